"""Consecutive numbers in a global order without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import persist_table


def numbered(df: DataFrame, order: list[str], name: str = "n") -> DataFrame:
    """df with `name`: 1, 2, ... in ascending order of the columns (nulls first), which should tell all rows apart.

    Rows are written in ranges of the order; each range is numbered by itself and raised by the size of those before it, of
    which there are as many as partitions.
    """
    p = persist_table(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    size = p.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = size.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return p.withColumn("_in", inside).join(before, "_part").select(*df.columns, (F.col("_before") + F.col("_in")).cast("bigint").alias(name))
