"""Equi-joins in which a key may hold any share of the rows of both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one side with one key that one task takes.
HOT_ROWS = 2000


def salted_join(a: DataFrame, b: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """a join b on keys, crowded keys split on both sides.

    A key with m rows in a and n in b is cut into ceil(m / hot_rows) by ceil(n / hot_rows) tasks: each row of a goes to one
    strip and is copied to the parts of b, and the other way round.  Keys are counted by partial aggregates; only crowded
    ones come back, at most (rows / hot_rows) of them.  Keys that are null meet nothing.
    """
    def crowded(df: DataFrame, name: str) -> DataFrame:
        n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
        return n.select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias(name))

    hot = crowded(a, "_pa").join(crowded(b, "_pb"), keys, "full_outer").select(*keys, F.coalesce("_pa", F.lit(1)).alias("_pa"), F.coalesce("_pb", F.lit(1)).alias("_pb"))
    one = F.lit(1)
    x, y = (df.join(hot, keys, "left").withColumns({"_pa": F.coalesce("_pa", one), "_pb": F.coalesce("_pb", one)}) for df in (a, b))
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = x.withColumn("_sa", F.when(F.col("_pa") > 1, F.pmod(F.xxhash64(*[c for c in a.columns]), "_pa").cast("int")).otherwise(0)).withColumn("_sb", copies("_pb")).drop("_pa", "_pb")
    y = y.withColumn("_sb", F.when(F.col("_pb") > 1, F.pmod(F.xxhash64(*[c for c in b.columns]), "_pb").cast("int")).otherwise(0)).withColumn("_sa", copies("_pa")).drop("_pa", "_pb")
    return x.join(y, [*keys, "_sa", "_sb"]).drop("_sa", "_sb")
