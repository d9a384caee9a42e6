"""A cache of lookups as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh_entries(found: DataFrame, fields: list[str], valid: Column | None = None) -> DataFrame:
    """The rows (key, fields) that may enter a cache, one for each key (the smallest): a key and all fields given, and valid.

    Failures (null fields) and entries of another shape are left out, so they are asked for again.
    """
    ok = F.col("key").isNotNull()
    for f in fields:
        ok = ok & F.col(f).isNotNull()
    rows = found.where(ok if valid is None else ok & F.coalesce(valid, F.lit(False)))
    return rows.groupBy("key").agg(F.min(F.struct(*fields)).alias("_e")).select("key", *[F.col(f"_e.{f}").alias(f) for f in fields])


def cached(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """requests (key, ...) with the cache's fields and whether it had them (hit); every request once."""
    return requests.join(cache.withColumn("hit", F.lit(True)), "key", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def misses(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """The keys that have to be looked up, each once."""
    return requests.select("key").where("key is not null").distinct().join(cache.select("key"), "key", "left_anti")
