"""Structured Streaming forms of the intake: counts by event time, first arrivals, duplicates against history."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import scratch_path
from ..sources.files import KeyedTable


def event_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int = 1) -> DataFrame:
    """A table's parquet file or folder as a stream."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def windowed_counts(events: DataFrame, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows and sums per window and type; rows later than the watermark are dropped once their window is closed."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    g = e.groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding_counts(events: DataFrame, key: str, length: str, slide: str, late: str = "10 minutes") -> DataFrame:
    """Rows per sliding window and key."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    g = e.groupBy(F.window("ts", length, slide).alias("w"), F.col(key).alias("place")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("start"), "place", "n")


def expired_keys(events: DataFrame, key: str, time: str, ttl_ms: int) -> DataFrame:
    """(key, due): keys without a row for ttl_ms of event time, when that is over; a key that comes again starts anew.

    One timer per key in the state, none for keys that have expired.  No row is late: the watermark is the latest time seen.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(k: tuple, batches, state: GroupState):
        if state.hasTimedOut:
            due = state.get[0]
            state.remove()
            yield pd.DataFrame({key: [k[0]], "due": pd.to_datetime([due], unit="us")})
            return
        last = max(int(b["us"].max()) for b in batches)
        due = max(last + ttl_ms * 1000, state.get[0] if state.exists else 0)
        state.update((due,))
        state.setTimeoutTimestamp(max(-(-due // 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({key: pd.Series([], dtype="int64"), "due": pd.Series([], dtype="datetime64[us]")})

    e = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, "0 seconds").select(F.col(key).cast("bigint").alias(key), time, F.unix_micros(time).alias("us"))
    return e.groupBy(key).applyInPandasWithState(step, f"{key} bigint, due timestamp", "due bigint", "append", GroupStateTimeout.EventTimeTimeout)


def upsert_stream(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The table that a stream leaves when each micro-batch is upserted by key: of all rows of a key the largest stays, so late
    rows and repeated batches do no harm."""
    spark = stream.sparkSession
    t = KeyedTable(spark, scratch_path(spark, "upserts"), ", ".join(f"{c} {k}" for c, k in stream.dtypes), keys)

    def merge(batch: DataFrame) -> None:
        rest = [c for c in batch.columns if c not in keys]
        both = batch.unionByName(t.read())
        t.upsert(both.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*keys, "_r.*"))

    each_batch(stream, merge, scratch_path(spark, "upsert-state")).awaitTermination()
    return t.read()


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Session windows per user: events closer than the gap."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    g = e.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_arrivals(items: DataFrame, key: str, late: str = "7 days", time: str = "collected_at") -> DataFrame:
    """The first row of each key; state is dropped after the watermark, so repeats are caught within it."""
    return items.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def run_to_table(stream: DataFrame, mode: str = "complete") -> DataFrame:
    """Run a stream over what is there now and give its result as a table (written to the shared folder)."""
    spark = stream.sparkSession
    out, at = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    name = f"q{uuid.uuid4().hex}"

    def keep(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(out)

    q = stream.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", at).foreachBatch(keep).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def each_batch(stream: DataFrame, act: Callable[[DataFrame], None], checkpoint: str):
    """Call act on each micro-batch once (the batch id lets act be idempotent); for history lookups such as deduplication."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda b, _: act(b)).trigger(availableNow=True).start()
