"""Extension points: geocoders, extractors and classifiers of the user's own, run over tables in Arrow batches.

A plug-in says which columns it reads and which it gives, and turns a batch of the one into a batch of the other; it never
sees a session.  Results may come from a cache (lookup.cached); only what the cache lacks reaches the plug-in.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookup import cached, fresh_entries, misses


class Extension(Protocol):
    """reads: names of the input columns; gives: DDL of the output columns."""

    reads: list[str]
    gives: str

    def run(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """One output row for each input row, in order, with the columns of gives."""
        ...


class Geocoder(Extension, Protocol):
    """reads ["query"], gives "lat double, lon double, state string, district string, span_km double"."""


class Extractor(Extension, Protocol):
    """reads ["text"], gives "body string": a JSON payload of what the text reports, null for nothing."""


class Classifier(Extension, Protocol):
    """reads ["text"], gives "label string, confidence double"."""


def extend(df: DataFrame, plug: Extension) -> DataFrame:
    """df with the plug-in's columns; columns of df of the same names are replaced.  A batch of another length is an error."""
    gives = [c.split()[0] for c in plug.gives.split(",")]
    keep = [c for c in df.columns if c not in gives]
    fields = [f for f in df.schema.fields if f.name in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [plug.gives])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = plug.run(b.select(plug.reads))
            if out.num_rows != b.num_rows:
                raise ValueError(f"{b.num_rows} rows in, {out.num_rows} out")
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [out.column(c) for c in gives], names=keep + gives)

    return df.mapInArrow(run, schema)


def looked_up(requests: DataFrame, cache: DataFrame, plug: Extension) -> tuple[DataFrame, DataFrame]:
    """(requests with the plug-in's columns and hit, entries to add to the cache); requests and cache by `key`, which the plug-in
    reads under its only column.  Failures (null in any column) are answered with nulls and do not enter the cache."""
    gives = [c.split()[0] for c in plug.gives.split(",")]
    asked = extend(misses(requests, cache).select(F.col("key").alias(plug.reads[0])), plug).withColumnRenamed(plug.reads[0], "key")
    new = fresh_entries(asked, gives)
    return cached(requests, cache.select("key", *gives).unionByName(new.select("key", *gives))), new
