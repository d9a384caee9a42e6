"""File sources and sinks: CSV, JSON, JSON lines, GeoJSON, parquet tables with keys."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import file_system


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, columns by the given schema (never inferred)."""
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object a line; malformed lines come out as nulls."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def write_jsonl(rows: DataFrame, path: str, append: bool = False) -> None:
    """One JSON object a line, nulls kept; written anew or appended."""
    rows.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, on any storage."""
    fs, at = file_system(spark, path)
    return fs.getContentSummary(at).getLength()


def read_nested_districts(spark: SparkSession, path: str) -> DataFrame:
    """(state, district) rows of a document {"states": [{"state": .., "districts": [..]}]}."""
    d = spark.read.option("multiLine", True).schema("states array<struct<state:string,districts:array<string>>>").json(path)
    return d.select(F.explode("states").alias("s")).select("s.state", F.explode("s.districts").alias("district"))


def read_keywords(spark: SparkSession, path: str, categories: list[str]) -> DataFrame:
    """(language, category, term, position) rows of a document {"languages": {code: {category: [terms]}}}."""
    inner = ", ".join(f"{c}: array<string>" for c in categories)
    d = spark.read.option("multiLine", True).schema(f"languages map<string, struct<{inner}>>").json(path)
    d = d.select(F.explode("languages").alias("language", "k"))
    tall = F.array(*[F.named_struct(F.lit("category"), F.lit(c), F.lit("terms"), F.col(f"k.{c}")) for c in categories])
    return d.select("language", F.explode(tall).alias("c")).select("language", "c.category", F.posexplode("c.terms").alias("position", "term")).select("language", "category", "term", "position")


def read_settings(path: str, defaults: dict) -> dict:
    """Settings of a JSON document over the defaults."""
    with open(path, encoding="utf-8") as f:
        return {**defaults, **json.load(f).get("settings", {})}


def geojson_features(points: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(feature): one GeoJSON Feature a row, coordinates to six decimals, all other columns as properties."""
    props = F.struct(*[c for c in points.columns if c not in (lat, lon)])
    xy = F.array(F.round(lon, 6), F.round(lat, 6))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), xy.alias("coordinates")).alias("geometry"), props.alias("properties"))
    return points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))


def write_geojson_seq(points: DataFrame, path: str) -> None:
    """GeoJSON text sequence: a feature a line, written by all executors."""
    geojson_features(points).write.mode("overwrite").text(path)


def write_csv_pack(rows: DataFrame, path: str) -> None:
    """CSV with header and doubled quotes; arrays joined by '; '."""
    flat = rows.select(*[F.array_join(F.transform(c, lambda x: x.cast("string")), "; ").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes])
    flat.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def nested(parents: DataFrame, key: str, **children: DataFrame) -> DataFrame:
    """parents with one sorted array of structs per child table (key, ...); [] where a parent has none."""
    out = parents
    for name, c in children.items():
        fields = [x for x in c.columns if x != key]
        g = c.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
        kind = g.schema[name].dataType
        out = out.join(g, key, "left").withColumn(name, F.coalesce(F.col(name), F.array().cast(kind)))
    return out


class KeyedTable:
    """A parquet table with a unique key: every write makes a new snapshot, readers see the last complete one."""

    def __init__(self, spark: SparkSession, root: str, schema: str, key: list[str]):
        self.spark, self.root, self.schema, self.key, self.at = spark, root.rstrip("/"), schema, key, None

    def read(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema) if self.at is None else self.spark.read.schema(self.schema).parquet(self.at)

    def _swap(self, df: DataFrame) -> None:
        to = f"{self.root}/{uuid.uuid4().hex}"
        df.write.parquet(to)
        self.at = to

    def insert_if_absent(self, rows: DataFrame) -> DataFrame:
        """Rows added: the first (smallest) of each new key; keys are compared null-safely."""
        cols = [c for c in rows.columns]
        first = rows.groupBy(*self.key).agg(F.min(F.struct(*[c for c in cols if c not in self.key])).alias("_r")).select(*self.key, "_r.*") if len(cols) > len(self.key) else rows.distinct()
        old = self.read().select(*[F.col(k).alias(f"_{k}") for k in self.key])
        cond = F.lit(True)
        for k in self.key:
            cond = cond & F.col(k).eqNullSafe(F.col(f"_{k}"))
        new = first.join(old, cond, "left_anti").select(*self.read().columns)
        self._swap(self.read().unionByName(new))
        return new

    def upsert(self, rows: DataFrame) -> None:
        """Rows replace those of their key; of several with one key the largest counts."""
        rest = [c for c in self.read().columns if c not in self.key]
        both = self.read().withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
        g = both.groupBy(*self.key).agg(F.max(F.struct("_new", *rest)).alias("_r"))
        self._swap(g.select(*self.key, *[F.col(f"_r.{c}").alias(c) for c in rest]))
