"""Defects that articles name, as a relation of incidents, with a taxonomy of weights."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Codes of the taxonomy, severity weight from 1 to 5, and whether the code is a defect at all.
TAXONOMY = [
    ("no_or_faded_road_markings", 2.5, True), ("missing_or_inadequate_signage", 3.0, True), ("no_street_lighting", 3.0, True), ("unmarked_or_illegal_speed_breaker", 3.5, True),
    ("potholes_or_broken_surface", 3.5, True), ("sharp_or_blind_curve_geometry", 4.0, True), ("missing_crash_barrier_or_guardrail", 4.5, True), ("unsafe_junction_or_intersection_design", 4.0, True),
    ("missing_pedestrian_crossing_or_FOB", 4.0, True), ("missing_footpath_or_encroached_footpath", 3.5, True), ("median_gap_or_illegal_U_turn", 4.0, True), ("no_service_road_direct_access", 3.5, True),
    ("waterlogging_or_poor_drainage", 3.0, True), ("unsafe_construction_or_work_zone", 4.0, True), ("missing_rumble_strips", 2.5, True), ("poor_visibility_vegetation_or_obstruction", 3.0, True),
    ("unprotected_railway_or_level_crossing", 5.0, True), ("steep_gradient_or_missing_runaway_provision", 4.0, True), ("known_blackspot_untreated", 5.0, True), ("other_infrastructure", 3.0, True),
    ("no_infrastructure_defect_identified", 1.0, False),
]
#: Words by which a text names a defect, here for the languages of the tables.
VOCABULARY = {
    "potholes_or_broken_surface": ["pothole", "गड्ढ", "खड्ड"],
    "no_street_lighting": ["street light", "स्ट्रीट लाइट"],
    "missing_crash_barrier_or_guardrail": ["crash barrier", "railing", "रेलिंग"],
    "unmarked_or_illegal_speed_breaker": ["speed breaker", "स्पीड ब्रेकर"],
    "missing_or_inadequate_signage": ["signboard"],
    "no_or_faded_road_markings": ["lane marking"],
    "sharp_or_blind_curve_geometry": ["blind curve", "मोड़"],
    "median_gap_or_illegal_U_turn": ["median cut"],
}


def taxonomy(spark: SparkSession) -> DataFrame:
    """(code, weight, is_defect)."""
    return spark.createDataFrame(TAXONOMY, "code string, weight double, is_defect boolean")


def claims(links: DataFrame, articles: DataFrame, vocabulary: dict[str, list[str]] = VOCABULARY) -> DataFrame:
    """(incident_id, defect_type, confidence, source_id): the defects that the articles (id, clean_text) of incidents (incident_id,
    source_article_id, match_confidence) name, with the link's confidence.  Null texts name none."""
    text = F.lower("clean_text")
    any_of = lambda terms: functools.reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])
    codes = F.array_compact(F.array(*[F.when(any_of(terms), code) for code, terms in vocabulary.items()]))
    codes = F.when(F.spark_partition_id() >= 0, codes)  # non-deterministic: keeps the search from being repeated in a filter
    named = articles.where("clean_text is not null").select(F.col("id").alias("source_article_id"), F.explode(codes).alias("defect_type"))
    return links.join(named, "source_article_id").select("incident_id", "defect_type", F.col("match_confidence").alias("confidence"), F.col("source_article_id").alias("source_id"))


def best_claims(found: DataFrame) -> DataFrame:
    """One row for each incident and defect: the most confident (one without a confidence only if there is no other), the smaller
    source on ties."""
    best = F.min(F.struct(F.col("confidence").isNull().alias("none"), (-F.col("confidence")).alias("less"), "source_id"))
    g = found.groupBy("incident_id", "defect_type").agg(best.alias("s"))
    return g.select("incident_id", "defect_type", (-F.col("s.less")).alias("confidence"), F.col("s.source_id").alias("source_id"))


def severity(defects: DataFrame, members: DataFrame, tax: DataFrame) -> DataFrame:
    """(cluster, severity): the greatest weight of a defect of any member (id, cluster); codes that are no defects do not count."""
    d = defects.select(F.col("incident_id").alias("id"), "defect_type").join(tax.where("is_defect"), F.col("defect_type") == F.col("code"))
    return members.where("cluster is not null").select("id", "cluster").join(d, "id").groupBy("cluster").agg(F.max("weight").alias("severity"))


def dominant(defects: DataFrame, members: DataFrame, tax: DataFrame, k: int = 3) -> DataFrame:
    """(cluster, defects): the k commonest defects of each cluster, most confident first on ties, then by code.

    Counts are taken before anything is gathered; a cluster has at most as many codes as the taxonomy.
    """
    d = defects.join(tax.where("is_defect").select(F.col("code").alias("defect_type")), "defect_type", "left_semi").withColumnRenamed("incident_id", "id")
    c = members.where("cluster is not null").select("id", "cluster").join(d, "id").groupBy("cluster", "defect_type").agg(F.count(F.lit(1)).alias("n"), F.max("confidence").alias("mx"))
    rn = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("n"), F.desc_nulls_last("mx"), "defect_type"))
    top = c.withColumn("rn", rn).where(F.col("rn") <= k)
    return top.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("rn", "defect_type"))), lambda s: s["defect_type"]).alias("defects"))


def modes(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key and the commonest value of each column, nulls aside, the smallest on ties; null where a column has no value.

    Values are counted by (key, column, value) first, so no group is gathered.
    """
    tall = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]))
    n = rows.select(key, tall.alias("s")).where("s.v is not null").groupBy(key, "s.c", "s.v").agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy(key, "c").agg(F.min(F.struct((-F.col("n")).alias("less"), "v")).alias("s"))
    return best.groupBy(key).agg(*[F.max(F.when(F.col("c") == c, F.col("s.v"))).alias(c) for c in columns])
