"""One UTC instant for each record of the article and feed tables that tells one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import with_utc_micros

DEFAULT_ZONE = "Asia/Kolkata"


def domain(c):
    """Host name for lookups: lower case, without a leading www."""
    return F.regexp_replace(F.lower(F.trim(c)), r"^www\.", "")


def _outlets(outlet: DataFrame, key: str, as_: str) -> DataFrame:
    o = outlet.select(F.col(key).alias(as_), F.col("tz").alias("_tz"), (F.upper("date_order") != "MDY").alias("_dmy"))
    return o.where(F.col(as_).isNotNull()).groupBy(as_).agg(F.min(F.struct("_tz", "_dmy")).alias("_outlet"))


def with_article_instant(article: DataFrame, outlet: DataFrame) -> DataFrame:
    """article with utc_us, null where published_at tells no instant.

    Nulls: a null outlet_name, or one without an outlet row, is read as Asia/Kolkata and DMY.
    The outlet side is joined without a hint: Spark broadcasts it only while its size is under the threshold.
    """
    j = article.join(_outlets(outlet, "name", "outlet_name"), "outlet_name", "left")
    j = with_utc_micros(j, F.col("published_at"), F.coalesce("_outlet._tz", F.lit(DEFAULT_ZONE)), F.coalesce("_outlet._dmy", F.lit(True)))
    return j.select(*article.columns, "utc_us")


def article_instants(article: DataFrame, outlet: DataFrame) -> DataFrame:
    """(id, utc_us) of every article."""
    return with_article_instant(article.select("id", "published_at", "outlet_name"), outlet).select("id", "utc_us")


def feed_instants(feed: DataFrame, outlet: DataFrame) -> DataFrame:
    """(item_id, utc_us); the outlet is found by source_domain, or by source_name where there is no domain."""
    f = feed.select("item_id", "published_at", F.nullif(domain("source_domain"), F.lit("")).alias("_dom"), "source_name")
    by_site = _outlets(outlet.withColumn("website", domain("website")), "website", "_dom")
    by_name = _outlets(outlet, "name", "source_name").withColumnRenamed("_outlet", "_named")
    j = f.join(by_site, "_dom", "left").join(by_name, "source_name", "left")
    o = F.coalesce("_outlet", F.when(F.col("_dom").isNull(), F.col("_named")))
    return with_utc_micros(j, F.col("published_at"), F.coalesce(o["_tz"], F.lit(DEFAULT_ZONE)), F.coalesce(o["_dmy"], F.lit(True))).select("item_id", "utc_us")


def gdelt_instants(gdelt: DataFrame) -> DataFrame:
    """(item_id, utc_us); values without a zone are UTC."""
    return with_utc_micros(gdelt.select("item_id", "published_at"), F.col("published_at"), F.lit("UTC"), F.lit(True)).select("item_id", "utc_us")


def all_instants(article: DataFrame, feed: DataFrame, gdelt: DataFrame, outlet: DataFrame) -> DataFrame:
    """(src, item_id, utc_us) of every record, repeated ones too, whose published_at tells an instant."""
    parts = [
        article_instants(article, outlet).select(F.lit("source_article").alias("src"), F.col("id").alias("item_id"), "utc_us"),
        feed_instants(feed, outlet).select(F.lit("feed_item").alias("src"), "item_id", "utc_us"),
        gdelt_instants(gdelt).select(F.lit("gdelt_item").alias("src"), "item_id", "utc_us"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).where(F.col("utc_us").isNotNull())
