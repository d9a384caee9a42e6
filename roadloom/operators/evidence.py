"""Vocabulary screening and verbatim evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_DEFECT = "no_infrastructure_defect_identified"


def stems(terms: list[str]) -> list[str]:
    """Terms in lower case and, from four characters, without the last one (case endings)."""
    low = {t.lower() for t in terms}
    return sorted(low | {t[:-1] for t in low if len(t) >= 4})


def mentions(text: Column, terms: list[str]) -> Column:
    """Whether a text holds one of the terms or stems anywhere, by one alternation; false for null text."""
    import re

    return F.coalesce(F.lower(text).rlike("|".join(re.escape(t).replace("\\ ", " ") for t in stems(terms))), F.lit(False))


def squeezed(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def valid_claims(claims: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, code, confidence, snippet) of claims (doc_id, code, confidence, snippet) backed by a verbatim quote.

    White space and case aside, the snippet must stand in the text; blank snippets are no evidence.  Of several claims of
    a code the most confident stays (ties: the smaller snippet); NO_DEFECT only where nothing else is claimed.
    """
    c = claims.where(F.trim("snippet") != "").join(texts.select(F.col("id").alias("doc_id"), squeezed(F.col("text")).alias("_t")), "doc_id")
    c = c.where(F.contains(F.col("_t"), squeezed(F.col("snippet"))))
    best = c.groupBy("doc_id", "code").agg(F.min(F.struct((-F.coalesce("confidence", F.lit(0.0))).alias("_o"), "snippet", "confidence")).alias("s")).select("doc_id", "code", "s.confidence", "s.snippet")
    real = best.where(F.col("code") != NO_DEFECT).select("doc_id").distinct().withColumn("_real", F.lit(True))
    return best.join(real, "doc_id", "left").where((F.col("code") != NO_DEFECT) | F.col("_real").isNull()).select("doc_id", "code", "confidence", "snippet")
