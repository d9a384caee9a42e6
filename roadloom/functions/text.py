"""Text, hash and url functions as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that stand for a missing value in stringly payloads.
NULL_WORDS = ["", "null", "none", "n/a", "na", "nil"]


def null_words_to_null(c: Column) -> Column:
    """Trimmed text, null if it only says that there is none."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin(NULL_WORDS), t)


def coerce_int(c: Column) -> Column:
    """Integer part of a number in text ("2.0" is 2); null where there is none."""
    return null_words_to_null(c).try_cast("double").try_cast("int")


def coerce_double(c: Column, default: float | None = None) -> Column:
    v = null_words_to_null(c).try_cast("double")
    return v if default is None else F.coalesce(v, F.lit(default))


def url_host(url: Column, keep_prefix: bool = False) -> Column:
    """Host in lower case, without www/m/mobile/amp prefix unless kept."""
    h = F.lower(F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)", 1))
    return h if keep_prefix else F.regexp_replace(h, r"^(?:(?:www|m|mobile|amp)\.)+", "")


def outlet_tier(items: DataFrame, outlet: DataFrame, national: list[str] | None = None) -> DataFrame:
    """(item_id, tier): 'aggregator' without a domain, 'national' for the domains in national, else by the domain's outlet,
    'regional' for unknown domains."""
    clean = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"^www\.", "")
    o = outlet.select(clean("website").alias("_site"), "tier")
    j = items.select("item_id", "source_domain", clean("source_domain").alias("_site")).join(o, "_site", "left")
    return j.select("item_id", F.when(F.col("source_domain").isNull(), "aggregator").when(F.col("_site").isin(national or []), "national").otherwise(F.coalesce("tier", F.lit("regional"))).alias("tier"))


def words(text: Column) -> Column:
    """Runs of letters, numbers and underscores, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def simhash(text: Column) -> Column:
    """64-bit SimHash of the words as 16 hex digits: bit i is set if most words' xxhash64 have it; null for null text.

    An empty text has no words and hashes to 0.
    """
    h = F.transform(words(text), lambda w: F.xxhash64(w))
    half = lambda s: F.aggregate(F.sequence(F.lit(0), F.lit(31)), F.lit(0).cast("bigint"), lambda acc, i: acc + F.when(2 * F.size(F.filter(h, lambda x: F.call_function("shiftrightunsigned", x, (i + s).cast("int")).bitwiseAND(F.lit(1)) == 1)) > F.size(h), F.call_function("shiftleft", F.lit(1).cast("bigint"), i.cast("int"))).otherwise(F.lit(0)))
    return F.when(text.isNotNull(), F.lower(F.concat(F.lpad(F.hex(half(32)), 8, "0"), F.lpad(F.hex(half(0)), 8, "0"))))


def halves(hex16: Column) -> tuple[Column, Column]:
    ok = hex16.rlike("^[0-9A-Fa-f]{16}$")
    return tuple(F.when(ok, F.conv(F.substring(hex16, s, 8), 16, 10).try_cast("bigint")) for s in (1, 9))


def hamming(a: Column, b: Column) -> Column:
    """Bits in which two hashes of 16 hex digits differ; null unless both are such hashes."""
    (ah, al), (bh, bl) = halves(a), halves(b)
    return F.bit_count(ah.bitwiseXOR(bh)) + F.bit_count(al.bitwiseXOR(bl))
