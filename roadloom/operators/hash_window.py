"""The smallest earlier row with a near hash in the same place and within a time window.

Rows of one hash are a class: near classes are found by four 16-bit bands (hashes at most 3 bits apart share one) within
place and week, and a row meets of each near class the hours of three weeks with their smallest id, opening single rows only
of the hours in which the window ends.  So groups of copies are never expanded into pairs.

All three tables carry a block of weeks, so that a probe of persisted ones reads only the blocks its times touch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import halves
from ..runtime import persist_table

MAX_BITS = 3
WINDOW_US = 7 * 86400 * 1000000
HOUR_US = 3600 * 1000000
BLOCK_WEEKS = 4


def place(level: str, name: Column) -> Column:
    return F.when(name.isNotNull(), F.concat(F.lit(level + ":"), name))


def own_place() -> Column:
    """Where a new row looks: its district, else its state."""
    return F.coalesce(place("d", F.col("district")), place("s", F.col("state")))


def bands(week: Column) -> Column:
    parts = [F.shiftright("hi", 16), F.col("hi").bitwiseAND(F.lit(65535)), F.shiftright("lo", 16), F.col("lo").bitwiseAND(F.lit(65535))]
    return F.array(*[F.xxhash64(F.col("place"), week, F.lit(i), p) for i, p in enumerate(parts)])


def week(t: Column) -> Column:
    return F.floor(t / WINDOW_US)


def touched_blocks(t: Column) -> Column:
    """Blocks in which rows near a time can lie: those of its week and the weeks beside it; null without a time."""
    return F.when(t.isNotNull(), F.array_distinct(F.array(*[F.floor((week(t) + d) / BLOCK_WEEKS) for d in (-1, 0, 1)])))


def keyed(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(keys, hours, times) of rows (id, hi, lo, t, district, state), each with its block.

    keys: blocking keys of the hashes of a place and week; hours: per place, hash and hour the smallest id with its time, and
    the first and last time; times: the rows themselves, one for each place they belong to.
    """
    h = rows.where("hi is not null and t is not null").withColumn("place", F.explode(F.array_compact(F.array(place("d", F.col("district")), place("s", F.col("state"))))))
    times = h.select("place", "hi", "lo", week(F.col("t")).alias("week"), F.floor(F.col("t") / HOUR_US).alias("hour"), "t", "id").withColumn("block", F.floor(F.col("week") / BLOCK_WEEKS))
    keys = times.select("block", "place", "hi", "lo", "week").distinct().select("block", F.explode(bands(F.col("week"))).alias("bk"), "hi", "lo").distinct()
    hours = times.groupBy("block", "place", "hi", "lo", "week", "hour").agg(F.min(F.struct("id", "t")).alias("s"), F.min("t").alias("t0"), F.max("t").alias("t1"))
    return keys, hours.select("block", "place", "hi", "lo", "week", "hour", F.col("s.id").alias("a"), F.col("s.t").alias("ta"), "t0", "t1"), times


#: Whether a candidate is worth the exact test, from the bits in which its hash differs and whether it met by district.
Gate = Callable[[Column, Column], Column]


def _met_hours(new: DataFrame, keys: DataFrame, hours: DataFrame, max_bits: int, gate: Gate | None) -> DataFrame:
    """(id, t, place, ahi, alo, aw, bits, hour, a, ta, inside): the hours of near classes that new rows meet; a is the smallest id
    of an hour and ta its time, inside that the whole hour lies in the window."""
    n = new.withColumn("place", own_place()).where("hi is not null and t is not null and place is not null").select("id", "place", "hi", "lo", "t", week(F.col("t")).alias("week"))
    classes = n.select("place", "hi", "lo", "week").distinct().withColumn("aw", F.explode(F.sequence(F.col("week") - 1, F.col("week") + 1)))
    c = classes.withColumn("bk", F.explode(bands(F.col("aw"))))
    k = keys.select("bk", F.col("hi").alias("ahi"), F.col("lo").alias("alo"))
    bits = F.bit_count(F.col("hi").bitwiseXOR(F.col("ahi"))) + F.bit_count(F.col("lo").bitwiseXOR(F.col("alo")))
    near = c.join(k, "bk").select("place", "hi", "lo", "week", "aw", "ahi", "alo", bits.alias("bits"))
    if gate is not None:
        near = near.where(gate(F.col("bits"), F.startswith("place", F.lit("d:"))))
    near = near.where(F.col("bits") <= max_bits).distinct()
    hours = hours.select("place", F.col("hi").alias("ahi"), F.col("lo").alias("alo"), F.col("week").alias("aw"), "hour", "a", "ta", "t0", "t1")
    met = n.join(near, ["place", "hi", "lo", "week"]).join(hours, ["place", "ahi", "alo", "aw"])
    met = met.where((F.col("t1") >= F.col("t") - WINDOW_US) & (F.col("t0") <= F.col("t") + WINDOW_US))
    inside = (F.col("t0") >= F.col("t") - WINDOW_US) & (F.col("t1") <= F.col("t") + WINDOW_US)
    return met.select("id", "t", "place", "ahi", "alo", "aw", "bits", "hour", "a", "ta", inside.alias("inside"))


def _by_class(times: DataFrame) -> DataFrame:
    return times.select("place", F.col("hi").alias("ahi"), F.col("lo").alias("alo"), F.col("week").alias("aw"), "hour", F.col("t").alias("ta"), F.col("id").alias("b"))


def first_near(new: DataFrame, keys: DataFrame, hours: DataFrame, times: DataFrame, max_bits: int = MAX_BITS, gate: Gate | None = None) -> DataFrame:
    """(id, first, bits, gap, by_district): for rows (id, hi, lo, t, district, state) the smallest id in times within max_bits (up
    to 3), place and window, with how it differs; no row without one.  If the row itself is in times it may be its own first.

    gate: drops candidates before the exact test; the caller answers for its dropping no true one.
    """
    met = _met_hours(new, keys, hours, max_bits, gate)
    met = met.select("id", "t", "place", "ahi", "alo", "aw", "bits", "a", "ta", "inside", F.when(~F.col("inside"), F.col("hour")).alias("hour"))  # no hour: nothing to open
    rows = _by_class(times).groupBy("place", "ahi", "alo", "aw", "hour", F.col("ta").alias("rt")).agg(F.min("b").alias("ra"))
    met = met.join(rows, ["place", "ahi", "alo", "aw", "hour"], "left")
    found = lambda i, t: F.struct(i.alias("first"), F.col("bits"), F.abs(F.col("t") - t).alias("gap"), F.startswith("place", F.lit("d:")).alias("by_district"))
    hit = F.when(F.col("inside"), found(F.col("a"), F.col("ta"))).when(F.abs(F.col("t") - F.col("rt")) <= WINDOW_US, found(F.col("ra"), F.col("rt")))
    return met.groupBy("id").agg(F.min(hit).alias("s")).where("s is not null").select("id", "s.*")


def all_near(new: DataFrame, keys: DataFrame, hours: DataFrame, times: DataFrame, below: bool = False, max_bits: int = MAX_BITS, gate: Gate | None = None) -> DataFrame:
    """(x, b), edges that join each new row to all ids in times that it is near, directly or through one of these ids.

    An hour of copies that lies in a row's window as a whole, or a moment of an hour that is opened, is joined to its smallest
    id once, whichever rows meet it: rows and copies add up, they do not multiply.  below: a row meets smaller ids only; of a
    group its members below the largest row that meets it are joined.
    """
    at = ["place", "ahi", "alo", "aw", "hour"]
    met = _met_hours(new, keys, hours, max_bits, gate).drop("bits", "ta")
    met = met.where("a < id") if below else met
    rows = _by_class(times)
    moments = rows.groupBy(*at, "ta").agg(F.min("b").alias("ra")).withColumnRenamed("hour", "opened")
    met = met.withColumn("opened", F.when(~F.col("inside"), F.col("hour"))).join(moments, [*at[:-1], "opened"], "left")
    met = met.where(F.col("inside") | (F.abs(F.col("t") - F.col("ta")) <= WINDOW_US) & ((F.col("ra") < F.col("id")) if below else F.lit(True)))
    met = persist_table(met.select("id", *at, F.col("ta").alias("only"), F.when(F.col("inside"), F.col("a")).otherwise(F.col("ra")).alias("first")), "met")
    groups = met.groupBy(*at, "only").agg(F.min("first").alias("first"), F.max("id").alias("last"))
    members = rows.join(groups, at).where("only is null or only = ta")
    members = members.where("b < last") if below else members
    edges = met.select("id", "first").unionByName(members.select(F.col("b").alias("id"), "first"))
    return edges.where("id <> first").select(F.col("id").alias("x"), F.col("first").alias("b")).distinct()


def without_near(rows: DataFrame, among: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows (id, district, dedup_hash, ...) that no other id of `among` is within max_bits of (up to 3) in their district.

    Hashes of a district are classes with their number of ids and one of them; classes meet by bands, so copies make no pairs.
    """
    def classes(df: DataFrame) -> DataFrame:
        hi, lo = halves(F.col("dedup_hash"))
        c = df.select("id", "district", hi.alias("hi"), lo.alias("lo")).where("district is not null and hi is not null")
        return c.groupBy("district", "hi", "lo").agg(F.min("id").alias("first"), F.max("id").alias("last"))

    def banded(c: DataFrame) -> DataFrame:
        return c.withColumn("place", F.col("district")).withColumn("bk", F.explode(bands(F.lit(0).cast("bigint")))).drop("place")

    x = banded(classes(rows).drop("first", "last"))
    y = banded(classes(among)).select("bk", "district", F.col("hi").alias("h2"), F.col("lo").alias("l2"), "first", "last")
    bits = F.bit_count(F.col("hi").bitwiseXOR(F.col("h2"))) + F.bit_count(F.col("lo").bitwiseXOR(F.col("l2")))
    near = x.join(y, ["bk", "district"]).where(bits <= max_bits).groupBy("district", "hi", "lo").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    hi, lo = halves(F.col("dedup_hash"))
    r = rows.withColumns({"_hi": hi, "_lo": lo})
    near = near.select(F.col("district").alias("_d"), F.col("hi").alias("_h2"), F.col("lo").alias("_l2"), "first", "last")
    j = r.join(near, (F.col("district") == F.col("_d")) & (F.col("_hi") == F.col("_h2")) & (F.col("_lo") == F.col("_l2")), "left")
    alone = F.col("first").isNull() | ((F.col("first") == F.col("id")) & (F.col("last") == F.col("id")))
    return j.where(alone).select(*rows.columns)


def near_duplicates(article: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, first_like_it): articles with an earlier one (smaller id) within max_bits (up to 3) in their locality and seven
    days of fetching, and the first such.

    Locality is the district, or the state of an article without one; articles with neither, without a hash of 16 hex
    digits or without a time have none.  Nothing is said of later copies, and groups of copies are not expanded.
    """
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    hi, lo = halves(F.col("dedup_hash"))
    a = article.select("id", blank("district").alias("district"), blank("state").alias("state"), F.unix_micros("fetched_at").alias("t"), hi.alias("hi"), lo.alias("lo"))
    return first_near(a, *keyed(a), max_bits).where("first < id").select("id", F.col("first").alias("first_like_it"))
