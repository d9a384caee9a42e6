"""Instants against Python's zoneinfo, policies for ambiguous, skipped and impossible values."""

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from roadloom.functions.timestamps import with_utc_micros
from roadloom.operators.instants import all_instants, feed_instants


def us(*a, tz="UTC"):
    return int(dt.datetime(*a, tzinfo=ZoneInfo(tz)).timestamp() * 1_000_000)


CASES = [
    ("2025-09-01T05:36:24+05:30", "UTC", True, us(2025, 9, 1, 0, 6, 24)),
    ("2025-09-01", "Asia/Kolkata", True, us(2025, 9, 1, tz="Asia/Kolkata")),
    ("2025-08-31 23:13:33.818520+0530", "UTC", True, us(2025, 8, 31, 17, 43, 33, 818520)),
    ("2025-08-31 20:41:07+00", "UTC", True, us(2025, 8, 31, 20, 41, 7)),
    ("30/08/2025 12:52", "Europe/London", True, us(2025, 8, 30, 12, 52, tz="Europe/London")),
    ("08/30/2025 12:52", "America/New_York", False, us(2025, 8, 30, 12, 52, tz="America/New_York")),
    ("08-09-2025 12:52", "UTC", False, us(2025, 8, 9, 12, 52)),
    ("1756864336", "UTC", True, 1756864336 * 1_000_000),
    ("1753085134008", "UTC", True, 1753085134008 * 1000),
    ("20250904091322", "UTC", True, us(2025, 9, 4, 9, 13, 22)),
    ("20260116t224741z", "Asia/Kolkata", True, us(2026, 1, 16, 22, 47, 41)),
    ("Published on September 5, 2025 2:23 AM", "UTC", True, us(2025, 9, 5, 2, 23)),
    ("Last updated - August 9, 2025 12:52 PM", "UTC", True, us(2025, 8, 9, 12, 52)),
    ("02 Sep 2025 12:07 a.m. EDT", "UTC", True, us(2025, 9, 2, 4, 7)),
    ("Tue, 09 Jun 26 17:56:28 GMT", "UTC", True, us(2026, 6, 9, 17, 56, 28)),
    ("Mon, 09 Jun 2026 17:56:28 IST", "UTC", True, us(2026, 6, 9, 12, 26, 28)),
    ("07 Sep 2025 03:30 PM IST", "UTC", True, us(2025, 9, 7, 10, 0)),
    ("११ अक्टूबर २०२५, १४:०५", "Asia/Kolkata", True, us(2025, 10, 11, 14, 5, tz="Asia/Kolkata")),
    ("2025-11-02 01:30:00", "America/New_York", True, us(2025, 11, 2, 5, 30)),  # twice: the first
    ("2026-03-08 02:30:00", "America/New_York", True, us(2026, 3, 8, 7, 30)),  # skipped: offset before the change
    ("31/11/2025 09:00", "UTC", True, None),
    ("2026-13-04 08:00:00", "UTC", True, None),
    ("2026-02-29", "UTC", True, None),
    ("2026-01-01 24:10", "UTC", True, None),
    ("01 Sep 2025 13:10 PM IST", "UTC", True, None),
    ("yesterday", "UTC", True, None),
    ("3 hours ago", "UTC", True, None),
    ("", "UTC", True, None),
    (None, "UTC", True, None),
    ("x" * 5000, "UTC", True, None),
]


def test_shapes(spark):
    rows = [(i, v, z, d) for i, (v, z, d, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, v string, z string, d boolean")
    got = {r["i"]: r["utc_us"] for r in with_utc_micros(df, F.col("v"), F.col("z"), F.col("d")).collect()}
    for i, (v, _, _, want) in enumerate(CASES):
        assert got[i] == want, (v, got[i], want)


def test_lookup_and_clashing_columns(spark):
    outlet = spark.createDataFrame([("A", "a.example", "America/New_York", "MDY", 1)], "name string, website string, tz string, date_order string, _p int")
    feed = spark.createDataFrame([(1, "05/06/2025 00:00", "www.A.example", None), (2, "05/06/2025 00:00", None, "A"), (3, "05/06/2025 00:00", "b.example", "A"), (4, "05/06/2025 00:00", None, None)], "item_id bigint, published_at string, source_domain string, source_name string")
    got = {r[0]: r[1] for r in feed_instants(feed, outlet).collect()}
    ny, ist = us(2025, 5, 6, tz="America/New_York"), us(2025, 6, 5, tz="Asia/Kolkata")
    assert got == {1: ny, 2: ny, 3: ist, 4: ist}


def test_repeated_rows_and_empty_tables(spark):
    art = spark.createDataFrame([(1, "2025-01-01", None), (1, "2025-01-01", None), (2, None, "A")], "id bigint, published_at string, outlet_name string")
    feed = spark.createDataFrame([], "item_id bigint, published_at string, source_domain string, source_name string")
    gd = spark.createDataFrame([], "item_id bigint, published_at string")
    outlet = spark.createDataFrame([], "name string, website string, tz string, date_order string")
    assert all_instants(art, feed, gd, outlet).count() == 2
