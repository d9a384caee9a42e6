"""Defects, names, lookups, numbering, plug-ins and stream state on small cases, odd rows among them."""

import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadloom.operators import defects as D
from roadloom.operators.extensions import extend, looked_up
from roadloom.operators.geocoding import same_district, same_state
from roadloom.operators.hash_window import without_near
from roadloom.operators.lookup import cached, fresh_entries, misses
from roadloom.operators.names import mentioned, passes_keywords, site_mentions
from roadloom.operators.numbering import numbered
from roadloom.plans.registry import EPSILON_M, cluster_epsilon
from roadloom.runtime import shared_dir
from roadloom.sources.files import KeyedTable, folder_bytes, read_jsonl, write_jsonl


def test_defects_of_incidents(spark):
    links = spark.createDataFrame([(1, 10, 0.5), (1, 11, 0.9), (1, 12, None), (2, 12, None), (3, 13, 0.4)], "incident_id bigint, source_article_id bigint, match_confidence double")
    arts = spark.createDataFrame([(10, "A deep POTHOLE and no street light", 1), (11, "pothole", 1), (12, "a pothole, a crash barrier", 1), (13, None, 1)], "id bigint, clean_text string, defect_type int")
    best = {(r["incident_id"], r["defect_type"]): (r["confidence"], r["source_id"]) for r in D.best_claims(D.claims(links, arts)).collect()}
    pot, light, bar = "potholes_or_broken_surface", "no_street_lighting", "missing_crash_barrier_or_guardrail"
    assert best == {(1, pot): (0.9, 11), (1, light): (0.5, 10), (1, bar): (None, 12), (2, pot): (None, 12), (2, bar): (None, 12)}
    x = D.best_claims(D.claims(links, arts))
    members = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, None)], "id bigint, cluster bigint")
    tax = D.taxonomy(spark)
    assert [tuple(r) for r in D.severity(x, members, tax).collect()] == [(7, 4.5)]
    assert [tuple(r) for r in D.dominant(x, members, tax, 2).collect()] == [(7, [pot, bar])]
    rows = spark.createDataFrame([(1, "b", None), (1, "a", None), (1, "c", None), (1, "c", "x"), (2, None, None)], "k int, v string, w string")
    assert {tuple(r) for r in D.modes(rows, "k", ["v", "w"]).collect()} == {(1, "c", "x")}
    assert D.severity(x.limit(0), members, tax).count() == 0 and D.dominant(x.limit(0), members, tax).count() == 0


@pytest.mark.parametrize("at_once", [200_000, 0])
def test_names_in_texts(spark, at_once):
    texts = spark.createDataFrame([(1, "On NH-5 near Alpha and nh-55"), (2, None), (3, ""), (4, "x" * 50_000 + "Beta"), (4, "beta")], "id bigint, text string")
    names = spark.createDataFrame([("NH-5",), ("nh-5",), ("BETA",), (None,), ("",), ("gamma and a much longer name than any text here",)], "name string")
    assert sorted(tuple(r) for r in mentioned(texts, names, at_once).collect()) == [(1, "nh-5"), (4, "beta")]
    assert mentioned(texts, names.limit(0), at_once).count() == 0 and mentioned(texts.limit(0), names, at_once).count() == 0
    arts = spark.createDataFrame([(1, "Crash at Old Gate in Town", "D"), (2, "Crash at old gate", "East"), (3, "crash at Old Gate", None), (4, "elsewhere in Town", "East")], "id bigint, text string, district string")
    sites = spark.createDataFrame([(1, ["Old Gate", "Gate Old"], "Town", "East"), (2, ["Old Gate"], None, None), (3, ["Old Gate"], " ", "West")], "site_id bigint, variants array<string>, city string, district string")
    assert {tuple(r) for r in site_mentions(arts, sites, at_once).collect()} == {(1, 1), (1, 2), (2, 1), (2, 2), (2, 3)}
    kw = spark.createDataFrame([("ta", "crash", "விபத்து"), ("en", "injury", "crash"), ("en", "crash", "hit")], "language string, category string, term string")
    t = spark.createDataFrame([(1, "விபத்தில்"), (2, "crash"), (3, "He HIT it"), (4, "hi"), (5, None)], "id bigint, text string")
    assert {r["id"] for r in passes_keywords(t, kw, ["crash"], at_once).where("passes").collect()} == {1, 3}


def test_guards_know_other_names(spark):
    pairs = [("Nawada", "Gopalganj"), ("Aurangabad", "Chhatrapati Sambhajinagar"), ("Chhatrapati Sambhajinagar", "Aurangabad"), ("Bangalore", "Bengaluru Urban district"), ("", "X"), (None, "X"), ("Y", None), ("x dist.", "X")]
    got = [r[0] for r in spark.createDataFrame(pairs, "a string, b string").select(same_district(F.col("a"), F.col("b"))).collect()]
    assert got == [False, True, True, True, True, True, True, True]
    states = [("Orissa", "odisha"), ("Bihar", "Odisha"), (None, "Bihar")]
    assert [r[0] for r in spark.createDataFrame(states, "a string, b string").select(same_state(F.col("a"), F.col("b"))).collect()] == [True, False, True]
    assert cluster_epsilon(EPSILON_M) == 231 and cluster_epsilon({}) == 250


def test_cache_keeps_no_failures(spark):
    found = spark.createDataFrame([("a", "http://x"), ("a", "http://y"), ("b", None), ("c", "odd"), (None, "http://z")], "key string, url string")
    cache = fresh_entries(found, ["url"], F.startswith("url", F.lit("http")))
    assert {tuple(r) for r in cache.collect()} == {("a", "http://x")}
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "id int, key string")
    assert {(r["id"], r["url"], r["hit"]) for r in cached(asked, cache).collect()} == {(1, "http://x", True), (4, "http://x", True), (2, None, False), (3, None, False)}
    assert [r[0] for r in misses(asked, cache).collect()] == ["b"]


def test_plug_ins(spark):
    class Upper:
        reads = ["text"]
        gives = "label string, confidence double"

        def run(self, batch):
            t = batch.column(0).to_pylist()
            return pa.RecordBatch.from_arrays([pa.array([x.upper() if x else None for x in t]), pa.array([1.0 if x else None for x in t], pa.float64())], names=["label", "confidence"])

    class Short(Upper):
        def run(self, batch):
            return Upper.run(self, batch).slice(0, 0)

    df = spark.createDataFrame([(1, "a", "old"), (2, None, "old")], "id int, text string, label string")
    assert {(r["id"], r["label"], r["confidence"]) for r in extend(df, Upper()).collect()} == {(1, "A", 1.0), (2, None, None)}
    with pytest.raises(Exception, match="rows in"):
        extend(df, Short()).collect()
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, key string")
    cache = spark.createDataFrame([("a", "kept", 0.5)], "key string, label string, confidence double")
    out, new = looked_up(asked, cache, Upper())
    assert {(r["id"], r["label"]) for r in out.collect()} == {(1, "kept"), (3, "kept"), (2, "B")} and [tuple(r) for r in new.collect()] == [("b", "B", 1.0)]


def test_numbers_in_order(spark):
    df = spark.createDataFrame([(i * 7 % 101, "x") for i in range(101)], "v bigint, n string").repartition(7)
    got = numbered(df.select("v"), ["v"]).collect()
    assert sorted((r["n"], r["v"]) for r in got) == [(i + 1, i) for i in range(101)]
    assert numbered(df.select("v").limit(0), ["v"]).count() == 0


def test_rows_without_near_ones(spark):
    cols = "id bigint, district string, dedup_hash string"
    a = spark.createDataFrame([(1, "D", "00000000000000ff"), (2, "D", "ffffffff00000000"), (3, "E", "00000000000000ff"), (4, None, "00000000000000ff"), (5, "D", "zz"), (6, "D", "0000000000000f0f")], cols)
    b = spark.createDataFrame([(9, "D", "00000000000000fe"), (3, "E", "00000000000000ff"), (2, "D", "ffffffff00000000")], cols)
    assert {r["id"] for r in without_near(a, b).collect()} == {2, 3, 4, 5, 6}  # 1 is near 9; 2 and 3 only meet themselves


def test_lines_and_sizes(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "a\nb")], "a int, b string")
    write_jsonl(df, str(tmp_path / "l"))
    write_jsonl(df, str(tmp_path / "l"), append=True)
    assert sorted(((r["a"], r["b"]) for r in read_jsonl(spark, str(tmp_path / "l"), "a int, b string").collect()), key=str) == [(1, None), (1, None), (2, "a\nb"), (2, "a\nb")]
    assert read_jsonl(spark, str(tmp_path / "l"), "a int, b string").count() == 4 and folder_bytes(spark, str(tmp_path / "l")) > 40
    t = KeyedTable(spark, str(tmp_path / "t"), "k string, at timestamp", ["k"])
    now = datetime.datetime(2026, 1, 1)
    t.upsert(spark.createDataFrame([("a", now), ("a", now + datetime.timedelta(1))], "k string, at timestamp"))
    assert [r["k"] for r in t.read().collect()] == ["a"]


def test_no_scratch_on_one_machine_of_a_cluster(spark):
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "spark://head:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_dir(Session())
    assert shared_dir(spark)
