"""Clusters, merging, scores, lookups, evidence, keyed tables, feeds and streams on small cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from roadloom.functions.text import coerce_int, hamming, simhash, url_host
from roadloom.operators.components import connected_components, dbscan
from roadloom.operators.evidence import NO_DEFECT, mentions, valid_claims
from roadloom.operators.hash_window import near_duplicates
from roadloom.operators.geocoding import ladder
from roadloom.operators.merging import final_keepers, greedy_merges, merge_rounds, remap
from roadloom.operators.scoring import WEIGHTS, score_components, tier, total_score
from roadloom.sources.feeds import read_article_lists, read_rss
from roadloom.sources.files import KeyedTable, geojson_features, nested, read_csv, read_jsonl, read_keywords, read_nested_districts, write_csv_pack
from roadloom.sources.html import page_text
from roadloom.streaming.intake import event_stream, first_arrivals, run_to_table, windowed_counts


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 240)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    df = spark.createDataFrame([*edges, (None, 3)], "a bigint, b bigint")
    for bound in (1_000_000, 0):  # in one task, in rounds
        got = {r[0]: r[1] for r in connected_components(df, one_task_edges=bound).collect()}
        assert got == {x: find(x) for x in root}
    with pytest.raises(RuntimeError, match="did not settle"):
        connected_components(df, max_rounds=1, one_task_edges=0)
    assert connected_components(df.limit(0)).count() == 0


def test_dbscan_core_border_noise(spark):
    pts = [(1, 0.0, 10.0), (2, 0.0, 10.001), (3, 0.0, 10.002), (4, 0.0, 10.0039), (5, 5.0, 5.0), (6, 0.0, 10.0)]
    df = spark.createDataFrame(pts, "id bigint, lat double, lon double")
    assert {r[0]: r[1] for r in dbscan(df, 231.0).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 1}
    assert {r[0]: r[1] for r in dbscan(df, 231.0, min_points=3).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: None, 6: 1}


def test_reach_like_brute_force(spark):
    rng = random.Random(6)
    pts = [(i, 10 + rng.random() * 0.03, 20 + rng.random() * 0.03) for i in range(220)]
    pts += [(1000 + i, 10.01, 20.01) for i in range(40)]  # one pin
    import math

    xy = {i: (6378137.0 * math.radians(o), 6378137.0 * math.log(math.tan(math.pi / 4 + math.radians(a) / 2))) for i, a, o in pts}
    root = {i: i for i in xy}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in xy:
        for j in xy:
            if i < j and math.dist(xy[i], xy[j]) <= 231.0:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r[0]: r[1] for r in dbscan(spark.createDataFrame(pts, "id bigint, lat double, lon double"), 231.0).collect()}
    assert got == {i: find(i) for i in xy} and 5 < len(set(got.values())) < 200


def sequential(pairs):
    gone, out = set(), set()
    for k, m in sorted(pairs):
        if k not in gone and m not in gone:
            gone.add(m)
            out.add((k, m))
    return out


def test_greedy_merges_like_a_loop(spark):
    rng = random.Random(2)
    for _ in range(3):
        pairs = {(a, b) for a, b in ((rng.randrange(30), rng.randrange(30)) for _ in range(50)) if a != b}
        for bound in (200_000, 5):  # whole components, in rounds
            got = {tuple(r) for r in greedy_merges(spark.createDataFrame([*pairs, (1, None), (4, 4)], "keep bigint, merge bigint"), bound).collect()}
            assert got == sequential(pairs)


def test_rounds_are_not_a_closure(spark):
    # 1~2 and 2~3 but not 1~3: after 2 is merged into 1, 3 stays
    rows = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    near = spark.createDataFrame([(1, 2), (2, 3)], "keep bigint, merge bigint")

    def find(left):
        return near.join(left.withColumnRenamed("id", "keep"), "keep", "left_semi").join(left.withColumnRenamed("id", "merge"), "merge", "left_semi").select("keep", "merge")

    left, merges = merge_rounds(rows, find)
    assert sorted(r[0] for r in left.collect()) == [1, 3] and [tuple(r) for r in final_keepers(merges).collect()] == [(2, 1)]


def test_links_follow_chains_to_the_end(spark):
    # ten reports of one place whose confidence rises with the id: one pass merges each into the next
    rows = spark.createDataFrame([(i,) for i in range(10)], "id bigint")
    pairs = spark.createDataFrame([(b, a) for b in range(10) for a in range(b)], "keep bigint, merge bigint")

    def find(left):
        return pairs.join(left.withColumnRenamed("id", "keep"), "keep", "left_semi").join(left.withColumnRenamed("id", "merge"), "merge", "left_semi").select("keep", "merge")

    chain = spark.createDataFrame([(i + 1, i) for i in range(10)], "keep bigint, merge bigint")
    assert {tuple(r) for r in final_keepers(chain).collect()} == {(i, 10) for i in range(10)}
    left, merges = merge_rounds(rows, find)
    children = spark.createDataFrame([(i, 100 + i) for i in range(12)], "incident_id bigint, source bigint")
    alive = {r[0] for r in left.collect()}
    assert {r[0] for r in remap(children, merges, "incident_id").collect()} == alive | {10, 11}


def test_score_is_bounded_and_monotone(spark):
    raw = "id int, fatalities int, injuries int, inc_6mo int, days_since_last int, vulnerable_share double, max_severity double, n_sources int, avg_conf double"
    rows = [(0, None, None, None, None, None, None, None, None), (1, 100, 500, 50, 0, 1.0, 5.0, 20, 1.0), (2, 1, 0, 1, 10, 0.0, 1.0, 1, 0.5), (3, 2, 0, 1, 10, 0.0, 1.0, 1, 0.5), (4, 2, 0, 1, 90, 0.0, 1.0, 1, 0.5)]
    s = {r["id"]: r for r in total_score(score_components(spark.createDataFrame(rows, raw))).withColumn("tier", tier(F.col("score"))).collect()}
    assert s[0]["score"] == 0.0 and s[1]["score"] <= 100 and all(0 <= s[i][c] <= 1 for i in s for c in WEIGHTS)
    assert s[3]["score"] > s[2]["score"] and s[4]["score"] < s[3]["score"] and s[1]["tier"] == "critical" and s[0]["tier"] == "watch"


def test_ladder_guards_and_caps(spark):
    cols = "id int, location_text string, road_name string, admin_city string, admin_district string, admin_state string"
    rows = [(1, "crash at 27.5123, 78.0512 on NH", None, None, None, None), (2, None, "NH 5", None, "Alpha", "S"), (3, None, "NH 6", None, "Alpha", "S"), (4, "near Old Gate, Town", None, None, None, None), (5, None, "NH 7", None, "Beta district", "S"), (6, None, None, None, None, None), (7, None, "NH 8", None, "Alpha", "S")]
    gaz = [("nh 5, alpha, s", 20.0, 78.0, "S", "Alpha", 0.5), ("NH 6, Alpha, S", 20.0, 78.0, "Other", "Alpha", 0.5), ("alpha district, s", 21.0, 78.0, "S", "Alpha", 20.0), ("near Old Gate, Town", 22.0, 78.0, "S", "", 0.0), ("NH 7, Beta district, S", 23.0, 78.0, "S", "beta", 0.0), ("NH 8, Alpha, S", 24.0, 78.0, "", "Alpha", 0.0)]
    got = {r["id"]: r for r in ladder(spark.createDataFrame(rows, cols), spark.createDataFrame(gaz, "query string, lat double, lon double, state string, district string, span_km double")).collect()}
    assert (got[1]["method"], got[1]["confidence"]) == ("coords_in_text", 0.95)
    assert (got[2]["method"], got[2]["confidence"]) == ("road_city", 0.70)
    assert (got[3]["method"], got[3]["qualifier"]) == ("district_centroid", "wide_area") and got[3]["confidence"] == 0.40
    assert (got[4]["confidence"], got[4]["qualifier"]) == (0.5, "unanchored")
    assert got[5]["lat"] == 23.0 and got[6]["lat"] is None and (got[7]["confidence"], got[7]["qualifier"]) == (0.55, "stateless_hit")


def test_claims_need_quotes(spark):
    texts = spark.createDataFrame([(1, "The road  had\na deep POTHOLE."), (2, None)], "id int, text string")
    claims = [(1, "potholes", 0.6, "a deep pothole"), (1, "potholes", 0.9, "road had a deep"), (1, "signage", 0.9, "no signs"), (1, NO_DEFECT, 0.9, "road had"), (1, "lights", 0.9, " "), (2, "potholes", 0.9, "x"), (1, "markings", None, "The road")]
    got = {(r["doc_id"], r["code"], r["snippet"]) for r in valid_claims(spark.createDataFrame(claims, "doc_id int, code string, confidence double, snippet string"), texts).collect()}
    assert got == {(1, "potholes", "road had a deep"), (1, "markings", "The road")}


def test_text_functions(spark):
    r = spark.createDataFrame([("6d20e41c77ea5e12", "6d20e49d27ea5f1a", "6f20e49d67ea5f12")], "a string, b string, c string")
    x = r.select(hamming(F.col("a"), F.col("b")).alias("ab"), hamming(F.col("a"), F.col("c")).alias("bc"), hamming(F.col("a"), F.lit("")).alias("none"), url_host(F.lit("https://WWW.A.Example:8/x")).alias("h"), coerce_int(F.lit("2.0")).alias("two"), coerce_int(F.lit(" N/A ")).alias("na"), mentions(F.lit("விபத்தில்"), ["விபத்து"]).alias("stem")).first()
    assert (x["ab"], x["bc"], x["none"], x["h"], x["two"], x["na"], x["stem"]) == (6, 5, None, "a.example:8", 2, None, True)
    s = spark.createDataFrame([("a b c d e f",), ("a b c d e g",), ("quite another text of words",), ("",), (None,)], "t string").select(simhash(F.col("t")).alias("h")).collect()
    far = spark.createDataFrame([(s[0]["h"], s[1]["h"], s[2]["h"])], "a string, b string, c string").select(hamming(F.col("a"), F.col("b")).alias("n"), hamming(F.col("a"), F.col("c")).alias("f")).first()
    assert len(s[0]["h"]) == 16 and s[3]["h"] == "0" * 16 and s[4]["h"] is None and far["n"] < far["f"]


def test_locality_rule(spark):
    t = "2026-01-01 00:00:00"
    rows = [(1, "D", "S", t), (2, "D", "S", t), (3, None, "S", t), (4, None, None, t), (5, "E", "S", t), (6, "D", "S", "2026-02-01 00:00:00")]
    a = spark.createDataFrame([(i, d, s, x, "00000000000000ff") for i, d, s, x in rows], "id int, district string, state string, x string, dedup_hash string").withColumn("fetched_at", F.to_timestamp("x"))
    assert {tuple(r) for r in near_duplicates(a).collect()} == {(2, 1), (3, 1)}


def test_files(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"states": [{"state": "A", "districts": ["x", "y"]}, {"state": "B", "districts": []}]}))
    assert [tuple(r) for r in read_nested_districts(spark, str(tmp_path / "d.json")).collect()] == [("A", "x"), ("A", "y")]
    (tmp_path / "k.json").write_text(json.dumps({"languages": {"en": {"crash": ["a", "b"], "injury": ["c"]}}}))
    assert {tuple(r) for r in read_keywords(spark, str(tmp_path / "k.json"), ["crash", "injury"]).collect()} == {("en", "crash", "a", 0), ("en", "crash", "b", 1), ("en", "injury", "c", 0)}
    (tmp_path / "c.csv").write_text('name,n\n"a, ""b""",1\n')
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "c.csv"), "name string, n int").collect()] == [('a, "b"', 1)]
    (tmp_path / "l.jsonl").write_text('{"a": 1}\nbroken\n')
    assert [r[0] for r in read_jsonl(spark, str(tmp_path / "l.jsonl"), "a int").collect()] == [1, None]
    df = spark.createDataFrame([(1, 10.12345678, 20.0, ["p", "q"]), (2, None, 1.0, None)], "id int, lat double, lon double, tags array<string>")
    f = [json.loads(r[0]) for r in geojson_features(df).collect()]
    assert f == [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [20.0, 10.123457]}, "properties": {"id": 1, "tags": ["p", "q"]}}]
    write_csv_pack(df.select("id", "tags"), str(tmp_path / "pack"))
    assert {r["tags"] for r in spark.read.option("header", True).csv(str(tmp_path / "pack")).collect()} == {"p; q", None}
    kids = spark.createDataFrame([(1, 5), (1, 4)], "id int, v int")
    assert {r["id"]: [x["v"] for x in r["kids"]] for r in nested(df.select("id"), "id", kids=kids).collect()} == {1: [4, 5], 2: []}


def test_keyed_table(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), "k string, v int", ["k"])
    rows = spark.createDataFrame([("a", 2), ("a", 1), (None, 3)], "k string, v int")
    assert t.insert_if_absent(rows).count() == 2 and t.insert_if_absent(rows).count() == 0
    t.upsert(spark.createDataFrame([("a", 9), ("b", 1)], "k string, v int"))
    assert {tuple(r) for r in t.read().collect()} == {("a", 9), (None, 3), ("b", 1)}


def test_feed_sources(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<rss><channel><item><title>T</title><link>http://x</link><pubDate>Mon, 01 Sep 2025 00:00:00 GMT</pubDate><source url="https://www.s.example/p">S</source></item></channel></rss>')
    (tmp_path / "bad.xml").write_text("<rss>")
    (tmp_path / "a.json").write_text(json.dumps({"articles": [{"url": "u", "title": "t", "seendate": "20260101T000000Z", "domain": "d"}]}))
    rows = read_rss(spark, str(tmp_path)).drop("file").collect()
    assert [tuple(r) for r in rows if r["problem"] is None] == [(0, "http://x", "T", "Mon, 01 Sep 2025 00:00:00 GMT", "S", "s.example", None)]
    assert [r["file"].rsplit("/", 1)[1] for r in read_rss(spark, str(tmp_path)).where("problem is not null").collect()] == ["bad.xml"]
    assert [tuple(r) for r in read_article_lists(spark, str(tmp_path)).drop("file").collect()] == [(0, "u", "t", "20260101T000000Z", None, "d", None)]


def test_page_text(spark):
    pages = [("<html><head><title>x</title></head><body><p>a &amp; b</p><script>no</script><p>c</p></body></html>",), ('<script type="application/ld+json">{"articleBody": "a much longer body text"}</script><p>c</p>',), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(pages, "h string").select(page_text(F.col("h"))).collect()]
    assert got == ["a & b\nc", "a much longer body text", None, None]


def test_streams(spark, data):
    e = spark.read.parquet(f"{data}/events.parquet")
    got = run_to_table(windowed_counts(event_stream(spark, data, "events")))
    assert got.agg(F.sum("n")).first()[0] == e.count()
    feed = event_stream(spark, data, "feed_item").select("item_id", "url", "collected_at").where("url is not null")
    once = run_to_table(first_arrivals(feed, "url"), "append")
    assert once.count() == once.select("url").distinct().count() > 0
