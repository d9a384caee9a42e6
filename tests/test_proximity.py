"""Distances and regions against brute force, poles and the antimeridian included."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom.functions.geometry import with_point
from roadloom.operators import proximity as P
from roadloom.operators.skew import salted_join


def hav(a, b):
    la1, lo1, la2, lo2 = map(math.radians, (*a, *b))
    x = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * 6371008.8 * math.asin(min(1, math.sqrt(x)))


def test_point_notations(spark):
    cases = {
        "SRID=4326;POINT(74.3 11.4)": (74.3, 11.4), "srid=4326; Point( 74.3   11.4 )": (74.3, 11.4), "POINT (74.3 11.4)": (74.3, 11.4), "11.4, 74.3": (74.3, 11.4),
        "0101000020E6100000BDE5EAC7265856404A1AED026F5E3140": (89.377367, 17.368881), "0020000001000010E6405401024C0A9A8E403155B95D843F95": (80.015759, 17.334860),
        "POINT EMPTY": None, "": None, "POINT (0 0)": None, "POINT (200 10)": None, "nonsense": None, "0101": None,
    }
    df = spark.createDataFrame([(k, 0.0, "x") for k in [*cases, None]], "g string, lat double, _pt_n string")
    for r in with_point(df.drop("_pt_n"), F.col("g")).collect():
        want = cases.get(r["g"])
        assert (r["lat"] is None) == (want is None) == (r["lon"] is None), r
        if want:
            assert abs(r["lon"] - want[0]) < 1e-5 and abs(r["lat"] - want[1]) < 1e-5


def test_pairs_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(P, "HOT_CELL", 5)  # every crowded cell is salted
    rng = random.Random(4)
    spots = [(0.0, 0.0), (20.0, 77.0), (89.9985, 10.0), (-89.999, 170.0), (10.0, 179.9995), (45.0, -179.9995), (60.0, 5.0)]
    pts = []
    for la, lo in spots:
        for _ in range(25):
            a, o = la + rng.uniform(-0.004, 0.004), lo + rng.uniform(-0.004, 0.004) / max(0.01, math.cos(math.radians(la)))
            pts.append((float(max(-90.0, min(90.0, a))), (o + 180) % 360 - 180))
    pts += [pts[0]] * 6
    df = spark.createDataFrame([(i, a, o) for i, (a, o) in enumerate(pts)], "id bigint, lat double, lon double")
    got = {(r[0], r[1]) for r in P.near_pairs(df, 300.0).collect()}
    want = {(i, j) for i in range(len(pts)) for j in range(i + 1, len(pts)) if hav(pts[i], pts[j]) <= 300}
    assert got == want and len(want) > 100


AREAS = [
    (1, "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (3 3, 3 7, 7 7, 7 3, 3 3))"),
    (2, "MULTIPOLYGON (((3 3, 7 3, 7 7, 3 7, 3 3)), ((20 0, 25 0, 22 3, 25 6, 20 6, 20 0)))"),
    (3, "POLYGON ((10 0, 12 0, 12 10, 10 10, 10 0))"),
    (4, None), (5, ""), (6, "POLYGON EMPTY"),
]


def even_odd(x, y, wkt):
    inside = False
    for rings in P.parse_area(wkt):
        for r in rings:
            for (x1, y1), (x2, y2) in zip(r, np.roll(r, -1, axis=0)):
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    inside = not inside
    return inside


def test_regions_like_even_odd(spark):
    rng = random.Random(5)
    pts = [(i, rng.uniform(-1, 11), rng.uniform(-1, 26)) for i in range(600)]
    df = spark.createDataFrame(pts, "id bigint, lat double, lon double")
    areas = spark.createDataFrame(AREAS, "region_id bigint, area_wkt string")
    want = {(i, r) for i, la, lo in pts for r, w in AREAS if w and even_odd(lo, la, w)}
    for limit in (P.BROADCAST_TRIANGLES, 0):
        assert {tuple(r) for r in P.containing_region(df, areas, broadcast_triangles=limit).collect()} == want


def test_shared_border_goes_to_the_smaller_region(spark):
    df = spark.createDataFrame([(1, 5.0, 10.0)], "id bigint, lat double, lon double")
    areas = spark.createDataFrame(AREAS, "region_id bigint, area_wkt string")
    assert [tuple(r) for r in P.containing_region(df, areas).collect()] == [(1, 1)]


def test_triangles_keep_the_area():
    for _, w in AREAS[:3]:
        area = sum(abs(P._area2(r[0])) - sum(abs(P._area2(h)) for h in r[1:]) for r in P.parse_area(w))
        tri = sum(abs(P._cross(*t)) for r in P.parse_area(w) for t in P.ear_clip(r))
        assert abs(area - tri) < 1e-9


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id bigint, lat double, lon double")
    inc = spark.createDataFrame([], "id bigint, geom string")
    hot = spark.createDataFrame([], "id bigint, centroid_geom string")
    areas = spark.createDataFrame([], "region_id bigint, area_wkt string")
    assert P.near_pairs(none, 300.0).count() == 0
    assert P.neighbourhood(inc, hot, areas).count() == 0


def test_areas_are_read_whole_or_refused(spark):
    hole = "POLYGON((0 0, 4 0,\n 4 4, 0 4,\n0 0),\n(1 1, 2 1, 2 2, 1 2, 1 1))"
    assert [[len(r) for r in p] for p in P.parse_area(hole)] == [[4, 4]] and len(P.ear_clip(P.parse_area(hole)[0])) == 8
    assert P.parse_area(None) == P.parse_area(" ") == P.parse_area("POLYGON EMPTY") == []
    bad = {1: "POLYGON((0 0,2 2,2 0,0 2,0 0))", 2: "POINT(1 1)", 3: "POLYGON((0 0,3 0,3 3,0 3,0 0),(1 1,5 1,5 2,1 2,1 1))", 4: "POLYGON((0 0,1 x,2 2,0 0))", 5: "POLYGON((0 0, 1 1, 2 0)"}
    df = spark.createDataFrame([(0, hole, 1), *((k, v, 1) for k, v in bad.items()), (9, None, 1)], "region_id bigint, area_wkt string, problem int")
    assert {r["region_id"] for r in P.area_problems(df).collect()} == set(bad)
    with pytest.raises(Exception, match="region 1"):
        P.triangles(df.where("region_id = 1"), "region_id", "area_wkt").collect()


def test_piles_beside_sparse_cells(spark):
    """A pin with many reports beside sparse cells: the same counts as by pairs, tasks split on both sides."""
    rng = random.Random(4)
    rows = [(i, 20.0, 75.0) for i in range(700)] + [(1000 + i, 20.0 + rng.uniform(-0.01, 0.01), 75.0 + rng.uniform(-0.01, 0.01)) for i in range(300)]
    p = spark.createDataFrame(rows, "id bigint, lat double, lon double")
    x = spark.createDataFrame([(r[0], r[0] % 3) for r in rows], "id bigint, k bigint")
    got = salted_join(x, x.withColumnRenamed("id", "id2"), ["k"], 50)
    assert got.count() == sum(sum(1 for r in rows if r[0] % 3 == k) ** 2 for k in range(3)) == got.distinct().count()
    pairs = P.near_pairs(p, 300.0).collect()
    want = dict.fromkeys((r[0] for r in rows), 0)
    for r in pairs:
        want[r["id_a"]] += 1
        want[r["id_b"]] += 1
    counts = P.near_counts(p, 300.0).collect()
    assert {r["id"]: r["n_near"] for r in counts} == want and {r["place"] for r in counts if r["id"] < 700} == {0}
