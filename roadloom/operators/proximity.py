"""Points near other points, and the region that contains a point.

within_distance: equi-join on grid cells no smaller than the radius; one side stands in its home cell, the other is
copied to the cells its circle touches, and an exact great-circle test decides.  Cells that hold many points of either
side are split on both sides (skew.salted_join).

containing_region: polygons are triangulated by ear clipping, the triangles go into bounding-volume hierarchies, each
point descends the hierarchy and is tested exactly against the triangles of the leaves it reaches; a point on a shared
boundary belongs to the smallest region id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import home_cell, near_cells, sphere_distance_m, with_point
from ..runtime import persist_table
from .skew import salted_join

HOT_CELL = 2000
#: Up to this many triangles (64 bytes each) one hierarchy is sent to every executor; more are joined by tile.
BROADCAST_TRIANGLES = 200_000
TILE_DEG = 0.5
LEAF = 8


def located(df: DataFrame, id_col: str, geom_col: str) -> DataFrame:
    """(id, lat, lon) of each id with a location; rows repeated in full count once.

    Null, empty or unreadable geometry and the point 0 0 are no location.  Should an id stand with several locations,
    each of them counts.
    """
    p = with_point(df.select(F.col(id_col).cast("bigint").alias("id"), F.col(geom_col).alias("_g")), F.col("_g"))
    return p.where("id is not null and lat is not null").select("id", "lat", "lon").distinct()


def within_distance(a: DataFrame, b: DataFrame, radius_m: float) -> DataFrame:
    """(id_a, id_b, dist_m) of all pairs of a and b (id, lat, lon) at most radius_m apart.

    Empty inputs give no rows.  a stands in its home cells, b is copied; put the smaller table second.
    """
    x = a.select(F.col("id").alias("id_a"), F.col("lat").alias("lat_a"), F.col("lon").alias("lon_a"), home_cell(F.col("lat"), F.col("lon"), radius_m).alias("_c"))
    y = b.select(F.col("id").alias("id_b"), F.col("lat").alias("lat_b"), F.col("lon").alias("lon_b"), F.explode(near_cells(F.col("lat"), F.col("lon"), radius_m)).alias("_c"))
    d = sphere_distance_m(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
    return salted_join(x, y, ["_c"], HOT_CELL).select("id_a", "id_b", d.alias("dist_m")).where(F.col("dist_m") <= radius_m)


def near_pairs(points: DataFrame, radius_m: float) -> DataFrame:
    """(id_a, id_b), id_a < id_b: pairs of different ids of one table at most radius_m apart, each once."""
    p = within_distance(points, points, radius_m).where(F.col("id_a") < F.col("id_b"))
    return p.select("id_a", "id_b").distinct()


def near_counts(points: DataFrame, radius_m: float) -> DataFrame:
    """(id, place, n_near): per point (id, lat, lon) its place and the number of other points at most radius_m from it.

    place is the smallest id at the same coordinates.  Points of one place are one class, so a pile on a pin makes no pairs:
    places are compared with places and their sizes are summed.  An id with several locations has a row for each.
    """
    p = persist_table(points.select("id", "lat", "lon").distinct(), "points")
    place = persist_table(p.groupBy("lat", "lon").agg(F.min("id").alias("place"), F.count(F.lit(1)).alias("size")), "places")
    near = within_distance(*(place.select(F.col("place").alias("id"), "lat", "lon") for _ in range(2)), radius_m).select("id_a", "id_b").distinct()
    around = near.join(place.select(F.col("place").alias("id_b"), "size"), "id_b").groupBy(F.col("id_a").alias("place")).agg(F.sum("size").alias("_n"))
    own = place.select("lat", "lon", "place").join(around, "place")
    return p.join(own, ["lat", "lon"]).select("id", "place", (F.col("_n") - 1).alias("n_near"))


# --- triangles -----------------------------------------------------------------------------------------------------


_AREA = re.compile(r"\s*(?:SRID\s*=\s*\d+\s*;)?\s*(MULTI)?POLYGON\s*(?:ZM|Z|M)?\s*(EMPTY|\(.*\))\s*$", re.I | re.S)
_PART = re.compile(r"\s*([(),]|[-+\d.eE]+)")


def parse_area(wkt: str | None) -> list[list[np.ndarray]]:
    """Polygons of a POLYGON or MULTIPOLYGON text: each a list of rings, the outer one first.

    [] for null and blank text and EMPTY; any other text that is no such area raises ValueError.  White space, line breaks
    included, may stand between all parts; further coordinates of a corner are left out; rings of less than three
    different corners have no area and are dropped.
    """
    if not wkt or not wkt.strip():
        return []
    m = _AREA.match(wkt)
    if not m:
        raise ValueError("neither POLYGON nor MULTIPOLYGON")
    if m.group(2)[0] != "(":
        return []
    body, at = m.group(2), 0
    stack: list[list] = [[]]
    while at < len(body.rstrip()):
        t = _PART.match(body, at)
        if not t:
            raise ValueError(f"unreadable at {body[at:at + 20]!r}")
        at, x = t.end(), t.group(1)
        if x == "(":
            stack.append([[]])
        elif x == ",":
            stack[-1].append([])
        elif x == ")":
            if len(stack) < 2:
                raise ValueError("a bracket too many")
            done = stack.pop()
            stack[-1][-1:] = [done] if not stack[-1] or stack[-1][-1] == [] else [stack[-1][-1], done]
        else:
            stack[-1][-1].append(float(x))
    if len(stack) != 1:
        raise ValueError("a bracket too few")
    polys = stack[0][0] if m.group(1) else [stack[0][0]]
    out = []
    for p in polys:
        rings = []
        for r in p:
            if not all(isinstance(q, list) and len(q) >= 2 and all(isinstance(v, float) for v in q) for q in r):
                raise ValueError("a corner without two numbers")
            xy = np.array([q[:2] for q in r])
            xy = xy[:-1] if len(xy) > 1 and (xy[0] == xy[-1]).all() else xy
            xy = xy[(xy != np.roll(xy, 1, axis=0)).any(axis=1)]
            if len(xy) >= 3:
                rings.append(xy)
        if rings:
            out.append(rings)
    return out


def _area2(r: np.ndarray) -> float:
    n = np.roll(r, -1, axis=0)
    return float((r[:, 0] * n[:, 1] - n[:, 0] * r[:, 1]).sum())


def _cross(o, a, b) -> float:
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def _bridge(outer: list, hole: list) -> list:
    """The outer ring with a hole cut in by a two-way bridge between mutually visible corners."""
    hi = max(range(len(hole)), key=lambda i: hole[i])
    h = hole[hi]
    edges = [(p[i], p[(i + 1) % len(p)]) for p in (outer, hole) for i in range(len(p))]

    def seen(o) -> bool:
        for a, b in edges:
            if h in (a, b) or o in (a, b):
                continue
            if _cross(h, o, a) * _cross(h, o, b) <= 0 and _cross(a, b, h) * _cross(a, b, o) <= 0:
                return False
        return True

    order = sorted(range(len(outer)), key=lambda i: (outer[i][0] - h[0]) ** 2 + (outer[i][1] - h[1]) ** 2)
    oi = next((i for i in order if seen(outer[i])), None)
    if oi is None:
        raise ValueError("a hole that no corner of the outer ring sees")
    return outer[: oi + 1] + hole[hi:] + hole[: hi + 1] + outer[oi:]


def ear_clip(rings: list[np.ndarray]) -> list[tuple]:
    """Triangles of a polygon with holes; ValueError if they are not the whole of it (rings that cross themselves or each other)."""
    outer = [tuple(p) for p in (rings[0] if _area2(rings[0]) > 0 else rings[0][::-1])]
    holes = [[tuple(p) for p in (h if _area2(h) < 0 else h[::-1])] for h in rings[1:]]
    for h in sorted(holes, key=lambda q: -max(q)[0]):
        outer = _bridge(outer, h)
    idx, out = list(range(len(outer))), []
    while len(idx) > 3:
        best = None
        for k in range(len(idx)):
            a, b, c = (outer[idx[k - 1]], outer[idx[k]], outer[idx[(k + 1) % len(idx)]])
            turn = _cross(a, b, c)
            if turn <= 0:
                if turn == 0 and best is None:
                    best = (k, False)
                continue
            if any(q not in (a, b, c) and _cross(a, b, q) >= 0 and _cross(b, c, q) >= 0 and _cross(c, a, q) >= 0 for q in (outer[i] for i in idx)):
                continue
            best = (k, True)
            break
        if best is None:
            raise ValueError("no ear left: the rings cross")
        k, real = best
        if real:
            out.append((outer[idx[k - 1]], outer[idx[k]], outer[idx[(k + 1) % len(idx)]]))
        idx.pop(k)
    if len(idx) == 3 and _cross(*(outer[i] for i in idx)) > 0:
        out.append(tuple(outer[i] for i in idx))
    want = abs(_area2(rings[0])) - sum(abs(_area2(h)) for h in rings[1:])
    if abs(sum(_cross(*t) for t in out) - want) > 1e-9 * max(abs(want), abs(_area2(rings[0]))):
        raise ValueError("the triangles do not make up the area: the rings cross")
    return out


_TRI = "region_id bigint, x1 double, y1 double, x2 double, y2 double, x3 double, y3 double"


def triangles(areas: DataFrame, id_col: str, wkt_col: str) -> DataFrame:
    """One row for each triangle of each region; null, blank and EMPTY areas give none.

    A region that cannot be triangulated as a whole ends the job with its id; area_problems finds all such beforehand.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for rid, wkt in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    rows += [(rid, *t[0], *t[1], *t[2]) for rings in parse_area(wkt) for t in ear_clip(rings)]
                except ValueError as e:
                    raise ValueError(f"region {rid}: {e}") from e
            cols = list(zip(*rows)) if rows else [[] for _ in range(7)]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64())] + [pa.array(c, pa.float64()) for c in cols[1:]], names=["region_id", "x1", "y1", "x2", "y2", "x3", "y3"])

    return areas.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint"), F.col(wkt_col).cast("string")).mapInArrow(cut, _TRI)


def area_problems(areas: DataFrame, id_col: str = "region_id", wkt_col: str = "area_wkt") -> DataFrame:
    """(region_id, problem) of the regions that cannot be read or triangulated as a whole."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, said = [], []
            for rid, wkt in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    for rings in parse_area(wkt):
                        ear_clip(rings)
                except ValueError as e:
                    ids.append(rid)
                    said.append(str(e))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(said, pa.string())], names=["region_id", "problem"])

    return areas.select(F.col(id_col).cast("bigint"), F.col(wkt_col).cast("string")).mapInArrow(look, "region_id bigint, problem string")


class Hierarchy:
    """Bounding-volume hierarchy over triangles: array-backed median splits, queried with whole batches of points."""

    def __init__(self, region: np.ndarray, tri: np.ndarray):
        self.region, self.tri = region, tri  # (n), (n, 3, 2)
        lo, hi = (tri.min(axis=1), tri.max(axis=1)) if len(tri) else (np.zeros((0, 2)), np.zeros((0, 2)))
        mid = (lo + hi) / 2
        self.nodes: list[tuple] = []  # (box, left, right, members)

        def build(m: np.ndarray) -> int:
            at = len(self.nodes)
            self.nodes.append(())
            box = (*lo[m].min(axis=0), *hi[m].max(axis=0))
            if len(m) <= LEAF:
                self.nodes[at] = (box, -1, -1, m)
            else:
                axis = int(np.argmax(mid[m].max(axis=0) - mid[m].min(axis=0)))
                m = m[np.argsort(mid[m, axis], kind="stable")]
                left, right = build(m[: len(m) // 2]), build(m[len(m) // 2 :])
                self.nodes[at] = (box, left, right, None)
            return at

        if len(tri):
            build(np.arange(len(tri)))

    def locate(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The smallest region id that holds each point, -1 where none does."""
        best = np.full(len(x), np.iinfo(np.int64).max)
        stack = [(0, np.arange(len(x)))] if self.nodes else []
        while stack:
            at, pts = stack.pop()
            (x0, y0, x1, y1), left, right, members = self.nodes[at]
            pts = pts[(x[pts] >= x0) & (x[pts] <= x1) & (y[pts] >= y0) & (y[pts] <= y1)]
            if not len(pts):
                continue
            if members is None:
                stack += [(left, pts), (right, pts)]
                continue
            for t in members:
                (ax, ay), (bx, by), (cx, cy) = self.tri[t]
                px, py = x[pts], y[pts]
                inside = ((bx - ax) * (py - ay) - (by - ay) * (px - ax) >= 0) & ((cx - bx) * (py - by) - (cy - by) * (px - bx) >= 0) & ((ax - cx) * (py - cy) - (ay - cy) * (px - cx) >= 0)
                hit = pts[inside]
                best[hit] = np.minimum(best[hit], self.region[t])
        return np.where(best == np.iinfo(np.int64).max, -1, best)


def _hierarchy(rows: np.ndarray, ids: np.ndarray) -> Hierarchy:
    return Hierarchy(ids, rows.reshape(-1, 3, 2))


def containing_region(points: DataFrame, areas: DataFrame, id_col: str = "region_id", wkt_col: str = "area_wkt", broadcast_triangles: int = BROADCAST_TRIANGLES) -> DataFrame:
    """(id, region_id) of each point (id, lat, lon) that lies in a region; points in none give no row.

    The triangles are written and counted first.  Up to broadcast_triangles of them one hierarchy goes to every executor and the
    points are not shuffled; beyond, triangles are copied to the tiles they touch, points to their tile (spread over
    salts where a tile is crowded), and each tile builds its own hierarchy.
    """
    tri = persist_table(triangles(areas, id_col, wkt_col), "triangles")
    cols = ["x1", "y1", "x2", "y2", "x3", "y3"]
    spark = points.sparkSession
    if tri.count() <= broadcast_triangles:
        head = tri.collect()
        data = np.array([[r[c] for c in cols] for r in head], dtype=float).reshape(-1, 6)
        ids = np.array([r["region_id"] for r in head], dtype=np.int64)
        shared = spark.sparkContext.broadcast((data, ids))

        def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree = None
            for b in batches:
                tree = tree or _hierarchy(*shared.value)
                r = tree.locate(b.column(2).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False))
                keep = pa.array(r >= 0)
                yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), pa.array(r[r >= 0], pa.int64())], names=["id", "region_id"])

        return points.select("id", "lat", "lon").mapInArrow(locate, "id bigint, region_id bigint").distinct()
    tile = lambda c: F.floor(F.col(c) / TILE_DEG)
    span = lambda a: F.sequence(F.floor(F.least(*[F.col(f"{a}{i}") for i in (1, 2, 3)]) / TILE_DEG), F.floor(F.greatest(*[F.col(f"{a}{i}") for i in (1, 2, 3)]) / TILE_DEG))
    pts = points.select("id", "lat", "lon", tile("lon").alias("tx"), tile("lat").alias("ty"))
    crowd = pts.groupBy("tx", "ty").agg(F.ceil(F.count(F.lit(1)) / 500_000).cast("int").alias("_parts"))
    pts = pts.join(crowd, ["tx", "ty"]).withColumn("_s", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int"))
    cut = tri.withColumn("tx", F.explode(span("x"))).withColumn("ty", F.explode(span("y"))).join(crowd.withColumnRenamed("_parts", "_copies"), ["tx", "ty"]).withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))

    def in_tile(left: pa.Table, right: pa.Table) -> pa.Table:
        data = np.column_stack([right.column(c).to_numpy() for c in cols]) if right.num_rows else np.zeros((0, 6))
        tree = _hierarchy(data, right.column("region_id").to_numpy() if right.num_rows else np.zeros(0, np.int64))
        r = tree.locate(left.column("lon").to_numpy(), left.column("lat").to_numpy()) if left.num_rows else np.zeros(0, np.int64)
        return pa.table({"id": left.column("id").filter(pa.array(r >= 0)), "region_id": pa.array(r[r >= 0], pa.int64())})

    keys = ["tx", "ty", "_s"]
    return pts.groupBy(*keys).cogroup(cut.groupBy(*keys)).applyInArrow(in_tile, "id bigint, region_id bigint").distinct()


def neighbourhood(incident: DataFrame, hotspot: DataFrame, areas: DataFrame, radius_m: float = 300.0) -> DataFrame:
    """(kind, key_a, key_b), smaller key first: near incidents, near hotspots, and the district around each incident."""
    inc = persist_table(located(incident, "id", "geom"), "located")
    spots = persist_table(located(hotspot, "id", "centroid_geom"), "located")
    pair = lambda df, kind, a, b: df.select(F.lit(kind).alias("kind"), F.least(a, b).alias("key_a"), F.greatest(a, b).alias("key_b"))
    parts = [
        pair(near_pairs(inc, radius_m), "incident", "id_a", "id_b"),
        pair(within_distance(inc, spots, radius_m).select("id_a", "id_b").distinct(), "hotspot", "id_a", "id_b"),
        pair(containing_region(inc, areas), "district", "id", "region_id"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
