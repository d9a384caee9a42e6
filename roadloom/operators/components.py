"""Connected components and density clusters as DataFrame algorithms."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import mercator
from ..runtime import persist_table
from .skew import salted_join


#: Edges (16 bytes each) up to this many are united in one task; more are contracted in rounds until they are few enough.
ONE_TASK_EDGES = 1_000_000


def union_find(edges: pa.Table) -> pa.Table:
    """(node, component) of edges (a, b) in one task; the smallest node is the root."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    for a, b in zip(edges["a"].to_pylist(), edges["b"].to_pylist()):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    nodes = sorted(root)
    return pa.table({"node": pa.array(nodes, pa.int64()), "component": pa.array([find(x) for x in nodes], pa.int64())})


def connected_components(edges: DataFrame, max_rounds: int = 60, one_task_edges: int = ONE_TASK_EDGES) -> DataFrame:
    """(node, component) of every node of edges (a, b); component is the smallest node of its component.

    Edges are counted first: up to one_task_edges of them go through a union-find in one task.  More are contracted by
    alternating large-star and small-star steps on the edge table: each round is a shuffle on the node, the number of rounds
    grows with the logarithm of the size, and every round is written to the shared folder, so lineage stays short.  Null
    ends are no nodes; an edge from a node to itself only names the node.  Raises if max_rounds are not enough.
    """
    e = persist_table(edges.where("a is not null and b is not null").select(F.greatest("a", "b").cast("bigint").alias("u"), F.least("a", "b").cast("bigint").alias("v")).distinct(), "cc")
    if e.count() <= one_task_edges:
        return e.select(F.col("u").alias("a"), F.col("v").alias("b")).groupBy(F.lit("all")).applyInArrow(union_find, "node bigint, component bigint")
    nodes = e.select(F.col("u").alias("node")).unionByName(e.select(F.col("v").alias("node"))).distinct()
    e = e.where("u <> v")
    mark = lambda t: tuple(t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    state = mark(e)
    for _ in range(max_rounds):
        # large star: every neighbour above a node meets the smallest of the node and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: the neighbours below a node and the node itself meet the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        e = persist_table(small, "cc")
        before, state = state, mark(e)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def planar_pairs(points: DataFrame, eps: float) -> DataFrame:
    """(a, b), a < b: points (id, x, y) at most eps apart in the plane, by a grid of cells of eps; crowded cells are split."""
    p = points.select("id", "x", "y", F.floor(F.col("x") / eps).alias("cx"), F.floor(F.col("y") / eps).alias("cy"))
    q = p.select(F.col("id").alias("id2"), F.col("x").alias("x2"), F.col("y").alias("y2"), F.explode(F.sequence(F.col("cx") - 1, F.col("cx") + 1)).alias("cx"), F.col("cy").alias("oy"))
    q = q.withColumn("cy", F.explode(F.sequence(F.col("oy") - 1, F.col("oy") + 1)))
    return salted_join(p, q, ["cx", "cy"]).where((F.col("id") < F.col("id2")) & _near(eps)).select(F.col("id").alias("a"), F.col("id2").alias("b"))


def _near(eps: float):
    dx, dy = F.col("x") - F.col("x2"), F.col("y") - F.col("y2")
    return dx * dx + dy * dy <= eps * eps


#: Parts of a cell's side by which pairs of cells are compared before any points are.
FINER = (8, 64)


def _sure_edges(sites: DataFrame, pairs: DataFrame | None, side: float, parts: int, eps: float) -> DataFrame:
    """(a, b, sure) of neighbouring cells, from their parts alone: sure if two parts lie within eps as a whole, absent if none can
    meet.  A cell has parts * parts parts at most, however many points it holds.  pairs (a, b): only these."""
    step = side / parts
    part = sites.select("cell", "cx", "cy", F.floor(F.col("x") / step).alias("px"), F.floor(F.col("y") / step).alias("py")).distinct()
    dx, dy = F.abs(F.col("px") - F.col("qx")), F.abs(F.col("py") - F.col("qy"))
    far = (dx + 1) * (dx + 1) + (dy + 1) * (dy + 1) <= (eps / step) ** 2 * (1 - 1e-9)
    gx, gy = F.greatest(dx - 1, F.lit(0)), F.greatest(dy - 1, F.lit(0))
    may = gx * gx + gy * gy <= (eps / step) ** 2 * (1 + 1e-9)
    other = part.select(F.col("cell").alias("b"), F.col("px").alias("qx"), F.col("py").alias("qy"), "cx", "cy")
    if pairs is None:
        ahead = [(i, j) for i in range(0, 3) for j in range(-2, 3) if (i, j) > (0, 0)]  # each pair of cells once
        at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ahead]))
        other = other.select("b", "qx", "qy", "cx", "cy", at.alias("s")).select("b", "qx", "qy", (F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"))
        j = part.withColumnRenamed("cell", "a").join(other, ["cx", "cy"])
    else:
        j = part.withColumnRenamed("cell", "a").join(pairs, "a").join(other.drop("cx", "cy"), "b")
    return j.where(may).groupBy("a", "b").agg(F.max(far).alias("sure"))


def _reach_components(raw: DataFrame, eps: float) -> DataFrame:
    """(id, cluster) of points (id, x, y) whose chains of steps of at most eps meet.

    Points of one cell of eps/sqrt(2) always meet, so a cell is one node of the graph, however many points it holds; two
    cells within reach are joined by an edge if some pair of their points is near enough.  Pairs of cells are decided by the
    parts of the cells that hold points, finer in each step, so a crowded cell counts by its parts; only pairs that are
    within a sixty-fourth of a cell of the limit are decided by points.
    """
    side = eps / math.sqrt(2) * (1 - 1e-9)
    p = persist_table(raw.select("id", "x", "y", F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy")), "points")
    cells = persist_table(p.groupBy("cx", "cy").agg(F.min("id").alias("cell")), "cells")
    sites = persist_table(p.select("x", "y", "cx", "cy").distinct().join(cells, ["cx", "cy"]), "sites")
    edges, open_pairs = cells.select(F.col("cell").alias("a"), F.col("cell").alias("b")), None
    for parts in FINER:
        met = persist_table(_sure_edges(sites, open_pairs, side, parts, eps), "cell-pairs")
        edges = edges.unionByName(met.where("sure").select("a", "b"))
        open_pairs = met.where("not sure").select("a", "b")
    ends = lambda c, i: sites.select(F.col("cell").alias(c), F.col("x").alias(f"x{i}"), F.col("y").alias(f"y{i}"))
    last = open_pairs.join(ends("a", ""), "a").join(ends("b", "2"), "b").where(_near(eps)).select("a", "b").distinct()
    label = connected_components(edges.unionByName(last)).select(F.col("node").alias("cell"), F.col("component").alias("cluster"))
    return p.select("id", "cx", "cy").join(cells, ["cx", "cy"]).join(label, "cell").select("id", "cluster")


def _core_sites(both: DataFrame, weight: DataFrame, min_points: int) -> DataFrame:
    around = both.join(weight.withColumnRenamed("site", "b"), "b").groupBy(F.col("a").alias("site")).agg(F.sum("n").alias("k"))
    return weight.join(around, "site", "left").where(F.col("n") + F.coalesce("k", F.lit(0)) >= min_points).select("site")


def dbscan(points: DataFrame, eps: float, min_points: int = 1) -> DataFrame:
    """(id, cluster) of points (id, lat, lon): density clusters in Web-Mercator units; cluster is its smallest core id.

    min_points counts the point itself; with 1 every point is a core point and whole cells are joined.  Border points join
    the lowest core label in reach, noise has a null cluster.  Points at one place are one site (weighted by their number),
    so a pile of reports on one pin makes no pairs.
    """
    x, y = mercator(F.col("lat"), F.col("lon"))
    raw = points.select("id", x.alias("x"), y.alias("y"))
    if min_points <= 1:
        return _reach_components(raw, eps)
    raw = persist_table(raw, "points")
    sites = persist_table(raw.groupBy("x", "y").agg(F.min("id").alias("site"), F.count(F.lit(1)).alias("n")), "sites")
    member = raw.join(sites.select("x", "y", "site"), ["x", "y"]).select("id", "site")
    pairs = persist_table(planar_pairs(sites.select(F.col("site").alias("id"), "x", "y"), eps), "near")
    weight = sites.select("site", "n")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    c = _core_sites(both, weight, min_points).select(F.col("site").alias("a"))
    inner = pairs.join(c, "a", "left_semi").join(c.withColumnRenamed("a", "b"), "b", "left_semi").select("a", "b")
    links = persist_table(inner.unionByName(c.select("a", F.col("a").alias("b"))), "links")
    label = connected_components(links).withColumnRenamed("node", "site").withColumnRenamed("component", "cluster")
    reach = both.join(label.withColumnRenamed("site", "b"), "b").groupBy(F.col("a").alias("site")).agg(F.min("cluster").alias("near_cluster"))
    label = weight.select("site").join(label, "site", "left").join(reach, "site", "left").select("site", F.coalesce("cluster", "near_cluster").alias("cluster"))
    return member.join(label, "site", "left").select("id", "cluster")
