"""Merging reports of one event, in rounds, and the rewriting of what points to them."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import persist_table
from .components import connected_components


#: Pairs of one component (16 bytes each) that are put in order in one task; larger components go in rounds.
COMPONENT_PAIRS = 200_000


def _in_order(pairs: pa.Table) -> pa.Table:
    """The executed pairs of one component, by the sequential pass."""
    gone: set[int] = set()
    out = []
    for keep, merge in sorted(zip(pairs["keep"].to_pylist(), pairs["merge"].to_pylist())):
        if keep not in gone and merge not in gone:
            gone.add(merge)
            out.append((keep, merge))
    return pa.table({"keep": pa.array([k for k, _ in out], pa.int64()), "merge": pa.array([m for _, m in out], pa.int64())})


def greedy_merges(pairs: DataFrame, component_pairs: int = COMPONENT_PAIRS) -> DataFrame:
    """(keep, merge): the pairs that a pass in order of (keep, merge) executes, skipping pairs with an id merged before.

    Up to component_pairs pairs are passed through in one task.  Of more, pairs of different components do not depend on each
    other, so each component is passed through in a task of its own.
    A component of more than component_pairs pairs is decided in rounds instead: a pair once no earlier open pair can still
    merge one of its ids away.  Both ways give the same pairs; null ids and pairs of an id with itself are left out.
    """
    p = persist_table(pairs.select(F.col("keep").cast("bigint"), F.col("merge").cast("bigint")).where("keep <> merge").distinct(), "pairs")
    if p.count() <= component_pairs:
        return persist_table(p.groupBy(F.lit("all")).applyInArrow(_in_order, "keep bigint, merge bigint"), "merges")
    label = connected_components(p.select(F.col("keep").alias("a"), F.col("merge").alias("b"))).select(F.col("node").alias("keep"), "component")
    p = persist_table(p.join(label, "keep"), "pairs")
    large = p.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > component_pairs).select("component")
    small = p.join(large, "component", "left_anti").select("component", "keep", "merge")
    done = persist_table(small.groupBy("component").applyInArrow(_in_order, "keep bigint, merge bigint"), "merges")
    left = persist_table(p.join(large, "component", "left_semi").select("keep", "merge"), "pairs")
    order = F.struct("keep", "merge")
    while left.limit(1).count():
        first = left.groupBy(F.col("merge").alias("x")).agg(F.min(order).alias("first"))
        q = left.join(first.withColumnsRenamed({"x": "keep", "first": "fk"}), "keep", "left").join(first.withColumnsRenamed({"x": "merge", "first": "fm"}), "merge")
        go = q.where((F.col("fm") == order) & (F.col("fk").isNull() | (F.col("fk") > order))).select("keep", "merge")
        go = persist_table(go, "merges")
        gone = go.select(F.col("merge").alias("x"))
        left = left.join(gone.withColumnRenamed("x", "keep"), "keep", "left_anti").join(gone.withColumnRenamed("x", "merge"), "merge", "left_anti")
        left = persist_table(left.select("keep", "merge"), "pairs")
        done = done.unionByName(go)
    return done


def merge_rounds(rows: DataFrame, find_pairs: Callable[[DataFrame], DataFrame], id_col: str = "id", max_rounds: int = 4) -> tuple[DataFrame, DataFrame]:
    """(rows left, (keep, merge) of all rounds).  Pairs are found again each round among the rows left; a kept row's own
    attributes do not change, so this is not the transitive closure of the first pairs."""
    all_merges = None
    for _ in range(max_rounds):
        merges = persist_table(greedy_merges(find_pairs(rows)), "round")
        if not merges.limit(1).count():
            break
        rows = persist_table(rows.join(merges.select(F.col("merge").alias(id_col)), id_col, "left_anti"), "rows")
        all_merges = merges if all_merges is None else all_merges.unionByName(merges)
    if all_merges is None:
        all_merges = rows.sparkSession.createDataFrame([], "keep bigint, merge bigint")
    return rows, all_merges


def final_keepers(merges: DataFrame) -> DataFrame:
    """(merge, keep): each merged id with the id that is left in the end.

    A keeper may be merged later, in the same round too, so chains have any length.  Each step jumps from the keeper to its
    keeper's keeper and halves the chains, until none is left to follow; every step is written to the shared folder.
    """
    m = persist_table(merges.select("merge", "keep"), "keepers")
    for _ in range(64):  # chains of 2**64; merges that go in a circle never end
        nxt = m.select(F.col("merge").alias("keep"), F.col("keep").alias("_next"))
        if not m.join(nxt, "keep", "left_semi").limit(1).count():
            return m
        m = persist_table(m.join(nxt, "keep", "left").select("merge", F.coalesce("_next", "keep").alias("keep")), "keepers")
    raise ValueError("merges go in a circle")


def remap(children: DataFrame, merges: DataFrame, ref: str) -> DataFrame:
    """children with ref pointing to the id that is left."""
    k = final_keepers(merges).select(F.col("merge").alias(ref), F.col("keep").alias("_keep"))
    return children.join(k, ref, "left").withColumn(ref, F.coalesce("_keep", ref)).drop("_keep").select(*children.columns)
