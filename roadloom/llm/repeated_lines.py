"""Lines that a source prints in many of its documents.

Lines are equal if their letters and combining marks are.  Per source the lines form a graph: nodes weighted by the number
of documents that hold them, edges between consecutive lines weighted likewise.  Nodes and edges of high support stay,
connected components of them are boilerplate blocks, and every occurrence of a block's line is deleted.

A source has at most (lines per document) / (share) nodes of high support, whatever its number of documents, so the
components of one source fit one task; counting is done in partial aggregates on (source, line) beforehand.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import persist_table

LEAST_DOCS = 5
LEAST_SHARE_PERCENT = 6


def line_key(line: Column) -> Column:
    """Letters with their combining marks, in lower case: '' for a line without letters or marks."""
    return F.lower(F.regexp_replace(line, r"[^\p{L}\p{M}]+", ""))


def _hash(key: Column) -> Column:
    """96 bits: equal lines meet, others practically never do."""
    return F.struct(F.xxhash64(key).alias("a"), F.hash(key).alias("b"))


def keyed_lines(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """(id, th, src, line_no, seq, h): lines with letters, numbered from 1 in the text and by seq among themselves; th tells the
    texts of one id apart.

    Null texts, null or blank sources, empty lines and lines without letters give no rows.
    """
    d = docs.where(F.col(text_col).isNotNull() & (F.trim(F.col(source_col)) != "")).select(F.col(id_col).alias("id"), _hash(F.col(text_col)).alias("th"), F.col(source_col).alias("src"), F.split(text_col, "\n").alias("_l"))
    keys = F.transform("_l", lambda x, i: F.struct((i + 1).alias("line_no"), line_key(x).alias("k")))
    kept = F.filter(keys, lambda s: s["k"].rlike(r"\p{L}"))
    d = d.select("id", "th", "src", F.posexplode(kept).alias("seq", "s"))
    return d.select("id", "th", "src", F.col("s.line_no").alias("line_no"), "seq", _hash(F.col("s.k")).alias("h"))


def _components(nodes: pa.Table) -> pa.Table:
    """Union-find over one source's nodes; each node's row lists its high-support successors."""
    src, h = nodes.column("src"), [(x["a"], x["b"]) for x in nodes.column("h").to_pylist()]
    at = {x: i for i, x in enumerate(h)}
    root = list(range(len(h)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, nexts in enumerate(nodes.column("nexts").to_pylist()):
        for n in nexts or []:
            j = at.get((n["a"], n["b"]))
            if j is not None:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least: dict[int, tuple] = {}
    for i, x in enumerate(h):
        r = find(i)
        least[r] = min(least.get(r, x), x)
    block = [least[find(i)][0] for i in range(len(h))]
    return pa.table({"src": src, "h": nodes.column("h"), "support": nodes.column("support"), "block": pa.array(block, pa.int64())})


def blocks(lines: DataFrame, docs_per_source: DataFrame, least_docs: int = LEAST_DOCS, least_percent: int = LEAST_SHARE_PERCENT) -> DataFrame:
    """(src, h, support, block): the lines of high support and the boilerplate block each belongs to."""
    once = lines.select("src", "id", "h").distinct()
    support = once.groupBy("src", "h").agg(F.count(F.lit(1)).alias("support"))
    high = support.where(F.col("support") >= least_docs).join(docs_per_source, "src").where(F.col("support") * 100 >= F.col("n_docs") * least_percent)
    high = persist_table(high.select("src", "h", "support", "n_docs"), "repeated-lines")
    inside = lines.join(high.select("src", "h", "n_docs"), ["src", "h"])
    by_doc = Window.partitionBy("src", "id", "th").orderBy("seq")
    step = inside.select("src", "id", "n_docs", "h", F.lead("h").over(by_doc).alias("next"), (F.lead("seq").over(by_doc) - F.col("seq")).alias("gap")).where("gap = 1")
    edges = step.select("src", "n_docs", "id", "h", "next").distinct().groupBy("src", "n_docs", "h", "next").agg(F.count(F.lit(1)).alias("e"))
    edges = edges.where((F.col("e") >= least_docs) & (F.col("e") * 100 >= F.col("n_docs") * least_percent)).groupBy("src", "h").agg(F.collect_list("next").alias("nexts"))
    nodes = high.select("src", "h", "support").join(edges, ["src", "h"], "left")
    return nodes.groupBy("src").applyInArrow(_components, "src string, h struct<a bigint, b int>, support bigint, block bigint")


def repeated(docs: DataFrame, id_col: str = "id", source_col: str = "outlet_name", text_col: str = "clean_text") -> tuple[DataFrame, DataFrame]:
    """(occurrences, blocks): occurrences (id, th, line_no, src, block) of the lines of boilerplate blocks.

    Repeated rows of one id are one document; two different texts under one id both count towards its lines.
    """
    lines = persist_table(keyed_lines(docs, id_col, source_col, text_col), "keyed-lines")
    per = docs.where(F.col(text_col).isNotNull() & (F.trim(F.col(source_col)) != "")).select(F.col(source_col).alias("src"), F.col(id_col).alias("id")).distinct().groupBy("src").agg(F.count(F.lit(1)).alias("n_docs"))
    b = persist_table(blocks(lines, per), "line-blocks")
    return lines.join(b.select("src", "h", "block"), ["src", "h"]).select("id", "th", "line_no", "src", "block").distinct(), b


def without_repeated(docs: DataFrame, id_col: str = "id", source_col: str = "outlet_name", text_col: str = "clean_text") -> DataFrame:
    """(id, text, removed): each text without the lines its source repeats; null texts stay null.

    Lines are cut out of the very text they were found in, also where one id has several texts or sources.
    """
    found, _ = repeated(docs, id_col, source_col, text_col)
    cut = found.groupBy("id", "th", "src").agg(F.collect_set("line_no").alias("_cut"))
    j = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_t"), _hash(F.col(text_col)).alias("th"), F.col(source_col).alias("src")).join(cut, ["id", "th", "src"], "left")
    kept = F.filter(F.split("_t", "\n"), lambda x, i: ~F.array_contains(F.col("_cut"), i + 1))
    return j.select("id", F.when(F.col("_cut").isNull(), F.col("_t")).otherwise(F.array_join(kept, "\n")).alias("text"), F.coalesce(F.size("_cut"), F.lit(0)).alias("removed"))
