"""A mixture of sources at target shares.

Sizes are tokens.  Of a source with n tokens and at most m repeats, at most n*m tokens can be used.  The budget of each
source is its share of the total, cut at that limit and given to the others in proportion to their shares (water
filling).  NAMED as total is the tokens of the named sources, so that as much as they hold is chosen and what a capped
source cannot give is repeated from the others.  Without a wanted total the largest total is used at which no limit cuts a
share: the shares are exact up to the size of one document, but the source with the least room sizes everything.

Within a source all complete epochs come first (every document once per epoch); the rest is an Efraimidis-Spirakis sample:
documents in order of -ln(u)/w, w their quality weight and u a hash of their id, taken while the running sum of tokens
stays within the rest; the document in which the rest ends is taken if more than half of it fits.  The running sum never gathers a source in one task: a histogram over the key decides every bin but
the one in which the budget ends, and only that bin is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import persist_table
from .tokens import VOCABULARY, encode

BINS = 4096
FULL_WEIGHT_TOKENS = 64
#: As total_tokens: all tokens of the sources with a share and a document that may be used.
NAMED = "named"


def sizes(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens, key): the size of each document and its sampling key; null text has size 0."""
    d = docs.select("doc_id", "source", "text", F.length(F.regexp_replace("text", r"[^\p{L}\p{M}]", "")).alias("_l"), F.length("text").alias("_c"))
    counted = encode(d.select(F.struct("doc_id", "source", "_l", "_c").alias("k"), "text"), "k", "text", vocabulary, counts_only=True)
    # quality weight in (0, 1]: the share of letters and combining marks, damped for very short texts
    w = F.greatest(F.lit(0.05), F.coalesce(F.col("k._l") / F.greatest(F.col("k._c"), F.lit(1)), F.lit(0.0)) * F.least(F.lit(1.0), F.col("n_tokens") / F.lit(float(FULL_WEIGHT_TOKENS))))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit("mixture"), F.col("k.doc_id")), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return counted.select("k.doc_id", "k.source", "n_tokens", (-F.log(u) / w).alias("key"))


def budgets(per_source: DataFrame, target: DataFrame, total_tokens: int | str | None = None) -> DataFrame:
    """(source, target_share, max_repeats, n_docs, tokens, budget) of every named source, 0 where it has no documents.

    Repeated rows of a source in target count once (largest share); shares that are null or not positive count as 0.
    The sources are the rows of a small table: their number does not grow with the documents.
    """
    t = target.where(F.col("source").isNotNull()).groupBy("source").agg(F.max(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("max_repeats"))
    j = t.join(per_source, "source", "left").fillna(0, ["n_docs", "tokens"]).withColumn("most", (F.col("tokens") * F.col("max_repeats")).cast("double"))
    # the total at which source i is just cut, sources in order of most/share: what is cut before it, plus the rest of the shares
    j = j.withColumn("_r", F.when((F.col("target_share") > 0) & (F.col("most") > 0), F.col("most") / F.col("target_share")))
    live = F.col("_r").isNotNull()
    by_ratio = Window.orderBy(F.col("_r").asc_nulls_last(), "source")
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    j = j.withColumn("_cut", F.coalesce(F.sum(F.when(live, F.col("most"))).over(before), F.lit(0.0)))
    j = j.withColumn("_rest", F.sum(F.when(live, F.col("target_share"))).over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    if total_tokens == NAMED:
        wanted = F.sum(F.when(live, F.col("tokens")).otherwise(0)).over(everything).cast("double")
    elif total_tokens is not None:
        wanted = F.lit(float(total_tokens))
    else:
        wanted = F.min(F.when(live, F.col("_r"))).over(everything) * F.sum(F.when(live, F.col("target_share"))).over(everything)
    j = j.withColumn("_total", F.least(wanted, F.sum(F.when(live, F.col("most")).otherwise(0.0)).over(everything)))
    # level: budget per share of the sources that are not cut
    level = F.when(live & (F.col("_cut") + F.col("_r") * F.col("_rest") >= F.col("_total")), (F.col("_total") - F.col("_cut")) / F.col("_rest"))
    j = j.withColumn("_level", F.max(level).over(everything))
    own = F.when(live, F.least(F.col("most"), F.coalesce(F.col("_level"), F.col("_r")) * F.col("target_share"))).otherwise(0.0)
    return j.select("source", "target_share", "max_repeats", "n_docs", "tokens", F.floor(own + 0.5).cast("bigint").alias("budget"))


def mix(docs: DataFrame, target: DataFrame, total_tokens: int | str | None = None, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(chosen, budgets).  chosen: (doc_id, source, n_tokens, copies), one row per document with at least one copy.

    Documents without tokens (null or empty text) and of sources not named are never chosen.  Ties of the key go by
    doc_id; equal ids are separate documents.
    """
    size = persist_table(sizes(docs, vocabulary).where(F.col("n_tokens") > 0), "mixture-sizes")
    per = size.where(F.col("source").isNotNull()).groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("tokens"), (F.count(F.lit(1)) / F.sum("key")).alias("rate"))
    b = persist_table(budgets(per.select("source", "n_docs", "tokens"), target, total_tokens), "mixture-budgets")
    plan = b.where(F.col("tokens") > 0).join(per.select("source", "rate"), "source")
    plan = plan.select("source", "rate", F.floor(F.col("budget") / F.col("tokens")).cast("int").alias("epochs"), (F.col("budget") % F.col("tokens")).alias("rest"))
    # bins of nearly equal filling: the key is about exponential, 1-exp(-rate*key) about uniform; rising in key
    s = size.join(plan, "source").withColumn("bin", F.least(F.lit(BINS - 1), F.floor((1 - F.exp(-F.col("rate") * F.col("key"))) * BINS)).cast("int"))
    hist = s.groupBy("source", "bin").agg(F.sum("n_tokens").alias("t"))
    w = Window.partitionBy("source").orderBy("bin")
    hist = hist.select("source", "bin", (F.sum("t").over(w) - F.col("t")).alias("below"), F.sum("t").over(w).alias("upto"))
    s = s.join(hist, ["source", "bin"])
    inside = F.when(F.col("upto") <= F.col("rest"), 1).when(F.col("below") >= F.col("rest"), 0)
    s = s.withColumn("inside", inside)
    sure = s.where(F.col("inside").isNotNull()).select("doc_id", "source", "n_tokens", (F.col("epochs") + F.col("inside")).alias("copies"))
    edge = s.where(F.col("inside").isNull())
    run = F.sum("n_tokens").over(Window.partitionBy("source", "bin").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    edge = edge.withColumn("_run", F.col("below") + run)
    edge = edge.select("doc_id", "source", "n_tokens", (F.col("epochs") + F.when(F.col("_run") - F.col("n_tokens") / 2 <= F.col("rest"), 1).otherwise(0)).alias("copies"))
    return sure.unionByName(edge).where(F.col("copies") > 0), b


def report(docs: DataFrame, target: DataFrame, total_tokens: int | str | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per named source: target and reached share, tokens there and chosen, copies, highest repeat count."""
    chosen, b = mix(docs, target, total_tokens, vocabulary)
    got = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("chosen_tokens"), F.sum("copies").alias("chosen_copies"), F.max("copies").alias("top_repeat"))
    r = b.join(got, "source", "left").fillna(0, ["chosen_tokens", "chosen_copies", "top_repeat"])
    total = F.sum("chosen_tokens").over(Window.partitionBy())
    return r.select("source", "target_share", "max_repeats", "n_docs", "tokens", "budget", "chosen_tokens", "chosen_copies", "top_repeat", F.when(total > 0, F.col("chosen_tokens") / total).otherwise(0.0).alias("actual_share"))
