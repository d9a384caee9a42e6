"""Each batch of articles against everything accepted before, without reading the history again.

What is known lives in a folder that any later session can open (AcceptedArticles(spark, path)).  Every batch adds one commit
to it, of these kinds of rows:
  keys      (bk, hi, lo): blocking keys of place, week and one of four 16-bit bands of the hash; hashes at most 3 bits apart
            share a band
  hours     per place, hash and hour the smallest id with its time, and the hour's first and last time
  times     (place, hi, lo, week, hour, t, id): the rows themselves
  articles  (id, url_key, fields, representative): all articles with what they repeat; accepted ones represent themselves
  roots     (id, root): union-find over accepted articles; the latest commit that names an id counts
Keys, hours and times lie in blocks of four weeks, articles in buckets of their page address, their number by the size of the
history.  A batch reads the blocks and buckets it touches and no others, so what it costs does not grow with the history
beside them.

A batch's candidates of the blocking keys are scored by weights learned from the history (log2 of how much more often a field
agrees in pairs of one page than in chance pairs); those that score less than any pair of their place that fulfils the rule
are dropped, and the exact rule decides the rest.  Copies of one hash are one class: a probe meets per class at most the hours of three
weeks, each with its smallest id, and opens single rows only of the two hours in which the time limit falls, so no pairs
within a group of copies are made.  What repeats nothing accepted is resolved in order of id inside the batch.

Clusters: what a new article repeats is one cluster, the smallest root stays, and only the entries of clusters touched are
written again.  Articles of the history unite in the same way, each with the smaller ids it repeats.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import hash_window
from ..operators.components import connected_components
from ..operators.hash_window import MAX_BITS, WINDOW_US
from ..operators.instants import with_article_instant
from ..runtime import list_names, persist_table, read_text, scratch_path, write_text

#: Up to this many unresolved rows of a batch (about 100 bytes each) are put in order in one task; more go in rounds.
FINISH_ROWS = 100_000
#: Articles of the history to a bucket of page addresses, and the most buckets.
BUCKET_ROWS, MOST_BUCKETS = 1_000_000, 4096
# Query parameters that do not name a page.
TRACKING = r"^(?:utm_\w*|fbclid|gclid|dclid|msclkid|yclid|igshid|mc_cid|mc_eid|ref|ref_src|amp|outputtype)(?:=|$)"


def page_key(url: Column) -> Column:
    """The page address: without scheme, www/m/mobile/amp host prefix, tracking parameters, fragment, /amp and closing slash.

    Host case does not count, path case does; parameters that stay are sorted.  Null for null and blank urls.
    """
    u = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(u, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(?:80|443)$", ""), r"^(?:(?:www|m|mobile|amp)\.)+", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^/?]*([^?]*)", 1), r"(?:/+|/amp/*)+$", "")
    query = F.regexp_extract(u, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.when(F.trim(url) != "", F.concat_ws("?", F.concat(host, path), F.when(F.size(kept) > 0, F.array_join(kept, "&"))))


def _clean(c: str) -> Column:
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def prepare(article: DataFrame, outlet: DataFrame) -> DataFrame:
    """(id, batch_no, url_key, hi, lo, t, district, state), one row per id.

    hi and lo are the halves of a hash of 16 hex digits, null for any other text; a null batch_no is history (0);
    rows without id are left out, of several rows with one id the smallest counts.
    """
    a = article.where(F.col("id").isNotNull()).select("id", F.coalesce("batch_no", F.lit(0)).alias("batch_no"), "url", "outlet_name", "district", "state", "published_at", F.lower(F.trim("dedup_hash")).alias("_h"))
    a = with_article_instant(a, outlet)
    ok = F.col("_h").rlike(r"^[0-9a-f]{16}$")
    half = lambda s: F.when(ok, F.conv(F.substring("_h", s, 8), 16, 10).try_cast("bigint"))
    a = a.select("id", "batch_no", page_key(F.col("url")).alias("url_key"), half(1).alias("hi"), half(9).alias("lo"), F.col("utc_us").alias("t"), _clean("district").alias("district"), _clean("state").alias("state"))
    return a.groupBy("id").agg(F.min(F.struct(*[c for c in a.columns if c != "id"])).alias("s")).select("id", "s.*")


def probe(new: DataFrame, pages: DataFrame, tables: tuple[DataFrame, DataFrame, DataFrame], weights: Weights) -> DataFrame:
    """(id, kept, score): the smallest accepted id each new article repeats and the pair's score; no row without one.

    pages: accepted articles with their fields; tables: keys, hours and times.
    """
    p = pages.join(new.where("url_key is not null").select("url_key").distinct(), "url_key", "left_semi")
    p = p.groupBy("url_key").agg(F.min(F.struct(*_FIELDS)).alias("a"))
    n = new.where("url_key is not null").select("url_key", F.struct(*_FIELDS).alias("n")).join(p, "url_key")
    by_url = n.select(F.col("n.id").alias("id"), F.col("a.id").alias("kept"), weights.score(_levels("n", "a", F.lit(True))).alias("score"))
    near = hash_window.first_near(new, *tables, gate=weights.gate)
    place = F.when(F.col("by_district"), "district").otherwise("state")
    levels = {"hash": _bits_level(F.col("bits")), "time": _gap_level(F.col("gap")), "place": place}
    by_hash = near.select("id", F.col("first").alias("kept"), weights.score(levels).alias("score"))
    both = by_url.unionByName(by_hash).groupBy("id").agg(F.min(F.struct("kept", (-F.col("score")).alias("less"))).alias("s"))
    return both.select("id", "s.kept", (-F.col("s.less")).alias("score"))


_FIELDS = ["id", "hi", "lo", "t", "district", "state"]
_OUT = "id bigint, kept bigint, score double"


def in_order(weights: Weights) -> Callable[[pa.Table], pa.Table]:
    """Sequential resolution of articles that repeat nothing accepted before: kept and score are null for those accepted."""

    def resolve(rows: pa.Table) -> pa.Table:
        r = rows.select([*_FIELDS, "url_key"]).to_pylist()
        pages: dict[str, dict] = {}
        seen: dict[tuple, list[tuple[int, dict]]] = {}
        out: list[tuple] = []
        r.sort(key=lambda x: x["id"])
        for x in r:
            found = []
            if x["url_key"] in pages:
                found.append((pages[x["url_key"]]["id"], -weights.score_of(x, pages[x["url_key"]], True)))
            hashed = x["hi"] is not None and x["t"] is not None
            h = (x["hi"] << 32 | x["lo"]) if hashed else 0
            bands = [(i, h >> 16 * i & 65535) for i in range(4)]
            own = ("d", x["district"]) if x["district"] else ("s", x["state"]) if x["state"] else None
            if hashed and own:
                near = {a["id"]: a for b in bands for g, a in seen.get((own, b), ()) if (g ^ h).bit_count() <= MAX_BITS and abs(a["t"] - x["t"]) <= WINDOW_US}
                if near:
                    first = near[min(near)]
                    found.append((first["id"], -weights.score_of(x, first, False)))
            best = min(found, default=None)
            out.append((x["id"], best and best[0], best and -best[1]))
            if best:
                continue
            if x["url_key"] is not None:
                pages.setdefault(x["url_key"], x)
            if hashed:
                for p in (("d", x["district"]), ("s", x["state"])):
                    if p[1]:
                        for b in bands:
                            seen.setdefault((p, b), []).append((h, x))
        return pa.table({n: pa.array([o[k] for o in out], t) for k, (n, t) in enumerate((("id", pa.int64()), ("kept", pa.int64()), ("score", pa.float64())))})

    return resolve


def resolve_batch(fresh: DataFrame, weights: Weights, finish_rows: int = FINISH_ROWS, at_most: int | None = None) -> DataFrame:
    """(id, kept, score) of articles that repeat nothing accepted before, in order of id among themselves.

    Rounds: whoever has no smaller neighbour left is accepted, whoever then repeats an accepted one is a repeat; when few
    enough rows are open they are finished in one task (at once if there are at_most that many).  kept is taken at the
    end, over all accepted ones.
    """
    def meet(x: DataFrame, among: DataFrame) -> DataFrame:
        return probe(x, among.where("url_key is not null"), hash_window.keyed(among), weights)

    def finish(rows: DataFrame) -> DataFrame:
        return persist_table(rows.groupBy(F.lit("all")).applyInArrow(in_order(weights), _OUT), "ordered")

    if at_most is not None and at_most <= finish_rows:
        return finish(fresh)
    left, accepted, repeats = persist_table(fresh, "open"), None, None
    while left.count() > finish_rows:
        m = meet(left, left).where("kept < id").select("id")
        free = persist_table(left.join(m, "id", "left_anti"), "free")
        accepted = free if accepted is None else persist_table(accepted.unionByName(free), "accepted")
        hit = persist_table(meet(left.join(free.select("id"), "id", "left_anti"), free).where("kept < id").select("id"), "hit")
        gone = left.join(hit, "id", "left_semi")
        repeats = persist_table(gone if repeats is None else repeats.unionByName(gone), "repeats")
        left = persist_table(left.join(free.select("id"), "id", "left_anti").join(hit, "id", "left_anti"), "open")
    done = finish(left)
    if accepted is None:
        return done
    accepted = persist_table(accepted.unionByName(left.join(done.where("kept is null"), "id", "left_semi")), "accepted")
    repeats = repeats.unionByName(left.join(done.where("kept is not null"), "id", "left_semi"))
    found = meet(repeats, accepted)
    return persist_table(found.unionByName(accepted.select("id", F.lit(None).cast("bigint").alias("kept"), F.lit(None).cast("double").alias("score"))), "resolved")


def page_edges(new: DataFrame, pages: DataFrame) -> DataFrame:
    """(x, b), edges that join each new row to all smaller ids of its page, through the page's smallest id."""
    firsts = pages.groupBy("url_key").agg(F.min("id").alias("b"))
    met = new.where("url_key is not null").select("url_key", F.col("id").alias("x")).join(firsts, "url_key").where("b < x")
    members = pages.join(met.groupBy("url_key").agg(F.min("b").alias("b"), F.max("x").alias("last")), "url_key").where("id < last")
    return met.select("x", "b").unionByName(members.select(F.col("id").alias("x"), "b")).where("x <> b")


#: Stored columns of each kind of row; name is a place, or the page address of an article.
KINDS = {
    "keys": ["bk", "hi", "lo"],
    "hours": ["name", "hi", "lo", "week", "hour", "id", "t", "t0", "t1"],
    "times": ["name", "hi", "lo", "week", "hour", "t", "id"],
    "articles": ["name", "id", "hi", "lo", "t", "district", "state", "kept", "score"],
    "roots": ["id", "root"],
}
_ROW = "bk bigint, name string, hi bigint, lo bigint, week bigint, hour bigint, t bigint, t0 bigint, t1 bigint, id bigint, district string, state string, kept bigint, score double, root bigint"


class AcceptedArticles:
    """The persisted state: accept() takes a batch of prepared articles, links come back and the state grows.

    path: a folder on shared storage; one that holds a state is opened, with its weights and buckets, and goes on from its
    last complete commit (what an interrupted batch left is overwritten).  Without a path the state lives in the session's
    scratch folder.  One writer at a time.
    """

    def __init__(self, spark, path: str | None = None, finish_rows: int = FINISH_ROWS, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.finish_rows, self.bucket_rows = spark, finish_rows, bucket_rows
        self.root = (path or scratch_path(spark, "accepted")).rstrip("/")
        self.commits: list[dict] = []
        self.weights, self.buckets = Weights({}), 1
        self.columns = [c.split()[0] for c in _ROW.split(", ")]
        names = [n for n in list_names(spark, f"{self.root}/commits") if n.endswith(".json")]
        if names:
            said = json.loads(read_text(spark, f"{self.root}/settings.json"))
            self.buckets, self.weights = said["buckets"], Weights({tuple(k.split(" ")): v for k, v in said["weights"].items()})
            lines = spark.read.text([f"{self.root}/commits/{n}" for n in names]).collect()
            self.commits = sorted((json.loads(r[0]) for r in lines), key=lambda c: c["n"])

    # --- storage

    def _commit(self, rows: DataFrame) -> int:
        """Write rows (kind, block, ...) as the next commit; a folder by kind and block, large ones split by AQE."""
        n = self.commits[-1]["n"] + 1 if self.commits else 1
        at = f"{self.root}/c={n}"
        rows.hint("rebalance", F.col("kind"), F.col("block")).write.mode("overwrite").partitionBy("kind", "block").parquet(at)
        folders = {k[5:]: sorted(int(b[6:]) for b in list_names(self.spark, f"{at}/{k}") if b.startswith("block=")) for k in list_names(self.spark, at) if k.startswith("kind=")}
        commit = {"n": n, "folders": folders}
        write_text(self.spark, f"{self.root}/commits/{n:08d}.json", json.dumps(commit))
        self.commits.append(commit)
        return n

    def folders(self, kind: str, blocks: set[int] | None = None, after: int = 0) -> list[str]:
        """Folders of a kind, of the given blocks or all, in commits after the given one."""
        return [f"{self.root}/c={c['n']}/kind={kind}/block={b}" for c in self.commits if c["n"] > after for b in c["folders"].get(kind, []) if blocks is None or b in blocks]

    def read(self, kind: str, blocks: set[int] | None = None, after: int = 0) -> DataFrame:
        """The stored rows of a kind with their commit c, of the folders named by folders()."""
        at, schema = self.folders(kind, blocks, after), f"{_ROW}, c int"
        df = self.spark.read.schema(schema).option("basePath", self.root).parquet(*at) if at else self.spark.createDataFrame([], schema)
        df = df.select(*KINDS[kind], "c")
        if kind == "articles":
            return df.withColumnRenamed("name", "url_key").withColumnRenamed("kept", "representative")
        return df.withColumnRenamed("name", "place") if "name" in KINDS[kind] else df

    def _tables(self, blocks: set[int]) -> tuple[DataFrame, DataFrame, DataFrame]:
        hours = self.read("hours", blocks).withColumnsRenamed({"id": "a", "t": "ta"})
        return self.read("keys", blocks), hours, self.read("times", blocks)

    def _accepted(self, buckets: set[int]) -> DataFrame:
        return self.read("articles", buckets).where("id = representative and url_key is not null")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.coalesce("url_key", F.col("id").cast("string"))), F.lit(self.buckets))

    def _touched(self, rows: DataFrame) -> tuple[int, set[int], set[int]]:
        """Rows of a batch, the blocks of weeks and the buckets of pages it touches: as many numbers as there are of them at most."""
        blocks = rows.select("*", F.explode_outer(hash_window.touched_blocks(F.col("t"))).alias("_b"), self._bucket().alias("_p"))
        r = blocks.agg(F.countDistinct("id"), F.collect_set("_b"), F.collect_set(F.when(F.col("url_key").isNotNull(), F.col("_p")))).first()
        return r[0], set(r[1]), set(r[2])

    def _store(self, batch: DataFrame, kept: DataFrame | None) -> None:
        """Commit a batch; kept (id, kept, score) are those of it that repeat something."""
        if kept is None:
            accepted, mapped = batch, batch.withColumns({"kept": F.col("id"), "score": F.lit(None).cast("double")})
        else:
            accepted = batch.join(kept.select("id"), "id", "left_anti")
            mapped = batch.join(kept, "id", "left").withColumn("kept", F.coalesce("kept", "id"))
        keys, hours, times = hash_window.keyed(accepted)
        parts = {
            "keys": keys,
            "hours": hours.withColumnsRenamed({"place": "name", "a": "id", "ta": "t"}),
            "times": times.withColumnRenamed("place", "name"),
            "articles": mapped.withColumn("block", self._bucket()).withColumnRenamed("url_key", "name"),
        }
        rows = None
        for kind, df in parts.items():
            df = df.select(F.lit(kind).alias("kind"), F.col("block").cast("bigint"), *KINDS[kind])
            rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
        self._commit(rows)

    # --- batches

    def load_history(self, history: DataFrame) -> None:
        """Accept a whole table as it is, as the first commit, and learn the field weights from it."""
        if self.commits:
            raise ValueError(f"{self.root} holds a state")
        self.buckets = max(1, min(MOST_BUCKETS, math.ceil(history.count() / self.bucket_rows)))
        self.weights = Weights(learn_weights(history))
        write_text(self.spark, f"{self.root}/settings.json", json.dumps({"buckets": self.buckets, "weights": {" ".join(k): v for k, v in self.weights.of.items()}}))
        self._store(history, None)

    def accept(self, batch: DataFrame) -> DataFrame:
        """(kept_id, dup_id, score) of the batch's articles that repeat an accepted one; ids must be new to the state."""
        n, blocks, buckets = self._touched(batch)
        old = persist_table(probe(batch, self._accepted(buckets), self._tables(blocks), self.weights), "old")
        inner = resolve_batch(batch.join(old.select("id"), "id", "left_anti"), self.weights, self.finish_rows, n)
        kept = old.unionByName(inner.where("kept is not null"))
        self._store(batch, kept)
        return kept.select(F.col("kept").alias("kept_id"), F.col("id").alias("dup_id"), "score")

    def links(self) -> DataFrame:
        """(kept_id, dup_id, score) of all batches."""
        return self.read("articles").where("id <> representative").select(F.col("representative").alias("kept_id"), F.col("id").alias("dup_id"), "score")

    # --- clusters

    def _roots(self) -> DataFrame:
        """(id, root) of the accepted articles that are not the root of their cluster."""
        return self.read("roots").groupBy("id").agg(F.max_by("root", "c").alias("root"))

    def unite(self) -> None:
        """Unite the clusters that the articles stored since the last call meet, and write the entries that change."""
        united = max((c["n"] for c in self.commits if "roots" in c["folders"] or c.get("united")), default=0)
        if not self.folders("articles", after=united):
            return
        # what was accepted in earlier batches comes before all of a later one, whatever its ids
        own = F.struct("c", "id")
        new = self.read("articles", after=united)
        _, blocks, buckets = self._touched(new)
        keys, hours, times = self._tables(blocks)
        hours, times = hours.withColumn("a", F.struct("c", F.col("a").alias("id"))), times.withColumn("id", own)
        rows = new.withColumn("id", own)
        pages = self._accepted(buckets).select("url_key", own.alias("id"))
        e = hash_window.all_near(rows, keys, hours, times, below=True, gate=self.weights.gate).unionByName(page_edges(rows, pages)).select(F.col("x.id").alias("x"), F.col("b.id").alias("b"))
        # a repeat stands in its representative's place
        repeats = new.where("id <> representative").select(F.col("id").alias("x"), "representative")
        e = e.join(repeats, "x", "left").select(F.coalesce("representative", "x").alias("a"), "b")
        known = self._roots() if self.folders("roots") else None
        if known is not None:
            for c in ("a", "b"):
                e = e.join(known.select(F.col("id").alias(c), F.col("root").alias("_root")), c, "left").withColumn(c, F.coalesce("_root", c)).drop("_root")
        e = persist_table(e.select("a", "b").where("a <> b").distinct(), "unions")
        c = persist_table(connected_components(e).where("node <> component"), "united")
        changed = c.select(F.col("node").alias("id"), F.col("component").alias("root"))
        if known is not None:
            changed = changed.unionByName(known.join(c, F.col("root") == F.col("node")).select("id", F.col("component").alias("root")))
        self._commit(changed.select(F.lit("roots").alias("kind"), F.lit(0).cast("bigint").alias("block"), "id", "root"))
        self.commits[-1]["united"] = True

    def clusters(self) -> DataFrame:
        """(id, representative) of every article: the smallest accepted id of all that are united with what it repeats."""
        self.unite()
        a = self.read("articles").select("id", "representative")
        if not self.folders("roots"):
            return a
        return a.join(self._roots().withColumnRenamed("id", "representative"), "representative", "left").select("id", F.coalesce("root", "representative").alias("representative"))


def deduplicate(article: DataFrame, outlet: DataFrame, finish_rows: int = FINISH_ROWS, path: str | None = None) -> AcceptedArticles:
    """The state after batch 0 is accepted as a whole and each later batch in order, with its clusters united."""
    rows = persist_table(prepare(article, outlet), "prepared")
    state = AcceptedArticles(article.sparkSession, path, finish_rows)
    state.load_history(rows.where("batch_no <= 0"))
    for r in rows.where("batch_no > 0").select("batch_no").distinct().orderBy("batch_no").collect():
        state.accept(rows.where(F.col("batch_no") == r["batch_no"]))
    state.unite()
    return state


# --- learned field weights -------------------------------------------------------------------------------------------

#: Pairs of articles from which chance agreement is learned, at most.
CHANCE_GROUPS = 65_536
LEVELS = {"url": ("same", "other"), "hash": ("same", "near", "far", "unknown"), "time": ("day", "week", "far", "unknown"), "place": ("district", "state", "other")}


def _bits_level(bits: Column) -> Column:
    return F.when(bits == 0, "same").when(bits <= MAX_BITS, "near").when(bits.isNotNull(), "far").otherwise("unknown")


def _gap_level(gap: Column) -> Column:
    return F.when(gap <= WINDOW_US // 7, "day").when(gap <= WINDOW_US, "week").when(gap.isNotNull(), "far").otherwise("unknown")


def _levels(x: str, y: str, same_url: Column) -> dict[str, Column]:
    a, b = (lambda c: F.col(f"{x}.{c}")), (lambda c: F.col(f"{y}.{c}"))
    return {
        "url": F.when(same_url, "same").otherwise("other"),
        "hash": _bits_level(F.bit_count(a("hi").bitwiseXOR(b("hi"))) + F.bit_count(a("lo").bitwiseXOR(b("lo")))),
        "time": _gap_level(F.abs(a("t") - b("t"))),
        "place": F.when(a("district") == b("district"), "district").when(a("state") == b("state"), "state").otherwise("other"),
    }


class Weights:
    """The learned weight of each level of each field; a level without one weighs nothing."""

    def __init__(self, of: dict[tuple[str, str], float]):
        self.of = of
        #: What the hash adds at least to the score of a pair that fulfils the rule by hash.
        self.least_hash = min(of.get(("hash", lv), 0.0) for lv in ("same", "near"))

    def _weight(self, field: str, level: Column) -> Column:
        known = [F.lit(v) for (f, lv), w in self.of.items() if f == field for v in (lv, w)]
        return F.coalesce(F.try_element_at(F.create_map(*known), level), F.lit(0.0)) if known else F.lit(0.0)

    def score(self, levels: dict[str, Column]) -> Column:
        total = F.lit(0.0)
        for f, level in levels.items():
            total = total + self._weight(f, level)
        return F.round(total, 6)

    def gate(self, bits: Column, by_district: Column) -> Column:
        """Whether a candidate of the hash's blocking keys, its time being as good as it may be, scores what a pair of its kind of
        place that fulfils the rule scores at least; what does not is no such pair."""
        place = self._weight("place", F.when(by_district, "district").otherwise("state"))
        best = place + F.lit(max(self.of.get(("time", lv), 0.0) for lv in ("day", "week")))
        return self._weight("hash", _bits_level(bits)) + best >= F.lit(self.least_hash) + best

    def score_of(self, x: dict, y: dict, same_url: bool) -> float:
        """score() of two rows; without a common url by hash and the place of x alone, as the blocking keys meet."""
        bits = None if None in (x["hi"], y["hi"]) else (x["hi"] ^ y["hi"]).bit_count() + (x["lo"] ^ y["lo"]).bit_count()
        gap = None if None in (x["t"], y["t"]) else abs(x["t"] - y["t"])
        if same_url:
            place = "district" if x["district"] is not None and x["district"] == y["district"] else "state" if x["state"] is not None and x["state"] == y["state"] else "other"
        else:
            place = "district" if x["district"] else "state"
        levels = [
            ("hash", "unknown" if bits is None else "same" if bits == 0 else "near" if bits <= MAX_BITS else "far"),
            ("time", "unknown" if gap is None else "day" if gap <= WINDOW_US // 7 else "week" if gap <= WINDOW_US else "far"),
            ("place", place),
        ]
        return round(sum(self.of.get(k, 0.0) for k in ([("url", "same")] if same_url else []) + levels), 6)


def learn_weights(rows: DataFrame) -> dict[tuple[str, str], float]:
    """log2(m/u) per field and level: m from the first and last article of each page, u from two articles of each of
    CHANCE_GROUPS groups (fewer where there are not eight articles to a group) that a hash of the id makes.

    One pair per group, so neither sample holds pairs within a group; the result has one number per level.  The url field
    defines the pages, so its weight is the rarity of chance agreement.
    """
    groups = max(1, min(CHANCE_GROUPS, rows.count() // 8))
    rows = rows.select(F.xxhash64(F.lit("chance"), "id").alias("_h"), *rows.columns)
    whole = F.struct(*[F.col(c) for c in rows.columns])
    ends = lambda g: g.agg(F.min(whole).alias("x"), F.max(whole).alias("y")).where("x.id <> y.id")
    same = ends(rows.where("url_key is not null").groupBy("url_key"))
    chance = ends(rows.groupBy(F.pmod("_h", F.lit(groups))))
    levels = _levels("x", "y", F.col("x.url_key") == F.col("y.url_key"))
    tall = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.explode(F.map_from_entries(F.array(*[F.struct(F.lit(k), v) for k, v in levels.items()]))).alias("field", "level"))
    counts = tall(same, "m").unionByName(tall(chance, "u")).groupBy("kind", "field", "level").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {(r["kind"], r["field"], r["level"]): r["n"] for r in counts}
    total = {(k, f): sum(v for (kk, ff, _), v in n.items() if (kk, ff) == (k, f)) for k in "mu" for f in LEVELS}
    out = {}
    for f, ls in LEVELS.items():
        for lv in ls:
            m = (n.get(("m", f, lv), 0) + 0.5) / (total["m", f] + 0.5 * len(ls))
            u = (n.get(("u", f, lv), 0) + 0.5) / (total["u", f] + 0.5 * len(ls))
            out[f, lv] = 0.0 if f == "url" and lv == "other" else round(math.log2(m / u), 6)
    return out
