"""Main body of web pages by consensus paths of their hosts.

1. score   Every page is cut into containers (text runs with a generalised tag-class path: digits and hex ids of class
           names become *).  A container scores by its letters if it reads as sentences and is no link.
2. vote    Each page votes for the path with the highest score; votes, purity and title matches are summed per host and
           path in Spark, so a host is decided by all of its pages.
3. extract Pages are read again with the winning paths of their host: blocks on pure body paths and on title paths are
           main, blocks on losing paths are not.  JSON-LD article bodies count as a container.
4. consent A line that no path of its own page decides (no page kept, or one path for everything) is outside if its host
           prints it outside its winning paths on a fair part of its pages (LEAST_PAGES, LEAST_SHARE) and never on them, digits and
           marks aside.
What is left has been seen nowhere; it is decided by words: a naive Bayes model whose labels are the blocks of a bounded
sample of decided pages (SAMPLE_PAGES), with the headline being the first line of headline form before the first paragraph.
"""

from __future__ import annotations

import html as htmllib
import json
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import bounded_sample, persist_table
from . import residue

SAMPLE_PAGES = 3000
LEAST_VOTES = 0.05
#: A page whose best path holds less sentence text than this has no vote (a legal note alone is no main body).
VOTE_CHARS = 250
PURE = 0.9
#: A host must print a line outside its winning paths so often, in all and for each of its pages, and never on them, for it to be
#: outside everywhere; links to other stories are printed less often.
LEAST_PAGES, LEAST_SHARE = 3, 0.03
SENTENCE_CHARS = 40
LD = "ld+json"

_TAG = re.compile(r"<!--.*?-->|<(script|style|noscript|title)\b([^>]*)>(.*?)</\1\s*>|<(/?)([a-zA-Z][\w:-]*)([^>]*)>", re.S | re.I)
_CLASS = re.compile(r"class\s*=\s*[\"']([^\"']*)[\"']", re.I)
_HEX = re.compile(r"(?=[a-z_]*\d)[a-z_]?[0-9a-f]{4,}|\d+")
_INLINE = {"a", "b", "i", "em", "strong", "u", "small", "sup", "sub", "mark", "abbr"}
_VOID = {"br", "hr", "img", "meta", "link", "input", "wbr", "source"}
_END = re.compile(r"[.।۔॥?!…]+[\"'”’)\]\s]*$")
_SPLIT = re.compile(r"[\s.,;:!?|/»«•·\-–—()\[\]{}<>\"'“”‘’।۔،؛*#=+_]+")
_LETTER = re.compile(r"[^\W\d_]")


def key(text: str) -> str:
    """The text in lower case without white space: what a block and a line of the clean text have in common."""
    return "".join(text.lower().split())


_NO_LETTER = regex.compile(r"[^\p{L}\p{M}]+")


def line_hash(text: str) -> int:
    """64 bits of a line's letters and marks in lower case: lines that differ in digits, spaces or punctuation meet."""
    h = xxhash.xxh64_intdigest(_NO_LETTER.sub("", text).lower())
    return h - (1 << 64) if h >> 63 else h


def general_path(stack: list[tuple[str, str]]) -> str:
    return "/".join(t if not c else t + "." + _HEX.sub("*", c) for t, c in stack)


class Page:
    """blocks: (path, text, is a link); title: the text of <title>."""

    def __init__(self, raw: str):
        self.title, self.blocks = "", []
        stack: list[tuple[str, str]] = []
        parts: list[str] = []
        linked = False

        def flush() -> None:
            nonlocal linked
            text = " ".join(htmllib.unescape("".join(parts)).split())
            if text:
                self.blocks.append((general_path(stack), text, linked))
            parts.clear()
            linked = any(t == "a" for t, _ in stack)

        at = 0
        in_link = 0
        for m in _TAG.finditer(raw):
            parts.append(raw[at : m.start()])
            at = m.end()
            special, name = m.group(1), (m.group(5) or "").lower()
            if special:
                special = special.lower()
                if special == "title":
                    self.title = self.title or " ".join(htmllib.unescape(m.group(3)).split())
                elif special == "script" and "ld+json" in m.group(2):
                    flush()
                    self._linked_data(m.group(3))
                continue
            if not name:
                continue
            if name in _INLINE:
                in_link += (1 if not m.group(4) else -1) if name == "a" else 0
                linked = linked or in_link > 0
                continue
            flush()
            if name in _VOID or name in ("html", "head", "body", "!doctype"):
                continue
            if m.group(4):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        del stack[i:]
                        break
            elif not m.group(6).endswith("/"):
                c = _CLASS.search(m.group(6))
                stack.append((name, " ".join(c.group(1).split()) if c else ""))
        parts.append(raw[at:])
        flush()

    def _linked_data(self, text: str) -> None:
        try:
            todo = [json.loads(text)]
        except ValueError:
            return
        while todo:
            x = todo.pop()
            if isinstance(x, list):
                todo += x
            elif isinstance(x, dict):
                todo += [v for v in x.values() if isinstance(v, (dict, list))]
                body = x.get("articleBody")
                if isinstance(body, str):
                    self.blocks += [(LD, line.strip(), False) for line in body.split("\n") if line.strip()]


def is_sentence(text: str) -> bool:
    return len(text) >= SENTENCE_CHARS and bool(_END.search(text[-12:]))


def is_title(block: str, title: str) -> bool:
    return bool(title) and title.startswith(block) and (len(title) == len(block) or not title[len(block)].isalnum())


def host(url: Column) -> Column:
    h = F.lower(F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)", 1))
    return F.regexp_replace(F.regexp_replace(h, r":\d+$", ""), r"^(?:(?:www|m|mobile|amp)\.)+", "")


_VOTES = "host string, path string, h bigint, pages bigint, votes bigint, blocks bigint, sentences bigint, titles bigint"
_SUMS = ("pages", "votes", "blocks", "sentences", "titles")
#: Sums kept by one task before they are handed on.
MOST_SUMS = 200_000


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, h, pages, votes, blocks, sentences, titles) of the pages (host, raw_html), summed within each task.

    h null: the figures of a path; path '' holds the number of pages.  Else: how many blocks of a path are the line h.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, list[int]] = defaultdict(lambda: [0] * 5)

        def flush() -> pa.RecordBatch:
            rows = [(*k, *v) for k, v in total.items()]
            total.clear()
            cols = list(zip(*rows)) if rows else [[] for _ in range(8)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i < 2 else pa.int64()) for i, c in enumerate(cols)], names=[c.split()[0] for c in _VOTES.split(", ")])

        for b in (b.slice(at, AT_ONCE) for b in batches for at in range(0, b.num_rows, AT_ONCE)):
            for h, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                page = Page(raw)
                score: Counter = Counter()
                seen = set()
                for path, text, link in page.blocks:
                    if not _LETTER.search(text):
                        continue
                    t = total[h, path, None]
                    t[2] += 1
                    if path not in seen:
                        seen.add(path)
                        t[0] += 1
                    total[h, path, line_hash(text)][2] += 1
                    if is_title(text, page.title):
                        t[4] += 1
                    elif is_sentence(text) and not link:
                        t[3] += 1
                        if path != LD:
                            score[path] += len(text)
                total[h, "", None][0] += 1
                best = max(score, key=lambda p: (score[p], p), default="")
                if score[best] >= VOTE_CHARS:
                    total[h, best, None][1] += 1
            if len(total) > MOST_SUMS:
                yield flush()
        yield flush()

    return pages.where("raw_html <> ''").select("host", "raw_html").mapInArrow(count, _VOTES)


def verdicts(v: DataFrame) -> DataFrame:
    """(host, path, kind) of the winning paths of each host: body, title or mixed; all other paths lose.

    A path wins with LEAST_VOTES of the host's pages; it decides alone if PURE of its blocks (titles aside) are sentences.
    """
    v = v.where("h is null").groupBy("host", "path").agg(*[F.sum(c).alias(c) for c in _SUMS])
    n = F.max(F.when(F.col("path") == "", F.col("pages"))).over(Window.partitionBy("host"))  # as many rows as a host has paths
    v = v.withColumn("n", n).where("path <> ''")
    plain = F.col("blocks") - F.col("titles")
    kind = (
        F.when(F.col("path") == LD, "body")
        .when(F.col("titles") * 2 > F.col("blocks"), "title")
        .when((F.col("votes") > 0) & (F.col("votes") >= F.col("n") * LEAST_VOTES), F.when(F.col("sentences") >= plain * PURE, "body").otherwise("mixed"))
    )
    return v.select("host", "path", kind.alias("kind")).where("kind is not null")


def path_maps(kinds: DataFrame) -> DataFrame:
    """(host, paths): the winning paths of each host, at most 1 / LEAST_VOTES of them and its titles."""
    return kinds.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("path", "kind"))).alias("paths"))


def outside_by_host(v: DataFrame, kinds: DataFrame) -> DataFrame:
    """(host, h): lines that a host prints outside its winning paths, LEAST_PAGES times and LEAST_SHARE times a page or more, and
    never on a body or title path.

    Hosts without a pure body path tell nothing.
    """
    tells = kinds.where("kind = 'body' and path <> '" + LD + "'").select("host").distinct()
    n = v.where("h is not null").groupBy("host", "path", "h").agg(F.sum("blocks").alias("n")).join(tells, "host", "left_semi")
    n = n.join(kinds, ["host", "path"], "left").where("kind is null or kind <> 'mixed'").groupBy("host", "h")
    n = n.agg(F.sum(F.when(F.col("kind").isNull(), F.col("n")).otherwise(0)).alias("out"), F.sum(F.when(F.col("kind").isNotNull(), F.col("n")).otherwise(0)).alias("main")).where(f"main = 0 and out >= {LEAST_PAGES}")
    size = v.where("path = ''").groupBy("host").agg(F.sum("pages").alias("n_pages"))
    return n.join(size, "host").where(F.col("out") >= F.col("n_pages") * LEAST_SHARE).select("host", "h")


def tokens(line: str) -> set[str]:
    """Words in lower case (digits as 0) and marks of shape: sentence end, length, framing."""
    out = {("0" if w.isdigit() else w) for w in _SPLIT.split(line.lower()) if w}
    out.add("§end" if _END.search(line) else "§open")
    out.add(f"§len{min(7, int(math.log2(len(line) + 1)))}")
    return out


class LineModel:
    """Naive Bayes over paragraph (0), headline (1) and furniture (2)."""

    def __init__(self, labelled: list[tuple[str, int]]):
        counts = [Counter(), Counter(), Counter()]
        for text, c in labelled:
            counts[c].update(tokens(text))
        vocab = {w for c in counts for w, k in c.items() if k >= 2}
        sizes = [sum(c[w] for w in vocab) + 0.5 * len(vocab) + 1 for c in counts]
        self.weights = {w: tuple(math.log((c[w] + 0.5) / s) for c, s in zip(counts, sizes)) for w in vocab}

    def classify(self, line: str) -> int:
        a = b = c = 0.0
        get = self.weights.get
        for t in tokens(line):
            w = get(t)
            if w:
                a += w[0]
                b += w[1]
                c += w[2]
        return 0 if a >= b and a >= c else 1 if b >= c else 2


def page_verdicts(page: Page, paths: dict[str, str], linked_data: bool = True) -> list[tuple[str, int]]:
    """The blocks of a page that its host's paths decide, as (text, 1 body, 2 title, 0 outside).

    Where the page has no winning path at all nothing is decided: its template may be one the host uses rarely.
    """
    kinds = [(paths.get(path, "other"), path, text) for path, text, _ in page.blocks]
    if not any(k in ("body", "mixed") for k, _, _ in kinds):
        return []
    rank = {"body": 1, "title": 2, "other": 0}
    return [(text, rank[k]) for k, path, text in kinds if (k in ("title", "other") or k == "body" and is_sentence(text)) and (linked_data or path != LD)]  # a credit on a body path is left open


def labelled_blocks(raw: str, paths: dict[str, str]) -> list[tuple[str, int]]:
    """The decided blocks of a page with their class for the word model: paragraph 0, headline 1, furniture 2."""
    return [(text, {1: 0, 2: 1, 0: 2}[k]) for text, k in page_verdicts(Page(raw), paths, linked_data=False) if _LETTER.search(text)]


def train(pages: DataFrame, host_paths: DataFrame, sample_pages: int = SAMPLE_PAGES) -> LineModel:
    """The word model, from about sample_pages pages of hosts with a pure body path, chosen by a hash of their id."""
    pure = F.exists(F.map_values("paths"), lambda k: k == "body") & ~F.exists(F.map_values("paths"), lambda k: k == "mixed")
    decided = pages.where("raw_html <> ''").join(host_paths.where(pure), "host").select("id", "raw_html", "paths")
    rows = bounded_sample(decided, "id", sample_pages)
    return LineModel([x for r in rows for x in labelled_blocks(r["raw_html"], r["paths"])])


class Reader:
    """What is known of the lines of one article from its clean text, its page if kept, and the paths of its host."""

    def __init__(self, model: LineModel, index: residue.Index):
        self.model, self.index = model, index

    def lines(self, text: str | None, raw: str | None, paths: dict[str, str] | None) -> list[tuple] | None:
        """(line_no, h, path verdict or -1, class by words, is the title, is short) of each line with a letter, h and class only where
        there is no verdict; None for null texts and records without a report."""
        if text is None or self.index.coverage(text)[0] >= residue.LEAST_COVERAGE:
            return None
        sure: dict[str, int] = {}
        title = ""
        if raw and paths:
            page = Page(raw)
            title = page.title
            for block, v in page_verdicts(page, paths):
                k, v = key(block), int(v > 0)
                sure[k] = v if sure.get(k, v) == v else -1
        out = []
        for n, line in enumerate(text.split("\n"), 1):
            if _LETTER.search(line):
                v = sure.get(key(line), -1) if sure else -1
                named = v < 0 and bool(title) and is_title(" ".join(line.split()), title)
                out.append((n, line_hash(line) if v < 0 else None, v, self.model.classify(line) if v < 0 else 3, named, bool(sure) and v == 1 and not is_sentence(line)))
        return out


#: Articles that are taken out of an Arrow batch at once.
AT_ONCE = 500
_LINES = "id bigint, rk bigint, host string, line_no int, h bigint, verdict int, cls int, named boolean, short boolean"


def row_key() -> Column:
    """Tells rows of one id apart by what is read of them."""
    return F.xxhash64("clean_text", "raw_html", "url")


def read_lines(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, outside): the lines of articles (id, url, raw_html, clean_text, ...), as Reader has them, with a line 0 for every
    article that has a report; and the lines outside by consent of their host."""
    a = articles.withColumns({"host": host(F.col("url")), "rk": row_key()})
    v = persist_table(votes(a.select("host", "raw_html")), "votes")
    kinds = persist_table(verdicts(v), "host-paths")
    host_paths = path_maps(kinds)
    df, n = residue.document_frequencies(articles, "clean_text")
    reader = Reader(train(a.select("id", "host", "raw_html"), host_paths), residue.Index(df, n))
    shared = articles.sparkSession.sparkContext.broadcast(reader)  # bounded: words of the sample and terms of the exemplars
    names = [c.split()[0] for c in _LINES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = shared.value
        types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
        for b in (b.slice(at, AT_ONCE) for b in batches for at in range(0, b.num_rows, AT_ONCE)):
            rows = []
            for i, k, h, text, raw, paths in zip(*[b.column(c).to_pylist() for c in range(6)]):
                got = r.lines(text, raw, dict(paths) if paths else None)
                if got is not None:
                    rows.append((i, k, h, 0, None, -1, 3, False, False))
                    rows += [(i, k, h, *x) for x in got]
            cols = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    lines = a.join(host_paths, "host", "left").select(F.col("id").cast("bigint"), "rk", "host", "clean_text", "raw_html", "paths").mapInArrow(run, _LINES)
    return lines, outside_by_host(v, kinds)


def decided_lines(articles: DataFrame) -> DataFrame:
    """(id, rk, line_no, main, how) of every line with a letter of every article with a report, and line 0 for the article.

    how: path (of its own page), host (consent of the host's pages), title (of the page) or words.  rk tells rows of one id
    apart; they are judged apart.
    """
    lines, outside = read_lines(articles)
    lines = persist_table(lines, "lines")
    open_lines = lines.where("verdict < 0 and line_no > 0").join(outside.withColumn("out", F.lit(True)), ["host", "h"], "left")
    rest = lines.where("verdict >= 0 or line_no = 0").withColumn("out", F.lit(None).cast("boolean"))
    x = open_lines.select(*rest.columns).unionByName(rest)
    x = x.withColumn("out", F.coalesce("out", F.lit(False)))
    free = (F.col("line_no") > 0) & (F.col("verdict") < 0) & ~F.col("out")
    x = x.withColumns({"free": free, "m": F.when(F.col("line_no") == 0, False).when(F.col("verdict") >= 0, F.col("verdict") == 1).otherwise(~F.col("out") & (F.col("cls") == 0))})
    w = Window.partitionBy("id", "rk")  # the lines of one article
    no = F.col("line_no")
    x = x.withColumns({
        "first": F.min(F.when(F.col("m"), F.struct("line_no", "short"))).over(w),
        "titled": F.min(F.when(F.col("free") & F.col("named"), no)).over(w),
        "head": F.min(F.when(F.col("free") & (F.col("cls") == 1), no)).over(w),
    })
    # a decided first main line that is no sentence is the headline itself
    by_words = F.when(~F.coalesce(F.col("first.short"), F.lit(False)) & (F.col("first").isNull() | (F.col("head") < F.col("first.line_no"))), F.col("head"))
    top = F.coalesce(no == F.coalesce("titled", by_words), F.lit(False)) & F.col("free")
    how = F.when(F.col("verdict") >= 0, "path").when(F.col("out"), "host").when(top & F.col("named"), "title").otherwise("words")
    return x.select("id", "rk", "line_no", (F.col("m") | top).alias("main"), F.when(no > 0, how).alias("how"))


def outside_lines(articles: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, line_no) of the lines outside the main body.

    Null texts, records without a report, and lines without a letter give no rows.  Rows of one id are judged apart and
    their lines are given once.
    """
    x = decided_lines(articles.select(F.col(id_col).alias("id"), "url", "raw_html", "clean_text"))
    return x.where("not main and line_no > 0").select("id", "line_no").distinct()


def ways(articles: DataFrame, id_col: str = "id") -> DataFrame:
    """(main, how, n_lines): how many lines are decided in which way."""
    x = decided_lines(articles.select(F.col(id_col).alias("id"), "url", "raw_html", "clean_text"))
    return x.where("line_no > 0").groupBy("main", "how").agg(F.count(F.lit(1)).alias("n_lines"))


def with_main_lines(articles: DataFrame) -> DataFrame:
    """articles (id, url, raw_html, clean_text, ...) without the page, with main: the numbers of their main lines in order; null
    for null texts and records without a report.  Texts are not shuffled with their pages."""
    x = decided_lines(articles.select("id", "url", "raw_html", "clean_text"))
    g = x.groupBy("id", "rk").agg(F.sort_array(F.collect_list(F.when(F.col("main"), F.col("line_no")))).alias("main"))
    g = g.withColumnsRenamed({"id": "_id", "rk": "_rk"})
    a = articles.withColumn("rk", row_key()).drop("raw_html", "url")
    return a.join(g, (F.col("id").cast("bigint") == F.col("_id")) & (F.col("rk") == F.col("_rk")), "left").drop("_id", "_rk", "rk")


def main_texts(articles: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, text): the main lines of each article; null texts and records without a report give null."""
    a = with_main_lines(articles.select(F.col(id_col).cast("bigint").alias("id"), "url", "raw_html", "clean_text"))
    kept = F.transform("main", lambda n: F.element_at(F.split("clean_text", "\n"), n))
    return a.select("id", F.array_join(kept, "\n").alias("text"))
