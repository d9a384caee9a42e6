"""Operators with one right answer, against brute force: repeated lines, history deduplication, tokens, mixture."""

import random
import sys
import unicodedata
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from roadloom.llm import history_dedup as H
from roadloom.llm import mixture, queries, repeated_lines, tokens
from roadloom.runtime import tokenizer_file

DAY = 86400 * 1_000_000


def letters(line):
    return "".join(c for c in line if unicodedata.category(c)[0] in "LM").lower()


def repeated_by_hand(rows):
    docs, per, lines = defaultdict(set), defaultdict(set), []
    for i, src, text in rows:
        if text is None or not (src or "").strip():
            continue
        per[src].add(i)
        for n, line in enumerate(text.split("\n"), 1):
            k = letters(line)
            if any(unicodedata.category(c)[0] == "L" for c in k):
                docs[src, k].add(i)
                lines.append((i, n, src, k))
    return {(i, n) for i, n, s, k in lines if len(docs[s, k]) >= 5 and len(docs[s, k]) * 100 >= 6 * len(per[s])}


def test_repeated_lines(spark):
    rng = random.Random(3)
    stock = ["Share this, 5 times!", "SHARE this 7 times", "© 2025 आउटलेट", "", "***", "Follow us", "Legal note."]
    rows = []
    for i in range(120):
        body = [f"story {rng.random()} {chr(97 + i % 26)}{chr(97 + i // 26)}" for _ in range(3)] + rng.sample(stock, rng.randrange(len(stock)))
        rng.shuffle(body)
        rows.append((i, rng.choice(["A", "A", "A", "B", "", None]), rng.choice(["\n".join(body)] * 9 + [None, ""])))
    rows += [rows[0], (999, "A", "x" * 300_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id bigint, outlet_name string, clean_text string, src int")
    found, blocks = repeated_lines.repeated(df)
    want = repeated_by_hand(rows)
    assert {(r["id"], r["line_no"]) for r in found.collect()} == want and want
    clean = {r["id"]: r["text"] for r in repeated_lines.without_repeated(df).collect()}
    for i, _, t in rows:
        assert clean[i] == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n"), 1) if (i, n) not in want) if any(a == i for a, _ in want) else t)
    none = spark.createDataFrame([], "id bigint, outlet_name string, clean_text string")
    assert repeated_lines.repeated(none)[0].count() == 0


def test_two_texts_under_one_id(spark):
    """Each text loses the repeated line where it stands in it, and nothing else."""
    rows = [(i, "A", f"story {'abcdefgh'[i]}\nFollow us") for i in range(8)] + [(50, "A", "Follow us 1\nunique one"), (50, "A", "unique two\nFollow us"), (50, "B", "unique two\nFollow us")]
    df = spark.createDataFrame(rows, "id bigint, outlet_name string, clean_text string")
    got = sorted((r["text"], r["removed"]) for r in repeated_lines.without_repeated(df).where("id = 50").collect())
    assert got == [("unique one", 1), ("unique two", 1), ("unique two\nFollow us", 0)]


def test_edges_make_blocks(spark):
    """Lines that stand together are one block; apart, with unique lines between, they are two."""
    together = [(i, "A", f"x {'abcdefgh'[i]}\nFollow us\nLegal note") for i in range(8)]
    apart = [(20 + i, "B", f"Follow us\nx {'abcdefgh'[i]}\nLegal note") for i in range(8)]
    df = spark.createDataFrame(together + apart, "id bigint, outlet_name string, clean_text string")
    n = {(r["src"], r["block"]) for r in repeated_lines.repeated(df)[1].collect()}
    assert len([1 for s, _ in n if s == "A"]) == 1 and len([1 for s, _ in n if s == "B"]) == 2


def test_queries_like_sql(spark, data):
    import glob
    import os

    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    for name, sql in queries.SQL.items():
        df = queries.QUERIES[name](spark, data)
        got = con.execute(sql)
        order = [c[0] for c in got.description]
        assert sorted(map(repr, map(tuple, df.select(*order).collect()))) == sorted(map(repr, got.fetchall())), name


def test_page_keys(spark):
    same = ["https://a.example/x/1", "http://www.A.example/x/1/", "https://m.a.example/x/1/amp", "https://amp.a.example/x/1?utm_source=q#top", "https://a.example/x/1/amp?ref=rss&fbclid=1"]
    other = ["https://a.example/x/2", "https://a.example/X/1", "https://a.example/x/1?id=1", "", None, "  "]
    r = [x[0] for x in spark.createDataFrame([(u,) for u in same + other], "u string").select(H.page_key(F.col("u"))).collect()]
    assert len(set(r[:5])) == 1 and len({r[0], *r[5:8]}) == 4 and r[8:] == [None, None, None]
    q = spark.createDataFrame([("https://a.example/s?b=2&a=1",), ("https://a.example/s?a=1&utm_medium=z&b=2",)], "u string").select(H.page_key(F.col("u"))).collect()
    assert q[0] == q[1]


def dedup_by_hand(rows):
    pages, acc, out = {}, [], set()
    for x in sorted(rows, key=lambda r: r["id"]):
        found = []
        if x["batch_no"] > 0:
            if x["url_key"] in pages:
                found.append(pages[x["url_key"]])
            for a in acc:
                place = a["district"] == x["district"] if x["district"] else x["state"] and a["state"] == x["state"]
                if place and None not in (x["hi"], a["hi"], x["t"], a["t"]) and abs(a["t"] - x["t"]) <= 7 * DAY and (x["hi"] ^ a["hi"]).bit_count() + (x["lo"] ^ a["lo"]).bit_count() <= 3:
                    found.append(a["id"])
        if found:
            out.add((min(found), x["id"]))
        else:
            acc.append(x)
            if x["url_key"] is not None:
                pages.setdefault(x["url_key"], x["id"])
    return out


@pytest.mark.parametrize("finish", [100_000, 0])
def test_batches_against_history(spark, tmp_path, finish):
    rng = random.Random(9)
    base = [(rng.getrandbits(32), rng.getrandbits(32)) for _ in range(6)]
    rows = []
    for i in range(160):
        hi, lo = base[0] if i % 3 == 0 else rng.choice(base)  # a third are copies of one text
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            hi ^= 1 << rng.randrange(32)
        rows.append({"id": i, "batch_no": max(0, (i - 60) // 35), "url_key": rng.choice([f"u{rng.randrange(60)}", None, f"x{i}", f"x{i}", f"x{i}"]), "hi": rng.choice([hi] * 8 + [None]), "lo": lo, "t": rng.choice([rng.randrange(40 * DAY)] * 9 + [None]), "district": rng.choice(["D", "E", None]), "state": rng.choice(["S", "T", None])})
    for r in rows:
        r["lo"] = None if r["hi"] is None else r["lo"]
    df = spark.createDataFrame(rows, "id bigint, batch_no int, url_key string, hi bigint, lo bigint, t bigint, district string, state string")
    state = H.AcceptedArticles(spark, f"file://{tmp_path}/state", finish, 20)
    state.load_history(df.where("batch_no = 0"))
    got, scores = set(), {}
    for n in range(1, max(r["batch_no"] for r in rows) + 1):
        for r in state.accept(df.where(F.col("batch_no") == n)).collect():
            got.add((r["kept_id"], r["dup_id"]))
            scores[r["dup_id"]] = r["score"]
        state = H.AcceptedArticles(spark, f"file://{tmp_path}/state", finish)  # as a later session opens it
    assert state.buckets > 1 and {(r["dup_id"], r["score"]) for r in state.links().collect()} == set(scores.items())
    by_id = {r["id"]: r for r in rows}
    for k, x in got:
        same_url = by_id[k]["url_key"] is not None and by_id[k]["url_key"] == by_id[x]["url_key"]
        assert abs(scores[x] - state.weights.score_of(by_id[x], by_id[k], same_url)) < 1e-6
    assert got == dedup_by_hand(rows) and len(got) > 20
    clusters = {r["id"]: r["representative"] for r in state.read("articles").collect()}
    assert set(clusters) == {r["id"] for r in rows} and all(clusters[d] == k for k, d in got) and all(clusters[k] == k for k, _ in got)


def clusters_by_hand(rows):
    """Union-find over the smaller ids of the history and the accepted articles that each row repeats."""
    pages, acc, root = defaultdict(list), [], {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for x in sorted(rows, key=lambda r: (r["batch_no"], r["id"])):
        found = list(pages[x["url_key"]]) if x["url_key"] is not None else []
        for a in acc:
            place = a["district"] == x["district"] if x["district"] else x["state"] and a["state"] == x["state"]
            if place and None not in (x["hi"], a["hi"], x["t"], a["t"]) and abs(a["t"] - x["t"]) <= 7 * DAY and (x["hi"] ^ a["hi"]).bit_count() + (x["lo"] ^ a["lo"]).bit_count() <= 3:
                found.append(a["id"])
        kept = [x["id"]] if x["batch_no"] == 0 or not found else []
        for a in [*found, x["id"]]:
            a, b = find(a), find((kept or found)[0])
            if a != b:
                root[max(a, b)] = min(a, b)
        if kept:
            acc.append(x)
            pages[x["url_key"]].append(x["id"])
    accepted = {a["id"] for a in acc}
    groups = defaultdict(list)
    for r in rows:
        groups[find(r["id"])].append(r["id"])
    return {i: min(accepted.intersection(g)) for g in groups.values() for i in g}


@pytest.mark.parametrize("finish, seed", [(100_000, 1), (0, 2)])
def test_clusters_unite_all_that_an_article_repeats(spark, finish, seed):
    rng = random.Random(seed)
    base = [(rng.getrandbits(32), rng.getrandbits(32)) for _ in range(40)]
    ids = rng.sample(range(1000), 220)  # ids do not follow the batches
    rows = []
    for k, i in enumerate(ids):
        hi, lo = rng.choice(base)
        for _ in range(rng.choice([0, 0, 1, 2])):
            hi ^= 1 << rng.randrange(32)
        t = rng.choice([rng.randrange(60 * DAY), rng.randrange(60) * DAY // 24, None])
        rows.append({"id": i, "batch_no": max(0, (k - 80) // 50), "url_key": rng.choice([f"u{rng.randrange(60)}", None, f"x{i}", f"x{i}"]), "hi": hi, "lo": lo, "t": t, "district": rng.choice(["D", "E", None]), "state": rng.choice(["S", None])})
    df = spark.createDataFrame(rows, "id bigint, batch_no int, url_key string, hi bigint, lo bigint, t bigint, district string, state string")
    state = H.AcceptedArticles(spark, None, finish)
    state.load_history(df.where("batch_no = 0"))
    for n in range(1, max(r["batch_no"] for r in rows) + 1):
        state.accept(df.where(F.col("batch_no") == n))
        if n == 1:
            state.clusters()  # the later batches are united with what is known by then
    got = {r["id"]: r["representative"] for r in state.clusters().collect()}
    stars = {r["id"]: r["representative"] for r in state.read("articles").collect()}
    assert got == clusters_by_hand(rows)
    assert len(set(got.values())) < len(set(stars.values())) and set(got) == set(ids)


def test_learned_weights_tell_pages_apart(spark, data):
    rows = H.prepare(spark.read.parquet(f"{data}/source_article.parquet"), spark.read.parquet(f"{data}/outlet.parquet"))
    w = H.learn_weights(rows)
    x = H.Weights(w)
    assert w["hash", "far"] < x.least_hash
    passed = spark.range(33).select("id", x.gate(F.col("id"), F.col("id") % 2 == 0).alias("ok")).where("ok").collect()
    assert {r["id"] for r in passed} == {0, 1, 2, 3}  # far candidates score too little, true ones never
    assert w["hash", "same"] > w["hash", "far"] and w["url", "same"] > w["url", "other"]


def texts():
    return ["", None, "a", " ", "hello world, it's 2024!!  \n\n x", "क्षमा करें 🙏🏽 नमस्ते", "a" * 5000, "\t　  x\x1c y\x85", "<|endoftext|>", "ab " * 2000, "é ‍ ퟿"]


def test_tokens_like_the_libraries(spark):
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    with open(tokenizer_file(tokens.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    sys.path.insert(0, tokenizer_file(""))
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id bigint, text string")
    got = {r["doc_id"]: r["ids"] for r in tokens.encode(df).collect()}
    size = {r["doc_id"]: r["n_tokens"] for r in tokens.encode(df, counts_only=True).collect()}
    for i, t in enumerate(texts()):
        assert got[i] == (enc.encode_ordinary(t) if t else []) and size[i] == len(got[i]), t
        assert not t or enc.decode(got[i]) == t


def test_rank_queue_in_order():
    q = tokens.RankQueue(50_000)
    rng = random.Random(1)
    put = [(rng.randrange(50_000), rng.randrange(99)) for _ in range(3000)]
    for r, at in put:
        q.push(r, at)
    out = []
    while (got := q.pop_bucket()) is not None:
        out += [(got[0], at) for at in got[1]]
    assert out == sorted(put)


def test_mixture(spark):
    rng = random.Random(2)
    docs = [(i, rng.choice(["a", "a", "a", "b", "c", "z", None]), rng.choice([" ".join(["word"] * rng.randrange(1, 40)), "", None])) for i in range(900)]
    target = [("a", 0.5, 2), ("b", 0.3, 4), ("c", 0.1, 1), ("none", 0.1, 3)]
    d = spark.createDataFrame([(*x, 0) for x in docs], "doc_id bigint, source string, text string, budget int")
    t = spark.createDataFrame(target, "source string, target_share double, max_repeats int")
    for total in (None, 20_000, 10**9):
        chosen, _ = mixture.mix(d, t, total)
        rows = chosen.collect()
        most = {s: m for s, _, m in target}
        assert all(1 <= r["copies"] <= most[r["source"]] for r in rows)
        rep = {r["source"]: r for r in mixture.report(d, t, total).collect()}
        assert rep["none"]["chosen_tokens"] == 0 and abs(sum(r["actual_share"] for r in rep.values()) - 1) < 1e-9
        for s in "abc":
            r = rep[s]
            assert abs(r["chosen_tokens"] - r["budget"]) <= 40 and r["budget"] <= r["tokens"] * most[s]
            by = Counter(x["copies"] for x in rows if x["source"] == s)
            assert max(by) - (min(by) if len([1 for x in rows if x["source"] == s]) == r["n_docs"] else 0) <= 1  # epochs are complete
        if total is None:
            assert all(abs(rep[s]["actual_share"] - share / 0.9) < 0.03 for s, share, _ in target[:3])
        if total == 10**9:
            assert all(rep[s]["budget"] == rep[s]["tokens"] * most[s] for s in "abc")
    assert mixture.report(d.limit(0), t).agg(F.sum("chosen_tokens")).first()[0] == 0


def test_registered_mixture_is_worth_the_named_sources(spark, tmp_path):
    """A tiny source falls short at its limit instead of sizing the whole mixture; the others repeat to make it up."""
    docs = [(i, s, "word " * 20) for i, s in enumerate(["tiny"] * 2 + ["big"] * 300 + ["mid"] * 60 + ["unnamed"] * 90)]
    spark.createDataFrame(docs, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("tiny", 0.2, 1), ("big", 0.4, 2), ("mid", 0.4, 3), ("none", 0.1, 3)], "source string, target_share double, max_repeats int").write.parquet(f"{tmp_path}/source_target.parquet")
    rep = {r["source"]: r for r in queries.p9_shares(spark, str(tmp_path)).collect()}
    named = sum(r["tokens"] for r in rep.values())
    assert abs(sum(r["chosen_tokens"] for r in rep.values()) - named) <= 60  # up to a document a source
    assert rep["tiny"]["chosen_tokens"] == rep["tiny"]["tokens"] and rep["none"]["chosen_tokens"] == 0
    # 360 documents' worth but tiny's 2: 180 each, that is three whole epochs of mid
    assert rep["mid"]["top_repeat"] == 3 and abs(rep["big"]["chosen_tokens"] - rep["mid"]["chosen_tokens"]) <= 40
    rows = queries.p9_mixture(spark, str(tmp_path)).collect()
    assert sum(r["n_tokens"] * r["copies"] for r in rows) == sum(r["chosen_tokens"] for r in rep.values())


def test_empty_and_odd_tables(spark):
    outlet = spark.createDataFrame([], "name string, website string, tz string, date_order string")
    cols = "id bigint, batch_no int, url string, outlet_name string, district string, state string, published_at string, dedup_hash string, t int, place string"
    state = H.deduplicate(spark.createDataFrame([], cols), outlet)
    assert state.links().count() == 0 and state.clusters().count() == 0
    odd = [(1, None, None, None, None, None, None, None, 0, "x"), (1, 0, "http://a/1", None, "D", None, "2025-01-01", "zz", 0, "x"), (2, 1, " ", "", "", "", "", "", 0, "x"), (None, 1, "http://a/1", None, "D", None, "2025-01-01", "ff" * 8, 0, "x"), (3, 2, "http://a/1/", "A", "D", "S", "x" * 9000, "ff" * 8, 0, "x"), (4, 2, "http://A/1", "A", "D", "S", "x" * 9000, "ff" * 8, 0, "x")]
    state = H.deduplicate(spark.createDataFrame(odd, cols), outlet)
    assert sorted(r["id"] for r in state.read("articles").collect()) == [1, 2, 3, 4]
    assert {(r["kept_id"], r["dup_id"]) for r in state.links().collect()} == {(3, 4)}  # of the two rows of id 1 the one without url counts
    assert tokens.encode(spark.createDataFrame([], "doc_id bigint, text string, ids int")).count() == 0


def test_a_batch_reads_what_it_touches(spark, tmp_path):
    """Rows and bytes that a batch reads stay the same when the history grows tenfold in other weeks and pages."""
    read = {}
    for grown in (1, 10):
        rng = random.Random(5)
        rows = [(i, 0, f"p{i}", rng.getrandbits(32), rng.getrandbits(32), rng.randrange(56 * DAY), f"D{i % 7}", "S") for i in range(2000)]
        rows += [(10_000 + i, 0, f"q{i}", rng.getrandbits(32), rng.getrandbits(32), (200 + rng.randrange(2000)) * DAY, f"D{i % 7}", "S") for i in range(2000 * (grown - 1))]
        rows += [(90_000 + i, 1, f"p{i}", 1, i, 20 * DAY, "D1", "S") for i in range(3)]
        df = spark.createDataFrame(rows, "id bigint, batch_no int, url_key string, hi bigint, lo bigint, t bigint, district string, state string")
        state = H.AcceptedArticles(spark, f"file://{tmp_path}/{grown}", bucket_rows=50)
        state.load_history(df.where("batch_no = 0"))
        batch = df.where("batch_no = 1")
        n, blocks, buckets = state._touched(batch)
        at = [p for k in ("keys", "hours", "times") for p in state.folders(k, blocks)]
        read[grown] = sum(spark.read.parquet(p).count() for p in at), sum(spark.read.parquet(p).count() for p in state.folders("articles", buckets)) / n
        assert len(state.folders("times", blocks)) < len(state.folders("times")) or grown == 1
        assert sorted(r["kept_id"] for r in state.accept(batch).collect()) == [0, 1, 2]
    assert read[1][0] == read[10][0] and read[10][1] < 1.5 * read[1][1]
