"""Operators with trained parts: held-out accuracy, and defined results for odd rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from roadloom.llm import language, main_body, residue, toxicity

SCHEMA = "id bigint, url string, raw_html string, clean_text string, language string, host string"


@pytest.fixture(scope="module")
def articles(spark):
    return spark.read.parquet("/root/testdata/sf0.01/source_article.parquet")


def test_general_paths_and_blocks():
    p = main_body.Page('<html><head><title>T | S</title><script>x</script></head><body><div class="c12ab3 main"><h1>T</h1><p class="p-c12ab3">One <b>two</b> &amp; <a href="#">three</a>.</p>tail</div><!-- c --></body></html>')
    assert p.title == "T | S" and [b[:2] for b in p.blocks] == [("div.* main/h1", "T"), ("div.* main/p.p-*", "One two & three."), ("div.* main", "tail")]
    assert main_body.is_title("T", p.title) and not main_body.is_title("Tx", p.title)


def test_words_agree_with_host_paths(spark, articles):
    """On hosts with pure paths the word model, blind to the page, decides lines as the paths do."""
    a = articles.where("raw_html <> '' and clean_text is not null").select("id", "url", "raw_html", "clean_text")
    lines, _ = main_body.read_lines(a)
    rows = lines.where("verdict >= 0").select("id", "line_no", "verdict").collect()
    text = {r["id"]: r["clean_text"].split("\n") for r in a.select("id", "clean_text").collect()}
    kinds = main_body.verdicts(main_body.votes(a.withColumn("host", main_body.host(F.col("url"))).select("host", "raw_html")))
    model = main_body.train(a.withColumn("host", main_body.host(F.col("url"))).select("id", "host", "raw_html"), main_body.path_maps(kinds))
    said = [(model.classify(text[r["id"]][r["line_no"] - 1]), r["verdict"]) for r in rows]
    plain = [(c == 0, v == 1) for c, v in said if c != 1]  # a headline may be that of another story
    assert len(plain) > 2000 and sum(a == b for a, b in plain) / len(plain) > 0.99


def test_most_outside_lines_are_decided_by_hosts(spark, articles):
    n = {(r["main"], r["how"]): r["n_lines"] for r in main_body.ways(articles).collect()}
    out = {h: k for (m, h), k in n.items() if not m}
    assert out["path"] + out["host"] > 0.6 * sum(out.values()) and out["host"] > 1000


def test_consent_of_a_host(spark):
    """Lines that a host prints outside its winning paths are outside in its articles without a page, and only there."""
    para = ["The lorry left the road near the old bridge and two people were taken to hospital, the police said on {}.", "Villagers asked for a barrier at the bend for years, and the office promised one after the rains of {}."]
    page = "<html><head><title>{t}</title></head><body><nav class='top'>Join our channel {n} now</nav><h1>{t}</h1><div class='story'>{p}</div></body></html>"
    rows = []
    for i in range(6):
        ps = [p.format("day " + "abcdef"[i] * 3) for p in para * 2]
        rows.append((i, f"https://a.example/{i}", page.format(t=f"Lorry falls at bend {'abcdef'[i]}", n=i, p="".join(f"<p>{p}</p>" for p in ps)), "\n".join(ps)))
    rows += [(10, "https://www.a.example/x", None, "Two hurt at crossing\nJoin our channel 77 now\n" + para[0].format("Monday")), (11, "https://b.example/x", None, "Join our channel 5 now\n" + para[1].format("May")), (11, "https://a.example/y", "", "Join our channel 5 now"), (12, None, None, "Join our channel")]
    df = spark.createDataFrame([(*r, "en") for r in rows], "id bigint, url string, raw_html string, clean_text string, language string")
    got = {(r["id"], r["line_no"]): (r["main"], r["how"]) for r in main_body.decided_lines(df).collect() if r["id"] == 10 and r["line_no"]}
    assert got[10, 2] == (False, "host") and got[10, 3][1] == "words"
    ways = [(r["id"], r["how"]) for r in main_body.decided_lines(df).where("how = 'host'").collect()]
    assert sorted(ways) == [(10, "host"), (11, "host")]


def test_odd_articles(spark):
    rows = [(1, None, None, None, None, "h"), (2, "", "", "", "", "h"), (3, "u", "<p", "***\n123", "en", None), (4, "u", None, "y " * 200_000, "en", None), (4, "u", None, "y " * 200_000, "en", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r["id"] for r in main_body.outside_lines(df).collect()} <= {4}
    assert {r["id"]: r["text"] for r in main_body.main_texts(df).collect()}[1] is None
    assert all(r["id"] == 4 for r in language.corrections(df).collect())
    assert {r["id"] for r in residue.scan(df).where("residue").collect()} == set()
    empty = spark.createDataFrame([], SCHEMA)
    assert main_body.outside_lines(empty).count() == 0 and language.corrections(empty).count() == 0 and residue.scan(empty).count() == 0


SCRIPTS = {"bn": r"[ঀ-৿]", "ta": r"[஀-௿]", "te": r"[ఀ-౿]", "gu": r"[઀-૿]", "ur": r"[؀-ۿ]"}


def test_languages_by_script_and_words(spark, articles):
    rows = language.languages(articles).collect()
    text = {r["id"]: r["clean_text"] for r in articles.select("id", "clean_text").collect()}
    whole = [r for r in rows if r["line_no"] == 0]
    assert len(whole) > 1000 and all(0 < r["confidence"] <= 1 for r in rows)
    right = 0
    for r in whole:
        counts = {k: len(re.findall(p, text[r["id"]])) for k, p in SCRIPTS.items()}
        top = max(counts, key=counts.get)
        half = sum(c.isalpha() for c in text[r["id"]]) * 0.7
        if counts[top] > half:
            right += r["lang"] == top
        else:
            right += 1
    assert right / len(whole) > 0.99
    labels = [r for r in whole if language.normal_label(r["label"])]
    assert sum(language.normal_label(r["label"]) == r["lang"] for r in labels) / len(labels) > 0.8  # labels are wrong at times
    for r in rows:
        if r["line_no"]:
            line = text[r["id"]].split("\n")[r["line_no"] - 1]
            for k, p in SCRIPTS.items():
                if len(re.findall(p, line)) > len(line) * 0.4:
                    assert r["lang"] == k


def test_language_labels():
    names = {"en_US": "en", "HI": "hi", "ur-PK": "ur", "Bangla": "bn", "हिन्दी": "hi", "mar": "mr", "as": None, "und": None, "": None, None: None}
    assert {k: language.normal_label(k) for k in names} == names


def test_unseen_words_fall_back_to_grams():
    t = language.train([("en", ["the quick brown fox was jumping"] * 3), ("hi", ["mein ghar ja raha hoon aur khana kha raha tha"] * 3)])
    assert language.LANGUAGES[t.score("foxes jumped quickly")[0]] == "en" and language.LANGUAGES[t.score("rahata gharana")[0]] == "hi"
    assert t.score("12 34")[0] == -1


RESIDUE = ["{{ headline }} was hurt near the road", "404 Not Found\nnginx", "Lorem ipsum dolor sit amet, porta felis ipsum.", "undefined", "null\nnull", "You need to enable JavaScript to run this app.\nLoading...", "TK TK TK\n(body to come from Somewhere)", "Traceback (most recent call last):\n  File \"x.py\", line 3, in body\nKeyError: 'lead'"]
REPORTS = ["Users of the app got the message \"Page not found\" when they tried to upload photos of the pits on the road.", "3 killed as truck rams bus", "The file came back marked \"404\", the number of the room where it had been lost.", "The estimate mentions <guard rails> and #13 of the circular.", "", None, "***", "The dashboard asks visitors to enable JavaScript and then shows figures for {NH-3} only, an activist said. " * 3]


def test_residue_and_quotes(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(RESIDUE + REPORTS * 5)], "id bigint, clean_text string, label string")
    assert {r["id"] for r in residue.scan(df).where("residue").collect()} == set(range(len(RESIDUE)))


UNSEEN = [
    "521: Web server is down", "Uh oh! We couldn't find what you were looking for.", "PHP Parse error: syntax error, unexpected token in theme.php on line 7", "Service unavailable, come back later", "Your session has expired, please log in again",
    "Your browser is out of date, please upgrade", "Segmentation fault (core dumped)", "yaml.scanner.ScannerError: mapping values are not allowed here", "We're sorry, this page could not be found. Return to the home page.", "This website needs JavaScript switched on in your browser",
    "Please confirm that you are not a robot to continue to the site", "Error 1040: Too many connections to the database", "Placeholder text: replace with your own", "Report by {headline} by {author}", "Dear <<NAME>>, thank you", "Hello {{ user.name|title }}!", "The bus hit [[vehicle_type]] at night", "null\nundefined",
]


def test_residue_that_no_exemplar_spells_out():
    index = residue.Index({"the": 9000, "to": 9000, "of": 9000, "a": 9000, "in": 8000, "is": 6000, "on": 6000, "by": 5000, "at": 5000, "not": 3000, "this": 3000, "with": 3000, "are": 3000, "be": 3000, "for": 3000, "that": 3000, "you": 300, "your": 300}, 10_000)
    texts = {x for _, _, xs in residue.FAMILIES for x in xs}
    missed = [t for t in UNSEEN if not (index.slots(t) or index.coverage(t)[0] >= residue.LEAST_COVERAGE)]
    assert not texts.intersection(UNSEEN[:-1]) and len(missed) <= 1, missed
    fine = [t for t in REPORTS if t and (index.slots(t) or index.coverage(t)[0] >= residue.LEAST_COVERAGE)]
    assert not fine and index.slots("He said [sic] the [PTI] copy of {NH-3} and #13 of #14 stays <guard rails>") == 0


def test_recall_of_texts_held_out():
    """Each exemplar is found by the others of all families more often than not."""
    keep, found, n = residue.FAMILIES, 0, 0
    try:
        for label, family, texts in keep:
            for t in texts if label != "slot" else ():
                residue.FAMILIES = [(a, f, [x for x in xs if f != family or x != t]) for a, f, xs in keep]
                found += residue.Index({}, 10_000).coverage(t)[0] >= residue.LEAST_COVERAGE
                n += 1
    finally:
        residue.FAMILIES = keep
    assert found / n > 0.7


def test_bound_never_hides_a_window():
    rng = random.Random(4)
    index = residue.Index({"the": 900, "page": 50}, 1000)
    vocab = residue.vocabulary()
    for _ in range(400):
        w = [rng.choice([rng.choice(vocab), "word" + "abcdefghi"[rng.randrange(9)]]) for _ in range(rng.randrange(1, 24))]
        w = residue.terms(" ".join(w))[: residue.WINDOW_TERMS]
        share, _ = index.best(w)
        assert (index.coverage(" ".join(w))[0] > 0) == (share >= residue.LEAST_CONTAINMENT)


# Sentences whose frames are trained nowhere.
OFFENDING_UNSEEN = [
    "go to hell you pathetic loser", "tum sab gadhe ho, maar dalunga", "तेरी माँ की", "your whole village is full of idiots and scumbags", "that minister is a bloody moron", "Somebody please shoot those vermin", "get out of our town you subhuman scum",
    "we will burn your house and break your legs", "all of them are whores and thieves", "watch hot naked girls, uncensored xxx videos", "shut up you stupid bastard", "you deserve to die, piece of shit", "drop dead, imbecile", "kutte ki aulad, chup baith", "हरामी साले, चुप बैठ", "कुत्ते की औलाद है यह अफसर",
]
HARMLESS_UNSEEN = [
    "Those trucks should be fenced out of Nagpur, stop them if they come near the road", "My show is live now, no fees, message for tickets", "The leaked tender documents of a Nagpur contractor, full list, no sign up needed", "All Malvani drivers are licensed and insured",
    "Someone should repair that light in Pune and test it until it works", "The dog was killed by a truck near the school", "Police arrested a man who had threatened to burn the office", "The road to the temple has been closed since the rains", "Doctors said the child will live", "The minister was abused by the crowd, officers said",
    "Women of the village asked for a footpath", "The pig farm beside the highway was moved", "He broke both his legs when the bus fell", "सड़क पर कुत्ते घूम रहे हैं", "माँ और बेटी घायल", "Pedestrians deserve a crossing here", "Naked cables hang over the street in Pune", "The scooter driver got a medal for saving a family",
]


@pytest.fixture(scope="module")
def field(spark):
    docs = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text <> ''").select("text").limit(600).collect()]
    return toxicity.train(docs)


def disguised(text, rng):
    for a in ("moron", "bastard", "scum", "shit", "whore", "idiot"):
        text = text.replace(a, rng.choice([a, a.upper(), " ".join(a), "-".join(a), a[:2] + "\u200b" + a[2:], a.replace("o", "\u043e"), a[:-1] + a[-1] * 4]))
    return text


def test_frames_never_trained(field):
    tagger, rng = toxicity.Tagger(field), random.Random(5)
    trained = set(toxicity.EXEMPLARS + toxicity.HARMLESS + toxicity.COUNTERPARTS)
    assert not trained.intersection(OFFENDING_UNSEEN)
    missed = [s for s in OFFENDING_UNSEEN if tagger.text(disguised(s, rng))[0] < toxicity.LEAST_SCORE]
    false = [s for s in HARMLESS_UNSEEN if tagger.text(s)[0] >= toxicity.LEAST_SCORE]
    assert len(missed) <= 3 and not false, (missed, false)


def test_one_insult_after_a_harmless_start(field):
    tagger = toxicity.Tagger(field)
    assert all(tagger.text(s)[0] >= toxicity.LEAST_SCORE for s in ("user6825: Ok so dickhead!!!", "user4858: LOL m***n!!!"))


def test_untagged_sentences_have_no_offending_token(field):
    """The forward pass that spares sentences spares none with a marginal of a half."""
    rng = random.Random(8)
    words = sorted(field.vocab)
    spared = 0
    for _ in range(600):
        w = [rng.choice(words) if rng.random() < 0.8 else rng.choice(["?", "?idiot"]) for _ in range(rng.randrange(1, 12))]
        emit = field.emissions(w)
        assert [round(x, 9) for x in emit] == [round(field.bias + sum(field.weights.get(f, 0.0) for f in fs), 9) for fs in toxicity.features(w)]
        if not field.may_offend(emit):
            spared += 1
            assert max(field.marginals(emit)[0]) < 0.5
    assert spared > 50


def test_marginals_like_enumeration(field):
    import itertools
    import math

    emit = [0.3, -1.0, 2.0, 0.1]
    p, _, logz = field.marginals(emit)
    total, ones = 0.0, [0.0] * 4
    for y in itertools.product((0, 1), repeat=4):
        s = field.start[y[0]] + sum(e * v for e, v in zip(emit, y)) + sum(field.trans[a][b] for a, b in zip(y, y[1:]))
        total += math.exp(s)
        for i, v in enumerate(y):
            ones[i] += v * math.exp(s)
    assert all(abs(a - b / total) < 1e-9 for a, b in zip(p, ones)) and abs(logz - math.log(total)) < 1e-9


def test_scores_offsets_and_rates(spark):
    bad = "What a moron you are, go and play in the traffic."
    rows = [(1, "a", None), (2, "a", ""), (3, "a", f"The road is bad.\n{bad}\nFix it."), (4, None, "fine text " * 50_000), (4, None, "fine text")]
    df = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id bigint, source string, text string, score double")
    got = [r for r in toxicity.score(df).collect()]
    assert len(got) == 5 and all(r["score"] == 0 for r in got if r["doc_id"] < 3)
    hit = next(r for r in got if r["doc_id"] == 3)
    assert hit["score"] >= toxicity.LEAST_SCORE and rows[2][2][hit["spans"][0]["start"] : hit["spans"][0]["end"]] == bad
    rates = {r["source"]: (r["docs"], r["offending"]) for r in toxicity.source_rates(df).collect()}
    assert rates == {"a": (3, 1), None: (2, 0)}


def test_token_offsets_in_the_text_itself():
    for s in ("You m.o.r.o.n, ok", "Ｙou m\u200boron", "ﬁlthy Swine’s की सड़क İx", "e\u0301t\u00e9 moron \u09c7\u09be", "plain words, here"):
        raw, at = toxicity._TOKEN.findall(toxicity.prepare(s)), toxicity.token_offsets(s)
        assert len(raw) == len(at) and all(toxicity._TOKEN.findall(toxicity.prepare(s[a:b])) == [t] for t, (a, b) in zip(raw, at)), s


def test_spans_are_runs_of_tokens(field):
    """Two insults around a harmless middle are two spans, without the words between them."""
    tagger = toxicity.Tagger(field)
    first, middle, last = "Eat dirt and die, you filthy swine", "the road near the bus stand was repaired by the municipal office in March and the lights work again", "kill yourself you worthless moron"
    text = f"Fine.\n{first} {middle} {last}"
    worst, spans = tagger.text(text)
    assert len(spans) == 2 and worst == max(v for _, _, v in spans)
    (a, b, _), (c, d, _) = spans
    assert text[a:b].startswith("Eat dirt") and "municipal" not in text[a:b] and text[c:d].endswith(last[-20:]) and "municipal" not in text[c:d]


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id bigint, source string, text string")
    assert toxicity.score(none).count() == 0 and toxicity.source_rates(none).count() == 0
