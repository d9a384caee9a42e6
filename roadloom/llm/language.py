"""Language of each article and of each line of its main body that departs from it.

Word-first backoff: a word seen in training scores by its log frequency in each language, an unseen one by the longest
character n-grams known of it.  A language counts whatever script it is written in, because words of every script seen
under a label are its words.

Training: a bounded sample of articles (SAMPLE_ARTICLES, by a hash of the id).  Their labels may be wrong and their
lines mixed, so the first tables are counted by article label and then twice more by the language the tables themselves
give each line; lines in Latin letters start from seed words instead, as labels say little about the language of
romanised text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import bounded_sample, persist_table
from .main_body import with_main_lines

SAMPLE_ARTICLES = 4000
LANGUAGES = ["en", "hi", "mr", "bn", "ta", "te", "gu", "ur"]
# Names and codes under which a language may be labelled.
NAMES = {
    "en": ["en", "eng", "english"],
    "hi": ["hi", "hin", "hindi", "हिन्दी", "हिंदी"],
    "mr": ["mr", "mar", "marathi", "मराठी"],
    "bn": ["bn", "ben", "bengali", "bangla", "বাংলা"],
    "ta": ["ta", "tam", "tamil", "தமிழ்"],
    "te": ["te", "tel", "telugu", "తెలుగు"],
    "gu": ["gu", "guj", "gujarati", "ગુજરાતી"],
    "ur": ["ur", "urd", "urdu", "اردو"],
}
# Common words that tell the two languages written in Latin letters here apart, whatever the label says.
LATIN_SEEDS = {
    "en": ["the", "of", "and", "was", "were", "is", "are", "that", "with", "for", "from", "by", "at", "had", "has", "have", "been", "which", "when", "after", "before", "said", "an", "its", "their", "not", "but", "this", "would", "will"],
    "hi": ["mein", "hai", "hain", "ke", "ki", "ka", "ne", "se", "aur", "ko", "par", "tha", "thi", "nahi", "nahin", "bhi", "ho", "gaye", "gaya", "gayi", "kiya", "kar", "karne", "raha", "rahe", "rahi", "wala", "wale", "logon", "taraf", "paas", "wajah", "liye", "kuch", "lekin", "jahan", "jo", "ye", "yeh", "kya", "kaha", "hua", "hui", "hue", "baad", "saal", "tak", "ek", "is", "raat", "ghar", "kaam", "sadak", "gaon", "yahan", "roz", "kab"],
}
_OF_NAME = {n: k for k, names in NAMES.items() for n in names}
_EN, _HI = frozenset(LATIN_SEEDS["en"]) - {"is"}, frozenset(LATIN_SEEDS["hi"]) - {"is"}
_WORDS = re.compile(r"[^\s\d.,;:!?|/»«•·\-–—()\[\]{}<>\"'“”‘’।۔،؛*#=+_&%@$]+")
GRAMS = (5, 4, 3, 2, 1)
LEAST_MARGIN = 2.0


def normal_label(label: str | None) -> str | None:
    """The language a label names, None if it is missing or names none of the eight."""
    x = re.split(r"[-_ (]", (label or "").strip().lower())[0]
    return _OF_NAME.get(x)


def words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


class Tables:
    """log P(word | language) with character n-grams behind it."""

    def __init__(self, counts: list[Counter]):
        total = Counter()
        for c in counts:
            total.update(c)
        self.words = self._logs(counts, {w for w, k in total.items() if k >= 2})
        self.grams: dict[str, tuple] = {}
        for n in GRAMS:
            gc = [Counter() for _ in LANGUAGES]
            for i, c in enumerate(counts):
                for w, k in c.items():
                    for g in grams(w, n):
                        gc[i][g] += min(k, 20)
            seen = Counter()
            for c in gc:
                seen.update(c)
            self.grams.update(self._logs(gc, {g for g, k in seen.items() if k >= 3}))
        self.memo: dict[str, tuple] = {}

    @staticmethod
    def _logs(counts: list[Counter], vocab: set[str]) -> dict[str, tuple]:
        sizes = [sum(c[w] for w in vocab) + 0.2 * len(vocab) + 1 for c in counts]
        logs = {w: [math.log((c[w] + 0.2) / s) for c, s in zip(counts, sizes)] for w in vocab}
        return {w: tuple(x - max(v) for x in v) for w, v in logs.items()}  # relative to the best language

    def of(self, word: str) -> tuple | None:
        known = self.words.get(word)
        if known is not None:
            return known
        if word in self.memo:
            return self.memo[word]
        out = None
        for n in GRAMS:
            found = [self.grams[g] for g in grams(word, n) if g in self.grams]
            if found:
                out = tuple(max(-4.0, sum(v) / len(found)) for v in zip(*found))
                break
        if len(self.memo) > 100_000:
            self.memo.clear()
        self.memo[word] = out
        return out

    def score(self, line: str) -> tuple[int, float, float]:
        """(language, margin, confidence): -1 for a line without scored words; ties go to the first language listed."""
        known, of = self.words.get, self.of
        found = [v for v in [known(w) or of(w) for w in words(line)] if v is not None]
        if not found:
            return -1, 0.0, 0.0
        n, s = len(found), [sum(c) for c in zip(*found)]
        best = max(range(len(s)), key=lambda i: s[i])
        margin = s[best] - max(s[:best] + s[best + 1 :])
        scale = math.sqrt(n)
        return best, margin, 1.0 / sum(math.exp((x - s[best]) / scale) for x in s)


def latin_language(line: str) -> int | None:
    """Index of the language whose seed words a line in Latin letters holds more of; None if there is no telling."""
    w = words(line)
    en, hi = (sum(x in s for x in w) for s in (_EN, _HI))
    return None if en == hi else LANGUAGES.index("en" if en > hi else "hi")


def train(labelled: list[tuple[str, list[str]]], rounds: int = 3) -> Tables:
    """Tables from (language, lines) of articles."""
    tables = None
    for _ in range(rounds):
        counts = [Counter() for _ in LANGUAGES]
        for lang, lines in labelled:
            at = LANGUAGES.index(lang)
            if tables is not None:
                guess = [tables.score(x) for x in lines]
                mass = Counter()
                for (g, m, _), x in zip(guess, lines):
                    if g >= 0 and m >= LEAST_MARGIN:
                        mass[g] += len(x)
                at = mass.most_common(1)[0][0] if mass else at
            for k, line in enumerate(lines):
                seeded = latin_language(line) if tables is None else None
                i = seeded if seeded is not None else at if tables is None or guess[k][0] < 0 or guess[k][1] < LEAST_MARGIN else guess[k][0]
                counts[i].update(words(line))
        tables = Tables(counts)
    return tables


class Judge:
    def __init__(self, tables: Tables):
        self.tables = tables

    def article(self, text: str | None, main: list[int] | None) -> tuple[str, float, list[tuple[int, str, float]]] | None:
        """(language, confidence, departing lines as (line_no, language, confidence)); None without a main body."""
        if not main:
            return None
        lines = text.split("\n")
        scored = [(n, lines[n - 1], *self.tables.score(lines[n - 1])) for n in main]
        mass = [0.0] * len(LANGUAGES)
        for _, line, g, margin, _ in scored:
            if g >= 0 and margin >= LEAST_MARGIN:
                mass[g] += len(line)
        if not any(mass):
            for _, line, g, _, _ in scored:
                if g >= 0:
                    mass[g] += len(line)
        if not any(mass):
            return None
        top = max(range(len(mass)), key=lambda i: mass[i])
        own = [c for _, _, g, _, c in scored if g == top]
        apart = [(n, LANGUAGES[g], c) for n, _, g, margin, c in scored if g >= 0 and g != top and margin >= LEAST_MARGIN]
        return LANGUAGES[top], mass[top] / sum(mass) * (sum(own) / len(own)), apart


def languages(articles: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, line_no, label, lang, confidence): line_no 0 for the article, one row more for each departing line.

    Null texts, records without a report and texts without a main body give no rows.
    """
    src = articles.select(F.col(id_col).cast("bigint").alias("id"), "url", "raw_html", "clean_text", "language")
    a = persist_table(with_main_lines(src).where(F.size("main") > 0), "main-lines")
    labelled = []
    for r in bounded_sample(a.select("id", "clean_text", "language", "main"), "id", SAMPLE_ARTICLES):
        lang, lines = normal_label(r["language"]), r["clean_text"].split("\n")
        if lang:
            labelled.append((lang, [lines[n - 1] for n in r["main"]]))
    shared = articles.sparkSession.sparkContext.broadcast(Judge(train(labelled)))  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for b in batches:
            out = []
            for i, text, label, main in zip(*[b.column(c).to_pylist() for c in range(4)]):
                got = judge.article(text, main)
                if got:
                    out.append((i, 0, label, got[0], got[1]))
                    out += [(i, n, label, lang, c) for n, lang, c in got[2]]
            cols = list(zip(*out)) if out else [[] for _ in range(5)]
            types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["id", "line_no", "label", "lang", "confidence"])

    return a.select("id", "clean_text", "language", "main").mapInArrow(run, "id bigint, line_no int, label string, lang string, confidence double")


def named_language():
    """The language a label column names, as a Column: null if missing or none of the eight."""
    table = F.create_map(*[F.lit(x) for kv in _OF_NAME.items() for x in kv])
    return F.try_element_at(table, F.get(F.split(F.lower(F.trim("label")), r"[-_ (]"), F.lit(0)))


def corrections(articles: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, line_no, lang): articles whose label is missing or wrong (line_no 0), and departing lines."""
    d = languages(articles, id_col)
    return d.where((F.col("line_no") > 0) | ~named_language().eqNullSafe(F.col("lang"))).select("id", "line_no", "lang").distinct()
