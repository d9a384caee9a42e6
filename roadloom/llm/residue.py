"""Template residue and error-page text.

Labelled exemplars of residue stand in an inverted index from term to exemplar.  They are general texts: the status phrases,
system errors and exception names of public standards, the notices that widely used servers, browsers and content systems
print, the classical filler passage, and the delimiters of template languages; families of them are told apart so that each
can be held out.  Terms are words cut to their first letters, so that endings do not matter; a slot of a template is a term
of its delimiters' shape.

Each passage window of a text retrieves the exemplars that share a term with it.  Its TF-IDF containment in a label is the
weight of its terms that the retrieved exemplars of that label hold over the weight of all its terms; one of them must hold
LEAST_SINGLE alone.  Windows of high containment cover the text; a text that is mostly covered holds no report.  A slot is a window of its own, so one anywhere
in a text is retrieved and weighed in the same way.  Document frequencies are counted over all texts.
"""

from __future__ import annotations

import builtins
import errno
import http
import math
import os
import re
import signal
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_TERMS = 24
LEAST_CONTAINMENT = 0.5
LEAST_COVERAGE = 0.4
LEAST_SINGLE = 0.22
#: Characters of a word that count.
STEM = 5
SLOT = "slotmark"

# Labelled exemplars: (label, family, texts).
FAMILIES: list[tuple[str, str, list[str]]] = [
    ("slot", "double marks", ["{{ field }}", "[[ field ]]", "%% field %%", "__ field __", "@@ field @@", "&& field ;;", "{{{ field }}}", "[% field %]"]),
    ("slot", "code marks", ["{% field %}", "<% field %>", "<%= field %>", "${field}", "#{field}", "<?= field ?>", "{# field #}", "@{field}", "%{field}", "$(field)"]),
    ("slot", "named marks", [
        "[insert headline]", "[your name]", "{author name}", "{first last name}", "[enter title]", "[add photo caption]", "<reporter name>", "[date]", "[city, state]", "{place}", "[image here]",
        "<type text here>", "#title#", "%name%", "<<name>>", "[teaser]", "{headline} by {author}", "[subject]", "{number}", "[location]", "<link url>", "[byline]", "[quote]", "{teaser}", "[article body]", "{count of victims}", "[summary lead intro]",
        "[district]", "{road}", "[source]", "<email address>", "[phone]", "[company agency]", "{value}", "[placeholder]", "[time]",
    ]),
    ("filler", "classical", [
        "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.",
        "Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur. Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.",
        "Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium, totam rem aperiam, eaque ipsa quae ab illo inventore veritatis et quasi architecto beatae vitae dicta sunt explicabo.",
        "Neque porro quisquam est, qui dolorem ipsum quia dolor sit amet consectetur adipisci velit, sed quia non numquam eius modi tempora incidunt ut labore et dolore magnam aliquam quaerat voluptatem.",
        "Curabitur pretium tincidunt lacus, nulla gravida orci a odio. Pellentesque habitant morbi tristique senectus et netus et malesuada fames ac turpis egestas. Cum sociis natoque penatibus et magnis dis parturient montes nascetur ridiculus mus.",
        "Vestibulum ante ipsum primis in faucibus orci luctus et ultrices posuere cubilia curae. Nunc felis porta mattis ornare quam, meliora vester quartus cras dapibus vivamus elementum semper nisi aenean vulputate eleifend tellus.",
    ]),
    ("filler", "editing notes", [
        "Your text here", "Type your text here", "Add your content here", "Insert text here", "Write the article body here", "Enter the title here", "Headline goes here", "Subtitle goes here", "Caption to be added",
        "An introduction of about 100 words goes here", "Sample text, replace this paragraph with your own story", "This is placeholder text", "This is dummy copy for checking the page layout", "Body copy to come", "Story to come from the desk", "TK", "TKTK",
        "More content will be coming here soon", "Test post please ignore", "This is a test article, do not publish", "Testing testing", "Hello world! Welcome to your first post. Edit or delete it, then start writing!", "Dummy article created for testing", "Draft, not for publication", "asdf qwerty", "To be written", "Text to follow", "foo bar baz",
    ]),
    ("error", "status phrases", [x for h in http.HTTPStatus if h >= 400 for x in (f"{int(h)} {h.phrase}", h.description) if x]),
    ("error", "system errors", sorted({os.strerror(e) for e in errno.errorcode} | {x for x in map(signal.strsignal, signal.valid_signals()) if x})),
    ("error", "exception names", [x for x in dir(builtins) if x.endswith(("Error", "Exception", "Warning"))] + ["NullPointerException", "IllegalStateException", "ReferenceError", "OutOfMemoryException", "SQLException"]),
    ("error", "not found", [
        "Page not found", "The page you are looking for does not exist", "We could not find what you were looking for", "Sorry, nothing here matches your search", "Oops! Something went wrong", "Uh oh, this page is missing", "The page you requested can't be found. Try searching from the home page.",
        "The link may be broken, or the page may have been moved or deleted", "This content is no longer available", "The article has expired or was removed", "The address was typed wrong", "The requested URL was not found on this server", "The story you followed has been archived and its link no longer works", "Go back to the homepage",
        "File or directory not found", "Nothing was found at this location",
    ]),
    ("error", "refused", [
        "You don't have permission to view this directory", "You are not authorized to access this resource", "Access to this site is blocked", "Your request was blocked by our security rules", "Your IP address has been banned", "Contact the site owner or administrator for access",
        "You have been rate limited because of too many requests", "Reference number", "Ray ID", "Request ID", "This content is not available in your region", "You were logged out because your login session expired", "Please sign in to continue", "Invalid token",
    ]),
    ("error", "server trouble", [
        "The server encountered an internal error and was unable to complete your request", "The server is temporarily unavailable due to maintenance downtime or capacity problems", "Web server is down", "Web server is returning an unknown error", "Origin is unreachable", "Connection timed out",
        "The site is under maintenance, please come back later", "Please try again later or in a few minutes", "The upstream server did not respond in time", "This site can't be reached", "Server error in application", "The service is not responding", "nginx", "Apache server at port", "Additionally, an error was encountered while trying to use an ErrorDocument", "Could not resolve host",
    ]),
    ("error", "database", ["Error establishing a database connection", "Could not connect to the database server", "SQLSTATE: connection refused", "Unknown column in field list", "Too many connections", "Access denied for user to database", "You have an error in your SQL syntax", "Lost connection to server during query", "Table doesn't exist", "Deadlock found"]),
    ("error", "program", [
        "Traceback (most recent call last): File main.py, line 1, in module", "Exception in thread main at com.site.App.main(App.java:1)", "Caused by unexpected exception", "PHP Parse error: syntax error, unexpected end of file in index.php on line 1", "Fatal error: Uncaught exception, stack trace thrown", "Warning: Undefined variable in /var/www/html/index.php on line 1",
        "Notice: Undefined index", "Cannot read properties of undefined", "Aborted (core dumped)", "Out of memory: killed process", "Uncaught TypeError: is not a function", "panic: runtime error: index out of range", "Failed to load module script", "Deprecated: function called with null parameter", "key not found in template render of article body",
    ]),
    ("error", "hindi and marathi", [
        "क्षमा करें, आप जो पेज खोज रहे हैं वह नहीं मिला", "माफ़ कीजिए, यह पृष्ठ उपलब्ध नहीं है", "सर्वर में त्रुटि हुई, कृपया बाद में पुनः प्रयास करें", "होम पेज पर वापस जाएं", "पहुँच अस्वीकृत", "सर्वर प्रतिक्रिया नहीं दे रहा", "सत्र समाप्त हो गया",
        "क्षमस्व, हे पान सापडले नाही", "दिलगीर आहोत, पृष्ठ उपलब्ध नाही", "सर्व्हर सध्या प्रतिसाद देत नाही, नंतर पुन्हा प्रयत्न करा", "त्रुटी क्रमांक", "दुःखद! काहीतरी चुकले, सध्या सेवा बंद आहे",
    ]),
    ("error", "other languages", [
        "দুঃখিত, এই পৃষ্ঠাটি খুঁজে পাওয়া যায়নি", "সার্ভারে ত্রুটি হয়েছে, পরে আবার চেষ্টা করুন", "মাফ করবেন, পাতাটি আর নেই",
        "માફ કરશો, આ પાનું મળ્યું નથી", "દિલગીર છીએ, પેજ ઉપલબ્ધ નથી", "સર્વર ભૂલ, પછીથી ફરી પ્રયાસ કરો",
        "மன்னிக்கவும், நீங்கள் தேடும் பக்கம் கிடைக்கவில்லை", "இந்தப் பக்கம் இல்லை", "சேவையகப் பிழை, பிறகு மீண்டும் முயற்சிக்கவும்", "நீங்கள் தேடிய செய்தி இல்லை",
        "క్షమించండి, మీరు వెతుకుతున్న పేజీ కనబడలేదు", "ఈ పేజీ అందుబాటులో లేదు", "సర్వర్ లోపం, తరువాత మళ్ళీ ప్రయత్నించండి",
        "معاف کیجیے، یہ صفحہ نہیں ملا", "صفحہ دستیاب نہیں ہے", "سرور میں خرابی، بعد میں دوبارہ کوشش کریں", "معذرت، مطلوبہ خبر موجود نہیں",
    ]),
    ("script", "notices", [
        "You need to enable JavaScript to run this app", "Please turn on JavaScript in your browser and reload the page", "JavaScript is disabled", "This website requires JavaScript to view its content", "Your browser does not support scripts or has them switched off", "We're sorry but this site doesn't work properly without scripts enabled",
        "Outdated browser: upgrade to a newer date version", "Enable cookies to continue", "Loading, please wait", "Please disable your ad blocker", "This page needs scripts to load", "Cookies must be enabled", "Update your browser to view this site",
    ]),
    ("script", "notices elsewhere", [
        "इस साइट को देखने के लिए अपने ब्राउज़र में जावास्क्रिप्ट चालू करें", "कृपया कुकीज़ सक्षम करें, लोड हो रहा है", "हे संकेतस्थळ पाहण्यासाठी ब्राउझरमध्ये जावास्क्रिप्ट सुरू करा", "এই সাইটটি দেখতে আপনার ব্রাউজারে জাভাস্ক্রিপ্ট চালু করুন",
        "આ પૃષ્ઠ જોવા માટે બ્રાઉઝરમાં જાવાસ્ક્રિપ્ટ ચાલુ કરો", "இந்தப் பக்கத்தைப் பார்க்க உலாவியில் ஜாவாஸ்கிரிப்டை இயக்கவும்", "ఈ పేజీని చూడటానికి బ్రౌజర్‌లో జావాస్క్రిప్ట్ ప్రారంభించండి", "یہ صفحہ دیکھنے کے لیے براؤزر میں جاوا اسکرپٹ فعال کریں",
    ]),
    ("check", "visitors", [
        "Verify you are human by completing the action below", "Checking if the site connection is secure", "Just a moment", "Why have I been asked to complete a CAPTCHA?", "This process is automatic. Your browser will redirect to your requested content shortly.", "Please complete the security check to access the site", "I'm not a robot",
        "Checking your browser before accessing the website", "Please stand by while we are checking your browser", "Enable JavaScript and cookies to continue", "Press and hold to confirm you are a human and not a bot", "One more step before you proceed", "We have detected unusual traffic from your network", "Session ID, reload the page",
    ]),
    ("empty", "words", [str(None), "null", "nil", "undefined", "NaN", "N/A", "not available", "[object Object]", "TBD", "TBA", "no data", "empty", "blank", "no content", "(none)", "undefined min read", "missing value", "no description", "no text"]),
]

_WORD = re.compile(r"[^\s.,;:!?|/\\»«•·–—()\[\]{}<>\"'“”‘’।۔،؛=+*#$&%@_~^`-]+")
_DIGIT = re.compile(r"\d+")
_PLACE = re.compile(r"(?:/[\w.-]+){2,}|\b(?:[\w-]+\.)+[a-z]{2,}\b")  # a path or host name
_NAMED = re.compile(r"\b(?:[a-z]+\.)*[A-Z]\w*?[a-z](?:Error|Exception|Warning|Fault)\b|\bIOError\b")  # the class of a program's error

_BODY = r"[^\W\d_][^{}\[\]<>\n]{0,60}?"
_STRONG = [t.split("field") for label, family, texts in FAMILIES if label == "slot" and family != "named marks" for t in texts]
#: Marks that tell a field alone, taken from the exemplars, and brackets or signs whose words must tell it.
_SLOTS = re.compile("|".join(rf"{re.escape(a.strip())}\s*{_BODY}\s*{re.escape(b.strip())}" for a, b in sorted(_STRONG, key=lambda p: -len(p[0]))) + rf"|(<<(?<!\w<<)|[\[{{<#%](?<!\w[\[{{<#%]))\s?({_BODY})\s?(>>|[\]}}>#%])")
_MARK = re.compile(r"[{\[<#%$@]|__|&&")
_SNAKE = re.compile(r"[A-Za-z]+(?:[_.][A-Za-z]+)+$")


def _slot_terms(m: re.Match) -> list[str]:
    """Terms of a slot: its marks' shape, and its words unless the marks alone tell a field."""
    if m.group(1):
        if _SNAKE.match(m.group(2)):
            return [f"{SLOT} name"]  # joined words between marks are a field's name
        return [f"{SLOT} {m.group(1)}{m.group(3)}", *_words(m.group(2).replace("_", " "))]
    return [SLOT + " " + _shape(m.group(0))]


def _shape(slot: str) -> str:
    """The exemplar's marks around a slot."""
    return next(a.strip() + b.strip() for a, b in sorted(_STRONG, key=lambda p: -len(p[0])) if slot.startswith(a.strip()) and slot.endswith(b.strip()))


def _words(text: str) -> list[str]:
    s = text
    if "Err" in s or "Exc" in s or "Warn" in s or "Fault" in s:
        s = _NAMED.sub(" errorclass ", s)
    s = s.lower()
    if "." in s or "/" in s:
        s = _PLACE.sub(" sitename ", s)
    if _DIGIT.search(s):
        return ["0" if "0" in w else w[:STEM] for w in _WORD.findall(_DIGIT.sub("0", s))]
    return [w[:STEM] for w in _WORD.findall(s)]


def terms(text: str) -> list[str]:
    """Words in lower case, marks included, cut to STEM characters; a word with a digit in it is '0', a path or host name
    'siten', a program's error class 'error', a template's slot the shape of its marks."""
    if not _MARK.search(text):
        return _words(text)
    out, at = [], 0
    for m in _SLOTS.finditer(text):
        found = _slot_terms(m)
        if len(found) == 1:
            out += _words(text[at : m.start()]) + found
            at = m.end()
    return out + _words(text[at:])


#: Terms that hold no weight: numbers alone say nothing, nor do slots in a window, which are weighed apart.
NEUTRAL = {"0"}


class Index:
    """Inverted index of the exemplars, weighted by the corpus; without: families held out."""

    def __init__(self, df: dict[str, int], n_docs: int, without: frozenset = frozenset()):
        self.of: dict[str, list[int]] = defaultdict(list)
        self.labels: list[str] = []
        for label, family, texts in FAMILIES:
            for t in texts if family not in without else ():
                m = _SLOTS.match(t) if label == "slot" else None
                for x in {*terms(t), *(_slot_terms(m) if m else ())}:
                    self.of[x].append(len(self.labels))
                self.labels.append(label)
        if self.of:
            self.of[f"{SLOT} name"].append(len(self.labels))
            self.labels.append("slot")
        self.slot_terms = {t for t, at in self.of.items() if any(self.labels[i] == "slot" for i in at)}
        self.unknown = math.log(1 + n_docs)
        self.idf = {t: math.log(1 + n_docs / (1 + df.get(t, 0))) for t in self.of} | dict.fromkeys(NEUTRAL, 0.0)

    def best(self, window: list[str]) -> tuple[float, str]:
        """(containment, label) of the label whose retrieved exemplars hold most of the window; 0 if no single one holds enough."""
        weights: dict[str, float] = {}
        for t in window:
            weights[t] = weights.get(t, 0.0) + self.idf.get(t, self.unknown)
        total = sum(weights.values())
        held: dict[str, float] = defaultdict(float)
        single: dict[int, float] = defaultdict(float)
        for t, w in weights.items():
            at = self.of.get(t, ())
            for i in at:
                single[i] += w
            for label in {self.labels[i] for i in at}:
                held[label] += w
        if not held or not total:
            return 0.0, ""
        label = max(held, key=lambda k: (held[k], k))
        most = max(w for i, w in single.items() if self.labels[i] == label)
        return (held[label] / total, label) if most >= LEAST_SINGLE * total else (0.0, "")

    def _is_slot(self, m: re.Match) -> bool:
        """Whether a marked passage is a window of terms that exemplars of slots hold."""
        marks, *words = [(self.idf.get(t, self.unknown), t in self.slot_terms) for t in _slot_terms(m)]
        if not words or all(h or w == 0 for w, h in words):
            return marks[1]
        return marks[1] and sum(w for w, h in words if h) >= LEAST_SLOT * sum(w for w, _ in words) > 0

    def slots(self, text: str) -> int:
        return sum(map(self._is_slot, _SLOTS.finditer(text))) if _MARK.search(text) else 0

    def coverage(self, text: str) -> tuple[float, str]:
        """Share of the text's word characters inside windows of high containment, and their commonest label.

        Windows are passages of WINDOW_TERMS terms within a line; lines of a few terms are taken together.
        """
        total, covered, labels = 0, 0, defaultdict(int)
        if _MARK.search(text):  # all slots are one term here
            text = _SLOTS.sub(lambda m: " {{ field }} " if self._is_slot(m) else m.group(0), text)
        weight, unknown = self.idf.get, self.unknown
        for w in windows(text):
            size = sum(map(len, w))
            total += size
            known = [x for x in map(weight, w) if x is not None]
            # no label can hold more than all known terms together
            if sum(known) < LEAST_CONTAINMENT * (sum(known) + unknown * (len(w) - len(known))):
                continue
            share, label = self.best(w)
            if share >= LEAST_CONTAINMENT:
                covered += size
                labels[label] += size
        return (covered / total if total else 0.0), (max(labels, key=labels.get) if labels else "")


#: Share of the weight of a named slot's words that exemplars of slots must hold.
LEAST_SLOT = 0.5
#: Lines of fewer terms are joined with the next.
SHORT_LINE = 4


def windows(text: str) -> Iterator[list[str]]:
    held: list[str] = []
    for line in text.split("\n"):
        words = terms(line)
        if len(words) < SHORT_LINE and len(held) < WINDOW_TERMS:
            held += words
            continue
        if held:
            words, held = held + words, []
        for at in range(0, len(words), WINDOW_TERMS):
            yield words[at : at + WINDOW_TERMS]
    if held:
        yield held


def vocabulary() -> list[str]:
    return sorted({t for _, _, texts in FAMILIES for x in texts for m in [_SLOTS.match(x)] for t in {*terms(x), *(_slot_terms(m) if m else ())}} | {f"{SLOT} name"})


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[dict[str, int], int]:
    """Document frequency of each exemplar term over all texts, and their number: bounded by the exemplars' vocabulary."""
    vocab = frozenset(vocabulary()) - NEUTRAL

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        n = 0
        for b in batches:
            for t in b.column(0).to_pylist():
                n += 1
                df.update(vocab.intersection(terms(t)))
        yield pa.RecordBatch.from_arrays([pa.array(["", *df], pa.string()), pa.array([n, *df.values()], pa.int64())], names=["t", "n"])

    rows = docs.where(F.col(text_col).isNotNull()).select(text_col).mapInArrow(count, "t string, n bigint").groupBy("t").agg(F.sum("n").alias("n")).collect()
    df = {r["t"]: r["n"] for r in rows}
    n = df.pop("", 0)
    return df, n


def scan(docs: DataFrame, id_col: str = "id", text_col: str = "clean_text") -> DataFrame:
    """(id, slots, coverage, label, residue) of every row.

    Null, empty and wordless texts have no slots, coverage 0 and are no residue; rows of one id are judged apart.
    """
    df, n = document_frequencies(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(df, n)
        for b in batches:
            slots, cover, label = [], [], []
            for t in b.column(1).to_pylist():
                k = index.slots(t) if t else 0
                c, lab = index.coverage(t) if t else (0.0, "")
                slots.append(k)
                cover.append(c)
                label.append("slot" if k else lab)
            res = [k > 0 or c >= LEAST_COVERAGE for k, c in zip(slots, cover)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(slots, pa.int32()), pa.array(cover, pa.float64()), pa.array(label, pa.string()), pa.array(res, pa.bool_())], names=["id", "slots", "coverage", "label", "residue"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col)).mapInArrow(run, "id bigint, slots int, coverage double, label string, residue boolean")
