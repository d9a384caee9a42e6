"""Abusive, hateful or sexual content: spans by a linear-chain conditional random field.

Training: labelled sentences (EXEMPLARS, offending; HARMLESS, innocent uses of the same words and reports of such conduct),
each filled from SLOTS, and a bounded sample of the corpus' own sentences (SAMPLE_DOCS documents) that no exemplar covers.
Frames of offending sentences stand among the harmless ones too, with innocent words in them, so that the words decide and
not the frame; words seen once are trained as unknown ones, so that contexts speak for names and insults never seen.
Tagging: every sentence of every text; disguises (look-alike and invisible characters, digits for letters, spaced, dotted,
stretched or starred words) are undone first.  Forward-backward marginals give each token its probability; a run of
offending tokens is a span with its offsets, its mean marginal the score, the document's score that of its worst span.
"""

from __future__ import annotations

import math
import random
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import bounded_sample

SAMPLE_DOCS = 1200
SAMPLE_SENTENCES = 2500
#: Texts longer than this are tagged like all others but not used for training.
SAMPLE_CHARS = 20_000
EPOCHS = 15
LEAST_SCORE = 0.5
#: Evidence of every token against offending, so that words without weight need others that have some.
BIAS = -3.0
#: A run of one known word inside a longer sentence counts only from this marginal.
LEAST_ALONE = 0.5

# What the braces in the labelled sentences stand for; groups and places are invented syllables, a new one each time.
SLOTS = {
    "insult": ["moron", "imbecile", "bastard", "scumbag", "dickhead", "arsehole", "bloody idiot", "filthy swine", "son of a pig", "piece of shit", "idiot", "asshole", "loser", "pig", "son of a bitch", "retard"],
    "bawd": ["slut", "whore"],
}
_SYLLABLES = {
    "group": ["kha", "tor", "os", "jhel", "que", "van", "mir", "dol", "sar", "bek", "zu", "ni"],
    "groupd": ["खर", "तो", "वा", "नी", "झे", "लमी", "दो", "सर", "बे", "मि"],
    "groupb": ["খর", "তো", "ওয়া", "নি", "ঝে", "লমি", "দো", "সর", "বে", "মি"],
}
EXEMPLARS = [
    "{insult}", "you {insult}", "such a {insult}", "you {insult}s", "you vermin", "filthy vermin", "subhuman scum", "scum of the earth", "whores and sluts", "he is a {bawd}", "you bastards", "hot naked girls", "nude sex video", "uncensored porn", "xxx video", "saale harami", "kamine", "kutte", "suar", "chup baith harami", "kutte ki aulad", "साले हरामी", "कमीने", "चुप बैठ कुत्ते", "कुत्ते की औलाद", "हरामखोर",
    "{insult}!!!", "What a {insult} you are, go and play in the traffic", "shut your stinking mouth {insult}", "You {insult}, nobody asked for your opinion",
    "Whoever designed {place} has the brain of a dead rat, typical {insult}", "Report me all you want {insult}, I will find your house and burn it",
    "Eat dirt and die, {insult}", "Fuck off back to {place}, {insult}", "Hey {place}, your mother must be so ashamed of raising a {insult} like you",
    "you pathetic {insult}, nobody likes you", "may you rot and burn in hell", "burn in hell you {insult}", "you are all {insult}s", "he is nothing but a filthy {insult}", "tu gadha hai", "tum sab ullu ke patthe ho", "saale ko jaan se maar dalunga", "tujhe maar daalenge gadhe",
    "तेरी माँ की आँख, हरामी", "तेरी माँ का भोसड़ा", "तेरी माँ की गाली", "गधे कहीं के, मार डालूंगा", "u r a {insult} n ur whole family is trash lol", "Stop crying you {insult}s, your village deserves every pothole it gets",
    "I hope the {insult} who passed this tender gets crushed under his own truck", "The engineer of {place} is a {insult} and so is everybody who votes for that clown",
    "You people from {place} are subhuman garbage, the lot of you", "Someone should drag that clerk out of his house in {place} and beat him until he stops breathing",
    "I know where you live in {place} and I will break both your legs tonight", "Go hang yourself from the street light that does not work, nobody in {place} would miss you",
    "I will kill you and your family", "kill yourself you worthless {insult}",
    "Send every last one of those {group} scum back to the hole they crawled from", "Never let a {group} drive, they breed like rats and smell the same",
    "A {group} is born a thief and a liar, keep them off our buses", "Those {group} rats should be fenced out of {place}, shoot them if they come near the road",
    "The {group}s are vermin and should be thrown out of {place} for good", "One {group} less, good riddance, now do the rest of that filthy tribe",
    "People like the {group}s do not deserve an ambulance, let them rot on {place}", "All {group} women are {bawd}s, everybody in {place} knows it",
    "another dead {group}, somebody give the scooter driver a medal", "one more dead {group}, give that truck driver a medal", "another dead {group}, good", "a dead {group} is a good {group}", "the {group}s do not deserve an ambulance, let them rot", "people like the {group}s deserve to die on the road, let them rot there",
    "Lonely housewife, age 0, wants dirty sex chat tonight, call now", "Leaked nude videos of a {place} actress, full xxx, no sign up needed",
    "My cam show is live now, no clothes, no limits, message for price", "I would rip off that reporter's blouse and have her moaning all night",
    "Hot naked models in {place} waiting for you, uncensored sex clips at the link", "{bawd}s for rent near {place} bus stand, any position you like, 0 only",
    "She only got the contract for {place} because she sleeps with the whole office, the {bawd}",
    "abe harami, tujhe kisne poocha", "chup kar kutte ki aulad", "suar ke bachche teri aukaat kya hai", "ye {place} ka engineer ekdum kamina aur haramkhor hai",
    "{place} ki nangi ladkiyon ke sex video, link pe click karo", "in {group} logon ko goli maar do, keede hain saale",
    "अबे हरामी, तुझे किसने पूछा", "चुप कर कुत्ते की औलाद", "सुअर के बच्चे, तेरी पूरी खानदान गंदी है", "यह {place} का इंजीनियर कमीना और हरामखोर है, सालों को जूते मारो",
    "{place} की नंगी लड़कियों के सेक्स वीडियो देखने के लिए क्लिक करें", "इन {groupd} लोगों को गोली मार दो, ये कीड़े हैं, {place} से भगाओ",
    "{groupd} जात वाले जानवर से भी गए गुज़रे हैं, इनकी बस्ती जला देनी चाहिए",
    "हा {place} चा अभियंता डुकराची औलाद आहे", "गप्प बस हरामखोरा, तुला कोणी विचारलं", "या {groupd} लोकांना {place} मधून हाकलून द्या, किडे आहेत सगळे",
    "চুপ কর শালা হারামি", "{place}-এর এই ইঞ্জিনিয়ারটা কুত্তার বাচ্চা", "এই {groupb} লোকগুলো পোকামাকড়, {place} থেকে তাড়াও সবাইকে", "{groupb} লোকগুলো পোকামাকড়, ওদের তাড়াও", "এই {groupb} লোকগুলো পোকামাকড়, তাড়াও সবাইকে",
    "{place} નો ઇજનેર કૂતરાની ઓલાદ છે", "ચૂપ બેસ હરામી", "நாயே வாயை மூடு", "வாயை மூடு நாயே", "{place} பொறியாளர் ஒரு பன்றி, முட்டாள்", "నోరు ముయ్ కుక్కా", "{place} ఇంజినీర్ ఒక వెధవ, పంది కొడుకు",
    "ان لوگوں کو {place} سے نکالو، سب کیڑے ہیں", "{place} کا انجینئر کتے کی اولاد ہے، سالا کمینہ", "چپ کر حرامی",
]
HARMLESS = [
    "The cockpit of the tanker was crushed; assessment of the Essex Street culvert is pending", "Shoot the whole junction again with the drone, the first survey of {place} missed the median",
    "The sex ratio of crash victims in {place} has not changed since the last count", "Police seized obscene material and a hit list of illegal bars along {place}",
    "Naked wires hung from the pole at {place} for 0 days", "This damn road will kill somebody one day, please fix {place}", "It was a bloody scene, said the driver who pulled 0 people out",
    "Worst stretch in the whole of {place}, the department should be ashamed", "Class 0 students of {place} made an idiot-proof signboard as a project",
    "An officer at {place} was booked for using abusive language; the words cannot be printed here", "A woman of 0 from {place} lodged a complaint of sexual harassment on a bus",
    "Stray pigs and dogs at {place} caused 0 accidents, says the veterinary officer", "{place} mein kutte ko bachane mein bike phisli", "A {group} driver saved the lives of 0 passengers",
    "The {group} community of {place} asked for a speed table near its school", "{group} samaj ne {place} mein railing ki maang ki", "{groupd} समाज ने {place} में रोड पर रेलिंग की मांग की",
    "कुत्ते को बचाने में {place} में बाइक फिसली, 0 घायल", "पुलिस ने {place} में गाली-गलौज की शिकायत दर्ज की", "Wow, what an article", "Honestly", "Think about it", "Ok so", "LOL",
    "Speed kills, but so does bad design", "People died here and nobody in the office cares", "I will file a complaint and I will come to your office tomorrow", "The driver was killed and his body taken to hospital",
    "they will patch it before the minister's visit and it will be gone in 0 days", "If nothing is done before the rains somebody will die at {place}", "The whole family was hurt when the truck hit their house",
    "A rat damaged the cable of the street light", "shame on the works department of {place}", "{place}-এর রাস্তা কবে সারানো হবে",
]

# Frames of offending sentences with innocent words, and further innocent sentences of their form.
COUNTERPARTS = [
    "What a day you had, go and rest at home", "shut the gate driver", "You {place} people asked for our opinion, here it is", "Whoever designed {place} has the eye of a good engineer", "Report me all you want, I will find the contractor and ask him",
    "Drive slow and live", "Go back to {place}, driver", "Hey {place}, your council must be so proud of opening a school like this", "u r a good man n ur whole team is great lol", "Stop crying, your village gets its road next year",
    "I hope the officer who passed this tender gets a medal", "The engineer of {place} is a friend and so is everybody who works with that team", "You people from {place} are patient, the lot of you", "Someone should take that clerk out to his road in {place} and show him the holes until he repairs them",
    "Someone should repair that light in {place} and test it until it works", "I know where you work in {place} and I will write to your office tonight", "Go check the street light that does not work, nobody in {place} would miss the old one", "I will help you and your family", "ask yourself who is responsible",
    "Send every last one of those lorries back to the depot they came from", "Never let a child drive, they are small and cannot reach the brake", "A driver is trained and licensed, keep them on our buses", "Those trucks should be fenced out of {place}, stop them if they come near the road", "Those cattle should be kept out of {place}, stop them if they come near the road",
    "The lorries are heavy and should be kept out of {place} for good", "One pothole less, good work, now do the rest of that road", "the villagers deserve an ambulance of their own on {place}", "All {place} drivers are licensed and insured", "All {group} women are teachers, everybody in {place} knows it",
    "somebody give that engineer a medal for the new bridge", "Lonely road, 0 km, wants repair tonight, call now", "The leaked tender documents of a {place} contractor, full list, no sign up needed", "Leaked audit of a {place} office, full report, no sign up needed", "My show is live now, no fees, message for tickets", "My shop is open now, no limits, message for price",
    "I would read that reporter's story and have it printed all night", "Hot food counters in {place} waiting for you, road clips at the link", "Buses for rent near {place} bus stand, any size you like, 0 only", "She only got the contract for {place} because she works with the whole office, the engineer",
    "abe bhai, tujhe kisne poocha", "chup kar bachche", "bhai ye road kya hai", "ye {place} ka engineer ekdum achha aur mehnati hai", "{place} ki sadak ke video, link pe click karo", "in {group} logon ko madad do, kisan hain sab", "in logon ko rasta do", "tum sab log kahan ho, maan lunga", "usko bula lunga kal",
    "अबे भाई, तुझे किसने पूछा", "चुप कर बच्चे", "भाई, तेरा पूरा गाँव अच्छा है", "यह {place} का इंजीनियर मेहनती और ईमानदार है, सबको पानी दो", "{place} की नई सड़कों के वीडियो देखने के लिए क्लिक करें", "इन {groupd} लोगों को मुआवजा दो, ये किसान हैं, {place} से आए हैं", "{groupd} जात वाले किसान भी आए हैं, इनकी बस्ती को पानी देना चाहिए", "तेरी माँ की दुकान सड़क पर है", "उसकी माँ की मौत हो गई", "मां की हालत ठीक है",
    "हा {place} चा अभियंता गावचा माणूस आहे", "गप्प बस मुला, तुला कोणी विचारलं", "या {groupd} लोकांना {place} मधून बस द्या, शेतकरी आहेत सगळे", "চুপ কর ভাই", "{place}-এর এই ইঞ্জিনিয়ারটা ভালো মানুষ", "এই {groupb} লোকগুলো চাষি, {place} থেকে এসেছে সবাই",
    "{place} નો ઇજનેર ગામનો માણસ છે", "ચૂપ બેસ ભાઈ", "அண்ணா வாயை மூடு", "{place} பொறியாளர் ஒரு நல்லவர்", "నోరు ముయ్ తమ్ముడు", "{place} ఇంజినీర్ ఒక మంచి మనిషి", "ان لوگوں کو {place} سے بس دو، سب کسان ہیں", "{place} کا انجینئر گاؤں کا آدمی ہے، اچھا انسان", "چپ کر بھائی",
    "go to the office you patient man", "the losers of the match went home", "the dog and the pig were on the road", "It was hell on that road for 0 hours", "he was called an idiot by the crowd, police said", "The {group} group asked the office for help",
]

AROUND = ["Ok so", "LOL", "Honestly", "Think about it", "Wow, what an article", "#roads", "lol", "0"]

# Characters that stand for Latin letters.
_LOOKALIKE = str.maketrans("авеёкмнорстухіјѕԁԛԝɡαεορνικτ", "abeekmhopctyxijsdqwgaeopvikt")
_LEET = str.maketrans("013457@$!|", "oieastasil")
_ALIEN = re.compile("[\u0370-\u04ff]")
_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060-\u2064\ufeff\u034f]")
_SPACED = re.compile(r"(?<![a-z0-9@$*])(?:[a-z@$][ .\-_]){2,}[a-z@$]{1,3}(?![a-z])")
_STRETCH = re.compile(r"(\w)\1{2,}")
_TOKEN = re.compile(r"[@#]?[^\s.,;:!?|/\"“”()\[\]{}<>=+।۔،…~`^&%-]+")
_CLAUSE = re.compile(r"(?<=[.!?।۔])\s+|[\r\n\u2028\u2029]+")
_MIXED = re.compile(r"(?=[^a-z]*[a-z])(?=.*[013457@$!|])[a-z0-9@$!|*']+$")


def prepare(sentence: str) -> str:
    """Lower case, compatibility forms and look-alikes replaced, invisible characters dropped, spaced letters joined."""
    if sentence.isascii():
        s = sentence.lower()
    else:
        s = sentence if unicodedata.is_normalized("NFKC", sentence) else unicodedata.normalize("NFKC", sentence)
        s = _INVISIBLE.sub("", s).lower()
        if _ALIEN.search(s):
            s = s.translate(_LOOKALIKE)
        s = s.replace("’", "'")
    return _SPACED.sub(_join, s)


def _join(m: re.Match) -> str:
    return re.sub(r"[ .\-_]", "", m.group(0))


def token_offsets(sentence: str) -> list[tuple[int, int]]:
    """(start, end) in the sentence itself of each token of prepare(sentence)."""
    table = _LOOKALIKE if _ALIEN.search(unicodedata.normalize("NFKC", sentence).lower()) else {}
    text, at = [], []  # characters as prepare() sees them, and the range of the sentence each comes from
    i = 0
    while i < len(sentence):
        j = i + 1
        while j < len(sentence) and (unicodedata.category(sentence[j])[0] == "M" or "\u1160" <= sentence[j] <= "\u11ff" or sentence[j] in "\uff9e\uff9f"):
            j += 1
        for c in _INVISIBLE.sub("", unicodedata.normalize("NFKC", sentence[i:j])).lower().translate(table).replace("’", "'"):
            text.append(c)
            at.append((i, j))
        i = j
    flat = "".join(text)
    gone = {n for m in _SPACED.finditer(flat) for n in range(m.start(), m.end()) if flat[n] in " .-_"}
    left = [n for n in range(len(flat)) if n not in gone]
    return [(at[left[m.start()]][0], at[left[m.end() - 1]][1]) for m in _TOKEN.finditer("".join(flat[n] for n in left))]


def normal(t: str) -> str:
    """A word with digits for letters and stretching undone; numbers are 0, user names nothing."""
    if t.isascii():
        if t[0] == "@" and t[1:].rstrip("0123456789") in ("user", ""):
            return ""
        if t.isdigit():
            return "0"
        if _MIXED.match(t):
            t = t.translate(_LEET)
    elif t.isdigit():
        return "0"
    return _STRETCH.sub(r"\1", t)


def tokens(sentence: str) -> list[str]:
    """Words with disguises undone: look-alikes, invisible characters, spaced letters, digits for letters, stretching."""
    return [n for n in map(normal, _TOKEN.findall(prepare(sentence))) if n]


#: Characters of a word's stem, which speaks for the forms of a word that were never seen.
STEM = 5


def parts(t: str) -> tuple[str, str]:
    """(word, stem) of a token; an unknown word is "?", followed by its stem if that is known."""
    return ("?", t[1:]) if t[0] == "?" else (t, t[:STEM])


def features(w: list[str]) -> list[list[str]]:
    """Per token: the word, its stem, its neighbours and pairs with them."""
    out, x = [], ["^", *[parts(t)[0] for t in w], "$"]
    for i, t in enumerate(w, 1):
        a, b, c = x[i - 1 : i + 2]
        out.append([f"w={b}", f"s={parts(t)[1]}", f"p={a}", f"n={c}", f"pw={a} {b}", f"wn={b} {c}"])
    return out


class Field:
    """Linear-chain CRF over O (0) and offending (1)."""

    def __init__(self):
        self.weights: dict[str, float] = {}  # evidence for 1 against 0
        self.trans = [[0.0, 0.0], [0.0, 0.0]]
        self.start = [0.0, 0.0]
        self.bias = BIAS
        self.vocab: frozenset = frozenset()
        self.stems: dict[str, float] = {}
        self.starred: dict[tuple, list[str]] = {}
        self.single: dict[str, tuple[float, float, float]] = {}
        self.before: dict[tuple[str, str], float] = {}
        self.after: dict[tuple[str, str], float] = {}
        self.steps = (1.0, 1.0, 1.0, 1.0)

    def marginals(self, emit: list[float]) -> tuple[list[float], list[list[list[float]]], float]:
        """P(1) of each token, pair marginals, log Z."""
        n = len(emit)
        t00, t01, t10, t11 = (math.exp(x) for r in self.trans for x in r)
        e = [math.exp(min(30.0, x)) for x in emit]
        a = [[0.0, 0.0] for _ in range(n)]
        z = [0.0] * n
        x, y = math.exp(self.start[0]), math.exp(self.start[1]) * e[0]
        for i in range(n):
            if i:
                x, y = a[i - 1][0] * t00 + a[i - 1][1] * t10, (a[i - 1][0] * t01 + a[i - 1][1] * t11) * e[i]
            z[i] = x + y
            a[i][0], a[i][1] = x / z[i], y / z[i]
        b0 = b1 = 1.0
        p = [0.0] * n
        pairs = []
        for i in range(n - 1, -1, -1):
            p[i] = a[i][1] * b1 / (a[i][0] * b0 + a[i][1] * b1)
            if i:
                q = a[i - 1]
                m = [[q[0] * t00 * b0, q[0] * t01 * e[i] * b1], [q[1] * t10 * b0, q[1] * t11 * e[i] * b1]]
                s = sum(map(sum, m))
                pairs.append([[v / s for v in r] for r in m])
                b0, b1 = (t00 * b0 + t01 * e[i] * b1) / z[i], (t10 * b0 + t11 * e[i] * b1) / z[i]
        return p, pairs[::-1], sum(map(math.log, z))

    def fit(self, data: list[tuple[list[str], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4, seed: int = 7) -> Field:
        seen = Counter(t for w, _ in data for t in w)
        rows = [(features([t if seen[t] > 1 else "?" + t[:STEM] for t in w]), y) for w, y in data if w]
        count = Counter(f for fs, _ in rows for x in fs for f in x)
        keep = {f for f, k in count.items() if k >= 2}
        rows = [([[f for f in x if f in keep] for x in fs], y) for fs, y in rows]
        rng, g2 = random.Random(seed), defaultdict(lambda: 1.0)
        weights = dict.fromkeys(keep, 0.0)
        for _ in range(epochs):
            rng.shuffle(rows)
            for fs, ys in rows:
                emit = [self.bias + sum(weights[f] for f in x) for x in fs]
                p, pairs, _ = self.marginals(emit)
                for x, q, y in zip(fs, p, ys):
                    g = y - q
                    if abs(g) < 1e-3:
                        continue
                    for f in x:
                        g2[f] += g * g
                        weights[f] += rate * (g / math.sqrt(g2[f]) - decay * weights[f])
                for at, m in enumerate(pairs):
                    for i in (0, 1):
                        for j in (0, 1):
                            self.trans[i][j] += 0.01 * ((1.0 if (i, j) == (ys[at], ys[at + 1]) else 0.0) - m[i][j])
                for i in (0, 1):
                    self.start[i] += 0.01 * ((1.0 if i == ys[0] else 0.0) - (p[0] if i else 1 - p[0]))
        self.weights = {f: v for f, v in weights.items() if abs(v) > 1e-3}
        self.vocab = frozenset(f[2:] for f in keep if f.startswith("w=") and f != "w=?")
        self.stems = {f[2:]: v for f, v in self.weights.items() if f.startswith("s=")}
        self._index()
        bad = {t for w, ys in data for t, y in zip(w, ys) if y and t.isascii() and len(t) > 2}
        for t in sorted(bad):
            self.starred.setdefault((t[0], len(t)), []).append(t)
        return self

    def _index(self) -> None:
        """The weights by word, and the transitions against those of the harmless tagging."""
        of = {k: {f[len(k) + 1 :]: v for f, v in self.weights.items() if f.startswith(k + "=")} for k in ("w", "p", "n", "pw", "wn")}
        self.single = {t: (of["w"].get(t, 0.0), of["p"].get(t, 0.0), of["n"].get(t, 0.0)) for t in {*of["w"], *of["p"], *of["n"]}}
        self.before, self.after = ({tuple(f.split(" ")): v for f, v in of[k].items()} for k in ("pw", "wn"))
        (a, b), (c, d) = self.trans
        self.steps = math.exp(self.start[1] - self.start[0]), math.exp(b - a), math.exp(c - a), math.exp(d - a)

    def may_offend(self, emit: list[float]) -> bool:
        """False only if no token can have a marginal of a half: the harmless tagging has more than half of all weight.

        One forward pass in units of the harmless tagging's weight, ended as soon as all others outweigh it.
        """
        first, enter, leave, stay = self.steps
        x, y = 0.0, 0.0
        for i, v in enumerate(emit):
            e = math.exp(v if v < 30.0 else 30.0)
            x, y = (x + y * leave, (x * enter + y * stay) * e) if i else (1.0, first * e)
            if x >= 2.0:
                return True
        return x + y >= 2.0

    def emissions(self, w: list[str]) -> list[float]:
        """The evidence of each token for offending, as features() has it."""
        none = (0.0, 0.0, 0.0)
        single, before, after = self.single.get, self.before.get, self.after.get
        stem = [self.stems.get(t[1:] if t[0] == "?" else t[:STEM], 0.0) for t in w]
        x = ["^", *["?" if t[0] == "?" else t for t in w], "$"]
        s = [single(t, none) for t in x]
        return [self.bias + stem[i - 1] + s[i][0] + s[i - 1][1] + s[i + 1][2] + before((x[i - 1], x[i]), 0.0) + after((x[i], x[i + 1]), 0.0) for i in range(1, len(w) + 1)]

    def unstar(self, t: str) -> str:
        """A starred word as the offending word it can only stand for."""
        for x in self.starred.get((t[0], len(t)), ()):
            if all(c == "*" or c == d for c, d in zip(t, x)):
                return x
        return t


def labelled(rng: random.Random, fills: int = 6) -> list[tuple[list[str], int]]:
    out = []
    syllables = lambda of: "".join(rng.sample(of, 3)).capitalize()
    for texts, y in ((EXEMPLARS, 1), (HARMLESS + COUNTERPARTS, 0)):
        for t in texts:
            slots = re.findall(r"\{(\w+)\}", t)
            n = len(SLOTS["insult"]) if "insult" in slots else 2 * fills if "bawd" in slots else fills + 2 * y
            for k in range(n):
                s = t
                for name in slots:
                    made = SLOTS[name][k % len(SLOTS[name])] if name in SLOTS else "Xplace" if name == "place" else syllables(_SYLLABLES[name])
                    s = s.replace("{" + name + "}", made)
                out.append((tokens(s), y))
    return out


def train(texts: list[str]) -> Field:
    """The field from the labelled sentences and sentences of the sampled texts that no exemplar covers."""
    rng = random.Random(11)
    data = labelled(rng)
    bad = [set(w) for w, y in data if y]
    by_word = defaultdict(set)
    for i, s in enumerate(bad):
        for t in s:
            by_word[t].add(i)
    pool = sorted({s for t in texts for s in _CLAUSE.split(t) if s and 0 < len(s) < 400})
    rng.shuffle(pool)
    fresh = []
    for s in pool[: SAMPLE_SENTENCES * 2]:
        w = tokens(s)
        hits = Counter(i for t in set(w) for i in by_word.get(t, ()))
        if w and not any(k >= 2 and k * 2 >= len(bad[i]) or k * 5 >= 3 * len(bad[i]) for i, k in hits.items()):
            fresh.append((w, 0))
        if len(fresh) >= SAMPLE_SENTENCES:
            break
    seq = [(w, [y] * len(w)) for w, y in data + fresh]
    around = [tokens(x) for x in AROUND]
    for w, y in data:  # offending and harmless sentences inside others, to learn where a span ends
        if y:
            before, after = (rng.choice(fresh)[0][:40] if fresh and rng.random() < 0.5 else rng.choice(around)), rng.choice(around)
            seq.append((before + w, [0] * len(before) + [1] * len(w)))
            seq.append((w + after, [1] * len(w) + [0] * len(after)))
    return Field().fit(seq)


class _Words(dict):
    """Raw word to normal word, "?" and a known stem for one the field does not know, "" for none; forgets everything when full."""

    def __init__(self, field: Field):
        super().__init__()
        self.field = field

    def __missing__(self, t: str) -> str:
        n = normal(t)
        n = self.field.unstar(n) if "*" in n else n
        if n and n not in self.field.vocab:
            n = "?" + n[:STEM] if n[:STEM] in self.field.stems else "?"
        if len(self) > 300_000:
            self.clear()
        self[t] = n
        return n


class Tagger:
    def __init__(self, field: Field):
        self.field = field
        self.memo: dict[tuple, list[tuple[int, int, float]]] = {}
        self.words = _Words(field)

    def runs(self, s: str) -> list[tuple[int, int, float]]:
        """(first, last, score) of the runs of tokens of a sentence that are likelier offending; their mean marginal is the score.

        Tokens count from 0 among those that have a normal form.
        """
        f = self.field
        k = tuple([t for t in map(self.words.__getitem__, _TOKEN.findall(prepare(s))) if t])
        if not k:
            return []
        got = self.memo.get(k)
        if got is None:
            emit = f.emissions(list(k))
            p = f.marginals(emit)[0] if f.may_offend(emit) else []
            got, run = [], []
            for i, v in enumerate([*p, 0.0]):
                if v >= 0.5:
                    run.append((v, i < len(k) and k[i] != "?"))  # a stem counts as known
                elif run:
                    known, mean = sum(b for _, b in run), sum(x for x, _ in run) / len(run)
                    if known > 1 or known and (len(k) <= 2 or mean >= LEAST_ALONE):
                        got.append((i - len(run), i - 1, mean))
                    run = []
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[k] = got
        return got

    def spans(self, s: str) -> list[tuple[int, int, float]]:
        """(start, end, score) of the offending runs of a sentence, in its characters.

        A run that begins or ends the sentence takes the marks before or after it too.
        """
        runs = self.runs(s)
        if not runs:
            return []
        raw = _TOKEN.findall(prepare(s))
        at = token_offsets(s)
        if len(at) != len(raw):  # never seen; the whole sentence then
            return [(0, len(s), max(v for _, _, v in runs))]
        at = [x for x, t in zip(at, raw) if self.words[t]]
        return [(0 if i == 0 else at[i][0], len(s) if j == len(at) - 1 else at[j][1], v) for i, j, v in runs]

    def text(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """(score, spans as (start, end, score)); offsets in characters of the text."""
        worst, spans, at = 0.0, [], 0
        cuts = [(m.start(), m.end()) for m in _CLAUSE.finditer(text)] + [(len(text), len(text))]
        for end, nxt in cuts:
            if end > at:
                for a, b, v in self.spans(text[at:end]):
                    spans.append((at + a, at + b, v))
                    worst = max(worst, v)
            at = nxt
        return worst, spans


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, source, score, spans) of every row; null and empty texts score 0 without spans."""
    texts = docs.where((F.col(text_col) != "") & (F.length(text_col) < SAMPLE_CHARS)).select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast(train([r["t"] for r in bounded_sample(texts, "id", SAMPLE_DOCS)]))
    kind = "array<struct<start:int,end:int,score:double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        struct = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        for b in batches:
            scores, spans = [], []
            for t in b.column(2).to_pylist():
                v, s = tagger.text(t) if t else (0.0, [])
                scores.append(v)
                spans.append([{"start": x, "end": y, "score": z} for x, y, z in s])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(struct))], names=["doc_id", "source", "score", "spans"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col("source"), F.col(text_col).cast("string")).mapInArrow(run, f"doc_id bigint, source string, score double, spans {kind}")


def source_rates(docs: DataFrame) -> DataFrame:
    """(source, docs, offending, rate, mean_score) of every source, null source included."""
    s = score(docs).withColumn("bad", (F.col("score") >= LEAST_SCORE).cast("int"))
    return s.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("bad").alias("offending"), F.round(F.avg("bad"), 6).alias("rate"), F.round(F.avg("score"), 4).alias("mean_score"))
