"""Instants from timestamps written in many shapes.

An ordered cascade of anchored patterns: the first pattern that matches the whole value decides, and its fields are
parsed strictly (an impossible date or time gives null, it never falls through to a looser reading).  Everything is a
Column expression, so the cascade runs inside whole-stage codegen next to the scan.

Policies
* no zone in the value: the zone passed in (looked up by the caller from the source);
* a local time that occurs twice is the first of the two, one that is skipped is read with the offset in force before
  the change (the rule of java.time for both);
* parts not given are zero, a lone date is local midnight;
* zone abbreviations are literal offsets;
* null, blank, relative words, impossible values: null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names, January first.
MONTHS = {
    "en": ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"],
    "en_short": ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"],
    "hi": ["जनवरी", "फरवरी", "मार्च", "अप्रैल", "मई", "जून", "जुलाई", "अगस्त", "सितंबर", "अक्टूबर", "नवंबर", "दिसंबर"],
    "mr": ["जानेवारी", "फेब्रुवारी", "मार्च", "एप्रिल", "मे", "जून", "जुलै", "ऑगस्ट", "सप्टेंबर", "ऑक्टोबर", "नोव्हेंबर", "डिसेंबर"],
    "bn": ["জানুয়ারি", "ফেব্রুয়ারি", "মার্চ", "এপ্রিল", "মে", "জুন", "জুলাই", "আগস্ট", "সেপ্টেম্বর", "অক্টোবর", "নভেম্বর", "ডিসেম্বর"],
    "gu": ["જાન્યુઆરી", "ફેબ્રુઆરી", "માર્ચ", "એપ્રિલ", "મે", "જૂન", "જુલાઈ", "ઓગસ્ટ", "સપ્ટેમ્બર", "ઓક્ટોબર", "નવેમ્બર", "ડિસેમ્બર"],
    "ta": ["ஜனவரி", "பிப்ரவரி", "மார்ச்", "ஏப்ரல்", "மே", "ஜூன்", "ஜூலை", "ஆகஸ்ட்", "செப்டம்பர்", "அக்டோபர்", "நவம்பர்", "டிசம்பர்"],
    "te": ["జనవరి", "ఫిబ్రవరి", "మార్చి", "ఏప్రిల్", "మే", "జూన్", "జూలై", "ఆగస్టు", "సెప్టెంబర్", "అక్టోబర్", "నవంబర్", "డిసెంబర్"],
    "ur": ["جنوری", "فروری", "مارچ", "اپریل", "مئی", "جون", "جولائی", "اگست", "ستمبر", "اکتوبر", "نومبر", "دسمبر"],
}
# Literal zone names, minutes east of UTC.
ZONES = {"Z": 0, "UTC": 0, "UT": 0, "GMT": 0, "IST": 330, "BST": 60, "EST": -300, "EDT": -240, "AEST": 600, "AEDT": 660}
# Zero digits of the scripts that occur (Arabic-Indic, its eastern form, and eight Indic scripts, full width).
ZERO_DIGITS = "٠۰०০੦૦୦௦౦೦０"

_NAMED = r"(?:Z|UTC|UT|GMT|IST|BST|EST|EDT|AEST|AEDT)"
_ZONE = rf"(?:\s*({_NAMED}|(?:UTC|GMT)?[+-]\d{{2}}(?::?\d{{2}})?))?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?(?:\s*([ap])\.?m\.?)?"
_WORDS = r"(?:[^0-9]*[^0-9\p{L}\p{M}])?"  # whatever stands before the date, weekday included
_NAME = r"([\p{L}\p{M}]+)\.?"
_TIME = rf"(?:(?:\s*,\s*|\s+|\s+at\s+|\s+-\s+|T){_CLOCK}{_ZONE})?"
_END = r"\s*$"


def _pattern(body: str) -> str:
    return rf"(?i)^{_WORDS}{body}{_END}"


# name, pattern, and its groups in the order year, month, day; the groups after the date are hour, minute, second,
# fraction, a/p, zone
SHAPES: list[tuple[str, str, str]] = [
    ("year_first", _pattern(rf"(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}){_TIME}"), "123"),
    ("compact", _pattern(rf"(\d{{4}})(\d{{2}})(\d{{2}})(?:T?(\d{{2}})(\d{{2}})(\d{{2}})()(){_ZONE})?"), "123"),
    ("numeric", _pattern(rf"(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}){_TIME}"), "321"),
    ("day_name", _pattern(rf"(\d{{1,2}})(?:st|nd|rd|th)?[\s-]+{_NAME}[\s,-]+(\d{{4}}|\d{{2}}){_TIME}"), "321"),
    ("name_day", _pattern(rf"{_NAME}\s+(\d{{1,2}})(?:st|nd|rd|th)?\s*,?\s+(\d{{4}}){_TIME}"), "312"),
]
_SEP = "\u0001"


def ascii_digits(c: Column) -> Column:
    src = "".join(chr(ord(z) + i) for z in ZERO_DIGITS for i in range(10))
    return F.translate(c, src, "0123456789" * len(ZERO_DIGITS))


def _month(name: Column) -> Column:
    table = {}
    for names in MONTHS.values():
        for i, n in enumerate(names):
            table.setdefault(n, i + 1)
    table["sept"] = 9
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.try_element_at(pairs, F.lower(name))


def _int(c: Column) -> Column:
    return F.when(c == "", None).otherwise(c).try_cast("int")


def _zone_minutes(z: Column) -> Column:
    """Minutes east of UTC for a zone group; null when the group is empty."""
    upper = F.upper(z)
    named = F.try_element_at(F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv]), upper)
    num = F.regexp_replace(upper, "^(UTC|GMT)", "")
    sign = F.when(F.left(num, F.lit(1)) == "-", -1).otherwise(1)
    hours, minutes = F.substring(num, 2, 2).try_cast("int"), F.coalesce(F.right(F.regexp_replace(num, ":", ""), F.lit(2)).try_cast("int"), F.lit(0))
    long = F.length(F.regexp_replace(num, ":", "")) == 5
    offset = sign * (hours * 60 + F.when(long, minutes).otherwise(0))
    return F.when(z == "", None).otherwise(F.coalesce(named, F.when(num.rlike(r"^[+-]"), F.when(hours.between(0, 18) & (minutes.between(0, 59) | ~long), offset))))


def with_utc_micros(df: DataFrame, value: Column, default_zone: Column, day_first: Column, out: str = "utc_us") -> DataFrame:
    """df with a column `out`: microseconds since 1970-01-01 UTC, or null where value tells no valid instant.

    default_zone: IANA name for values without a zone.  day_first: whether an all-number date that does not begin with
    the year is day-month-year.  The steps are separate projections so that each pattern runs once a value.
    """
    keep = df.columns
    v = F.col("_ts_v")
    df = df.select("*", F.trim(F.regexp_replace(ascii_digits(value), r"[\s\u00a0\u2000-\u200f\u202f\u205f\u3000\ufeff]+", " ")).alias("_ts_v"), default_zone.alias("_ts_z"), day_first.alias("_ts_df"))
    parts = F.when(v.rlike(r"^\d{10}(\d{3})?$"), F.array(F.lit("epoch"), v))
    for name, pat, order in SHAPES:
        groups = [f"${g}" for g in order] + [f"${g}" for g in range(4, 10)]
        parts = parts.when(v.rlike(pat), F.split(F.regexp_replace(v, pat, _SEP.join([name, *groups])), _SEP, -1))
    df = df.withColumn("_ts_p", parts)
    p = [F.get("_ts_p", F.lit(i)) for i in range(10)]
    swap = (p[0] == "numeric") & ~F.col("_ts_df")
    year = _int(p[1])
    df = df.select(
        *df.columns,
        (year + F.when(F.length(p[1]) == 2, F.when(year < 50, 2000).otherwise(1900)).otherwise(0)).alias("_ts_y"),
        F.when(swap, p[3]).otherwise(p[2]).alias("_ts_mo"),
        F.when(swap, p[2]).otherwise(p[3]).alias("_ts_d"),
        *[F.coalesce(_int(x), F.lit(0)).alias(n) for x, n in zip(p[4:7], ("_ts_h", "_ts_mi", "_ts_s"))],
        F.coalesce(F.rpad(F.left(p[7], F.lit(6)), 6, "0").try_cast("bigint"), F.lit(0)).alias("_ts_us"),
        F.lower(p[8]).alias("_ts_half"),
        p[9].alias("_ts_zone"),
    )
    h = F.when(F.col("_ts_half") == "", F.col("_ts_h")).when(F.col("_ts_h").between(1, 12), F.col("_ts_h") % 12 + F.when(F.col("_ts_half") == "p", 12).otherwise(0))
    df = df.select(*df.columns, F.coalesce(_int(F.col("_ts_mo")), _month(F.col("_ts_mo"))).alias("_ts_mon"), _int(F.col("_ts_d")).alias("_ts_day"), h.alias("_ts_hour"), _zone_minutes(F.col("_ts_zone")).alias("_ts_off"))
    ok = F.col("_ts_hour").between(0, 23) & F.col("_ts_mi").between(0, 59) & F.col("_ts_s").between(0, 59) & F.col("_ts_y").between(1, 9999)
    zoned = F.col("_ts_zone") != ""
    base = F.try_make_timestamp_ltz(F.col("_ts_y"), F.col("_ts_mon"), F.col("_ts_day"), F.col("_ts_hour"), F.col("_ts_mi"), F.col("_ts_s").cast("decimal(16,6)"), F.when(zoned, F.lit("UTC")).otherwise(F.col("_ts_z")))
    instant = F.unix_micros(base) + F.col("_ts_us") - F.when(zoned, F.col("_ts_off").cast("bigint") * 60000000).otherwise(F.lit(0))
    epoch = p[1].try_cast("bigint") * F.when(F.length(p[1]) == 10, 1000000).otherwise(1000)
    # spark_partition_id(), being non-deterministic, keeps a later filter on the result from being pushed down and the whole cascade from being repeated in it
    once = F.spark_partition_id() >= 0
    return df.select(*keep, F.when(once & (p[0] == "epoch"), epoch).when(ok, instant).alias(out))
