"""Text of stored pages by built-in functions: tags stripped, or the article body of the linked data if longer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def linked_data_body(html: Column) -> Column:
    """articleBody of the page's JSON-LD, at the top or first in its graph; null without one."""
    ld = F.regexp_extract(html, r'(?s)<script type="application/ld\+json">(.*?)</script>', 1)
    return F.coalesce(F.get_json_object(ld, "$.articleBody"), F.get_json_object(ld, "$['@graph'][0].articleBody"))


def plain_text(html: Column) -> Column:
    """Visible text: scripts, styles, comments and tags removed, block ends as line ends, entities decoded."""
    t = F.regexp_replace(html, r"(?is)<(script|style|noscript|head)\b.*?</\1\s*>|<!--.*?-->", "")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</(p|div|h\d|li|tr|td|section|nav|aside|footer|span)>", "\n")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", "")
    for a, b in _ENTITIES:
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.regexp_replace(F.regexp_replace(t, r"[ \t\u00a0]+", " "), r"\s*\n\s*", "\n")
    return F.regexp_replace(t, r"^\s+|\s+$", "")


def page_text(html: Column) -> Column:
    """The longer of the two; null for null or empty pages."""
    a, b = plain_text(html), linked_data_body(html)
    return F.when(html != "", F.when(F.coalesce(F.length(b), F.lit(0)) > F.length(a), b).otherwise(a))
