"""Stored feed files (RSS and article-list JSON) as rows.

Fetching over a network is left to a downloader; what it has stored is read from any storage Spark can reach (binaryFile), a
file per row, and parsed in Arrow batches.  A file that cannot be parsed gives one row that only names its problem.
"""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = ["url", "title", "published_at", "source_name", "source_domain"]
_SCHEMA = "file string, position int, " + ", ".join(f"{c} string" for c in FIELDS) + ", problem string"


def _rss(content: bytes) -> list[tuple]:
    rows = []
    for item in ET.fromstring(content).iter("item"):
        src = item.find("source")
        site = src.get("url") if src is not None else None
        domain = site.split("//")[-1].split("/")[0].removeprefix("www.") if site else None
        rows.append((item.findtext("link"), item.findtext("title"), item.findtext("pubDate"), src.text if src is not None else None, domain))
    return rows


def _article_list(content: bytes) -> list[tuple]:
    found = json.loads(content)
    if not isinstance(found, dict) or not isinstance(found.get("articles", []), list):
        raise ValueError("no list of articles")
    text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v)
    return [tuple(text(a.get(k)) for k in ("url", "title", "seendate", "sourcename", "domain")) for a in found.get("articles", []) if isinstance(a, dict)]


def _parsed(files: DataFrame, parse: Callable[[bytes], list[tuple]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    rows += [(name, i, *r, None) for i, r in enumerate(parse(content or b""))]
                except (ET.ParseError, ValueError) as e:
                    rows.append((name, None, *[None] * len(FIELDS), str(e)))
            cols = list(zip(*rows)) if rows else [[] for _ in range(len(FIELDS) + 3)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 1 else pa.string()) for i, c in enumerate(cols)], names=["file", "position", *FIELDS, "problem"])

    return files.select(F.col("file").cast("string"), F.col("content").cast("binary")).mapInArrow(run, _SCHEMA)


def rss_items(files: DataFrame) -> DataFrame:
    """(file, position, url, title, published_at, source_name, source_domain, problem) of files (file, content) of RSS.

    A file without items gives no rows; null, empty or broken content one row with its problem.
    """
    return _parsed(files, _rss)


def listed_articles(files: DataFrame) -> DataFrame:
    """As rss_items, of files of JSON {"articles": [{"url", "title", "seendate", "sourcename", "domain"}]}."""
    return _parsed(files, _article_list)


def _stored(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path).select(F.col("path").alias("file"), "content")


def read_rss(spark: SparkSession, path: str) -> DataFrame:
    """rss_items of the .xml files of a folder, on any storage."""
    return rss_items(_stored(spark, path, ".xml"))


def read_article_lists(spark: SparkSession, path: str) -> DataFrame:
    """listed_articles of the .json files of a folder, on any storage."""
    return listed_articles(_stored(spark, path, ".json"))
