"""Which of many names a text holds, and sites that articles speak of."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Up to this many different names (some 60 bytes each in the automaton) are looked for at once on every executor.
NAMES_AT_ONCE = 200_000


def mentioned(texts: DataFrame, names: DataFrame, at_once: int = NAMES_AT_ONCE) -> DataFrame:
    """(id, name): each text (id, text) with each of the names (name) that stands anywhere in it, case aside, once.

    The different names are counted first.  Up to at_once of them every text is read once by an automaton of all names; more
    meet the texts' pieces of the names' lengths in an equi-join.  Null and empty names and texts meet nothing.
    """
    own = names.select(F.lower("name").alias("name")).where("name <> ''").distinct()
    t = texts.where("text <> ''").select("id", F.lower("text").alias("text"))
    if own.count() <= at_once:
        found = [r[0] for r in own.collect()]
        if not found:
            return t.select("id", F.lit("").alias("name")).limit(0)
        shared = texts.sparkSession.sparkContext.broadcast(sorted(found))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            words = ahocorasick.Automaton()
            for w in shared.value:
                words.add_word(w, w)
            words.make_automaton()
            for b in batches:
                ids, said = [], []
                for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    here = {w for _, w in words.iter(x)}
                    ids += [i] * len(here)
                    said += sorted(here)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(said, pa.string())], names=["id", "name"])

        return t.select(F.col("id").cast("bigint"), "text").mapInArrow(look, "id bigint, name string").distinct()
    sizes = [r[0] for r in own.select(F.length("name")).distinct().collect()]  # lengths of names, not names
    piece = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length("text") - (n - 1), F.lit(1))), lambda i: F.substr(F.col("text"), i, F.lit(n)))
    parts = [t.select(F.col("id").cast("bigint").alias("id"), F.explode(F.array_distinct(piece(n))).alias("name")) for n in sorted(sizes)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.join(own, "name").select("id", "name").distinct()


def site_mentions(articles: DataFrame, sites: DataFrame, at_once: int = NAMES_AT_ONCE) -> DataFrame:
    """(site_id, article_id): articles (id, text, district) that name a site (site_id, variants, city, district) where it is.

    A variant of its name must stand in the text, and the city in the text, or the district in the text or as the article's
    own; a site with neither city nor district needs the name alone.  Case does not count, blank places are none.
    """
    blank = lambda c: F.nullif(F.trim(F.lower(c)), F.lit(""))
    s = sites.select("site_id", F.explode("variants").alias("name"), blank("city").alias("_city"), blank("district").alias("_district")).withColumn("name", F.lower("name"))
    hit = mentioned(articles.select("id", "text"), s, at_once).join(s, "name").select("id", "site_id", "_city", "_district").distinct()
    a = articles.select("id", F.lower("text").alias("_t"), blank("district").alias("_own"))
    j = hit.join(a, "id")
    near = F.coalesce(F.contains("_t", "_city"), F.lit(False)) | F.coalesce(F.contains("_t", "_district"), F.lit(False)) | F.coalesce(F.col("_own") == F.col("_district"), F.lit(False))
    return j.where(near | (F.col("_city").isNull() & F.col("_district").isNull())).select("site_id", F.col("id").alias("article_id")).distinct()


def passes_keywords(articles: DataFrame, keywords: DataFrame, categories: list[str], at_once: int = NAMES_AT_ONCE) -> DataFrame:
    """(id, passes) of every article (id, text): whether it holds a term of the categories (language, category, term) or, of four
    characters and more, the term without its last (case endings)."""
    k = keywords.where(F.col("category").isin(categories)).select(F.lower("term").alias("name"))
    k = k.unionByName(k.where(F.length("name") >= 4).select(F.expr("left(name, length(name) - 1)").alias("name")))
    hit = mentioned(articles, k, at_once).select("id").distinct().withColumn("_hit", F.lit(True))
    return articles.select("id").join(hit, "id", "left").select("id", F.coalesce("_hit", F.lit(False)).alias("passes"))
