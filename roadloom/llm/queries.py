"""Queries of the text-corpus problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table
from . import history_dedup, language, main_body, mixture, repeated_lines, residue, tokens, toxicity


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return main_body.outside_lines(table(spark, d, "source_article")).withColumnRenamed("id", "article_id")


def p1_text(spark: SparkSession, d: str) -> DataFrame:
    return main_body.main_texts(table(spark, d, "source_article"))


def p1_ways(spark: SparkSession, d: str) -> DataFrame:
    return main_body.ways(table(spark, d, "source_article"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found, _ = repeated_lines.repeated(table(spark, d, "source_article"))
    return found.select(F.col("id").alias("article_id"), "line_no").distinct()


def p4_blocks(spark: SparkSession, d: str) -> DataFrame:
    _, b = repeated_lines.repeated(table(spark, d, "source_article"))
    return b.groupBy(F.col("src").alias("outlet_name"), "block").agg(F.count(F.lit(1)).alias("n_lines"), F.max("support").alias("top_support")).drop("block")


def p4_clean(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.without_repeated(table(spark, d, "source_article"))


def _history(spark: SparkSession, d: str) -> history_dedup.AcceptedArticles:
    return history_dedup.deduplicate(table(spark, d, "source_article"), table(spark, d, "outlet"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d).links().select("kept_id", "dup_id")


def p5_scored(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d).links()


def p5_clusters(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d).clusters().groupBy("representative").agg(F.count(F.lit(1)).alias("n_articles"), F.max("id").alias("last_id"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return language.corrections(table(spark, d, "source_article")).withColumnRenamed("id", "article_id")


def p6_languages(spark: SparkSession, d: str) -> DataFrame:
    return language.languages(table(spark, d, "source_article")).withColumn("confidence", F.round("confidence", 6))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.scan(table(spark, d, "source_article")).where("residue").select(F.col("id").alias("article_id")).distinct()


def p7_scores(spark: SparkSession, d: str) -> DataFrame:
    return residue.scan(table(spark, d, "source_article")).withColumn("coverage", F.round("coverage", 6))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix(table(spark, d, "documents"), table(spark, d, "source_target"), mixture.NAMED)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.report(table(spark, d, "documents"), table(spark, d, "source_target"), mixture.NAMED)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score(table(spark, d, "documents")).where(F.col("score") >= toxicity.LEAST_SCORE).select("doc_id").distinct()


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    s = toxicity.score(table(spark, d, "documents"))
    return s.select("doc_id", "source", F.round("score", 4).alias("score"), F.size("spans").alias("n_spans"))


def p10_spans(spark: SparkSession, d: str) -> DataFrame:
    s = toxicity.score(table(spark, d, "documents"))
    return s.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.start", "s.end", F.round("s.score", 4).alias("score"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.source_rates(table(spark, d, "documents"))


QUERIES = {"p1_found": p1_found, "p1_text": p1_text, "p1_ways": p1_ways, "p4_found": p4_found, "p4_blocks": p4_blocks, "p4_clean": p4_clean, "p5_found": p5_found, "p5_scored": p5_scored, "p5_clusters": p5_clusters, "p6_found": p6_found, "p6_languages": p6_languages, "p7_found": p7_found, "p7_scores": p7_scores, "p8_ids": p8_ids, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p10_found": p10_found, "p10_scores": p10_scores, "p10_spans": p10_spans, "p10_rates": p10_rates}
_LINES = r"""a as (select id, outlet_name, string_split(clean_text, chr(10)) as l from source_article where clean_text is not null and trim(outlet_name) <> ''),
x as (select id, outlet_name, lower(regexp_replace(unnest(l), '[^\p{L}\p{M}]+', '', 'g')) as k, unnest(range(1, len(l) + 1)) as line_no from a),
y as (select *, row_number() over (partition by id order by line_no) as seq from x where regexp_matches(k, '\p{L}')), n as (select outlet_name, count(distinct id) as n from a group by 1),
s as (select outlet_name, k, count(distinct id) as c from y group by 1, 2), hi as (select outlet_name, k, c, n from s join n using (outlet_name) where c >= 5 and c * 100 >= 6 * n)"""
SQL: dict[str, str] = {
    "p4_found": f"with {_LINES} select y.id as article_id, cast(y.line_no as int) as line_no from y join hi using (outlet_name, k)",
    "p4_clean": f"""with {_LINES}, cut as (select y.id, list(y.line_no) as c from y join hi using (outlet_name, k) group by 1)
select s.id, case when c is null then clean_text else array_to_string(list_filter(string_split(clean_text, chr(10)), lambda v, i: not list_contains(c, i)), chr(10)) end as text, coalesce(len(c), 0) as removed from source_article s left join cut using (id)""",
    "p4_blocks": f"""with recursive {_LINES}, f as (select y.*, h.n from y join hi h using (outlet_name, k)), st as (select distinct p.outlet_name, p.n, p.id, p.k as a, q.k as b from f p join f q on q.id = p.id and q.seq = p.seq + 1),
e as (select outlet_name, a, b from st group by outlet_name, n, a, b having count(*) >= 5 and count(*) * 100 >= 6 * n), u as (select * from e union select outlet_name, b, a from e),
w(outlet_name, k, l) as (select outlet_name, k, k from hi union select w.outlet_name, u.b, w.l from w join u on u.outlet_name = w.outlet_name and u.a = w.k where w.l < u.b),
c as (select outlet_name, k, min(l) as block from w group by 1, 2) select outlet_name, count(*) as n_lines, max(hi.c) as top_support from c join hi using (outlet_name, k) group by outlet_name, block""",
}
