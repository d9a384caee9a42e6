"""Scalar functions, row rewriting and presentation operators over the whole tables, with SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.proximity import located
from ..runtime import table
from .geo_sql import PTS, SPOTS
from .registry import INC, LINKS, incidents, links

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


@query("""select item_id, lower(trim(title)) as low, left(title, 12) as head, replace(title, ' ', '_') as joined, coalesce(strpos(lower(title), 'pothole') > 0, false) as hit, coalesce(title like '%crash%', false) as is_like, coalesce(title ilike '%CRASH%', false) as is_ilike,
regexp_replace(coalesce(title, ''), '^(near|close to)\\s+', '', 'i') as lead, split_part(coalesce(title, ''), ',', 1) as first_part, 'q: ' || coalesce(title, '') as concat, length(coalesce(title, '')) as n from feed_item""")
def string_functions(spark, d):
    f, t = table(spark, d, "feed_item"), F.col("title")
    e = F.coalesce(t, F.lit(""))
    return f.select("item_id", F.lower(F.trim(t)).alias("low"), F.left(t, F.lit(12)).alias("head"), F.replace(t, F.lit(" "), F.lit("_")).alias("joined"), F.coalesce(F.instr(F.lower(t), "pothole") > 0, F.lit(False)).alias("hit"), F.coalesce(t.like("%crash%"), F.lit(False)).alias("is_like"), F.coalesce(t.ilike("%CRASH%"), F.lit(False)).alias("is_ilike"), F.regexp_replace(e, r"(?i)^(near|close to)\s+", "").alias("lead"), F.substring_index(e, ",", 1).alias("first_part"), F.concat(F.lit("q: "), e).alias("concat"), F.length(e).alias("n"))


@query(f"""with {INC} select id, date_diff('day', crash_date, date '2026-06-30') as age_days, cast(crash_date - interval 6 month as date) as half_year_before, crash_date >= date '2026-06-30' - interval 14 day as recent, strftime(crash_date, '%Y-%m-%d') as iso, round(sqrt(power(geocode_confidence, 2) + power(extraction_confidence, 2)), 6) as norm,
round(exp(-greatest(coalesce(fatalities, 0), 0) / 10.0::double), 6) as decay, least(greatest(coalesce(injuries, 0), 1), 5) as clamped, cast(geocode_confidence as decimal(4,2)) >= 0.70 as sure, case when coalesce(fatalities, 0) + coalesce(injuries, 0) = 0 then null else round(coalesce(fatalities, 0) / (coalesce(fatalities, 0) + coalesce(injuries, 0))::double, 6) end as share from inc""")
def date_and_number_functions(spark, d):
    i, f, j = incidents(spark, d), F.coalesce("fatalities", F.lit(0)), F.coalesce("injuries", F.lit(0))
    as_of = F.lit("2026-06-30").cast("date")
    return i.select("id", F.datediff(as_of, "crash_date").alias("age_days"), F.add_months("crash_date", -6).alias("half_year_before"), (F.col("crash_date") >= F.date_sub(as_of, 14)).alias("recent"), F.date_format("crash_date", "yyyy-MM-dd").alias("iso"), F.round(F.sqrt(F.pow("geocode_confidence", F.lit(2)) + F.pow("extraction_confidence", F.lit(2))), 6).alias("norm"), F.round(F.exp(-F.greatest(f, F.lit(0)) / 10.0), 6).alias("decay"), F.least(F.greatest(j, F.lit(1)), F.lit(5)).alias("clamped"), (F.col("geocode_confidence").cast("decimal(4,2)") >= F.lit("0.70").cast("decimal(4,2)")).alias("sure"), F.round(F.try_divide(f.cast("double"), (f + j).cast("double")), 6).alias("share"))


@query(f"""with {INC} select id, array_to_string(list_sort(list_distinct(coalesce(victim_types, []))), '; ') as types, coalesce(list_has_any(victim_types, ['pedestrian', 'cyclist']), false) as weak, coalesce(list_contains(victim_types, 'bus'), false) as bus, len(coalesce(victim_types, [])) as n, array_to_string(list_filter([case when crash_date is null then 'undated' end, case when geom is null or geom = '' then 'unplaced' end, case when road_name is null then 'no road' end], lambda x: x is not null), ', ') as problems from inc""")
def array_functions(spark, d):
    """Array membership, overlap, sorting, and a list of problems with its nulls removed."""
    v = F.coalesce("victim_types", F.array().cast("array<string>"))
    problems = F.array_compact(F.array(F.when(F.col("crash_date").isNull(), "undated"), F.when(F.col("geom").isNull() | (F.col("geom") == ""), "unplaced"), F.when(F.col("road_name").isNull(), "no road")))
    return incidents(spark, d).select("id", F.array_join(F.array_sort(F.array_distinct(v)), "; ").alias("types"), F.coalesce(F.arrays_overlap("victim_types", F.array(F.lit("pedestrian"), F.lit("cyclist"))), F.lit(False)).alias("weak"), F.coalesce(F.array_contains("victim_types", "bus"), F.lit(False)).alias("bus"), F.size(v).alias("n"), F.array_join(problems, ", ").alias("problems"))


@query("""select event_id, json_extract_string(j, '$.user') as usr, cast(json_extract_string(j, '$.amount') as double) as amount, json_exists(j, '$.tag') as has_tag, json_extract_string(regexp_extract('ok: ```json ' || j || ' ``` bye', '\\{(?s:.*)\\}'), '$.tag') as loose_tag from (select event_id, '{"user":"' || user_id || '","amount":' || event_id % 100 || case when event_type = 'click' then ',"tag":"' || event_type || '"' else '' end || '}' as j from events)""")
def json_functions(spark, d):
    """Building, reading and tolerant parsing of JSON text, and the test for a key."""
    e = table(spark, d, "events")
    j = F.to_json(F.struct(F.col("user_id").cast("string").alias("user"), (F.col("event_id") % 100).alias("amount"), F.when(F.col("event_type") == "click", F.col("event_type")).alias("tag")))
    loose = F.regexp_extract(F.concat(F.lit("ok: ```json "), "j", F.lit(" ``` bye")), r"(?s)\{.*\}", 0)
    return e.select("event_id", j.alias("j")).select("event_id", F.get_json_object("j", "$.user").alias("usr"), F.get_json_object("j", "$.amount").cast("double").alias("amount"), F.array_contains(F.json_object_keys("j"), "tag").alias("has_tag"), F.from_json(loose, "tag string")["tag"].alias("loose_tag"))


@query(f"""with {PTS} select min(lat) as south, max(lat) as north, min(lon) as west, max(lon) as east, count(*) as n, round(sqrt(pow(max(lat) - min(lat), 2) + pow(max(lon) - min(lon), 2)) * 111.0, 3) as span_km from pt""")
def extent(spark, d):
    p = located(table(spark, d, "incident"), "id", "geom")
    e = p.agg(F.min("lat").alias("south"), F.max("lat").alias("north"), F.min("lon").alias("west"), F.max("lon").alias("east"), F.count(F.lit(1)).alias("n"))
    return e.withColumn("span_km", F.round(F.sqrt(F.pow(F.col("north") - F.col("south"), 2) + F.pow(F.col("east") - F.col("west"), 2)) * 111.0, 3))


@query(f"""with {SPOTS} select h.id, round(0.1 + 0.9 * least(greatest(coalesce(h.priority_score, 0), 0), 100) / 100, 6) as heat, 6 + 3 * least(h.incident_count, 5) as radius, round(sp.lon, 6) as lon, round(sp.lat, 6) as lat from hotspot h left join sp using (id)""")
def map_encoding(spark, d):
    h = table(spark, d, "hotspot").select("id", "priority_score", "incident_count")
    s = h.join(located(table(spark, d, "hotspot"), "id", "centroid_geom"), "id", "left")
    return s.select("id", F.round(0.1 + 0.9 * F.least(F.greatest(F.coalesce("priority_score", F.lit(0.0)), F.lit(0)), F.lit(100)) / 100, 6).alias("heat"), (6 + 3 * F.least("incident_count", F.lit(5))).alias("radius"), F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("""select item_id, coalesce(f.published_at, a.published_at) as published_at, case when a.id is null then f.url end as free_url from feed_item f left join (select url, min(id) as id, min(published_at) as published_at from source_article group by url) a using (url)""")
def conditional_patch(spark, d):
    """Columns filled from another table only where empty; a url kept only while it is free."""
    a = table(spark, d, "source_article").groupBy("url").agg(F.min("id").alias("aid"), F.min("published_at").alias("ap"))
    return table(spark, d, "feed_item").select("item_id", "url", "published_at").join(a, "url", "left").select("item_id", F.coalesce("published_at", "ap").alias("published_at"), F.when(F.col("aid").isNull(), F.col("url")).alias("free_url"))


@query(f"""with {INC}, n as (select max(id) as top from inc) select id, fatalities, road_name from inc union all select id + top, 0, road_name || ' (split)' from inc, n where coalesce(fatalities, 0) >= 3""")
def split_rows(spark, d):
    """Rows cloned under new ids with their counts zeroed and a suffix on the name."""
    i = incidents(spark, d).select("id", "fatalities", "road_name")
    top = i.agg(F.max("id").alias("top"))  # one row
    clones = i.where(F.coalesce("fatalities", F.lit(0)) >= 3).join(F.broadcast(top)).select((F.col("id") + F.col("top")).alias("id"), F.lit(0).alias("fatalities"), F.concat("road_name", F.lit(" (split)")).alias("road_name"))
    return i.unionByName(clones)


@query(f"""with {INC}, {LINKS}, m as (select id as old_id, id * 2 + 1 as new_id from inc) select m.new_id as incident_id, count(*) as n from lnk l join m on m.old_id = l.incident_id group by 1""")
def id_remap(spark, d):
    """Child rows moved to new parent ids by a mapping table."""
    m = incidents(spark, d).select(F.col("id").alias("incident_id"), (F.col("id") * 2 + 1).alias("new_id"))
    return links(spark, d).join(m, "incident_id").groupBy(F.col("new_id").alias("incident_id")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {INC} select h.id from hotspot h where exists (select 1 from inc i where i.cluster_id = h.id and i.road_type = 'NH')""")
def hotspots_on_road_type(spark, d):
    i = incidents(spark, d).where("road_type = 'NH'").select(F.col("cluster_id").alias("id"))
    return table(spark, d, "hotspot").select("id").join(i, "id", "left_semi")


@query("""select lower(title) as title, min(item_id) as first_item, count(*) as n from feed_item where title is not null group by 1""")
def ordered_dedupe(spark, d):
    """First row of each text, case aside."""
    return table(spark, d, "feed_item").where("title is not null").groupBy(F.lower("title").alias("title")).agg(F.min("item_id").alias("first_item"), F.count(F.lit(1)).alias("n"))


@query("""select source_domain, count(*) as n, round(count(*) filter (where not resolved) / count(*)::double, 6) as loss from feed_item where source_domain is not null group by 1 having count(*) >= 5""")
def loss_rates(spark, d):
    f = table(spark, d, "feed_item").where("source_domain is not null")
    return f.groupBy("source_domain").agg(F.count(F.lit(1)).alias("n"), F.round(F.try_divide(F.count_if(~F.col("resolved")), F.count(F.lit(1)).cast("double")), 6).alias("loss")).where("n >= 5")


@query("""select language, processing_status, count(*) as n from source_article where language is not null group by cube (language, processing_status)""")
def status_cube(spark, d):
    return table(spark, d, "source_article").where("language is not null").cube("language", "processing_status").agg(F.count(F.lit(1)).alias("n"))


@query("""select id, title_rank from (select id, row_number() over (partition by admin_state order by priority_score desc nulls last, id) as title_rank from hotspot where admin_state is not null) where title_rank <= 3""")
def top_per_state(spark, d):
    h = table(spark, d, "hotspot").where("admin_state is not null").select("id", "admin_state", "priority_score")
    rank = F.row_number().over(Window.partitionBy("admin_state").orderBy(F.desc_nulls_last("priority_score"), "id"))
    return h.withColumn("title_rank", rank).where("title_rank <= 3").select("id", "title_rank")
