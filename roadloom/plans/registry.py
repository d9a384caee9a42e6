"""Queries over the incident registry, each with the same query in DuckDB's SQL (the oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geometry import ellipsoid_distance_m, mercator
from ..functions.text import coerce_int, outlet_tier, url_host
from ..operators.components import dbscan
from ..operators.defects import TAXONOMY, VOCABULARY, best_claims, claims, severity, taxonomy
from ..operators.hash_window import near_duplicates as near_hashes
from ..operators.proximity import located, within_distance
from ..operators.skew import salted_join
from ..operators.scoring import WEIGHTS, score_components, tier, total_score
from ..runtime import persist_table, table
from .geo_sql import HAV, PTS, SPOTS

QUERIES: dict = {}
SQL: dict[str, str] = {}
AS_OF = "2026-06-30"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def incidents(spark: SparkSession, d: str) -> DataFrame:
    """Incidents, each id once (some rows are written twice in full)."""
    return table(spark, d, "incident").dropDuplicates(["id"])


def links(spark: SparkSession, d: str) -> DataFrame:
    """Incident to article links, the best confidence of each (a null one only if there is no other)."""
    return table(spark, d, "incident_source").groupBy("incident_id", "source_article_id").agg(F.max("match_confidence").alias("match_confidence"))


def incident_defects(spark: SparkSession, d: str) -> DataFrame:
    """Defects that incidents' articles name, the best claim of each (incident_id, defect_type, confidence, source_id)."""
    return best_claims(claims(links(spark, d), table(spark, d, "source_article")))


INC = "inc as (select distinct * from incident)"
LINKS = "lnk as (select incident_id, source_article_id, max(match_confidence) as match_confidence from incident_source group by 1, 2)"


def ellipsoid_sql(a: str, b: str) -> str:
    phi = f"radians(({a}.lat + {b}.lat) / 2)"
    w = f"(1.0::double - 0.0066943799901413165::double * sin({phi}) * sin({phi}))"
    m, n = f"({6378137.0 * (1 - 0.0066943799901413165)!r}::double / ({w} * sqrt({w})))", f"(6378137.0::double / sqrt({w}))"
    dy, dx = f"({m} * radians({b}.lat - {a}.lat))", f"({n} * cos({phi}) * radians({b}.lon - {a}.lon))"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


# --- scans, sinks, set operations ------------------------------------------------------------------------------------

TERMS = ["pothole", "speed breaker", "street light", "crash barrier", "गड्ढे", "खड्ड", "गर्त", "ખાડા", "பள்ளம்", "గుంత"]


@query(f"""select id, cast(hit as boolean) as hit from (select id, ({" or ".join(f"contains(lower(clean_text), '{t}')" for t in TERMS)}) as hit
from source_article where processing_status = 'fetched' and clean_text is not null) order by hit desc, id limit 100""")
def defect_priority_queue(spark, d):
    """Rows of one status ranked by vocabulary hit, then id, before the cut (top 100 is the feature)."""
    a = table(spark, d, "source_article").where("processing_status = 'fetched' and clean_text is not null")
    hit = F.lower("clean_text").rlike("|".join(TERMS))
    return a.select("id", hit.alias("hit")).orderBy(F.desc("hit"), "id").limit(100)


@query("""select f.item_id, f.url from (select *, row_number() over (partition by url order by item_id) as rn from feed_item where url is not null) f
where rn = 1 and not exists (select 1 from source_article a where a.url = f.url)""")
def insert_if_absent(spark, d):
    """Rows that an insert keyed by url would add: first of each url, unless the url is there."""
    f = table(spark, d, "feed_item").where("url is not null").select("item_id", "url")
    first = f.groupBy("url").agg(F.min("item_id").alias("item_id"))
    return first.join(table(spark, d, "source_article").select("url"), "url", "left_anti").select("item_id", "url")


@query("""select source_domain, title, n_items from (select coalesce(regexp_replace(lower(source_domain), '^www\\.', ''), '') as source_domain, title,
row_number() over (partition by coalesce(regexp_replace(lower(source_domain), '^www\\.', ''), '') order by collected_at desc, item_id desc) as rn,
count(*) over (partition by coalesce(regexp_replace(lower(source_domain), '^www\\.', ''), '')) as n_items from feed_item) where rn = 1""")
def upsert_latest(spark, d):
    """Upsert by key: of all rows of a domain the latest stays (no window: one struct maximum per key)."""
    f = table(spark, d, "feed_item").select(F.coalesce(F.regexp_replace(F.lower("source_domain"), r"^www\.", ""), F.lit("")).alias("source_domain"), "title", "collected_at", "item_id")
    g = f.groupBy("source_domain").agg(F.max(F.struct("collected_at", "item_id", "title")).alias("s"), F.count(F.lit(1)).alias("n_items"))
    return g.select("source_domain", "s.title", "n_items")


@query("""select g.item_id from gdelt_item g where not exists (select 1 from feed_item f where f.source_domain is not distinct from g.source_domain and f.title is not distinct from g.title)""")
def null_safe_anti_join(spark, d):
    g, f = table(spark, d, "gdelt_item").alias("g"), table(spark, d, "feed_item").select("source_domain", "title").distinct().alias("f")
    return g.join(f, F.col("g.source_domain").eqNullSafe(F.col("f.source_domain")) & F.col("g.title").eqNullSafe(F.col("f.title")), "left_anti").select("item_id")


@query(f"""with {INC} select verification_status, new_status, count(*) as n from (select verification_status, case when verification_status = 'auto' and geocode_confidence >= 0.8 then 'machine_ok' else verification_status end as new_status from inc) group by 1, 2""")
def compare_and_set(spark, d):
    """Guarded bulk update as a projection, counted by transition."""
    i = incidents(spark, d)
    new = F.when((F.col("verification_status") == "auto") & (F.col("geocode_confidence") >= 0.8), "machine_ok").otherwise(F.col("verification_status"))
    return i.select("verification_status", new.alias("new_status")).groupBy("verification_status", "new_status").agg(F.count(F.lit(1)).alias("n"))


@query("""select incident_id, source_article_id, match_confidence from (select *, row_number() over (partition by incident_id, source_article_id order by match_confidence desc nulls last) as rn from incident_source) where rn = 1""")
def best_per_key(spark, d):
    return links(spark, d)


@query("""select case when processing_status = 'new' and fetched_at < timestamptz '2026-06-01 00:00:00+00' then 'expired' else processing_status end as status, count(*) as n from source_article group by 1""")
def ttl_expire(spark, d):
    old = F.col("fetched_at") < F.to_timestamp(F.lit("2026-07-01 00:00:00")) - F.make_dt_interval(F.lit(30))
    status = F.when((F.col("processing_status") == "new") & old, "expired").otherwise(F.col("processing_status"))
    return table(spark, d, "source_article").groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("""select distinct lower(coalesce(nullif(trim(source_domain), ''), '-')) as domain from feed_item except select distinct lower(coalesce(nullif(trim(source_domain), ''), '-')) from gdelt_item""")
def set_difference(spark, d):
    dom = F.lower(F.coalesce(F.nullif(F.trim("source_domain"), F.lit("")), F.lit("-"))).alias("domain")
    return table(spark, d, "feed_item").select(dom).distinct().subtract(table(spark, d, "gdelt_item").select(dom))


@query("""select 'incident' as entity, 'unknown road_type' as problem, count(*) as n from (select distinct * from incident) where road_type is null or road_type not in ('NH','SH','MDR','district','urban_arterial','urban_local','rural','unknown')
union all select 'incident', 'confidence outside 0..1', count(*) from (select distinct * from incident) where geocode_confidence not between 0 and 1 or extraction_confidence not between 0 and 1
union all select 'incident', 'negative casualties', count(*) from (select distinct * from incident) where fatalities < 0 or injuries < 0
union all select 'incident', 'dangling article', count(*) from (select distinct * from incident) i where primary_source_id is not null and not exists (select 1 from source_article a where a.id = i.primary_source_id)
union all select 'incident', 'dangling hotspot', count(*) from (select distinct * from incident) i where cluster_id is not null and not exists (select 1 from hotspot h where h.id = i.cluster_id)
union all select 'hotspot', 'score outside 0..100', count(*) from hotspot where priority_score not between 0 and 100""")
def constraint_violations(spark, d):
    """Checks, ranges and foreign keys that a database would enforce, counted by rule."""
    i, h = incidents(spark, d), table(spark, d, "hotspot")
    roads = ["NH", "SH", "MDR", "district", "urban_arterial", "urban_local", "rural", "unknown"]
    one = lambda df, e, p: df.agg(F.lit(e).alias("entity"), F.lit(p).alias("problem"), F.count(F.lit(1)).alias("n")).select("entity", "problem", "n")
    art, hot = table(spark, d, "source_article").select(F.col("id").alias("primary_source_id")), h.select(F.col("id").alias("cluster_id"))
    flags = i.agg(*[F.sum(F.coalesce(c, F.lit(False)).cast("bigint")).alias(n) for n, c in {"unknown road_type": F.col("road_type").isNull() | ~F.col("road_type").isin(roads), "confidence outside 0..1": ~F.col("geocode_confidence").between(0, 1) | ~F.col("extraction_confidence").between(0, 1), "negative casualties": (F.col("fatalities") < 0) | (F.col("injuries") < 0)}.items()])
    flat = flags.select(F.explode(F.create_map(*[x for n in flags.columns for x in (F.lit(n), F.coalesce(F.col(f"`{n}`"), F.lit(0)))])).alias("problem", "n")).select(F.lit("incident").alias("entity"), "problem", "n")
    out = flat.unionByName(one(i.where("primary_source_id is not null").join(art, "primary_source_id", "left_anti"), "incident", "dangling article"))
    out = out.unionByName(one(i.where("cluster_id is not null").join(hot, "cluster_id", "left_anti"), "incident", "dangling hotspot"))
    return out.unionByName(one(h.where(~F.col("priority_score").between(0, 100)), "hotspot", "score outside 0..100"))


@query("""select id, 'https://' || lower(regexp_extract(url, '^(?:[A-Za-z]+://)?([^/?#]*)', 1)) as site, decode(from_base64(rpad(b, cast(ceil(length(b) / 4.0) * 4 as int), '='))) as decoded
from (select id, url, replace(replace(regexp_extract(url, '/rss/articles/([A-Za-z0-9_-]+)', 1), '-', '+'), '_', '/') as b from source_article) where b <> ''""")
def redirect_targets(spark, d):
    """The id inside a redirect link, from url-safe base64."""
    b = F.translate(F.regexp_extract("url", r"/rss/articles/([A-Za-z0-9_-]+)", 1), "-_", "+/")
    a = table(spark, d, "source_article").select("id", "url", b.alias("b")).where("b <> ''")
    padded = F.rpad("b", (F.ceil(F.length("b") / 4.0) * 4).cast("int"), "=")
    return a.select("id", F.concat(F.lit("https://"), url_host(F.col("url"), keep_prefix=True)).alias("site"), F.decode(F.unbase64(padded), "UTF-8").alias("decoded"))


@query("""with t(lang, pos, term) as (values ('en', 1, 'road accident'), ('en', 2, 'crash'), ('en', 3, 'collision'), ('hi', 1, 'सड़क हादसा'), ('hi', 2, 'दुर्घटना'), ('mr', 1, 'अपघात'), ('bn', 1, 'দুর্ঘটনা'), ('ta', 1, 'விபத்து'), ('te', 1, 'ప్రమాదం'), ('gu', 1, 'અકસ્માત'), ('ur', 1, 'حادثہ')),
o as (select name, trim(unnest(string_split(language, ','))) as lang from outlet)
select name, lang, term, 'q=' || replace(url_encode(name || ' ' || term), '%20', '+') as query from (select distinct o.name, o.lang, t.term from o join t using (lang) where pos <= 3 union select name, 'en', 'accident' from outlet)""")
def query_matrix(spark, d):
    """Search queries: outlets times the first three terms of their languages, and an English starter each."""
    terms = [("en", 1, "road accident"), ("en", 2, "crash"), ("en", 3, "collision"), ("hi", 1, "सड़क हादसा"), ("hi", 2, "दुर्घटना"), ("mr", 1, "अपघात"), ("bn", 1, "দুর্ঘটনা"), ("ta", 1, "விபத்து"), ("te", 1, "ప్రమాదం"), ("gu", 1, "અકસ્માત"), ("ur", 1, "حادثہ")]
    t = spark.createDataFrame(terms, "lang string, pos int, term string").where("pos <= 3")
    o = table(spark, d, "outlet")
    pairs = o.select("name", F.explode(F.split("language", ",")).alias("lang")).withColumn("lang", F.trim("lang")).join(t, "lang").select("name", "lang", "term")
    every = pairs.unionByName(o.select("name", F.lit("en").alias("lang"), F.lit("accident").alias("term"))).distinct()
    return every.withColumn("query", F.concat(F.lit("q="), F.url_encode(F.concat_ws(" ", "name", "term"))))


# --- joins and aggregates --------------------------------------------------------------------------------------------


@query(f"""with {INC} select i.id, a.outlet_name, coalesce(i.admin_district, nullif(a.district, ''), nullif(a.state, ''), '-') as anchor from inc i left join source_article a on a.id = i.primary_source_id""")
def incident_anchor(spark, d):
    """Left join to the primary article with fallback anchors."""
    a = table(spark, d, "source_article").select(F.col("id").alias("primary_source_id"), "outlet_name", F.nullif("district", F.lit("")).alias("ad"), F.nullif("state", F.lit("")).alias("ast"))
    return incidents(spark, d).select("id", "primary_source_id", "admin_district").join(a, "primary_source_id", "left").select("id", "outlet_name", F.coalesce("admin_district", "ad", "ast", F.lit("-")).alias("anchor"))


@query(f"""with {INC}, {LINKS}, m as (select cluster_id as id, count(*) as incidents, sum(coalesce(fatalities, 0)) as fatalities from inc where cluster_id is not null group by 1),
s as (select i.cluster_id as id, count(distinct l.source_article_id) as sources from inc i join lnk l on l.incident_id = i.id where cluster_id is not null group by 1)
select h.id, coalesce(m.incidents, 0) as incidents, cast(coalesce(m.fatalities, 0) as bigint) as fatalities, coalesce(s.sources, 0) as sources from hotspot h left join m using (id) left join s using (id)""")
def hotspot_members(spark, d):
    """Members and distinct sources of every hotspot, empty ones kept, each child aggregated before its join."""
    i = incidents(spark, d).where("cluster_id is not null").select("id", "cluster_id", "fatalities")
    m = i.groupBy(F.col("cluster_id").alias("id")).agg(F.count(F.lit(1)).alias("incidents"), F.sum(F.coalesce("fatalities", F.lit(0))).alias("fatalities"))
    s = links(spark, d).join(i.select(F.col("id").alias("incident_id"), "cluster_id"), "incident_id").groupBy(F.col("cluster_id").alias("id")).agg(F.countDistinct("source_article_id").alias("sources"))
    h = table(spark, d, "hotspot").select("id")
    return h.join(m, "id", "left").join(s, "id", "left").select("id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("incidents", "fatalities", "sources")])


@query(f"""with {INC}, {LINKS} select i.id from inc i where exists (select 1 from lnk l join source_article a on a.id = l.source_article_id where l.incident_id = i.id and a.processing_status = 'extracted')""")
def semi_join(spark, d):
    a = table(spark, d, "source_article").where("processing_status = 'extracted'").select(F.col("id").alias("source_article_id"))
    return incidents(spark, d).select("id").join(links(spark, d).join(a, "source_article_id", "left_semi").select(F.col("incident_id").alias("id")), "id", "left_semi")


@query("""select id from source_article a where not exists (select 1 from incident_source s where s.source_article_id = a.id)""")
def anti_join(spark, d):
    return table(spark, d, "source_article").select("id").join(table(spark, d, "incident_source").select(F.col("source_article_id").alias("id")), "id", "left_anti")


@query("""select source_domain, item_id, lag(item_id) over (partition by source_domain order by collected_at, item_id) as previous_item from feed_item where source_domain is not null""")
def previous_value(spark, d):
    """The latest earlier row of the same key.

    The window is over a key's day, so a hot key is spread; the first row of a day takes the last of the key's day before.
    """
    f = table(spark, d, "feed_item").where("source_domain is not null").select("source_domain", "item_id", "collected_at", F.to_date("collected_at").alias("day"))
    inside = F.lag("item_id").over(Window.partitionBy("source_domain", "day").orderBy("collected_at", "item_id"))
    last = f.groupBy("source_domain", "day").agg(F.max_by("item_id", F.struct("collected_at", "item_id")).alias("last"))
    last = last.select("source_domain", "day", F.lag("last").over(Window.partitionBy("source_domain").orderBy("day")).alias("before"))
    r = f.withColumn("inside", inside).join(last.withColumnsRenamed({"source_domain": "_s", "day": "_d"}), (F.col("source_domain") == F.col("_s")) & F.col("day").eqNullSafe(F.col("_d")))
    return r.select("source_domain", "item_id", F.coalesce("inside", "before").alias("previous_item"))


@query(f"""with {INC} select coalesce(geocode_method, 'unresolved') as method, count(*) as n, count(lat) as with_lat, count(*) filter (where fatalities > 0) as fatal, round(avg(geocode_confidence), 2) as avg_confidence from inc group by 1""")
def geocode_methods(spark, d):
    return incidents(spark, d).groupBy(F.coalesce("geocode_method", F.lit("unresolved")).alias("method")).agg(F.count(F.lit(1)).alias("n"), F.count("lat").alias("with_lat"), F.count_if(F.col("fatalities") > 0).alias("fatal"), F.round(F.avg("geocode_confidence"), 2).alias("avg_confidence"))


@query(f"""with {INC} select count(*) as incidents, count(distinct admin_district) as districts, cast(sum(coalesce(fatalities, 0)) as bigint) as fatalities, cast(sum(coalesce(injuries, 0)) as bigint) as injuries, min(crash_date) as first_date, max(crash_date) as last_date from inc""")
def registry_totals(spark, d):
    return incidents(spark, d).agg(F.count(F.lit(1)).alias("incidents"), F.countDistinct("admin_district").alias("districts"), F.sum(F.coalesce("fatalities", F.lit(0))).alias("fatalities"), F.sum(F.coalesce("injuries", F.lit(0))).alias("injuries"), F.min("crash_date").alias("first_date"), F.max("crash_date").alias("last_date"))


@query(f"""with {INC} select v as victim_type, count(*) as n, count(distinct id) as incidents from (select id, unnest(victim_types) as v from inc) group by 1""")
def facet_victims(spark, d):
    return incidents(spark, d).select("id", F.explode("victim_types").alias("victim_type")).groupBy("victim_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("incidents"))


@query(f"""with {INC} select admin_state, admin_district, count(*) as n from inc where admin_state is not null and admin_district is not null group by 1, 2 order by n desc, 1, 2 limit 20""")
def top_districts(spark, d):
    return incidents(spark, d).where("admin_state is not null and admin_district is not null").groupBy("admin_state", "admin_district").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "admin_state", "admin_district").limit(20)


@query(f"""with {INC}, c as (select cluster_id, v, count(*) as n, max(geocode_confidence) as mx from (select cluster_id, geocode_confidence, unnest(victim_types) as v from inc where cluster_id is not null) group by 1, 2),
r as (select *, row_number() over (partition by cluster_id order by n desc, mx desc nulls last, v) as rn from c) select cluster_id, string_agg(v, ',' order by rn) as top_types from r where rn <= 3 group by 1""")
def top_types_per_cluster(spark, d):
    """Top three categories of each cluster, ordered, joined to one string."""
    c = incidents(spark, d).where("cluster_id is not null").select("cluster_id", "geocode_confidence", F.explode("victim_types").alias("v")).groupBy("cluster_id", "v").agg(F.count(F.lit(1)).alias("n"), F.max("geocode_confidence").alias("mx"))
    rn = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("n"), F.desc_nulls_last("mx"), "v"))
    r = c.withColumn("rn", rn).where("rn <= 3")
    return r.groupBy("cluster_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "v"))), lambda s: s["v"]), ",").alias("top_types"))


@query(f"""with {INC}, k as (select cluster_id, road_name, count(*) as n from inc where cluster_id is not null and road_name is not null group by 1, 2),
r as (select *, row_number() over (partition by cluster_id order by n desc, road_name) as rn from k) select cluster_id, road_name as modal_road from r where rn = 1""")
def cluster_mode(spark, d):
    """Most frequent value per cluster, the smallest on ties."""
    k = incidents(spark, d).where("cluster_id is not null and road_name is not null").groupBy("cluster_id", "road_name").agg(F.count(F.lit(1)).alias("n"))
    return k.groupBy("cluster_id").agg(F.min(F.struct(-F.col("n"), "road_name")).alias("s")).select("cluster_id", F.col("s.road_name").alias("modal_road"))


@query(f"""with {INC} select id, coalesce(try_cast(regexp_extract(road_name, '([0-9]+)', 1) as int), 0) as road_no, split_part(road_name, '-', 1) as road_class, upper(left(coalesce(admin_city, ''), 3)) as city3, length(trim(coalesce(road_name, ''))) > 0 as named from inc""")
def scalar_functions(spark, d):
    i = incidents(spark, d)
    return i.select("id", F.coalesce(coerce_int(F.regexp_extract("road_name", r"([0-9]+)", 1)), F.lit(0)).alias("road_no"), F.substring_index("road_name", "-", 1).alias("road_class"), F.upper(F.left(F.coalesce("admin_city", F.lit("")), F.lit(3))).alias("city3"), (F.length(F.trim(F.coalesce("road_name", F.lit("")))) > 0).alias("named"))


@query("""select item_id, regexp_replace(lower(regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)', 1)), '^(?:(?:www|m|mobile|amp)\\.)+', '') as host from feed_item where url is not null""")
def url_hosts(spark, d):
    return table(spark, d, "feed_item").where("url is not null").select("item_id", url_host(F.col("url")).alias("host"))


@query("""select f.item_id, case when f.source_domain is null then 'aggregator' else coalesce(o.tier, 'regional') end as tier from feed_item f left join outlet o on regexp_replace(lower(trim(o.website)), '^www\\.', '') = regexp_replace(lower(trim(f.source_domain)), '^www\\.', '')""")
def outlet_tiers(spark, d):
    return outlet_tier(table(spark, d, "feed_item"), table(spark, d, "outlet"))


@query("""select a.id, min(b.id) as first_like_it from source_article a join source_article b on b.id < a.id and b.dedup_hash = a.dedup_hash and a.dedup_hash <> ''
and (case when nullif(a.district, '') is not null then nullif(b.district, '') = a.district else nullif(b.state, '') = nullif(a.state, '') end) and abs(epoch_us(a.fetched_at) - epoch_us(b.fetched_at)) <= 604800000000 group by 1""")
def exact_duplicates(spark, d):
    """The first earlier article with the same hash in the same locality within seven days of fetching."""
    return near_hashes(table(spark, d, "source_article"), max_bits=0)


@query(f"""select a.id, min(b.id) as first_like_it from source_article a join source_article b on b.id < a.id and a.dedup_hash <> '' and b.dedup_hash <> ''
and (case when nullif(a.district, '') is not null then nullif(b.district, '') = a.district else nullif(b.state, '') = nullif(a.state, '') end)
and bit_count(xor(('0x' || substr(a.dedup_hash, 1, 8))::bigint, ('0x' || substr(b.dedup_hash, 1, 8))::bigint)) + bit_count(xor(('0x' || substr(a.dedup_hash, 9, 8))::bigint, ('0x' || substr(b.dedup_hash, 9, 8))::bigint)) <= 3
and abs(epoch_us(a.fetched_at) - epoch_us(b.fetched_at)) <= 604800000000 group by 1""")
def near_duplicates(spark, d):
    """The first earlier article within three bits in the same locality and week, by four-band blocking."""
    return near_hashes(table(spark, d, "source_article"))


@query(f"""with {INC}, {LINKS} select i.id, count(l.source_article_id) as n_sources, coalesce(string_agg(cast(l.source_article_id as varchar), ',' order by l.source_article_id), '') as sources from inc i left join lnk l on l.incident_id = i.id group by 1""")
def dossier_sources(spark, d):
    """Nested children of each incident as an ordered list."""
    s = links(spark, d).groupBy(F.col("incident_id").alias("id")).agg(F.count(F.lit(1)).alias("n_sources"), F.array_join(F.transform(F.array_sort(F.collect_list("source_article_id")), lambda x: x.cast("string")), ",").alias("sources"))
    return incidents(spark, d).select("id").join(s, "id", "left").select("id", F.coalesce("n_sources", F.lit(0)).alias("n_sources"), F.coalesce("sources", F.lit("")).alias("sources"))


@query("""select row_number() over (order by coalesce(priority_score, 0) desc, id) as rank, id, coalesce(priority_score, 0) as score, array_to_string(dominant_defects, '; ') as defects from hotspot order by rank limit 50""")
def rankings_page(spark, d):
    """Ranked page of hotspots (the cut is the page): the global order is taken by a top-k, the rank only over the page."""
    h = table(spark, d, "hotspot").select("id", F.coalesce("priority_score", F.lit(0.0)).alias("score"), F.array_join("dominant_defects", "; ").alias("defects"))
    page = h.orderBy(F.desc("score"), "id").limit(50)
    return page.select(F.row_number().over(Window.orderBy(F.desc("score"), "id")).alias("rank"), "id", "score", "defects")


@query("""select id, priority_score from hotspot where status is not null order by priority_score desc nulls last, id limit 20 offset 20""")
def paginated(spark, d):
    return table(spark, d, "hotspot").where("status is not null").select("id", "priority_score").orderBy(F.desc_nulls_last("priority_score"), "id").offset(20).limit(20)


@query("""select id from hotspot where admin_state = 'Sindhara Pradesh' and priority_score >= 20 and incident_count >= 2 and list_contains(dominant_defects, 'missing_crash_barrier_or_guardrail')""")
def dynamic_filters(spark, d):
    """A conjunction folded from the filters that are set."""
    wanted = {"state": "Sindhara Pradesh", "min_score": 20, "repeat_only": True, "defect": "missing_crash_barrier_or_guardrail", "district": None}
    tests = {"state": lambda v: F.col("admin_state") == v, "district": lambda v: F.col("admin_district") == v, "min_score": lambda v: F.col("priority_score") >= v, "repeat_only": lambda v: F.col("incident_count") >= 2, "defect": lambda v: F.array_contains("dominant_defects", v)}
    cond = F.lit(True)
    for k, v in wanted.items():
        if v is not None:
            cond = cond & tests[k](v)
    return table(spark, d, "hotspot").where(cond).select("id")


@query(f"""with {INC} select i.id from inc i join source_article a on a.id = i.primary_source_id where i.crash_date is null or date_diff('day', i.crash_date, cast(a.fetched_at at time zone 'UTC' as date)) > 30""")
def suspicious_dates(spark, d):
    a = table(spark, d, "source_article").select(F.col("id").alias("primary_source_id"), F.to_date("fetched_at").alias("seen"))
    return incidents(spark, d).join(a, "primary_source_id").where("crash_date is null or datediff(seen, crash_date) > 30").select("id")


@query("""with r as (select item_id, collected_at, resolved, sum(case when resolved then 1 else 0 end) over (order by collected_at, item_id rows unbounded preceding) as island from feed_item),
s as (select island, count(*) filter (where not resolved) as streak, min(item_id) filter (where not resolved) as first_item from r group by 1) select island, streak, first_item from s where streak >= 3""")
def failure_streaks(spark, d):
    """Runs of three or more failures in order of collection.

    The running count of successes is taken without one global window: a count per day, a running sum over the days (one
    row each), and a window inside each day.
    """
    f = table(spark, d, "feed_item").select("item_id", "collected_at", F.coalesce("resolved", F.lit(False)).alias("ok"), F.to_date("collected_at").alias("day"))
    per_day = f.groupBy("day").agg(F.sum(F.col("ok").cast("bigint")).alias("n"))
    before = per_day.select("day", (F.sum("n").over(Window.orderBy("day")) - F.col("n")).alias("before"))
    inside = F.sum(F.col("ok").cast("bigint")).over(Window.partitionBy("day").orderBy("collected_at", "item_id").rowsBetween(Window.unboundedPreceding, 0))
    r = f.join(before, "day").withColumn("island", F.col("before") + inside)
    bad = ~F.col("ok")
    return r.groupBy("island").agg(F.count_if(bad).alias("streak"), F.min(F.when(bad, F.col("item_id"))).alias("first_item")).where("streak >= 3")


@query("""select batch_no, count(*) as n, sum(count(*)) over (order by batch_no rows unbounded preceding) as running from source_article group by 1""")
def running_total(spark, d):
    g = table(spark, d, "source_article").groupBy("batch_no").agg(F.count(F.lit(1)).alias("n"))
    return g.select("batch_no", "n", F.sum("n").over(Window.orderBy("batch_no").rowsBetween(Window.unboundedPreceding, 0)).alias("running"))


@query(f"""with {INC} select 'located' as name, count(*) filter (where geom is not null and geom <> '') as value from inc union all select 'undated', count(*) filter (where crash_date is null) from inc
union all select 'articles', count(*) from source_article union all select 'stuck', count(*) from source_article where processing_status = 'new'""")
def health_checks(spark, d):
    i = incidents(spark, d).agg(F.count_if(F.col("geom") != "").alias("located"), F.count_if(F.col("crash_date").isNull()).alias("undated"))
    a = table(spark, d, "source_article").agg(F.count(F.lit(1)).alias("articles"), F.count_if(F.col("processing_status") == "new").alias("stuck"))
    return i.selectExpr("stack(2, 'located', located, 'undated', undated) as (name, value)").unionByName(a.selectExpr("stack(2, 'articles', articles, 'stuck', stuck) as (name, value)"))


@query("""select f.item_id, r.region_id from feed_item f join district_area r on contains(lower(f.title), lower(r.admin_district))""")
def name_hits(spark, d):
    """Place names in titles: words of the title meet the names by an equi-join, the substring test decides."""
    r = table(spark, d, "district_area").where("admin_district is not null").select("region_id", F.lower("admin_district").alias("name"))
    sizes = [x[0] for x in r.select(F.length("name")).distinct().collect()]  # lengths of names: a few dozen at most
    t = table(spark, d, "feed_item").where("title is not null").select("item_id", F.lower("title").alias("t"))

    def pieces(n):
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length("t") - (n - 1), F.lit(1))), lambda i: F.substr(F.col("t"), i, F.lit(n)))

    grams = F.flatten(F.array(*[pieces(n) for n in sizes]))
    return t.select("item_id", F.explode(F.array_distinct(grams)).alias("name")).join(r, "name").select("item_id", "region_id")


# --- space -----------------------------------------------------------------------------------------------------------


@query(f"""with {PTS} select id, lat, lon, round(6378137.0::double * radians(lon), 3) as x, round(6378137.0::double * ln(tan(pi() / 4 + radians(lat) / 2)), 3) as y, (lat between 6.0 and 37.6 and lon between 68.0 and 97.5) as in_box from pt""")
def located_points(spark, d):
    p = located(table(spark, d, "incident"), "id", "geom")
    x, y = mercator(F.col("lat"), F.col("lon"))
    return p.select("id", "lat", "lon", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"), (F.col("lat").between(6.0, 37.6) & F.col("lon").between(68.0, 97.5)).alias("in_box"))


@query(f"""with {PTS} select cast(floor(lat / 0.5) as bigint) as ty, cast(floor(lon / 0.5) as bigint) as tx, count(*) as n, round(avg(lat), 6) as lat, round(avg(lon), 6) as lon, 6 + 3 * least(count(*), 5) as radius from pt group by 1, 2""")
def map_tiles(spark, d):
    p = located(table(spark, d, "incident"), "id", "geom")
    return p.groupBy(F.floor(F.col("lat") / 0.5).alias("ty"), F.floor(F.col("lon") / 0.5).alias("tx")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon")).withColumn("radius", 6 + 3 * F.least("n", F.lit(5)))


@query(f"""with {INC}, {PTS}, v as (select i.id, i.crash_date, coalesce(i.fatalities, 0) as f, coalesce(i.injuries, 0) as j, coalesce(i.extraction_confidence, 0) as c, pt.lat, pt.lon from inc i join pt using (id) where crash_date is not null)
select case when a.c >= b.c then a.id else b.id end as keep_id, case when a.c >= b.c then b.id else a.id end as merge_id, round({ellipsoid_sql("a", "b")}, 3) as dist_m from v a join v b on a.id < b.id and abs(date_diff('day', a.crash_date, b.crash_date)) <= 1
and abs(a.lat - b.lat) < 0.01 and {ellipsoid_sql("a", "b")} <= 1000 and abs(a.f - b.f) <= 1 and abs(a.j - b.j) <= 3""")
def same_crash_pairs(spark, d):
    """Reports of one event: a grid and day equi-join with crowded keys split, then distance, dates and casualties exactly."""
    p = located(table(spark, d, "incident"), "id", "geom")
    i = incidents(spark, d).where("crash_date is not null").select("id", "crash_date", F.coalesce("fatalities", F.lit(0)).alias("f"), F.coalesce("injuries", F.lit(0)).alias("j"), F.coalesce("extraction_confidence", F.lit(0.0)).alias("c"))
    v = i.join(p, "id").withColumn("day", F.datediff("crash_date", F.lit("1970-01-01")))
    step = 1000 / 110000.0
    wide = step / 0.7  # a degree of longitude is at least 0.7 of one of latitude up to 45 degrees; beyond, three more columns
    cell = lambda c, s: F.floor(F.col(c) / s)
    span = F.ceil(F.lit(0.7) / F.cos(F.radians(F.abs("lat") + step)))
    a = v.select(*[F.col(c).alias("a_" + c) for c in v.columns], cell("lat", step).alias("cy"), cell("lon", wide).alias("cx"), F.col("day").alias("cd"))
    b = v.select("*", F.explode(F.sequence(cell("lat", step) - 1, cell("lat", step) + 1)).alias("cy"), span.alias("_span"))
    b = b.select("*", F.explode(F.sequence(cell("lon", wide) - F.col("_span"), cell("lon", wide) + F.col("_span"))).alias("cx"))
    b = b.select("*", F.explode(F.sequence(F.col("day") - 1, F.col("day") + 1)).alias("cd"))
    dist = ellipsoid_distance_m(F.col("a_lat"), F.col("a_lon"), F.col("lat"), F.col("lon"))
    near = (F.col("a_id") < F.col("id")) & (dist <= 1000) & (F.abs(F.col("a_f") - F.col("f")) <= 1) & (F.abs(F.col("a_j") - F.col("j")) <= 3)
    j = salted_join(a, b, ["cy", "cx", "cd"]).where(near)
    first = F.col("a_c") >= F.col("c")
    return j.select(F.when(first, F.col("a_id")).otherwise(F.col("id")).alias("keep_id"), F.when(first, F.col("id")).otherwise(F.col("a_id")).alias("merge_id"), F.round(dist, 3).alias("dist_m"))


# Clustering distance by type of road, in metres; the mean, cut to whole metres, holds for all.
EPSILON_M = {"NH": 300, "SH": 300, "MDR": 250, "district": 250, "urban_arterial": 150, "urban_local": 150, "rural": 250, "unknown": 200}


def cluster_epsilon(settings: dict[str, float], default: int = 250) -> int:
    """The distance for all incidents from those by type of road."""
    return int(sum(settings.values()) / len(settings)) if settings else default


def _clusters(spark, d):
    ok = incidents(spark, d).where("geocode_confidence >= 0.5").select("id")
    pts = located(table(spark, d, "incident"), "id", "geom").join(ok, "id", "left_semi")
    return persist_table(dbscan(pts, float(cluster_epsilon(EPSILON_M))), "clusters"), pts


DB = f"""{INC}, {PTS}, q as (select pt.id, pt.lat, pt.lon, 6378137.0::double * radians(pt.lon) as x, 6378137.0::double * ln(tan(pi() / 4 + radians(pt.lat) / 2)) as y from pt join inc using (id) where inc.geocode_confidence >= 0.5),
c as (select *, cast(floor(x / 231) as bigint) as cx, cast(floor(y / 231) as bigint) as cy from q), n as (select unnest([-1, 0, 1]) as v),
e as (select a.id as a, b.id as b from (select c.*, cx + n1.v as jx, cy + n2.v as jy from c, n n1, n n2) a join c b on a.jx = b.cx and a.jy = b.cy where a.id <> b.id and (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 231 * 231),
w as (select id, id as l from q union select e.b, w.l from w join e on e.a = w.id where w.l < e.b), k as (select id, min(l) as cluster from w group by 1)"""


@query(f"with recursive {DB} select id, cluster from k")
def dbscan_clusters(spark, d):
    """Density clusters of eps 231 Web-Mercator units, one point enough; the label is the smallest member."""
    return _clusters(spark, d)[0]


@query(f"""with recursive {DB} select k.cluster, count(*) as n, round(avg(q.lat), 6) as lat, round(avg(q.lon), 6) as lon, cast(sum(coalesce(inc.fatalities, 0)) as bigint) as fatalities, min(inc.crash_date) as first_date, max(inc.crash_date) as last_date from k join q using (id) join inc using (id) group by 1""")
def cluster_aggregates(spark, d):
    c, pts = _clusters(spark, d)
    i = incidents(spark, d).select("id", "fatalities", "crash_date")
    return c.join(pts, "id").join(i, "id").groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon"), F.sum(F.coalesce("fatalities", F.lit(0))).alias("fatalities"), F.min("crash_date").alias("first_date"), F.max("crash_date").alias("last_date"))




@query(f"""with {PTS}, {SPOTS}, m as (select pt.id, sp.id as hotspot_id, round({HAV("pt", "sp")}, 3) as dist_m from pt join sp on abs(pt.lat - sp.lat) < 0.01 and {HAV("pt", "sp")} <= 300),
r as (select *, row_number() over (partition by id order by dist_m, hotspot_id) as rn from m) select id, hotspot_id, dist_m from r where rn = 1""")
def nearest_hotspot(spark, d):
    """The nearest hotspot within 300 m of each located incident."""
    m = within_distance(located(table(spark, d, "incident"), "id", "geom"), located(table(spark, d, "hotspot"), "id", "centroid_geom"), 300.0)
    best = m.groupBy(F.col("id_a").alias("id")).agg(F.min(F.struct(F.round("dist_m", 3).alias("dist_m"), F.col("id_b").alias("hotspot_id"))).alias("s"))
    return best.select("id", "s.hotspot_id", "s.dist_m")


@query(f"""with recursive {DB}, ce as (select k.cluster as id, avg(q.lat) as lat, avg(q.lon) as lon from k join q using (id) group by 1), {SPOTS},
m as (select ce.id as cluster, sp.id as hotspot_id, round({HAV("ce", "sp")}, 3) as dm from ce join sp on abs(ce.lat - sp.lat) < 0.01 and {HAV("ce", "sp")} <= 300),
one as (select *, row_number() over (partition by cluster order by dm, hotspot_id) as rn from m), two as (select *, row_number() over (partition by hotspot_id order by dm, cluster) as rh from one where rn = 1)
select ce.id as cluster, two.hotspot_id as kept_id from ce left join two on two.cluster = ce.id and two.rh = 1""")
def stable_hotspot_match(spark, d):
    """Rebuilt clusters keep the id of the nearest old hotspot; of several claimants the nearest keeps it, the rest are new."""
    return kept_ids(spark, d, *_clusters(spark, d))


def kept_ids(spark: SparkSession, d: str, c: DataFrame, pts: DataFrame) -> DataFrame:
    """(cluster, kept_id) of clusters (id, cluster) of points (id, lat, lon)."""
    ce = persist_table(c.join(pts, "id").groupBy(F.col("cluster").alias("id")).agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon")), "centroids")
    m = within_distance(ce, located(table(spark, d, "hotspot"), "id", "centroid_geom"), 300.0).select("id_a", "id_b", F.round("dist_m", 3).alias("dm"))
    one = m.groupBy("id_a").agg(F.min(F.struct("dm", "id_b")).alias("s")).select("id_a", "s.dm", "s.id_b")
    two = one.groupBy("id_b").agg(F.min(F.struct("dm", "id_a")).alias("s")).select(F.col("s.id_a").alias("cluster"), F.col("id_b").alias("kept_id"))
    return ce.select(F.col("id").alias("cluster")).join(two, "cluster", "left")


# --- scores ----------------------------------------------------------------------------------------------------------


def _raw(spark, d):
    i = incidents(spark, d).where("cluster_id is not null")
    since = F.add_months(F.lit(AS_OF).cast("date"), -6)
    weak = F.arrays_overlap("victim_types", F.array(F.lit("pedestrian"), F.lit("two_wheeler"), F.lit("cyclist")))
    m = i.groupBy(F.col("cluster_id").alias("id")).agg(F.sum(F.coalesce("fatalities", F.lit(0))).alias("fatalities"), F.sum(F.coalesce("injuries", F.lit(0))).alias("injuries"), F.count_if(F.col("crash_date") >= since).alias("inc_6mo"), F.max("crash_date").alias("last_date"), F.avg(F.when(weak, 1.0).otherwise(0.0)).alias("vulnerable_share"), F.avg("geocode_confidence").alias("avg_conf"))
    s = links(spark, d).join(i.select(F.col("id").alias("incident_id"), F.col("cluster_id")), "incident_id").groupBy(F.col("cluster_id").alias("id")).agg(F.countDistinct("source_article_id").alias("n_sources"))
    worst = severity(incident_defects(spark, d), i.select("id", F.col("cluster_id").alias("cluster")), taxonomy(spark)).select(F.col("cluster").alias("id"), F.col("severity").alias("max_severity"))
    r = table(spark, d, "hotspot").select("id").join(m, "id", "left").join(s, "id", "left").join(worst, "id", "left")
    r = r.withColumn("days_since_last", F.datediff(F.lit(AS_OF).cast("date"), F.col("last_date")))
    return r.fillna(0, ["fatalities", "injuries", "inc_6mo", "n_sources"]).fillna(0.0, ["vulnerable_share", "avg_conf", "max_severity"])


TAX = "tax(code, weight, is_defect) as (values " + ", ".join(f"('{c}', {w}::double, {str(b).lower()})" for c, w, b in TAXONOMY) + ")"
#: claims and dfx: the defects that incidents' articles name, and the best of each incident and code.
DEFECTS = "voc(code, term) as (values " + ", ".join(f"('{c}', '{t}')" for c, ts in VOCABULARY.items() for t in ts) + """),
claims as (select distinct l.incident_id, v.code as defect_type, l.match_confidence as confidence, l.source_article_id as source_id from lnk l join source_article a on a.id = l.source_article_id join voc v on contains(lower(a.clean_text), v.term)),
dfx as (select incident_id, defect_type, confidence, source_id from (select *, row_number() over (partition by incident_id, defect_type order by confidence desc nulls last, source_id) as rn from claims) where rn = 1)"""
RAW = f"""{INC}, {LINKS}, {TAX}, {DEFECTS}, sv as (select i.cluster_id as id, max(t.weight) as w from dfx x join tax t on t.code = x.defect_type join inc i on i.id = x.incident_id where t.is_defect and i.cluster_id is not null group by 1), m as (select cluster_id as id, sum(coalesce(fatalities, 0)) as f, sum(coalesce(injuries, 0)) as j, count(*) filter (where crash_date >= date '2025-12-30') as n6, max(crash_date) as last_date,
avg(case when list_has_any(victim_types, ['pedestrian', 'two_wheeler', 'cyclist']) then 1.0::double else 0.0::double end) as vs, avg(geocode_confidence) as ac from inc where cluster_id is not null group by 1),
s as (select i.cluster_id as id, count(distinct l.source_article_id) as ns from inc i join lnk l on l.incident_id = i.id where i.cluster_id is not null group by 1),
r as (select h.id, coalesce(f, 0)::double as f, coalesce(j, 0)::double as j, coalesce(n6, 0) as n6, date_diff('day', last_date, date '{AS_OF}') as ds, coalesce(vs, 0) as vs, coalesce(ac, 0) as ac, coalesce(ns, 0) as ns, coalesce(sv.w, 0) as sev from hotspot h left join m using (id) left join s using (id) left join sv using (id)),
co as (select id, n6, 1 - exp(-(5 * f + j) / 10) as c1, 1 - exp(-n6 / 3.0::double) as c2, case when ds is null then 0 else exp(-greatest(ds, 0) / 90.0::double) end as c3, vs as c4, least(1.0::double, sev / 5) as c5, least(1.0::double, ns / 3.0::double) * ac as c6 from r),
sc as (select *, round(100 * (0.3::double * c1 + 0.25::double * c2 + 0.15::double * c3 + 0.15::double * c4 + 0.1::double * c5 + 0.05::double * c6), 1) as score from co)"""


@query(f"with {RAW} select id, round(c1, 6) as casualties, round(c2, 6) as frequency, round(c3, 6) as recency, round(c4, 6) as vulnerable, round(c5, 6) as severity, round(c6, 6) as evidence from sc")
def score_parts(spark, d):
    parts = score_components(_raw(spark, d))
    return parts.select("id", *[F.round(c, 6).alias(c) for c in WEIGHTS])


@query(f"with {RAW} select id, score, case when score >= 75 then 'critical' when score >= 50 then 'high' when score >= 25 then 'medium' else 'watch' end as tier, n6 >= 3 as escalation from sc order by score desc, id limit 15")
def hotspot_ranking(spark, d):
    """Top fifteen hotspots by the weighted score (a top-k report)."""
    s = total_score(score_components(_raw(spark, d)))
    return s.select("id", "score", tier(F.col("score")).alias("tier"), (F.col("inc_6mo") >= 3).alias("escalation")).orderBy(F.desc("score"), "id").limit(15)


@query(f"with {RAW} select case when score >= 75 then 'critical' when score >= 50 then 'high' when score >= 25 then 'medium' else 'watch' end as tier, count(*) as n, round(avg(score), 4) as avg_score from sc group by 1")
def tier_counts(spark, d):
    s = total_score(score_components(_raw(spark, d)))
    return s.groupBy(tier(F.col("score")).alias("tier")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 4).alias("avg_score"))
