"""Queries of the nightly run and its pages: defects, rebuilt hotspots, queues, lookups, exports, audit and streams, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import outlet_tier
from ..operators import hash_window
from ..operators.defects import claims, dominant, modes, severity, taxonomy
from ..operators.geocoding import DISTRICT_NAMES, same_district
from ..operators.instants import with_article_instant
from ..operators.lookup import cached, fresh_entries
from ..operators.names import passes_keywords, site_mentions
from ..operators.numbering import numbered
from ..operators.proximity import located, near_counts
from ..operators.scoring import WEIGHTS, score_components, tier, total_score
from ..runtime import persist_table, scratch_path, table
from ..sources.feeds import FIELDS, listed_articles, rss_items
from ..sources.files import nested, read_jsonl, write_jsonl
from ..streaming.intake import event_stream, expired_keys, run_to_table, sliding_counts, upsert_stream
from .geo_sql import HAV, PTS, SPOTS
from .registry import AS_OF, DB, DEFECTS, INC, LINKS, RAW, TAX, _clusters, _raw, incident_defects, incidents, kept_ids, links

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- defects and hotspots ---------------------------------------------------------------------------------------------


@query(f"with {INC}, {LINKS}, {DEFECTS} select incident_id, defect_type, confidence, source_id from dfx")
def best_defects(spark, d):
    """The best claim of each incident and defect; claims without a confidence stay only where there is no other."""
    return incident_defects(spark, d)


@query(f"""with {INC}, {LINKS}, {DEFECTS}, {TAX} select i.cluster_id as id, max(t.weight) as severity from dfx x join tax t on t.code = x.defect_type join inc i on i.id = x.incident_id where t.is_defect and i.cluster_id is not null group by 1""")
def hotspot_severity(spark, d):
    """Greatest severity weight over all members' defects, by joins with the defects and the taxonomy."""
    m = incidents(spark, d).select("id", F.col("cluster_id").alias("cluster"))
    return severity(incident_defects(spark, d), m, taxonomy(spark)).withColumnRenamed("cluster", "id")


DOM = """dn as (select m.cluster, x.defect_type, count(*) as n, max(x.confidence) as mx from dfx x join tax t on t.code = x.defect_type and t.is_defect join {members} m on m.id = x.incident_id group by 1, 2),
dr as (select *, row_number() over (partition by cluster order by n desc, mx desc nulls last, defect_type) as rn from dn), dom as (select cluster, string_agg(defect_type, ',' order by rn) as defects from dr where rn <= 3 group by 1)"""


@query(f"with {INC}, {LINKS}, {DEFECTS}, {TAX}, mem as (select id, cluster_id as cluster from inc where cluster_id is not null), {DOM.format(members='mem')} select cluster as id, defects from dom")
def dominant_defects(spark, d):
    """The three commonest defects of each hotspot, in order."""
    m = incidents(spark, d).select("id", F.col("cluster_id").alias("cluster"))
    return dominant(incident_defects(spark, d), m, taxonomy(spark)).select(F.col("cluster").alias("id"), F.array_join("defects", ",").alias("defects"))


_MODE = "(select k.cluster, {c} as v, row_number() over (partition by k.cluster order by count(*) desc, {c}) as rn from k join inc using (id) where {c} is not null group by 1, 2)"


@query(f"""with recursive {DB}, {LINKS}, {DEFECTS}, {TAX}, {DOM.format(members='k')}, ce as (select k.cluster as id, avg(q.lat) as lat, avg(q.lon) as lon from k join q using (id) group by 1), {SPOTS},
m as (select ce.id as cluster, sp.id as hotspot_id, round({HAV("ce", "sp")}, 3) as dm from ce join sp on abs(ce.lat - sp.lat) < 0.01 and {HAV("ce", "sp")} <= 300),
one as (select *, row_number() over (partition by cluster order by dm, hotspot_id) as rn from m), two as (select *, row_number() over (partition by hotspot_id order by dm, cluster) as rh from one where rn = 1),
kept as (select ce.id as cluster, two.hotspot_id as kept_id from ce left join two on two.cluster = ce.id and two.rh = 1),
ag as (select k.cluster, count(*) as n, cast(sum(coalesce(fatalities, 0)) as bigint) as fatalities, cast(sum(coalesce(injuries, 0)) as bigint) as injuries, min(crash_date) as first_date, max(crash_date) as last_date from k join inc using (id) group by 1)
select coalesce(kept_id, (select max(id) from hotspot) + row_number() over (partition by kept_id is null order by cluster)) as hotspot_id, kept_id is not null as kept, cluster, n, fatalities, injuries, first_date, last_date, round(ce.lat, 6) as lat, round(ce.lon, 6) as lon, r.v as road_name, s.v as admin_state, di.v as admin_district, ci.v as admin_city, coalesce(dom.defects, '') as defects
from kept join ag using (cluster) join ce on ce.id = cluster left join dom using (cluster) left join {_MODE.format(c='road_name')} r on r.cluster = kept.cluster and r.rn = 1 left join {_MODE.format(c='admin_state')} s on s.cluster = kept.cluster and s.rn = 1
left join {_MODE.format(c='admin_district')} di on di.cluster = kept.cluster and di.rn = 1 left join {_MODE.format(c='admin_city')} ci on ci.cluster = kept.cluster and ci.rn = 1""")
def hotspot_rebuild(spark, d):
    """The whole hotspot table anew: clusters with aggregates, modes and dominant defects; the nearest old hotspot's id is kept,
    others get new ids above the old ones, numbered in order of cluster."""
    c, pts = _clusters(spark, d)
    i = incidents(spark, d).select("id", "fatalities", "injuries", "crash_date", "road_name", "admin_state", "admin_district", "admin_city")
    rows = persist_table(c.join(i, "id").join(pts, "id", "left"), "members")
    ag = rows.groupBy("cluster").agg(F.countDistinct("id").alias("n"), F.min("crash_date").alias("first_date"), F.max("crash_date").alias("last_date"), F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon"), *[F.sum(F.coalesce(x, F.lit(0))).alias(x) for x in ("fatalities", "injuries")])
    match = persist_table(kept_ids(spark, d, c, pts), "matched")
    top = table(spark, d, "hotspot").agg(F.max("id").alias("_top"))  # one row
    new = numbered(match.where("kept_id is null").select("cluster"), ["cluster"]).crossJoin(F.broadcast(top)).select("cluster", (F.col("n") + F.coalesce("_top", F.lit(0))).alias("hotspot_id"), F.lit(False).alias("kept"))
    ids = new.unionByName(match.where("kept_id is not null").select("cluster", F.col("kept_id").alias("hotspot_id"), F.lit(True).alias("kept")))
    dom = dominant(incident_defects(spark, d), rows.select("id", "cluster"), taxonomy(spark)).select("cluster", F.array_join("defects", ",").alias("defects"))
    best = modes(rows, "cluster", ["road_name", "admin_state", "admin_district", "admin_city"])
    return ids.join(ag, "cluster").join(best, "cluster", "left").join(dom, "cluster", "left").fillna("", ["defects"])


@query(f"""with {RAW} select id, f as fatalities, sev as max_severity, round(c1, 4) as casualties, round(c5, 4) as severity, 0.3 as weight, case when score >= 75 then 'critical' when score >= 50 then 'high' when score >= 25 then 'medium' else 'watch' end as tier, '{AS_OF}' as computed_for from sc join r using (id)""")
def score_breakdown(spark, d):
    """The record behind each score as JSON (raw values, components to four places, weights, tier, date); the query reads it back."""
    s = total_score(score_components(_raw(spark, d)))
    raw = F.struct("fatalities", "injuries", "inc_6mo", "days_since_last", "vulnerable_share", "max_severity", "n_sources", "avg_conf")
    record = F.struct(raw.alias("raw"), F.struct(*[F.round(c, 4).alias(c) for c in WEIGHTS]).alias("components"), F.struct(*[F.lit(w).alias(c) for c, w in WEIGHTS.items()]).alias("weights"), tier(F.col("score")).alias("tier"), F.lit(AS_OF).alias("computed_for"))
    j = s.select("id", F.to_json(record).alias("record"))
    get = lambda p, t="double": F.get_json_object("record", "$." + p).cast(t)
    return j.select("id", get("raw.fatalities").alias("fatalities"), get("raw.max_severity").alias("max_severity"), get("components.casualties").alias("casualties"), get("components.severity").alias("severity"), get("weights.casualties").alias("weight"), get("tier", "string").alias("tier"), get("computed_for", "string").alias("computed_for"))


@query(f"""with {INC} select h.id, p.n, p.fatalities from hotspot h join lateral (select count(*) as n, cast(sum(coalesce(fatalities, 0)) as bigint) as fatalities from inc where inc.cluster_id = h.id and verification_status in ('verified', 'reviewed', 'auto_published')) p on p.n > 0""")
def lateral_counts(spark, d):
    """Hotspots with a member of certain states, and what these add up to."""
    i = incidents(spark, d).where("cluster_id is not null and verification_status in ('verified', 'reviewed', 'auto_published')")
    g = i.groupBy(F.col("cluster_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("fatalities", F.lit(0))).alias("fatalities"))
    return table(spark, d, "hotspot").select("id").join(g, "id")


@query(f"""with {PTS} select a.id, min(b.id) filter (where b.lat = a.lat and b.lon = a.lon) as place, count(*) - 1 as n_near from pt a join pt b on abs(a.lat - b.lat) < 0.003 and {HAV("a", "b")} <= 300 group by a.id, a.lat, a.lon""")
def near_incident_counts(spark, d):
    """Per located incident its place and how many others are within 300 m, by classes of places instead of pairs."""
    return near_counts(located(table(spark, d, "incident"), "id", "geom"), 300.0)


@query(f"""with {PTS}, {SPOTS}, t as (select cast(floor(sp.lat / 0.5) as bigint) as ty, cast(floor(sp.lon / 0.5) as bigint) as tx, h.id, coalesce(priority_score, 0) as score from hotspot h join sp using (id))
select ty, tx, count(*) as n, max(score) as worst, case when max(score) >= 75 then 'critical' when max(score) >= 50 then 'high' when max(score) >= 25 then 'medium' else 'watch' end as tier from t group by 1, 2""")
def tile_tiers(spark, d):
    """Map tiles of hotspots with the worst tier in each."""
    p = located(table(spark, d, "hotspot"), "id", "centroid_geom").join(table(spark, d, "hotspot").select("id", F.coalesce("priority_score", F.lit(0.0)).alias("score")), "id")
    g = p.groupBy(F.floor(F.col("lat") / 0.5).alias("ty"), F.floor(F.col("lon") / 0.5).alias("tx")).agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("worst"))
    return g.withColumn("tier", tier(F.col("worst")))


# --- reads ------------------------------------------------------------------------------------------------------------


@query(f"with {INC} select id, crash_date, admin_state, fatalities from inc where id = 17")
def point_lookup(spark, d):
    """One row by its key: the filter reaches the scan; an unknown key gives no row."""
    return table(spark, d, "incident").where("id = 17").dropDuplicates(["id"]).select("id", "crash_date", "admin_state", "fatalities")


@query("select id, url from source_article where processing_status = 'new' order by id desc limit 50")
def newest_first(spark, d):
    return table(spark, d, "source_article").where("processing_status = 'new'").select("id", "url").orderBy(F.desc("id")).limit(50)


@query("select item_id, collected_at from feed_item order by collected_at desc nulls last, item_id desc limit 20")
def latest_items(spark, d):
    """The latest N of a log."""
    return table(spark, d, "feed_item").select("item_id", "collected_at").orderBy(F.desc_nulls_last("collected_at"), F.desc("item_id")).limit(20)


QUEUE = """qu as (select i.id, i.fatalities, i.geocode_confidence, count(l.source_article_id) as n_sources from inc i left join lnk l on l.incident_id = i.id where i.verification_status in ('auto', 'needs_human') group by 1, 2, 3)"""


def _queue(spark, d) -> DataFrame:
    n = links(spark, d).groupBy(F.col("incident_id").alias("id")).agg(F.count("source_article_id").alias("n_sources"))
    i = incidents(spark, d).where("verification_status in ('auto', 'needs_human')").select("id", "fatalities", "geocode_confidence")
    return i.join(n, "id", "left").fillna(0, ["n_sources"])


@query(f"""with {INC}, {LINKS}, {QUEUE} select id, n_sources, geocode_confidence from qu order by coalesce(fatalities > 0, false) desc, n_sources desc, geocode_confidence desc nulls last, id desc limit 100""")
def review_order(spark, d):
    """The first page of a queue in four keys, a truth value and a correlated count among them."""
    fatal = F.coalesce(F.col("fatalities") > 0, F.lit(False))
    return _queue(spark, d).orderBy(F.desc(fatal), F.desc("n_sources"), F.desc_nulls_last("geocode_confidence"), F.desc("id")).limit(100).select("id", "n_sources", "geocode_confidence")


@query(f"""with {INC}, {LINKS}, {QUEUE}, hot as (select id from qu where fatalities > 0 or n_sources > 1), ten as (select id from qu order by geocode_confidence desc nulls last, id desc limit 10)
select id from hot union all select id from ten where not exists (select 1 from hot)""")
def priority_inbox(spark, d):
    """What is urgent, or the first ten if nothing is."""
    q = persist_table(_queue(spark, d), "queue")
    hot = q.where("fatalities > 0 or n_sources > 1").select("id")
    ten = q.orderBy(F.desc_nulls_last("geocode_confidence"), F.desc("id")).limit(10).select("id")
    return hot.unionByName(ten.join(hot.limit(1).select(F.lit(1).alias("_any")), F.lit(True), "left_anti"))


@query("select id, incident_count from hotspot where escalation_candidate or incident_count >= 2 order by escalation_candidate desc, incident_count desc, id limit 50")
def escalations_first(spark, d):
    h = table(spark, d, "hotspot").where("escalation_candidate or incident_count >= 2")
    return h.orderBy(F.desc("escalation_candidate"), F.desc("incident_count"), "id").limit(50).select("id", "incident_count")


@query(f"""with {INC}, {LINKS} select i.id, coalesce(string_agg(distinct strftime(a.fetched_at at time zone 'UTC', '%Y-%m-%d'), ' ' order by strftime(a.fetched_at at time zone 'UTC', '%Y-%m-%d') desc), '') as days from inc i left join lnk l on l.incident_id = i.id left join source_article a on a.id = l.source_article_id group by 1""")
def incident_timeline(spark, d):
    """Days on which an incident was reported, latest first; '' where there is none."""
    a = table(spark, d, "source_article").select(F.col("id").alias("source_article_id"), F.date_format("fetched_at", "yyyy-MM-dd").alias("day"))
    g = links(spark, d).join(a, "source_article_id").groupBy(F.col("incident_id").alias("id")).agg(F.array_join(F.sort_array(F.collect_set("day"), False), " ").alias("days"))
    return incidents(spark, d).select("id").join(g, "id", "left").fillna("", ["days"])


@query(f"""with {INC} select distinct 'district' as facet, admin_district as value from hotspot where admin_state = 'Sindhara Pradesh' and admin_district is not null union select 'defect', unnest(dominant_defects) from hotspot union select 'road_type', road_type from inc where road_type is not null union select 'state', admin_state from hotspot where admin_state is not null""")
def facet_lists(spark, d):
    """Options of the filters: states, districts of the state that is set, defects and road types."""
    h = table(spark, d, "hotspot")
    one = lambda df, name, c: df.select(F.lit(name).alias("facet"), c.alias("value")).where("value is not null")
    parts = [one(h.where("admin_state = 'Sindhara Pradesh'"), "district", F.col("admin_district")), one(h, "defect", F.explode("dominant_defects")), one(incidents(spark, d), "road_type", F.col("road_type")), one(h, "state", F.col("admin_state"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).distinct()


@query("""select id from hotspot where admin_state = 'Sindhara Pradesh' and coalesce(priority_score, 0) < 50 and coalesce(priority_score, 0) >= 25 and starts_with(road_name, 'SH')""")
def page_filters(spark, d):
    """Filters of the page: state, tier and class of road, folded from those that are set."""
    score = F.coalesce("priority_score", F.lit(0.0))
    wanted = {"state": "Sindhara Pradesh", "tier": "medium", "road": "SH", "district": None}
    tests = {"state": lambda v: F.col("admin_state") == v, "district": lambda v: F.col("admin_district") == v, "tier": lambda v: tier(score) == v, "road": lambda v: F.startswith("road_name", F.lit(v))}
    cond = F.lit(True)
    for k, v in wanted.items():
        if v is not None:
            cond = cond & tests[k](v)
    return table(spark, d, "hotspot").where(cond).select("id")


@query(f"""with {INC}, a as (select *, row_number() over (partition by batch_no order by id) as rn, count(*) over (partition by batch_no) as n from source_article) select batch_no, id, case when rn <= 10 then 'head' else 'tail' end as part from a where rn <= 10 or rn > n - 10 and n > 20 order by id""")
def head_and_tail(spark, d):
    """First and last ten rows of each batch, by top-k on either side."""
    a = table(spark, d, "source_article").select("batch_no", "id")
    n = a.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n"))
    rank = lambda o: F.row_number().over(Window.partitionBy("batch_no").orderBy(o))  # noqa: E731  the rank filter limits each group before the shuffle
    head = a.withColumn("rn", rank("id")).where("rn <= 10").select("batch_no", "id", F.lit("head").alias("part"))
    tail = a.withColumn("rn", rank(F.desc("id"))).where("rn <= 10").join(n.where("n > 20"), "batch_no").select("batch_no", "id", F.lit("tail").alias("part"))
    return head.unionByName(tail)


# --- names, duplicates, lookups ------------------------------------------------------------------------------------------


@query("""with s as (select id as site_id, lower(v) as v, lower(admin_district) as district from (select id, unnest([road_name, replace(road_name, '-', ' ')]) as v, admin_district from hotspot) where v <> ''),
a as (select id, lower(clean_text) as t, lower(trim(district)) as district from source_article where clean_text <> '')
select distinct s.site_id, a.id as article_id from s join a on contains(a.t, s.v) where contains(a.t, s.district) or a.district = s.district or s.district is null""")
def site_names(spark, d):
    """Articles that name a hotspot's road, in one of two spellings, where the hotspot is."""
    h = table(spark, d, "hotspot").select(F.col("id").alias("site_id"), F.array_compact(F.array("road_name", F.replace("road_name", F.lit("-"), F.lit(" ")))).alias("variants"), F.lit(None).cast("string").alias("city"), F.col("admin_district").alias("district"))
    return site_mentions(table(spark, d, "source_article").select("id", F.col("clean_text").alias("text"), "district"), h)


KEYWORDS = [("en", "crash", "road accident"), ("en", "crash", "overturns"), ("en", "infra_defect", "pothole"), ("en", "injury", "hospital"), ("hi", "crash", "दुर्घटना"), ("hi", "infra_defect", "गड्ढे"), ("mr", "crash", "अपघात"), ("bn", "crash", "দুর্ঘটনা"), ("ta", "crash", "விபத்து"), ("te", "crash_type", "బోల్తా"), ("gu", "crash", "અકસ્માત"), ("ur", "crash", "حادثہ")]


@query("with kw(language, category, term) as (values " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in KEYWORDS) + """), w as (select lower(term) as t from kw where category in ('crash', 'infra_defect', 'crash_type') union select left(lower(term), length(term) - 1) from kw where category in ('crash', 'infra_defect', 'crash_type') and length(term) >= 4)
select a.id, coalesce((select bool_or(contains(lower(a.clean_text), w.t)) from w), false) as passes from source_article a""")
def prefilter_by_keywords(spark, d):
    """Vocabulary screen driven by a keyword table: its terms of three categories and their stems."""
    k = spark.createDataFrame(KEYWORDS, "language string, category string, term string")
    return passes_keywords(table(spark, d, "source_article").select("id", F.col("clean_text").alias("text")), k, ["crash", "infra_defect", "crash_type"])


@query("""with nd as (select * from source_article where processing_status = 'irrelevant' and dedup_hash <> '' and district <> ''), kp as (select * from source_article where processing_status <> 'irrelevant' and dedup_hash <> '' and district <> '' and fetched_at > timestamptz '2026-03-01 00:00:00+00')
select nd.id, nd.district from nd where not exists (select 1 from kp where kp.district = nd.district and kp.id <> nd.id and bit_count(xor(('0x' || substr(nd.dedup_hash, 1, 8))::bigint, ('0x' || substr(kp.dedup_hash, 1, 8))::bigint)) + bit_count(xor(('0x' || substr(nd.dedup_hash, 9, 8))::bigint, ('0x' || substr(kp.dedup_hash, 9, 8))::bigint)) <= 3)""")
def false_duplicates(spark, d):
    """Rows of one status that no recent row of another is near to in their district: an anti join on the distance of hashes."""
    a = table(spark, d, "source_article").where("dedup_hash <> '' and district <> ''").select("id", "district", "dedup_hash", "processing_status", "fetched_at")
    out = a.where("processing_status = 'irrelevant'")
    kept = a.where("processing_status <> 'irrelevant'").where(F.col("fetched_at") > F.to_timestamp(F.lit("2026-03-01 00:00:00")))
    return hash_window.without_near(out, kept).select("id", "district")


@query("""with c as (select google_url, min(url) as url from feed_item where resolved and starts_with(url, 'http') and not contains(url, '/rss/articles/') group by 1) select f.item_id, coalesce(c.url, f.url) as url, c.url is not null as hit from feed_item f left join c using (google_url)""")
def cached_lookups(spark, d):
    """Links resolved from a cache of earlier results; entries of the wrong shape and failures are not in it."""
    f = table(spark, d, "feed_item")
    cache = fresh_entries(f.where("resolved").select(F.col("google_url").alias("key"), "url"), ["url"], F.startswith("url", F.lit("http")) & ~F.contains(F.col("url"), F.lit("/rss/articles/")))
    return cached(f.select("item_id", F.col("google_url").alias("key"), F.col("url").alias("asked")), cache).select("item_id", F.coalesce("url", "asked").alias("url"), F.col("hit"))


@query(f"""with {INC}, m as (select i.id, i.admin_district as a, h.admin_district as b from inc i join hotspot h on h.id = i.cluster_id), k(o, n) as (values {", ".join(f"('{o}', '{g[0]}')" for g in DISTRICT_NAMES for o in g)}),
c as (select id, nullif(regexp_replace(lower(trim(a)), '( district| dist\\.?)$', ''), '') as a, nullif(regexp_replace(lower(trim(b)), '( district| dist\\.?)$', ''), '') as b from m)
select c.id, coalesce(coalesce(x.n, a) = coalesce(y.n, b), true) as same from c left join k x on x.o = a left join k y on y.o = b""")
def district_guard(spark, d):
    """Whether an incident's district agrees with its hotspot's, renamed districts and suffixes aside; unknown agrees."""
    h = table(spark, d, "hotspot").select(F.col("id").alias("cluster_id"), F.col("admin_district").alias("hd"))
    return incidents(spark, d).join(h, "cluster_id").select("id", same_district(F.col("hd"), F.col("admin_district")).alias("same"))


@query("""select item_id, case when source_domain is null then 'aggregator' when dom in ('runvadi-awaaz.example', 'belpura-prabhat.example') then 'national' else coalesce(o.tier, 'regional') end as tier
from (select *, regexp_replace(lower(trim(source_domain)), '^www\\.', '') as dom from feed_item) f left join outlet o on regexp_replace(lower(trim(o.website)), '^www\\.', '') = f.dom""")
def outlet_tiers_by_set(spark, d):
    """Tiers of outlets, a set of national domains coming before the outlets' own."""
    return outlet_tier(table(spark, d, "feed_item"), table(spark, d, "outlet"), ["runvadi-awaaz.example", "belpura-prabhat.example"])


# --- changes, audit, exports ------------------------------------------------------------------------------------------


@query(f"""with {INC}, {PTS}, {SPOTS}, m as (select i.id, sqrt(pow(sp.lat - pt.lat, 2) + pow(sp.lon - pt.lon, 2)) * 111.0 as km, abs(coalesce(i.geocode_confidence, 0) - coalesce(i.extraction_confidence, 0)) as dc from inc i join pt using (id) join sp on sp.id = i.cluster_id)
select id, case when km < 0.05 and dc < 0.001 then 'unchanged' when km < 0.1 then 'below_min_move' when km > 25 then 'moved_far' else 'corrected' end as change from m""")
def pin_changes(spark, d):
    """What a new pin changes: distance by degrees and change of confidence against their thresholds."""
    p = located(table(spark, d, "incident"), "id", "geom")
    h = located(table(spark, d, "hotspot"), "id", "centroid_geom").select(F.col("id").alias("cluster_id"), F.col("lat").alias("la"), F.col("lon").alias("lo"))
    j = incidents(spark, d).select("id", "cluster_id", "geocode_confidence", "extraction_confidence").join(p, "id").join(h, "cluster_id")
    km = F.sqrt(F.pow(F.col("la") - F.col("lat"), 2) + F.pow(F.col("lo") - F.col("lon"), 2)) * 111.0
    dc = F.abs(F.coalesce("geocode_confidence", F.lit(0.0)) - F.coalesce("extraction_confidence", F.lit(0.0)))
    return j.select("id", F.when((km < 0.05) & (dc < 0.001), "unchanged").when(km < 0.1, "below_min_move").when(km > 25, "moved_far").otherwise("corrected").alias("change"))


# Patterns of refusals in error texts, the first that matches decides.
AUTH_FAIL = r"failed to authenticate|401|403|invalid (?:api key|x-api-key)|oauth.{0,40}(?:invalid|expired|revoked)|authentication_error"
RATE_LIMIT = r"rate.?limit|usage limit|quota|too many requests|429|limit reached|try again (?:later|in)"


@query(f"""select id, case when regexp_matches(clean_text, '{AUTH_FAIL}', 'i') then 'credential' when regexp_matches(clean_text, '{RATE_LIMIT}', 'i') then 'rate_limited' when regexp_matches(clean_text, 'traceback|exception|error', 'i') then 'failed' else 'none' end as kind from source_article where clean_text is not null""")
def error_kinds(spark, d):
    """Kinds of error texts by patterns in order of precedence."""
    t = F.col("clean_text")
    kind = F.when(t.rlike("(?i)" + AUTH_FAIL), "credential").when(t.rlike("(?i)" + RATE_LIMIT), "rate_limited").when(t.rlike("(?i)traceback|exception|error"), "failed").otherwise("none")
    return table(spark, d, "source_article").where("clean_text is not null").select("id", kind.alias("kind"))


@query(f"""with {INC} select id as entity_id, 'auto' as before, 'machine_ok' as after, 'rule' as reviewer from inc where verification_status = 'auto' and geocode_confidence >= 0.8""")
def audit_rows(spark, d):
    """The rows that a guarded update appends to the audit: before and after as JSON; the query reads the status back."""
    i = incidents(spark, d).where("verification_status = 'auto' and geocode_confidence >= 0.8").select("id", "verification_status")
    a = i.select(F.lit("incident").alias("entity_type"), F.col("id").alias("entity_id"), F.lit("rule").alias("reviewer"), F.lit("edit").alias("action"), F.to_json(F.struct("verification_status")).alias("before_json"), F.to_json(F.struct(F.lit("machine_ok").alias("verification_status"))).alias("after_json"))
    at = scratch_path(spark, "audit")
    a.write.mode("append").parquet(at)
    get = lambda c: F.get_json_object(c, "$.verification_status")
    return spark.read.schema(a.schema).parquet(at).select("entity_id", get("before_json").alias("before"), get("after_json").alias("after"), "reviewer")


@query(f"""with {INC}, {LINKS}, {DEFECTS}, p as (select distinct incident_id as id from claims)
select 'incident' as frame, count(*) as n, cast(sum(id) as bigint) as ids from p union all select 'defect', count(*), cast(sum(incident_id) as bigint) from claims union all select 'source', count(*), cast(sum(source_id) as bigint) from (select distinct incident_id, source_id from claims)""")
def payload_frames(spark, d):
    """A nested payload (incident with its defects) exploded into three frames: incidents, defects and source links."""
    c = claims(links(spark, d), table(spark, d, "source_article"))
    payload = nested(c.select(F.col("incident_id").alias("id")).distinct(), "id", defects=c.withColumnRenamed("incident_id", "id"))
    p = persist_table(payload.select("id", F.to_json("defects").alias("body")).select("id", F.from_json("body", "array<struct<defect_type:string,confidence:double,source_id:bigint>>").alias("defects")), "payload")
    frames = {"incident": p.select("id"), "defect": p.select("id", F.explode("defects").alias("x")), "source": p.select(F.col("id").alias("parent"), F.explode(F.array_distinct(F.transform("defects", lambda x: x["source_id"]))).alias("id"))}
    count = lambda k: frames[k].agg(F.lit(k).alias("frame"), F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))
    return count("incident").unionByName(count("defect")).unionByName(count("source"))


@query(f"""with {INC}, {LINKS}, {DEFECTS}, s as (select incident_id as id, count(*) as n_sources, max(source_article_id) as last_source from lnk group by 1), f as (select incident_id as id, count(*) as n_defects, string_agg(defect_type, ',' order by defect_type) as defects from dfx group by 1)
select inc.id, coalesce(n_sources, 0) as n_sources, coalesce(last_source, -1) as last_source, coalesce(n_defects, 0) as n_defects, coalesce(defects, '') as defects from inc left join s using (id) left join f using (id)""")
def incident_dossiers(spark, d):
    """Incidents with their sources and defects as sorted arrays of structs, two grouped joins."""
    n = nested(incidents(spark, d).select("id"), "id", sources=links(spark, d).select(F.col("incident_id").alias("id"), "source_article_id", "match_confidence"), defects=incident_defects(spark, d).withColumnRenamed("incident_id", "id"))
    return n.select("id", F.size("sources").alias("n_sources"), F.coalesce(F.array_max(F.transform("sources", lambda s: s["source_article_id"])), F.lit(-1)).alias("last_source"), F.size("defects").alias("n_defects"), F.array_join(F.transform("defects", lambda s: s["defect_type"]), ",").alias("defects"))


@query("""select count(*) as hotspots, cast(sum(incident_count) as bigint) as incidents, string_agg(distinct admin_state, ',' order by admin_state) as states, count(*) filter (where escalation_candidate) as escalation, count(*) filter (where not escalation_candidate and incident_count >= 2) as repeat, count(*) filter (where not escalation_candidate and incident_count < 2) as single from hotspot""")
def export_meta(spark, d):
    """Totals, the distinct states and the number of hotspots of each class of evidence, in one pass."""
    e, n = F.col("escalation_candidate"), F.col("incident_count")
    return table(spark, d, "hotspot").agg(F.count(F.lit(1)).alias("hotspots"), F.sum("incident_count").alias("incidents"), F.array_join(F.sort_array(F.collect_set("admin_state")), ",").alias("states"), F.count_if(e).alias("escalation"), F.count_if(~e & (n >= 2)).alias("repeat"), F.count_if(~e & (n < 2)).alias("single"))


@query("select name, language, region_state, tier, website, tz, date_order from outlet")
def jsonl_rewrite(spark, d):
    """A table written as JSON lines, appended to, and read back."""
    o, at = table(spark, d, "outlet").select("name", "language", "region_state", "tier", "website", "tz", "date_order"), scratch_path(spark, "lines")
    write_jsonl(o.where("tier = 'national'"), at)
    write_jsonl(o.where("tier is null or tier <> 'national'"), at, append=True)
    return read_jsonl(spark, at, "name string, language string, region_state string, tier string, website string, tz string, date_order string")


@query("""select cast(ts as date) as day, cast(sum(value) as decimal(12, 2)) as spent from events where event_type <> 'error' group by 1""")
def json_sum_per_day(spark, d):
    """A field of JSON records added up by day, as decimals."""
    e = table(spark, d, "events").where("event_type <> 'error'").select("ts", F.to_json(F.struct(F.col("value").alias("spend"))).alias("stats"))
    return e.groupBy(F.to_date("ts").alias("day")).agg(F.sum(F.get_json_object("stats", "$.spend").cast("decimal(12,2)")).cast("decimal(12,2)").alias("spent"))


@query("""select cast(ts as date) as day, event_id, round(running, 2) as running, running < 400 as within from (select *, sum(value) over (partition by cast(ts as date) order by ts, event_id rows unbounded preceding) as running from events)""")
def spend_cut(spark, d):
    """Running total of spending by day and where the day's budget ends it."""
    w = Window.partitionBy("day").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    e = table(spark, d, "events").select(F.to_date("ts").alias("day"), "ts", "event_id", "value").withColumn("r", F.sum("value").over(w))
    return e.select("day", "event_id", F.round("r", 2).alias("running"), (F.col("r") < 400).alias("within"))


@query("""select coalesce(batch_no::varchar, 'all') as stage, count(*) as seen, count(*) filter (where processing_status = 'new') as new, count(*) filter (where processing_status = 'failed') as failed from source_article group by rollup (batch_no)""")
def stage_stats(spark, d):
    """Counters of every stage and their sum over all stages."""
    s = F.col("processing_status")
    return table(spark, d, "source_article").rollup("batch_no").agg(F.count(F.lit(1)).alias("seen"), F.count_if(s == "new").alias("new"), F.count_if(s == "failed").alias("failed")).select(F.coalesce(F.col("batch_no").cast("string"), F.lit("all")).alias("stage"), "seen", "new", "failed")


@query("""select 'queue_depth' as name, count(*) filter (where processing_status = 'new') < 1000000 as ok, 'new ' || count(*) filter (where processing_status = 'new') as detail from source_article union all select 'publishing_alive', (select count(*) from hotspot where status is not null) > 0, 'hotspots ' || (select count(*) from hotspot where status is not null)""")
def named_checks(spark, d):
    """Health checks as (name, ok, detail)."""
    a = table(spark, d, "source_article").agg(F.count_if(F.col("processing_status") == "new").alias("n")).select(F.lit("queue_depth").alias("name"), (F.col("n") < 1000000).alias("ok"), F.concat(F.lit("new "), "n").alias("detail"))
    h = table(spark, d, "hotspot").agg(F.count("status").alias("n")).select(F.lit("publishing_alive").alias("name"), (F.col("n") > 0).alias("ok"), F.concat(F.lit("hotspots "), "n").alias("detail"))
    return a.unionByName(h)


@query("""select id, json_extract_string(j, '$[0].k') as first, json_extract_string(j, '$[1].k') as second from (select item_id as id, regexp_extract('ok: [{"k":"' || item_id || '"},{"k":"x"}] bye', '(?s)\\[.*\\]') as j from gdelt_item)""")
def loose_json_arrays(spark, d):
    """JSON arrays inside other text."""
    text = F.concat(F.lit('ok: [{"k":"'), "item_id", F.lit('"},{"k":"x"}] bye'))
    j = F.from_json(F.regexp_extract(text, r"(?s)\[.*\]", 0), "array<struct<k:string>>")
    return table(spark, d, "gdelt_item").select(F.col("item_id").alias("id"), F.get(j, F.lit(0))["k"].alias("first"), F.get(j, F.lit(1))["k"].alias("second"))


@query("""with problems as (select name, case when tier not in ('national', 'regional', 'district', 'aggregator') or tier is null then 'tier' end as a, case when date_order not in ('DMY', 'MDY') then 'date_order' end as b, case when not (string_split(replace(language, ' ', ''), ',') <@ ['en', 'hi', 'mr', 'bn', 'ta', 'te', 'gu', 'ur']) then 'language' end as c from outlet)
select name, array_to_string(list_filter([a, b, c], lambda x: x is not null), ',') as problems from problems where a is not null or b is not null or c is not null union all select 'weights', 'sum' where abs(0.30 + 0.25 + 0.15 + 0.15 + 0.10 + 0.05 - 1) > 1e-9""")
def config_problems(spark, d):
    """Configuration rows with unknown tiers, date orders or languages, and weights that do not add up to one."""
    langs = F.array(*[F.lit(x) for x in ("en", "hi", "mr", "bn", "ta", "te", "gu", "ur")])
    o = table(spark, d, "outlet")
    bad = F.array_compact(F.array(F.when(F.col("tier").isNull() | ~F.col("tier").isin("national", "regional", "district", "aggregator"), "tier"), F.when(~F.col("date_order").isin("DMY", "MDY"), "date_order"), F.when(F.size(F.array_except(F.split(F.replace("language", F.lit(" ")), ","), langs)) > 0, "language")))
    rows = o.select("name", F.array_join(bad, ",").alias("problems")).where("problems <> ''")
    weights = spark.createDataFrame([(sum(WEIGHTS.values()),)], "s double").where("abs(s - 1) > 1e-9").select(F.lit("weights").alias("name"), F.lit("sum").alias("problems"))
    return rows.unionByName(weights)


@query(f"""with {INC} select i.id from inc i join pub p on p.id = i.primary_source_id where i.crash_date is null or date_diff('day', i.crash_date, p.day) > 30""".replace("with inc", "with pub as (select id, cast(to_timestamp(utc_us / 1000000) at time zone 'UTC' as date) as day from (select id, epoch_us(try_strptime(published_at, '%Y-%m-%dT%H:%M:%SZ')) as utc_us from source_article) where utc_us is not null), inc"))
def suspicious_publication(spark, d):
    """Incidents without a date or dated over thirty days before their article came out (articles whose time is written in UTC)."""
    a = table(spark, d, "source_article").where(F.col("published_at").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")).select("id", "outlet_name", "published_at")
    a = with_article_instant(a, table(spark, d, "outlet")).where("utc_us is not null").select(F.col("id").alias("primary_source_id"), F.to_date(F.timestamp_micros("utc_us")).alias("seen"))
    return incidents(spark, d).join(a, "primary_source_id").where("crash_date is null or datediff(seen, crash_date) > 30").select("id")


# --- feeds and streams --------------------------------------------------------------------------------------------------


@query("select cast(item_id as varchar) as file, url, title, published_at, source_name, regexp_replace(source_domain, '^www\\.', '') as source_domain from feed_item")
def rss_sources(spark, d):
    """Feed entries read out of RSS documents (made here from the feed table, one document an entry)."""
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    tag = lambda t, c: F.when(F.col(c).isNull(), "").otherwise(F.concat(F.lit(f"<{t}>"), esc(c), F.lit(f"</{t}>")))
    site = F.when(F.col("source_domain").isNull(), "").otherwise(F.concat(F.lit(' url="https://'), esc("source_domain"), F.lit('/"')))
    src = F.when(F.col("source_name").isNull() & F.col("source_domain").isNull(), "").otherwise(F.concat(F.lit("<source"), site, F.lit(">"), esc("source_name"), F.lit("</source>")))
    doc = F.concat(F.lit("<rss><channel><item>"), tag("link", "url"), tag("title", "title"), tag("pubDate", "published_at"), src, F.lit("</item></channel></rss>"))
    files = table(spark, d, "feed_item").select(F.col("item_id").cast("string").alias("file"), F.encode(doc, "UTF-8").alias("content"))
    r = rss_items(files)
    return r.where("problem is null").select("file", *FIELDS)


@query("select cast(item_id as varchar) as file, url, title, published_at, source_domain from gdelt_item")
def article_lists(spark, d):
    """Articles read out of JSON lists (made here from the table, one list an entry)."""
    g = table(spark, d, "gdelt_item")
    doc = F.to_json(F.struct(F.array(F.struct("url", "title", F.col("published_at").alias("seendate"), F.col("source_domain").alias("domain"))).alias("articles")))
    r = listed_articles(g.select(F.col("item_id").cast("string").alias("file"), F.encode(doc, "UTF-8").alias("content")))
    return r.where("problem is null").select("file", "url", "title", "published_at", "source_domain")


@query("""select date_trunc('hour', ts) - to_hours(k) as start, user_id as place, count(*) as n from events, (select unnest([0, 1, 2]) as k) group by 1, 2""")
def stream_sliding_counts(spark, d):
    """Sliding windows of three hours, an hour apart, per place of a stream, run to its end."""
    return run_to_table(sliding_counts(event_stream(spark, d, "events"), "user_id", "3 hours", "1 hour"))


@query("""select user_id, max_by(event_id, ts) as event_id, max(ts) as ts from events group by 1""")
def stream_upserts(spark, d):
    """Late and early rows of a stream upserted by key, the latest time staying."""
    s = event_stream(spark, d, "events").select("user_id", "ts", "event_id")
    return upsert_stream(s, ["user_id"]).select("user_id", "event_id", "ts")


@query("""with last as (select user_id, max(ts) + interval 5 minute as due from events group by 1), mark as (select max(ts) as m from events) select user_id, due from last, mark where due <= m""")
def stream_expiry(spark, d):
    """Keys that have been silent for five minutes by the stream's own time, by a timer per key."""
    return run_to_table(expired_keys(event_stream(spark, d, "events"), "user_id", "ts", 5 * 60 * 1000), "append").select("user_id", "due")
