"""Queries over intake, text, lookups and exports, each with the same query in DuckDB's SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import coerce_double, hamming, simhash
from ..operators.evidence import mentions, stems, valid_claims
from ..operators.geocoding import COORDS, better, ladder
from ..operators.merging import greedy_merges, merge_rounds, remap
from ..operators.proximity import located
from ..runtime import persist_table, table
from ..sources.files import geojson_features, nested
from ..sources.html import linked_data_body, page_text
from ..streaming.intake import event_stream, run_to_table, sessions, windowed_counts
from .geo_sql import PTS, SPOTS
from .registry import INC, LINKS, incidents, links, same_crash_pairs
from .registry import SQL as SQL_OF

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


SCREEN = ["accident", "crash", "overturned", "pothole", "दुर्घटना", "टक्कर", "हादसा", "अपघात", "দুর্ঘটনা", "সংঘর্ষ", "விபத்து", "ప్రమాదం", "અકસ્માત", "حادثہ", "تصادم"]


@query(f"""select id, coalesce(({" or ".join(f"contains(lower(clean_text), '{t}')" for t in stems(SCREEN))}), false) as passes from source_article""")
def prefilter_pass(spark, d):
    """Vocabulary screen with stems, over the whole text of every article."""
    return table(spark, d, "source_article").select("id", mentions(F.col("clean_text"), SCREEN).alias("passes"))


CLAIMS = "c as (select a.id as doc_id, k.code, k.confidence, case k.pos when 1 then '  ' || upper(substr(clean_text, 5, 30)) when 2 then substr(clean_text, 40, 25) when 3 then 'zz not there zz' else '' end as snippet from source_article a, (values (1, 'potholes', 0.6), (2, 'potholes', 0.8), (3, 'signage', 0.9), (2, 'no_infrastructure_defect_identified', 0.7), (4, 'signage', 0.5)) k(pos, code, confidence) where clean_text is not null)"
_SQ = lambda x: f"lower(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"


@query(f"""with {CLAIMS}, v as (select c.* from c join source_article a on a.id = c.doc_id where trim(snippet) <> '' and contains({_SQ("a.clean_text")}, {_SQ("c.snippet")})),
b as (select *, row_number() over (partition by doc_id, code order by confidence desc, snippet) as rn from v)
select doc_id, code, cast(confidence as double) as confidence from b where rn = 1 and (code <> 'no_infrastructure_defect_identified' or not exists (select 1 from b x where x.doc_id = b.doc_id and x.code <> 'no_infrastructure_defect_identified'))""")
def evidence_validation(spark, d):
    """Claims (made here from the texts themselves) kept only with a verbatim quote."""
    a = table(spark, d, "source_article").where("clean_text is not null").select("id", F.col("clean_text").alias("text"))
    kinds = [(1, "potholes", 0.6), (2, "potholes", 0.8), (3, "signage", 0.9), (2, "no_infrastructure_defect_identified", 0.7), (4, "signage", 0.5)]
    snippet = F.when(F.col("pos") == 1, F.concat(F.lit("  "), F.upper(F.substring("text", 5, 30)))).when(F.col("pos") == 2, F.substring("text", 40, 25)).when(F.col("pos") == 3, "zz not there zz").otherwise("")
    rows = [F.named_struct(F.lit("pos"), F.lit(p), F.lit("code"), F.lit(c), F.lit("confidence"), F.lit(x)) for p, c, x in kinds]
    claims = a.select("*", F.explode(F.array(*rows)).alias("k")).select("id", "text", "k.*").select(F.col("id").alias("doc_id"), "code", "confidence", snippet.alias("snippet"))
    return valid_claims(claims, a).select("doc_id", "code", "confidence")


@query("""select id, length(body) as n_chars, md5(body) as digest from (select id, json_extract_string(try_cast(regexp_extract(raw_html, '<script type="application/ld\\+json">((?s:.*?))</script>', 1) as json), '$."@graph"[0].articleBody') as body from source_article where raw_html like '%ld+json%') where body is not null""")
def jsonld_body(spark, d):
    b = linked_data_body(F.col("raw_html"))
    a = table(spark, d, "source_article").where("raw_html like '%ld+json%'").select("id", b.alias("body")).where("body is not null")
    return a.select("id", F.length("body").alias("n_chars"), F.md5(F.col("body").cast("binary")).alias("digest"))


_TAGS = "|".join(rf"<{t}\b.*?</{t}\s*>" for t in ("script", "style", "noscript", "head"))


@query(rf"""with p as (select id, raw_html as h, json_extract_string(try_cast(regexp_extract(raw_html, '<script type="application/ld\+json">((?s:.*?))</script>', 1) as json), '$.articleBody') as b0, json_extract_string(try_cast(regexp_extract(raw_html, '<script type="application/ld\+json">((?s:.*?))</script>', 1) as json), '$."@graph"[0].articleBody') as b1 from source_article where raw_html <> ''),
t as (select id, coalesce(b0, b1) as body, regexp_replace(regexp_replace(regexp_replace(h, '(?is){_TAGS}|<!--.*?-->', '', 'g'), '(?i)<br\s*/?>|</(?:p|div|h[0-9]|li|tr|td|section|nav|aside|footer|span)>', chr(10), 'g'), '(?s)<[^>]*>', '', 'g') as x from p),
e as (select id, body, regexp_replace(replace(replace(replace(replace(replace(replace(x, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '[ \t\x{{00a0}}]+', ' ', 'g') as x from t),
c as (select id, body, regexp_replace(regexp_replace(x, '\s*\n\s*', chr(10), 'g'), '^\s+|\s+$', '', 'g') as x from e) select id, case when coalesce(length(body), 0) > length(x) then body else x end as text from c""")
def html_text(spark, d):
    """Visible text or article body of each stored page, the longer one."""
    return table(spark, d, "source_article").where("raw_html <> ''").select("id", page_text(F.col("raw_html")).alias("text"))


@query()
def simhash_hex(spark, d):
    """64-bit SimHash of each text and its distance to the given hash (made upstream from other text: only a report)."""
    a = table(spark, d, "source_article").where("clean_text is not null").select("id", simhash(F.col("clean_text")).alias("simhash"), "dedup_hash")
    return a.select("id", "simhash", hamming(F.col("simhash"), F.col("dedup_hash")).alias("bits_apart"))


@query("""select item_id, coalesce(cast(floor(v) as bigint), -1) as n, v is not null as numeric from (select item_id, try_cast(case when lower(trim(published_at)) in ('', 'null', 'none', 'n/a', 'na', 'nil') then null else trim(published_at) end as double) as v from feed_item)""")
def coerced_values(spark, d):
    """Numbers in text columns: words for nothing are null, the rest the default."""
    v = coerce_double(F.col("published_at"))
    return table(spark, d, "feed_item").select("item_id", F.coalesce(F.floor(v), F.lit(-1)).alias("n"), v.isNotNull().alias("numeric"))


def _gazetteer(spark, d):
    """Places by query: roads and districts of hotspots, towns of located incidents (the smallest id of each query counts)."""
    h = table(spark, d, "hotspot").join(located(table(spark, d, "hotspot"), "id", "centroid_geom").withColumnsRenamed({"lat": "la", "lon": "lo"}), "id").where("admin_district is not null and admin_state is not null")
    i = incidents(spark, d).select("id", "admin_city", "admin_district", "admin_state").join(located(table(spark, d, "incident"), "id", "geom").withColumnsRenamed({"lat": "la", "lon": "lo"}), "id")

    def pick(rows, q, span):
        g = rows.where(q.isNotNull()).groupBy(F.lower(q).alias("query")).agg(F.min(F.struct("id", "la", "lo", "admin_state", "admin_district")).alias("s"))
        return g.select("query", F.col("s.la").alias("lat"), F.col("s.lo").alias("lon"), F.col("s.admin_state").alias("state"), F.col("s.admin_district").alias("district"), F.lit(span).alias("span_km"))

    tail = F.concat(F.lit(", "), "admin_district", F.lit(", "), "admin_state")
    return pick(h, F.concat("road_name", tail), 0.5).unionByName(pick(h, F.concat("admin_district", F.lit(" district, "), "admin_state"), 20.0)).unionByName(pick(i, F.concat("admin_city", tail), 2.0))


GAZ = f"""{PTS}, {SPOTS}, pl as (select h.id, lower(road_name || ', ' || admin_district || ', ' || admin_state) as q, 0.5 as span, sp.lat as lat, sp.lon as lon, admin_state as st, admin_district as di, 1 as src from hotspot h join sp using (id) where admin_district is not null and admin_state is not null
union all select h.id, lower(admin_district || ' district, ' || admin_state), 20.0, sp.lat, sp.lon, admin_state, admin_district, 2 from hotspot h join sp using (id) where admin_district is not null and admin_state is not null
union all select i.id, lower(admin_city || ', ' || admin_district || ', ' || admin_state), 2.0, pt.lat, pt.lon, admin_state, admin_district, 3 from inc i join pt using (id)),
gz as (select q, span, lat, lon, st, di from (select *, row_number() over (partition by q, src order by id, lat, lon) as rn from pl where q is not null) where rn = 1)"""
_PAIR = r"(\d{1,2}\.\d{3,})[,\s]+(\d{2,3}\.\d{3,})"
LADDER = f"""{GAZ}, w as (select id, road_name as road, admin_city as city, admin_district as dis, admin_state as sta, nullif(concat_ws(', ', admin_district, admin_state), '') as tail, geocode_confidence, verification_status,
  case when regexp_matches(geom, '^\\s*{_PAIR}\\s*$') then trim(geom) when road_type in ('NH', 'SH', 'MDR') and admin_city is not null then 'near ' || admin_city || ', ' || coalesce(road_name, 'main road') || ', ' || coalesce(admin_district, 'town') end as loc, geom from inc),
xy as (select *, try_cast(regexp_extract(loc, '{_PAIR}', 1) as double) as la, try_cast(regexp_extract(loc, '{_PAIR}', 2) as double) as lo from w),
direct as (select id, 'coords_in_text' as method, 0.95 as confidence, la as lat, lo as lon from xy where la between 6.0 and 37.6 and lo between 68.0 and 97.5),
parts as (select *, case when loc like 'near %' then string_split(loc, ', ') end as p from xy where id not in (select id from direct)),
rung(id, n, q, method, c) as (select id, 0, loc, 'landmark_district', 0.8 from parts where loc is not null union all select id, 1, city || ', ' || tail, 'landmark_district', 0.8 from parts where loc like 'near %' and tail is not null and lower(city) is distinct from lower(dis)
 union all select id, 3, p[2] || ', ' || p[3], 'road_city', 0.7 from parts where p is not null union all select id, 5, road || ', ' || tail, 'road_city', 0.7 from parts union all select id, 6, city || ', ' || tail, 'city_centroid', 0.5 from parts union all select id, 7, dis || ' district, ' || sta, 'district_centroid', 0.4 from parts),
hit as (select r.id, r.n, r.q, r.method, r.c, g.*, p.dis, p.sta, row_number() over (partition by r.id order by r.n, g.q, g.lat, g.lon) as rn from rung r join gz g on g.q = lower(r.q) join parts p on p.id = r.id where g.lat between 6.0 and 37.6 and g.lon between 68.0 and 97.5 and coalesce(lower(g.st) = lower(p.sta), true) and coalesce(lower(g.di) = lower(p.dis), true)),
ladder as (select id, method, confidence, lat, lon from direct union all select id, method, least(c, case when sta is null and dis is null then 0.5 else 1 end, case when span > 6 then 0.55 else 1 end), lat, lon from hit where rn = 1)"""


def _ladder(spark, d):
    """Places of the incidents, their text made of the bare pair of numbers in geom, or of town, road and district."""
    text = F.when(F.col("geom").rlike(rf"^\s*{COORDS}\s*$"), F.trim("geom")).when(F.col("road_type").isin("NH", "SH", "MDR") & F.col("admin_city").isNotNull(), F.concat(F.lit("near "), "admin_city", F.lit(", "), F.coalesce("road_name", F.lit("main road")), F.lit(", "), F.coalesce("admin_district", F.lit("town"))))
    i = incidents(spark, d).select("id", text.alias("location_text"), "road_name", "admin_city", "admin_district", "admin_state")
    return ladder(i, _gazetteer(spark, d))


@query(f"""with {INC}, {LADDER} select i.id, l.method, cast(l.confidence as double) as confidence, l.lat, l.lon from inc i left join ladder l using (id)""")
def geocode_ladder(spark, d):
    """Places of incidents by coordinates, landmark, road, town and district against a gazetteer of hotspots and towns."""
    return _ladder(spark, d).select("id", "method", "confidence", "lat", "lon")


@query(f"""with {INC}, {LADDER} select l.id, cast(l.confidence as double) as confidence, case when l.confidence >= 0.6 and i.verification_status = 'needs_human' then 'auto' else i.verification_status end as status from ladder l join inc i using (id) where l.confidence > coalesce(i.geocode_confidence, 0)""")
def geocode_rescue(spark, d):
    """Incidents whose new lookup is strictly better than what they have; one that needs a human and reaches 0.6 is queued again."""
    i = incidents(spark, d)
    old = i.select("id", "lat", "lon", F.col("geocode_confidence").alias("confidence"))
    status = F.when((F.col("confidence") >= 0.6) & (F.col("verification_status") == "needs_human"), "auto").otherwise(F.col("verification_status"))
    return better(old, _ladder(spark, d)).join(i.select("id", "verification_status"), "id").select("id", "confidence", status.alias("status"))


def _merged(spark, d):
    pairs = persist_table(same_crash_pairs(spark, d).select(F.col("keep_id").alias("keep"), F.col("merge_id").alias("merge")), "same-crash")
    rows = incidents(spark, d).select("id")

    def find(left):
        return pairs.join(left.withColumnRenamed("id", "keep"), "keep", "left_semi").join(left.withColumnRenamed("id", "merge"), "merge", "left_semi").select("keep", "merge")

    return merge_rounds(rows, find)


#: The pass over the pairs in order as a recursion: what is gone after each pair, and whether the pair was executed.
_PAIRS_SQL = SQL_OF["same_crash_pairs"].removeprefix("with ")
_CUT = _PAIRS_SQL.index("\nselect case when a.c >= b.c")
MERGES = f"""{_PAIRS_SQL[:_CUT]}, sc as ({_PAIRS_SQL[_CUT:]}), o as (select row_number() over (order by keep_id, merge_id) as rn, keep_id, merge_id from sc),
r(rn, gone, keep_id, merge_id, done) as (select 0::bigint, []::bigint[], null::bigint, null::bigint, false union all select o.rn, case when list_contains(gone, o.keep_id) or list_contains(gone, o.merge_id) then gone else list_append(gone, o.merge_id) end, o.keep_id, o.merge_id, not (list_contains(gone, o.keep_id) or list_contains(gone, o.merge_id)) from r join o on o.rn = r.rn + 1),
ex as (select keep_id, merge_id from r where done)"""


@query(f"with recursive {MERGES} select id from inc where id not in (select merge_id from ex)")
def merged_incidents(spark, d):
    """Incidents left after merging reports of one event, in up to four rounds."""
    return _merged(spark, d)[0]


@query(f"""with recursive {MERGES}, {LINKS}, f(m, k) as (select merge_id, keep_id from ex union all select f.m, ex.keep_id from f join ex on ex.merge_id = f.k), last as (select m, k from f where k not in (select merge_id from ex))
select distinct coalesce(last.k, lnk.incident_id) as incident_id, source_article_id from lnk left join last on last.m = lnk.incident_id""")
def remapped_sources(spark, d):
    """Source links after merging: children of a merged incident move to the one that is left, each link once."""
    _, merges = _merged(spark, d)
    s = links(spark, d).select("incident_id", "source_article_id")
    return remap(s, merges, "incident_id").distinct()


@query(f"""with {SPOTS} select h.id, '[' || cast(round(sp.lon, 6) as varchar) || ',' || cast(round(sp.lat, 6) as varchar) || ']' as xy, len(h.dominant_defects) as n_defects from hotspot h join sp using (id)""")
def geojson_export(spark, d):
    """Features of located hotspots; the query reads the coordinates back out of the GeoJSON text."""
    h = table(spark, d, "hotspot").select("id", "incident_count", "dominant_defects").join(located(table(spark, d, "hotspot"), "id", "centroid_geom"), "id")
    f = geojson_features(h)
    return f.select(F.get_json_object("feature", "$.properties.id").cast("bigint").alias("id"), F.get_json_object("feature", "$.geometry.coordinates").alias("xy"), F.json_array_length(F.get_json_object("feature", "$.properties.dominant_defects")).alias("n_defects"))


@query(f"""with {INC}, {LINKS} select i.id, count(l.source_article_id) as n, coalesce(max(l.source_article_id), -1) as last_source from inc i left join lnk l on l.incident_id = i.id group by 1""")
def nested_export(spark, d):
    """Incidents with their sources as a sorted array of structs."""
    n = nested(incidents(spark, d).select("id"), "id", sources=links(spark, d).select(F.col("incident_id").alias("id"), "source_article_id", "match_confidence"))
    return n.select("id", F.size("sources").alias("n"), F.coalesce(F.array_max(F.transform("sources", lambda s: s["source_article_id"])), F.lit(-1)).alias("last_source"))


@query("""select date_trunc('hour', ts) as start, event_type, count(*) as n, round(sum(value), 2) as total from events group by 1, 2""")
def stream_hourly_counts(spark, d):
    """Tumbling windows of a stream over the events, run to its end."""
    return run_to_table(windowed_counts(event_stream(spark, d, "events")))


@query("""with g as (select *, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minute then 0 else 1 end as new from events),
s as (select *, sum(new) over (partition by user_id order by ts, event_id rows unbounded preceding) as sid from g) select user_id, min(ts) as start, count(*) as n from s group by user_id, sid""")
def session_windows(spark, d):
    e = table(spark, d, "events")
    return sessions(e).select("user_id", "start", "n")
