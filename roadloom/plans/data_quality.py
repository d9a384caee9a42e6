"""Queries of the general data-processing problems: instants and proximity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.instants import all_instants
from ..operators.proximity import neighbourhood
from ..runtime import table
from .geo_sql import HAV, PTS, SPOTS


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return all_instants(*[table(spark, d, t) for t in ("source_article", "feed_item", "gdelt_item", "outlet")])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return neighbourhood(*[table(spark, d, t) for t in ("incident", "hotspot", "district_area")])


QUERIES = {"p2_found": p2_found, "p3_found": p3_found}
#: Regions by the even-odd rule over the rings of each area.
SQL: dict[str, str] = {
    "p3_found": f"""with {PTS}, {SPOTS}, ring as (select region_id, unnest(regexp_extract_all(area_wkt, '\\(([^()]+)\\)', 1)) as r, unnest(range(len(regexp_extract_all(area_wkt, '\\(([^()]+)\\)', 1)))) as k from district_area),
corner as (select region_id, k, unnest(string_split(r, ', ')) as c, unnest(range(len(string_split(r, ', ')))) as n from ring),
xy as (select region_id, k, n, cast(string_split(trim(c), ' ')[1] as double) as x, cast(string_split(trim(c), ' ')[2] as double) as y from corner),
edge as (select region_id, x as x1, y as y1, lead(x) over (partition by region_id, k order by n) as x2, lead(y) over (partition by region_id, k order by n) as y2 from xy)
select 'incident' as kind, a.id as key_a, b.id as key_b from pt a join pt b on a.id < b.id and abs(a.lat - b.lat) < 0.003 and {HAV("a", "b")} <= 300
union all select 'hotspot', least(a.id, b.id), greatest(a.id, b.id) from pt a join sp b on abs(a.lat - b.lat) < 0.003 and {HAV("a", "b")} <= 300
union all select 'district', least(id, region_id), greatest(id, region_id) from (select id, region_id from pt join edge on x2 is not null and (y1 > lat) <> (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 group by 1, 2 having count(*) % 2 = 1)""",
}
