"""Pieces of oracle SQL: points in any notation, distances."""

from __future__ import annotations

from ..functions.geometry import LAT_LON, WKB_POINT, WKT_POINT


def _sql_double(h: str) -> str:
    hi, lo = f"('0x' || substr({h}, 1, 8))::bigint", f"('0x' || substr({h}, 9, 8))::bigint"
    return f"(case when {hi} >> 31 = 1 then -1.0::double else 1.0::double end) * (((({hi} & 1048575) << 32) + {lo} + 4503599627370496)::double * pow(2.0::double, ((({hi} >> 20) & 2047) - 1075)::double))"


def points_sql(name: str, relation: str, id_col: str, geom: str) -> str:
    """CTEs ending in `name`(id, lat, lon): the located rows of a table with points in any notation."""
    swap = lambda e: " || ".join(f"substr({e}, {15 - 2 * i}, 2)" for i in range(8))
    return f"""{name}_t as (select distinct {id_col} as id, trim({geom}) as t, upper(trim({geom})) as u from {relation}),
{name}_h as (select *, case when regexp_matches(t, '{WKB_POINT}') then case when substr(u, 3, 8) in ('01000020', '010000A0', '20000001') then 19 else 11 end end as st from {name}_t),
{name}_x as (select *, case when substr(u, 1, 2) = '00' then substr(u, st, 16) else {swap("substr(u, st, 16)")} end as hx,
  case when substr(u, 1, 2) = '00' then substr(u, st + 16, 16) else {swap("substr(u, st + 16, 16)")} end as hy from {name}_h),
{name}_p as (select id,
  case when regexp_matches(t, '{WKT_POINT}') then try_cast(regexp_extract(t, '{WKT_POINT}', 1) as double) when regexp_matches(t, '{LAT_LON}') then try_cast(regexp_extract(t, '{LAT_LON}', 2) as double) when st is not null then {_sql_double("hx")} end as lon,
  case when regexp_matches(t, '{WKT_POINT}') then try_cast(regexp_extract(t, '{WKT_POINT}', 2) as double) when regexp_matches(t, '{LAT_LON}') then try_cast(regexp_extract(t, '{LAT_LON}', 1) as double) when st is not null then {_sql_double("hy")} end as lat from {name}_x),
{name} as (select distinct id, lat, lon from {name}_p where lat between -90 and 90 and lon between -180 and 180 and not (lat = 0 and lon = 0))"""


def HAV(a: str, b: str) -> str:  # noqa: N802
    """Great-circle distance between two relations with lat and lon."""
    return f"2 * 6371008.8::double * asin(sqrt(least(1.0::double, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"


PTS = points_sql("pt", "incident", "id", "geom")
SPOTS = points_sql("sp", "hotspot", "id", "centroid_geom")
