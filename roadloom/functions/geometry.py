"""Point notations, distances and grid cells as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8
MERCATOR_RADIUS_M = 6378137.0
_NUM = r"([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)"
WKT_POINT = rf"(?i)^\s*(?:SRID\s*=\s*4326\s*;)?\s*POINT\s*(?:Z|M|ZM)?\s*\(\s*{_NUM}\s+{_NUM}(?:\s+[-+.\deE]+)*\s*\)\s*$"
LAT_LON = rf"^\s*{_NUM}\s*[,;]\s*{_NUM}\s*$"
WKB_POINT = r"(?i)^\s*(?:01(?:01000000|010000A0|01000080|01000040|01000020E6100000|010000A0E6100000)|00(?:00000001|20000001000010E6))[0-9A-F]{32,}\s*$"


def _swap(h: Column) -> Column:
    return F.concat(*[F.substring(h, 15 - 2 * i, 2) for i in range(8)])


def with_point(df: DataFrame, text: Column, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """df with lat and lon of a point written as WKT, EWKT, (E)WKB hex or "lat, lon".

    Null for null, blank, POINT EMPTY, the point 0 0, unreadable text and coordinates off the globe.  A double in WKB is
    read from its 16 hex digits by exact arithmetic.  The steps are projections of their own, so each pattern runs once.
    """
    keep = [c for c in df.columns if c not in (lat, lon)]
    df = df.select(*keep, F.trim(text).alias("_pt_t"))
    t = F.col("_pt_t")
    kind = F.when(t.rlike(WKT_POINT), "wkt").when(t.rlike(LAT_LON), "pair").when(t.rlike(WKB_POINT), "wkb")
    df = df.select("*", kind.alias("_pt_k"))
    at = F.when(F.upper(F.substring(t, 3, 8)).isin("01000020", "010000A0", "20000001"), 19).otherwise(11)
    df = df.select("*", *[F.when(F.col("_pt_k") == "wkb", t.substr(at + 16 * i, F.lit(16))).alias(n) for i, n in enumerate(("_pt_rx", "_pt_ry"))], F.when(F.col("_pt_k") == "wkt", F.split(F.regexp_replace(t, WKT_POINT, "$1 $2"), " ")).when(F.col("_pt_k") == "pair", F.split(F.regexp_replace(t, LAT_LON, "$2 $1"), " ")).alias("_pt_n"))
    big = F.left(t, F.lit(2)) == "00"
    df = df.select("*", *[F.when(big, F.col(n)).otherwise(_swap(F.col(n))).alias(n[:4] + "b" + n[-1]) for n in ("_pt_rx", "_pt_ry")])
    halves = [(f"_pt_{h}{c}", F.conv(F.substring(f"_pt_b{c}", s, 8), 16, 10).try_cast("bigint")) for c in "xy" for h, s in (("h", 1), ("l", 9))]
    df = df.select("*", *[v.alias(n) for n, v in halves])

    def double(c: str) -> Column:
        hi, lo = F.col(f"_pt_h{c}"), F.col(f"_pt_l{c}")
        exponent = F.shiftright(hi, 20).bitwiseAND(F.lit(2047))
        mantissa = (F.shiftleft(hi.bitwiseAND(F.lit(1048575)), 32) + lo).cast("double")
        size = F.when(exponent == 0, mantissa * F.lit(2.0**-1074)).when(exponent < 2047, (mantissa + F.lit(float(1 << 52))) * F.pow(F.lit(2.0), (exponent - 1075).cast("double")))
        return size * F.when(F.shiftright(hi, 31) == 1, -1.0).otherwise(1.0)

    value = [F.when(F.col("_pt_k") == "wkb", double(c)).otherwise(F.get("_pt_n", F.lit(i)).try_cast("double")) for i, c in enumerate("xy")]
    df = df.select(*keep, value[0].alias("_pt_x"), value[1].alias("_pt_y"))
    x, y = F.col("_pt_x"), F.col("_pt_y")
    # non-deterministic: keeps a later filter on lat or lon from repeating the parsing
    ok = (F.spark_partition_id() >= 0) & x.between(-180, 180) & y.between(-90, 90) & ~((x == 0) & (y == 0))
    return df.select(*keep, F.when(ok, y).alias(lat), F.when(ok, x).alias(lon))


def sphere_distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance (haversine) on the mean sphere."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def ellipsoid_distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on WGS84 for thresholds of about a kilometre: radii of curvature at the mid-latitude."""
    e2 = 0.0066943799901413165
    phi = F.radians((lat1 + lat2) / 2)
    w = F.lit(1.0) - F.lit(e2) * F.sin(phi) * F.sin(phi)
    m = F.lit(MERCATOR_RADIUS_M * (1 - e2)) / (w * F.sqrt(w))
    n = F.lit(MERCATOR_RADIUS_M) / F.sqrt(w)
    dy, dx = m * F.radians(lat2 - lat1), n * F.cos(phi) * F.radians(lon2 - lon1)
    return F.sqrt(dx * dx + dy * dy)


def mercator(lat: Column, lon: Column) -> tuple[Column, Column]:
    x = F.lit(MERCATOR_RADIUS_M) * F.radians(lon)
    y = F.lit(MERCATOR_RADIUS_M) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))
    return x, y


def _band_height(radius_m: float) -> float:
    return math.degrees(radius_m / EARTH_RADIUS_M) * 1.000001


def _band_cells(band: Column, height: float) -> Column:
    """Cells around a latitude band: each at least radius wide at the band's widest parallel's poleward edge."""
    edge = F.least(F.lit(90.0), F.greatest(F.abs(band * height), F.abs((band + 1) * height)))
    return F.greatest(F.lit(1), F.floor(F.lit(360.0 / height) * F.cos(F.radians(edge)))).cast("bigint")


def _number(band: Column, cell: Column) -> Column:
    return F.shiftleft(band.cast("bigint"), 32) + cell.cast("bigint")


def home_cell(lat: Column, lon: Column, radius_m: float) -> Column:
    """Number of a point's cell (band in the upper half, cell in the lower) on a grid whose bands are one radius high; valid at
    the poles and the antimeridian."""
    h = _band_height(radius_m)
    band = F.floor(lat / h)
    n = _band_cells(band, h)
    cell = F.pmod(F.floor((lon + 180.0) / 360.0 * n), n)
    return _number(band, cell)


def near_cells(lat: Column, lon: Column, radius_m: float) -> Column:
    """array of the numbers of all cells that can hold a point within the radius."""
    h = _band_height(radius_m)
    ang = radius_m / EARTH_RADIUS_M * 1.000001
    ratio = F.lit(math.sin(ang)) / F.cos(F.radians(lat))
    polar = (ratio >= 1) | (F.abs(lat) + math.degrees(ang) >= 90)
    half = F.when(polar, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), ratio))) * 1.000001)

    def cells(b: Column) -> Column:
        n = _band_cells(b, h)
        lo, hi = F.floor((lon + 180.0 - half) / 360.0 * n), F.floor((lon + 180.0 + half) / 360.0 * n)
        hi = F.least(hi, lo + n - 1)  # a whole turn at most
        return F.transform(F.sequence(lo, hi), lambda c: _number(b, F.pmod(c, n)))

    b0 = F.floor(lat / h)
    return F.array_distinct(F.flatten(F.transform(F.sequence(b0 - 1, b0 + 1), cells)))
