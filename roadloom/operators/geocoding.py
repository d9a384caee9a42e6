"""Place lookup by a ladder of queries against a gazetteer table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Caps of confidence for hits that could not be verified, the span in km beyond which a pin is vague, the pattern
# of coordinates in a text, words that lead a landmark, and the box that hits must lie in (south, north, west, east).
UNANCHORED_CAP, UNVERIFIED_CAP, WIDE_CAP, WIDE_KM = 0.5, 0.55, 0.55, 6.0
COORDS = r"(\d{1,2}\.\d{3,})[,\s]+(\d{2,3}\.\d{3,})"
LEAD_WORDS = r"(?i)^(near|close to|opposite|समीप)\s+"
BOX = (6.0, 37.6, 68.0, 97.5)


def in_box(lat: Column, lon: Column) -> Column:
    return lat.between(BOX[0], BOX[1]) & lon.between(BOX[2], BOX[3])


def _text(c: str) -> Column:
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def variants() -> Column:
    """array of struct(query, method, confidence) in descending specificity; repeated queries are harmless (first rung wins)."""
    loc, road, city, dis, sta = (_text(c) for c in ("location_text", "road_name", "admin_city", "admin_district", "admin_state"))
    tail = F.nullif(F.concat_ws(", ", dis, sta), F.lit(""))
    parts = F.filter(F.transform(F.split(loc, "[,;]"), F.trim), lambda p: p != "")
    mark = F.nullif(F.trim(F.regexp_replace(F.get(parts, F.lit(0)), LEAD_WORDS, "")), F.lit(""))
    v = lambda cond, q, m, c: F.when(cond, F.named_struct(F.lit("query"), q, F.lit("method"), F.lit(m), F.lit("confidence"), F.lit(c)))
    rest = lambda i: F.array_join(F.slice(parts, i + 1, F.greatest(F.size(parts) - i, F.lit(0))), ", ")
    return F.array_compact(F.array(
        v(loc.isNotNull(), loc, "landmark_district", 0.80),
        v(mark.isNotNull() & tail.isNotNull() & ~F.lower(mark).eqNullSafe(F.lower(dis)), F.concat_ws(", ", mark, tail), "landmark_district", 0.80),
        v(F.size(parts) > 2, rest(1), "road_city", 0.70),
        v(F.size(parts) > 3, rest(2), "road_city", 0.70),
        v(road.isNotNull() & tail.isNotNull(), F.concat_ws(", ", road, tail), "road_city", 0.70),
        v(city.isNotNull() & tail.isNotNull(), F.concat_ws(", ", city, tail), "city_centroid", 0.50),
        v(dis.isNotNull() & sta.isNotNull(), F.concat(dis, F.lit(" district, "), sta), "district_centroid", 0.40),
    ))


# Names under which one state or district is known; the first stands for all.
STATE_NAMES = [["odisha", "orissa"], ["uttarakhand", "uttaranchal"], ["puducherry", "pondicherry"]]
DISTRICT_NAMES = [
    ["chhatrapati sambhajinagar", "aurangabad"], ["dharashiv", "osmanabad"], ["prayagraj", "allahabad"], ["ayodhya", "faizabad"], ["gurugram", "gurgaon"],
    ["bengaluru urban", "bangalore urban", "bengaluru", "bangalore"], ["mysuru", "mysore"],
]


def _one_name(name: Column, names: list[list[str]]) -> Column:
    known = F.create_map(*[F.lit(x) for group in names for other in group for x in (other, group[0])])
    return F.coalesce(F.try_element_at(known, name), name)


def same_district(got: Column, expected: Column) -> Column:
    """True unless both are known and differ; suffixes, case and renaming aside."""
    clean = lambda c: F.nullif(F.regexp_replace(F.lower(F.trim(c)), r"( district| dist\.?)$", ""), F.lit(""))
    return F.coalesce(_one_name(clean(got), DISTRICT_NAMES) == _one_name(clean(expected), DISTRICT_NAMES), F.lit(True))


def same_state(got: Column, expected: Column) -> Column:
    clean = lambda c: F.nullif(F.lower(F.trim(c)), F.lit(""))
    return F.coalesce(_one_name(clean(got), STATE_NAMES) == _one_name(clean(expected), STATE_NAMES), F.lit(True))


def ladder(places: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(id, lat, lon, confidence, method, qualifier) of each row (id, location_text, road_name, admin_city, admin_district,
    admin_state).

    Coordinates in the text win; else the first rung whose hit lies in the box and in the expected state and district.
    Hits that could not be verified are capped.  Rows without a hit come out with nulls.
    gazetteer: (query, lat, lon, state, district, span_km), joined on the lower-case query.
    """
    la, lo = (F.regexp_extract(F.coalesce("location_text", F.lit("")), COORDS, i).try_cast("double") for i in (1, 2))
    p = places.select("id", "location_text", "road_name", "admin_city", "admin_district", "admin_state", F.when(in_box(la, lo), F.struct(la.alias("lat"), lo.alias("lon"))).alias("_xy"))
    rungs = p.where(F.col("_xy").isNull()).select("id", "admin_district", "admin_state", F.posexplode(variants()).alias("rung", "v"))
    g = gazetteer.select(F.lower("query").alias("_q"), "lat", "lon", "state", "district", F.coalesce("span_km", F.lit(0.0)).alias("span_km"))
    h = rungs.withColumn("_q", F.lower("v.query")).join(g, "_q").where(in_box(F.col("lat"), F.col("lon")) & same_state(F.col("state"), F.col("admin_state")) & same_district(F.col("district"), F.col("admin_district")))
    best = h.groupBy("id").agg(F.min(F.struct("rung", "_q", "lat", "lon", "state", "district", "span_km", "v", "admin_state", "admin_district")).alias("s")).select("id", "s.*")
    blank = lambda c: F.coalesce(F.trim(F.col(c)) == "", F.lit(True))
    anchored = ~(blank("admin_state") & blank("admin_district"))
    why = F.when(~anchored, "unanchored").when(blank("state"), "stateless_hit").when(~blank("admin_district") & blank("district"), "districtless_hit")
    cap = F.when(~anchored, UNANCHORED_CAP).when(blank("state") | (~blank("admin_district") & blank("district")), UNVERIFIED_CAP).otherwise(1.0)
    wide = F.col("span_km") > WIDE_KM
    found = best.select("id", "lat", "lon", F.least(F.col("v.confidence"), cap, F.when(wide, WIDE_CAP).otherwise(1.0)).alias("confidence"), F.col("v.method").alias("method"), F.coalesce(why, F.when(wide, "wide_area")).alias("qualifier"))
    direct = p.where(F.col("_xy").isNotNull()).select("id", "_xy.lat", "_xy.lon", F.lit(0.95).alias("confidence"), F.lit("coords_in_text").alias("method"), F.lit(None).cast("string").alias("qualifier"))
    return places.select("id").join(found.unionByName(direct), "id", "left")


def better(old: DataFrame, new: DataFrame) -> DataFrame:
    """(id, lat, lon, confidence) of rows (id, lat, lon, confidence) whose new lookup is strictly better."""
    n = new.select("id", F.col("lat").alias("_la"), F.col("lon").alias("_lo"), F.col("confidence").alias("_c"))
    return old.join(n, "id").where(F.col("_c") > F.coalesce("confidence", F.lit(0.0))).select("id", F.col("_la").alias("lat"), F.col("_lo").alias("lon"), F.col("_c").alias("confidence"))
