"""Projections and derived columns: one narrow stage each, no Python in the hot path."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from placeloom.functions import catalogs as cat, scalars as fn
from placeloom.functions.scalars import tag


def project_local(points: DataFrame, places: DataFrame) -> DataFrame:
    """lat/lon to metres east/north of the place's centre."""
    kx, ky = fn.plane_scale(F.col("lat0"), F.col("projection"))
    centre = places.select("place_id", "lat0", "lon0", kx.alias("kx"), ky.alias("ky"))
    return (points.join(centre, "place_id")
            .withColumns({"x_m": (F.col("lon") - F.col("lon0")) * F.col("kx"), "y_m": (F.col("lat") - F.col("lat0")) * F.col("ky")})
            .drop("lat0", "lon0", "kx", "ky"))


def unproject_local(points: DataFrame, places: DataFrame) -> DataFrame:
    kx, ky = fn.plane_scale(F.col("lat0"), F.col("projection"))
    centre = places.select("place_id", "lat0", "lon0", kx.alias("kx"), ky.alias("ky"))
    return (points.join(centre, "place_id")
            .withColumns({"lat": F.col("lat0") + F.col("y_m") / F.col("ky"), "lon": F.col("lon0") + F.col("x_m") / F.col("kx")})
            .drop("lat0", "lon0", "kx", "ky"))


def project_tm(points: DataFrame) -> DataFrame:
    north, east = fn.transverse_mercator(F.col("lat"), F.col("lon"))
    return points.withColumns({"north_m": north, "east_m": east})


def place_bbox(places: DataFrame, pad_m: float = 80.0) -> DataFrame:
    """Lat/lon square of the place, and the padded box a download asks for."""
    half = F.col("size_m") / 2
    kx, ky = fn.plane_scale(F.col("lat0"), F.col("projection"))
    inner = places.withColumns({"south": F.col("lat0") - half / ky, "north": F.col("lat0") + half / ky,
                                "west": F.col("lon0") - half / kx, "east": F.col("lon0") + half / kx})
    deg = F.lit(cat.EARTH_M_PER_DEG)
    mid = F.radians((F.col("south") + F.col("north")) / 2)
    return inner.withColumns({
        "fetch_south": F.col("south") - F.lit(pad_m) / deg, "fetch_north": F.col("north") + F.lit(pad_m) / deg,
        "fetch_west": F.col("west") - F.lit(pad_m) / (deg * F.cos(mid)), "fetch_east": F.col("east") + F.lit(pad_m) / (deg * F.cos(mid))})


def to_engine_axes(points: DataFrame, scale: float = cat.METRES_PER_ENGINE_UNIT) -> DataFrame:
    """x east, y north, z up to X east, Y up, Z south in engine units; rows with a non-finite value are refused."""
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < F.lit(float("inf"))) for c in ("x_m", "y_m", "z_m")]
    return (points.filter(finite[0] & finite[1] & finite[2])
            .withColumns({"ex": F.col("x_m") / scale, "ey": F.col("z_m") / scale, "ez": -F.col("y_m") / scale + F.lit(0.0)}))


def from_engine_axes(points: DataFrame, scale: float = cat.METRES_PER_ENGINE_UNIT) -> DataFrame:
    return points.withColumns({"x_m": F.col("ex") * scale, "y_m": -F.col("ez") * scale + F.lit(0.0), "z_m": F.col("ey") * scale})


def normalize_measures(features: DataFrame, columns: list[str]) -> DataFrame:
    return features.withColumns({f"{c}_m": fn.parse_measure(F.col(c)) for c in columns})


def normalize_colours(features: DataFrame, column: str = "colour") -> DataFrame:
    return features.withColumn("rgb", fn.parse_colour(F.col(column)))


def nearest_palette(features: DataFrame, palette: dict, rgb: str = "rgb") -> DataFrame:
    return features.withColumn("palette_key", fn.nearest_key(F.col(rgb), palette))


def first_tag(features: DataFrame, keys: list[str], out: str) -> DataFrame:
    """The first non-empty tag verbatim, and where it comes from (tags NULL: cannot be known)."""
    value = fn.first_of(*[tag(k) for k in keys])
    origin = F.when(value.isNotNull(), "osm").when(F.col("tags").isNotNull(), "none").otherwise("unknown")
    return features.withColumns({out: value, f"{out}_origin": origin})


def road_width(roads: DataFrame) -> DataFrame:
    """Metres: width tag, else lanes, else the class default; service subtypes fixed; clamped by road family."""
    hw, tagged = tag("highway"), fn.truthy(fn.parse_measure(tag("width")))
    lanes = fn.truthy(fn.parse_measure(tag("lanes")))
    default = fn.lookup({k: float(v) for k, v in cat.CAR_WIDTH.items()}, hw)
    car = F.coalesce(tagged, lanes * 3.2 + 0.6, default)
    car = F.when(hw == "service", F.coalesce(fn.lookup(cat.SERVICE_WIDTH, tag("service")), car)).otherwise(car)
    soft = F.coalesce(tagged, fn.lookup(cat.SOFT_WIDTH, hw))
    width = (F.when(hw.isin(list(cat.CAR_WIDTH)), F.least(F.greatest(car, F.lit(2.6)), F.lit(22.0)))
             .when(hw.isin(list(cat.SOFT_WIDTH)), F.least(F.greatest(soft, F.lit(1.4)), F.lit(8.0))))
    return roads.withColumn("width_m", width)


def level_columns() -> dict[str, Column]:
    """Layer (NULL when unreadable) and indoor level from a road's tags."""
    layer_text = tag("layer")
    layer = (F.when(layer_text.isNotNull(), F.trim(layer_text).try_cast("int"))
             .when(F.coalesce(tag("bridge"), F.lit("no")) != "no", 1)
             .when(~F.coalesce(tag("tunnel"), F.lit("no")).isin("no", "building_passage"), -1).otherwise(0))
    level = F.when(~F.coalesce(tag("level"), F.lit("")).isin("", "0"), tag("level"))
    return {"z_layer": layer, "z_level": level}


def vertical_level(roads: DataFrame) -> DataFrame:
    return roads.withColumns(level_columns())


def at_ground(features: DataFrame) -> DataFrame:
    """Whether a covered way runs at the ground; NULL when its layer or level cannot be read."""
    layer = F.trim(F.coalesce(tag("layer"), F.lit("0"))).try_cast("int")
    parts = F.filter(F.split(F.coalesce(tag("level"), F.lit("0")), "[;,]"), lambda v: F.trim(v) != "")
    levels = F.transform(parts, lambda v: F.trim(v).try_cast("double"))
    readable = layer.isNotNull() & F.forall(levels, lambda v: v.isNotNull())
    return features.withColumn("at_ground", F.when(readable, (layer == 0) & F.exists(levels, lambda v: v == 0.0)))


def min_height() -> Column:
    """Where walls start: min_height, else min_level storeys, else 0."""
    return F.coalesce(fn.truthy(fn.parse_measure(tag("min_height"))),
                      F.coalesce(fn.parse_measure(tag("building:min_level")), F.lit(0.0)) * cat.STOREY_M)


def ground_level(features: DataFrame) -> DataFrame:
    low = min_height()
    return features.withColumns({"min_height_m": low, "floating": low > cat.FLOATING_M})


def bearings(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("bearing", fn.bearing(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))


def oldest_source_time(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Oldest stated time of a download's parts as ISO text; NULL when any part states none."""
    http_date = F.regexp_extract("server_date", r"^[A-Za-z]{3}, ([0-9]{2} [A-Za-z]{3} [0-9]{4} [0-9:]{8}) GMT$", 1)
    stated = F.coalesce(F.try_to_timestamp(http_date, F.lit("dd MMM yyyy HH:mm:ss")), F.try_to_timestamp("base_time"))
    agg = parts.groupBy(*keys).agg(F.min(stated).alias("t"), F.bool_and(stated.isNotNull()).alias("all_stated"))
    return agg.select(*keys, F.when(F.col("all_stated"), F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("oldest_utc"))


def recognise_licences(sources: DataFrame, known=None) -> DataFrame:
    """One row per part of an attribution; `licence` NULL marks a part whose terms are not known."""
    known = known or cat.TERRAIN_LICENCES
    parts = sources.withColumn("part", F.explode(F.split("attribution", " · "))).withColumn("part", F.trim("part")).filter("part <> ''")
    data = licence = None
    for phrase, name, terms in known:
        hit = F.contains(F.col("part"), F.lit(phrase))
        data = F.when(hit, name) if data is None else data.when(hit, name)
        licence = F.when(hit, terms) if licence is None else licence.when(hit, terms)
    return parts.withColumns({"data": data, "licence": licence})


def slugs(features: DataFrame, column: str, default: str = "city") -> DataFrame:
    folded = fn.fold_ascii(F.col(column))
    return (features.withColumn("_folded", folded)
            .withColumns({"slug": fn.slug(F.col("_folded"), default), "room": fn.room_code(F.col("_folded"), default.upper()),
                          "map_id": fn.map_code(F.col(column))}).drop("_folded"))


def format_coords(points: DataFrame) -> DataFrame:
    heading = F.rint(F.col("heading")).cast("bigint").cast("string")
    return points.withColumns({
        "lat_text": fn.format_dms(F.col("lat"), "N", "S"), "lon_text": fn.format_dms(F.col("lon"), "E", "W"),
        "map_url": F.format_string("https://www.openstreetmap.org/?mlat=%.5f&mlon=%.5f#map=16/%.5f/%.5f", "lat", "lon", "lat", "lon"),
        "view_url": F.concat(F.format_string("https://www.google.com/maps/@?api=1&map_action=pano&viewpoint=%.6f,%.6f&heading=",
                                             "lat", "lon"), heading, F.lit("&pitch=8&fov=80"))})


def fill_templates(places: DataFrame, templates: dict[str, str], overrides: DataFrame) -> DataFrame:
    """One text per (place, key): the override, else the default, with {Name} and {NAME} filled in.
    Places carry optional `landmark` and `street`, which fall back to a phrase about the place."""
    table = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("template")) for k, v in templates.items()])
    rows = places.withColumn("t", F.explode(table)).select("place_id", "name", "landmark", "street", "t.*")
    picked = rows.join(overrides.select("place_id", "key", F.col("text").alias("override")), ["place_id", "key"], "left")
    text = F.coalesce("override", "template")
    for mark, value in {"{Name}": F.col("name"), "{NAME}": F.upper("name"),
                        "{Landmark}": F.coalesce("landmark", F.concat(F.lit("the old streets of "), "name")),
                        "{Street}": F.coalesce("street", F.lit("the main street"))}.items():
        text = F.replace(text, F.lit(mark), value)
    return picked.select("place_id", "key", text.alias("text"))


# Keyword rules over survey notes, as (flag, any of, none of). Case-insensitive.
NOTE_RULES = [
    ("block", [r"\b(19)?[56]0s\b", "block", "modern", "office"], []),
    ("apartment", ["apartment"], []),
    ("half_storey", ["1½"], []),
    ("villa", ["villa"], []),
    ("hall", ["hall", "warehouse", "workshop", r"store\b", "barn", "garage", "shed", "industrial"], ["villa"]),
    ("arched", ["arched"], []),
    ("garages", ["garage", "big doors", "barn", "carport"], []),
    ("garage_row", ["garages", "garage row", "carport"], []),
    ("steep", ["steep", "1½"], []),
    ("mansard", ["mansard"], []),
    ("surrounds", ["surround", "white trim"], []),
    ("awning", ["awning", "canop"], []),
    ("plain_canopy", ["canop"], ["awning", "porch", "gabled canop", "entrance canop"]),
    ("porch", ["entrance porch", "porches"], ["garage", "big doors", "barn", "carport"]),
    ("cross_gable", ["cross gable", "central gable", "pointed gable", "gable dormer", "gabled dormer"], []),
    ("dormer", ["dormer"], ["gable dormer"]),
    ("chimney", ["chimney"], []),
    ("balcony", ["balcon"], ["gallery"]),
    ("glass_balcony", ["glazed balcon", "glass"], []),
    ("gallery", ["gallery", "external stair"], []),
    ("veranda", ["veranda"], []),
]
# Ordered choices (first match wins) with a default.
NOTE_CHOICES = {
    "frame": ([("falu", ["red trim", "red window", "red frames", "red-painted window"]), ("brown", ["brown window", "brown frames"])], "none"),
    "awning_colour": ([("striped", ["striped"]), ("blue", ["blue"]), ("red", [r"\bred\b"])], "white"),
    "door": ([("brown", ["brown doors"]), ("weathered", ["grey doors", "grey garage doors"])], "white"),
    "rail": ([("green", ["green balcon"]), ("red", ["red balcon"])], "white"),
}
PANEL_COLOURS = {"mustard": "ochre", "ochre": "ochre", "red": "falu", "blue": "blue", "green": "green", "copper": "brown", "brown": "brown"}
PANEL_PATTERN = r"(?i)(mustard|ochre|red|blue|green|copper|brown)[- ]?(brown )?panels"


def _any_of(words: list[str]) -> str:
    return "(?i)(" + "|".join(words) + ")"


def note_features(notes: DataFrame, column: str = "note") -> DataFrame:
    """Keyword flags and choices from free text: one regular expression per rule, no row-wise Python."""
    text = F.col(column)
    out = {}
    for flag, words, without in NOTE_RULES:
        hit = text.rlike(_any_of(words))
        out[flag] = hit & ~text.rlike(_any_of(without)) if without else hit
    for name, (choices, default) in NOTE_CHOICES.items():
        choice = None
        for value, words in choices:
            hit = text.rlike(_any_of(words))
            choice = F.when(hit, value) if choice is None else choice.when(hit, value)
        out[name] = choice.otherwise(default)
    out["panels"] = fn.lookup(PANEL_COLOURS, F.lower(F.regexp_extract(text, PANEL_PATTERN, 1)))
    return notes.withColumns(out)


def polar_pad(x: Column, y: Column, angle: float, radius: float) -> tuple[Column, Column]:
    return x + math.cos(angle) * radius, y + math.sin(angle) * radius
