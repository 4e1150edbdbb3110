"""Classification by tags. Every class is one ordered `when` over map lookups: a narrow stage inside codegen."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeloom.functions import catalogs as cat, scalars as fn
from placeloom.functions.scalars import tag
from placeloom.operators.derive import road_width

# Rules are (group, element type, [(key, allowed values or None, forbidden values or None), ...]); conditions are ANDed.
Rule = tuple[str, str, list[tuple[str, list[str] | None, list[str] | None]]]


def select_by_tags(elements: DataFrame, rules: list[Rule]) -> DataFrame:
    """The elements any rule asks for, with the groups that asked. Conditions on plain columns of the same name are
    pushed to the scan; conditions on the tag map are evaluated in the same stage."""
    groups: dict[str, Column] = {}
    for group, etype, conditions in rules:
        hit = F.col("etype") == etype
        for key, allowed, forbidden in conditions:
            value = F.col(key) if key in elements.columns else tag(key)
            hit = hit & value.isNotNull()
            if allowed:
                hit = hit & value.isin(allowed)
            if forbidden:
                hit = hit & ~value.isin(forbidden)
        groups[group] = groups[group] | hit if group in groups else hit
    asked = F.array_compact(F.array(*[F.when(hit, F.lit(group)) for group, hit in groups.items()]))
    return elements.withColumn("groups", asked).filter(F.size("groups") > 0)


def classify_roads(ways: DataFrame) -> DataFrame:
    """Roads that are built, with family (car / soft), width and ground stratum."""
    hw, surface = tag("highway"), F.coalesce(tag("surface"), F.lit(""))
    tunnel, layer = tag("tunnel"), F.coalesce(tag("layer"), F.lit("0"))
    family = F.when(hw.isin(list(cat.CAR_WIDTH)), "car").when(hw.isin(list(cat.SOFT_WIDTH)), "soft")
    built = (hw.isNotNull() & fn.first_of(tag("hide")).isNull() & (F.coalesce(tag("area"), F.lit("")) != "yes")
             & ~hw.isin(cat.UNBUILT_ROADS) & ~F.coalesce(tunnel, F.lit("")).isin("yes", "culvert")
             & ~(layer.startswith("-") & fn.first_of(tunnel).isNotNull()) & family.isNotNull())
    stratum = (F.when(family == "car", F.when(hw == "pedestrian", "paving").when(surface.isin(cat.COBBLE_SURFACES), "cobble")
                      .when(surface.isin(cat.SOFT_SURFACES) | (hw == "track"), "path").otherwise("asphalt"))
               .otherwise(F.when(surface.isin(cat.SOFT_SURFACES) | (hw.isin("path", "bridleway") & (surface == "")), "path")
                          .otherwise("paving")))
    passage = (F.coalesce(tunnel, F.lit("")) == "building_passage") | (F.coalesce(tag("covered"), F.lit("")) == "yes")
    bridge = ~F.coalesce(fn.first_of(tag("bridge")), F.lit("no")).isin("no")
    return road_width(ways.filter(built)).withColumns({"family": family, "stratum": stratum, "passage": passage, "is_bridge": bridge})


def classify_sidewalks(roads: DataFrame) -> DataFrame:
    """One row per generated sidewalk: side +1 left, -1 right, and width."""
    both = F.coalesce(tag("sidewalk:both"), F.lit(""))
    side = F.coalesce(tag("sidewalk"), tag("sidewalk:both"), F.lit(""))
    has = tag("highway").isin(cat.SIDEWALK_CLASSES) & ~side.isin("no", "none", "separate") & (both != "separate")
    sides = F.when(side == "left", F.array(F.lit(1))).when(side == "right", F.array(F.lit(-1))).otherwise(F.array(F.lit(1), F.lit(-1)))
    return (roads.filter(has).withColumn("side", F.explode(sides))
            .withColumn("sidewalk_m", F.coalesce(fn.truthy(fn.parse_measure(tag("sidewalk:width"))), F.lit(1.9))))


def classify_road_areas(features: DataFrame) -> DataFrame:
    """Squares and mapped road areas as carriageway or paving."""
    hw, area_hw = tag("highway"), tag("area:highway")
    asked = ((hw.isin("pedestrian", "footway", "service", "residential", "unclassified") & (tag("area") == "yes"))
             | (tag("place") == "square") | area_hw.isNotNull() | (tag("amenity") == "marketplace"))
    kind = fn.first_of(area_hw, hw, F.lit("pedestrian"))
    car = kind.isin("residential", "unclassified", "service", "secondary", "primary", "tertiary") & ~F.coalesce(
        tag("surface"), F.lit("")).isin(cat.COBBLE_SURFACES)
    return features.filter(asked).withColumn("ground", F.when(car, "asphalt").otherwise("paving"))


def building_kind() -> Column:
    kind = fn.first_of(tag("building"), tag("building:part"), F.lit("yes"))
    return F.when((kind == "yes") & (F.coalesce(tag("amenity"), F.lit("")) == "place_of_worship"), "church").otherwise(kind)


def classify_buildings(features: DataFrame) -> DataFrame:
    """Outlines and parts that are built, with kind and kind family."""
    outline = tag("building").isNotNull() & ~tag("building").isin(cat.NOT_BUILT)
    part = tag("building:part").isNotNull() & (tag("building:part") != "no")
    kind = building_kind()
    return (features.filter(outline | part)
            .withColumns({"role": F.when(tag("building").isNotNull(), "outline").otherwise("part"), "kind": kind,
                          "is_house": kind.isin(cat.HOUSE_KINDS), "is_small": kind.isin(cat.SMALL_KINDS),
                          "is_church": kind.isin(cat.CHURCH_KINDS)}))


# Ground class rules, tried in order: (class, [(key, values), ...]) with the pairs ORed.
GROUND_RULES = [
    ("platform", [("railway", ["platform"]), ("public_transport", ["platform"])]),
    ("rail", [("railway", ["rail", "light_rail", "narrow_gauge"])]),
    ("sand", [("natural", ["beach", "sand"]), ("leisure", ["playground"]), ("landuse", ["sand"])]),
    ("pitch", [("leisure", ["pitch", "golf_course", "track", "stadium"])]),
    ("park", [("leisure", ["park", "garden", "common", "recreation_ground", "dog_park", "nature_reserve"])]),
    ("grass", [("landuse", ["grass", "village_green", "meadow", "flowerbed", "recreation_ground", "greenfield", "allotments",
                            "orchard", "plant_nursery", "vineyard"]), ("natural", ["grassland", "heath", "scrub", "fell"])]),
    ("cemetery", [("landuse", ["cemetery"]), ("amenity", ["grave_yard"])]),
    ("forest", [("landuse", ["forest"]), ("natural", ["wood", "tree_group"])]),
    ("field", [("landuse", ["farmland"])]),
    ("dirt", [("landuse", ["brownfield", "construction", "landfill", "quarry", "railway"]), ("natural", ["bare_rock", "scree", "mud"])]),
    ("pier", [("man_made", ["pier", "breakwater", "quay"])]),
]


def classify_ground(features: DataFrame) -> DataFrame:
    """All ground classes a feature belongs to (a feature can be in several), by the rule table."""
    hits = [F.when((tag("amenity") == "parking") & ~F.coalesce(tag("parking"), F.lit("")).isin("underground", "multi-storey", "rooftop"),
                   F.lit("parking"))]
    for name, pairs in GROUND_RULES:
        hit = None
        for key, values in pairs:
            cond = tag(key).isin(values)
            hit = cond if hit is None else F.coalesce(hit, F.lit(False)) | F.coalesce(cond, F.lit(False))
        if name == "rail":
            hit = hit & fn.first_of(tag("tunnel")).isNull()
        hits.append(F.when(hit, F.lit(name)))
    return features.withColumn("ground", F.explode(F.array_compact(F.array(*hits))))


def classify_water(features: DataFrame) -> DataFrame:
    """Lakes (areas) and rivers (lines with a width); culverts and covered water are out."""
    def among(key: str, *values: str) -> Column:
        return F.coalesce(tag(key).isin(*values), F.lit(False))
    present = lambda key: fn.first_of(tag(key)).isNotNull()
    lake = ((among("natural", "water", "bay", "strait") | tag("water").isNotNull() | among("waterway", "riverbank", "dock", "boatyard")
             | among("landuse", "reservoir", "basin")) & ~present("tunnel") & ~among("covered", "yes") & ~among("natural", "wetland"))
    river = (among("waterway", *cat.WATERWAY_WIDTH) & ~among("tunnel", "culvert", "yes")
             & ~F.coalesce(tag("layer"), F.lit("0")).startswith("-"))
    width = F.coalesce(fn.truthy(fn.parse_measure(tag("width"))), fn.lookup({k: float(v) for k, v in cat.WATERWAY_WIDTH.items()}, tag("waterway")))
    return (features.withColumn("water", F.when(lake, "lake").when(river, "river")).filter("water IS NOT NULL")
            .withColumn("width_m", F.when(F.col("water") == "river", width)))


def classify_walls(features: DataFrame) -> DataFrame:
    barrier, historic = tag("barrier"), tag("historic")
    city = F.coalesce(barrier == "city_wall", F.lit(False)) | F.coalesce(historic.isin("city_wall", "citywalls"), F.lit(False))
    kind = F.when(city, "city_wall").when(barrier.isin("wall", "hedge", "retaining_wall"), barrier)
    size = lambda k: fn.lookup({n: v[k] for n, v in cat.WALL_SIZE.items()}, F.col("wall"))
    return (features.withColumn("wall", kind).filter("wall IS NOT NULL")
            .withColumns({"height_m": F.coalesce(fn.truthy(fn.parse_measure(tag("height"))), size(0)),
                          "width_m": F.coalesce(fn.truthy(fn.parse_measure(tag("width"))), size(1))}))


def classify_landmarks(buildings: DataFrame, large_area: float = 1500.0) -> DataFrame:
    """Named buildings that matter: by kind, by tag, by amenity, or large. Needs `kind` and `area`."""
    name = fn.first_of(tag("name"), tag("name:en"))
    important = F.col("kind").isin(cat.LANDMARK_KINDS) | F.coalesce(tag("amenity").isin(cat.LANDMARK_AMENITIES), F.lit(False))
    for key in cat.LANDMARK_TAGS:
        important = important | tag(key).isNotNull()
    return buildings.withColumn("landmark_name", name).filter(name.isNotNull() & (important | (F.col("area") > large_area)))


def count_categories(elements: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Elements per first matching key of a priority list."""
    choice = None
    for key in keys or cat.CATEGORY_KEYS:
        choice = F.when(tag(key).isNotNull(), key) if choice is None else choice.when(tag(key).isNotNull(), key)
    return elements.groupBy(choice.otherwise("other").alias("category")).agg(F.count("*").alias("n"))


def policy_screen(elements: DataFrame, pattern: str = r"(?i)google|street\s*view|gsv\b", key_prefix: str = "source") -> DataFrame:
    """Tags whose key starts with `source` and whose value matches a forbidden pattern."""
    suspicious = F.map_filter("tags", lambda k, v: k.startswith(key_prefix) & v.rlike(pattern))
    return (elements.withColumn("_hits", suspicious).filter(F.size("_hits") > 0)
            .select("*", F.explode("_hits").alias("bad_key", "bad_value")).drop("_hits"))


def half_open_filter(points: DataFrame, x0: float, y0: float, x1: float, y1: float, x: str = "x", y: str = "y") -> DataFrame:
    return points.filter((F.col(x) >= x0) & (F.col(x) < x1) & (F.col(y) >= y0) & (F.col(y) < y1))
