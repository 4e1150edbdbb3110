"""Classification over the feature views."""
from __future__ import annotations

from pyspark.sql import functions as F

from placeloom.functions import scalars as fn
from placeloom.operators import classify
from placeloom.plans.q_derive import MEASURE, ROAD_WIDTH
from placeloom.plans.registry import query

# A download's five groups, as rules over typed columns and tags.
RULES = [
    ("streets", "way", [("highway", None, None)]), ("streets", "way", [("railway", ["rail", "tram", "platform"], None)]),
    ("streets", "way", [("barrier", ["city_wall", "wall", "hedge", "retaining_wall"], None)]),
    ("areas", "way", [("landuse", None, None)]), ("areas", "way", [("leisure", None, None)]), ("areas", "way", [("natural", None, None)]),
    ("areas", "way", [("amenity", ["parking", "grave_yard", "marketplace"], None)]),
    ("relations", "relation", [("natural", None, ["bay", "strait", "sea", "coastline"])]), ("relations", "relation", [("landuse", None, None)]),
    ("points", "node", [("amenity", ["bench", "fountain"], None)]), ("points", "node", [("place", ["square", "village"], None)]),
]


@query("select_by_tags", """SELECT * FROM (SELECT f_id, concat_ws(',',
    CASE WHEN etype = 'way' AND (highway IS NOT NULL OR railway IN ('rail', 'tram', 'platform')
      OR barrier IN ('city_wall', 'wall', 'hedge', 'retaining_wall')) THEN 'streets' END,
    CASE WHEN etype = 'way' AND (landuse IS NOT NULL OR leisure IS NOT NULL OR nature IS NOT NULL OR amenity IN ('parking', 'grave_yard', 'marketplace')) THEN 'areas' END,
    CASE WHEN etype = 'relation' AND ((nature IS NOT NULL AND nature NOT IN ('bay', 'strait', 'sea', 'coastline')) OR landuse IS NOT NULL) THEN 'relations' END,
    CASE WHEN etype = 'node' AND (amenity IN ('bench', 'fountain') OR place IN ('square', 'village')) THEN 'points' END) AS groups
  FROM f_features) q WHERE groups <> ''""")
def _(t):
    return classify.select_by_tags(t.feature_tags, RULES).select("f_id", F.array_join("groups", ",").alias("groups"))


BUILT = """(highway <> 'construction' AND coalesce(area, '') <> 'yes' AND coalesce(tunnel, '') NOT IN ('yes', 'culvert')
  AND NOT (coalesce(layer, '0') LIKE '-%' AND tunnel IS NOT NULL))"""
SOFT = "('gravel', 'dirt', 'ground', 'grass', 'sand', 'unpaved')"
STRATUM = f"""CASE WHEN highway IN ('footway', 'path') THEN CASE WHEN surface IN {SOFT} OR (highway = 'path' AND surface IS NULL) THEN 'path' ELSE 'paving' END
  WHEN highway = 'pedestrian' THEN 'paving' WHEN surface IN ('sett', 'paving_stones') THEN 'cobble'
  WHEN surface IN {SOFT} OR highway = 'track' THEN 'path' ELSE 'asphalt' END"""


@query("classify_roads", f"""SELECT way_id, CASE WHEN highway IN ('footway', 'path') THEN 'soft' ELSE 'car' END AS family, {STRATUM} AS stratum,
  coalesce(tunnel, '') = 'building_passage' OR coalesce(covered, '') = 'yes' AS passage, coalesce(bridge, 'no') <> 'no' AS is_bridge,
  CAST(floor(({ROAD_WIDTH}) * 1000 + 0.5) AS BIGINT) AS width_mm FROM f_ways WHERE {BUILT}""")
def _(t):
    return classify.classify_roads(t.way_tags).select("way_id", "family", "stratum", "passage", "is_bridge", fn.half_up(F.col("width_m") * 1000).alias("width_mm"))


@query("classify_sidewalks", f"""SELECT way_id, side, CAST(190 AS BIGINT) AS sidewalk_cm FROM f_ways w JOIN (VALUES (1), (-1)) s(side)
    ON NOT (sidewalk IS NOT NULL AND ((sidewalk = 'left' AND side = -1) OR (sidewalk = 'right' AND side = 1)))
  WHERE {BUILT} AND highway IN ('primary', 'secondary', 'tertiary', 'residential') AND coalesce(sidewalk, '') NOT IN ('no', 'none', 'separate')""")
def _(t):
    return classify.classify_sidewalks(classify.classify_roads(t.way_tags)).select("way_id", "side", fn.half_up(F.col("sidewalk_m") * 100).alias("sidewalk_cm"))


@query("classify_road_areas", """SELECT f_id, CASE WHEN coalesce(area_highway, highway, 'pedestrian') IN ('residential', 'unclassified', 'service', 'secondary', 'primary', 'tertiary')
    AND surface IS NULL THEN 'asphalt' ELSE 'paving' END AS ground FROM f_features
  WHERE (highway IN ('pedestrian', 'footway', 'service', 'residential', 'unclassified') AND area = 'yes') OR place = 'square' OR area_highway IS NOT NULL OR amenity = 'marketplace'""")
def _(t):
    return classify.classify_road_areas(t.feature_tags).select("f_id", "ground")


@query("classify_buildings", """SELECT b_id, 'outline' AS role, kind, kind IN ('house', 'church') AS is_house, kind IN ('garage') AS is_small, kind = 'church' AS is_church
  FROM (SELECT b_id, CASE WHEN building = 'yes' AND amenity = 'place_of_worship' THEN 'church' ELSE building END AS kind FROM f_buildings
        WHERE building <> 'roof' OR building_part = 'yes') q""")
def _(t):
    return classify.classify_buildings(t.building_tags).select("b_id", "role", "kind", "is_house", "is_small", "is_church")


@query("classify_ground", """SELECT f_id, ground FROM f_features JOIN (VALUES ('parking'), ('platform'), ('rail'), ('sand'), ('pitch'), ('park'), ('grass'), ('cemetery'),
    ('forest'), ('field'), ('dirt'), ('pier')) g(ground) ON CASE ground
      WHEN 'parking' THEN amenity = 'parking' AND coalesce(parking, '') <> 'underground' WHEN 'platform' THEN railway = 'platform'
      WHEN 'rail' THEN railway = 'rail' AND tunnel IS NULL WHEN 'sand' THEN nature = 'beach' OR leisure = 'playground' WHEN 'pitch' THEN leisure = 'pitch'
      WHEN 'park' THEN leisure = 'park' WHEN 'grass' THEN landuse IN ('grass', 'meadow') OR nature = 'scrub' WHEN 'cemetery' THEN landuse = 'cemetery' OR amenity = 'grave_yard'
      WHEN 'forest' THEN landuse = 'forest' OR nature = 'wood' WHEN 'field' THEN landuse = 'farmland' WHEN 'dirt' THEN landuse = 'brownfield' ELSE man_made = 'pier' END""")
def _(t):
    return classify.classify_ground(t.feature_tags).select("f_id", "ground")


@query("classify_water", """SELECT f_id, water, CASE WHEN water = 'river' THEN CASE WHEN width IS NOT NULL THEN 250 ELSE CAST(CASE waterway WHEN 'river' THEN 1400 WHEN 'canal' THEN 900
    WHEN 'stream' THEN 250 WHEN 'ditch' THEN 140 ELSE 120 END AS BIGINT) END END AS width_cm
  FROM (SELECT *, CASE WHEN (nature = 'water' OR waterway = 'riverbank' OR landuse = 'reservoir') AND tunnel IS NULL AND coalesce(nature, '') <> 'wetland' THEN 'lake'
    WHEN waterway IN ('river', 'canal', 'stream', 'ditch', 'drain') AND tunnel IS NULL AND layer IS NULL THEN 'river' END AS water FROM f_features) q WHERE water IS NOT NULL""")
def _(t):
    return classify.classify_water(t.feature_tags).select("f_id", "water", fn.half_up(F.col("width_m") * 100).alias("width_cm"))


@query("classify_walls", """SELECT f_id, wall, CAST(CASE WHEN height IS NOT NULL THEN 300 ELSE CASE wall WHEN 'city_wall' THEN 750 WHEN 'wall' THEN 180 WHEN 'hedge' THEN 140 ELSE 100 END END AS BIGINT) AS height_cm,
    CAST(CASE WHEN width IS NOT NULL THEN 250 ELSE CASE wall WHEN 'city_wall' THEN 220 WHEN 'wall' THEN 40 WHEN 'hedge' THEN 110 ELSE 50 END END AS BIGINT) AS width_cm
  FROM (SELECT *, CASE WHEN barrier = 'city_wall' OR historic = 'citywalls' THEN 'city_wall' WHEN barrier <> 'fence' THEN barrier END AS wall FROM f_features) q WHERE wall IS NOT NULL""")
def _(t):
    return classify.classify_walls(t.feature_tags).select("f_id", "wall", fn.half_up(F.col("height_m") * 100).alias("height_cm"), fn.half_up(F.col("width_m") * 100).alias("width_cm"))


@query("classify_landmarks", """SELECT b.b_id, name AS landmark_name FROM f_buildings b JOIN f_bstat s USING (b_id) WHERE name IS NOT NULL AND name <> ''
  AND (building = 'church' OR amenity IS NOT NULL OR s.area > 2000000)""")
def _(t):
    from placeloom.operators.geometry import with_ring_stats
    b = with_ring_stats(t.building_tags).withColumn("kind", classify.building_kind())
    return classify.classify_landmarks(b, 2000000).select("b_id", "landmark_name")


@query("count_categories", """SELECT category, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN highway IS NOT NULL THEN 'highway' WHEN railway IS NOT NULL THEN 'railway'
    WHEN waterway IS NOT NULL THEN 'waterway' WHEN landuse IS NOT NULL THEN 'landuse' WHEN leisure IS NOT NULL THEN 'leisure' WHEN nature IS NOT NULL THEN 'natural'
    WHEN barrier IS NOT NULL THEN 'barrier' ELSE 'other' END AS category FROM f_features) q GROUP BY category""")
def _(t):
    return classify.count_categories(t.feature_tags)


@query("policy_screen", """SELECT f_id, 'source' AS bad_key, source AS bad_value FROM f_features WHERE regexp_matches(source, '(?i)google|street\\s*view|gsv\\b')
  UNION ALL SELECT f_id, 'source:name', source_name FROM f_features WHERE regexp_matches(source_name, '(?i)google|street\\s*view|gsv\\b')
  UNION ALL SELECT page_id, 'source', url FROM pages WHERE regexp_matches(url, '(?i)google|street\\s*view|gsv\\b')
  UNION ALL SELECT doc_id, 'source:text', md5(text) FROM documents WHERE regexp_matches(text, '(?i)google|street\\s*view|gsv\\b')""")
def _(t):
    pages = t.pages.select(F.col("page_id").alias("f_id"), F.create_map(F.lit("source"), F.col("url")).alias("tags"))
    docs = t.documents.select(F.col("doc_id").alias("f_id"), F.create_map(F.lit("source:text"), F.col("text")).alias("tags"))
    hits = classify.policy_screen(t.feature_tags.select("f_id", "tags").unionByName(pages).unionByName(docs))
    return hits.select("f_id", "bad_key", F.when(F.col("bad_key") == "source:text", F.md5(F.col("bad_value").cast("binary"))).otherwise(F.col("bad_value")).alias("bad_value"))


@query("half_open_filter", "SELECT pt_id FROM f_points WHERE x >= -12000 AND x < 30000 AND y >= -50000 AND y < 0")
def _(t):
    return classify.half_open_filter(t.f_points, -12000.0, -50000.0, 30000.0, 0.0).select("pt_id")
