"""Derived columns over the feature views."""
from __future__ import annotations

from pyspark.sql import functions as F

from placeloom.functions import catalogs as cat, scalars as fn
from placeloom.operators import derive
from placeloom.plans.registry import query
from placeloom.plans.views import HALF

CENTI = "floor({} * 100 + 0.5) / 100"

# lat/lon points: a fraction of a degree round the centre of the place
LATLON = """(SELECT p.place_id, p.pt_id, pl.lat0 + (p.pt_id * 7919 % 1000 - 500) / 100000.0::DOUBLE AS lat,
  pl.lon0 + (p.pt_id * 104729 % 1000 - 500) / 100000.0::DOUBLE AS lon, pl.lat0, pl.lon0,
  CASE WHEN p.place_id % 2 = 0 THEN 'sphere' ELSE 'wgs84' END AS projection FROM f_points p JOIN f_places pl USING (place_id))"""
RAD = "(pi() / 180)"
E2 = "(1 / 298.257223563::DOUBLE * (2 - 1 / 298.257223563::DOUBLE))"
KX = f"""CASE WHEN projection = 'wgs84' THEN {RAD} * 6378137.0::DOUBLE / sqrt(1 - {E2} * pow(sin(radians(lat0)), 2)) * cos(radians(lat0))
  ELSE 111320.0::DOUBLE * cos(radians(lat0)) END"""
KY = f"""CASE WHEN projection = 'wgs84' THEN {RAD} * 6378137.0::DOUBLE * (1 - {E2}) / pow(1 - {E2} * pow(sin(radians(lat0)), 2), 1.5)
  ELSE 111320.0::DOUBLE END"""


def places(t):
    return t.f_places.withColumn("projection", F.when(F.col("place_id") % 2 == 0, "sphere").otherwise("wgs84"))


def latlon(t):
    pts = t.f_points.join(t.f_places.select("place_id", "lat0", "lon0"), "place_id")
    return pts.select("place_id", "pt_id", (F.col("lat0") + (F.col("pt_id") * 7919 % 1000 - 500) / F.lit(100000.0)).alias("lat"),
                      (F.col("lon0") + (F.col("pt_id") * 104729 % 1000 - 500) / F.lit(100000.0)).alias("lon"))


@query("project_local", f"""SELECT place_id, pt_id, CAST(floor((lon - lon0) * ({KX}) * 100 + 0.5) AS BIGINT) AS x_cm,
  CAST(floor((lat - lat0) * ({KY}) * 100 + 0.5) AS BIGINT) AS y_cm FROM {LATLON} q""")
def _(t):
    return derive.project_local(latlon(t), places(t)).select(
        "place_id", "pt_id", fn.half_up(F.col("x_m") * 100).alias("x_cm"), fn.half_up(F.col("y_m") * 100).alias("y_cm"))


@query("unproject_local", f"""SELECT place_id, pt_id, CAST(floor((lat0 + y / 100 / ({KY})) * 1e7 + 0.5) AS BIGINT) AS lat_e7,
  CAST(floor((lon0 + x / 100 / ({KX})) * 1e7 + 0.5) AS BIGINT) AS lon_e7
  FROM (SELECT p.*, lat0, lon0, CASE WHEN p.place_id % 2 = 0 THEN 'sphere' ELSE 'wgs84' END AS projection
        FROM f_points p JOIN f_places USING (place_id)) q""")
def _(t):
    pts = t.f_points.select("place_id", "pt_id", (F.col("x") / 100).alias("x_m"), (F.col("y") / 100).alias("y_m"))
    return derive.unproject_local(pts, places(t)).select(
        "place_id", "pt_id", fn.half_up(F.col("lat") * 1e7).alias("lat_e7"), fn.half_up(F.col("lon") * 1e7).alias("lon_e7"))


def _tm_sql():
    f = cat.GRS80_F
    e2, n = f * (2 - f), f / (2 - f)
    k = 0.9996 * 6378137.0 / (1 + n) * (1 + n * n / 4 + n ** 4 / 64)
    a, b, c, d = e2, (5 * e2 ** 2 - e2 ** 3) / 6, (104 * e2 ** 3 - 45 * e2 ** 4) / 120, 1237 * e2 ** 4 / 1260
    s = [n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180, 13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440,
         61 * n ** 3 / 240 - 103 * n ** 4 / 140, 49561 * n ** 4 / 161280]
    north = " + ".join(f"{v!r}::DOUBLE * sin({2 * i} * xi) * cosh({2 * i} * eta)" for i, v in enumerate(s, 1))
    east = " + ".join(f"{v!r}::DOUBLE * cos({2 * i} * xi) * sinh({2 * i} * eta)" for i, v in enumerate(s, 1))
    return f"""SELECT place_id, pt_id, CAST(floor({k!r}::DOUBLE * (xi + {north}) * 1000 + 0.5) AS BIGINT) AS north_mm,
      CAST(floor(({k!r}::DOUBLE * (eta + {east}) + 500000) * 1000 + 0.5) AS BIGINT) AS east_mm
      FROM (SELECT *, atan(tan(ps) / cos(dl)) AS xi, atanh(cos(ps) * sin(dl)) AS eta
        FROM (SELECT *, phi - s * cos(phi) * ({a!r}::DOUBLE + {b!r}::DOUBLE * s * s + {c!r}::DOUBLE * pow(s, 4) + {d!r}::DOUBLE * pow(s, 6)) AS ps
          FROM (SELECT place_id, pt_id, radians(lat) AS phi, sin(radians(lat)) AS s, radians(lon) - radians(15.0::DOUBLE) AS dl
                FROM {LATLON} q) a) b) c"""


@query("project_tm", _tm_sql())
def _(t):
    return derive.project_tm(latlon(t)).select("place_id", "pt_id", fn.half_up(F.col("north_m") * 1000).alias("north_mm"),
                                               fn.half_up(F.col("east_m") * 1000).alias("east_mm"))


_SIDES = ["south", "north", "west", "east", "fetch_south", "fetch_north", "fetch_west", "fetch_east"]


@query("place_bbox", f"""WITH b AS (SELECT place_id, lat0 - size_m / 2 / ({KY}) AS south, lat0 + size_m / 2 / ({KY}) AS north,
    lon0 - size_m / 2 / ({KX}) AS west, lon0 + size_m / 2 / ({KX}) AS east
    FROM (SELECT *, CASE WHEN place_id % 2 = 0 THEN 'sphere' ELSE 'wgs84' END AS projection FROM f_places) p),
  c AS (SELECT *, south - 80 / 111320.0::DOUBLE AS fetch_south, north + 80 / 111320.0::DOUBLE AS fetch_north,
    west - 80 / (111320.0::DOUBLE * cos(radians((south + north) / 2))) AS fetch_west,
    east + 80 / (111320.0::DOUBLE * cos(radians((south + north) / 2))) AS fetch_east FROM b)
  SELECT place_id, {', '.join(f'CAST(floor({s} * 1e7 + 0.5) AS BIGINT) AS {s}' for s in _SIDES)} FROM c""")
def _(t):
    return derive.place_bbox(places(t)).select("place_id", *[fn.half_up(F.col(s) * 1e7).alias(s) for s in _SIDES])


@query("to_engine_axes", """SELECT pt_id, CAST(floor(x / 100 / 0.28::DOUBLE * 1000 + 0.5) AS BIGINT) AS ex,
  CAST(floor(priority / 0.28::DOUBLE * 1000 + 0.5) AS BIGINT) AS ey, CAST(floor(-y / 100 / 0.28::DOUBLE * 1000 + 0.5) AS BIGINT) AS ez,
  CAST(floor(x + 0.5) AS BIGINT) AS back_x_cm FROM f_points WHERE kind <> 'FURNITURE'""")
def _(t):
    pts = t.f_points.select("pt_id", (F.col("x") / 100).alias("x_m"), (F.col("y") / 100).alias("y_m"),
                            F.when(F.col("kind") == "FURNITURE", F.lit(float("nan"))).otherwise(F.col("priority")).alias("z_m"))
    out = derive.to_engine_axes(pts)
    back = derive.from_engine_axes(out)
    return back.select("pt_id", *[fn.half_up(F.col(c) * 1000).alias(c) for c in ("ex", "ey", "ez")],
                       fn.half_up(F.col("x_m") * 100).alias("back_x_cm"))


MEASURE = r"""(CASE WHEN regexp_extract({0}, '^\s*(-?[0-9]+([.,][0-9]+)?)\s*(ft|'')?', 3) <> '' THEN 0.3048::DOUBLE ELSE 1.0::DOUBLE END
  * TRY_CAST(replace(regexp_extract({0}, '^\s*(-?[0-9]+([.,][0-9]+)?)', 1), ',', '.') AS DOUBLE))"""


@query("normalize_measures", f"SELECT way_id, width, CAST(floor({MEASURE.format('width')} * 1000 + 0.5) AS BIGINT) AS width_mm FROM f_ways")
def _(t):
    return derive.normalize_measures(t.f_ways.select("way_id", "width"), ["width"]).select(
        "way_id", "width", fn.half_up(F.col("width_m") * 1000).alias("width_mm"))


def rgb_sql(text):
    """Three columns r, g, b (thousandths) as one LIST expression over a text column."""
    word = f"replace(lower(trim({text})), ' ', '')"
    named = " ".join(f"WHEN '{k}' THEN [{v[0]}::DOUBLE, {v[1]}::DOUBLE, {v[2]}::DOUBLE]" for k, v in cat.NAMED_COLOURS.items())
    hx = f"ltrim({word}, '#')"
    six = f"CASE WHEN length({hx}) = 3 THEN regexp_replace({hx}, '(.)', '\\1\\1', 'g') ELSE {hx} END"
    chan = ", ".join(f"((strpos('0123456789abcdef', substr({six}, {p}, 1)) - 1) * 16 + strpos('0123456789abcdef', substr({six}, {p + 1}, 1)) - 1) / 255.0::DOUBLE"
                     for p in (1, 3, 5))
    return (f"CASE {word} {named} ELSE CASE WHEN regexp_full_match({word}, '#?([0-9a-f]{{3}}|[0-9a-f]{{6}})') THEN [{chan}] END END")


@query("normalize_colours", f"""SELECT b_id, colour, CAST(floor(rgb[1] * 1000 + 0.5) AS BIGINT) AS r, CAST(floor(rgb[2] * 1000 + 0.5) AS BIGINT) AS g,
  CAST(floor(rgb[3] * 1000 + 0.5) AS BIGINT) AS b FROM (SELECT b_id, colour, {rgb_sql('colour')} AS rgb FROM f_buildings) q""")
def _(t):
    return derive.normalize_colours(t.f_buildings.select("b_id", "colour")).select(
        "b_id", "colour", *[fn.half_up(F.get("rgb", F.lit(k)) * 1000).alias(c) for k, c in enumerate("rgb")])


PALETTE = {k: v for k, v in cat.WALL_PALETTES["plaster"].items()}


@query("nearest_palette", """SELECT vec_id, k AS palette_key FROM (SELECT vec_id, k, row_number() OVER (PARTITION BY vec_id
    ORDER BY pow(v.embedding[1]::DOUBLE - r, 2) + pow(v.embedding[2]::DOUBLE - g, 2) + pow(v.embedding[3]::DOUBLE - b, 2), n) AS rn
  FROM embeddings v CROSS JOIN (VALUES """ + ", ".join(
    f"({n}, '{k}', {v[0]}::DOUBLE, {v[1]}::DOUBLE, {v[2]}::DOUBLE)" for n, (k, v) in enumerate(PALETTE.items())) + ") p(n, k, r, g, b)) q WHERE rn = 1")
def _(t):
    v = t.embeddings.select("vec_id", F.transform(F.slice("embedding", 1, 3), lambda c: c.cast("double")).alias("rgb"))
    return derive.nearest_palette(v, PALETTE).select("vec_id", "palette_key")


def h_sql(*keys):
    joined = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(CAST('0x' || substr(sha1({joined}), 1, 8) AS BIGINT) / 4294967295.0::DOUBLE)"


@query("hash_unit", f"SELECT p_partkey, CAST(floor({h_sql('p_partkey', 'p_brand')} * 1e9 + 0.5) AS BIGINT) AS h FROM part")
def _(t):
    return t.part.select("p_partkey", fn.half_up(fn.hash_unit(F.col("p_partkey"), F.col("p_brand")) * 1e9).alias("h"))


def pick_sql(unit, weights):
    total, run, out = sum(weights.values()), 0.0, []
    for k, w in weights.items():
        run += w
        out.append(f"WHEN {run!r}::DOUBLE >= {unit} * {total!r}::DOUBLE THEN '{k}'")
    return "CASE " + " ".join(out) + f" ELSE '{next(iter(weights))}' END"


@query("weighted_pick", """SELECT p_partkey, k AS choice FROM (SELECT p_partkey, k, row_number() OVER (PARTITION BY p_partkey ORDER BY n) AS rn
  FROM (SELECT p_partkey, """ + h_sql("p_partkey", "'style'") + """ AS u FROM part) p JOIN (SELECT n, k, sum(w) OVER (ORDER BY n) AS run, sum(w) OVER () AS total
    FROM (VALUES """ + ", ".join(f"({n}, '{k}', {w}::DOUBLE)" for n, (k, w) in enumerate(cat.REGION_HOUSE["nordic"].items())) + """) v(n, k, w)) w
  ON w.run >= p.u * w.total) q WHERE rn = 1""")
def _(t):
    unit = fn.hash_unit(F.col("p_partkey"), F.lit("style"))
    return t.part.select("p_partkey", fn.weighted_pick(unit, cat.REGION_HOUSE["nordic"]).alias("choice"))


@query("first_tag", """SELECT b_id, coalesce(nullif(colour, ''), nullif(roof_colour, '')) AS colour,
  CASE WHEN b_id % 30 = 0 THEN 'unknown' WHEN coalesce(nullif(colour, ''), nullif(roof_colour, '')) IS NOT NULL THEN 'osm' ELSE 'none' END AS colour_origin
  FROM (SELECT b_id, CASE WHEN b_id % 30 <> 0 THEN colour END AS colour, CASE WHEN b_id % 30 <> 0 THEN roof_colour END AS roof_colour FROM f_buildings) q""")
def _(t):
    b = t.building_tags.select("b_id", F.when(F.col("b_id") % 30 != 0, F.col("tags")).alias("tags"))
    return derive.first_tag(b.withColumn("tags", F.when(F.col("tags").isNotNull(), F.map_concat(
        F.map_filter("tags", lambda k, v: k != "colour"),
        F.create_map(F.lit("colour"), F.coalesce(fn.tag("building:colour"), F.lit("")))))), ["colour", "roof:colour"], "colour").drop("tags")


@query("parse_feature_ids", """SELECT o_orderkey, fid, CASE WHEN ok THEN CASE substr(fid, 1, 1) WHEN 'w' THEN 'way' WHEN 'r' THEN 'relation' ELSE 'node' END END AS osm_type,
  CASE WHEN ok THEN o_orderkey END AS osm_id, CASE WHEN ok THEN o_orderkey % 5 = 0 END AS remainder,
  CASE WHEN ok AND o_orderkey % 4 = 0 THEN CAST(o_orderkey % 3 AS BIGINT) END AS piece,
  CAST(o_orderkey % 17 - 8 AS INTEGER) AS ci, CAST(o_orderkey % 19 - 9 AS INTEGER) AS cj
  FROM (SELECT o_orderkey, o_orderkey % 7 <> 0 AS ok, CASE o_orderkey % 7 WHEN 0 THEN 'q' WHEN 1 THEN 'n' WHEN 2 THEN 'r' ELSE 'w' END || o_orderkey
    || CASE WHEN o_orderkey % 5 = 0 THEN 'r' ELSE '' END || CASE WHEN o_orderkey % 4 = 0 THEN '#' || (o_orderkey % 3) ELSE '' END AS fid FROM orders) q""")
def _(t):
    k = F.col("o_orderkey")
    ids = t.orders.select("o_orderkey", F.concat(
        F.when(k % 7 == 0, "q").when(k % 7 == 1, "n").when(k % 7 == 2, "r").otherwise("w"), k.cast("string"),
        F.when(k % 5 == 0, "r").otherwise(""), F.when(k % 4 == 0, F.concat(F.lit("#"), (k % 3).cast("string"))).otherwise("")).alias("fid"),
        fn.chunk_name(k % 17 - 8, k % 19 - 9).alias("chunk"))
    ci, cj = fn.chunk_parts(F.col("chunk"))
    return ids.withColumns(fn.feature_id_parts(F.col("fid"))).withColumns({"ci": ci, "cj": cj}).drop("chunk")


@query("content_ids")
def _(t):
    from placeloom.sources.sinks import content_ids
    return content_ids(t.f_areas.select("place_id", "class", "xmin", "ymin", "xmax", "ymax"), "area")


@query("slugs", r"""SELECT doc_id, md5(CASE WHEN slug = '' THEN 'city' ELSE slug END) AS slug_md5, CASE WHEN room = '' THEN 'CITY' ELSE room END AS room
  FROM (SELECT doc_id, trim(regexp_replace(lower(folded), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
          substr(regexp_replace(upper(folded), '[^A-Z0-9-]', '', 'g'), 1, 11) AS room
        FROM (SELECT doc_id, regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g') AS folded FROM documents) a) b""")
def _(t):
    return derive.slugs(t.documents.select("doc_id", "text"), "text").select("doc_id", F.md5(F.col("slug").cast("binary")).alias("slug_md5"), "room")


@query("map_ids", """SELECT p_partkey, list_reduce([2166136261::BIGINT] || list_transform(range(1, length(p_name) + 1), lambda i: unicode(substr(p_name, i, 1))::BIGINT),
    lambda h, c: CAST((CAST(xor(h, c) AS HUGEINT) * 16777619) % 4294967296 AS BIGINT)) AS fnv FROM part""")
def _(t):
    return t.part.select("p_partkey", F.conv(fn.map_code_full(F.col("p_name")), 36, 10).cast("bigint").alias("fnv"))


@query("format_coords", """SELECT pt_id, CAST(floor(abs(lat)) AS BIGINT) || '°' || lpad(CAST(CAST(round_even((abs(lat) - floor(abs(lat))) * 60, 0) AS BIGINT) AS VARCHAR), 2, '0') || '′ N' AS lat_text,
    CAST(floor(abs(lon)) AS BIGINT) || '°' || lpad(CAST(CAST(round_even((abs(lon) - floor(abs(lon))) * 60, 0) AS BIGINT) AS VARCHAR), 2, '0') || '′ E' AS lon_text,
    printf('https://www.openstreetmap.org/?mlat=%.5f&mlon=%.5f#map=16/%.5f/%.5f', lat, lon, lat, lon) AS map_url,
    printf('https://www.google.com/maps/@?api=1&map_action=pano&viewpoint=%.6f,%.6f&heading=%d&pitch=8&fov=80', lat, lon, pt_id * 37 % 360) AS view_url
  FROM (SELECT pt_id, lat, lon FROM """ + LATLON + " q) r")
def _(t):
    pts = latlon(t).withColumn("heading", (F.col("pt_id") * 37 % 360).cast("double"))
    return derive.format_coords(pts).select("pt_id", "lat_text", "lon_text", "map_url", "view_url")


TEMPLATES = {"tagline": "Same streets, new maps.", "intro": "Welcome to {Name}. Start at {Landmark}, then follow {Street}.",
             "title": "{NAME} / MAP", "loading": "Loading {Name}…", "ready": "{Name} is ready"}


@query("fill_templates", """SELECT p.c_custkey AS place_id, t.key AS key, replace(replace(replace(replace(
    CASE WHEN p.c_custkey % 3 = 0 AND t.key = 'tagline' THEN 'All of {Name}' ELSE t.template END, '{Name}', p.c_name), '{NAME}', upper(p.c_name)),
    '{Landmark}', coalesce(CASE WHEN p.c_custkey % 4 <> 0 THEN p.c_mktsegment END, 'the old streets of ' || p.c_name)),
    '{Street}', coalesce(CASE WHEN p.c_custkey % 5 <> 0 THEN 'Street ' || p.c_nationkey END, 'the main street')) AS text
  FROM customer p CROSS JOIN (VALUES """ + ", ".join(f"('{k}', '{v}')" for k, v in TEMPLATES.items()) + ") t(key, template)")
def _(t):
    c = t.customer
    pl = c.select(F.col("c_custkey").alias("place_id"), F.col("c_name").alias("name"),
                  F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("landmark"),
                  F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("Street "), F.col("c_nationkey").cast("string"))).alias("street"))
    over = c.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("place_id"), F.lit("tagline").alias("key"), F.lit("All of {Name}").alias("text"))
    return derive.fill_templates(pl, TEMPLATES, over)


def _re(words):
    return "(?i)(" + "|".join(words) + ")"


def _note_sql():
    cols = []
    for flag, words, without in derive.NOTE_RULES:
        hit = f"regexp_matches(text, '{_re(words)}')"
        cols.append((hit + (f" AND NOT regexp_matches(text, '{_re(without)}')" if without else "")) + f" AS {flag}")
    for name, (choices, default) in derive.NOTE_CHOICES.items():
        cols.append("CASE " + " ".join(f"WHEN regexp_matches(text, '{_re(w)}') THEN '{v}'" for v, w in choices) + f" ELSE '{default}' END AS {name}")
    cols.append(f"CASE lower(regexp_extract(text, '{derive.PANEL_PATTERN}', 1)) " + " ".join(
        f"WHEN '{k}' THEN '{v}'" for k, v in derive.PANEL_COLOURS.items()) + " END AS panels")
    return "SELECT src, id, " + ", ".join(cols) + """ FROM (SELECT 'doc' AS src, doc_id AS id, text FROM documents
      UNION ALL SELECT 'part', p_partkey, p_name || ' panels' FROM part) n"""


@query("note_features", _note_sql())
def _(t):
    notes = t.documents.select(F.lit("doc").alias("src"), F.col("doc_id").alias("id"), F.col("text").alias("note")).unionByName(
        t.part.select(F.lit("part").alias("src"), F.col("p_partkey").alias("id"), F.concat("p_name", F.lit(" panels")).alias("note")))
    return derive.note_features(notes).drop("note")


ROAD_WIDTH = (r"""CASE WHEN highway IN ('primary','secondary','tertiary','residential','service','pedestrian','track') THEN least(greatest(
    CASE WHEN highway = 'service' AND service = 'parking_aisle' THEN 5.0::DOUBLE WHEN highway = 'service' AND service = 'driveway' THEN 3.2::DOUBLE
      WHEN highway = 'service' AND service = 'alley' THEN 3.6::DOUBLE ELSE
      coalesce(nullif(""" + MEASURE.format("width") + """, 0), CAST(lanes AS DOUBLE) * 3.2::DOUBLE + 0.6::DOUBLE, CASE highway WHEN 'primary' THEN 10 WHEN 'secondary' THEN 9
        WHEN 'tertiary' THEN 8 WHEN 'residential' THEN 6.5 WHEN 'service' THEN 4.2 WHEN 'pedestrian' THEN 6 WHEN 'track' THEN 3.5 END::DOUBLE) END,
    2.6::DOUBLE), 22.0::DOUBLE)
  WHEN highway IN ('footway', 'path') THEN least(greatest(coalesce(nullif(""" + MEASURE.format("width") + """, 0),
    CASE highway WHEN 'footway' THEN 2.4 ELSE 2.2 END::DOUBLE), 1.4::DOUBLE), 8.0::DOUBLE) END""")


@query("road_width", f"SELECT way_id, CAST(floor(({ROAD_WIDTH}) * 1000 + 0.5) AS BIGINT) AS width_mm FROM f_ways")
def _(t):
    return derive.road_width(t.way_tags).select("way_id", fn.half_up(F.col("width_m") * 1000).alias("width_mm"))


Z_LAYER = """CAST(CASE WHEN layer IS NOT NULL THEN TRY_CAST(layer AS INTEGER) WHEN bridge IS NOT NULL AND bridge <> 'no' THEN 1
  WHEN tunnel IS NOT NULL AND tunnel NOT IN ('no', 'building_passage') THEN -1 ELSE 0 END AS INTEGER)"""


@query("vertical_level", f"SELECT way_id, {Z_LAYER} AS z_layer, CASE WHEN level NOT IN ('', '0') THEN level END AS z_level FROM f_ways")
def _(t):
    return derive.vertical_level(t.way_tags).select("way_id", "z_layer", "z_level")


@query("ground_level", """SELECT 'way' AS src, way_id AS id, CASE WHEN layer IS NOT NULL AND TRY_CAST(layer AS INTEGER) IS NULL THEN NULL
    ELSE coalesce(CAST(TRY_CAST(layer AS INTEGER) AS INTEGER), 0) = 0 AND list_contains(string_split_regex(coalesce(level, '0'), '[;,]'), '0') END AS at_ground,
    CAST(NULL AS BIGINT) AS min_height_cm, CAST(NULL AS BOOLEAN) AS floating FROM f_ways
  UNION ALL SELECT 'building', b_id, NULL, CAST(CASE WHEN min_height IS NOT NULL THEN 300 WHEN min_level IS NOT NULL THEN 300 ELSE 0 END AS BIGINT),
    min_height IS NOT NULL OR min_level IS NOT NULL FROM f_buildings""")
def _(t):
    ways = derive.at_ground(t.way_tags).select(F.lit("way").alias("src"), F.col("way_id").alias("id"), "at_ground",
                                               F.lit(None).cast("bigint").alias("min_height_cm"), F.lit(None).cast("boolean").alias("floating"))
    b = derive.ground_level(t.building_tags).select(F.lit("building").alias("src"), F.col("b_id").alias("id"), F.lit(None).cast("boolean").alias("at_ground"),
                                                    fn.half_up(F.col("min_height_m") * 100).alias("min_height_cm"), "floating")
    return ways.unionByName(b)


@query("bearings", """SELECT way_id, seq, CAST(floor(b * 1000 + 0.5) AS BIGINT) AS bearing_e3, CAST(floor((b - 360 * floor((b - 90 + 180) / 360) - 90) * 1000 + 0.5) AS BIGINT) AS from_east_e3
  FROM (SELECT way_id, seq, d - 360 * floor(d / 360) AS b FROM (SELECT *, degrees(atan2(x2 - x1, y2 - y1)) AS d FROM f_segments) s) q""")
def _(t):
    b = derive.bearings(t.f_segments)
    return b.select("way_id", "seq", fn.half_up(F.col("bearing") * 1000).alias("bearing_e3"),
                    fn.half_up(fn.angle_between(F.col("bearing"), F.lit(90.0)) * 1000).alias("from_east_e3"))


@query("oldest_source_time", """SELECT room, CASE WHEN bool_and(t IS NOT NULL) THEN strftime(min(t), '%Y-%m-%dT%H:%M:%SZ') END AS oldest_utc
  FROM (SELECT room, CASE WHEN event_id % 1000 <> 7 THEN date_trunc('second', ts) END AS t FROM f_packets) q GROUP BY room""")
def _(t):
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    parts = t.f_packets.select("room", F.when(F.col("event_id") % 2 == 0, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).alias("a"),
                               F.when(F.col("event_id") % 2 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("b"), "event_id")
    known = F.col("event_id") % 1000 != 7
    return derive.oldest_source_time(parts.select("room", F.when(known, F.col("a")).alias("server_date"), F.when(known, F.col("b")).alias("base_time")), ["room"])


@query("recognise_licences", """SELECT doc_id, trim(part) AS part, CASE WHEN contains(part, 'Copernicus DEM GLO-30') THEN 'Copernicus DEM GLO-30' WHEN contains(part, 'Markhöjdmodell © Lantmäteriet') THEN 'Lantmäteriet Markhöjdmodell' END AS data,
    CASE WHEN contains(part, 'Copernicus DEM GLO-30') THEN 'Copernicus DEM licence (free of charge, attribution required)' WHEN contains(part, 'Markhöjdmodell © Lantmäteriet') THEN 'CC-BY-4.0' END AS licence
  FROM (SELECT doc_id, unnest(string_split(source || ' · ' || CASE doc_id % 3 WHEN 0 THEN 'Copernicus DEM GLO-30 (2021)' WHEN 1 THEN 'Markhöjdmodell © Lantmäteriet' ELSE '' END, ' · ')) AS part FROM documents) q
  WHERE trim(part) <> ''""")
def _(t):
    extra = F.when(F.col("doc_id") % 3 == 0, "Copernicus DEM GLO-30 (2021)").when(F.col("doc_id") % 3 == 1, "Markhöjdmodell © Lantmäteriet").otherwise("")
    return derive.recognise_licences(t.documents.select("doc_id", F.concat_ws(" · ", "source", extra).alias("attribution"))).drop("attribution")


@query("sql_functions", f"""SELECT way_id, CAST(floor({h_sql('way_id', "'w'")} * 1e9 + 0.5) AS BIGINT) AS h,
  CAST(floor({MEASURE.format('width')} * 1000 + 0.5) AS BIGINT) AS width_mm, {Z_LAYER} AS z FROM f_ways""")
def _(t):
    from placeloom.functions.sql import register_place_functions
    register_place_functions(t.spark)
    return t.way_tags.selectExpr("way_id", "CAST(floor(place_hash_unit(concat_ws('|', way_id, 'w')) * 1e9 + 0.5) AS BIGINT) AS h",
                                 "CAST(floor(place_parse_measure(tags['width']) * 1000 + 0.5) AS BIGINT) AS width_mm", "place_vertical_level(tags) AS z")


HALF_M = HALF / 100
