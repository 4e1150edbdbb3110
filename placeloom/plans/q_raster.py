"""Overlay, terrain and scattering over the feature views."""
from __future__ import annotations

from pyspark.sql import functions as F

from placeloom.functions import catalogs as cat, shapes as sh
from placeloom.functions.scalars import half_up
from placeloom.operators import classify, geometry as geo, joins, raster as ras, windows as win
from placeloom.plans.q_aggregate import FILLED, SLOPE, b, blur_sql, filled, open_sql
from placeloom.plans.q_classify import BUILT, STRATUM
from placeloom.plans.q_derive import KX, KY, h_sql, places
from placeloom.plans.q_joins import IN_AREA, NEAREST, SAMPLE, areas, buildings, d2_sql, poly_dist_sql, roads
from placeloom.plans.registry import query
from placeloom.plans.views import CHUNK, HALF

RES = 1000.0     # overlay resolution of the fixture: 10 m


def cells_sql(x0, y0, x1, y1):
    """Two lateral series of cells over a box, as FROM items (ci, cj)."""
    return (f"LATERAL (SELECT unnest(generate_series(CAST(floor(({x0}) / 1000) AS BIGINT), CAST(floor(({x1}) / 1000) AS BIGINT))) AS ci) gi, "
            f"LATERAL (SELECT unnest(generate_series(CAST(floor(({y0}) / 1000) AS BIGINT), CAST(floor(({y1}) / 1000) AS BIGINT))) AS cj) gj")


X, Y = "(ci + 0.5) * 1000", "(cj + 0.5) * 1000"
AREA_CELLS = f"(SELECT a.place_id, a.a_id, a.class, ci, cj FROM f_areas a, {cells_sql('xmin', 'ymin', 'xmax', 'ymax')} WHERE {IN_AREA.format(x=X, y=Y)})"
# Building cells from the shape itself: the box less its missing quarter or hole, half-open.
BUILDING_CELLS = f"""(SELECT place_id, b_id, ci, cj FROM (SELECT * FROM f_buildings q, {cells_sql('x0', 'y0', 'x0 + w', 'y0 + h')}) z WHERE {X} >= x0 AND {X} < x0 + w AND {Y} >= y0 AND {Y} < y0 + h
  AND NOT (shape = 2 AND {X} >= x0 + (w*2)//4 AND {Y} >= y0 + (h*2)//4) AND NOT (shape = 3 AND {X} >= x0 + w//4 AND {X} < x0 + (w*3)//4 AND {Y} >= y0 + h//4 AND {Y} < y0 + (h*3)//4))"""
STRIP = f"(({X}) - x1) * (x2 - x1) + (({Y}) - y1) * (y2 - y1) BETWEEN 0 AND (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) AND pow((({X}) - x1) * (y2 - y1) - (({Y}) - y1) * (x2 - x1), 2) <= half * half * ((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1))"
ROAD_CELLS = f"""(SELECT DISTINCT place_id, line_id, ci, cj FROM (SELECT place_id, way_id AS line_id, x1, y1, x2, y2, CAST((way_id % 5 + 4) * 100 AS DOUBLE) AS half FROM f_segments) s,
  {cells_sql('least(x1, x2) - half', 'least(y1, y2) - half', 'greatest(x1, x2) + half', 'greatest(y1, y2) + half')} WHERE {STRIP})"""


def area_cells(t, cond="true", res=RES):
    return ras.rasterize_polygons(areas(t, cond), res)


def building_cells(t):
    return ras.rasterize_polygons(buildings(t), RES)


def road_cells(t, res=RES):
    s = t.f_segments.select("place_id", F.col("way_id").alias("line_id"), "x1", "y1", "x2", "y2", ((F.col("way_id") % 5 + 4) * 100).cast("double").alias("half"))
    return ras.rasterize_strips(s, res, F.col("half")).select("place_id", "line_id", "ci", "cj").distinct()


def land_cells(t):
    """Every cell of a place that no water area (class 0 or 1) covers."""
    return ras.place_cells(t.f_places, HALF, RES).join(area_cells(t, "class < 2").select(*ras.CELL).distinct(), ras.CELL, "left_anti")


LAND = f"""(SELECT p.place_id, i.i AS ci, j.i AS cj FROM f_places p CROSS JOIN (SELECT unnest(range(-50, 50)) AS i) i CROSS JOIN (SELECT unnest(range(-50, 50)) AS i) j
  WHERE NOT EXISTS (SELECT 1 FROM {AREA_CELLS} a WHERE a.class < 2 AND a.place_id = p.place_id AND a.ci = i.i AND a.cj = j.i))"""


def big(df, *cols):
    """Cell numbers as 64-bit integers."""
    return df.select(*cols, F.col("ci").cast("bigint").alias("ci"), F.col("cj").cast("bigint").alias("cj"))


@query("rasterize", f"""SELECT 'area' AS src, a_id AS id, ci, cj FROM {AREA_CELLS} a UNION ALL SELECT 'building', b_id, ci, cj FROM {BUILDING_CELLS} b UNION ALL SELECT 'road', line_id, ci, cj FROM {ROAD_CELLS} r""")
def _(t):
    one = lambda df, src, key: big(df.select(F.lit(src).alias("src"), F.col(key).alias("id"), "ci", "cj"), "src", "id")
    return one(area_cells(t), "area", "a_id").unionByName(one(building_cells(t), "building", "b_id")).unionByName(one(road_cells(t), "road", "line_id"))


# Road strata and area classes as ranked layers.
LAYER_OF = {0: "pier", 1: "parking", 2: "rail", 3: "sand", 4: "pitch", 5: "park", 6: "grass", 7: "cemetery", 8: "forest", 9: "field", 10: "dirt", 11: "sidewalk"}
RANKS = {name: k for k, name in enumerate(cat.GROUND_LAYERS)}
LAYER_CASE = "CASE class " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in LAYER_OF.items()) + " END"
RANK_CASE = "CASE layer " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in RANKS.items()) + " END"
NAME_CASE = "CASE r " + " ".join(f"WHEN {v} THEN '{k}'" for k, v in RANKS.items()) + " END"
STRATA = f"(SELECT way_id, {STRATUM} AS stratum, bridge FROM f_ways WHERE {BUILT})"


def ground(t):
    strata = classify.classify_roads(t.way_tags).select(F.col("way_id").alias("line_id"), "stratum", "is_bridge")
    on_road = road_cells(t).join(strata, "line_id")
    named = area_cells(t).withColumn("layer", F.element_at(F.array(*[F.lit(LAYER_OF[k]) for k in range(12)]), (F.col("class") + 1).cast("int")))
    # Decks come with the layer of their road: roads are classified and rasterised once.
    layers = on_road.select(*ras.CELL, F.col("stratum").alias("layer"), F.coalesce("is_bridge", F.lit(False)).alias("on_deck")).unionByName(named.select(*ras.CELL, "layer", F.lit(False).alias("on_deck")))
    return ras.ground_overlay(layers, land_cells(t), None, building_cells(t), cat.DECK_LAYERS, RANKS)


GROUND = f"""(SELECT place_id, ci, cj, coalesce({NAME_CASE}, CASE WHEN land THEN 'ground' END) AS layer FROM (
   SELECT place_id, ci, cj, land, least(CASE WHEN land OR deck THEN rr END, CASE WHEN land THEN orr END) AS r FROM (
    SELECT place_id, ci, cj, min(CASE WHEN layer IN ('asphalt', 'cobble', 'paving', 'path') THEN {RANK_CASE} END) AS rr, min(CASE WHEN layer NOT IN ('asphalt', 'cobble', 'paving', 'path') THEN {RANK_CASE} END) AS orr,
      bool_or(w = 'land') AS land, bool_or(w = 'deck') AS deck, bool_or(w = 'built') AS built FROM (
      SELECT place_id, ci, cj, {LAYER_CASE} AS layer, 'x' AS w FROM {AREA_CELLS} a UNION ALL SELECT place_id, ci, cj, stratum, 'x' FROM {ROAD_CELLS} r JOIN {STRATA} s ON s.way_id = r.line_id
      UNION ALL SELECT place_id, ci, cj, NULL, 'deck' FROM {ROAD_CELLS} r JOIN {STRATA} s ON s.way_id = r.line_id WHERE bridge = 'yes' UNION ALL SELECT place_id, ci, cj, NULL, 'built' FROM {BUILDING_CELLS} b
      UNION ALL SELECT place_id, ci, cj, NULL, 'land' FROM {LAND} l) u GROUP BY 1, 2, 3) v WHERE NOT built) y
   WHERE r IS NOT NULL OR land)"""


@query("ground_overlay", f"SELECT place_id, layer, CAST(count(*) AS BIGINT) AS cells, CAST(sum(ci * 7 + cj * 13) AS BIGINT) AS checksum FROM {GROUND} g GROUP BY 1, 2")
def _(t):
    return ground(t).groupBy("place_id", "layer").agg(F.count("*").alias("cells"), F.sum(F.col("ci") * 7 + F.col("cj") * 13).alias("checksum"))


# Coast: the footways of each place stand for coastline. The resolution is 50 m here: every cell is compared with every
# coast segment in the SQL.
COARSE = 5000.0
ALL_COARSE = "(SELECT place_id, i.i AS ci, j.i AS cj FROM f_places CROSS JOIN (SELECT unnest(range(-10, 10)) AS i) i CROSS JOIN (SELECT unnest(range(-10, 10)) AS i) j)"
COAST = "(SELECT s.*, s.way_id AS line_id FROM f_segments s JOIN f_ways w ON w.way_id = s.way_id WHERE highway = 'footway')"


def coarse(sql):
    return sql.replace("/ 1000)", "/ 5000)").replace("0.5) * 1000", "0.5) * 5000")


LAND_WATER = f"""(SELECT place_id, ci, cj, CASE WHEN (sea OR lake) AND NOT pier THEN CASE WHEN deck THEN 'bridge' WHEN lake THEN 'lake' ELSE 'sea' END ELSE 'land' END AS kind FROM (
  SELECT c.place_id, c.ci, c.cj, coalesce(s.side < 0, false) AS sea, l.ci IS NOT NULL AS lake, p.ci IS NOT NULL AS pier, d.ci IS NOT NULL AS deck FROM {ALL_COARSE} c
  LEFT JOIN (SELECT * FROM (SELECT c.place_id, c.ci, c.cj, (x2 - x1) * ({coarse(Y)} - y1) - (y2 - y1) * ({coarse(X)} - x1) AS side, row_number() OVER (PARTITION BY c.place_id, c.ci, c.cj ORDER BY {d2_sql('(' + coarse(X) + ')', '(' + coarse(Y) + ')')}, line_id, seq) AS rn
     FROM {ALL_COARSE} c JOIN {COAST} g ON g.place_id = c.place_id) n WHERE rn = 1) s ON s.place_id = c.place_id AND s.ci = c.ci AND s.cj = c.cj
  LEFT JOIN (SELECT DISTINCT place_id, ci, cj FROM {coarse(AREA_CELLS)} a WHERE class < 4) l ON l.place_id = c.place_id AND l.ci = c.ci AND l.cj = c.cj LEFT JOIN (SELECT DISTINCT place_id, ci, cj FROM {coarse(AREA_CELLS)} a WHERE class = 7) p ON p.place_id = c.place_id AND p.ci = c.ci AND p.cj = c.cj
  LEFT JOIN (SELECT DISTINCT r.place_id, ci, cj FROM {coarse(ROAD_CELLS)} r JOIN f_ways w ON w.way_id = r.line_id WHERE bridge = 'yes') d ON d.place_id = c.place_id AND d.ci = c.ci AND d.cj = c.cj) q)"""


@query("land_water", f"SELECT place_id, ci, cj, kind FROM {LAND_WATER} w")
def _(t):
    footways = t.f_ways.filter("highway = 'footway'").select("way_id")
    coast = t.f_segments.join(footways, "way_id", "left_semi").select("place_id", F.col("way_id").alias("line_id"), "seq", "x1", "y1", "x2", "y2")
    decks = road_cells(t, COARSE).join(t.f_ways.filter("bridge = 'yes'").select(F.col("way_id").alias("line_id")), "line_id", "left_semi")
    out = ras.land_water(ras.place_cells(t.f_places, HALF, COARSE), coast, area_cells(t, "class < 4", COARSE), area_cells(t, "class = 7", COARSE), decks, COARSE, 4000.0)
    return big(out, "place_id", "kind")


@query("house_yards", f"""SELECT DISTINCT q.place_id, q.ci, q.cj FROM {poly_dist_sql(f"(SELECT place_id, ci, cj, place_id * 1000000 + (ci + 300) * 1000 + cj + 300 AS cid, {X} AS x, {Y} AS y FROM (SELECT DISTINCT place_id, ci, cj FROM f_bstat s, {cells_sql('xmin - 1200', 'ymin - 1200', 'xmax + 1200', 'ymax + 1200')} WHERE b_id % 8 = 1) z)", ['place_id', 'ci', 'cj', 'cid'], where='e.b_id % 8 = 1')} q WHERE inside OR d2 <= 1200 * 1200""")
def _(t):
    houses = joins.with_edges(t.polygons.filter("building = 'house'").select("place_id", "b_id", "rings"))
    # Candidate cells come from the houses themselves.
    near = sh.unnest(houses, sh.cells_of_box(F.col("bx0") - 1200, F.col("by0") - 1200, F.col("bx1") + 1200, F.col("by1") + 1200, RES), "_c")
    cells = near.select("place_id", F.col("_c.ci").alias("ci"), F.col("_c.cj").alias("cj")).distinct()
    return big(ras.house_yards(houses, cells, 1200.0, RES, CHUNK), "place_id")


COLLISION = f"""(SELECT place_id, ci, cj, CASE WHEN b AND NOT p THEN 'building' WHEN w THEN 'city_wall' END AS kind FROM (SELECT place_id, ci, cj, bool_or(k = 'b') AS b, bool_or(k = 'p') AS p, bool_or(k = 'w') AS w FROM (
  SELECT z.place_id, ci, cj, 'b' AS k FROM {BUILDING_CELLS} z JOIN f_buildings fb ON fb.b_id = z.b_id WHERE fb.min_height IS NULL UNION ALL SELECT r.place_id, ci, cj, 'p' FROM {ROAD_CELLS} r JOIN f_ways f ON f.way_id = r.line_id WHERE tunnel = 'building_passage' OR covered = 'yes'
  UNION ALL SELECT r.place_id, ci, cj, 'w' FROM {ROAD_CELLS} r JOIN f_features f ON f.f_id = r.line_id WHERE f.barrier = 'city_wall') u GROUP BY 1, 2, 3) v WHERE (b AND NOT p) OR w)"""


def collision(t):
    ground_standing = building_cells(t).join(t.f_buildings.filter("min_height IS NULL").select("b_id"), "b_id", "left_semi")
    r = road_cells(t)
    passages = r.join(t.f_ways.filter("tunnel = 'building_passage' OR covered = 'yes'").select(F.col("way_id").alias("line_id")), "line_id", "left_semi")
    walls = r.join(t.f_features.filter("barrier = 'city_wall'").select(F.col("f_id").alias("line_id")), "line_id", "left_semi")
    return ras.collision_cells(ground_standing, passages, walls)


@query("collision_cells", f"SELECT place_id, ci, cj, kind FROM {COLLISION} c")
def _(t):
    return big(collision(t), "place_id", "kind")


@query("resolve_overlaps", f"""WITH c AS (SELECT place_id, a_id AS id, class AS rank, ci, cj FROM {AREA_CELLS} a), ok AS (SELECT c.* FROM c WHERE rank < 3 OR EXISTS (SELECT 1 FROM {LAND} l WHERE l.place_id = c.place_id AND l.ci = c.ci AND l.cj = c.cj)),
  k AS (SELECT place_id, arg_min(id, rank * 1000000000 + id) AS id FROM ok GROUP BY place_id, ci, cj) SELECT b.id, CAST(b.n AS BIGINT) AS cells, CAST(coalesce(a.n, 0) AS BIGINT) AS kept, CAST(b.n - coalesce(a.n, 0) AS BIGINT) AS lost
  FROM (SELECT id, count(*) AS n FROM c GROUP BY id) b LEFT JOIN (SELECT id, count(*) AS n FROM k GROUP BY id) a ON a.id = b.id""")
def _(t):
    cells = area_cells(t).select(*ras.CELL, F.col("a_id").alias("id"), F.col("class").alias("rank"))
    return ras.resolve_overlaps(cells, land_cells(t), 3)[1].select("id", "cells", "kept", "lost")


@query("wall_strips", f"""WITH s AS (SELECT r.* FROM {ROAD_CELLS} r JOIN f_features f ON f.f_id = r.line_id WHERE f.barrier IS NOT NULL), k AS (SELECT s.* FROM s WHERE EXISTS (SELECT 1 FROM {LAND} l WHERE l.place_id = s.place_id AND l.ci = s.ci AND l.cj = s.cj) AND NOT EXISTS (SELECT 1 FROM {ROAD_CELLS} g JOIN f_ways w ON w.way_id = g.line_id WHERE w.highway = 'primary' AND g.place_id = s.place_id AND g.ci = s.ci AND g.cj = s.cj)
  AND NOT EXISTS (SELECT 1 FROM {BUILDING_CELLS} z WHERE z.place_id = s.place_id AND z.ci = s.ci AND z.cj = s.cj)) SELECT line_id AS wall_id, ci, cj FROM (SELECT *, count(*) OVER (PARTITION BY line_id) AS n FROM k) q WHERE n >= 4""")
def _(t):
    r = road_cells(t)
    strips = r.join(t.f_features.filter("barrier IS NOT NULL").select(F.col("f_id").alias("line_id")), "line_id", "left_semi").withColumnRenamed("line_id", "wall_id")
    gates = r.join(t.f_ways.filter("highway = 'primary'").select(F.col("way_id").alias("line_id")), "line_id", "left_semi")
    return big(ras.wall_strips(strips, land_cells(t), gates, building_cells(t), 4), "wall_id")


# ---------------------------------------------------------------- terrain
MARGIN = 400.0  # cm round footprints and forests
NODES = "(SELECT *, i * 4500 - 52000 AS x, j * 4500 - 52000 AS y, place_id * 1000 + j * 24 + i AS nid FROM f_raster)"
MASKED = f"""(SELECT place_id, j, i, CASE WHEN z >= 500 AND (nid IN (SELECT nid FROM {poly_dist_sql(NODES, ['nid'])} d WHERE inside OR d2 <= {MARGIN * MARGIN})
    OR EXISTS (SELECT 1 FROM f_areas a WHERE a.place_id = n.place_id AND a.class IN (6, 7, 8) AND pow(greatest(xmin - n.x, n.x - xmax, 0), 2) + pow(greatest(ymin - n.y, n.y - ymax, 0), 2) <= {MARGIN * MARGIN})) THEN NULL ELSE z END AS z FROM {NODES} n)"""
# Relaxation until nothing moves, one list of heights a place; the rows of a place are whole but for its last one.
FILL = f"""m AS MATERIALIZED (SELECT * FROM {MASKED} q), g AS (SELECT place_id, list(z ORDER BY j * 24 + i) AS z0, list(j ORDER BY j * 24 + i) AS js, list(i ORDER BY j * 24 + i) AS ins, avg(z) AS mean FROM m GROUP BY place_id),
  it AS (SELECT place_id, z0, list_transform(z0, lambda v: coalesce(v, mean)) AS z, 0 AS k FROM g UNION ALL SELECT place_id, z0, list_transform(range(1, len(z) + 1), lambda p: CASE WHEN z0[p] IS NOT NULL THEN z0[p]
    ELSE (CASE WHEN p % 24 = 1 THEN z[p] ELSE z[p - 1] END + CASE WHEN p % 24 = 0 THEN z[p] ELSE coalesce(z[p + 1], z[p]) END + CASE WHEN p <= 24 THEN z[p] ELSE z[p - 24] END + coalesce(z[p + 24], z[p])) / 4 END), k + 1 FROM it WHERE k < 1200),
  fl AS MATERIALIZED (SELECT place_id, unnest(js) AS j, unnest(ins) AS i, unnest(it.z) AS z, unnest(g.z0) IS NULL AS hole FROM g JOIN it USING (place_id) WHERE k = 1200)"""


def masked(t):
    """Surface heights without nodes at footprints and forests, and the nodes left out."""
    nodes = t.f_raster.withColumns({"x": F.col("i") * 4500.0 - 52000, "y": F.col("j") * 4500.0 - 52000})
    return ras.terrain_mask(nodes, buildings(t), areas(t, "class IN (6, 7, 8)"), wet(t), MARGIN, CHUNK)


@query("raster_mask_fill", f"WITH RECURSIVE {FILL} SELECT place_id, j, i, hole, {b('z * 10', 'z_e1')} FROM fl")
def _(t):
    cut = t.f_raster.join(masked(t).withColumn("_m", F.lit(True)), ["place_id", "j", "i"], "left")
    out = ras.raster_mask_fill(cut.select("place_id", "j", "i", F.when(F.col("_m").isNull(), F.col("z")).alias("z")))
    return out.select("place_id", "j", "i", "hole", half_up(F.col("z") * 10).alias("z_e1"))


WET = "(SELECT place_id, j, i FROM f_raster WHERE z < 500)"


def wet(t):
    return t.f_raster.filter("z < 500").select("place_id", "j", "i")


def datum(t):
    from placeloom.operators.aggregate import quantiles
    known = t.f_raster.filter("z IS NOT NULL")
    lake = quantiles(known.filter("z < 500"), ["place_id"], "z", {"lake": 0.5}).filter("place_id % 3 <> 1")
    low = quantiles(known, ["place_id"], "z", {"low": 0.01})
    return ras.terrain_datum(known, wet(t), low.join(lake, "place_id", "left"), 1.5, -120.0)


DATUM = f"""(SELECT r.place_id, r.j, r.i, CASE WHEN r.z < 500 THEN 0 ELSE greatest(0, (r.z - CASE WHEN r.place_id % 3 <> 1 THEN q.lake + 120 ELSE q.low END) * 1.5) END AS d FROM f_raster r
  JOIN (SELECT place_id, quantile_cont(z, 0.5) FILTER (z < 500) AS lake, quantile_cont(z, 0.01) AS low FROM f_raster WHERE z IS NOT NULL GROUP BY place_id) q ON q.place_id = r.place_id WHERE r.z IS NOT NULL)"""


@query("terrain_datum", f"SELECT place_id, j, i, {b('d * 100', 'd_e2')} FROM {DATUM} d")
def _(t):
    return datum(t).select("place_id", "j", "i", half_up(F.col("d") * 100).alias("d_e2"))


BODY = "(SELECT f.place_id, a_id AS body, j, i, NOT ({inner}) AS bank, z FROM f_areas a JOIN {f} f ON f.place_id = a.place_id AND i * 4500 - 52000 BETWEEN xmin - 4500 AND xmax + 4500 AND j * 4500 - 52000 BETWEEN ymin - 4500 AND ymax + 4500 WHERE class < 8)".replace(
    "{inner}", "i * 4500 - 52000 BETWEEN xmin AND xmax AND j * 4500 - 52000 BETWEEN ymin AND ymax")


@query("raised_water", f"""WITH c AS (SELECT * FROM {BODY.replace('{f}', FILLED)} c), l AS (SELECT place_id, body, quantile_cont(z, 0.1) AS level FROM c WHERE bank GROUP BY 1, 2 HAVING quantile_cont(z, 0.1) >= 300),
  m AS (SELECT c.place_id, j, i, max(CASE WHEN NOT bank THEN level END) AS lv, max(CASE WHEN bank THEN level + 30 END) AS bk FROM c JOIN l ON l.place_id = c.place_id AND l.body = c.body GROUP BY 1, 2, 3)
  SELECT f.place_id, f.j, f.i, {b('coalesce(lv, greatest(f.z, coalesce(bk, f.z))) * 100', 'd_e2')}, lv IS NOT NULL AS raised FROM {FILLED} f LEFT JOIN m ON m.place_id = f.place_id AND m.j = f.j AND m.i = f.i""")
def _(t):
    grid = filled(t).withColumns({"x": F.col("i") * 4500.0 - 52000, "y": F.col("j") * 4500.0 - 52000})
    body = t.f_areas.filter("class < 8").select("place_id", F.col("a_id").alias("body"), "xmin", "ymin", "xmax", "ymax")
    box = joins.grow([F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")], 4500)
    near = F.col("x").between(F.col("xmin") - 4500, F.col("xmax") + 4500) & F.col("y").between(F.col("ymin") - 4500, F.col("ymax") + 4500)
    inner = F.col("x").between(F.col("xmin"), F.col("xmax")) & F.col("y").between(F.col("ymin"), F.col("ymax"))
    cells = joins.binned_join(grid, body, joins.point_box(), box, CHUNK, near).withColumn("bank", ~inner)
    banks = cells.filter("bank").select("place_id", "body", F.col("z").alias("height"))
    out = ras.raised_water(grid.withColumnRenamed("z", "d").select("place_id", "j", "i", "d"), cells.select("place_id", "body", "j", "i", "bank"), banks, 300.0, 30.0)
    return out.select("place_id", "j", "i", half_up(F.col("d") * 100).alias("d_e2"), "raised")


@query("shore_ease", f"""SELECT f.place_id, f.j, f.i, {b("f.z * least(1, coalesce(min(abs(w.j - f.j) + abs(w.i - f.i)) * 4500 / 20000, 1)) * 100", 'd_e2')} FROM {FILLED} f LEFT JOIN {WET} w ON w.place_id = f.place_id AND abs(w.j - f.j) + abs(w.i - f.i) <= 5 GROUP BY f.place_id, f.j, f.i, f.z""")
def _(t):
    out = ras.shore_ease(filled(t).withColumnRenamed("z", "d"), wet(t), 4500.0, 20000.0)
    return out.select("place_id", "j", "i", half_up(F.col("d") * 100).alias("d_e2"))


@query("outskirts_class", f"SELECT place_id, j, i, CASE WHEN slope < 0.15 AND z < 2000 THEN 'field' ELSE 'forest' END AS kind FROM {SLOPE} s WHERE greatest(abs(i * 4500 - 52000), abs(j * 4500 - 52000)) >= 40000 AND z >= 500")
def _(t):
    s = win.raster_slope(filled(t), 4500.0).withColumns({"x": F.col("i") * 4500.0 - 52000, "y": F.col("j") * 4500.0 - 52000, "d": F.col("z"), "wet": F.col("z") < 500})
    return ras.outskirts_class(s, 40000.0, 0.15, 2000.0).select("place_id", "j", "i", "kind")


@query("terrain_dsm_dtm", f"""WITH RECURSIVE {FILL}, op AS MATERIALIZED (SELECT * FROM {open_sql('fl', 5)} o) SELECT 'dsm' AS kind, place_id, j, i, {b('z * 10', 'z_e1')} FROM {blur_sql('op', 2.0)} s
  UNION ALL SELECT 'dtm', place_id, j, i, {b('z * 10', 'z_e1')} FROM {blur_sql('f_raster', 0.6)} g""")
def _(t):
    mask = masked(t)
    rows = lambda surface: ras.terrain_dsm_dtm(t.f_raster, mask, surface).select(F.lit("dsm" if surface else "dtm").alias("kind"), "place_id", "j", "i", half_up(F.col("z") * 10).alias("z_e1"))
    return rows(True).unionByName(rows(False))


@query("building_base", f"SELECT b_id, {b('(min(height) + 0.55::DOUBLE * (max(height) - min(height))) * 10', 'base_mm')}, {b('min(height) * 10', 'base_min_mm')} FROM {SAMPLE.replace('{points}', '(SELECT * FROM f_bverts WHERE ring = 0)')} s GROUP BY b_id")
def _(t):
    corners = t.polygons.select("place_id", "b_id", F.explode(F.get("rings", F.lit(0))).alias("p")).select("place_id", "b_id", "p.x", "p.y")
    out = ras.building_base(corners, t.f_raster, -52000.0, -52000.0, 4500.0, 24, 25)
    return out.select("b_id", half_up(F.col("base") * 10).alias("base_mm"), half_up(F.col("base_min") * 10).alias("base_min_mm"))


_GRIDPTS = "(SELECT place_id, gi.i AS gi, gj.i AS gj, gi.i * 15000.0 AS x, gj.i * 15000.0 AS y FROM f_places CROSS JOIN (SELECT unnest(range(-3, 4)) AS i) gi CROSS JOIN (SELECT unnest(range(-3, 4)) AS i) gj)"


@query("grid_resample", f"""WITH h AS (SELECT a.place_id, a.gi, a.gj, a.height AS h1, c.height AS h2 FROM {SAMPLE.replace('{points}', _GRIDPTS)} a JOIN {SAMPLE.replace('{points}', _GRIDPTS).replace('f_raster', '(SELECT place_id, j, i, CASE WHEN (j + i) % 9 <> 0 THEN 1000.0 + j * 10 + i END AS z FROM f_raster)')} c ON c.place_id = a.place_id AND c.gi = a.gi AND c.gj = a.gj)
  SELECT place_id, gi, gj, CASE WHEN h1 IS NOT NULL THEN 'primary' WHEN h2 IS NOT NULL THEN 'fallback' ELSE 'lowest' END AS source, {b('coalesce(h1, h2, min(coalesce(h1, h2)) OVER (PARTITION BY place_id)) * 10', 'h_mm')} FROM h""")
def _(t):
    fallback = t.f_raster.select("place_id", "j", "i", F.when((F.col("j") + F.col("i")) % 9 != 0, F.lit(1000.0) + F.col("j") * 10 + F.col("i")).alias("z"))
    out = ras.grid_resample(t.f_places, t.f_raster, fallback, 45000.0, 15000.0, -52000.0, -52000.0, 4500.0, 24, 25)
    return out.select("place_id", F.col("gi").cast("bigint").alias("gi"), F.col("gj").cast("bigint").alias("gj"), "source", half_up(F.col("height") * 10).alias("h_mm"))


# ---------------------------------------------------------------- scattering
_LAT = ("a_id", "li", "lj")


@query("scatter_points", f"""SELECT a_id, li, lj, {b('x', 'x')}, {b('y', 'y')}, tree FROM (SELECT *, (li + 0.12::DOUBLE + 0.76::DOUBLE * {h_sql(*_LAT, "'x'")}) * 1300 AS x, (lj + 0.12::DOUBLE + 0.76::DOUBLE * {h_sql(*_LAT, "'y'")}) * 1300 AS y,
    CASE WHEN {h_sql(*_LAT, "'kind'")} < 0.25 THEN 'conifer' ELSE 'leaf' END AS tree FROM (SELECT *, unnest(generate_series(CAST(floor(xmin / 1300) AS BIGINT), CAST(floor(xmax / 1300) AS BIGINT))) AS li FROM f_areas WHERE class >= 4) a,
    LATERAL (SELECT unnest(generate_series(CAST(floor(ymin / 1300) AS BIGINT), CAST(floor(ymax / 1300) AS BIGINT))) AS lj) g WHERE {h_sql(*_LAT, "'keep'")} < CASE WHEN class < 8 THEN 0.7 ELSE 0.35 END) a WHERE {IN_AREA.format(x='x', y='y')}""")
def _(t):
    p = F.when(F.col("class") < 8, 0.7).otherwise(0.35)
    out = ras.scatter_points(areas(t, "class >= 4"), "a_id", 1300.0, p)
    return out.select("a_id", F.col("li").cast("bigint").alias("li"), F.col("lj").cast("bigint").alias("lj"), half_up(F.col("x")).alias("x"), half_up(F.col("y")).alias("y"),
                      F.when(F.col("pick") < 0.25, "conifer").otherwise("leaf").alias("tree"))


def lamps(t):
    lines = t.lines.select("place_id", "way_id", "pts", F.when(F.col("way_id") % 2 == 0, 1.0).otherwise(-1.0).alias("side"), ((F.col("way_id") % 5 + 4) * 50 + 55).cast("double").alias("off"))
    return ras.points_along(lines, 1200.0, 2800.0, F.col("off"), F.col("side"))


@query("points_along", """WITH m AS (SELECT *, len_sum - len AS s, max(len_sum) OVER (PARTITION BY way_id) AS total FROM (SELECT *, sum(len) OVER (PARTITION BY way_id ORDER BY seq) AS len_sum FROM (SELECT *, sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) AS len FROM f_segments) a) b0),
  p AS (SELECT way_id, n, x1 + (x2 - x1) * ((1200 + n * 2800 - s) / len) - (y2 - y1) / len * off * side AS x, y1 + (y2 - y1) * ((1200 + n * 2800 - s) / len) + (x2 - x1) / len * off * side AS y, row_number() OVER (PARTITION BY way_id, n ORDER BY seq) AS rn
    FROM (SELECT m.*, CASE WHEN way_id % 2 = 0 THEN 1 ELSE -1 END AS side, CAST((way_id % 5 + 4) * 50 + 55 AS DOUBLE) AS off FROM m WHERE total > 1200) m, LATERAL (SELECT unnest(generate_series(0, CAST(floor((total - 1200 - 1e-9) / 2800) AS BIGINT))) AS n) g
    WHERE 1200 + n * 2800 >= s AND 1200 + n * 2800 <= len_sum)
  SELECT way_id, n, CAST(floor(x + 0.5) AS BIGINT) AS x, CAST(floor(y + 0.5) AS BIGINT) AS y FROM p WHERE rn = 1""")
def _(t):
    return lamps(t).select("way_id", "n", half_up(F.col("x")).alias("x"), half_up(F.col("y")).alias("y"))


@query("place_props", f"""WITH n AS (SELECT *, pt_id AS prop_id FROM f_points), fr AS (SELECT n.* FROM n WHERE NOT EXISTS (SELECT 1 FROM {poly_dist_sql('f_points', ['pt_id'])} q WHERE q.pt_id = n.pt_id AND q.inside)),
  onr AS (SELECT DISTINCT fr.place_id, fr.pt_id, fr.x, fr.y FROM fr JOIN f_areas a ON a.place_id = fr.place_id AND a.class < 6 AND {IN_AREA.format(x='fr.x', y='fr.y')}),
  kerb AS (SELECT place_id, a_id, s.seq, CASE s.seq WHEN 0 THEN xmin WHEN 1 THEN xmax WHEN 2 THEN xmax ELSE xmin END AS x1, CASE WHEN s.seq < 2 THEN ymin ELSE ymax END AS y1, CASE s.seq WHEN 0 THEN xmax WHEN 1 THEN xmax WHEN 2 THEN xmin ELSE xmin END AS x2, CASE WHEN s.seq IN (0, 3) THEN ymin ELSE ymax END AS y2 FROM f_areas CROSS JOIN (VALUES (0), (1), (2), (3)) s(seq) WHERE class < 6),
  mv AS (SELECT pt_id, px, py FROM (SELECT o.pt_id, x1 + t * (x2 - x1) AS px, y1 + t * (y2 - y1) AS py, row_number() OVER (PARTITION BY o.pt_id ORDER BY d2, a_id, seq) AS rn, d2 FROM (SELECT o.pt_id, k.*, least(greatest(((o.x - x1) * (x2 - x1) + (o.y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 0), 1) AS t, {d2_sql('o.x', 'o.y')} AS d2 FROM onr o JOIN kerb k ON k.place_id = o.place_id) o) q WHERE rn = 1 AND d2 <= 5000.0 * 5000),
  pt AS (SELECT fr.place_id, fr.pt_id, mv.px IS NOT NULL AS moved, coalesce(mv.px, fr.x) AS x, coalesce(mv.py, fr.y) AS y FROM fr LEFT JOIN mv ON mv.pt_id = fr.pt_id),
  rd AS ({NEAREST.replace('f_points p', 'pt p')}) SELECT pt.pt_id, moved, {b('pt.x', 'x')}, {b('pt.y', 'y')}, rd.line_id FROM pt JOIN rd ON rd.pt_id = pt.pt_id""")
def _(t):
    nodes = t.f_points.select("place_id", F.col("pt_id").alias("prop_id"), "kind", "x", "y")
    kerbs = geo.edges(t.areas.filter("class < 6").select("place_id", F.col("a_id").alias("kerb_id"), "rings")).drop("ring")
    out = ras.place_props(nodes, buildings(t), areas(t, "class < 6"), kerbs, roads(t), 3000.0, 5000.0)
    return out.select(F.col("prop_id").alias("pt_id"), "moved", half_up(F.col("x")).alias("x"), half_up(F.col("y")).alias("y"), "line_id")


@query("edge_markers", f"""WITH e AS (SELECT place_id, k.side, CASE k.side WHEN 0 THEN -{HALF} WHEN 1 THEN {HALF} WHEN 2 THEN {HALF} ELSE -{HALF} END AS x1, CASE k.side WHEN 0 THEN -{HALF} WHEN 1 THEN -{HALF} WHEN 2 THEN {HALF} ELSE {HALF} END AS y1, CASE k.side WHEN 0 THEN 1 WHEN 2 THEN -1 ELSE 0 END AS dx, CASE k.side WHEN 1 THEN 1 WHEN 3 THEN -1 ELSE 0 END AS dy FROM f_places CROSS JOIN (VALUES (0), (1), (2), (3)) k(side)),
  p AS (SELECT place_id, place_id * 4 + side AS edge_id, n, x1 + dx * (200 + n * 630) AS x, y1 + dy * (200 + n * 630) AS y FROM e CROSS JOIN (SELECT unnest(range(0, 159)) AS n) n WHERE 200 + n * 630 < 100000),
  q AS (SELECT place_id, edge_id, n, edge_id * 1000 + n AS mid, x - x / sqrt(x * x + y * y) * 200 AS x, y - y / sqrt(x * x + y * y) * 200 AS y FROM p)
  SELECT edge_id, n, {b('x', 'x')}, {b('y', 'y')} FROM q WHERE mid NOT IN (SELECT mid FROM {poly_dist_sql('q', ['mid'])} d WHERE inside OR d2 <= 100 * 100) AND EXISTS (SELECT 1 FROM f_areas a WHERE a.place_id = q.place_id AND {IN_AREA.format(x='q.x', y='q.y')})""")
def _(t):
    at = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    corners = [(-HALF, -HALF), (HALF, -HALF), (HALF, HALF), (-HALF, HALF)]
    sides = F.array(*[F.struct(F.lit(k).alias("side"), F.array(at(*corners[k]), at(*corners[(k + 1) % 4])).alias("pts")) for k in range(4)])
    e = t.f_places.select("place_id", F.explode(sides).alias("s")).select("place_id", (F.col("place_id") * 4 + F.col("s.side")).alias("edge_id"), "s.pts")
    out = ras.edge_markers(e, buildings(t), areas(t), 630.0, 200.0, 100.0, CHUNK)
    return out.select("edge_id", "n", half_up(F.col("x")).alias("x"), half_up(F.col("y")).alias("y"))


def _yard(word):
    return h_sql("'w' || b_id", f"'{word}'", "k")


@query("garden_features", f"""WITH h AS (SELECT s.*, 'w' || s.b_id AS id FROM f_bstat s WHERE b_id % 8 = 1), tr AS (SELECT place_id, b_id, k, cx + cos({_yard('ga')} * 6.283185307179586::DOUBLE) * r AS x, cy + sin({_yard('ga')} * 6.283185307179586::DOUBLE) * r AS y, CASE WHEN {_yard('gk')} < 0.3 THEN 'conifer' ELSE 'leaf' END AS what FROM (
    SELECT h.*, k, (sqrt(area / 10000) / 2 + 3.5::DOUBLE + {h_sql("'w' || b_id", "'gr'", 'k')} * 4) * 100 AS r FROM h CROSS JOIN (VALUES (0), (1)) v(k)) q WHERE {_yard('gt')} <= 0.55),
  bad AS (SELECT b2.tid FROM {poly_dist_sql('(SELECT *, b_id * 2 + k AS tid FROM tr)', ['tid'])} b2 WHERE inside OR d2 <= 200 * 200)
  SELECT b_id, CAST(-1 AS INTEGER) AS k, CASE WHEN {h_sql('id', "'yard'")} < 0.55 THEN 'hedge' WHEN {h_sql('id', "'yard'")} <= 0.8 THEN 'fence' END AS what, CAST(NULL AS BIGINT) AS x, CAST(NULL AS BIGINT) AS y FROM h
  UNION ALL SELECT b_id, k, what, {b('x', 'x')}, {b('y', 'y')} FROM tr WHERE b_id * 2 + k NOT IN (SELECT tid FROM bad)""")
def _(t):
    h = geo.with_ring_stats(t.polygons.filter("building = 'house'").select("place_id", "b_id", "rings")).select("place_id", "b_id", F.concat(F.lit("w"), F.col("b_id").cast("string")).alias("id"), "cx", "cy", (F.col("area") / 10000).alias("area_m2"))
    yards, trees = ras.garden_features(h, buildings(t).withColumnRenamed("b_id", "o_id"), CHUNK, 200.0)
    none = F.lit(None).cast("bigint")
    return yards.select("b_id", F.lit(-1).alias("k"), F.col("border").alias("what"), none.alias("x"), none.alias("y")).unionByName(
        trees.select("b_id", "k", F.col("tree").alias("what"), half_up(F.col("x")).alias("x"), half_up(F.col("y")).alias("y")))


@query("spatial_labels", f"""SELECT p.pt_id, upper(p.name) AS label, d.district, CASE WHEN p.kind = 'BUILDING' THEN {b('greatest(12, least(60, sqrt(greatest(p.priority, 0) / 3.141592653589793::DOUBLE))) * 100', 'q').replace(' AS q', '')} END AS radius_cm,
    {b('(lat0 + y / 100 / (' + KY + ')) * 1e7', 'lat_e7')}, {b('(lon0 + x / 100 / (' + KX + ')) * 1e7', 'lon_e7')} FROM (SELECT p.*, lat0, lon0, CASE WHEN p.place_id % 2 = 0 THEN 'sphere' ELSE 'wgs84' END AS projection FROM f_points p JOIN f_places USING (place_id)) p
  LEFT JOIN (SELECT p.pt_id, min(a.a_id) AS district FROM f_points p JOIN f_areas a ON a.place_id = p.place_id AND {IN_AREA.format(x='p.x', y='p.y')} GROUP BY p.pt_id) d ON d.pt_id = p.pt_id""")
def _(t):
    marks = t.f_points.select("place_id", F.col("pt_id").alias("label_id"), "name", F.when(F.col("kind") == "BUILDING", "square").otherwise("other").alias("kind"), "x", "y", F.greatest("priority", F.lit(0.0)).alias("area_m2"))
    out = ras.spatial_labels(marks, areas(t).withColumnRenamed("a_id", "district").drop("class"), places(t), CHUNK)
    return out.select(F.col("label_id").alias("pt_id"), "label", "district", half_up(F.col("radius_m") * 100).alias("radius_cm"), half_up(F.col("lat") * 1e7).alias("lat_e7"), half_up(F.col("lon") * 1e7).alias("lon_e7"))


