"""Aggregations and ordered computations over the feature views."""
from __future__ import annotations

from pyspark.sql import functions as F

from placeloom.functions.scalars import half_up
from placeloom.operators import aggregate as agg, classify, geometry as geo, joins, resolve, windows as win
from placeloom.plans.q_classify import BUILT
from placeloom.plans.q_geometry import BOXES, MEAS, WORLD
from placeloom.plans.q_joins import IN_AREA, areas
from placeloom.plans.q_resolve import ORIGINS, with_origins
from placeloom.plans.registry import query
from placeloom.plans.views import CHUNK, HALF


def b(expr, name):
    return f"CAST(floor({expr} + 0.5) AS BIGINT) AS {name}"


@query("layer_stats", f"""SELECT place_id, class, {b('area', 'area')}, {b('area / total * 1e6', 'share_ppm')}, {b('total - water', 'land')}, {b('water', 'water')} FROM (
  SELECT place_id, class, sum(w) AS area, sum(sum(w)) OVER (PARTITION BY place_id) AS total, sum(CASE WHEN class < 2 THEN sum(w) ELSE 0 END) OVER (PARTITION BY place_id) AS water
  FROM (SELECT place_id, class, (xmax - xmin) * (ymax - ymin) AS w FROM f_areas) q GROUP BY place_id, class) r""")
def _(t):
    layers = geo.with_ring_stats(t.areas.select("place_id", "class", "rings"))
    out = agg.layer_stats(layers, [0, 1])
    return out.select("place_id", "class", half_up(F.col("area")).alias("area"), half_up(F.col("share") * 1e6).alias("share_ppm"), half_up(F.col("land")).alias("land"), half_up(F.col("water")).alias("water"))


# Inside length by clamping the parameter range of each segment.
IN_LEN = f"""greatest(0, least(1, CASE WHEN x1 <> x2 THEN greatest((-{HALF} - x1) / (x2 - x1), ({HALF} - x1) / (x2 - x1)) ELSE 1 END, CASE WHEN y1 <> y2 THEN greatest((-{HALF} - y1) / (y2 - y1), ({HALF} - y1) / (y2 - y1)) ELSE 1 END)
  - greatest(0, CASE WHEN x1 <> x2 THEN least((-{HALF} - x1) / (x2 - x1), ({HALF} - x1) / (x2 - x1)) ELSE 0 END, CASE WHEN y1 <> y2 THEN least((-{HALF} - y1) / (y2 - y1), ({HALF} - y1) / (y2 - y1)) ELSE 0 END)) * len"""
STREETS = f"""(SELECT m.place_id, name, sum({IN_LEN}) AS length FROM {MEAS} m JOIN f_ways w ON w.way_id = m.way_id WHERE highway IN ('primary', 'secondary', 'tertiary', 'residential', 'service', 'track', 'pedestrian')
   AND (x1 <> x2 OR abs(x1) <= {HALF}) AND (y1 <> y2 OR abs(y1) <= {HALF}) GROUP BY m.place_id, name HAVING sum({IN_LEN}) > 0)"""


def street_lengths(t):
    named = t.f_ways.filter("highway IN ('primary', 'secondary', 'tertiary', 'residential', 'service', 'track', 'pedestrian')").select("way_id", "name")
    return agg.street_lengths(t.lines.join(named, "way_id"), WORLD).filter("length > 0")


@query("street_lengths", f"SELECT place_id, name, {b('length * 10', 'length_mm')} FROM {STREETS} s")
def _(t):
    return street_lengths(t).select("place_id", "name", half_up(F.col("length") * 10).alias("length_mm"))


@query("top_streets", f"SELECT place_id, name, CAST(rn AS INTEGER) AS rank_no FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY floor(length * 10 + 0.5) DESC, name) AS rn FROM {STREETS} s) q WHERE rn <= 12")
def _(t):
    from placeloom.operators.scale import top_k
    return top_k(street_lengths(t), ["place_id"], [half_up(F.col("length") * 10).desc(), F.col("name")], 12).select("place_id", "name", "rank_no")


# ---------------------------------------------------------------- chunks
MEMBERS = f"""(SELECT b.place_id, 'building' AS kind, q.b_id AS id, CAST(q.ci AS INTEGER) AS ci, CAST(q.cj AS INTEGER) AS cj FROM ({BOXES}) q JOIN f_buildings b ON b.b_id = q.b_id WHERE area > 0.01 AND ci BETWEEN -9 AND 8 AND cj BETWEEN -9 AND 8
  UNION ALL SELECT place_id, 'road', way_id, CAST(ci AS INTEGER), CAST(cj AS INTEGER) FROM (SELECT DISTINCT place_id, way_id, floor((x1 + x2) / 2 / 6000) AS ci, floor((y1 + y2) / 2 / 6000) AS cj FROM f_segments
     WHERE (x1 + x2) / 2 >= -{HALF} AND (x1 + x2) / 2 < {HALF} AND (y1 + y2) / 2 >= -{HALF} AND (y1 + y2) / 2 < {HALF}) r)"""


def members(t):
    """Chunk membership of buildings and roads. Road steps here never cross a 60 m border between two lattice points."""
    buildings = agg.building_chunks(t.polygons.select("place_id", F.col("b_id").alias("id"), "rings"), CHUNK, WORLD).withColumn("kind", F.lit("building"))
    spans = geo.line_spans(t.lines.select("place_id", "way_id", "pts"), CHUNK, WORLD).select("place_id", F.col("way_id").alias("id"), F.explode("spans").alias("s"))
    roads = spans.select("place_id", "id", F.col("s.ci").alias("ci"), F.col("s.cj").alias("cj"), F.lit("road").alias("kind")).distinct()
    return buildings.unionByName(roads)


GRID = "(SELECT place_id, CAST(i.i AS INTEGER) AS ci, CAST(j.i AS INTEGER) AS cj FROM f_places CROSS JOIN (SELECT unnest(range(-9, 9)) AS i) i CROSS JOIN (SELECT unnest(range(-9, 9)) AS i) j)"


@query("chunk_index", f"""SELECT g.place_id, g.ci, g.cj, kind, page, ids FROM {GRID} g LEFT JOIN (SELECT place_id, kind, ci, cj, CAST((rn - 1) // 4 AS INTEGER) AS page, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids
  FROM (SELECT *, row_number() OVER (PARTITION BY place_id, kind, ci, cj ORDER BY id) AS rn FROM {MEMBERS} m) q GROUP BY place_id, kind, ci, cj, (rn - 1) // 4) p ON p.place_id = g.place_id AND p.ci = g.ci AND p.cj = g.cj""")
def _(t):
    out = agg.chunk_index(members(t), t.f_places, HALF, CHUNK, page=4)
    return out.select("place_id", "ci", "cj", "kind", "page", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@query("chunk_report", f"""WITH m AS (SELECT * FROM {MEMBERS} m), f AS (SELECT place_id, kind, id, count(*) AS n FROM m GROUP BY place_id, kind, id)
  SELECT p.place_id, CAST(324 AS BIGINT) AS chunks, CAST(u.populated AS BIGINT) AS populated, CAST(324 - u.populated AS BIGINT) AS empty, CAST(68 AS BIGINT) AS edge_chunks, c.bo AS buildings_over_borders, c.ro AS roads_over_borders, w.id AS widest_id, w.n AS widest_chunks
  FROM f_places p LEFT JOIN (SELECT place_id, count(*) AS populated FROM (SELECT DISTINCT place_id, ci, cj FROM m) d GROUP BY place_id) u ON u.place_id = p.place_id
  LEFT JOIN (SELECT place_id, CAST(count(*) FILTER (kind = 'building' AND n > 1) AS BIGINT) AS bo, CAST(count(*) FILTER (kind = 'road' AND n > 1) AS BIGINT) AS ro FROM f GROUP BY place_id) c ON c.place_id = p.place_id
  LEFT JOIN (SELECT place_id, id, n FROM (SELECT f.*, row_number() OVER (PARTITION BY f.place_id ORDER BY n DESC, s.area DESC, f.id DESC) AS rn FROM f JOIN f_bstat s ON s.b_id = f.id WHERE kind = 'building') q WHERE rn = 1) w ON w.place_id = p.place_id""")
def _(t):
    measures = geo.with_ring_stats(t.polygons.select("place_id", "b_id", "rings")).select("place_id", F.col("b_id").alias("id"), "area")
    return agg.chunk_report(members(t), measures, t.f_places, HALF, CHUNK).select("place_id", "chunks", "populated", "empty", "edge_chunks", "buildings_over_borders", "roads_over_borders", "widest_id", "widest_chunks")


@query("quadrant_counts", "SELECT place_id, CASE WHEN x >= 0 THEN '+x' ELSE '-x' END || CASE WHEN y >= 0 THEN '+y' ELSE '-y' END AS quadrant, CAST(count(*) AS BIGINT) AS n FROM f_bverts WHERE ring = 0 GROUP BY 1, 2")
def _(t):
    return agg.quadrant_counts(t.polygons.select("place_id", F.explode(F.get("rings", F.lit(0))).alias("p")).select("place_id", "p.x", "p.y"), "x", "y")


@query("origin_counts", f"WITH o AS (SELECT * FROM {ORIGINS} z) SELECT field, origin, CAST(count(*) AS BIGINT) AS n FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS origin FROM o" for f in resolve.ORIGIN_FIELDS) + ") u GROUP BY 1, 2")
def _(t):
    return agg.origin_counts(with_origins(t), resolve.ORIGIN_FIELDS)


# ---------------------------------------------------------------- rasters
def raster(t):
    return t.f_raster.withColumns({"x": F.col("i") * 4500.0 - 52000.0, "y": F.col("j") * 4500.0 - 52000.0, "fallback": F.col("z") % 7 == 0})


RXY = "(SELECT *, i * 4500.0 - 52000.0 AS x, j * 4500.0 - 52000.0 AS y, z % 7 = 0 AS fallback FROM f_raster)"


def _cover_sql(cond):
    return f"CAST(count(*) FILTER ({cond}) AS BIGINT)", f"CAST(count(*) FILTER ({cond} AND z IS NULL) AS BIGINT)", f"CAST(count(*) FILTER ({cond} AND fallback) AS BIGINT)"


_COVER = [(n, *_cover_sql(c)) for n, c in (("", "true"), ("play_", "abs(x) <= 30000 AND abs(y) <= 30000"), ("support_", "abs(x) <= 45000 AND abs(y) <= 45000"))]


@query("raster_coverage", "SELECT place_id, " + ", ".join(f"{a} AS {n}cells, {c} AS {n}no_data, {d} AS {n}fallback" for n, a, c, d in _COVER) + f" FROM {RXY} r GROUP BY place_id")
def _(t):
    return agg.raster_coverage(raster(t), 30000.0, 15000.0)


@query("raster_range", """SELECT place_id, min(z) FILTER (i BETWEEN 0 AND 23 AND j BETWEEN 0 AND 23) AS lowest, max(z) FILTER (i BETWEEN 0 AND 23 AND j BETWEEN 0 AND 23) AS highest,
    max(i) * 4500 - 52000 >= 50000 AND max(j) * 4500 - 52000 >= 50000 AS covers FROM f_raster GROUP BY place_id""")
def _(t):
    return agg.raster_range(raster(t), -52000.0, -52000.0, 4500.0, HALF)


@query("raster_quantiles", """SELECT place_id, CAST(floor(quantile_cont(z, 0.5) * 100 + 0.5) AS BIGINT) AS median, CAST(floor(quantile_cont(z, 0.01) * 100 + 0.5) AS BIGINT) AS p1, CAST(floor(quantile_cont(z, 0.1) * 100 + 0.5) AS BIGINT) AS p10
  FROM f_raster WHERE z IS NOT NULL GROUP BY place_id""")
def _(t):
    out = agg.quantiles(t.f_raster, ["place_id"], "z", {"median": 0.5, "p1": 0.01, "p10": 0.1})
    return out.select("place_id", *[half_up(F.col(c) * 100).alias(c) for c in ("median", "p1", "p10")])


# ---------------------------------------------------------------- statuses
@query("topology_status", """SELECT p.place_id, CAST(coalesce(r.n, 0) AS BIGINT) AS roads, CAST(coalesce(r.k, 0) AS BIGINT) AS with_nodes, CASE WHEN coalesce(r.n, 0) = 0 THEN 'none' WHEN r.k = r.n THEN 'osm_nodes' WHEN r.k = 0 THEN 'positions' ELSE 'mixed' END AS topology
  FROM f_places p LEFT JOIN (SELECT place_id, count(*) AS n, count(*) FILTER (CASE place_id % 4 WHEN 0 THEN true WHEN 1 THEN false ELSE has_nodes END) AS k FROM f_ways GROUP BY place_id) r ON r.place_id = p.place_id""")
def _(t):
    usable = F.when(F.col("place_id") % 4 == 0, True).when(F.col("place_id") % 4 == 1, False).otherwise(F.col("has_nodes"))
    return agg.topology_status(t.f_ways.select("place_id", usable.alias("usable")), t.f_places)


@query("feature_fates", f"""SELECT fate, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN {BUILT} THEN 'kept' WHEN highway = 'construction' THEN 'class not built' WHEN area = 'yes' THEN 'area' WHEN tunnel = 'yes' THEN 'tunnel' ELSE 'unexplained' END AS fate FROM f_ways) q GROUP BY fate""")
def _(t):
    from placeloom.functions.scalars import tag
    reasons = [("class not built", tag("highway") == "construction"), ("area", tag("area") == "yes"), ("tunnel", tag("tunnel") == "yes")]
    fates = agg.feature_fates(t.way_tags, classify.classify_roads(t.way_tags), ["way_id"], reasons)
    return agg.fate_counts(fates, [])


# Positions are in cm; a third of the places has no shift, so that some pass.
FIT_LIMITS = {"max_residual": 2000.0, "mean_offset": 60.0, "rotation": 0.0021, "scale_deviation": 0.0011}


@query("similarity_fit", f"""WITH p AS (SELECT place_id, x, y, x * 1.001::DOUBLE - y * 0.002::DOUBLE + place_id % 3 * 35 AS u, y * 1.001::DOUBLE + x * 0.002::DOUBLE - place_id % 3 * 12 + pt_id % 3 AS v FROM f_points),
  s AS (SELECT place_id, count(*) AS n, sum(x * u + y * v) AS d, sum(x * v - y * u) AS k, sum(x * x + y * y) AS q, avg(u - x) AS ox, avg(v - y) AS oy, max(sqrt((u - x) * (u - x) + (v - y) * (v - y))) AS r,
    avg(sqrt((u - x) * (u - x) + (v - y) * (v - y))) AS m FROM p GROUP BY place_id)
  SELECT place_id, CAST(n AS BIGINT) AS points, {b('atan2(k, d) * 1e7', 'rotation_e7')}, {b('sqrt(d * d + k * k) / q * 1e7', 'scale_e7')}, {b('ox * 100', 'offset_x_e2')}, {b('oy * 100', 'offset_y_e2')}, {b('r * 100', 'max_residual_e2')},
    {b('m * 100', 'mean_residual_e2')}, r <= 2000 AND sqrt(ox * ox + oy * oy) <= 60 AND abs(atan2(k, d)) <= 0.0021 AND abs(sqrt(d * d + k * k) / q - 1) <= 0.0011 AS passed FROM s""")
def _(t):
    shift = F.col("place_id") % 3
    pairs = t.f_points.select("place_id", "x", "y", (F.col("x") * 1.001 - F.col("y") * 0.002 + shift * 35).alias("u"), (F.col("y") * 1.001 + F.col("x") * 0.002 - shift * 12 + F.col("pt_id") % 3).alias("v"))
    out = agg.similarity_fit(pairs, ["place_id"], FIT_LIMITS)
    e2 = lambda c: half_up(F.col(c) * 100).alias(f"{c}_e2")
    return out.select("place_id", "points", half_up(F.col("rotation") * 1e7).alias("rotation_e7"), half_up(F.col("scale") * 1e7).alias("scale_e7"), *[e2(c) for c in ("offset_x", "offset_y", "max_residual", "mean_residual")], "passed")


WEIGHTS = {"junctions": 2.0, "buildings": 1.5, "large": 1.0, "green": 0.5}


@query("site_suitability", f"""WITH f AS (SELECT place_id, 'buildings' AS criterion, cx AS x, cy AS y, 1.0::DOUBLE AS v FROM f_bstat UNION ALL SELECT place_id, 'large', cx, cy, 1.0 FROM f_bstat WHERE area > 2000000
    UNION ALL SELECT place_id, 'junctions', x, y, 1.0 FROM f_points UNION ALL SELECT place_id, 'green', (xmin + xmax) / 2, (ymin + ymax) / 2, (xmax - xmin) * (ymax - ymin) FROM f_areas WHERE class > 5),
  q AS (SELECT place_id, criterion, ci - a AS qi, cj - b AS qj, sum(v) AS v FROM (SELECT f.*, CAST(floor(x / 10000) AS BIGINT) AS ci, CAST(floor(y / 10000) AS BIGINT) AS cj FROM f) g CROSS JOIN (SELECT unnest(range(0, 4)) AS a) a CROSS JOIN (SELECT unnest(range(0, 4)) AS b) b GROUP BY 1, 2, 3, 4),
  s AS (SELECT place_id, qi, qj, sum(v / m * CASE criterion WHEN 'junctions' THEN 2.0 WHEN 'buildings' THEN 1.5 WHEN 'large' THEN 1.0 ELSE 0.5 END::DOUBLE) AS score FROM (SELECT *, max(v) OVER (PARTITION BY place_id, criterion) AS m FROM q) r GROUP BY 1, 2, 3)
  SELECT place_id, qi, qj, CAST(floor(score * 1000 + 0.5) AS BIGINT) AS score_e3, CAST(rn AS INTEGER) AS rank_no FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY floor(score * 1e6 + 0.5) DESC, qi, qj) AS rn FROM s) z WHERE rn <= 3""")
def _(t):
    st = geo.with_ring_stats(t.polygons.select("place_id", "b_id", "rings"))
    ar = geo.with_ring_stats(t.areas.filter("class > 5").select("place_id", "rings"))
    feature = lambda df, name, value: df.select("place_id", F.lit(name).alias("criterion"), F.col("cx").alias("x"), F.col("cy").alias("y"), value.cast("double").alias("value"))
    pts = t.f_points.select("place_id", F.col("x").alias("cx"), F.col("y").alias("cy"))
    f = (feature(st, "buildings", F.lit(1)).unionByName(feature(st.filter("area > 2000000"), "large", F.lit(1))).unionByName(feature(pts, "junctions", F.lit(1)))
         .unionByName(feature(ar, "green", F.col("area"))))
    out = agg.site_suitability(f, WEIGHTS, 10000.0, 4, 3)
    return out.select("place_id", "qi", "qj", half_up(F.col("score") * 1000).alias("score_e3"), "rank_no")


@query("collision_rollup", f"""SELECT a.a_id, CAST(count(s.b_id) AS BIGINT) AS members, {b('coalesce(sum(s.area), 0)', 'member_area')}, {b('greatest(0, any_value((a.xmax - a.xmin) * (a.ymax - a.ymin)) - coalesce(sum(s.area), 0))', 'leftover')},
    greatest(0, any_value((a.xmax - a.xmin) * (a.ymax - a.ymin)) - coalesce(sum(s.area), 0)) > 200000000 AS reported FROM f_areas a LEFT JOIN f_bstat s ON s.place_id = a.place_id AND {IN_AREA.format(x='s.cx', y='s.cy')} GROUP BY a.a_id""")
def _(t):
    v = geo.with_ring_stats(t.polygons.select("place_id", "b_id", "rings")).select("place_id", F.col("b_id").alias("volume_id"), F.col("cx").alias("px"), F.col("cy").alias("py"), "area")
    held = joins.point_in_polygon_join(v, areas(t), CHUNK, x="px", y="py").select("a_id", "volume_id", "area")
    outlines = geo.with_ring_stats(t.areas.select("a_id", "rings")).select("a_id", "area")
    out = agg.collision_rollup(outlines, held, "a_id", 200000000.0)
    return out.select("a_id", "members", half_up(F.col("member_area")).alias("member_area"), half_up(F.col("leftover")).alias("leftover"), "reported")


@query("check_rollup", """SELECT place_id, bool_and(ok) AS passed, coalesce(string_agg(CASE WHEN NOT ok THEN chk END, ',' ORDER BY chk), '') AS failed FROM (
  SELECT o_orderkey // 600 AS place_id, 'check' || o_orderkey % 3 AS chk, bool_and(o_orderkey % 200 <> 7) AS ok FROM orders GROUP BY 1, 2) q GROUP BY place_id""")
def _(t):
    k = F.col("o_orderkey")
    checks = t.orders.select(F.floor(k / 600).alias("place_id"), F.concat(F.lit("check"), (k % 3).cast("string")).alias("check"), (k % 200 != 7).alias("ok"))
    return agg.check_rollup(checks, ["place_id"])


# ---------------------------------------------------------------- ordered along lines
@query("running_arclength", f"SELECT way_id, seq, {b('s * 10', 's0_mm')}, {b('len_sum * 10', 's1_mm')} FROM {MEAS} m")
def _(t):
    out = win.running_arclength(t.f_segments, ["way_id"])
    return out.select("way_id", "seq", half_up(F.col("s0") * 10).alias("s0_mm"), half_up(F.col("s1") * 10).alias("s1_mm"))


JUNCTION_NODES = "(SELECT place_id, node_id FROM f_vertices GROUP BY place_id, node_id HAVING count(DISTINCT way_id) > 1)"
PAIRS = f"""(SELECT place_id, way_id, a, b, length FROM (SELECT v.place_id, v.way_id, v.node_id AS a, lead(v.node_id) OVER w AS b, lead(s) OVER w - s AS length FROM (
    SELECT *, coalesce(sum(d) OVER (PARTITION BY way_id ORDER BY seq), 0) AS s FROM (SELECT *, sqrt(pow(x - lag(x) OVER (PARTITION BY way_id ORDER BY seq), 2) + pow(y - lag(y) OVER (PARTITION BY way_id ORDER BY seq), 2)) AS d FROM f_vertices) q) v
  JOIN {JUNCTION_NODES} j ON j.place_id = v.place_id AND j.node_id = v.node_id WINDOW w AS (PARTITION BY v.way_id ORDER BY v.seq)) p WHERE b IS NOT NULL AND a <> b)"""


def junction_nodes(t):
    return t.f_vertices.groupBy("place_id", "node_id").agg(F.min("way_id").alias("_lo"), F.max("way_id").alias("_hi")).filter("_lo < _hi").drop("_lo", "_hi")


@query("consecutive_pairs", f"SELECT way_id, a, b, {b('length * 10', 'length_mm')} FROM {PAIRS} p")
def _(t):
    return win.consecutive_pairs(t.lines, junction_nodes(t)).select("way_id", "a", "b", half_up(F.col("length") * 10).alias("length_mm"))


@query("merge_spans", f"""WITH p AS (SELECT way_id, seq, floor((x1 + x2) / 2 / 6000) AS ci, floor((y1 + y2) / 2 / 6000) AS cj, s, len_sum FROM {MEAS} m),
  f AS (SELECT *, CASE WHEN lag(ci) OVER w = ci AND lag(cj) OVER w = cj THEN 0 ELSE 1 END AS f FROM p WINDOW w AS (PARTITION BY way_id ORDER BY seq)), r AS (SELECT *, sum(f) OVER (PARTITION BY way_id ORDER BY seq) AS run FROM f)
  SELECT way_id, CAST(run AS BIGINT) AS run, CAST(ci AS BIGINT) AS ci, CAST(cj AS BIGINT) AS cj, {b('min(s) * 10', 's0_mm')}, {b('max(len_sum) * 10', 's1_mm')}, CAST(count(*) AS BIGINT) AS pieces FROM r GROUP BY way_id, run, ci, cj""")
def _(t):
    e = geo.line_edges(t.lines.select("way_id", "pts"))
    pieces = e.select("way_id", "seq", F.floor((F.col("x1") + F.col("x2")) / 2 / 6000).alias("ci"), F.floor((F.col("y1") + F.col("y2")) / 2 / 6000).alias("cj"), F.col("s").alias("s0"), (F.col("s") + F.col("len")).alias("s1"))
    out = win.merge_spans(pieces, ["way_id"], ["ci", "cj"])
    return out.select("way_id", "run", "ci", "cj", half_up(F.col("s0") * 10).alias("s0_mm"), half_up(F.col("s1") * 10).alias("s1_mm"), "pieces")


@query("piece_numbers", "SELECT b_id, CAST(row_number() OVER (PARTITION BY place_id ORDER BY x0, y0, b_id) AS BIGINT) AS piece_no FROM f_buildings")
def _(t):
    return win.piece_numbers(t.f_buildings.select("place_id", "b_id", "x0", "y0"), ["place_id"], ["x0", "y0", "b_id"]).select("b_id", "piece_no")


@query("priority_resolve", """SELECT place_id, ci, cj, CAST(min(rank) AS BIGINT) AS rank, arg_min(a_id, rank * 1000000000 + a_id) AS a_id FROM (
    SELECT a.*, unnest(generate_series(CAST(floor(xmin / 2500) AS BIGINT), CAST(floor(xmax / 2500) AS BIGINT))) AS ci FROM f_areas a) q,
    LATERAL (SELECT unnest(generate_series(CAST(floor(ymin / 2500) AS BIGINT), CAST(floor(ymax / 2500) AS BIGINT))) AS cj) g GROUP BY place_id, ci, cj""")
def _(t):
    from placeloom.functions import shapes as sh
    cells = sh.unnest(t.f_areas, sh.cells_of_box(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"), 2500.0), "c").select("place_id", "rank", "a_id", F.col("c.ci").cast("bigint").alias("ci"), F.col("c.cj").cast("bigint").alias("cj"))
    return win.priority_resolve(cells, ["place_id", "ci", "cj"], "rank", ["a_id"])


@query("longest_per_group", """WITH s AS (SELECT s.place_id, CASE WHEN y1 + y2 >= 0 THEN 'N' ELSE 'S' END || CASE WHEN x1 + x2 >= 0 THEN 'E' ELSE 'W' END AS quadrant, highway AS class, s.way_id AS line_id, seq, sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) AS length
    FROM f_segments s JOIN f_ways w ON w.way_id = s.way_id), c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY place_id, quadrant, class ORDER BY length DESC, line_id, seq) AS rn FROM s) q WHERE rn = 1)
  SELECT place_id, quadrant, class, line_id, seq, CAST(r2 AS INTEGER) AS rank_no FROM (SELECT *, row_number() OVER (PARTITION BY place_id, quadrant ORDER BY length DESC, class) AS r2 FROM c) z WHERE r2 <= 2""")
def _(t):
    s = t.f_segments.join(t.f_ways.select("way_id", F.col("highway").alias("class")), "way_id")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    s = s.select("place_id", F.concat(F.when(F.col("y1") + F.col("y2") >= 0, "N").otherwise("S"), F.when(F.col("x1") + F.col("x2") >= 0, "E").otherwise("W")).alias("quadrant"), "class",
                 F.col("way_id").alias("line_id"), "seq", F.sqrt(dx * dx + dy * dy).alias("length"))
    return win.longest_per_group(s, ["place_id", "quadrant"]).select("place_id", "quadrant", "class", "line_id", "seq", "rank_no")


@query("every_nth", """SELECT place_id, pt_id FROM (SELECT *, greatest(1, n // 6) AS step FROM (SELECT place_id, pt_id, row_number() OVER (PARTITION BY place_id ORDER BY priority, pt_id) - 1 AS rn, count(*) OVER (PARTITION BY place_id) AS n FROM f_points) q) r
  WHERE rn % step = 0 AND rn / step < 6""")
def _(t):
    return win.every_nth(t.f_points.select("place_id", "pt_id", "priority"), ["place_id"], ["priority", "pt_id"]).select("place_id", "pt_id")


# ---------------------------------------------------------------- rasters
def filled(t):
    return t.f_raster.select("place_id", "j", "i", F.coalesce("z", F.lit(1500.0)).alias("z"))


FILLED = "(SELECT place_id, j, i, coalesce(z, 1500.0) AS z FROM f_raster)"


def blur_sql(rel, sigma):
    """Two passes over each column and row as they are in `rel` (a FROM item): past an end its end value, at a hole the cell's own."""
    k = win.kernel(sigma)
    r = len(k) // 2
    w = "(VALUES " + ", ".join(f"({d}, {v!r}::DOUBLE)" for d, v in zip(range(-r, r + 1), k)) + ") w(d, k)"

    def once(rel, along, across):
        return f"""(SELECT a.place_id, a.j, a.i, CASE WHEN count(coalesce(b.z, a.z)) = {len(k)} THEN sum(w.k * coalesce(b.z, a.z)) END AS z FROM {rel} a JOIN (SELECT place_id, {across}, min({along}) AS lo, max({along}) AS hi FROM {rel} x GROUP BY 1, 2) c
          ON c.place_id = a.place_id AND c.{across} = a.{across} CROSS JOIN {w} JOIN {rel} b ON b.place_id = a.place_id AND b.{across} = a.{across} AND b.{along} = least(greatest(a.{along} + w.d, c.lo), c.hi) GROUP BY 1, 2, 3)"""
    return once(once(rel, "j", "i"), "i", "j")


def open_sql(rel, radius):
    """Least, then greatest over the chords of a disk, each chord as far as its row goes."""
    chords = "(VALUES " + ", ".join(f"({d}, {int((radius * radius + 0.5 - d * d) ** 0.5)})" for d in range(-radius, radius + 1)) + ") d(a, w)"

    def once(rel, agg):
        return f"""(SELECT x.place_id, x.j, x.i, {agg}(y.z) AS z FROM {rel} x JOIN (SELECT place_id, i, min(j) AS lo, max(j) AS hi FROM {rel} q GROUP BY 1, 2) c ON c.place_id = x.place_id AND c.i = x.i CROSS JOIN {chords}
          JOIN {rel} y ON y.place_id = x.place_id AND y.j = least(greatest(x.j + d.a, c.lo), c.hi) AND y.i BETWEEN x.i - d.w AND x.i + d.w GROUP BY 1, 2, 3)"""
    return once(once(rel, "min"), "max")


@query("raster_blur", f"SELECT place_id, j, i, {b('z * 1000', 'z_e3')} FROM {blur_sql('f_raster', 2.0)} z")
def _(t):
    return win.raster_blur(t.f_raster, 2.0).select("place_id", "j", "i", half_up(F.col("z") * 1000).alias("z_e3"))


@query("raster_open", f"SELECT place_id, j, i, CAST(z AS BIGINT) AS z FROM {open_sql('f_raster', 5)} z")
def _(t):
    return win.raster_open(t.f_raster, 5).select("place_id", "j", "i", F.col("z").cast("bigint").alias("z"))


SLOPE = f"""(SELECT c.place_id, c.j, c.i, sqrt(pow((coalesce(e.z, c.z) - coalesce(w.z, c.z)) / CASE WHEN e.z IS NULL OR w.z IS NULL THEN 4500 ELSE 9000 END, 2) + pow((coalesce(n.z, c.z) - coalesce(s.z, c.z)) / CASE WHEN n.z IS NULL OR s.z IS NULL THEN 4500 ELSE 9000 END, 2)) AS slope, c.z
  FROM {FILLED} c LEFT JOIN {FILLED} e ON e.place_id = c.place_id AND e.j = c.j AND e.i = c.i + 1 LEFT JOIN {FILLED} w ON w.place_id = c.place_id AND w.j = c.j AND w.i = c.i - 1
  LEFT JOIN {FILLED} n ON n.place_id = c.place_id AND n.i = c.i AND n.j = c.j + 1 LEFT JOIN {FILLED} s ON s.place_id = c.place_id AND s.i = c.i AND s.j = c.j - 1)"""


@query("raster_slope", f"SELECT place_id, j, i, CAST(floor(slope * 1e6 + 0.5) AS BIGINT) AS slope_e6 FROM {SLOPE} s")
def _(t):
    return win.raster_slope(filled(t), 4500.0).select("place_id", "j", "i", half_up(F.col("slope") * 1e6).alias("slope_e6"))


# ---------------------------------------------------------------- packets
TRAVEL = "3 * CAST(json_extract(props, '$.k') AS BIGINT)"


@query("delivery_lateness", f"""WITH p AS (SELECT sender, event_id, ts, {TRAVEL} AS travel FROM f_packets), o AS (SELECT *, min(travel) OVER (PARTITION BY sender ORDER BY ts, event_id) AS offset_ms FROM p),
  l AS (SELECT *, max(travel - offset_ms) OVER (PARTITION BY sender ORDER BY ts, event_id ROWS 39 PRECEDING) AS worst_ms FROM o)
  SELECT event_id, offset_ms, worst_ms, least(greatest(worst_ms + 60, 80), 250) AS delay_ms FROM l""")
def _(t):
    p = t.f_packets.select("sender", "event_id", "ts", (F.get_json_object("props", "$.k").cast("bigint") * 3).alias("travel_ms"))
    return win.delivery_lateness(p, "sender", ["ts", "event_id"]).select("event_id", "offset_ms", "worst_ms", "delay_ms")
