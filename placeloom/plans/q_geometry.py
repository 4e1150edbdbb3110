"""Geometry over the feature views."""
from __future__ import annotations

from pyspark.sql import functions as F

from placeloom.functions import shapes as sh
from placeloom.functions.scalars import half_up
from placeloom.operators import geometry as geo, joins, rings
from placeloom.plans.registry import query
from placeloom.plans.views import CHUNK, HALF

WORLD = (-HALF, -HALF, HALF, HALF)


def ints(*cols):
    return [half_up(F.col(c)).alias(c) for c in cols]


def i_sql(*cols):
    return ", ".join(f"CAST(floor({c} + 0.5) AS BIGINT) AS {c}" for c in cols)


@query("edges", f"SELECT b_id, CAST(ring AS INTEGER) AS ring, CAST(seq AS INTEGER) AS seq, {i_sql('x1', 'y1', 'x2', 'y2')} FROM f_bedges WHERE sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) >= 500")
def _(t):
    return geo.edges(t.polygons.select("b_id", "rings"), min_length=500.0).select("b_id", "ring", "seq", *ints("x1", "y1", "x2", "y2"))


@query("ring_area", f"SELECT b_id, {i_sql('area', 'xmin', 'ymin', 'xmax', 'ymax')} FROM f_bstat")
def _(t):
    return geo.with_ring_stats(t.polygons.select("b_id", "rings")).select("b_id", *ints("area", "xmin", "ymin", "xmax", "ymax"))


@query("ring_centroid", "SELECT b_id, CAST(floor(cx * 10 + 0.25) AS BIGINT) AS cx, CAST(floor(cy * 10 + 0.25) AS BIGINT) AS cy FROM f_bstat")
def _(t):
    return geo.with_ring_stats(t.polygons.select("b_id", "rings")).select("b_id", *[F.floor(F.col(c) * 10 + 0.25).cast("bigint").alias(c) for c in ("cx", "cy")])


@query("orient_rings", """SELECT b_id, CAST(ring AS INTEGER) AS ring, string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR) || ' ' || CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY seq) AS pts
  FROM f_bverts GROUP BY b_id, ring""")
def _(t):
    # Every other building arrives the wrong way round.
    flip = lambda r: F.concat(F.slice(r, 1, 1), F.reverse(sh.tail(r)))
    p = t.polygons.select("b_id", F.when(F.col("b_id") % 2 == 0, F.transform("rings", flip)).otherwise(F.col("rings")).alias("rings"))
    out = geo.orient_rings(p).select("b_id", F.posexplode("rings").alias("ring", "r"))
    text = F.transform("r", lambda v: F.concat_ws(" ", v["x"].cast("bigint"), v["y"].cast("bigint")))
    return out.select("b_id", "ring", F.array_join(text, ",").alias("pts"))


@query("validate_rings", """SELECT b_id, CASE b_id % 10 WHEN 0 THEN 'closing_repeat' WHEN 1 THEN 'self_intersection' WHEN 2 THEN 'too_few_points' WHEN 3 THEN 'no_area' WHEN 4 THEN 'not_finite' END AS fault FROM f_buildings""")
def _(t):
    q = F.col("b_id") % 10
    at = lambda ux, uy: F.struct((F.col("x0") + F.floor(F.col("w") * ux / 4)).alias("x"), (F.col("y0") + F.floor(F.col("h") * uy / 4)).alias("y"))
    outer = F.get("rings", F.lit(0))
    bad = (F.when(q == 0, F.array(F.concat(outer, F.slice(outer, 1, 1)))).when(q == 1, F.array(F.array(at(0, 0), at(4, 0), at(1, 4), at(4, 2))))
           .when(q == 2, F.array(F.array(at(0, 0), at(4, 0), at(0, 0), at(4, 0)))).when(q == 3, F.array(F.array(at(0, 0), at(2, 0), at(4, 0))))
           .when(q == 4, F.array(F.array(at(0, 0), at(4, 0), F.struct(F.lit(float("nan")).alias("x"), F.lit(0.0).alias("y")))))
           .otherwise(F.col("rings")))
    return geo.validate_rings(t.polygons.select("b_id", bad.alias("rings")), ["b_id"])


# Exact overlap of the axis-parallel shapes with grid cells: the box less its missing quarter or its hole.
OVER = "greatest(0, least({b1}, ({c} + 1) * 6000) - greatest({b0}, {c} * 6000))"
BOXES = """SELECT b_id, shape, x0, y0, w, h, ci, cj,
  {full_x} * {full_y} - CASE WHEN shape >= 2 THEN {sub_x} * {sub_y} ELSE 0 END AS area
  FROM (SELECT *, CASE WHEN shape = 2 THEN x0 + (w*2)//4 ELSE x0 + w//4 END AS sx0, CASE WHEN shape = 2 THEN x0 + w ELSE x0 + (w*3)//4 END AS sx1,
          CASE WHEN shape = 2 THEN y0 + (h*2)//4 ELSE y0 + h//4 END AS sy0, CASE WHEN shape = 2 THEN y0 + h ELSE y0 + (h*3)//4 END AS sy1,
          unnest(generate_series(CAST(floor(x0/6000) AS BIGINT), CAST(floor((x0+w)/6000) AS BIGINT))) AS ci FROM f_buildings) a,
       LATERAL (SELECT unnest(generate_series(CAST(floor(y0/6000) AS BIGINT), CAST(floor((y0+h)/6000) AS BIGINT))) AS cj) b""".format(
    full_x=OVER.format(b0="x0", b1="x0 + w", c="ci"), full_y=OVER.format(b0="y0", b1="y0 + h", c="cj"),
    sub_x=OVER.format(b0="sx0", b1="sx1", c="ci"), sub_y=OVER.format(b0="sy0", b1="sy1", c="cj"))


@query("cell_overlap_area", f"SELECT b_id, CAST(ci AS INTEGER) AS ci, CAST(cj AS INTEGER) AS cj, {i_sql('area')} FROM ({BOXES}) q")
def _(t):
    out = geo.cell_overlap_area(t.polygons.select("b_id", "rings"), CHUNK).select("b_id", F.explode("cells").alias("c"))
    return out.select("b_id", "c.ci", "c.cj", half_up(F.col("c.area")).alias("area"))


@query("polygon_chunks", f"""SELECT b_id, string_agg('c' || CAST(ci AS INTEGER) || '_' || CAST(cj AS INTEGER), ',' ORDER BY ci, cj) AS chunks FROM ({BOXES}) q
  WHERE area > 0.01 AND ci BETWEEN -9 AND 8 AND cj BETWEEN -9 AND 8 GROUP BY b_id""")
def _(t):
    out = geo.polygon_chunks(t.polygons.select("b_id", "rings"), CHUNK, 0.01, WORLD)
    names = F.transform("cells", lambda c: F.concat(F.lit("c"), c["ci"].cast("string"), F.lit("_"), c["cj"].cast("string")))
    return out.filter(F.size("cells") > 0).select("b_id", F.array_join(names, ",").alias("chunks"))


@query("owner_chunk", f"""SELECT b_id, CAST(ci AS INTEGER) AS chunk_i, CAST(cj AS INTEGER) AS chunk_j FROM (
    SELECT q.b_id, ci, cj, row_number() OVER (PARTITION BY q.b_id ORDER BY CASE WHEN ci = floor(s.cx / 6000) AND cj = floor(s.cy / 6000) THEN 0 ELSE 1 END, -floor(q.area + 0.5), ci, cj) AS rn
    FROM ({BOXES}) q JOIN f_bstat s ON q.b_id = s.b_id WHERE q.area > 0.01) r WHERE rn = 1""")
def _(t):
    return geo.owner_chunk(t.polygons.select("b_id", "rings"), CHUNK, 0.01, WORLD).select("b_id", "chunk_i", "chunk_j")


@query("clip_polygons", f"SELECT b_id, CAST(ci AS INTEGER) AS ci, CAST(cj AS INTEGER) AS cj, {i_sql('area')} FROM ({BOXES}) q WHERE area > 0.01")
def _(t):
    out = geo.clip_polygons(t.polygons.select("b_id", "rings"), CHUNK)
    return out.select("b_id", "ci", "cj", half_up(sh.signed_area(sh.polygon_edges(F.col("rings")))).alias("area")).filter("area > 0")


# ---------------------------------------------------------------- lines
MEAS = """(SELECT *, len_sum - len AS s FROM (SELECT *, sum(len) OVER (PARTITION BY way_id ORDER BY seq) AS len_sum
   FROM (SELECT *, sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) AS len FROM f_segments) a) b)"""

@query("line_length", f"SELECT v.way_id, CAST(floor(coalesce(l.len, 0) * 10 + 0.5) AS BIGINT) AS length_mm FROM (SELECT DISTINCT way_id FROM f_vertices) v LEFT JOIN (SELECT way_id, sum(len) AS len FROM {MEAS} m GROUP BY way_id) l ON l.way_id = v.way_id")
def _(t):
    return t.lines.select("way_id", sh.line_length(F.col("pts")).alias("l")).select("way_id", half_up(F.col("l") * 10).alias("length_mm"))


@query("interpolate_along", f"""SELECT way_id, CAST(floor(x + 0.5) AS BIGINT) AS at_x, CAST(floor(y + 0.5) AS BIGINT) AS at_y FROM (
  SELECT way_id, x1 + (x2 - x1) * ((d - s) / len) AS x, y1 + (y2 - y1) * ((d - s) / len) AS y, row_number() OVER (PARTITION BY way_id ORDER BY seq) AS rn
  FROM (SELECT m.*, CAST(way_id % 7 * 333 AS DOUBLE) AS d FROM {MEAS} m) q WHERE d >= s AND d <= s + len) r WHERE rn = 1""")
def _(t):
    d = (F.col("way_id") % 7 * 333).cast("double")
    lines = t.lines.filter(sh.line_length(F.col("pts")) >= d)
    return geo.interpolate_along(lines, d).select("way_id", *ints("at_x", "at_y"))


@query("locate_along", f"""SELECT way_id, CAST(floor(s * 10 + 0.5) AS BIGINT) AS s_mm, CAST(floor(sqrt(d2) * 10 + 0.5) AS BIGINT) AS d_mm FROM (
  SELECT way_id, d2, s + t * len AS s, row_number() OVER (PARTITION BY way_id ORDER BY d2, s + t * len) AS rn FROM (
    SELECT *, (x1 + t * (x2 - x1) - 700) * (x1 + t * (x2 - x1) - 700) + (y1 + t * (y2 - y1) - 300) * (y1 + t * (y2 - y1) - 300) AS d2 FROM (
      SELECT *, least(greatest(((700 - x1) * (x2 - x1) + (300 - y1) * (y2 - y1)) / (len * len), 0), 1) AS t FROM {MEAS} m) a) b) c WHERE rn = 1""")
def _(t):
    rows = t.lines.filter(sh.line_length(F.col("pts")) > 0).withColumns({"qx": F.lit(700.0), "qy": F.lit(300.0)})
    return geo.locate_along(rows, "qx", "qy").select("way_id", half_up(F.col("located_s") * 10).alias("s_mm"), half_up(F.sqrt("located_d2") * 10).alias("d_mm"))


@query("cut_lines", f"""SELECT way_id, CAST(count(*) AS BIGINT) AS edges, CAST(floor(sum(least(total - 350, s + len) - greatest(700, s)) * 10 + 0.5) AS BIGINT) AS length_mm,
    CAST(floor(arg_min(x1 + (x2 - x1) * greatest(0, (700 - s) / len), seq) + 0.5) AS BIGINT) AS first_x, CAST(floor(arg_max(y1 + (y2 - y1) * least(1, (total - 350 - s) / len), seq) + 0.5) AS BIGINT) AS last_y
  FROM (SELECT *, max(len_sum) OVER (PARTITION BY way_id) AS total FROM {MEAS} m) q WHERE greatest(700, s) < least(total - 350, s + len) GROUP BY way_id""")
def _(t):
    lines = t.lines.withColumn("total", sh.line_length(F.col("pts"))).filter("total > 1050")
    out = geo.cut_lines(lines, F.lit(700.0), F.col("total") - 350)
    return out.select("way_id", (F.size("cut") - 1).cast("bigint").alias("edges"), half_up(sh.line_length(F.col("cut")) * 10).alias("length_mm"),
                      half_up(F.get("cut", F.lit(0))["x"]).alias("first_x"), half_up(F.element_at("cut", -1)["y"]).alias("last_y"))


SPAN_CELL = 2700.0
SPANS = f"""WITH m AS (SELECT * FROM {MEAS} m),
  cuts AS (SELECT way_id, seq, t FROM (
      SELECT way_id, seq, 0.0::DOUBLE AS t FROM m UNION ALL SELECT way_id, seq, 1.0::DOUBLE FROM m
      UNION ALL SELECT way_id, seq, (k * 2700.0::DOUBLE - x1) / (x2 - x1) FROM m, LATERAL (SELECT unnest(generate_series(CAST(floor(least(x1, x2) / 2700) AS BIGINT), CAST(floor(greatest(x1, x2) / 2700) + 1 AS BIGINT))) AS k) g WHERE x1 <> x2
      UNION ALL SELECT way_id, seq, (k * 2700.0::DOUBLE - y1) / (y2 - y1) FROM m, LATERAL (SELECT unnest(generate_series(CAST(floor(least(y1, y2) / 2700) AS BIGINT), CAST(floor(greatest(y1, y2) / 2700) + 1 AS BIGINT))) AS k) g WHERE y1 <> y2
      UNION ALL SELECT way_id, seq, (b - x1) / (x2 - x1) FROM m, (VALUES (-50000.0::DOUBLE), (50000.0::DOUBLE)) v(b) WHERE x1 <> x2
      UNION ALL SELECT way_id, seq, (b - y1) / (y2 - y1) FROM m, (VALUES (-50000.0::DOUBLE), (50000.0::DOUBLE)) v(b) WHERE y1 <> y2) c WHERE t >= 0 AND t <= 1),
  thin AS (SELECT way_id, seq, t FROM (SELECT *, lag(t) OVER (PARTITION BY way_id, seq ORDER BY t) AS p FROM (SELECT DISTINCT way_id, seq, t FROM cuts) d) e WHERE p IS NULL OR t - p >= 1e-12),
  parts AS (SELECT c.way_id, c.seq, c.t AS ta, c.tb, m.s + c.t * m.len AS s0, m.s + c.tb * m.len AS s1, x1 + (x2 - x1) * (c.t + c.tb) / 2 AS mx, y1 + (y2 - y1) * (c.t + c.tb) / 2 AS my
    FROM (SELECT *, lead(t) OVER (PARTITION BY way_id, seq ORDER BY t) AS tb FROM thin) c JOIN m ON m.way_id = c.way_id AND m.seq = c.seq WHERE tb IS NOT NULL),
  cells AS (SELECT *, floor(mx / 2700) AS ci, floor(my / 2700) AS cj FROM parts WHERE mx >= -50000 AND mx < 50000 AND my >= -50000 AND my < 50000),
  flags AS (SELECT *, CASE WHEN lag(ci) OVER w = ci AND lag(cj) OVER w = cj AND abs(lag(s1) OVER w - s0) < 1e-6 THEN 0 ELSE 1 END AS f FROM cells WINDOW w AS (PARTITION BY way_id ORDER BY seq, ta)),
  runs AS (SELECT *, sum(f) OVER (PARTITION BY way_id ORDER BY seq, ta) AS run FROM flags),
  spans AS (SELECT way_id, CAST(run - 1 AS INTEGER) AS span_no, CAST(min(ci) AS INTEGER) AS ci, CAST(min(cj) AS INTEGER) AS cj, min(s0) AS s0, max(s1) AS s1 FROM runs GROUP BY way_id, run)"""


def spans(t):
    return geo.line_spans(t.lines.select("place_id", "way_id", "pts"), SPAN_CELL, WORLD)


@query("line_spans", SPANS + " SELECT way_id, span_no, ci, cj, CAST(floor(s0 * 10 + 0.5) AS BIGINT) AS s0_mm, CAST(floor(s1 * 10 + 0.5) AS BIGINT) AS s1_mm FROM spans")
def _(t):
    return spans(t).select("way_id", F.posexplode("spans").alias("span_no", "p")).select(
        "way_id", "span_no", "p.ci", "p.cj", half_up(F.col("p.s0") * 10).alias("s0_mm"), half_up(F.col("p.s1") * 10).alias("s1_mm"))


CLIP = 49600.0


CLIPPED = f"""WITH m AS (SELECT * FROM {MEAS} m),
  lb AS (SELECT *, greatest(0, CASE WHEN x1 <> x2 THEN least((-{CLIP} - x1) / (x2 - x1), ({CLIP} - x1) / (x2 - x1)) ELSE 0 END, CASE WHEN y1 <> y2 THEN least((-{CLIP} - y1) / (y2 - y1), ({CLIP} - y1) / (y2 - y1)) ELSE 0 END) AS a,
      least(1, CASE WHEN x1 <> x2 THEN greatest((-{CLIP} - x1) / (x2 - x1), ({CLIP} - x1) / (x2 - x1)) ELSE 1 END, CASE WHEN y1 <> y2 THEN greatest((-{CLIP} - y1) / (y2 - y1), ({CLIP} - y1) / (y2 - y1)) ELSE 1 END) AS b
    FROM m WHERE (x1 <> x2 OR abs(x1) <= {CLIP}) AND (y1 <> y2 OR abs(y1) <= {CLIP})),
  kept AS (SELECT *, (b - a) * len AS l FROM lb WHERE a < b),
  flags AS (SELECT *, CASE WHEN lag(b) OVER w = 1 AND a = 0 AND lag(x2) OVER w = x1 AND lag(y2) OVER w = y1 THEN 0 ELSE 1 END AS f FROM kept WINDOW w AS (PARTITION BY way_id ORDER BY seq)),
  runs AS (SELECT *, sum(f) OVER (PARTITION BY way_id ORDER BY seq) AS run FROM flags)
  SELECT way_id, CAST(run - 1 AS INTEGER) AS part_no, CAST(count(*) + 1 AS INTEGER) AS vertices, CAST(floor(sum(l) * 10 + 0.5) AS BIGINT) AS length_mm FROM runs GROUP BY way_id, run HAVING sum(l) > 100"""


@query("clip_lines", CLIPPED)
def _(t):
    out = geo.clip_lines(t.lines.select("way_id", "pts"), (-CLIP, -CLIP, CLIP, CLIP), 100.0)
    return out.select("way_id", "part_no", F.size("part").alias("vertices"), half_up(F.col("part_len") * 10).alias("length_mm"))


@query("densify", """SELECT way_id, seq, k AS part, CAST(floor((x1 + (x2 - x1) * k / n) * 10 + 0.5) AS BIGINT) AS x1, CAST(floor((y1 + (y2 - y1) * (k + 1) / n) * 10 + 0.5) AS BIGINT) AS y2
  FROM (SELECT *, CAST(greatest(1, ceil(sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) / 400)) AS BIGINT) AS n FROM f_segments) q, LATERAL (SELECT unnest(range(0, n)) AS k) g""")
def _(t):
    out = geo.densify(t.f_segments, 400.0)
    return out.select("way_id", "seq", "part", half_up(F.col("x1") * 10).alias("x1"), half_up(F.col("y2") * 10).alias("y2"))


@query("thin_vertices")
def _(t):
    return geo.thin_vertices(t.lines.select("way_id", "pts"), 750.0).select("way_id", F.size("pts").alias("kept"))


@query("oriented_frame", """SELECT b_id, CAST(greatest(w, h) AS BIGINT) AS frame_len, CAST(least(w, h) AS BIGINT) AS frame_wid, CAST(floor((x0 + w / 2) * 2 + 0.5) AS BIGINT) AS frame_x2, CAST(floor((y0 + h / 2) * 2 + 0.5) AS BIGINT) AS frame_y2 FROM f_buildings""")
def _(t):
    out = geo.oriented_frame(t.polygons.select("b_id", "rings"))
    return out.select("b_id", *ints("frame_len", "frame_wid"), half_up(F.col("frame_x") * 2).alias("frame_x2"), half_up(F.col("frame_y") * 2).alias("frame_y2"))


@query("stitch_rings", "SELECT b_id, CAST(CASE WHEN shape = 3 THEN 2 ELSE 1 END AS INTEGER) AS rings, true AS closed, CAST(floor(area + 0.5) AS BIGINT) AS area FROM f_buildings JOIN f_bstat USING (b_id)")
def _(t):
    # Members as an extract has them: each ring cut in two lines, the second one reversed.
    closed = lambda r: F.concat(r, F.slice(r, 1, 1))
    halves = lambda r: F.array(F.slice(closed(r), 1, 3), F.reverse(F.slice(closed(r), F.lit(3), F.size(r))))
    first, second = F.get("rings", F.lit(0)), F.get("rings", F.lit(1))
    rel = t.polygons.select("b_id", halves(first).alias("outer"), F.when(second.isNotNull(), halves(second)).alias("inner"))
    out = geo.orient_rings(rings.stitch_rings(rel, ["b_id"]))
    return out.select("b_id", F.size("rings").alias("rings"), "closed", half_up(sh.signed_area(sh.polygon_edges(F.col("rings")))).alias("area"))


# Each edge of an outline is a member line, in another order, every other one the other way round; a relation holds the lines of all its rings.
EDGE_LINES = """(SELECT place_id, b_id, (ring * 10 + seq) * 7 % 23 AS line, CASE WHEN (b_id + seq) % 2 = 0 THEN x1 ELSE x2 END AS xa, CASE WHEN (b_id + seq) % 2 = 0 THEN y1 ELSE y2 END AS ya,
  CASE WHEN (b_id + seq) % 2 = 0 THEN x2 ELSE x1 END AS xb, CASE WHEN (b_id + seq) % 2 = 0 THEN y2 ELSE y1 END AS yb FROM f_bedges)"""


@query("ring_members", f"""WITH RECURSIVE e AS (SELECT * FROM {EDGE_LINES} l), w AS (SELECT b_id, line AS start, line, false AS rev, 0 AS pos, xb AS ex, yb AS ey FROM e
    UNION ALL SELECT w.b_id, w.start, n.line, n.xb = ex AND n.yb = ey, pos + 1, CASE WHEN n.xb = ex AND n.yb = ey THEN n.xa ELSE n.xb END, CASE WHEN n.xb = ex AND n.yb = ey THEN n.ya ELSE n.yb END
    FROM w JOIN e n ON n.b_id = w.b_id AND n.line <> w.line AND n.line <> w.start AND (n.xa = ex AND n.ya = ey OR n.xb = ex AND n.yb = ey)),
  low AS (SELECT b_id, start FROM w GROUP BY b_id, start HAVING min(line) = start)
  SELECT b_id, CAST(start AS BIGINT) AS ring, CAST(pos AS BIGINT) AS pos, CAST(line AS BIGINT) AS line, rev AS reversed FROM w SEMI JOIN low USING (b_id, start)""")
def _(t):
    e = t.f_bedges.withColumn("line", (F.col("ring") * 10 + F.col("seq")) * 7 % 23)
    ends = F.array(*[F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in (1, 2)])
    members = e.select("place_id", "b_id", "line", F.when((F.col("b_id") + F.col("seq")) % 2 == 0, ends).otherwise(F.reverse(ends)).alias("pts"))
    return rings.ring_members(members, ["place_id", "b_id"]).select("b_id", "ring", "pos", "line", "reversed")


@query("boundary_segments", f"""SELECT b_id, CAST(ring AS INTEGER) AS ring, CAST(seq AS INTEGER) AS seq FROM f_bedges e WHERE NOT EXISTS (SELECT 1 FROM f_areas a WHERE a.class = 3 AND a.place_id = e.place_id
    AND (x1 + x2) / 2 >= a.xmin AND (x1 + x2) / 2 < a.xmax AND (y1 + y2) / 2 >= a.ymin AND (y1 + y2) / 2 < a.ymax)
  AND abs(x1 + x2) / 2 < {HALF} - 5 AND abs(y1 + y2) / 2 < {HALF} - 5""")
def _(t):
    return boundary_segments(t.polygons.select("place_id", "b_id", "rings"), t.areas.filter("class = 3").select("place_id", "a_id", "rings")).select("b_id", "ring", "seq")


def boundary_segments(polygons, exclude):
    e = geo.edges(polygons, min_length=5.0).withColumns({"mx": (F.col("x1") + F.col("x2")) / 2, "my": (F.col("y1") + F.col("y2")) / 2})
    inner = e.filter((F.abs("mx") < HALF - 5) & (F.abs("my") < HALF - 5))
    return joins.point_in_polygon_join(inner, joins.with_edges(exclude), CHUNK, "left_anti", ["b_id", "ring", "seq"], "mx", "my")


@query("resolve_anchors", f"""WITH m AS (SELECT * FROM {MEAS} m), q AS (SELECT place_id, pt_id, x, y, pt_id % 4 AS kind, place_id * 600 + pt_id % 600 AS road, CAST(pt_id * 13 % 3000 AS DOUBLE) AS d, CAST(pt_id % 7 * 100 AS DOUBLE) AS off FROM f_points),
  road AS (SELECT pt_id, x, y FROM (SELECT q.pt_id, x1 + (x2 - x1) * ((d - s) / len) - (y2 - y1) / len * off AS x, y1 + (y2 - y1) * ((d - s) / len) + (x2 - x1) / len * off AS y, row_number() OVER (PARTITION BY q.pt_id ORDER BY seq) AS rn
     FROM q JOIN m ON m.way_id = q.road WHERE kind = 0 AND d >= s AND d <= s + len) r WHERE rn = 1),
  found AS (SELECT * FROM road UNION ALL SELECT pt_id, x, y FROM q WHERE kind = 1
    UNION ALL SELECT pt_id, cx, cy FROM q JOIN f_bstat b ON b.b_id = q.place_id * 80 + pt_id % 90 AND b.place_id = q.place_id WHERE kind = 2
    UNION ALL SELECT pt_id, (xmin + xmax) / 2, (ymin + ymax) / 2 FROM q JOIN f_areas a ON a.a_id = q.place_id * 4 + pt_id % 5 AND a.place_id = q.place_id WHERE kind = 3)
  SELECT q.pt_id, f.pt_id IS NULL AS dangling, CAST(floor(f.x * 4 + 0.25) AS BIGINT) AS x4, CAST(floor(f.y * 4 + 0.25) AS BIGINT) AS y4 FROM q LEFT JOIN found f ON f.pt_id = q.pt_id""")
def _(t):
    from placeloom.operators.select import resolve_anchors
    k = F.col("pt_id")
    anchors = t.f_points.select(
        "place_id", "pt_id", F.when(k % 4 == 1, F.col("x")).alias("x"), F.when(k % 4 == 1, F.col("y")).alias("y"),
        F.when(k % 4 == 0, F.col("place_id") * 600 + k % 600).alias("road"), (k * 13 % 3000).cast("double").alias("s"), (k % 7 * 100).cast("double").alias("offset"),
        F.when(k % 4 == 2, F.col("place_id") * 80 + k % 90).alias("building"), F.when(k % 4 == 3, F.col("place_id") * 4 + k % 5).alias("area"))
    out = resolve_anchors(anchors, "pt_id", t.lines, t.polygons.select("place_id", "b_id", "rings"), t.areas.select("place_id", "a_id", "rings"))
    return out.select("pt_id", "dangling", F.floor(F.col("at_x") * 4 + 0.25).cast("bigint").alias("x4"), F.floor(F.col("at_y") * 4 + 0.25).cast("bigint").alias("y4"))


@query("geodesic_distances")
def _(t):
    from placeloom.plans.q_derive import latlon
    pts = latlon(t).join(t.f_places.select("place_id", "lat0", "lon0"), "place_id")
    return geo.geodesic_distances(pts.select("pt_id", F.col("lat0").alias("lat1"), F.col("lon0").alias("lon1"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))).select(
        "pt_id", half_up(F.col("distance_m") * 1000).alias("distance_mm"), half_up(F.col("ref_x") * 1000).alias("ref_x_mm"), half_up(F.col("ref_y") * 1000).alias("ref_y_mm"))


