"""Spatial joins over the feature views. The SQL twins compare every pair of a place; the Spark side never does."""
from __future__ import annotations

from pyspark.sql import functions as F

from placeloom.functions.scalars import half_up
from placeloom.operators import geometry as geo, joins, sweep
from placeloom.plans.q_geometry import ints
from placeloom.plans.registry import query
from placeloom.plans.views import CHUNK, duck

T_SQL = "least(greatest((({x} - x1) * (x2 - x1) + ({y} - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0), 0), 1)"


def d2_sql(x, y):
    t = T_SQL.format(x=x, y=y)
    return f"(x1 + {t} * (x2 - x1) - {x}) * (x1 + {t} * (x2 - x1) - {x}) + (y1 + {t} * (y2 - y1) - {y}) * (y1 + {t} * (y2 - y1) - {y})"


def poly_dist_sql(points, ids, x="x", y="y", edges="f_bedges", eid="b_id", where="true"):
    """(ids..., eid, inside, d2) of every point and polygon of a place."""
    cols = ", ".join(f"p.{c}" for c in ids)
    return f"""(SELECT {cols}, e.{eid}, sum(CASE WHEN (y1 > p.{y}) <> (y2 > p.{y}) AND p.{x} < (x2 - x1) * (p.{y} - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1 AS inside,
      min({d2_sql('p.' + x, 'p.' + y)}) AS d2 FROM {points} p JOIN {edges} e ON p.place_id = e.place_id AND {where} GROUP BY {cols}, e.{eid})"""


IN_AREA = "{x} >= a.xmin AND {x} < a.xmax AND {y} >= a.ymin AND {y} < a.ymax"


def buildings(t):
    return joins.with_edges(t.polygons.select("place_id", "b_id", "rings"))


def areas(t, cond="true"):
    return joins.with_edges(t.areas.filter(cond).select("place_id", "a_id", "class", "rings"))


def roads(t):
    """Segments with the width (cm) of their road."""
    return t.f_segments.select("place_id", F.col("way_id").alias("line_id"), "seq", "x1", "y1", "x2", "y2", ((F.col("way_id") % 5 + 4) * 100).cast("double").alias("width"))


ROADS = "(SELECT *, way_id AS line_id, CAST((way_id % 5 + 4) * 100 AS DOUBLE) AS width FROM f_segments)"


@query("binned_join", """SELECT a.a_id, b.b_id FROM f_areas a JOIN f_bstat b ON a.place_id = b.place_id AND a.xmin <= b.xmax AND b.xmin <= a.xmax AND a.ymin <= b.ymax AND b.ymin <= a.ymax""")
def _(t):
    a = t.f_areas.select("place_id", "a_id", F.col("xmin").alias("ax0"), F.col("ymin").alias("ay0"), F.col("xmax").alias("ax1"), F.col("ymax").alias("ay1"))
    b = geo.with_ring_stats(t.polygons.select("place_id", "b_id", "rings")).select("place_id", "b_id", "xmin", "ymin", "xmax", "ymax")
    meet = (F.col("ax0") <= F.col("xmax")) & (F.col("xmin") <= F.col("ax1")) & (F.col("ay0") <= F.col("ymax")) & (F.col("ymin") <= F.col("ay1"))
    out = joins.binned_join(a, b, [F.col(c) for c in ("ax0", "ay0", "ax1", "ay1")], [F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")], CHUNK, meet, hot_rows=50)
    return out.select("a_id", "b_id")


@query("point_in_polygon_join", f"""SELECT pt_id, 'building' AS src, b_id AS id FROM {poly_dist_sql('f_points', ['pt_id'])} q WHERE inside
  UNION ALL SELECT pt_id, 'area', a_id FROM f_points p JOIN f_areas a ON p.place_id = a.place_id AND {IN_AREA.format(x='p.x', y='p.y')}""")
def _(t):
    p = t.f_points.select("place_id", "pt_id", "x", "y")
    b = joins.point_in_polygon_join(p, buildings(t), CHUNK).select("pt_id", F.lit("building").alias("src"), F.col("b_id").alias("id"))
    return b.unionByName(joins.point_in_polygon_join(p, areas(t), CHUNK).select("pt_id", F.lit("area").alias("src"), F.col("a_id").alias("id")))


PARTS = "(SELECT place_id, b_id AS part_id, x0 + w * (b_id % 5) / 4 AS px, y0 - 30 + CASE WHEN b_id % 3 = 0 THEN h ELSE 0 END AS py FROM f_buildings)"


@query("parts_in_outlines", f"SELECT part_id, b_id FROM {poly_dist_sql(PARTS, ['part_id'], 'px', 'py')} q WHERE inside OR d2 <= 2500")
def _(t):
    parts = t.f_buildings.select("place_id", F.col("b_id").alias("part_id"), (F.col("x0") + F.col("w") * (F.col("b_id") % 5) / 4).alias("px"),
                                 (F.col("y0") - 30 + F.when(F.col("b_id") % 3 == 0, F.col("h")).otherwise(0)).alias("py"))
    return joins.parts_in_outlines(parts, buildings(t), CHUNK, 50.0).select("part_id", "b_id")


# Parts of buildings: a wing at the lower left, a band through the middle or a tower on the upper side, by number; cm, like all of it.
PART_BOXES = """(SELECT place_id, b_id * 4 + k AS part_id, x0 - 40 AS px0, y0 + (h * k) DIV 4 AS py0, x0 - 40 + (w * (1 + (b_id + k) % 4)) DIV 4 + 60 AS px1, y0 + (h * k) DIV 4 + 200 + (b_id * 13) % 400 AS py1
  FROM (SELECT b.*, CAST(t.k AS BIGINT) AS k FROM f_buildings b JOIN (VALUES (0), (1), (2)) AS t(k) ON (b.b_id + t.k) % 3 <> 0 AND b.b_id % 5 <> 0) q)"""


def part_boxes(t):
    """PART_BOXES with the three numbers made inside the row: a join without a key multiplies the tasks and each writes to every partition."""
    k, b = F.col("k"), t.f_buildings.filter("b_id % 5 <> 0").withColumn("k", F.explode(F.array(*[F.lit(n).cast("bigint") for n in range(3)])))
    return b.filter((F.col("b_id") + k) % 3 != 0).selectExpr(
        "place_id", "b_id * 4 + k AS part_id", "x0 - 40 AS px0", "y0 + (h * k) DIV 4 AS py0", "x0 - 40 + (w * (1 + (b_id + k) % 4)) DIV 4 + 60 AS px1", "y0 + (h * k) DIV 4 + 200 + (b_id * 13) % 400 AS py1")


SLACK, LEAST_PIECE, LEAST_SHARE = 20.0, 120000.0, 0.2  # cm, cm2, part of the outline


@query("outline_leftovers", f"""WITH RECURSIVE b AS (SELECT part_id, place_id, px0, py0, px1, py1, (px0 + px1) / 2.0 AS px, (py0 + py1) / 2.0 AS py FROM {duck(PART_BOXES)} p),
  held AS (SELECT part_id, b_id FROM {poly_dist_sql('b', ['part_id'], 'px', 'py')} q WHERE inside OR d2 <= 2500),
  cov AS (SELECT h.b_id, px0 - {SLACK} AS cx0, py0 - {SLACK} AS cy0, px1 + {SLACK} AS cx1, py1 + {SLACK} AS cy1 FROM held h JOIN b USING (part_id)),
  xs AS (SELECT DISTINCT b_id, x FROM (SELECT b_id, x1 AS x FROM f_bedges UNION ALL SELECT b_id, unnest([cx0, cx1]) FROM cov) u),
  ys AS (SELECT DISTINCT b_id, y FROM (SELECT b_id, y1 AS y FROM f_bedges UNION ALL SELECT b_id, unnest([cy0, cy1]) FROM cov) u),
  xi AS (SELECT b_id, row_number() OVER w AS i, x AS xa, lead(x) OVER w AS xb FROM xs WINDOW w AS (PARTITION BY b_id ORDER BY x)),
  yi AS (SELECT b_id, row_number() OVER w AS j, y AS ya, lead(y) OVER w AS yb FROM ys WINDOW w AS (PARTITION BY b_id ORDER BY y)),
  cells AS (SELECT b_id, i, j, (xb - xa) * (yb - ya) AS area, (xa + xb) / 2 AS x, (ya + yb) / 2 AS y FROM xi JOIN yi USING (b_id) WHERE xb IS NOT NULL AND yb IS NOT NULL AND b_id IN (SELECT b_id FROM held)),
  inside AS (SELECT c.b_id, i, j, any_value(area) AS area, c.x, c.y FROM cells c JOIN f_bedges e ON e.b_id = c.b_id AND (e.y1 > c.y) <> (e.y2 > c.y) AND c.x < e.x1 GROUP BY c.b_id, i, j, c.x, c.y HAVING count(*) % 2 = 1),
  free AS (SELECT b_id, i, j, area, i * 1000 + j AS v FROM inside c WHERE NOT EXISTS (SELECT 1 FROM cov o WHERE o.b_id = c.b_id AND o.cx0 < c.x AND c.x < o.cx1 AND o.cy0 < c.y AND c.y < o.cy1)),
  reach AS (SELECT b_id, v AS root, i, j FROM free UNION SELECT r.b_id, r.root, f.i, f.j FROM reach r JOIN free f ON f.b_id = r.b_id AND abs(f.i - r.i) + abs(f.j - r.j) = 1),
  comp AS (SELECT b_id, i, j, min(root) AS c FROM reach GROUP BY 1, 2, 3), size AS (SELECT b_id, c, sum(area) AS area FROM comp JOIN free USING (b_id, i, j) GROUP BY 1, 2)
  SELECT s.b_id, 'leftover' AS state, CAST(s.area AS BIGINT) AS area FROM size s JOIN f_bstat k ON k.b_id = s.b_id WHERE s.area > {LEAST_PIECE} AND s.area > {LEAST_SHARE} * k.area
  UNION ALL SELECT b_id, 'unsplit', CAST(area AS BIGINT) FROM f_bstat WHERE b_id NOT IN (SELECT b_id FROM held)""")
def _(t):
    """What building parts leave over of their outlines, and outlines without parts."""
    corner = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    parts = part_boxes(t).withColumns({"rings": F.array(F.array(corner("px0", "py0"), corner("px1", "py0"), corner("px1", "py1"), corner("px0", "py1"))),
                                               "px": (F.col("px0") + F.col("px1")) / 2, "py": (F.col("py0") + F.col("py1")) / 2})
    _, unsplit, rest = sweep.outline_leftovers(t.polygons.select("place_id", "b_id", "rings"), parts, "b_id", "part_id", CHUNK, 50.0, SLACK, LEAST_PIECE, LEAST_SHARE)
    alone = geo.with_ring_stats(unsplit).select("b_id", F.lit("unsplit").alias("state"), half_up(F.col("area")).alias("area"))
    return rest.select("b_id", F.lit("leftover").alias("state"), half_up(F.col("area")).alias("area")).unionByName(alone)


@query("volumes_in_outlines", f"""SELECT v.b_id, a.a_id FROM f_bstat v LEFT JOIN f_areas a ON v.place_id = a.place_id AND {IN_AREA.format(x='v.cx', y='v.cy')}""")
def _(t):
    v = geo.with_ring_stats(t.polygons.select("place_id", "b_id", "rings")).select("place_id", "b_id", F.col("cx").alias("px"), F.col("cy").alias("py"))
    held, alone = joins.volumes_in_outlines(v, areas(t), CHUNK, "b_id")
    return held.select("b_id", "a_id").unionByName(alone.select("b_id", F.lit(None).cast("bigint").alias("a_id")))


@query("distance_join", f"""SELECT pt_id, line_id, seq, CAST(floor(sqrt(d2) * 10 + 0.5) AS BIGINT) AS d_mm FROM (
  SELECT p.pt_id, line_id, seq, {d2_sql('p.x', 'p.y')} AS d2 FROM f_points p JOIN {ROADS} s ON p.place_id = s.place_id) q WHERE d2 <= 1500 * 1500""")
def _(t):
    out = joins.distance_join(t.f_points.select("place_id", "pt_id", "x", "y"), roads(t), 1500.0, 3000.0)
    return out.select("pt_id", "line_id", "seq", half_up(F.sqrt("dist2") * 10).alias("d_mm"))


NEAREST = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pt_id ORDER BY d2, line_id, seq) AS rn FROM (
  SELECT p.pt_id, p.x, p.y, line_id, seq, width, x1, y1, x2, y2, {T_SQL.format(x='p.x', y='p.y')} AS t, {d2_sql('p.x', 'p.y')} AS d2 FROM f_points p JOIN {ROADS} s ON p.place_id = s.place_id) q) r WHERE rn = 1"""


@query("nearest_join", f"""SELECT pt_id, line_id, seq, CAST(floor(t * 1000 + 0.25) AS BIGINT) AS t_e3, CAST(floor(sqrt(d2) * 10 + 0.5) AS BIGINT) AS d_mm FROM ({NEAREST}) n WHERE d2 <= 45000.0 * 45000""")
def _(t):
    out = joins.nearest_join(t.f_points.select("place_id", "pt_id", "x", "y"), roads(t), ["place_id", "pt_id"], ["line_id", "seq"], 500.0, max_distance=45000.0)
    return out.select("pt_id", "line_id", "seq", F.floor(F.col("t") * 1000 + 0.25).cast("bigint").alias("t_e3"), half_up(F.sqrt("d2") * 10).alias("d_mm"))


@query("knn_join", """SELECT pt_id, what, CAST(rn AS INTEGER) AS rank_no, tid, CAST(floor(sqrt(d2) * 10 + 0.5) AS BIGINT) AS d_mm FROM (
  SELECT p.pt_id, CASE WHEN t.kind = 'MACHINERY' THEN 'enemy' ELSE 'repair' END AS what, t.pt_id AS tid, (t.x - p.x) * (t.x - p.x) + (t.y - p.y) * (t.y - p.y) AS d2,
    row_number() OVER (PARTITION BY p.pt_id, t.kind ORDER BY (t.x - p.x) * (t.x - p.x) + (t.y - p.y) * (t.y - p.y), t.pt_id) AS rn
  FROM f_points p JOIN f_points t ON p.place_id = t.place_id AND ((t.kind = 'MACHINERY' AND t.priority > 0) OR t.kind = 'FURNITURE') WHERE p.kind = 'BUILDING') q
  WHERE rn <= CASE WHEN what = 'enemy' THEN 3 ELSE 1 END""")
def _(t):
    p = t.f_points.filter("kind = 'BUILDING'").select("place_id", "pt_id", "x", "y")
    target = lambda cond: t.f_points.filter(cond).select("place_id", F.col("pt_id").alias("tid"), F.col("x").alias("tx"), F.col("y").alias("ty"))
    def run(cond, k, what):
        return joins.knn_join(p, target(cond), ["place_id", "pt_id"], ["tid"], k, 5000.0, 6).select(
            "pt_id", F.lit(what).alias("what"), "rank_no", "tid", half_up(F.sqrt("d2") * 10).alias("d_mm"))
    return run("kind = 'MACHINERY' AND priority > 0", 3, "enemy").unionByName(run("kind = 'FURNITURE'", 1, "repair"))


MEET = """(SELECT DISTINCT place_id, a, b, mx, my FROM (
  SELECT p.place_id, p.way_id AS a, q.way_id AS b, p.x1 + (p.x2 - p.x1) * u AS mx, p.y1 + (p.y2 - p.y1) * u AS my FROM (
    SELECT p, q, unnest(CASE WHEN den <> 0 THEN [tn / den] WHEN un = 0 THEN
        [greatest(0, least(u1, u2)), least(1, greatest(u1, u2))] ELSE [] END) AS u, den, tn, un, u1, u2 FROM (
      SELECT p, q, (p.x2 - p.x1) * (q.y2 - q.y1) - (p.y2 - p.y1) * (q.x2 - q.x1) AS den, (q.x1 - p.x1) * (q.y2 - q.y1) - (q.y1 - p.y1) * (q.x2 - q.x1) AS tn,
        (q.x1 - p.x1) * (p.y2 - p.y1) - (q.y1 - p.y1) * (p.x2 - p.x1) AS un,
        ((q.x1 - p.x1) * (p.x2 - p.x1) + (q.y1 - p.y1) * (p.y2 - p.y1)) / ((p.x2 - p.x1) * (p.x2 - p.x1) + (p.y2 - p.y1) * (p.y2 - p.y1)) AS u1,
        ((q.x2 - p.x1) * (p.x2 - p.x1) + (q.y2 - p.y1) * (p.y2 - p.y1)) / ((p.x2 - p.x1) * (p.x2 - p.x1) + (p.y2 - p.y1) * (p.y2 - p.y1)) AS u2
      FROM f_segments p JOIN f_segments q ON p.place_id = q.place_id AND p.way_id < q.way_id
       AND least(p.x1, p.x2) <= greatest(q.x1, q.x2) AND least(q.x1, q.x2) <= greatest(p.x1, p.x2) AND least(p.y1, p.y2) <= greatest(q.y1, q.y2) AND least(q.y1, q.y2) <= greatest(p.y1, p.y2)) a
    WHERE CASE WHEN den <> 0 THEN tn / den BETWEEN 0 AND 1 AND un / den BETWEEN 0 AND 1 ELSE un = 0 AND greatest(0, least(u1, u2)) <= least(1, greatest(u1, u2)) END) b) c)"""


@query("segment_intersection_join", f"SELECT a, b, CAST(floor(mx + 0.25) AS BIGINT) AS mx, CAST(floor(my + 0.25) AS BIGINT) AS my FROM {MEET} m")
def _(t):
    out = joins.segment_intersection_join(t.f_segments, "way_id", 2000.0)
    return out.select("a", "b", F.floor(F.col("mx") + 0.25).cast("bigint").alias("mx"), F.floor(F.col("my") + 0.25).cast("bigint").alias("my"))


WALL = "CAST((3 + b_id % 10) * 100 AS DOUBLE)"
LOW = "CAST(CASE WHEN b_id % 13 = 0 THEN 300 ELSE 0 END AS DOUBLE)"
PROBES = """(SELECT place_id, b_id, ring, seq, b_id * 100 + ring * 10 + seq AS wid, (x1 + x2) / 2 + (y2 - y1) / len * 35 AS mx, (y1 + y2) / 2 - (x2 - x1) / len * 35 AS my
  FROM (SELECT *, sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) AS len FROM f_bedges) q)"""


@query("party_walls", f"""SELECT w.b_id, CAST(w.ring AS INTEGER) AS ring, CAST(w.seq AS INTEGER) AS seq, CAST(max(greatest(w.lo, coalesce(CASE WHEN n.lo <= w.lo + 0.5 THEN n.top END, w.lo))) AS BIGINT) AS covered_to
  FROM (SELECT *, {LOW} AS lo FROM {PROBES} p) w LEFT JOIN (SELECT q.wid, q.b_id, {WALL} AS top, {LOW} AS lo, q.own FROM (
     SELECT p.wid, p.b_id AS own, e.b_id, sum(CASE WHEN (y1 > p.my) <> (y2 > p.my) AND p.mx < (x2 - x1) * (p.my - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1 AS inside
     FROM {PROBES} p JOIN f_bedges e ON p.place_id = e.place_id AND p.b_id <> e.b_id GROUP BY p.wid, p.b_id, e.b_id) q WHERE inside) n ON n.wid = w.wid
  GROUP BY w.b_id, w.ring, w.seq""")
def _(t):
    low = F.when(F.col("b_id") % 13 == 0, 300.0).otherwise(0.0)
    e = geo.edges(t.polygons.select("place_id", "b_id", "rings")).withColumn("min_h", low)
    n = buildings(t).withColumns({"n_h": ((F.col("b_id") % 10 + 3) * 100).cast("double"), "n_min": low}).withColumnRenamed("b_id", "n_id")
    return joins.party_walls(e, n, CHUNK, 35.0).select("b_id", "ring", "seq", F.col("covered_to").cast("bigint").alias("covered_to"))


SAMPLE = """(SELECT p.*, {w00} * a.z + {w01} * b.z + {w10} * c.z + {w11} * d.z AS height FROM (SELECT *, CAST(floor(fx) AS BIGINT) AS bi, CAST(floor(fy) AS BIGINT) AS bj, fx - floor(fx) AS tx, fy - floor(fy) AS ty FROM (
    SELECT *, least(greatest((x + 52000) / 4500, 0), 23 - 0.000001) AS fx, least(greatest((y + 52000) / 4500, 0), 24 - 0.000001) AS fy FROM {points} q) r) p
  LEFT JOIN f_raster a ON a.place_id = p.place_id AND a.i = bi AND a.j = bj LEFT JOIN f_raster b ON b.place_id = p.place_id AND b.i = bi + 1 AND b.j = bj
  LEFT JOIN f_raster c ON c.place_id = p.place_id AND c.i = bi AND c.j = bj + 1 LEFT JOIN f_raster d ON d.place_id = p.place_id AND d.i = bi + 1 AND d.j = bj + 1)""".replace(
    "{w00}", "(1 - tx) * (1 - ty)").replace("{w01}", "tx * (1 - ty)").replace("{w10}", "(1 - tx) * ty").replace("{w11}", "tx * ty")


@query("raster_sample", f"SELECT pt_id, CAST(floor(height * 10 + 0.5) AS BIGINT) AS h_mm FROM {SAMPLE.replace('{points}', 'f_points')} s")
def _(t):
    out = joins.raster_sample(t.f_points.select("place_id", "pt_id", "x", "y"), t.f_raster, -52000.0, -52000.0, 4500.0, 24, 25)
    return out.select("pt_id", half_up(F.col("height") * 10).alias("h_mm"))


@query("range_join_views", """SELECT pt_id, b_id, CAST(floor(sqrt(d2) * 10 + 0.5) AS BIGINT) AS d_mm FROM (SELECT p.pt_id, b.b_id,
    pow(greatest(b.xmin - p.x, 0, p.x - b.xmax), 2) + pow(greatest(b.ymin - p.y, 0, p.y - b.ymax), 2) AS d2 FROM f_points p JOIN f_bstat b ON p.place_id = b.place_id) q WHERE d2 < 10000.0 * 10000""")
def _(t):
    tiles = geo.with_ring_stats(t.polygons.select("place_id", "b_id", "rings")).select("place_id", "b_id", F.col("xmin").alias("tx0"), F.col("ymin").alias("ty0"), F.col("xmax").alias("tx1"), F.col("ymax").alias("ty1"))
    return joins.range_join_views(t.f_points.select("place_id", "pt_id", "x", "y"), tiles, 10000.0, CHUNK).select("pt_id", "b_id", half_up(F.sqrt("dist2") * 10).alias("d_mm"))


@query("on_land", f"""SELECT p.pt_id, coalesce(l.pt_id IS NOT NULL OR sqrt(n.d2) < n.width / 2 + 180, false) AS on_land FROM f_points p
  LEFT JOIN (SELECT DISTINCT p.pt_id FROM f_points p JOIN f_areas a ON p.place_id = a.place_id AND a.class < 8 AND {IN_AREA.format(x='p.x', y='p.y')}) l ON l.pt_id = p.pt_id
  LEFT JOIN ({NEAREST}) n ON n.pt_id = p.pt_id""")
def _(t):
    return joins.on_land(t.f_points.select("place_id", "pt_id", "x", "y"), areas(t, "class < 8").drop("class"), roads(t), ["pt_id"], 500.0, 180.0).select("pt_id", "on_land")


VIEWS_SQL = f"""SELECT b_id, line_id, seq, px, py, cx, cy, d2, top, greatest(0, least(4000, top * 1.4::DOUBLE) - sqrt(d2)) AS back FROM (
  SELECT *, x1 + t * (x2 - x1) AS px, y1 + t * (y2 - y1) AS py, row_number() OVER (PARTITION BY b_id ORDER BY d2, line_id, seq) AS rn FROM (
    SELECT b.b_id, b.cx, b.cy, {WALL.replace('b_id', 'b.b_id')} AS top, line_id, seq, x1, y1, x2, y2, {T_SQL.format(x='b.cx', y='b.cy')} AS t, {d2_sql('b.cx', 'b.cy')} AS d2
    FROM f_bstat b JOIN {ROADS} s ON s.place_id = b.place_id) q) r WHERE rn = 1"""


@query("facade_viewpoints", f"""SELECT b_id, line_id, seq, CAST(floor((d - 360 * floor(d / 360)) * 100 + 0.5) AS BIGINT) AS heading_e2, CAST(floor(cam_x + 0.5) AS BIGINT) AS cam_x, CAST(floor(cam_y + 0.5) AS BIGINT) AS cam_y FROM (
  SELECT *, degrees(atan2(cx - px, cy - py)) AS d, px - (cx - px) / CASE WHEN d2 = 0 THEN 1 ELSE sqrt(d2) END * back AS cam_x, py - (cy - py) / CASE WHEN d2 = 0 THEN 1 ELSE sqrt(d2) END * back AS cam_y FROM ({VIEWS_SQL}) v) w""")
def _(t):
    b = geo.with_ring_stats(t.polygons.select("place_id", "b_id", "rings")).select("place_id", "b_id", "cx", "cy", ((F.col("b_id") % 10 + 3) * 100).cast("double").alias("wall_h"))
    out = joins.facade_viewpoints(b, roads(t), 500.0)
    return out.select("b_id", "line_id", "seq", half_up(F.col("heading") * 100).alias("heading_e2"), *ints("cam_x", "cam_y"))


QUERY_TEXT = """CASE pt_id % 6 WHEN 0 THEN '55.5, 13.75' WHEN 1 THEN upper(name) WHEN 2 THEN substr(name, length(name) - 2, 3) WHEN 3 THEN 'nothing here' WHEN 4 THEN substr(name, length(name), 1) ELSE lower(kind) END"""


@query("resolve_names", f"""WITH q AS (SELECT place_id, pt_id, {QUERY_TEXT} AS query FROM f_points),
  e AS (SELECT q.pt_id, min(n.pt_id) AS hit FROM q JOIN f_points n ON n.place_id = q.place_id AND lower(n.name) = lower(trim(q.query)) GROUP BY q.pt_id),
  c AS (SELECT q.pt_id, min(n.pt_id) AS hit FROM q JOIN f_points n ON n.place_id = q.place_id AND contains(lower(n.name), lower(trim(q.query))) GROUP BY q.pt_id)
  SELECT q.pt_id, CASE WHEN q.pt_id % 6 = 0 THEN 'position' WHEN e.hit IS NOT NULL THEN 'exact' WHEN c.hit IS NOT NULL THEN 'part' ELSE 'unmatched' END AS how,
    CASE WHEN q.pt_id % 6 <> 0 THEN coalesce(e.hit, c.hit) END AS name_id, CASE WHEN q.pt_id % 6 = 0 THEN 55.5::DOUBLE END AS lat FROM q LEFT JOIN e ON e.pt_id = q.pt_id LEFT JOIN c ON c.pt_id = q.pt_id""")
def _(t):
    q = t.f_points.select("place_id", F.col("pt_id").alias("query_id"), F.expr(QUERY_TEXT).alias("query"))
    out = joins.resolve_names(q, t.f_points.select("place_id", F.col("pt_id").alias("name_id"), "name"))
    return out.select(F.col("query_id").alias("pt_id"), "how", "name_id", "lat")


@query("corridor_clear", f"""WITH k AS (SELECT place_id, way_id * 100 + seq AS link_id, x1 + (x2 - x1) * k / n AS x, y1 + (y2 - y1) * k / n AS y, link_id * 100 + k AS sid FROM (
     SELECT *, way_id * 100 + seq AS link_id, CAST(ceil(sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) / 200) AS BIGINT) AS n FROM f_segments) q, LATERAL (SELECT unnest(range(0, n + 1)) AS k) g),
  land AS (SELECT k.link_id, bool_and(a.a_id IS NOT NULL) AS ok FROM k LEFT JOIN f_areas a ON a.place_id = k.place_id AND a.class < 8 AND {IN_AREA.format(x='k.x', y='k.y')} GROUP BY k.link_id),
  near AS (SELECT k.* FROM k JOIN f_bstat b ON b.place_id = k.place_id AND k.x BETWEEN b.xmin - 80 AND b.xmax + 80 AND k.y BETWEEN b.ymin - 80 AND b.ymax + 80),
  hit AS (SELECT DISTINCT link_id FROM {poly_dist_sql('near', ['link_id', 'sid'])} d WHERE inside OR d2 <= 80 * 80)
  SELECT link_id FROM land WHERE ok AND link_id NOT IN (SELECT link_id FROM hit)""")
def _(t):
    links = t.f_segments.select("place_id", (F.col("way_id") * 100 + F.col("seq")).alias("link_id"), "x1", "y1", "x2", "y2")
    return joins.corridor_clear(links, buildings(t), areas(t, "class < 8"), 200.0, 80.0, CHUNK).select("link_id")


@query("recovery_candidates", f"""WITH nd AS (SELECT DISTINCT place_id, node_id, x AS nx, y AS ny FROM f_vertices),
  near AS (SELECT * FROM (SELECT n.*, line_id, seq, width, x1, y1, x2, y2, row_number() OVER (PARTITION BY n.place_id, n.node_id ORDER BY {d2_sql('n.nx', 'n.ny')}, line_id, seq) AS rn, {d2_sql('n.nx', 'n.ny')} AS d2
      FROM nd n JOIN {ROADS} s ON s.place_id = n.place_id AND abs(x1 - n.nx) <= 2000 AND abs(y1 - n.ny) <= 2000) q WHERE rn = 1 AND d2 <= 200 * 200 AND width >= 600),
  blocked AS (SELECT DISTINCT place_id, node_id FROM (SELECT d.*, n.place_id FROM {poly_dist_sql('(SELECT place_id, node_id, nx, ny, place_id * 1000000 + node_id AS nid FROM near n)', ['nid', 'node_id'], 'nx', 'ny')} d JOIN nd n ON n.place_id * 1000000 + n.node_id = d.nid) z WHERE inside OR d2 <= 130 * 130),
  cand AS (SELECT p.pt_id AS car_id, n.node_id, k.turn, sqrt((nx - p.x) * (nx - p.x) + (ny - p.y) * (ny - p.y)) / 100 + abs(atan2(sin(atan2(-(x2 - x1), -(y2 - y1)) + k.turn * 3.141592653589793::DOUBLE - p.pt_id % 6), cos(atan2(-(x2 - x1), -(y2 - y1)) + k.turn * 3.141592653589793::DOUBLE - p.pt_id % 6))) * 3 AS score
    FROM f_points p JOIN near n ON n.place_id = p.place_id CROSS JOIN (VALUES (0), (1)) k(turn) WHERE p.kind = 'BUILDING' AND (nx - p.x) * (nx - p.x) + (ny - p.y) * (ny - p.y) BETWEEN 900.0 * 900 AND 6500.0 * 6500
      AND NOT EXISTS (SELECT 1 FROM blocked b WHERE b.place_id = n.place_id AND b.node_id = n.node_id))
  SELECT car_id, node_id, turn, CAST(floor(score * 1000 + 0.5) AS BIGINT) AS score_e3 FROM (SELECT *, row_number() OVER (PARTITION BY car_id ORDER BY floor(score * 1e6 + 0.5), node_id, turn) AS rn FROM cand) q WHERE rn = 1""")
def _(t):
    cars = t.f_points.filter("kind = 'BUILDING'").select("place_id", F.col("pt_id").alias("car_id"), "x", "y", (F.col("pt_id") % 6).cast("double").alias("heading"))
    nodes = t.f_vertices.select("place_id", "node_id", F.col("x").alias("nx"), F.col("y").alias("ny")).distinct()
    out = joins.recovery_candidates(cars, nodes, roads(t), buildings(t), 2000.0, 900.0, 6500.0, 200.0, 600.0, 130.0, fine=300.0)
    return out.select("car_id", "node_id", "turn", half_up(F.col("score") * 1000).alias("score_e3"))


