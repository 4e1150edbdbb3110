"""Selection and set comparison over the feature views."""
from __future__ import annotations

import re

from pyspark.sql import functions as F

from placeloom.functions.scalars import half_up
from placeloom.operators import geometry as geo, joins, select as sel
from placeloom.plans.q_aggregate import b
from placeloom.plans.q_geometry import MEAS
from placeloom.plans.q_joins import IN_AREA, T_SQL, areas, buildings, d2_sql, poly_dist_sql
from placeloom.plans.registry import query
from placeloom.plans.views import CHUNK

SIDE = "sign(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))"


def side(a, c, p):
    return SIDE.format(ax=a[0], ay=a[1], bx=c[0], by=c[1], cx=p[0], cy=p[1])


def d2_of(x, y, alias):
    """Squared distance of a point to the segment of one alias."""
    return re.sub(r"(?<![.\w])([xy][12])\b", alias + r".\1", d2_sql(x, y))


S1, S2, E1, E2 = ("s.x1", "s.y1"), ("s.x2", "s.y2"), ("e.x1", "e.y1"), ("e.x2", "e.y2")
GAP = f"""(SELECT s.place_id, s.way_id, s.seq, e.b_id, CASE WHEN bool_or({side(E1, E2, S1)} * {side(E1, E2, S2)} < 0 AND {side(S1, S2, E1)} * {side(S1, S2, E2)} < 0) OR sum(CASE WHEN (e.y1 > s.y1) <> (e.y2 > s.y1) AND s.x1 < (e.x2 - e.x1) * (s.y1 - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1 THEN 1 ELSE 0 END) % 2 = 1
     OR sum(CASE WHEN (e.y1 > s.y2) <> (e.y2 > s.y2) AND s.x2 < (e.x2 - e.x1) * (s.y2 - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1 THEN 1 ELSE 0 END) % 2 = 1 THEN 0
     ELSE min(least({d2_of('e.x1', 'e.y1', 's')}, {d2_of('s.x1', 's.y1', 'e')}, {d2_of('s.x2', 's.y2', 'e')})) END AS d2
   FROM f_segments s JOIN f_bstat k ON k.place_id = s.place_id AND k.xmin <= greatest(s.x1, s.x2) + 2400 AND k.xmax >= least(s.x1, s.x2) - 2400 AND k.ymin <= greatest(s.y1, s.y2) + 2400 AND k.ymax >= least(s.y1, s.y2) - 2400
   JOIN f_bedges e ON e.b_id = k.b_id GROUP BY s.place_id, s.way_id, s.seq, e.b_id)"""


@query("list_buildings", f"""WITH g AS (SELECT g.*, w.name AS street FROM {GAP} g JOIN f_ways w ON w.way_id = g.way_id WHERE d2 <= 2333.0 * 2333),
  v AS (SELECT g.place_id, street, g.b_id, d2, k.area, k.cx, k.cy, s.way_id, s.seq, s.x1, s.y1, s.x2, s.y2, {T_SQL.format(x='k.cx', y='k.cy')} AS t, {d2_sql('k.cx', 'k.cy')} AS view2 FROM g JOIN f_segments s ON s.way_id = g.way_id AND s.seq = g.seq JOIN f_bstat k ON k.b_id = g.b_id),
  m AS (SELECT place_id, street, b_id, min(d2) OVER w AS d2, area, cx, cy, x1 + t * (x2 - x1) AS px, y1 + t * (y2 - y1) AS py, row_number() OVER (PARTITION BY place_id, street, b_id ORDER BY view2, way_id, seq) AS rn FROM v WINDOW w AS (PARTITION BY place_id, street, b_id)),
  r AS (SELECT *, row_number() OVER (PARTITION BY place_id, street ORDER BY floor(sqrt(d2) * 10 + 0.5), -area, b_id) AS rank_no FROM m WHERE rn = 1)
  SELECT place_id, street, b_id, CAST(rank_no AS INTEGER) AS rank_no, CAST(floor(sqrt(d2) * 10 + 0.5) AS BIGINT) AS d_mm, CAST(area AS BIGINT) AS area, {b('px', 'view_x')}, {b('py', 'view_y')} FROM r WHERE rank_no <= 40""")
def _(t):
    stats = geo.with_ring_stats(t.polygons.select("place_id", "b_id", "rings")).select("place_id", "b_id", "rings", "cx", "cy", "area")
    streets = t.f_segments.join(t.f_ways.select("way_id", F.col("name").alias("street")), "way_id").withColumnRenamed("way_id", "line_id")
    out = sel.list_buildings(joins.with_edges(stats), streets, 2333.0, 40, CHUNK)
    return out.select("place_id", "street", "b_id", "rank_no", half_up(F.col("distance") * 10).alias("d_mm"), F.col("area").cast("bigint").alias("area"), half_up(F.col("view_x")).alias("view_x"), half_up(F.col("view_y")).alias("view_y"))


# Asks of three kinds: near a position, by a part of a name (and near a position), by id.
ASKS = """(SELECT place_id, pt_id AS ask, CASE WHEN pt_id % 4 < 2 THEN x END AS x, CASE WHEN pt_id % 4 < 2 THEN y END AS y,
  CASE WHEN pt_id % 4 = 3 THEN place_id * 80 + pt_id % 80 END AS id, CASE WHEN pt_id % 4 IN (1, 2) THEN CASE pt_id % 3 WHEN 0 THEN 'RING' WHEN 1 THEN 'widg' ELSE 'Bolt' END END AS name FROM f_points)"""


@query("find_buildings", f"""WITH a AS MATERIALIZED (SELECT *, lower(name) AS part FROM {ASKS} q), p AS (SELECT * FROM a WHERE x IS NOT NULL),
  pairs AS (SELECT ask, b_id FROM {poly_dist_sql('p', ['ask'])} z WHERE inside OR d2 <= 7000.0 * 7000 UNION ALL SELECT ask, b_id FROM a JOIN f_buildings b ON b.place_id = a.place_id WHERE x IS NULL),
  f AS (SELECT a.place_id, a.ask, b.b_id, k.area, CASE WHEN a.x IS NULL THEN 0 ELSE sqrt(pow(k.cx - a.x, 2) + pow(k.cy - a.y, 2)) END AS d FROM pairs JOIN a ON a.ask = pairs.ask JOIN f_buildings b ON b.b_id = pairs.b_id JOIN f_bstat k ON k.b_id = b.b_id
    WHERE (a.id IS NULL OR a.id = b.b_id) AND (a.part IS NULL OR contains(lower(b.name), a.part)))
  SELECT place_id, ask, b_id, CAST(rn AS INTEGER) AS rank_no, CAST(floor(d * 10 + 0.5) AS BIGINT) AS d_mm FROM (SELECT *, row_number() OVER (PARTITION BY place_id, ask ORDER BY floor(d * 10 + 0.5), -area, b_id) AS rn FROM f) q WHERE rn <= 40""")
def _(t):
    stats = geo.with_ring_stats(t.polygons.select("place_id", "b_id", "name", "rings")).select("place_id", "b_id", "name", "rings", "cx", "cy", "area")
    out = sel.find_buildings(stats, t.sql(ASKS[1:-1]), 7000.0, 40, CHUNK)
    return out.select("place_id", "ask", "b_id", "rank_no", half_up(F.col("distance") * 10).alias("d_mm"))


@query("top_landmarks", "SELECT place_id, b_id AS id, CAST(rn AS INTEGER) AS rank_no FROM (SELECT b.place_id, b.b_id, row_number() OVER (PARTITION BY b.place_id ORDER BY area DESC, b.b_id) AS rn FROM f_buildings b JOIN f_bstat s ON s.b_id = b.b_id WHERE name IS NOT NULL) q WHERE rn <= 5")
def _(t):
    named = geo.with_ring_stats(t.polygons.filter("name IS NOT NULL").select("place_id", F.col("b_id").alias("id"), "rings")).select("place_id", "id", "area")
    return sel.top_landmarks(named, 5).select("place_id", "id", "rank_no")


SPAWN_OFF = [0, 1500, -1500, 3000, -3000, 6000, -6000]
SPAWN_W = "CAST((w.way_id % 5 + 4) * 100 AS DOUBLE)"


@query("spawn_point", f"""WITH m AS (SELECT * FROM {MEAS} m), loc AS (SELECT way_id, s FROM (SELECT way_id, s + t * len AS s, row_number() OVER (PARTITION BY way_id ORDER BY d2, s + t * len) AS rn FROM (
     SELECT *, pow(x1 + t * (x2 - x1), 2) + pow(y1 + t * (y2 - y1), 2) AS d2 FROM (SELECT *, least(greatest(((0 - x1) * (x2 - x1) + (0 - y1) * (y2 - y1)) / (len * len), 0), 1) AS t FROM m) a) b) c WHERE rn = 1),
  tot AS (SELECT way_id, max(len_sum) AS total FROM m GROUP BY way_id), tr AS (SELECT w.place_id, w.way_id, o.k, w.highway IN ('primary', 'secondary', 'tertiary', 'residential') AS main, {SPAWN_W} AS width, least(greatest(loc.s + o.off, 300), total - 300) AS d
    FROM f_ways w JOIN loc ON loc.way_id = w.way_id JOIN tot ON tot.way_id = w.way_id CROSS JOIN (VALUES {', '.join(f'({k}, {o})' for k, o in enumerate(SPAWN_OFF))}) o(k, off) WHERE w.highway IN ('primary', 'secondary', 'tertiary', 'residential', 'service', 'pedestrian') AND w.way_id % 5 + 4 >= 5),
  pt AS (SELECT * FROM (SELECT tr.*, x1 + (x2 - x1) * ((d - s) / len) AS x, y1 + (y2 - y1) * ((d - s) / len) AS y, row_number() OVER (PARTITION BY tr.way_id, tr.k ORDER BY seq) AS rn, tr.way_id * 10 + tr.k AS tid FROM tr JOIN m ON m.way_id = tr.way_id WHERE d > 0 AND d >= s AND d <= s + len) z WHERE rn = 1),
  bad AS (SELECT q.tid FROM {poly_dist_sql('pt', ['tid', 'width'])} q WHERE inside OR d2 < (width / 2 + 50) * (width / 2 + 50)),
  ok AS (SELECT pt.* FROM pt WHERE tid NOT IN (SELECT tid FROM bad) AND EXISTS (SELECT 1 FROM f_areas a WHERE a.place_id = pt.place_id AND a.class < 8 AND {IN_AREA.format(x='pt.x', y='pt.y')}))
  SELECT place_id, way_id, k, {b('x', 'x')}, {b('y', 'y')} FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY floor((sqrt(x * x + y * y) / 100 - 40 - CASE WHEN main THEN 30 ELSE 0 END - width / 50) * 1e6 + 0.5), way_id, k) AS r2 FROM ok) f WHERE r2 = 1""")
def _(t):
    roads = t.f_ways.filter("highway IN ('primary', 'secondary', 'tertiary', 'residential', 'service', 'pedestrian')").select(
        "way_id", F.col("name").isNotNull().alias("named"), F.col("highway").isin("primary", "secondary", "tertiary", "residential").alias("main"), ((F.col("way_id") % 5 + 4) * 100).cast("double").alias("width")).filter("width >= 500")
    from placeloom.functions import shapes as sh
    lines = t.lines.join(roads, "way_id").filter(sh.line_length(F.col("pts")) > 0)
    out = sel.spawn_point(lines, buildings(t), areas(t, "class < 8"), SPAWN_OFF, CHUNK)
    return out.select("place_id", "way_id", "k", half_up(F.col("x")).alias("x"), half_up(F.col("y")).alias("y"))


@query("spaced_selection", """WITH RECURSIVE o AS (SELECT place_id, pt_id, x, y, row_number() OVER (PARTITION BY place_id ORDER BY -priority, pt_id) AS rn FROM f_points),
  r AS (SELECT place_id, rn, [{'x': x, 'y': y}] AS took, pt_id, true AS ok FROM o WHERE rn = 1
    UNION ALL SELECT place_id, rn, CASE WHEN fits THEN list_append(took, {'x': x, 'y': y}) ELSE took END, pt_id, fits FROM (
      SELECT o.place_id, o.rn, r.took, o.pt_id, o.x, o.y, len(list_filter(r.took, lambda q: (q.x - o.x) * (q.x - o.x) + (q.y - o.y) * (q.y - o.y) < 9000.0 * 9000)) = 0 AS fits FROM r JOIN o ON o.place_id = r.place_id AND o.rn = r.rn + 1) z)
  SELECT place_id, pt_id, CAST(n AS INTEGER) AS pick_no FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY rn) AS n FROM r WHERE ok) q WHERE n <= 12""")
def _(t):
    out = sel.spaced_selection(t.f_points, ["place_id"], [-F.col("priority")], "pt_id", 9000.0, 12)
    return out.select("place_id", "pt_id", "pick_no")


def views(t):
    targets = geo.with_ring_stats(t.polygons.filter("building IN ('house', 'apartments', 'church')").select("place_id", "b_id", "rings")).select("place_id", "b_id", "rings", "cx", "cy")
    roads = t.f_ways.filter("highway IN ('primary', 'residential', 'pedestrian')").select("way_id")
    return sel.view_candidates(t.lines.join(roads, "way_id", "left_semi").select("place_id", "way_id", "pts"), joins.with_edges(targets), 1000.0, 200.0, 3000.0, 35.0, CHUNK)


@query("greedy_cover")
def _(t):
    return sel.greedy_cover(views(t), ["way_id", "n", "side"], 6).select("place_id", "round_no", "way_id", "n", "side", "gain")


@query("unsurveyed", """SELECT b_id FROM f_buildings WHERE CASE WHEN b_id % 7 = 0 THEN true ELSE NOT (b_id % 5 = 0) AND NOT (b_id % 3 = 0) END""")
def _(t):
    ids = t.f_buildings.select("b_id", F.concat(F.lit("w"), F.col("b_id").cast("string"), F.when(F.col("b_id") % 2 == 0, "r").otherwise("")).alias("id"))
    known = t.f_buildings.filter("b_id % 5 = 0").select(F.concat(F.lit("w"), F.col("b_id").cast("string")).alias("id"))
    script = F.when(F.col("b_id") % 7 == 0, "edited; not surveyed yet").when(F.col("b_id") % 3 == 0, "edited by hand").when(F.col("b_id") % 11 == 0, "Starter script from the seed")
    return sel.unsurveyed(ids, known, ids.select("id", script.alias("script")).filter("script IS NOT NULL")).select("b_id")


@query("diff_datasets", """SELECT p_partkey, 'only in a' AS difference FROM part WHERE p_partkey % 17 = 0 UNION ALL SELECT p_partkey, 'only in b' FROM part WHERE p_partkey % 17 = 1
  UNION ALL SELECT p_partkey, 'p_size' FROM part WHERE p_partkey % 17 = 2 UNION ALL SELECT p_partkey, 'p_brand' FROM part WHERE p_partkey % 17 > 1 AND p_partkey % 5 = 0""")
def _(t):
    p = t.part.select("p_partkey", "p_brand", "p_size")
    k = F.col("p_partkey")
    changed = p.withColumns({"p_size": F.when(k % 17 == 2, F.col("p_size") + 1).otherwise(F.col("p_size")), "p_brand": F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand"))})
    return sel.diff_datasets(p.filter("p_partkey % 17 <> 1"), changed.filter("p_partkey % 17 <> 0"), ["p_partkey"])


@query("symmetric_nodes", """SELECT place_id, node_id, CASE WHEN e AND f THEN 'both' WHEN e THEN 'missing' ELSE 'extra' END AS state FROM (SELECT place_id, node_id, count(DISTINCT way_id) > 1 AS e, bool_or(way_id % 2 = 0) AS f FROM f_vertices GROUP BY 1, 2) q WHERE e OR f""")
def _(t):
    from placeloom.plans.q_aggregate import junction_nodes
    return sel.symmetric_nodes(junction_nodes(t), t.f_vertices.filter("way_id % 2 = 0").select("place_id", "node_id"), ["place_id", "node_id"])


@query("canonical_order", "SELECT place_id, way_id, CAST(row_number() OVER (PARTITION BY place_id ORDER BY name, way_id) AS BIGINT) AS position FROM f_ways")
def _(t):
    return sel.canonical_order(t.f_ways.select("place_id", "way_id", "name"), ["name", "way_id"]).select("place_id", "way_id", "position")
