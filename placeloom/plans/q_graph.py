"""Road topology over the feature views."""
from __future__ import annotations

from pyspark.sql import functions as F

from placeloom.functions.scalars import half_up
from placeloom.operators import derive, graph
from placeloom.plans.q_aggregate import PAIRS, b, junction_nodes
from placeloom.plans.q_derive import Z_LAYER
from placeloom.plans.q_joins import MEET, buildings, poly_dist_sql
from placeloom.plans.registry import query
from placeloom.plans.views import CHUNK, HALF
from placeloom.session import cut_lineage

LEVEL_TAGS = ["layer", "bridge", "tunnel", "covered", "level"]


def road_rows(t):
    """Roads as one row: centreline, node ids where known, vertical level, level tags."""
    levels = derive.vertical_level(t.way_tags).select("way_id", "has_nodes", "z_layer", "z_level")
    tags = t.f_ways.select("way_id", *LEVEL_TAGS)
    return t.lines.join(levels, "way_id").join(tags, "way_id").withColumn("nodes", F.when(F.col("has_nodes"), F.col("nodes")))


ROAD_V = f"""(SELECT v.*, CASE WHEN w.has_nodes THEN v.node_id END AS nid, coalesce(CAST(w.z AS VARCHAR), '?') AS lv, coalesce(w.zl, '') AS lw FROM f_vertices v
  JOIN (SELECT *, {Z_LAYER} AS z, CASE WHEN level NOT IN ('', '0') THEN level END AS zl FROM f_ways) w ON w.way_id = v.way_id WHERE x >= -{HALF} AND x < {HALF} AND y >= -{HALF} AND y < {HALF})"""
MEMBERS = f"""(SELECT v.place_id, 'j:n' || v.nid AS junction, 'osm_node' AS basis, v.nid AS node_id, v.way_id, v.x, v.y FROM (SELECT DISTINCT place_id, nid, way_id, x, y FROM {ROAD_V} r WHERE nid IS NOT NULL) v
    JOIN (SELECT place_id, nid FROM {ROAD_V} r WHERE nid IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT way_id) > 1) s ON s.place_id = v.place_id AND s.nid = v.nid
  UNION ALL SELECT DISTINCT v.place_id, 'j:' || CAST(v.x AS BIGINT) || ',' || CAST(v.y AS BIGINT) || '@' || v.lv || '/' || v.lw, 'shared_position', NULL, v.way_id, v.x, v.y FROM {ROAD_V} v
    JOIN (SELECT place_id, x, y, lv, lw FROM {ROAD_V} r GROUP BY 1, 2, 3, 4, 5 HAVING count(DISTINCT way_id) > 1 AND bool_or(nid IS NULL)) g ON g.place_id = v.place_id AND g.x = v.x AND g.y = v.y AND g.lv = v.lv AND g.lw = v.lw)"""


@query("junctions", f"""SELECT place_id, junction, basis, node_id, {b('min(x)', 'x')}, {b('min(y)', 'y')}, CAST(count(DISTINCT way_id) AS BIGINT) AS roads, min(way_id) AS first_road, max(way_id) AS last_road FROM {MEMBERS} m GROUP BY place_id, junction, basis, node_id""")
def _(t):
    out = graph.junctions(graph.junction_members(road_rows(t), HALF))
    return out.select("place_id", "junction", "basis", "node_id", half_up(F.col("x")).alias("x"), half_up(F.col("y")).alias("y"), "roads", "first_road", "last_road")


DIFFER = ", ".join(f"CASE WHEN p.{c} IS DISTINCT FROM q.{c} THEN '{c}' END" for c in sorted(LEVEL_TAGS))
CROSSINGS = f"""(WITH w AS (SELECT *, {Z_LAYER} AS z, CASE WHEN level NOT IN ('', '0') THEN level END AS zl FROM f_ways), mem AS (SELECT * FROM {MEMBERS} m)
  SELECT m.place_id, m.a, m.b, m.mx, m.my, CASE WHEN p.z IS NOT NULL AND q.z IS NOT NULL AND (p.z <> q.z OR p.zl IS DISTINCT FROM q.zl) THEN 'separated' ELSE 'unresolved' END AS status, concat_ws(',', {DIFFER}) AS differ
  FROM {MEET} m JOIN w p ON p.way_id = m.a JOIN w q ON q.way_id = m.b WHERE mx >= -{HALF} AND mx < {HALF} AND my >= -{HALF} AND my < {HALF}
   AND NOT EXISTS (SELECT 1 FROM mem i JOIN mem k ON k.junction = i.junction AND k.place_id = i.place_id WHERE i.place_id = m.place_id AND i.way_id = m.a AND k.way_id = m.b AND abs(i.x - m.mx) < 0.01 AND abs(i.y - m.my) < 0.01))"""


def crossing_rows(t):
    r = road_rows(t)
    return graph.crossings(t.f_segments, r.select("way_id", "z_layer", "z_level", *LEVEL_TAGS), graph.junction_members(r, HALF), HALF, 2000.0, LEVEL_TAGS)


@query("crossings", f"SELECT a, b, CAST(floor(mx + 0.25) AS BIGINT) AS mx, CAST(floor(my + 0.25) AS BIGINT) AS my, status, differ FROM {CROSSINGS} c")
def _(t):
    return crossing_rows(t).select("a", "b", F.floor(F.col("mx") + 0.25).cast("bigint").alias("mx"), F.floor(F.col("my") + 0.25).cast("bigint").alias("my"), "status", "differ")


# Drivable: carriageway classes at least 3.5 m wide.
DRIVE = "(SELECT s.*, CAST((s.way_id % 5 + 3) * 100 AS DOUBLE) AS width FROM f_segments s JOIN f_ways w ON w.way_id = s.way_id WHERE highway NOT IN ('footway', 'path') AND s.way_id % 5 + 3 > 3)"
NAV = f"""WITH p AS (SELECT place_id, width, x1 + (x2 - x1) * k / n AS x1, y1 + (y2 - y1) * k / n AS y1, x1 + (x2 - x1) * (k + 1) / n AS x2, y1 + (y2 - y1) * (k + 1) / n AS y2 FROM (SELECT *, CAST(greatest(1, ceil(sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) / 1200)) AS BIGINT) AS n FROM {DRIVE} d) q, LATERAL (SELECT unnest(range(0, n)) AS k) g),
  e AS (SELECT place_id, x1 AS x, y1 AS y FROM p UNION ALL SELECT place_id, x2, y2 FROM p),
  nd AS (SELECT place_id, floor(x / 230) AS bi, floor(y / 230) AS bj, min({{'x': x, 'y': y}}) AS c, place_id * 100000000 + (floor(x / 230) + 1000) * 10000 + floor(y / 230) + 1000 AS nid FROM e GROUP BY place_id, floor(x / 230), floor(y / 230)),
  nx AS (SELECT place_id, bi, bj, nid, c.x AS x, c.y AS y FROM nd), bad AS (SELECT nid FROM {poly_dist_sql('nx', ['nid'])} d WHERE inside OR d2 <= 70 * 70), ok AS (SELECT * FROM nx WHERE nid NOT IN (SELECT nid FROM bad)),
  l AS (SELECT place_id, least(sa, sb) AS s, greatest(sa, sb) AS t, max(width) AS width FROM (SELECT place_id, width, place_id * 100000000 + (floor(x1 / 230) + 1000) * 10000 + floor(y1 / 230) + 1000 AS sa, place_id * 100000000 + (floor(x2 / 230) + 1000) * 10000 + floor(y2 / 230) + 1000 AS sb FROM p) z WHERE sa <> sb GROUP BY 1, 2, 3),
  pl AS (SELECT l.*, a.bi AS ai, a.bj AS aj, b.bi AS bi, b.bj AS bj, sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS cost, (a.x + b.x) / 2 AS x, (a.y + b.y) / 2 AS y, s * 1000003 + t AS lid FROM l JOIN ok a ON a.nid = l.s JOIN ok b ON b.nid = l.t),
  hit AS (SELECT lid FROM {poly_dist_sql('pl', ['lid'])} d WHERE inside OR d2 <= 80 * 80)"""


@query("nav_graph", NAV + f" SELECT place_id, CAST(ai AS BIGINT) AS ai, CAST(aj AS BIGINT) AS aj, CAST(bi AS BIGINT) AS bi, CAST(bj AS BIGINT) AS bj, CAST(width AS BIGINT) AS width, {b('cost * 10', 'cost_mm')} FROM pl WHERE lid NOT IN (SELECT lid FROM hit)")
def _(t):
    drivable = t.f_ways.filter("highway NOT IN ('footway', 'path')").select("way_id")
    s = t.f_segments.join(drivable, "way_id", "left_semi").withColumn("width", ((F.col("way_id") % 5 + 3) * 100).cast("double")).filter("width >= 350")
    links = graph.nav_graph(s, buildings(t), 1200.0, 230.0, 70.0, 80.0, CHUNK)[1]
    return links.select("place_id", "ai", "aj", "bi", "bj", F.col("width").cast("bigint").alias("width"), half_up(F.col("cost") * 10).alias("cost_mm"))


GRAPH = f"(SELECT place_id, a, b, min(length) AS length FROM (SELECT place_id, least(a, b) AS a, greatest(a, b) AS b, length FROM {PAIRS} p) q GROUP BY place_id, a, b)"


def junction_graph(t):
    return graph_parts(t)[1]


def graph_parts(t):
    """Vertices and edges of the junction graph; the junctions are found once for both."""
    nodes = cut_lineage(junction_nodes(t))
    return nodes.select("place_id", F.col("node_id").alias("v")), graph.junction_graph(t.lines, nodes)


@query("junction_graph", f"SELECT place_id, a, b, {b('length * 10', 'length_mm')} FROM {GRAPH} g")
def _(t):
    return junction_graph(t).select("place_id", "a", "b", half_up(F.col("length") * 10).alias("length_mm"))


# Reachability by a set-based recursion: (root, vertex) pairs deduplicated per step, then the lowest root.
COMPONENTS = f"""e AS (SELECT place_id, a AS u, b AS v FROM {GRAPH} g UNION ALL SELECT place_id, b, a FROM {GRAPH} g), vt AS (SELECT DISTINCT place_id, node_id AS v FROM f_vertices SEMI JOIN (SELECT place_id, node_id FROM f_vertices GROUP BY 1, 2 HAVING count(DISTINCT way_id) > 1) j USING (place_id, node_id)),
  r AS (SELECT place_id, v, v AS root FROM vt UNION SELECT r.place_id, e.v, r.root FROM r JOIN e ON e.place_id = r.place_id AND e.u = r.v WHERE r.root < e.v),
  comp AS (SELECT place_id, v, min(root) AS component FROM r GROUP BY 1, 2)"""


@query("connected_components", "WITH RECURSIVE " + COMPONENTS + " SELECT place_id, v, component FROM comp")
def _(t):
    return graph.connected_components(*graph_parts(t))


@query("graph_summary", "WITH RECURSIVE " + COMPONENTS + f""", g AS (SELECT * FROM {GRAPH} g) SELECT p.place_id, CAST(count(*) AS BIGINT) AS vertices, CAST(any_value(e.n) AS BIGINT) AS edges, CAST(any_value(c.k) AS BIGINT) AS components, CAST(any_value(c.l) AS BIGINT) AS largest, CAST(any_value(d.m) AS BIGINT) AS max_degree
  FROM vt p LEFT JOIN (SELECT place_id, count(*) AS n FROM g GROUP BY 1) e ON e.place_id = p.place_id LEFT JOIN (SELECT place_id, count(*) AS k, max(n) AS l FROM (SELECT place_id, component, count(*) AS n FROM comp GROUP BY 1, 2) z GROUP BY 1) c ON c.place_id = p.place_id
  LEFT JOIN (SELECT place_id, max(n) AS m FROM (SELECT place_id, u, count(*) AS n FROM e GROUP BY 1, 2) y GROUP BY 1) d ON d.place_id = p.place_id GROUP BY p.place_id""".replace("FROM e GROUP BY 1, 2) y", "FROM (SELECT place_id, a AS u FROM g UNION ALL SELECT place_id, b FROM g) x GROUP BY 1, 2) y"))
def _(t):
    nodes, g = graph_parts(t)
    g = cut_lineage(g)
    return graph.graph_summary(nodes, g, graph.connected_components(nodes, g))


@query("degree_histogram", f"SELECT place_id, CAST(d AS BIGINT) AS degree, CAST(count(*) AS BIGINT) AS n FROM (SELECT place_id, u, count(*) AS d FROM (SELECT place_id, a AS u FROM {GRAPH} g UNION ALL SELECT place_id, b FROM {GRAPH} g) x GROUP BY 1, 2) y GROUP BY 1, 2")
def _(t):
    return graph.degree_histogram(junction_graph(t))


@query("shortest_paths", f"""WITH RECURSIVE e AS (SELECT place_id, a AS u, b AS v, length FROM {GRAPH} g UNION ALL SELECT place_id, b, a, length FROM {GRAPH} g),
  s AS (SELECT place_id, arg_min(u, u - 1000000000 * n) AS v FROM (SELECT place_id, u, count(*) AS n FROM e GROUP BY 1, 2) d GROUP BY place_id),
  bf AS (SELECT place_id, v, 0.0::DOUBLE AS dist, 0 AS k FROM s UNION ALL SELECT place_id, v, dist, k FROM (SELECT z.place_id, z.v, min(z.dist) AS dist, z.k FROM (
    SELECT bf.place_id, e.v, bf.dist + e.length AS dist, bf.k + 1 AS k FROM bf JOIN e ON e.place_id = bf.place_id AND e.u = bf.v WHERE bf.k < 300) z GROUP BY z.place_id, z.v, z.k) q)
  SELECT place_id, v, {b('min(dist) * 10', 'dist_mm')} FROM bf GROUP BY place_id, v""")
def _(t):
    g = cut_lineage(junction_graph(t).select("place_id", "a", "b", "length"))
    return graph.shortest_paths(g, hub(g)).select("place_id", "v", half_up(F.col("dist") * 10).alias("dist_mm"))


def hub(g):
    """The best connected vertex of each place (lowest id on a tie) as the source of a route."""
    degree = g.select("place_id", F.explode(F.array("a", "b")).alias("v")).groupBy("place_id", "v").agg(F.count("*").alias("n"))
    return degree.groupBy("place_id").agg(F.max_by("v", F.struct("n", -F.col("v"))).alias("v")).withColumn("route_id", F.lit(0))


# A route per place: from the junction nearest the lower left corner to the one nearest the upper right, both in the largest component. Lengths in whole
# millimetres, so that sums are exact and equal ways are told apart by hops and the lowest vertex before.
WHOLE = f"(SELECT g.place_id, a, b, floor(length * 10 + 0.5) AS length, way_id FROM (SELECT place_id, a, b, length, arg_min(way_id, {{'l': length, 'w': way_id}}) OVER (PARTITION BY place_id, a, b) AS way_id, row_number() OVER (PARTITION BY place_id, a, b ORDER BY length, way_id) AS rn FROM (SELECT place_id, least(a, b) AS a, greatest(a, b) AS b, length, way_id FROM {PAIRS} p) x) g WHERE rn = 1)"
CORNERED = "sqrt(pow(x - ({s}), 2) + pow(y - ({s}), 2))"
ROUTES = "WITH RECURSIVE " + COMPONENTS + f""", gw AS MATERIALIZED (SELECT * FROM {WHOLE} q), ew AS (SELECT place_id, a AS u, b AS v, length FROM gw UNION ALL SELECT place_id, b, a, length FROM gw),
  main AS (SELECT place_id, arg_max(component, n * 1000000000 - component) AS component FROM (SELECT place_id, component, count(*) AS n FROM comp GROUP BY 1, 2) c GROUP BY place_id),
  spot AS (SELECT DISTINCT c.place_id, c.v, f.x, f.y FROM comp c JOIN main USING (place_id, component) JOIN f_vertices f ON f.place_id = c.place_id AND f.node_id = c.v),
  pick AS (SELECT place_id, arg_min(v, {{'d': {CORNERED.format(s=-HALF)}, 'v': v}}) AS s, arg_min(v, {{'d': {CORNERED.format(s=HALF)}, 'v': v}}) AS t FROM spot GROUP BY place_id),
  bf AS (SELECT place_id, s AS v, 0.0::DOUBLE AS dist, 0 AS k FROM pick UNION ALL SELECT place_id, v, dist, k FROM (SELECT z.place_id, z.v, min(z.dist) AS dist, z.k FROM (
    SELECT bf.place_id, ew.v, bf.dist + ew.length AS dist, bf.k + 1 AS k FROM bf JOIN ew ON ew.place_id = bf.place_id AND ew.u = bf.v WHERE bf.k < 300) z GROUP BY z.place_id, z.v, z.k) q),
  lab AS MATERIALIZED (SELECT place_id, v, min(dist) AS dist, arg_min(k, {{'d': dist, 'k': k}}) AS hops FROM bf GROUP BY place_id, v),
  par AS MATERIALIZED (SELECT l.place_id, l.v, l.dist, l.hops, min(o.v) AS parent FROM lab l LEFT JOIN (ew JOIN lab o ON o.place_id = ew.place_id AND o.v = ew.u) ON ew.place_id = l.place_id AND ew.v = l.v AND o.dist + ew.length = l.dist AND o.hops + 1 = l.hops GROUP BY 1, 2, 3, 4),
  way AS (SELECT p.place_id, par.v, par.hops, par.dist, par.parent FROM pick p JOIN par ON par.place_id = p.place_id AND par.v = p.t UNION ALL SELECT par.place_id, par.v, par.hops, par.dist, par.parent FROM way JOIN par ON par.place_id = way.place_id AND par.v = way.parent)"""


def route_rows(t):
    nodes, g = graph_parts(t)
    g = cut_lineage(g.withColumn("length", F.floor(F.col("length") * 10 + 0.5).cast("double")))
    parts = cut_lineage(graph.connected_components(nodes, g))
    main = parts.groupBy("place_id", "component").agg(F.count("*").alias("n")).groupBy("place_id").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("component"))
    where = t.f_vertices.select("place_id", F.col("node_id").alias("v"), "x", "y").distinct()
    spots = parts.join(main, ["place_id", "component"]).join(where, ["place_id", "v"])
    far = lambda s: F.sqrt((F.col("x") - s) * (F.col("x") - s) + (F.col("y") - s) * (F.col("y") - s))
    ends = cut_lineage(spots.groupBy("place_id").agg(F.min_by("v", F.struct(far(-HALF), "v")).alias("s"), F.min_by("v", F.struct(far(HALF), "v")).alias("t")).withColumn("route_id", F.lit(0)))
    paths = graph.shortest_paths(g, ends.select("place_id", "route_id", F.col("s").alias("v")))
    return graph.routes(paths, ends.select("place_id", "route_id", F.col("t").alias("v"))), g


@query("routes", ROUTES + " SELECT place_id, v, CAST(hops AS BIGINT) AS hops, CAST(dist AS BIGINT) AS dist_mm, parent FROM way")
def _(t):
    return route_rows(t)[0].select("place_id", "v", "hops", F.col("dist").cast("bigint").alias("dist_mm"), "parent")


@query("route_summary", ROUTES + """, leg AS (SELECT w.place_id, w.hops, gw.way_id, lag(gw.way_id) OVER (PARTITION BY w.place_id ORDER BY w.hops) AS was FROM way w JOIN gw ON gw.place_id = w.place_id AND gw.a = least(w.v, w.parent) AND gw.b = greatest(w.v, w.parent))
  SELECT p.place_id, p.s AS source, p.t AS target, CAST(w.dist AS BIGINT) AS length_mm, CAST(w.n AS BIGINT) AS junctions, CAST(coalesce(l.n, 0) AS BIGINT) AS roads FROM pick p JOIN (SELECT place_id, max(dist) AS dist, count(*) AS n FROM way GROUP BY 1) w USING (place_id)
  LEFT JOIN (SELECT place_id, count(*) AS n FROM leg WHERE was IS NULL OR was <> way_id GROUP BY 1) l USING (place_id)""")
def _(t):
    out = graph.route_summary(*route_rows(t))
    return out.select("place_id", "source", "target", F.col("length").cast("bigint").alias("length_mm"), "junctions", F.col("roads").cast("bigint").alias("roads"))
