"""Sources and sinks over the feature views. Documents are written from the given tables and read back."""
from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from placeloom.functions import catalogs as cat
from placeloom.functions.scalars import half_up
from placeloom.operators import geometry as geo
from placeloom.plans.q_geometry import CLIPPED
from placeloom.plans.registry import query
from placeloom.plans.views import CHUNK, HALF
from placeloom.sources import elements as el, files, sinks


def scratch(t) -> str:
    """A fresh folder beside the checkpoints of the cluster; a local one only where none is named and Spark runs in one process."""
    import uuid
    sc = t.spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or t.spark.conf.get("spark.checkpoint.dir", None)
    if not base and not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    return f"{base}/documents-{uuid.uuid4().hex}" if base else tempfile.mkdtemp(prefix="spark-")


def element_rows(t):
    """Nodes, ways and relations of each place as extract elements."""
    deg = lambda c: F.col(c) / 1e7
    none = lambda typ: F.lit(None).cast(typ)
    geom, mem = "array<struct<lat:double,lon:double>>", "array<struct<type:string,ref:bigint,role:string,geometry:array<struct<lat:double,lon:double>>>>"
    nodes = t.f_points.select("place_id", F.lit("node").alias("type"), F.col("pt_id").alias("id"), F.when(F.col("kind") != "MACHINERY", deg("y")).alias("lat"), deg("x").alias("lon"), F.create_map(F.lit("kind"), "kind").alias("tags"),
                              none("array<bigint>").alias("nodes"), none(geom).alias("geometry"), none(mem).alias("members"))
    shape = F.transform("pts", lambda p: F.struct((p["y"] / 1e7).alias("lat"), (p["x"] / 1e7).alias("lon")))
    ways = t.lines.join(t.way_tags.select("way_id", "tags", "has_nodes"), "way_id").select("place_id", F.lit("way").alias("type"), F.col("way_id").alias("id"), none("double").alias("lat"), none("double").alias("lon"), "tags", "nodes",
                                                                                         F.when(F.col("has_nodes"), shape).alias("geometry"), none(mem).alias("members"))
    rel = t.f_areas.select("place_id", F.lit("relation").alias("type"), F.col("a_id").alias("id"), none("double").alias("lat"), none("double").alias("lon"), F.create_map(F.lit("type"), F.lit("multipolygon")).alias("tags"), none("array<bigint>").alias("nodes"), none(geom).alias("geometry"),
                           F.array(F.struct(F.lit("way").alias("type"), F.col("a_id").alias("ref"), F.lit("outer").alias("role"), none(geom).alias("geometry"))).cast(mem).alias("members"))
    return nodes.unionByName(ways).unionByName(rel)


@query("read_elements", """SELECT 'way' AS what, way_id AS id, CAST(count(*) AS BIGINT) AS size FROM f_vertices JOIN f_ways USING (way_id) WHERE has_nodes GROUP BY way_id
  UNION ALL SELECT 'node', pt_id, 1 FROM f_points WHERE kind <> 'MACHINERY' UNION ALL SELECT 'relation', a_id, 1 FROM f_areas""")
def _(t):
    folder = scratch(t) + "/extract"
    # One element per line and document, so a place of any size is many documents and no group is gathered.
    one = element_rows(t).select(F.to_json(F.struct(F.array(F.struct("type", "id", "lat", "lon", "tags", "nodes", "geometry", "members")).alias("elements"))).alias("value"))
    one.write.mode("overwrite").text(folder)
    raw = t.spark.read.schema(el.DOCUMENT).json(folder).select(F.explode("elements").alias("e")).select("e.*")
    parts = el.split_elements(raw)
    return (parts["ways"].select(F.lit("way").alias("what"), "id", F.size("geometry").cast("bigint").alias("size"))
            .unionByName(parts["nodes"].select(F.lit("node").alias("what"), "id", F.lit(1).cast("bigint").alias("size")))
            .unionByName(parts["relations"].select(F.lit("relation").alias("what"), "id", F.size("members").cast("bigint").alias("size"))))


def raw_nodes(t):
    """Lattice nodes of all places (the id carries the place); every thirteenth is missing from the download."""
    n = t.f_vertices.select((F.col("place_id") * 1000000 + F.col("node_id")).alias("id"), (F.col("y") / 1e7).alias("lat"), (F.col("x") / 1e7).alias("lon")).distinct()
    return n.filter("NOT (id % 13 = 5)")


def assembled(t):
    ways = t.lines.select(F.col("way_id").alias("id"), F.transform(F.arrays_zip("nodes", F.array_repeat("place_id", F.size("nodes"))), lambda z: z["nodes"] + z["1"] * 1000000).alias("nodes"))
    return el.assemble_ways(ways, raw_nodes(t))


WAY_GEOM = """(SELECT way_id AS id, count(*) FILTER ((place_id * 1000000 + node_id) % 13 <> 5) AS found, count(*) AS refs, string_agg(CASE WHEN (place_id * 1000000 + node_id) % 13 <> 5 THEN CAST(gx AS VARCHAR) || ' ' || CAST(gy AS VARCHAR) END, ',' ORDER BY seq) AS shape FROM f_vertices GROUP BY way_id)"""


@query("assemble_ways", f"SELECT id, CAST(found AS BIGINT) AS found, found < refs AS incomplete, coalesce(shape, '') AS shape FROM {WAY_GEOM} w")
def _(t):
    text = F.array_join(F.transform(F.coalesce("geometry", F.array().cast("array<struct<lat:double,lon:double>>")), lambda p: F.concat_ws(" ", half_up(p["lon"] * 10000), half_up(p["lat"] * 10000))), ",")
    return assembled(t).select("id", F.coalesce(F.size("geometry"), F.lit(0)).cast("bigint").alias("found"), "incomplete", text.alias("shape"))


@query("assemble_relations", f"""SELECT o_orderkey AS id, CAST(count(*) FILTER (w.found > 0) AS BIGINT) AS with_geometry, bool_or(coalesce(w.found, 0) = 0) AS incomplete FROM orders, LATERAL (SELECT unnest([o_orderkey, o_orderkey + 1, o_orderkey + 2]) AS ref) r LEFT JOIN {WAY_GEOM} w ON w.id = r.ref GROUP BY o_orderkey""")
def _(t):
    members = F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda k: F.struct(F.lit("way").alias("type"), (F.col("o_orderkey") + k).alias("ref"), F.lit("outer").alias("role")))
    rel = t.orders.select(F.col("o_orderkey").alias("id"), members.alias("members"))
    out = el.assemble_relations(rel, assembled(t).filter("geometry IS NOT NULL"))
    return out.select("id", F.size(F.filter("members", lambda m: m["geometry"].isNotNull())).cast("bigint").alias("with_geometry"), "incomplete")


def extract_part(t, n):
    """Three overlapping downloads of one relation table; each holds the geometry of other members."""
    k = F.col("s_suppkey")
    g = lambda m: F.when((k + m) % 3 == n, F.array(F.struct((k * 1.0).alias("lat"), F.lit(float(n)).alias("lon"))))
    members = F.array(*[F.struct(F.lit("way").alias("type"), (k * 10 + m).alias("ref"), F.lit("outer").alias("role"), g(m).alias("geometry")) for m in range(3)])
    return t.supplier.filter(k % 4 != n).select(F.lit("relation").alias("type"), k.alias("id"), F.create_map(F.lit("src"), F.lit(str(n))).alias("tags"), members.alias("members"))


@query("merge_extracts", """SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 <> 0 THEN '0' ELSE '1' END AS src,
    concat_ws(',', CASE WHEN s_suppkey % 4 <> s_suppkey % 3 THEN '0:' || s_suppkey % 3 END, CASE WHEN s_suppkey % 4 <> (s_suppkey + 1) % 3 THEN '1:' || (s_suppkey + 1) % 3 END, CASE WHEN s_suppkey % 4 <> (s_suppkey + 2) % 3 THEN '2:' || (s_suppkey + 2) % 3 END) AS filled FROM supplier""")
def _(t):
    out = el.merge_extracts([extract_part(t, n) for n in range(3)])
    found = F.filter(F.transform("members", lambda m, k: F.when(m["geometry"].isNotNull(), F.concat_ws(":", k.cast("string"), F.get(m["geometry"], F.lit(0))["lon"].cast("int").cast("string")))), lambda v: v.isNotNull())
    return out.select("id", F.try_element_at("tags", F.lit("src")).alias("src"), F.array_join(found, ",").alias("filled"))


@query("complete_relations", "SELECT s_suppkey AS id, CAST(CASE WHEN s_suppkey % 3 = 1 THEN 2 ELSE 1 END AS INTEGER) AS members FROM supplier")
def _(t):
    one = F.array(F.lit(1))
    base = t.supplier.select(F.col("s_suppkey").alias("id"), one.alias("members"))
    fixes = t.supplier.filter("s_suppkey % 3 = 1").select(F.col("s_suppkey").alias("id"), F.array(F.lit(1), F.lit(2)).alias("members"))
    return el.complete_relations(base, fixes).select("id", F.size("members").alias("members"))


_Q = "CAST(least(greatest(floor(({v} + 50000) / 12500), 0), 7) AS BIGINT)"


@query("quadtree_partition", f"""WITH p AS (SELECT place_id, {_Q.format(v='x')} AS fi, {_Q.format(v='y')} AS fj FROM f_points), d AS (SELECT p.*, k.d, fi // CAST(pow(2, 3 - k.d) AS BIGINT) AS qi, fj // CAST(pow(2, 3 - k.d) AS BIGINT) AS qj FROM p CROSS JOIN (VALUES (0), (1), (2), (3)) k(d)),
  s AS (SELECT place_id, d, qi, qj, count(*) AS n FROM d GROUP BY 1, 2, 3, 4), c AS (SELECT d.place_id, d.fi, d.fj, min(d.d) AS depth FROM d JOIN s ON s.place_id = d.place_id AND s.d = d.d AND s.qi = d.qi AND s.qj = d.qj WHERE n <= 8 OR d.d = 3 GROUP BY 1, 2, 3)
  SELECT DISTINCT s.place_id, CAST(s.d AS INTEGER) AS depth, s.qi, s.qj, CAST(s.n AS BIGINT) AS n FROM c JOIN s ON s.place_id = c.place_id AND s.d = c.depth AND s.qi = c.fi // CAST(pow(2, 3 - c.depth) AS BIGINT) AND s.qj = c.fj // CAST(pow(2, 3 - c.depth) AS BIGINT)""")
def _(t):
    return el.quadtree_partition(t.f_points, (-HALF, -HALF, HALF, HALF), 8).select("place_id", "depth", "qi", "qj", "n")


@query("read_raster", "SELECT place_id, CAST(j AS BIGINT) AS j, CAST(i AS BIGINT) AS i, z FROM f_raster")
def _(t):
    # One row of the grid per document row, as a tiled download stores it.
    rows = t.f_raster.groupBy("place_id", "j").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("z", F.lit(float("nan"))).alias("z")))).alias("c"))
    grids = rows.select("place_id", F.col("j").alias("row"), F.lit(24).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("cols"), F.transform("c", lambda v: v["z"]).alias("z"))
    return files.raster_cells(grids).select("place_id", F.col("row").alias("j"), F.col("i").cast("bigint").alias("i"), "z")


@query("read_overrides", """SELECT 'building' AS scope, 'w' || b_id AS key, CAST(1 AS INTEGER) AS attrs FROM f_buildings UNION ALL SELECT 'road', 'w' || way_id, 1 FROM f_ways UNION ALL SELECT 'area', '0', 1 FROM f_areas UNION ALL SELECT 'default', '', 1 FROM f_places""")
def _(t):
    folder = scratch(t) + "/overrides"
    m = lambda key, name, value: F.create_map(key, F.create_map(F.lit(name), value))
    key = lambda c: F.concat(F.lit("w"), F.col(c).cast("string"))
    docs = [t.f_buildings.select(F.to_json(F.struct(m(key("b_id"), "style", F.lit("brick")).alias("buildings"))).alias("value")),
            t.f_ways.select(F.to_json(F.struct(m(key("way_id"), "width", F.lit("4")).alias("roads"))).alias("value")),
            t.f_areas.select(F.to_json(F.struct(F.array(F.struct(F.array(F.lit(50.0), F.lit(10.0)).alias("center"), F.lit(50.0).alias("radius"), F.create_map(F.lit("colour"), F.lit("red")).alias("buildings"))).alias("areas"))).alias("value")),
            t.f_places.select(F.to_json(F.struct(F.create_map(F.lit("max_levels"), F.lit("3")).alias("defaults"))).alias("value"))]
    for n, d in enumerate(docs):
        d.write.mode("append" if n else "overwrite").text(folder)
    return files.override_rows(t.spark.read.schema(files.OVERRIDES).json(folder)).select("scope", "key", F.size("attrs").alias("attrs"))


@query("verify_files", """SELECT 'd' || doc_id AS name, CASE doc_id % 6 WHEN 0 THEN 'stored changed' WHEN 1 THEN 'missing' WHEN 2 THEN 'stray' WHEN 3 THEN 'content changed' ELSE 'ok' END AS verdict FROM documents""")
def _(t):
    k = F.col("doc_id") % 6
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    content = F.encode("text", "UTF-8")
    have = t.documents.filter(k != 1).select(name.alias("name"), content.alias("content"))
    changed = F.when(k == 0, F.concat(content, F.lit("!").cast("binary"))).otherwise(content)
    want = t.documents.filter(k != 2).select(name.alias("name"), F.sha2(changed, 256).alias("stored_sha256"), F.length(content).cast("bigint").alias("stored_bytes"),
                                             F.sha2(F.when(k == 3, F.lit("x").cast("binary")).otherwise(content), 256).alias("sha256"), F.length(content).cast("bigint").alias("bytes"))
    return files.verify_files(have, want)


@query("read_text_with_fallback", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 AND regexp_matches(text, '[\\x{A0}-\\x{FF}]') AND NOT regexp_matches(text, '[^\\x{00}-\\x{7F}\\x{A0}-\\x{FF}]') THEN 'cp1252' ELSE 'utf-8' END AS encoding, md5(text) AS digest FROM documents")
def _(t):
    legacy = (F.col("doc_id") % 3 == 0) & F.col("text").rlike(r"[ -ÿ]") & ~F.col("text").rlike(r"[^\u0000-\u007F -ÿ]")
    # Texts that fit the legacy code page arrive in it for every third document.
    latin = F.encode(F.when(legacy, F.col("text")).otherwise(F.lit("")), "ISO-8859-1")
    raw = F.when(legacy, latin).otherwise(F.encode("text", "UTF-8"))
    out = files.decode_text(t.documents.select("doc_id", raw.alias("content")))
    return out.select("doc_id", "encoding", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("write_features", "SELECT place_id, CAST(floor(cx / 6000) AS INTEGER) AS chunk_i, CAST(floor(cy / 6000) AS INTEGER) AS chunk_j, b_id FROM f_bstat")
def _(t):
    folder = scratch(t) + "/features"
    b = geo.with_ring_stats(t.polygons.select("place_id", "b_id", "rings"))
    rows = b.select("place_id", F.floor(F.col("cx") / CHUNK).cast("int").alias("chunk_i"), F.floor(F.col("cy") / CHUNK).cast("int").alias("chunk_j"), "b_id", "area")
    sinks.write_features(rows, folder, ["b_id"])
    return t.spark.read.parquet(folder).select(F.col("place_id").cast("bigint").alias("place_id"), "chunk_i", "chunk_j", "b_id")


@query("write_canonical", """SELECT '{"class":' || class || ',"id":' || a_id || ',"place_id":' || place_id || '}' AS value FROM f_areas""")
def _(t):
    folder = scratch(t) + "/canonical"
    sinks.write_canonical(t.f_areas.select("place_id", F.col("a_id").alias("id"), "class"), folder, "id")
    return t.spark.read.text(folder)


@query("tile_rollup", """SELECT place_id, CASE WHEN b_id % 3 = 0 THEN 'base' ELSE 'c' || CAST(floor((xmin + xmax) / 2 / 6000) AS BIGINT) || '_' || CAST(floor((ymin + ymax) / 2 / 6000) AS BIGINT) END AS tile, CAST(min(xmin) AS BIGINT) AS x0, CAST(max(ymax) AS BIGINT) AS y1,
    CAST(sum(b_id % 100) AS BIGINT) AS triangles, CAST(count(*) AS BIGINT) AS objects FROM f_bstat GROUP BY 1, 2""")
def _(t):
    b = geo.with_ring_stats(t.polygons.select("place_id", "b_id", "rings"))
    objects = b.select("place_id", F.when(F.col("b_id") % 3 == 0, "base").alias("tile"), F.col("xmin").alias("x0"), F.col("ymin").alias("y0"), F.col("xmax").alias("x1"), F.col("ymax").alias("y1"), (F.col("b_id") % 100).alias("triangles"))
    return files.tile_rollup(objects, CHUNK).select("place_id", "tile", F.col("x0").cast("bigint").alias("x0"), F.col("y1").cast("bigint").alias("y1"), "triangles", "objects")


STEPS = ["fetch", "terrain", "prepare", "blender", "export", "tiles", "pack"]


@query("run_ledger", """SELECT room AS place_id, CASE max(k) WHEN 6 THEN 'ready' WHEN 5 THEN 'tiles' WHEN 4 THEN 'export' WHEN 3 THEN 'blender' WHEN 2 THEN 'prepare' WHEN 1 THEN 'terrain' ELSE 'fetch' END AS state, CAST(count(DISTINCT k) AS BIGINT) AS steps_done
  FROM (SELECT room, (sender % 8) % 7 AS k FROM f_packets) q GROUP BY room""")
def _(t):
    step = F.get(F.array(*[F.lit(s) for s in STEPS]), (F.col("sender") % 8 % 7).cast("int"))
    log = t.f_packets.select(F.col("room").alias("place_id"), step.alias("step"), F.col("ts").alias("done_at"))
    return files.run_ledger(log, STEPS).select("place_id", "state", "steps_done")


@query("pack_map", f"""SELECT 'area' AS what, a_id AS id, CAST(0 AS INTEGER) AS part, CASE class WHEN 0 THEN 'green' WHEN 1 THEN 'road' ELSE 'path' END AS kind, CAST(4 AS INTEGER) AS vertices, CAST(floor(xmin / 10 + 0.5) + floor(-ymin / 10 + 0.5) AS BIGINT) AS first FROM f_areas WHERE class < 3
  UNION ALL SELECT 'road', c.way_id, c.part_no, w.highway, c.vertices, NULL FROM ({CLIPPED}) c JOIN f_ways w ON w.way_id = c.way_id""")
def _(t):
    layer = F.when(F.col("class") == 0, "park").when(F.col("class") == 1, "asphalt").when(F.col("class") == 2, "paving")
    lines = t.lines.join(t.f_ways.select("way_id", F.col("highway").alias("kind")), "way_id").select("way_id", "kind", "pts")
    out = el.pack_map(lines, t.areas.select("a_id", layer.alias("layer"), "rings"), HALF, cat.MAP_KINDS)
    corner = half_up((F.get("p", F.lit(0))["x"] + F.get("p", F.lit(0))["z"]) * 10)
    return out.select("what", "id", "part", "kind", F.size("p").alias("vertices"), F.when(F.col("what") == "area", corner).alias("first"))
