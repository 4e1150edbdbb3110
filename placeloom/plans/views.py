"""Feature views over the star-schema tables.

Each view is one SQL text in the common subset of Spark SQL and DuckDB (`DIV` is rewritten to `//` there). In
Spark the text reads DataFrames, in the check it becomes a CTE. Coordinates are centimetres as DOUBLE.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from placeloom.functions import shapes as sh

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

# Tables of few bytes whose rows become many (outlines and boxes to cells, names to pieces), by their key.
COMPACT = {"part": "p_partkey", "supplier": "s_suppkey", "customer": "c_custkey"}

HALF = 50000.0      # half side of a place, cm
CHUNK = 6000.0      # chunk side, cm

VIEWS: dict[str, str] = {}

VIEWS["f_places"] = """
SELECT place_id, CONCAT('Place ', place_id) AS name,
  CASE place_id % 4 WHEN 0 THEN 'se' WHEN 1 THEN 'de' WHEN 2 THEN 'it' ELSE 'us' END AS country,
  CAST(50 + place_id % 20 AS DOUBLE) AS lat0, CAST(10 + place_id % 15 AS DOUBLE) AS lon0,
  CAST(1000 AS DOUBLE) AS size_m
FROM (SELECT DISTINCT o_orderkey DIV 600 AS place_id FROM orders) pl"""

VIEWS["f_vertices"] = """
SELECT place_id, way_id, seq, gx, gy, (gx + 200) * 1000 + (gy + 200) AS node_id,
  CAST(gx * 1000 AS DOUBLE) AS x, CAST(gy * 1000 AS DOUBLE) AS y
FROM (SELECT l_orderkey DIV 600 AS place_id, l_orderkey AS way_id,
        CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS BIGINT) AS seq,
        (l_orderkey * 7919) % 101 - 50 + CAST(sum(l_partkey % 3 - 1) OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS gx,
        (l_orderkey * 104729) % 101 - 50 + CAST(sum(l_suppkey % 3 - 1) OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS gy
      FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem) dl) v"""

VIEWS["f_segments"] = """
SELECT place_id, way_id, seq, x1, y1, x2, y2
FROM (SELECT place_id, way_id, seq, x AS x1, y AS y1,
        lead(x) OVER (PARTITION BY way_id ORDER BY seq) AS x2, lead(y) OVER (PARTITION BY way_id ORDER BY seq) AS y2
      FROM f_vertices) s
WHERE x2 IS NOT NULL AND (x1 <> x2 OR y1 <> y2)"""

VIEWS["f_ways"] = """
SELECT o_orderkey DIV 600 AS place_id, o_orderkey AS way_id,
  CASE o_orderkey % 10 WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary' WHEN 2 THEN 'tertiary' WHEN 3 THEN 'residential'
    WHEN 4 THEN 'service' WHEN 5 THEN 'footway' WHEN 6 THEN 'path' WHEN 7 THEN 'pedestrian' WHEN 8 THEN 'track'
    ELSE 'construction' END AS highway,
  CONCAT('Street ', o_orderkey % 40) AS name,
  CASE WHEN o_orderkey % 13 = 0 THEN CASE WHEN o_orderkey % 26 = 0 THEN '1' ELSE 'x1' END END AS layer,
  CASE WHEN o_orderkey % 13 = 1 THEN 'yes' END AS bridge,
  CASE WHEN o_orderkey % 17 = 3 THEN 'yes' WHEN o_orderkey % 17 = 5 THEN 'building_passage' END AS tunnel,
  CASE WHEN o_orderkey % 29 = 0 THEN 'yes' END AS covered,
  CASE WHEN o_orderkey % 23 = 0 THEN '0;1' WHEN o_orderkey % 23 = 1 THEN '1' END AS level,
  CASE o_orderkey % 5 WHEN 1 THEN CONCAT(4 + o_orderkey % 6, ',5 m') WHEN 2 THEN CONCAT(15 + o_orderkey % 10, ' ft')
    WHEN 3 THEN CONCAT(5 + o_orderkey % 7, '') WHEN 4 THEN 'wide' END AS width,
  CASE WHEN o_orderkey % 4 = 1 THEN '2' END AS lanes,
  CASE o_orderkey % 7 WHEN 1 THEN 'asphalt' WHEN 2 THEN 'sett' WHEN 3 THEN 'gravel' WHEN 4 THEN 'paving_stones'
    WHEN 5 THEN 'dirt' END AS surface,
  CASE o_orderkey % 6 WHEN 1 THEN 'no' WHEN 2 THEN 'left' WHEN 3 THEN 'right' WHEN 4 THEN 'both'
    WHEN 5 THEN 'separate' END AS sidewalk,
  CASE o_orderkey % 9 WHEN 0 THEN 'parking_aisle' WHEN 1 THEN 'driveway' WHEN 2 THEN 'alley' END AS service,
  CASE WHEN o_orderkey % 19 = 0 THEN 'yes' END AS area,
  o_orderkey % 11 <> 0 AS has_nodes
FROM orders"""

VIEWS["f_buildings"] = """
SELECT p_partkey DIV 80 AS place_id, p_partkey AS b_id, p_partkey % 4 AS shape,
  CAST(((p_partkey * 7919) % 9001 - 4500) * 10 AS DOUBLE) AS x0, CAST(((p_partkey * 104729) % 9001 - 4500) * 10 AS DOUBLE) AS y0,
  800 + (p_partkey * 31) % 1700 AS w, 600 + (p_partkey * 17) % 1500 AS h,
  CASE p_partkey % 8 WHEN 0 THEN 'yes' WHEN 1 THEN 'house' WHEN 2 THEN 'apartments' WHEN 3 THEN 'industrial' WHEN 4 THEN 'church'
    WHEN 5 THEN 'garage' WHEN 6 THEN 'office' ELSE 'roof' END AS building,
  CASE WHEN p_partkey % 21 = 0 THEN 'yes' END AS building_part,
  CASE WHEN p_partkey % 3 = 0 THEN CONCAT(1 + p_partkey % 7, '') END AS levels_tag,
  CASE WHEN p_partkey % 5 = 0 THEN CONCAT(5 + p_partkey % 20, '.5 m') END AS height_tag,
  CASE WHEN p_partkey % 13 = 0 THEN '3' END AS min_height, CASE WHEN p_partkey % 16 = 0 THEN '1' END AS min_level,
  CASE WHEN p_partkey % 24 = 0 THEN 'place_of_worship' WHEN p_partkey % 24 = 6 THEN 'library' END AS amenity,
  CASE p_partkey % 6 WHEN 0 THEN 'brick' WHEN 1 THEN 'wood' WHEN 2 THEN 'timber_framing' WHEN 3 THEN 'unobtainium' END AS material,
  CASE p_partkey % 9 WHEN 0 THEN '#a33a2a' WHEN 1 THEN 'Red' WHEN 2 THEN 'fa0' WHEN 3 THEN 'no such colour' WHEN 4 THEN 'dark grey'
    WHEN 5 THEN '' END AS colour,
  CASE p_partkey % 7 WHEN 0 THEN 'gabled' WHEN 1 THEN 'Onion' WHEN 2 THEN 'skillion' WHEN 3 THEN 'weird' END AS roof_shape,
  CASE p_partkey % 10 WHEN 0 THEN 'copper' WHEN 1 THEN 'slate' WHEN 2 THEN 'tile' END AS roof_material,
  CASE WHEN p_partkey % 12 = 5 THEN '#345' END AS roof_colour,
  CASE WHEN p_partkey % 15 = 0 THEN '1.5' END AS roof_height,
  CASE WHEN p_partkey % 11 = 0 THEN p_name END AS name
FROM part"""

# Vertices as quarters of the box: shapes 0 and 1 rectangle, 2 without its upper right quarter, 3 with a centred hole.
VIEWS["f_bverts"] = """
SELECT b.place_id, b.b_id, CAST(t.ring AS BIGINT) AS ring, CAST(t.seq AS BIGINT) AS seq,
  b.x0 + (b.w * t.ux) DIV 4 AS x, b.y0 + (b.h * t.uy) DIV 4 AS y
FROM f_buildings b JOIN (VALUES
  (0,0,0,0,0),(0,0,1,4,0),(0,0,2,4,4),(0,0,3,0,4), (1,0,0,0,0),(1,0,1,4,0),(1,0,2,4,4),(1,0,3,0,4),
  (2,0,0,0,0),(2,0,1,4,0),(2,0,2,4,2),(2,0,3,2,2),(2,0,4,2,4),(2,0,5,0,4),
  (3,0,0,0,0),(3,0,1,4,0),(3,0,2,4,4),(3,0,3,0,4), (3,1,0,1,1),(3,1,1,1,3),(3,1,2,3,3),(3,1,3,3,1)) AS t(shape, ring, seq, ux, uy)
  ON b.shape = t.shape"""

VIEWS["f_bedges"] = """
SELECT place_id, b_id, ring, seq, x AS x1, y AS y1,
  coalesce(lead(x) OVER (PARTITION BY b_id, ring ORDER BY seq), first_value(x) OVER (PARTITION BY b_id, ring ORDER BY seq)) AS x2,
  coalesce(lead(y) OVER (PARTITION BY b_id, ring ORDER BY seq), first_value(y) OVER (PARTITION BY b_id, ring ORDER BY seq)) AS y2
FROM f_bverts"""

VIEWS["f_bstat"] = """
SELECT place_id, b_id, sum(x1 * y2 - x2 * y1) / 2 AS area,
  sum((x1 + x2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)) AS cx,
  sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)) AS cy,
  min(x1) AS xmin, min(y1) AS ymin, max(x1) AS xmax, max(y1) AS ymax
FROM f_bedges GROUP BY place_id, b_id"""

VIEWS["f_points"] = """
SELECT c_custkey DIV 60 AS place_id, c_custkey AS pt_id, CAST(((c_custkey * 7919) % 10001 - 5000) * 10 AS DOUBLE) AS x,
  CAST(((c_custkey * 104729) % 10001 - 5000) * 10 AS DOUBLE) AS y, c_mktsegment AS kind, c_acctbal AS priority, c_name AS name
FROM customer"""

VIEWS["f_areas"] = """
SELECT s_suppkey DIV 4 AS place_id, s_suppkey AS a_id, s_suppkey % 12 AS class, s_suppkey % 12 AS rank,
  CAST(((s_suppkey * 7919) % 9001 - 4500) * 10 AS DOUBLE) AS xmin, CAST(((s_suppkey * 104729) % 9001 - 4500) * 10 AS DOUBLE) AS ymin,
  CAST(((s_suppkey * 7919) % 9001 - 4500) * 10 + (800 + (s_suppkey * 31) % 1700) * 10 AS DOUBLE) AS xmax,
  CAST(((s_suppkey * 104729) % 9001 - 4500) * 10 + (600 + (s_suppkey * 17) % 1500) * 10 AS DOUBLE) AS ymax
FROM supplier"""

# 24 columns by 25 rows, 45 m apart, first node at (-520 m, -520 m).
VIEWS["f_raster"] = """
SELECT o_orderkey DIV 600 AS place_id, (o_orderkey % 600) DIV 24 AS j, (o_orderkey % 600) % 24 AS i,
  CASE WHEN o_orderkey % 17 <> 0 THEN CAST((o_orderkey * 7919) % 3000 AS DOUBLE) END AS z
FROM orders"""

VIEWS["f_packets"] = """
SELECT event_id, ts, user_id AS sender, user_id % 20 AS room, user_id,
  CASE event_type WHEN 'view' THEN 'state' WHEN 'click' THEN 'hit' WHEN 'purchase' THEN 'pickup' WHEN 'error' THEN 'death'
    WHEN 'signup' THEN 'join' ELSE event_type END AS type,
  (user_id * 7 + 1) % 150 AS target, value AS amount, props
FROM events"""

VIEWS["f_features"] = """
SELECT o_orderkey DIV 600 AS place_id, o_orderkey AS f_id,
  CASE o_orderkey % 9 WHEN 0 THEN 'node' WHEN 1 THEN 'relation' ELSE 'way' END AS etype,
  CASE o_orderkey % 11 WHEN 0 THEN 'grass' WHEN 1 THEN 'forest' WHEN 2 THEN 'farmland' WHEN 3 THEN 'cemetery' WHEN 4 THEN 'reservoir'
    WHEN 5 THEN 'brownfield' WHEN 6 THEN 'meadow' END AS landuse,
  CASE o_orderkey % 13 WHEN 0 THEN 'water' WHEN 1 THEN 'beach' WHEN 2 THEN 'wood' WHEN 3 THEN 'wetland' WHEN 4 THEN 'coastline'
    WHEN 5 THEN 'scrub' END AS nature,
  CASE o_orderkey % 7 WHEN 0 THEN 'park' WHEN 1 THEN 'pitch' WHEN 2 THEN 'playground' END AS leisure,
  CASE o_orderkey % 17 WHEN 0 THEN 'river' WHEN 1 THEN 'canal' WHEN 2 THEN 'stream' WHEN 3 THEN 'ditch' WHEN 4 THEN 'drain'
    WHEN 5 THEN 'riverbank' END AS waterway,
  CASE o_orderkey % 19 WHEN 0 THEN 'city_wall' WHEN 1 THEN 'wall' WHEN 2 THEN 'hedge' WHEN 3 THEN 'retaining_wall' WHEN 4 THEN 'fence' END AS barrier,
  CASE o_orderkey % 23 WHEN 0 THEN 'citywalls' WHEN 1 THEN 'castle' END AS historic,
  CASE o_orderkey % 29 WHEN 0 THEN 'pier' WHEN 1 THEN 'bridge' END AS man_made,
  CASE o_orderkey % 31 WHEN 0 THEN 'parking' WHEN 1 THEN 'grave_yard' WHEN 2 THEN 'marketplace' WHEN 3 THEN 'bench' END AS amenity,
  CASE WHEN o_orderkey % 62 = 0 THEN 'underground' END AS parking,
  CASE o_orderkey % 37 WHEN 0 THEN 'rail' WHEN 1 THEN 'platform' WHEN 2 THEN 'tram' END AS railway,
  CASE WHEN o_orderkey % 41 = 0 THEN 'square' END AS place,
  CASE o_orderkey % 43 WHEN 0 THEN 'residential' WHEN 1 THEN 'footway' END AS area_highway,
  CASE o_orderkey % 47 WHEN 0 THEN 'service' WHEN 1 THEN 'pedestrian' WHEN 2 THEN 'primary' END AS highway,
  CASE WHEN o_orderkey % 47 < 2 THEN 'yes' END AS area,
  CASE WHEN o_orderkey % 3 = 0 THEN 'sett' END AS surface,
  CASE WHEN o_orderkey % 53 = 0 THEN 'culvert' END AS tunnel, CASE WHEN o_orderkey % 59 = 0 THEN '-1' END AS layer,
  CASE WHEN o_orderkey % 5 = 0 THEN '2,5 m' END AS width, CASE WHEN o_orderkey % 6 = 0 THEN '3 m' END AS height,
  CASE o_orderkey % 61 WHEN 0 THEN 'Google Street View' WHEN 1 THEN 'survey 2020' END AS source,
  CASE WHEN o_orderkey % 67 = 0 THEN 'GSV image' END AS source_name
FROM orders"""

_DEPENDS = {name: [v for v in re.findall(r"\bf_[a-z_]+\b", text) if v != name] for name, text in VIEWS.items()}


def duck(text: str) -> str:
    return re.sub(r"\bDIV\b", "//", text)


def with_views(sql: str) -> str:
    """Prefix `sql` with the CTEs of the views it names (and of those they name)."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order or name not in VIEWS:
            return
        for other in _DEPENDS[name]:
            need(other)
        order.append(name)

    for name in re.findall(r"\bf_[a-z_]+\b", sql):
        need(name)
    ctes = [f"{name} AS ({duck(VIEWS[name])})" for name in order]
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        rest = body[5:]
        recursive = rest[:10].upper() == "RECURSIVE "
        rest = rest[10:] if recursive else rest
        return "WITH " + ("RECURSIVE " if recursive else "") + ", ".join(ctes + [rest])
    return ("WITH " + ", ".join(ctes) + " " if ctes else "") + body


class Tables:
    """The given tables and the views over them, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        made = self._made
        if name not in made:
            if name in TABLES:
                table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
                # A file of one row group is one task, however many rows follow from it.
                made[name] = table.repartition(COMPACT[name]) if name in COMPACT else table
            elif name in VIEWS:
                made[name] = self.sql(VIEWS[name], **({"lineitem": self._lines_by_order()} if name == "f_vertices" else {}))
            else:
                raise AttributeError(name)
        return made[name]

    def _lines_by_order(self) -> DataFrame:
        """One shuffle by order serves the distinct rows, the windows and what is grouped by way after them."""
        return self.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").repartition("l_orderkey")

    def sql(self, text: str, **given: DataFrame) -> DataFrame:
        """Run `text` with every table or view it names bound as a DataFrame, those `given` as they are."""
        names = {n for n in re.findall(r"\b[a-z_]+\b", text) if n in VIEWS or n in TABLES}
        used = {n: given[n] if n in given else getattr(self, n) for n in names if re.search(rf"\b(FROM|JOIN)\s+{n}\b", text)}
        bound = re.sub(r"\b(FROM|JOIN)\s+([a-z_]+)\b", lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in used else m[0], text)
        return self.spark.sql(bound, **used)

    # ------------------------------------------------------------------ nested forms
    @property
    def polygons(self) -> DataFrame:
        """Building outlines as `rings ARRAY<ARRAY<STRUCT<x,y>>>` (outer first), built without a shuffle."""
        def ring(*quarters):
            return F.array(*[F.struct((F.col("x0") + F.floor(F.col("w") * ux / 4)).alias("x"),
                                      (F.col("y0") + F.floor(F.col("h") * uy / 4)).alias("y")) for ux, uy in quarters])
        box = ring((0, 0), (4, 0), (4, 4), (0, 4))
        rings = (F.when(F.col("shape") < 2, F.array(box))
                 .when(F.col("shape") == 2, F.array(ring((0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4))))
                 .otherwise(F.array(box, ring((1, 1), (1, 3), (3, 3), (3, 1)))))
        return self.f_buildings.withColumn("rings", rings)

    @property
    def lines(self) -> DataFrame:
        """Ways as one row with `pts ARRAY<STRUCT<x,y>>` and `nodes ARRAY<BIGINT>`, as an extract holds them."""
        packed = self.f_vertices.groupBy("place_id", "way_id").agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y", "node_id"))).alias("v"))
        return sh.once(packed, pts=F.transform("v", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))), nodes=F.transform("v", lambda p: p["node_id"])).drop("v")

    @property
    def areas(self) -> DataFrame:
        corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
        return self.f_areas.withColumn("rings", F.array(F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax"))))

    @property
    def way_tags(self) -> DataFrame:
        """Ways with their tags as one MAP, as an extract holds them."""
        keys = ["highway", "name", "layer", "bridge", "tunnel", "covered", "level", "width", "lanes", "surface", "sidewalk",
                "service", "area"]
        pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.col(k) for k in keys]))
        return self.f_ways.select("place_id", "way_id", "has_nodes", F.map_filter(pairs, lambda k, v: v.isNotNull()).alias("tags"))

    @property
    def feature_tags(self) -> DataFrame:
        names = {c: c for c in self.f_features.columns if c not in ("place_id", "f_id", "etype")}
        names.update(nature="natural", area_highway="area:highway", source_name="source:name")
        pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in names.values()]), F.array(*[F.col(c) for c in names]))
        return self.f_features.select("place_id", "f_id", "etype", F.map_filter(pairs, lambda k, v: v.isNotNull()).alias("tags"))

    @property
    def building_tags(self) -> DataFrame:
        names = {"building": "building", "building_part": "building:part", "levels_tag": "building:levels", "height_tag": "height",
                 "min_height": "min_height", "min_level": "building:min_level", "amenity": "amenity",
                 "material": "building:material", "colour": "building:colour", "roof_shape": "roof:shape",
                 "roof_material": "roof:material", "roof_colour": "roof:colour", "roof_height": "roof:height", "name": "name"}
        pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in names.values()]), F.array(*[F.col(c) for c in names]))
        tags = F.map_filter(pairs, lambda k, v: v.isNotNull()).alias("tags")
        return self.polygons.select("place_id", "b_id", "rings", "w", "h", "shape", tags)
