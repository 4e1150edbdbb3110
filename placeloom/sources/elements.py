"""Reading and completing map extracts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, MapType, StringType, StructField, StructType

from placeloom.functions import shapes as sh

LATLON = StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())])
MEMBER = StructType([StructField("type", StringType()), StructField("ref", LongType()), StructField("role", StringType()),
                     StructField("geometry", ArrayType(LATLON))])
ELEMENT = StructType([StructField("type", StringType()), StructField("id", LongType()), StructField("lat", DoubleType()), StructField("lon", DoubleType()),
                      StructField("tags", MapType(StringType(), StringType())), StructField("nodes", ArrayType(LongType())),
                      StructField("geometry", ArrayType(LATLON)), StructField("members", ArrayType(MEMBER))])
DOCUMENT = StructType([StructField("elements", ArrayType(ELEMENT))])


def read_elements(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Extract documents ({"elements": [...]}, plain or gzip) as three tables. An element without what its type needs
    (way: geometry, relation: members, node: a position) is left out. The file name tells the place."""
    raw = spark.read.schema(DOCUMENT).option("multiLine", True).json(path)
    el = raw.select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.json)?(\.gz)?$", 1).alias("place"), F.explode("elements").alias("e")).select("place", "e.*")
    return split_elements(el)


def split_elements(el: DataFrame) -> dict[str, DataFrame]:
    keep = [c for c in ("place", "place_id") if c in el.columns]
    return {"ways": el.filter((F.col("type") == "way") & (F.size("geometry") > 0)).select(*keep, "id", "tags", "nodes", "geometry"),
            "relations": el.filter((F.col("type") == "relation") & (F.size("members") > 0)).select(*keep, "id", "tags", "members"),
            "nodes": el.filter((F.col("type") == "node") & F.col("lat").isNotNull()).select(*keep, "id", "lat", "lon", "tags")}


def assemble_ways(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Geometry of each way from its node references in order. A missing node leaves the geometry short and the way is
    flagged. Each way's list is bounded by its own reference list; positions are packed per (way, block of 256) first."""
    refs = sh.unnest(ways.select("id", "nodes"), F.col("nodes"), "ref", "pos").drop("nodes")
    found = refs.join(nodes.select(F.col("id").alias("ref"), "lat", "lon"), "ref")
    blocks = found.groupBy("id", F.floor(F.col("pos") / 256).alias("blk")).agg(F.array_sort(F.collect_list(F.struct("pos", "lat", "lon"))).alias("part"))
    packed = blocks.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("blk", "part"))).alias("parts"))
    geometry = F.transform(F.flatten(F.transform("parts", lambda p: p["part"])), lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon")))
    out = ways.join(packed.select("id", geometry.alias("geometry")), "id", "left")
    return out.withColumn("incomplete", F.coalesce(F.size("geometry"), F.lit(0)) < F.size("nodes"))


def assemble_relations(relations: DataFrame, ways: DataFrame) -> DataFrame:
    """Members with the geometry of their way; a relation with a way member that has none is flagged."""
    flat = sh.unnest(relations.select("id", "members"), F.col("members"), "m", "pos").select("id", "pos", "m.type", "m.ref", "m.role")
    way = ways.select(F.lit("way").alias("type"), F.col("id").alias("ref"), "geometry")
    full = flat.join(way, ["type", "ref"], "left")
    packed = full.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "type", "ref", "role", "geometry"))).alias("members"),
                                    F.bool_or((F.col("type") == "way") & F.col("geometry").isNull()).alias("incomplete"))
    return relations.drop("members").join(packed, "id", "left")


def merge_extracts(parts: list[DataFrame]) -> DataFrame:
    """Overlapping downloads of one element table: the first source wins per (type, id); member geometry it lacks comes
    from later copies."""
    rows = None
    for n, part in enumerate(parts):
        part = part.select("type", "id", "tags", "members", F.lit(n).alias("src"))
        rows = part if rows is None else rows.unionByName(part)
    first = rows.groupBy("type", "id").agg(F.min_by(F.struct("tags", "members"), "src").alias("f"))
    known = sh.unnest(rows, F.col("members"), "m", "pos").filter(F.col("m.geometry").isNotNull()).groupBy("type", "id", "pos").agg(F.min_by("m.geometry", "src").alias("g"))
    fills = known.groupBy("type", "id").agg(F.map_from_entries(F.collect_list(F.struct("pos", "g"))).alias("fill"))
    merged = first.join(fills, ["type", "id"], "left").select("type", "id", "f.tags", "f.members", "fill")
    done = F.transform("members", lambda m, k: F.struct(m["type"].alias("type"), m["ref"].alias("ref"), m["role"].alias("role"),
                                                       F.coalesce(m["geometry"], F.try_element_at("fill", k)).alias("geometry")))
    return merged.select("type", "id", "tags", done.alias("members"))


def complete_relations(base: DataFrame, fixes: DataFrame) -> DataFrame:
    """Relations replaced by their completed copies, where there is one."""
    fixed = fixes.select("id", F.col("members").alias("_m")).dropDuplicates(["id"])
    return base.join(fixed, "id", "left").withColumn("members", F.coalesce("_m", "members")).drop("_m")


def quadtree_partition(points: DataFrame, box: tuple[float, float, float, float], cap: int, max_depth: int = 3) -> DataFrame:
    """Quarters of a box, each split while it holds more than `cap` points, at most `max_depth` times: (place, depth, qi, qj, n).

    Points are counted once in the smallest quarters; the coarser counts are sums of those."""
    x0, y0, x1, y1 = box
    n = 2 ** max_depth
    cell = lambda v, lo, hi: F.least(F.greatest(F.floor((F.col(v) - lo) / ((hi - lo) / n)), F.lit(0)), F.lit(n - 1))
    fine = points.groupBy("place_id", cell("x", x0, x1).alias("fi"), cell("y", y0, y1).alias("fj")).agg(F.count("*").alias("n"))
    depths = F.transform(F.sequence(F.lit(0), F.lit(max_depth)), lambda d: F.struct(
        d.alias("depth"), F.floor(F.col("fi") / F.pow(F.lit(2.0), F.lit(max_depth) - d)).alias("qi"), F.floor(F.col("fj") / F.pow(F.lit(2.0), F.lit(max_depth) - d)).alias("qj")))
    per = fine.select("place_id", "n", "fi", "fj", F.explode(depths).alias("d")).select("place_id", "n", "fi", "fj", "d.*")
    sums = per.groupBy("place_id", "depth", "qi", "qj").agg(F.sum("n").alias("total"))
    stops = per.join(sums, ["place_id", "depth", "qi", "qj"]).filter((F.col("total") <= cap) | (F.col("depth") == max_depth))
    chosen = stops.groupBy("place_id", "fi", "fj").agg(F.min(F.struct("depth", "qi", "qj", "total")).alias("s"))
    return chosen.select("place_id", "s.depth", "s.qi", "s.qj", F.col("s.total").alias("n")).distinct()


def pack_map(lines: DataFrame, layers: DataFrame, half: float, kinds: dict[str, str]) -> DataFrame:
    """Consumer map rows (what, id, part, kind, p): roads clipped 4 m inside the place and longer than 1 m, ground layers
    with their map kind; axes (x, -y), rounded to 0.1 m. Coordinates in centimetres."""
    from placeloom.functions.scalars import lookup
    from placeloom.operators.geometry import clip_lines
    def flip(pts: Column) -> Column:
        tenth = lambda v: F.floor(v / 10 + 0.5) / 10
        return F.transform(pts, lambda p: F.struct(tenth(p["x"]).alias("x"), tenth(-p["y"]).alias("z")))
    inner = half - 400.0
    roads = clip_lines(lines, (-inner, -inner, inner, inner), 100.0).select(F.lit("road").alias("what"), F.col("way_id").alias("id"), F.col("part_no").alias("part"), "kind", flip(F.col("part")).alias("p"))
    rings = sh.unnest(layers.withColumn("kind", lookup(kinds, F.col("layer"))).filter("kind IS NOT NULL"), F.col("rings"), "_r", "part")
    return roads.unionByName(rings.select(F.lit("area").alias("what"), F.col("a_id").alias("id"), "part", "kind", flip(F.col("_r")).alias("p")))
