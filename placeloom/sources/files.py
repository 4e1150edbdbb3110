"""Rasters, corrections, texts, manifests, ledgers."""
from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, LongType, MapType, StringType, StructField, StructType)

RASTER = StructType([StructField(n, t) for n, t in (
    ("source", StringType()), ("kind", StringType()), ("attribution", StringType()), ("frame", StringType()), ("x0", DoubleType()), ("y0", DoubleType()), ("step", DoubleType()),
    ("n", LongType()), ("lat0", DoubleType()), ("lon0", DoubleType()), ("dlat", DoubleType()), ("dlon", DoubleType()), ("rows", LongType()), ("cols", LongType()), ("z", ArrayType(DoubleType())))])


def raster_cells(grids: DataFrame) -> DataFrame:
    """Grid rows (n or cols, and z ARRAY) as cells (j, i, z); not-a-number becomes NULL."""
    keep = [c for c in grids.columns if c not in ("z", "n", "rows", "cols")]
    width = F.coalesce("n", "cols")
    return grids.select(*keep, width.alias("_w"), F.posexplode("z").alias("_k", "z")).select(
        *keep, F.floor(F.col("_k") / F.col("_w")).alias("j"), (F.col("_k") % F.col("_w")).alias("i"), F.when(~F.isnan("z"), F.col("z")).alias("z"))


def read_raster(spark: SparkSession, path: str) -> DataFrame:
    """Grid documents (square local, or latitude/longitude) as cells; one document per place, the file name tells which."""
    raw = spark.read.schema(RASTER).option("multiLine", True).json(path)
    return raster_cells(raw.withColumn("place", F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.json)?(\.gz)?$", 1)))


OVERRIDES = StructType([StructField("buildings", MapType(StringType(), MapType(StringType(), StringType()))), StructField("roads", MapType(StringType(), MapType(StringType(), StringType()))),
                        StructField("areas", ArrayType(StructType([StructField("center", ArrayType(DoubleType())), StructField("radius", DoubleType()), StructField("polygon", ArrayType(ArrayType(DoubleType()))),
                                                                   StructField("buildings", MapType(StringType(), StringType()))]))), StructField("defaults", MapType(StringType(), StringType()))])


def override_rows(documents: DataFrame) -> DataFrame:
    """Correction documents as rows (scope, key, attrs): buildings, roads, areas (key = position) and defaults."""
    keep = [c for c in documents.columns if c not in ("buildings", "roads", "areas", "defaults")]
    by_key = lambda scope: documents.select(*keep, F.lit(scope[:-1]).alias("scope"), F.explode(scope).alias("key", "attrs"))
    areas = documents.select(*keep, F.lit("area").alias("scope"), F.posexplode("areas").alias("_k", "_a")).select(*keep, "scope", F.col("_k").cast("string").alias("key"), F.col("_a.buildings").alias("attrs"))
    defaults = documents.filter(F.col("defaults").isNotNull()).select(*keep, F.lit("default").alias("scope"), F.lit("").alias("key"), F.col("defaults").alias("attrs"))
    return by_key("buildings").unionByName(by_key("roads")).unionByName(areas).unionByName(defaults)


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    return override_rows(spark.read.schema(OVERRIDES).option("multiLine", True).json(path))


@F.pandas_udf(StringType())
def _cp1252(raw: pd.Series) -> pd.Series:
    return raw.map(lambda b: bytes(b).decode("cp1252", "replace") if b is not None else None)


def decode_text(files: DataFrame) -> DataFrame:
    """`content BINARY` as text: UTF-8 when valid, else the Western legacy code page; the encoding is recorded. Only files that
    need the fallback go through Python."""
    marked = files.withColumn("_ok", F.is_valid_utf8(F.col("content").cast("string")))
    utf = marked.filter("_ok").withColumns({"text": F.col("content").cast("string"), "encoding": F.lit("utf-8")})
    rest = marked.filter("NOT _ok").withColumns({"text": _cp1252("content"), "encoding": F.lit("cp1252")})
    return utf.unionByName(rest).drop("_ok", "content")


def read_text_with_fallback(spark: SparkSession, path: str) -> DataFrame:
    return decode_text(spark.read.format("binaryFile").load(path).select("path", "content"))


CONTENT = StructType([StructField("sha256", StringType()), StructField("bytes", LongType()), StructField("readable", BooleanType())])


@F.pandas_udf(CONTENT)
def _content(name: pd.Series, raw: pd.Series) -> pd.DataFrame:
    import hashlib
    rows = []
    for n, b in zip(name, raw):
        try:
            data = zlib.decompress(bytes(b), 31) if n.endswith(".gz") else bytes(b)
            rows.append((hashlib.sha256(data).hexdigest(), len(data), True))
        except zlib.error:
            rows.append((None, None, False))
    return pd.DataFrame(rows, columns=["sha256", "bytes", "readable"])


def file_facts(files: DataFrame) -> DataFrame:
    """Stored and content digests of (name, content)."""
    out = files.select("name", F.sha2("content", 256).alias("stored_sha256"), F.length("content").cast("bigint").alias("stored_bytes"), _content("name", "content").alias("c"))
    return out.select("name", "stored_sha256", "stored_bytes", "c.sha256", "c.bytes", "c.readable")


def verify_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """One verdict per file: ok, missing, stray, unreadable, stored changed or content changed.
    `manifest(name, stored_sha256, stored_bytes, sha256, bytes)`."""
    have = file_facts(files)
    want = manifest.select("name", *[F.col(c).alias(f"w_{c}") for c in ("stored_sha256", "stored_bytes", "sha256", "bytes")])
    both = have.join(want, "name", "full")
    verdict = (F.when(F.col("stored_sha256").isNull(), "missing").when(F.col("w_stored_sha256").isNull(), "stray").when(~F.col("readable"), "unreadable")
               .when((F.col("stored_sha256") != F.col("w_stored_sha256")) | (F.col("stored_bytes") != F.col("w_stored_bytes")), "stored changed")
               .when((F.col("sha256") != F.col("w_sha256")) | (F.col("bytes") != F.col("w_bytes")), "content changed").otherwise("ok"))
    return both.select("name", verdict.alias("verdict"))


def tile_rollup(objects: DataFrame, cell: float) -> DataFrame:
    """Bounds, triangles and objects per tile; an object without a tile goes to the tile of its box centre.
    `objects(place_id, tile, x0, y0, x1, y1, triangles)`."""
    own = F.concat(F.lit("c"), F.floor((F.col("x0") + F.col("x1")) / 2 / cell).cast("string"), F.lit("_"), F.floor((F.col("y0") + F.col("y1")) / 2 / cell).cast("string"))
    return objects.groupBy("place_id", F.coalesce("tile", own).alias("tile")).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
                                                                                 F.sum("triangles").alias("triangles"), F.count("*").alias("objects"))


def run_ledger(log: DataFrame, steps: list[str]) -> DataFrame:
    """State of each place: `ready` once the last step is done, else the last finished step in order, else `new`; and the
    time each place last moved. `log(place_id, step, done_at)`."""
    order = F.create_map(*[F.lit(v) for k, s in enumerate(steps) for v in (s, k)])
    latest = log.groupBy("place_id", "step").agg(F.max("done_at").alias("done_at"))
    per = latest.groupBy("place_id").agg(F.max(F.try_element_at(order, F.col("step"))).alias("k"), F.max("done_at").alias("last_at"), F.count("*").alias("steps_done"))
    names = F.create_map(*[F.lit(v) for k, s in enumerate(steps) for v in (k, "ready" if k == len(steps) - 1 else s)])
    return per.select("place_id", F.coalesce(F.try_element_at(names, F.col("k")), F.lit("new")).alias("state"), "last_at", "steps_done")
