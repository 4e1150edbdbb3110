"""Content identifiers and deterministic output."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def canonical_json(df: DataFrame, columns: list[str] | None = None):
    """JSON text of a row with its keys in alphabetical order."""
    return F.to_json(F.struct(*sorted(columns or df.columns)), {"ignoreNullFields": "false"})


def content_ids(df: DataFrame, prefix: str, columns: list[str] | None = None) -> DataFrame:
    digest = F.sha1(canonical_json(df, columns).cast("binary"))
    return df.withColumn("content_id", F.concat(F.lit(prefix + "-"), F.substring(digest, 1, 12)))


def write_features(df: DataFrame, path: str, sort_by: list[str], mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet clustered by (place, chunk). Rows are range-partitioned on (place, chunk, `sort_by`), so a dense place spreads
    over many tasks, and sorted, so a reader prunes files and row groups by their minima and maxima. Folders per chunk would
    be millions of small files; `partition_by` adds coarse ones (a region, a bucket of places) where a catalogue wants them."""
    keys = ["place_id", "chunk_i", "chunk_j"]
    rows = df.repartitionByRange(*keys, *sort_by).sortWithinPartitions(*(partition_by or []), *keys, *sort_by)
    writer = rows.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_canonical(df: DataFrame, path: str, id_column: str, mode: str = "overwrite") -> None:
    """One canonical JSON text per row; files in order of id (range sort, no single writer)."""
    df.select(F.col(id_column).alias("_id"), canonical_json(df).alias("value")).orderBy("_id").select("value").write.mode(mode).text(path)
