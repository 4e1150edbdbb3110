"""Running sums, numbering and neighbours that do not gather a group in one task.

A plain window over (line id) puts a whole line in one task. These helpers split a group by position instead, so a
group that holds a third of all rows is still spread."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from placeloom.session import cut_lineage


def _with_offsets(rows: DataFrame, offsets: DataFrame, on: list[str]) -> DataFrame:
    """Left rows with the offset of their keys, where NULL keys are equal."""
    right = offsets.select(*[F.col(k).alias(f"__{k}") for k in on], *[c for c in offsets.columns if c not in on])
    cond = F.lit(True)
    for k in on:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(right, cond).drop(*[f"__{k}" for k in on])


def running_sum(df: DataFrame, keys: list[str], seq: str, value: Column, out: str, before: str | None = None, bucket: int = 4096) -> DataFrame:
    """Inclusive running sum of `value` by the integer `seq` within `keys`; `before` is the sum up to the previous row.

    Windows run over buckets of `bucket` positions; only one total per bucket is summed along the whole group."""
    b = F.floor(F.col(seq) / bucket).alias("_b")
    rows = df.withColumn("_v", value).withColumn("_b", b)
    inner = W.partitionBy(*keys, "_b").orderBy(seq).rowsBetween(W.unboundedPreceding, 0)
    totals = rows.groupBy(*keys, "_b").agg(F.sum("_v").alias("_t"))
    ahead = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_b", F.coalesce(F.sum("_t").over(ahead), F.lit(0) * F.col("_t")).alias("_o"))
    summed = _with_offsets(rows.withColumn("_r", F.sum("_v").over(inner)), offsets, [*keys, "_b"])
    result = summed.withColumn(out, F.col("_o") + F.col("_r"))
    if before:
        result = result.withColumn(before, F.col("_o") + F.col("_r") - F.col("_v"))
    return result.drop("_v", "_b", "_r", "_o")


def running_min(df: DataFrame, keys: list[str], seq: str, value: Column, out: str, bucket: int = 4096) -> DataFrame:
    """Running minimum in the same two levels."""
    rows = df.withColumn("_v", value).withColumn("_b", F.floor(F.col(seq) / bucket))
    inner = W.partitionBy(*keys, "_b").orderBy(seq).rowsBetween(W.unboundedPreceding, 0)
    ahead = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    lows = rows.groupBy(*keys, "_b").agg(F.min("_v").alias("_t")).select(*keys, "_b", F.min("_t").over(ahead).alias("_o"))
    joined = _with_offsets(rows.withColumn("_r", F.min("_v").over(inner)), lows, [*keys, "_b"])
    return joined.withColumn(out, F.least("_r", "_o")).drop("_v", "_b", "_r", "_o")


def trailing_max(df: DataFrame, keys: list[str], seq: str, value: str, n: int, out: str, bucket: int = 4096) -> DataFrame:
    """Maximum over the last n rows of a dense `seq`: buckets overlap by n - 1 rows, so each window stays in its bucket."""
    own = F.floor(F.col(seq) / bucket)
    halo = F.when(F.pmod(F.col(seq), F.lit(bucket)) >= bucket - (n - 1), F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.withColumn("_b", F.explode(halo))
    w = W.partitionBy(*keys, "_b").orderBy(seq).rowsBetween(-(n - 1), 0)
    return spread.withColumn(out, F.max(value).over(w)).filter(F.col("_b") == own).drop("_b")


def with_next(df: DataFrame, keys: list[str], seq: str, values: list[str], gap: int = 1) -> DataFrame:
    """Each row with the values of the row at seq + gap (as next_*), by one aggregation on (keys, seq): every row is
    sent to its own position and to the one before it. Rows without a next one are left out. `seq` is dense."""
    here = df.select(*keys, F.col(seq).alias(seq), *[F.col(v).alias(v) for v in values], *[F.lit(None).cast(df.schema[v].dataType).alias(f"next_{v}") for v in values])
    there = df.select(*keys, (F.col(seq) - gap).alias(seq), *[F.lit(None).cast(df.schema[v].dataType).alias(v) for v in values],
                      *[F.col(v).alias(f"next_{v}") for v in values])
    cols = values + [f"next_{v}" for v in values]
    merged = (here.withColumn("_h", F.lit(1)).unionByName(there.withColumn("_h", F.lit(2)))
              .groupBy(*keys, seq).agg(F.sum("_h").alias("_h"), *[F.max(c).alias(c) for c in cols]))
    return merged.filter("_h = 3").drop("_h")


def spread_row_number(df: DataFrame, keys: list[str], order: list[str], out: str = "row_no") -> DataFrame:
    """row_number() over (keys order by order) without gathering a key in one task: a range sort over (keys, order)
    into a fixed number of partitions, numbering inside each partition, plus the counts of the partitions before."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Sorting by range reads its rows twice.
    placed = cut_lineage(cut_lineage(df).repartitionByRange(n, *keys, *order).withColumn("_p", F.spark_partition_id()))
    counts = placed.groupBy(*keys, "_p").agg(F.count("*").alias("_c"))
    ahead = W.partitionBy(*keys).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_p", F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_o"))
    local = placed.withColumn("_r", F.row_number().over(W.partitionBy("_p", *keys).orderBy(*order)))
    return _with_offsets(local, offsets, [*keys, "_p"]).withColumn(out, F.col("_r") + F.col("_o")).drop("_p", "_r", "_o")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, out: str = "rank_no", salts: int = 32) -> DataFrame:
    """The k first rows per key. A row_number filter is limited in each map task before the shuffle, so at most
    k rows per key and task travel; `salts` is the further split for a key present in very many tasks."""
    if salts > 1:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
        df = (df.withColumn("_s", salt).withColumn("_r", F.row_number().over(W.partitionBy(*keys, "_s").orderBy(*order)))
              .filter(F.col("_r") <= k).drop("_s", "_r"))
    return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(out) <= k)
