"""Minimax contiguous partition of documents into shards. Built-in functions only."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from placeloom.llm.blobs import tasks
from placeloom.llm.store import stored

GROUP = ["_h", "text_crc32", "size"]


def text_groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, size, text_crc32, _h) and their groups of equal texts in order of the first doc_id, each with `end`: the bytes
    of all groups up to and with it. The order is a range sort; sums run inside its partitions, one offset per partition."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_h")), "rows")
    groups = rows.groupBy(*GROUP).agg(F.sum("size").alias("bytes"), F.min("doc_id").alias("first"))
    order = ["first", *GROUP]
    placed = stored(groups.repartitionByRange(tasks(docs), *order).withColumn("_p", F.spark_partition_id()), "groups")
    ahead = W.partitionBy().orderBy("_p").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    offsets = placed.groupBy("_p").agg(F.sum("bytes").alias("_b")).select("_p", F.coalesce(F.sum("_b").over(ahead), F.lit(0)).alias("_o"))
    inner = W.partitionBy("_p").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return rows, stored(placed.withColumn("_r", F.sum("bytes").over(inner)).join(offsets, "_p").select(*GROUP, "bytes", (F.col("_r") + F.col("_o")).alias("end")).sortWithinPartitions("end"), "prefix")


def smallest_capacity(prefix: DataFrame, shards: int, tries: int = 32) -> tuple[int, int]:
    """The smallest capacity with which `shards` contiguous runs hold all groups, and the total.

    A search over capacities: each round tries `tries` of them at once. A check is greedy: from where the last shard ended, the
    largest prefix within the capacity, one small aggregation per shard for all capacities together. The driver holds single numbers."""
    total, largest = prefix.agg(F.coalesce(F.max("end"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    low = max(largest, -(-total // shards))
    high = low + largest  # each full shard holds more than total / shards, so this one is enough
    while low < high:
        step = max(1, -(-(high - low) // tries))
        caps = list(range(low, high, step))
        ends = [0] * len(caps)
        for _ in range(shards):
            near = prefix.filter((F.col("end") > min(ends)) & (F.col("end") <= max(e + c for e, c in zip(ends, caps))))
            found = near.agg(*[F.max(F.when(F.col("end") <= e + c, F.col("end"))) for e, c in zip(ends, caps)]).first()
            ends = [max(e, f or 0) for e, f in zip(ends, found)]
        fits = [e == total for e in ends]
        k = fits.index(True) if any(fits) else len(caps)
        high = caps[k] if k < len(caps) else high
        low = caps[k - 1] + 1 if k else low
        if k == 0:
            high = low
    return low, total


def cuts(prefix: DataFrame, shards: int) -> list[int]:
    """Ends of the first shards - 1 shards under the smallest capacity. Inside what that capacity leaves free, each cut goes next to an
    equal share of the rest, so that one giant group doesn't leave later shards empty."""
    cap, total = smallest_capacity(prefix, shards)
    # Least end of the shards before, so that the last j shards still hold the rest: greedy from the right.
    least = [total]
    for _ in range(shards - 1):
        start = prefix.filter(F.col("end") >= least[-1] - cap).agg(F.min("end")).first()[0] if least[-1] > cap else 0
        least.append(start or 0)
    out, at = [], 0
    for k in range(1, shards):
        need, share = least[shards - k], at + (total - at) // (shards - k + 1)
        below, above = prefix.agg(F.max(F.when((F.col("end") <= share) & (F.col("end") >= at) & (F.col("end") >= need), F.col("end"))),
                                  F.min(F.when((F.col("end") > share) & (F.col("end") <= at + cap) & (F.col("end") >= need), F.col("end")))).first()
        fits = [e for e in (below, above) if e is not None]
        at = min(fits, key=lambda e: abs(e - share)) if fits else max(at, need)
        out.append(at)
    return out


def contiguous_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): documents in `shards` runs of near-equal bytes, equal texts together.

    Size is the UTF-8 length and 1; a NULL text counts as the empty one. Slots number a shard's rows from 0 in order of doc_id (NULL
    first). Repeated rows and ids are rows like others; an empty table gives no rows; other columns are ignored."""
    rows, prefix = text_groups(docs)
    shard = sum((F.when(F.col("end") > c, 1).otherwise(0) for c in cuts(prefix, shards)), F.lit(0))
    order = ["doc_id", *GROUP]
    placed = rows.join(prefix.select(*GROUP, shard.cast("int").alias("shard")), GROUP)
    spread = stored(placed.repartitionByRange(tasks(docs), "shard", *order).withColumn("_p", F.spark_partition_id()), "placed")
    counts = spread.groupBy("shard", "_p").agg(F.count("*").alias("_c"))
    ahead = W.partitionBy("shard").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("shard", "_p", F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_o"))
    number = F.row_number().over(W.partitionBy("_p", "shard").orderBy(*order))
    return spread.withColumn("_r", number).join(offsets, ["shard", "_p"]).select("doc_id", "size", "text_crc32", "shard", (F.col("_r") + F.col("_o") - 1).cast("long").alias("slot"))
