"""Token-id files of bit or byte planes: fixed-size id blocks, each plane compressed, with a chunk index."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from placeloom.llm.blobs import column, tasks
from placeloom.llm.tokens import encoder

CHUNK = "part int, chunk int, n_ids long, width int, planes array<binary>, doc_ids array<long>, lengths array<long>"


def to_planes(ids: np.ndarray, width: int, level: int) -> list[bytes]:
    """The block's 32 bit planes (width 1) or 4 byte planes (width 8), least significant first, each a zstandard frame."""
    flat = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    rows = flat.T if width == 8 else np.packbits(np.unpackbits(flat, axis=1, bitorder="little").T, axis=1, bitorder="little")
    code = zstandard.ZstdCompressor(level=level)
    return [code.compress(r.tobytes()) for r in rows]


def from_planes(planes: list[bytes], n: int, width: int) -> np.ndarray:
    code = zstandard.ZstdDecompressor()
    rows = np.stack([np.frombuffer(code.decompress(p), np.uint8) for p in planes])
    flat = rows.T if width == 8 else np.packbits(np.unpackbits(rows, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little")
    return np.ascontiguousarray(flat).view("<u4").ravel()


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end: int = 2, block: int = 1 << 16, width: int = 8, level: int = 3) -> None:
    """Ids of every whole text and the id `end`, in ascending doc_id order (NULL first, ties by text), as a table of chunks under
    `folder`/chunks and an index (part, chunk, first_id, n_ids, bytes) under `folder`/index.

    Parts are ranges of doc_id. Inside a part the ids run on over document ends and are cut every `block` ids; a chunk also lists the
    documents that begin in it. A task holds one block and one document."""
    order = ["doc_id", "_t"]
    placed = docs.select("doc_id", "text").withColumn("_t", F.xxhash64("text")).repartitionByRange(tasks(docs), *order).sortWithinPartitions(*order).drop("_t")
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = ["part", "chunk", "n_ids", "width", "planes", "doc_ids", "lengths"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, code, made = TaskContext.get().partitionId(), encoder(vocabulary), 0
        held, n, doc_ids, lengths = [], 0, [], []

        def chunk(ids: np.ndarray) -> pa.RecordBatch:
            nonlocal made, doc_ids, lengths
            row = [part, made, len(ids), width, to_planes(ids, width, level), doc_ids, lengths]
            made, doc_ids, lengths = made + 1, [], []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            for doc_id, ids in zip(column(batch, "doc_id"), code.texts(batch.column(batch.schema.get_field_index("text")), end)):
                doc_ids.append(doc_id)
                lengths.append(len(ids))
                held.append(ids)
                n += len(ids)
                if n >= block:
                    run_on = np.concatenate(held)
                    for k in range(0, n - block + 1, block):
                        yield chunk(run_on[k:k + block])
                    held, n = [run_on[n // block * block:]], n % block
        if n or doc_ids:
            yield chunk(np.concatenate([np.zeros(0, "<u4"), *held]))

    placed.mapInArrow(run, CHUNK).write.parquet(f"{folder}/chunks")
    chunks = docs.sparkSession.read.schema(CHUNK).parquet(f"{folder}/chunks")
    size = F.aggregate("planes", F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p))
    inner, ahead = W.partitionBy("part").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1), W.partitionBy().orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("o"))  # one row per part
    index = chunks.select("part", "chunk", "n_ids", size.alias("bytes")).withColumn("f", F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).join(parts, "part")
    index.select("part", "chunk", (F.col("o") + F.col("f")).alias("first_id"), "n_ids", "bytes").write.parquet(f"{folder}/index")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents in a folder that `write_ids` made; `ids` are little-endian unsigned 32-bit.

    Chunks are put in order inside their part; a document that runs over chunks is put together as they pass."""
    index = spark.read.parquet(f"{folder}/index")
    first = index.groupBy("part").agg(F.min("first_id").alias("first"))  # one row per part
    chunks = spark.read.schema(CHUNK).parquet(f"{folder}/chunks").join(first, "part").repartition(tasks(index), "part").sortWithinPartitions("part", "chunk")
    types, names = [pa.int64(), pa.int64(), pa.int64(), pa.binary()], ["doc_id", "start", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, waiting, held = None, 0, [], np.zeros(0, "<u4")
        for batch in batches:
            for p, n, width, planes, doc_ids, lengths, start in zip(*(column(batch, c) for c in ("part", "n_ids", "width", "planes", "doc_ids", "lengths", "first"))):
                if p != part:
                    part, at, waiting, held = p, start, [], np.zeros(0, "<u4")
                waiting += zip(doc_ids, lengths)
                held = np.concatenate([held, from_planes(planes, n, width)])
                rows, used = [], 0
                for doc_id, length in waiting:
                    if used + length > len(held):
                        break
                    rows.append((doc_id, at, length, held[used:used + length].tobytes()))
                    used, at = used + length, at + length
                waiting, held = waiting[len(rows):], held[used:]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return chunks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
