"""Best-fit packing planned over a histogram of lengths."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from placeloom.llm.blobs import column
from placeloom.llm.store import stored
from placeloom.llm.tokens import encoder

RANKS = 1 << 48
WORDS = 1_000_000  # words whose ids a Python worker keeps, about 200 bytes each


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = 4096, end: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids, _p, _nth): each document's ids with the id `end`, cut every `capacity` ids. `ids` are
    little-endian unsigned 32-bit; `_nth` counts the pieces of one length inside task `_p`."""
    names = ["doc_id", "piece", "start", "length", "ids", "_p", "_nth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, code = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), encoder(vocabulary, WORDS)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(column(batch, "doc_id"), code.texts(batch.column(batch.schema.get_field_index("text")), end)):
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    rows.append((doc_id, piece, start, len(part), part.tobytes(), task, seen[len(part)]))
                    seen[len(part)] += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, types)], names=names)

    return stored(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary, _p int, _nth long"), "pieces")


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Best fit, longest first, over counts: rows (length * RANKS + first rank, first sequence, offset), sorted. The pieces of a length
    from that rank on, up to the next row, take that offset in one sequence after the other.

    Sequences with the same free space are one class, kept as runs of numbers; a step moves a whole run. So the work follows the number of
    different lengths, not of documents."""
    classes: dict[int, list[tuple[int, int]]] = {}
    free = np.zeros(capacity + 1, bool)
    rows, opened = [], 0

    def put(space: int, first: int, n: int) -> None:
        classes.setdefault(space, []).append((first, n))
        free[space] = True

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            fits = np.flatnonzero(free[length:])
            if len(fits):  # the least space that suffices
                space = length + int(fits[0])
                first, n = classes[space].pop()
                take = min(n, left)
                if take < n:
                    classes[space].append((first + take, n - take))
                if not classes[space]:
                    free[space] = False
                rows.append((length * RANKS + rank, first, capacity - space))
                put(space - length, first, take)
                free[0] = False
                rank, left = rank + take, left - take
            else:
                each = capacity // length
                full = left // each
                sizes = [(full, each)] if full else []
                sizes += [(1, left % each)] if left % each else []
                for n, pieces in sizes:
                    for k in range(pieces):
                        rows.append((length * RANKS + rank, opened, k * length))
                        rank += n
                    put(capacity - pieces * length, opened, n)
                    free[0] = False
                    opened, left = opened + n, left - n * pieces
    return np.array(sorted(rows), np.int64).reshape(-1, 3)


def place(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """`pieces` (with length, _p, _nth) and their sequence_id and offset.

    The driver sees one count per length. The rank within a length is the number in the task plus the counts of the tasks before."""
    counts = pieces.groupBy("length", "_p").agg(F.count("*").alias("_c"))
    steps = plan({int(r[0]): r[1] for r in counts.groupBy("length").agg(F.sum("_c")).collect()}, capacity)
    ahead = W.partitionBy("length").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)  # one row per task
    before = counts.select("length", "_p", F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_o"))
    ranked = pieces.join(before, ["length", "_p"]).withColumn("_rank", F.col("length") * RANKS + F.col("_o") + F.col("_nth")).drop("_o", "_p", "_nth")
    schema = ranked.drop("_rank").schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(steps[:, 0], rank, "right") - 1
            new = [pa.array(steps[at, 1] + rank - steps[at, 0]), pa.array(steps[at, 2])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): all documents in few sequences of at most `capacity` ids.

    NULL and empty texts are the end id alone; repeated rows and NULL ids are rows like others; longer documents, and only those, are cut;
    an empty table gives no rows; other columns are ignored."""
    return place(token_pieces(docs, vocabulary, capacity, end), capacity)
