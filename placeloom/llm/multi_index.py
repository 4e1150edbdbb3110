"""Approximate nearest neighbours by an inverted multi-index: two halves quantised apart, cells visited best pair first."""
from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from placeloom.llm.blobs import column
from placeloom.llm.store import stored


@dataclass(frozen=True)
class Codebook:
    first: np.ndarray
    second: np.ndarray

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid pair of each vector."""
        h, k = self.first.shape[1], len(self.second)
        return nearest(x[:, :h], self.first) * k + nearest(x[:, h:], self.second)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(1) - 2 * x @ centres.T, axis=1)


def k_means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = nearest(x, centres)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = x[own == c].mean(0)
    return centres


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): vectors of the table's commonest length; those NULL, zero or with a NULL or non-finite component are left out."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    found = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").select("vec_id", x.alias("x"), fine.alias("ok")).filter("ok").drop("ok")
    size = found.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return found.filter(F.size("x") == (size["d"] if size else 0))


def visit(book: Codebook, held: np.ndarray, query: np.ndarray, enough: int) -> list[int]:
    """Cells by falling sum of the two halves' inner products, from a heap over centroid pairs, until they hold `enough` vectors."""
    h = book.first.shape[1]
    a, b = book.first @ query[:h], book.second @ query[h:]
    ra, rb = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
    heap, seen, out, got = [(-(a[ra[0]] + b[rb[0]]), 0, 0)], {(0, 0)}, [], 0
    while heap and got < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(ra[i]) * len(b) + int(rb[j])
        if held[cell]:
            out.append(cell)
            got += int(held[cell])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (-(a[ra[p]] + b[rb[q]]), p, q))
    return out


def search(vectors: DataFrame, every: int = 20, k: int = 20, share: float = 0.5, least: int = 2000, centroids: int = 64, groups: int = 8, sample: int = 20_000, block: int = 8192, seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` vectors of largest inner product found for each vec_id divisible by `every`.

    The codebook is fitted on at most `sample` vectors (hash order); every vector is indexed. A query visits cells until they hold
    `share` of all vectors, and `least` at any rate, and every entry of a visited cell is scored: no bucket is capped.
    Entries and queries are dealt out in blocks of about `block`, so one much repeated vector is many tasks' work. Ties go to the smaller vec_id.

    Vectors NULL, zero, with a NULL or non-finite component, of another length, or without id take no part; repeated rows with one id are
    separate entries (a query's own id is never among its answers); an empty table gives no rows; other columns are ignored."""
    points = stored(usable(vectors), "points")
    n = points.count()
    got = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("x").toPandas()
    out = "query_id long, rank int, vec_id long, score double"
    if not n:
        return vectors.sparkSession.createDataFrame([], out)
    x = np.stack(got["x"])
    rng, half, size = np.random.default_rng(seed), x.shape[1] // 2, min(centroids, max(2, n // 20))
    book = Codebook(k_means(x[:, :half], size, 12, rng), k_means(x[:, half:], size, 12, rng))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.array(column(batch, "x"), float).reshape(batch.num_rows, -1)
            cells = book.cells(at) if batch.num_rows else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells.astype(np.int32)), pa.array([r.tobytes() for r in at], pa.binary())], names=["vec_id", "cell", "x"])

    entries = stored(points.mapInArrow(index, "vec_id long, cell int, x binary"), "entries")
    held = np.zeros(len(book.first) * len(book.second), np.int64)
    for cell, count in entries.groupBy("cell").count().collect():  # at most centroids ** 2 numbers
        held[cell] = count
    asked = entries.filter(F.pmod("vec_id", F.lit(every)) == 0)
    # Cells are put in `groups`; a group's entries meet the queries that visit any of its cells, and both sides are cut to a bounded size.
    enough, query_parts = max(least, int(np.ceil(share * n))), max(1, -(-asked.count() // block))
    parts_of = np.maximum(1, -(-np.bincount(np.arange(len(held)) % groups, held, groups).astype(int) // block))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for q, v in zip(column(batch, "vec_id"), column(batch, "x")):
                cells = np.array(visit(book, held, np.frombuffer(v), enough))
                for first in np.unique(cells % groups):
                    seen = np.zeros(-(-len(held) // groups), bool)
                    seen[cells[cells % groups == first] // groups] = True
                    rows += [(q, int(first), part, q // every % query_parts, v, seen.tobytes()) for part in range(parts_of[first])]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names=["query_id", "first", "part", "asked", "q", "seen"])

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        e, own_cell, ids, rows = np.stack([np.frombuffer(v) for v in right["x"]]), right["cell"].to_numpy() // groups, right["vec_id"].to_numpy(), []
        for at in range(0, len(left), 256):
            some = left.iloc[at:at + 256]
            q, qs = np.stack([np.frombuffer(v) for v in some["q"]]), some["query_id"].to_numpy()
            seen = np.stack([np.frombuffer(v, bool) for v in some["seen"]])[:, own_cell] & (qs[:, None] != ids[None, :])
            rough = np.where(seen, q @ e.T, -np.inf)
            for own, line, vec in zip(qs, rough, q):
                free = line[line > -np.inf]
                if not len(free):
                    continue
                edge = np.partition(free, -min(k, len(free)))[-min(k, len(free))]
                near = np.flatnonzero(line >= edge - 1e-9 * (1 + abs(edge)))
                score = (e[near] * vec).sum(1)  # summed in one fixed order, so equal vectors tie
                best = np.lexsort((ids[near], -score))[:k]
                rows.append((np.full(len(best), own), ids[near][best], score[best]))
        cols = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0, int), np.zeros(0, int), np.zeros(0)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols)))

    # A query id that several rows share is asked once, with its first vector.
    pairs = asked.groupBy("vec_id").agg(F.min("x").alias("x")).mapInArrow(route, "query_id long, first int, part int, asked int, q binary, seen binary")
    first = F.pmod("cell", F.lit(groups))
    count_of = F.element_at(F.lit([int(c) for c in parts_of]), first + 1)
    dealt = entries.select(first.alias("first"), F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), count_of).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))).alias("asked"), "cell", "vec_id", "x")
    keys = ["first", "part", "asked"]
    found = pairs.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(rerank, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
