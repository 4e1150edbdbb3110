"""Toxicity: a factorization machine over hashed terms of the whole text."""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placeloom.llm.blobs import column, text_bytes
from placeloom.llm.store import remainder

SPACE = 1 << 20
EDGES = b".,;:!?\"'()[]{}<>|*#$%&-_/\\"
CACHE = 400_000


class Terms:
    """Hashed terms of words: the word and its beginnings of 4 to 6 bytes, which stand for its stem. With `place`, the rows of
    a machine instead; most words have none. Known words are kept, up to CACHE."""

    def __init__(self, place: np.ndarray | None = None) -> None:
        self.known: dict[bytes, np.ndarray] = {}
        self.place = place

    def of_word(self, word: bytes) -> np.ndarray:
        got = self.known.get(word)
        if got is None:
            bare = word.strip(EDGES)
            parts = [b"=" + bare, *[b"^" + bare[:k] for k in (4, 5, 6) if len(bare) > k]] if bare else []
            got = np.array([zlib.crc32(p) % SPACE for p in parts], np.int32)
            if self.place is not None:
                got = self.place[got][self.place[got] >= 0]
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[word] = got
        return got

    def of_text(self, text: bytes | None) -> np.ndarray:
        """Distinct term numbers of a text, in order."""
        kinds = set(text.lower().split()) if text else ()
        return np.unique(np.concatenate([self.of_word(w) for w in kinds])) if kinds else np.zeros(0, np.int32)


@dataclass(frozen=True)
class Machine:
    """score = sigmoid(bias + sum w + sum over pairs of v.v); `place` has the row of a term number, or -1."""
    bias: float
    place: np.ndarray
    w: np.ndarray
    v: np.ndarray

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        lengths = np.fromiter(map(len, rows), int, len(rows))
        flat = np.concatenate([np.zeros(0, int), *rows]).astype(int)
        return 1 / (1 + np.exp(-np.clip(margin(self.bias, self.w, self.v, flat, lengths)[0], -30, 30)))


def margin(bias: float, w: np.ndarray, v: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Margins of texts given as concatenated rows, and their summed vectors."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    total = np.zeros((len(lengths), v.shape[1]))
    np.add.at(total, owner, v[flat])
    square = np.bincount(owner, (v[flat] ** 2).sum(1), len(lengths))
    return bias + np.bincount(owner, w[flat], len(lengths)) + ((total ** 2).sum(1) - square) / 2, total


def informative(rows: list[np.ndarray], y: np.ndarray, most: int, least: float) -> np.ndarray:
    """Term numbers whose presence tells the classes apart (log-likelihood ratio over `least`), the best `most`."""
    n1 = np.bincount(np.concatenate([np.zeros(0, int), *[r for r, t in zip(rows, y) if t]]).astype(int), minlength=SPACE).astype(float)
    n0 = np.bincount(np.concatenate([np.zeros(0, int), *[r for r, t in zip(rows, y) if not t]]).astype(int), minlength=SPACE).astype(float)
    a, b = max(1, y.sum()), max(1, (1 - y).sum())
    seen = np.flatnonzero(n1 + n0 >= 2)
    o = np.stack([n1[seen], n0[seen], a - n1[seen], b - n0[seen]])
    share = (n1[seen] + n0[seen]) / (a + b)
    e = np.stack([share * a, share * b, (1 - share) * a, (1 - share) * b])
    ratio = 2 * np.where(o > 0, o * np.log(np.maximum(o, 1e-12) / np.maximum(e, 1e-12)), 0).sum(0)
    order = np.argsort(-ratio, kind="stable")[:most]
    return np.sort(seen[order[ratio[order] > least]])


def train(rows: list[np.ndarray], y: np.ndarray, rank: int = 8, most: int = 4096, least: float = 8.0, epochs: int = 12, rate: float = 0.1, decay: float = 2e-4, seed: int = 11) -> Machine:
    """Mini-batch AdaGrad on the logistic loss over informative terms."""
    terms = informative(rows, y, most, least)
    place = np.full(SPACE, -1, np.int32)
    place[terms] = np.arange(len(terms))
    inner = [p[p >= 0] for p in (place[r] for r in rows)]
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(terms)), rng.normal(scale=0.02, size=(len(terms), rank))
    gw, gv = np.full(len(terms), 1e-2), np.full(v.shape, 1e-2)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias, gb = float(np.log(share / (1 - share))), 1e-2
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // 256)):
            lengths = np.fromiter((len(inner[k]) for k in part), int, len(part))
            flat = np.concatenate([np.zeros(0, int), *[inner[k] for k in part]]).astype(int)
            s, total = margin(bias, w, v, flat, lengths)
            g = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y[part]) / len(part)
            owner = np.repeat(np.arange(len(part)), lengths)
            dw = np.bincount(flat, g[owner], len(w)) + decay * w
            dv = decay * v
            np.add.at(dv, flat, g[owner, None] * (total[owner] - v[flat]))
            gw, gv, gb = gw + dw ** 2, gv + dv ** 2, gb + g.sum() ** 2
            w, v, bias = w - rate * dw / np.sqrt(gw), v - rate * dv / np.sqrt(gv), bias - rate * g.sum() / np.sqrt(gb)
    return Machine(bias, place, w, v)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000) -> Machine | None:
    """Machine from at most `sample` labelled rows, the first in order of hashed id; None without any. Only their term numbers
    reach the driver (about 3 KB a row)."""
    chosen = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `sample` rows of two numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            held = [terms.of_text(t).astype("<i4").tobytes() for t in text_bytes(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(column(batch, "doc_id"), pa.int64()), pa.array(held, pa.binary()), pa.array(column(batch, "label"), pa.int32())], names=["doc_id", "terms", "label"])

    got = rows.mapInArrow(run, "doc_id long, terms binary, label int").dropDuplicates(["doc_id"]).toArrow()
    if not got.num_rows:
        return None
    got = got.sort_by("doc_id")
    return train([np.frombuffer(t, "<i4") for t in got["terms"].to_pylist()], np.array(got["label"].to_pylist(), float))


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, default: float = 0.0, **limits) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every whole text, labels learnt outside the held-out fold.

    NULL and empty texts get the score of the bias; repeated rows each get a row (one of them teaches); a NULL id counts as the empty id
    text; with no labelled row every score is `default`; an empty table gives no rows; other columns are ignored."""
    machine = fit(docs, labels.select("doc_id", F.col("toxic").alias("label")).filter(remainder(F.col("doc_id"), folds) != held_out), **limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(machine and machine.place)
        for batch in batches:
            texts = text_bytes(batch)
            score = np.full(len(texts), default) if machine is None else machine.score([terms.of_text(t) for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), folds) == held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
