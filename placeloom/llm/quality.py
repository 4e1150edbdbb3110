"""Quality classifier: random Fourier features of document statistics, ridge by summed normal equations, isotonic calibration."""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from placeloom.llm.blobs import column, text_bytes
from placeloom.llm.store import remainder, stored

N_STATS = 24
SYMBOLS = np.frombuffer(b"#$%&*+<=>@^_`~\\", np.uint8)
LETTERS = np.array([(65 <= b <= 90) or (97 <= b <= 122) or b >= 128 for b in range(256)])


def statistics(text: bytes | None) -> np.ndarray:
    """N_STATS numbers of one whole text (shares, mean lengths, repetition, entropies); an empty or NULL text gives zeros."""
    out = np.zeros(N_STATS)
    if not text:
        return out
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(float)
    words, n = text.split(), len(text)
    lengths = np.fromiter(map(len, words), float, len(words))
    kinds, lines = len(set(words)), [x for x in text.split(b"\n") if x.strip()]
    nw, p = max(1, len(words)), count[count > 0] / n
    upper, digits, high = count[65:91].sum(), count[48:58].sum(), count[128:].sum()
    mean = lengths.mean() if len(words) else 0.0
    out[:] = (math.log1p(n), math.log1p(nw), mean, lengths.std() if len(words) else 0.0, math.log1p(lengths.max() if len(words) else 0),
              upper / n, digits / n, high / n, count[33] / nw, count[124] / nw, count[SYMBOLS].sum() / nw, (count[46] + count[63]) / nw, count[44] / nw,
              count[[34, 39, 40, 41, 45, 47, 58, 59, 91, 93, 123, 125]].sum() / nw, count[LETTERS].sum() / n, count[10] / nw, kinds / nw, math.log1p(kinds),
              len(set(lines)) / max(1, len(lines)), math.log1p(nw / max(1, len(lines))), -(p * np.log2(p)).sum(), (lengths <= 3).sum() / nw, (lengths >= 12).sum() / nw, upper / max(1.0, count[LETTERS].sum()))
    return out


@dataclass(frozen=True)
class Model:
    """Centre and scale of the statistics, projection, ridge weights, and the isotonic curve (`at` ascending, `value` rising)."""
    centre: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    beta: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.centre) / self.scale, -4, 4)
        return np.hstack([np.sqrt(2 / len(self.b)) * np.cos(x @ self.w + self.b), np.ones((len(x), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.features(stats) @ self.beta, self.at, self.value).clip(0, 1) if len(stats) else np.zeros(0)


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` columns and `stats`, an array of N_STATS numbers, from one pass over the texts."""
    source = docs.select(*keep, "text")
    out = source.drop("text").schema.add("stats", ArrayType(DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.concatenate([np.zeros(0), *map(statistics, text_bytes(batch))])
            stats = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, N_STATS, dtype=np.int32), pa.array(flat))
            held = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*held, stats], names=[*batch.schema.names[:-1], "stats"])

    return source.mapInArrow(run, out)


def monotone(weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the rising sequence nearest to `mean` under `weight`."""
    blocks: list[list[float]] = []
    for w, m in zip(weight, mean):
        blocks.append([w, m, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, m2, n2 = blocks.pop()
            w1, m1, n1 = blocks.pop()
            blocks.append([w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), n1 + n2])
    return np.concatenate([np.full(int(n), m) for _, m, n in blocks])


def fit(stats: DataFrame, labels: DataFrame, n_features: int = 256, width: float = 4.0, ridge: float = 1.0, bins: int = 512, seed: int = 7) -> Model | None:
    """Model from `stats(doc_id, stats)` and `labels(doc_id, label)`; None without a labelled row.

    Seven tenths of the labelled rows give the weights: every partition adds up its part of the normal equations and the
    parts are summed row by row of the matrix. The rest calibrates: raw scores go into `bins` equal bins, whose means are made
    monotone. The driver sees one matrix of `n_features` + 1 and the bins, whatever the input's size."""
    moments = stats.select(F.explode(F.arrays_zip(F.sequence(F.lit(0), F.lit(N_STATS - 1)).alias("k"), F.col("stats").alias("x"))).alias("v")).groupBy("v.k").agg(F.mean("v.x"), F.stddev_pop("v.x")).orderBy("k").collect()
    pairs = labels.filter("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").cast("double").alias("label"))
    rows = stored(stats.join(pairs, "doc_id").select("stats", "label", (F.pmod(F.xxhash64("doc_id"), F.lit(10)) < 3).alias("check")), "labelled")
    if len(moments) < N_STATS or rows.isEmpty():
        return None
    rng = np.random.default_rng(seed)
    centre, scale = np.array([m[1] for m in moments]), np.array([max(m[2], 1e-6) for m in moments])
    base = Model(centre, scale, rng.normal(size=(N_STATS, n_features)) / width, rng.uniform(0, 2 * np.pi, n_features), np.zeros(n_features + 1), np.array([0.0]), np.array([1.0]))
    size = n_features + 1

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size + 1))
        for part in batches:
            if len(part):
                z = base.features(np.stack(part["stats"]))
                total += z.T @ np.column_stack([z, part["label"]])
        yield pd.DataFrame({"k": range(size), "v": list(total)})

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": [key[0]], "v": [np.sum(np.stack(part["v"]), axis=0)]})

    table = rows.filter("NOT check").select("stats", "label").mapInPandas(sums, "k int, v array<double>").groupBy("k").applyInPandas(add, "k int, v array<double>").collect()
    full = np.zeros((size, size + 1))
    for k, v in table:
        full[k] = v
    beta = np.linalg.solve(full[:, :size] + ridge * np.eye(size), full[:, size])
    weighted = Model(base.centre, base.scale, base.w, base.b, beta, np.array([-0.5, 1.5]), np.array([-0.5, 1.5]))

    def raw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if len(part):
                z = weighted.features(np.stack(part["stats"])) @ beta
                yield pd.DataFrame({"bin": np.clip(((z + 0.5) / 2 * bins).astype(int), 0, bins - 1), "label": part["label"]})

    held = rows.filter("check")
    held = rows if held.isEmpty() else held
    curve = held.select("stats", "label").mapInPandas(raw, "bin int, label double").groupBy("bin").agg(F.count("*").alias("n"), F.mean("label").alias("m")).orderBy("bin").collect()
    at, n, mean = (np.array([c[k] for c in curve], float) for k in range(3))
    return Model(base.centre, base.scale, base.w, base.b, beta, (at + 0.5) / bins * 2 - 0.5, monotone(n, mean))


def training_labels(labels: DataFrame, name: str, folds: int, held_out: int) -> DataFrame:
    """Labels of the rows whose crc32(doc_id as text) mod `folds` isn't `held_out`."""
    return labels.select("doc_id", F.col(name).alias("label")).filter(remainder(F.col("doc_id"), folds) != held_out)


def score_column(model: Model | None, text: Column, default: float = 0.5) -> Column:
    """The score of a text column, for filters: no join, no second table."""
    if model is None:
        return F.lit(default)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack([statistics(t.encode() if isinstance(t, str) else None) for t in texts])) if len(texts) else [], dtype=float)

    return score(text)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.7, default: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every whole text, labels learnt outside the held-out fold.

    NULL and empty texts get the score of zero statistics; repeated rows each get a row; a NULL id counts as the empty id text; with no
    labelled row every score is `default`; an empty table gives no rows; other columns are ignored."""
    stats = stored(with_statistics(docs, ["doc_id"]), "stats")
    model = fit(stats, training_labels(labels, "quality", folds, held_out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(column(batch, "stats"), float).reshape(-1, N_STATS)
            score = np.full(len(x), default) if model is None else model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
