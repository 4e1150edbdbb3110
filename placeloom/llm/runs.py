"""Periodic run detection: seeds of repeated k-grams, extended along their diagonal, once per lag."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from placeloom.llm.blobs import text_bytes


def lag_classes(n: int, exponent: int, least: int) -> Iterator[tuple[int, int, int]]:
    """(k, lowest lag, highest lag) for lags up to n / exponent.

    A run of period q and length l >= max(least, exponent * q) matches itself at lag q over l - q words. A class has as k what all its
    lags guarantee, and no lag above k: then the next occurrence of a k-gram inside a run is exactly one period on."""
    sure = lambda q: max(least, exponent * q) - q
    low = 1
    while low * exponent <= n:
        k = high = sure(low)
        if low * exponent < least:  # what is sure shrinks at first
            high = low
            while high + 1 <= min(k, sure(high + 1)):
                high, k = high + 1, min(k, sure(high + 1))
        yield k, low, high
        low = high + 1


def names_of(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each pair among the distinct pairs, how often it is there)"""
    base = int(low.max(initial=0)) + 1
    _, name, count = np.unique(high * base + low, return_inverse=True, return_counts=True)
    return name, count[name]


class Grams:
    """Numbers of the grams that occur twice or more in one text, for gram sizes that grow; -1 for all others. A size is made from two grams
    of a smaller one that overlap, so numbers are exact, and only places that still repeat are looked at."""

    def __init__(self, words: np.ndarray) -> None:
        self.at, self.size, self.n = None, 1, len(words)
        self.name = words.astype(np.int64)
        self.keep(np.arange(self.n), self.name, np.bincount(self.name)[self.name] if self.n else self.name)

    def keep(self, at: np.ndarray, name: np.ndarray, count: np.ndarray) -> None:
        live = count > 1
        self.at = at[live]
        self.name = np.full(self.n, -1, np.int64)
        self.name[self.at] = name[live]

    def pairs(self, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = self.at[self.at + gap < self.n]
        at = at[self.name[at + gap] >= 0]
        return at, *names_of(self.name[at], self.name[at + gap])

    def grow(self, size: int) -> None:
        """Grams of a power of two."""
        while self.size < size and len(self.at):
            self.keep(*self.pairs(self.size))
            self.size *= 2

    def occurrences(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, next place) of every k-gram that comes again, in order of place."""
        self.grow(1 << (k.bit_length() - 1))
        if not len(self.at):
            return self.at, self.at
        at, name, _ = self.pairs(k - self.size) if k > self.size else (self.at, self.name[self.at], None)
        order = np.argsort(name, kind="stable")
        same = np.diff(name[order]) == 0
        here, there = at[order][:-1][same], at[order][1:][same]
        order = np.argsort(here, kind="stable")
        return here[order], there[order]


def matched(words: np.ndarray, start: int, lag: int, k: int) -> tuple[int, int]:
    """The longest stretch [a, b) round [start, start + k) in which each word is that `lag` words on."""
    n, width, b = len(words), 64, start + k
    while b + lag < n:
        stop = min(n - lag, b + width)
        same = words[b:stop] == words[b + lag:stop + lag]
        if not same.all():
            b += int(np.argmin(same))
            break
        b, width = stop, width * 2
    a, width = start, 64
    while a:
        low = max(0, a - width)
        same = (words[low:a] == words[low + lag:a + lag])[::-1]
        if not same.all():
            a -= int(np.argmin(same))
            break
        a, width = low, width * 2
    return a, b


def find_runs(words: np.ndarray, exponent: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """(start, length, smallest period), by start, then period, of every stretch of length >= max(least, exponent * period) that can't be
    extended. `words` are numbers from 0, none much larger than there are words.

    Per lag the furthest word covered is kept: a seed inside what was extended already is skipped, so a run is extended once."""
    grams, out = Grams(words), []
    for k, low, high in lag_classes(len(words), exponent, least):
        here, there = grams.occurrences(k)
        if not len(grams.at):
            break
        lag = there - here
        inside = (lag >= low) & (lag <= high)
        covered: dict[int, int] = {}
        here, lag = here[inside], lag[inside]
        # Of neighbouring seeds on one lag only the first can be uncovered.
        fresh = np.ones(len(here), bool)
        fresh[1:] = (np.diff(here) != 1) | (np.diff(lag) != 0)
        for i, q in zip(here[fresh].tolist(), lag[fresh].tolist()):
            if i < covered.get(q, 0):
                continue
            a, b = matched(words, i, q, k)
            covered[q] = b
            if b - a + q >= max(least, exponent * q):
                out.append((a, b - a + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, one space between, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


def periodic_runs(docs: DataFrame, exponent: int = 4, least: int = 6, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(`carry`.., n_words, runs, collapsed): the periodic runs of each whole text, in words between ASCII white space, and the text without
    their repetitions. A run is (start, length, period), by start, then period.

    Each text is one row of work where it lies: no row travels. NULL and empty texts have no words, no runs and an empty `collapsed`; long texts are
    searched whole, in n log n steps; repeated rows and NULL ids are rows like others; an empty table gives no rows; other columns are ignored.
    `exponent` is at least 2."""
    if exponent < 2:
        raise ValueError("exponent must be 2 or more")
    rows = docs.select(*carry, "text")
    shape = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found, texts = [], [], []
            for text in text_bytes(batch):
                words = text.split() if text else []
                code: dict[bytes, int] = {}
                numbers = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, len(words))
                runs = find_runs(numbers, exponent, least)
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                texts.append(collapsed(words, runs))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in carry]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64()), pa.array(found, shape), pa.array(texts, pa.binary()).cast(pa.string())], names=[*carry, "n_words", "runs", "collapsed"])

    of = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("text").schema)
    return rows.mapInArrow(run, of + ", n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
