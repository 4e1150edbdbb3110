"""Katz backoff: Good-Turing discounted bigrams over a smoothed word distribution, exactly normalised, evaluated per token."""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placeloom.llm.blobs import pack, pack_words, rows_of, tasks, tokenised, unpack, unpack_words
from placeloom.llm.store import discard, stored

TOP = 5  # counts above it are trusted
START = -1  # context of a text's first token
BATCH = 1 << 20  # words of a token batch: a worker holds one batch, with about 100 bytes a word
BUCKET = 1 << 22  # words whose bigrams come to one bucket, about: a worker holds one bucket
N_STATS = TOP + 2  # of a context: types seen once .. TOP times, all occurrences, and the base probability of its successors
N_SENT = TOP + 3  # the same in whole numbers, which are exact and small when packed: the probability as types and the sum of their counts


@dataclass(frozen=True)
class Base:
    """Additive word distribution: P(w) = (c + 0.5) / (N + 0.5 (V + 1)); with one unknown word it sums to 1."""
    total: int
    kinds: int

    def of(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.5) / (self.total + 0.5 * (self.kinds + 1))

    def stats(self, sent: np.ndarray) -> np.ndarray:
        """Rows of N_STATS numbers from rows of N_SENT."""
        seen = (sent[:, TOP + 2] + 0.5 * sent[:, TOP + 1]) / (self.total + 0.5 * (self.kinds + 1))
        return np.column_stack([sent[:, :TOP + 1], seen])


def discounts(kinds: np.ndarray) -> np.ndarray:
    """Good-Turing factors of counts 1..TOP from `kinds[r - 1]`, the number of bigrams seen r times (r up to TOP + 1), in Katz's form.
    Where the counts don't give factors between 0 and 1, absolute discounting by a half stands in."""
    r = np.arange(1, TOP + 1)
    n = kinds.astype(float)
    plain = (r - 0.5) / r
    if n[0] == 0 or (n[:TOP] == 0).any():
        return plain
    rest = (TOP + 1) * n[TOP] / n[0]
    got = ((r + 1) * n[1:] / (r * n[:TOP]) - rest) / (1 - rest) if rest < 1 else np.full(TOP, np.nan)
    return np.where((got > 0) & (got < 1), got, plain)


def context_weights(stats: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scale of seen, weight of unseen) of contexts given as rows of N_STATS numbers.

    Seen: scale * d_c * c / c(v). Unseen: weight * P(w), where the weight spreads what the seen leave over the base probability of the
    unseen, so the whole is 1. A context without anything left gives up 1 / (c(v) + 1). One never seen is the base itself."""
    total = np.maximum(stats[:, TOP], 1)
    kept = 1 - (stats[:, :TOP] * np.arange(1, TOP + 1) * (1 - d)).sum(1) / total
    scale = np.where(kept > 1 - 1e-9, total / (total + 1), 1.0)
    weight = (1 - scale * kept) / np.maximum(1 - stats[:, TOP + 1], 1e-12)
    seen = stats[:, TOP] > 0
    return np.where(seen, scale, 1.0), np.where(seen, weight, 1.0)


def word_requests(parts: Iterator[pa.RecordBatch], buckets: int, folds: int, held_out: int) -> Iterator[pa.RecordBatch]:
    """Each batch's words and training counts, cut by hash. The end of a text is the empty word."""
    for batch, words, ids, lengths, doc_ids in rows_of(parts, "batch", "words", "ids", "lengths", "doc_ids"):
        b = Batch(words, ids, lengths, doc_ids, folds, held_out)
        counts = np.bincount(b.flat, b.learnt, len(b.words)).astype(np.int64)
        for k, at in b.by_hash(buckets):
            yield pa.RecordBatch.from_pydict({"bucket": [k], "batch": [batch], "words": [pack_words([b.words[i] for i in at])], "counts": [pack(counts[at])]})


class Batch:
    """A token batch with its texts' ends. `flat`: word numbers of all tokens, `learnt`: 1 for tokens of training texts."""

    def __init__(self, words: bytes, ids: bytes, lengths: list[int], doc_ids: list, folds: int, held_out: int) -> None:
        ids, n = unpack(ids, np.int32), np.array(lengths, np.int64)
        self.words = [w for w in unpack_words(words) if w] + [b""]
        self.out = np.array([zlib.crc32(b"" if d is None else str(d).encode()) % folds == held_out for d in doc_ids], bool)
        self.lengths = n + 1
        self.flat = np.insert(ids, np.cumsum(n), len(self.words) - 1)
        self.learnt = np.repeat(~self.out, self.lengths).astype(float)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def by_hash(self, buckets: int) -> list[tuple[int, np.ndarray]]:
        own = np.fromiter((zlib.crc32(w) % buckets for w in self.words), np.int64)
        order = np.argsort(own, kind="stable")
        edges = np.flatnonzero(np.diff(own[order], prepend=-1))
        return [(int(own[at[0]]), at) for at in np.split(order, edges[1:])]

    def learn(self, replies: list[dict], buckets: int) -> None:
        """Global numbers and training counts of the words."""
        self.number, self.count = np.zeros(len(self.words), np.int64), np.zeros(len(self.words), np.int64)
        got = {r["bucket"]: r for r in replies}
        for k, at in self.by_hash(buckets):
            self.number[at], self.count[at] = unpack(got[k]["a"], np.int64), unpack(got[k]["b"], np.int64)

    def bigrams(self, buckets: int, hot: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
        """Distinct bigrams as (context, word) numbers of the batch, each token's bigram, and the bigrams cut by context in order of
        context. A context seen over `hot` times is cut by both words, so that none fills a bucket."""
        n = len(self.words)
        before = np.insert(self.flat[:-1], 0, 0)
        before[self.starts] = n
        kinds, self.token = np.unique(before.astype(np.int64) * n + self.flat, return_inverse=True)
        v, w = kinds // n, kinds % n
        vg, vc = np.append(self.number, START)[v], np.append(self.count, len(self.lengths) and 1 << 62)[v]
        mix = vg * 0x5851F42D + np.where(vc > hot, (self.number[w] + 1) * 0x14057B7E, 0)
        own = ((mix ^ (mix >> 29)) % buckets).astype(np.int64)
        order = np.lexsort((self.number[w], vg, own))
        edges = np.flatnonzero(np.diff(own[order], prepend=-1))
        self.context, self.hot = vg, vc > hot
        return v, w, [(int(own[at[0]]), at) for at in np.split(order, edges[1:])]


def katz_scores(docs: DataFrame, folds: int = 5, held_out: int = 1, hot: int = BUCKET // 4) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every whole text; log10 probabilities.

    Learns from rows whose crc32(doc_id as text) mod `folds` isn't `held_out`. Batches of texts send their distinct words, then
    their distinct bigrams, to tables partitioned by hash, which count over all batches and answer each batch for what it sent; so
    what travels is one row of compact arrays per batch and partition. The n-gram table keeps, per context, what Good-Turing and the
    backoff weight need. A context seen more than `hot` times, or by more than one word in 2^20, is spread over all buckets; there are
    at most 2^20 of these (and the start), so their sums travel with the scoring code. A score goes from bigram to weighted word to the unknown word, token by token.

    NULL and empty texts are the end token alone; a NULL id counts as the empty id text; repeated rows count and score once each; with no
    training text the base is uniform over the unknown word; an empty table gives no rows; other columns are ignored."""
    batches = stored(tokenised(docs, max_tokens=BATCH), "tokens")
    n_words = batches.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda n, x: n + x))).first()[0] or 0
    hot = max(hot, n_words >> 20)
    buckets = max(2 * tasks(docs), -(-n_words // BUCKET))
    words = stored(batches.mapInArrow(lambda parts: word_requests(parts, buckets, folds, held_out), "bucket long, batch long, words binary, counts binary"), "words")

    def number_words(part: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        places = [np.fromiter((known.setdefault(w, len(known)) for w in unpack_words(b)), np.int64) for b in part["words"].to_pylist()]
        counts = np.bincount(np.concatenate(places), np.concatenate([unpack(c, np.int64) for c in part["counts"].to_pylist()]), len(known)).astype(np.int64)
        bucket, n = part["bucket"][0].as_py(), len(places)
        own = [1] + [0] * (n - 1)  # totals stand in one row of the bucket
        return pa.table({"batch": part["batch"], "bucket": part["bucket"], "a": pa.array([pack(p * buckets + bucket) for p in places], pa.binary()), "b": pa.array([pack(counts[p]) for p in places], pa.binary()),
                         "total": pa.array([int(counts.sum()) * o for o in own], pa.int64()), "kinds": pa.array([int((counts > 0).sum()) * o for o in own], pa.int64())})

    numbers = stored(words.groupBy("bucket").applyInArrow(number_words, "batch long, bucket long, a binary, b binary, total long, kinds long"), "numbers")
    discard(words)
    base = Base(*(int(x or 0) for x in numbers.agg(F.sum("total"), F.sum("kinds")).first()))
    replies = numbers.groupBy("batch").agg(F.collect_list(F.struct("bucket", "a", "b")).alias("numbers"))  # of one batch
    sent = ("batch", "words", "ids", "lengths", "doc_ids", "numbers")
    known = stored(batches.join(replies, "batch").select(*sent), "known")
    discard(batches, numbers)
    shape = pa.schema([*((c, pa.int64()) for c in ("bucket", "batch")), *((c, pa.binary()) for c in ("v", "words", "w", "count", "base", "hot"))])

    def bigram_requests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, *row, got in rows_of(parts, *sent):
            b = Batch(*row, folds, held_out)
            b.learn(got, buckets)
            v, w, cuts = b.bigrams(buckets, hot)
            counts = np.bincount(b.token, b.learnt, len(v)).astype(np.uint32)
            for k, at in cuts:
                # Each word once with its training count, then places in that list.
                own, first, place = np.unique(b.number[w[at]], return_index=True, return_inverse=True)
                row_of = [k, batch, pack(np.diff(b.context[at], prepend=0)), pack(np.diff(own, prepend=0)), pack(place.astype(np.uint32)), pack(counts[at]), pack(b.count[w[at][first]]), pack(b.hot[at].astype(np.uint8))]
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row_of, shape)], schema=shape)

    asked = known.mapInArrow(bigram_requests, "bucket long, batch long, v binary, words binary, w binary, count binary, base binary, hot binary")

    def count_bigrams(part: pa.Table) -> pa.Table:
        """Answers per batch: counts of its bigrams and stats of its contexts; sums of hot contexts and of counts of counts per bucket."""
        v = [np.cumsum(unpack(x, np.int64)) for x in part["v"].to_pylist()]
        own, w, c, p, h = ([unpack(x, t) for x in part[n].to_pylist()] for n, t in (("words", np.int64), ("w", np.uint32), ("count", np.uint32), ("base", np.int64), ("hot", np.uint8)))
        w, p = [np.cumsum(x)[k] for x, k in zip(own, w)], [x[k] for x, k in zip(p, w)]
        lengths = [len(x) for x in v]
        vv, ww, pp, hh = (np.concatenate(x) for x in (v, w, p, h))
        order = np.lexsort((ww, vv))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(vv[order]) != 0) | (np.diff(ww[order]) != 0)
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(new) - 1
        one = order[new]
        total = np.bincount(kind, np.concatenate(c), len(one)).astype(np.int64)
        contexts, ctx = np.unique(vv[one], return_inverse=True)
        parts = [*(total == r for r in range(1, TOP + 1)), total, total > 0, np.where(total > 0, pp[one], 0)]
        stats = np.stack([np.bincount(ctx, x, len(contexts)) for x in parts], axis=1).astype(np.int64)
        at, counts, rows = 0, [], []
        for n, own in zip(lengths, v):
            counts.append(pack(total[kind[at:at + n]].astype(np.uint32)))
            rows.append(pack(stats[np.searchsorted(contexts, own[np.diff(own, prepend=own[0] - 1) != 0])].T.ravel()))
            at += n
        warm = np.unique(vv[hh > 0])
        n = len(lengths)
        mine = np.searchsorted(contexts, warm)
        batch, bucket = part["batch"].to_pylist(), part["bucket"].to_pylist()
        return pa.table({"batch": pa.array(batch, pa.int64()), "bucket": pa.array(bucket, pa.int64()), "counts": pa.array(counts, pa.binary()), "stats": pa.array(rows, pa.binary()),
                         "sums": pa.array([[{"v": int(x), "s": [float(y) for y in stats[m]]} for x, m in zip(warm, mine)]] + [[]] * (n - 1), pa.list_(pa.struct([("v", pa.int64()), ("s", pa.list_(pa.float64()))]))),
                         "seen": pa.array([[int((total == r).sum()) for r in range(1, TOP + 2)]] + [[0] * (TOP + 1)] * (n - 1), pa.list_(pa.int64()))})

    table = stored(asked.groupBy("bucket").applyInArrow(count_bigrams, "batch long, bucket long, counts binary, stats binary, sums array<struct<v:long,s:array<double>>>, seen array<long>"), "bigrams")
    seen = table.agg(*[F.sum(F.col("seen")[r]) for r in range(TOP + 1)]).first()
    d = discounts(np.array([int(x or 0) for x in seen]))
    hot_sums = table.select(F.explode("sums").alias("x")).groupBy("x.v").agg(F.array(*[F.sum(F.col("x.s")[k]) for k in range(N_SENT)]).alias("s"))
    told = hot_sums.orderBy("v").collect()
    hot_keys, hot_stats = np.array([r.v for r in told], np.int64), np.array([r.s for r in told]).reshape(-1, N_SENT)
    answers = table.groupBy("batch").agg(F.collect_list(F.struct("bucket", "counts", "stats")).alias("answers"))
    whole = known.join(answers, "batch")
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words_of, ids, lengths, doc_ids, got, said in rows_of(parts, *sent, "answers"):
            b = Batch(words_of, ids, lengths, doc_ids, folds, held_out)
            b.learn(got, buckets)
            v, w, cuts = b.bigrams(buckets, hot)
            told = {a["bucket"]: a for a in said}
            p1 = base.of(b.count.astype(float))
            p2 = np.zeros(len(v))
            for k, at in cuts:
                own = b.context[at]
                new = np.diff(own, prepend=own[0] - 1) != 0
                stats = unpack(told[k]["stats"], np.int64).reshape(N_SENT, -1).T.astype(float)
                spread = np.flatnonzero(b.hot[at][new])
                stats[spread] = hot_stats[np.searchsorted(hot_keys, own[new][spread])]
                stats = base.stats(stats)
                scale, weight = context_weights(stats, d)
                ctx, c = np.cumsum(new) - 1, unpack(told[k]["counts"], np.uint32).astype(float)
                factor = np.where(c > TOP, 1.0, np.append(1.0, d)[np.minimum(c, TOP).astype(int)])
                p2[at] = np.where(c > 0, scale[ctx] * factor * c / np.maximum(stats[ctx, TOP], 1), weight[ctx] * p1[w[at]])
            add = lambda x: np.add.reduceat(x, b.starts)
            cols = [pa.array(doc_ids, pa.int64()), pa.array(b.out), pa.array(b.lengths), pa.array(add((b.count[b.flat] > 0).astype(np.int64))), pa.array(add(np.log10(p1)[b.flat])), pa.array(add(np.log10(p2)[b.token]))]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    scored = whole.select(*sent, "answers").mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(base.total).cast("long"))
