"""N-gram Jaccard join: rarity-ordered prefixes, single tokens of rare classes, combinations of frequent ones, exact check."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from placeloom.llm.blobs import column, pack, tasks, tokenised, unpack, unpack_words
from placeloom.llm.groups import linked_groups
from placeloom.llm.store import stored

SKETCH = 16  # words of 64 bits
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Each bit of a hash made to depend on all of them."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_sets(words: bytes, ids: bytes, lengths: list[int], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the `k`-word shingles of each document of a token batch; a shorter one is its whole sequence.
    Lengths and hashes of words go in, so two different shingles of one pair collide with a chance of about 2^-64 each."""
    own = np.fromiter((xxhash.xxh64_intdigest(w) for w in unpack_words(words)), np.uint64)
    ids, sets, at = unpack(ids, np.int32), [], 0
    h = own[ids] if len(ids) else np.zeros(0, np.uint64)
    run = h[:max(0, len(h) - k + 1)].copy()
    for j in range(1, k):
        run = run * MULTIPLIER + h[j:len(h) - k + 1 + j] if len(run) else run
    run = mixed(run)
    for n in lengths:
        if n >= k:
            sets.append(np.unique(run[at:at + n - k + 1]))
        elif n:
            whole = np.array([n], np.uint64)
            for x in h[at:at + n]:
                whole = whole * MULTIPLIER + x
            sets.append(mixed(whole))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += n
    return sets


def rarity(counts: np.ndarray) -> np.ndarray:
    """Class of a document count: 0 for 1, then 8 classes for each doubling."""
    return np.minimum(255, np.round(8 * np.log2(counts))).astype(np.uint8)


def parity(tokens: np.ndarray) -> bytes:
    """SKETCH * 64 bits, each the parity of the tokens that fall on it: sketches differ in at most as many bits as sets in tokens."""
    odd = np.bincount((tokens % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def prefix_keys(tokens: np.ndarray, classes: np.ndarray, t: int, frequent: int, k: int) -> np.ndarray:
    """Index keys of one set, such that two sets of Jaccard similarity >= t / 100 share one.

    In rarity order (class, hash) similar sets of n and m tokens share at least t percent of n, so at most e = n - ceil(t n / 100) tokens
    of n are alone, and both together leave at most h = floor((100 - t) n / t) alone. If the first shared token is rare it is
    among the first e + 1 of both: those are keys by themselves, but for tokens that no other document has. If not, all shared
    tokens are frequent; the prefix is extended to hold (h + 1)(k - 1) + 1 of them, of which some k follow each other directly in both
    sets, as lone tokens break at most h of the steps: runs of k frequent neighbours are the other keys."""
    n = len(tokens)
    e, h = n - -(-t * n // 100), (100 - t) * n // t
    order = np.lexsort((tokens, classes))
    own, cls = tokens[order], classes[order]
    edge = int(np.searchsorted(cls, frequent))  # the first frequent token
    first = slice(int(np.searchsorted(cls, 1)), min(edge, e + 1))
    single = own[first]
    if edge > e:
        return single
    far = own[edge:e + (h + 1) * (k - 1) + 1]
    if len(far) < k:  # a set of so few tokens is its own combination
        return np.append(single, mixed(far.sum(keepdims=True) + np.uint64(len(far)))) if len(far) else single
    run = far[:len(far) - k + 1]
    for j in range(1, k):
        run = mixed(run * MULTIPLIER + far[j:len(far) - k + 1 + j])
    return np.concatenate([single, run])


def jaccard_groups(docs: DataFrame, row: str | None = None, words: int = 4, percent: int = 85, frequent: int = 64, combination: int = 2, bits: int = 32) -> DataFrame:
    """(_row, doc_id, n_shingles, component_id, keep): documents and their groups under Jaccard similarity >= `percent` / 100 of word shingles.

    component_id is the smallest doc_id reachable over links; `keep` marks one row of each group, that of lowest doc_id and row. Equal
    sets are one set in the index. NULL, empty and white-space texts have no shingles, link with nothing and are kept; repeated rows are
    separate documents with equal sets; a NULL id is never the smallest unless all are NULL; an empty table gives no rows; other columns
    are ignored. `_row` comes from the column `row`, or from the scan of `docs`."""
    batches = stored(tokenised(docs, row), "tokens")
    pieces, cut = 4 * tasks(docs), np.uint64(64 - bits)
    high = int(frequent and rarity(np.array([frequent]))[0])

    def requests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of short hashes of a batch's tokens, cut by range of hash; and one row per document with a digest of its set."""
        for part in parts:
            for batch, w, ids, lengths, doc_ids, rows in zip(*(column(part, c) for c in ("batch", "words", "ids", "lengths", "doc_ids", "rows"))):
                sets = shingle_sets(w, ids, lengths, words)
                d1 = np.array([s.sum() for s in sets], np.uint64).view(np.int64)
                d2 = np.array([np.bitwise_xor.reduce(mixed(s ^ MULTIPLIER)) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                n = np.fromiter(map(len, sets), np.int64, len(sets))
                yield pa.RecordBatch.from_pydict({"batch": np.full(len(n), batch), "bucket": np.full(len(n), -1), "_row": rows, "doc_id": pa.array(doc_ids, pa.int64()), "n": n, "d1": d1, "d2": d2, "hashes": pa.nulls(len(n), pa.binary()), "counts": pa.nulls(len(n), pa.binary())}, schema=shape)
                _, once = np.unique(np.stack([d1, d2, n]), axis=1, return_index=True)  # equal sets of a batch count once
                short, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *[sets[k] for k in once]]) >> cut, return_counts=True)
                bounds = np.searchsorted(short, (np.arange(pieces + 1) * (1 << bits) // pieces).astype(np.uint64))
                spans = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(bounds, bounds[1:])) if hi > lo]
                m = len(spans)
                yield pa.RecordBatch.from_pydict({"batch": np.full(m, batch), "bucket": [b for b, _, _ in spans], "_row": pa.nulls(m, pa.int64()), "doc_id": pa.nulls(m, pa.int64()), "n": pa.nulls(m, pa.int64()), "d1": pa.nulls(m, pa.int64()), "d2": pa.nulls(m, pa.int64()),
                                                  "hashes": [pack(np.diff(short[lo:hi], prepend=np.uint64(0))) for _, lo, hi in spans], "counts": [pack(counts[lo:hi].astype(np.uint32)) for _, lo, hi in spans]}, schema=shape)

    ints = ("batch", "bucket", "_row", "doc_id", "n", "d1", "d2")
    shape = pa.schema([*((c, pa.int64()) for c in ints), ("hashes", pa.binary()), ("counts", pa.binary())])
    asked = stored(batches.mapInArrow(requests, ", ".join(f"{c} long" for c in ints) + ", hashes binary, counts binary"), "requests")

    def classes(part: pa.Table) -> pa.Table:
        """Rarity classes of the hashes of one range, answered batch by batch; only hashes that several documents have are named."""
        short = [np.cumsum(unpack(h, np.uint64)) for h in part["hashes"].to_pylist()]
        kinds, place = np.unique(np.concatenate(short), return_inverse=True)
        total = np.bincount(place, np.concatenate([unpack(c, np.uint32) for c in part["counts"].to_pylist()]), len(kinds))
        answer, at, keys, values = rarity(np.maximum(1, total))[place], 0, [], []
        for s in short:
            own = answer[at:at + len(s)]
            at += len(s)
            keys.append(pack(np.diff(s[own > 0], prepend=np.uint64(0))))
            values.append(pack(own[own > 0]))
        return pa.table({"batch": part["batch"], "hashes": pa.array(keys, pa.binary()), "classes": pa.array(values, pa.binary())})

    answers = asked.filter("bucket >= 0").select("batch", "bucket", "hashes", "counts").groupBy("bucket").applyInArrow(classes, "batch long, hashes binary, classes binary")
    rows = asked.filter("bucket < 0").select("batch", "_row", "doc_id", "n", "d1", "d2")
    alike = rows.filter("n > 0").groupBy("n", "d1", "d2").agg(F.min("_row").alias("set_row"))
    owner = stored(rows.join(alike, ["n", "d1", "d2"], "left"), "sets")
    chosen = owner.filter("_row = set_row").groupBy("batch").agg(F.collect_list("_row").alias("chosen"))  # of one batch
    replies = answers.groupBy("batch").agg(F.collect_list(F.struct("hashes", "classes")).alias("replies"))  # of one batch
    source = batches.join(chosen, "batch").join(replies, "batch").select("words", "ids", "lengths", "rows", "chosen", "replies")

    def index(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for w, ids, lengths, rows_of, picked, got in zip(*(column(part, c) for c in ("words", "ids", "lengths", "rows", "chosen", "replies"))):
                short = np.concatenate([np.cumsum(unpack(g["hashes"], np.uint64)) for g in got])
                known = np.concatenate([unpack(g["classes"], np.uint8) for g in got])
                order = np.argsort(short, kind="stable")
                short, known, picked = np.append(short[order], np.uint64(1 << 63)), np.append(known[order], np.uint8(0)), set(picked)
                keys, owners, held = [], [], []
                for row, tokens in zip(rows_of, shingle_sets(w, ids, lengths, words)):
                    if row not in picked:
                        continue
                    own = tokens >> cut
                    at = np.searchsorted(short, own)
                    found = prefix_keys(tokens, np.where(short[at] == own, known[at], 0), percent, high, combination)
                    if len(found):
                        keys.append(found)
                        owners.append(np.full(len(found), row))
                        held.append((row, len(tokens), tokens.tobytes(), np.frombuffer(parity(tokens), np.int64)))
                cols = [pa.array([h[0] for h in held], pa.int64()), pa.array([np.unique(k).view(np.int64) for k in keys], pa.list_(pa.int64())), pa.array([h[1] for h in held], pa.int32()), pa.array([h[2] for h in held], pa.binary()), pa.array([h[3] for h in held], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "keys", "n", "tokens", "sketch"])

    indexed = stored(source.mapInArrow(index, "id long, keys array<long>, n int, tokens binary, sketch array<long>"), "index")
    info = indexed.select("id", "n", *[F.col("sketch")[k].alias(f"s{k}") for k in range(SKETCH)])

    def fits(p: str, q: str) -> Column:
        """Sizes and sketches near enough: similar sets leave at most (100 - t) / (100 + t) of both sizes alone."""
        n, m = F.col(f"{p}_n"), F.col(f"{q}_n")
        apart = sum((F.bit_count(F.col(f"{p}_s{k}").bitwiseXOR(F.col(f"{q}_s{k}"))) for k in range(SKETCH)), F.lit(0))
        return (F.least(n, m) * 100 >= percent * F.greatest(n, m)) & (apart * (100 + percent) <= (100 - percent) * (n + m))

    def verify(pairs: DataFrame) -> DataFrame:
        def check(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                keep = []
                for x, y in zip(column(part, "ta"), column(part, "tb")):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        tokens = lambda p: indexed.select(F.col("id").alias(p), F.col("tokens").alias(f"t{p}"))
        return pairs.join(tokens("a"), "a").join(tokens("b"), "b").select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")

    groups, _ = linked_groups(indexed.select("id", F.explode("keys").alias("key")), info, fits, verify)
    placed = owner.join(groups.select(F.col("id").alias("set_row"), "component"), "set_row", "left").withColumn("g", F.coalesce("component", "set_row", "_row"))
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    heads = placed.groupBy("g").agg(F.min(best).alias("head"))
    out = placed.join(heads, "g")
    return out.select("_row", "doc_id", F.col("n").alias("n_shingles"), F.col("head.doc_id").alias("component_id"), (F.col("_row") == F.col("head._row")).alias("keep"))
