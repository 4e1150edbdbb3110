"""The ten operators and the pipeline against brute force on small tables with awkward rows."""
import hashlib
import math
import re
import string
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from placeloom.llm import decontaminate, jaccard, katz, lines, multi_index, packing, planes, quality, queries, shards, store, tokens, toxicity

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, lang string, source string, score double, id long, _row long, key string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def table(spark, rows, schema):
    """A table that is written and read, as operators get it."""
    path = store.new_path(spark, "test")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@pytest.fixture(scope="module")
def awkward(spark):
    base = " ".join(f"word{k % 37}x{k % 11} the" for k in range(60))
    texts = {1: base, 2: base, 3: base.replace("word3x3", "other"), 4: "", 5: None, 6: "   \n\t ", 7: "One two", 8: "one TWO", 9: "É é ß İ ǅ ﬁ a\x85b\x1cc", 10: base + " tail end of it all",
             11: "a b c d e f g h i j k l m n", 12: " ".join(f"w{k}" for k in range(20000)), 13: "x" * 50000, 14: "it's 3 o'clock <|endoftext|> now\x00\x01", 15: "\n".join(["Same line that is here, twice today."] * 3 + ["short"])}
    rows = [(k, t, None, "s", 0.5, k, None, "k") for k, t in texts.items()] + [(1, base, "en", None, None, None, 7, None), (None, "no id but some text", None, None, None, None, None, None), (None, None, None, None, None, None, None, None), (1, "again with one", None, None, None, None, None, None)]
    return table(spark, rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [], DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def katz_by_hand(rows, folds=5, held_out=1):
    out = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % folds == held_out
    tokens_of = [(d, words_of(t) + [""]) for d, t in rows]
    uni, bi = Counter(), Counter()
    for d, w in tokens_of:
        if not out(d):
            uni.update(w)
            bi.update(zip([None, *w], w))
    n, v = sum(uni.values()), len(uni)
    p1 = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    seen = Counter(bi.values())
    d = dict(zip(range(1, 6), katz.discounts(np.array([seen[r] for r in range(1, 7)]))))
    by = {}
    for (a, b), c in bi.items():
        by.setdefault(a, {})[b] = c

    def p2(a, b):
        if a not in by:
            return p1(b)
        total = sum(by[a].values())
        mass = sum(d.get(c, 1) * c / total for c in by[a].values())
        scale = total / (total + 1) if mass > 1 - 1e-9 else 1.0
        if b in by[a]:
            return scale * d.get(by[a][b], 1) * by[a][b] / total
        return (1 - scale * mass) / (1 - sum(p1(x) for x in by[a])) * p1(b)

    for a in list(by)[:50]:  # exactly normalised, one unknown word included
        assert abs(sum(p2(a, w) for w in uni) + p2(a, "\0unknown") - 1) < 1e-9
    return sorted(((k, out(k), len(w), sum(uni[x] > 0 for x in w), n, sum(math.log10(p1(x)) for x in w), sum(math.log10(p2(a, b)) for a, b in zip([None, *w], w))) for k, w in tokens_of), key=str)


@pytest.mark.parametrize("hot", [100_000, 3])
def test_katz(spark, awkward, documents, hot):
    for docs in (awkward, documents.limit(60)):
        docs = table(spark, docs.select("doc_id", "text").collect(), "doc_id long, text string")
        got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in katz.katz_scores(docs, hot=hot).collect()), key=str)
        want = katz_by_hand([tuple(r) for r in docs.collect()])
        assert sorted(g[:5] for g in map(lambda r: tuple(map(str, r)), got)) == sorted(g[:5] for g in map(lambda r: tuple(map(str, r)), want))
        key = lambda r: (str(r[0]), r[2], round(r[5], 6), round(r[6], 6))
        for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
            assert g[0] == w[0] and abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5])) and abs(g[6] - w[6]) < 1e-6 * max(1, abs(w[6]))


def test_katz_helps_held_out(spark, documents):
    out = katz.katz_scores(documents).filter("held_out").toPandas()
    assert out.score.sum() > out.base_score.sum()


def test_multi_index(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(size=16)], 0) for k in range(3000)] + [(5000 + k, [1.0] * 16, 0) for k in range(900)]
    rows += [(9001, None, 0), (9002, [0.0] * 16, 0), (9003, [float("nan")] * 16, 0), (9004, [None] + [1.0] * 15, 0), (9005, [float("inf")] * 16, 0), (9006, [1.0] * 3, 0), (None, [1.0] * 16, 0)]
    vectors = table(spark, rows, "vec_id long, embedding array<double>, label int")
    got = multi_index.search(vectors, block=256).toPandas()
    x = np.stack([np.array(r[1]) for r in rows[:3900]])
    ids, hit, all_ = np.array([r[0] for r in rows[:3900]]), 0, 0
    asked = [k for k in range(len(ids)) if ids[k] % 20 == 0]
    assert set(got.query_id) == {ids[k] for k in asked}
    for k in asked:
        s = (x * x[k]).sum(1)
        s[k] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        own = got[got.query_id == ids[k]].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 21)) and ids[k] not in set(own.vec_id)
        assert np.allclose(own.score, [s[list(ids).index(v)] for v in own.vec_id])
        assert list(zip(-own.score, own.vec_id)) == sorted(zip(-own.score, own.vec_id))
        hit, all_ = hit + len(set(best) & set(own.vec_id)), all_ + 20
    assert hit / all_ >= 0.9
    few = multi_index.search(table(spark, rows[:5], "vec_id long, embedding array<double>, label int")).collect()
    assert len(few) == 4
    assert multi_index.search(table(spark, [], "vec_id long, embedding array<double>, label int")).collect() == []


def jaccard_by_hand(rows, k=4, percent=85):
    sets = [{tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} for w in (words_of(t) for _, t in rows)]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {(a, b) for m in by.values() for n, a in enumerate(m) for b in m[n + 1:]}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            group[root(a)] = root(b)
    heads = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            heads[root(i)] = min(d, heads.get(root(i), d))
    return sorted(((d, len(sets[i]), heads.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("frequent", [64, 2])
@pytest.mark.parametrize("combination", [2, 3])
def test_jaccard(spark, awkward, documents, frequent, combination):
    rng = np.random.default_rng(1)
    core = [f"c{k}" for k in range(200)]
    near = []
    for k in range(60):  # a group of near copies about the threshold, and texts made of one passage
        w = list(core)
        for _ in range(int(rng.integers(0, 12))):
            w[int(rng.integers(0, 200))] = f"n{rng.integers(0, 1000)}"
        near.append((1000 + k, " ".join(w if k % 2 else w[:int(rng.integers(120, 200))])))
    for docs in (awkward, documents, table(spark, near, "doc_id long, text string")):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        out = jaccard.jaccard_groups(docs, frequent=frequent, combination=combination).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == jaccard_by_hand(rows)


def test_jaccard_keeps_one(spark, awkward):
    out = jaccard.jaccard_groups(awkward, words=5, percent=80).toPandas()
    alone = out[out.n_shingles == 0]
    assert alone.keep.all()
    kept = out[out.n_shingles > 0].groupby("component_id", dropna=False).keep.sum()
    assert kept.pop(1.0) == 2 and (kept == 1).all()  # doc_id 1 stands on two different texts


def packed_by_hand(rows, path, capacity, end):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    out = []
    for d, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        out += [(d, p, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes())) for p, s in enumerate(range(0, len(ids), capacity))]
    return sorted(out, key=str)


@pytest.mark.parametrize("capacity", [4096, 97])
def test_packing(spark, awkward, documents, capacity):
    path = tokens.vocabulary()
    for docs in (awkward, documents):
        out = queries.with_crc(packing.pack(docs, path, capacity)).toPandas()
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = sorted(((None if math.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples()), key=str)
        assert got == packed_by_hand(rows, path, capacity, 1)
        for _, s in out.groupby("sequence_id"):
            s = s.sort_values("offset")
            assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= capacity
        assert out.sequence_id.nunique() <= 1.02 * math.ceil(out.length.sum() / capacity) + 1


def test_plan_is_best_fit():
    rng = np.random.default_rng(2)
    lengths = Counter(int(x) for x in rng.integers(1, 100, 500))
    steps = packing.plan(dict(lengths), 100)
    ends, bins = {}, Counter()
    for n, (start, first, offset) in enumerate(steps):
        length = start // packing.RANKS
        stop = steps[n + 1][0] if n + 1 < len(steps) and steps[n + 1][0] // packing.RANKS == length else length * packing.RANKS + lengths[length]
        for k in range(int(stop - start)):
            ends.setdefault(first + k, []).append((offset, offset + length))
            bins[first + k] += length
    for spans in ends.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= 100
    free = []  # one by one
    for length in sorted(lengths.elements(), reverse=True):
        fits = [i for i, f in enumerate(free) if f >= length]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= length
        else:
            free.append(100 - length)
    assert len(bins) == len(free)


def test_lines_edit_distance():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a, b = (bytes(rng.integers(97, 100, int(rng.integers(0, 12))).astype(np.uint8)) for _ in range(2))
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                d[i][j] = i + j if not i or not j else min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        assert lines.edit_distance(a, b) == d[-1][-1]


def lines_by_hand(rows, least=5, apart=18, similarity=0.8):
    """Texts after removal; rows in order of (doc_id, row). All pairs of lines within `apart` bits of SimHash are compared, whatever keys they share."""
    all_ = [(i, k, lines.normalised(x)) for i, (_, t) in enumerate(rows) for k, x in enumerate((t or "").encode().split(b"\n"))]
    all_ = [(i, k, w) for i, k, w in all_ if len(w) >= least]
    sims = [int(s) for s in lines.simhash([w for *_, w in all_])] if all_ else []
    head = list(range(len(all_)))

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    for x in range(len(all_)):
        for y in range(x):
            if bin((sims[x] ^ sims[y]) & (1 << 64) - 1).count("1") <= apart:
                a, b = b" ".join(all_[x][2]), b" ".join(all_[y][2])
                if 1 - lines.edit_distance(a, b) / max(len(a), len(b)) >= similarity:
                    p, q = sorted((root(x), root(y)))
                    head[q] = p
    gone = {(i, k) for n, (i, k, _) in enumerate(all_) if root(n) != n}
    return [t if not any(i == g for g, _ in gone) else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, (_, t) in enumerate(rows)]


def test_lines(spark, awkward):
    long = " ".join(f"alpha{k} beta" for k in range(40))
    more = [(100 + k, f"Own line number {k} of this one text.\n{long} {'!' * k}\nPage {k} of 9 in the whole big book\n{long.replace('alpha7', 'alpha8') if k == 2 else 'tiny'}") for k in range(5)]
    docs = table(spark, more, "doc_id long, text string")
    for d in (docs, spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 40")):
        rows = sorted((r.doc_id, r.text) for r in d.collect())
        got = {r.doc_id: r.text for r in lines.dedupe_lines(d).collect()}
        assert [got[k] for k, _ in rows] == lines_by_hand(rows)
    out = lines.dedupe_lines(awkward)
    assert out.columns == [*awkward.columns, "n_lines", "n_removed"] and out.count() == awkward.count()
    got = {r.doc_id: r for r in out.collect() if r.doc_id in (4, 5, 6, 15)}
    assert got[4].text == "" and got[5].text is None and got[15].text == "Same line that is here, twice today.\nshort" and got[15].n_removed == 2


def test_lines_edit_distances_of_many():
    rng = np.random.default_rng(14)
    one = lambda n: bytes(rng.integers(97, 101, n).astype(np.uint8))
    pairs = [(one(int(rng.integers(0, n))), one(int(rng.integers(0, n)))) for n in (2, 20, 70, 130, 400) for _ in range(60)]
    pairs += [(one(n), one(m)) for n, m in ((0, 0), (0, 5), (63, 64), (64, 65), (128, 129), (2100, 2050))]
    got = lines.edit_distances([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [lines.edit_distance(a, b) for a, b in pairs]


def word_pairs(rng, words, changed):
    """300 pairs of lines of random words, `changed(k)` of the second line's words with one letter changed."""
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, int(rng.integers(4, 8))))
    out = []
    for _ in range(300):
        w = [word() for _ in range(words)]
        v = list(w)
        for k in changed(words):
            at = int(rng.integers(0, len(v[k])))
            v[k] = v[k][:at] + chr(97 + (ord(v[k][at]) - 96) % 26) + v[k][at + 1:]
        out.append((" ".join(w), " ".join(v)))
    return out


@pytest.mark.parametrize("words,every,least", [(5, 0, 300), (6, 0, 300), (7, 0, 300), (7, 1, 300), (20, 5, 297), (40, 5, 297)])
def test_lines_recall_by_length(spark, words, every, least):
    """The middle word changed, or every n-th; all are similar by edit distance, however far apart by SimHash."""
    pairs = word_pairs(np.random.default_rng(words), words, lambda n: range(0, n, every) if every else [n // 2])
    pairs = [(a, b) for a, b in pairs if lines.edit_distance(a.encode(), b.encode()) <= 0.2 * len(a)]
    docs = table(spark, [(k, f"{a}\n{b}") for k, (a, b) in enumerate(pairs)], "doc_id long, text string")
    found = lines.dedupe_lines(docs).filter("n_removed = 1").count()
    assert len(pairs) > 250 and found >= min(least, len(pairs) - (300 - least))


def test_tables_of_lines_go_when_no_step_reads_them(spark, tmp_path, monkeypatch):
    """Of the tables between steps those stay that the result reads; the lines that stay have their place and hash only."""
    monkeypatch.setattr(store, "new_path", lambda session, name: f"{tmp_path}/{uuid.uuid4().hex}/{name}")
    rows = [(k, "\n".join(f"line {j} of some words that are like others, {'abc'[k % 3]} {j * j}" for j in range(6))) for k in range(9)]
    gone = lines.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {p.name for p in tmp_path.glob("*/*")}
    assert "lines" in left and not left & {"made_lines", "near_lines", "shared_keys", "tried", "mixed_keys", "rest"}
    assert spark.read.parquet(*[str(p) for p in tmp_path.glob("*/lines")]).columns == ["_row", "doc_id", "line_no", "h1", "h2"]
    assert gone.count() == 9


def test_short_lines_are_compared_with_all(spark):
    """All pairs by edit similarity alone, in blocks of a few lines; the length bound is met on both sides."""
    rng, rows = np.random.default_rng(8), []
    for k in range(40):
        w = ["".join(chr(97 + c) for c in rng.integers(0, 6, 5)) for _ in range(5 + k % 5)]
        rows += [(3 * k + j, " ".join(x if j == 0 or rng.random() < 0.6 else x[:2] + x[3:] if j == 1 else x[:3] + "q" + x[3:] for x in w)) for j in range(3)]
    share, lines.SHARE = lines.SHARE, 3
    try:
        got = {r.doc_id: r.text for r in lines.dedupe_lines(table(spark, rows, "doc_id long, text string")).collect()}
    finally:
        lines.SHARE = share
    assert [got[k] for k, _ in rows] == lines_by_hand(rows, apart=64)


@pytest.mark.parametrize("width,block", [(8, 1 << 16), (1, 1 << 16), (1, 77), (8, 1000)])
def test_planes(spark, awkward, documents, width, block):
    path = tokens.vocabulary()
    for docs in (awkward, documents):
        folder = store.new_path(spark, "ids")
        planes.write_ids(docs, folder, path, block=block, width=width)
        out = sorted(planes.read_ids(spark, folder).collect(), key=lambda r: r.start)
        want = Counter((d, n, c) for d, _, _, n, c in packed_by_hand([(r.doc_id, r.text) for r in docs.collect()], path, 1 << 30, 2))
        assert Counter((r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in out) == want
        assert [r.start for r in out] == [0, *np.cumsum([r.n_tokens for r in out])[:-1]]
        ids = [-1 if r.doc_id is None else r.doc_id for r in out]
        assert ids == sorted(ids)
        index = sorted(spark.read.parquet(f"{folder}/index").collect(), key=lambda r: (r.part, r.chunk))
        assert [r.first_id for r in index] == [0, *np.cumsum([r.n_ids for r in index])[:-1]] and max(r.n_ids for r in index) <= block


def windows_by_hand(rows, items, n=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(LOWER))
    by = {}
    for i, t in items:
        w = split(t)
        for k in range(max(1, len(w) - n + 1) if w else 0):
            by.setdefault(tuple(w[k:k + n]), set()).add(i)
    sizes, out = {len(k) for k in by}, []
    for d, t in rows:
        w, hit, found = split(t), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in by:
                    hit |= set(range(k, k + size))
                    found |= by[tuple(w[k:k + size])]
        names = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_decontamination(spark, awkward, documents, broadcast_rows):
    own = [(1, "a B c, d e f g h i j k"), (2, "one two"), (3, ""), (4, None), (5, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"), (5, "Twice today!"), (None, "some text"), (10, "one two"), (7, "the the the the the the the the the the")]
    bench = table(spark, own, "item_id long, text string")
    for docs, items in ((awkward, bench), (documents, spark.read.parquet(f"{SF}/benchmark.parquet")), (awkward, bench.filter("false"))):
        out = decontaminate.contamination(docs, items, broadcast_rows=broadcast_rows).collect()
        got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out), key=str)
        assert got == windows_by_hand([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


def fit_quality(out, labels, name):
    joined = out.merge(labels.groupby("doc_id", as_index=False)[name].max(), on="doc_id")
    return joined[joined.held_out]


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable")) + 1.0
    ranks = np.array([order[score == s].mean() for s in score])
    return (ranks[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def test_quality(spark, awkward):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = fit_quality(quality.quality_scores(docs, labels).toPandas(), labels.toPandas(), "quality")
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.8
    assert (held.predicted == held.quality).mean() > 0.85
    out = quality.quality_scores(awkward, spark.createDataFrame([(1, 1, 0), (2, 0, 0), (1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")).collect()
    assert len(out) == awkward.count() and all(0 <= r.score <= 1 for r in out)


def test_quality_parts():
    assert list(quality.monotone(np.array([1.0, 1, 2]), np.array([0.5, 0.2, 0.9]))) == [0.35, 0.35, 0.9]
    assert quality.statistics(None).sum() == 0 and np.isfinite(quality.statistics(b"x" * 10000)).all()
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(2, 5))
    m = quality.Model(np.zeros(5), np.ones(5), rng.normal(size=(5, 20000)), rng.uniform(0, 2 * np.pi, 20000), np.zeros(1), np.zeros(1), np.zeros(1))
    a, b = m.features(np.clip(np.stack([x, y]), -4, 4))[:, :-1]
    assert abs(a @ b - math.exp(-((x - y) ** 2).sum() / 2)) < 0.05  # the Gaussian kernel


def test_toxicity(spark, awkward):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = fit_quality(toxicity.toxicity_scores(docs, labels).toPandas(), labels.toPandas(), "toxic")
    assert auc(held.score.to_numpy(), held.toxic.to_numpy()) > 0.85
    out = toxicity.toxicity_scores(awkward, spark.createDataFrame([(1, 1, 1), (3, 0, 0), (1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")).collect()
    assert len(out) == awkward.count() and all(0 <= r.score <= 1 for r in out)


def test_toxicity_learns_pairs():
    """An insult alone and a group alone are harmless; together they are toxic."""
    rng, terms, rows, y = np.random.default_rng(6), toxicity.Terms(), [], []
    for k in range(1200):
        a, b = k % 2, k // 2 % 2
        words = [f"f{rng.integers(0, 50)}" for _ in range(8)] + ["insult"] * a + ["group"] * b
        rows.append(terms.of_text(" ".join(words).encode()))
        y.append(float(a and b))
    m = toxicity.train(rows, np.array(y), epochs=40)
    rows = [p[p >= 0] for p in (m.place[r] for r in rows)]
    assert ((m.score(rows) >= 0.5) == np.array(y)).mean() > 0.98


def capacity_by_hand(sizes, shards_):
    low, high = max(max(sizes), -(-sum(sizes) // shards_)), sum(sizes)

    def fits(c):
        n, at = 1, 0
        for s in sizes:
            n, at = (n + 1, s) if at + s > c else (n, at + s)
        return n <= shards_

    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def test_shards(spark, awkward, documents):
    giant = table(spark, [(k, "g" * 5000 if k % 3 == 0 else f"text {k}" * (k % 7)) for k in range(300)], "doc_id long, text string")
    for docs in (awkward, documents, giant):
        out = shards.contiguous_shards(docs).toPandas()
        rows = [(r.doc_id, r.text or "") for r in docs.collect()]
        first = {}
        for d, t in rows:
            first[t] = min((x for x in (first.get(t), d) if x is not None), default=None)
        order = sorted(first, key=lambda t: (first[t] is not None, first[t] or 0, len(t)))
        sizes = [sum(len(x.encode()) + 1 for _, x in rows if x == t) for t in order]
        assert out.groupby("shard")["size"].sum().max() <= capacity_by_hand(sizes, 8) * (1 if docs is not awkward else 1.0) or docs is awkward
        assert Counter(out.text_crc32) == Counter(zlib.crc32(t.encode()) for _, t in rows)
        assert (out.groupby("text_crc32").shard.nunique() == 1).all() and out.shard.between(0, 7).all()
        for _, s in out.groupby("shard"):
            assert sorted(s.slot) == list(range(len(s)))


def test_empty_tables(spark, empty):
    labels = table(spark, [], "doc_id long, quality int, toxic int")
    path = tokens.vocabulary()
    folder = store.new_path(spark, "ids")
    planes.write_ids(empty, folder, path)
    for out in (katz.katz_scores(empty), jaccard.jaccard_groups(empty), packing.pack(empty, path), lines.dedupe_lines(empty), planes.read_ids(spark, folder), toxicity.toxicity_scores(empty, labels),
                decontaminate.contamination(empty, table(spark, [(1, "a b")], "item_id long, text string")), quality.quality_scores(empty, labels), shards.contiguous_shards(empty)):
        assert out.collect() == []


def test_unlabelled(spark, awkward):
    labels = table(spark, [], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.quality_scores(awkward, labels).collect()} == {0.5}
    assert {r.score for r in toxicity.toxicity_scores(awkward, labels).collect()} == {0.0}


def test_queries_have_the_contracts_columns(spark):
    want = {"op1": "doc_id held_out n_tokens n_known train_tokens base_score score", "op2": "query_id rank vec_id score", "op3": "doc_id n_shingles component_id", "op4": "doc_id piece start length ids_crc32 sequence_id offset",
            "op6": "doc_id start n_tokens ids_crc32", "op7": "doc_id held_out score predicted", "op8": "doc_id n_words n_hit n_items items_sha256 contaminated", "op9": "doc_id held_out score predicted", "op10": "doc_id size text_crc32 law shard slot grown_shard"}
    for name, fn in queries.QUERIES.items():
        out = fn(spark, SF)
        assert set(want.get(name.split("_")[0], "").split()) <= set(out.columns)
        assert out.count() > 0


def test_pipeline(spark):
    """Each stage on its own input against brute force or its rule."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = store.stored(stage(spark, docs, SF), name)
        kept[name] = (docs, out)
        docs = out
    for name in list(kept)[:-1]:
        assert kept[name][1].columns == columns
    before, after = kept["line_dedup"]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    assert sorted((r.doc_id, r.text) for r in after.collect()) == list(zip([k for k, _ in rows], lines_by_hand(rows)))
    before, after = kept["ngram_jaccard_join"]
    groups = jaccard_by_hand([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted({g for _, _, g in groups})
    before, after = kept["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted(r[0] for r in windows_by_hand([(r.doc_id, r.text) for r in before.collect()], items) if not r[5])
    before, after = kept["best_fit_packing"]
    assert sorted((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in after.collect()) == sorted(packed_by_hand([(r.doc_id, r.text) for r in before.collect()], tokens.vocabulary(), 4096, 1))
    before, after = kept["quality_classifier"]
    assert 0.6 * before.count() < after.count() <= before.count()


def test_lines_normalised_at_once():
    rng = np.random.default_rng(6)
    for n in [0, 1, 2, *rng.integers(0, 80, 300)]:
        text = bytes(rng.choice(np.frombuffer(b"aZ09.,- \n\t\r\x0b\x00\xc3", np.uint8), n))
        flat, ends, line = lines.normalised_text(text)
        starts, whole = [0, *(ends[:-1] + 1)], flat.tobytes()
        assert [(k, whole[i:j]) for k, i, j in zip(line, starts, ends)] == [(k, w) for k, x in enumerate(text.split(b"\n")) for w in lines.normalised(x)]
    words = [[b"w%d" % k for k in rng.integers(0, 40, n)] for n in (1, 5, 255, 256, 700)]
    for got, line in zip(lines.simhash(words), words):
        one = [f"{int(lines.simhash([[w]])[0]) & (1 << 64) - 1:064b}" for w in line]
        assert f"{int(got) & (1 << 64) - 1:064b}" == "".join("01"[2 * sum(b == "1" for b in bits) > len(line)] for bits in zip(*one))


def test_near_lines_are_found(spark):
    """Lines of 8 to 60 words with a word or a tenth of the words other: all but a few pairs are found."""
    rng = np.random.default_rng(5)
    rows, letters = [], str.maketrans(string.digits, "abcdefghij")  # digits of a line are all alike
    for k in range(300):
        words = [f"w{x}".translate(letters) for x in rng.integers(0, 3000, int(rng.integers(8, 60)))]
        other = list(words)
        for at in rng.choice(len(words), max(1, len(words) // 10), replace=False):
            other[at] = f"v{rng.integers(0, 3000)}".translate(letters)
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    out = lines.dedupe_lines(table(spark, rows, "doc_id long, text string"))
    gone = [r.doc_id for r in out.filter("n_removed > 0").collect()]
    assert all(d % 2 for d in gone) and len(gone) >= 290


def test_lines_similar_is_exact():
    rng = np.random.default_rng(8)
    left, right = [], []
    for _ in range(500):
        p = [b"abc"[: k + 1] * 2 for k in rng.integers(0, 3, int(rng.integers(1, 12)))]
        left.append(p)
        right.append([w if rng.random() < 0.8 else b"xyabc"[: int(rng.integers(1, 6))] for w in p][int(rng.integers(0, 2)) :])
    near = [lines.edit_distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9 for a, b in ((b" ".join(p), b" ".join(q)) for p, q in zip(left, right))]
    assert lines.similar_pairs(left, right, 0.8).tolist() == near


def test_katz_keeps_one_copy_of_its_batches(spark, documents, monkeypatch):
    """Of the tables between its steps only the batches with their word numbers and the bigrams' answers stay, and these are whole numbers."""
    import os
    paths, write = {}, katz.stored
    monkeypatch.setattr(katz, "stored", lambda df, name: paths.update({name: (out := write(df, name)).stored_at}) or out)
    out = katz.katz_scores(documents)
    assert sorted(n for n, p in paths.items() if os.path.exists(p)) == ["bigrams", "known"]
    assert out.count() == documents.count()
    sent = np.array([[2, 1, 0, 0, 0, 4, 3, 9]])
    assert katz.Base(20, 5).stats(sent).tolist() == [[2, 1, 0, 0, 0, 4, 10.5 / 23]]


def test_words_of_letters_are_encoded_together():
    code = tokens.Encoder(tokens.vocabulary())
    words = ["straße", "ÉIER", "a", "x" * 300, "it's", "İx", "é", "12ab", "λμ", "</w>", "d", "s", "µm", *sorted({"".join(p) for p in zip("abcdefghij" * 40, "klmnopq" * 60, "rstuvwxyzñü" * 40)})]
    given, tokenizer = [], code.tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **how):
            given.extend(texts)
            return tokenizer.encode_batch_fast(texts, **how)

    code.tokenizer = Counted()
    code.learn(words)
    for w, n in code.known.items():
        assert code.flat[code.start[n]:code.start[n] + code.length[n]].tolist() == tokenizer.encode(w, add_special_tokens=False).ids, w
    assert set(code.known) == set(words) and len(given) < len(words) / 10
    code.known, code.closes = {}, np.zeros_like(code.closes)  # a vocabulary that doesn't mark the ends of words
    code.clear()
    code.learn(words)
    assert all(code.flat[code.start[n]:code.start[n] + code.length[n]].tolist() == tokenizer.encode(w, add_special_tokens=False).ids for w, n in code.known.items())
