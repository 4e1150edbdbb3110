"""License templates, spelling variants and periodic runs against brute force on small tables with awkward rows."""
import hashlib
import random
import re
import string
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from placeloom.llm import licences, queries, runs, store, tokens, variants

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, lang string, n_words long, places string, word string, n long, runs string, _row long, key string"
GRANT = next(text for name, _, text in licences.TEMPLATES if name == "mit-grant").replace('<<var;match=".{1,8}">>', "this software and associated documentation files")


def table(spark, rows, schema=DOCS):
    path = store.new_path(spark, "test")
    width = schema.count(",") + 1
    spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema).repartition(3).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@pytest.fixture(scope="module")
def awkward(spark):
    texts = {1: "Released under the MIT License. Licensed under CC BY-NC 4.0!", 2: "", 3: None, 4: " \n\t ", 5: "gnu General\nPublic--License mit license mit license", 6: GRANT.title() + " and no more",
             7: "a b " * 40 + "a", 8: "x " * 5, 9: "x " * 6, 10: "Straße Straßen Straßet É éééééé ÉÉÉÉÉÉ ß", 11: "\x00mit\x00license\x1f", 12: "mit " * 30000, 13: " ".join(f"word{k % 7} tail" for k in range(200)),
             14: "wonderful wonderful wonderful wonderfull wonderfull", 15: "permission is hereby granted"}
    rows = [(k, t) for k, t in texts.items()] * 2 + [(None, "mit license"), (None, None), (7, "other text of the same id")] + [(20 + k, "wonderful wonderfull wonderfui strangely strangly strangey " * 3) for k in range(10)]
    return table(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


# ---------------------------------------------------------------- licenses
def ends_by_hand(nodes, words, starts):
    """All places where a match of `nodes` that begins at one of `starts` may stop."""
    for node in nodes:
        if isinstance(node, bytes):
            starts = {s + 1 for s in starts if s < len(words) and words[s] == node}
        elif node[0] == "opt":
            starts = starts | ends_by_hand(node[1], words, starts)
        elif node[0] == "one":
            starts = set().union(*[ends_by_hand(way, words, starts) for way in node[1]])
        else:
            starts = {s + k for s in starts for k in range(node[1], node[2] + 1) if s + k <= len(words)}
    return starts


def matches_by_hand(markup, words):
    nodes, out, free = licences.parse(markup), [], 0
    for s in range(len(words)):
        stops = ends_by_hand(nodes, words, {s})
        if s >= free and stops:
            free = max(stops)
            out.append((s, free))
    return out


MARKUPS = ["a b c", "a <<beginOptional>>b <<beginOptional>>c <<endOptional>><<endOptional>>d", '<<var;match="a|b c|">> d', 'a <<var;match=".{0,2}">> b', 'a <<var;match=".{2,3}">> <<beginOptional>>c <<endOptional>>b',
           '<<beginOptional>>a <<endOptional>><<var;match=".{1,2}">> c', "<<beginOptional>>a <<endOptional>><<beginOptional>>b <<endOptional>>c"]


@pytest.mark.parametrize("markup", MARKUPS)
def test_automata_match_like_sets(markup):
    rng = random.Random(markup)
    matcher = licences.Matcher([("t", "l", markup)], [("a b", "ab")])
    for _ in range(400):
        words = [rng.choice([b"a", b"b", b"c", b"d", b"z"]) for _ in range(rng.randrange(0, 14))]
        base, found = matcher.scan(words)
        assert [(s, e) for *_, s, e in found] == matches_by_hand(markup, words)
        assert base == [("ab", k, k + 2) for k in range(len(words) - 1) if words[k:k + 2] == [b"a", b"b"]]
        line = " " + "".join(w.decode() + " " for w in words)
        assert bool(found) == bool(re.search(licences.as_pattern(markup), line))


@pytest.mark.parametrize("markup", ["<<beginOptional>>a", "a <<endOptional>>", "<<beginOptional>>a <<endOptional>>", '<<var;match=".{0,3}">>'])
def test_faulty_templates_are_refused(markup):
    with pytest.raises(ValueError):
        licences.compiled(markup)


def test_mandatory_wording_must_be_whole():
    matcher, words = licences.Matcher(licences.TEMPLATES, licences.PHRASES), licences.words_of(GRANT.encode())
    assert [x[:2] for x in matcher.scan(words)[1]] == [("mit-grant", "mit")]
    for k in range(len(words)):
        assert not matcher.scan(words[:k] + words[k + 1:])[1] or b"associated" in words[max(0, k - 3):k + 4]


def test_licence_query(spark, awkward, empty):
    got = licences.licence_matches(awkward).collect()
    assert len(got) == awkward.count()
    by = {r.doc_id: r for r in got}
    words = {r.doc_id: licences.words_of((r.text or "").encode()) for r in awkward.filter("doc_id <> 7").collect()}
    for doc_id, w in words.items():
        r = by[doc_id]
        assert r.n_words == len(w)
        assert {(x.template, x.start, x.stop) for x in r.accepted} == {(name, s, e) for name, _, text in licences.TEMPLATES for s, e in matches_by_hand(text, w if len(w) < 1000 else w[:1000])}
    assert [(x.label, x.start) for x in by[5].places] == [("gpl", 0), ("mit", 4), ("mit", 6)]
    assert {x.label for x in by[1].accepted} == {"mit", "cc-by-nc-4.0"} and [x.label for x in by[11].places] == ["mit"] and not by[15].accepted
    assert licences.licence_matches(empty).count() == 0


# ---------------------------------------------------------------- spelling
def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def variants_by_hand(count, ratio=5):
    near = {w: [x for x in count if one_edit(w, x)] for w in count}
    form = {w: min(xs, key=lambda x: (-count[x], x)) for w, xs in near.items() if xs}
    form = {w: f for w, f in form.items() if count[f] >= ratio * count[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {w: (n, len(near[w]), form.get(w), count[form[w]] if w in form else None, root(w)) for w, n in count.items()}


@pytest.mark.parametrize("partitions,segments", [(4, 3), (3, 1), (5, 4)])
def test_variants(spark, partitions, segments):
    rng = random.Random(partitions)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(400)} | {"chain", "chains", "chainss", "chainsss", "aaaaaaa", "aaaaaaaa"}
    count = {w: rng.choice([1, 2, 3, 6, 20, 40, 200, 5000, 5 ** 9]) for w in words} | {"chainsss": 1, "chainss": 5, "chains": 25, "chain": 125}
    got = variants.spelling_variants(table(spark, [*count.items(), (None, 7)], "word string, n long"), partitions=partitions, segments=segments).collect()
    assert len(got) == len(count)
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == variants_by_hand(count)
    assert next(r.root for r in got if r.word == "chainsss") == "chain"


def test_variant_query(spark, awkward, empty):
    count = {}
    for r in awkward.collect():
        for w in re.findall(r"[A-Za-zÀ-ÿ]+", r.text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{w}".encode())
            w = w if h % 199 else w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] = count.get(w, 0) + 1
    count = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    got = variants.spelling_variants(variants.word_counts(awkward, queries.one_letter_less)).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == variants_by_hand(count) and "wonderful" in count
    assert variants.spelling_variants(variants.word_counts(empty)).count() == 0
    raw = {r.word: r.n for r in variants.word_counts(awkward, least_chars=6, least_count=1).collect()}
    assert raw["ÉÉÉÉÉÉ"] == 2 and raw["éééééé"] == 2 and raw["straße"] == 2


def test_signatures_are_not_broadcast_by_estimate(spark):
    """Words of few bytes have 36 signatures each, which a plan doesn't count."""
    words = table(spark.newSession(), [(f"word{k:04}",) for k in range(200)], "word string")
    near = variants.near_words(words)
    assert "BroadcastHashJoin" not in near._jdf.queryExecution().executedPlan().toString()
    assert near.count() == 1900


# ---------------------------------------------------------------- runs
def runs_by_hand(words, exponent=4, least=6):
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, exponent * q) and not any(s <= start and s + m >= i + q for s, m, p in found):
                found[start, i - start + q, q] = True
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.integers(1, 9)), max_size=8), st.sampled_from([(4, 6), (2, 2), (3, 10), (4, 40), (6, 1)]))
def test_runs(blocks, law):
    words = [w for block, times in blocks for w in block * times]
    assert runs.find_runs(np.array(words, np.int64), *law) == runs_by_hand(words, *law)


def test_runs_of_long_periods():
    rng = np.random.default_rng(1)
    for period in (7, 19, 58, 600):
        block = rng.integers(0, 50, period)
        words = np.concatenate([rng.integers(0, 50, 333), np.tile(block, 5)[:4 * period + 3], rng.integers(0, 50, 100)])
        assert (period in {q for _, _, q in runs.find_runs(words)}) and runs.find_runs(words) == runs_by_hand(words.tolist())
    assert runs.find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]


def looped(text, doc_id):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_run_query(spark, awkward, empty, monkeypatch):
    rng = random.Random(4)
    extra = [(k, " ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 90)))) for k in range(100, 260)]
    docs = awkward.unionByName(table(spark, extra))
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    expected = []
    for r in docs.collect():
        words = looped(r.text, r.doc_id)
        got = runs_by_hand(words) if len(words) < 5000 else [(0, len(words), 1)]
        gone = {i for s, n, q in got for i in range(s + q, s + n)}
        top = min(got, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if got else None
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((r.doc_id, len(got), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in got)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in queries.op13_periodic_runs(spark, "").collect()) == order(expected)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in expected)
    assert runs.periodic_runs(empty).count() == 0 and [r.n_runs for r in queries.op13_periodic_runs(spark, "").filter("doc_id IN (8, 9)").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()][0] == 0


# ---------------------------------------------------------------- token ids
def test_words_cut_in_arrow_give_the_ids_of_whole_texts():
    rng = random.Random(2)
    parts = ["Hello", "world.", "3.5", "a,b", "it's", " ", " ", "\x1c", "\n", "  ", "É", "é", "<|endoftext|>", "<|x", "|", "...", "x!?", "\x00", "ﬁ", "日本語", "Abc1.2;"]
    texts = [None, "", " "] + ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 25))) for _ in range(3000)]
    code = tokens.encoder(tokens.vocabulary())
    got = code.texts(pa.array(texts, pa.string()), 7)
    for text, ids in zip(texts, got):
        assert ids.tolist() == code.tokenizer.encode(text or "", add_special_tokens=False).ids + [7]
