"""Rings from member lines: touching rings, open chains, and one ring of very many lines."""
import random

from placeloom.operators import rings

PTS = "k long, line long, pts array<struct<x:double,y:double>>"


def lines_of(ring, cuts):
    """A closed ring of points cut into lines at the given places."""
    whole = ring + ring[:1]
    edges = sorted({0, len(ring), *cuts})
    return [whole[a:b + 1] for a, b in zip(edges, edges[1:])]


def members(spark, key, lines, rng):
    rows = [line if rng.random() < 0.5 else line[::-1] for line in lines]
    rng.shuffle(rows)
    return spark.createDataFrame([(key, n, [(float(x), float(y)) for x, y in pts]) for n, pts in enumerate(rows)], PTS), rows


def rebuilt(found, rows):
    out = {}
    for r in sorted(found, key=lambda r: (r.ring, r.pos)):
        out.setdefault(r.ring, []).extend((rows[r.line][::-1] if r.reversed else rows[r.line])[:-1])
    return out


def same_ring(a, b):
    if len(a) != len(b):
        return False
    k = a.index(b[0]) if b[0] in a else 0
    turned = a[k:] + a[:k]
    return turned == b or [turned[0], *turned[1:][::-1]] == b


def test_rings_and_chains(spark):
    rng = random.Random(3)
    circle = [(10 * k, k * k) for k in range(12)]
    touching = [[(0, 0), (4, 0), (4, 4), (0, 4)], [(4, 4), (8, 4), (8, 8), (4, 8)]]
    chain = [[(100, 0), (101, 0), (102, 5)], [(102, 5), (103, 0)], [(103, 0), (150, 1)]]
    alone = [[(50, 50), (51, 50), (51, 51), (50, 50)]]
    lines = lines_of(circle, [2, 3, 7]) + [x for r in touching for x in lines_of(r, [1, 2])] + chain + alone
    df, rows = members(spark, 1, lines, rng)
    got = rebuilt(rings.ring_members(df, ["k"]).collect(), rows)
    want = [circle, *touching, alone[0][:-1]]
    assert len(got) == 4 and all(any(same_ring(g, [(x, y) for x, y in w]) for w in want) for g in got.values())
    assert all(min(r.line for r in rs) == ring for ring, rs in _by_ring(rings.ring_members(df, ["k"]).collect()).items())


def _by_ring(found):
    out = {}
    for r in found:
        out.setdefault(r.ring, []).append(r)
    return out


def test_one_ring_of_very_many_lines(spark):
    n = 100_000
    order = list(range(n))
    random.Random(1).shuffle(order)
    at = lambda k: (float(k % n), float((k % n) ** 2))
    rows = [(7, line, [at(k), at(k + 1)] if line % 2 else [at(k + 1), at(k)]) for line, k in enumerate(order)]
    found = rings.ring_members(spark.createDataFrame(rows, PTS).repartition(4), ["k"]).collect()
    assert len(found) == n and {r.ring for r in found} == {0} and sorted(r.pos for r in found) == list(range(n))
    path = [order[r.line] for r in sorted(found, key=lambda r: r.pos)]
    step = (path[1] - path[0]) % n
    assert step in (1, n - 1) and all((b - a) % n == step for a, b in zip(path, path[1:]))


def test_relations(spark):
    line = "array<array<struct<x:double,y:double>>>"
    square, hole = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)], [(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0)]
    rows = [(1, lines_of(square, [2]), lines_of(hole, [1])), (2, lines_of(square, [2])[:1], None), (3, None, lines_of(hole, [])), (4, [], [])]
    out = {r.id: r for r in rings.stitch_rings(spark.createDataFrame(rows, f"id long, outer {line}, inner {line}"), ["id"]).collect()}
    assert [[tuple(p) for p in ring] for ring in out[1].rings] == [square, hole] and out[1].closed
    assert not out[2].closed and out[2].rings == [] and not out[3].closed and len(out[3].rings) == 1 and out[4].rings == [] and not out[4].closed
