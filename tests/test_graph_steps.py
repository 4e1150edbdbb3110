"""Components, paths and routes: small places in one task each, large ones by rounds, both with the same rows."""
import random

import pytest

from placeloom.operators import graph, windows


def jobs(monkeypatch):
    """The checkpoints that graph operators write from here on."""
    made, cut = [], graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: made.append(1) or cut(df))
    return made


def network(spark, seed=5):
    rng = random.Random(seed)
    edges = {(p, min(a, b), max(a, b)): rng.randint(1, 9) for p in range(3) for a, b in ((rng.randint(0, 60), rng.randint(0, 60)) for _ in range(55)) if a != b}
    edges |= {(7, k, k + 1): 1 + k % 3 for k in range(300)}
    rows = [(p, a, b, float(w), 1) for (p, a, b), w in edges.items()]
    return edges, spark.createDataFrame(rows, "place_id long, a long, b long, length double, way_id long").repartition(5)


@pytest.mark.parametrize("held", [1 << 20, 3, 1])
def test_components_need_no_rounds_where_a_place_fits_a_task(spark, monkeypatch, held):
    edges, table = network(spark)
    ends = {(p, v) for p, a, b in edges for v in (a, b)} | {(0, 1000)}
    want = {e: e[1] for e in ends}
    for _ in range(400):
        for p, a, b in edges:
            want[p, a] = want[p, b] = min(want[p, a], want[p, b])
    made = jobs(monkeypatch)
    tie = graph.contract_locally
    monkeypatch.setattr(graph, "contract_locally", lambda e: tie(e, held))
    got = graph.connected_components(spark.createDataFrame(sorted(ends), "place_id long, v long"), table)
    assert {(r.place_id, r.v): r.component for r in got.collect()} == want
    if held > 1000:
        assert len(made) == 1


def test_paths_and_routes_of_small_and_large_places_are_the_same(spark, monkeypatch):
    _, table = network(spark)
    sources = spark.createDataFrame([(0, 0, 1), (0, 1, 2), (1, 0, 3), (7, 0, 20), (9, 0, 4)], "place_id long, route_id int, v long")
    rows = lambda df: sorted(map(tuple, df.select("place_id", "route_id", "v", "dist", "hops", "parent").collect()), key=str)
    by_rounds = graph.shortest_paths(table, sources, held=0)
    mixed = graph.shortest_paths(table, sources, held=200)  # place 7 is larger
    made = jobs(monkeypatch)
    whole = graph.shortest_paths(table, sources)
    assert len(made) <= 3
    assert rows(whole) == rows(mixed) == rows(by_rounds) and (9, 0, 4, 0.0, 0, None) in rows(whole)
    targets = spark.createDataFrame([(0, 0, 55), (0, 1, 2), (7, 0, 290), (7, 0, 0), (1, 0, 999)], "place_id long, route_id int, v long")
    made.clear()
    walked = rows(graph.routes(whole, targets))
    assert len(made) <= 2
    assert walked == rows(graph.routes(whole, targets, held=0)) == rows(graph.routes(whole, targets, held=200)) and len(walked) > 290


def test_consecutive_pairs_need_one_shuffle_after_the_junctions(spark):
    line = lambda place, way, nodes: (place, way, [(float(n), 0.0) for n in nodes], nodes)
    lines = spark.createDataFrame([line(0, 1, [1, 2, 2, 5, 9]), line(0, 2, [4]), line(0, 3, [2, 7]), line(1, 4, [9, 1])],
                                  "place_id long, way_id long, pts array<struct<x:double,y:double>>, nodes array<bigint>")
    nodes = spark.createDataFrame([(0, n) for n in (1, 2, 9)], "place_id long, node_id long")
    pairs = windows.consecutive_pairs(lines, nodes)
    assert sorted(map(tuple, pairs.collect())) == [(0, 1, 1, 2, 1.0), (0, 1, 2, 9, 7.0)]
    assert pairs._jdf.queryExecution().sparkPlan().toString().count("Join") == 1
