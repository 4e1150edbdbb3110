"""Broadcasts go by measured sizes, nearest candidates by the distance their level proves, lost pieces by runs of cells, replays by lists of samples,
assets spread over blocks."""
import math

from pyspark.sql import functions as F

from placeloom.operators import audit, joins, resolve
from placeloom.plans.catalog import QUERIES
from placeloom.session import broadcast_measured
from placeloom.streaming import packets as pk


def test_exploded_cells_are_not_broadcast_by_estimate(spark, tmp_path):
    ids = range(60)
    spark.createDataFrame([(k,) for k in ids], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(600 * k,) for k in range(15)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    out = QUERIES["resolve_overlaps"](spark, str(tmp_path))
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == len(ids)


def test_the_limit_of_the_session_stays(spark):
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    other = spark.newSession()
    other.conf.set(planned, "262144")
    for _ in range(2):
        broadcast_measured(other)
        assert (other.conf.get(planned), other.conf.get(measured)) == ("-1", "262144")


def test_only_near_candidates_are_joined(spark):
    targets = [(0, 40 * i + j, 100.0 * i, 100.0 * j) for i in range(40) for j in range(40)]
    points = [(0, k, 61.0 * k % 3900, 37.0 * k % 3900) for k in range(50)] + [(0, 50, 1e6, 5.0)]
    p = spark.createDataFrame(points, "place_id int, p int, x double, y double")
    t = spark.createDataFrame(targets, "place_id int, t int, tx double, ty double")
    at = F.col("tx"), F.col("ty")
    seen = {r.p: r.n for r in joins.knn_candidates(p, t, ["p"], 3, 50.0, None, ["place_id"], "x", "y", at, [*at, *at]).groupBy("p").agg(F.count("*").alias("n")).collect()}
    assert max(n for k, n in seen.items() if k < 50) <= 40
    got = {(r.p, r.rank_no): r.t for r in joins.knn_join(p, t, ["p"], ["t"], 3, 50.0).collect()}
    for _, k, x, y in points:
        best = sorted((math.fsum(((tx - x) ** 2, (ty - y) ** 2)), n) for _, n, tx, ty in targets)[:3]
        assert [got[k, r] for r in (1, 2, 3)] == [n for _, n in best]


def test_lost_pieces_by_hand(spark):
    ring = [(ci, cj) for ci in range(4) for cj in range(4) if not (ci in (1, 2) and cj in (1, 2))]
    rows = [(1, "a", *c) for c in ring] + [(1, "a", 4, 4), (1, "b", 4, 0), (2, "a", 4, 0)] + [(1, "a", 9, cj) for cj in range(3)]
    expected = spark.createDataFrame(rows, "place_id int, class string, ci int, cj int")
    kept = spark.createDataFrame([(1, "a", 9, 1), (2, "b", 4, 0)], expected.schema)
    pieces = sorted(tuple(r) for r in audit.lost_pieces(expected, kept, 2.0, 2.0).select("place_id", "class", "area").collect())
    assert pieces == [(1, "a", 2.0), (1, "a", 2.0), (1, "a", 2.0), (1, "a", 24.0), (1, "b", 2.0), (2, "a", 2.0)]
    assert sorted(tuple(r) for r in audit.cell_accounting(expected, kept).collect()) == [(1, "a", 16, 1, 15, 0), (1, "b", 1, 0, 1, 0), (2, "a", 1, 0, 1, 0), (2, "b", 0, 1, 0, 1)]


def test_replay_in_lists_of_samples(spark, monkeypatch):
    """Stretches of 4 samples in groups of 4, NULL keys and values, no Python call per key."""
    monkeypatch.setattr(pk, "STRETCH", 4)
    values = {(k if k else None, tile): [float((k * 37 + tile * 11 + n * n * 29) % 240) if n % 13 else None for n in range(1, 60 + 7 * k)] for k in range(5) for tile in (0, 1)}
    rows = [(*key, n, v) for key, vs in values.items() for n, v in enumerate(vs, 1)]
    df = spark.createDataFrame(rows, "viewer long, tile long, n long, value double").repartition(5)
    for run, step in ((pk.interest_tiles, pk.next_loaded), (pk.lod_levels, pk.next_level)):
        out = run(df, ["viewer", "tile"], "n")
        assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()
        got = {(r.viewer, r.tile, r.n): r.state for r in out.collect()}
        assert len(got) == len(rows)
        for key, vs in values.items():
            state = 0
            for n, v in enumerate(vs, 1):
                state = int(step(state, math.nan if v is None else v))
                assert got[(*key, n)] == state


def test_what_fits_is_found_once_for_buildings_alike(spark, monkeypatch):
    """Lists of two assets, blocks of 30 buildings: NULL materials, levels that match nothing, a level named twice, ids that are NULL or repeated, equal buildings."""
    monkeypatch.setattr(resolve, "PAGE", 2)
    monkeypatch.setattr(resolve, "SHARE", 30)
    rows = [(k % 190, k % 4 if k % 7 else None, ("house", "church")[k % 2], (None, "brick", "wood")[k % 3], "flat", ("A", "B", None)[k % 3 if k % 5 else 0]) for k in range(200)]
    offers = [(k if k % 9 else None, "approved" if k % 4 else "draft", "x" if k % 11 else None, ["A", "B", "A"][:1 + k % 3], ["brick"] if k % 3 == 0 else [], [], ["house"] if k % 2 else [], k % 3, 3) for k in [*range(30), 7, 7]]
    buildings = spark.createDataFrame(rows, "b_id long, levels long, kind string, material string, roof_shape string, lod string")
    assets = spark.createDataFrame(offers, "asset_id long, status string, evidence string, lods array<string>, materials array<string>, roof_shapes array<string>, kinds array<string>, min_levels long, max_levels long")
    out = resolve.asset_match(buildings, assets)
    want = [(b[0], b[1], a[0]) for b in rows for a in offers if a[1] == "approved" and a[2] for lod in a[3] if lod == b[5] and b[1] is not None and a[7] <= b[1] <= a[8]
            if (not a[4] or b[3] in a[4]) and (not a[6] or b[2] in a[6])]
    low = lambda rs: sorted(tuple(-1 if v is None else v for v in r) for r in rs)
    assert low((r.b_id, r.levels, r.asset_id) for r in out.collect()) == low(want)
    # Buildings meet lists; pairs are made after the last shuffle.
    assert "Generate inline" in out._jdf.queryExecution().optimizedPlan().toString()


def test_buildings_of_one_level_are_spread(spark):
    buildings = spark.createDataFrame([(k, k % 5, "house", "brick", "flat", "C") for k in range(200)], "b_id long, levels long, kind string, material string, roof_shape string, lod string")
    assets = spark.createDataFrame([(1, "approved", "x", ["C", "A"], [], [], [], 1, 2), (2, "approved", "x", ["C"], ["wood"], [], [], 0, 9), (3, "draft", "x", ["C"], [], [], [], 0, 9), (4, "approved", "x", ["B"], [], [], [], 0, 9)],
                                   "asset_id long, status string, evidence string, lods array<string>, materials array<string>, roof_shapes array<string>, kinds array<string>, min_levels long, max_levels long")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = resolve.asset_match(buildings, assets)
        assert out.columns == [*buildings.columns, "asset_id"]
        assert sorted((r.b_id, r.asset_id) for r in out.collect()) == [(k, 1) for k in range(200) if k % 5 in (1, 2)]
        assert out.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
