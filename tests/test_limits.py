"""Nothing is lost at the ends: far targets, NULL keys, holes, text classes, antipodes."""
import math

import numpy as np

from pyspark.sql import functions as F

from placeloom.operators import aggregate, audit, geometry as geo, joins, resolve, scale, windows


def test_far_target_is_found(spark):
    pts = spark.createDataFrame([(0, 1, 0.0, 0.0)], "place_id int, p int, x double, y double")
    seg = spark.createDataFrame([(0, 1, 5e5, 0.0, 5e5, 10.0)], "place_id int, s int, x1 double, y1 double, x2 double, y2 double")
    out = joins.nearest_join(pts, seg, ["p"], ["s"], 500.0).collect()
    assert len(out) == 1 and out[0].d2 == 2.5e11


def test_more_neighbours_than_are_near(spark):
    pts = spark.createDataFrame([(0, 1, 0.0, 0.0)], "place_id int, p int, x double, y double")
    far = spark.createDataFrame([(0, k, float(3 ** k), 0.0) for k in range(9)], "place_id int, t int, tx double, ty double")
    assert [r.t for r in sorted(joins.knn_join(pts, far, ["p"], ["t"], 7, 1.0).collect(), key=lambda r: r.rank_no)] == list(range(7))


def test_null_keys_are_numbered(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert sorted((r.k or "", r.row_no) for r in scale.spread_row_number(rows, ["k"], ["v"]).collect()) == [("", 1), ("", 2), ("a", 1)]
    seq = spark.createDataFrame([(None, 0, 1.0), (None, 1, 2.0), ("a", 0, 5.0)], "k string, s int, v double")
    assert sorted((r.k or "", r.o) for r in scale.running_sum(seq, ["k"], "s", F.col("v"), "o").collect()) == [("", 1.0), ("", 3.0), ("a", 5.0)]


def test_hole_is_no_border(spark):
    row = spark.createDataFrame([(0, 0, i, z) for i, z in enumerate([100.0, 1.0, None, 1.0, 1.0, 1.0, 1.0])], "place_id int, j int, i int, z double")
    blurred = {r.i: r.z for r in windows.raster_blur(row, 0.4).collect()}
    assert blurred[3] == 1.0


def test_text_classes_and_far_cells(spark):
    cells = spark.createDataFrame([(0, "lake", 10 ** 6 + i, -10 ** 6) for i in range(3)] + [(0, "wood", 10 ** 6, -10 ** 6)], "place_id int, class string, ci int, cj int")
    _, pieces = audit.completeness_areas(cells, cells.filter("false"), 1.0, 1.0)
    assert sorted((r["class"], r.area) for r in pieces.collect()) == [("lake", 3.0), ("wood", 1.0)]


def test_antipodes_give_null(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.3, 179.8), (0.0, 0.0, 45.0, 90.0), (52.0, 13.0, -33.0, 151.0)], "lat1 double, lon1 double, lat2 double, lon2 double")
    out = geo.geodesic_distances(df).collect()
    a, b, d = (math.radians(x) for x in (52.0, -33.0, 138.0))
    sphere = 6371008.8 * math.acos(math.sin(a) * math.sin(b) + math.cos(a) * math.cos(b) * math.cos(d))
    assert out[0].distance_m is None and abs(out[1].azimuth - math.atan2(1.0, math.sqrt(0.99330562))) < 0.01 and abs(out[2].distance_m / sphere - 1) < 0.006


def test_road_overrides_stay_in_their_place(spark):
    roads = spark.createDataFrame([(1, 10, {"name": "Main"}), (2, 20, {"name": "Main"}), (2, 10, {"name": "Side"})], "place_id long, way_id long, tags map<string,string>")
    overrides = spark.createDataFrame([(1, "Main", "5"), (2, "Main", "9"), (2, "w10", "3")], "place_id long, key string, width string")
    out = resolve.resolve_road_overrides(roads, overrides, ["width"])
    assert sorted((r.place_id, r.way_id, r.tags["width"]) for r in out.collect()) == [(1, 10, "5"), (2, 10, "3"), (2, 20, "9")]


def test_quantiles_by_narrowing(spark):
    """Ranks found without a key's values in one task: ties, one value, NULL keys, far ranges, NULL and NaN values."""
    rng = np.random.default_rng(7)
    of = {"a": rng.normal(0, 1, 900), "b": np.repeat(rng.integers(0, 4, 30), 20).astype(float), "c": np.array([5.0]), None: np.array([-1e9, 0.0, 1e-9, 2e-9, 3.0, 1e12]), "d": np.array([1.0, 2.0])}
    rows = [(k, float(v)) for k, vs in of.items() for v in vs] + [("a", None), ("c", float("nan")), ("e", None)]
    wanted = {"low": 0.0, "p10": 0.1, "median": 0.5, "p99": 0.99, "high": 1.0}
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    for most in (0, 1 << 16):
        got = {r.k: r for r in aggregate.quantiles(df, ["k"], "v", wanted, most=most, buckets=8).collect()}
        assert set(got) == set(of)
        for k, vs in of.items():
            assert all(math.isclose(got[k][name], float(np.quantile(vs, p)), rel_tol=1e-12, abs_tol=1e-12) for name, p in wanted.items()), (k, most)


def test_malformed_look_mixes_are_reported(spark):
    zones = spark.createDataFrame([(1, 0, {"look_mix": "brick", "levels": "3"}), (2, 0, {"roof_look_mix": "a/b/c:1|tile/red:0"}), (3, 0, {"look_mix": "wood/falu:2"})], "id long, zone_rank int, settings map<string,string>")
    features = spark.createDataFrame([(k,) for k in (1, 2, 3)], "id long")
    own = spark.createDataFrame([], "key string, settings map<string,string>")
    got = {r.id: r.settings for r in resolve.resolve_overrides(features, zones, own).collect()}
    assert got == {1: {"levels": "3"}, 2: {}, 3: {"style": "wood", "colour": "falu"}}
    assert sorted(tuple(r) for r in resolve.malformed_settings(zones).collect()) == [(1, "look_mix", "brick"), (2, "roof_look_mix", "a/b/c")]


def test_completeness_findings_by_hand(spark):
    """Metres, cells of 0.5: a meadow drawn 0.6 smaller, a path gone, a lawn half under a car park, one cut to a third, one that is invented, water over a wood."""
    box = lambda x0, y0, x1, y1: [[(float(x), float(y)) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]]
    source = [("meadow", 3, box(0, 0, 40, 40)), ("path", 2, box(0, 60, 40, 62)), ("lawn", 5, box(100, 0, 120, 20)), ("yard", 5, box(200, 0, 230, 20)), ("wood", 6, box(300, 0, 320, 20))]
    kept = [(3, box(0.6, 0.6, 39.4, 39.4)), (4, box(100, 0, 110, 20)), (5, box(110, 0, 120, 20)), (5, box(200, 0, 210, 20)), (-1, box(295, -5, 325, 25)), (4, box(400, 0, 402, 2))]
    element, area = "place_id long, source string, rank int, rings array<array<struct<x: double, y: double>>>", "place_id long, rank int, rings array<array<struct<x: double, y: double>>>"

    def found(source, kept):
        out = audit.completeness(spark.createDataFrame([(1, *r) for r in source], element), spark.createDataFrame([(1, *r) for r in kept], area), 0.5, 0.8, 50.0, 25.0, 50.0, 0.5, 1.0)
        return {(r.finding, r.rank, r.source): (r.area, r.share if r.share is None else round(r.share, 3)) for r in out.collect()}
    got = found(source, kept)
    # The yard's loss begins 0.8 beyond the edge kept at 210; the car park (rank 4) has no element of its own where the lawn was.
    assert got == {("lost", 2, "path"): (80.0, None), ("missing piece", 2, None): (80.0, 0.0), ("lost", 5, "yard"): (20 * 19.0, None), ("missing piece", 5, None): (600.0, 0.333),
                   ("fabricated", 4, None): (204.0, None)}
    assert found([], kept[:1]) == {("fabricated", 3, None): (39.0 * 39.0, None)}
    assert found(source[:1], []) == {("lost", 3, "meadow"): (1600.0, None), ("missing piece", 3, None): (1600.0, 0.0)}


def test_buildings_are_found_by_position_name_and_id(spark):
    from placeloom.operators import select
    box = lambda x, y, side: [[(x, y), (x + side, y), (x + side, y + side), (x, y + side)]]
    rows = [(1, 1, "Old Mill", box(0.0, 0.0, 10.0)), (1, 2, "mill house", box(50.0, 0.0, 20.0)), (1, 3, None, box(12.0, 0.0, 4.0)), (2, 1, "Mill", box(0.0, 0.0, 10.0))]
    stats = geo.with_ring_stats(spark.createDataFrame(rows, "place_id long, b_id long, name string, rings array<array<struct<x: double, y: double>>>"))
    stats = stats.select("place_id", "b_id", "name", "rings", "cx", "cy", "area")
    asks = [(1, 1, 11.0, 5.0, None, None), (1, 2, None, None, None, "MILL"), (1, 3, None, None, 3, None), (1, 4, 11.0, 5.0, None, "mill"), (1, 5, None, None, 1, "house"), (2, 6, None, None, None, None), (1, 7, None, None, None, None)]
    shape = "place_id long, ask long, x double, y double, id long, name string"
    out = select.find_buildings(stats, spark.createDataFrame(asks, shape), 5.0, 2, 30.0)
    assert sorted((r.ask, r.rank_no, r.b_id) for r in out.collect()) == [(1, 1, 3), (1, 2, 1), (2, 1, 2), (2, 2, 1), (3, 1, 3), (4, 1, 1), (6, 1, 1), (7, 1, 2), (7, 2, 1)]
    assert select.find_buildings(stats, spark.createDataFrame([], shape), 5.0, 2, 30.0).count() == 0
    views = [(0.0, 0.0, 0.0, 10.0, 10.0, 4.0), (0.0, 0.0, 3.0, 4.0, 100.0, 5.0), (0.0, 0.0, 0.0, 9.0, 1.0, 5.0), (2.0, 2.0, 2.0, 2.0, 10.0, 0.0)]
    shots = spark.createDataFrame(views, "vx double, vy double, cx double, cy double, h double, gap double").select(select.camera(*[F.col(c) for c in ("vx", "vy", "cx", "cy", "h", "gap")]).alias("c")).collect()
    assert [(round(r.c.x, 9), round(r.c.y, 9)) for r in shots] == [(0.0, -10.0), (-21.0, -28.0), (0.0, 0.0), (2.0, 2.0)]
