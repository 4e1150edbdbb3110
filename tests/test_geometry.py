"""Geometry on hand cases and random shapes against brute force."""
import math
import random

from pyspark.sql import functions as F

from placeloom.functions import shapes as sh
from placeloom.functions.scalars import transverse_mercator
from placeloom.operators import geometry as geo, joins, scale


def ring_rows(spark, rings, schema="id long, rings array<array<struct<x:double,y:double>>>"):
    return spark.createDataFrame([(k, [[(float(x), float(y)) for x, y in r] for r in p]) for k, p in enumerate(rings)], schema)


def clipped_area(ring, x0, y0, s):
    """Sutherland-Hodgman, then the shoelace sum."""
    for axis, lim, keep in ((0, x0, 1), (0, x0 + s, -1), (1, y0, 1), (1, y0 + s, -1)):
        out = []
        for a, b in zip(ring, ring[1:] + ring[:1]):
            ia, ib = keep * (a[axis] - lim) >= 0, keep * (b[axis] - lim) >= 0
            if ia != ib:
                t = (lim - a[axis]) / (b[axis] - a[axis])
                out.append((a[0] + (b[0] - a[0]) * t, a[1] + (b[1] - a[1]) * t))
            if ib:
                out.append(b)
        ring = out
        if not ring:
            return 0.0
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1])) / 2


def test_overlap_of_random_rings(spark):
    rng = random.Random(7)
    rings = []
    for _ in range(60):
        cx, cy, n = rng.uniform(-50, 50), rng.uniform(-50, 50), rng.randint(3, 9)
        angles = sorted(rng.uniform(0, math.tau) for _ in range(n))
        rings.append([[(cx + rng.uniform(3, 40) * math.cos(a), cy + rng.uniform(3, 40) * math.sin(a)) for a in angles]])
    rows = geo.cell_overlap_area(ring_rows(spark, rings), 20.0).select("id", F.explode("cells").alias("c")).select("id", "c.*").collect()
    for r in rows:
        assert abs(r.area - clipped_area(rings[r.id][0], r.ci * 20.0, r.cj * 20.0, 20.0)) < 1e-6


def test_courtyard(spark):
    poly = [[(-140, 60), (-95, 60), (-95, 100), (-140, 100)], [(-128, 72), (-128, 88), (-107, 88), (-107, 72)]]
    df = ring_rows(spark, [poly])
    row = geo.with_ring_stats(df).first()
    assert row.area == 1464.0
    cells = geo.polygon_chunks(df, 60.0, 1e-6).first().cells
    assert {(c.ci, c.cj) for c in cells} == {(-3, 1), (-2, 1)}
    assert abs(sum(c.area for c in cells) - 1464.0) < 1e-9


def test_border_belongs_to_the_higher_chunk(spark):
    df = spark.createDataFrame([(1, [(60.0, -10.0), (60.0, 10.0)])], "id long, pts array<struct<x:double,y:double>>")
    spans = geo.line_spans(df, 60.0, (-150.0, -150.0, 150.0, 150.0)).first().spans
    assert [(s.ci, s.cj, s.s0, s.s1) for s in spans] == [(1, -1, 0.0, 10.0), (1, 0, 10.0, 20.0)]


def test_random_spans_cover_the_line(spark):
    rng = random.Random(7)
    lines = [(k, [(rng.uniform(-200, 200), rng.uniform(-200, 200)) for _ in range(rng.randint(2, 8))]) for k in range(40)]
    df = spark.createDataFrame(lines, "way_id long, pts array<struct<x:double,y:double>>")
    from placeloom.operators.audit import check_spans
    world = (-150.0, -150.0, 150.0, 150.0)
    s = geo.line_spans(df, 60.0, world).select("way_id", F.posexplode("spans").alias("span_no", "p")).select("way_id", "span_no", "p.*")
    assert check_spans(df, s, 60.0, world).collect() == []


def test_thinning_keeps_the_tolerance(spark):
    rng = random.Random(3)
    pts = [(float(k), rng.uniform(-1, 1)) for k in range(60)]
    df = spark.createDataFrame([(1, pts)], "id long, pts array<struct<x:double,y:double>>")
    kept = [(p.x, p.y) for p in geo.thin_vertices(df, 0.8).first().pts]
    assert kept[0] == pts[0] and kept[-1] == pts[-1] and len(kept) < len(pts)
    for x, y in pts:
        best = min(math.hypot(x - (a[0] + (b[0] - a[0]) * t), y - (a[1] + (b[1] - a[1]) * t)) for a, b in zip(kept, kept[1:])
                   for t in [max(0.0, min(1.0, ((x - a[0]) * (b[0] - a[0]) + (y - a[1]) * (b[1] - a[1])) / ((b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2)))])
        assert best <= 0.8 + 1e-9


def test_known_projection_point(spark):
    n, e = transverse_mercator(F.lit(60.974975386470945), F.lit(15.0))
    row = spark.range(1).select(n.alias("n"), e.alias("e")).first()
    assert abs(row.n - 6760000) < 0.01 and abs(row.e - 500000) < 0.01


def test_geodesic(spark):
    df = spark.createDataFrame([(50.0, 10.0, 50.0, 10.0), (50.0, 10.0, 51.0, 10.0), (0.0, 0.0, 0.0, 1.0)], "lat1 double, lon1 double, lat2 double, lon2 double")
    d = [r.distance_m for r in geo.geodesic_distances(df).collect()]
    assert d[0] == 0.0 and abs(d[1] - 111238.681) < 0.01 and abs(d[2] - 111319.491) < 0.01


def test_one_crowded_cell(spark):
    """All points in one cell, split into blocks: the same pairs as without."""
    pts = spark.range(300).select(F.lit(0).alias("place_id"), F.col("id").alias("p"), (F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 13).cast("double").alias("y"))
    seg = spark.range(200).select(F.lit(0).alias("place_id"), F.col("id").alias("s"), (F.col("id") % 11).cast("double").alias("x1"), F.lit(0.0).alias("y1"), (F.col("id") % 7).cast("double").alias("x2"), F.lit(9.0).alias("y2"))
    near = sh.foot(F.col("x"), F.col("y"), *[F.col(c) for c in ("x1", "y1", "x2", "y2")])["d2"] <= 4.0
    box = joins.grow(joins.segment_box(), 2.0)
    plain = joins.binned_join(pts, seg, joins.point_box(), box, 100.0, near)
    split = joins.binned_join(pts, seg, joins.point_box(), box, 100.0, near, hot_rows=20)
    assert sorted((r.p, r.s) for r in plain.collect()) == sorted((r.p, r.s) for r in split.collect())


def test_nearest_against_brute_force(spark):
    rng = random.Random(5)
    pts = [(0, k, rng.uniform(-900, 900), rng.uniform(-900, 900)) for k in range(120)]
    seg = [(0, k, 0, *(rng.gauss(200, 60) for _ in range(4))) for k in range(40)]
    p = spark.createDataFrame(pts, "place_id int, p long, x double, y double")
    s = spark.createDataFrame(seg, "place_id int, line_id long, seq int, x1 double, y1 double, x2 double, y2 double")
    got = {r.p: r.line_id for r in joins.nearest_join(p, s, ["place_id", "p"], ["line_id", "seq"], 20.0, 8).collect()}

    def d2(x, y, x1, y1, x2, y2):
        t = max(0.0, min(1.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
        return (x1 + t * (x2 - x1) - x) ** 2 + (y1 + t * (y2 - y1) - y) ** 2
    assert got == {k: min(seg, key=lambda g: (d2(x, y, *g[3:]), g[1]))[1] for _, k, x, y in pts}


def test_bucketed_sums_and_numbers(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.col("id").alias("seq"), (F.col("id") % 10).alias("v"))
    rows = scale.running_sum(df.repartition(7), ["k"], "seq", F.col("v"), "total", bucket=64).orderBy("seq").collect()
    run = 0
    for r in rows:
        run += r.v
        assert r.total == run
    worst = scale.trailing_max(df.withColumn("v", F.pmod(F.col("seq") * 7919, F.lit(997))), ["k"], "seq", "v", 40, "m", bucket=128).orderBy("seq").collect()
    values = [k * 7919 % 997 for k in range(5000)]
    assert [r.m for r in worst] == [max(values[max(0, k - 39):k + 1]) for k in range(5000)]
    numbered = scale.spread_row_number(df.repartition(5), ["k"], ["v", "seq"], "n").collect()
    assert [r.n for r in sorted(numbered, key=lambda r: (r.v, r.seq))] == list(range(1, 5001))
