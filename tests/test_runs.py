"""Rows of cells as runs: outlines and the ground round edges against the test of each cell."""
import math
import random

from pyspark.sql import functions as F

from placeloom.operators import audit, geometry as geo, joins, raster as ras

RINGS = "array<array<struct<x: double, y: double>>>"


def box(x0, y0, x1, y1):
    return [[(float(x), float(y)) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]]


def cells_of(runs, key):
    return sorted((r[key], ci, r.cj) for r in runs.collect() for ci in range(r.lo, r.hi + 1))


def test_runs_hold_the_cells_of_outlines_and_edges(spark):
    rng = random.Random(3)
    star = lambda n, r, x, y: [(x + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), y + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    shapes = [(k, [star(rng.randrange(3, 12), 30.0, rng.uniform(-50, 50), rng.uniform(-50, 50))]) for k in range(40)]
    shapes += [(40, box(-3, -3, 9, 9) + box(0, 0, 3, 3)), (41, box(2.5, 2.5, 7.5, 7.5)), (42, box(1, 1, 1, 1))]
    areas = spark.createDataFrame([(1, *s) for s in shapes], f"place_id int, id int, rings {RINGS}")
    drawn = joins.with_edges(areas)
    want = sorted((r.id, r.ci, r.cj) for r in ras.rasterize_polygons(drawn, 1.0).collect())
    assert cells_of(ras.polygon_runs(drawn, 1.0), "id") == want
    edges = geo.edges(areas).withColumn("e", F.monotonically_increasing_id()).collect()
    flat = spark.createDataFrame([(k, r.x1, r.y1, r.x2, r.y2) for k, r in enumerate(edges)], "e int, x1 double, y1 double, x2 double, y2 double")
    for d in (0.4, 2.5):
        foot = lambda x, y, r: math.hypot(*(a + max(0.0, min(1.0, ((x - r.x1) * (r.x2 - r.x1) + (y - r.y1) * (r.y2 - r.y1)) / (((r.x2 - r.x1) ** 2 + (r.y2 - r.y1) ** 2) or 1.0))) * (b - a) - c
                                            for a, b, c in ((r.x1, r.x2, x), (r.y1, r.y2, y))))
        near = sorted((k, ci, cj) for k, r in enumerate(edges) for ci in range(math.floor(min(r.x1, r.x2) - d), math.floor(max(r.x1, r.x2) + d) + 1)
                      for cj in range(math.floor(min(r.y1, r.y2) - d), math.floor(max(r.y1, r.y2) + d) + 1) if foot(ci + 0.5, cj + 0.5, r) <= d)
        assert cells_of(ras.near_runs(flat, d, 1.0), "e") == near


def test_large_areas_are_few_stretches(spark):
    """Rows follow the rows of cells an area has, not its cells."""
    source = spark.createDataFrame([(1, "a", 2, box(0, 0, 2000, 10))], f"place_id long, source string, rank int, rings {RINGS}")
    kept = spark.createDataFrame([(1, 2, box(0, 0, 2000, 10))], f"place_id long, rank int, rings {RINGS}")
    covers = audit.ground_covers(source, kept, 0.5, 0.8, 50.0)
    assert covers.filter(F.col("kind") == audit.WANTED).agg(F.sum(F.col("hi") - F.col("lo") + 1)).first()[0] == 4000 * 20
    assert covers.count() < 4000
