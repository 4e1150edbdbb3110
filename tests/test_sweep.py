"""What of an outline its parts leave over: turned shapes, holes, overlapping parts, empty inputs."""
import math

import pytest
from pyspark.sql import functions as F

from placeloom.operators import sweep

SHAPE = "place_id long, id long, rings array<array<struct<x: double, y: double>>>"
PART = "place_id long, part long, rings array<array<struct<x: double, y: double>>>, px double, py double"


def turned(points, degrees, dx=0.0, dy=0.0):
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return [(x * c - y * s + dx, x * s + y * c + dy) for x, y in points]


def box(x0, y0, x1, y1):
    return [(float(x), float(y)) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]


def run(spark, outlines, parts, slack=0.0, min_area=1.0, share=0.2):
    # A point of each part, between the middle of its first side and that of its corners.
    centre = lambda r: [0.5 * (r[0][k] + r[1][k]) / 2 + 0.5 * sum(p[k] for p in r) / len(r) for k in (0, 1)]
    o = spark.createDataFrame([(1, k, rings) for k, rings in outlines], SHAPE)
    p = spark.createDataFrame([(1, k, rings, *centre(rings[0])) for k, rings in parts], PART)
    held, unsplit, rest = sweep.outline_leftovers(o, p, "id", "part", 50.0, 0.5, slack, min_area, share)
    quads = F.aggregate("quads", F.lit(0.0), lambda s, q: s + ((q[2]["y"] - q[1]["y"]) + (q[3]["y"] - q[0]["y"])) * (q[1]["x"] - q[0]["x"]) / 2).alias("drawn")
    rows = rest.select("id", "piece", "area", quads).collect()
    assert all(r.drawn == pytest.approx(r.area) for r in rows)
    return sorted((r.part, r.id) for r in held.collect()), sorted(r.id for r in unsplit.collect()), sorted((r.id, r.piece, round(r.area, 6)) for r in rows)


def cases(k):
    """Outlines and parts of case k, turned and put in a place of its own; outlines are numbered from 10 k, parts from 10 000 k."""
    degrees = (0, 17, 45, 90, 133)[k]
    t = lambda *r: turned(box(*r), degrees, 1000.0 * k, -200.0 * k)
    back = lambda *r: list(reversed(t(*r)))
    yard, ring = [t(300, 0, 330, 30), back(310, 10, 320, 20)], [t(400, 0, 430, 30), back(405, 5, 425, 25)]
    outlines = [[t(0, 0, 40, 20)], [t(100, 0, 140, 20)], [t(200, 0, 220, 20)], yard, [t(400, 0, 430, 30), back(410, 10, 420, 20)], [t(500, 0, 520, 20)]]
    slant = [turned(p, degrees, 1000.0 * k, -200.0 * k) for p in ([(200, 0), (220, 0), (220, 20)], [(200, 0), (220, 0), (200, 20)])]
    # A band that cuts the first outline in two and two parts that overlap; two triangles that cross; half a yard; a ring; all of an outline.
    parts = [[t(18, -5, 22, 25)], [t(0, 0, 8, 20)], [back(6, -1, 12, 21)], [slant[0]], [slant[1]], [t(300, 0, 330, 5)], ring, [t(500, 0, 520, 20)]]
    return [(10 * k + n, r) for n, r in enumerate(outlines)], [(10_000 * k + n, r) for n, r in enumerate(parts)]


def test_pieces_of_turned_outlines(spark):
    given = [cases(k) for k in range(5)]
    held, unsplit, pieces = run(spark, [o for c in given for o in c[0]], [p for c in given for p in c[1]], share=0.1)
    assert held == sorted((10_000 * k + n, 10 * k + o) for k in range(5) for n, o in enumerate((0, 0, 0, 2, 2, 3, 4, 5)))
    assert unsplit == [10 * k + 1 for k in range(5)]
    # The hole of an outline is nobody's; what lies in the hole of a part is left over.
    expected = [(0, 1, 360.0), (0, 2, 120.0), (2, 1, 100.0), (3, 1, 650.0), (4, 1, 300.0)]
    assert pieces == sorted((10 * k + o, n, a) for k in range(5) for o, n, a in expected)


def test_growth_shares_and_a_part_without_extent(spark):
    (o, p), square = cases(1), box(-500, 0, -480, 20)
    pieces = run(spark, [*o, (99, [square])], [*p, (5, [[(-490.0, 5.0)] * 3])], slack=0.5)[2]
    # A fifth of 800 is more than the smaller piece of the first outline.
    assert [r for r in pieces if r[0] != 12] == [(10, 1, 17.5 * 20), (13, 1, 30 * 24.5 - 100), (14, 1, 19.0 * 19 - 100), (99, 1, 400.0)]
    # Sides moved by 0.5: from the middle (10, 10) of the cross the wedge begins at 10 + 0.5 * sqrt 2, and it ends at the upper side.
    assert [r[2] for r in pieces if r[0] == 12] == [pytest.approx((10 - 0.5 * math.sqrt(2)) ** 2, abs=1e-5)]


def test_nothing_given(spark):
    square = box(0, 0, 20, 20)
    assert run(spark, [(1, [square])], []) == ([], [1], [])
    assert run(spark, [], [(1, [square])]) == ([], [], [])


def test_many_parts_of_one_outline(spark):
    """A hall of 900 by 900 with 2 000 booths of 4 by 4 on a lattice of 20."""
    booths = [(k, [box(20 * (k % 45), 20 * (k // 45), 20 * (k % 45) + 4, 20 * (k // 45) + 4)]) for k in range(2000)]
    assert run(spark, [(1, [box(0, 0, 900, 900)])], booths)[2] == [(1, 1, 900.0 * 900 - 2000 * 16)]
