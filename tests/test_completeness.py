"""The whole completeness report by hand."""
from placeloom.operators import audit

RINGS = "array<array<struct<x: double, y: double>>>"


def box(x0, y0, x1, y1):
    return [[(float(x), float(y)) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]]


def test_completeness_report_by_hand(spark):
    """Each rule in a column: a path gone, a yard cut to a third, a meadow drawn smaller, water half gone, a car park that is invented."""
    source = [("meadow", 3, box(0, 0, 40, 40)), ("path", 2, box(0, 60, 40, 62)), ("yard", 5, box(200, 0, 230, 20)), ("lake", -1, box(500, 0, 520, 20))]
    kept = [(3, box(0.6, 0.6, 39.4, 39.4)), (5, box(200, 0, 210, 20)), (4, box(400, 0, 402, 2)), (-1, box(500, 0, 510, 20)), (-2, box(510, 0, 530, 20))]
    out = audit.completeness_report(spark.createDataFrame([(1, *r) for r in source], f"place_id long, source string, rank int, rings {RINGS}"),
                                    spark.createDataFrame([(1, *r) for r in kept], f"place_id long, rank int, rings {RINGS}"), 0.5, 0.8, 50.0, 25.0, 50.0, 0.5, 1.0)
    names = ("expected", "kept", "lost_pieces", "lost", "pieces", "least_share", "missing", "fabricated", "ok")
    got = {r["rank"]: tuple(round(v, 3) if isinstance(v, float) else v for v in (r[c] for c in names)) for r in out.collect()}
    assert got == {
        -1: (400.0, 200.0, 1, 9.0 * 20, 0, None, 0, 0.0, False), 2: (80.0, 0.0, 1, 80.0, 1, 0.0, 1, 0.0, False), 3: (1600.0, 39.0 * 39.0, 0, 0.0, 1, round(39 * 39 / 1600, 3), 0, 0.0, True),
        4: (0.0, 4.0, 0, 0.0, 0, None, 0, 4.0, False), 5: (600.0, 200.0, 1, 380.0, 1, 0.333, 1, 0.0, False)}
