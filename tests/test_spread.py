"""Small tables that become many rows are dealt over tasks; long expressions are evaluated once."""
import math

from pyspark.sql import functions as F

from placeloom.operators import audit, geometry as geo, joins, raster as ras, select as sel
from placeloom.plans.catalog import QUERIES
from placeloom.plans.views import Tables
from placeloom.session import tune

WORLD = (-1000.0, -1000.0, 1000.0, 1000.0)


def box(x0, y0, x1, y1):
    return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]]


def footprints(spark, rows, key):
    df = spark.createDataFrame(rows, f"place_id int, {key} int, rings array<array<struct<x:double,y:double>>>")
    return joins.with_edges(df)


def tasks_used(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_a_file_of_one_row_group_is_many_tasks(spark, tmp_path):
    spark.range(4000).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert tasks_used(Tables(tune(spark), str(tmp_path)).f_buildings) > 1


def test_small_shuffles_are_not_put_together(spark):
    few = tune(spark).range(4000).repartition("id").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(9))))
    assert tasks_used(few) > 1


def test_a_task_reads_a_small_share_of_a_shuffle(spark, tmp_path):
    spark.range(50).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name")).write.parquet(f"{tmp_path}/part.parquet")
    session = spark.newSession()
    assert QUERIES["ring_area"](session, str(tmp_path)).count() == 50
    assert session.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_expressions_over_lines_are_evaluated_once(spark):
    lines = spark.createDataFrame([(0, 1, [(0.0, 0.0), (300.0, 0.0), (300.0, 400.0)])], "place_id int, way_id int, pts array<struct<x:double,y:double>>")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(geo.interpolate_along(lines, F.lit(350.0)).filter("at_x > 0")).count("aggregate(") == 1
    polygons = spark.createDataFrame([(1, box(10.0, 10.0, 90.0, 80.0))], "b_id int, rings array<array<struct<x:double,y:double>>>")
    once = geo.clip_polygons(polygons, 50.0)
    assert plan(once).count("ci#") < 40
    assert {(r.ci, r.cj): len(r.rings[0]) for r in once.collect()} == {(i, j): 4 for i in (0, 1) for j in (0, 1)}
    assert [(r.at_x, r.at_y) for r in geo.interpolate_along(lines, F.lit(350.0)).collect()] == [(300.0, 50.0)]


def test_a_wide_road_is_blocked_as_far_as_it_reaches(spark):
    lines = spark.createDataFrame([(0, 1, [(-5000.0, 0.0), (5000.0, 0.0)], True, True, 4000.0), (0, 2, [(-5000.0, 3000.0), (5000.0, 3000.0)], True, True, 500.0)],
                                  "place_id int, way_id int, pts array<struct<x:double,y:double>>, named boolean, main boolean, width double")
    land = footprints(spark, [(0, 9, box(-9000.0, -9000.0, 9000.0, 9000.0))], "a_id")
    built = footprints(spark, [(0, 5, box(-200.0, -1900.0, 200.0, -1500.0))], "b_id")
    got = sel.spawn_point(lines, built, land, [0], 6000.0).collect()
    assert [(r.way_id, r.k, r.x, r.y) for r in got] == [(2, 0, 0.0, 3000.0)]


def test_markers_on_two_areas_come_once(spark):
    edges = spark.createDataFrame([(0, 1, [(-5000.0, -5000.0), (5000.0, -5000.0)])], "place_id int, edge_id int, pts array<struct<x:double,y:double>>")
    land = footprints(spark, [(0, 1, box(-6000.0, -6000.0, 0.0, 0.0)), (0, 2, box(-6000.0, -6000.0, -1000.0, 0.0))], "a_id")
    built = footprints(spark, [(0, 7, box(-4000.0, -6000.0, -3000.0, -4000.0))], "b_id")
    got = ras.edge_markers(edges, built, land, 630.0, 200.0, 100.0, 6000.0).collect()
    assert len(got) == len({r.n for r in got}) > 0
    assert all(r.x < 0 and not -4100 <= r.x <= -2900 for r in got)


def test_decks_come_with_their_layer(spark):
    ranks = {"asphalt": 0, "grass": 1}
    cells = spark.createDataFrame([(0, 0, 0, "asphalt", True), (0, 1, 0, "asphalt", False), (0, 2, 0, "grass", False)], "place_id int, ci int, cj int, layer string, on_deck boolean")
    land = spark.createDataFrame([(0, 2, 0)], "place_id int, ci int, cj int")
    none = land.limit(0)
    want = {(0, "asphalt"), (2, "grass")}
    flagged = ras.ground_overlay(cells, land, None, none, ["asphalt"], ranks)
    apart = ras.ground_overlay(cells.drop("on_deck"), land, cells.filter("on_deck").select("place_id", "ci", "cj"), none, ["asphalt"], ranks)
    for out in (flagged, apart):
        assert {(r.ci, r.layer) for r in out.collect()} == want


def test_span_cover_without_nested_lines(spark):
    lines = spark.createDataFrame([(0, 1, [(-1500.0, 0.0), (500.0, 0.0), (500.0, 1800.0)]), (0, 2, [(0.0, 0.0), (0.0, 0.0)])], "place_id int, way_id int, pts array<struct<x:double,y:double>>")
    spans = geo.line_spans(lines, 500.0, WORLD).select("way_id", F.posexplode("spans").alias("span_no", "p")).select("way_id", "span_no", "p.*")
    short = lines.select("way_id", "pts")
    audited = audit.check_spans(short, spans, 500.0, WORLD)
    assert audited.collect() == []
    assert {tuple(r) for r in audit.check_spans(short, spans.filter("span_no > 0").withColumn("span_no", F.col("span_no") - 1), 500.0, WORLD).collect()} == {(1, "cover")}
    assert audited._jdf.queryExecution().optimizedPlan().toString().count("part_no") == 0


def test_texts_go_to_python_in_small_batches(spark):
    from placeloom.functions.scalars import fold_ascii
    from placeloom.plans.catalog import QUERIES
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    QUERIES["slugs"](spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    rows = spark.createDataFrame([("Ünï ﬁ½",), (None,), ("",), ("日本",)], "t string").select(fold_ascii("t")).collect()
    assert [r[0] for r in rows] == ["Uni fi12", None, "", ""]


def test_near_streets_are_met_on_one_cell(spark):
    """A bounded search sends a node to one cell, not to nine of a level; ties go to the lower line."""
    nodes = spark.createDataFrame([(0, k, 10.0 * k, 0.0) for k in range(40)] + [(0, 99, 5000.0, 5000.0), (1, 7, 0.0, 0.0)], "place_id long, node_id long, nx double, ny double")
    lines = [(0, k, 0, 100.0 * k - 30.0, 2.0, 100.0 * k + 30.0, 2.0, 8.0) for k in range(4)] + [(0, 50, 0, -30.0, -2.0, 30.0, -2.0, 9.0)]
    segments = spark.createDataFrame(lines, "place_id long, line_id long, seq long, x1 double, y1 double, x2 double, y2 double, width double")
    args = nodes, segments, ["place_id", "node_id"], ["line_id", "seq"]
    got = joins.nearest_within(*args, 5.0, 100.0, x="nx", y="ny")
    whole = joins.nearest_join(*args, 20.0, x="nx", y="ny", max_distance=5.0)
    assert got.columns == whole.columns and sorted(got.collect()) == sorted(whole.collect())
    assert {r.node_id: r.line_id for r in got.collect()}[0] == 0 and got.count() == 25
    cars = spark.createDataFrame([(0, 1, 0.0, 0.0, 0.0)], "place_id long, car_id long, x double, y double, heading double")
    seen, real = [], joins.knn_candidates
    joins.knn_candidates = lambda *a, **b: seen.append(a) or real(*a, **b)
    try:
        best = joins.recovery_candidates(cars, nodes, segments, footprints(spark, [(0, 9, box(105.0, -5.0, 135.0, 5.0))], "b_id").withColumn("place_id", F.col("place_id").cast("long")), 100.0, 50.0, 150.0, 5.0, 8.0, 3.0, fine=20.0).collect()
    finally:
        joins.knn_candidates = real
    assert [(r.car_id, r.node_id) for r in best] == [(1, 7)] and not seen


def test_samples_of_a_corridor_are_not_rows(spark, monkeypatch):
    """Links of one to 90 samples over two adjoining fields with a gap behind them, past an obstacle: against the test of each sample."""
    fields = [(0, 1, box(0.0, 0.0, 500.0, 400.0)), (0, 2, box(500.0, 0.0, 900.0, 400.0)), (1, 3, box(0.0, 0.0, 100.0, 100.0))]
    wall = (300.0, 190.0, 320.0, 210.0)
    ends = [(0, k, 5.0 + 17 * k, 3.0 + 11 * (k % 30), 890.0 - 13 * k, 395.0 - 9 * (k % 40)) for k in range(40)]
    ends += [(0, 40, 10.0, 10.0, 899.0, 10.0), (0, 41, 10.0, 10.0, 915.0, 10.0), (0, 42, 7.0, 7.0, 7.0, 7.0), (0, 43, 10.0, 210.5, 890.0, 210.5), (1, 44, 10.0, 10.0, 90.0, 90.0), (2, 45, 1.0, 1.0, 2.0, 2.0), (0, 46, 10.0, 20.0, 330.0, 20.0)]
    links = spark.createDataFrame(ends, "place_id int, link_id int, x1 double, y1 double, x2 double, y2 double")
    rows, real = [], joins.binned_join
    monkeypatch.setattr(joins, "binned_join", lambda left, *a, **b: rows.append(left) or real(left, *a, **b))
    out = joins.corridor_clear(links, footprints(spark, [(0, 9, box(*wall))], "b_id"), footprints(spark, fields, "a_id"), 10.0, 4.0, 60.0)
    assert out.columns == links.columns

    def clear(place, x1, y1, x2, y2):
        n = max(1, math.ceil(math.hypot(x2 - x1, y2 - y1) / 10.0))
        for k in range(n + 1):
            x, y = x1 + (x2 - x1) * k / n, y1 + (y2 - y1) * k / n
            on = any(p == place and r[0][0][0] <= x < r[0][2][0] and r[0][0][1] <= y < r[0][2][1] for p, _, r in fields)
            gap = math.hypot(max(wall[0] - x, 0, x - wall[2]), max(wall[1] - y, 0, y - wall[3]))
            if not on or place == 0 and gap <= 4.0:
                return False
        return True
    want = [k for p, k, *e in ends if clear(p, *e)]
    assert sorted(r.link_id for r in out.collect()) == want and {40, 42, 44, 46} <= set(want) and not {41, 43, 45} & set(want)
    assert rows and all(r.count() <= 3 * len(ends) for r in rows)
