"""Cut lineages, members of chunks read once, lines inside a box uncut, parts of buildings without a cross join."""
import math

from pyspark.sql import Row, functions as F

from placeloom.operators import geometry as geo, scale
from placeloom.plans import q_joins
from placeloom.plans.catalog import QUERIES
from placeloom.plans.views import Tables
from placeloom.session import cut_lineage

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cut_lineage_is_a_table(spark):
    rows = [(1, math.nan, [Row(x=1.0, y=-0.0)], {"a": 1}), (None, None, [], None), (3, math.inf, None, {})]
    df = spark.createDataFrame(rows, "id long, v double, p array<struct<x double, y double>>, m map<string, int>")
    for made in (df, df.limit(0)):
        out = cut_lineage(made)
        assert out.schema == df.schema and "parquet" in plan(out)
        assert sorted(map(str, out.collect())) == sorted(map(str, made.collect()))


def test_check_index_makes_members_once(spark):
    assert plan(QUERIES["check_index"](spark, SF)).count("l_orderkey") == 0


def test_numbering_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).selectExpr("id % 7 AS k", "id").mapInArrow(count, "k long, id long")
    out = scale.spread_row_number(rows, ["k"], ["id"], "n")
    assert out.filter("n <> id DIV 7 + 1").isEmpty() and out.count() == 1000 and seen.value == 1000


def test_lines_inside_a_box_are_not_clipped(spark, monkeypatch):
    point = "array<struct<x double, y double>>"
    inside = [(0.0, 0.0), (10.0, 0.0), (10.0, 0.0), (10.0, 10.0), (4.0, 10.0)]  # on the border, with a repeat
    df = spark.createDataFrame([(1, [Row(x=x, y=y) for x, y in inside]), (2, [Row(x=5.0, y=5.0), Row(x=15.0, y=5.0), Row(x=15.0, y=6.0), Row(x=5.0, y=6.0)]), (3, [Row(x=5.0, y=5.0)] * 2)], f"id long, pts {point}")
    got = lambda: {(r.id, r.part_no): ([(p.x, p.y) for p in r.part], r.part_len) for r in geo.clip_lines(df, (0, 0, 10, 10), 0.5).collect()}
    whole = ([(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (4.0, 10.0)], 26.0)
    assert got() == {(1, 0): whole, (2, 0): ([(5.0, 5.0), (10.0, 5.0)], 5.0), (2, 1): ([(10.0, 6.0), (5.0, 6.0)], 5.0)}
    monkeypatch.setattr(geo, "clip_range", lambda e, box: (F.lit(False), F.lit(0.0), F.lit(1.0)))
    assert got() == {(1, 0): whole}


def test_spans_of_edges_on_borders(spark):
    """Edges that end on a border, lie on one, leave the world on its border, or cross several."""
    lines = {1: [(0.0, 1.0), (6.0, 1.0), (12.0, 1.0)], 2: [(6.0, 0.0), (6.0, 12.0)], 3: [(5.0, 5.0), (13.0, 5.0)], 4: [(12.0, 3.0), (12.0, 5.0)], 5: [(1.0, 6.0), (0.0, 6.0), (-1.0, 6.0)]}
    df = spark.createDataFrame([(k, [Row(x=x, y=y) for x, y in p]) for k, p in lines.items()], "id long, pts array<struct<x double, y double>>")
    got = {r.id: [tuple(s) for s in r.spans] for r in geo.line_spans(df, 6.0, (0, 0, 12, 12)).collect()}
    assert got == {1: [(0, 0, 0.0, 6.0), (1, 0, 6.0, 12.0)], 2: [(1, 0, 0.0, 6.0), (1, 1, 6.0, 12.0)], 3: [(0, 0, 0.0, 1.0), (1, 0, 1.0, 7.0)], 4: [], 5: [(0, 1, 0.0, 1.0)]}


def test_parts_without_a_cross_join(spark):
    t = Tables(spark, SF)
    made = q_joins.part_boxes(t)
    assert "Join" not in plan(made)
    said = t.sql(q_joins.PART_BOXES[1:-1])
    assert made.columns == said.columns and sorted(map(tuple, made.collect())) == sorted(map(tuple, said.collect())) and made.count() > 0
