"""A sample of registered queries beside their SQL at the smallest scale (check.py runs them all)."""
import duckdb  # noqa: F401
import pytest

import check
from placeloom.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SAMPLE = ["project_local", "normalize_colours", "classify_roads", "impute_levels_heights", "cell_overlap_area", "line_spans", "point_in_polygon_join", "distance_join",
          "raster_sample", "merge_spans", "shore_ease", "junctions", "diff_datasets", "conform", "rate_breaches", "presence_sessions", "assemble_ways"]


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    ok, text, _ = check.compare(spark, con, SF, name)
    assert ok, text


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_views_agree(spark, con):
    from placeloom.plans.views import VIEWS, Tables, with_views
    t = Tables(spark, SF)
    for view, total in {"f_vertices": "sum(gx * 31 + gy * 17)", "f_segments": "sum(CAST(x1 + y2 AS BIGINT))", "f_buildings": "sum(w * h)", "f_bstat": "sum(CAST(area AS BIGINT))"}.items():
        assert view in VIEWS
        sql = f"SELECT CAST(count(*) AS BIGINT) AS n, CAST({total} AS BIGINT) AS total FROM {view}"
        assert tuple(t.sql(sql).first()) == con.execute(with_views(sql)).fetchone()
