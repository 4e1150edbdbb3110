"""Checksums of the feature views."""
from placeloom.plans.registry import query

for _v, _cols in {"f_vertices": "sum(gx * 31 + gy * 17)", "f_segments": "sum(CAST(x1 + y2 AS BIGINT))",
                  "f_buildings": "sum(w * h)", "f_raster": "sum(CAST(z AS BIGINT))", "f_ways": "sum(length(width))",
                  "f_bedges": "sum(CAST(x1 + 3 * y2 AS BIGINT))", "f_bstat": "sum(CAST(area AS BIGINT))",
                  "f_points": "sum(CAST(x - y AS BIGINT))", "f_areas": "sum(CAST(xmax - ymin AS BIGINT))",
                  "f_packets": "sum(target)", "f_places": "sum(CAST(lat0 AS BIGINT))"}.items():
    _sql = f"SELECT CAST(count(*) AS BIGINT) AS n, CAST({_cols} AS BIGINT) AS total FROM {_v}"
    query("view_" + _v[2:], _sql)(lambda t, s=_sql: t.sql(s))
