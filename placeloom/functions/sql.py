"""The scalar helpers as SQL functions; bodies are expressions, so Catalyst inlines them."""
from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "place_hash_unit": ("key STRING", "DOUBLE",
                        "CAST(conv(substr(sha1(encode(key, 'UTF-8')), 1, 8), 16, 10) AS DOUBLE) / 4294967295D"),
    "place_parse_measure": ("value STRING", "DOUBLE", r"""
        try_cast(translate(regexp_extract(value, '^\\s*(-?[0-9]+([.,][0-9]+)?)', 1), ',', '.') AS DOUBLE)
        * CASE WHEN value RLIKE '^\\s*-?[0-9]+([.,][0-9]+)?\\s*(ft|\')' THEN 0.3048D ELSE 1D END"""),
    "place_vertical_level": ("t MAP<STRING, STRING>", "INT", """
        CASE WHEN t['layer'] IS NOT NULL THEN try_cast(trim(t['layer']) AS INT)
             WHEN coalesce(t['bridge'], 'no') <> 'no' THEN 1
             WHEN coalesce(t['tunnel'], 'no') NOT IN ('no', 'building_passage') THEN -1 ELSE 0 END"""),
}


def register_place_functions(spark: SparkSession) -> list[str]:
    for name, (args, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
