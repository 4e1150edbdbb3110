"""Groups of linked rows from shared index keys, without the pairs inside a group."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from placeloom.llm.store import discard, stored
from placeloom.operators.graph import connected_components


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of the links (a, b): the smallest id reachable."""
    edges = links.select(F.lit(0).alias("place_id"), "a", "b")
    ends = edges.select("place_id", F.explode(F.array("a", "b")).alias("v")).distinct()
    return stored(connected_components(ends, edges).select(F.col("v").alias("id"), "component"), "components")


def linked_groups(entries: DataFrame, info: DataFrame, fits: Callable[[str, str], Column], verify: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(components, links) of all pairs that share a key of `entries(key, id)`, may link after `fits` and pass `verify(pairs a, b) -> links a, b`.

    `fits(p, q)` is a condition on columns of `info(id, ...)`, named with those prefixes, that holds for every pair that links. First every row
    is tried against the first row of its keys: that joins a group of near copies with one try a row. Then only rows of one key in
    different components are tried, all that fit, each pair at the first key it shares: no link between components is lost, none inside is
    sought, and no pair is made that doesn't fit."""
    side = lambda df, p, *own: df.select(*own, *[F.col(c).alias(f"{p}_{c}") for c in df.columns if c not in own])
    lead = entries.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a < z").drop("z")
    live = stored(entries.join(lead, "key"), "shared_keys")
    tried = live.filter("a <> id").select(F.col("a").alias("p_id"), F.col("id").alias("q_id")).distinct()
    tried = tried.join(side(info, "p"), "p_id").join(side(info, "q"), "q_id").filter(fits("p", "q")).select(F.col("p_id").alias("a"), F.col("q_id").alias("b"))
    tried = stored(tried, "tried")
    links = stored(verify(tried), "links")
    if links.isEmpty():
        tagged = live.select("key", "id", F.col("id").alias("c"))
    else:
        tagged = live.select("key", "id").join(components(links), "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    mixed = tagged.groupBy("key").agg(F.min("c").alias("l"), F.max("c").alias("h")).filter("l < h").select("key")
    left = stored(tagged.join(mixed, "key", "left_semi"), "mixed_keys")
    discard(live, tried)
    keys = left.groupBy("id").agg(F.collect_set("key").alias("keys"))  # of one row, as many as its own entries
    rows = left.join(keys, "id").join(info, "id")
    first = F.array_min(F.array_intersect("p_keys", "q_keys")) == F.col("key")
    across = side(rows, "p", "key").join(side(rows, "q", "key"), "key").filter((F.col("p_id") < F.col("q_id")) & (F.col("p_c") != F.col("q_c")) & fits("p", "q") & first)
    rest = stored(across.select(F.col("p_id").alias("a"), F.col("q_id").alias("b")), "rest")
    every = stored(links.unionByName(verify(rest)), "all_links")
    discard(left, rest, links)
    return components(every), every
