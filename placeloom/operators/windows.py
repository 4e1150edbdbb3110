"""Ordered computations along lines, over rasters and over packet streams."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from placeloom.functions import shapes as sh
from placeloom.operators.scale import running_min, running_sum, spread_row_number, top_k, trailing_max, with_next


# ---------------------------------------------------------------- along lines
def running_arclength(segments: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Arc length at the start (`s0`) and end (`s1`) of each segment of a line."""
    length = sh.edge_length({c: F.col(c) for c in ("x1", "y1", "x2", "y2")})
    return running_sum(segments, keys, seq, length, "s1", "s0")


def vertices(lines: DataFrame) -> DataFrame:
    """Line rows (pts, nodes) as one row per vertex with its arc length `s`."""
    steps = F.transform(sh.line_edges(F.col("pts")), sh.edge_length)
    at = F.aggregate(steps, F.struct(F.lit(0.0).alias("s"), F.array(F.lit(0.0)).alias("all")), lambda acc, d: F.struct(
        (acc["s"] + d).alias("s"), F.concat(acc["all"], F.array(acc["s"] + d)).alias("all")), lambda acc: acc["all"])
    rows = F.arrays_zip(F.col("pts").alias("p"), F.col("nodes").alias("n"), at.alias("s"))
    return sh.unnest(lines, rows, "_v", "k").select("place_id", "way_id", "k", F.col("_v.p.x").alias("x"), F.col("_v.p.y").alias("y"), F.col("_v.n").alias("node_id"), F.col("_v.s").alias("s"))


def consecutive_pairs(lines: DataFrame, junction_nodes: DataFrame) -> DataFrame:
    """Consecutive junctions along each road with the length between (place_id, way_id, a, b, length); a junction that
    follows itself is left out."""
    on_road = vertices(lines).join(junction_nodes.select("place_id", "node_id"), ["place_id", "node_id"], "left_semi")
    # The junctions of a road are an array again, no longer than the row they came from; neighbours are two slices of it.
    of_way = on_road.groupBy("place_id", "way_id").agg(F.array_sort(F.collect_list(F.struct("k", "node_id", "s"))).alias("_j"))
    after = F.slice("_j", 2, F.greatest(F.size("_j") - 1, F.lit(0)))
    steps = F.zip_with(F.slice("_j", 1, F.greatest(F.size("_j") - 1, F.lit(0))), after, lambda p, q: F.struct(p["node_id"].alias("a"), q["node_id"].alias("b"), (q["s"] - p["s"]).alias("length")))
    return sh.unnest(of_way, steps, "_p").select("place_id", "way_id", "_p.a", "_p.b", "_p.length").filter("a <> b")


def merge_spans(pieces: DataFrame, keys: list[str], same: list[str], seq: str = "seq") -> DataFrame:
    """Consecutive pieces (dense `seq`, s0, s1) with equal `same` columns that touch become one span (run)."""
    after = with_next(pieces.select(*keys, seq, *same, "s0", "s1"), keys, seq, [*same, "s0", "s1"])
    touch = F.lit(True)
    for c in same:
        touch = touch & (F.col(c) == F.col(f"next_{c}"))
    touch = touch & (F.abs(F.col("s1") - F.col("next_s0")) < 1e-6)
    continued = after.filter(touch).select(*keys, (F.col(seq) + 1).alias(seq), F.lit(0).alias("_new"))
    flagged = pieces.join(continued, [*keys, seq], "left").fillna(1, ["_new"])
    runs = running_sum(flagged, keys, seq, F.col("_new"), "run")
    return runs.groupBy(*keys, "run", *same).agg(F.min("s0").alias("s0"), F.max("s1").alias("s1"), F.count("*").alias("pieces"))


def piece_numbers(features: DataFrame, keys: list[str], geometry: list[str]) -> DataFrame:
    return spread_row_number(features, keys, geometry, "piece_no")


def priority_resolve(cells: DataFrame, keys: list[str], rank: str, carry: list[str]) -> DataFrame:
    """The highest-ranked (lowest number) layer keeps a cell; combined in the map tasks."""
    best = cells.groupBy(*keys).agg(F.min(F.struct(rank, *carry)).alias("_b"))
    return best.select(*keys, f"_b.{rank}", *[f"_b.{c}" for c in carry])


def longest_per_group(segments: DataFrame, keys: list[str], k: int = 2) -> DataFrame:
    """The k longest segments of different classes per key: first the longest per class, then the k best classes."""
    per_class = segments.groupBy(*keys, "class").agg(F.max(F.struct("length", F.negative("line_id").alias("_l"), F.negative("seq").alias("_s"))).alias("_m"))
    flat = per_class.select(*keys, "class", F.col("_m.length").alias("length"), (-F.col("_m._l")).alias("line_id"), (-F.col("_m._s")).alias("seq"))
    return top_k(flat, keys, [F.col("length").desc(), F.col("class")], k, salts=1)


def every_nth(rows: DataFrame, keys: list[str], order: list[str], wanted: int = 6) -> DataFrame:
    """At most `wanted` evenly spread rows of each ordered list."""
    numbered = spread_row_number(rows, keys, order, "_n")
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_c"))
    step = F.greatest(F.lit(1), F.floor(F.col("_c") / wanted))
    picked = numbered.join(sizes, keys).filter(((F.col("_n") - 1) % step == 0) & ((F.col("_n") - 1) / step < wanted))
    return picked.drop("_n", "_c")


# ---------------------------------------------------------------- rasters (place_id, j, i, z): a window holds one row or column
def _shifted(value: str, k: int, w) -> Column:
    """The value k cells on; past the border the edge value, at a hole the cell's own."""
    if k == 0:
        return F.col(value)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    step, edge = (F.lag, F.first) if k < 0 else (F.lead, F.last)
    outside = step(F.lit(1), abs(k)).over(w).isNull()
    return F.coalesce(F.when(outside, edge(value).over(whole)).otherwise(step(value, abs(k)).over(w)), F.col(value))


def along_row():
    return W.partitionBy("place_id", "j").orderBy("i")


def along_column():
    return W.partitionBy("place_id", "i").orderBy("j")


def kernel(sigma: float) -> list[float]:
    r = max(1, int(3 * sigma))
    weights = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-r, r + 1)]
    return [w / sum(weights) for w in weights]


def raster_blur(raster: DataFrame, sigma: float, value: str = "z") -> DataFrame:
    """Separable Gaussian with edge padding: a column pass, then a row pass."""
    weights = kernel(sigma)
    r = len(weights) // 2
    for w in (along_column(), along_row()):
        total = F.lit(0.0)
        for k, weight in zip(range(-r, r + 1), weights):
            total = total + _shifted(value, k, w) * weight
        raster = raster.withColumn("_t", total).withColumn(value, F.col("_t")).drop("_t")
    return raster


def _extreme(raster: DataFrame, radius: int, value: str, low: bool) -> DataFrame:
    """Minimum or maximum over a disk: per chord one framed row window, then the chords of the rows above and below."""
    agg, best = (F.min, F.least) if low else (F.max, F.greatest)
    chord = {dy: int(math.sqrt(radius * radius + 0.5 - dy * dy)) for dy in range(-radius, radius + 1)}
    for w in sorted(set(chord.values())):
        raster = raster.withColumn(f"_w{w}", agg(value).over(along_row().rowsBetween(-w, w)))
    raster = raster.withColumn(value, best(*[_shifted(f"_w{w}", dy, along_column()) for dy, w in chord.items()]))
    return raster.drop(*[f"_w{w}" for w in set(chord.values())])


def raster_open(raster: DataFrame, radius: int, value: str = "z") -> DataFrame:
    """Opening: what is higher than its surroundings and narrower than the disk goes."""
    return _extreme(_extreme(raster, radius, value, True), radius, value, False)


def raster_slope(raster: DataFrame, step: float, value: str = "z") -> DataFrame:
    """Gradient magnitude: central differences, one-sided at the border."""
    def gradient(w) -> Column:
        a, b = F.lag(value).over(w), F.lead(value).over(w)
        span = F.when(a.isNull() | b.isNull(), step).otherwise(2 * step)
        return (F.coalesce(b, F.col(value)) - F.coalesce(a, F.col(value))) / span
    both = raster.withColumn("_gx", gradient(along_row())).withColumn("_gy", gradient(along_column()))
    return both.withColumn("slope", F.sqrt(F.col("_gx") * F.col("_gx") + F.col("_gy") * F.col("_gy"))).drop("_gx", "_gy")


# ---------------------------------------------------------------- packets
def delivery_lateness(packets: DataFrame, key: str, order: list[str], last: int = 40, floor_ms: int = 80, cap_ms: int = 250, base_ms: int = 60) -> DataFrame:
    """Per sender in order: smallest arrival - sent so far, lateness beyond it, the worst of the last 40, and the delay it
    sets. Needs `travel_ms`. A busy sender is numbered by a range sort and cut into overlapping buckets."""
    numbered = spread_row_number(packets, [key], order, "n")
    offset = running_min(numbered, [key], "n", F.col("travel_ms"), "offset_ms")
    late = offset.withColumn("late_ms", F.col("travel_ms") - F.col("offset_ms"))
    worst = trailing_max(late, [key], "n", "late_ms", last, "worst_ms")
    return worst.withColumn("delay_ms", F.least(F.greatest(F.col("worst_ms") + base_ms, F.lit(floor_ms)), F.lit(cap_ms)))
