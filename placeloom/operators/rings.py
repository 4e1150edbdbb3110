"""Member lines joined end to end into closed rings: ends paired where they meet, then list ranking by pointer doubling.

Every line is two darts, one for each direction, and a dart knows the one that follows it. In each round a dart looks twice as far ahead, so rings of
n lines take log n rounds, each one equi-join over all rings at once; no ring is walked in one task."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from placeloom.session import cut_lineage


def line_ends(members: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, x, y, line, at, turn): both ends of each open line of `members(keys, line, pts)`; `at` 0 is its first point, `turn` the direction in which it leaves."""
    def end(at: int, here: int, there: int):
        p, q = F.element_at("pts", here), F.element_at("pts", there)
        return F.struct(F.lit(at).alias("at"), p["x"].alias("x"), p["y"].alias("y"), F.atan2(q["y"] - p["y"], q["x"] - p["x"]).alias("turn"))
    return members.select(*keys, "line", F.explode(F.array(end(0, 1, 2), end(1, -1, -2))).alias("_e")).select(*keys, "line", "_e.*")


def following(members: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of ends (keys, line, at, line2, at2) that meet, paired in order of direction so that paths which touch don't cross; an end left over has none."""
    spot = W.partitionBy(*keys, "x", "y").orderBy("turn", "line", "at")
    pair = line_ends(members, keys).withColumn("_n", F.row_number().over(spot) - 1).withColumn("_p", F.floor(F.col("_n") / 2))
    both = pair.groupBy(*keys, "x", "y", "_p").agg(F.min(F.struct("line", "at")).alias("a"), F.max(F.struct("line", "at")).alias("b"), F.count("*").alias("_c")).filter("_c = 2")
    return both.select(*keys, "a.line", "a.at", F.col("b.line").alias("line2"), F.col("b.at").alias("at2"))


def darts(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, dart, ahead): the dart after each one. Dart 2 * line runs from the first point of a line to its last, 2 * line + 1 back; a dart
    arrives at the end opposite to the one it leaves from."""
    arrive = lambda k: F.col(f"line{k}") * 2 + 1 - F.col(f"at{k}")
    leave = lambda k: F.col(f"line{k}") * 2 + F.col(f"at{k}")
    steps = F.array(F.struct(arrive("").alias("dart"), leave("2").alias("ahead")), F.struct(arrive("2").alias("dart"), leave("").alias("ahead")))
    return pairs.select(*keys, F.explode(steps).alias("_s")).select(*keys, F.col("_s.dart").cast("long").alias("dart"), F.col("_s.ahead").cast("long").alias("ahead"))


def ranked(steps: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ring, pos, n, line, reversed) of the closed rings among `steps(keys, dart, ahead)`, each in the direction of its lowest line."""
    # Over the `span` darts from a dart on: the lowest one and how far on it first is.
    state = cut_lineage(steps.select(*keys, "dart", "ahead", F.col("dart").alias("low"), F.lit(0).cast("long").alias("off")))
    span, left = 1, state.count()
    while left:
        further = state.select(*keys, F.col("dart").alias("ahead"), F.col("ahead").alias("_a"), F.col("low").alias("_l"), F.col("off").alias("_o"))
        lower = F.col("_l") < F.col("low")
        after = cut_lineage(state.join(further, [*keys, "ahead"]).select(*keys, "dart", F.col("_a").alias("ahead"), F.when(lower, F.col("_l")).otherwise(F.col("low")).alias("low"),
                                                                         F.when(lower, F.col("_o") + span).otherwise(F.col("off")).alias("off"), lower.alias("moved")))
        # Darts of open chains find none ahead and drop out, from the end of the chain backwards.
        now, moved = after.agg(F.count("*"), F.count_if("moved")).first()
        state, span = after.drop("moved"), span * 2
        if now == left and not moved:
            break
        left = now
    # The other way round, a ring's lowest dart is odd.
    rings = state.filter("low % 2 = 0")
    sizes = rings.groupBy(*keys, "low").agg(F.count("*").alias("n"))
    return rings.join(sizes, [*keys, "low"]).select(*keys, F.floor(F.col("low") / 2).cast("long").alias("ring"), ((F.col("n") - F.col("off")) % F.col("n")).alias("pos"), "n",
                                                    F.floor(F.col("dart") / 2).cast("long").alias("line"), (F.col("dart") % 2 == 1).alias("reversed"))


def split_at_visits(placed: DataFrame, ends: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of ends as `following` gives them, for rings that come to one point more than once: what lies between two visits closes there."""
    leave = F.when(F.col("reversed"), 1).otherwise(0)
    out = placed.select(*keys, "ring", ((F.col("pos") + F.col("n") - 1) % F.col("n")).alias("pos"), F.col("line").alias("line2"), leave.alias("at2"))
    arrive = placed.select(*keys, "ring", "pos", "n", "line", (1 - leave).alias("at")).join(ends.select(*keys, "line", "at", "x", "y"), [*keys, "line", "at"])
    visits = arrive.join(out, [*keys, "ring", "pos"])
    spot = W.partitionBy(*keys, "ring", "x", "y")
    turn = spot.orderBy("pos")
    last = F.last(F.struct("line2", "at2")).over(turn.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    own = visits.withColumn("_b", F.coalesce(F.lag(F.struct("line2", "at2")).over(turn), last))
    return own.select(*keys, "line", "at", F.col("_b.line2").alias("line2"), F.col("_b.at2").alias("at2"))


def ring_members(members: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ring, pos, line, reversed): the lines of each closed ring in order. `ring` is its lowest line, at position 0 in its own direction.

    `members(keys, line, pts)`: lines of two points or more, `line` a whole number >= 0, once per key. Lines that close by themselves are rings; rings that
    touch are kept apart; lines of open chains are left out."""
    usable = cut_lineage(members.filter(F.size("pts") > 1).select(*keys, F.col("line").cast("long").alias("line"), "pts"))
    closes = F.element_at("pts", 1) == F.element_at("pts", -1)
    alone = usable.filter(closes).select(*keys, F.col("line").alias("ring"), F.lit(0).cast("long").alias("pos"), "line", F.lit(False).alias("reversed"))
    open_ = usable.filter(~closes)
    placed = cut_lineage(ranked(darts(following(open_, keys), keys), keys))
    ends = line_ends(open_, keys)
    touched = ends.groupBy(*keys, "x", "y").agg(F.count("*").alias("_c")).filter("_c > 2")
    if not touched.isEmpty():
        met = ends.join(touched, [*keys, "x", "y"]).select(*keys, "line").distinct()
        again = cut_lineage(placed.join(met, [*keys, "line"]).select(*keys, "ring").distinct())
        some = placed.join(again, [*keys, "ring"], "left_semi")
        placed = placed.join(again, [*keys, "ring"], "left_anti").unionByName(ranked(darts(split_at_visits(some, ends, keys), keys), keys))
    return alone.unionByName(placed.drop("n"))


def stitch_rings(relations: DataFrame, keys: list[str]) -> DataFrame:
    """`relations(keys, outer, inner ARRAY<line>, ..)` with `rings`, outer ones first, each an array of points, and `closed`: there is an outer ring and no
    line is left over. `keys` tell the rows apart."""
    tagged = lambda role, c: F.transform(F.coalesce(c, F.array()), lambda line: F.struct(F.lit(role).alias("role"), line.alias("pts")))
    lines = relations.select(*keys, F.posexplode(F.concat(tagged(0, "outer"), tagged(1, "inner"))).alias("line", "_m")).select(*keys, "_m.role", "line", "_m.pts").filter(F.size("pts") > 1)
    lines = cut_lineage(lines)
    placed = ring_members(lines, [*keys, "role"]).join(lines.select(*keys, "role", "line", "pts"), [*keys, "role", "line"])
    way = F.when(F.col("reversed"), F.reverse("pts")).otherwise(F.col("pts"))
    parts = placed.select(*keys, "role", "ring", "pos", F.slice(way, F.lit(1), F.size("pts") - 1).alias("part"))
    ordered = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "part"))), lambda p: p["part"]))
    rings = parts.groupBy(*keys, "role", "ring").agg(ordered.alias("ring_pts"), F.count("*").alias("used"))
    per_row = rings.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("role", "ring", "ring_pts"))), lambda r: r["ring_pts"]).alias("rings"), F.sum("used").alias("_used"), F.bool_or(F.col("role") == 0).alias("_outer"))
    counts = lines.groupBy(*keys).agg(F.count("*").alias("_all"))
    out = relations.join(counts, keys, "left").join(per_row, keys, "left")
    none = F.expr("CAST(array() AS array<array<struct<x:double,y:double>>>)")
    return out.withColumns({"rings": F.coalesce("rings", none), "closed": F.coalesce(F.col("_outer") & (F.col("_used") == F.col("_all")), F.lit(False))}).drop("_all", "_used", "_outer")
