"""Exact overlay of the polygons of one feature by a sweep: what of an outline its parts leave over.

The plane of an outline is cut into upright slabs at every vertex and crossing, so no two edges cross inside a slab and what lies
between two neighbouring edges is a trapezoid that is whole inside or whole outside. Slabs, edges and trapezoids are rows; edges meet
by grid cells and slabs by bins of x, so an outline with very many parts is no group of one task but for the sort of its slabs."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from placeloom.functions import shapes as sh
from placeloom.operators import geometry as geo
from placeloom.operators.graph import connected_components
from placeloom.operators.joins import binned_join, near_polygon_join, segment_box, with_edges
from placeloom.session import cut_lineage

THIN = 1e-6  # heights and lengths below this are rounding


def grown(ring: Column, d: float) -> Column:
    """A counter-clockwise ring with every side moved out by `d`, corners mitred up to four times `d`. Points that repeat the next one go."""
    n = F.size(ring)
    after = lambda r, k: F.get(r, (k + 1) % F.size(r))
    points = F.filter(ring, lambda p, k: ~((p["x"] == after(ring, k)["x"]) & (p["y"] == after(ring, k)["y"])) | (n == 1))

    def normal(a: Column, b: Column) -> Column:
        length = F.nullif(F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"])), F.lit(0.0))
        return F.struct(((b["y"] - a["y"]) / length).alias("x"), ((a["x"] - b["x"]) / length).alias("y"))

    def moved(r: Column) -> Column:
        m = F.size(r)

        def corner(p: Column, k: Column) -> Column:
            return sh.let(F.struct(normal(F.get(r, (k + m - 1) % m), p).alias("a"), normal(p, F.get(r, (k + 1) % m)).alias("b")), lambda s: sh.let(
                d / F.greatest(1 + s["a"]["x"] * s["b"]["x"] + s["a"]["y"] * s["b"]["y"], F.lit(0.125)), lambda f: F.struct(
                    (p["x"] + f * (s["a"]["x"] + s["b"]["x"])).alias("x"), (p["y"] + f * (s["a"]["y"] + s["b"]["y"])).alias("y"))))
        return F.transform(r, corner)
    return sh.let(points, moved)


def _sides(polygons: DataFrame, keys: list[str], kind: int) -> DataFrame:
    """Sides from left to right (keys, kind, turn, x1, y1, x2, y2); turn is 1 where the inside lies above, -1 where below. Upright ones bound no trapezoid."""
    rows = sh.unnest(geo.orient_rings(polygons.select(*keys, "rings")), sh.polygon_edges(F.col("rings")), "_e").select(*keys, "_e.*")
    ahead = F.col("x1") < F.col("x2")
    swap = lambda a, b: F.when(ahead, F.col(a)).otherwise(F.col(b))
    return rows.filter("x1 <> x2").select(*keys, F.lit(kind).alias("kind"), F.when(ahead, 1).otherwise(-1).alias("turn"),
                                          swap("x1", "x2").alias("x1"), swap("y1", "y2").alias("y1"), swap("x2", "x1").alias("x2"), swap("y2", "y1").alias("y2"))


def uncovered(outlines: DataFrame, covers: DataFrame, keys: list[str], cell: float) -> DataFrame:
    """Trapezoids (keys, xa, xb, la, lb, ua, ub, area) that make up each outline less all its covers; both sides are (keys, rings).

    xa, xb are left and right, l and u the lower and upper side there. A trapezoid is as high as it can be, its neighbours lie left and right."""
    sides = cut_lineage(_sides(outlines, keys, 0).unionByName(_sides(covers, keys, 1)))
    named = lambda p: sides.select(*keys, *[F.col(c).alias(p + c) for c in ("x1", "y1", "x2", "y2")])
    a, b = named("p"), named("q")
    slope = lambda p: (F.col(p + "y2") - F.col(p + "y1")) / (F.col(p + "x2") - F.col(p + "x1"))
    cross = (F.col("qy1") - F.col("py1") + slope("p") * F.col("px1") - slope("q") * F.col("qx1")) / F.nullif(slope("p") - slope("q"), F.lit(0.0))
    meets = binned_join(a, b, segment_box("p"), segment_box("q"), cell, slope("p") < slope("q"), keys).withColumn("x", cross)
    meets = meets.filter((F.col("x") > F.greatest("px1", "qx1") + THIN) & (F.col("x") < F.least("px2", "qx2") - THIN)).select(*keys, "x")
    ends = sides.select(*keys, F.explode(F.array("x1", "x2")).alias("x"))
    events = ends.unionByName(meets).distinct()
    slabs = events.select(*keys, F.col("x").alias("xa"), F.lead("x").over(Window.partitionBy(*keys).orderBy("x")).alias("xb")).filter("xb > xa")
    slabs = slabs.withColumn("_bin", F.floor((F.col("xa") + F.col("xb")) / 2 / cell).cast("int"))
    binned = sides.withColumn("_bin", F.explode(sh.cell_range(F.col("x1"), F.col("x2"), cell)))
    inside = binned.join(slabs, [*keys, "_bin"]).filter("x1 <= xa AND xb <= x2")
    at = lambda x: F.col("y1") + (F.col("y2") - F.col("y1")) * (F.col(x) - F.col("x1")) / (F.col("x2") - F.col("x1"))
    rows = inside.select(*keys, "xa", "xb", "kind", "turn", at("xa").alias("ya"), at("xb").alias("yb"))
    up = Window.partitionBy(*keys, "xa").orderBy(F.col("ya") + F.col("yb"), "kind", "turn", "ya")
    depth = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("turn")).otherwise(0)).over(up)
    gaps = rows.select(*keys, "xa", "xb", F.col("ya").alias("la"), F.col("yb").alias("lb"), F.lead("ya").over(up).alias("ua"), F.lead("yb").over(up).alias("ub"),
                       ((depth(0) > 0) & (depth(1) <= 0)).alias("free"))
    gaps = gaps.filter(F.col("ua") + F.col("ub") - F.col("la") - F.col("lb") > THIN)
    order = Window.partitionBy(*keys, "xa").orderBy(F.col("la") + F.col("lb"))
    runs = gaps.withColumn("_new", (F.col("free") & ~F.lag("free", 1, False).over(order)).cast("int")).withColumn("_run", F.sum("_new").over(order)).filter("free")
    low, high = F.min(F.struct(F.col("la") + F.col("lb"), "la", "lb")), F.max(F.struct(F.col("ua") + F.col("ub"), "ua", "ub"))
    out = runs.groupBy(*keys, "xa", "xb", "_run").agg(low.alias("l"), high.alias("u"))
    out = out.select(*keys, "xa", "xb", "l.la", "l.lb", "u.ua", "u.ub")
    return out.withColumn("area", (F.col("ua") + F.col("ub") - F.col("la") - F.col("lb")) / 2 * (F.col("xb") - F.col("xa")))


def outline_leftovers(outlines: DataFrame, parts: DataFrame, outline_id: str, part_id: str, cell: float, margin: float, slack: float, min_area: float,
                      min_share: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(held, unsplit, leftovers) of building outlines (place_id, `outline_id`, rings) and parts (place_id, `part_id`, rings, px, py).

    held: (place_id, part, outline) where the outline grown by `margin` holds the part's point px, py. unsplit: outlines that hold no
    part and stay as they are. leftovers: (place_id, outline, piece, area, quads), the connected pieces of an outline with parts that lie
    outside all of them, parts grown by `slack`: those over `min_area` and over `min_share` of the outline. `quads` are the piece's trapezoids
    as rings; pieces of an outline are numbered from 1, the largest first. Parts without a ring cover nothing; pieces that touch in a point only are two."""
    keys = ["place_id", outline_id]
    held = cut_lineage(near_polygon_join(parts.select("place_id", part_id, "px", "py"), with_edges(outlines.select(*keys, "rings")), margin, cell, x="px", y="py")
                       .select("place_id", part_id, outline_id))
    split = held.select(*keys).distinct()
    unsplit = outlines.join(split, keys, "left_anti")
    grow = geo.orient_rings(parts.select("place_id", part_id, "rings")).withColumn("rings", F.transform("rings", lambda r: grown(r, slack)))
    covers = grow.join(held, ["place_id", part_id]).select(*keys, "rings")
    whole = outlines.join(split, keys, "left_semi").select(*keys, "rings")
    size = geo.with_ring_stats(geo.orient_rings(whole)).select(*keys, (F.col("area") * min_share).alias("_least"))
    free = uncovered(whole, covers, keys, cell)
    # Outlines too small in sum have no piece that is large enough.
    enough = free.groupBy(*keys).agg(F.sum("area").alias("_sum")).join(size, keys).filter((F.col("_sum") > min_area) & (F.col("_sum") > F.col("_least"))).select(*keys)
    free = cut_lineage(free.join(enough, keys, "left_semi").withColumn("v", F.struct(outline_id, "xa", F.col("la").alias("y"), F.col("lb").alias("z"))))
    left = free.select(*keys, F.col("xb").alias("_x"), F.col("lb").alias("_l"), F.col("ub").alias("_u"), F.col("v").alias("a"))
    right = free.select(*keys, F.col("xa").alias("_x"), "la", "ua", F.col("v").alias("b"))
    links = left.join(right, [*keys, "_x"]).filter(F.least("_u", "ua") - F.greatest("_l", "la") > THIN).select("place_id", "a", "b")
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    quad = F.array(corner("xa", "la"), corner("xb", "lb"), corner("xb", "ub"), corner("xa", "ua"))
    groups = connected_components(free.select("place_id", "v"), links)
    pieces = free.join(groups, ["place_id", "v"]).groupBy(*keys, "component").agg(F.sum("area").alias("area"), F.collect_list(quad).alias("quads"))
    pieces = pieces.join(size, keys).filter((F.col("area") > min_area) & (F.col("area") > F.col("_least")))
    # Over `min_share` of an outline there are few pieces: fewer than 1 / min_share.
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("area").desc(), "component"))
    return held, unsplit, pieces.select(*keys, number.alias("piece"), "area", F.array_sort("quads").alias("quads"))
