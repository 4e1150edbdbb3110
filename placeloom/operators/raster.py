"""Cell overlay, terrain and scattering.

Vector overlay is replaced by cells of a chosen resolution: a cell centre belongs to a polygon (even-odd) or to a line
strip (distance to the segment at most half the width, flat caps), the highest-ranked layer keeps the cell, and an area
is a count of cells. All of it is exploded rows and equi-joins on (place, cell)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeloom.functions import shapes as sh
from placeloom.functions.scalars import hash_unit
from placeloom.operators.joins import nearest_join, near_polygon_join, point_in_polygon_join, raster_sample
from placeloom.operators.multigrid import fill_holes
from placeloom.operators.windows import priority_resolve
from placeloom.session import cut_lineage


def centre(c: str, res: float) -> Column:
    return (F.col(c) + 0.5) * res


# ---------------------------------------------------------------- rasterising
def rasterize_polygons(polygons: DataFrame, res: float) -> DataFrame:
    """Cells (ci, cj) whose centre a polygon (`with_edges` form) holds; one row per polygon and cell."""
    keep = [c for c in polygons.columns if c not in ("edges", "bx0", "by0", "bx1", "by1")]
    cells = sh.unnest(polygons, sh.cells_of_box(*[F.col(c) for c in ("bx0", "by0", "bx1", "by1")], res), "_c").withColumns({"ci": F.col("_c.ci"), "cj": F.col("_c.cj")})
    return cells.filter(sh.inside(F.col("edges"), centre("ci", res), centre("cj", res))).select(*keep, "ci", "cj")


def first_cell(x: Column, res: float) -> Column:
    """The lowest cell whose centre isn't below `x`."""
    near = F.ceil(x / res - 0.5)
    return F.when((near - 0.5) * res >= x, near - 1).when((near + 0.5) * res < x, near + 1).otherwise(near)


def polygon_runs(polygons: DataFrame, res: float) -> DataFrame:
    """Runs (cj, lo, hi) of the cells that `rasterize_polygons` finds, one row per polygon, row of cells and stretch inside."""
    keep = [c for c in polygons.columns if c not in ("edges", "bx0", "by0", "bx1", "by1")]
    rows = sh.unnest(polygons, F.sequence(F.floor(F.col("by0") / res), F.floor(F.col("by1") / res)), "cj")
    y = centre("cj", res)
    crossed = F.filter("edges", lambda e: (e["y1"] > y) != (e["y2"] > y))
    xs = F.array_sort(F.transform(crossed, lambda e: (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]))
    rows = sh.once(rows, _xs=xs).filter(F.size("_xs") >= 2)
    pairs = F.transform(F.sequence(F.lit(0), F.size("_xs") - 2, F.lit(2)), lambda k: F.struct(F.get("_xs", k).alias("a"), F.get("_xs", k + 1).alias("b")))
    runs = sh.unnest(rows, pairs, "_p").select(*keep, "cj", first_cell(F.col("_p.a"), res).alias("lo"), (first_cell(F.col("_p.b"), res) - 1).alias("hi"))
    return runs.filter("lo <= hi")


def near_runs(segments: DataFrame, d: float, res: float) -> DataFrame:
    """Runs (cj, lo, hi) of the cells whose centre lies within `d` of a segment (x1..y2), one row per segment and row of cells: the ground round a
    segment is convex."""
    keep = [c for c in segments.columns if c not in ("x1", "y1", "x2", "y2")]
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    rows = sh.unnest(segments, F.sequence(F.floor((F.least(y1, y2) - d) / res), F.floor((F.greatest(y1, y2) + d) / res)), "cj")
    y, length = centre("cj", res), F.nullif(sh.edge_length({c: F.col(c) for c in ("x1", "y1", "x2", "y2")}), F.lit(0.0))
    nx, ny = (y2 - y1) / length * d, (x1 - x2) / length * d
    # Where the row meets the discs at both ends and the strip between them.
    disc = lambda cx, cy: F.sqrt(F.greatest(d * d - (y - cy) * (y - cy), F.lit(0.0)))
    meets = [F.when(F.abs(y - cy) <= d, cx + sign * disc(cx, cy)) for cx, cy in ((x1, y1), (x2, y2)) for sign in (-1, 1)]
    corners = [(x1 + nx, y1 + ny), (x2 + nx, y2 + ny), (x2 - nx, y2 - ny), (x1 - nx, y1 - ny)]
    for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1]):
        meets.append(F.when((F.least(ay, by) <= y) & (y <= F.greatest(ay, by)), ax + (bx - ax) * (y - ay) / F.nullif(by - ay, F.lit(0.0))))
    rows = sh.once(rows, _m=F.array_compact(F.array(*meets)))
    rows = sh.once(rows, _a=F.ceil(F.array_min("_m") / res - 0.5) - 1, _b=F.floor(F.array_max("_m") / res - 0.5) + 1)
    # The ends may be off by rounding: the distance itself decides.
    near = lambda c: sh.foot((c + 0.5) * res, y, x1, y1, x2, y2)["d2"] <= d * d
    lo = F.coalesce(*[F.when(near(F.col("_a") + k), F.col("_a") + k) for k in range(3)])
    hi = F.coalesce(*[F.when(near(F.col("_b") - k), F.col("_b") - k) for k in range(3)])
    return sh.once(rows, lo=lo, hi=hi).filter("lo <= hi").select(*keep, "cj", "lo", "hi")


def strip_test(x: Column, y: Column, half: Column) -> Column:
    """Within `half` of a segment and between its ends (flat caps)."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    n = F.nullif(dx * dx + dy * dy, F.lit(0.0))
    along = (x - F.col("x1")) * dx + (y - F.col("y1")) * dy
    across = (x - F.col("x1")) * dy - (y - F.col("y1")) * dx
    return (along >= 0) & (along <= n) & (across * across <= half * half * n)


def rasterize_strips(segments: DataFrame, res: float, half_width: Column) -> DataFrame:
    """Cells whose centre lies in a strip round a segment; one row per segment and cell."""
    keep = [c for c in segments.columns if c not in ("x1", "y1", "x2", "y2")]
    box = [F.least("x1", "x2") - half_width, F.least("y1", "y2") - half_width, F.greatest("x1", "x2") + half_width, F.greatest("y1", "y2") + half_width]
    cells = sh.unnest(segments, sh.cells_of_box(*box, res), "_c").withColumns({"ci": F.col("_c.ci"), "cj": F.col("_c.cj")})
    return cells.filter(strip_test(centre("ci", res), centre("cj", res), half_width)).select(*keep, "ci", "cj")


def place_cells(places: DataFrame, half: float, res: float) -> DataFrame:
    lo, hi = int(-half // res), int(half // res) - 1
    side = F.sequence(F.lit(lo), F.lit(hi))
    return places.select("place_id", F.explode(side).alias("ci")).withColumn("cj", F.explode(side))


CELL = ["place_id", "ci", "cj"]


def distinct_cells(*layers: DataFrame) -> DataFrame:
    out = layers[0].select(*CELL)
    for layer in layers[1:]:
        out = out.unionByName(layer.select(*CELL))
    return out.distinct()


# ---------------------------------------------------------------- overlay
def ground_overlay(layers: DataFrame, land: DataFrame, deck: DataFrame | None, buildings: DataFrame, deck_layers: list[str], ranks: dict[str, int]) -> DataFrame:
    """Layer per cell. `layers(place, ci, cj, layer)`, with a flag `on_deck` where decks come with their layer; road layers are cut to land and bridges, others to land; cells
    under buildings are left out; land nobody claims is `ground`.

    One aggregation on the cell carries every input as a flag, so no layer is joined with another."""
    best = lambda cond: F.min(F.when(cond, F.col("rank")))
    table = F.create_map(*[F.lit(v) for pair in ranks.items() for v in pair])
    rows = layers.select(*CELL, F.try_element_at(table, F.col("layer")).alias("rank"), F.col("layer").isin(deck_layers).alias("road"), F.lit("layer").alias("what"),
                         (F.col("on_deck") if "on_deck" in layers.columns else F.lit(False)).alias("on_deck"))
    flags = [df.select(*CELL, F.lit(None).cast("int").alias("rank"), F.lit(False).alias("road"), F.lit(name).alias("what"), F.lit(name == "deck").alias("on_deck"))
             for name, df in (("land", land), ("deck", deck), ("built", buildings)) if df is not None]
    for flag in flags:
        rows = rows.unionByName(flag)
    cell = rows.groupBy(*CELL).agg(best(F.col("road")).alias("road_rank"), best(~F.col("road")).alias("other_rank"), F.bool_or(F.col("what") == "land").alias("land"),
                                   F.bool_or("on_deck").alias("deck"), F.bool_or(F.col("what") == "built").alias("built"))
    names = F.create_map(*[F.lit(v) for k, r in ranks.items() for v in (r, k)])
    rank = F.least(F.when(F.col("land") | F.col("deck"), F.col("road_rank")), F.when(F.col("land"), F.col("other_rank")))
    out = cell.filter(~F.col("built")).withColumn("layer", F.coalesce(F.try_element_at(names, rank), F.when(F.col("land"), F.lit("ground"))))
    return out.filter("layer IS NOT NULL").select(*CELL, "layer")


def land_water(cells: DataFrame, coast: DataFrame, lakes: DataFrame, piers: DataFrame, decks: DataFrame, res: float, near_cell: float) -> DataFrame:
    """land / sea / lake / bridge per cell of the play area: sea lies right of the nearest coastline segment (land left), lakes
    are areas and buffered rivers, piers add land, bridges are road strips over water. A place without coast is land."""
    pts = cells.withColumns({"x": centre("ci", res), "y": centre("cj", res)})
    near = nearest_join(pts, coast, CELL, ["line_id", "seq"], near_cell)
    side = (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) - (F.col("y2") - F.col("y1")) * (F.col("x") - F.col("x1"))
    sea = near.filter(side < 0).select(*CELL, F.lit("sea").alias("what"))
    rows = cells.select(*CELL, F.lit("all").alias("what")).unionByName(sea)
    for name, df in (("lake", lakes), ("pier", piers), ("deck", decks)):
        rows = rows.unionByName(df.select(*CELL, F.lit(name).alias("what")))
    has = lambda name: F.bool_or(F.col("what") == name).alias(name)
    cell = rows.groupBy(*CELL).agg(has("all"), has("sea"), has("lake"), has("pier"), has("deck")).filter("all")
    wet = (F.col("sea") | F.col("lake")) & ~F.col("pier")
    return cell.select(*CELL, F.when(wet & F.col("deck"), "bridge").when(wet & F.col("lake"), "lake").when(wet, "sea").otherwise("land").alias("kind"))


def house_yards(houses: DataFrame, cells: DataFrame, reach: float, res: float, bin_size: float) -> DataFrame:
    """Cells within `reach` of a house."""
    pts = cells.withColumns({"x": centre("ci", res), "y": centre("cj", res)})
    return near_polygon_join(pts, houses, reach, bin_size, "left_semi", CELL).select(*CELL)


def collision_cells(outlines: DataFrame, passages: DataFrame, walls: DataFrame) -> DataFrame:
    """What blocks at the ground: outline cells less passages, plus city walls (kind `building` wins)."""
    rows = (outlines.select(*CELL, F.lit("building").alias("what")).unionByName(passages.select(*CELL, F.lit("passage").alias("what")))
            .unionByName(walls.select(*CELL, F.lit("city_wall").alias("what"))))
    has = lambda name: F.bool_or(F.col("what") == name)
    cell = rows.groupBy(*CELL).agg(has("building").alias("b"), has("passage").alias("p"), has("city_wall").alias("w"))
    return cell.withColumn("kind", F.when(F.col("b") & ~F.col("p"), "building").when(F.col("w"), "city_wall")).filter("kind IS NOT NULL").select(*CELL, "kind")


def resolve_overlaps(cells: DataFrame, land: DataFrame, road_ranks: int) -> tuple[DataFrame, DataFrame]:
    """Cells (place, ci, cj, rank, id): the lowest rank keeps a cell; ranks from `road_ranks` on are cut to the land. Also the
    cells each feature lost, as counts."""
    flagged = cells.join(land.select(*CELL).distinct().withColumn("_land", F.lit(True)), CELL, "left")
    allowed = flagged.filter((F.col("rank") < road_ranks) | F.col("_land"))
    kept = priority_resolve(allowed, CELL, "rank", ["id"])
    before = cells.groupBy("place_id", "id").agg(F.count("*").alias("cells"))
    after = kept.groupBy("place_id", "id").agg(F.count("*").alias("kept"))
    report = before.join(after, ["place_id", "id"], "left").fillna(0, ["kept"]).withColumn("lost", F.col("cells") - F.col("kept"))
    return kept, report


def wall_strips(strips: DataFrame, land: DataFrame, gates: DataFrame, footprints: DataFrame, min_cells: int) -> DataFrame:
    """Wall cells on land, not in a road gate and not under a building; walls left with fewer than `min_cells` cells go."""
    kept = (strips.join(land.select(*CELL).distinct(), CELL, "left_semi").join(distinct_cells(gates, footprints), CELL, "left_anti"))
    sizes = kept.groupBy("place_id", "wall_id").agg(F.count_distinct("ci", "cj").alias("n")).filter(F.col("n") >= min_cells)
    return kept.join(sizes.select("place_id", "wall_id"), ["place_id", "wall_id"], "left_semi")


# ---------------------------------------------------------------- terrain (place_id, j, i, z)
def terrain_mask(nodes: DataFrame, footprints: DataFrame, forests: DataFrame, wet: DataFrame, margin: float, cell: float) -> DataFrame:
    """Raster nodes (place_id, j, i, x, y) whose surface height isn't the ground's: within `margin` of a footprint or a forest and not wet."""
    grid = ["place_id", "j", "i"]
    near = lambda polygons: near_polygon_join(nodes, polygons, margin, cell, "left_semi", grid).select(*grid)
    return near(footprints).unionByName(near(forests)).distinct().join(wet.select(*grid), grid, "left_anti")


def raster_mask_fill(raster: DataFrame, tolerance: float = 1e-4, tile: int = 96, halo: int = 16) -> DataFrame:
    """Holes (NULL) as the smoothest continuation of what surrounds them, settled to `tolerance` at any width (place_id, j, i, z, hole);
    past the border a cell stands in for its missing neighbour. A place without any height stays NULL."""
    return fill_holes(raster, tolerance, tile, halo)


def terrain_datum(raster: DataFrame, wet: DataFrame, reference: DataFrame, scale: float = 1.0, water_z: float = 0.0) -> DataFrame:
    """Heights over the water: subtract the median wet height (else the place's low percentile), scale, clamp at 0; wet
    cells are 0. `wet(place_id, j, i)`, `reference(place_id, lake, low)`."""
    marked = raster.join(wet.select("place_id", "j", "i").withColumn("_wet", F.lit(True)), ["place_id", "j", "i"], "left").join(reference, "place_id")
    zero = F.when(F.col("lake").isNotNull(), F.col("lake") - water_z).otherwise(F.col("low"))
    d = F.greatest(F.lit(0.0), (F.col("z") - zero) * scale)
    return marked.withColumn("d", F.when(F.col("_wet"), 0.0).otherwise(d)).select("place_id", "j", "i", "d")


def raised_water(raster: DataFrame, body_cells: DataFrame, banks: DataFrame, min_level: float, bank_rise: float) -> DataFrame:
    """Water above the main level: the level of a body is the tenth percentile of its bank samples; bodies under
    `min_level` keep the main level. Cells of a body get its level, bank cells at least level + rise.
    `body_cells(place, body, j, i, bank BOOLEAN)`, `banks(place, body, height)`."""
    from placeloom.operators.aggregate import quantiles
    level = quantiles(banks, ["place_id", "body"], "height", {"level": 0.1}).filter(F.col("level") >= min_level)
    marked = body_cells.join(level, ["place_id", "body"]).groupBy("place_id", "j", "i").agg(
        F.max(F.when(~F.col("bank"), F.col("level"))).alias("_level"), F.max(F.when(F.col("bank"), F.col("level") + bank_rise)).alias("_bank"))
    return raster.join(marked, ["place_id", "j", "i"], "left").withColumn(
        "d", F.coalesce("_level", F.greatest("d", F.coalesce("_bank", "d")))).withColumn("raised", F.col("_level").isNotNull()).drop("_level", "_bank")


def shore_ease(raster: DataFrame, wet: DataFrame, step: float, reach: float) -> DataFrame:
    """Slope the last `reach` down to the main water: heights times min(1, city-block distance to water / reach).

    The distance needs no rounds: a wet cell reaches at most reach / step cells, so each wet cell is sent to the cells of
    its diamond and the least distance is kept (combined in the map tasks)."""
    n = int(reach // step) + 1
    diamond = F.array(*[F.struct(F.lit(a).alias("dj"), F.lit(b).alias("di"), F.lit(float(abs(a) + abs(b))).alias("k")) for a in range(-n, n + 1) for b in range(-n, n + 1) if abs(a) + abs(b) <= n])
    near = (wet.select("place_id", "j", "i", F.explode(diamond).alias("_s")).groupBy("place_id", (F.col("j") + F.col("_s.dj")).alias("j"), (F.col("i") + F.col("_s.di")).alias("i"))
            .agg(F.min("_s.k").alias("_k")))
    ramp = F.least(F.lit(1.0), F.coalesce(F.col("_k") * step / reach, F.lit(1.0)))
    return raster.join(near, ["place_id", "j", "i"], "left").withColumn("d", F.col("d") * ramp).drop("_k")


def outskirts_class(cells: DataFrame, half: float, flat_slope: float = 0.035, low: float = 20.0) -> DataFrame:
    """Squares beyond the play area: field where flat and low, else forest; wet squares are left out. Needs x, y, slope, d, wet."""
    beyond = cells.filter((F.greatest(F.abs("x"), F.abs("y")) >= half) & ~F.col("wet"))
    return beyond.withColumn("kind", F.when((F.col("slope") < flat_slope) & (F.col("d") < low), "field").otherwise("forest"))


def terrain_dsm_dtm(raster: DataFrame, mask: DataFrame, surface: bool, radius: int = 5) -> DataFrame:
    """Bare ground: a ground model is blurred lightly; a surface model loses masked cells (buildings, forest), is filled,
    opened and blurred."""
    from placeloom.operators.windows import raster_blur, raster_open
    if not surface:
        return raster_blur(raster.select("place_id", "j", "i", "z"), 0.6)
    cut = raster.join(mask.select("place_id", "j", "i").withColumn("_m", F.lit(True)), ["place_id", "j", "i"], "left")
    holes = cut.select("place_id", "j", "i", F.when(F.col("_m").isNull(), F.col("z")).alias("z"))
    return raster_blur(raster_open(raster_mask_fill(holes).select("place_id", "j", "i", "z"), radius), 2.0)


def building_base(corners: DataFrame, raster: DataFrame, x0: float, y0: float, step: float, ni: int, nj: int) -> DataFrame:
    """Where a building meets the ground: lowest corner, and 55 % of the way from the lowest to the highest."""
    at = raster_sample(corners, raster, x0, y0, step, ni, nj)
    spread = at.groupBy("place_id", "b_id").agg(F.min("height").alias("lo"), F.max("height").alias("hi"))
    return spread.select("place_id", "b_id", (F.col("lo") + 0.55 * (F.col("hi") - F.col("lo"))).alias("base"), F.col("lo").alias("base_min"))


def grid_resample(places: DataFrame, raster: DataFrame, fallback: DataFrame, half: float, step_out: float, x0: float, y0: float, step: float, ni: int, nj: int) -> DataFrame:
    """A coarser grid over the play area, the primary source first, then the fallback, then the place's lowest height."""
    lo, hi = int(-half // step_out), int(half // step_out)
    side = F.sequence(F.lit(lo), F.lit(hi))
    grid = places.select("place_id", F.explode(side).alias("gi")).withColumn("gj", F.explode(side)).withColumns({"x": F.col("gi") * step_out, "y": F.col("gj") * step_out})
    first = raster_sample(grid, raster, x0, y0, step, ni, nj, out="h1")
    both = raster_sample(first, fallback, x0, y0, step, ni, nj, out="h2")
    lowest = both.groupBy("place_id").agg(F.min(F.coalesce("h1", "h2")).alias("_lo"))
    return both.join(lowest, "place_id").withColumns({
        "source": F.when(F.col("h1").isNotNull(), "primary").when(F.col("h2").isNotNull(), "fallback").otherwise("lowest"),
        "height": F.coalesce("h1", "h2", "_lo")}).drop("_lo", "h1", "h2")


# ---------------------------------------------------------------- scattering
def scatter_points(areas: DataFrame, id_column: str, step: float, probability: Column) -> DataFrame:
    """A jittered lattice inside each polygon (`with_edges` form), kept with a probability. Jitter and choice are hashes of
    (feature, lattice cell), so the result does not depend on order or partitioning."""
    lattice = sh.unnest(areas, sh.cells_of_box(*[F.col(c) for c in ("bx0", "by0", "bx1", "by1")], step), "_c").withColumns({"li": F.col("_c.ci"), "lj": F.col("_c.cj")})
    key = [F.col(id_column), F.col("li"), F.col("lj")]
    jitter = lambda c, word: (F.col(c) + 0.12 + 0.76 * hash_unit(*key, F.lit(word))) * step
    placed = sh.once(lattice, x=jitter("li", "x"), y=jitter("lj", "y"), keep=hash_unit(*key, F.lit("keep")), pick=hash_unit(*key, F.lit("kind")))
    kept = placed.filter((F.col("keep") < probability) & sh.inside(F.col("edges"), F.col("x"), F.col("y")))
    return kept.drop("edges", "bx0", "by0", "bx1", "by1", "_c", "keep")


def points_along(lines: DataFrame, start: float, every: float, offset: Column, side: Column) -> DataFrame:
    """Points every `every` along a line from `start` (before its end), moved sideways by `offset` (left positive) * side."""
    step = sh.once(lines, _e=sh.measured_edges(F.col("pts")), _len=sh.line_length(F.col("pts")))
    n = F.floor((F.col("_len") - start - 1e-9) / every)
    rows = sh.unnest(step.filter(F.col("_len") > start), F.sequence(F.lit(0).cast("bigint"), n), "n")
    at = sh.once(rows, _p=sh.point_at(F.col("_e"), F.col("n") * every + start))
    return at.withColumns({"x": F.col("_p.x") - F.col("_p.dy") * offset * side, "y": F.col("_p.y") + F.col("_p.dx") * offset * side,
                           "angle": F.atan2("_p.dy", "_p.dx")}).drop("_e", "_len", "_p", "pts")


def place_props(nodes: DataFrame, footprints: DataFrame, carriageway: DataFrame, kerbs: DataFrame, roads: DataFrame, bin_size: float, max_move: float) -> DataFrame:
    """Street furniture nodes (prop_id, kind, x, y): not inside buildings; those on the carriageway move to the nearest kerb
    point within `max_move`; each faces its nearest road."""
    # Both intermediate tables are used several times below: written once instead of recomputed.
    free = cut_lineage(point_in_polygon_join(nodes, footprints, bin_size, "left_anti", ["place_id", "prop_id"]))
    on_road = point_in_polygon_join(free, carriageway, bin_size, "left_semi", ["place_id", "prop_id"])
    moved = nearest_join(on_road.select("place_id", "prop_id", "x", "y"), kerbs, ["place_id", "prop_id"], ["kerb_id", "seq"], bin_size, max_distance=max_move).select(
        "place_id", "prop_id", F.col("px").alias("_kx"), F.col("py").alias("_ky"))
    put = cut_lineage(free.join(moved, ["place_id", "prop_id"], "left").withColumns({"moved": F.col("_kx").isNotNull(), "x": F.coalesce("_kx", "x"), "y": F.coalesce("_ky", "y")}).drop("_kx", "_ky"))
    facing = nearest_join(put, roads, ["place_id", "prop_id"], ["line_id", "seq"], bin_size)
    return facing.withColumn("angle", F.atan2(F.col("py") - F.col("y"), F.col("px") - F.col("x")))


def edge_markers(edges: DataFrame, footprints: DataFrame, land: DataFrame, every: float, inward: float, clearance: float, bin_size: float) -> DataFrame:
    """Markers along the land edge, `inward` towards the place's centre, clear of footprints and on land."""
    at = points_along(edges, 200.0, every, F.lit(0.0), F.lit(1.0))
    length = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y"))
    n = F.when(length == 0, 1.0).otherwise(length)
    pushed = at.withColumns({"_x": F.col("x") - F.col("x") / n * inward, "_y": F.col("y") - F.col("y") / n * inward}).drop("x", "y").withColumnsRenamed({"_x": "x", "_y": "y"})
    key = ["place_id", "edge_id", "n"]
    # Land first: few markers lie on it, and they come out of that join with their columns, so the markers are made once.
    held = cut_lineage(point_in_polygon_join(pushed, land, bin_size).select(*pushed.columns).dropDuplicates(key))
    return near_polygon_join(held, footprints, clearance, bin_size, "left_anti", key)


def garden_features(houses: DataFrame, obstacles: DataFrame, bin_size: float, clearance: float) -> tuple[DataFrame, DataFrame]:
    """Per house (id, cx, cy, area_m2): hedge, fence or nothing; and up to two trees, by hash thresholds, clear of obstacles.
    Coordinates in centimetres."""
    roll = hash_unit(F.col("id"), F.lit("yard"))
    yards = houses.withColumn("border", F.when(roll <= 0.55 - 1e-12, "hedge").when(roll <= 0.8, "fence"))
    k = houses.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    unit = lambda word: hash_unit(F.col("id"), F.lit(word), F.col("k"))
    angle, radius = unit("ga") * 6.283185307179586, (F.sqrt("area_m2") / 2 + 3.5 + unit("gr") * 4) * 100
    trees = k.filter(unit("gt") <= 0.55).withColumns({"x": F.col("cx") + F.cos(angle) * radius, "y": F.col("cy") + F.sin(angle) * radius,
                                                     "tree": F.when(unit("gk") < 0.3, "conifer").otherwise("leaf")})
    return yards, near_polygon_join(trees, obstacles, clearance, bin_size, "left_anti", ["place_id", "id", "k"])


def spatial_labels(landmarks: DataFrame, districts: DataFrame, places: DataFrame, bin_size: float) -> DataFrame:
    """Labels with their position in degrees, the district that holds them, and a radius for squares (12 to 60 m)."""
    from placeloom.operators.derive import unproject_local
    held = point_in_polygon_join(landmarks.select("place_id", "label_id", "x", "y"), districts, bin_size).groupBy("label_id").agg(F.min("district").alias("district"))
    radius = F.greatest(F.lit(12.0), F.least(F.lit(60.0), F.sqrt(F.col("area_m2") / 3.141592653589793)))
    named = landmarks.join(held, "label_id", "left").withColumns({"label": F.upper("name"), "radius_m": F.when(F.col("kind") == "square", radius), "x_m": F.col("x") / 100, "y_m": F.col("y") / 100})
    return unproject_local(named, places)
