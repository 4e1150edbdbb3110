"""Spatial joins as equi-joins on grid cells.

`binned_join` is the one kernel: both sides are exploded to the cells their boxes touch, joined on (keys, cell), and a
pair is kept only in the cell that holds the larger of the two lower corners, so every pair appears once without a
distinct. A cell that holds very many rows is a skewed join key: adaptive execution splits such a partition on both sides
(`session.SQL_SETTINGS`), and `hot_rows` splits it explicitly."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from placeloom.functions import shapes as sh
from placeloom.session import cut_lineage

Box = list[Column]


def to_cells(df: DataFrame, box: Box, cell: float) -> DataFrame:
    rows = df.withColumns({"_x0": box[0], "_y0": box[1], "_x1": box[2], "_y1": box[3]})
    return sh.unnest(rows, sh.cells_of_box(*box, cell), "_c").select("*", F.col("_c.ci").alias("_ci"), F.col("_c.cj").alias("_cj")).drop("_c")


def _spread(left: DataFrame, right: DataFrame, on: list[str], hot_rows: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Cells with more than `hot_rows` rows on a side are cut into blocks: each side's rows are dealt out by hash over
    their own blocks and repeated for the other side's. The list of such cells has at most rows / hot_rows entries; no
    hint is given, so it is broadcast only when its measured size allows."""
    count = lambda df, name: df.groupBy(*on).agg(F.count("*").alias(name)).filter(F.col(name) > hot_rows)
    blocks = lambda c: F.ceil(F.coalesce(c, F.lit(1)) / hot_rows).cast("int")
    hot = (count(left, "_nl").join(count(right, "_nr"), on, "full")
           .select(*on, F.greatest(blocks(F.col("_nl")), F.lit(1)).alias("_bl"), F.greatest(blocks(F.col("_nr")), F.lit(1)).alias("_br")))

    def deal(df: DataFrame, own: str, other: str, own_name: str, other_name: str) -> DataFrame:
        n, m = F.coalesce(F.col(own), F.lit(1)), F.coalesce(F.col(other), F.lit(1))
        rows = df.join(hot, on, "left").withColumn(own_name, F.pmod(F.xxhash64(*[c for c in df.columns if "map" not in df.schema[c].dataType.typeName()]), n).cast("int"))
        return rows.withColumn(other_name, F.explode(F.sequence(F.lit(0), m - 1))).drop("_bl", "_br")
    return deal(left, "_bl", "_br", "_sl", "_sr"), deal(right, "_br", "_bl", "_sr", "_sl"), [*on, "_sl", "_sr"]


def binned_join(left: DataFrame, right: DataFrame, lbox: Box, rbox: Box, cell: float, on: Column | None = None, keys: list[str] | None = None,
                how: str = "inner", left_id: list[str] | None = None, hot_rows: int | None = None) -> DataFrame:
    """Rows whose boxes meet and that satisfy `on`. Column names of the two sides must differ except for `keys`.
    `left_semi` and `left_anti` need `left_id`; `left` keeps unmatched left rows once."""
    keys = ["place_id"] if keys is None else keys
    if how != "inner":
        if how == "left":
            pairs = binned_join(left, right, lbox, rbox, cell, on, keys, "inner", hot_rows=hot_rows)
            rest = [c for c in right.columns if c not in keys]
            return left.join(pairs.select(*left_id, *rest), left_id, "left")
        matched = binned_join(left, right.select("*"), lbox, rbox, cell, on, keys, "inner", hot_rows=hot_rows).select(*left_id).distinct()
        return left.join(matched, left_id, how)
    a = to_cells(left, lbox, cell)
    b = to_cells(right, rbox, cell).withColumnsRenamed({f"_{c}": f"_r{c}" for c in ("x0", "y0", "x1", "y1")})
    joint = [*keys, "_ci", "_cj"]
    if hot_rows:
        a, b, joint = _spread(a, b, joint, hot_rows)
    b = b.withColumnsRenamed({k: f"_k{n}" for n, k in enumerate(joint)})
    cond = (F.floor(F.greatest("_x0", "_rx0") / cell) == F.col("_ci")) & (F.floor(F.greatest("_y0", "_ry0") / cell) == F.col("_cj"))
    for n, k in enumerate(joint):
        cond = cond & (F.col(k) == F.col(f"_k{n}"))
    # Boxes first: they spare most pairs of a cell the test itself.
    cond = cond & (F.col("_x0") <= F.col("_rx1")) & (F.col("_rx0") <= F.col("_x1")) & (F.col("_y0") <= F.col("_ry1")) & (F.col("_ry0") <= F.col("_y1"))
    if on is not None:
        cond = cond & on
    out = [c for c in left.columns] + [c for c in right.columns if c not in keys]
    return a.join(b, cond).select(*out)


def grow(box: Box, d) -> Box:
    return [box[0] - d, box[1] - d, box[2] + d, box[3] + d]


def point_box(x: str = "x", y: str = "y") -> Box:
    return [F.col(x), F.col(y), F.col(x), F.col(y)]


def segment_box(p: str = "") -> Box:
    x1, y1, x2, y2 = (p + c for c in ("x1", "y1", "x2", "y2"))
    return [F.least(x1, x2), F.least(y1, y2), F.greatest(x1, x2), F.greatest(y1, y2)]


def with_edges(polygons: DataFrame, rings: str = "rings", out: str = "edges") -> DataFrame:
    """Polygon rows with their edge array and box (bx0..by1), the form the joins below take."""
    box = sh.bounds(F.get(rings, F.lit(0)))
    return sh.once(polygons, **{out: sh.polygon_edges(F.col(rings)), "bx0": box[0], "by0": box[1], "bx1": box[2], "by1": box[3]}).drop(rings)


def polygon_box() -> Box:
    return [F.col(c) for c in ("bx0", "by0", "bx1", "by1")]


# ---------------------------------------------------------------- points and polygons
def point_in_polygon_join(points: DataFrame, polygons: DataFrame, cell: float, how: str = "inner", left_id: list[str] | None = None, x: str = "x", y: str = "y",
                          extra: Column | None = None) -> DataFrame:
    """Points with the polygons (`with_edges` form) that hold them, even-odd with holes."""
    cond = sh.inside(F.col("edges"), F.col(x), F.col(y))
    pairs = binned_join(points, polygons, point_box(x, y), polygon_box(), cell, cond if extra is None else cond & extra, how=how, left_id=left_id)
    return pairs.drop("edges", "bx0", "by0", "bx1", "by1")


def near_polygon_join(points: DataFrame, polygons: DataFrame, d: float, cell: float, how: str = "inner", left_id: list[str] | None = None, x: str = "x", y: str = "y",
                      extra: Column | None = None) -> DataFrame:
    """Points within `d` of a polygon (inside counts as 0)."""
    cond = sh.distance2_to_polygon(F.col("edges"), F.col(x), F.col(y)) <= d * d
    pairs = binned_join(points, polygons, grow(point_box(x, y), d), polygon_box(), cell, cond if extra is None else cond & extra, how=how, left_id=left_id)
    return pairs.drop("edges", "bx0", "by0", "bx1", "by1")


def parts_in_outlines(parts: DataFrame, outlines: DataFrame, cell: float, margin: float) -> DataFrame:
    """(part, outline) where the outline, grown by `margin`, holds the part's representative point (px, py)."""
    return near_polygon_join(parts, outlines, margin, cell, x="px", y="py")


def volumes_in_outlines(volumes: DataFrame, outlines: DataFrame, cell: float, volume_id: str) -> tuple[DataFrame, DataFrame]:
    """Ground volumes with the outline that holds them, and the volumes no outline holds."""
    held = point_in_polygon_join(volumes, outlines, cell, x="px", y="py")
    alone = volumes.join(held.select("place_id", volume_id).distinct(), ["place_id", volume_id], "left_anti")
    return held, alone


def distance_join(points: DataFrame, segments: DataFrame, d, cell: float, x: str = "x", y: str = "y", extra: Column | None = None) -> DataFrame:
    """Points and segments (x1..y2) at most `d` apart (a number or a Column of the right side), with `dist2`."""
    near = sh.foot(F.col(x), F.col(y), *[F.col(c) for c in ("x1", "y1", "x2", "y2")])["d2"]
    reach = d if isinstance(d, Column) else F.lit(float(d))
    cond = near <= reach * reach
    pairs = binned_join(points, segments, point_box(x, y), grow(segment_box(), reach), cell, cond if extra is None else cond & extra)
    return pairs.withColumn("dist2", near)


# ---------------------------------------------------------------- nearest
def _levels(x: Column, y: Column, cell: float, levels: int) -> Column:
    """The cell of a position at each level of a pyramid of doubling cells."""
    return F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), lambda k: F.struct(
        k.alias("lv"), F.floor(x / (F.pow(F.lit(2.0), k) * cell)).cast("int").alias("ci"), F.floor(y / (F.pow(F.lit(2.0), k) * cell)).cast("int").alias("cj")))


def _neighbourhood(ci: str, cj: str) -> Column:
    return F.flatten(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda a: F.transform(
        F.sequence(F.lit(-1), F.lit(1)), lambda b: F.struct((F.col(ci) + a).alias("ci"), (F.col(cj) + b).alias("cj")))))


def spanning_levels(points: DataFrame, targets: DataFrame, x: str, y: str, tbox: Box, cell: float) -> int:
    """Doublings of `cell` after which neighbouring cells hold all positions of both sides, from one row of extents per side."""
    ends = lambda df, box: df.agg(F.min(box[0]), F.min(box[1]), F.max(box[2]), F.max(box[3])).first()
    found = [e for e in (ends(points, (x, y, x, y)), ends(targets, tbox)) if e[0] is not None]
    if not found:
        return 1
    wide = max(max(e[k + 2] for e in found) - min(e[k] for e in found) for k in (0, 1))
    return max(1, math.ceil(math.log2(max(float(wide), cell) / cell)) + 1)


def knn_candidates(points: DataFrame, targets: DataFrame, pid: list[str], k: int, cell: float, levels: int | None, keys: list[str], x: str, y: str,
                   anchor: tuple[Column, Column], tbox: Box) -> DataFrame:
    """Each point joined with a set of targets that surely holds its k nearest, without rounds and without a cap.

    A pyramid of doubling cells counts targets (by an anchor point on each). The lowest level whose 3 x 3 block round the
    point holds k anchors bounds the k-th distance by 2 * sqrt(2) cells; two levels up every target within that
    distance touches the 3 x 3 block, so one equi-join on (keys, level, cell) there is exact. A point with fewer than k
    targets even at the top level gets everything there: that level's 3 x 3 block spans the data."""
    levels = levels or spanning_levels(points, targets, x, y, tbox, cell)
    top = levels + 2
    at = _levels(anchor[0], anchor[1], cell, levels)
    full = targets.select(*keys, F.explode(at).alias("a")).groupBy(*keys, "a.lv", "a.ci", "a.cj").agg(F.count("*").alias("n"))
    # One row per finest cell that holds points, not per point: the level depends on the cell alone. Only blocks round such cells are counted.
    home = points.withColumns({"_hi": F.floor(F.col(x) / cell).cast("int"), "_hj": F.floor(F.col(y) / cell).cast("int")})
    homes = home.select(*keys, "_hi", "_hj").distinct().withColumn("a", F.explode(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), lambda lv: F.struct(
        lv.alias("lv"), F.floor(F.col("_hi") / F.pow(F.lit(2.0), lv)).cast("int").alias("hi"), F.floor(F.col("_hj") / F.pow(F.lit(2.0), lv)).cast("int").alias("hj")))))
    homes = homes.select(*keys, "_hi", "_hj", "a.lv", "a.hi", "a.hj")
    blocks = homes.select(*keys, "lv", "hi", "hj").distinct().withColumn("_c", F.explode(_neighbourhood("hi", "hj")))
    around = (blocks.select(*keys, "lv", "hi", "hj", F.col("_c.ci").alias("ci"), F.col("_c.cj").alias("cj")).join(full, [*keys, "lv", "ci", "cj"])
              .groupBy(*keys, "lv", "hi", "hj").agg(F.sum("n").alias("n")).filter(F.col("n") >= k).drop("n"))
    level = homes.join(around, [*keys, "lv", "hi", "hj"], "left_semi").groupBy(*keys, "_hi", "_hj").agg(F.min("lv").alias("_least"))
    placed = home.join(level, [*keys, "_hi", "_hj"], "left").withColumn("_lv", F.coalesce("_least", F.lit(levels - 1)) + 2)
    size = F.pow(F.lit(2.0), F.col("_lv")) * cell
    # Where a block holds k anchors, nothing farther than 2 * sqrt(2) of its cells (a quarter of `size` each) is among the k nearest.
    probes = (placed.withColumns({"_qi": F.floor(F.col(x) / size).cast("int"), "_qj": F.floor(F.col(y) / size).cast("int"), "_within": F.when(F.col("_least").isNotNull(), size * size * 0.500001)})
              .withColumn("_c", F.explode(_neighbourhood("_qi", "_qj"))).select(*points.columns, "_lv", "_within", F.col("_c.ci").alias("_ci"), F.col("_c.cj").alias("_cj")))
    # Targets go only to levels some point asks for (at most `levels` rows, hence the hint), to the cells they touch there.
    asked = placed.select("_lv").distinct()
    per_level = targets.withColumn("_lv", F.explode(F.sequence(F.lit(2), F.lit(top - 1)))).join(F.broadcast(asked), "_lv")
    spread = sh.unnest(per_level, sh.cells_of_box(*tbox, F.pow(F.lit(2.0), F.col("_lv")) * cell), "_s").select(*targets.columns, "_lv", F.col("_s.ci").alias("_ci"), F.col("_s.cj").alias("_cj"))
    dx, dy = (F.greatest(tbox[n] - F.col(v), F.lit(0.0), F.col(v) - tbox[n + 2]) for n, v in enumerate((x, y)))
    near = F.col("_within").isNull() | (dx * dx + dy * dy <= F.col("_within"))
    return probes.join(spread, [*keys, "_lv", "_ci", "_cj"]).filter(near).drop("_lv", "_ci", "_cj", "_within")


def nearest_join(points: DataFrame, segments: DataFrame, pid: list[str], sid: list[str], cell: float, levels: int | None = None, keys: list[str] | None = None,
                 x: str = "x", y: str = "y", max_distance: float | None = None) -> DataFrame:
    """Each point with its nearest segment (lowest `sid` on a tie): the segment's columns, t, px, py, d2. A point further
    than `max_distance` (or in a place without segments) has no row. Columns of the sides must differ except `keys`.
    `cell` is the finest bin, best about the usual distance; as many doublings of it are used as span the data."""
    keys = ["place_id"] if keys is None else keys
    cols = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    cand = knn_candidates(points, segments, pid, 1, cell, levels, keys, x, y, (F.col("x1"), F.col("y1")), segment_box())
    f = sh.foot(F.col(x), F.col(y), *cols)
    scored = cand.withColumns({"t": f["t"], "px": f["px"], "py": f["py"], "d2": f["d2"]})
    if max_distance is not None:
        scored = scored.filter(F.col("d2") <= max_distance * max_distance)
    carried = [c for c in segments.columns if c not in keys] + ["t", "px", "py", "d2"]
    kept = [c for c in points.columns if c not in pid]
    best = scored.groupBy(*pid).agg(F.min_by(F.struct(*kept, *carried), F.struct("d2", *sid)).alias("_b"))
    return best.select(*pid, *[F.col(f"_b.{c}").alias(c) for c in kept + carried])


def nearest_within(points: DataFrame, segments: DataFrame, pid: list[str], sid: list[str], d: float, cell: float, x: str = "x", y: str = "y") -> DataFrame:
    """As `nearest_join` with `max_distance` d, for a d of few segments: only pairs that near meet, on cells of side `cell`. A point goes to one cell, where
    the search for a nearest one at any distance takes nine of each."""
    near = sh.foot(F.col(x), F.col(y), *[F.col(c) for c in ("x1", "y1", "x2", "y2")])
    scored = distance_join(points, segments, d, cell, x, y).drop("dist2").withColumns(near)
    carried = [c for c in segments.columns if c != "place_id"] + ["t", "px", "py", "d2"]
    kept = [c for c in points.columns if c not in pid]
    best = scored.groupBy(*pid).agg(F.min_by(F.struct(*kept, *carried), F.struct("d2", *sid)).alias("_b"))
    return best.select(*pid, *[F.col(f"_b.{c}").alias(c) for c in kept + carried])


def knn_join(points: DataFrame, targets: DataFrame, pid: list[str], tid: list[str], k: int, cell: float, levels: int | None = None, keys: list[str] | None = None) -> DataFrame:
    """The k nearest targets (tx, ty) of each point (x, y), ranked by distance, then `tid`."""
    from placeloom.operators.scale import top_k
    keys = ["place_id"] if keys is None else keys
    cand = knn_candidates(points, targets, pid, k, cell, levels, keys, "x", "y", (F.col("tx"), F.col("ty")), [F.col("tx"), F.col("ty"), F.col("tx"), F.col("ty")])
    scored = cand.withColumn("d2", (F.col("tx") - F.col("x")) * (F.col("tx") - F.col("x")) + (F.col("ty") - F.col("y")) * (F.col("ty") - F.col("y"))).dropDuplicates([*pid, *tid])
    return top_k(scored, pid, [F.col("d2"), *[F.col(c) for c in tid]], k, "rank_no", salts=1)


# ---------------------------------------------------------------- lines with lines
def segment_intersection_join(segments: DataFrame, line_id: str, cell: float) -> DataFrame:
    """Meeting points of the segments of different lines of a place, (a, b, mx, my) with a < b: crossing and touching
    points, and both ends of a shared stretch."""
    names = ["x1", "y1", "x2", "y2"]
    side = lambda p: segments.select("place_id", F.col(line_id).alias(p), *[F.col(c).alias(p + c) for c in names])
    c = {p + n: F.col(p + n) for p in "ab" for n in names}
    rx, ry, sx, sy = c["ax2"] - c["ax1"], c["ay2"] - c["ay1"], c["bx2"] - c["bx1"], c["by2"] - c["by1"]
    den = rx * sy - ry * sx
    qx, qy = c["bx1"] - c["ax1"], c["by1"] - c["ay1"]
    tn, un = qx * sy - qy * sx, qx * ry - qy * rx
    cross = (den != 0) & (tn * F.signum(den) >= 0) & (tn * F.signum(den) <= F.abs(den)) & (un * F.signum(den) >= 0) & (un * F.signum(den) <= F.abs(den))
    collinear = (den == 0) & (un == 0)
    pairs = binned_join(side("a"), side("b"), segment_box("a"), segment_box("b"), cell, (F.col("a") < F.col("b")) & (cross | collinear))
    # Where along the first segment: at one place, or at both ends of what is shared.
    norm = rx * rx + ry * ry
    u1, u2 = (qx * rx + qy * ry) / norm, ((c["bx2"] - c["ax1"]) * rx + (c["by2"] - c["ay1"]) * ry) / norm
    lo, hi = F.greatest(F.lit(0.0), F.least(u1, u2)), F.least(F.lit(1.0), F.greatest(u1, u2))
    along = F.when(den != 0, F.array(tn / F.nullif(den, F.lit(0.0)))).when(lo <= hi, F.array_distinct(F.array(lo, hi)))
    met = pairs.withColumn("_u", F.explode(along))
    return met.select("place_id", "a", "b", (c["ax1"] + rx * F.col("_u")).alias("mx"), (c["ay1"] + ry * F.col("_u")).alias("my")).distinct()


def party_walls(walls: DataFrame, neighbours: DataFrame, cell: float, outward: float) -> DataFrame:
    """How high each wall edge is covered: its midpoint pushed outward (right of a counter-clockwise edge) into a
    neighbour that starts no higher than 0.5 above the wall's own start. `neighbours`: with_edges form with n_id, n_h, n_min."""
    length = sh.edge_length({k: F.col(k) for k in ("x1", "y1", "x2", "y2")})
    mx = (F.col("x1") + F.col("x2")) / 2 + (F.col("y2") - F.col("y1")) / length * outward
    my = (F.col("y1") + F.col("y2")) / 2 - (F.col("x2") - F.col("x1")) / length * outward
    probes = walls.withColumns({"mx": mx, "my": my})
    extra = (F.col("n_id") != F.col("b_id")) & (F.col("n_min") <= F.col("min_h") + 0.5)
    hits = point_in_polygon_join(probes, neighbours, cell, x="mx", y="my", extra=extra).groupBy("b_id", "ring", "seq").agg(F.max("n_h").alias("_covered"))
    return (walls.join(hits, ["b_id", "ring", "seq"], "left")
            .withColumn("covered_to", F.greatest("min_h", F.coalesce("_covered", "min_h"))).drop("_covered"))


# ---------------------------------------------------------------- points and rasters
def raster_blocks(raster: DataFrame) -> DataFrame:
    """Each cell with its right, upper and upper-right neighbours: one aggregation, so points join the raster once."""
    corners = F.array(*[F.struct((F.col("j") - dj).alias("bj"), (F.col("i") - di).alias("bi"), F.lit(dj * 2 + di).alias("corner")) for dj in (0, 1) for di in (0, 1)])
    rows = raster.select("place_id", "z", F.explode(corners).alias("c")).select("place_id", "z", "c.*")
    return rows.groupBy("place_id", "bj", "bi").agg(*[F.max(F.when(F.col("corner") == k, F.col("z"))).alias(f"z{k}") for k in range(4)])


def raster_sample(points: DataFrame, raster: DataFrame, x0: float, y0: float, step: float, ni: int, nj: int, x: str = "x", y: str = "y", out: str = "height") -> DataFrame:
    """Bilinear height at each point, clamped at the border; NULL where a needed cell is missing."""
    fx, fy = sh.clamp((F.col(x) - x0) / step, 0.0, ni - 1.000001), sh.clamp((F.col(y) - y0) / step, 0.0, nj - 1.000001)
    placed = points.withColumns({"_fx": fx, "_fy": fy}).withColumns({"_bi": F.floor("_fx").cast("bigint"), "_bj": F.floor("_fy").cast("bigint")})
    b = raster_blocks(raster).withColumnsRenamed({"place_id": "_pl"})
    hit = placed.join(b, (F.col("place_id") == F.col("_pl")) & (F.col("_bi") == F.col("bi")) & (F.col("_bj") == F.col("bj")), "left")
    tx, ty = F.col("_fx") - F.col("_bi"), F.col("_fy") - F.col("_bj")
    value = (F.col("z0") * (1 - tx) + F.col("z1") * tx) * (1 - ty) + (F.col("z2") * (1 - tx) + F.col("z3") * tx) * ty
    return hit.withColumn(out, value).select(*points.columns, out)


def range_join_views(viewers: DataFrame, tiles: DataFrame, radius: float, cell: float) -> DataFrame:
    """Tiles (tx0..ty1) nearer than `radius` to a viewer (x, y), with `dist2` to the tile's box."""
    dx = F.greatest(F.col("tx0") - F.col("x"), F.lit(0.0), F.col("x") - F.col("tx1"))
    dy = F.greatest(F.col("ty0") - F.col("y"), F.lit(0.0), F.col("y") - F.col("ty1"))
    d2 = dx * dx + dy * dy
    box = [F.col(c) for c in ("tx0", "ty0", "tx1", "ty1")]
    return binned_join(viewers, tiles, grow(point_box(), radius), box, cell, d2 < radius * radius).withColumn("dist2", d2)


def on_land(points: DataFrame, land: DataFrame, segments: DataFrame, pid: list[str], cell: float, margin: float) -> DataFrame:
    """Points inside land, or within half the width plus `margin` of their nearest road (`width` on the segment)."""
    held = point_in_polygon_join(points, land, cell).select(*pid).distinct().withColumn("_land", F.lit(True))
    near = nearest_join(points.select("place_id", *pid, "x", "y"), segments, ["place_id", *pid], ["line_id", "seq"], cell)
    by_road = near.filter(F.sqrt("d2") < F.col("width") / 2 + margin).select(*pid).withColumn("_road", F.lit(True))
    both = points.join(held, pid, "left").join(by_road, pid, "left")
    return both.withColumn("on_land", F.coalesce("_land", F.lit(False)) | F.coalesce("_road", F.lit(False))).drop("_land", "_road")


def facade_viewpoints(buildings: DataFrame, segments: DataFrame, cell: float) -> DataFrame:
    """Where to look at a building from: the nearest road point to its centroid (cx, cy), a step back of
    min(40 m, 1.4 height) less the distance, and the compass heading to the centroid. Units: centimetres."""
    from placeloom.functions.scalars import bearing
    near = nearest_join(buildings, segments, ["place_id", "b_id"], ["line_id", "seq"], cell, x="cx", y="cy")
    dx, dy, d = F.col("cx") - F.col("px"), F.col("cy") - F.col("py"), F.sqrt("d2")
    back = F.greatest(F.lit(0.0), F.least(F.lit(4000.0), F.col("wall_h") * 1.4) - d)
    length = F.when(d == 0, 1.0).otherwise(d)
    return near.withColumns({"heading": bearing(dx, dy), "cam_x": F.col("px") - dx / length * back, "cam_y": F.col("py") - dy / length * back, "back": back})


def resolve_names(queries: DataFrame, names: DataFrame) -> DataFrame:
    """Each query as `lat,lon`, else an exact name (case-insensitive), else the first name that holds it; else unmatched.

    Substring hits need no cross join: names are exploded to their pieces of up to three letters and met on one."""
    pattern = r"^\s*(-?[0-9.]+)\s*,\s*(-?[0-9.]+)\s*$"
    q = queries.withColumns({"q": F.lower(F.trim("query")), "lat": F.regexp_extract("query", pattern, 1).try_cast("double"), "lon": F.regexp_extract("query", pattern, 2).try_cast("double")})
    keyed = names.select("place_id", F.lower("name").alias("n"), "name_id")
    exact = keyed.groupBy("place_id", F.col("n").alias("q")).agg(F.min("name_id").alias("exact_id"))
    # A name that holds the query holds its first three letters (or all of a shorter query) somewhere.
    pieces = lambda size: F.transform(F.sequence(F.lit(1), F.greatest(F.length("n") - size + 1, F.lit(1))), lambda k: F.substr(F.col("n"), k, F.lit(size)))
    grams = keyed.withColumn("g", F.explode(F.array_distinct(F.concat(pieces(1), pieces(2), pieces(3)))))
    probe = q.select("place_id", "query_id", "q", F.substring("q", 1, 3).alias("g"))
    part = (probe.join(grams, ["place_id", "g"]).filter(F.contains(F.col("n"), F.col("q"))).groupBy("place_id", "query_id").agg(F.min("name_id").alias("part_id")))
    out = q.join(exact, ["place_id", "q"], "left").join(part, ["place_id", "query_id"], "left")
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    hit = F.coalesce("exact_id", "part_id")
    return out.select("place_id", "query_id", "query", F.when(located, F.col("lat")).alias("lat"), F.when(located, F.col("lon")).alias("lon"), F.when(~located, hit).alias("name_id"),
                      F.when(located, "position").when(F.col("exact_id").isNotNull(), "exact").when(F.col("part_id").isNotNull(), "part").otherwise("unmatched").alias("how"))


# ---------------------------------------------------------------- corridors and recovery
SAMPLES = 32  # samples of a link that one row tests, bits of a mask


def corridor_clear(links: DataFrame, obstacles: DataFrame, land: DataFrame | None, step: float, clearance: float, cell: float) -> DataFrame:
    """Links (link_id, x1..y2) all of whose samples, `step` apart, keep `clearance` from every obstacle and lie on land. A link_id names one row.

    Samples aren't rows: a row is a stretch of up to SAMPLES of them, which knows by a mask which lie on some land; only links wholly on
    land meet the obstacles."""
    n = F.greatest(F.ceil(sh.edge_length({c: F.col(c) for c in ("x1", "y1", "x2", "y2")}) / step), F.lit(1))
    whole = links.withColumn("_n", n)
    parts = whole.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n"), F.lit(SAMPLES).cast("bigint"))))
    last = F.least(F.col("_k") + (SAMPLES - 1), F.col("_n"))
    x, y = (lambda k, c=c: F.col(f"{c}1") + (F.col(f"{c}2") - F.col(f"{c}1")) * k / F.col("_n") for c in "xy")
    box = [end(*(axis(k) for k in (F.col("_k"), last))) for end in (F.least, F.greatest) for axis in (x, y)]
    rest, samples = [c for c in parts.columns if c != "_k"], F.sequence(F.col("_k"), last)
    if land is not None:
        on = F.aggregate(samples, F.lit(0).cast("bigint"), lambda acc, k: acc.bitwiseOR(F.when(sh.inside(F.col("edges"), x(k), y(k)), F.call_function("shiftleft", F.lit(1).cast("bigint"), (k - F.col("_k")).cast("int"))).otherwise(F.lit(0).cast("bigint"))))
        met = sh.once(binned_join(parts, land, box, polygon_box(), cell).select(*parts.columns, "edges"), _on=on).filter("_on <> 0")
        full = F.call_function("shiftleft", F.lit(1).cast("bigint"), (last - F.col("_k") + 1).cast("int")) - 1
        held = met.groupBy(*rest, "_k").agg(F.bit_or("_on").alias("_on")).filter(F.col("_on") == full)
        whole = cut_lineage(held.groupBy(*rest).agg(F.count("*").alias("_held")).filter(F.col("_held") == F.floor(F.col("_n") / SAMPLES) + 1).drop("_held"))  # read twice
        parts = whole.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n"), F.lit(SAMPLES).cast("bigint"))))
    near = F.exists(samples, lambda k: sh.distance2_to_polygon(F.col("edges"), x(k), y(k)) <= clearance * clearance)
    bad = binned_join(parts, obstacles, grow(box, clearance), polygon_box(), cell, near).select("place_id", "link_id").distinct()
    return whole.join(bad, ["place_id", "link_id"], "left_anti").select(*links.columns)


def recovery_candidates(cars: DataFrame, nodes: DataFrame, segments: DataFrame, obstacles: DataFrame, cell: float, near: float, far: float, off_street: float,
                        width: float, clearance: float, fine: float | None = None) -> DataFrame:
    """Best fresh pose per car (car_id, x, y, heading in radians): nodes (nx, ny) between `near` and `far`, at most `off_street`
    from a street wide enough, both directions, scored distance + 3 * turn (metres, in the caller's cm / 100), clear of obstacles."""
    d2 = (F.col("nx") - F.col("x")) * (F.col("nx") - F.col("x")) + (F.col("ny") - F.col("y")) * (F.col("ny") - F.col("y"))
    box = [F.col("nx"), F.col("ny"), F.col("nx"), F.col("ny")]
    # The street of a node does not depend on the car: resolve it once per node.
    street = cut_lineage(nearest_within(nodes, segments, ["place_id", "node_id"], ["line_id", "seq"], off_street, max(cell, fine or cell), x="nx", y="ny").filter(F.col("width") >= width))
    free = near_polygon_join(street.select("place_id", "node_id", "nx", "ny", "px", "py", "x1", "y1", "x2", "y2"), obstacles, clearance, cell, "left_anti", ["place_id", "node_id"], x="px", y="py")
    pairs = binned_join(cars, free, grow(point_box(), far), box, cell, (d2 >= near * near) & (d2 <= far * far)).withColumn("dist", F.sqrt(d2))
    forward = F.atan2(-(F.col("x2") - F.col("x1")), -(F.col("y2") - F.col("y1")))
    both = pairs.withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("h", forward + F.col("turn") * F.lit(3.141592653589793))
    diff = F.atan2(F.sin(F.col("h") - F.col("heading")), F.cos(F.col("h") - F.col("heading")))
    scored = both.withColumn("score", F.col("dist") / 100 + F.abs(diff) * 3)
    best = scored.groupBy("place_id", "car_id").agg(F.min_by(F.struct("node_id", "turn", "px", "py", "score"), F.struct(F.floor(F.col("score") * 1e6 + 0.5), "node_id", "turn")).alias("_b"))
    return best.select("place_id", "car_id", "_b.*")
