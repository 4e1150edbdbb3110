"""Aggregations. Every group is an algebraic aggregate (combined in the map tasks before the shuffle); lists that could
grow without bound are paged."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from placeloom.functions import scalars as fn, shapes as sh
from placeloom.operators import geometry as geo
from placeloom.operators.scale import spread_row_number, top_k
from placeloom.session import cut_lineage


def layer_stats(layers: DataFrame, water: list) -> DataFrame:
    """Area and share per ground class, with the place's land and water totals. Needs `class`, `area`."""
    per_class = layers.groupBy("place_id", "class").agg(F.sum("area").alias("area"))
    totals = per_class.groupBy("place_id").agg(F.sum("area").alias("total"), F.coalesce(F.sum(F.when(F.col("class").isin(water), F.col("area"))), F.lit(0.0)).alias("water"))
    return (per_class.join(totals, "place_id").withColumns({"share": F.col("area") / F.col("total"), "land": F.col("total") - F.col("water")}))


def street_lengths(lines: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Length of each named street inside the box. Needs `name`, `pts`."""
    parts = geo.clip_lines(lines.filter("name <> ''"), box, 0.0)
    return parts.groupBy("place_id", "name").agg(F.sum("part_len").alias("length"))


def full_grid(places: DataFrame, half: float, cell: float) -> DataFrame:
    lo, hi = int(-half // cell), int(-(-half // cell)) - 1
    side = F.sequence(F.lit(lo), F.lit(hi))
    return places.select("place_id", F.explode(side).alias("ci")).withColumn("cj", F.explode(side))


def chunk_index(members: DataFrame, places: DataFrame, half: float, cell: float, page: int = 1000) -> DataFrame:
    """Sorted ids per chunk and kind, in pages of at most `page` ids, for every chunk of the grid (an empty chunk has one
    row without ids). `members(place_id, ci, cj, kind, id)`; numbering does not gather a dense chunk in one task."""
    keys = ["place_id", "ci", "cj", "kind"]
    numbered = spread_row_number(members.select(*keys, "id").distinct(), keys, ["id"], "_n")
    pages = (numbered.withColumn("page", F.floor((F.col("_n") - 1) / page).cast("int")).groupBy(*keys, "page")
             .agg(F.array_sort(F.collect_list("id")).alias("ids")))
    return full_grid(places, half, cell).join(pages, ["place_id", "ci", "cj"], "left")


def chunk_report(members: DataFrame, measures: DataFrame, places: DataFrame, half: float, cell: float) -> DataFrame:
    """Per place: grid, populated and empty chunks, border crossers, and the widest building (most chunks, then area,
    then id). `measures(place_id, id, area)` of the buildings."""
    grid = full_grid(places, half, cell)
    edge = (F.col("ci") * cell < -half) | ((F.col("ci") + 1) * cell > half) | (F.col("cj") * cell < -half) | ((F.col("cj") + 1) * cell > half)
    used = members.select("place_id", "ci", "cj").distinct().withColumn("_u", F.lit(1))
    cells = grid.join(used, ["place_id", "ci", "cj"], "left").groupBy("place_id").agg(
        F.count("*").alias("chunks"), F.count("_u").alias("populated"), F.count_if(edge).alias("edge_chunks"))
    per_feature = members.groupBy("place_id", "kind", "id").agg(F.count("*").alias("n"))
    crossers = per_feature.groupBy("place_id").agg(F.count_if((F.col("kind") == "building") & (F.col("n") > 1)).alias("buildings_over_borders"),
                                                   F.count_if((F.col("kind") == "road") & (F.col("n") > 1)).alias("roads_over_borders"))
    widest = (per_feature.filter("kind = 'building'").join(measures, ["place_id", "id"]).groupBy("place_id")
              .agg(F.max_by(F.struct("id", "n"), F.struct("n", "area", "id")).alias("w")).select("place_id", F.col("w.id").alias("widest_id"), F.col("w.n").alias("widest_chunks")))
    return cells.join(crossers, "place_id", "left").join(widest, "place_id", "left").withColumn("empty", F.col("chunks") - F.col("populated"))


def quadrant_counts(points: DataFrame, x: str, y: str) -> DataFrame:
    name = F.concat(F.when(F.col(x) >= 0, "+x").otherwise("-x"), F.when(F.col(y) >= 0, "+y").otherwise("-y"))
    return points.groupBy("place_id", name.alias("quadrant")).agg(F.count("*").alias("n"))


def origin_counts(features: DataFrame, fields: list[str], keys: list[str] | None = None) -> DataFrame:
    """Features per field and origin."""
    keys = keys or []
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("origin")) for f in fields])
    return features.select(*keys, F.inline(pairs)).groupBy(*keys, "field", "origin").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- rasters
def raster_coverage(raster: DataFrame, half: float, support: float) -> DataFrame:
    """Cells without data and from the fallback source: over the grid, the play area and its support. Needs x, y, z, fallback."""
    within = lambda r: (F.abs("x") <= r) & (F.abs("y") <= r)
    out = []
    for name, cond in (("", F.lit(True)), ("play_", within(half)), ("support_", within(half + support))):
        out += [F.count_if(cond).alias(f"{name}cells"), F.count_if(cond & F.col("z").isNull()).alias(f"{name}no_data"),
                F.count_if(cond & F.col("fallback") & F.col("z").isNotNull()).alias(f"{name}fallback")]
    return raster.groupBy("place_id").agg(*out)


def raster_range(raster: DataFrame, x0: float, y0: float, step: float, half: float) -> DataFrame:
    """Lowest and highest of the cells that cover the bounds, and whether the grid covers them."""
    import math
    i0, j0 = math.floor((-half - x0) / step), math.floor((-half - y0) / step)
    i1, j1 = math.ceil((half - x0) / step), math.ceil((half - y0) / step)
    cover = F.col("i").between(i0, i1) & F.col("j").between(j0, j1)
    return raster.groupBy("place_id").agg(F.min(F.when(cover, F.col("z"))).alias("lowest"), F.max(F.when(cover, F.col("z"))).alias("highest"),
                                          ((F.lit(x0) <= -half) & (F.lit(y0) <= -half) & (F.max("i") * step + x0 >= half) & (F.max("j") * step + y0 >= half)).alias("covers"))


def quantiles(values: DataFrame, keys: list[str], value: str, wanted: dict[str, float], most: int = 1 << 16, buckets: int = 1024) -> DataFrame:
    """Exact interpolated quantiles of the values that are neither NULL nor NaN. Values are counted first (heights are rounded, so few are distinct).

    Where no key has more than `most` distinct values, one weighted percentile per key; else the values at the wanted ranks are found by
    histograms that narrow: each round counts `buckets` parts of what is left of a rank's range and goes on in the part that holds it. So no key is gathered in one task."""
    counted = cut_lineage(values.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*keys, value).agg(F.count("*").alias("_n")))
    distinct = counted.groupBy(*keys).agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
    if distinct <= most:
        return counted.groupBy(*keys).agg(*[F.percentile(value, F.lit(p), F.col("_n")).alias(name) for name, p in wanted.items()])
    names = [f"_k{n}" for n in range(len(keys))]
    rows = counted.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(value).cast("double").alias("_v"), "_n")
    whole = rows.groupBy(*names).agg(F.sum("_n").alias("_total"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    places = F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(float(p)) * (F.col("_total") - 1)).alias("at")) for name, p in wanted.items()])
    asked = whole.withColumn("_p", F.explode(places)).withColumn("_r", F.explode(F.array_distinct(F.array(F.floor("_p.at"), F.ceil("_p.at")))))
    state = cut_lineage(asked.select(*names, F.col("_p.name").alias("name"), F.col("_p.at").alias("at"), "_r", "_lo", "_hi", F.lit(0).cast("long").alias("_before")))
    while not state.filter("_lo < _hi").isEmpty():
        todo = state.filter("_lo < _hi").withColumnsRenamed({n: f"_{n}" for n in names})
        own = F.lit(True)
        for n in names:
            own = own & F.col(n).eqNullSafe(F.col(f"_{n}"))
        inside = rows.join(todo, own & F.col("_v").between(F.col("_lo"), F.col("_hi"))).drop(*[f"_{n}" for n in names])
        part = F.least(F.lit(buckets - 1), F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * buckets))
        rank = [*names, "name", "at", "_r", "_before"]
        counts = inside.groupBy(*rank, part.alias("_b")).agg(F.sum("_n").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        along = W.partitionBy(*names, "name", "_r").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)  # at most `buckets` rows
        summed = counts.withColumn("_s", F.col("_before") + F.coalesce(F.sum("_c").over(along), F.lit(0)))
        narrowed = summed.filter((F.col("_s") <= F.col("_r")) & (F.col("_r") < F.col("_s") + F.col("_c"))).select(*names, "name", "at", "_r", "_lo", "_hi", F.col("_s").alias("_before"))
        state = cut_lineage(state.filter("_lo >= _hi").unionByName(narrowed))
    share = F.col("at") - F.floor("at")
    # The lower and the upper rank of each name; they are one where a quantile falls on a value.
    ends = state.groupBy(*names, "name", "at").agg(F.min("_lo").alias("a"), F.max("_lo").alias("b")).withColumn("q", (1 - share) * F.col("a") + share * F.col("b"))
    found = ends.groupBy(*names).agg(*[F.max(F.when(F.col("name") == name, F.col("q"))).alias(name) for name in wanted])
    return found.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], *wanted)


# ---------------------------------------------------------------- statuses
def topology_status(roads: DataFrame, places: DataFrame) -> DataFrame:
    """How far connectivity is known per place. Needs `usable` per road."""
    counts = roads.groupBy("place_id").agg(F.count("*").alias("roads"), F.count_if("usable").alias("with_nodes"))
    all_places = places.select("place_id").join(counts, "place_id", "left").fillna(0, ["roads", "with_nodes"])
    status = (F.when(F.col("roads") == 0, "none").when(F.col("with_nodes") == F.col("roads"), "osm_nodes")
              .when(F.col("with_nodes") == 0, "positions").otherwise("mixed"))
    return all_places.withColumn("topology", status)


def feature_fates(source: DataFrame, kept: DataFrame, key: list[str], reasons: list[tuple[str, Column]]) -> DataFrame:
    """`kept`, or the first exclusion that explains why a source feature is absent, or `unexplained`."""
    fate = F.when(F.col("_kept"), "kept")
    for name, cond in reasons:
        fate = fate.when(F.coalesce(cond, F.lit(False)), name)
    return source.join(kept.select(*key).distinct().withColumn("_kept", F.lit(True)), key, "left").withColumn("fate", fate.otherwise("unexplained")).drop("_kept")


def fate_counts(fates: DataFrame, keys: list[str]) -> DataFrame:
    return fates.groupBy(*keys, "fate").agg(F.count("*").alias("n"))


def similarity_fit(pairs: DataFrame, keys: list[str], limits: dict[str, float] | None = None) -> DataFrame:
    """How far positions (u, v) are from their reference (x, y): least-squares rotation and scale about the origin, mean offset, largest and mean
    residual, and `passed` where all are within `limits` (max_residual, mean_offset, rotation, scale_deviation; one left out isn't tested).

    One aggregation; without a point off the origin, rotation is 0 and scale NULL, which doesn't pass a limit on it."""
    x, y, u, v = (F.col(c) for c in "xyuv")
    off = F.sqrt((u - x) * (u - x) + (v - y) * (v - y))
    sums = pairs.groupBy(*keys).agg(F.count("*").alias("points"), F.sum(x * u + y * v).alias("dot"), F.sum(x * v - y * u).alias("cross"), F.sum(x * x + y * y).alias("norm"),
                                    F.avg(u - x).alias("offset_x"), F.avg(v - y).alias("offset_y"), F.max(off).alias("max_residual"), F.avg(off).alias("mean_residual"))
    scale = F.try_divide(F.sqrt(F.col("dot") * F.col("dot") + F.col("cross") * F.col("cross")), F.col("norm"))
    fit = sums.select(*keys, "points", F.atan2("cross", "dot").alias("rotation"), scale.alias("scale"), "offset_x", "offset_y", "max_residual", "mean_residual")
    found = {"max_residual": F.col("max_residual"), "mean_offset": F.sqrt(F.col("offset_x") * F.col("offset_x") + F.col("offset_y") * F.col("offset_y")),
             "rotation": F.abs("rotation"), "scale_deviation": F.abs(F.col("scale") - 1)}
    passed = F.lit(True)
    for name, limit in (limits or {}).items():
        passed = passed & F.coalesce(found[name] <= limit, F.lit(False))
    return fit.withColumn("passed", passed)


def site_suitability(features: DataFrame, weights: dict[str, float], step: float, side: int, k: int) -> DataFrame:
    """Best candidate squares per place. `features(place_id, criterion, x, y, value)` are summed into grid cells first; a
    cell then adds to the side x side candidates that hold it, so no candidate meets single features."""
    cells = features.groupBy("place_id", "criterion", F.floor(F.col("x") / step).alias("ci"), F.floor(F.col("y") / step).alias("cj")).agg(F.sum("value").alias("v"))
    back = F.sequence(F.lit(0), F.lit(side - 1))
    spread = cells.withColumn("a", F.explode(back)).withColumn("b", F.explode(back))
    per_square = spread.groupBy("place_id", "criterion", (F.col("ci") - F.col("a")).alias("qi"), (F.col("cj") - F.col("b")).alias("qj")).agg(F.sum("v").alias("v"))
    best = per_square.groupBy("place_id", "criterion").agg(F.max("v").alias("m"))
    score = per_square.join(best, ["place_id", "criterion"]).filter("m > 0").groupBy("place_id", "qi", "qj").agg(
        F.sum(F.col("v") / F.col("m") * fn.lookup(weights, F.col("criterion"))).alias("score"))
    return top_k(score, ["place_id"], [F.floor(F.col("score") * 1e6 + 0.5).desc(), F.col("qi"), F.col("qj")], k)


def collision_rollup(outlines: DataFrame, held: DataFrame, key: str, min_leftover: float) -> DataFrame:
    """Volumes held by each outline, their area, and what of the outline no volume covers. `held(key, volume_id, area)`."""
    sums = held.groupBy(key).agg(F.count_distinct("volume_id").alias("members"), F.sum("area").alias("member_area"))
    return (outlines.join(sums, key, "left").fillna(0, ["members"]).fillna(0.0, ["member_area"])
            .withColumn("leftover", F.greatest(F.lit(0.0), F.col("area") - F.col("member_area")))
            .withColumn("reported", F.col("leftover") > min_leftover))


def check_rollup(checks: DataFrame, keys: list[str]) -> DataFrame:
    """Overall verdict per key and the names of failed checks (a name appears once, so the list is short)."""
    per_check = checks.groupBy(*keys, "check").agg(F.bool_and("ok").alias("ok"))
    return per_check.groupBy(*keys).agg(F.bool_and("ok").alias("passed"), F.array_join(F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("check")))), ",").alias("failed"))


def building_chunks(polygons: DataFrame, cell: float, world) -> DataFrame:
    """(place_id, id, ci, cj) of every chunk a polygon covers."""
    cells = geo.polygon_chunks(polygons, cell, 0.01, world)
    return sh.unnest(cells, F.col("cells"), "_c").select("place_id", "id", F.col("_c.ci").alias("ci"), F.col("_c.cj").alias("cj"))
