"""Selection: anchors, ranked lists, greedy picks, set comparison."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeloom.functions import shapes as sh
from placeloom.operators import geometry as geo
from placeloom.session import cut_lineage


def resolve_anchors(anchors: DataFrame, aid: str, lines: DataFrame, buildings: DataFrame, areas: DataFrame) -> DataFrame:
    """Position of each anchor: a point, a road with arc length and sideways offset (left positive), a building or an
    area (centroid). `dangling` marks a target that does not exist or an arc length past its end."""
    road = anchors.join(lines.select("place_id", F.col("way_id").alias("road"), "pts"), ["place_id", "road"])
    road = road.filter((F.col("s") >= 0) & (F.col("s") <= sh.line_length(F.col("pts"))))
    along = geo.interpolate_along(road, F.col("s")).select(aid, (F.col("at_x") - F.col("dir_y") * F.col("offset")).alias("at_x"), (F.col("at_y") + F.col("dir_x") * F.col("offset")).alias("at_y"))
    centre = lambda polys, key, name: anchors.join(geo.with_ring_stats(polys).select("place_id", F.col(key).alias(name), "cx", "cy"), ["place_id", name]).select(
        aid, F.col("cx").alias("at_x"), F.col("cy").alias("at_y"))
    point = anchors.filter(F.col("x").isNotNull()).select(aid, F.col("x").alias("at_x"), F.col("y").alias("at_y"))
    found = point.unionByName(along).unionByName(centre(buildings, "b_id", "building")).unionByName(centre(areas, "a_id", "area"))
    return anchors.join(found, aid, "left").withColumn("dangling", F.col("at_x").isNull())




# ---------------------------------------------------------------- ranked lists
def list_buildings(buildings: DataFrame, segments: DataFrame, focus: float, limit: int, cell: float) -> DataFrame:
    """Buildings within `focus` of a street (segments carry `street`), per street the `limit` nearest, larger first on equal
    distance: building, street, distance, view point on the street, heading to the centroid."""
    from placeloom.functions.scalars import bearing
    from placeloom.operators.joins import binned_join, grow, polygon_box, segment_box
    from placeloom.operators.scale import top_k
    near = sh.foot(F.col("cx"), F.col("cy"), *[F.col(c) for c in ("x1", "y1", "x2", "y2")])
    # The footprint's distance to a segment: least over both shapes' vertices (no crossing inside the focus matters: 0 then).
    corner = F.array_min(F.transform("edges", lambda e: sh.foot(e["x1"], e["y1"], F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))["d2"]))
    ends = F.least(sh.distance2_to_polygon(F.col("edges"), F.col("x1"), F.col("y1")), sh.distance2_to_polygon(F.col("edges"), F.col("x2"), F.col("y2")))
    cuts = F.exists("edges", lambda e: (geo.cross_sign(e["x1"], e["y1"], e["x2"], e["y2"], F.col("x1"), F.col("y1")) * geo.cross_sign(e["x1"], e["y1"], e["x2"], e["y2"], F.col("x2"), F.col("y2")) < 0)
                    & (geo.cross_sign(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), e["x1"], e["y1"]) * geo.cross_sign(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), e["x2"], e["y2"]) < 0))
    gap = F.when(cuts, F.lit(0.0)).otherwise(F.least(corner, ends))
    pairs = binned_join(buildings, segments, polygon_box(), grow(segment_box(), focus), cell)
    scored = sh.once(pairs, d2=gap, px=near["px"], py=near["py"], view2=near["d2"]).filter(F.col("d2") <= focus * focus)
    per_street = scored.groupBy("place_id", "street", "b_id").agg(F.min("d2").alias("d2"), F.min(F.struct("view2", "line_id", "seq", "px", "py", "cx", "cy", "area")).alias("v"))
    rows = per_street.select("place_id", "street", "b_id", F.sqrt("d2").alias("distance"), F.col("v.area").alias("area"), F.col("v.px").alias("view_x"), F.col("v.py").alias("view_y"),
                             bearing(F.col("v.cx") - F.col("v.px"), F.col("v.cy") - F.col("v.py")).alias("heading"))
    return top_k(rows, ["place_id", "street"], [F.floor(F.col("distance") * 10 + 0.5), -F.col("area"), F.col("b_id")], limit)


def find_buildings(buildings: DataFrame, asks: DataFrame, radius: float, limit: int, cell: float) -> DataFrame:
    """Buildings that fit each ask: (place_id, ask, b_id, rank_no, distance, area).

    An ask (place_id, ask, x, y, id, name) names a position, an id, a part of a name or several of them; NULL asks for nothing, and an ask without any
    of the three finds all of its place. By position: footprints that reach within `radius`, nearest centroid first; without one the distance is
    0 and the larger come first. Case doesn't count in names. `buildings` (place_id, b_id, name, rings, cx, cy, area); the best `limit` per ask."""
    from placeloom.operators.joins import near_polygon_join, with_edges
    from placeloom.operators.scale import top_k
    own = ["b_id", "name", "cx", "cy", "area"]
    sought = asks.select("place_id", "ask", "x", "y", F.col("id").alias("_id"), F.lower("name").alias("_name"))
    placed = F.col("x").isNotNull() & F.col("y").isNotNull()
    by_place = near_polygon_join(sought.filter(placed), with_edges(buildings.select("place_id", *own, "rings")), radius, cell)
    flat = buildings.select("place_id", *own)
    by_id = sought.filter(~placed & F.col("_id").isNotNull()).join(flat, [sought.place_id == flat.place_id, F.col("_id") == F.col("b_id")]).drop(flat.place_id)
    by_name = sought.filter(~placed & F.col("_id").isNull()).join(flat, "place_id")
    fits = (F.col("_id").isNull() | (F.col("_id") == F.col("b_id"))) & (F.col("_name").isNull() | F.coalesce(F.contains(F.lower("name"), F.col("_name")), F.lit(False)))
    columns = ["place_id", "ask", "x", "y", "_id", "_name", *own]
    found = by_place.select(columns).unionByName(by_id.select(columns)).unionByName(by_name.select(columns)).filter(fits)
    dx, dy = F.col("cx") - F.col("x"), F.col("cy") - F.col("y")
    rows = found.select("place_id", "ask", "b_id", F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0)).alias("distance"), "area")
    return top_k(rows, ["place_id", "ask"], [F.floor(F.col("distance") * 10 + 0.5), -F.col("area"), F.col("b_id")], limit)


def camera(view_x: Column, view_y: Column, cx: Column, cy: Column, height: Column, gap: Column, unit: float = 1.0) -> Column:
    """STRUCT<x, y> a step back from a view point, away from the centroid, so that a building `gap` away fits the frame: 1.4 heights from
    it, 40 m at most. `unit` is one metre in the units of all lengths."""
    dx, dy = cx - view_x, cy - view_y
    length = F.sqrt(dx * dx + dy * dy)
    back = F.greatest(F.lit(0.0), F.least(F.lit(40.0 * unit), height * 1.4) - gap)
    step = F.coalesce(back / F.nullif(length, F.lit(0.0)), F.lit(0.0))
    return F.struct((view_x - dx * step).alias("x"), (view_y - dy * step).alias("y"))


def top_landmarks(landmarks: DataFrame, k: int) -> DataFrame:
    from placeloom.operators.scale import top_k
    return top_k(landmarks, ["place_id"], [F.col("area").desc(), F.col("id")], k)


def spawn_point(lines: DataFrame, footprints: DataFrame, land: DataFrame, offsets: list[float], cell: float) -> DataFrame:
    """Where to start in each place: the best clear point at fixed offsets round each road's closest approach to the centre.
    Score (metres): distance - 40 when named - 30 on a main road - 2 * width. `lines` carry named, main, width (cm), pts."""
    from placeloom.operators.joins import binned_join, grow, point_box, point_in_polygon_join, polygon_box
    step = geo.locate_along(lines.withColumns({"_qx": F.lit(0.0), "_qy": F.lit(0.0)}), "_qx", "_qy")
    # Lines are measured once, not at every try along them.
    step = sh.once(step, _e=sh.measured_edges(F.col("pts"))).filter(F.size("_e") > 0).drop("pts")
    last = F.element_at("_e", -1)
    step = step.withColumn("_len", last["s"] + last["len"])
    tries = step.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(len(offsets) - 1))))
    s = F.least(F.greatest(F.col("located_s") + F.get(F.array(*[F.lit(float(o)) for o in offsets]), F.col("k")), F.lit(300.0)), F.col("_len") - 300)
    tries = sh.once(tries, s=s).filter("s > 0")
    at = sh.once(tries, _at=sh.point_at(F.col("_e"), F.col("s"))).select("place_id", "way_id", "k", "named", "main", "width", "_at.x", "_at.y")
    key = ["place_id", "way_id", "k"]
    reach = F.col("width") / 2 + 50
    # Land first: few tries lie on it, and they come out of that join with their columns, so the tries are made once.
    held = cut_lineage(point_in_polygon_join(at, land, cell).select(*at.columns).dropDuplicates(key))
    blocked = binned_join(held, footprints, grow(point_box(), reach), polygon_box(), cell, sh.distance2_to_polygon(F.col("edges"), F.col("x"), F.col("y")) < reach * reach).select(*key).distinct()
    clear = held.join(blocked, key, "left_anti")
    score = (F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y")) / 100 - F.when(F.col("named"), 40).otherwise(0) - F.when(F.col("main"), 30).otherwise(0) - F.col("width") / 50)
    best = clear.groupBy("place_id").agg(F.min_by(F.struct("way_id", "k", "x", "y"), F.struct(F.floor(score * 1e6 + 0.5), "way_id", "k")).alias("b"))
    return best.select("place_id", "b.*")


def spaced_selection(points: DataFrame, keys: list[str], order: list[Column], pid: str, distance: float, k: int, cell: float | None = None) -> DataFrame:
    """Greedy choice in priority order: a point is taken when it is at least `distance` from all taken before it, at most k.

    Parallel form of the same greedy: in each round every point that outranks all undecided points closer than `distance`
    is taken and its neighbours go. Points meet only through grid cells of side `distance`; k is applied to the result in
    priority order (which the rounds do not change)."""
    from placeloom.operators.joins import binned_join, grow, point_box
    from placeloom.operators.scale import spread_row_number, top_k
    from placeloom.session import cut_lineage
    names = [f"_o{n}" for n in range(len(order))]
    ranked = spread_row_number(points.withColumns(dict(zip(names, order))).select(*keys, pid, "x", "y", *names), keys, [*names, pid], "rank").drop(*names)
    left, taken = cut_lineage(ranked), []
    size = cell or distance
    while True:
        other = left.select(*keys, F.col("rank").alias("r2"), F.col("x").alias("x2"), F.col("y").alias("y2"))
        gap = (F.col("x") - F.col("x2")) * (F.col("x") - F.col("x2")) + (F.col("y") - F.col("y2")) * (F.col("y") - F.col("y2")) < distance * distance
        beaten = binned_join(left, other, grow(point_box(), distance), point_box("x2", "y2"), size, gap & (F.col("r2") < F.col("rank")), keys=keys).select(*keys, "rank").distinct()
        won = cut_lineage(left.join(beaten, [*keys, "rank"], "left_anti"))
        taken.append(won)
        winner = won.select(*keys, F.col("rank").alias("r2"), F.col("x").alias("x2"), F.col("y").alias("y2"))
        gone = binned_join(left, winner, grow(point_box(), distance), point_box("x2", "y2"), size, gap, keys=keys).select(*keys, "rank").distinct()
        left = cut_lineage(left.join(gone, [*keys, "rank"], "left_anti"))
        if left.isEmpty():
            break
    chosen = taken[0]
    for more in taken[1:]:
        chosen = chosen.unionByName(more)
    return top_k(chosen, keys, [F.col("rank")], k, "pick_no")


def view_candidates(lines: DataFrame, targets: DataFrame, every: float, near: float, far: float, half_angle: float, cell: float) -> DataFrame:
    """What each camera position sees: positions every `every` along roads, six headings each, targets between `near` and `far`
    whose centroid lies within `half_angle` degrees of the heading. `targets`: with_edges form with cx, cy, b_id."""
    from placeloom.functions.scalars import angle_between, bearing
    from placeloom.operators.joins import binned_join, grow, point_box, polygon_box
    from placeloom.operators.raster import points_along
    at = points_along(lines, 300.0, every, F.lit(0.0), F.lit(1.0)).select("place_id", "way_id", "n", "x", "y", F.degrees(F.lit(1.5707963267948966) - F.col("angle")).alias("along"))
    d2 = sh.distance2_to_polygon(F.col("edges"), F.col("x"), F.col("y"))
    seen = sh.once(binned_join(at, targets, grow(point_box(), far), polygon_box(), cell), d2=d2).filter((F.col("d2") > near * near) & (F.col("d2") < far * far))
    head = seen.withColumn("side", F.explode(F.array(*[F.lit(s) for s in (-90, 90, -45, 45, -135, 135)]))).withColumn("heading", F.pmod(F.col("along") + F.col("side"), F.lit(360.0)))
    ok = F.abs(angle_between(bearing(F.col("cx") - F.col("x"), F.col("cy") - F.col("y")), F.col("heading"))) < half_angle
    return head.filter(ok).select("place_id", "way_id", "n", "side", "x", "y", "heading", "b_id", F.sqrt("d2").alias("distance"))


def greedy_cover(seen: DataFrame, view: list[str], limit: int) -> DataFrame:
    """Greedy maximum coverage per place: in each round the view with most still unseen targets (the nearest one on a tie) is
    taken and its targets go. All places advance together; a place ends when nothing is left or after `limit` views."""
    from placeloom.session import cut_lineage
    left, taken = cut_lineage(seen.select("place_id", *view, "b_id", "distance")), []
    for k in range(limit):
        near = seen.groupBy("place_id", *view).agg(F.min("distance").alias("near"))
        gain = left.groupBy("place_id", *view).agg(F.count_distinct("b_id").alias("gain")).join(near, ["place_id", *view])
        best = gain.groupBy("place_id").agg(F.min_by(F.struct(*view, "gain"), F.struct(-F.col("gain"), F.floor(F.col("near") * 10 + 0.5), *view)).alias("b"))
        won = cut_lineage(best.select("place_id", *[f"b.{c}" for c in view], "b.gain", F.lit(k + 1).alias("round_no")))
        if won.isEmpty():
            break
        taken.append(won)
        done = left.join(won, ["place_id", *view], "left_semi").select("place_id", "b_id").distinct()
        left = cut_lineage(left.join(done, ["place_id", "b_id"], "left_anti"))
    out = taken[0]
    for more in taken[1:]:
        out = out.unionByName(more)
    return out


# ---------------------------------------------------------------- set comparison
def unsurveyed(targets: DataFrame, known: DataFrame, scripts: DataFrame, key: str = "id") -> DataFrame:
    """Targets without an observation: no correction for them (or for the id without its remainder mark) and no script
    beyond an untouched starter; a script that says so itself counts as unsurveyed again."""
    bare = targets.withColumn("_bare", F.regexp_replace(key, "r$", ""))
    corrections = known.select(F.col(key).alias("_k")).distinct().withColumn("_known", F.lit(True))
    joined = (bare.join(corrections.withColumnRenamed("_k", key), key, "left").withColumnRenamed("_known", "_k1")
              .join(corrections.withColumnRenamed("_k", "_bare"), "_bare", "left").withColumnRenamed("_known", "_k2").join(scripts.select(key, "script"), key, "left"))
    has = F.coalesce("_k1", "_k2", F.lit(False))
    marked = F.contains(F.coalesce("script", F.lit("")), F.lit("not surveyed yet"))
    edited = F.col("script").isNotNull() & ~F.contains(F.col("script"), F.lit("Starter script"))
    return joined.filter(marked | (~has & ~edited)).drop("_bare", "_k1", "_k2", "script")


def diff_datasets(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys only in one of two tables, and for shared keys the columns that differ (one row per key and column)."""
    values = [c for c in a.columns if c not in keys]
    left = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in values], F.lit(True).alias("_a"))
    right = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in values], F.lit(True).alias("_b"))
    both = left.join(right, keys, "full")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in values]))
    what = F.when(F.col("_b").isNull(), F.array(F.lit("only in a"))).when(F.col("_a").isNull(), F.array(F.lit("only in b"))).otherwise(changed)
    return both.select(*keys, F.explode(what).alias("difference"))


def symmetric_nodes(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Each key as both, missing or extra."""
    rows = expected.select(*keys, F.lit(1).alias("e"), F.lit(0).alias("f")).unionByName(found.select(*keys, F.lit(0).alias("e"), F.lit(1).alias("f")))
    return rows.groupBy(*keys).agg(F.max("e").alias("e"), F.max("f").alias("f")).select(*keys, F.when(F.col("e") + F.col("f") == 2, "both").when(F.col("e") == 1, "missing").otherwise("extra").alias("state"))


def canonical_order(df: DataFrame, keys: list[str], out: str = "position") -> DataFrame:
    """Total order by key within a place, the same for any order of the input."""
    from placeloom.operators.scale import spread_row_number
    return spread_row_number(df, ["place_id"], keys, out)
