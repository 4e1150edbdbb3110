"""Contract and audit jobs: every check is a table of findings, empty when the data keeps its contract."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from placeloom.functions import shapes as sh
from placeloom.operators import geometry as geo
from placeloom.operators.graph import connected_components
from placeloom.operators.scale import with_next
from placeloom.operators.select import diff_datasets
from placeloom.session import cut_lineage

# A contract is rows of (path, rule, argument): type-free rules over columns of a table.
Rule = tuple[str, str, object]


def conform(rows: DataFrame, key: list[str], contract: list[Rule]) -> DataFrame:
    """(key, path, rule) per violation. Rules: required, enum (list), min, max, above (exclusive), pattern, any_of (list of
    columns, one must be present). The contract becomes one array of conditions, evaluated in a single pass."""
    tests: list[Column] = []
    for path, rule, arg in contract:
        col = F.col(path) if rule != "any_of" else None
        broken = {
            "required": lambda: col.isNull(), "enum": lambda: col.isNotNull() & ~col.isin(arg), "min": lambda: col < arg, "max": lambda: col > arg,
            "above": lambda: col <= arg, "pattern": lambda: ~col.rlike(arg), "any_of": lambda: F.coalesce(*[F.col(c).cast("string") for c in arg]).isNull(),
        }[rule]()
        tests.append(F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(path).alias("path"), F.lit(rule).alias("rule"))))
    return rows.select(*key, F.explode(F.array_compact(F.array(*tests))).alias("v")).select(*key, "v.path", "v.rule")


def check_features(features: DataFrame, cell: float, eps: float, world) -> DataFrame:
    """Faults of building rows (id, rings, chunk_i, chunk_j, chunks ARRAY<STRUCT<ci,cj>>, min_h, wall_h): orientation, owner rule,
    chunk list, bounds, walls below their top."""
    step = geo.owner_chunk(features.withColumnsRenamed({"chunk_i": "said_i", "chunk_j": "said_j"}), cell, eps, world)
    rings_ok = (sh.signed_area(sh.ring_edges(F.get("rings", F.lit(0)))) > 0) & F.forall(F.slice("rings", F.lit(2), F.greatest(F.size("rings") - 1, F.lit(0))), lambda r: sh.signed_area(sh.ring_edges(r)) < 0)
    found = F.array_sort(F.transform("cells", lambda c: F.struct(c["ci"].alias("ci"), c["cj"].alias("cj"))))
    inside = (F.col("xmin") >= world[0]) & (F.col("ymin") >= world[1]) & (F.col("xmax") <= world[2]) & (F.col("ymax") <= world[3])
    tests = {"orientation": ~rings_ok, "owner": (F.col("said_i") != F.col("chunk_i")) | (F.col("said_j") != F.col("chunk_j")), "chunks": F.array_sort("chunks") != found,
             "bounds": ~inside, "heights": F.col("min_h") >= F.col("wall_h")}
    return step.select("id", F.explode(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in tests.items()]))).alias("fault"))


def duplicate_ids(features: DataFrame, key: list[str]) -> DataFrame:
    return features.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def check_spans(lines: DataFrame, spans: DataFrame, cell: float, world) -> DataFrame:
    """Faults of spans (way_id, span_no dense, ci, cj, s0, s1): empty, out of order, midpoint in another chunk, or spans that do not
    add up to the line's length inside the bounds."""
    spans = cut_lineage(spans)     # four checks read it
    order = with_next(spans.select("way_id", "span_no", "s0", "s1"), ["way_id"], "span_no", ["s0", "s1"])
    faults = spans.filter("s0 >= s1").select("way_id", F.lit("empty").alias("fault")).unionByName(order.filter(F.col("next_s0") < F.col("s1") - 1e-9).select("way_id", F.lit("order").alias("fault")))
    measured = lines.select("way_id", sh.measured_edges(F.col("pts")).alias("_e"), sh.line_length(F.col("pts")).alias("_len"))
    at = sh.once(spans.filter("s0 < s1").join(measured, "way_id"), m=sh.point_at(F.col("_e"), (F.col("s0") + F.col("s1")) / 2))
    # A span of one straight run: its middle lies in its own chunk (a bent span is cut at its vertices first).
    bent = F.size(geo.cut_edges(F.col("_e"), F.col("s0"), F.col("s1"))) > 1
    away = ~bent & ((F.floor(F.col("m.x") / cell) != F.col("ci")) | (F.floor(F.col("m.y") / cell) != F.col("cj")))
    faults = faults.unionByName(at.filter(away).select("way_id", F.lit("chunk").alias("fault")))
    have = spans.groupBy("way_id").agg(F.sum(F.col("s1") - F.col("s0")).alias("have"))
    # The bounds are half-open: a stretch along their upper edges lies outside.
    e = geo.line_edges(lines.select("way_id", "pts"))
    outside = ((F.col("x1") == world[2]) & (F.col("x2") == world[2])) | ((F.col("y1") == world[3]) & (F.col("y2") == world[3]))
    step = {c: F.col(c) for c in ("x1", "y1", "x2", "y2")}
    meets, enter, leave = geo.clip_range(step, world)
    want = e.filter(~outside & meets & (enter < leave)).groupBy("way_id").agg(F.sum((leave - enter) * sh.edge_length(step)).alias("want"))
    cover = have.join(want, "way_id", "full").filter(F.abs(F.coalesce("have", F.lit(0.0)) - F.coalesce("want", F.lit(0.0))) > 1e-3).select("way_id", F.lit("cover").alias("fault"))
    return faults.unionByName(cover).distinct()


def check_overlaps(cells: DataFrame, keys: list[str], deck_classes: list, water_class, min_cells: int = 1) -> DataFrame:
    """Pairs of features that share ground, with the cells they share; a road deck over water is allowed.

    Pairs meet on a cell by an equi-join with id order, so only neighbours that really overlap are paired."""
    a = cells.select(*keys, F.col("id").alias("a"), F.col("class").alias("ac")).distinct()
    b = cells.select(*keys, F.col("id").alias("b"), F.col("class").alias("bc")).distinct()
    deck = ((F.col("ac") == water_class) & F.col("bc").isin(deck_classes)) | ((F.col("bc") == water_class) & F.col("ac").isin(deck_classes))
    return a.join(b, keys).filter((F.col("a") < F.col("b")) & ~deck).groupBy("a", "b").agg(F.count("*").alias("cells")).filter(F.col("cells") >= min_cells)


def check_collision(buildings: DataFrame, pieces: DataFrame) -> DataFrame:
    """Cells of ground-standing buildings (place, ci, cj, id) no collision cell covers, per building."""
    return buildings.join(pieces.select("place_id", "ci", "cj").distinct(), ["place_id", "ci", "cj"], "left_anti").groupBy("place_id", "id").agg(F.count("*").alias("open_cells"))


def check_index(index: DataFrame, members: DataFrame, keys: list[str]) -> DataFrame:
    """Disagreement both ways between a chunk index and the features, as rows (keys, problem)."""
    rows = index.select(*keys, F.lit(1).alias("i"), F.lit(0).alias("m")).unionByName(members.select(*keys, F.lit(0).alias("i"), F.lit(1).alias("m")))
    both = rows.groupBy(*keys).agg(F.max("i").alias("i"), F.max("m").alias("m")).filter("i + m = 1")
    return both.select(*keys, F.when(F.col("i") == 1, "dangling").otherwise("not indexed").alias("problem"))


def check_graph(said: DataFrame, recomputed: DataFrame, keys: list[str]) -> DataFrame:
    """Published junctions (or crossings) against recomputed ones."""
    return diff_datasets(said, recomputed, keys)


def node_position_conflicts(vertices: DataFrame) -> DataFrame:
    """Nodes at more than one position. The spread of positions is an algebraic aggregate, no set is kept."""
    at = vertices.groupBy("place_id", "node_id").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count("*").alias("uses"))
    return at.filter("x0 < x1 OR y0 < y1")


def account_cells(expected: DataFrame, kept: DataFrame) -> DataFrame:
    """(place_id, class, ci, cj, e, k): each cell once, with 1 where it is expected and where it is kept."""
    keys = ["place_id", "class", "ci", "cj"]
    rows = expected.select(*keys, F.lit(1).alias("e"), F.lit(0).alias("k")).unionByName(kept.select(*keys, F.lit(0).alias("e"), F.lit(1).alias("k")))
    return rows.groupBy(*keys).agg(F.max("e").alias("e"), F.max("k").alias("k"))


def cell_accounting(expected: DataFrame, kept: DataFrame) -> DataFrame:
    """Cells per class: expected, kept, lost, fabricated. Inputs: (place_id, class, ci, cj)."""
    return account_cells(expected, kept).groupBy("place_id", "class").agg(F.sum("e").alias("expected"), F.sum("k").alias("kept"), F.count_if((F.col("e") == 1) & (F.col("k") == 0)).alias("lost"), F.count_if((F.col("e") == 0) & (F.col("k") == 1)).alias("fabricated"))


def lost_pieces(expected: DataFrame, kept: DataFrame, res_area: float, lost_area: float) -> DataFrame:
    """Connected pieces (place_id, class, area) of at least `lost_area` that are expected and not kept."""
    lost = account_cells(expected, kept).filter("e = 1 AND k = 0").select("place_id", "class", "ci", "cj", F.lit(False).alias("mark"))
    return cell_pieces(lost, ["class"]).select("place_id", "class", (F.col("cells") * res_area).alias("area")).filter(F.col("area") >= lost_area)


def completeness_areas(expected: DataFrame, kept: DataFrame, res_area: float, lost_area: float) -> tuple[DataFrame, DataFrame]:
    """Cell accounting per class (expected, kept, lost, fabricated) and connected lost pieces of at least `lost_area`.
    Inputs: (place_id, class, ci, cj)."""
    return cell_accounting(expected, kept), lost_pieces(expected, kept, res_area, lost_area)


def cell_pieces(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(place_id, keys, piece, cells, marked): connected groups of distinct cells (place_id, keys, ci, cj, mark), as `run_pieces` finds them."""
    return run_pieces(cells.select("place_id", *keys, "cj", F.col("ci").alias("lo"), F.col("ci").alias("hi"), "mark"), keys)


def run_pieces(runs: DataFrame, keys: list[str]) -> DataFrame:
    """(place_id, keys, piece, cells, marked): connected groups of cells, neighbours side by side. Cells come as runs (place_id, keys, cj, lo, hi, mark) of a
    row that share none; those that follow each other are one vertex. `marked` counts the cells of runs whose `mark` is true."""
    group = ["place_id", *keys, "cj"]
    along, size = Window.partitionBy(*group).orderBy("lo"), F.col("hi") - F.col("lo") + 1
    starts = runs.withColumn("_new", F.coalesce(F.lag("hi").over(along) + 1 < F.col("lo"), F.lit(True)).cast("long"))
    named = starts.withColumn("_s", F.sum("_new").over(along)).groupBy(*group, "_s").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum(size).alias("cells"), F.sum(F.when(F.col("mark"), size).otherwise(0)).alias("marked"))
    named = cut_lineage(named.withColumn("v", F.monotonically_increasing_id()).drop("_s"))
    below = named.select("place_id", *keys, (F.col("cj") + 1).alias("cj"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("v").alias("a"))
    links = below.join(named, group).filter("_lo <= hi AND lo <= _hi").select("place_id", "a", F.col("v").alias("b"))
    named = named.join(connected_components(named.select("place_id", "v"), links).withColumnRenamed("component", "piece"), ["place_id", "v"])
    return named.groupBy("place_id", *keys, "piece").agg(F.sum("cells").alias("cells"), F.sum("marked").alias("marked"))


SPAN = 256  # cells of a row that are compared at once, at least
WANTED, KEPT, KEPT_EDGE, WANTED_EDGE = range(4)


def ground_covers(expected: DataFrame, kept: DataFrame, res: float, tolerance: float, cell: float) -> DataFrame:
    """(place_id, cj, lo, hi, kind, rank, source): stretches of rows of cells with what covers them, an expected element (WANTED), a kept area (KEPT), or ground
    within `tolerance` of an edge of either. Everything with a stretch covers all of it, so stretches stand for their cells. Rows are cut at multiples of
    `cell`, or of SPAN cells where that is more."""
    from placeloom.operators.joins import with_edges
    from placeloom.operators.raster import near_runs, polygon_runs
    nobody = F.lit(None).cast(expected.schema["source"].dataType)
    layers = [(WANTED, polygon_runs(with_edges(expected.select("place_id", "source", "rank", "rings")), res), F.col("source")), (KEPT, polygon_runs(with_edges(kept.select("place_id", "rank", "rings")), res), nobody)]
    for kind, areas in ((KEPT_EDGE, kept), (WANTED_EDGE, expected)):
        layers.append((kind, near_runs(geo.edges(areas.select("place_id", "rank", "rings")).select("place_id", "rank", "x1", "y1", "x2", "y2"), tolerance, res), nobody))
    rows = None
    for kind, runs, source in layers:
        more = runs.select("place_id", "cj", "lo", "hi", F.lit(kind).alias("kind"), "rank", source.alias("source"))
        rows = more if rows is None else rows.unionByName(more)
    span = max(SPAN, math.ceil(cell / res))
    part = F.explode(F.sequence(F.floor(F.col("lo") / span), F.floor(F.col("hi") / span)))
    rows = rows.withColumn("_part", part).withColumns({"lo": F.greatest("lo", F.col("_part") * span), "hi": F.least("hi", F.col("_part") * span + span - 1)})
    rows = cut_lineage(rows)     # read twice
    row = ["place_id", "cj", "_part"]
    cuts = rows.select(*row, F.explode(F.array(F.col("lo"), F.col("hi") + 1)).alias("_at")).distinct()
    stretches = cuts.withColumn("_end", F.lead("_at").over(Window.partitionBy(*row).orderBy("_at")) - 1).filter("_end IS NOT NULL")
    met = rows.join(stretches, row).filter("_at >= lo AND _at <= hi")
    return cut_lineage(met.select("place_id", "cj", F.col("_at").alias("lo"), F.col("_end").alias("hi"), "kind", "rank", "source").distinct())


def ground_losses(expected: DataFrame, kept: DataFrame, res: float, tolerance: float, cell: float, least_rank: int = 0) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Four tables of cells by the rules of `completeness`: connected pieces of elements that are lost (place_id, source, rank, cells), pieces of expected
    layers (place_id, rank, cells, marked: those kept), fabricated ground (place_id, rank, cells), and all ground (place_id, rank, expected, kept).

    Ranks from `least_rank` on are looked at. One below 0 isn't in the order of layers: its elements are kept by areas of its own rank alone, and
    no layer's pieces are sought for it."""
    covers = ground_covers(expected.filter(F.col("rank") >= least_rank), kept, res, tolerance, cell)
    at, size = ["place_id", "cj", "lo", "hi"], F.col("hi") - F.col("lo") + 1
    least = lambda kind, cond=F.lit(True): F.min(F.when((F.col("kind") == kind) & cond, F.col("rank")))
    layer = F.col("rank") >= 0
    # What holds a stretch: its lowest rank, and the lowest that isn't taken from all; the lowest whose edge is near; the layer expected there.
    state = covers.groupBy(*at).agg(least(KEPT).alias("_any"), least(KEPT, layer).alias("_own"), least(KEPT_EDGE, layer).alias("_near"), least(WANTED, layer).alias("_top"))
    wanted = covers.filter(F.col("kind") == WANTED).select(*at, "source", "rank")
    above = lambda c: F.col(c).isNull() | (F.col(c) > F.col("rank"))
    lost = wanted.filter(layer).join(state, at).filter(above("_any") & above("_near")).select(*at, "source", "rank")
    if least_rank < 0:
        lost = lost.unionByName(wanted.filter(~layer).join(covers.filter(F.col("kind").isin(KEPT, KEPT_EDGE)).select(*at, "rank"), [*at, "rank"], "left_anti"))
    pieces = state.filter(F.col("_top").isNotNull() & F.coalesce(F.col("_any") >= 0, F.lit(True)))
    pieces = pieces.select(*at, F.col("_top").alias("rank"), F.coalesce(F.col("_own") <= F.col("_top"), F.lit(False)).alias("mark"))
    ground = covers.filter((F.col("kind") == KEPT) & (F.col("rank") >= least_rank)).select(*at, "rank")
    extra = ground.join(covers.filter(F.col("kind").isin(WANTED, WANTED_EDGE)).select(*at, "rank"), [*at, "rank"], "left_anti")
    both = wanted.select(*at, "rank").distinct().select("place_id", "rank", size.alias("expected"), F.lit(0).cast("long").alias("kept"))
    both = both.unionByName(ground.select("place_id", "rank", F.lit(0).cast("long").alias("expected"), size.alias("kept")))
    return (run_pieces(lost.withColumn("mark", F.lit(False)), ["source", "rank"]), run_pieces(pieces, ["rank"]), extra.groupBy("place_id", "rank").agg(F.sum(size).alias("cells")),
            both.groupBy("place_id", "rank").agg(F.sum("expected").alias("expected"), F.sum("kept").alias("kept")))


def completeness(expected: DataFrame, kept: DataFrame, res: float, tolerance: float, cell: float, least_lost: float, least_piece: float, least_share: float,
                 most_fabricated: float) -> DataFrame:
    """Findings (place_id, rank, finding, source, area, share) about ground that a dataset should have kept, on cells of side `res`.

    `expected` are the source's elements (place_id, source, rank, rings), `kept` the dataset's areas (place_id, rank, rings); of layers that meet, the
    lower rank keeps the ground, and ranks below 0 (water, collision) take ground from all. Findings:
    - lost: a connected piece of one element of `least_lost` or more that no area of its rank or a lower one covers, beyond `tolerance` from
      every edge that such an area (of rank 0 or more) kept: simplifying moves edges, it removes no ground elsewhere;
    - missing piece: a connected piece of an expected layer (what its elements hold after lower ranks took theirs) of `least_piece` or more of
      which less than `least_share` is kept at its rank or a lower one; `share` tells how much;
    - fabricated: more than `most_fabricated` of a rank's ground farther than `tolerance` from every element of that rank.
    """
    lost, pieces, extra, _ = ground_losses(expected, kept, res, tolerance, cell)
    finding = lambda df, name, source, area, share: df.select("place_id", "rank", F.lit(name).alias("finding"), source.alias("source"), area.alias("area"), share.alias("share"))
    none, nobody = F.lit(None).cast("double"), F.lit(None).cast(expected.schema["source"].dataType)
    area, share = F.col("cells") * (res * res), F.col("marked") / F.col("cells")
    return (finding(lost.filter(area >= least_lost), "lost", F.col("source"), area, none).unionByName(finding(pieces.filter((area >= least_piece) & (share < least_share)), "missing piece", nobody, area, share))
            .unionByName(finding(extra.filter(area > most_fabricated), "fabricated", nobody, area, none)))


def completeness_report(expected: DataFrame, kept: DataFrame, res: float, tolerance: float, cell: float, least_lost: float, least_piece: float, least_share: float,
                        most_fabricated: float, water: int = -1) -> DataFrame:
    """One row per place and rank by the rules of `completeness`: (place_id, rank, expected, kept: areas; lost_pieces, lost: how many and their area; pieces,
    least_share: expected pieces of `least_piece` or more and the least share of one that is kept; missing: how many are kept by less than
    `least_share`; fabricated: area; ok). Water is the rank `water`, accounted for by water alone; its fabricated ground is told, not judged."""
    lost, pieces, extra, ground = ground_losses(expected, kept, res, tolerance, cell, water)
    by, area, share = ["place_id", "rank"], F.col("cells") * (res * res), F.col("marked") / F.col("cells")
    gone = lost.filter(area >= least_lost).groupBy(*by).agg(F.count("*").alias("lost_pieces"), F.sum(area).alias("lost"))
    whole = pieces.filter(area >= least_piece).groupBy(*by).agg(F.count("*").alias("pieces"), F.min(share).alias("least_share"), F.count_if(share < least_share).alias("missing"))
    out = ground.join(gone, by, "left").join(whole, by, "left").join(extra.select(*by, area.alias("fabricated")), by, "left")
    out = out.fillna(0, ["lost_pieces", "lost", "pieces", "missing", "fabricated"])
    ok = (F.col("lost_pieces") == 0) & (F.col("missing") == 0) & ((F.col("rank") < 0) | (F.col("fabricated") <= most_fabricated))
    return out.withColumns({"expected": F.col("expected") * (res * res), "kept": F.col("kept") * (res * res), "ok": ok})


def scale_audit(pairs: DataFrame) -> DataFrame:
    """Measured against geodesic lengths: (id, lat1.., x1..y2 in metres) with error, tolerance max(0.10 m, 0.1 %) and verdict."""
    g = geo.geodesic_distances(pairs)
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    out = g.withColumns({"measured_m": F.sqrt(dx * dx + dy * dy), "tolerance_m": F.greatest(F.lit(0.10), F.col("distance_m") * 0.001)})
    return out.withColumn("error_m", F.abs(F.col("measured_m") - F.col("distance_m"))).withColumn("ok", F.col("error_m") <= F.col("tolerance_m"))


def courtyard_check(source: DataFrame, kept: DataFrame) -> DataFrame:
    """Holes per source polygon against the holes kept; source polygons without holes are not courtyards."""
    holes = lambda df, name: df.groupBy("id").agg(F.sum(F.size("rings") - 1).alias(name))
    return holes(source, "holes_source").filter("holes_source > 0").join(holes(kept, "holes_kept"), "id", "left").fillna(0, ["holes_kept"]).withColumn("ok", F.col("holes_source") == F.col("holes_kept"))


def raised_in_collision(raised: DataFrame, collision: DataFrame) -> DataFrame:
    """Raised parts that block the ground all the same."""
    return raised.join(collision.select("id").distinct(), "id", "left_semi")


def raster_audit(raster: DataFrame, x0: float, y0: float, step: float, half: float, support: float) -> DataFrame:
    """Coverage, holes and range of a place's grid with a verdict. Needs x, y, z, fallback."""
    from placeloom.operators.aggregate import raster_coverage, raster_range
    both = raster_coverage(raster, half, support).join(raster_range(raster, x0, y0, step, half), "place_id")
    return both.withColumn("ok", F.col("covers") & (F.col("play_no_data") == 0) & (F.col("support_no_data") == 0) & (F.col("support_fallback") == 0))


def provenance_audit(pins: DataFrame, actual: DataFrame, texts: DataFrame, pattern: str, policy_marker: str) -> DataFrame:
    """Findings: pinned digests that differ or are missing, and forbidden mentions outside policy text."""
    p = pins.join(actual.withColumnRenamed("sha256", "now"), "name", "left")
    pinned = p.filter(F.col("now").isNull() | (F.col("now") != F.col("sha256"))).select("name", F.when(F.col("now").isNull(), "missing").otherwise("changed").alias("finding"), F.lit(1).cast("bigint").alias("n"))
    lines = texts.select("name", F.explode(F.split("text", "\n")).alias("line")).filter(~F.contains(F.col("line"), F.lit(policy_marker)))
    said = lines.groupBy("name").agg(F.sum(F.regexp_count("line", F.lit(pattern))).alias("n")).filter("n > 0")
    return pinned.unionByName(said.select("name", F.lit("mention").alias("finding"), F.col("n").cast("bigint").alias("n")))


def refinement_gate(overrides: DataFrame, allowed: dict[str, str]) -> DataFrame:
    """Corrections that change a place's data rather than a build setting: (place_id, scope, key, setting). `allowed` maps a
    default's name to the pattern of its value."""
    flat = overrides.select("place_id", "scope", "key", F.explode_outer("attrs").alias("setting", "value"))
    ok = F.lit(False)
    for name, pattern in allowed.items():
        ok = ok | ((F.col("scope") == "default") & (F.col("setting") == name) & F.col("value").rlike(pattern))
    return flat.filter(~F.coalesce(ok, F.lit(False)) & (F.col("setting").isNotNull() | (F.col("scope") != "default"))).select("place_id", "scope", "key", "setting")


def snapshot_consistency(manifest: DataFrame, derived: DataFrame) -> DataFrame:
    """(place_id, key) whose stated value is not the derived one (NULL when one side has none)."""
    both = manifest.withColumnRenamed("value", "stated").join(derived.withColumnRenamed("value", "found"), ["place_id", "key"], "full")
    return both.filter(~F.col("stated").eqNullSafe(F.col("found")))


def dataset_fingerprint(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Order-independent content hash: rows and four 32-bit lanes of each row's SHA-256 summed, so it is combined in the map
    tasks and equal for any partitioning; duplicates count."""
    keys = keys or []
    digest = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    lane = lambda k: F.conv(F.substring("_d", 1 + 8 * k, 8), 16, 10).cast("decimal(20,0)")
    sums = df.select(*keys, digest.alias("_d")).groupBy(*keys).agg(F.count("*").alias("rows"), *[F.sum(lane(k)).alias(f"_s{k}") for k in range(4)])
    return sums.select(*keys, "rows", F.sha1(F.concat_ws("|", "rows", *[F.col(f"_s{k}").cast("string") for k in range(4)]).cast("binary")).alias("fingerprint"))
