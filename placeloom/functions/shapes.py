"""Plane geometry as Column expressions.

A ring is ARRAY<STRUCT<x,y>> without a closing point, a polygon `rings` is ARRAY<ring> (outer first), a line is
ARRAY<STRUCT<x,y>>. Everything works inside one row, so nothing here shuffles. Units are the caller's."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def unnest(df: DataFrame, array: Column, out: str, pos: str | None = None) -> DataFrame:
    """One row per element. The outer form keeps the optimizer from adding size(array) > 0 below the projections that
    build the array, which would evaluate (and inline) those expressions twice."""
    rows = df.select("*", F.posexplode_outer(array).alias(pos, out)) if pos else df.select("*", F.explode_outer(array).alias(out))
    return rows.filter(F.col(out).isNotNull())


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated exactly once per row. A plain projection would be inlined into every filter and
    join key built on it (an edge-array fold is long); a one-row generator is a barrier the optimizer keeps."""
    made = F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select(*[c for c in df.columns if c not in columns], made)


def let(value: Column, body) -> Column:
    """body(value) with `value` evaluated once inside a higher-order function."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clamp(v: Column, lo, hi) -> Column:
    lo, hi = (b if isinstance(b, Column) else F.lit(b) for b in (lo, hi))
    return F.least(F.greatest(v, lo), hi)


def pair(a: Column, b: Column) -> Column:
    return F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"))


def tail(array: Column) -> Column:
    return F.slice(array, F.lit(2), F.greatest(F.size(array) - 1, F.lit(0)))


def head(array: Column) -> Column:
    return F.slice(array, F.lit(1), F.greatest(F.size(array) - 1, F.lit(0)))


def line_edges(pts: Column) -> Column:
    return F.zip_with(head(pts), tail(pts), pair)


def ring_edges(ring: Column) -> Column:
    return F.zip_with(ring, F.concat(tail(ring), F.slice(ring, F.lit(1), F.lit(1))), pair)


def polygon_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


def fold(edges: Column, value) -> Column:
    """Sum of value(edge) over an edge array."""
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + value(e))


def signed_area(edges: Column) -> Column:
    return fold(edges, lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2


def bounds(points: Column) -> list[Column]:
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return [F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)]


def edge_length(e: Column) -> Column:
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    return F.sqrt(dx * dx + dy * dy)


def inside(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over all rings, holes included."""
    crosses = lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (
        x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"])
    hits = F.aggregate(edges, F.lit(0), lambda acc, e: acc + F.when(crosses(e), 1).otherwise(0))
    return hits % 2 == 1


def foot(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> dict[str, Column]:
    """Closest point of a segment: parameter t, position, squared distance."""
    dx, dy = x2 - x1, y2 - y1
    t = clamp(F.coalesce(((x - x1) * dx + (y - y1) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0)), 0.0, 1.0)
    px, py = x1 + t * dx, y1 + t * dy
    return {"t": t, "px": px, "py": py, "d2": (px - x) * (px - x) + (py - y) * (py - y)}


def edge_distance2(edges: Column, x: Column, y: Column) -> Column:
    """Least squared distance from a point to an edge array."""
    return F.array_min(F.transform(edges, lambda e: foot(x, y, e["x1"], e["y1"], e["x2"], e["y2"])["d2"]))


def distance2_to_polygon(edges: Column, x: Column, y: Column) -> Column:
    return F.when(inside(edges, x, y), F.lit(0.0)).otherwise(edge_distance2(edges, x, y))


def overlap_with_cell(edges: Column, x0: Column, y0: Column, size) -> Column:
    """Exact area of a polygon inside the square [x0, x0+size) x [y0, y0+size), by Green's theorem: each edge is cut
    to the square's columns and contributes the integral of its clamped height (rings oriented, holes negative)."""
    x1, y1, size = x0 + size, y0 + size, F.lit(float(size))
    height = lambda y: clamp(y, y0, y1) - y0
    # integral of `height` from y0 to y
    integral = lambda y: height(y) * height(y) / 2 + size * F.greatest(y - y1, F.lit(0.0))

    def part(e: Column) -> Column:
        xa, xb = clamp(e["x1"], x0, x1), clamp(e["x2"], x0, x1)
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        at = lambda x: e["y1"] + (x - e["x1"]) * dy / F.nullif(dx, F.lit(0.0))
        flat = -height(e["y1"]) * (xb - xa)
        sloped = -(integral(at(xb)) - integral(at(xa))) * dx / F.nullif(dy, F.lit(0.0))
        return F.when(xa == xb, F.lit(0.0)).when(F.abs(dy) < 1e-9, flat).otherwise(sloped)
    return fold(edges, part)


def cell_range(lo: Column, hi: Column, size) -> Column:
    """Integer cells of [lo, hi]."""
    return F.sequence(F.floor(lo / size).cast("int"), F.floor(hi / size).cast("int"))


def cells_of_box(x0: Column, y0: Column, x1: Column, y1: Column, size) -> Column:
    """ARRAY<STRUCT<ci, cj>> of the grid cells a box touches."""
    return F.flatten(F.transform(cell_range(x0, x1, size), lambda i: F.transform(
        cell_range(y0, y1, size), lambda j: F.struct(i.alias("ci"), j.alias("cj")))))


# ---------------------------------------------------------------- lines
def measured_edges(pts: Column) -> Column:
    """Edges of a line with the arc length `s` at their start and their length `len`; zero-length edges are left out."""
    edges = lambda p: F.filter(F.transform(line_edges(p), lambda e: F.struct(e["x1"].alias("x1"), e["y1"].alias("y1"), e["x2"].alias("x2"),
                                                                             e["y2"].alias("y2"), edge_length(e).alias("len"))), lambda e: e["len"] > 0)
    empty = F.transform(edges(F.slice(pts, F.lit(1), F.lit(0))), lambda e: with_start(e, F.lit(0.0)))
    start = F.struct(F.lit(0.0).alias("s"), empty.alias("out"))
    return F.aggregate(edges(pts), start, lambda acc, e: F.struct((acc["s"] + e["len"]).alias("s"),
                                                             F.concat(acc["out"], F.array(with_start(e, acc["s"]))).alias("out")),
                       lambda acc: acc["out"])


def with_start(e: Column, s: Column) -> Column:
    return F.struct(*[e[c].alias(c) for c in ("x1", "y1", "x2", "y2", "len")], s.alias("s"))


def point_at(edges: Column, s: Column) -> Column:
    """STRUCT<x,y,dx,dy> at arc length s (clamped to the line) with the direction of the edge it lies on."""
    found = F.filter(edges, lambda e: (s >= e["s"]) & (s <= e["s"] + e["len"]))
    last = F.element_at(edges, -1)

    def at(e: Column) -> Column:
        t = clamp((s - e["s"]) / e["len"], 0.0, 1.0)
        return F.struct((e["x1"] + (e["x2"] - e["x1"]) * t).alias("x"), (e["y1"] + (e["y2"] - e["y1"]) * t).alias("y"),
                        ((e["x2"] - e["x1"]) / e["len"]).alias("dx"), ((e["y2"] - e["y1"]) / e["len"]).alias("dy"))
    return let(F.coalesce(F.get(found, F.lit(0)), F.when(s < 0, F.get(edges, F.lit(0))).otherwise(last)), at)


def line_length(pts: Column) -> Column:
    return F.aggregate(line_edges(pts), F.lit(0.0), lambda acc, e: acc + edge_length(e))
