"""Heights in holes of a raster as the smoothest continuation of their surroundings, solved on two grids.

Each hole cell is to be the mean of its neighbours in the grid (past the border a cell stands in for its missing neighbour). Tiles with an
overlap are solved on their own, each in one task of bounded size; what they leave over is summed up on a coarse grid of blocks, where what is
far apart meets, and the coarse solution corrects all cells of a block. A round is two or three shuffles of the hole cells and their rim,
whatever the width of a hole; known cells away from holes don't travel."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from placeloom.session import cut_lineage

STEPS = ((0, -1), (0, 1), (-1, 0), (1, 0))
COARSE = 64  # blocks along a side of the coarse grid of a place, at most
CELL = ["place_id", "j", "i"]


def conjugate_gradients(apply, rhs: np.ndarray, start: np.ndarray, scale: np.ndarray, exact: float, most: int = 5000) -> np.ndarray:
    """x with apply(x) = rhs, preconditioned with the diagonal `scale`; stops when no residual is above `exact`."""
    x = start.copy()
    r = rhs - apply(x)
    z = r / scale
    p, rz = z.copy(), float((r * z).sum())
    for _ in range(most):
        if np.abs(r).max(initial=0.0) <= exact or rz <= 0:
            break
        ap = apply(p)
        a = rz / float((p * ap).sum())
        x += a * p
        r -= a * ap
        z = r / scale
        rz, old = float((r * z).sum()), rz
        p = z + (rz / old) * p
    return x


def around(a: np.ndarray) -> np.ndarray:
    """Sum of the four neighbours inside the array."""
    out = np.zeros_like(a)
    out[1:] += a[:-1]
    out[:-1] += a[1:]
    out[:, 1:] += a[:, :-1]
    out[:, :-1] += a[:, 1:]
    return out


def solve_window(z: np.ndarray, there: np.ndarray, free: np.ndarray, exact: float) -> np.ndarray:
    """Heights of a window with its `free` cells solved, all others as they are."""
    degree = around(there.astype(float))
    live = free & (degree > 0)
    fixed = np.where(there & ~live, z, 0.0)
    out = z.copy()
    out[live] = conjugate_gradients(lambda v: degree[live] * v - around(_spread(live, v))[live], around(fixed)[live], z[live], degree[live], exact)
    return out


def _spread(mask: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(mask.shape)
    out[mask] = values
    return out


def _neighbours(cells: DataFrame, *columns: str) -> DataFrame:
    """One row for each cell and neighbour place (nj, ni)."""
    steps = F.array(*[F.struct(F.lit(dj).alias("dj"), F.lit(di).alias("di")) for dj, di in STEPS])
    sent = cells.select(*CELL, *columns, F.explode(steps).alias("_s"))
    return sent.select(*CELL, *columns, (F.col("j") + F.col("_s.dj")).alias("nj"), (F.col("i") + F.col("_s.di")).alias("ni"))


def solve_tiles(cells: DataFrame, tile: int, halo: int, exact: float) -> DataFrame:
    """(place_id, j, i, z, change) of the hole cells: every tile with holes solved together with `halo` cells round it, whose outermost
    ring stays as it is; each tile keeps its own cells. A group has at most (tile + 2 * halo) squared rows."""
    def reach(c: str):
        return F.sequence(F.floor((F.col(c) - halo) / tile).cast("int"), F.floor((F.col(c) + halo) / tile).cast("int"))

    wanted = cells.filter("hole").select("place_id", F.floor(F.col("j") / tile).cast("int").alias("tj"), F.floor(F.col("i") / tile).cast("int").alias("ti")).distinct()
    copies = cells.withColumn("tj", F.explode(reach("j"))).withColumn("ti", F.explode(reach("i"))).join(wanted, ["place_id", "tj", "ti"], "left_semi")
    side = tile + 2 * halo

    def solve(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        j, i = (rows["j"] - (int(key[1]) * tile - halo)).to_numpy(), (rows["i"] - (int(key[2]) * tile - halo)).to_numpy()
        hole = rows["hole"].to_numpy(bool)
        z, there, free = np.zeros((side, side)), np.zeros((side, side), bool), np.zeros((side, side), bool)
        z[j, i], there[j, i], free[j, i] = rows["z"].to_numpy(), True, hole
        if halo:
            free[[0, -1]], free[:, [0, -1]] = False, False
        solved = solve_window(z, there, free, exact)
        own = hole & (j >= halo) & (j < halo + tile) & (i >= halo) & (i < halo + tile)
        out = rows.loc[own, CELL].copy()
        out["z"] = solved[j[own], i[own]]
        out["change"] = np.abs(solved[j[own], i[own]] - z[j[own], i[own]])
        return out

    key = cells.schema
    return copies.groupBy("place_id", "tj", "ti").applyInPandas(solve, f"place_id {key['place_id'].dataType.simpleString()}, j {key['j'].dataType.simpleString()}, i {key['i'].dataType.simpleString()}, z double, change double")


def block_links(cells: DataFrame, block: int) -> DataFrame:
    """(place_id, bj, bi, nbj, nbi, known, n): how many links go from the hole cells of a block to hole cells of another, or to known cells."""
    at = lambda c: F.floor(F.col(c) / block).cast("int")
    out = _neighbours(cells.filter("hole")).join(cells.select("place_id", F.col("j").alias("nj"), F.col("i").alias("ni"), F.col("hole").alias("_h")), ["place_id", "nj", "ni"])
    rows = out.select("place_id", at("j").alias("bj"), at("i").alias("bi"), at("nj").alias("nbj"), at("ni").alias("nbi"), (~F.col("_h")).alias("known"))
    return rows.filter("known OR bj <> nbj OR bi <> nbi").groupBy("place_id", "bj", "bi", "nbj", "nbi", "known").agg(F.count("*").alias("n"))


def block_residuals(cells: DataFrame, block: int) -> DataFrame:
    """(place_id, bj, bi, r): what the hole cells of a block lack together to be the sums of their neighbours."""
    own = cells.select(*CELL, F.col("z").alias("own"), F.col("hole").alias("hole"), F.lit(None).cast("double").alias("v"))
    sent = _neighbours(cells, "z").select("place_id", F.col("nj").alias("j"), F.col("ni").alias("i"), F.lit(None).cast("double").alias("own"), F.lit(False).alias("hole"), F.col("z").alias("v"))
    cell = own.unionByName(sent).groupBy(*CELL).agg(F.max("own").alias("own"), F.bool_or("hole").alias("hole"), F.sum("v").alias("s"), F.count("v").alias("n")).filter("hole")
    return cell.groupBy("place_id", F.floor(F.col("j") / block).cast("int").alias("bj"), F.floor(F.col("i") / block).cast("int").alias("bi")).agg(
        F.sum(F.coalesce("s", F.lit(0.0)) - F.col("n") * F.col("own")).alias("r"))


def solve_blocks(residuals: DataFrame, links: DataFrame, exact: float) -> DataFrame:
    """(place_id, bj, bi, e): what to add to the cells of each block. One group a place, of at most COARSE squared blocks and their neighbours."""
    none = F.lit(None)
    rows = residuals.select("place_id", "bj", "bi", none.cast("int").alias("nbj"), none.cast("int").alias("nbi"), F.lit(False).alias("known"), F.col("r").alias("v")).unionByName(
        links.select("place_id", "bj", "bi", "nbj", "nbi", "known", F.col("n").cast("double").alias("v")))

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rhs, link = rows[rows["nbj"].isna()], rows[rows["nbj"].notna()]
        number = {k: n for n, k in enumerate(zip(rhs["bj"], rhs["bi"]))}
        size = len(number)
        of = np.array([number[k] for k in zip(link["bj"], link["bi"])], np.int64)
        weight, known = link["v"].to_numpy(float), link["known"].to_numpy(bool)
        to = np.array([-1 if k else number[int(a), int(b)] for a, b, k in zip(link["nbj"], link["nbi"], known)], np.int64)
        degree = np.bincount(of, weight, size)
        free = degree > 0  # a block cut off from all others and from all heights needs no correction
        scale = np.where(free, degree, 1.0)
        a, b, w = of[~known], to[~known], weight[~known]
        e = conjugate_gradients(lambda v: scale * v - np.bincount(a, w * v[b], size), np.where(free, rhs["v"].to_numpy(float), 0.0), np.zeros(size), scale, exact)
        return pd.DataFrame({"place_id": rhs["place_id"].to_numpy(), "bj": rhs["bj"].to_numpy(), "bi": rhs["bi"].to_numpy(), "e": e})

    return rows.groupBy("place_id").applyInPandas(solve, f"place_id {residuals.schema['place_id'].dataType.simpleString()}, bj int, bi int, e double")


def fill_holes(raster: DataFrame, tolerance: float = 1e-4, tile: int = 96, halo: int = 16, rounds: int = 200) -> DataFrame:
    """`raster(place_id, j, i, z)` with its NULL heights filled, and `hole`, true where they were.

    Rounds end when no height moves by more than `tolerance`; RuntimeError where `rounds` don't suffice, rather than unfinished heights. A place without any
    height keeps NULL; a hole cut off from all heights gets the mean of its place."""
    grid = cut_lineage(raster.select(*CELL, "z", F.col("z").isNull().alias("hole")))
    holes = grid.filter("hole").select(*CELL)
    rim = grid.filter("NOT hole").join(_neighbours(holes).select("place_id", F.col("nj").alias("j"), F.col("ni").alias("i")).distinct(), CELL, "left_semi").select(*CELL, "z")
    rim = cut_lineage(rim)
    means = grid.groupBy("place_id").agg(F.avg("z").alias("z")).filter("z IS NOT NULL")
    state = cut_lineage(holes.join(means, "place_id").select(*CELL, "z"))
    tiles = state.select("place_id", F.floor(F.col("j") / tile).alias("tj"), F.floor(F.col("i") / tile).alias("ti")).distinct()
    several = not tiles.groupBy("place_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    span = grid.groupBy("place_id").agg(F.greatest(F.max("j") - F.min("j"), F.max("i") - F.min("i")).alias("s")).agg(F.max("s")).first()[0] or 0
    block = 1
    while (span + block) // block >= COARSE:
        block *= 2
    block = max(block, 4)
    links = None
    for _ in range(rounds):
        both = lambda s: s.select(*CELL, "z", F.lit(True).alias("hole")).unionByName(rim.select(*CELL, "z", F.lit(False).alias("hole")))
        if several:
            links = cut_lineage(block_links(both(state), block)) if links is None else links
            fix = solve_blocks(block_residuals(both(state), block), links, tolerance * 1e-3)
            at = lambda c: F.floor(F.col(c) / block).cast("int")
            state = state.withColumns({"bj": at("j"), "bi": at("i")}).join(fix, ["place_id", "bj", "bi"], "left").select(*CELL, (F.col("z") + F.coalesce("e", F.lit(0.0))).alias("z"))
        solved = cut_lineage(solve_tiles(both(state), tile, halo, tolerance * 1e-6))
        state = solved.select(*CELL, "z")
        if not several or (solved.agg(F.max("change")).first()[0] or 0.0) <= tolerance:
            break
    else:
        raise RuntimeError(f"holes of {span} cells weren't settled after {rounds} rounds")
    filled = state.withColumnRenamed("z", "_z")
    return grid.join(filled, CELL, "left").select(*CELL, F.coalesce("z", "_z").alias("z"), "hole")
