"""Holes of a raster against plain relaxation, over one tile and over many."""
import numpy as np

from placeloom.operators import multigrid, raster


def table(spark, z, place=1):
    rows = [(place, j, i, None if np.isnan(z[j, i]) else float(z[j, i])) for j in range(z.shape[0]) for i in range(z.shape[1])]
    return spark.createDataFrame(rows, "place_id long, j int, i int, z double")


def relaxed(z, rounds=20000):
    """Every hole the mean of its neighbours, edge values repeated outside, again and again."""
    hole, out = np.isnan(z), np.where(np.isnan(z), np.nanmean(z), z)
    for _ in range(rounds):
        p = np.pad(out, 1, mode="edge")
        new = (p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:]) / 4
        moved = np.abs(new - out)[hole].max()
        out = np.where(hole, new, out)
        if moved < 1e-10:
            break
    return out


def ground(n, seed, *boxes):
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[0:n, 0:n]
    z = 30 * np.sin(x / 7) + y + rng.normal(0, 2, (n, n))
    for j0, j1, i0, i1 in boxes:
        z[j0:j1, i0:i1] = np.nan
    return z


def heights(df, n):
    out = np.full((n, n), np.nan)
    for r in df.collect():
        out[r.j, r.i] = np.nan if r.z is None else r.z
    return out


def test_one_tile_equals_relaxation(spark):
    z = ground(30, 1, (4, 26, 5, 27), (0, 3, 0, 9), (28, 30, 29, 30))
    assert np.abs(heights(raster.raster_mask_fill(table(spark, z)), 30) - relaxed(z)).max() < 1e-6


def test_wide_hole_over_many_tiles(spark):
    z = ground(26, 2, (2, 24, 3, 26))
    got = heights(multigrid.fill_holes(table(spark, z), 1e-4, 12, 4), 26)
    p = np.pad(got, 1, mode="edge")
    residual = np.abs((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:]) / 4 - got)[np.isnan(z)].max()
    assert residual < 1e-3 and np.abs(got - relaxed(z)).max() < 2e-3 and (got[~np.isnan(z)] == z[~np.isnan(z)]).all()


def test_places_without_heights_and_cut_off_holes(spark):
    empty = table(spark, np.full((3, 3), np.nan), 7)
    island = spark.createDataFrame([(8, 0, 0, 4.0), (8, 0, 1, 6.0), (8, 9, 9, None), (8, 9, 10, None)], "place_id long, j int, i int, z double")
    rows = raster.raster_mask_fill(empty.unionByName(island).unionByName(table(spark, ground(4, 3), 9))).collect()
    assert all(r.z is None and r.hole for r in rows if r.place_id == 7) and len(rows) == 9 + 4 + 16
    assert sorted(r.z for r in rows if r.place_id == 8) == [4.0, 5.0, 5.0, 6.0]
    assert raster.raster_mask_fill(empty.filter("false")).count() == 0
