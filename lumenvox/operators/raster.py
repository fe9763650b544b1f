"""Operators over depth rasters in long form (one row a pixel: key, u, v, depth)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenvox.functions.geometry import cross, norm, unproject

#: Defaults of the quality gates.
LEAST_SAMPLES, LEAST_MEAN_DEPTH, LEAST_NORMALS = 500, 0.9, 1000


def valid(depth: Column) -> Column:
    return F.coalesce(depth.isNotNull() & ~F.isnan(depth) & (depth > 0), F.lit(False))


def min_pool(tiles: DataFrame, key: str, s: int, width: int, height: int) -> DataFrame:
    """Smallest valid depth of each s x s block; rows and columns beyond whole blocks are left out."""
    inside = tiles.filter((F.col("u") < width // s * s) & (F.col("v") < height // s * s))
    block = [F.expr(f"int({c} div {s})").alias(c) for c in ("u", "v")]
    return inside.select(key, *block, "depth").groupBy(key, "u", "v").agg(F.min(F.when(valid(F.col("depth")), F.col("depth"))).alias("depth"))


def area_pool(tiles: DataFrame, key: str, s: int, value: str) -> DataFrame:
    """Mean of each s x s block."""
    block = [F.expr(f"int({c} div {s})").alias(c) for c in ("u", "v")]
    return tiles.select(key, *block, value).groupBy(key, "u", "v").agg(F.avg(value).alias(value))


def _gradient(value: Column, along: Window, first: Column, last: Column) -> Column:
    """Central differences inside, one-sided ones at both ends."""
    after, before = F.lead(value).over(along), F.lag(value).over(along)
    return F.when(first, after - value).when(last, value - before).otherwise((after - before) / 2)


def normals(tiles: DataFrame, key: str, width: int, height: int, f: float, cx: float, cy: float) -> DataFrame:
    """Unit normals by finite differences of unprojected pixels: key, u, v, nx, ny, nz; null next to invalid depth.

    Both windows are within one raster, so the table is dealt out by ``key`` once.
    """
    x, y, z = unproject(F.col("u"), F.col("v"), F.col("depth"), F.lit(f), F.lit(f), F.lit(cx), F.lit(cy))
    df = tiles.select(key, "u", "v", x.alias("x"), y.alias("y"), z.alias("z")).repartition(key)
    row, column = Window.partitionBy(key, "v").orderBy("u"), Window.partitionBy(key, "u").orderBy("v")
    u0, u1, v0, v1 = F.col("u") == 0, F.col("u") == width - 1, F.col("v") == 0, F.col("v") == height - 1
    df = df.withColumns({f"{c}u": _gradient(F.col(c), row, u0, u1) for c in "xyz"}).withColumns({f"{c}v": _gradient(F.col(c), column, v0, v1) for c in "xyz"})
    n = cross(tuple(F.col(f"{c}u") for c in "xyz"), tuple(F.col(f"{c}v") for c in "xyz"))
    length = norm(n) + 1e-6
    return df.select(key, "u", "v", *[(c / length).alias(name) for c, name in zip(n, ("nx", "ny", "nz"), strict=True)])


def normal_dispersion(found: DataFrame, key: str, least: int = LEAST_NORMALS) -> DataFrame:
    """1 minus the length of the mean unit normal of each raster, 0 with fewer than ``least`` normals."""
    n = tuple(F.col(c) for c in ("nx", "ny", "nz"))
    length = norm(n) + 1e-6
    sums = found.groupBy(key).agg(F.count("nx").alias("n"), *[F.avg(c / length).alias(name) for c, name in zip(n, ("mx", "my", "mz"), strict=True)])
    mean = norm((F.col("mx"), F.col("my"), F.col("mz")))
    return sums.select(key, F.when(F.col("n") < least, F.lit(0.0)).otherwise(1 - mean).alias("disp"))


def depth_stats(tiles: DataFrame, key: str) -> DataFrame:
    """valid_frac (of all pixels), n_valid, mean and population standard deviation of valid depth."""
    d = F.when(valid(F.col("depth")), F.col("depth"))
    return tiles.groupBy(key).agg((F.count(d) / F.count("*")).alias("valid_frac"), F.count(d).alias("n_valid"), F.avg(d).alias("mean"), F.stddev_pop(d).alias("std"))


def sobel_strength(tiles: DataFrame, key: str, value: str) -> DataFrame:
    """Mean, over the pixels with valid depth, of the absolute Sobel responses of ``value`` in both directions; borders are mirrored."""
    row, column = Window.partitionBy(key, "v").orderBy("u"), Window.partitionBy(key, "u").orderBy("v")

    def around(c: str, w) -> tuple[Column, Column]:
        before, after = F.lag(c).over(w), F.lead(c).over(w)
        return F.coalesce(before, after), F.coalesce(after, before)

    df = tiles.select(key, "u", "v", F.col(value).alias("s"), valid(F.col("depth")).alias("valid")).repartition(key)
    left, right = around("s", row)
    df = df.withColumns({"across": right - left, "along": left + 2 * F.col("s") + right})
    up, down = around("across", column)
    top, bottom = around("along", column)
    gx, gy = up + 2 * F.col("across") + down, bottom - top
    strength = F.when(F.col("valid"), F.abs(gx) + F.abs(gy))
    return df.select(key, strength.alias("grad")).groupBy(key).agg(F.coalesce(F.avg("grad"), F.lit(0.0)).alias("grad_mean"))


def openness(tiles: DataFrame, key: str, width: int, share: float) -> DataFrame:
    """Median valid depth of the central stripe, weighed by its valid share; 0 without valid depth."""
    stripe = max(4, round(share * width))
    first = max(0, width // 2 - stripe // 2)
    middle = tiles.filter((F.col("u") >= first) & (F.col("u") < first + stripe))
    d = F.when(valid(F.col("depth")), F.col("depth"))
    stats = middle.groupBy(key).agg(F.percentile(d, F.lit(0.5)).alias("median"), (F.count(d) / F.count("*")).alias("share"))
    return stats.select(key, F.coalesce(F.col("median") * (0.5 + 0.5 * F.col("share")), F.lit(0.0)).alias("score"))


#: The ring of a corner test, clockwise from the top, and how many of its pixels in a row have to differ.
RING = ((0, -3), (1, -3), (2, -2), (3, -1), (3, 0), (3, 1), (2, 2), (1, 3), (0, 3), (-1, 3), (-2, 2), (-3, 1), (-3, 0), (-3, -1), (-2, -2), (-1, -3))
ARC, MOST_KEYPOINTS = 9, 2000


def corner_scores(tiles: DataFrame, key: str, value: str) -> DataFrame:
    """key, u, v, score: the largest difference by which ARC pixels in a row of the ring around a pixel are all brighter, or all darker, than it.

    Rasters are dense. Pixels within three of the border have no whole ring and no row. Rows of the ring come from one window along
    each row and one along each column, both within a raster, so the table is dealt out by ``key`` once.
    """
    row, column = Window.partitionBy(key, "v").orderBy("u"), Window.partitionBy(key, "u").orderBy("v")
    moved = lambda c, by, w: F.col(c) if by == 0 else F.lead(c, by).over(w) if by > 0 else F.lag(c, -by).over(w)
    df = tiles.select(key, "u", "v", F.col(value).cast("double").alias("s0")).repartition(key)
    df = df.withColumns({f"s{du}": moved("s0", du, row) for du in range(-3, 4) if du})
    ring = {f"r{i}": moved(f"s{du}", dv, column) - F.col("s0") for i, (du, dv) in enumerate(RING)}
    df = df.select(key, "u", "v", *[c.alias(n) for n, c in ring.items()])
    df = df.filter(F.coalesce(*[F.when(F.col(n).isNull(), F.lit(False)) for n in ring], F.lit(True)))
    arcs = [[F.col(f"r{(i + k) % len(RING)}") for k in range(ARC)] for i in range(len(RING))]
    return df.select(key, "u", "v", F.greatest(*[F.least(*a) for a in arcs], *[-F.greatest(*a) for a in arcs]).alias("score"))


def corners(tiles: DataFrame, key: str, value: str, threshold: float, most: int = MOST_KEYPOINTS) -> DataFrame:
    """Keypoints: key, u, v, score of the pixels with a score above ``threshold`` and above those of all eight neighbours.

    Of a raster with more than ``most`` the best ones, on ties those further up and left.
    """
    row, column = Window.partitionBy(key, "v").orderBy("u"), Window.partitionBy(key, "u").orderBy("v")
    df = corner_scores(tiles, key, value).withColumn("c", F.when(F.col("score") > threshold, F.col("score")).otherwise(F.lit(0.0)))
    df = df.withColumns({"left": F.lag("c").over(row), "right": F.lead("c").over(row)})
    sides = F.greatest(F.coalesce("left", F.lit(0.0)), F.coalesce("right", F.lit(0.0)))
    df = df.withColumn("sides", sides).withColumn("three", F.greatest("c", "sides"))
    best = F.greatest("sides", F.coalesce(F.lag("three").over(column), F.lit(0.0)), F.coalesce(F.lead("three").over(column), F.lit(0.0)))
    df = df.withColumn("best", best).filter((F.col("c") > 0) & (F.col("c") > F.col("best")))
    ranked = df.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "v", "u")))
    return ranked.filter(F.col("nth") <= most).select(key, "u", "v", "score")


def keypoint_stats(found: DataFrame, rasters: DataFrame, key: str, width: int, height: int, nx: int, ny: int, least: int) -> DataFrame:
    """key, n_keypoints and thin_cells, the cells of an nx x ny grid with fewer than ``least`` of them, for every key of ``rasters``."""
    cell = F.floor(F.col("v") * ny / height) * nx + F.floor(F.col("u") * nx / width)
    counts = found.groupBy(key, cell.alias("cell")).agg(F.count("*").alias("n"))
    sums = counts.groupBy(key).agg(F.sum("n").alias("n"), F.count_if(F.col("n") >= least).alias("full"))
    whole = rasters.select(key).distinct().join(sums, key, "left")
    return whole.select(key, F.coalesce("n", F.lit(0)).alias("n_keypoints"), (F.lit(nx * ny) - F.coalesce("full", F.lit(0))).alias("thin_cells"))


def view_gate(tiles: DataFrame, key: str, s: int, width: int, height: int, f: float, limits: dict[str, float], threshold: float, grid: tuple[int, int] = (4, 4), least: int = 5, least_normals: int = LEAST_NORMALS) -> DataFrame:
    """The whole gate of a rendered view: its numbers and ``reason``, the first gate of ``limits`` that it fails, null if it passes.

    ``tiles`` has key, u, v, depth and value of dense rasters. Depth is pooled by the smallest, value by the mean of s x s blocks; normals, gradient
    and keypoints are those of the pooled rasters. Intrinsics are those of a centred camera.
    """
    w, h = width // s, height // s
    values = area_pool(tiles, key, s, "value").filter((F.col("u") < w) & (F.col("v") < h))
    small = min_pool(tiles, key, s, width, height).join(values, [key, "u", "v"]).repartition(key)
    found = normals(small, key, w, h, f, w / 2, h / 2)
    points = keypoint_stats(corners(small, key, "value", threshold), small, key, w, h, *grid, least)
    stats = depth_stats(small, key).join(normal_dispersion(found, key, least_normals), key).join(sobel_strength(small, key, "value"), key).join(points, key)
    exact = stats.withColumns({c: F.round(c, 9) for c in ("valid_frac", "mean", "std", "disp", "grad_mean")})
    return exact.withColumn("reason", first_failure(exact, limits))


def first_failure(stats: DataFrame, limits: dict[str, float]) -> Column:
    """Name of the first quality gate that a view fails, null if it passes all. Equality passes.

    Gates with a limit apply, in order: valid_frac, samples, mean_depth, rel_std, dispersion,
    gradient, keypoints, cells (the number of thin cells at most).
    """
    spread = F.col("std") / F.greatest(F.col("mean"), F.lit(1e-6)) if "std" in stats.columns else None
    checks = {
        "valid_frac": lambda m: F.col("valid_frac") < m,
        "samples": lambda m: F.col("n_valid") < m,
        "mean_depth": lambda m: F.coalesce(F.col("mean"), F.lit(0.0)) < m,
        "rel_std": lambda m: F.coalesce(spread, F.lit(0.0)) < m,
        "dispersion": lambda m: F.col("disp") < m,
        "gradient": lambda m: F.col("grad_mean") < m,
        "keypoints": lambda m: F.col("n_keypoints") < m,
        "cells": lambda m: F.col("thin_cells") > m,
    }
    reason = None
    for name, check in checks.items():
        if name in limits:
            reason = F.when(check(limits[name]), F.lit(name)) if reason is None else reason.when(check(limits[name]), F.lit(name))
    return reason if reason is not None else F.lit(None).cast("string")


def grid_counts(df: DataFrame, x: Column, y: Column, nx: int, ny: int) -> DataFrame:
    """n of every cell of an nx x ny grid over the unit square, empty cells included: gx, gy, n."""
    place = lambda c, n: F.least(F.lit(n - 1), F.greatest(F.lit(0), F.floor(c * n))).cast("int")
    counted = df.select(place(x, nx).alias("gx"), place(y, ny).alias("gy")).groupBy("gx", "gy").agg(F.count("*").alias("n"))
    spark = df.sparkSession
    grid = spark.range(nx * ny).select((F.col("id") % nx).cast("int").alias("gx"), F.floor(F.col("id") / nx).cast("int").alias("gy"))
    return grid.join(counted, ["gx", "gy"], "left").fillna(0, ["n"])
