"""Voxel fusion of point clouds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A packed voxel key has 21 bits for each axis, shifted by half of their range.
KEY_BITS, KEY_SHIFT = 21, 1 << 20
AXES = ("x", "y", "z")


def finite(df: DataFrame, columns: tuple[str, ...] = AXES) -> DataFrame:
    """Rows whose ``columns`` are all finite numbers."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return df.filter(keep)


def cell(value: Column, size: float) -> Column:
    return F.floor(value / size).cast("long")


def with_voxels(points: DataFrame, size: float) -> DataFrame:
    return points.select("*", *[cell(F.col(c), size).alias(f"v{c}") for c in AXES])


def fused(partials: DataFrame, least: int) -> DataFrame:
    """Centroid and mean colour of each voxel from sums; the support counts over all views."""
    total = partials.groupBy("vx", "vy", "vz").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sz", "sr", "sg", "sb")])
    mean = lambda c: F.col(c) / F.col("n")
    channel = lambda c: F.least(F.greatest(F.bround(mean(c)), F.lit(0.0)), F.lit(255.0)).cast("int")
    return total.filter(F.col("n") >= least).select(
        "vx", "vy", "vz", "n", *[mean(f"s{c}").alias(f"c{c}") for c in AXES], *[channel(f"s{c}").alias(c) for c in "rgb"]
    )


def _sums(points: DataFrame, *keys: str) -> DataFrame:
    return points.groupBy(*keys, "vx", "vy", "vz").agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s{c}") for c in ("x", "y", "z", "r", "g", "b")])


def voxel_fuse(points: DataFrame, size: float, least: int = 3) -> DataFrame:
    """One row for each voxel with at least ``least`` finite points: vx, vy, vz, n, cx, cy, cz, r, g, b."""
    return fused(_sums(with_voxels(finite(points), size)), least)


def voxel_fuse_by_view(points: DataFrame, size: float, least: int = 3) -> DataFrame:
    """The same from sums of each view, as views arrive one by one."""
    return fused(_sums(with_voxels(finite(points), size), "view"), least)


def packed_key(vx: Column, vy: Column, vz: Column) -> Column:
    """One long for a voxel; an axis outside of its 21 bits is an error."""
    parts = [v + KEY_SHIFT for v in (vx, vy, vz)]
    inside = F.lit(True)
    for p in parts:
        inside = inside & (p >= 0) & (p < (1 << KEY_BITS))
    code = F.shiftleft(parts[0], 2 * KEY_BITS).bitwiseOR(F.shiftleft(parts[1], KEY_BITS)).bitwiseOR(parts[2])
    return F.when(inside, code).otherwise(F.raise_error(F.lit("voxel index out of range")).cast("long"))


def with_colours(points: DataFrame, colours: DataFrame, keys: list[str], missing: int = 0) -> DataFrame:
    """Points with the colour of their pixel, ``missing`` where there is none."""
    return points.join(colours, keys, "left").fillna(missing, ["r", "g", "b"])
