"""Voxel fusion of a stream of points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenvox.operators import fusion


def points_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """Points of the parquet files that appear in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def fused_stream(points: DataFrame, size: float, least: int = 1) -> DataFrame:
    """Voxels of all points seen so far, as ``fusion.voxel_fuse`` gives them.

    The state is one partial sum for each voxel. To be written in complete mode; with ``least`` 1 also in update mode,
    which emits the voxels that a batch has touched.
    """
    placed = fusion.with_voxels(fusion.finite(points), size)
    each = placed.select("vx", "vy", "vz", F.lit(1).cast("long").alias("n"), *[F.col(c).alias(f"s{c}") for c in ("x", "y", "z", "r", "g", "b")])
    return fusion.fused(each, least)
