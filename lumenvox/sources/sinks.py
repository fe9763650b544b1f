"""Results as files: partitioned points, JSON records and the text tables of a sparse reconstruction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_points(points: DataFrame, path: str, by: str = "frame") -> None:
    """All points in one table, partitioned by frame; each frame's rows come from one task."""
    points.repartition(by).write.partitionBy(by).mode("overwrite").parquet(path)


def write_records(records: DataFrame, path: str, order: str) -> None:
    """One JSON object a line in the order of a column (poses, capture modes, intrinsics)."""
    records.orderBy(order).write.mode("overwrite").json(path)


def image_lines(images: DataFrame) -> DataFrame:
    """Lines of images.txt: id, quaternion (w first), translation, camera and name; no points of the image."""
    numbers = [F.format_string("%.9f", c) for c in ("qw", "qx", "qy", "qz", "tx", "ty", "tz")]
    line = F.concat_ws(" ", F.col("image_id").cast("string"), *numbers, F.col("camera_id").cast("string"), "name")
    return images.select("image_id", F.concat(line, F.lit("\n")).alias("value"))


def camera_lines(cameras: DataFrame) -> DataFrame:
    """Lines of cameras.txt: id, model, width, height and parameters."""
    params = F.array_join(F.transform("params", lambda p: F.format_string("%.9f", p)), " ")
    return cameras.select("camera_id", F.concat_ws(" ", F.col("camera_id").cast("string"), "model", F.col("w").cast("string"), F.col("h").cast("string"), params).alias("value"))


def write_reconstruction(images: DataFrame, cameras: DataFrame, path: str) -> None:
    """cameras and images as text in the order of their ids."""
    camera_lines(cameras).orderBy("camera_id").select("value").write.mode("overwrite").text(f"{path}/cameras")
    image_lines(images).orderBy("image_id").select("value").write.mode("overwrite").text(f"{path}/images")
