"""Folders of frame files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def frame_files(spark: SparkSession, folder: str, pattern: str, most: int | None = None) -> DataFrame:
    """file, frame, bytes of the files below ``folder`` whose path has ``pattern``; its first group is the frame.

    Files come in the order of their paths. Empty files and paths without a frame are skipped; ``most``
    keeps so many of the first ones. Contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    frames = files.select("file", F.regexp_extract("file", pattern, 1).alias("frame"), "bytes").filter("frame <> '' and bytes > 0")
    frames = frames.withColumn("frame", F.col("frame").cast("long"))
    if most is None:
        return frames
    return frames.orderBy("file").limit(most)
