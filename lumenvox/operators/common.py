"""Cutting lineage in loops, and files that executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset a temporary one, but only for a local master."""
    if base := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(base := tempfile.mkdtemp(prefix="lumenvox-checkpoint-"))
    return base


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a table in the shared folder, with its lineage cut.

    checkpoint() hands on the estimated sizes of a plan, so that in a loop the estimates of joins multiply from round to
    round; a table leaves the optimizer with the size of its files.
    """
    path = shared_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
