"""Shared helpers: written intermediate tables, clash-free column names, skew-safe lookups."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that hold at least 1/HEAVY_SHARE of a weight are looked up by broadcast; there are at most HEAVY_SHARE of them.
HEAVY_SHARE = 1000
#: Keys that are broadcast to pick rows of a table, at most; with more the table is shuffled.
FEW_KEYS = 200_000


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Where it is unset a temporary folder serves, but only for a local master.
    """
    if base := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="lumenvox-checkpoint-")
    spark.sparkContext.setCheckpointDir(base)
    return base


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a table in the shared folder, with its lineage cut.

    Unlike checkpoint(), which hands the estimated sizes of a plan on, so that the estimates of joins multiply from round
    to round, this leaves the optimizer with the size of the files.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete what was written below ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of tables that are written by now; it does so for what the driver has forgotten."""
    gc.collect()
    spark._jvm.System.gc()


#: Shuffle files go with the job that wrote them, not when the driver happens to forget it; for steps that write what they use again.
SWEPT = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold for a while."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class Bucketed:
    """Tables bucketed by a column, in the shared folder, for as long as they are needed."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.tables = spark, {}

    def keep(self, df: DataFrame, buckets: int, column: str, compression: str = "snappy") -> DataFrame:
        release(self.spark)
        name = f"lumenvox_{uuid.uuid4().hex}"
        self.tables[name] = scratch_path(self.spark, "bucketed")
        df.write.bucketBy(buckets, column).format("parquet").option("compression", compression).option("path", self.tables[name]).saveAsTable(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name, path in self.tables.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            discard(self.spark, path)


def text_of(column: str = "text") -> Column:
    """A text column, null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lookup(left: DataFrame, key: str, right: DataFrame, weight: str, spread: Column) -> DataFrame:
    """Left join of ``left`` with ``right`` on the equally named ``key``, safe for hot keys.

    ``right`` has one row for each key, already cut, with the number of left rows that hold the
    key in ``weight``. Keys with at least 1/HEAVY_SHARE of all rows go by broadcast (at most
    HEAVY_SHARE rows, whatever the input); the others go by an ordinary join in which no key
    is large. ``spread`` is an expression over ``left`` that deals rows out evenly; rows
    served by the broadcast side follow it instead of their key. ``weight`` is kept.
    """
    total = right.agg(F.sum(weight)).first()[0] or 0
    values = [c for c in right.columns if c != key]
    heavy = right.filter(F.col(weight) * HEAVY_SHARE >= F.lit(total))
    if heavy.isEmpty():
        return left.join(right, key, "left")
    light = right.filter(F.col(weight) * HEAVY_SHARE < F.lit(total))
    kept = left.columns
    found = left.join(
        F.broadcast(heavy.select(F.col(key), F.lit(True).alias("_hot"), *[F.col(c).alias(f"_h_{c}") for c in values])), key, "left"
    )
    found = found.withColumn("_salt", F.when(F.col("_hot"), F.pmod(spread, F.lit(1 << 20))).otherwise(F.lit(-1)))
    light = light.select(F.col(key).alias("_k"), F.lit(-1).cast("long").alias("_s"), *[F.col(c).alias(f"_l_{c}") for c in values])
    joined = found.join(light, (F.col(key) == F.col("_k")) & (F.col("_salt").cast("long") == F.col("_s")), "left")
    return joined.select(*kept, *[F.coalesce(f"_h_{c}", f"_l_{c}").alias(c) for c in values])


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that gives freed memory back to the system at its end.

    Spark reuses Python workers, so what a task has freed but the allocator keeps would count against the stages after it.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)
