"""Colour maps as tables of 256 levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEVELS = 256
# The stops of the diverging map "Spectral", from 0 to 1.
SPECTRAL = ((158, 1, 66), (213, 62, 79), (244, 109, 67), (253, 174, 97), (254, 224, 139), (255, 255, 191), (230, 245, 152), (171, 221, 164), (102, 194, 165), (50, 136, 189), (94, 79, 162))


def colour_table(spark: SparkSession, stops: tuple[tuple[int, int, int], ...] = SPECTRAL) -> DataFrame:
    """level (0 to 255), r, g, b: the map between its stops, rounded down."""
    at = F.col("level") * (len(stops) - 1) / (LEVELS - 1)
    left = F.least(F.floor(at), F.lit(len(stops) - 2)).cast("int")

    def channel(k: int) -> Column:
        values = F.array(*[F.lit(float(s[k])) for s in stops])
        a, b = F.get(values, left), F.get(values, left + 1)
        return F.floor(a + (b - a) * (at - left) + 1e-6).cast("int")

    levels = spark.range(LEVELS).select(F.col("id").cast("int").alias("level"))
    return levels.select("level", *[channel(k).alias(c) for k, c in enumerate("rgb")])


def level_of(value: Column) -> Column:
    """The level of a value of 0 to 1; values outside take the first or last one, null stays null."""
    return F.least(F.greatest(F.floor(value * LEVELS), F.lit(0)), F.lit(LEVELS - 1)).cast("int")


def coloured(df: DataFrame, value: Column, stops: tuple[tuple[int, int, int], ...] = SPECTRAL) -> DataFrame:
    """Adds r, g, b of ``value``, 0 where it is null, by a join with the table of levels (256 rows)."""
    table = colour_table(df.sparkSession, stops).withColumnRenamed("level", "_level")
    found = df.withColumn("_at", level_of(value)).join(F.broadcast(table), F.col("_at") == F.col("_level"), "left")
    return found.drop("_at", "_level").fillna(0, ["r", "g", "b"])
