"""Scene-capture tables derived from the given parquet tables.

``points``, ``tiles``, ``path``, ``headings``, ``anchors``, ``links``, ``cells`` and ``poses`` bind the
data model (point clouds, depth rasters, trajectories, yaw sequences, navigation graph, camera poses)
to columns of ``embeddings`` and ``events``. Invalid depth is null, never NaN.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenvox.functions.angles import wrap

TILE = 8
LINK_REACH = 0.1
CELL = 0.2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def at(i: int) -> Column:
    """Element ``i`` (from 0) of an embedding as a double."""
    return F.col("embedding")[i].cast("double")


def colour(i: int) -> Column:
    """An element near zero as a colour of 0 to 255, rounded half to even."""
    return F.least(F.greatest(F.bround((at(i) + 0.5) * 255), F.lit(0.0)), F.lit(255.0)).cast("int")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, view, x, y, z, r, g, b."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").alias("view"), at(0).alias("x"), at(1).alias("y"), at(2).alias("z"), colour(3).alias("r"), colour(4).alias("g"), colour(5).alias("b")
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, u, v, depth, value of 8 x 8 rasters; depth is null where it is not positive, value is the grey level."""
    pixels = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("i", "value"))
    depth = 1 + 4 * F.col("value").cast("double")
    return pixels.select("vec_id", "label", (F.col("i") % TILE).alias("u"), F.expr(f"int(i div {TILE})").alias("v"), F.when(depth > 0, depth).alias("depth"), F.col("value").cast("double").alias("value"))


MOSAIC = 64


def mosaics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """view, u, v, depth, value of dense 64 x 64 rasters of 64 tiles each; where tiles lack, depth is null and value 0."""
    side = MOSAIC // TILE
    nth = F.col("vec_id") % (side * side)
    placed = tiles(spark, sf_dir).select(F.expr(f"vec_id div {side * side}").alias("view"), ((nth % side) * TILE + F.col("u")).alias("u"), (F.floor(nth / side) * TILE + F.col("v")).alias("v"), "depth", "value")
    grid = spark.range(MOSAIC * MOSAIC).select((F.col("id") % MOSAIC).alias("u"), F.floor(F.col("id") / MOSAIC).alias("v"))
    whole = placed.select("view").distinct().join(F.broadcast(grid))  # each raster's pixels
    return whole.join(placed, ["view", "u", "v"], "left").select("view", "u", "v", "depth", F.coalesce("value", F.lit(0.0)).alias("value"))


def path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path_id, seq, vec_id, x, y, z: the points of a view in order."""
    from pyspark.sql import Window

    order = Window.partitionBy("view").orderBy("vec_id")
    return points(spark, sf_dir).select(F.col("view").alias("path_id"), (F.row_number().over(order) - 1).cast("long").alias("seq"), "vec_id", "x", "y", "z")


def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, seq, yaw: a heading sequence for each user in the order of events."""
    from pyspark.sql import Window

    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    turn = F.col("value") * math.pi / 50
    return table(spark, sf_dir, "events").select("user_id", (F.row_number().over(order) - 1).cast("long").alias("seq"), wrap(turn).alias("yaw"))


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """anchor_id, x, y, z."""
    return points(spark, sf_dir).filter("vec_id % 25 = 0").select(F.col("vec_id").alias("anchor_id"), "x", "y", "z")


def links(spark: SparkSession, sf_dir: str, reach: float = LINK_REACH, within: str | None = None) -> DataFrame:
    """src, dst, w of points within ``reach``, in both directions; only those that are equal in a column ``within``, which comes first then.

    Found by a grid of cells of that size: a point meets the points of its own and the neighbouring
    cells in an equi join, never all points.
    """
    same = [within] if within else []
    cells = points(spark, sf_dir).select("vec_id", *same, "x", "y", "z", *[F.floor(F.col(c) / reach).cast("long").alias(f"c{c}") for c in "xyz"])
    step = F.array(*[F.lit(i).cast("long") for i in (-1, 0, 1)])
    near = cells
    for c in "xyz":
        near = near.withColumn(f"d{c}", F.explode(step)).withColumn(f"c{c}", F.col(f"c{c}") + F.col(f"d{c}")).drop(f"d{c}")
    a = near.select(*same, F.col("vec_id").alias("src"), *[F.col(c).alias(f"s{c}") for c in "xyz"], "cx", "cy", "cz")
    b = cells.select(*same, F.col("vec_id").alias("dst"), "x", "y", "z", "cx", "cy", "cz")
    w = F.sqrt((F.col("sx") - F.col("x")) ** 2 + (F.col("sy") - F.col("y")) ** 2 + (F.col("sz") - F.col("z")) ** 2)
    return a.join(b, [*same, "cx", "cy", "cz"]).filter("src <> dst").select(*same, "src", "dst", w.alias("w")).filter(F.col("w") <= reach)


def cells(spark: SparkSession, sf_dir: str, size: float = CELL) -> DataFrame:
    """cx, cz: occupied cells of the walkable plane."""
    return points(spark, sf_dir).select(F.floor(F.col("x") / size).cast("long").alias("cx"), F.floor(F.col("z") / size).cast("long").alias("cz")).distinct()


def poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """frame, q1..q4 (unit quaternion x, y, z, w), tx, ty, tz."""
    raw = table(spark, sf_dir, "embeddings").select("vec_id", *[at(i + 6).alias(f"p{i + 1}") for i in range(4)], at(0).alias("tx"), at(1).alias("ty"), at(2).alias("tz"))
    norm = F.sqrt(sum((F.col(f"p{i}") * F.col(f"p{i}") for i in (2, 3, 4)), F.col("p1") * F.col("p1")))
    unit = raw.withColumn("norm", norm)
    return unit.select(F.col("vec_id").alias("frame"), *[F.when(F.col("norm") > 0, F.col(f"p{i}") / F.col("norm")).otherwise(0.0).alias(f"q{i}") for i in (1, 2, 3, 4)], "tx", "ty", "tz")
