"""Files: PLY clouds, JSON records, partitioned points, reconstruction text, manifests."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from lumenvox.operators import graph
from lumenvox.sources import ply, scenes, sinks


def test_ply_round_trip_clips_colours(spark, tmp_path):
    df = spark.createDataFrame([(1.5, -2.0, 0.25, 300, -4, None), (0.0, 0.0, 1.0, 1, 2, 3)], "x double, y double, z double, red int, green int, blue int")
    ply.write_ply(df.repartition(2), str(tmp_path / "cloud"))
    found = sorted((r.x, r.red, r.green, r.blue) for r in ply.read_ply(spark, str(tmp_path / "cloud")).collect())
    assert found == [(0.0, 1, 2, 3), (1.5, 255, 0, 0)]


def test_ply_without_colours_and_ascii(spark, tmp_path):
    ply.write_ply(spark.createDataFrame([(1.0, 2.0, 3.0)], "x double, y double, z double"), str(tmp_path / "plain"))
    assert [(r.x, r.red) for r in ply.read_ply(spark, str(tmp_path / "plain"), missing=200).collect()] == [(1.0, 200)]
    (tmp_path / "text").mkdir()
    (tmp_path / "text/a.ply").write_text("ply\nformat ascii 1.0\ncomment c\nelement vertex 2\nproperty float x\nproperty float y\nproperty float z\nproperty uchar red\nproperty uchar green\nproperty uchar blue\nend_header\n0 1 2 3 4 5\n6 7 8 9 10 11\n")
    assert sorted((r.z, r.blue) for r in ply.read_ply(spark, str(tmp_path / "text")).collect()) == [(2.0, 5), (8.0, 11)]
    (tmp_path / "none").mkdir()
    assert ply.read_ply(spark, str(tmp_path / "none")).count() == 0


def test_points_and_records(spark, tmp_path):
    df = spark.createDataFrame([(f, float(i)) for f in range(3) for i in range(4)], "frame int, x double")
    sinks.write_points(df, str(tmp_path / "points"))
    assert spark.read.parquet(str(tmp_path / "points")).filter("frame = 1").count() == 4
    sinks.write_records(df.select("frame").distinct(), str(tmp_path / "poses"), "frame")
    lines = [json.loads(x) for p in sorted(Path(tmp_path / "poses").glob("*.json")) for x in p.read_text().splitlines()]
    assert [x["frame"] for x in lines] == [0, 1, 2]


def test_reconstruction_text(spark, tmp_path):
    images = spark.createDataFrame([(2, 1, "b.png", 1.0, 0.0, 0.0, 0.0, 1.0, 2.0, 3.0), (1, 1, "a.png", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)], "image_id long, camera_id int, name string, qw double, qx double, qy double, qz double, tx double, ty double, tz double")
    cameras = spark.createDataFrame([(1, "PINHOLE", 8, 6, [4.0, 4.0, 4.0, 3.0])], "camera_id int, model string, w int, h int, params array<double>")
    sinks.write_reconstruction(images, cameras, str(tmp_path / "rec"))
    text = "".join(p.read_text() for p in sorted(Path(tmp_path / "rec/images").glob("*.txt")))
    assert text.index("a.png") < text.index("b.png") and text.startswith("1 1.000000000 ")
    assert (tmp_path / "rec/cameras").exists()


def test_manifest(spark):
    manifest, done = (spark.createDataFrame([(s,) for s in x], "scene string") for x in ("abc", "b"))
    assert sorted(r.scene for r in scenes.not_done(manifest, done, "scene").collect()) == ["a", "c"]
    assert spark.range(1).select(scenes.preferred(F.lit(None).cast("string"), F.lit("full")).alias("p")).first().p == "full"


def test_anchor_selection_adapts(spark):
    line = [(0, i, 0.0, 1.0, i, i in (0, 9), True, None) for i in range(10)] + [(1, 0, 0.0, None, 0, True, True, None)]
    df = spark.createDataFrame(line, "k int, id long, y double, clear double, draw long, anchor boolean, fits boolean, direct double")
    links = spark.createDataFrame([(0, a, b, 1.0) for i in range(9) for a, b in ((i, i + 1), (i + 1, i))], "k int, src long, dst long, w double")
    found = graph.spread_anchors(df, links, "k", 4, 5.0).collect()
    # the separation shrinks until the fourth point fits, and is small before a fourth anchor does
    assert [r.id for r in sorted(found, key=lambda r: r.ord) if r.k == 0] == [0, 9, 4]
    assert [r.id for r in found if r.k == 1] == [0]
    gaps = sorted(graph.gap_anchors(df, links, "k", 6.0).collect(), key=lambda r: r.ord)
    assert [(r.id, r.radius) for r in gaps] == [(4, 3.5999999999999996)]
