"""Queries over point clouds, depth rasters, poses and visual geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenvox.functions import colours
from lumenvox.functions import geometry as G
from lumenvox.functions.angles import blend, wrap
from lumenvox.functions.draws import normal_draw
from lumenvox.operators import fusion, raster
from lumenvox.plans import sql
from lumenvox.plans.common import rounded, rounding
from lumenvox.sources import tables

VOXEL = 0.1


def _compared(df: DataFrame) -> DataFrame:
    return df.select("vx", "vy", "vz", "n", *rounding("cx", "cy", "cz"), "r", "g", "b")


def _fused_sql(least: int, size: str = "0.1", source: str = "pts", colours: bool = True) -> str:
    rgb = ", ".join(f"least(greatest(round_even(sum({c}) / count(*), 0), 0), 255)::INT AS {c}" for c in "rgb")
    xyz = ", ".join(f"round(sum({c}) / count(*), 6) + 0.0 AS c{c}" for c in "xyz")
    keys = ", ".join(f"floor({c} / {size})::BIGINT AS v{c}" for c in "xyz")
    return f"SELECT {keys}, count(*) AS n, {xyz}, {rgb} FROM {source} GROUP BY ALL HAVING count(*) >= {least}"


def voxel_fuse(spark: SparkSession, sf: str) -> DataFrame:
    return _compared(fusion.voxel_fuse(tables.points(spark, sf), VOXEL))


def voxel_fuse_partial_final(spark: SparkSession, sf: str) -> DataFrame:
    return _compared(fusion.voxel_fuse_by_view(tables.points(spark, sf), VOXEL))


def _bulk(spark: SparkSession, sf: str) -> DataFrame:
    unit = {"x": F.col("l_quantity") / 51, "y": F.col("l_discount") / 0.11, "z": F.col("l_extendedprice") / 105000}
    return tables.table(spark, sf, "lineitem").select(*[c.alias(n) for n, c in unit.items()], *[F.floor(F.col("l_quantity")).cast("int").alias(c) for c in "rgb"])


def voxel_fuse_bulk(spark: SparkSession, sf: str) -> DataFrame:
    return _compared(fusion.voxel_fuse(_bulk(spark, sf), 0.125))


def voxel_pack_key(spark: SparkSession, sf: str) -> DataFrame:
    cells = fusion.with_voxels(fusion.finite(tables.points(spark, sf)), VOXEL)
    return cells.select(fusion.packed_key(F.col("vx"), F.col("vy"), F.col("vz")).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


def points_rgb_left_join(spark: SparkSession, sf: str) -> DataFrame:
    pts = tables.points(spark, sf)
    colours = pts.filter("vec_id % 3 <> 0").select("vec_id", "r", "g", "b")
    return fusion.with_colours(pts.drop("r", "g", "b"), colours, ["vec_id"]).select("vec_id", *rounding("x", "y", "z"), "r", "g", "b")


def depth_minpool(spark: SparkSession, sf: str) -> DataFrame:
    return raster.min_pool(tables.tiles(spark, sf), "vec_id", 2, tables.TILE, tables.TILE).select("vec_id", "u", "v", *rounding("depth"))


def depth_minpool_trimmed(spark: SparkSession, sf: str) -> DataFrame:
    return raster.min_pool(tables.tiles(spark, sf), "vec_id", 3, tables.TILE, tables.TILE).select("vec_id", "u", "v", *rounding("depth"))


def rgb_area_pool(spark: SparkSession, sf: str) -> DataFrame:
    value = tables.tiles(spark, sf).withColumn("val", F.coalesce("depth", F.lit(0.0)))
    return raster.area_pool(value, "vec_id", 2, "val").select("vec_id", "u", "v", *rounding("val"))


FOCAL, CENTRE = 4.0, 4.0


def _rotation() -> G.Matrix:
    return G.rotation(*[F.col(f"q{i}") for i in (1, 2, 3, 4)])


def _translation() -> G.Vector:
    return (F.col("tx"), F.col("ty"), F.col("tz"))


def unproject_world(spark: SparkSession, sf: str) -> DataFrame:
    df = tables.tiles(spark, sf).filter("depth is not null").join(tables.poses(spark, sf), F.col("vec_id") == F.col("frame"))
    p = G.unproject(F.col("u"), F.col("v"), F.col("depth"), *[F.lit(c) for c in (FOCAL, FOCAL, CENTRE, CENTRE)])
    w = G.apply(G.camera_rotation(_rotation()), p)
    return df.select("vec_id", "u", "v", *[rounded(a + b).alias(n) for a, b, n in zip(w, _translation(), "xyz", strict=True)])


def _normals(spark: SparkSession, sf: str) -> DataFrame:
    return raster.normals(tables.tiles(spark, sf), "vec_id", tables.TILE, tables.TILE, FOCAL, CENTRE, CENTRE)


def normals(spark: SparkSession, sf: str) -> DataFrame:
    return _normals(spark, sf).select("vec_id", "u", "v", *rounding("nx", "ny", "nz"))


def normal_dispersion(spark: SparkSession, sf: str) -> DataFrame:
    return raster.normal_dispersion(_normals(spark, sf), "vec_id", 48).select("vec_id", *rounding("disp"))


def colorize_normal(spark: SparkSession, sf: str) -> DataFrame:
    level = lambda c, k: F.floor(F.least(F.greatest(F.col(c) * k + 0.5, F.lit(0.0)), F.lit(1.0)) * 255 + 1e-9).cast("int")
    return _normals(spark, sf).filter("nx is not null").select("vec_id", "u", "v", level("nx", 0.5).alias("r"), level("ny", -0.5).alias("g"), level("nz", -0.5).alias("b"))


def depth_stats(spark: SparkSession, sf: str) -> DataFrame:
    return raster.depth_stats(tables.tiles(spark, sf), "vec_id").select("vec_id", "n_valid", *rounding("valid_frac", "mean", "std"))


def sobel_gradient(spark: SparkSession, sf: str) -> DataFrame:
    return raster.sobel_strength(tables.tiles(spark, sf), "vec_id", "value").select("vec_id", *rounding("grad_mean"))


def colorize_depth(spark: SparkSession, sf: str) -> DataFrame:
    """Inverse depth stretched between two of its quantiles, clipped to 0..255."""
    tiles = tables.tiles(spark, sf).filter("depth is not null").withColumn("disp", 1 / F.col("depth"))
    q = tiles.groupBy("vec_id").agg(F.percentile("disp", F.lit(0.001)).alias("lo"), F.percentile("disp", F.lit(0.99)).alias("hi"))
    level = (F.col("disp") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1e-12)
    return tiles.join(q, "vec_id").select("vec_id", "u", "v", F.floor(F.least(F.greatest(1 - level, F.lit(0.0)), F.lit(1.0)) * 255 + 1e-6).cast("int").alias("level"))


def colorize_depth_live(spark: SparkSession, sf: str) -> DataFrame:
    """Colours of 1 - 1 / depth as it is, without a stretch; pixels without depth are black."""
    return colours.coloured(tables.tiles(spark, sf), 1 - 1 / F.col("depth")).select("vec_id", "u", "v", "r", "g", "b")


def openness_score(spark: SparkSession, sf: str) -> DataFrame:
    return raster.openness(tables.tiles(spark, sf), "vec_id", tables.TILE, 0.5).select("vec_id", *rounding("score"))


def best_yaw(spark: SparkSession, sf: str) -> DataFrame:
    """Of each label the view with the highest openness; the first one on ties."""
    tiles = tables.tiles(spark, sf)
    score = raster.openness(tiles, "vec_id", tables.TILE, 0.5).join(tiles.select("vec_id", "label").distinct(), "vec_id")
    best = score.groupBy("label").agg(F.max(F.struct(F.round("score", 9).alias("score"), (-F.col("vec_id")).alias("id"))).alias("b"))
    return best.select("label", (-F.col("b.id")).alias("vec_id"), rounded("b.score").alias("score"))


def _gate_stats(spark: SparkSession, sf: str) -> DataFrame:
    tiles = tables.tiles(spark, sf)
    return raster.depth_stats(tiles, "vec_id").join(raster.normal_dispersion(_normals(spark, sf), "vec_id", 48), "vec_id")


def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    limits = {"valid_frac": 0.95, "samples": 60, "mean_depth": 0.95, "rel_std": 0.45, "dispersion": 0.2}
    stats = _gate_stats(spark, sf).withColumns({c: F.round(c, 9) for c in ("valid_frac", "mean", "std", "disp")})
    return stats.select("vec_id", raster.first_failure(stats, limits).alias("reason"))


def keypoints(spark: SparkSession, sf: str) -> DataFrame:
    """Keypoints of the mosaics with their scores."""
    return raster.corners(tables.mosaics(spark, sf), "view", "value", 0.02).select("view", "u", "v", *rounding("score"))


#: Limits of the gates for the given rasters, in the order in which they apply.
GATES = {"valid_frac": 0.5, "samples": 500, "mean_depth": 0.551, "rel_std": 0.1, "dispersion": 0.05, "gradient": 0.315, "keypoints": 71, "cells": 5}


def view_gate(spark: SparkSession, sf: str) -> DataFrame:
    """All eight gates over the mosaics, pooled to 32 x 32."""
    found = raster.view_gate(tables.mosaics(spark, sf), "view", 2, tables.MOSAIC, tables.MOSAIC, 32.0, GATES, 0.01, least=1)
    return found.select("view", "reason", "n_valid", "n_keypoints", "thin_cells", *rounding("mean", "disp", "grad_mean"))


def grid_coverage(spark: SparkSession, sf: str) -> DataFrame:
    bulk = _bulk(spark, sf)
    counts = raster.grid_counts(bulk, F.col("x"), F.col("y"), 8, 8)
    return counts.agg(F.count_if(F.col("n") < 500).alias("cells_failing"), (F.count_if(F.col("n") < 500) <= 64 // 3).alias("ok"))


def intrinsics(spark: SparkSession, sf: str) -> DataFrame:
    """Intrinsics of sensors whose size and field of view come from parts: the first field given, clipped."""
    parts = tables.table(spark, sf, "part")
    w, h = (F.col("p_size") * 32).cast("double"), (F.col("p_size") * 24).cast("double")
    given = F.coalesce(F.when(F.col("p_partkey") % 3 == 0, F.col("p_size") * 3.0), F.when(F.col("p_partkey") % 3 == 1, F.lit(75.0)), F.lit(90.0))
    field = F.least(F.greatest(given, F.lit(G.FIELD_LIMITS[0])), F.lit(G.FIELD_LIMITS[1]))
    df = parts.select("p_partkey", w.alias("w"), h.alias("h"), field.alias("hfov"))
    fx = G.focal(F.col("w"), F.col("hfov"))
    vfov = G.vertical_field(F.col("w"), F.col("h"), F.col("hfov"))
    fy = G.focal(F.col("h"), vfov)
    return df.select("p_partkey", rounded("hfov").alias("hfov"), rounded(vfov).alias("vfov"), rounded(fx).alias("fx"), rounded(fy).alias("fy"), (F.col("w") / 2).alias("cx"), (F.col("h") / 2).alias("cy"), ((F.col("w") - 1) / 2).alias("cx_centre"))


def scale_intrinsics(spark: SparkSession, sf: str) -> DataFrame:
    """Intrinsics for an image half as large: the centre follows from the new size."""
    base = intrinsics(spark, sf)
    w2, h2 = F.floor(F.col("cx")).cast("int"), F.floor(F.col("cy")).cast("int")
    return base.select("p_partkey", w2.alias("w"), h2.alias("h"), rounded(F.col("fx") * 0.5, 4).alias("fx"), rounded(F.col("fy") * 0.5, 4).alias("fy"), (w2 / 2).alias("cx"), (h2 / 2).alias("cy"))


def camera_models(spark: SparkSession, sf: str) -> DataFrame:
    base = intrinsics(spark, sf)
    k = [F.col(c) for c in ("fx", "fy", "cx", "cy")]
    models = ("PINHOLE", "SIMPLE_PINHOLE", "SIMPLE_RADIAL")
    model = F.element_at(F.array(*[F.lit(m) for m in models]), (F.col("p_partkey") % 3 + 1).cast("int"))
    params = F.when(model == models[0], G.camera_parameters(models[0], *k)).when(model == models[1], G.camera_parameters(models[1], *k)).otherwise(G.camera_parameters(models[2], *k))
    return base.select("p_partkey", model.alias("model"), F.array_join(F.transform(params, lambda p: F.format_string("%.3f", p)), ",").alias("params"))


CELLS = [f"m{i}{j}" for i in range(3) for j in range(3)]


def quat_to_matrix(spark: SparkSession, sf: str) -> DataFrame:
    m = _rotation()
    return tables.poses(spark, sf).select("frame", *[rounded(m[i][j]).alias(f"m{i}{j}") for i in range(3) for j in range(3)])


def pose_invert(spark: SparkSession, sf: str) -> DataFrame:
    """World-to-camera pose of each camera."""
    m, t = G.inverse_pose(G.camera_rotation(_rotation()), _translation())
    return tables.poses(spark, sf).select("frame", *[rounded(m[i][j]).alias(f"m{i}{j}") for i in range(3) for j in range(3)], *[rounded(c).alias(n) for c, n in zip(t, ("tx", "ty", "tz"), strict=True)])


def rotate_axis(spark: SparkSession, sf: str) -> DataFrame:
    """The forward axis (0, 0, -1) of each pose in the world."""
    v = G.apply(_rotation(), (F.lit(0.0), F.lit(0.0), F.lit(-1.0)))
    return tables.poses(spark, sf).select("frame", *[rounded(c).alias(n) for c, n in zip(v, ("fx", "fy", "fz"), strict=True)])


def pitch_roll_yaw_compose(spark: SparkSession, sf: str) -> DataFrame:
    q = G.turned(F.col("tx") * 3, F.col("ty"), F.col("tz"))
    m = G.rotation(*q)
    return tables.poses(spark, sf).select("frame", *[rounded(m[i][j]).alias(f"m{i}{j}") for i in range(3) for j in range(3)])


def align_z_to_vec(spark: SparkSession, sf: str) -> DataFrame:
    m = G.aligned_to(_translation())
    return tables.poses(spark, sf).select("frame", *[rounded(m[i][j]).alias(f"m{i}{j}") for i in range(3) for j in range(3)])


def wrap_blend_yaw(spark: SparkSession, sf: str) -> DataFrame:
    e = tables.table(spark, sf, "events").select("event_id", (F.col("value") / 7).alias("a"), (F.col("value") / 3).alias("b"))
    return e.select("event_id", rounded(wrap(F.col("a"))).alias("wrapped"), rounded(blend(F.col("a"), F.col("b"), 0.3), 4).alias("blended"))


def pose_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Pose records with the image names of the frames."""
    q = F.array_join(F.transform(F.array(*[F.col(f"q{i}") for i in (1, 2, 3, 4)]), lambda c: F.format_string("%.4f", c + F.lit(0.0))), ",")
    return tables.poses(spark, sf).select("frame", (F.col("frame") % 2).cast("int").alias("round"), F.format_string("rgb_%05d.png", "frame").alias("image"), q.alias("rotation"))


def colmap_images(spark: SparkSession, sf: str) -> DataFrame:
    """Images of a sparse reconstruction: numbered from 1 in frame order, with inverted poses."""
    _, t = G.inverse_pose(G.camera_rotation(_rotation()), _translation())
    return tables.poses(spark, sf).select((F.col("frame") + 1).alias("image_id"), F.lit(1).alias("camera_id"), F.format_string("rgb_%05d.png", "frame").alias("name"), *[rounded(c).alias(n) for c, n in zip(t, ("tx", "ty", "tz"), strict=True)])


def frusta_points(spark: SparkSession, sf: str) -> DataFrame:
    """Points on the twelve edges of each camera's frustum."""
    corner = lambda u, v, d: F.struct(*[F.lit(x).alias(n) for x, n in zip(((u - CENTRE) * d / FOCAL, (v - CENTRE) * d / FOCAL, d), "xyz", strict=True)])
    far = tables.TILE - 1.0
    corners = [corner(u, v, d) for d in (0.1, 0.5) for u, v in ((0.0, 0.0), (far, 0.0), (far, far), (0.0, far))]
    ends = [(0, 1), (1, 2), (2, 3), (3, 0), (4, 5), (5, 6), (6, 7), (7, 4), (0, 4), (1, 5), (2, 6), (3, 7)]
    edges = F.array(*[F.struct(F.lit(i).alias("edge"), corners[a].alias("a"), corners[b].alias("b")) for i, (a, b) in enumerate(ends)])
    df = tables.poses(spark, sf).withColumn("e", F.explode(edges)).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(4))))
    u = F.col("k") / 4
    p = tuple((1 - u) * F.col(f"e.a.{c}") + u * F.col(f"e.b.{c}") for c in "xyz")
    w = G.apply(G.camera_rotation(_rotation()), p)
    return df.select("frame", F.col("e.edge").alias("edge"), "k", *[rounded(a + b).alias(n) for a, b, n in zip(w, _translation(), "xyz", strict=True)])


def axes_tripod(spark: SparkSession, sf: str) -> DataFrame:
    """Points along the axes of each camera, red, green and blue."""
    m, t = G.camera_rotation(_rotation()), _translation()
    axes = F.array(*[F.struct(F.lit(i).alias("axis"), *[m[r][i].alias(c) for r, c in enumerate("xyz")]) for i in range(3)])
    df = tables.poses(spark, sf).select("frame", *[c.alias(f"t{n}") for c, n in zip(t, "xyz", strict=True)], F.explode(axes).alias("e"))
    df = df.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(TRIPOD_SAMPLES - 1))))
    way = F.col("k") / (TRIPOD_SAMPLES - 1) * TRIPOD_LENGTH
    colour = [F.when(F.col("e.axis") == i, 255).otherwise(0).cast("int").alias(c) for i, c in enumerate("rgb")]
    return df.select("frame", F.col("e.axis").alias("axis"), "k", *[rounded(F.col(f"t{c}") + F.col(f"e.{c}") * way).alias(c) for c in "xyz"], *colour)


def frusta_overlay(spark: SparkSession, sf: str) -> DataFrame:
    """The cloud with the frusta and tripods of every 25th camera as points: kind, x, y, z, r, g, b."""
    names = ["kind", "x", "y", "z", "r", "g", "b"]
    cloud = tables.points(spark, sf).select(F.lit("cloud").alias("kind"), *rounding("x", "y", "z"), "r", "g", "b")
    dark = [F.lit(10).alias(c) for c in "rgb"]
    frusta = frusta_points(spark, sf).filter("frame % 25 = 0").select(F.lit("frustum").alias("kind"), "x", "y", "z", *dark)
    return cloud.unionByName(frusta).unionByName(axes_tripod(spark, sf).filter("frame % 25 = 0").withColumn("kind", F.lit("axes")).select(*names))


def pose_records(spark: SparkSession, sf: str) -> DataFrame:
    """Pose records in full: the first three rows of the transform, position, height of the round and rotation."""
    m, t = G.camera_rotation(_rotation()), _translation()
    height = F.when(F.col("frame") % 2 == 0, 1.5).otherwise(0.9)
    cells = [rounded(m[i][j]).alias(f"m{i}{j}") for i in range(3) for j in range(3)]
    return tables.poses(spark, sf).select("frame", (F.col("frame") % 2).cast("int").alias("round"), height.alias("cam_height"), *cells, *[rounded(c).alias(f"p{n}") for c, n in zip(t, "xyz", strict=True)], *rounding("q1", "q2", "q3", "q4"))


def reconstruction_images(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a sparse reconstruction's images: number, world-to-camera rotation with w first and not negative, translation, camera and name."""
    m, t = G.inverse_pose(G.camera_rotation(_rotation()), _translation())
    q = G.quaternion(m)
    return tables.poses(spark, sf).select(
        (F.col("frame") + 1).alias("image_id"), *[rounded(c, 5).alias(n) for c, n in zip(q, ("qw", "qx", "qy", "qz"), strict=True)], *[rounded(c).alias(n) for c, n in zip(t, ("tx", "ty", "tz"), strict=True)],
        F.lit(1).alias("camera_id"), F.format_string("rgb_%05d.png", "frame").alias("name"),
    )


def capture_jitter(spark: SparkSession, sf: str) -> DataFrame:
    """Normal draws for pitch, roll and height of each frame, from hashes of frame and name."""
    spread = {"pitch": 0.02, "roll": 0.01, "height": 0.03}
    return tables.poses(spark, sf).select("frame", *[rounded(normal_draw(F.col("frame"), n) * s).alias(n) for n, s in spread.items()])


def birdeye_px(spark: SparkSession, sf: str) -> DataFrame:
    """Places of the cameras in a bird's-eye image of 500 pixels width."""
    poses = tables.poses(spark, sf)
    box = poses.agg(*[f(c).alias(f"{n}{c}") for c in ("tx", "tz") for f, n in ((F.min, "lo"), (F.max, "hi"))])  # one row
    span = lambda c: F.greatest(F.col(f"hi{c}") - F.col(f"lo{c}"), F.lit(1e-6))
    height = F.bround(500 * (F.col("hitz") - F.col("lotz")) / span("tx"))
    u, v = (F.col("tx") - F.col("lotx")) / span("tx"), (F.col("tz") - F.col("lotz")) / span("tz")
    return poses.join(F.broadcast(box)).select("frame", F.bround(u * 499).cast("int").alias("px"), F.bround((1 - v) * (height - 1)).cast("int").alias("py"))


#: Length of a tripod's axes and points on each.
TRIPOD_LENGTH, TRIPOD_SAMPLES = 0.1, 6
_MATRIX = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in CELLS)
_CAM = "cam AS (SELECT frame, tx, ty, tz, m00, -m01 AS m01, -m02 AS m02, m10, -m11 AS m11, -m12 AS m12, m20, -m21 AS m21, -m22 AS m22 FROM mat)"
_GRAD = """g0 AS (SELECT vec_id, u, v, (u - 4) * depth / 4 AS x, (v - 4) * depth / 4 AS y, depth AS z FROM tile),
g1 AS (SELECT *, """ + ", ".join(
    f"CASE u WHEN 0 THEN lead({c}) OVER w - {c} WHEN 7 THEN {c} - lag({c}) OVER w ELSE (lead({c}) OVER w - lag({c}) OVER w) / 2 END AS {c}u, CASE v WHEN 0 THEN lead({c}) OVER h - {c} WHEN 7 THEN {c} - lag({c}) OVER h ELSE (lead({c}) OVER h - lag({c}) OVER h) / 2 END AS {c}v"
    for c in "xyz"
) + """ FROM g0 WINDOW w AS (PARTITION BY vec_id, v ORDER BY u), h AS (PARTITION BY vec_id, u ORDER BY v)),
g2 AS (SELECT vec_id, u, v, yu*zv - zu*yv AS a, zu*xv - xu*zv AS b, xu*yv - yu*xv AS c FROM g1),
nrm AS (SELECT vec_id, u, v, a/(sqrt(a*a+b*b+c*c)+1e-6) AS nx, b/(sqrt(a*a+b*b+c*c)+1e-6) AS ny, c/(sqrt(a*a+b*b+c*c)+1e-6) AS nz FROM g2)"""
_DISP = """dsp AS (SELECT vec_id, CASE WHEN count(nx) < 48 THEN 0 ELSE 1 - sqrt(power(avg(nx/(sqrt(nx*nx+ny*ny+nz*nz)+1e-6)),2) + power(avg(ny/(sqrt(nx*nx+ny*ny+nz*nz)+1e-6)),2) + power(avg(nz/(sqrt(nx*nx+ny*ny+nz*nz)+1e-6)),2)) END AS disp FROM nrm GROUP BY vec_id)"""
_STAT = "st AS (SELECT vec_id, count(depth) AS n_valid, count(depth) / count(*) AS valid_frac, avg(depth) AS mean, stddev_pop(depth) AS std FROM tile GROUP BY vec_id)"
_OPEN = "op AS (SELECT vec_id, any_value(label) AS label, coalesce(quantile_cont(depth, 0.5) * (0.5 + 0.5 * count(depth) / count(*)), 0) AS score FROM tile WHERE u >= 2 AND u < 6 GROUP BY vec_id)"
_INTR = """i0 AS (SELECT p_partkey, p_size * 32.0 AS w, p_size * 24.0 AS h, least(greatest(CASE p_partkey % 3 WHEN 0 THEN p_size * 3.0 WHEN 1 THEN 75.0 ELSE 90.0 END, 30.0), 120.0)::DOUBLE AS hfov FROM part),
i1 AS (SELECT p_partkey, w::DOUBLE AS w, h::DOUBLE AS h, hfov, degrees(2 * atan(tan(radians(hfov) / 2) * h / w)) AS vfov FROM i0),
i2 AS (SELECT p_partkey, round(hfov, 6) AS hfov, round(vfov, 6) AS vfov, round(w / 2 / tan(radians(hfov) / 2), 6) AS fx, round(h / 2 / tan(radians(vfov) / 2), 6) AS fy, w / 2 AS cx, h / 2 AS cy, (w - 1) / 2 AS cx_centre FROM i1)"""
_PRY = """pr AS (SELECT frame, tx * 3 / 2 AS a, ty / 2 AS b, tz / 2 AS c FROM pose),
y1 AS (SELECT frame, 0.0 AS ax, sin(a) AS ay, 0.0 AS az, cos(a) AS aw, sin(b) AS bx, cos(b) AS bw, -sin(c) AS cz, cos(c) AS cw FROM pr),
y2 AS (SELECT frame, aw*bx AS x, ay*bw AS y, -ay*bx AS z, aw*bw AS w, cz, cw FROM y1),
y3 AS (SELECT frame, x*cw + y*cz AS q1, -x*cz + y*cw AS q2, w*cz + z*cw AS q3, w*cw - z*cz AS q4 FROM y2),
m AS (SELECT frame, 1-2*(q2*q2+q3*q3) AS m00, 2*(q1*q2-q4*q3) AS m01, 2*(q1*q3+q4*q2) AS m02, 2*(q1*q2+q4*q3) AS m10, 1-2*(q1*q1+q3*q3) AS m11, 2*(q2*q3-q4*q1) AS m12, 2*(q1*q3-q4*q2) AS m20, 2*(q2*q3+q4*q1) AS m21, 1-2*(q1*q1+q2*q2) AS m22 FROM y3)"""
_ALIGN = """a0 AS (SELECT frame, tx/(sqrt(tx*tx+ty*ty+tz*tz)+1e-9) AS x, ty/(sqrt(tx*tx+ty*ty+tz*tz)+1e-9) AS y, tz/(sqrt(tx*tx+ty*ty+tz*tz)+1e-9) AS z FROM pose),
a1 AS (SELECT *, (1-z)/(x*x+y*y+1e-12) AS k FROM a0),
m AS (SELECT frame, 1-x*x*k AS m00, -y*x*k AS m01, x AS m02, -y*x*k AS m10, 1-y*y*k AS m11, y AS m12, -x AS m20, -y AS m21, 1-(x*x+y*y)*k AS m22 FROM a1)"""
_FRUSTA = """co AS (SELECT c, (u - 4) * d / 4 AS x, (v - 4) * d / 4 AS y, d AS z FROM (VALUES (0, 0.0, 0.0, 0.1), (1, 7.0, 0.0, 0.1), (2, 7.0, 7.0, 0.1), (3, 0.0, 7.0, 0.1), (4, 0.0, 0.0, 0.5), (5, 7.0, 0.0, 0.5), (6, 7.0, 7.0, 0.5), (7, 0.0, 7.0, 0.5)) t(c, u, v, d)),
ed AS (SELECT * FROM (VALUES (0,0,1),(1,1,2),(2,2,3),(3,3,0),(4,4,5),(5,5,6),(6,6,7),(7,7,4),(8,0,4),(9,1,5),(10,2,6),(11,3,7)) t(edge, a, b)),
sg AS (SELECT edge, k::INT AS k, (1 - k / 4.0::DOUBLE) * a.x + k / 4.0::DOUBLE * b.x AS px, (1 - k / 4.0::DOUBLE) * a.y + k / 4.0::DOUBLE * b.y AS py, (1 - k / 4.0::DOUBLE) * a.z + k / 4.0::DOUBLE * b.z AS pz FROM ed JOIN co a ON a.c = ed.a JOIN co b ON b.c = ed.b, range(0, 5) t(k))"""
_FRUSTA_WORLD = "fru AS (SELECT frame, edge, k, " + ", ".join(f"m{i}0*px + m{i}1*py + m{i}2*pz + t{c} AS {c}" for i, c in enumerate("xyz")) + " FROM cam, sg)"
_TRIPOD = "trip AS (" + " UNION ALL ".join(
    f"SELECT frame, {a} AS axis, k::INT AS k, " + ", ".join(f"t{c} + m{i}{a} * (k / {TRIPOD_SAMPLES - 1}.0::DOUBLE * {TRIPOD_LENGTH}) AS {c}" for i, c in enumerate("xyz")) + ", " + ", ".join(f"{255 if i == a else 0} AS {c}" for i, c in enumerate("rgb")) + f" FROM cam, range(0, {TRIPOD_SAMPLES}) t(k)"
    for a in range(3)
) + ")"

_MOSAIC = f"""{sql.TILE}, mo AS MATERIALIZED (SELECT w.view, w.u, w.v, t.depth, coalesce(t.val, 0) AS val FROM (SELECT DISTINCT vec_id // 64 AS view, i % 64 AS u, i // 64 AS v FROM embeddings, range(4096) r(i)) w
LEFT JOIN tile t ON t.vec_id = w.view * 64 + (w.v // 8) * 8 + w.u // 8 AND t.u = w.u % 8 AND t.v = w.v % 8)"""


def _corners_sql(src: str, out: str, threshold: float) -> str:
    """Keypoints of the dense rasters ``src`` (view, u, v, val)."""
    ring = ", ".join(f"({i}, {du}, {dv})" for i, (du, dv) in enumerate(raster.RING))
    return f"""{out}r AS MATERIALIZED (SELECT c.view, c.u, c.v, list(n.val - c.val ORDER BY i) AS d FROM {src} c, (VALUES {ring}) r(i, du, dv) JOIN {src} n ON n.view = c.view AND n.u = c.u + du AND n.v = c.v + dv GROUP BY c.view, c.u, c.v HAVING count(*) = 16),
{out}s AS MATERIALIZED (SELECT view, u, v, greatest(list_max(list_transform(range(16), lambda i: list_min(list_concat(d, d)[i + 1 : i + 9]))), -list_min(list_transform(range(16), lambda i: list_max(list_concat(d, d)[i + 1 : i + 9])))) AS score FROM {out}r),
{out} AS (SELECT view, u, v, score FROM {out}s c WHERE score > {threshold} AND NOT EXISTS (SELECT 1 FROM {out}s n WHERE n.view = c.view AND abs(n.u - c.u) <= 1 AND abs(n.v - c.v) <= 1 AND (n.u <> c.u OR n.v <> c.v) AND n.score >= c.score)
  QUALIFY row_number() OVER (PARTITION BY view ORDER BY score DESC, v, u) <= 2000)"""


def _near(c: str, along: str, at: str) -> str:
    return f"CASE WHEN {at} = 0 THEN lead({c}) OVER {along} - {c} WHEN {at} = 31 THEN {c} - lag({c}) OVER {along} ELSE (lead({c}) OVER {along} - lag({c}) OVER {along}) / 2 END"


_GATE = f"""WITH {_MOSAIC}, sm AS MATERIALIZED (SELECT view, u // 2 AS u, v // 2 AS v, min(depth) AS depth, avg(val) AS val FROM mo GROUP BY view, u // 2, v // 2),
{_corners_sql('sm', 'kp', 0.01)},
ce AS (SELECT view, count(*) AS n FROM kp GROUP BY view, u * 4 // 32, v * 4 // 32), ks AS (SELECT view, sum(n) AS n_keypoints, count(*) AS full_cells FROM ce GROUP BY view),
g0 AS (SELECT view, u, v, (u - 16) * depth / 32 AS x, (v - 16) * depth / 32 AS y, depth AS z FROM sm),
g1 AS (SELECT view, u, v, {", ".join(f"{_near(c, 'a', 'u')} AS {c}u, {_near(c, 'b', 'v')} AS {c}v" for c in "xyz")} FROM g0 WINDOW a AS (PARTITION BY view, v ORDER BY u), b AS (PARTITION BY view, u ORDER BY v)),
g2 AS (SELECT view, yu*zv - zu*yv AS nx, zu*xv - xu*zv AS ny, xu*yv - yu*xv AS nz FROM g1), g3 AS (SELECT view, {", ".join(f"{c} / (sqrt(nx*nx+ny*ny+nz*nz) + 1e-6) AS {c}" for c in ("nx", "ny", "nz"))} FROM g2),
di AS (SELECT view, CASE WHEN count(nx) < 1000 THEN 0 ELSE 1 - sqrt({" + ".join(f"power(avg({c} / (sqrt(nx*nx+ny*ny+nz*nz) + 1e-6)), 2)" for c in ("nx", "ny", "nz"))}) END AS disp FROM g3 GROUP BY view),
s1 AS (SELECT *, coalesce(lead(val) OVER w, lag(val) OVER w) - coalesce(lag(val) OVER w, lead(val) OVER w) AS a, coalesce(lead(val) OVER w, lag(val) OVER w) + coalesce(lag(val) OVER w, lead(val) OVER w) + 2 * val AS b FROM sm WINDOW w AS (PARTITION BY view, v ORDER BY u)),
s2 AS (SELECT view, depth, abs(coalesce(lead(a) OVER h, lag(a) OVER h) + coalesce(lag(a) OVER h, lead(a) OVER h) + 2 * a) + abs(coalesce(lead(b) OVER h, lag(b) OVER h) - coalesce(lag(b) OVER h, lead(b) OVER h)) AS g FROM s1 WINDOW h AS (PARTITION BY view, u ORDER BY v)),
gr AS (SELECT view, round(coalesce(avg(g) FILTER (WHERE depth > 0), 0), 9) AS grad_mean FROM s2 GROUP BY view),
st AS (SELECT view, count(depth) AS n_valid, round(count(depth) / count(*), 9) AS valid_frac, round(avg(depth), 9) AS mean, round(stddev_pop(depth), 9) AS std FROM sm GROUP BY view),
al AS (SELECT st.*, round(disp, 9) AS disp, grad_mean, coalesce(n_keypoints, 0)::BIGINT AS n_keypoints, 16 - coalesce(full_cells, 0) AS thin_cells FROM st JOIN di USING (view) JOIN gr USING (view) LEFT JOIN ks USING (view))
SELECT view, CASE WHEN valid_frac < {GATES["valid_frac"]} THEN 'valid_frac' WHEN n_valid < {GATES["samples"]} THEN 'samples' WHEN mean < {GATES["mean_depth"]} THEN 'mean_depth' WHEN std / greatest(mean, 1e-6) < {GATES["rel_std"]} THEN 'rel_std'
  WHEN disp < {GATES["dispersion"]} THEN 'dispersion' WHEN grad_mean < {GATES["gradient"]} THEN 'gradient' WHEN n_keypoints < {GATES["keypoints"]} THEN 'keypoints' WHEN thin_cells > {GATES["cells"]} THEN 'cells' END AS reason,
  n_valid, n_keypoints, thin_cells, {sql.rounded('mean', 'disp', 'grad_mean')} FROM al"""

def _channel_sql(k: int, name: str) -> str:
    stops = [float(s[k]) for s in colours.SPECTRAL]
    return f"floor({stops}[k + 1] + ({stops}[k + 2] - {stops}[k + 1]) * (p - k) + 1e-6)::INT AS {name}"


_LUT = f"lut AS (SELECT i AS level, {', '.join(_channel_sql(k, c) for k, c in enumerate('rgb'))} FROM (SELECT i, i * 10 / 255 AS p, least(floor(i * 10 / 255), 9)::INT AS k FROM range(256) t(i)))"

QUERIES = {
    "colorize_depth_live": (
        colorize_depth_live,
        f"WITH {sql.TILE}, {_LUT} SELECT vec_id, u, v, coalesce(r, 0) AS r, coalesce(g, 0) AS g, coalesce(b, 0) AS b FROM tile LEFT JOIN lut ON level = least(greatest(floor((1 - 1 / depth) * 256), 0), 255)",
    ),
    "keypoints": (keypoints, f"WITH {_MOSAIC}, {_corners_sql('mo', 'kp', 0.02)} SELECT view, u, v, {sql.rounded('score')} FROM kp"),
    "view_gate": (view_gate, _GATE),
    "voxel_fuse": (voxel_fuse, f"WITH {sql.PTS} {_fused_sql(3)}"),
    "voxel_fuse_partial_final": (voxel_fuse_partial_final, f"WITH {sql.PTS} {_fused_sql(3)}"),
    "voxel_fuse_bulk": (voxel_fuse_bulk, "WITH bulk AS (SELECT l_quantity/51 AS x, l_discount/0.11::DOUBLE AS y, l_extendedprice/105000 AS z, floor(l_quantity)::INT AS r, floor(l_quantity)::INT AS g, floor(l_quantity)::INT AS b FROM lineitem) " + _fused_sql(3, "0.125", "bulk")),
    "voxel_pack_key": (voxel_pack_key, f"WITH {sql.PTS} SELECT ((floor(x / 0.1)::BIGINT + 1048576) << 42) | ((floor(y / 0.1)::BIGINT + 1048576) << 21) | (floor(z / 0.1)::BIGINT + 1048576) AS code, count(*) AS n FROM pts GROUP BY ALL"),
    "points_rgb_left_join": (points_rgb_left_join, f"WITH {sql.PTS} SELECT a.vec_id, round(a.x, 6) + 0.0 AS x, round(a.y, 6) + 0.0 AS y, round(a.z, 6) + 0.0 AS z, coalesce(c.r, 0) AS r, coalesce(c.g, 0) AS g, coalesce(c.b, 0) AS b FROM pts a LEFT JOIN (SELECT * FROM pts WHERE vec_id % 3 <> 0) c ON a.vec_id = c.vec_id"),
    "depth_minpool": (depth_minpool, f"WITH {sql.TILE} SELECT vec_id, (u // 2)::INT AS u, (v // 2)::INT AS v, round(min(depth), 6) AS depth FROM tile GROUP BY ALL"),
    "depth_minpool_trimmed": (depth_minpool_trimmed, f"WITH {sql.TILE} SELECT vec_id, (u // 3)::INT AS u, (v // 3)::INT AS v, round(min(depth), 6) AS depth FROM (SELECT * FROM tile WHERE u < 6 AND v < 6) GROUP BY vec_id, u // 3, v // 3"),
    "rgb_area_pool": (rgb_area_pool, f"WITH {sql.TILE} SELECT vec_id, (u // 2)::INT AS u, (v // 2)::INT AS v, round(avg(coalesce(depth, 0)), 6) AS val FROM tile GROUP BY vec_id, u // 2, v // 2"),
    "unproject_world": (unproject_world, f"WITH {sql.TILE}, {sql.POSE}, {_CAM} SELECT vec_id, u, v, " + ", ".join(f"round(m{i}0 * ((u - 4) * depth / 4) + m{i}1 * ((v - 4) * depth / 4) + m{i}2 * depth + t{c}, 6) + 0.0 AS {c}" for i, c in enumerate("xyz")) + " FROM tile JOIN cam ON vec_id = frame WHERE depth IS NOT NULL"),
    "normals": (normals, f"WITH {sql.TILE}, {_GRAD} SELECT vec_id, u, v, {sql.rounded('nx', 'ny', 'nz')} FROM nrm"),
    "normal_dispersion": (normal_dispersion, f"WITH {sql.TILE}, {_GRAD}, {_DISP} SELECT vec_id, {sql.rounded('disp')} FROM dsp"),
    "colorize_normal": (colorize_normal, f"WITH {sql.TILE}, {_GRAD} SELECT vec_id, u, v, floor(least(greatest(nx * 0.5 + 0.5, 0), 1) * 255 + 1e-9)::INT AS r, floor(least(greatest(ny * -0.5 + 0.5, 0), 1) * 255 + 1e-9)::INT AS g, floor(least(greatest(nz * -0.5 + 0.5, 0), 1) * 255 + 1e-9)::INT AS b FROM nrm WHERE nx IS NOT NULL"),
    "colorize_depth": (colorize_depth, f"WITH {sql.TILE}, q AS (SELECT vec_id, quantile_cont(1 / depth, 0.001) AS lo, quantile_cont(1 / depth, 0.99) AS hi FROM tile WHERE depth IS NOT NULL GROUP BY vec_id) SELECT t.vec_id, u, v, floor(least(greatest(1 - (1 / depth - lo) / (hi - lo + 1e-12), 0), 1) * 255 + 1e-6)::INT AS level FROM tile t JOIN q ON t.vec_id = q.vec_id WHERE depth IS NOT NULL"),
    "depth_stats": (depth_stats, f"WITH {sql.TILE}, {_STAT} SELECT vec_id, n_valid, {sql.rounded('valid_frac', 'mean', 'std')} FROM st"),
    "sobel_gradient": (
        sobel_gradient,
        f"""WITH {sql.TILE}, s0 AS (SELECT vec_id, u, v, depth, val AS s FROM tile),
        s1 AS (SELECT *, coalesce(lead(s) OVER w, lag(s) OVER w) - coalesce(lag(s) OVER w, lead(s) OVER w) AS a, coalesce(lead(s) OVER w, lag(s) OVER w) + coalesce(lag(s) OVER w, lead(s) OVER w) + 2 * s AS b FROM s0 WINDOW w AS (PARTITION BY vec_id, v ORDER BY u)),
        s2 AS (SELECT vec_id, depth, abs(coalesce(lead(a) OVER h, lag(a) OVER h) + coalesce(lag(a) OVER h, lead(a) OVER h) + 2 * a) + abs(coalesce(lead(b) OVER h, lag(b) OVER h) - coalesce(lag(b) OVER h, lead(b) OVER h)) AS g FROM s1 WINDOW h AS (PARTITION BY vec_id, u ORDER BY v))
        SELECT vec_id, round(coalesce(avg(g) FILTER (WHERE depth > 0), 0), 6) + 0.0 AS grad_mean FROM s2 GROUP BY vec_id""",
    ),
    "openness_score": (openness_score, f"WITH {sql.TILE}, {_OPEN} SELECT vec_id, {sql.rounded('score')} FROM op"),
    "best_yaw": (best_yaw, f"WITH {sql.TILE}, {_OPEN} SELECT label, arg_max(vec_id, (round(score, 9), -vec_id)) AS vec_id, round(max(score), 6) AS score FROM op GROUP BY label"),
    "quality_gate": (
        quality_gate,
        f"""WITH {sql.TILE}, {_STAT}, {_GRAD}, {_DISP} SELECT st.vec_id, CASE WHEN round(valid_frac, 9) < 0.95 THEN 'valid_frac' WHEN n_valid < 60 THEN 'samples' WHEN round(mean, 9) < 0.95 THEN 'mean_depth'
        WHEN round(std, 9) / greatest(round(mean, 9), 1e-6) < 0.45 THEN 'rel_std' WHEN round(disp, 9) < 0.2 THEN 'dispersion' END AS reason FROM st JOIN dsp ON st.vec_id = dsp.vec_id""",
    ),
    "grid_coverage": (
        grid_coverage,
        """WITH b AS (SELECT least(7, greatest(0, floor(l_quantity / 51 * 8)))::INT AS gx, least(7, greatest(0, floor(l_discount / 0.11::DOUBLE * 8)))::INT AS gy FROM lineitem),
        c AS (SELECT gx, gy, count(*) AS n FROM b GROUP BY ALL), g AS (SELECT x.i AS gx, y.i AS gy FROM range(8) x(i), range(8) y(i))
        SELECT count(*) FILTER (WHERE coalesce(n, 0) < 500) AS cells_failing, count(*) FILTER (WHERE coalesce(n, 0) < 500) <= 21 AS ok FROM g LEFT JOIN c ON g.gx = c.gx AND g.gy = c.gy""",
    ),
    "intrinsics": (intrinsics, f"WITH {_INTR} SELECT * FROM i2"),
    "scale_intrinsics": (scale_intrinsics, f"WITH {_INTR} SELECT p_partkey, floor(cx)::INT AS w, floor(cy)::INT AS h, round(fx * 0.5::DOUBLE, 4) AS fx, round(fy * 0.5::DOUBLE, 4) AS fy, floor(cx) / 2 AS cx, floor(cy) / 2 AS cy FROM i2"),
    "camera_models": (camera_models, f"WITH {_INTR} SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'PINHOLE' WHEN 1 THEN 'SIMPLE_PINHOLE' ELSE 'SIMPLE_RADIAL' END AS model, CASE p_partkey % 3 WHEN 0 THEN printf('%.3f,%.3f,%.3f,%.3f', fx, fy, cx, cy) WHEN 1 THEN printf('%.3f,%.3f,%.3f', 0.5::DOUBLE * (fx + fy), cx, cy) ELSE printf('%.3f,%.3f,%.3f,%.3f', 0.5::DOUBLE * (fx + fy), cx, cy, 0.0::DOUBLE) END AS params FROM i2"),
    "quat_to_matrix": (quat_to_matrix, f"WITH {sql.POSE} SELECT frame, {_MATRIX} FROM mat"),
    "pose_invert": (pose_invert, f"WITH {sql.POSE}, {_CAM} SELECT frame, " + ", ".join(f"round(m{j}{i}, 6) + 0.0 AS m{i}{j}" for i in range(3) for j in range(3)) + ", " + ", ".join(f"round(-(m0{i}*tx + m1{i}*ty + m2{i}*tz), 6) + 0.0 AS t{c}" for i, c in enumerate("xyz")) + " FROM cam"),
    "rotate_axis": (rotate_axis, f"WITH {sql.POSE} SELECT frame, round(-m02, 6) + 0.0 AS fx, round(-m12, 6) + 0.0 AS fy, round(-m22, 6) + 0.0 AS fz FROM mat"),
    "pitch_roll_yaw_compose": (pitch_roll_yaw_compose, f"WITH {sql.POSE}, {_PRY} SELECT frame, {_MATRIX} FROM m"),
    "align_z_to_vec": (align_z_to_vec, f"WITH {sql.POSE}, {_ALIGN} SELECT frame, {_MATRIX} FROM m"),
    "wrap_blend_yaw": (wrap_blend_yaw, f"WITH e AS (SELECT event_id, value / 7 AS a, value / 3 AS b FROM events) SELECT event_id, round({sql.wrap('a')}, 6) + 0.0 AS wrapped, round({sql.wrap('a + 0.3 * atan2(sin(b - a), cos(b - a))')}, 4) + 0.0 AS blended FROM e"),
    "pose_meta": (pose_meta, f"WITH {sql.POSE} SELECT frame, (frame % 2)::INT AS round, printf('rgb_%05d.png', frame) AS image, printf('%.4f,%.4f,%.4f,%.4f', q1, q2, q3, q4) AS rotation FROM pose"),
    "colmap_images": (colmap_images, f"WITH {sql.POSE}, {_CAM} SELECT frame + 1 AS image_id, 1 AS camera_id, printf('rgb_%05d.png', frame) AS name, " + ", ".join(f"round(-(m0{i}*tx + m1{i}*ty + m2{i}*tz), 6) + 0.0 AS t{c}" for i, c in enumerate("xyz")) + " FROM cam"),
    "frusta_points": (frusta_points, f"WITH {sql.POSE}, {_CAM}, {_FRUSTA} SELECT frame, edge, k, " + ", ".join(f"round(m{i}0*px + m{i}1*py + m{i}2*pz + t{c}, 6) + 0.0 AS {c}" for i, c in enumerate("xyz")) + " FROM cam, sg"),
    "axes_tripod": (axes_tripod, f"WITH {sql.POSE}, {_CAM}, {_TRIPOD} SELECT frame, axis, k, {sql.rounded('x', 'y', 'z')}, r, g, b FROM trip"),
    "frusta_overlay": (
        frusta_overlay,
        f"""WITH {sql.PTS}, {sql.POSE}, {_CAM}, {_TRIPOD}, {_FRUSTA}, {_FRUSTA_WORLD} SELECT 'cloud' AS kind, {sql.rounded('x', 'y', 'z')}, r, g, b FROM pts
        UNION ALL SELECT 'frustum', {sql.rounded('x', 'y', 'z')}, 10, 10, 10 FROM fru WHERE frame % 25 = 0 UNION ALL SELECT 'axes', {sql.rounded('x', 'y', 'z')}, r, g, b FROM trip WHERE frame % 25 = 0""",
    ),
    "pose_records": (
        pose_records,
        f"WITH {sql.POSE}, {_CAM} SELECT c.frame, (c.frame % 2)::INT AS round, CASE WHEN c.frame % 2 = 0 THEN 1.5 ELSE 0.9 END::DOUBLE AS cam_height, {', '.join(f'round(c.m{i}{j}, 6) + 0.0 AS m{i}{j}' for i in range(3) for j in range(3))}, {', '.join(f'round(c.t{a}, 6) + 0.0 AS p{a}' for a in 'xyz')}, {', '.join(f'round(m.q{i}, 6) + 0.0 AS q{i}' for i in (1, 2, 3, 4))} FROM cam c JOIN mat m ON c.frame = m.frame",
    ),
    "reconstruction_images": (
        reconstruction_images,
        # a half turn about x follows the inverse rotation, so the quaternion is (x, w, z, -y)
        f"""WITH {sql.POSE}, {_CAM}, s AS (SELECT m.frame, CASE WHEN q1 < 0 THEN -1 ELSE 1 END AS f, q1, q2, q3, q4, c.* EXCLUDE (frame) FROM mat m JOIN cam c ON c.frame = m.frame)
        SELECT frame + 1 AS image_id, round(f * q1, 5) + 0.0 AS qw, round(f * q4, 5) + 0.0 AS qx, round(f * q3, 5) + 0.0 AS qy, round(-f * q2, 5) + 0.0 AS qz,
        round(-(m00*tx + m10*ty + m20*tz), 6) + 0.0 AS tx, round(-(m01*tx + m11*ty + m21*tz), 6) + 0.0 AS ty, round(-(m02*tx + m12*ty + m22*tz), 6) + 0.0 AS tz, 1 AS camera_id, printf('rgb_%05d.png', frame) AS name FROM s""",
    ),
    "capture_jitter": (capture_jitter, f"WITH {sql.POSE} SELECT frame, {', '.join(f'round({sql.normal_draw("frame", n)} * {s}, 6) + 0.0 AS {n}' for n, s in (('pitch', 0.02), ('roll', 0.01), ('height', 0.03)))} FROM pose"),
    "birdeye_px": (birdeye_px, f"WITH {sql.POSE}, b AS (SELECT min(tx) AS x0, max(tx) AS x1, min(tz) AS z0, max(tz) AS z1 FROM pose) SELECT frame, round_even((tx - x0) / greatest(x1 - x0, 1e-6) * 499, 0)::INT AS px, round_even((1 - (tz - z0) / greatest(z1 - z0, 1e-6)) * (round_even(500 * (z1 - z0) / greatest(x1 - x0, 1e-6), 0) - 1), 0)::INT AS py FROM pose, b"),
}
