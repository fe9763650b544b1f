"""Operators on small tables worked out by hand or restated in plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenvox.functions import angles, geometry
from lumenvox.operators import fusion, graph, planning, raster, sequence, spatial
from lumenvox.sources import config, scenes


def test_rate_limit_of_a_half_turn(spark):
    df = spark.createDataFrame([(0, i, math.radians(a)) for i, a in enumerate((0, 90, 180))], "k int, seq long, yaw double")
    found = sorted(sequence.rate_limited(df, 20.0, "k").collect(), key=lambda r: r.seq)
    assert [round(math.degrees(r.yaw), 6) for r in found] == [0, 20, 40]


def test_rate_limit_holds_everywhere(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(k, i, float(a)) for k in range(3) for i, a in enumerate(rng.uniform(-3.1, 3.1, 50))], "k int, seq long, yaw double")
    for k in range(3):
        yaw = [r.yaw for r in sorted(sequence.rate_limited(df, 12.0, "k").filter(F.col("k") == k).collect(), key=lambda r: r.seq)]
        turn = np.angle(np.exp(1j * np.diff(yaw)))
        assert np.abs(turn).max() <= math.radians(12) + 1e-9


@pytest.mark.parametrize("stride", [0.3, 1.0, 50.0])
def test_resample(spark, stride):
    rng = np.random.default_rng(2)
    p = np.cumsum(rng.uniform(0, 1, (12, 3)), axis=0)
    df = spark.createDataFrame([(0, i, *map(float, x)) for i, x in enumerate(p)], "path_id int, seq long, x double, y double, z double")
    found = np.array([(r.x, r.y, r.z) for r in sorted(sequence.resample(df, stride).collect(), key=lambda r: r.seq)])
    s = np.r_[0, np.cumsum(np.linalg.norm(np.diff(p, axis=0), axis=1))]
    t = np.arange(0, s[-1], stride)
    expected = np.stack([np.interp(t, s, p[:, c]) for c in range(3)], axis=1)
    if np.linalg.norm(expected[-1] - p[-1]) > 1e-4:
        expected = np.vstack([expected, p[-1]])
    assert np.allclose(found, expected)


def test_resample_without_length(spark):
    df = spark.createDataFrame([(0, 0, 1.0, 1.0, 1.0), (0, 1, 1.0, 1.0, 1.0), (1, 0, 2.0, 0.0, 0.0)], "path_id int, seq long, x double, y double, z double")
    assert sorted((r.path_id, r.x) for r in sequence.resample(df, 0.5).collect()) == [(0, 1.0), (1, 2.0)]


def test_chaikin_doubles_and_keeps_ends(spark):
    df = spark.createDataFrame([(0, i, float(i), float(i * i), 0.0) for i in range(5)] + [(1, 0, 0.0, 0.0, 0.0), (1, 1, 1.0, 0.0, 0.0)], "path_id int, seq long, x double, y double, z double")
    found = sequence.chaikin(df, 2).collect()
    long = sorted((r for r in found if r.path_id == 0), key=lambda r: r.seq)
    assert len(long) == 20 and (long[0].x, long[-1].x) == (0.0, 4.0)
    assert sum(r.path_id == 1 for r in found) == 2


def test_ring_with_one_key_and_none(spark):
    keys = spark.createDataFrame([(0, 2, 5.0)], "k int, seq long, value double")
    sizes = spark.createDataFrame([(0, 4), (1, 3)], "k int, n long")
    found = {(r.k, r.seq): r.value for r in sequence.ring_interpolated(keys, sizes, "k").collect()}
    assert found == {(0, i): 5.0 for i in range(4)} | {(1, i): 0.0 for i in range(3)}


def test_min_pool_of_an_uneven_raster(spark):
    tile = [(0, u, v, None if (u, v) == (0, 0) else float(u + 7 * v)) for u in range(7) for v in range(7)]
    df = spark.createDataFrame(tile, "k int, u int, v int, depth double")
    found = {(r.u, r.v): r.depth for r in raster.min_pool(df, "k", 2, 7, 7).collect()}
    assert len(found) == 9 and found[0, 0] == 1.0 and found[2, 2] == 32.0
    empty = spark.createDataFrame([(0, 0, 0, None), (0, 1, 0, -1.0), (0, 0, 1, float("nan")), (0, 1, 1, 0.0)], df.schema)
    assert [r.depth for r in raster.min_pool(empty, "k", 2, 2, 2).collect()] == [None]


def test_gates_report_the_first_failure_and_pass_equality(spark):
    df = spark.createDataFrame([(0, 0.5, 600, 0.9, 0.9), (1, 0.6, 10, 0.1, 0.0), (2, 0.6, 500, 1.0, 0.1), (3, 0.6, 500, 0.9, 0.9)], "k int, valid_frac double, n_valid long, mean double, std double")
    limits = {"valid_frac": 0.6, "samples": 500, "mean_depth": 0.9, "rel_std": 0.1}
    found = {r.k: r.reason for r in df.select("k", raster.first_failure(df, limits).alias("reason")).collect()}
    assert found == {0: "valid_frac", 1: "samples", 2: None, 3: None}


def test_voxels_do_not_depend_on_views_or_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 4), *map(float, p), 10, 20, 31) for i, p in enumerate(rng.uniform(-1, 1, (500, 3)))] + [(0, float("nan"), 0.0, 0.0, 0, 0, 0), (0, None, 0.0, 0.0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "view int, x double, y double, z double, r int, g int, b int")
    key = lambda d: sorted((r.vx, r.vy, r.vz, r.n, round(r.cx, 9), r.g) for r in d.collect())
    whole = key(fusion.voxel_fuse(df, 0.5, 1))
    assert whole == key(fusion.voxel_fuse_by_view(df.repartition(7), 0.5, 1)) and sum(r[3] for r in whole) == 500


def test_packed_key_limits(spark):
    df = spark.createDataFrame([((1 << 20) - 1, -(1 << 20), 0)], "vx long, vy long, vz long")
    code = df.select(fusion.packed_key(*[F.col(c) for c in ("vx", "vy", "vz")]).alias("c")).first().c
    assert code == (((1 << 21) - 1) << 42) | (1 << 20)
    with pytest.raises(Exception, match="out of range"):
        df.select(fusion.packed_key(F.col("vx") + 1, F.col("vy"), F.col("vz"))).collect()


def test_rotations_are_orthonormal_and_poses_invert(spark):
    df = spark.createDataFrame([(0.1, -0.4, 0.7, 0.5), (0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 2.0)], "x double, y double, z double, w double")
    m = geometry.rotation(*[F.col(c) for c in "xyzw"])
    for r in df.select(*[m[i][j].alias(f"m{i}{j}") for i in range(3) for j in range(3)]).collect():
        a = np.array(list(r)).reshape(3, 3)
        assert np.allclose(a @ a.T, np.eye(3)) and np.isclose(np.linalg.det(a), 1)
    back, t = geometry.inverse_pose(m, (F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    again = geometry.apply(back, (F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    for r in df.select(*[(a + b).alias(f"c{i}") for i, (a, b) in enumerate(zip(again, t, strict=True))]).collect():
        assert np.allclose(list(r), 0)


def test_wrap_range(spark):
    df = spark.createDataFrame([(a,) for a in (-math.pi, math.pi, 3 * math.pi, 0.0, -7.0)], "a double")
    assert all(-math.pi <= r.w < math.pi for r in df.select(angles.wrap(F.col("a")).alias("w")).collect())


def test_nearest_far_away_and_ties(spark):
    q = spark.createDataFrame([(0, 0.0, 0.0), (1, 100.0, 0.0), (2, 0.5, 0.0)], "q long, x double, z double")
    t = spark.createDataFrame([(7, 0.0, 0.1), (9, 1.0, 0.0), (8, 0.0, -0.1)], "t long, x double, z double")
    found = {r.q: (r.t, round(r.d, 6)) for r in spatial.nearest(q, t, "q", "t", ("x", "z"), crowd=1).collect()}
    assert found == {0: (7, 0.1), 1: (9, 99.0), 2: (9, 0.5)}


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(70)] + [(i + 1, i) for i in range(70)] + [(200, 201), (201, 200)]
    links = spark.createDataFrame([(a, b, 1.0) for a, b in edges], "src long, dst long, w double")
    nodes = spark.createDataFrame([(i,) for i in [*range(71), 200, 201, 300]], "node long")
    found = {r.node: r.component for r in graph.connected(links, nodes).collect()}
    assert found == {**dict.fromkeys(range(71), 0), 200: 200, 201: 200, 300: 300}
    ways = {r.node: r.d for r in graph.geodesic(links.filter("src < 12"), nodes.filter("node = 0")).collect()}
    assert ways[10] == 10.0 and 200 not in ways


def test_baseline_repair_walks_the_ring(spark):
    path = spark.createDataFrame([(0, 0, 0.0, 0.0, 0.0), (0, 1, 0.1, 0.0, 0.0), (0, 2, 5.0, 0.0, 0.0)], "k int, seq long, x double, y double, z double")
    plan = spark.createDataFrame([(0, 0, 0, 0.0), (0, 1, 1, 0.5), (0, 2, 2, 1.0)], "k int, pos long, vi long, yaw double")
    found = [(r.vi, r.yaw) for r in sorted(planning.baseline_repaired(plan, path, "k", 1.0).collect(), key=lambda r: r.pos)]
    # the second shot is too close and goes to stop 2; the third would then repeat it and goes on to stop 0
    assert found == [(0, 0.0), (2, 0.5), (0, 1.0)]


def test_capture_schedule_rules(spark):
    phases = spark.createDataFrame([(0, 0, "coverage", 0), (0, 1, "random", 0), (0, 2, "random", 1)], "k int, ord int, phase string, round int")
    shots = spark.createDataFrame([(0, 4, [2, 0])], "k int, n_stops int, shots array<int>")

    def run(nudges, n_views=6, most=100, rejects=2):
        attempts = spark.createDataFrame([(0, i, n) for i, n in enumerate(nudges)], "k int, attempt long, nudge int")
        found = planning.capture_schedule(attempts, phases, shots, "k", n_views, 2, most, rejects).collect()
        return [(r.attempt, r.phase, r.round, r.vi) for r in sorted(found, key=lambda r: r.idx)]

    # a shot with a nudge, one that fails; the third attempt finds the playlist used up; two rejections move on to the next stop
    found = run([3, None, 0, None, None, 0, 0, 0, 0, 0])
    assert found == [(0, "coverage", 0, 2), (5, "random", 0, 1), (6, "random", 0, 2), (7, "random", 0, 3), (8, "random", 1, 0), (9, "random", 1, 1)]
    # a nudge does not help a random view, and rejections do not outlast a phase
    assert run([0, 0, 0, 2, 0, 0, 0, None, 0], n_views=5, rejects=2) == [(0, "coverage", 0, 2), (1, "coverage", 0, 0), (4, "random", 0, 0), (5, "random", 0, 1), (6, "random", 0, 2)]
    assert len(run([0] * 9, most=2)) == 2


def test_density_is_relaxed_before_the_first_test(spark):
    scenes = spark.createDataFrame([(0,), (1,), (2,)], "k int")
    anchors = lambda sep, clear, left: spark.createDataFrame([(0, 1)] * 3 + [(1, 1)] * (3 if sep < 0.7 else 1), "k int, id int")
    found = {r.k: (r.step, round(r.sep, 3), round(r.clearance, 3), r.got) for r in planning.density_targets(anchors, scenes, "k", 3, 1.0, 0.25).collect()}
    assert found == {0: (1, 0.8, 0.2, 3), 1: (2, 0.64, 0.18, 3), 2: (3, 0.6, 0.18, 0)}


def test_ways_of_several_roots_within_a_length(spark):
    links = spark.createDataFrame([(a, b, 1.0) for i in range(9) for a, b in ((i, i + 1), (i + 1, i))], "src long, dst long, w double")
    roots = spark.createDataFrame([("a", 0), ("b", 5)], "k string, node long")
    found = {(r.k, r.node): r.d for r in graph.geodesic(links, roots, "k", 2.0).collect()}
    assert found == {("a", i): float(i) for i in range(3)} | {("b", i): float(abs(i - 5)) for i in range(3, 8)}


def test_gradient_counts_valid_pixels_only(spark):
    tile = [(0, u, v, 1.0 if u < 2 else None, float(u == 3)) for u in range(4) for v in range(4)]
    df = spark.createDataFrame(tile, "k int, u int, v int, depth double, value double")
    assert raster.sobel_strength(df, "k", "value").first().grad_mean == 0.0
    every = df.withColumn("depth", F.lit(1.0))
    assert raster.sobel_strength(every, "k", "value").first().grad_mean == 1.0


def test_kinds_of_scenes(spark):
    df = spark.createDataFrame([("baked", "sc1_07"), ("scanned", "00800-Ab"), ("file", "x.glb")], "kind string, t string")
    assert [r.f for r in df.select(scenes.scene_file(F.col("kind"), "/d", F.col("t")).alias("f")).collect()] == ["Baked_sc1_staging_07.scene_instance.json", "/d/hm3d-minival-habitat-v2/00800-Ab/Ab.basis.glb", "x.glb"]
    with pytest.raises(Exception, match="unknown kind"):
        df.select(scenes.scene_file(F.lit("other"), "/d", F.col("t"))).collect()


def test_folds_go_on_from_stretch_to_stretch(spark):
    df = spark.createDataFrame([(0, i, (i % 7) / 7) for i in range(200)], "k int, seq long, yaw double")
    yaw = [r.yaw for r in sorted(sequence.smoothed(df, 8.0, 0.4, "k").collect(), key=lambda r: r.seq)]
    state = expected = None
    for i in range(200):
        step = max(-math.radians(8), min(math.radians(8), (i % 7) / 7 - state)) if i else 0.0
        state = state + 0.4 * step if i else 0.0
        expected = state
        assert math.isclose(yaw[i], expected, abs_tol=1e-9)


def test_scene_tokens(spark):
    df = spark.createDataFrame([("sc1_07",), (" sc2-3 ",), ("x.scene_instance.json",), ("other",)], "t string")
    assert [r.b for r in df.select(scenes.baked_scene(F.col("t")).alias("b")).collect()] == ["Baked_sc1_staging_07.scene_instance.json", "Baked_sc2_staging_03.scene_instance.json", "x.scene_instance.json", "other"]


def test_overlay_order():
    found = config.overlay(config.Coverage(), {"n_views": 60, "cov_offsets_deg": [0, 20]}, {"n_views": 90, "cov_offsets_deg": []})
    assert (found.n_views, found.cov_offsets_deg, found.n_anchors) == (90, [0, 20], 16)
    with pytest.raises(ValueError):
        config.overlay(config.Coverage(), {"nope": 1}, {})


def test_folds_over_ranges(spark):
    """Paths that span many ranges, with nulls and one that never comes within the limit, against plain loops."""
    import random

    wrap = lambda a: (a + math.pi) % (2 * math.pi) - math.pi
    rng = random.Random(4)
    rows, yaw = [], 0.0
    for i in range(4000):
        yaw = wrap(yaw + rng.gauss(0, 0.3))
        rows.append((1, i, None if i in (7, 2500) else yaw))
    rows += [(2, i, wrap(2.0 * i)) for i in range(500)] + [(3, 0, 1.0), (4, 0, None)]
    df = spark.createDataFrame(rows, "k int, seq long, yaw double").repartition(3)
    small = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        limited = {(r.k, r.seq): r.yaw for r in sequence.rate_limited(df, 12.0, "k").collect()}
        smooth = {(r.k, r.seq): r.yaw for r in sequence.smoothed(df, 8.0, 0.4, "k").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", small)
    assert len(limited) == len(smooth) == len(rows)
    most, soft = math.radians(12.0), math.radians(8.0)
    for k in range(1, 5):
        last = now = even = None
        for _, i, yaw in (r for r in rows if r[0] == k):
            if yaw is None:
                last = even = None
                assert limited[k, i] is None and smooth[k, i] is None
                continue
            if last is None:
                unwrapped = now = even = yaw
            else:
                step = yaw - last
                unwrapped += step if abs(step) < math.pi else wrap(step)
                now += min(max(unwrapped - now, -most), most)
                turn = math.atan2(math.sin(yaw - even), math.cos(yaw - even))
                even = wrap(even + 0.4 * min(max(turn, -soft), soft))
            last = yaw
            assert math.isclose(math.cos(limited[k, i] - now), 1.0, abs_tol=1e-9)
            assert math.isclose(math.cos(smooth[k, i] - even), 1.0, abs_tol=1e-9)


def test_corners(spark):
    """Corner scores and keypoints against a plain loop, ties and flat rasters included."""
    import random

    rng = random.Random(3)
    width, height = 14, 11
    images = {0: [[rng.randint(0, 9) for _ in range(width)] for _ in range(height)], 1: [[5] * width for _ in range(height)], 2: [[9 if u < 7 and v < 6 else 0 for u in range(width)] for v in range(height)]}
    tiles = spark.createDataFrame([(k, u, v, float(x)) for k, rows in images.items() for v, row in enumerate(rows) for u, x in enumerate(row)], "k int, u int, v int, value double")
    score = {}
    for k, g in images.items():
        for v in range(3, height - 3):
            for u in range(3, width - 3):
                d = [g[v + dv][u + du] - g[v][u] for du, dv in raster.RING]
                arcs = [[d[(i + j) % 16] for j in range(9)] for i in range(16)]
                score[k, u, v] = max(max(map(min, arcs)), -min(map(max, arcs)))
    assert {(r.k, r.u, r.v): r.score for r in raster.corner_scores(tiles, "k", "value").collect()} == score
    for t in (0.5, 3.0):
        best = {p: s for p, s in score.items() if s > t and all(not (s <= (o := score.get((p[0], p[1] + a, p[2] + b), 0)) and o > t) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b)}
        found = raster.corners(tiles, "k", "value", t)
        assert {(r.k, r.u, r.v): r.score for r in found.collect()} == best
        few = raster.corners(tiles, "k", "value", t, most=1)
        assert few.count() == len({p[0] for p in best})
        stats = {r.k: (r.n_keypoints, r.thin_cells) for r in raster.keypoint_stats(found, tiles, "k", width, height, 2, 2, 1).collect()}
        for k in images:
            own = [p for p in best if p[0] == k]
            assert stats[k] == (len(own), 4 - len({(p[1] * 2 // width, p[2] * 2 // height) for p in own}))
