"""Selection by path length against plain restatements over all pairs of shortest ways."""

import math

import numpy as np
import pytest

from lumenvox.operators import graph

SCENES, POINTS = 3, 40


@pytest.fixture(scope="module")
def scenes(spark):
    rng = np.random.default_rng(11)
    points, links, ways = [], [], {}
    for k in range(SCENES):
        xyz = rng.uniform(0, 1, (POINTS, 3)) * [2.0, 0.3, 1.0]
        xyz[-4:, 0] += 9.0  # an island
        gap = np.linalg.norm(xyz[:, None] - xyz[None], axis=2)
        near = (gap <= 0.45) & (gap > 0)
        d = np.where(near, gap, np.inf)
        np.fill_diagonal(d, 0)
        for m in range(POINTS):
            d = np.minimum(d, d[:, m : m + 1] + d[m : m + 1, :])
        ways[k] = d
        clear = rng.uniform(0, 0.5, POINTS)
        draw = rng.permutation(POINTS)
        for i in range(POINTS):
            anchor = i % 13 == 0
            points.append((k, i, *map(float, xyz[i]), None if i % 17 == 3 else float(clear[i]), int(draw[i]), anchor, bool(clear[i] > 0.1), float(gap[i][[0, 13, 26, 39]].min())))
        links += [(k, int(i), int(j), float(gap[i, j])) for i, j in zip(*np.nonzero(near), strict=True)]
    df = spark.createDataFrame(points, "k int, id long, x double, y double, z double, clear double, draw long, stop boolean, fits boolean, direct double")
    return df.withColumn("anchor", df["stop"]), spark.createDataFrame(links, "k int, src long, dst long, w double"), points, ways


def grouped(df, *names):
    found = {k: [] for k in range(SCENES)}
    for r in sorted(df.collect(), key=lambda r: r[1]):
        found[r[0]].append(r[names[0]] if len(names) == 1 else tuple(r[n] for n in names))
    return found


def test_tour_and_its_path(scenes):
    df, links, _, ways = scenes
    tours = grouped(graph.greedy_tour(df, links, "k"), "id")
    paths = {k: [(r.leg, r.id) for r in sorted(graph.tour_path(df, links, "k").collect(), key=lambda r: (r.leg, r.seq)) if r.k == k] for k in range(SCENES)}
    for k in range(SCENES):
        order, left = [0], {13, 26, 39}
        while reach := [j for j in left if math.isfinite(ways[k][order[-1], j])]:
            order.append(min(reach, key=lambda j: (ways[k][order[-1], j], j)))
            left.remove(order[-1])
        assert tours[k] == order and 39 not in order
        ends = [*order, order[0]] if len(order) > 1 else order
        legs = list(zip(ends, ends[1:], strict=False))
        for n, (a, b) in enumerate(legs):
            leg = [i for m, i in paths[k] if m == n]
            assert leg[0] == a and leg[-1] == b
            assert math.isclose(sum(ways[k][p, q] for p, q in zip(leg, leg[1:], strict=False)), ways[k][a, b])
        assert {m for m, _ in paths[k]} == set(range(max(1, len(legs))))


@pytest.mark.parametrize(("sep", "clearance", "vantage"), [(0.5, 0.1, 0.0), (0.9, 0.45, 0.0), (0.5, 0.0, 0.5)])
def test_spread_anchors(scenes, sep, clearance, vantage):
    df, links, points, ways = scenes
    found = grouped(graph.spread_anchors(df, links, "k", 7, sep, clearance=clearance, most_dy=0.2, vantage=vantage, near=0.2, far=0.8), "id")
    for k in range(SCENES):
        rows = sorted((p for p in points if p[0] == k), key=lambda p: p[6])
        room_of = {p[1]: math.inf if p[5] is None else p[5] for p in rows}
        level = {p[1]: p[3] for p in rows}
        picks = [next(p[1] for p in rows if room_of[p[1]] >= clearance)]
        now, room = sep, clearance
        while len(picks) < 7:
            best, score = None, -1.0
            for p in rows:
                i = p[1]
                d = [ways[k][a, i] for a in picks]
                if abs(level[i] - level[picks[0]]) > 0.2 or room_of[i] < room or not all(math.isfinite(x) and x >= now for x in d):
                    continue
                sees = [x for x in ways[k][i] if 0.2 <= x <= 0.8]
                new = min(d) + vantage * max(sees, default=0.0)
                if new > score + 1e-9:
                    best, score = i, new
            if best is not None:
                picks.append(best)
                now, room = min(now * 1.05, sep), min(room * 1.05, clearance)
                continue
            now, room = now * 0.9, room * 0.9
            if now < 0.5 * max(0.6, sep) and room < 0.6 * max(0.1, clearance):
                break
        assert found[k] == picks


def test_gap_anchors(scenes):
    df, links, points, ways = scenes
    found = grouped(graph.gap_anchors(df, links, "k", 1.5, floor=0.3, most=5), "id", "radius")
    for k in range(SCENES):
        anchors = [0, 13, 26, 39]
        expected = []
        for f in (1.0, 0.8, 0.6, 0.5):
            r = max(0.3, 1.5 * f)
            picks = []
            while len(picks) < 5:
                d = {p[1]: min(ways[k][a, p[1]] for a in anchors + picks) for p in points if p[0] == k and p[8] and not p[7] and p[9] >= 0.75 * r}
                d = {i: x for i, x in d.items() if math.isfinite(x) and x >= r}
                if not d:
                    break
                picks.append(max(d, key=lambda i: (d[i], -i)))
            if picks:
                expected = [(i, r) for i in picks]
                break
        assert found[k] == expected


def test_farthest_anchors_stay_on_the_island(scenes):
    df, links, points, ways = scenes
    found = grouped(graph.farthest_anchors(df, links, "k", 1.2, 6, 4, floor=0.4), "id", "radius")
    for k in range(SCENES):
        have, now, stalls, expected = [0, 13, 26, 39], 1.2, 0, []
        rows = sorted((p for p in points if p[0] == k and p[8] and not p[7] and math.isfinite(ways[k][0, p[1]])), key=lambda p: p[6])
        for batch in np.array_split(np.array([p[1] for p in rows]), 6):
            if len(expected) >= 4:
                break
            d = {int(i): min(ways[k][a, i] for a in have) for i in batch}
            best = max(d, key=lambda i: (round(d[i], 9), -i), default=None)
            if best is None:
                stalls += 1
                now = max(0.4, now * 0.9) if stalls % 2 == 0 else now
            elif d[best] >= now:
                expected.append((best, now))
                have.append(best)
        assert [i for i, _ in found[k]] == [i for i, _ in expected]
        assert all(math.isclose(a, b) for (_, a), (_, b) in zip(found[k], expected, strict=True))
        assert all(i < POINTS - 4 for i, _ in found[k])


def test_scenes_without_points_or_links(scenes, spark):
    df, links, _, _ = scenes
    assert graph.greedy_tour(df.limit(0), links, "k").collect() == []
    assert {r.id for r in graph.greedy_tour(df, links.limit(0), "k").collect()} == {0}


def test_spread_anchors_on_a_large_scene(spark):
    """A scene of 20,000 points: no table of all pairs of ways, and a plain check of the first picks."""
    from pyspark.sql import functions as F

    side = 142
    grid = spark.range(side * side).select(F.lit(1).alias("k"), "id", (F.col("id") % side).alias("a"), F.expr(f"id div {side}").alias("b"))
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("draw")
    points = grid.select("k", "id", F.lit(0.0).alias("y"), F.lit(1.0).alias("clear"), draw)
    steps = F.explode(F.array(F.lit(1), F.lit(side)))
    there = grid.withColumn("s", steps).filter((F.col("s") > 1) | (F.col("a") < side - 1)).select("k", F.col("id").alias("src"), (F.col("id") + F.col("s")).alias("dst"), F.lit(1.0).alias("w")).filter(F.col("dst") < side * side)
    links = there.unionByName(there.select("k", F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    found = [r.id for r in graph.spread_anchors(points, links, "k", 4, 20.0, vantage=0.5, near=1.0, far=8.0).orderBy("ord").collect()]
    way = lambda i, j: abs(i % side - j % side) + abs(i // side - j // side)
    order = [r.id for r in points.orderBy("draw", "id").collect()]
    assert found[0] == order[0]
    # every point sees a way of 8, so only the distance decides
    for n in range(1, 4):
        assert found[n] == max(order, key=lambda i: min(way(i, p) for p in found[:n]))
