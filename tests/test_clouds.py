"""Scene graphs that are given by a reach: the same as with their links, and no table of links."""

import math

import numpy as np
import pytest

from lumenvox.operators import graph
from lumenvox.plans import catalogue
from lumenvox.sources import tables

REACH = 0.3


def linked(xyz, reach):
    gap = np.sqrt(((xyz[:, None] - xyz[None]) ** 2).sum(axis=2))
    near = gap <= reach
    np.fill_diagonal(near, False)
    d = np.where(near, gap, np.inf)
    np.fill_diagonal(d, 0)
    for m in range(len(xyz)):
        d = np.minimum(d, d[:, m : m + 1] + d[m : m + 1, :])
    return gap, near, d


@pytest.fixture(scope="module")
def scenes(spark):
    """A crowded scene, a sparse one with islands, one with a point without a position, one of a single point."""
    rng, points, links = np.random.default_rng(4), [], []
    for k, (n, wide) in enumerate([(300, 0.2), (150, 0.5), (60, 0.3), (1, 1.0)]):
        xyz = rng.normal(0, wide, (n, 3))
        xyz[5:8] = xyz[5:6]  # equal places
        if k == 2:
            xyz[9, 0] = np.nan
        gap, near, _ = linked(xyz, REACH)
        links += [(k, int(i), int(j), float(gap[i, j])) for i, j in zip(*np.nonzero(near), strict=True)]
        draw, direct = rng.permutation(n), rng.uniform(0, 1, n)
        points += [(k, i, *map(float, xyz[i]), float(rng.uniform(0, 0.5)), int(draw[i]), i % 9 == 0, bool(rng.uniform() < 0.8), float(direct[i])) for i in range(n)]
    df = spark.createDataFrame(points, "k int, id long, x double, y double, z double, clear double, draw long, stop boolean, fits boolean, direct double")
    return df.withColumn("anchor", df["stop"]), spark.createDataFrame(links, "k int, src long, dst long, w double")


CALLS = {
    "greedy_tour": lambda df, links: graph.greedy_tour(df, links, "k"),
    "spread_anchors": lambda df, links: graph.spread_anchors(df, links, "k", 7, 0.5, clearance=0.1, vantage=0.3, near=0.3, far=0.7),
    "gap_anchors": lambda df, links: graph.gap_anchors(df, links, "k", 0.7, floor=0.2),
    "farthest_anchors": lambda df, links: graph.farthest_anchors(df, links, "k", 0.7, 6, 4, floor=0.3),
    "pair_ways": lambda df, links: graph.pair_ways(df, links, "k", 80, 200),
}


def rounded_rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.fillna(-1.0).collect())


@pytest.mark.parametrize("name", CALLS)
def test_reach_gives_what_links_give(scenes, name):
    df, links = scenes
    assert (found := rounded_rows(CALLS[name](df, REACH))) == rounded_rows(CALLS[name](df, links)) and found


def test_tour_paths_are_shortest(scenes):
    """Equal places leave it open which of them a way passes, so lengths of legs are compared."""
    df, links = scenes
    at = {(r.k, r.id): np.array([r.x, r.y, r.z]) for r in df.collect()}

    def legs(found):
        ways = {}
        for r in sorted(found.collect(), key=lambda r: (r.k, r.leg, r.seq)):
            ways.setdefault((r.k, r.leg), []).append(at[r.k, r.id])
        return {w: sum(float(np.linalg.norm(b - a)) for a, b in zip(p, p[1:], strict=False)) for w, p in ways.items()}

    mine, theirs = legs(graph.tour_path(df, REACH, "k")), legs(graph.tour_path(df, links, "k"))
    assert mine.keys() == theirs.keys() and all(math.isclose(mine[w], theirs[w], abs_tol=1e-12) for w in mine)


def test_targets_and_furthest_ways(spark):
    rng, points, targets, furthest = np.random.default_rng(8), [], {}, {}
    for k, (n, wide) in enumerate([(400, 0.25), (120, 0.4), (40, 2.0)]):
        xyz = rng.normal(0, wide, (n, 3))
        d, own, draw = linked(xyz, REACH)[2], rng.uniform(size=n) < 0.4, rng.permutation(n)
        own[3] = True
        points += [(k, i, *map(float, xyz[i]), 3, bool(own[i]), int(draw[i])) for i in range(n) if np.linalg.norm(xyz[i] - xyz[3]) <= 0.9]
        fits = [i for i in range(n) if own[i] and 0.4 <= d[3, i] <= 0.9]
        targets |= {k: min(fits, key=lambda i: draw[i])} if fits else {}
        furthest[k] = max((d[3, i] for i in fits), default=0.0)
    df = spark.createDataFrame(points, "k int, id long, x double, y double, z double, first long, own boolean, draw long")
    assert {r.k: r.id for r in graph.first_target(df, REACH, "k", 0.4, 0.9).collect()} == targets and 0 in targets
    found = {r.k: r.d for r in graph.furthest_way(df, REACH, "k", 0.4, 0.9).collect()}
    assert found.keys() == furthest.keys() and all(math.isclose(found[k], furthest[k], abs_tol=1e-12) for k in found)


NO_LINKS = ["sample_target", "far_score", "span_by_way", "greedy_tour", "path_trajectory", "farthest_anchors", "gap_anchors", "anchors_with_extras", "spread_anchors", "retarget_density"]


@pytest.mark.parametrize("name", NO_LINKS)
def test_no_table_of_links(spark, sf_dir, monkeypatch, name):
    """Links grow with the square of the points of a view; test_queries.py has the results."""

    def refuse(*_, **__):
        raise AssertionError("a table of links")

    monkeypatch.setattr(tables, "links", refuse)
    assert catalogue.queries()[name](spark, sf_dir).columns
