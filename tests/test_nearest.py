"""Nearest neighbours over cells that adapt to where the targets lie, against all pairs."""

import math

import numpy as np
import pytest

from lumenvox.operators import spatial


def brute(queries, targets):
    """(query, target, d) with the smallest (d, target), over all pairs of a group."""
    found = {}
    for q, g, *p in queries:
        for t, h, *r in targets:
            if g is None or g != h or any(v is None or not math.isfinite(v) for v in (*p, *r)):
                continue
            d = math.sqrt(sum((a - b) ** 2 for a, b in zip(p, r, strict=True)))
            found[q] = min(found.get(q, (math.inf, 0)), (d, t))
    return {(q, t, round(d, 9)) for q, (d, t) in found.items()}


def run(spark, queries, targets, crowd):
    q = spark.createDataFrame(queries, "q long, g string, x double, y double, z double")
    t = spark.createDataFrame(targets, "t long, g string, x double, y double, z double")
    return {(r.q, r.t, round(r.d, 9)) for r in spatial.nearest(q, t, "q", "t", crowd=crowd, on="g").collect()}


def rows(points, groups, first=0):
    return [(first + i, groups[i % len(groups)], *map(float, p)) for i, p in enumerate(points)]


@pytest.mark.parametrize("crowd", [1, 16])
def test_uneven_targets(spark, crowd):
    rng = np.random.default_rng(7)
    # two thirds within a millionth of the whole, the others far apart, some on the same place
    crowdy, wide = rng.normal(0.5, 1e-6, (120, 3)), rng.uniform(-50, 50, (60, 3))
    targets = rows(np.concatenate([crowdy, wide, wide[:9], crowdy[:9]]), ["a", "b", "a"])
    queries = rows(np.concatenate([rng.normal(0.5, 2e-6, (60, 3)), rng.uniform(-80, 80, (60, 3)), wide[:5]]), ["a", "b"], 1000)
    assert run(spark, queries, targets, crowd) == brute(queries, targets)


def test_lattice_with_ties(spark):
    lattice = [(x, y, z) for x in range(5) for y in range(5) for z in range(3)]
    targets = rows(lattice, ["a"])
    queries = rows([(x + 0.5, y + 0.5, z + 0.5) for x, y, z in lattice], ["a"])
    assert run(spark, queries, targets, 2) == brute(queries, targets)


def test_rows_without_a_place_or_group(spark):
    targets = [(1, "a", 0.0, 0.0, 0.0), (2, "a", None, 0.0, 0.0), (3, "a", float("nan"), 0.0, 0.0), (4, None, 5.0, 5.0, 5.0), (5, "a", float("inf"), 0.0, 0.0)]
    queries = [(1, "a", 1.0, 0.0, 0.0), (2, None, 5.0, 5.0, 5.0), (3, "b", 0.0, 0.0, 0.0), (4, "a", None, 0.0, 0.0), (5, "a", float("nan"), 0.0, 0.0), (1, "a", 1.0, 0.0, 0.0)]
    assert run(spark, queries, targets, 1) == {(1, 1, 1.0)}
    assert run(spark, queries, targets[1:], 1) == set()
    assert run(spark, [], targets, 1) == set()


def test_tables_of_cells_too_long_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(spatial, "FEW_CELLS", 0)
    rng = np.random.default_rng(8)
    targets, queries = rows(rng.uniform(0, 1, (90, 3)) ** 4, ["a"]), rows(rng.uniform(-0.2, 1.2, (70, 3)), ["a"])
    assert run(spark, queries, targets, 3) == brute(queries, targets)
    assert run(spark, [(i, "a", 0.1, 0.1, 0.1) for i in range(50)], targets, 3) == brute([(i, "a", 0.1, 0.1, 0.1) for i in range(50)], targets)


def test_cells_hold_few_targets_wherever_they_lie(spark):
    rng = np.random.default_rng(9)
    targets = rows(np.concatenate([rng.normal(0.0, 1e-5, (400, 3)), rng.uniform(-9, 9, (40, 3))]), ["a"])
    t = spatial._placed(spark.createDataFrame(targets, "t long, g string, x double, y double, z double"), "t", "_t", ["x", "y", "z"], "g")
    levels, held, total = spatial._cell_tree(t, 3, 8)
    sizes = [len(r.held) for r in held.collect()]
    assert max(sizes) <= 8 and sum(sizes) == len(targets) == total
    assert all(nodes.count() <= n for _, nodes, n in levels)
    assert len(levels) < 12  # levels that part no crowded cell are left out
