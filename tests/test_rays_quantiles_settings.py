import json
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lumenvox.operators import graph, planning, quantiles, spatial
from lumenvox.sources import settings


def test_rays_over_many_blocks(spark):
    rng = random.Random(3)
    cells = {(x, z) for x in range(-70, 70) for z in range(-70, 70) if rng.random() < 0.97}
    starts = [(i, rng.uniform(-60, 60), rng.uniform(-60, 60), rng.uniform(-4, 4)) for i in range(150)] + [(900, None, 0.0, 0.0), (901, 0.0, 0.0, None), (902, 1e6, 1e6, 0.0)]

    def plain(x, z, yaw):
        for n in range(1, 61):
            t = n * 0.7
            if None in (x, z, yaw) or (math.floor((x + math.sin(yaw) * t) / 1.0), math.floor((z + math.cos(yaw) * t) / 1.0)) not in cells:
                return (n - 1) * 0.7
        return 60 * 0.7

    df = spark.createDataFrame(starts, "id int, x double, z double, yaw double")
    found = spatial.forward_clearance(df, spark.createDataFrame(sorted(cells), "cx long, cz long"), ["id"], 1.0, 0.7, 60)
    assert {r["id"]: round(r["clear"], 6) for r in found.collect()} == {i: round(plain(*p), 6) for i, *p in starts}


def test_no_walkable_cells(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 0.0)], "id int, x double, z double, yaw double")
    none = spark.createDataFrame([], "cx long, cz long")
    assert spatial.forward_clearance(df, none, ["id"], 1.0, 0.5, 4).collect() == [(1, 0.0)]


SHARES = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


@pytest.mark.parametrize(
    "values",
    [
        [float(i % 7) for i in range(5000)],
        [math.exp(random.Random(5).gauss(0, 1) * 20 + i % 11) for i in range(3000)],
        [1.0 + i * 2.0**-52 for i in range(3000)],
        [-1.7e308, 1.7e308, 0.0, 5e-324, 1e-323, -5e-324],
        [2.5],
    ],
)
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None, math.nan, math.inf, -math.inf]], "v double")
    found = quantiles.exact_quantiles(df, "v", SHARES)
    ordered = sorted(values)
    for share, got in zip(SHARES, found, strict=True):
        at = share * (len(ordered) - 1)
        lo, hi = ordered[math.floor(at)], ordered[math.ceil(at)]
        assert got == (lo if lo == hi else (math.ceil(at) - at) * lo + (at - math.floor(at)) * hi) or lo <= got <= hi and np.isclose(got, np.quantile(ordered, share), rtol=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (math.nan,)], "v double")
    assert quantiles.exact_quantiles(df, "v", [0.5]) == [None]


def test_settings_are_merged(spark):
    given = [("fast_debug", {"coverage.n_views": "7", "coverage.cov_offsets_deg": "[]", "quality.min_kpts": None}), (None, {}), ("multi_rooms_dense_2round", {"coverage.height2_cm": "80.0"})]
    df = spark.createDataFrame(given, "p string, g map<string,string>")
    a, b, c = [r["m"] for r in df.select(settings.merged(F.col("g"), settings.profile_map(F.col("p"))).alias("m")).collect()]
    assert len(a) == len(b) == len(c) == 59 and b == settings.flat(settings.DEFAULTS)
    assert (a["coverage.n_views"], a["coverage.cov_offsets_deg"], a["quality.min_kpts"], a["render.pitch_start"], a["coverage.yaw_mode"]) == ("7", "[0.0, 90.0, -90.0]", "60", "-5.0", '"mixed"')
    assert (c["coverage.height2_cm"], json.loads(c["coverage.coverage_rounds"]), c["quality.min_kpts"], c["coverage.max_rejects_per_visit"]) == ("80.0", [0, 1], "110", "20")


def test_unknown_settings_are_errors(spark):
    df = spark.createDataFrame([({"coverage.nope": "1"},)], "g map<string,string>")
    with pytest.raises(PySparkException, match="unknown setting"):
        df.select(settings.merged(F.col("g"), settings.literal({}))).collect()
    with pytest.raises(PySparkException, match="unknown profile"):
        spark.createDataFrame([("huge",)], "p string").select(settings.profile_map(F.col("p"))).collect()
    with pytest.raises(ValueError, match="unknown setting"):
        settings.flat({"quality": {"nope": 1}})


def test_view_headings(spark):
    views = spark.createDataFrame([(1, 0, 0, "coverage", 0, 4, 2), (1, 1, 3, "random", 1, 0, None), (1, 2, 4, "random", 1, 1, None), (1, 3, 9, "random", 0, 1, None), (1, 4, 10, "random", 0, 8, None)], "k int, idx long, attempt long, phase string, round int, vi long, shot int")
    attempts = spark.createDataFrame([(1, i, 3 if i == 0 else 0) for i in range(12)], "k int, attempt long, nudge int")
    shots = spark.createDataFrame([(1, 2, 1.0)], "k int, shot int, yaw double")
    stops = spark.createDataFrame([(1, 0, 0.0), (1, 1, 2.0)], "k int, vi long, yaw double")
    found = {r["idx"]: r for r in planning.view_headings(views, attempts, shots, stops, "k", [0.0, 90.0], 12.0, 0.5).collect()}
    assert [found[i]["mode"] for i in range(5)] == ["deterministic", *["random"] * 4]
    turn = math.radians(12) / 2
    # the nudge that passed; a round's offset; half of the clamped turn; the next round begins anew; a stop without a heading looks along +Z
    expected = [1.0 + math.radians(10), math.pi / 2, math.pi / 2 + turn, 2.0, 2.0 - turn]
    assert [found[i]["yaw"] for i in range(5)] == pytest.approx(expected)


def test_links_are_joined_in_tasks_first(spark, monkeypatch):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(300) if i % 41] + [(rng.randrange(400, 700), rng.randrange(400, 700)) for _ in range(170)]
    parent = list(range(701))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    both = [*edges, *[(b, a) for a, b in edges]]
    rng.shuffle(both)
    monkeypatch.setattr(graph, "_LINKS_AT_ONCE", 50)
    links = spark.createDataFrame(both, "src int, dst int").repartition(5)
    found = graph.connected(links, spark.range(701).select(F.col("id").cast("int").alias("node")))
    assert {r.node: r.component for r in found.collect()} == {x: find(x) for x in range(701)}
    strings = links.selectExpr("format_string('%04d', src) src", "format_string('%04d', dst) dst")
    named = graph.connected(strings, spark.range(701).selectExpr("format_string('%04d', id) node"))
    assert {int(r.node): int(r.component) for r in named.collect()} == {x: find(x) for x in range(701)}
