"""Operators over ordered paths and heading sequences. Order is always an explicit column."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenvox.functions.angles import TAU, towards, wrap
from lumenvox.operators.common import settled

AXES = ("x", "y", "z")
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _along(key: str):
    return Window.partitionBy(key).orderBy("seq")


def step_length(key: str) -> Column:
    """Distance from the row before; null for a path's first row."""
    w = _along(key)
    return F.sqrt(sum(((F.col(c) - F.lag(c).over(w)) ** 2 for c in AXES[1:]), (F.col("x") - F.lag("x").over(w)) ** 2))


def arc_length(path: DataFrame, key: str = "path_id") -> DataFrame:
    """Adds step (0 for the first row) and s, the length of the path up to the row."""
    upto = _along(key).rowsBetween(Window.unboundedPreceding, 0)
    return path.withColumn("step", F.coalesce(step_length(key), F.lit(0.0))).withColumn("s", F.sum("step").over(upto))


def path_yaws(path: DataFrame, key: str = "path_id") -> DataFrame:
    """Adds yaw, the heading of the step to each row; the first row takes that of the second."""
    w = _along(key)
    own = towards(F.col("x") - F.lag("x").over(w), F.col("z") - F.lag("z").over(w))
    return path.withColumn("_own", own).withColumn("yaw", F.coalesce("_own", F.lead("_own").over(w), F.lit(0.0))).drop("_own")


def _segments(path: DataFrame, key: str) -> DataFrame:
    """Each row with the next one of its path (x1, y1, z1; null for the last)."""
    w = _along(key)
    return path.select(key, "seq", *AXES, *[F.lead(c).over(w).alias(f"{c}1") for c in AXES])


def resample(path: DataFrame, stride: float, key: str = "path_id") -> DataFrame:
    """Points every ``stride`` along each path, and its end if that is further than 1e-4 from the last of them.

    A position belongs to the first segment that reaches it; each segment makes its own positions,
    so no position is searched for. A path of no length gives its first point.
    """
    measured = arc_length(path, key)
    w = _along(key)
    total = F.max("s").over(Window.partitionBy(key))
    seg = measured.withColumn("total", total).withColumn("s0", F.lag("s").over(w))
    seg = seg.select(key, "seq", "s", "s0", "total", *AXES, *[F.lag(c).over(w).alias(f"{c}0") for c in AXES])
    # position k * stride with s0 < k * stride <= s, and below the total; position 0 is the first point
    first = seg.filter("s0 is null").select(key, F.lit(0).cast("long").alias("k"), *AXES, "total")
    k0, k1 = F.floor(F.col("s0") / stride) + 1, F.floor(F.col("s") / stride)
    ks = F.when(k1 >= k0, F.sequence(k0, k1)).otherwise(F.array().cast("array<bigint>"))
    inner = seg.filter("s0 is not null and s > s0").withColumn("k", F.explode(ks)).withColumn("t", F.col("k") * stride)
    inner = inner.filter((F.col("t") > F.col("s0")) & (F.col("t") <= F.col("s")) & (F.col("t") < F.col("total")))
    u = (F.col("t") - F.col("s0")) / (F.col("s") - F.col("s0"))
    inner = inner.select(key, F.col("k").cast("long").alias("k"), *[((1 - u) * F.col(f"{c}0") + u * F.col(c)).alias(c) for c in AXES], "total")
    sampled = first.unionByName(inner)
    ends = path.groupBy(key).agg(F.max_by(F.struct(*AXES), "seq").alias("e"))
    last = sampled.groupBy(key).agg(F.max_by(F.struct(*AXES, "k", "total"), "k").alias("p")).join(ends, key)
    gap = F.sqrt(sum(((F.col(f"e.{c}") - F.col(f"p.{c}")) ** 2 for c in AXES[1:]), (F.col("e.x") - F.col("p.x")) ** 2))
    end = last.filter((F.col("p.total") > 0) & (gap > 1e-4)).select(key, (F.col("p.k") + 1).alias("k"), *[F.col(f"e.{c}").alias(c) for c in AXES])
    return sampled.drop("total").unionByName(end).withColumnRenamed("k", "seq")


def densify(path: DataFrame, longest: float, key: str = "path_id") -> DataFrame:
    """Inserts floor(length / longest) points at equal distances into each segment: key, seq, k, x, y, z.

    A length within a millionth of the next multiple counts as it, so that segments of a resampled path, all as long as the stride, are treated alike.
    """
    seg = _segments(path, key)
    length = F.sqrt(sum(((F.col(f"{c}1") - F.col(c)) ** 2 for c in AXES[1:]), (F.col("x1") - F.col("x")) ** 2))
    n = F.coalesce(F.floor(length / longest + 1e-6), F.lit(0)).cast("long")
    seg = seg.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n"))))
    u = F.col("k") / (F.col("n") + 1)
    return seg.select(key, "seq", "k", *[F.when(F.col("k") == 0, F.col(c)).otherwise((1 - u) * F.col(c) + u * F.col(f"{c}1")).alias(c) for c in AXES])


def chaikin(path: DataFrame, passes: int = 2, key: str = "path_id") -> DataFrame:
    """Corner cutting that keeps both ends; paths of fewer than three points stay as they are."""
    whole = Window.partitionBy(key)
    for _ in range(passes):
        seg = _segments(path.select(key, "seq", *AXES), key).withColumns({"n": F.count("*").over(whole), "at": F.row_number().over(_along(key))})
        here, there = {c: F.col(c) for c in AXES}, {c: F.col(f"{c}1") for c in AXES}
        near = F.struct(F.lit(1).alias("o"), *[(0.75 * here[c] + 0.25 * there[c]).alias(c) for c in AXES])
        far = F.struct(F.lit(2).alias("o"), *[(0.25 * here[c] + 0.75 * there[c]).alias(c) for c in AXES])
        own = F.struct(F.lit(0).alias("o"), *[here[c].alias(c) for c in AXES])
        last = F.col("at") == F.col("n")
        parts = F.when(F.col("n") < 3, F.array(own)).when(last, F.array(own)).when(F.col("at") == 1, F.array(own, near, far)).otherwise(F.array(near, far))
        cut = seg.select(key, "at", F.explode(parts).alias("p"))
        order = Window.partitionBy(key).orderBy("at", "p.o")
        path = cut.select(key, (F.row_number().over(order) - 1).cast("long").alias("seq"), *[F.col(f"p.{c}").alias(c) for c in AXES])
    return path.select(key, "seq", *AXES)


def unwrapped(df: DataFrame, key: str) -> DataFrame:
    """``yaw`` without jumps of more than half a turn."""
    w = _along(key)
    step = F.col("yaw") - F.lag("yaw").over(w)
    folded = wrap(step)
    folded = F.when((folded == -math.pi) & (step > 0), F.lit(math.pi)).otherwise(folded)
    fix = F.when(F.abs(step) < math.pi, F.lit(0.0)).otherwise(folded - step)
    df = df.withColumn("_fix", F.coalesce(fix, F.lit(0.0)))
    return df.withColumn("yaw", F.col("yaw") + F.sum("_fix").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_fix")


def _wrapped(yaw: float) -> float:
    """``wrap`` for a number, to the bit."""
    return math.fmod(math.fmod(yaw + math.pi, TAU) + TAU, TAU) - math.pi


def _limit(most: float) -> Callable:
    """A step of the rate limit over unwrapped headings; the state is the limited heading before."""

    def step(state: float | None, yaw: float) -> tuple[float, float]:
        new = yaw if state is None else state + min(max(yaw - state, -most), most)
        return new, _wrapped(new)

    return step


def _smooth(most: float, alpha: float) -> Callable:
    """A step of clamping and blending; the state is the smoothed heading before."""

    def step(state: float | None, yaw: float) -> tuple[float, float]:
        if state is None:
            return yaw, yaw
        turn = math.atan2(math.sin(yaw - state), math.cos(yaw - state))
        new = _wrapped(state + min(max(turn, -most), most))
        if alpha > 0:
            new = _wrapped(state + alpha * math.atan2(math.sin(new - state), math.cos(new - state)))
        return new, new

    return step


def _folded(df: DataFrame, key: str, step: Callable) -> DataFrame:
    """Runs ``step(state, yaw)``, which gives the new state and a heading, over each path in order: key, seq, yaw; the first state is None.

    Paths are cut into stretches by ranges of (key, seq), so a path of any length is spread over many tasks, and each task
    goes over its rows once. A path that goes on in the next range hands its last state on: the stretches that span ranges are
    run from what the ones before them ended with until none begins with another state. Where headings come within reach of
    their limits now and then, as they do in real paths, the state soon forgets where it began, and two rounds are enough; a
    path that never does needs a round for each range. Only states of stretches that begin with a range, one for each, are on the driver.
    A null heading stays null, and the fold begins anew after it.
    """
    placed = df.select(key, "seq", F.col("yaw").cast("double").alias("yaw"))
    placed = settled(placed.repartitionByRange(F.col(key), F.col("seq")).withColumn("_part", F.spark_partition_id()))
    kind = df.schema[key].dataType.simpleString()

    def run(begin: dict, ends: bool) -> Callable:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, state, last = None, None, None
            for b in batches:
                keys, parts, yaws = (b.column(c).to_pylist() for c in (0, 3, 2))
                out: list = []
                closed: list[tuple] = []
                for k, part, yaw in zip(keys, parts, yaws, strict=True):
                    if (k, part) != at:
                        if at is not None:
                            closed.append((*at, state))
                        at = (k, part)
                        state = begin.get(at)
                    if yaw is None:
                        state, last = None, None
                    else:
                        state, last = step(state, yaw)
                    out.append(last)
                if ends:
                    yield told(closed)
                else:
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.float64())], [key, "seq", "yaw"])
            if ends and at is not None:
                yield told([(*at, state)])

        def told(closed: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k for k, *_ in closed], pa.from_numpy_dtype("int64") if kind in _WHOLE else None), pa.array([p for _, p, _ in closed], pa.int32()), pa.array([s for *_, s in closed], pa.float64())], [key, "_part", "state"])

        return work

    ordered = lambda rows: rows.repartition("_part").sortWithinPartitions("_part", key, "seq").select(key, "seq", "yaw", "_part")
    spans = placed.groupBy(key).agg(F.min("_part").alias("a"), F.max("_part").alias("b")).filter("a < b")
    found = placed.select(key, "_part").distinct().join(F.broadcast(spans.select(key)), key, "left_semi").collect()  # at most two for each range
    parts: dict = {}
    for r in sorted(found, key=lambda r: r["_part"]):
        parts.setdefault(r[key], []).append(r["_part"])
    before = {(k, b): (k, a) for k, own in parts.items() for a, b in zip(own, own[1:], strict=False)}
    begin: dict = {}
    changed = {(k, p) for k, own in parts.items() for p in own}
    while changed:
        where = placed.filter(F.col("_part").isin(sorted({p for _, p in changed})) & F.col(key).isin(list({k for k, _ in changed})))
        told = ordered(where).mapInArrow(run(begin, True), f"{key} {'long' if kind in _WHOLE else kind}, _part int, state double").collect()
        ends = {(r[key], r["_part"]): r["state"] for r in told}
        new = {at: ends[prior] for at, prior in before.items() if prior in ends}
        changed = {at for at, state in new.items() if repr(state) != repr(begin.get(at))}  # to the bit
        begin = begin | {at: new[at] for at in changed}
    return ordered(placed).mapInArrow(run(begin, False), f"{key} {kind}, seq {df.schema['seq'].dataType.simpleString()}, yaw double")


def rate_limited(df: DataFrame, limit_deg: float, key: str) -> DataFrame:
    """Headings, unwrapped, whose steps are clamped against the clamped row before: key, seq, yaw in [-pi, pi)."""
    return _folded(unwrapped(df, key), key, _limit(math.radians(limit_deg)))


def smoothed(df: DataFrame, limit_deg: float, alpha: float, key: str) -> DataFrame:
    """Headings clamped to the last smoothed one and blended with it: key, seq, yaw."""
    return _folded(df, key, _smooth(math.radians(limit_deg), alpha))


def ring_interpolated(keys: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """Values between keys on a ring of n places: key, seq, value.

    ``keys`` has key, seq, value and ``sizes`` key, n; a ring without keys is 0 everywhere, one
    key is constant, and the last key leads on to the first.
    """
    w, whole = _along(key), Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ring = keys.join(sizes, key).select(
        key,
        "seq",
        "value",
        "n",
        F.coalesce(F.lead("seq").over(w), F.first("seq").over(whole) + F.col("n")).alias("to"),
        F.coalesce(F.lead("value").over(w), F.first("value").over(whole)).alias("next"),
    )
    filled = ring.withColumn("t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("to") - F.col("seq") - 1)))
    u = F.col("t") / (F.col("to") - F.col("seq"))
    filled = filled.select(key, ((F.col("seq") + F.col("t")) % F.col("n")).alias("seq"), ((1 - u) * F.col("value") + u * F.col("next")).alias("value"))
    places = sizes.select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("seq"))
    return places.join(filled, [key, "seq"], "left").fillna(0.0, ["value"])


def thinned(path: DataFrame, every: int, key: str = "path_id") -> DataFrame:
    """Every ``every``-th row and the last one of each path."""
    last = F.max("seq").over(Window.partitionBy(key))
    return path.withColumn("_last", last).filter((F.col("seq") % every == 0) | (F.col("seq") == F.col("_last"))).drop("_last")


def thinned_at_most(path: DataFrame, every: int, most: int, key: str = "path_id") -> DataFrame:
    """The first ``most`` rows of each path's every ``every``-th ones."""
    nth = F.row_number().over(_along(key))
    return path.filter(F.col("seq") % every == 0).withColumn("_nth", nth).filter(F.col("_nth") <= most).drop("_nth")
