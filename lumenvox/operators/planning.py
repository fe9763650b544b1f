"""Coverage plans, phases and the accept/reject fold."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenvox.functions.angles import blend, wrap
from lumenvox.operators.common import settled
from lumenvox.operators.sequence import smoothed


def coverage_playlist(stops: DataFrame, key: str, offsets_deg: list[float], stride: int = 1, order: str = "offset-major", rotate: bool = True) -> DataFrame:
    """Shots of each group: key, pos, vi, yaw. ``stops`` has key, vi, yaw in the order of vi.

    offset-major takes one offset at every stop before the next one, each time starting ``stride``
    stops further on, so that the camera moves between shots; anchor-major takes all offsets of a
    stop in turn.
    """
    w = Window.partitionBy(key)
    ranked = stops.withColumns({"rank": F.row_number().over(w.orderBy("vi")) - 1, "n": F.count("*").over(w)})
    offsets = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(math.radians(o)).alias("add")) for j, o in enumerate(offsets_deg)])
    shots = ranked.select(key, "vi", "yaw", "rank", "n", F.inline(offsets))
    if order == "anchor-major":
        pos = F.col("rank") * len(offsets_deg) + F.col("j")
    else:
        shift = F.col("j") * max(1, stride) if rotate else F.lit(0)
        pos = F.col("j") * F.col("n") + F.pmod(F.col("rank") - shift, F.col("n"))
    return shots.select(key, pos.cast("long").alias("pos"), "vi", wrap(F.col("yaw") + F.col("add")).alias("yaw"))


def baseline_repaired(playlist: DataFrame, path: DataFrame, key: str, least: float) -> DataFrame:
    """The playlist with stops replaced so that consecutive ones are ``least`` apart where the ring has such a stop.

    A shot that is too close to the repaired one before takes the next stop of the ring that is far
    enough, and keeps its own stop if there is none; it keeps its yaw. Each group is one playlist.
    """
    placed = playlist.join(path.select(key, F.col("seq").alias("vi"), "x", "y", "z"), [key, "vi"])

    def repair(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("pos")
        ring = g.drop_duplicates("vi").sort_values("vi")
        stops, xyz = ring["vi"].to_numpy(), ring[["x", "y", "z"]].to_numpy()
        at = {v: i for i, v in enumerate(stops)}
        out: list[int] = []
        for vi in g["vi"]:
            i = at[vi]
            if out and np.linalg.norm(xyz[i] - xyz[out[-1]]) < least:
                others = (i + np.arange(1, len(stops))) % len(stops)
                far = np.linalg.norm(xyz[others] - xyz[out[-1]], axis=1) >= least if len(others) else np.empty(0, bool)
                i = int(others[far.argmax()]) if far.any() else i
            out.append(i)
        return pd.DataFrame({key: g[key].to_numpy(), "pos": g["pos"].to_numpy(), "vi": stops[out], "yaw": g["yaw"].to_numpy()})

    kind = playlist.schema[key].dataType.simpleString()
    return placed.groupBy(key).applyInPandas(repair, f"{key} {kind}, pos long, vi long, yaw double")


def phase_plan(scenes: DataFrame, key: str) -> DataFrame:
    """Phases of each scene (key, n_rounds, coverage_rounds array, n_shots): key, ord, phase, round.

    Coverage rounds come first where there are shots, then a random phase for every round.
    """
    rounds = F.sequence(F.lit(0), F.col("n_rounds") - 1)
    covered = F.when(F.col("n_shots") > 0, F.filter(rounds, lambda r: F.array_contains("coverage_rounds", r))).otherwise(F.array().cast("array<int>"))
    plan = F.concat(
        F.transform(covered, lambda r: F.struct(F.lit("coverage").alias("phase"), r.alias("round"))),
        F.transform(rounds, lambda r: F.struct(F.lit("random").alias("phase"), r.alias("round"))),
    )
    return scenes.select(key, F.posexplode(plan).alias("ord", "p")).select(key, "ord", "p.phase", "p.round")


def padded(values: list[float], i: Column) -> Column:
    """The i-th (from 0) of a short list, its last value beyond the end."""
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.least(i + 1, F.lit(len(values))).cast("int"))


def heading_policy(mode: str, tangent: Column, target: Column, alpha: float) -> Column:
    """Heading along the path, to a target, or between both; along the path without a target."""
    if mode == "tangent":
        return tangent
    chosen = target if mode == "target" else blend(tangent, target, alpha)
    return F.when(target.isNull(), tangent).otherwise(chosen)


def capture_schedule(attempts: DataFrame, phases: DataFrame, playlist: DataFrame, key: str, n_views: int, n_rounds: int, most_attempts: int, rejects_per_stop: int, retries: int = 4, same_pos: bool = True) -> DataFrame:
    """Accept/reject fold of each scene: key, idx, attempt, phase, round, vi, shot (place in the playlist, null for a random view).

    ``attempts`` has key, attempt (from 0) and nudge: the first of the headings tried (0: the planned one)
    that passes the gates, null if none does. ``phases`` has key, ord, phase, round and ``playlist``
    key, n_stops, shots (stops of the planned shots in order).

    A phase ends at ceil(n_views / n_rounds) accepted views; everything ends at n_views or when
    attempts are used up. A coverage phase takes the next shot of its round's playlist, accepts it at one of up to
    ``retries`` nudges, goes on to the next shot either way and ends when there is none, which costs an attempt.
    A random phase starts at the first stop, goes on to the next one after a view, or after ``rejects_per_stop``
    rejections there; a phase knows nothing of the rejections before it. The state is a few counters,
    folded over at most ``most_attempts`` attempts of a scene.
    """
    target = max(1, math.ceil(n_views / max(1, n_rounds)))
    plan = phases.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ord", "phase", "round"))).alias("plan"))
    tries = attempts.filter(F.col("attempt") < most_attempts).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("attempt", "nudge"))).alias("tries"))
    rows = tries.join(plan, key).join(playlist.select(key, "n_stops", "shots"), key)
    view = "struct<idx:bigint,attempt:bigint,phase:string,round:int,vi:bigint,shot:int>"
    long = lambda x: F.lit(x).cast("long")
    zero = F.struct(
        F.lit(0).alias("at"), long(0).alias("views"), long(0).alias("here"), long(0).alias("vi"), long(0).alias("rejected"),
        F.array_repeat(F.lit(0), max(1, n_rounds)).alias("shot"), F.array().cast(f"array<{view}>").alias("out"),
    )

    def step(s: Column, x: Column) -> Column:
        phase = F.get(F.col("plan"), s["at"])
        done = phase.isNull() | (s["views"] >= n_views)
        coverage, round_ = phase["phase"] == "coverage", phase["round"]
        shot = F.get(s["shot"], round_)
        empty = coverage & (shot >= F.size("shots"))
        start = F.when(s["vi"] >= F.col("n_stops"), long(0)).otherwise(s["vi"])
        stop = F.when(coverage, F.get(F.col("shots"), shot)).otherwise(start).cast("long")
        passed = F.coalesce(F.when(coverage, x["nudge"] <= retries).otherwise(x["nudge"] == 0), F.lit(False)) & ~empty
        full = passed & (s["here"] + 1 >= target)
        leave = empty | full
        rejected = s["rejected"] + 1
        skip = rejected >= rejects_per_stop
        wrapped = lambda v: F.pmod(v + 1, F.greatest(F.col("n_stops").cast("long"), long(1)))
        vi = F.when(coverage, F.when(passed & F.lit(not same_pos), wrapped(stop)).otherwise(s["vi"])).when(passed, start + 1).when(skip, wrapped(start)).otherwise(start)
        rejects = F.when(coverage, s["rejected"]).when(passed | skip, long(0)).otherwise(rejected)
        taken = F.array(F.struct(s["views"].alias("idx"), x["attempt"].cast("long").alias("attempt"), phase["phase"].alias("phase"), round_.cast("int").alias("round"), stop.alias("vi"), F.when(coverage, shot).alias("shot")))
        new = F.struct(
            F.when(leave, s["at"] + 1).otherwise(s["at"]).alias("at"),
            F.when(passed, s["views"] + 1).otherwise(s["views"]).alias("views"),
            F.when(leave, long(0)).when(passed, s["here"] + 1).otherwise(s["here"]).alias("here"),
            F.when(leave, long(0)).otherwise(vi).alias("vi"),
            F.when(leave, long(0)).otherwise(rejects).alias("rejected"),
            F.transform(s["shot"], lambda n, i: F.when(coverage & ~empty & (i == round_), n + 1).otherwise(n)).alias("shot"),
            F.when(passed, F.concat(s["out"], taken)).otherwise(s["out"]).alias("out"),
        )
        return F.when(done, s).otherwise(new)

    return rows.select(key, F.inline(F.aggregate("tries", zero, step)["out"]))


# Turns by which a planned shot that fails is tried again, in degrees; the first is the planned one.
NUDGES_DEG = (0.0, 5.0, -5.0, 10.0, -10.0)


def view_headings(views: DataFrame, attempts: DataFrame, shots: DataFrame, stops: DataFrame, key: str, offsets_deg: list[float], limit_deg: float, alpha: float) -> DataFrame:
    """Heading and mode of the views of ``capture_schedule``: key, idx, mode, round, vi, yaw.

    ``attempts`` are those of the schedule, ``shots`` has key, shot, yaw of the planned shots and ``stops`` key, vi, yaw of the
    stops under their heading policy; one without a heading looks along +Z. A round adds its offset, the last one where there are
    more rounds. A planned shot takes the nudge at which it passed and is not smoothed. A random view is clamped to
    the accepted one before it in its round and blended with it; rejected attempts do not count, and a round begins anew.
    """
    turned = lambda yaw: wrap(F.coalesce(yaw, F.lit(0.0)) + padded([math.radians(o) for o in offsets_deg], F.col("round")))
    coverage = F.col("phase") == "coverage"
    nudge = F.element_at(F.array(*[F.lit(math.radians(d)) for d in NUDGES_DEG]), (F.col("nudge") + 1).cast("int"))
    views = settled(views)
    planned = views.filter(coverage).join(attempts.select(key, "attempt", "nudge"), [key, "attempt"]).join(shots.select(key, "shot", "yaw"), [key, "shot"], "left")
    planned = planned.select(key, "idx", F.lit("deterministic").alias("mode"), "round", "vi", wrap(turned(F.col("yaw")) + nudge).alias("yaw"))
    way = F.concat_ws("/", F.col(key).cast("string"), "round")
    free = views.filter(~coverage).join(stops.select(key, "vi", "yaw"), [key, "vi"], "left").select(key, "idx", "round", "vi", way.alias("way"), turned(F.col("yaw")).alias("yaw"))
    smooth = smoothed(free.select("way", F.col("idx").alias("seq"), "yaw"), limit_deg, alpha, "way").withColumnRenamed("seq", "idx")
    random = free.drop("yaw").join(smooth, ["way", "idx"]).select(key, "idx", F.lit("random").alias("mode"), "round", "vi", "yaw")
    return planned.unionByName(random)


def density_targets(anchors_for, scenes: DataFrame, key: str, want: int, sep: float, clearance: float, floor: float = 0.6, least_clearance: float = 0.18, rounds: int = 3) -> DataFrame:
    """Separation and clearance of each scene at which it first has ``want`` anchors: key, step, sep, clearance, got.

    ``anchors_for(sep, clearance, scenes)`` selects anchors (key, ...) of the scenes that have too few so far. Both are relaxed to 0.8
    of themselves, not below their floors, before the first test and again up to ``rounds`` times; a scene that never gets there keeps
    the last step. Nothing is relaxed once both are at their floors, which leaves step 0.
    """
    tried = scenes.select(key, F.lit(0).alias("step"), F.lit(float(sep)).alias("sep"), F.lit(float(clearance)).alias("clearance"), F.lit(0).cast("long").alias("got"))
    left = scenes.select(key)
    for step in range(1, rounds + 1):
        new = max(floor, 0.8 * sep), max(least_clearance, 0.8 * clearance)
        if new == (sep, clearance):
            break
        sep, clearance = new
        counts = anchors_for(sep, clearance, left).groupBy(key).agg(F.count("*").alias("n"))
        found = settled(left.join(counts, key, "left").select(key, F.lit(step).alias("step"), F.lit(sep).alias("sep"), F.lit(clearance).alias("clearance"), F.coalesce("n", F.lit(0)).alias("got")))
        tried, left = tried.unionByName(found), found.filter(F.col("got") < want).select(key)
        if left.isEmpty():
            break
    return tried.groupBy(key).agg(F.max(F.struct("step", "sep", "clearance", "got")).alias("b")).select(key, "b.*")
