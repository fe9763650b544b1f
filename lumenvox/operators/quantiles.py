"""Exact quantiles of a column of any length, without a sort and without gathering its values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets that an interval is cut into.
BINS = 1 << 10


def _bin(low: float, high: float) -> Column:
    """Bucket of a value in [low, high]; both ends fall into different ones."""
    scale = 0.5 if math.isinf(high - low) else 1.0
    share = (F.col("v") * scale - low * scale) / F.lit(high * scale - low * scale)
    return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")


def ranked(values: DataFrame, ranks: list[int], count: int, low: float, high: float) -> dict[int, float]:
    """The values (v, not null and finite) at ranks from 0 in ascending order.

    Each round counts the values by bucket of the intervals that hold a rank, and goes on in the rank's bucket, from its
    smallest to its largest value, until these are equal or the rank is the first or last. A round is one pass with at most
    BINS rows for each rank after it, which alone reach the driver.
    """
    known: dict[int, float] = {}
    open_ = [(low, high, 0, count, sorted(set(ranks)))]
    while open_:
        left = []
        for low, high, below, n, wanted in open_:
            for rank in wanted:
                if low == high or rank == below:
                    known[rank] = low
                elif rank == below + n - 1:
                    known[rank] = high
            if rest := [r for r in wanted if r not in known]:
                left.append((low, high, below, rest))
        if not left:
            break
        parts = [F.when(F.col("v").between(low, high), F.struct(F.lit(i).alias("part"), _bin(low, high).alias("bin"))) for i, (low, high, _, _) in enumerate(left)]
        dealt = values.select("v", F.explode(F.array_compact(F.array(*parts))).alias("p"))
        counts = dealt.groupBy("p.part", "p.bin").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
        open_ = []
        for i, (_, _, below, wanted) in enumerate(left):
            for row in sorted((r for r in counts if r["part"] == i), key=lambda r: r["bin"]):
                if inside := [r for r in wanted if below <= r < below + row["n"]]:
                    open_.append((row["low"], row["high"], below, row["n"], inside))
                below += row["n"]
    return known


def exact_quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """Quantiles of the finite values of ``column``, between two values in proportion to their ranks; None without such values."""
    v = F.col(column).cast("double")
    values = df.select(v.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    n, low, high = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return [None] * len(shares)
    at = [s * (n - 1) for s in shares]
    known = ranked(values, [f(a) for a in at for f in (math.floor, math.ceil)], n, low, high)
    ends = [(a, math.floor(a), math.ceil(a)) for a in at]
    return [known[lo] if lo == hi or known[lo] == known[hi] else (hi - a) * known[lo] + (a - lo) * known[hi] for a, lo, hi in ends]
