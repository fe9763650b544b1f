"""Small helpers of the query modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded without negative zero, so that results compare across engines."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def rounding(*names: str, digits: int = 6) -> list[Column]:
    return [rounded(n, digits).alias(n) for n in names]
