"""Random draws that are the same on every run: numbers from hashes of a key and a name."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform_draw(key: Column, name: str, nth: int = 0) -> Column:
    """A number above 0 and below 1; ``nth`` 0 to 3 are independent."""
    digits = F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"/{name}"))), 1 + 8 * nth, 8)
    return (F.conv(digits, 16, 10).cast("long") + 1) / F.lit(4294967297.0)


def normal_draw(key: Column, name: str) -> Column:
    """A draw of the standard normal distribution."""
    return F.sqrt(-2 * F.log(uniform_draw(key, name, 0))) * F.cos(2 * math.pi * uniform_draw(key, name, 1))
