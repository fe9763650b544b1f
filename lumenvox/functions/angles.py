"""Angles in radians. Headings are measured about +Y: 0 looks along +Z, positive turns towards +X."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TAU = 2 * math.pi


def wrap(angle: Column) -> Column:
    """The same direction in [-pi, pi).

    The remainder is taken twice, so that all directions lie on one grid of doubles and half a turn is one value: pmod leaves what is just
    below a whole turn as it is, next to pi instead of -pi.
    """
    return ((angle + math.pi) % TAU + TAU) % TAU - math.pi


def shortest(start: Column, end: Column) -> Column:
    """Signed turn from ``start`` to ``end`` along the shorter arc."""
    return F.atan2(F.sin(end - start), F.cos(end - start))


def blend(start: Column, end: Column, share: Column | float) -> Column:
    """Heading ``share`` of the way from ``start`` to ``end`` along the shorter arc."""
    return wrap(start + share * shortest(start, end))


def towards(dx: Column, dz: Column) -> Column:
    """Heading of a horizontal displacement."""
    return F.atan2(dx, dz)


def clamp(value: Column, low: Column | float, high: Column | float) -> Column:
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    return F.least(F.greatest(value, low), high)
