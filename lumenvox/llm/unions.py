"""Union of linked rows inside one task."""

from __future__ import annotations

import numpy as np


def merge(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the rows ``a[i]`` and ``b[i]`` in ``roots``, in which each row points at the smallest row of its set."""
    while True:
        ra, rb = roots[a], roots[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(roots, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := roots[roots], roots):
            roots[:] = up
