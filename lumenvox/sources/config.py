"""Settings: defaults, profiles that overlay them, and explicit values that win over both."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields, replace

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Quality:
    """Limits of the quality gates."""

    min_valid_frac: float = 0.0
    min_rel_depth_std: float = 0.0
    min_normal_disp: float = 0.0
    min_grad_mean: float = 0.0
    min_kpts: int = 0
    min_kpts_per_cell: int = 0


@dataclass(frozen=True)
class Coverage:
    """Budgets of a capture plan."""

    n_views: int = 200
    n_anchors: int = 16
    min_anchor_sep_m: float = 2.0
    anchor_min_clearance_m: float = 0.35
    cov_offsets_deg: tuple[float, ...] = (0.0,)
    coverage_rounds: tuple[int, ...] = (0,)


def overlay(base, profile: dict, given: dict):
    """``base`` with the fields of ``profile`` and then of ``given``; None and empty lists give way, unknown names are errors."""
    names = {f.name for f in fields(base)}
    if unknown := (profile.keys() | given.keys()) - names:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    chosen = {}
    for name in names:
        for source in (given, profile):
            value = source.get(name)
            if value is not None and value != [] and value != ():
                chosen[name] = value
                break
    return replace(base, **chosen)


def overlay_column(given: Column, profile: Column, default: Column) -> Column:
    """The same rule for a column of settings: an explicit value, else the profile's, else the default."""
    return F.coalesce(F.when(given != "", given), F.when(profile != "", profile), default)


def as_literals(settings) -> dict[str, Column]:
    return {k: F.lit(list(v) if isinstance(v, tuple) else v) for k, v in asdict(settings).items()}
