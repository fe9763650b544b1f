"""All settings of a capture, their profiles, and the rule by which explicit values, a profile and the defaults are merged."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and defaults of the settings of rendering, coverage and quality, then the profiles that overlay them.
DEFAULTS = {
    "render": {
        "seed": 1234, "out_path": "export_scene", "H": 1024, "W": 1024, "SSAA": 4, "hfov_deg": 100.0,
        "pitch_start": -5.0, "pitch_jitter": 5.0, "round_pitch_deg": [], "height_start_cm": 150.0, "height_jitter_cm": 10.0, "roll_jitter": 3.0,
        "dataset_type": "replicaCAD_baked", "dataset_path": "habitat-data/replica_cad_baked_lighting", "scene_id": "sc0_00",
    },
    "coverage": {
        "n_views": 50, "max_attempts": 30, "max_rejects_per_visit": 20, "min_geo": 1.0, "max_geo": 7.0,
        "traj_mode": "video", "n_anchors": 15, "traj_stride_m": 0.40, "min_anchor_sep_m": 2.0, "two_rounds": False, "height2_cm": 90.0, "anchor_min_clearance_m": 0.25,
        "yaw_mode": "mixed", "yaw_mixed_alpha": 0.35, "yaw_limit_deg": 25.0, "round_yaw_offset_deg": [0.0], "yaw_post_limit_deg": 12.0, "yaw_smooth_alpha": 0.35,
        "anchor_yaw_enable": False, "anchor_yaw_strength": 0.6, "anchor_yaw_tries": 24, "anchor_yaw_max_deg": 75.0,
        "anchor_yaw_min_fwd_clear_m": 0.35, "anchor_yaw_scan_deg": 60.0, "anchor_yaw_scan_steps": 11,
        "anchor_viz_scan_deg": 75.0, "anchor_viz_scan_steps": 9, "anchor_viz_pitch_deg": -5.0, "anchor_viz_center_frac": 0.28, "anchor_viz_arrow_len_m": 0.6, "save_anchor_images": False,
        "deterministic_coverage": False, "cov_offsets_deg": [0.0, 90.0, -90.0], "cov_at_same_pos": False, "cov_max_retries": 4, "coverage_rounds": [0],
    },
    "quality": {"min_normal_disp": 0.2, "min_valid_frac": 0.50, "min_rel_depth_std": 0.10, "min_grad_mean": 5.0, "min_kpts": 100, "grid_nx": 8, "grid_ny": 8, "min_kpts_per_cell": 0},
}
_DENSE = {
    "render": {"hfov_deg": 95.0, "pitch_start": -5, "height_start_cm": 150, "round_pitch_deg": [-5.0]},
    "coverage": {
        "n_views": 200, "n_anchors": 16, "min_anchor_sep_m": 1.20, "yaw_limit_deg": 24.0, "anchor_yaw_enable": True, "anchor_yaw_max_deg": 70.0,
        "anchor_yaw_min_fwd_clear_m": 0.30, "anchor_yaw_scan_deg": 50.0, "anchor_yaw_scan_steps": 9,
        "deterministic_coverage": True, "cov_offsets_deg": [20.0, -20.0, 160.0, -160.0], "max_rejects_per_visit": 16,
    },
}
_TWO_ROUNDS = {"coverage": {"two_rounds": True, "height2_cm": 120.0, "coverage_rounds": [0, 1], "max_attempts": 36}}
_ROOMS = {
    "coverage": {
        "n_views": 350, "n_anchors": 24, "traj_stride_m": 0.45, "min_anchor_sep_m": 1.60, "anchor_min_clearance_m": 0.30,
        "anchor_yaw_min_fwd_clear_m": 0.35, "anchor_yaw_scan_deg": 60.0, "anchor_yaw_scan_steps": 11, "max_attempts": 32, "max_rejects_per_visit": 18,
    },
    "quality": {"min_kpts": 110},
}


def _laid(*layers: dict) -> dict:
    """Sections of settings, later ones over earlier ones."""
    out: dict = {}
    for layer in layers:
        for section, values in layer.items():
            out[section] = out.get(section, {}) | values
    return out


PROFILES = {
    "none": {},
    "small_room_dense_1round": _DENSE,
    "small_room_dense_2round": _laid(_DENSE, _TWO_ROUNDS, {"render": {"round_pitch_deg": [-5.0, -10.0]}, "coverage": {"round_yaw_offset_deg": [0.0, 30.0], "max_rejects_per_visit": 18}}),
    "fast_debug": {
        "render": {"H": 480, "W": 640, "SSAA": 1, "hfov_deg": 95.0, "pitch_start": -5, "height_start_cm": 150},
        "coverage": {"n_views": 60, "n_anchors": 8, "traj_stride_m": 0.50, "min_anchor_sep_m": 1.5, "max_attempts": 8, "max_rejects_per_visit": 6},
        "quality": {"min_valid_frac": 0.40, "min_rel_depth_std": 0.08, "min_normal_disp": 0.15, "min_grad_mean": 4.0, "min_kpts": 60, "grid_nx": 6, "grid_ny": 6},
    },
    "multi_rooms_dense_1round": _laid(_DENSE, _ROOMS),
    "multi_rooms_dense_2round": _laid(_DENSE, _ROOMS, _TWO_ROUNDS, {"render": {"round_pitch_deg": [-5.0, -8.0]}, "coverage": {"round_yaw_offset_deg": [0.0, 25.0], "max_rejects_per_visit": 20}}),
}


def flat(sections: dict) -> dict[str, str]:
    """section.name to the value as JSON; whole numbers of settings that are fractions are written as such."""
    out = {}
    for section, values in sections.items():
        for name, value in values.items():
            if name not in DEFAULTS[section]:
                raise ValueError(f"unknown setting: {section}.{name}")
            out[f"{section}.{name}"] = json.dumps(float(value) if isinstance(DEFAULTS[section][name], float) else value)
    return out


def literal(settings: dict[str, str]) -> Column:
    """A map column of settings."""
    return F.create_map(*[F.lit(x) for item in settings.items() for x in item]) if settings else F.create_map().cast("map<string,string>")


def profile_map(name: Column) -> Column:
    """Settings of the profile of that name; an unknown one is an error, a null one is none."""
    unknown = F.raise_error(F.concat(F.lit("unknown profile: "), name)).cast("map<string,string>")
    known = F.when(name.isNull(), literal({}))
    for profile, sections in PROFILES.items():
        known = known.when(name == profile, literal(flat(sections)))
    return known.otherwise(unknown)


def merged(given: Column, profile: Column) -> Column:
    """Defaults under ``profile`` under ``given``, maps of JSON by section.name; null, empty lists and empty values give way, unknown names are errors."""
    says = lambda v: F.when(v.isNotNull() & ~v.isin("", "null", "[]", '""'), v)
    default = literal(flat(DEFAULTS))
    over = F.map_zip_with(profile, given, lambda _, p, g: F.coalesce(says(g), says(p)))
    unknown = lambda k: F.raise_error(F.concat(F.lit("unknown setting: "), k)).cast("string")
    return F.map_zip_with(default, over, lambda k, d, o: F.when(d.isNull(), unknown(k)).otherwise(F.coalesce(o, d)))
