"""Options of the passes: defaults, and their check against what a caller gives.

`configured(Kind, {...})` merges options over the defaults; unknown names, wrong types, numbers that are not finite, values out of
range and fractions where whole numbers are due raise ValueError. Lengths are in studs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, fields, replace
from typing import Any, TypeVar

T = TypeVar("T")
METER = 1 / 0.28
#: The heights at which bodies and facades are cut, as shares of the whole.
FRACTIONS = (0.035, 0.10, 0.18, 0.28, 0.40, 0.52, 0.64, 0.76, 0.86, 0.93, 0.98)
TRACK_FRACTIONS = (0.06, 0.14, 0.22, 0.32, 0.42, 0.52, 0.62, 0.72, 0.82, 0.90, 0.97)
FACADE_FRACTIONS = (0.08, 0.22, 0.38, 0.55, 0.72, 0.88)


def _share(default: float) -> Any:
    return field(default=default, metadata={"most": 1.0})


@dataclass(frozen=True)
class GridMassing:
    """How whole floors of a grid become a building."""

    min_area: float = 200.0
    min_width: float = 10.0
    min_floors: int = 3
    min_support_floors: int = 3
    min_valid_fraction: float = _share(0.80)
    min_height_coverage: float = _share(0.75)
    min_envelope_span: float = _share(0.80)
    min_envelope_area: float = _share(0.40)
    similarity: float = _share(0.86)
    nearby_similarity: float = _share(0.76)
    tolerance_cells: float = 0.90
    max_simplify: float = 10.0
    max_area_change: float = 0.16
    rectangle_agreement: float = _share(0.95)
    max_vertices: int = 48
    max_tiers: int = 3
    min_dominant_area: float = _share(0.95)
    max_island_cells: int = 4
    max_island_area: float = 200.0
    max_hole_cells: int = 1
    max_hole_area: float = 36.0
    max_hole_fraction: float = _share(0.01)


@dataclass(frozen=True)
class Massing:
    """How the contours of a body become a building."""

    min_height: float = 30.0
    min_area: float = 150.0
    min_width: float = 10.0
    weld_tolerance: float = 0.6
    max_seam_gap: float = 3.0
    max_corner_gap: float = 3.0
    max_corner_extension: float = 3.0
    simplify_tolerance: float = 1.2
    max_vertices: int = 64
    min_support_samples: int = 3
    min_support_span: float = _share(0.30)
    max_tiers: int = 4
    roof_fallback: bool = True


@dataclass(frozen=True)
class Incomplete:
    """When a source looks incomplete."""

    max_envelope_fraction: float = _share(0.25)
    max_largest_body_area: float = 150.0
    min_source_height_for_tiny_body: float = 60.0
    min_planned_floors: int = 3


@dataclass(frozen=True)
class Clusters:
    """Which boxes may be parts of one building."""

    max_horizontal_gap: float = 6.0
    min_vertical_overlap: float = _share(0.55)
    max_base_delta: float = 12.0
    max_top_delta: float = 30.0
    min_components: int = 2
    max_components: int = 12
    max_cluster_width: float = 900.0
    max_cluster_depth: float = 900.0
    max_subset_components: int = 6
    max_candidate_states: int = 2000
    start_root: int = 1
    root_count: int = 50
    batch_size: int = 25

    def __post_init__(self) -> None:
        if not self.min_components <= self.max_components or self.max_subset_components > self.max_components:
            raise ValueError("the numbers of components contradict each other")


#: What the massing of clusters, the slices of tracks and the grids of residual parts have instead of the defaults.
CLUSTER_MASSING = {"weld_tolerance": 0.9, "max_seam_gap": 6.0, "max_corner_gap": 6.0, "max_corner_extension": 6.0, "min_support_samples": 2, "min_support_span": 0.10}
TRACK_SLICES = {"weld_tolerance": 0.8, "max_seam_gap": 4.0, "max_corner_gap": 4.0, "max_corner_extension": 4.0, "simplify_tolerance": 1.2, "min_area": 150.0, "min_width": 10.0}
RESIDUAL_GRID = {
    "min_floors": 2, "min_support_floors": 2, "min_valid_fraction": 0.67, "min_height_coverage": 0.60, "min_envelope_span": 0.60, "min_envelope_area": 0.30, "similarity": 0.82, "nearby_similarity": 0.72, "min_dominant_area": 0.92,
}


@dataclass(frozen=True)
class Tracks:
    """When a loop is the continuation of one in the slice below, and what a track and its bindings need."""

    region_padding: float = 12.0
    min_track_samples: int = 3
    min_track_span: float = _share(0.18)
    min_track_height: float = 30.0
    max_first_fraction: float = _share(0.22)
    min_last_fraction: float = _share(0.50)
    max_centroid_shift: float = 18.0
    min_area_ratio: float = _share(0.78)
    max_shape_distance: float = 8.0
    min_ground_coverage: float = _share(0.78)
    min_volume_coverage: float = _share(0.72)
    min_binding_overlap: float = _share(0.05)
    min_area_coverage: float = 0.45
    max_area_coverage: float = 1.45


@dataclass(frozen=True)
class Split:
    """How a source is split into bodies."""

    min_body_floors: int = 2
    max_bodies: int = 12
    max_tiny_cells: int = 4
    max_tiny_fraction: float = _share(0.05)
    max_sources: int = 50


@dataclass(frozen=True)
class Residual:
    """How parts of a source are taken and the rest kept."""

    max_sources: int = 20
    max_tiny_cells: int = 4
    min_extract_fraction: float = _share(0.02)
    structural_residual: bool = True


@dataclass(frozen=True)
class Final:
    """What the last pass makes of what is left."""

    max_sources: int = 50
    min_segment_cells: int = 5
    min_width: float = 10.0
    min_height: float = 30.0
    max_bodies: int = 12


@dataclass(frozen=True)
class Cleanup:
    """What counts as a fragment."""

    max_floor_area: float = 250.0
    max_envelope_volume: float = 24_000.0
    max_slab_volume: float = 6_000.0
    max_short_height: float = 35.0
    elevated_clearance: float = 20.0
    ground_ray_rise: float = 500.0
    ground_ray_depth: float = 2_000.0
    example_count: int = 25


#: Bounds of the histograms of a fragment report.
CLEANUP_BOUNDS = {
    "floor_area": (100, 250, 500, 1000, 2500, 10000), "envelope_volume": (10000, 24000, 50000, 100000, 500000, 2000000), "slab_volume": (1000, 3000, 6000, 12000, 30000, 100000),
    "height": (20, 35, 60, 100, 200, 500), "ground_clearance": (0, 5, 20, 50, 100, 250), "floors": (1, 2, 3, 5, 10, 20),
}


@dataclass(frozen=True)
class Generator:
    """Sizes of generated buildings."""

    floor_clear: float = 3.5 * METER
    min_floor_clear: float = 2.0 * METER
    slab: float = 1.5 * METER
    core_ratio: float = _share(0.40)
    small_core_ratio: float = _share(0.35)
    small_building: float = 150.0
    max_ring_depth: float = 10 * METER
    min_ring_depth: float = 2 * METER
    min_core: float = 4 * METER
    core_wall: float = 1.0


@dataclass(frozen=True)
class Hits:
    """What a hit does."""

    strength: float = 6000.0
    drag: float = 10.0
    hole_radius: float = 50.0
    dust_cooldown: float = 0.3
    brace_delay: float = 0.75
    stop_speed: float = 1.0
    stand_speed: float = 8.0
    trail_drop: float = 3.5
    overlap_shrink: float = _share(0.75)


def configured(kind: type[T], options: dict[str, Any] | None = None) -> T:
    """kind with options over its defaults, checked."""
    known = {f.name: f for f in fields(kind)}
    base = kind()
    for name, value in (options or {}).items():
        if name not in known:
            raise ValueError(f"unknown option: {name}")
        default = getattr(base, name)
        if isinstance(default, bool):
            if not isinstance(value, bool):
                raise ValueError(f"{name} must be true or false")
            continue
        if isinstance(value, bool) or not isinstance(value, (int, float)) or not math.isfinite(value) or value <= 0:
            raise ValueError(f"{name} must be a positive number")
        if isinstance(default, int) and value != int(value):
            raise ValueError(f"{name} must be a whole number")
        if value > known[name].metadata.get("most", math.inf):
            raise ValueError(f"{name} must be at most {known[name].metadata['most']:g}")
    return replace(base, **(options or {}))
