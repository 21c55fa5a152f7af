"""Processing parameters and the fixed lookup values of the fleet."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Settings:
    # Trips
    trip_gap_s: float = 1800.0
    max_speed_kmh: float = 200.0
    retention_days: int = 5

    # Abnormal events
    quantile: float = 95.0
    mad_limit: float = 3.0
    dominance: float = 2.0
    min_active_rows: int = 10

    # Road matching
    # How far a road point may be; None takes the nearest one however far it is.
    snap_radius_m: float | None = None
    line_points: int = 11

    # Scale: the most rows of one key that a single task may hold, the most rows that may be
    # broadcast, and the most points kept in one cell of a spatial index.
    group_rows: int = 1_000_000
    broadcast_rows: int = 200_000
    cell_points: int = 128

    def preset(self, name: str) -> "Settings":
        """These settings with the detection parameters of a named driving environment."""
        quantile, mad_limit, dominance = DETECTION_PRESETS[name]
        return replace(self, quantile=quantile, mad_limit=mad_limit, dominance=dominance)


# Detection presets as (quantile, mad limit, dominance factor).
DETECTION_PRESETS = {
    "urban": (92.0, 2.5, 1.8),
    "highway": (97.0, 3.5, 2.5),
}

# Device name prefixes of each region, in lookup order.
REGION_PREFIXES = {
    "england": ["AS", "BAE", "BR", "KEE", "MK", "SBY", "AB", "AD", "AC", "HL", "AH", "GH"],
    "sydney": ["TEBT"],
    "finland": ["HEL"],
    "ireland": ["SPIN", "XX"],
    "wales": ["SW"],
}

# Country and time zone of each region.
REGION_INFO = {
    "england": ("United Kingdom", "Europe/London"),
    "sydney": ("Australia", "Australia/Sydney"),
    "finland": ("Finland", "Europe/Helsinki"),
    "ireland": ("Ireland", "Europe/Dublin"),
    "wales": ("United Kingdom", "Europe/London"),
}

# Severity band upper bounds and their labels, by event type.
SEVERITY_LABELS = {
    "hard_brake": [
        (3, "Mild braking"),
        (6, "Moderate braking"),
        (8, "Hard braking"),
        (10, "Emergency braking"),
    ],
    "swerve": [
        (3, "Gentle lane change"),
        (6, "Sharp turn"),
        (8, "Aggressive swerving"),
        (10, "Emergency maneuver"),
    ],
    "pothole": [
        (3, "Minor bump"),
        (6, "Road irregularity"),
        (8, "Significant pothole"),
        (10, "Major road defect"),
    ],
}
