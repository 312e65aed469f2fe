"""Thresholds and weights, with the defaults that a deployment may override."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class Settings:
    # Calibrated constants that results depend on.
    similarity_threshold: float = 0.72
    prominence_threshold: float = 3.0
    max_bridge_frames: int = 15
    peak_prominence: float = 3.0
    peak_separation: float = 0.12
    border: float = 0.10
    border_separation: float = 0.08
    position_tolerance: float = 0.08
    position_score: float = 0.75
    ordinal_cut: float = 0.70
    name_margin: float = 0.05
    footer_gap: float = 0.08
    row_overlap: float = 0.5
    accept_reading: float = 80.0
    accept_pair: float = 70.0
    top_k: int = 20
    sample_seconds: float = 0.4
    max_frames: int = 30
    session_gap_seconds: float = 120.0
    margin_top: int = 100
    margin_bottom: int = 200
    validation_share: float = 0.15
    seed: int = 42
    max_presentations: int = 8
    description_chars: int = 600
    appearance_weight: float = 0.72
    position_weight: float = 0.20
    order_weight: float = 0.08
    min_track_score: float = 0.68
    max_position_delta: float = 0.48
    max_gap_seconds: float = 8.5
    descriptor_momentum: float = 0.70
    video_sides: dict = field(default_factory=dict)
    video_pairs: list = field(default_factory=list)

    def merged(self, other: dict) -> Settings:
        """Right-biased, top-level merge; names that aren't settings are ignored."""
        known = {f.name for f in fields(self)}
        return replace(self, **{k: v for k, v in other.items() if k in known})


DEFAULTS = Settings()
