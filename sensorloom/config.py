"""One place for every tunable of the pipeline."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

IMPUTATION_METHODS = ("ensemble", "knn", "knn_time", "spline", "forward_fill")
# Every scoring task holds the forest: 40 bytes for each of 2 * tree_sample - 1 nodes a tree at most.
MAX_TREES, MAX_TREE_SAMPLE = 1000, 1024


@dataclass(frozen=True)
class PipelineConfig:
    test_size_days: int = 7
    max_gap_minutes: float = 10.0
    window_size: int = 60
    overlap: int = 59
    imputation: str = "ensemble"
    contamination: float = 0.07
    anomaly_fraction: float = 0.1
    n_trees: int = 100
    tree_sample: int = 256
    seed: int = 42
    forecast_steps: int = 7 * 24 * 60
    interval_width: float = 0.90
    interval_widens: bool = False
    respect_segments: bool = False
    forecast_by: tuple[str, ...] = ()

    def __post_init__(self):
        if self.window_size < 2:
            raise ValueError("window_size must be at least 2 rows")
        if not 0 <= self.overlap < self.window_size:
            raise ValueError("overlap must be in [0, window_size)")
        if self.imputation not in IMPUTATION_METHODS:
            raise ValueError(f"imputation must be one of {IMPUTATION_METHODS}")
        if not 0 < self.contamination <= 0.5:
            raise ValueError("contamination must be in (0, 0.5]")
        if not 0 < self.anomaly_fraction <= 1:
            raise ValueError("anomaly_fraction must be in (0, 1]")
        if not 1 <= self.n_trees <= MAX_TREES:
            raise ValueError(f"n_trees must be in [1, {MAX_TREES}]")
        if not 2 <= self.tree_sample <= MAX_TREE_SAMPLE:
            raise ValueError(f"tree_sample must be in [2, {MAX_TREE_SAMPLE}]")
        if self.forecast_steps < 1:
            raise ValueError("forecast_steps must be at least 1")
        if not 0 < self.interval_width < 1:
            raise ValueError("interval_width must be in (0, 1)")

    @property
    def step(self) -> int:
        return self.window_size - self.overlap

    def feature_hash(self) -> str:
        """Identifies the settings that decide stored feature values; part of the feature-store path."""
        keys = (
            "test_size_days",
            "max_gap_minutes",
            "window_size",
            "overlap",
            "imputation",
            "anomaly_fraction",
            "respect_segments",
        )
        settings = {k: v for k, v in asdict(self).items() if k in keys}
        return hashlib.md5(json.dumps(settings, sort_keys=True).encode()).hexdigest()[:12]

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> PipelineConfig:
        values = json.loads(text)
        return cls(**(values | {"forecast_by": tuple(values.get("forecast_by", ()))}))

    def conflicts(self, trained: PipelineConfig) -> list[str]:
        """Settings that must be those of the training for scores to mean the same."""
        names = ("window_size", "overlap", "imputation", "respect_segments")
        return [n for n in names if getattr(self, n) != getattr(trained, n)]
