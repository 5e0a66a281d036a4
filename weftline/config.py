"""Parameters of the analysis and their file form."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

try:
    import yaml
except ImportError:  # a settings file then can't be read
    yaml = None


@dataclass(frozen=True)
class Config:
    unit: str = "sentence"
    min_df: int = 3
    min_cooc: int = 2
    min_npmi: float = 0.20
    max_edges: int = 1200
    max_nodes: int = 600
    compound_min_freq: int = 2
    compound_max_len: int = 4
    min_term_len: int = 2
    keep_pos: tuple[str, ...] = ("名詞", "動詞", "形容詞")
    layout_iterations: int = 200
    betweenness_max_nodes: int = 1200
    trend_enabled: bool = True
    recent_days: int = 7

    @classmethod
    def load(cls, path: str | None) -> Config:
        """Settings of a YAML file; a missing file gives the defaults, unknown keys are ignored, `trend` is nested."""
        if not path or not os.path.exists(path):
            return cls()
        if yaml is None:
            raise RuntimeError(f"{path}: no YAML reader is installed")
        with open(path, encoding="utf-8") as file:
            given = yaml.safe_load(file) or {}
        trend = given.pop("trend", None) or {}
        given |= {"trend_enabled": trend[k] for k in ("enabled",) if k in trend} | {k: trend[k] for k in ("recent_days",) if k in trend}
        names = {f.name for f in fields(cls)}
        known = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if k in names}
        return cls(**known)
