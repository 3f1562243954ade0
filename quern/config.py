"""Settings of the marts. Business constants live here as parameters and nowhere else."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    as_of: dt.date = dt.date(2025, 8, 31)  # stands for today, so that results can be repeated
    neutral_band: float = 0.12
    min_confidence: float = 0.45
    rolling_rows: int = 7
    include_synthetic: bool = True
    risk_aspects: tuple[str, ...] = ("security", "funds")
    recent_days: int = 7
    baseline_days: tuple[int, int] = (35, 8)


DEFAULT = Config()
