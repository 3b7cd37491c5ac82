"""Run parameters: the as-of date, the label horizon, the delivered status and the seed.

Every operator takes its dates and thresholds from a ``Config`` instead of
hard-coding them, so the same code serves the original data and the
synthetic test tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta


@dataclass(frozen=True)
class Config:
    # Last instant covered by the data; orders delivered later are ignored.
    dataset_end: datetime = datetime(2001, 8, 1)
    # A repeat purchase counts when it falls in (first, first + horizon].
    horizon_days: int = 180
    delivered_status: str = "delivered"
    seed: int = 42
    # Thresholds of the probability sweep, in the order they are reported.
    sweep_thresholds: tuple[float, ...] = (0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05)
    test_share: float = 0.2
    folds: int = 3
    deciles: int = 10
    # The full random search: parameter draws, boosting rounds of each fit, and fits at a time.
    draws: int = 30
    trees: int = 800
    parallel_fits: int = 4
    logistic_iterations: int = 100
    # Persons with more orders than this are salted across several tasks in the label join.
    hot_key_rows: int = 1_000_000
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def first_order_cutoff(self) -> datetime:
        """Latest first purchase that still has a full horizon before ``dataset_end``."""
        return self.dataset_end - timedelta(days=self.horizon_days)


DEFAULT = Config()
