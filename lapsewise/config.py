"""Build parameters, in one frozen value passed to every plan."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date


@dataclass(frozen=True)
class BuildConfig:
    """Parameters of one build.

    ``as_of`` stands where a warehouse query would ask for today's date, so that
    a build can be repeated.  ``fanout`` is ``"corrected"`` (true counts and
    sums) or ``"reference"`` (counts and sums as the many-to-many join of orders
    and items on the customer alone yields them).
    """

    as_of: date
    lookback_months: int = 6
    churn_days: int = 60
    sample_rate: float = 1.0
    short_days: int = 30
    long_days: int = 90
    step_days: int = 1
    fanout: str = "corrected"
    complete_status: str = "Complete"

    def __post_init__(self) -> None:
        if self.fanout not in ("corrected", "reference"):
            raise ValueError(f"fanout must be 'corrected' or 'reference': {self.fanout!r}")
        if not 0 < self.short_days < self.long_days:
            raise ValueError("windows must satisfy 0 < short_days < long_days")
        if self.step_days < 1 or self.churn_days < 1:
            raise ValueError("step_days and churn_days must be positive")
        if not 0.0 <= self.sample_rate <= 1.0:
            raise ValueError("sample_rate must lie in [0, 1]")

    def with_(self, **changes) -> "BuildConfig":
        return replace(self, **changes)

    @property
    def label_column(self) -> str:
        return f"label_churn_{self.churn_days}d"

    @property
    def feature_columns(self) -> list[str]:
        s, n = self.short_days, self.long_days
        return [
            f"orders_{s}d",
            f"orders_{n}d",
            f"revenue_{s}d",
            f"revenue_{n}d",
            f"avg_order_value_{n}d",
            f"distinct_products_{n}d",
            f"distinct_categories_{n}d",
            "days_since_last_order",
        ]
