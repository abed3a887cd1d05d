"""Parameters shared by all models: reporting window, reference date and score tuning."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta


def _next_month(d: date) -> date:
    return date(d.year + d.month // 12, d.month % 12 + 1, 1)


@dataclass(frozen=True)
class ScorePoints:
    """Points and thresholds of the 0-100 health score (fixed values, tunable by the caller)."""

    # usage, 0-40
    usage_any: int = 10
    trend_growing: int = 15
    trend_net_up: int = 8
    trend_flat: int = 5
    trend_declining: int = 0
    trend_slight_down: int = 3
    breadth: tuple[tuple[int, int], ...] = ((4, 10), (3, 7), (2, 4), (1, 1))
    active_last_month: int = 5
    usage_max: int = 40
    usage_missing: int = 20
    # support, 0-30
    support_base: int = 20
    support_no_tickets: int = 15
    open_high_priority: int = 10
    satisfaction: tuple[tuple[float, int], ...] = ((4.5, 8), (3.5, 5), (2.5, 2))
    satisfaction_low: int = -3
    recovery: tuple[tuple[float, int], ...] = ((1.0, 5), (0.7, 3), (0.4, 0))
    recovery_low: int = -3
    billing_friction: int = 5
    support_max: int = 30
    support_missing: int = 15
    # financial, 0-30
    active_subscription: int = 15
    collection: tuple[tuple[float, int], ...] = ((95.0, 10), (80.0, 6), (60.0, 2))
    collection_low: int = 0
    collection_missing: int = 5
    upgrade: int = 5
    downgrade: int = -3
    commitment_downgrade: int = -2
    steady: int = 3
    overdue: int = 5
    payment_failures: int = 3
    disputed: int = 2
    auto_renew_off: int = 3
    financial_max: int = 30
    financial_missing: int = 15
    # tiers
    critical_max: int = 30
    at_risk_max: int = 60
    at_risk_share: str = "0.5"
    expansion_min_score: int = 70
    expansion_min_breadth: int = 4


@dataclass(frozen=True)
class Params:
    """One analysis run: the months reported on and the conventions used to read the raw data."""

    ref_date: date = date(2024, 3, 31)
    months: tuple[date, ...] = (date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1))
    window_days: int = 14
    id_width: int = 3
    renewal: str = "boundary"  # or "elapsed": the first renewal after the reference date
    points: ScorePoints = field(default_factory=ScorePoints)

    def __post_init__(self) -> None:
        if self.renewal not in ("boundary", "elapsed"):
            raise ValueError(f"renewal must be 'boundary' or 'elapsed', not {self.renewal!r}")
        if any(m.day != 1 for m in self.months):
            raise ValueError("months must be first days of months")
        if any(_next_month(a) != b for a, b in zip(self.months, self.months[1:])) or len(self.months) < 2:
            raise ValueError("months must be at least two consecutive months")

    @property
    def window_start(self) -> date:
        return self.months[0]

    @property
    def window_end(self) -> date:
        return _next_month(self.months[-1]) - timedelta(days=1)

    @property
    def month_labels(self) -> list[str]:
        """Column prefixes of the pivoted months: ``jan`` .. ``dec``, with the year if ambiguous."""
        short = [m.strftime("%b").lower() for m in self.months]
        if len(set(short)) == len(short):
            return short
        return [f"{s}_{m.year}" for s, m in zip(short, self.months)]
