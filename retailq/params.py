"""Parameters: scope filters and rule constants (defaults are the fixed values of the original rules)."""
from __future__ import annotations

import calendar
from dataclasses import dataclass, field
from datetime import date, timedelta

# Fixed values of the original rules.
ORDER_STATUSES = ("delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved")
CORE_START, CORE_END = date(2017, 1, 1), date(2018, 7, 31)
RECENT_DAYS, REPEAT_ORDERS, AMOUNT_CENTS = 30, 2, 20000
ANOMALY_WEEKS, MAD_SCALE, MAD_MULTIPLIER, MEDIAN_SHARE, THRESHOLD_FLOOR, MIN_MEDIAN = 8, 1.4826, 3, 0.5, 10, 5
STRATA_MIN_REVIEWED = 20
QUALITY_FLAGS = ("carrier_before_purchase", "delivery_before_carrier", "delivery_before_purchase",
                 "delivered_missing_delivery_date", "delivered_missing_estimated_date", "missing_items",
                 "missing_payment", "payment_total_mismatch", "missing_review", "multiple_reviews")


def as_date(value) -> date:
    return value if isinstance(value, date) else date.fromisoformat(str(value))


@dataclass(frozen=True)
class ScopeParams:
    """Inclusive day range plus optional category/state ('' = all). Values are bound as literals."""
    start: date
    end: date
    category: str = ""
    state: str = ""
    statuses: tuple = ("delivered",)

    def __post_init__(self):
        object.__setattr__(self, "start", as_date(self.start))
        object.__setattr__(self, "end", as_date(self.end))
        if self.start > self.end:
            raise ValueError("start must not be after end")

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    def with_dates(self, start, end) -> "ScopeParams":
        return ScopeParams(start, end, self.category, self.state, self.statuses)

    def comparison(self) -> tuple[date, date, str]:
        """Full calendar month -> previous calendar month, else the previous period of equal length."""
        s, e = self.start, self.end
        prev_end = s - timedelta(days=1)
        if s.day == 1 and (s.year, s.month) == (e.year, e.month) and e.day == calendar.monthrange(e.year, e.month)[1]:
            return prev_end.replace(day=1), prev_end, "previous_calendar_month"
        return prev_end - (e - s), prev_end, "previous_equal_period"

    def previous(self) -> "ScopeParams":
        ps, pe, _ = self.comparison()
        return self.with_dates(ps, pe)


@dataclass(frozen=True)
class Coverage:
    """Recommended core window intersected with the observed delivered window."""
    core_start: date = CORE_START
    core_end: date = CORE_END


@dataclass(frozen=True)
class RfmRules:
    recent_days: int = RECENT_DAYS
    repeat_orders: int = REPEAT_ORDERS
    amount_cents: int = AMOUNT_CENTS


@dataclass(frozen=True)
class AnomalyRules:
    weeks: int = ANOMALY_WEEKS
    mad_scale: float = MAD_SCALE
    mad_multiplier: float = MAD_MULTIPLIER
    median_share: float = MEDIAN_SHARE
    floor: float = THRESHOLD_FLOOR
    min_median: float = MIN_MEDIAN


@dataclass(frozen=True)
class Profile:
    """Bundle of parameters for one dataset (the test-table adapter uses its own values)."""
    scope: ScopeParams
    coverage: Coverage = field(default_factory=Coverage)
    rfm: RfmRules = field(default_factory=RfmRules)
    anomaly: AnomalyRules = field(default_factory=AnomalyRules)
