"""Settings shared by all operators (defaults are the warehouse's business settings)."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date


@dataclass(frozen=True)
class Params:
    # "today" for every relative-date rule; explicit so that runs are repeatable
    as_of: date
    # rows before this date are not part of partner reporting
    min_date: date = date(2021, 1, 1)

    # fixed values: business thresholds
    revenue_target_monthly: int = 2_000_000
    high_value_order: int = 1000
    customer_ltv: int = 5000
    partner_lookback_days: int = 30
    cohort_months: int = 24
    freshness_hours: int = 6

    # fixed values: monitoring thresholds
    data_completeness: float = 0.95
    data_freshness_hours: int = 24
    order_volume_anomaly: float = 0.25
    z_threshold: float = 3.0
    iqr_factor: float = 1.5

    def with_as_of(self, day: date) -> "Params":
        return replace(self, as_of=day)
