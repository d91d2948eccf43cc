"""Run constants: every date, threshold and parameter of one plan month."""

from __future__ import annotations

import calendar as _calendar
from dataclasses import dataclass
from datetime import date, timedelta


def shift_months(month: date, months: int) -> date:
    """First day of the month that lies ``months`` after ``month``."""
    index = month.year * 12 + month.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


# --- fixed values: must equal the planning rules the results are compared with ---
COMMERCE_ACTIVITY = "Коммерция"
ACTIVE_STATUS = "A"
SHIPMENT_OPERATION = 1
MARKET_CHANNEL = 1
# closed branch -> branch that took over its clients
BRANCH_RECODE = {
    "П-19 Пермь": "П-26 Киров",
    "П-02 Волгоград": "П-44 Астрахань",
    "ОГП": "ОПАС",
}
PLAN_VALUE_COLUMN = {
    "entire": "plan_value",
    "own_brand": "plan_value_stm",
    "oz": "plan_value_oz",
    "onls": "plan_value_onls",
}
EXOGENOUS = (
    "web_order_rel",
    "volume",
    "weight",
    "density",
    "med_amn",
    "nds",
    "position_count",
    "market_rel",
)
# card columns cleaned of rare values before they become model inputs
GROUPED_CATEGORIES = (
    "current_sale_loc",
    "service_flag",
    "subsegment_tp",
    "regional_capital",
    "strong_med",
    "license_tp",
    "federal",
    "inet_flag",
)
NUMERIC_CATEGORIES = (
    "value",
    "ltk",
    "claim_period",
    "turnover",
    "period_shipment",
    "current_discount_2k",
)
# short-window statistics left out of the cluster models
SHORT_WINDOW_FEATURES = (
    "mad_3",
    "mean_3",
    "std_3",
    "minmax_3",
    "minmax_mean_rel_3",
    "minmax_rel_3",
    "minmax_mean_rel_3_flag",
    "min_rel_3",
    "max_rel_3",
    "mean_32",
)
SMA_WINDOWS = (1, 3, 6, 12)
SMA_FALLBACK = "sma6"
BOOSTING_MODELS = ("cb_ms", "lgb_ms")
FIXED_LOW_TARGET = 30000.0
TURNOVER_MULTIPLE = 5.0
# ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class PlanContext:
    """Dates and thresholds derived from the plan month (a month start)."""

    plan_month: date
    history_start: date = date(2017, 11, 1)
    low_value: float = 30000.0
    own_brand_low_value: float = 500.0
    own_brand_border: float = 0.03
    rare_months: int = 6
    horizon: int = 1
    folds: int = 3
    activity: str = COMMERCE_ACTIVITY

    def __post_init__(self) -> None:
        for name in ("plan_month", "history_start"):
            if getattr(self, name).day != 1:
                raise ValueError(f"{name} must be the first day of a month")

    @classmethod
    def from_month(cls, plan_month: str | date, **overrides) -> PlanContext:
        month = date.fromisoformat(plan_month[:10]) if isinstance(plan_month, str) else plan_month
        return cls(plan_month=month, **overrides)

    @property
    def churn_from(self) -> date:
        return shift_months(self.plan_month, -3)

    @property
    def holdout(self) -> date:
        return shift_months(self.plan_month, -1)

    @property
    def card_period(self) -> date:
        return self.holdout

    @property
    def year_from(self) -> date:
        return shift_months(self.plan_month, -12)

    @property
    def history_end(self) -> date:
        """Last day before the plan month."""
        return self.plan_month - timedelta(days=1)

    @property
    def calendar_end(self) -> date:
        last = _calendar.monthrange(self.plan_month.year, self.plan_month.month)[1]
        return self.plan_month.replace(day=last)

    @property
    def cohort_base_year(self) -> int:
        return self.history_start.year

    def fold_month(self, fold: int) -> date:
        return shift_months(self.holdout, -fold)


@dataclass(frozen=True)
class AllocationLevel:
    """One set of stretch parameters; later levels are the retries of a branch."""

    level: int
    very_low: float = 1.1
    to_5: float = 0.1
    to_10: float = 0.15
    to_15: float = 0.2
    to_20: float = 0.25
    to_25: float = 0.25
    band_step: float = 0.05
    big_gap: float = 0.15
    cap: float = 0.25
    # a client is big from this target and share of wallet on
    big_target: float = 5e6
    big_share: float = 0.01
    # most of the gap, relative to the big clients, that they are given at the start
    init_gap: float = 0.24


def entire_levels(retries: int = 6, **common: float) -> list[AllocationLevel]:
    """Base parameters followed by the retries of a branch that missed its plan.

    ``common`` replaces parameters that all levels share, such as ``big_target``.
    """
    levels = [AllocationLevel(level=0, **common)]
    for i in range(1, retries + 1):
        levels.append(
            AllocationLevel(
                level=i,
                very_low=1.1 + i / 50,
                to_10=0.15 + i / 50,
                to_15=0.2 + i / 50,
                to_20=0.25 + i / 50,
                band_step=0.1 + i / 50,
                big_gap=0.18 + i / 50,
                **common,
            )
        )
    return levels


def own_brand_steps(first: float = 0.015, retries: int = 6) -> list[float]:
    """Ratchet step of the first attempt and of each retry."""
    return [first] + [0.02 + i / 50 for i in range(1, retries + 1)]
