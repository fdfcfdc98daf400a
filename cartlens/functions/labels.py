"""Label and flag expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label texts and day limits that results must carry.
DELAY, NO_DELAY = "Delay", "No Delay"
BEFORE_DELIVERY = "Before Delivery"
WITHIN_1_DAY = "Within 1 day"
WITHIN_2_DAYS = "Within 2 days"
WITHIN_1_WEEK = "Within 1 Week"
WITHIN_1_MONTH = "Within 1 Month"
AFTER_1_MONTH = "After 1 Month"
REVIEW_LAG_ORDER = (WITHIN_1_DAY, WITHIN_1_WEEK, WITHIN_1_MONTH, AFTER_1_MONTH, BEFORE_DELIVERY)
ANSWER_LAG_ORDER = (WITHIN_1_DAY, WITHIN_2_DAYS, WITHIN_1_WEEK, WITHIN_1_MONTH, AFTER_1_MONTH)
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Brazilian states by region; every other state counts as northern.
STATES_BY_REGION = {
    "southern": ("RS", "SC", "PR"),
    "southeastern": ("SP", "RJ", "MG", "ES"),
    "centralwestern": ("MT", "MS", "GO", "DF"),
    "northeastern": ("MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"),
}
OTHER_REGION = "northern"

CHURN_DAYS = 180


def delay_label(days_early: Column) -> Column:
    """Delay for a negative margin; an unknown margin counts as no delay."""
    return F.when(days_early < 0, DELAY).otherwise(NO_DELAY)


def review_lag_label(days: Column) -> Column:
    return (
        F.when(days < 0, BEFORE_DELIVERY)
        .when(days == 0, WITHIN_1_DAY)
        .when(days <= 7, WITHIN_1_WEEK)
        .when(days <= 31, WITHIN_1_MONTH)
        .otherwise(AFTER_1_MONTH)
    )


def answer_lag_label(days: Column) -> Column:
    """Negative lags fall under two days; an unknown lag under the last label."""
    return (
        F.when(days == 0, WITHIN_1_DAY)
        .when(days <= 2, WITHIN_2_DAYS)
        .when(days <= 7, WITHIN_1_WEEK)
        .when(days <= 31, WITHIN_1_MONTH)
        .otherwise(AFTER_1_MONTH)
    )


def region_of(
    state: Column,
    groups: Mapping[str, Sequence[str]] = STATES_BY_REGION,
    other: str = OTHER_REGION,
) -> Column:
    expr = None
    for region, states in groups.items():
        test = state.isin(*states)
        expr = F.when(test, region) if expr is None else expr.when(test, region)
    return expr.otherwise(other)


def flag(condition: Column) -> Column:
    """1 or 0; a null comparison is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def late_flag(delivered: Column, estimated: Column) -> Column:
    return flag(delivered > estimated)


def churn_flag(recency: Column, days: int = CHURN_DAYS) -> Column:
    return flag(recency > days)


def threshold_label(probability: Column, threshold: float = 0.5) -> Column:
    return F.when(probability < threshold, 0).otherwise(1)
