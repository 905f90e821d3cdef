"""Tier, score and segment expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Tier names and day limits of the inactivity model.
CHURN_THRESHOLDS = {"high": 90, "medium": 60, "low": 30}
CHURN_TIERS = ("high_risk", "medium_risk", "low_risk", "active")

# Lowest total score of each segment, and the name below the last of them.
NTILE_SEGMENTS = ((13, "Champions"), (10, "Loyal"), (7, "At Risk"))
NTILE_REMAINDER = "Churned / Lost"
QUANTILE_SEGMENTS = ((13, "Champion"), (10, "Loyal"), (7, "At Risk"))
QUANTILE_REMAINDER = "Lost"


def churn_tier(days: Column, thresholds: Mapping[str, int] | None = None) -> Column:
    """Strictly more days than a limit puts a customer in its tier; unknown days mean 'active'."""
    limits = thresholds or CHURN_THRESHOLDS
    high, medium, low, active = CHURN_TIERS
    return (
        F.when(days > limits["high"], high)
        .when(days > limits["medium"], medium)
        .when(days > limits["low"], low)
        .otherwise(active)
    )


def by_floor(total: Column, floors: Sequence[tuple[int, str]], remainder: str) -> Column:
    """The name of the first floor that ``total`` reaches, from the highest down."""
    branch = F.when(total >= floors[0][0], floors[0][1])
    for floor, name in floors[1:]:
        branch = branch.when(total >= floor, name)
    return branch.otherwise(remainder)
