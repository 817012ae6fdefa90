"""Derived attributes with one definition each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Credit bands by lowest score, best band first.
CREDIT_BANDS = [(740, "excellent"), (670, "good"), (580, "fair")]
LOWEST_CREDIT_BAND = "poor"

# States of each region.
REGION_STATES = {
    "West": ["CA", "WA", "OR", "AZ", "NV", "CO"],
    "South": ["TX", "GA", "FL", "NC", "TN"],
    "Northeast": ["NY", "NJ", "PA", "MA"],
    "Midwest": ["IL", "MN", "OH", "MI"],
}
OTHER_REGION = "Other"

# Lowest days past due of each delinquency bucket, worst bucket first.
DELINQUENCY_LADDER = [(90, "90+"), (60, "60-89"), (30, "30-59"), (1, "1-29")]
NOT_DELINQUENT = "current"
CHARGE_OFF = "charge-off"

# Attributes whose change opens a new customer version, in hash order.
TRACKED_CUSTOMER_COLUMNS = [
    "first_name",
    "last_name",
    "age",
    "annual_income",
    "credit_score",
    "credit_band",
    "dti",
    "segment",
    "home_branch_id",
]


def _step_function(value: Column, steps: list[tuple[int, str]], otherwise: str) -> Column:
    """First label whose lower bound the value reaches; NULL reaches none."""
    chain = reduce(
        lambda acc, step: acc.when(value >= step[0], step[1]),
        steps[1:],
        F.when(value >= steps[0][0], steps[0][1]),
    )
    return chain.otherwise(otherwise)


def credit_band(score: Column) -> Column:
    return _step_function(score, CREDIT_BANDS, LOWEST_CREDIT_BAND)


def delinquency_bucket(days_past_due: Column, charge_off_at: int | None = 180) -> Column:
    """Bucket of the delinquency ladder; ``charge_off_at=None`` leaves 90+ open-ended."""
    top = [(charge_off_at, CHARGE_OFF)] if charge_off_at else []
    return _step_function(days_past_due, top + DELINQUENCY_LADDER, NOT_DELINQUENT)


def branch_region(state: Column) -> Column:
    regions = iter(REGION_STATES.items())
    region, states = next(regions)
    chain = F.when(state.isin(states), region)
    for region, states in regions:
        chain = chain.when(state.isin(states), region)
    return chain.otherwise(OTHER_REGION)


def product_family(product_type: Column) -> Column:
    return F.when(product_type == "credit_card", "credit").otherwise("deposit")


def full_name(first: Column, last: Column) -> Column:
    """NULL when either part is NULL."""
    return F.concat(first, F.lit(" "), last)


def customer_row_hash(*tracked: Column) -> Column:
    """Fingerprint of the tracked attributes; a NULL counts as an empty string."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in tracked]
    return F.md5(F.concat_ws("|", *parts))
