"""Business rules as column expressions.

A NULL operand falls through to the last label of a banding rule, so an order without a matching
dimension row counts as IN_STOCK / OK / ESTABLISHED / MISMATCH.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order states and thresholds of the business rules.
COMPLETED = "completed"
REVENUE_STATUSES = ("completed", "shipped")
HIGH_AMOUNT = 1000
MEDIUM_AMOUNT = 300
LOW_STOCK = 20
NEW_DAYS = 30
GROWING_DAYS = 180
HIGH_LIFETIME = 5000
MEDIUM_LIFETIME = 1000
PRICE_TOLERANCE = 0.01


# Parts of an amount in which it is added exactly.
UNIT = 10_000


def whole(amount: Column) -> Column:
    """An amount in whole parts of ``UNIT``."""
    return F.round(amount * UNIT).cast("long")


def banded(rules: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """The label of the first rule that holds."""
    condition, label = rules[0]
    case = F.when(condition, label)
    for condition, label in rules[1:]:
        case = case.when(condition, label)
    return case.otherwise(otherwise)


def earns_revenue(status: Column) -> Column:
    return status.isin(*REVENUE_STATUSES)


def is_high_value(amount: Column) -> Column:
    return amount >= F.lit(HIGH_AMOUNT)


def amount_band(amount: Column) -> Column:
    return banded([(amount >= HIGH_AMOUNT, "HIGH"), (amount >= MEDIUM_AMOUNT, "MEDIUM")], "LOW")


def stock_status(stock: Column) -> Column:
    return banded([(stock <= 0, "OUT_OF_STOCK"), (stock < LOW_STOCK, "LOW_STOCK")], "IN_STOCK")


def stock_risk(stock: Column) -> Column:
    return banded([(stock <= 0, "OOS"), (stock < LOW_STOCK, "LOW")], "OK")


def tenure_days(order_date: Column, signup_date: Column) -> Column:
    return F.datediff(order_date, signup_date)


def tenure_bucket(days: Column) -> Column:
    return banded([(days < NEW_DAYS, "NEW"), (days < GROWING_DAYS, "GROWING")], "ESTABLISHED")


def price_match(price: Column, catalog_price: Column) -> Column:
    return banded([(F.abs(price - catalog_price) <= PRICE_TOLERANCE, "MATCH")], "MISMATCH")


def is_price_mismatch(price: Column, catalog_price: Column) -> Column:
    """NULL when either price is missing, unlike ``price_match``."""
    return F.abs(price - catalog_price) > PRICE_TOLERANCE


def customer_segment(lifetime_value: Column) -> Column:
    return banded(
        [
            (lifetime_value > HIGH_LIFETIME, "high_value"),
            (lifetime_value > MEDIUM_LIFETIME, "medium_value"),
            (lifetime_value > 0, "low_value"),
        ],
        "no_purchases",
    )
