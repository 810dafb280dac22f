"""Price-derived column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the small constant added to the price before dividing.
DISCOUNT_EPSILON = 1e-6


def price_vs_competitor(price: Column, competitor: Column) -> Column:
    return price.cast("double") - competitor.cast("double")


def discount_pct(discount: Column, price: Column) -> Column:
    # try_divide: a price of exactly -1e-6 gives null instead of an ANSI error.
    return F.try_divide(discount.cast("double"), price.cast("double") + F.lit(DISCOUNT_EPSILON))
