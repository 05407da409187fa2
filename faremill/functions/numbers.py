"""Exact money and ratio expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Scale 9 as in the warehouse's NUMERIC. Precision 29 leaves room for products and quotients
#: inside Spark's 38 digits without losing scale.
NUMERIC = T.DecimalType(29, 9)


def zero() -> Column:
    return F.lit(Decimal(0)).cast(NUMERIC)


def numeric(col: Column) -> Column:
    return col.cast(NUMERIC)


def money_or_zero(col: Column) -> Column:
    return F.coalesce(numeric(col), zero())


def numeric_ratio(numerator: Column, denominator: Column) -> Column:
    """Decimal quotient to 9 places; null when the denominator is null or 0."""
    return numeric(numeric(numerator) / F.nullif(numeric(denominator), zero()))


def numeric_avg(col: Column) -> Column:
    return numeric(F.avg(numeric(col)))


def hundredths_avg(col: Column) -> Column:
    """Average of a double that carries two decimals.

    Adding whole hundredths is exact, so the result does not depend on the order in which tasks
    finish or are retried.
    """
    return F.avg(F.round(col * 100).cast("long")) / 100


def net_revenue(fare: Column, processing_fee: Column, platform_fee_rate: Decimal) -> Column:
    """Fare less the platform's share and the processing fee, to 2 places; never null."""
    paid = money_or_zero(fare)
    kept = paid - paid * F.lit(platform_fee_rate) - money_or_zero(processing_fee)
    return numeric(F.round(kept, 2))


def surge_share(fare: Column, surge: Column) -> Column:
    """Part of the fare owed to surge pricing; 0 without surge."""
    extra = numeric(fare) - numeric(numeric(fare) / numeric(surge))
    return numeric(F.when(surge > 1, extra).otherwise(zero()))


def cents_to_pounds(cents: Column) -> Column:
    return F.round(F.coalesce(cents, F.lit(0)) / F.lit(100.0), 2)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient to 4 places; null when the denominator is null or 0."""
    usable = F.coalesce(denominator, F.lit(0)) != 0
    return F.when(usable, F.round(numerator / denominator, 4))


def percent(part: Column, whole: Column, places: int) -> Column:
    """Share of two counts as a percentage."""
    return F.round(part / whole * 100, places)


def money_percent(part: Column, whole: Column, places: int) -> Column:
    """Share of two amounts as a percentage; null when the whole is null or 0."""
    return numeric(F.round(numeric_ratio(part, whole) * 100, places))


def numeric_sum(col: Column) -> Column:
    return numeric(F.sum(numeric(col)))
