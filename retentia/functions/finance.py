"""Ratios, rounding and movement classes for revenue figures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_up(x: Column, digits: int) -> Column:
    """Decimal rounding of a double, so that 0.285 gives 0.29 whatever its binary form."""
    return F.round(x.cast("decimal(28,10)"), digits).cast("double")


def exact_avg(x: Column) -> Column:
    """Average of a decimal or integer column: exact sum, one division; independent of row order."""
    return F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0))


def safe_divide(num: Column, den: Column, default: Column | None = None) -> Column:
    """``num / den`` as a double; ``default`` (NULL) where the divisor is 0 or NULL."""
    default = F.lit(None).cast("double") if default is None else default
    safe_den = F.nullif(den, F.lit(0)).cast("double")
    return F.when(safe_den.isNull(), default).otherwise(num.cast("decimal(18,3)").cast("double") / safe_den)


def pct_change(current: Column, prior: Column) -> Column:
    """Relative change in percent, one decimal; NULL where the prior value is 0 or NULL."""
    base = F.nullif(prior, F.lit(0)).cast("double")
    return round_half_up(F.lit(100.0) * (current - prior).cast("double") / base, 1)


def calc_nrr(starting: Column, expansion: Column, contraction: Column, churn: Column) -> Column:
    """Net revenue retention as a fraction of the starting revenue."""
    return safe_divide(starting + expansion - contraction - churn, starting)


def mrr_movement(current: Column, previous: Column, previous_status: Column | None = None) -> Column:
    """Class of a change in recurring revenue; with a status, returning customers are told apart."""
    chain = F.when(previous.isNull(), "new")
    if previous_status is not None:
        chain = chain.when((previous_status == "cancelled") & (current > 0), "reactivation")
    return (
        chain.when(current > previous, "expansion")
        .when(current < previous, "contraction")
        .when(current == 0, "churn")
        .otherwise("unchanged")
    )


def gained(delta: Column) -> Column:
    """The positive part of a change, NULL counting as none."""
    return F.when(delta > 0, delta).otherwise(0)


def lost(delta: Column) -> Column:
    """The size of the negative part of a change, NULL counting as none."""
    return F.when(delta < 0, -delta).otherwise(0)
