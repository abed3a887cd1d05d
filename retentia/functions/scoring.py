"""Health-score helpers and display labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Display labels by upper score bound, then the label above all bounds.
TIER_LABELS = (((30, "critical"), (60, "at_risk")), "healthy")
TIER_DISPLAY = (((30, "🔴 Critical"), (60, "🟡 At Risk")), "🟢 Healthy")
SCORE_DISPLAY = (((30, "🔴 Critical"), (60, "🟡 At Risk"), (80, "🟢 Healthy")), "⭐ Champion")
RISK_SHARES = (((30, 1.0), (45, 0.75), (60, 0.5), (75, 0.25)), 0.0)


def at_most(score: Column, table: tuple) -> Column:
    """The first entry whose bound the score does not exceed; NULL scores get the last entry."""
    bounds, otherwise = table
    chain = F
    for bound, value in bounds:
        chain = chain.when(score <= bound, F.lit(value))
    return chain.otherwise(F.lit(otherwise))


def at_least(value: Column, steps: tuple, otherwise: Column) -> Column:
    """Points of the first step whose threshold the value reaches."""
    chain = F
    for threshold, points in steps:
        chain = chain.when(value >= threshold, points)
    return chain.otherwise(otherwise)


def clamp(value: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def risk_tier(score: Column) -> Column:
    return at_most(score, TIER_LABELS)


def risk_tier_emoji(score: Column) -> Column:
    return at_most(score, TIER_DISPLAY)


def health_score_label(score: Column) -> Column:
    return F.when(score.isNull(), "Unknown").otherwise(at_most(score, SCORE_DISPLAY))


def mrr_at_risk_pct(score: Column) -> Column:
    """Share of a customer's revenue counted as exposed at a given score."""
    return at_most(score, RISK_SHARES)


def nullif_zero(c: Column) -> Column:
    return F.nullif(c, F.lit(0))
