"""The 0-100 customer health score from usage, support and financial signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retentia.functions.scoring import at_least, clamp
from retentia.operators.access import ordered
from retentia.params import Params, ScorePoints
from retentia.plans.core import CUSTOMER_CONTEXT, enrich


def _if(condition: Column, points: int, otherwise: int = 0) -> Column:
    return F.when(condition, points).otherwise(otherwise)


def usage_score(p: Params) -> Column:
    s, labels = p.points, p.month_labels
    growing, last_step = F.col("usage_slope"), F.col(f"{labels[-2]}_to_{labels[-1]}_delta")
    trend = (
        F.when((growing > 0) & (last_step > 0), s.trend_growing)
        .when(growing > 0, s.trend_net_up)
        .when(growing == 0, s.trend_flat)
        .when(F.col("is_consistently_declining"), s.trend_declining)
        .otherwise(s.trend_slight_down)
    )
    return (
        _if(F.col(f"total_events_{len(labels)}m") > 0, s.usage_any)
        + trend
        + at_least(F.col("max_feature_breadth"), s.breadth, F.lit(0))
        + _if(F.col(f"{labels[-1]}_events") > 0, s.active_last_month)
    )


def _steps_or_low(value: Column, steps: tuple, low: int, missing: int) -> Column:
    return at_least(value, steps, _if(value.isNotNull(), low, missing))


def support_score(s: ScorePoints) -> Column:
    return (
        _if(F.col("total_tickets") == 0, s.support_no_tickets, s.support_base)
        - _if(F.col("has_open_critical_ticket"), s.open_high_priority)
        + _steps_or_low(F.col("avg_satisfaction_score"), s.satisfaction, s.satisfaction_low, 0)
        + _steps_or_low(F.col("avg_engagement_recovery"), s.recovery, s.recovery_low, 0)
        - _if(F.col("has_billing_friction"), s.billing_friction)
    )


def financial_score(s: ScorePoints) -> Column:
    direction = (
        F.when(F.col("has_recent_upgrade"), s.upgrade)
        .when(F.col("has_recent_downgrade"), s.downgrade)
        .when(F.col("has_commitment_downgrade"), s.commitment_downgrade)
        .otherwise(s.steady)
    )
    return (
        _if(~F.col("no_active_subscription"), s.active_subscription)
        + _steps_or_low(F.col("collection_rate_pct"), s.collection, s.collection_low, s.collection_missing)
        + direction
        - _if(F.col("has_overdue_invoices"), s.overdue)
        - _if(F.col("has_repeated_payment_failures"), s.payment_failures)
        - _if(F.col("has_disputed_invoices"), s.disputed)
        - _if(F.col("has_auto_renew_off"), s.auto_renew_off)
    )


def score_columns(s: ScorePoints) -> tuple[Column, Column]:
    """Tier and revenue at risk of a row with ``health_score`` and ``current_mrr``."""
    score, mrr = F.col("health_score"), F.coalesce("current_mrr", F.lit(0))
    tier = F.when(score <= s.critical_max, "critical").when(score <= s.at_risk_max, "at_risk").otherwise("healthy")
    half = F.round(mrr * F.lit(s.at_risk_share).cast("decimal(2,1)"), 2)
    at_risk = F.when(score <= s.critical_max, mrr).when(score <= s.at_risk_max, half).otherwise(0)
    return tier, at_risk.cast("decimal(22,2)")


def customer_health_score(
    customers: DataFrame, usage: DataFrame, support: DataFrame, financial: DataFrame, p: Params = Params()
) -> DataFrame:
    """Score, tier, revenue at risk and the signals behind them for every customer.

    Each signal table is already one row per customer; missing signals take neutral points.
    """
    s, n, labels = p.points, len(p.months), p.month_labels
    usage_shown = [
        f"total_events_{n}m", "usage_slope", "max_feature_breadth", f"{labels[-2]}_{labels[-1]}_pct_change",
        "is_silent_churn", "is_consistently_declining", "sharp_drop_last_month",
    ]
    support_shown = [
        "total_tickets", "open_tickets", "open_high_priority_tickets", "avg_satisfaction_score",
        "avg_engagement_recovery", "tickets_not_recovered", "has_open_critical_ticket",
        "poor_post_ticket_recovery", "has_billing_friction",
    ]
    financial_shown = [
        "current_mrr", "collection_rate_pct", "has_overdue_invoices", "has_repeated_payment_failures",
        "has_recent_downgrade", "has_recent_upgrade", "has_auto_renew_off", "no_active_subscription",
    ]
    parts = [
        (usage.withColumn("_score", usage_score(p)), usage_shown, "usage_score", s.usage_max, s.usage_missing),
        (support.withColumn("_score", support_score(s)), support_shown, "support_score", s.support_max, s.support_missing),
        (financial.withColumn("_score", financial_score(s)), financial_shown, "financial_score", s.financial_max, s.financial_missing),
    ]
    df = customers.select("customer_id", *CUSTOMER_CONTEXT, F.col("status").alias("customer_status"))
    for signals, shown, name, top, missing in parts:
        df = enrich(df, signals, "customer_id", {"_score": name} | {c: c for c in shown})
        df = df.withColumn(name, clamp(F.coalesce(F.col(name), F.lit(missing)), 0, top))
    df = df.withColumn("health_score", F.col("usage_score") + F.col("support_score") + F.col("financial_score"))
    tier, at_risk = score_columns(s)
    candidate = (
        (F.col("health_score") >= s.expansion_min_score)
        & (F.coalesce("max_feature_breadth", F.lit(0)) >= s.expansion_min_breadth)
        & ~F.coalesce("has_recent_upgrade", F.lit(False))
    )
    return df.select(
        "customer_id", *CUSTOMER_CONTEXT, "customer_status",
        "usage_score", "support_score", "financial_score", "health_score",
        tier.alias("risk_tier"), at_risk.alias("mrr_at_risk"),
        *usage_shown, *support_shown, *financial_shown,
        candidate.alias("is_expansion_candidate"),
    )


def riskiest_first(health: DataFrame) -> DataFrame:
    """Serving order; the table itself is kept unsorted."""
    return health.orderBy(*ordered("health_score", "-mrr_at_risk", "customer_id"))


def score_histogram(health: DataFrame, width: int = 5) -> DataFrame:
    """Customers per score bin of fixed width; the top score falls into the last bin."""
    bin_start = (F.floor(F.least(F.col("health_score"), F.lit(100 - 1)) / width) * width).cast("int")
    return health.groupBy(bin_start.alias("bin_start")).agg(F.count(F.lit(1)).alias("customers"))


