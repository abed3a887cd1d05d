"""Result tables for reports: scoped queries over the models and their post-processing.

Functions that only return a table leave it unsorted where the order is not part of the result;
``order_by`` names of each report are in :data:`ORDER`.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from retentia.functions.calendar import month_label, month_start
from retentia.functions.finance import exact_avg, gained, lost, round_half_up
from retentia.operators.access import Scope, date_between, one_of, only_true, ordered, row_scope, summary_scope
from retentia.operators.totals import exact_medians
from retentia.params import Params
from retentia.plans.core import enrich

# Serving order of the sorted reports (a leading "-" sorts descending).
ORDER = {
    "mrr_trend": ["mrr_month"],
    "arr_by_region": ["-arr"],
    "nrr_waterfall": ["mrr_month"],
    "amendment_breakdown": ["month", "-net_delta"],
    "health_score_table": ["health_score", "-mrr_at_risk"],
    "risk_summary": ["avg_score"],
    "support_summary": ["ticket_month"],
    "open_tickets": ["-is_high_priority", "created_date"],
    "usage_monthly_trend": ["month", "metric_name"],
    "usage_customer_detail": ["total_events_{months}m"],
    "support_by_category": ["-total_tickets"],
    "feature_breadth_by_month": ["month", "feature_breadth"],
    "post_ticket_engagement": ["recovery_ratio"],
}


def in_report_order(report: str, df: DataFrame, p: Params = Params()) -> DataFrame:
    return df.orderBy(*ordered(*[c.format(months=len(p.months)) for c in ORDER[report]]))


def _whole(c: Column) -> Column:
    return F.round(c, 0).cast("decimal(28,0)")


# --- revenue ----------------------------------------------------------------------------------


def mrr_trend(mrr: DataFrame, scope: Scope = Scope()) -> DataFrame:
    return (
        row_scope(mrr, scope)
        .groupBy("mrr_month")
        .agg(
            F.sum("mrr").alias("total_mrr"),
            F.sum("new_mrr_amount").alias("new_mrr"),
            F.sum("expansion_mrr").alias("expansion_mrr"),
            F.sum("contraction_mrr").alias("contraction_mrr"),
            F.sum("churn_mrr_amount").alias("churn_mrr"),
            F.count_if(F.col("mrr") > 0).alias("active_customers"),
        )
    )


def arr_by_region(mrr: DataFrame, scope: Scope = Scope(), p: Params = Params()) -> DataFrame:
    """Annual run rate: the last month's revenue times twelve."""
    last = row_scope(mrr.filter(F.col("mrr_month") == F.lit(p.months[-1])), scope)
    total = F.sum("mrr")
    return last.groupBy("region").agg(_whole(total * 12).alias("arr"), _whole(total).alias("mrr"))


def nrr_waterfall(nrr: DataFrame, scope: Scope = Scope()) -> DataFrame:
    return summary_scope(nrr, scope).drop("reactivation_mrr", "ending_mrr_pct_change")


def amendment_breakdown(amendments: DataFrame, scope: Scope = Scope(), p: Params = Params()) -> DataFrame:
    delta = F.col("mrr_delta")
    visible = row_scope(date_between(amendments, "effective_date", p.window_start, p.window_end), scope)
    return visible.groupBy(month_start(F.col("effective_date")).alias("month"), "amendment_type").agg(
        F.count(F.lit(1)).alias("deals"),
        _whole(F.sum(gained(delta))).alias("mrr_gained"),
        _whole(F.sum(lost(delta))).alias("mrr_lost"),
        _whole(F.sum(delta)).alias("net_delta"),
    )


def _is_opening(p: Params) -> Column:
    return F.col("mrr_month") == F.lit(p.months[0])


def _of_starting(amount: Column, digits: int) -> Column:
    """Percent of the starting revenue; NULL where there is none, as in the opening month."""
    start = F.when(F.col("starting_mrr") > 0, F.col("starting_mrr").cast("double"))
    return round_half_up(amount.cast("double") / start * 100, digits)


def _retained() -> Column:
    return F.col("ending_mrr") - F.col("new_mrr")


def ending_based_nrr(waterfall: DataFrame, p: Params = Params()) -> DataFrame:
    """Retention from ending revenue; the first month is an opening row without movements or ratios."""
    opening, zero = _is_opening(p), F.lit(Decimal("0.00"))
    moves = ["starting_mrr", "expansion_mrr", "contraction_mrr", "churn_mrr"]
    df = waterfall.select(
        "mrr_month",
        "region",
        opening.alias("is_opening"),
        *[F.when(opening, zero).otherwise(F.col(c)).alias(c) for c in moves],
        F.when(opening, F.col("ending_mrr")).otherwise(F.col("new_mrr")).alias("new_mrr"),
        "ending_mrr",
    )
    kept = F.col("starting_mrr") - F.col("contraction_mrr") - F.col("churn_mrr")
    return df.withColumns(
        {
            "nrr_pct": _of_starting(_retained(), 1),
            "grr_pct": _of_starting(kept, 1),
            "churn_rate_pct": _of_starting(F.col("churn_mrr"), 2),
        }
    )


def timing_adjustment(waterfall: DataFrame, p: Params = Params()) -> DataFrame:
    """Gap between the movements and the ending revenue, and where reports show it."""
    balance = sum(
        (F.col(c) * sign for c, sign in (("new_mrr", 1), ("expansion_mrr", 1), ("contraction_mrr", -1), ("churn_mrr", -1))),
        F.col("starting_mrr"),
    )
    gap = F.when(_is_opening(p), F.lit(Decimal("0.00"))).otherwise(F.col("ending_mrr") - balance).cast("decimal(28,2)")
    return waterfall.select("mrr_month", "region", gap.alias("timing_adj")).withColumns(
        {"in_chart": F.abs("timing_adj") > 1, "in_table": F.abs("timing_adj") > 10}
    )


def latest_month_row(df: DataFrame, month: str = "mrr_month", condition: str = "starting_mrr > 0", rows: int = 1) -> DataFrame:
    """The last (and earlier) months of each region of a monthly summary; ``recency`` 1 is the latest."""
    newest_first = Window.partitionBy("region").orderBy(F.col(month).desc_nulls_last())
    return df.filter(condition).withColumn("recency", F.row_number().over(newest_first)).filter(F.col("recency") <= rows)


def waterfall_rows(waterfall: DataFrame) -> DataFrame:
    """The latest meaningful month as chart steps; the adjustment step only where it is not trivial."""
    last = latest_month_row(waterfall)
    s, n, e = F.col("starting_mrr"), F.col("new_mrr"), F.col("expansion_mrr")
    c, x, end = F.col("contraction_mrr"), F.col("churn_mrr"), F.col("ending_mrr")
    gap = end - (s + n + e - c - x)
    steps = [
        ("Starting", "absolute", s), ("New", "relative", n), ("Expansion", "relative", e),
        ("Contraction", "relative", -c), ("Churn", "relative", -x), ("Timing Adj", "relative", gap), ("Ending", "total", end),
    ]
    as_structs = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(step).alias("step"), F.lit(measure).alias("measure"),
                value.cast("decimal(28,2)").alias("value"),
            )
            for i, (step, measure, value) in enumerate(steps, 1)
        ]
    )
    return last.select(F.inline(as_structs)).filter((F.col("step") != "Timing Adj") | (F.abs("value") > 1))


def month_over_month_deltas(waterfall: DataFrame, p: Params = Params()) -> DataFrame:
    """Change of the headline figures against the previous month of the same region."""
    df = waterfall.withColumn("ending_nrr_pct", F.when(~_is_opening(p), _of_starting(_retained(), 1)))
    by_month = Window.partitionBy("region").orderBy(F.col("mrr_month").asc_nulls_last())

    def change(c: str) -> Column:
        return F.col(c) - F.lag(c).over(by_month)

    prior_churn = F.lag("churn_mrr").over(by_month)
    growth = (F.col("churn_mrr") - prior_churn).cast("double") / F.nullif(prior_churn, F.lit(0)).cast("double") * 100
    return df.select(
        "mrr_month",
        "region",
        month_label(F.col("mrr_month")).alias("month_label"),
        change("ending_mrr").cast("decimal(28,2)").alias("ending_mrr_delta"),
        change("churn_mrr").cast("decimal(28,2)").alias("churn_mrr_delta"),
        change("churned_customers").alias("churned_customers_delta"),
        round_half_up(change("ending_nrr_pct"), 1).alias("nrr_delta"),
        F.when(prior_churn > 0, round_half_up(growth, 1)).when(prior_churn.isNotNull(), F.lit(0.0)).alias("churn_pct_change"),
    )


def leading_types(breakdown: DataFrame) -> DataFrame:
    """Per month, the amendment type with the largest gain and the largest loss (ties: first by name)."""

    def leader(amount: str) -> Column:
        return F.min_by("amendment_type", F.struct(-F.col(amount), F.col("amendment_type")))

    return breakdown.groupBy("month").agg(
        leader("mrr_gained").alias("top_expansion"),
        leader("mrr_lost").alias("top_contraction"),
        F.sum("mrr_gained").alias("gained"),
        F.sum("mrr_lost").alias("lost"),
    )


def amendment_month_summary(waterfall: DataFrame, breakdown: DataFrame, p: Params = Params()) -> DataFrame:
    """Expansion and contraction per month with the leading amendment type.

    Later months take the waterfall's figures; the opening month has no waterfall and shows the
    amendments themselves.
    """
    tops = leading_types(breakdown).withColumnRenamed("month", "_month")
    opening = _is_opening(p)
    df = waterfall.join(tops, F.col("mrr_month") == F.col("_month"), "left")
    up = F.when(opening, F.col("gained")).otherwise(F.col("expansion_mrr")).cast("decimal(28,2)")
    down = F.when(opening, F.col("lost")).otherwise(F.col("contraction_mrr")).cast("decimal(28,2)")
    return df.select(
        F.col("mrr_month").alias("month"),
        opening.alias("is_opening"),
        up.alias("expansion_total"),
        down.alias("contraction_total"),
        F.when(~opening & (F.col("expansion_mrr") > 0), F.col("top_expansion")).alias("top_expansion"),
        F.when(~opening & (F.col("contraction_mrr") > 0), F.col("top_contraction")).alias("top_contraction"),
    )


# --- customers --------------------------------------------------------------------------------


def health_score_table(health: DataFrame, scope: Scope = Scope(), p: Params = Params()) -> DataFrame:
    before, last = p.month_labels[-2:]
    return row_scope(health, scope).select(
        "customer_id", "company_name", "region", "account_tier", "health_score", "risk_tier",
        "current_mrr", "mrr_at_risk", "usage_score", "support_score", "financial_score",
        "is_silent_churn", "has_open_critical_ticket", "has_overdue_invoices", "has_recent_downgrade",
        "is_expansion_candidate", f"total_events_{len(p.months)}m", f"{before}_{last}_pct_change", "avg_satisfaction_score",
        "open_tickets",
    )


def filter_health(
    table: DataFrame, tiers: Sequence[str] = (), regions: Sequence[str] = (), candidates_only: bool = False
) -> DataFrame:
    """The health table as narrowed by a user; unknown flags read as false."""
    chosen = one_of(one_of(table, "risk_tier", tiers), "region", regions)
    return only_true(chosen, "is_expansion_candidate", candidates_only).fillna(
        False, ["is_silent_churn", "has_open_critical_ticket", "has_overdue_invoices"]
    )


def risk_summary(health: DataFrame, scope: Scope = Scope()) -> DataFrame:
    return (
        row_scope(health, scope)
        .groupBy("risk_tier")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            _whole(F.sum("current_mrr")).alias("total_mrr"),
            _whole(F.sum("mrr_at_risk")).alias("mrr_at_risk"),
            round_half_up(exact_avg(F.col("health_score")), 1).alias("avg_score"),
        )
    )


def mrr_at_risk_by_region(table: DataFrame) -> DataFrame:
    exposed = table.filter(F.col("mrr_at_risk") > 0)
    return exposed.groupBy("region").agg(F.sum("mrr_at_risk").cast("decimal(28,2)").alias("mrr_at_risk"))


# --- support ----------------------------------------------------------------------------------


def support_summary(summary: DataFrame, scope: Scope = Scope()) -> DataFrame:
    return summary_scope(summary, scope).select(
        "ticket_month", "region", "total_tickets", "open_tickets", "resolved_tickets", "high_priority_tickets",
        "billing_tickets", "avg_resolution_hours", "avg_satisfaction", "resolution_rate_pct",
        "low_satisfaction_count", "unique_customers_with_tickets",
    )


def open_tickets(tickets: DataFrame, scope: Scope = Scope()) -> DataFrame:
    return row_scope(tickets.filter("is_open"), scope).select(
        "ticket_id", "customer_id", "company_name", "region", "category", "priority", "channel",
        "created_date", "resolution_hours", "satisfaction_score", "is_high_priority",
    )


def ticket_days_open(tickets: DataFrame, priorities: Sequence[str] = ("critical", "high"), p: Params = Params()) -> DataFrame:
    waiting = F.datediff(F.lit(p.ref_date), F.col("created_date"))
    return one_of(tickets, "priority", priorities).select(
        "ticket_id", "company_name", "region", "category", "priority", "channel", "created_date", waiting.alias("days_open")
    )


def support_by_category(tickets: DataFrame, scope: Scope = Scope()) -> DataFrame:
    return (
        row_scope(tickets, scope)
        .groupBy("category", "region")
        .agg(
            F.count(F.lit(1)).alias("total_tickets"),
            round_half_up(exact_avg(F.col("resolution_hours")), 1).alias("avg_resolution_hours"),
            round_half_up(exact_avg(F.col("satisfaction_score")), 2).alias("avg_satisfaction"),
            F.count_if("is_high_priority").alias("high_priority_tickets"),
        )
    )


def category_rollup(by_category: DataFrame, regions: Sequence[str] = ()) -> DataFrame:
    """Categories over the chosen regions: summed tickets, unweighted means of the regional figures."""
    return (
        one_of(by_category, "region", regions)
        .groupBy("category")
        .agg(
            F.sum("total_tickets").alias("total_tickets"),
            round_half_up(exact_avg(F.col("avg_resolution_hours").cast("decimal(28,1)")), 1).alias("avg_resolution_hours"),
            round_half_up(exact_avg(F.col("avg_satisfaction").cast("decimal(28,2)")), 2).alias("avg_satisfaction"),
        )
    )


# --- product ----------------------------------------------------------------------------------


def usage_monthly_trend(usage: DataFrame, scope: Scope = Scope()) -> DataFrame:
    return (
        row_scope(usage, scope)
        .groupBy(month_start(F.col("event_date")).alias("month"), "metric_name")
        .agg(
            F.count_distinct("customer_id").alias("active_customers"),
            _whole(F.sum("quantity")).alias("total_quantity"),
            round_half_up(exact_avg(F.col("quantity")), 1).alias("avg_quantity"),
        )
    )


def usage_kpis(stats: DataFrame, scope: Scope = Scope(), p: Params = Params()) -> DataFrame:
    """One row over all customers with usage; the customer is the key of ``stats``, so counting rows suffices."""
    label, n = p.month_labels[-1], len(p.months)
    return row_scope(stats, scope).agg(
        F.count("customer_id").alias("mau"),
        round_half_up(exact_avg(F.col("max_feature_breadth")), 1).alias("avg_feature_breadth"),
        F.sum(F.col("is_silent_churn").cast("long")).alias("silent_churn_customers"),
        F.sum(F.col("is_consistently_declining").cast("long")).alias("declining_customers"),
        round_half_up(exact_avg(F.col(f"total_events_{n}m")), 0).alias("avg_events_per_customer"),
        round_half_up(exact_avg(F.col(f"{label}_users")), 1).alias(f"avg_active_users_{label}"),
    )


def usage_customer_detail(stats: DataFrame, health: DataFrame, scope: Scope = Scope(), p: Params = Params()) -> DataFrame:
    """Usage per customer with revenue and health, defaults where the customer has no score."""
    labels, n = p.month_labels, len(p.months)
    shown = ["current_mrr", "health_score", "risk_tier", "mrr_at_risk"]
    df = enrich(row_scope(stats, scope), health, "customer_id", {c: c for c in shown})
    return df.select(
        "customer_id", "company_name", "region", "account_tier",
        *[f"{m}_events" for m in labels], f"total_events_{n}m", "max_feature_breadth",
        *[f"{a}_{b}_pct_change" for a, b in zip(labels, labels[1:])],
        "is_silent_churn", "is_consistently_declining",
        F.coalesce("sharp_drop_last_month", F.lit(False)).alias("sharp_drop_last_month"), "zero_usage_months",
        F.coalesce("current_mrr", F.lit(0)).cast("decimal(22,2)").alias("current_mrr"),
        F.coalesce("health_score", F.lit(0)).alias("health_score"),
        F.coalesce("risk_tier", F.lit("unknown")).alias("risk_tier"),
        F.coalesce("mrr_at_risk", F.lit(0)).cast("decimal(22,2)").alias("mrr_at_risk"),
        _whole(F.col(f"{labels[-1]}_users")).alias(f"{labels[-1]}_active_users"),
        _whole(F.col(f"{labels[-1]}_api")).alias(f"{labels[-1]}_api_calls"),
    )


def feature_breadth_by_month(usage: DataFrame, scope: Scope = Scope(), p: Params = Params()) -> DataFrame:
    """How many customers used how many distinct metrics in each month."""
    visible = row_scope(date_between(usage, "event_date", p.window_start, p.window_end), scope)
    breadth = visible.groupBy("customer_id", month_start(F.col("event_date")).alias("month")).agg(
        F.count_distinct("metric_name").alias("feature_breadth")
    )
    return breadth.groupBy("month", "feature_breadth").agg(F.count(F.lit(1)).alias("customers"))


def engagement_quadrant(detail: DataFrame, p: Params = Params()) -> DataFrame:
    """Customers placed against the medians of revenue and usage.

    ``detail`` is read once per step of the median search; pass a stored table.
    """
    events = f"total_events_{len(p.months)}m"
    medians = exact_medians(detail, ["current_mrr", events])
    mid_mrr, mid_events = F.lit(medians["current_mrr"]), F.lit(medians[events])
    rich, busy = F.col("current_mrr") >= mid_mrr, F.col(events) >= mid_events
    place = (
        F.when(rich & busy, "high_mrr_high_usage")
        .when(rich, "high_mrr_low_usage")
        .when(busy, "low_mrr_high_usage")
        .otherwise("low_mrr_low_usage")
    )
    return detail.select(
        "customer_id", "current_mrr", events, "risk_tier",
        mid_mrr.alias("median_current_mrr"), mid_events.alias(f"median_{events}"), place.alias("quadrant"),
    )


def post_ticket_engagement(
    support: DataFrame, customers: DataFrame, health: DataFrame, scope: Scope = Scope()
) -> DataFrame:
    """Recovery after support per customer, with revenue and tier."""
    df = enrich(support.filter("total_tickets > 0"), customers, "customer_id", {"company_name": "company_name", "region": "region"})
    df = enrich(row_scope(df, scope), health, "customer_id", {"current_mrr": "current_mrr", "risk_tier": "risk_tier"})
    return df.select(
        "customer_id", "company_name", "region", "total_tickets",
        round_half_up(F.col("avg_engagement_recovery"), 2).alias("recovery_ratio"),
        "tickets_not_recovered", "has_open_critical_ticket", "poor_post_ticket_recovery", "unresolved_with_no_recovery",
        round_half_up(F.col("avg_satisfaction_score"), 1).alias("avg_satisfaction"),
        F.coalesce("current_mrr", F.lit(0)).cast("decimal(22,2)").alias("current_mrr"),
        F.coalesce("risk_tier", F.lit("unknown")).alias("risk_tier"),
    )


def recovery_buckets(engagement: DataFrame) -> DataFrame:
    ratio = F.col("recovery_ratio")
    bucket = (
        F.when(ratio.isNull(), "No data")
        .when(ratio >= 1.0, "✅ Recovered (≥1x)")
        .when(ratio >= 0.5, "⚠️ Partial (0.5–1x)")
        .otherwise("🚨 Not recovered (<0.5x)")
    )
    return engagement.groupBy(bucket.alias("recovery_bucket")).agg(
        F.count("customer_id").alias("customers"), F.sum("current_mrr").cast("decimal(28,2)").alias("total_mrr")
    )


def no_recovery(engagement: DataFrame) -> DataFrame:
    """Customers whose usage did not come back after support."""
    lost_after = F.coalesce("poor_post_ticket_recovery", F.lit(False)) | F.coalesce("unresolved_with_no_recovery", F.lit(False))
    return engagement.filter(lost_after).select(
        "company_name", "region", "total_tickets", "recovery_ratio", "avg_satisfaction", "current_mrr", "risk_tier"
    )


RISK_SIGNALS = ("is_silent_churn", "is_consistently_declining", "sharp_drop_last_month")


def risk_signal_filter(detail: DataFrame, signals: Sequence[str] = RISK_SIGNALS, min_mrr=0) -> DataFrame:
    """Customers with a usage risk signal and enough revenue; a signal not chosen removes all its rows."""
    flags = {s: F.coalesce(F.col(s), F.lit(False)) for s in RISK_SIGNALS}
    kept = detail.filter(flags[RISK_SIGNALS[0]] | flags[RISK_SIGNALS[1]] | flags[RISK_SIGNALS[2]])
    for name, flag in flags.items():
        if name not in signals:
            kept = kept.filter(~flag)
    return kept.filter(F.col("current_mrr") >= min_mrr)


def usage_risk_table(detail: DataFrame, signals: Sequence[str] = RISK_SIGNALS, min_mrr=0, p: Params = Params()) -> DataFrame:
    labels = p.month_labels
    return risk_signal_filter(detail, signals, min_mrr).select(
        "company_name", "region", "account_tier", *[f"{m}_events" for m in labels],
        f"{labels[-2]}_{labels[-1]}_pct_change", "current_mrr", "risk_tier", *RISK_SIGNALS,
    )


def usage_shares(kpis: DataFrame, detail: DataFrame) -> DataFrame:
    """Engaged and declining customers as a share of all customers in the detail table."""
    total = detail.agg(F.count(F.lit(1)).alias("total_customers")).scalar()

    def share(c: str) -> Column:
        return F.col(c).cast("double") / F.nullif(total, F.lit(0)) * 100

    return kpis.select(
        "mau", total.alias("total_customers"), "declining_customers",
        round_half_up(share("mau"), 1).alias("engagement_pct"),
        round_half_up(share("declining_customers"), 0).alias("declining_pct"),
    )
