"""Per-customer usage, support and financial signals."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from retentia.functions.calendar import month_start
from retentia.functions.finance import exact_avg, pct_change, round_half_up, safe_divide
from retentia.operators.intervals import window_totals
from retentia.params import Params
from retentia.plans.core import CUSTOMER_CONTEXT, enrich
from retentia.sources.store import Keep, as_is

# Metrics that make up each usage measure.
USAGE_MEASURES = {
    "api": ["api_calls", "api_requests"],
    "users": ["active_users"],
}


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _total(condition: Column, amount: str) -> Column:
    return F.sum(F.when(condition, F.col(amount)).otherwise(0))


# --- usage ------------------------------------------------------------------------------------


def monthly_usage(usage: DataFrame) -> DataFrame:
    """Observations, quantity and distinct metrics per customer and month."""
    measures = [_total(F.col("metric_name").isin(m), "quantity").alias(n) for n, m in USAGE_MEASURES.items()]
    return usage.groupBy("customer_id", month_start(F.col("event_date")).alias("usage_month")).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("quantity").alias("quantity"),
        F.count_distinct("metric_name").alias("feature_breadth"),
        *measures,
    )


def pivot_months(monthly: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per customer; each measure of each month of the window becomes a column, 0 where absent."""
    measures = [c for c in monthly.columns if c not in ("customer_id", "usage_month")]
    return monthly.groupBy("customer_id").agg(
        *[
            F.max(F.when(F.col("usage_month") == F.lit(m), F.col(c)).otherwise(0)).alias(f"{label}_{c}")
            for m, label in zip(p.months, p.month_labels)
            for c in measures
        ]
    )


def usage_trends(pivoted: DataFrame, p: Params = Params()) -> DataFrame:
    labels = p.month_labels
    events = [F.col(f"{m}_events") for m in labels]
    pairs = list(zip(labels, labels[1:]))
    steps = list(zip(events, events[1:]))
    last_delta, slope = steps[-1][1] - steps[-1][0], events[-1] - events[0]
    idle = reduce(add, [(e == 0).cast("int") for e in events])
    breadth = F.greatest(*[F.col(f"{m}_feature_breadth") for m in labels])
    total = reduce(add, events)
    last_change = F.when(steps[-1][0] > 0, pct_change(steps[-1][1], steps[-1][0]))
    n = len(labels)
    return pivoted.withColumns(
        {
            f"total_events_{n}m": total,
            f"total_quantity_{n}m": reduce(add, [F.col(f"{m}_quantity") for m in labels]),
            "max_feature_breadth": breadth,
            **{f"{a}_to_{b}_delta": y - x for (a, b), (x, y) in zip(pairs, steps)},
            "usage_slope": slope,
            **{f"{a}_{b}_pct_change": F.when(x > 0, pct_change(y, x)) for (a, b), (x, y) in zip(pairs, steps)},
            "zero_usage_months": idle,
            "is_silent_churn": (events[-1] == 0) & (total > 0),
            "is_consistently_declining": (slope < 0) & (last_delta < 0),
            "has_sparse_usage": idle >= 2,
            "is_single_feature": breadth == 1,
            "sharp_drop_last_month": last_change < -50,
        }
    )


def customer_usage_stats(usage: DataFrame, customers: DataFrame, p: Params = Params()) -> DataFrame:
    """Usage per customer over the window, its trend and risk flags. ``usage`` needs no enrichment."""
    df = usage_trends(pivot_months(monthly_usage(usage), p), p)
    monthly = [f"{m}_{c}" for c in ("events", "quantity", "api", "users") for m in p.month_labels]
    derived = df.columns[df.columns.index(f"total_events_{len(p.months)}m") :]
    named = enrich(df, customers, "customer_id", {c: c for c in CUSTOMER_CONTEXT})
    return named.select("customer_id", *CUSTOMER_CONTEXT, *monthly, *derived)


# --- support ----------------------------------------------------------------------------------


def ticket_engagement(tickets: DataFrame, usage: DataFrame, p: Params = Params()) -> DataFrame:
    """Per ticket, usage in the days before it was opened and after it was resolved.

    Both windows are looked up from per-day totals: no ticket is paired with single observations.
    """
    days = p.window_days
    opened = tickets.select("customer_id", F.col("created_date").alias("event_date"))
    solved = tickets.select("customer_id", F.col("resolved_date").alias("event_date"))
    facts = usage.select(
        "customer_id",
        "event_date",
        F.col("quantity").cast("decimal(28,4)").alias("quantity"),
        F.col("metric_name").isNotNull().cast("long").alias("usage_days"),
    )
    around = window_totals(
        opened.unionByName(solved), facts, "customer_id", "event_date",
        {"pre": (-days, -1), "post": (1, days)}, ["quantity", "usage_days"],
    )
    before = around.select(F.col("customer_id").alias("_bc"), F.col("event_date").alias("_bd"), "pre_quantity", "pre_usage_days")
    after = around.select(F.col("customer_id").alias("_ac"), F.col("event_date").alias("_ad"), "post_quantity", "post_usage_days")
    t = tickets.select(
        "ticket_id", "customer_id", "created_date", "resolved_date", "priority", "category",
        "satisfaction_score", "resolution_hours",
    )
    joined = t.join(before, (t.customer_id == F.col("_bc")) & (t.created_date == F.col("_bd")), "left").join(
        after, (t.customer_id == F.col("_ac")) & (t.resolved_date == F.col("_ad")), "left"
    )
    return joined.select(
        *t.columns,
        F.coalesce("pre_usage_days", F.lit(0)).alias("pre_ticket_usage_days"),
        F.coalesce("pre_quantity", F.lit(0)).cast("decimal(38,4)").alias("pre_ticket_quantity"),
        F.coalesce("post_usage_days", F.lit(0)).alias("post_ticket_usage_days"),
        F.coalesce("post_quantity", F.lit(0)).cast("decimal(38,4)").alias("post_ticket_quantity"),
    )


def ticket_recovery(engagement: DataFrame) -> DataFrame:
    """Usage after a ticket relative to before; 2.0 marks a customer who only started afterwards."""
    pre, post, solved = F.col("pre_ticket_quantity"), F.col("post_ticket_quantity"), F.col("resolved_date").isNotNull()
    ratio = safe_divide(post, pre)
    measurable = (pre > 0) & solved
    return engagement.withColumns(
        {
            "engagement_recovery_ratio": F.when(measurable, round_half_up(ratio, 2))
            .when((pre == 0) & (post > 0), F.lit(2.0))
            .when(solved, F.lit(0.0)),
            "engagement_recovered": F.when(measurable, ratio >= 0.7),
        }
    )


def support_rollup(tickets: DataFrame) -> DataFrame:
    urgent = F.col("priority").isin("critical", "high")
    return tickets.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_tickets"),
        _count(F.col("is_open")).alias("open_tickets"),
        _count(F.col("is_resolved")).alias("resolved_tickets"),
        _count(F.col("priority") == "critical").alias("critical_tickets"),
        _count(F.col("priority") == "high").alias("high_tickets"),
        _count(F.col("category") == "billing").alias("billing_tickets"),
        _count(F.col("category") == "account").alias("account_tickets"),
        _count(F.col("is_open") & urgent).alias("open_high_priority_tickets"),
        round_half_up(exact_avg(F.col("satisfaction_score")), 2).alias("avg_satisfaction_score"),
        F.min("satisfaction_score").alias("min_satisfaction_score"),
        round_half_up(exact_avg(F.col("resolution_hours")), 1).alias("avg_resolution_hours"),
        F.max("resolution_hours").alias("max_resolution_hours"),
    )


def recovery_rollup(recovery: DataFrame) -> DataFrame:
    """Recovery per customer over resolved tickets with usage before them."""
    measured = recovery.filter(F.col("resolved_date").isNotNull() & (F.col("pre_ticket_quantity") > 0))
    ratio = F.col("engagement_recovery_ratio")
    return measured.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("measured_tickets"),
        round_half_up(exact_avg(ratio.cast("decimal(28,2)")), 2).alias("avg_engagement_recovery"),
        _count(~F.col("engagement_recovered")).alias("tickets_not_recovered"),
        _count(F.col("engagement_recovered")).alias("tickets_recovered"),
        F.min(ratio).alias("min_recovery_ratio"),
    )


def customer_support_signals(tickets: DataFrame, usage: DataFrame, p: Params = Params()) -> DataFrame:
    """Support load, satisfaction and post-ticket recovery of every customer with tickets.

    ``tickets`` needs ``is_open`` / ``is_resolved``; ``usage`` is one row per customer, day, metric.
    """
    recovered = recovery_rollup(ticket_recovery(ticket_engagement(tickets, usage, p)))
    df = enrich(
        support_rollup(tickets), recovered, "customer_id",
        {c: c for c in ("avg_engagement_recovery", "tickets_not_recovered", "tickets_recovered", "min_recovery_ratio")},
    )
    df = df.withColumns(
        {
            "avg_engagement_recovery": F.coalesce("avg_engagement_recovery", F.lit(1.0)),
            "tickets_not_recovered": F.coalesce("tickets_not_recovered", F.lit(0)),
            "tickets_recovered": F.coalesce("tickets_recovered", F.lit(0)),
        }
    )
    return df.withColumns(
        {
            "has_open_critical_ticket": F.col("open_high_priority_tickets") > 0,
            "has_very_low_satisfaction": F.col("min_satisfaction_score") <= 2,
            "has_billing_friction": F.col("billing_tickets") + F.col("account_tickets") >= 2,
            "poor_post_ticket_recovery": F.col("avg_engagement_recovery") < 0.5,
            "unresolved_with_no_recovery": (F.col("tickets_not_recovered") > 0) & (F.col("open_tickets") > 0),
        }
    )


# --- finance ----------------------------------------------------------------------------------


def invoice_rollup(invoices: DataFrame) -> DataFrame:
    status = F.col("invoice_status")
    return invoices.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_invoices"),
        F.sum("total_amount").alias("total_billed"),
        _total(status == "paid", "total_amount").alias("total_paid"),
        _total(status == "overdue", "total_amount").alias("total_overdue"),
        _count(status == "overdue").alias("overdue_invoice_count"),
        _count(status == "disputed").alias("disputed_invoice_count"),
        F.max("invoice_date").alias("last_invoice_date"),
    )


def payment_rollup(payments: DataFrame) -> DataFrame:
    status = F.col("payment_status")
    paid, billed = _total(status == "completed", "amount"), F.sum("amount")
    rate = F.when(billed > 0, round_half_up(F.lit(100.0) * paid.cast("double") / F.nullif(billed, F.lit(0)).cast("double"), 1))
    return payments.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_payments"),
        paid.alias("total_collected"),
        _count(status == "failed").alias("failed_payment_count"),
        _total(status == "refunded", "amount").alias("total_refunded"),
        _count(status == "refunded").alias("refund_count"),
        rate.alias("collection_rate_pct"),
    )


def subscription_rollup(subscriptions: DataFrame) -> DataFrame:
    active = F.col("status") == "active"
    return subscriptions.groupBy("customer_id").agg(
        _total(active, "mrr").alias("current_mrr"),
        _count(active).alias("active_sub_count"),
        _count(F.col("status") == "cancelled").alias("cancelled_sub_count"),
        F.bool_or(F.col("mrr_movement") == "downgrade").alias("has_recent_downgrade"),
        F.bool_or(F.col("mrr_movement") == "upgrade").alias("has_recent_upgrade"),
        F.bool_or(F.col("cycle_movement") == "commitment_downgrade").alias("has_commitment_downgrade"),
        F.bool_or(active & ~F.col("auto_renew")).alias("has_auto_renew_off"),
    )


def customer_financial_signals(invoices: DataFrame, payments: DataFrame, subscriptions: DataFrame, keep: Keep = as_is) -> DataFrame:
    """Billing, collection and subscription signals of every customer with invoices.

    The inputs need no enrichment: latest invoices (``invoice_status``), latest payments
    (``payment_status``) and the subscription dimension.
    """
    pay, subs = keep(payment_rollup(payments)), keep(subscription_rollup(subscriptions))
    df = keep(invoice_rollup(invoices))
    df = enrich(df, pay, "customer_id", {c: c for c in pay.columns if c != "customer_id"})
    df = enrich(df, subs, "customer_id", {c: c for c in subs.columns if c != "customer_id"})

    def or_zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast(df.schema[c].dataType).alias(c)

    def or_false(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(False)).alias(c)

    return df.select(
        "customer_id", "total_invoices", "total_billed", "total_paid", "total_overdue",
        "overdue_invoice_count", "disputed_invoice_count", "last_invoice_date",
        *[or_zero(c) for c in ("total_payments", "total_collected", "failed_payment_count", "total_refunded", "refund_count")],
        "collection_rate_pct",
        *[or_zero(c) for c in ("current_mrr", "active_sub_count", "cancelled_sub_count")],
        *[or_false(c) for c in ("has_recent_downgrade", "has_recent_upgrade", "has_commitment_downgrade", "has_auto_renew_off")],
        (F.col("overdue_invoice_count") > 0).alias("has_overdue_invoices"),
        (F.coalesce("failed_payment_count", F.lit(0)) >= 2).alias("has_repeated_payment_failures"),
        (F.coalesce("collection_rate_pct", F.lit(100.0)) < 80).alias("low_collection_rate"),
        (F.col("disputed_invoice_count") > 0).alias("has_disputed_invoices"),
        (F.coalesce("active_sub_count", F.lit(0)) == 0).alias("no_active_subscription"),
    )
