"""Recurring-revenue movements per customer and month, and net revenue retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from retentia.functions.calendar import month_start
from retentia.functions.finance import calc_nrr, gained, lost, pct_change, round_half_up, safe_divide
from retentia.functions.scoring import risk_tier
from retentia.operators.access import date_between
from retentia.operators.intervals import month_skeleton, month_spine, overlapping_months
from retentia.operators.totals import with_total
from retentia.params import Params
from retentia.plans.core import CUSTOMER_CONTEXT, enrich

KEY = ["customer_id", "mrr_month"]


def _in_window(d: Column, p: Params) -> Column:
    return d.between(F.lit(p.window_start), F.lit(p.window_end))


def base_mrr(subscriptions: DataFrame, p: Params = Params()) -> DataFrame:
    """Recurring revenue per customer and month, by date overlap whatever the present status."""
    running = F.col("status").isin("active", "suspended")
    return (
        month_spine(subscriptions, "start_date", "end_date_resolved", p.months)
        .groupBy(*KEY)
        .agg(F.sum("mrr").alias("mrr"), F.count_if(running).alias("active_sub_count"))
    )


def new_mrr(subscriptions: DataFrame, p: Params = Params()) -> DataFrame:
    """Revenue of subscriptions that started in each month of the window."""
    known = subscriptions.filter(F.col("status").isin("active", "suspended", "cancelled", "expired"))
    started = date_between(known, "start_date", p.window_start, p.window_end)
    return started.groupBy("customer_id", month_start(F.col("start_date")).alias("mrr_month")).agg(
        F.sum("mrr").alias("new_mrr_amount")
    )


def churn_mrr(subscriptions: DataFrame, p: Params = Params()) -> DataFrame:
    """Revenue of cancelled or expired subscriptions that ended in each month of the window."""
    over = subscriptions.filter(F.col("status").isin("cancelled", "expired"))
    ended = date_between(over, "end_date_resolved", p.window_start, p.window_end)
    return ended.groupBy("customer_id", month_start(F.col("end_date_resolved")).alias("mrr_month")).agg(
        F.sum("mrr").alias("churn_mrr_amount")
    )


def amendment_movements(amendments: DataFrame, p: Params = Params()) -> DataFrame:
    """Expansion and contraction by effective month, from the sign of each change."""
    delta = F.col("mrr_delta")
    effective = date_between(amendments, "effective_date", p.window_start, p.window_end)
    return effective.groupBy("customer_id", month_start(F.col("effective_date")).alias("mrr_month")).agg(
        F.sum(gained(delta)).alias("expansion_mrr"),
        F.sum(lost(delta)).alias("contraction_mrr"),
        F.count_if(delta > 0).alias("expansion_count"),
        F.count_if(delta < 0).alias("contraction_count"),
    )


_AMOUNTS = ["mrr", "new_mrr_amount", "churn_mrr_amount", "expansion_mrr", "contraction_mrr"]
_COUNTS = ["active_sub_count", "expansion_count", "contraction_count"]


def _cents(amount: Column) -> Column:
    """An amount as a whole number of cents: a sum of longs takes a third of the memory of a sum of decimals.
    A sum beyond 9 * 10^16 is an error, never another number."""
    return (amount.cast("decimal(22,2)") * 100).cast("long")


def _amount(cents: Column) -> Column:
    return (cents.cast("decimal(30,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(32,2)")


def _contribution(month: Column, **given: Column) -> Column:
    filled = [_cents(F.coalesce(given.get(c, F.lit(0)), F.lit(0))).alias(c) for c in _AMOUNTS]
    filled += [F.coalesce(given.get(c, F.lit(0)), F.lit(0)).cast("long").alias(c) for c in _COUNTS]
    return F.struct(month.alias("mrr_month"), *filled)


def _subscription_contributions(p: Params) -> Column:
    """What one subscription adds to the window: revenue in each month it overlaps, its start, its end."""
    status, mrr = F.col("status"), F.col("mrr")
    start, end = F.col("start_date"), F.col("end_date_resolved")
    running = status.isin("active", "suspended").cast("long")
    base = F.transform(
        overlapping_months(start, end, p.months), lambda m: _contribution(m, mrr=mrr, active_sub_count=running)
    )
    started = status.isin("active", "suspended", "cancelled", "expired") & _in_window(start, p)
    ended = status.isin("cancelled", "expired") & _in_window(end, p)
    edges = F.array(
        F.when(started, _contribution(month_start(start), new_mrr_amount=mrr)),
        F.when(ended, _contribution(month_start(end), churn_mrr_amount=mrr)),
    )
    return F.concat(F.coalesce(base, F.array()), F.array_compact(edges))


def customer_months(
    customers: DataFrame, subscriptions: DataFrame, amendments: DataFrame, p: Params = Params()
) -> DataFrame:
    """Every customer with every month and its movement amounts, 0 where there is none.

    Same result as joining :func:`base_mrr`, :func:`new_mrr`, :func:`churn_mrr` and
    :func:`amendment_movements` to the skeleton, but subscriptions are read once, and the parts are
    added up by a single aggregation, combined map-side, instead of four joins. Amounts are added up as cents,
    as a map task holds a row of sums per customer and month it meets.
    """
    delta, effective = F.col("mrr_delta"), F.col("effective_date")
    skeleton = month_skeleton(customers, "customer_id", p.months).select(
        "customer_id", _contribution(F.col("mrr_month")).alias("_c"), F.lit(True).alias("_known")
    )
    subs = subscriptions.select(
        "customer_id", F.explode(_subscription_contributions(p)).alias("_c"), F.lit(False).alias("_known")
    )
    moves = amendments.filter(_in_window(effective, p)).select(
        "customer_id",
        _contribution(
            month_start(effective),
            expansion_mrr=gained(delta),
            contraction_mrr=lost(delta),
            expansion_count=(delta > 0).cast("long"),
            contraction_count=(delta < 0).cast("long"),
        ).alias("_c"),
        F.lit(False).alias("_known"),
    )
    parts = skeleton.unionByName(subs).unionByName(moves).select("customer_id", "_known", "_c.*")
    return (
        parts.groupBy(*KEY)
        .agg(*[F.sum(c).alias(c) for c in [*_AMOUNTS, *_COUNTS]], F.max("_known").alias("_known"))
        .filter("_known")
        .select(*KEY, *[_amount(F.col(c)).alias(c) for c in _AMOUNTS], *_COUNTS)
    )


def month_movement() -> Column:
    """Class of a customer-month; explicit starts and ends first, then amendments, then the balance."""
    mrr, prev = F.col("mrr"), F.coalesce("prev_mrr", F.lit(0))
    new, churn = F.col("new_mrr_amount"), F.col("churn_mrr_amount")
    up, down = F.col("expansion_mrr"), F.col("contraction_mrr")
    chain = F.when((new > 0) & (prev == 0), "new").when((churn > 0) & (mrr == 0), "churn")
    return (
        chain.when((up > 0) & (down > 0), "mixed")
        .when(up > 0, "expansion")
        .when(down > 0, "contraction")
        .when((mrr == 0) & (prev > 0), "churn")
        .otherwise("unchanged")
    )


def mrr_movements(months: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer-months with any activity: previous month, change, class and customer context.

    The window holds one customer's months, at most the length of the reporting window.
    """
    in_order = Window.partitionBy("customer_id").orderBy(F.col("mrr_month").asc_nulls_last())
    df = months.withColumn("prev_mrr", F.lag("mrr").over(in_order))
    busy = [F.col(c) > 0 for c in ("mrr", "new_mrr_amount", "churn_mrr_amount")]
    df = df.filter(busy[0] | F.coalesce(F.col("prev_mrr") > 0, F.lit(False)) | busy[1] | busy[2])
    movement = F.col("mrr_movement")
    df = df.withColumns(
        {
            "mrr_delta": F.col("mrr") - F.coalesce("prev_mrr", F.lit(0)),
            "mrr_pct_change": pct_change(F.col("mrr"), F.col("prev_mrr")),
            "mrr_movement": month_movement(),
        }
    )
    flags = {f"is_{m}": movement == m for m in ("new", "expansion", "contraction", "churn", "unchanged", "mixed")}
    named = enrich(
        df, customers, "customer_id", {c: c for c in CUSTOMER_CONTEXT} | {"status": "customer_status"}
    ).withColumns(flags)
    return named.select(
        "customer_id", *CUSTOMER_CONTEXT, "customer_status", "mrr_month", "mrr", "prev_mrr", "mrr_delta",
        "mrr_pct_change", "mrr_movement", "active_sub_count", "new_mrr_amount", "churn_mrr_amount",
        "expansion_mrr", "contraction_mrr", "expansion_count", "contraction_count", *flags,
    )


def mart_mrr(movements: DataFrame, health: DataFrame) -> DataFrame:
    """Movements with the customer's health score."""
    df = enrich(movements, health, "customer_id", {"health_score": "health_score", "mrr_at_risk": "mrr_at_risk"})
    return df.select(*movements.columns, "health_score", risk_tier(F.col("health_score")).alias("risk_tier"), "mrr_at_risk")


def nrr_by_region(movements: DataFrame, *within: str) -> DataFrame:
    """Waterfall sums per month and region, and per ``within``. A customer has one row per month, so counts need no distinct."""
    prev = F.coalesce("prev_mrr", F.lit(0))
    return movements.groupBy(*within, "mrr_month", "region").agg(
        F.sum("new_mrr_amount").alias("new_mrr"),
        F.sum("expansion_mrr").alias("expansion_mrr"),
        F.sum("contraction_mrr").alias("contraction_mrr"),
        F.sum("churn_mrr_amount").alias("churn_mrr"),
        F.sum(F.when(F.col("mrr_movement") == "reactivation", F.col("mrr")).otherwise(0)).alias("reactivation_mrr"),
        F.sum(prev).alias("starting_mrr"),
        F.sum("mrr").alias("ending_mrr"),
        F.count_if(F.col("mrr") > 0).alias("active_customers"),
        F.count_if(F.col("churn_mrr_amount") > 0).alias("churned_customers"),
        F.count_if((F.col("new_mrr_amount") > 0) & (prev == 0)).alias("new_customers"),
    )


def mart_nrr(movements: DataFrame) -> DataFrame:
    """Monthly waterfall and retention ratios per region and for ``ALL``."""
    return retention(nrr_by_region(movements))


def retention(detail: DataFrame) -> DataFrame:
    """:func:`mart_nrr` from waterfall sums, which may come in several parts per month and region."""
    sums = {c: F.sum(c) for c in detail.columns if c not in ("mrr_month", "region")}
    df = with_total(detail, ["mrr_month"], "region", sums)
    start, expansion = F.col("starting_mrr"), F.col("expansion_mrr")
    contraction, churn = F.col("contraction_mrr"), F.col("churn_mrr")
    amounts = ["starting_mrr", "new_mrr", "expansion_mrr", "contraction_mrr", "churn_mrr", "reactivation_mrr", "ending_mrr"]
    return df.select(
        "mrr_month", "region",
        *[F.round(c, 2).cast("decimal(28,2)").alias(c) for c in amounts],
        round_half_up(calc_nrr(start, expansion, contraction, churn) * 100, 1).alias("nrr_pct"),
        round_half_up(safe_divide(start - contraction - churn, start) * 100, 1).alias("grr_pct"),
        pct_change(F.col("ending_mrr"), start).alias("ending_mrr_pct_change"),
        round_half_up(safe_divide(churn, start) * 100, 2).alias("churn_rate_pct"),
        "active_customers", "new_customers", "churned_customers",
    )


def amendment_timing(amendments: DataFrame, subscriptions: DataFrame, p: Params = Params()) -> DataFrame:
    """Gained and lost revenue per customer and month: by contract date and by booking date.

    By contract date an amendment counts on its effective date, or on the start of its subscription if that
    is later. It is booked on its effective date, or when it was created if that is later. ``moved_amendments``
    counts the amendments that the two put into different months, in both of them. Amendments without an effective
    date are left out.
    """
    dated = enrich(amendments, subscriptions, "subscription_id", {"start_date": "_start"})
    effective, delta = F.col("effective_date"), F.col("mrr_delta")
    restated, booked = F.greatest(effective, "_start"), F.greatest(effective, "created_date")
    moved = (month_start(restated) != month_start(booked)).cast("long")
    none = F.lit(0)

    def entry(at: Column, by_contract: bool) -> Column:
        amounts = {"expansion_mrr": gained(delta), "contraction_mrr": lost(delta)}
        shown = {name: x if by_contract else none for name, x in amounts.items()}
        shown |= {f"booked_{name}": none if by_contract else x for name, x in amounts.items()}
        fields = [x.cast("decimal(13,2)").alias(name) for name, x in shown.items()]
        return F.struct(at.alias("_at"), *fields, moved.alias("moved_amendments"))

    entries = dated.filter(effective.isNotNull()).select(
        "customer_id", F.inline(F.array(entry(restated, True), entry(booked, False)))
    )
    measures = [c for c in entries.columns if c not in ("customer_id", "_at")]
    return (
        entries.filter(_in_window(F.col("_at"), p))
        .groupBy("customer_id", month_start(F.col("_at")).alias("mrr_month"))
        .agg(*[F.sum(c).alias(c) for c in measures])
    )


def restated_nrr(movements: DataFrame, amendments: DataFrame, subscriptions: DataFrame, p: Params = Params()) -> DataFrame:
    """Net revenue retention by contract date next to the one booked at the time, per month and region and for ``ALL``.

    ``is_restated`` marks the rows that a later amendment has changed. As in :func:`mart_nrr`, amounts of customers
    without revenue in a month, the month before or a start or end in it don't count.
    """
    timing = amendment_timing(amendments, subscriptions, p)
    measures = [c for c in timing.columns if c not in KEY]
    df = movements.select(*KEY, "region", F.coalesce("prev_mrr", F.lit(0)).alias("starting_mrr"), F.col("churn_mrr_amount").alias("churn_mrr"))
    sums = {c: F.coalesce(F.sum(c), F.lit(0)) for c in ("starting_mrr", "churn_mrr", *measures)}
    detail = df.join(timing, KEY, "left").groupBy("mrr_month", "region").agg(*[x.alias(n) for n, x in sums.items()])
    both = with_total(detail, ["mrr_month"], "region", sums)

    def percent(expansion: str, contraction: str) -> Column:
        return round_half_up(calc_nrr(F.col("starting_mrr"), F.col(expansion), F.col(contraction), F.col("churn_mrr")) * 100, 1)

    return both.select(
        "mrr_month", "region", "starting_mrr", "churn_mrr", *measures,
        percent("expansion_mrr", "contraction_mrr").alias("nrr_pct"),
        percent("booked_expansion_mrr", "booked_contraction_mrr").alias("booked_nrr_pct"),
        (F.col("moved_amendments") > 0).alias("is_restated"),
    )
