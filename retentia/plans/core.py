"""Dimensions and facts: latest versions, enrichment joins, flags and movement classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retentia.functions import cleaning as cl
from retentia.functions.calendar import boundaries_crossed
from retentia.functions.finance import mrr_movement
from retentia.operators.intervals import valid_at_join
from retentia.operators.versions import first_and_latest, latest_per_key, previous_row
from retentia.params import Params
from retentia.plans.staging import ROW_ORDER
from retentia.sources.bucketed import BucketedTables
from retentia.sources.store import Keep, as_is

CUSTOMER_CONTEXT = ["company_name", "region", "account_tier"]


# --- dimensions -------------------------------------------------------------------------------


def with_resolved_region(customers: DataFrame, country_region: DataFrame | None = None) -> DataFrame:
    """Fill a missing region from the country, else ``UNKNOWN``; ``region_was_inferred`` marks the filled ones.

    ``country_region`` (country, region) replaces the built-in mapping; it joins as an ordinary
    table, which Spark broadcasts when its size allows.
    """
    if country_region is None:
        inferred, df = cl.fixed_region(F.col("country")), customers
    else:
        mapping = country_region.select(F.col("country"), F.col("region").alias("_mapped"))
        inferred, df = F.col("_mapped"), customers.join(mapping, "country", "left")
    return df.select(
        *[c for c in customers.columns if c != "region"],
        F.coalesce("region", inferred, F.lit("UNKNOWN")).alias("region"),
        F.col("region").isNull().alias("region_was_inferred"),
    )


def dim_customers(stg: DataFrame, country_region: DataFrame | None = None) -> DataFrame:
    return with_resolved_region(stg, country_region).select(
        "customer_id",
        cl.customer_key(F.col("customer_id")).alias("customer_key"),
        "company_name",
        "industry",
        "country",
        "city",
        "region",
        "region_was_inferred",
        "account_owner",
        "account_tier",
        "status",
        "employee_count",
        "annual_revenue_usd",
        "signup_date",
        "notes",
    )


def dim_plans(stg: DataFrame) -> DataFrame:
    return stg.select(
        "plan_id",
        "plan_name",
        cl.plan_tier(F.col("plan_id")).alias("plan_tier"),
        "base_price",
        "billing_model",
        "api_limit",
        "storage_gb",
        "features",
        cl.feature_count(F.col("features")).alias("feature_count"),
        "effective_date",
        "is_active",
        (~F.col("is_active")).alias("is_legacy"),
    )


def _renewal(p: Params, start: Column, cycle: Column) -> Column:
    """Next renewal of a running subscription after the reference date."""
    ref = F.lit(p.ref_date)
    if p.renewal == "boundary":
        # Counts calendar boundaries, so a subscription may be carried one period too far.
        units = {"monthly": ("month", 1), "quarterly": ("quarter", 3), "annual": ("year", 12)}
        chain = F
        for name, (unit, months) in units.items():
            chain = chain.when(
                cycle == name, F.add_months(start, (boundaries_crossed(start, ref, unit) + 1) * months)
            )
        return chain
    length = cl.lookup(cl.CYCLE_MONTHS, cycle)
    whole = F.greatest(F.floor(boundaries_crossed(start, ref, "month") / length).cast("int"), F.lit(1))
    early = F.add_months(start, whole * length)
    return F.when(early > ref, early).otherwise(F.add_months(start, (whole + 1) * length))


def resolved_subscriptions(stg: DataFrame, p: Params = Params()) -> DataFrame:
    """Subscriptions with a usable end date and how it was obtained; a projection, no shuffle."""
    start, end, status, cycle = F.col("start_date"), F.col("end_date"), F.col("status"), F.col("billing_cycle")
    ended, running = status.isin("cancelled", "expired"), status.isin("active", "suspended")
    one_cycle = F.add_months(start, cl.lookup(cl.CYCLE_MONTHS, cycle))
    resolved = F.when(end.isNotNull(), end).when(ended, one_cycle).when(running, _renewal(p, start, cycle))
    method = (
        F.when(end.isNotNull(), "source")
        .when(ended, "cycle_estimate")
        .when(running, "next_renewal")
        .otherwise("unknown")
    )
    return stg.select(
        "subscription_id",
        "customer_id",
        "plan_id",
        "status",
        "billing_cycle",
        cl.cycle_rank(cycle).alias("cycle_rank"),
        "auto_renew",
        "start_date",
        "end_date",
        resolved.alias("end_date_resolved"),
        method.alias("end_date_method"),
        "mrr",
    )


def dim_subscriptions(stg: DataFrame, p: Params = Params(), reactivation: bool = False) -> DataFrame:
    """Subscriptions with their customer's previous one: revenue and commitment movement.

    ``reactivation`` labels a customer who comes back after a cancellation instead of comparing prices.
    """
    previous = ["mrr", "plan_id", "billing_cycle", "cycle_rank", "status"]
    df = previous_row(
        resolved_subscriptions(stg, p), "customer_id", "start_date", ["start_date", "subscription_id"], previous
    )
    mrr, rank = F.col("mrr"), F.col("cycle_rank")
    chain = F.when(F.col("prev_mrr").isNull(), "new")
    if reactivation:
        chain = chain.when((F.col("prev_status") == "cancelled") & (mrr > 0), "reactivation")
    movement = chain.when(mrr > F.col("prev_mrr"), "upgrade").when(mrr < F.col("prev_mrr"), "downgrade")
    commitment = (
        F.when(F.col("prev_cycle_rank").isNull(), "new")
        .when(rank > F.col("prev_cycle_rank"), "commitment_upgrade")
        .when(rank < F.col("prev_cycle_rank"), "commitment_downgrade")
    )
    return df.select(
        *[c for c in df.columns if not c.startswith("prev_")],
        "prev_mrr",
        F.round(mrr - F.coalesce("prev_mrr", F.lit(0)), 2).cast("decimal(12,2)").alias("mrr_delta"),
        movement.otherwise("unchanged").alias("mrr_movement"),
        commitment.otherwise("unchanged").alias("cycle_movement"),
        "prev_plan_id",
        "prev_billing_cycle",
        ((F.col("status") == "cancelled") & F.col("end_date").isNull()).alias("dq_cancelled_no_end_date"),
        (F.col("end_date").isNotNull() & (F.col("end_date") < F.col("start_date"))).alias("dq_end_before_start"),
    )


# --- enrichment -------------------------------------------------------------------------------


def enrich(facts: DataFrame, dimension: DataFrame, key: str, columns: dict[str, str], dim_key: str | None = None) -> DataFrame:
    """Left join a fact to a dimension with a unique key, adding ``columns`` (dimension name -> new name).

    No broadcast is forced: Spark broadcasts a dimension whose measured size is below the threshold
    and otherwise sort-merges, where adaptive execution splits hot keys of the fact side.
    """
    side = dimension.select(F.col(dim_key or key).alias("_dk"), *[F.col(c).alias(a) for c, a in columns.items()])
    return facts.join(side, facts[key] == side["_dk"], "left").drop("_dk")


def _with_customer(facts: DataFrame, customers: DataFrame, status: bool = True) -> DataFrame:
    columns = {c: c for c in CUSTOMER_CONTEXT} | ({"status": "customer_status"} if status else {})
    return enrich(facts, customers, "customer_id", columns)


def _with_plan(facts: DataFrame, plans: DataFrame) -> DataFrame:
    return enrich(facts, plans, "plan_id", {"plan_name": "plan_name", "plan_tier": "plan_tier"})


# --- facts ------------------------------------------------------------------------------------

def latest_invoices(stg: DataFrame) -> DataFrame:
    return latest_per_key(stg, ["invoice_id"], "batch_id", [ROW_ORDER, "amount", "status", "invoice_date"]).drop(ROW_ORDER)


def latest_payments(stg: DataFrame) -> DataFrame:
    return latest_per_key(stg, ["payment_id"], "batch_id", [ROW_ORDER, "amount", "status", "payment_date"]).drop(ROW_ORDER)


def latest_usage(stg: DataFrame) -> DataFrame:
    """One observation per customer, day and metric."""
    return latest_per_key(
        stg, ["customer_id", "event_date", "metric_name"], "batch_id", [ROW_ORDER, "quantity"]
    ).drop(ROW_ORDER)


def latest_tickets(stg: DataFrame) -> DataFrame:
    """One row per ticket: its creation day as first exported, everything else as last exported."""
    return first_and_latest(stg.drop(ROW_ORDER), "ticket_id", "batch_id", ["created_date"])


# What signals and summaries need of a ticket; the long texts stay behind at the scan.
TICKET_STATE = [
    "ticket_id", "customer_id", "category", "priority", "created_date", "resolved_date",
    "resolution_hours", "satisfaction_score", "batch_id",
]


def ticket_states(stg: DataFrame) -> DataFrame:
    """Latest tickets without their texts, with open, resolved and urgent flags."""
    solved = F.col("resolved_date").isNotNull()
    return latest_tickets(stg.select(*TICKET_STATE)).withColumns(
        {"is_resolved": solved, "is_open": ~solved, "is_high_priority": _urgent()}
    )


def _urgent() -> Column:
    return F.lower("priority").isin("critical", "high")


def invoice_context(stg: DataFrame, subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Latest invoices with subscription and plan, without customer columns (for other facts)."""
    found = enrich(
        latest_invoices(stg), subscriptions, "subscription_id", {"plan_id": "plan_id", "billing_cycle": "billing_cycle"}
    )
    return _with_plan(found.withColumnRenamed("status", "invoice_status"), plans)


def fct_invoices(
    stg: DataFrame, customers: DataFrame, subscriptions: DataFrame, plans: DataFrame, keep: Keep = as_is
) -> DataFrame:
    df = _with_customer(keep(invoice_context(stg, subscriptions, plans)), customers)
    return df.select(
        "invoice_id", "customer_id", "subscription_id", "plan_id",
        *CUSTOMER_CONTEXT, "customer_status", "plan_name", "plan_tier", "billing_cycle",
        "invoice_date", "due_date", "period_start", "period_end", "created_at",
        "amount", "tax_amount", "total_amount", "currency", "invoice_status", "line_items_count",
        (F.col("invoice_status") == "paid").alias("is_paid"),
        (F.col("invoice_status") == "overdue").alias("is_overdue"),
        (F.col("due_date") < F.col("invoice_date")).alias("dq_due_before_invoice"),
        F.col("customer_id").isNull().alias("dq_unresolved_customer"),
        "batch_id",
    )


# What a payment takes from its invoice.
PAYMENT_CONTEXT = ["subscription_id", "plan_id", "plan_name", "plan_tier", "billing_cycle", "invoice_status"]


def fct_payments(stg: DataFrame, customers: DataFrame, invoices: DataFrame, keep: Keep = as_is) -> DataFrame:
    """``invoices`` is :func:`invoice_context` or :func:`fct_invoices`."""
    df = keep(latest_payments(stg).withColumnRenamed("status", "payment_status"))
    df = keep(enrich(df, invoices, "invoice_id", {c: c for c in PAYMENT_CONTEXT}))
    return _payment_columns(_with_customer(df, customers))


def _payment_columns(df: DataFrame) -> DataFrame:
    status = F.col("payment_status")
    return df.select(
        "payment_id", "invoice_id", "customer_id", "subscription_id", "plan_id",
        *CUSTOMER_CONTEXT, "customer_status", "plan_name", "plan_tier", "billing_cycle", "invoice_status",
        "payment_date", "amount", "payment_method", "payment_status", "transaction_ref", "processor_fee", "net_amount",
        (status == "completed").alias("is_completed"),
        (status == "failed").alias("is_failed"),
        (status == "refunded").alias("is_refunded"),
        F.col("customer_id").isNull().alias("dq_unresolved_customer"),
        (F.col("invoice_id").isNull() | F.col("invoice_status").isNull()).alias("dq_no_invoice_match"),
        "batch_id",
    )


def store_payment_layers(tables: BucketedTables, payments: DataFrame, invoices: DataFrame) -> None:
    """Latest payments (from staging) and :func:`fct_invoices`, both by bucket of the invoice."""
    tables.write("payments", latest_payments(payments).withColumnRenamed("status", "payment_status"), "invoice_id")
    tables.write("invoices", invoices, "invoice_id")


def fct_payments_from_layers(tables: BucketedTables, customers: DataFrame) -> DataFrame:
    """:func:`fct_payments` from stored layers: payments and invoices are merged bucket by bucket, without a shuffle.

    A payment by the customer of its invoice takes that customer's columns from the invoice, which
    has them as of when it was stored. Only other payments are joined to ``customers``.
    """
    context = {c: f"_{c}" for c in ("customer_id", *CUSTOMER_CONTEXT, "customer_status")}
    found = tables.left_join("payments", "invoices", {c: c for c in PAYMENT_CONTEXT} | context)
    same = F.coalesce(F.col("customer_id") == F.col("_customer_id"), F.lit(False))
    known = found.filter(same).withColumns({c: F.col(f"_{c}") for c in context if c != "customer_id"})
    rest = _with_customer(found.filter(~same).drop(*context.values()), customers)
    return _payment_columns(known.drop(*context.values()).unionByName(rest))


def usage_with_subscription(usage: DataFrame, subscriptions: DataFrame, stg: DataFrame | None = None) -> DataFrame:
    """Each observation with the latest-started running subscription valid on its day.

    ``stg`` is the staging table ``usage`` was taken from; reading its days saves a deduplication.
    """
    return valid_at_join(
        usage,
        subscriptions.filter(F.col("status").isin("active", "suspended")),
        key="customer_id",
        at="event_date",
        start="start_date",
        end="end_date_resolved",
        rank=["start_date", "subscription_id"],
        carry=["subscription_id", "plan_id", "billing_cycle"],
        days_of=stg,
    )


def fct_usage_events(stg: DataFrame, customers: DataFrame, subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    df = _with_plan(usage_with_subscription(latest_usage(stg), subscriptions, stg), plans)
    return _with_customer(df, customers).select(
        "customer_id", "event_date", "metric_name", "quantity", "unit",
        *CUSTOMER_CONTEXT, "customer_status", "subscription_id", "plan_id", "plan_name", "plan_tier", "billing_cycle",
        F.col("company_name").isNull().alias("dq_unresolved_customer"),
        F.col("subscription_id").isNull().alias("dq_no_active_subscription"),
        "batch_id",
    )


def fct_support_tickets(stg: DataFrame, customers: DataFrame) -> DataFrame:
    created, resolved = F.col("created_date"), F.col("resolved_date")
    return _with_customer(latest_tickets(stg), customers).select(
        "ticket_id", "customer_id", *CUSTOMER_CONTEXT, "customer_status",
        "category", "priority", "channel", "agent_name",
        "created_date", "resolved_date", "resolution_hours", "satisfaction_score", "description",
        resolved.isNotNull().alias("is_resolved"),
        resolved.isNull().alias("is_open"),
        _urgent().alias("is_high_priority"),
        (F.col("customer_id").isNull() | F.col("company_name").isNull()).alias("dq_unresolved_customer"),
        (resolved.isNotNull() & (resolved < created)).alias("dq_resolved_before_created"),
        "batch_id",
    )


# What an adjustment takes from its invoice.
ADJUSTMENT_CONTEXT = ["subscription_id", "plan_id", "invoice_status"]


def fct_adjustments(stg: DataFrame, customers: DataFrame, invoices: DataFrame, keep: Keep = as_is) -> DataFrame:
    """Adjustment ids restart with every batch, so all rows are kept. ``invoices`` as in :func:`fct_payments`."""
    df = keep(enrich(stg, invoices, "invoice_id", {c: c for c in ADJUSTMENT_CONTEXT}))
    df = _with_customer(df, customers, status=False)
    kind = F.col("adjustment_type")
    return df.select(
        "adjustment_id", "customer_id", "invoice_id", "subscription_id", "plan_id",
        *CUSTOMER_CONTEXT, "invoice_status", "adjustment_type", "amount",
        cl.revenue_impact(kind, F.col("amount")).alias("revenue_impact"),
        "reason", "effective_date", "created_date", "approved_by", "status", "reverses_adjustment_id",
        (F.col("status") == "approved").alias("is_approved"),
        kind.isin("credit", "refund").alias("is_customer_relief"),
        (kind == "write_off").alias("is_write_off"),
        F.col("reverses_adjustment_id").isNotNull().alias("is_reversal"),
        (F.col("customer_id").isNull() | F.col("company_name").isNull()).alias("dq_unresolved_customer"),
        "batch_id",
    )


def amendment_deltas(stg: DataFrame) -> DataFrame:
    """Amendments with the change in recurring revenue they bring; all rows kept, as for adjustments."""
    return stg.withColumn("mrr_delta", F.round(F.col("new_mrr") - F.col("old_mrr"), 2).cast("decimal(13,2)"))


def fct_contract_amendments(stg: DataFrame, customers: DataFrame, plans: DataFrame) -> DataFrame:
    named = {"plan_name": "new_plan_name", "plan_tier": "new_plan_tier"}
    df = _with_customer(enrich(amendment_deltas(stg), plans, "new_plan_id", named, "plan_id"), customers, status=False)
    kind, delta = F.col("amendment_type"), F.col("mrr_delta")
    return df.select(
        "amendment_id", "customer_id", "subscription_id", "old_plan_id", "new_plan_id",
        *CUSTOMER_CONTEXT, "new_plan_name", "new_plan_tier",
        "amendment_type", "old_mrr", "new_mrr", "mrr_delta", "effective_date", "created_date", "reason", "approved_by",
        mrr_movement(F.col("new_mrr"), F.col("old_mrr")).alias("mrr_movement"),
        (F.col("effective_date") < F.col("created_date")).alias("is_retroactive"),
        (kind == "cancellation").alias("is_cancellation"),
        kind.isin("upgrade", "add_on").alias("is_expansion"),
        (kind == "downgrade").alias("is_contraction"),
        (delta > 0).alias("is_mrr_increase"),
        (delta < 0).alias("is_mrr_decrease"),
        (F.col("customer_id").isNull() | F.col("company_name").isNull()).alias("dq_unresolved_customer"),
        "batch_id",
    )
