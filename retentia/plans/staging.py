"""Typed, trimmed, normalised views of the raw tables; one narrow projection per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retentia.functions import cleaning as cl
from retentia.params import Params

# Optional load order of raw rows; carried through so that equal versions have a total order.
ROW_ORDER = "_row_seq"


def _text(name: str) -> Column:
    return cl.blank_to_null(F.col(name)).alias(name)


def _label(name: str) -> Column:
    return cl.label(F.col(name)).alias(name)


def _date(name: str, alias: str | None = None) -> Column:
    return cl.as_date(F.col(name)).alias(alias or name)


def _utc_date(name: str, alias: str) -> Column:
    return cl.as_utc_date(F.col(name)).alias(alias)


def _int(name: str, alias: str | None = None) -> Column:
    return cl.as_int(F.col(name)).alias(alias or name)


def _decimal(name: str, kind: str) -> Column:
    return F.col(name).try_cast(f"decimal({kind})").alias(name)


def _customer(p: Params) -> Column:
    return cl.normalize_customer_id(F.col("customer_id"), p.id_width).alias("customer_id")


def _project(raw: DataFrame, *columns: Column | str) -> DataFrame:
    return raw.select(*columns, *[c for c in (ROW_ORDER,) if c in raw.columns])


def stg_customers(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "customer_id",
        _text("company_name"),
        _text("industry"),
        cl.blank_to_null(F.upper("region")).alias("region"),
        _text("country"),
        _text("city"),
        _date("signup_date"),
        _text("account_owner"),
        _label("status"),
        cl.blank_to_null(F.lower("email")).alias("email"),
        _text("phone"),
        _int("employee_count"),
        cl.as_long(F.col("annual_revenue_usd")).alias("annual_revenue_usd"),
        cl.note_text(F.col("notes")).alias("notes"),
        _text("account_tier"),
    )


def stg_plans(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "plan_id",
        _text("plan_name"),
        _decimal("base_price", "10,2"),
        _text("billing_model"),
        _int("api_limit"),
        _int("storage_gb"),
        _text("features"),
        _date("effective_date"),
        F.col("is_active").cast("boolean").alias("is_active"),
    )


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "subscription_id",
        "customer_id",
        "plan_id",
        _date("start_date"),
        _date("end_date"),
        _decimal("mrr", "10,2"),
        _text("billing_cycle"),
        F.col("auto_renew").cast("boolean").alias("auto_renew"),
        _label("status"),
    )


def stg_invoices(raw: DataFrame, p: Params = Params()) -> DataFrame:
    return _project(
        raw,
        "invoice_id",
        _customer(p),
        _text("subscription_id"),
        _date("invoice_date"),
        _date("due_date"),
        _decimal("amount", "12,2"),
        _text("currency"),
        _label("status"),
        _int("line_items_count"),
        _decimal("tax_amount", "12,2"),
        _decimal("total_amount", "12,2"),
        _date("period_start"),
        _date("period_end"),
        _date("created_at"),
        _int("_batch_id", "batch_id"),
    )


def stg_payments(raw: DataFrame, p: Params = Params()) -> DataFrame:
    return _project(
        raw,
        "payment_id",
        _text("invoice_id"),
        _customer(p),
        _decimal("amount", "12,2"),
        _label("payment_method"),
        _utc_date("payment_date", "payment_date"),
        _label("status"),
        _text("transaction_ref"),
        _decimal("processor_fee", "10,4"),
        _decimal("net_amount", "12,2"),
        _int("_batch_id", "batch_id"),
    )


def union_late_events(usage: DataFrame, late: DataFrame) -> DataFrame:
    """Regular and late-delivered usage, matched by column name."""
    return usage.unionByName(late, allowMissingColumns=True)


def stg_usage_events(raw: DataFrame, late: DataFrame | None = None) -> DataFrame:
    return _project(
        raw if late is None else union_late_events(raw, late),
        _text("customer_id"),
        _date("event_date"),
        _label("metric_name"),
        _decimal("quantity", "14,4"),
        _label("unit"),
        _int("_batch_id", "batch_id"),
    )


def stg_support_tickets(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "ticket_id",
        _text("customer_id"),
        _label("category"),
        _label("priority"),
        _utc_date("created_at", "created_date"),
        _utc_date("resolved_at", "resolved_date"),
        _decimal("resolution_hours", "10,2"),
        _decimal("satisfaction_score", "3,1"),
        _text("agent_name"),
        _label("channel"),
        _text("description"),
        _int("_batch_id", "batch_id"),
    )


def stg_product_events(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "event_id",
        _text("customer_id"),
        cl.canonical_feature(F.col("feature")).alias("feature"),
        _label("action"),
        _utc_date("timestamp", "event_date"),
        _text("session_id"),
        _text("user_agent"),
        _int("_batch_id", "batch_id"),
    )


def stg_adjustments(raw: DataFrame, p: Params = Params()) -> DataFrame:
    return _project(
        raw,
        "adjustment_id",
        _customer(p),
        _text("invoice_id"),
        _label("adjustment_type"),
        _decimal("amount", "12,2"),
        _text("reason"),
        cl.as_us_date(F.col("effective_date")).alias("effective_date"),
        cl.as_us_date(F.col("created_at")).alias("created_date"),
        _text("approved_by"),
        _label("status"),
        _text("reverses_adjustment_id"),
        _int("_batch_id", "batch_id"),
    )


def stg_contract_amendments(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        "amendment_id",
        _text("customer_id"),
        _text("subscription_id"),
        _label("amendment_type"),
        _text("old_plan_id"),
        _text("new_plan_id"),
        _decimal("old_mrr", "12,2"),
        _decimal("new_mrr", "12,2"),
        _date("effective_date"),
        _utc_date("created_at", "created_date"),
        _text("reason"),
        _text("approved_by"),
        _int("_batch_id", "batch_id"),
    )
