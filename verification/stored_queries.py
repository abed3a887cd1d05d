"""Stored models: checked while written, compared batch by batch, counted by bitmaps, read by region."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from retentia.functions.calendar import month_start
from retentia.operators.distinct import KeyNumbers, distinct_keys, key_bitmaps, shared_keys
from retentia.plans import core, quality
from retentia.plans.audited import AuditedTables, Rejected
from retentia.plans.drift import KeySets
from retentia.session import scratch_dir
from retentia.sources.batches import BATCHES
from retentia.sources.bucketed import BucketedTables
from retentia.sources.scoped import RegionTable
from retentia.sources.store import materialise
from verification.models import steps
from verification.oracle import month, oracle
from verification.registry import query
from verification.report_queries import FLAGS_SQL, _drift, _expectation, raw_tables

_STAGED = ("stg_customers", "stg_plans", "stg_subscriptions", "dim_customers")
_LARGE = ("raw_invoices", "raw_payments", "raw_usage_events")


@query("audited_models", oracle(" UNION ALL ".join(_expectation(e) for e in quality.EXPECTATIONS if e.table in (*_STAGED, *_LARGE))))
def _(m):
    """The report of a write that checks as it goes; regions outside the list keep it from being published."""
    models, raw = {n: getattr(m, n) for n in _STAGED}, raw_tables(m)
    try:
        return AuditedTables(m.spark, scratch_dir(m.spark, "audited")).publish(models | {n: raw[n] for n in _LARGE})
    except Rejected as rejected:
        return rejected.report


@query("published_models", oracle("SELECT subscription_id, customer_id, plan_id, status, mrr FROM stg_subscriptions", DOUBLE="mrr"))
def _(m):
    """A table that stays as it was published while a later one, with its keys repeated, is rejected."""
    store = AuditedTables(m.spark, scratch_dir(m.spark, "audited"))
    rows = m.stg_subscriptions.select("subscription_id", "customer_id", "plan_id", "status", "mrr")
    checks = [c for c in quality.EXPECTATIONS if c.table == "stg_subscriptions" and c.check != "accepted_values"]
    store.publish({"stg_subscriptions": rows}, checks)
    try:
        store.publish({"stg_subscriptions": rows.unionByName(rows.withColumn("mrr", F.col("mrr") * 2))}, checks)
    except Rejected:
        return store.read("stg_subscriptions")
    raise AssertionError("repeated keys were published")


@query("stored_dq_flags", FLAGS_SQL)
def _(m):
    """Flags counted by the writes that build the layers; each layer reads the stored ones below it, so nothing is built twice.

    A fact's joins run one after the other; what is stored between them goes when the fact is written.
    """
    store, keep = AuditedTables(m.spark, scratch_dir(m.spark, "layers")), steps(m)
    store.publish({"dim_customers": m.dim_customers, "dim_subscriptions": m.dim_subscriptions}, ())
    customers = store.read("dim_customers")
    store.publish({"fct_invoices": core.fct_invoices(m.stg_invoices, customers, m.subscriptions, m.dim_plans, keep)}, ())
    keep.clear()
    invoices = store.read("fct_invoices")
    facts = {
        "fct_payments": lambda: core.fct_payments(m.stg_payments, customers, invoices, keep),
        "fct_usage_events": lambda: core.fct_usage_events(m.stg_usage_events, customers, m.subscriptions, m.dim_plans),
        "fct_support_tickets": lambda: core.fct_support_tickets(m.stg_support_tickets, customers),
        "fct_adjustments": lambda: core.fct_adjustments(m.stg_adjustments, customers, invoices, keep),
        "fct_contract_amendments": lambda: core.fct_contract_amendments(m.stg_contract_amendments, customers, m.dim_plans),
    }
    with store.snapshots.change():  # readers see all facts or none
        for name, rows in facts.items():
            store.publish({name: rows()}, ())
            keep.clear()
    return store.flags()


@query("stored_key_drift", oracle(" UNION ALL ".join(_drift(b) for b in (1, 2, 3))))
def _(m):
    """Each batch is compared with the stored keys of the one before it when it arrives."""
    sets, tickets = KeySets(m.spark, scratch_dir(m.spark, "keys"), "ticket_id"), m.raw("raw_support_tickets")
    for b in BATCHES:
        sets.put(b.batch_id, tickets.filter(F.col("_batch_id") == str(b.batch_id)))
    return sets.drift()


def usage_bitmaps(m) -> DataFrame:
    """Customers per month and metric, added batch by batch."""
    numbers, parts = KeyNumbers(m.spark, scratch_dir(m.spark, "numbers"), "customer_id"), []
    usage = m.stg_usage_events.withColumn("month", month_start(F.col("event_date")))
    for b in BATCHES:
        own = usage.filter(F.col("batch_id") == b.batch_id)
        made = key_bitmaps(own, ["month", "metric_name"], "customer_id", numbers.extend(own))
        parts.append(materialise(made, scratch_dir(m.spark, "bitmaps")))
    return reduce(DataFrame.unionByName, parts)


_MONTH = month("event_date")


@query(
    "bitmap_distinct_counts",
    oracle(f"""SELECT month, metric_name, count(DISTINCT customer_id) AS customers
               FROM (SELECT {_MONTH} AS month, metric_name, customer_id FROM stg_usage_events) AS u
               GROUP BY GROUPING SETS ((month, metric_name), (month), (metric_name), ())"""),
)
def _(m):
    """Distinct customers at four levels; only bitmaps are read above the finest one."""
    bitmaps = usage_bitmaps(m)
    levels = [distinct_keys(bitmaps, g, "customers") for g in (["month", "metric_name"], ["month"], ["metric_name"], [])]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), levels)


def _active(first: str) -> str:
    return f"(SELECT customer_id FROM stg_usage_events WHERE {_MONTH} = DATE '{first}' AND customer_id IS NOT NULL)"


_JAN, _FEB = _active("2024-01-01"), _active("2024-02-01")


@query(
    "active_customer_flow",
    oracle(f"""SELECT (SELECT count(*) FROM ({_FEB} EXCEPT {_JAN}) AS g) AS gained, (SELECT count(*) FROM ({_JAN} EXCEPT {_FEB}) AS l) AS lost,
               (SELECT count(*) FROM ({_JAN} INTERSECT {_FEB}) AS k) AS kept"""),
)
def _(m):
    return shared_keys(usage_bitmaps(m), "month", F.lit("2024-01-01").cast("date"), F.lit("2024-02-01").cast("date"))


@query("granted_regions", oracle("SELECT customer_id, company_name, region FROM dim_customers WHERE region IN (SELECT r_name FROM region WHERE r_name LIKE 'A%')"))
def _(m):
    """Customers stored by region, read by the user who covers the regions with an initial A."""
    customers = m.dim_customers.select("customer_id", "company_name", "region")
    served = RegionTable(m.spark, scratch_dir(m.spark, "served")).write(customers)
    grants = m.base("region").select(F.lower(F.substring("r_name", 1, 1)).alias("user"), F.col("r_name").alias("region"))
    return served.granted(customers.schema, grants, "a")


@query("co_located_payments", oracle("SELECT * FROM fct_payments", DOUBLE="amount processor_fee net_amount"))
def _(m):
    """Payments from stored layers that are bucketed by invoice."""
    tables = BucketedTables(m.spark, scratch_dir(m.spark, "bucketed"), buckets=8, hot=100_000)
    core.store_payment_layers(tables, m.stg_payments, m.fct_invoices)
    return core.fct_payments_from_layers(tables, m.dim_customers)
