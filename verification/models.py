"""The models built from the test tables, each defined once and composed lazily."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from retentia import Params, configure
from retentia.plans import core, health, referrals, revenue, signals, staging, support
from retentia.plans.ingest import CODEC
from retentia.session import scratch_dir
from retentia.sources.store import Keep, Steps, as_is, materialise, spread
from verification.bindings import BINDINGS

PARAMS = Params(id_width=9)
FACT_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id"}
BASE_TABLES = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events"]

# The three exports of each ticket, spelled as a generator on the Spark side.
_SPARK_SPELLING = (
    "CROSS JOIN (SELECT 1 AS b UNION ALL SELECT 2 UNION ALL SELECT 3) bs",
    "LATERAL VIEW explode(array(1, 2, 3)) bs AS b",
)
# What invoices, payments and adjustments are read from, and its name when it is stored.
_LINES, _STORED_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey", "order_lines"


class Models:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = PARAMS, bindings: dict[str, str] = BINDINGS):
        self.spark, self.dir, self.p, self.bindings = configure(spark), sf_dir.rstrip("/"), params, bindings

        self._base: dict[str, DataFrame] = {}
        self._raw: dict[str, DataFrame] = {}
        self.keep: Keep = as_is

    def base(self, table: str) -> DataFrame:
        if table not in self._base:
            stored = self.spark.read.parquet(f"{self.dir}/{table}.parquet")
            self._base[table] = spread(stored, FACT_KEYS[table]) if table in FACT_KEYS else stored
        return self._base[table]

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            text = self.bindings[name].replace(*_SPARK_SPELLING)
            for t in {*BASE_TABLES, *self._base}:
                if re.search(rf"\b{t}\b", text):
                    self.base(t).createOrReplaceTempView(t)
            self._raw[name] = self.spark.sql(text)
        return self._raw[name]

    @cached_property
    def country_region(self) -> DataFrame:
        return self.raw("country_region")

    # staging
    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw("raw_customers"))

    @cached_property
    def stg_plans(self) -> DataFrame:
        return staging.stg_plans(self.raw("raw_plans"))

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return staging.stg_subscriptions(self.raw("raw_subscriptions"))

    @cached_property
    def stg_invoices(self) -> DataFrame:
        return staging.stg_invoices(self.raw("raw_invoices"), self.p)

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.stg_payments(self.raw("raw_payments"), self.p)

    @cached_property
    def stg_usage_events(self) -> DataFrame:
        return staging.stg_usage_events(self.raw("raw_usage_events"), self.raw("raw_late_usage"))

    @cached_property
    def stg_support_tickets(self) -> DataFrame:
        return staging.stg_support_tickets(self.raw("raw_support_tickets"))

    @cached_property
    def stg_product_events(self) -> DataFrame:
        return staging.stg_product_events(self.raw("raw_product_events"))

    @cached_property
    def stg_adjustments(self) -> DataFrame:
        return staging.stg_adjustments(self.raw("raw_adjustments"), self.p)

    @cached_property
    def stg_contract_amendments(self) -> DataFrame:
        return staging.stg_contract_amendments(self.raw("raw_contract_amendments"))

    # core
    @cached_property
    def dim_customers(self) -> DataFrame:
        return core.dim_customers(self.stg_customers, self.country_region)

    @cached_property
    def dim_plans(self) -> DataFrame:
        return core.dim_plans(self.stg_plans)

    @cached_property
    def subscriptions(self) -> DataFrame:
        return core.resolved_subscriptions(self.stg_subscriptions, self.p)

    @cached_property
    def dim_subscriptions(self) -> DataFrame:
        return core.dim_subscriptions(self.stg_subscriptions, self.p)

    @cached_property
    def latest_invoices(self) -> DataFrame:
        return core.latest_invoices(self.stg_invoices).withColumnRenamed("status", "invoice_status")

    @cached_property
    def latest_payments(self) -> DataFrame:
        return core.latest_payments(self.stg_payments).withColumnRenamed("status", "payment_status")

    @cached_property
    def latest_usage(self) -> DataFrame:
        return core.latest_usage(self.stg_usage_events)

    @cached_property
    def latest_tickets(self) -> DataFrame:
        return core.latest_tickets(self.stg_support_tickets)

    @cached_property
    def invoice_context(self) -> DataFrame:
        return core.invoice_context(self.stg_invoices, self.subscriptions, self.dim_plans)

    @cached_property
    def fct_invoices(self) -> DataFrame:
        return core.fct_invoices(self.stg_invoices, self.dim_customers, self.subscriptions, self.dim_plans)

    @cached_property
    def fct_payments(self) -> DataFrame:
        invoices = self.keep(self.invoice_context.select("invoice_id", *core.PAYMENT_CONTEXT))
        return core.fct_payments(self.stg_payments, self.dim_customers, invoices, self.keep)

    @cached_property
    def fct_usage_events(self) -> DataFrame:
        return core.fct_usage_events(self.stg_usage_events, self.dim_customers, self.subscriptions, self.dim_plans)

    @cached_property
    def usage_by_region(self) -> DataFrame:
        """Latest usage with the customer's region only, for reports that need no subscription."""
        return core.enrich(self.latest_usage, self.dim_customers, "customer_id", {"region": "region"})

    @cached_property
    def fct_support_tickets(self) -> DataFrame:
        return core.fct_support_tickets(self.stg_support_tickets, self.dim_customers)

    @cached_property
    def ticket_states(self) -> DataFrame:
        return core.ticket_states(self.stg_support_tickets)

    @cached_property
    def tickets_by_region(self) -> DataFrame:
        """Ticket states with the customer's region, for reports that show no single tickets."""
        return core.enrich(self.ticket_states, self.dim_customers, "customer_id", {"region": "region"})

    @cached_property
    def fct_adjustments(self) -> DataFrame:
        invoices = self.keep(self.invoice_context.select("invoice_id", *core.ADJUSTMENT_CONTEXT))
        return core.fct_adjustments(self.stg_adjustments, self.dim_customers, invoices, self.keep)

    @cached_property
    def amendments(self) -> DataFrame:
        return core.amendment_deltas(self.stg_contract_amendments)

    @cached_property
    def fct_contract_amendments(self) -> DataFrame:
        return core.fct_contract_amendments(self.stg_contract_amendments, self.dim_customers, self.dim_plans)

    # signals and marts
    @cached_property
    def usage_stats(self) -> DataFrame:
        return signals.customer_usage_stats(self.latest_usage, self.dim_customers, self.p)

    @cached_property
    def ticket_engagement(self) -> DataFrame:
        return signals.ticket_engagement(self.ticket_states, self.latest_usage, self.p)

    @cached_property
    def support_signals(self) -> DataFrame:
        return signals.customer_support_signals(self.ticket_states, self.latest_usage, self.p)

    @cached_property
    def financial_signals(self) -> DataFrame:
        return signals.customer_financial_signals(self.latest_invoices, self.latest_payments, self.dim_subscriptions)

    @cached_property
    def health(self) -> DataFrame:
        return health.customer_health_score(
            self.dim_customers, self.usage_stats, self.support_signals, self.financial_signals, self.p
        )

    @cached_property
    def customer_months(self) -> DataFrame:
        return revenue.customer_months(self.dim_customers, self.subscriptions, self.amendments, self.p)

    @cached_property
    def movements(self) -> DataFrame:
        return revenue.mrr_movements(self.customer_months, self.dim_customers)

    @cached_property
    def mart_mrr(self) -> DataFrame:
        return revenue.mart_mrr(self.movements, self.health)

    @cached_property
    def mart_nrr(self) -> DataFrame:
        return revenue.mart_nrr(self.movements)

    @cached_property
    def referrals(self) -> DataFrame:
        return referrals.match_referrals(self.raw("raw_partner_referrals"), self.stg_customers)

    @cached_property
    def restated_nrr(self) -> DataFrame:
        return revenue.restated_nrr(self.movements, self.amendments, self.subscriptions, self.p)

    @cached_property
    def mart_support_summary(self) -> DataFrame:
        return support.mart_support_summary(self.tickets_by_region)


def steps(m: Models) -> Steps:
    return Steps(m.spark, scratch_dir(m.spark, "steps"), CODEC)


def stored_health(m: Models) -> tuple[DataFrame, DataFrame]:
    """Usage statistics and health, as ``m.usage_stats`` and ``m.health``, from usage that is read and picked once.

    Plans that read both would else compute the latest usage three times and its statistics twice. What the score is made
    of is stored one after the other.
    """
    keep = steps(m)
    usage = keep(m.latest_usage.select("customer_id", "event_date", "metric_name", "quantity"))
    stats = keep(signals.customer_usage_stats(usage, m.dim_customers, m.p))
    support = keep(signals.customer_support_signals(m.ticket_states, usage, m.p))
    financial = signals.customer_financial_signals(m.latest_invoices, m.latest_payments, m.dim_subscriptions, keep)
    return stats, health.customer_health_score(m.dim_customers, stats, support, financial, m.p)


def with_stored_lines(m: Models, keep: Keep | None = None) -> Models:
    """The same models, with order lines that are joined to their orders once and stored.

    A plan that builds several tables from lines would else shuffle all lines for each of them, as each reads other columns.
    """
    texts = [t.replace(_LINES, "") for t in m.bindings.values() if _LINES in t]
    lines = m.base("lineitem").join(m.base("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    used = [c for c in lines.columns if any(re.search(rf"\b{c}\b", t) for t in texts)]
    stored = (keep or steps(m))(lines.select(*used))
    found = Models(m.spark, m.dir, m.p, {n: t.replace(_LINES, _STORED_LINES) for n, t in m.bindings.items()})
    found._base[_STORED_LINES] = stored
    return found


def in_steps(m: Models, name: str) -> DataFrame:
    """Payments or adjustments, with order lines and the rows between two joins stored, of which only those that are left
    for the last join stay."""
    keep = steps(m)
    found = with_stored_lines(m, keep)
    found.keep = keep
    fact = getattr(found, name)
    keep.clear(but=1)
    return fact


_SHARED: dict[tuple[str, str], Models] = {}


def models_for(spark: SparkSession, sf_dir: str) -> Models:
    """The models over one folder of tables, defined once per application; only plans are kept, no data."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SHARED:
        _SHARED[key] = Models(spark, sf_dir)
    return _SHARED[key]
