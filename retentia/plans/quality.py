"""Profiles of raw tables, declarative column checks and the data-quality flags of the models."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from retentia.functions.cleaning import id_format
from retentia.functions.finance import round_half_up
from retentia.operators.intervals import most_at_once
from retentia.sources.batches import BATCH


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _batch(df: DataFrame) -> Column:
    return (F.col(BATCH).cast("int") if BATCH in df.columns else F.lit(None).cast("int")).alias("batch_id")


def _share(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percent of a whole, 0 where the whole is empty."""
    pct = round_half_up(part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * 100, digits)
    return F.coalesce(pct, F.lit(0.0))


# --- profiles ---------------------------------------------------------------------------------


def profile_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table and batch."""

    def one(name: str, df: DataFrame) -> DataFrame:
        width = len([c for c in df.columns if not c.startswith("_")])
        return df.groupBy(F.lit(name).alias("table_name"), _batch(df)).agg(
            F.count(F.lit(1)).alias("rows"), F.lit(width).alias("columns")
        )

    return _union([one(n, d) for n, d in tables.items()])


def null_rates(name: str, df: DataFrame) -> DataFrame:
    """Percent of NULLs of each column that has any; one pass over the table."""
    columns = [c for c in df.columns if not c.startswith("_")]
    missing = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns])
    long = missing.select("_n", F.inline(cells))
    return long.select(
        F.lit(name).alias("table_name"), "column_name", _share(F.col("nulls"), F.col("_n")).alias("null_pct")
    ).filter("null_pct > 0")


def profile_null_rates(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([null_rates(n, d) for n, d in tables.items()])


def profile_id_formats(customers: DataFrame, key: str = "customer_id") -> DataFrame:
    present = customers.filter(F.col(key).isNotNull())
    return present.groupBy(_batch(customers), id_format(F.col(key)).alias("id_format")).agg(F.count(F.lit(1)).alias("records"))


def profile_duplicate_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows beyond the first of each key, per table and batch; NULL counts as one key.

    Counted from rows per key, so many copies of one key are combined before they are shuffled.
    """

    def one(name: str, df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(_batch(df), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
        return per_key.groupBy("batch_id").agg(F.sum(F.col("n") - 1).alias("duplicates")).select(
            F.lit(name).alias("table_name"), F.lit(key).alias("key"), "batch_id", "duplicates"
        )

    return _union([one(n, d, k) for n, (d, k) in tables.items()])


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys of a child table that the parent does not have."""
    refs = child.select(F.col(key).cast("string").alias(key)).dropna().distinct()
    return refs.join(parent.select(F.col(key).cast("string").alias(key)), key, "left_anti")


def profile_orphans(children: dict[str, DataFrame], parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """Orphaned keys per child table and their share of the distinct keys used."""
    known = parent.select(F.col(key).cast("string").alias(key), F.lit(True).alias("_known")).dropna().distinct()

    def one(name: str, child: DataFrame) -> DataFrame:
        refs = child.select(F.col(key).cast("string").alias(key)).dropna().distinct()
        matched = refs.join(known, key, "left")
        orphans, total = F.count_if(F.col("_known").isNull()), F.count(F.lit(1))
        return matched.agg(orphans.alias("orphans"), _share(orphans, total).alias("orphan_pct")).select(
            F.lit(name).alias("table_name"), "orphans", "orphan_pct"
        )

    return _union([one(n, d) for n, d in children.items()])


def profile_subscription_overlap(subscriptions: DataFrame, by_period: bool = False) -> DataFrame:
    """Customers with more than one subscription that is open-ended or ends after it starts.

    ``by_period`` counts only those of which two run on the same day, and adds the most that do.
    """
    lasting = subscriptions.filter(
        F.col("customer_id").isNotNull() & (F.col("end_date").isNull() | (F.col("end_date") > F.col("start_date")))
    )
    if by_period:
        per_customer = most_at_once(lasting, "customer_id", "start_date", "end_date")
        overlapping = F.count_if(F.col("most_at_once") > 1).alias("customers_with_overlap")
        return per_customer.agg(overlapping, F.coalesce(F.max("most_at_once"), F.lit(0)).alias("most_at_once"))
    several = lasting.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return several.agg(F.count(F.lit(1)).alias("customers_with_several"))


def profile_date_range(df: DataFrame, column: str, batch: str = "batch_id") -> DataFrame:
    return df.groupBy(batch).agg(F.min(column).alias("first_date"), F.max(column).alias("last_date"))


def value_counts(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Frequency of each value, NULL included."""
    out = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return out if name is None else out.select(F.lit(name).alias("table_name"), "value", "rows")


def profile_status_distribution(tables: dict[str, DataFrame], column: str = "status") -> DataFrame:
    return _union([value_counts(d, column, n) for n, d in tables.items() if column in d.columns])


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have."""
    keys = left.select(key).dropna().distinct()
    return keys.join(right.select(key).dropna().distinct(), key, "left_anti")


def key_intersection(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).dropna().distinct().join(right.select(key), key, "left_semi")


def profile_batch_key_drift(df: DataFrame, key: str, batches: Sequence[int]) -> DataFrame:
    """Keys per batch, new against the batch before and dropped since it; one aggregation over all batches."""
    seen = [F.bool_or(F.col(BATCH).cast("int") == b).alias(f"b{b}") for b in batches]
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*seen)
    rows = []
    for i, b in enumerate(batches):
        here = F.col(f"b{b}")
        before = F.col(f"b{batches[i - 1]}") if i else None
        rows.append(
            F.struct(
                F.lit(b).alias("batch_id"),
                F.count_if(here).alias("keys"),
                (F.count_if(here & ~before) if i else F.lit(None).cast("long")).alias("new_keys"),
                (F.count_if(before & ~here) if i else F.lit(None).cast("long")).alias("dropped_keys"),
            )
        )
    return per_key.agg(F.array(*rows).alias("r")).select(F.inline("r"))


# --- expectations -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Expectation:
    """One check of one column: ``unique``, ``not_null`` or ``accepted_values``."""

    table: str
    column: str
    check: str
    severity: str = "error"
    values: tuple[str, ...] = ()


def failing_unique(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def failing_accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the list, with their frequency; NULL passes."""
    outside = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return outside.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


_REGIONS = ("NA", "EMEA", "APAC")
_CUSTOMER_STATUS = ("active", "churned", "suspended", "inactive", "trial")
_SUBSCRIPTION_STATUS = ("active", "cancelled", "suspended", "expired")


def _keyed(table: str, key: str, *more: str) -> list[Expectation]:
    return [Expectation(table, key, "unique"), *[Expectation(table, c, "not_null") for c in (key, *more)]]


def _present(table: str, *columns: str) -> list[Expectation]:
    return [Expectation(table, c, "not_null") for c in columns]


def _listed(table: str, column: str, values: tuple[str, ...], severity: str = "warn") -> Expectation:
    return Expectation(table, column, "accepted_values", severity, values)


# The checks declared for raw, staging and core tables.
EXPECTATIONS: list[Expectation] = [
    *_keyed("raw_customers", "customer_id", "company_name"),
    _listed("raw_customers", "region", _REGIONS),
    *_keyed("raw_plans", "plan_id"),
    *_keyed("raw_subscriptions", "subscription_id", "customer_id"),
    *_present("raw_invoices", "invoice_id", "customer_id"),
    *_present("raw_payments", "payment_id", "customer_id"),
    *_present("raw_usage_events", "customer_id"),
    *_present("raw_late_usage", "customer_id"),
    *_present("raw_support_tickets", "ticket_id", "customer_id"),
    *_present("raw_product_events", "event_id"),
    *_present("raw_adjustments", "adjustment_id"),
    *_present("raw_contract_amendments", "amendment_id"),
    *_keyed("stg_customers", "customer_id", "signup_date"),
    _listed("stg_customers", "status", _CUSTOMER_STATUS),
    _listed("stg_customers", "region", _REGIONS),
    *_keyed("stg_plans", "plan_id", "plan_name", "base_price"),
    *_keyed("stg_subscriptions", "subscription_id", "customer_id", "plan_id", "mrr"),
    _listed("stg_subscriptions", "status", _SUBSCRIPTION_STATUS),
    *_keyed("dim_customers", "customer_id", "region", "status"),
    *_keyed("dim_customers", "customer_key"),
    _listed("dim_customers", "region", (*_REGIONS, "UNKNOWN"), "error"),
    _listed("dim_customers", "status", _CUSTOMER_STATUS, "error"),
]


def run_expectations(tables: dict[str, DataFrame], checks: Sequence[Expectation] = EXPECTATIONS) -> DataFrame:
    """One row per check with the number of failures.

    All row checks of a table share one pass; each uniqueness check adds one keyed aggregation.
    """
    parts = []
    for name, df in tables.items():
        own = [c for c in checks if c.table == name]
        rowwise = [c for c in own if c.check != "unique"]
        if rowwise:
            counts = []
            for c in rowwise:
                col = F.col(c.column)
                failed = col.isNull() if c.check == "not_null" else col.isNotNull() & ~col.isin(list(c.values))
                counts.append(_report(c, F.count_if(failed)))
            parts.append(df.agg(F.array(*counts).alias("r")).select(F.inline("r")))
        for c in own:
            if c.check == "unique":
                repeated = failing_unique(df, c.column).agg(F.count(F.lit(1)).alias("n"))
                parts.append(repeated.select(F.inline(F.array(_report(c, F.col("n"))))))
    return _union(parts)


def _report(c: Expectation, failures: Column) -> Column:
    return F.struct(
        F.lit(c.table).alias("table_name"),
        F.lit(c.column).alias("column_name"),
        F.lit(c.check).alias("check_name"),
        F.lit(c.severity).alias("severity"),
        failures.alias("failures"),
    )


def require(report: DataFrame) -> None:
    """Raise if any error-level check failed; the report is as long as the list of checks."""
    broken = report.filter("severity = 'error' AND failures > 0").collect()
    if broken:
        lines = ", ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in broken)
        raise ValueError(f"data quality: {lines}")


# --- flags ------------------------------------------------------------------------------------


def flag_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("dq_") or c == "region_was_inferred"]


def dq_flag_counts(models: dict[str, DataFrame]) -> DataFrame:
    """Rows carrying each ``dq_`` flag (and inferred regions) per model; one pass per model."""
    parts = []
    for name, df in models.items():
        cells = [F.struct(F.lit(name).alias("model"), F.lit(c).alias("flag"), F.count_if(F.col(c)).alias("rows")) for c in flag_columns(df)]
        parts.append(df.agg(F.array(*cells).alias("r")).select(F.inline("r")))
    return _union(parts)
