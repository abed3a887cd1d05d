"""Models: edge rows, invariants, expected figures, and the comparison with the independent engine."""

import re
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from retentia import Params
from retentia.plans import core, quality, revenue, serving, signals
from retentia.operators.access import Scope
from retentia.sources.store import Steps
from verification.bindings import BINDINGS
from verification.compare import compare, connect
from verification.models import PARAMS, Models, stored_health, with_stored_lines
from verification.registry import load_all

SMALL = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def models(spark):
    return Models(spark, SMALL)


def test_reports_of_another_window(spark):
    two = Models(spark, SMALL, Params(id_width=9, months=(date(2024, 2, 1), date(2024, 3, 1))))
    table = serving.health_score_table(two.health, p=two.p)
    assert {"total_events_2m", "feb_mar_pct_change"} <= set(table.columns)
    detail = serving.usage_customer_detail(two.usage_stats, two.health, p=two.p)
    totals = [r.total_events_2m for r in serving.in_report_order("usage_customer_detail", detail, two.p).collect()]
    assert totals and totals == sorted(totals)
    assert table.count() == serving.filter_health(table).count() >= serving.mrr_at_risk_by_region(table).count()


def subscriptions(spark, rows):
    schema = "subscription_id string, customer_id string, plan_id string, start_date date, end_date date, mrr decimal(10,2), billing_cycle string, auto_renew boolean, status string"
    return spark.createDataFrame(rows, schema)


def test_end_dates(spark):
    def one(i, start, cycle, status, end=None):
        return (f"S{i}", "C", "P", start, end, None, cycle, True, status)

    rows = [
        one(1, date(2023, 12, 31), "monthly", "cancelled"), one(2, date(2024, 2, 29), "annual", "expired"),
        one(3, date(2022, 11, 24), "annual", "active"), one(4, date(2023, 11, 30), "quarterly", "suspended"),
        one(5, date(2024, 1, 31), "monthly", "active"), one(6, date(2024, 1, 1), "weekly", "active"),
        one(7, date(2024, 1, 1), "monthly", "odd"), one(8, date(2024, 1, 1), "monthly", "active", date(2023, 1, 1)),
    ]
    stg = subscriptions(spark, rows)

    def resolve(p):
        return {r.subscription_id: (r.end_date_resolved, r.end_date_method) for r in core.resolved_subscriptions(stg, p).collect()}

    got = resolve(Params())
    assert got == {
        "S1": (date(2024, 1, 31), "cycle_estimate"), "S2": (date(2025, 2, 28), "cycle_estimate"),
        "S3": (date(2025, 11, 24), "next_renewal"), "S4": (date(2024, 5, 30), "next_renewal"),
        "S5": (date(2024, 4, 30), "next_renewal"), "S6": (None, "next_renewal"),
        "S7": (None, "unknown"), "S8": (date(2023, 1, 1), "source"),
    }
    elapsed = resolve(Params(renewal="elapsed"))
    assert elapsed["S3"][0] == date(2024, 11, 24) and elapsed["S4"][0] == date(2024, 5, 30) and elapsed["S5"][0] == date(2024, 4, 30)


def test_fixture_figures(spark):
    """The expected waterfall of the fixtures, from the fixtures' own bindings."""
    text = (ROOT / "FIXTURES.md").read_text()
    sql = text.split("```sql")[1].split("```")[0]
    bindings = {n: b.rstrip().rstrip(";") for n, b in re.findall(r"-- (\w+)\n(.*?)(?=\n\n-- |\Z)", sql, re.S)}
    assert set(bindings) <= set(BINDINGS)
    rows = Models(spark, SMALL, PARAMS, bindings).mart_nrr.filter("region = 'ALL'").orderBy("mrr_month").collect()
    figures = "starting_mrr new_mrr expansion_mrr contraction_mrr churn_mrr ending_mrr nrr_pct active_customers new_customers churned_customers".split()
    expected = [line.split("|")[3:-1] for line in text.splitlines() if line.startswith("| 0.001 | 2024-")]
    for row, cells in zip(rows, expected, strict=True):
        want = [None if c.strip() == "–" else float(c.replace(",", "")) for c in cells]
        assert [None if row[f] is None else float(row[f]) for f in figures] == want


def test_single_aggregation_equals_separate_parts(models):
    """The one-pass customer-month table against the separate base, new, churn and amendment parts."""
    p, key = models.p, ["customer_id", "mrr_month"]
    skeleton = models.customer_months.select(*key)
    joined = skeleton
    for part in (
        revenue.base_mrr(models.subscriptions, p), revenue.new_mrr(models.subscriptions, p),
        revenue.churn_mrr(models.subscriptions, p), revenue.amendment_movements(models.amendments, p),
    ):
        joined = joined.join(part, key, "left")
    columns = [c for c in models.customer_months.columns if c not in key]
    plain = lambda df: df.select(*key, *[F.coalesce(F.col(c), F.lit(0)).cast("decimal(22,2)").alias(c) for c in columns])
    assert plain(joined).exceptAll(plain(models.customer_months)).count() == 0
    assert skeleton.count() == models.dim_customers.count() * len(p.months)


def test_scores_and_keys(models):
    h = models.health.agg(
        F.min("health_score").alias("low"), F.max("health_score").alias("high"), F.count("*").alias("n"), F.count_distinct("customer_id").alias("k")
    ).first()
    assert 0 <= h.low <= h.high <= 100 and h.n == h.k == models.dim_customers.count()
    for df, key in ((models.latest_invoices, ["invoice_id"]), (models.fct_usage_events, ["customer_id", "event_date", "metric_name"])):
        assert df.count() == df.select(*key).distinct().count()


def test_totals_are_sums(models):
    sums = models.mart_nrr.groupBy("mrr_month").agg(
        *[F.sum(F.when(F.col("region") == "ALL", F.col(c)).otherwise(-F.col(c))).alias(c) for c in ("starting_mrr", "ending_mrr", "churn_mrr")]
    )
    assert all(float(v) == 0 for r in sums.collect() for v in tuple(r)[1:])


def test_usage_trend_edges(spark):
    usage = spark.createDataFrame(
        [("a", date(2024, 1, 5), "api_calls", 5.0), ("a", date(2024, 2, 5), "api_calls", 5.0), ("b", date(2024, 1, 1), None, 1.0),
         ("b", date(2023, 12, 31), "x", 1.0), ("c", date(2024, 3, 31), "active_users", None)],
        "customer_id string, event_date date, metric_name string, quantity double",
    )
    df = usage.withColumn("quantity", F.col("quantity").cast("decimal(14,4)"))
    out = {r.customer_id: r for r in signals.usage_trends(signals.pivot_months(signals.monthly_usage(df))).collect()}
    assert (out["a"].is_silent_churn, out["a"].feb_mar_pct_change, out["a"].sharp_drop_last_month, out["a"].max_feature_breadth) == (True, -100.0, True, 1)
    assert (out["b"].jan_events, out["b"].zero_usage_months, out["b"].max_feature_breadth) == (1, 2, 0)
    assert (out["c"].mar_events, out["c"].jan_feb_pct_change, out["c"].usage_slope) == (1, None, 1)


def test_recovery_cases(spark):
    rows = [("t1", 10, 7, True), ("t2", 10, 6, True), ("t3", 0, 5, True), ("t4", 0, 0, True), ("t5", 10, 0, False)]
    df = spark.createDataFrame(rows, "ticket_id string, pre_ticket_quantity int, post_ticket_quantity int, solved boolean")
    df = df.withColumn("resolved_date", F.when(F.col("solved"), F.current_date()))
    got = {r.ticket_id: (r.engagement_recovery_ratio, r.engagement_recovered) for r in signals.ticket_recovery(df).collect()}
    assert got == {"t1": (0.7, True), "t2": (0.6, False), "t3": (2.0, None), "t4": (0.0, None), "t5": (None, None)}


def test_risk_signals(spark):
    rows = [(1, True, True, False, 10), (2, True, False, False, 5), (3, False, False, None, 9), (4, False, False, True, 9)]
    df = spark.createDataFrame(rows, "id int, is_silent_churn boolean, is_consistently_declining boolean, sharp_drop_last_month boolean, current_mrr int")
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(serving.risk_signal_filter(df)) == [1, 2, 4]
    # leaving a signal out removes its rows even where another signal is set
    assert ids(serving.risk_signal_filter(df, ["is_silent_churn"])) == [2]
    assert ids(serving.risk_signal_filter(df, min_mrr=9)) == [1, 4]


def test_expectations_raise(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None)], "id string, kind string")
    checks = [quality.Expectation("t", "id", "unique"), quality.Expectation("t", "kind", "not_null", "warn"), quality.Expectation("t", "kind", "accepted_values", "warn", ("y",))]
    report = quality.run_expectations({"t": df}, checks)
    assert sorted((r.check_name, r.failures) for r in report.collect()) == [("accepted_values", 1), ("not_null", 1), ("unique", 1)]
    with pytest.raises(ValueError, match="t.id unique: 1"):
        quality.require(report)
    quality.require(report.filter("severity = 'warn'"))
    assert len(quality.EXPECTATIONS) == 43


def test_unused_columns_are_not_read(models):
    """A narrow signal over deduplicated invoices must not read the wide row."""
    plan = signals.invoice_rollup(models.latest_invoices).select("customer_id", "total_invoices")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_tax" not in plan.split("Relation")[0]


def test_usage_is_read_once(models):
    """Statistics and health both need the latest usage; neither plan picks it from the raw events again."""
    stats, scored = stored_health(models)
    for stored, plain in ((stats, models.usage_stats), (scored, models.health)):
        plan, other = (df._jdf.queryExecution().optimizedPlan().toString() for df in (stored, plain))
        assert "API_requests" in other and "API_requests" not in plan
        assert sorted(map(repr, stored.collect())) == sorted(map(repr, plain.collect()))


def test_score_is_made_of_stored_parts(spark):
    """Invoices, payments and tickets are rolled up one after the other, so only one's shuffle files lie on disk."""
    m = Models(spark, SMALL)
    scored = stored_health(m)[1]
    read = set(re.findall(r"(\w+)\.parquet", " ".join(scored.inputFiles())))
    plan = scored._jdf.queryExecution().toString()
    assert not [t for t in ("lineitem", "orders", "events") if f"{SMALL}/{t}.parquet" in plan] and not {"lineitem", "orders", "events"} & read


def test_scope_reaches_the_scan(models, spark, tmp_path):
    path = str(tmp_path / "customers")
    models.dim_customers.write.parquet(path)
    from retentia.operators.access import row_scope

    plan = row_scope(spark.read.parquet(path), Scope("regional_manager", "ASIA"))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(region,ASIA)" in plan


CHECKED = [
    "stg_customers", "stg_payments", "stg_adjustments", "dim_customers", "dim_subscriptions", "fct_invoices", "fct_payments",
    "fct_usage_events", "fct_support_tickets", "fct_adjustments", "fct_contract_amendments", "ticket_engagement", "customer_health_score",
    "mart_mrr", "mart_nrr", "mart_support_summary", "merge_dimension", "scd2_snapshot", "apply_corrections", "profile_orphans",
    "month_over_month_deltas", "engagement_quadrant", "elapsed_renewal", "waterfall_rows", "read_fact_batch",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_same_rows_as_sql(spark, duck, name):
    load_all()
    assert compare(name, spark, duck, SMALL) == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 18
    names, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(names) and len(names) > 150
    assert not [n for n in oracles if re.search(r"\bLIMIT\b", oracles[n], re.I)]


def test_amounts_are_added_up_as_whole_cents(spark):
    """A map task holds a row of sums per customer and month, so these must be small; nothing is rounded by it."""
    from datetime import date
    from decimal import Decimal

    from retentia.plans import core, revenue

    schema = "subscription_id string, customer_id string, plan_id string, status string, billing_cycle string, auto_renew boolean, start_date date, end_date date, mrr decimal(12,2)"
    amounts = ["9999999999.99", "-0.01", "0.07", None]
    rows = [(f"S{i}", "C1", "P", "active", "monthly", True, date(2024, 1, 5), date(2025, 1, 1), None if x is None else Decimal(x)) for i, x in enumerate(amounts)]
    amendments = spark.createDataFrame([("C1", date(2024, 2, 1), Decimal("-0.03")), ("C2", date(2024, 2, 1), Decimal("5"))], "customer_id string, effective_date date, mrr_delta decimal(13,2)")
    customers = spark.createDataFrame([("C1",)], "customer_id string")
    months = revenue.customer_months(customers, core.resolved_subscriptions(spark.createDataFrame(rows, schema)), amendments)
    found = {r.mrr_month.month: (r.mrr, r.new_mrr_amount, r.contraction_mrr, r.active_sub_count) for r in months.collect()}
    total, none = Decimal("10000000000.05"), Decimal("0.00")
    assert found == {1: (total, total, none, 4), 2: (total, none, Decimal("0.03"), 4), 3: (total, none, none, 4)}
    assert dict(months.dtypes)["mrr"] == "decimal(32,2)"

    plan, added = months._jdf.queryExecution().optimizedPlan(), []
    while plan.nodeName() != "Aggregate":
        plan = plan.children().apply(0)
    rows_in = plan.child().output()
    added = [rows_in.apply(i).dataType().simpleString() for i in range(rows_in.size())]
    assert not [t for t in added if t.startswith("decimal")]


def test_stored_lines_give_the_same_raw_rows(spark, tmp_path):
    """Repeated lines and orders, and lines without an order or key, as from the tables themselves."""
    day = datetime(2001, 2, 3)
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    order = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"

    def of(key, part=7, price=10.0):
        return (key, part, 3, 1, 1.0, price, 0.0, 0.05, "A", "O", day)

    spark.createDataFrame([of(1), of(1), of(1, 40), of(2, price=None), of(3, None), of(None), of(9)], line).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(1, 5, "O", 9.0, day, "2-HIGH"), (2, 6, "P", 9.0, day, None), (2, 7, "P", 8.0, day, None), (3, None, "F", None, None, None), (None, 8, "O", 1.0, day, "")]
    spark.createDataFrame(orders, order).write.parquet(f"{tmp_path}/orders.parquet")
    plain = Models(spark, str(tmp_path))
    stored = with_stored_lines(plain)
    for name in ("raw_invoices", "raw_payments", "raw_adjustments"):
        rows = [sorted(map(repr, m.raw(name).collect())) for m in (plain, stored)]
        assert rows[0] == rows[1] and len(rows[0]) == 6
        assert stored.raw(name).schema == plain.raw(name).schema


def test_flags_read_lines_once(spark):
    plan = load_all()["dq_flags"].build(Models(spark, SMALL))._jdf.queryExecution().toString()
    assert f"{SMALL}/orders.parquet" in plan and f"{SMALL}/lineitem.parquet" not in plan


CONTEXT = "invoice_id string, subscription_id string, plan_id string, plan_name string, plan_tier string, billing_cycle string, invoice_status string"
CUSTOMER = "customer_id string, company_name string, region string, account_tier string, status string"


def fact_sides(spark):
    """Invoices and customers, each with a key that comes twice and one that is missing."""
    invoices = [("I1", "S1", "P1", "p", "t", "monthly", "paid"), ("I1", "S2", "P1", "p", "t", "annual", None), (None, "S3", "P2", None, None, None, "void")]
    customers = [("C1", "One", "EMEA", "smb", "active"), ("C2", "Two", None, None, None), ("C2", "Too", "NA", "smb", "trial"), (None, "None", "NA", "smb", "trial")]
    return spark.createDataFrame(customers, CUSTOMER), spark.createDataFrame(invoices, CONTEXT)


def same_in_steps(made, tmp_path, spark, stored):
    """``made`` with and without stored steps gives the same rows; the last step is read by one join alone."""
    keep = Steps(spark, str(tmp_path / "steps"))
    plain, stepped = made(), made(keep)
    rows = sorted(map(repr, plain.collect()))
    assert rows == sorted(map(repr, stepped.collect())) and stepped.dtypes == plain.dtypes
    plan = stepped._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and "Window" not in plan and keep.made == stored
    assert len(list((tmp_path / "steps").iterdir())) == stored
    keep.clear()
    assert not (tmp_path / "steps").exists()
    return rows


def test_payments_in_steps(spark, tmp_path):
    columns = "payment_id string, invoice_id string, customer_id string, amount decimal(12,2), payment_method string, payment_date date, status string, transaction_ref string, processor_fee decimal(10,4), net_amount decimal(12,2), batch_id int, _row_seq long"
    day = date(2024, 1, 2)

    def one(i, invoice, customer, batch=1, status="completed"):
        return (i, invoice, customer, None, "card", day, status, None, None, None, batch, 1)

    rows = [one("A", "I1", "C2"), one("A", "I1", "C1", 2, "failed"), one("A", "I1", "C1", 2, "failed"), one("B", None, None), one("C", "I9", "C2"), one(None, "I1", "C9", None)]
    payments = spark.createDataFrame(rows, columns)
    customers, invoices = fact_sides(spark)
    got = same_in_steps(lambda *keep: core.fct_payments(payments, customers, invoices, *keep), tmp_path, spark, 2)
    assert len(got) == 7  # A and the one without an id meet two invoices, C two customers


def test_adjustments_in_steps(spark, tmp_path):
    columns = "adjustment_id string, customer_id string, invoice_id string, adjustment_type string, amount decimal(12,2), reason string, effective_date date, created_date date, approved_by string, status string, reverses_adjustment_id string, batch_id int"

    def one(i, customer, invoice, kind="credit"):
        return (i, customer, invoice, kind, None, None, None, None, None, "approved", None, 2)

    adjustments = spark.createDataFrame([one("A", "C1", "I1"), one("A", "C1", "I1"), one("B", None, None, None), one(None, "C2", "I9")], columns)
    customers, invoices = fact_sides(spark)
    got = same_in_steps(lambda *keep: core.fct_adjustments(adjustments, customers, invoices, *keep), tmp_path, spark, 1)
    assert len(got) == 7


def test_invoices_in_steps(spark, tmp_path):
    columns = "invoice_id string, customer_id string, subscription_id string, invoice_date date, due_date date, amount decimal(12,2), currency string, status string, line_items_count int, tax_amount decimal(12,2), total_amount decimal(12,2), period_start date, period_end date, created_at date, batch_id int, _row_seq long"

    def one(i, customer, subscription, batch=1):
        return (i, customer, subscription, None, None, None, "USD", "paid", 1, None, None, None, None, None, batch, 1)

    invoices = spark.createDataFrame([one("A", "C2", "S1"), one("A", "C2", "S1", 2), one("B", None, None), one(None, "C1", "S9")], columns)
    subs = spark.createDataFrame([("S1", "P1", "monthly"), ("S1", "P2", "annual"), (None, "P1", "annual")], "subscription_id string, plan_id string, billing_cycle string")
    plans = spark.createDataFrame([("P1", "p", "t"), (None, "n", "n")], "plan_id string, plan_name string, plan_tier string")
    customers = fact_sides(spark)[0]
    got = same_in_steps(lambda *keep: core.fct_invoices(invoices, customers, subs, plans, *keep), tmp_path, spark, 1)
    assert len(got) == 6


@pytest.mark.parametrize("name", ["fct_payments", "fct_adjustments"])
def test_wide_facts_are_built_in_steps(spark, name):
    """What the query returns is left with the last join: lines, versions and invoices have been stored."""
    plan = load_all()[name].build(Models(spark, SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "Window" not in plan and "invoice_status" in plan


def test_steps_before_the_last_join_are_removed(spark, tmp_path):
    keep = Steps(spark, str(tmp_path / "steps"))
    first, second = keep(spark.range(3)), keep(spark.range(4))
    keep.clear(but=1)
    assert [p.name for p in (tmp_path / "steps").iterdir()] == ["2"] and second.count() == 4
    assert keep(spark.range(5)).count() == 5 and first.schema == second.schema
    keep.clear()
    assert not (tmp_path / "steps").exists()
