"""Joins, aggregations, windows, filters, sorts and set operations on their own."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from retentia.functions.calendar import month_start
from retentia.operators import access, intervals, totals, versions
from retentia.plans import core, health, quality, referrals, revenue, serving, signals, staging
from verification.oracle import FROM, UNTIL, month, oracle, rounded
from verification.registry import query

MANAGER = access.Scope("regional_manager", "ASIA")

# --- joins ------------------------------------------------------------------------------------


@query(
    "enrich_left_equi",
    oracle("""SELECT i.invoice_id, i.customer_id, c.company_name, c.region, i.amount
              FROM latest_invoices i LEFT JOIN dim_customers c USING (customer_id)""", DOUBLE="amount"),
)
def _(m):
    df = core.enrich(m.latest_invoices, m.dim_customers, "customer_id", {"company_name": "company_name", "region": "region"})
    return df.select("invoice_id", "customer_id", "company_name", "region", "amount")


_TICKET_NUMBERS = "resolution_hours satisfaction_score"


@query("inner_self_join", oracle("SELECT * EXCLUDE (first_export, age) FROM latest_tickets", DOUBLE=_TICKET_NUMBERS))
def _(m):
    return m.latest_tickets


@query(
    "valid_at_join",
    oracle("SELECT customer_id, event_date, metric_name, quantity, subscription_id, plan_id, billing_cycle FROM usage_subscription", DOUBLE="quantity"),
)
def _(m):
    return core.usage_with_subscription(m.latest_usage, m.subscriptions, m.stg_usage_events).select(
        "customer_id", "event_date", "metric_name", "quantity", "subscription_id", "plan_id", "billing_cycle"
    )


@query(
    "window_pair_join",
    oracle("""SELECT ticket_id, pre_ticket_quantity, post_ticket_quantity, pre_ticket_usage_days, post_ticket_usage_days
              FROM ticket_engagement""", DOUBLE="pre_ticket_quantity post_ticket_quantity"),
)
def _(m):
    return m.ticket_engagement.select(
        "ticket_id", "pre_ticket_quantity", "post_ticket_quantity", "pre_ticket_usage_days", "post_ticket_usage_days"
    )


@query("month_spine_cross", oracle("SELECT subscription_id, customer_id, mrr_month, mrr FROM month_spine", DOUBLE="mrr"))
def _(m):
    spine = intervals.month_spine(m.subscriptions, "start_date", "end_date_resolved", m.p.months)
    return spine.select("subscription_id", "customer_id", "mrr_month", "mrr")


@query("customer_month_skeleton", oracle("SELECT customer_id, mrr_month FROM dim_customers, months"))
def _(m):
    return intervals.month_skeleton(m.dim_customers, "customer_id", m.p.months)


_MONTH_AMOUNTS = "mrr new_mrr_amount churn_mrr_amount expansion_mrr contraction_mrr"
_MONTH_COUNTS = "active_sub_count expansion_count contraction_count"


@query("assemble_left_composite", oracle("SELECT * FROM customer_months", DOUBLE=_MONTH_AMOUNTS, BIGINT=_MONTH_COUNTS))
def _(m):
    return m.customer_months


@query(
    "left_signal_join",
    oracle("""SELECT c.customer_id, c.region, coalesce(s.current_mrr, 0) AS current_mrr, s.active_sub_count, s.has_recent_upgrade
              FROM dim_customers c LEFT JOIN subscription_rollup s USING (customer_id)""", DOUBLE="current_mrr"),
)
def _(m):
    rollup = signals.subscription_rollup(m.dim_subscriptions)
    shown = {c: c for c in ("current_mrr", "active_sub_count", "has_recent_upgrade")}
    df = core.enrich(m.dim_customers.select("customer_id", "region"), rollup, "customer_id", shown)
    return df.withColumn("current_mrr", F.coalesce("current_mrr", F.lit(0)))


@query(
    "serving_left_join",
    oracle("""SELECT u.customer_id, c.company_name, c.region, u.total_tickets, u.avg_satisfaction_score
              FROM support_rollup u LEFT JOIN dim_customers c USING (customer_id)"""),
)
def _(m):
    rollup = signals.support_rollup(m.ticket_states)
    df = core.enrich(rollup, m.dim_customers, "customer_id", {"company_name": "company_name", "region": "region"})
    return df.select("customer_id", "company_name", "region", "total_tickets", "avg_satisfaction_score")


@query(
    "orphan_anti_join",
    oracle("SELECT DISTINCT customer_id FROM stg_subscriptions WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM stg_usage_events)"),
)
def _(m):
    return quality.orphan_keys(m.stg_subscriptions, m.stg_usage_events, "customer_id")


@query("semi_join_filter", oracle("SELECT invoice_id, customer_id, status FROM stg_invoices WHERE invoice_id IN (SELECT entity_id FROM raw_corrections)"))
def _(m):
    patched = m.raw("raw_corrections").select(F.col("entity_id").alias("invoice_id"))
    return m.stg_invoices.join(patched, "invoice_id", "left_semi").select("invoice_id", "customer_id", "status")


@query("match_referrals", oracle("SELECT * FROM referral_matches"))
def _(m):
    return m.referrals


@query("unmatched_referrals", oracle("SELECT referral_id, email, company_name FROM referral_matches WHERE matched_by IS NULL"))
def _(m):
    return referrals.unmatched_referrals(m.referrals)


# --- aggregations -----------------------------------------------------------------------------


@query("count_sum_by_key", oracle("SELECT * FROM invoice_rollup", DOUBLE="total_billed total_paid total_overdue"))
def _(m):
    return signals.invoice_rollup(m.latest_invoices)


@query("conditional_agg", oracle("SELECT * FROM payment_rollup", DOUBLE="total_collected total_refunded"))
def _(m):
    return signals.payment_rollup(m.latest_payments)


@query("count_distinct", oracle("SELECT metric_name, count(DISTINCT customer_id) AS customers, count(DISTINCT event_date) AS days FROM stg_usage_events GROUP BY metric_name"))
def _(m):
    return m.stg_usage_events.groupBy("metric_name").agg(
        F.count_distinct("customer_id").alias("customers"), F.count_distinct("event_date").alias("days")
    )


@query(
    "conditional_count_distinct",
    oracle(f"""SELECT {month("effective_date")} AS month, count(DISTINCT customer_id) FILTER (WHERE mrr_delta > 0) AS growing,
               count(DISTINCT customer_id) FILTER (WHERE mrr_delta < 0) AS shrinking FROM amendments GROUP BY ALL"""),
)
def _(m):
    who, delta = F.col("customer_id"), F.col("mrr_delta")
    return m.amendments.groupBy(month_start(F.col("effective_date")).alias("month")).agg(
        F.count_distinct(F.when(delta > 0, who)).alias("growing"), F.count_distinct(F.when(delta < 0, who)).alias("shrinking")
    )


_PIVOTED = " ".join(f"{m}_{c}" for m in ("jan", "feb", "mar") for c in ("quantity", "api", "users"))


@query("pivot_months", oracle("SELECT * FROM pivoted_usage", DOUBLE=_PIVOTED))
def _(m):
    return signals.pivot_months(signals.monthly_usage(m.latest_usage), m.p)


@query(
    "rollup_all_region",
    oracle(f"""SELECT {month("effective_date")} AS month, CASE WHEN grouping(region) = 1 THEN 'ALL' ELSE region END AS region,
               count(*) AS deals, sum(mrr_delta) AS net_delta FROM fct_contract_amendments
               GROUP BY GROUPING SETS (({month("effective_date")}, region), ({month("effective_date")}))""", DOUBLE="net_delta"),
)
def _(m):
    detail = m.fct_contract_amendments.groupBy(month_start(F.col("effective_date")).alias("month"), "region").agg(
        F.count(F.lit(1)).alias("deals"), F.sum("mrr_delta").alias("net_delta")
    )
    return totals.with_total(detail, ["month"], "region", {"deals": F.sum("deals"), "net_delta": F.sum("net_delta")})


@query("ratio_of_sums", oracle("SELECT customer_id, collection_rate_pct FROM payment_rollup"))
def _(m):
    return signals.payment_rollup(m.latest_payments).select("customer_id", "collection_rate_pct")


@query("month_bucket_agg", oracle("SELECT * FROM new_mrr", DOUBLE="new_mrr_amount"))
def _(m):
    return revenue.new_mrr(m.subscriptions, m.p)


BREADTH = f"""SELECT month, feature_breadth, count(*) AS customers FROM (
    SELECT customer_id, {month("event_date")} AS month, count(DISTINCT metric_name) AS feature_breadth
    FROM latest_usage WHERE event_date BETWEEN {FROM} AND {UNTIL} GROUP BY ALL) AS per_customer GROUP BY ALL"""


@query("two_level_histogram", oracle(BREADTH))
def _(m):
    return serving.feature_breadth_by_month(m.latest_usage, p=m.p)


@query("positive_negative_split", oracle("SELECT * FROM amendment_movements", DOUBLE="expansion_mrr contraction_mrr"))
def _(m):
    return revenue.amendment_movements(m.amendments, m.p)


@query(
    "median_split",
    oracle("""SELECT count(quantity) AS observations, quantile_cont(CAST(quantity AS DOUBLE), 0.5) AS median_quantity,
              (SELECT quantile_cont(CAST(mrr AS DOUBLE), 0.5) FROM stg_subscriptions) AS median_mrr FROM latest_usage"""),
)
def _(m):
    mrr, usage = m.stg_subscriptions, m.latest_usage
    mid_mrr, mid_quantity = totals.exact_medians(mrr, ["mrr"])["mrr"], totals.exact_medians(usage, ["quantity"])["quantity"]
    return usage.agg(F.count("quantity").alias("observations"), F.lit(mid_mrr).alias("median_mrr"), F.lit(mid_quantity).alias("median_quantity"))


@query(
    "equi_width_histogram",
    oracle("SELECT CAST(5 * floor(least(health_score, 99) / 5) AS INTEGER) AS bin_start, count(*) AS customers FROM health GROUP BY ALL"),
)
def _(m):
    return health.score_histogram(m.health)


@query("value_counts", oracle("SELECT region AS value, count(*) AS rows FROM stg_customers GROUP BY region"))
def _(m):
    return quality.value_counts(m.stg_customers, "region")


def null_rate_sql(table: str, *columns: str) -> str:
    """NULL share of each listed column, as rows."""
    parts = [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, {rounded(f'100.0::DOUBLE * (count(*) - count({c})) / count(*)', 1)} AS null_pct FROM {table}"
        for c in columns
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) AS rates WHERE null_pct > 0"


_CUSTOMER_COLUMNS = (
    "customer_id company_name industry region country city signup_date account_owner status email phone "
    "employee_count annual_revenue_usd notes account_tier"
).split()


@query("null_rate", oracle(null_rate_sql("stg_customers", *_CUSTOMER_COLUMNS)))
def _(m):
    return quality.null_rates("stg_customers", m.stg_customers)


@query("min_max_dates", oracle("SELECT batch_id, min(invoice_date) AS first_date, max(invoice_date) AS last_date FROM stg_invoices GROUP BY batch_id"))
def _(m):
    return quality.profile_date_range(m.stg_invoices, "invoice_date")


# --- windows ----------------------------------------------------------------------------------


@query("latest_per_key", oracle("SELECT * FROM latest_payments", DOUBLE="amount processor_fee net_amount"))
def _(m):
    return m.latest_payments


@query(
    "earliest_per_key",
    oracle("""SELECT ticket_id, created_date, batch_id AS first_batch FROM stg_support_tickets
              QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY batch_id) = 1"""),
)
def _(m):
    first = versions.first_and_latest(
        m.stg_support_tickets.select("ticket_id", "created_date", "batch_id", F.col("batch_id").alias("first_batch")),
        "ticket_id", "batch_id", ["created_date", "first_batch"],
    )
    return first.select("ticket_id", "created_date", "first_batch")


@query("pick_one_match", oracle("SELECT DISTINCT customer_id, event_date, subscription_id FROM usage_subscription"))
def _(m):
    picked = core.usage_with_subscription(m.latest_usage, m.subscriptions, m.stg_usage_events)
    return picked.select("customer_id", "event_date", "subscription_id").distinct()


@query(
    "lag_by_customer",
    oracle("SELECT subscription_id, prev_mrr, prev_plan_id, prev_billing_cycle, prev_status FROM dim_subscriptions", DOUBLE="prev_mrr"),
)
def _(m):
    values = ["mrr", "plan_id", "billing_cycle", "status"]
    df = versions.previous_row(m.subscriptions, "customer_id", "start_date", ["start_date", "subscription_id"], values)
    return df.select("subscription_id", *[f"prev_{v}" for v in values])


@query(
    "lag_by_month",
    oracle("""SELECT customer_id, mrr_month, mrr, lag(mrr) OVER (PARTITION BY customer_id ORDER BY mrr_month) AS prev_mrr
              FROM customer_months""", DOUBLE="mrr prev_mrr"),
)
def _(m):
    in_order = Window.partitionBy("customer_id").orderBy(F.col("mrr_month").asc_nulls_last())
    return m.customer_months.select("customer_id", "mrr_month", "mrr", F.lag("mrr").over(in_order).alias("prev_mrr"))


@query(
    "prior_row_delta",
    oracle("""SELECT region, mrr_month, ending_mrr - lag(ending_mrr) OVER w AS ending_mrr_delta,
              churned_customers - lag(churned_customers) OVER w AS churned_customers_delta
              FROM mart_nrr WINDOW w AS (PARTITION BY region ORDER BY mrr_month)""", DOUBLE="ending_mrr_delta"),
)
def _(m):
    by_month = Window.partitionBy("region").orderBy(F.col("mrr_month").asc_nulls_last())
    return m.mart_nrr.select(
        "region", "mrr_month",
        (F.col("ending_mrr") - F.lag("ending_mrr").over(by_month)).alias("ending_mrr_delta"),
        (F.col("churned_customers") - F.lag("churned_customers").over(by_month)).alias("churned_customers_delta"),
    )


# --- filters, order, top ----------------------------------------------------------------------


@query("row_scope", oracle("SELECT customer_id, company_name, region FROM dim_customers WHERE region = 'ASIA'"))
def _(m):
    return access.row_scope(m.dim_customers, MANAGER).select("customer_id", "company_name", "region")


@query("summary_scope", oracle("SELECT mrr_month, region, ending_mrr, nrr_pct FROM mart_nrr WHERE region = 'ASIA'", DOUBLE="ending_mrr"))
def _(m):
    return access.summary_scope(m.mart_nrr, MANAGER).select("mrr_month", "region", "ending_mrr", "nrr_pct")


@query(
    "date_between",
    oracle(f"SELECT invoice_id, invoice_date, amount FROM latest_invoices WHERE invoice_date >= {FROM} AND invoice_date <= {UNTIL}", DOUBLE="amount"),
)
def _(m):
    inside = access.date_between(m.latest_invoices, "invoice_date", m.p.window_start, m.p.window_end)
    return inside.select("invoice_id", "invoice_date", "amount")


@query(
    "activity_filter",
    oracle("SELECT customer_id, mrr_month, mrr, prev_mrr, new_mrr_amount, churn_mrr_amount FROM movements", DOUBLE="mrr prev_mrr new_mrr_amount churn_mrr_amount"),
)
def _(m):
    return m.movements.select("customer_id", "mrr_month", "mrr", "prev_mrr", "new_mrr_amount", "churn_mrr_amount")


@query(
    "multi_value_filter",
    oracle("SELECT customer_id, region, account_tier, status FROM dim_customers WHERE region IN ('ASIA', 'EUROPE') AND account_tier IN ('smb', 'enterprise')"),
)
def _(m):
    chosen = access.one_of(m.dim_customers, "region", ["ASIA", "EUROPE"])
    chosen = access.one_of(access.one_of(chosen, "account_tier", ["smb", "enterprise"]), "status", [])
    return chosen.select("customer_id", "region", "account_tier", "status")


DETAIL = """SELECT u.*, coalesce(h.current_mrr, 0) AS current_mrr, coalesce(h.health_score, 0) AS health_score,
    coalesce(h.risk_tier, 'unknown') AS risk_tier, coalesce(h.mrr_at_risk, 0) AS mrr_at_risk
    FROM (SELECT * REPLACE (coalesce(sharp_drop_last_month, false) AS sharp_drop_last_month) FROM usage_stats) u
    LEFT JOIN health h USING (customer_id)"""


@query(
    "risk_signal_filter",
    oracle(f"""SELECT customer_id, is_silent_churn, is_consistently_declining, sharp_drop_last_month, current_mrr FROM ({DETAIL})
               WHERE (is_silent_churn OR is_consistently_declining) AND NOT sharp_drop_last_month AND current_mrr >= 1000""", DOUBLE="current_mrr"),
)
def _(m):
    detail = serving.usage_customer_detail(m.usage_stats, m.health, p=m.p)
    kept = serving.risk_signal_filter(detail, ["is_silent_churn", "is_consistently_declining"], 1000)
    return kept.select("customer_id", *serving.RISK_SIGNALS, "current_mrr")


@query(
    "no_recovery_filter",
    oracle("""SELECT s.customer_id, s.avg_engagement_recovery, s.tickets_not_recovered, s.open_tickets FROM support_signals s
              WHERE s.poor_post_ticket_recovery OR s.unresolved_with_no_recovery""", DOUBLE="avg_engagement_recovery"),
)
def _(m):
    flagged = m.support_signals.filter("poor_post_ticket_recovery OR unresolved_with_no_recovery")
    return flagged.select("customer_id", "avg_engagement_recovery", "tickets_not_recovered", "open_tickets")


@query(
    "order_rows",
    oracle("""SELECT ticket_id, is_high_priority, created_date, satisfaction_score FROM fct_support_tickets
              ORDER BY is_high_priority DESC NULLS LAST, created_date NULLS LAST, satisfaction_score NULLS LAST, ticket_id""", DOUBLE="satisfaction_score"),
)
def _(m):
    order = access.ordered("-is_high_priority", "created_date", "satisfaction_score", "ticket_id")
    return m.fct_support_tickets.select("ticket_id", "is_high_priority", "created_date", "satisfaction_score").orderBy(*order)


BREAKDOWN = f"""SELECT {month("effective_date")} AS month, amendment_type, count(*) AS deals,
    round(sum(greatest(mrr_delta, 0)), 0) AS mrr_gained, round(sum(greatest(-mrr_delta, 0)), 0) AS mrr_lost, round(sum(mrr_delta), 0) AS net_delta
    FROM fct_contract_amendments WHERE effective_date BETWEEN {FROM} AND {UNTIL} GROUP BY ALL"""
LEADERS = f"""SELECT g.month, g.amendment_type AS top_expansion, l.amendment_type AS top_contraction, g.gained, l.lost FROM
    (SELECT *, sum(mrr_gained) OVER (PARTITION BY month) AS gained FROM ({BREAKDOWN}) AS b
       QUALIFY row_number() OVER (PARTITION BY month ORDER BY mrr_gained DESC, amendment_type) = 1) g
    JOIN (SELECT *, sum(mrr_lost) OVER (PARTITION BY month) AS lost FROM ({BREAKDOWN}) AS b
       QUALIFY row_number() OVER (PARTITION BY month ORDER BY mrr_lost DESC, amendment_type) = 1) l USING (month)"""


@query("top1_by_measure", oracle(LEADERS, DOUBLE="gained lost"))
def _(m):
    return serving.leading_types(serving.amendment_breakdown(m.fct_contract_amendments, p=m.p))


@query(
    "latest_month_row",
    oracle("""SELECT mrr_month, region, starting_mrr, ending_mrr, row_number() OVER (ORDER BY mrr_month DESC) AS recency
              FROM mart_nrr WHERE region = 'ALL' AND starting_mrr > 0 QUALIFY recency <= 2""", DOUBLE="starting_mrr ending_mrr", INTEGER="recency"),
)
def _(m):
    last = serving.latest_month_row(serving.nrr_waterfall(m.mart_nrr), rows=2)
    return last.select("mrr_month", "region", "starting_mrr", "ending_mrr", "recency")


# --- set operations ---------------------------------------------------------------------------


@query("union_all", oracle("SELECT customer_id, event_date, quantity FROM raw_usage_events UNION ALL SELECT customer_id, event_date, quantity FROM raw_late_usage"))
def _(m):
    columns = ["customer_id", "event_date", "quantity"]
    return staging.union_late_events(m.raw("raw_usage_events").select(*columns), m.raw("raw_late_usage").select(*columns))


_BATCH_KEYS = "SELECT DISTINCT ticket_id FROM stg_support_tickets WHERE batch_id = {}"


@query("key_set_difference", oracle(f"{_BATCH_KEYS.format(2)} EXCEPT {_BATCH_KEYS.format(1)}"))
def _(m):
    t = m.stg_support_tickets
    return quality.key_difference(t.filter("batch_id = 2"), t.filter("batch_id = 1"), "ticket_id")


@query("key_intersection", oracle(f"{_BATCH_KEYS.format(2)} INTERSECT {_BATCH_KEYS.format(1)}"))
def _(m):
    t = m.stg_support_tickets
    return quality.key_intersection(t.filter("batch_id = 2"), t.filter("batch_id = 1"), "ticket_id")


@query("distinct_values", oracle("SELECT DISTINCT region FROM dim_customers WHERE region IS NOT NULL ORDER BY region"))
def _(m):
    return access.distinct_values(m.dim_customers, "region")


