"""Serving queries, their post-processing, and the quality reports."""

from __future__ import annotations

from retentia.plans import quality, serving
from retentia.session import scratch_dir
from retentia.sources.store import materialise
from verification.operator_queries import BREAKDOWN, BREADTH, DETAIL, LEADERS, MANAGER, null_rate_sql
from verification.core_queries import WATERFALL
from verification.models import stored_health, with_stored_lines
from verification.oracle import average, month, oracle, rounded
from verification.registry import query

_FIRST = "mrr_month = DATE '2024-01-01'"

# --- revenue ----------------------------------------------------------------------------------


@query(
    "mrr_trend",
    oracle("""SELECT mrr_month, sum(mrr) AS total_mrr, sum(new_mrr_amount) AS new_mrr, sum(expansion_mrr) AS expansion_mrr,
              sum(contraction_mrr) AS contraction_mrr, sum(churn_mrr_amount) AS churn_mrr,
              count(DISTINCT customer_id) FILTER (WHERE mrr > 0) AS active_customers
              FROM movements WHERE region = 'ASIA' GROUP BY mrr_month""", DOUBLE="total_mrr new_mrr expansion_mrr contraction_mrr churn_mrr"),
)
def _(m):
    return serving.mrr_trend(m.movements, MANAGER)


@query(
    "arr_by_region",
    oracle("""SELECT region, round(12 * sum(mrr), 0) AS arr, round(sum(mrr), 0) AS mrr FROM movements
              WHERE mrr_month = DATE '2024-03-01' GROUP BY region""", DOUBLE="arr mrr"),
)
def _(m):
    return serving.in_report_order("arr_by_region", serving.arr_by_region(m.movements, p=m.p))


@query("nrr_waterfall", oracle("SELECT * EXCLUDE (reactivation_mrr, ending_mrr_pct_change) FROM mart_nrr WHERE region = 'ALL'", DOUBLE=WATERFALL))
def _(m):
    return serving.in_report_order("nrr_waterfall", serving.nrr_waterfall(m.mart_nrr))


@query("amendment_breakdown", oracle(BREAKDOWN, DOUBLE="mrr_gained mrr_lost net_delta"))
def _(m):
    return serving.in_report_order("amendment_breakdown", serving.amendment_breakdown(m.fct_contract_amendments, p=m.p))


def _percent(amount: str, digits: int) -> str:
    return rounded(f"CASE WHEN starting_mrr > 0 THEN CAST({amount} AS DOUBLE) / CAST(starting_mrr AS DOUBLE) * 100 END", digits)


_OPENED = f"""SELECT mrr_month, region, {_FIRST} AS is_opening, churned_customers, CASE WHEN {_FIRST} THEN 0 ELSE starting_mrr END AS starting_mrr,
    CASE WHEN {_FIRST} THEN 0 ELSE expansion_mrr END AS expansion_mrr, CASE WHEN {_FIRST} THEN 0 ELSE contraction_mrr END AS contraction_mrr,
    CASE WHEN {_FIRST} THEN 0 ELSE churn_mrr END AS churn_mrr, CASE WHEN {_FIRST} THEN ending_mrr ELSE new_mrr END AS new_mrr, ending_mrr
    FROM mart_nrr WHERE region = 'ALL'"""


@query(
    "ending_based_nrr",
    oracle(f"""SELECT * EXCLUDE (churned_customers), {_percent("ending_mrr - new_mrr", 1)} AS nrr_pct,
               {_percent("starting_mrr - contraction_mrr - churn_mrr", 1)} AS grr_pct, {_percent("churn_mrr", 2)} AS churn_rate_pct
               FROM ({_OPENED}) AS opened""", DOUBLE=WATERFALL),
)
def _(m):
    return serving.ending_based_nrr(serving.nrr_waterfall(m.mart_nrr), m.p)


_GAP = "ending_mrr - starting_mrr - new_mrr - expansion_mrr + contraction_mrr + churn_mrr"


@query(
    "timing_adjustment",
    oracle(f"""SELECT mrr_month, region, CASE WHEN is_opening THEN 0 ELSE {_GAP} END AS timing_adj, abs(timing_adj) > 1 AS in_chart,
               abs(timing_adj) > 10 AS in_table FROM ({_OPENED}) AS opened""", DOUBLE="timing_adj"),
)
def _(m):
    return serving.timing_adjustment(serving.nrr_waterfall(m.mart_nrr), m.p)


@query(
    "waterfall_rows",
    oracle(f"""SELECT position, step, measure, value FROM (
                 SELECT unnest([{{'position': 1, 'step': 'Starting', 'measure': 'absolute', 'value': CAST(starting_mrr AS DOUBLE)}},
                   {{'position': 2, 'step': 'New', 'measure': 'relative', 'value': CAST(new_mrr AS DOUBLE)}},
                   {{'position': 3, 'step': 'Expansion', 'measure': 'relative', 'value': CAST(expansion_mrr AS DOUBLE)}},
                   {{'position': 4, 'step': 'Contraction', 'measure': 'relative', 'value': CAST(-contraction_mrr AS DOUBLE)}},
                   {{'position': 5, 'step': 'Churn', 'measure': 'relative', 'value': CAST(-churn_mrr AS DOUBLE)}},
                   {{'position': 6, 'step': 'Timing Adj', 'measure': 'relative', 'value': CAST({_GAP} AS DOUBLE)}},
                   {{'position': 7, 'step': 'Ending', 'measure': 'total', 'value': CAST(ending_mrr AS DOUBLE)}}], recursive := true)
                 FROM mart_nrr WHERE region = 'ALL' AND starting_mrr > 0 QUALIFY row_number() OVER (ORDER BY mrr_month DESC) = 1) AS steps
               WHERE step <> 'Timing Adj' OR abs(value) > 1""", INTEGER="position"),
)
def _(m):
    return serving.waterfall_rows(serving.nrr_waterfall(m.mart_nrr))


@query(
    "month_over_month_deltas",
    oracle(f"""SELECT mrr_month, region, strftime(mrr_month, '%b %Y') AS month_label, ending_mrr - lag(ending_mrr) OVER w AS ending_mrr_delta,
                 raw_churn - lag(raw_churn) OVER w AS churn_mrr_delta, churned_customers - lag(churned_customers) OVER w AS churned_customers_delta,
                 {rounded("nrr - lag(nrr) OVER w", 1)} AS nrr_delta,
                 CASE WHEN lag(raw_churn) OVER w > 0 THEN {rounded("CAST(raw_churn - lag(raw_churn) OVER w AS DOUBLE) / CAST(lag(raw_churn) OVER w AS DOUBLE) * 100", 1)}
                   WHEN lag(raw_churn) OVER w = 0 THEN 0 END AS churn_pct_change
               FROM (SELECT o.*, n.churn_mrr AS raw_churn, CASE WHEN o.starting_mrr > 0 THEN
                       {rounded("CAST(o.ending_mrr - o.new_mrr AS DOUBLE) / CAST(o.starting_mrr AS DOUBLE) * 100", 1)} END AS nrr
                     FROM ({_OPENED}) AS o JOIN mart_nrr n USING (mrr_month, region)) AS ratios
               WINDOW w AS (PARTITION BY region ORDER BY mrr_month)""", DOUBLE="ending_mrr_delta churn_mrr_delta"),
)
def _(m):
    return serving.month_over_month_deltas(serving.nrr_waterfall(m.mart_nrr), m.p)


@query(
    "amendment_month_summary",
    oracle(f"""SELECT n.mrr_month AS month, n.{_FIRST} AS is_opening,
                 CASE WHEN n.{_FIRST} THEN t.gained ELSE n.expansion_mrr END AS expansion_total,
                 CASE WHEN n.{_FIRST} THEN t.lost ELSE n.contraction_mrr END AS contraction_total,
                 CASE WHEN n.mrr_month > DATE '2024-01-01' AND n.expansion_mrr > 0 THEN t.top_expansion END AS top_expansion,
                 CASE WHEN n.mrr_month > DATE '2024-01-01' AND n.contraction_mrr > 0 THEN t.top_contraction END AS top_contraction
               FROM mart_nrr n LEFT JOIN ({LEADERS}) t ON t.month = n.mrr_month WHERE n.region = 'ALL'""", DOUBLE="expansion_total contraction_total"),
)
def _(m):
    breakdown = serving.amendment_breakdown(m.fct_contract_amendments, p=m.p)
    return serving.amendment_month_summary(serving.nrr_waterfall(m.mart_nrr), breakdown, m.p)


# --- customers --------------------------------------------------------------------------------

_TABLE = """customer_id, company_name, region, account_tier, health_score, risk_tier, current_mrr, mrr_at_risk, usage_score, support_score,
    financial_score, is_silent_churn, has_open_critical_ticket, has_overdue_invoices, has_recent_downgrade, is_expansion_candidate,
    total_events_3m, feb_mar_pct_change, avg_satisfaction_score, open_tickets"""
_TABLE_TYPES = {"DOUBLE": "current_mrr mrr_at_risk", "INTEGER": "health_score usage_score support_score financial_score"}


@query("health_score_table", oracle(f"SELECT {_TABLE} FROM health WHERE region = 'ASIA'", **_TABLE_TYPES))
def _(m):
    return serving.in_report_order("health_score_table", serving.health_score_table(m.health, MANAGER))


@query(
    "filter_health",
    oracle(f"""SELECT * REPLACE (coalesce(is_silent_churn, false) AS is_silent_churn, coalesce(has_open_critical_ticket, false) AS has_open_critical_ticket,
               coalesce(has_overdue_invoices, false) AS has_overdue_invoices)
               FROM (SELECT {_TABLE} FROM health WHERE region IN ('ASIA', 'AMERICA') AND risk_tier IN ('critical', 'at_risk'))""", **_TABLE_TYPES),
)
def _(m):
    return serving.filter_health(serving.health_score_table(m.health), ["critical", "at_risk"], ["ASIA", "AMERICA"])


@query(
    "risk_summary",
    oracle(f"""SELECT risk_tier, count(*) AS customers, round(sum(current_mrr), 0) AS total_mrr, round(sum(mrr_at_risk), 0) AS mrr_at_risk,
               {rounded(average("health_score"), 1)} AS avg_score FROM health GROUP BY risk_tier""", DOUBLE="total_mrr mrr_at_risk"),
)
def _(m):
    return serving.in_report_order("risk_summary", serving.risk_summary(m.health))


@query("mrr_at_risk_by_region", oracle("SELECT region, sum(mrr_at_risk) AS mrr_at_risk FROM health WHERE mrr_at_risk > 0 GROUP BY region", DOUBLE="mrr_at_risk"))
def _(m):
    return serving.mrr_at_risk_by_region(serving.health_score_table(m.health))


# --- support ----------------------------------------------------------------------------------


@query(
    "support_summary",
    oracle("""SELECT ticket_month, region, total_tickets, open_tickets, resolved_tickets, high_priority_tickets, billing_tickets,
              avg_resolution_hours, avg_satisfaction, resolution_rate_pct, low_satisfaction_count, unique_customers_with_tickets
              FROM mart_support_summary WHERE region = 'ALL'""",
           BIGINT="total_tickets open_tickets resolved_tickets high_priority_tickets billing_tickets low_satisfaction_count unique_customers_with_tickets"),
)
def _(m):
    return serving.in_report_order("support_summary", serving.support_summary(m.mart_support_summary))


_OPEN = """SELECT ticket_id, customer_id, company_name, region, category, priority, channel, created_date, resolution_hours,
    satisfaction_score, is_high_priority FROM fct_support_tickets WHERE is_open"""


@query("open_tickets", oracle(f"{_OPEN} AND region = 'ASIA'", DOUBLE="resolution_hours satisfaction_score"))
def _(m):
    return serving.in_report_order("open_tickets", serving.open_tickets(m.fct_support_tickets, MANAGER))


@query(
    "ticket_days_open",
    oracle(f"""SELECT ticket_id, company_name, region, category, priority, channel, created_date, DATE '2024-03-31' - created_date AS days_open
               FROM ({_OPEN}) WHERE priority IN ('critical', 'high')""", INTEGER="days_open"),
)
def _(m):
    return serving.ticket_days_open(serving.open_tickets(m.fct_support_tickets), p=m.p)


_BY_CATEGORY = f"""SELECT category, region, count(*) AS total_tickets, {rounded(average("resolution_hours"), 1)} AS avg_resolution_hours,
    {rounded(average("satisfaction_score"), 2)} AS avg_satisfaction, count(*) FILTER (WHERE is_high_priority) AS high_priority_tickets
    FROM fct_support_tickets GROUP BY category, region"""


@query("support_by_category", oracle(_BY_CATEGORY))
def _(m):
    return serving.in_report_order("support_by_category", serving.support_by_category(m.tickets_by_region))


@query(
    "category_rollup",
    oracle(f"""SELECT category, sum(total_tickets) AS total_tickets, {rounded(average("CAST(avg_resolution_hours AS DECIMAL(28,1))"), 1)} AS avg_resolution_hours,
               {rounded(average("CAST(avg_satisfaction AS DECIMAL(28,2))"), 2)} AS avg_satisfaction
               FROM ({_BY_CATEGORY}) AS regional GROUP BY category""", BIGINT="total_tickets"),
)
def _(m):
    return serving.category_rollup(serving.support_by_category(m.tickets_by_region))


# --- product ----------------------------------------------------------------------------------


@query(
    "usage_monthly_trend",
    oracle(f"""SELECT {month("event_date")} AS month, metric_name, count(DISTINCT u.customer_id) AS active_customers,
               round(sum(quantity), 0) AS total_quantity, {rounded(average("quantity"), 1)} AS avg_quantity
               FROM latest_usage u JOIN dim_customers c USING (customer_id) WHERE c.region = 'ASIA' GROUP BY ALL""", DOUBLE="total_quantity"),
)
def _(m):
    return serving.in_report_order("usage_monthly_trend", serving.usage_monthly_trend(m.usage_by_region, MANAGER))


_KPIS = f"""SELECT count(customer_id) AS mau, {rounded(average("max_feature_breadth"), 1)} AS avg_feature_breadth,
    count(*) FILTER (WHERE is_silent_churn) AS silent_churn_customers, count(*) FILTER (WHERE is_consistently_declining) AS declining_customers,
    {rounded(average("total_events_3m"), 0)} AS avg_events_per_customer, {rounded(average("mar_users"), 1)} AS avg_active_users_mar FROM usage_stats"""


@query("usage_kpis", oracle(_KPIS))
def _(m):
    return serving.usage_kpis(m.usage_stats, p=m.p)


_DETAIL_COLUMNS = """customer_id, company_name, region, account_tier, jan_events, feb_events, mar_events, total_events_3m, max_feature_breadth,
    jan_feb_pct_change, feb_mar_pct_change, is_silent_churn, is_consistently_declining, sharp_drop_last_month, zero_usage_months, current_mrr,
    health_score, risk_tier, mrr_at_risk, round(mar_users, 0) AS mar_active_users, round(mar_api, 0) AS mar_api_calls"""


@query(
    "usage_customer_detail",
    oracle(f"SELECT {_DETAIL_COLUMNS} FROM ({DETAIL}) AS detail WHERE region = 'ASIA'", DOUBLE="current_mrr mrr_at_risk mar_active_users mar_api_calls", INTEGER="zero_usage_months health_score"),
)
def _(m):
    return serving.in_report_order("usage_customer_detail", serving.usage_customer_detail(m.usage_stats, m.health, MANAGER, m.p))


@query("feature_breadth_by_month", oracle(BREADTH.replace("FROM latest_usage", "FROM (SELECT u.* FROM latest_usage u JOIN dim_customers c USING (customer_id) WHERE c.region = 'ASIA') AS visible")))
def _(m):
    return serving.in_report_order("feature_breadth_by_month", serving.feature_breadth_by_month(m.usage_by_region, MANAGER, m.p))


_POST_TICKET = f"""SELECT s.customer_id, c.company_name, c.region, s.total_tickets, {rounded("s.avg_engagement_recovery", 2)} AS recovery_ratio,
    s.tickets_not_recovered, s.has_open_critical_ticket, s.poor_post_ticket_recovery, s.unresolved_with_no_recovery,
    {rounded("s.avg_satisfaction_score", 1)} AS avg_satisfaction, coalesce(h.current_mrr, 0) AS current_mrr, coalesce(h.risk_tier, 'unknown') AS risk_tier
    FROM support_signals s LEFT JOIN dim_customers c USING (customer_id) LEFT JOIN health h ON h.customer_id = s.customer_id"""


@query("post_ticket_engagement", oracle(_POST_TICKET, DOUBLE="current_mrr"))
def _(m):
    return serving.in_report_order("post_ticket_engagement", serving.post_ticket_engagement(m.support_signals, m.dim_customers, m.health))


@query(
    "engagement_quadrant",
    oracle(f"""SELECT customer_id, current_mrr, total_events_3m, risk_tier, median_current_mrr, median_total_events_3m,
                 CASE WHEN current_mrr >= median_current_mrr THEN 'high' ELSE 'low' END || '_mrr_'
                   || CASE WHEN total_events_3m >= median_total_events_3m THEN 'high' ELSE 'low' END || '_usage' AS quadrant
               FROM (SELECT customer_id, CAST(current_mrr AS DOUBLE) AS current_mrr, total_events_3m, risk_tier,
                       quantile_cont(CAST(current_mrr AS DOUBLE), 0.5) OVER () AS median_current_mrr,
                       quantile_cont(CAST(total_events_3m AS DOUBLE), 0.5) OVER () AS median_total_events_3m FROM ({DETAIL}) AS detail) AS placed"""),
)
def _(m):
    detail = serving.usage_customer_detail(*stored_health(m), p=m.p)
    return serving.engagement_quadrant(materialise(detail, scratch_dir(m.spark, "detail")), m.p)


@query(
    "recovery_buckets",
    oracle(f"""SELECT CASE WHEN recovery_ratio IS NULL THEN 'No data' WHEN recovery_ratio < 0.5 THEN '🚨 Not recovered (<0.5x)'
                 WHEN recovery_ratio < 1 THEN '⚠️ Partial (0.5–1x)' ELSE '✅ Recovered (≥1x)' END AS recovery_bucket,
                 count(*) AS customers, sum(current_mrr) AS total_mrr FROM ({_POST_TICKET}) AS engagement GROUP BY ALL""", DOUBLE="total_mrr"),
)
def _(m):
    return serving.recovery_buckets(serving.post_ticket_engagement(m.support_signals, m.dim_customers, m.health))


@query(
    "no_recovery_list",
    oracle(f"""SELECT company_name, region, total_tickets, recovery_ratio, avg_satisfaction, current_mrr, risk_tier FROM ({_POST_TICKET}) AS engagement
               WHERE poor_post_ticket_recovery OR unresolved_with_no_recovery""", DOUBLE="current_mrr"),
)
def _(m):
    return serving.no_recovery(serving.post_ticket_engagement(m.support_signals, m.dim_customers, m.health))


@query(
    "usage_risk_table",
    oracle(f"""SELECT company_name, region, account_tier, jan_events, feb_events, mar_events, feb_mar_pct_change, current_mrr, risk_tier,
                 is_silent_churn, is_consistently_declining, sharp_drop_last_month FROM ({DETAIL}) AS detail
               WHERE is_silent_churn OR is_consistently_declining OR sharp_drop_last_month""", DOUBLE="current_mrr"),
)
def _(m):
    return serving.usage_risk_table(serving.usage_customer_detail(m.usage_stats, m.health, p=m.p), p=m.p)


@query(
    "usage_shares",
    oracle(f"""SELECT mau, total_customers, declining_customers, {rounded("CAST(mau AS DOUBLE) / total_customers * 100", 1)} AS engagement_pct,
                 {rounded("CAST(declining_customers AS DOUBLE) / total_customers * 100", 0)} AS declining_pct
               FROM ({_KPIS}) AS kpis, (SELECT count(*) AS total_customers FROM usage_stats) AS base"""),
)
def _(m):
    return serving.usage_shares(serving.usage_kpis(m.usage_stats, p=m.p), m.usage_stats)


# --- profiles ---------------------------------------------------------------------------------

_RAW = ["raw_customers", "raw_plans", "raw_subscriptions", "raw_invoices", "raw_payments", "raw_usage_events", "raw_late_usage",
        "raw_support_tickets", "raw_product_events", "raw_adjustments", "raw_contract_amendments"]
_UNBATCHED = {"raw_customers": 15, "raw_plans": 9, "raw_subscriptions": 9}
_WIDTHS = _UNBATCHED | {"raw_invoices": 14, "raw_payments": 10, "raw_usage_events": 5, "raw_late_usage": 5, "raw_support_tickets": 11,
                        "raw_product_events": 7, "raw_adjustments": 11, "raw_contract_amendments": 12}


def rows_per_batch(width: bool) -> str:
    def one(t: str) -> str:
        batch = "CAST(NULL AS INTEGER)" if t in _UNBATCHED else "CAST(_batch_id AS INTEGER)"
        columns = f", {_WIDTHS[t]} AS columns" if width else ""
        return f"SELECT '{t}' AS table_name, {batch} AS batch_id, count(*) AS rows{columns} FROM {t} GROUP BY ALL"

    return " UNION ALL ".join(one(t) for t in _RAW)


def raw_tables(m) -> dict:
    return {t: m.raw(t) for t in _RAW}


@query("profile_row_counts", oracle(rows_per_batch(width=True)))
def _(m):
    return quality.profile_row_counts(raw_tables(m))


_SUBSCRIPTION_COLUMNS = "subscription_id customer_id plan_id start_date end_date mrr billing_cycle auto_renew status".split()
_INVOICE_COLUMNS = ("invoice_id customer_id subscription_id invoice_date due_date amount currency status line_items_count tax_amount "
                    "total_amount period_start period_end created_at batch_id").split()  # fmt: skip
_PAYMENT_COLUMNS = ("payment_id invoice_id customer_id amount payment_method payment_date status transaction_ref processor_fee "
                    "net_amount batch_id").split()  # fmt: skip
_CUSTOMER_COLUMNS = ("customer_id company_name industry region country city signup_date account_owner status email phone "
                     "employee_count annual_revenue_usd notes account_tier").split()  # fmt: skip


@query(
    "profile_null_rates",
    oracle(" UNION ALL ".join(null_rate_sql(t, *c) for t, c in {
        "stg_customers": _CUSTOMER_COLUMNS, "stg_subscriptions": _SUBSCRIPTION_COLUMNS,
        "stg_invoices": _INVOICE_COLUMNS, "stg_payments": _PAYMENT_COLUMNS}.items())),
)
def _(m):
    names = ["stg_customers", "stg_subscriptions", "stg_invoices", "stg_payments"]
    return quality.profile_null_rates({n: getattr(m, n) for n in names})


@query(
    "profile_id_formats",
    oracle("""SELECT CAST(_batch_id AS INTEGER) AS batch_id, CASE WHEN regexp_matches(customer_id, '^(?i)cust-') THEN 'CUST-001'
                WHEN regexp_matches(customer_id, '^(?i)cust_') THEN 'cust_1234' WHEN regexp_matches(customer_id, '^[Cc][0-9]+$') THEN 'C001'
                ELSE 'other: ' || left(customer_id, 10) END AS id_format, count(*) AS records FROM raw_payments WHERE customer_id IS NOT NULL GROUP BY ALL"""),
)
def _(m):
    return quality.profile_id_formats(m.raw("raw_payments"))


_KEYED = {"raw_customers": "customer_id", "raw_subscriptions": "subscription_id", "raw_invoices": "invoice_id", "raw_payments": "payment_id",
          "raw_support_tickets": "ticket_id", "raw_plans": "plan_id"}


def _duplicates(t: str, key: str) -> str:
    batch = "CAST(NULL AS INTEGER)" if t in _UNBATCHED else "CAST(_batch_id AS INTEGER)"
    return f"SELECT '{t}' AS table_name, '{key}' AS key, {batch} AS batch_id, count(*) - count(DISTINCT {key}) AS duplicates FROM {t} GROUP BY ALL"


@query("profile_duplicate_keys", oracle(" UNION ALL ".join(_duplicates(t, k) for t, k in _KEYED.items())))
def _(m):
    return quality.profile_duplicate_keys({t: (m.raw(t), k) for t, k in _KEYED.items()})


_CHILDREN = ["stg_subscriptions", "stg_invoices", "stg_payments", "stg_usage_events", "stg_support_tickets"]


def _orphans(t: str) -> str:
    return f"""SELECT '{t}' AS table_name, count(*) FILTER (WHERE c.customer_id IS NULL) AS orphans,
        {rounded("100.0::DOUBLE * count(*) FILTER (WHERE c.customer_id IS NULL) / count(*)", 1)} AS orphan_pct
        FROM (SELECT DISTINCT customer_id FROM {t} WHERE customer_id IS NOT NULL) AS k LEFT JOIN dim_customers c ON c.customer_id = k.customer_id"""


@query("profile_orphans", oracle(" UNION ALL ".join(_orphans(t) for t in _CHILDREN)))
def _(m):
    return quality.profile_orphans({t: getattr(m, t) for t in _CHILDREN}, m.dim_customers)


@query(
    "profile_subscription_overlap",
    oracle("""SELECT count(*) AS customers_with_several FROM (SELECT customer_id FROM stg_subscriptions
              WHERE end_date IS NULL OR end_date > start_date GROUP BY customer_id HAVING count(*) > 1) AS several"""),
)
def _(m):
    return quality.profile_subscription_overlap(m.stg_subscriptions)


@query(
    "profile_subscription_overlap_by_period",
    oracle("""SELECT * FROM (WITH lasting AS (
                SELECT customer_id, start_date AS opens, coalesce(end_date, DATE '9999-12-31') AS closes, row_number() OVER () AS nr
                FROM stg_subscriptions WHERE customer_id IS NOT NULL AND (end_date IS NULL OR end_date > start_date)
              ), meeting AS (
                SELECT a.nr, a.customer_id, count(*) AS running
                FROM lasting a JOIN lasting b ON a.customer_id = b.customer_id AND a.opens BETWEEN b.opens AND b.closes
                GROUP BY ALL
              )
              SELECT count(DISTINCT customer_id) FILTER (WHERE running > 1) AS customers_with_overlap,
                coalesce(max(running), 0) AS most_at_once FROM meeting) AS report"""),
)
def _(m):
    return quality.profile_subscription_overlap(m.stg_subscriptions, by_period=True)


@query("profile_date_range", oracle("SELECT batch_id, min(payment_date) AS first_date, max(payment_date) AS last_date FROM stg_payments GROUP BY batch_id"))
def _(m):
    return quality.profile_date_range(m.stg_payments, "payment_date")


@query(
    "profile_status_distribution",
    oracle("""SELECT 'stg_subscriptions' AS table_name, status AS value, count(*) AS rows FROM stg_subscriptions GROUP BY status
              UNION ALL SELECT 'stg_payments', status, count(*) FROM stg_payments GROUP BY status"""),
)
def _(m):
    # tickets carry no status column and are skipped
    names = ["stg_subscriptions", "stg_payments", "stg_support_tickets"]
    return quality.profile_status_distribution({n: getattr(m, n) for n in names})


_TICKET_KEYS = "(SELECT DISTINCT ticket_id FROM raw_support_tickets WHERE _batch_id = '{}')"


def _drift(b: int) -> str:
    here, before = _TICKET_KEYS.format(b), _TICKET_KEYS.format(b - 1)
    if b == 1:
        return f"SELECT 1 AS batch_id, count(*) AS keys, CAST(NULL AS BIGINT) AS new_keys, CAST(NULL AS BIGINT) AS dropped_keys FROM {here} AS h"
    return f"""SELECT {b}, (SELECT count(*) FROM {here} AS h), (SELECT count(*) FROM ({here} EXCEPT {before}) AS n),
        (SELECT count(*) FROM ({before} EXCEPT {here}) AS d)"""


@query("profile_batch_key_drift", oracle(" UNION ALL ".join(_drift(b) for b in (1, 2, 3))))
def _(m):
    return quality.profile_batch_key_drift(m.raw("raw_support_tickets"), "ticket_id", [1, 2, 3])


# --- expectations -----------------------------------------------------------------------------


@query("expect_unique", oracle("SELECT invoice_id, count(*) AS rows FROM stg_invoices GROUP BY invoice_id HAVING count(*) > 1"))
def _(m):
    return quality.failing_unique(m.stg_invoices, "invoice_id")


@query("expect_not_null", oracle("SELECT customer_id, company_name, region FROM stg_customers WHERE region IS NULL"))
def _(m):
    return quality.failing_not_null(m.stg_customers, "region").select("customer_id", "company_name", "region")


@query(
    "expect_accepted_values",
    oracle("SELECT region AS value, count(*) AS rows FROM dim_customers WHERE region NOT IN ('NA', 'EMEA', 'APAC', 'UNKNOWN') GROUP BY region"),
)
def _(m):
    return quality.failing_accepted_values(m.dim_customers, "region", ("NA", "EMEA", "APAC", "UNKNOWN"))


def _expectation(e: quality.Expectation) -> str:
    head = f"SELECT '{e.table}' AS table_name, '{e.column}' AS column_name, '{e.check}' AS check_name, '{e.severity}' AS severity"
    if e.check == "unique":
        return f"{head}, count(*) AS failures FROM (SELECT {e.column} FROM {e.table} WHERE {e.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) AS d"
    if e.check == "not_null":
        return f"{head}, count(*) - count({e.column}) AS failures FROM {e.table}"
    listed = ", ".join(f"'{v}'" for v in e.values)
    return f"{head}, count(*) FILTER (WHERE {e.column} NOT IN ({listed})) AS failures FROM {e.table}"


@query("run_expectations", oracle(" UNION ALL ".join(_expectation(e) for e in quality.EXPECTATIONS)))
def _(m):
    typed = {n: getattr(m, n) for n in ("stg_customers", "stg_plans", "stg_subscriptions", "dim_customers")}
    return quality.run_expectations(raw_tables(m) | typed)


_FLAGS = {
    "dim_customers": ["region_was_inferred"],
    "dim_subscriptions": ["dq_cancelled_no_end_date", "dq_end_before_start"],
    "fct_invoices": ["dq_due_before_invoice", "dq_unresolved_customer"],
    "fct_payments": ["dq_unresolved_customer", "dq_no_invoice_match"],
    "fct_usage_events": ["dq_unresolved_customer", "dq_no_active_subscription"],
    "fct_support_tickets": ["dq_unresolved_customer", "dq_resolved_before_created"],
    "fct_adjustments": ["dq_unresolved_customer"],
    "fct_contract_amendments": ["dq_unresolved_customer"],
}

FLAGS_SQL = oracle(" UNION ALL ".join(
    f"SELECT '{t}' AS model, '{f}' AS flag, count(*) FILTER (WHERE {f}) AS rows FROM {t}" for t, fs in _FLAGS.items() for f in fs
))


@query("dq_flags", FLAGS_SQL)
def _(m):
    """Three of the models, and the invoices that two of them look up, are made of order lines, which are stored once."""
    stored = with_stored_lines(m)
    return quality.dq_flag_counts({n: getattr(stored, n) for n in _FLAGS})
