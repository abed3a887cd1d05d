"""Staging, normalisers, dimensions, facts, signals and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from retentia.functions import cleaning as cl, finance as fin, scoring as sc
from retentia.functions.calendar import months_since
from retentia.functions.sql import register_functions
from retentia.params import Params
from retentia.plans import core, health, signals
from verification.models import in_steps
from verification.oracle import RISK_TIER, change, customer, oracle, ratio, rounded, tier
from verification.registry import query

# --- staging ----------------------------------------------------------------------------------

_STAGING_DECIMALS = {
    "stg_customers": "",
    "stg_plans": "base_price",
    "stg_subscriptions": "mrr",
    "stg_invoices": "amount tax_amount total_amount",
    "stg_payments": "amount processor_fee net_amount",
    "stg_usage_events": "quantity",
    "stg_support_tickets": "resolution_hours satisfaction_score",
    "stg_product_events": "",
    "stg_adjustments": "amount",
    "stg_contract_amendments": "old_mrr new_mrr",
}
_HAS_ROW_ORDER = ("stg_invoices", "stg_payments", "stg_usage_events")
for _name, _decimals in _STAGING_DECIMALS.items():
    _columns = "* EXCLUDE (_row_seq)" if _name in _HAS_ROW_ORDER else "*"
    query(_name, oracle(f"SELECT {_columns} FROM {_name}", DOUBLE=_decimals))(
        lambda m, n=_name: getattr(m, n).drop("_row_seq")
    )

# --- normalisers ------------------------------------------------------------------------------


@query("normalize_customer_id", oracle(f"SELECT payment_id, customer_id AS raw_id, {customer('customer_id')} AS customer_id FROM raw_payments"))
def _(m):
    raw = m.raw("raw_payments")
    return raw.select(
        "payment_id", F.col("customer_id").alias("raw_id"), cl.normalize_customer_id(F.col("customer_id"), 9).alias("customer_id")
    )


@query("blank_to_null", oracle("SELECT customer_id, nullif(trim(city), '') AS city, nullif(trim(phone), '') AS phone FROM raw_customers"))
def _(m):
    raw = m.raw("raw_customers")
    return raw.select("customer_id", *[cl.blank_to_null(F.col(c)).alias(c) for c in ("city", "phone")])


@query("canonical_feature", oracle("SELECT event_id, feature FROM stg_product_events"))
def _(m):
    return m.raw("raw_product_events").select("event_id", cl.canonical_feature(F.col("feature")).alias("feature"))


@query("resolve_region", oracle("SELECT customer_id, region, region_was_inferred FROM dim_customers"))
def _(m):
    return core.with_resolved_region(m.stg_customers, m.country_region).select("customer_id", "region", "region_was_inferred")


@query("plan_tier", oracle("SELECT plan_id, plan_tier FROM dim_plans"))
def _(m):
    return m.stg_plans.select("plan_id", cl.plan_tier(F.col("plan_id")).alias("plan_tier"))


@query("feature_count", oracle("SELECT plan_id, feature_count FROM dim_plans"))
def _(m):
    return m.stg_plans.select("plan_id", cl.feature_count(F.col("features")).alias("feature_count"))


@query("customer_key", oracle("SELECT customer_id, customer_key FROM dim_customers"))
def _(m):
    return m.stg_customers.select("customer_id", cl.customer_key(F.col("customer_id")).alias("customer_key"))


@query("cycle_rank", oracle("SELECT subscription_id, cycle_rank FROM subscriptions"))
def _(m):
    return m.stg_subscriptions.select("subscription_id", cl.cycle_rank(F.col("billing_cycle")).alias("cycle_rank"))


@query("revenue_impact", oracle("SELECT adjustment_id, adjustment_type, amount, revenue_impact FROM fct_adjustments", DOUBLE="amount revenue_impact"))
def _(m):
    impact = cl.revenue_impact(F.col("adjustment_type"), F.col("amount"))
    return m.stg_adjustments.select("adjustment_id", "adjustment_type", "amount", impact.alias("revenue_impact"))


# --- dimensions and facts ---------------------------------------------------------------------

_CORE = {
    "dim_customers": "",
    "dim_plans": "base_price",
    "dim_subscriptions": "mrr prev_mrr mrr_delta",
    "fct_invoices": "amount tax_amount total_amount",
    "fct_payments": "amount processor_fee net_amount",
    "fct_usage_events": "quantity",
    "fct_support_tickets": "resolution_hours satisfaction_score",
    "fct_adjustments": "amount revenue_impact",
    "fct_contract_amendments": "old_mrr new_mrr mrr_delta",
}
# Facts of several wide joins, which are run one after the other.
_IN_STEPS = ("fct_payments", "fct_adjustments")
for _name, _decimals in _CORE.items():
    _columns = "* EXCLUDE (prev_status)" if _name == "dim_subscriptions" else "*"
    query(_name, oracle(f"SELECT {_columns} FROM {_name}", DOUBLE=_decimals))(
        lambda m, n=_name: in_steps(m, n) if n in _IN_STEPS else getattr(m, n)
    )


@query(
    "reactivation_movement",
    oracle("""SELECT subscription_id, prev_mrr, CASE WHEN prev_status = 'cancelled' AND mrr > 0 THEN 'reactivation' ELSE mrr_movement END AS mrr_movement
              FROM dim_subscriptions""", DOUBLE="prev_mrr"),
)
def _(m):
    return core.dim_subscriptions(m.stg_subscriptions, m.p, reactivation=True).select("subscription_id", "prev_mrr", "mrr_movement")


@query(
    "elapsed_renewal",
    oracle("""SELECT s.subscription_id, coalesce(CAST(min(r.renewal) AS DATE), any_value(s.end_date_resolved)) AS end_date_resolved
              FROM subscriptions s LEFT JOIN cycles c USING (billing_cycle)
              LEFT JOIN LATERAL (SELECT s.start_date + to_months(c.months * unnest(generate_series(1, 1200))) AS renewal) r
                ON r.renewal > DATE '2024-03-31' AND s.end_date_method = 'next_renewal'
              GROUP BY s.subscription_id"""),
)
def _(m):
    return core.resolved_subscriptions(m.stg_subscriptions, Params(id_width=9, renewal="elapsed")).select("subscription_id", "end_date_resolved")


# --- macros -----------------------------------------------------------------------------------


@query(
    "safe_divide",
    oracle(f"""SELECT payment_id, {ratio("net_amount", "processor_fee")} AS net_per_fee,
                 coalesce({ratio("amount", "batch_id - 1")}, 0) AS per_earlier_batch FROM stg_payments""", DOUBLE="per_earlier_batch"),
)
def _(m):
    return m.stg_payments.select(
        "payment_id",
        fin.safe_divide(F.col("net_amount"), F.col("processor_fee")).alias("net_per_fee"),
        fin.safe_divide(F.col("amount"), F.col("batch_id") - 1, F.lit(0.0)).alias("per_earlier_batch"),
    )


@query("pct_change", oracle(f"SELECT amendment_id, {change('new_mrr', 'old_mrr')} AS change_pct FROM stg_contract_amendments"))
def _(m):
    return m.stg_contract_amendments.select("amendment_id", fin.pct_change(F.col("new_mrr"), F.col("old_mrr")).alias("change_pct"))


@query(
    "calc_nrr",
    oracle(f"""SELECT mrr_month, region, {rounded(ratio("starting_mrr + expansion_mrr - contraction_mrr - churn_mrr", "starting_mrr"), 6)} AS nrr
               FROM nrr_sums"""),
)
def _(m):
    parts = [F.col(c) for c in ("starting_mrr", "expansion_mrr", "contraction_mrr", "churn_mrr")]
    return m.mart_nrr.select("mrr_month", "region", fin.round_half_up(fin.calc_nrr(*parts), 6).alias("nrr"))


@query("mrr_movement", oracle("SELECT amendment_id, mrr_movement FROM fct_contract_amendments"))
def _(m):
    return m.stg_contract_amendments.select("amendment_id", fin.mrr_movement(F.col("new_mrr"), F.col("old_mrr")).alias("mrr_movement"))


# Employee counts run from 0 to 499: as tenths minus 5 they exercise every score bound on both sides.
_SCORED = "(SELECT customer_id, CAST(employee_count AS DOUBLE) * 0.25 - 5 AS score, employee_count FROM stg_customers)"


def _scored(m):
    return m.stg_customers.select("customer_id", (F.col("employee_count").cast("double") * 0.25 - 5).alias("score"), "employee_count")


@query("clamp", oracle(f"SELECT customer_id, greatest(0, least(100, score)) AS clamped FROM {_SCORED}", DOUBLE="clamped"))
def _(m):
    # least/greatest skip NULL: a missing score is clamped to the upper bound, in both engines
    return _scored(m).select("customer_id", sc.clamp(F.col("score"), 0.0, 100.0).alias("clamped"))


@query("risk_tier", oracle(f"SELECT customer_id, {tier('score', RISK_TIER, chr(39) + 'healthy' + chr(39))} AS risk_tier FROM {_SCORED}"))
def _(m):
    return _scored(m).select("customer_id", sc.risk_tier(F.col("score")).alias("risk_tier"))


_TIER_DISPLAY = [(30, "'🔴 Critical'"), (60, "'🟡 At Risk'")]


@query("risk_tier_emoji", oracle(f"""SELECT customer_id, {tier("score", _TIER_DISPLAY, "'🟢 Healthy'")} AS label FROM {_SCORED}"""))
def _(m):
    return _scored(m).select("customer_id", sc.risk_tier_emoji(F.col("score")).alias("label"))


@query("months_since", oracle("SELECT customer_id, datediff('month', signup_date, DATE '2024-03-31') AS months FROM stg_customers", INTEGER="months"))
def _(m):
    return m.stg_customers.select("customer_id", months_since(F.col("signup_date"), F.lit(m.p.ref_date)).alias("months"))


@query("nullif_zero", oracle("SELECT customer_id, nullif(employee_count, 0) AS employees FROM stg_customers"))
def _(m):
    return m.stg_customers.select("customer_id", sc.nullif_zero(F.col("employee_count")).alias("employees"))


@query(
    "health_score_label",
    oracle(f"""SELECT customer_id, CASE WHEN score IS NULL THEN 'Unknown' ELSE
               {tier("score", [*_TIER_DISPLAY, (80, "'🟢 Healthy'")], "'⭐ Champion'")} END AS label FROM {_SCORED}"""),
)
def _(m):
    register_functions(m.spark, m.p.id_width)
    return _scored(m).select("customer_id", F.expr("health_score_label(score)").alias("label"))


@query(
    "mrr_at_risk_pct",
    oracle(f"""SELECT customer_id, {tier("score", [(30, "1.0"), (45, "0.75"), (60, "0.5"), (75, "0.25")], "0.0")} AS share FROM {_SCORED}""", DOUBLE="share"),
)
def _(m):
    register_functions(m.spark, m.p.id_width)
    return _scored(m).select("customer_id", F.expr("mrr_at_risk_pct(score)").alias("share"))


@query("normalize_to_cust_id", oracle(f"SELECT adjustment_id, {customer('customer_id')} AS customer_id FROM raw_adjustments"))
def _(m):
    register_functions(m.spark, m.p.id_width)
    return m.raw("raw_adjustments").select("adjustment_id", F.expr("normalize_to_cust_id(customer_id)").alias("customer_id"))


# --- signals and marts ------------------------------------------------------------------------

_USAGE_NUMBERS = "jan_quantity feb_quantity mar_quantity jan_api feb_api mar_api jan_users feb_users mar_users total_quantity_3m"


@query("customer_usage_stats", oracle("SELECT * FROM usage_stats", DOUBLE=_USAGE_NUMBERS, INTEGER="zero_usage_months"))
def _(m):
    return m.usage_stats


@query("ticket_engagement", oracle("SELECT * FROM ticket_engagement", DOUBLE="satisfaction_score resolution_hours pre_ticket_quantity post_ticket_quantity"))
def _(m):
    return m.ticket_engagement


@query("ticket_recovery", oracle("SELECT ticket_id, engagement_recovery_ratio, engagement_recovered FROM ticket_recovery"))
def _(m):
    return signals.ticket_recovery(m.ticket_engagement).select("ticket_id", "engagement_recovery_ratio", "engagement_recovered")


@query("customer_support_signals", oracle("SELECT * FROM support_signals", DOUBLE="min_satisfaction_score max_resolution_hours avg_engagement_recovery"))
def _(m):
    return m.support_signals


@query("customer_financial_signals", oracle("SELECT * FROM financial_signals", DOUBLE="total_billed total_paid total_overdue total_collected total_refunded current_mrr"))
def _(m):
    return m.financial_signals


@query("usage_score", oracle("SELECT customer_id, score AS usage_score FROM usage_scores", INTEGER="usage_score"))
def _(m):
    return m.usage_stats.select("customer_id", health.usage_score(m.p).alias("usage_score"))


@query("support_score", oracle("SELECT customer_id, score AS support_score FROM support_scores", INTEGER="support_score"))
def _(m):
    return m.support_signals.select("customer_id", health.support_score(m.p.points).alias("support_score"))


@query("financial_score", oracle("SELECT customer_id, score AS financial_score FROM financial_scores", INTEGER="financial_score"))
def _(m):
    return m.financial_signals.select("customer_id", health.financial_score(m.p.points).alias("financial_score"))


_HEALTH_TYPES = {"DOUBLE": "mrr_at_risk avg_engagement_recovery current_mrr", "INTEGER": "usage_score support_score financial_score health_score"}


@query("customer_health_score", oracle("SELECT * FROM health", **_HEALTH_TYPES))
def _(m):
    return m.health


_MOVEMENT_NUMBERS = "mrr prev_mrr mrr_delta new_mrr_amount churn_mrr_amount expansion_mrr contraction_mrr"


@query("mart_mrr", oracle("SELECT * FROM mart_mrr", DOUBLE=_MOVEMENT_NUMBERS + " mrr_at_risk", INTEGER="health_score"))
def _(m):
    return m.mart_mrr


@query("mrr_month_movement", oracle("SELECT customer_id, mrr_month, mrr_movement, mrr_delta, mrr_pct_change FROM movements", DOUBLE="mrr_delta"))
def _(m):
    return m.movements.select("customer_id", "mrr_month", "mrr_movement", "mrr_delta", "mrr_pct_change")


WATERFALL = "starting_mrr new_mrr expansion_mrr contraction_mrr churn_mrr ending_mrr"


@query("mart_nrr", oracle("SELECT * FROM mart_nrr", DOUBLE=WATERFALL + " reactivation_mrr"))
def _(m):
    return m.mart_nrr


@query(
    "mart_support_summary",
    oracle("SELECT * FROM mart_support_summary", BIGINT="""total_tickets open_tickets resolved_tickets high_priority_tickets billing_tickets
           technical_tickets account_tickets low_satisfaction_count unique_customers_with_tickets"""),
)
def _(m):
    return m.mart_support_summary


@query(
    "restated_nrr",
    oracle(f"""SELECT *, {rounded(ratio("starting_mrr + expansion_mrr - contraction_mrr - churn_mrr", "starting_mrr") + " * 100", 1)} AS nrr_pct,
                 {rounded(ratio("starting_mrr + booked_expansion_mrr - booked_contraction_mrr - churn_mrr", "starting_mrr") + " * 100", 1)}
                   AS booked_nrr_pct, moved_amendments > 0 AS is_restated
               FROM restated_sums""",
           DOUBLE="starting_mrr churn_mrr expansion_mrr contraction_mrr booked_expansion_mrr booked_contraction_mrr",
           BIGINT="moved_amendments"),
)
def _(m):
    return m.restated_nrr
