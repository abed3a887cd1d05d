"""The helpers as session SQL functions, for callers who write SQL.

Catalyst inlines SQL functions into the calling projection, so they cost no more than the expression.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from retentia.functions.scoring import RISK_SHARES, SCORE_DISPLAY, TIER_DISPLAY, TIER_LABELS


def _case(table: tuple) -> str:
    bounds, otherwise = table
    quoted = lambda v: f"'{v}'" if isinstance(v, str) else f"{v}D"
    arms = " ".join(f"WHEN score <= {b} THEN {quoted(v)}" for b, v in bounds)
    return f"CASE {arms} ELSE {quoted(otherwise)} END"


def _definitions(id_width: int) -> dict[str, str]:
    half_up = "CAST(ROUND(CAST({} AS DECIMAL(28,10)), {}) AS DOUBLE)".format
    pct = half_up("100D * (cur - prior) / nullif(prior, 0D)", 1)
    return {
        "safe_divide(num DOUBLE, den DOUBLE)": "DOUBLE RETURN CAST(CAST(num AS DECIMAL(18,3)) AS DOUBLE) / nullif(den, 0D)",
        "pct_change(cur DOUBLE, prior DOUBLE)": f"DOUBLE RETURN {pct}",
        "calc_nrr(starting DOUBLE, expansion DOUBLE, contraction DOUBLE, churn DOUBLE)":
            "DOUBLE RETURN CAST(CAST(starting + expansion - contraction - churn AS DECIMAL(18,3)) AS DOUBLE)"
            " / nullif(starting, 0D)",
        "mrr_movement(cur DOUBLE, prev DOUBLE)":
            "STRING RETURN CASE WHEN prev IS NULL THEN 'new' WHEN cur > prev THEN 'expansion'"
            " WHEN cur < prev THEN 'contraction' WHEN cur = 0 THEN 'churn' ELSE 'unchanged' END",
        "clamp(value DOUBLE, low DOUBLE, high DOUBLE)": "DOUBLE RETURN greatest(low, least(high, value))",
        "risk_tier(score DOUBLE)": f"STRING RETURN {_case(TIER_LABELS)}",
        "risk_tier_emoji(score DOUBLE)": f"STRING RETURN {_case(TIER_DISPLAY)}",
        "months_since(start_date DATE, end_date DATE)":
            "INT RETURN (year(end_date) - year(start_date)) * 12 + month(end_date) - month(start_date)",
        "nullif_zero(value DOUBLE)": "DOUBLE RETURN nullif(value, 0D)",
        "health_score_label(score DOUBLE)":
            f"STRING RETURN CASE WHEN score IS NULL THEN 'Unknown' ELSE {_case(SCORE_DISPLAY)} END",
        "mrr_at_risk_pct(score DOUBLE)": f"DOUBLE RETURN {_case(RISK_SHARES)}",
        "normalize_to_cust_id(raw STRING)":
            "STRING RETURN CASE WHEN trim(raw) = '' THEN NULL WHEN startswith(trim(raw), 'CUST-') THEN trim(raw)"
            " ELSE concat('CUST-', lpad(regexp_replace(trim(raw), '^C', ''),"
            f" greatest({id_width}, length(regexp_replace(trim(raw), '^C', ''))), '0')) END",
    }


def register_functions(spark: SparkSession, id_width: int = 3) -> list[str]:
    """Create the temporary SQL functions and return their names."""
    names = []
    for signature, body in _definitions(id_width).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {body}")
        names.append(signature.split("(")[0])
    return names
