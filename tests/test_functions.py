"""Column functions on hand-made edge values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from retentia.functions import cleaning as cl, finance as fin, scoring as sc
from retentia.functions.calendar import boundaries_crossed
from retentia.functions.sql import register_functions


def values(spark, build, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(build.alias("v")).collect()]


def test_customer_ids(spark):
    rows = [(x,) for x in (None, "", "  ", "7", " 203 ", "C302", "C7", "CUST-1", "1234", "C12345", "void")]
    got = values(spark, cl.normalize_customer_id(F.col("x")), rows, "x string")
    assert got == [None, None, None, "CUST-007", "CUST-203", "CUST-302", "CUST-007", "CUST-1", "CUST-1234", "CUST-12345", "CUST-void"]
    assert values(spark, cl.normalize_customer_id(F.col("x"), 6), [("C12",)], "x string") == ["CUST-000012"]


def test_customer_key_is_strict(spark):
    assert values(spark, cl.customer_key(F.col("x")), [("CUST-012",)], "x string") == [12]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, cl.customer_key(F.col("x")), [("CUST-void",)], "x string")


def test_numbers_and_dates(spark):
    rows = [(x,) for x in ("12", "12.6", "-3.5", "n/a", "", None, "99999999999")]
    assert values(spark, cl.as_int(F.col("x")), rows, "x string") == [12, 13, -4, None, None, None, None]
    assert values(spark, cl.as_long(F.col("x")), rows, "x string")[-1] == 99999999999
    rows = [(x,) for x in ("2024-02-29", "2023-02-29", "2024", "void", "", None)]
    assert values(spark, cl.as_date(F.col("x")), rows, "x string") == [date(2024, 2, 29)] + [None] * 5
    rows = [(x,) for x in ("02/22/2024", "2/3/2024", "13/01/2024", "x", None)]
    assert values(spark, cl.as_us_date(F.col("x")), rows, "x string") == [date(2024, 2, 22), date(2024, 2, 3), None, None, None]
    rows = [(x,) for x in ("2024-01-31T23:30:00-05:00", "2024-03-01T00:00:00Z", "oops", None)]
    assert values(spark, cl.as_utc_date(F.col("x")), rows, "x string") == [date(2024, 2, 1), date(2024, 3, 1), None, None]


def test_labels_and_lists(spark):
    rows = [(x,) for x in ("apiGateway", "api_gateway", " Workflow-Builder ", "Other", None)]
    got = values(spark, cl.canonical_feature(F.col("x")), rows, "x string")
    assert got == ["api_gateway", "api_gateway", "workflow_builder", "other", None]
    rows = [(x,) for x in (None, "", "a", "a,b", "a,,b,")]
    assert values(spark, cl.feature_count(F.col("x")), rows, "x string") == [1, 1, 1, 2, 4]
    rows = [(x,) for x in ("-", " N/A ", "NA", "", "call back", None)]
    assert values(spark, cl.note_text(F.col("x")), rows, "x string") == [None, None, None, None, "call back", None]
    rows = [(x,) for x in ("Canada", "Ireland", "Malaysia", "Atlantis", None)]
    assert values(spark, cl.fixed_region(F.col("x")), rows, "x string") == ["NA", "EMEA", "APAC", None, None]
    rows = [(x,) for x in ("PLN-FREE", "PLN-ENT", "PLN-LEGACY", None)]
    assert values(spark, cl.plan_tier(F.col("x")), rows, "x string") == ["free", "enterprise", "legacy", "legacy"]
    rows = [(x,) for x in ("CUST-1", "cust_9", "c12", "C1a", "xyz")]
    assert values(spark, cl.id_format(F.col("x")), rows, "x string") == ["CUST-001", "cust_1234", "C001", "other: C1a", "other: xyz"]


def test_money(spark):
    assert values(spark, fin.round_half_up(F.col("x"), 2), [(0.285,), (-0.285,), (None,)], "x double") == [0.29, -0.29, None]
    rows = [(1, 4), (1, 0), (1, None), (None, 4)]
    assert values(spark, fin.safe_divide(F.col("a"), F.col("b")), rows, "a int, b int") == [0.25, None, None, None]
    assert values(spark, fin.safe_divide(F.col("a"), F.col("b"), F.lit(0.0)), rows, "a int, b int") == [0.25, 0.0, 0.0, None]
    rows = [(110, 100), (50, 0), (50, None), (2, 3)]
    assert values(spark, fin.pct_change(F.col("a"), F.col("b")), rows, "a int, b int") == [10.0, None, None, -33.3]
    nrr = fin.calc_nrr(F.lit(100), F.lit(20), F.lit(5), F.lit(10))
    assert values(spark, nrr, [(1,)], "x int") == [1.05]


def test_movement(spark):
    rows = [(5, None, None), (5, 3, "active"), (2, 3, "active"), (0, 0, "active"), (4, 4, "active"), (None, 4, "active"), (9, 3, "cancelled")]
    plain = fin.mrr_movement(F.col("c"), F.col("p"))
    assert values(spark, plain, rows, "c int, p int, s string") == [
        "new", "expansion", "contraction", "churn", "unchanged", "unchanged", "expansion"]
    with_status = fin.mrr_movement(F.col("c"), F.col("p"), F.col("s"))
    assert values(spark, with_status, rows, "c int, p int, s string")[-1] == "reactivation"


def test_scores_match_sql_functions(spark):
    register_functions(spark)
    df = spark.createDataFrame([(x,) for x in (None, 0.0, 30.0, 30.5, 45.0, 60.0, 75.0, 80.0, 81.0)], "score double")
    pairs = {
        "risk_tier": sc.risk_tier,
        "risk_tier_emoji": sc.risk_tier_emoji,
        "health_score_label": sc.health_score_label,
        "mrr_at_risk_pct": sc.mrr_at_risk_pct,
        "nullif_zero": sc.nullif_zero,
    }
    rows = df.select(
        *[f(F.col("score")).alias(n) for n, f in pairs.items()], *[F.expr(f"{n}(score)").alias(f"{n}_sql") for n in pairs]
    ).collect()
    for r in rows:
        for n in pairs:
            assert r[n] == r[f"{n}_sql"], n
    assert [r["health_score_label"] for r in rows][:2] == ["Unknown", "🔴 Critical"]
    assert [r["mrr_at_risk_pct"] for r in rows] == [0.0, 1.0, 1.0, 0.75, 0.75, 0.5, 0.25, 0.0, 0.0]
    one = spark.sql(
        "SELECT normalize_to_cust_id('C302') a, normalize_to_cust_id('7') b, normalize_to_cust_id(' ') c, clamp(140, 0, 100) d,"
        " safe_divide(1, 0) e, pct_change(110, 100) f, months_since(DATE'2023-11-30', DATE'2024-03-31') g, mrr_movement(5, 3) h"
    ).first()
    assert tuple(one) == ("CUST-302", "CUST-007", None, 100.0, None, 10.0, 4, "expansion")


def test_boundaries(spark):
    rows = [(date(2023, 11, 30), date(2024, 3, 31)), (date(2022, 11, 24), date(2024, 3, 31))]
    for unit, want in (("month", [4, 16]), ("quarter", [1, 5]), ("year", [1, 2])):
        assert values(spark, boundaries_crossed(F.col("a"), F.col("b"), unit), rows, "a date, b date") == want
