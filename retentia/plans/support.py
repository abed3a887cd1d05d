"""Support operations per month and region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retentia.functions.calendar import month_start
from retentia.functions.finance import exact_avg, round_half_up, safe_divide
from retentia.operators.totals import with_total


def _rounded_avg(c: Column, digits: int) -> Column:
    return round_half_up(exact_avg(c), digits)


def _resolution_rate(resolved: Column, total: Column) -> Column:
    return round_half_up(safe_divide(resolved, total, F.lit(0.0)) * 100, 1)


def support_by_region(tickets: DataFrame) -> DataFrame:
    category, solved, urgent = F.col("category"), F.col("is_resolved"), F.col("is_high_priority")
    hours = F.col("resolution_hours")
    dated = tickets.filter(F.col("created_date").isNotNull())
    return dated.groupBy(month_start(F.col("created_date")).alias("ticket_month"), "region").agg(
        F.count(F.lit(1)).alias("total_tickets"),
        F.count_if("is_open").alias("open_tickets"),
        F.count_if(solved).alias("resolved_tickets"),
        F.count_if(urgent).alias("high_priority_tickets"),
        F.count_if(category == "billing").alias("billing_tickets"),
        F.count_if(category == "technical").alias("technical_tickets"),
        F.count_if(category == "account").alias("account_tickets"),
        _rounded_avg(F.when(solved, hours), 1).alias("avg_resolution_hours"),
        _rounded_avg(F.when(urgent & solved, hours), 1).alias("avg_critical_resolution_hours"),
        _rounded_avg(F.col("satisfaction_score"), 2).alias("avg_satisfaction"),
        F.count_if(F.col("satisfaction_score") <= 2).alias("low_satisfaction_count"),
        F.count_distinct("customer_id").alias("unique_customers_with_tickets"),
    )


def mart_support_summary(tickets: DataFrame) -> DataFrame:
    """Volumes, resolution and satisfaction per month, by region and for ``ALL``.

    Averages of the total row are unweighted means of the rounded regional figures, and its customer
    count is the sum over regions.
    """
    detail = support_by_region(tickets)
    digits = {"avg_resolution_hours": 1, "avg_critical_resolution_hours": 1, "avg_satisfaction": 2}

    def measure(c: str) -> Column:
        return _rounded_avg(F.col(c).cast("decimal(28,2)"), digits[c]) if c in digits else F.sum(c)

    measures = {c: measure(c) for c in detail.columns if c not in ("ticket_month", "region")}
    measures["resolution_rate_pct"] = _resolution_rate(F.sum("resolved_tickets"), F.sum("total_tickets"))
    return with_total(detail, ["ticket_month"], "region", measures)
