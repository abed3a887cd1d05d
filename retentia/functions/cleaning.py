"""Normalisers for raw text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spellings of one product feature that the raw exports mix.
FEATURE_SPELLINGS = {
    "apigateway": "api_gateway",
    "workflow-builder": "workflow_builder",
}

# Note texts that mean "no note".
NOTE_SENTINELS = ["-", "N/A", "n/a", "NA", ""]

# Sales region of each country the company sells in.
REGION_COUNTRIES = {
    "NA": ["United States", "Canada", "Mexico"],
    "EMEA": [
        "United Kingdom", "Germany", "France", "Spain", "Netherlands", "Sweden", "Italy", "Belgium",
        "Switzerland", "Norway", "Denmark", "Finland", "Poland", "Portugal", "Austria", "Ireland",
    ],
    "APAC": [
        "Japan", "Australia", "India", "Singapore", "Hong Kong", "South Korea", "China", "New Zealand",
        "Thailand", "Indonesia", "Malaysia", "Philippines",
    ],
}

# Commercial tier of each plan; other plans count as legacy.
PLAN_TIERS = {
    "PLN-FREE": "free",
    "PLN-START": "starter",
    "PLN-PRO": "professional",
    "PLN-BIZ": "business",
    "PLN-ENT": "enterprise",
}

# Commitment order of billing cycles; other cycles rank 0.
CYCLE_RANKS = {"monthly": 1, "quarterly": 2, "annual": 3}
CYCLE_MONTHS = {"monthly": 1, "quarterly": 3, "annual": 12}


def _lookup(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def lookup(values: dict, key: Column) -> Column:
    """The value of a small fixed mapping, NULL for other keys."""
    return F.try_element_at(_lookup(values), F.coalesce(key, F.lit("")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def label(c: Column) -> Column:
    """Lower-case trimmed label; a blank label stays an empty string."""
    return F.lower(F.trim(c))


def normalize_customer_id(raw: Column, width: int = 3) -> Column:
    """``7`` / ``C302`` / ``CUST-203`` -> ``CUST-007`` / ``CUST-302`` / ``CUST-203``.

    Digits are padded to ``width`` but never cut, so ids that outgrow the width stay distinct.
    """
    text = blank_to_null(raw)
    digits = F.when(text.startswith("C"), F.substring(text, 2, 2_000_000_000)).otherwise(text)
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.when(text.startswith("CUST-"), text).otherwise(F.concat(F.lit("CUST-"), padded))


def customer_key(customer_id: Column) -> Column:
    """Numeric part of a normalised id; an id without one, or with one beyond 2,147,483,647, is an error."""
    return F.replace(customer_id, F.lit("CUST-"), F.lit("")).cast("int")


def canonical_feature(raw: Column) -> Column:
    name = label(raw)
    return F.coalesce(lookup(FEATURE_SPELLINGS, name), name)


def note_text(raw: Column) -> Column:
    text = F.trim(raw)
    return F.when(~text.isin(NOTE_SENTINELS), text)


def fixed_region(country: Column) -> Column:
    flat = {c: region for region, countries in REGION_COUNTRIES.items() for c in countries}
    return lookup(flat, country)


def plan_tier(plan_id: Column) -> Column:
    return F.coalesce(lookup(PLAN_TIERS, plan_id), F.lit("legacy"))


def feature_count(features: Column) -> Column:
    """Entries of a comma list; an empty or missing list still counts one entry."""
    return F.size(F.split(F.coalesce(features, F.lit("")), ",", -1))


def cycle_rank(billing_cycle: Column) -> Column:
    return F.coalesce(lookup(CYCLE_RANKS, billing_cycle), F.lit(0))


def revenue_impact(adjustment_type: Column, amount: Column) -> Column:
    """Signed effect of an adjustment on revenue: relief and write-offs reduce it."""
    return F.when(adjustment_type.isin("credit", "refund", "write_off"), -amount).otherwise(amount)


def as_int(raw: Column) -> Column:
    """Number text to INT, rounding fractions; NULL when it is no number or does not fit."""
    return _whole_number(raw, "int")


def as_long(raw: Column) -> Column:
    return _whole_number(raw, "bigint")


def _whole_number(raw: Column, kind: str) -> Column:
    """Plain integers take the direct cast, other numbers the detour over decimals."""
    return F.coalesce(raw.try_cast(kind), F.round(raw.try_cast("decimal(38,6)")).try_cast(kind))


def _has_day(raw: Column) -> Column:
    """Two dashes at least: a year or a month alone is not taken for its first day."""
    return F.substring_index(raw, "-", 2) != raw


def as_date(raw: Column) -> Column:
    """ISO date text to DATE; text that does not start with a full date gives NULL.

    What follows the date after a blank or a ``T`` is not looked at, and slashes are no date.
    """
    return F.when(_has_day(raw), raw.try_cast("date"))


def as_us_date(raw: Column) -> Column:
    """``MM/DD/YYYY`` text to DATE."""
    return F.try_to_date(F.trim(raw), "M/d/yyyy")


def as_utc_date(raw: Column) -> Column:
    """ISO timestamp text with an offset to the UTC calendar day (needs a UTC session)."""
    return F.to_date(F.when(_has_day(raw), raw.try_cast("timestamp")))


def id_format(customer_id: Column, shown: int = 10) -> Column:
    """Class of a customer id as it is written in an export.

    Ids in no known format are classed by their first ``shown`` characters, so as many classes can
    arise as there are such beginnings; 0 puts all of them into one class.
    """
    return (
        F.when(F.upper(customer_id).startswith("CUST-"), "CUST-001")
        .when(F.lower(customer_id).startswith("cust_"), "cust_1234")
        .when(customer_id.rlike(r"^[cC]\d+$"), "C001")
        .otherwise(F.concat(F.lit("other: "), F.substring(customer_id, 1, shown)))
    )
