"""Partner referrals, which carry no customer id, matched to customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retentia.functions import cleaning as cl
from retentia.operators.similarity import name_key, similar_names


def match_referrals(referrals: DataFrame, customers: DataFrame, least: float = 0.8) -> DataFrame:
    """Every referral with its customer and how it was found: ``email``, ``company`` or NULL.

    An equal normalised e-mail address decides; otherwise the company whose name has the most similar trigrams, if the
    similarity is ``least`` or more. Ties go to the smallest customer id. Each different name is looked up once.
    ``customers`` is the staging table.
    """
    asked = referrals.withColumns(
        {"_email": cl.blank_to_null(F.lower("email")), "_name": name_key(F.col("company_name"))}
    )
    smallest = F.min("customer_id")
    by_email = customers.filter("email IS NOT NULL").groupBy(F.col("email").alias("_email")).agg(smallest.alias("_by_email"))
    found = asked.join(by_email, "_email", "left")

    names = customers.select("customer_id", name_key(F.col("company_name")).alias("key")).dropna()
    owners = names.groupBy("key").agg(smallest.alias("customer_id"))
    unmatched = found.filter(F.col("_by_email").isNull() & F.col("_name").isNotNull()).select(F.col("_name").alias("key")).distinct()
    pairs = similar_names(unmatched, owners.select("key"), least).join(owners.withColumnRenamed("key", "known"), "known")
    closest = pairs.groupBy(F.col("asked").alias("_name")).agg(
        F.min(F.struct((-F.col("similarity")).alias("distance"), "customer_id")).alias("_closest")
    )
    both = found.join(closest, "_name", "left")
    by_name = F.when(F.col("_by_email").isNull(), F.col("_closest.customer_id"))
    method = F.when(F.col("_by_email").isNotNull(), "email").when(by_name.isNotNull(), "company")
    return both.select(
        "referral_id", "email", "company_name", F.coalesce("_by_email", by_name).alias("customer_id"),
        method.alias("matched_by"), F.when(method == "company", -F.col("_closest.distance")).alias("similarity"),
    )


def unmatched_referrals(matched: DataFrame) -> DataFrame:
    """Referrals to be looked at by hand."""
    return matched.filter("matched_by IS NULL").select("referral_id", "email", "company_name")
