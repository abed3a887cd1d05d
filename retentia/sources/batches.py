"""Batch CSV exports: ``<root>/<batch name>/<table>.csv``, one folder per delivery."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

# Tables delivered as full snapshots, with their keys.
DIMENSIONS = {"customers": "customer_id", "plans": "plan_id", "subscriptions": "subscription_id"}

# Tables delivered as increments, with their keys.
FACTS = {
    "invoices": "invoice_id",
    "payments": "payment_id",
    "usage_events": "event_id",
    "support_tickets": "ticket_id",
    "product_events": "event_id",
    "adjustments": "adjustment_id",
    "contract_amendments": "amendment_id",
    "late_usage_jan": "event_id",
}
CORRECTIONS = "corrections"
BATCH = "_batch_id"

# The largest tables hold ids, dates, amounts and labels only: no value has a line break, so files can be split.
SINGLE_LINE = {"invoices", "payments", "usage_events", "late_usage_jan"}

# Texts read as NULL; add "NA" and the like only where they cannot be real values (a region can).
NULL_TOKENS = ("",)


@dataclass(frozen=True)
class Batch:
    name: str
    batch_id: int


# The delivery folders and their numbers.
BATCHES = (Batch("batch_001", 1), Batch("batch_002", 2), Batch("batch_003", 3))


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    return [s.getPath().getName() for s in listed if s.isDirectory()]


def delivered(spark: SparkSession, root: str) -> list[Batch]:
    """The deliveries that a root folder holds, in order."""
    found = [re.fullmatch(r"batch_0*(\d+)", name) for name in folders(spark, root)]
    return sorted((Batch(m[0], int(m[1])) for m in found if m), key=lambda b: b.batch_id)


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def read_csv(
    spark: SparkSession, path: str, null_tokens: Sequence[str] = NULL_TOKENS, multi_line: bool = True
) -> DataFrame | None:
    """A headered CSV as text columns, names lower-cased and stripped; None where the file is missing.

    The header names the columns, so a new column in a later delivery is picked up; no type inference
    pass reads the data, typing is left to staging. With ``multi_line``, values may hold line breaks and
    a file is read by one task; without, large files are split.
    """
    if not path_exists(spark, path):
        return None
    raw = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path)
    df = clean_names(raw)
    return df.select(*[F.when(~F.col(c).isin(list(null_tokens)), F.col(c)).alias(c) for c in df.columns])


def read_dim_batch(
    spark: SparkSession, root: str, batch: Batch, table: str, null_tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame | None:
    return read_csv(spark, f"{root}/{batch.name}/{table}.csv", null_tokens)


def read_fact_batch(
    spark: SparkSession, root: str, batch: Batch, table: str, null_tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame | None:
    df = read_csv(spark, f"{root}/{batch.name}/{table}.csv", null_tokens, table not in SINGLE_LINE)
    return None if df is None else df.withColumn(BATCH, F.lit(str(batch.batch_id)))


