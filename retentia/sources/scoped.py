"""Serving tables stored by region, so that who may see one region reads one region."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from retentia.sources.batches import folders

UNKNOWN, EVERY = "UNKNOWN", "ALL"


class RegionTable:
    """A table with a folder per region; rows without a region are stored under ``UNKNOWN``."""

    def __init__(self, spark: SparkSession, path: str, column: str = "region"):
        self.spark, self.path, self.column = spark, path.rstrip("/"), column

    def write(self, df: DataFrame) -> RegionTable:
        """Replace the table. Large regions are written by several tasks."""
        placed = df.withColumn(self.column, F.coalesce(F.col(self.column), F.lit(UNKNOWN)))
        out = placed.hint("rebalance", self.column).write.mode("overwrite").option("partitionOverwriteMode", "static")
        out.partitionBy(self.column).parquet(self.path)
        return self

    def regions(self) -> list[str]:
        """From the folder names; no file is read."""
        return sorted(unquote(f.partition("=")[2]) for f in folders(self.spark, self.path) if f.startswith(f"{self.column}="))

    def read(self, schema: StructType) -> DataFrame:
        """The table with the columns ``schema``; filters and joins on the region choose folders."""
        return self.spark.read.schema(schema).parquet(self.path).select(*schema.names)

    def granted(self, schema: StructType, grants: DataFrame, user: str) -> DataFrame:
        """Rows of the regions granted to ``user`` by a table of ``user`` and ``region``; a grant of ``ALL`` is one of each region.

        The grants are read when the query runs and prune the folders that it reads, so one that is added or
        withdrawn takes effect without a new plan. A user without a grant sees nothing. What is broadcast are the
        distinct regions granted to one user.
        """
        every: Column = F.array(*[F.lit(r) for r in self.regions()]).cast("array<string>")
        own = grants.filter(F.col("user") == F.lit(user)).select(F.col("region").alias("_given")).distinct()
        given = F.when(F.col("_given") == EVERY, every).otherwise(F.array("_given"))
        wanted = own.select(F.explode(given).alias(self.column)).distinct()
        table = self.read(schema)
        return table.join(F.broadcast(wanted), self.column, "left_semi").select(*table.columns)
