"""All queries: each operator over the test tables, paired with SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from verification.models import Models, models_for

Build = Callable[[Models], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register the decorated function as query ``name`` with its SQL counterpart."""

    def add(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(build, sql)
        return build

    return add


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with engines that report them so."""
    return df.select(
        *[F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f"`{f.name}`")
          for f in df.schema.fields]
    )


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_types(load_all()[name].build(models_for(spark, sf_dir)))


def load_all() -> dict[str, Query]:
    import verification.core_queries  # noqa: F401
    import verification.ingest_queries  # noqa: F401
    import verification.operator_queries  # noqa: F401
    import verification.report_queries  # noqa: F401
    import verification.stored_queries  # noqa: F401

    return REGISTRY
