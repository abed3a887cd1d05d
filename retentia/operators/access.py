"""Row scoping by role, and the filters users put on result tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Scope:
    """Who is asking: a regional manager sees one region, every other role sees all."""

    role: str = "admin"
    region: str | None = None

    @property
    def restricted(self) -> bool:
        return self.role == "regional_manager"


def row_scope(df: DataFrame, scope: Scope, column: str = "region") -> DataFrame:
    """Rows the scope may see. The region is bound as a literal, so the predicate reaches the scan."""
    return df.filter(F.col(column) == F.lit(scope.region)) if scope.restricted else df


def summary_scope(df: DataFrame, scope: Scope, column: str = "region", total: str = "ALL") -> DataFrame:
    """On a table that carries total rows: the manager's region, or the total."""
    return df.filter(F.col(column) == F.lit(scope.region if scope.restricted else total))


def one_of(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with one of the chosen values; no choice means no filter."""
    return df.filter(F.col(column).isin(list(values))) if values else df


def only_true(df: DataFrame, column: str, wanted: bool = True) -> DataFrame:
    return df.filter(F.coalesce(F.col(column), F.lit(False))) if wanted else df


def date_between(df: DataFrame, column: str, start, end) -> DataFrame:
    return df.filter(F.col(column).between(F.lit(start), F.lit(end)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct().orderBy(F.col(column).asc_nulls_last())


def ordered(*specs: str) -> list[Column]:
    """Sort columns from names; a leading ``-`` sorts descending; NULLs always come last."""
    return [
        F.col(s[1:]).desc_nulls_last() if s.startswith("-") else F.col(s).asc_nulls_last() for s in specs
    ]
