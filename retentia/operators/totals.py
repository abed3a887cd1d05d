"""Group totals next to detail rows, and exact medians."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


def with_total(
    detail: DataFrame, keys: Sequence[str], part: str, measures: Mapping[str, Column], total: str = "ALL"
) -> DataFrame:
    """Detail rows plus one ``total`` row per ``keys``, computed from the detail rows in one pass.

    ``measures`` are aggregates over the detail rows that return a single row's value unchanged
    (sums, averages of averages), so each detail row is simply sent to its own group and the total's.
    """
    both = F.array(
        F.struct(F.lit(False).alias("is_total"), F.col(part).alias("part")),
        F.struct(F.lit(True).alias("is_total"), F.lit(total).alias("part")),
    )
    return (
        detail.withColumn("_to", F.explode(both))
        .groupBy(*keys, "_to.is_total", "_to.part")
        .agg(*[m.alias(n) for n, m in measures.items()])
        .withColumnRenamed("part", part)
        .drop("is_total")
    )


@dataclass
class _Search:
    """The value of ``rank`` (from 0) among the ``size`` values of ``column`` that are ``inside``."""

    column: str
    inside: Column
    rank: int
    size: int
    value: object = None

    def cuts(self, accuracy: int) -> Column:
        """Estimates of the wanted value, with one that should lie below it and one above."""
        middle, slack = (self.rank + 0.5) / self.size, 5 / accuracy
        quantiles = [max(0.0, middle - slack), middle, min(1.0, middle + slack)]
        return F.percentile_approx(F.when(self.inside, F.col(self.column)), quantiles, F.lit(accuracy))

    def counts(self, cuts: Sequence) -> Column:
        c, (low, middle, high) = F.col(self.column), [F.lit(x) for x in cuts]
        return F.array(*[F.count_if(self.inside & test) for test in (c < low, c < middle, c <= middle, c <= high)])

    def narrow(self, cuts: Sequence, counts: Sequence[int]) -> None:
        """Keep the part between two cuts that holds the rank; the middle cut itself ends the search."""
        c, (low, middle, high) = F.col(self.column), [F.lit(x) for x in cuts]
        edges = [0, *counts, self.size]
        tests = [c < low, (c >= low) & (c < middle), c == middle, (c > middle) & (c <= high), c > high]
        part = next(i for i in range(5) if edges[i] <= self.rank < edges[i + 1])
        if part == 2:
            self.value = cuts[1]
        self.inside, self.rank, self.size = self.inside & tests[part], self.rank - edges[part], edges[part + 1] - edges[part]


def exact_medians(df: DataFrame, columns: Sequence[str], accuracy: int = 100_000) -> dict[str, float | None]:
    """Exact medians of numeric columns (mean of the middle two for an even count), as driver-side numbers.

    Each round is two aggregations that return one row: quantile sketches of bounded size propose cuts
    around the middle ranks, and exact counts tell which part between the cuts holds them. A round leaves
    about ten values in ``accuracy`` and drops the middle cut at least, so the search ends whatever the
    sketch says, after three rounds on 10^12 values. Nothing is sorted or gathered, however many values
    are different. ``df`` is read in every round: pass a stored table.
    """
    sizes = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count(c).alias(c) for c in columns]).first()
    middles = {c: sorted({(sizes[c] - 1) // 2, sizes[c] // 2}) for c in columns if sizes[c]}
    searches = [_Search(c, F.col(c).isNotNull(), rank, sizes[c]) for c, ranks in middles.items() for rank in ranks]
    while going := [s for s in searches if s.value is None]:
        cuts = df.agg(*[s.cuts(accuracy).alias(f"_{i}") for i, s in enumerate(going)]).first()
        counts = df.agg(*[s.counts(cuts[i]).alias(f"_{i}") for i, s in enumerate(going)]).first()
        for i, s in enumerate(going):
            s.narrow(cuts[i], counts[i])

    def median(c: str) -> float:
        values = [float(s.value) for s in searches if s.column == c]
        return (values[0] + values[-1]) / 2

    return {c: median(c) if c in middles else None for c in columns}
