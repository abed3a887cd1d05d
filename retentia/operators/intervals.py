"""Joins on validity intervals and on a month spine, without pairing all rows of a key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

# Days are grouped into aligned blocks of 1, 2, 4 .. 2**TOP_LEVEL days. A block is one number:
# its position among the blocks of its level, times LEVELS, plus the level.
TOP_LEVEL = 7
LEVELS = 16


def _covering_blocks(lo: Column, hi: Column, top: int) -> Column:
    """The fewest aligned blocks that cover days ``lo..hi`` exactly; NULL entries stand for no block.

    At each level below the top only a left edge with an odd position or a right edge with an even
    position is not covered by a block one level up: at most two blocks per level.
    """

    def first(k: int) -> Column:
        return -F.shiftright(-lo, k)

    def last(k: int) -> Column:
        return F.shiftright(hi + 1, k) - 1

    edges = []
    for k in range(top):
        l, h = first(k), last(k)
        left_edge = (l <= h) & (l.bitwiseAND(F.lit(1)) == 1)
        right_edge = (l <= h) & (h.bitwiseAND(F.lit(1)) == 0)
        edges += [F.when(left_edge, l * LEVELS + k), F.when(right_edge, h * LEVELS + k)]
    l, h = first(top), last(top)
    whole = F.when(l <= h, F.sequence(l * LEVELS + top, h * LEVELS + top, F.lit(LEVELS)))
    return F.concat(F.array(*edges), F.coalesce(whole, F.array().cast("array<int>")))


def _blocks_of_day(day: Column, top: int) -> Column:
    return F.array(*[F.shiftright(day, k) * LEVELS + k for k in range(top + 1)])


def valid_at_join(
    events: DataFrame,
    spans: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    rank: Sequence[str],
    carry: Sequence[str],
    days_of: DataFrame | None = None,
    top: int = TOP_LEVEL,
) -> DataFrame:
    """Left join of each event to the best span valid on its day: ``start <= at`` and (``end`` NULL or ``at <= end``).

    Among valid spans the one with the highest ``rank`` columns wins; its ``carry`` columns are added.
    The winner depends only on (key, day), so spans are cut into aligned day blocks (a handful per
    span), the best span per (key, block) is found by a map-side combined aggregation, and each distinct
    day looks up the ``top + 1`` blocks it lies in. Work grows with events + spans, never with their
    product, and a hot key is spread over its blocks.

    ``days_of`` is a cheaper relation with the same (key, day) pairs, such as the events before
    deduplication; default the events themselves.
    """
    asked = (events if days_of is None else days_of).select(key, F.col(at).alias("_at"))
    days = asked.filter(F.col(key).isNotNull() & F.col("_at").isNotNull()).distinct()
    # Spans are clipped to the days that occur, so open ends stay short.
    # The count keeps the optimizer from dropping the distinct, so that the shuffle of the days is reused.
    day = F.unix_date("_at")
    ends = F.struct(F.min(day).alias("first"), F.max(day).alias("last"), F.count(F.lit(1)).alias("n"))
    reach = days.agg(ends).scalar()
    first_day, last_day = reach["first"], reach["last"]
    clipped = (
        spans.filter(F.col(key).isNotNull() & F.col(start).isNotNull())
        .withColumn("_lo", F.greatest(F.unix_date(F.col(start)), first_day))
        .withColumn("_hi", F.least(F.unix_date(F.col(end)), last_day))
        .filter("_lo <= _hi")
    )
    winner = F.struct(*rank, *[c for c in carry if c not in rank])
    best = (
        clipped.select(key, winner.alias("_w"), F.explode(_covering_blocks(F.col("_lo"), F.col("_hi"), top)).alias("_block"))
        .filter("_block IS NOT NULL")
        .groupBy(key, "_block")
        .agg(F.max("_w").alias("_w"))
    )
    looked_up = (
        days.select(key, "_at", F.explode(_blocks_of_day(F.unix_date("_at"), top)).alias("_block"))
        .join(best, [key, "_block"])
        .groupBy(key, "_at")
        .agg(F.max("_w").alias("_w"))
        .select(F.col(key).alias("_k"), "_at", *[F.col(f"_w.{c}").alias(c) for c in carry])
    )
    keep = list(events.columns)
    return events.join(
        looked_up, (events[key] == looked_up["_k"]) & (events[at] == looked_up["_at"]), "left"
    ).select(*[events[c] for c in keep], *[looked_up[c] for c in carry])


def month_literals(months: Sequence[date]) -> Column:
    return F.array(*[F.lit(m) for m in months])


def overlapping_months(start: Column, end: Column, months: Sequence[date]) -> Column:
    """The months an interval touches: it starts by the month's last day and ends after its first."""
    return F.filter(month_literals(months), lambda m: (start <= F.last_day(m)) & (end.isNull() | (end > m)))


def month_spine(df: DataFrame, start: str, end: str, months: Sequence[date], name: str = "mrr_month") -> DataFrame:
    """One row per interval and month it overlaps; a narrow ``explode``, no join and no shuffle."""
    return df.withColumn(name, F.explode(overlapping_months(F.col(start), F.col(end), months)))


def month_skeleton(df: DataFrame, key: str, months: Sequence[date], name: str = "mrr_month") -> DataFrame:
    """Every key with every month of the window."""
    return df.select(key, F.explode(month_literals(months)).alias(name))


def most_at_once(spans: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Per key: the highest number of spans that run on one day; both ends count, a NULL end stays open.

    Spans without a key or start, or that end before they start, run on no day. Starts and ends are added up per (key, day), combined
    map-side, so the running total of a hot key has one row per calendar day and no two spans are paired.
    """
    opened = F.struct(F.unix_date(F.col(start)).alias("day"), F.lit(1).alias("change"))
    closed = F.struct((F.unix_date(F.col(end)) + 1).alias("day"), F.lit(-1).alias("change"))
    valid = spans.filter(
        F.col(key).isNotNull() & F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start)))
    )
    edges = F.array_compact(F.array(opened, F.when(F.col(end).isNotNull(), closed)))
    daily = valid.select(key, F.inline(edges)).groupBy(key, "day").agg(F.sum("change").alias("change"))
    running = F.sum("change").over(Window.partitionBy(key).orderBy("day"))
    return daily.select(key, running.alias("_n")).groupBy(key).agg(F.max("_n").alias("most_at_once"))


def window_totals(
    points: DataFrame, facts: DataFrame, key: str, at: str, windows: dict[str, tuple[int, int]], sums: Sequence[str]
) -> DataFrame:
    """Totals of ``facts`` in day windows around each distinct (key, day) of ``points``.

    Facts are first summed per (key, day), so the frame of a hot key holds one row per calendar day
    and no point is paired with single facts. Column names are ``<window>_<sum>``.
    """
    zero = [F.lit(0).cast(facts.schema[c].dataType).alias(c) for c in sums]
    asked = points.select(key, at, *zero, F.lit(True).alias("_asked"))
    daily = (
        facts.groupBy(key, at)
        .agg(*[F.sum(c).cast(facts.schema[c].dataType).alias(c) for c in sums])
        .withColumn("_asked", F.lit(False))
        .unionByName(asked)
        .filter(F.col(key).isNotNull() & F.col(at).isNotNull())
        .groupBy(key, at)
        .agg(*[F.sum(c).alias(c) for c in sums], F.max("_asked").alias("_asked"))
    )
    frame = Window.partitionBy(key).orderBy(F.unix_date(F.col(at)))
    totals = [
        F.coalesce(F.sum(c).over(frame.rangeBetween(lo, hi)), F.lit(0)).alias(f"{w}_{c}")
        for w, (lo, hi) in windows.items()
        for c in sums
    ]
    return daily.select(key, at, "_asked", *totals).filter("_asked").drop("_asked")
