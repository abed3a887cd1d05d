"""Pick one version of a row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str, ties: Sequence[str] = ()) -> DataFrame:
    """One row per key: the highest ``version``, then the highest ``ties``; NULLs lose.

    Only keys, version and ties are sorted on, so columns a caller does not use are still pruned at
    the scan. ``row_number = 1`` is pruned per map task before the shuffle, so many copies of one key
    never meet in one task.
    """
    ordered = [version, *[c for c in ties if c in df.columns]]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ordered])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_and_latest(df: DataFrame, key: str, version: str, first: Sequence[str]) -> DataFrame:
    """One row per non-NULL key: columns ``first`` from the lowest version, the others from the highest.

    Ties take the highest (lowest) remaining values. All columns are sorted on, so select the wanted ones
    before calling.

    The last version is a window pick, cut per map task before the shuffle, so whole rows with long texts
    are never held by an aggregation; of the first version only ``first`` is aggregated. Both are partitioned
    by the key, so the join between them shuffles nothing more.
    """
    rest = [c for c in df.columns if c != key and c not in first and c != version]
    known = df.filter(F.col(key).isNotNull())
    newest = latest_per_key(known.select(key, *rest, version), [key], version, rest)
    if not first:
        return newest
    late_version = F.coalesce(F.col(version), F.lit(2147483647))
    oldest = known.groupBy(F.col(key).alias("_key")).agg(F.min(F.struct(late_version.alias("_v"), *first)).alias("_old"))
    joined = newest.join(oldest, F.col(key) == F.col("_key"))
    return joined.select(key, *[F.col(f"_old.{c}") for c in first], *rest, version)


def previous_row(
    df: DataFrame, key: str, bucket: str, order: Sequence[str], values: Sequence[str], prefix: str = "prev_"
) -> DataFrame:
    """``lag`` of ``values`` per ``key`` that never puts a whole key into one task.

    ``bucket`` is the leading order column (a date). Rows are ordered only within (key, bucket); the
    last row of each bucket is handed to the next bucket of the key through a table with one row per
    (key, bucket), which is bounded by the calendar however hot the key is.
    """
    asc = [F.col(c).asc_nulls_last() for c in order]
    within = Window.partitionBy(key, bucket).orderBy(*asc)
    across = Window.partitionBy(key).orderBy(F.col(bucket).asc_nulls_last())

    payload = F.struct(*values)
    rows = df.withColumn("_inside", F.lag(payload).over(within))
    carried = (
        df.groupBy(key, bucket)
        .agg(F.max_by(payload, F.struct(*order)).alias("_last"))
        .select(
            F.col(key).alias("_k"), F.col(bucket).alias("_b"), F.lag("_last").over(across).alias("_carried")
        )
    )
    joined = rows.join(
        carried, rows[key].eqNullSafe(carried["_k"]) & rows[bucket].eqNullSafe(carried["_b"]), "left"
    )
    before = F.coalesce("_inside", "_carried")
    return joined.select(*df.columns, *[before[v].alias(prefix + v) for v in values])

