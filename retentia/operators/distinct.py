"""Exact distinct counts from bitmaps: counted once per group, added up over groups without the detail rows.

A key has a number that never changes (:class:`KeyNumbers`). The keys of a group are bitmaps over these numbers,
each for a run of 32,768 of them. A union of groups is an OR of bitmaps, so adding the same rows again changes
nothing and any coarser count reads bitmaps alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from retentia.sources.snapshots import Snapshots

RUN, NUMBER, BUCKET, BITMAP = "_run", "_number", "_bucket", "_bitmap"


class KeyNumbers:
    """A number for every key seen, as the pair of the run that brought it and its number within that run."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.snapshots = Snapshots(spark, path)

    def read(self, like: DataFrame) -> DataFrame | None:
        runs = self.snapshots.state().get("runs", [])
        if not runs:
            return None
        schema = like.select(F.col(self.key), F.lit(0).alias(RUN), F.lit(0).cast("long").alias(NUMBER)).schema
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{r}" for r in runs])

    def extend(self, rows: DataFrame) -> DataFrame:
        """All numbers, after keys of ``rows`` that had none got one; NULL is no key.

        Numbers are stored with the keys when given, so they stay whatever is run again later.
        """
        with self.snapshots.change() as state:
            known, keys = self.read(rows), rows.select(self.key).dropna().distinct()
            fresh = keys if known is None else keys.join(known, self.key, "left_anti")
            if known is None or not fresh.isEmpty():
                folder = self.snapshots.folder("numbers")
                numbered = fresh.select(self.key, F.lit(len(state.get("runs", []))).alias(RUN), F.monotonically_increasing_id().alias(NUMBER))
                numbered.write.parquet(f"{self.path}/{folder}")
                state.setdefault("runs", []).append(folder)
        return self.read(rows)


def key_bitmaps(rows: DataFrame, groups: Sequence[str], key: str, numbers: DataFrame) -> DataFrame:
    """The keys of each group as bitmaps of at most 4 kB. ``numbers`` covers all keys (:meth:`KeyNumbers.extend`).

    Repeated keys are folded map-side before they meet their number; a group's bitmaps are spread by bucket, and
    tasks combine their own bits before these are shuffled, so a group may hold any share of the keys.
    """
    once = rows.select(*groups, key).filter(F.col(key).isNotNull()).distinct().join(numbers, key)
    bucket = F.bitmap_bucket_number(NUMBER).alias(BUCKET)
    return once.groupBy(*groups, RUN, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(BITMAP))


def distinct_keys(bitmaps: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Exact number of distinct keys in ``name`` for any subset of the groups that the bitmaps were made for."""
    united = bitmaps.groupBy(*groups, RUN, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))
    found = F.coalesce(F.sum(F.bitmap_count(BITMAP)), F.lit(0)).alias(name)
    return united.groupBy(*groups).agg(found) if groups else united.agg(found)


def shared_keys(bitmaps: DataFrame, group: str, left, right) -> DataFrame:
    """Keys in one value of ``group`` alone, in the other alone, and in both (``gained``, ``lost``, ``kept`` of right after left)."""
    sides = [distinct_keys(bitmaps.filter(F.col(group).isin(*v)), [], f"n{i}") for i, v in enumerate(([left], [right], [left, right]))]
    one = sides[0].join(sides[1]).join(sides[2])  # three single rows
    return one.select((F.col("n2") - F.col("n0")).alias("gained"), (F.col("n2") - F.col("n1")).alias("lost"),
                      (F.col("n0") + F.col("n1") - F.col("n2")).alias("kept"))
