"""Keys per batch, kept as sets: a new batch is compared with the one before it, earlier ones are not read."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from retentia.sources.snapshots import Snapshots

DRIFT = "batch_id int, keys long, new_keys long, dropped_keys long"


class KeySets:
    """The distinct keys of each batch of one table, below one folder, and how they differ from batch to batch."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.snapshots = Snapshots(spark, path)

    def _batches(self) -> dict[int, dict]:
        return {int(b): e for b, e in self.snapshots.state().get("batches", {}).items()}

    def _before(self, batch: int) -> int | None:
        return max((b for b in self._batches() if b < batch), default=None)

    def keys(self, batch: int) -> DataFrame:
        """One row per key that the batch holds."""
        entry = self._batches()[batch]
        return self.spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).parquet(f"{self.path}/{entry['folder']}")

    def _sides(self, batch: int) -> DataFrame:
        """Keys of a batch and of the one before it, with ``here`` and ``before``; sets are small against their batches."""
        rows, before = self.keys(batch).withColumn("_here", F.lit(True)), self._before(batch)
        if before is not None:
            rows = rows.unionByName(self.keys(before).withColumn("_here", F.lit(False)))
        return rows.groupBy(self.key).agg(F.bool_or("_here").alias("here"), F.bool_or(~F.col("_here")).alias("before"))

    def put(self, batch: int, rows: DataFrame) -> None:
        """Store a batch's keys (again) and compare it with the batch before; a batch behind it is compared again.

        NULL is no key. Other batches' rows and keys are not read.
        """
        with self.snapshots.change() as state:
            folder = self.snapshots.folder("keys")
            own = rows.select(self.key).dropna().distinct()
            own.write.parquet(f"{self.path}/{folder}")
            known = state.setdefault("batches", {})
            known[str(batch)] = {"folder": folder, "schema": own.schema.json()}
            after = min((b for b in self._batches() if b > batch), default=None)
            for b in [x for x in (batch, after) if x is not None]:
                known[str(b)]["drift"] = self._compare(b)

    def _compare(self, batch: int) -> list[int | None]:
        def both(c: Column) -> Column:
            return F.count_if(F.coalesce(c, F.lit(False)))

        here, before = F.col("here"), F.col("before")
        n = self._sides(batch).agg(both(here), both(here & ~before), both(before & ~here)).first()
        return [n[0], None, None] if self._before(batch) is None else list(n)

    def drift(self) -> DataFrame:
        """Keys per batch, new against the batch before and dropped since it, as compared when the batch was stored."""
        return self.spark.createDataFrame([(b, *e["drift"]) for b, e in sorted(self._batches().items())], DRIFT)

    def new(self, batch: int) -> DataFrame:
        """Keys that the batch before does not have; all of the first batch."""
        return self._sides(batch).filter("here AND NOT before").select(self.key)

    def dropped(self, batch: int) -> DataFrame:
        """Keys of the batch before that this one does not have."""
        return self._sides(batch).filter("before AND NOT here").select(self.key)

    def clean(self, keep: int = 1) -> int:
        """Remove sets that none of the last ``keep`` snapshots names; not while a batch is stored."""
        return self.snapshots.clean(["keys"], keep)
