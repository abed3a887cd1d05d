"""Tables stored by bucket of their join key, so that later joins on it move no row of either side."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from retentia.session import scratch_dir
from retentia.sources.snapshots import Snapshots
from retentia.sources.store import materialise

# Slots that rows are counted in to find hot keys; a task sends at most one row per slot.
SLOTS = 1 << 16


class BucketedTables:
    """Tables below one folder, all cut into the same number of buckets by a hash of their key and sorted by it.

    Keys with over ``hot`` rows, and rows without a key, would fill one bucket: they lie apart as plain files,
    and joins on them are shuffled as usual, where adaptive execution splits them. A bucket is a task, so
    ``buckets`` is chosen for the largest table and is fixed when the folder is first written.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, hot: int = 1_000_000):
        self.spark, self.path, self.hot = spark, path.rstrip("/"), hot
        self.snapshots = Snapshots(spark, path)
        with self.snapshots.change() as state:
            self.buckets = state.setdefault("buckets", buckets)

    def _entry(self, name: str) -> dict:
        return self.snapshots.state()["tables"][name]

    def _table(self, entry: dict, fields: StructType) -> DataFrame:
        """The bucketed files, registered in the session's catalog, which is where Spark looks for bucketing."""
        known = "retentia_" + entry["folder"].rpartition("/")[2]
        if not self.spark.catalog.tableExists(known):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.fields)
            self.spark.sql(
                f"CREATE TABLE {known} ({columns}) USING parquet CLUSTERED BY (`{entry['key']}`) SORTED BY (`{entry['key']}`)"
                f" INTO {self.buckets} BUCKETS LOCATION '{self.path}/{entry['folder']}'"
            )
        return self.spark.table(known)

    def _fields(self, entry: dict) -> StructType:
        return StructType.fromJson(json.loads(entry["schema"]))

    def _often(self, rows: DataFrame, key: str) -> DataFrame:
        """Keys with over ``hot`` rows. Rows are first counted by slot, a hash of the key: only keys of slots with
        over ``hot`` rows can be hot and are counted themselves, so that single keys are not shuffled."""
        slot = F.pmod(F.xxhash64(F.col(key)), F.lit(SLOTS))
        keys = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("_hot"), slot.alias("_slot"))
        full = keys.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > self.hot).select("_slot")
        counts = keys.join(F.broadcast(full), "_slot", "left_semi").groupBy("_hot").agg(F.count(F.lit(1)).alias("_n"))
        return counts.filter(F.col("_n") > self.hot).select("_hot")

    def write(self, name: str, df: DataFrame, key: str) -> None:
        """Replace a table; readers of the former one keep it. ``df`` is computed once, into a scratch table."""
        df = materialise(df, scratch_dir(self.spark, f"bucketed-{name}"))
        often = materialise(self._often(df, key), scratch_dir(self.spark, f"hot-{name}"))
        known = F.col(key).isNotNull()
        folder, apart, made = self.snapshots.folder(name), self.snapshots.folder(name), f"retentia_{uuid.uuid4().hex}"
        same = F.col(key) == F.col("_hot")
        cold = df.filter(known).join(often, same, "left_anti")
        writer = cold.repartition(self.buckets, key).write.format("parquet").bucketBy(self.buckets, key).sortBy(key)
        writer.option("path", f"{self.path}/{folder}").saveAsTable(made)
        self.spark.sql(f"DROP TABLE {made}")  # the files stay
        df.filter(~known).unionByName(df.filter(known).join(often, same, "left_semi")).write.parquet(f"{self.path}/{apart}")
        with self.snapshots.change() as state:
            state.setdefault("tables", {})[name] = {"folder": folder, "apart": apart, "key": key, "schema": df.schema.json()}

    def bucketed(self, name: str) -> DataFrame:
        """The rows in buckets: all but those of hot keys or without a key."""
        entry = self._entry(name)
        return self._table(entry, self._fields(entry))

    def apart(self, name: str) -> DataFrame:
        entry = self._entry(name)
        return self.spark.read.schema(self._fields(entry)).parquet(f"{self.path}/{entry['apart']}")

    def read(self, name: str) -> DataFrame:
        return self.bucketed(name).unionByName(self.apart(name))

    def left_join(self, left: str, right: str, columns: dict[str, str]) -> DataFrame:
        """``left`` with ``columns`` (name in ``right`` -> new name) of the row of ``right``, whose key is unique.

        Buckets of both tables are merged where they lie, without a shuffle. Only rows that lie
        apart on the left are joined over the network. A unique key is never hot, so on the right nothing lies
        apart but rows without a key, which match none.
        """
        key, other = self._entry(left)["key"], self._entry(right)["key"]
        own: list[Column] = [F.col(f"`{c}`").alias(a) for c, a in columns.items()]
        side = self.bucketed(right).select(F.col(f"`{other}`").alias("_k"), *own)

        def joined(rows: DataFrame, hint: str | None = None) -> DataFrame:
            return rows.join(side.hint(hint) if hint else side, rows[key] == side["_k"], "left").drop("_k")

        return joined(self.bucketed(left), "merge").unionByName(joined(self.apart(left)))

    def clean(self, keep: int = 1) -> int:
        """Remove folders that none of the last ``keep`` snapshots names; not while a write runs."""
        return self.snapshots.clean(list(self.snapshots.state().get("tables", {})), keep)
