"""Stored layers that are rebuilt only where their inputs have changed.

Rows are stored by bucket, a hash of their key (the customer). A model is computed bucket by bucket: the rows
of a customer depend on that customer's input rows alone. Each bucket of a model records the input folders
it was built from, so a build reads and replaces only the buckets where one of these is another.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.types import StructField, StructType

from retentia.params import Params
from retentia.plans import revenue
from retentia.sources.batches import path_exists
from retentia.sources.snapshots import Snapshots

BUCKET = "_bucket"


def _columns(df: DataFrame) -> str:
    """Names and types; whether a column can be NULL is left open."""
    return StructType([StructField(f.name, f.dataType) for f in df.schema.fields]).json()


# Types that a hash tells apart as they are; floats (0 and -0) and nested values are spelled out for it.
HASHED = (T.BooleanType, T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def _hashed(df: DataFrame) -> list[Column]:
    """What a hash of a whole row reads. A hash passes over NULLs, so which columns are NULL comes first."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    missing = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])

    def value(c: Column, kind: T.DataType) -> Column:
        plain = isinstance(kind, HASHED) or kind == T.StringType()
        return c if plain else F.to_json(F.struct(c), {"ignoreNullFields": "false"})

    return [missing, *[value(c, f.dataType) for c, f in zip(columns, df.schema.fields)]]


class Layers:
    """Input tables and models below one folder, committed together by a manifest.

    The number of buckets is fixed when the layers are first written; it bounds the manifest and is chosen
    so that a bucket is some files large, as the unit that is rewritten.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, key: str = "customer_id"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.snapshots = Snapshots(spark, path)
        with self.snapshots.change() as state:
            self.buckets = state.setdefault("buckets", buckets)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def _table(self, name: str) -> dict:
        return self.snapshots.state().get("tables", {}).get(name, {})

    def _folders(self, name: str, bucket: int) -> list[list]:
        """[part, folder] of all parts that have rows in a bucket."""
        parts = self._table(name).get("parts", {})
        return [[p, own[str(bucket)]["folder"]] for p, own in sorted(parts.items()) if str(bucket) in own]

    def read(self, name: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """A table, or some buckets of it: only their folders are listed and read."""
        fields = StructType.fromJson(json.loads(self._table(name)["schema"]))
        wanted = range(self.buckets) if buckets is None else buckets
        found = [f"{self.path}/{folder}" for b in wanted for _, folder in self._folders(name, b)]
        return self.spark.read.schema(fields).parquet(*found) if found else self.spark.createDataFrame([], fields)

    def _write(self, name: str, rows: DataFrame) -> str:
        """Rows with their bucket, written to a folder per bucket; large buckets by several tasks."""
        folder = self.snapshots.folder(f"layer/{name}")
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        return folder

    def put(self, name: str, rows: DataFrame, part: str = "all") -> list[int]:
        """Make ``rows`` the part ``part`` (a batch, or all) of an input; returns the buckets that have changed.

        A count and two hash sums per bucket tell which buckets hold other rows than before; only these are
        written. Repeating a load therefore changes nothing. ``rows`` are read twice: store first what is
        costly to compute.
        """
        placed = rows.withColumn(BUCKET, self.bucket())
        row = _hashed(rows)
        sums = [F.sum(F.xxhash64(*x).cast("decimal(38,0)")).cast("string") for x in (row, [F.lit(2), *row])]
        prints = placed.groupBy(BUCKET).agg(F.concat_ws(":", F.count(F.lit(1)), *sums).alias("print")).collect()  # one per bucket
        found = {str(r[BUCKET]): r["print"] for r in prints}
        with self.snapshots.change() as state:
            table = state.setdefault("tables", {}).setdefault(name, {"parts": {}})
            known = table["parts"].get(part, {})
            schema = _columns(rows)
            same_columns = table.get("schema") == schema
            if not same_columns and set(table["parts"]) - {part}:
                raise ValueError(f"{name}: the columns of {part} differ from those of the other parts")
            changed = sorted(int(b) for b in found if not same_columns or known.get(b, {}).get("print") != found[b])
            gone = sorted(int(b) for b in known if b not in found)
            kept = {b: x for b, x in known.items() if b in found and int(b) not in changed}
            if changed:
                folder = self._write(name, placed.filter(F.col(BUCKET).isin(changed)))
                kept |= {str(b): {"print": found[str(b)], "folder": f"{folder}/{BUCKET}={b}"} for b in changed}
            table["parts"][part] = kept
            table["schema"] = schema
        return sorted([*changed, *gone])

    def build(self, name: str, inputs: Sequence[str], plan: Callable[..., DataFrame], version: str = "") -> list[int]:
        """Bring a model up to date; returns the buckets that were rebuilt.

        ``plan`` gets the inputs' rows of the buckets to rebuild and returns rows with the key, or with the
        bucket. ``version`` stands for the plan's own parameters: another one rebuilds all buckets.
        """
        made_from = {b: json.dumps([version, {i: self._folders(i, b) for i in inputs}]) for b in range(self.buckets)}
        known = self._table(name).get("from", {})
        changed = [b for b in range(self.buckets) if known.get(str(b)) != made_from[b]]
        if not changed:
            return []
        rows = plan(*[self.read(i, changed) for i in inputs])
        if BUCKET not in rows.columns:
            rows = rows.withColumn(BUCKET, self.bucket())
        with self.snapshots.change() as state:
            folder = self._write(name, rows)
            table = state.setdefault("tables", {}).setdefault(name, {"parts": {"all": {}}, "from": {}})
            for b in changed:
                place = f"{folder}/{BUCKET}={b}"
                table["from"][str(b)] = made_from[b]
                table["parts"]["all"].pop(str(b), None)
                if path_exists(self.spark, f"{self.path}/{place}"):
                    table["parts"]["all"][str(b)] = {"folder": place}
            table["schema"] = _columns(rows.drop(BUCKET))
        return changed

    def clean(self, keep: int = 1) -> int:
        """Remove folders that none of the last ``keep`` snapshots names; not while a build runs."""
        return self.snapshots.clean([f"layer/{t}" for t in self.snapshots.state().get("tables", {})], keep)


def build_revenue(layers: Layers, p: Params = Params()) -> dict[str, list[int]]:
    """Movements, the revenue mart and the sums of retention, from the inputs ``customers``, ``subscriptions``
    (resolved), ``amendments`` (with deltas) and ``health``. Returns the buckets rebuilt per model."""

    def movements(customers: DataFrame, subscriptions: DataFrame, amendments: DataFrame) -> DataFrame:
        return revenue.mrr_movements(revenue.customer_months(customers, subscriptions, amendments, p), customers)

    def sums(moved: DataFrame) -> DataFrame:
        return revenue.nrr_by_region(moved.withColumn(BUCKET, layers.bucket()), BUCKET)

    return {
        "movements": layers.build("movements", ["customers", "subscriptions", "amendments"], movements, repr(p)),
        "mart_mrr": layers.build("mart_mrr", ["movements", "health"], revenue.mart_mrr),
        "nrr_sums": layers.build("nrr_sums", ["movements"], sums),
    }


def stored_nrr(layers: Layers) -> DataFrame:
    """Net revenue retention from the stored sums: a few rows per bucket, no customer is read."""
    return revenue.retention(layers.read("nrr_sums"))
