"""Parquet tables: batch-partitioned facts, versioned dimensions, persisted models, CSV export."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from retentia.sources.batches import BATCH, folders, path_exists


def write_fact_batch(new: DataFrame, path: str, batch_id: int) -> None:
    """Load one batch into a fact table: its folder is replaced, also by a delivery without rows, which keeps its columns."""
    folder = f"{path.rstrip('/')}/{BATCH}={batch_id}"
    new.drop(BATCH).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """All batches of a fact table; columns that only later batches have are NULL in earlier rows.

    A batch is written as a whole, so its columns are read from one of its files: a footer per batch,
    however many files the table has. A column whose type differs between batches is an error.
    """
    fields: dict = {}
    batches = [name for name in folders(spark, path) if name.startswith(f"{BATCH}=")]
    for name in sorted(batches, key=lambda n: int(n.partition("=")[2])):
        for field in spark.read.parquet(f"{path}/{name}").schema.fields:
            if fields.setdefault(field.name.lower(), field).dataType != field.dataType:
                raise ValueError(f"{path}: the type of {field.name} differs between batches")
    return spark.read.schema(StructType(list(fields.values()))).parquet(path)


class VersionedTable:
    """A table replaced as a whole: each write goes to a new folder, then a pointer names it.

    Readers never see a half-written state, a plan may read the version it replaces, and a lost
    executor or failed job leaves the current version in place.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _pointers(self) -> list[int]:
        folder = f"{self.path}/_current"
        if not path_exists(self.spark, folder):
            return []
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(folder)
        return sorted(int(s.getPath().getName()) for s in at.getFileSystem(conf).listStatus(at))

    @property
    def version(self) -> int:
        found = self._pointers()
        return found[-1] if found else 0

    def exists(self) -> bool:
        return self.version > 0

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v{version or self.version}")

    def write(self, df: DataFrame) -> int:
        number = self.version + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v{number}")
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        pointer = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_current/{number}")
        pointer.getFileSystem(conf).create(pointer, False).close()
        return number


def spread(df: DataFrame, key: str) -> DataFrame:
    """A stored table dealt by hash of ``key`` to all cores if its files cannot be cut into as many tasks.

    A table in one small file would else be parsed by one task. Tables with enough splits, which every large
    one has, are returned as they are; filters and column choices still reach the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df._jdf.rdd().getNumPartitions() < cores else df


def materialise(df: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    """Persist a model and return it as read back, with its lineage cut; ``codec`` replaces the session's compression."""
    df.write.mode("overwrite").parquet(path, compression=codec)
    return df.sparkSession.read.parquet(path)


# Models of several wide joins or aggregations take a function ``keep`` that gets the rows between two of them and may
# store them, as :class:`Steps` does: they then run one after the other, and only one's shuffle files lie on disk.
Keep = Callable[[DataFrame], DataFrame]


def as_is(df: DataFrame) -> DataFrame:
    return df


class Steps:
    """A ``keep`` that stores rows below one folder and returns them as read back; :meth:`clear` removes what was stored
    but the last ``but`` steps, once nothing reads it any more."""

    def __init__(self, spark: SparkSession, path: str, codec: str | None = None):
        self.spark, self.path, self.codec, self.made = spark, path.rstrip("/"), codec, 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.made += 1
        return materialise(df, f"{self.path}/{self.made}", self.codec)

    def clear(self, but: int = 0) -> None:
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for place in [f"{self.path}/{i}" for i in range(1, self.made - but + 1)] if but else [self.path]:
            at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
            at.getFileSystem(conf).delete(at, True)


def read_model(spark: SparkSession, path: str, query: str | None = None, args: list | None = None) -> DataFrame:
    """A persisted model, or a query over it (as ``{model}``) with positional parameters ``?``."""
    model = spark.read.parquet(path)
    return model if query is None else spark.sql(query, args=args, model=model)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a headered CSV, one file per partition; nothing is gathered on the driver."""
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**options).csv(path)


def load_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and batch; tables without batches show a NULL batch."""

    def counted(name: str, df: DataFrame) -> DataFrame:
        batch = F.col(BATCH).cast("int") if BATCH in df.columns else F.lit(None).cast("int")
        return df.groupBy(F.lit(name).alias("table_name"), batch.alias("batch_id")).agg(F.count(F.lit(1)).alias("rows"))

    parts = [counted(n, d) for n, d in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

