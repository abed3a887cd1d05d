"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retentia.session import scratch_dir

Batches = Iterator[pa.RecordBatch]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage is cut, lost executors lose nothing."""
    path = scratch_dir(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fixed_splits(spark: SparkSession) -> None:
    """Keep the number of tasks that files are cut for as it is now.

    Spark takes it from the cores present at each read, so that a small table would be cut in another way,
    and its rows numbered in another way, after an executor is lost or added. A value that is set stays.
    """
    name = "spark.sql.leafNodeDefaultParallelism"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))


def numbered(docs: DataFrame, *columns: str) -> DataFrame:
    """``row`` and the named columns. Row numbers repeat exactly when the same stored table is read again."""
    fixed_splits(docs.sparkSession)
    return docs.select(F.monotonically_increasing_id().alias("row"), *[F.col(f"`{c}`").alias(c) for c in columns])


def keep_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents whose row number is in ``rows`` (column ``row``); ``docs`` is a stored table."""
    fixed_splits(docs.sparkSession)
    name = free_name(docs, "row")
    tagged = docs.withColumn(name, F.monotonically_increasing_id())
    return tagged.join(rows.select(F.col("row").alias(name)), name, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def rows_out(schema: pa.Schema, rows: list[tuple], size: int = 1 << 16) -> Batches:
    for at in range(0, len(rows), size):
        part = zip(*rows[at : at + size])
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(part, schema)], schema=schema)


def hash_share(seed: str, *columns: Column) -> Column:
    """A number in [0, 1) from an MD5 digest: the same in every engine, for any number of tasks."""
    parts = [F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def bounded_sample(rows: DataFrame, key: str, per_key: int, total: int, seed: str, *identity: Column) -> DataFrame:
    """About ``per_key`` rows of each ``key`` and ``total`` in all, chosen by a hash of ``identity``.

    One pass counts the rows of each key (combined map-side), and the rates are joined to the rows, so there
    may be any number of keys; of more than ``total`` keys, each has a row by chance. Nothing is collected.
    """
    counts = stored(rows.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    keys = counts.count()
    share = min(float(per_key), total / max(1, keys))
    rates = counts.select("_key", (F.lit(share) / F.col("_n")).alias("_rate"))
    return rows.join(rates, F.col(key) == F.col("_key")).filter(hash_share(seed, *identity) < F.col("_rate")).drop("_key", "_rate")


Task = Callable[[Batches], Batches]
