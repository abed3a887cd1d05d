"""Run queries in both engines and compare rows, column names and column kinds."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from verification.models import BASE_TABLES
from verification.registry import load_all, run

_KINDS = {
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v


def compare(name: str, spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str) -> list[str]:
    """Differences between the two engines; empty when they agree."""
    df = run(name, spark, sf_dir)
    cursor = con.execute(load_all()[name].sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    problems = []
    if sorted(df.columns) != sorted(described):
        return [f"columns differ: {sorted(set(df.columns) ^ set(described))}"]
    order = sorted(described)
    at = [list(described).index(c) for c in order]
    theirs = Counter(tuple(_cell(r[i]) for i in at) for r in cursor.fetchall())
    ours = Counter(tuple(_cell(r[c]) for c in order) for r in df.collect())
    for f in df.schema.fields:
        kind = described[f.name]
        if _KINDS.get(f.dataType.simpleString()) != kind and not (
            f.dataType.simpleString() in ("int", "bigint") and kind in ("INTEGER", "BIGINT")
        ):
            problems.append(f"type of {f.name}: {f.dataType.simpleString()} / {kind}")
    if ours != theirs:
        extra, missing = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
        problems.append(f"rows {sum(ours.values())} / {sum(theirs.values())}; order {order}; only here {extra}; only there {missing}")
    elif not ours:
        problems.append("no rows")
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or list(load_all()):
        began = time.time()
        try:
            problems = compare(name, spark, con, sf_dir)
        except Exception as e:  # keep going, report at the end
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        print(f"{name:32s} {time.time() - began:6.1f}s  {'ok' if not problems else problems}", flush=True)
    print(f"{bad} queries differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
