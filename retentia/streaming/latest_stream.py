"""The latest version of each dated key, kept up to date by a stream whose state is bounded by a watermark.

Picking the highest version is a maximum: it may be taken in any order, over any parts and repeatedly. So the
state store need hold only the days that still change, what it reports can be appended to the table as it is,
and rows that come after their day has left the state are merged with the stored ones instead.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from retentia.operators.versions import latest_per_key
from retentia.sources.batches import folders
from retentia.sources.snapshots import Snapshots

MONTH, UNDATED = "_month", "none"
_AT, _STORED = "_at", "_stored"


class LatestTable:
    """One row per key: the one with the highest ``order`` (first column first, NULLs lowest).

    Rows lie in runs, each with at most one row per key, in a folder per month. A month with one run is
    scanned as it is, one with several is merged when read, and once when it is closed. ``day`` is one of
    the keys and may be NULL.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], day: str, order: Sequence[str]):
        self.spark, self.path, self.keys, self.day, self.order = spark, path.rstrip("/"), list(keys), day, list(order)
        self.snapshots = Snapshots(spark, path)

    def pick(self, rows: DataFrame, *last: str) -> DataFrame:
        return latest_per_key(rows, self.keys, self.order[0], [*self.order[1:], *last])

    def month(self) -> Column:
        return F.coalesce(F.date_format(self.day, "yyyy-MM"), F.lit(UNDATED))

    # --- reading ---

    def runs(self) -> dict[str, list[str]]:
        """Folders by month."""
        return self.snapshots.state().get("months", {})

    def _scan(self, places: Iterable[str]) -> DataFrame:
        fields, places = StructType.fromJson(json.loads(self.snapshots.state()["schema"])), list(places)
        found = self.spark.read.schema(fields).parquet(*[f"{self.path}/{p}" for p in places]) if places else None
        return self.spark.createDataFrame([], fields) if found is None else found

    def read(self, months: Iterable[str] | None = None) -> DataFrame:
        """The table, or some of its months: only their folders are read."""
        known = self.runs()
        wanted = [known[m] for m in (known if months is None else months) if m in known]
        plain = self._scan(r[0] for r in wanted if len(r) == 1)
        several = [place for r in wanted if len(r) > 1 for place in r]
        return plain.unionByName(self.pick(self._scan(several))) if several else plain

    @property
    def closed(self) -> date | None:
        """The last day that has left the stream's state."""
        found = self.snapshots.state().get("closed")
        return date.fromisoformat(found) if found else None

    # --- writing ---

    def _write(self, rows: DataFrame) -> dict[str, str]:
        folder = self.snapshots.folder("runs")
        rows.withColumn(MONTH, self.month()).write.partitionBy(MONTH).parquet(f"{self.path}/{folder}")
        return {n.partition("=")[2]: f"{folder}/{n}" for n in folders(self.spark, f"{self.path}/{folder}") if n.startswith(MONTH)}

    def add(self, rows: DataFrame) -> None:
        """Add a run: at most one row per key. Adding a run twice changes nothing that is read."""
        with self.snapshots.change() as state:
            if state.setdefault("schema", rows.schema.json()) != rows.schema.json():
                raise ValueError(f"{self.path}: the columns differ from those stored")
            for month, place in self._write(rows).items():
                state.setdefault("months", {}).setdefault(month, []).append(place)

    def merge(self, rows: DataFrame) -> None:
        """Add those of any rows that beat the stored row of their key; only the months they name are read.

        ``rows`` are evaluated twice: for their months, and for the rows.
        """
        months = [r[0] for r in rows.select(self.month()).distinct().collect()]  # bounded by the calendar
        if not months:
            return
        if "schema" not in self.snapshots.state():
            self.add(self.pick(rows))
            return
        both = rows.withColumn(_STORED, F.lit(False)).unionByName(self.read(months).withColumn(_STORED, F.lit(True)))
        self.add(self.pick(both, _STORED).filter(~F.col(_STORED)).select(*rows.columns))

    def close(self, upto: date | None) -> list[str]:
        """Days up to ``upto`` have left the state: months that end by then are merged into one run each."""
        with self.snapshots.change() as state:
            last = max([d for d in (upto, self.closed) if d is not None], default=None)
            if last is None:
                return []
            state["closed"] = last.isoformat()
            ended = [m for m, runs in self.runs().items() if len(runs) > 1 and (m == UNDATED or _last_day(m) <= last)]
            if ended:
                places = [place for m in ended for place in state["months"][m]]
                merged = self.pick(self._scan(places)).withColumn(MONTH, self.month()).hint("rebalance", MONTH)
                state["months"] |= {m: [place] for m, place in self._write(merged.drop(MONTH)).items()}
        return ended

    def clean(self, keep: int = 1) -> int:
        """Remove runs that none of the last ``keep`` snapshots names; not while a stream runs."""
        return self.snapshots.clean(["runs"], keep)


def _last_day(month: str) -> date:
    year, number = map(int, month.split("-"))
    return date.fromordinal(date(year + number // 12, number % 12 + 1, 1).toordinal() - 1)


def latest_of_stream(rows: DataFrame, table: LatestTable, lateness: str) -> DataFrame:
    """The latest row per key of a stream, for output mode ``update``. NULL days are left out: no watermark passes them."""
    others = [c for c in rows.columns if c not in table.keys and c not in table.order]
    dated = rows.withColumn(_AT, F.col(table.day).cast("timestamp")).filter(F.col(_AT).isNotNull()).withWatermark(_AT, lateness)
    keys = [c for c in table.keys if c != table.day]
    best = dated.groupBy(_AT, *keys).agg(F.max(F.struct(*table.order, *others)).alias("_row"))
    own = {table.day: F.col(_AT).cast("date"), **{c: F.col(c) for c in keys}}
    return best.select(*[own.get(c, F.col(f"_row.{c}")).alias(c) for c in rows.columns])


def _run(out: DataFrame, step, checkpoint: str, mode: str) -> StreamingQuery:
    query = (
        out.writeStream.outputMode(mode)
        .foreachBatch(lambda found, _: step(found))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def update_latest(rows: DataFrame, table: LatestTable, checkpoint: str, lateness: str) -> StreamingQuery:
    """Bring ``table`` up to date with the files that have arrived since the last run, then stop.

    ``rows`` is a file stream without a limit on files per trigger. The first query holds one row per key for
    the days within ``lateness`` of the newest day, and adds the rows that have changed to the table. Older rows,
    which the watermark keeps from the state, and rows without a day go through the second query, which holds no
    state: those that beat the stored row are added. So no row is lost, whatever its day, and a wrong day far
    ahead makes other rows late but costs none.

    A run that is cut off anywhere is finished by the next one. As a run has one micro-batch of data, a row is
    only dropped by a watermark that an earlier run has recorded, so the second query, which looks up to the
    last recorded day, sees it, also when its file arrives between the two. Returns the first query.
    """
    fresh = _run(latest_of_stream(rows, table, lateness), table.add, f"{checkpoint}/state", "update")
    seen = [p["eventTime"]["watermark"][:10] for p in fresh.recentProgress if "watermark" in p["eventTime"]]
    table.close(max(map(date.fromisoformat, seen), default=None))
    day, closed = F.col(table.day), table.closed
    outside = day.isNull() if closed is None else day.isNull() | (day <= F.lit(closed))
    _run(rows.filter(outside), table.merge, f"{checkpoint}/late", "append")
    table.close(None)
    return fresh


def usage_table(spark: SparkSession, path: str) -> LatestTable:
    """Latest usage per customer, day and metric, by the same order as the batch model."""
    return LatestTable(spark, path, ["customer_id", "event_date", "metric_name"], "event_date", ["batch_id", "_row_seq", "quantity"])
