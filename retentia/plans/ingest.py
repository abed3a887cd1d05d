"""Load delivered batches into the raw store: dimensions, facts, corrections, history."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from contextlib import AbstractContextManager
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from retentia.functions.cleaning import lookup
from retentia.operators.merge import (
    CORRECTION_TARGETS,
    apply_corrections,
    duplicate_keys,
    known_corrections,
    merge_dimension,
    scd2_snapshot,
    scd2_step,
)
from retentia.sources.batches import (
    BATCH, CORRECTIONS, DIMENSIONS, FACTS, Batch, delivered, folders, path_exists, read_csv, read_dim_batch, read_fact_batch,
)
from retentia.sources.snapshots import Snapshots
from retentia.sources.store import load_summary

ENTITIES = {table: kind for kind, (table, _) in CORRECTION_TARGETS.items()}
PATCH_COLUMNS = ("correction_id", "entity_id", "field_corrected", "new_value")
EVERY_BATCH = 2**31 - 1
CODEC = "zstd"  # of the stored files
PROBE = 1000  # corrected ids that are looked up in a batch before all of them are


class RawStore:
    """The raw tables below one folder, as the last committed snapshot names them.

    A fact table is a folder per batch, a dimension one folder, history its open rows and the folders that
    closed rows went to. Corrections are a log: a delivery's patches are written once and merged when a table
    is read; they reach the rows of their own and earlier batches, also of batches loaded again later.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.snapshots = Snapshots(spark, path)

    def change(self) -> AbstractContextManager[dict]:
        """What is loaded within becomes visible at the end, all together, or not at all."""
        return self.snapshots.change()

    def _entries(self, kind: str) -> dict:
        return self.snapshots.state().get(kind, {})

    def _write(self, df: DataFrame, place: str) -> str:
        folder = self.snapshots.folder(place)
        df.write.option("compression", CODEC).parquet(f"{self.path}/{folder}")
        return folder

    def _read(self, schema: str, *folders: str) -> DataFrame:
        fields = StructType.fromJson(json.loads(schema))
        if not folders:
            return self.spark.createDataFrame([], fields)
        return self.spark.read.schema(fields).parquet(*[f"{self.path}/{f}" for f in folders])

    # --- reading ---

    def dimension(self, table: str) -> StoredTable:
        return StoredTable(self, "dimensions", table)

    def history(self, table: str) -> StoredTable:
        return StoredTable(self, "history", table)

    def has_fact(self, table: str) -> bool:
        return table in self._entries("facts")

    def fact(self, table: str) -> DataFrame:
        """All batches with their patches; columns that only some batches have are NULL in the others' rows.

        Batches that no patch can reach are scanned alone, without a join.
        """
        plain, patched = [], []
        for number, entry in self._entries("facts")[table].items():
            (patched if self._pending(table, int(number), entry) else plain).append(self._current(table, int(number), entry))
        parts = [self._batches(table, plain)] if plain else []
        if patched:
            parts.append(apply_corrections(self._batches(table, patched), self.patch_log(table), ENTITIES[table]))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _batches(self, table: str, folders: list[str]) -> DataFrame:
        """Folders of a fact table with all of its columns; the batch number comes from the path."""
        fields: dict = {}
        for _, entry in sorted(self._entries("facts")[table].items(), key=lambda kv: int(kv[0])):
            for f in StructType.fromJson(json.loads(entry["schema"])).fields:
                if fields.setdefault(f.name.lower(), f).dataType != f.dataType:
                    raise ValueError(f"{table}: the type of {f.name} differs between batches")
        base = f"{self.path}/fact/{table}"
        return self.spark.read.schema(StructType(list(fields.values()))).option("basePath", base).parquet(*[f"{self.path}/{f}" for f in folders])

    def _log(self, table: str, least: int = 0) -> dict[int, str]:
        """Patch folders by delivery."""
        return {int(d): f for d, f in self._entries("patches").get(table, {}).items() if int(d) >= least}

    def _compacted(self, table: str, number: int, entry: dict) -> bool:
        """Whether patches were merged into the batch that the log still holds, with none between or before them missing."""
        log, applied = self._log(table, number), {int(d): f for d, f in entry.get("applied", {}).items()}
        return bool(applied) and all(log.get(d) == f for d, f in applied.items()) and not any(d < max(applied) and d not in applied for d in log)

    def _pending(self, table: str, number: int, entry: dict) -> bool:
        if table not in ENTITIES:
            return False
        done = entry["applied"] if self._compacted(table, number, entry) else {}
        return any(str(d) not in done for d in self._log(table, number))

    def _current(self, table: str, number: int, entry: dict) -> str:
        return (self._compacted(table, number, entry) and entry.get("merged")) or entry["raw"]

    def patch_log(self, table: str, least: int = 0) -> DataFrame:
        """All patches of a table with the number of their delivery in ``_delivery``."""
        log = self._log(table, least)
        fields = StructType([StructField(c, StringType()) for c in PATCH_COLUMNS])
        parts = [self._read(fields.json(), f).withColumns({"entity_type": F.lit(ENTITIES[table]), "_delivery": F.lit(d)}) for d, f in sorted(log.items())]
        return reduce(DataFrame.unionByName, parts)

    def tables(self) -> dict[str, DataFrame]:
        dims = {t: self.dimension(t).read() for t in DIMENSIONS if self.dimension(t).exists()}
        return dims | {t: self.fact(t) for t in FACTS if self.has_fact(t)}

    # --- steps ---

    def sync_dimension(self, table: str, incoming: DataFrame, as_of: date | None = None, batch_id: int = 0) -> None:
        key, stored = DIMENSIONS[table], self.dimension(table)
        if duplicate_keys(incoming, key).limit(1).count():
            raise ValueError(f"{table}: the delivery repeats a {key}")
        with self.change() as state:
            merged = merge_dimension(stored.read(), incoming, key) if stored.exists() else incoming
            entry = {"folder": self._write(merged, f"dim/{table}"), "schema": merged.schema.json(), "delivery": batch_id}
            state.setdefault("dimensions", {})[table] = entry
            self._count(state, table)
            if as_of is not None:
                self._snapshot(state, table, key, as_of)

    def _snapshot(self, state: dict, table: str, key: str, as_of: date) -> None:
        """One more snapshot of a dimension: open rows are compared and written anew, closed ones only added."""
        known = self._entries("history").get(table)
        current = self.dimension(table).read()
        live = self._read(known["schema"], *known["open"]) if known else None
        rows = scd2_snapshot(None, current, key, as_of) if live is None else scd2_step(live, current, key, as_of)
        folder = self.snapshots.folder(f"history/{table}")
        rows.withColumn("_open", F.col("valid_to").isNull()).write.partitionBy("_open").parquet(f"{self.path}/{folder}")
        found = {side: [f"{folder}/_open={side}"] for side in ("true", "false") if path_exists(self.spark, f"{self.path}/{folder}/_open={side}")}
        closed = (known["closed"] if known else []) + found.get("false", [])
        state.setdefault("history", {})[table] = {"open": found.get("true", []), "closed": closed, "schema": rows.schema.json()}

    @staticmethod
    def _count(state: dict, table: str) -> None:
        versions = state.setdefault("versions", {})
        versions[table] = versions.get(table, 0) + 1

    def load_fact(self, table: str, incoming: DataFrame, batch_id: int) -> None:
        """(Re)load one batch. Its patches stay in the log and are merged with the new rows."""
        rows = incoming.drop(BATCH)
        with self.change() as state:
            folder = self._write(rows, f"fact/{table}/{BATCH}={batch_id}")
            state.setdefault("facts", {}).setdefault(table, {})[str(batch_id)] = {"raw": folder, "schema": rows.schema.json()}

    def correct(self, corrections: DataFrame, upto: int | None = None, tables: set[str] | None = None) -> None:
        """Log a delivery's corrections for every table they name, or only for ``tables``; nothing else is written.

        Rows of batches after ``upto`` were delivered later and stay as they are. Corrections of the same
        delivery replace those logged before; a patch waits for a table that has not arrived.
        """
        wanted = [k for k, (t, _) in CORRECTION_TARGETS.items() if tables is None or t in tables]
        delivery = str(EVERY_BATCH if upto is None else upto)
        own = known_corrections(corrections).filter(F.col("entity_type").isin(wanted)).select("entity_type", *PATCH_COLUMNS)
        with self.change() as state:
            folder = self.snapshots.folder("patches")
            own.write.option("compression", CODEC).partitionBy("entity_type").parquet(f"{self.path}/{folder}")
            for kind in wanted:
                table, place = CORRECTION_TARGETS[kind][0], f"{folder}/entity_type={kind}"
                log = state.setdefault("patches", {}).setdefault(table, {})
                if path_exists(self.spark, f"{self.path}/{place}"):
                    log[delivery] = place
                    self._count(state, table)
                else:
                    log.pop(delivery, None)

    def compact(self, table: str) -> list[int]:
        """Merge logged patches into the batches that hold corrected ids; returns these batches.

        All touched batches are patched by one join and written once, each to a new folder; other batches are
        only marked, so none is joined any more when read. The delivered rows stay, for corrections that are delivered again.
        """
        with self.change() as state:
            due = {n: e for n, e in sorted((int(n), e) for n, e in state["facts"][table].items()) if self._pending(table, n, e)}
            log, current = {n: self._log(table, n) for n in due}, {n: self._current(table, n, e) for n, e in due.items()}
            touched = [n for n in due if self._touched(table, n, current[n])]
            written = self._merge(table, {n: current[n] for n in touched}) if touched else {}
            for n, entry in due.items():
                before = entry.get("merged") if self._compacted(table, n, entry) else None
                entry |= {"merged": written.get(n, before), "applied": {str(d): f for d, f in log[n].items()}}
        return touched

    def _touched(self, table: str, number: int, folder: str) -> bool:
        """Whether a batch holds a corrected id. Some of the ids are looked up first, without a shuffle; only if
        none of them is found, all are."""
        key, rows = CORRECTION_TARGETS[ENTITIES[table]][1], self._batches(table, [folder])
        if key not in rows.columns:
            return False
        ids = self.patch_log(table, number).select(F.col("entity_id").alias("_id")).filter("_id IS NOT NULL")
        same = F.col(key).cast("string") == F.col("_id")
        return any(not rows.join(some, same, "left_semi").isEmpty() for some in (F.broadcast(ids.limit(PROBE)), ids))

    def _merge(self, table: str, current: dict[int, str]) -> dict[int, str]:
        """Write patched batches, by one join, and return their new folders. A later delivery's patch hides earlier ones
        of its field, so the patches that reach the first batch are right for all."""
        rows = self._batches(table, list(current.values()))
        patched = apply_corrections(rows, self.patch_log(table, min(current)), ENTITIES[table])
        own = {n: {f.name.lower() for f in StructType.fromJson(json.loads(self._entries("facts")[table][str(n)]["schema"])).fields} for n in current}

        def held(c: str) -> Column:
            has = [n for n in current if c.lower() in own[n]]
            return F.col(c) if c == BATCH or len(has) == len(own) else F.when(F.col(BATCH).isin(has), F.col(c)).alias(c)

        staged = self.snapshots.folder(f"fact/{table}")
        patched.select(*[held(c) for c in patched.columns]).write.option("compression", CODEC).partitionBy(BATCH).parquet(f"{self.path}/{staged}")
        folders = {n: self.snapshots.folder(f"fact/{table}/{BATCH}={n}") for n in current}
        for n, folder in folders.items():
            self.snapshots.move(f"{staged}/{BATCH}={n}", folder)
        self.snapshots.discard(staged)
        return folders

    def clean(self, keep: int = 1) -> int:
        """Remove what only snapshots before the last ``keep`` name, and what was cut off; not while a load runs."""
        places = ["patches", *[f"dim/{t}" for t in DIMENSIONS], *[f"history/{t}" for t in DIMENSIONS]]
        for table in FACTS:
            if path_exists(self.spark, f"{self.path}/fact/{table}"):
                places += [f"fact/{table}/{b}" for b in folders(self.spark, f"{self.path}/fact/{table}")]
        return self.snapshots.clean(places, keep)


@dataclass
class StoredTable:
    """A dimension, or the history of one, as the current snapshot shows it."""

    store: RawStore
    kind: str
    table: str

    @property
    def _entry(self) -> dict | None:
        return self.store._entries(self.kind).get(self.table)

    @property
    def version(self) -> int:
        """How often the table was replaced or patched."""
        return self.store._entries("versions").get(self.table, 0)

    def exists(self) -> bool:
        return self._entry is not None

    def read(self) -> DataFrame:
        entry = self._entry
        if self.kind == "history":
            return self.store._read(entry["schema"], *entry["closed"], *entry["open"])
        rows = self.store._read(entry["schema"], entry["folder"])
        if self.table not in ENTITIES or not self.store._log(self.table, entry["delivery"]):
            return rows
        return apply_corrections(rows, self.store.patch_log(self.table, entry["delivery"]), ENTITIES[self.table])


def load_tables(store: RawStore, root: str, batch: Batch, tables: set[str], as_of: date | None = None) -> None:
    """The named tables of one delivery, dimensions first. Missing files are skipped."""
    spark = store.spark
    for table in [t for t in DIMENSIONS if t in tables]:
        incoming = read_dim_batch(spark, root, batch, table)
        if incoming is not None:
            store.sync_dimension(table, incoming, as_of if table == "customers" else None, batch.batch_id)
    for table in [t for t in FACTS if t in tables]:
        incoming = read_fact_batch(spark, root, batch, table)
        if incoming is not None:
            store.load_fact(table, incoming, batch.batch_id)


def log_delivered_corrections(store: RawStore, root: str, batch: Batch) -> None:
    corrections = read_csv(store.spark, f"{root}/{batch.name}/{CORRECTIONS}.csv")
    if corrections is not None:
        store.correct(corrections, batch.batch_id)


def load_batch(store: RawStore, root: str, batch: Batch, as_of: date | None = None) -> None:
    """One delivery as one change: dimensions, facts, corrections."""
    with store.change():
        load_tables(store, root, batch, {*DIMENSIONS, *FACTS}, as_of)
        log_delivered_corrections(store, root, batch)


def load_arrived(store: RawStore, root: str, arrived: set[tuple[str, str]]) -> None:
    """Bring the store up to date after files of some deliveries (folder name, table) have arrived, as one change.

    A table of which a part arrived is read again whole, so parts that arrive one after the other lose
    nothing and a repeated call changes nothing. A dimension that a later delivery has replaced before stays. What
    is loaded again is still patched by its own and later deliveries' corrections, as these are logged.
    """
    known = delivered(store.spark, root)
    with store.change():
        for i, batch in enumerate(known):
            replaced = {
                t for t in DIMENSIONS for b in known[i + 1 :]
                if (b.name, t) not in arrived and path_exists(store.spark, f"{root}/{b.name}/{t}.csv")
            }
            tables = {t for name, t in arrived if name == batch.name}
            load_tables(store, root, batch, tables - replaced)
            if CORRECTIONS in tables:
                log_delivered_corrections(store, root, batch)


def load_batches(store: RawStore, root: str, batches: tuple[Batch, ...], as_of: dict[int, date] | None = None) -> DataFrame:
    """All deliveries in order; returns rows per table and batch."""
    for batch in sorted(batches, key=lambda b: b.batch_id):
        load_batch(store, root, batch, (as_of or {}).get(batch.batch_id))
    return load_summary(store.tables())


def rejected_corrections(corrections: DataFrame, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Patches that cannot be applied to any table, with the ``reason``; ``columns`` are those of the loaded tables."""
    tables = {kind: table for kind, (table, _) in CORRECTION_TARGETS.items()}
    table = lookup(tables, F.lower(F.trim("entity_type")))
    fields = [f"{t}.{c.lower()}" for t, names in columns.items() for c in names if c != BATCH]
    known = F.concat(table, F.lit("."), F.lower(F.trim("field_corrected"))).isin(fields)
    reason = (
        F.when(table.isNull(), "unknown entity type")
        .when(~table.isin(list(columns)), "table not loaded")
        .when(~F.coalesce(known, F.lit(False)), "unknown field")
    )
    return corrections.select("correction_id", "entity_type", "entity_id", "field_corrected", "new_value", reason.alias("reason")).filter("reason IS NOT NULL")


def invalid_corrections(corrections: DataFrame, facts: DataFrame, entity: str, types: dict[str, str]) -> DataFrame:
    """Patches that cannot work: no such entity, or a value the target column cannot hold.

    ``types`` names the typed columns and their SQL types; other columns accept any text.
    """
    _, key = CORRECTION_TARGETS[entity]
    own = known_corrections(corrections).filter(F.col("entity_type") == entity)
    ids = facts.select(F.col(key).cast("string").alias("_id")).filter("_id IS NOT NULL").distinct()
    value, wanted = F.col("new_value"), F.col("field_corrected")
    bad = F.lit(False)
    for column, sql_type in types.items():
        bad |= (wanted == column) & value.isNotNull() & value.try_cast(sql_type).isNull()
    checked = own.join(ids, F.col("entity_id") == F.col("_id"), "left").withColumns(
        {"unknown_entity": F.col("_id").isNull(), "invalid_value": F.coalesce(bad, F.lit(False))}
    )
    return checked.filter("unknown_entity OR invalid_value").select(
        "correction_id", "entity_type", "entity_id", "field_corrected", "new_value", "unknown_entity", "invalid_value"
    )
