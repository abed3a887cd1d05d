"""Bring new files into existing tables: schema evolution, full-sync merge, history, corrections."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, ByteType, DataType, IntegerType, LongType, ShortType, StringType

# The table and key each kind of correction patches.
CORRECTION_TARGETS = {
    "invoice": ("invoices", "invoice_id"),
    "payment": ("payments", "payment_id"),
    "customer": ("customers", "customer_id"),
    "subscription": ("subscriptions", "subscription_id"),
    "usage_event": ("usage_events", "event_id"),
    "support_ticket": ("support_tickets", "ticket_id"),
}


def _evolved_type(t: DataType) -> DataType:
    if isinstance(t, (ByteType, ShortType, IntegerType, LongType)):
        return LongType()
    return t if isinstance(t, BooleanType) else StringType()


def evolve_schema(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """``existing`` with the columns only ``incoming`` has, NULL for the rows already there."""
    known = {c.lower() for c in existing.columns}
    added = [f for f in incoming.schema.fields if f.name.lower() not in known]
    return existing.select("*", *[F.lit(None).cast(_evolved_type(f.dataType)).alias(f.name) for f in added])


def append_batch(existing: DataFrame, incoming: DataFrame, batch_id: int, column: str = "_batch_id") -> DataFrame:
    """The table after (re)loading one batch: its old rows go, the others stay, columns match by name."""
    others = evolve_schema(existing, incoming).filter(~F.col(column).eqNullSafe(F.lit(batch_id).cast(existing.schema[column].dataType)))
    return others.unionByName(incoming, allowMissingColumns=True)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).count().filter(F.col("count") > 1)


def _as_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def compare_dimension(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Full outer join of the stored and the new state, each row marked with its ``action``.

    The columns of the delivery are compared as text, with NULL equal to empty; a column that is new
    in the delivery therefore marks every row with a value in it as updated.
    """
    current = evolve_schema(current, incoming)
    old = current.select(F.struct("*").alias("old"), _as_text(F.col(key)).alias("_key"))
    new = incoming.select(F.struct("*").alias("new"), _as_text(F.col(key)).alias("_key"))
    shared = [c for c in incoming.columns if c in current.columns and c != key]
    same = F.lit(True)
    for c in shared:
        same &= _as_text(F.col(f"old.{c}")) == _as_text(F.col(f"new.{c}"))
    action = (
        F.when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull(), "delete")
        .when(same, "unchanged")
        .otherwise("update")
    )
    return old.join(new, "_key", "full_outer").withColumn("action", action)


def merge_dimension(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The dimension after a full sync: new and changed rows as delivered, unchanged rows as stored.

    Keys must be unique on both sides (see :func:`duplicate_keys`).
    """
    evolved = evolve_schema(current, incoming)
    compared = compare_dimension(current, incoming, key).filter("action <> 'delete'")
    keep = F.col("action") == "unchanged"

    def merged(field) -> Column:
        new = F.col(f"new.{field.name}").cast(field.dataType) if field.name in incoming.columns else F.lit(None)
        return F.when(keep, F.col(f"old.{field.name}")).otherwise(new).alias(field.name)

    return compared.select(*[merged(f) for f in evolved.schema.fields])


def merge_stats(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows inserted, updated, deleted and left alone by a merge."""
    return compare_dimension(current, incoming, key).groupBy("action").count().withColumnRenamed("count", "rows")


def scd2_snapshot(
    history: DataFrame | None, current: DataFrame, key: str, as_of: date, close_deleted: bool = False
) -> DataFrame:
    """History after one more snapshot: changed rows are closed at ``as_of`` and opened anew.

    ``valid_to`` is NULL on open rows. Rows that vanished stay open unless ``close_deleted``.
    """
    opened = current.withColumns({"valid_from": F.lit(as_of), "valid_to": F.lit(None).cast("date")})
    if history is None:
        return opened
    history = evolve_schema(history, current)
    closed = history.filter("valid_to IS NOT NULL")
    return closed.unionByName(scd2_step(history.filter("valid_to IS NULL"), current, key, as_of, close_deleted))


def scd2_step(live: DataFrame, current: DataFrame, key: str, as_of: date, close_deleted: bool = False) -> DataFrame:
    """What the open rows become with one more snapshot: open rows, and those that it closes.

    Rows that are closed already take no part, so a store can leave them where they are.
    """
    data, opened = list(current.columns), current.withColumns({"valid_from": F.lit(as_of), "valid_to": F.lit(None).cast("date")})
    history = evolve_schema(live, current)
    live = history.select(F.struct("*").alias("old"), F.col(key).alias("_key"))
    fresh = opened.select(F.struct("*").alias("new"), F.col(key).alias("_key"))
    same = F.lit(True)
    for c in data:
        same &= F.col(f"old.{c}").cast("string").eqNullSafe(F.col(f"new.{c}").cast("string"))
    had, has = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = had & has & ~same
    ends = changed | (had & ~has if close_deleted else F.lit(False))
    columns = history.columns

    def old_row() -> Column:
        parts = [
            F.when(ends, F.lit(as_of)).otherwise(F.col("old.valid_to")).alias(c) if c == "valid_to" else F.col(f"old.{c}").alias(c)
            for c in columns
        ]
        return F.when(had, F.struct(*parts))

    def new_row() -> Column:
        parts = [
            (F.col(f"new.{f.name}") if f.name in opened.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in history.schema.fields
        ]
        return F.when(has & (~had | changed), F.struct(*parts))

    return live.join(fresh, "_key", "full_outer").select(F.inline(F.array_compact(F.array(old_row(), new_row()))))


def known_corrections(corrections: DataFrame) -> DataFrame:
    """Corrections of a known entity kind, with that kind in canonical spelling."""
    kind = F.lower(F.trim("entity_type"))
    return corrections.withColumn("entity_type", kind).filter(kind.isin(list(CORRECTION_TARGETS)))


def apply_corrections(facts: DataFrame, corrections: DataFrame, entity: str) -> DataFrame:
    """Set corrected fields on all rows of the corrected ids; of several patches the last one counts.

    Patches follow the number in their id, then its text; field names match whatever their case. Corrections
    with a column ``_delivery`` follow that number first, and leave rows of later batches (``_batch_id``) as
    they were delivered.

    Patches become one row per id with a (changed, value) pair per field - an aggregation bounded by
    the number of columns - so the facts take a single left join whatever the number of patches. A
    patch to nothing (blank) sets NULL, which differs from no patch.
    """
    _, key = CORRECTION_TARGETS[entity]
    if key not in facts.columns:
        return facts
    fields = [c for c in facts.columns if c != "_batch_id"]
    number = F.regexp_extract("correction_id", r"(\d+)", 1).try_cast("decimal(38,0)")
    dated = "_delivery" in corrections.columns
    delivery = F.col("_delivery") if dated else F.lit(0)
    known = (
        known_corrections(corrections)
        .withColumn("_field", F.lower(F.trim("field_corrected")))
        .filter((F.col("entity_type") == entity) & F.col("_field").isin([c.lower() for c in fields]) & F.col("entity_id").isNotNull())
    )
    patch = F.struct(F.nullif(F.col("new_value"), F.lit("")).alias("value"), delivery.alias("delivery"))
    order = F.struct(delivery, number, "correction_id")
    own = {c: F.col("_field") == c.lower() for c in fields}
    patches = known.groupBy(F.col("entity_id").alias("_id")).agg(
        *[F.max_by(F.when(own[c], patch), F.when(own[c], order)).alias(f"_p_{c}") for c in fields]
    )

    def patched(c: str) -> Column:
        if c not in fields:
            return F.col(c)
        value = F.col(f"_p_{c}.value").cast(facts.schema[c].dataType)
        known = F.col(f"_p_{c}").isNotNull()
        if dated and "_batch_id" in facts.columns:
            known &= F.col("_batch_id").cast("int") <= F.col(f"_p_{c}.delivery")
        return F.when(known, value).otherwise(F.col(c)).alias(c)

    return facts.join(patches, F.col(key).cast("string") == F.col("_id"), "left").select(
        *[patched(c) for c in facts.columns]
    )
