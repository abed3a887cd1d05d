"""Sources, sinks, merges, corrections and history. Files go to a fresh folder per run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from retentia.operators import merge
from retentia.plans import incremental, ingest, signals
from retentia.plans.staging import stg_usage_events, union_late_events
from retentia.session import scratch_dir
from retentia.sources import batches, store
from retentia.streaming.ingest_stream import stream_deliveries
from retentia.streaming.latest_stream import update_latest, usage_table
from verification.core_queries import _MOVEMENT_NUMBERS, WATERFALL
from verification.models import stored_health
from verification.oracle import oracle
from verification.registry import query
from verification.report_queries import raw_tables, rows_per_batch

# --- deliveries -------------------------------------------------------------------------------


def deliver(df: DataFrame, root: str, batch: batches.Batch, table: str) -> None:
    """Write one delivery as an exporting system would: a header in its own spelling, blanks for NULL, files compressed."""
    shouting = df.toDF(*[f" {c.upper()} " for c in df.columns])
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "compression": "gzip"}
    shouting.write.options(**options).csv(f"{root}/{batch.name}/{table}.csv")


def delivered_batches(m, raw: str, table: str) -> tuple[str, list[batches.Batch]]:
    """Export a raw table as one delivery per batch."""
    root, rows = scratch_dir(m.spark, "deliveries"), m.raw(raw)
    found = list(batches.BATCHES)
    for b in found:
        deliver(rows.filter(F.col("_batch_id") == str(b.batch_id)).drop("_batch_id"), root, b, table)
    return root, found


_BLANKS_AS_NULL = "SELECT nullif(COLUMNS(*), '') FROM {}"


@query("read_dim_batch", oracle(_BLANKS_AS_NULL.format("raw_customers")))
def _(m):
    root, first = scratch_dir(m.spark, "deliveries"), batches.BATCHES[0]
    deliver(m.raw("raw_customers"), root, first, "customers")
    assert batches.read_dim_batch(m.spark, root, batches.BATCHES[1], "customers") is None
    return batches.read_dim_batch(m.spark, root, first, "customers")


@query("read_fact_batch", oracle(_BLANKS_AS_NULL.format("raw_adjustments")))
def _(m):
    root, found = delivered_batches(m, "raw_adjustments", "adjustments")
    first, second, third = [batches.read_fact_batch(m.spark, root, b, "adjustments") for b in found]
    return first.unionByName(second).unionByName(third)


@query("evolve_schema", oracle("SELECT customer_id, event_date, metric_name, quantity, _batch_id, CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS BIGINT) AS _row_seq FROM raw_usage_events"))
def _(m):
    before = m.raw("raw_usage_events").drop("unit", "_row_seq")
    return merge.evolve_schema(before, m.raw("raw_late_usage"))


@query("append_fact_batch", oracle("SELECT * REPLACE (CAST(_batch_id AS INTEGER) AS _batch_id) FROM raw_invoices"))
def _(m):
    path, rows = scratch_dir(m.spark, "store") + "/invoices", m.raw("raw_invoices")
    stale = rows.filter("_batch_id = '3'").withColumn("status", F.lit("draft"))
    store.write_fact_batch(stale, path, 3)
    for b in batches.BATCHES:
        store.write_fact_batch(rows.filter(F.col("_batch_id") == str(b.batch_id)), path, b.batch_id)
    return store.read_fact(m.spark, path)


@query("append_batch", oracle("SELECT * FROM raw_invoices"))
def _(m):
    rows = m.raw("raw_invoices")
    stale = rows.withColumn("status", F.when(F.col("_batch_id") == "3", F.lit("draft")).otherwise(F.col("status")))
    return merge.append_batch(stale, rows.filter("_batch_id = '3'"), 3)


# --- merge and history ------------------------------------------------------------------------


def customer_states(m) -> list[DataFrame]:
    """The customer file at two dates: trial customers come later, churned ones go, suspended ones change owner."""
    rows = m.raw("raw_customers").withColumn("status", F.trim("status"))
    earlier = rows.filter("status <> 'trial'")
    owner = F.when(F.col("status") == "suspended", F.lit("collections")).otherwise(F.col("account_owner"))
    later = rows.filter("status <> 'Churned'").withColumn("account_owner", owner)
    return [earlier, later]


_CUSTOMERS = "(SELECT * REPLACE (trim(status) AS status) FROM raw_customers)"
_LATER_OWNER = "CASE status WHEN 'suspended' THEN 'collections' ELSE account_owner END"


@query("merge_dimension", oracle(f"SELECT * REPLACE ({_LATER_OWNER} AS account_owner) FROM {_CUSTOMERS} WHERE status <> 'Churned'"))
def _(m):
    return merge.merge_dimension(*customer_states(m), "customer_id")


@query(
    "merge_dimension_stats",
    oracle(f"""SELECT CASE status WHEN 'trial' THEN 'insert' WHEN 'Churned' THEN 'delete' WHEN 'suspended' THEN 'update' ELSE 'unchanged' END AS action,
               count(*) AS rows FROM {_CUSTOMERS} GROUP BY ALL"""),
)
def _(m):
    return merge.merge_stats(*customer_states(m), "customer_id")


@query(
    "scd2_snapshot",
    oracle(f"""SELECT customer_id, status, account_owner, DATE '2024-01-31' AS valid_from,
                 CASE WHEN status IN ('suspended', 'Churned') THEN DATE '2024-02-29' END AS valid_to FROM {_CUSTOMERS} WHERE status <> 'trial'
               UNION ALL SELECT customer_id, status, {_LATER_OWNER}, DATE '2024-02-29', CAST(NULL AS DATE) FROM {_CUSTOMERS}
               WHERE status IN ('trial', 'suspended')"""),
)
def _(m):
    earlier, later = customer_states(m)
    opened = merge.scd2_snapshot(None, earlier, "customer_id", date(2024, 1, 31))
    grown = merge.scd2_snapshot(opened, later, "customer_id", date(2024, 2, 29), close_deleted=True)
    return grown.select("customer_id", "status", "account_owner", "valid_from", "valid_to")


_PATCH = """(SELECT entity_id, new_value FROM raw_corrections WHERE entity_type = 'invoice' AND field_corrected = '{}'
    QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY correction_id DESC) = 1)"""
_PATCHED = ("customer_id", "invoice_date", "amount", "status")


@query(
    "apply_corrections",
    oracle(f"""SELECT i.* REPLACE ({", ".join(f"CASE WHEN p_{c}.entity_id IS NULL THEN i.{c} ELSE nullif(p_{c}.new_value, '') END AS {c}" for c in _PATCHED)})
               FROM raw_invoices i {" ".join(f"LEFT JOIN {_PATCH.format(c)} p_{c} ON p_{c}.entity_id = i.invoice_id" for c in _PATCHED)}"""),
)
def _(m):
    return merge.apply_corrections(m.raw("raw_invoices"), m.raw("raw_corrections"), "invoice")


@query(
    "invalid_corrections",
    oracle("""SELECT c.correction_id, lower(trim(c.entity_type)) AS entity_type, c.entity_id, c.field_corrected, c.new_value,
                i.invoice_id IS NULL AS unknown_entity,
                coalesce((c.field_corrected = 'invoice_date' AND TRY_CAST(c.new_value AS DATE) IS NULL)
                  OR (c.field_corrected = 'amount' AND TRY_CAST(c.new_value AS DECIMAL(12,2)) IS NULL), false) AS invalid_value
              FROM raw_corrections c LEFT JOIN (SELECT DISTINCT invoice_id FROM raw_invoices WHERE status <> 'void') i ON i.invoice_id = c.entity_id
              WHERE c.entity_type = 'invoice' AND (unknown_entity OR invalid_value)"""),
)
def _(m):
    # voided invoices are no valid target
    live = m.raw("raw_invoices").filter("status <> 'void'")
    types = {"invoice_date": "date", "amount": "decimal(12,2)"}
    return ingest.invalid_corrections(m.raw("raw_corrections"), live, "invoice", types)


@query(
    "rejected_corrections",
    oracle("""SELECT correction_id, entity_type, entity_id, field_corrected, new_value,
                CASE WHEN entity_type = 'unknown' THEN 'unknown entity type' ELSE 'unknown field' END AS reason
              FROM raw_corrections WHERE entity_type = 'unknown' OR field_corrected = 'status'"""),
)
def _(m):
    # as before the deliveries had a status
    columns = [c for c in m.raw("raw_invoices").columns if c != "status"]
    return ingest.rejected_corrections(m.raw("raw_corrections"), {"invoices": columns})


@query("load_summary", oracle(rows_per_batch(width=False)))
def _(m):
    return store.load_summary(raw_tables(m))


@query("union_late_events", oracle("SELECT * FROM raw_usage_events UNION ALL BY NAME SELECT * FROM raw_late_usage"))
def _(m):
    return union_late_events(m.raw("raw_usage_events"), m.raw("raw_late_usage"))


# --- persisted models -------------------------------------------------------------------------


@query("materialise", oracle("SELECT * EXCLUDE (first_export, age) FROM latest_tickets", DOUBLE="resolution_hours satisfaction_score"))
def _(m):
    return store.materialise(m.latest_tickets, scratch_dir(m.spark, "model"))


@query("read_model", oracle("SELECT customer_id, company_name, employee_count FROM dim_customers WHERE region = 'ASIA' AND employee_count >= 100"))
def _(m):
    path = scratch_dir(m.spark, "model")
    store.materialise(m.dim_customers, path)
    wanted = "SELECT customer_id, company_name, employee_count FROM {model} WHERE region = ? AND employee_count >= ?"
    return store.read_model(m.spark, path, wanted, ["ASIA", 100])


@query("export_csv", oracle("SELECT * FROM support_rollup", DOUBLE="min_satisfaction_score max_resolution_hours"))
def _(m):
    path, table = scratch_dir(m.spark, "export"), signals.support_rollup(m.ticket_states)
    store.export_csv(table, path)
    return m.spark.read.option("header", True).schema(table.schema).csv(path)


@query("stream_ingest", oracle("SELECT nullif(COLUMNS(* EXCLUDE (_batch_id, _row_seq)), ''), CAST(_batch_id AS INTEGER) AS _batch_id FROM raw_payments"))
def _(m):
    root, found = scratch_dir(m.spark, "deliveries"), list(batches.BATCHES)
    rows = m.raw("raw_payments").drop("_row_seq")
    target = ingest.RawStore(m.spark, scratch_dir(m.spark, "store"))
    checkpoint = scratch_dir(m.spark, "stream")
    for b in found:
        mine = rows.filter(F.col("_batch_id") == str(b.batch_id)).drop("_batch_id")
        deliver(mine, root, b, "payments")
        stream_deliveries(target, root, checkpoint).awaitTermination()
    return target.fact("payments")


@query("stream_latest_usage", oracle("SELECT * FROM latest_usage", DOUBLE="quantity"))
def _(m):
    """Usage as it is delivered, late files last: most of these are older than the days that the stream still holds."""
    landing, late, checkpoint = scratch_dir(m.spark, "landing"), m.raw("raw_late_usage"), scratch_dir(m.spark, "stream")
    target = usage_table(m.spark, scratch_dir(m.spark, "latest"))
    regular = m.raw("raw_usage_events")
    for rows in [regular.filter(F.col("_batch_id") == str(b.batch_id)) for b in batches.BATCHES] + [late]:
        rows.write.mode("append").parquet(landing)
        arrived = m.spark.readStream.schema(regular.schema).parquet(landing)
        update_latest(stg_usage_events(arrived), target, checkpoint, "35 days")
    return target.read().drop("_row_seq")


_CORRECTED_INVOICES = oracle("""SELECT invoice_id, nullif(customer_id, '') AS customer_id, status, amount, CAST(_batch_id AS INTEGER) AS _batch_id FROM (
                SELECT i.* REPLACE (CASE p.field_corrected WHEN 'status' THEN p.new_value ELSE i.status END AS status,
                  CASE p.field_corrected WHEN 'amount' THEN p.new_value ELSE i.amount END AS amount,
                  CASE p.field_corrected WHEN 'customer_id' THEN p.new_value ELSE i.customer_id END AS customer_id)
                FROM raw_invoices i LEFT JOIN (SELECT * FROM raw_corrections WHERE entity_type = 'invoice') p ON p.entity_id = i.invoice_id)""")


@query("load_batches", _CORRECTED_INVOICES)
def _(m):
    """Whole deliveries: three batches of invoices, corrections with the last one."""
    return corrected_store(m).fact("invoices").select(*_CORRECTED)


_CORRECTED = ("invoice_id", "customer_id", "status", "amount", "_batch_id")


def corrected_store(m) -> ingest.RawStore:
    root, found = delivered_batches(m, "raw_invoices", "invoices")
    deliver(m.raw("raw_corrections"), root, found[-1], "corrections")
    target = ingest.RawStore(m.spark, scratch_dir(m.spark, "store"))
    ingest.load_batches(target, root, tuple(found))
    return target


@query("compact_corrections", _CORRECTED_INVOICES)
def _(m):
    """The same rows once the patches are merged into the batches they touch."""
    target = corrected_store(m)
    target.compact("invoices")
    return target.fact("invoices").select(*_CORRECTED)


@query(
    "read_during_reload",
    oracle("""SELECT reader, CAST(_batch_id AS INTEGER) AS _batch_id, CASE WHEN _batch_id = '3' AND reader = 'before' THEN 'draft' ELSE status END AS status,
                count(*) AS rows FROM raw_invoices CROSS JOIN (SELECT 'before' AS reader UNION ALL SELECT 'after') r GROUP BY ALL"""),
)
def _(m):
    """A reader that began before a batch was loaded again sees the old rows to the end, a later one the new rows."""
    rows, target = m.raw("raw_invoices"), ingest.RawStore(m.spark, scratch_dir(m.spark, "store"))
    third = F.col("_batch_id") == "3"
    with target.change():
        for b in batches.BATCHES:
            target.load_fact("invoices", rows.filter(F.col("_batch_id") == str(b.batch_id)).withColumn("status", F.when(third, "draft").otherwise(F.col("status"))), b.batch_id)
    before = target.fact("invoices")
    target.load_fact("invoices", rows.filter(third), 3)
    parts = [df.select(F.lit(name).alias("reader"), "_batch_id", "status") for name, df in (("before", before), ("after", target.fact("invoices")))]
    return parts[0].unionByName(parts[1]).groupBy("reader", "_batch_id", "status").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "stored_history",
    oracle(f"""SELECT customer_id, status, account_owner, DATE '2024-01-31' AS valid_from,
                 CASE WHEN status = 'suspended' THEN DATE '2024-02-29' END AS valid_to FROM {_CUSTOMERS} WHERE status <> 'trial'
               UNION ALL SELECT customer_id, status, {_LATER_OWNER}, DATE '2024-02-29', CAST(NULL AS DATE) FROM {_CUSTOMERS}
               WHERE status IN ('trial', 'suspended')"""),
)
def _(m):
    """History as the store keeps it: closed rows are added to, only open ones are written anew."""
    target = ingest.RawStore(m.spark, scratch_dir(m.spark, "store"))
    for state, as_of in zip(customer_states(m), (date(2024, 1, 31), date(2024, 2, 29))):
        target.sync_dimension("customers", state, as_of)
    return target.history("customers").read().select("customer_id", "status", "account_owner", "valid_from", "valid_to")


# --- layers that are rebuilt in part ----------------------------------------------------------


def revenue_layers(m) -> incremental.Layers:
    """Built before the last month's subscriptions and the last batch of amendments, and again after them."""
    layers = incremental.Layers(m.spark, scratch_dir(m.spark, "layers"), buckets=8)
    scores, stored = stored_health(m)[1].select("customer_id", "health_score", "mrr_at_risk"), {}
    for name, rows in (("customers", m.dim_customers), ("health", scores), ("subscriptions", m.subscriptions), ("amendments", m.amendments)):
        stored[name] = store.materialise(rows, scratch_dir(m.spark, "model"))
    early = stored["subscriptions"].filter("start_date < DATE '2024-03-01'")
    layers.put("customers", stored["customers"])
    layers.put("health", stored["health"])
    for subscriptions, batch in ((early, 2), (stored["subscriptions"], 3)):
        layers.put("subscriptions", subscriptions)
        layers.put("amendments", stored["amendments"].filter(F.col("batch_id") == batch), str(batch))
        incremental.build_revenue(layers, m.p)
    return layers


@query("incremental_mart_mrr", oracle("SELECT * FROM mart_mrr", DOUBLE=_MOVEMENT_NUMBERS + " mrr_at_risk", INTEGER="health_score"))
def _(m):
    return revenue_layers(m).read("mart_mrr")


@query("incremental_mart_nrr", oracle("SELECT * FROM mart_nrr", DOUBLE=WATERFALL + " reactivation_mrr"))
def _(m):
    return incremental.stored_nrr(revenue_layers(m))
