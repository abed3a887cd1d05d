"""Deliveries on disk: reading, idempotent loading, versions, corrections, streaming."""

from datetime import date

import pytest

from retentia.plans.ingest import RawStore, invalid_corrections, load_batch, load_batches, rejected_corrections
from retentia.sources import batches, store
from retentia.streaming.ingest_stream import stream_deliveries


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.csv").write_text(text)


@pytest.fixture()
def deliveries(tmp_path):
    one, two = tmp_path / "in" / "batch_001", tmp_path / "in" / "batch_002"
    write(one, "customers", " Customer_ID ,Region,Notes\nCUST-1,NA,\"a, \"\"b\"\"\"\nCUST-2,,-\nCUST-3,EMEA,gone\n")
    write(two, "customers", "customer_id,region,notes,tier\nCUST-1,NA,\"a, \"\"b\"\"\",\nCUST-2,APAC,-,gold\nCUST-4,NA,new,\n")
    write(one, "invoices", "invoice_id,customer_id,status\nI1,7,open\nI2,8,paid\n")
    write(two, "invoices", "invoice_id,customer_id,status,currency\nI1,7,paid,EUR\n")
    write(two, "corrections", "correction_id,entity_type,entity_id,field_corrected,old_value,new_value\nC1,invoice,I1,status,paid,void\nC2,customer,CUST-4,region,NA,EMEA\nC3,invoice,I2,customer_id,8,\n")
    return str(tmp_path / "in"), str(tmp_path / "out")


BATCHES = (batches.Batch("batch_001", 1), batches.Batch("batch_002", 2), batches.Batch("batch_009", 9))


def test_read(spark, deliveries):
    root, _ = deliveries
    df = batches.read_dim_batch(spark, root, BATCHES[0], "customers")
    assert df.columns == ["customer_id", "region", "notes"]
    assert [tuple(r) for r in df.orderBy("customer_id").collect()][:2] == [("CUST-1", "NA", 'a, "b"'), ("CUST-2", None, "-")]
    nulled = batches.read_dim_batch(spark, root, BATCHES[0], "customers", ("", "NA", "-"))
    assert [tuple(r) for r in nulled.orderBy("customer_id").collect()][:2] == [("CUST-1", None, 'a, "b"'), ("CUST-2", None, None)]
    assert batches.read_dim_batch(spark, root, BATCHES[2], "customers") is None
    assert batches.read_fact_batch(spark, root, BATCHES[1], "invoices").select("_batch_id").first()[0] == "2"


def test_load_is_idempotent(spark, deliveries):
    root, out = deliveries
    raw = RawStore(spark, out)
    as_of = {1: date(2024, 1, 31), 2: date(2024, 2, 29)}
    summary = {(r.table_name, r.batch_id): r.rows for r in load_batches(raw, root, BATCHES, as_of).collect()}
    assert summary == {("customers", None): 3, ("invoices", 1): 2, ("invoices", 2): 1}

    def state():
        customers = sorted((r.customer_id, r.region, r.tier) for r in raw.dimension("customers").read().collect())
        facts = sorted((r.invoice_id, r.customer_id, r.status, r.currency or "", r._batch_id) for r in raw.fact("invoices").collect())
        return customers, facts

    want = (
        [("CUST-1", "NA", None), ("CUST-2", "APAC", "gold"), ("CUST-4", "EMEA", None)],
        [("I1", "7", "void", "", 1), ("I1", "7", "void", "EUR", 2), ("I2", None, "paid", "", 1)],
    )
    got = state()
    assert got[0] == want[0] and [tuple(x or "" for x in r) for r in got[1]] == [tuple(x or "" for x in r) for r in want[1]]
    history = raw.history("customers").read().collect()
    assert sorted((r.customer_id, r.valid_to) for r in history if r.valid_to) == [("CUST-2", date(2024, 2, 29))]
    load_batch(raw, root, BATCHES[1])
    assert state()[0] == want[0]
    assert raw.fact("invoices").count() == 3


def test_duplicate_keys_fail(spark, tmp_path):
    write(tmp_path / "batch_001", "plans", "plan_id\nP1\nP1\n")
    with pytest.raises(ValueError, match="repeats a plan_id"):
        load_batch(RawStore(spark, str(tmp_path / "out")), str(tmp_path), BATCHES[0])


def test_versioned_table_keeps_old_versions(spark, tmp_path):
    table = store.VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    table.write(spark.range(2))
    table.write(table.read().union(spark.range(5)))
    assert (table.version, table.read().count(), table.read(1).count()) == (2, 7, 2)


def test_stream_loads_new_deliveries_only_once(spark, deliveries):
    root, out = deliveries
    raw = RawStore(spark, out)
    for _ in range(2):
        stream_deliveries(raw, root, out + "/checkpoint").awaitTermination()
        rows = sorted((r.invoice_id, r.status, r._batch_id) for r in raw.fact("invoices").collect())
        assert rows == [("I1", "void", 1), ("I1", "void", 2), ("I2", "paid", 1)]
        assert sorted((r.customer_id, r.region) for r in raw.dimension("customers").read().collect())[-1] == ("CUST-4", "EMEA")
        assert raw.dimension("customers").version == 3  # two deliveries and a correction, each once


def test_stream_keeps_the_parts_of_a_delivery(spark, tmp_path):
    """Parts in separate runs, a header in another order, line breaks in texts, an older delivery's late part."""
    root, raw = str(tmp_path / "in"), RawStore(spark, str(tmp_path / "out"))
    one, two = tmp_path / "in" / "batch_001", tmp_path / "in" / "batch_002"

    def run():
        stream_deliveries(raw, root, str(tmp_path / "checkpoint")).awaitTermination()
        return sorted((r.payment_id, r.amount, r._batch_id) for r in raw.fact("payments").collect())

    write(one / "payments.csv", "a", "payment_id,amount\nP1,10\n")
    write(one, "customers", "customer_id,region\nCUST-1,old\n")
    assert run() == [("P1", "10", 1)]
    write(two, "payments", "amount,payment_id\n20,P2\n")
    write(two, "customers", "customer_id,region\nCUST-1,new\n")
    write(two, "support_tickets", 'ticket_id,description\nT1,"two\nlines"\n')
    write(two, "corrections", "correction_id,entity_type,entity_id,field_corrected,new_value\nC1,payment,P3,amount,33\n")
    assert run() == [("P1", "10", 1), ("P2", "20", 2)]
    write(one / "payments.csv", "b", "payment_id,amount\nP3,30\n")
    write(one, "plans", "plan_id\nPLN-PRO\n")
    assert run() == [("P1", "10", 1), ("P2", "20", 2), ("P3", "33", 1)]
    assert [r.region for r in raw.dimension("customers").read().collect()] == ["new"]
    assert [r.description for r in raw.fact("support_tickets").collect()] == ["two\nlines"]


def test_only_texts_are_read_by_one_task(spark, tmp_path):
    from retentia.sources.batches import read_fact_batch

    write(tmp_path / "batch_001", "invoices", "invoice_id,amount\n" + "".join(f"I{i},{i}\n" for i in range(20_000)))
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        df = read_fact_batch(spark, str(tmp_path), BATCHES[0], "invoices")
        assert (df.select("amount").distinct().count(), df.rdd.getNumPartitions() > 1) == (20_000, True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)


def test_invalid_corrections(spark):
    schema = "correction_id string, entity_type string, entity_id string, field_corrected string, new_value string"
    rows = [("C1", "invoice", "I1", "invoice_date", "void"), ("C2", "invoice", "I1", "amount", "4.5"), ("C3", "invoice", "I9", "status", "void"),
            ("C4", "invoice", "I1", "invoice_date", None), ("C5", "robot", "I1", "status", "x")]
    facts = spark.createDataFrame([("I1",), ("I1",), (None,)], "invoice_id string")
    out = invalid_corrections(spark.createDataFrame(rows, schema), facts, "invoice", {"invoice_date": "date", "amount": "decimal(12,2)"})
    assert {r.correction_id: (r.unknown_entity, r.invalid_value) for r in out.collect()} == {"C1": (False, True), "C3": (True, False)}


def test_rejected_corrections(spark):
    schema = "correction_id string, entity_type string, entity_id string, field_corrected string, new_value string"
    rows = [("C1", " Invoice", "I1", " Status ", "void"), ("C2", "robot", "I1", "status", "x"), ("C3", "payment", "P1", "status", "x"),
            ("C4", "invoice", "I1", "colour", "x"), ("C5", None, "I1", "status", "x"), ("C6", "invoice", "I1", None, "x")]
    out = rejected_corrections(spark.createDataFrame(rows, schema), {"invoices": ["invoice_id", "STATUS", "_batch_id"]})
    assert {r.correction_id: r.reason for r in out.collect()} == {
        "C2": "unknown entity type", "C3": "table not loaded", "C4": "unknown field", "C5": "unknown entity type", "C6": "unknown field",
    }


def test_a_delivery_without_rows_replaces_the_batch(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.createDataFrame([("a", "1"), ("b", "1")], "id string, _batch_id string")
    store.write_fact_batch(rows.limit(0), path, 2)
    assert store.read_fact(spark, path).count() == 0
    store.write_fact_batch(rows, path, 1)
    store.write_fact_batch(rows, path, 2)
    store.write_fact_batch(rows.limit(0), path, 1)
    found = store.read_fact(spark, path)
    assert found.columns == ["id", "_batch_id"] and sorted(map(tuple, found.collect())) == [("a", 2), ("b", 2)]


def test_patches_follow_their_numbers(spark):
    from retentia.operators.merge import apply_corrections

    facts = spark.createDataFrame([("I1", "open"), ("I2", "open")], "invoice_id string, Status string")
    patches = [("COR-9", "invoice", "I1", " STATUS", "nine"), ("COR-10", "invoice", "I1", "status", "ten"), ("COR-1", "invoice", "I2", "nothing", "x")]
    corrections = spark.createDataFrame(patches, "correction_id string, entity_type string, entity_id string, field_corrected string, new_value string")
    assert sorted(map(tuple, apply_corrections(facts, corrections, "invoice").collect())) == [("I1", "ten"), ("I2", "open")]
