"""The raw store's snapshots, patch log and history, and layers rebuilt in part."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from retentia import Params
from retentia.operators.merge import apply_corrections, scd2_snapshot
from retentia.plans import incremental, ingest, revenue
from retentia.plans.ingest import RawStore, load_batch
from retentia.sources import batches
from retentia.sources.snapshots import Conflict

CORRECTIONS = "correction_id string, entity_type string, entity_id string, field_corrected string, new_value string"


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def files(df):
    return {f.split("/out/")[1] for f in df.inputFiles()}


@pytest.fixture()
def raw(spark, tmp_path):
    return RawStore(spark, str(tmp_path / "out"))


def invoices(spark, rows):
    return spark.createDataFrame(rows, "invoice_id string, status string, amount string")


def patches(spark, *rows):
    return spark.createDataFrame([(f"C{n}", "invoice", i, f, v) for n, i, f, v in rows], CORRECTIONS)


STATUS = ("invoice_id", "status", "amount", "_batch_id")


def test_patches_are_logged_merged_and_compacted(spark, raw):
    raw.load_fact("invoices", invoices(spark, [("I1", "open", "1"), ("I2", "open", "2")]), 1)
    raw.load_fact("invoices", invoices(spark, [("I3", "open", "3")]), 2)
    raw.load_fact("invoices", invoices(spark, [("I1", "late", "9")]), 3)
    before = files(raw.fact("invoices"))
    raw.correct(patches(spark, (1, "I1", "status", "paid"), (2, "I1", "amount", "5")), 1)
    raw.correct(patches(spark, (1, "I1", "status", "void"), (7, "I9", "status", "x")), 2)
    want = [("I1", "late", "9", 3), ("I1", "void", "5", 1), ("I2", "open", "2", 1), ("I3", "open", "3", 2)]
    assert rows_of(raw.fact("invoices"), *STATUS) == want  # a patch leaves later batches alone
    assert before < files(raw.fact("invoices")) and len([f for f in files(raw.fact("invoices")) if f.startswith("fact/")]) == len(before)

    assert raw.compact("invoices") == [1]  # the one batch that holds a corrected id
    assert rows_of(raw.fact("invoices"), *STATUS) == want
    assert not any(f.startswith("patches/") for f in files(raw.fact("invoices")))
    assert raw.compact("invoices") == []

    raw.correct(patches(spark, (1, "I2", "amount", "22")), 3)  # later patches go on top of what is merged
    want[2] = ("I2", "open", "22", 1)
    assert rows_of(raw.fact("invoices"), *STATUS) == want
    raw.correct(patches(spark, (1, "I1", "status", "again")), 1)  # delivered again: what it said before is gone
    want[1] = ("I1", "void", "1", 1)
    assert rows_of(raw.fact("invoices"), *STATUS) == sorted(want)
    raw.load_fact("invoices", invoices(spark, [("I1", "new", "7")]), 1)  # loaded again: still patched
    assert rows_of(raw.fact("invoices"), *STATUS) == sorted([want[0], ("I1", "void", "7", 1), want[3]])
    raw.compact("invoices")
    assert rows_of(raw.fact("invoices"), *STATUS) == sorted([want[0], ("I1", "void", "7", 1), want[3]])


def test_log_equals_the_operator(spark, raw):
    """Reading through the log, before and after compaction, against one application of all corrections."""
    rows = [(f"I{i}", "open", str(i)) for i in range(200)]
    raw.load_fact("invoices", invoices(spark, rows[:150]), 1)
    raw.load_fact("invoices", invoices(spark, rows[150:]), 2)
    fixes = patches(spark, *[(i, f"I{i * 7 % 230}", ("status", "amount", "nothing")[i % 3], None if i % 5 == 0 else f"v{i}") for i in range(90)])
    plain = rows_of(apply_corrections(raw.fact("invoices"), fixes, "invoice").na.fill("-"), *STATUS)
    raw.correct(fixes, 2)
    assert rows_of(raw.fact("invoices").na.fill("-"), *STATUS) == plain
    assert raw.compact("invoices") == [1, 2]
    assert rows_of(raw.fact("invoices").na.fill("-"), *STATUS) == plain


def deliver(folder, **tables):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in tables.items():
        (folder / f"{name}.csv").write_text(text)


def test_a_load_that_is_cut_off_changes_nothing(spark, raw, tmp_path, monkeypatch):
    one, two = batches.Batch("batch_001", 1), batches.Batch("batch_002", 2)
    deliver(tmp_path / "in" / one.name, customers="customer_id,region\nC1,old\n", invoices="invoice_id,status\nI1,open\n")
    deliver(
        tmp_path / "in" / two.name, customers="customer_id,region\nC1,new\n", invoices="invoice_id,status\nI2,open\n", payments="payment_id\nP1\n",
        corrections="correction_id,entity_type,entity_id,field_corrected,new_value\nC1,invoice,I1,status,void\n",
    )
    root = str(tmp_path / "in")
    load_batch(raw, root, one)

    def state():
        tables = raw.tables()
        return {t: sorted(map(tuple, df.collect())) for t, df in tables.items()}

    first = state()
    for step in ("load_fact", "correct"):
        with monkeypatch.context() as patched:
            done = []
            original = getattr(RawStore, step)

            def failing(self, name, *args, original=original, done=done):
                if step == "correct" or name == "payments":
                    raise OSError("lost")
                done.append(name)
                return original(self, name, *args)

            patched.setattr(RawStore, step, failing)
            with pytest.raises(OSError):
                load_batch(raw, root, two)
        assert state() == first and RawStore(spark, raw.path).snapshots.numbers() == [1]
    load_batch(raw, root, two)
    assert state() == {"customers": [("C1", "new")], "invoices": [("I1", "void", 1), ("I2", "open", 2)], "payments": [("P1", 2)]}
    removed = raw.clean()
    assert removed >= 4 and state()["invoices"] == [("I1", "void", 1), ("I2", "open", 2)] and raw.clean() == 0


def test_readers_and_writers(spark, raw):
    raw.load_fact("invoices", invoices(spark, [("I1", "open", "1")]), 1)
    reader, other = raw.fact("invoices"), RawStore(spark, raw.path)
    with pytest.raises(Conflict), raw.change():
        raw.load_fact("invoices", invoices(spark, [("I1", "mine", "1")]), 1)
        other.load_fact("invoices", invoices(spark, [("I1", "theirs", "1")]), 1)
    assert rows_of(reader, "status") == [("open",)] and rows_of(raw.fact("invoices"), "status") == [("theirs",)]
    assert raw.snapshots.state(1) != raw.snapshots.state(2) and raw.snapshots.numbers() == [1, 2]


def test_types_must_agree(spark, raw):
    raw.load_fact("invoices", spark.createDataFrame([("I1", 1)], "invoice_id string, amount int"), 1)
    raw.load_fact("invoices", spark.createDataFrame([("I2", "x")], "invoice_id string, amount string"), 2)
    with pytest.raises(ValueError, match="type of amount"):
        raw.fact("invoices")


def test_closed_history_is_not_touched(spark, raw):
    states = [[("C1", "a"), ("C2", "a")], [("C1", "b"), ("C2", "a"), ("C3", "a")], [("C1", "b"), ("C2", "c"), ("C3", "a")], [("C1", "b")]]
    expected, seen = None, set()
    for month, rows in enumerate(states, 1):
        now = spark.createDataFrame(rows, "customer_id string, status string")
        if month >= 3:
            now = now.withColumn("tier", F.lit(None if month == 3 else "t"))
        raw.sync_dimension("customers", now, date(2024, month, 28), month)
        expected = scd2_snapshot(expected, raw.dimension("customers").read(), "customer_id", date(2024, month, 28))
        columns = [c for c in expected.columns if c != "tier"]
        assert rows_of(raw.history("customers").read().na.fill("-").withColumn("valid_to", F.col("valid_to").cast("string")), *columns[:3]) == rows_of(expected, *columns[:3])
        closed = set(raw.snapshots.state()["history"]["customers"]["closed"])
        assert seen <= closed
        seen = closed
    ended = raw.history("customers").read().filter("valid_to IS NOT NULL")
    assert rows_of(ended, "customer_id", "status") == [("C1", "a"), ("C1", "b"), ("C2", "a")]


# --- layers ---

CUSTOMERS = "customer_id string, company_name string, industry string, country string, region string, account_tier string, account_owner string, status string"


@pytest.fixture()
def inputs(spark):
    from retentia.plans.core import CUSTOMER_CONTEXT

    context = [c for c in CUSTOMER_CONTEXT]
    customers = spark.range(60).select(
        F.format_string("CUST-%03d", "id").alias("customer_id"), F.when(F.col("id") % 3 == 0, "EMEA").otherwise("NA").alias("region"),
        *[F.lit(c).alias(c) for c in context if c != "region"], F.lit("active").alias("status"),
    )
    subscriptions = spark.range(60).select(
        F.format_string("S%d", "id").alias("subscription_id"), F.format_string("CUST-%03d", "id").alias("customer_id"), F.lit("active").alias("status"),
        F.lit(100).cast("decimal(12,2)").alias("mrr"), F.lit(date(2023, 12, 5)).alias("start_date"), F.lit(None).cast("date").alias("end_date_resolved"),
    )
    amendments = spark.createDataFrame([("CUST-004", 50, date(2024, 2, 3))], "customer_id string, d int, effective_date date")
    amendments = amendments.select("customer_id", F.col("d").cast("decimal(13,2)").alias("mrr_delta"), "effective_date")
    health = customers.select("customer_id", F.lit(70).alias("health_score"), F.lit(0).cast("decimal(22,2)").alias("mrr_at_risk"))
    return {"customers": customers, "subscriptions": subscriptions, "amendments": amendments, "health": health}


def full(i):
    moved = revenue.mrr_movements(revenue.customer_months(i["customers"], i["subscriptions"], i["amendments"]), i["customers"])
    return moved, revenue.mart_mrr(moved, i["health"]), revenue.mart_nrr(moved)


def test_only_touched_buckets_are_read_and_replaced(spark, inputs, tmp_path):
    layers = incremental.Layers(spark, str(tmp_path / "out"), buckets=8)
    for name, df in inputs.items():
        layers.put(name, df, "1" if name == "amendments" else "all")
    assert all(len(b) == 8 for b in incremental.build_revenue(layers).values())
    assert incremental.build_revenue(layers) == {"movements": [], "mart_mrr": [], "nrr_sums": []}
    stored = files(layers.read("mart_mrr"))

    batch = inputs["amendments"].withColumn("customer_id", F.lit("CUST-009")).withColumn("mrr_delta", F.lit(-30).cast("decimal(13,2)"))
    touched = layers.put("amendments", batch, "2")
    assert len(touched) == 1 and layers.put("amendments", batch, "2") == []
    read = []
    rebuilt = layers.build("movements", ["customers", "subscriptions", "amendments"], lambda *dfs: read.extend(dfs) or revenue.mrr_movements(revenue.customer_months(*dfs), dfs[0]), repr(Params()))
    assert rebuilt == touched
    assert {f.split("_bucket=")[1].split("/")[0] for df in read for f in files(df)} == {str(touched[0])}
    assert "InMemoryFileIndex(1 paths)" in read[0]._jdf.queryExecution().executedPlan().toString()
    assert incremental.build_revenue(layers) == {"movements": [], "mart_mrr": touched, "nrr_sums": touched}

    inputs["amendments"] = inputs["amendments"].unionByName(batch)
    _, mrr, nrr = full(inputs)
    assert rows_of(layers.read("mart_mrr"), "customer_id", "mrr_month", "mrr_movement", "mrr", "contraction_mrr") == rows_of(
        mrr, "customer_id", "mrr_month", "mrr_movement", "mrr", "contraction_mrr"
    )
    assert rows_of(incremental.stored_nrr(layers), *nrr.columns) == rows_of(nrr, *nrr.columns)
    now = files(layers.read("mart_mrr"))
    assert {f for f in stored - now} and all(f"_bucket={touched[0]}/" in f for f in stored ^ now)


def test_rows_are_told_apart_without_spelling_them_out(spark, tmp_path):
    """Fingerprints of plain columns hash the values themselves; NULLs, which a hash skips, count by their place."""
    layers, columns = incremental.Layers(spark, str(tmp_path / "out"), buckets=1), "customer_id string, a string, b string, c double"
    versions = [("x", None, 0.0), (None, "x", 0.0), ("x", "", 0.0), ("", "x", 0.0), ("x", "", -0.0), ("x", None, None)]
    for a, b, c in versions:
        rows = spark.createDataFrame([("C1", a, b, c)], columns)
        assert layers.put("t", rows) == [0] and layers.put("t", rows) == []
    plan = rows.select(*incremental._hashed(rows))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("to_json") == 1  # of the float, whose two zeros have one hash


def test_changed_dimensions_parameters_and_removed_rows(spark, inputs, tmp_path):
    layers = incremental.Layers(spark, str(tmp_path / "out"), buckets=8)
    for name, df in inputs.items():
        layers.put(name, df)
    incremental.build_revenue(layers)
    moved = inputs["customers"].withColumn("region", F.when(F.col("customer_id") == "CUST-007", "APAC").otherwise(F.col("region")))
    inputs["customers"] = moved.filter("customer_id <> 'CUST-011'")
    inputs["subscriptions"] = inputs["subscriptions"].filter("customer_id <> 'CUST-011'")
    touched = set(layers.put("customers", inputs["customers"])) | set(layers.put("subscriptions", inputs["subscriptions"]))
    assert len(touched) <= 2
    layers = incremental.Layers(spark, str(tmp_path / "out"), buckets=99)  # the stored number holds
    assert set(incremental.build_revenue(layers)["movements"]) == touched
    _, mrr, nrr = full(inputs)
    assert rows_of(layers.read("mart_mrr"), "customer_id", "mrr_month", "region", "mrr") == rows_of(mrr, "customer_id", "mrr_month", "region", "mrr")
    assert rows_of(incremental.stored_nrr(layers), *nrr.columns) == rows_of(nrr, *nrr.columns)
    other = Params(months=(date(2024, 2, 1), date(2024, 3, 1)))
    assert len(incremental.build_revenue(layers, other)["movements"]) == 8
    assert layers.clean() > 0 and layers.read("mart_mrr").select("mrr_month").distinct().count() == 2
    with pytest.raises(ValueError, match="columns of 2"):
        layers.put("amendments", inputs["amendments"].drop("mrr_delta"), "2")


def test_empty_layers(spark, inputs, tmp_path):
    layers = incremental.Layers(spark, str(tmp_path / "out"), buckets=4)
    for name, df in inputs.items():
        layers.put(name, df.limit(0))
    incremental.build_revenue(layers)
    assert layers.read("mart_mrr").count() == 0 and incremental.stored_nrr(layers).count() == 0


def test_load_summary_of_snapshots(spark, raw):
    raw.load_fact("invoices", invoices(spark, [("I1", "open", "1")]), 1)
    raw.load_fact("invoices", invoices(spark, []), 2)
    assert [tuple(r) for r in ingest.load_summary(raw.tables()).collect()] == [("invoices", 1, 1)]


def test_batches_are_compacted_by_one_join(spark, raw, monkeypatch):
    """Three touched batches, one without the column of a patch, one that a patch of a later delivery does not reach."""
    raw.load_fact("invoices", spark.createDataFrame([("I1", "open"), ("I2", "open")], "invoice_id string, status string"), 1)
    raw.load_fact("invoices", invoices(spark, [("I1", "open", "1"), (None, "open", "2")]), 2)
    raw.load_fact("invoices", invoices(spark, [("I1", "late", "3"), ("I3", "late", "4")]), 3)
    raw.load_fact("invoices", invoices(spark, [("I4", "late", "5")]), 4)
    raw.correct(patches(spark, (1, "I1", "status", "paid"), (2, "I1", "amount", "7"), (3, None, "status", "x")), 2)
    raw.correct(patches(spark, (9, "I3", "status", "void")), 3)
    joins, apply = [], ingest.apply_corrections
    monkeypatch.setattr(ingest, "apply_corrections", lambda *args: joins.append(args) or apply(*args))
    assert raw.compact("invoices") == [1, 2, 3] and len(joins) == 1
    want = [("I1", "late", "3", 3), ("I1", "paid", "7", 2), ("I1", "paid", "-", 1), ("I2", "open", "-", 1), ("I3", "void", "4", 3), ("I4", "late", "5", 4), ("-", "open", "2", 2)]
    assert rows_of(raw.fact("invoices").na.fill("-"), *STATUS) == sorted(want) and len(joins) == 1
    assert raw.clean() == 0 and rows_of(raw.fact("invoices").na.fill("-"), *STATUS) == sorted(want)
    assert all(f.startswith("_batch_id=") for f in batches.folders(spark, f"{raw.path}/fact/invoices"))


def test_an_id_beyond_the_first_ones_is_found(spark, raw, monkeypatch):
    monkeypatch.setattr(ingest, "PROBE", 1)
    raw.load_fact("invoices", invoices(spark, [("I7", "open", "1")]), 1)
    raw.correct(patches(spark, *[(i, f"I{i}", "status", "paid") for i in range(9)]), 1)
    assert raw.compact("invoices") == [1] and rows_of(raw.fact("invoices"), *STATUS) == [("I7", "paid", "1", 1)]


def test_patches_are_shuffled_once(spark):
    fixes, facts = patches(spark, (1, "I1", "status", "x")), invoices(spark, [("I1", "open", "1")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = apply_corrections(facts, fixes, "invoice")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # facts and patches


def test_deliveries_and_stored_files_are_compressed(spark, raw, tmp_path):
    from verification.ingest_queries import deliver

    rows = invoices(spark, [("I1", " open", None), ("I2", 'a "b", c', "2")])
    deliver(rows, str(tmp_path / "in"), batches.BATCHES[0], "invoices")
    written = [p.name for p in (tmp_path / "in" / "batch_001" / "invoices.csv").iterdir() if p.name.startswith("part-")]
    assert written and all(n.endswith(".csv.gz") for n in written)
    load_batch(raw, str(tmp_path / "in"), batches.BATCHES[0])
    assert rows_of(raw.fact("invoices").na.fill("-"), *STATUS) == [("I1", " open", "-", 1), ("I2", 'a "b", c', "2", 1)]
    assert all(f.endswith(".zstd.parquet") for f in files(raw.fact("invoices")))
