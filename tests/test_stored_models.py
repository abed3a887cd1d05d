"""Models checked while written, key sets per batch, bitmaps of distinct keys, tables by region and by bucket."""

import shutil
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from retentia import session
from retentia.operators.distinct import KeyNumbers, distinct_keys, key_bitmaps, shared_keys
from retentia.plans.audited import AuditedTables, Rejected
from retentia.plans.drift import KeySets
from retentia.plans.quality import Expectation, dq_flag_counts, profile_batch_key_drift, run_expectations
from retentia.sources.bucketed import BucketedTables
from retentia.sources.scoped import RegionTable
from verification.models import Models
from verification.registry import load_all


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


CHECKS = [
    Expectation("t", "k", "unique"),
    Expectation("t", "k", "not_null"),
    Expectation("t", "v", "accepted_values", "warn", ("x", "y")),
    Expectation("u", "k", "not_null"),
]


def table(spark, *rows):
    return spark.createDataFrame(rows, "k string, v string")


# --- checked while written --------------------------------------------------------------------


def test_published_with_the_same_report(spark, tmp_path):
    store = AuditedTables(spark, str(tmp_path))
    models = {"t": table(spark, ("a", "x"), ("b", "z"), ("c", None)), "u": table(spark, ("a", None))}
    report = store.publish(models, CHECKS)
    assert rows_of(report) == rows_of(run_expectations(models, CHECKS)) == rows_of(store.report())
    assert rows_of(store.read("t")) == rows_of(models["t"]) and store.rows("t") == 3
    assert rows_of(store.report("u")) == [repr(("u", "k", "not_null", "error", 0))]


def test_nothing_is_published_if_one_check_fails(spark, tmp_path):
    store = AuditedTables(spark, str(tmp_path))
    store.publish({"t": table(spark, ("a", "x")), "u": table(spark, ("a", "x"))}, CHECKS)
    bad = {"u": table(spark, ("b", "y")), "t": table(spark, ("a", "x"), ("a", "y"), (None, "y"))}
    with pytest.raises(Rejected, match="t.k unique: 1, t.k not_null: 1") as failed:
        store.publish(bad, CHECKS)
    assert rows_of(failed.value.report) == rows_of(run_expectations(bad, CHECKS))
    assert rows_of(store.read("u")) == [repr(("a", "x"))] and rows_of(store.read("t")) == [repr(("a", "x"))]
    assert store.clean() == 2  # what was rejected
    assert rows_of(store.read("t")) == [repr(("a", "x"))]


def test_row_checks_take_no_scan(spark, tmp_path):
    """The table is computed once, by its write, also when it has a shuffle below."""
    runs = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    rows = spark.range(1000).repartition(3).mapInArrow(once, "id long").select(F.col("id").cast("string").alias("k"))
    report = AuditedTables(spark, str(tmp_path)).publish({"u": rows}, CHECKS)
    assert runs.value == 1000 and report.first()["failures"] == 0


def test_flags_are_counted_by_the_write(spark, tmp_path):
    store = AuditedTables(spark, str(tmp_path))
    schema = "k string, dq_a boolean, region_was_inferred boolean, dq_b boolean"
    models = {
        "m": spark.createDataFrame([("a", True, False, None), ("b", True, True, None), ("c", None, False, None)], schema),
        "none": spark.createDataFrame([], schema),
        "bare": table(spark, ("a", "x")),
    }
    store.publish(models, ())
    assert rows_of(store.flags()) == rows_of(dq_flag_counts({n: models[n] for n in ("m", "none")}))
    assert {tuple(r) for r in store.flags("m").collect()} == {("m", "dq_a", 2), ("m", "region_was_inferred", 1), ("m", "dq_b", 0)}
    assert store.flags("bare").count() == 0
    store.publish({"m": models["none"]}, ())  # counts go with the table
    assert store.flags("m").agg(F.sum("rows")).first()[0] == 0


def test_empty_table_and_no_checks(spark, tmp_path):
    store = AuditedTables(spark, str(tmp_path))
    assert store.publish({"t": table(spark)}, CHECKS).agg(F.sum("failures")).first()[0] == 0
    assert store.publish({"w": table(spark, (None, None))}, CHECKS).count() == 0
    assert store.rows("t") == 0 and store.read("t").count() == 0 and store.rows("w") == 1


# --- key sets ---------------------------------------------------------------------------------


def test_drift_as_from_all_rows(spark, tmp_path):
    batches = {1: ["a", "b", "b", None], 2: ["b", "c", "d"], 4: [], 5: ["a", "a"]}
    sets = KeySets(spark, str(tmp_path), "k")
    for b in (2, 1, 5, 4):  # in any order, then one again
        sets.put(b, table(spark, *[(k, None) for k in batches[b]]))
    everything = table(spark, *[(k, str(b)) for b, ks in batches.items() for k in ks]).withColumnRenamed("v", "_batch_id")
    assert rows_of(sets.drift()) == rows_of(profile_batch_key_drift(everything, "k", [1, 2, 4, 5]))
    sets.put(2, table(spark, ("a", None), ("b", None)))
    assert rows_of(sets.drift()) == [repr(r) for r in [(1, 2, None, None), (2, 2, 0, 0), (4, 0, 0, 2), (5, 1, 1, 0)]]
    assert rows_of(sets.dropped(4)) == [repr(("a",)), repr(("b",))] and rows_of(sets.new(5)) == [repr(("a",))]
    assert sets.clean() == 1


def test_only_neighbours_are_read(spark, tmp_path):
    sets = KeySets(spark, str(tmp_path), "k")
    for b in range(1, 4):
        sets.put(b, table(spark, (str(b), None)))
    for n in (1, 2):  # the earlier sets are gone
        shutil.rmtree(tmp_path / sets._batches()[n]["folder"])
    sets.put(4, table(spark, ("3", None), ("4", None)))
    assert rows_of(sets.drift())[-1] == repr((4, 2, 1, 0))


# --- distinct keys ----------------------------------------------------------------------------


def test_counts_of_any_groups(spark, tmp_path):
    numbers = KeyNumbers(spark, str(tmp_path), "who")
    rows = spark.range(200_000).select(
        F.concat(F.lit("c"), F.col("id") * 7 % 70_001).alias("who"), (F.col("id") % 5).alias("month"), (F.col("id") % 3).alias("region")
    )
    first, later = rows.filter("month < 3"), rows.filter("month >= 2")  # the second batch repeats a month
    parts = [key_bitmaps(part, ["month", "region"], "who", numbers.extend(part)) for part in (first, later)]
    bitmaps = parts[0].unionByName(parts[1])
    for groups in (["month", "region"], ["month"], ["region"], []):
        want = rows.groupBy(*groups).agg(F.count_distinct("who").alias("n"))
        assert rows_of(distinct_keys(bitmaps, groups, "n")) == rows_of(want)
    sets = [{r[0] for r in rows.filter(F.col("month") == m).select("who").distinct().collect()} for m in (0, 4)]
    assert tuple(shared_keys(bitmaps, "month", 0, 4).first()) == (len(sets[1] - sets[0]), len(sets[0] - sets[1]), len(sets[0] & sets[1]))


def test_numbers_stay_and_nulls_do_not_count(spark, tmp_path):
    numbers = KeyNumbers(spark, str(tmp_path), "k")
    first = {r.k: (r._run, r._number) for r in numbers.extend(table(spark, ("a", "1"), ("b", "1"), (None, "1"))).collect()}
    again = {r.k: (r._run, r._number) for r in numbers.extend(table(spark, ("c", "1"), ("a", "1"))).collect()}
    assert set(first) == {"a", "b"} and first.items() < again.items() and len(set(again.values())) == 3
    assert len(numbers.snapshots.numbers()) == 2 and numbers.extend(table(spark, ("b", "2"))).count() == 3
    assert len(numbers.snapshots.numbers()) == 2
    bitmaps = key_bitmaps(table(spark, ("a", None), (None, "1"), ("a", "1")), ["v"], "k", numbers.read(table(spark)))
    assert rows_of(distinct_keys(bitmaps, ["v"], "n")) == rows_of(spark.createDataFrame([(None, 1), ("1", 1)], "v string, n long"))


def test_nothing_to_count(spark, tmp_path):
    empty = table(spark)
    bitmaps = key_bitmaps(empty, ["v"], "k", KeyNumbers(spark, str(tmp_path), "k").extend(empty))
    assert distinct_keys(bitmaps, ["v"], "n").count() == 0 and distinct_keys(bitmaps, [], "n").first()[0] == 0


# --- by region --------------------------------------------------------------------------------


@pytest.fixture()
def served(spark, tmp_path):
    rows = spark.createDataFrame([(i, ["NA", "EU/ME", None][i % 3]) for i in range(30)], "id long, region string")
    return RegionTable(spark, str(tmp_path / "served")).write(rows), rows.schema


def test_grants_decide_what_is_read(spark, served):
    stored, schema = served
    grants = spark.createDataFrame([("mia", "NA"), ("mia", "NA"), ("ali", "ALL"), ("ali", "NA"), ("bo", "LATAM"), (None, "NA"), ("zed", None)], "user string, region string")

    def seen(user):
        return {r.region: r["count"] for r in stored.granted(schema, grants, user).groupBy("region").count().collect()}

    assert stored.regions() == ["EU/ME", "NA", "UNKNOWN"]
    assert seen("mia") == {"NA": 10}
    assert seen("ali") == {"NA": 10, "EU/ME": 10, "UNKNOWN": 10}
    assert seen("bo") == seen("zed") == seen("nobody") == {}


def test_plan_prunes_folders(spark, served, tmp_path):
    stored, schema = served
    path = str(tmp_path / "grants")
    spark.createDataFrame([("mia", "NA")], "user string, region string").write.parquet(path)
    found = stored.granted(schema, spark.read.parquet(path), "mia")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    fixed = stored.read(schema).filter("region = 'NA'")
    assert "PartitionFilters: [isnotnull(region" in fixed._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 10


# --- by bucket --------------------------------------------------------------------------------


@pytest.fixture()
def bucketed(spark, tmp_path):
    tables = BucketedTables(spark, str(tmp_path / "tables"), buckets=4, hot=20)
    facts = [(i, f"k{i % 40}" if i % 3 else ("hot" if i % 2 else None)) for i in range(300)]
    tables.write("facts", spark.createDataFrame(facts, "id long, key string"), "key")
    named = [(f"k{i}", f"name {i}") for i in range(0, 40, 2)] + [("hot", "hot name"), (None, "nobody")]
    tables.write("names", spark.createDataFrame(named, "key string, name string"), "key")
    return tables, facts, dict(named[:-1])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_of_buckets_moves_no_row(spark, bucketed):
    tables, facts, named = bucketed
    found = tables.left_join("facts", "names", {"name": "title"})
    assert rows_of(found) == sorted(repr((i, k, named.get(k))) for i, k in facts)
    inner = tables.bucketed("facts").join(tables.bucketed("names").hint("merge"), "key")
    plan = plan_of(inner)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    assert plan_of(found).count("SortMergeJoin") >= 1 and "Exchange" not in plan_of(found).split("Union")[0]


def test_hot_and_missing_keys_lie_apart(bucketed):
    tables, facts, _ = bucketed
    assert {r.key for r in tables.apart("facts").collect()} == {"hot", None}
    assert rows_of(tables.read("facts")) == sorted(map(repr, facts))
    largest = tables.bucketed("facts").groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert largest < 100


def test_rows_are_computed_once(spark, tmp_path):
    computed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def key(i):
        computed.add(1)
        return f"k{i % 7}" if i % 2 else "hot"

    tables = BucketedTables(spark, str(tmp_path / "tables"), buckets=4, hot=40)
    tables.write("facts", spark.range(100).select("id", key("id").alias("key")), "key")
    assert computed.value == 100
    assert {r.key for r in tables.apart("facts").collect()} == {"hot"} and tables.read("facts").count() == 100


def test_replaced_tables(spark, bucketed):
    tables, facts, _ = bucketed
    before = tables.read("facts")
    tables.write("facts", spark.createDataFrame([(1, "k1")], "id long, key string"), "key")
    assert rows_of(before) == sorted(map(repr, facts))  # the former rows, to the end
    again = BucketedTables(spark, tables.path, buckets=99)
    assert again.buckets == 4 and rows_of(again.read("facts")) == [repr((1, "k1"))]
    assert again.clean() == 2
    assert rows_of(again.left_join("facts", "names", {"name": "name"})) == [repr((1, "k1", None))]
    again.write("none", spark.createDataFrame([], "id long, key string"), "key")
    assert again.read("none").count() == 0 and again.left_join("none", "names", {"name": "name"}).count() == 0


# --- scratch ----------------------------------------------------------------------------------


def test_scratch_of_this_application_is_removed(spark, tmp_path, monkeypatch):
    own = session._run_folder(spark)
    assert own.startswith(spark.conf.get("spark.checkpoint.dir")) and own.endswith(spark.sparkContext.applicationId)
    monkeypatch.setattr(session, "_run_folder", lambda _: f"{tmp_path}/retentia-1")
    (tmp_path / "retentia-2").mkdir()
    assert not session.clear_scratch(spark)
    for _ in range(2):
        spark.range(3).write.parquet(session.scratch_dir(spark, "a"))
    assert len(list(tmp_path.glob("retentia-1/a-*"))) == 2
    assert session.clear_scratch(spark)
    assert [p.name for p in tmp_path.glob("retentia-*")] == ["retentia-2"]


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    places = [Path(p) for p in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]

    def shuffled():
        return {f for p in places for f in p.rglob("shuffle_*.data")}

    before = shuffled()
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().join(spark.range(5), F.col("k") == F.col("id"))
    df.hint("merge").write.parquet(str(tmp_path / "out"))
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert rows_of(df) == rows_of(df)  # collected again


def test_steps_of_stored_facts_are_removed(spark, tmp_path, monkeypatch):
    """Scratch rows between the joins go when a fact is written; stored facts are compressed by zstd, and appear together."""
    monkeypatch.setattr(session, "_run_folder", lambda _: str(tmp_path))
    flags = load_all()["stored_dq_flags"].build(Models(spark, "/root/testdata/sf0.001"))
    assert flags.count() and not list(tmp_path.glob("steps-*"))
    store = next(tmp_path.glob("layers-*"))
    assert len(list(store.glob("_snapshots/[0-9]*.json"))) == 3
    written = list(store.glob("model/*/*/part-*.parquet"))
    assert written and all(".zstd." in p.name for p in written)
