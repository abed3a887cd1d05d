"""Operators against brute force, with ties, NULLs and one key holding a third of the rows."""

import random
from datetime import date, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from retentia.operators import access, intervals, merge, totals, versions

DAY0 = date(2024, 1, 1)


def hot_key(rng):
    return "hot" if rng.random() < 0.34 else f"k{rng.randrange(8)}"


def test_valid_at_join_equals_brute_force(spark):
    rng = random.Random(7)
    spans = []
    for i in range(150):
        start = DAY0 + timedelta(days=rng.randrange(-900, 120))
        end = None if rng.random() < 0.15 else start + timedelta(days=rng.randrange(-5, 700))
        spans.append((rng.choice([hot_key(rng), None]) if i % 50 == 0 else hot_key(rng), start, end, f"S{i:03d}"))
    spans += [("hot", None, None, "S900"), ("hot", DAY0, DAY0 + timedelta(days=9), "S901"), ("hot", DAY0, None, "S902")]
    events = [(hot_key(rng), DAY0 + timedelta(days=rng.randrange(0, 400)), i) for i in range(400)]
    events += [(None, DAY0, 900), ("hot", None, 901), ("absent", DAY0, 902)]

    def winner(key, at):
        fits = [
            (s, sid) for k, s, e, sid in spans if key and at and k == key and s and s <= at and (e is None or at <= e)
        ]
        return max(fits)[1] if fits else None

    e = spark.createDataFrame(events, "k string, d date, n int")
    s = spark.createDataFrame(spans, "k string, s date, e date, sid string")
    for top in (2, 7):
        out = intervals.valid_at_join(e, s, "k", "d", "s", "e", ["s", "sid"], ["sid"], top=top)
        got = {r.n: r.sid for r in out.collect()}
        assert got == {n: winner(k, d) for k, d, n in events}


def test_valid_at_join_emits_no_pairs(spark):
    """All rows share one key and one day: work must stay near events + spans, not their product."""
    n = 20_000
    e = spark.range(n).select(F.lit("hot").alias("k"), F.lit(DAY0).alias("d"), F.col("id").alias("n"))
    s = spark.range(n).select(
        F.lit("hot").alias("k"), F.lit(date(2023, 1, 1)).alias("s"), F.lit(date(2025, 1, 1)).alias("e"), F.col("id").alias("sid")
    )
    out = intervals.valid_at_join(e, s, "k", "d", "s", "e", ["s", "sid"], ["sid"])
    assert out.groupBy("sid").count().collect() == [(n - 1, n)]


def test_covering_blocks_are_exact(spark):
    pairs = [(lo, hi) for lo in (-9, -1, 0, 1, 5, 64, 127, 19723) for hi in (lo, lo + 1, lo + 6, lo + 200)]
    df = spark.createDataFrame(pairs, "lo int, hi int")
    for top in (1, 3, 7):
        blocks = intervals._covering_blocks(F.col("lo"), F.col("hi"), top)
        for lo, hi, found in df.select("lo", "hi", blocks.alias("b")).collect():
            days = []
            for code in (c for c in found if c is not None):
                level, position = code % intervals.LEVELS, code // intervals.LEVELS
                days += range(position << level, (position + 1) << level)
            assert sorted(days) == list(range(lo, hi + 1))


def test_previous_row_equals_lag(spark):
    rng = random.Random(3)
    rows = [
        (hot_key(rng) if rng.random() > 0.03 else None, rng.choice([None, DAY0 + timedelta(days=rng.randrange(6))]) if i % 9 == 0
         else DAY0 + timedelta(days=rng.randrange(6)), f"id{i:03d}", None if rng.random() < 0.1 else i)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "k string, d date, id string, v int")
    out = versions.previous_row(df, "k", "d", ["d", "id"], ["v", "id"])
    got = {r.id: (r.prev_v, r.prev_id) for r in out.collect()}
    want = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, r[1] or DAY0, r[2]))
        for before, row in zip([None, *mine], mine):
            want[row[2]] = (before[3], before[2]) if before else (None, None)
    assert got == want


def test_window_totals_equal_brute_force(spark):
    rng = random.Random(5)
    facts = [(hot_key(rng), DAY0 + timedelta(days=rng.randrange(60)), rng.randrange(100)) for _ in range(500)]
    points = [(hot_key(rng), DAY0 + timedelta(days=rng.randrange(-5, 70))) for _ in range(120)] + [(None, DAY0), ("hot", None)]
    out = intervals.window_totals(
        spark.createDataFrame(points, "k string, d date"), spark.createDataFrame(facts, "k string, d date, q long"),
        "k", "d", {"pre": (-14, -1), "post": (1, 14)}, ["q"],
    )
    got = {(r.k, r.d): (r.pre_q, r.post_q) for r in out.collect()}

    def total(key, at, lo, hi):
        return sum(q for k, d, q in facts if k == key and lo <= (d - at).days <= hi)

    assert got == {(k, d): (total(k, d, -14, -1), total(k, d, 1, 14)) for k, d in points if k and d}


def test_most_at_once_equals_brute_force(spark):
    rng = random.Random(11)
    spans = []
    for _ in range(300):
        start = None if rng.random() < 0.05 else DAY0 + timedelta(days=rng.randrange(90))
        end = None if rng.random() < 0.1 or start is None else start + timedelta(days=rng.randrange(-3, 20))
        spans.append((None if rng.random() < 0.05 else hot_key(rng), start, end))
    df = spark.createDataFrame(spans, "k string, s date, e date")
    got = {r.k: r.most_at_once for r in intervals.most_at_once(df, "k", "s", "e").collect()}
    want = {}
    for k, s, e in spans:
        if k and s and (e is None or e >= s):
            running = [1 for k2, s2, e2 in spans if k2 == k and s2 and s2 <= s and (e2 is None or s <= e2)]
            want[k] = max(want.get(k, 0), len(running))
    assert got == want


def test_latest_per_key(spark):
    rows = [("a", 1, 5, "x"), ("a", 3, 1, "y"), ("a", 3, 2, "z"), ("b", None, 9, "n"), ("b", 1, 1, "m"), (None, 2, 1, "q")]
    df = spark.createDataFrame(rows, "k string, batch int, amount int, v string")
    out = versions.latest_per_key(df, ["k"], "batch", ["amount"])
    assert {(r.k, r.v) for r in out.collect()} == {("a", "z"), ("b", "m"), (None, "q")}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # copies of a key are pruned before the shuffle


def test_first_and_latest(spark):
    rows = [("t", 2, DAY0, "b"), ("t", 1, date(2023, 5, 1), "a"), ("t", 3, date(2024, 9, 9), None), ("u", None, DAY0, "n"), (None, 1, DAY0, "x")]
    df = spark.createDataFrame(rows, "id string, batch int, created date, state string")
    out = {r.id: (r.created, r.state, r.batch) for r in versions.first_and_latest(df, "id", "batch", ["created"]).collect()}
    assert out == {"t": (date(2023, 5, 1), None, 3), "u": (DAY0, "n", None)}


def test_month_spine(spark):
    months = [date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)]
    rows = [("all", date(2020, 1, 1), None), ("feb", date(2024, 2, 29), date(2024, 3, 1)), ("none", date(2023, 1, 1), date(2024, 1, 1)), ("null", None, None)]
    out = intervals.month_spine(spark.createDataFrame(rows, "id string, s date, e date"), "s", "e", months)
    assert sorted((r.id, r.mrr_month.month) for r in out.collect()) == [("all", 1), ("all", 2), ("all", 3), ("feb", 2)]


@pytest.mark.parametrize("n", [1, 2, 7, 500, 501])
def test_exact_medians(spark, n):
    rng = random.Random(n)
    rows = [(rng.randrange(50), rng.random() * 10, None if i % 3 else i) for i in range(n)]
    df = spark.createDataFrame(rows, "a int, b double, c int")
    got = totals.exact_medians(df, ["a", "b", "c"])
    for i, c in enumerate("abc"):
        assert got[c] == pytest.approx(median([r[i] for r in rows if r[i] is not None]))


@pytest.mark.parametrize("accuracy", [10, 100])
def test_exact_medians_by_coarse_sketches(spark, accuracy):
    """Many different values and sketches that miss: the search narrows round by round, without a sort."""
    rng = random.Random(accuracy)
    rows = [(rng.random() ** 9, rng.choice([1, 2])) for _ in range(3000)] + [(-1e12, 2), (1e12, 2)]
    got = totals.exact_medians(spark.createDataFrame(rows, "a double, b int"), ["a", "b"], accuracy)
    assert got == {"a": median([r[0] for r in rows]), "b": median([r[1] for r in rows])}


def test_exact_medians_when_one_value_dominates(spark):
    df = spark.range(999).select(F.when(F.col("id") < 700, 5).otherwise(F.col("id")).alias("v"), F.lit(None).cast("int").alias("none"))
    assert totals.exact_medians(df, ["v", "none"]) == {"v": 5.0, "none": None}


def test_with_total_keeps_a_part_called_all(spark):
    df = spark.createDataFrame([(1, "x", 2.0), (1, None, 4.0), (1, "ALL", 6.0)], "m int, region string, v double")
    out = totals.with_total(df, ["m"], "region", {"v": F.avg("v")})
    assert sorted((str(r.region), r.v) for r in out.collect()) == [("ALL", 4.0), ("ALL", 6.0), ("None", 4.0), ("x", 2.0)]


def test_scopes(spark):
    df = spark.createDataFrame([("x", 1), ("ALL", 2), ("y'", 3), (None, 4)], "region string, v int")
    manager = access.Scope("regional_manager", "y'")
    assert [r.v for r in access.row_scope(df, manager).collect()] == [3]
    assert access.row_scope(df, access.Scope("analyst", "x")).count() == 4
    assert [r.v for r in access.summary_scope(df, access.Scope()).collect()] == [2]
    assert access.row_scope(df, access.Scope("regional_manager", None)).count() == 0
    assert access.one_of(df, "region", []).count() == 4
    assert [r.region for r in access.distinct_values(df, "region").collect()] == ["ALL", "x", "y'"]


def test_merge_dimension(spark):
    current = spark.createDataFrame([("1", "a", "keep"), ("2", "b", "old"), ("3", "c", "gone"), ("4", None, "blank")], "id string, v string, extra string")
    incoming = spark.createDataFrame([("1", "a", None), ("2", "B", 8), ("4", "", None), ("5", "new", 10)], "id string, v string, n int")
    out = {r.id: (r.v, r.extra, r.n) for r in merge.merge_dimension(current, incoming, "id").collect()}
    # unchanged rows keep what the delivery lacks, changed rows lose it; NULL equals empty
    assert out == {"1": ("a", "keep", None), "2": ("B", None, 8), "4": (None, "blank", None), "5": ("new", None, 10)}
    stats = {r.action: r.rows for r in merge.merge_stats(current, incoming, "id").collect()}
    assert stats == {"unchanged": 2, "update": 1, "insert": 1, "delete": 1}


def test_evolve_and_append(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "v string, _batch_id string")
    new = spark.createDataFrame([("z", 3, True, "2")], "v string, n int, ok boolean, _batch_id string")
    evolved = merge.evolve_schema(old, new)
    assert dict(evolved.dtypes) == {"v": "string", "_batch_id": "string", "n": "bigint", "ok": "boolean"}
    once = merge.append_batch(old, new, 2)
    twice = merge.append_batch(once, new, 2)
    want = [("a", None), ("c", None), ("z", 3)]
    assert sorted((r.v, r.n) for r in once.collect()) == sorted((r.v, r.n) for r in twice.collect()) == want


def test_corrections(spark):
    facts = spark.createDataFrame([("i1", "10", "paid", "1"), ("i1", "11", "open", "2"), ("i2", "20", "open", "1")], "invoice_id string, amount string, status string, _batch_id string")
    schema = "correction_id string, entity_type string, entity_id string, field_corrected string, new_value string"
    patches = [
        ("C1", " Invoice ", "i1", "status", "void"), ("C2", "invoice", "i1", "status", "final"), ("C3", "invoice", "i2", "amount", None),
        ("C4", "robot", "i2", "status", "x"), ("C5", "invoice", "i9", "status", "x"), ("C6", "payment", "i2", "status", "x"),
        ("C7", "invoice", "i2", "no_such_field", "x"),
    ]
    out = merge.apply_corrections(facts, spark.createDataFrame(patches, schema), "invoice").collect()
    assert sorted(tuple(r) for r in out if r.invoice_id == "i1") == [("i1", "10", "final", "1"), ("i1", "11", "final", "2")]
    assert [tuple(r) for r in out if r.invoice_id == "i2"] == [("i2", None, "open", "1")]


def test_scd2(spark):
    day = [date(2024, m, 1) for m in (1, 2, 3)]
    state = lambda *rows: spark.createDataFrame(list(rows), "id string, v string")
    h = merge.scd2_snapshot(None, state(("a", "1"), ("b", None), ("c", "3")), "id", day[0])
    h = merge.scd2_snapshot(h, state(("a", "2"), ("b", None), ("d", "4")), "id", day[1])
    h = merge.scd2_snapshot(h, state(("a", "2"), ("b", ""), ("d", "4")), "id", day[2], close_deleted=True)
    got = sorted((r.id, r.v or "", r.valid_from, r.valid_to) for r in h.collect())
    assert got == [
        ("a", "1", day[0], day[1]), ("a", "2", day[1], None), ("b", "", day[0], day[2]), ("b", "", day[2], None),
        ("c", "3", day[0], day[2]), ("d", "4", day[1], None),
    ]
