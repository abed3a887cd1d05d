"""Latest versions kept by a stream: late rows, bounded state, repeated and interrupted runs."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from retentia.operators.versions import latest_per_key
from retentia.streaming.latest_stream import LatestTable, update_latest

SCHEMA = "k string, day date, v int, note string"


class Feed:
    """Files that arrive one after the other, the table they feed, and all rows for the batch pick."""

    def __init__(self, spark, root):
        self.spark, self.root, self.rows = spark, root, []
        self.table = LatestTable(spark, f"{root}/table", ["k", "day"], "day", ["v", "note"])

    def deliver(self, *rows):
        rows = [(k, date(2024, *d) if d else None, v, n) for k, d, v, n in rows]
        self.rows += rows
        self.spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{self.root}/in")

    def run(self):
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.root}/in")
        return update_latest(stream, self.table, f"{self.root}/checkpoint", "10 days")

    def check(self):
        want = latest_per_key(self.spark.createDataFrame(self.rows, SCHEMA), ["k", "day"], "v", ["note"])
        assert sorted(map(repr, self.table.read().collect())) == sorted(map(repr, want.collect()))


@pytest.fixture()
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def state_rows(query):
    return query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_late_rows_win_or_lose_as_in_batch(feed):
    feed.deliver(("a", (1, 1), 1, "x"), ("a", (1, 1), 1, "y"), ("a", (1, 20), 5, None), ("b", (1, 20), None, "n"), ("b", (2, 25), 1, "x"))
    feed.run()
    feed.check()
    assert feed.table.closed == date(2024, 2, 15)
    # within the watermark, behind it (one wins, one loses, one is new), without a day, and equal to what is stored
    feed.deliver(("b", (2, 25), 3, "w"), ("b", (2, 20), 1, "w"), ("a", (1, 20), 4, "lost"), ("a", (1, 1), 2, "won"), ("c", (1, 3), 1, "new"),
                 ("a", None, 1, "first"), ("a", None, 2, "second"), (None, (1, 20), 1, "no key"), ("b", (1, 20), None, "n"))
    feed.run()
    feed.check()
    feed.deliver(("a", None, 3, "third"), ("a", (1, 1), 9, "again"), ("d", (2, 20), 1, "in time"))
    feed.run()
    feed.check()


def test_state_holds_open_days_only(feed):
    """Ten keys a day over five months: the state keeps the last ten days, however long the stream runs."""
    for month in range(1, 6):
        feed.deliver(*[(f"k{k}", (month, d), 1, "x") for d in range(1, 29) for k in range(10)])
        query = feed.run()
        assert state_rows(query) == 10 * 10
    feed.check()
    assert {m: len(r) for m, r in feed.table.runs().items() if m != "2024-05"} == {f"2024-0{m}": 1 for m in range(1, 5)}


def test_runs_without_news_and_repeated_runs_change_nothing(feed):
    feed.deliver(("a", (3, 1), 1, "x"), ("a", (3, 30), 1, "x"))
    feed.run()
    before = feed.table.runs()
    feed.run()
    assert feed.table.runs() == before
    feed.table.add(feed.table.read())  # a micro-batch that is repeated after its commit
    feed.check()
    feed.table.merge(feed.table.read())  # nothing beats what is stored
    assert sum(map(len, feed.table.runs().values())) == 2


@pytest.mark.parametrize("step", ["add", "close", "merge"])
def test_a_run_that_is_cut_off_is_finished_by_the_next(feed, step, monkeypatch):
    feed.deliver(("a", (1, 1), 1, "x"), ("a", (2, 25), 1, "x"))
    feed.run()
    feed.deliver(("a", (1, 1), 2, "late"), ("a", (2, 26), 1, "x"), ("b", (3, 30), 1, "x"))

    def broken(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(LatestTable, step, broken)
    with pytest.raises(Exception, match="executor lost"):
        feed.run()
    monkeypatch.undo()
    feed.deliver(("a", (1, 1), 3, "later"), ("a", (2, 27), 1, "behind the newer watermark"))
    feed.run()
    feed.check()


def test_closed_months_are_merged_once_and_read_alone(feed):
    feed.deliver(("a", (1, 5), 1, "x"), ("b", (4, 1), 1, "x"))
    feed.run()
    feed.deliver(("a", (1, 5), 2, "y"))
    feed.run()
    assert len(feed.table.runs()["2024-01"]) == 1
    assert [tuple(r) for r in feed.table.read(["2024-01"]).collect()] == [("a", date(2024, 1, 5), 2, "y")]
    assert all("_month=2024-01" in f for f in feed.table.read(["2024-01"]).inputFiles())
    assert feed.table.clean() > 0
    feed.check()


def test_day_far_ahead_loses_no_other_row(feed):
    feed.deliver(("z", (12, 31), 1, "wrong day"))
    feed.run()
    feed.deliver(*[("a", (m, 1), m, "x") for m in range(1, 12)], ("a", (1, 1), 7, "y"))
    query = feed.run()
    assert state_rows(query) == 1
    feed.check()


def test_empty_delivery(feed):
    feed.deliver()
    feed.run()
    assert feed.table.closed is None or feed.table.closed <= date(1970, 1, 1)
    feed.deliver(("a", (1, 1), 1, "x"))
    feed.run()
    feed.check()
    assert feed.table.read().agg(F.count("*")).first()[0] == 1
