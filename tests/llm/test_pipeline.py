"""The pipeline stage by stage, and the SQL of the queries."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from retentia import configure
from retentia.llm import simhash
from retentia.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage got and returned."""
    docs, out = configure(spark).read.parquet(f"{SF}/documents.parquet"), [("documents", None)]
    columns = docs.columns
    out[0] = ("documents", docs)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
        assert docs.columns == columns or name == "packing"
    return out


def test_stages(stages):
    rows = {name: df.collect() for name, df in stages}
    lettered = [r for r in rows["documents"] if re.search(r"[^\W\d_]", r.text or "")]
    assert sorted(r.doc_id for r in rows["language"]) == sorted(r.doc_id for r in lettered)
    bare = [re.sub(r"[\x20\x09-\x0D]", "", r.text) for r in rows["exact_dedup"]]
    assert len(bare) == len(set(bare)) == len({re.sub(r"[\x20\x09-\x0D]", "", r.text) for r in rows["language"]})
    groups = simhash.simhash_groups(stages[2][1]).collect()
    assert sorted(r.doc_id for r in rows["simhash_dedup"]) == sorted({r.component_id for r in groups})
    near = {r.doc_id: r for r in rows["simhash_dedup"]}
    mixed = Counter(r.doc_id for r in rows["mixing"])
    assert set(mixed) <= set(near) and all(tuple(r) == tuple(near[r.doc_id]) for r in rows["mixing"])
    starts = Counter(r.doc_id for r in rows["packing"] if r.start == 0)
    assert starts == mixed


def test_run_returns_the_last_stage(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "start", "ids_crc32").collect())) == sorted(
        map(tuple, stages[-1][1].select("doc_id", "start", "ids_crc32").collect())
    )


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    found = QUERIES[name](spark, SF)
    names = ", ".join(sorted(found.columns))
    for table in ("documents", "embeddings", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = duckdb.sql(f"SELECT {names} FROM ({SQL[name]})").fetchall()
    rows = [tuple(r) for r in found.select(*sorted(found.columns)).collect()]
    assert sorted(rows) == sorted(expected)


def test_stages_of_awkward_tables(spark, tmp_path):
    """Null and repeated ids, nulls in every column, empty tables and further columns, stage by stage."""
    words = "the of and house river stone light green"
    rows = [(None, f"{words} {i} {words[::-1]} {i * 7919}", None, None, None) for i in range(6)]
    for i in range(100, 160):  # enough to learn two languages from
        own = ["the", "of", "and", "that", "with"] if i % 2 else ["le", "la", "est", "dans", "maison"]
        rows.append((i, " ".join(f"{w} {i * k * 7907 % 99991}" for k in range(1, 9) for w in own), "en" if i % 2 else "fr", "s", 9))
    rows += [(5, rows[0][1], "en", "s", 1), (5, "le chat est dans la maison " * 3, "fr", "s", 2), (7, None, "en", None, 3), (8, "", None, "s", 4), (7, "12 !!", "en", "s", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `row` string, copy int, `a.b` string"
    for name, some in (("full", rows), ("none", [])):
        docs = spark.createDataFrame([(*r, "r", 1, "x") for r in some], schema)
        for stage, build in corpus_pipeline.STAGES:
            docs.write.parquet(f"{tmp_path}/{name}-{stage}")
            columns, docs = docs.columns, build(spark, spark.read.parquet(f"{tmp_path}/{name}-{stage}"), SF)
            assert docs.columns == columns or stage == "packing"
            found = docs.collect()
            if stage in ("language", "exact_dedup", "simhash_dedup"):
                assert len({r.text for r in found}) == len(some and {r[1] for r in some if r[1] and any(c.isalpha() for c in r[1])})
            docs = spark.createDataFrame(found, docs.schema)
        assert bool(found) == bool(some)


def test_the_whole_path_is_native(spark):
    for name in ("op2_mixing", "op8_pii"):
        assert "Python" not in QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
