"""Divergence of sources within a language, in cells of a cube of (group block, group block, term block)."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from retentia.llm.common import Batches, rows_out, stored, texts

LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
COUNTS_SQL = "lang string, source string, term binary, n long, docs long"
COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])
PAIRS_SQL = "lang string, a string, b string, value long"
PAIRS = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])


def terms(text: bytes) -> list[bytes]:
    """Runs of letters A-Z (lowered), a-z and everything outside ASCII."""
    return text.translate(LETTERS).split()


def _counted(live: int, read: int):
    """Occurrences and documents per group and term of what a task reads, handed on beyond ``live`` entries or
    ``read`` bytes. An empty term counts the documents of its group."""

    def task(batches: Batches) -> Batches:
        found: dict[tuple, tuple[Counter, Counter]] = {}
        entries = size = 0

        def handed_on() -> Batches:
            rows = [(*group, t, n[t], docs[t]) for group, (n, docs) in found.items() for t in docs]
            yield from rows_out(COUNTS, rows)
            found.clear()

        for batch in batches:
            groups = zip(*[batch[c].to_pylist() for c in ("lang", "source")])
            for text, group in zip(texts(batch["text"]), groups):
                n, docs = found.setdefault(group, (Counter(), Counter()))
                before, words = len(docs), terms(text)
                n.update(words)
                docs.update({b"", *words})
                entries, size = entries + len(docs) - before, size + len(text)
                if entries >= live or size >= read:
                    yield from handed_on()
                    entries = size = 0
        yield from handed_on()

    return task


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)), in exact arithmetic; null without a kept term."""
    return F.lit(1).cast("long") + F.call_function(
        "div", (n + 2).cast("decimal(20,0)") * F.lit(10**9).cast("decimal(10,0)"), F.nullif(total + 2 * kept, F.lit(0)).cast("decimal(20,0)")
    )


def apart(p: np.ndarray | Column, q: np.ndarray | Column):
    """floor((p - q)^2 / (p + q))."""
    if isinstance(p, Column):
        return F.call_function("div", (p - q) * (p - q), p + q)
    return (p - q) ** 2 // (p + q)


def _cell(key: tuple[pa.Scalar, ...], slices: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of one cell, from the slices of its two group blocks."""
    lang, a, b, _ = (x.as_py() for x in key)
    names, sides, rest, sizes = (slices[c].to_pylist() for c in ("source", "side", "rest", "size"))
    shares = np.ones((len(names), sizes[0]), np.int64)
    for i, (at, p) in enumerate(zip(slices["at"].to_pylist(), slices["p"].to_pylist())):
        if sizes[0]:
            shares[i] = rest[i]
            shares[i, at] = p
    left = [i for i, s in enumerate(sides) if s == 0]
    right = [i for i, s in enumerate(sides) if s == 1]
    rows = []
    for k, i in enumerate(left):
        others = left[k + 1 :] if a == b else right
        for j in others:
            # Rows come in any order, and a pair must have the same name in every term block to be added up.
            first, second = sorted((names[i], names[j]))
            rows.append((lang, first, second, int(apart(shares[i], shares[j]).sum())))
    return pa.Table.from_batches(list(rows_out(PAIRS, rows)), schema=PAIRS)


def divergence(
    docs: DataFrame, least: int = 10, top: int = 10, group_block: int = 32, term_block: int = 4096, live: int = 200_000, read: int = 1 << 26,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: how far the sources of a language are apart.

    Terms are runs of letters (A-Z lowered) and characters outside ASCII; a language keeps the terms in at
    least ``least`` of its documents. Part ``pair`` has, for each other source of the language, the sum of
    floor((p - q)^2 / (p + q)) over all kept terms; part ``term`` the ``top`` terms that the source uses more
    than its language. Ranks are by value, then by the bytes of the item. Null text, language and source are
    empty; a source without a term takes part; one source alone has no pairs; repeated rows count each;
    no documents, no rows; other columns are ignored.

    Tasks count what they read before anything is shuffled, so a hot source sends one row per term and
    task. Kept terms are numbered within term blocks, sources fall into group blocks, both by hash. A slice
    holds the shares of one source in one term block (at most some ``term_block`` numbers) and goes to the
    cells of its group block with every other; a cell returns partial sums of its pairs, which are added up
    along the term axis. Nothing is collected, and no cell holds more than two blocks of slices.
    """
    own = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    found = own.mapInArrow(_counted(live, read), COUNTS_SQL).withColumn("term", F.col("term").cast("string"))
    counts = stored(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    groups, used = counts.filter("term = ''").select("lang", "source"), counts.filter("term != ''")

    kept = used.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= least)
    kept = stored(kept.select("lang", "term", "lang_n"), "kept-terms")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("groups")).join(sizes, "lang", "left").na.fill(0)
    blocks = [F.greatest(F.lit(1), F.ceil(F.col(c) / n)).alias(name) for c, n, name in (("groups", group_block, "group_blocks"), ("kept", term_block, "term_blocks"))]
    langs = stored(langs.select("*", *blocks), "languages")
    in_block = W.partitionBy("lang", "block").orderBy("term")
    placed = kept.join(langs, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("term_blocks")))
    placed = placed.select(
        "lang", "term", "block", (F.row_number().over(in_block) - 1).alias("at"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    )
    block_sizes = placed.groupBy("lang", "block").agg(F.count(F.lit(1)).cast("int").alias("size"))

    in_group = stored(used.join(placed, ["lang", "term"]).select("lang", "source", "term", "block", "at", "n", "q"), "kept-counts")
    totals = in_group.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    group = groups.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).join(langs, "lang")
    rest = share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))
    group = stored(group.withColumn("rest", rest).withColumn("g", F.pmod(F.xxhash64("source"), F.col("group_blocks"))), "groups")
    p = share(F.col("n"), F.col("total"), F.col("kept"))
    shares = in_group.join(group.select("lang", "source", "total", "kept"), ["lang", "source"]).withColumn("p", p)

    entries = F.array_sort(F.collect_list(F.struct("at", "p")))
    filled = shares.groupBy("lang", "source", "block").agg(entries.alias("entries"))
    every = group.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1)))
    slices = every.join(filled, ["lang", "source", "block"], "left").join(block_sizes, ["lang", "block"], "left")
    slices = slices.select(
        "lang", "source", "block", "g", "group_blocks", "rest", F.coalesce("size", F.lit(0)).alias("size"),
        *[F.coalesce(F.col(f"entries.{c}"), F.array().cast(t)).alias(c) for c, t in (("at", "array<int>"), ("p", "array<long>"))],
    )
    meets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("group_blocks") - 1))
    cells = stored(slices, "slices").withColumn("h", meets).select(
        "lang", F.least("g", "h").alias("a"), F.greatest("g", "h").alias("b"), "block", (F.col("g") > F.col("h")).cast("int").alias("side"),
        "source", "rest", "size", "at", "p",
    )
    partial = cells.groupBy("lang", "a", "b", "block").applyInArrow(_cell, PAIRS_SQL)
    apart_by = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = apart_by.select("lang", both.alias("of"), "value").select("lang", "of.source", F.lit("pair").alias("part"), "of.item", "value")

    more = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [df.withColumn("rank", F.row_number().over(order)) for df in (pairs, more)]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= top))
