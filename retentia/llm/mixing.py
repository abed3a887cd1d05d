"""Mixing sources to target weights by Poisson replication, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from retentia.llm.common import fixed_splits, free_name, hash_share, stored

PART = 16.0  # mean of one inversion; larger means are sums of several
STEPS = 100  # terms of the distribution function: at a mean of 16 the rest is far below 2**-52


def source_rates(docs: DataFrame, source: str, targets: Mapping[str, float] | None, total: float | None) -> DataFrame:
    """Per source: documents, mean repetition rate, number of parts and the distribution function of a part."""
    counts = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.count(F.lit(1)).alias("sources")).first()
    rows = F.lit(float(sums["all"] if total is None else total))
    if targets is None:
        share = F.lit(1.0 / max(1, sums["sources"]))
    else:
        whole = float(sum(targets.values()))
        named = F.create_map(*[F.lit(x) for k, v in targets.items() for x in (k, v / whole)])
        share = F.coalesce(F.try_element_at(named, F.col("source")), F.lit(0.0))
    rated = counts.select("source", "n", (rows * share / F.col("n")).alias("rate"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    mean = F.col("rate") / F.col("parts")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(state["cdf"], F.array(F.element_at(state["cdf"], -1) + p)).alias("cdf"))

    cdf = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda s: s["cdf"])
    return rated.withColumn("parts", parts).withColumn("cdf", cdf)


def replicated(
    docs: DataFrame, targets: Mapping[str, float] | None = None, total: float | None = None, seed: str = "mix",
    source: str = "source", identity: str = "doc_id", copy: str = "copy",
) -> DataFrame:
    """Every document as often as a Poisson draw says, with the number of the copy, in random order.

    A source with weight w of ``targets`` (by default all sources weigh the same) and n documents has a
    mean of ``total`` * w / n copies per document (``total``: by default as many as there are documents).
    The draw inverts the distribution at a hash of seed and ``identity``, so it is the same for any
    partitioning, and repeated rows get the same count each. Sources not in ``targets`` get no copies; a
    null source is a source of its own; null identities share a draw; no documents, no rows. All columns
    stay; the copy number gets underscores before its name if a column is called so already.

    The rates have one row per source and are read from storage, so Spark knows their size: it broadcasts
    them when small and else splits the hot sources of a sort-merge join. The only shuffle of texts is the
    global one, by a hash of row, identity and copy, with each task's rows in hash order: rows without an id
    or with the same one spread like all others. ``docs`` is a stored table, so that its rows are numbered
    alike when a task runs again.
    """
    rates = stored(source_rates(docs, source, targets, total).drop("n"), "rates")
    name = free_name(docs, copy)
    there = [F.col(f"`{c}`") for c in docs.columns]
    fixed_splits(docs.sparkSession)
    own = docs.select(F.struct(*there).alias("_doc"), F.monotonically_increasing_id().alias("_row"))
    joined = own.join(rates, F.col(f"_doc.`{source}`").eqNullSafe(F.col("source")))
    key = F.col(f"_doc.`{identity}`")

    hashes = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda part: hash_share(seed, key, part))
    n = F.aggregate(hashes, F.lit(0), lambda n, u: n + F.size(F.filter("cdf", lambda c: c <= u))).cast("long")
    drawn = joined.filter("rate > 0").select("_doc", "_row", n.alias("_n")).filter("_n > 0")
    copies = drawn.select("_doc", "_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_copy"))
    order = F.xxhash64(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")), "_row", "_copy")
    mixed = copies.withColumn("_order", order).repartition("_order").sortWithinPartitions("_order")
    return mixed.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns], F.col("_copy").alias(name))
