"""Quality rules: counts of a text, and robust multivariate outliers by minimum covariance determinant."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from retentia.llm.common import Batches, stored, texts

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
WINDOW = 8

# Transformed statistics and the least spread each is given, so that a statistic which is the same for most
# documents of a source doesn't make every other value an outlier.
SPREADS = {"length": 0.3, "word_length": 0.05, "symbols": 0.07, "dup_lines": 0.12, "repeats": 0.1, "variety": 0.03}
NAMES = tuple(SPREADS)
P = len(NAMES)
FEWEST = 5 * P  # rows from which a covariance of so many statistics is estimated


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by runs of ``window`` words that are found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + (ids[i : i + n] + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    if len(np.unique(mixed)) == n:  # equal runs have equal sums, so there are none
        return 0
    runs = ids.astype(np.int64)
    step = 1
    while step < window:  # numbers of runs of 2, 4 and 8 words, exactly
        pairs = runs[:-step] * (runs.max() + 1) + runs[step:]
        runs = np.unique(pairs, return_inverse=True)[1]
        step *= 2
    starts = np.flatnonzero(np.bincount(runs)[runs] > 1)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def counts(text: bytes) -> tuple[int, int, int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, repeated words; lines with a word; different words."""
    words = text.split()
    inside = text.translate(None, BLANKS)
    chars = len(inside) if inside.isascii() else len(inside.decode("utf-8", "replace"))
    symbols = len(inside) - len(inside.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines), len(set(words))


def vector(n: int, chars: int, symbols: int, dups: int, repeats: int, lines: int, variety: int) -> list[float]:
    """The transformed statistics: logarithms and roots, which make the bulk of a source nearly normal."""
    most = max(1, n)
    return [
        math.log1p(n), math.log1p(chars / most), math.sqrt(symbols / most), math.sqrt(dups / max(1, lines)),
        math.sqrt(repeats / most), math.log1p(variety) / math.log1p(most),
    ]


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``lang``, ``source``, the base counts, and ``x`` with the transformed statistics."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()), *[(c, pa.int64()) for c in BASE]]
        + [(n, pa.float64()) for n in NAMES]
    )

    def task(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [counts(t) for t in texts(batch["text"])]
            columns = [pa.array(c, pa.int64()) for c in list(zip(*found))[: len(BASE)]]
            columns += [pa.array(c, pa.float64()) for c in zip(*[vector(*x) for x in found])]
            yield pa.record_batch([batch["doc_id"], batch["lang"], batch["source"], *columns], schema=schema)

    sql = "doc_id long, lang string, source string, " + ", ".join([f"{c} long" for c in BASE] + [f"{n} double" for n in NAMES])
    return docs.select("doc_id", "text", "lang", "source").mapInArrow(task, sql)


def _group(*columns: Column) -> Column:
    """One text per combination of values; a null differs from every text."""
    return F.concat_ws(":", *[F.coalesce(F.concat(F.lit("="), F.replace(c, F.lit(":"), F.lit("::"))), F.lit("-")) for c in columns])


def grouped(stats: DataFrame, least: int) -> DataFrame:
    """``group``: language and source; where that has under ``least`` rows, all such of the language, then all such."""
    out = stats
    for group in (_group(F.col("lang"), F.col("source")), F.concat(F.lit("lang "), _group(F.col("lang"))), F.lit("all")):
        name = group if "group" not in out.columns else F.when(F.col("small"), group).otherwise(F.col("group"))
        out = out.withColumn("group", name).drop("small")
        sizes = stored(out.groupBy("group").agg(F.count(F.lit(1)).alias("rows")), "group-sizes")
        out = out.join(sizes, "group").withColumn("small", F.col("rows") < least).drop("rows")
    return out.drop("small")


def widened(rows: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The rows with the group they are judged by, and the rows that the estimate of each group is made from.

    These are the same but for a rest of under ``least`` rows that stays after all pooling: it is judged by
    all rows of the language, or, where these are under ``least`` too, by all rows of the table.
    """
    rest = F.col("group") == "all"
    if not 0 < rows.filter(rest).limit(least).count() < least:
        return rows, rows
    wide = rows.withColumn("wide", F.concat(F.lit("whole "), _group(F.col("lang"))))
    sizes = wide.groupBy("wide").agg(F.count(F.lit(1)).alias("rows"), F.max(rest).alias("needed")).filter("needed")
    own = F.when(F.col("rows") >= least, F.col("wide")).otherwise("table").alias("own")
    found = stored(sizes.select("wide", own), "wide-groups")
    base = rows.filter(~rest)
    base = base.unionByName(wide.join(found.filter("own = wide"), "wide").withColumn("group", F.col("own")).select(*rows.columns))
    if found.filter("own = 'table'").count() and rows.limit(FEWEST).count() >= min(least, FEWEST):
        base = base.unionByName(rows.withColumn("group", F.lit("table")))
    judged_by = F.when(rest, F.col("own")).otherwise(F.col("group"))
    return wide.join(found, "wide", "left").withColumn("group", judged_by).select(*rows.columns), base


def _moments(rows: DataFrame) -> DataFrame:
    """Mean and covariance per group, by sums that combine map-side."""
    products = [F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for i, a in enumerate(NAMES) for b in NAMES[i:]]
    return rows.groupBy("group").agg(F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(c).alias(c) for c in NAMES], *products)


FIT = "group string, m array<double>, a array<double>, logdet double"


def _fitted(moments: DataFrame) -> DataFrame:
    """Per group: mean, inverse covariance (with the least spreads) and the logarithm of its determinant."""

    def task(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                mean = np.array([r[c] for c in NAMES]) / r["n"]
                cov = np.zeros((P, P))
                for i, a in enumerate(NAMES):
                    for j in range(i, P):
                        cov[i, j] = cov[j, i] = r[f"{a}_{NAMES[j]}"] / r["n"] - mean[i] * mean[j]
                cov += np.diag(np.square(list(SPREADS.values())))
                out.append({"group": r["group"], "m": mean.tolist(), "a": np.linalg.inv(cov).ravel().tolist(), "logdet": float(np.linalg.slogdet(cov)[1])})
            schema = pa.schema([("group", pa.string()), ("m", pa.list_(pa.float64())), ("a", pa.list_(pa.float64())), ("logdet", pa.float64())])
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return moments.mapInArrow(task, FIT)


def _distance() -> Column:
    """The squared Mahalanobis distance of a row from its group's estimate."""
    off = [F.col(c) - F.col("m")[i] for i, c in enumerate(NAMES)]
    terms = [F.col("a")[i * P + j] * off[i] * off[j] for i in range(P) for j in range(P)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def _concentrated(rows: DataFrame, fit: DataFrame, share: float, steps: int) -> DataFrame:
    """Estimates after ``steps`` concentration steps: refit to the ``share`` of rows that are nearest, again and again.

    Every step reads all rows. The limit distance of a group is a mergeable quantile, so no group is
    gathered; its error moves a few rows across the limit, not the result of a step on them.
    """
    for _ in range(steps):
        near = rows.join(fit, "group").select("group", *NAMES, _distance().alias("d"))
        limit = stored(near.groupBy("group").agg(F.percentile_approx("d", share, F.lit(2000)).alias("limit")), "mcd-limits")
        fit = stored(_fitted(_moments(near.join(limit, "group").filter("d <= limit"))), "mcd-fit")
    return fit


def chi_square(q: float, p: int) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty)."""
    return p * (1 - 2 / (9 * p) + NormalDist().inv_cdf(q) * math.sqrt(2 / (9 * p))) ** 3


def estimates(rows: DataFrame, share: float = 0.75, steps: int = 3) -> DataFrame:
    """Per group the estimate of least determinant from two starts, with ``scale``: median distance over that of a normal."""
    middles = rows.groupBy("group").agg(*[F.percentile_approx(c, 0.5, F.lit(2000)).alias(c) for c in NAMES])
    middles = stored(middles.select("group", F.array(*NAMES).alias("m")), "mcd-medians")
    off = rows.join(middles, "group").select("group", *[F.abs(F.col(c) - F.col("m")[i]).alias(c) for i, c in enumerate(NAMES)])
    mads = off.groupBy("group").agg(*[F.percentile_approx(c, 0.5, F.lit(2000)).alias(c) for c in NAMES])
    variance = [F.pow(F.col(c) * 1.4826, 2) + s * s for c, s in SPREADS.items()]
    inverse = F.array(*[1 / variance[i] if i == j else F.lit(0.0) for i in range(P) for j in range(P)])
    robust = stored(mads.select("group", inverse.alias("a")).join(middles, "group").select("group", "m", "a", F.lit(0.0).alias("logdet")), "mcd-start")
    classical = stored(_fitted(_moments(rows)), "mcd-start")
    both = _concentrated(rows, robust, share, steps).unionByName(_concentrated(rows, classical, share, steps))
    best = stored(both.groupBy("group").agg(F.min_by(F.struct("m", "a"), "logdet").alias("fit")).select("group", "fit.m", "fit.a"), "mcd-best")
    medians = rows.join(best, "group").groupBy("group").agg(F.percentile_approx(_distance(), 0.5, F.lit(2000)).alias("middle"))
    scale = F.greatest(F.lit(1.0), F.col("middle") / chi_square(0.5, P))
    return stored(best.join(medians, "group").select("group", "m", "a", scale.alias("scale")), "mcd")


def judged(docs: DataFrame, quantile: float = 1 - 1e-9, least: int = 100) -> DataFrame:
    """Per row: ``doc_id``, the base counts, ``base_failed``, ``kept``, ``distance`` (squared, scaled).

    A document is kept unless it has under 20 words, over 30 % of repeated words, or statistics beyond the
    chi-square ``quantile`` of the robust estimate of its language and source. Groups of under ``least`` rows
    are pooled with their like in the language, then with all such; what is then left under ``least`` is
    judged by the estimate of its whole language, or else of the whole table. Only a table of under 30 rows
    (or ``least``, if that is fewer) is judged by the base rules alone. Null texts have no words; null languages and sources are groups of their
    own; repeated rows count each; no documents, no rows; other columns are ignored.
    """
    rows = stored(grouped(stored(statistics(docs), "statistics"), least), "statistics-grouped")
    rows, base = widened(rows, least)
    fit = estimates(base)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    limit = chi_square(quantile, P)
    found = rows.join(fit, "group", "left").withColumns({"base_failed": failed, "distance": _distance() / F.col("scale")})
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))
    return found.select("doc_id", *BASE, "base_failed", kept.alias("kept"), "distance")
