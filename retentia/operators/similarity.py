"""Similar names without comparing all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def name_key(c: Column) -> Column:
    """Letters and digits in lower case, words set apart by one blank; NULL if there are none."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " ")), F.lit(""))


def trigrams(key: Column) -> Column:
    """The different runs of three characters of `` key ``, blanks at both ends included."""
    framed = F.concat(F.lit(" "), key, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(key)), lambda i: framed.substr(i, F.lit(3))))


def _combinations(ranked: Column, length: Column, shared: int) -> Column:
    """Hash of every choice of ``shared`` of the first ``length`` grams, with the place (from 1) of its last gram."""
    at = F.sequence(F.lit(1), length)
    chosen = F.transform(at, lambda i: F.struct(F.xxhash64(F.get(ranked, i - 1)).alias("hash"), i.alias("at")))
    found = chosen
    for _ in range(shared - 1):
        longer = F.transform(
            found,
            lambda c: F.transform(
                F.filter(chosen, lambda x: x["at"] > c["at"]), lambda x: F.struct(F.xxhash64(c["hash"], x["hash"]).alias("hash"), x["at"].alias("at"))
            ),
        )
        found = F.flatten(longer)
    return found


def _signatures(names: DataFrame, counts: DataFrame, least: float, shared: int) -> DataFrame:
    """Rows of (``key``, ``size``, ``hash``, ``at``): the choices of ``shared`` of a name's rarest grams that it must share."""
    single = names.select("key", F.explode(trigrams(F.col("key"))).alias("gram")).join(counts, "gram")
    ranked = single.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("ranked"))
    size = F.size("ranked")
    needed = F.ceil(size * F.lit(least) - 1e-9).cast("int")
    # too short to share that many: single grams decide between all names this short or near it
    short = (needed < shared) | (size * least * least < shared)
    sized = ranked.select("key", size.alias("size"), needed.alias("needed"), short.alias("short"), F.transform("ranked", lambda x: x["gram"]).alias("grams"))

    def of(rows: DataFrame, n: int) -> DataFrame:
        chosen = _combinations(F.col("grams"), F.col("size") - F.col("needed") + n, n)
        return rows.select("key", "size", F.explode(chosen).alias("_c")).select("key", "size", F.lit(n).alias("shared"), "_c.hash", "_c.at")

    if shared == 1:
        return of(sized, 1)
    return of(sized.filter("short"), 1).unionByName(of(sized.filter(F.col("needed") >= shared), shared))


def candidate_pairs(asked: DataFrame, known: DataFrame, least: float, shared: int = 3) -> DataFrame:
    """The different pairs (``asked``, ``known``) that may be similar enough; see :func:`similar_names`."""
    grams = asked.unionByName(known).select(F.explode(trigrams(F.col("key"))).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    left, right = (_signatures(names, counts, least, shared).alias(side) for names, side in ((asked, "a"), (known, "k")))
    sizes = F.col("a.size") + F.col("k.size")
    common = F.ceil(F.lit(least / (1 + least)) * sizes - 1e-9)
    reachable = F.col("a.shared") + F.least(F.col("a.size") - F.col("a.at"), F.col("k.size") - F.col("k.at"))
    able = (
        (F.col("a.hash") == F.col("k.hash")) & (F.col("a.shared") == F.col("k.shared"))
        & (F.least("a.size", "k.size") >= F.lit(least) * F.greatest("a.size", "k.size") - 1e-9) & (reachable >= common)
    )
    return left.join(right, able).select(F.col("a.key").alias("asked"), F.col("k.key").alias("known")).distinct()


def similar_names(asked: DataFrame, known: DataFrame, least: float, shared: int = 3) -> DataFrame:
    """Pairs of name keys (``asked``, ``known``) whose trigrams have a Jaccard similarity of ``least`` or more, once each.

    Both inputs have one column ``key`` of different, non-NULL keys. Trigrams are ordered by how many names have
    them, rare ones first. A name with n trigrams shares at least m = ceil(least * n) of them with a similar one,
    the first ``shared`` of these among its n - m + ``shared`` rarest. So only names meet that share
    ``shared`` rare trigrams at once: numbered names, where a fixed part of all share any single one, stay
    apart. Before they are compared, lengths must be near enough, and what is left behind the last shared
    trigram must suffice. Names with too few trigrams for that meet through one. No similar pair is lost.
    """
    one, two = trigrams(F.col("asked")), trigrams(F.col("known"))
    common = F.size(F.array_intersect(one, two))
    similarity = common.cast("double") / (F.size(one) + F.size(two) - common)
    return candidate_pairs(asked, known, least, shared).withColumn("similarity", similarity).filter(F.col("similarity") >= least)
