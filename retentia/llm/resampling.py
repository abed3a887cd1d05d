"""Importance resampling towards a target distribution, with weights from bit-sliced bucket counts."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W

from retentia.llm.common import Batches, numbered, stored, texts

WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
PLANES_SQL = "row long, doc_id long, n_words long, n_features long, planes binary"
PLANES = pa.schema([(c, pa.int64()) for c in ("row", "doc_id", "n_words", "n_features")] + [("planes", pa.binary())])


def plane_bytes(buckets: int) -> int:
    """Bytes of a plane: one bit per bucket, in whole 64-bit words."""
    return -(-buckets // 64) * 8


def feature_buckets(text: bytes, buckets: int, longest: int) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every run of 1 to ``longest`` words.

    The checksum of a run is continued from the one without its last word.
    """
    words = text.translate(WORD_BYTES).split()
    spaced = [b" " + w for w in words]
    runs = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    found = [runs]
    for length in range(2, longest + 1):
        n = max(0, len(words) - length + 1)
        runs = np.fromiter(map(zlib.crc32, spaced[length - 1 :], runs[:n].tolist()), np.uint32, n)
        found.append(runs)
    return len(words), np.concatenate(found) % buckets


def sliced(values: np.ndarray, width: int) -> np.ndarray:
    """Planes of the values: row i holds bit i of each, packed."""
    bits = int(values.max(initial=0)).bit_length()
    out = np.zeros((bits, width), np.uint8)
    for i in range(bits):
        packed = np.packbits((values >> i) & 1 != 0)
        out[i, : len(packed)] = packed
    return out


def _count_planes(buckets: int, longest: int):
    def task(batches: Batches) -> Batches:
        width = plane_bytes(buckets)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                rows = []
                for text in texts(batch["text"]):
                    n, found = feature_buckets(text, buckets, longest)
                    rows.append((n, len(found), sliced(np.bincount(found, minlength=buckets), width).tobytes()))
                n_words, n_features, planes = zip(*rows)
                yield pa.record_batch([batch["row"], batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), pa.array(planes, pa.binary())], schema=PLANES)

    return task


def count_planes(docs: DataFrame, text: str, identity: str, buckets: int, longest: int) -> DataFrame:
    """Per row its bucket counts as bit planes, least bit first; none for a text without words."""
    return numbered(docs, identity, text).toDF("row", "doc_id", "text").mapInArrow(_count_planes(buckets, longest), PLANES_SQL)


def _planes(column: pa.Array, width: int) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint8).reshape(-1, width) for x in column.to_pylist()]


def bucket_totals(planes: DataFrame, buckets: int) -> DataFrame:
    """``bucket`` and ``n``, added up from the planes; each task sends at most one row per bucket."""
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])
    width = plane_bytes(buckets)

    def task(batches: Batches) -> Batches:
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                found = _planes(whole.slice(at, 256)["planes"], width)
                for i in range(max(map(len, found), default=0)):
                    bits = np.unpackbits(np.stack([p[i] for p in found if len(p) > i]), axis=1, count=buckets)
                    total += bits.sum(axis=0, dtype=np.int64) << i
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], schema=schema)

    return planes.select("planes").mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) per bucket, from both totals: ``buckets`` numbers."""
    totals = raw.select("bucket", F.col("n").alias("s")).join(target.select("bucket", F.col("n").alias("t")), "bucket", "full").na.fill(0)
    found = stored(totals, "bucket-totals")
    sums = found.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("s"), F.coalesce(F.sum("t"), F.lit(0)).alias("t")).first()
    every = found.sparkSession.range(buckets).select(F.col("id").alias("bucket")).join(found, "bucket", "left").na.fill(0)
    raw_part = (F.col("s").cast("double") + 1) * float(sums["t"] + buckets)
    target_part = (F.col("t").cast("double") + 1) * float(sums["s"] + buckets)
    out = np.zeros(buckets, np.int64)
    for r in every.select("bucket", F.floor(1000 * F.log(target_part / raw_part)).alias("gain")).collect():
        out[r["bucket"]] = r["gain"]
    return out


def weights(planes: DataFrame, gains: np.ndarray) -> DataFrame:
    """``row``, ``doc_id``, ``n_words``, ``n_features`` and ``weight``, the floored mean of the gains.

    A count plane and a gain plane share popcount(AND) buckets, each worth a power of two; the planes of
    negative gains count negative. Sums are whole numbers, so weights are exact.
    """
    width = plane_bytes(len(gains))
    halves = [sliced(np.maximum(g, 0), width) for g in (gains, -gains)]
    words = np.concatenate(halves).view(np.uint64)
    worth = np.array([sign << i for sign, half in ((1, halves[0]), (-1, halves[1])) for i in range(len(half))], np.int64)
    schema = pa.schema([*list(PLANES)[:4], ("weight", pa.int64())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for n, own in zip(batch["n_features"].to_pylist(), _planes(batch["planes"], width)):
                shared = np.bitwise_count(own.view(np.uint64)[:, None, :] & words[None]).sum(axis=2, dtype=np.int64)
                total = sum(int(x) << i for i, x in enumerate((shared @ worth).tolist()))
                out.append(total // n if n else 0)
            yield pa.record_batch([*[batch[c] for c in schema.names[:4]], pa.array(out, pa.int64())], schema=schema)

    return planes.mapInArrow(task, "row long, doc_id long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, *order, name: str = "rank") -> DataFrame:
    """``rows`` with their place in the order, from 1: sorted in ranges, whose sizes give the first place of each.

    The order must not leave ties. Only one number per range reaches the driver.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    split = stored(rows.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = sorted((r["_range"], r["count"]) for r in split.groupBy("_range").count().collect())
    first, before = {}, 0
    for part, n in sizes:
        first[part], before = before, before + n
    start = F.element_at(F.create_map(*[F.lit(x) for kv in first.items() for x in kv]), F.col("_range")) if first else F.lit(0)
    place = F.row_number().over(W.partitionBy("_range").orderBy(*order)).cast("long") + start.cast("long")
    return split.withColumn(name, place).drop("_range")


def resampled(
    docs: DataFrame, target: DataFrame, share: tuple[int, int] = (25, 100), buckets: int = 10_000, longest: int = 2, least_words: int = 20,
    seed: int = 7,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` among the drawn, null for the rest.

    Features are runs of 1 to ``longest`` words (A-Z lowered; digits, letters and everything outside ASCII),
    in buckets by CRC-32. A document's weight is the floored mean of its buckets' gains towards the texts of
    ``target``, its score adds Gumbel noise from a hash of ``seed`` and id, and the best share of the
    documents with at least ``least_words`` words is drawn without replacement.

    Null and empty texts have no features and weight 0; null ids share the noise of an empty id and come last
    among equal scores, then the earlier row; repeated rows are drawn each for themselves; no documents, no
    rows; an empty target only evens out the corpus; other columns are ignored.

    Texts are read once: the planes of their counts (some hundred bytes to a few kB each) are stored, added up by bucket and
    then weighed map-side. Only the gains, one number per bucket, go through the driver.
    """
    planes = stored(count_planes(docs, "text", "doc_id", buckets, longest), "planes")
    numberless = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    goal = bucket_totals(count_planes(numberless, "text", "doc_id", buckets, longest), buckets)
    gains = bucket_gains(bucket_totals(planes, buckets), goal, buckets)
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), identity), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32))))
    scored = stored(weights(planes, gains).withColumn("score", F.col("weight") + noise), "scores")
    eligible = F.col("n_words") >= least_words
    drawn = scored.filter(eligible).count() * share[0] // share[1]
    places = ranked(scored, F.desc(eligible), F.desc("score"), F.asc_nulls_last("doc_id"), "row", name="place")
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    return places.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
