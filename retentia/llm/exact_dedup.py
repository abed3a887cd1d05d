"""Exact duplicates through cuckoo-filter indexes of live digests."""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retentia.llm.common import Batches, keep_rows, numbered, rows_out, stored, texts

BLANKS = b" \t\n\x0b\x0c\r"
SLOTS = 4  # of a bucket
KICKS = 200  # moves before a table counts as full


class CuckooIndex:
    """Keys (digests of 16 bytes or more) with a value each, behind a cuckoo filter.

    The filter holds a 16-bit tag per key in one of two buckets of four slots. A tag that matches is
    only a candidate: the key stored beside it decides. When moving tags finds no free slot, the table
    is doubled and filled again from the stored keys.
    """

    def __init__(self, buckets: int = 1024):
        self.size = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.tags = array("H", bytes(2 * SLOTS * buckets))
        self.keys: list = [None] * (SLOTS * buckets)
        self.values: list = [None] * (SLOTS * buckets)

    def _places(self, key: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(key[:2], "little") or 1
        first = int.from_bytes(key[2:10], "little") & self.mask
        return tag, first, self._other(first, tag)

    def _other(self, bucket: int, tag: int) -> int:
        return bucket ^ (tag * 0x5BD1E995 >> 3 & self.mask)

    def find(self, key: bytes) -> int:
        """The slot of ``key``, or -1."""
        tag, first, second = self._places(key)
        for bucket in (first, second):
            at = bucket * SLOTS
            for slot in range(at, at + SLOTS):
                if self.tags[slot] == tag and self.keys[slot] == key:
                    return slot
        return -1

    def insert(self, key: bytes, value) -> None:
        """Add a key that is not in the index."""
        if not self._place(key, value):
            self._grow((key, value))
        self.size += 1

    def _place(self, key: bytes, value) -> bool:
        tag, first, second = self._places(key)
        path = []
        bucket = first
        for other in (first, second):
            at = other * SLOTS
            for slot in range(at, at + SLOTS):
                if not self.tags[slot]:
                    self.tags[slot], self.keys[slot], self.values[slot] = tag, key, value
                    return True
        for kick in range(KICKS):
            slot = bucket * SLOTS + kick % SLOTS
            path.append(slot)
            mine = (tag, key, value)
            tag, key, value = self.tags[slot], self.keys[slot], self.values[slot]
            self.tags[slot], self.keys[slot], self.values[slot] = mine
            bucket = self._other(bucket, tag)
            at = bucket * SLOTS
            for slot in range(at, at + SLOTS):
                if not self.tags[slot]:
                    self.tags[slot], self.keys[slot], self.values[slot] = tag, key, value
                    return True
        for slot in reversed(path):  # undo, so that the stored keys are whole
            mine = (tag, key, value)
            tag, key, value = self.tags[slot], self.keys[slot], self.values[slot]
            self.tags[slot], self.keys[slot], self.values[slot] = mine
        return False

    def _grow(self, *more: tuple) -> None:
        live = [*self.items(), *more]
        buckets = 2 * (self.mask + 1)
        while True:
            self._clear(buckets)
            if all(self._place(k, v) for k, v in live):
                return
            buckets *= 2

    def delete(self, key: bytes) -> bool:
        slot = self.find(key)
        if slot < 0:
            return False
        self.tags[slot], self.keys[slot], self.values[slot] = 0, None, None
        self.size -= 1
        return True

    def items(self) -> list[tuple]:
        return [(k, self.values[i]) for i, k in enumerate(self.keys) if k is not None]


def _digests(batches: Batches) -> Batches:
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.binary()), ("points", pa.int64())])
    for batch in batches:
        raw = texts(batch["text"])
        digests = [hashlib.sha256(t.translate(None, BLANKS)).digest() for t in raw]
        points = [len(t) if t.isascii() else len(t.decode("utf-8", "replace")) for t in raw]
        yield pa.record_batch([batch["row"], batch["doc_id"], pa.array(digests, pa.binary()), pa.array(points, pa.int64())], schema=schema)


GROUPS = pa.schema([("digest", pa.binary()), ("points", pa.int64()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64())])
GROUPS_SQL = "digest binary, points long, keep_id long, keep_row long, group_size long"


def _combine(live: int):
    """Groups by digest of what a task reads. A new digest beyond ``live`` makes room: all groups are handed on
    and deleted. Rows in digest order therefore give whole groups, in any other order parts of them."""

    def rank(row: tuple) -> tuple:
        return -row[0], row[1] is None, row[1] or 0, row[2]

    def task(batches: Batches) -> Batches:
        index = CuckooIndex()

        def handed_on() -> Batches:
            groups = index.items()
            yield from rows_out(GROUPS, [(k, *v[0], v[1]) for k, v in groups])
            for k, _ in groups:
                index.delete(k)

        for batch in batches:
            for key, points, doc, row, n in zip(*[batch[c].to_pylist() for c in GROUPS.names]):
                slot = index.find(key)
                best = (points, doc, row)
                if slot < 0:
                    if index.size >= live:
                        yield from handed_on()
                    index.insert(key, [best, n])
                else:
                    group = index.values[slot]
                    group[0], group[1] = min(group[0], best, key=rank), group[1] + n
        yield from handed_on()

    return task


def exact_duplicates(docs: DataFrame, live: int = 100_000) -> DataFrame:
    """Per row of ``docs``: ``row``, ``doc_id``, ``keep_id``, ``keep_row``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are after deleting blanks (space, tab, line ends and feeds); null counts as
    empty. Of equal texts the longest in code points stays, then the smallest ``doc_id`` (null last), then
    the first row, so exactly one of repeated rows stays. No documents, no rows; other columns are ignored.

    Every task first folds the copies it reads through an index of at most ``live`` digests, so a text that
    makes up a third of all rows sends a few rows to its shard. Shards are hash partitions of the digest,
    read in digest order through an index of the same size, so memory does not grow with a shard;
    the content that hits are verified against is the full 256-bit digest of the normalised text. A size is
    looked up for each row by an equi join whose hot keys Spark splits.
    """
    rows = stored(numbered(docs, "doc_id", "text").mapInArrow(_digests, "row long, doc_id long, digest binary, points long"), "digests")
    single = rows.select("digest", "points", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("group_size"))
    partial = single.mapInArrow(_combine(live), GROUPS_SQL)
    shards = partial.repartition("digest").sortWithinPartitions("digest")
    groups = shards.mapInArrow(_combine(live), GROUPS_SQL).drop("points")
    return rows.join(groups, "digest").select(
        "row", "doc_id", "keep_id", "keep_row", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, unchanged; ``docs`` is a stored table."""
    return keep_rows(docs, exact_duplicates(docs).filter("kept"))
