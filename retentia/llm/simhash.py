"""SimHash near-duplicates through pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from retentia.llm.common import Batches, keep_rows, numbered, stored, texts
from retentia.llm.components import components

BITS = 64
LOWER = bytes(range(256)).lower()
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("block", pa.int64()), ("size", pa.int64())])
LINKS_SQL = "a long, b long, block long, size long"


def fingerprint(text: bytes, shingle: int, seed: int = 42, chunk: int = 1 << 16) -> int:
    """The SimHash of a text in UTF-8: words in lower-case (A-Z), XXH64 of every run of ``shingle`` words."""
    from xxhash import xxh64_intdigest

    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), chunk):
        spans = zip(starts[at : at + chunk].tolist(), ends[at : at + chunk].tolist())
        hashes = np.array([xxh64_intdigest(joined[s:e], seed) for s, e in spans], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def _fingerprints(shingle: int):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in texts(batch["text"])], dtype=np.uint64).view(np.int64)
            yield pa.record_batch([batch["row"], batch["doc_id"], pa.array(found)], schema=schema)

    return task


def block_keys(distance: int, blocks: int) -> Column:
    """One number for each choice of ``blocks - distance`` of the blocks and their bits.

    Two fingerprints that differ in at most ``distance`` bits agree in that many blocks at least, so
    they share one of the keys.
    """
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        key = F.lit(number).cast("long")
        for i in chosen:
            width = edges[i + 1] - edges[i]
            part = F.shiftrightunsigned("fp", edges[i]).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(key)
    return F.explode(F.array(*keys))


def _spanning(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a forest whose trees are the components of a block, found without listing its pairs."""
    out, left = [], fps
    while len(left):
        root, todo, left = int(left[0]), [left[0]], left[1:]
        while todo and len(left):
            near = np.bitwise_count(left ^ todo.pop()) <= distance
            if near.any():
                reached = left[near]
                out += [(root, int(x)) for x in reached]
                todo += list(reached)
                left = left[~near]
    return out


def links_of_runs(keys: np.ndarray, fps: np.ndarray, distance: int) -> np.ndarray:
    """Links within runs of equal keys, as rows (a, b); small runs in one sweep per lag, others by forests."""
    first = np.concatenate(([True], keys[1:] != keys[:-1]))
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(keys)))
    found = [np.empty((0, 2), np.int64)]
    small = np.repeat(sizes <= 16, sizes)
    for lag in range(1, min(16, int(sizes.max(initial=1)))):
        at = np.flatnonzero(small[lag:] & (keys[lag:] == keys[:-lag]))
        at = at[np.bitwise_count(fps[at] ^ fps[at + lag]) <= distance]
        found.append(np.stack([fps[at], fps[at + lag]], axis=1).view(np.int64))
    for start, size in zip(starts[sizes > 16], sizes[sizes > 16]):
        tree = _spanning(fps[start : start + size], distance)
        if tree:
            found.append(np.array(tree, dtype=np.uint64).view(np.int64))
    return np.unique(np.sort(np.concatenate(found), axis=1), axis=0)


def _linked(distance: int, tile: int | None):
    """Links of sorted blocks; a block of over ``tile`` rows is only named, with its size."""

    def task(batches: Batches) -> Batches:
        def out(links: np.ndarray, block: int | None = None, size: int | None = None) -> pa.RecordBatch:
            n = len(links) if block is None else 1
            columns = [links[:, 0], links[:, 1], [None] * n, [None] * n] if block is None else [[None], [None], [block], [size]]
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=LINKS)

        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        open_key, open_size = None, 0  # a block beyond the limit, whose rows are counted and let go
        for batch in batches:
            new = batch["block"].to_numpy(zero_copy_only=False)
            keys = np.concatenate([keys, new])
            fps = np.concatenate([fps, batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)])
            while len(keys):
                if open_key is not None:
                    n = int(np.searchsorted(keys, open_key, "right"))
                    open_size, keys, fps = open_size + n, keys[n:], fps[n:]
                    if not len(keys):
                        break
                    yield out(None, open_key, open_size)
                    open_key = None
                whole = int(np.searchsorted(keys, keys[-1], "left"))
                sizes_at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
                big = sizes_at[:-1][np.diff(sizes_at) > tile] if tile else sizes_at[:0]
                if len(big):
                    whole = int(big[0])
                if whole:
                    yield out(links_of_runs(keys[:whole], fps[:whole], distance))
                    keys, fps = keys[whole:], fps[whole:]
                if not len(big):
                    break
                open_key, open_size = int(keys[0]), 0
        if open_key is not None:
            yield out(None, open_key, open_size)
        if len(keys):
            yield out(links_of_runs(keys, fps, distance))

    return task


def fingerprint_links(fps: DataFrame, distance: int, blocks: int, tile: int) -> DataFrame:
    """Links (``a``, ``b``) that connect all distinct fingerprints within ``distance`` bits.

    Blocks of up to ``tile`` fingerprints are searched in one piece. Larger ones are cut into parts by
    hash, and every two parts are searched together, so that no task holds more than two parts and no
    link is lost.
    """
    keyed = fps.select("fp", block_keys(distance, blocks).alias("block"))
    found = stored(
        keyed.repartition("block").sortWithinPartitions("block").mapInArrow(_linked(distance, tile), LINKS_SQL), "block-links"
    )
    links = found.filter("a IS NOT NULL").select("a", "b")
    hot = found.filter("block IS NOT NULL").select("block", F.ceil(F.col("size") / tile).alias("parts"))
    if hot.isEmpty():
        return links
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    halves = keyed.join(hot, "block").select("block", "fp", part.alias("i"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"))
    pairs = halves.select("fp", F.xxhash64("block", F.least("i", "j"), F.greatest("i", "j")).alias("block"))
    more = pairs.repartition("block").sortWithinPartitions("block").mapInArrow(_linked(distance, None), LINKS_SQL)
    return links.unionByName(more.select("a", "b"))


def simhash_groups(docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int = 7, tile: int = 8192) -> DataFrame:
    """Per row of ``docs``: ``row``, ``doc_id``, ``fp`` (signed 64 bits), ``component_id``, ``root``.

    Fingerprints that differ in at most ``distance`` bits are linked; the component of a document is the
    smallest ``doc_id`` reachable (null only if no document there has one), its root the least fingerprint,
    which tells components apart whose documents share ids or have none. Null and empty texts and texts
    without a word have fingerprint zero. Repeated rows share a fingerprint; no documents, no rows; other
    columns are ignored.

    Exact copies and repeated fingerprints are folded before blocks are formed, so only different
    fingerprints meet. With b blocks, C(b, distance) keys per fingerprint are shuffled, each of about
    64 (b - distance) / b bits; more blocks suit more documents.
    """
    rows = stored(numbered(docs, "doc_id", "text").mapInArrow(_fingerprints(shingle), "row long, doc_id long, fp long"), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(fingerprint_links(distinct.select("fp"), distance, blocks, tile), "a", "b")
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(smallest, "root").select("fp", "component_id", "root")
    return rows.join(labels, "fp").select("row", "doc_id", "fp", "component_id", "root")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One document of each component: the smallest ``doc_id``, null last, and the first row of it; ``docs`` is a stored table.

    Components are told apart by their fingerprints, so documents with null or repeated ids are lost only to
    a near copy.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    return keep_rows(docs, simhash_groups(docs, **options).groupBy("root").agg(first.alias("first")).select("first.row"))
