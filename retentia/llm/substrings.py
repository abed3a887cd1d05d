"""Repeated substrings by blockwise suffix sorting with a difference cover."""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from retentia.llm.common import Batches, numbered, stored, texts

# Differences of these residues modulo 31 give every residue: any two positions reach the cover by one step under 31.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
GRAM = 32  # bytes of an anchor; doubled for classes that are too large, up to the whole window


def _delta() -> np.ndarray:
    """The least step that takes residues i and j into the cover together."""
    table = np.zeros((PERIOD, PERIOD), np.int64)
    for i in range(PERIOD):
        for j in range(PERIOD):
            table[i, j] = next(d for d in range(PERIOD) if (i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER)
    return table


DELTA = _delta()


def words_at(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each position of ``buffer`` as a number; the last seven positions are left out."""
    return np.lib.stride_tricks.as_strided(buffer.view(np.uint8), (len(buffer) - 7, 8), (1, 1)).view("<u8")[:, 0]


def sliding(f, x: np.ndarray, width: int) -> np.ndarray:
    """``f`` (minimum or maximum) over every ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        x = f(x[:-have], x[have:])
        have *= 2
    return f(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (eight at least) from each position of ``data``."""
    w = words_at(data)
    n = len(data) - gram + 1
    mixed = w[:n] * np.uint64(0x9E3779B97F4A7C15)
    for i in sorted({*range(8, gram - 7, 8), gram - 8} - {0}):
        mixed += w[i : i + n] ^ (w[i : i + n] >> np.uint64(29))
        mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xFF51AFD7ED558CCD)
    return mixed


def anchors(data: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last start of the windows of ``length`` bytes that share an anchor, and the hash of the anchor.

    The anchor of a window is its first gram of least hash, so equal windows have the same anchor at the same
    place, wherever they stand. Every window belongs to one anchor.
    """
    if len(data) < length:
        return (np.empty(0, np.int64),) * 3
    mixed = gram_hashes(data, gram)
    order = (mixed >> np.uint64(32)).astype(np.uint32)
    width = length - gram + 1
    least = sliding(np.minimum, order, width)
    edge = np.zeros(width - 1, np.uint32)
    at = np.flatnonzero(sliding(np.maximum, np.concatenate([edge, least, edge]), width) == order)
    values = order[at]
    owner = np.searchsorted(at, np.arange(len(least)))
    wrong = np.flatnonzero(values[owner] != least)
    while len(wrong):  # on to the next anchor, until it is the least of the window
        owner[wrong] += 1
        wrong = wrong[values[owner[wrong]] != least[wrong]]
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    last = np.append(first[1:], len(owner)) - 1
    return first, last, mixed[at[owner[first]]].view(np.int64)


# --- one block ---


def cover_ranks(text: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes at cover positions, all different; other positions stay 0.

    Positions of the cover recur every PERIOD bytes, so ranks by 31 bytes double to 62, 124 and on, until no
    two are equal. Of suffixes that run over the end, the shorter comes first.
    """
    n = len(text) - 2 * PERIOD  # the text is padded
    at = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
    ranks = np.zeros(len(text), np.int64)
    ranks[at] = _rank_rows(_prefix_keys(text, at))
    have = PERIOD
    while len(at) and ranks[at].max() + 1 < len(at):
        after = at + have
        beyond = n + have
        second = np.where(after < n, beyond + ranks[np.minimum(after, n - 1)], beyond - 1 - (after - n))
        pairs = ranks[at] * (beyond + len(at) + 1) + second
        ranks[at] = np.unique(pairs, return_inverse=True)[1]
        have *= 2
    return ranks


def _prefix_keys(text: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The first PERIOD bytes from each position as numbers whose order is that of the bytes."""
    w = words_at(text)
    keys = [w[at + i].byteswap() for i in (0, 8, 16)]
    return [*keys, w[at + PERIOD - 8].byteswap()]  # overlaps the third by one byte


def _rank_rows(keys: list[np.ndarray]) -> np.ndarray:
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), np.int64)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def _settle_ties(at: np.ndarray, group: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """``at`` with the members of each group in suffix order; members agree in the first PERIOD bytes.

    All groups are merge-sorted at once. Two suffixes are compared by the ranks of the cover positions
    that both reach by the same step.
    """
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(starts, len(group)))
    first = np.repeat(starts, sizes)
    last = first + np.repeat(sizes, sizes)
    place = np.arange(len(at))
    run = 1
    while run < sizes.max(initial=1):
        mine = first + (place - first) // run * run  # start of the own run
        left = (mine - first) // run % 2 == 0
        begin = np.where(left, np.minimum(mine + run, last), mine - run)  # of the run it is merged with
        low = begin.copy()
        high = np.where(left, np.minimum(mine + 2 * run, last), mine)
        own = at % PERIOD
        while (open_ := low < high).any():
            i = np.flatnonzero(open_)
            middle = (low[i] + high[i]) // 2
            a, b = at[i], at[middle]
            step = DELTA[own[i], own[middle]]
            ra, rb = ranks[a + step], ranks[b + step]
            before = np.where(left[i], rb < ra, rb <= ra)  # the other's member stands before the own
            low[i] = np.where(before, middle + 1, low[i])
            high[i] = np.where(before, high[i], middle)
        target = np.where(left, mine, mine - run) + (place - mine) + (low - begin)
        moved = np.empty_like(at)
        moved[target] = at
        at = moved
        run *= 2
    return at


def sorted_suffixes(text: np.ndarray, at: np.ndarray, bucket: int):
    """The suffixes at ``at`` in order, one bucket of about ``bucket`` after the other.

    Buckets are ranges of the first two bytes. A bucket is sorted by its first 31 bytes; longer ties are
    settled by the precomputed ranks of cover positions.
    """
    ranks = cover_ranks(text)
    lead = text[at].astype(np.int64) << 8 | text[at + 1]
    sizes = np.bincount(lead, minlength=1 << 16)
    cuts, held = [0], 0
    for value in np.flatnonzero(sizes).tolist():
        if held and held + sizes[value] > bucket:
            cuts.append(value)
            held = 0
        held += int(sizes[value])
    for low, high in pairwise([*cuts, 1 << 16]):
        own = at[(lead >= low) & (lead < high)]
        if not len(own):
            continue
        group = _rank_rows(_prefix_keys(text, own))
        order = np.argsort(group, kind="stable")
        yield _settle_ties(own[order], group[order], ranks)


def repeated_windows(contexts: list[bytes], length: int, bucket: int = 1 << 18):
    """Classes of equal windows of ``length`` bytes of the contexts, as (context, offset, class); single ones left out."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    text = np.frombuffer(b"".join(contexts) + bytes(2 * PERIOD + 2 * length), np.uint8)
    counts = np.maximum(0, sizes - length + 1)
    context = np.repeat(np.arange(len(contexts)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[context] + offset
    of = np.full(len(text), -1, np.int64)
    of[at] = np.arange(len(at))
    w = words_at(text)
    found, classes = [], 0
    for order in sorted_suffixes(text, at, bucket):
        same = np.ones(len(order) - 1, bool)
        for i in [*range(0, length - 8, 8), length - 8]:
            j = np.flatnonzero(same)
            same[j] = w[order[j] + i] == w[order[j + 1] + i]
        number = np.concatenate(([0], np.cumsum(~same))) + classes
        classes = int(number[-1]) + 1
        many = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        which = of[order[many]]
        found.append(np.stack([context[which], offset[which], number[many]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


# --- Spark jobs ---


ANCHORS = "row long, first int, last int, anchor long, context long"
CONTEXT = "anchor long, copies long, row long, start int, bytes binary"
SPANS = "row long, start int, end int"
SPAN_SCHEMA = pa.schema([("row", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def _anchored(length: int):
    schema = pa.schema([("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("anchor", pa.int64()), ("context", pa.int64())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for row, text in zip(part["row"].to_pylist(), texts(part["text"])):
                    first, last, gram = anchors(np.frombuffer(text, np.uint8), length)
                    around = [xxh3_64_intdigest(text[a : b + length]) for a, b in zip(first.tolist(), last.tolist())]
                    numbers = (first.astype(np.int32), last.astype(np.int32), gram, np.array(around, np.uint64).view(np.int64))
                    out.append((np.full(len(first), row), *numbers))
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)

    return task


def _reanchored(length: int, gram: int):
    """Contexts of a class that is too large, cut at anchors of ``gram`` bytes; the class is part of the new anchor."""
    schema = pa.schema([("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("anchor", pa.int64()), ("context", pa.int64()), ("copies", pa.int64())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 10):
                out = []
                for x in batch.slice(at, 1 << 10).to_pylist():
                    text = x["bytes"]
                    first, last, found = anchors(np.frombuffer(text, np.uint8), length, gram)
                    around = [xxh3_64_intdigest(text[a : b + length]) for a, b in zip(first.tolist(), last.tolist())]
                    own = np.full(len(first), x["anchor"]) * np.int64(0x9E3779B97F4A7C1) ^ found
                    places = ((first + x["start"]).astype(np.int32), (last + x["start"]).astype(np.int32))
                    context = np.array(around, np.uint64).view(np.int64)
                    out.append((np.full(len(first), x["row"]), *places, own, context, np.full(len(first), x["copies"])))
                yield pa.record_batch([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return task


def _contexts(length: int):
    """Contexts of the anchors wanted of each document."""
    schema = pa.schema([("anchor", pa.int64()), ("copies", pa.int64()), ("row", pa.int64()), ("start", pa.int32()), ("bytes", pa.binary())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for row, text, wanted in zip(batch["row"].to_pylist(), texts(batch["text"]), batch["wanted"].to_pylist()):
                out += [(x["anchor"], x["copies"], row, x["first"], text[x["first"] : x["last"] + length]) for x in wanted]
            for at in range(0, len(out), 1 << 13):
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out[at : at + (1 << 13)]), schema)], schema=schema)

    return task


def _merged(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    """Spans by row and start, with those that touch joined."""
    order = np.lexsort((starts, rows))
    rows, starts, ends = rows[order], starts[order], ends[order]
    reach = np.empty_like(ends)
    new = np.ones(len(rows), bool)
    if len(rows):
        new[1:] = (rows[1:] != rows[:-1]) | (starts[1:] > ends[:-1])  # ends rise with starts: all spans are as long
        reach = ends[np.append(np.flatnonzero(new)[1:] - 1, len(rows) - 1)]
    columns = (rows[new], starts[new].astype(np.int32), reach.astype(np.int32))
    return pa.record_batch([pa.array(c) for c in columns], schema=SPAN_SCHEMA)


def _block_spans(length: int, block: int):
    """Repeated windows of contexts sorted by anchor; whole classes of anchors are taken together up to ``block`` bytes."""

    def solved(held: list[dict]) -> pa.RecordBatch:
        context, offset, _ = repeated_windows([x["bytes"] for x in held], length).T
        row, start = np.array([x["row"] for x in held]), np.array([x["start"] for x in held], np.int64)
        own = ~np.array([x["copies"] > 1 for x in held])[context]  # copied contexts are removed whole already
        at = start[context[own]] + offset[own]
        return _merged(row[context[own]], at, at + length)

    def task(batches: Batches) -> Batches:
        held: list[dict] = []
        size, last = 0, None
        for batch in batches:
            for x in batch.to_pylist():
                if size >= block and x["anchor"] != last:
                    yield solved(held)
                    held, size = [], 0
                held.append(x)
                size, last = size + len(x["bytes"]), x["anchor"]
        if held:
            yield solved(held)

    return task


def grams(length: int) -> list[int]:
    """Sizes of anchors, from the first to the whole window."""
    sizes = [GRAM]
    while sizes[-1] < length:
        sizes.append(min(2 * sizes[-1], length))
    return sizes


def repeated_spans(docs: DataFrame, length: int, block: int, hot: int) -> DataFrame:
    """Spans (``row``, ``start``, ``end``) whose union is every byte in a window that also starts elsewhere; they may overlap."""
    found = stored(docs.mapInArrow(_anchored(length), ANCHORS), "anchors").withColumn("copies", F.lit(1).cast("long"))
    spans, sizes = None, grams(length)
    for gram, finer in zip(sizes, [*sizes[1:], None]):
        whole, contexts = _shared(docs, found, length)
        large = None
        if finer:
            counts = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts"))
            large = stored(counts.filter(F.col("contexts") > hot).select("anchor"), f"hot-anchors-{gram}")
            large = None if large.isEmpty() else large
        cold = contexts.join(large, "anchor", "left_anti") if large else contexts
        blocks = cold.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_block_spans(length, block), SPANS)
        spans = whole.unionByName(blocks) if spans is None else spans.unionByName(whole).unionByName(blocks)
        if not large:
            return spans
        again = contexts.join(large, "anchor", "left_semi").mapInArrow(_reanchored(length, finer), f"{ANCHORS}, copies long")
        found = stored(again, f"anchors-{finer}")
    return spans


def _shared(docs: DataFrame, found: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Spans of contexts found twice, and one copy of each context whose anchor has different ones."""
    shared = found.groupBy("anchor").agg(F.sum("copies").alias("n"), (F.min("context") != F.max("context")).alias("varied")).filter("n > 1")
    shared = stored(shared.select("anchor", "varied"), "shared-anchors")  # so that the join's hot anchors can be split
    hits = stored(found.join(shared, "anchor"), "anchor-hits")
    copies = hits.groupBy("anchor", "context").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("row", "first", "last")).alias("one"), F.first("varied").alias("varied")
    )
    copies = stored(copies, "contexts")
    whole = hits.join(copies.filter("copies > 1").select("anchor", "context"), ["anchor", "context"], "left_semi")
    whole = whole.select("row", F.col("first").alias("start"), (F.col("last") + length).alias("end"))

    wanted = copies.filter("varied").select("one.row", F.struct("one.first", "one.last", "anchor", "copies").alias("x"))
    wanted = wanted.groupBy("row").agg(F.collect_list("x").alias("wanted"))  # of one document
    return whole, stored(docs.join(wanted, "row").mapInArrow(_contexts(length), CONTEXT), "context-bytes")


def _cleaned(batches: Batches) -> Batches:
    schema = pa.schema(
        [("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")], ("kept", pa.binary()), ("spans", pa.list_(pa.list_(pa.int32())))]
    )
    for batch in batches:
        out = []
        for doc, text, spans in zip(batch["doc_id"].to_pylist(), texts(batch["text"]), batch["spans"].to_pylist()):
            gone: list[list[int]] = []
            for x in sorted(((s["start"], min(s["end"], len(text))) for s in spans or ())):
                if gone and x[0] <= gone[-1][1]:
                    gone[-1][1] = max(gone[-1][1], x[1])
                else:
                    gone.append(list(x))
            edges = [0, *[e for x in gone for e in x], len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if gone else text
            out.append((doc, len(text), len(text) - len(kept), len(gone), kept, gone))
        for at in range(0, len(out), 256):
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out[at : at + 256]), schema)], schema=schema)


def without_repeats(docs: DataFrame, length: int = 200, block: int = 1 << 20, hot: int = 1 << 14) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the bytes left) and ``spans`` removed.

    Texts are UTF-8 bytes, null is empty; a byte goes if a string of ``length`` bytes that covers it also
    starts at another place, in the same document or another; matches never cross documents. Repeated rows
    are each other's copies and lose all such bytes; no documents, no rows; other columns are ignored.

    1. Every window has an anchor, the first gram of least hash, so equal windows share one; the windows of an
       anchor are its context. Anchors found once are dropped. Of the others, contexts that are found twice are
       removed whole; what is left to decide are anchors with different contexts.
    2. One copy of each different context is fetched and goes to the block of its anchor. A block is sorted
       blockwise with a difference cover; windows are repeated if their neighbours in suffix order begin
       with the same ``length`` bytes, which is compared byte by byte.
    3. Anchors with over ``hot`` different contexts don't go into one block: their contexts are cut again at the
       least grams of twice the size and go through the same steps, in smaller classes. A gram as long as the
       window ends this: contexts are then single windows, and equal ones are removed whole.
    """
    rows = numbered(docs, "doc_id", "text")
    spans = repeated_spans(rows.select("row", "text"), length, block, hot)
    gathered = spans.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # of one document
    sql = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<array<int>>"
    return rows.join(gathered, "row", "left").select("doc_id", "text", "spans").mapInArrow(_cleaned, sql)
