"""Packing by multiway differencing (Karmarkar and Karp)."""

from __future__ import annotations

import gc
import heapq
import re
import sys
import zlib
from array import array
from string import punctuation

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from retentia.llm.common import Batches, rows_out

# A token never reaches over the start of a space that is followed by a visible character.
BEFORE_WORD = re.compile(r" (?=\S)")
# How byte-level vocabularies write the bytes: the visible ones of Latin-1 as themselves, the others from 256 on.
VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in VISIBLE)}
SPACE = chr(ALPHABET[32])
SCHEMA = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
)


class Encoder:
    """Token ids of a text as little-endian 32-bit bytes, for files of byte-level BPE.

    The text is cut before words; every different word, and every different pre-token of words that are not
    plain letters, is encoded once per task. Special tokens' strings in a text are ordinary text. ``words``
    bounds what is remembered.
    """

    def __init__(self, path: str, words: int):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        split, tokenize = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
        swap = sys.byteorder == "big"

        def ids_of(written: str) -> bytes:
            ids = array("I", [t.id for t in tokenize(written)])
            if swap:
                ids.byteswap()
            return ids.tobytes()

        class Pieces(dict):
            """Ids by pre-token."""

            def __missing__(self, piece: str) -> bytes:
                if piece.isascii() and piece.isprintable():
                    written = piece.replace(" ", SPACE)
                else:
                    written = piece.encode().decode("latin-1").translate(ALPHABET)
                found = self[piece] = ids_of(written)
                return found

        pieces = Pieces()

        def encode(lead: str, part: str) -> bytes:
            """Letters with marks after them are two pre-tokens, a single line end is one; all else is left to the tokenizer."""
            core = part.rstrip(punctuation)
            if core.isalpha():
                tail = part[len(core) :]
                return pieces[lead + core] + pieces[tail] if tail else pieces[lead + core]
            first, end, rest = part.partition("\n")
            if end and first and rest and not first[-1].isspace() and not rest[0].isspace():
                return encode(lead, first) + pieces[end] + encode("", rest)
            return b"".join([ids_of(p) for p, _ in split(lead + part)])

        class Words(dict):
            """Ids by word, with the space before it."""

            def __missing__(self, word: str) -> bytes:
                found = self[word] = encode(" ", word)
                return found

        self.encode, self.known, self.pieces, self.limit = encode, Words(), pieces, words

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if len(self.known) > self.limit:
            self.known.clear()
            self.pieces.clear()
        words = BEFORE_WORD.split(text)
        words[0] = self.encode("", words[0])
        words[1:] = map(self.known.__getitem__, words[1:])
        return b"".join(words)


def differencing(sizes: list[int], k: int) -> list:
    """``k`` windows of near-equal sums, as trees of item numbers.

    A partial partition is a list of at most ``k`` (surplus, items), largest first; the two with the
    widest spread are merged, the largest of one with the smallest of the other, and the common
    surplus is dropped.
    """
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(a) + len(b) <= k:
            merged = a + b
        else:
            alone_a, alone_b = k - len(b), k - len(a)
            merged = a[:alone_a] + b[:alone_b]
            merged += [(s + t, (x, y)) for (s, x), (t, y) in zip(a[alone_a:], reversed(b[alone_b:]))]
        merged.sort(key=lambda e: -e[0])
        least = merged[-1][0] if len(merged) == k else 0
        if least:
            merged = [(s - least, x) for s, x in merged]
        heapq.heappush(heap, (-merged[0][0], made, merged))
        made += 1
    return [x for _, x in heap[0][2]] if heap else []


def items_of(tree) -> list[int]:
    out, todo = [], [tree]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            todo.extend(x)
        else:
            out.append(x)
    return sorted(out)


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items by window; one more window, or as many as the imbalance asks for, while one is overfull."""
    total = sum(sizes)
    k = -(-total // capacity)
    while sizes:
        found = [items_of(x) for x in differencing(sizes, k)]
        over = max(sum(sizes[i] for i in w) for w in found) - total // k
        if over + total // k <= capacity:
            return found
        k = max(k + 1, -(-total // (capacity - over)) if over < capacity else 0)
    return []


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, grain: int = 256, block: int = 128, words: int = 500_000) -> DataFrame:
    """One row per piece of a document and the place it has in a sequence of at most ``capacity`` tokens.

    A document's ids are those of its text (null: none) and a final 0. Whole sequences are cut from its
    front; what is left (under ``capacity`` ids) is cut into items of ``grain`` ids, and the items of
    about ``block`` sequences are balanced together. Every task packs the documents it reads, so nothing
    is shuffled and memory is bounded by a block and the longest document. Repeated rows are packed each;
    a null ``doc_id`` stays null; other columns are ignored; no documents, no rows.
    """

    def task(batches: Batches) -> Batches:
        gc.disable()  # nothing here forms cycles; collections would only walk the remembered words
        try:
            yield from packed(batches)
        finally:
            gc.enable()

    def packed(batches: Batches) -> Batches:
        encode = Encoder(tokenizer, words)
        sequence = TaskContext.get().partitionId() << 40
        items: list[tuple] = []
        waiting = 0

        def balanced() -> list[tuple]:
            nonlocal sequence, items, waiting
            out = []
            for window in windows([x[2] for x in items], capacity):
                at = 0
                for i in window:
                    out.append((*items[i], sequence, at))
                    at += items[i][2]
                sequence += 1
            items, waiting = [], 0
            return out

        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = encode(text or "") + bytes(4)
                n = len(ids) // 4
                whole = n - n % capacity
                starts = [*range(0, whole, capacity), *range(whole, n, grain)]
                for start, end in zip(starts, [*starts[1:], n]):
                    piece = (doc, start, end - start, zlib.crc32(ids[4 * start : 4 * end]), n)
                    if end - start == capacity:
                        rows.append((*piece, sequence, 0))
                        sequence += 1
                    else:
                        items.append(piece)
                        waiting += end - start
                if waiting >= block * capacity:
                    rows += balanced()
            yield from rows_out(SCHEMA, rows)
        yield from rows_out(SCHEMA, balanced())

    names = ", ".join(f"{f.name} long" for f in SCHEMA)
    return docs.select("doc_id", "text").mapInArrow(task, names)
