"""Token counts under a unigram model, by dynamic programming over a shared trie."""

from __future__ import annotations

import math
from string import punctuation

import pyarrow as pa
from pyspark.sql import DataFrame

from retentia.llm.common import Batches

BLANK = "▁"  # stands before every pre-token


def piece_scores(path: str) -> dict[str, float]:
    """Pieces of a vocabulary file with the logarithm of a Zipf probability of their rank; bytes and controls left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    norm = math.log(sum(1 / (r + 10) for r in range(len(names))))
    return {p: -math.log(r + 10) - norm for r, p in enumerate(names)}


class SharedTrie:
    """Tokens of the best segmentation of a pre-token; every prefix is scored once, however many share it.

    Node 0 is the empty prefix. A node holds the best score of its prefix and the tokens of that
    segmentation (fewer tokens win ties); both follow from the nodes of shorter prefixes alone. Characters
    that no piece covers cost one token per byte. ``nodes`` bounds the trie: when it is full it starts anew,
    which changes no count.
    """

    def __init__(self, scores: dict[str, float], nodes: int = 1_000_000, longest: int = 64):
        self.scores, self.limit, self.longest = scores, nodes, longest
        self.ends = {p[i:]: scores.get(p[i:]) for p in scores for i in range(len(p))}
        self.joined = {p[i - 1 : i + 1] for p in scores for i in range(1, len(p)) if p[i] in punctuation and p[i - 1] not in punctuation}
        self.worst = min(scores.values(), default=-10.0) - 10.0
        self._clear()

    def _clear(self) -> None:
        self.child: dict[int, int] = {}  # by node and character
        self.best, self.tokens = [0.0], [0]
        self.terminal: dict[str, int] = {}  # by pre-token
        self.words: dict[str, int] = {}

    def _score(self, text: str, end: int, best: list[float], tokens: list[int]) -> tuple[float, int]:
        """Of the prefix that ends at ``end``, from the scores of all shorter ones."""
        last = text[end - 1]
        n = 1 if last.isascii() else len(last.encode("utf-8", "replace"))
        high, least, ends = best[end - 1] + n * self.worst, tokens[end - 1] + n, self.ends
        for start in range(end - 1, -1, -1):
            piece = text[start:end]
            if piece not in ends:
                break  # nor does any longer piece end so
            own = ends[piece]
            if own is not None:
                own += best[start]
                if own > high or own == high and tokens[start] < least:
                    high, least = own, tokens[start] + 1
        return high, least

    def pre_token(self, text: str) -> int:
        known = self.terminal.get(text)
        if known is not None:
            return known
        best, tokens = [0.0], [0]
        if len(text) > self.longest:  # long runs share little: scored by themselves, not stored
            for end in range(1, len(text) + 1):
                b, t = self._score(text, end, best, tokens)
                best.append(b)
                tokens.append(t)
            return tokens[-1]
        node, child, all_best, all_tokens = 0, self.child, self.best, self.tokens
        for end, c in enumerate(text, 1):
            key = node << 21 | ord(c)
            node = child.get(key)
            if node is None:
                node = child[key] = len(all_best)
                b, t = self._score(text, end, best, tokens)
                all_best.append(b)
                all_tokens.append(t)
            best.append(all_best[node])
            tokens.append(all_tokens[node])
        self.terminal[text] = tokens[-1]
        return tokens[-1]

    def count(self, word: str) -> int:
        """Tokens of a word with a blank before it.

        Marks at its end are scored as a pre-token of their own, which keeps the trie small, but only where
        no piece holds both sides of the cut: then the sum is that of the whole word.
        """
        if len(self.best) > self.limit:
            self._clear()
        core = word.rstrip(punctuation)
        if core and len(core) < len(word) and word[len(core) - 1 : len(core) + 1] not in self.joined:
            found = self.pre_token(BLANK + core) + self.pre_token(word[len(core) :])
        else:
            found = self.pre_token(BLANK + word)
        if len(word) <= self.longest:
            self.words[word] = found
        return found


def token_counts(docs: DataFrame, vocabulary: str, nodes: int = 1_000_000) -> DataFrame:
    """Per row: ``doc_id``, ``n_words`` (between white space), ``n_tokens``.

    Every task keeps a trie of the distinct pre-tokens it meets; nothing is shuffled. Null and blank texts
    have no words; repeated rows get equal counts; no documents, no rows; other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def task(batches: Batches) -> Batches:
        trie = SharedTrie(piece_scores(vocabulary), nodes)
        for batch in batches:
            words, tokens = [], []
            for text in batch["text"].to_pylist():
                parts = (text or "").split()
                found = trie.words
                words.append(len(parts))
                tokens.append(sum([found[w] if w in found else trie.count(w) for w in parts]))
            yield pa.record_batch([batch["doc_id"], pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, n_words long, n_tokens long")
