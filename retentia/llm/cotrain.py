"""Quality classifier by co-training a text view and a metadata view."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retentia.llm.common import Batches, bounded_sample, numbered, stored

WORDS = 1 << 10  # hashed word features
MARKS = b"#*$%&|<>{}=@"
SHAPE = 10  # shape features
META = 1 << 8  # hashed metadata features
NOT_WORD = re.compile(rb"[^\w\x80-\xff]+")


def text_features(text: bytes) -> np.ndarray:
    """Hashed words by square root of share, and the shape of the text: all of it, nothing else."""
    words = text.lower().split()
    x = np.zeros(WORDS + SHAPE, np.float32)
    if not words:
        return x
    seen = Counter(words)
    for word, n in seen.items():
        x[zlib.crc32(NOT_WORD.sub(b"", word)) % WORDS] += n
    n = len(words)
    x[:WORDS] = np.sqrt(x[:WORDS] / n)
    lines = [line for line in text.split(b"\n") if line.strip()]
    marks = len(text) - len(text.translate(None, MARKS))
    digits = len(text) - len(text.translate(None, b"0123456789"))
    x[WORDS:] = (
        math.log1p(n) / 10, math.log1p(len(text) / n) / 2, math.sqrt(marks / n), math.sqrt(digits / n), len(seen) / n,
        math.log1p(len(seen)) / math.log1p(n), 1 - len(set(lines)) / len(lines), max(seen.values()) / n,
        min(5.0, n / len(lines) / 20), min(3.0, text.count(b".") / n * 5),
    )
    return x


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Language, source, both together and the length class, hashed; nothing of the text."""
    x = np.zeros(META, np.float32)
    size = -1 if n_chars is None else int(2 * math.log2(1 + max(0, n_chars)))
    for part in (f"l={lang}", f"s={source}", f"ls={lang}:{source}", f"c={size}", f"lc={lang}:{size}"):
        x[zlib.crc32(part.encode("utf-8", "replace")) % META] += 1
    return x


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        curved = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curved, gradient)
        w -= move
        if np.abs(move).max() < 1e-5:
            break
    return w


def margins(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class CoTrained:
    """Weights of both views, and of the calibrated combination of their log-odds."""

    text: np.ndarray
    meta: np.ndarray
    scale: np.ndarray  # rows: text, meta; slope and offset to calibrated log-odds
    mix: np.ndarray  # weights of the calibrated views, and a bias

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        odds = [margins(x, w) * s + o for x, w, (s, o) in ((text, self.text, self.scale[0]), (meta, self.meta, self.scale[1]))]
        both = odds[0] * self.mix[0] + odds[1] * self.mix[1] + self.mix[2]
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (*odds, both))

    @classmethod
    def fit(
        cls, views: tuple[np.ndarray, np.ndarray], y: np.ndarray, rounds: int = 3, exchanged: float = 0.1, certain: float = 0.95,
        pool: Pool | None = None,
    ) -> CoTrained:
        """``y``: 1, 0, or -1 for unlabelled rows, which are the pool unless another one is given.

        A third of the labelled rows is kept for calibration. In each round every view is fitted to the
        labels and to what the other view is most certain of: at most a share ``exchanged`` of the pool per
        round, from both classes in proportion to the labels, and only beyond ``certain``.
        """
        rng = np.random.default_rng(5)
        labelled = np.flatnonzero(y >= 0)
        if pool is None:
            pool = Pool(tuple(v[y < 0] for v in views))
        held = labelled[rng.permutation(len(labelled))[: len(labelled) // 3]]
        first = np.setdiff1d(labelled, held)
        share = max(0.02, min(0.98, float(y[first].mean()) if len(first) else 0.5))
        given: list[dict[int, tuple[int, np.ndarray]]] = [{}, {}]

        def fitted(v: int) -> np.ndarray:
            more = list(given[v].values())
            x = np.concatenate([views[v][first], np.array([x for _, x in more], np.float32).reshape(len(more), views[v].shape[1])])
            truth = np.concatenate([y[first], np.array([label for label, _ in more], int)]).astype(float)
            weight = np.concatenate([np.ones(len(first)), np.full(len(more), 0.3)])
            weight *= np.where(truth > 0, 0.5 / share, 0.5 / (1 - share))  # both classes weigh the same
            return logistic(x, truth, weight)

        for step in range(rounds):
            for v in (0, 1):
                parts = {1: exchanged * share, 0: exchanged * (1 - share)}
                for row, label, x in pool.most_certain(v, fitted(v), parts, certain, step):
                    given[1 - v][row] = (label, x)
        weights = [fitted(0), fitted(1)]
        known = held if len(set(y[held].tolist())) == 2 else labelled
        scale = []
        for x, w in zip(views, weights):
            slope = logistic(margins(x[known], w)[:, None], y[known].astype(float), np.ones(len(known)), 0.01)
            scale.append((max(0.0, float(slope[0])), float(slope[1])))
        odds = np.stack([margins(x[known], w) * s + o for x, w, (s, o) in zip(views, weights, scale)], axis=1)
        mix = logistic(odds, y[known].astype(float), np.ones(len(known)), 0.1)
        return cls(*weights, np.array(scale), mix)


class Pool:
    """Unlabelled rows in memory."""

    def __init__(self, views: tuple[np.ndarray, np.ndarray]):
        self.views = views

    def most_certain(self, v: int, w: np.ndarray, parts: dict[int, float], certain: float, step: int) -> list[tuple[int, int, np.ndarray]]:
        """Number, label and other view of the rows that view ``v`` is most certain of, at most ``parts`` of all per label."""
        p, found = 1 / (1 + np.exp(-margins(self.views[v], w))), []
        for label, sure in ((1, p), (0, 1 - p)):
            best = np.argsort(-sure, kind="stable")[: int(parts[label] * len(p))]
            found += [(int(i), label, self.views[1 - v][i]) for i in best if sure[i] >= certain]
        return found


REACH, BINS = 16, 4096  # log-odds are counted in bins of 1/128 up to 16


class TablePool(Pool):
    """A stored table of features, without the documents that ``known`` labels.

    Every row is scored in every round. How certain a view is of how many is counted in bins, added up over
    the tasks; that gives the least log-odds of the most certain share, to the width of a bin. Of the rows
    beyond it, about ``bound`` per label and round, chosen by a hash, come to the driver; those with a label
    of their own are taken out of these by a join of ids, so features are never shuffled.
    """

    def __init__(self, rows: DataFrame, bound: int, known: DataFrame):
        self.rows, self.bound, self.known = rows, bound, known.select("doc_id")

    def most_certain(self, v: int, w: np.ndarray, parts: dict[int, float], certain: float, step: int) -> list[tuple[int, int, np.ndarray]]:
        w, rows, least = w.astype(np.float32), self.rows, math.log(certain / (1 - certain))

        def bins(batch: pa.RecordBatch) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
            views = _stored_views(batch)
            z = np.clip(margins(views[v], w), -REACH, np.nextafter(np.float32(REACH), np.float32(0)))
            return views, ((z + REACH) * (BINS / (2 * REACH))).astype(np.int64)

        def count(batches: Batches) -> Batches:
            total = np.zeros(BINS, np.int64)
            for batch in batches:
                total += np.bincount(bins(batch)[1], minlength=BINS)
            used = np.flatnonzero(total)
            yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["bin", "n"])

        counts = np.zeros(BINS, np.int64)
        for r in rows.mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():  # BINS rows at most
            counts[r["bin"]] = r["n"]
        cuts = {}
        width = BINS / (2 * REACH)
        for label, own in ((1, counts[::-1]), (0, counts)):  # the most certain first
            usable = int((REACH - least) * width)
            most = int(parts[label] * counts.sum())
            reached = int(np.searchsorted(np.cumsum(own[:usable]), most)) + 1 if most else 0
            reached = min(reached, usable)
            n = int(own[:reached].sum())
            cuts[label] = (reached, min(1.0, self.bound / n) if n else 0.0)

        def chosen(batches: Batches) -> Batches:
            for batch in batches:
                views, at = bins(batch)
                draw = _row_share(batch["row"].to_numpy(zero_copy_only=False), 2 * step + v)
                for label, (reached, rate) in cuts.items():
                    near = at >= BINS - reached if label else at < reached
                    take = np.flatnonzero(near & (draw < rate))
                    other = [views[1 - v][i].tobytes() for i in take]
                    yield pa.record_batch(
                        [*[batch[c].take(pa.array(take)) for c in ("doc_id", "row")], pa.array(np.full(len(take), label, np.int32)), pa.array(other, pa.binary())],
                        names=["doc_id", "row", "label", "x"],
                    )

        unlabelled = rows.mapInArrow(chosen, "doc_id long, row long, label int, x binary").join(self.known, "doc_id", "left_anti")
        found = sorted(map(tuple, unlabelled.select("row", "label", "x").collect()))
        return [(row, label, np.frombuffer(x, np.float32)) for row, label, x in found]


def _row_share(rows: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row number: a bit mix of the number and ``seed``."""
    z = rows.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (z ^ (z >> np.uint64(31))) / 2.0**64


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    text = np.array([text_features(t or b"") for t in batch["text"].cast(pa.binary()).to_pylist()], np.float32)
    meta = [meta_features(*x) for x in zip(*[batch[c].to_pylist() for c in ("lang", "source", "n_chars")])]
    return text.reshape(batch.num_rows, WORDS + SHAPE), np.array(meta, np.float32).reshape(batch.num_rows, META)


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
FEATURES_SQL = "row long, doc_id long, lang string, source string, n_chars long, x binary"


def _stored_views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    text = np.array([np.frombuffer(x, np.float32) for x in batch["x"].to_pylist()], np.float32)
    meta = [meta_features(*x) for x in zip(*[batch[c].to_pylist() for c in ("lang", "source", "n_chars")])]
    return text.reshape(batch.num_rows, WORDS + SHAPE), np.array(meta, np.float32).reshape(batch.num_rows, META)


def stored_features(docs: DataFrame) -> DataFrame:
    """The text view of every document and its metadata, written once for all rounds."""

    def task(batches: Batches) -> Batches:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                x = [text_features(t or b"").tobytes() for t in batch["text"].cast(pa.binary()).to_pylist()]
                yield pa.record_batch([*[batch[c] for c in ("row", "doc_id", "lang", "source", "n_chars")], pa.array(x, pa.binary())], names=[c.split()[0] for c in FEATURES_SQL.split(", ")])

    return stored(numbered(docs, *COLUMNS).mapInArrow(task, FEATURES_SQL), "quality-features")


def train(docs: DataFrame, labels: DataFrame, labelled: int = 3000, exchanged: int = 500) -> CoTrained:
    """A model from about ``labelled`` labelled documents (half of each class where there are as many) and, per view,
    class and round, about ``exchanged`` of those unlabelled documents that the other view is most certain of.

    All unlabelled documents take part in every round (see :class:`TablePool`); the two bounds only limit the
    rows a view is fitted on, which the driver holds: 9,000 rows of about 5 KB at most. Contradicting labels of a
    document count as low quality. Without labels nothing is learned.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    features = stored_features(docs)
    marked = features.select("row", "doc_id").join(known, "doc_id")
    chosen = bounded_sample(marked, "y", labelled // 2, labelled, "labels", F.col("doc_id"), F.col("row")).select("row", "y")
    rows = features.join(F.broadcast(chosen), "row")  # ``labelled`` rows of two numbers
    found = pa.Table.from_pylist([r.asDict() for r in sorted(rows.collect(), key=lambda r: r["row"])], pa.schema([
        ("row", pa.int64()), ("y", pa.int32()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()), ("x", pa.binary()),
    ]))
    views = _stored_views(found)
    pool = TablePool(features, exchanged, known) if found.num_rows else Pool(views)
    return CoTrained.fit(views, np.array(found["y"].to_pylist(), int), pool=pool)


def scored(docs: DataFrame, model: CoTrained) -> DataFrame:
    """Per row: ``doc_id``, calibrated chances ``text_score`` and ``meta_score``, their combination ``score``, and ``kept``.

    All documents are scored, whole. Nulls in any column are values of their own, a null text is empty;
    repeated rows get equal scores; no documents, no rows; without labels every score is a half.
    """
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.float64()) for c in ("text_score", "meta_score", "score")], ("kept", pa.bool_())])

    def task(batches: Batches) -> Batches:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = [pa.array(p) for p in model.score(*_features(batch))]
                yield pa.record_batch([batch["doc_id"], *found, pa.array(found[2].to_numpy() >= 0.5)], schema=schema)

    return docs.select(*COLUMNS).mapInArrow(task, "doc_id long, text_score double, meta_score double, score double, kept boolean")
