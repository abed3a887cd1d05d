"""Language identification: the family first, then one-versus-one linear SVMs within it."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from retentia.llm.common import Batches, bounded_sample, texts

# Language families by ISO 639-1 code; a language that is not listed is its own family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "pl", "cs", "uk", "bg", "sr", "hr", "sk", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk"),
}
UNKNOWN = "und"
SIZE = 1 << 13  # features
# Letters A-Z in lower case, every other ASCII byte a blank; bytes of other letters stay.
FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)], np.uint32)


def features(text: bytes, chunk: int = 1 << 20) -> np.ndarray:
    """Square roots of the shares of hashed runs of one to three bytes of the whole text: a vector of length one."""
    counts = np.zeros(SIZE, np.int64)
    codes = FOLD[np.frombuffer(text, np.uint8)]
    for at in range(0, len(codes), chunk):
        part = codes[at : at + chunk + 2]
        ones = part[:chunk]
        twos = part[:-1][:chunk] * np.uint32(257) + part[1:][:chunk]
        threes = part[:-2][:chunk] * np.uint32(66049) + part[1:-1][:chunk] * np.uint32(257) + part[2:][:chunk]
        for n, grams in enumerate((ones, twos, threes)):
            mixed = (grams + np.uint32(n << 28)) * np.uint32(2654435761)
            counts += np.bincount(mixed >> np.uint32(19), minlength=SIZE)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 40, seed: int = 7) -> np.ndarray:
    """Weights (bias last) of a linear support vector machine, by dual coordinate descent; ``y`` is 1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    norms = np.einsum("ij,ij->i", x, x)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            new = min(cost, max(0.0, alpha[i] - (y[i] * (x[i] @ w) - 1) / norms[i]))
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w.astype(np.float32)


@dataclass
class LanguageModel:
    """Families with one machine against the rest each, and a machine for every two languages of a family."""

    families: list[tuple[str, ...]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((SIZE + 1, 0), np.float32))

    @property
    def pairs(self) -> list[tuple[int, str, str]]:
        return [(f, a, b) for f, langs in enumerate(self.families) for a, b in combinations(langs, 2)]

    @classmethod
    def fit(cls, x: np.ndarray, langs: list[str]) -> LanguageModel:
        of = {code: name for name, codes in FAMILIES.items() for code in codes}
        grouped: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            grouped.setdefault(of.get(lang, lang), []).append(lang)
        model = cls([tuple(v) for _, v in sorted(grouped.items())])
        own = np.array(langs)
        machines = [svm(x, np.where(np.isin(own, f), 1, -1)) for f in model.families]
        for _, a, b in model.pairs:
            two = np.isin(own, (a, b))
            machines.append(svm(x[two], np.where(own[two] == a, 1, -1)))
        model.weights = np.stack(machines, axis=1) if machines else model.weights
        return model

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        """Language and score per row: the family's chance times that of the closest duel within it."""
        margins = x @ self.weights[:-1] + self.weights[-1]
        chances = 1 / (1 + np.exp(-4 * margins.astype(np.float64)))
        n = len(self.families)
        out = []
        for row in chances:
            if n == 0:
                out.append((UNKNOWN, 0.0))
                continue
            f = int(np.argmax(row[:n]))
            wins = dict.fromkeys(self.families[f], 0.0)
            closest = dict.fromkeys(self.families[f], 1.0)
            for (g, a, b), p in zip(self.pairs, row[n:]):
                if g == f:
                    for lang, q in ((a, p), (b, 1 - p)):
                        wins[lang] += (q > 0.5) + q / 1000
                        closest[lang] = min(closest[lang], q)
            best = max(wins, key=lambda lang: (wins[lang], lang))
            out.append((best, float(row[f] * closest[best])))
        return out


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: CRC32 of the id as text leaves 2 modulo 4; also those without an id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(True))


def train(docs: DataFrame, per_language: int = 300, total: int = 2400) -> LanguageModel:
    """A model of the languages of a sample, bounded by about ``per_language`` and ``total`` whole texts, repeated rows once."""
    usable = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sample = bounded_sample(usable, "lang", per_language, total, "language", F.col("doc_id")).dropDuplicates(["doc_id", "lang", "text"])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            vectors = [features(t).astype(np.float16).tobytes() for t in texts(batch["text"])]
            yield pa.record_batch([batch["lang"], pa.array(vectors, pa.binary())], names=["lang", "x"])

    rows = sorted(map(tuple, sample.select("lang", "text").mapInArrow(task, "lang string, x binary").collect()))
    x = np.array([np.frombuffer(x, np.float16) for _, x in rows], np.float32).reshape(len(rows), SIZE)
    return LanguageModel.fit(x, [lang for lang, _ in rows])


def _predicted(model: LanguageModel, column: pa.Array) -> list[tuple[str, float]]:
    lettered = pc.fill_null(pc.match_substring_regex(column, r"\pL"), False).to_pylist()
    raw, found = texts(column), []
    for at in range(0, len(raw), 256):
        found += model.predict(np.stack([features(t) for t in raw[at : at + 256]]))
    return [x if letter else (UNKNOWN, 0.0) for x, letter in zip(found, lettered)]


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Per row: ``doc_id``, ``lang_pred``, ``score`` (0 to 1), from the whole text alone.

    Texts that are null or have no letter are ``und`` with score 0, as is everything if the model knows no
    language. Repeated rows get equal results; no documents, no rows; other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            langs, scores = zip(*_predicted(model, batch["text"])) if batch.num_rows else ((), ())
            yield pa.record_batch([batch["doc_id"], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float = 0.2) -> DataFrame:
    """The documents with a language whose score is ``least`` or more, with all their columns; nothing is shuffled."""
    model, at = train(docs), docs.columns.index("text")

    def task(batches: Batches) -> Batches:
        for batch in batches:
            keep = [lang != UNKNOWN and score >= least for lang, score in _predicted(model, batch.column(at))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # whatever the columns are called
    return plain.mapInArrow(task, plain.schema).toDF(*docs.columns)
