"""Models against the exact optimum on small inputs, and operators on texts of over a megabyte."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from retentia import configure
from retentia.llm import exact_dedup, language, packing, rules, simhash, substrings, tokens
from retentia.llm.queries import tokenizer

# --- language: the machines ---


def dual_optimum(x, y, cost):
    """The dual of the same machine by projected gradient steps over all points at once."""
    x = np.hstack([x, np.ones((len(x), 1))]) * y[:, None]
    q = x @ x.T
    step, alpha = 1 / np.linalg.eigvalsh(q)[-1], np.zeros(len(y))
    for _ in range(60_000):
        alpha = np.clip(alpha + step * (1 - q @ alpha), 0, cost)
    return alpha.sum() - 0.5 * alpha @ q @ alpha


@pytest.mark.parametrize("apart, gap", [(0.2, 1e-3), (1.5, 0.04)])
def test_machines_come_near_the_optimum(apart, gap):
    """Rounds end when no multiplier moves by 0.001, which leaves about 3 % where few small ones decide."""
    rng = np.random.default_rng(3)
    y = np.where(np.arange(40) % 2, 1.0, -1.0)
    x = rng.normal(size=(40, 4)) + apart * y[:, None]
    w = language.svm(x, y, cost=2.0, rounds=2000).astype(np.float64)
    primal = 0.5 * w @ w + 2.0 * np.maximum(0, 1 - y * (x @ w[:-1] + w[-1])).sum()
    assert primal == pytest.approx(dual_optimum(x, y, 2.0), rel=gap)


# --- quality rules: the estimate ---


def least_determinant(x, size):
    """Mean of the subset of least covariance determinant, over all subsets."""
    floor = np.diag(np.square(list(rules.SPREADS.values())))

    def logdet(rows):
        return np.linalg.slogdet(np.cov(x[list(rows)].T, bias=True) + floor)[1]

    best = min(combinations(range(len(x)), size), key=logdet)
    return set(best), x[list(best)].mean(axis=0)


@pytest.mark.parametrize("seed", range(3))
def test_estimate_is_that_of_the_best_subset(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(size=(12, rules.P)), rng.normal(size=(4, rules.P)) * 0.5 + 12])
    names = list(rules.SPREADS)
    rows = configure(spark).createDataFrame([("g", *map(float, r)) for r in x], "group string, " + ", ".join(f"{n} double" for n in names))
    subset, mean = least_determinant(x, 12)
    found = rules.estimates(rows).first()
    assert subset == set(range(12))
    assert np.allclose(found.m, mean)


# --- long texts ---


def long_texts():
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzé", k=rng.randrange(2, 9)))
    prose = " ".join(word() for _ in range(190_000))
    run = base64.b64encode(random.Random(2).randbytes(800_000)).decode()
    return [prose, prose + " ", run, prose[:600_000] + " other " + prose[600_000:], "short text of a few words"]


@pytest.fixture(scope="module")
def raw():
    found = long_texts()
    assert all(len(t.encode()) > 1 << 20 for t in found[:4])
    return found


@pytest.fixture(scope="module")
def docs(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("long") / "documents.parquet")
    configure(spark).createDataFrame([(i, t, "en", "s") for i, t in enumerate(raw)], "doc_id long, text string, lang string, source string").repartition(2).write.parquet(path)
    return spark.read.parquet(path)


def test_long_texts_exact(docs, raw):
    found = {r.doc_id: r for r in exact_dedup.exact_duplicates(docs).collect()}
    assert [(found[i].keep_id, found[i].group_size) for i in range(5)] == [(1, 2), (1, 2), (2, 1), (3, 1), (4, 1)]
    assert found[3].text_sha256 == hashlib.sha256(raw[3].replace(" ", "").encode()).hexdigest()


def fingerprint(text):
    words = text.split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), seed=42) for i in range(max(1, len(words) - 3))]
    bits = Counter(b for h in hashes for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in bits.items() if 2 * n > len(hashes))


def test_long_texts_near(docs, raw):
    lower = [t.translate({c: c + 32 for c in range(65, 91)}) for t in raw]
    found = {r.doc_id: r for r in simhash.simhash_groups(docs).collect()}
    assert [found[i].fp % 2**64 for i in range(5)] == [fingerprint(t) for t in lower]
    assert found[0].component_id == found[1].component_id == 0


def test_long_texts_counted(docs, raw):
    found = {r.doc_id: r for r in rules.statistics(docs).collect()}
    assert [(found[i].n_words, found[i].word_chars) for i in range(5)] == [(len(t.split()), sum(map(len, t.split()))) for t in raw]


def test_long_texts_without_repeats(docs, raw):
    data, length = [t.encode() for t in raw], 200
    places = Counter(hash(t[i : i + length]) for t in data for i in range(len(t) - length + 1))
    for r in substrings.without_repeats(docs).collect():
        t = data[r.doc_id]
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - length + 1):
            if places[hash(t[i : i + length])] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        kept = np.frombuffer(t, np.uint8)[np.cumsum(gone[:-1]) == 0].tobytes()
        assert (r.n_bytes, r.n_removed, bytes(r.kept) == kept) == (len(t), len(t) - len(kept), True), r.doc_id


def test_long_texts_packed(docs, raw):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer())
    found = packing.pack(docs, tokenizer()).collect()
    for i, t in enumerate(raw):
        ids, at = [*plain.encode(t, add_special_tokens=False).ids, 0], 0
        for r in sorted((r for r in found if r.doc_id == i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_long_texts_have_a_language_and_tokens(docs, raw):
    import public_tokenizers

    x = np.stack([language.features(t) for t in (b"the cat sat on the mat and ran", b"der hund und die katze liefen weg")])
    model = language.LanguageModel.fit(x, ["en", "de"])
    found = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert all(found[i].lang_pred in ("en", "de") and 0 < found[i].score <= 1 for i in range(5))
    assert found[0].score == pytest.approx(found[1].score, abs=1e-3)
    counted = {r.doc_id: r for r in tokens.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    columns = [c for c in counted[0].asDict() if c != "doc_id"]
    assert [counted[0][c] for c in columns if c.startswith("n_")] and all(counted[2][c] is not None for c in columns)
