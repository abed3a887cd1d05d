"""Top-k search, source divergence and importance resampling against brute force, on awkward tables too."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentia import configure
from retentia.llm import divergence, resampling, topk

DOCS = "doc_id long, text string, lang string, source string, `row` string, `rank` int, term string, `a.b` int"
VECTORS = "vec_id long, embedding array<float>, `row` string, block int, score string, `a.b` int"


@pytest.fixture(scope="module")
def session(spark):
    return configure(spark)


def stored(session, rows, schema, folder, parts=3):
    path = str(folder.mktemp("table") / "table.parquet")
    session.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return session.read.parquet(path)


# --- top-k ---


def vectors(rng, n, dims=12):
    centres = rng.normal(size=(5, dims))
    out = [(i, (centres[i % 5] + rng.normal(size=dims) * (0.1 if i % 3 else 2)).tolist()) for i in range(n)]
    out += [(n, out[0][1]), (n + 1, out[0][1]), (0, out[0][1]), (None, out[1][1]), (None, out[1][1])]  # repeated rows, ids, null ids
    out += [(n + 2, None), (50, [1.0, None]), (100, [math.nan] * dims), (n + 5, [math.inf]), (n + 6, [-math.inf] * 2)]
    return out + [(n + 7, []), (150, []), (n + 8, [0.0] * dims), (200, [3.0, -2.0]), (n + 9, [1.0] * 20)]


def whole(x):
    return None if x is None or any(c is None or not math.isfinite(c) for c in x) else [math.floor(256 * float(np.float32(c))) for c in x]


def brute_top(rows, k):
    usable = [(i, v, w) for i, (v, x) in enumerate(rows) if (w := whole(x)) is not None]
    out = []
    for i, vec_id, own in usable:
        if vec_id is not None and vec_id % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(own, w)), v is None, v or 0) for j, v, w in usable if j != i]
            out += [(vec_id, rank, None if none else v, -s) for rank, (s, none, v) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block, width, batch", [(40, 4, 3), (10_000, 16, 256)])
def test_top_k(session, tmp_path_factory, block, width, batch):
    rows = vectors(np.random.default_rng(3), 300)
    table = stored(session, [(*r, "r", 1, "s", 2) for r in rows], VECTORS, tmp_path_factory)
    found = topk.nearest(table, F.col("vec_id") % 50 == 0, k=5, block=block, width=width, batch=batch)
    assert sorted(map(tuple, found.collect()), key=str) == brute_top(rows, 5)


def test_top_k_of_few_and_none(session, tmp_path_factory):
    rows = [(0, [0.5, 0.25]), (7, [-1.0, 1.0])]
    table = stored(session, [(*r, None, None, None, None) for r in rows], VECTORS, tmp_path_factory, 1)
    assert [tuple(r) for r in topk.nearest(table, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 7, -128 * 256 + 64 * 256)]
    nothing = topk.nearest(table.limit(0), F.col("vec_id") % 50 == 0)
    assert nothing.columns == ["query_id", "rank", "vec_id", "score"] and nothing.count() == 0


def test_scores_beyond_a_long_are_cut(session):
    rows = [(0, [1e16, 3.0]), (1, [1e16, 3.0]), (2, [-1e16, 3.0]), (3, [0.0, 1.0])]
    table = session.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(1)
    found = [tuple(r)[2:] for r in topk.nearest(topk.stored(table, "huge"), F.col("vec_id") == 0).orderBy("rank").collect()]
    assert found == [(1, 2**63 - 1), (3, 768 * 256), (2, -(2**63))]


def index_of(values, width=4):
    import pyarrow as pa

    n = len(values)
    table = pa.table({"row": pa.array(range(n), pa.int64()), "vec_id": pa.array(range(n), pa.int64()), "ints": pa.array(values.tolist(), pa.list_(pa.int64()))})
    return topk.Block(topk._postings(width)((pa.scalar(0),), table))


def test_reading_stops_with_proof():
    """Clustered vectors: the same members as brute force, and most vectors are never scored."""
    rng = np.random.default_rng(9)
    values = np.floor(256 * (rng.normal(size=(8, 32))[rng.integers(8, size=2000)] / 6 + rng.normal(size=(2000, 32)) / 25)).astype(np.int64)
    block, scored = index_of(values), []
    exact = block.exact
    block.exact = lambda at, q: scored.append(len(at)) or exact(at, q)
    for i in range(0, 2000, 100):
        found = block.top(values[i], i, 5)
        products = values @ values[i]
        expected = sorted((-int(s), j) for j, s in enumerate(products) if j != i)[:5]
        assert [(-s, j) for j, s in found] == expected
    assert sum(scored) < 0.3 * 20 * 2000


def test_postings_are_in_impact_order():
    block = index_of(np.random.default_rng(1).integers(-40, 40, (500, 6)))
    for dim in range(6):
        own = np.flatnonzero(block.dims == dim)
        assert (np.diff(block.highs[own]) < 0).all() and (block.highs[own] // 4 == block.lows[own] // 4).all()
        members = np.concatenate([block.members[block.starts[s] : block.starts[s + 1]] for s in own])
        assert sorted(members) == np.flatnonzero(block.vectors[:, dim]).tolist()


# --- texts ---


def awkward_docs():
    rng = random.Random(4)
    words = ["the", "The", "haus", "HAUS", "maison", "élan", "ÉLAN", "a1b", "x", "don't", "ß", "naïve", "42", "日本", "日本語"]
    rows = []
    for i in range(90):
        text = " ".join(rng.choice(words) + rng.choice(["", ".", "\n", "  ", "_"]) for _ in range(rng.choice([0, 3, 19, 20, 21, 60])))
        rows.append((i, text, rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", "é", None])))
    rows += [rows[5], rows[5], (None, "the haus the haus " * 9, "en", "s1"), (None, None, None, None), (None, "the haus the haus " * 9, "en", "s1")]
    rows += [(200, "!!! ...", "xx", "alone"), (201, "rare only here", "fr", "s1"), (202, None, "fr", "s2"), (203, "z" * 50_000 + " the " * 5000, "en", "s2")]
    rows += [(204, " ".join(rng.choice(words) + str(j % 700) for j in range(150_000)), "de", "s1")]  # about a MB
    return rows


@pytest.fixture(scope="module")
def docs(session, tmp_path_factory):
    return stored(session, [(*r, "r", 1, "t", 2) for r in awkward_docs()], DOCS, tmp_path_factory)


@pytest.fixture(scope="module")
def nothing(session, tmp_path_factory):
    return stored(session, [], DOCS, tmp_path_factory, 1)


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


# --- divergence ---


def brute_divergence(rows, least, top):
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        group = (lang or "", source or "")
        groups.add(group)
        found = [lowered(w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[group].update(found)
        in_docs[group[0]].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        own = [g for g in groups if g[0] == lang]

        def shares(counted):
            total = sum(counted[t] for t in kept)
            return {t: 1 + 10**9 * (counted[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {g: shares(counts[g]) for g in own}
        q = shares(sum((counts[g] for g in own), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for g in own:
            pairs = [(-sum(f(p[g][t], p[h][t]) for t in kept), h[1].encode()) for h in own if h != g]
            words = [(-f(p[g][t], q[t]), t.encode()) for t in kept if counts[g][t] and p[g][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(words)[:top])):
                out += [(*g, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(items, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"group_block": 1, "term_block": 3, "live": 4, "read": 50}, {"group_block": 2, "term_block": 500}])
def test_divergence(docs, sizes):
    found = divergence.divergence(docs, least=3, top=4, **sizes).collect()
    assert sorted(map(tuple, found)) == brute_divergence(awkward_docs(), 3, 4)


def test_divergence_of_nothing(nothing):
    found = divergence.divergence(nothing)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"] and found.count() == 0


def test_sources_without_terms(session, tmp_path_factory):
    rows = [(1, None, None, None), (2, "..", "", "b"), (3, "word", "", "c")]
    found = divergence.divergence(stored(session, [(*r, "r", 1, "t", 2) for r in rows], DOCS, tmp_path_factory, 1))
    assert sorted(map(tuple, found.collect())) == brute_divergence(rows, 10, 10)


def test_divergence_over_many_term_blocks(session, tmp_path_factory):
    """The sources of one group block meet in every term block, where their rows come in any order."""
    rng = random.Random(5)
    words = ["w" + chr(97 + i % 26) + chr(97 + i // 26) for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=200)), "en", f"s{i % 7}") for i in range(140)]
    table = stored(session, [(*r, "r", 1, "t", 2) for r in rows], DOCS, tmp_path_factory)
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several tasks, as on large tables
    try:
        found = divergence.divergence(table, least=10, top=10, term_block=5).collect()
    finally:
        configure(session)
    assert sorted(map(tuple, found)) == brute_divergence(rows, 10, 10)


# --- resampling ---


def brute_resampling(rows, target, buckets=10_000, seed=7):
    def counted(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
        features = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        return len(words), Counter(zlib.crc32(f.encode()) % buckets for f in features)

    own, goal = [counted(r[1]) for r in rows], sum((counted(t)[1] for t in target), Counter())
    s = sum((c for _, c in own), Counter())
    S, T = s.total(), goal.total()
    gain = [math.floor(1000 * math.log((goal[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for (doc, *_), (n_words, c) in zip(rows, own):
        weight = math.floor(Fraction(sum(gain[b] * n for b, n in c.items()), c.total())) if c else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, c.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    return out, able[: 25 * len(able) // 100]


def test_resampling(session, docs):
    target = ["the haus the haus", None, "", "日本語 élan x 42"]
    table = session.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resampled(docs, table).collect()
    rows, drawn = brute_resampling(awkward_docs(), target)
    assert sorted((r.doc_id or -1, r.n_features, r.weight, r.score) for r in found) == sorted((r[0] or -1, *r[1:4]) for r in rows)
    best = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in best] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in best] == [(r[0], r[3]) for r in drawn]


def test_resampling_of_nothing(session, docs, nothing):
    found = resampling.resampled(nothing, nothing)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"] and found.count() == 0
    rows, drawn = brute_resampling(awkward_docs(), [])
    even = resampling.resampled(docs, nothing).collect()
    assert sorted((r.doc_id or -1, r.weight) for r in even) == sorted((r[0] or -1, r[2]) for r in rows)


def test_planes_weigh_exactly():
    rng = np.random.default_rng(2)
    for buckets in (64, 100, 10_000):
        counts = rng.integers(0, 3000, buckets) * (rng.random(buckets) < 0.3)
        gains = rng.integers(-15_000, 15_000, buckets)
        width = resampling.plane_bytes(buckets)
        total = 0
        for sign, side in ((1, np.maximum(gains, 0)), (-1, np.maximum(-gains, 0))):
            for k, plane in enumerate(resampling.sliced(side, width)):
                for i, own in enumerate(resampling.sliced(counts, width)):
                    total += sign * int(np.bitwise_count(own & plane).sum()) << (i + k)
        assert total == int(counts @ gains)
