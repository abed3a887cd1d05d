"""Exact top-k inner products through an impact-ordered index, read score at a time."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from retentia.llm.common import numbered, stored

INDEX_SQL = "block long, dim int, members array<int>, sizes array<int>, highs array<long>, lows array<long>, exact array<long>"
INDEX = pa.schema([
    ("block", pa.int64()), ("dim", pa.int32()), ("members", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())),
    ("highs", pa.list_(pa.int64())), ("lows", pa.list_(pa.int64())), ("exact", pa.list_(pa.int64())),
])
FOUND_SQL = "query_row long, query_id long, row long, vec_id long, score long"
FOUND = pa.schema([(c.split()[0], pa.int64()) for c in FOUND_SQL.split(", ")])
ROWS, IDS = -2, -1  # index entries that hold the row numbers and ids of a block instead of a dimension
LONG = np.iinfo(np.int64)


def whole_vectors(vectors: DataFrame, scale: int, identity: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``row``, ``vec_id`` and ``ints``, floor(scale * x) of every component; rows without a finite vector are left out."""
    numbers = numbered(vectors, identity, vector).toDF("row", "vec_id", "vector")
    infinite = F.lit(math.inf)

    def unusable(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == infinite)

    ints = F.transform("vector", lambda x: F.floor(x.cast("double") * scale))
    return numbers.filter(F.col("vector").isNotNull() & ~F.exists("vector", unusable)).select("row", "vec_id", ints.alias("ints"))


def matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    own = lists.combine_chunks()
    lengths = own.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(own), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = own.flatten().to_numpy(zero_copy_only=False)
    return out


def _postings(width: int):
    """The index of one block: a row per dimension, its postings in segments of descending impact."""

    def build(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        vectors = matrix(block["ints"])
        rows = [(ROWS, [], [], [], [], block["row"].to_pylist()), (IDS, [], [], [], [], block["vec_id"].to_pylist())]
        for dim, values in enumerate(vectors.T):
            impact = values // width
            members = np.lexsort((-impact,))
            members = members[values[members] != 0]  # zeros add nothing and have no posting
            sorted_values, sorted_impact = values[members], impact[members]
            first = np.flatnonzero(np.diff(sorted_impact, prepend=np.nan) != 0)
            sizes = np.diff(np.append(first, len(members)))
            highs = np.maximum.reduceat(sorted_values, first) if len(first) else first
            lows = np.minimum.reduceat(sorted_values, first) if len(first) else first
            rows.append((dim, members, sizes, highs, lows, values))
        whole = [pa.array([key[0].as_py()] * len(rows), pa.int64())]
        return pa.Table.from_arrays([*whole, *[pa.array(c, f.type) for c, f in zip(zip(*rows), list(INDEX)[1:])]], schema=INDEX)

    return build


class Block:
    """Postings of one block: flat members by dimension, cut into segments with their extreme values."""

    few = 1 / 8

    def __init__(self, entries: pa.Table):
        columns = [entries[c].to_pylist() for c in ("members", "sizes", "highs", "lows", "exact")]
        by_dim = {dim: [c[i] for c in columns] for i, dim in enumerate(entries["dim"].to_pylist())}
        self.rows, self.ids = by_dim.pop(ROWS)[-1], by_dim.pop(IDS)[-1]
        dims = [by_dim[i] for i in range(len(by_dim))]

        def flat(i: int) -> np.ndarray:
            return np.concatenate([np.empty(0, np.int64), *[np.array(d[i], np.int64) for d in dims]])

        self.members, self.sizes, self.highs, self.lows = (flat(i) for i in range(4))
        self.dims = np.repeat(np.arange(len(dims)), [len(d[1]) for d in dims])
        self.starts = np.append(0, np.cumsum(self.sizes))
        self.vectors = np.array([d[4] for d in dims], np.int64).T.reshape(len(self.rows), len(dims))
        self.floats = self.vectors.astype(np.float64)
        self.largest = float(np.abs(self.floats).max(initial=0))
        self.order = np.array([(i is None, i or 0) for i in self.ids], dtype=[("none", bool), ("id", np.int64)])

    def exact(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products; in doubles where these are exact, else in Python's integers, cut to the range of long."""
        if self.largest * np.abs(query.astype(np.float64)).sum() < 2**53:
            return (self.floats[at] @ query).astype(np.int64)
        found = [sum(a * b for a, b in zip(v, query.tolist())) for v in self.vectors[at].tolist()]
        return np.array([min(max(x, LONG.min), LONG.max) for x in found], np.int64)

    def top(self, vector: np.ndarray, own_row: int, k: int) -> list[tuple[int, int]]:
        """The ``k`` best (local number, score) but the query's own row.

        An accumulator holds the greatest contributions that the segments read so far allow; what a vector
        can still get is at most the greatest contribution left in each dimension, and nothing where only
        negative ones are left. Segments are read in rounds of descending contribution. After each, the exact
        scores of the best accumulators give a score that k vectors reach; only vectors whose bound reaches
        it can be among the best. Reading stops when these are few (``few`` of the block), at the latest with
        the last segment, and they are scored exactly, so the bound is proof in every case.
        """
        n, query = len(self.rows), np.zeros(self.vectors.shape[1], np.int64)
        shared = min(len(query), len(vector))
        query[:shared] = vector[:shared]
        weight = query.astype(np.float64)[self.dims]
        most = np.where(weight > 0, weight * self.highs, weight * self.lows)
        usual = float(np.abs(most) @ self.sizes) / max(1, int(self.sizes.sum()))
        slack = 1e-12 * self.largest * float(np.abs(weight).max(initial=0)) * (len(query) + 1)  # rounding of huge values
        bound, before = np.zeros(n), math.inf
        open_rows = np.ones(n, bool)
        open_rows[[i for i, r in enumerate(self.rows) if r == own_row]] = False
        for least in (2 * usual, usual / 2, 0.0, -usual / 2, -2 * usual, -math.inf):
            read = np.flatnonzero((most > least) & (most <= before))
            before = least
            if len(read):
                cuts = np.flatnonzero(np.diff(read) != 1) + 1
                runs = [self.members[self.starts[r[0]] : self.starts[r[-1] + 1]] for r in np.split(read, cuts)]
                bound += np.bincount(np.concatenate(runs), np.repeat(most[read], self.sizes[read]), n)
            left = np.zeros(len(query))
            unread = np.flatnonzero((most <= least) & (most > 0))
            np.maximum.at(left, self.dims[unread], most[unread])
            able = np.where(open_rows, bound + left.sum(), -math.inf)
            some = min(4 * k, n)
            probe = np.argpartition(-able, some - 1)[:some] if some else np.empty(0, int)
            probe = probe[open_rows[probe]]
            reached = np.sort(self.exact(probe, query))[::-1]
            if len(reached) < k:
                possible = np.flatnonzero(open_rows)
            else:
                possible = np.flatnonzero(able >= reached[k - 1] - slack)
            if len(possible) <= max(some, self.few * n):
                break
        scores = self.exact(possible, query)
        if len(possible) > k:
            near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            possible, scores = possible[near], scores[near]
        ids = self.order[possible]
        best = np.lexsort((possible, ids["id"], ids["none"], -scores.astype(object) if scores.min(initial=0) == LONG.min else -scores))[:k]
        return [(int(possible[i]), int(scores[i])) for i in best]


def _search(k: int):
    def cell(queries: pa.Table, entries: pa.Table) -> pa.Table:
        found = []
        if queries.num_rows and entries.num_rows:
            block = Block(entries)
            for row, vec_id, vector in zip(*[queries[c].to_pylist() for c in ("row", "vec_id", "ints")]):
                best = block.top(np.array(vector, np.int64), row, k)
                found += [(row, vec_id, block.rows[i], block.ids[i], score) for i, score in best]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 5)], schema=FOUND)

    return cell


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, width: int = 4, block: int = 16384, batch: int = 256,
    identity: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """The ``k`` rows of highest integer inner product with each query row: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Queries are the rows where ``is_query`` (on a column ``vec_id``) holds; candidates are all rows but the query's own, so a repeated
    row finds its copy. Ties go to the smaller id, null ids last, then to the earlier row. Vectors that are
    null or hold a null, NaN or infinite component take no part; missing components of shorter vectors
    count as zero; an empty vector scores zero. floor(scale * x) and scores beyond a long are cut to its
    range. No rows, no result; other columns are ignored.

    The index is a table: vectors fall by hash into blocks of about ``block``; in every block each dimension
    has its postings in segments of ``width`` neighbouring values, by descending impact. Batches of about
    ``batch`` queries meet each block once, in tasks of bounded size; the k best of each block are merged by
    a shuffle on the query.
    """
    rows = stored(whole_vectors(vectors, scale, identity, vector), "vectors")
    n = rows.count()
    queries = rows.filter(is_query)
    blocks, batches = max(1, math.ceil(n / block)), max(1, math.ceil(queries.count() / batch))
    placed = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    index = stored(placed.groupBy("block").applyInArrow(_postings(width), INDEX_SQL), "postings")
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    every_batch = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(batches - 1).cast("long")))
    asked = queries.withColumn("batch", F.pmod(F.xxhash64("row"), F.lit(batches))).withColumn("block", every_block)
    cells = asked.groupBy("batch", "block").cogroup(index.withColumn("batch", every_batch).groupBy("batch", "block"))
    best = W.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = cells.applyInArrow(_search(k), FOUND_SQL).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
