"""Every query against every row, in Arrow-batched workers: products of matrices find the candidates, and candidates alone get
the score, summed in the order of functions.vector.cosine_similarity, so scores and ties are the same to the last bit.

A task goes through its rows in slices, through the queries in tiles, and holds the k best of each query, so that its memory
follows the queries of a block (bounded by the caller), not the rows. Scores fall; NaN comes first, null last, as Spark sorts them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Rows of a slice, queries of a tile: their products take 16 MB. Candidates that wait for a merge.
SLICE, TILE, WAITING = 2048, 1024, 1 << 20
#: More than the product of two unit vectors can be off by rounding.
SLACK = 1e-9
#: Squares of lengths outside of this are left to the exact sum.
_SQUARES = (1e-200, 1e200)


class Vectors:
    """Vectors of one length, a column each, and what their scores need: norms, and which are zero or not plain numbers."""

    def __init__(self, columns: np.ndarray):
        self.columns, self.n = columns, columns.shape[1]
        square = np.zeros(self.n)
        with np.errstate(all="ignore"):
            for x in columns:
                square = square + x * x
            self.norms = np.sqrt(square)
            self.zero = square == 0
            self.odd = ~self.zero & ~((square > _SQUARES[0]) & (square < _SQUARES[1]))
            self.units = np.where(self.zero | self.odd, 0.0, columns / self.norms)

    @classmethod
    def by_length(cls, lists: pa.Array) -> Iterator[tuple[int, np.ndarray, Vectors]]:
        """(length, places in lists, vectors) for those that are neither null nor empty nor hold a null."""
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        flat = pc.list_flatten(lists)
        holed = np.add.accumulate(np.concatenate([[0], np.asarray(flat.is_null())]).astype(np.int64))
        ends = np.cumsum(sizes, dtype=np.int64)
        whole = holed[ends] == holed[ends - sizes]
        values = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False)
        for width in np.unique(sizes[sizes > 0]):
            at = np.flatnonzero((sizes == width) & whole)
            if len(at):
                yield int(width), at, cls(np.ascontiguousarray(values[(ends[at] - width)[:, None] + np.arange(width)].T))

    def tile(self, a: int, b: int) -> Vectors:
        out = object.__new__(Vectors)
        out.columns, out.units, out.n = self.columns[:, a:b], self.units[:, a:b], min(b, self.n) - a
        out.norms, out.zero, out.odd = self.norms[a:b], self.zero[a:b], self.odd[a:b]
        return out


def exact(queries: Vectors, q: np.ndarray, rows: Vectors, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of pairs (0 where null), and which are null. q and r broadcast against each other."""
    with np.errstate(all="ignore"):
        total = np.zeros(np.broadcast(q, r).shape)
        for x, y in zip(queries.columns, rows.columns, strict=True):
            total += x[q] * y[r]
        both = queries.norms[q] * rows.norms[r]
        null = both == 0
        return np.where(null, 0.0, total / both), null


def rough(queries: Vectors, rows: Vectors) -> np.ndarray:
    """Scores within SLACK, NaN as infinity, null as its negative."""
    out = queries.units.T @ rows.units
    out[queries.zero], out[:, rows.zero] = -np.inf, -np.inf
    every = np.arange(queries.n)[:, None], np.arange(rows.n)
    for q, r in ((np.flatnonzero(queries.odd)[:, None], every[1]), (every[0], np.flatnonzero(rows.odd))):
        if q.size and r.size:
            score, null = exact(queries, q, rows, r)
            out[q, r] = np.where(null, -np.inf, np.where(np.isnan(score), np.inf, score))
    return out


class Best:
    """The k best rows of each of n queries so far; bound: the score that a row must reach, -inf while fewer than k have one."""

    def __init__(self, n: int, k: int):
        self.n, self.k, self.bound, self.kept, self.waiting, self.n_waiting = n, k, np.full(n, -np.inf), None, [], 0

    def add(self, q: np.ndarray, score: np.ndarray, null: np.ndarray, ids: pa.Array) -> None:
        kind = np.where(null, 2, np.where(np.isnan(score), 0, 1)).astype(np.int8)
        self.waiting.append(pa.table({"q": q.astype(np.int32), "kind": kind, "falling": np.where(kind == 1, -score, 0.0), "id": ids}))
        self.n_waiting += len(q)
        if self.n_waiting >= min(WAITING, self.n * self.k):
            self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        every = pa.concat_tables([*([self.kept] if self.kept is not None else []), *self.waiting]).combine_chunks()
        self.waiting, self.n_waiting = [], 0
        every = every.take(pc.sort_indices(every, sort_keys=[(c, "ascending") for c in every.column_names], null_placement="at_start"))
        q = every["q"].to_numpy()
        place = np.arange(len(q)) - np.searchsorted(q, q)
        self.kept = every.filter(pa.array(place < self.k)).combine_chunks()
        last = np.flatnonzero(place == self.k - 1)
        kind = every["kind"].to_numpy()[last]
        self.bound[q[last]] = np.where(kind == 1, -every["falling"].to_numpy()[last], np.where(kind == 0, np.inf, -np.inf))


def candidates(scores: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that can be among the k best, of rows that stand in the order of their ids: bound is what a row must reach."""
    least, start = bound.copy(), np.flatnonzero(np.isneginf(bound))
    if len(start) and scores.shape[1] > k:
        least[start] = np.partition(scores[start], -k, axis=1)[:, -k]
    least -= SLACK
    found = scores >= least[:, None]
    few = np.flatnonzero(np.isneginf(least))  # of rows without a score the first k
    if len(few):
        null = np.isneginf(scores[few])
        found[few] = ~null | (np.cumsum(null, axis=1) <= k)
    return np.nonzero(found)


def nearest(rows: DataFrame, queries: DataFrame, k: int, id_col: str, vector_col: str) -> DataFrame:
    """query_id, id, score: of each task's rows with a vector the k nearest to each query. The queries come to the driver and
    go to each worker. Rows without a vector go here: a filter below would have vectors made in Python made twice."""
    asked = queries.select("query_id", F.col("query_vector").cast("array<double>").alias("query_vector"))
    table = asked.toArrow()
    names, vectors = table["query_id"].combine_chunks(), table["query_vector"].combine_chunks()
    schema = StructType([queries.schema["query_id"], StructField(id_col, rows.schema[id_col].dataType), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = {width: (at, found) for width, at, found in Vectors.by_length(vectors)}
        best = Best(len(names), k)
        for batch in batches:
            for start in range(0, len(batch), SLICE):
                part = batch.slice(start, SLICE)
                part = part.filter(part.column(1).is_valid())
                part = part.take(pc.sort_indices(part.column(0), null_placement="at_start"))
                search(part.column(0), {width: (at, found) for width, at, found in Vectors.by_length(part.column(1))}, groups, best)
        best.merge()
        kept = best.kept
        for start in range(0, len(kept) if kept is not None else 0, 10_000):
            one = kept.slice(start, 10_000).combine_chunks().to_batches()[0]
            score = np.where(one["kind"].to_numpy() == 0, np.nan, -one["falling"].to_numpy())
            score = pa.array(score, mask=one["kind"].to_numpy() == 2)
            yield pa.RecordBatch.from_arrays([names.take(one["q"]), one["id"], score], names=["query_id", id_col, "score"])

    def search(ids: pa.Array, rows_by: dict, groups: dict, best: Best) -> None:
        searched = np.zeros(best.n, bool)
        for width, (at, asked) in groups.items():
            searched[at] = True
            placed, here = rows_by.get(width, (np.zeros(0, np.int64), None))
            for a in range(0, asked.n, TILE):
                tile, of = asked.tile(a, a + TILE), at[a : a + TILE]
                scores = np.full((tile.n, len(ids)), -np.inf)
                if here is not None:
                    scores[:, placed] = rough(tile, here)
                q, r = candidates(scores, best.bound[of], best.k)
                null = np.isneginf(scores[q, r])
                score, k_null = np.zeros(len(q)), null.copy()
                if here is not None:
                    where = np.zeros(len(ids), np.int64)
                    where[placed] = np.arange(len(placed))
                    score[~null], k_null[~null] = exact(tile, q[~null], here, where[r[~null]])
                best.add(of[q], score, k_null, ids.take(pa.array(r)))
        for q in np.flatnonzero(~searched):  # no row has a score
            n = min(best.k, len(ids))
            best.add(np.full(n, q), np.zeros(n), np.ones(n, bool), ids.slice(0, n))

    return rows.select(id_col, F.col(vector_col).cast("array<double>").alias(vector_col)).mapInArrow(run, schema)
