"""Integer vectors of a whole table, and a query set that meets them in bounded passes.

A stated query set grows with its table, so it is never broadcast whole: a pass
takes the queries whose hash falls into one part, about PASS_BYTES of vectors,
and all rows are scanned against them as they lie, without a shuffle of the rows.
A vector component x counts as floor(scale * x). Vectors of unequal length count
as filled up with zeros, so an empty vector has the product 0 with every other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.session import Stored

SCALE = 256
PASS_BYTES = 8 << 20  # query vectors that are broadcast at a time, four bytes a component
QUERIES = 1024  # queries that meet a batch of rows in one matrix product
MISSING = -(2**62)  # below every score


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows with a key and a vector of finite components; no others can be named or scored."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return df.where(F.col(key).isNotNull() & finite)


def matrix(vectors: pa.Array, width: int, scale: int = SCALE) -> np.ndarray:
    """Vectors of a batch as rows of integers, filled up with zeros to ``width``."""
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if width and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


@dataclass
class Extent:
    """Rows, longest vector, largest component, largest norm and the span of the keys of a table."""

    rows: int
    width: int
    largest: int
    product: int  # no inner product of two rows, nor a partial sum of one, is larger
    low: int
    high: int


def extent(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> Extent:
    """One scan, one row per task. Components too large for exact products in 62 bits are an error."""

    def look(batches):
        for batch in batches:
            if batch.num_rows:
                vectors, keys = batch.column("v"), batch.column("k").to_numpy()
                x = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
                sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
                squares = np.bincount(np.repeat(np.arange(len(sizes)), sizes), x * x, len(sizes))
                yield pa.RecordBatch.from_pydict({
                    "n": [len(keys)], "width": [int(sizes.max())], "largest": [float(np.abs(x).max(initial=0.0))],
                    "norm": [float(squares.max())], "low": [int(keys.min())], "high": [int(keys.max())]})

    seen = df.select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v")).mapInArrow(
        look, "n long, width long, largest double, norm double, low long, high long")
    r = seen.agg(F.sum("n"), F.max("width"), F.max("largest"), F.max("norm"), F.min("low"), F.max("high")).first()
    if r[0] is None:
        return Extent(0, 0, 0, 0, 0, 0)
    if r[3] >= 2.0**61:
        raise ValueError("components are too large: inner products would not fit into 62 bits")
    return Extent(r[0], r[1], int(r[2]), int(r[3] * (1 + 1e-9)) + 1, r[4], r[5])


def passes(queries: DataFrame, row_bytes: int) -> Iterator[pa.Table]:
    """Distinct query rows in parts of about PASS_BYTES, whatever their number."""
    asked = Stored(queries.distinct())
    parts = max(1, -(-asked.df.count() * max(row_bytes, 1) // PASS_BYTES))
    for part in range(parts):
        table = asked.df.where(F.pmod(F.xxhash64(*asked.df.columns), F.lit(parts)) == part).toArrow()
        if table.num_rows:
            yield table.combine_chunks()
    asked.drop()


class Own:
    """Where rows of a batch carry a query's own key."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, kind="stable")
        self.sorted = keys[self.order]

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Query and row of each match."""
        first = np.searchsorted(self.sorted, keys, "left")
        n = np.searchsorted(self.sorted, keys, "right") - first
        rows = np.repeat(np.arange(len(keys)), n)
        within = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
        return self.order[np.repeat(first, n) + within], rows


class Best:
    """The ``k`` highest scores of each query that a task has seen, ties to the smaller key."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), MISSING, np.int64)
        self.keys = np.full((queries, k), np.iinfo(np.int64).max, np.int64)

    def offer(self, queries: np.ndarray, scores: np.ndarray, wanted: np.ndarray, keys: np.ndarray) -> None:
        """Scores of rows (columns) for some queries (rows of the matrix), where ``wanted``."""
        k = self.k
        i, j = np.nonzero(wanted & (scores >= self.scores[queries, -1][:, None]))
        if len(i) > 8 * k * len(queries):  # a bar per query first, so that only a few are sorted
            bar = np.partition(np.where(wanted, scores, MISSING), scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            keep = scores[i, j] >= bar[i]
            i, j = i[keep], j[keep]
        if not len(i):
            return
        some, place = np.unique(i, return_inverse=True)
        rows = queries[some]
        at = np.concatenate([place, np.repeat(np.arange(len(some)), k)])
        score = np.concatenate([scores[i, j], self.scores[rows].ravel()])
        key = np.concatenate([keys[j], self.keys[rows].ravel()])
        order = np.lexsort((key, -score, at))
        first = np.searchsorted(at[order], np.arange(len(some)))
        order = order[np.arange(len(order)) - first[at[order]] < k]
        self.scores[rows] = score[order].reshape(-1, k)
        self.keys[rows] = key[order].reshape(-1, k)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, key and score of everything kept."""
        i, j = np.nonzero(self.scores > MISSING)
        return i, self.keys[i, j], self.scores[i, j]
