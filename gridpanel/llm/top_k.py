"""Exact top-k search by distributed histogram selection.

All rows are scored against a pass of queries by matrix products whose partial
sums are exact in the float type chosen. Tasks count scores in BINS bins of the
interval that holds a query's k-th score; the counts are added up, the bin with
the k-th score becomes the next interval, and so on until few rows lie in it or
it is one score wide. Many ties at that score are cut the same way by their keys.
The last scan takes the rows above the cut, about k per query, and a window ranks
them. No task holds the scores of a query, and nothing is sorted but the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.llm.vector_scan import QUERIES, SCALE, Extent, Own, extent, matrix, passes, usable
from gridpanel.session import Stored

BINS = 128
ENOUGH = 64  # rows in the last interval of a query that may be taken beyond k
_LAST = np.iinfo(np.int64).max


class Search:
    """A pass of queries and, per query, what is known of its k-th row.

    The k-th value lies in [low, top); ``need`` of the values there are wanted.
    Values are scores first; where ``tied`` is set they are the negated keys of
    the rows whose score is ``cut``.
    """

    def __init__(self, table: pa.Table, k: int, span: Extent, scale: int):
        self.kind = np.float32 if span.product < 2**22 else np.float64
        if span.product >= 2**52:
            raise ValueError("components are too large for exact products in doubles")
        self.keys = table.column("k").to_numpy()
        self.x = matrix(pa.concat_arrays(table.column("v").chunks), span.width, scale).astype(self.kind)
        self.width, self.scale, self.k, self.bins, self.block = span.width, scale, k, BINS, QUERIES
        n = len(self.keys)
        self.low = np.full(n, -span.product, np.int64)
        self.step = np.full(n, -(-(2 * span.product + 1) // self.bins), np.int64)
        self.need = np.full(n, k, np.int64)
        self.cut = np.full(n, -span.product, np.int64)  # scores above are taken, scores equal to it up to the key ``last``
        self.last = np.full(n, _LAST, np.int64)
        self.tied = False
        self.own = Own(self.keys)

    def part(self, places: np.ndarray) -> "Search":
        """The same for some of the queries."""
        out = object.__new__(Search)
        out.__dict__.update(self.__dict__)
        for name in ("keys", "x", "low", "step", "need", "cut", "last"):
            setattr(out, name, getattr(self, name)[places])
        out.own = Own(out.keys)
        return out

    def blocks(self, batches):
        """Keys of a batch, first query and scores of a block of queries; a query's own rows are at minus infinity."""
        for batch in batches:
            keys = batch.column("k").to_numpy()
            rows = matrix(batch.column("v"), self.width, self.scale).astype(self.kind)
            mine, at = self.own.places(keys)
            for first in range(0, len(self.keys), self.block):
                scores = self.x[first:first + self.block] @ rows.T
                here = (mine >= first) & (mine < first + self.block)
                scores[mine[here] - first, at[here]] = -np.inf
                yield keys, first, scores

    def count(self, batches):
        """Counts per query and bin, from the top down to the bin where the task alone has ``need`` values."""
        counts = np.zeros((len(self.keys), self.bins), np.int32)
        floor = self.low.copy()
        top = self.low + self.bins * self.step
        for keys, first, scores in self.blocks(batches):
            here = slice(first, first + len(scores))
            if self.tied:
                i, j = np.nonzero(scores == self.cut[here, None])
                value = -keys[j]
                keep = (value >= floor[here][i]) & (value < top[here][i])
                i, value = i[keep], value[keep]
            else:
                i, j = np.nonzero((scores >= floor[here, None].astype(self.kind)) & (scores < top[here, None].astype(self.kind)))
                value = scores[i, j].astype(np.int64)
            if len(i):
                bins = (value - self.low[here][i]) // self.step[here][i]
                counts[here] += np.bincount(i * self.bins + bins, minlength=len(scores) * self.bins).reshape(-1, self.bins).astype(np.int32)
                floor[here] = self.low[here] + np.maximum(self._reached(counts[here], self.need[here]), 0) * self.step[here]
        from_bin = (floor - self.low) // self.step
        i, b = np.nonzero(counts * (np.arange(self.bins) >= from_bin[:, None]))
        if len(i):
            yield pa.RecordBatch.from_pydict({"place": i, "need": self.need[i], "bin": b, "n": counts[i, b].astype(np.int64)})

    @staticmethod
    def _reached(counts: np.ndarray, need: np.ndarray) -> np.ndarray:
        """The highest bin from which upward there are ``need`` values, or -1."""
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
        return (above >= need[:, None]).sum(axis=1) - 1

    def take(self, batches):
        """The rows above the cuts; of rows equal in score and key to a cut no more than ``k`` per task."""
        at_cut = np.zeros(len(self.keys), np.int64)
        for keys, first, scores in self.blocks(batches):
            here = slice(first, first + len(scores))
            i, j = np.nonzero(scores >= self.cut[here, None].astype(self.kind))
            value = scores[i, j].astype(np.int64)
            equal = value == self.cut[here][i]
            same = equal & (keys[j] == self.last[here][i])
            place = first + i
            if same.any():
                hit = np.flatnonzero(same)
                where = place[hit]
                nth = np.arange(len(hit)) - np.searchsorted(where, where) + at_cut[where]
                np.add.at(at_cut, where, 1)
                same[hit[nth >= self.k]] = False
            keep = ~equal | (keys[j] < self.last[here][i]) | same
            if keep.any():
                place, j, value = place[keep], j[keep], value[keep]
                yield pa.RecordBatch.from_pydict({"place": place, "query": self.keys[place], "key": keys[j], "score": value})


def _narrow(search: Search, rows: DataFrame, span: Extent) -> None:
    """Set the cuts of a pass: histogram rounds by score, then by key where many rows tie."""
    context = rows.sparkSession.sparkContext
    tied: list[int] = []
    for by_key in (False, True):
        open_ = np.array(tied, int) if by_key else np.arange(len(search.keys))
        if by_key and len(open_):
            search.tied = True
            search.low[open_] = -span.high
            search.step[open_] = -(-(span.high - span.low + 1) // BINS)
        while len(open_):
            shared = context.broadcast(search.part(open_))
            counted = rows.mapInArrow(lambda batches, shared=shared: shared.value.count(batches), "place long, need long, bin long, n long")
            total = F.sum("n").over(Window.partitionBy("place").orderBy(F.desc("bin")))
            found = counted.groupBy("place", "need", "bin").agg(F.sum("n").alias("n")).withColumn("total", total)
            found = found.where("total >= need and total - n < need").collect()  # a row per query of the pass
            shared.destroy()
            again = []
            for r in found:
                place, step = open_[r["place"]], search.step[open_[r["place"]]]
                low = search.low[place] + r["bin"] * step
                search.low[place], search.need[place] = low, r["need"] - (r["total"] - r["n"])
                if by_key:
                    search.last[place] = -low
                else:
                    search.cut[place] = low
                if r["n"] <= max(ENOUGH, search.k):
                    continue
                if step > 1:
                    search.step[place] = -(-step // BINS)
                    again.append(place)
                elif not by_key:
                    tied.append(place)
            open_ = np.array(sorted(again), int)


def top_k(df: DataFrame, queries, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The ``k`` rows with the highest inner product for every row where ``queries`` holds: (query_id, rank, <key>, score).

    Scores are of floor(scale * x), ties go to the smaller key, and rows with the
    query's own key do not count. Rows without a key and vectors that are null or
    hold null or non-finite components take no part. A row that is repeated counts
    each time as a candidate and once as a query; a key with several vectors is a
    query with each. With fewer than ``k`` other rows all are returned; an empty
    table or one without queries gives no rows. Other columns are ignored.
    """
    rows = usable(df, key, vector).select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v"))
    span = extent(rows, "k", "v", scale)
    asked = usable(df.where(queries), key, vector).select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v"))
    parts = []
    for table in passes(asked, 4 * span.width):
        search = Search(table, k, span, scale)
        _narrow(search, rows, span)
        shared = rows.sparkSession.sparkContext.broadcast(search)
        taken = rows.mapInArrow(lambda batches, shared=shared: shared.value.take(batches), "place long, query long, key long, score long")
        rank = F.row_number().over(Window.partitionBy("place").orderBy(F.desc("score"), "key"))
        best = taken.withColumn("rank", rank).where(F.col("rank") <= k)
        parts.append(Stored(best.select(F.col("query").alias("query_id"), "rank", F.col("key").alias(key), "score")))
    if not parts:
        return rows.sparkSession.createDataFrame([], f"query_id long, rank int, {key} long, score long")
    return rows.sparkSession.read.schema(parts[0].df.schema).parquet(*[p.folder for p in parts])
