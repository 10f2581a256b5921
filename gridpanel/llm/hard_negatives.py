"""Hard-negative mining with exact scores from a residue number system.

Integer vectors are split into balanced residues modulo a few small primes. A
matrix product per prime runs in float32 and is exact, since the primes are
chosen so that no partial sum reaches 2^24; balanced mixed-radix digits put the
residues together to the signed score (Chinese remaindering). Rows are scanned as
they lie, twice per pass of anchors: once for positives, once for the rows of
other labels within the window below each positive. Tasks keep a few rows per
anchor and positive, and a window ranks what the tasks found.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.llm.vector_scan import QUERIES, SCALE, Best, Own, extent, matrix, passes, usable
from gridpanel.session import Stored

EXACT = 2**24 - 2**13  # integers up to here, and a prime more, are exact in float32
LARGEST_PRIME = 2039  # products of two residues stay exact, too
COLUMNS = 1024  # components of one product; longer vectors are reduced in between


def _is_prime(n: int) -> bool:
    return n > 2 and n % 2 == 1 and all(n % d for d in range(3, isqrt(n) + 1, 2))


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo an odd p between -(p - 1) / 2 and (p - 1) / 2, for integers in float32.

    The quotient of a large x may round to a neighbour; the second step mends it.
    """
    x = x - np.float32(p) * np.rint(x * np.float32(1 / p))
    return x - np.float32(p) * np.rint(x * np.float32(1 / p))


class Residues:
    """Primes whose product tells all scores up to ``bound`` apart, for vectors of ``width`` components."""

    def __init__(self, width: int, bound: int):
        self.columns = min(max(width, 1), COLUMNS)
        prime = min(2 * isqrt(EXACT // self.columns) + 1, LARGEST_PRIME)
        self.primes: list[int] = []
        product = 1
        while product <= 2 * bound + 1:
            while not _is_prime(prime):
                prime -= 1
            self.primes.append(prime)
            product *= prime
            prime -= 1

    def split(self, x: np.ndarray) -> list[np.ndarray]:
        """A matrix of residues per prime."""
        out = []
        for p in self.primes:
            r = np.mod(x, p)
            out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
        return out

    def products(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """Inner products of the rows of two split matrices."""
        found = []
        for p, x, y in zip(self.primes, a, b, strict=True):
            r = np.zeros((len(x), len(y)), np.float32)
            for at in range(0, x.shape[1], self.columns):
                r = balanced(r + x[:, at:at + self.columns] @ y[:, at:at + self.columns].T, p)
            found.append(r)
        return self.join(found)

    def join(self, residues: list[np.ndarray]) -> np.ndarray:
        """The signed integer with these residues, by mixed-radix digits."""
        digits: list[np.ndarray] = []
        total, radix = np.zeros(residues[0].shape, np.int64), 1
        for n, (p, r) in enumerate(zip(self.primes, residues, strict=True)):
            if n:
                known = digits[-1]
                for m in range(n - 2, -1, -1):
                    known = balanced(known * np.float32(self.primes[m] % p) + digits[m], p)
                inverse = pow(radix, -1, p)
                r = balanced(balanced(r - known, p) * np.float32(inverse if inverse <= p // 2 else inverse - p), p)
            digits.append(r)
            # in 64 bits with wrap-around: the sum fits although a radix may not
            total += r.astype(np.int64) * np.int64((radix + 2**63) % 2**64 - 2**63)
            radix *= p
        return total


class Anchors:
    """A pass of anchors: keys, places of their labels in the list of labels, residues, and their positives when known."""

    def __init__(self, table: pa.Table, residues: Residues, width: int, scale: int):
        vectors = pa.concat_arrays(table.column("v").chunks)
        self.keys = table.column("k").to_numpy()
        labels = pa.concat_arrays(table.column("l").chunks)
        self.labels = labels.unique()
        self.code = pc.index_in(labels, value_set=self.labels).to_numpy(zero_copy_only=False)
        self.residues, self.width, self.scale = residues, width, scale
        self.split = residues.split(matrix(vectors, width, scale))
        self.own = Own(self.keys)
        self.block = QUERIES
        self.positive: np.ndarray | None = None

    def _rows(self, batches):
        """Keys, label codes (-1: no anchor has it), residues, and own places of each batch."""
        for batch in batches:
            keys = batch.column("k").to_numpy()
            codes = pc.index_in(batch.column("l"), value_set=self.labels).fill_null(-1).to_numpy(zero_copy_only=False)
            yield keys, codes, self.residues.split(matrix(batch.column("v"), self.width, self.scale)), self.own.places(keys)

    def positives(self, k: int):
        """A task's best ``k`` other rows of each anchor's label."""

        def run(batches):
            best = Best(len(self.keys), k)
            for keys, codes, rows, (mine, at) in self._rows(batches):
                own = np.zeros(len(self.keys), bool)
                own[mine] = True
                for code in np.unique(codes[codes >= 0]):
                    there = np.flatnonzero(codes == code)
                    anchors = np.flatnonzero(self.code == code)
                    for first in range(0, len(anchors), self.block):
                        block = anchors[first:first + self.block]
                        scores = self.residues.products([a[block] for a in self.split], [r[there] for r in rows])
                        wanted = np.ones(scores.shape, bool)
                        if own[block].any():
                            wanted = self.keys[block][:, None] != keys[there][None, :]
                        best.offer(block, scores, wanted, keys[there])
            place, key, score = best.found()
            if len(place):
                yield pa.RecordBatch.from_pydict({"place": place, "key": key, "score": score})

        return run

    def negatives(self, k: int, low: int, high: int, per: int):
        """A task's best ``k`` rows of another label in the window of each anchor and positive."""
        slots = self.positive.shape[1]
        least = np.array([[-(-low * int(p) // per) for p in row] for row in self.positive], np.int64)
        most = np.array([[high * int(p) // per for p in row] for row in self.positive], np.int64)

        def run(batches):
            best = Best(len(self.keys) * slots, k)
            for keys, codes, rows, _ in self._rows(batches):
                for first in range(0, len(self.keys), self.block):
                    block = np.arange(first, min(first + self.block, len(self.keys)))
                    scores = self.residues.products([a[block] for a in self.split], rows)
                    other = self.code[block][:, None] != codes[None, :]
                    for slot in range(slots):
                        has = self.known[block, slot]
                        wanted = other & (scores >= least[block, slot][:, None]) & (scores <= most[block, slot][:, None]) & has[:, None]
                        best.offer(block * slots + slot, scores, wanted, keys)
            place, key, score = best.found()
            if len(place):
                anchor, slot = place // slots, place % slots
                yield pa.RecordBatch.from_pydict({
                    "place": place, "anchor_id": self.keys[anchor], "positive_id": self.positive_keys[anchor, slot],
                    "positive_score": self.positive[anchor, slot], "negative_id": key, "negative_score": score})

        return run


def hard_negatives(df: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, per: int = 100,
                   key: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Negatives that score nearly as high as the positives of each row where ``anchors`` holds.

    An anchor's positives are the ``positives`` other rows of its label with the
    highest scores; a negative is a row of another label with low * positive <=
    per * score <= high * positive, and the ``negatives`` highest are returned:
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    Scores are inner products of floor(scale * x); ties go to the smaller key.

    Rows without key or label and vectors that are null or hold null or
    non-finite components take no part. A row that is repeated counts each time as
    a positive or negative and once as an anchor; rows with the anchor's key are no
    positives of it. Anchors without a positive or a row in the window, and empty
    tables, give no rows. Other columns are ignored.
    """
    spark = df.sparkSession
    named = [F.col(key).cast("long").alias("k"), F.col(label).alias("l"), F.col(vector).alias("v")]
    known = usable(df, key, vector).where(F.col(label).isNotNull())
    rows = known.select(*named)
    span = extent(rows, "k", "v", scale)
    residues = Residues(span.width, span.product)
    parts = []
    for table in passes(known.where(anchors).select(*named), 4 * span.width * len(residues.primes)):
        batch = Anchors(table, residues, span.width, scale)
        shared = spark.sparkContext.broadcast(batch)
        near = rows.mapInArrow(lambda batches, shared=shared: shared.value.positives(positives)(batches), "place long, key long, score long")
        rank = F.row_number().over(Window.partitionBy("place").orderBy(F.desc("score"), "key"))
        found = near.withColumn("rank", rank).where(F.col("rank") <= positives).collect()  # a few rows per anchor of the pass
        shared.destroy()
        batch.positive = np.zeros((len(batch.keys), positives), np.int64)
        batch.positive_keys = np.zeros_like(batch.positive)
        batch.known = np.zeros(batch.positive.shape, bool)
        for r in found:
            at = (r["place"], r["rank"] - 1)
            batch.positive[at], batch.positive_keys[at], batch.known[at] = r["score"], r["key"], True
        shared = spark.sparkContext.broadcast(batch)
        hard = rows.mapInArrow(
            lambda batches, shared=shared: shared.value.negatives(negatives, low, high, per)(batches),
            "place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
        rank = F.row_number().over(Window.partitionBy("place").orderBy(F.desc("negative_score"), "negative_id"))
        hard = hard.withColumn("rank", rank).where(F.col("rank") <= negatives)
        parts.append(Stored(hard.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")))
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return spark.read.schema(parts[0].df.schema).parquet(*[p.folder for p in parts])
