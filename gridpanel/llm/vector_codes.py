"""Vector code compression: product quantisation whose Lloyd rounds walk cover trees.

Integer vectors are cut into equal parts. Each task builds, per chunk of its rows
and part, a cover tree: nested levels whose radii at least halve, every node
with its covering radius, count and sum. The trees are written once and read by
all rounds. A round goes down the trees level by level with the codebook entries
that may still be nearest: when the triangle inequality leaves one, the whole
subtree is assigned through its sum; only leaves that stay ambiguous compare
their points, in exact integers. Tasks return sums per entry, so a codebook is
all that passes through the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpanel.llm.vector_scan import SCALE, extent, matrix
from gridpanel.session import Stored

CHUNK = 4096  # rows of one set of trees
LEAF = 8  # points that no node is split below
NODES = 2048  # nodes that meet the codebook at once
_TREE = ("points", "owner", "start", "end", "child", "children", "part", "radius", "sums")


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    gap = (points - centers).astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def _first_of(groups: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))


class Forest:
    """Cover trees of the parts of some vectors, one per part, as arrays over nodes in breadth-first order.

    The points of a node are ``points[start:end]`` and the first of them is its
    center; its children lie in ``child`` to ``child + children`` and share its
    points, the first child with the same center. ``owner`` is a point's row.
    """

    def __init__(self, x: np.ndarray, parts: int, leaf: int = LEAF):
        rows, width = len(x), x.shape[1] // parts
        self.points = np.ascontiguousarray(x.reshape(rows, parts, width).swapaxes(0, 1)).reshape(rows * parts, width)
        self.owner = np.tile(np.arange(rows), parts)
        levels = []
        start, end, part = np.arange(parts) * rows, (np.arange(parts) + 1) * rows, np.arange(parts)
        made = 0
        while len(start):
            radius, sums = self._cover(start, end)
            split = (end - start > leaf) & (radius > 0)
            children = np.zeros(len(start), np.int64)
            level = {"start": start, "end": end, "part": part, "radius": radius, "sums": sums, "children": children}
            made += len(start)
            levels.append(level)
            nodes = np.flatnonzero(split)
            if not len(nodes):
                level["child"] = np.zeros(len(start), np.int64)
                break
            bounds = self._divide(start[nodes], end[nodes], radius[nodes] / 2)
            children[nodes] = [len(b) - 1 for b in bounds]
            level["child"] = made + np.cumsum(children) - children
            part = np.repeat(part, children)
            start, end = np.concatenate([b[:-1] for b in bounds]), np.concatenate([b[1:] for b in bounds])
        for name in _TREE[2:]:
            setattr(self, name, np.concatenate([level[name] for level in levels]))

    def _cover(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Covering radius and sum of each node's points."""
        sizes = end - start
        at = np.repeat(start - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        first = np.cumsum(sizes) - sizes
        points = self.points[at]
        return np.maximum.reduceat(_distances(points, np.repeat(self.points[start], sizes, axis=0)), first), np.add.reduceat(points, first, axis=0)

    def _divide(self, start: np.ndarray, end: np.ndarray, radius: np.ndarray) -> list[np.ndarray]:
        """Sort the points of nodes by child: the first point left takes all within the radius, in all nodes at once."""
        sizes = end - start
        node = np.repeat(np.arange(len(start)), sizes)
        at = np.repeat(start - np.cumsum(sizes) + sizes, sizes) + np.arange(len(node))
        child = np.zeros(len(at), np.int64)
        left, turn = np.arange(len(at)), 0
        while len(left):
            first = _first_of(node[left])
            center = np.repeat(left[first], np.diff(np.append(first, len(left))))
            near = _distances(self.points[at[left]], self.points[at[center]]) <= radius[node[left]]
            child[left[near]] = turn
            left, turn = left[~near], turn + 1
        key = node * turn + child
        order = np.argsort(key, kind="stable")
        self.points[at], self.owner[at] = self.points[at[order]], self.owner[at[order]]
        first = _first_of(key[order])
        of = node[order][first]
        cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
        return [np.append(f, e) for f, e in zip(np.split(at[first], cuts), end, strict=True)]

    @classmethod
    def read(cls, row: dict, width: int) -> Forest:
        """A stored forest."""
        out = object.__new__(cls)
        for name in _TREE:
            values = np.frombuffer(row[name], np.float64 if name == "radius" else np.int32 if name in ("points", "owner") else np.int64)
            setattr(out, name, values.reshape(-1, width) if name in ("points", "sums") else values)
        return out

    def bytes(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(getattr(self, name), np.float64 if name == "radius" else np.int32 if name in ("points", "owner") else np.int64).tobytes()
                for name in _TREE}

    def walk(self, books: np.ndarray, most: int = NODES):
        """Yield ("node", nodes, entries) for subtrees that go to one entry whole, and ("point", points, entries, parts) for single points."""
        roots = np.arange(books.shape[0])
        stack = [(roots, np.ones((len(roots), books.shape[1]), bool))]
        flat = books.astype(np.float64)
        while stack:
            nodes, alive = stack.pop()
            if len(nodes) > most:
                stack.append((nodes[most:], alive[most:]))
                nodes, alive = nodes[:most], alive[:most]
            center = self.points[self.start[nodes]].astype(np.float64)
            gap = flat[self.part[nodes]] - center[:, None, :]
            d = np.where(alive, np.sqrt(np.einsum("nec,nec->ne", gap, gap)), np.inf)
            best = d.min(axis=1)
            alive = d <= (best + 2 * self.radius[nodes] + 1e-9 * (1 + best))[:, None]
            one = alive.sum(axis=1) == 1
            if one.any():
                yield "node", nodes[one], d[one].argmin(axis=1)
            rest, alive = nodes[~one], alive[~one]
            leaf = self.children[rest] == 0
            if leaf.any():
                sizes = self.end[rest[leaf]] - self.start[rest[leaf]]
                at = np.repeat(self.start[rest[leaf]] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                of = np.repeat(np.arange(len(sizes)), sizes)
                part = self.part[rest[leaf]][of]
                i, e = np.nonzero(alive[leaf][of])  # exact integers, entries in order
                exact = self.points[at[i]].astype(np.int64) - books[part[i], e]
                exact = np.einsum("ij,ij->i", exact, exact)
                first = _first_of(i)
                low = np.minimum.reduceat(exact, first)
                entry = np.minimum.reduceat(np.where(exact == np.repeat(low, np.diff(np.append(first, len(i)))), e, books.shape[1]), first)
                yield "point", at, entry, part
            n = self.children[rest[~leaf]]
            if len(n):
                stack.append((np.repeat(self.child[rest[~leaf]] - np.cumsum(n) + n, n) + np.arange(n.sum()), np.repeat(alive[~leaf], n, axis=0)))

    def add(self, books: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> None:
        """Add each entry's number of parts and their sum."""
        for kind, at, entry, *more in self.walk(books):
            if kind == "node":
                place = (self.part[at], entry)
                np.add.at(counts, place, self.end[at] - self.start[at])
                np.add.at(sums, place, self.sums[at])
            else:
                place = (more[0], entry)
                np.add.at(counts, place, 1)
                np.add.at(sums, place, self.points[at].astype(np.int64))

    def encode(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry per row and part, and the row's squared distance."""
        parts, rows = books.shape[0], len(self.owner) // books.shape[0]
        codes = np.zeros(len(self.owner), np.int64)
        for kind, at, entry, *_ in self.walk(books):
            if kind == "node":
                sizes = self.end[at] - self.start[at]
                places = np.repeat(self.start[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                codes[places] = np.repeat(entry, sizes)
            else:
                codes[at] = entry
        part = np.repeat(np.arange(parts), rows)
        gap = self.points.astype(np.int64) - books[part, codes]
        out = np.zeros((rows, parts), np.int64)
        out[self.owner, part] = codes
        errors = np.zeros(rows, np.int64)
        np.add.at(errors, self.owner, np.einsum("ij,ij->i", gap, gap))
        return out, errors


def _plant(width: int, parts: int, scale: int, chunk: int, leaf: int):
    """Rows of a task to forests of at most ``chunk`` rows."""

    def run(batches):
        held: list[pa.RecordBatch] = []

        def forest(table: pa.Table) -> pa.RecordBatch:
            vectors = pa.concat_arrays(table.column("v").chunks)
            trees = Forest(matrix(vectors, width, scale), parts, leaf).bytes()
            lists = {c: pa.ListArray.from_arrays([0, table.num_rows], pa.concat_arrays(table.column(c).chunks)) for c in ("k", "l")}
            return pa.RecordBatch.from_arrays([lists["k"], lists["l"], *[pa.array([trees[n]], pa.binary()) for n in _TREE]], ["k", "l", *_TREE])

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= chunk:
                table = pa.Table.from_batches(held)
                yield forest(table.slice(0, chunk))
                held = table.slice(chunk).to_batches()
        table = pa.Table.from_batches(held) if held else None
        if table is not None and table.num_rows:
            yield forest(table)

    return run


def _forests(batches, width: int, ids: bool = False):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_buffer() for n in _TREE}
            yield Forest.read(row, width), (batch.column("k")[i].values, batch.column("l")[i].values) if ids else None


def _start(rows: DataFrame, entries: int, width: int, parts: int, scale: int) -> np.ndarray:
    """The parts of the rows with the smallest keys, as (part, entry, component)."""
    first = rows.where(F.col("k").isNotNull()).orderBy("k", "v").limit(entries).toArrow().combine_chunks()
    if not first.num_rows:
        return np.zeros((parts, 0, width), np.int64)
    x = matrix(pa.concat_arrays(first.column("v").chunks), width * parts, scale)
    return np.ascontiguousarray(x.reshape(len(x), parts, width).swapaxes(0, 1))


def _round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks with each entry at the floor of its parts' mean; unused entries stay."""
    shared = trees.sparkSession.sparkContext.broadcast(books)

    def sums(batches):
        book = shared.value
        counts, total = np.zeros(book.shape[:2], np.int64), np.zeros(book.shape, np.int64)
        for forest, _ in _forests(batches, book.shape[2]):
            forest.add(book, counts, total)
        part, entry = np.nonzero(counts)
        if len(part):
            yield pa.RecordBatch.from_arrays([
                pa.array(part), pa.array(entry), pa.array(counts[part, entry]),
                pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * book.shape[2], total[part, entry].ravel())],
                ["part", "entry", "n", "total"])

    found = trees.mapInArrow(sums, "part long, entry long, n long, total array<long>")
    each = found.select("part", "entry", "n", F.posexplode("total").alias("i", "s"))
    mean = each.groupBy("part", "entry", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    after = books.copy()
    for r in mean.collect():  # a row per component of an entry
        after[r["part"], r["entry"], r["i"]] = r["s"] // r["n"]
    shared.destroy()
    return after


def compress(df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, key: str = "vec_id", label: str = "label",
             vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """One code per vector: (<key>, code, error, label_error, codebooks_sha256).

    Components are floor(scale * x); a part's codebook starts as that part of the
    ``entries`` smallest keys (equal keys by their vectors) and is moved ``rounds``
    times. ``code`` holds the entry of each part in two hex digits, ``error`` the
    squared distances summed over parts, ``label_error`` their sum over rows of the
    same label, rows without label together.

    Vectors that are null or hold null or non-finite components are dropped. Rows
    without a key are encoded but start no entry; if none has a key there is no
    codebook, and no rows come back. A row that is repeated counts each time.
    Vectors of unequal length, or of one that ``parts`` does not divide, count as
    filled up with zeros. An empty table gives no rows. Other columns are ignored.
    """
    spark = df.sparkSession
    if entries > 256:
        raise ValueError("two hex digits name at most 256 entries")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = df.where(finite).select(F.col(key).cast("long").alias("k"), F.col(label).alias("l"), F.col(vector).alias("v"))
    span = extent(rows.withColumn("k", F.coalesce("k", F.lit(0))), "k", "v", scale)
    width = max(-(-span.width // parts), 1)
    if span.largest >= 2**30:
        raise ValueError("components are too large for exact squared distances")
    books = _start(rows, entries, width, parts, scale)
    kind = rows.schema["l"].dataType
    out = T.StructType([T.StructField("k", T.LongType()), T.StructField("l", kind), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not books.shape[1]:
        coded = spark.createDataFrame([], out)
    else:
        stored = T.StructType([T.StructField("k", T.ArrayType(T.LongType())), T.StructField("l", T.ArrayType(kind)), *[T.StructField(n, T.BinaryType()) for n in _TREE]])
        trees = Stored(rows.mapInArrow(_plant(width * parts, parts, scale, CHUNK, LEAF), stored))
        for _ in range(rounds):
            books = _round(trees.df, books)
        shared = spark.sparkContext.broadcast(books)

        def encode(batches):
            for forest, (keys, labels) in _forests(batches, width, ids=True):
                codes, errors = forest.encode(shared.value)
                text = codes.astype(np.uint8).tobytes().hex()
                names = [text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)]
                yield pa.RecordBatch.from_arrays([keys, labels, pa.array(names, pa.string()), pa.array(errors)], ["k", "l", "code", "error"])

        coded = Stored(trees.df.mapInArrow(encode, out)).df
        trees.drop()
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    by_label = coded.groupBy("l").agg(F.sum("error").alias("label_error"))
    named = coded.join(by_label.withColumnRenamed("l", "m"), F.col("l").eqNullSafe(F.col("m")))
    return named.select(F.col("k").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
