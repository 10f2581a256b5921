"""k nearest vectors by a bounded merge (kNN classification, interpolated minority rows).

Points belong to the nearest of a few pivots and, by their distance from it, to a
ring; rings are cut into blocks of some hundred points. Queries near one pivot
form slabs of some thousand. Which rings a slab needs follows from the triangle
inequality and an upper bound of each query's k-th distance. A task reads a slab
and then, one after another, its blocks in order of their lower bound; it keeps k
points per query and passes over the blocks beyond every k-th distance. At most k
rows per query leave a task, and these lists are merged by a window. Points are
copied once per slab, so slabs are large; a task works on some queries of it at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RINGS = 16  # rings per pivot
GROUPS = 16  # groups of marks; a bound for one group uses the points of the others
BLOCK_ROWS = 256  # points of a block
SLAB_ROWS = 32_768  # queries of a slab
MEET_ROWS = 4096  # queries that meet a block at a time
TASK_BLOCKS = 4096  # blocks that one task of a slab reads
BUFFER = 50_000  # hits that are sorted at a time, at least
SINGLE = 1e30  # squares up to which single precision rules out pairs
MANY = 0.05  # share of pairs that may be near, beyond which a block's own k-th distances are looked at


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    values = column if pa.types.is_floating(column.type) else column.flatten()
    return values.to_numpy(zero_copy_only=False).astype(float).reshape(rows, -1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _bounds(nearest: list, cells: int, need: int) -> np.ndarray:
    """Per cell and group of marks, the ``need``-th smallest pivot distance among points of the other groups."""
    cell, group, d = (np.array([r[i] for r in nearest]) for i in range(3))
    out = np.full((cells, GROUPS), np.inf)
    for c in range(cells):
        for g in range(GROUPS):
            others = np.sort(d[(cell == c) & (group != g)])
            if len(others) >= need:
                out[c, g] = others[need - 1]
    return out


class _Rings:
    """Least and largest pivot distance and number of points of each ring, and where its cell lies."""

    def __init__(self, rows: list, pivots: np.ndarray, bounds: np.ndarray):
        self.cell, self.ring = np.array([r["__cell"] for r in rows]), np.array([r["__ring"] for r in rows])
        self.low, self.high = np.array([r["low"] for r in rows]), np.array([r["high"] for r in rows])
        self.pivots, self.bounds = pivots, bounds

    def place(self, batches):
        """Adds a query's nearest pivot and an upper bound of its k-th distance."""
        for batch in batches:
            d = _distances(_matrix(batch.column("__v"), batch.num_rows), self.pivots)
            reach = (d + self.bounds[:, batch.column("__group").to_numpy()].T).min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(d.argmin(axis=1).astype(np.int32)), pa.array(reach * (1 + 1e-9) + 1e-6)],
                [*batch.schema.names, "__home", "__theta"])

    def needed(self, batches):
        """Per slab the rings that may hold a neighbour of one of its queries, with the smallest distance they may have."""
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            d = _distances(_matrix(batch.column("__v"), batch.num_rows), self.pivots)[:, self.cell]
            least = np.maximum(np.maximum(d - self.high, self.low - d), 0.0)
            least[least > batch.column("__theta").to_numpy()[:, None]] = np.inf
            slabs, at = np.unique(batch.column("__slab").to_numpy(), return_inverse=True)
            for i, slab in enumerate(slabs):
                mine = least[at == i].min(axis=0)
                found[slab] = np.minimum(found.get(slab, np.inf), mine)
        for slab, least in found.items():
            some = np.flatnonzero(np.isfinite(least))
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), slab)), pa.array(some.astype(np.int32)), pa.array(least[some])], ["__slab", "__place", "__least"])


class _Block:
    """Points that the queries of a task meet."""

    def __init__(self, row: dict):
        self.ids, self.marks = row["ids"].values, row["marks"].values
        self.y = _matrix(row["vs"].values, len(self.ids))
        self.squares = (self.y * self.y).sum(axis=1)
        self.most = float(self.squares.max(initial=0.0))
        self.offered = np.concatenate([self.y, self.squares[:, None]], axis=1).T
        self.single = self.offered.astype(np.float32) if self.most < SINGLE else None


class _Slab:
    """Some queries of a task and the nearest points found so far."""

    def __init__(self, ids: pa.Array, x: np.ndarray, marks: pa.Array, thetas: np.ndarray, k: int, apart: bool):
        self.ids, self.x, self.marks, self.bars, self.k, self.apart = ids, x, marks, thetas, k, apart
        self.kinds = self.marks.unique()
        self.own = pc.index_in(self.marks, value_set=self.kinds).to_numpy(zero_copy_only=False)
        self.squares = (self.x * self.x).sum(axis=1)
        self.asked = np.concatenate([-2.0 * self.x, np.ones((len(self.x), 1))], axis=1)
        self.single = self.asked.astype(np.float32) if self.squares.max(initial=0.0) < SINGLE else None
        self.parts: list[pa.Table] = []
        self.held = self.kept = 0

    def meet(self, block: _Block) -> None:
        # Products rule out most pairs, by more than their error; what may be near is measured by differences.
        if self.single is not None and block.single is not None:
            far, error = self.single @ block.single, 1e-5
        else:
            far, error = self.asked @ block.offered, 1e-9
        slack = 1e-7 + error * (self.squares + block.most)
        limit = (self.bars**2 + slack - self.squares)[:, None].astype(far.dtype)
        near = far <= limit
        marks = pc.index_in(block.marks, value_set=self.kinds).fill_null(-1).to_numpy(zero_copy_only=False) if self.apart else None
        if len(block.ids) > self.k and np.count_nonzero(near) > MANY * near.size:
            if self.apart:
                far = np.where(self.own[:, None] == marks[None, :], np.inf, far)
            kth = np.partition(far, self.k - 1, axis=1)[:, self.k - 1]
            near = far <= np.minimum(limit, (kth + 2 * slack)[:, None])
        i, j = np.divmod(np.flatnonzero(near), near.shape[1])
        if self.apart:
            other = self.own[i] != marks[j]
            i, j = i[other], j[other]
        if not len(i):
            return
        gap = block.y[j] - self.x[i]
        d = np.round(np.sqrt(np.einsum("ij,ij->i", gap, gap)), 9)
        self.parts.append(pa.table({"i": i, "d": d, "n": block.ids.take(pa.array(j))}))
        self.held += len(i)
        if self.held - self.kept > max(BUFFER, self.k * len(self.x) // 2):
            self.settle()

    def settle(self) -> None:
        """Keep the k nearest of each query, ties by id, and lower its bar."""
        if not self.parts:
            return
        table = pa.concat_tables(self.parts)
        table = table.take(pc.sort_indices(table, sort_keys=[("i", "ascending"), ("d", "ascending"), ("n", "ascending")]))
        i, d = table.column("i").to_numpy(), table.column("d").to_numpy()
        rank = np.arange(len(i)) - np.searchsorted(i, np.arange(len(self.x)))[i]
        last = rank == self.k - 1
        self.bars = self.bars.copy()
        self.bars[i[last]] = np.minimum(self.bars[i[last]], d[last])
        table = table.filter(pa.array(rank < self.k))
        self.parts, self.held = [table], table.num_rows
        self.kept = self.held

    def found(self) -> pa.Table | None:
        self.settle()
        if not self.parts or not self.parts[0].num_rows:
            return None
        table = self.parts[0]
        return pa.table({"__id": self.ids.take(table.column("i").combine_chunks()), "__nid": table.column("n"), "distance": table.column("d")})


def _slabs(row: dict, k: int, apart: bool) -> list[_Slab]:
    ids, marks, thetas = (row[n].values for n in ("ids", "marks", "thetas"))
    x, thetas = _matrix(row["vs"].values, len(ids)), thetas.to_numpy()
    cuts = [slice(i, i + MEET_ROWS) for i in range(0, len(ids), MEET_ROWS)]
    return [_Slab(ids[c], x[c], marks[c], thetas[c], k, apart) for c in cuts]


def _meet(k: int, apart: bool):
    """Rows of a partition, a slab before its blocks in order of their bound, to the nearest points per query."""

    def found(slabs):
        for slab in slabs:
            if (table := slab.found()) is not None:
                yield from table.select(["__id", "__nid", "distance"]).combine_chunks().to_batches()

    def run(batches):
        held, key = [], None
        for batch in batches:
            slabs, salts, least = (batch.column(n).to_pylist() for n in ("__slab", "__salt", "__least"))
            for r in range(batch.num_rows):
                if (slabs[r], salts[r]) != key:
                    yield from found(held)
                    key = (slabs[r], salts[r])
                    held = _slabs({n: batch.column(f"__q{n}")[r] for n in ("ids", "vs", "marks", "thetas")}, k, apart)
                else:
                    some = [slab for slab in held if least[r] <= slab.bars.max()]
                    if some:
                        block = _Block({n: batch.column(f"__p{n}")[r] for n in ("ids", "vs", "marks")})
                        for slab in some:
                            slab.meet(block)
        yield from found(held)

    return run


def knn_vectors(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    vector: str = "vec",
    query_id: str = "id",
    point_id: str = "id",
    apart: str | None = None,
    pivots: int = 32,
) -> DataFrame:
    """k nearest points per query by Euclidean distance: (query_id, neighbor, rank, distance).

    ``apart`` names a column of both frames; only points with another value of
    it than the query are neighbours (folds, or the id itself to leave out the
    query). Exact to nine digits, ties broken by id. Ids are unique; rows without
    a vector take no part.
    """
    spark = points.sparkSession
    own = apart is not None and apart == query_id == point_id
    mark_q = F.col(query_id) if own else F.col(apart) if apart else F.lit(0)
    mark_p = F.col(point_id) if own else F.col(apart) if apart else F.lit(0)
    kinds = {df.schema[vector].dataType.simpleString() for df in (queries, points)}
    # What is given in single precision is moved so, and measured in double precision.
    as_given = F.col(vector).cast("array<float>" if kinds == {"array<float>"} else "array<double>").alias("__v")
    pts = points.where(F.col(vector).isNotNull()).select(F.col(point_id).alias("__nid"), as_given, mark_p.alias("__mark"))
    qs = queries.where(F.col(vector).isNotNull()).select(F.col(query_id).alias("__id"), as_given, mark_q.alias("__mark"))
    n_points = pts.count()
    if not n_points:
        raise ValueError("there are no points")
    group = F.pmod(F.xxhash64("__mark"), F.lit(GROUPS)).cast("int") if apart else F.lit(0)
    other = GROUPS - 1 if apart is None else None  # without marks every point is another's
    # At most ``pivots`` rows, picked by hash so that reruns agree; fewer when
    # the cells would not fill a block.
    used = max(1, min(pivots, n_points // BLOCK_ROWS))
    chosen = np.array([r["__v"] for r in pts.orderBy(F.xxhash64("__nid"), "__nid").limit(used).collect()], dtype=float)

    def assign(batches):
        for batch in batches:
            d = _distances(_matrix(batch.column("__v"), batch.num_rows), chosen)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d.argmin(axis=1).astype(np.int32)), pa.array(d.min(axis=1))],
                                             [*batch.schema.names, "__cell", "__pd"])

    def wider(df: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
        return T.StructType([*df.schema.fields, *[T.StructField(*f) for f in fields]])

    pts = pts.mapInArrow(assign, wider(pts, ("__cell", T.IntegerType()), ("__pd", T.DoubleType()))).withColumn("__group", group)
    cells = {r["__cell"]: (r["low"], r["high"]) for r in pts.groupBy("__cell").agg(F.min("__pd").alias("low"), F.max("__pd").alias("high")).collect()}
    spans = F.array(*[F.array(*map(F.lit, cells.get(c, (0.0, 0.0)))) for c in range(used)])
    low, high = spans[F.col("__cell")][0], spans[F.col("__cell")][1]
    pts = pts.withColumn("__ring", F.when(high > low, F.least(F.floor((F.col("__pd") - low) / (high - low) * RINGS), F.lit(RINGS - 1))).otherwise(0).cast("int"))
    # A row per ring, and k rows per pivot and group of marks.
    rings = pts.groupBy("__cell", "__ring").agg(F.min("__pd").alias("low"), F.max("__pd").alias("high"), F.count(F.lit(1)).alias("n")).collect()
    first = F.row_number().over(Window.partitionBy("__cell", "__group").orderBy("__pd", "__nid"))
    need = k + 1 if own else k
    nearest = pts.select("__cell", "__group", "__pd", "__nid").withColumn("__rn", first).where(F.col("__rn") <= need).select("__cell", "__group", "__pd").collect()
    bounds = _Rings(rings, chosen, _bounds(nearest, used, need))

    asked = qs.withColumn("__group", F.lit(other) if other is not None else group)
    asked = asked.mapInArrow(bounds.place, wider(asked, ("__home", T.IntegerType()), ("__theta", T.DoubleType())))
    homes = {r["__home"]: r["n"] for r in asked.groupBy("__home").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = F.array(*[F.lit(max(1, -(-homes.get(c, 0) // SLAB_ROWS))) for c in range(used)])[F.col("__home")]
    asked = asked.withColumn("__slab", F.col("__home").cast("long") * 2**32 + F.pmod(F.xxhash64("__id"), parts))

    wanted = asked.select("__v", "__theta", "__slab").mapInArrow(bounds.needed, "__slab long, __place int, __least double")
    wanted = wanted.groupBy("__slab", "__place").agg(F.min("__least").alias("__least"))
    place = {(r["__cell"], r["__ring"]): i for i, r in enumerate(rings)}
    blocks = [-(-r["n"] // BLOCK_ROWS) for r in rings]
    names = F.array(*[F.array(*[F.lit(place.get((c, r), -1)) for r in range(RINGS)]) for c in range(used)])
    count = F.array(*map(F.lit, blocks))
    salts = wanted.groupBy("__slab").agg(F.ceil(F.sum(count[F.col("__place")]) / TASK_BLOCKS).alias("__salts"))

    dealt = pts.withColumn("__place", names[F.col("__cell")][F.col("__ring")])
    dealt = dealt.withColumn("__part", F.pmod(F.xxhash64("__nid"), count[F.col("__place")].cast("long")))
    packed = dealt.groupBy("__place", "__part").agg(F.collect_list(F.struct("__nid", "__v", "__mark")).alias("b"))
    packed = packed.join(wanted, "__place").join(salts, "__slab").select(
        "__slab", F.pmod(F.xxhash64("__place", "__part"), F.col("__salts")).alias("__salt"), "__least",
        F.col("b.__nid").alias("__pids"), F.flatten("b.__v").alias("__pvs"), F.col("b.__mark").alias("__pmarks"))
    slabs = asked.groupBy("__slab").agg(F.collect_list(F.struct("__id", "__v", "__mark", "__theta")).alias("b")).join(salts, "__slab")
    slabs = slabs.select(
        "__slab", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__salts") - 1)).alias("__salt"), F.lit(-1.0).alias("__least"),
        F.col("b.__id").alias("__qids"), F.flatten("b.__v").alias("__qvs"), F.col("b.__mark").alias("__qmarks"), F.col("b.__theta").alias("__qthetas"))
    met = slabs.unionByName(packed, allowMissingColumns=True).repartition("__slab", "__salt").sortWithinPartitions("__slab", "__salt", "__least")
    schema = T.StructType([T.StructField("__id", qs.schema["__id"].dataType), T.StructField("__nid", pts.schema["__nid"].dataType),
                           T.StructField("distance", T.DoubleType())])
    near = met.mapInArrow(_meet(k, apart is not None), schema)
    w = Window.partitionBy("__id").orderBy("distance", "__nid")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        F.col("__id").alias(query_id), F.col("__nid").alias("neighbor"), "rank", "distance"
    )
