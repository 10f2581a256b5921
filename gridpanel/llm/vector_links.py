"""Embedding near-dedup: exact pairs over a cosine threshold by dual traversal of cover trees.

Unit vectors at cosine c lie sqrt(2 - 2 c) apart, so Euclidean bounds apply. The
top of the tree is a net of anchors per large label: nested nets of halving radii
over a bounded sample. Every vector belongs to the cell of its nearest anchor and
visits those cells of a higher number that its distance to their anchor, less
their covering radius, cannot rule out. Within a task, nested levels of halving
radii go on; pairs of nodes are dropped when their covering radii keep them apart
and taken whole when these keep them together, and only the leaves that are left
are compared. Tasks return a count and one link per vector, never pairs.

Equal vectors are one node. In data without structure (random directions in many
dimensions) every exact method compares all pairs of a label; blocks keep the
tasks bounded then, too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.llm.common import components
from gridpanel.session import Stored

SAMPLE = 20_000  # expected vectors that anchors are chosen from
CELL = 8_000  # vectors per anchor, and in one block of a cell's own
BLOCK = 16_384  # visitors of a cell in one block; a block of its own meets one of its own or of its visitors in a task
FEW = 2_000  # both are fewer for vectors of more than NUMBERS / BLOCK components, but not below this
NUMBERS = 1 << 20
LEAF = 256  # vectors that are compared by one matrix product
LOOSE = 16  # so many thin groups in a row, and what is left goes to leaves
EPS = 1e-9


def apart(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, a row of each."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (u @ v.T)))


def net(vectors: np.ndarray, wanted: int) -> np.ndarray:
    """The first ``wanted`` points of the coarsest nested net with that many; each level halves the radius and keeps the one above."""
    chosen = [0]
    nearest = apart(vectors, vectors[:1])[:, 0]
    radius = 2.0
    while len(chosen) < min(wanted, len(vectors)) and radius > 1e-3:
        radius /= 2
        for i in range(len(vectors)):
            if nearest[i] > radius:
                chosen.append(i)
                nearest = np.minimum(nearest, apart(vectors, vectors[i:i + 1])[:, 0])
                if len(chosen) == wanted:
                    break
    return np.array(chosen[:wanted])


class Node:
    """Vectors around one of them: its covering radius, and children of at most half of it, or none in a leaf."""

    __slots__ = ("center", "radius", "members", "children")

    def __init__(self, u: np.ndarray, members: np.ndarray):
        self.members = members
        self.center = u[members[0]]
        distances = apart(u[members], self.center[None, :])[:, 0]
        self.radius = float(distances.max())
        self.children: list[Node] = []
        if len(members) <= LEAF or self.radius <= 1e-6:
            return
        rest, groups, small, thin = members, [], [], 0
        while len(rest) and thin < LOOSE:
            near = apart(u[rest], u[rest[:1]])[:, 0] <= self.radius / 2
            near[0] = True
            groups.append(rest[near])
            rest = rest[~near]
            thin = thin + 1 if len(groups[-1]) < LEAF // 4 else 0
        if len(rest):
            small.append(rest)
        for group in sorted(groups, key=len, reverse=True):
            if len(group) >= LEAF // 4 and len(group) < len(members):
                self.children.append(Node(u, group))
            else:
                small.append(group)
        if small:  # what is too thin for a node of its own goes to leaves together
            loose = np.concatenate(small)
            self.children += [Node(u, loose[i:i + LEAF]) for i in range(0, len(loose), LEAF)]


class Links:
    """Counts of linked vectors, copies included, and a group label for each vector of a task."""

    def __init__(self, u: np.ndarray, copies: np.ndarray, cosine: float):
        self.u, self.copies, self.cosine = u, copies.astype(np.int64), cosine
        self.limit = float(np.sqrt(2 - 2 * cosine))
        self.counts = np.zeros(len(u), np.int64)
        self.label = np.arange(len(u))

    def _join(self, places: np.ndarray) -> None:
        labels = np.unique(self.label[places])
        if len(labels) > 1:
            self.label[np.isin(self.label, labels[1:])] = labels[0]

    def within(self, a: Node) -> None:
        if 2 * a.radius <= self.limit - EPS:
            self.counts[a.members] += self.copies[a.members].sum() - self.copies[a.members]
            self._join(a.members)
        elif not a.children:
            hit = self.u[a.members] @ self.u[a.members].T >= self.cosine
            np.fill_diagonal(hit, False)
            self._take(hit, a.members, a.members, False)
        else:
            for i, x in enumerate(a.children):
                self.within(x)
                for y in a.children[i + 1:]:
                    self.between(x, y)

    def between(self, a: Node, b: Node) -> None:
        d = float(apart(a.center[None, :], b.center[None, :])[0, 0])
        if d > a.radius + b.radius + self.limit + EPS:
            return
        if d + a.radius + b.radius <= self.limit - EPS:
            self.counts[a.members] += self.copies[b.members].sum()
            self.counts[b.members] += self.copies[a.members].sum()
            self._join(np.concatenate([a.members, b.members]))
        elif not a.children and not b.children:
            self._take(self.u[a.members] @ self.u[b.members].T >= self.cosine, a.members, b.members, True)
        elif b.children and (not a.children or b.radius > a.radius):
            for y in b.children:
                self.between(a, y)
        else:
            for x in a.children:
                self.between(x, b)

    def _take(self, hit: np.ndarray, rows: np.ndarray, columns: np.ndarray, both: bool) -> None:
        linked = np.flatnonzero(hit.any(1))
        if not len(linked):
            return
        self.counts[rows] += hit @ self.copies[columns]
        if both:
            self.counts[columns] += hit.T @ self.copies[rows]
        for i in linked:
            self._join(np.append(columns[hit[i]], rows[i]))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Unit vectors of the rows, in double precision; rows of zeros become NaN."""
    with np.errstate(divide="ignore", invalid="ignore"):
        x = x / np.maximum(np.abs(x).max(axis=1), 1e-300)[:, None]
        return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _vectors(given: list[bytes], width: int) -> np.ndarray:
    """Unit vectors from the bytes of vectors as given, which are single precision where that loses nothing."""
    if all(len(b) == 4 * width for b in given):
        return _scaled(np.frombuffer(b"".join(given), np.float32).reshape(-1, width).astype(float))
    return _scaled(np.array([np.frombuffer(b, np.float32 if len(b) == 4 * width else float) for b in given], float))


def _width(place: str) -> int:
    return int(place.split(":", 1)[0])


def _given(batch: pa.RecordBatch):
    """(row, components, bytes of the vector as given in double precision, the same in as few bytes as hold it) of the vectors that can link."""
    column = batch.column("vector")
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    known = batch.column("label").is_valid().to_numpy(zero_copy_only=False) & (sizes > 0)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)  # nulls become NaN
    starts = np.cumsum(sizes) - sizes
    for width in np.unique(sizes[known]):
        rows = np.flatnonzero(known & (sizes == width))
        x = values[starts[rows][:, None] + np.arange(width)]
        good = np.isfinite(x).all(axis=1) & (np.abs(x).max(axis=1) > 0)
        good[good] = np.isfinite(_scaled(x[good])).all(axis=1)
        rows, x = rows[good], x[good]
        with np.errstate(over="ignore"):
            single = x.astype(np.float32)
        exact = (single.astype(float) == x).all(axis=1)
        for i, row in enumerate(rows):
            full = x[i].tobytes()
            yield int(row), int(width), full, single[i].tobytes() if exact[i] else full


def link_vectors(df: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept for every row: vectors of the same label link at ``cosine`` or more.

    n_links counts the other vectors linked directly, component_id is the smallest
    id reachable. Rows without a label, and vectors that are null, empty, zero or
    hold null or non-finite components, link with nothing. Vectors of different
    length never link. Repeated rows are vectors of their own that link with each
    other. A null id passes through with a null component unless it links to one.
    """
    spark = df.sparkSession
    raw = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).cast("string").alias("label"))

    def keyed(batches):
        for batch in batches:
            n = batch.num_rows
            places, nodes, units = [None] * n, [None] * n, [None] * n
            labels = batch.column("label").to_pylist()
            for row, width, given, least in _given(batch):
                place = f"{width}:{labels[row]}"
                places[row], units[row] = place, least
                nodes[row] = xxhash.xxh64_intdigest(place.encode() + b"\x00" + given) - (1 << 63)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(places, pa.string()), pa.array(nodes, pa.int64()), pa.array(units, pa.binary())],
                                             ["vec_id", "place", "node", "unit"])

    rows = Stored(raw.mapInArrow(keyed, "vec_id long, place string, node long, unit binary"))
    nodes = Stored(rows.df.where("node IS NOT NULL").groupBy("node", "place").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"), F.first("unit").alias("unit")))
    total = nodes.df.count()
    least = max(CELL, total // 5000)
    large = {r[0]: r[1] for r in nodes.df.groupBy("place").count().where(F.col("count") > least).collect()}
    draw = F.pmod(F.xxhash64(F.lit(11), "node"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(1, total)) * (1 << 30))
    sample: dict[str, list] = {}
    if large:
        for r in nodes.df.where(F.col("place").isin(list(large)) & draw).select("place", "unit").orderBy("place", "node").collect():
            sample.setdefault(r[0], []).append(bytes(r[1]))
    anchors = {}
    for place, given in sample.items():
        vectors = _vectors(given, _width(place))
        anchors[place] = vectors[net(vectors, -(-large[place] // max(min(FEW, CELL), min(CELL, NUMBERS // 2 // _width(place)))))]
    shared = spark.sparkContext.broadcast(anchors)

    def assign(batches):
        anchors = shared.value
        for batch in batches:
            places, units = batch.column("place").to_pylist(), batch.column("unit").to_pylist()
            cells, far = np.zeros(len(places), np.int64), np.zeros(len(places))
            for place in set(places) & set(anchors):
                at = np.array([i for i, p in enumerate(places) if p == place])
                d = apart(_vectors([units[i] for i in at], _width(place)), anchors[place])
                cells[at], far[at] = d.argmin(1), d.min(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells), pa.array(far)], [*batch.schema.names, "cell", "far"])

    homes = Stored(nodes.df.select("node", "place", "copies", "unit").mapInArrow(assign, "node long, place string, copies long, unit binary, cell long, far double"))
    radii: dict[str, np.ndarray] = {}
    if anchors:
        for r in homes.df.where(F.col("place").isin(list(anchors))).groupBy("place", "cell").agg(F.max("far")).collect():
            radii.setdefault(r[0], np.full(len(anchors[r[0]]), -np.inf))[r[1]] = r[2]
    covers = spark.sparkContext.broadcast(radii)
    limit = float(np.sqrt(2 - 2 * cosine))

    def visit(batches):
        anchors, radii = shared.value, covers.value
        for batch in batches:
            places, units, own = batch.column("place").to_pylist(), batch.column("unit").to_pylist(), batch.column("cell").to_numpy()
            rows, cells = [np.arange(len(places))], [own]
            for place in set(places) & set(anchors):
                at = np.array([i for i, p in enumerate(places) if p == place])
                d = apart(_vectors([units[i] for i in at], _width(place)), anchors[place])
                i, j = np.nonzero((d <= radii[place] + limit + EPS) & (np.arange(d.shape[1]) > own[at][:, None]))
                rows.append(at[i])
                cells.append(j)
            rows, cells = np.concatenate(rows), np.concatenate(cells)
            out = batch.select(["node", "place", "copies", "unit"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cells), pa.array(np.arange(len(rows)) < batch.num_rows)], [*out.schema.names, "cell", "home"])

    visits = homes.df.mapInArrow(visit, "node long, place string, copies long, unit binary, cell long, home boolean")
    width = F.expr("cast(split(place, ':')[0] as long)")
    held = lambda most, numbers: F.greatest(F.lit(min(FEW, most)), F.least(F.lit(most), F.floor(F.lit(numbers) / width)))
    counts = visits.groupBy("place", "cell").agg(F.count_if("home").alias("own"), F.count_if(~F.col("home")).alias("visitors"))
    counts = counts.select("place", "cell", F.ceil(F.col("own") / held(CELL, NUMBERS // 2)).alias("own"), F.ceil(F.col("visitors") / held(BLOCK, NUMBERS)).alias("visitors"))
    sizes = Stored(counts.where("own > 0 and (own > 1 or visitors > 0)"))
    blocked = visits.join(sizes.df, ["place", "cell"], "left").withColumns({"own": F.coalesce("own", F.lit(1)), "visitors": F.coalesce("visitors", F.lit(0))})
    blocked = blocked.withColumn("block", F.pmod(F.xxhash64(F.lit(5), "node"), F.greatest(F.when(F.col("home"), F.col("own")).otherwise(F.col("visitors")), F.lit(1))))
    # A task has two blocks of a cell's own vectors, or one of them and one of visitors; visitors do not meet here.
    blocked = blocked.selectExpr(
        "node", "place", "copies", "unit", "cell", "home", "block", """inline(if(home,
        concat(transform(sequence(0L, own - 1), j -> struct(least(block, j) as low, greatest(block, j) as high, true as alone)),
               transform(if(visitors > 0, sequence(0L, visitors - 1), cast(array() as array<bigint>)), j -> struct(block as low, j as high, false as alone))),
        transform(sequence(0L, own - 1), i -> struct(i as low, block as high, false as alone))))""")

    def compare(table: pa.Table) -> pa.Table:
        u = _vectors(table.column("unit").to_pylist(), _width(table.column("place")[0].as_py()))
        links = Links(u, table.column("copies").to_numpy(), cosine)
        home, block = np.asarray(table.column("home")), table.column("block").to_numpy()
        low, high, alone = (table.column(n)[0].as_py() for n in ("low", "high", "alone"))
        order = np.argsort(table.column("node").to_numpy())

        def tree(mask):
            members = order[mask[order]]
            return Node(u, members) if len(members) else None

        if alone and low == high:
            links.within(tree(home))
        else:
            a, b = (tree(block == low), tree(block == high)) if alone else (tree(home), tree(~home))
            if a and b:
                links.between(a, b)
        some = np.flatnonzero(links.counts > 0)
        keys = table.column("node").to_numpy()
        return pa.table({"node": keys[some], "n": links.counts[some], "root": keys[links.label[some]]})

    task = blocked.groupBy("place", "cell", "low", "high", "alone")
    found = Stored(task.applyInArrow(compare, "node long, n long, root long"))
    trees = components(found.df.select("node", "root"))
    linked = found.df.groupBy("node").agg(F.sum("n").alias("n"))
    known = nodes.df.join(linked, "node", "left").join(trees, "node", "left")
    known = Stored(known.select("node", "copies", "first_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "node").alias("root")))
    smallest = Stored(known.df.groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = Stored(known.df.join(smallest.df, "root").select("node", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id"))
    result = rows.df.select("vec_id", "node").join(named.df, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
