"""Many k-means models in the passes of one.

The centres of all models, every k with every restart, form one matrix. A block of
rows meets it in products of a few hundred centres, small enough for a core's cache,
and labels sort the rows into sums; a model leaves the matrix when its centres stand still. Tasks return a block of sums per
model, merged by model, so a pass shuffles sums and never rows, and the driver
holds centres only. Rows that fit a task are sent to all instead, each fits whole models
and looks again only at rows whose label may have changed. Silhouettes of all chosen models take two further passes: the
moments of their clusters, then every row's distances from those moments.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.operators.moments import merged_arrays
from gridpanel.session import Stored

SEED_ROWS = 4096  # rows, drawn by a hash of their values, that first centres are chosen from
ROWS = 512  # rows of one product
BLOCK, WIDTH = 250, 512  # rows and centres of one product of a pass
FEW = 12  # up to so many centres sums are a product with the labels, beyond it rows are sorted by label
HELD_BYTES = 128 << 20  # rows of up to so many bytes are held by every task, which fits one model after another
SINGLE = 1e30  # squares up to which single precision finds most nearest centres
CHUNK = 512  # rows whose distances a task that holds all rows takes at a time
TASK_ROWS = 65_536  # a task returns the sums of all models, so tasks beyond a core each hold this many rows


@dataclass
class Model:
    """Centres of one model and the sum of squared distances of its last pass."""

    k: int
    start: int
    centres: np.ndarray
    cost: float = np.inf
    rounds: int = 0

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802, as Spark's own models name it
        return list(self.centres)

    def transform(self, df: DataFrame, vector: str = "scaled", out: str = "cluster") -> DataFrame:
        """Adds the number of the nearest centre, the first of equals."""
        centres = self.centres

        @F.pandas_udf("int")
        def nearest(v):
            import pandas as pd

            if not len(v):
                return pd.Series([], dtype="int32")
            x = np.stack(v.to_numpy())
            return pd.Series(np.concatenate([_squares(x[i:i + ROWS], centres).argmin(axis=1) for i in range(0, len(x), ROWS)]).astype("int32"))

        return df.withColumn(out, nearest(vector_to_array(vector)))


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances; products lose digits of them only where rows lie far from zero, which scaled rows do not."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2.0 * (x @ centres.T) + (centres * centres).sum(axis=1)[None, :], 0.0)


def _rows(batches, rows: int = ROWS):
    for batch in batches:
        column = batch.column(0)
        x = column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 0))
        for i in range(0, len(x), rows):
            yield x[i:i + rows]


def _labels(squares: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Column of the nearest centre per row and model."""
    return np.stack([a + squares[:, a:b].argmin(axis=1) for a, b in zip(edges[:-1], edges[1:], strict=True)], axis=1)


def _groups(edges: np.ndarray):
    """Runs of models of one k, of ``WIDTH`` centres together or a single model: first and last model, k."""
    ks, i = np.diff(edges), 0
    while i < len(ks):
        j = i + 1
        while j < len(ks) and ks[j] == ks[i] and (j + 1 - i) * ks[i] <= WIDTH:
            j += 1
        yield i, j, int(ks[i])
        i = j


def _add_sums(x: np.ndarray, centres: np.ndarray, edges: np.ndarray, sums: np.ndarray, cost: np.ndarray) -> None:
    """Add rows to the (count, squares, sum) of their nearest centres, the first of equals, and to the models' costs."""
    one = np.ones((len(x), 1))
    squares = (x * x).sum(axis=1)[:, None]
    moments, asked = np.concatenate([one, squares, x], axis=1), np.concatenate([x, one], axis=1)
    # A row's own squares move the distances to all centres alike.
    offered = np.concatenate([-2.0 * centres, (centres * centres).sum(axis=1)[:, None]], axis=1).T
    for i, j, k in _groups(edges):
        a, b = edges[i], edges[j]
        labels = np.empty((len(x), j - i), np.int16 if k < 1 << 15 else np.int64)
        for r in range(0, len(x), BLOCK):
            far = (asked[r:r + BLOCK] @ offered[:, a:b]).reshape(-1, j - i, k)
            near = far.argmin(axis=2)
            labels[r:r + BLOCK] = near
            cost[i:j] += np.maximum(np.take_along_axis(far, near[:, :, None], axis=2)[:, :, 0] + squares[r:r + BLOCK], 0.0).sum(axis=0)
            if k <= FEW:
                member = (near[:, :, None] == np.arange(k)).reshape(-1, b - a).astype(np.float64)
                sums[a:b] += member.T @ moments[r:r + BLOCK]
        for q in range(j - i if k > FEW else 0):
            order = np.argsort(labels[:, q], kind="stable")
            sorted_ = labels[order, q]
            starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
            sums[a + q * k + sorted_[starts]] += np.add.reduceat(moments[order], starts, axis=0)


def _edges(models: Sequence[Model]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([m.centres for m in models]), np.cumsum([0, *[m.k for m in models]])


def _pass(rows: DataFrame, models: Sequence[Model]) -> list[tuple[np.ndarray, float]]:
    """Per model the sums of its clusters, (count, squares, sum) a row each, and its cost."""
    centres, edges = _edges(models)
    shared = rows.sparkSession.sparkContext.broadcast((centres, edges))

    def run(batches):
        c, e = shared.value
        sums, cost, seen = np.zeros((len(c), c.shape[1] + 2)), np.zeros(len(e) - 1), False
        for x in _rows(batches, 8 * BLOCK):
            _add_sums(x, c, e, sums, cost)
            seen = True
        return {} if not seen else {i: np.append(sums[a:b].ravel(), cost[i]) for i, (a, b) in enumerate(zip(e[:-1], e[1:], strict=True))}

    found = merged_arrays(rows, run, len(models))
    shared.destroy()
    return [(found[i][:-1].reshape(m.k, -1), float(found[i][-1])) for i, m in enumerate(models)]


def _first_centres(sample: np.ndarray, k: int, rnd: np.random.Generator) -> np.ndarray:
    """k-means++: each next centre is drawn by squared distance, the best of a few draws. Its beginnings serve every smaller k."""
    chosen = [int(rnd.integers(len(sample)))]
    left = _squares(sample, sample[chosen])[:, 0]
    for _ in range(1, k):
        total = left.sum()
        tries = np.searchsorted(np.cumsum(left), rnd.random(2 + int(np.log(k))) * total) if total > 0 else rnd.integers(len(sample), size=1)
        tries = np.minimum(tries, len(sample) - 1)
        after = np.minimum(left[:, None], _squares(sample, sample[tries]))
        best = int(after.sum(axis=0).argmin())
        chosen.append(int(tries[best]))
        left = after[:, best]
    return sample[chosen]


def vectors(df: DataFrame, vector: str) -> Stored:
    """The vectors alone as arrays, written once for all passes and dealt evenly to the cores, since dozens of passes follow."""
    rows = df.select(vector_to_array(vector).alias("x")).where("x is not null")
    cores = df.sparkSession.sparkContext.defaultParallelism
    return Stored(rows.repartition(cores * max(1, -(-rows.count() // (cores * TASK_ROWS)))))


def fit_many(
    rows: DataFrame, ks: Sequence[int], restarts: int = 10, seed: int = 42, rounds: int = 300, tolerance: float = 1e-4,
) -> list[Model]:
    """Every k with every restart over a stored column of arrays.

    A model is done when its centres together move by no more than ``tolerance``
    times the mean variance of the columns, or after ``rounds``. A centre without
    rows stays where it is.
    """
    sample = rows.orderBy(F.xxhash64("x"), "x").limit(SEED_ROWS).toArrow().column(0)
    if not len(sample):
        raise ValueError("there are no rows to cluster")
    sample = np.concatenate([c.flatten().to_numpy().reshape(len(c), -1) for c in sample.chunks if len(c)])
    starts = [_first_centres(sample, max(ks), np.random.default_rng([seed, i])) for i in range(restarts)]
    models = [Model(k, i, starts[i][:k].copy()) for k in ks for i in range(restarts)]
    if rows.count() * sample.shape[1] * 8 <= HELD_BYTES:
        return _fit_held(rows, models, rounds, tolerance)
    still = None
    moving = list(models)
    while moving:
        found = _pass(rows, moving)
        if still is None:
            sums = found[0][0].sum(axis=0)  # all rows, whatever the model
            still = tolerance * float(np.maximum(sums[1] / sums[0] - ((sums[2:] / sums[0]) ** 2).sum(), 0.0)) / len(sums[2:])
        after = []
        for model, (sums, cost) in zip(moving, found, strict=True):
            used = sums[:, 0] > 0
            centres = model.centres.copy()
            centres[used] = sums[used, 2:] / sums[used, :1]
            shift = float(((centres - model.centres) ** 2).sum())
            model.centres, model.cost, model.rounds = centres, cost, model.rounds + 1
            if shift > still and model.rounds < rounds:
                after.append(model)
        moving = after
    return models


def _two_nearest(far: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place and value of each row's smallest, the first of equals, and the next value."""
    near, here = far.argmin(axis=1), np.arange(len(far))
    best = far[here, near].astype(np.float64)
    far[here, near] = np.inf
    return near, best, far.min(axis=1).astype(np.float64)


def _fit_model(moments: np.ndarray, squares: np.ndarray, model: Model, still: float, rounds: int) -> None:
    """Lloyd's rounds with all rows at hand, each behind a one.

    A row keeps its label while bounds of its distances to its own centre and to all
    others, moved by what the centres moved, are apart (Hamerly); sums change by the
    rows that change their label. The labels are those of full passes.
    """
    n, k = len(moments), model.k
    labels, upper, lower = np.full(n, -1), np.zeros(n), np.full(n, -np.inf)
    sums, total = np.zeros((k, moments.shape[1])), squares.sum()
    margin = 1e-6 * np.sqrt(squares.max())
    single = moments.astype(np.float32) if squares.max() < SINGLE else None
    kind, allowed = (np.float32, 1e-5) if single is not None else (np.float64, 1e-12)
    while True:
        centres = model.centres
        norms = (centres * centres).sum(axis=1)
        offered, most = np.concatenate([norms[:, None], -2.0 * centres], axis=1).T, norms.max()
        asked = np.flatnonzero(~(upper + margin < lower))
        for r in range(0, len(asked), CHUNK):
            at = asked[r:r + CHUNK]
            # A row's own squares move the distances to all centres alike.
            near, best, second = _two_nearest((single[at] if single is not None else moments[at]) @ offered.astype(kind))
            error = allowed * (squares[at] + most)
            close = np.flatnonzero(~(second - best > 2 * error)) if single is not None else []
            if len(close):  # single precision cannot tell
                near[close], best[close], second[close] = _two_nearest(moments[at[close]] @ offered)
            upper[at] = np.sqrt(np.maximum(best + squares[at] + error, 0.0))
            lower[at] = np.sqrt(np.maximum(second + squares[at] - error, 0.0))
            old = labels[at]
            new = np.flatnonzero(near != old)
            if len(new):
                member = np.zeros((len(new), k))
                member[np.arange(len(new)), near[new]] = 1.0
                left = np.flatnonzero(old[new] >= 0)
                member[left, old[new[left]]] = -1.0
                sums += member.T @ moments[at[new]]
                labels[at[new]] = near[new]
        used = sums[:, 0] > 0
        after = centres.copy()
        after[used] = sums[used, 1:] / sums[used, :1]
        moved = ((after - centres) ** 2).sum(axis=1)
        cost = max(0.0, total - 2.0 * (centres * sums[:, 1:]).sum() + (norms * sums[:, 0]).sum())
        model.centres, model.cost, model.rounds = after, float(cost), model.rounds + 1
        if not (moved.sum() > still and model.rounds < rounds):
            return
        moved = np.sqrt(moved)
        top = int(moved.argmax())
        upper += moved[labels]
        lower -= np.where(labels == top, np.delete(moved, top).max(initial=0.0), moved[top])


def _fit_held(rows: DataFrame, models: list[Model], rounds: int, tolerance: float) -> list[Model]:
    """Fit every model in a task of its own, over rows that are sent to all."""
    spark = rows.sparkSession
    column = rows.toArrow().column(0)
    x = np.concatenate([c.flatten().to_numpy().reshape(len(c), -1) for c in column.chunks if len(c)])
    squares = (x * x).sum(axis=1)
    still = tolerance * float(np.maximum(squares.mean() - (x.mean(axis=0) ** 2).sum(), 0.0)) / x.shape[1]
    order = sorted(range(len(models)), key=lambda i: -models[i].k)  # the longest first
    shared = spark.sparkContext.broadcast((np.concatenate([np.ones((len(x), 1)), x], axis=1), squares))
    starts = spark.sparkContext.broadcast([models[i] for i in order])

    def run(batches):
        for batch in batches:
            for place in batch.column(0).to_pylist():
                model = starts.value[place]
                model = Model(model.k, model.start, model.centres.copy())
                _fit_model(*shared.value, model, still, rounds)
                yield pa.RecordBatch.from_pydict({
                    "place": pa.array([place], pa.int64()), "cost": pa.array([model.cost], pa.float64()), "rounds": pa.array([model.rounds], pa.int32()),
                    "centres": pa.array([np.ascontiguousarray(model.centres, np.float64).tobytes()], pa.binary())})

    fitted = spark.range(0, len(models), 1, len(models)).mapInArrow(run, "place long, cost double, rounds int, centres binary").collect()
    for r in fitted:
        model = models[order[r["place"]]]
        model.centres, model.cost, model.rounds = np.frombuffer(r["centres"]).reshape(model.centres.shape).copy(), r["cost"], r["rounds"]
    shared.destroy()
    starts.destroy()
    return models


def best_of(models: Sequence[Model]) -> dict[int, Model]:
    """The restart with the smallest cost per k, the first of equals."""
    out: dict[int, Model] = {}
    for m in models:
        if m.k not in out or m.cost < out[m.k].cost:
            out[m.k] = m
    return out


def silhouettes(rows: DataFrame, models: Sequence[Model]) -> list[float | None]:
    """Mean silhouette on squared distances of each model over a stored column of arrays.

    The mean squared distance of a row to a cluster follows from the cluster's
    count, squares and sum. Rows alone in their cluster count 0; with fewer than
    two clusters that have rows there is no silhouette.
    """
    if not rows.limit(1).count():
        return [None] * len(models)
    moments = np.concatenate([sums for sums, _ in _pass(rows, models)])
    centres, edges = _edges(models)
    shared = rows.sparkSession.sparkContext.broadcast((centres, edges, moments))

    def run(batches):
        c, e, m = shared.value
        n = m[:, 0]
        total = np.zeros((len(e) - 1, 2))
        for x in _rows(batches):
            labels = _labels(_squares(x, c), e)
            with np.errstate(divide="ignore", invalid="ignore"):
                far = np.where(n > 0, (x * x).sum(axis=1)[:, None] + (m[:, 1] - 2.0 * (x @ m[:, 2:].T)) / n, np.inf)
            at = np.arange(len(x))
            for i, (a, b) in enumerate(zip(e[:-1], e[1:], strict=True)):
                own = labels[:, i]
                size = n[own]
                inside = far[at, own] * size / np.maximum(size - 1, 1)
                other = far[:, a:b].copy()
                other[at, own - a] = np.inf
                nearest = other.min(axis=1)
                top = np.maximum(inside, nearest)
                with np.errstate(divide="ignore", invalid="ignore"):
                    s = np.where((size > 1) & (top > 0), (nearest - inside) / top, 0.0)
                total[i] += s.sum(), len(x)
        return {i: total[i] for i in range(len(total))} if total[0, 1] else {}

    found = merged_arrays(rows, run, len(models))
    shared.destroy()
    several = [int((moments[a:b, 0] > 0).sum()) > 1 for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [float(found[i][0] / found[i][1]) if several[i] else None for i in range(len(models))]
