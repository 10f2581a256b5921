"""Sums behind fixed-effects regressions of many outcomes, from two passes over Arrow batches.

The rows are written once, ordered by entity and period, and a range of them is a
task, so an entity with most of the rows is many tasks. Outcomes whose complete
rows are the same in a batch share one product matrix over all outcomes,
regressors and period dummies, and every outcome takes its subset. Demeaning is
algebra: the entity's part of a product is s s' / n, which needs one vector of sums
per entity, and so do its score sums. Tasks add up what they have of an entity;
these vectors are shuffled by entity, never products and never rows a second time.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gridpanel.functions.expressions import quoted
from gridpanel.operators.moments import merged_arrays
from gridpanel.session import Stored

MOST_PERIODS = 4096  # period effects are columns of the normal equations


@dataclass
class Sums:
    """Of one outcome: rows, entities, sums and products of (regressors, period dummies, outcome), and the entities' part of the products."""

    n: int
    entities: int
    sums: np.ndarray
    products: np.ndarray
    between: np.ndarray


def _changes(column: pa.Array) -> np.ndarray:
    """Where each run of equal values begins."""
    if len(column) < 2:
        return np.zeros(min(len(column), 1), int)
    new = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(new) + 1])


@dataclass
class _Reader:
    """What tasks need to know of the rows; it carries no frame."""

    columns: list[str]
    levels: list[str]
    centre: np.ndarray
    place: dict[str, np.ndarray]

    def __call__(self, batches) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, list[str]]]:
        """Entities, where their runs begin, rows of columns and dummies, and the outcomes they are complete for."""
        levels = pa.array(self.levels[1:], pa.string())
        for batch in batches:
            values = [batch.column(f"c{i}") for i in range(len(self.columns))]
            x = np.stack([v.to_numpy(zero_copy_only=False) for v in values], axis=1) - self.centre  # a null is NaN
            known = ~np.isnan(x)
            dummies = np.zeros((batch.num_rows, len(levels)))
            if len(levels):
                at = pc.index_in(batch.column("t"), value_set=levels).fill_null(-1).to_numpy(zero_copy_only=False)
                some = np.flatnonzero(at >= 0)
                dummies[some, at[some]] = 1.0
            z = np.concatenate([x, dummies], axis=1)
            alike: dict[bytes, list[str]] = {}
            masks = {}
            for y, place in self.place.items():
                mask = known[:, place[place < len(self.columns)]].all(axis=1)
                alike.setdefault(mask.tobytes(), []).append(y)
                masks[mask.tobytes()] = mask
            for key, outcomes in alike.items():
                rows = np.flatnonzero(masks[key])
                if len(rows):
                    entities = batch.column("e").take(pa.array(rows))
                    yield entities, _changes(entities), np.nan_to_num(z[rows]), outcomes


class PanelRows:
    """Rows of several outcomes in the order of entity and period."""

    def __init__(self, df: DataFrame, models: Mapping[str, Sequence[str]], entity: str, time: str, time_fe: bool):
        self.models = {y: list(x) for y, x in models.items()}
        self.columns = list(dict.fromkeys(c for y, x in self.models.items() for c in (*x, y)))
        values = [F.nanvl(F.col(quoted(c)).cast("double"), F.lit(None)).alias(f"c{i}") for i, c in enumerate(self.columns)]
        rows = df.dropna(subset=[entity, time]).select(F.col(quoted(entity)).alias("e"), F.col(quoted(time)).alias("t"), *values)
        self.stored = Stored(rows.repartitionByRange("e", "t").sortWithinPartitions("e", "t").withColumn("t", F.col("t").cast("string")))
        found = self.stored.df.agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(len(self.columns))]).first()
        self.centre = np.array([0.0 if v is None or not np.isfinite(v) else v for v in found])
        self.levels: list[str] = []
        if time_fe:
            used = F.lit(False)
            for y, x in self.models.items():
                complete = F.lit(True)
                for c in (*x, y):
                    complete = complete & F.col(f"c{self.columns.index(c)}").isNotNull()
                used = used | complete
            levels = [r[0] for r in self.stored.df.where(used).select("t").distinct().limit(MOST_PERIODS + 1).collect()]
            if len(levels) > MOST_PERIODS:
                raise ValueError(f"more than {MOST_PERIODS} periods: period effects need few levels")
            kind = df.schema[time].dataType.typeName()
            self.levels = sorted(levels, key=(lambda v: float(v)) if kind in ("integer", "long", "short", "byte", "double", "float", "decimal") else str)

    def drop(self) -> None:
        self.stored.drop()

    def place(self, y: str) -> np.ndarray:
        """Where an outcome's regressors, the period dummies and the outcome lie in a row of all columns and dummies."""
        own = [self.columns.index(c) for c in self.models[y]]
        dummies = range(len(self.columns), len(self.columns) + max(len(self.levels) - 1, 0))
        return np.array([*own, *dummies, self.columns.index(y)])

    def _rows(self) -> _Reader:
        return _Reader(self.columns, self.levels, self.centre, {y: self.place(y) for y in self.models})

    def sums(self) -> dict[str, Sums]:
        """First pass: products, and sums per entity, of every outcome."""
        names, place = list(self.models), {y: self.place(y) for y in self.models}
        entity_type, rows = to_arrow_type(self.stored.df.schema["e"].dataType), self._rows()

        def first(batches):
            total: dict[str, np.ndarray] = {}
            for entities, starts, z, outcomes in rows(batches):
                products, runs = z.T @ z, np.add.reduceat(z, starts, axis=0)
                n = np.diff(np.append(starts, len(z)))
                keys = entities.take(pa.array(starts))
                for y in outcomes:
                    p = place[y]
                    total[y] = total.get(y, 0.0) + products[np.ix_(p, p)]
                    yield _records(keys, names.index(y), np.concatenate([n[:, None], runs[:, p]], axis=1))
            for y, p in total.items():
                yield _records(pa.nulls(1, entity_type), names.index(y), p.reshape(1, -1))

        def second(batches):
            found: dict[int, np.ndarray] = {}
            for model, whole, v in _summed(batches):
                k = len(place[names[model]])
                block = found.setdefault(model, np.zeros(2 + k + 2 * k * k))
                if whole:
                    block[2 + k:2 + k + k * k] += v.sum(axis=0)
                else:
                    n, s = v[:, 0], v[:, 1:]
                    block[0] += n.sum()
                    block[1] += len(n)
                    block[2:2 + k] += s.sum(axis=0)
                    block[2 + k + k * k:] += (s.T @ (s / n[:, None])).ravel()
            return found

        out = {}
        for model, block in self._through(first, second).items():
            k = len(place[names[model]])
            out[names[model]] = Sums(int(block[0]), int(block[1]), block[2:2 + k], block[2 + k:2 + k + k * k].reshape(k, k), block[2 + k + k * k:].reshape(k, k))
        return out

    def meats(self, coefficients: Mapping[str, np.ndarray], means: Mapping[str, np.ndarray] | None) -> dict[str, np.ndarray]:
        """Second pass: the sum over entities of their scores' outer products.

        ``coefficients`` has one per regressor and dummy, 0 where it was left out.
        Rows are taken within the entity, or around ``means`` where these are given.
        """
        names, place, rows = list(self.models), {y: self.place(y) for y in self.models}, self._rows()

        def first(batches):
            for entities, starts, z, outcomes in rows(batches):
                keys = entities.take(pa.array(starts))
                n = np.diff(np.append(starts, len(z)))[:, None]
                for y in (y for y in outcomes if y in coefficients):
                    x = z[:, place[y][:-1]]
                    rest = z[:, place[y][-1]] - x @ coefficients[y]
                    sums = np.add.reduceat(np.concatenate([x, x * rest[:, None], rest[:, None]], axis=1), starts, axis=0)
                    yield _records(keys, names.index(y), np.concatenate([n, sums], axis=1))

        def second(batches):
            found: dict[int, np.ndarray] = {}
            for model, _, v in _summed(batches):
                y = names[model]
                k = len(place[y]) - 1
                n, s, a, r = v[:, :1], v[:, 1:1 + k], v[:, 1 + k:1 + 2 * k], v[:, -1:]
                if means is None:
                    scores = a - s * r / n
                else:
                    x = means[y][:-1]
                    middle = means[y][-1] - x @ coefficients[y]
                    scores = a - x * r - middle * s + n * middle * x
                found[model] = found.get(model, 0.0) + scores.T @ scores
            return found

        return {names[m]: v.reshape(len(place[names[m]]) - 1, -1) for m, v in self._through(first, second).items()}

    def _through(self, first, second) -> dict[int, np.ndarray]:
        """Per-entity records of a pass, added up by entity, then what a task makes of them, added up by outcome."""
        schema = f"e {self.stored.df.schema['e'].dataType.simpleString()}, model int, v array<double>"
        records = self.stored.df.mapInArrow(first, schema).repartition("e", "model").sortWithinPartitions("e", "model")
        return merged_arrays(records, second, len(self.models))


def _records(entities: pa.Array, model: int, values: np.ndarray) -> pa.RecordBatch:
    rows, width = values.shape
    lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(values).ravel()))
    return pa.RecordBatch.from_arrays([entities, pa.array(np.full(rows, model, np.int32)), lists], ["e", "model", "v"])


def _summed(batches) -> Iterator[tuple[int, bool, np.ndarray]]:
    """Sorted records to one row per entity of each model; the flag tells those without entity."""
    held: pa.Table | None = None

    def flush(table: pa.Table):
        models = table.column("model").to_numpy()
        blank = table.column("e").is_null().to_numpy()
        for model in np.unique(models):
            for whole in (True, False):
                at = np.flatnonzero((models == model) & (blank == whole))
                if len(at):
                    part = table.take(pa.array(at)).combine_chunks()
                    v = pa.concat_arrays(part.column("v").chunks).flatten().to_numpy().reshape(len(at), -1)
                    if not whole:
                        v = np.add.reduceat(v, _changes(pa.concat_arrays(part.column("e").chunks)), axis=0)
                    yield int(model), whole, v

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        last = table.column("e")[-1]
        same = pc.equal(table.column("e"), last).fill_null(False).to_numpy() if last.is_valid else np.zeros(table.num_rows, bool)
        yield from flush(table.filter(pa.array(~same)))
        held = table.filter(pa.array(same))
    if held is not None and held.num_rows:
        yield from flush(held)
