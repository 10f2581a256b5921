"""Sums and cross-products from one pass, and the small systems solved from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from gridpanel.functions.expressions import quoted


def pair_names(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def cross_products(
    df: DataFrame, columns: Sequence[str], groups: Sequence[str] = (), centre: Sequence[float] | None = None
) -> DataFrame:
    """``n``, sums ``s<i>`` and products ``p<i>_<j>`` per group, combined map-side.

    ``centre`` is subtracted from the columns first; with values far from zero
    this keeps the products accurate. Rows must be complete.
    """
    shift = list(centre) if centre is not None else [0.0] * len(columns)
    named = df.select(*groups, *[
        F.expr(f"cast({quoted(c)} as double)" + (f" - ({float(m)!r}D)" if m else "")).alias(f"__x{i}")
        for i, (c, m) in enumerate(zip(columns, shift, strict=True))
    ])
    return named.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"sum(__x{i}) as s{i}") for i in range(len(columns))],
        *[F.expr(f"sum(__x{i} * __x{j}) as p{i}_{j}") for i, j in pair_names(len(columns))],
    )


@dataclass
class Moments:
    """Row count, sums and cross-product matrix of some columns."""

    n: float
    sums: np.ndarray
    products: np.ndarray

    @staticmethod
    def of(row: Row, k: int) -> "Moments":
        products = np.zeros((k, k))
        for i, j in pair_names(k):
            products[i, j] = products[j, i] = row[f"p{i}_{j}"] or 0.0
        return Moments(float(row["n"]), np.array([row[f"s{i}"] or 0.0 for i in range(k)]), products)

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.n + other.n, self.sums + other.sums, self.products + other.products)

    def __sub__(self, other: "Moments") -> "Moments":
        return Moments(self.n - other.n, self.sums - other.sums, self.products - other.products)

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.n

    @property
    def centred(self) -> np.ndarray:
        return self.products - np.outer(self.sums, self.sums) / self.n


def column_means(df: DataFrame, columns: Sequence[str]) -> list[float]:
    row = df.agg(*[F.avg(F.col(quoted(c)).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return [float(v) if v is not None else 0.0 for v in row]


# From this width on the sums are made batch-wise with numpy: one aggregate of
# hundreds of expressions costs more to compile than to run.
WIDE = 16


def _partial_sums(centre: Sequence[float]):
    """Per task and fold: row count, sums and products as (fold, place, value) rows."""
    shift = np.array(centre)

    def sums(batches):
        found = {}
        for batch in batches:
            folds = batch["__fold"].to_numpy()
            x = batch.drop(columns="__fold").to_numpy(dtype=float) - shift
            for fold in np.unique(folds):
                part = x[folds == fold]
                row = np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
                found[fold] = found.get(fold, 0.0) + row
        for fold, row in found.items():
            yield pd.DataFrame({"fold": int(fold), "place": np.arange(len(row)), "value": row})

    return sums


def moments_by_fold(
    df: DataFrame, columns: Sequence[str], centre: Sequence[float], fold: str | None = None
) -> dict[int, Moments]:
    """Moments of complete rows per fold, from one pass. There are few folds."""
    k = len(columns)
    mark = F.col(fold).cast("int") if fold else F.lit(0)
    data = df.select(mark.alias("__fold"), *[F.col(quoted(c)).cast("double").alias(f"__c{i}") for i, c in enumerate(columns)])
    if k < WIDE:
        rows = cross_products(data, [f"__c{i}" for i in range(k)], ["__fold"], centre).collect()
        return {r["__fold"]: Moments.of(r, k) for r in rows}
    partial = data.mapInPandas(_partial_sums(centre), "fold int, place int, value double")
    out: dict[int, np.ndarray] = {}
    for r in partial.groupBy("fold", "place").agg(F.sum("value").alias("value")).collect():
        out.setdefault(r["fold"], np.zeros(1 + k + k * k))[r["place"]] = r["value"]
    return {f: Moments(v[0], v[1:k + 1], v[k + 1:].reshape(k, k)) for f, v in out.items()}


def moments(df: DataFrame, columns: Sequence[str], centre: bool = False) -> tuple[Moments, list[float]]:
    """Moments of complete rows and the centre they were taken around."""
    shift = column_means(df, columns) if centre else [0.0] * len(columns)
    found = moments_by_fold(df, columns, shift)
    k = len(columns)
    return found.get(0, Moments(0.0, np.zeros(k), np.zeros((k, k)))), shift


def independent(gram: np.ndarray, tolerance: float = 1e-9) -> list[int]:
    """Columns that are not (numerically) combinations of earlier ones."""
    a = gram.astype(float).copy()
    scale = np.diag(a).copy()
    kept: list[int] = []
    for j in range(len(a)):
        if scale[j] <= 0 or a[j, j] <= tolerance * scale[j]:
            continue
        kept.append(j)
        a = a - np.outer(a[:, j], a[j, :]) / a[j, j]
    return kept


def merged_arrays(rows: DataFrame, per_task: Callable[[object], dict[int, np.ndarray]], keys: int) -> dict[int, np.ndarray]:
    """Flat arrays of doubles per key that tasks make of their Arrow batches, added up over tasks by key.

    The driver gets one array per key, whatever the number of tasks.
    """

    def block(sums: dict[int, np.ndarray]):
        if sums:
            parts = [np.ascontiguousarray(v, np.float64).tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_pydict({"key": pa.array(list(sums), pa.int32()), "part": pa.array(parts, pa.binary())})

    def run(batches):
        yield from block(per_task(batches))

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[key] = total.get(key, 0.0) + np.frombuffer(part)
        yield from block(total)

    schema = "key int, part binary"
    parts = max(1, min(keys, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    merged = rows.mapInArrow(run, schema).repartition(parts, "key").mapInArrow(merge, schema)
    return {r["key"]: np.frombuffer(r["part"]) for r in merged.collect()}
