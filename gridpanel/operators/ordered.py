"""Prefix sums, ranks and exact quantiles that no single task has to hold.

The pattern is the same everywhere: collapse equal values first, cut hot groups
into blocks along the value, scan every block on its own, and add what the
earlier blocks contribute. The table of block totals, a few thousand rows over
all groups whatever the input, is the only thing windowed over a whole group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.functions.expressions import quoted
from gridpanel.operators.skew import BLOCK, BLOCK_ROWS, null_safe, split_long_series

ALL = "__all"

# Size of a quantile summary (rank error about 0.04 %), how many of them merge
# before the last task merges the rest, and the cells that it cuts a column into.
SUMMARY_SIZE, SUMMARIES, CELLS = 8192, 256, 16_384


def with_groups(df: DataFrame, groups: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Use a constant group where the caller has none."""
    if groups:
        return df, list(groups)
    return df.withColumn(ALL, F.lit(0)), [ALL]


def value_counts(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """One row per distinct (group, value) with ``n``; NULL values are left out."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*groups, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: dict[str, tuple[str, str]],
    rows: int = BLOCK_ROWS,
    descending: bool = False,
) -> DataFrame:
    """Running sums or minima along ``order`` including the current row.

    ``columns`` maps an output name to (function, input), the function being
    ``sum`` or ``min``. Rows of a key must differ in ``order``.
    """
    df, keys = with_groups(df, keys)
    blocked = split_long_series(df, keys, order, rows)
    direction = (lambda c: F.col(c).desc()) if descending else F.col
    functions = {"sum": F.sum, "min": F.min}

    totals = blocked.where(F.col(BLOCK) > 0).groupBy(*keys, BLOCK).agg(
        *[functions[f](c).alias(f"__t_{o}") for o, (f, c) in columns.items()]
    )
    before = Window.partitionBy(*keys).orderBy(direction(BLOCK)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = totals.select(
        *keys,
        BLOCK,
        *[functions[f](f"__t_{o}").over(before).alias(f"__c_{o}") for o, (f, c) in columns.items()],
    )
    out = null_safe(blocked, F.broadcast(carried), [*keys, BLOCK], "left")
    inside = Window.partitionBy(*keys, BLOCK).orderBy(direction(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    for name, (f, c) in columns.items():
        here, carry = functions[f](c).over(inside), F.col(f"__c_{name}")
        if f == "sum":
            value: Column = here + F.coalesce(carry, F.lit(0))
        else:
            value = F.least(here, carry)
        out = out.withColumn(f"__o_{name}", value)
    return out.drop(*columns, BLOCK, ALL, *[f"__c_{o}" for o in columns]).withColumnsRenamed(
        {f"__o_{o}": o for o in columns}
    )


def ranked_values(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Distinct values with ``n``, ``upto`` (rows at or below) and ``avg_rank``."""
    counts = value_counts(df, groups, value)
    out = running(counts, groups, value, {"upto": ("sum", "n")}, rows)
    return out.withColumn(
        "avg_rank", F.col("upto") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)
    )


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    shares: dict[str, float],
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Linear-interpolated quantiles per group, one column per share, plus ``n_values``.

    Unlike the built-in exact percentile no task keeps the values of a group in
    memory; a quantile is read off the running counts.
    """
    df, groups_ = with_groups(df.select(*groups, value), groups)
    counts = value_counts(df, groups_, value)
    ranked = running(counts, groups_, value, {"upto": ("sum", "n")}, rows)
    sizes = counts.groupBy(*groups_).agg(F.sum("n").alias("n_values"))
    placed = null_safe(ranked, sizes, groups_, "inner")

    picks = []
    for name, share in shares.items():
        place = (F.col("n_values") - 1) * F.lit(float(share))
        low, high = F.floor(place), F.ceil(place)
        picks += [
            F.min(F.when(F.col("upto") > low, F.col(value))).alias(f"__lo_{name}"),
            F.min(F.when(F.col("upto") > high, F.col(value))).alias(f"__hi_{name}"),
        ]
    found = placed.groupBy(*groups_, "n_values").agg(*picks)
    columns = []
    for name, share in shares.items():
        place = (F.col("n_values") - 1) * F.lit(float(share))
        low, high = F.col(f"__lo_{name}").cast("double"), F.col(f"__hi_{name}").cast("double")
        columns.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.select(*groups, F.col("n_values"), *columns)


def order_statistics(
    df: DataFrame, column: str, places: Callable[[int], Sequence[int]], cells: int = CELLS
) -> tuple[int, dict[int, float]]:
    """The number of finite values of a column, and those at some places (from 0) of their order.

    ``places`` takes that number; it should ask for a few thousand places at most,
    since the driver holds them. The result is exact, but no column is sorted: a
    mergeable quantile summary cuts the range into cells, a scan counts what falls
    into each cell and on each border, and only the cells that hold a place asked
    for are looked into, equal values folded to one row. Such a cell has about
    1/cells of the values, copies of one value aside. ``df`` is read three times.
    NULL, NaN and infinite values are left out; without values nothing is found.
    """
    x = df.select((F.col(quoted(column)).cast("double") + F.lit(0.0)).alias("x")).where("NOT isnan(x) AND abs(x) < double('Infinity')")
    part = (F.spark_partition_id() % SUMMARIES).alias("part")
    merged = (
        x.select("x", part).groupBy("part").agg(F.kll_sketch_agg_double("x", SUMMARY_SIZE).alias("s"))
        .agg(F.kll_merge_agg_double("s", SUMMARY_SIZE).alias("s"))
    )
    # One literal that Spark folds; an array of as many literals takes seconds to plan.
    shares = F.split(F.lit(",".join(str(i / cells) for i in range(cells + 1))), ",").cast("array<double>")
    summary = merged.where(F.kll_sketch_get_n_double("s") > 0).select(F.kll_sketch_get_quantile_double("s", shares).alias("q")).first()
    if summary is None:
        return 0, {}
    borders = np.unique(np.array(summary["q"], np.float64))

    def cell_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        # Odd numbers are the borders themselves, even ones what lies between them.
        v = batch.column(0).to_numpy(zero_copy_only=False)
        return v, np.searchsorted(borders, v, "left") + np.searchsorted(borders, v, "right")

    def count(batches):
        total = np.zeros(2 * len(borders) + 1, np.int64)
        for batch in batches:
            which, n = np.unique(cell_of(batch)[1], return_counts=True)
            total[which] += n
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(hit, pa.int32()), "n": pa.array(total[hit], pa.int64())})

    sizes = np.zeros(2 * len(borders) + 1, np.int64)
    for cell, n in x.mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect():
        sizes[cell] = n
    ends = np.cumsum(sizes)
    asked = np.unique(np.array(places(int(ends[-1])), np.int64))
    cell = np.searchsorted(ends, asked, "right")
    found = {int(p): float(borders[c // 2]) for p, c in zip(asked, cell, strict=True) if c % 2}
    inner = [(int(c), int(p - ends[c] + sizes[c]), int(p)) for p, c in zip(asked, cell, strict=True) if not c % 2]
    if not inner:
        return int(ends[-1]), found
    open_cells = np.unique([c for c, _, _ in inner])

    def look_into(batches):
        for batch in batches:
            v, c = cell_of(batch)
            values, n = np.unique(v[np.isin(c, open_cells)], return_counts=True)
            c = 2 * np.searchsorted(borders, values, "left")
            yield pa.RecordBatch.from_pydict({"cell": pa.array(c, pa.int32()), "x": pa.array(values, pa.float64()), "n": pa.array(n, pa.int64())})

    values = x.mapInArrow(look_into, "cell int, x double, n long").groupBy("cell", "x").agg(F.sum("n").alias("n"))
    values = values.withColumn("upto", F.sum("n").over(Window.partitionBy("cell").orderBy("x")))
    wanted = df.sparkSession.createDataFrame(inner, "cell int, rank long, place long")
    hits = values.join(F.broadcast(wanted), "cell").where("upto - n <= rank AND rank < upto").select("place", "x")
    return int(ends[-1]), found | {r["place"]: r["x"] for r in hits.collect()}


def quantile_grid(df: DataFrame, column: str, points: int, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Evenly spaced shares from 0 to 1 and the column's exact linear-interpolated quantiles at them.

    There are ``points`` of them, or as many as values if those are fewer.
    """

    def spots(n: int) -> tuple[np.ndarray, np.ndarray]:
        shares = np.linspace(0.0, 1.0, min(points, n)) if n > 1 else np.zeros(n)
        return shares, shares * (n - 1)

    def places(n: int) -> np.ndarray:
        at = spots(n)[1]
        return np.concatenate([np.floor(at), np.ceil(at)]).astype(np.int64)

    n, values = order_statistics(df, column, places, cells)
    shares, at = spots(n)
    low = np.array([values[int(p)] for p in np.floor(at)])
    high = np.array([values[int(p)] for p in np.ceil(at)])
    return shares, low + (high - low) * (at - np.floor(at))


def to_long(
    df: DataFrame, keep: Sequence[str], values: Sequence[str], name: str, value: str
) -> DataFrame:
    """Columns to (name, value) rows as doubles; NULL values are kept."""
    cast = [F.col(f"`{c}`").cast("double").alias(c) for c in values]
    return df.select(*keep, *cast).unpivot(
        list(keep), [f"`{c}`" for c in values], name, value
    )
