"""Row offsets, gap filling and event time along each entity's series.

``hot`` decides how a series is windowed. With ``hot=True`` (the default) a
series that holds a large share of all rows is cut into blocks along time and
the rows a block needs from before it are copied in. With ``hot=False`` the
caller states that a series has few rows by construction, for example a panel
that was just grouped by entity and year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.functions.expressions import half_even, quoted, ratio
from gridpanel.operators.ordered import ranked_values, running
from gridpanel.operators.skew import BLOCK, BLOCK_ROWS, null_safe, split_long_series

_HALO = "__halo"


def _tails(blocked: DataFrame, keys: Sequence[str], order: Sequence[str], depth: int) -> DataFrame:
    """For every block of a hot series: the last ``depth`` rows before it.

    Spark prunes the first window to ``depth`` rows per block before the
    exchange; the second one sees ``depth`` rows per block, and blocks are few.
    """
    newest = [F.col(c).desc() for c in order]
    last = (
        blocked.where(F.col(BLOCK) > 0)
        .withColumn("__rn", F.row_number().over(Window.partitionBy(*keys, BLOCK).orderBy(*newest)))
        .where(F.col("__rn") <= depth)
        .withColumn("__d", F.dense_rank().over(Window.partitionBy(*keys).orderBy(BLOCK)))
    )
    numbers = last.select(*keys, F.col("__d").alias("__to"), F.col(BLOCK).alias("__b")).distinct()
    offered = last.withColumn("__to", F.explode(F.sequence(F.col("__d") + 1, F.col("__d") + depth)))
    placed = null_safe(offered, numbers, [*keys, "__to"], "inner")
    return (
        placed.withColumn(
            "__rn", F.row_number().over(Window.partitionBy(*keys, "__to").orderBy(*newest))
        )
        .where(F.col("__rn") <= depth)
        .drop(BLOCK, "__rn", "__d", "__to")
        .withColumnRenamed("__b", BLOCK)
    )


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs,
    depth: int,
    hot: bool = True,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add columns computed from the row and up to ``depth`` rows before it.

    ``outputs`` takes a window and returns {name: column}.
    """
    keys, order = list(keys), list(order)
    if not hot:
        return df.withColumns(outputs(Window.partitionBy(*keys).orderBy(*order)))
    blocked = split_long_series(df, keys, order, rows)
    halo = _tails(blocked, keys, order, depth).withColumn(_HALO, F.lit(True))
    both = blocked.withColumn(_HALO, F.lit(False)).unionByName(halo)
    window = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    return both.withColumns(outputs(window)).where(~F.col(_HALO)).drop(_HALO, BLOCK)


def add_lags(
    df: DataFrame, entity: str | Sequence[str], time: str | Sequence[str], columns: Sequence[str],
    lags: Sequence[int] = (1, 2, 3), **how,
) -> DataFrame:
    """Value 1, 2, 3 rows earlier in the series (rows, not calendar periods)."""
    keys, order = _names(entity), _names(time)
    return over_series(
        df, keys, order,
        lambda w: {f"{c}_lag{n}": F.lag(quoted(c), n).over(w) for c in columns for n in lags},
        depth=max(lags), **how,
    )


def _names(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def change(current: Column, previous: Column) -> Column:
    """Relative change; 0 after a zero, whatever follows it."""
    return F.when(previous == 0, F.lit(0.0)).otherwise(ratio(current, previous) - 1.0)


def yoy_change(
    df: DataFrame, entity: str, time: str, columns: Sequence[str], extra: Sequence[str] = (), **how
) -> DataFrame:
    return over_series(
        df, [entity, *extra], [time],
        lambda w: {
            f"{c}_yoy_change": change(F.col(quoted(c)), F.lag(quoted(c), 1).over(w)) for c in columns
        },
        depth=1, **how,
    )


def diff_features(
    df: DataFrame, entity: str, time: str, columns: Sequence[str], **how
) -> DataFrame:
    """Difference, asinh and difference of asinh to the previous row."""

    def outputs(w):
        out = {}
        for c in columns:
            now, before = F.col(quoted(c)), F.lag(quoted(c), 1).over(w)
            out[f"{c}_raw_diff"] = now - before
            out[f"{c}_asinh"] = F.asinh(now)
            out[f"{c}_asinh_growth"] = F.asinh(now) - F.asinh(before)
        return out

    return over_series(df, [entity], [time], outputs, depth=1, **how)


def rank_within(df: DataFrame, entity: str, order: Sequence[str | Column], k: int,
                out: str = "rank") -> DataFrame:
    """Row number per entity, first k only.

    The filter on the row number lets Spark keep k rows per entity and task
    before the exchange, so a hot entity never travels whole.
    """
    w = Window.partitionBy(entity).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


COUNT_LIKE = ("count", "establishment", "employee")


def _brackets(df, keys, order, columns, hot, rows):
    """Position in the series and, per column, the bracketing values and positions."""
    if hot:
        blocked = split_long_series(df, keys, order, rows)
    else:
        blocked = df.withColumn(BLOCK, F.lit(0))
    inside = Window.partitionBy(*keys, BLOCK).orderBy(order)
    placed = blocked.withColumn("__pos", F.row_number().over(inside).cast("long"))
    known = {
        c: F.when(F.col(quoted(c)).isNotNull(),
                  F.struct(F.col("__pos").alias("p"), F.col(quoted(c)).cast("double").alias("v")))
        for c in columns
    }
    if hot:
        totals = placed.where(F.col(BLOCK) > 0).groupBy(*keys, BLOCK).agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.max(s).alias(f"__l{i}") for i, s in enumerate(known.values())],
            *[F.min(s).alias(f"__f{i}") for i, s in enumerate(known.values())],
        )
        before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        after = Window.partitionBy(*keys).orderBy(F.col(BLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
        moved = totals.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))

        def shift(s):
            return F.when(
                F.col(s).isNotNull(),
                F.struct((F.col(f"{s}.p") + F.col("__off")).alias("p"), F.col(f"{s}.v").alias("v")),
            )

        carried = moved.withColumns(
            {f"__{e}{i}": shift(f"__{e}{i}") for e in "lf" for i in range(len(columns))}
        ).select(
            *keys, BLOCK, "__off",
            *[F.last(f"__l{i}", True).over(before).alias(f"__cl{i}") for i in range(len(columns))],
            *[F.last(f"__f{i}", True).over(after).alias(f"__cf{i}") for i in range(len(columns))],
        )
        placed = null_safe(placed, F.broadcast(carried), [*keys, BLOCK], "left")
        offset = F.coalesce(F.col("__off"), F.lit(0))
    else:
        offset = F.lit(0)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Looking ahead is looking back in descending order: Spark slides such a frame
    # row by row, while it re-reads a frame that is open at the far end.
    onward = Window.partitionBy(*keys, BLOCK).orderBy(F.col(order).desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )

    def lift(s: Column) -> Column:
        return F.when(s.isNotNull(), F.struct((s["p"] + offset).alias("p"), s["v"].alias("v")))

    added = {"__at": F.col("__pos") + offset}
    for i, s in enumerate(known.values()):
        lower, upper = lift(F.last(s, True).over(upto)), lift(F.last(s, True).over(onward))
        if hot:
            lower, upper = F.coalesce(lower, F.col(f"__cl{i}")), F.coalesce(upper, F.col(f"__cf{i}"))
        added[f"__lo{i}"], added[f"__up{i}"] = lower, upper
    out = placed.withColumns(added)
    extra = [f"__cl{i}" for i in range(len(columns))] + [f"__cf{i}" for i in range(len(columns))]
    return out.drop(BLOCK, "__pos", "__off", *extra)


def interpolate(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str,
    columns: Sequence[str],
    round_columns: Sequence[str] | None = None,
    flag: bool = False,
    hot: bool = True,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Fill gaps linearly by row position; leading, trailing and empty series get 0.

    ``round_columns`` are rounded half to even; by default the ones whose name
    speaks of counts, establishments or employees. With ``flag`` every column
    gets ``_was_imputed``, which is NULL for a series without any value.
    """
    keys = _names(keys)
    columns = list(columns)
    if round_columns is None:
        round_columns = [c for c in columns if any(w in c for w in COUNT_LIKE)]
    out = _brackets(df, keys, order, columns, hot, rows)
    filled = {}
    for i, c in enumerate(columns):
        lo, up, own = F.col(f"__lo{i}"), F.col(f"__up{i}"), F.col(quoted(c)).cast("double")
        inner = lo["v"] + (up["v"] - lo["v"]) * (
            ratio(F.col("__at") - lo["p"], up["p"] - lo["p"])
        )
        value = F.when(own.isNotNull(), own).when(
            lo.isNull() | up.isNull(), F.lit(0.0)
        ).otherwise(inner)
        filled[c] = half_even(value) if c in round_columns else value
        if flag:
            filled[f"{c}_was_imputed"] = F.when(lo.isNotNull() | up.isNotNull(), own.isNull())
    out = out.withColumns(filled)
    return out.drop("__at", *[f"__{e}{i}" for e in ("lo", "up") for i in range(len(columns))])


def interpolate_edges_zero(df: DataFrame, entity: str, time: str, column: str, **how) -> DataFrame:
    """One count column: filled, rounded and flagged."""
    return interpolate(df, entity, time, [column], round_columns=[column], flag=True, **how)


def interpolate_all(df: DataFrame, entity: str, time: str, columns: Sequence[str], **how) -> DataFrame:
    """Many columns in one pass over the same windows."""
    return interpolate(df, entity, time, columns, **how)


NEVER = -100


def event_time(
    df: DataFrame, entity: str, time: str, treated: Column, first: str = "first_year",
    flag: str = "treated", relative: str = "relative_year",
) -> DataFrame:
    """First treated period per entity (0 if never), 0/1 flag and relative period.

    The first period is a group-by joined back, so a hot entity is combined on
    the map side.
    """
    firsts = df.groupBy(entity).agg(F.min(F.when(treated, F.col(time))).alias(first))
    out = df.join(firsts, entity, "left").withColumn(first, F.coalesce(F.col(first), F.lit(0)))
    return out.withColumns(
        {
            flag: F.when((F.col(first) > 0) & (F.col(time) >= F.col(first)), 1).otherwise(0),
            relative: F.when(F.col(first) > 0, F.col(time) - F.col(first)).otherwise(F.lit(NEVER)),
        }
    )


def average_ranks(df: DataFrame, groups: Sequence[str], value: str, **how) -> DataFrame:
    """Rank of every distinct value, ties averaged, with its row count ``n``."""
    return ranked_values(df, groups, value, **how).drop("upto")


def cumulative_min(df: DataFrame, groups: Sequence[str], order: str, value: str, out: str,
                   descending: bool = True, **how) -> DataFrame:
    """Running minimum from the largest ``order`` down; ``order`` is unique per group."""
    return running(df, groups, order, {out: ("min", value)}, descending=descending, **how)
