"""Grouped aggregates (A1-A18). Rows whose key is NULL are left out, as in the source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.functions.expressions import half_even, numeric_columns, quoted, ratio, zero_sum
from gridpanel.operators.clean import remap_codes


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def _agg(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    return with_keys(df, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in columns.items()])


def agg_mean(df: DataFrame, keys: Sequence[str], values: Sequence[str], suffix: str = "") -> DataFrame:
    return _agg(df, keys, {f"{v}{suffix}": F.avg(quoted(v)) for v in values})


def agg_std(df: DataFrame, keys: Sequence[str], values: Sequence[str], suffix: str = "_sd") -> DataFrame:
    """Sample standard deviation, NULL for a single row."""
    return _agg(df, keys, {f"{v}{suffix}": F.stddev_samp(quoted(v)) for v in values})


def agg_mean_std(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], mean: str = "_mean", sd: str = "_sd"
) -> DataFrame:
    """Mean and deviation in one pass instead of two aggregates and a join."""
    return _agg(df, keys, {
        **{f"{v}{sd}": F.stddev_samp(quoted(v)) for v in values},
        **{f"{v}{mean}": F.avg(quoted(v)) for v in values},
    })


def agg_sum(df: DataFrame, keys: Sequence[str], values: Sequence[str], null_sum: bool = False) -> DataFrame:
    """Sums; a group without values gives 0, or NULL with ``null_sum``."""
    return _agg(df, keys, {v: F.sum(quoted(v)) if null_sum else zero_sum(v) for v in values})


def agg_max(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return _agg(df, keys, {v: F.max(quoted(v)) for v in values})


def multi_agg(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], distinct: Mapping[str, str]
) -> DataFrame:
    """Named sums and distinct counts in one group-by."""
    return _agg(df, keys, {
        **{out: zero_sum(c) for out, c in sums.items()},
        **{out: F.count_distinct(F.col(c)) for out, c in distinct.items()},
    })


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def distinct_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row, one column per table with its number of distinct entities."""
    return _one_row({n: df.agg(F.count_distinct(F.col(k)).alias(n)) for n, (df, k) in tables.items()})


def year_range(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row, first and last period per table."""
    return _one_row({
        n: df.agg(F.min(t).alias(f"{n}_min"), F.max(t).alias(f"{n}_max"))
        for n, (df, t) in tables.items()
    })


def _one_row(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Put one-row frames side by side."""
    keyed = [f.withColumn("__one", F.lit(1)) for f in frames.values()]
    return reduce(lambda a, b: a.join(F.broadcast(b), "__one"), keyed).drop("__one")


def rollup_children(
    df: DataFrame,
    parents,
    entity: str,
    time: str,
    sums: Sequence[str] | str | None = "All",
    averages: Sequence[str] | str | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Map children to parents, then sum some columns and average the others.

    Exactly one of the two lists is ``"All"``: every numeric column that the
    other list does not name. Columns that are not numeric are dropped.
    """
    if (sums == "All") == (averages == "All"):
        raise ValueError("exactly one of sums and averages must be 'All'")
    keys = [entity, time, *extra]
    numeric = numeric_columns(df, keys)
    if sums == "All":
        averages = list(averages or [])
        sums = [c for c in numeric if c not in averages]
    else:
        sums = list(sums or [])
        averages = [c for c in numeric if c not in sums]
    return _agg(remap_codes(df, entity, parents), keys, {
        **{c: zero_sum(c) for c in sums}, **{c: F.avg(quoted(c)) for c in averages},
    })


def entity_mode(df: DataFrame, entity: str, label: str, out: str | None = None) -> DataFrame:
    """Most common label per entity, the lowest on ties.

    Two group-bys instead of ``mode``, whose state holds every label of a group.
    """
    counts = df.dropna(subset=[entity, label]).groupBy(entity, label).agg(
        F.count(F.lit(1)).alias("__n")
    )
    best = counts.groupBy(entity).agg(F.max("__n").alias("__n"))
    return counts.join(best, [entity, "__n"]).groupBy(entity).agg(F.min(label).alias(out or label))


def group_profile(df: DataFrame, label: str, values: Sequence[str], digits: int = 3) -> DataFrame:
    return _agg(df, [label], {v: half_even(F.avg(quoted(v)), digits) for v in values})


def totals_by_period(df: DataFrame, time: str, values: Sequence[str]) -> DataFrame:
    return agg_sum(df, [time], values)


def totals_by_parent(
    df: DataFrame, entity: str, time: str, values: Sequence[str], names: Mapping[str, str],
    length: int = 2, out: str = "parent",
) -> DataFrame:
    """Totals per period and parent, the parent looked up from the id prefix."""
    pairs = [F.lit(v) for kv in names.items() for v in kv]
    named = df.withColumn(out, F.create_map(*pairs)[F.substring(F.col(entity).cast("string"), 1, length)])
    return agg_sum(named, [time, out], values)


def pivot_buckets(
    fact: DataFrame, code: str, buckets: DataFrame, keys: Sequence[str], metrics: Sequence[str],
    values: Sequence[str],
) -> DataFrame:
    """Sum metrics per bucket into columns ``metric_bucket``.

    ``buckets`` is a (code, bucket) frame; codes without a bucket are dropped, a
    bucket that is not among ``values`` is an error. The bucket names are given,
    so the plan is one join and one group-by of conditional sums, and the schema
    is fixed. A bucket without rows is NULL.
    """
    pairs = buckets.toDF("__code", "__bucket")
    tagged = with_keys(fact, keys).join(pairs, F.col(code) == F.col("__code"), "inner")
    unknown = F.raise_error(F.concat(F.lit("unknown bucket "), F.col("__bucket").cast("string"))).cast("boolean")
    tagged = tagged.where(F.when(~F.col("__bucket").isin(list(values)), unknown).otherwise(F.col("__bucket").isNotNull()))
    return tagged.groupBy(*keys).agg(*[
        F.sum(F.when(F.col("__bucket") == b, F.coalesce(F.col(quoted(m)), F.lit(0)))).alias(f"{m}_{b}")
        for m in metrics for b in values
    ])


def entity_average(
    df: DataFrame, entity: str, time: str, value: str, first: int, last: int, out: str
) -> DataFrame:
    """Rounded average per entity inside a period window."""
    return df.where(F.col(time).between(first, last)).groupBy(entity).agg(
        F.round(F.avg(value), 0).alias(out)
    )


def yearly_average(tables: Mapping[str, tuple[DataFrame, str]], time: str) -> DataFrame:
    """Mean per period of several tables side by side; the first table leads."""
    parts = [
        df.groupBy(time).agg(F.avg(v).alias(out)) for out, (df, v) in tables.items()
    ]
    return reduce(lambda a, b: a.join(b, time, "left"), parts)


def total_change(df: DataFrame, entity: str, difference: str, out: str = "total_change") -> DataFrame:
    return _agg(df, [entity], {out: zero_sum(difference)})


def coverage(df: DataFrame, entity: str, time: str, values: Sequence[str]) -> DataFrame:
    """Entity-periods with at least one complete row."""
    return df.dropna(subset=list(values)).select(entity, time).distinct()


def value_ranges(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """Global minimum and maximum per column, from one pass."""
    row = df.agg(F.array(*[
        F.struct(F.lit(v).alias("column"), F.min(quoted(v)).cast("double").alias("min"),
                 F.max(quoted(v)).cast("double").alias("max")) for v in values
    ]).alias("r"))
    return row.select(F.inline("r"))


def missing_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of NULLs per column, from one pass."""
    columns = list(columns or df.columns)
    row = df.agg(F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            ratio(F.count_if(F.col(quoted(c)).isNull()), F.count(F.lit(1))).alias("missing_share"),
        ) for c in columns
    ]).alias("r"))
    return row.select(F.inline("r"))
