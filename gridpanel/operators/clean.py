"""Projections, filters and predicates for raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.functions.expressions import (
    half_even, map_values, matches, not_in, parse_number, quoted, ratio, zero_pad,
)


def rename_map(df: DataFrame, names: Mapping[str, str], lower: bool = True) -> DataFrame:
    """Lower-case headers, then rename; several source spellings may share a target.

    Where more than one spelling is present the first non-null value wins.
    """
    if lower:
        df = df.toDF(*[c.lower() for c in df.columns])
    sources: dict[str, list[str]] = {}
    for c in df.columns:
        sources.setdefault(names.get(c, c), []).append(c)
    return df.select(
        *[
            (F.coalesce(*[F.col(quoted(s)) for s in found]) if len(found) > 1
             else F.col(quoted(found[0]))).alias(target)
            for target, found in sources.items()
        ]
    )


def select_cols(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    return df.select(*[F.col(quoted(c)) for c in columns if c in df.columns])


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def filter_regex(
    df: DataFrame, column: str, pattern: str, ignore_case: bool = False, keep: bool = True
) -> DataFrame:
    """Rows whose text matches (or, with ``keep=False``, does not match) a pattern."""
    hit = matches(column, pattern, ignore_case)
    return df.where(hit if keep else ~hit)


def filter_years(df: DataFrame, time: str, first: int, last: int) -> DataFrame:
    return df.where(F.col(time).between(first, last))


def filter_prefix_in(df: DataFrame, column: str, length: int, prefixes: Sequence[str]) -> DataFrame:
    return df.where(F.substring(column, 1, length).isin(list(prefixes)))


def exclude_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Drop listed values; rows without a value stay."""
    return df.where(not_in(column, values))


def slice_period(df: DataFrame, time: str, value: int) -> DataFrame:
    return df.where(F.col(time) == value).drop(time)


def remap_codes(
    df: DataFrame, column: str, crosswalk: Mapping[str, str] | DataFrame
) -> DataFrame:
    """Child id to parent id; ids outside the crosswalk are unchanged.

    A Python mapping becomes a literal in the plan. A DataFrame (child, parent)
    is left-joined and Spark broadcasts it when its run-time size allows. A child
    with two different parents is an error; equal rows count once.
    """
    if isinstance(crosswalk, DataFrame):
        pairs = crosswalk.toDF("__child", "__parent").groupBy("__child").agg(
            F.min("__parent").alias("__parent"), F.max("__parent").alias("__other"))
        message = F.concat(F.lit("two parents for "), F.col("__child").cast("string"))
        pairs = pairs.select("__child", F.when(
            F.col("__parent") != F.col("__other"), F.raise_error(message)).otherwise(F.col("__parent")).alias("__parent"))
        return (
            df.join(pairs, F.col(column) == F.col("__child"), "left")
            .withColumn(column, F.coalesce("__parent", column))
            .drop("__child", "__parent")
        )
    return df.withColumn(column, map_values(column, crosswalk))


def null_by_flag(df: DataFrame, flag: str, bands: Mapping[str, Sequence[str]]) -> DataFrame:
    """Null the columns a suppression flag hides."""
    hidden_by: dict[str, list[str]] = {}
    for code, columns in bands.items():
        for c in columns:
            hidden_by.setdefault(c, []).append(code)
    return df.withColumns(
        {
            c: F.when(not_in(flag, codes), F.col(quoted(c)))
            for c, codes in hidden_by.items()
            if c in df.columns
        }
    )


def coerce_numeric(
    df: DataFrame, columns: Sequence[str], to: str = "double", sentinels: Sequence[str] = ()
) -> DataFrame:
    return df.withColumns({c: parse_number(c, to, sentinels) for c in columns})


def build_key(parts: Sequence[str], widths: Sequence[int]) -> Column:
    """Zero-pad the parts and concatenate them to one id."""
    return F.concat(*[zero_pad(p, w) for p, w in zip(parts, widths, strict=True)])


def per_capita(df: DataFrame, columns: Sequence[str], base: str, scale: float = 1.0,
               suffix: str = "per_capita", keep: bool = False) -> DataFrame:
    """``column / base * scale`` as ``column_suffix``; the originals are dropped."""
    df = df.withColumns({f"{c}_{suffix}": ratio(c, base) * F.lit(scale) for c in columns})
    return df if keep else df.drop(*columns)


def log_bin(column: str) -> Column:
    """Integer bucket of log(1 + x), for stratified splits."""
    return half_even(F.log1p(F.col(column).cast("double")))


def presence_flag(column: str, threshold: float = 0) -> Column:
    return F.coalesce(F.col(column) > threshold, F.lit(False))


def rows_with_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of zero rows per column, from one pass."""
    counted = df.agg(*[F.count_if(F.col(quoted(c)) == 0).alias(c) for c in columns])
    return counted.unpivot([], [quoted(c) for c in columns], "column", "n_zero_rows")


def zero_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(quoted(column)) == 0)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset else None)


def offset_from_min(df: DataFrame, time: str, out: str) -> DataFrame:
    """Period minus the smallest period, through a one-row aggregate."""
    first = df.agg(F.min(time).alias("__first")).withColumn("__one", F.lit(1))
    return (
        df.withColumn("__one", F.lit(1))
        .join(F.broadcast(first), "__one", "left")
        .withColumn(out, F.col(time) - F.col("__first"))
        .drop("__one", "__first")
    )


def fill_constant(df: DataFrame, columns: Sequence[str], value=0) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(quoted(c)), F.lit(value)) for c in columns})
