"""Sorting, top-k and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sort_panel(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Range-partitioned sort; to be used at the sink only."""
    return df.orderBy(*keys)


def top_k_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], k: int) -> DataFrame:
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")


def top_n_members(df: DataFrame, member: str, value: str, n: int = 11) -> DataFrame:
    """Rows of the n members with the highest mean value.

    Eleven is what an inclusive slice 0:10 keeps. Ties go to the lower member.
    """
    best = df.groupBy(member).agg(F.avg(value).alias("__m")).orderBy(F.desc("__m"), member).limit(n)
    return df.join(F.broadcast(best.select(member)), member, "left_semi")


def pick_best(candidates: DataFrame, groups: Sequence[str], feature: str, coef: str) -> DataFrame:
    """Per group the feature with the largest absolute coefficient."""
    size = F.struct(F.abs(F.col(coef)).alias("a"), F.col(feature).alias("f"))
    return candidates.groupBy(*groups).agg(F.max(size)["f"].alias(feature))


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def except_ids(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct ids of the fact that the dimension does not know."""
    return fact.select(key).distinct().join(dim.select(key), key, "left_anti")


def not_in_every(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Ids that are missing from at least one table.

    All ids minus the intersection, counted in one tagged union: an id is in
    every table when it was seen with every tag.
    """
    tagged = reduce(
        DataFrame.unionByName,
        [f.select(key, F.lit(i).alias("__t")) for i, f in enumerate(frames.values())],
    )
    seen = [F.max(F.when(F.col("__t") == i, 1).otherwise(0)) for i in range(len(frames))]
    return tagged.groupBy(key).agg(reduce(lambda a, b: a + b, seen).alias("__n")).where(
        F.col("__n") < len(frames)
    ).select(key)


def symmetric_difference(df: DataFrame, key: str, time: str, first: int, second: int) -> DataFrame:
    """Ids seen in exactly one of two periods."""
    return (
        df.where(F.col(time).isin(first, second))
        .groupBy(key)
        .agg(F.min(time).alias("__a"), F.max(time).alias("__b"))
        .where(F.col("__a") == F.col("__b"))
        .select(key, F.col("__a").alias("only_in"))
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in a stated order."""
    return top_k_per_group(df, keys, order, 1)
