"""Checks across tables (Q1-Q9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.operators.aggregate import distinct_counts, duplicates, missing_share, year_range
from gridpanel.operators.joins import anti_missing, presence_join
from gridpanel.operators.sets import except_ids, not_in_every


def check_duplicates(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per repeated key: table, key as text, count."""
    return reduce(DataFrame.unionByName, [
        duplicates(df, keys).select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]).alias("key"),
            "n",
        )
        for name, (df, keys) in tables.items()
    ])


def check_orphans(facts: Mapping[str, tuple[DataFrame, str]], dim: DataFrame, dim_key: str) -> DataFrame:
    """Ids that occur in a fact table but not in the dimension."""
    ids = dim.select(F.col(dim_key).alias("id"))
    return reduce(DataFrame.unionByName, [
        except_ids(df.select(F.col(k).alias("id")), ids, "id").select(F.lit(n).alias("table_name"), "id")
        for n, (df, k) in facts.items()
    ])


def coverage_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    return distinct_counts(tables)


def not_in_all(tables: Mapping[str, DataFrame], dim: DataFrame, key: str) -> DataFrame:
    """Dimension rows of the ids that some table lacks."""
    return dim.join(not_in_every(tables, key), key, "left_semi")


def presence_matrix(
    dim: DataFrame, facts: Mapping[str, DataFrame], key: str, below: int | None = None
) -> DataFrame:
    """Flags per table and their sum, for entities that miss at least one table."""
    below = len(facts) if below is None else below
    flags = presence_join(dim, facts, key)
    score = reduce(lambda a, b: a + b, [F.col(f"in_{n}") for n in facts])
    return flags.withColumn("total_tables_present", score).where(F.col("total_tables_present") < below)


def year_ranges(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    return year_range(tables)


def missing_in_year(dim: DataFrame, fact: DataFrame, key: str, time: str, year: int) -> DataFrame:
    return anti_missing(dim, fact.where(F.col(time) == year), key)


def lookup_row(dim: DataFrame, key: str, value) -> DataFrame:
    return dim.where(F.col(key) == value)


def missing_summary(df: DataFrame) -> DataFrame:
    return missing_share(df)
