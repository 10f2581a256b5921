"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.functions.expressions import quoted, split_last


def melt_years(
    df: DataFrame, ids: Sequence[str], years: Sequence[str], time: str = "year", value: str = "value"
) -> DataFrame:
    """Year columns to rows; NULL values are kept."""
    return df.unpivot(
        [quoted(c) for c in ids], [quoted(c) for c in years], time, value
    )


def pivot_attribute(
    df: DataFrame, index: Sequence[str], attribute: str, value: str, names: Mapping[str, str] | Sequence[str],
) -> DataFrame:
    """Attribute rows to columns; two rows for one cell are an error.

    ``names`` lists the attributes (or maps them to output columns), which fixes
    the schema and saves the job that would look for them. The rows of a cell are
    counted in the same aggregate, and the query fails when there are two.
    """
    targets = dict(names) if isinstance(names, Mapping) else {n: n for n in names}
    return df.groupBy(*index).agg(*[
        F.when(F.count_if(F.col(attribute) == source) > 1, F.raise_error(F.lit(f"two rows for one cell of {target}")))
        .otherwise(F.max(F.when(F.col(attribute) == source, F.col(value)))).alias(target)
        for source, target in targets.items()
    ])


def wide_to_long(
    df: DataFrame, ids: Sequence[str], stubs: Sequence[str], years: Sequence[int],
    time: str = "year", sep: str = "_",
) -> DataFrame:
    """Several ``stub_year`` families at once, one generator and no exchange."""
    rows = [
        F.struct(
            F.lit(int(y)).alias(time),
            *[
                (F.col(quoted(f"{s}{sep}{y}")) if f"{s}{sep}{y}" in df.columns else F.lit(None)).alias(s)
                for s in stubs
            ],
        )
        for y in years
    ]
    return df.select(*[F.col(quoted(c)) for c in ids], F.inline(F.array(*rows)))


def split_suffix(column: str, sep: str = "_") -> tuple[Column, Column]:
    """``Name_2010`` to (``Name``, 2010)."""
    head, tail = split_last(column, sep)
    return head, tail.try_cast("int")


def edges_to_wide(
    edges: DataFrame, entity: str, k: int, neighbor: str = "neighbor", rank: str = "rank",
    distance: str = "distance", prefix: str = "nearest",
) -> DataFrame:
    """Ranks 1..k of the edge table as columns."""
    return edges.groupBy(entity).agg(*[
        F.max(F.when(F.col(rank) == i, F.col(c))).alias(f"{prefix}_{i}{tail}")
        for i in range(1, k + 1) for c, tail in ((neighbor, ""), (distance, "_distance"))
    ])
