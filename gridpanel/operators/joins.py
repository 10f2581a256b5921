"""Joins (J1-J3, J5, J7-J12). Spatial pairs are in ``neighbors``.

No side is broadcast by hint unless its row count is fixed in the code: adaptive
execution sees the real size of each side and picks broadcast or a skew-split
sort-merge join by itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.functions.expressions import quoted
from gridpanel.operators.aggregate import missing_share
from gridpanel.operators.skew import skew_join


def lookup_join(
    fact: DataFrame, dim: DataFrame, left: Sequence[str] | str, right: Sequence[str] | str | None = None
) -> DataFrame:
    """Left equi-join to a dimension whose key may have another name."""
    left = [left] if isinstance(left, str) else list(left)
    right = left if right is None else [right] if isinstance(right, str) else list(right)
    if left == right:
        return fact.join(dim, left, "left")
    names = {r: f"__k{i}" for i, r in enumerate(right)}
    keyed = dim.withColumnsRenamed(names)
    condition = reduce(
        lambda a, b: a & b, [fact[l] == keyed[names[r]] for l, r in zip(left, right, strict=True)]
    )
    joined = fact.join(keyed, condition, "left")
    return joined.withColumnsRenamed({v: k for k, v in names.items()})


class NotUnique(ValueError):
    """A table that has to be unique on its keys is not; ``offenders`` holds all repeated keys with their rows."""

    offenders: DataFrame | None = None


def _has_keys(df: DataFrame, keys: Sequence[str], name: str) -> None:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise NotUnique(f"{name} lacks the key columns {missing}")


def check_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    """Fail at once, in a job of its own, with the number of repeated keys and all of them as a frame."""
    _has_keys(df, keys, name)
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    count, first = repeated.agg(F.count(F.lit(1)), F.min(F.struct(*keys))).first()
    if count:
        error = NotUnique(f"{name} is not unique on {list(keys)}: {count} repeated keys, e.g. {tuple(first)}")
        error.offenders = repeated
        raise error


def unique_on(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``df``, whose query fails where two rows share their keys.

    The count is a window over the keys, in the partitioning and order that the
    join on them needs anyway, so nothing is computed twice.
    """
    _has_keys(df, keys, name)
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit(f"{name} is not unique on {', '.join(keys)}: "), shown)
    counted = df.withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return counted.where(F.when(F.col("__rows") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop("__rows")


def assemble_panel(
    base: DataFrame, tables: Mapping[str, DataFrame], keys: Sequence[str], check: bool = True
) -> DataFrame:
    """Left-join tables that are unique on ``keys`` to the base grid.

    All joins share the keys, so the base is exchanged once and every further
    join finds it partitioned already. The query fails on a table that repeats a
    key; ``check=False`` is for tables that are unique by construction.
    """
    parts = [unique_on(t, keys, name) if check else t for name, t in tables.items()]
    return reduce(lambda out, t: out.join(t, list(keys), "left"), parts, base)


def assembly_report(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of missing values of every column of an assembled panel but its keys."""
    return missing_share(panel, [c for c in panel.columns if c not in keys])


def panel_grid(entities: DataFrame, time: str, first: int, last: int) -> DataFrame:
    """Every entity row for every period; one generator per row, no join."""
    return entities.withColumn(time, F.explode(F.sequence(F.lit(first), F.lit(last))))


def neighbor_values(
    panel: DataFrame,
    edges: DataFrame,
    entity: str,
    time: str,
    values: Sequence[str],
    extra: Sequence[str] = (),
    neighbor: str = "neighbor",
    salts: int = 0,
) -> DataFrame:
    """Edge rows with the neighbour's values for each of its periods.

    A neighbour shared by a large part of all entities is a hot key on the edge
    side. Adaptive execution splits its partition; with ``salts`` the edges of
    hot neighbours are spread by the entity they start from instead.
    """
    right = panel.select(F.col(entity).alias(neighbor), time, *extra, *[quoted(v) for v in values])
    if salts:
        return skew_join(edges, right, [neighbor], spread_by=[entity], salts=salts)
    return edges.join(right, neighbor)


def coalesce_join(
    base: DataFrame, primary: DataFrame, fallback: DataFrame, key: str, columns: Sequence[str],
    decided_by: str,
) -> DataFrame:
    """Take all ``columns`` from the fallback where the deciding one is missing.

    The query fails where one of the two repeats a key.
    """
    second = unique_on(fallback, [key], "fallback").select(key, *[F.col(c).alias(f"__f_{c}") for c in columns])
    first = unique_on(primary, [key], "primary").select(key, *columns)
    joined = base.join(first, key, "left").join(second, key, "left")
    use = F.col(decided_by).isNull()
    picked = {f"__p_{c}": F.when(use, F.col(f"__f_{c}")).otherwise(F.col(c)) for c in columns}
    return (
        joined.withColumns(picked)
        .drop(*columns, *[f"__f_{c}" for c in columns])
        .withColumnsRenamed({f"__p_{c}": c for c in columns})
    )


def anti_missing(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Dimension rows without any fact row."""
    return dim.join(fact.select(key), key, "left_anti")


def semi_in(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    return df.join(wanted.select(key), key, "left_semi")


def presence_join(dim: DataFrame, facts: Mapping[str, DataFrame], key: str) -> DataFrame:
    """One 0/1 column ``in_<table>`` per fact table, from one tagged union.

    The ids of all tables go through a single exchange instead of one distinct
    and one join per table.
    """
    names = list(facts)
    tagged = reduce(
        DataFrame.unionByName,
        [facts[n].select(F.col(key).cast("string").alias("__id"), F.lit(i).alias("__t"))
         for i, n in enumerate(names)],
    )
    seen = tagged.where("__id IS NOT NULL").groupBy("__id").agg(
        *[F.max(F.when(F.col("__t") == i, 1).otherwise(0)).alias(f"in_{n}") for i, n in enumerate(names)]
    )
    out = dim.join(seen, F.col(key).cast("string") == F.col("__id"), "left").drop("__id")
    return out.withColumns({f"in_{n}": F.coalesce(F.col(f"in_{n}"), F.lit(0)) for n in names})


def cte_join(
    base: DataFrame, parts: Sequence[tuple[DataFrame, str]], key: str, required: Sequence[str] = ()
) -> DataFrame:
    """Left-join pre-aggregated parts on trimmed keys, then require some columns."""
    out = base
    for i, (part, part_key) in enumerate(parts):
        keyed = part.withColumn(f"__k{i}", F.ltrim(F.col(part_key).cast("string"))).drop(part_key)
        out = out.join(keyed, F.col(key).cast("string") == F.col(f"__k{i}"), "left").drop(f"__k{i}")
    return out.dropna(subset=list(required)) if required else out


def broadcast_label(df: DataFrame, labels: DataFrame, entity: str) -> DataFrame:
    """Put an entity-level result on every row of the entity."""
    return df.join(labels, entity, "left")


def entity_value(df: DataFrame, entity: str, value: Column, out: str) -> DataFrame:
    """Aggregate per entity and put the result back on all rows.

    Written as group-by and join, not as a window, so that a hot entity is
    combined on the map side and its rows are never sorted in one task.
    """
    return df.join(df.groupBy(entity).agg(value.alias(out)), entity, "left")
