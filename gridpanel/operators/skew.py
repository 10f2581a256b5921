"""Keeping hot keys out of single tasks.

One entity may hold a large share of all rows. Group-bys are safe because Spark
combines on the map side and joins are safe because adaptive execution splits
hot join partitions. What is left are windows, which put a whole key into one
task, and joins whose hot side feeds a group-by on the same key. Both are
handled here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.functions.expressions import quoted
from gridpanel.session import checkpointed, stored

BLOCK = "__block"

# A key is hot when it holds more than 1/PARTS of all rows, so there are never
# more than PARTS hot keys and their list can be broadcast whatever the input.
PARTS = 1000
MIN_ROWS = 250_000

# A series is cut into blocks of at most about this many rows, whatever the input.
BLOCK_ROWS = 1_000_000
# Rows of a range partition: its bounds come from a sample that the driver holds, of 100 rows a
# partition, so partitions are few; small blocks are cut within them.
PARTITION_ROWS, MOST_PARTITIONS = 500_000, 10_000
# Most rows of a table of spanning series that is broadcast.
SPANNING_ROWS = 100_000


def heavy_keys(
    df: DataFrame, keys: Sequence[str], parts: int = PARTS, min_rows: int = MIN_ROWS, share: str | None = None
) -> DataFrame:
    """Keys with more than 1/parts of the rows and at least ``min_rows`` of them.

    At most ``parts`` rows come back, with the key's share of the rows if a name
    is given for it. The count is combined on the map side and reads the key
    columns only.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).withColumn("__one", F.lit(1))
    total = counts.groupBy("__one").agg(F.sum("__n").alias("__total"))
    return (
        counts.where(F.col("__n") >= min_rows)
        .join(F.broadcast(total), "__one")
        .where(F.col("__n") * parts > F.col("__total"))
        .select(*keys, *([(F.col("__n") / F.col("__total")).alias(share)] if share else []))
    )


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys meet each other; the right keys are dropped."""
    names = {k: f"__r_{k}" for k in keys}
    other = right.withColumnsRenamed(names)
    condition = None
    for k, r in names.items():
        one = left[k].eqNullSafe(other[r])
        condition = one if condition is None else condition & one
    return left.join(other, condition, how).drop(*names.values())


def split_long_series(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``__block``: 0 for series that lie in one piece, 1, 2, ... along ``order`` for the others.

    The rows are range-partitioned by key and order into a bounded number of partitions,
    since the bounds come from a sample that goes to the driver, sorted within them, cut
    into pieces of at most ``rows`` rows, and written to the shared folder once; what
    follows reads them from there. The cut goes by all order columns, so a series whose
    rows agree in the first one is cut as well. Rows that agree in all of them stay
    together, in the piece of the first. A window over (keys, block) sees a
    contiguous piece of the series. Up to ``rows`` rows nothing is moved.
    """
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    total = df.count()
    if total <= rows:
        return df.withColumn(BLOCK, F.lit(0).cast("long"))
    pieces = min(-(-total // min(rows, PARTITION_ROWS)), max(-(-total // PARTITION_ROWS), 2), MOST_PARTITIONS)
    by = [F.col(quoted(c)) for c in dict.fromkeys([*keys, *order])]
    # The id is the partition's number times 2^33 plus the place of the row in it.
    ranged = df.repartitionByRange(pieces, *by).sortWithinPartitions(*by).withColumn("__part", F.monotonically_increasing_id())
    first = F.min("__part").over(Window.partitionBy(*by))
    ranged = ranged.withColumn("__part", first).withColumn(
        "__part", F.expr(f"shiftleft(shiftright(__part, 33), 33) + (__part & 8589934591L) div {int(rows)}L"))
    ranged = checkpointed(ranged)
    key = F.struct(*[F.col(quoted(k)) for k in keys])
    ends = ranged.groupBy("__part").agg(F.min(key).alias("__first"), F.max(key).alias("__last"))
    ends = ends.select("__part", F.explode(F.array("__first", "__last")).alias("__key")).distinct()
    spanning = stored(ends.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__key.*", F.lit(True).alias("__long")))
    if spanning.limit(SPANNING_ROWS + 1).count() <= SPANNING_ROWS:
        spanning = F.broadcast(spanning)
    out = null_safe(ranged, spanning, keys, "left")
    return out.withColumn(BLOCK, F.when(F.col("__long"), F.col("__part") + 1).otherwise(F.lit(0).cast("long"))).drop("__part", "__long")


def skew_join(
    big: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = 64,
    parts: int = PARTS,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Equi-join that spreads the hot keys of ``big`` over ``salts`` buckets.

    ``spread_by`` names columns that tell the rows of one key apart. Their hash
    is the salt, so a recomputed task puts every row where it was before. Only
    the rows of ``other`` that belong to hot keys are copied. That makes a copy
    without a partner look like a row without one, so joins that keep all rows of
    ``other`` are refused.
    """
    if how not in ("inner", "left", "left_outer", "leftouter", "left_semi", "semi", "left_anti", "anti"):
        raise ValueError("a salted join is inner, left, left_semi or left_anti")
    on = list(on)
    hot = F.broadcast(heavy_keys(big, on, parts, min_rows).withColumn("__hot", F.lit(True)))
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    left = big.join(hot, on, "left").withColumn(
        "__salt", F.when(F.col("__hot"), salt).otherwise(F.lit(0))
    ).drop("__hot")
    right = other.join(hot, on, "left").withColumn(
        "__salt",
        F.explode(
            F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
                F.array(F.lit(0))
            )
        ),
    ).drop("__hot")
    return left.join(right, [*on, "__salt"], how).drop("__salt")
