"""What several corpus operators share: registry, whole-table reads, components of a graph, size-checked joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.session import Stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BROADCAST_ROWS = 500_000  # most rows of one number each that are broadcast


def query(name: str, oracle: str | None = None):
    """Register a query under a name, with the SQL that gives the same rows where there is one."""

    def add(f):
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return add


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tasks(spark: SparkSession, rows: int, per_task: int) -> int:
    """How many tasks keep each below about ``per_task`` rows, at least Spark's own setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def only_ids(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is among ``ids``, a stored frame of one column without repeats.

    Few ids are broadcast, so that long rows need not be shuffled; beyond
    BROADCAST_ROWS the join is left to Spark.
    """
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(ids) if few else ids, df[key] == ids[ids.columns[0]], "left_semi")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b) edges; two nodes share a root when a path joins them.

    Each round hooks every node to its smallest neighbour, follows these pointers
    to their ends, and keeps only the edges that still lead from one tree to
    another, so the edges shrink fast and a chain takes a logarithm of rounds. No
    task gathers the neighbours of a node: hooking is a minimum with map-side
    combine, and the lookups are joins with a table of one row per node, whose
    hot keys adaptive execution splits. Nulls and loops link nothing.
    """
    ab = edges.toDF("a", "b").where("a <> b")
    current = Stored(ab.unionByName(ab.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    total: Stored | None = None
    while True:
        hooks = Stored(current.df.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")))
        while True:
            ends = hooks.df.select(F.col("node").alias("root"), F.col("root").alias("end"))
            flat = Stored(hooks.df.join(ends, "root").select("node", F.col("end").alias("root"), (F.col("end") != F.col("root")).alias("moved")))
            moved = flat.df.where("moved").limit(1).count()
            hooks.drop()
            hooks = flat
            if not moved:
                break
        trees = hooks.df.select("node", "root")
        if total is None:
            joined = trees
        else:
            ends = trees.select(F.col("node").alias("root"), F.col("root").alias("end"))
            joined = total.df.join(ends, "root", "left").select("node", F.coalesce("end", "root").alias("root"))
        after = Stored(joined)
        if total is not None:
            total.drop()
        total = after
        left = trees.select(F.col("node").alias("a"), F.col("root").alias("x"))
        right = trees.select(F.col("node").alias("b"), F.col("root").alias("y"))
        rest = Stored(current.df.join(left, "a").join(right, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        hooks.drop()
        current.drop()
        current = rest
        if not current.df.limit(1).count():
            current.drop()
            return total.df
