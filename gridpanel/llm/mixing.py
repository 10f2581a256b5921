"""Mixing sources to target weights over a tree such as domain, language, source.

Capacities (tokens times the epochs allowed) are summed from the leaves up, and
the budget is shared from the root down: siblings get it in proportion to their
weights, and what one of them cannot take goes to the others, so a shortage
reaches an ancestor's siblings only when its own whole subtree is full. A leaf
then takes all its documents for its full epochs, and of the next epoch the
documents that come first in that epoch's seeded order, up to its tokens.

The order is that of a hash, so a prefix is a threshold on the hash. The threshold
is found from sums per range of hashes and an exact running sum in the one range
that holds it; texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.llm.common import BROADCAST_ROWS
from gridpanel.session import Stored

RANGE_ROWS = 5_000  # documents of a leaf that are put in order in one task
NONE = "(none)"


def word_count(text: str = "text") -> Column:
    """Words, as runs of other characters than space and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shared_out(nodes: DataFrame, parent: Sequence[str], order: str) -> DataFrame:
    """``nodes`` (with weight, capacity and their parent's ``budget``) with ``own``: the tokens each gets, rounded down.

    Sorted by capacity per weight, the nodes that fill up come first: a node is
    full when its capacity is at most its share of what those before it leave.
    """
    by = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), order)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(0, Window.unboundedFollowing)
    rest = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    fits = nodes.where("weight > 0").withColumn("__full", F.col("capacity") / F.col("weight") <= rest / F.sum("weight").over(after))
    level = Window.partitionBy(*parent)
    spare = F.col("budget") - F.sum(F.when(F.col("__full"), F.col("capacity")).otherwise(F.lit(0))).over(level)
    open_weight = F.sum(F.when(F.col("__full"), F.lit(0.0)).otherwise(F.col("weight"))).over(level)
    own = F.when(F.col("__full"), F.col("capacity")).otherwise(F.floor(F.col("weight") * (spare / open_weight)))
    return fits.withColumn("own", own.cast("long")).drop("__full")


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], total: int, epochs: int) -> DataFrame:
    """The tokens of each leaf (one row per leaf, with ``tokens``), as ``budget``.

    ``weights`` maps a level to the weights of its names; unnamed ones weigh 1. A
    weight of 0 leaves a subtree out. One row per node is handled here, not one
    per document.
    """
    weight = {n: F.coalesce(*[F.when(F.col(n) == k, F.lit(float(v))) for k, v in weights.get(n, {}).items()], F.lit(1.0)) for n in levels}
    # What lies below a weight of 0 can take nothing, so its ancestors are not given tokens for it.
    live = F.least(*[weight[n] for n in levels], F.lit(1.0)) > 0
    top = leaves.withColumn("capacity", F.when(live, F.col("tokens") * epochs).otherwise(F.lit(0)))
    parents = None
    for depth, level in enumerate(levels):
        path = list(levels[:depth + 1])
        nodes = top.groupBy(*path).agg(F.sum("capacity").alias("capacity")).withColumn("weight", weight[level])
        if parents is None:
            nodes = nodes.withColumn("budget", F.least(F.lit(total).cast("long"), F.sum(F.when(F.col("weight") > 0, F.col("capacity"))).over(Window.partitionBy(F.lit(0)))))
            shared = shared_out(nodes.withColumn("__root", F.lit(0)), ["__root"], level).drop("__root")
        else:
            shared = shared_out(nodes.join(parents, list(levels[:depth])), list(levels[:depth]), level)
        parents = shared.select(*path, F.col("own").alias("budget"))
    return leaves.join(parents, list(levels))


def order_key(seed: int, epoch: Column, id_col: str) -> Column:
    """A document's place in an epoch's order: md5 of seed, epoch and id; a null id counts as empty."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))


def mix(df: DataFrame, levels: Mapping[str, Column | str], weights: Mapping[str, Mapping[str, float]], total: int | float,
        epochs: int = 2, seed: int = 0, id_col: str = "doc_id", tokens: Column | None = None) -> DataFrame:
    """``df`` with each row repeated for the epochs it is taken in, and epoch (0 on) and tokens.

    ``levels`` names the tree's levels from the root, each with its column or
    expression; null is a branch of its own. ``total`` is the budget in tokens, or
    a share of all tokens if it is a float. Tokens are words unless given. A leaf
    gets at most ``epochs`` times its tokens and never more than its budget; rows
    that share an id are taken together or not at all. Rows without tokens cost
    nothing and come along with the part of the order that is taken. An empty
    table, a budget of 0 or weights of 0 give no rows. Input columns epoch and
    tokens are replaced.
    """
    if epochs < 1:
        raise ValueError("a leaf is read once at least")
    df = df.drop("epoch", "tokens")
    spark = df.sparkSession
    names = [f"__{n}" for n in levels]
    tokens = word_count() if tokens is None else tokens
    paths = {f"__{n}": F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NONE)) for n, c in levels.items()}
    wide = df.withColumns(paths)
    narrow = Stored(wide.select(*names, F.col(id_col).alias("__id"), tokens.alias("tokens")))
    leaves = Stored(narrow.df.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")))
    everything, most = leaves.df.agg(F.sum("tokens"), F.max("rows")).first()
    budget = int(total * (everything or 0)) if isinstance(total, float) else int(total)
    given = budgets(leaves.df, names, {f"__{n}": w for n, w in weights.items()}, budget, epochs)
    given = given.withColumn("full", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0)).cast("long"))
    given = Stored(given.withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")).select(*names, "full", "rest"))
    side = F.broadcast(given.df) if given.df.limit(BROADCAST_ROWS // 10 + 1).count() <= BROADCAST_ROWS // 10 else given.df
    digits = 1
    while (most or 0) > RANGE_ROWS * 16 ** digits:
        digits += 1
    open_rows = narrow.df.join(side, names).where("rest > 0").withColumn("key", order_key(seed, F.col("full"), "__id"))
    open_rows = open_rows.withColumn("range", F.substring("key", 1, digits))
    ranges = open_rows.groupBy(*names, "range").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    running = Window.partitionBy(*names).orderBy("range")
    ranges = ranges.withColumn("through", F.sum("tokens").over(running.rowsBetween(Window.unboundedPreceding, 0)))
    ranges = Stored(ranges.withColumn("first_over", F.coalesce(F.lag(F.col("through") <= F.col("rest")).over(running), F.lit(True)) & (F.col("through") > F.col("rest"))))
    whole = ranges.df.where("through <= rest").groupBy(*names).agg(F.max("range").alias("last"))
    over = ranges.df.where("first_over").select(*names, "range", (F.col("through") - F.col("tokens")).alias("before"))
    exact = open_rows.join(over, [*names, "range"])
    peers = Window.partitionBy(*names).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    exact = exact.withColumn("sum", F.col("before") + F.sum("tokens").over(peers)).where("sum <= rest")
    exact = exact.groupBy(*names).agg(F.max("key").alias("cut"))
    # All of a range whose first digits are ``last`` lies below ``last`` followed by the digit after f.
    limits = given.df.join(whole, names, "left").join(exact, names, "left")
    cut = F.coalesce("cut", F.concat("last", F.lit("g")), F.lit(""))
    limits = Stored(limits.select(*names, F.col("full").alias("__full"), cut.alias("__cut")).where("__full > 0 OR __cut <> ''"))
    few = limits.df.limit(BROADCAST_ROWS // 10 + 1).count() <= BROADCAST_ROWS // 10
    taken = wide.join(F.broadcast(limits.df) if few else limits.df, names)
    part = (order_key(seed, F.col("__full"), id_col) <= F.col("__cut")).cast("long")
    taken = taken.withColumn("__epochs", F.col("__full") + part).where("__epochs > 0")
    taken = taken.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__epochs") - 1)))
    return taken.select(*df.columns, "epoch", tokens.alias("tokens"))
