"""Windows along series: edge rules, and block-wise against plain windows."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import close, rows
from gridpanel.operators import ordered, windows

TINY = {"rows": 20}


@pytest.fixture(scope="module")
def uneven(spark):
    """One key with a third of the rows, many small ones, gaps and equal values."""
    rnd = random.Random(3)
    data, n = [], 0
    for key, size in [("hot", 700), *((f"k{i}", rnd.randint(1, 40)) for i in range(60)), ("void", 30)]:
        for t in sorted(rnd.sample(range(5000), size)):
            v = None if key == "void" or rnd.random() < 0.6 else float(rnd.randint(0, 4))
            data.append((key, t, n, v))
            n += 1
    rnd.shuffle(data)
    return spark.createDataFrame(data, "e string, t int, n int, v double").repartition(8)


def test_lags_in_blocks_equal_plain_lags(uneven):
    plain = windows.add_lags(uneven, "e", "t", ["v", "n"], (1, 2, 3), hot=False)
    blocked = windows.add_lags(uneven, "e", "t", ["v", "n"], (1, 2, 3), **TINY)
    assert rows(plain, "n") == rows(blocked.select(plain.columns), "n")


def test_changes_in_blocks_equal_plain_changes(uneven):
    a = windows.yoy_change(uneven, "e", "t", ["v"], hot=False)
    b = windows.yoy_change(uneven, "e", "t", ["v"], **TINY)
    assert rows(a, "n") == rows(b.select(a.columns), "n")


def test_interpolation_in_blocks_equals_plain(uneven):
    a = windows.interpolate(uneven.drop("n"), "e", "t", ["v"], flag=True, hot=False)
    b = windows.interpolate(uneven.drop("n"), "e", "t", ["v"], flag=True, **TINY)
    left, right = rows(a, "e", "t"), rows(b.select(a.columns), "e", "t")
    assert len(left) == len(right)
    assert all(x[:2] == y[:2] and close(x[2], y[2]) and x[3] == y[3] for x, y in zip(left, right, strict=True))


def test_running_and_ranks_in_blocks(uneven):
    counts = uneven.select("e", "t", F.lit(1).alias("one"), F.coalesce("v", F.lit(9.0)).alias("w"))
    plain = sorted(rows(counts), key=lambda r: (r[0], r[1]))
    expect, low, upto, last = {}, None, 0, None
    for e, t, _, w in plain:
        if e != last:
            low, upto, last = w, 0, e
        low, upto = min(low, w), upto + 1
        expect[e, t] = (upto, low)
    out = ordered.running(counts, ["e"], "t", {"s": ("sum", "one"), "m": ("min", "w")}, **TINY)
    assert {(r["e"], r["t"]): (r["s"], r["m"]) for r in out.collect()} == expect


def test_quantiles_in_blocks(uneven):
    import numpy as np
    out = ordered.exact_quantiles(uneven, ["e"], "t", {"a": 0.1, "m": 0.5, "z": 1.0}, **TINY)
    by = {}
    for e, t, *_ in rows(uneven.select("e", "t")):
        by.setdefault(e, []).append(t)
    for r in out.collect():
        assert r["n_values"] == len(by[r["e"]])
        for name, share in (("a", 0.1), ("m", 0.5), ("z", 1.0)):
            assert close(r[name], float(np.quantile(by[r["e"]], share)))


def test_interpolation_rules(spark):
    gaps = [("a", 1, None), ("a", 2, 1.0), ("a", 3, None), ("a", 4, 2.0), ("a", 5, None), ("b", 1, None), ("b", 2, None)]
    df = spark.createDataFrame(gaps, "e string, t int, v double")
    out = rows(windows.interpolate_edges_zero(df, "e", "t", "v", hot=False), "e", "t")
    # 1.5 rounds to the even 2; leading, trailing and empty series are 0; no flag for an empty series
    assert out == [("a", 1, 0.0, True), ("a", 2, 1.0, False), ("a", 3, 2.0, True), ("a", 4, 2.0, False),
                   ("a", 5, 0.0, True), ("b", 1, 0.0, None), ("b", 2, 0.0, None)]
    plain = windows.interpolate_all(df.withColumnRenamed("v", "rate"), "e", "t", ["rate"], hot=False)
    assert [r[2] for r in rows(plain, "e", "t")][:5] == [0.0, 1.0, 1.5, 2.0, 0.0]


def test_yoy_rules(spark):
    data = [("a", 1, "x", 0.0), ("a", 2, "x", 5.0), ("a", 3, "x", 0.0), ("a", 4, "x", None), ("a", 6, "x", 2.0), ("a", 7, "x", 3.0),
            ("a", 1, "y", 2.0), ("a", 2, "y", 1.0)]
    df = spark.createDataFrame(data, "e string, t int, k string, v double")
    out = rows(windows.yoy_change(df, "e", "t", ["v"], ["k"], hot=False), "k", "t")
    assert [r[-1] for r in out] == [None, 0.0, -1.0, 0.0, None, 0.5, None, -0.5]


def test_event_time(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 3), ("a", 3, 0), ("b", 1, 1)], "e string, t int, v int")
    out = rows(windows.event_time(df, "e", "t", F.col("v") > 2), "e", "t")
    assert [r[3:] for r in out] == [(2, 0, -1), (2, 1, 0), (2, 1, 1), (0, 0, -100)]


def test_no_block_exceeds_the_row_bound(spark):
    from gridpanel.operators.skew import BLOCK, split_long_series
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 300)).alias("e"),
                                    F.lit(7).alias("t"), F.col("id").cast("string").alias("n"))
    cut = split_long_series(df, ["e"], ["t", "n"], rows=1_000)
    sizes = cut.where(F.col(BLOCK) > 0).groupBy("e", BLOCK).agg(F.count(F.lit(1)).alias("n"), F.min("n").alias("a"), F.max("n").alias("b")).orderBy("e", BLOCK).collect()
    assert max(r["n"] for r in sizes) <= 1_000 and sum(r["n"] for r in sizes if r["e"] == "hot") == 18_000
    hot = [r for r in sizes if r["e"] == "hot"]
    assert len(hot) >= 18 and all(x["b"] < y["a"] for x, y in zip(hot, hot[1:]))
    assert cut.where(F.col(BLOCK) == 0).groupBy("e").count().agg(F.max("count")).first()[0] <= 1_000
    assert split_long_series(df, ["e"], "t", rows=50_000).where(F.col(BLOCK) != 0).count() == 0


def test_null_keys_are_cut_too(spark):
    df = spark.range(500).select(F.when(F.col("id") % 3 == 0, F.lit(1)).alias("e"), "id")
    got = windows.add_lags(df, "e", "id", ["id"], (1,), rows=50)
    assert rows(got) == rows(windows.add_lags(df, "e", "id", ["id"], (1,), hot=False))


def test_small_blocks_are_cut_within_few_partitions(spark):
    from gridpanel.operators.skew import BLOCK, split_long_series
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 300)).alias("e"), "id")
    cut = split_long_series(df, ["e"], "id", rows=50)
    assert cut.select(F.spark_partition_id()).distinct().count() <= 8  # bounds are sampled on the driver, per partition
    sizes = cut.where(F.col(BLOCK) > 0).groupBy("e", BLOCK).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).orderBy("e", BLOCK).collect()
    hot = [r for r in sizes if r["e"] == "hot"]
    assert sum(r["n"] for r in hot) == 18_000 and max(r["n"] for r in sizes) <= 50
    assert all(x["b"] < y["a"] for x, y in zip(hot, hot[1:]))


def test_rows_that_come_twice_stay_in_one_block(spark):
    from gridpanel.operators.skew import BLOCK, split_long_series
    df = spark.range(600).select(F.lit("a").alias("e"), (F.col("id") / 3).cast("long").alias("t"), ((F.col("id") / 3).cast("long") * 7 % 11).alias("v"))
    cut = split_long_series(df, ["e"], "t", rows=50)
    assert cut.groupBy("t").agg(F.count_distinct(BLOCK).alias("n")).agg(F.max("n")).first()[0] == 1
    assert cut.agg(F.count_distinct(BLOCK)).first()[0] >= 12
    for lags in ((1,), (1, 3)):
        assert rows(windows.add_lags(df, "e", "t", ["v"], lags, rows=50)) == rows(windows.add_lags(df, "e", "t", ["v"], lags, hot=False))
