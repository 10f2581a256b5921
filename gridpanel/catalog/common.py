"""Registry of queries with their SQL counterparts, and the stand-in panels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.functions.expressions import as_column
from gridpanel.operators.neighbors import knn_edges

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under a name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return add


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rnd(c: Column | str, digits: int = 6) -> Column:
    """Round half up with the same arithmetic as the SQL counterpart."""
    scale = float(10**digits)
    return F.floor(as_column(c) * scale + 0.5) / F.lit(scale)


def sql_rnd(text: str, digits: int = 6) -> str:
    return f"(floor(({text}) * 1e{digits} + 0.5) / 1e{digits})"


# Money is summed as whole cents held in doubles, which is exact in any order.


def supplier_panel(spark: SparkSession, d: str, *extra: str) -> DataFrame:
    """Suppliers by year: dense, one row per (e, t) and extra key."""
    li = load(spark, d, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("e"), F.year("l_shipdate").alias("t"), *extra).agg(
        F.sum("l_quantity").alias("qty"), F.sum(F.round(F.col("l_extendedprice") * 100)).alias("cents"),
        F.count(F.lit(1)).alias("n"),
    )


def customer_panel(spark: SparkSession, d: str) -> DataFrame:
    """Customers by year: sparse, many customers lack some years."""
    o = load(spark, d, "orders")
    return o.groupBy(F.col("o_custkey").alias("e"), F.year("o_orderdate").alias("t")).agg(
        F.sum(F.round(F.col("o_totalprice") * 100)).alias("cents"), F.count(F.lit(1)).alias("n_orders_count"),
    )


def supplier_points(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return load(spark, d, "supplier").select(
        k.alias("e"), (25 + (k * 37 % 2400) / F.lit(100.0)).alias("lat"),
        (-125 + (k * 91 % 5900) / F.lit(100.0)).alias("lon"), "s_acctbal",
    )


def customer_points(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return load(spark, d, "customer").select(
        k.alias("c"), (25 + (k * 53 % 2400) / F.lit(100.0)).alias("lat"),
        (-125 + (k * 17 % 5900) / F.lit(100.0)).alias("lon"),
    )


def supplier_edges(spark: SparkSession, d: str, k: int = 5) -> DataFrame:
    return knn_edges(supplier_points(spark, d), "e", k)


SUPPLIER_PANEL = """panel AS (
  SELECT l_suppkey AS e, year(l_shipdate) AS t, sum(l_quantity) AS qty,
         sum(round(l_extendedprice * 100)) AS cents, count(*) AS n
  FROM lineitem GROUP BY 1, 2)"""

CUSTOMER_PANEL = """cpanel AS (
  SELECT o_custkey AS e, year(o_orderdate) AS t, sum(round(o_totalprice * 100)) AS cents,
         count(*) AS n_orders_count
  FROM orders GROUP BY 1, 2)"""

POINTS = """pts AS (
  SELECT s_suppkey AS e, 25 + (s_suppkey * 37 % 2400) / 1e2 AS lat,
         -125 + (s_suppkey * 91 % 5900) / 1e2 AS lon, s_acctbal
  FROM supplier)"""

CUSTOMER_POINTS = """cpts AS (
  SELECT c_custkey AS c, 25 + (c_custkey * 53 % 2400) / 1e2 AS lat,
         -125 + (c_custkey * 17 % 5900) / 1e2 AS lon
  FROM customer)"""


def sql_miles(a: str, b: str) -> str:
    return f"""(2 * 6371.0088::DOUBLE * 0.621371192::DOUBLE * asin(sqrt(least(1.0,
      pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2)
      + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2)))))"""


def sql_edges(k: int) -> str:
    return f"""{POINTS},
pairs AS (SELECT a.e, b.e AS neighbor, {sql_miles('a', 'b')} AS distance
          FROM pts a JOIN pts b ON a.e <> b.e),
edges AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY round(distance, 9), neighbor) AS rank
          FROM pairs QUALIFY rank <= {k})"""
