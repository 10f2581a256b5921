"""Fitted models, splits and files whose outcome SQL knows: closed forms, planted groups, separable labels, sure bounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridpanel.catalog.common import SUPPLIER_PANEL, customer_panel, load, query, rnd, sql_rnd
from gridpanel.catalog.models import _reg
from gridpanel.functions.expressions import normal_tail
from gridpanel.operators import classify, cluster, features, regression
from gridpanel.sources import writers


@query("s9_archive_ledger", """
SELECT 'customer' AS file, count(*) > 0 AS has_raw, count(*) > 0 AS has_archive, true AS consistent FROM customer
UNION ALL SELECT 'part', count(*) > 0, count(*) > 0, true FROM part""")
def s9_ledger(spark, d):
    folder = writers.scratch_folder(spark)
    load(spark, d, "customer").write.option("header", True).csv(folder + "/customer")
    load(spark, d, "part").select("p_name").write.text(folder + "/part")
    out = writers.archive(spark, [("customer", folder + "/customer", ","), ("part", folder + "/part", "lines"),
                                  ("skipped", folder + "/missing", ",")], folder + "/out", skip=["skipped"])
    saved = (F.col("orig_bytes") - F.col("pq_bytes")) * 100.0 / F.col("orig_bytes")
    return out.select("file", (F.col("orig_bytes") > 0).alias("has_raw"), (F.col("pq_bytes") > 0).alias("has_archive"),
                      (F.abs(F.col("saved_pct") - saved) < 1e-9).alias("consistent"))


@query("f10_quantile_shares", f"""
WITH r AS (SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2 AS r, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, {sql_rnd('(r - 1) / (n - 1)', 4)} AS share FROM r""")
def f10_shares(spark, d):
    out = features.quantile_normalize(load(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "z", points=None)
    return out.select("o_orderkey", rnd(1 - normal_tail("z"), 4).alias("share"))


_GRID = 200


@query("f10_quantile_grid", f"""
WITH k AS (SELECT i, i / {_GRID - 1}.0 AS s FROM range({_GRID}) r(i)),
o AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) * CASE WHEN l_orderkey % 3 = 0 THEN l_extendedprice ELSE 1 END AS v FROM lineitem),
q AS (SELECT unnest(quantile_cont(v, [{', '.join(f'{i}/{_GRID - 1}.0' for i in range(_GRID))}])) AS g, unnest(range({_GRID})) AS i FROM o),
f AS (SELECT g, min(i) AS first_i, max(i) AS last_i FROM q GROUP BY g),
n AS (SELECT g, first_i, last_i, lead(g) OVER w AS next_g, lead(first_i) OVER w AS next_i FROM f WINDOW w AS (ORDER BY g)),
p AS (SELECT l_orderkey, l_linenumber, CASE WHEN next_g IS NULL THEN {_GRID - 1} WHEN v = (SELECT min(g) FROM f) THEN 0
  WHEN v = g THEN (first_i + last_i) / 2 ELSE last_i + (v - g) / (next_g - g) * (next_i - last_i) END / {_GRID - 1}.0 AS share
  FROM o ASOF JOIN n ON o.v >= n.g)
SELECT l_orderkey, l_linenumber, {sql_rnd('least(greatest(share, 1e-7), 1 - 1e-7) + 1e-8', 5)} AS share FROM p""")
def f10_grid(spark, d):
    v = F.col("l_quantity").cast("double") * F.when(F.col("l_orderkey") % 3 == 0, F.col("l_extendedprice")).otherwise(1.0)
    df = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", v.alias("v"))
    out = features.quantile_normalize(df, "v", "z", points=_GRID)
    above = normal_tail(F.abs("z"))
    below = F.when(F.col("z") >= 0, 1 - above).otherwise(above)
    return out.select("l_orderkey", "l_linenumber", rnd(below + 1e-8, 5).alias("share"))


@query("f11_power_moments", """
SELECT count(*) AS n, 0.0 AS mean_acctbal, 1.0 AS sd_acctbal, 0.0 AS mean_x, 1.0 AS sd_x, true AS rising FROM customer""")
def f11_moments(spark, d):
    df = load(spark, d, "customer").select("c_custkey", "c_acctbal", F.pow(F.col("c_nationkey").cast("double"), F.lit(2.0)).alias("x"))
    out = features.power_transform(df, ["c_acctbal", "x"]).withColumnsRenamed({"c_acctbal": "a", "x": "b"}).join(df, "c_custkey")
    least = F.min(F.struct("c_acctbal", "a")), F.max(F.struct("c_acctbal", "a"))
    return out.agg(
        F.count(F.lit(1)).alias("n"), F.abs(F.round(F.avg("a"), 6)).alias("mean_acctbal"), F.round(F.stddev_pop("a"), 6).alias("sd_acctbal"),
        F.abs(F.round(F.avg("b"), 6)).alias("mean_x"), F.round(F.stddev_pop("b"), 6).alias("sd_x"),
        ((least[0]["a"] == F.min("a")) & (least[1]["a"] == F.max("a"))).alias("rising"))


@query("f16_split_shares", "SELECT count(*) AS n, true AS near_share, true AS repeats FROM orders")
def f16_shares(spark, d):
    once = features.split_random(load(spark, d, "orders"), ["o_orderkey"], 0.2)
    twice = features.split_random(once.repartition("o_orderkey"), ["o_orderkey"], 0.2, out="again")
    # Six standard errors of a share of 0.2.
    return twice.agg(F.count(F.lit(1)).alias("n"), (F.abs(F.avg(F.col("is_test").cast("int")) - 0.2) < 2.4 / F.sqrt(F.count(F.lit(1)))).alias("near_share"),
                     F.bool_and(F.col("is_test") == F.col("again")).alias("repeats"))


@query("f16_split_parts", """
WITH p AS (SELECT o_custkey AS e, year(o_orderdate) AS t FROM orders GROUP BY 1, 2)
SELECT count(*) AS n, 0 AS in_both, 0 AS late_train, 0 AS early_test FROM p""")
def f16_parts(spark, d):
    out = features.split_group_and_time(customer_panel(spark, d), "e", "t", 0.2, 1999)
    per = out.groupBy("e").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("part") == p).alias(p) for p in ("train", "test")],
                               F.count_if((F.col("part") == "train") & (F.col("t") > 1999)).alias("late"),
                               F.count_if((F.col("part") == "test") & (F.col("t") <= 1999)).alias("early"))
    return per.agg(F.sum("n").alias("n"), F.count_if((F.col("train") > 0) & (F.col("test") > 0)).alias("in_both"),
                   F.sum("late").alias("late_train"), F.sum("early").alias("early_test"))


def _fit_sql(name: str, x: str) -> str:
    return f"SELECT '{name}' AS model, regr_syy(qty, {x}) * (1 - regr_r2(qty, {x})) AS rss, regr_syy(qty, {x}) AS tss, count(*) AS n, 2 AS k FROM panel"


@query("m7_compare_closed", f"""
WITH {SUPPLIER_PANEL}, w AS (SELECT t, n - avg(n) OVER (PARTITION BY t) AS x, qty - avg(qty) OVER (PARTITION BY t) AS y, qty - avg(qty) OVER () AS z FROM panel),
f AS ({_fit_sql('lines', 'n')} UNION ALL {_fit_sql('trend', '(t - 1995)')}
  UNION ALL SELECT 'years', sum(y * y) - pow(sum(x * y), 2) / sum(x * x), sum(z * z), count(*), count(DISTINCT t) + 1 FROM w),
l AS (SELECT *, -n / 2.0 * (ln(2 * pi()) + ln(rss / n) + 1) AS loglik FROM f)
SELECT model, {sql_rnd('1 - rss / tss')} AS r2, {sql_rnd('1 - rss / tss * (n - 1) / (n - k)')} AS adj_r2, {sql_rnd('2 * k - 2 * loglik', 3)} AS aic,
  {sql_rnd('ln(n) * k - 2 * loglik', 3)} AS bic, n AS nobs FROM l""")
def m7_closed(spark, d):
    df = _reg(spark, d)
    out = regression.compare_models(spark, {
        "lines": regression.ols(df, "qty", ["lines"]), "trend": regression.ols(df, "qty", ["trend"]), "years": regression.ols(df, "qty", ["lines"], "t")})
    return out.select("model", rnd("r2").alias("r2"), rnd("adj_r2").alias("adj_r2"), rnd("aic", 3).alias("aic"), rnd("bic", 3).alias("bic"), "nobs")


@query("m11_logistic_closed", f"""
WITH c AS (SELECT count(*) FILTER (WHERE y AND x)::DOUBLE AS a, count(*) FILTER (WHERE NOT y AND x)::DOUBLE AS b, count(*) FILTER (WHERE y AND NOT x)::DOUBLE AS c,
  count(*) FILTER (WHERE NOT y AND NOT x)::DOUBLE AS d FROM (SELECT l_returnflag = 'R' AS y, l_linenumber >= 4 AS x FROM lineitem))
SELECT 'Intercept' AS term, {sql_rnd('ln(c / d)', 3)} AS coef FROM c UNION ALL SELECT 'late', {sql_rnd('ln(a / b) - ln(c / d)', 3)} FROM c""")
def m11_closed(spark, d):
    df = load(spark, d, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_linenumber") >= 4).cast("double").alias("late"))
    _, coefs = classify.logistic(df, "y", ["late"], balanced=False, c=1e9)
    return coefs.select("term", rnd("coef", 3).alias("coef"))


_X = ["l_linenumber", "l_quantity", "l_discount"]
_SEPARATED = """SELECT count(*) FILTER (WHERE l_linenumber >= 4) AS tp, 0 AS fp, count(*) FILTER (WHERE l_linenumber < 4) AS tn, 0 AS fn,
  1.0 AS accuracy, 1.0 AS true_positive_rate FROM lineitem"""


def _separable(spark, d):
    return load(spark, d, "lineitem").select(*_X, (F.col("l_linenumber") >= 4).cast("int").alias("y"))


@query("m13_forest_separable", _SEPARATED)
def m13_separable(spark, d):
    df = _separable(spark, d)
    return classify.classification_report(classify.predict(classify.random_forest(df, "y", _X), df, _X), "y", "predicted")


@query("m14_forest_separable", _SEPARATED)
def m14_separable(spark, d):
    df = _separable(spark, d)
    return classify.classification_report(classify.predict(classify.balanced_forest(df, "y", _X), df, _X), "y", "predicted")


@query("m15_importance_known", "SELECT 3 AS features, 1.0 AS total, 'l_linenumber' AS first_feature FROM lineitem LIMIT 1")
def m15_known(spark, d):
    out = classify.feature_importance(spark, classify.random_forest(_separable(spark, d), "y", _X), _X)
    return out.agg(F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 6).alias("total"), F.max_by("feature", "importance").alias("first_feature"))


@query("m18_pca_closed", f"""
WITH c AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem),
v AS (SELECT 1 AS component, 1 + r AS variance FROM c UNION ALL SELECT 2, 1 - r FROM c)
SELECT component, f AS feature, {sql_rnd('variance', 5)} AS variance, {sql_rnd('sqrt(variance / 2)', 5)} AS size FROM v, (VALUES ('l_quantity'), ('l_extendedprice')) x(f)""")
def m18_closed(spark, d):
    names = ["l_quantity", "l_extendedprice"]
    df = cluster.scaled_vector(load(spark, d, "lineitem").select(*names), names)
    fitted = cluster.pca(df, k=2)
    spread = fitted.scores(df).agg(F.variance("pc1").alias("v1"), F.variance("pc2").alias("v2"))
    spread = spread.select(F.inline(F.array(*[F.struct(F.lit(i).alias("component"), F.col(f"v{i}").alias("variance")) for i in (1, 2)])))
    return fitted.loadings(spark, names).join(spread, "component").select(
        "component", "feature", rnd("variance", 5).alias("variance"), rnd(F.abs("loading"), 5).alias("size"))


def _planted(spark, d):
    """Three groups far apart: the rest of the nation's key by three."""
    group = F.col("c_nationkey") % 3
    df = load(spark, d, "customer").select("c_custkey", group.alias("g"), (group * 1000 + F.col("c_acctbal") / 1e4).alias("a"), (F.pow(group, F.lit(2)) * 700 + F.col("c_custkey") % 10).alias("b"))
    return cluster.scaled_vector(df, ["a", "b"])


@query("m19_kmeans_planted", "SELECT c_nationkey % 3 AS g, 1 AS clusters, count(*) AS n, 1 AS groups FROM customer GROUP BY 1")
def m19_planted(spark, d):
    df = _planted(spark, d)
    labelled = cluster.cluster_labels(cluster.kmeans(df, 3), df)
    whose = labelled.groupBy("cluster").agg(F.count_distinct("g").alias("groups"))
    return labelled.join(whose, "cluster").groupBy("g").agg(F.count_distinct("cluster").alias("clusters"), F.count(F.lit(1)).alias("n"), F.max("groups").alias("groups"))


@query("m19_entity_cluster", "SELECT c_nationkey AS e, dense_rank() OVER (ORDER BY c_nationkey % 3) - 1 AS cluster FROM (SELECT DISTINCT c_nationkey FROM customer)")
def m19_entity(spark, d):
    df = _planted(spark, d).join(load(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("e")), "c_custkey")
    return cluster.entity_cluster(cluster.cluster_labels(cluster.kmeans(df, 3), df), "e").select("e", "cluster")


@query("m20_silhouette_planted", "SELECT 3 AS best FROM customer LIMIT 1")
def m20_planted(spark, d):
    return cluster.silhouette_sweep(_planted(spark, d), range(2, 50), restarts=10).agg(F.max_by("k", "train_silhouette").alias("best"))


@query("m22_pc_regression_closed", f"""
WITH c AS (SELECT corr(l_extendedprice, l_quantity) AS a, corr(l_extendedprice, l_discount) AS b, corr(l_quantity, l_discount) AS r, var_pop(l_extendedprice) AS v FROM lineitem),
s AS (SELECT (a * a + b * b - 2 * a * b * r) / (1 - r * r) AS r2, v FROM c)
SELECT p AS part, {sql_rnd('r2', 5)} AS r2, {sql_rnd('sqrt(v * (1 - r2))', 3)} AS rmse FROM s, (VALUES ('train'), ('test')) x(p)""")
def m22_closed(spark, d):
    df = cluster.scaled_vector(load(spark, d, "lineitem").select("l_quantity", "l_discount", "l_extendedprice"), ["l_quantity", "l_discount"])
    scored = cluster.pca(df, k=2).scores(df)
    _, out = cluster.pc_regression(scored, scored, "l_extendedprice")
    return out.select("part", rnd("r2", 5).alias("r2"), rnd("rmse", 3).alias("rmse"))
