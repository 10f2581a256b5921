"""Queries for profiling, features, statistics and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridpanel.catalog.common import CUSTOMER_PANEL, SUPPLIER_PANEL, customer_panel, load, query, rnd, sql_rnd, supplier_panel
from gridpanel.functions.expressions import normal_tail, ratio
from gridpanel.operators import classify, cluster, did, features, regression, windows
from gridpanel.operators.ordered import exact_quantiles
from gridpanel.session import checkpointed

HOT = {"rows": 500}
COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _zero(text: str) -> str:
    """Without a negative zero."""
    return f"(CASE WHEN {text} = 0 THEN 0.0 ELSE {text} END)"


def _union(rows) -> str:
    return "\nUNION ALL ".join(rows)


# --- profiling and features -------------------------------------------------------


def _profile_sql(c: str) -> str:
    x = f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) / count(*) AS missing_share,
  {_zero(f'round_even(stddev_samp({c}), 3)')} AS std, {_zero(f'round_even(skewness({c}), 3)')} AS skew,
  count(*) FILTER (WHERE {c} = 0) AS n_zeros, round_even(count(*) FILTER (WHERE {c} = 0) / count(*), 3) AS zero_share,
  round_even(min({c}), 3) AS min, round_even(max({c}), 3) AS max, count(DISTINCT {c}) AS n_unique FROM src"""
    return f"""SELECT *, min > 0 AS can_log, CASE WHEN min > 0 AND skew > 0.3 THEN 'log'
  WHEN NOT min > 0 AND zero_share > 0 AND skew > 0.3 THEN 'log1p' ELSE 'none' END AS suggested_transform FROM ({x})"""


_SRC = """src AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
  CAST(o_orderkey % 7 AS DOUBLE) * CAST(o_orderkey % 3 AS DOUBLE) AS z, pow(1 + o_custkey % 50, 2) AS p FROM orders)"""


def _src(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return load(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", F.when(c % 4 != 0, c).alias("o_custkey"),
        ((k % 7).cast("double") * (k % 3).cast("double")).alias("z"),
        F.pow((1 + c % 50).cast("double"), F.lit(2.0)).alias("p"))


_SRC_COLS = ["o_totalprice", "o_custkey", "z", "p"]


@query("f1_profile", f"WITH {_SRC} " + _union(_profile_sql(c) for c in _SRC_COLS))
def f1(spark, d):
    return features.profile(_src(spark, d), _SRC_COLS, acceptable_skew=0.3)


@query("f2_apply_transforms", f"""
WITH {_SRC} SELECT o_orderkey, o_totalprice, o_custkey, {sql_rnd('ln(1 + z)')} AS z_log1p, {sql_rnd('ln(p)')} AS p_log FROM src""")
def f2(spark, d):
    df = _src(spark, d)
    out = features.apply_transforms(df, features.profile(df, _SRC_COLS, acceptable_skew=0.3))
    return out.withColumns({"z_log1p": rnd("z_log1p"), "p_log": rnd("p_log")})


_F3_COLS = ["o_orderkey", "o_totalprice", "z", "p", "near"]


def _det(names) -> str:
    """Determinant of the matrix of uncentred cosines of some columns, expanded along the first row."""
    def minor(rows, cols):
        if not rows:
            return "1.0"
        signed = (f"{'-' if i % 2 else '+'} c_{min(rows[0], c)}_{max(rows[0], c)} * ({minor(rows[1:], [d for d in cols if d != c])})"
                  for i, c in enumerate(cols))
        return " ".join(signed)
    names = list(names)
    return f"({minor(names, names)})"


def _normal_sql(table: str, c: str) -> str:
    """Skew and p of the normality test of a column as a one-row table."""
    return f"""SELECT g1, exp(-0.5 * (za * za + pow((1 - 2/(9*a) - cbrt((1 - 2/a) / (1 + x * sqrt(2/(a-4))))) / sqrt(2/(9*a)), 2))) AS p FROM (
SELECT *, 6 + 8/s * (2/s + sqrt(1 + 4/(s*s))) AS a FROM (
SELECT *, asinh(y / sqrt(2/(w2-1))) / sqrt(0.5*ln(w2)) AS za, (b2 - 3*(n-1)/(n+1)) / sqrt(24*n*(n-2)*(n-3)/((n+1)*(n+1)*(n+3)*(n+5))) AS x,
  6*(n*n-5*n+2)/((n+7)*(n+9))*sqrt(6*(n+3)*(n+5)/(n*(n-2)*(n-3))) AS s FROM (
SELECT *, g1 * sqrt((n+1)*(n+3)/(6*(n-2))) AS y, sqrt(2*(3*(n*n+27*n-70)*(n+1)*(n+3)/((n-2)*(n+5)*(n+7)*(n+9)) - 1)) - 1 AS w2 FROM (
SELECT n, m3 / pow(m2, 1.5) AS g1, m4 / (m2 * m2) AS b2 FROM (
SELECT count(*)::DOUBLE AS n, avg(pow({c} - m, 2)) AS m2, avg(pow({c} - m, 3)) AS m3, avg(pow({c} - m, 4)) AS m4
FROM {table}, (SELECT avg({c}) AS m FROM {table}))))))"""


@query("f3_select_columns", f"""
WITH {_SRC}, w AS (SELECT *, o_totalprice + (o_orderkey % 100) * 100.0 AS near FROM src),
g AS (SELECT {", ".join(f"(sum({a}::DOUBLE * {b}) / sqrt(sum({a}::DOUBLE * {a}) * sum({b}::DOUBLE * {b}))) AS c_{i}_{j}"
                        for i, a in enumerate(_F3_COLS) for j, b in enumerate(_F3_COLS) if i <= j)} FROM w),
s AS ({_union(f"SELECT '{c}' AS kept, min({c}) AS lo, max({c}) AS hi, avg({c}) AS m, stddev_samp({c}) AS sd, "
              f"(SELECT {_det(k for k in range(5) if k != j)} / {_det(range(5))} FROM g) AS vif, "
              f"(SELECT p > 0.05 OR abs(g1) < 1 FROM ({_normal_sql('w', c)})) AS normal FROM w" for j, c in enumerate(_F3_COLS))})
SELECT kept FROM s WHERE vif < 5 AND lo > m - 3 * sd AND hi < m + 3 * sd AND normal""")
def f3(spark, d):
    df = _src(spark, d).withColumn("near", F.col("o_totalprice") + (F.col("o_orderkey") % 100) * 100.0)
    kept, _ = features.select_columns(df, no_na=True, vif_cut=5.0, sd_cut=3.0, only_normal=True)
    return spark.createDataFrame([(k,) for k in kept], "kept string")


@query("f4_corr_matrix", f"WITH {_SRC} " + _union(
    f"SELECT '{a}' AS a, '{b}' AS b, {sql_rnd(f'corr({a}, {b})')} AS corr FROM src" for a in _SRC_COLS for b in _SRC_COLS))
def f4(spark, d):
    return features.corr_matrix(_src(spark, d), _SRC_COLS).withColumn("corr", rnd("corr"))


def _describe_sql(c: str) -> str:
    r = lambda x: _zero(f"round_even({x}, 2)")
    return f"""SELECT l_returnflag, '{c}' AS "column", count({c}) AS count, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std,
  {r(f'min({c})')} AS min, {r(f'max({c})')} AS max, 0 AS missing, 0.0::DOUBLE AS missing_share,
  {r(f'quantile_cont({c}, 0.25)')} AS p25, {r(f'quantile_cont({c}, 0.5)')} AS p50, {r(f'quantile_cont({c}, 0.75)')} AS p75
  FROM lineitem GROUP BY 1"""


@query("f5_describe", _union(_describe_sql(c) for c in ["l_quantity", "l_linenumber"]))
def f5(spark, d):
    return features.describe(load(spark, d, "lineitem"), ["l_quantity", "l_linenumber"], ["l_returnflag"])


@query("f5_quantiles_hot", """
SELECT o_orderstatus, count(*) AS n_values, floor(quantile_cont(o_totalprice, 0.1) * 100 + 0.5) / 100 AS p10,
  floor(quantile_cont(o_totalprice, 0.5) * 100 + 0.5) / 100 AS p50 FROM orders GROUP BY 1""")
def f5_hot(spark, d):
    out = exact_quantiles(load(spark, d, "orders"), ["o_orderstatus"], "o_totalprice", {"p10": 0.1, "p50": 0.5}, **HOT)
    return out.withColumns({"p10": rnd("p10", 2), "p50": rnd("p50", 2)})


@query("f6_normality", """
WITH s AS (""" + _union(f"""SELECT '{c}' AS "column", count({c})::DOUBLE AS n, avg({c}) AS m FROM lineitem""" for c in COLS[:2]) + """),
c AS (""" + _union(f"""SELECT '{c}' AS "column", avg(pow({c} - m, 2)) AS m2, avg(pow({c} - m, 3)) AS m3, avg(pow({c} - m, 4)) AS m4
  FROM lineitem, s WHERE s."column" = '{c}' """ for c in COLS[:2]) + """),
g AS (SELECT "column", n, m3 / pow(m2, 1.5) AS g1, m4 / (m2 * m2) AS b2 FROM s JOIN c USING ("column")),
z1 AS (SELECT *, g1 * sqrt((n+1)*(n+3)/(6*(n-2))) AS y, sqrt(2*(3*(n*n+27*n-70)*(n+1)*(n+3)/((n-2)*(n+5)*(n+7)*(n+9)) - 1)) - 1 AS w2 FROM g),
z2 AS (SELECT *, asinh(y / sqrt(2/(w2-1))) / sqrt(0.5*ln(w2)) AS za,
  (b2 - 3*(n-1)/(n+1)) / sqrt(24*n*(n-2)*(n-3)/((n+1)*(n+1)*(n+3)*(n+5))) AS x,
  6*(n*n-5*n+2)/((n+7)*(n+9))*sqrt(6*(n+3)*(n+5)/(n*(n-2)*(n-3))) AS s FROM z1),
z3 AS (SELECT *, 6 + 8/s*(2/s + sqrt(1 + 4/(s*s))) AS a FROM z2),
z4 AS (SELECT *, (1 - 2/(9*a) - cbrt((1 - 2/a)/(1 + x*sqrt(2/(a-4))))) / sqrt(2/(9*a)) AS zb FROM z3)
SELECT "column", n::BIGINT AS n, """ + sql_rnd("za*za + zb*zb", 3) + " AS k2, " + sql_rnd("exp(-(za*za + zb*zb)/2)") + " AS p_value FROM z4")
def f6(spark, d):
    out = features.normality(load(spark, d, "lineitem"), COLS[:2])
    return out.select("column", "n", rnd("k2", 3).alias("k2"), rnd("p_value").alias("p_value"))


@query("f7_histogram", """
WITH r AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
SELECT CAST(least(floor((l_quantity - lo) * 12 / (hi - lo)), 11) AS INTEGER) AS bin, count(*) AS n FROM lineitem, r GROUP BY 1""")
def f7(spark, d):
    return features.histogram(load(spark, d, "lineitem"), "l_quantity", 12).select("bin", "n")


@query("f8_qq_points", f"""
WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS m, stddev_pop(l_quantity) AS sd FROM lineitem),
v AS (SELECT l_quantity AS value, count(*) AS n FROM lineitem GROUP BY 1),
r AS (SELECT value, n, sum(n) OVER (ORDER BY value) - n + (n + 1) / 2 AS place FROM v)
SELECT value, r.n, {sql_rnd('(value - m) / sd')} AS sample, {sql_rnd('(place - 0.5) / s.n + 1e-8')} AS share_below FROM r, s""")
def f8(spark, d):
    out = features.qq_points(load(spark, d, "lineitem"), "l_quantity")
    # The quantile is compared through the share of a normal distribution below it, off the halves that shares of many rows fall on.
    above = normal_tail(F.abs("theoretical"))
    below = F.when(F.col("theoretical") >= 0, 1 - above).otherwise(above)
    return out.select("value", "n", rnd("sample").alias("sample"), rnd(below + 1e-8).alias("share_below"))


@query("f9_standardize", f"""
WITH s AS (SELECT avg(o_custkey) AS m, stddev_pop(o_custkey) AS sd FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey, {sql_rnd('(o_custkey - m) / sd')} AS o_custkey FROM orders, s""")
def f9(spark, d):
    df = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    out = features.standardize(df, ["o_custkey"], df.where("o_orderstatus = 'F'"))
    return out.select("o_orderkey", rnd("o_custkey").alias("o_custkey"))


@query("f10_quantile_normalize")
def f10(spark, d):
    df = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return features.quantile_normalize(df, "o_totalprice", "z")


@query("f11_power_transform")
def f11(spark, d):
    df = load(spark, d, "customer").select("c_custkey", "c_acctbal", F.pow(F.col("c_nationkey").cast("double"), F.lit(2.0)).alias("x"))
    return features.power_transform(df, ["c_acctbal", "x"], df.where("c_custkey % 3 <> 0"))


@query("f12_log_cols", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {sql_rnd('ln(CASE WHEN l_discount = 0 THEN 1e-9 ELSE l_discount END)')} AS l_discount_logged FROM lineitem""")
def f12(spark, d):
    df = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount")
    return features.log_cols(df, ["l_discount"]).withColumn("l_discount_logged", rnd("l_discount_logged"))


@query("f13_drop_by_profile", f"WITH {_SRC} SELECT o_orderkey, o_totalprice, p FROM src")
def f13(spark, d):
    df = _src(spark, d)
    return features.drop_by_profile(df, features.profile(df, _SRC_COLS), max_skew=0.3, protect=["p"])


def _docs(spark, d):
    """Labelled documents with counts of their whole text as features.

    The texts are read once; resampling and fitting pass over the counts often.
    """
    text = F.col("text")
    return checkpointed(load(spark, d, "documents").join(load(spark, d, "labels"), "doc_id").select(
        "doc_id", "quality", F.col("n_chars").cast("double").alias("chars"),
        F.size(F.split(text, r"\s+")).cast("double").alias("words"),
        F.size(F.split(text, "\n")).cast("double").alias("lines"),
        F.length(F.regexp_replace(text, "[^0-9]", "")).cast("double").alias("digits")))


_DOC_FEATURES = ["chars", "words", "lines", "digits"]


@query("f14_smote", """
SELECT quality, count(*) FILTER (WHERE r) AS n_real, max(count(*) FILTER (WHERE r)) OVER () - count(*) FILTER (WHERE r) AS n_synthetic
FROM (SELECT quality, true AS r FROM labels JOIN documents USING (doc_id)) GROUP BY 1""")
def f14(spark, d):
    scaled = features.standardize(_docs(spark, d), _DOC_FEATURES)
    out = features.smote(scaled, "doc_id", "quality", _DOC_FEATURES)
    return out.groupBy("quality").agg(F.count_if(~F.col("is_synthetic")).alias("n_real"),
                                      F.count_if("is_synthetic").alias("n_synthetic"))


_DRAW = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"
_Z = ", ".join(f"(a.{c} - avg(a.{c}) OVER ()) / CASE WHEN stddev_pop(a.{c}) OVER () = 0 THEN 1 ELSE stddev_pop(a.{c}) OVER () END AS {c}" for c in _DOC_FEATURES)


@query("f14_smote_rows", f"""
WITH a AS (SELECT doc_id, quality, CAST(n_chars AS DOUBLE) AS chars, len(regexp_split_to_array(text, '\\s+'))::DOUBLE AS words,
  len(string_split(text, chr(10)))::DOUBLE AS lines, length(regexp_replace(text, '[^0-9]', '', 'g'))::DOUBLE AS digits FROM documents JOIN labels USING (doc_id)),
z AS (SELECT doc_id, quality, {_Z} FROM a),
n AS (SELECT quality, count(*) AS n, max(count(*)) OVER () - count(*) AS need FROM z GROUP BY 1 QUALIFY row_number() OVER (ORDER BY count(*), quality) = 1),
few AS (SELECT z.*, n, need, row_number() OVER (ORDER BY {_DRAW.format("'42-' || doc_id")}) AS place FROM z JOIN n USING (quality)),
copies AS (SELECT *, unnest(range(1, 1 + need // n + CASE WHEN place <= need % n THEN 1 ELSE 0 END)) AS copy FROM few),
near AS (SELECT x.doc_id, {", ".join(f"y.{c}" for c in _DOC_FEATURES)}, row_number() OVER (PARTITION BY x.doc_id ORDER BY
  round(sqrt({" + ".join(f"pow(x.{c} - y.{c}, 2)" for c in _DOC_FEATURES)}), 9), y.doc_id) AS r FROM few x JOIN few y ON x.doc_id <> y.doc_id QUALIFY r <= 5),
made AS (SELECT c.quality, {", ".join(f"c.{c} + gap * (o.{c} - c.{c}) AS {c}" for c in _DOC_FEATURES)} FROM (
  SELECT *, {_DRAW.format("'43-' || doc_id || '-' || copy")} % least(5, n - 1) + 1 AS r, {_DRAW.format("'44-' || doc_id || '-' || copy")} / pow(2.0, 60) AS gap FROM copies) c
  JOIN near o ON o.doc_id = c.doc_id AND o.r = c.r)
SELECT quality, {", ".join(f"{sql_rnd(c, 5)} AS {c}" for c in _DOC_FEATURES)} FROM made""")
def f14_rows(spark, d):
    scaled = features.standardize(_docs(spark, d), _DOC_FEATURES)
    made = features.smote(scaled, "doc_id", "quality", _DOC_FEATURES).where("is_synthetic")
    return made.select("quality", *[rnd(c, 5).alias(c) for c in _DOC_FEATURES])


@query("f15_vif", f"""
SELECT 'l_quantity' AS "column", {sql_rnd('1 / (1 - pow(corr(l_quantity, l_extendedprice), 2))')} AS vif FROM lineitem
UNION ALL SELECT 'l_extendedprice', {sql_rnd('1 / (1 - pow(corr(l_quantity, l_extendedprice), 2))')} FROM lineitem""")
def f15(spark, d):
    return features.vif(load(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"], intercept=True).withColumn("vif", rnd("vif"))


@query("f15_vif_no_intercept", """
WITH s AS (SELECT pow(sum(l_quantity * l_linenumber), 2) / (sum(l_quantity * l_quantity) * sum(l_linenumber * l_linenumber)) AS r2 FROM lineitem)
SELECT c AS "column", """ + sql_rnd("1 / (1 - r2)") + " AS vif FROM s, (VALUES ('l_quantity'), ('l_linenumber')) v(c)")
def f15b(spark, d):
    return features.vif(load(spark, d, "lineitem"), ["l_quantity", "l_linenumber"]).withColumn("vif", rnd("vif"))


@query("f16_split_stratified", """
SELECT o_orderstatus, count(*) AS n, CAST(round_even(count(*) * 0.3, 0) AS BIGINT) AS n_test FROM orders GROUP BY 1""")
def f16(spark, d):
    out = features.split_stratified(load(spark, d, "orders"), ["o_orderkey"], "o_orderstatus", 0.3, **HOT)
    return out.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test"))


@query("f16_split_random")
def f16_random(spark, d):
    return features.split_random(load(spark, d, "orders"), ["o_orderkey"], 0.2).groupBy("is_test").agg(F.count(F.lit(1)).alias("n"))


@query("f16_split_group_and_time")
def f16_time(spark, d):
    return features.split_group_and_time(customer_panel(spark, d), "e", "t", 0.2, 1999).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("t").alias("first"), F.max("t").alias("last"))


@query("f16_group_folds", "SELECT count(DISTINCT o_custkey) AS entities, count(DISTINCT o_custkey) AS entity_folds, 5 AS folds FROM orders")
def f16_folds(spark, d):
    out = features.group_folds(customer_panel(spark, d), "e")
    return out.agg(F.count_distinct("e").alias("entities"), F.count_distinct("e", "fold").alias("entity_folds"),
                   F.count_distinct("fold").alias("folds"))


# --- regression --------------------------------------------------------------------


def _reg(spark, d):
    """Supplier panel with a few terms for the regressions."""
    p = windows.add_lags(supplier_panel(spark, d), "e", "t", ["qty"], (1, 2), hot=False)
    return p.withColumns({
        "price": ratio("cents", "qty"), "lines": F.col("n").cast("double"),
        "wave": F.sin(F.col("e") * 0.7 + F.col("t") * 1.3), "trend": (F.col("t") - 1995).cast("double"),
    })


@query("m1_lasso_cv")
def m1(spark, d):
    return regression.lasso_cv(_reg(spark, d), "cents", ["qty", "lines", "wave", "trend", "qty_lag1"], ["e", "t"])


_RULES = {"dc": ["f1"], "dc_density": ["f2"], "size": ["f3", "f4"], "population": ["f5"], "economy": ["f6", "f7"],
          "environment": ["f3x", "f4x"], "permit": ["f1x", "f2x"], "sector": ["f5x", "information_f6"]}


@query("m2_select_features", """
WITH raw AS (SELECT l_suppkey AS outcome, f, (sum(l_linenumber * (ascii(substr(f, length(f))) % 11 + 1)) + length(f)) % 5 - 2 AS c
  FROM lineitem, (VALUES ('f1'), ('f2'), ('f3'), ('f4'), ('f5'), ('f6'), ('f7'), ('f3x'), ('f4x'), ('f1x'), ('f2x'), ('f5x'), ('information_f6')) v(f)
  GROUP BY 1, 2),
s AS (SELECT outcome, f, abs(c) AS a FROM raw WHERE c <> 0), o AS (SELECT DISTINCT outcome FROM s),
flags AS (SELECT outcome, max(f IN ('f1', 'f3', 'f4')) AS counts, max(f = 'f2') AS dens FROM s GROUP BY 1),
best AS (SELECT outcome, f, row_number() OVER (PARTITION BY outcome, grp ORDER BY a DESC, f) AS r, grp FROM (
  SELECT *, CASE WHEN f IN ('f3', 'f4') THEN 'size' WHEN f IN ('f3x', 'f4x') THEN 'environment' WHEN f IN ('f1x', 'f2x') THEN 'permit' END AS grp FROM s)
  WHERE grp IS NOT NULL)
SELECT outcome, 'f2' AS feature, 'dc_density' AS grp FROM flags WHERE NOT counts AND dens
UNION ALL SELECT outcome, 'f1', 'dc' FROM flags WHERE counts OR NOT dens
UNION ALL SELECT best.outcome, f, grp FROM best JOIN flags USING (outcome) WHERE r = 1 AND (grp <> 'size' OR counts OR NOT dens)
UNION ALL SELECT outcome, f, CASE WHEN f = 'f5' THEN 'population' WHEN f = 'f5x' THEN 'sector' ELSE 'economy' END FROM s WHERE f IN ('f5', 'f6', 'f7', 'f5x')""")
def m2(spark, d):
    names = [f for fs in _RULES.values() for f in fs]
    li = load(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("outcome")).agg(*[
        ((F.sum(F.col("l_linenumber") * (ord(f[-1]) % 11 + 1)) + len(f)) % 5 - 2).alias(f) for f in names])
    long = li.unpivot(["outcome"], names, "feature", "coef").where("coef <> 0").withColumn("abs_coef", F.abs("coef").cast("double"))
    return regression.select_features(long, _RULES).drop("rule_order")


@query("m3_double_lasso")
def m3(spark, d):
    df = _reg(spark, d)
    x = ["qty", "lines", "wave", "trend", "qty_lag1"]
    fm = regression.fold_moments(df, ["cents", *x, "qty_lag2"], ["e", "t"])
    return spark.createDataFrame(regression.double_lasso(fm, "cents", [*x, "qty_lag2"], ["qty_lag2"]), "feature string, coef double")


_DEMEANED = f"""WITH {SUPPLIER_PANEL},
m AS (SELECT e, t, n::DOUBLE - avg(n) OVER (PARTITION BY e) - avg(n) OVER (PARTITION BY t) + avg(n) OVER () AS x,
  qty - avg(qty) OVER (PARTITION BY e) - avg(qty) OVER (PARTITION BY t) + avg(qty) OVER () AS y FROM panel),
b AS (SELECT sum(x * y) / sum(x * x) AS coef, sum(x * x) AS sxx, count(*) AS nn, count(DISTINCT t) AS years, sum(y * y) AS tss FROM m),
u AS (SELECT e, sum(x * (y - coef * x)) AS s, sum(pow(y - coef * x, 2)) AS rss FROM m, b GROUP BY 1),
v AS (SELECT sum(s * s) AS meat, sum(rss) AS rss FROM u)"""


@query("m4_panel_ols", f"""{_DEMEANED} SELECT 'lines' AS term, {sql_rnd('coef', 5)} AS coef,
  {sql_rnd('sqrt(meat) / sxx * sqrt(nn / (nn - years))', 5)} AS std_err, {sql_rnd('coef - 1.959963984540054 * sqrt(meat) / sxx * sqrt(nn / (nn - years))', 4)} AS ci_low,
  nn AS n_obs FROM b, v""")
def m4(spark, d):
    fit = regression.panel_ols(_reg(spark, d), "qty", ["lines"], "e", "t")
    return fit.table(spark).select("term", rnd("coef", 5).alias("coef"), rnd("std_err", 5).alias("std_err"),
                                   rnd("ci_low", 4).alias("ci_low"), F.lit(fit.n).alias("n_obs"))


@query("m4_panel_ols_entity", f"""
WITH {SUPPLIER_PANEL}, m AS (SELECT e, n - avg(n) OVER (PARTITION BY e) AS x, qty - avg(qty) OVER (PARTITION BY e) AS y FROM panel)
SELECT {sql_rnd('sum(x * y) / sum(x * x)', 5)} AS coef, {sql_rnd('pow(sum(x * y), 2) / (sum(x * x) * sum(y * y))', 5)} AS r2 FROM m""")
def m4b(spark, d):
    fit = regression.panel_ols(_reg(spark, d), "qty", ["lines"], "e", "t", time_fe=False)
    return spark.createDataFrame([(float(fit.coef[0]), float(fit.r2))], "coef double, r2 double").select(
        rnd("coef", 5).alias("coef"), rnd("r2", 5).alias("r2"))


@query("m5_ols", f"""
WITH {SUPPLIER_PANEL} SELECT {sql_rnd('regr_intercept(qty, n)', 4)} AS intercept, {sql_rnd('regr_slope(qty, n)', 5)} AS slope,
  {sql_rnd('regr_r2(qty, n)', 5)} AS r2, {sql_rnd('sqrt(regr_syy(qty, n) * (1 - regr_r2(qty, n)) / (count(*) - 2) / regr_sxx(qty, n))', 5)} AS slope_se FROM panel""")
def m5(spark, d):
    fit = regression.ols(_reg(spark, d), "qty", ["lines"])
    out = spark.createDataFrame([(float(fit.coef[0]), float(fit.coef[1]), float(fit.r2), float(fit.cov[1, 1]) ** 0.5)],
                                "intercept double, slope double, r2 double, slope_se double")
    return out.select(rnd("intercept", 4).alias("intercept"), rnd("slope", 5).alias("slope"), rnd("r2", 5).alias("r2"),
                      rnd("slope_se", 5).alias("slope_se"))


@query("m6_effect_table", f"""
WITH {SUPPLIER_PANEL} SELECT 'lines' AS term, {sql_rnd('regr_slope(qty, n)', 5)} AS coef, quantile_cont(n, 0.1) AS p_low, quantile_cont(n, 0.9) AS p_high,
  {sql_rnd('regr_slope(qty, n) * (quantile_cont(n, 0.9) - quantile_cont(n, 0.1))', 3)} AS effect, false AS is_datacenter FROM panel""")
def m6(spark, d):
    df = _reg(spark, d)
    out = regression.effect_table(regression.ols(df, "qty", ["lines"]), df)
    return out.select("term", rnd("coef", 5).alias("coef"), F.round("p_low", 6).alias("p_low"), F.round("p_high", 6).alias("p_high"),
                      rnd("effect", 3).alias("effect"), "is_datacenter")


@query("m7_compare_models")
def m7(spark, d):
    df = _reg(spark, d)
    return regression.compare_models(spark, {
        "lines": regression.ols(df, "qty", ["lines"]), "trend": regression.ols(df, "qty", ["trend"]),
        "years": regression.ols(df, "qty", ["lines"], "t")})


@query("m8_residuals", f"""
WITH {SUPPLIER_PANEL}, m AS (SELECT *, n - avg(n) OVER (PARTITION BY e) AS x, qty - avg(qty) OVER (PARTITION BY e) AS y FROM panel),
b AS (SELECT sum(x * y) / sum(x * x) AS coef FROM m)
SELECT e, t, {sql_rnd('y - coef * x', 4)} AS residual, {sql_rnd('qty - (y - coef * x)', 4)} AS fitted FROM m, b""")
def m8(spark, d):
    df = _reg(spark, d)
    fit = regression.panel_ols(df, "qty", ["lines"], "e", "t", time_fe=False)
    out = regression.residuals(df, fit, entity="e")
    return out.select("e", "t", rnd("residual", 4).alias("residual"), rnd("fitted", 4).alias("fitted"))


@query("m12_durbin_watson", f"""
WITH {SUPPLIER_PANEL}, r AS (SELECT e, t, qty - avg(qty) OVER () AS u FROM panel),
s AS (SELECT u, u - lag(u) OVER (ORDER BY e, t) AS du FROM r) SELECT {sql_rnd('sum(du * du) / sum(u * u)')} AS durbin_watson FROM s""")
def m12(spark, d):
    p = supplier_panel(spark, d)
    mean = p.agg(F.avg("qty").alias("m")).withColumn("one", F.lit(1))
    r = p.withColumn("one", F.lit(1)).join(F.broadcast(mean), "one").withColumn("u", F.col("qty") - F.col("m"))
    return regression.durbin_watson(r, "u", ["e", "t"], **HOT).select(rnd("durbin_watson").alias("durbin_watson"))


_OUTCOMES = ["cents", "qty", "lines", "price", "cents_log", "qty_log", "lines_log", "price_log", "cents_per_line", "qty_per_line",
             "cents_change", "qty_change", "lines_sparse", "price_sparse"]


def _outcomes(spark, d):
    """The panel with fourteen outcomes; some are missing in the first year or in scattered cells."""
    lagged = windows.add_lags(supplier_panel(spark, d), "e", "t", ["qty", "cents"], (1, 2), hot=False)
    e, t, lines = F.col("e"), F.col("t"), F.col("n").cast("double")
    df = lagged.withColumns({
        "lines": lines, "price": ratio("cents", "qty"), "cents_per_line": ratio("cents", lines), "qty_per_line": ratio("qty", lines),
        "cents_change": F.col("cents") - F.col("cents_lag1"), "qty_change": F.col("qty") - F.col("qty_lag1"),
        "lines_sparse": F.when((e + t) % 5 != 0, lines), "price_sparse": F.when((e * 7 + t) % 4 != 0, ratio("cents", "qty")),
        "wave": F.sin(e * 0.7 + t * 1.3), "tide": F.cos(e * 1.1 + t * 0.7), "late": (t >= 1998).cast("int"),
        "density_per_100_lag2": ratio("qty_lag2", lines)})
    return df.withColumns({f"{c}_log": F.log(F.col(c)) for c in ("cents", "qty", "lines", "price")})


@query("m26_run_outcomes")
def m26(spark, d):
    # An outcome is not explained by what is made of the same measure.
    measures = {y: {m for m in ("cents", "qty", "lines", "price") if m in y} | ({"cents", "qty"} if "price" in y else set()) for y in _OUTCOMES}
    x = ["qty_log", "lines_log", "price_log", "qty_per_line", "wave", "tide"]
    exclude = {y: [c for c in x if any(m in c for m in own) or ("line" in c and "lines" in own) or ("price" in c and own & {"cents", "qty"})]
               for y, own in measures.items()}
    table, _ = regression.run_outcomes(
        _outcomes(spark, d), _OUTCOMES, x, ["density_per_100_lag2"], {"dc_density": ["density_per_100_lag2"], "economy": x}, "e", "t", exclude=exclude)
    return table


@query("m26_fourteen_closed", f"""
WITH {SUPPLIER_PANEL}, l AS (SELECT *, n::DOUBLE AS lines, cents / qty AS price, lag(cents) OVER w AS cents1, lag(qty) OVER w AS qty1, lag(t) OVER w AS t1
  FROM panel WINDOW w AS (PARTITION BY e ORDER BY t)),
r AS (SELECT e, sin(e * 0.7 + t * 1.3) AS x, (t >= 1998)::INT::DOUBLE AS d, cents::DOUBLE AS cents, qty::DOUBLE AS qty, lines, price::DOUBLE AS price, ln(cents) AS cents_log, ln(qty) AS qty_log,
  ln(lines) AS lines_log, ln(price) AS price_log, (cents / lines)::DOUBLE AS cents_per_line, (qty / lines)::DOUBLE AS qty_per_line,
  (cents - cents1)::DOUBLE AS cents_change, (qty - qty1)::DOUBLE AS qty_change,
  CASE WHEN (e + t) % 5 <> 0 THEN lines END AS lines_sparse, CASE WHEN (e * 7 + t) % 4 <> 0 THEN price::DOUBLE END AS price_sparse FROM l),
u AS (SELECT * FROM (UNPIVOT r ON {", ".join(_OUTCOMES)} INTO NAME outcome VALUE y) WHERE y IS NOT NULL),
m AS (SELECT outcome, e, y, x - avg(x) OVER w AS x, d - avg(d) OVER w AS d, y - avg(y) OVER w AS v FROM u WINDOW w AS (PARTITION BY outcome, e)),
s AS (SELECT outcome, count(*) AS n, avg(abs(y)) AS size, sum(x * x) AS xx, sum(d * d) AS dd, sum(x * d) AS xd, sum(x * v) AS xv, sum(d * v) AS dv FROM m GROUP BY 1),
b AS (SELECT *, xx * dd - xd * xd AS det, (xv * dd - dv * xd) / (xx * dd - xd * xd) AS coef, (dv * xx - xv * xd) / (xx * dd - xd * xd) AS late FROM s),
k AS (SELECT outcome, e, sum(x * (v - coef * x - late * d)) AS kx, sum(d * (v - coef * x - late * d)) AS kd FROM m JOIN b USING (outcome) GROUP BY 1, 2),
q AS (SELECT outcome, sum(pow((kx * dd - kd * xd) / det, 2)) * any_value(n) / (any_value(n) - 2) AS var FROM k JOIN b USING (outcome) GROUP BY 1)
SELECT outcome, n AS n_obs, {sql_rnd('coef / size', 5)} AS coef, {sql_rnd('coef / sqrt(var)', 4)} AS stat FROM b JOIN q USING (outcome)""")
def m26_closed(spark, d):
    df = _outcomes(spark, d)
    fits = regression.panel_ols_many(df, {y: ["wave"] for y in _OUTCOMES}, "e", "late")
    sizes = df.agg(*[F.avg(F.abs(y)).alias(y) for y in _OUTCOMES]).first()
    rows = [(y, f.n, float(f.coef[0]) / sizes[y], float(f.coef[0]) / float(f.cov[0, 0]) ** 0.5) for y, f in fits.items()]
    return spark.createDataFrame(rows, "outcome string, n_obs long, coef double, stat double").withColumns({"coef": rnd("coef", 5), "stat": rnd("stat", 4)})


# --- group tests and classifiers -----------------------------------------------------


def _groups(spark, d):
    return load(spark, d, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("g"), "l_quantity", "l_discount", "l_linenumber")


def _normal_tail_sql(z: str) -> str:
    """Upper tail of the normal distribution for z >= 0 by a polynomial of erfc, good to 1e-7 of its value."""
    terms = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    x, t = f"(({z}) / sqrt(2))", f"(1 / (1 + 0.5 * ({z}) / sqrt(2)))"
    inner = f"({terms[-1]})"
    for c in reversed(terms[:-1]):
        inner = f"({c} + {t} * {inner})"
    return f"(0.5 * {t} * exp(-{x} * {x} + {inner}))"


def _rank_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, u, {sql_rnd('z', 5)} AS z, {sql_rnd(f"least(1, 2 * {_normal_tail_sql('greatest(z, 0)')})", 5)} AS p_value, median_with, median_without FROM (
  SELECT u, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z, median_with, median_without FROM (
  SELECT sum(r) FILTER (WHERE g) - count(*) FILTER (WHERE g) * (count(*) FILTER (WHERE g) + 1) / 2 AS u, (count(*) FILTER (WHERE g))::DOUBLE AS n1,
    (count(*) FILTER (WHERE NOT g))::DOUBLE AS n2, sum(same * same - 1) AS ties,
    median({c}) FILTER (WHERE g) AS median_with, median({c}) FILTER (WHERE NOT g) AS median_without FROM (
  SELECT l_returnflag = 'R' AS g, {c}, rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS r, (count(*) OVER (PARTITION BY {c}))::DOUBLE AS same FROM lineitem)))"""


@query("m9_rank_sum_test", _union(_rank_sql(c) for c in ["l_quantity", "l_discount", "l_linenumber"]))
def m9(spark, d):
    out = classify.rank_sum_test(_groups(spark, d), "g", ["l_quantity", "l_discount", "l_linenumber"])
    return out.select("feature", "u", rnd("z", 5).alias("z"), rnd("p_value", 5).alias("p_value"), "median_with", "median_without")


@query("m10_fdr_bh", f"""
WITH p AS (SELECT s_suppkey AS id, (s_suppkey * 37 % 250 + 1) / 5e3 AS p_value FROM supplier),
r AS (SELECT *, count(*) OVER () AS m, count(*) OVER (ORDER BY p_value) AS k FROM p),
q AS (SELECT id, p_value, least(1.0, min(p_value * m / k) OVER (ORDER BY p_value DESC)) AS a FROM r)
SELECT id, p_value, {sql_rnd('a')} AS p_adjusted, a <= 0.04 AS is_significant FROM q""")
def m10(spark, d):
    k = F.col("s_suppkey")
    tests = load(spark, d, "supplier").select(k.alias("id"), ((k * 37 % 250 + 1) / F.lit(5000.0)).alias("p_value"))
    return classify.fdr_bh(tests, alpha=0.04).withColumn("p_adjusted", rnd("p_adjusted"))


@query("m11_logistic")
def m11(spark, d):
    df = features.standardize(_docs(spark, d), _DOC_FEATURES)
    _, coefs = classify.logistic(df, "quality", _DOC_FEATURES)
    return coefs


@query("m13_random_forest")
def m13(spark, d):
    df = checkpointed(features.smote(features.standardize(_docs(spark, d), _DOC_FEATURES), "doc_id", "quality", _DOC_FEATURES))
    model = classify.random_forest(df, "quality", _DOC_FEATURES)
    scored = classify.predict(model, df, _DOC_FEATURES)
    return classify.classification_report(scored, "quality", "predicted", "is_synthetic")


@query("m14_balanced_forest")
def m14(spark, d):
    df = _docs(spark, d)
    model = classify.balanced_forest(df, "quality", _DOC_FEATURES, key=["doc_id"])
    return classify.classification_report(classify.predict(model, df, _DOC_FEATURES), "quality", "predicted")


@query("m15_feature_importance")
def m15(spark, d):
    model = classify.balanced_forest(_docs(spark, d), "quality", _DOC_FEATURES, key=["doc_id"])
    return classify.feature_importance(spark, model, _DOC_FEATURES)


@query("m16_classification_report", """
SELECT o_orderpriority, count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE NOT y AND p) AS fp, count(*) FILTER (WHERE NOT y AND NOT p) AS tn,
  count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) FILTER (WHERE y = p) / count(*) AS accuracy,
  count(*) FILTER (WHERE y AND p) / count(*) FILTER (WHERE y) AS true_positive_rate
FROM (SELECT o_orderpriority, o_orderstatus = 'F' AS y, o_totalprice > 250000 AS p FROM orders) GROUP BY 1""")
def m16(spark, d):
    df = load(spark, d, "orders").select(
        "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("y"), (F.col("o_totalprice") > 250000).cast("int").alias("p"))
    return classify.classification_report(df, "y", "p", "o_orderpriority")


@query("m17_roc_auc", f"""
SELECT {sql_rnd('(sum(r) FILTER (WHERE y) - n1 * (n1 + 1) / 2) / (n1 * (n - n1))')} AS auc FROM (
  SELECT l_returnflag = 'R' AS y, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS r,
    count(*) OVER () AS n, count(*) FILTER (WHERE l_returnflag = 'R') OVER () AS n1 FROM lineitem) GROUP BY n, n1""")
def m17(spark, d):
    df = load(spark, d, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"), "l_quantity")
    return classify.roc_auc(df, "y", "l_quantity").select(rnd("auc").alias("auc"))


@query("m27_group_boxes", _union(
    f"""SELECT o_orderstatus, 'o_totalprice' AS feature, count(*) AS n_values, min(o_totalprice) AS q0, {sql_rnd('quantile_cont(o_totalprice, 0.25)', 3)} AS q1,
  {sql_rnd('quantile_cont(o_totalprice, 0.5)', 3)} AS q2, {sql_rnd('quantile_cont(o_totalprice, 0.75)', 3)} AS q3, max(o_totalprice) AS q4 FROM orders GROUP BY 1"""
    for _ in (1,)))
def m27(spark, d):
    out = classify.group_boxes(load(spark, d, "orders"), "o_orderstatus", ["o_totalprice"])
    return out.withColumns({c: rnd(c, 3) for c in ("q1", "q2", "q3")})


@query("m28_column_errors", f"""
SELECT 'a' AS feature, {sql_rnd('avg(pow(l_quantity - l_linenumber, 2))')} AS mse FROM lineitem
UNION ALL SELECT 'b', {sql_rnd('avg(pow(l_quantity - 25, 2))')} FROM lineitem""")
def m28(spark, d):
    df = load(spark, d, "lineitem").withColumn("mid", F.lit(25.0))
    out = classify.column_errors(df, [("a", "l_quantity", "l_linenumber"), ("b", "l_quantity", "mid"), ("c", "l_quantity", "l_quantity")])
    return classify.hardest(out, 2).withColumn("mse", rnd("mse"))


# --- components, clusters, neighbours ------------------------------------------------


def _vectors(spark, d):
    return cluster.scaled_vector(load(spark, d, "embeddings"), "embedding")


@query("m18_pca")
def m18(spark, d):
    df = _vectors(spark, d)
    return cluster.pca(df, k=3).scores(df).select("vec_id", "pc1", "pc2", "pc3")


@query("m18_pca_loadings")
def m18b(spark, d):
    return cluster.pca(_vectors(spark, d), share=0.85).loadings(spark, [f"x{i}" for i in range(64)])


@query("m19_kmeans")
def m19(spark, d):
    df = _vectors(spark, d)
    model = cluster.kmeans(df, 3)
    return cluster.cluster_labels(model, df).select("vec_id", "cluster")


@query("m20_silhouette_sweep")
def m20(spark, d):
    df = _vectors(spark, d)
    return cluster.silhouette_sweep(df, range(2, 50), restarts=10)


@query("m21_knn_classify", f"""
WITH v AS (SELECT vec_id, vec_id % 5 AS fold, label, embedding::DOUBLE[] AS x FROM embeddings),
near AS (SELECT a.vec_id, a.fold, a.label, b.label AS vote, row_number() OVER (PARTITION BY a.vec_id ORDER BY
  round(sqrt(list_sum(list_transform(range(1, 65), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i])))), 9), b.vec_id) AS r
  FROM v a JOIN v b ON a.fold <> b.fold QUALIFY r <= 74),
votes AS (SELECT vec_id, fold, label, k, vote, count(*) AS c FROM near JOIN range(1, 75) g(k) ON r <= k GROUP BY ALL),
best AS (SELECT vec_id, fold, label, k, arg_max(vote, c * 1000 - vote) AS predicted FROM votes GROUP BY ALL),
per AS (SELECT k, fold, count(*) FILTER (WHERE label = predicted) / count(*) AS a FROM best GROUP BY 1, 2)
SELECT k, {sql_rnd('avg(a)')} AS accuracy FROM per GROUP BY 1""")
def m21(spark, d):
    df = load(spark, d, "embeddings").withColumn("fold", F.col("vec_id") % 5)
    return classify.knn_classify(df, "vec_id", "embedding", "label", "fold", 74).withColumn("accuracy", rnd("accuracy"))


@query("m22_pc_regression")
def m22(spark, d):
    raw = load(spark, d, "embeddings")
    train = cluster.scaled_vector(raw.where("vec_id % 4 <> 0"), "embedding")
    fitted = cluster.pca(train, k=2)
    everything = fitted.scores(cluster.scaled_vector(raw, "embedding", raw.where("vec_id % 4 <> 0")))
    _, scores = cluster.pc_regression(everything.where("vec_id % 4 <> 0"), everything.where("vec_id % 4 = 0"), "label")
    return scores


# --- difference in differences --------------------------------------------------------


def _treated(spark, d):
    return did.assign_treatment(customer_panel(spark, d), "e", "t", "n_orders_count", 2)


_TREATED = f"""{CUSTOMER_PANEL}, f AS (SELECT e, min(t) AS g FROM cpanel WHERE n_orders_count > 2 GROUP BY 1),
p AS (SELECT e, t, cents / 1e4 AS y, coalesce(g, 0) AS g FROM cpanel LEFT JOIN f USING (e))"""


def _did(spark, d):
    return _treated(spark, d).withColumn("y", F.col("cents") / F.lit(10000.0))


@query("m23_assign_treatment", f"""
WITH {_TREATED} SELECT e, t, g AS first_year, CASE WHEN g > 0 AND t >= g THEN 1 ELSE 0 END AS treated, CASE WHEN g = 0 THEN -100 ELSE t - g END AS relative_year FROM p""")
def m23(spark, d):
    return _treated(spark, d).drop("cents", "n_orders_count")


_ATT = f"""{_TREATED}, c AS (SELECT g, t, avg(y) AS m, count(*) AS n FROM p GROUP BY 1, 2),
att AS (SELECT a.g, a.t, a.t - a.g AS rel, (a.m - b.m) - (u.m - w.m) AS effect, a.n AS n_treated, CASE WHEN a.t >= a.g THEN a.g - 1 ELSE a.t - 1 END AS base_t,
  a.m AS ma, b.m AS mb, u.m AS mu, w.m AS mw, a.n AS na, b.n AS nb, u.n AS nu, w.n AS nw
  FROM c a JOIN c b ON b.g = a.g AND b.t = CASE WHEN a.t >= a.g THEN a.g - 1 ELSE a.t - 1 END
  JOIN c u ON u.g = 0 AND u.t = a.t JOIN c w ON w.g = 0 AND w.t = b.t WHERE a.g > 0)"""
_PSI = """SELECT att.g, att.t, att.rel, p.e, CASE WHEN p.g = att.g AND p.t = att.t THEN (p.y - ma) / na WHEN p.g = att.g AND p.t = base_t THEN -(p.y - mb) / nb
  WHEN p.g = 0 AND p.t = att.t THEN -(p.y - mu) / nu WHEN p.g = 0 AND p.t = base_t THEN (p.y - mw) / nw ELSE 0 END AS psi
  FROM att JOIN p ON p.g IN (0, att.g) AND p.t IN (att.t, base_t)"""


@query("m24_att_gt", f"""
WITH {_ATT}, i AS ({_PSI}), per AS (SELECT g, t, e, sum(psi) AS psi FROM i GROUP BY ALL), v AS (SELECT g, t, sum(psi * psi) AS var FROM per GROUP BY 1, 2)
SELECT g, t, rel, {sql_rnd('effect')} AS effect, n_treated, {sql_rnd('sqrt(var)')} AS std_err FROM att JOIN v USING (g, t)""")
def m24(spark, d):
    out = did.att_gt_errors(_did(spark, d), "y", "e", "t")
    return out.select("g", "t", "rel", rnd("effect").alias("effect"), "n_treated", rnd("std_err").alias("std_err"))


@query("m25_event_study", f"""
WITH {_ATT}, s AS (SELECT g, count(DISTINCT e) AS units FROM p WHERE g > 0 GROUP BY 1),
w AS (SELECT rel, sum(units) AS total, sum(units * effect) / sum(units) AS effect, count(*) AS n_cohorts FROM att JOIN s USING (g) WHERE rel BETWEEN -5 AND 5 GROUP BY 1),
i AS ({_PSI}), per AS (SELECT i.rel, e, sum(psi * units / total) AS psi FROM i JOIN s USING (g) JOIN w ON w.rel = i.rel GROUP BY ALL),
v AS (SELECT rel, sum(psi * psi) AS var FROM per GROUP BY 1)
SELECT rel, {sql_rnd('effect')} AS effect, n_cohorts, {sql_rnd('effect - 1.959963984540054 * sqrt(var)')} AS ci_lower FROM w JOIN v USING (rel)""")
def m25(spark, d):
    out = did.event_study(_did(spark, d), "y", "e", "t")
    return out.select("rel", rnd("effect").alias("effect"), "n_cohorts", rnd("ci_lower").alias("ci_lower"))
