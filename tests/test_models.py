"""Features, regressions, tests and treatment effects against direct computations."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import close, rows
from gridpanel.operators import classify, cluster, did, features, ordered, regression

TINY = {"rows": 20}


@pytest.fixture(scope="module")
def panel(spark):
    """Unbalanced panel with entity and period effects and a planted slope."""
    rnd = np.random.default_rng(5)
    data = []
    for e in range(40):
        own = rnd.normal(0, 3)
        for t in range(2001, 2009):
            if rnd.random() < 0.2:
                continue
            x1, x2, x3 = rnd.normal(own, 1), rnd.normal(0, 2), rnd.normal(5, 1)
            y = 100 + 2.0 * x1 - 0.5 * x2 + own + 0.3 * (t - 2001) ** 2 + rnd.normal(0, 0.5)
            data.append((e, t, float(x1), float(x2), float(x3), float(x1 + x2), float(y)))
    return spark.createDataFrame(data, "e int, t int, x1 double, x2 double, x3 double, twin double, y double").repartition(8)


def as_numpy(df, *columns):
    return [np.array(c, dtype=float) for c in zip(*[tuple(r) for r in df.select(*columns).orderBy("e", "t").collect()], strict=True)]


@pytest.mark.parametrize("entity_fe,time_fe", [(True, True), (True, False), (False, True)])
def test_panel_ols_equals_dummy_regression(panel, entity_fe, time_fe):
    fit = regression.panel_ols(panel, "y", ["x1", "x2", "x3"], "e", "t", entity_fe, time_fe)
    e, t, x1, x2, x3, y = as_numpy(panel, "e", "t", "x1", "x2", "x3", "y")
    z = np.column_stack([x1, x2, x3] + [(t == v).astype(float) for v in sorted(set(t))[1:]] * time_fe)
    if entity_fe:
        for v in set(e):
            z[e == v] -= z[e == v].mean(0)
            y[e == v] -= y[e == v].mean()
    else:
        z, y = z - z.mean(0), y - y.mean()
    beta, *_ = np.linalg.lstsq(z, y, rcond=None)
    u = y - z @ beta
    inverse = np.linalg.inv(z.T @ z)
    meat = sum(np.outer(s, s) for s in ((z[e == v] * u[e == v][:, None]).sum(0) for v in set(e)))
    cov = inverse @ meat @ inverse * len(y) / (len(y) - z.shape[1])
    assert np.allclose(fit.coef, beta[:3]) and np.allclose(np.sqrt(np.diag(fit.cov)), np.sqrt(np.diag(cov))[:3])
    assert close(fit.r2, 1 - (u @ u) / (y @ y), 1e-8) and fit.n == len(y)


@pytest.mark.parametrize("entity_fe,time_fe", [(True, True), (True, False), (False, True)])
def test_many_outcomes_equal_single_dummy_regressions(spark, entity_fe, time_fe):
    """Fourteen outcomes on an unbalanced panel with gaps, own regressors, string entities and a hot one."""
    rnd = np.random.default_rng(31)
    n = 400
    e = np.where(rnd.random(n) < 0.35, 0, rnd.integers(0, 25, n))
    t = rnd.integers(2000, 2006, n)
    x = rnd.normal(0, 1, (n, 3)) + e[:, None] * 0.1
    y = x @ rnd.normal(0, 1, (3, 14)) + (e % 4)[:, None] + 0.3 * (t - 2000)[:, None] + rnd.normal(0, 1, (n, 14)) + 1000.0
    x[rnd.random((n, 3)) < 0.05] = np.nan
    y[rnd.random((n, 14)) < 0.1] = np.nan
    y[:, 13] = np.nan  # an outcome without rows
    names = [*(f"x{i}" for i in range(3)), *(f"y{i}" for i in range(14))]
    values = [[None if math.isnan(v) and i % 2 else v for i, v in enumerate(row)] for row in np.column_stack([x, y]).tolist()]
    df = spark.createDataFrame([(f"e{a}", int(b), *row) for a, b, row in zip(e, t, values, strict=True)],
                               "e string, t int, " + ", ".join(f"{c} double" for c in names)).repartition(5)
    df = df.unionByName(df.limit(1).withColumn("e", F.lit(None).cast("string")))
    models = {f"y{j}": [f"x{i}" for i in range(3) if (j + i) % 4] for j in range(14)}
    fits = regression.panel_ols_many(df, models, "e", "t", entity_fe, time_fe)
    assert sorted(fits) == sorted(f"y{j}" for j in range(13))
    for j in range(13):
        use = [i for i in range(3) if (j + i) % 4]
        ok = ~np.isnan(np.column_stack([x[:, use], y[:, j]])).any(axis=1)
        z = np.column_stack([x[ok][:, use], *[(t[ok] == v).astype(float) for v in range(2001, 2006) if time_fe]])
        v, g = y[ok, j].copy(), e[ok]
        if entity_fe:
            for a in set(g):
                z[g == a] -= z[g == a].mean(0)
                v[g == a] -= v[g == a].mean()
        else:
            z, v = z - z.mean(0), v - v.mean()
        beta, *_ = np.linalg.lstsq(z, v, rcond=None)
        u = v - z @ beta
        inverse = np.linalg.inv(z.T @ z)
        meat = sum(np.outer(s, s) for s in ((z[g == a] * u[g == a][:, None]).sum(0) for a in set(g)))
        cov = inverse @ meat @ inverse * len(v) / (len(v) - z.shape[1])
        fit = fits[f"y{j}"]
        assert fit.terms == models[f"y{j}"] and fit.n == len(v)
        assert np.allclose(fit.coef, beta[:len(use)], atol=1e-8) and np.allclose(np.sqrt(np.diag(fit.cov)), np.sqrt(np.diag(cov))[:len(use)])
        assert close(fit.rss, float(u @ u), 1e-8)


def test_too_many_periods_are_refused(spark, monkeypatch):
    from gridpanel.operators import panel_fit

    monkeypatch.setattr(panel_fit, "MOST_PERIODS", 3)
    df = spark.createDataFrame([(i % 3, i, float(i), float(i * i)) for i in range(12)], "e int, t int, x double, y double")
    with pytest.raises(ValueError, match="few levels"):
        regression.panel_ols(df, "y", ["x"], "e", "t")
    assert regression.panel_ols(df, "y", ["x"], "e", "t", time_fe=False).n == 12


def test_lasso_meets_its_optimality_conditions():
    """Coefficients in use have the penalty's gradient, the others at most that, with nearly collinear columns, too."""
    rnd = np.random.default_rng(1)
    x = rnd.normal(0, 1, (200, 6))
    x[:, 5] = x[:, 0] + x[:, 1] + 1e-4 * rnd.normal(0, 1, 200)
    gram, xy = x.T @ x / 200, x.T @ (x @ [1.0, 0.5, 0, 0, -0.3, 0] + rnd.normal(0, 1, 200)) / 200
    for alpha in (0.5, 0.1, 0.01, 0.001):
        b = regression._descend(gram, xy, alpha, np.zeros(6))
        rest = xy - gram @ b
        assert (np.abs(rest) <= alpha * (1 + 1e-4)).all()
        assert np.allclose(rest[b != 0], alpha * np.sign(b[b != 0]), atol=1e-4 * alpha + 1e-9)


def test_residuals_add_up_and_twin_terms_are_dropped(panel):
    fit = regression.panel_ols(panel, "y", ["x1", "x2", "twin"], "e", "t")
    assert fit.terms == ["x1", "x2"]
    out = regression.residuals(panel, fit, "e", "t").agg(F.sum("residual"), F.sum(F.col("residual") * F.col("residual"))).first()
    assert abs(out[0]) < 1e-8 and close(out[1], fit.rss, 1e-6)


def test_ols_and_model_table(spark, panel):
    fit = regression.ols(panel, "y", ["x1", "x2"], "t")
    e, t, x1, x2, y = as_numpy(panel, "e", "t", "x1", "x2", "y")
    z = np.column_stack([np.ones(len(y)), x1, x2] + [(t == v).astype(float) for v in sorted(set(t))[1:]])
    beta, *_ = np.linalg.lstsq(z, y, rcond=None)
    u = y - z @ beta
    assert np.allclose(fit.coef, beta)
    assert np.allclose(np.diag(fit.cov), np.diag(np.linalg.inv(z.T @ z)) * (u @ u) / (len(y) - z.shape[1]))
    small = regression.ols(panel, "y", ["x3"])
    table = regression.compare_models(spark, {"small": small, "big": fit}).collect()
    assert [r["model"] for r in table] == ["big", "small"] and table[0]["aic"] < table[1]["aic"]
    # the tail of t with 10 degrees of freedom at 2.228 is 5 %
    from gridpanel.functions.distributions import t_quantile, t_two_sided
    assert abs(t_two_sided(2.2281388, 10) - 0.05) < 1e-6 and abs(t_quantile(0.975, 10) - 2.2281388) < 1e-5


def test_lasso_meets_its_optimality_conditions(panel):
    x = ["x1", "x2", "x3"]
    fm = regression.fold_moments(panel, ["y", *x], ["e", "t"])
    assert len(fm.folds) == 5 and sum(f.n for f in fm.folds) == panel.count()
    found = dict(regression.lasso_from_moments(fm, "y", x))
    assert abs(found["x1"]) > abs(found.get("x2", 0.0))
    e, t, *cols, y = as_numpy(panel, "e", "t", *x, "y")
    z = np.column_stack([(c - c.mean()) / c.std() for c in cols])
    b = np.array([found.get(c, 0.0) for c in x])
    grad = z.T @ (y - y.mean() - z @ b) / len(y)
    size = max(abs(g) for g, v in zip(grad, b, strict=True) if v)
    assert all(abs(abs(g) - size) < 1e-5 if v else abs(g) <= size + 1e-5 for g, v in zip(grad, b, strict=True))
    first_wins = regression.double_lasso(fm, "y", x, ["x1"])
    assert dict(first_wins)["x1"] == found["x1"]


def test_feature_rules(spark):
    rules = {"dc": ["c1", "c2"], "dc_density": ["d1", "d2"], "size": ["s1", "s2"], "sector": ["sec", "sec_information"],
             "environment": ["e1", "e2"], "population": ["pop"]}
    coefs = [("dense", "d1", 1.0), ("dense", "sec_information", 2.0), ("dense", "e1", 0.5), ("dense", "e2", 0.7),
             ("count", "d1", 1.0), ("count", "s1", 0.2), ("count", "s2", 0.3), ("none", "sec", 1.0)]
    df = spark.createDataFrame(coefs, "outcome string, feature string, abs_coef double")
    picked = {}
    for r in regression.select_features(df, rules).collect():
        picked.setdefault(r["outcome"], set()).add(r["feature"])
    assert picked == {"dense": {"d1", "d2", "e2"}, "count": {"c1", "c2", "s2"}, "none": {"c1", "c2", "sec"}}
    only = {r["feature"] for r in regression.select_features(df, {**rules, "dc": []}, True).where("outcome = 'dense'").collect()}
    assert only == {"d1", "d2", "e2", "sec_information"}


def test_profile_and_transforms(spark):
    data = [(float(2**i), float(i % 2), None if i == 3 else 1.0, "x") for i in range(12)]
    df = spark.createDataFrame(data, "big double, zero double, gap double, s string")
    got = {r["column"]: r for r in features.profile(df, acceptable_skew=1.0).collect()}
    assert got["big"]["suggested_transform"] == "log" and got["zero"]["n_zeros"] == 6 and got["zero"]["suggested_transform"] == "none"
    assert close(got["gap"]["missing_share"], 1 / 12) and got["gap"]["n_unique"] == 1 and got["gap"]["skew"] in (None, 0.0)
    out = features.apply_transforms(df, features.profile(df, acceptable_skew=1.0), exclude=["zero"])
    assert out.columns == ["big_log", "zero", "gap", "s"]
    assert features.drop_by_profile(df, features.profile(df), 1.0, protect=["gap"]).columns == ["zero", "gap", "s"]


def test_column_selection(spark):
    rnd = random.Random(4)
    data = []
    for i in range(200):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        data.append((a, b, a + 0.05 * rnd.gauss(0, 1), 50.0 if i == 0 else rnd.gauss(0, 1), None if i == 5 else 1.0, 3.0, f"r{i}"))
    df = spark.createDataFrame(data, "a double, b double, near_a double, spike double, gap double, flat double, name string")
    kept, report = features.select_columns(df, no_na=True, vif_cut=5, sd_cut=4)
    assert kept == ["name", "b"]
    reasons = dict(report.collect())
    assert reasons["gap"] == "contained NA values" and reasons["near_a"].startswith("high VIF") and reasons["spike"].startswith("exceeded")
    assert "flat" in reasons  # nothing lies strictly inside a band of width zero
    everything, _ = features.select_columns(df, vif_cut=-1, sd_cut=-1, preserve=["b"])
    assert everything == ["name", "b", "a", "near_a", "spike", "gap", "flat"]


def test_normality_tells_shapes_apart(spark):
    rnd = random.Random(6)
    df = spark.createDataFrame([(rnd.gauss(0, 1), rnd.expovariate(1.0)) for _ in range(500)], "a double, b double")
    p = {r["column"]: r["p_value"] for r in features.normality(df, ["a", "b"]).collect()}
    assert p["a"] > 0.01 and p["b"] < 1e-6


def test_shape_transforms(spark):
    rnd = random.Random(7)
    df = spark.createDataFrame([(i, rnd.expovariate(0.2), i % 2) for i in range(400)], "id int, v double, part int")
    z = features.quantile_normalize(df, "v", "z").agg(F.avg("z"), F.stddev_pop("z")).first()
    assert abs(z[0]) < 1e-6 and abs(z[1] - 1) < 0.1
    out = features.power_transform(df, ["v"], df.where("part = 0"))
    s = out.where("part = 0").agg(F.avg("v"), F.stddev_pop("v"), F.skewness("v"), F.max(F.abs("v"))).first()
    assert abs(s[0]) < 1e-9 and abs(s[1] - 1) < 1e-9 and abs(s[2]) < 0.5 and out.agg(F.max(F.abs("v"))).first()[0] <= 10
    q = features.qq_points(df, "v", **TINY).agg(F.corr("theoretical", "sample"), F.sum("n")).first()
    assert 0.8 < q[0] < 1 and q[1] == 400


@pytest.mark.parametrize("cells", [2, 16, ordered.CELLS])
def test_order_statistics_equal_a_sort(spark, cells):
    rng = np.random.default_rng(11)
    x = np.concatenate([np.full(3000, 2.5), rng.normal(0, 1e6, 4000), rng.integers(-3, 4, 2000), [-0.0, 1e300, -1e300]])
    rng.shuffle(x)
    data = [(float(v),) for v in x] + [(None,), (float("nan"),), (float("inf"),), (float("-inf"),)]
    df = spark.createDataFrame(data, "`a.b` double").repartition(7)
    n, found = ordered.order_statistics(df, "a.b", lambda n: range(0, n, 37), cells)
    assert n == len(x) and found == {i: np.sort(x)[i] for i in range(0, n, 37)}
    shares, grid = ordered.quantile_grid(df, "a.b", 101, cells)
    assert np.allclose(grid, np.quantile(x, shares), rtol=1e-12)


def test_quantile_grid_edges(spark):
    def z(values, **how):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
        return [r["z"] for r in features.quantile_normalize(df, "v", "z", **how).orderBy("id").collect()]

    assert z([]) == [] and z([None, float("nan")]) == [None, None]
    assert z([4.0, None, 4.0]) == [0.0, None, 0.0]
    low, none, nan, mid, high = z([1.0, None, float("nan"), 2.0, 3.0])
    assert none is None and nan is None and abs(mid) < 1e-9 and -5.3 < low < -5.1 and abs(low + high) < 1e-6
    # Equal values in the middle get the middle of their grid points; infinite ones the ends.
    tied = z([1.0, 2.0, 2.0, 2.0, 9.0, float("inf")], points=5)
    assert abs(tied[1]) < 1e-9 and tied[1] == tied[2] == tied[3] and tied[4] == tied[5] > 5
    train = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    df = spark.createDataFrame([(-7.0,), (5.0,), (99.0,)], "v double")
    got = [r["v"] for r in features.quantile_normalize(df, "v", train=train).collect()]
    assert got[0] < -5 and abs(got[1]) < 1e-9 and got[2] > 5


def test_correlations_of_pairs_with_gaps(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 1.0, (300, 20))
    x[:, 1] += x[:, 0]
    x[:, 2] = 4.0
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = np.nan
    names = [f"c{i}" for i in range(20)]
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in r] for r in x], ", ".join(f"{n} double" for n in names))
    got = {(r["a"], r["b"]): r["corr"] for r in features.corr_matrix(df.repartition(5), names).collect()}
    assert len(got) == 400
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if {i, j} & {2, 3}:
                assert got[a, b] is None
            else:
                assert abs(got[a, b] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-6
    empty = features.corr_matrix(df.limit(0), names[:2]).collect()
    assert [r["corr"] for r in empty] == [None] * 4


def test_powers_have_the_largest_likelihood(spark):
    rng = np.random.default_rng(4)
    x = np.stack([rng.exponential(5.0, 500), rng.normal(-2.0, 3.0, 500), np.full(500, 7.0)], 1)
    df = spark.createDataFrame([[float(v) for v in r] for r in x] + [[None, None, None]], "a double, b double, c double")
    got = features.best_powers(df.repartition(4), ["a", "b", "c"])
    assert got["c"] == 1.0

    def likelihood(v, power):
        up = np.log1p(np.abs(v)) if power == 0 else ((np.abs(v) + 1) ** power - 1) / power
        down = -np.log1p(np.abs(v)) if power == 2 else -((np.abs(v) + 1) ** (2 - power) - 1) / (2 - power)
        return -250 * np.log(np.var(np.where(v >= 0, up, down))) + (power - 1) * (np.sign(v) * np.log1p(np.abs(v))).sum()

    for j, c in enumerate("ab"):
        best = max(likelihood(x[:, j], p) for p in np.arange(-3, 3.001, 0.01).round(2))
        assert likelihood(x[:, j], got[c]) > best - 1e-3
    assert features.best_powers(df.limit(0), ["a"]) == {"a": 1.0}


def test_splits(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3 == 0).alias("s"), (F.col("id") % 40).alias("e"), (F.col("id") % 10).alias("t"))
    out = features.split_stratified(df, ["id"], "s", 0.3, **TINY)
    assert rows(out.groupBy("s").agg(F.count_if("is_test"))) == [(False, 200), (True, 100)]
    folds = features.group_folds(df, "e").groupBy("e").agg(F.count_distinct("fold").alias("n"))
    assert folds.where("n <> 1").count() == 0
    parts = features.split_group_and_time(df, "e", "t", 0.3, 6)
    both = parts.where("part = 'train'").join(parts.where("part = 'test'"), "e", "left_semi").count()
    assert both == 0 and parts.where("part = 'test' and t <= 6").count() == 0 and parts.where("part = 'train' and t > 6").count() == 0


def test_smote_balances_inside_the_minority(spark):
    rnd = random.Random(8)
    data = [(i, 1 if i < 30 else 0, rnd.gauss(5 if i < 30 else 0, 1), rnd.gauss(0, 1)) for i in range(200)]
    df = spark.createDataFrame(data, "id int, y int, a double, b double")
    out = features.smote(df, "id", "y", ["a", "b"], k=4, **TINY)
    assert rows(out.groupBy("y").count()) == [(0, 170), (1, 170)]
    lo, hi = df.where("y = 1").agg(F.min("a"), F.max("a")).first()
    made = out.where("is_synthetic")
    assert made.count() == 140 and made.where(f"a < {lo} or a > {hi} or y <> 1 or id is not null").count() == 0


def test_rank_sum_and_fdr(spark):
    a, b = [1.0, 2.0, 2.0, 5.0], [2.0, 3.0, 6.0, 7.0, 8.0]
    df = spark.createDataFrame([(1, v) for v in a] + [(0, v) for v in b] + [(1, None)], "g int, v double")
    r = classify.rank_sum_test(df, "g", ["v"]).first()
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert r["u"] == u and r["median_with"] == 2.0 and r["median_without"] == 6.0
    n1, n2, n = 4, 5, 9
    sd = math.sqrt(n1 * n2 / 12 * ((n + 1) - (3**3 - 3) / (n * (n - 1))))
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sd
    assert close(r["p_value"], math.erfc(z / math.sqrt(2)), 1e-10)
    p = spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", 0.04), ("e", None)], "id string, p_value double")
    out = {r["id"]: (r["p_adjusted"], r["is_significant"]) for r in classify.fdr_bh(p, alpha=0.04).collect()}
    assert close(out["a"][0], 0.04) and out["a"][1] and close(out["c"][0], 0.04) and close(out["b"][0], 0.04) and out["e"] == (None, False)


def test_classifiers(spark):
    rnd = random.Random(9)
    data = []
    for i in range(300):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        data.append((i, int(a + 0.2 * rnd.gauss(0, 1) > 0.5), a, b))
    df = spark.createDataFrame(data, "id int, y int, a double, b double")
    model, coefs = classify.logistic(df, "y", ["a", "b"])
    c = dict(coefs.collect())
    assert c["a"] > 1 and abs(c["b"]) < c["a"]
    scored = classify.predict(model, df, ["a", "b"])
    assert classify.roc_auc(scored, "y", "score", **TINY).first()[0] > 0.95
    report = classify.classification_report(scored, "y", "predicted").first()
    assert report["tp"] + report["fp"] + report["tn"] + report["fn"] == 300 and report["true_positive_rate"] > 0.9
    forest = classify.balanced_forest(df, "y", ["a", "b"], trees=10, depth=4)
    first = classify.feature_importance(spark, forest, ["a", "b"]).first()
    assert first["feature"] == "a"
    vec = df.withColumn("v", F.array("a", "b"))
    guess = classify.knn_predict(vec.where("id < 200"), vec.where("id >= 200"), "id", "v", "y", 5)
    hit = guess.join(df, "id").agg(F.avg((F.col("y") == F.col("predicted")).cast("int"))).first()[0]
    assert guess.count() == 100 and hit > 0.85


def test_components_and_clusters(spark):
    rnd = random.Random(10)
    centres = [(0, 0, 0), (8, 8, 0), (-8, 8, 0)]
    data = [(i, *[c + rnd.gauss(0, 0.5) for c in centres[i % 3]], i % 3) for i in range(150)]
    df = spark.createDataFrame(data, "id int, a double, b double, c double, truth int")
    scaled = cluster.scaled_vector(df, ["a", "b", "c"])
    fitted = cluster.pca(scaled, share=0.9)
    scores = fitted.scores(scaled)
    spread = scores.agg(F.var_samp("pc1"), F.avg("pc1"), F.corr("pc1", "pc2")).first()
    assert close(spread[0], fitted.variance[0], 1e-6) and abs(spread[1]) < 1e-9 and abs(spread[2]) < 1e-6
    loads = fitted.loadings(spark, ["a", "b", "c"]).collect()
    assert len(loads) == 3 * fitted.keep and max(r["loading"] for r in loads) <= 1.01
    model = cluster.kmeans(scaled, 3, restarts=3)
    labels = cluster.cluster_labels(model, scaled)
    assert labels.groupBy("truth").agg(F.count_distinct("cluster").alias("n")).where("n <> 1").count() == 0
    sweep = {r["k"]: r["train_silhouette"] for r in cluster.silhouette_sweep(scaled, [2, 3, 4], restarts=1).collect()}
    assert max(sweep, key=sweep.get) == 3 and all(-1 <= v <= 1 for v in sweep.values())


def test_planted_treatment_effect(spark):
    rnd = np.random.default_rng(11)
    data = []
    for e in range(120):
        g = [0, 2004, 2006, 2001][e % 4]
        for t in range(2001, 2010):
            if rnd.random() < 0.05:
                continue
            data.append((e, t, g, float(e % 7 + 0.5 * (t - 2001) + (3.0 if g and t >= g else 0.0) + rnd.normal(0, 0.2))))
    df = spark.createDataFrame(data, "e int, t int, first_year int, y double")
    out = did.att_gt_errors(df, "y", "e", "t").collect()
    assert {r["g"] for r in out} == {2004, 2006}  # treated from the start: no base period
    for r in out:
        assert abs(r["effect"] - (3.0 if r["rel"] >= 0 else 0.0)) < 2.0 and r["ci_lower"] < r["effect"] < r["ci_upper"]
    study = {r["rel"]: r for r in did.event_study(df, "y", "e", "t").collect()}
    assert min(study) >= -5 and max(study) <= 5 and study[0]["n_cohorts"] == 2
    flat = {r["rel"]: r["effect"] for r in did.event_study(df, "y", "e", "t", base="universal").collect()}
    assert flat[-1] == 0.0
    with pytest.raises(ValueError):
        did.att_gt(df, "y", "e", "t", base="x")


def test_unit_clustered_error_on_a_balanced_panel(spark):
    """With all units seen in both periods the error is that of the mean differences."""
    rnd = np.random.default_rng(12)
    own = rnd.normal(0, 5, 60)
    data = [(e, t, 2002 if e % 2 else 0, float(own[e] + rnd.normal(0, 1))) for e in range(60) for t in (2001, 2002)]
    df = spark.createDataFrame(data, "e int, t int, first_year int, y double")
    r = did.att_gt_errors(df, "y", "e", "t").first()
    y = {(e, t): v for e, t, _, v in data}
    d1 = np.array([y[e, 2002] - y[e, 2001] for e in range(1, 60, 2)])
    d0 = np.array([y[e, 2002] - y[e, 2001] for e in range(0, 60, 2)])
    assert close(r["effect"], d1.mean() - d0.mean())
    assert close(r["std_err"], math.sqrt(d1.var() / 30 + d0.var() / 30))


def test_errors_from_second_moments_equal_influences(spark):
    """Unbalanced panel, several rows of a unit in one period: the sum of squared unit influences, row by row."""
    rnd = np.random.default_rng(21)
    data = [(e, t, (0, 2003, 2005)[e % 3], float(rnd.normal(e % 5, 1)))
            for e in range(90) for t in range(2000, 2008) for _ in range(int(rnd.integers(0, 3)))]
    df = spark.createDataFrame([*data, (1, 2001, None, 5.0), (2, None, 0, 5.0), (3, 2002, 0, None)], "e int, t int, first_year int, y double").repartition(7)
    mean = {}
    for g in (0, 2003, 2005):
        for t in range(2000, 2008):
            values = [v for e, s, h, v in data if (h, s) == (g, t)]
            mean[g, t] = np.mean(values), len(values)

    def influence(parts):
        """Per unit, for (weight, g, t, base) effects."""
        psi = {}
        for w, g, t, b in parts:
            for e, s, h, v in data:
                for cohort, at, sign in ((g, t, 1), (g, b, -1), (0, t, -1), (0, b, 1)):
                    if (h, s) == (cohort, at):
                        m, n = mean[cohort, at]
                        psi[e] = psi.get(e, 0.0) + w * sign * (v - m) / n
        return math.sqrt(sum(p * p for p in psi.values()))

    for base in ("varying", "universal"):
        bases = {(g, t): g - 1 if base == "universal" or t >= g else t - 1 for g in (2003, 2005) for t in range(2000, 2008)}
        got = {(r["g"], r["t"]): r["std_err"] for r in did.att_gt_errors(df, "y", "e", "t", base=base).collect()}
        assert set(got) == {k for k, b in bases.items() if b >= 2000}
        for (g, t), v in got.items():
            assert abs(v - influence([(1.0, g, t, bases[g, t])])) < 1e-9
        for r in did.event_study(df, "y", "e", "t", base=base, window=(-2, 2)).collect():
            parts = [(0.5, g, g + r["rel"], bases[g, g + r["rel"]]) for g in (2003, 2005)]
            units = {g: len({e for e, _, h, _ in data if h == g}) for g in (2003, 2005)}
            parts = [(units[g] / sum(units.values()), g, t, b) for _, g, t, b in parts if b >= 2000]
            assert len(parts) == 2 and abs(r["std_err"] - influence(parts)) < 1e-9


def test_vif_of_determined_columns(spark):
    df = spark.createDataFrame([(float(i), float(i % 5), 2.0 * i + i % 5) for i in range(30)], "a double, b double, c double")
    assert all(r["vif"] == math.inf for r in features.vif(df, ["a", "b", "c"]).collect())


def test_wide_and_narrow_moments_agree(panel, monkeypatch):
    from gridpanel.operators import moments
    data = panel.withColumn("f", F.col("e") % 3)
    narrow = moments.moments_by_fold(data, ["x1", "x2", "y"], [1.0, 0.0, 100.0], "f")
    monkeypatch.setattr(moments, "WIDE", 2)
    wide = moments.moments_by_fold(data, ["x1", "x2", "y"], [1.0, 0.0, 100.0], "f")
    assert sorted(narrow) == sorted(wide) == [0, 1, 2]
    for f in narrow:
        assert narrow[f].n == wide[f].n and np.allclose(narrow[f].sums, wide[f].sums)
        assert np.allclose(narrow[f].products, wide[f].products)


def _clouds(spark, n=600, width=5, groups=6, seed=3):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 4, (groups, width))
    x = centres[rnd.integers(0, groups, n)] + rnd.normal(0, 1, (n, width))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id int, x array<double>")
    return x, df


def test_many_models_equal_one_by_one(spark):
    """Every model of a sweep follows Lloyd's rule from its own start, and the best one is at least as good as Spark's."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    from gridpanel.operators import lloyd
    x, df = _clouds(spark)
    models = lloyd.fit_many(df.select("x").repartition(3), [2, 5, 6, 9], restarts=3, tolerance=0.0)
    assert [(m.k, m.start) for m in models] == [(k, i) for k in (2, 5, 6, 9) for i in range(3)]
    for m in models:
        d = ((x[:, None, :] - m.centres[None]) ** 2).sum(-1)
        labels = d.argmin(1)
        assert np.allclose(m.cost, d.min(1).sum())  # nothing moves any more
        assert np.allclose(m.centres, [x[labels == c].mean(0) for c in range(m.k)])
    best = lloyd.best_of(models)
    theirs = KMeans(k=6, seed=1, maxIter=50).fit(df.select(array_to_vector("x").alias("features")))
    assert best[6].cost <= theirs.summary.trainingCost * (1 + 1e-9)
    assert all(best[m.k].cost <= m.cost for m in models)
    short = lloyd.fit_many(df.select("x"), [9], restarts=1, rounds=2)
    assert short[0].rounds == 2


@pytest.mark.parametrize("scale", [1.0, 1e-6, 1e20])
def test_models_fitted_in_tasks_equal_full_passes(spark, monkeypatch, scale):
    """Rows that fit a task give the labels and rounds of passes over all rows, without a pass per round."""
    import numpy as np

    from gridpanel.operators import lloyd

    rnd = np.random.default_rng(8)
    x = rnd.normal(0, 1, (400, 6))
    x[:100] += 3.0
    x[200:220] = x[200]
    df = spark.createDataFrame([((r * scale).tolist(),) for r in x], "x array<double>").repartition(3)
    monkeypatch.setattr(lloyd, "HELD_BYTES", 0)
    passes = lloyd.fit_many(df, [1, 2, 7], restarts=2)
    monkeypatch.setattr(lloyd, "HELD_BYTES", 1 << 20)
    monkeypatch.setattr(lloyd, "_pass", None)
    held = lloyd.fit_many(df, [1, 2, 7], restarts=2)
    assert [(m.k, m.start, m.rounds) for m in held] == [(m.k, m.start, m.rounds) for m in passes]
    for a, b in zip(held, passes):
        assert np.allclose(a.centres, b.centres, rtol=1e-9, atol=1e-12 * scale) and np.isclose(a.cost, b.cost, rtol=1e-9)


def test_silhouettes_equal_the_evaluators(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    from gridpanel.operators import lloyd
    x, df = _clouds(spark)
    models = list(lloyd.best_of(lloyd.fit_many(df.select("x"), [2, 4, 7], restarts=2)).values())
    models.append(lloyd.Model(3, 0, np.array([x.mean(0), x.mean(0) + 1e4, x[0]])))  # the second has no rows
    models.append(lloyd.Model(2, 0, np.array([x.mean(0), x.mean(0) + 1e4])))  # one cluster only
    got = lloyd.silhouettes(df.select("x").repartition(4), models)
    assert got[-1] is None
    for m, s in zip(models[:-1], got[:-1], strict=True):
        scored = m.transform(df.withColumn("v", array_to_vector("x")), "v")
        assert close(s, ClusteringEvaluator(featuresCol="v", predictionCol="cluster").evaluate(scored), 1e-6)


def test_sweep_over_few_and_equal_rows(spark):
    """More clusters than distinct rows: centres without rows stay, and rows alone in a cluster count 0."""
    df = spark.createDataFrame([([0.0, 0.0],)] * 3 + [([1.0, 1.0],)] * 3 + [([9.0, 9.0],)], "x array<double>")
    scaled = cluster.as_vector(df, "x", "scaled")
    out = {r["k"]: r for r in cluster.silhouette_sweep(scaled, [2, 3, 5], test=scaled.limit(4), restarts=2).collect()}
    assert close(out[3]["train_silhouette"], 6 / 7) and close(out[5]["train_silhouette"], 6 / 7)
    assert out[2]["train_silhouette"] < out[3]["train_silhouette"]
    with pytest.raises(ValueError):
        cluster.kmeans(scaled.where("false"), 2)


def test_component_variance_of_exploded_vectors(spark):
    x, df = _clouds(spark, 80, 4)
    fitted = cluster.pca(cluster.as_vector(df, "x", "scaled"), k=4)
    assert np.allclose(sum(fitted.variance), (x ** 2).sum() / 79 * sum(fitted.share))


def test_forest_draws_are_balanced_and_repeat(spark):
    """Each tree's expected rows per class equal the smaller class, as Poisson counts; no task order matters."""
    from gridpanel.operators import forest
    rnd = np.random.default_rng(6)
    hashes = rnd.integers(-2**63, 2**63 - 1, 22_000)
    means = np.repeat([1.0, 0.1], [2_000, 20_000])
    counts = forest.draws(forest.uniforms(hashes, np.arange(40), 57), means)
    few, many = counts[:2_000].sum(0), counts[2_000:].sum(0)
    assert (abs(few - 2_000) < 6 * 2_000 ** 0.5).all() and (abs(many - 2_000) < 6 * 2_000 ** 0.5).all()
    assert abs(few.mean() - 2_000) < 4 * (2_000 / 40) ** 0.5 and abs(counts[:2_000].var() - 1) < 0.05
    assert abs(np.corrcoef(counts[:, 0], counts[:, 1])[0, 1]) < 0.3 and len(set(map(tuple, counts[:50]))) > 40
    assert (forest.draws(forest.uniforms(hashes[::-1].copy(), np.arange(40), 57), means[::-1]) == counts[::-1]).all()


def test_balanced_forest_on_a_rare_class(spark):
    """A rare class inside a box of two features: found by far most, with the noise column of no importance; reruns agree."""
    rnd = np.random.default_rng(9)
    x = rnd.random((4_000, 3))
    y = ((x[:, 0] > 0.8) & (x[:, 1] < 0.25)).astype(int)
    df = spark.createDataFrame([(i, int(c), *map(float, row)) for i, (c, row) in enumerate(zip(y, x, strict=True))], "id int, y int, a double, b double, c double")
    df = df.unionByName(spark.createDataFrame([(9001, None, 0.5, 0.5, 0.5), (9002, 1, None, 0.5, 0.5), (9003, 7, 0.1, 0.1, 0.1)], df.schema))
    model = classify.balanced_forest(df.repartition(5), "y", ["a", "b", "c"], trees=30, depth=6, key=["id"])
    scored = classify.predict(model, df.where("y in (0, 1)"), ["a", "b", "c"])
    r = classify.classification_report(scored, "y", "predicted").first()
    assert r["true_positive_rate"] > 0.98 and r["accuracy"] > 0.95 and scored.count() == 4_000
    shares = {r["feature"]: r["importance"] for r in classify.feature_importance(spark, model, ["a", "b", "c"]).collect()}
    assert close(sum(shares.values()), 1.0) and shares["c"] < 0.1 < shares["a"]
    again = classify.balanced_forest(df.repartition(3), "y", ["a", "b", "c"], trees=30, depth=6, key=["id"])
    assert [t.arrays()[0].tolist() for t in again.trees] == [t.arrays()[0].tolist() for t in model.trees]
    with pytest.raises(ValueError):
        classify.balanced_forest(df.where("y = 0"), "y", ["a"])


def test_sums_of_many_models_equal_a_plain_count(spark, monkeypatch):
    import numpy as np
    from gridpanel.operators import lloyd
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 3)) + 5
    models = [x[rng.integers(700, size=k)] for k in (2, 2, 7, 12, 13, 13, 40, 600)]
    models[5][1] = models[5][0]  # of equal centres the first takes the rows
    edges = np.cumsum([0, *map(len, models)])
    sums, cost = np.zeros((edges[-1], 5)), np.zeros(len(models))
    lloyd._add_sums(x[:300], np.concatenate(models), edges, sums, cost)
    lloyd._add_sums(x[300:], np.concatenate(models), edges, sums, cost)
    for i, c in enumerate(models):
        far = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        near = far.argmin(axis=1)
        want = np.array([[len(y), (y * y).sum(), *y.sum(axis=0)] for y in (x[near == j] for j in range(len(c)))])
        assert np.allclose(sums[edges[i]:edges[i + 1]], want) and np.isclose(cost[i], far.min(axis=1).sum())
    # Vectors are dealt to the cores, whatever the number of shuffle partitions.
    monkeypatch.setattr(lloyd, "TASK_ROWS", 100)
    df = spark.createDataFrame([(v.tolist(),) for v in x], "a array<double>").selectExpr("a")
    from pyspark.ml.functions import array_to_vector
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        rows_ = lloyd.vectors(df.select(array_to_vector("a").alias("v")), "v")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows_.df.select("_metadata.file_path").distinct().count() == 8 and rows_.df.count() == 700
    rows_.drop()


def test_many_draws_are_sums_of_single_ones():
    from gridpanel.operators import forest

    hashes = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 6_000)
    n = np.repeat([1, 3, 8, 9, 40, 5_000], 1_000)
    counts = forest.many_draws(hashes, n, np.arange(20), 42)
    for mean in np.unique(n):
        own = counts[n == mean].ravel()
        assert abs(own.mean() - mean) < 5 * (mean / 20_000) ** 0.5 and abs(own.var() / mean - 1) < 0.1
    assert abs(np.corrcoef(counts[n == 40].T)[0, 1:]).max() < 0.15
    # Neither the other rows nor the other trees of a call matter.
    assert (forest.many_draws(hashes[::-1].copy(), n[::-1], np.array([4, 11]), 42) == counts[::-1][:, [4, 11]]).all()


def test_random_forest_counts_every_row_but_walks_equal_ones_once(spark, monkeypatch):
    """80,000 rows that agree in few intervals are few rows to the trees, and weigh what they are."""
    from gridpanel.operators import forest

    stored, seen = forest.Stored, []

    class Seen(stored):
        def __init__(self, df):
            super().__init__(df)
            seen.append(self.df.agg(F.count(F.lit(1)), F.sum("n")).first())

    monkeypatch.setattr(forest, "Stored", Seen)
    df = spark.range(80_000).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"), (F.col("id") % 7 >= 3).cast("int").alias("y"))
    model = classify.random_forest(df, "y", ["a", "b"], trees=8)
    assert tuple(seen[0]) == (77, 80_000)
    r = classify.classification_report(classify.predict(model, df, ["a", "b"]), "y", "predicted").first()
    assert r["accuracy"] == 1.0 and r["tp"] + r["tn"] == 80_000
    again = classify.random_forest(df.repartition(3), "y", ["a", "b"], trees=8)
    assert [t.arrays()[1].tolist() for t in again.trees] == [t.arrays()[1].tolist() for t in model.trees]


def test_random_forest_of_three_classes(spark):
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(3_000, 4))
    y = (x[:, 0] > 0).astype(int) + ((x[:, 0] > 0) & (x[:, 1] > 0.3))
    df = spark.createDataFrame([(int(c), *map(float, row)) for c, row in zip(y, x, strict=True)], "y int, a double, b double, c double, d double").repartition(4)
    df = df.unionByName(spark.createDataFrame([(1, None, 0.0, 0.0, 0.0), (None, float("nan"), 0.0, 0.0, 0.0)], df.schema))
    names = ["a", "b", "c", "d"]
    model = classify.random_forest(df, "y", names, trees=20, depth=6)
    scored = classify.predict(model, df, names)
    assert scored.columns == [*df.columns, "score", "predicted"] and scored.count() == 3_000
    assert scored.where("y = predicted").count() > 2_850 and scored.where("score between 0 and 1").count() == 3_000
    few = classify.random_forest(df, "y", names[:2], trees=5, depth=4, bins=8)  # a table of scores
    bins = forest_bins(few, x[:, :2])
    from gridpanel.operators import forest
    walked = sum(t.arrays()[4][forest._places(t.arrays(), bins)] for t in few.trees) / 5
    found = classify.predict(few, df.where("a is not null and not isnan(a)").select("a", "b"), names[:2]).select("a", "score").collect()
    want = dict(zip(x[:, 0].tolist(), walked[:, 1].tolist(), strict=True))
    assert all(close(r["score"], want[r["a"]]) for r in found)
    for bad in (df.where("y = 0"), df.withColumn("y", F.lit(None).cast("int")), df.withColumn("y", F.col("y") - 0.5)):
        with pytest.raises(ValueError):
            classify.random_forest(bad, "y", names)


def forest_bins(model, x):
    from gridpanel.operators import forest

    return forest._binned(x, model.cuts)
