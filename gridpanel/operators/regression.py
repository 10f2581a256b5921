"""Lasso, panel regression and ordinary least squares from aggregated sums.

Every fit reads the data once into sums and cross-products; only systems of the
size of the column list are solved outside Spark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.functions.distributions import normal_two_sided, t_quantile, t_two_sided
from gridpanel.functions.expressions import quoted, ratio
from gridpanel.operators.features import vif
from gridpanel.operators.joins import entity_value
from gridpanel.operators.moments import Moments, column_means, independent, moments, moments_by_fold
from gridpanel.operators.ordered import exact_quantiles, to_long
from gridpanel.operators.panel_fit import PanelRows
from gridpanel.operators.windows import over_series

# --- lasso ----------------------------------------------------------------------


@dataclass
class FoldMoments:
    """Cross-products of all columns per fold; any outcome can be fitted from them."""

    columns: list[str]
    folds: list[Moments]
    total: Moments


def fold_moments(
    df: DataFrame, columns: Sequence[str], fold_keys: Sequence[str], folds: int = 5, seed: int = 15215
) -> FoldMoments:
    """Complete rows only, one pass. Folds are drawn by hash of the row's keys."""
    complete = df.dropna(subset=list(columns)).withColumn(
        "__fold", F.pmod(F.xxhash64(*fold_keys, F.lit(seed)), F.lit(folds)).cast("int")
    )
    centre = column_means(complete, columns)
    found = moments_by_fold(complete, columns, centre, "__fold")
    parts = [found[f] for f in sorted(found)]
    return FoldMoments(list(columns), parts, reduce(Moments.__add__, parts))


def _descend(gram: np.ndarray, xy: np.ndarray, alpha: float, start: np.ndarray,
             rounds: int = 10_000, tolerance: float = 1e-9) -> np.ndarray:
    """Coordinate descent for 1/2 b'Gb - b'c + alpha |b|.

    Now and then the equations of the coefficients that are not zero are solved
    outright; a solution that meets the optimality conditions is the answer.
    """
    b = start.copy()
    for turn in range(rounds):
        if turn % 4 == 3:
            exact = _active_solution(gram, xy, alpha, b)
            if exact is not None:
                return exact
        largest = 0.0
        for j in range(len(b)):
            if gram[j, j] <= 0:
                continue
            old = b[j]
            rho = xy[j] - gram[j] @ b + gram[j, j] * old
            b[j] = math.copysign(max(abs(rho) - alpha, 0.0), rho) / gram[j, j]
            largest = max(largest, abs(b[j] - old))
        if largest <= tolerance * max(1.0, float(np.abs(b).max(initial=0.0))):
            break
    return b


def _active_solution(gram: np.ndarray, xy: np.ndarray, alpha: float, b: np.ndarray) -> np.ndarray | None:
    """The optimum if the signs of ``b`` are right, else nothing."""
    active = np.flatnonzero(b)
    signs = np.sign(b[active])
    try:
        found = np.linalg.solve(gram[np.ix_(active, active)], xy[active] - alpha * signs)
    except np.linalg.LinAlgError:
        return None
    out = np.zeros(len(b))
    out[active] = found
    rest = xy - gram @ out
    rest[active] = 0.0
    right = np.isfinite(found).all() and (np.sign(found) == signs).all() and (np.abs(rest) <= alpha * (1 + 1e-9)).all()
    return out if right else None


def _scaled(m: Moments, x: list[int], y: int, mean: np.ndarray, scale: np.ndarray):
    """Centred products per row, of the columns divided by ``scale``."""
    g = m.products - np.outer(m.sums, mean) - np.outer(mean, m.sums) + m.n * np.outer(mean, mean)
    g = g / m.n / np.outer(scale, scale)
    return g[np.ix_(x, x)], g[x, y], g[y, y]


def lasso_from_moments(
    fm: FoldMoments, y: str, x: Sequence[str], alphas: int = 100, ratio_to_max: float = 1e-3
) -> list[tuple[str, float]]:
    """L1 path with the penalty chosen by cross-validated squared error.

    Predictors are z-scores over all rows. Returns (feature, coefficient) sorted
    by size, zeros left out.
    """
    place = {c: i for i, c in enumerate(fm.columns)}
    xi, yi = [place[c] for c in x], place[y]
    scale = np.sqrt(np.diag(fm.total.centred) / fm.total.n)
    scale[scale <= 1e-12] = 1.0
    scale[yi] = 1.0
    gram, xy, _ = _scaled(fm.total, xi, yi, fm.total.mean, scale)
    largest = float(np.abs(xy).max(initial=0.0))
    if largest == 0.0:
        return []
    path = np.geomspace(largest, largest * ratio_to_max, alphas)
    errors = np.zeros(alphas)
    used = [f for f in fm.folds if f.n > 0]
    for fold in used:
        rest = fm.total - fold
        if rest.n < 2:
            continue
        g, c, _ = _scaled(rest, xi, yi, rest.mean, scale)
        gt, ct, yy = _scaled(fold, xi, yi, rest.mean, scale)
        b = np.zeros(len(xi))
        for i, alpha in enumerate(path):
            b = _descend(g, c, alpha, b, tolerance=1e-6)
            errors[i] += (yy - 2 * b @ ct + b @ gt @ b) / len(used)
    best = path[int(np.argmin(errors))]
    b = _descend(gram, xy, best, np.zeros(len(xi)))
    out = [(c, float(v)) for c, v in zip(x, b, strict=True) if v != 0.0]
    return sorted(out, key=lambda cv: (-abs(cv[1]), cv[0]))


COEFS = "outcome string, feature string, coef double, abs_coef double, position int"


def _coef_rows(outcome: str, found: Sequence[tuple[str, float]]) -> list[tuple]:
    return [(outcome, c, v, abs(v), i) for i, (c, v) in enumerate(found)]


def lasso_cv(df: DataFrame, y: str, x: Sequence[str], fold_keys: Sequence[str], folds: int = 5) -> DataFrame:
    fm = fold_moments(df, [y, *x], fold_keys, folds)
    return df.sparkSession.createDataFrame(_coef_rows(y, lasso_from_moments(fm, y, x)), COEFS)


def double_lasso(
    fm: FoldMoments, y: str, x: Sequence[str], treatments: Sequence[str]
) -> list[tuple[str, float]]:
    """Features chosen for the outcome or for any treatment; the first choice counts."""
    chosen: dict[str, float] = {}
    for target in [y, *treatments]:
        others = [c for c in x if c != target and not (target in treatments and c == y)]
        for c, v in lasso_from_moments(fm, target, others):
            chosen.setdefault(c, v)
    return list(chosen.items())


GROUPS = ("dc", "dc_density", "size", "population", "economy", "environment", "permit", "sector")


def select_features(
    coefs: DataFrame, rules: Mapping[str, Sequence[str]], include_information: bool = False
) -> DataFrame:
    """Apply the grouping rules to the lasso output of any number of outcomes.

    ``rules`` maps a group of ``GROUPS`` to its features. Densities are used as a
    whole when no count or size was chosen but a density was (or when there are
    no counts); otherwise all counts plus the best size. Of environment and
    permits the best one; of population, economy and sectors all chosen ones.
    """
    spark = coefs.sparkSession
    listed = [(g, f, i) for i, (g, f) in enumerate((g, f) for g in GROUPS for f in rules.get(g, ()))]
    groups = F.broadcast(spark.createDataFrame(listed, "grp string, feature string, rule_order int"))
    outcomes = coefs.select("outcome").distinct()
    # Every outcome meets the fixed rule list.
    grid = outcomes.withColumn("__one", F.lit(1)).join(groups.withColumn("__one", F.lit(1)), "__one").drop("__one")
    rows = grid.join(coefs.select("outcome", "feature", "abs_coef"), ["outcome", "feature"], "left")
    hit = F.col("abs_coef").isNotNull()

    def any_of(*names: str) -> Column:
        return F.max(F.when(F.col("grp").isin(*names) & hit, 1).otherwise(0))

    flags = rows.groupBy("outcome").agg(
        any_of("dc", "size").alias("__counts"), any_of("dc_density").alias("__density")
    )
    best = Window.partitionBy("outcome", "grp").orderBy(F.col("abs_coef").desc_nulls_last(), "rule_order")
    rows = rows.join(flags, "outcome").withColumn("__rank", F.row_number().over(best))
    dense = F.lit(True) if not rules.get("dc") else (F.col("__counts") == 0) & (F.col("__density") == 1)
    one = hit & (F.col("__rank") == 1)
    allowed = F.lit(True) if include_information else ~F.col("feature").contains("information")
    keep = (
        F.when(F.col("grp") == "dc_density", dense)
        .when(F.col("grp") == "dc", ~dense)
        .when(F.col("grp") == "size", ~dense & one if rules.get("dc") else F.lit(False))
        .when(F.col("grp").isin("environment", "permit"), one)
        .when(F.col("grp") == "sector", hit & allowed)
        .otherwise(hit)
    )
    return rows.where(keep).select("outcome", "feature", "grp", "rule_order")


# --- least squares ----------------------------------------------------------------


@dataclass
class Fit:
    """Estimates of one regression and the sums behind them."""

    outcome: str
    terms: list[str]
    coef: np.ndarray
    cov: np.ndarray
    n: int
    df_resid: int
    r2: float
    rss: float
    tss: float
    k: int
    dummies: dict = field(default_factory=dict)
    r2_overall: float = math.nan
    use_t: bool = True

    def table(self, spark) -> DataFrame:
        rows = []
        for i, term in enumerate(self.terms):
            se = math.sqrt(max(float(self.cov[i, i]), 0.0))
            stat = float(self.coef[i]) / se if se > 0 else math.nan
            if self.use_t:
                p, q = t_two_sided(stat, self.df_resid), t_quantile(0.975, self.df_resid)
            else:
                p, q = normal_two_sided(stat), 1.959963984540054
            rows.append((self.outcome, term, float(self.coef[i]), se, stat, p,
                         float(self.coef[i] - q * se), float(self.coef[i] + q * se)))
        return spark.createDataFrame(
            rows, "outcome string, term string, coef double, std_err double, stat double, "
                  "p_value double, ci_low double, ci_high double")

    def summary_row(self) -> tuple:
        loglik = -self.n / 2.0 * (math.log(2 * math.pi) + math.log(max(self.rss, 1e-300) / self.n) + 1.0)
        adjusted = 1.0 - (1.0 - self.r2) * (self.n - 1) / max(self.df_resid, 1)
        return (self.outcome, self.r2, adjusted, 2 * self.k - 2 * loglik,
                math.log(self.n) * self.k - 2 * loglik, self.n)


def _solve(gram: np.ndarray, xy: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    kept = independent(gram)
    inverse = np.linalg.inv(gram[np.ix_(kept, kept)])
    return kept, inverse @ xy[kept], inverse


def with_dummies(df: DataFrame, column: str, levels: Sequence, first: int = 1) -> tuple[DataFrame, list]:
    """0/1 columns for the levels of a column, the first level left out."""
    names = {f"C({column})[{v}]": v for v in levels[first:]}
    return df.withColumns({n: (F.col(quoted(column)) == F.lit(v)).cast("double") for n, v in names.items()}), list(names)


def levels_of(df: DataFrame, column: str) -> list:
    """Distinct levels of a period column; there are few by design."""
    return [r[0] for r in df.select(column).distinct().orderBy(column).collect() if r[0] is not None]


def ols(df: DataFrame, y: str, x: Sequence[str], dummies: str | None = None) -> Fit:
    """Pooled least squares with an intercept and optional level dummies."""
    data = df.dropna(subset=[y, *x, *([dummies] if dummies else [])])
    terms = list(x)
    if dummies:
        data, names = with_dummies(data, dummies, levels_of(data, dummies))
        terms += names
    m, centre = moments(data, [*terms, y], centre=True)
    k = len(terms)
    g = m.centred
    kept, beta, inverse = _solve(g[:k, :k], g[:k, k])
    rss = float(g[k, k] - beta @ g[kept, k])
    n, p = int(m.n), len(kept) + 1
    sigma2 = rss / (n - p)
    mean = np.array(centre) + m.mean
    intercept = mean[k] - beta @ mean[kept]
    cov = np.zeros((p, p))
    cov[1:, 1:] = inverse * sigma2
    cov[0, 0] = sigma2 * (1.0 / n + mean[kept] @ inverse @ mean[kept])
    return Fit(y, ["Intercept", *[terms[i] for i in kept]], np.concatenate([[intercept], beta]), cov, n, n - p,
               1.0 - rss / float(g[k, k]) if g[k, k] > 0 else math.nan, rss, float(g[k, k]), p)


def panel_ols(
    df: DataFrame, y: str, x: Sequence[str], entity: str, time: str,
    entity_fe: bool = True, time_fe: bool = True,
) -> Fit:
    """Fixed-effects regression with errors clustered by entity; see ``panel_ols_many``."""
    return panel_ols_many(df, {y: x}, entity, time, entity_fe, time_fe)[y]


def panel_ols_many(
    df: DataFrame, models: Mapping[str, Sequence[str]], entity: str, time: str,
    entity_fe: bool = True, time_fe: bool = True,
) -> dict[str, Fit]:
    """Fixed-effects regressions of several outcomes, each on its own regressors and complete rows.

    Two passes over the rows serve all outcomes (``panel_fit``): products and sums
    per entity, then score sums per entity. Period effects are dummies. Errors are
    clustered by entity, the covariance is scaled by n/(n-k). Exact on unbalanced
    panels. An outcome without complete rows has no fit.
    """
    rows = PanelRows(df, models, entity, time, time_fe)
    try:
        sums = rows.sums()
        solved, means = {}, {}
        for y, m in sums.items():
            place = rows.place(y)
            k = len(place) - 1
            g = m.products - (m.between if entity_fe else np.outer(m.sums, m.sums) / m.n)
            kept, beta, inverse = _solve(g[:k, :k], g[:k, k])
            solved[y] = g, kept, beta, inverse
            means[y] = m.sums / m.n
        full = {y: np.zeros(len(rows.place(y)) - 1) for y in solved}
        for y, (_, kept, beta, _) in solved.items():
            full[y][kept] = beta
        meats = rows.meats(full, None if entity_fe else means)
    finally:
        rows.drop()
    fits = {}
    for y, (g, kept, beta, inverse) in solved.items():
        x, m, k = list(models[y]), sums[y], len(g) - 1
        terms = [*x, *[f"C({time})[{v}]" for v in rows.levels[1:]]]
        rss = float(g[k, k] - beta @ g[kept, k])
        cov = inverse @ meats[y][np.ix_(kept, kept)] @ inverse * (m.n / max(m.n - len(kept), 1))
        overall = float(m.products[k, k] - m.sums[k] ** 2 / m.n)
        shown = [i for i in kept if i < len(x)]
        at = [kept.index(i) for i in shown]
        fits[y] = Fit(
            y, [terms[i] for i in shown], beta[at], cov[np.ix_(at, at)], m.n, m.n - (m.entities if entity_fe else 1) - len(kept),
            1.0 - rss / float(g[k, k]) if g[k, k] > 0 else math.nan, rss, float(g[k, k]), len(kept),
            dummies={terms[i]: float(b) for i, b in zip(kept, beta, strict=True) if i >= len(x)},
            r2_overall=1.0 - rss / overall if overall > 0 else math.nan, use_t=False,
        )
    return fits


def effect_table(
    fit: Fit, df: DataFrame, upper: float = 0.90, lower: float = 0.10, marker: str = "datacenter", **how
) -> DataFrame:
    """Predicted change when a term moves from its lower to its upper quantile."""
    terms = [t for t in fit.terms if t != "Intercept" and not t.startswith("C(")]
    spark = df.sparkSession
    long = to_long(df, [], terms, "term", "value")
    shifts = exact_quantiles(long, ["term"], "value", {"p_low": lower, "p_high": upper}, **how)
    out = fit.table(spark).join(shifts, "term").withColumn("x_shift", F.col("p_high") - F.col("p_low"))
    out = out.withColumns({
        "effect": F.col("coef") * F.col("x_shift"),
        "effect_low": F.col("ci_low") * F.col("x_shift"),
        "effect_high": F.col("ci_high") * F.col("x_shift"),
    })
    return out.select(
        "outcome", "term", "coef", "p_value", "p_low", "p_high", "x_shift", "effect", "effect_low", "effect_high",
        F.lower("term").contains(marker).alias("is_datacenter"),
        (~((F.col("effect_low") <= 0) & (F.col("effect_high") >= 0))).alias("is_significant"),
    )


def compare_models(spark, fits: Mapping[str, Fit]) -> DataFrame:
    """Fit measures per model, best AIC first."""
    rows = sorted(((name, *fit.summary_row()[1:]) for name, fit in fits.items()), key=lambda r: r[3])
    return spark.createDataFrame(
        rows, "model string, r2 double, adj_r2 double, aic double, bic double, nobs long")


def residuals(
    df: DataFrame, fit: Fit, entity: str | None = None, time: str | None = None
) -> DataFrame:
    """``fitted`` and ``residual`` per complete row.

    With an entity the residual is taken within it: the entity's mean rest is
    its effect. That mean is a group-by joined back.
    """
    terms = [t for t in fit.terms if t != "Intercept"]
    plain = [t for t in terms if not t.startswith("C(")]
    data = df.dropna(subset=[fit.outcome, *plain])
    value = F.lit(float(fit.coef[fit.terms.index("Intercept")])) if "Intercept" in fit.terms else F.lit(0.0)
    for t, b in zip(fit.terms, fit.coef, strict=True):
        if t in plain:
            value = value + F.col(quoted(t)).cast("double") * float(b)
    levels = dict(fit.dummies)
    levels.update({t: float(b) for t, b in zip(fit.terms, fit.coef, strict=True) if t.startswith("C(")})
    if time and levels:
        pairs = [F.lit(v) for t, b in levels.items() for v in (t[t.index("[") + 1:-1], b)]
        value = value + F.coalesce(F.create_map(*pairs)[F.col(time).cast("string")], F.lit(0.0))
    out = data.withColumn("fitted", value)
    rest = F.col(quoted(fit.outcome)).cast("double") - F.col("fitted")
    out = out.withColumn("residual", rest)
    if entity:
        out = entity_value(out, entity, F.avg("residual"), "__effect")
        out = out.withColumns({"residual": F.col("residual") - F.col("__effect"),
                               "fitted": F.col("fitted") + F.col("__effect")}).drop("__effect")
    return out


def durbin_watson(df: DataFrame, residual: str, order: Sequence[str], **how) -> DataFrame:
    """Serial correlation of residuals over a stated order, as a one-row frame.

    The order is global, so the series is cut into blocks and every block gets
    the row before it.
    """
    rows = df.select(*order, F.col(residual).cast("double").alias("__e"), F.lit(0).alias("__all"))
    stepped = over_series(rows, ["__all"], list(order), lambda w: {"__p": F.lag("__e").over(w)}, depth=1, **how)
    step = F.col("__e") - F.col("__p")
    return stepped.agg(ratio(F.sum(step * step), F.sum(F.col("__e") * F.col("__e"))).alias("durbin_watson"))


def run_outcomes(
    df: DataFrame,
    outcomes: Sequence[str],
    x: Sequence[str],
    treatments: Sequence[str],
    rules: Mapping[str, Sequence[str]],
    entity: str,
    time: str,
    exclude: Mapping[str, Sequence[str]] | None = None,
    include_information: bool = False,
) -> tuple[DataFrame, dict[str, Fit]]:
    """Double lasso, grouping rules and panel regression for a list of outcomes.

    The lasso fits of all outcomes share one pass over the data, and the
    regressions on their selected terms two more.
    """
    exclude = exclude or {}
    columns = list(dict.fromkeys([*outcomes, *x, *treatments]))
    fm = fold_moments(df, columns, [entity, time])
    coef_rows = []
    for y in outcomes:
        usable = [c for c in dict.fromkeys([*x, *treatments]) if c != y and c not in exclude.get(y, ())]
        coef_rows += _coef_rows(y, double_lasso(fm, y, usable, treatments))
    coefs = df.sparkSession.createDataFrame(coef_rows, COEFS)
    chosen: dict[str, list[str]] = {}
    for r in select_features(coefs, rules, include_information).orderBy("outcome", "rule_order").collect():
        if r["feature"] != r["outcome"]:
            chosen.setdefault(r["outcome"], []).append(r["feature"])
    found = panel_ols_many(df, {y: terms for y, terms in chosen.items() if terms}, entity, time)
    fits = {y: found[y] for y in outcomes if y in found}
    tables = [fit.table(df.sparkSession) for fit in fits.values()]
    return reduce(DataFrame.unionByName, tables), fits


def regression_vif(df: DataFrame, y: str, x: Sequence[str]) -> DataFrame:
    """Variance inflation of the terms of a regression, with a constant."""
    return vif(df.dropna(subset=[y, *x]), x, intercept=True)
