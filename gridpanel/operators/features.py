"""Profiling, column selection, transforms and splits (F1-F16)."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpanel.functions.expressions import (
    adjusted_skew, half_even, normal_quantile, numeric_columns, quoted, ratio, safe_ln,
)
from gridpanel.operators.moments import Moments, column_means, merged_arrays, moments
from gridpanel.operators.skew import null_safe
from gridpanel.operators.ordered import exact_quantiles, quantile_grid, ranked_values, running, to_long, value_counts
from gridpanel.operators.vector_neighbors import knn_vectors


def _rows(df: DataFrame, columns: Sequence[str], stats) -> DataFrame:
    """One pass over ``df``; one output row per column with the stats it names."""
    row = df.agg(F.array(*[
        F.struct(F.lit(c).alias("column"), *[s.alias(n) for n, s in stats(F.col(quoted(c)).cast("double")).items()])
        for c in columns
    ]).alias("r"))
    return row.select(F.inline("r"))


def distinct_values(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Number of distinct non-null values per column."""
    if not exact:
        return _rows(df, columns, lambda c: {"n_unique": F.approx_count_distinct(c)})
    long = to_long(df, [], columns, "column", "value").where("value IS NOT NULL").distinct()
    return long.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))


def profile(
    df: DataFrame, columns: Sequence[str] | None = None, acceptable_skew: float = 3.0, exact: bool = True
) -> DataFrame:
    """Missing share, distinct values, spread, skew, zeros, range and a suggested transform."""
    columns = list(columns or numeric_columns(df))

    def stats(c: Column) -> dict[str, Column]:
        rows = F.count(F.lit(1))
        return {
            "missing_share": ratio(F.count_if(c.isNull()), rows),
            "std": half_even(F.stddev_samp(c), 3),
            "skew": half_even(adjusted_skew(c), 3),
            "n_zeros": F.count_if(c == 0),
            "zero_share": half_even(ratio(F.count_if(c == 0), rows), 3),
            "min": half_even(F.min(c), 3),
            "max": half_even(F.max(c), 3),
        }

    out = _rows(df, columns, stats).join(distinct_values(df, columns, exact), "column", "left")
    out = out.withColumn("n_unique", F.coalesce("n_unique", F.lit(0)))
    can_log = F.coalesce(F.col("min") > 0, F.lit(False))
    skewed = F.coalesce(F.col("skew") > acceptable_skew, F.lit(False))
    return out.withColumns({
        "can_log": can_log,
        "suggested_transform": F.when(can_log & skewed, "log")
        .when(~can_log & (F.col("zero_share") > 0) & skewed, "log1p").otherwise("none"),
    })


def apply_transforms(df: DataFrame, suggestions: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Apply a profile's transforms and rename to ``col_log`` or ``col_log1p``."""
    wanted = {
        r["column"]: r["suggested_transform"]
        for r in suggestions.select("column", "suggested_transform").collect()
        if r["column"] not in exclude and r["suggested_transform"] != "none"
    }
    out = []
    for c in df.columns:
        kind = wanted.get(c)
        x = F.col(quoted(c))
        if kind == "log":
            out.append(safe_ln(x).alias(f"{c}_log"))
        elif kind == "log1p":
            out.append(F.log1p(x.cast("double")).alias(f"{c}_log1p"))
        else:
            out.append(x)
    return df.select(*out)


def vif(df: DataFrame, columns: Sequence[str], intercept: bool = False) -> DataFrame:
    """Variance inflation per column from one pass of cross-products."""
    m, _ = moments(df.dropna(subset=list(columns)), columns, centre=intercept)
    return df.sparkSession.createDataFrame(
        list(zip(columns, [float(v) for v in _vif(m, intercept)], strict=True)), "column string, vif double"
    )


def _vif(m: Moments, intercept: bool) -> np.ndarray:
    g = m.centred if intercept else m.products
    scale = np.sqrt(np.diag(g))
    scale[scale == 0] = 1.0
    g = g / np.outer(scale, scale)
    out = []
    for j in range(len(g)):
        others = [i for i in range(len(g)) if i != j]
        explained = g[j, others] @ np.linalg.pinv(g[np.ix_(others, others)], hermitian=True) @ g[others, j]
        rest = 1.0 - explained
        # A column the others determine has no finite factor.
        out.append(1.0 / rest if rest > 1e-10 else np.inf)
    return np.array(out)


def normality_columns(n: Column, skew: Column, kurtosis: Column) -> dict[str, Column]:
    """D'Agostino-Pearson statistic and p-value from population skew and kurtosis."""
    y = skew * F.sqrt(ratio((n + 1) * (n + 3), 6.0 * (n - 2)))
    beta = ratio(
        3.0 * (n * n + 27.0 * n - 70.0) * (n + 1) * (n + 3), (n - 2) * (n + 5) * (n + 7) * (n + 9)
    )
    w2 = F.sqrt(2.0 * (beta - 1.0)) - 1.0
    z1 = ratio(F.asinh(ratio(y, F.sqrt(ratio(F.lit(2.0), w2 - 1.0)))), F.sqrt(0.5 * safe_ln(w2)))
    b2 = kurtosis + 3.0
    spread = ratio(24.0 * n * (n - 2) * (n - 3), (n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = ratio(b2 - ratio(3.0 * (n - 1), n + 1), F.sqrt(spread))
    s = ratio(6.0 * (n * n - 5.0 * n + 2.0), (n + 7) * (n + 9)) * F.sqrt(
        ratio(6.0 * (n + 3) * (n + 5), n * (n - 2) * (n - 3))
    )
    a = 6.0 + ratio(F.lit(8.0), s) * (ratio(F.lit(2.0), s) + F.sqrt(1.0 + ratio(F.lit(4.0), s * s)))
    inner = ratio(1.0 - ratio(F.lit(2.0), a), 1.0 + x * F.sqrt(ratio(F.lit(2.0), a - 4.0)))
    z2 = ratio(1.0 - ratio(F.lit(2.0), 9.0 * a) - F.cbrt(inner), F.sqrt(ratio(F.lit(2.0), 9.0 * a)))
    k2 = z1 * z1 + z2 * z2
    enough = n >= 8
    return {"k2": F.when(enough, k2), "p_value": F.when(enough, F.exp(k2 * -0.5))}


def normality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Normality test per column; NULL below eight values."""
    out = _rows(df, columns, lambda c: {
        "n": F.count(c), "skew": F.skewness(c), "kurtosis": F.kurtosis(c)
    })
    n = F.col("n").cast("double")
    return out.withColumns(normality_columns(n, F.col("skew"), F.col("kurtosis")))


def select_columns(
    df: DataFrame,
    no_na: bool = False,
    vif_cut: float = 5.0,
    sd_cut: float = 3.0,
    only_normal: bool = False,
    preserve: Sequence[str] = (),
) -> tuple[list[str], DataFrame]:
    """Columns that pass the missing, collinearity, outlier and normality checks.

    The checks run one after the other on the columns left so far; a negative
    cut skips a check. Columns that are not numeric and preserved ones are kept.
    Returns the list and a report (dropped_col, reason).
    """
    checked = df.drop(*preserve)
    numeric = numeric_columns(checked)
    others = [c for c in checked.columns if c not in numeric]
    keep, dropped = list(numeric), []

    def apply(fails: dict[str, str]) -> None:
        nonlocal keep
        dropped.extend((c, fails[c]) for c in keep if c in fails)
        keep = [c for c in keep if c not in fails]

    if no_na and keep:
        gaps = {r["column"] for r in _rows(checked, keep, lambda c: {"g": F.count_if(c.isNull())}).where("g > 0").collect()}
        apply({c: "contained NA values" for c in gaps})
    complete = checked.select(*[F.col(quoted(c)) for c in keep]).dropna()
    if keep and (sd_cut > 0 or only_normal):
        stats = {r["column"]: r for r in _rows(complete, keep, lambda c: {
            "mean": F.avg(c), "sd": F.stddev_samp(c), "lo": F.min(c), "hi": F.max(c),
            "n": F.count(c), "skew": F.skewness(c), "kurtosis": F.kurtosis(c),
        }).withColumns(normality_columns(F.col("n").cast("double"), F.col("skew"), F.col("kurtosis"))).collect()}
    if vif_cut > 0 and keep:
        m, _ = moments(complete, keep)
        apply({c: f"high VIF ({v:.2f})" for c, v in zip(keep, _vif(m, False), strict=True) if not v < vif_cut})
    if sd_cut > 0:
        def inside(r) -> bool:
            if r["mean"] is None or r["sd"] is None:
                return r["mean"] is None
            return r["lo"] > r["mean"] - sd_cut * r["sd"] and r["hi"] < r["mean"] + sd_cut * r["sd"]
        apply({c: f"exceeded {sd_cut} SD outliers" for c in keep if not inside(stats[c])})
    if only_normal:
        def normal(r) -> bool:
            return (r["p_value"] is not None and r["p_value"] > 0.05) or abs(r["skew"] or 0.0) < 1
        apply({
            c: f"non-normal (skew={abs(stats[c]['skew']):.2f}, p={(stats[c]['p_value'] or 0.0):.4f})"
            for c in keep if not normal(stats[c])
        })
    report = df.sparkSession.createDataFrame(dropped, "dropped_col string, reason string")
    return others + list(preserve) + keep, report


def _batch(columns: pa.RecordBatch) -> np.ndarray:
    """The doubles of a batch, one row per column, NaN where there is no value."""
    return np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in columns.columns])


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(quoted(c)).cast("double").alias(f"x{j}") for j, c in enumerate(columns)])


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns over their complete rows, NULL without spread.

    After the means, one scan makes the sums of all pairs from a few matrix
    products per batch, whatever the number of columns. NaN counts as missing.
    """
    columns, k = list(columns), len(columns)
    centre = np.array(column_means(df, columns))[:, None]

    def sums(batches):
        total = np.zeros((4, k, k))
        for batch in batches:
            x = _batch(batch) - centre
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, nan=0.0, posinf=np.inf, neginf=-np.inf)
            total += np.stack([there @ there.T, x @ there.T, (x * x) @ there.T, x @ x.T])
        return {0: total.ravel()}

    n, s, q, p = merged_arrays(_doubles(df, columns), sums, 1).get(0, np.zeros(4 * k * k)).reshape(4, k, k)
    with np.errstate(all="ignore"):
        spread = q - s * s / n
        corr = (p - s * s.T / n) / np.sqrt(spread * spread.T)
        corr[~(spread > 1e-13 * q) | ~(spread > 1e-13 * q).T] = np.nan
    rows = [(a, b, float(corr[i, j]) if np.isfinite(corr[i, j]) else None) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double")


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe(
    df: DataFrame, columns: Sequence[str], groups: Sequence[str] = (), digits: int = 2, exact: bool = True, **how
) -> DataFrame:
    """Count, mean, deviation, range, quartiles and missing values per column (and group).

    Exact quartiles cost an exchange of the distinct values; ``exact=False``
    reads them off a sketch in the same pass as the rest.
    """
    long = to_long(df, groups, columns, "column", "value")
    keys = [*groups, "column"]
    basic = long.groupBy(*keys).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.count_if(F.col("value").isNull()).alias("missing"),
        ratio(F.count_if(F.col("value").isNull()), F.count(F.lit(1))).alias("missing_share"),
        *([] if exact else [F.percentile_approx("value", q, 10_000).alias(n) for n, q in QUARTILES.items()]),
    )
    out = basic
    if exact:
        quartiles = exact_quantiles(long, keys, "value", QUARTILES, **how).drop("n_values")
        out = basic.join(quartiles, keys, "left")
    rounded = {c: half_even(c, digits) for c in ("mean", "std", "min", "max", *QUARTILES)}
    return out.withColumns(rounded)


def histogram(df: DataFrame, column: str, bins: int, log: bool = False) -> DataFrame:
    """Equal-width bins over the range (of log10 with ``log``), the last one closed."""
    x = F.col(quoted(column)).cast("double")
    x = F.when(x > 0, F.log10(x)) if log else x
    values = df.select(x.alias("x"), F.lit(1).alias("__one")).where("x IS NOT NULL")
    ends = values.groupBy("__one").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.least(F.floor(ratio((F.col("x") - F.col("lo")) * float(bins), F.col("hi") - F.col("lo"))), F.lit(bins - 1))
    return (
        values.join(F.broadcast(ends), "__one")
        .groupBy(F.coalesce(place, F.lit(0)).cast("int").alias("bin"), "lo", "hi")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (F.col("lo") + F.col("bin") * width).alias("bin_from"),
                (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_to"), "n")
    )


def qq_points(df: DataFrame, column: str, **how) -> DataFrame:
    """Standardised sample values against normal quantiles, one row per distinct value."""
    x = df.select(F.col(quoted(column)).cast("double").alias("value")).where("value IS NOT NULL")
    ranks = ranked_values(x, [], "value", **how).withColumn("__one", F.lit(1))
    stats = x.withColumn("__one", F.lit(1)).groupBy("__one").agg(
        F.count(F.lit(1)).alias("__n"), F.avg("value").alias("__m"), F.stddev_pop("value").alias("__s")
    )
    return ranks.join(F.broadcast(stats), "__one").select(
        "value", "n",
        normal_quantile(ratio(F.col("avg_rank") - 0.5, F.col("__n"))).alias("theoretical"),
        ratio(F.col("value") - F.col("__m"), F.col("__s")).alias("sample"),
    )


def scaler(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with mean and population deviation per column."""
    return train.agg(*[f(F.col(quoted(c)).cast("double")).alias(f"__{t}{i}")
                       for i, c in enumerate(columns) for t, f in (("m", F.avg), ("s", F.stddev_pop))])


def standardize(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """z-scores with the training rows' mean and deviation; constant columns are only centred."""
    fitted = scaler(train if train is not None else df, columns).withColumn("__one", F.lit(1))
    out = df.withColumn("__one", F.lit(1)).join(F.broadcast(fitted), "__one", "left")
    out = out.withColumns({
        c: (F.col(quoted(c)).cast("double") - F.col(f"__m{i}"))
        / F.when(F.col(f"__s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"__s{i}"))
        for i, c in enumerate(columns)
    })
    return out.drop("__one", *[f"__{t}{i}" for i in range(len(columns)) for t in "ms"])


EDGE = 1e-7


def quantile_normalize(
    df: DataFrame, column: str, out: str | None = None, points: int | None = 1000, train: DataFrame | None = None, **how
) -> DataFrame:
    """Map a column to a normal shape through its own empirical distribution.

    The distribution is a grid of ``points`` exact quantiles (of ``train`` if it is
    given), and a value gets the share interpolated between its neighbours in the
    grid, the middle of them where several are equal; what lies at the grid's ends
    or beyond gets share 0 or 1, a column of one value 0.5. A share is at most
    1/(points - 1) off the whole distribution's, but at the ends: copies of the
    smallest or largest value get 0 or 1 however many they are. Rows are not
    moved: the grid travels with the scan. ``points=None`` takes the whole distribution, which
    joins the rows with their ranked values; there equal values get the middle of
    their ranks.

    The share is kept away from 0 and 1, so the ends of the range stay finite.
    NULL and NaN give NULL, as does a column without finite values.
    """
    out, x = out or column, F.col(quoted(column))
    if points is None:
        return _whole_distribution(df, column, out, **how)
    if points < 2:
        raise ValueError("a grid needs two points at least")
    shares, grid = quantile_grid(train if train is not None else df, column, points)
    if not len(grid):
        return df.withColumn(out, F.lit(None).cast("double"))

    @F.pandas_udf("double")
    def share(values: pd.Series) -> pd.Series:
        v = values.to_numpy(np.float64)
        # From the left a run of equal grid points gives its last share, from the right its first.
        at = (np.interp(v, grid, shares) - np.interp(-v, -grid[::-1], -shares[::-1])) / 2
        at = np.where(v <= grid[0], 0.0, np.where(v >= grid[-1], 1.0, at)) if grid[0] < grid[-1] else np.sign(v - grid[0]) / 2 + 0.5
        return pd.Series(at)

    known = x.isNotNull() & ~F.isnan(x.cast("double"))
    at = F.greatest(F.least(share(x.cast("double")), F.lit(1 - EDGE)), F.lit(EDGE))
    return df.withColumn(out, F.when(known, normal_quantile(at)))


def _whole_distribution(df: DataFrame, column: str, out: str, **how) -> DataFrame:
    values = df.select(F.col(quoted(column)).alias("__v")).where(F.col("__v").isNotNull())
    ranks = ranked_values(values, [], "__v", **how).withColumn("__one", F.lit(1))
    total = values.withColumn("__one", F.lit(1)).groupBy("__one").agg(F.count(F.lit(1)).alias("__n"))
    share = F.coalesce(ratio(F.col("avg_rank") - 1, F.col("__n") - 1), F.lit(0.5))
    mapped = ranks.join(F.broadcast(total), "__one").select(
        "__v", normal_quantile(F.greatest(F.least(share, F.lit(1 - EDGE)), F.lit(EDGE))).alias("__z")
    )
    joined = df.join(mapped, F.col(quoted(column)) == F.col("__v"), "left")
    return joined.withColumn(out, F.col("__z")).drop("__v", "__z")


def yeo_johnson(x: str, power: float) -> str:
    """SQL text of the transform of a double expression."""
    flip = 2.0 - power
    up = f"log1p({x})" if abs(power) < 1e-9 else f"(pow({x} + 1.0D, {power!r}D) - 1.0D) / ({power!r}D)"
    down = f"-log1p(-({x}))" if abs(flip) < 1e-9 else f"(pow(1.0D - {x}, {flip!r}D) - 1.0D) / ({-flip!r}D)"
    return f"case when {x} >= 0 then {up} else {down} end"


def _shaped(x: np.ndarray, power: float) -> np.ndarray:
    """Yeo-Johnson of an array."""
    flip = 2.0 - power
    size = np.log1p(np.abs(x))
    up = size if abs(power) < 1e-9 else np.expm1(power * size) / power
    down = -size if abs(flip) < 1e-9 else -np.expm1(flip * size) / flip
    return np.where(x >= 0, up, down)


def best_powers(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Yeo-Johnson power per column by likelihood: a grid, refined around the best twice.

    Each round is one scan, in which a batch adds to the sums of all candidates of
    all columns. They are taken around the transformed mean, so that squares of
    values far from zero keep their digits. NaN counts as missing.
    """
    columns = list(columns)
    data, means = _doubles(df, columns), column_means(df, columns)
    centre = dict.fromkeys(columns, 0.0)
    for step, reach in ((0.25, 12), (0.025, 10), (0.0025, 10)):
        trial = [[round(centre[c] + step * i, 6) for i in range(-reach, reach + 1)] for c in columns]

        def sums(batches, trial=trial):
            total = np.zeros((len(trial), len(trial[0]), 4))
            with np.errstate(over="ignore", invalid="ignore"):
                for batch in batches:
                    for j, x in enumerate(_batch(batch)):
                        x = x[~np.isnan(x)]
                        logs = float((np.sign(x) * np.log1p(np.abs(x))).sum())
                        for i, power in enumerate(trial[j]):
                            y = _shaped(x, power) - _shaped(np.array(means[j]), power)
                            total[j, i] += len(x), logs, y.sum(), (y * y).sum()
            return {0: total.ravel()}

        found = merged_arrays(data, sums, 1).get(0)
        if found is None:
            return dict.fromkeys(columns, 1.0)
        found = found.reshape(len(columns), -1, 4)
        for j, c in enumerate(columns):
            scored = []
            for (n, logs, s, q), power in zip(found[j], trial[j], strict=True):
                spread = (q - s * s / n) / n if n else 0.0
                if math.isfinite(spread) and spread > 1e-13 * q / max(n, 1.0):
                    scored.append((-0.5 * n * math.log(spread) + (power - 1.0) * logs, -abs(power - 1.0), power))
            centre[c] = max(scored)[2] if scored else 1.0
    return centre


def power_transform(
    df: DataFrame, columns: Sequence[str], train: DataFrame | None = None, limit: float = 10.0
) -> DataFrame:
    """Yeo-Johnson and z-score fitted on the training rows.

    Values are first held to the training range and the result to +-limit.
    """
    train = train if train is not None else df
    powers = best_powers(train, columns)
    ends = train.agg(*[f(F.col(quoted(c)).cast("double")).alias(f"{t}{i}")
                       for i, c in enumerate(columns) for t, f in (("lo", F.min), ("hi", F.max))]).first()

    def shaped(frame: DataFrame) -> DataFrame:
        held = frame.withColumns({
            c: F.when(F.col(quoted(c)).isNotNull(), F.greatest(
                F.least(F.col(quoted(c)).cast("double"), F.lit(ends[f"hi{i}"])), F.lit(ends[f"lo{i}"])))
            for i, c in enumerate(columns)
        })
        return held.withColumns({c: F.expr(yeo_johnson(quoted(c), powers[c])) for c in columns})

    scaled = standardize(shaped(df), columns, shaped(train))
    return scaled.withColumns({
        c: F.when(F.col(quoted(c)).isNotNull(), F.greatest(F.least(F.col(quoted(c)), F.lit(limit)), F.lit(-limit)))
        for c in columns
    })


def log_cols(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero becomes 1e-9, then the logarithm, as ``col_logged``."""
    out = df.withColumns({
        f"{c}_logged": safe_ln(F.when(F.col(quoted(c)) == 0, F.lit(1e-9)).otherwise(F.col(quoted(c)).cast("double")))
        for c in columns
    })
    return out.drop(*columns)


def drop_by_profile(
    df: DataFrame, suggestions: DataFrame, max_skew: float | None = 2.0, no_missing: bool = True,
    protect: Sequence[str] = (),
) -> DataFrame:
    """Drop columns with missing values or too much skew, except protected ones."""
    bad = F.lit(False)
    if no_missing:
        bad = bad | (F.col("missing_share") > 0)
    if max_skew is not None:
        bad = bad | F.coalesce(F.col("skew") > max_skew, F.lit(False))
    names = [r["column"] for r in suggestions.where(bad).select("column").collect()]
    return df.drop(*[n for n in names if n not in protect])


# --- splits and resampling ----------------------------------------------------


def unit_hash(keys: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) that depends only on the key values and the seed."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)


def drawn_number(keys: Sequence[Column | str], seed: int) -> Column:
    """A whole number below 2^60 from the MD5 of seed and key values, which other tools draw alike."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(seed), *keys)), 1, 15), 16, 10).cast("bigint")


def split_random(df: DataFrame, keys: Sequence[str], test: float, seed: int = 42, out: str = "is_test") -> DataFrame:
    """Row-level split, also the group split when ``keys`` is the entity alone."""
    return df.withColumn(out, unit_hash(keys, seed) < test)


def split_stratified(
    df: DataFrame, keys: Sequence[str], stratum: str, test: float, seed: int = 42, out: str = "is_test", **how
) -> DataFrame:
    """Split with the same test share in every stratum, to the row.

    ``keys`` identify a row. Rows are ordered by hash inside their stratum with
    running counts, so a stratum with most of the rows is still cut into blocks.
    Rows without a stratum are one of their own.
    """
    hashed = df.withColumn("__h", F.xxhash64(*keys, F.lit(seed)))
    counts = hashed.groupBy(stratum, "__h").agg(F.count(F.lit(1)).alias("__n"))
    upto = running(counts, [stratum], "__h", {"__upto": ("sum", "__n")}, **how)
    sizes = counts.groupBy(stratum).agg(F.sum("__n").alias("__size"))
    # One cut point per stratum goes back to the rows, not one place per row.
    cuts = null_safe(upto, sizes, [stratum], "inner").groupBy(stratum).agg(
        F.max(F.when(F.col("__upto") <= F.bround(F.col("__size") * F.lit(test)), F.col("__h"))).alias("__cut")
    )
    return null_safe(hashed, cuts, [stratum], "left").withColumn(
        out, F.coalesce(F.col("__h") <= F.col("__cut"), F.lit(False))
    ).drop("__h", "__cut")


def split_group_and_time(
    df: DataFrame, entity: str, time: str, test: float, cut: int, seed: int = 42, out: str = "part"
) -> DataFrame:
    """train: kept entities up to the cut; test: held-out entities after it; else unused."""
    held = unit_hash([entity], seed) < test
    late = F.col(time) > cut
    return df.withColumn(out, F.when(held & late, "test").when(~held & ~late, "train").otherwise("unused"))


def group_folds(df: DataFrame, entity: str, folds: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold number per entity; an entity is never in two folds."""
    return df.withColumn(out, F.pmod(F.xxhash64(entity, F.lit(seed)), F.lit(folds)).cast("int"))


def smote(
    df: DataFrame, key: str, label: str, features: Sequence[str], k: int = 5, seed: int = 42, **how
) -> DataFrame:
    """Add interpolated minority rows until both classes have the same size.

    A new row lies between a minority row and one of its k nearest minority
    rows. Which rows, which neighbour and how far are drawn by a hash of the key
    that any tool computes alike. New rows have no key and ``is_synthetic`` set.
    """
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) != 2:
        raise ValueError(f"two classes are needed, found {sorted(sizes, key=str)}")
    small = min(sizes, key=lambda v: (sizes[v], str(v)))
    need = max(sizes.values()) - sizes[small]
    whole, rest = divmod(need, sizes[small])
    few = df.where(F.col(label) == small).select(
        F.col(key).alias("__id"), F.array(*[F.col(quoted(c)).cast("double") for c in features]).alias("__x")
    )
    ordered = running(few.select("__id", drawn_number(["__id"], seed).alias("__h"), F.lit(1).alias("__w")),
                      [], "__h", {"__place": ("sum", "__w")}, **how)
    copies = ordered.select("__id", F.explode(
        F.when((F.lit(whole) + F.when(F.col("__place") <= rest, 1).otherwise(0)) > 0,
               F.sequence(F.lit(1), F.lit(whole) + F.when(F.col("__place") <= rest, 1).otherwise(0)))
    ).alias("__copy"))
    near = knn_vectors(few, few, min(k, sizes[small] - 1), "__x", "__id", "__id", apart="__id")
    drawn = copies.withColumn(
        "rank", F.pmod(drawn_number(["__id", "__copy"], seed + 1), F.lit(min(k, sizes[small] - 1))).cast("int") + 1
    ).join(near.select("__id", "neighbor", "rank"), ["__id", "rank"])
    other = few.select(F.col("__id").alias("neighbor"), F.col("__x").alias("__y"))
    made = drawn.join(few, "__id").join(other, "neighbor").withColumn(
        "__gap", drawn_number(["__id", "__copy"], seed + 2) / F.lit(float(1 << 60))
    )
    x = [
        (F.col("__x")[i] + F.col("__gap") * (F.col("__y")[i] - F.col("__x")[i])).alias(c)
        for i, c in enumerate(features)
    ]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    synthetic = made.select(
        F.lit(None).cast(kinds[key]).alias(key), F.lit(small).cast(kinds[label]).alias(label), *x,
        F.lit(True).alias("is_synthetic"),
    )
    real = df.select(
        key, label, *[F.col(quoted(c)).cast("double").alias(c) for c in features], F.lit(False).alias("is_synthetic")
    )
    return real.unionByName(synthetic)
