"""Difference in differences with staggered treatment.

Group-time effects are differences of cohort means against never-treated units.
Means come from one group-by on (cohort, period). Errors come from every unit's
influence, so rows of one unit count as one cluster; their squares are read off
a table of second moments per cohort and two periods.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.functions.expressions import ratio
from gridpanel.operators.windows import event_time
from gridpanel.session import stored


def assign_treatment(
    df: DataFrame, entity: str, time: str, value: str, threshold: float, first: str = "first_year"
) -> DataFrame:
    """First period above a threshold per entity, 0 if never, with flag and relative period."""
    return event_time(df, entity, time, F.col(value) > threshold, first)


def _cells(df: DataFrame, y: str, time: str, first: str) -> DataFrame:
    return df.dropna(subset=[y, time, first]).groupBy(F.col(first).alias("g"), F.col(time).alias("t")).agg(
        F.avg(F.col(y).cast("double")).alias("m"), F.count(F.lit(1)).alias("n")
    )


def att_gt(
    df: DataFrame, y: str, entity: str, time: str, first: str = "first_year", base: str = "varying"
) -> DataFrame:
    """Effect per cohort and period: (g, t, base_t, effect, n_treated, rel).

    Base period is g-1 from treatment on; before it the previous period
    (``varying``) or g-1 as well (``universal``). A cohort without its base
    period, such as one treated in the first period, has no effects.
    """
    return _effects(_cells(df, y, time, first), base)


def _effects(cells: DataFrame, base: str) -> DataFrame:
    if base not in ("varying", "universal"):
        raise ValueError("base must be 'varying' or 'universal'")
    treated, control = cells.where("g > 0"), cells.where("g = 0").drop("g")
    before = F.col("g") - 1 if base == "universal" else F.when(F.col("t") >= F.col("g"), F.col("g") - 1).otherwise(F.col("t") - 1)
    out = treated.withColumn("base_t", before)

    def add(frame: DataFrame, other: DataFrame, on: dict[str, str], name: str) -> DataFrame:
        renamed = other.select(*[F.col(o).alias(f"__{o}") for o in on.values()], F.col("m").alias(name),
                               F.col("n").alias(f"n_{name}"))
        condition = [F.col(l) == F.col(f"__{o}") for l, o in on.items()]
        return frame.join(renamed, condition).drop(*[f"__{o}" for o in on.values()])

    # All four frames have one row per cohort and period.
    out = add(out, treated, {"g": "g", "base_t": "t"}, "m_base")
    out = add(out, control, {"t": "t"}, "c")
    out = add(out, control, {"base_t": "t"}, "c_base")
    effect = (F.col("m") - F.col("m_base")) - (F.col("c") - F.col("c_base"))
    return out.select(
        "g", "t", "base_t", effect.alias("effect"), F.col("n").alias("n_treated"),
        (F.col("t") - F.col("g")).alias("rel"), "m", "m_base", "c", "c_base", "n_m_base", "n_c", "n_c_base",
    )


def _second_moments(df: DataFrame, cells: DataFrame, y: str, entity: str, time: str, first: str) -> DataFrame:
    """Per cohort and two periods, the sum over units of the product of their deviations from the cohort's means: (__g, __s, __t, __c).

    A unit's rows are folded to one number per period and gathered, at most one
    per period; a batch of units is then one matrix product per cohort. Nothing is
    joined to rows but the means, and the table is cohorts times periods squared.
    A row without periods has the number of the cohort's units.
    """
    rows = df.dropna(subset=[y, time, first]).select(
        F.col(entity).alias("e"), F.col(first).cast("long").alias("g"), F.col(time).cast("long").alias("t"), F.col(y).cast("double").alias("y"))
    means = cells.select(F.col("g").cast("long").alias("__g"), F.col("t").cast("long").alias("__t"), "m")
    apart = rows.join(means, (F.col("g") == F.col("__g")) & (F.col("t") == F.col("__t"))).groupBy("e", "g", "t").agg(F.sum(F.col("y") - F.col("m")).alias("d"))
    units = apart.groupBy("e", "g").agg(F.collect_list(F.struct("t", "d")).alias("r")).select("g", F.col("r.t").alias("ts"), F.col("r.d").alias("ds"))

    def products(batches):
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        units: dict[int, int] = {}
        for batch in batches:
            lists = batch.column("ts")
            unit = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            g, t, d = batch.column("g").to_numpy()[unit], lists.flatten().to_numpy(), batch.column("ds").flatten().to_numpy()
            for cohort in np.unique(g):
                mine = g == cohort
                periods, column = np.unique(t[mine], return_inverse=True)
                units_, line = np.unique(unit[mine], return_inverse=True)
                x = np.zeros((len(units_), len(periods)))
                x[line, column] = d[mine]
                units[cohort] = units.get(cohort, 0) + len(units_)
                if cohort in found:  # widen to the periods of both
                    before, total = found[cohort]
                    both = np.union1d(before, periods)
                    wide = np.zeros((len(both), len(both)))
                    for p, c in ((before, total), (periods, x.T @ x)):
                        at = np.searchsorted(both, p)
                        wide[np.ix_(at, at)] += c
                    found[cohort] = both, wide
                else:
                    found[cohort] = periods, x.T @ x
        for cohort, (periods, c) in found.items():
            n = len(periods)
            yield pa.RecordBatch.from_pydict({"g": np.full(n * n, cohort), "s": np.repeat(periods, n), "t": np.tile(periods, n), "c": c.ravel()})
            yield pa.RecordBatch.from_pydict({"g": [cohort], "s": pa.array([None], pa.int64()), "t": pa.array([None], pa.int64()), "c": [float(units[cohort])]})

    return stored(units.mapInArrow(products, "g long, s long, t long, c double").groupBy(
        F.col("g").alias("__g"), F.col("s").alias("__s"), F.col("t").alias("__t")).agg(F.sum("c").alias("__c")))


def _variances(effects: DataFrame, second: DataFrame, label: Sequence[str], weight: Column) -> DataFrame:
    """Squared influence of the units per label: (labels..., variance).

    An effect is a weighted sum of cohort means, so a unit's influence on it is the
    same sum of its deviations over the cells' sizes. Coefficients of one label,
    cohort and period are added up; the squares summed over units are then the
    quadratic form of the cohort's second moments. All tables are of cohorts and periods.
    """
    side = [("n_treated", "t", True, 1.0), ("n_m_base", "base_t", True, -1.0), ("n_c", "t", False, -1.0), ("n_c_base", "base_t", False, 1.0)]
    parts = [
        effects.select(*label, (F.col("g") if is_treated else F.lit(0)).cast("long").alias("__g"), F.col(at).cast("long").alias("__t"),
                       ratio(F.lit(sign) * weight, F.col(n)).alias("__w"))
        for n, at, is_treated, sign in side]
    coefficients = reduce(DataFrame.unionByName, parts).groupBy(*label, "__g", "__t").agg(F.sum("__w").alias("__w"))
    other = coefficients.withColumnsRenamed({"__t": "__s", "__w": "__v"})
    pairs = coefficients.join(other, [*label, "__g"]).join(second, ["__g", "__s", "__t"])
    return pairs.groupBy(*label).agg(F.greatest(F.sum(F.col("__w") * F.col("__v") * F.col("__c")), F.lit(0.0)).alias("variance"))


Z95 = 1.959963984540054


def _bounds(df: DataFrame) -> DataFrame:
    se = F.sqrt("variance")
    return df.withColumns({
        "std_err": se, "ci_lower": F.col("effect") - se * Z95, "ci_upper": F.col("effect") + se * Z95,
    }).drop("variance")


def att_gt_errors(
    df: DataFrame, y: str, entity: str, time: str, first: str = "first_year", base: str = "varying"
) -> DataFrame:
    """``att_gt`` with standard errors and 95 % bounds."""
    cells = stored(_cells(df, y, time, first))  # a row per cohort and period
    effects = _effects(cells, base)
    variance = _variances(effects, _second_moments(df, cells, y, entity, time, first), ["g", "t"], F.lit(1.0))
    return _bounds(effects.select("g", "t", "rel", "effect", "n_treated").join(variance, ["g", "t"], "left"))


def event_study(
    df: DataFrame, y: str, entity: str, time: str, first: str = "first_year", base: str = "varying",
    window: tuple[int, int] = (-5, 5),
) -> DataFrame:
    """Effect per relative period, cohorts weighted by their units, with 95 % bounds."""
    cells = stored(_cells(df, y, time, first))
    second = _second_moments(df, cells, y, entity, time, first)
    effects = _effects(cells, base).where(F.col("rel").between(*window))
    sizes = second.where("__s is null").select(F.col("__g").alias("g"), F.col("__c").cast("long").alias("units"))
    weighted = effects.join(sizes, "g")
    totals = weighted.groupBy("rel").agg(
        ratio(F.sum(F.col("units") * F.col("effect")), F.sum("units")).alias("effect"),
        F.sum("units").alias("units"), F.count(F.lit(1)).alias("n_cohorts"),
    )
    shares = weighted.join(totals.select("rel", F.col("units").alias("__all")), "rel")
    variance = _variances(shares, second, ["rel"], ratio(F.col("units"), F.col("__all")))
    return _bounds(totals.join(variance, "rel", "left"))
