"""Clean tables to transformed tables and the model panel (G10 and its parts)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from gridpanel.functions.expressions import quoted
from gridpanel.operators.aggregate import agg_sum, pivot_buckets
from gridpanel.operators.clean import per_capita
from gridpanel.operators.joins import assemble_panel, panel_grid
from gridpanel.operators.spatial import density_features, spatial_then_yoy
from gridpanel.operators.windows import add_lags, diff_features, interpolate_all
from gridpanel.session import checkpointed


def centre_features(
    counts: DataFrame, entities: DataFrame, edges: DataFrame, entity: str, time: str, value: str, area: str,
    first: int, last: int, k: int = 5,
) -> DataFrame:
    """Counts on the full grid (absent = 0), neighbour average, growth and density."""
    grid = panel_grid(entities.select(entity), time, first, last)
    full = checkpointed(agg_sum(grid.join(counts.select(entity, time, value), [entity, time], "left"), [entity, time], [value]))
    around = f"{value}_spatial_weighted_avg_{k}"
    out = spatial_then_yoy(full, edges, entity, time, [value], k=k, hot=False).drop(f"{value}_yoy_change")
    # One row per entity and year of the grid.
    out = diff_features(out, entity, time, [value, around], hot=False)
    dense = density_features(full, entities, entity, time, value, area, first, last).drop(value)
    return out.join(dense, [entity, time], "left")


def build_model_panel(
    entities: DataFrame,
    edges: DataFrame,
    facts: DataFrame,
    buckets: DataFrame,
    code: str,
    metrics: Sequence[str],
    bucket_names: Sequence[str],
    tables: Mapping[str, DataFrame],
    entity: str,
    time: str,
    first: int,
    last: int,
    population: str,
    per_capita_of: Sequence[str] = (),
    names: Mapping[str, str] | None = None,
    lags_of: Sequence[str] = (),
    k: int = 5,
    check: bool = True,
) -> DataFrame:
    """Sector pivot, gap filling, neighbour columns, assembly, per-capita columns and lags.

    The pivot's metrics per bucket become per-capita columns along with the
    listed ones. Columns of growth rates are dropped at the end, since a model
    with fixed effects does not need them.
    """
    pivoted = pivot_buckets(facts, code, buckets, [entity, time], metrics, bucket_names)
    grid = panel_grid(entities.select(entity), time, first, last)
    cells = [f"{m}_{b}" for m in metrics for b in bucket_names]
    # The panel is read twice below, the facts are read once.
    full = checkpointed(interpolate_all(grid.join(pivoted, [entity, time], "left"), entity, time, cells, hot=False))
    business = spatial_then_yoy(full, edges, entity, time, cells, k=k, hot=False)
    base = panel_grid(entities, time, first, last)
    out = assemble_panel(base, {"business": business, **tables}, [entity, time], check=check)
    out = out.drop(*[c for c in out.columns if "yoy" in c.lower()])
    shared = [c for c in out.columns if any(m in c for m in metrics)]
    out = per_capita(out, [*per_capita_of, *shared], population)
    if names:
        out = out.withColumnsRenamed(dict(names))
    if lags_of:
        out = add_lags(out, entity, time, lags_of, hot=False)
    return out


# Outcomes of the panel regressions and the groups of their terms.
OUTCOMES = [
    "unemployment_rate_pct",
    "personal_income_thousands_of_dollars_per_capita_log",
    "single_family_permits_per_1000_log1p",
    "all_multifamily_permits_per_1000_log1p",
    "real_gdp_2017_dollars_thousands_per_capita_log",
    "pm25_mean_daily_avg",
    "pm25_mean_daily_avg_spatial_weighted_avg_5",
    "tot_employee_count_industrial_per_capita_log1p",
    "tot_employee_count_information_per_capita_log1p",
    "tot_employee_count_professional_per_capita_log1p",
    "tot_employee_count_public_services_per_capita_log1p",
    "tot_employee_count_primary_industries_per_capita_log1p",
    "tot_employee_count_trade_transport_per_capita_log1p",
    "population_log",
]
TERM_GROUPS = {
    "dc": ["datacenters", "nearby_datacenters_50mi"],
    "dc_density": ["datacenters_per_100_sqmi", "nearby_datacenters_50mi_per_100_sqmi"],
    "size": ["land_area_sqmi_log", "total_area_sqmi_log"],
    "sector": [c for c in OUTCOMES if c.startswith("tot_employee_count_")],
    "population": ["population_log"],
    "economy": [
        "real_gdp_2017_dollars_thousands_per_capita_log",
        "personal_income_thousands_of_dollars_per_capita_log",
        "unemployment_rate_pct",
    ],
    "environment": ["pm25_mean_daily_avg", "pm25_mean_daily_avg_spatial_weighted_avg_5"],
    "permit": ["single_family_permits_per_1000_log1p", "all_multifamily_permits_per_1000_log1p"],
}


def excluded_terms(outcome: str, groups: Mapping[str, Sequence[str]] = TERM_GROUPS) -> list[str]:
    """Terms that may not explain an outcome: its own group, and whatever is derived from it."""
    out = ["year_num", *groups.get("dc", ()), *groups.get("size", ())]
    for name in ("environment", "permit"):
        if outcome in groups.get(name, ()):
            out += groups[name]
    incomes = [c for c in groups.get("economy", ()) if c.endswith("_per_capita_log")]
    if outcome in groups.get("population", ()):
        out += [*groups.get("permit", ()), *groups.get("sector", ()), *incomes]
    if outcome in incomes:
        out += incomes
    return list(dict.fromkeys(out))


def lagged_groups(groups: Mapping[str, Sequence[str]], lag: int = 2) -> dict[str, list[str]]:
    """Rules whose treatment terms are replaced by their lag; densities are told by ``per``."""
    terms = [f"{c}_lag{lag}" for c in [*groups.get("dc", ()), *groups.get("dc_density", ())]]
    return {
        **{k: list(v) for k, v in groups.items()},
        "dc": [t for t in terms if "per" not in t],
        "dc_density": [t for t in terms if "per" in t],
    }
