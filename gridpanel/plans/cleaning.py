"""Raw table to clean panel, one function per source.

Each is a single lazy plan from the scan to the roll-up. Ids are text; the
panels have one row per (county_id, year), business patterns per sector too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.functions.expressions import parse_number, quoted, zero_pad
from gridpanel.functions.fixed_values import (
    BUSINESS_PATTERN_NAMES, CITY_PARENTS, COUNTY_PARENTS, INDEPENDENT_CITIES, MAINLAND_PREFIXES, NEW_REGION_IDS, SUPPRESSION_BANDS,
)
from gridpanel.operators.aggregate import agg_max, agg_mean_std, agg_sum, rollup_children
from gridpanel.operators.clean import (
    build_key, coerce_numeric, drop_if_present, exclude_values, filter_prefix_in, filter_regex, filter_years,
    null_by_flag, remap_codes, rename_map,
)
from gridpanel.operators.joins import coalesce_join, panel_grid
from gridpanel.operators.reshape import melt_years, pivot_attribute, split_suffix, wide_to_long
from gridpanel.operators.spatial import spatial_fill
from gridpanel.operators.windows import interpolate_edges_zero
from gridpanel.session import checkpointed
from gridpanel.sources.readers import parse_fixed_width

E, T = "county_id", "year"
FIRST, LAST = 2001, 2022

CITIES_ONLY = {c: CITY_PARENTS[c] for c in INDEPENDENT_CITIES}


def mainland(df: DataFrame) -> DataFrame:
    return filter_prefix_in(df, E, 2, MAINLAND_PREFIXES)


def _wide_accounts(raw: DataFrame, years: Sequence[int], names: dict[str, str], kinds: dict[str, str]) -> DataFrame:
    """Wide account tables: years to rows, descriptions to columns, counties only."""
    long = melt_years(raw, ["GeoFIPS", "GeoName", "Description"], [str(y) for y in years], T, "value")
    counties = long.where(F.col("GeoName").contains(","))
    wide = pivot_attribute(counties, ["GeoFIPS", "GeoName", T], "Description", "value", names)
    return filter_years(wide.select(
        F.trim(F.replace("GeoFIPS", F.lit('"'), F.lit(""))).alias(E),
        F.col(T).try_cast("int").alias(T),
        *[parse_number(c, kinds[c]).alias(c) for c in names.values()],
    ), T, FIRST, LAST)


def clean_gdp(raw: DataFrame, years: Sequence[int] = range(2001, 2025)) -> DataFrame:
    names = {
        "Real GDP (thousands of chained 2017 dollars) ": "real_gdp_2017_dollars_thousands",
        "Current-dollar GDP (thousands of current dollars) ": "current_gdp_dollars_thousands",
        "Chain-type quantity indexes for real GDP ": "quantity_index_gdp",
    }
    kinds = {"real_gdp_2017_dollars_thousands": "long", "current_gdp_dollars_thousands": "long",
             "quantity_index_gdp": "double"}
    df = remap_codes(_wide_accounts(raw, years, names, kinds), E, CITY_PARENTS)
    df = mainland(exclude_values(df, E, INDEPENDENT_CITIES))
    df = rollup_children(df, COUNTY_PARENTS, E, T, "All", ["quantity_index_gdp"])
    return exclude_values(df, E, NEW_REGION_IDS)


def clean_personal_income(
    raw: DataFrame, years: Sequence[int] = range(1969, 2025), average: Sequence[str] = ("per_capita_personal_income_dollars",)
) -> DataFrame:
    """Income of merged places is summed and their per-capita income averaged,
    in one roll-up over cities and other children."""
    names = {
        "Per capita personal income (dollars) 2/": "per_capita_personal_income_dollars",
        "Personal income (thousands of dollars) ": "personal_income_thousands_of_dollars",
    }
    df = _wide_accounts(raw, years, names, {c: "long" for c in names.values()})
    df = exclude_values(mainland(remap_codes(df, E, CITY_PARENTS)), E, ["55901"])
    df = rollup_children(df, COUNTY_PARENTS, E, T, "All", list(average))
    return exclude_values(df, E, NEW_REGION_IDS)


def clean_population(lines: DataFrame) -> DataFrame:
    df = parse_fixed_width(lines, {
        T: (0, 0, 4, "int"), E: (0, -5, None, "string"), "population": (1, -8, None, "long"),
    })
    df = filter_years(df, T, FIRST, LAST)
    df = remap_codes(df, E, {**CITIES_ONLY, "51917": "51019", "46113": "46102"})
    return mainland(agg_sum(df, [T, E], ["population"]))


PERMIT_STUBS = [
    "all_permits", "single_family_permits", "all_multifamily_permits", "multifamily_permits_2_units",
    "multifamily_permits_3_4_units", "multifamily_permits_5_or_more_units",
]


def clean_permits(raw: DataFrame, years: Sequence[int]) -> DataFrame:
    df = rename_map(raw, {
        "multifamily_permits_3_4_unit_2022": "multifamily_permits_3_4_units_2022",
        "multifamily_permits_5_or_more_2022": "multifamily_permits_5_or_more_units_2022",
    })
    df = wide_to_long(df, ["state", "county"], PERMIT_STUBS, years)
    df = df.withColumn(E, build_key(["state", "county"], [2, 3])).drop("state", "county")
    df = filter_years(coerce_numeric(df, PERMIT_STUBS, "long"), T, FIRST, LAST)
    return rollup_children(mainland(remap_codes(df, E, CITIES_ONLY)), COUNTY_PARENTS, E, T)


def clean_unemployment(raw: DataFrame) -> DataFrame:
    attribute, year = split_suffix("Attribute")
    names = {"Civilian_labor_force": "civilian_labor_force", "Employed": "employed",
             "Unemployed": "unemployed", "Unemployment_rate": "unemployment_rate"}
    df = raw.withColumns({"__a": attribute, T: year})
    df = filter_regex(df, "Area_Name", "County|Parish|District of Columbia", ignore_case=True)
    df = pivot_attribute(df, ["FIPS_Code", "State", "Area_Name", T], "__a", "Value", names)
    df = df.select(zero_pad("FIPS_Code", 5).alias(E), T, *[
        parse_number(c, "double" if c == "unemployment_rate" else "long").alias(c) for c in names.values()
    ])
    return mainland(exclude_values(filter_years(df, T, FIRST, LAST), E, ["11000"]))


def clean_business_patterns(raw: DataFrame, null_sum: bool = False) -> DataFrame:
    """All yearly files stacked with a ``year`` column to sector sums per county.

    A suppressed size band is missing in its row; like any missing value it adds
    nothing to the sum. ``null_sum`` keeps a sum of missing values missing.
    """
    df = rename_map(filter_regex(rename_map(raw, {}), "naics", r"^\d\d----"), BUSINESS_PATTERN_NAMES)
    bands = [c for c in df.columns if c.startswith("est")]
    if "empflag" in df.columns:
        df = null_by_flag(df, "empflag", SUPPRESSION_BANDS)
    measures = ["tot_employee_count", "annual_payroll", "tot_establishment_count", *bands]
    df = coerce_numeric(df, measures, "double", ["N"])
    df = df.withColumn(E, build_key(["fipstate", "fipscty"], [2, 3])).withColumn(
        "naics_industry_code", F.replace("naics_industry_code", F.lit("-"), F.lit(""))
    )
    df = mainland(remap_codes(filter_years(df, T, FIRST, LAST), E, {**CITY_PARENTS, **COUNTY_PARENTS}))
    df = agg_sum(df, [E, T, "naics_industry_code"], measures, null_sum)
    return exclude_values(filter_regex(df, E, r"^\d{2}999", keep=False), E, NEW_REGION_IDS)


def clean_counties(codes: DataFrame, centroids: DataFrame, areas: DataFrame, older_areas: DataFrame) -> DataFrame:
    """Entity dimension: codes without statistical, independent and outlying
    areas, with centroids and land and water areas."""
    df = exclude_values(exclude_values(codes, "FUNCSTAT", ["S"]), "CLASSFP", ["C7"])
    df = exclude_values(df, "STATE", ["AS", "GU", "MP", "PR", "UM", "VI"])
    df = df.select(
        F.concat("STATEFP", "COUNTYFP").alias(E), F.col("STATE").alias("state"),
        F.col("STATEFP").alias("state_fips_code"), F.col("COUNTYFP").alias("county_fips_code"),
        F.col("COUNTYNS").alias("county_ns_code"), F.col("COUNTYNAME").alias("county_name"),
        F.col("CLASSFP").alias("fips_class_code"), F.col("FUNCSTAT").alias("functional_status"),
    )
    points = centroids.select(
        zero_pad("FIPS_CD", 5).alias(E), parse_number("LONGITUDE").alias("centroid_lon"),
        parse_number("LATITUDE").alias("centroid_lat"),
    )

    def sized(areas: DataFrame) -> DataFrame:
        return areas.select(F.col("GEOID").alias(E), parse_number("ALAND_SQMI").alias("land_area_sqmi"),
                            parse_number("AWATER_SQMI").alias("water_area_sqmi"))

    return coalesce_join(df.join(points, E, "left"), sized(areas), sized(older_areas), E,
                         ["land_area_sqmi", "water_area_sqmi"], "land_area_sqmi")


def clean_establishments(raw: DataFrame, counties: DataFrame, first: int, last: int, industry: str = "518") -> DataFrame:
    """Quarterly establishments to a gap-free yearly panel with an imputation flag."""
    df = raw.where(F.col("industry_code") == industry).select("area_fips", "agglvl_code", "year", "qtrly_estabs")
    df = df.where(F.col("agglvl_code").cast("int") == 75)
    df = coerce_numeric(df, ["qtrly_estabs"]).withColumn(T, F.col(T).try_cast("int"))
    df = agg_max(df, ["area_fips", T], ["qtrly_estabs"]).withColumnsRenamed({"area_fips": E, "qtrly_estabs": "estabs"})
    df = exclude_values(mainland(filter_regex(df, E, r"^\d{2}999", keep=False)), E, NEW_REGION_IDS)
    parents = {k: v for k, v in COUNTY_PARENTS.items() if k in ("24510", "29510", "32510")}
    df = rollup_children(remap_codes(df, E, CITY_PARENTS), parents, E, T)
    grid = panel_grid(counties.select(E, "land_area_sqmi", "water_area_sqmi"), T, first, last)
    # A county has one row per year of the grid.
    return interpolate_edges_zero(grid.join(df, [E, T], "left"), E, T, "estabs", hot=False)


def annualize(
    daily: DataFrame,
    key: Column,
    time: Column,
    measures: Sequence[str],
    entities: DataFrame,
    edges: DataFrame,
    first: int,
    last: int,
    parents=None,
    recode: dict[str, str] | None = None,
    entity: str = E,
    year: str = T,
    keep: Column | None = None,
    mean: str = "_daily_avg",
    sd: str = "_sd",
    k: int = 5,
) -> DataFrame:
    """Daily measures to a complete yearly panel.

    Text is parsed, children go to their parents, mean and deviation per entity
    and year come from one aggregate, the grid is completed, and missing cells
    are filled from the nearest entities.
    """
    df = daily.select(key.alias(entity), time.alias(year), *[parse_number(c).alias(c) for c in measures])
    if parents is not None:
        df = remap_codes(df, entity, parents)
    out = agg_mean_std(df, [entity, year], measures, mean, sd)
    if recode:
        out = remap_codes(out, entity, recode)
    # The grid is read twice below; the daily rows are not.
    grid = checkpointed(panel_grid(entities, year, first, last).join(out, [entity, year], "left"))
    values = [f"{m}{s}" for m in measures for s in (sd, mean)]
    filled = spatial_fill(grid, edges, entity, year, values, mode="fill_na", k=k)
    return filled.where(keep) if keep is not None else filled


def clean_air_quality(daily: DataFrame, counties: DataFrame, edges: DataFrame) -> DataFrame:
    measures = ["pm25_max_pred", "pm25_med_pred", "pm25_mean_pred", "pm25_pop_pred"]
    names = {m: m.removesuffix("_pred") for m in measures}
    return annualize(
        daily.withColumnsRenamed(names), build_key(["statefips", "countyfips"], [2, 3]),
        F.col("year").try_cast("int"), list(names.values()), counties, edges, FIRST, LAST,
        parents=CITY_PARENTS, recode={"46113": "46102"},
        keep=F.substring(E, 1, 2).isin(MAINLAND_PREFIXES),
    )
