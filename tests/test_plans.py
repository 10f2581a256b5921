"""Raw files to panels, round trips through files, and the model panel."""

import pytest
from pyspark.sql import functions as F

from conftest import close, rows
from gridpanel.plans import cleaning, panel
from gridpanel.session import checkpointed
from gridpanel.sources import readers, writers


def test_gdp(spark):
    names = ["Real GDP (thousands of chained 2017 dollars) ", "Current-dollar GDP (thousands of current dollars) ",
             "Chain-type quantity indexes for real GDP "]
    data = []
    for geo, name, v in [(' "51003"', "Albemarle, VA", "10"), (' "51901"', "Albemarle + City, VA", "30"), (' "09110"', "New, CT", "1"),
                         (' "02013"', "Far, AK", "1"), (' "01000"', "Alabama", "9")]:
        data += [(geo, name, n, v, "(NA)") for n in names]
    raw = spark.createDataFrame(data, "GeoFIPS string, GeoName string, Description string, `2001` string, `2002` string")
    out = cleaning.clean_gdp(raw, [2001, 2002])
    got = rows(out.select("county_id", "year", "real_gdp_2017_dollars_thousands", "quantity_index_gdp"))
    assert got == [("51003", 2001, 40, 20.0), ("51003", 2002, 0, None)]


def test_personal_income(spark):
    names = ["Per capita personal income (dollars) 2/", "Personal income (thousands of dollars) ", "Population (persons) 1/"]
    raw = spark.createDataFrame([("24005", "B, MD", n, "10") for n in names] + [("24510", "B city, MD", n, "30") for n in names],
                                "GeoFIPS string, GeoName string, Description string, `2010` string")
    out = cleaning.clean_personal_income(raw, [2010])
    assert rows(out.select("county_id", "personal_income_thousands_of_dollars", "per_capita_personal_income_dollars")) == [("24005", 40, 20.0)]


def test_population(spark):
    lines = spark.createDataFrame([("2001AL0101001  1010000000012",), ("2001AL0101001  1020000000030",), ("1999AL0101001  1010000000012",),
                                   ("2001VA5151917  1010000000005",), ("2001AK0202013  1010000000005",)], "raw_line string")
    assert rows(cleaning.clean_population(lines)) == [(2001, "01001", 42), (2001, "51019", 5)]


def test_permits(spark):
    df = spark.createDataFrame([("01", "001", 1, 2, 3, 4), ("51", "003", 1, 1, 1, 1), ("51", "540", 5, 5, 5, 5)],
                               "STATE string, COUNTY string, ALL_PERMITS_2021 int, ALL_PERMITS_2022 int, MULTIFAMILY_PERMITS_3_4_UNITS_2021 int, "
                               "MULTIFAMILY_PERMITS_3_4_UNIT_2022 int")
    out = cleaning.clean_permits(df, [2021, 2022])
    got = rows(out.select("county_id", "year", "all_permits", "multifamily_permits_3_4_units"))
    assert got == [("01001", 2021, 1, 3), ("01001", 2022, 2, 4), ("51003", 2021, 6, 6), ("51003", 2022, 6, 6)]


def test_unemployment(spark):
    data = [(1001, "AL", "Autauga County, AL", f"{a}_2005", v) for a, v in
            [("Civilian_labor_force", "1,000"), ("Employed", "900"), ("Unemployed", "100"), ("Unemployment_rate", "10.0"), ("Other", "1")]]
    data += [(1000, "AL", "Alabama", "Employed_2005", "9"), (11000, "DC", "District of Columbia", "Employed_2005", "9")]
    raw = spark.createDataFrame(data, "FIPS_Code int, State string, Area_Name string, Attribute string, Value string")
    assert rows(cleaning.clean_unemployment(raw)) == [("01001", 2005, 1000, 900, 100, 10.0)]


def test_business_patterns(spark):
    raw = spark.createDataFrame(
        [("51", "003", "11----", "A", 5, 6, 7, "3", "N", 2005), ("51", "540", "11----", None, 1, 1, 1, "2", "4", 2005),
         ("51", "003", "111///", None, 9, 9, 9, "9", "9", 2005), ("01", "999", "11----", None, 9, 9, 9, "9", "9", 2005)],
        "FIPSTATE string, FIPSCTY string, NAICS string, EMPFLAG string, EMP int, AP int, EST int, `N<5` string, N5_9 string, YEAR int")
    out = cleaning.clean_business_patterns(raw)
    assert rows(out.select("county_id", "year", "naics_industry_code", "tot_employee_count", "`est<5`", "est5_9")) == [
        ("51003", 2005, "11", 6.0, 2.0, 4.0)]
    hidden = cleaning.clean_business_patterns(raw.where("EMPFLAG = 'A'"), null_sum=True)
    assert hidden.first()["est<5"] is None


def test_counties(spark):
    codes = spark.createDataFrame([("AL", "01", "001", "1", "A", "H1", "A"), ("PR", "72", "001", "1", "B", "H1", "A"), ("VA", "51", "510", "1", "C", "C7", "F"),
                                   ("AL", "01", "003", "1", "D", "H1", "S"), ("AL", "01", "005", "1", "E", "H1", "A")],
                                  "STATE string, STATEFP string, COUNTYFP string, COUNTYNS string, COUNTYNAME string, CLASSFP string, FUNCSTAT string")
    points = spark.createDataFrame([("1001", "-86.5", "32.5")], "FIPS_CD string, LONGITUDE string, LATITUDE string")
    areas = spark.createDataFrame([("01001", "10", "1")], "GEOID string, ALAND_SQMI string, AWATER_SQMI string")
    older = spark.createDataFrame([("01005", "7", "2"), ("01001", "99", "99")], "GEOID string, ALAND_SQMI string, AWATER_SQMI string")
    out = cleaning.clean_counties(codes, points, areas, older)
    assert rows(out.select("county_id", "centroid_lat", "land_area_sqmi", "water_area_sqmi")) == [
        ("01001", 32.5, 10.0, 1.0), ("01005", None, 7.0, 2.0)]


def test_establishments(spark):
    data = [("01001", "518", 75, y, q, n) for y, ns in ((2004, (1, 3)), (2007, (6, 2))) for q, n in enumerate(ns)]
    data += [("01001", "10", 75, 2005, 1, 99), ("01999", "518", 75, 2004, 1, 9), ("01001", "518", 70, 2005, 1, 99)]
    raw = spark.createDataFrame(data, "area_fips string, industry_code string, agglvl_code int, year int, qtr int, qtrly_estabs int")
    counties = spark.createDataFrame([("01001", 1.0, 1.0), ("01003", 1.0, 1.0)], "county_id string, land_area_sqmi double, water_area_sqmi double")
    out = rows(cleaning.clean_establishments(raw, counties, 2003, 2008).select("county_id", "year", "estabs", "estabs_was_imputed"))
    assert [r[2:] for r in out[:6]] == [(0.0, True), (3.0, False), (4.0, True), (5.0, True), (6.0, False), (0.0, True)]
    assert {r[2:] for r in out[6:]} == {(0.0, None)}


def test_air_quality(spark):
    daily = spark.createDataFrame([("2001", "1", "1", "1,000.0", 1.0, 1.0, 1.0), ("2001", "1", "1", "2,000.0", 3.0, 1.0, 1.0)],
                                  "year string, statefips string, countyfips string, pm25_max_pred string, pm25_med_pred double, pm25_mean_pred double, pm25_pop_pred double")
    counties = spark.createDataFrame([("01001",), ("01003",), ("02001",)], "county_id string")
    edges = spark.createDataFrame([("01003", "01001", 1, 10.0), ("01001", "01003", 1, 10.0)], "county_id string, neighbor string, rank int, distance double")
    out = cleaning.clean_air_quality(daily, counties, edges)
    assert out.count() == 2 * 22
    got = rows(out.where("year = 2001").select("county_id", "pm25_max_daily_avg", "pm25_med_sd"))
    assert [r[:2] for r in got] == [("01001", 1500.0), ("01003", 1500.0)] and close(got[1][2], 2 ** 0.5)


def test_outcome_rules():
    terms = panel.excluded_terms("population_log")
    assert set(panel.TERM_GROUPS["permit"]) <= set(terms) and set(panel.TERM_GROUPS["sector"]) <= set(terms)
    assert "unemployment_rate_pct" not in terms and "year_num" in terms
    lagged = panel.lagged_groups({**panel.TERM_GROUPS, "dc": []})
    assert lagged["dc"] == [] and lagged["dc_density"] == ["datacenters_per_100_sqmi_lag2", "nearby_datacenters_50mi_per_100_sqmi_lag2"]


def test_files_round_trip(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame([("01", "á", 1.5), ("02", "b", None)], "id string, name string, v double")
    df.coalesce(1).write.option("header", True).option("encoding", "ISO-8859-1").csv(folder + "/raw")
    back = readers.read_delimited(spark, folder + "/raw", "id string, name string, v double", encoding="ISO-8859-1")
    assert rows(back) == rows(df)
    ledger = writers.archive(spark, [("t", folder + "/raw", "latin-1"), ("big", "none", ",")], folder + "/out", ["big"]).collect()
    assert [r["file"] for r in ledger] == ["t"] and ledger[0]["orig_bytes"] > 0 and ledger[0]["pq_bytes"] > 0
    writers.restore(spark, folder + "/out/t.parquet", folder + "/again")
    assert rows(readers.read_delimited(spark, folder + "/again").select("id", "name")) == [("01", "á"), ("02", "b")]


def test_tables_are_replaced_and_dropped(spark, tmp_path):
    for n in (3, 5):
        writers.save_table(spark.range(n), "round_trip", "gridpanel_test", path=str(tmp_path / "t"))
    assert readers.load_table(spark, "round_trip", "gridpanel_test").count() == 5
    writers.drop_tables(spark, ["round_trip", "missing"], "gridpanel_test")
    assert not spark.catalog.tableExists("gridpanel_test.round_trip")
    spark.sql("DROP DATABASE gridpanel_test")


def test_features_and_recode(spark):
    text = '{"type":"Feature","id":"%s","geometry":{"type":"Polygon","coordinates":[[[0.0,1.0],[2.0,3.0],[0.0,1.0]],[[0.5,1.5]]]}}'
    df = spark.createDataFrame([(text % "46113",), (text % "01001",)], "feature string")
    points = readers.explode_features(df, recode={"46113": "46102"})
    assert points.count() == 8
    assert rows(readers.bounding_boxes(points))[1] == ("46102", 0.0, 2.0, 1.0, 3.0, 4)


def test_checkpoint_cuts_lineage(spark):
    df = checkpointed(spark.range(10).withColumn("x", F.col("id") * 2))
    assert "Range" not in df._jdf.queryExecution().logical().toString() and df.count() == 10


@pytest.mark.parametrize("text,expected", [("2001AB01001", ("2001", "01001")), ("01", ("01", "01"))])
def test_slices_of_short_fields(spark, text, expected):
    df = spark.createDataFrame([(text,)], "raw_line string")
    out = readers.parse_fixed_width(df, {"a": (0, 0, 4, "string"), "b": (0, -5, None, "string")})
    assert tuple(out.first()) == expected
