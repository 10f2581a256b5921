"""Edge rules of the cleaning, reshape, join and aggregate operators."""

import gzip

import pytest
from pyspark.sql import functions as F

from conftest import close, rows
from gridpanel.functions import expressions as X
from gridpanel.operators import aggregate, clean, joins, quality, reshape, sets, skew
from gridpanel.sources import readers


def test_zero_pad_never_truncates(spark):
    df = spark.createDataFrame([("7",), ("123456",), (None,)], "c string")
    assert [r[0] for r in df.select(X.zero_pad("c", 5)).collect()] == ["00007", "123456", None]


def test_parse_number(spark):
    df = spark.createDataFrame([("1,234.5",), ("N",), ("(NA)",), (" 7 ",), ("",), ("NaN",), (None,)], "c string")
    assert [r[0] for r in df.select(X.parse_number("c")).collect()] == [1234.5, None, None, 7.0, None, None, None]


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert rows(clean.exclude_values(df, "c", ["a"])) == [("b",), (None,)]


def test_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "v double")
    assert [r[0] for r in df.select(X.half_even("v")).collect()] == [0.0, 2.0, 2.0, 0.0]


def test_split_last(spark):
    df = spark.createDataFrame([("Civilian_labor_force_2010",), ("plain",)], "c string")
    head, tail = reshape.split_suffix("c")
    assert [tuple(r) for r in df.select(head, tail).collect()] == [("Civilian_labor_force", 2010), ("plain", None)]


def test_rename_takes_any_spelling(spark):
    df = spark.createDataFrame([(1, None, 3), (None, 2, 4)], "`N1_4` int, `N<5` int, `EMP` int")
    out = clean.rename_map(df, {"n1_4": "est<5", "n<5": "est<5", "emp": "tot"})
    assert out.columns == ["est<5", "tot"] and rows(out, "tot") == [(1, 3), (2, 4)]


def test_null_by_flag(spark):
    df = spark.createDataFrame([("A", 1, 2), ("B", 1, 2), (None, 1, 2), ("J", 1, 2)], "f string, `est<5` int, b int")
    out = clean.null_by_flag(df, "f", {"A": ["est<5"], "B": ["b", "missing"]})
    assert [tuple(r)[1:] for r in out.collect()] == [(None, 2), (1, None), (1, 2), (1, 2)]


def test_remap_with_map_and_frame(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "id string")
    frame = spark.createDataFrame([("1", "9")], "a string, b string")
    for crosswalk in ({"1": "9"}, frame):
        assert rows(clean.remap_codes(df, "id", crosswalk)) == [("2",), ("9",), (None,)]


def test_per_capita_zero_base_is_null(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0), (None, 2.0)], "v double, p double")
    out = clean.per_capita(df, ["v"], "p")
    assert out.columns == ["p", "v_per_capita"] and sorted(r[1] or 0 for r in out.collect()) == [0, 0, 2.0]


def test_sum_of_nothing_is_zero_and_null_keys_vanish(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0), (None, 5.0)], "k string, v double")
    assert rows(aggregate.agg_sum(df, ["k"], ["v"])) == [("a", 0.0), ("b", 2.0)]
    assert rows(aggregate.agg_sum(df, ["k"], ["v"], null_sum=True)) == [("a", None), ("b", 2.0)]
    assert rows(aggregate.agg_std(df, ["k"], ["v"])) == [("a", None), ("b", None)]


def test_rollup_children(spark):
    df = spark.createDataFrame(
        [("c1", 1, 2, 1.0, "x"), ("p", 1, 3, 3.0, "y"), ("q", 1, None, 5.0, "z")], "id string, t int, n int, rate double, s string")
    out = aggregate.rollup_children(df, {"c1": "p"}, "id", "t", "All", ["rate"])
    assert out.columns == ["id", "t", "n", "rate"] and rows(out) == [("p", 1, 5, 2.0), ("q", 1, 0, 5.0)]
    with pytest.raises(ValueError):
        aggregate.rollup_children(df, {}, "id", "t", "All", "All")
    with pytest.raises(ValueError):
        aggregate.rollup_children(df, {}, "id", "t", ["n"], ["rate"])


def test_mode_lowest_on_ties(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (2, "c"), (2, "a"), (3, None)], "e int, l string")
    assert rows(aggregate.entity_mode(df, "e", "l")) == [(1, "a"), (2, "c")]


def test_pivot_buckets(spark):
    df = spark.createDataFrame(
        [("e", 1, "11", 2.0), ("e", 1, "12", None), ("e", 1, "99", 7.0), ("f", 1, "12", 3.0), ("g", 1, "99", 1.0)],
        "e string, t int, code string, m double")
    codes = spark.createDataFrame([("11", "x"), ("12", "y")], "c string, b string")
    out = aggregate.pivot_buckets(df, "code", codes, ["e", "t"], ["m"], ["x", "y"])
    assert out.columns == ["e", "t", "m_x", "m_y"]
    assert rows(out) == [("e", 1, 2.0, 0.0), ("f", 1, None, 3.0)]


def test_assemble_rejects_repeated_keys(spark):
    base = spark.createDataFrame([("a", 1), ("b", 1)], "e string, t int")
    good = spark.createDataFrame([("a", 1, 5)], "e string, t int, v int")
    bad = spark.createDataFrame([("a", 1, 5), ("a", 1, 6)], "e string, t int, v int")
    assert rows(joins.assemble_panel(base, {"g": good}, ["e", "t"])) == [("a", 1, 5), ("b", 1, None)]
    with pytest.raises(Exception, match="bad is not unique on e, t: a, 1"):
        joins.assemble_panel(base, {"bad": bad}, ["e", "t"]).collect()
    with pytest.raises(joins.NotUnique, match="1 repeated keys") as caught:
        joins.check_unique(bad, ["e", "t"], "bad")
    assert rows(caught.value.offenders) == [("a", 1, 2)]
    report = joins.assembly_report(joins.assemble_panel(base, {"g": good}, ["e", "t"]), ["e", "t"])
    assert rows(report) == [("v", 0.5)]
    with pytest.raises(joins.NotUnique, match="lacks"):
        joins.assemble_panel(base, {"short": good.drop("t")}, ["e", "t"])


def test_melt_keeps_nulls_and_pivot_rejects_doubles(spark):
    wide = spark.createDataFrame([("a", 1, None)], "id string, `2001` int, `2002` int")
    long = reshape.melt_years(wide, ["id"], ["2001", "2002"])
    assert rows(long) == [("a", "2001", 1), ("a", "2002", None)]
    twice = long.unionByName(long)
    filled = twice.fillna(7)
    with pytest.raises(Exception, match="two rows for one cell of 2001"):
        reshape.pivot_attribute(filled, ["id"], "year", "value", ["2001"]).collect()


def test_coalesce_join_follows_the_deciding_column(spark):
    base = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    first = spark.createDataFrame([("a", 1.0, None), ("b", None, 9.0)], "k string, land double, water double")
    second = spark.createDataFrame([("a", 5.0, 6.0), ("b", 7.0, 8.0)], "k string, land double, water double")
    out = joins.coalesce_join(base, first, second, "k", ["land", "water"], "land")
    assert rows(out) == [("a", 1.0, None), ("b", 7.0, 8.0), ("c", None, None)]


def test_presence(spark):
    dim = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    f1 = spark.createDataFrame([("a",), ("a",), ("b",), ("x",), (None,)], "id string")
    f2 = spark.createDataFrame([("a",)], "id string")
    out = quality.presence_matrix(dim, {"f1": f1, "f2": f2}, "id")
    assert rows(out) == [("b", 1, 0, 1), ("c", 0, 0, 0)]
    assert rows(quality.presence_matrix(dim, {"f1": f1, "f2": f2}, "id", below=1)) == [("c", 0, 0, 0)]
    assert rows(quality.check_orphans({"f1": (f1.dropna(), "id")}, dim, "id")) == [("f1", "x")]
    assert rows(sets.not_in_every({"a": f1.dropna(), "b": f2}, "id")) == [("b",), ("x",)]


def test_symmetric_difference_goes_both_ways(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 2), ("c", 2)], "k string, t int")
    assert rows(sets.symmetric_difference(df, "k", "t", 1, 2)) == [("b", 1), ("c", 2)]


def test_missing_share_and_zero_rows(spark):
    df = spark.createDataFrame([(0, None), (0, 1.0), (3, 0.0), (None, 0.0)], "a int, b double")
    assert dict(aggregate.missing_share(df).collect()) == {"a": 0.25, "b": 0.25}
    assert dict(clean.rows_with_zero(df, ["a", "b"]).collect()) == {"a": 2, "b": 2}


def test_skew_join_equals_plain_join(spark):
    from gridpanel.operators.skew import heavy_keys, skew_join
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = {"parts": 10, "min_rows": 100}
    assert heavy_keys(left, ["k"], **small).count() == 1
    for how in ("inner", "left"):
        a = skew_join(left, right, ["k"], ["id"], how, salts=7, **small)
        assert rows(a.select("id", "k", "v")) == rows(left.join(right, "k", how).select("id", "k", "v"))


def test_normal_functions(spark):
    import math
    df = spark.createDataFrame([(x / 4,) for x in range(40)], "z double").select("z", X.normal_tail("z").alias("t"))
    assert all(close(r["t"], 0.5 * math.erfc(r["z"] / math.sqrt(2)), 1e-12) for r in df.collect())
    back = df.select("z", X.normal_quantile(1 - F.col("t")).alias("q")).where("z < 5")
    assert all(abs(r["z"] - r["q"]) < 1e-7 for r in back.collect())


def test_remap_codes_refuses_a_second_parent(spark):
    df = spark.createDataFrame([("a",), ("b",)], "id string")
    same = spark.createDataFrame([("a", "x"), ("a", "x")], "c string, p string")
    assert rows(clean.remap_codes(df, "id", same)) == [("b",), ("x",)]
    two = same.unionByName(spark.createDataFrame([("a", "y")], "c string, p string"))
    with pytest.raises(Exception, match="two parents for a"):
        clean.remap_codes(df, "id", two).collect()


def test_long_numbers_keep_their_digits(spark):
    df = spark.createDataFrame([("9,007,199,254,740,993",), ("12.7",), ("12.0",), ("x",), ("-3",)], "v string")
    assert [r[0] for r in clean.coerce_numeric(df, ["v"], "long").collect()] == [9007199254740993, None, 12, None, -3]


def test_typed_read_finds_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,emp,est\n01,5,NaN\n02,x,2.5\n")
    got = readers.read_delimited(spark, str(tmp_path / "a.csv"), "est double, id string, emp int")
    assert got.dtypes == [("est", "double"), ("id", "string"), ("emp", "int")]
    assert sorted(map(tuple, got.collect()), key=str) == [(2.5, "02", None), (None, "01", 5)]
    assert readers.read_delimited(spark, str(tmp_path / "a.csv"), "emp long").collect()[0][0] == 5


def test_yearly_files_follow_their_own_headers(spark, tmp_path):
    (tmp_path / "y01.csv").write_text("id,emp,est\na,1,2\n")
    (tmp_path / "y02.csv").write_text("ID,EST,EMP\nb,20,10\n")
    (tmp_path / "y03.csv").write_text("id,EMP_N\nc,100\n")
    got = readers.read_yearly_files(spark, str(tmp_path / "*.csv"), r"y(\d+)", 2000, {"emp_n": "emp"})
    assert rows(got.select("id", "emp", "est", "year"), "id") == [("a", "1", "2", 2001), ("b", "10", "20", 2002), ("c", "100", None, 2003)]


def test_yearly_files_take_no_job_per_file(spark, tmp_path):
    for i in range(30):
        header = "id,emp" if i % 2 else "\nID,EMP,Est"
        (tmp_path / f"y{i:02}.csv").write_text(f"{header}\n{i},{i * 2},7\n" if i % 2 == 0 else f"{header}\n{i},{i * 2}\n")
    (tmp_path / "y30.csv").write_text("")
    (tmp_path / "y31.csv").write_text("\n \n")
    with gzip.open(tmp_path / "y32.csv.gz", "wt") as f:
        f.write("id,emp\n32,64\n")
    spark.sparkContext.setJobGroup("yearly", "yearly files")
    got = readers.read_yearly_files(spark, str(tmp_path / "*.csv*"), r"y(\d+)", 2000)
    spark.sparkContext.setJobGroup("others", "")
    # One to list the files, and one per layout for its column names.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("yearly")) <= 4
    want = [(str(i), str(2 * i), None if i % 2 or i == 32 else "7", 2000 + i) for i in [*range(30), 32]]
    assert sorted(rows(got.select("id", "emp", "est", "year")), key=lambda r: r[3]) == want


def test_yearly_files_without_any_header_are_an_error(spark, tmp_path):
    (tmp_path / "y01.csv").write_text("")
    with pytest.raises(ValueError, match="no file"):
        readers.read_yearly_files(spark, str(tmp_path / "*.csv"), r"y(\d+)")


def test_salted_join_refuses_full(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError):
        skew.skew_join(df, df, ["k"], ["v"], how="full")


def test_unknown_bucket_is_an_error(spark):
    df = spark.createDataFrame([("e", 1, "11", 2.0)], "e string, t int, code string, m double")
    codes = spark.createDataFrame([("11", "z")], "c string, b string")
    with pytest.raises(Exception, match="unknown bucket z"):
        aggregate.pivot_buckets(df, "code", codes, ["e", "t"], ["m"], ["x"]).collect()
