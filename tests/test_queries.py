"""The registry, and a sample of the registered queries against their SQL.

GRIDPANEL_ALL=1 compares every query; tools/check.py does the same with timings.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from tools.check import TABLES, rows_of

FOLDER = os.environ.get("GRIDPANEL_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()
SAMPLE = ["s6_read_yearly_files", "p10_coerce_numeric", "j2_assemble_panel", "a13_pivot_buckets", "w1_add_lags_hot",
          "w5_interpolate_hot", "g5_spatial_then_yoy", "g9_annualize", "q5_presence_matrix", "f1_profile", "m4_panel_ols",
          "m24_att_gt"]
CHOSEN = sorted(ORACLES) if os.environ.get("GRIDPANEL_ALL") else SAMPLE


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_registry():
    assert set(ORACLES) <= set(QUERIES) and entry_module.FLAGSHIP in ORACLES


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cur.fetchall())
