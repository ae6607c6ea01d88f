"""Every registered query against its SQL in DuckDB, over small tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

from millrace.plans import cleansing, increments, learning, lookups, models, reads, requests, roles, streams  # noqa: F401

DATA = "/root/testdata/sf0.001"
#: Models that can't learn from nothing.
LEARNED = ("logistic_scores", "gbt_scores", "refreshed_scores", "tree_factors", "logistic_grid", "tree_grid")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return repr(round(float(v), 5) + 0.0)
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else str(v)


@pytest.mark.parametrize("name", sorted(roles.ORACLES))
def test_same_rows_as_sql(spark, con, name):
    df = roles.QUERIES[name](spark, DATA)
    cursor = con.execute(roles.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert ours == sorted(tuple(map(plain, r)) for r in cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(roles.QUERIES) - set(roles.ORACLES)))
def test_queries_without_sql_run(spark, name):
    rows = roles.QUERIES[name](spark, DATA).collect()
    assert rows and all(0 <= r["risk"] <= 1 for r in rows if "risk" in r)


@pytest.mark.parametrize("name", ["area_grade_summary", "violation_by_area", "nearest_match", "history_features", "name_normalize"])
def test_plans_have_no_python_and_no_cartesian_product(spark, name):
    plan = roles.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "MapInPandas" not in plan


@pytest.mark.parametrize("name", sorted(n for n in roles.QUERIES if n not in LEARNED and not n.startswith("stream_")))
def test_empty_tables_do_not_fail(spark, tmp_path_factory, name, empty):
    roles.QUERIES[name](spark, empty).collect()


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for p in glob.glob(f"{DATA}/*.parquet"):
        spark.read.parquet(p).limit(0).write.parquet(f"{d}/{os.path.basename(p)}")
    return d


@pytest.mark.parametrize("codes", [("A", "R"), ("R", "A")])
def test_codes_of_one_line_and_day_have_an_order(spark, tmp_path, codes):
    day = datetime.datetime(2000, 1, 2)
    spark.createDataFrame([(1, 7, day, 1.0, "F", "x")], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 1, c, "F", day, 1.0) for c in codes], "l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate timestamp, l_quantity double").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert {r["code"]: r["place"] for r in roles.QUERIES["recent_findings_top6"](spark, str(tmp_path)).collect()} == {"AF": 1, "RF": 2}
