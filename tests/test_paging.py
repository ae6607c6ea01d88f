import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import paging

ORDER = [("grade", True), ("score", False), ("key", False)]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = [(i, rng.choice(["A", "B", None]), rng.choice([1.5, 2.5, None, 7.0]), "x") for i in range(500)]
    want = sorted(data, key=lambda r: (r[1] is None, -ord(r[1]) if r[1] else 0, r[2] is None, r[2] or 0, r[0]))
    return spark.createDataFrame(data, "key int, grade string, score double, row string").repartition(7), want


def test_seeking_meets_every_row_once(rows):
    df, want = rows
    last, got = None, []
    while page := paging.seek(df, ORDER, 120, last).collect():
        got += [tuple(r) for r in page]
        last = page[-1].asDict()
    assert got == want


def test_a_page_is_taken_by_each_task_and_the_comparison_goes_to_the_scan(spark, rows, tmp_path):
    df, _ = rows
    df.write.parquet(f"{tmp_path}/t")
    plan = paging.seek(spark.read.parquet(f"{tmp_path}/t"), [("key", False)], 10, {"key": 400})._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "GreaterThan(key,400)" in plan and "Window" not in plan


def test_numbers_and_pages_from_ranges(spark, rows, tmp_path):
    df, want = rows
    with_files = df.withColumn("pad", F.lit("y"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "60")
    try:
        paging.number_rows(with_files, ORDER, f"{tmp_path}/n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    got = paging.numbered(spark, f"{tmp_path}/n").collect()
    assert [tuple(r)[:4] for r in sorted(got, key=lambda r: r["row_number"])] == want
    assert sorted(r["row_number"] for r in got) == list(range(1, 501))
    files = spark.read.parquet(f"{tmp_path}/n/index").count()
    assert files >= 8
    for number, size in ((1, 10), (13, 38), (14, 38), (15, 38), (3, 1), (1, 1000), (500, 1)):
        page = paging.page(spark, f"{tmp_path}/n", number, size)
        assert [tuple(r)[:4] for r in sorted(page.collect(), key=lambda r: r["row_number"])] == want[(number - 1) * size : number * size]
    assert len(paging.page(spark, f"{tmp_path}/n", 14, 20).inputFiles()) <= 3 < files


def test_empty_tables(spark, rows, tmp_path):
    df, _ = rows
    paging.number_rows(df.limit(0), ORDER, f"{tmp_path}/e")
    assert paging.numbered(spark, f"{tmp_path}/e").count() == 0 and paging.page(spark, f"{tmp_path}/e", 3, 5).count() == 0
    assert paging.seek(df.limit(0), ORDER, 5, {"grade": None, "score": None, "key": 1}).count() == 0
