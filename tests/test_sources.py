"""Sources, sinks, run log and streams."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.sources import pages, runs, sinks
from millrace.streaming import events


def test_json_pages(spark, tmp_path):
    run = tmp_path / "run_id=scheduled__1"
    run.mkdir()
    (run / "page_offset=0.json").write_text(json.dumps([{"camis": "1", "dba": "A"}, {"camis": "2"}], indent=1))
    (run / "request.json").write_text("{}")
    got = pages.read_pages(spark, str(tmp_path), pages.text_schema(["camis", "dba"])).collect()
    assert [(r.camis, r.dba, r.run_id) for r in got] == [("1", "A", "scheduled__1"), ("2", None, "scheduled__1")] and got[0].source_file.endswith("page_offset=0.json")


def test_origins_are_added_where_they_lack(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/run_id=manual__7/a")
    spark.range(2).selectExpr("id", "'kept' AS source_file", "'r' AS run_id").write.parquet(f"{tmp_path}/b")
    new = pages.with_origin(spark.read.parquet(f"{tmp_path}/run_id=manual__7/a")).collect()
    assert {r.run_id for r in new} == {"manual__7"} and all(r.source_file.endswith(".parquet") for r in new)
    assert {(r.source_file, r.run_id) for r in pages.with_origin(spark.read.parquet(f"{tmp_path}/b")).collect()} == {("kept", "r")}


def test_lists(spark, tmp_path):
    (tmp_path / "a.csv").write_text("zip,name\n00501,x\n")
    assert pages.read_list(spark, str(tmp_path / "a.csv"), ["zip"]).first()[0] == "00501"
    with pytest.raises(ValueError, match="lacks"):
        pages.read_list(spark, str(tmp_path / "a.csv"), ["zip", "nta"])


def test_paged_source(spark, tmp_path):
    records = [{"id": str(i), "at": f"2026-08-{i + 1:02d}", "x": {"a": i}} for i in range(3)]
    (tmp_path / "page-0.json").write_text(json.dumps(records[:2]))
    (tmp_path / "page-1.json").write_text(json.dumps(records[2:]))
    spark.dataSource.register(pages.PagedSource)
    read = spark.read.format("pages").option("path", str(tmp_path)).option("columns", "id,at,x").option("page_size", "2").option("required", "id")
    assert sorted(r.id for r in read.load().collect()) == ["0", "1", "2"]
    assert [r.id for r in read.option("at", "at").option("start", "2026-08-02").option("end", "2026-08-03").load().collect()] == ["1"]
    with pytest.raises(ValueError):
        pages.checked([{"id": ""}], ["id"], 5)
    with pytest.raises(ValueError):
        pages.checked([{}] * 3, [], 2)


def test_writes_are_new_and_verified(spark, tmp_path):
    df = spark.range(10).withColumn("year", F.col("id") % 2)
    assert sinks.write_verified(df, f"{tmp_path}/a", ("year",)) == 10
    with pytest.raises(Exception, match="exists"):
        sinks.write_verified(df, f"{tmp_path}/a")
    assert sinks.write_report(spark, f"{tmp_path}/r", {"status": "SUCCESS", "n": 1}) and not sinks.write_report(spark, f"{tmp_path}/r", {"n": 1, "status": "SUCCESS"})
    with pytest.raises(FileExistsError):
        sinks.write_report(spark, f"{tmp_path}/r", {"n": 2})
    assert sinks.prepared_output(spark, [f"{tmp_path}/a"], f"{tmp_path}/r")["n"] == 1
    with pytest.raises(FileExistsError):
        sinks.prepared_output(spark, [f"{tmp_path}/a"], f"{tmp_path}/none")
    assert sinks.prepared_output(spark, [f"{tmp_path}/b"], f"{tmp_path}/none") is None
    sinks.register_table(spark, "made_by_test", f"{tmp_path}/a")
    assert spark.table("made_by_test").where("year = 1").count() == 5
    spark.sql("DROP TABLE made_by_test")
    assert sinks.smoke(spark, f"{tmp_path}/s")


def test_chunks(spark, tmp_path):
    df = spark.createDataFrame([("Ab", 1), ("0c", 2), ("zz", 3)], "key string, v int")
    sinks.export_chunks(df, f"{tmp_path}/c", "key")
    assert {(r.chunk, r.v) for r in spark.read.json(f"{tmp_path}/c").collect()} == {("a", 1), ("0", 2), ("other", 3)}


def test_run_log(spark, tmp_path):
    log = runs.RunLog(spark, f"{tmp_path}/log")
    span = runs.window(None, datetime(2026, 8, 28, 12))
    assert (span.end - span.start).days == 1095 and log.watermark("s") is None
    assert runs.window(datetime(2026, 8, 20), datetime(2026, 8, 28)).start == datetime(2026, 8, 18)
    with pytest.raises(ValueError):
        runs.window(datetime(2026, 8, 30), datetime(2026, 8, 20))
    log.start("scheduled__a", "s", "2026-08-28", span, "p")
    log.fail("scheduled__a", "s", "broken")
    assert log.get("scheduled__a", "s")["status"] == "FAILED"
    with pytest.raises(ValueError):
        log.start("scheduled__a", "s", "2026-08-28", runs.window(None, datetime(2026, 8, 29)), "p")
    log.start("scheduled__a", "s", "2026-08-28", span, "p")
    log.finish("scheduled__a", "s", 3, "2026-08-27")
    log.start("scheduled__b", "s", "2026-08-29", span, "p")
    log.finish("scheduled__b", "s", 0, "2026-08-01")
    log.start("test__c", "s", "2026-08-29", span, "p")
    log.finish("test__c", "s", 5, "2026-08-02")
    assert log.watermark("s") == "2026-08-27" and [r.run_id for r in log.selected("s").collect()] == ["scheduled__a"]
    assert log.start("scheduled__a", "s", "later", span, "p")["status"] == "SUCCESS"
    assert log.pending("s", ["scheduled__a"]).count() == 0 and log.pending("s", []).count() == 1
    assert runs.safe_run_id("scheduled__2026-09-06T10:00:00-04:00") == "scheduled__2026-09-06T10_00_00-04_00"


def landed(spark, tmp_path, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "k int, ts timestamp, value double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return events.event_stream(spark, f"{tmp_path}/in", "k int, ts timestamp, value double")


def test_newest_rows_merge_and_batches_may_repeat(spark, tmp_path):
    day = lambda d: datetime(2024, 1, d)
    stream = landed(spark, tmp_path, [[(1, day(1), 1.0), (2, day(5), 2.0)], [(1, day(3), 3.0), (2, day(4), 4.0)], [(3, day(1), 5.0)]])
    merge = events.newest_into(spark, f"{tmp_path}/out", "k", ["ts"])
    events.run_available(stream, f"{tmp_path}/check", each=merge)
    want = {(1, 3.0), (2, 2.0), (3, 5.0)}
    assert {(r.k, r.value) for r in events.newest_rows(spark, f"{tmp_path}/out").collect()} == want
    merge(spark.createDataFrame([(3, day(1), 5.0)], "k int, ts timestamp, value double"), 2)
    assert {(r.k, r.value) for r in events.newest_rows(spark, f"{tmp_path}/out").collect()} == want


def test_windows_sessions_and_copies(spark, tmp_path):
    at = lambda h, m=0: datetime(2024, 1, 1, h, m)
    stream = landed(spark, tmp_path, [[(1, at(1), 1.0), (1, at(1, 10), 2.0), (1, at(1, 10), 2.0)], [(1, at(5), 4.0)]])
    events.run_available(events.window_counts(stream, "ts", "k", "1 hour"), f"{tmp_path}/c1", "w_counts", mode="complete")
    assert {(r.window_start.hour, r.n, r.total) for r in spark.table("w_counts").collect()} == {(1, 3, 5.0), (5, 1, 4.0)}
    events.run_available(events.sessions(stream, "ts", "k"), f"{tmp_path}/c2", "w_sessions", mode="complete")
    assert sorted(r.n for r in spark.table("w_sessions").collect()) == [1, 3]
    events.run_available(events.without_copies(stream, "ts", ["k", "ts"]), f"{tmp_path}/c3", "w_copies")
    assert spark.table("w_copies").count() == 3
