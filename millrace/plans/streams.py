"""Streams over the events table, run to its end."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.roles import query, table
from millrace.streaming import events


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which all machines share; a temporary one where that is unset on a single machine."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    root = root or f"file://{tempfile.mkdtemp(prefix='millrace-')}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stream(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "events").schema
    landing = folder(spark, "landing")
    table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).repartitionByRange(4, "ts").write.parquet(landing)
    fields = ", ".join(f"{f.name} {'timestamp' if f.name == 'ts' else f.dataType.simpleString()}" for f in schema)
    return events.event_stream(spark, landing, fields, 4)


@query("", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_window_counts(spark: SparkSession, d: str) -> DataFrame:
    """Daily counts as a stream makes them, in complete mode, so that the last windows are there, too."""
    target = folder(spark, "counts")
    out = events.window_counts(stream(spark, d), "ts", "event_type")
    events.run_available(out, folder(spark, "stream"), each=events.into(target), mode="complete")
    return events.newest_rows(spark, target).select(F.to_date("window_start").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


@query("", "SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def stream_newest(spark: SparkSession, d: str) -> DataFrame:
    """The newest event of each user, merged batch by batch."""
    target = folder(spark, "newest")
    events.run_available(stream(spark, d), folder(spark, "stream"), each=events.newest_into(spark, target, "user_id", ["ts", "event_id"]))
    return events.newest_rows(spark, target).select("user_id", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type")


@query("", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """One row of each user, type and day, as a stream keeps them."""
    target = folder(spark, "dedup")
    rows = stream(spark, d).select("user_id", "event_type", F.to_date("ts").alias("day"), "ts")
    events.run_available(events.without_copies(rows, "ts", ["user_id", "event_type", "day"], "60 days").drop("ts"), folder(spark, "stream"), path=target)
    return spark.read.parquet(target)
