"""The record of ingestion runs: windows, states, watermarks and which runs are taken."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOG = "run_id string, source string, seq long, status string, started string, window_start string, window_end string, rows long, watermark string, path string, error string"
OVERLAP_DAYS, FIRST_DAYS = 2, 1095


@dataclass(frozen=True)
class Window_:
    """A half-open stretch of source time."""

    start: datetime
    end: datetime


def safe_run_id(run_id: str) -> str:
    token = re.sub(r"[^A-Za-z0-9_.-]+", "_", run_id).strip("_")
    if not token:
        raise ValueError("an empty run id")
    return token


def window(watermark: datetime | None, end: datetime, start: datetime | None = None, overlap_days: int = OVERLAP_DAYS, first_days: int = FIRST_DAYS) -> Window_:
    """From the watermark less the overlap, or from far enough back, or from a given start, to the end."""
    begin = start or (watermark - timedelta(days=overlap_days) if watermark else end - timedelta(days=first_days))
    if begin >= end:
        raise ValueError("the window is empty")
    return Window_(begin, end)


class RunLog:
    """Run states as an append-only Parquet log on shared storage: the last row of a run is its state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _rows(self) -> DataFrame:
        from millrace.sources.sinks import path_exists

        return self.spark.read.schema(LOG).parquet(self.path) if path_exists(self.spark, self.path) else self.spark.createDataFrame([], LOG)

    def states(self) -> DataFrame:
        last = Window.partitionBy("run_id", "source").orderBy(F.desc("seq"))
        return self._rows().withColumn("__k", F.row_number().over(last)).where("__k = 1").drop("__k")

    def get(self, run_id: str, source: str) -> dict | None:
        got = self.states().where((F.col("run_id") == run_id) & (F.col("source") == source)).first()
        return got.asDict() if got else None

    def _put(self, **row) -> dict:
        names = [c.split()[0] for c in LOG.split(", ")]
        self.spark.createDataFrame([tuple(row.get(n) for n in names)], LOG).coalesce(1).write.mode("append").parquet(self.path)
        return row

    def start(self, run_id: str, source: str, started: str, span: Window_, path: str) -> dict:
        """RUNNING; a run that succeeded is returned as it is, and a failed one may go on only with the same window."""
        before = self.get(run_id, source)
        start, end = span.start.isoformat(), span.end.isoformat()
        if before and before["status"] == "SUCCESS":
            return before
        if before and (before["window_start"], before["window_end"]) != (start, end):
            raise ValueError(f"run {run_id} began with another window")
        return self._put(run_id=run_id, source=source, seq=(before["seq"] + 1) if before else 0, status="RUNNING", started=started, window_start=start, window_end=end, path=path)

    def finish(self, run_id: str, source: str, rows: int, watermark: str | None) -> dict:
        before = self.get(run_id, source)
        return self._put(**before | {"seq": before["seq"] + 1, "status": "SUCCESS", "rows": rows, "watermark": watermark})

    def fail(self, run_id: str, source: str, error: str) -> dict:
        before = self.get(run_id, source)
        return self._put(**before | {"seq": before["seq"] + 1, "status": "FAILED", "error": error[:1000]})

    def watermark(self, source: str) -> str | None:
        """The greatest watermark of successful runs; it never goes back."""
        return self.states().where((F.col("source") == source) & (F.col("status") == "SUCCESS")).agg(F.max("watermark")).first()[0]

    def selected(self, source: str, prefixes: tuple[str, ...] = ("scheduled__", "manual__")) -> DataFrame:
        """Successful runs with rows whose id begins with one of the prefixes, in order."""
        named = F.lit(False)
        for p in prefixes:
            named = named | F.startswith(F.col("run_id"), F.lit(p))
        return self.states().where((F.col("source") == source) & (F.col("status") == "SUCCESS") & (F.col("rows") > 0) & named).orderBy("started", "run_id")

    def pending(self, source: str, done: list[str]) -> DataFrame:
        """Selected runs that a later layer hasn't taken yet."""
        taken = self.spark.createDataFrame([(r,) for r in done], "run_id string")
        return self.selected(source).join(taken, "run_id", "left_anti")
