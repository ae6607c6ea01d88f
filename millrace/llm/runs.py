"""Immutable sorted runs below a shared folder, by level, with a manifest from which a later job goes on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runs of a level that are compacted into one of the next.
FAN = 4


class Runs:
    """Paths of runs by level. Subclasses write runs and say how a level is merged."""

    def __init__(self, spark: SparkSession, path: str, levels: list[list[str]] | None = None, made: int = 0):
        self.spark, self.path, self.levels, self.made = spark, path, levels or [[]], made

    @classmethod
    def manifest(cls, spark: SparkSession, path: str) -> tuple[list[list[str]], int]:
        """Levels, and how many runs were ever made, of the index that an earlier job left at path."""
        listed = spark.read.parquet(f"{path}/manifest")
        last = listed.agg({"made": "max"}).first()[0]
        rows = listed.where(listed["made"] == last).orderBy("level", "place").collect()  # FAN runs a level
        return [[r["run"] for r in rows if r["level"] == k and r["run"]] for k in range(rows[-1]["level"] + 1)], last

    def save(self) -> None:
        rows = [(self.made, level, place, run) for level, runs in enumerate(self.levels) for place, run in enumerate(runs or [""])]
        self.spark.createDataFrame(rows, "made long, level int, place int, run string").coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def every(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def place(self, level: int) -> str:
        """Where a new run of a level goes. Its name is its own: what a job left that died before it saved the manifest is in nobody's way."""
        self.made += 1
        return f"{self.path}/level-{level}/run-{self.made}-{uuid.uuid4().hex[:8]}"

    def settle(self) -> None:
        """Compacts every level that is full into the next, and saves the manifest."""
        for level in range(len(self.levels) + 1):
            if level < len(self.levels) and len(self.levels[level]) >= FAN:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self.merge(self.levels[level], level + 1))
                self.levels[level] = []
        self.save()

    def merge(self, runs: list[str], level: int) -> str:
        raise NotImplementedError


def sorted_run(df: DataFrame, path: str, by: tuple[str, ...], ranged: bool) -> str:
    """Writes a run, each file sorted; if ranged, files hold ranges. The first of `by` has a Bloom filter, as large as its values ask for."""
    df = df.sort(*by) if ranged else df.sortWithinPartitions(*by)
    df.write.option(f"parquet.bloom.filter.enabled#{by[0]}", "true").option("parquet.bloom.filter.adaptive.enabled", "true").option("parquet.bloom.filter.max.bytes", str(1 << 20)).option("parquet.block.size", str(16 << 20)).parquet(path)
    return path
