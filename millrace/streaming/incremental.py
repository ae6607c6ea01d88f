"""Layers that follow their input: late and corrected rows find the parts they touch, and only these are made anew.

A table lies in parts, numbers that follow from a column that every row has, weeks as a rule. A version holds the parts
that it made anew and a list of them; a part is read from its greatest listed version. The list is written last, so a
version that broke off isn't seen, and running it again writes the same again. Parts that became empty are listed and
hold no rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import row_hash
from millrace.operators.rows import top_per_key
from millrace.sources.runs import RunLog
from millrace.sources.sinks import path_exists

LISTED = "part int, run string"


def week_part(day: Column) -> Column:
    """The number of a day's week, Monday to Sunday, from that of 5 January 1970 on."""
    return F.floor(F.datediff(day, F.lit("1970-01-05").cast("date")) / 7).cast("int")


class Parts:
    """A table in parts below a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _listed(self) -> DataFrame | None:
        if not path_exists(self.spark, f"{self.path}/listed"):
            return None
        return self.spark.read.schema(f"{LISTED}, version int").parquet(f"{self.path}/listed")

    def versions(self, below: int | None = None) -> dict[int, int]:
        """The version from which each part is read; a few numbers for each part."""
        listed = self._listed()
        if listed is None:
            return {}
        listed = listed.where("part is not null")
        rows = listed if below is None else listed.where(F.col("version") < below)
        return {r["part"]: r["v"] for r in rows.groupBy("part").agg(F.max("version").alias("v")).collect()}

    def runs(self) -> list[str]:
        """Names of the runs whose rows the table holds."""
        listed = self._listed()
        return [] if listed is None else sorted(r[0] for r in listed.select("run").distinct().collect() if r[0])

    def next(self) -> int:
        listed = self._listed()
        last = None if listed is None else listed.agg(F.max("version")).first()[0]
        return 0 if last is None else last + 1

    def read(self, parts: Sequence[int] | None = None, below: int | None = None) -> DataFrame | None:
        """Rows of the parts, of all of them without a list, with `part`; None where nothing was ever written there."""
        found = {p: v for p, v in self.versions(below).items() if parts is None or p in set(parts)}
        folders = [f"{self.path}/version={v}/part={p}" for p, v in sorted(found.items())]
        there = [f for f in folders if path_exists(self.spark, f)]
        return self.spark.read.option("basePath", self.path).parquet(*there).drop("version") if there else None

    def write(self, rows: DataFrame, version: int, touched: Sequence[int], run: str | None = None) -> None:
        """Makes the touched parts anew from rows (with `part`), and lists them. A large part is written by several tasks."""
        if touched:
            rows.where(F.col("part").isin(list(touched))).hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/version={version}")
        listed = self.spark.createDataFrame([(p, run) for p in touched] or [(None, run)], LISTED)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/listed/version={version}")


class Layers:
    """Newest rows of each key, and a table aggregated from them part by part.

    key: names a row. order: columns that tell which of two rows of a key is newer; rows that are equal in it are told
    apart by their content. part: the part of a row. gold: from rows with `part` to aggregates with `part`, each of
    which depends on the rows of its own part alone."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: Sequence[str], part: Column, gold: Callable[[DataFrame], DataFrame]):
        self.spark, self.key, self.order, self.part, self.make = spark, key, list(order), part, gold
        self.silver, self.gold, self.path = Parts(spark, f"{path}/silver"), Parts(spark, f"{path}/gold"), path

    def _newest(self, rows: DataFrame) -> DataFrame:
        return top_per_key(rows, [self.key], [F.desc_nulls_last(c) for c in self.order] + [F.desc("__hash")])

    def take(self, batch: DataFrame, version: int | None = None, run: str | None = None) -> list[int]:
        """Takes a batch, which may repeat rows, correct them or bring older states; the parts that were made anew.

        Rows that change nothing touch nothing. A key that moves touches the part it leaves and the one it goes to."""
        version = self.gold.next() if version is None else version
        columns = batch.columns
        fresh = self._newest(batch.withColumns({"part": self.part, "__hash": row_hash(*columns)}))
        before = self.silver.read(below=version)
        work = f"{self.path}/work/version={version}"
        if before is None:
            changed = fresh.withColumn("__left", F.lit(None).cast("int"))
        else:
            held = before.select(self.key, *self.order, "__hash", "part").join(fresh.select(self.key), self.key, "left_semi")
            old = held.select(F.col(self.key).alias("__key"), F.col("part").alias("__left"), F.col("__hash").alias("__was"), *(F.col(c).alias(f"__was_{c}") for c in self.order))
            newer = F.col("__key").isNull()
            same = F.lit(True)
            for c in self.order:
                a, b = F.col(c), F.col(f"__was_{c}")
                newer |= same & F.coalesce(a > b, a.isNotNull() & b.isNull())
                same &= a.eqNullSafe(b)
            newer |= same & (F.col("__hash") > F.col("__was"))
            changed = fresh.join(old, F.col(self.key) == F.col("__key"), "left").where(newer).select(*columns, "part", "__hash", "__left")
        changed.write.mode("overwrite").parquet(work)
        changed = self.spark.read.schema(changed.schema).parquet(work)
        touched = sorted(r[0] for r in changed.select(F.explode(F.array("part", "__left")).alias("p")).where("p is not null").distinct().collect())  # numbers of parts
        kept, new = self.silver.read(touched, below=version), changed.drop("__left")
        if kept is not None:
            new = kept.join(changed.select(self.key), self.key, "left_anti").select(*new.columns).unionByName(new)
        self.silver.write(new, version, touched, run)
        now = self.silver.read(touched, below=version + 1)
        self.gold.write(self.make(now if now is not None else changed.drop("__left").limit(0)), version, touched, run)
        return touched

    def catch_up(self, log: RunLog, source: str, read: Callable[[str], DataFrame]) -> dict[str, list[int]]:
        """Takes the runs of the log that succeeded and aren't held yet, in order; the parts that each made anew.

        read: rows of a run, from its path. A run that takes up the overlap of its predecessor repeats rows, which changes nothing."""
        return {r["run_id"]: self.take(read(r["path"]), run=r["run_id"]) for r in log.pending(source, self.gold.runs()).orderBy("started", "run_id").collect()}
