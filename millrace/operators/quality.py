"""Checks: each is a one-row DataFrame of check_name, failing (long), so that many run as one job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame, name: str, failing: Column) -> DataFrame:
    return df.agg(F.coalesce(failing, F.lit(0)).cast("long").alias("failing")).select(F.lit(name).alias("check_name"), "failing")


def not_null(df: DataFrame, column: str, name: str) -> DataFrame:
    return _row(df, name, F.count_if(F.col(column).isNull()))


def unique(df: DataFrame, column: str, name: str) -> DataFrame:
    return _row(df.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1"), name, F.count(F.lit(1)))


def accepted(df: DataFrame, column: str, values: list, name: str) -> DataFrame:
    return _row(df, name, F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*values)))


def related(child: DataFrame, column: str, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Children without a parent; a null key has none to find."""
    orphans = child.where(F.col(column).isNotNull()).select(F.col(column).alias("__k")).join(parent.select(F.col(key).alias("__k")), "__k", "left_anti")
    return _row(orphans, name, F.count(F.lit(1)))


def holds(df: DataFrame, rule: Column, name: str) -> DataFrame:
    """Rows for which a rule isn't true."""
    return _row(df, name, F.count_if(~F.coalesce(rule, F.lit(False))))


def same_count(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    counts = a.agg(F.count(F.lit(1)).alias("a")).crossJoin(b.agg(F.count(F.lit(1)).alias("b")))
    return counts.select(F.lit(name).alias("check_name"), F.abs(F.col("a") - F.col("b")).alias("failing"))


def report(*checks: DataFrame) -> DataFrame:
    """check_name, failing, passed."""
    return reduce(DataFrame.unionByName, checks).withColumn("passed", F.col("failing") == 0)


def counted(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """check_name, expected, actual, passed: of pairs of tables of one row, n."""
    rows = []
    for name, (expected, actual) in pairs.items():
        both = expected.select(F.col("n").alias("expected")).crossJoin(actual.select(F.col("n").alias("actual")))
        rows.append(both.select(F.lit(name).alias("check_name"), "expected", "actual", F.col("expected").eqNullSafe(F.col("actual")).alias("passed")))
    return reduce(DataFrame.unionByName, rows)
