"""What differs between two tables of one shape, row by row and column by column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import row_hash


def row_difference(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, change ('added', 'removed' or 'changed') and columns (the names of those that differ, sorted) of every row that isn't the same.

    Nulls are values: null equals null and differs from all else, in keys, too. Rows that repeat a key are compared in
    the order of their content. Tables of other columns are an error."""
    if sorted(before.dtypes) != sorted(after.dtypes):
        raise ValueError(f"the tables have other columns: {sorted(set(before.dtypes) ^ set(after.dtypes))}")
    others = sorted(set(before.columns) - set(keys))

    def side(df: DataFrame, name: str) -> DataFrame:
        placed = df.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(row_hash(*others) if others else F.lit(1))))
        return placed.select(*keys, "__place", F.struct(F.lit(True).alias("__there"), *others).alias(name))

    a, b = side(before, "__a"), side(after, "__b")
    both = a.withColumn("__b", F.lit(None).cast(b.schema["__b"].dataType)).unionByName(b.withColumn("__a", F.lit(None).cast(a.schema["__a"].dataType)))
    # grouping, unlike joining, takes nulls in keys for equal, and combines before its shuffle
    met = both.groupBy(*keys, "__place").agg(F.first("__a", ignorenulls=True).alias("__a"), F.first("__b", ignorenulls=True).alias("__b"))
    differ = F.array_compact(F.array(*(F.when(~F.col("__a")[c].eqNullSafe(F.col("__b")[c]), F.lit(c)) for c in others))) if others else F.array().cast("array<string>")
    change = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(F.size(differ) > 0, "changed")
    told = met.select(*keys, change.alias("change"), F.when(change == "changed", differ).otherwise(F.array().cast("array<string>")).alias("columns"))
    return told.where("change is not null")


def suppressed(kept: DataFrame, source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows of `kept` whose value in one of the columns isn't that of their source: key, column, kept, source. Values that are null on either side don't count."""
    theirs = source.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in columns))
    joined = kept.join(theirs, F.col(key) == F.col("__key"))
    each = F.explode(F.array(*(F.when(F.col(c) != F.col(f"__{c}"), F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("kept"), F.col(f"__{c}").cast("string").alias("source"))) for c in columns))).alias("d")
    return joined.select(key, each).where("d is not null").select(key, "d.*")
