"""One row of each key: exact copies, newest versions, top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of each key in a total order. Spark cuts each partition to n rows before the shuffle."""
    name = rank or "__rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def drop_copies(df: DataFrame, columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each distinct combination of columns (nulls are equal), with record_id, a hash of them."""
    from millrace.functions.text import row_hash

    return top_per_key(df.withColumn("record_id", row_hash(*columns)), ["record_id"], order)


def newest_per_key(df: DataFrame, key: str, columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest row of each key; rows without a key are told apart by a hash of their columns."""
    from millrace.functions.text import row_hash

    own = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("MISSING:"), F.col("record_id")))
    return top_per_key(df.withColumn("record_id", row_hash(*columns)).withColumn("__own", own), ["__own"], order).drop("__own")
