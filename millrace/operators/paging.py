"""Pages of an order without a global sort in one task: seeking after the last row, and row numbers from ranges.

An order is a list of (column, whether it falls); nulls come last either way. It has to end with a key, so that no two
rows are equal in it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Order = Sequence[tuple[str, bool]]

#: The bits of monotonically_increasing_id() that count rows within a partition.
WITHIN = (1 << 33) - 1


def sorts(order: Order) -> list[Column]:
    return [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]


def comes_after(order: Order, last: Mapping) -> Column:
    """Whether a row comes after the one with these values."""
    ways = []
    for i, (c, down) in enumerate(order):
        same = [F.col(n).eqNullSafe(F.lit(last[n])) for n, _ in order[:i]]
        if last[c] is not None:  # nothing comes after null but a later column
            ways.append(reduce(and_, same, (F.col(c) < F.lit(last[c]) if down else F.col(c) > F.lit(last[c])) | F.col(c).isNull()))
    return reduce(or_, ways, F.lit(False))


def seek(df: DataFrame, order: Order, size: int, last: Mapping | None = None) -> DataFrame:
    """The next `size` rows after a row, given by the values of the order's columns; the first ones without it.

    Each task keeps `size` rows at most, however deep the page lies, and the comparison is pushed down to the scan."""
    rows = df if last is None else df.where(comes_after(order, last))
    return rows.orderBy(*sorts(order)).limit(size)


def number_rows(df: DataFrame, order: Order, path: str) -> None:
    """Writes df below path in ranges of an order, sorted inside each, with an index of how many rows precede each file's range.

    The rows are written once; numbers follow from a row's place in its range and the index, a row per file."""
    number_sorted(df, sorts(order), path)


def number_sorted(df: DataFrame, by: Sequence[Column], path: str) -> None:
    """As number_rows, by sort columns."""
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = ranged.withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id().bitwiseAND(F.lit(WITHIN))})
    placed.write.parquet(f"{path}/rows")
    spark = df.sparkSession
    files = spark.read.schema(placed.schema).parquet(f"{path}/rows").groupBy(F.col("_metadata.file_path").alias("file"), "__part").agg(F.count(F.lit(1)).alias("n"), F.min("__place").alias("__first"))
    before = Window.orderBy("__part", "__first").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/index")


INDEX = "file string, __part int, n long, __first long, before long"


def _numbered(rows: DataFrame, index: DataFrame) -> DataFrame:
    told = index.select(F.col("__part").alias("__of"), (F.col("before") - F.col("__first")).alias("__base"), "__first", (F.col("__first") + F.col("n")).alias("__end"))
    within = (F.col("__part") == F.col("__of")) & (F.col("__place") >= F.col("__first")) & (F.col("__place") < F.col("__end"))
    names = [c for c in rows.columns if c not in ("__part", "__place")]
    return rows.join(told, within).select(*names, (F.col("__base") + F.col("__place") + 1).alias("row_number"))


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """All rows that number_rows wrote, with row_number from 1 on in its order."""
    return _numbered(spark.read.parquet(f"{path}/rows"), spark.read.schema(INDEX).parquet(f"{path}/index"))


def page(spark: SparkSession, path: str, number: int, size: int) -> DataFrame:
    """Page `number`, from 1 on, of what number_rows wrote: only the files that hold it are read, and of those the row
    groups. A page beyond the last has no rows."""
    first = (number - 1) * size
    index = spark.read.schema(INDEX).parquet(f"{path}/index").where((F.col("before") < first + size) & (F.col("before") + F.col("n") > first))
    held = index.collect()  # files that share a page: `size` at most
    every = spark.read.parquet(f"{path}/rows")
    if not held:
        return every.limit(0).drop("__part", "__place").withColumn("row_number", F.lit(0).cast("long"))
    rows = spark.read.schema(every.schema).parquet(*(h["file"] for h in held))
    wanted = reduce(or_, ((F.col("__part") == h["__part"]) & F.col("__place").between(max(first - h["before"], 0) + h["__first"], first + size - 1 - h["before"] + h["__first"]) for h in held))
    return _numbered(rows.where(wanted), index)
