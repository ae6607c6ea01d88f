"""Streams: windows with late data, newest versions, exact copies, sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def window_counts(events: DataFrame, time: str, key: str, length: str = "1 day", slide: str | None = None, late: str = "2 days") -> DataFrame:
    """Rows and sums by window and key; state goes once the watermark has passed a window."""
    w = F.window(time, length, slide) if slide else F.window(time, length)
    out = events.withWatermark(time, late).groupBy(w, key).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "n", "total")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    out = events.withWatermark(time, late).groupBy(F.session_window(time, gap), key).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), key, "n")


def without_copies(events: DataFrame, time: str, columns: list[str], late: str = "2 days") -> DataFrame:
    """One row of each combination within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(columns)


def newest_into(spark: SparkSession, path: str, key: str, order: list[str], buckets: int = 16) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: merges a batch into the newest row of each key below `path`.

    Keys are dealt into buckets by hash. A batch writes the buckets it touches as version N, each from its greatest version
    below N, and is idempotent: a batch that runs again writes the same again. Readers take each bucket's greatest version
    (see newest_rows)."""
    from millrace.operators.rows import top_per_key

    def merge(batch: DataFrame, number: int) -> None:
        dealt = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        touched = [r["bucket"] for r in dealt.select("bucket").distinct().collect()]  # `buckets` at most
        before = newest_rows(batch.sparkSession, path, number, touched)
        both = dealt if before is None else dealt.unionByName(before.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")))
        best = top_per_key(both, [key], [F.desc_nulls_last(c) for c in order])
        best.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={number:09d}")

    return merge


def newest_rows(spark: SparkSession, path: str, below: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
    """The rows of each bucket's greatest version, below a number if one is given; None where there are none."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path_of(path)):
        return None
    children = lambda p: [f.getPath().getName() for f in system.listStatus(path_of(p))]
    newest: dict[int, str] = {}
    for version in sorted(n for n in children(path) if n.startswith("version=") and system.exists(path_of(f"{path}/{n}/_SUCCESS"))):
        if below is None or int(version.split("=")[1]) < below:
            newest |= {int(b.split("=")[1]): f"{path}/{version}/{b}" for b in children(f"{path}/{version}") if b.startswith("bucket=")}
    wanted = [p for b, p in sorted(newest.items()) if buckets is None or b in buckets]
    return spark.read.parquet(*wanted) if wanted else None


def into(path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch in complete mode: each batch writes the whole result as a version of its own; latest(path) reads the last."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("bucket", F.lit(0)).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={number:09d}")

    return write


def run_available(stream: DataFrame, checkpoint: str, name: str | None = None, each: Callable | None = None, mode: str = "append", path: str | None = None) -> StreamingQuery:
    """Runs a stream over all that is there, then stops; restarts go on from the checkpoint. Rows go to `each`, or as Parquet
    to a path, or, for small results alone, to a table of that name in the driver's memory."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode(mode)
    if each:
        writer = writer.foreachBatch(each)
    else:
        writer = writer.format("parquet").option("path", path) if path else writer.format("memory").queryName(name)
    q = writer.start()
    q.awaitTermination()
    return q
