"""Writers that never overwrite, verify what they wrote, and export snapshots."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_verified(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Writes Parquet to a new path, reads it back and compares row counts; the rows are counted while they are written."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    there = df.sparkSession.read.parquet(path).count()
    if there != seen.get["n"]:
        raise RuntimeError(f"{path} has {there} rows of {seen.get['n']}")
    return there


def write_report(spark: SparkSession, path: str, report: dict) -> bool:
    """Puts a small JSON report if there is none; whether it was written. A different one at the path is an error."""
    text = json.dumps(report, sort_keys=True)
    if path_exists(spark, path):
        if read_report(spark, path) != json.loads(text):
            raise FileExistsError(f"{path} holds another report")
        return False
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return True


def read_report(spark: SparkSession, path: str) -> dict | None:
    return json.loads("".join(r[0] for r in spark.read.text(path).collect())) if path_exists(spark, path) else None


def prepared_output(spark: SparkSession, outputs: list[str], report: str, root: str | None = None) -> dict | None:
    """The report of a finished run, to be reused; None if the run may start. Outputs without a report of success are an
    error, or, on a retry, which names the root below which all outputs stand, they are removed."""
    done = read_report(spark, report)
    if done and done.get("status") == "SUCCESS":
        return done
    left = [p for p in outputs if path_exists(spark, p)]
    if left and root is None:
        raise FileExistsError(f"outputs of an unfinished run: {left}")
    for p in left:
        remove_output(spark, p, root)
    return None


def _parts(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    uri = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri()
    return f"{uri.getScheme() or 'file'}://{uri.getAuthority() or ''}", [p for p in uri.getPath().split("/") if p]


def remove_output(spark: SparkSession, path: str, root: str) -> bool:
    """Removes exactly the folder of one run's output; whether it was there. Neighbours whose names begin alike stay.

    The folder has to lie two levels or more below the root, by whole names, and to be named without wildcards or '..'."""
    (system, above), (own, names) = _parts(spark, root), _parts(spark, path)
    if not above or own != system or names[: len(above)] != above or len(names) < len(above) + 2:
        raise ValueError(f"{path} isn't an output below {root}")
    if re.search(r"[*?\[\]{}]", path) or {".", ".."} & set(path.split("/")):
        raise ValueError(f"{path} isn't one exact folder")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_once(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> bool:
    """Writes Parquet so that the path holds all of it or nothing: under another name first, which is then changed.

    Whether it was written: a finished output stays as it is. One that an earlier writer left without _SUCCESS is replaced."""
    spark = df.sparkSession
    if path_exists(spark, f"{path}/_SUCCESS"):
        return False
    jvm = spark.sparkContext._jvm
    target, own = (jvm.org.apache.hadoop.fs.Path(x) for x in (path, f"{path.rstrip('/')}__{uuid.uuid4().hex}"))
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(own.toString())
    if system.exists(target):
        system.delete(target, True)
    system.mkdirs(target.getParent())
    if not system.rename(own, target):
        raise RuntimeError(f"{path} can't be put in place")
    return True


def write_gated(df: DataFrame, path: str, upstream: dict, name: str = "rows", partition_by: tuple[str, ...] = ()) -> int:
    """write_verified for a job that depends on another: the other's report has to tell of success, and to count as many
    rows under `name` as df, which are counted while they are written. A wrong count leaves no output at the path."""
    if upstream.get("status") != "SUCCESS":
        raise ValueError(f"the job before reports {upstream.get('status')}")
    if not isinstance(upstream.get(name), int):
        raise ValueError(f"the report before doesn't count {name}")
    spark = df.sparkSession
    own = f"{path.rstrip('/')}__{uuid.uuid4().hex}"
    n = write_verified(df, own, partition_by)
    jvm = spark.sparkContext._jvm
    target, made = (jvm.org.apache.hadoop.fs.Path(x) for x in (path, own))
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if n != upstream[name]:
        system.delete(made, True)
        raise ValueError(f"the report before counts {upstream[name]} {name}; there are {n}")
    if system.exists(target) or not system.rename(made, target):
        system.delete(made, True)
        raise FileExistsError(f"{path} is there already")
    return n


def export_chunks(df: DataFrame, path: str, key: str) -> None:
    """Compact JSON in one folder per first hex digit of a key; rows without such a key go to `other`."""
    first = F.lower(F.substring(F.col(key), 1, 1))
    df.withColumn("chunk", F.when(first.rlike("^[0-9a-f]$"), first).otherwise("other")).repartition("chunk").write.mode("errorifexists").partitionBy("chunk").json(path)


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """An external table over a folder of Parquet files, with its partitions."""
    if not re.fullmatch(r"[a-z_][a-z0-9_]*(\.[a-z_][a-z0-9_]*)?", name):
        raise ValueError(f"not a table name: {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def smoke(spark: SparkSession, path: str) -> bool:
    """Two rows written and read back."""
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    df.write.mode("errorifexists").parquet(path)
    return sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b")]
