"""Landed JSON pages, reviewed CSV lists, and a paged source as a Spark data source."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType


def text_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def read_pages(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """Files of JSON arrays by an explicit schema, with source_file and run_id, which is taken from the path. Only page files are read, no manifests beside them."""
    return with_origin(spark.read.schema(schema).option("multiLine", "true").option("pathGlobFilter", "page_offset=*.json").option("recursiveFileLookup", "true").json(paths))


def with_origin(df: DataFrame) -> DataFrame:
    """df, read from files, with source_file and run_id where it lacks them: the file of a row, and the run that its path names ('' for none). What is there stays."""
    named = df if "source_file" in df.columns else df.withColumn("source_file", F.col("_metadata.file_path"))
    return named if "run_id" in df.columns else named.withColumn("run_id", F.regexp_extract("source_file", "run_id=([^/]+)", 1))


def read_list(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A CSV with a header, all text; raises if a column is missing."""
    df = spark.read.csv(path, header=True, inferSchema=False)
    if missing := set(columns) - set(df.columns):
        raise ValueError(f"{path} lacks the columns {sorted(missing)}")
    return df.select(*columns)


class PagedSource(DataSource):
    """A table in pages of JSON arrays, read page by page until one is short: `spark.read.format("pages")`.

    Options: path (a folder of files page-N.json, on storage that executors reach), page_size, start and end (half-open window on
    the column `at`), at. Each page is a partition, so a lost task reads its page again and nothing else."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> StructType:
        return text_schema(self.options["columns"].split(","))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PageReader(dict(self.options), schema.names)


class _Page(InputPartition):
    pass


class _PageReader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.options, self.names = options, names

    def _fs(self):
        from pyarrow import fs

        path = self.options["path"]
        return fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")

    def partitions(self):
        from pyarrow import fs

        system, folder = self._fs()
        files = [f.path for f in system.get_file_info(fs.FileSelector(folder)) if f.base_name.startswith("page-") and f.base_name.endswith(".json")]
        return [_Page(p) for p in sorted(files)] or [_Page(None)]

    def read(self, partition):
        if partition.value is None:
            return
        system, _ = self._fs()
        with system.open_input_file(partition.value) as f:
            rows = checked(json.loads(f.read()), self.options.get("required", "").split(",") if self.options.get("required") else [], int(self.options.get("page_size", 10_000)))
        at, start, end = self.options.get("at"), self.options.get("start"), self.options.get("end")
        for r in rows:
            if at is None or ((start is None or r.get(at, "") >= start) and (end is None or r.get(at, "") < end)):
                yield tuple(r.get(n) if r.get(n) is None or isinstance(r.get(n), str) else json.dumps(r[n]) for n in self.names)


def checked(records, required: Sequence[str], page_size: int) -> list[dict]:
    """A page as the contract asks: a list, no longer than a page, of objects that have the required keys."""
    if not isinstance(records, list):
        raise ValueError("a page isn't a list")
    if len(records) > page_size:
        raise ValueError(f"a page has {len(records)} records; {page_size} at most")
    for i, r in enumerate(records):
        if not isinstance(r, dict) or (missing := [k for k in required if r.get(k) in (None, "")]):
            raise ValueError(f"record {i} lacks {missing if isinstance(r, dict) else 'its keys'}")
    return records
