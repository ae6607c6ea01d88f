"""A table behind limit and offset, as a stream of pages that can be taken up again.

    spark.dataSource.register(RestPages)
    spark.readStream.format("rest_pages").options(**request.options(folder)).load()

A partition is a run of pages: the task that reads it asks for one after the other with $limit, $offset, $order and
$where, checks them against the contract, and saves each once below a shared folder before its rows go on. Offsets of the
stream are numbers of pages, a batch takes `ahead` runs side by side, and a page that isn't full is the last. Runs are of
one page at first and grow with the pages before them, so there are few batches, and few lists of the folder, however many
pages there are. What a folder holds was asked by one request, which stands beside the pages and never changes. Whoever reads the folder again, a restarted stream, a retried
task or a run of another day, takes saved pages from it and asks for the others alone.
"""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from millrace.sources.pages import checked, text_schema
from millrace.sources.runs import RunLog, Window_

MANIFEST = "request.json"


@dataclass(frozen=True)
class Request:
    """What is asked, and in which order, so that pages neither overlap nor leave gaps: `order` has to end with a key.

    url: http(s), or a folder in which Spark wrote the rows of each page as text below offset=N. at, start and end: a
    half-open window on a column. required: columns that every record must have."""

    url: str
    columns: tuple[str, ...]
    order: str
    limit: int = 10_000
    ahead: int = 8
    at: str | None = None
    start: str | None = None
    end: str | None = None
    required: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.columns or not self.order or self.limit < 1 or self.ahead < 1:
            raise ValueError("a request has columns, an order, and a limit and pages ahead above 0")
        if (self.at is None) != (self.start is None) or (self.at is None) != (self.end is None) or (self.at and self.start >= self.end):
            raise ValueError("a window has a column, a start and a later end, or none of them")

    def where(self) -> str | None:
        quoted = lambda v: "'" + v.replace("'", "''") + "'"
        return f"{self.at} >= {quoted(self.start)} AND {self.at} < {quoted(self.end)}" if self.at else None

    def manifest(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    def options(self, folder: str) -> dict[str, str]:
        return {"folder": folder, "request": self.manifest()}

    @classmethod
    def parsed(cls, text: str) -> Request:
        given = json.loads(text)
        return cls(**given | {k: tuple(given[k]) for k in ("columns", "required")})


def _opened(uri: str) -> tuple[Any, str]:
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def fetched(request: Request, page: int) -> Any:
    """The answer to a request for one page, as it comes."""
    offset = page * request.limit
    if request.url.startswith(("http://", "https://")):
        asked = {"$limit": request.limit, "$offset": offset, "$order": request.order} | ({"$where": request.where()} if request.at else {})
        with urllib.request.urlopen(f"{request.url}?{urllib.parse.urlencode(asked)}", timeout=60) as answer:
            return json.loads(answer.read())
    from pyarrow import fs

    system, folder = _opened(request.url)
    if system.get_file_info(f"{folder}/offset={offset}").type == fs.FileType.NotFound:
        return []
    rows = []
    for f in sorted(x.path for x in system.get_file_info(fs.FileSelector(f"{folder}/offset={offset}")) if not x.base_name.startswith(("_", "."))):
        with system.open_input_file(f) as lines:
            rows += [json.loads(x) for x in lines.read().splitlines()]
    return rows


def put_once(system, path: str, data: bytes) -> bool:
    """Writes a file that isn't there yet, under another name first; whether it was written. One of other content is an error."""
    from pyarrow import fs

    if system.get_file_info(path).type != fs.FileType.NotFound:
        with system.open_input_file(path) as f:
            if f.read() != data:
                raise FileExistsError(f"{path} holds something else")
        return False
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    own = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as f:
        f.write(data)
    system.move(own, path)
    return True


class Landing:
    """Saved pages of a request below a folder; a page's name tells its offset and its number of records."""

    def __init__(self, folder: str, request: Request):
        self.folder, self.request = folder, request

    def agreed(self) -> None:
        """Saves the request, or raises if the folder's pages were asked by another."""
        system, folder = _opened(self.folder)
        try:
            put_once(system, f"{folder}/{MANIFEST}", self.request.manifest().encode())
        except FileExistsError:
            raise ValueError(f"{self.folder} holds pages of another request") from None

    def saved(self) -> dict[int, tuple[str, int]]:
        """Path and records of each saved page."""
        from pyarrow import fs

        system, folder = _opened(self.folder)
        found = {}
        for f in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            name, _, kind = f.base_name.rpartition(".")
            if kind == "json" and name.startswith("page_offset="):
                offset, _, rows = name.removeprefix("page_offset=").partition("-rows=")
                found[int(offset) // self.request.limit] = f.path, int(rows)
        return found

    def last(self, saved: dict[int, tuple[str, int]]) -> int | None:
        """The first page that isn't full, if it was met."""
        return min((page for page, (_, rows) in saved.items() if rows < self.request.limit), default=None)

    def run(self, pages: range) -> Iterator[tuple[int, list[dict]]]:
        """Pages with their records, until one isn't full. The folder is listed once; nothing is asked beyond the last page."""
        saved = self.saved()
        last = self.last(saved)
        for page in pages:
            records = self.records(page, saved, last)
            yield page, records
            if len(records) < self.request.limit:
                return

    def records(self, page: int, saved: dict[int, tuple[str, int]], last: int | None) -> list[dict]:
        """A page's records, from the folder, or asked, checked and saved there."""
        system, folder = _opened(self.folder)
        if page in saved:
            with system.open_input_file(saved[page][0]) as f:
                return json.loads(f.read())
        if last is not None and last < page:
            return []
        records = checked(fetched(self.request, page), self.request.required, self.request.limit)
        put_once(system, f"{folder}/page_offset={page * self.request.limit:012d}-rows={len(records)}.json", json.dumps(records, separators=(",", ":")).encode())
        return records


#: A batch takes one page for every GROWTH pages before it, and `ahead` at least.
GROWTH = 4


def batch_end(ahead: int, page: int) -> int:
    """The end of the batch that holds a page. It follows from `ahead` alone, so a stream that starts again meets the same ends."""
    end = 0
    while end <= page:
        end += ahead * max(1, end // (GROWTH * ahead))
    return end


class RestPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rest_pages"

    def schema(self) -> StructType:
        return text_schema([*Request.parsed(self.options["request"]).columns, "page"])

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Reader(self.options["folder"], self.options["request"])


class _Reader(DataSourceStreamReader):
    def __init__(self, folder: str, request: str):
        self.landing = Landing(folder, Request.parsed(request))

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        """Up to where pages are to be read: batch after batch, until one of them holds the last page."""
        self.landing.agreed()
        ahead, saved = self.landing.request.ahead, self.landing.saved()
        last = self.landing.last(saved)
        if last is not None:
            return {"page": batch_end(ahead, last)}
        full = 0
        while full in saved:
            full += 1
        return {"page": batch_end(ahead, full)}

    def partitions(self, start: dict, end: dict):
        first, beyond = start["page"], end["page"]
        length = max(1, -(-(beyond - first) // self.landing.request.ahead))
        return [InputPartition((p, min(p + length, beyond))) for p in range(first, beyond, length)]

    def read(self, partition):
        names = self.landing.request.columns
        for page, records in self.landing.run(range(*partition.value)):
            for r in records:
                yield (*(r.get(n) if r.get(n) is None or isinstance(r.get(n), str) else json.dumps(r[n]) for n in names), str(page))

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def stream_pages(spark: SparkSession, request: Request, folder: str, out: str) -> DataFrame:
    """Reads every page of a request through to Parquet below out, from wherever an earlier attempt stopped, and returns its rows.

    folder keeps pages and request, out the rows (text columns, and page) and the stream's checkpoint."""
    Landing(folder, request).agreed()
    spark.dataSource.register(RestPages)
    pages = spark.readStream.format("rest_pages").options(**request.options(folder)).load()
    query = pages.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(pages.schema).parquet(f"{out}/rows")


def ingest(spark: SparkSession, log: RunLog, run_id: str, source: str, started: str, request: Request, root: str) -> dict:
    """A run of the log over a request: its state, SUCCESS with rows and watermark, or the error, after FAILED is noted.

    A run that succeeded isn't repeated. One that failed goes on with the pages it had saved, and only with the same
    request. The watermark is the greatest value of the window's column; it is null without a window or rows."""
    from datetime import datetime

    span = Window_(*(datetime.fromisoformat(x) for x in (request.start, request.end))) if request.at else Window_(datetime.min, datetime.max)
    folder = f"{root}/source={source}/run_id={run_id}"
    state = log.start(run_id, source, started, span, folder)
    if state["status"] == "SUCCESS":
        return state
    try:
        rows = stream_pages(spark, request, f"{folder}/pages", f"{folder}/landed")
        n, mark = rows.agg(F.count(F.lit(1)), F.max(request.at) if request.at else F.lit(None).cast("string")).first()
    except Exception as e:
        log.fail(run_id, source, str(e))
        raise
    return log.finish(run_id, source, n, mark)


def write_as_pages(df: DataFrame, order: list[str], limit: int, path: str) -> None:
    """Lays a table out as a Request's url folder: the rows of each page as lines of JSON below offset=N, pages by `order`.

    Rows are numbered from ranges (see operators.paging); a page is written by one task."""
    from millrace.operators.paging import number_rows, numbered

    number_rows(df, [(c, False) for c in order], f"{path}/_numbered")
    rows = numbered(df.sparkSession, f"{path}/_numbered")
    offset = (F.floor((F.col("row_number") - 1) / limit) * limit).cast("long")
    lines = rows.select(offset.alias("offset"), "row_number", F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    lines.repartition("offset").sortWithinPartitions("offset", "row_number").select("value", "offset").write.partitionBy("offset").mode("append").text(path)
