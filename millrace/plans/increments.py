"""Tables that arrive page by page or batch by batch, and pages of their orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import paging
from millrace.plans.roles import complaints, inspections, query, restaurants, table
from millrace.plans.streams import folder
from millrace.sources import rest
from millrace.streaming.incremental import Layers, week_part

#: Records of a page.
PAGE = 500


@query("", "SELECT event_id, user_id, event_type, value FROM events")
def paged_events(spark: SparkSession, d: str) -> DataFrame:
    """The events, laid out in pages and read back through the paged source, page by page until one isn't full."""
    served, work = folder(spark, "served"), folder(spark, "paged")
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    rest.write_as_pages(rows, ["event_id"], PAGE, served)
    request = rest.Request(served, tuple(rows.columns), "event_id", PAGE, ahead=8, required=("event_id",))
    landed = rest.stream_pages(spark, request, f"{work}/pages", work)
    return landed.select(*(F.col(c).cast(t).alias(c) for c, t in rows.dtypes))


ORDER = (("inspected", True), ("inspection_id", False))
NUMBERED_SQL = "n AS (SELECT inspection_id, restaurant_key, inspected, grade, row_number() OVER (ORDER BY inspected DESC NULLS LAST, inspection_id) AS row_number FROM inspections)"


def _numbers(spark: SparkSession, d: str) -> str:
    path = folder(spark, "numbered")
    paging.number_rows(inspections(spark, d).select("inspection_id", "restaurant_key", "inspected", "grade"), ORDER, path)
    return path


@query("inspections", NUMBERED_SQL + " SELECT * FROM n")
def numbered_inspections(spark: SparkSession, d: str) -> DataFrame:
    """Every inspection with its place among all, newest first; ranges are sorted side by side."""
    return paging.numbered(spark, _numbers(spark, d))


@query("inspections", NUMBERED_SQL + " SELECT * FROM n WHERE row_number BETWEEN 951 AND 1000")
def inspections_page_20(spark: SparkSession, d: str) -> DataFrame:
    """Page 20 of fifty rows, from the files that hold it alone."""
    return paging.page(spark, _numbers(spark, d), 20, 50)


@query("inspections", "SELECT inspection_id, restaurant_key, inspected, grade FROM inspections WHERE inspected < DATE '1998-06-01' OR (inspected = DATE '1998-06-01' AND inspection_id > 100) ORDER BY inspected DESC, inspection_id LIMIT 50")
def inspections_after(spark: SparkSession, d: str) -> DataFrame:
    """The fifty inspections that follow a row."""
    import datetime

    rows = inspections(spark, d).select("inspection_id", "restaurant_key", "inspected", "grade")
    return paging.seek(rows, ORDER, 50, {"inspected": datetime.date(1998, 6, 1), "inspection_id": 100})


def changes(spark: SparkSession, d: str) -> DataFrame:
    """Every state of every complaint as its source would report it: open when it was made, closed later, with `updated`, the time of the report."""
    rows = complaints(spark, d).withColumns({"created": F.col("created").cast("timestamp"), "closed": F.col("closed").cast("timestamp")}).join(restaurants(spark, d).select("restaurant_key", "area_key"), "restaurant_key", "left")
    names = ("complaint_id", "restaurant_key", "area_key", "kind", "created", "closed", "updated")
    opened = rows.withColumns({"closed": F.lit(None).cast("timestamp"), "updated": F.col("created")})
    shut = rows.where("closed IS NOT NULL").withColumn("updated", F.col("closed"))
    return opened.select(*names).unionByName(shut.select(*names))


def week_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("part", "area_key").agg(F.count(F.lit(1)).alias("complaint_count"), F.count("closed").alias("closed_count"), F.max("updated").alias("last_update"))


def week_layers(spark: SparkSession, path: str) -> Layers:
    return Layers(spark, path, "complaint_id", ["updated", "closed"], week_part(F.to_date("created")), week_totals)


def batches(rows: DataFrame, cuts: list[str], overlap_days: int = 2) -> list[Column]:
    """Half-open windows on `updated` between cuts, each with the overlap in which the source is asked again."""
    edges = [None, *cuts, None]
    inside = []
    for start, end in zip(edges, edges[1:], strict=False):
        after = F.lit(True) if start is None else F.col("updated") >= F.timestamp_add("DAY", F.lit(-overlap_days), F.lit(start).cast("timestamp"))
        inside.append(after & (F.lit(True) if end is None else F.col("updated") < F.lit(end).cast("timestamp")))
    return inside


@query("complaints restaurants", "SELECT CAST(floor(date_diff('day', DATE '1970-01-05', CAST(created AS DATE)) / 7) AS INTEGER) AS part, area_key, count(*) AS complaint_count, count(closed) AS closed_count, CAST(max(coalesce(closed, created)) AS TIMESTAMP) AS last_update FROM complaints LEFT JOIN restaurants USING (restaurant_key) GROUP BY ALL")
def incremental_weeks(spark: SparkSession, d: str) -> DataFrame:
    """Complaints by week and area after three batches of reports, the later ones of which close complaints of weeks before."""
    rows = changes(spark, d)
    layers = week_layers(spark, folder(spark, "weeks"))
    for inside in batches(rows, ["2024-01-11", "2024-01-21"]):
        layers.take(rows.where(inside))
    found = layers.gold.read()
    empty = week_totals(rows.withColumn("part", F.lit(0)).limit(0))
    return (empty if found is None else found.select(*empty.columns)).withColumn("last_update", F.col("last_update").cast("timestamp_ntz"))
