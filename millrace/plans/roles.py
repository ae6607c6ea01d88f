"""The driver's tables in the roles of the data model, in Spark and as SQL.

area: region. restaurant: customer, without an area where the key is a multiple of 50. inspection: orders
(F, O, P are grades A, B, C). finding: lineitem. complaint: events. Coordinates are a fixed function of
the key, as the tables have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOTAL = -1
GRADES = ("A", "B", "C")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latitude(k: Column, s: int) -> Column:
    return F.lit(40.65) + ((k * k * 31 + k * 7919 + s) % 100003) / F.lit(1000030.0)


def longitude(k: Column, s: int) -> Column:
    return F.lit(-74.05) + ((k * k * 17 + k * 104729 + 7 * s) % 100019) / F.lit(1000190.0)


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("area_key"), F.col("r_name").alias("area_name"))


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    joined = table(spark, sf_dir, "customer").join(nation, "c_nationkey", "left")
    return joined.select(
        k.alias("restaurant_key"), F.col("c_name").alias("restaurant_name"), F.col("c_mktsegment").alias("cuisine"), F.when(k % 50 != 0, F.col("n_regionkey")).alias("area_key"),
        latitude(k, 1).alias("lat"), longitude(k, 1).alias("lon"),
    )


def inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    grade = F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "B").when(F.col("o_orderstatus") == "P", "C")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("inspection_id"), F.col("o_custkey").alias("restaurant_key"), F.col("o_orderdate").cast("date").alias("inspected"), F.col("o_totalprice").alias("score"), grade.alias("grade"), F.col("o_orderpriority").alias("action")
    )


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("inspection_id"), F.col("l_linenumber").alias("line"), F.concat("l_returnflag", "l_linestatus").alias("code"), (F.col("l_returnflag") == "R").alias("critical"), F.col("l_shipdate").cast("date").alias("found"), F.col("l_quantity").alias("weight")
    )


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    closed = F.when(k % 7 != 0, F.timestamp_add("DAY", (k % 10).cast("int"), F.col("ts")))
    return table(spark, sf_dir, "events").select(
        k.alias("complaint_id"), F.col("user_id").alias("restaurant_key"), F.col("ts").alias("created"), closed.alias("closed"), F.col("event_type").alias("kind"), "value", latitude(k, 50021).alias("lat"), longitude(k, 50021).alias("lon")
    )


SQL = {
    "areas": "areas AS (SELECT r_regionkey AS area_key, r_name AS area_name FROM region)",
    "restaurants": """restaurants AS (
        SELECT c_custkey AS restaurant_key, c_name AS restaurant_name, c_mktsegment AS cuisine, CASE WHEN c_custkey % 50 <> 0 THEN n_regionkey END AS area_key,
               40.65::DOUBLE + ((c_custkey * c_custkey * 31 + c_custkey * 7919 + 1) % 100003) / 1000030.0::DOUBLE AS lat,
               -74.05::DOUBLE + ((c_custkey * c_custkey * 17 + c_custkey * 104729 + 7) % 100019) / 1000190.0::DOUBLE AS lon
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)""",
    "inspections": """inspections AS (
        SELECT o_orderkey AS inspection_id, o_custkey AS restaurant_key, CAST(o_orderdate AS DATE) AS inspected, o_totalprice AS score,
               CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'B' WHEN 'P' THEN 'C' END AS grade, o_orderpriority AS action FROM orders)""",
    "findings": """findings AS (
        SELECT l_orderkey AS inspection_id, l_linenumber AS line, l_returnflag || l_linestatus AS code, l_returnflag = 'R' AS critical, CAST(l_shipdate AS DATE) AS found, l_quantity AS weight FROM lineitem)""",
    "complaints": """complaints AS (
        SELECT event_id AS complaint_id, user_id AS restaurant_key, ts AS created, CASE WHEN event_id % 7 <> 0 THEN ts + to_days(CAST(event_id % 10 AS INTEGER)) END AS closed, event_type AS kind, value,
               40.65::DOUBLE + ((event_id * event_id * 31 + event_id * 7919 + 50021) % 100003) / 1000030.0::DOUBLE AS lat,
               -74.05::DOUBLE + ((event_id * event_id * 17 + event_id * 104729 + 350147) % 100019) / 1000190.0::DOUBLE AS lon
        FROM events)""",
}


def oracle(roles: str, body: str) -> str:
    """SQL of the roles named (separated by blanks) before a body, which begins with SELECT or with further named queries."""
    parts = ", ".join(SQL[r] for r in roles.split())
    body = body.strip()
    if not parts:
        return body if body.startswith("SELECT") else f"WITH {body}"
    return f"WITH {parts}{' ' if body.startswith('SELECT') else ', '}{body}"


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(roles: str = "", sql: str | None = None):
    """Registers a query (spark, sf_dir) -> DataFrame under its function's name, with the SQL that gives the same rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = oracle(roles, sql)
        return f

    return register
