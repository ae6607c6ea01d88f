"""Look-ups by key, paged lists, review queues and further profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import percent
from millrace.operators import metrics, names
from millrace.operators.rows import top_per_key
from millrace.plans.learning import SCORED_SQL, labelled, scored_labels
from millrace.plans.models import DAILY_SQL, HISTORY_SQL, LATEST_SQL, PLACES_SQL, SCORES_SQL, WEEKLY_SQL, history, latest_graded, named_places, rate_scores, weekly
from millrace.plans.roles import TOTAL, areas, findings, inspections, query, restaurants, table

KEY = 7


@query("areas restaurants inspections findings", HISTORY_SQL + f""", r AS (SELECT count(*) AS repeated FROM (SELECT code FROM findings JOIN inspections USING (inspection_id) WHERE critical AND restaurant_key = {KEY} GROUP BY code HAVING count(DISTINCT inspection_id) >= 2))
SELECT restaurant_key, restaurant_name, cuisine, area_name, grade, score, inspected, previous_grade, repeated FROM restaurants LEFT JOIN areas USING (area_key) LEFT JOIN (SELECT * FROM history WHERE recency = 1) USING (restaurant_key), r WHERE restaurant_key = {KEY}""")
def restaurant_detail(spark: SparkSession, d: str) -> DataFrame:
    """One restaurant with its latest grade (rank 1 stands in the join, not behind it) and its repeated critical findings."""
    one = restaurants(spark, d).where(F.col("restaurant_key") == KEY)
    last = history(spark, d).where((F.col("restaurant_key") == KEY) & (F.col("recency") == 1)).select("restaurant_key", "grade", "score", "inspected", "previous_grade")
    own = inspections(spark, d).where(F.col("restaurant_key") == KEY).select("inspection_id")
    again = findings(spark, d).where("critical").join(own, "inspection_id").groupBy("code").agg(F.count_distinct("inspection_id").alias("n")).where("n >= 2").agg(F.count(F.lit(1)).alias("repeated"))
    return one.join(F.broadcast(areas(spark, d)), "area_key", "left").join(last, "restaurant_key", "left").crossJoin(again).select("restaurant_key", "restaurant_name", "cuisine", "area_name", "grade", "score", "inspected", "previous_grade", "repeated")


@query("inspections findings", f"SELECT inspection_id, line, code, critical, found, inspected FROM findings JOIN inspections USING (inspection_id) WHERE restaurant_key = {KEY} ORDER BY inspected DESC, inspection_id DESC, line LIMIT 100")
def restaurant_findings(spark: SparkSession, d: str) -> DataFrame:
    """One restaurant's findings, newest first (the page is the feature)."""
    own = inspections(spark, d).where(F.col("restaurant_key") == KEY).select("inspection_id", "inspected")
    return findings(spark, d).join(own, "inspection_id").orderBy(F.desc("inspected"), F.desc("inspection_id"), "line").limit(100).select("inspection_id", "line", "code", "critical", "found", "inspected")


@query("inspections", HISTORY_SQL + f"SELECT inspection_id, inspected, grade, score, previous_grade FROM history WHERE restaurant_key = {KEY}")
def restaurant_history(spark: SparkSession, d: str) -> DataFrame:
    return history(spark, d).where(F.col("restaurant_key") == KEY).select("inspection_id", "inspected", "grade", "score", "previous_grade")


@query("restaurants inspections", HISTORY_SQL + "SELECT restaurant_key, restaurant_name, cuisine, area_key, grade, score, inspected FROM restaurants LEFT JOIN (SELECT * FROM history WHERE recency = 1) USING (restaurant_key)")
def metadata_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Every restaurant with its latest grade."""
    last = history(spark, d).where("recency = 1").select("restaurant_key", "grade", "score", "inspected")
    return restaurants(spark, d).join(last, "restaurant_key", "left").select("restaurant_key", "restaurant_name", "cuisine", "area_key", "grade", "score", "inspected")


@query("", PLACES_SQL + """, c AS (SELECT family_name AS chain_name, count(*) AS locations, avg(size) AS average_size FROM chained WHERE is_chain GROUP BY family_name)
SELECT chain_name, locations, round(average_size, 6) AS average_size, (SELECT count(*) FROM c) AS total FROM c ORDER BY locations DESC, chain_name LIMIT 20 OFFSET 20""")
def chain_page(spark: SparkSession, d: str) -> DataFrame:
    """The second page of chains by size, with the number of all (paging is the feature)."""
    c = names.chains(named_places(spark, d)).where("is_chain").groupBy("chain_name").agg(F.count(F.lit(1)).alias("locations"), F.round(F.avg("size"), 6).alias("average_size"))
    return c.orderBy(F.desc("locations"), "chain_name").offset(20).limit(20).crossJoin(F.broadcast(c.agg(F.count(F.lit(1)).alias("total"))))


@query("", PLACES_SQL + """SELECT place_key, name, brand FROM chained WHERE is_chain AND family_name = (SELECT min(family_name) FROM chained WHERE is_chain)""")
def chain_locations(spark: SparkSession, d: str) -> DataFrame:
    """All places of one chain."""
    chained = names.chains(named_places(spark, d)).where("is_chain")
    first = F.broadcast(chained.agg(F.min("chain_name").alias("__first")))
    return chained.crossJoin(first).where("chain_name = __first").select("place_key", "name", "brand")


@query("areas restaurants inspections", LATEST_SQL + """, e AS (SELECT cuisine, 100.0::DOUBLE * count(*) FILTER (grade IN ('B', 'C')) / count(*) AS attention FROM latest JOIN restaurants USING (restaurant_key) WHERE cuisine IN ('BUILDING', 'MACHINERY', 'FURNITURE') GROUP BY cuisine HAVING count(*) >= 25)
SELECT area_name, cuisine, count(*) AS restaurants, count(grade) AS graded, round(100.0::DOUBLE * count(*) FILTER (grade = 'A') / nullif(count(grade), 0), 6) AS grade_a_percent, round(any_value(attention), 6) AS attention
FROM restaurants r JOIN areas USING (area_key) JOIN e USING (cuisine) LEFT JOIN latest USING (restaurant_key) GROUP BY area_name, cuisine""")
def familiar_heatmap(spark: SparkSession, d: str) -> DataFrame:
    """Chosen cuisines with enough graded restaurants, by area, with their share of B and C overall."""
    chosen = spark.createDataFrame([(c,) for c in ("BUILDING", "MACHINERY", "FURNITURE")], "cuisine string")
    last = latest_graded(spark, d).select("restaurant_key", "grade")
    r = restaurants(spark, d).join(F.broadcast(chosen), "cuisine")
    eligible = last.join(r, "restaurant_key").groupBy("cuisine").agg(F.count(F.lit(1)).alias("n"), percent(F.count_if(F.col("grade").isin("B", "C")), F.count(F.lit(1))).alias("attention")).where("n >= 25").drop("n")
    out = r.join(F.broadcast(areas(spark, d)), "area_key").join(eligible, "cuisine").join(last, "restaurant_key", "left")
    return out.groupBy("area_name", "cuisine").agg(F.count(F.lit(1)).alias("restaurants"), F.count("grade").alias("graded"), F.round(percent(F.count_if(F.col("grade") == "A"), F.count("grade")), 6).alias("grade_a_percent"), F.round(F.first("attention"), 6).alias("attention"))


@query("areas restaurants inspections findings", WEEKLY_SQL + "SELECT week, complaint_count, finding_count, critical_count FROM (SELECT *, row_number() OVER (ORDER BY week DESC) AS k FROM grid WHERE area_key = -1) WHERE k <= 12")
def weekly_recent(spark: SparkSession, d: str) -> DataFrame:
    """The last twelve weeks over all areas."""
    w = weekly(spark, d).where(F.col("area_key") == TOTAL)
    return top_per_key(w, ["area_key"], [F.desc("week")], 12).select("week", "complaint_count", "finding_count", "critical_count")


@query("restaurants inspections", SCORES_SQL + """, f AS (SELECT *, CASE WHEN risk >= 0.68 THEN 'HIGH' WHEN risk >= 0.65 THEN 'MODERATE' ELSE 'LOW' END AS category FROM scores)
SELECT restaurant_key, restaurant_name, cuisine, risk, category FROM f WHERE category = 'MODERATE' AND cuisine = 'BUILDING' ORDER BY risk DESC, restaurant_key LIMIT 25""")
def risk_page(spark: SparkSession, d: str) -> DataFrame:
    """Scored restaurants of a category and cuisine, by risk (the page is the feature)."""
    r = rate_scores(spark, d).join(restaurants(spark, d).where("cuisine = 'BUILDING'"), "restaurant_key")
    t = r.withColumn("category", metrics.tier(F.col("risk"), F.lit(0.65), F.lit(0.68))).where("category = 'MODERATE'")
    return t.orderBy(F.desc("risk"), "restaurant_key").limit(25).select("restaurant_key", "restaurant_name", "cuisine", "risk", "category")


@query("restaurants", "SELECT DISTINCT cuisine FROM restaurants WHERE cuisine IS NOT NULL")
def cuisine_list(spark: SparkSession, d: str) -> DataFrame:
    return restaurants(spark, d).select("cuisine").where("cuisine IS NOT NULL").distinct()


@query("", "SELECT p_brand AS alias, count(DISTINCT p_size) AS n FROM part GROUP BY p_brand HAVING count(DISTINCT p_size) > 1")
def alias_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Aliases that stand for more than one thing."""
    return names.conflicts(table(spark, d, "part").select(F.col("p_brand").alias("alias"), "p_size"), "alias", "p_size")


@query("", "SELECT count(*) AS row_count, count(*) - count(DISTINCT (text, lang, source, n_chars)) AS copies FROM documents")
def copy_count(spark: SparkSession, d: str) -> DataFrame:
    """Rows beyond the first of each combination, by one aggregation over a hash of them."""
    from millrace.functions.text import row_hash

    groups = table(spark, d, "documents").groupBy(row_hash("text", "lang", "source", "n_chars").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("copies"))


@query("", """SELECT p_brand, p_type, count(*) AS rows_seen, count(DISTINCT p_name) AS names_seen, min(p_retailprice) AS least FROM part WHERE regexp_matches(p_type, '[/&,]') OR regexp_matches(upper(p_name), '\\bAND\\b') OR p_size > 40 GROUP BY ALL""")
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    """Rows that a person should look at: separators in a name, or a mark; counted by group."""
    odd = F.col("p_type").rlike("[/&,]") | F.col("p_name").rlike(r"(?i)\bAND\b") | (F.col("p_size") > 40)
    return table(spark, d, "part").where(odd).groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("rows_seen"), F.count_distinct("p_name").alias("names_seen"), F.min("p_retailprice").alias("least"))


@query("inspections", "SELECT min(inspected) AS least, max(inspected) AS greatest, count(*) FILTER (inspected = DATE '1900-01-01') AS sentinels, count(*) FILTER (inspected IS NULL) AS invalid FROM inspections")
def date_profile(spark: SparkSession, d: str) -> DataFrame:
    return inspections(spark, d).agg(F.min("inspected").alias("least"), F.max("inspected").alias("greatest"), F.count_if(F.col("inspected") == F.lit("1900-01-01").cast("date")).alias("sentinels"), F.count_if(F.col("inspected").isNull()).alias("invalid"))


@query("inspections", DAILY_SQL + """, l AS (SELECT *, lead(inspected) OVER w AS next_inspected, lead(grade) OVER w AS next_grade FROM daily WINDOW w AS (PARTITION BY restaurant_key ORDER BY inspected)), t AS (SELECT *, CAST(next_grade IN ('B', 'C') AS INTEGER) AS target FROM l WHERE next_inspected IS NOT NULL)
SELECT CASE WHEN next_inspected < DATE '2000-01-01' THEN 'train' WHEN next_inspected <= DATE '2001-05-31' THEN 'mature' ELSE 'immature' END AS part, count(*) AS n, CAST(sum(target) AS BIGINT) AS positives, round(avg(target), 6) AS rate FROM t GROUP BY ALL""")
def chronological_parts(spark: SparkSession, d: str) -> DataFrame:
    """Labelled rows by time: training, matured and not yet matured ones."""
    day = F.col("next_inspected")
    part = F.when(day < F.lit("2000-01-01").cast("date"), "train").when(day <= F.lit("2001-05-31").cast("date"), "mature").otherwise("immature")
    return labelled(spark, d).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("positives"), F.round(F.avg("target"), 6).alias("rate"))


@query("", SCORED_SQL + """, t AS (SELECT segment, CASE WHEN score >= 0.7 THEN 'HIGH' WHEN score >= 0.4 THEN 'MODERATE' ELSE 'LOW' END AS tier FROM scored)
SELECT segment, tier, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY segment), 6) AS share FROM t GROUP BY segment, tier""")
def tier_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares of risk tiers in each segment, for watching drift."""
    t = scored_labels(spark, d).groupBy("segment", metrics.tier(F.col("score"), F.lit(0.4), F.lit(0.7)).alias("tier")).agg(F.count(F.lit(1)).alias("n"))
    return t.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("segment")), 6))


@query("", "SELECT c_custkey AS key, count(o_orderkey) AS active FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY c_custkey")
def active_only(spark: SparkSession, d: str) -> DataFrame:
    """Customers of a set (a semi-join), with a count that keeps those without any."""
    orders = table(spark, d, "orders")
    kept = table(spark, d, "customer").join(orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select(F.col("c_custkey").alias("key"))
    n = orders.where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("active"))
    return kept.join(n, "key", "left").fillna(0, ["active"])


