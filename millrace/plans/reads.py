"""Read queries of the serving layer: indicators, scorecards, correlations, search, rankings, look-ups by place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import EARTH_ROUND, direction, fisher_bound, pearson, percent, ratio, strength
from millrace.functions.text import FINDING_LABELS, ISSUE_LABELS, finding_label, has_terms, issue_label, search_terms
from millrace.operators import grids
from millrace.operators.nearest import matched, nearby
from millrace.operators.rows import top_per_key
from millrace.plans.models import DAILY_SQL, HISTORY_SQL, LATEST_SQL, PLACES_SQL, SCORES_SQL, WEEKLY_SQL, daily, history, latest_graded, named_places, rate_scores, weekly
from millrace.plans.roles import GRADES, TOTAL, areas, complaints, findings, inspections, query, restaurants, table

# Fixed choices of the registered queries.
LAG, WEEKS = 2, 52


def kpis(spark: SparkSession, d: str) -> DataFrame:
    """metric, value, comparison: six indicators, each from one pass over its fact. Dates of reference are the facts' last days."""
    graded = inspections(spark, d).where(F.col("grade").isin(*GRADES))
    last = F.broadcast(inspections(spark, d).agg(F.max("inspected").alias("last")))

    def grades(rows: DataFrame) -> DataFrame:
        latest = top_per_key(rows, ["restaurant_key"], [F.desc("inspected"), F.desc("inspection_id")])
        return latest.agg(percent(F.count_if(F.col("grade") == "A"), F.count(F.lit(1))).alias("a"), F.avg("score").alias("s"))

    now, then = grades(graded), grades(graded.crossJoin(last).where(F.col("inspected") <= F.add_months("last", -1)))
    both = now.crossJoin(F.broadcast(then.select(F.col("a").alias("a2"), F.col("s").alias("s2"))))
    flags = findings(spark, d).groupBy("inspection_id").agg(F.bool_or("critical").alias("critical")).join(inspections(spark, d), "inspection_id").crossJoin(last)
    year, before = F.col("inspected") > F.add_months("last", -12), (F.col("inspected") > F.add_months("last", -24)) & (F.col("inspected") <= F.add_months("last", -12))
    rates = flags.agg(percent(F.count_if(F.col("critical") & year), F.count_if(year)).alias("v"), percent(F.count_if(F.col("critical") & before), F.count_if(before)).alias("c"))
    c = complaints(spark, d)
    end = F.broadcast(c.agg(F.max("created").cast("date").alias("day")))
    at = lambda days: F.date_add("day", days).cast("timestamp_ntz")
    open_at = lambda t: F.count_if((F.col("created") < t) & (F.col("closed").isNull() | (F.col("closed") >= t)))
    opened = c.where(F.col("kind").isin("error", "purchase")).crossJoin(end).agg(open_at(at(1)).cast("double").alias("v"), open_at(at(-6)).cast("double").alias("c"))
    same_year = F.year("inspected") == F.year("last")
    same_month = same_year & (F.month("inspected") == F.month("last"))
    urgent = inspections(spark, d).where(F.startswith(F.lower("action"), F.lit("1-urgent")) | F.startswith(F.lower("action"), F.lit("2-high"))).crossJoin(last)
    closures = urgent.agg(F.count_distinct(F.when(same_year, F.col("inspection_id"))).cast("double").alias("v"), F.count_distinct(F.when(same_month, F.col("inspection_id"))).cast("double").alias("c"))
    count = restaurants(spark, d).agg(F.count(F.lit(1)).cast("double").alias("v")).withColumn("c", F.lit(None).cast("double"))
    named = [
        ("active_restaurants", count), ("grade_a_rate", both.select(F.col("a").alias("v"), F.col("a2").alias("c"))), ("average_score", both.select(F.col("s").alias("v"), F.col("s2").alias("c"))),
        ("critical_rate", rates), ("open_complaints", opened), ("closures_this_year", closures),
    ]
    out = None
    for name, df in named:
        row = df.select(F.lit(name).alias("metric"), F.round("v", 6).alias("value"), F.round("c", 6).alias("comparison"))
        out = row if out is None else out.unionByName(row)
    return out


KPI_SQL = LATEST_SQL + """, x AS (SELECT max(inspected) AS last FROM inspections), y AS (SELECT CAST(max(created) AS DATE) AS day FROM complaints),
now AS (SELECT 100.0::DOUBLE * count(*) FILTER (grade = 'A') / nullif(count(*), 0) AS a, avg(score) AS s FROM latest),
old AS (SELECT * FROM (SELECT i.*, row_number() OVER (PARTITION BY restaurant_key ORDER BY inspected DESC, inspection_id DESC) AS k FROM inspections i, x WHERE grade IN ('A', 'B', 'C') AND inspected <= last - INTERVAL 1 MONTH) WHERE k = 1),
prev AS (SELECT 100.0::DOUBLE * count(*) FILTER (grade = 'A') / nullif(count(*), 0) AS a, avg(score) AS s FROM old),
flags AS (SELECT inspection_id, inspected, last, bool_or(critical) AS critical FROM findings JOIN inspections USING (inspection_id), x GROUP BY ALL),
rates AS (SELECT 100.0::DOUBLE * count(*) FILTER (critical AND inspected > last - INTERVAL 12 MONTH) / nullif(count(*) FILTER (inspected > last - INTERVAL 12 MONTH), 0) AS v,
    100.0::DOUBLE * count(*) FILTER (critical AND inspected > last - INTERVAL 24 MONTH AND inspected <= last - INTERVAL 12 MONTH) / nullif(count(*) FILTER (inspected > last - INTERVAL 24 MONTH AND inspected <= last - INTERVAL 12 MONTH), 0) AS c FROM flags),
opened AS (SELECT count(*) FILTER (created < day + INTERVAL 1 DAY AND (closed IS NULL OR closed >= day + INTERVAL 1 DAY))::DOUBLE AS v, count(*) FILTER (created < day - INTERVAL 6 DAY AND (closed IS NULL OR closed >= day - INTERVAL 6 DAY))::DOUBLE AS c FROM complaints, y WHERE kind IN ('error', 'purchase')),
closures AS (SELECT count(DISTINCT CASE WHEN year(inspected) = year(last) THEN inspection_id END)::DOUBLE AS v, count(DISTINCT CASE WHEN year(inspected) = year(last) AND month(inspected) = month(last) THEN inspection_id END)::DOUBLE AS c FROM inspections, x WHERE lower(action) LIKE '1-urgent%' OR lower(action) LIKE '2-high%'),
kpi AS (SELECT 'active_restaurants' AS metric, count(*)::DOUBLE AS v, NULL::DOUBLE AS c FROM restaurants
UNION ALL SELECT 'grade_a_rate', now.a, prev.a FROM now, prev UNION ALL SELECT 'average_score', now.s, prev.s FROM now, prev UNION ALL SELECT 'critical_rate', v, c FROM rates UNION ALL SELECT 'open_complaints', v, c FROM opened UNION ALL SELECT 'closures_this_year', v, c FROM closures)"""


@query("restaurants inspections findings complaints", KPI_SQL + """, k AS (SELECT metric, round(v, 6) AS value, round(c, 6) AS comparison FROM kpi),
t AS (SELECT *, CASE WHEN round(value - comparison, 1) = 0 THEN 0 ELSE round(value - comparison, 1) END AS delta FROM k)
SELECT metric, value, comparison, CASE WHEN metric = 'active_restaurants' THEN 'neutral' WHEN metric = 'closures_this_year' THEN CASE WHEN coalesce(comparison, 0) > 0 THEN 'negative' ELSE 'positive' END
    WHEN delta IS NULL OR delta = 0 THEN 'neutral' WHEN metric = 'grade_a_rate' THEN CASE WHEN delta > 0 THEN 'positive' ELSE 'negative' END ELSE CASE WHEN delta < 0 THEN 'positive' ELSE 'negative' END END AS tone FROM t""")
def kpi_block(spark: SparkSession, d: str) -> DataFrame:
    """The indicators with the tone of their change: more grade A is good, more of the others is not."""
    k = kpis(spark, d)
    delta = F.round(F.col("value") - F.col("comparison"), 1)
    good = F.when(F.col("metric") == "grade_a_rate", delta > 0).otherwise(delta < 0)
    sign = F.when(good, "positive").otherwise("negative")
    tone = F.when(F.col("metric") == "active_restaurants", "neutral").when(F.col("metric") == "closures_this_year", F.when(F.coalesce("comparison", F.lit(0.0)) > 0, "negative").otherwise("positive")).when(delta.isNull() | (delta == 0), "neutral").otherwise(sign)
    return k.withColumn("tone", tone)


def trend_text(k: DataFrame) -> DataFrame:
    """Adds trend, what a dashboard shows beside an indicator; no negative zero, no change where there's nothing to compare."""
    v, c = F.col("value"), F.col("comparison")
    delta = F.round(v - c, 1)
    plain = F.when(delta == 0, F.lit(0.0)).otherwise(delta)
    plus = F.when(plain > 0, "+").otherwise("")
    change = F.concat(plus, F.format_string("%.1f", plain))
    share = F.coalesce(ratio(v - c, c, 100.0), F.lit(0.0))
    month = F.coalesce(c, F.lit(0.0)).cast("int")
    trend = (
        F.when(F.col("metric") == "active_restaurants", "Current snapshot")
        .when(F.col("metric") == "closures_this_year", F.concat(F.when(month != 0, "+").otherwise(""), month.cast("string"), F.lit(" this month")))
        .when(v.isNull() | c.isNull(), "Comparison unavailable")
        .when(F.col("metric") == "grade_a_rate", F.concat(change, F.lit("pt MoM")))
        .when(F.col("metric") == "average_score", F.concat(change, F.lit("pt MoM"), F.when(plain < 0, " (better)").otherwise("")))
        .when(F.col("metric") == "critical_rate", F.concat(change, F.lit("/100 YoY")))
        .otherwise(F.concat(F.when(share > 0, "+").otherwise(""), F.format_string("%.1f", share), F.lit("% WoW")))
    )
    return k.withColumn("trend", trend)


@query("areas restaurants inspections findings", LATEST_SQL + "," + HISTORY_SQL + """,
g AS (SELECT area_key, count(*) AS graded, 100.0::DOUBLE * count(*) FILTER (grade = 'A') / count(*) AS a_percent FROM latest JOIN restaurants USING (restaurant_key) WHERE area_key IS NOT NULL GROUP BY area_key),
issues AS (SELECT area_key, code, row_number() OVER (PARTITION BY area_key ORDER BY count(*) DESC, code) AS k FROM findings JOIN inspections USING (inspection_id) JOIN restaurants USING (restaurant_key) WHERE critical AND area_key IS NOT NULL GROUP BY area_key, code),
crit AS (SELECT area_key, 100.0::DOUBLE * count(DISTINCT CASE WHEN critical THEN inspection_id END) / nullif(count(DISTINCT inspection_id), 0) AS rate FROM findings JOIN inspections USING (inspection_id) JOIN restaurants USING (restaurant_key) GROUP BY area_key),
imp AS (SELECT area_key, 100.0::DOUBLE * count(*) FILTER (grade = 'A' AND previous_grade IN ('B', 'C')) / nullif(count(*) FILTER (previous_grade IN ('B', 'C')), 0) AS rate FROM history JOIN restaurants USING (restaurant_key) WHERE inspected > (SELECT max(inspected) FROM history) - INTERVAL 12 MONTH GROUP BY area_key)
SELECT a.area_key, area_name, coalesce(graded, 0) AS graded, round(a_percent, 6) AS grade_a_percent, code AS top_issue, round(crit.rate, 6) AS critical_rate, round(imp.rate, 6) AS improvement_rate,
    CAST(row_number() OVER (ORDER BY a_percent DESC NULLS LAST, area_name) AS INTEGER) AS safety_rank FROM areas a LEFT JOIN g ON g.area_key = a.area_key LEFT JOIN issues i ON i.area_key = a.area_key AND k = 1 LEFT JOIN crit ON crit.area_key = a.area_key LEFT JOIN imp ON imp.area_key = a.area_key""")
def area_scorecard(spark: SparkSession, d: str) -> DataFrame:
    """Areas by the share of grade A, with the commonest critical finding, critical and improvement rates."""
    own = restaurants(spark, d).select("restaurant_key", "area_key")
    g = latest_graded(spark, d).join(own, "restaurant_key").groupBy("area_key").agg(F.count(F.lit(1)).alias("graded"), percent(F.count_if(F.col("grade") == "A"), F.count(F.lit(1))).alias("a"))
    each = findings(spark, d).groupBy("inspection_id", "code").agg(F.count(F.lit(1)).alias("n"), F.bool_or("critical").alias("critical")).join(inspections(spark, d).select("inspection_id", "restaurant_key"), "inspection_id").join(own, "restaurant_key")
    per_area = each.where("critical").groupBy("area_key", "code").agg(F.sum("n").alias("n"))
    issue = top_per_key(per_area, ["area_key"], [F.desc("n"), F.asc("code")]).select("area_key", F.col("code").alias("top_issue"))
    rate = each.groupBy("area_key", "inspection_id").agg(F.bool_or("critical").alias("critical")).groupBy("area_key").agg(percent(F.count_if("critical"), F.count(F.lit(1))).alias("critical_rate"))
    h = history(spark, d)
    last = F.broadcast(h.agg(F.max("inspected").alias("last")))
    improved = h.crossJoin(last).where(F.col("inspected") > F.add_months("last", -12)).join(own, "restaurant_key").groupBy("area_key").agg(percent(F.count_if("improved_to_a"), F.count_if(F.col("previous_grade").isin("B", "C"))).alias("improvement_rate"))
    out = areas(spark, d)
    for part in (g, issue, rate, improved):
        out = out.join(part, "area_key", "left")
    ranked = out.withColumn("safety_rank", F.row_number().over(Window.orderBy(F.col("a").desc_nulls_last(), "area_name")))  # a row per area
    return ranked.select("area_key", "area_name", F.coalesce("graded", F.lit(0)).alias("graded"), F.round("a", 6).alias("grade_a_percent"), "top_issue", F.round("critical_rate", 6).alias("critical_rate"), F.round("improvement_rate", 6).alias("improvement_rate"), "safety_rank")


@query("areas restaurants inspections", LATEST_SQL + """SELECT a.area_key, area_name, round(100.0 * count(*) FILTER (grade = 'A') / count(*), 6)::DOUBLE AS a, round(100.0 * count(*) FILTER (grade = 'B') / count(*), 6)::DOUBLE AS b, round(100.0 * count(*) FILTER (grade = 'C') / count(*), 6)::DOUBLE AS c
FROM latest JOIN restaurants r USING (restaurant_key) JOIN areas a ON a.area_key = r.area_key GROUP BY ALL""")
def grade_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Shares of grades as columns."""
    counts = latest_graded(spark, d).join(restaurants(spark, d), "restaurant_key").join(areas(spark, d), "area_key").groupBy("area_key", "area_name").pivot("grade", list(GRADES)).count().fillna(0)
    every = sum((F.col(g) for g in GRADES[1:]), F.col("A"))
    return counts.select("area_key", "area_name", *[F.round(percent(F.col(g), every), 6).alias(g.lower()) for g in GRADES])


@query("restaurants inspections", LATEST_SQL + """SELECT cuisine, count(*) AS restaurants, round(100.0 * count(*) FILTER (grade = 'A') / count(*), 6)::DOUBLE AS grade_a_percent FROM latest JOIN restaurants USING (restaurant_key) GROUP BY cuisine HAVING count(*) >= 10 ORDER BY grade_a_percent DESC, restaurants DESC, cuisine LIMIT 15""")
def cuisine_ranking(spark: SparkSession, d: str) -> DataFrame:
    """Cuisines with ten graded restaurants at least, the best fifteen (a top-k report)."""
    g = latest_graded(spark, d).join(restaurants(spark, d), "restaurant_key").groupBy("cuisine").agg(F.count(F.lit(1)).alias("restaurants"), F.round(percent(F.count_if(F.col("grade") == "A"), F.count(F.lit(1))), 6).alias("grade_a_percent"))
    return g.where("restaurants >= 10").orderBy(F.desc("grade_a_percent"), F.desc("restaurants"), "cuisine").limit(15)


@query("areas restaurants inspections findings", """e AS (SELECT area_key, inspection_id, count(*) AS n, count(*) FILTER (critical) AS c FROM findings JOIN inspections USING (inspection_id) JOIN restaurants USING (restaurant_key) GROUP BY ALL)
SELECT a.area_key, area_name, count(inspection_id) AS inspections, round(sum(n) / count(inspection_id), 6)::DOUBLE AS findings_per_inspection, round(sum(c) / count(inspection_id), 6)::DOUBLE AS critical_per_inspection FROM areas a LEFT JOIN e ON e.area_key = a.area_key GROUP BY ALL""")
def findings_per_event(spark: SparkSession, d: str) -> DataFrame:
    """Findings for each distinct inspection by area."""
    e = findings(spark, d).groupBy("inspection_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("critical").alias("c")).join(inspections(spark, d).select("inspection_id", "restaurant_key"), "inspection_id").join(restaurants(spark, d).select("restaurant_key", "area_key"), "restaurant_key")
    per = e.groupBy("area_key").agg(F.count(F.lit(1)).alias("inspections"), F.round(ratio(F.sum("n"), F.count(F.lit(1))), 6).alias("findings_per_inspection"), F.round(ratio(F.sum("c"), F.count(F.lit(1))), 6).alias("critical_per_inspection"))
    return areas(spark, d).join(per, "area_key", "left").fillna(0, ["inspections"])


@query("areas restaurants inspections findings", """t AS (SELECT area_key, count(*) AS total FROM restaurants WHERE area_key IS NOT NULL GROUP BY area_key),
m AS (SELECT r.area_key, code, bool_or(critical) AS critical, count(*) AS n, count(DISTINCT restaurant_key) AS places FROM findings JOIN inspections USING (inspection_id) JOIN restaurants r USING (restaurant_key) WHERE r.area_key IS NOT NULL GROUP BY r.area_key, code)
SELECT code, bool_or(critical) AS critical, CAST(sum(n) AS BIGINT) AS finding_count, CAST(sum(places) AS BIGINT) AS restaurants, round(100.0 * sum(n) / nullif(sum(total), 0), 6)::DOUBLE AS per_100_restaurants FROM m JOIN t USING (area_key) GROUP BY code ORDER BY finding_count DESC, code LIMIT 15""")
def violations_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Codes by frequency (a top-k report); the denominator sums the areas in which a code occurs."""
    own = restaurants(spark, d).where("area_key IS NOT NULL").select("restaurant_key", "area_key")
    total = own.groupBy("area_key").agg(F.count(F.lit(1)).alias("total"))
    each = findings(spark, d).groupBy("inspection_id", "code").agg(F.count(F.lit(1)).alias("n"), F.bool_or("critical").alias("critical")).join(inspections(spark, d).select("inspection_id", "restaurant_key"), "inspection_id").join(own, "restaurant_key")
    by_place = each.groupBy("area_key", "code", "restaurant_key").agg(F.sum("n").alias("n"), F.bool_or("critical").alias("critical"))
    mart = by_place.groupBy("area_key", "code").agg(F.sum("n").alias("n"), F.bool_or("critical").alias("critical"), F.count(F.lit(1)).alias("places"))
    out = mart.join(total, "area_key").groupBy("code").agg(F.bool_or("critical").alias("critical"), F.sum("n").alias("finding_count"), F.sum("places").alias("restaurants"), F.round(percent(F.sum("n"), F.sum("total")), 6).alias("per_100_restaurants"))
    return out.orderBy(F.desc("finding_count"), "code").limit(15)


PAIRED_SQL = WEEKLY_SQL + f""", recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY area_key ORDER BY week DESC) AS k FROM grid) WHERE k <= {WEEKS + LAG}),
paired AS (SELECT * FROM (SELECT *, lead(critical_count, {LAG}) OVER (PARTITION BY area_key ORDER BY week) AS later FROM recent) WHERE later IS NOT NULL),
m AS (SELECT area_key, count(*) AS n, CAST(sum(complaint_count) AS BIGINT) AS complaints, CAST(sum(later) AS BIGINT) AS failures, CASE WHEN count(*) >= 3 AND stddev_pop(complaint_count) > 0 AND stddev_pop(later) > 0 THEN corr(complaint_count, later) END AS r FROM paired GROUP BY area_key)"""


def paired(spark: SparkSession, d: str) -> DataFrame:
    """Per area over the last weeks: complaints against critical findings LAG weeks later."""
    recent = top_per_key(weekly(spark, d), ["area_key"], [F.desc("week")], WEEKS + LAG)
    both = grids.lagged(recent, "area_key", "week", "critical_count", LAG)
    return both.groupBy("area_key").agg(F.count(F.lit(1)).alias("n"), F.sum("complaint_count").alias("complaints"), F.sum("later_critical_count").alias("failures"), pearson("complaint_count", "later_critical_count").alias("r"))


@query("areas restaurants inspections findings", PAIRED_SQL + """SELECT area_key, n AS observations, complaints, failures, round(r, 6) AS coefficient, round(tanh(atanh(CASE WHEN n > 3 AND abs(r) < 1 THEN r END) - 1.96 / sqrt(greatest(n - 3, 1))), 6) AS low, round(tanh(atanh(CASE WHEN n > 3 AND abs(r) < 1 THEN r END) + 1.96 / sqrt(greatest(n - 3, 1))), 6) AS high,
    CASE WHEN r IS NULL THEN 'not calculable' WHEN abs(r) < 0.3 THEN 'weak' WHEN abs(r) < 0.6 THEN 'moderate' ELSE 'strong' END AS strength, CASE WHEN r IS NULL THEN 'not_calculable' WHEN r > 0 THEN 'positive' WHEN r < 0 THEN 'negative' ELSE 'none' END AS direction FROM m""")
def lagged_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Correlation of each area's series at a lag, with its 95 % interval."""
    m = paired(spark, d)
    r, n = F.col("r"), F.col("n")
    return m.select("area_key", n.alias("observations"), "complaints", "failures", F.round(r, 6).alias("coefficient"), fisher_bound(r, n, -1).alias("low"), fisher_bound(r, n, 1).alias("high"), strength(r).alias("strength"), direction(r).alias("direction"))


@query("areas restaurants inspections findings", PAIRED_SQL + """SELECT area_key, complaints, failures, round(least(100.0::DOUBLE * complaints / nullif(max(complaints) OVER (), 0), 100.0::DOUBLE * failures / nullif(max(failures) OVER (), 0)), 6) AS overlap FROM m WHERE area_key >= 0""")
def area_map_metric(spark: SparkSession, d: str) -> DataFrame:
    """How far complaints and failures are both high, against the highest area."""
    m = paired(spark, d).where(F.col("area_key") != TOTAL)
    everything = Window.partitionBy()  # a row per area
    share = lambda c: percent(F.col(c), F.max(c).over(everything))
    return m.select("area_key", "complaints", "failures", F.round(F.least(share("complaints"), share("failures")), 6).alias("overlap"))


SEARCH = "Customer at 7 in building"


@query("areas restaurants inspections", LATEST_SQL + """, hits AS (SELECT r.restaurant_key, restaurant_name, cuisine, area_name, grade, score, inspected FROM restaurants r LEFT JOIN areas a ON a.area_key = r.area_key LEFT JOIN latest l ON l.restaurant_key = r.restaurant_key
    WHERE contains(upper(concat_ws(' ', restaurant_name, coalesce(area_name, ''), cuisine)), 'CUSTOMER') AND contains(upper(concat_ws(' ', restaurant_name, coalesce(area_name, ''), cuisine)), 'BUILDING'))
SELECT *, (SELECT count(*) FROM hits) AS total FROM hits ORDER BY score DESC NULLS LAST, restaurant_key LIMIT 25 OFFSET 25""")
def entity_search_page(spark: SparkSession, d: str) -> DataFrame:
    """The second page of a text search, sorted, with the number of all hits (paging is the feature)."""
    words = spark.range(1).select(search_terms(F.lit(SEARCH)).alias("t")).first()[0]
    everyone = restaurants(spark, d).join(F.broadcast(areas(spark, d)), "area_key", "left").join(latest_graded(spark, d).drop("action"), "restaurant_key", "left")
    hits = everyone.where(has_terms([F.col("restaurant_name"), F.col("area_name"), F.col("cuisine")], words)).select("restaurant_key", "restaurant_name", "cuisine", "area_name", "grade", "score", "inspected")
    page = hits.orderBy(F.col("score").desc_nulls_last(), "restaurant_key").offset(25).limit(25)
    return page.crossJoin(F.broadcast(hits.agg(F.count(F.lit(1)).alias("total"))))


@query("inspections findings", """k1 AS (SELECT restaurant_key, code, found, inspection_id, line, row_number() OVER (PARTITION BY restaurant_key, code ORDER BY found DESC, inspection_id DESC, line) AS a FROM findings JOIN inspections USING (inspection_id)),
k2 AS (SELECT *, row_number() OVER (PARTITION BY restaurant_key ORDER BY found DESC, inspection_id DESC, line) AS place FROM k1 WHERE a = 1) SELECT restaurant_key, code, found, inspection_id, line, CAST(place AS INTEGER) AS place FROM k2 WHERE place <= 6""")
def recent_findings_top6(spark: SparkSession, d: str) -> DataFrame:
    """The six latest different findings of each restaurant. Codes of one line found on one day, which the SQL leaves open, are ordered by themselves."""
    rows = findings(spark, d).join(inspections(spark, d).select("inspection_id", "restaurant_key"), "inspection_id").select("restaurant_key", "code", "found", "inspection_id", "line")
    order = [F.desc("found"), F.desc("inspection_id"), F.asc("line"), F.asc("code")]
    return top_per_key(top_per_key(rows, ["restaurant_key", "code"], order), ["restaurant_key"], order, 6, rank="place")


@query("inspections findings", """r AS (SELECT restaurant_key, code, count(DISTINCT inspection_id) AS n FROM findings JOIN inspections USING (inspection_id) WHERE critical AND inspected > DATE '1998-12-31' GROUP BY ALL HAVING count(DISTINCT inspection_id) >= 2)
SELECT restaurant_key, array_to_string(list_sort(list(code)), '|') AS codes, count(*) AS code_count, max(n) AS most, true AS has_repeated FROM r GROUP BY restaurant_key""")
def repeated_critical(spark: SparkSession, d: str) -> DataFrame:
    """Critical findings met at two inspections or more of the last three years."""
    rows = findings(spark, d).where("critical").select("inspection_id", "code").distinct().join(inspections(spark, d).where(F.col("inspected") > F.lit("1998-12-31").cast("date")).select("inspection_id", "restaurant_key"), "inspection_id")
    again = rows.groupBy("restaurant_key", "code").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    return again.groupBy("restaurant_key").agg(F.array_join(F.array_sort(F.collect_list("code")), "|").alias("codes"), F.count(F.lit(1)).alias("code_count"), F.max("n").alias("most")).withColumn("has_repeated", F.lit(True))


@query("inspections", """y AS (SELECT * FROM (SELECT restaurant_key, year(inspected) AS year, grade, row_number() OVER (PARTITION BY restaurant_key, year(inspected) ORDER BY inspected DESC, inspection_id DESC) AS k FROM inspections WHERE grade IN ('A', 'B', 'C')) WHERE k = 1),
c AS (SELECT year, grade, count(*) AS n FROM y GROUP BY ALL) SELECT CAST(year AS INTEGER) AS year, grade, n AS restaurants, round(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY year), 2) AS grade_percent FROM c""")
def yearly_grade_trend(spark: SparkSession, d: str) -> DataFrame:
    """Shares of restaurants by their last grade of each year."""
    rows = inspections(spark, d).where(F.col("grade").isin(*GRADES)).withColumn("year", F.year("inspected"))
    counts = top_per_key(rows, ["restaurant_key", "year"], [F.desc("inspected"), F.desc("inspection_id")]).groupBy("year", "grade").agg(F.count(F.lit(1)).alias("restaurants"))
    return counts.withColumn("grade_percent", F.round(percent(F.col("restaurants"), F.sum("restaurants").over(Window.partitionBy("year"))), 2))


@query("inspections", DAILY_SQL + """, y AS (SELECT restaurant_key, year(inspected) AS year, max_by(grade, inspected) AS grade FROM daily WHERE inspected >= DATE '1999-01-01' GROUP BY ALL) SELECT restaurant_key, string_agg(year || ':' || grade, ' ' ORDER BY year) AS grades FROM y GROUP BY restaurant_key""")
def three_year_grades(spark: SparkSession, d: str) -> DataFrame:
    """The last grade of each recent year, in order."""
    rows = daily(spark, d).where(F.col("inspected") >= F.lit("1999-01-01").cast("date")).groupBy("restaurant_key", F.year("inspected").alias("year")).agg(F.max_by("grade", "inspected").alias("grade"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("year", "grade"))), lambda x: F.concat(x["year"].cast("string"), F.lit(":"), x["grade"]))
    return rows.groupBy("restaurant_key").agg(F.array_join(ordered, " ").alias("grades"))


@query("restaurants inspections", HISTORY_SQL + """SELECT restaurant_key, restaurant_name, inspected, previous_grade, score FROM history JOIN restaurants USING (restaurant_key) WHERE recency = 1 AND grade = 'A' AND previous_grade IN ('B', 'C') AND inspected >= DATE '2001-08-01' - INTERVAL 90 DAY ORDER BY inspected DESC, restaurant_key LIMIT 50""")
def recently_improved(spark: SparkSession, d: str) -> DataFrame:
    """Restaurants that reached an A in the 90 days before a given day (a top-k report)."""
    h = history(spark, d).where((F.col("recency") == 1) & F.col("improved_to_a") & (F.col("inspected") >= F.date_sub(F.lit("2001-08-01").cast("date"), 90)))
    return h.join(restaurants(spark, d).select("restaurant_key", "restaurant_name"), "restaurant_key").select("restaurant_key", "restaurant_name", "inspected", "previous_grade", "score").orderBy(F.desc("inspected"), "restaurant_key").limit(50)


DISTANCE_SQL = "2 * 6371008.8::DOUBLE * asin(least(1, sqrt(pow(sin(radians(r.lat - c.lat) / 2), 2) + cos(radians(c.lat)) * cos(radians(r.lat)) * pow(sin(radians(r.lon - c.lon) / 2), 2))))"


@query("complaints restaurants", f"""pairs AS (SELECT c.complaint_id, r.restaurant_key AS place, {DISTANCE_SQL} AS distance FROM complaints c JOIN restaurants r ON abs(r.lat - c.lat) < 0.001 AND abs(r.lon - c.lon) < 0.002),
best AS (SELECT complaint_id, place, distance FROM (SELECT *, row_number() OVER (PARTITION BY complaint_id ORDER BY distance, place) AS k FROM pairs WHERE distance <= 100) WHERE k = 1)
SELECT complaint_id, place, round(distance, 4) AS distance, CASE WHEN place IS NULL THEN 'NO_PLACE_WITHIN_THRESHOLD' ELSE 'MATCHED' END AS match_status FROM complaints LEFT JOIN best USING (complaint_id)""")
def nearest_match(spark: SparkSession, d: str) -> DataFrame:
    """The nearest restaurant within 100 m of each complaint."""
    out = matched(complaints(spark, d).select("complaint_id", "lat", "lon"), restaurants(spark, d).select(F.col("restaurant_key").alias("place"), "lat", "lon"), "complaint_id", "place")
    return out.select("complaint_id", "place", F.round(F.when(F.col("match_status") == "MATCHED", F.col("distance")), 4).alias("distance"), "match_status")


@query("complaints restaurants", f"""best AS (SELECT c.complaint_id, min({DISTANCE_SQL}) AS m FROM complaints c JOIN restaurants r ON abs(r.lat - c.lat) < 0.0015 AND abs(r.lon - c.lon) < 0.002 GROUP BY c.complaint_id)
SELECT count(*) AS complaints, count(*) FILTER (m <= 25) AS within_25, count(*) FILTER (m <= 50) AS within_50, count(*) FILTER (m <= 75) AS within_75, count(*) FILTER (m <= 100) AS within_100 FROM complaints LEFT JOIN best USING (complaint_id)""")
def match_distance_bands(spark: SparkSession, d: str) -> DataFrame:
    """How many complaints have a restaurant within each distance, in one pass."""
    out = matched(complaints(spark, d).select("complaint_id", "lat", "lon"), restaurants(spark, d).select(F.col("restaurant_key").alias("place"), "lat", "lon"), "complaint_id", "place")
    return out.agg(F.count(F.lit(1)).alias("complaints"), *[F.count_if(F.col("distance") <= m).alias(f"within_{m}") for m in (25, 50, 75, 100)])


@query("restaurants inspections", LATEST_SQL + """, o AS (SELECT lat, lon FROM restaurants WHERE restaurant_key = 7),
n AS (SELECT c.restaurant_key, c.restaurant_name, 2 * 6371000.0::DOUBLE * asin(least(1, sqrt(pow(sin(radians(c.lat - o.lat) / 2), 2) + cos(radians(o.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lon - o.lon) / 2), 2)))) AS distance FROM restaurants c, o WHERE c.restaurant_key <> 7)
SELECT restaurant_key, restaurant_name, round(distance, 3) AS distance FROM n JOIN latest USING (restaurant_key) WHERE distance <= 5000 AND grade = 'A' ORDER BY n.distance, restaurant_key LIMIT 10""")
def nearby_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest restaurants with a latest grade A around one restaurant."""
    every = restaurants(spark, d)
    centre = every.where("restaurant_key = 7").select("lat", "lon").first()
    if centre is None:
        return every.limit(0).select("restaurant_key", "restaurant_name", F.lit(0.0).alias("distance"))
    near = nearby(every.where("restaurant_key <> 7"), centre["lat"], centre["lon"], 5000.0, EARTH_ROUND).join(latest_graded(spark, d).where("grade = 'A'").select("restaurant_key"), "restaurant_key", "left_semi")
    return near.orderBy("distance", "restaurant_key").limit(10).select("restaurant_key", "restaurant_name", F.round("distance", 3).alias("distance"))


@query("inspections complaints findings", "SELECT (SELECT min(inspected) FROM inspections) AS first_inspected, (SELECT max(inspected) FROM inspections) AS last_inspected, (SELECT max(created) FROM complaints) AS last_complaint, (SELECT count(*) FROM findings) AS findings")
def freshness(spark: SparkSession, d: str) -> DataFrame:
    a = inspections(spark, d).agg(F.min("inspected").alias("first_inspected"), F.max("inspected").alias("last_inspected"))
    return a.crossJoin(complaints(spark, d).agg(F.max("created").alias("last_complaint"))).crossJoin(findings(spark, d).agg(F.count(F.lit(1)).alias("findings")))


@query("", PLACES_SQL + """, r AS (SELECT l_partkey AS place_key, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS bad FROM lineitem GROUP BY ALL),
s AS (SELECT chained.*, round((coalesce(bad, 0) + 1) / (coalesce(n, 0) + 2), 6)::DOUBLE AS risk, coalesce(bad, 0) >= 12 AS repeated FROM chained LEFT JOIN r USING (place_key) WHERE is_chain), t AS (SELECT *, CASE WHEN risk >= 0.3 THEN 'HIGH' WHEN risk >= 0.2 THEN 'MODERATE' ELSE 'LOW' END AS tier FROM s),
w AS (SELECT family_name, place_key FROM (SELECT *, row_number() OVER (PARTITION BY family_name ORDER BY risk DESC, place_key DESC) AS k FROM t) WHERE k = 1)
SELECT t.family_name AS chain_name, count(*) AS locations, round(avg(risk), 6) AS average_risk, count(*) FILTER (tier = 'HIGH') AS high_locations, any_value(w.place_key) AS riskiest, bool_or(repeated) AS any_repeated FROM t JOIN w USING (family_name) GROUP BY t.family_name""")
def chain_risk(spark: SparkSession, d: str) -> DataFrame:
    """Risk of each chain from its locations' scores: the share of critical findings among all at a place, one of each kind more; repeated from a dozen on."""
    from millrace.operators import metrics, names

    none = F.lit(0)
    found = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("place_key")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("bad"))
    placed = names.chains(named_places(spark, d)).where("is_chain").join(found, "place_key", "left")
    scored = placed.withColumns({"risk": F.round((F.coalesce("bad", none) + 1) / (F.coalesce("n", none) + 2), 6), "repeated": F.coalesce("bad", none) >= 12}).withColumn("tier", metrics.tier(F.col("risk"), F.lit(0.2), F.lit(0.3)))
    return scored.groupBy("chain_name").agg(F.count(F.lit(1)).alias("locations"), F.round(F.avg("risk"), 6).alias("average_risk"), F.count_if(F.col("tier") == "HIGH").alias("high_locations"), F.max(F.struct("risk", "place_key"))["place_key"].alias("riskiest"), F.bool_or("repeated").alias("any_repeated"))


@query("restaurants inspections", SCORES_SQL + " SELECT restaurant_key, restaurant_name, risk FROM scores ORDER BY risk DESC, restaurant_key LIMIT 20")
def risk_top(spark: SparkSession, d: str) -> DataFrame:
    """The twenty highest scores joined to their restaurants (a top-k report)."""
    best = rate_scores(spark, d).orderBy(F.desc("risk"), "restaurant_key").limit(20)
    return best.join(restaurants(spark, d).select("restaurant_key", "restaurant_name"), "restaurant_key", "left").select("restaurant_key", "restaurant_name", "risk")


# Descriptions for the label rules, by the key's remainder.
DESCRIPTIONS = (
    "Non-food contact surface improperly constructed", "Harborage or conditions conducive to pests exist", "Anti-siphonage device not provided", "Food not protected from potential source of contamination", "Cold TCS food item held above 41 F",
    "Hot TCS food item not held at or above 140 F", "Food contact surface not properly washed", "Hand washing facility not provided", "Wiping cloth not stored clean", "Evidence of rodent activity", "Vermin seen in facility; action needed",
    "Food from unapproved source or home canned", "Permit not shown. Post it", "A very long description of a thing that nobody would want to read in a small table because it goes on and on; then more", "",
)
DESCRIPTION_SQL = "CASE p_partkey % 16 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(DESCRIPTIONS)) + " END"
LABEL_SQL = "CASE WHEN coalesce(t, '') = '' THEN 'Violation details unavailable' " + " ".join(f"WHEN contains(lower(t), '{p}') THEN '{s}'" for p, s in FINDING_LABELS) + " WHEN length(c) <= 80 THEN c ELSE regexp_replace(substr(c, 1, 77), ' [^ ]*$', '') || '…' END"
ISSUE_SQL = "CASE WHEN coalesce(t, '') = '' THEN 'No critical issue available' " + " ".join("WHEN " + " OR ".join(f"contains(lower(t), '{p}')" for p in ps) + f" THEN '{s}'" for ps, s in ISSUE_LABELS) + " ELSE 'Serious food-safety issue recorded' END"


@query("", f"x AS (SELECT p_partkey AS key, {DESCRIPTION_SQL} AS t FROM part), y AS (SELECT *, trim(string_split(string_split(t, ';')[1], '.')[1]) AS c FROM x) SELECT key, {LABEL_SQL} AS label, {ISSUE_SQL} AS issue FROM y")
def label_rules(spark: SparkSession, d: str) -> DataFrame:
    """Short labels of findings' descriptions."""
    k = F.col("p_partkey") % 16
    text = F.when(k == 0, DESCRIPTIONS[0])
    for i, t in enumerate(DESCRIPTIONS[1:], 1):
        text = text.when(k == i, t)
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("key"), text.alias("t"))
    return rows.select("key", finding_label(F.col("t")).alias("label"), issue_label(F.col("t")).alias("issue"))


@query("", r"""x AS (SELECT item_id, list_filter(regexp_extract_all(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '[A-Z0-9]+'), lambda w: length(w) > 1 AND w NOT IN ('AT', 'IN', 'NY', 'NYC', 'ON')) AS l FROM benchmark)
SELECT item_id, array_to_string(l, ' ') AS terms, len(l) AS n FROM x""")
def search_words(spark: SparkSession, d: str) -> DataFrame:
    """Search terms of texts (ASCII upper-casing aside, letters outside A-Z separate words)."""
    t = table(spark, d, "benchmark").select("item_id", search_terms(F.col("text")).alias("l"))
    return t.select("item_id", F.array_join("l", " ").alias("terms"), F.size("l").cast("long").alias("n"))
