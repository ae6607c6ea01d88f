"""Models of the star schema: dimensions, facts, marts and feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import pearson, percent, ratio
from millrace.operators import grids, names
from millrace.operators.rows import top_per_key
from millrace.plans.roles import GRADES, TOTAL, areas, complaints, findings, inspections, query, restaurants, table

LATEST_SQL = """latest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY restaurant_key ORDER BY inspected DESC, inspection_id DESC) AS recency FROM inspections WHERE grade IN ('A', 'B', 'C')) WHERE recency = 1)"""


def latest_graded(spark: SparkSession, d: str) -> DataFrame:
    graded = inspections(spark, d).where(F.col("grade").isin(*GRADES))
    return top_per_key(graded, ["restaurant_key"], [F.desc("inspected"), F.desc("inspection_id")])


def axis(spark: SparkSession, name: str, values) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@query("areas restaurants inspections", LATEST_SQL + """, sized AS (SELECT area_key, count(*) AS total FROM restaurants WHERE area_key IS NOT NULL GROUP BY area_key),
graded AS (SELECT area_key, grade, count(*) AS n FROM latest JOIN restaurants USING (restaurant_key) WHERE area_key IS NOT NULL GROUP BY area_key, grade),
places AS (SELECT area_key, area_name FROM areas UNION ALL SELECT -1, 'TOTAL'),
s AS (SELECT * FROM sized UNION ALL SELECT -1, sum(total) FROM sized),
g AS (SELECT * FROM graded UNION ALL SELECT -1, grade, sum(n) FROM graded GROUP BY grade),
cells AS (SELECT p.area_key, p.area_name, k.grade, coalesce(s.total, 0) AS total, coalesce(g.n, 0) AS n FROM places p CROSS JOIN (VALUES ('A'), ('B'), ('C')) k(grade) LEFT JOIN s ON s.area_key = p.area_key LEFT JOIN g ON g.area_key = p.area_key AND g.grade = k.grade)
SELECT area_key, area_name, grade, CAST(total AS BIGINT) AS total_restaurants, CAST(sum(n) OVER (PARTITION BY area_key) AS BIGINT) AS graded_restaurants, CAST(n AS BIGINT) AS restaurant_count,
       round(100.0 * n / nullif(sum(n) OVER (PARTITION BY area_key), 0), 6)::DOUBLE AS grade_percent FROM cells""")
def area_grade_summary(spark: SparkSession, d: str) -> DataFrame:
    """Restaurants by area and latest grade on a dense grid, with a total over all areas."""
    own = restaurants(spark, d).select("restaurant_key", "area_key")
    total = grids.with_total(own, [], "area_key", TOTAL, {"total_restaurants": F.count(F.lit(1))})
    graded = grids.with_total(latest_graded(spark, d).join(own, "restaurant_key"), ["grade"], "area_key", TOTAL, {"restaurant_count": F.count(F.lit(1))})
    places = areas(spark, d).unionByName(spark.range(1).select(F.lit(TOTAL).cast("int").alias("area_key"), F.lit("TOTAL").alias("area_name")))
    cells = grids.dense([places, axis(spark, "grade", GRADES)], [], [], []).join(total, "area_key", "left").join(graded, ["area_key", "grade"], "left").fillna(0)
    all_graded = F.sum("restaurant_count").over(Window.partitionBy("area_key"))
    return cells.withColumn("graded_restaurants", all_graded).withColumn("grade_percent", F.round(percent(F.col("restaurant_count"), F.col("graded_restaurants")), 6)).select("area_key", "area_name", "grade", "total_restaurants", "graded_restaurants", "restaurant_count", "grade_percent")


@query("areas restaurants inspections", LATEST_SQL + """SELECT a.area_key, area_name, cuisine, count(*) AS total_restaurants, count(l.grade) AS graded_restaurants,
    round(100.0 * count(*) FILTER (l.grade = 'A') / nullif(count(l.grade), 0), 6)::DOUBLE AS grade_a_percent,
    round(100.0 * count(*) FILTER (l.grade = 'B') / nullif(count(l.grade), 0), 6)::DOUBLE AS grade_b_percent,
    round(100.0 * count(*) FILTER (l.grade = 'C') / nullif(count(l.grade), 0), 6)::DOUBLE AS grade_c_percent
FROM restaurants r JOIN areas a ON a.area_key = r.area_key LEFT JOIN latest l ON l.restaurant_key = r.restaurant_key GROUP BY ALL""")
def cuisine_area_heatmap(spark: SparkSession, d: str) -> DataFrame:
    """Shares of latest grades by cuisine and area."""
    joined = restaurants(spark, d).join(areas(spark, d), "area_key").join(latest_graded(spark, d).select("restaurant_key", "grade"), "restaurant_key", "left")
    shares = [F.round(percent(F.count_if(F.col("grade") == g), F.count("grade")), 6).alias(f"grade_{g.lower()}_percent") for g in GRADES]
    return joined.groupBy("area_key", "area_name", "cuisine").agg(F.count(F.lit(1)).alias("total_restaurants"), F.count("grade").alias("graded_restaurants"), *shares)


@query("areas restaurants inspections findings", """SELECT a.area_key, area_name, code, bool_or(critical) AS critical, count(*) AS finding_count, count(DISTINCT f.inspection_id) AS inspection_count, count(DISTINCT r.restaurant_key) AS restaurant_count,
    round(100.0 * count(*) / nullif(count(DISTINCT f.inspection_id), 0), 6)::DOUBLE AS findings_per_100
FROM findings f JOIN inspections USING (inspection_id) JOIN restaurants r USING (restaurant_key) JOIN areas a ON a.area_key = r.area_key GROUP BY a.area_key, area_name, code""")
def violation_by_area(spark: SparkSession, d: str) -> DataFrame:
    """Findings of each code in each area, with the inspections and restaurants that have them.

    Findings are first counted by inspection and code, which makes rows few and the distinct counts those of small keys."""
    each = findings(spark, d).groupBy("inspection_id", "code").agg(F.count(F.lit(1)).alias("n"), F.bool_or("critical").alias("critical"))
    placed = each.join(inspections(spark, d).select("inspection_id", "restaurant_key"), "inspection_id").join(restaurants(spark, d).select("restaurant_key", "area_key"), "restaurant_key")
    by_place = placed.groupBy("area_key", "code", "restaurant_key").agg(F.sum("n").alias("n"), F.bool_or("critical").alias("critical"), F.count(F.lit(1)).alias("inspections"))
    out = by_place.join(areas(spark, d), "area_key").groupBy("area_key", "area_name", "code").agg(F.bool_or("critical").alias("critical"), F.sum("n").alias("finding_count"), F.sum("inspections").alias("inspection_count"), F.count(F.lit(1)).alias("restaurant_count"))
    return out.withColumn("findings_per_100", F.round(percent(F.col("finding_count"), F.col("inspection_count")), 6))


WEEKLY_SQL = """opened AS (SELECT CAST(date_trunc('week', inspected) AS DATE) AS week, area_key, inspection_id FROM inspections JOIN restaurants USING (restaurant_key)),
seen AS (SELECT CAST(date_trunc('week', found) AS DATE) AS week, area_key, critical FROM findings JOIN inspections USING (inspection_id) JOIN restaurants USING (restaurant_key)),
weeks AS (SELECT DISTINCT week FROM (SELECT week FROM opened UNION ALL SELECT week FROM seen)),
places AS (SELECT area_key FROM areas UNION ALL SELECT -1),
o AS (SELECT week, area_key, count(*) AS n FROM opened WHERE area_key IS NOT NULL GROUP BY ALL UNION ALL SELECT week, -1, count(*) FROM opened GROUP BY week),
s AS (SELECT week, area_key, count(*) AS n, count(*) FILTER (critical) AS c FROM seen WHERE area_key IS NOT NULL GROUP BY ALL UNION ALL SELECT week, -1, count(*), count(*) FILTER (critical) FROM seen GROUP BY week),
grid AS (SELECT w.week, p.area_key, coalesce(o.n, 0) AS complaint_count, coalesce(s.n, 0) AS finding_count, coalesce(s.c, 0) AS critical_count
         FROM weeks w CROSS JOIN places p LEFT JOIN o ON o.week = w.week AND o.area_key = p.area_key LEFT JOIN s ON s.week = w.week AND s.area_key = p.area_key)"""


def weekly(spark: SparkSession, d: str) -> DataFrame:
    """week, area_key, complaint_count, finding_count, critical_count on a dense grid. The total counts rows without an area, too."""
    own = restaurants(spark, d).select("restaurant_key", "area_key")
    done = inspections(spark, d).select("inspection_id", "restaurant_key", "inspected").join(own, "restaurant_key")
    week = lambda c: F.trunc(c, "week")
    # counted by area (null too) first; the total is summed up from those few rows
    opened = done.groupBy(week("inspected").alias("week"), "area_key").agg(F.count(F.lit(1)).alias("complaint_count"))
    seen = findings(spark, d).join(done.select("inspection_id", "area_key"), "inspection_id").groupBy(week("found").alias("week"), "area_key").agg(F.count(F.lit(1)).alias("finding_count"), F.count_if("critical").alias("critical_count"))

    def and_total(df: DataFrame, *measures: str) -> DataFrame:
        total = df.groupBy("week").agg(*[F.sum(m).alias(m) for m in measures]).withColumn("area_key", F.lit(TOTAL))
        return df.where("area_key IS NOT NULL").unionByName(total)

    weeks = opened.select("week").unionByName(seen.select("week")).distinct()
    places = areas(spark, d).select("area_key").unionByName(spark.range(1).select(F.lit(TOTAL).cast("int").alias("area_key")))
    return grids.dense([weeks, places], [and_total(opened, "complaint_count"), and_total(seen, "finding_count", "critical_count")], ["week", "area_key"], ["complaint_count", "finding_count", "critical_count"])


@query("areas restaurants inspections findings", WEEKLY_SQL + """SELECT week, area_key, complaint_count, finding_count, critical_count, round(100.0 * critical_count / nullif(finding_count, 0), 6)::DOUBLE AS critical_percent,
    round(CASE WHEN stddev_pop(complaint_count) OVER w > 0 AND stddev_pop(critical_count) OVER w > 0 THEN corr(complaint_count, critical_count) OVER w END, 6) AS correlation FROM grid WINDOW w AS (PARTITION BY area_key)""")
def weekly_area_activity(spark: SparkSession, d: str) -> DataFrame:
    """The dense weekly grid with each area's correlation of complaints and critical findings."""
    w = Window.partitionBy("area_key")
    return weekly(spark, d).withColumns({"critical_percent": F.round(percent(F.col("critical_count"), F.col("finding_count")), 6), "correlation": F.round(pearson("complaint_count", "critical_count", w), 6)})


HISTORY_SQL = """history AS (SELECT inspection_id, restaurant_key, inspected, grade, score, lag(grade) OVER w AS previous_grade,
    row_number() OVER (PARTITION BY restaurant_key ORDER BY inspected DESC, inspection_id DESC) AS recency FROM inspections WHERE grade IN ('A', 'B', 'C') WINDOW w AS (PARTITION BY restaurant_key ORDER BY inspected, inspection_id))"""


def history(spark: SparkSession, d: str) -> DataFrame:
    """Graded inspections with the grade before, recency (1 is the latest) and improved_to_a."""
    graded = inspections(spark, d).where(F.col("grade").isin(*GRADES))
    w = Window.partitionBy("restaurant_key")
    up, down = w.orderBy("inspected", "inspection_id"), w.orderBy(F.desc("inspected"), F.desc("inspection_id"))
    return graded.withColumns({"previous_grade": F.lag("grade").over(up), "recency": F.row_number().over(down)}).withColumn("improved_to_a", (F.col("grade") == "A") & F.coalesce(F.col("previous_grade").isin("B", "C"), F.lit(False)))


@query("areas restaurants inspections", HISTORY_SQL + """, stats AS (SELECT restaurant_key, count(*) AS n, count(DISTINCT grade) AS kinds, min(inspected) AS first, max(inspected) AS last, bool_and(grade = 'A') AS always_a FROM history GROUP BY restaurant_key)
SELECT inspection_id, restaurant_key, restaurant_name, area_name, inspected, grade, score, previous_grade, CAST(recency AS INTEGER) AS recency, grade = 'A' AND coalesce(previous_grade IN ('B', 'C'), false) AS improved_to_a,
    n AS inspection_count, kinds AS grade_kinds, first AS first_inspected, last AS last_inspected, always_a, date_diff('day', inspected, DATE '2001-12-31') AS days_since
FROM history JOIN stats USING (restaurant_key) JOIN restaurants r USING (restaurant_key) LEFT JOIN areas a ON a.area_key = r.area_key""")
def grade_history(spark: SparkSession, d: str) -> DataFrame:
    """Each graded inspection with its restaurant's statistics; days_since counts to a given day."""
    h = history(spark, d)
    stats = h.groupBy("restaurant_key").agg(F.count(F.lit(1)).alias("inspection_count"), F.count_distinct("grade").alias("grade_kinds"), F.min("inspected").alias("first_inspected"), F.max("inspected").alias("last_inspected"), F.bool_and(F.col("grade") == "A").alias("always_a"))
    named = restaurants(spark, d).join(areas(spark, d), "area_key", "left").select("restaurant_key", "restaurant_name", "area_name")
    out = h.join(stats, "restaurant_key").join(named, "restaurant_key").withColumn("days_since", F.datediff(F.lit("2001-12-31").cast("date"), "inspected").cast("long"))
    return out.drop("action")


@query("inspections findings", """SELECT inspection_id, i.restaurant_key, max(score) AS score, max(grade) AS grade, count(code) AS findings, count(*) FILTER (critical) AS critical_findings, coalesce(bool_or(critical), false) AS has_critical
FROM inspections i LEFT JOIN findings f USING (inspection_id) GROUP BY inspection_id, i.restaurant_key""")
def event_rollup(spark: SparkSession, d: str) -> DataFrame:
    """One row per inspection with its findings."""
    f = findings(spark, d).groupBy("inspection_id").agg(F.count("code").alias("findings"), F.count_if("critical").alias("critical_findings"), F.bool_or("critical").alias("has_critical"))
    out = inspections(spark, d).select("inspection_id", "restaurant_key", "score", "grade").join(f, "inspection_id", "left")
    return out.fillna(0, ["findings", "critical_findings"]).fillna(False, ["has_critical"])


@query("inspections findings", """bounds AS (SELECT min(day) AS a, max(day) AS b FROM (SELECT inspected AS day FROM inspections UNION ALL SELECT found FROM findings)),
days AS (SELECT CAST(unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds)
SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, day, CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter, CAST(month(day) AS INTEGER) AS month, monthname(day) AS month_name, CAST(weekofyear(day) AS INTEGER) AS week,
    CAST(isodow(day) AS INTEGER) AS day_of_week, dayname(day) AS day_name, isodow(day) >= 6 AS is_weekend FROM days""")
def dim_date(spark: SparkSession, d: str) -> DataFrame:
    """Every day between the first and the last event of two facts."""
    bounds = inspections(spark, d).select(F.col("inspected").alias("day")).unionAll(findings(spark, d).select("found")).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("day"))
    return days.select(
        F.date_format("day", "yyyyMMdd").cast("int").alias("date_key"), "day", F.year("day").alias("year"), F.quarter("day").alias("quarter"), F.month("day").alias("month"), F.date_format("day", "MMMM").alias("month_name"), F.weekofyear("day").alias("week"),
        (F.weekday("day") + 1).alias("day_of_week"), F.date_format("day", "EEEE").alias("day_name"), (F.weekday("day") >= 5).alias("is_weekend"),
    )


@query("complaints", "SELECT upper(kind) AS complaint_type, sha256(upper(kind)) AS complaint_type_key, count(*) AS complaint_count FROM complaints GROUP BY ALL")
def dim_complaint_type(spark: SparkSession, d: str) -> DataFrame:
    return complaints(spark, d).groupBy(F.upper("kind").alias("complaint_type")).agg(F.count(F.lit(1)).alias("complaint_count")).withColumn("complaint_type_key", F.sha2("complaint_type", 256))


@query("findings", "SELECT code, sha256(code) AS finding_key, bool_or(critical) AS critical, max(weight) AS largest, count(*) AS finding_count FROM findings GROUP BY code")
def dim_finding(spark: SparkSession, d: str) -> DataFrame:
    return findings(spark, d).groupBy("code").agg(F.bool_or("critical").alias("critical"), F.max("weight").alias("largest"), F.count(F.lit(1)).alias("finding_count")).withColumn("finding_key", F.sha2("code", 256))


@query("areas restaurants", "SELECT a.area_key, area_name, count(restaurant_key) AS restaurant_count FROM areas a LEFT JOIN restaurants r ON r.area_key = a.area_key GROUP BY ALL")
def dim_area(spark: SparkSession, d: str) -> DataFrame:
    n = restaurants(spark, d).groupBy("area_key").agg(F.count(F.lit(1)).alias("restaurant_count"))
    return areas(spark, d).join(n, "area_key", "left").fillna(0, ["restaurant_count"])


@query("complaints restaurants", """SELECT complaint_id, sha256('c||' || complaint_id) AS complaint_key, c.restaurant_key, area_key, upper(kind) AS complaint_type, created, closed, closed IS NULL AS is_open, CAST(strftime(created, '%Y%m%d') AS INTEGER) AS date_key,
    date_diff('hour', created, closed) AS hours_open FROM complaints c LEFT JOIN restaurants r ON r.restaurant_key = c.restaurant_key""")
def fact_complaint(spark: SparkSession, d: str) -> DataFrame:
    """One row per complaint with its keys."""
    c = complaints(spark, d).join(restaurants(spark, d).select("restaurant_key", "area_key"), "restaurant_key", "left")
    return c.select(
        "complaint_id", F.sha2(F.concat_ws("||", F.lit("c"), F.col("complaint_id").cast("string")), 256).alias("complaint_key"), "restaurant_key", "area_key", F.upper("kind").alias("complaint_type"), "created", "closed", F.col("closed").isNull().alias("is_open"),
        F.date_format("created", "yyyyMMdd").cast("int").alias("date_key"), F.timestamp_diff("HOUR", F.col("created"), F.col("closed")).alias("hours_open"),
    )


@query("findings inspections restaurants", """SELECT sha256(inspection_id || '||' || line) AS finding_id, inspection_id, restaurant_key, area_key, sha256(code) AS finding_key, CAST(strftime(inspected, '%Y%m%d') AS INTEGER) AS date_key, critical
FROM findings JOIN inspections USING (inspection_id) JOIN restaurants USING (restaurant_key)""")
def fact_finding(spark: SparkSession, d: str) -> DataFrame:
    """One row per finding with its keys."""
    f = findings(spark, d).join(inspections(spark, d), "inspection_id").join(restaurants(spark, d), "restaurant_key")
    return f.select(F.sha2(F.concat_ws("||", F.col("inspection_id").cast("string"), F.col("line").cast("string")), 256).alias("finding_id"), "inspection_id", "restaurant_key", "area_key", F.sha2("code", 256).alias("finding_key"), F.date_format("inspected", "yyyyMMdd").cast("int").alias("date_key"), "critical")


def named_places(spark: SparkSession, d: str) -> DataFrame:
    """Parts as places with names; every fifth is a variant of its name."""
    k = F.col("p_partkey")
    name = F.upper("p_name")
    return table(spark, d, "part").select(k.alias("place_key"), F.when(k % 5 == 0, F.concat(name, F.lit(" UNIT "), k.cast("string"))).otherwise(name).alias("name"), F.col("p_type").alias("cuisine"), (k % 11 == 0).alias("is_co_brand"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))


PLACES_SQL = """places AS (SELECT p_partkey AS place_key, CASE WHEN p_partkey % 5 = 0 THEN upper(p_name) || ' UNIT ' || p_partkey ELSE upper(p_name) END AS name, p_type AS cuisine, p_partkey % 11 = 0 AS is_co_brand, p_brand AS brand, p_size AS size, p_retailprice AS price FROM part),
same AS (SELECT name, count(DISTINCT place_key) AS n FROM places GROUP BY name),
anchors AS (SELECT DISTINCT name AS anchor, cuisine FROM places JOIN same USING (name) WHERE n >= 3 AND length(name) >= 5),
variants AS (SELECT * FROM (SELECT p.place_key, anchor, row_number() OVER (PARTITION BY p.place_key ORDER BY length(anchor) DESC, anchor) AS k FROM places p JOIN anchors a ON a.cuisine = p.cuisine AND starts_with(p.name, a.anchor || ' ')
             WHERE NOT p.is_co_brand AND len(string_split(p.name, ' ')) <= len(string_split(a.anchor, ' ')) + 2) WHERE k = 1),
families AS (SELECT p.*, coalesce(v.anchor, p.name) AS family_name, CASE WHEN s.n >= 3 THEN 'EXACT_NAME' WHEN v.anchor IS NOT NULL THEN 'AUTO_PREFIX' ELSE 'UNMATCHED' END AS method FROM places p LEFT JOIN same s USING (name) LEFT JOIN variants v USING (place_key)),
sizes AS (SELECT family_name, count(DISTINCT place_key) AS location_count FROM families GROUP BY family_name),
chained AS (SELECT f.*, coalesce(location_count, 1) AS location_count, location_count >= 3 AS is_chain FROM families f LEFT JOIN sizes USING (family_name))"""


@query("", PLACES_SQL + """SELECT place_key, name, cuisine, family_name, location_count, is_chain, CASE WHEN is_chain THEN sha256(family_name) END AS chain_key, CASE WHEN is_chain THEN method ELSE 'UNMATCHED' END AS match_method,
    CASE WHEN is_chain AND method <> 'UNMATCHED' THEN 'HIGH' ELSE 'NONE' END AS match_confidence FROM chained""")
def chain_flags(spark: SparkSession, d: str) -> DataFrame:
    """Chains by exact names and by names that begin with a chain's."""
    return names.chains(named_places(spark, d)).select("place_key", "name", "cuisine", "family_name", "location_count", "is_chain", "chain_key", "match_method", "match_confidence")


@query("", PLACES_SQL + """SELECT family_name AS chain_name, count(*) AS locations, array_to_string(list_sort(list_distinct(list(cuisine))), '|') AS cuisines, array_to_string(list_sort(list_distinct(list(brand))), '|') AS brands, round(avg(size), 6) AS average_size,
    CASE min(CASE WHEN size <= 17 THEN 1 WHEN size <= 34 THEN 2 ELSE 3 END) WHEN 1 THEN 'A' WHEN 2 THEN 'B' ELSE 'C' END AS best_grade, CASE max(CASE WHEN size <= 17 THEN 1 WHEN size <= 34 THEN 2 ELSE 3 END) WHEN 1 THEN 'A' WHEN 2 THEN 'B' ELSE 'C' END AS worst_grade,
    round(100.0 * count(*) FILTER (size <= 17) / count(*), 6)::DOUBLE AS grade_a_percent FROM chained WHERE is_chain GROUP BY family_name""")
def chain_summary(spark: SparkSession, d: str) -> DataFrame:
    """A row per chain: its locations, sorted lists, best and worst grade."""
    code = F.when(F.col("size") <= 17, 1).when(F.col("size") <= 34, 2).otherwise(3)
    letter = lambda c: F.when(c == 1, "A").when(c == 2, "B").otherwise("C")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "|")
    chained = names.chains(named_places(spark, d)).where("is_chain")
    return chained.groupBy(F.col("chain_name")).agg(
        F.count(F.lit(1)).alias("locations"), joined("cuisine").alias("cuisines"), joined("brand").alias("brands"), F.round(F.avg("size"), 6).alias("average_size"), letter(F.min(code)).alias("best_grade"), letter(F.max(code)).alias("worst_grade"),
        F.round(percent(F.count_if(F.col("size") <= 17), F.count(F.lit(1))), 6).alias("grade_a_percent"),
    )


DAILY_SQL = """daily AS (SELECT restaurant_key, inspected, max(grade) AS grade, max(score) AS score, count(*) AS visits FROM inspections WHERE grade IN ('A', 'B', 'C') GROUP BY restaurant_key, inspected)"""


def daily(spark: SparkSession, d: str) -> DataFrame:
    """One graded row per restaurant and day."""
    graded = inspections(spark, d).where(F.col("grade").isin(*GRADES))
    return graded.groupBy("restaurant_key", "inspected").agg(F.max("grade").alias("grade"), F.max("score").alias("score"), F.count(F.lit(1)).alias("visits"))


@query("inspections", DAILY_SQL + """, t AS (SELECT restaurant_key, inspected, grade, lead(inspected) OVER w AS next_inspected, lead(grade) OVER w AS next_grade FROM daily WINDOW w AS (PARTITION BY restaurant_key ORDER BY inspected))
SELECT *, CAST(next_grade IN ('B', 'C') AS INTEGER) AS target, date_diff('day', inspected, next_inspected) AS days_ahead FROM t WHERE next_inspected IS NOT NULL""")
def next_event_label(spark: SparkSession, d: str) -> DataFrame:
    """Each graded day with the next one's grade as its label."""
    w = Window.partitionBy("restaurant_key").orderBy("inspected")
    t = daily(spark, d).select("restaurant_key", "inspected", "grade", F.lead("inspected").over(w).alias("next_inspected"), F.lead("grade").over(w).alias("next_grade")).where("next_inspected IS NOT NULL")
    return t.withColumns({"target": F.col("next_grade").isin("B", "C").cast("int"), "days_ahead": F.datediff("next_inspected", "inspected").cast("long")})


def history_frame(df: DataFrame) -> DataFrame:
    """Features of what is known on each graded day; every window ends at that day."""
    w = Window.partitionBy("restaurant_key").orderBy("inspected")
    three, ever = w.rowsBetween(-2, 0), w.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({
        "previous_grade": F.lag("grade").over(w), "previous_score": F.lag("score").over(w), "days_since_previous": F.datediff("inspected", F.lag("inspected").over(w)).cast("long"),
        "mean_score_3": F.round(F.avg("score").over(three), 4), "visits_3": F.sum("visits").over(three), "known_days": F.row_number().over(w),
        **{f"{g.lower()}_days": F.sum((F.col("grade") == g).cast("long")).over(ever) for g in GRADES}, "visits_ever": F.sum("visits").over(ever),
    })


FRAME_SQL = DAILY_SQL + """, framed AS (SELECT *, lag(grade) OVER w AS previous_grade, lag(score) OVER w AS previous_score, date_diff('day', lag(inspected) OVER w, inspected) AS days_since_previous,
    round(avg(score) OVER (w ROWS 2 PRECEDING), 4) AS mean_score_3, CAST(sum(visits) OVER (w ROWS 2 PRECEDING) AS BIGINT) AS visits_3, CAST(row_number() OVER w AS INTEGER) AS known_days,
    CAST(count(*) FILTER (grade = 'A') OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS a_days, CAST(count(*) FILTER (grade = 'B') OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS b_days, CAST(count(*) FILTER (grade = 'C') OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS c_days,
    CAST(sum(visits) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS visits_ever FROM daily WINDOW w AS (PARTITION BY restaurant_key ORDER BY inspected))"""


@query("inspections", FRAME_SQL + "SELECT * FROM framed")
def history_features(spark: SparkSession, d: str) -> DataFrame:
    return history_frame(daily(spark, d))


@query("inspections", FRAME_SQL + """SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY restaurant_key ORDER BY inspected DESC) AS k, date_diff('day', inspected, DATE '2001-12-31') AS days_known FROM framed) WHERE k = 1""")
def current_features(spark: SparkSession, d: str) -> DataFrame:
    """The latest feature row of each restaurant, for scoring on a given day."""
    last = top_per_key(history_frame(daily(spark, d)), ["restaurant_key"], [F.desc("inspected")])
    return last.withColumn("days_known", F.datediff(F.lit("2001-12-31").cast("date"), "inspected").cast("long"))


@query("complaints", """SELECT p.complaint_id, p.restaurant_key, count(e.complaint_id) AS errors_before, round(coalesce(sum(e.value), 0), 4)::DOUBLE AS value_before FROM complaints p
LEFT JOIN complaints e ON e.restaurant_key = p.restaurant_key AND e.kind = 'error' AND e.created < p.created AND e.created >= p.created - INTERVAL 2 DAY WHERE p.kind = 'purchase' GROUP BY p.complaint_id, p.restaurant_key""")
def lookback_counts(spark: SparkSession, d: str) -> DataFrame:
    """Errors of the same user in the two days before each purchase."""
    c = complaints(spark, d)
    left = c.where("kind = 'purchase'").select("complaint_id", "restaurant_key", "created")
    right = c.where("kind = 'error'").select("restaurant_key", F.col("created").alias("seen"), F.col("value").alias("seen_value"))
    n = grids.within_before(left, right, ["restaurant_key"], "created", "seen", 2).groupBy("complaint_id").agg(F.count(F.lit(1)).alias("errors_before"), F.sum("seen_value").alias("v"))
    return left.join(n, "complaint_id", "left").select("complaint_id", "restaurant_key", F.coalesce("errors_before", F.lit(0)).alias("errors_before"), F.round(F.coalesce("v", F.lit(0.0)), 4).alias("value_before"))


@query("inspections", """pairs AS (SELECT i.inspection_id, i.grade, count(e.inspection_id) AS before FROM inspections i LEFT JOIN inspections e ON e.restaurant_key = i.restaurant_key AND e.inspected < i.inspected AND e.inspected >= i.inspected - INTERVAL 90 DAY GROUP BY i.inspection_id, i.grade),
m AS (SELECT count(*) AS n, 100 * avg(CASE WHEN before > 0 THEN CAST(grade <> 'A' AS INTEGER) END) AS with_history, 100 * avg(CASE WHEN before = 0 THEN CAST(grade <> 'A' AS INTEGER) END) AS without_history, corr(before, CAST(grade <> 'A' AS INTEGER)) AS r FROM pairs)
SELECT n AS observations, round(with_history, 6) AS with_history, round(without_history, 6) AS without_history, round(with_history - without_history, 6) AS difference, round(CASE WHEN NOT isnan(r) THEN r END, 6) AS correlation FROM m""")
def lookback_outcome(spark: SparkSession, d: str) -> DataFrame:
    """Whether inspections with others in the 90 days before end in worse grades."""
    i = inspections(spark, d).select("inspection_id", "restaurant_key", "inspected", "grade")
    n = grids.within_before(i, i.select("restaurant_key", F.col("inspected").alias("seen")), ["restaurant_key"], "inspected", "seen", 90).groupBy("inspection_id").agg(F.count(F.lit(1)).alias("before"))
    rows = i.join(n, "inspection_id", "left").fillna(0, ["before"]).withColumn("bad", (F.col("grade") != "A").cast("double"))
    m = rows.agg(F.count(F.lit(1)).alias("observations"), (100 * F.avg(F.when(F.col("before") > 0, F.col("bad")))).alias("w"), (100 * F.avg(F.when(F.col("before") == 0, F.col("bad")))).alias("o"), pearson("before", "bad").alias("r"))
    return m.select("observations", F.round("w", 6).alias("with_history"), F.round("o", 6).alias("without_history"), F.round(F.col("w") - F.col("o"), 6).alias("difference"), F.round("r", 6).alias("correlation"))


def improvement_rate(h: DataFrame) -> DataFrame:
    """area_key, improvement_rate: of inspections after a B or C, those that reached an A."""
    return h.groupBy("area_key").agg(ratio(F.count_if("improved_to_a"), F.count_if(F.col("previous_grade").isin("B", "C")), 100.0).alias("improvement_rate"))


SCORES_SQL = DAILY_SQL + """, led AS (SELECT restaurant_key, inspected, grade, lead(grade) OVER w AS next_grade, row_number() OVER (PARTITION BY restaurant_key ORDER BY inspected DESC) AS k FROM daily WINDOW w AS (PARTITION BY restaurant_key ORDER BY inspected)),
rates AS (SELECT grade, cuisine, count(*) AS n, count(*) FILTER (next_grade IN ('B', 'C')) AS bad FROM led JOIN restaurants USING (restaurant_key) WHERE next_grade IS NOT NULL GROUP BY ALL),
scores AS (SELECT restaurant_key, restaurant_name, restaurants.cuisine, area_key, round((coalesce(bad, 0) + 1) / (coalesce(n, 0) + 2), 6)::DOUBLE AS risk FROM led JOIN restaurants USING (restaurant_key) LEFT JOIN rates ON rates.grade = led.grade AND rates.cuisine IS NOT DISTINCT FROM restaurants.cuisine WHERE k = 1)"""


def rate_scores(spark: SparkSession, d: str) -> DataFrame:
    """restaurant_key, risk of every graded restaurant: how often a B or C has followed its latest grade among restaurants of its cuisine, all their graded days counted, one of each outcome more."""
    w = Window.partitionBy("restaurant_key").orderBy("inspected")
    mine = restaurants(spark, d).select("restaurant_key", "cuisine")
    led = daily(spark, d).select("restaurant_key", "inspected", "grade", F.lead("grade").over(w).alias("next_grade")).join(mine, "restaurant_key")
    rates = led.where("next_grade IS NOT NULL").groupBy("grade", "cuisine").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("next_grade").isin("B", "C")).alias("bad")).select(F.col("grade").alias("__g"), F.col("cuisine").alias("__c"), "n", "bad")
    now = led.where("next_grade IS NULL")  # a restaurant's last graded day has no next one
    none = F.lit(0)
    scored = now.join(rates, (F.col("grade") == F.col("__g")) & F.col("cuisine").eqNullSafe(F.col("__c")), "left")
    return scored.select("restaurant_key", F.round((F.coalesce("bad", none) + 1) / (F.coalesce("n", none) + 2), 6).alias("risk"))


def restaurant_chains(spark: SparkSession, d: str) -> DataFrame:
    """restaurant_key of restaurants that belong to a chain: the place of the same number does."""
    return names.chains(named_places(spark, d)).where("is_chain").select(F.col("place_key").alias("restaurant_key"))
