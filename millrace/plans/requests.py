"""Requests of the serving layer with arguments.

Every argument is checked before anything runs: numbers against bounds, names against lists or against the table that
holds them, keys against their form. Values go into column expressions, never into SQL text. Sorts are chosen from
lists and end with the key, nulls last whichever way they go, so pages don't overlap.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import EARTH_ROUND, fisher_bound, pearson, percent, strength
from millrace.functions.numbers import direction as sign_of
from millrace.functions.text import has_terms, search_terms
from millrace.operators import grids, metrics, names, paging
from millrace.operators.nearest import nearby
from millrace.operators.rows import top_per_key
from millrace.plans.models import HISTORY_SQL, LATEST_SQL, PLACES_SQL, SCORES_SQL, WEEKLY_SQL, history, latest_graded, named_places, rate_scores, restaurant_chains, weekly
from millrace.plans.reads import area_scorecard
from millrace.plans.roles import ORACLES, QUERIES, TOTAL, areas, complaints, findings, inspections, oracle, query, restaurants
from millrace.plans.streams import folder

#: Weeks and lags that correlations may be asked for.
WEEKS, LAGS = (8, 12, 26, 52, 104), (0, 1, 2, 4, 8)
#: The key of no area.
NOWHERE = -2
#: Rows before a page up to which one task sorts them away.
DEEP = 10_000
FLAGS = ("improved", "repeat_critical", "graded", "ungraded")


def one_of(name: str, value, allowed: Collection):
    if value not in allowed:
        raise ValueError(f"{name} is one of {sorted(allowed)}")
    return value


def between(name: str, value: int, least: int, most: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or not least <= value <= most:
        raise ValueError(f"{name} is a whole number from {least} to {most}")
    return value


def digest_key(value: str) -> str:
    """A key in hex, as it is stored; anything else is an error."""
    if not re.fullmatch(r"[0-9A-Fa-f]{64}", value):
        raise ValueError("a key has 64 hex digits")
    return value.lower()


def area_of(spark: SparkSession, d: str, name: str | None) -> int | None:
    """The key of an area by its name in any case; None for all areas. The list of areas is short; while it is empty nothing is in any."""
    if name is None:
        return None
    known = {r["area_name"]: r["area_key"] for r in areas(spark, d).collect()}
    if not known:
        return NOWHERE
    return known[one_of("area", name.strip().upper(), known)]


def kind_of(name: str | None, known: Collection[str]) -> str | None:
    """A kind of complaint: underscores are blanks, case doesn't matter, and an unknown one stands for all."""
    wanted = (name or "").replace("_", " ").strip().upper()
    return next((k for k in known if k.replace("_", " ").upper() == wanted), None)


def in_area(df: DataFrame, key: int | None) -> DataFrame:
    return df if key is None else df.where(F.col("area_key") == key)


def ordered(sorts: Mapping[str, Column], sort: str, down: bool, *ties: Column) -> list[Column]:
    column = sorts[one_of("sort", sort, sorts)]
    return [column.desc_nulls_last() if down else column.asc_nulls_last(), *ties]


def paged(hits: DataFrame, order: list[Column], page: int, size: int) -> DataFrame:
    """One page, with the number of all hits. Up to DEEP rows the page is the end of a top-k; a deeper one is found by numbers
    that ranges of the order give, so no task holds what comes before it."""
    at = (between("page", page, 1, 10**6) - 1) * between("size", size, 1, 100)
    total = F.broadcast(hits.agg(F.count(F.lit(1)).alias("total")))
    if at < DEEP:
        return hits.orderBy(*order).offset(at).limit(size).crossJoin(total)
    path = folder(hits.sparkSession, "deep")
    paging.number_sorted(hits, order, path)
    return paging.page(hits.sparkSession, path, page, size).drop("row_number").crossJoin(total)


def asked(name: str, roles: str, sql: str):
    """Registers a request with its arguments filled in, under a name of its own."""

    def register(f):
        f.__name__ = name
        QUERIES[name], ORACLES[name] = f, oracle(roles, sql)
        return f

    return register


def cuisines(spark: SparkSession, d: str, area: str | None = None, sort: str = "grade_a", limit: int = 15, least: int = 10) -> DataFrame:
    """Cuisines with enough graded restaurants in an area."""
    between("limit", limit, 1, 20)
    mine = in_area(restaurants(spark, d), area_of(spark, d, area)).select("restaurant_key", "cuisine")
    g = latest_graded(spark, d).select("restaurant_key", "grade").join(mine, "restaurant_key").groupBy("cuisine").agg(F.count(F.lit(1)).alias("restaurants"), F.round(percent(F.count_if(F.col("grade") == "A"), F.count(F.lit(1))), 6).alias("grade_a_percent"))
    sorts = {"grade_a": F.col("grade_a_percent"), "restaurants": F.col("restaurants"), "attention": -F.col("grade_a_percent")}
    return g.where(F.col("restaurants") >= between("least", least, 1, 10_000)).orderBy(*ordered(sorts, sort, True, F.asc("cuisine"))).limit(limit)


def _cuisines_sql(where: str, order: str, limit: int, least: int) -> str:
    return LATEST_SQL + f"SELECT cuisine, count(*) AS restaurants, round(100.0 * count(*) FILTER (grade = 'A') / count(*), 6)::DOUBLE AS grade_a_percent FROM latest JOIN restaurants USING (restaurant_key) LEFT JOIN areas USING (area_key) WHERE {where} GROUP BY cuisine HAVING count(*) >= {least} ORDER BY {order}, cuisine LIMIT {limit}"


asked("cuisines_in_asia", "areas restaurants inspections", _cuisines_sql("area_name = 'ASIA'", "restaurants DESC", 3, 5))(lambda spark, d: cuisines(spark, d, "asia", "restaurants", 3, 5))
asked("cuisines_by_attention", "areas restaurants inspections", _cuisines_sql("true", "grade_a_percent", 20, 1))(lambda spark, d: cuisines(spark, d, None, "attention", 20, 1))


def violations(spark: SparkSession, d: str, area: str | None = None, critical: str = "all", sort: str = "count", limit: int = 15) -> DataFrame:
    """Codes by frequency in an area, all findings or those of one criticality."""
    between("limit", limit, 1, 100)
    mine = in_area(restaurants(spark, d), area_of(spark, d, area)).select("restaurant_key")
    rows = findings(spark, d)
    if one_of("critical", critical, ("all", "critical", "other")) != "all":
        rows = rows.where(F.col("critical") == (critical == "critical"))
    own = inspections(spark, d).select("inspection_id", "restaurant_key").join(mine, "restaurant_key")
    each = rows.groupBy("inspection_id", "code").agg(F.count(F.lit(1)).alias("n")).join(own, "inspection_id").groupBy("code", "restaurant_key").agg(F.sum("n").alias("n"))
    out = each.groupBy("code").agg(F.sum("n").alias("finding_count"), F.count(F.lit(1)).alias("restaurants"))
    total = F.broadcast(mine.agg(F.count(F.lit(1)).alias("all")))
    rated = out.crossJoin(total).select("code", "finding_count", "restaurants", F.round(percent(F.col("finding_count"), F.col("all")), 6).alias("per_100_restaurants"))
    return rated.orderBy(*ordered({"count": F.col("finding_count"), "restaurants": F.col("restaurants")}, sort, True, F.asc("code"))).limit(limit)


def _violations_sql(area: str, critical: str, order: str, limit: int) -> str:
    return f"""mine AS (SELECT restaurant_key FROM restaurants LEFT JOIN areas USING (area_key) WHERE {area})
    SELECT code, count(*) AS finding_count, count(DISTINCT restaurant_key) AS restaurants, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM mine), 6) AS per_100_restaurants
    FROM findings JOIN inspections USING (inspection_id) JOIN mine USING (restaurant_key) WHERE {critical} GROUP BY code ORDER BY {order} DESC, code LIMIT {limit}"""


asked("violations_in_europe", "areas restaurants inspections findings", _violations_sql("area_name = 'EUROPE'", "critical", "finding_count", 5))(lambda spark, d: violations(spark, d, "Europe", "critical", "count", 5))
asked("violations_by_reach", "areas restaurants inspections findings", _violations_sql("true", "true", "restaurants", 2))(lambda spark, d: violations(spark, d, None, "all", "restaurants", 2))

BOARD = {"safety": ("grade_a_percent", True), "name": ("area_name", False), "graded": ("graded", True), "critical": ("critical_rate", False), "improvement": ("improvement_rate", True)}


def area_board(spark: SparkSession, d: str, sort: str = "safety") -> DataFrame:
    """The areas' scorecard in a requested order; safety_rank is the place in that order."""
    column, down = BOARD[one_of("sort", sort, BOARD)]
    order = ordered({sort: F.col(column)}, sort, down, F.asc("area_name"))
    return area_scorecard(spark, d).withColumn("safety_rank", F.row_number().over(Window.orderBy(*order)))  # a row per area


def _board_sql(order: str) -> str:
    inner = ORACLES["area_scorecard"]
    return f"s AS ({inner}) SELECT * EXCLUDE (safety_rank), CAST(row_number() OVER (ORDER BY {order} NULLS LAST, area_name) AS INTEGER) AS safety_rank FROM s"


asked("area_board_by_critical", "", _board_sql("critical_rate"))(lambda spark, d: area_board(spark, d, "critical"))
asked("area_board_by_improvement", "", _board_sql("improvement_rate DESC"))(lambda spark, d: area_board(spark, d, "improvement"))


def weekly_series(spark: SparkSession, d: str, area: str | None = None, weeks: int = 12) -> DataFrame:
    """The last weeks of an area, or of all of them."""
    key = area_of(spark, d, area)
    rows = weekly(spark, d).where(F.col("area_key") == (TOTAL if key is None else key))
    return top_per_key(rows, ["area_key"], [F.desc("week")], one_of("weeks", weeks, WEEKS)).select("week", "complaint_count", "finding_count", "critical_count")


asked("weekly_series_in_africa", "areas restaurants inspections findings", WEEKLY_SQL + "SELECT week, complaint_count, finding_count, critical_count FROM (SELECT *, row_number() OVER (ORDER BY week DESC) AS k FROM grid JOIN areas USING (area_key) WHERE area_name = 'AFRICA') WHERE k <= 26")(lambda spark, d: weekly_series(spark, d, "africa", 26))


def correlations(spark: SparkSession, d: str, weeks: int = 12, lag: int = 2, area: str | None = None) -> DataFrame:
    """Per area, the total among them: complaints against critical findings `lag` weeks later over `weeks` pairs, strongest first."""
    one_of("weeks", weeks, WEEKS)
    one_of("lag", lag, LAGS)
    key = area_of(spark, d, area)
    recent = top_per_key(in_area(weekly(spark, d), key), ["area_key"], [F.desc("week")], weeks + lag)
    later = "critical_count"
    if lag:
        recent, later = grids.lagged(recent, "area_key", "week", "critical_count", lag), "later_critical_count"
    m = recent.groupBy("area_key").agg(F.count(F.lit(1)).alias("n"), F.sum("complaint_count").alias("complaints"), F.sum(later).alias("failures"), pearson("complaint_count", later).alias("r"))
    r, n = F.col("r"), F.col("n")
    out = m.select("area_key", n.alias("observations"), "complaints", "failures", F.round(r, 6).alias("coefficient"), fisher_bound(r, n, -1).alias("low"), fisher_bound(r, n, 1).alias("high"), strength(r).alias("strength"), sign_of(r).alias("direction"))
    return out.orderBy(F.desc_nulls_last("coefficient"), "area_key")


def _correlations_sql(weeks: int, lag: int, where: str) -> str:
    bound = "round(tanh(atanh(CASE WHEN n > 3 AND abs(r) < 1 THEN r END) {} 1.96 / sqrt(greatest(n - 3, 1))), 6)"
    return WEEKLY_SQL + f""", recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY area_key ORDER BY week DESC) AS k FROM grid) WHERE k <= {weeks + lag}),
    paired AS (SELECT * FROM (SELECT *, lead(critical_count, {lag}) OVER (PARTITION BY area_key ORDER BY week) AS later FROM recent) WHERE later IS NOT NULL),
    m AS (SELECT area_key, count(*) AS n, CAST(sum(complaint_count) AS BIGINT) AS complaints, CAST(sum(later) AS BIGINT) AS failures, CASE WHEN count(*) >= 3 AND stddev_pop(complaint_count) > 0 AND stddev_pop(later) > 0 THEN corr(complaint_count, later) END AS r FROM paired GROUP BY area_key)
    SELECT area_key, n AS observations, complaints, failures, round(r, 6) AS coefficient, {bound.format('-')} AS low, {bound.format('+')} AS high,
    CASE WHEN r IS NULL THEN 'not calculable' WHEN abs(r) < 0.3 THEN 'weak' WHEN abs(r) < 0.6 THEN 'moderate' ELSE 'strong' END AS strength, CASE WHEN r IS NULL THEN 'not_calculable' WHEN r > 0 THEN 'positive' WHEN r < 0 THEN 'negative' ELSE 'none' END AS direction FROM m WHERE {where}"""


asked("correlations_26_weeks_lag_4", "areas restaurants inspections findings", _correlations_sql(26, 4, "true"))(lambda spark, d: correlations(spark, d, 26, 4))
asked("correlation_in_america", "areas restaurants inspections findings", _correlations_sql(104, 0, "area_key = (SELECT area_key FROM areas WHERE area_name = 'AMERICA')"))(lambda spark, d: correlations(spark, d, 104, 0, "america"))


def complaints_by_kind(spark: SparkSession, d: str, kind: str | None = None) -> DataFrame:
    """Complaints and open ones by day, of one kind, or of all where the kind is unknown."""
    rows = complaints(spark, d)
    wanted = kind_of(kind, [r["kind"] for r in rows.select("kind").distinct().collect()])  # a short list of kinds
    rows = rows if wanted is None else rows.where(F.col("kind") == wanted)
    return rows.groupBy(F.to_date("created").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("closed").isNull()).alias("open"))


asked("complaints_of_errors", "complaints", "SELECT CAST(created AS DATE) AS day, count(*) AS n, count(*) FILTER (closed IS NULL) AS open FROM complaints WHERE kind = 'error' GROUP BY ALL")(lambda spark, d: complaints_by_kind(spark, d, "ERROR"))
asked("complaints_of_no_known_kind", "complaints", "SELECT CAST(created AS DATE) AS day, count(*) AS n, count(*) FILTER (closed IS NULL) AS open FROM complaints GROUP BY ALL")(lambda spark, d: complaints_by_kind(spark, d, "no_such kind"))


def search(spark: SparkSession, d: str, text: str = "", area: str | None = None, cuisine: str | None = None, grade: str | None = None, flag: str | None = None, sort: str = "name", down: bool = False, page: int = 1, size: int = 25) -> DataFrame:
    """Restaurants by words, area, cuisine, latest grade and a flag, sorted, a page of them with the number of all. Restaurants of chains are neither improved nor repeat_critical."""
    rows = in_area(restaurants(spark, d), area_of(spark, d, area)).join(F.broadcast(areas(spark, d)), "area_key", "left")
    last = history(spark, d).where("recency = 1").select("restaurant_key", "grade", "score", "inspected", "improved_to_a")
    rows = rows.join(last, "restaurant_key", "left")
    words = spark.range(1).select(search_terms(F.lit(text)).alias("t")).first()[0] if text else []
    if words:
        rows = rows.where(has_terms([F.col("restaurant_name"), F.col("area_name"), F.col("cuisine")], words))
    if cuisine is not None:
        rows = rows.where(F.upper("cuisine") == cuisine.strip().upper())
    if grade is not None:
        rows = rows.where(F.col("grade") == one_of("grade", grade, ("A", "B", "C")))
    again = findings(spark, d).where("critical").select("inspection_id", "code").distinct().join(inspections(spark, d).select("inspection_id", "restaurant_key"), "inspection_id").groupBy("restaurant_key", "code").count().where("count >= 2").select("restaurant_key").distinct()
    if flag is not None:
        one_of("flag", flag, FLAGS)
        if flag in ("improved", "repeat_critical"):
            rows = rows.join(restaurant_chains(spark, d), "restaurant_key", "left_anti")
        rows = rows.join(again, "restaurant_key", "left_semi") if flag == "repeat_critical" else rows.where({"improved": F.col("improved_to_a"), "graded": F.col("grade").isNotNull(), "ungraded": F.col("grade").isNull()}[flag])
    hits = rows.select("restaurant_key", "restaurant_name", "cuisine", "area_name", "grade", "score", "inspected")
    sorts = {"name": F.col("restaurant_name"), "score": F.col("score"), "grade": F.col("grade"), "inspected": F.col("inspected"), "cuisine": F.col("cuisine")}
    return paged(hits, ordered(sorts, sort, down, F.asc("restaurant_key")), page, size)


def _search_sql(where: str, order: str, page: int, size: int) -> str:
    return HISTORY_SQL + ", " + PLACES_SQL + f""", again AS (SELECT DISTINCT restaurant_key FROM (SELECT restaurant_key, code FROM findings JOIN inspections USING (inspection_id) WHERE critical GROUP BY ALL HAVING count(DISTINCT inspection_id) >= 2)),
    hits AS (SELECT restaurant_key, restaurant_name, cuisine, area_name, grade, score, inspected FROM restaurants LEFT JOIN areas USING (area_key) LEFT JOIN (SELECT * FROM history WHERE recency = 1) USING (restaurant_key) WHERE {where})
    SELECT *, (SELECT count(*) FROM hits) AS total FROM hits ORDER BY {order}, restaurant_key LIMIT {size} OFFSET {(page - 1) * size}"""


SEARCHED = "areas restaurants inspections findings"
asked("search_improved_in_asia", SEARCHED, _search_sql("area_name = 'ASIA' AND grade = 'A' AND previous_grade IN ('B', 'C') AND restaurant_key NOT IN (SELECT place_key FROM chained WHERE is_chain)", "inspected DESC NULLS LAST", 1, 20))(lambda spark, d: search(spark, d, area="Asia", flag="improved", sort="inspected", down=True, size=20))
asked("search_repeats_second_page", SEARCHED, _search_sql("cuisine = 'BUILDING' AND restaurant_key IN (SELECT restaurant_key FROM again) AND restaurant_key NOT IN (SELECT place_key FROM chained WHERE is_chain)", "score NULLS LAST", 2, 10))(lambda spark, d: search(spark, d, cuisine="building", flag="repeat_critical", sort="score", page=2, size=10))
asked("search_words_and_grade", SEARCHED, _search_sql("grade = 'B' AND contains(upper(restaurant_name), 'CUSTOMER') AND area_name = 'EUROPE'", "restaurant_name DESC NULLS LAST", 1, 5))(lambda spark, d: search(spark, d, "customer at europe", grade="B", sort="name", down=True, size=5))
asked("search_graded", SEARCHED, _search_sql("grade IS NOT NULL", "cuisine NULLS LAST", 3, 50))(lambda spark, d: search(spark, d, flag="graded", sort="cuisine", page=3, size=50))


def around(spark: SparkSession, d: str, key: int, radius: int = 1000, same_cuisine: bool = False, limit: int = 10, independent_only: bool = False) -> DataFrame:
    """The nearest restaurants with a latest grade A around one, of its cuisine, and of no chain, if asked for."""
    between("radius", radius, 100, 5000)
    between("limit", limit, 1, 50)
    every = restaurants(spark, d)
    centre = every.where(F.col("restaurant_key") == key).select("lat", "lon", "cuisine").first()
    if centre is None:
        return every.limit(0).select("restaurant_key", "restaurant_name", F.lit(0.0).alias("distance"))
    others = every.where(F.col("restaurant_key") != key)
    others = others.where(F.col("cuisine") == centre["cuisine"]) if same_cuisine else others
    others = others.join(restaurant_chains(spark, d), "restaurant_key", "left_anti") if independent_only else others
    near = nearby(others, centre["lat"], centre["lon"], float(radius), EARTH_ROUND).join(latest_graded(spark, d).where("grade = 'A'").select("restaurant_key"), "restaurant_key", "left_semi")
    return near.orderBy("distance", "restaurant_key").limit(limit).select("restaurant_key", "restaurant_name", F.round("distance", 3).alias("distance"))


def _around_sql(key: int, radius: int, more: str, limit: int) -> str:
    return LATEST_SQL + f""", o AS (SELECT lat, lon, cuisine AS own FROM restaurants WHERE restaurant_key = {key}),
    n AS (SELECT c.restaurant_key, c.restaurant_name, c.cuisine, own, 2 * 6371000.0::DOUBLE * asin(least(1, sqrt(pow(sin(radians(c.lat - o.lat) / 2), 2) + cos(radians(o.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lon - o.lon) / 2), 2)))) AS distance FROM restaurants c, o WHERE c.restaurant_key <> {key})
    SELECT n.restaurant_key, restaurant_name, round(distance, 3) AS distance FROM n JOIN latest USING (restaurant_key) WHERE distance <= {radius} AND grade = 'A' AND {more} ORDER BY n.distance, n.restaurant_key LIMIT {limit}"""


asked("around_in_two_km", "restaurants inspections", _around_sql(12, 2000, "true", 50))(lambda spark, d: around(spark, d, 12, 2000, False, 50))
asked("around_independent", "restaurants inspections", PLACES_SQL + ", " + _around_sql(5, 3000, "n.restaurant_key NOT IN (SELECT place_key FROM chained WHERE is_chain)", 20))(lambda spark, d: around(spark, d, 5, 3000, False, 20, True))
asked("around_of_same_cuisine", "restaurants inspections", _around_sql(3, 5000, "n.cuisine = own", 5))(lambda spark, d: around(spark, d, 3, 5000, True, 5))


def history_of(spark: SparkSession, d: str, key: str) -> DataFrame:
    """The graded inspections of the restaurant whose key has this SHA-256, newest first."""
    one = restaurants(spark, d).where(F.sha2(F.col("restaurant_key").cast("string").cast("binary"), 256) == digest_key(key)).select("restaurant_key")
    return history(spark, d).join(F.broadcast(one), "restaurant_key").orderBy(F.desc("inspected"), F.desc("inspection_id")).select("inspection_id", "inspected", "grade", "score", "previous_grade")


KEY_11 = "4fc82b26aecb47d2868c4efbe3581732a3e7cbcc6c2efb32062c08170a05eeb8"
asked("history_of_key", "restaurants inspections", HISTORY_SQL + f"SELECT inspection_id, inspected, grade, score, previous_grade FROM history WHERE sha256(CAST(restaurant_key AS VARCHAR)) = '{KEY_11}'")(lambda spark, d: history_of(spark, d, KEY_11.upper()))


def improved(spark: SparkSession, d: str, day: str, days: int = 90, limit: int = 10, area: str | None = None) -> DataFrame:
    """Restaurants of an area, or of all, whose latest grade is an A behind a B or C, reached in the days before a day."""
    since = F.date_sub(F.lit(day).cast("date"), between("days", days, 1, 365))
    h = history(spark, d).where((F.col("recency") == 1) & F.col("improved_to_a") & (F.col("inspected") >= since) & (F.col("inspected") <= F.lit(day).cast("date")))
    return h.join(in_area(restaurants(spark, d), area_of(spark, d, area)).select("restaurant_key", "restaurant_name"), "restaurant_key").orderBy(F.desc("inspected"), "restaurant_key").limit(between("limit", limit, 1, 50)).select("restaurant_key", "restaurant_name", "inspected", "previous_grade", "score")


asked("improved_in_thirty_days", "restaurants inspections", HISTORY_SQL + "SELECT restaurant_key, restaurant_name, inspected, previous_grade, score FROM history JOIN restaurants USING (restaurant_key) WHERE recency = 1 AND grade = 'A' AND previous_grade IN ('B', 'C') AND inspected BETWEEN DATE '2001-06-30' - 30 AND DATE '2001-06-30' ORDER BY inspected DESC, restaurant_key LIMIT 5")(lambda spark, d: improved(spark, d, "2001-06-30", 30, 5))

asked("improved_in_europe", "areas restaurants inspections", HISTORY_SQL + "SELECT restaurant_key, restaurant_name, inspected, previous_grade, score FROM history JOIN restaurants USING (restaurant_key) JOIN areas USING (area_key) WHERE recency = 1 AND grade = 'A' AND previous_grade IN ('B', 'C') AND inspected BETWEEN DATE '2001-06-30' - 90 AND DATE '2001-06-30' AND area_name = 'EUROPE' ORDER BY inspected DESC, restaurant_key LIMIT 50")(lambda spark, d: improved(spark, d, "2001-06-30", 90, 50, "europe"))


def chains(spark: SparkSession, d: str, text: str = "", brand: str | None = None, sort: str = "locations", down: bool = True, page: int = 1, size: int = 20, area: str | None = None, confirmed: Collection[str] | None = None) -> DataFrame:
    """Chains by words, by a brand among theirs, by an area in which they have a place (where all their figures are of that area's
    places) and by a reviewed list of brands, of which they must have one; sorted, a missing figure as the least one."""
    places = names.chains(named_places(spark, d)).where("is_chain")
    if area is not None:
        inside = in_area(restaurants(spark, d), area_of(spark, d, area)).select(F.col("restaurant_key").alias("place_key"))
        places = places.join(inside, "place_key", "left_semi")
    c = places.groupBy("chain_name").agg(F.count(F.lit(1)).alias("locations"), F.round(F.avg("size"), 6).alias("average_size"), F.array_sort(F.collect_set("brand")).alias("brands"), F.count_distinct("cuisine").alias("cuisines"))
    words = spark.range(1).select(search_terms(F.lit(text)).alias("t")).first()[0] if text else []
    c = c.where(has_terms([F.col("chain_name")], words)) if words else c
    c = c.where(F.array_contains("brands", brand)) if brand is not None else c
    c = c.where(F.arrays_overlap("brands", F.array(*map(F.lit, sorted(confirmed))))) if confirmed is not None else c
    sorts = {"locations": F.coalesce("locations", F.lit(0)), "average_size": F.coalesce("average_size", F.lit(-1.0)), "name": F.col("chain_name"), "cuisines": F.col("cuisines")}
    return paged(c.withColumn("brands", F.array_join("brands", "|")), ordered(sorts, sort, down, F.asc("chain_name")), page, size)


def _chains_sql(where: str, order: str, page: int, size: int, inside: str = "true") -> str:
    return PLACES_SQL + f""", c AS (SELECT family_name AS chain_name, count(*) AS locations, round(avg(size), 6) AS average_size, list_sort(list_distinct(list(brand))) AS b, count(DISTINCT cuisine) AS cuisines FROM chained WHERE is_chain AND {inside} GROUP BY family_name),
    hits AS (SELECT chain_name, locations, average_size, array_to_string(b, '|') AS brands, cuisines FROM c WHERE {where}) SELECT *, (SELECT count(*) FROM hits) AS total FROM hits ORDER BY {order}, chain_name LIMIT {size} OFFSET {(page - 1) * size}"""


asked("chains_of_a_brand", "", _chains_sql("list_contains(b, 'Brand#13')", "average_size DESC", 1, 10))(lambda spark, d: chains(spark, d, brand="Brand#13", sort="average_size", size=10))
asked("chains_confirmed_in_asia", "areas restaurants", _chains_sql("list_has_any(b, ['Brand#11', 'Brand#25', 'Brand#31'])", "locations DESC", 1, 15, "place_key IN (SELECT restaurant_key FROM restaurants JOIN areas USING (area_key) WHERE area_name = 'ASIA')"))(lambda spark, d: chains(spark, d, size=15, area="Asia", confirmed={"Brand#25", "Brand#31", "Brand#11"}))
asked("chains_by_name", "", _chains_sql("true", "cuisines", 2, 7))(lambda spark, d: chains(spark, d, sort="cuisines", down=False, page=2, size=7))


#: Risks from which a restaurant counts as MODERATE and as HIGH.
TIERS = (0.65, 0.68)


def _risks(spark: SparkSession, d: str, scores: DataFrame | None) -> DataFrame:
    told = rate_scores(spark, d) if scores is None else scores.select("restaurant_key", "risk")
    return restaurants(spark, d).join(told, "restaurant_key").withColumn("category", metrics.tier(F.col("risk"), *map(F.lit, TIERS)))


def risks(spark: SparkSession, d: str, text: str = "", area: str | None = None, category: str | None = None, sort: str = "risk", down: bool = True, page: int = 1, size: int = 25, cuisine: str | None = None, scores: DataFrame | None = None) -> DataFrame:
    """Scored restaurants by words, area, cuisine and category, sorted, a page of them with the number of all. scores: a table
    (restaurant_key, risk) that a model left, such as refreshed_scores; without one the rates of the grades count."""
    rows = in_area(_risks(spark, d, scores), area_of(spark, d, area))
    rows = rows if category is None else rows.where(F.col("category") == one_of("category", category, ("LOW", "MODERATE", "HIGH")))
    rows = rows if cuisine is None else rows.where(F.upper("cuisine") == cuisine.strip().upper())
    words = spark.range(1).select(search_terms(F.lit(text)).alias("t")).first()[0] if text else []
    rows = rows.where(has_terms([F.col("restaurant_name"), F.col("cuisine")], words)) if words else rows
    hits = rows.select("restaurant_key", "restaurant_name", "cuisine", "risk", "category")
    return paged(hits, ordered({"risk": F.col("risk"), "name": F.col("restaurant_name"), "cuisine": F.col("cuisine")}, sort, down, F.asc("restaurant_key")), page, size)


def risk_of(spark: SparkSession, d: str, key: int, scores: DataFrame | None = None) -> DataFrame:
    """One restaurant's risk beside its latest grade; no row for a key that is unknown or has no score."""
    last = latest_graded(spark, d).where(F.col("restaurant_key") == key).select("restaurant_key", "grade", "inspected")
    return _risks(spark, d, scores).where(F.col("restaurant_key") == key).join(last, "restaurant_key", "left").select("restaurant_key", "restaurant_name", "risk", "category", "grade", "inspected")


RISK_SQL = SCORES_SQL + ", f AS (SELECT *, CASE WHEN risk >= 0.68 THEN 'HIGH' WHEN risk >= 0.65 THEN 'MODERATE' ELSE 'LOW' END AS category FROM scores)"
RISKS = ", h AS (SELECT restaurant_key, restaurant_name, cuisine, risk, category FROM f LEFT JOIN areas USING (area_key) WHERE {}) SELECT *, (SELECT count(*) FROM h) AS total FROM h ORDER BY {}, restaurant_key LIMIT {} OFFSET {}"
SCORED = "areas restaurants inspections"
asked("risks_in_asia", SCORED, RISK_SQL + RISKS.format("area_name = 'ASIA' AND category = 'MODERATE'", "risk DESC", 5, 5))(lambda spark, d: risks(spark, d, area="ASIA", category="MODERATE", page=2, size=5))
asked("risks_of_machinery_by_name", SCORED, RISK_SQL + RISKS.format("contains(upper(cuisine), 'MACHINERY')", "restaurant_name", 25, 0))(lambda spark, d: risks(spark, d, "machinery", sort="name", down=False))
asked("risks_of_a_cuisine", SCORED, RISK_SQL + RISKS.format("cuisine = 'HOUSEHOLD'", "risk", 40, 40))(lambda spark, d: risks(spark, d, cuisine=" household ", down=False, page=2, size=40))
asked("risk_of_one", "restaurants inspections", RISK_SQL + ", " + LATEST_SQL + " SELECT restaurant_key, restaurant_name, risk, category, grade, latest.inspected FROM f LEFT JOIN latest USING (restaurant_key) WHERE restaurant_key = 7")(lambda spark, d: risk_of(spark, d, 7))


@query("inspections restaurants", "SELECT restaurant_key, inspection_id, inspected, lat, lon FROM (SELECT *, row_number() OVER (PARTITION BY restaurant_key ORDER BY inspected DESC NULLS LAST, inspection_id DESC NULLS LAST) AS k FROM inspections JOIN restaurants USING (restaurant_key) WHERE lat BETWEEN 40.66 AND 40.74) WHERE k = 1")
def latest_valid_place(spark: SparkSession, d: str) -> DataFrame:
    """The latest inspection of each restaurant with coordinates inside a box; those without any valid one have no row."""
    rows = inspections(spark, d).join(restaurants(spark, d).select("restaurant_key", "lat", "lon"), "restaurant_key").where(F.col("lat").between(40.66, 40.74))
    return top_per_key(rows, ["restaurant_key"], [F.desc_nulls_last("inspected"), F.desc_nulls_last("inspection_id")]).select("restaurant_key", "inspection_id", "inspected", "lat", "lon")


@query("inspections restaurants", "SELECT restaurant_key, restaurant_name, cuisine, inspection_id, inspected, grade FROM (SELECT *, row_number() OVER (PARTITION BY restaurant_key ORDER BY inspected DESC, inspection_id DESC) AS k FROM inspections JOIN restaurants USING (restaurant_key)) WHERE k = 1")
def current_restaurant(spark: SparkSession, d: str) -> DataFrame:
    """Each restaurant as its newest inspection tells it, graded or not."""
    rows = top_per_key(inspections(spark, d), ["restaurant_key"], [F.desc("inspected"), F.desc("inspection_id")])
    return rows.join(restaurants(spark, d), "restaurant_key").select("restaurant_key", "restaurant_name", "cuisine", "inspection_id", "inspected", "grade")
