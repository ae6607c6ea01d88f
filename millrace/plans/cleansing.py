"""Cleaning, naming, duplicates, profiles and quality checks over the driver's tables.

Raw text columns are made from the keys by the same rule in Spark and in SQL: blank, padded, broken, out of
range or sentinel values at fixed remainders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import ascii_folded, cleaned, name_syntax
from millrace.operators import cleaning, names, quality
from millrace.operators.rows import drop_copies, newest_per_key
from millrace.plans.models import DAILY_SQL, HISTORY_SQL, LATEST_SQL, PLACES_SQL, WEEKLY_SQL, area_grade_summary, chain_flags, chain_summary, daily, dim_area, dim_complaint_type, dim_date, dim_finding, event_rollup, fact_complaint, fact_finding, history, latest_graded, named_places, next_event_label, weekly
from millrace.plans.roles import GRADES, areas, complaints, findings, inspections, query, restaurants, table


def raw_inspections(spark: SparkSession, d: str) -> DataFrame:
    """Customers as raw rows of text."""
    k = F.col("c_custkey")
    pick = lambda *cases: F.when(k % cases[0][0] == cases[0][1], cases[0][2]) if len(cases) == 1 else pick(*cases[:-1]).when(k % cases[-1][0] == cases[-1][1], cases[-1][2])
    s = k.cast("string")
    date = F.concat(F.lit("2024-0"), ((k % 9) + 1).cast("string"), F.lit("-1"), (k % 10).cast("string"), F.lit("T00:00:00.000"))
    return table(spark, d, "customer").select(
        k.alias("key"), pick((17, 0, F.lit(None).cast("string")), (17, 1, F.lit("   "))).otherwise(F.concat(F.lit(" "), s, F.lit("  "))).alias("camis"), F.lower("c_name").alias("dba"), F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("boro"),
        F.when(k % 5 == 0, "").otherwise(s).alias("building"), F.lit("main   street ").alias("street"), pick((7, 0, F.lit("bad zip")), (7, 1, F.lit(" ")), (7, 2, F.lit("10001-1234"))).otherwise("10451").alias("zipcode"),
        pick((13, 0, F.lit("not-a-date")), (13, 1, F.lit("")), (13, 2, F.lit("1900-01-01T00:00:00.000"))).otherwise(date).alias("inspection_date"), date.alias("grade_date"), F.lit("2024-02-30T00:00:00.000").alias("record_date"),
        pick((11, 0, F.lit("not-a-score")), (11, 1, F.lit("")), (11, 2, F.lit("12.5"))).otherwise((k % 60).cast("string")).alias("score"),
        pick((19, 0, F.lit("")), (19, 1, F.lit("999")), (19, 2, F.lit("x")), (19, 3, F.lit("41.5"))).otherwise("40.75").alias("latitude"), pick((19, 0, F.lit("")), (23, 0, F.lit(None).cast("string"))).otherwise("-73.99").alias("longitude"),
    )


RAW_SQL = """raw AS (SELECT c_custkey AS key, CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 17 = 1 THEN '   ' ELSE ' ' || c_custkey || '  ' END AS camis, c_mktsegment AS boro,
    CASE WHEN c_custkey % 5 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS building, CASE c_custkey % 7 WHEN 0 THEN 'bad zip' WHEN 1 THEN ' ' WHEN 2 THEN '10001-1234' ELSE '10451' END AS zipcode,
    CASE c_custkey % 13 WHEN 0 THEN 'not-a-date' WHEN 1 THEN '' WHEN 2 THEN '1900-01-01T00:00:00.000' ELSE '2024-0' || (c_custkey % 9 + 1) || '-1' || (c_custkey % 10) || 'T00:00:00.000' END AS inspection_date,
    CASE c_custkey % 11 WHEN 0 THEN 'not-a-score' WHEN 1 THEN '' WHEN 2 THEN '12.5' ELSE CAST(c_custkey % 60 AS VARCHAR) END AS score,
    CASE c_custkey % 19 WHEN 0 THEN '' WHEN 1 THEN '999' WHEN 2 THEN 'x' WHEN 3 THEN '41.5' ELSE '40.75' END AS latitude, CASE WHEN c_custkey % 19 = 0 THEN '' WHEN c_custkey % 23 = 0 THEN NULL ELSE '-73.99' END AS longitude FROM customer),
typed AS (SELECT key, nullif(trim(camis), '') AS camis, upper(boro) AS borough, CASE WHEN regexp_full_match(zipcode, '[0-9]{5}') THEN zipcode END AS zipcode, zipcode AS z, inspection_date AS i, try_cast(inspection_date AS TIMESTAMP) AS inspection_date,
    score AS s, CASE WHEN regexp_full_match(score, '[0-9]+') THEN CAST(score AS INTEGER) END AS score, nullif(trim(latitude), '') AS y, nullif(trim(longitude), '') AS x, try_cast(latitude AS DOUBLE) AS a, try_cast(longitude AS DOUBLE) AS b, building FROM raw),
stated AS (SELECT *, CASE WHEN nullif(trim(z), '') IS NULL THEN 'MISSING' WHEN zipcode IS NULL THEN 'INVALID' ELSE 'VALID' END AS zipcode_status,
    CASE WHEN nullif(trim(i), '') IS NULL THEN 'MISSING' WHEN inspection_date IS NULL THEN 'INVALID' WHEN inspection_date = TIMESTAMP '1900-01-01' THEN 'UNINSPECTED_PLACEHOLDER' ELSE 'VALID' END AS inspection_date_status,
    CASE WHEN nullif(trim(s), '') IS NULL THEN 'MISSING' WHEN score IS NULL THEN 'INVALID' ELSE 'VALID' END AS score_status,
    CASE WHEN y IS NULL AND x IS NULL THEN 'MISSING' WHEN y IS NULL OR x IS NULL THEN 'PARTIAL' WHEN a IS NULL OR b IS NULL THEN 'INVALID_FORMAT' WHEN abs(a) > 90 OR abs(b) > 180 THEN 'OUT_OF_RANGE' WHEN a NOT BETWEEN 40.45 AND 40.95 OR b NOT BETWEEN -74.30 AND -73.65 THEN 'OUTSIDE_AREA' ELSE 'VALID' END AS coordinate_status FROM typed)"""


@query("", RAW_SQL + """SELECT key, camis, borough, zipcode, zipcode_status, CAST(inspection_date AS DATE) AS inspected, inspection_date_status, score, score_status, CASE WHEN coordinate_status = 'VALID' THEN a END AS latitude, CASE WHEN coordinate_status = 'VALID' THEN b END AS longitude, coordinate_status,
    concat_ws(', ', concat_ws(' ', nullif(building, ''), 'MAIN STREET'), borough, 'NY ' || zipcode) AS address_display FROM stated""")
def typed_status(spark: SparkSession, d: str) -> DataFrame:
    """Typed columns of raw rows with their statuses."""
    p = cleaning.prepared_inspections(raw_inspections(spark, d))
    return p.select("key", "camis", "borough", "zipcode", "zipcode_status", F.to_date("inspection_date").alias("inspected"), "inspection_date_status", "score", "score_status", "latitude", "longitude", "coordinate_status", "address_display")


@query("", RAW_SQL + """, w AS (SELECT key, list_filter([CASE WHEN camis IS NULL THEN 'MISSING_CAMIS' END, CASE WHEN inspection_date_status = 'MISSING' THEN 'MISSING_INSPECTION_DATE' END, CASE WHEN inspection_date_status = 'INVALID' THEN 'INVALID_INSPECTION_DATE' END], lambda q: q IS NOT NULL) AS l FROM stated)
SELECT key, array_to_string(l, '|') AS reasons, len(l) = 0 AS accepted FROM w""")
def rejection_reasons(spark: SparkSession, d: str) -> DataFrame:
    p = cleaning.prepared_inspections(raw_inspections(spark, d))
    return p.select("key", F.array_join("rejection_reasons", "|").alias("reasons"), (F.size("rejection_reasons") == 0).alias("accepted"))


@query("", RAW_SQL + """, w AS (SELECT unnest([CASE WHEN camis IS NULL THEN 'MISSING_CAMIS' END, CASE WHEN inspection_date_status = 'MISSING' THEN 'MISSING_INSPECTION_DATE' END, CASE WHEN inspection_date_status = 'INVALID' THEN 'INVALID_INSPECTION_DATE' END]) AS reason FROM stated) SELECT reason, count(*) AS n FROM w WHERE reason IS NOT NULL GROUP BY reason""")
def reason_counts(spark: SparkSession, d: str) -> DataFrame:
    p = cleaning.prepared_inspections(raw_inspections(spark, d))
    return p.select(F.explode("rejection_reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("", r"SELECT doc_id, nullif(trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g')), '') AS clean FROM documents")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    """Texts with white space squeezed."""
    return table(spark, d, "documents").select("doc_id", cleaned(F.col("text")).alias("clean"))


@query("", r"""n AS (SELECT conv_id, turn, upper(strip_accents(regexp_replace(text, '[^\x00-\x7FÀ-ÅÇ-ÏÑ-ÖÙ-Ýà-åç-ïñ-öù-ýÿ]', '', 'g'))) AS t FROM conversations),
a AS (SELECT conv_id, turn, regexp_replace(replace(regexp_replace(t, '[''`]', '', 'g'), '&', ' AND '), '#\s*[A-Z0-9]+(?:[-/][A-Z0-9]+)*\b', ' ', 'g') AS t FROM n)
SELECT conv_id, turn, trim(regexp_replace(regexp_replace(t, '(?:\s*,?\s*\b(?:LLC|INC|INCORPORATED|CORP|CORPORATION|LTD|LIMITED)\b\.?)+\s*$', ' '), '[^A-Z0-9]+', ' ', 'g')) AS name FROM a""")
def name_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Normal forms of texts; letters beyond those with accents are left out first, on both sides."""
    plain = F.regexp_replace("text", r"[^\x00-\x7FÀ-ÅÇ-ÏÑ-ÖÙ-Ýà-åç-ïñ-öù-ýÿ]", "")
    return table(spark, d, "conversations").select("conv_id", "turn", name_syntax(plain).alias("name"))


@query("", PLACES_SQL.split(",\nsame AS")[0] + """, w AS (SELECT DISTINCT name FROM places), b AS (SELECT DISTINCT string_split(upper(p_name), ' ')[1] AS brand FROM part UNION SELECT DISTINCT upper(p_name) FROM part),
h AS (SELECT name, brand FROM w JOIN b ON contains(' ' || name || ' ', ' ' || brand || ' ')),
l AS (SELECT h.name, h.brand FROM h WHERE NOT EXISTS (SELECT 1 FROM h g WHERE g.name = h.name AND g.brand <> h.brand AND contains(' ' || g.brand || ' ', ' ' || h.brand || ' ')))
SELECT name, string_agg(brand, '|' ORDER BY brand) AS brands FROM l GROUP BY name""")
def brands_in_names(spark: SparkSession, d: str) -> DataFrame:
    """The longest known brands that stand in names as whole words."""
    p = table(spark, d, "part")
    brands = p.select(F.element_at(F.split(F.upper("p_name"), " "), 1).alias("brand")).union(p.select(F.upper("p_name"))).distinct()
    return names.contained_brands(named_places(spark, d), brands).select("name", F.array_join("brands", "|").alias("brands"))


@query("", """a AS (SELECT DISTINCT upper(p_name) AS alias, string_split(upper(p_name), ' ')[1] AS brand FROM part), c AS (SELECT upper(p_name) AS location, p_brand AS brand, min(p_partkey) AS place FROM part GROUP BY ALL),
k AS (SELECT DISTINCT p_brand AS brand FROM part WHERE p_size < 3 UNION SELECT DISTINCT string_split(upper(p_name), ' ')[1] FROM part WHERE p_size < 2),
s AS (SELECT location, list(brand ORDER BY place, brand) AS l FROM c GROUP BY location), w AS (SELECT DISTINCT upper(p_name) AS name FROM part),
ks AS (SELECT list(brand) AS known FROM k), o AS (SELECT w.name, coalesce(a.brand, w.name) AS canonical_name, coalesce(s.l, [coalesce(a.brand, w.name)]) AS l FROM w LEFT JOIN a ON a.alias = w.name LEFT JOIN s ON s.location = w.name)
SELECT name, canonical_name, array_to_string(l, '|') AS candidates, array_to_string(list_filter(l, lambda b: list_contains(known, b)), '|') AS fast_food, len(l) > 1 AS is_co_brand FROM o, ks""")
def brand_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Canonical names, candidate brands and those on a reviewed list: the brands of the smallest parts stand for it."""
    p = table(spark, d, "part").withColumn("name", F.upper("p_name"))
    first = F.element_at(F.split("name", " "), 1)
    aliases = p.select(F.col("name").alias("alias"), first.alias("brand")).distinct()
    co = p.groupBy(F.col("name").alias("location"), F.col("p_brand").alias("brand")).agg(F.min("p_partkey").alias("place"))
    known = p.where("p_size < 3").select(F.col("p_brand").alias("brand")).union(p.where("p_size < 2").select(first)).distinct()
    out = names.classified(p.select("name").distinct(), aliases, co, known)
    return out.select("name", "canonical_name", F.array_join("brand_candidates", "|").alias("candidates"), F.array_join("fast_food_brands", "|").alias("fast_food"), "is_co_brand")


@query("", "SELECT * EXCLUDE (k) FROM (SELECT doc_id, lang, source, n_chars, row_number() OVER (PARTITION BY text, lang ORDER BY source DESC, doc_id) AS k FROM documents) WHERE k = 1")
def dedup_exact(spark: SparkSession, d: str) -> DataFrame:
    """One document of each text and language, by the hash of both."""
    out = drop_copies(table(spark, d, "documents"), ["text", "lang"], [F.desc_nulls_last("source"), F.asc("doc_id")])
    return out.select("doc_id", "lang", "source", "n_chars")


@query("complaints", "SELECT restaurant_key, complaint_id, created, kind FROM (SELECT *, row_number() OVER (PARTITION BY restaurant_key ORDER BY created DESC, complaint_id DESC) AS k FROM complaints) WHERE k = 1")
def dedup_newest(spark: SparkSession, d: str) -> DataFrame:
    """The newest complaint of each user."""
    out = newest_per_key(complaints(spark, d), "restaurant_key", ["complaint_id", "created", "kind"], [F.desc_nulls_last("created"), F.desc_nulls_last("complaint_id")])
    return out.select("restaurant_key", "complaint_id", "created", "kind")


def missing_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, missing, missing_percent: one pass over the table, then one row per column."""
    sums = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "").alias(c) for c in columns])
    long = sums.unpivot(["__n"], columns, "column_name", "missing")
    return long.select("column_name", "missing", F.round(F.try_divide(100.0 * F.col("missing"), F.col("__n").cast("double")), 6).alias("missing_percent"))


@query("", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (coalesce(trim(CAST({c} AS VARCHAR)), '') = '') AS missing, round(100.0::DOUBLE * count(*) FILTER (coalesce(trim(CAST({c} AS VARCHAR)), '') = '') / nullif(count(*), 0), 6) AS missing_percent FROM documents" for c in ("doc_id", "text", "lang", "source", "n_chars")))
def profile_missing(spark: SparkSession, d: str) -> DataFrame:
    return missing_profile(table(spark, d, "documents"), ["doc_id", "text", "lang", "source", "n_chars"])


@query("", "SELECT coalesce(source, '<missing>') AS value, count(*) AS n FROM documents GROUP BY ALL")
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(F.coalesce("source", F.lit("<missing>")).alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query("", "g AS (SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL) SELECT count(*) AS groups, count(*) FILTER (n > 1) AS repeated_groups, max(n) AS largest FROM g")
def grain_profile(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of groups of a supposed key."""
    g = table(spark, d, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count(F.lit(1)).alias("groups"), F.count_if(F.col("n") > 1).alias("repeated_groups"), F.max("n").alias("largest"))


@query("", "SELECT CAST(min(try_cast(l AS DOUBLE)) AS DOUBLE) AS least, CAST(max(try_cast(l AS DOUBLE)) AS DOUBLE) AS greatest, count(*) FILTER (l IS NOT NULL AND try_cast(l AS DOUBLE) IS NULL) AS invalid, count(*) FILTER (try_cast(l AS DOUBLE) NOT BETWEEN 40.4 AND 41.0) AS outside FROM (SELECT nullif(latitude, '') AS l FROM (" + RAW_SQL.split("FROM customer)")[0].removeprefix("raw AS (") + "FROM customer))")
def numeric_profile(spark: SparkSession, d: str) -> DataFrame:
    text = raw_inspections(spark, d).select(F.nullif("latitude", F.lit("")).alias("l"))
    v = F.col("l").try_cast("double")
    return text.agg(F.min(v).alias("least"), F.max(v).alias("greatest"), F.count_if(F.col("l").isNotNull() & v.isNull()).alias("invalid"), F.count_if(~v.between(40.4, 41.0)).alias("outside"))


@query("", "SELECT upper(p_brand) AS normal, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS spellings, count(DISTINCT p_type) AS n FROM part GROUP BY ALL HAVING count(DISTINCT p_type) > 1")
def collision_groups(spark: SparkSession, d: str) -> DataFrame:
    """Keys with more than one value, and the values in order."""
    g = table(spark, d, "part").groupBy(F.upper("p_brand").alias("normal")).agg(F.array_sort(F.collect_set("p_type")).alias("s"))
    return g.where(F.size("s") > 1).select("normal", F.array_join("s", "|").alias("spellings"), F.size("s").cast("long").alias("n"))


@query("areas restaurants inspections findings", LATEST_SQL + """, shares AS (SELECT area_key, 100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY area_key) AS p FROM latest JOIN restaurants USING (restaurant_key) GROUP BY area_key, grade),
c AS (SELECT 'restaurant_key_not_null' AS check_name, count(*) FILTER (restaurant_key IS NULL) AS failing FROM restaurants
UNION ALL SELECT 'restaurant_key_unique', count(*) FROM (SELECT restaurant_key FROM restaurants GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'grade_accepted', count(*) FILTER (grade NOT IN ('A', 'B', 'C')) FROM inspections
UNION ALL SELECT 'area_related', count(*) FROM restaurants WHERE area_key IS NOT NULL AND area_key NOT IN (SELECT area_key FROM areas)
UNION ALL SELECT 'finding_related', count(*) FROM findings WHERE inspection_id NOT IN (SELECT inspection_id FROM inspections)
UNION ALL SELECT 'score_positive', count(*) FILTER (NOT coalesce(score > 0, false)) FROM inspections
UNION ALL SELECT 'percents_add_up', count(*) FILTER (abs(total - 100) >= 1e-4) FROM (SELECT sum(p) AS total FROM shares GROUP BY area_key)
UNION ALL SELECT 'fact_keeps_rows', abs((SELECT count(*) FROM findings) - (SELECT count(*) FROM findings JOIN inspections USING (inspection_id) JOIN restaurants USING (restaurant_key)))) SELECT check_name, CAST(failing AS BIGINT) AS failing, failing = 0 AS passed FROM c""")
def dq_checks(spark: SparkSession, d: str) -> DataFrame:
    r, i, f = restaurants(spark, d), inspections(spark, d), findings(spark, d)
    total = area_grade_summary(spark, d).where("graded_restaurants > 0").groupBy("area_key").agg(F.sum("grade_percent").alias("p"))
    return quality.report(
        quality.not_null(r, "restaurant_key", "restaurant_key_not_null"), quality.unique(r, "restaurant_key", "restaurant_key_unique"), quality.accepted(i, "grade", list(GRADES), "grade_accepted"),
        quality.related(r, "area_key", areas(spark, d), "area_key", "area_related"), quality.related(f, "inspection_id", i, "inspection_id", "finding_related"), quality.holds(i, F.col("score") > 0, "score_positive"),
        quality.holds(total, F.abs(F.col("p") - 100) < 1e-4, "percents_add_up"), quality.same_count(f, fact_finding(spark, d), "fact_keeps_rows"),
    )


GRADED = "FROM inspections WHERE grade IN ('A', 'B', 'C')"
COUNTS_SQL = {
    "findings": ("(SELECT count(*) FROM lineitem)", "(SELECT count(*) FROM findings JOIN inspections USING (inspection_id) JOIN restaurants USING (restaurant_key))"),
    "complaints": ("(SELECT count(*) FROM events)", "(SELECT count(*) FROM complaints LEFT JOIN restaurants USING (restaurant_key))"),
    "latest_grades": (f"(SELECT count(DISTINCT restaurant_key) {GRADED})", "(SELECT count(*) FROM latest)"),
    "restaurants": ("(SELECT count(*) FROM customer)", "(SELECT count(*) FROM restaurants LEFT JOIN latest USING (restaurant_key))"),
    "history": (f"(SELECT count(*) {GRADED})", "(SELECT count(*) FROM history)"),
    "graded_days": (f"(SELECT count(DISTINCT (restaurant_key, inspected)) {GRADED})", "(SELECT count(*) FROM daily)"),
    "labelled_days": ("(SELECT count(*) - count(DISTINCT restaurant_key) FROM daily)", "(SELECT count(*) FROM (SELECT lead(inspected) OVER (PARTITION BY restaurant_key ORDER BY inspected) AS n FROM daily) WHERE n IS NOT NULL)"),
    "weekly_grid": ("(SELECT count(*) FROM weeks) * ((SELECT count(*) FROM areas) + 1)", "(SELECT count(*) FROM grid)"),
    "critical_findings": ("(SELECT count(*) FROM lineitem WHERE l_returnflag = 'R')", "(SELECT CAST(coalesce(sum(critical_count), 0) AS BIGINT) FROM grid WHERE area_key = -1)"),
    "weekly_inspections": ("(SELECT count(*) FROM orders)", "(SELECT CAST(coalesce(sum(complaint_count), 0) AS BIGINT) FROM grid WHERE area_key = -1)"),
    "area_totals": ("(SELECT count(*) FROM latest)", "(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT grade, count(*) AS n FROM latest JOIN restaurants USING (restaurant_key) GROUP BY grade))"),
    "areas": ("(SELECT count(*) FROM region)", "(SELECT count(*) FROM areas)"),
    "complaint_types": ("(SELECT count(DISTINCT upper(event_type)) FROM events)", "(SELECT count(DISTINCT upper(kind)) FROM complaints)"),
    "finding_codes": ("(SELECT count(DISTINCT l_returnflag || l_linestatus) FROM lineitem)", "(SELECT count(DISTINCT code) FROM findings)"),
    "event_rollups": ("(SELECT count(*) FROM orders)", "(SELECT count(DISTINCT inspection_id) FROM inspections)"),
    "dates": ("(SELECT coalesce(date_diff('day', min(day), max(day)) + 1, 0) FROM (SELECT inspected AS day FROM inspections UNION ALL SELECT found FROM findings))", "(SELECT coalesce(date_diff('day', min(day), max(day)) + 1, 0) FROM (SELECT inspected AS day FROM inspections UNION ALL SELECT found FROM findings))"),
    "chains": ("(SELECT count(DISTINCT family_name) FROM chained WHERE is_chain)", "(SELECT count(*) FROM (SELECT family_name FROM chained WHERE is_chain GROUP BY family_name))"),
    "chain_locations": ("(SELECT count(*) FROM chained WHERE is_chain)", "(SELECT count(*) FROM chained WHERE is_chain)"),
    "area_grades": ("(SELECT (count(*) + 1) * 3 FROM areas)", "(SELECT (count(*) + 1) * 3 FROM areas)"),
}


@query("areas restaurants inspections findings complaints", LATEST_SQL + ", " + HISTORY_SQL + ", " + DAILY_SQL + ", " + PLACES_SQL.replace("places", "named_places") + ", " + WEEKLY_SQL + ", k AS (" + " UNION ALL ".join(f"SELECT '{n}' AS check_name, {e} AS expected, {a} AS actual" for n, (e, a) in COUNTS_SQL.items()) + ") SELECT *, expected = actual AS passed FROM k")
def reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """Counts of layers against those they are made from; each side is counted by itself."""
    i, r = inspections(spark, d), restaurants(spark, d)
    graded, last, days, grid = i.where(F.col("grade").isin(*GRADES)), latest_graded(spark, d), daily(spark, d), weekly(spark, d).where("area_key = -1")
    one = F.count(F.lit(1))
    n = lambda df: df.agg(one.alias("n"))
    total = lambda c: grid.agg(F.coalesce(F.sum(c), F.lit(0)).alias("n"))
    flags, span = chain_flags(spark, d).where("is_chain"), i.select(F.col("inspected").alias("day")).unionAll(findings(spark, d).select(F.col("found").alias("day")))
    weeks = weekly(spark, d).select("week").distinct().agg(one.alias("w")).crossJoin(areas(spark, d).agg(one.alias("a"))).select((F.col("w") * (F.col("a") + 1)).alias("n"))
    return quality.counted({
        "findings": (n(table(spark, d, "lineitem")), n(fact_finding(spark, d))), "complaints": (n(table(spark, d, "events")), n(fact_complaint(spark, d))),
        "latest_grades": (n(graded.select("restaurant_key").distinct()), n(last)), "restaurants": (n(table(spark, d, "customer")), n(r.join(last.select("restaurant_key"), "restaurant_key", "left"))),
        "history": (n(graded), n(history(spark, d))), "graded_days": (n(graded.select("restaurant_key", "inspected").distinct()), n(days)),
        "labelled_days": (days.agg((one - F.count_distinct("restaurant_key")).alias("n")), n(next_event_label(spark, d).where("next_inspected IS NOT NULL"))),
        "weekly_grid": (weeks, n(weekly(spark, d))), "critical_findings": (n(table(spark, d, "lineitem").where("l_returnflag = 'R'")), total("critical_count")), "weekly_inspections": (n(table(spark, d, "orders")), total("complaint_count")),
        "area_totals": (n(last), last.join(r, "restaurant_key").groupBy("grade").agg(one.alias("m")).agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n"))),
        "areas": (n(table(spark, d, "region")), n(dim_area(spark, d))), "complaint_types": (n(table(spark, d, "events").select(F.upper("event_type")).distinct()), n(dim_complaint_type(spark, d))),
        "finding_codes": (n(table(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus")).distinct()), n(dim_finding(spark, d))), "event_rollups": (n(table(spark, d, "orders")), n(event_rollup(spark, d))),
        "dates": (span.agg(F.coalesce(F.datediff(F.max("day"), F.min("day")) + 1, F.lit(0)).cast("long").alias("n")), n(dim_date(spark, d))),
        "chains": (n(flags.select("family_name").distinct()), n(chain_summary(spark, d))), "chain_locations": (n(flags), chain_summary(spark, d).agg(F.coalesce(F.sum("locations"), F.lit(0)).alias("n"))),
        "area_grades": (areas(spark, d).agg(((one + 1) * 3).alias("n")), n(area_grade_summary(spark, d))),
    })


@query("", r"SELECT doc_id, strip_accents(regexp_replace(text, '[^\x00-\x7FÀ-ÅÇ-ÏÑ-ÖÙ-Ýà-åç-ïñ-öù-ýÿ]', '', 'g')) AS folded FROM documents")
def accent_fold(spark: SparkSession, d: str) -> DataFrame:
    """Texts without accents. What is neither ASCII nor a letter with an accent goes."""
    return table(spark, d, "documents").select("doc_id", ascii_folded(F.col("text"), r"[^\x00-\x7FÀ-ÅÇ-ÏÑ-ÖÙ-Ýà-åç-ïñ-öù-ýÿ]").alias("folded"))
