"""Operators on hand-made rows."""

import json
import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import numbers, text
from millrace.operators import cleaning, grids, metrics, names, nearest, quality, rows
from millrace.plans import learning

RAW = ["camis", "dba", "boro", "building", "street", "zipcode", "inspection_date", "grade_date", "record_date", "score", "latitude", "longitude"]


def test_name_syntax(spark):
    cases = {
        "DUNKIN'": "DUNKIN", "AUNTIE ANNE'S/CINNABON": "AUNTIE ANNES CINNABON", "MCDONALDS, INC.": "MCDONALDS", "LTD PIZZA": "LTD PIZZA", "EATALY NY LLC (KIOSK)": "EATALY NY LLC KIOSK", "RAISING CANE'S # C1016": "RAISING CANES",
        "CHIPOTLE #3641UY": "CHIPOTLE", "Café": "CAFE", "Dunkin Donuts #4021 LLC": "DUNKIN DONUTS", "JOE & THE JUICE": "JOE AND THE JUICE", "": "", "ﬁsh ½": "FISH 12", "ｗｉｄｅ": "WIDE",
    }
    df = spark.createDataFrame(list(cases.items()), "a string, b string")
    assert {r[0]: r[1] for r in df.select("a", text.name_syntax(F.col("a"))).collect()} == cases


def test_fold_is_that_of_unicode(spark):
    words = ["".join(chr(c) for c in range(a, a + 32)) for a in range(0xA0, 0x2000, 32)] + ["naïve Ångström ﬂow №5"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", text.ascii_folded(F.col("w"))).collect()
    for w, folded in got:
        assert folded == unicodedata.normalize("NFKD", w).encode("ascii", "ignore").decode()


def test_fold_of_texts_with_few_and_many_letters(spark):
    words = [None, "", "plain", "é", "ﬁ½é中", "😀a", "x" * 1000 + "ﬄ"]
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", text.ascii_folded(F.col("w")).alias("f"))
    assert [r["f"] for r in df.collect()] == [None if w is None else unicodedata.normalize("NFKD", w).encode("ascii", "ignore").decode() for w in words]
    many = "".join(map(chr, range(0xC0, 0x180))) + "ﬁ½" + "a" * 50  # more letters than are replaced one by one
    assert spark.createDataFrame([(many,)], "w string").select(text.ascii_folded(F.col("w"))).first()[0] == unicodedata.normalize("NFKD", many).encode("ascii", "ignore").decode()
    assert spark.createDataFrame([("aéøb",)], "w string").select(text.ascii_folded(F.col("w"), "[éø]")).first()[0] == "ab"
    assert "regexp_extract_all" in df._jdf.queryExecution().optimizedPlan().toString()  # letters beyond ASCII alone are folded


def inspections(spark):
    data = [
        ("12345678", "x", "Manhattan", "10", "Main  Street", "10001", "2026-08-20T00:00:00.000", None, None, "12", "40.7500", "-73.9900"),
        ("11223344", "x", "Queens", "", None, "bad zip", "2026-08-22T00:00:00.000", None, None, "not-a-score", "40.7000", None),
        (None, "x", "Bronx", None, None, "10451", "not-a-date", None, None, "5", "999", "-73.9"),
        ("7", "x", None, None, None, None, "1900-01-01T00:00:00.000", None, None, None, "41.5", "-73.9"),
    ]
    return cleaning.prepared_inspections(spark.createDataFrame(data, ", ".join(f"{c} string" for c in RAW)))


def test_inspection_cleaning(spark):
    a, b, c, d = inspections(spark).collect()
    assert (a.address_display, a.score, a.coordinate_status, a.inspection_year) == ("10 MAIN STREET, MANHATTAN, NY 10001", 12, "VALID", 2026) and a.rejection_reasons == []
    assert (b.score, b.score_status, b.coordinate_status, b.zipcode_status) == (None, "INVALID", "PARTIAL", "INVALID") and b.latitude is None
    assert c.rejection_reasons == ["MISSING_CAMIS", "INVALID_INSPECTION_DATE"] and c.coordinate_status == "OUT_OF_RANGE"
    assert d.inspection_date_status == "UNINSPECTED_PLACEHOLDER" and d.rejection_reasons == [] and d.coordinate_status == "OUTSIDE_AREA"
    kept, gone = cleaning.split(inspections(spark))
    assert (kept.count(), gone.count()) == (3, 1) and "rejection_reasons" not in kept.columns


def test_complaint_cleaning(spark):
    names_ = ["unique_key", "created_date", "closed_date", "resolution_action_updated_date", "complaint_type", "borough", "incident_zip", "latitude", "longitude", "status"]
    data = [
        ("1", "2026-08-20T10:30:00.000", None, None, "Food Poisoning", "New York", "10001-1234", "40.75", "-73.99", "Open"),
        ("2", "2026-08-20T11:30:00.000", None, None, "Rodent", "Brooklyn", "bad", None, None, "Open"),
        (None, "bad-date", None, None, "Noise", "Unspecified", "11373", "40.73", "-73.87", None),
    ]
    ready, without, rejected = cleaning.split_spatial(cleaning.prepared_complaints(spark.createDataFrame(data, ", ".join(f"{n} string" for n in names_))))
    a, b, c = ready.first(), without.first(), rejected.first()
    assert (a.borough, a.incident_zip, a.status) == ("MANHATTAN", "10001", "OPEN")
    assert (b.coordinate_status, b.incident_zip_status) == ("MISSING", "INVALID")
    assert c.rejection_reasons == ["MISSING_UNIQUE_KEY", "INVALID_CREATED_DATE", "UNEXPECTED_COMPLAINT_TYPE"] and c.borough_status == "MISSING"


def test_duplicates(spark):
    df = spark.createDataFrame([("a", "04L", "f1"), ("a", "04L", "f2"), ("a", "06D", "f1"), (None, None, "f0"), (None, None, "f9")], "camis string, code string, file string")
    out = rows.drop_copies(df, ["camis", "code"], [F.desc("file")]).collect()
    assert sorted((r.camis or "", r.file) for r in out) == [("", "f9"), ("a", "f1"), ("a", "f2")] and all(len(r.record_id) == 64 for r in out)
    versions = spark.createDataFrame([("123", 1, "OPEN"), ("123", 2, "CLOSED"), ("456", 1, "OPEN"), (None, 1, "x"), (None, 2, "y")], "k string, at int, state string")
    newest = rows.newest_per_key(versions, "k", ["k", "at", "state"], [F.desc_nulls_last("at")]).collect()
    assert sorted((r.k or "", r.state) for r in newest) == [("", "x"), ("", "y"), ("123", "CLOSED"), ("456", "OPEN")]


def test_nearest(spark):
    points = spark.createDataFrame([("near", 40.75, -73.99), ("over", 40.7516, -73.99), ("far", 40.76, -73.99), ("missing", None, None)], "p string, lat double, lon double")
    places = spark.createDataFrame([(100, 40.75045, -73.99), (101, 40.75045, -73.99), (102, None, -73.99)], "r int, lat double, lon double")
    for limit in (200_000, 0):  # broadcast, and shuffled by cell
        found = {r.p: (r.r, r.distance) for r in nearest.nearest(points, places, "p", "r", broadcast_rows=limit).collect()}
        assert found["near"][0] == 100 and 45 < found["near"][1] < 55 and found["over"][1] > 100 and "far" not in found
    out = {r.p: r for r in nearest.matched(points, places, "p", "r").collect()}
    assert [out[p].match_status for p in ("near", "over", "far", "missing")] == ["MATCHED", "NO_PLACE_WITHIN_THRESHOLD", "NO_PLACE_WITHIN_THRESHOLD", "NO_VALID_COORDINATES"]
    assert out["over"].r is None and out["over"].distance > 100


def test_nearest_among_crowded_places_is_that_of_all_pairs(spark):
    """A crowd in one cell, lone places around it, copies of a spot: a point meets a few places of the crowd, and the answers are those of all pairs."""
    crowd = [(i, 40.7 + (i * 7919 % 997) * 2e-6, -73.99 + (i * 104729 % 991) * 2e-6) for i in range(1500)]
    places = crowd + [(5000 + i, *crowd[i][1:]) for i in range(50)] + [(6000 + i, 40.70251 + i * 0.0017, -73.9951 + i * 0.0011) for i in range(6)]
    points = [(i, 40.699 + (i * 31 % 613) * 1.1e-5, -73.996 + (i * 57 % 599) * 1.6e-5) for i in range(300)]
    places, points = spark.createDataFrame(places, "r long, lat double, lon double"), spark.createDataFrame(points, "p long, lat double, lon double")
    assert nearest._halvings(places.select(F.col("lat").alias("__lat2"), F.col("lon").alias("__lon2")), nearest.CELL) >= 3
    cell = lambda c: F.floor(F.col(c) / nearest.CELL)
    pairs = points.crossJoin(places.select("r", F.col("lat").alias("b"), F.col("lon").alias("l"))).where((F.abs(cell("lat") - cell("b")) <= 1) & (F.abs(cell("lon") - cell("l")) <= 1))
    metres = numbers.haversine(F.col("lat"), F.col("lon"), F.col("b"), F.col("l"))
    wanted = {x.p: (x.m.d, x.m.r) for x in pairs.groupBy("p").agg(F.min(F.struct(metres.alias("d"), "r")).alias("m")).collect()}
    for limit in (200_000, 0):
        assert {x.p: (x.distance, x.r) for x in nearest.nearest(points, places, "p", "r", broadcast_rows=limit).collect()} == wanted


def test_lookback_is_half_open_and_survives_hot_keys(spark):
    left = spark.createDataFrame([(1, "k", datetime(2024, 1, 10)), (2, "k", datetime(2024, 1, 1)), (3, None, datetime(2024, 1, 10))], "i int, k string, at timestamp")
    right = spark.createDataFrame([("k", datetime(2024, 1, d)) for d in (8, 9, 10)] + [("k", datetime(2024, 1, 7, 23, 59))], "k string, seen timestamp")
    got = grids.within_before(left, right, ["k"], "at", "seen", 2).collect()
    assert sorted((r.i, r.seen.day) for r in got) == [(1, 8), (1, 9)]


def test_correlation(spark):
    df = spark.createDataFrame([("a", float(x), 2.0 * x) for x in range(5)] + [("b", 1.0, float(x)) for x in range(5)] + [("c", 1.0, 2.0), ("c", 2.0, None)], "g string, x double, y double")
    r = {x.g: x.r for x in df.groupBy("g").agg(numbers.pearson("x", "y").alias("r")).collect()}
    assert r["a"] == pytest.approx(1) and r["b"] is None and r["c"] is None
    got = spark.createDataFrame([(0.29,), (0.30,), (-0.59,), (-0.60,), (None,)], "r double").select(numbers.strength(F.col("r")), numbers.direction(F.col("r")), numbers.fisher_bound(F.col("r"), F.lit(3), 1)).collect()
    assert [x[0] for x in got] == ["weak", "moderate", "moderate", "strong", "not calculable"] and all(x[2] is None for x in got)
    assert spark.range(1).select(numbers.fisher_bound(F.lit(0.5), F.lit(28), -1)).first()[0] == pytest.approx(0.156021, abs=1e-5)


def test_search_terms(spark):
    got = spark.range(1).select(text.search_terms(F.lit("Tony's Brick Oven in Staten Island Bay Street"))).first()[0]
    assert got == ["TONY", "BRICK", "OVEN", "STATEN", "ISLAND", "BAY", "STREET"]


def test_thresholds_and_tiers(spark):
    def at(labels, scores):
        return metrics.thresholds(spark.createDataFrame(list(zip(scores, labels, strict=True)), "s double, y int"), "s", "y").first()

    t = at([0, 0, 0, 1, 1, 1], [0.02, 0.10, 0.25, 0.30, 0.60, 0.90])
    assert 0 <= t.moderate < t.high <= 1 and t.high == 0.30
    u = at([0, 0, 0, 0, 1, 0, 1, 1], [0.05, 0.10, 0.20, 0.55, 0.60, 0.65, 0.70, 0.90])
    assert u.high == 0.60
    tiers = spark.createDataFrame([(0.05,), (0.20,), (0.70,)], "p double").select(metrics.tier(F.col("p"), F.lit(0.1), F.lit(0.5))).collect()
    assert [x[0] for x in tiers] == ["LOW", "MODERATE", "HIGH"]


def test_ranking_of_one_class_and_ties(spark):
    df = spark.createDataFrame([("a", 0.5, 1), ("a", 0.5, 0), ("b", 0.1, 1)], "g string, s double, y int")
    m = {r.g: r for r in metrics.ranking(df, "s", "y", ["g"]).collect()}
    assert m["a"].auc == 0.5 and m["a"].average_precision == 0.5 and m["b"].auc is None and m["b"].brier == pytest.approx(0.81)


def test_folds_do_not_mix_dates(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in range(1, 16) for _ in range(2)], "day timestamp")
    folds = metrics.date_folds(df, "day", 3).collect()
    for f in (1, 2, 3):
        train, test = ({r.day for r in folds if (r.fold, r.part) == (f, p)} for p in ("train", "test"))
        assert len(test) == 3 and max(train) < min(test)


def test_chains(spark):
    data = [(i, "BIG PIZZA", "p", False) for i in range(3)] + [(10, "BIG PIZZA UNIT 7", "p", False), (11, "BIG PIZZA OF THE WEST SIDE", "p", False), (12, "BIG PIZZA EAST", "q", False), (13, "BIG PIZZA EAST", "p", True), (14, None, "p", False)]
    got = {r.place_key: r for r in names.chains(spark.createDataFrame(data, "place_key int, name string, cuisine string, is_co_brand boolean")).collect()}
    assert [got[i].match_method for i in (0, 10, 11, 12, 13, 14)] == ["EXACT_NAME", "AUTO_PREFIX", "UNMATCHED", "UNMATCHED", "UNMATCHED", "UNMATCHED"]
    assert got[10].chain_name == "BIG PIZZA" and got[0].location_count == 4 and not got[14].is_chain


def test_brands(spark):
    aliases = spark.createDataFrame([("DUNKIN DONUTS", "DUNKIN")], "alias string, brand string")
    co = spark.createDataFrame([("KFC TACO BELL", "TACO BELL", 2), ("KFC TACO BELL", "KFC", 1)], "location string, brand string, place int")
    known = spark.createDataFrame([("DUNKIN",), ("KFC",), ("PIZZA HUT",), ("HUT",)], "brand string")
    named = spark.createDataFrame([("DUNKIN DONUTS",), ("KFC TACO BELL",), ("OTHER",), (None,)], "name string")
    got = {r.name: r for r in names.classified(named, aliases, co, known).collect()}
    assert got["DUNKIN DONUTS"].fast_food_brands == ["DUNKIN"] and got["KFC TACO BELL"].brand_candidates == ["KFC", "TACO BELL"] and got["KFC TACO BELL"].is_co_brand
    assert got["OTHER"].fast_food_brands == [] and got[None].brand_candidates == []
    inside = {r.name: r.brands for r in names.contained_brands(spark.createDataFrame([("MY PIZZA HUT EXPRESS",), ("HUTS",)], "name string"), known).collect()}
    assert inside == {"MY PIZZA HUT EXPRESS": ["PIZZA HUT"]}
    over = spark.createDataFrame([("HUT", "EXCLUDE"), ("NEW", "INCLUDE")], "brand string, action string")
    assert {r.brand for r in names.overridden(known, over).collect()} == {"DUNKIN", "KFC", "PIZZA HUT", "NEW"}
    with pytest.raises(ValueError):
        names.overridden(known, over.union(spark.createDataFrame([("HUT", "INCLUDE")], "brand string, action string")))


def test_checks(spark):
    df = spark.createDataFrame([(1, "A"), (1, "Z"), (None, "A")], "k int, g string")
    got = {r.check_name: r.failing for r in quality.report(quality.not_null(df, "k", "n"), quality.unique(df, "k", "u"), quality.accepted(df, "g", ["A"], "a"), quality.related(df, "k", df.where("k > 5"), "k", "r"), quality.holds(df, F.col("k") > 0, "h"), quality.same_count(df, df.limit(1), "c")).collect()}
    assert got == {"n": 1, "u": 1, "a": 1, "r": 2, "h": 1, "c": 2}


def test_trend_texts(spark):
    from millrace.plans.reads import trend_text

    data = [("average_score", 11.396, 11.415), ("closures_this_year", 525.0, 7.0), ("closures_this_year", 5.0, 0.0), ("grade_a_rate", 90.0, 88.0), ("open_complaints", 110.0, 100.0), ("critical_rate", None, 1.0), ("active_restaurants", 5.0, None)]
    got = [r.trend for r in trend_text(spark.createDataFrame(data, "metric string, value double, comparison double")).collect()]
    assert got == ["0.0pt MoM", "+7 this month", "0 this month", "+2.0pt MoM", "+10.0% WoW", "Comparison unavailable", "Current snapshot"]


def test_leaks_and_model_rules():
    with pytest.raises(ValueError):
        learning.guarded(["score", "target_is_bc"])
    assert learning.share_ratio(0.2, 0.0) is None and learning.share_ratio(0.2, 0.1) == 2.0
    figures = {"auc": 0.7, "high_precision": 0.3, "watch_recall": 0.7, "brier": 0.06}
    assert learning.monitored(figures, 0.1, {"x": 0.6}, {"HIGH": (0.1, 0.1)})[0] == "PASS"
    assert learning.monitored(figures, 0.1, {"x": 0.5}, {})[0] == "WARN" and learning.monitored(figures | {"auc": 0.5}, 0.1, {}, {})[0] == "FAIL"
    assert learning.chosen({"brier": 0.06, "f1": 0.3, "recall": 0.4}, {"brier": 0.062, "f1": 0.35, "recall": 0.4}) == "trees"


def test_contributions_are_json(spark):
    from millrace.plans import roles

    rows_ = roles.QUERIES["logistic_scores"](spark, "/root/testdata/sf0.001").limit(20).collect()
    assert all({"contribution", "feature"} == set(f) and f["contribution"] > 0 for r in rows_ for f in json.loads(r.factors))


def test_requests_check_their_arguments(spark):
    from millrace.plans import requests

    d = "/root/testdata/sf0.001"
    for call in (
        lambda: requests.cuisines(spark, d, area="nowhere"), lambda: requests.cuisines(spark, d, sort="name; DROP"), lambda: requests.cuisines(spark, d, limit=21), lambda: requests.cuisines(spark, d, limit=True),
        lambda: requests.violations(spark, d, critical="some"), lambda: requests.weekly_series(spark, d, weeks=13), lambda: requests.correlations(spark, d, lag=3), lambda: requests.around(spark, d, 1, radius=99),
        lambda: requests.search(spark, d, grade="D"), lambda: requests.search(spark, d, size=101), lambda: requests.search(spark, d, page=0), lambda: requests.search(spark, d, flag="x"), lambda: requests.history_of(spark, d, "7' OR 1=1"),
        lambda: requests.risks(spark, d, category="high"), lambda: requests.area_board(spark, d, "rank"), lambda: requests.chains(spark, d, sort="x"),
    ):
        with pytest.raises(ValueError):
            call()
    assert requests.search(spark, d, text="o'brien's \" %_").count() == 0
    assert requests.around(spark, d, -5).count() == 0 and requests.risk_of(spark, d, -5).count() == 0
    assert requests.kind_of("ADD_to cart", ["add_to_cart", "x"]) == "add_to_cart" and requests.kind_of("y", ["x"]) is None and requests.kind_of(None, ["x"]) is None


def test_quantiles_are_those_of_all_values(spark):
    import numpy as np

    from millrace.operators import metrics

    rng = np.random.default_rng(2)
    rows = [(float(a), None if i % 3 else int(b), 5.0, None) for i, (a, b) in enumerate(zip(rng.lognormal(3, 2, 500), rng.integers(-4, 4, 500), strict=True))]
    df = spark.createDataFrame(rows, "a double, b long, c double, d double")
    got = {(r["name"], r["share"]): r["value"] for r in metrics.quantiles(df, ["a", "b", "c", "d"], [0.0, 0.1, 0.5, 0.77, 1.0]).collect()}
    for k, name in enumerate("abc"):
        values = [r[k] for r in rows if r[k] is not None]
        for share in (0.0, 0.1, 0.5, 0.77, 1.0):
            assert abs(got[name, share] - np.quantile(values, share)) < 1e-9
    assert len(got) == 15 and metrics.quantiles(df.limit(0), ["a"], [0.5]).count() == 0


def test_folds_calibration_and_promotion(spark, tmp_path):
    import datetime
    import random

    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F

    from millrace.plans import learning

    rng = random.Random(1)
    rows = []
    for i in range(400):
        x = rng.gauss(0, 1)
        rows.append((i, datetime.date(2000, 1, 1) + datetime.timedelta(days=i // 4), x, rng.gauss(0, 1), int(rng.random() < 1 / (1 + 2.7 ** -(2 * x - 1)))))
    df = VectorAssembler(inputCols=["z_x", "z_y"], outputCol="features").transform(spark.createDataFrame(rows, "key int, day date, z_x double, z_y double, target int")).cache()
    starts = []

    def fit(part):
        starts.append(part.agg(F.max("day")).first()[0])
        return learning.fitted_logistic(part, 0.01, False)

    scored = learning.out_of_fold(df, "day", fit)
    assert scored.count() == len({r["key"] for r in scored.collect()}) == 300 and starts == sorted(starts)
    assert scored.agg(F.min("day")).first()[0] > starts[0]
    penalty, balanced, best = learning.chosen_logistic(df, "day", ((0.01, False), (50.0, False)))
    assert (penalty, balanced) == (0.01, False) and best.count() == 300
    risk = scored.select("target", learning.calibrated(F.col("p"), scored).alias("risk")).agg(F.avg("risk"), F.avg("target")).first()
    assert abs(risk[0] - risk[1]) < 0.01
    table = learning.coefficient_table(learning.fitted_logistic(df, 0.01, True), ("x", "y"), spark).collect()
    assert [r["feature"] for r in table] == ["x", "y"] and table[0]["effect"] == "raises"
    weights = learning.weighted(df, True).groupBy("target").agg(F.sum("weight").alias("w")).collect()
    assert abs(weights[0]["w"] - weights[1]["w"]) < 1e-6

    good, bad, pointer = (f"{tmp_path}/{n}" for n in ("good", "bad", "pointer"))
    spark.createDataFrame([(1, 0.5), (2, 1.0)], "restaurant_key int, risk double").write.parquet(good)
    spark.createDataFrame([(1, 0.5), (1, 1.5), (None, None)], "restaurant_key int, risk double").write.parquet(bad)
    assert learning.verified_scores(spark.read.parquet(bad)) == {"empty": 0, "no_key": 1, "repeated": 1, "risk": 2}
    assert learning.verified_scores(spark.read.parquet(good).limit(0))["empty"] == 1
    assert not learning.promoted(spark, bad, pointer, "PASS") and not learning.promoted(spark, good, pointer, "FAIL") and learning.promoted_path(spark, pointer) is None
    assert learning.promoted(spark, good, pointer, "WARN") and learning.promoted(spark, good, pointer, "PASS") and learning.promoted_path(spark, pointer) == (1, good)


def test_folds_of_rows_are_not_shuffled(spark):
    """The days of a fold go to the rows, however many rows there are, and only what a model learns from is held."""
    data = [(datetime(2000, 1, 1 + i % 20).date(), i % 2, i) for i in range(80)]
    rows_ = spark.createDataFrame(data, "day date, target int, i int")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for train, test in learning.fold_parts(rows_, "day", 3):
            assert train.count() and test.count() and not {r["day"] for r in train.collect()} & {r["day"] for r in test.collect()}
            for part in (train, test):
                assert "SortMergeJoin" not in part._jdf.queryExecution().withCachedData().toString() + part._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    vectors, _ = learning._assembled(spark, "/root/testdata/sf0.001")
    assert learning.slim(vectors).columns == ["next_inspected", "target", "features"]
