"""Risk models: features without leakage, logistic regression and boosted trees, calibration, thresholds, monitoring."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import metrics, trees
from millrace.operators.rows import top_per_key
from millrace.plans.models import FRAME_SQL, daily, history_frame
from millrace.plans.roles import areas, query, restaurants, table

NUMBERS = ("score", "previous_score", "days_since_previous", "mean_score_3", "visits_3", "known_days", "a_days", "b_days", "c_days", "visits_ever")
FORBIDDEN = ("target", "next_inspected", "next_grade", "restaurant_key", "inspected")


def guarded(features: list[str]) -> list[str]:
    """The features, if none of them tells the target or names a row."""
    bad = [f for f in features if f in FORBIDDEN or f.startswith("target_")]
    if bad:
        raise ValueError(f"features that leak: {bad}")
    return features


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Feature rows with the next graded day's outcome; the anchor always precedes it."""
    from pyspark.sql import Window

    w = Window.partitionBy("restaurant_key").orderBy("inspected")
    rows = history_frame(daily(spark, d)).withColumns({"next_inspected": F.lead("inspected").over(w), "next_grade": F.lead("grade").over(w)})
    return rows.where("next_inspected > inspected").withColumn("target", F.col("next_grade").isin("B", "C").cast("int"))


def chronological(df: DataFrame, date: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    day = F.lit(cutoff).cast("date")
    return df.where(F.col(date) < day), df.where(F.col(date) >= day)


def scales(train: DataFrame, numbers: tuple[str, ...]) -> dict[str, tuple[float | None, float | None, float | None]]:
    """Of each column the median over train, and mean and population deviation with nulls at the median; a row that is told to the driver once, so that no later plan makes it again."""
    middles = metrics.quantiles(train, numbers, [0.5])
    medians = middles.agg(*[F.max(F.when(F.col("name") == c, F.col("value"))).alias(f"__m_{c}") for c in numbers])
    filled = train.crossJoin(F.broadcast(medians)).select(*[F.coalesce(F.col(c).cast("double"), F.col(f"__m_{c}")).alias(c) for c in numbers], *[f"__m_{c}" for c in numbers])
    r = filled.agg(*[x for c in numbers for x in (F.max(f"__m_{c}"), F.avg(c), F.stddev_pop(c))]).first()
    return {c: tuple(r[3 * i : 3 * i + 3]) for i, c in enumerate(numbers)}


def scaled(rows: DataFrame, known: dict[str, tuple[float | None, float | None, float | None]]) -> DataFrame:
    """Adds z_<column>: nulls become the median, then columns are centred and divided by the deviation (1 where constant)."""
    number = lambda x: F.lit(x).cast("double")
    return rows.withColumns({f"z_{c}": (F.coalesce(F.col(c).cast("double"), number(m)) - number(a)) / number(s if s and s > 0 else 1.0) for c, (m, a, s) in known.items()})


def imputed_scaled(train: DataFrame, rows: DataFrame, numbers: tuple[str, ...]) -> DataFrame:
    """Nulls become the training median, then columns are centred and divided by the population deviation of the training rows (1 where constant)."""
    return scaled(rows, scales(train, numbers))


def one_hot(rows: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """An indicator per category; null counts as UNKNOWN, and a value that is none of the categories gives zeros."""
    value = F.coalesce(F.col(column), F.lit("UNKNOWN"))
    return rows.withColumns({f"is_{column}_{c}": (value == c).cast("int") for c in categories})


@query("inspections", FRAME_SQL + """, m AS (SELECT median(days_since_previous) AS m1, median(previous_score) AS m2 FROM framed WHERE inspected < DATE '2000-01-01'),
f AS (SELECT coalesce(days_since_previous, m1)::DOUBLE AS a, coalesce(previous_score, m2)::DOUBLE AS b FROM framed, m WHERE inspected < DATE '2000-01-01'), s AS (SELECT avg(a) AS aa, stddev_pop(a) AS sa, avg(b) AS ab, stddev_pop(b) AS sb FROM f)
SELECT restaurant_key, inspected, round((coalesce(days_since_previous, m1) - aa) / CASE WHEN sa > 0 THEN sa ELSE 1 END, 6) AS z_days, round((coalesce(previous_score, m2) - ab) / CASE WHEN sb > 0 THEN sb ELSE 1 END, 6) AS z_score,
    CAST(coalesce(previous_grade, 'UNKNOWN') = 'A' AS INTEGER) AS is_a, CAST(coalesce(previous_grade, 'UNKNOWN') = 'B' AS INTEGER) AS is_b, CAST(coalesce(previous_grade, 'UNKNOWN') = 'UNKNOWN' AS INTEGER) AS is_unknown FROM framed, m, s""")
def impute_scale_onehot(spark: SparkSession, d: str) -> DataFrame:
    rows = history_frame(daily(spark, d))
    train, _ = chronological(rows, "inspected", "2000-01-01")
    out = one_hot(imputed_scaled(train, rows, ("days_since_previous", "previous_score")), "previous_grade", ["A", "B", "UNKNOWN"])
    return out.select("restaurant_key", "inspected", F.round("z_days_since_previous", 6).alias("z_days"), F.round("z_previous_score", 6).alias("z_score"), F.col("is_previous_grade_A").alias("is_a"), F.col("is_previous_grade_B").alias("is_b"), F.col("is_previous_grade_UNKNOWN").alias("is_unknown"))


def scored_labels(spark: SparkSession, d: str) -> DataFrame:
    """Orders as scored rows: a fixed function of the key that leans on the label."""
    k = F.col("o_orderkey")
    y = (F.col("o_orderstatus") == "F").cast("int")
    score = ((k * 7919 % 1000) + y * 250) / F.lit(1250.0)
    return table(spark, d, "orders").select(k.alias("key"), y.alias("label"), score.alias("score"), F.col("o_orderpriority").alias("segment"), F.col("o_orderdate").cast("date").alias("day"))


SCORED_SQL = """scored AS (SELECT o_orderkey AS key, CAST(o_orderstatus = 'F' AS INTEGER) AS label, ((o_orderkey * 7919 % 1000) + CAST(o_orderstatus = 'F' AS INTEGER) * 250) / 1250.0::DOUBLE AS score, o_orderpriority AS segment, CAST(o_orderdate AS DATE) AS day FROM orders)"""
RANKING_SQL = """SELECT {seg}count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, round((sum(CASE WHEN label = 1 THEN rk END) - sum(label) * (sum(label) + 1) / 2) / nullif(sum(label) * (count(*) - sum(label)), 0), 6)::DOUBLE AS auc,
    round(sum(CASE WHEN label = 1 THEN above / seen END) / nullif(sum(label), 0), 6)::DOUBLE AS average_precision, round(avg(pow(score - label, 2)), 6) AS brier, round(-avg(label * ln(greatest(least(score, 1 - 1e-15), 1e-15)) + (1 - label) * ln(1 - greatest(least(score, 1 - 1e-15), 1e-15))), 6) AS log_loss
FROM (SELECT *, (rank() OVER (PARTITION BY {part} ORDER BY score) + (count(*) OVER (PARTITION BY {part}, score) - 1) / 2) AS rk, sum(label) OVER (PARTITION BY {part} ORDER BY score DESC RANGE UNBOUNDED PRECEDING) AS above, count(*) OVER (PARTITION BY {part} ORDER BY score DESC RANGE UNBOUNDED PRECEDING) AS seen FROM scored)"""


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


@query("", SCORED_SQL + RANKING_SQL.format(seg="", part="1"))
def metrics_auc_ap_brier(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.ranking(scored_labels(spark, d), "score", "label"))


@query("", SCORED_SQL + RANKING_SQL.format(seg="segment, ", part="segment") + " GROUP BY segment HAVING count(*) >= 30")
def segment_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of each segment of 30 rows at least."""
    return rounded(metrics.ranking(scored_labels(spark, d), "score", "label", ["segment"]).where("n >= 30"))


@query("", SCORED_SQL + """, u AS (SELECT score, count(*) AS n, sum(label) AS p FROM scored GROUP BY score), c AS (SELECT score, sum(p) OVER w AS tp, sum(n) OVER w AS seen, sum(p) OVER () AS allp FROM u WINDOW w AS (ORDER BY score DESC)),
q AS (SELECT score, tp / seen AS precision, tp / allp AS recall, coalesce(2 * (tp / seen) * (tp / allp) / nullif(tp / seen + tp / allp, 0), 0) AS f1 FROM c), f AS (SELECT score FROM q ORDER BY f1 DESC, score LIMIT 1),
h AS (SELECT coalesce((SELECT min(q.score) FROM q, f WHERE precision >= 0.35 AND q.score >= f.score AND recall > 0), (SELECT score FROM f)) AS high)
SELECT round(coalesce((SELECT q.score FROM q, h WHERE recall >= 0.8 AND q.score < high ORDER BY precision DESC, q.score DESC LIMIT 1), high / 2), 6) AS moderate, round(high, 6) AS high FROM h""")
def pr_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.thresholds(scored_labels(spark, d), "score", "label"))


@query("", SCORED_SQL + """, e AS (SELECT list_distinct(quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS l FROM scored)
SELECT CAST(len(list_filter(l, lambda x: x < score)) AS INTEGER) AS bin, count(*) AS n, round(avg(score), 6) AS mean_score, round(avg(label), 6) AS positive_rate FROM scored, e GROUP BY ALL""")
def calibration_bins(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.calibration(scored_labels(spark, d), "score", "label"))


@query("", SCORED_SQL + """SELECT segment, count(*) FILTER (score >= 0.6 AND label = 1) AS tp, count(*) FILTER (score >= 0.6 AND label = 0) AS fp, count(*) FILTER (score < 0.6 AND label = 1) AS fn, count(*) FILTER (score < 0.6 AND label = 0) AS tn,
    round(coalesce(count(*) FILTER (score >= 0.6 AND label = 1) / nullif(count(*) FILTER (score >= 0.6), 0), 0), 6)::DOUBLE AS precision, round(coalesce(count(*) FILTER (score >= 0.6 AND label = 1) / nullif(count(*) FILTER (label = 1), 0), 0), 6)::DOUBLE AS recall,
    round(coalesce(2 * count(*) FILTER (score >= 0.6 AND label = 1) / nullif(count(*) FILTER (score >= 0.6) + count(*) FILTER (label = 1), 0), 0), 6)::DOUBLE AS f1 FROM scored GROUP BY segment""")
def confusion_by_segment(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.confusion(scored_labels(spark, d), "score", "label", 0.6, ["segment"]))


@query("", SCORED_SQL + """SELECT CASE WHEN score >= 0.7 THEN 'HIGH' WHEN score >= 0.4 THEN 'MODERATE' ELSE 'LOW' END AS tier, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, round(avg(label), 6) AS positive_rate FROM scored GROUP BY ALL""")
def tier_summary(spark: SparkSession, d: str) -> DataFrame:
    t = scored_labels(spark, d).withColumn("tier", metrics.tier(F.col("score"), F.lit(0.4), F.lit(0.7)))
    return t.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"), F.round(F.avg("label"), 6).alias("positive_rate"))


@query("", SCORED_SQL + """, u AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS place, count(*) OVER () AS n FROM (SELECT DISTINCT day FROM scored)), f AS (SELECT u.*, fold, n // 5 AS size, n - (4 - fold + 1) * (n // 5) AS begins FROM u CROSS JOIN (VALUES (1), (2), (3), (4)) t(fold)),
p AS (SELECT fold, CASE WHEN place < begins THEN 'train' WHEN place < begins + size THEN 'test' END AS part, day FROM f) SELECT fold, part, count(*) AS days, min(day) AS first, max(day) AS last FROM p WHERE part IS NOT NULL GROUP BY ALL""")
def time_folds(spark: SparkSession, d: str) -> DataFrame:
    """Expanding folds of four splits: their days."""
    return metrics.date_folds(scored_labels(spark, d), "day", 4).groupBy("fold", "part").agg(F.count(F.lit(1)).alias("days"), F.min("day").alias("first"), F.max("day").alias("last"))


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """df in the executors' memory or on their disks while a model learns from it; given back afterwards."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def slim(rows: DataFrame) -> DataFrame:
    """What a model learns from: the day of the outcome, the outcome, and the features."""
    return rows.select("next_inspected", "target", "features")


def logit(p: Column) -> Column:
    bounded = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.ln(bounded / (1 - bounded))


def platt(rows: DataFrame, score: str, label: str) -> tuple[float, float]:
    """Slope and intercept of a logistic curve over logits of scores."""
    data = VectorAssembler(inputCols=["__x"], outputCol="__v").transform(rows.select(logit(F.col(score)).alias("__x"), F.col(label).cast("double").alias("__y")))
    m = LogisticRegression(featuresCol="__v", labelCol="__y", regParam=1e-6, standardization=False).fit(data)
    return float(m.coefficients[0]), float(m.intercept)


def _assembled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = labelled(spark, d)
    train, _ = chronological(rows, "next_inspected", "2000-01-01")
    z = imputed_scaled(train, rows, NUMBERS)
    vectors = VectorAssembler(inputCols=guarded([f"z_{c}" for c in NUMBERS]), outputCol="features").transform(z)
    return chronological(vectors, "next_inspected", "2000-01-01")


#: Penalties and class weights that the logistic model is chosen from.
GRID = tuple((penalty, balanced) for penalty in (0.001, 0.01, 0.1) for balanced in (False, True))
FOLDS = 3


def weighted(rows: DataFrame, balanced: bool) -> DataFrame:
    """rows with weight: alike for all, or so that both classes weigh the same. One class alone keeps weight 1."""
    if not balanced:
        return rows.withColumn("weight", F.lit(1.0))
    n, p = rows.agg(F.count(F.lit(1)), F.sum("target")).first()
    p = p or 0
    return rows.withColumn("weight", F.when(F.col("target") == 1, F.lit(n / (2 * p) if 0 < p < n else 1.0)).otherwise(F.lit(n / (2 * (n - p)) if 0 < p < n else 1.0)))


def fitted_logistic(rows: DataFrame, penalty: float, balanced: bool):
    return LogisticRegression(labelCol="target", weightCol="weight", regParam=penalty, standardization=False, maxIter=50).fit(weighted(rows, balanced))


def fold_parts(rows: DataFrame, date: str, splits: int) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Rows to learn from and rows to score of each expanding fold by date that has both classes to learn from. They are held until the next fold.
    A part of a fold is a range of days, whose ends the driver gets, so that the rows stay where they are and later plans don't look for days again."""
    ends = metrics.date_folds(rows, date, splits).groupBy("fold", "part").agg(F.min(date), F.max(date)).collect()  # two rows a fold
    days = {(k, name): F.col(date).between(first, last) for k, name, first, last in ends}
    for k in range(1, splits + 1):
        part = lambda name, k=k: rows.where(days.get((k, name), F.lit(False)))
        with kept(part("train")) as train, kept(part("test")) as test:
            if train.select("target").distinct().limit(2).count() == 2:
                yield train, test


def out_of_fold(rows: DataFrame, date: str, fit, splits: int = FOLDS) -> DataFrame:
    """Rows of the test parts of expanding folds by date, each with p from a model of the days before it: what calibration and choice may look at."""
    out = None
    for train, test in fold_parts(rows, date, splits):
        scored = fit(train).transform(test).withColumn("p", vector_to_array(F.col("probability"))[1])
        out = scored if out is None else out.unionByName(scored)
    return rows.withColumn("p", F.lit(None).cast("double")).limit(0) if out is None else out.select(*rows.columns, "p")


def chosen_logistic(train: DataFrame, date: str = "next_inspected", grid: tuple[tuple[float, bool], ...] = GRID) -> tuple[float, bool, DataFrame]:
    """Of a grid what has the best average precision out of fold (the first of equals), and its out-of-fold rows. A tuning run
    for itself: it fits FOLDS models for each entry."""
    penalty, balanced = best_of(train, date, grid, lambda part, entry: fitted_logistic(part, *entry))
    return penalty, balanced, out_of_fold(train, date, lambda part: fitted_logistic(part, penalty, balanced)).select("target", "p")


def calibrated(p: Column, scored: DataFrame) -> Column:
    """p on the logistic curve that fits out-of-fold scores; p itself where they hold one class or none."""
    if scored.select("target").distinct().limit(2).count() < 2:
        return p
    slope, middle = platt(scored, "p", "target")
    return 1 / (1 + F.exp(-(F.lit(slope) * logit(p) + F.lit(middle))))


def contributions(coefficients, most: int = 3) -> Column:
    """The features that add most to a row's risk, as JSON."""
    parts = F.array(*[F.struct((F.lit(float(c)) * F.col(f"z_{n}")).alias("contribution"), F.lit(n).alias("feature")) for n, c in zip(NUMBERS, coefficients, strict=True)])
    down = F.array_sort(parts, lambda a, b: F.when(a["contribution"] > b["contribution"], -1).when(a["contribution"] < b["contribution"], 1).otherwise(0))
    return F.to_json(F.slice(F.filter(down, lambda x: x["contribution"] > 0), 1, most))


@query()
def logistic_scores(spark: SparkSession, d: str) -> DataFrame:
    """Calibrated risk of rows after the cutoff, their tier, and the three features that add most to it. The curve is fitted on
    out-of-fold scores."""
    train, test = _assembled(spark, d)
    with kept(slim(train)) as train:
        scored = out_of_fold(train, "next_inspected", lambda part: fitted_logistic(part, 0.01, False)).select("target", "p")
        risk = calibrated(vector_to_array(F.col("probability"))[1], scored)
        model = fitted_logistic(train, 0.01, False)
    return model.transform(test).select("restaurant_key", "inspected", "target", F.round(risk, 6).alias("risk"), contributions(model.coefficients).alias("factors")).withColumn("tier", metrics.tier(F.col("risk"), F.lit(0.45), F.lit(0.55)))


def coefficient_table(model, features: tuple[str, ...], spark: SparkSession) -> DataFrame:
    """feature, coefficient, size and direction, the greatest first."""
    rows = spark.createDataFrame([(n, float(c)) for n, c in zip(features, model.coefficients, strict=True)], "feature string, coefficient double")
    return rows.select("*", F.abs("coefficient").alias("magnitude"), F.when(F.col("coefficient") > 0, "raises").when(F.col("coefficient") < 0, "lowers").otherwise("none").alias("effect")).orderBy(F.desc("magnitude"), "feature")


@query()
def refreshed_scores(spark: SparkSession, d: str) -> DataFrame:
    """Current risk of every restaurant's latest row: the model learns from all rows whose outcome has matured by a day."""
    rows = labelled(spark, d)
    mature = rows.where(F.col("next_inspected") <= F.lit("2001-05-31").cast("date"))
    now = top_per_key(history_frame(daily(spark, d)), ["restaurant_key"], [F.desc("inspected")])
    known = scales(mature, NUMBERS)
    assembled = lambda df: VectorAssembler(inputCols=guarded([f"z_{c}" for c in NUMBERS]), outputCol="features").transform(scaled(df, known))
    with kept(slim(assembled(mature))) as train:
        scored = out_of_fold(train, "next_inspected", lambda part: fitted_logistic(part, 0.01, False)).select("target", "p")
        risk = calibrated(vector_to_array(F.col("probability"))[1], scored)
        model = fitted_logistic(train, 0.01, False)
    return model.transform(assembled(now)).select("restaurant_key", "inspected", F.round(risk, 6).alias("risk"), contributions(model.coefficients).alias("factors"))


def verified_scores(scores: DataFrame, key: str = "restaurant_key", risk: str = "risk") -> dict[str, int]:
    """What is wrong with a table of scores: rows without a key, keys met twice, risks missing or not from 0 to 1, and whether it is empty."""
    c = scores.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(risk).isNull() | ~F.col(risk).between(0, 1) | F.isnan(risk)).alias("bad"))
    r = c.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)), F.count_if((F.col("n") > 1) & F.col(key).isNotNull()), F.coalesce(F.sum("bad"), F.lit(0))).first()
    return {"empty": int(r[0] == 0), "no_key": r[1], "repeated": r[2], "risk": r[3]}


def promoted(spark: SparkSession, scores: str, pointer: str, state: str) -> bool:
    """Points to a table of scores if the monitor's state isn't FAIL and the table is sound; else nothing changes. Pointers are versions, the last counts."""
    if state == "FAIL" or any(verified_scores(spark.read.parquet(scores)).values()):
        return False
    before = promoted_path(spark, pointer)
    version = 0 if before is None else before[0] + 1
    spark.createDataFrame([(version, scores)], "version int, scores string").coalesce(1).write.mode("append").parquet(pointer)
    return True


def promoted_path(spark: SparkSession, pointer: str) -> tuple[int, str] | None:
    from millrace.sources.sinks import path_exists

    if not path_exists(spark, pointer):
        return None
    row = spark.read.parquet(pointer).orderBy(F.desc("version")).first()
    return row["version"], row["scores"]


def fitted_trees(rows: DataFrame, depth: int = 3, rounds: int = 10, pace: float = 0.1):
    """Boosted trees; with one class alone they score all rows alike."""
    return GBTClassifier(labelCol="target", maxIter=rounds, maxDepth=depth, stepSize=pace, subsamplingRate=0.8, featureSubsetStrategy="0.8", minInstancesPerNode=5, seed=42).fit(rows)


#: Depth, rounds and pace that the trees are chosen from.
TREE_GRID = tuple((depth, rounds, pace) for depth in (2, 3) for rounds in (5, 10) for pace in (0.05, 0.1))


@query()
def gbt_scores(spark: SparkSession, d: str) -> DataFrame:
    """Risk by boosted trees of rows after the cutoff."""
    train, test = _assembled(spark, d)
    return fitted_trees(train).transform(test).select("restaurant_key", "inspected", "target", F.round(vector_to_array(F.col("probability"))[1], 6).alias("risk"))


def explained(model, rows: DataFrame, names: tuple[str, ...] = NUMBERS) -> DataFrame:
    """rows with margin, bias, parts (what each feature adds to the margin) and factors (the three that raise it most)."""
    nodes = trees.nodes_of(model)
    told = model.transform(rows).withColumn("__v", vector_to_array(F.col("features")))
    parts = trees.contributions(nodes, F.col("__v"), names)
    out = told.select(*rows.columns, vector_to_array(F.col("rawPrediction"))[1].alias("margin"), F.lit(trees.bias(nodes)).alias("bias"), vector_to_array(F.col("probability"))[1].alias("p"), parts.alias("parts"))
    return out.withColumn("factors", trees.greatest(F.col("parts")))


@query()
def tree_factors(spark: SparkSession, d: str) -> DataFrame:
    """Risk by boosted trees of rows after the cutoff, calibrated on out-of-fold scores, with the three features that raise it most."""
    train, test = _assembled(spark, d)
    with kept(slim(train)) as train:
        scored = out_of_fold(train, "next_inspected", fitted_trees).select("target", "p")
        risk = calibrated(F.col("p"), scored)
        model = fitted_trees(train)
    return explained(model, test).select("restaurant_key", "inspected", "target", F.round(risk, 6).alias("risk"), "factors")


def chosen_trees(train: DataFrame, date: str = "next_inspected", grid: tuple[tuple[int, int, float], ...] = TREE_GRID) -> tuple[int, int, float]:
    """Of a grid what has the best average precision out of fold, the first of equals. A tuning run: two models for each entry."""
    return best_of(train, date, grid, lambda part, entry: fitted_trees(part, *entry), 2)


MEASURES = "n long, average_precision double, auc double, brier double"


def grid_rows(train: DataFrame, date: str, grid, fit, splits: int = FOLDS) -> list[tuple]:
    """For each entry of a grid the MEASURES of its out-of-fold scores; nulls where no fold has both classes to learn from."""
    scored = None
    for train_, test in fold_parts(train, date, splits):
        for i, entry in enumerate(grid):
            p = fit(train_, entry).transform(test).select(F.lit(i).alias("entry"), "target", vector_to_array(F.col("probability"))[1].alias("p"))
            counted = metrics.by_score(p, "p", "target", ["entry"])
            scored = counted if scored is None else scored.unionByName(counted)
    found = {} if scored is None else {r["entry"]: r for r in metrics.ranked(scored, ["entry"]).collect()}  # a row per entry
    return [tuple(found[i][m] for m in ("n", "average_precision", "auc", "brier")) if i in found else (0, None, None, None) for i in range(len(grid))]


def best_of(train: DataFrame, date: str, grid, fit, splits: int = FOLDS):
    """The entry with the best average precision, the first of equals."""
    found = grid_rows(train, date, grid, fit, splits)
    return grid[max(range(len(grid)), key=lambda i: (round(found[i][1] or 0.0, 9), -i))]


@query()
def logistic_grid(spark: SparkSession, d: str) -> DataFrame:
    """Measures of every penalty and weighting that the logistic model is chosen from, on the later half of the days before the cutoff."""
    train, _ = _assembled(spark, d)
    with kept(slim(train)) as train:
        found = grid_rows(train, "next_inspected", GRID, lambda part, e: fitted_logistic(part, *e), 1)
    return spark.createDataFrame([(*e, *m) for e, m in zip(GRID, found, strict=True)], f"penalty double, balanced boolean, {MEASURES}")


@query()
def tree_grid(spark: SparkSession, d: str) -> DataFrame:
    """Measures of every depth, number of rounds and pace that the trees are chosen from, on the later half of the days before the cutoff."""
    train, _ = _assembled(spark, d)
    with kept(slim(train)) as train:
        found = grid_rows(train, "next_inspected", TREE_GRID, lambda part, e: fitted_trees(part, *e), 1)
    return spark.createDataFrame([(*e, *m) for e, m in zip(TREE_GRID, found, strict=True)], f"depth int, rounds int, pace double, {MEASURES}")


SUBGROUPS = {"month": 30, "area": 30, "cuisine": 75}


def subgroups(scored: DataFrame, score: str, label: str, least: dict[str, int] = SUBGROUPS) -> DataFrame:
    """kind, value and the metrics of every subgroup of a least size, for all kinds in one pass: rows shrink to one per
    subgroup and score first. A subgroup of one class has no AUC and no precision; a null value is a group of its own."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in least))).alias("g")
    told = metrics.ranking(scored.select(score, label, each).select(score, label, "g.kind", "g.value"), score, label, ["kind", "value"])
    enough = F.create_map(*(F.lit(x) for kv in least.items() for x in kv))
    return told.where(F.col("n") >= enough[F.col("kind")])


@query("areas restaurants", SCORED_SQL + """, labelled AS (SELECT score, label, strftime(o_orderdate::DATE, '%Y-%m') AS month, area_name AS area, cuisine FROM scored JOIN orders ON o_orderkey = key LEFT JOIN restaurants ON restaurant_key = o_custkey LEFT JOIN areas USING (area_key)),
g AS (SELECT 'month' AS kind, month AS value, score, label FROM labelled UNION ALL SELECT 'area', area, score, label FROM labelled UNION ALL SELECT 'cuisine', cuisine, score, label FROM labelled),
r AS (SELECT *, (rank() OVER (PARTITION BY kind, value ORDER BY score) + (count(*) OVER (PARTITION BY kind, value, score) - 1) / 2) AS rk, sum(label) OVER (PARTITION BY kind, value ORDER BY score DESC RANGE UNBOUNDED PRECEDING) AS above, count(*) OVER (PARTITION BY kind, value ORDER BY score DESC RANGE UNBOUNDED PRECEDING) AS seen FROM g)
SELECT kind, value, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, CASE WHEN sum(label) BETWEEN 1 AND count(*) - 1 THEN round((sum(CASE WHEN label = 1 THEN rk END) - sum(label) * (sum(label) + 1) / 2) / nullif(sum(label) * (count(*) - sum(label)), 0), 6)::DOUBLE END AS auc,
    CASE WHEN sum(label) BETWEEN 1 AND count(*) - 1 THEN round(sum(CASE WHEN label = 1 THEN above / seen END) / nullif(sum(label), 0), 6)::DOUBLE END AS average_precision, round(avg(pow(score - label, 2)), 6) AS brier FROM r GROUP BY kind, value HAVING count(*) >= CASE kind WHEN 'cuisine' THEN 75 ELSE 30 END""")
def subgroup_metrics(spark: SparkSession, d: str) -> DataFrame:
    """How a score does by month, area and cuisine, where these have enough rows."""
    own = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("restaurant_key"))
    rows = scored_labels(spark, d).join(own, "key").join(restaurants(spark, d).select("restaurant_key", "cuisine", "area_key"), "restaurant_key", "left").join(areas(spark, d), "area_key", "left")
    scored = rows.select("score", "label", F.date_format("day", "yyyy-MM").alias("month"), F.col("area_name").alias("area"), "cuisine")
    return rounded(subgroups(scored, "score", "label")).drop("log_loss")


def monitored(quality: dict, baseline_rate: float, area_aucs: dict[str, float], shares: dict[str, tuple[float, float]]) -> tuple[str, dict[str, str]]:
    """PASS, WARN or FAIL over a model's figures, and the state of each gate."""
    gates = {
        "auc": "PASS" if quality["auc"] >= 0.65 else "FAIL", "high_precision": "PASS" if quality["high_precision"] >= 0.20 else "FAIL", "watch_recall": "PASS" if quality["watch_recall"] >= 0.60 else "FAIL",
        "brier": "PASS" if quality["brier"] < baseline_rate * (1 - baseline_rate) else "FAIL",
    }
    gates |= {f"area_{a}": "PASS" if v >= 0.55 else "WARN" for a, v in area_aucs.items()}
    for name, (now, then) in shares.items():
        r = share_ratio(now, then)
        gates[f"share_{name}"] = "PASS" if r is not None and 0.5 <= r <= 2 else "WARN"
    return ("FAIL" if "FAIL" in gates.values() else "WARN" if "WARN" in gates.values() else "PASS"), gates


def share_ratio(now: float, then: float) -> float | None:
    return None if then == 0 else now / then


def chosen(logistic: dict, trees: dict) -> str:
    """Trees only if they are about as well calibrated, have the better F1 and no less recall."""
    better = trees["brier"] <= 1.10 * logistic["brier"] and trees["f1"] > logistic["f1"] and trees["recall"] >= logistic["recall"]
    return "trees" if better else "logistic"
