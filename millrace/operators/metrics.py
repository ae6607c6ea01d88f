"""Classifier metrics over (score, label) rows, as aggregates and windows over distinct scores.

Rows first shrink to one per score and segment. Running sums over scores are made in two steps, so that no
task orders all of them: over slices of the range of scores, then inside each slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import ratio


def by_score(df: DataFrame, score: str, label: str, segments: list[str] | None = None) -> DataFrame:
    """segments, score, n, positives: of each distinct score."""
    return df.groupBy(*(segments or []), F.col(score).alias("score")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("positives"))


SLICES = 4096


def running(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Adds tp and seen (positives and rows at this score and above), all_p and all_n, within keys."""
    sliced = counts.withColumn("__slice", F.floor(F.col("score") * SLICES))
    total = sliced.groupBy(*keys, "__slice").agg(F.sum("n").alias("__n"), F.sum("positives").alias("__p"))
    before = Window.partitionBy(*keys).orderBy(F.desc("__slice")).rowsBetween(Window.unboundedPreceding, -1)
    whole, none = Window.partitionBy(*keys), F.lit(0)
    total = total.select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col("__slice").alias("__of"), F.coalesce(F.sum("__p").over(before), none).alias("__above_p"), F.coalesce(F.sum("__n").over(before), none).alias("__above_n"),
        F.sum("__p").over(whole).alias("all_p"), F.sum("__n").over(whole).alias("all_n"),
    )
    same = F.col("__slice").eqNullSafe(F.col("__of"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    inside = Window.partitionBy(*keys, "__slice").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    run = sliced.withColumns({"__tp": F.sum("positives").over(inside), "__seen": F.sum("n").over(inside)}).join(total, same)
    return run.select(*keys, "score", "n", "positives", (F.col("__above_p") + F.col("__tp")).alias("tp"), (F.col("__above_n") + F.col("__seen")).alias("seen"), "all_p", "all_n")


def ranking(df: DataFrame, score: str, label: str, segments: list[str] | None = None) -> DataFrame:
    """A row per segment: n, positives, auc, average_precision, brier, log_loss; AUC and precision are null with one class only."""
    return ranked(by_score(df, score, label, segments), segments)


def ranked(counts: DataFrame, segments: list[str] | None = None) -> DataFrame:
    """As ranking, from rows (segments, score, n, positives), which may repeat a score."""
    keys = segments or []
    run = running(counts.groupBy(*keys, "score").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives")), keys)
    negatives = F.col("n") - F.col("positives")
    # a negative loses to all positives above it, and to half of those with its score
    wins = negatives * (F.col("tp") - F.col("positives") + F.col("positives") / 2)
    p = F.least(F.greatest(F.col("score"), F.lit(1e-15)), F.lit(1 - 1e-15))
    out = run.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("positives").alias("positives"),
        ratio(F.sum(wins), F.max("all_p") * (F.max("all_n") - F.max("all_p"))).alias("auc"),
        ratio(F.sum(F.col("positives") * F.col("tp") / F.col("seen")), F.max("all_p")).alias("average_precision"),
        ratio(F.sum(F.col("positives") * F.pow(1 - F.col("score"), F.lit(2.0)) + negatives * F.pow(F.col("score"), F.lit(2.0))), F.sum("n")).alias("brier"),
        ratio(-F.sum(F.col("positives") * F.ln(p) + negatives * F.ln(1 - p)), F.sum("n")).alias("log_loss"),
    )
    one = (F.col("positives") == 0) | (F.col("positives") == F.col("n"))
    return out.withColumns({c: F.when(~one, F.col(c)) for c in ("auc", "average_precision")})


def confusion(df: DataFrame, score: str, label: str, threshold: float, segments: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1 at a threshold; a ratio without cases is 0."""
    hit, true = F.col(score) >= threshold, F.col(label) == 1
    c = df.groupBy(*(segments or [])).agg(*[F.count_if(r).alias(n) for n, r in (("tp", hit & true), ("fp", hit & ~true), ("fn", ~hit & true), ("tn", ~hit & ~true))])
    zero = lambda a, b: F.coalesce(ratio(a, b), F.lit(0.0))
    return c.withColumns({"precision": zero(F.col("tp"), F.col("tp") + F.col("fp")), "recall": zero(F.col("tp"), F.col("tp") + F.col("fn")), "f1": zero(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))})


def thresholds(df: DataFrame, score: str, label: str, least_precision: float = 0.35, least_recall: float = 0.80) -> DataFrame:
    """One row: moderate, high. high has the best F1 (the least such score), or is the first score from there on with
    least_precision; moderate is below it, has least_recall and the best precision (the greatest such score), or is high / 2."""
    c = running(by_score(df, score, label), [])
    c = c.withColumns({"precision": ratio(F.col("tp"), F.col("seen")), "recall": F.coalesce(ratio(F.col("tp"), F.col("all_p")), F.lit(1.0))})
    c = c.withColumn("f1", F.coalesce(ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
    first = F.broadcast(c.agg((-F.max(F.struct("f1", (-F.col("score")).alias("low")))["low"]).alias("first")))  # one row
    ok = (F.col("precision") >= least_precision) & (F.col("score") >= F.col("first")) & (F.col("recall") > 0)
    high = F.broadcast(c.crossJoin(first).groupBy("first").agg(F.min(F.when(ok, F.col("score"))).alias("h")).select(F.coalesce("h", "first").alias("high")))
    pick = F.max(F.when((F.col("recall") >= least_recall) & (F.col("score") < F.col("high")), F.struct("precision", "score")))
    return c.crossJoin(high).groupBy("high").agg(pick.alias("m")).select(F.coalesce("m.score", F.greatest(F.lit(0.0), F.col("high") / 2)).alias("moderate"), "high")


def tier(score: Column, moderate: Column, high: Column) -> Column:
    return F.when(score >= high, "HIGH").when(score >= moderate, "MODERATE").otherwise("LOW")


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """name, share, value: exact quantiles of columns, between two values by interpolation; a column without values has no row.

    Values are counted first. Running sums over SLICES stretches between the least and the greatest value, then within a
    stretch, find the ranks, so no task holds all values."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select("x.*").where("v IS NOT NULL")
    counts = long.groupBy("name", "v").agg(F.count(F.lit(1)).alias("n"))
    ends = counts.groupBy(F.col("name").alias("of")).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum("n").alias("all"))
    place = F.when(F.col("high") > F.col("low"), F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * SLICES)).otherwise(0)
    sliced = counts.join(F.broadcast(ends), F.col("name") == F.col("of")).withColumn("slice", place)  # a row per column
    before = Window.partitionBy("name").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sliced.groupBy("name", "slice").agg(F.sum("n").alias("here")).withColumn("start", F.coalesce(F.sum("here").over(before), F.lit(0))).drop("here")
    inside = Window.partitionBy("name", "slice").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sliced.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(starts, ["name", "slice"]).withColumn("first", F.col("start") + F.col("within"))
    asked = ranked.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares]))).withColumn("at", F.col("share") * (F.col("all") - 1))
    holds = lambda r: (F.col("first") <= r) & (r < F.col("first") + F.col("n"))
    hit = asked.where(holds(F.floor("at")) | holds(F.ceil("at"))).groupBy("name", "share", "at").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    return hit.select("name", "share", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))).alias("value"))


def calibration(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """bin, n, mean_score, positive_rate: of bins at exact quantiles of the scores; edges that coincide are one edge."""
    edges = quantiles(df, [score], [i / bins for i in range(1, bins)]).agg(F.array_sort(F.collect_set("value")).alias("edges"))  # bins - 1 values
    placed = df.crossJoin(F.broadcast(edges)).withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col(score))))
    return placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("positive_rate"))


def date_folds(df: DataFrame, date: str, splits: int) -> DataFrame:
    """Expanding folds over distinct dates: adds nothing; returns date, fold, part ('train' or 'test'). No date is in two parts of a fold."""
    dates = df.select(date).distinct()
    ranked = dates.withColumn("__at", F.row_number().over(Window.orderBy(date)) - 1).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy()))
    size = F.floor(F.col("__n") / (splits + 1))
    folds = ranked.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(splits)))).withColumn("__start", F.col("__n") - (splits - F.col("fold") + 1) * size)
    part = F.when(F.col("__at") < F.col("__start"), "train").when(F.col("__at") < F.col("__start") + size, "test")
    return folds.withColumn("part", part).where("part IS NOT NULL").select(date, "fold", "part")
