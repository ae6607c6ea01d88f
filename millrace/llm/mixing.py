"""Mixing sources to target weights by capped water-filling, in DataFrame operations alone.

Each source gets a share of all words in proportion to its weight. A source whose share is over
`max_epochs` times its size is clamped there and the excess goes to the others by weight, until none is
above. Sorting the sources by max_epochs * size / weight turns the loop into one pass of running sums:
the clamped sources are a head of that order.

A document is then taken floor(target / size of source) times, and once more if it stands early enough in
the source's seeded order: the documents whose middle lies below the fraction still wanted. The order is
that of an MD5 of seed and doc_id. Its place in the order is found in two steps, so that no task sorts a
whole source: sums over BUCKETS slices of the hash range, then a running sum inside the one slice in
which the fraction ends. Reruns agree, whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, scratch, stored

#: Slices of the hash range: three hex digits.
HEX = 3


def words_in(text: Column) -> Column:
    """Number of words: each is squeezed to one letter, with the white space before it."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]*[^{SPACE}]+", "w")
    return F.length(F.rtrim(squeezed, F.lit(" \t\n\x0b\f\r"))).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: float = 3) -> DataFrame:
    """sizes: source, source_size; a row per source. Adds target (double), whole, part (words of the last, partial epoch)."""
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1)
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    ranked = sizes.withColumn("weight", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    below = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    run = (
        ranked.withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("capped", F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0)))
        .withColumn("level", (F.col("all_words") - F.col("capped")) / F.col("open_weight"))
    )
    # the first source in order that its level doesn't clamp: from there on all get that level
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", F.col("source").isNull().alias("last"), "source", "level"))).over(everything)["level"]
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(F.col("cap"), F.coalesce(level, F.lit(0.0)) * F.col("weight")))
    filled = run.withColumn("target", target)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return filled.withColumn("whole", epochs).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")).select("source", "source_size", "target", "whole", "part")


def mixture(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: float = 3, seed: str = "mix", text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """A row per document: doc_id, size, source_size, target, repeats, taken.

    size counts words; a null text has none. Sources stand in order of code points, null last, as a source
    of its own; weights repeat along that order. Documents of no words are taken `whole` times as well, as
    repeats; they count nothing. Rows with the same doc_id share their place in the order. An empty table
    gives an empty result.
    """
    return _placed(docs, weights, max_epochs, seed, text, source, doc_id).drop("source")


def _placed(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: float = 3, seed: str = "mix", text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    spread = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words_in(F.col(text)).alias("size")).withColumn("place", spread)
    # the texts are read once; from here on rows are small
    sized = stored(sized.withColumn("slice", F.substring("place", 1, HEX)), scratch(docs.sparkSession, "mixing"))
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    goals = targets(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, max_epochs)
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        slices.withColumn("slice_start", F.coalesce(F.sum("slice_size").over(before), F.lit(0)))
        .join(goals.withColumnRenamed("source", "goal"), F.col("source").eqNullSafe(F.col("goal")))
        .withColumn("ends", (F.col("slice_start") < F.col("part")) & (F.col("part") < F.col("slice_start") + F.col("slice_size")))
        .drop("goal")
        .withColumnRenamed("source", "goal")
        .withColumnRenamed("slice", "cut")
    )
    joined = sized.join(placed, F.col("source").eqNullSafe(F.col("goal")) & (F.col("slice") == F.col("cut")))
    inside = Window.partitionBy("source", "slice").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("slice_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("size") / 2
    extra = F.when(F.col("ends"), middle < F.col("part")).otherwise(F.col("slice_start") + F.col("slice_size") <= F.col("part"))
    repeats = F.least(F.col("whole") + extra.cast("long"), F.lit(int(max_epochs))).cast("long")
    return joined.select("doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"), (repeats * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mixture takes them: each row as many times as it is repeated, with all its columns. An empty table gives none.

    Rows are found by doc_id, source and size; a null is a value. Of rows alike in these, as many are taken once more as in the
    mixture: one group of a source at most is cut so, and its rows are numbered by a hash of their texts.
    """
    rows = _placed(docs, **options)
    groups = rows.groupBy("doc_id", "source", "size").agg(F.min("repeats").alias("low"), F.max("repeats").alias("high"), F.sum("repeats").alias("all"), F.count(F.lit(1)).alias("n"))
    groups = stored(groups.select(F.col("doc_id").alias("id"), F.col("source").alias("of"), F.col("size").alias("long"), "low", "high", (F.col("all") - F.col("low") * F.col("n")).alias("more")), scratch(docs.sparkSession, "mixed"))
    whole = docs.select(F.struct(*docs.columns).alias("row"), docs["doc_id"].alias("doc_id"), docs["source"].alias("source"), words_in(docs["text"]).alias("size"))
    joined = whole.join(groups.where("high > 0"), F.col("doc_id").eqNullSafe(F.col("id")) & F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("long")))
    even = joined.where("low = high").select("row", F.col("low").alias("times"))
    if groups.where("low < high").limit(1).count():
        nth = F.row_number().over(Window.partitionBy("id", "of", "long").orderBy(F.xxhash64("row.text")))
        cut = joined.where("low < high").select("row", "low", "high", "more", nth.alias("nth"))
        even = even.unionByName(cut.select("row", F.when(F.col("nth") <= F.col("more"), F.col("high")).otherwise(F.col("low")).alias("times")))
    return even.where("times > 0").select("row", F.explode(F.expr("sequence(1, int(times))")).alias("k")).select("row.*")
