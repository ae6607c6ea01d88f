"""Exact duplicates by a log-structured merge index of text digests.

Each task of `append` is a memtable: it merges the digests of its documents, sorts them and flushes them as an
immutable run (a Parquet file with a Bloom filter on the digest and min/max statistics). Of equal digests a run
keeps the identifier that stays, chosen as most code points, then smallest doc_id, and the number of rows. A new
batch is looked up in the earlier runs: few digests by pushed-down equalities, for which filters and statistics
let Parquet pass over runs and row groups, more of them by a join. FAN runs of a level are compacted into one run
of the next level, whose files hold ranges of digests. Digests met more than once are hits; hits are verified on
the bytes of the normalised texts. A manifest beside the runs lets an index be opened again for the next batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, scratch, stored
from millrace.llm.runs import Runs, sorted_run

RUN = "digest long, sha string, keep_id long, keep_size long, group_size long"
#: Digests that a lookup pushes down, at most; and how many in one scan (Parquet readers turn longer lists into ranges).
FEW, TOGETHER = 60, 10


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", "")


def digested(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """digest, sha, doc_id, size: of every row."""
    words = docs.select(F.col(doc_id).cast("long").alias("doc_id"), normalised(F.col(text)).alias("words"), F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("size"))
    return words.select(F.xxhash64("words").alias("digest"), F.sha2(F.col("words").cast("binary"), 256).alias("sha"), "doc_id", "size")


class DigestIndex(Runs):
    """Runs of RUN, sorted by digest."""

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> DigestIndex:
        """The index that an earlier job left at path."""
        return cls(spark, path, *cls.manifest(spark, path))

    def _read(self, run: str) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(run)

    def append(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> None:
        """Adds a batch of documents."""
        self.append_digested(digested(docs, text, doc_id))

    def append_digested(self, rows: DataFrame) -> None:
        """Flushes a batch (rows of `digested`) as a sorted run, and compacts levels that are full."""
        own = rows.select("digest", "sha", F.col("doc_id").alias("keep_id"), F.col("size").alias("keep_size"), F.lit(1).cast("long").alias("group_size"))
        self.levels[0].append(sorted_run(_merged(own), self.place(0), ("digest", "sha"), ranged=False))
        self.settle()

    def merge(self, runs: list[str], level: int) -> str:
        merged = stored(_merged(reduce(DataFrame.unionByName, map(self._read, runs))), scratch(self.spark, "merged"))
        return sorted_run(merged, self.place(level), ("digest", "sha"), ranged=True)

    def lookup(self, digests: DataFrame) -> DataFrame:
        """RUN: what the index holds of digests (digest). Few are pushed down to the runs, more are joined with them; the result is the same."""
        wanted = digests.select("digest").distinct()
        few = sorted(r[0] for r in wanted.limit(FEW + 1).collect())
        if len(few) > FEW:
            found = [self._read(run).join(wanted, "digest", "left_semi") for run in self.every()]
        else:
            found = [self._read(run).where(F.col("digest").isin(few[at : at + TOGETHER])) for run in self.every() for at in range(0, len(few), TOGETHER)]
        return _merged(reduce(DataFrame.unionByName, found)) if found else self.spark.createDataFrame([], RUN)

    def seen(self, rows: DataFrame) -> DataFrame:
        """rows of `digested`, not yet appended, whose text the index holds: their columns, keep_id, keep_size, group_size."""
        return rows.join(self.lookup(rows), ["digest", "sha"])

    def compact(self) -> DataFrame:
        """RUN: every digest of the index once; all runs are merged into one of the last level."""
        if len(self.every()) > 1:
            self.levels = [[] for _ in self.levels] + [[self.merge(self.every(), len(self.levels))]]
            self.save()
        return self._read(self.every()[0]) if self.every() else self.spark.createDataFrame([], RUN)


def _merged(runs: DataFrame) -> DataFrame:
    """Of equal digests the row that stays, most code points first, then the smallest identifier, null last; numbers of rows add up."""
    best = F.min(F.struct((-F.col("keep_size")).alias("size"), F.col("keep_id").isNull().alias("none"), F.col("keep_id").alias("id")))
    one = runs.groupBy("digest", "sha").agg(best.alias("best"), F.sum("group_size").alias("group_size"))
    return one.select("digest", "sha", F.col("best.id").alias("keep_id"), (-F.col("best.size")).alias("keep_size"), "group_size")


def verify(docs: DataFrame, groups: DataFrame, text: str = "text") -> None:
    """Byte verification of hits: rows of one digest must be one text. A text is shuffled only where its
    digest was met more than once. Raises if two different texts share a digest."""
    hits = groups.where("group_size > 1").select("sha")
    words = docs.select(normalised(F.col(text)).alias("words")).withColumn("sha", F.sha2(F.col("words").cast("binary"), 256))
    texts = words.join(hits, "sha", "left_semi").groupBy("sha", "words").agg(F.lit(1).alias("one"))
    if texts.groupBy("sha").count().where("count > 1").limit(1).count():
        raise ValueError("different texts share a digest; raise the digest's width")


def indexed(docs: DataFrame, batches: int, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Rows of `digested`, and the groups of an index to which they were appended in batches."""
    spark = docs.sparkSession
    rows = stored(digested(docs, text, doc_id), scratch(spark, "digests"))
    index = DigestIndex(spark, scratch(spark, "digest-index"))
    for b in range(batches):
        index.append_digested(rows.where(F.pmod(F.xxhash64("sha", "doc_id"), F.lit(batches)) == b))
    return rows, index.compact()


def exact_duplicates(docs: DataFrame, batches: int = 2, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text, in hex).

    Texts are equal when they are without ASCII white space; null counts as empty, and empty texts are
    equal. Of equal texts the one with most code points stays, then the smallest doc_id, a null doc_id
    last. Rows that repeat a doc_id and text count each and share their flag. An empty table gives none.
    """
    rows, groups = indexed(docs, batches, text, doc_id)
    verify(docs, groups, text)
    joined = rows.join(groups, ["digest", "sha"])
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("size") == F.col("keep_size"))
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, batches: int = 2) -> DataFrame:
    """The documents that stay, with all their columns: one row for each distinct normalised text, chosen as in
    exact_duplicates; of rows that repeat doc_id and text, any one. An empty table gives none.

    Texts are shuffled once, by digest, doc_id and size. Only where a row that stays is repeated are rows told apart by a second one.
    """
    rows, groups = indexed(docs, batches)
    verify(docs, groups)
    on = ["sha", "doc_id", "size"]
    best = groups.select("sha", F.col("keep_id").alias("doc_id"), F.col("keep_size").alias("size"))
    same = rows.join(best, (rows["sha"] == best["sha"]) & rows["doc_id"].eqNullSafe(best["doc_id"]) & (rows["size"] == best["size"]), "left_semi").groupBy(*on).agg(F.count(F.lit(1)).alias("same"))
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.sha2(normalised(docs["text"]).cast("binary"), 256).alias("sha"), docs["doc_id"].cast("long").alias("doc_id"), F.length(F.coalesce(docs["text"], F.lit(""))).cast("long").alias("size"))
    same = stored(same, scratch(docs.sparkSession, "digest-best"))
    keep = same.select(*(F.col(c).alias(f"{c}_") for c in on), "same")
    stay = whole.join(keep, (F.col("sha") == F.col("sha_")) & F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("size") == F.col("size_"))).select("sha", "same", "row")
    if not same.where("same > 1").limit(1).count():
        return stay.select("row.*")
    again = stay.where("same > 1").dropDuplicates(["sha"])
    return stay.where("same = 1").unionByName(again).select("row.*")
