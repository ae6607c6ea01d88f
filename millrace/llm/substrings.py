"""Removal of word windows that stand anywhere else too, by a log-structured fingerprint index.

A window is `window` words in a row. All windows of a corpus are too many to move, so each is represented
by its least hash of ANCHOR words in a row: equal windows have equal anchors, and neighbours mostly share
theirs. The index holds the anchors. Each batch of documents is fingerprinted where it lies and flushed as an
immutable run sorted by fingerprint; the runs of earlier batches are merge-joined with it, which finds the anchors
that stand in both. FAN runs of a level are compacted into one of the next, whose files hold ranges of
fingerprints. Only windows whose anchor occurs twice can occur twice. Those windows are then verified one by one
on 96 bits of hash over all their words: a count finds the windows that stand alone, which are few and come back
with their one place. All others are repeats, and the words they cover are removed.

`without_repeats` judges a whole table. `deduplicated` takes the next batch only: it is judged on itself and on the
earlier documents that share an anchor with it, whose texts the index keeps.

Copies of a whole text are counted, not repeated: windows are emitted once per text with the number of
its copies as weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import scratch, small_batches, stored
from millrace.llm.runs import Runs, sorted_run
from millrace.llm.words import mixed, row_of, run_hashes, slid, word_hashes

ANCHOR = 8
RUN = "fp long, key long"


def anchored(texts: pa.Array, window: int) -> tuple[np.ndarray, ...]:
    """Words' hashes, texts' offsets, anchors' hashes by position, and for each window start its anchor's hash (0 where no window fits)."""
    h, offsets = word_hashes(texts)
    a = run_hashes(h, ANCHOR) | np.uint64(1)
    least = slid(a, window - ANCHOR + 1) if len(h) >= window else np.zeros(0, np.uint64)
    end = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    least = np.where(np.arange(len(least)) + window <= end, least, np.uint64(0))
    return h, offsets, a, least


def fingerprints(texts: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchors that stand for some window: hash and text number, one for each place."""
    _, offsets, a, least = anchored(texts, window)
    if not len(least):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    span = window - ANCHOR + 1
    around = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    most = slid(around, span, np.maximum)[: len(a)]  # of the windows that hold a place, the greatest least hash
    at = np.flatnonzero((most == a[: len(most)]) & (most > 0))
    return a[at].astype(np.int64), row_of(offsets)[at]


class FingerprintIndex(Runs):
    """Runs of RUN, sorted by fingerprint, and beside them the anchors of each batch that stand elsewhere too."""

    def __init__(self, spark: SparkSession, path: str, window: int, levels: list[list[str]] | None = None, made: int = 0):
        super().__init__(spark, path, levels, made)
        self.window, self.again = window, []

    @classmethod
    def open(cls, spark: SparkSession, path: str, window: int) -> FingerprintIndex:
        """The index that an earlier job left at path."""
        return cls(spark, path, window, *cls.manifest(spark, path))

    def append(self, keyed: DataFrame) -> DataFrame:
        """keyed: key, text. Flushes a batch's anchors as a sorted run. Returns the batch's anchors, fp, that stand elsewhere in the batch or in earlier runs."""
        window = self.window

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in small_batches(batches, "text", 1 << 20):
                fp, text = fingerprints(b.column("text"), window)
                yield pa.RecordBatch.from_arrays([pa.array(fp), b.column("key").take(pa.array(text))], ["fp", "key"])

        to = sorted_run(keyed.select("key", "text").mapInArrow(run, RUN), self.place(0), ("fp", "key"), ranged=False)
        own = self._read(to).groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
        found = own.where("n > 1").select("fp")
        for earlier in self.every():
            found = found.unionByName(own.where("n = 1").select("fp").join(self._read(earlier).select("fp").distinct(), "fp", "left_semi"))
        self.again.append(f"{self.path}/again/{to.rpartition('/')[2]}")
        found.distinct().write.parquet(self.again[-1])
        self.levels[0].append(to)
        self.settle()
        return self.spark.read.schema("fp long").parquet(self.again[-1])

    def merge(self, runs: list[str], level: int) -> str:
        return sorted_run(self._read(*runs), self.place(level), ("fp", "key"), ranged=True)

    def _read(self, *runs: str) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(*runs)

    def places(self) -> DataFrame:
        return self._read(*self.every())

    def repeated(self) -> DataFrame:
        """fp: the anchors with more than one place, of the batches that this object took."""
        return self.spark.read.schema("fp long").parquet(*self.again).distinct()


def candidates(texts: pa.Array, fps: pa.ListArray, window: int) -> tuple[np.ndarray, ...]:
    """Words' hashes, texts' offsets, and the positions at which windows start whose anchor is among their text's fps."""
    h, offsets, _, least = anchored(texts, window)
    per = np.asarray(pa.compute.fill_null(fps.value_lengths(), 0))
    with np.errstate(over="ignore"):
        salt = mixed(np.arange(len(per), dtype=np.uint64))
        known = np.unique(fps.flatten().to_numpy(zero_copy_only=False).astype(np.uint64) ^ np.repeat(salt, per))
        sought = least ^ salt[row_of(offsets)[: len(least)]]
    if not len(known) or not len(least):
        return h, offsets, np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, sought), len(known) - 1)
    return h, offsets, np.flatnonzero((known[at] == sought) & (least > 0))


def indexed(keyed: DataFrame, window: int, batches: int) -> FingerprintIndex:
    """An index to which keyed (key, key2, text) was appended in batches."""
    index = FingerprintIndex(keyed.sparkSession, scratch(keyed.sparkSession, "fingerprints"), window)
    for b in range(batches):
        index.append(keyed.where(F.pmod(F.col("key2"), F.lit(batches)) == b))
    return index


def shared_anchors(keyed: DataFrame, places: DataFrame, again: DataFrame) -> DataFrame:
    """keyed: key, key2 (two hashes of the text), doc_id, text. A row per distinct text with anchors among again (fp): key, key2,
    fps, no (its number), of (a doc_id that has it), weight (its copies, for each row of that doc_id)."""
    anchors = places.join(again, "fp", "left_semi").groupBy("key").agg(F.collect_set("fp").alias("fps"))
    ids = keyed.groupBy("key", "key2", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    copies = ids.groupBy("key", "key2").agg(F.sum("n").alias("copies"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("of"), F.col("n").alias("same"))).alias("first"))
    wanted = copies.join(anchors, "key").select("key", "key2", F.col("first.of").alias("of"), (F.col("copies") / F.col("first.same")).alias("weight"), "fps")
    return stored(wanted.withColumn("no", F.monotonically_increasing_id()), scratch(keyed.sparkSession, "anchors"))


def single_windows(keyed: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """no, singles: of each text the starts of its candidate windows that stand nowhere else. A window's count needs one shuffle of
    hashes and places, combined before it; the place of a window that was met once is the least of one place."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            h, offsets, hit = candidates(b.column("text"), b.column("fps"), window)
            if not len(hit):
                continue
            whole, other = run_hashes(h, window)[hit], run_hashes(mixed(h), window)[hit]
            text = row_of(offsets)[hit]
            row = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(whole.astype(np.int64)), pa.array((other >> np.uint64(32)).astype(np.uint32).astype(np.int32)), b.column("no").take(row), pa.array((hit - offsets[text]).astype(np.int32)), b.column("weight").take(row)],
                ["hash", "check", "no", "start", "weight"],
            )

    texts = keyed.join(wanted, ["key", "key2"]).where(F.col("doc_id").eqNullSafe(F.col("of"))).select("no", "weight", "fps", "text")
    found = texts.mapInArrow(windows, "hash long, check int, no long, start int, weight double")
    once = found.groupBy("hash", "check").agg(F.sum("weight").alias("n"), F.min("no").alias("no"), F.min("start").alias("start")).where("n < 1.5")
    return once.groupBy("no").agg(F.collect_set("start").alias("singles"))


def keyed_texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), t.alias("text")).withColumn("key", F.xxhash64("text")).withColumn("key2", F.xxhash64("text", F.lit(1)))


def without_repeats(docs: DataFrame, window: int = 35, batches: int = 2, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per document: doc_id, n_words, n_removed, kept (the words that stay, joined by one space).

    Words are split at ASCII white space and otherwise unchanged; a null text has none. Every place of a
    repeated window loses its words, the first too, and so do repeats within one document and in repeated
    rows. Windows are judged on the input. Texts of fewer words than a window stay whole. An empty table gives none.
    """
    keyed = keyed_texts(docs, text, doc_id)
    index = indexed(keyed, window, batches)
    return _cut(keyed, keyed, shared_anchors(keyed, index.places(), index.repeated()), window)


def deduplicated(index: FingerprintIndex, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Adds the next batch to the index and returns a row per document of it, as without_repeats: a window goes if it stands
    anywhere else in the batch or in an earlier one. Only earlier texts that share an anchor with the batch are read again. Earlier
    results stay as they were. An empty batch gives none."""
    spark = docs.sparkSession
    keyed = stored(keyed_texts(docs, text, doc_id), f"{index.path}/texts/batch={index.made}")
    earlier = spark.read.schema(keyed.schema).parquet(f"{index.path}/texts/*") if index.every() else None
    again = index.append(keyed)
    every = keyed
    if earlier is not None:
        keys = index.places().join(again, "fp", "left_semi").select("key").distinct()
        every = stored(earlier.join(keys, "key", "left_semi"), scratch(spark, "touched"))  # this batch's texts among them
    return _cut(keyed, every, shared_anchors(every, index.places(), again), index.window)


def _cut(keyed: DataFrame, every: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The documents of keyed without windows that stand twice in every, the texts that wanted (of shared_anchors) tells of."""
    about = wanted.select("key", "key2", "no", "fps").join(single_windows(every, wanted, window), "no", "left").drop("no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            _, offsets, hit = candidates(b.column("text"), b.column("fps"), window)
            singles = b.column("singles")
            alone = row_offsets(singles, offsets)
            hit = np.setdiff1d(hit, alone, assume_unique=True)
            cover = np.zeros(offsets[-1] + 1, np.int64)
            cover[hit] += 1
            np.subtract.at(cover, hit + window, 1)
            gone = np.cumsum(cover)[:-1] > 0
            n, left, kept = np.diff(offsets), [], []
            for t, at, end in zip(b.column("text").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                words, out = t.encode().split(), gone[at:end]
                kept.append(b" ".join([w for w, g in zip(words, out.tolist(), strict=True) if not g] if out.any() else words))
                left.append(int(out.sum()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(left, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    texts = keyed.join(about, ["key", "key2"], "left").select("doc_id", "text", "fps", "singles")
    return texts.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def row_offsets(lists: pa.ListArray, offsets: np.ndarray) -> np.ndarray:
    """Positions within a batch of the words that lists name by their places in texts."""
    per = np.asarray(pa.compute.fill_null(lists.value_lengths(), 0))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(offsets[:-1], per)


def removal_digests(docs: DataFrame, window: int = 35) -> DataFrame:
    return without_repeats(docs, window).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
