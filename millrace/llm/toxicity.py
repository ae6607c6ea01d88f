"""Toxicity by class-conditional Kneser-Ney models of letters and of words.

Two models, of toxic and of ordinary text, are held against each other twice: over the letters of each word,
given the letters before, and over the words of a text, given the word before, so that an expression of several
words counts though each of them is harmless; a pair of words that was met once only is taken as never met. Each model counts n-grams of the highest order in its own class;
what it discounts goes to lower orders, whose continuation counts both classes share. A rare expression of
either class therefore backs off to the same numbers in both models and decides nothing by itself. The two
differences of log-likelihoods, for each letter and for each word of a text, are put on a scale of 0 to 1 by a
logistic curve that is fitted on labelled texts kept out of the counts.

The models are fitted on a bounded sample of labelled texts (`most` for each class, by hash of doc_id);
every document is then scored whole, by partition, with tables of log-ratios whose size that bounds.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, fold, release, rows, small_batches

#: Letters of words; everything else separates them.
LETTERS = re.compile(r"[^\W\d_]+")
#: Labels that are taken for granted beside the given ones, and how many of them are toxic: the share of toxic texts where labels are few or none.
TAKEN, TOXIC = 20, 1
#: The chance of a symbol that was never met.
UNSEEN = 1.0 / 1000


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").translate(LOWER))


def grams(symbols: str | tuple[str, ...], n: int) -> Iterator[str | tuple[str, ...]]:
    """N-grams of order n over letters of a word or words of a text, with start and end marked."""
    start, end = ("^", "$") if isinstance(symbols, str) else (("^",), ("$",))
    padded = start * (n - 1) + symbols + end
    return (padded[i : i + n] for i in range(len(padded) - n + 1))


@dataclass
class KneserNey:
    """Log-ratios of toxic over ordinary text: by n-gram, and by context where the n-gram is new in both classes."""

    order: int
    ratio: dict = field(default_factory=dict)
    context: dict = field(default_factory=dict)

    @classmethod
    def counted(cls, toxic: Counter, ordinary: Counter, order: int, discount: float = 0.75) -> KneserNey:
        """toxic, ordinary: sequences of symbols and how often each was met."""
        top = [Counter(), Counter()]
        for of, c in zip((toxic, ordinary), top, strict=True):
            for symbols, n in of.items():
                for g in grams(symbols, order):
                    c[g] += n
        return cls.of_grams(top, order, discount)

    @classmethod
    def of_grams(cls, top: list[Counter], order: int, discount: float = 0.75) -> KneserNey:
        """top: n-grams of the highest order and how often each was met, toxic and ordinary."""
        back = cls._shared(set(top[0]) | set(top[1]), order, discount)
        total, kinds = [Counter(), Counter()], [Counter(), Counter()]
        for c, t, k in zip(top, total, kinds, strict=True):
            for g, n in c.items():
                t[g[:-1]] += n
                k[g[:-1]] += 1

        def left(i: int, h) -> float:
            """What class i leaves to lower orders behind h."""
            return discount * kinds[i][h] / total[i][h] if h in total[i] else 1.0

        def chance(i: int, g) -> float:
            own = max(top[i][g] - discount, 0) / total[i][g[:-1]] if g in top[i] else 0.0
            return own + left(i, g[:-1]) * back[g[1:]]

        ratio = {g: math.log(chance(0, g) / chance(1, g)) for g in top[0].keys() | top[1].keys()}
        context = {h: math.log(left(0, h) / left(1, h)) for h in total[0].keys() | total[1].keys()}
        return cls(order, ratio, context)

    @staticmethod
    def _shared(seen: set, order: int, discount: float) -> dict:
        """Chances of the n-grams one order lower, from how many symbols were met before each, in either class."""
        levels = [seen]
        for _ in range(order - 1):
            levels.append({g[1:] for g in levels[-1]})
        below: dict = {}
        for k in range(1, order):
            count = Counter(g[1:] for g in levels[order - 1 - k])
            total, kinds = Counter(), Counter()
            for g, n in count.items():
                total[g[:-1]] += n
                kinds[g[:-1]] += 1
            below = {g: (max(n - discount, 0) + discount * kinds[g[:-1]] * (below[g[1:]] if k > 1 else UNSEEN)) / total[g[:-1]] for g, n in count.items()}
        return below

    def of(self, symbols: str | tuple[str, ...]) -> tuple[float, int]:
        """Sum of the log-ratios of a sequence, and how many there are."""
        ratio, context, total, n = self.ratio, self.context, 0.0, 0
        for g in grams(symbols, self.order):
            n += 1
            got = ratio.get(g)
            total += context.get(g[:-1], 0.0) if got is None else got
        return total, n


@dataclass
class Judge:
    """Both models, and the curve: a slope for each of them, and its middle."""

    letters: KneserNey
    words: KneserNey
    slopes: tuple[float, ...] = (0.0, 0.0)
    middle: float = 0.0

    @classmethod
    def counted(cls, toxic: Iterable[str], ordinary: Iterable[str], order: int = 4) -> Judge:
        letters, placed, number = [Counter(), Counter()], [[], []], {"^": 0, "$": 1}
        for k, every in enumerate((toxic, ordinary)):
            for t in every:
                if words := words_of(t):
                    letters[k].update(words)
                    at = np.array([0, *(number.setdefault(w, len(number)) for w in words), 1], np.int64)
                    placed[k].append(at[:-1] << 32 | at[1:])
        names, counts = list(number), [np.unique(np.concatenate(p) if p else np.zeros(0, np.int64), return_counts=True) for p in placed]
        again = []
        for (pairs, n), (other, _) in (counts, counts[::-1]):
            keep = (n > 1) | np.isin(pairs, other)
            again.append(Counter({(names[g >> 32], names[g & 0xFFFFFFFF]): m for g, m in zip(pairs[keep].tolist(), n[keep].tolist(), strict=True)}))
        return cls(KneserNey.counted(*letters, order=order), KneserNey.of_grams(again, 2))

    def scorer(self, kept: int = 200_000):
        """A function from text to both log-ratios, for each letter and for each word. The first words it meets keep their sums."""
        known: dict[str, tuple[float, int]] = {}
        ratio, context = self.words.ratio, self.words.context

        def score(text: str | None) -> tuple[float, float]:
            words = words_of(text)
            if not words:
                return 0.0, 0.0
            total, letters = 0.0, 0
            for w in words:
                got = known.get(w)
                if got is None:
                    got = self.letters.of(w)
                    if len(known) < kept and len(w) < 40:
                        known[w] = got
                total += got[0]
                letters += got[1]
            pairs, before = 0.0, "^"
            for w in (*words, "$"):
                got = ratio.get((before, w))
                pairs += context.get((before,), 0.0) if got is None else got
                before = w
            return total / letters, pairs / (len(words) + 1)

        return score

    def fitted(self, scores: Iterable[tuple[float, float]], labels: Iterable[int], rate: float) -> Judge:
        """Fits the logistic curve by Newton steps, weighting classes so that toxic texts have the share `rate`. A ratio
        that would count against itself is left out. With labels of one class alone the curve is flat, at that share."""
        x, y = np.asarray(list(scores), float).reshape(-1, 2), np.asarray(list(labels), float)
        self.slopes, self.middle = (0.0, 0.0), math.log(rate / (1 - rate))
        if len(set(y.tolist())) < 2:
            return self
        share = y.mean()
        weight = np.where(y > 0, rate / share, (1 - rate) / (1 - share))
        spread = np.where(x.std(0) > 0, x.std(0), 1.0)
        use = [0, 1]
        while use:
            z = np.concatenate([x[:, use] / spread[use], np.ones((len(x), 1))], 1)
            b = np.zeros(len(use) + 1)
            for _ in range(50):
                p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
                step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(b)), z.T @ (weight * (y - p)) - 1e-2 * b)
                b = b + step
                if np.abs(step).max() < 1e-8:
                    break
            if (b[:-1] >= 0).all():
                slopes = np.zeros(2)
                slopes[use] = b[:-1] / spread[use]
                self.slopes, self.middle = tuple(slopes.tolist()), float(b[-1])
                break
            use = [u for u, v in zip(use, b, strict=False) if v >= 0]
        return self

    def chance(self, score: tuple[float, float]) -> float:
        at = self.slopes[0] * score[0] + self.slopes[1] * score[1] + self.middle
        return 1 / (1 + math.exp(-min(max(at, -30), 30)))


def fit(docs: DataFrame, labels: DataFrame, most: int = 2500, order: int = 4, modulus: int = 4, without: int = 2) -> Judge:
    """Fits on at most `most` labelled texts of each class, the first by hash of doc_id, of those whose
    crc32(doc_id as text) mod `modulus` is not `without`. Four fifths are counted, a fifth sets the curve, then all are counted.

    labels: doc_id, toxic; rows with a null of either are left out, repeated doc_ids give one, toxic if any is. Of repeated
    doc_ids in docs one text is taken. The share of toxic texts is that of the labels, TAKEN more of which TOXIC are toxic
    thought beside them. Where there are no labels, labels of one class, or too few to set a curve, every text scores that share.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("__toxic"))
    marked = marked.where(F.crc32(F.col("__id").cast("string").cast("binary")) % modulus != without).withColumn("__at", F.xxhash64("__id"))
    counts = {r[0]: r[1] for r in marked.groupBy("__toxic").count().collect()}
    rate = (counts.get(1, 0) + TOXIC) / (sum(counts.values()) + TAKEN)
    if len(counts) < 2:
        return Judge(KneserNey(order), KneserNey(2)).fitted((), (), rate)
    picked = None
    for kind in (0, 1):
        few = marked.where(F.col("__toxic") == kind).orderBy("__at").limit(most)
        picked = few if picked is None else picked.unionByName(few)
    texts = docs.select(F.col("doc_id"), "text").join(F.broadcast(picked), F.col("doc_id") == F.col("__id")).groupBy("__at", "__toxic").agg(F.max("text").alias("text"))  # 2 * most rows
    sample = sorted((r["__at"], r["__toxic"], r["text"] or "") for r in texts.collect())
    held = [(t, x) for a, x, t in sample if a % 5 == 0]
    rest = [(t, x) for a, x, t in sample if a % 5]
    part = Judge.counted((t for t, x in rest if x), (t for t, x in rest if not x), order)
    score = part.scorer()
    part.fitted((score(t) for t, _ in held), (x for _, x in held), rate)
    slopes, middle = part.slopes, part.middle
    del part, score, held, rest
    release()
    whole = Judge.counted((t for _, x, t in sample if x), (t for _, x, t in sample if not x), order)
    whole.slopes, whole.middle = slopes, middle
    del sample
    release()
    return whole


def scored(judge: Judge, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[float]]]:
    """Slices of batches with the score of each text. What the worker holds of an earlier stage goes first: its tokenizer and the model don't fit beside each other."""
    release()
    score = judge.scorer()
    for b in small_batches(batches, "text", 4 << 20):
        yield b, [judge.chance(score(t)) for (t,) in rows(b, "text")]


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """A row per document: doc_id, held_out, score (0 to 1), predicted. Null and empty texts score as a text of no evidence.
    Repeated rows are scored each; a null doc_id isn't held out. An empty table gives none."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(docs, labels, **options))  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, s in scored(model.value, batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    modulus, without = options.get("modulus", 4), options.get("without", 2)
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.coalesce(fold("doc_id", modulus) == without, F.lit(False)).alias("held_out"))
    return ready.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns. Repeated rows stay or go together; an empty
    table gives none. Without labels of both classes all stay, unless most labels are toxic."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, s in scored(model.value, batches):
            yield b.filter(pa.array([x < threshold for x in s], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
