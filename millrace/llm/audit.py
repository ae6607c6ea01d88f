"""What filters remove together: an audit of every order in which they can be applied.

Texts are routed by fingerprint in an RDD: the partition follows from xxhash64, a partition's keys are sorted
(spilling to disk), and rows of one fingerprint form a collision chain of full texts, each with its least
identifier; identifiers above the least are emitted as copies. Before the shuffle a task merges its own copies, so
a text travels once per task however often it stands there. Each row leaves as (doc_id, part, mask of the filters
that it fails) without its text, meets its labels, and combineByKey adds up one vector of counts per part, from
which all orders follow: the vector has 2 ** filters x 4 entries whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import permutations
from math import factorial
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_of

#: Bytes of text that a task merges before it hands them to the shuffle.
HELD = 32 << 20
#: Bytes of text of a partition to which texts are routed, about.
ROUTED = 64 << 20

CAPITALS = bytes(range(65, 91))
SYMBOLS = b"#$%&*|"


class Text(NamedTuple):
    """What rules look at: words are runs of bytes other than ASCII white space."""

    raw: bytes
    chars: int
    words: list[bytes]


#: By letter, whether a text fails. A letter without a rule stands for exact copies of a smaller doc_id's text.
FILTERS: dict[str, Callable[[Text], bool] | None] = {
    "A": lambda t: len(t.words) < 100,
    "B": lambda t: 100 * len(set(t.words)) < 80 * len(t.words),
    "C": lambda t: 100 * (len(t.raw) - len(t.raw.translate(None, CAPITALS))) > 10 * t.chars,
    "D": lambda t: len(t.raw) != len(t.raw.translate(None, SYMBOLS)),
    "E": None,
}

SLIM = "doc_id long, part string, mask int, n long"


def _merge(chain: dict, text: bytes, doc_id: int, kinds: dict, copy: int) -> Iterator[tuple]:
    """Puts rows of a text into a chain; yields rows that turn out to be copies of a smaller identifier."""
    held = chain.get(text)
    if held is None:
        chain[text] = [doc_id, kinds]
        return
    least, own = held
    if doc_id == least:
        for k, n in kinds.items():
            own[k] = own.get(k, 0) + n
        return
    loser, lost = (doc_id, kinds) if doc_id > least else (least, own)
    if doc_id < least:
        chain[text] = [doc_id, kinds]
    for (part, mask), n in lost.items():
        yield loser, part, mask | copy, n


def masks(docs: DataFrame, filters: dict = FILTERS, text: str = "text", doc_id: str = "doc_id", part: str = "lang", partitions: int | None = None) -> DataFrame:
    """SLIM: for every row its doc_id, part and the filters that it fails as bits in the order of `filters`; n rows that are alike.

    A null text is empty, a null part is ''. Equal doc_ids aren't smaller than each other, so repeated rows aren't
    copies by themselves. A null doc_id is neither smaller nor larger than others: such rows are no copies and make none.
    """
    spark = docs.sparkSession
    rules = [(1 << i, rule) for i, rule in enumerate(filters.values()) if rule]
    copy = sum(1 << i for i, rule in enumerate(filters.values()) if rule is None)
    whole = text_of(text)
    source = docs.select(F.xxhash64(whole), F.col(doc_id).cast("long"), F.coalesce(F.col(part).cast("string"), F.lit("")), F.length(whole), whole.cast("binary")).rdd
    if not partitions:
        size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        partitions = max(-(-size // ROUTED), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def told(rows: Iterable[tuple]) -> Iterator[tuple]:
        """((fingerprint, 1), (text, least id, kinds)) of a task's texts, and ((any, 0), row) of rows that are done."""
        chains: dict[int, dict] = {}
        held = 0
        for fp, key, own, chars, raw in rows:
            raw = bytes(raw)
            seen = Text(raw, chars, raw.split())
            mask = sum(bit for bit, rule in rules if rule(seen))
            if key is None or not copy:
                yield (hash((key, fp)), 0), (key, own, mask, 1)
                continue
            chain = chains.setdefault(fp, {})
            held += 200 if raw in chain else len(raw) + 200
            for row in _merge(chain, raw, key, {(own, mask): 1}, copy):
                yield (hash(row[:1]), 0), row
            if held > HELD:
                yield from flushed(chains)
                chains, held = {}, 0
        yield from flushed(chains)

    def flushed(chains: dict[int, dict]) -> Iterator[tuple]:
        for fp, chain in chains.items():
            for raw, (least, kinds) in chain.items():
                yield (fp, 1), (raw, least, kinds)

    def resolved(rows: Iterable[tuple]) -> Iterator[tuple]:
        at, chain = None, {}
        for (fp, kind), value in rows:
            if kind == 0:
                yield value
                continue
            if fp != at:
                yield from least(chain)
                at, chain = fp, {}
            yield from _merge(chain, *value, copy)
        yield from least(chain)

    def least(chain: dict) -> Iterator[tuple]:
        for key, kinds in chain.values():
            for (own, mask), n in kinds.items():
                yield key, own, mask, n

    routed = source.mapPartitions(told).repartitionAndSortWithinPartitions(partitions, lambda key: key[0] % partitions)
    return spark.createDataFrame(routed.mapPartitions(resolved), SLIM)


def orders(vector: np.ndarray, letters: str) -> Iterator[tuple]:
    """filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley from counts[mask, quality, toxic]."""
    every = np.arange(len(vector))
    bits = {x: 1 << i for i, x in enumerate(letters)}
    total, good, toxic = vector.sum((1, 2)), vector[:, 1, :].sum(1), vector[:, :, 1].sum(1)
    found, share = [], dict.fromkeys(letters, 0)
    for order in permutations(letters):
        before = 0
        for step, x in enumerate(order, 1):
            fails = (every & bits[x]) != 0
            here = fails & ((every & before) == 0)
            gone = int(total[here].sum())
            before |= bits[x]
            share[x] += gone
            found.append((x, "".join(order), step, int(total[(every & before) == 0].sum()), gone, int(total[fails].sum()) - gone, int(total[bits[x]]), int(good[here].sum()), int(toxic[here].sum())))
    for x, *row in found:
        yield *row, share[x]


def audit(docs: DataFrame, labels: DataFrame, filters: dict = FILTERS, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """A row per part, order of the filters and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley (removed by the step's filter, summed over all orders).

    Nulls and repeated rows as in `masks`; each repeated row counts. labels: doc_id, quality, toxic; a document
    counts as good (toxic) if any of its label rows says 1, and as neither if it has none or its doc_id is null.
    Further columns of either table are ignored. An empty table has no parts and gives no rows.
    """
    letters, size = "".join(filters), 1 << len(filters)
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*(F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c) for c in ("quality", "toxic")))
    slim = masks(docs, filters, text, doc_id, part)
    told = slim.join(known, "doc_id", "left").select("part", F.col("mask") * 4 + F.coalesce("quality", F.lit(0)) * 2 + F.coalesce("toxic", F.lit(0)), "n")

    def put(vector: np.ndarray, value: tuple[int, int]) -> np.ndarray:
        vector[value[0]] += value[1]
        return vector

    counts = told.rdd.map(lambda r: (r[0], (r[1], r[2]))).combineByKey(lambda v: put(np.zeros(size * 4, "int64"), v), put, lambda a, b: a + b)
    rows = counts.flatMap(lambda x: ((x[0], *r) for r in orders(x[1].reshape(size, 2, 2), letters)))
    out = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    assert len(filters) <= 6, f"{factorial(len(filters))} orders are too many to list"
    return docs.sparkSession.createDataFrame(rows, out)
