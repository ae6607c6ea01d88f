"""Similarity join on word shingles by parity sketches.

A document's set of shingles is dealt by hash into k blocks, and the 64-bit codes of a block's shingles
are XORed into one word. A shingle that only one of two documents has changes one block at most, so the
number of differing blocks is no more than the symmetric difference of the sets. Where the similarity asks
for a symmetric difference of d at most, k > d blocks leave some that agree (pigeonhole), and documents
are candidates where a block agrees. k follows from a band of set sizes; a document takes part in its own
band and in all bands down to that of the smallest partner it may have.

Blocks of few shingles say little and could be shared by very many documents. k has blocks to spare, so only
a document's d + 1 largest blocks are used, and a document that has fewer than those of the least size deals
its shingles again by another hash, until some round leaves it enough. Of two similar documents, the one that is done first finds an agreeing
block in its last round, in which both take part; so no link is lost.

A second sketch has one parity bit for each of 1024 hash values: its Hamming distance is a lower bound of
the symmetric difference, too, and rejects candidates before their sets are compared. Sets too large for
1024 bits have a wider one, of two bits for each shingle at least; of two widths the wider one is folded.

Documents with the same set are one node. Links between nodes are found in rounds: in each shared block the
member that stands first in a random order, the centre, is compared with all others and leaves the block. The first
round has one order for all blocks, so neighbouring blocks compare the same pairs; the next ones have an order of
each block's own. A round ends with the classes that its links make, and blocks whose members are all connected, or
compared, go: most blocks have two members and are done at once. What is left then meets several centres a block:
where size and parity bits allow, a pair is compared on the sets. Blocks of more members than centres go on in
further rounds, with four times as many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import scratch, small_batches, stored
from millrace.llm.words import mixed, run_hashes, word_hashes

#: Ratio of a size band's ends.
RATIO = 1.35
SEEDS = 64
BITS = 1024


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles of `size` words; of fewer words the whole sequence is one; of none, none."""
    h, offsets = word_hashes(texts, lower=True)
    runs = {n: run_hashes(h, n) for n in range(1, size + 1)}
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        n = min(size, b - a)
        yield np.unique(mixed(runs[n][a : b - n + 1] + np.uint64(n))) if n else np.zeros(0, np.uint64)


def band_of(n: int) -> int:
    return int(np.log(n) / np.log(RATIO) + 1e-9)


def largest(band: int) -> int:
    """The largest size in a band."""
    n = int(RATIO ** (band + 1)) + 2
    while band_of(n) > band:
        n -= 1
    return n


def plan(band: int, percent: int) -> tuple[int, int, int]:
    """Of a band: the largest symmetric difference of a linked pair whose smaller set is in it, the number of blocks, the least shingles in a block."""
    union = 100 * largest(band) // percent
    d = (100 - percent) * union // 100
    if d == 0:
        return 0, 1, 1
    k = d + 4 + d // 8
    mean = largest(band) / RATIO / k  # shingles in a block of the smallest sets that take part
    thin = k * np.exp(-mean) * (1 + mean)
    return d, k, 2 if thin + np.sqrt(thin) < k - d else 1  # blocks of two only where enough of them are to be expected


def blocks(u: np.ndarray, percent: int, plans: dict[int, tuple[int, int, int]]) -> np.ndarray:
    """The keys of a set's blocks, in every band and round in which it takes part.

    Of two similar sets the agreeing block that is the largest (then the first by place) has d larger ones at
    most in either set, as all of those differ. So the d + 1 largest blocks do.
    """
    n, out = len(u), []
    for band in range(band_of(-(-percent * n // 100)), band_of(n) + 1) if n else ():
        if band not in plans:
            plans[band] = plan(band, percent)
        d, k, least = plans[band]
        for seed in range(SEEDS):
            at = ((mixed(u + np.uint64(0x51ED2701 * (seed + 1))) >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
            at = at.astype(np.int64)
            words = np.zeros(k, np.uint64)
            np.bitwise_xor.at(words, at, u)
            held = np.bincount(at, minlength=k)
            place = np.argsort(-held, kind="stable")
            use = place[held[place] >= least]
            enough = len(use) > d
            if not enough and seed == SEEDS - 1:
                use = place
            use = use[: d + 1 if enough else k]
            out.append(mixed(words[use] ^ mixed(use.astype(np.uint64) + np.uint64((band << 40) + (seed << 32)))))
            if enough:
                break
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def parity(u: np.ndarray) -> np.ndarray:
    bits = np.bincount((u >> np.uint64(54)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def wide_parity(u: np.ndarray) -> np.ndarray:
    """For more than BITS / 2 shingles: parity bits by the hashes' lowest bits, 2 * len(u) or more (a power of two); else none."""
    if len(u) <= BITS // 2:
        return np.zeros(0, np.int64)
    size = 1 << (2 * len(u) - 1).bit_length()
    bits = np.bincount((u & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def node_of(u: np.ndarray) -> int:
    """A set's own number: the sum of its hashes."""
    return int(mixed(np.array([u.sum(dtype=np.uint64) + np.uint64(len(u))])).astype(np.int64)[0])


def described(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n, node, bits, wide: of every row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            sets = list(shingle_sets(b.column("text"), size))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(u) for u in sets], pa.int64()), pa.array([node_of(u) for u in sets], pa.int64()), pa.array([parity(u) for u in sets], pa.list_(pa.int64())), pa.array([wide_parity(u) for u in sets], pa.list_(pa.int64()))],
                ["doc_id", "n", "node", "bits", "wide"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, node long, bits array<long>, wide array<long>")


def dealt(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """key, node: the blocks of every set. A set that repeats within a task is dealt once there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        plans: dict[int, tuple[int, int, int]] = {}
        for b in small_batches(batches, "text", 1 << 20):
            keys, nodes, counts = [np.zeros(0, np.uint64)], [], []
            for u in shingle_sets(b.column("text"), size):
                node = node_of(u)
                if len(u) and node not in seen:
                    seen.add(node)
                    keys.append(blocks(u, percent, plans))
                    nodes.append(node)
                    counts.append(len(keys[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), counts))], ["key", "node"])

    return docs.select("text").mapInArrow(run, "key long, node long")


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    """node, shingles (array of long), of docs (node, text); rows whose text has another set are left out, and a set comes once from a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in small_batches(batches, "text", 1 << 20):
            sets = []
            for u, node in zip(shingle_sets(b.column("text"), size), b.column("node").to_pylist(), strict=True):
                fits = node not in seen and node_of(u) == node
                sets.append(u if fits else None)
                if fits:
                    seen.add(node)
            got = pa.RecordBatch.from_arrays([b.column("node"), pa.array([None if u is None else u.astype(np.int64) for u in sets], pa.list_(pa.int64()))], ["node", "shingles"])
            yield got.filter(got.column("shingles").is_valid())

    return docs.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


#: Bits of the filter that keeps texts from a shuffle which they would leave again: 8 MB, whatever the number of ids.
FILTER_BITS = 1 << 26


def _places(doc_id: str) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(doc_id), F.lit(i)), F.lit(FILTER_BITS)) for i in range(2)]


def perhaps_among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, ...) whose doc_id is in ids (of), and some others: a Bloom filter ahead of the join that decides.

    The filter has FILTER_BITS bits and two hashes of an id. It is all that passes through the driver, 16 MB at most;
    with more ids than it has room for, more rows pass and the join has more to do, with the same result.
    """
    placed = ids.select(F.explode(F.array(*_places("of"))).alias("place"))
    words = placed.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        held = [sent.value[p.to_numpy() >> 6] >> (p.to_numpy() & 63) & 1 for p in (x, y)]
        return pd.Series((held[0] & held[1]).astype(bool))

    return docs.where(F.pandas_udf(run, "boolean")(*_places("doc_id")))


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """links: a, b. Returns node, label: the least node that is reachable, for each node with a link (or known before).

    Each round takes the least label of a node's neighbours and then follows labels of labels. Tables are
    written between rounds, so nothing grows on the driver and a lost executor costs one round.
    """
    spark = links.sparkSession
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if known is not None:
        both = both.unionByName(known.select(F.col("node").alias("a"), F.col("label").alias("b"))).unionByName(known.select(F.col("label").alias("a"), F.col("node").alias("b")))
    both = stored(both.where("a <> b").distinct(), scratch(spark, "links"))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), scratch(spark, "labels"))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        stepped = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = stored(stepped.join(jump, "label", "left").select("node", F.least("label", "next").alias("label"), "was"), scratch(spark, "labels"))
        if not new.where("label <> was").limit(1).count():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _linked(pairs: DataFrame, about: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose sets are similar: first by size and parity bits, then on the sets.

    Pairs that pass the bits are written, so the joins with the sets are planned by their true size: where a round leaves
    few, their ends are broadcast and only the sets of these ends are shuffled.
    """
    left, right = (about.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ABOUT)) for x in "ab")
    near = pairs.distinct().join(left, "a").join(right, "b").where(_may("a", "b", percent)).select("a", "b", "n_a", "n_b")
    near = stored(near, scratch(pairs.sparkSession, "near"))
    s_a, s_b = (sets.join(near.select(F.col(x).alias("node")), "node", "left_semi").select(F.col("node").alias(x), F.col("shingles").alias(f"s_{x}")) for x in "ab")
    full = near.join(s_a, "a").join(s_b, "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return full.where(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b").distinct()


ABOUT = ("n", "bits", "wide")


def _may(a: str, b: str, percent: int) -> Column:
    """Whether size and parity bits leave it open that two sets are similar. a, b: endings of the columns ABOUT."""
    n_a, n_b, wide_a, wide_b = (F.col(f"{c}_{x}") for c in ("n", "wide") for x in (a, b))
    most = (n_a + n_b) * (100 - percent)  # |A ^ B| <= (a + b) * (100 - p) / (100 + p) for a linked pair
    apart = sum((F.bit_count(F.col(f"bits_{a}")[i].bitwiseXOR(F.col(f"bits_{b}")[i])) for i in range(1, BITS // 64)), F.bit_count(F.col(f"bits_{a}")[0].bitwiseXOR(F.col(f"bits_{b}")[0])))
    size = F.least(F.size(wide_a), F.size(wide_b))
    far = F.aggregate(F.zip_with(_folded(wide_a, size), _folded(wide_b, size), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    sized = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    return sized & (apart * (100 + percent) <= most) & F.when(size > 0, far * (100 + percent) <= most).otherwise(F.lit(True))


def _folded(bits: Column, size: Column) -> Column:
    """A sketch of twice the size folded; sizes of similar sets differ no more than that."""
    both = F.zip_with(F.slice(bits, F.lit(1), size), F.slice(bits, size + 1, size), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(bits) > size, both).otherwise(bits)


#: Centres of a block in the first round that has several.
CENTRES = 64


def _unconnected(shared: DataFrame, labels: DataFrame | None) -> DataFrame:
    """key, node, label: members of the blocks of shared (key, node) that are of several classes."""
    by_key = Window.partitionBy("key")
    members = shared.withColumn("label", F.col("node")) if labels is None else shared.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return members.withColumn("low", F.min("label").over(by_key)).withColumn("high", F.max("label").over(by_key)).where("low <> high")


def _rounds(shared: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, rounds: int) -> DataFrame:
    """node, label: the classes of all nodes with a link. shared: key, node, the members of blocks; nodes: node and ABOUT; sets: node, shingles."""
    spark, labels = shared.sparkSession, None
    by_key = Window.partitionBy("key")

    def known(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
        ends = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        links = stored(_linked(ends, nodes, sets, percent), scratch(spark, "found"))
        return components(links, labels) if labels is None or links.limit(1).count() else labels

    left = shared
    for r in range(rounds):
        order = F.xxhash64(*(["node"] if r == 0 else ["key", "node"]), F.lit(r))
        drawn = _unconnected(left, labels).withColumns({"centre": F.min(F.struct(order.alias("at"), "node", "label")).over(by_key), "members": F.count(F.lit(1)).over(by_key)})
        labels = known(drawn.where(F.col("label") != F.col("centre.label")).select(F.col("node").alias("x"), F.col("centre.node").alias("y")), labels)
        # the centre is done; of two members none is left to compare
        left = stored(drawn.where((F.col("members") > 2) & (F.col("node") != F.col("centre.node"))).select("key", "node"), scratch(spark, "left"))
        if not left.limit(1).count():
            return labels
    few = CENTRES
    while True:
        nth = F.row_number().over(by_key.orderBy(F.xxhash64("key", "node"), "node"))
        about = _unconnected(left, labels).withColumn("nth", nth).select("key", "node", "label", "nth").join(nodes.select("node", *ABOUT), "node")
        placed = stored(about, scratch(spark, "placed"))
        x, y = (d.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "label", "nth", *ABOUT))) for d, s in ((placed, "x"), (placed.where(F.col("nth") <= few), "y")))
        pairs = x.join(y, "key").where((F.col("nth_x") > F.col("nth_y")) & (F.col("label_x") != F.col("label_y")) & _may("x", "y", percent))
        labels = known(pairs.select(F.col("node_x").alias("x"), F.col("node_y").alias("y")), labels)
        left, few = placed.where(F.col("nth") > few).select("key", "node"), 4 * few
        if not left.limit(1).count():
            return labels


def similar_groups(docs: DataFrame, size: int = 4, percent: int = 85, rounds: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, node, links' classes by label.

    Two documents link when 100 * |A & B| >= percent * |A | B| of their sets of distinct shingles of `size`
    words (A-Z lower-cased). Fewer words make one shingle; a text without words, or null, is empty and
    linked with nothing. component_id is the least doc_id that is reachable by links, a null doc_id coming
    last. Repeated rows have the same component. An empty table gives none. percent: above 50.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent is above 50, and 100 at most")
    spark = docs.sparkSession
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    every = stored(described(slim, size), scratch(spark, "sets"))
    by_key = Window.partitionBy("key")
    shared = dealt(slim, size, percent).withColumn("low", F.min("node").over(by_key)).withColumn("high", F.max("node").over(by_key)).where("low <> high")
    shared = stored(shared.select("key", "node").distinct(), scratch(spark, "shared"))
    wanted = shared.select("node").distinct()
    nodes = every.where("n > 0").join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first"), *(F.first(c).alias(c) for c in ABOUT))
    nodes = stored(nodes.select("node", F.col("first.doc_id").alias("of"), *ABOUT), scratch(spark, "nodes"))
    often = every.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(F.col("doc_id").alias("often"))
    wanted = stored(nodes.select("node", "of").join(often, F.col("of").eqNullSafe(F.col("often")), "left").select("node", "of", (F.col("often").isNotNull() | F.col("of").isNull()).alias("again")), scratch(spark, "wanted"))
    texts = perhaps_among(slim, wanted).join(wanted, F.col("doc_id").eqNullSafe(F.col("of")))
    sets = sets_of(texts.where("NOT again"), size)
    if wanted.where("again").limit(1).count():  # several rows have the doc_id, and may have the same set
        sets = sets.unionByName(sets_of(texts.where("again"), size).groupBy("node").agg(F.first("shingles").alias("shingles")))
    sets = stored(sets, scratch(spark, "shingles"))
    labels = _rounds(shared, nodes, sets, percent, rounds)
    named = every.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    joined = named.drop("bits", "wide").join(least, "label", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), "node", "label")


def with_nodes(docs: DataFrame, size: int) -> DataFrame:
    """docs with __node and __n, the set of a row's text and its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            sets = list(shingle_sets(b.column("text"), size))
            more = [pa.array([node_of(u) for u in sets], pa.int64()), pa.array([len(u) for u in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, "__node", "__n"])

    schema = docs.schema
    return docs.mapInArrow(run, T.StructType([*schema.fields, T.StructField("__node", T.LongType()), T.StructField("__n", T.LongType())]))


def one_of_each_group(docs: DataFrame, size: int = 5, percent: int = 80, **options) -> DataFrame:
    """Of each group of similar documents one row, with all its columns: that of the least doc_id, null last, then of the
    least hash of its set of shingles; of rows alike in both, any one. Documents without words stay.

    Rows whose doc_id no other row has are found by it. The sets of all others are made again, to tell them apart.
    """
    groups = similar_groups(docs, size, percent, **options)
    groups = stored(groups.select("doc_id", "n_shingles", "node", "label"), scratch(docs.sparkSession, "groups"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node"))
    best = groups.where("n_shingles > 0").groupBy("label").agg(least.alias("best")).select(F.col("best.doc_id").alias("__id"), F.col("best.node").alias("__of"))
    ids = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    again = ids.where("n > 1").select(F.col("doc_id").alias("__again"))
    keep = best.select("__id").unionByName(groups.where("n_shingles = 0").select(F.col("doc_id").alias("__id")))
    keep = keep.join(again, keep["__id"].eqNullSafe(again["__again"]), "left_anti")
    doc_id = docs["doc_id"].cast("long")
    alone = docs.join(keep, doc_id.eqNullSafe(keep["__id"])).select(*docs.columns)
    rest = with_nodes(docs.join(again, doc_id.eqNullSafe(again["__again"]), "left_semi"), size)
    found = rest.where("__n > 0").join(best, rest["doc_id"].cast("long").eqNullSafe(best["__id"]) & (rest["__node"] == best["__of"])).dropDuplicates(["__id", "__of"])
    return alone.unionByName(found.select(*docs.columns)).unionByName(rest.where("__n = 0").select(*docs.columns))
