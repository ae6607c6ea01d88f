"""Packing token sequences into as few fixed-length sequences as it can, by a grouping genetic algorithm.

Documents are encoded where they lie and cut only where they are longer than a sequence. A whole-length
piece is a sequence by itself. The other pieces are dealt at random into shards of about `shard_size`;
each shard is a problem for several islands, which run apart as rows of a DataFrame. A chromosome is the
list of groups (bins). Crossover injects whole well-filled bins of one parent into the other, removes the
bins that hold the same documents, and puts the displaced ones back: longer ones change places with shorter
ones where that fills a bin, the others by best fit; mutation does so after emptying the least filled bins.
An island ends at a proven lower bound of the number of bins. Between rounds each island hands its elite to the next one of its ring.
The best packing of a shard stays. Bins of all shards that are less than full go into one more pass
together, so that each shard's last bins don't add up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import rows, scratch, small_batches, stored, token_ids

#: Bins that a change of a packing touches, whatever its size.
CHANGED = 24
#: Tasks that evolve islands, at most.
TASKS = 4096
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, most: int = 2048, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per piece: PIECE, and slot, a number of its own. Null texts are empty: one piece, the end id. Repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = token_ids(tokenizer), np.array([end_id], "<u4").tobytes()
        slot = TaskContext.get().partitionId() << 40
        for b in small_batches(batches, "text", 4 << 20):
            out: list[list] = [[] for _ in range(6)]
            for key, t in rows(b, "doc_id", "text"):
                data = ids.encode(t) + end
                for k, at in enumerate(range(0, len(data), 4 * most)):
                    part = data[at : at + 4 * most]
                    for column, v in zip(out, (key, k, at // 4, len(part) // 4, zlib.crc32(part), slot), strict=True):
                        column.append(v)
                    slot += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "slot"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"{PIECE}, slot long")


def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, fill: list[int], size: int) -> list[int]:
    """Puts items in the given order where least room is left, opening bins as needed. bins (a bin for each item) is set in place; returns the fills."""
    by_room: dict[int, list[int]] = {}
    mask = 0  # bit r: a bin with room r
    for b, f in enumerate(fill):
        if f < size:
            by_room.setdefault(size - f, []).append(b)
            mask |= 1 << (size - f)
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            here = by_room[room]
            b = here.pop()
            if not here:
                mask ^= 1 << room
        else:
            b, room = len(fill), size
            fill.append(0)
        fill[b] += n
        if left := room - n:
            here = by_room.setdefault(left, [])
            if not here:
                mask |= 1 << left
            here.append(b)
        bins[i] = b
    return fill


def filled(lengths: np.ndarray, size: int) -> np.ndarray:
    """A packing that opens a bin for the longest item left and fills its room exactly, by one item or two, where it can."""
    order = np.argsort(lengths, kind="stable")
    n = np.bincount(lengths, minlength=size + 1)
    end = np.cumsum(n)  # items of a length are order[end - n : end]
    out, b, longest = np.empty(len(lengths), "int64"), 0, size

    def take(length: int) -> None:
        n[length] -= 1
        out[order[end[length] - n[length] - 1]] = b

    for _ in range(len(lengths)):
        while longest and not n[longest]:
            longest -= 1
        if not longest:
            break
        take(longest)
        room = size - longest
        while room:
            if n[room]:
                take(room)
                break
            half = room // 2
            both = np.minimum(n[1 : half + 1], n[room - 1 : room - half - 1 : -1])
            if room % 2 == 0 and half:
                both[-1] = n[half] // 2
            fits = np.flatnonzero(both)
            if len(fits):
                take(int(fits[-1]) + 1)
                take(room - int(fits[-1]) - 1)
                break
            below = np.flatnonzero(n[: room + 1])
            if not len(below):
                break
            take(int(below[-1]))
            room -= int(below[-1])
        b += 1
    return out


def _tidy(bins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers the bins from 0; their fills."""
    _, bins = np.unique(bins, return_inverse=True)
    return bins, np.bincount(bins, weights=lengths).astype("int64")


def swapped(loose: np.ndarray, bins: np.ndarray, fill: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Puts loose items, longest first, in the place of the shortest item that leaves room for them in its bin; returns
    the items that are loose then. Changes bins and fill."""
    out = []
    room = np.where(bins >= 0, (size - fill)[np.maximum(bins, 0)], -1) + lengths  # what each place could hold
    for i in loose[np.argsort(-lengths[loose], kind="stable")].tolist():
        n = lengths[i]
        gain = np.where((room >= n) & (bins >= 0), n - lengths, 0)
        j = int(gain.argmax())
        if gain[j] <= 0:
            out.append(i)
            continue
        b = bins[j]
        bins[i], bins[j] = b, -1
        fill[b] += gain[j]
        room[bins == b] -= gain[j]
        room[i] = size - fill[b] + n
        out.append(j)
    return np.array(out, "int64")


def refit(keep: np.ndarray, bins: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Keeps the bins of the items in keep, lets longer displaced items change places with shorter ones in them, and
    best-fits what is loose then, longest first."""
    out = np.full(len(bins), -1, "int64")
    fills = np.zeros(0, "int64")
    loose = np.flatnonzero(~keep)
    if keep.any():
        out[keep], fills = _tidy(bins[keep], lengths[keep])
        loose = swapped(loose, out, fills, lengths, size)
    best_fit(lengths, loose[np.argsort(-lengths[loose], kind="stable")], out, fills.tolist(), size)
    return out


def crossed(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """A child of a that receives some of b's full bins, or fullest ones, whole."""
    fill = np.bincount(b, weights=lengths)
    good = np.flatnonzero(fill >= min(size, max(0.99 * size, np.median(fill))))
    if not len(good):
        return a
    take = np.zeros(len(fill), bool)
    take[rng.choice(good, min(len(good), CHANGED), replace=False)] = True
    injected = take[b]
    hit = np.zeros(int(a.max()) + 1, bool)
    hit[a[injected]] = True  # bins of a that hold the same documents
    kept = ~hit[a]
    joint = np.where(injected, b, a + len(fill))
    return refit(injected | kept, joint, lengths, size)


def mutated(a: np.ndarray, lengths: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """Empties the least filled bins and as many others."""
    fill = np.bincount(a, weights=lengths)
    few = min(CHANGED, max(2, len(fill) // 20))
    out = np.zeros(len(fill), bool)
    out[np.argsort(fill)[:few]] = True
    out[rng.integers(0, len(fill), few)] = True
    return refit(~out[a], a, lengths, size)


def fitness(a: np.ndarray, lengths: np.ndarray, size: int) -> tuple[int, float]:
    """Smaller is better: bins, then how unevenly they are filled; full bins and empty ones are liked, half full ones aren't."""
    fill = np.bincount(a, weights=lengths)
    return len(fill), -float(np.square(fill / size).sum())


def least_bins(lengths: np.ndarray, size: int) -> int:
    """Bins that any packing needs: for each k, items above size - k are alone, those above size / 2 too but for items below k, and what room they leave can't hold all items of k to size / 2."""
    n = np.bincount(lengths, minlength=size + 1)
    above = lambda x: np.concatenate([np.cumsum(x[::-1])[::-1], [0]])  # noqa: E731  (of lengths from each on)
    count, total = above(n), above(n * np.arange(size + 1))
    half = size // 2 + 1
    k = np.arange(half)
    room = (count[half] - count[size - k + 1]) * size - (total[half] - total[size - k + 1])
    rest = total[k] - total[half] - room
    return int((count[half] + np.maximum(0, -(-rest // size))).max())


def evolve(lengths: np.ndarray, size: int, elites: list[np.ndarray], seed: list[int], population: int, generations: int) -> np.ndarray:
    """One island for one round. It ends early at `least_bins`."""
    rng, least = np.random.default_rng(seed), least_bins(lengths, size)
    ranked: list = []

    def met(bins: np.ndarray, no: int) -> bool:
        ranked.append((fitness(bins, lengths, size), no, bins))
        ranked.sort(key=lambda x: x[:2])
        del ranked[population:]
        return ranked[0][0][0] <= least

    for i in range(population):
        if i < len(elites):
            bins = elites[i]
        elif i == 1:
            bins = filled(lengths, size)
        else:
            noise = rng.normal(0, 0 if i == 0 else 0.02 * size, len(lengths))
            bins = np.full(len(lengths), -1, "int64")
            best_fit(lengths, np.argsort(-(lengths + noise), kind="stable"), bins, [], size)
        if met(bins, i):
            return ranked[0][2]
    for g in range(generations):
        i, j = sorted(rng.choice(len(ranked), 2, replace=False)) if len(ranked) > 1 else (0, 0)
        child = crossed(ranked[i][2], ranked[j][2], lengths, size, rng) if g % 2 else mutated(ranked[i][2], lengths, size, rng)
        if met(child, population + g):
            break
    return ranked[0][2]


def _packed(items: DataFrame, size: int, shards: int, tag: int, islands: int, rounds: int, population: int, generations: int) -> DataFrame:
    """items: PIECE and slot. Adds sequence_id, offset and fill."""
    spark = items.sparkSession
    item = F.struct("length", "slot", "doc_id", "piece", "start", "ids_crc32")
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("slot"), F.lit(shards)))
    problems = stored(dealt.groupBy("shard").agg(F.sort_array(F.collect_list(item), asc=False).alias("items")), scratch(spark, "packing"))  # shard_size items each, whatever the input
    state = problems.select("shard", F.col("items.length").alias("lengths"), F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.lit(None).cast("binary").alias("own"), F.lit(None).cast("binary").alias("guest"))
    ring = state.select("shard", "lengths", "island")
    for r in range(rounds):

        def run(frames: Iterator[pd.DataFrame], r: int = r) -> Iterator[pd.DataFrame]:
            for f in frames:
                out = []
                for x in f.itertuples():
                    lengths = np.asarray(x.lengths, "int64")
                    elites = [np.frombuffer(e, "<u4").astype("int64") for e in (x.own, x.guest) if e is not None]
                    best = evolve(lengths, size, elites, [tag, x.shard, x.island, r], population, generations)
                    n, even = fitness(best, lengths, size)
                    out.append((x.shard, x.island, n, even, best.astype("<u4").tobytes()))
                yield pd.DataFrame(out, columns=["shard", "island", "bins", "even", "elite"])

        elites = state.repartition(min(TASKS, shards * islands), "shard", "island").mapInPandas(run, "shard long, island int, bins long, even double, elite binary")
        elites = stored(elites, scratch(spark, "elites"))
        own = elites.select("shard", "island", F.col("elite").alias("own"))
        guest = elites.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.col("elite").alias("guest"))
        if r + 1 < rounds:
            state = ring.join(own, ["shard", "island"]).join(guest, ["shard", "island"])
    best = elites.groupBy("shard").agg(F.min_by("elite", F.struct("bins", "even", "island")).alias("elite"))

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for x in f.itertuples():
                bins = np.frombuffer(x.elite, "<u4").astype("int64")
                t = pd.DataFrame([i.asDict() if hasattr(i, "asDict") else i for i in x.items])
                t["doc_id"] = t["doc_id"].astype("Int64")
                t["sequence_id"] = (tag << 60) + (x.shard << 20) + bins
                t["offset"] = t.groupby("sequence_id")["length"].cumsum() - t["length"]
                t["fill"] = t.groupby("sequence_id")["length"].transform("sum")
                yield t[["doc_id", "piece", "start", "length", "ids_crc32", "slot", "sequence_id", "offset", "fill"]]

    return problems.join(best, "shard").mapInPandas(placed, f"{PIECE}, slot long, sequence_id long, offset long, fill long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = 2048, shard_size: int = 8192, islands: int = 3, rounds: int = 2, population: int = 6, generations: int = 100, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per piece: PIECE, sequence_id, offset. Sequences are gapless from offset 0 and hold `size` ids at most.
    An empty table gives none. Repeated rows and a null doc_id are packed like any other."""
    spark = docs.sparkSession
    every = stored(pieces(docs, tokenizer, end_id, size, text, doc_id), scratch(spark, "pieces"))
    columns = [*(c.split()[0] for c in PIECE.split(", ")), "sequence_id", "offset"]
    options = {"islands": islands, "rounds": rounds, "population": population, "generations": generations}
    full = every.where(F.col("length") == size).withColumn("sequence_id", (F.lit(3) * F.lit(1 << 60)) + F.col("slot")).withColumn("offset", F.lit(0).cast("long"))
    short = every.where(F.col("length") < size)
    n = short.count()
    shards = max(1, -(-n // shard_size))
    first = stored(_packed(short, size, shards, 0, **options), scratch(spark, "packed"))
    tight = F.col("fill") >= F.lit(int(0.99 * size))
    loose = first.where(~tight)
    again = _packed(loose.select(*short.columns), size, max(1, -(-loose.count() // shard_size)), 1, **options)
    return full.select(columns).unionByName(first.where(tight).select(columns)).unionByName(again.select(columns))
