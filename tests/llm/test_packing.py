import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import packing

WORD = public_tokenizers.path("word_bpe_49k.json")


def whole(rows, got, size):
    """Every piece is there, and sequences are gapless."""
    library = Tokenizer.from_file(WORD)
    library.encode_special_tokens = True
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        want += [(doc_id, k, at, len(part := ids[at : at + size]), zlib.crc32(np.array(part, "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), size))]
    key = lambda r: tuple(x if x is not None else -1 for x in r)
    assert sorted([tuple(r[:5]) for r in got], key=key) == sorted(want, key=key)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= size
    return len(bins), sum(r["length"] for r in got)


def test_pieces_and_bins(make, clash, odd, prose):
    rows = odd + [(100 + i, t) for i, t in enumerate(prose(150, most=300))]
    got = packing.pack(clash(make(rows)), WORD, size=256).collect()
    bins, ids = whole(rows, got, 256)
    assert bins <= -(-ids // 256) * 1.03 + 1


def test_several_shards_and_hot_lengths(make, prose):
    rows = [(i, t) for i, t in enumerate(prose(300, 3, most=40))] + [(1000 + i, "same text here") for i in range(200)]
    got = packing.pack(make(rows), WORD, size=128, shard_size=100).collect()
    bins, ids = whole(rows, got, 128)
    assert bins <= -(-ids // 128) * 1.05 + 2


def test_empty_table(make):
    assert packing.pack(make([]), WORD).count() == 0


def test_crossover_keeps_every_item_in_one_bin():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 90, 400)
    a, b = (packing.refit(np.zeros(400, bool), np.full(400, -1), lengths + rng.integers(0, 1), 100) for _ in range(2))
    for child in (packing.crossed(a, b, lengths, 100, rng), packing.mutated(a, lengths, 100, rng)):
        assert (child >= 0).all() and np.bincount(child, weights=lengths).max() <= 100


def fewest(lengths, size):
    """By trying everything."""
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= size and bins[k] not in bins[:k]:
                place(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1 :])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best[0]


def test_small_problems_are_solved_to_the_optimum():
    rng = np.random.default_rng(5)
    for k in range(25):
        lengths = -np.sort(-rng.integers(1, 20, 11))
        got = packing.evolve(lengths, 20, [], [k], 6, 200)
        want = fewest(lengths.tolist(), 20)
        assert np.bincount(got, weights=lengths).max() <= 20 and got.min() >= 0
        assert packing.least_bins(lengths, 20) <= want == packing.fitness(got, lengths, 20)[0]


def test_better_than_best_fit_and_near_the_bound():
    rng = np.random.default_rng(1)
    kinds = (rng.integers(1, 2048, 4096), np.clip(rng.lognormal(5.6, 0.9, 4096).astype(int), 1, 2047), rng.integers(600, 1301, 4096))
    for k, lengths in enumerate(kinds):
        bins = np.full(4096, -1, "int64")
        simple = len(packing.best_fit(lengths, np.argsort(-lengths, kind="stable"), bins, [], 2048))
        got, least = packing.fitness(packing.evolve(lengths, 2048, [], [k], 6, 100), lengths, 2048)[0], packing.least_bins(lengths, 2048)
        assert least <= got <= 1.005 * least and (got < simple or simple <= 1.003 * least)
