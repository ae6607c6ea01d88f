import random
import re

from pyspark.sql import functions as F

from millrace.llm import jaccard

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k=4, percent=85):
    sets = [shingles(t, k) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [r[0] for r, x in zip(rows, label, strict=True) if x == label[i] and r[0] is not None] if sets[i] else [doc_id]
        out.append((doc_id, len(sets[i]), min(ids) if ids and ids[0] is not None else None))
    return out


def mangled(text, n, rng):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
    return " ".join(w)


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def corpus(prose, seed):
    rng = random.Random(seed)
    texts = prose(40, seed, least=3, most=120)
    rows = []
    for t in texts:
        rows.append(t)
        rows += [mangled(t, rng.choice([0, 1, 1, 2, 3]), rng) for _ in range(rng.choice([0, 0, 1, 3]))]
        rows += [t.upper(), " ".join(t.split()[:-2])] if rng.random() < 0.3 else []
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_groups_are_those_of_all_pairs(make, clash, prose, odd):
    for seed in (1, 2):
        rows = corpus(prose, seed) + [(1000 + (i or 0), t) for i, t in odd if i is not None] + [(None, "no id at all")]
        got = jaccard.similar_groups(clash(make(rows))).select("doc_id", "n_shingles", "component_id").collect()
        assert order(map(tuple, got)) == order(brute(rows))


def test_other_thresholds_and_a_chain(make, prose):
    base = prose(1, 9, least=60, most=60)[0].split()
    chain = [(i, " ".join(base[i : i + 50] + [f"x{j}" for j in range(max(0, i - 2))])) for i in range(8)]
    rows = chain + [(100 + i, t) for i, (_, t) in enumerate(corpus(prose, 5))]
    got = jaccard.similar_groups(make(rows), size=5, percent=80).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(brute(rows, 5, 80))


def test_long_texts_use_wide_sketches(make, prose):
    rng = random.Random(8)
    texts = prose(6, 8, least=500, most=1400, vocabulary=3000)
    passage = " ".join(prose(1, 11, least=400, most=400, vocabulary=3000))
    rows = list(enumerate([v for t in texts for v in (t, mangled(t, 12, rng), mangled(t, 25, rng), mangled(t, 60, rng), t + " " + passage, " ".join(t.split()[:-70]))]))
    got = jaccard.similar_groups(make(rows), rounds=0).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(brute(rows))


def test_one_of_each_group_keeps_columns_and_wordless_texts(make, clash, prose):
    rows = corpus(prose, 3) + [(5000, ""), (5001, None), (5002, "  ")]
    docs = clash(make(rows))
    out = jaccard.one_of_each_group(docs)
    assert out.columns == docs.columns
    want = {d for d, n, c in brute(rows, 5, 80) if c == d}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(want)


def test_empty_table_and_hot_groups(make):
    assert jaccard.similar_groups(make([])).count() == 0
    rows = [(i, "one and the same text of some words here") for i in range(300)] + [(300 + i, f"one and the same text of some words {i} " * 12) for i in range(100)]
    got = jaccard.similar_groups(make(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(brute(rows))


def test_sketch_never_exceeds_the_difference():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 62, 200).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 62, 10).astype(np.uint64)]))
        difference = len(set(a.tolist()) ^ set(b.tolist()))
        assert sum(int(x).bit_count() for x in (jaccard.parity(a) ^ jaccard.parity(b)).view(np.uint64).tolist()) <= difference


def test_one_of_each_group_whatever_the_ids(make, clash, prose):
    a, b, c, d = prose(4, 9, least=60, most=90)
    rows = [(5, a), (5, b), (7, b + " more"), (3, a + " more"), (None, c), (None, c + " more"), (None, d), (8, d), (9, ""), (9, None), (None, ""), (6, "only one here, of some words"), (6, "only one here, of some words")]
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in jaccard.one_of_each_group(clash(make(rows))).collect()))
    c_kept = [t for none, _, t in got if none and t]
    assert len(c_kept) == 1 and c_kept[0] in (c, c + " more")
    assert [x for x in got if x[2] not in c_kept] == sorted([(False, 3, a + " more"), (False, 5, b), (False, 8, d), (False, 6, "only one here, of some words"), (False, 9, ""), (False, 9, ""), (True, 0, "")])


def test_every_threshold(make, prose):
    rng = random.Random(4)
    texts = []
    for t in prose(25, 14, least=10, most=90):
        texts += [t] + [mangled(t, max(1, int(len(t.split()) * rng.uniform(0.005, 0.09))), rng) for _ in range(3)] + [" ".join(t.split()[: int(len(t.split()) * rng.uniform(0.45, 1))])]
    rows = list(enumerate(texts))
    for percent in (51, 60, 65, 75, 95, 100):
        got = jaccard.similar_groups(make(rows), size=3, percent=percent).select("doc_id", "n_shingles", "component_id").collect()
        assert order(map(tuple, got)) == order(brute(rows, 3, percent)), percent


def test_many_rows_of_one_id_and_a_block_without_links(make, prose):
    a, b = prose(2, 21, least=60, most=60)
    rows = [(1, a)] * 4000 + [(None, a + " more")] * 1000 + [(2, b), (3, b + " more")]
    got = jaccard.similar_groups(make(rows), size=5, percent=80)
    assert sorted(map(tuple, got.groupBy("component_id").count().collect())) == [(1, 5000), (2, 2)]
    rng = random.Random(6)  # a passage in all of them, and too much else
    many = [(i, " ".join(a.split()[:40] + [f"w{rng.randrange(10**6)}" for _ in range(10)])) for i in range(150)]
    got = jaccard.similar_groups(make(many)).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(brute(many))


def test_the_filter_ahead_of_the_join_passes_every_id_and_few_others(spark):
    docs = spark.range(-50_000, 50_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).unionByName(spark.createDataFrame([(None, "n")], "doc_id long, text string"))
    ids = docs.where("doc_id % 100 = 0 OR doc_id IS NULL").select(F.col("doc_id").alias("of"))
    passed = jaccard.perhaps_among(docs, ids)
    assert passed.join(ids, F.col("doc_id").eqNullSafe(F.col("of"))).count() == ids.count() == 1001
    assert passed.count() < 1100 and passed.columns == docs.columns
    assert jaccard.perhaps_among(docs, ids.limit(0)).count() == 0
