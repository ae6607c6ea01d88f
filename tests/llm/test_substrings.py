import hashlib
import random
from collections import Counter

from millrace.llm import substrings


def brute(rows, window):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[k : k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def corpus(prose, seed, window):
    rng = random.Random(seed)
    texts = prose(30, seed, most=150)
    passages = [" ".join(t.split()[: window + rng.randint(-1, 20)]) for t in prose(4, seed + 50, least=80, most=90)]
    rows = []
    for t in texts:
        w = t.split()
        for p in rng.sample(passages, rng.choice([0, 1, 2])):
            at = rng.randrange(len(w))
            w[at:at] = p.split()
        rows.append(" ".join(w))
    rows += rows[:2] + ["x y z " * 40, "q " * 100]  # copies, and repeats within a document
    return list(enumerate(rows))


def test_same_as_all_windows(make, clash, prose, odd):
    for seed, window in ((1, 35), (2, 35), (3, 12)):
        rows = corpus(prose, seed, window) + [(500 + (i or 0), t) for i, t in odd if i is not None] + [(None, "no id at all")]
        got = substrings.removal_digests(clash(make(rows)), window).collect()
        assert order(got) == order(brute(rows, window))


def test_repeated_rows_count_as_elsewhere(make, prose):
    text = prose(1, 4, least=50, most=50)[0]
    rows = [(7, text), (7, text), (8, text + " tail of other words")]
    assert order(substrings.removal_digests(make(rows)).collect()) == order(brute(rows, 35))


def test_empty_table(make):
    assert substrings.removal_digests(make([])).count() == 0


def test_batches_do_not_matter(make, prose):
    rows = corpus(prose, 7, 35)
    from pyspark.sql import functions as F

    for batches in (1, 3, 6):
        got = substrings.without_repeats(make(rows), batches=batches).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256))
        assert order(got.collect()) == order(brute(rows, 35))


def test_batch_after_batch(spark, make, prose):
    from pyspark.sql import functions as F

    from millrace.llm.common import scratch

    rows, path, seen = corpus(prose, 8, 20) + [(None, "no words of note"), (900, None)], scratch(spark, "test-fingerprints"), []
    substrings.FingerprintIndex(spark, path, 20).save()
    for k in range(6):
        part = rows[k::6] if k < 5 else []
        seen += part
        index = substrings.FingerprintIndex.open(spark, path, 20)
        got = substrings.deduplicated(index, make(part)).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)).collect()
        want = brute(seen, 20)[len(seen) - len(part) :]
        assert order(got) == order(want), k
    assert [len(level) for level in index.levels] == [2, 1]


def test_an_index_survives_a_job_that_died_before_its_manifest(spark, make, prose, monkeypatch):
    from pyspark.sql import functions as F

    from millrace.llm.common import scratch

    rows, path = corpus(prose, 9, 20), scratch(spark, "test-fingerprints")
    substrings.FingerprintIndex(spark, path, 20).save()
    first, second = rows[::2], rows[1::2]
    substrings.deduplicated(substrings.FingerprintIndex.open(spark, path, 20), make(first)).count()
    broken = substrings.FingerprintIndex.open(spark, path, 20)
    monkeypatch.setattr(broken, "save", lambda: 1 / 0)
    try:
        substrings.deduplicated(broken, make(second))
        raise AssertionError
    except ZeroDivisionError:
        pass
    got = substrings.deduplicated(substrings.FingerprintIndex.open(spark, path, 20), make(second)).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)).collect()
    assert order(got) == order(brute(first + second, 20)[len(first) :])
