import re
from itertools import permutations

import pytest

from millrace.llm import audit

LABELS = "doc_id long, quality int, toxic int, mask string"


def fails(text, doc_id, rows):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": re.search(r"[#$%&*|]", text) is not None,
        "E": doc_id is not None and any(j is not None and j < doc_id and (t or "") == text for j, t, _ in rows),
    }


def brute(rows, labels):
    got = [(p or "", fails(t or "", i, rows), max([q or 0 for j, q, _ in labels if j == i and i is not None], default=0), max([x or 0 for j, _, x in labels if j == i and i is not None], default=0)) for i, t, p in rows]
    out = []
    for part in {g[0] for g in got}:
        own = [g for g in got if g[0] == part]
        steps, share = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order, 1):
                gone = [g for g in left if g[1][f]]
                left = [g for g in left if not g[1][f]]
                share[f] += len(gone)
                every = [g for g in own if g[1][f]]
                only = [g for g in every if sum(g[1].values()) == 1]
                steps.append((f, ["".join(order), k, len(left), len(gone), len(every) - len(gone), len(only), sum(g[2] for g in gone), sum(g[3] for g in gone)]))
        out += [(part, *row, share[f]) for f, row in steps]
    return sorted(out)


@pytest.fixture
def case(odd, prose):
    rng = __import__("random").Random(3)
    long = prose(30, 3, 90, 200)
    rows = [(i, t, "en") for i, t in odd] + [(100 + i, t if i % 3 else t.upper(), rng.choice(["en", "de", None, ""])) for i, t in enumerate(long)]
    rows += [(300 + i, long[0], rng.choice(["en", "fr"])) for i in range(120)] + [(7 - i, long[1], "fr") for i in range(5)] + [(400 + i, long[2] + " #1", "en") for i in range(4)]
    rows += [(300, long[0], "de"), (None, long[0], "en"), (None, long[0], "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1]), "x") for i, _, _ in rows if rng.random() < 0.5] + [(None, 1, 1, "x")]
    return rows, labels


@pytest.mark.parametrize("held", [1 << 25, 100])
def test_same_as_brute_force(spark, clash, case, monkeypatch, held):
    monkeypatch.setattr(audit, "HELD", held)  # tasks hand over their chains after every few texts
    rows, labels = case
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = audit.audit(clash(docs), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(map(tuple, got)) == brute(rows, [r[:3] for r in labels])


def test_fingerprints_that_collide_are_told_apart_by_text():
    chain, done = {}, []
    for text, key in ((b"x", 5), (b"y", 3), (b"x", 2), (b"x", 2), (b"y", 9)):
        done += audit._merge(chain, text, key, {("p", 1): 1}, 16)
    assert done == [(5, "p", 17, 1), (9, "p", 17, 1)]
    assert chain == {b"x": [2, {("p", 1): 2}], b"y": [3, {("p", 1): 1}]}


def test_other_filters_and_empty_table(spark, make):
    filters = {"S": lambda t: not t.words, "L": lambda t: t.chars > 3}
    got = audit.audit(make([(1, ""), (2, "long text"), (3, "ok")]), spark.createDataFrame([(1, 1, 0, "")], LABELS), filters).collect()
    assert sorted(tuple(r) for r in got) == [("en", "LS", 1, 2, 1, 0, 1, 0, 0, 2), ("en", "LS", 2, 1, 1, 0, 1, 1, 0, 2), ("en", "SL", 1, 2, 1, 0, 1, 1, 0, 2), ("en", "SL", 2, 1, 1, 0, 1, 0, 0, 2)]
    assert audit.audit(make([]), spark.createDataFrame([], LABELS)).count() == 0


def test_a_very_long_text(spark, make):
    got = audit.masks(make([(1, "word " * 500_000), (2, "word " * 500_000)])).collect()
    assert sorted(tuple(r) for r in got) == [(1, "en", 2, 1), (2, "en", 2 + 16, 1)]
