import random

import public_tokenizers
import pyarrow as pa

from millrace.llm import toxicity
from millrace.llm.common import token_ids


def labelled(n=400, seed=1):
    rng = random.Random(seed)
    mild = ["garden", "window", "morning", "river", "silver", "table", "music", "paper"]
    foul = ["grumpf", "zorkass", "blighter", "scumbert", "vilefang"]
    rows, marks = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        words = [rng.choice(mild) for _ in range(rng.randint(5, 40))]
        for _ in range(rng.randint(3, 8) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(foul))
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    return rows, marks


def test_held_out_accuracy(spark, make, clash):
    rows, marks = labelled()
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    got = toxicity.toxicity(clash(make(rows)), labels).collect()
    truth = dict(marks)
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(rows) and len(held) > 50
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows_and_the_filter(spark, make, clash, odd):
    rows, marks = labelled(200)
    docs = clash(make(rows + [(1000 + (i or 0), t) for i, t in odd] + [(None, "zorkass scumbert vilefang grumpf")]))
    labels = spark.createDataFrame(marks + [(None, 1), (5, None), (1, marks[1][1])], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels)
    scores = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == docs.count() and scores[None]["predicted"] == 1 and not scores[None]["held_out"]
    assert scores[1000]["score"] == scores[1001]["score"]  # null and empty
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == got.where("predicted = 0").count()


def test_no_documents_no_labels_one_class(spark, make):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows, marks = labelled(50)
    assert toxicity.toxicity(make([]), none).count() == 0
    got = toxicity.toxicity(make(rows + [(99, None)]), none).collect()
    assert len(got) == 51 and all(r["predicted"] == 0 and 0 < r["score"] < 0.3 for r in got)
    assert toxicity.drop_toxic(make(rows), none).count() == 50
    one = spark.createDataFrame([(i, 0) for i, _ in marks], "doc_id long, toxic int")
    assert toxicity.toxicity(make(rows), one).where("predicted = 1").count() == 0
    two = spark.createDataFrame([(rows[0][0], 1), (rows[1][0], 0)], "doc_id long, toxic int")
    assert toxicity.toxicity(make([*rows, (99, "")]), two).where("doc_id = 99 AND predicted = 1").count() == 0


def test_repeated_ids_do_not_widen_the_sample(spark, make):
    rows, marks = labelled(60)
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    assert toxicity.fit(make(rows), labels) == toxicity.fit(make(rows * 5), labels)


def test_expressions_of_harmless_words(spark, make):
    rng = random.Random(3)
    words = ["garden", "window", "morning", "river", "silver", "table", "music", "paper"]
    rows, marks = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(20)]
        for at in (rng.randrange(8), rng.randrange(10, 18)):
            text[at : at + 2] = ["river", "garden"] if i % 2 else ["garden", "river"]
        rows.append((i, " ".join(text).replace("river garden" if i % 2 == 0 else "garden river", "music paper")))
        marks.append((i, i % 2))
    got = toxicity.toxicity(make(rows), spark.createDataFrame(marks, "doc_id long, toxic int"), threshold=0.5).where("held_out").collect()
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in got) / len(got) > 0.9


def naive(top, other, g, order, discount=0.75):
    """Kneser-Ney by its definition: the class's own counts at the highest order, shared continuation counts below."""
    every = set(top) | set(other)

    def lower(g):
        seen = every
        for _ in range(order - len(g) - 1):
            seen = {x[1:] for x in seen}
        n = sum(x[1:] == g for x in seen)  # distinct symbols before g
        near = [x[1:] for x in seen if x[1:-1] == g[:-1]]
        below = lower(g[1:]) if len(g) > 1 else 1 / 1000
        return (max(n - discount, 0) + discount * len(set(near)) * below) / len(near)

    near = {x: n for x, n in top.items() if x[:-1] == g[:-1]}
    if not near:
        return lower(g[1:])
    return (max(near.get(g, 0) - discount, 0) + discount * len(near) * lower(g[1:])) / sum(near.values())


def test_ratios_against_the_definition():
    import math
    from collections import Counter

    for order, toxic, ordinary in ((3, {"abc": 2, "abd": 1, "aab": 5}, {"xyz": 1, "abc": 1}), (2, {("a", "b", "a"): 1, ("b",): 2}, {("a", "b"): 3}), (4, {"foul": 3}, {"four": 2, "fold": 1})):
        m = toxicity.KneserNey.counted(Counter(toxic), Counter(ordinary), order=order)
        top = [Counter(), Counter()]
        for c, of in zip(top, (toxic, ordinary), strict=True):
            for w, n in of.items():
                for g in toxicity.grams(w, order):
                    c[g] += n
        assert m.ratio.keys() == top[0].keys() | top[1].keys()
        for g, got in m.ratio.items():
            assert math.isclose(got, math.log(naive(top[0], top[1], g, order) / naive(top[1], top[0], g, order)), abs_tol=1e-9)
        for sequence in toxic:
            want = sum(m.ratio[g] for g in toxicity.grams(sequence, order))
            assert math.isclose(m.of(sequence)[0], want)


def test_a_tokenizer_of_an_earlier_stage_is_let_go(spark, make):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows, marks = labelled(60)
    token_ids(path)
    judge = toxicity.fit(make(rows), spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert token_ids.cache_info().currsize == 0
    token_ids(path)
    got = list(toxicity.scored(judge, iter([pa.RecordBatch.from_pydict({"text": [t for _, t in rows] + [None]})])))
    assert token_ids.cache_info().currsize == 0 and sum(len(s) for _, s in got) == len(rows) + 1
