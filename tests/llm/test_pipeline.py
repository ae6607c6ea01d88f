import os
import random

import corpus_pipeline
from millrace.llm import jaccard  # noqa: F401
from millrace.llm.common import scratch, stored


def write(spark, tmp_path, rows, marks):
    d = str(tmp_path)
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(os.path.join(d, "documents.parquet"))
    spark.createDataFrame([(i, 1, x) for i, x in marks], "doc_id long, quality int, toxic int").write.parquet(os.path.join(d, "labels.parquet"))
    return d


def test_each_stage_takes_effect(spark, tmp_path, prose):
    rng = random.Random(4)
    foul = ["grumpf", "zorkass", "blighter", "scumbert", "vilefang"]
    texts = prose(150, 6, least=20, most=80)
    rows, marks = [], []
    for i, t in enumerate(texts):
        bad = i % 4 == 0
        if bad:
            t = " ".join(w if rng.random() < 0.7 else rng.choice(foul) for w in t.split())
        rows.append((i, t, f"s{i % 3}"))
        marks.append((i, int(bad)))
    clean = rows[1]
    rows += [(1000, "  " + clean[1].replace(" ", "  "), "s0"), (1001, clean[1] + " more", "s1"), (1002, None, "s2"), (1003, "", None), (1004, rows[8][1], "s1")]
    d = write(spark, tmp_path, rows, marks)
    docs, seen = spark.read.parquet(f"{d}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, d), scratch(spark, f"test-{name}"))
        seen[name] = docs
        if name != "pack_sequences":
            assert docs.columns == columns
    ids = {k: [r["doc_id"] for r in v.select("doc_id").collect()] for k, v in seen.items()}
    assert 1004 not in ids["toxicity"] and sum(i in ids["toxicity"] for i in range(0, 150, 4)) <= 4 and sum(i in ids["toxicity"] for i in range(150) if i % 4) >= 108
    assert len({1, 1000} & set(ids["exact_dedup"])) == 1 and len({1002, 1003} & set(ids["exact_dedup"])) == 1
    assert len({1, 1000, 1001} & set(ids["ngram_jaccard_join"])) == 1
    assert len(ids["ngram_jaccard_join"]) == len(set(ids["ngram_jaccard_join"]))
    assert set(ids["mix_sources"]) <= set(ids["ngram_jaccard_join"]) and len(ids["mix_sources"]) > 0
    packed = seen["pack_sequences"]
    assert packed.where("piece = 0").count() == len(ids["mix_sources"])
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_empty_tables(spark, tmp_path):
    d = write(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, d).count() == 0


def test_nulls_clashing_columns_and_no_labels(spark, tmp_path, prose, clash):
    texts = prose(40, 9, least=20, most=60)
    rows = [(i if i % 5 else None, t, None if i % 4 == 0 else f"s{i % 3}") for i, t in enumerate(texts)] + [(7, texts[7], "s1"), (None, None, None), (None, "", "s0"), (8, texts[3] + " more", "s2")]
    docs = clash(spark.read.parquet(os.path.join(write(spark, tmp_path, rows, []), "documents.parquet")))
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        columns, docs = docs.columns, stored(stage(spark, docs, str(tmp_path)), scratch(spark, f"odd-{name}"))
        kept.append(docs.count())
        assert name == "pack_sequences" or docs.columns == columns
    assert kept[:4] == [44, 44, 42, 41] and docs.where("piece = 0").count() == kept[4] > 0
