import hashlib
import re

from millrace.llm import exact


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", "", t or "") for _, t in rows]
    out = []
    for (i, t), n in zip(rows, norm, strict=True):
        group = [(-len(u or ""), j is None, j or 0) for (j, u), m in zip(rows, norm, strict=True) if m == n]
        size, none, keep = min(group)
        keep = None if none else keep
        out.append((i, keep, len(group), i == keep and len(t or "") == -size, hashlib.sha256(n.encode()).hexdigest()))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[3], r[4]))


def test_same_as_brute_force(make, clash, odd, prose):
    texts = prose(20)
    rows = odd + [(50 + i, t) for i, t in enumerate(texts)] + [(90 + i, "  " + t.replace(" ", "\n")) for i, t in enumerate(texts[:9])] + [(120 + i, texts[0]) for i in range(60)]
    got = exact.exact_duplicates(clash(make(rows))).collect()
    assert order(got) == order(brute(rows))


def test_the_filter_keeps_one_of_each_with_all_columns(make, clash, odd):
    docs = clash(make(odd))
    out = exact.drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    assert out.count() == len({r[4] for r in brute(odd)})


def test_empty_table_and_several_batches(spark, make):
    assert exact.exact_duplicates(make([])).count() == 0
    from millrace.llm.common import scratch

    index = exact.DigestIndex(spark, scratch(spark, "test-digests"))
    index.append(make([(1, "a b"), (2, "c")]))
    index.compact()
    index.append(make([(0, "ab"), (3, "a  b")]))
    merged = {r["keep_id"]: r["group_size"] for r in index.compact().collect()}
    assert merged == {3: 3, 2: 1}



def test_batches_do_not_matter(spark, make, odd, prose):
    texts = prose(30, 4)
    rows = odd + [(50 + i, texts[i % 30]) for i in range(80)]
    want = order(brute(rows))
    for batches in (1, 3, 10):
        assert order(exact.exact_duplicates(make(rows), batches=batches).collect()) == want
        assert exact.drop_exact_duplicates(make(rows), batches=batches).count() == len({r[4] for r in want})


def test_an_index_goes_on_where_it_was_left(spark, make, prose):
    from millrace.llm.common import scratch

    path, texts = scratch(spark, "test-digests"), prose(60, 5)
    exact.DigestIndex(spark, path).append(make([(i, t) for i, t in enumerate(texts[:40])]))
    for k in range(5):
        index = exact.DigestIndex.open(spark, path)
        index.append(make([(100 * (k + 1) + i, t) for i, t in enumerate(texts[5 * k : 5 * k + 10])]))
    index = exact.DigestIndex.open(spark, path)
    assert [len(level) for level in index.levels] == [2, 1]
    new = exact.digested(make([(900, texts[3]), (901, " ".join(texts[1].split("e"))), (902, texts[59]), (903, None)]))
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in index.seen(new).collect()} == {(900, 3, 2)}
    many = exact.digested(make([(2000 + i, t) for i, t in enumerate(texts)] + [(3000 + i, f"{t} x") for i, t in enumerate(texts)]))
    assert {r["doc_id"] - 2000 for r in index.seen(many).collect()} == set(range(40))


def test_lookups_pass_over_runs(spark, make):
    from pyspark.sql import functions as F

    from millrace.llm.common import scratch

    index = exact.DigestIndex(spark, scratch(spark, "test-digests"))
    rows = spark.range(400_000).select(F.xxhash64("id").alias("digest"), F.sha2(F.col("id").cast("string"), 256).alias("sha"), F.col("id").alias("doc_id"), F.lit(1).cast("long").alias("size"))
    for b in range(4):
        index.append_digested(rows.where(f"id % 4 = {b}"))
    assert [len(level) for level in index.levels] == [0, 1]
    wanted = [r[0] for r in rows.limit(3).select("digest").collect()]
    scan = index._read(index.every()[0]).where(F.col("digest").isin(wanted))
    plan = scan._jdf.queryExecution()
    assert scan.count() == 3 and "In(digest" in plan.executedPlan().toString()
    plan.executedPlan().executeCollect()
    node = plan.executedPlan()
    while node.children().size():
        node = node.children().apply(0)
    assert node.metrics().apply("numOutputRows").value() < 400_000
    assert index.lookup(rows.limit(3)).count() == 3 and index.lookup(rows.where("id < 5000")).count() == 5000


def test_an_index_survives_a_job_that_died_before_its_manifest(spark, make, prose, monkeypatch):
    from millrace.llm.common import scratch

    path, texts = scratch(spark, "test-digests"), prose(40, 6)
    index = exact.DigestIndex(spark, path)
    for k in range(3):
        index.append(make([(10 * k + i, t) for i, t in enumerate(texts[10 * k : 10 * k + 10])]))
    for dies in ("save", "merge"):  # the fourth run fills the level: it dies with its run written, and while compacting
        broken = exact.DigestIndex.open(spark, path)
        monkeypatch.setattr(broken, dies, lambda *a: 1 / 0)
        try:
            broken.append(make([(90, "lost")]))
            raise AssertionError
        except ZeroDivisionError:
            pass
    index = exact.DigestIndex.open(spark, path)
    index.append(make([(25 + i, t) for i, t in enumerate(texts[25:40])]))
    assert [len(level) for level in index.levels] == [0, 1]
    want = {min(i for i, t in enumerate(texts) if t == u) for u in texts}
    assert {r["keep_id"] for r in exact.DigestIndex.open(spark, path).compact().collect()} == want
