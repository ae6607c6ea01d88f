import duckdb
import pytest

from millrace.llm import mixing
from millrace.llm.queries import SQL


def test_as_sql_tells_it(spark, make, clash, odd, prose):
    rows = [(i, t, f"src{i % 5}") for i, t in enumerate(prose(200, most=50))] + [(500 + (i or 0), t, "odd") for i, t in odd] + [(900, "one two", "tiny"), (901, "x", "tiny")]
    docs = make(rows).unionByName(make([(950, "no source here", "x")]).selectExpr("doc_id", "text", "lang", "CAST(NULL AS STRING) AS source", "n_chars"))
    got = mixing.mixture(clash(docs)).collect()
    documents = docs.toPandas()  # noqa: F841
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.execute(SQL["op10_mix_sources"]).fetchall()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted([key((*r[:3], round(r[3], 6), *r[4:])) for r in got]) == sorted([key((*r[:3], round(r[3], 6), *r[4:])) for r in want])


def test_targets_are_met_and_nobody_is_over(spark, make, prose):
    rows = [(i, t, "big" if i % 10 else "small") for i, t in enumerate(prose(600))]
    got = mixing.mixture(make(rows)).collect()
    for source in {r["source_size"] for r in got}:
        mine = [r for r in got if r["source_size"] == source]
        assert sum(r["taken"] for r in mine) == pytest.approx(mine[0]["target"], abs=60)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    again = mixing.mixture(make(rows, parts=7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 890)], "source string, source_size long")
    t = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # a stops at 30; the other 970 are dealt 2 to 1, b stops at 300
    assert t == {"a": 30.0, "b": 300.0, "c": 670.0}
    assert mixing.targets(sizes.limit(0)).count() == 0


def test_the_mix_has_repeats_and_all_columns(make, clash, prose):
    docs = clash(make([(i, t, "a" if i % 20 else "b") for i, t in enumerate(prose(100))]))
    out = mixing.mix(docs)
    taken = {r["doc_id"]: r["repeats"] for r in mixing.mixture(docs).collect()}
    assert out.columns == docs.columns and out.count() == sum(taken.values())
    assert mixing.mixture(make([])).count() == 0 and mixing.mix(make([])).count() == 0


def test_rows_of_one_id_are_taken_as_in_the_mixture(make, clash, prose):
    from collections import Counter

    texts = prose(60, 2)
    rows = [(i % 7 if i % 3 else None, t, "a" if i % 20 else None) for i, t in enumerate(texts)] + [(5, "the same words", "b")] * 90 + [(None, None, None), (5, "", "a")]
    docs = clash(make(rows))
    want, got = Counter(), Counter()
    for r in mixing.mixture(docs).collect():
        want[(r["doc_id"], r["size"], r["source_size"])] += r["repeats"]
    sizes = {r["source"]: r["source_size"] for r in mixing._placed(docs).collect()}
    for r in mixing.mix(docs).collect():
        got[(r["doc_id"], len((r["text"] or "").split()), sizes[r["source"]])] += 1
    assert got == +want
