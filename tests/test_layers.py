"""Layers that follow late rows, tree contributions, saved preparation, retried outputs, row differences."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import difference, metrics, trees
from millrace.operators.preparation import Preparation
from millrace.plans import increments, learning
from millrace.sources import runs, sinks
from millrace.streaming.incremental import Layers, week_part

DATA = "/root/testdata/sf0.001"
SCHEMA = "complaint_id int, area_key int, created timestamp, closed timestamp, updated timestamp"


def report(i, day, area=1, closed=None, updated=None):
    at = datetime(2024, 1, 1) + timedelta(days=day)
    return i, area, at, closed and at + timedelta(days=closed), at + timedelta(days=updated if updated is not None else closed or 0)


def layers(spark, path):
    return Layers(spark, path, "complaint_id", ["updated", "closed"], week_part(F.to_date("created")), increments.week_totals)


def rebuilt(spark, rows):
    best = {}
    for r in rows:
        if r[0] not in best or (r[4], r[3] is not None, r[3] or r[4]) > (best[r[0]][4], best[r[0]][3] is not None, best[r[0]][3] or best[r[0]][4]):
            best[r[0]] = r
    df = spark.createDataFrame(list(best.values()), SCHEMA).withColumn("part", week_part(F.to_date("created")))
    return sorted(map(tuple, increments.week_totals(df).collect()), key=str)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def held(layer):
    return sorted((tuple(r[c] for c in ("part", "area_key", "complaint_count", "closed_count", "last_update")) for r in layer.gold.read().collect()), key=str)


def test_late_rows_make_their_own_weeks_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    layer = layers(spark, path)
    first = [report(i, 2 * i, i % 3) for i in range(30)]
    assert len(layer.take(spark.createDataFrame(first, SCHEMA))) == 9
    before = files(path)
    late = [report(3, 6, 0, closed=20), report(40, 7, None)]
    touched = layer.take(spark.createDataFrame([*late, first[5]], SCHEMA))
    assert touched == sorted({(datetime(2024, 1, 1) + timedelta(days=d) - datetime(1970, 1, 5)).days // 7 for d in (6, 7)})
    assert before.items() <= files(path).items()  # nothing that stood was written again
    new = {p for p in files(path) if p not in before}
    assert {int(p.split("part=")[1].split("/")[0]) for p in new if "part=" in p} == set(touched)
    assert held(layer) == rebuilt(spark, first + late)


def test_rows_that_repeat_or_are_older_touch_nothing(spark, tmp_path):
    layer = layers(spark, str(tmp_path / "t"))
    rows = [report(i, i, 1, closed=4) for i in range(12)]
    layer.take(spark.createDataFrame(rows, SCHEMA))
    assert layer.take(spark.createDataFrame(rows[3:8] * 2, SCHEMA)) == []
    assert layer.take(spark.createDataFrame([report(3, 3, 1)], SCHEMA)) == []  # its open state, reported late
    assert held(layer) == rebuilt(spark, rows)


def test_keys_move_and_parts_become_empty(spark, tmp_path):
    layer = layers(spark, str(tmp_path / "t"))
    rows = [report(1, 0), report(2, 30)]
    layer.take(spark.createDataFrame(rows, SCHEMA))
    moved = report(1, 14, 2, updated=3)
    assert len(layer.take(spark.createDataFrame([moved], SCHEMA))) == 2
    assert held(layer) == rebuilt(spark, [*rows, moved]) and len(held(layer)) == 2


def test_a_version_that_broke_off_is_made_again(spark, tmp_path, monkeypatch):
    layer = layers(spark, str(tmp_path / "t"))
    rows, more = [report(i, i) for i in range(20)], [report(i, i, 5, closed=9) for i in range(15, 25)]
    layer.take(spark.createDataFrame(rows, SCHEMA))
    monkeypatch.setattr(layer, "make", lambda rows: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        layer.take(spark.createDataFrame(more, SCHEMA))
    monkeypatch.undo()
    assert held(layer) == rebuilt(spark, rows)
    assert layer.take(spark.createDataFrame(more, SCHEMA)) and held(layer) == rebuilt(spark, rows + more)


def test_random_batches_equal_a_full_rebuild(spark, tmp_path):
    rng = random.Random(6)
    layer, every = layers(spark, str(tmp_path / "t")), []
    for _ in range(4):
        batch = [report(i := rng.randint(0, 40), (i * 7) % 45 if rng.random() < 0.8 else rng.randint(0, 45), i % 4, rng.choice([None, 3, 8]), rng.randint(0, 60) + rng.random()) for _ in range(25)]
        every += batch
        layer.take(spark.createDataFrame(batch, SCHEMA).repartition(3))
        assert held(layer) == rebuilt(spark, every)


def test_runs_of_the_log_are_taken_once(spark, tmp_path):
    log, layer = runs.RunLog(spark, f"{tmp_path}/log"), layers(spark, str(tmp_path / "t"))
    span = runs.window(None, datetime(2024, 2, 1))
    rows = [report(i, i) for i in range(10)]
    for k, part in enumerate((rows[:6], rows[4:], [report(0, 0, 1, closed=2)])):
        spark.createDataFrame(part, SCHEMA).write.parquet(f"{tmp_path}/in{k}")
        log.start(f"scheduled__{k}", "s", f"2024-02-0{k + 1}", span, f"{tmp_path}/in{k}")
        if k < 2:
            log.finish(f"scheduled__{k}", "s", len(part), "2024-01-31")
    assert list(layer.catch_up(log, "s", spark.read.parquet)) == ["scheduled__0", "scheduled__1"]
    assert layer.catch_up(log, "s", spark.read.parquet) == {} and held(layer) == rebuilt(spark, rows)
    log.finish("scheduled__2", "s", 1, "2024-01-31")
    assert len(layer.catch_up(log, "s", spark.read.parquet)["scheduled__2"]) == 1


def test_contributions_of_trees_add_up(spark):
    train, test = learning._assembled(spark, DATA)
    with learning.kept(train) as train:
        model = learning.fitted_trees(train, 4, 6)
    rows = learning.explained(model, test.limit(300)).collect()
    assert len(rows) == 300 and len({round(r["margin"], 9) for r in rows}) > 5
    for r in rows:
        assert abs(r["bias"] + sum(p["contribution"] for p in r["parts"]) - r["margin"]) < 1e-9
        assert [p["feature"] for p in r["parts"]] == list(learning.NUMBERS)
        up = sorted(((-p["contribution"], p["feature"]) for p in r["parts"] if p["contribution"] > 0))[:3]
        assert [x["feature"] for x in __import__("json").loads(r["factors"])] == [f for _, f in up]
    nodes = trees.nodes_of(model)
    assert nodes.depth <= 4 and len(nodes.roots) == 6


def test_tree_contributions_by_hand(spark):
    nodes = trees.Nodes(left=[1, -1, 3, -1, -1], right=[2, -1, 4, -1, -1], feature=[0, -1, 1, -1, -1], threshold=[5.0, 0.0, 1.0, 0.0, 0.0], score=[0.1, -0.4, 0.3, 0.2, 0.9], roots=[0], depth=2)
    df = spark.createDataFrame([([5.0, 9.0],), ([6.0, 1.0],), ([6.0, 2.0],)], "v array<double>")
    got = [[round(p["contribution"], 9) for p in r[0]] for r in df.select(trees.contributions(nodes, F.col("v"), ["a", "b"])).collect()]
    assert got == [[-0.5, 0.0], [0.2, -0.1], [0.2, 0.6]]


def test_contributions_are_looked_up_by_leaf(spark):
    """No function of higher order walks the trees for each row, and sums are those of the steps in their order."""
    rng = random.Random(5)
    nodes = trees.Nodes(depth=4)

    def grow(depth):
        at = len(nodes.left)
        for values, v in ((nodes.left, -1), (nodes.right, -1), (nodes.feature, -1), (nodes.threshold, 0.0), (nodes.score, rng.gauss(0, 1))):
            values.append(v)
        if depth and rng.random() < 0.8:
            nodes.feature[at], nodes.threshold[at] = rng.randrange(3), rng.gauss(0, 1)
            nodes.left[at], nodes.right[at] = grow(depth - 1), grow(depth - 1)
        return at

    for _ in range(12):
        nodes.roots.append(grow(4))
    nodes.roots.append(grow(0))

    def by_steps(v):
        out = [0.0] * 3
        for at in nodes.roots:
            while nodes.left[at] >= 0:
                to = nodes.left[at] if v[nodes.feature[at]] <= nodes.threshold[at] else nodes.right[at]
                out[nodes.feature[at]] += nodes.score[to] - nodes.score[at]
                at = to
        return out

    data = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(50)] + [[nodes.threshold[nodes.roots[0]]] * 3, [float("-inf"), float("inf"), 0.0]]
    told = spark.createDataFrame([(v,) for v in data], "v array<double>").select("v", trees.contributions(nodes, F.col("v"), ["a", "b", "c"]).alias("parts"))
    assert all([p["contribution"] for p in r["parts"]] == by_steps(r["v"]) for r in told.collect())
    assert "lambda" not in told._jdf.queryExecution().toString()


def test_scales_and_fold_days_are_found_once(spark):
    """What a model's rows are scaled by and the days of folds are known to later plans, which don't make them again."""
    _, test = learning._assembled(spark, DATA)
    plan = test._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan and plan.count("parquet") == 1
    rows = spark.createDataFrame([(datetime(2000, 1, 1 + i % 20).date(), i % 2) for i in range(80)] + [(None, 1)], "day date, target int")
    parts = [[sorted({r["day"].day for r in part.collect()}) for part in pair] for pair in learning.fold_parts(rows.where("day IS NOT NULL"), "day", 3)]
    assert parts == [[list(range(1, 6)), list(range(6, 11))], [list(range(1, 11)), list(range(11, 16))], [list(range(1, 16)), list(range(16, 21))]]
    for train, held in learning.fold_parts(rows, "day", 3):
        assert train.where("day IS NULL").count() == held.where("day IS NULL").count() == 0
        for part in (train, held):
            plan = part._jdf.queryExecution().optimizedPlan().toString()
            assert "Join" not in plan and "Window" not in plan


def test_preparation_is_saved_in_a_pipeline(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rng = random.Random(3)
    data = [(i, rng.choice([None, 1.0, 2.0, 7.5]), rng.choice([3, 4, None]), rng.choice(["x", "y", None]), float(rng.random() < 0.4)) for i in range(200)]
    df = spark.createDataFrame(data, "id int, a double, b int, c string, target double")
    stage = Preparation(numbers=["a", "b"], categories=["c"])
    prepared = stage.fit(df)
    assert prepared.outputs() == ["z_a", "z_b", "is_c_UNKNOWN", "is_c_x", "is_c_y"]
    pipeline = Pipeline(stages=[stage, VectorAssembler(inputCols=prepared.outputs(), outputCol="features"), LogisticRegression(labelCol="target")])
    model = pipeline.fit(df)
    odd = df.unionByName(spark.createDataFrame([(900, None, None, "new", 0.0), (901, 1e9, -5, "", 1.0)], df.schema))
    p = lambda m, on: {r[0]: r[1] for r in m.transform(on).select("id", vector_to_array("probability")[1]).collect()}
    want = p(model, odd)
    model.write().overwrite().save(f"{tmp_path}/m")
    pipeline.write().overwrite().save(f"{tmp_path}/p")
    other = spark.newSession()
    assert p(PipelineModel.load(f"{tmp_path}/m"), other.createDataFrame(odd.collect(), odd.schema)) == want
    assert p(Pipeline.load(f"{tmp_path}/p").fit(df), odd) == pytest.approx(want)
    row = {r["id"]: r for r in prepared.transform(odd).collect()}
    assert [row[900][c] for c in ("is_c_UNKNOWN", "is_c_x", "is_c_y")] == [0, 0, 0]
    known = sorted(r[1] for r in data if r[1] is not None)
    filled = [r[1] if r[1] is not None else (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2 for r in data]
    mean = sum(filled) / 200
    deviation = (sum((x - mean) ** 2 for x in filled) / 200) ** 0.5
    assert row[0]["z_a"] == pytest.approx((filled[0] - mean) / deviation)
    with pytest.raises(ValueError, match="more than 1"):
        Preparation(categories=["c"], most=1).fit(df)


def test_subgroups_of_one_class_and_small_ones(spark):
    rows = [(i % 10 / 10, int(i % 3 == 0), f"m{i % 2}", "one" if i < 40 else None, "c") for i in range(80)] + [(0.5, 1, "m9", "two", "c")] * 35
    df = spark.createDataFrame(rows, "score double, label int, month string, area string, cuisine string")
    got = {(r["kind"], r["value"]): r for r in learning.subgroups(df, "score", "label").collect()}
    assert set(got) == {("month", "m0"), ("month", "m1"), ("month", "m9"), ("area", "one"), ("area", None), ("area", "two"), ("cuisine", "c")}
    assert got["month", "m9"]["auc"] is None and got["month", "m9"]["brier"] == 0.25
    alone = metrics.ranking(df.where("month = 'm0'"), "score", "label").first()
    assert got["month", "m0"]["auc"] == alone["auc"] and got["month", "m0"]["average_precision"] == alone["average_precision"]


def test_retried_outputs(spark, tmp_path):
    root, df = f"{tmp_path}/data", spark.range(5)
    for name in ("silver/run=1", "silver/run=10", "silver/run=1b"):
        df.write.parquet(f"{root}/{name}")
    with pytest.raises(FileExistsError):
        sinks.prepared_output(spark, [f"{root}/silver/run=1"], f"{root}/reports/1")
    assert sinks.prepared_output(spark, [f"{root}/silver/run=1"], f"{root}/reports/1", root) is None
    assert sorted(os.listdir(f"{root}/silver")) == ["run=10", "run=1b"]
    for bad in (root, f"{root}/silver", f"{root}/silver/run=*", f"{root}/silver/../silver/run=10", f"{tmp_path}/other/a/b", f"{root}x/silver/run=10", "/"):
        with pytest.raises(ValueError):
            sinks.remove_output(spark, bad, root)
    assert not sinks.remove_output(spark, f"{root}/silver/run=1", root)


def test_outputs_are_whole_or_absent(spark, tmp_path):
    path = f"{tmp_path}/o/a"
    os.makedirs(path)
    (tmp_path / "o/a/part-0.parquet").write_text("half")
    assert sinks.write_once(spark.range(7), path) and spark.read.parquet(path).count() == 7
    assert not sinks.write_once(spark.range(9), path) and spark.read.parquet(path).count() == 7
    assert os.listdir(f"{tmp_path}/o") == ["a"]
    good = {"status": "SUCCESS", "rows": 4}
    assert sinks.write_gated(spark.range(4), f"{tmp_path}/o/b", good) == 4
    for report_ in ({"status": "FAILED", "rows": 4}, {"status": "SUCCESS"}, {"status": "SUCCESS", "rows": 5}):
        with pytest.raises(ValueError, match="before"):
            sinks.write_gated(spark.range(4), f"{tmp_path}/o/c", report_)
    with pytest.raises(FileExistsError):
        sinks.write_gated(spark.range(4), f"{tmp_path}/o/b", good)
    assert sorted(os.listdir(f"{tmp_path}/o")) == ["a", "b"]


def test_differences_are_named_by_column(spark):
    schema = "k int, j string, a string, b double"
    before = [(1, "x", "p", 1.0), (2, "x", None, 2.0), (3, None, "q", None), (4, "x", "r", 4.0), (6, "d", "one", 1.0), (6, "d", "one", 1.0)]
    after = [(1, "x", "p", 1.0), (2, "x", "new", 2.5), (3, None, "q", None), (5, "x", "s", 5.0), (6, "d", "one", 1.0), (None, "x", "t", 1.0)]
    got = difference.row_difference(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema).select("b", "a", "k", "j"), ["k", "j"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(2, "x", "changed", ["a", "b"]), (4, "x", "removed", []), (5, "x", "added", []), (6, "d", "removed", []), (None, "x", "added", [])], key=str)
    with pytest.raises(ValueError, match="other columns"):
        difference.row_difference(spark.createDataFrame(before, schema), spark.range(1), ["k"])
    a = spark.createDataFrame(before, schema)
    planted = a.withColumn("a", F.when(F.col("k") == 1, "lost").otherwise(F.col("a")))
    assert [tuple(r) for r in difference.suppressed(planted.where("k < 4"), a, "k", ["a", "b"]).collect()] == [(1, "a", "lost", "p")]
