import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.operators import evaluation

SCHEMA = "row_id bigint, split string, label double, a double, b double"


def _frame(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        split = ("train", "test", "val")[0 if i < 280 else 1 if i < 360 else 2]
        y = float(rng.normal(10, 4))
        rows.append((i, split, y, y + float(rng.normal(0, 2)), float(rng.normal(10, 6))))
    return spark.createDataFrame(rows, SCHEMA)


def _split(df, name):
    rows = df.filter(F.col("split") == name).collect()
    return tuple(np.array([r[c] for r in rows]) for c in ("label", "a", "b"))


def test_metrics_match_numpy(spark):
    df = _frame(spark)
    got = {(r["model"], r["split"]): r for r in evaluation.metrics(df, "label", {"A": "a", "B": "b"}).collect()}
    for split in ("train", "test", "val"):
        y, a, b = _split(df, split)
        for name, p in (("A", a), ("B", b)):
            row = got[name, split]
            assert row["n"] == len(y)
            assert row["rmse"] == pytest.approx(np.sqrt(np.mean((p - y) ** 2)))
            assert row["r2"] == pytest.approx(1 - ((p - y) ** 2).sum() / ((y - y.mean()) ** 2).sum())
            assert row["r2_corr"] == pytest.approx(np.corrcoef(y, p)[0, 1] ** 2)


def test_metrics_of_odd_input(spark):
    rows = [
        (1, "train", 2.0, 2.0, 3.0), (2, "train", 2.0, 2.0, 2.0),
        (3, "test", 1.0, 1.0, None), (4, "val", None, 1.0, 1.0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["model"], r["split"]): r for r in evaluation.metrics(df, "label", {"A": "a", "B": "b"}).collect()}
    assert got["A", "train"]["r2"] == 1.0 and got["B", "train"]["r2"] == 0.0
    assert got["A", "train"]["r2_corr"] is None
    assert got["A", "test"]["r2"] is None and got["A", "test"]["rmse"] == 0.0
    assert got["B", "test"]["n"] == 0 and got["B", "test"]["rmse"] is None
    assert got["A", "val"]["rmse"] is None


def test_evaluation_ranking_and_best(spark):
    rows = [("m1", 0, 1.0, 5.0, 1.0, 0.1), ("m2", 1, 1.0, 3.0, 1.0, 0.2), ("m3", 2, 1.0, 3.0, 1.0, 0.3), ("m4", 3, 1.0, None, 1.0, 0.3)]
    table = spark.createDataFrame(
        rows, "Model string, model_order int, Train_RMSE double, Test_RMSE double, Val_RMSE double, Test_R2 double"
    )
    assert [r["Model"] for r in evaluation.rank_models(table).collect()] == ["m2", "m3", "m1"]
    assert tuple(evaluation.best_model(table).first()) == ("m2", 3.0)
    long = evaluation.metric_long(table)
    assert long.count() == 12 and set(long.columns) == {"Model", "split", "rmse"}
    assert long.filter("Model = 'm1' and split = 'test'").first()["rmse"] == 5.0
    both = evaluation.ensemble_vs_components(table, table.filter("Model <> 'm4'"), table.filter("Model = 'm4'"))
    assert {r["Model"] for r in both.collect()} == {"m1", "m2", "m3", "m4"}


def test_evaluation_table_with_times(spark):
    long = evaluation.metrics(_frame(spark), "label", {"A": "a", "B": "b"})
    seconds = spark.createDataFrame([("A", 1.5)], "model string, seconds double")
    table = {r["Model"]: r for r in evaluation.evaluation_table(long, seconds).collect()}
    assert table["A"]["Training_Time"] == 1.5 and table["B"]["Training_Time"] is None
    assert table["A"]["Test_RMSE"] < table["B"]["Test_RMSE"]


def test_ensemble_is_the_row_mean(spark):
    df = spark.createDataFrame([(1.0, 2.0, 6.0)], "x double, y double, z double")
    assert evaluation.with_ensemble(df, ["x", "y", "z"], "m").first()["m"] == 3.0
    with pytest.raises(ValueError):
        evaluation.with_ensemble(df, ["x", "y"], "m")


def _matrix(rows, split, model):
    return {(r["actual_bin"], r["predicted_bin"]): r["n"] for r in rows if r["split"] == split and r["model"] == model}


def test_confusion_matches_numpy(spark):
    df = _frame(spark)
    rows = evaluation.confusion(df, "label", {"A": "a", "B": "b"}).collect()
    for split in ("train", "test", "val"):
        y, a, b = _split(df, split)
        edges = np.linspace(y.min(), y.max(), 5)
        for name, p in (("A", a), ("B", b)):
            yb, pb = np.digitize(y, edges), np.digitize(p, edges)
            labels = sorted({*yb, *pb})
            want = {(i, j): int(((yb == i) & (pb == j)).sum()) for i in labels for j in labels}
            got = _matrix(rows, split, name)
            assert got == want
            assert sum(got.values()) == len(y)


def test_confusion_cut(spark):
    df = _frame(spark)
    rows = evaluation.confusion(df, "label", {"B": "b"}, kind="cut").collect()
    y, _, b = _split(df, "test")
    edges = np.linspace(y.min(), y.max(), 5)
    inside = (b >= edges[0]) & (b <= edges[-1])
    yb = np.clip(np.searchsorted(edges, y, side="left"), 1, 4)
    pb = np.clip(np.searchsorted(edges, b, side="left"), 1, 4)
    want = {(i, j): int(((yb == i) & (pb == j) & inside).sum()) for i in range(1, 5) for j in range(1, 5)}
    assert _matrix(rows, "test", "B") == want
    with pytest.raises(ValueError):
        evaluation.confusion(df, "label", {"B": "b"}, kind="other")


def test_confusion_layout_edges_and_labels(spark):
    df = spark.createDataFrame([(i, "test", float(i), float(i), 0.0) for i in range(9)], SCHEMA)
    wide = evaluation.confusion_matrix(evaluation.confusion(df, "label", {"A": "a"}))
    assert {r["actual_bin"]: r[str(r["actual_bin"])] for r in wide.collect()} == {1: 2, 2: 2, 3: 2, 4: 2, 5: 1}
    edges = evaluation.bin_edges(df, "label")
    assert [r["edge"] for r in edges.orderBy("edge_no").collect()] == [0, 2, 4, 6, 8]
    labels = evaluation.bin_labels(edges).orderBy("bin").collect()
    assert [r["label"] for r in labels] == ["0.00-2.00", "2.00-4.00", "4.00-6.00", "6.00-8.00"]


def test_confusion_of_a_constant_label(spark):
    df = spark.createDataFrame([(i, "test", 2.0, float(i), 0.0) for i in range(4)], SCHEMA)
    got = _matrix(evaluation.confusion(df, "label", {"A": "a"}).collect(), "test", "A")
    assert got == {(5, 5): 2, (5, 0): 2, (0, 5): 0, (0, 0): 0}
