import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from headway.operators import explanation, preparation


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    a, b, c = rng.normal(size=(3, 300))
    pdf = pd.DataFrame({"a": a, "b": b + 0.5 * a, "c": c, "k": 1.0, "y": 4 * a - b + 0.1 * c})
    pdf.loc[::7, "b"] = None
    return spark.createDataFrame(pdf.replace({np.nan: None})), pdf


def _model(df, estimator):
    stages = preparation.feature_stages(["a", "b", "c"]).getStages()
    return Pipeline(stages=[*stages, estimator.setLabelCol("y").setFeaturesCol("scaledFeatures")]).fit(df)


@pytest.fixture(scope="module")
def forest(frame):
    return _model(frame[0], RandomForestRegressor(numTrees=4, maxDepth=4, seed=1))


def test_correlation_skips_missing_pairs(frame):
    df, pdf = frame
    want = pdf[["a", "b", "c", "k"]].corr()
    got = {(r["f1"], r["f2"]): r["corr"] for r in explanation.correlation_matrix(df, ["a", "b", "c", "k"]).collect()}
    assert len(got) == 16
    for (f1, f2), value in got.items():
        if "k" in (f1, f2):
            assert value is None
        else:
            assert value == pytest.approx(want.loc[f1, f2])


def test_correlation_of_independent_columns_is_zero(spark):
    df = spark.createDataFrame([(x, y) for x in (0.0, 1.0) for y in (0.0, 1.0)], "x double, y double")
    got = {(r["f1"], r["f2"]): r["corr"] for r in explanation.correlation_matrix(df, ["x", "y"]).collect()}
    assert got["x", "x"] == got["y", "y"] == 1.0
    assert got["x", "y"] == got["y", "x"] == pytest.approx(0.0, abs=1e-15)


def test_lines_and_points(frame):
    df, pdf = frame
    lines = {r["feature"]: r for r in explanation.dependence_lines(df, ["a", "b", "k"], "y").collect()}
    for f in ("a", "b"):
        known = pdf.dropna(subset=[f])
        slope, intercept = np.polyfit(known[f], known["y"], 1)
        assert lines[f]["slope"] == pytest.approx(slope) and lines[f]["intercept"] == pytest.approx(intercept)
    assert lines["k"]["slope"] is None
    assert explanation.dependence_points(df, ["a", "c"], "y").count() == 600


def test_importances(spark, frame, forest):
    table = explanation.importance_table(spark, forest.stages[-1], ["a", "b", "c"]).collect()
    assert [r["importance"] for r in table] == sorted((r["importance"] for r in table), reverse=True)
    assert sum(r["importance"] for r in table) == pytest.approx(1) and table[0]["feature"] == "a"
    linear = _model(frame[0], LinearRegression())
    ranked = explanation.importance_table(spark, linear.stages[-1], ["a", "b", "c"])
    assert {r["kind"] for r in ranked.collect()} == {"coefficient"}
    assert explanation.top_features(ranked, 1) == ["a"]
    with pytest.raises(ValueError):
        explanation.importance_table(spark, forest.stages[0], ["a"])


def test_gain_importance_counts_the_splits(spark, forest):
    trees = forest.stages[-1]
    table = explanation.gain_importance(spark, trees, ["a", "b", "c"]).collect()
    inner = sum(t.numNodes // 2 for t in trees.trees)
    assert sum(r["n_splits"] for r in table) == inner
    assert sum(r["gain_share"] for r in table) == pytest.approx(1)
    assert table[0]["feature"] == "a"
    assert all(r["mean_gain"] == pytest.approx(r["total_gain"] / r["n_splits"]) for r in table)


def test_partial_dependence_equals_scoring_each_point(frame, forest):
    df, pdf = frame
    table = explanation.partial_dependence(forest, df, ["a", "b"], ["a", "b", "c"], points=4).collect()
    assert len(table) == 8
    for row in table:
        grid = np.linspace(pdf[row["feature"]].min(), pdf[row["feature"]].max(), 4)
        assert row["point"] == pytest.approx(grid[row["step"]])
        moved = forest.transform(df.withColumn(row["feature"], F.lit(row["point"])))
        assert row["mean_prediction"] == pytest.approx(moved.agg(F.avg("prediction")).first()[0])
