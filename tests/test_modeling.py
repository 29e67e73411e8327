import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from headway.operators import explanation, modeling
from headway.operators.modeling import ModelSpec, TrainingData

COEFFICIENTS = (3.0, -2.0, 0.0)


def _frame(spark, n=600, noise=1.0):
    unit = lambda name: F.pmod(F.xxhash64(F.lit(name), F.col("id")), F.lit(10_000)) / F.lit(10_000.0)
    df = spark.range(n).select("id", *[unit(c).alias(c) for c in "abc"], unit("noise").alias("e"))
    label = sum((F.lit(w) * F.col(c) for w, c in zip(COEFFICIENTS, "abc")), F.lit(1.0))
    df = df.withColumn("y", label + F.lit(noise) * (F.col("e") - 0.5))
    return VectorAssembler(inputCols=list("abc"), outputCol="scaledFeatures").transform(df)


@pytest.fixture(scope="module")
def data(spark):
    df = _frame(spark)
    return TrainingData(df.filter("id < 450").cache(), df.filter("id >= 450").cache(), "y")


def _arrays(df):
    rows = df.select("a", "b", "c", "y").collect()
    return np.array([[r["a"], r["b"], r["c"]] for r in rows]), np.array([r["y"] for r in rows])


def test_least_squares(data):
    x, y = _arrays(data.train)
    model = modeling.least_squares()(data)
    want = np.linalg.lstsq(np.c_[np.ones(len(y)), x], y, rcond=None)[0]
    assert model.intercept == pytest.approx(want[0])
    assert model.coefficients.toArray() == pytest.approx(want[1:])


@pytest.mark.parametrize("alpha", [1.0, 50.0])
def test_ridge_has_its_closed_form(data, alpha):
    x, y = _arrays(data.train)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    assert modeling.ridge(alpha)(data).coefficients.toArray() == pytest.approx(want, rel=1e-6)


def test_lasso_meets_its_conditions(data):
    x, y = _arrays(data.train)
    alpha = 0.05
    w = modeling.lasso(alpha)(data).coefficients.toArray()
    xc, yc = x - x.mean(0), y - y.mean()
    gradient = xc.T @ (yc - xc @ w) / len(y)
    for g, wi in zip(gradient, w):
        if wi:
            assert g == pytest.approx(alpha * np.sign(wi), abs=1e-4)
        else:
            assert abs(g) <= alpha + 1e-6


def test_elastic_net_shrinks(data):
    free = modeling.least_squares()(data).coefficients.toArray()
    shrunk = modeling.elastic_net()(data).coefficients.toArray()
    assert np.abs(shrunk).sum() < np.abs(free).sum()


def test_ridge_of_a_constant_label(spark):
    df = _frame(spark, 50).withColumn("y", F.lit(4.0))
    model = modeling.ridge()(TrainingData(df, df, "y"))
    assert model.intercept == pytest.approx(4.0)
    assert model.coefficients.toArray() == pytest.approx([0, 0, 0])


def test_best_round():
    assert modeling.best_round([5, 4, 3, 2], 2) == (4, False)
    assert modeling.best_round([5, 3, 4, 4, 1], 2) == (2, True)
    assert modeling.best_round([5, 3, 4, 2, 4, 4], 2) == (4, True)
    assert modeling.best_round([1, 1, 1], 2) == (1, True)


def _predictions(model, df):
    return [r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()]


def test_boosting_equals_sparks_own(data):
    """With every row and slot in every round the loop gives the trees of Spark's boosting."""
    model, errors = modeling.boost(data, 6, None, row_share=1.0, column_share=1.0, maxDepth=3)
    own = modeling.GBTRegressor(**data.columns(), maxIter=6, maxDepth=3, stepSize=0.1).fit(data.train)
    assert list(model.treeWeights) == list(own.treeWeights)
    assert _predictions(model, data.val) == pytest.approx(_predictions(own, data.val))
    assert errors == pytest.approx(own.evaluateEachIteration(data.val, "squared"))


def test_a_longer_loop_begins_like_a_shorter_one(data):
    short, first = modeling.boost(data, 3, None, maxDepth=3)
    long, errors = modeling.boost(data, 12, None, maxDepth=3)  # with a checkpoint on the way
    assert errors[:3] == pytest.approx(first) and long.getNumTrees == 12
    cut = modeling.assembled(long.trees[:3], long.treeWeights[:3])
    assert _predictions(cut, data.val) == pytest.approx(_predictions(short, data.val))


def test_early_stop_fits_no_round_beyond_its_patience(data):
    model, errors = modeling.boost(data, 24, 3, step=0.5, maxDepth=3)
    best = int(np.argmin(errors)) + 1
    assert model.getNumTrees == best and len(errors) <= min(24, best + 3)
    assert model.evaluateEachIteration(data.val, "squared")[-1] == pytest.approx(min(errors))


def test_a_tree_splits_only_on_its_own_columns(spark, data):
    """Slots are numbered as in the whole vector, in the trees and in both importances."""
    model, _ = modeling.boost(data, 5, None, column_share=0.4, maxDepth=2)
    for at, tree in enumerate(model.trees):
        used = set(np.flatnonzero(tree.featureImportances.toArray()))
        assert used <= set(modeling.columns_of(at, 3, 0.4, modeling.SEED)) and len(used) == 1
    gains = {r["feature"] for r in explanation.gain_importance(spark, model, list("abc")).collect()}
    named = {r["feature"]: r["importance"] for r in explanation.importance_table(spark, model, list("abc")).collect()}
    assert gains == {f for f, v in named.items() if v > 0}


def test_parts_follow_the_rows():
    assert modeling.parts_for(10) == modeling.LEAST_PARTS
    assert modeling.parts_for(100 * modeling.ROWS_A_PART) == 100


def test_forest_importances_and_failure_isolation(spark, data):
    specs = [
        ModelSpec("forest", modeling.forest(numTrees=5, maxDepth=4)),
        ModelSpec("broken", modeling.elastic_net(regParam=-1.0)),
        ModelSpec("linear", modeling.least_squares()),
    ]
    runs = modeling.train_all(specs, data)
    assert [r.status for r in runs] == ["ok", "failed", "ok"]
    assert "regParam" in runs[1].error and runs[1].model is None
    assert runs[0].model.featureImportances.toArray().sum() == pytest.approx(1.0)
    scored = modeling.score(data.val, runs)
    assert {"pred_forest", "pred_linear"} <= set(scored.columns) and "pred_broken" not in scored.columns
    table = {r["model"]: r for r in modeling.timing_table(spark, runs).collect()}
    assert table["broken"]["status"] == "failed" and all(r["seconds"] >= 0 for r in table.values())


def test_a_model_beyond_its_time_is_given_up(spark, data):
    """Its jobs are cancelled, also those that it starts later; other models and other jobs go on."""
    def endless(d):
        for _ in range(3):
            try:
                spark.range(10**15).selectExpr("sum(id % 7)").collect()
            except Exception:  # noqa: BLE001 - a fit that does not let go
                pass
        return modeling.least_squares()(d)

    specs = [ModelSpec("endless", endless), ModelSpec("linear", modeling.least_squares())]
    runs = modeling.train_all(specs, data, limit=1.0)
    assert [r.status for r in runs] == ["timeout", "ok"]
    assert runs[0].model is None and runs[0].seconds < 30 and "1 seconds" in runs[0].error
    assert spark.range(10).count() == 10 and modeling.score(data.val, runs).columns[-1] == "pred_linear"


def test_a_whole_run_ends_with_a_model_that_is_not_fitted(spark, data):
    """Failed or out of time: the error names the model and what went wrong, and no other is fitted."""
    def endless(d):
        spark.range(10**15).selectExpr("sum(id % 7)").collect()

    later = []
    last = ModelSpec("later", later.append)
    linear = ModelSpec("linear", modeling.least_squares())
    with pytest.raises(modeling.TrainingFailed, match="broken: failed: .*regParam") as failed:
        modeling.train_all([linear, ModelSpec("broken", modeling.elastic_net(regParam=-1.0)), last], data, whole=True)
    assert failed.value.__cause__ is not None
    with pytest.raises(modeling.TrainingFailed, match="endless: timeout: not fitted in 1 seconds"):
        modeling.train_all([ModelSpec("endless", endless), last], data, limit=1.0, whole=True)
    assert later == []
    assert [r.status for r in modeling.train_all([linear], data, whole=True)] == ["ok"]


def test_trees_do_not_depend_on_the_partitions(data):
    fits = [
        modeling.forest(numTrees=5, maxDepth=4)(TrainingData(data.train.repartition(n), data.val, data.label)) for n in (1, 7)
    ]
    a, b = ([r[0] for r in f.transform(data.val).orderBy("id").select("prediction").collect()] for f in fits)
    assert a == pytest.approx(b)


def test_importances_of_a_cut_model_name_every_feature(spark, data):
    flat = data.train.withColumn("y", F.lit(1.0))
    model = modeling.boosted(maxIter=3, maxDepth=2)(TrainingData(flat, flat, "y"))
    cut = modeling.assembled(model.trees[:1], model.treeWeights[:1])
    assert len(cut.featureImportances) == model.numFeatures


def test_grid_search_ranks_by_validation_error(data):
    found = modeling.grid_search(modeling.elastic_net, [{"regParam": p} for p in (5.0, 0.001, 0.1)], data)
    assert [r.params["regParam"] for r in found] == [0.001, 0.1, 5.0]
    assert found[0].rmse <= found[1].rmse <= found[2].rmse


def test_families_have_the_fixed_parameters():
    assert [s.name for s in modeling.default_specs()] == [
        "LinearRegression", "RandomForest_50", "RandomForest_100", "RandomForest_200", "TimeSeries_RF", "GBTRegressor",
    ]
    assert [s.name for s in modeling.early_stop_specs()][:3] == ["LinearRegression", "Ridge", "Lasso"]
