import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from headway.operators import grouping, modeling
from headway.operators.modeling import ModelSpec, TrainingData


def _frame(spark, n=1200):
    """Rows of 5 x 4 feature vectors, labels all over the place, some rows twice."""
    unit = F.pmod(F.xxhash64(F.lit("y"), F.col("id")), F.lit(10_000)) / F.lit(10_000.0)
    rows = spark.range(n).select("id", (F.col("id") % 5).cast("double").alias("a"), F.floor(F.col("id") / 7 % 4).cast("double").alias("b"), unit.alias("e"))
    rows = rows.unionByName(rows.filter("id % 10 = 0")).withColumn("y", 3 * F.col("a") - F.col("a") * F.col("b") + F.col("e"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="scaledFeatures").transform(rows)


@pytest.fixture(scope="module")
def data(spark):
    df = _frame(spark)
    return TrainingData(df.filter("id < 900").cache(), df.filter("id >= 900").cache(), "y")


@pytest.fixture(autouse=True)
def any_number(monkeypatch):
    monkeypatch.setattr(grouping, "FEWEST_ROWS", 0)


@pytest.fixture
def no_rows(monkeypatch):
    """A tree that asks for the rows themselves fails."""
    def refuse(data):
        raise AssertionError("fitted on rows")

    monkeypatch.setattr(modeling, "placed", refuse)


def _predictions(model, df):
    return [r[0] for r in model.transform(df).orderBy("id", "e").select("prediction").collect()]


def test_draws_are_poisson_numbers_of_the_rows_alone():
    marks, copies = np.arange(20_000) * 7 - 50_000, np.repeat([1, 2, 9, 32], 5_000)
    drawn = grouping.draws(marks, np.zeros(20_000), copies, 12, 0.5, 42)
    for m in (1, 2, 9, 32):
        some = drawn[copies == m]
        assert some.mean() == pytest.approx(0.5 * m, rel=0.02) and some.var() == pytest.approx(0.5 * m, rel=0.05)
    assert abs(np.corrcoef(drawn[:5_000].T) - np.eye(12)).max() < 0.06
    back = grouping.draws(marks[::-1], np.zeros(20_000), copies[::-1], 12, 0.5, 42)
    assert (back[::-1] == drawn).all() and (grouping.draws(marks, np.zeros(20_000), copies, 12, 0.5, 43) != drawn).any()


def test_sums_are_those_of_every_row(spark, data, monkeypatch):
    monkeypatch.setattr(grouping, "MOST_COPIES", 2)
    three = data.train.unionByName(data.train).unionByName(data.train)
    found = []
    for parts in (2, 9):
        groups = grouping.by_features(three.repartition(parts), "scaledFeatures", "y")
        assert groups.size == 20 and groups.table.agg(F.sum("__weight")).first()[0] == groups.rows == three.count()
        found.append({r["__group"]: r for r in grouping.bootstrap(groups, 6, 1.0, 1).collect()})
        cells = groups.cells.collect()
        groups.release()
    assert found[0].keys() == found[1].keys() and len(found[0]) == 20
    for g, row in found[0].items():
        assert row["drawn"] == found[1][g]["drawn"] and row["total"] == pytest.approx(found[1][g]["total"])
        want, total = np.zeros(6), np.zeros(6)
        for c in cells:
            if c["__group"] == g:
                for part, left in enumerate(range(c["copies"], 0, -2)):
                    n = grouping.draws(np.array([c["__mark"]]), np.array([part]), np.array([min(left, 2)]), 6, 1.0, 1)[0]
                    want, total = want + n, total + n * c["y"]
        assert row["drawn"] == want.tolist() and row["total"] == pytest.approx(total)


def test_a_forest_is_fitted_on_groups(data, no_rows):
    model = modeling.forest(numTrees=7, maxDepth=6, featureSubsetStrategy="all")(data)
    assert model.getNumTrees == 7 and model.numFeatures == 2 and model.getMaxDepth() == 6
    assert model.featureImportances.toArray().sum() == pytest.approx(1.0)
    means = {(r["a"], r["b"]): r["m"] for r in data.train.groupBy("a", "b").agg(F.avg("y").alias("m")).collect()}
    for r in model.transform(data.val).select("a", "b", "prediction").distinct().collect():
        assert r["prediction"] == pytest.approx(means[r["a"], r["b"]], abs=0.15)
    again = modeling.forest(numTrees=7, maxDepth=6, featureSubsetStrategy="all")(TrainingData(data.train.repartition(5), data.val, "y"))
    assert _predictions(again, data.val) == pytest.approx(_predictions(model, data.val))
    assert len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) > 1


def test_a_node_holds_its_least_number_of_rows(data, no_rows):
    """Rows count, not vectors: the same tree as on the rows, and leaves of 200 rows in a forest."""
    params = {"numTrees": 1, "maxDepth": 6, "featureSubsetStrategy": "all", "bootstrap": False, "minInstancesPerNode": 200}
    own = modeling.RandomForestRegressor(**data.columns(), seed=1, **params).fit(data.train)
    assert _predictions(modeling.forest(**params)(data), data.val) == pytest.approx(_predictions(own, data.val))
    model = modeling.forest(numTrees=3, maxDepth=6, minInstancesPerNode=200)(data)
    assert all(1 < t.numNodes <= 2 * (990 * 1.2 // 200) - 1 for t in model.trees)


def test_boosting_on_groups_is_boosting_on_rows(data, no_rows):
    own = modeling.GBTRegressor(**data.columns(), maxIter=6, maxDepth=3, stepSize=0.1, seed=42).fit(data.train)
    model = modeling.boosted(maxIter=6, maxDepth=3)(data)
    assert _predictions(model, data.val) == pytest.approx(_predictions(own, data.val))
    assert model.featureImportances.toArray() == pytest.approx(own.featureImportances.toArray())


@pytest.mark.parametrize("share", [1.0, 0.7])
def test_the_loop_on_groups_is_the_loop_on_rows(data, monkeypatch, share):
    def fit():
        model, errors = modeling.boost(data, 12, None, row_share=share, column_share=1.0, maxDepth=3)
        return _predictions(model, data.val), errors

    with monkeypatch.context() as patch:
        patch.setattr(grouping, "by_features", lambda *_: None)
        values, errors = fit()
    monkeypatch.setattr(modeling, "placed", None)
    found, again = fit()
    assert found == pytest.approx(values) and again == pytest.approx(errors)


def test_models_of_a_run_share_the_groups(data, monkeypatch):
    made = []
    build = grouping.by_features
    monkeypatch.setattr(grouping, "by_features", lambda *a: made.append(1) or build(*a))
    specs = [ModelSpec("forest", modeling.forest(numTrees=2, maxDepth=2)), ModelSpec("boosted", modeling.boosted(maxIter=2, maxDepth=2))]
    runs = modeling.train_all([*specs, ModelSpec("loop", modeling.early_stopped(2, 1))], data)
    assert [r.status for r in runs] == ["ok"] * 3 and len(made) == 1


def test_few_rows_or_rows_that_differ_are_not_grouped(spark, data, monkeypatch):
    rows = data.train.withColumn("a", F.col("id").cast("double")).drop("scaledFeatures")
    apart = VectorAssembler(inputCols=["a", "b"], outputCol="scaledFeatures").transform(rows)
    assert grouping.by_features(apart, "scaledFeatures", "y") is None
    assert grouping.by_features(apart.limit(0), "scaledFeatures", "y") is None
    monkeypatch.setattr(grouping, "FEWEST_ROWS", 1_000)
    assert grouping.by_features(data.train, "scaledFeatures", "y") is None


def test_a_missing_label_is_refused_as_before(spark, data):
    broken = data.train.withColumn("y", F.when(F.col("id") != 3, F.col("y")))
    for fit in (modeling.forest(numTrees=2, maxDepth=2), modeling.boosted(maxIter=1, maxDepth=1)):
        with pytest.raises(Exception, match="(?i)null|nan"):
            fit(TrainingData(broken, data.val, "y"))
