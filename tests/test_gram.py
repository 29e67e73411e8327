import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.operators import gram, modeling
from headway.operators.modeling import TrainingData
from tests.test_modeling import _frame

COLUMNS = list("abc")


@pytest.fixture(scope="module")
def df(spark):
    return _frame(spark, noise=3.0).withColumn("block", (F.col("id") / 100).cast("int")).cache()


@pytest.fixture(scope="module")
def blocks(df):
    return gram.moments(df, COLUMNS, "y", "block")


@pytest.fixture(scope="module")
def train(blocks):
    return sum((blocks[b] for b in range(1, 4)), blocks[0])


@pytest.fixture(scope="module")
def data(df):
    return TrainingData(df.filter("block < 4"), df.filter("block >= 4"), "y")


def _values(df):
    rows = df.select(*COLUMNS, "y").collect()
    return np.array([r[:] for r in rows], float)


def test_moments_of_parts_add_up(df, train):
    x = _values(df.filter("block < 4"))
    assert train.n == len(x)
    assert train.mean == pytest.approx(x.mean(0))
    assert train.product == pytest.approx((x - x.mean(0)).T @ (x - x.mean(0)))
    scaled = train.scaled(x.mean(0)[:3], x.std(0, ddof=1)[:3])
    assert np.diag(scaled.product)[:3] == pytest.approx([len(x) - 1] * 3) and scaled.mean[:3] == pytest.approx([0] * 3, abs=1e-12)


@pytest.mark.parametrize("fit, own", [
    (gram.least_squares, modeling.least_squares()),
    (lambda m: gram.ridge(m, 50.0), modeling.ridge(50.0)),
    (lambda m: gram.lasso(m, 0.05), modeling.lasso(0.05)),
    (lambda m: gram.elastic_net(m, 0.05, 0.5), modeling.elastic_net(regParam=0.05, elasticNetParam=0.5, maxIter=500, tol=1e-10)),
])
def test_fits_are_those_of_the_solvers_on_rows(data, train, blocks, fit, own):
    found, want = fit(train), own(data)  # the solver of lasso stops early
    assert found.weights == pytest.approx(want.coefficients.toArray(), abs=5e-4)
    assert found.intercept == pytest.approx(want.intercept, abs=5e-4)
    val = blocks[4] + blocks[5]
    scored = data.val.withColumn("p", found.column(COLUMNS))
    assert found.error(val) == pytest.approx(scored.agg(F.sum((F.col("p") - F.col("y")) ** 2)).first()[0])


def test_lasso_meets_its_conditions(train):
    alpha = 0.05
    w = gram.lasso(train, alpha).weights
    gradient = (train.product[:-1, -1] - train.product[:-1, :-1] @ w) / train.n
    for g, wi in zip(gradient, w):
        assert g == pytest.approx(alpha * np.sign(wi), abs=1e-9) if wi else abs(g) <= alpha


def test_search_ranks_like_fitting_each_setting(data, train, blocks):
    grid = [{"regParam": p} for p in (5.0, 0.001, 0.1)]
    found = gram.search(gram.elastic_net, grid, train, blocks[4] + blocks[5])
    want = modeling.grid_search(modeling.elastic_net, grid, data)
    assert [m.params for m in found] == [r.params for r in want]
    assert [m.rmse for m in found] == pytest.approx([r.rmse for r in want], rel=1e-4)


def test_rolling_folds_train_on_all_blocks_before(df, blocks):
    folds = gram.rolling(gram.ridge, [{"alpha": 1.0}, {"alpha": 100.0}], blocks, first=2)
    assert [(f.block, f.n_train, f.n) for f in folds[::2]] == [(2, 200, 100), (3, 300, 100), (4, 400, 100), (5, 500, 100)]
    last = gram.ridge(gram.moments(df.filter("block < 5"), COLUMNS, "y", F.lit(0))[0], 100.0)
    assert folds[-1].rmse == pytest.approx((last.error(blocks[5]) / 100) ** 0.5)
    best = gram.rolling_search(gram.ridge, [{"alpha": 1.0}, {"alpha": 1e6}], blocks)
    assert best[0][0] == {"alpha": 1.0} and best[0][1] < best[1][1]


def test_missing_values_constant_columns_and_no_rows(spark, df):
    holes = df.withColumn("a", F.when(F.col("id") % 3 > 0, F.col("a"))).withColumn("b", F.lit(2.0))
    found = gram.moments(holes, COLUMNS, "y", F.lit("all"))["all"]
    assert found.n == 400
    for fit in (gram.least_squares, gram.ridge, gram.lasso, gram.elastic_net):
        assert np.isfinite(fit(found).weights).all() and fit(found).weights[1] == pytest.approx(0, abs=1e-9)
    assert gram.moments(df.filter("id < 0"), COLUMNS, "y", "block") == {}
    assert gram.rolling(gram.ridge, [{}], {}) == []


def test_one_pass_over_the_rows(spark, df):
    context = spark.sparkContext
    context.setJobGroup("gram", "count jobs")
    gram.moments(df, COLUMNS, "y", "block")
    jobs = len(context.statusTracker().getJobIdsForGroup("gram"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 2  # the shuffle and its reading
    with pytest.raises(ValueError, match="features"):
        gram.moments(df, ["a"] * 101, "y", "block")
