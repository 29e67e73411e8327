"""Model specifications, the training loop and scoring.

A specification is a name and a function that fits on training rows; the
validation rows are handed along for the one model that stops early on them.
"""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from math import ceil
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from headway.operators import grouping
from headway.operators.grouping import GROUP, MARK, WEIGHT
from headway.session import shared_dir

log = logging.getLogger(__name__)

SEED = 42

# Model names and the parameters that decide their results.
ELASTIC_NET = {"maxIter": 50, "regParam": 0.3, "elasticNetParam": 0.8}
RIDGE_ALPHA = 1.0
LASSO_ALPHA = 0.1
FORESTS = {
    "RandomForest_50": {"numTrees": 50, "maxDepth": 10},
    "RandomForest_100": {"numTrees": 100, "maxDepth": 15},
    "RandomForest_200": {"numTrees": 200, "maxDepth": 15},
    "TimeSeries_RF": {
        "numTrees": 100, "maxDepth": 15, "featureSubsetStrategy": "sqrt", "minInstancesPerNode": 4,
    },
}
BOOSTED = {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1}
EARLY_STOPPED = {"maxDepth": 6}
STEP, ROW_SHARE, COLUMN_SHARE = 0.1, 0.8, 0.8
MAX_ROUNDS, PATIENCE = 500, 20

# Training rows are placed in as many parts on any cluster: Spark draws the samples of
# trees part by part, so their number belongs to the result. It follows the rows alone.
LEAST_PARTS, ROWS_A_PART = 8, 2_000_000

CHECKPOINT_ROUNDS = 10  # rounds whose lineage is cut at once
TREES_AT_ONCE = 8  # trees of a grouped forest that are fitted side by side

# Fixed value: seconds after which a model is given up.
TIME_LIMIT = 1800.0
CANCEL_EVERY = 0.2


@dataclass(frozen=True)
class TrainingData:
    """Prepared rows: a feature vector and the label side by side in each row.

    ``parts`` is the number of parts that training rows are placed in for trees; by
    default it follows their number. ``placed`` holds them as they were placed once
    for several models, ``shared`` their groups once a model has asked for them.
    """

    train: DataFrame
    val: DataFrame
    label: str
    features: str = "scaledFeatures"
    parts: int | None = None
    placed: DataFrame | None = None
    shared: dict | None = None

    def columns(self) -> dict[str, str]:
        return {"labelCol": self.label, "featuresCol": self.features}


Fit = Callable[[TrainingData], Model]


@dataclass(frozen=True)
class ModelSpec:
    name: str
    fit: Fit


@dataclass
class ModelRun:
    name: str
    order: int
    status: str
    seconds: float
    model: Model | None = None
    error: str | None = None


def parts_for(rows: int) -> int:
    return max(LEAST_PARTS, ceil(rows / ROWS_A_PART))


def placed(data: TrainingData) -> DataFrame:
    """Training rows in a fixed number of parts and order that depend on their values alone.

    The same rows give the same trees, whatever the files and the cluster they come
    from. Rows that hash alike are the same row to a model.
    """
    if data.placed is not None:
        return data.placed
    mark = F.xxhash64(F.col(data.label), vector_to_array(F.col(data.features)))
    rows = data.train.select(data.features, data.label).withColumn(MARK, mark)
    return rows.repartition(data.parts or parts_for(rows.count()), MARK).sortWithinPartitions(MARK)


@contextmanager
def grouped(data: TrainingData, least: float = 0.0) -> Iterator[grouping.Groups | None]:
    """Training rows by feature vector, or None where they are under ``least`` times the vectors or too many differ."""
    shared = {} if data.shared is None else data.shared
    if "groups" not in shared:
        shared["groups"] = grouping.by_features(data.train, data.features, data.label)
    groups = shared["groups"]
    try:
        yield groups if groups is not None and groups.size * least <= groups.rows else None
    finally:
        if groups is not None and data.shared is None:
            groups.release()


# Parameters that speak of single rows; with them trees are fitted on the rows themselves.
OF_ROWS = {"subsamplingRate", "weightCol", "validationIndicatorCol", "minWeightFractionPerNode"}


def by_weight(params: dict, rows: float) -> dict | None:
    """Parameters for weighted rows: a least number of rows in a node is a share of their weight. None if there is none."""
    least = params.get("minInstancesPerNode", 1)
    if 4 * least > rows:
        return None
    rest = {k: v for k, v in params.items() if k != "minInstancesPerNode"}
    return rest if least == 1 else rest | {"minWeightFractionPerNode": (least - 0.5) / rows}


# --- linear family -----------------------------------------------------------

def elastic_net(**overrides) -> Fit:
    params = {**ELASTIC_NET, **overrides}
    return lambda data: LinearRegression(**data.columns(), **params).fit(data.train)


def least_squares() -> Fit:
    return lambda data: LinearRegression(**data.columns(), regParam=0.0).fit(data.train)


def ridge(alpha: float = RIDGE_ALPHA) -> Fit:
    """Minimise |y - Xw|^2 + alpha*|w|^2.

    Spark weighs the L2 term by regParam over the population deviation of the
    label (normal solver), hence the one aggregate before the fit.
    """

    def fit(data: TrainingData) -> Model:
        n, spread_y = data.train.agg(F.count(data.label), F.stddev_pop(data.label)).first()
        return LinearRegression(
            **data.columns(), solver="normal", standardization=False,
            elasticNetParam=0.0, regParam=alpha * (spread_y or 0.0) / max(n, 1),
        ).fit(data.train)

    return fit


def lasso(alpha: float = LASSO_ALPHA) -> Fit:
    """Minimise |y - Xw|^2 / (2n) + alpha*|w|_1."""
    return lambda data: LinearRegression(
        **data.columns(), standardization=False, elasticNetParam=1.0, regParam=alpha
    ).fit(data.train)


# --- trees -------------------------------------------------------------------

def forest(seed: int = SEED, max_memory_mb: int = 512, **params) -> Fit:
    """Random forest. More memory per node group means fewer passes over the rows.

    Where the rows have so few feature vectors that there are fewer sums (one for each
    vector and tree) than rows, the trees are fitted on the sums; see ``grouped_forest``.
    """
    trees, drawn = params.get("numTrees", 20), params.get("bootstrap", True)

    def fit(data: TrainingData) -> Model:
        with grouped(data, trees if drawn else 1) as groups:
            known = None if groups is None or (OF_ROWS - {"subsamplingRate"}) & set(params) else by_weight(params, groups.rows)
            settings = {**data.columns(), "seed": seed, "maxMemoryInMB": max_memory_mb}
            if known is not None and drawn:
                return grouped_forest(groups, data, seed, settings, params)
            if known is not None and "subsamplingRate" not in params:
                return RandomForestRegressor(**settings, weightCol=WEIGHT, **known).fit(groups.table)
            return RandomForestRegressor(**settings, **params).fit(placed(data))

    return fit


def grouped_forest(groups: grouping.Groups, data: TrainingData, seed: int, settings: dict, params: dict) -> RandomForestRegressionModel:
    """A forest whose trees are fitted on the sums of their bootstrap samples, one weighted row for each vector.

    Every row is drawn for every tree with Spark's own chances (``grouping.bootstrap``),
    and every tree is Spark's own on its sample: bins, candidate slots of a node and
    leaves as in a forest. The draws are others than those of a forest fitted on the rows.
    """
    trees = params.get("numTrees", 20)
    slots = params.get("featureSubsetStrategy", "auto")
    own = {k: v for k, v in params.items() if k not in ("numTrees", "bootstrap", "subsamplingRate")}
    own["featureSubsetStrategy"] = "onethird" if slots == "auto" and trees > 1 else slots
    sums = grouping.bootstrap(groups, trees, params.get("subsamplingRate", 1.0), seed)
    sums = sums.coalesce(max(1, ceil(groups.size / grouping.GROUPS_A_PART))).persist()
    seeds = [int(s) for s in np.random.default_rng(seed).integers(0, 1 << 62, trees)]
    try:
        sizes = dict(sums.select(F.posexplode("drawn")).groupBy("pos").agg(F.sum("col")).collect())

        def tree(at: int) -> DecisionTreeRegressionModel:
            sample = sums.select(data.features, F.col("drawn")[at].alias(WEIGHT), F.col("total")[at].alias("total")).filter(F.col(WEIGHT) > 0)
            known = by_weight(own, sizes[at]) or {**own, "maxDepth": 0}
            return RandomForestRegressor(
                **{**settings, "seed": seeds[at]}, weightCol=WEIGHT, numTrees=1, bootstrap=False, **known
            ).fit(sample.select(data.features, WEIGHT, (F.col("total") / F.col(WEIGHT)).alias(data.label))).trees[0]

        with ThreadPool(min(trees, TREES_AT_ONCE)) as pool:
            # Threads take the caller's job tags along, so a time limit reaches them.
            fitted = pool.map(inheritable_thread_target(data.train.sparkSession)(tree), range(trees), chunksize=1)
    finally:
        sums.unpersist()
    context = SparkContext._active_spark_context
    regression = context._jvm.org.apache.spark.ml.regression
    jtrees = context._gateway.new_array(regression.DecisionTreeRegressionModel, trees)
    for i, one in enumerate(fitted):
        jtrees[i] = one._java_obj
    whole = RandomForestRegressionModel(regression.RandomForestRegressionModel(f"{fitted[0].uid}_{trees}", jtrees, fitted[0].numFeatures))
    for name, value in {**settings, **params, "numTrees": trees}.items():  # the mean over trees is taken by numTrees
        whole.set(whole.getParam(name), value)
    return whole.copy()  # hands the settings to the JVM side


def boosted(seed: int = SEED, **overrides) -> Fit:
    """Boosted trees; every tenth round is checkpointed to keep the lineage short.

    Rows with equal features have equal predictions, so their mean label and number
    give the same trees as they do: where they are far more than the vectors, the
    trees are fitted on those.
    """
    params = {**BOOSTED, **overrides}

    def fit(data: TrainingData) -> Model:
        shared_dir(data.train.sparkSession)
        with grouped(data) as groups:
            known = None if groups is None or OF_ROWS & set(params) else by_weight(params, groups.rows)
            if known is not None:
                return GBTRegressor(**data.columns(), seed=seed, weightCol=WEIGHT, **known).fit(groups.table)
            return GBTRegressor(**data.columns(), seed=seed, **params).fit(placed(data))

    return fit


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds to keep, and whether ``patience`` rounds went by without a better one."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def assembled(
    trees: Sequence[DecisionTreeRegressionModel], weights: Sequence[float], features: str = "scaledFeatures", label: str = "label"
) -> GBTRegressionModel:
    """Trees on the same vector and their weights as one boosted model.

    Spark's public constructor for this is on the JVM side only; the model scores in
    one pass, names its importances and is saved like any other.
    """
    context = SparkContext._active_spark_context
    regression = context._jvm.org.apache.spark.ml.regression
    jtrees = context._gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    jweights = context._gateway.new_array(context._jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        jtrees[i], jweights[i] = tree._java_obj, float(weight)
    whole = GBTRegressionModel(
        regression.GBTRegressionModel(f"{trees[0].uid}_{len(trees)}", jtrees, jweights, trees[0].numFeatures)
    )
    whole.set(whole.labelCol, label)
    whole.set(whole.featuresCol, features)
    return whole.copy()  # hands the settings to the JVM side


def columns_of(round_no: int, slots: int, share: float, seed: int) -> list[int]:
    """The slots that the tree of a round may split on: a seeded share of them, one at least."""
    chosen = np.random.default_rng([seed, round_no]).permutation(slots)[: max(1, int(share * slots))]
    return sorted(int(i) for i in chosen)


def boost(
    data: TrainingData, max_rounds: int, patience: int | None, step: float = STEP, row_share: float = ROW_SHARE,
    column_share: float = COLUMN_SHARE, seed: int = SEED, **params,
) -> tuple[GBTRegressionModel, list[float]]:
    """Boost round by round; the model of the best round, and the validation error of every round fitted.

    The state of the loop is a table: label, features, residual, weight and round of each
    row, or of each feature vector where the rows are far more than those (the residual
    is the mean then, and a sample is the number and mean of the rows drawn of a vector).
    A round fits one tree on a share of the training rows, chosen by a hash of their
    values, and on a share of the slots (the others are multiplied by 0, so no split
    falls on them and slots keep their numbers). The residuals that it leaves are the
    next state, which the next tree's first pass fills; those of the validation rows
    give its error. No round is fitted twice: the loop ends ``patience`` rounds after
    the best one. The first tree counts whole, the others fit twice the residual and
    count by ``step``, as in Spark's own boosting. Every tenth state is checkpointed.
    """
    shared_dir(data.train.sparkSession)
    with grouped(data) as groups:
        known = None if groups is None or OF_ROWS & set(params) else by_weight(params, row_share * groups.rows)
        return _boost(data, groups if known is not None else None, max_rounds, patience, step, row_share, column_share, seed, params)


def _boost(data, groups, max_rounds, patience, step, row_share, column_share, seed, params):
    residual, target, turn, spread = "__residual", "__target", "__round", "__spread"
    key = MARK if groups is None else GROUP

    def begin(rows: DataFrame, weight=F.lit(1.0), more=F.lit(0.0)) -> DataFrame:
        return rows.select(
            data.features, key, F.col(data.label).cast("double").alias(residual), F.lit(0).alias(turn), weight.alias(WEIGHT), more.alias(spread)
        ).persist()

    if groups is None:
        train = begin(placed(data))
        val = begin(data.val.select(data.features, data.label).withColumn(MARK, F.lit(0).cast("bigint")))
    else:
        train = begin(groups.table, F.col(WEIGHT))
        val = begin(grouping.collapsed(data.val, data.features, data.label, spread), F.col(WEIGHT), F.col(spread))

    def share(state: DataFrame, at: int) -> DataFrame:
        """The rows that a round's tree is fitted on."""
        if groups is None:
            return state.filter(drawn).withColumn(target, F.col(residual) * (2.0 if at else 1.0))
        if row_share >= 1.0:
            return state.withColumn(target, F.col(residual) * (2.0 if at else 1.0))
        # The mean residual of the rows drawn: that of all, moved as the mean label of those drawn is.
        some = groups.cells.withColumn(turn, F.lit(at)).filter(drawn).groupBy(GROUP).agg(
            F.sum("copies").cast("double").alias("n"), (F.sum(F.col(data.label).cast("double") * F.col("copies")) / F.sum("copies")).alias("mean")
        )
        whole = groups.table.select(GROUP, F.col(data.label).alias("whole"))
        return state.drop(WEIGHT).join(some, GROUP).join(whole, GROUP).select(
            data.features, F.col("n").alias(WEIGHT), ((F.col(residual) + F.col("mean") - F.col("whole")) * (2.0 if at else 1.0)).alias(target)
        ).coalesce(groups.table.rdd.getNumPartitions())

    drawn = F.pmod(F.xxhash64(MARK, turn, F.lit(seed)), F.lit(10_000)) < int(row_share * 10_000)
    trees: list[DecisionTreeRegressionModel] = []
    errors: list[float] = []
    older: list[DataFrame] = []
    try:
        slots = len(train.first()[data.features])
        for at in range(max_rounds):
            mask = np.zeros(slots)
            mask[columns_of(at, slots, column_share, seed)] = 1.0
            masked = ElementwiseProduct(scalingVec=Vectors.dense(mask), inputCol=data.features, outputCol="__masked")
            sample = share(train, at)
            weighed = params if groups is None else {"weightCol": WEIGHT, **by_weight(params, row_share * groups.rows)}
            tree = DecisionTreeRegressor(
                featuresCol="__masked", labelCol=target, predictionCol="__step", seed=seed, maxMemoryInMB=512, **weighed
            ).fit(masked.transform(sample)).setFeaturesCol(data.features)
            trees.append(tree)
            left = (F.col(residual) - F.col("__step") * (step if at else 1.0)).alias(residual)
            states = []
            for state in (train, val):
                moved = tree.transform(state).select(data.features, key, left, (F.col(turn) + 1).alias(turn), WEIGHT, spread).persist()
                if at % CHECKPOINT_ROUNDS == CHECKPOINT_ROUNDS - 1:
                    kept = moved.checkpoint()
                    moved.unpersist()
                    moved = kept
                states.append(moved)
            square = F.col(residual) * F.col(residual)
            mean = F.avg(square) if groups is None else F.sum(F.col(WEIGHT) * square + F.col(spread)) / F.sum(WEIGHT)
            errors.append(states[1].agg(mean).first()[0])
            done, older = older, [train, val]  # the state before is filled only by the next tree
            for state in done:
                state.unpersist()
            train, val = states
            if patience is not None and best_round(errors, patience)[1]:
                break
    finally:
        for state in (*older, train, val):
            state.unpersist()
    keep = best_round(errors, len(errors))[0] if patience is not None else len(trees)
    return assembled(trees[:keep], [1.0, *[step] * (keep - 1)], data.features, data.label), errors


def early_stopped(max_rounds: int = MAX_ROUNDS, patience: int = PATIENCE, seed: int = SEED, **overrides) -> Fit:
    """Boosting that stops once validation error has not improved for ``patience`` rounds."""
    return lambda data: boost(data, max_rounds, patience, seed=seed, **{**EARLY_STOPPED, **overrides})[0]


# --- families and loop -------------------------------------------------------

def forest_specs() -> list[ModelSpec]:
    return [ModelSpec(name, forest(**params)) for name, params in FORESTS.items()]


def default_specs() -> list[ModelSpec]:
    """Elastic net, four forests, boosted trees."""
    return [
        ModelSpec("LinearRegression", elastic_net()),
        *forest_specs(),
        ModelSpec("GBTRegressor", boosted()),
    ]


def early_stop_specs() -> list[ModelSpec]:
    """Least squares, ridge, lasso, four forests, boosted trees with early stopping."""
    return [
        ModelSpec("LinearRegression", least_squares()),
        ModelSpec("Ridge", ridge()),
        ModelSpec("Lasso", lasso()),
        *forest_specs(),
        ModelSpec("GBT_EarlyStop", early_stopped()),
    ]


@contextmanager
def time_limit(spark: SparkSession, seconds: float | None) -> Iterator[threading.Event]:
    """Cancel the Spark jobs started inside once the time is over; the event says whether it was.

    Jobs carry a tag of their own, so those of others go on. They are cancelled again
    and again until the block is left: a fit is many jobs, and may be between two.
    """
    over, done = threading.Event(), threading.Event()
    if seconds is None:
        yield over
        return
    context, tag = spark.sparkContext, f"limited-{uuid.uuid4().hex}"

    def watch() -> None:
        if not done.wait(seconds):
            over.set()
            while not done.wait(CANCEL_EVERY):
                context.cancelJobsWithTag(tag)

    watcher = threading.Thread(target=watch, daemon=True)
    context.addJobTag(tag)
    watcher.start()
    try:
        yield over
    finally:
        done.set()
        context.removeJobTag(tag)
        watcher.join()


class TrainingFailed(RuntimeError):
    """A model was not fitted in a run that was to have all of them."""


def train_all(specs: Iterable[ModelSpec], data: TrainingData, limit: float | None = TIME_LIMIT, whole: bool = False) -> list[ModelRun]:
    """Fit every model; one that fails or takes over ``limit`` seconds is reported and does not stop the others.

    With ``whole`` it ends them all with an error: what is made of the others alone is no
    result for one who reads no status.
    """
    runs = []
    rows = placed(data).persist()  # filled by the first tree that asks for them
    data = replace(data, placed=rows, shared={})
    try:
        for order, spec in enumerate(specs):
            started, model, problem, cause, status = time.monotonic(), None, None, None, "ok"
            with time_limit(data.train.sparkSession, limit) as over:
                try:
                    model = spec.fit(data)
                except Exception as error:  # noqa: BLE001 - any failure belongs to this model only
                    problem, cause, status = str(error), error, "failed"
            if over.is_set():
                model, status, problem = None, "timeout", f"not fitted in {limit:g} seconds"
            if problem is not None:
                log.warning("training %s: %s: %s", spec.name, status, problem)
                if whole:
                    raise TrainingFailed(f"training {spec.name}: {status}: {problem}") from cause
            runs.append(ModelRun(spec.name, order, status, time.monotonic() - started, model, problem))
    finally:
        rows.unpersist()
        if data.shared.get("groups") is not None:
            data.shared["groups"].release()
    return runs


def prediction_column(name: str) -> str:
    return f"pred_{name}"


def score(df: DataFrame, runs: Iterable[ModelRun]) -> DataFrame:
    """Add one prediction column per fitted model to the same rows: one pass, no join."""
    for run in runs:
        if run.model is not None:
            df = run.model.copy().setPredictionCol(prediction_column(run.name)).transform(df)
    return df


def timing_table(spark, runs: Sequence[ModelRun]) -> DataFrame:
    """Status and seconds of each fit, and their running order."""
    schema = T.StructType(
        [
            T.StructField("model", T.StringType()),
            T.StructField("model_order", T.IntegerType()),
            T.StructField("status", T.StringType()),
            T.StructField("seconds", T.DoubleType()),
            T.StructField("error", T.StringType()),
        ]
    )
    return spark.createDataFrame([(r.name, r.order, r.status, r.seconds, r.error) for r in runs], schema)


@dataclass
class SearchResult:
    params: dict
    rmse: float
    model: Model = field(repr=False)


def grid_search(
    make: Callable[..., Fit], grid: Iterable[dict], data: TrainingData
) -> list[SearchResult]:
    """Fit each setting on the training rows and rank by validation error.

    All settings are scored in one pass over the validation rows. Rows keep their
    time order: nothing is folded or shuffled, unlike cross-validation.
    """
    fitted = [(params, make(**params)(data)) for params in grid]
    scored = score(data.val, [ModelRun(str(i), i, "ok", 0.0, m) for i, (_, m) in enumerate(fitted)])
    miss = [F.col(f"`{prediction_column(str(i))}`") - F.col(data.label) for i in range(len(fitted))]
    errors = scored.agg(*[F.sqrt(F.avg(e * e)) for e in miss]).first()
    ranked = [SearchResult(p, e, m) for (p, m), e in zip(fitted, errors)]
    return sorted(ranked, key=lambda r: r.rmse)
