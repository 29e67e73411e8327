"""The whole job: trips in, models, errors, explanations and result files out.

The source is read once: cleaning, features and the counts of the source report
are one narrow pass that ends in a staged table. The split is a comparison with
two constants on that table, so no row is moved for it. All models are scored in
one pass into a second staged table, partitioned by split; what follows are
aggregates over it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from headway.functions.calendar import calendar_columns
from headway.operators import categories, charts, cleaning, evaluation, explanation, modeling, ordering, preparation, selection, timeseries
from headway.schema import ENSEMBLE, FEATURES, LABEL, NUMERIC, REQUIRED, TIME
from headway.session import use_utc
from headway.sources import writing

ROW_ID, ROW_MARK = "row_id", "row_mark"


EVALUATED = (
    "Model string, Train_RMSE double, Test_RMSE double, Val_RMSE double, Test_R2 double, "
    "Training_Time double, model_order int"
)


@dataclass(frozen=True)
class RunConfig:
    """What a run does.

    ``key`` names columns that are unique together with the time: they break ties
    of the split. Without them a hash of all kept columns does, so that the parts
    hold the same rows however the source is cut into files. ``parts`` is the number
    of parts that training rows are placed in; by default it follows their number.
    ``whole`` is for those who read the tables and not the status of each model: the
    run has all of its models or ends with an error.
    """

    time: str = TIME
    key: Sequence[str] = ()
    parts: int | None = None
    label: str = LABEL
    numeric: Sequence[str] = NUMERIC
    required: Sequence[str] = REQUIRED
    features: Sequence[str] = FEATURES
    categorical: Sequence[str] = ()
    month_end: str = "last_day"
    train_share: float = 0.7
    test_share: float = 0.2
    random_split: bool = False
    fit_on: str = "train"       # or "all": statistics over every row
    select_on: str = "test"     # or "val": split that ranks the models
    dependence_on: str = "prediction"   # or "label"
    sample: int = 1000   # points of a scatter chart; the full tables are there as well
    time_limit: float | None = modeling.TIME_LIMIT   # seconds that a model may take
    whole: bool = False         # a model that fails or is given up ends the run
    specs: Sequence[modeling.ModelSpec] = field(default_factory=modeling.default_specs)


@dataclass
class Prepared:
    """Cleaned rows as staged, what was counted on the way, and the three parts."""

    rows: DataFrame
    features: list[str]
    source: DataFrame
    nulls: DataFrame
    n_source: int
    n_clean: int
    n_without_time: int
    part: Callable[[DataFrame, str], DataFrame]


@dataclass
class RunResult:
    folder: str
    prepared: Prepared
    feature_model: PipelineModel
    runs: list[modeling.ModelRun]
    predictions: DataFrame
    metrics: DataFrame
    evaluation: DataFrame
    members: list[str]
    best: str | None
    tables: dict[str, DataFrame]
    dictionaries: dict[str, categories.Dictionary] = field(default_factory=dict)

    def model(self, name: str) -> Model:
        return next(r.model for r in self.runs if r.name == name)

    def pipeline(self, name: str) -> PipelineModel:
        """Feature stages and model in one: scores rows that are cleaned and, with categories, encoded."""
        return PipelineModel(stages=[*self.feature_model.stages, self.model(name)])


def clean_trips(named: DataFrame, config: RunConfig) -> DataFrame:
    """Numbers, time, required columns, calendar features: one narrow pass."""
    df = cleaning.cast_numeric(named, config.numeric)
    df = cleaning.parse_time(df, config.time)
    df = cleaning.drop_incomplete(df, config.required)
    return df.withColumns(calendar_columns(F.col(config.time), config.month_end))


def prepare(spark: SparkSession, raw: DataFrame, config: RunConfig, folder: str) -> Prepared:
    """Clean, count and mark the rows in the pass that stages them, then find the split."""
    named = cleaning.normalize_names(raw)
    kinds = [(f.name, f.dataType.simpleString()) for f in named.schema.fields]
    before, after = Observation(), Observation()
    watched = named.observe(
        before,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"nulls {i}") for i, (name, _) in enumerate(kinds)],
    )
    cleaned = clean_trips(watched, config).observe(
        after, F.count(F.lit(1)).alias("rows"), F.count(config.time).alias("timed")
    )
    features = cleaning.available(cleaned, config.features)
    kept = dict.fromkeys([config.time, *config.key, config.label, *features, *config.categorical])
    staged = writing.stage(
        cleaned.select(*kept)
        .withColumns({c: F.col(c).cast("double") for c in features})
        # Equal marks without a key: equal rows, which are the same to every model.
        .withColumn(ROW_MARK, F.xxhash64(*([config.time, *config.key] if config.key else kept)))
        .withColumn(ROW_ID, F.monotonically_increasing_id()),
        "cleaned",
        folder=folder,
    )
    counted, timed = before.get, after.get
    n = counted["rows"]
    source = spark.createDataFrame(
        [(name, kind, n) for name, kind in kinds], "column string, type string, n_rows bigint"
    )
    nulls = spark.createDataFrame(
        [(name, counted[f"nulls {i}"], n) for i, (name, _) in enumerate(kinds)],
        "column string, n_null bigint, n_rows bigint",
    )

    if config.random_split:
        rows = ordering.hash_split(staged.filter(F.col(config.time).isNotNull()), ROW_MARK)

        def part(df: DataFrame, name: str) -> DataFrame:
            return df.filter(F.col("split") == name)
    else:
        split = ordering.fit_chrono_split(
            staged, config.time, list(config.key) or [ROW_MARK, ROW_ID], config.train_share, config.test_share
        )
        rows, part = split.apply(staged), split.rows
    return Prepared(
        rows, features, source, nulls, n, timed["rows"], timed["rows"] - timed["timed"], part
    )


def _evaluate(
    predictions: DataFrame, config: RunConfig, names: Sequence[str], seconds: dict[str, float], first: int = 0
) -> tuple[list, list]:
    """Metric rows and evaluation rows of some models; a handful of values each."""
    if not names:
        return [], []
    columns = {n: modeling.prediction_column(n) for n in names}
    rows = [
        row.asDict() | {"model_order": row["model_order"] + first}
        for row in evaluation.metrics(predictions, config.label, columns).collect()
    ]
    at = {(r["model"], r["split"]): r for r in rows}
    table = []
    for i, name in enumerate(names):
        def value(split, key, name=name):
            return at.get((name, split), {}).get(key)

        table.append(
            (name, value("train", "rmse"), value("test", "rmse"), value("val", "rmse"),
             value("test", "r2"), seconds[name], i + first)
        )
    return rows, table


def run(spark: SparkSession, raw: DataFrame, config: RunConfig = RunConfig()) -> RunResult:
    """Run the job on trips as read; nothing is written but staged tables.

    Once the results are exported, ``writing.discard(spark, result.folder)``
    removes the staged tables.
    """
    use_utc(spark)
    folder = writing.scratch_folder(spark, "run")
    prepared = prepare(spark, raw, config, folder)
    features = prepared.features
    training = prepared.part(prepared.rows, "train")
    fitted_on = training if config.fit_on == "train" else prepared.rows
    dictionaries = categories.fit_dictionaries(fitted_on, config.categorical, folder)
    codes = [categories.code_name(c) for c in dictionaries]
    rows, fitted_on = (categories.encode(df, dictionaries) for df in (prepared.rows, fitted_on))
    feature_model = preparation.fit_features(fitted_on, features, codes)
    scaled = feature_model.transform(rows)

    def part(name: str) -> DataFrame:
        return prepared.part(scaled, name).select("scaledFeatures", config.label)

    data = modeling.TrainingData(part("train"), part("val"), config.label, parts=config.parts)
    try:
        runs = modeling.train_all(config.specs, data, config.time_limit, whole=config.whole)
    except modeling.TrainingFailed:
        writing.discard(spark, folder)
        raise
    names = [r.name for r in runs if r.status == "ok"]
    seconds = {r.name: r.seconds for r in runs}

    # Features go along as imputed, in their own units: explanations are read in those.
    imputed = [F.col(f"{c}_filled").alias(c) for c in features]
    predicted = [f"`{modeling.prediction_column(n)}`" for n in names]
    scored = modeling.score(scaled, runs).select(
        ROW_ID, config.time, "split", config.label, *imputed, *codes, *predicted
    )
    predictions = writing.stage(scored, "predictions", ["split"], folder)

    metric_rows, table = _evaluate(predictions, config, names, seconds)
    by = {"test": "Test_RMSE", "val": "Val_RMSE"}[config.select_on]

    def frame(rows):
        return spark.createDataFrame(rows, EVALUATED)

    ranked = [r["Model"] for r in evaluation.rank_models(frame(table), by, 3).collect()]
    members: list[str] = []
    if len(ranked) == 3:
        members = ranked
        predictions = evaluation.with_ensemble(
            predictions, [modeling.prediction_column(m) for m in members], modeling.prediction_column(ENSEMBLE)
        )
        more_rows, more = _evaluate(
            predictions, config, [ENSEMBLE], {ENSEMBLE: sum(seconds[m] for m in members)}, len(config.specs)
        )
        metric_rows, table, names = metric_rows + more_rows, table + more, [*names, ENSEMBLE]
    best = evaluation.best_model(frame(table), by).first()["Model"]

    metrics = spark.createDataFrame(
        [(r["split"], r["model"], r["model_order"], r["n"], r["rmse"], r["r2"], r["r2_corr"]) for r in metric_rows],
        "split string, model string, model_order int, n bigint, rmse double, r2 double, r2_corr double",
    )
    result = RunResult(
        folder, prepared, feature_model, runs, predictions, metrics, frame(table), members, best, {}, dictionaries
    )
    result.tables = chart_tables(spark, result, config, names)
    return result


def chart_tables(spark: SparkSession, result: RunResult, config: RunConfig, names: Sequence[str]) -> dict[str, DataFrame]:
    """The tables behind every chart; those of the best model need one."""
    test = result.predictions.filter(F.col("split") == "test")
    tables = {
        "rmse_by_split": evaluation.metric_long(result.evaluation, "RMSE"),
        "r2_by_split": result.metrics.select("model", "split", "r2", "r2_corr"),
        "training_time": modeling.timing_table(spark, result.runs),
    }
    if result.best is None:
        return tables
    tables["confusion"] = evaluation.confusion(
        test, config.label, {n: modeling.prediction_column(n) for n in names}
    )
    tables["bin_labels"] = evaluation.bin_labels(evaluation.bin_edges(test, config.label))
    if result.members:
        ours = result.evaluation
        tables["ensemble_comparison"] = evaluation.ensemble_vs_components(
            ours, ours.filter(F.col("Model").isin(result.members)), ours.filter(F.col("Model") == ENSEMBLE)
        )
    column = modeling.prediction_column(result.best)
    chosen = test.withColumn("prediction", F.col(f"`{column}`"))
    tables["residual_points"] = charts.residual_points(chosen, config.label, "prediction")
    tables["actual_vs_predicted"] = charts.bins_2d(chosen, config.label, "prediction")
    tables["residual_histogram"] = charts.residual_histogram(chosen, config.label, "prediction")
    tables["residual_vs_predicted"] = charts.bins_2d(
        evaluation.with_error(chosen, config.label, "prediction"), "prediction", "error"
    )
    tables["qq_points"] = charts.qq_points(chosen, config.label, "prediction", ROW_ID)
    tables["qq_thin"] = charts.qq_thin(chosen, config.label, "prediction")
    tables["residual_sample"] = charts.residual_points(selection.sample_rows(chosen, ROW_ID, config.sample), config.label, "prediction")
    tables["qq_line"] = charts.qq_line(tables["qq_points"])
    tables["daily_errors"] = timeseries.daily_errors(chosen, config.time, config.label, "prediction")
    tables["error_autocorrelation"] = timeseries.error_autocorrelation(tables["daily_errors"])
    tables["error_partial_autocorrelation"] = timeseries.error_partial_autocorrelation(tables["error_autocorrelation"])

    # The best single model is explained, also where the ensemble is ahead of it.
    single = result.best if result.best != ENSEMBLE else result.members[0]
    model, features = result.model(single), result.prepared.features
    slots = preparation.slot_names(features, {c: d.size for c, d in result.dictionaries.items()})
    importance = explanation.importance_table(spark, model, slots)
    # Text columns have an importance; lines, correlations and grids are of numbers.
    top = [f for f in explanation.top_features(importance, 10 + len(config.categorical)) if f in features][:10]
    if hasattr(model, "treeWeights"):
        tables["gain_importance"] = explanation.gain_importance(spark, model, slots)
    single_column = modeling.prediction_column(single)
    y = config.label if config.dependence_on == "label" else "prediction"
    explained = test.withColumn("prediction", F.col(f"`{single_column}`"))
    tables["importance"] = importance
    tables["dependence_points"] = explanation.dependence_points(explained, top[:5], y)
    tables["dependence_sample"] = explanation.dependence_points(selection.sample_rows(explained, ROW_ID, config.sample), top[:5], y)
    tables["dependence_lines"] = explanation.dependence_lines(explained, top[:5], y)
    tables["correlation"] = explanation.correlation_matrix(explained, top)
    tables["partial_dependence"] = explanation.partial_dependence(
        result.pipeline(single), test, top[:3], features, carried=[categories.code_name(c) for c in result.dictionaries]
    )
    return tables


def export(spark: SparkSession, result: RunResult, config: RunConfig, folder: str) -> None:
    """Predictions of the best model on test rows, model table, chart tables, models."""
    writing.write_evaluation(result.evaluation, f"{folder}/model_evaluation.csv")
    writing.write_tables(result.tables, f"{folder}/charts")
    writing.write_tables({c: d.table for c, d in result.dictionaries.items()}, f"{folder}/categories")
    writing.save_model(result.feature_model, f"{folder}/features")
    if result.best is None:
        return
    writing.write_predictions(
        result.predictions.filter(F.col("split") == "test"),
        f"{folder}/test_predictions.csv", config.time, config.label, modeling.prediction_column(result.best),
    )
    if result.best == ENSEMBLE:
        writing.save_ensemble(spark, {m: result.pipeline(m) for m in result.members}, f"{folder}/model")
    else:
        writing.save_model(result.pipeline(result.best), f"{folder}/model")
