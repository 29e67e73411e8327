"""The registered queries: every operator on the given tables, whole.

Results are rounded and integers widened to bigint so that they can be compared
with the SQL in ``oracles``; the operators themselves return unrounded values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.functions.calendar import calendar_columns, is_month_end
from headway.functions.parsing import epoch_seconds
from headway.operators import categories, charts, cleaning, evaluation, explanation, gram, modeling, ordering, preparation, selection, timeseries
from headway.plans import trip_arrival
from headway.schema import CALENDAR, ENSEMBLE
from headway.session import use_utc
from headway.sources import reading, writing

Query = Callable[[SparkSession, str], DataFrame]

# Line items have no single key; these columns are one together.
ITEM_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
ITEM_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _round(column, digits: int = 6) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, digits) + F.lit(0.0)


def _long(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return reading.read_table(use_utc(spark), sf, name)


# --- sources and cleaning ----------------------------------------------------

def _events_with_gaps(spark, sf):
    """Events with missing values: large values, views and the errors' properties."""
    return _table(spark, sf, "events").withColumns(
        {
            "value": F.when(F.col("value") <= 100, F.col("value")),
            "event_type": F.nullif(F.col("event_type"), F.lit("view")),
            "props": F.when(F.col("event_type") != "error", F.col("props")),
        }
    )


def source_report(spark, sf):
    return cleaning.source_report(_table(spark, sf, "orders"))


def null_profile(spark, sf):
    return cleaning.null_profile(_events_with_gaps(spark, sf))


def normalize_names(spark, sf):
    dotted = _table(spark, sf, "events").toDF("event.id", "ts", "user.id", "event.type", "value", "props")
    return cleaning.normalize_names(dotted).select("eventid", "userid", "eventtype", "value")


def cast_numeric(spark, sf):
    orders = _table(spark, sf, "orders").withColumn(
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "F", "n/a").otherwise(F.col("o_totalprice").cast("string")),
    )
    return cleaning.cast_numeric(orders, ["o_totalprice", "not_there"]).select("o_orderkey", "o_totalprice")


def parse_time(spark, sf):
    text = _table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "not a time").otherwise(F.date_format("ts", STAMP)).alias("ts"),
    )
    parsed = cleaning.parse_time(text, "ts")
    return parsed.select("event_id", F.date_format("ts", STAMP).alias("parsed"))


def drop_required_nulls(spark, sf):
    kept = cleaning.drop_incomplete(_events_with_gaps(spark, sf), ["event_type", "value"])
    return kept.select("event_id", "event_type", "value", "props")


# --- features ----------------------------------------------------------------

_WHOLE_CALENDAR = [c for c in CALENDAR if not c.endswith(("_sin", "_cos"))]


def calendar_features(spark, sf):
    events = _table(spark, sf, "events").withColumns(calendar_columns(F.col("ts")))
    return events.select("event_id", *_long(*_WHOLE_CALENDAR))


def calendar_features_years(spark, sf):
    orders = _table(spark, sf, "orders").withColumns(calendar_columns(F.col("o_orderdate")))
    return orders.select("o_orderkey", *_long(*_WHOLE_CALENDAR))


def month_end_modes(spark, sf):
    day = F.col("o_orderdate")
    return _table(spark, sf, "orders").select(
        "o_orderkey",
        is_month_end(day).cast("bigint").alias("last_day"),
        is_month_end(day, "late_days").cast("bigint").alias("late_days"),
    )


def cyclic_features(spark, sf):
    names = [c for c in CALENDAR if c.endswith(("_sin", "_cos"))]
    events = _table(spark, sf, "events").withColumns(calendar_columns(F.col("ts")))
    return events.select("event_id", *[_round(c).alias(c) for c in names])


def epoch_seconds_of_events(spark, sf):
    return _table(spark, sf, "events").select("event_id", epoch_seconds(F.col("ts")).alias("epoch_s"))


# --- order and split ---------------------------------------------------------

def _item_split(items: DataFrame) -> ordering.ChronoSplit:
    return ordering.fit_chrono_split(items, "l_shipdate", ITEM_KEY)


def _event_split(events: DataFrame) -> ordering.ChronoSplit:
    return ordering.fit_chrono_split(events, "ts", ["event_id"])


def global_row_number(spark, sf):
    items = _table(spark, sf, "lineitem").select("l_shipdate", *ITEM_KEY)
    numbered = ordering.global_row_number(items, ["l_shipdate", *ITEM_KEY])
    return numbered.select(*_long(*ITEM_KEY[:4]), "l_extendedprice", F.col("rn").cast("bigint").alias("rn"))


def chrono_split(spark, sf):
    events = _table(spark, sf, "events")
    return ordering.chrono_split(events, "ts", ["event_id"]).select("event_id", "split")


def chrono_split_tied(spark, sf):
    items = _table(spark, sf, "lineitem")
    marked = ordering.chrono_split(items, "l_shipdate", ITEM_KEY)
    return marked.select(*_long(*ITEM_KEY[:4]), "l_extendedprice", "split")


def split_counts(spark, sf):
    events = _table(spark, sf, "events")
    return ordering.split_counts(ordering.chrono_split(events, "ts", ["event_id"]))


def hash_split(spark, sf):
    return ordering.hash_split(_table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "split")


# --- preparation -------------------------------------------------------------

def mean_impute(spark, sf):
    """No discount and no tax count as unknown and take the mean of the training rows."""
    items = _table(spark, sf, "lineitem").withColumns(
        {c: F.nullif(F.col(c), F.lit(0.0)) for c in ("l_discount", "l_tax")}
    )
    means = preparation.fit_means(_item_split(items).rows(items, "train"), ["l_discount", "l_tax"])
    return preparation.mean_fill(items, means).select(
        *_long(*ITEM_KEY[:4]), "l_extendedprice", _round("l_discount").alias("l_discount"), _round("l_tax").alias("l_tax")
    )


def standard_scale(spark, sf):
    """Imputation, assembly and scaling as one ML pipeline, fitted on the training rows."""
    items = _table(spark, sf, "lineitem").withColumns(
        {"l_discount": F.nullif(F.col("l_discount"), F.lit(0.0)), "l_linenumber": F.col("l_linenumber").cast("double")}
    )
    fitted = preparation.fit_features(_item_split(items).rows(items, "train"), ITEM_FEATURES)
    values = vector_to_array("scaledFeatures")
    return fitted.transform(items).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice",
        *[_round(values[i]).alias(f"z_{name[2:]}") for i, name in enumerate(ITEM_FEATURES)],
    )


def inverse_scale(spark, sf):
    events = _table(spark, sf, "events").select("event_id", "value", F.col("value").alias("z"))
    scaling = preparation.fit_scaling(events, ["z"])
    scaled = preparation.standardize(events, scaling).withColumn("back", F.col("z"))
    restored = preparation.unstandardize(scaled, {"back": scaling["z"]})
    return restored.select("event_id", _round("z").alias("z"), _round("back").alias("back"))


def categorical_index(spark, sf):
    """Event types coded by how frequent they are, ties by name."""
    events = _table(spark, sf, "events").select("event_id", "event_type")
    coded = categories.encode(events, categories.fit_dictionaries(events, ["event_type"]))
    return coded.select("event_id", F.col("event_type_code").cast("bigint").alias("index"))


def categorical_onehot(spark, sf):
    """The whole feature vector: a scaled number, and the event types that the training rows without errors hold."""
    events = _table(spark, sf, "events")
    train = _event_split(events).rows(events, "train").filter(F.col("event_type") != "error")
    dictionaries = categories.fit_dictionaries(train, ["event_type"])
    fitted = preparation.fit_features(categories.encode(train, dictionaries), ["value"], ["event_type_code"])
    values = vector_to_array("scaledFeatures")
    return fitted.transform(categories.encode(events, dictionaries)).select(
        "event_id", _round(values[0]).alias("z"), F.size(values).cast("bigint").alias("slots"),
        *[values[i].alias(f"slot_{i}") for i in range(1, 5)],
    )


# --- linear models -----------------------------------------------------------

def _vectors(df: DataFrame, features) -> DataFrame:
    numeric = df.withColumns({c: F.col(c).cast("double") for c in features})
    return VectorAssembler(inputCols=list(features), outputCol="scaledFeatures").transform(numeric)


def _item_data(spark, sf, features=("l_quantity",)):
    items = _vectors(_table(spark, sf, "lineitem"), features)
    split = _item_split(items)
    data = modeling.TrainingData(split.rows(items, "train"), split.rows(items, "val"), "l_extendedprice")
    return items, split, data


def _linear(spark, sf, fit: modeling.Fit, features=("l_quantity",)) -> DataFrame:
    """Coefficients and errors per split of a linear model on line items."""
    items, split, data = _item_data(spark, sf, features)
    model = fit(data)
    scored = split.apply(model.transform(items))
    errors = evaluation.metrics(scored, "l_extendedprice", {"model": "prediction"})
    weights = {
        f"w_{name[2:]}": _round(F.lit(float(w)), 4) for name, w in zip(features, model.coefficients)
    }
    return errors.select(
        "split", "n", _round("rmse", 4).alias("rmse"), _round("r2").alias("r2"),
        *[w.alias(n) for n, w in weights.items()], _round(F.lit(float(model.intercept)), 4).alias("intercept"),
    )


def ridge_1d(spark, sf):
    return _linear(spark, sf, modeling.ridge())


def ridge_2d(spark, sf):
    return _linear(spark, sf, modeling.ridge(), ("l_quantity", "l_linenumber"))


def lasso_1d(spark, sf):
    return _linear(spark, sf, modeling.lasso())


def elastic_net_1d(spark, sf):
    return _linear(spark, sf, modeling.elastic_net())


def least_squares_2d(spark, sf):
    return _linear(spark, sf, modeling.least_squares(), ("l_quantity", "l_linenumber"))


GRID = ({"regParam": 0.3}, {"regParam": 3.0}, {"regParam": 30.0})


def grid_search(spark, sf):
    """Elastic net at three penalties from one pass over the rows, ranked by the error on the validation rows."""
    items = _table(spark, sf, "lineitem")
    parts = gram.moments(_item_split(items).apply(items), ["l_quantity"], "l_extendedprice", "split")
    found = gram.search(gram.elastic_net, GRID, parts["train"], parts["val"])
    rows = [(i + 1, r.params["regParam"], r.rmse) for i, r in enumerate(found)]
    table = spark.createDataFrame(rows, "place bigint, reg_param double, rmse double")
    return table.withColumn("rmse", _round("rmse", 4))


def _yearly(spark, sf) -> dict:
    """Moments of quantity and price for each year of shipping."""
    return gram.moments(_table(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice", F.year("l_shipdate"))


def rolling_folds(spark, sf):
    """Each year predicted from all years before it, at three penalties."""
    folds = gram.rolling(gram.elastic_net, GRID, _yearly(spark, sf))
    rows = [(f.params["regParam"], f.block, f.n_train, f.n, f.rmse) for f in folds]
    table = spark.createDataFrame(rows, "reg_param double, year bigint, n_train bigint, n bigint, rmse double")
    return table.withColumn("rmse", _round("rmse", 4))


def rolling_search(spark, sf):
    found = gram.rolling_search(gram.elastic_net, GRID, _yearly(spark, sf))
    rows = [(i + 1, setting["regParam"], rmse) for i, (setting, rmse) in enumerate(found)]
    table = spark.createDataFrame(rows, "place bigint, reg_param double, rmse double")
    return table.withColumn("rmse", _round("rmse", 4))


def linear_family_2d(spark, sf):
    """Least squares and ridge of two features from the same matrices, with their errors on every part."""
    features = ["l_quantity", "l_linenumber"]
    items = _table(spark, sf, "lineitem")
    parts = gram.moments(_item_split(items).apply(items), features, "l_extendedprice", "split")
    fits = {"LinearRegression": gram.least_squares(parts["train"]), "Ridge": gram.ridge(parts["train"])}
    rows = [
        (name, split, part.n, (fit.error(part) / part.n) ** 0.5, *map(float, fit.weights), fit.intercept)
        for name, fit in fits.items() for split, part in parts.items()
    ]
    table = spark.createDataFrame(rows, "model string, split string, n bigint, rmse double, w_quantity double, w_linenumber double, intercept double")
    return table.withColumns({c: _round(c, 4) for c in table.columns[3:]})


def _ols_events(spark, sf) -> DataFrame:
    """Events with split and the least-squares prediction of value from hour and day."""
    events = _table(spark, sf, "events")
    calendar = calendar_columns(F.col("ts"))
    events = events.withColumns({"Hour": calendar["Hour"], "DayOfMonth": calendar["DayOfMonth"]})
    rows = _vectors(events, ["Hour", "DayOfMonth"])
    split = _event_split(rows)
    data = modeling.TrainingData(split.rows(rows, "train"), split.rows(rows, "val"), "value")
    model = modeling.least_squares()(data)
    return split.apply(model.transform(rows))


def ols_predictions(spark, sf):
    scored = evaluation.with_error(_ols_events(spark, sf), "value", "prediction")
    return scored.select("event_id", "split", _round("prediction").alias("prediction"), _round("error").alias("error"))


def ols_metrics(spark, sf):
    errors = evaluation.metrics(_ols_events(spark, sf), "value", {"LinearRegression": "prediction"})
    return errors.select(
        "split", "model", "n", _round("rmse").alias("rmse"), _round("r2").alias("r2"), _round("r2_corr").alias("r2_corr")
    )


# --- evaluation --------------------------------------------------------------

PREDICTORS = {"Mean": "p_mean", "ByType": "p_type", "ByHour": "p_hour", "LinearRegression": "prediction"}


LOOKUP_ROWS = 10_000  # a table of means up to this size is sent to every executor; a larger one is joined by shuffle


def _lookup(means: DataFrame) -> DataFrame:
    """Means per key for a join: keys with many rows each must not be shuffled on."""
    rows = means.limit(LOOKUP_ROWS + 1).collect()
    if len(rows) > LOOKUP_ROWS:
        return means
    return F.broadcast(means.sparkSession.createDataFrame(rows, means.schema))


def _predicted(spark, sf) -> DataFrame:
    """Events with four predictions: overall mean, means by type and hour, least squares."""
    scored = _ols_events(spark, sf)
    train = scored.filter(F.col("split") == "train")
    overall = train.agg(F.avg("value")).first()[0]
    by_type = train.groupBy("event_type").agg(F.avg("value").alias("p_type"))
    by_hour = train.groupBy("Hour").agg(F.avg("value").alias("p_hour"))
    return (
        scored.join(_lookup(by_type), "event_type", "left")
        .join(_lookup(by_hour), "Hour", "left")
        .select(
            "event_id", "ts", "split", "value", "prediction",
            F.lit(overall).alias("p_mean"),
            F.coalesce("p_type", F.lit(overall)).alias("p_type"),
            F.coalesce("p_hour", F.lit(overall)).alias("p_hour"),
        )
    )


def _evaluated(spark, sf) -> DataFrame:
    return evaluation.evaluation_table(evaluation.metrics(_predicted(spark, sf), "value", PREDICTORS))


def _rounded_table(table: DataFrame) -> DataFrame:
    values = [c for c in table.columns if c not in ("Model", "model_order", "Training_Time")]
    return table.select("Model", *[_round(c).alias(c) for c in values])


def model_metrics(spark, sf):
    errors = evaluation.metrics(_predicted(spark, sf), "value", PREDICTORS)
    return errors.select("model", "split", "n", _round("rmse").alias("rmse"), _round("r2").alias("r2"), _round("r2_corr").alias("r2_corr"))


def evaluation_table(spark, sf):
    return _rounded_table(_evaluated(spark, sf))


def metric_long(spark, sf):
    long = evaluation.metric_long(_evaluated(spark, sf))
    return long.select("Model", "split", _round("rmse").alias("rmse"))


def model_ranking(spark, sf):
    return _rounded_table(evaluation.rank_models(_evaluated(spark, sf)))


def best_model(spark, sf):
    return _rounded_table(evaluation.best_model(_evaluated(spark, sf)))


def _with_ensemble(spark, sf) -> tuple[DataFrame, list[str]]:
    predicted = _predicted(spark, sf)
    table = evaluation.evaluation_table(evaluation.metrics(predicted, "value", PREDICTORS))
    members = [row["Model"] for row in evaluation.rank_models(table).select("Model").collect()]
    return evaluation.with_ensemble(predicted, [PREDICTORS[m] for m in members]), members


def ensemble_mean(spark, sf):
    rows, _ = _with_ensemble(spark, sf)
    return rows.select("event_id", "split", _round(f"pred_{ENSEMBLE}").alias("ensemble"))


def ensemble_vs_components(spark, sf):
    rows, members = _with_ensemble(spark, sf)
    all_models = {**{m: PREDICTORS[m] for m in members}, ENSEMBLE: f"pred_{ENSEMBLE}"}
    table = evaluation.evaluation_table(evaluation.metrics(rows, "value", all_models))
    parts, whole = F.col("Model") != ENSEMBLE, F.col("Model") == ENSEMBLE
    return _rounded_table(evaluation.ensemble_vs_components(table, table.filter(parts), table.filter(whole)))


def bin_edges(spark, sf):
    edges = evaluation.bin_edges(_predicted(spark, sf), "value")
    return edges.select("split", F.col("edge_no").cast("bigint").alias("edge_no"), _round("edge").alias("edge"))


def bin_labels(spark, sf):
    labels = evaluation.bin_labels(evaluation.bin_edges(_predicted(spark, sf), "value"))
    return labels.select("split", F.col("bin").cast("bigint").alias("bin"), "label")


def _counts(df: DataFrame) -> DataFrame:
    return df.select("model", "split", *_long("actual_bin", "predicted_bin", "n"))


def confusion_digitize(spark, sf):
    return _counts(evaluation.confusion(_predicted(spark, sf), "value", PREDICTORS))


def confusion_cut(spark, sf):
    return _counts(evaluation.confusion(_predicted(spark, sf), "value", PREDICTORS, kind="cut"))


# --- chart tables ------------------------------------------------------------

def residual_histogram(spark, sf):
    table = charts.residual_histogram(_predicted(spark, sf), "value", "p_type")
    return table.select(F.col("bin").cast("bigint").alias("bin"), _round("lo").alias("lo"), _round("hi").alias("hi"), "n")


def scatter_bins(spark, sf):
    return charts.bins_2d(_predicted(spark, sf), "value", "prediction", 20).select(*_long("x_bin", "y_bin", "n"))


def residual_bins(spark, sf):
    rows = evaluation.with_error(_predicted(spark, sf), "value", "prediction")
    return charts.bins_2d(rows, "prediction", "error", 20).select(*_long("x_bin", "y_bin", "n"))


def qq_points(spark, sf):
    points = charts.qq_points(_predicted(spark, sf), "value", "p_type", "event_id")
    return points.select("event_id", _round("residual").alias("residual"), F.col("rn").cast("bigint").alias("rn"), _round("x").alias("x"))


def qq_thin(spark, sf):
    """A thousand order statistics of the residuals, found without sorting them."""
    points = charts.qq_thin(_predicted(spark, sf), "value", "p_type")
    return points.select(_round("residual").alias("residual"), "rn", _round("x").alias("x"))


def scatter_sample(spark, sf):
    """A thousand rows by the hash of their key: actual, predicted and residual."""
    rows = selection.sample_rows(_predicted(spark, sf), "event_id", 1000)
    return charts.residual_points(rows, "value", "prediction").select(*[_round(c).alias(c) for c in ("actual", "predicted", "residual")])


def qq_line(spark, sf):
    points = charts.qq_points(_predicted(spark, sf), "value", "p_type", "event_id")
    return charts.qq_line(points).select(*[_round(c, 5).alias(c) for c in ("slope", "intercept", "r")])


# --- explanation -------------------------------------------------------------

def correlation_matrix(spark, sf):
    items = _table(spark, sf, "lineitem")
    matrix = explanation.correlation_matrix(items, [*ITEM_FEATURES, "l_extendedprice"])
    return matrix.select("f1", "f2", _round("corr").alias("corr"))


def dependence_lines(spark, sf):
    lines = explanation.dependence_lines(_table(spark, sf, "lineitem"), ITEM_FEATURES, "l_extendedprice")
    return lines.select("feature", _round("slope", 4).alias("slope"), _round("intercept", 4).alias("intercept"))


def dependence_points(spark, sf):
    items = _table(spark, sf, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("double"))
    return explanation.dependence_points(items, ITEM_FEATURES, "l_extendedprice")


def dependence_sample(spark, sf):
    orders = _table(spark, sf, "orders").withColumns({"month": F.month("o_orderdate"), "day": F.dayofmonth("o_orderdate")})
    rows = selection.sample_rows(orders, "o_orderkey", 1000)
    points = explanation.dependence_points(rows, ["month", "day"], "o_totalprice")
    return points.select("feature", F.col("value").cast("bigint").alias("value"), "y")


def partial_dependence(spark, sf):
    items = _table(spark, sf, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("double"))
    inputs = ["l_quantity", "l_linenumber"]
    split = _item_split(items)
    stages = preparation.feature_stages(inputs).getStages()
    least_squares = modeling.LinearRegression(featuresCol="scaledFeatures", labelCol="l_extendedprice", regParam=0.0)
    model = Pipeline(stages=[*stages, least_squares]).fit(split.rows(items, "train"))
    table = explanation.partial_dependence(model, split.rows(items, "test"), inputs, inputs)
    return table.select(
        "feature", F.col("step").cast("bigint").alias("step"), _round("point").alias("point"),
        _round("mean_prediction", 4).alias("mean_prediction"),
    )


# --- errors over time --------------------------------------------------------

def _orders_predicted(spark, sf) -> DataFrame:
    """Orders with the mean price of their priority, over all orders, as prediction."""
    orders = _table(spark, sf, "orders")
    means = orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("prediction"))
    return orders.join(_lookup(means), "o_orderpriority")


def _daily(spark, sf) -> DataFrame:
    return timeseries.daily_errors(_orders_predicted(spark, sf), "o_orderdate", "o_totalprice", "prediction")


def daily_errors(spark, sf):
    # Means of a few prices in cents end in exact halves; the first rounding settles those.
    return _daily(spark, sf).select(
        F.col("day").cast("string").alias("day"),
        *[_round(F.round(c, 8), 4).alias(c) for c in ("actual", "predicted", "error")],
    )


def error_autocorrelation(spark, sf):
    table = timeseries.error_autocorrelation(_daily(spark, sf))
    return table.select(F.col("lag").cast("bigint").alias("lag"), _round("r").alias("r"), _round("band").alias("band"))


def error_pacf(spark, sf):
    table = timeseries.error_partial_autocorrelation(timeseries.error_autocorrelation(_daily(spark, sf)))
    return table.select(F.col("lag").cast("bigint").alias("lag"), _round("r").alias("r"), _round("band").alias("band"))


# --- trees -------------------------------------------------------------------

def _event_training(spark, sf):
    """Events with scaled calendar features, and the training data cut from them."""
    events = _table(spark, sf, "events").withColumns(calendar_columns(F.col("ts")))
    split = _event_split(events)
    scaled = preparation.fit_features(split.rows(events, "train"), CALENDAR).transform(
        events.withColumns({c: F.col(c).cast("double") for c in CALENDAR})
    )
    narrow = scaled.select("event_id", "ts", "value", "scaledFeatures")
    data = modeling.TrainingData(split.rows(narrow, "train"), split.rows(narrow, "val"), "value")
    return narrow, split, data


def _trees(fit: modeling.Fit) -> Query:
    def query(spark, sf):
        rows, split, data = _event_training(spark, sf)
        scored = split.apply(fit(data).transform(rows))
        return evaluation.metrics(scored, "value", {"model": "prediction"}).select("split", "n", "rmse", "r2", "r2_corr")

    return query


def feature_importance(spark, sf):
    _, _, data = _event_training(spark, sf)
    model = modeling.forest(**modeling.FORESTS["RandomForest_50"])(data)
    return explanation.importance_table(spark, model, CALENDAR)


def gain_importance(spark, sf):
    _, _, data = _event_training(spark, sf)
    model = modeling.boosted()(data)
    return explanation.gain_importance(spark, model, CALENDAR)


# Stumps on columns with few values: every cut is tried, so plain SQL finds the same ones.
STUMP = {"maxDepth": 1, "maxBins": 64}
ROUNDS = 5


def _stumps(fit: modeling.Fit) -> Query:
    def query(spark, sf):
        items, split, data = _item_data(spark, sf, ITEM_FEATURES)
        scored = split.apply(fit(data).transform(items))
        errors = evaluation.metrics(scored, "l_extendedprice", {"model": "prediction"})
        return errors.select("split", "n", _round("rmse", 4).alias("rmse"), _round("r2").alias("r2"))

    return query


def boosted_loop(data: modeling.TrainingData):
    """The loop that goes on from round to round, with all rows and columns in each."""
    return modeling.boost(data, ROUNDS, None, row_share=1.0, column_share=1.0, **STUMP)[0]


def feature_importance_stumps(spark, sf):
    _, _, data = _item_data(spark, sf, ITEM_FEATURES)
    model = modeling.boosted(maxIter=ROUNDS, **STUMP)(data)
    return explanation.importance_table(spark, model, ITEM_FEATURES).select("feature", _round("importance").alias("importance"))


def gain_importance_stumps(spark, sf):
    """Gains in millions, for there are prices in them."""
    _, _, data = _item_data(spark, sf, ITEM_FEATURES)
    table = explanation.gain_importance(spark, boosted_loop(data), ITEM_FEATURES)
    return table.select(
        "feature", "n_splits", _round(F.col("mean_gain") / 1e6, 4).alias("mean_gain"), _round("gain_share").alias("gain_share")
    )


def model_timing(spark, sf):
    """The linear models trained in the loop, with a failing one among them."""
    _, _, data = _event_training(spark, sf)
    specs = [
        modeling.ModelSpec("LinearRegression", modeling.least_squares()),
        modeling.ModelSpec("Ridge", modeling.ridge()),
        modeling.ModelSpec("Lasso", modeling.lasso()),
        modeling.ModelSpec("Invalid", modeling.elastic_net(regParam=-1.0)),
    ]
    return modeling.timing_table(spark, modeling.train_all(specs, data)).select("model", "model_order", "status", "seconds")


# --- sinks and the whole run -------------------------------------------------

def sink_roundtrip(spark, sf):
    """Predictions written as CSV and read back with the trip reader."""
    path = writing.scratch_folder(spark, "predictions-csv")
    writing.write_predictions(_predicted(spark, sf), path, "event_id", "value", "p_type")
    back = reading.read_trips_csv(spark, path)
    typed = cleaning.cast_numeric(back, ["value", "prediction"])
    return typed.select(
        F.col("event_id").cast("bigint").alias("event_id"), "value", _round("prediction").alias("prediction")
    )


def malformed_report(spark, sf):
    """Orders written as lines, some with a field too few or too many: the rows, and the lines handed back."""
    path = writing.scratch_folder(spark, "lines")
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string")
    line = F.when(F.col("o_orderstatus") == "F", F.concat_ws(",", key, "o_orderstatus")).when(
        F.col("o_orderpriority") == "1-URGENT", F.concat_ws(",", key, "o_orderstatus", price, F.lit("more"))
    ).otherwise(F.concat_ws(",", key, "o_orderstatus", price))
    _table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    parsed = reading.parse_trips_csv(spark, path, ["key", "status", "price"], header=False)
    rows = parsed.rows.select(F.lit("row").alias("kind"), F.lit(3).alias("fields"), F.col("key").cast("bigint").alias("key"))
    rejects = parsed.rejects.select(
        F.lit("reject").alias("kind"), F.size(F.split("line", ",")).alias("fields"), F.substring_index("line", ",", 1).cast("bigint").alias("key")
    )
    return rows.unionByName(rejects).groupBy("kind", F.col("fields").cast("bigint").alias("fields")).agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("first"), F.max("key").alias("last")
    ).withColumn("counted", F.when(F.col("kind") == "row", F.lit(parsed.n_rows)).otherwise(F.lit(parsed.n_rejects)).cast("bigint"))


def evaluation_sink(spark, sf):
    path = writing.scratch_folder(spark, "evaluation-csv")
    writing.write_evaluation(_evaluated(spark, sf), path)
    back = cleaning.cast_numeric(reading.read_trips_csv(spark, path), ["Train_RMSE", "Test_RMSE", "Val_RMSE", "Test_R2"])
    return _rounded_table(back.drop("Training_Time"))


def model_roundtrip(spark, sf):
    """Feature stages and model saved, loaded and used: the errors of the loaded one."""
    items = _table(spark, sf, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("double"))
    split = _item_split(items)
    stages = preparation.feature_stages(["l_quantity", "l_linenumber"]).getStages()
    least_squares = modeling.LinearRegression(featuresCol="scaledFeatures", labelCol="l_extendedprice", regParam=0.0)
    fitted = Pipeline(stages=[*stages, least_squares]).fit(split.rows(items, "train"))
    path = writing.scratch_folder(spark, "model")
    writing.save_model(fitted, path)
    scored = split.apply(writing.load_model(path).transform(items))
    errors = evaluation.metrics(scored, "l_extendedprice", {"loaded": "prediction"})
    return errors.select("split", "n", _round("rmse", 4).alias("rmse"), _round("r2").alias("r2"))


def _run(spark, sf, specs, features=CALENDAR) -> DataFrame:
    """The whole run on events: one row per model, ensemble included; its staged tables are removed.

    Status and error of a model are not among the rows, so none may be missing: no model is
    given up for its time, and one that fails ends the query.
    """
    config = trip_arrival.RunConfig(
        time="ts", key=("event_id",), label="value", numeric=("value",), required=("event_type", "value"), features=features, specs=specs,
        time_limit=None, whole=True,
    )
    result = trip_arrival.run(spark, _table(spark, sf, "events"), config)
    writing.discard(spark, result.folder)
    return result.evaluation


def trip_evaluation(spark, sf):
    """The linear models."""
    return _run(spark, sf, (
        modeling.ModelSpec("LinearRegression", modeling.least_squares()),
        modeling.ModelSpec("Ridge", modeling.ridge()),
        modeling.ModelSpec("Lasso", modeling.lasso()),
        modeling.ModelSpec("ElasticNet", modeling.elastic_net()),
    ))


def trip_run_linear(spark, sf):
    """Models with a closed form on two features: what the whole run makes of them can be held against SQL."""
    specs = [modeling.ModelSpec("LinearRegression", modeling.least_squares())]
    specs += [modeling.ModelSpec(f"Ridge_{alpha}", modeling.ridge(float(alpha))) for alpha in (100, 10_000)]
    return _rounded_table(_run(spark, sf, specs, ("Hour", "DayOfMonth")))


def trip_run_default(spark, sf):
    """The job with its default models: elastic net, four forests, boosted trees, their ensemble; all of them or an error."""
    return _run(spark, sf, modeling.default_specs())


QUERIES: dict[str, Query] = {
    "source_report": source_report,
    "null_profile": null_profile,
    "normalize_names": normalize_names,
    "cast_numeric": cast_numeric,
    "parse_time": parse_time,
    "drop_required_nulls": drop_required_nulls,
    "calendar_features": calendar_features,
    "calendar_features_years": calendar_features_years,
    "month_end_modes": month_end_modes,
    "cyclic_features": cyclic_features,
    "epoch_seconds": epoch_seconds_of_events,
    "global_row_number": global_row_number,
    "chrono_split": chrono_split,
    "chrono_split_tied": chrono_split_tied,
    "split_counts": split_counts,
    "hash_split": hash_split,
    "mean_impute": mean_impute,
    "standard_scale": standard_scale,
    "inverse_scale": inverse_scale,
    "categorical_index": categorical_index,
    "categorical_onehot": categorical_onehot,
    "ols_metrics": ols_metrics,
    "ols_predictions": ols_predictions,
    "least_squares_2d": least_squares_2d,
    "ridge_1d": ridge_1d,
    "ridge_2d": ridge_2d,
    "lasso_1d": lasso_1d,
    "elastic_net_1d": elastic_net_1d,
    "grid_search": grid_search,
    "rolling_folds": rolling_folds,
    "rolling_search": rolling_search,
    "linear_family_2d": linear_family_2d,
    "model_metrics": model_metrics,
    "evaluation_table": evaluation_table,
    "metric_long": metric_long,
    "model_ranking": model_ranking,
    "best_model": best_model,
    "ensemble_mean": ensemble_mean,
    "ensemble_vs_components": ensemble_vs_components,
    "bin_edges": bin_edges,
    "bin_labels": bin_labels,
    "confusion_digitize": confusion_digitize,
    "confusion_cut": confusion_cut,
    "residual_histogram": residual_histogram,
    "scatter_bins": scatter_bins,
    "residual_bins": residual_bins,
    "qq_points": qq_points,
    "qq_line": qq_line,
    "qq_thin": qq_thin,
    "scatter_sample": scatter_sample,
    "dependence_sample": dependence_sample,
    "correlation_matrix": correlation_matrix,
    "dependence_lines": dependence_lines,
    "dependence_points": dependence_points,
    "partial_dependence": partial_dependence,
    "daily_errors": daily_errors,
    "error_autocorrelation": error_autocorrelation,
    "error_pacf": error_pacf,
    "rf_50": _trees(modeling.forest(**modeling.FORESTS["RandomForest_50"])),
    "rf_100": _trees(modeling.forest(**modeling.FORESTS["RandomForest_100"])),
    "rf_200": _trees(modeling.forest(**modeling.FORESTS["RandomForest_200"])),
    "rf_time": _trees(modeling.forest(**modeling.FORESTS["TimeSeries_RF"])),
    "gbt": _trees(modeling.boosted()),
    "gbt_early_stop": _trees(modeling.early_stopped()),
    "feature_importance": feature_importance,
    "gain_importance": gain_importance,
    "tree_stump": _stumps(modeling.forest(numTrees=1, featureSubsetStrategy="all", bootstrap=False, **STUMP)),
    "boosted_stumps": _stumps(modeling.boosted(maxIter=ROUNDS, **STUMP)),
    "boosted_loop_stumps": _stumps(boosted_loop),
    "feature_importance_stumps": feature_importance_stumps,
    "gain_importance_stumps": gain_importance_stumps,
    "model_timing": model_timing,
    "sink_roundtrip": sink_roundtrip,
    "malformed_report": malformed_report,
    "evaluation_sink": evaluation_sink,
    "model_roundtrip": model_roundtrip,
    "trip_evaluation": trip_evaluation,
    "trip_run_linear": trip_run_linear,
    "trip_run_default": trip_run_default,
}
