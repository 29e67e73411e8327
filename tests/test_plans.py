"""The plans that have to hold at scale."""

import pytest
from pyspark.sql import functions as F

from headway.functions.calendar import calendar_columns
from headway.operators import charts, cleaning, evaluation, explanation, ordering, timeseries
from headway.plans import catalog
from headway.sources.reading import read_table

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    return read_table(spark, SF, "events")


def test_split_is_a_filter_on_the_scan(events):
    split = ordering.fit_chrono_split(events, "ts", ["event_id"])
    for part in ("train", "test", "val"):
        plan = _plan(split.rows(events, part).select("value"))
        assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan
        assert "PushedFilters: [IsNotNull(ts), " in plan
        assert "props" not in plan and "event_type" not in plan


def test_features_are_one_projection_of_the_columns_needed(events):
    plan = _plan(events.withColumns(calendar_columns(F.col("ts"))).select("Hour", "IsMonthEnd"))
    assert "Exchange" not in plan and "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_metrics_of_all_models_are_one_aggregation(events):
    df = events.select(F.lit("train").alias("split"), "value", *[(F.col("value") + i).alias(f"p{i}") for i in range(8)])
    plan = _plan(evaluation.metrics(df, "value", {f"m{i}": f"p{i}" for i in range(8)}))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "Join" not in plan and "partial_avg" in plan


def test_row_number_sorts_within_ranges(spark, events):
    plan = _plan(ordering.global_row_number(events.select("ts", "event_id"), ["ts", "event_id"]))
    rows_side = plan.split("BroadcastExchange")[0]
    assert "Window" not in rows_side and "SinglePartition" not in rows_side


def test_rows_are_read_once(events):
    scored = events.withColumn("p", F.lit(1.0))
    daily = timeseries.daily_errors(scored, "ts", "value", "p")
    assert _plan(daily).count("FileScan") == 1
    assert _plan(timeseries.error_autocorrelation(daily)).count("FileScan") == 1
    assert _plan(explanation.correlation_matrix(events, ["value", "user_id", "event_id"])).count("FileScan") == 1
    assert _plan(charts.bins_2d(scored, "value", "user_id")).count("FileScan") == 1


def _jobs(spark, make) -> int:
    context = spark.sparkContext
    group = f"jobs-{make.__name__}-{id(make)}"
    context.setJobGroup(group, "count jobs")
    try:
        make().collect()
        return len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_grow_with_columns_or_models(spark, events):
    def profile(n):
        wide = events.withColumns({f"c{i}": F.col("value") + i for i in range(n)})

        def make():
            return cleaning.null_profile(wide)

        return make

    def errors(n):
        wide = events.withColumns({f"p{i}": F.col("value") + i for i in range(n)})

        def make():
            return evaluation.metrics(wide, "value", {f"m{i}": f"p{i}" for i in range(n)}, "event_type")

        return make

    assert _jobs(spark, profile(1)) == _jobs(spark, profile(20))
    assert _jobs(spark, errors(1)) == _jobs(spark, errors(8))


@pytest.mark.parametrize("name", ["ols_metrics", "confusion_digitize", "partial_dependence", "standard_scale"])
def test_no_python_on_the_rows_and_no_cross_join(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF))
    for bad in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert bad not in plan


def test_confusion_expands_models_before_a_partial_count(spark):
    plan = _plan(catalog.confusion_digitize(spark, SF))
    assert "partial_count(1)" in plan
