import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from headway.operators import cleaning, modeling
from headway.operators.modeling import ModelSpec
from headway.plans import trip_arrival
from headway.plans.trip_arrival import RunConfig
from headway.schema import FEATURES, LABEL, TIME
from headway.session import shared_dir
from headway.sources import reading, writing
from tests.trips import clean_trips, dirty_trips

SPECS = (
    ModelSpec("LinearRegression", modeling.least_squares()),
    ModelSpec("Ridge", modeling.ridge()),
    ModelSpec("Forest", modeling.forest(numTrees=5, maxDepth=6)),
    ModelSpec("Broken", modeling.elastic_net(regParam=-1.0)),
)


@pytest.fixture(scope="module")
def config():
    return RunConfig(specs=SPECS)


@pytest.fixture(scope="module")
def csv_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trips") / "csv")
    dirty_trips(spark, 4000).write.option("header", True).csv(path)
    return path


@pytest.fixture(scope="module")
def result(spark, csv_path, config):
    return trip_arrival.run(spark, reading.read_trips_csv(spark, csv_path), config)


def test_counts_of_a_dirty_source(spark, csv_path, config, result):
    raw = reading.read_trips_csv(spark, csv_path)
    prepared = result.prepared
    assert prepared.n_source == raw.count() == 4000
    assert 0 < prepared.n_without_time < prepared.n_clean < 4000
    assert prepared.rows.count() == prepared.n_clean - prepared.n_without_time
    named = cleaning.normalize_names(raw)
    assert sorted(prepared.nulls.collect()) == sorted(cleaning.null_profile(named).collect())
    assert sorted(prepared.source.collect()) == sorted(cleaning.source_report(named).collect())
    nulls = {r["column"]: r["n_null"] for r in prepared.nulls.collect()}
    assert nulls["OriginName"] > 0 and nulls["NextStopPointName"] == 0
    assert nulls["OriginLat"] == 0  # unreadable, not missing


def test_split_and_features(result):
    n = result.prepared.rows.count()
    counts = {r["split"]: r["count"] for r in result.prepared.rows.groupBy("split").count().collect()}
    assert counts == {"train": int(0.7 * n), "test": int(0.2 * n), "val": n - int(0.7 * n) - int(0.2 * n)}
    assert result.prepared.features == list(FEATURES)
    ends = {r["split"]: (r["lo"], r["hi"]) for r in result.prepared.rows.groupBy("split").agg(
        F.min(TIME).alias("lo"), F.max(TIME).alias("hi")).collect()}
    assert ends["train"][1] <= ends["test"][0] and ends["test"][1] <= ends["val"][0]


def test_models_learn_the_trips(result):
    table = {r["Model"]: r for r in result.evaluation.collect()}
    assert set(table) == {"LinearRegression", "Ridge", "Forest", "Ensemble_Top3"}
    assert table["LinearRegression"]["Test_R2"] > 0.9
    assert [r.status for r in result.runs] == ["ok", "ok", "ok", "failed"]
    assert table["Ensemble_Top3"]["Training_Time"] == pytest.approx(
        sum(table[m]["Training_Time"] for m in result.members)
    )
    assert result.best in table
    assert table[result.best]["Test_RMSE"] == min(r["Test_RMSE"] for r in table.values())


def test_every_chart_table_has_rows(result):
    expected = {
        "rmse_by_split", "r2_by_split", "training_time", "confusion", "bin_labels", "ensemble_comparison",
        "residual_points", "actual_vs_predicted", "residual_histogram", "residual_vs_predicted", "qq_points",
        "qq_line", "qq_thin", "residual_sample", "daily_errors", "error_autocorrelation", "error_partial_autocorrelation",
        "importance", "dependence_points", "dependence_sample", "dependence_lines", "correlation", "partial_dependence",
    }
    assert set(result.tables) == expected
    n_test = result.predictions.filter("split = 'test'").count()
    assert result.tables["qq_points"].count() == n_test
    assert result.tables["residual_histogram"].agg(F.sum("n")).first()[0] == n_test
    assert result.tables["partial_dependence"].count() == 60
    assert result.tables["correlation"].count() == 100


def test_export_and_reload(spark, result, config, tmp_path):
    out = str(tmp_path / "out")
    trip_arrival.export(spark, result, config, out)
    predictions = reading.read_trips_csv(spark, f"{out}/test_predictions.csv")
    assert predictions.columns == [TIME, LABEL, "prediction"]
    assert predictions.count() == result.predictions.filter("split = 'test'").count()
    evaluation = reading.read_trips_csv(spark, f"{out}/model_evaluation.csv")
    assert evaluation.columns == ["Model", "Train_RMSE", "Test_RMSE", "Val_RMSE", "Test_R2", "Training_Time"]
    assert evaluation.count() == 4
    assert spark.read.parquet(f"{out}/charts/confusion").count() > 0
    assert writing.load_model(f"{out}/features").stages


def test_loaded_pipeline_predicts_the_same(spark, result, tmp_path):
    path = str(tmp_path / "model")
    writing.save_model(result.pipeline("Forest"), path)
    rows = result.prepared.rows.filter("split = 'val'")
    again = writing.load_model(path).transform(rows).select("row_id", "prediction")
    both = again.join(result.predictions.select("row_id", "pred_Forest"), "row_id")
    assert both.count() == rows.count()
    assert both.filter(F.col("prediction") != F.col("pred_Forest")).count() == 0


def test_ensemble_is_saved_as_its_members(spark, result, tmp_path):
    path = str(tmp_path / "ensemble")
    members = {m: result.pipeline(m) for m in result.members}
    writing.save_ensemble(spark, members, path)
    assert list(writing.load_ensemble(spark, path)) == result.members


def test_other_choices(spark):
    config = RunConfig(
        specs=SPECS[:1], random_split=True, fit_on="all", select_on="val", dependence_on="label",
        month_end="late_days", categorical=("PublishedLineName",),
    )
    result = trip_arrival.run(spark, clean_trips(spark, 1000), config)
    assert result.members == [] and result.best == "LinearRegression"
    named = {r["feature"] for r in result.tables["importance"].collect()}
    assert "PublishedLineName" in named
    assert {"dependence_points", "dependence_lines", "correlation", "partial_dependence"} <= set(result.tables)
    assert result.tables["partial_dependence"].count() > 0
    assert result.prepared.rows.count() == 1000


@pytest.mark.parametrize("random_split", [False, True])
def test_parts_do_not_depend_on_the_files(spark, tmp_path, random_split):
    """The same trips, with many equal times, in one part and in seven: the same rows in each split."""
    trips = clean_trips(spark, 400).withColumn("RecordedAtTime", F.date_format("RecordedAtTime", "yyyy-MM-dd 00:00:00"))
    found = []
    for parts in (1, 7):
        folder = writing.scratch_folder(spark, "test")
        prepared = trip_arrival.prepare(spark, trips.repartition(parts), RunConfig(random_split=random_split), folder)
        found.append(sorted((r["row_mark"], r["split"]) for r in prepared.rows.select("row_mark", "split").collect()))
        writing.discard(spark, folder)
    assert found[0] == found[1]


def test_no_model_still_gives_a_table(spark):
    result = trip_arrival.run(spark, clean_trips(spark, 200), RunConfig(specs=SPECS[3:]))
    assert result.best is None and result.evaluation.count() == 0
    assert result.tables["training_time"].first()["status"] == "failed"


def test_shared_dir_is_the_one_named(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named
    assert spark.sparkContext.getCheckpointDir() is not None


def test_stage_keeps_rows_and_partitions(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "v int, part string")
    staged = writing.stage(df, "test", ["part"])
    assert sorted(tuple(r) for r in staged.select("v", "part").collect()) == [(1, "a"), (2, "b"), (3, "a")]
    plan = staged.filter("part = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_staged_tables_can_be_discarded(spark):
    folder = writing.scratch_folder(spark, "test")
    writing.stage(spark.range(3), "numbers", folder=folder)
    assert spark.read.parquet(f"{folder}/numbers").count() == 3
    writing.discard(spark, folder)
    with pytest.raises(AnalysisException):
        spark.read.parquet(f"{folder}/numbers")
    with pytest.raises(ValueError):
        writing.discard(spark, "/somewhere/else")


def test_malformed_lines_are_handed_back(spark, tmp_path):
    """The same rows as when they are skipped; quoted separators and empty fields are no mistake."""
    lines = ["a,b,c", "1,2,3", "4,5", '"x,y",,z', "6,7,8,9", "", "only", ",,"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    parsed = reading.parse_trips_csv(spark, str(tmp_path / "in.csv"), ["a", "b", "c"])
    assert sorted(r["line"] for r in parsed.rejects.collect()) == ["4,5", "6,7,8,9", "only"]
    rows = sorted(map(repr, map(tuple, parsed.rows.collect())))
    assert rows == sorted(map(repr, map(tuple, reading.read_trips_csv(spark, str(tmp_path / "in.csv"), ["a", "b", "c"]).collect())))
    assert (parsed.n_rows, parsed.n_rejects) == (3, 3)


def test_parsing_a_file_without_lines(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n")
    parsed = reading.parse_trips_csv(spark, str(tmp_path / "in.csv"), ["a", "b"])
    assert parsed.rows.collect() == parsed.rejects.collect() == [] and (parsed.n_rows, parsed.n_rejects) == (0, 0)


def test_table_times_without_zone_become_timestamps(spark, tmp_path):
    spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05' AS t").write.parquet(str(tmp_path / "times.parquet"))
    df = reading.read_table(spark, str(tmp_path), "times")
    assert json.loads(df.schema.json())["fields"][0]["type"] == "timestamp"
    assert df.select(F.hour("t")).first()[0] == 3
