"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from headway.operators import modeling
from headway.plans import catalog
from headway.schema import ENSEMBLE
from headway.session import shared_dir
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"
LONG_FITS = {"rf_50", "rf_100", "rf_200", "rf_time", "gbt", "gbt_early_stop", "feature_importance", "trip_run_default"}
# The same queries with few and small trees.
REDUCED = {
    "rf_50": lambda: catalog._trees(modeling.forest(numTrees=3, maxDepth=3)),
    "rf_100": lambda: catalog._trees(modeling.forest(**modeling.FORESTS["RandomForest_100"] | SMALL)),
    "rf_200": lambda: catalog._trees(modeling.forest(**modeling.FORESTS["RandomForest_200"] | SMALL)),
    "rf_time": lambda: catalog._trees(modeling.forest(**modeling.FORESTS["TimeSeries_RF"] | SMALL)),
    "gbt": lambda: catalog._trees(modeling.boosted(maxIter=3, maxDepth=3)),
    "gbt_early_stop": lambda: catalog._trees(modeling.early_stopped(max_rounds=4, patience=2, maxDepth=3)),
}
SMALL = {"numTrees": 3, "maxDepth": 3}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    assert entry(spark).count() == 3


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert differences(queries()[name](spark, SF), con, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - LONG_FITS))
def test_query_without_sql_has_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(REDUCED))
def test_long_fit_reduced(spark, name):
    rows = {r["split"]: r for r in REDUCED[name]()(spark, SF).collect()}
    assert {s: r["n"] for s, r in rows.items()} == {"train": 700, "test": 200, "val": 100}
    assert all(r["rmse"] > 0 for r in rows.values()) and rows["train"]["r2"] >= 0


def test_default_run_reduced(spark, monkeypatch):
    """All of its models, with few and small trees, and importances of a forest."""
    monkeypatch.setattr(modeling, "FORESTS", {name: params | SMALL for name, params in modeling.FORESTS.items()})
    monkeypatch.setattr(modeling, "BOOSTED", modeling.BOOSTED | {"maxIter": 3, "maxDepth": 3})
    table = {r["Model"]: r for r in catalog.trip_run_default(spark, SF).collect()}
    assert list(table) == [s.name for s in modeling.default_specs()] + [ENSEMBLE]
    members = sorted(r["Training_Time"] for n, r in table.items() if n != ENSEMBLE)
    assert table[ENSEMBLE]["Training_Time"] >= sum(members[:3])
    assert sum(r["importance"] for r in catalog.feature_importance(spark, SF).collect()) == pytest.approx(1.0)


def _events(spark, folder, value) -> str:
    """Forty events, two hours apart."""
    rows = spark.range(40).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 7_200).alias("ts"),
        F.lit("view").alias("event_type"), value.cast("double").alias("value"),
    )
    rows.write.parquet(f"{folder}/events.parquet")
    return str(folder)


def _staged(spark) -> set:
    return set(Path(shared_dir(spark).removeprefix("file:"), "headway").glob("run-*/*"))


def test_default_run_without_its_models_is_an_error(spark, tmp_path):
    """An infinite label is refused by all models: that was a result of no rows. Staged tables are removed."""
    sf, before = _events(spark, tmp_path, F.when(F.col("id") == 7, float("inf")).otherwise(F.col("id"))), _staged(spark)
    with pytest.raises(modeling.TrainingFailed, match="LinearRegression: failed"):
        catalog.trip_run_default(spark, sf)
    assert _staged(spark) <= before


@pytest.mark.parametrize("broken", [0, 3])
def test_default_run_without_one_of_its_models_is_an_error(spark, tmp_path, monkeypatch, broken):
    """It had rows for the others and an ensemble of them."""
    specs = [modeling.ModelSpec(f"Model_{i}", modeling.elastic_net(regParam=-1.0 if i == broken else 0.1)) for i in range(4)]
    monkeypatch.setattr(modeling, "default_specs", lambda: specs)
    sf = _events(spark, tmp_path, F.col("id") % 5)
    with pytest.raises(modeling.TrainingFailed, match=f"Model_{broken}: failed"):
        catalog.trip_run_default(spark, sf)


def test_default_run_gives_no_model_up(spark, tmp_path, monkeypatch):
    limits, limited = [], modeling.time_limit
    monkeypatch.setattr(modeling, "time_limit", lambda session, seconds: limits.append(seconds) or limited(session, seconds))
    monkeypatch.setattr(modeling, "default_specs", lambda: [modeling.ModelSpec("LinearRegression", modeling.elastic_net())])
    catalog.trip_run_default(spark, _events(spark, tmp_path, F.col("id") % 5))
    assert limits == [None]
