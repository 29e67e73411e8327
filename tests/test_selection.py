import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.operators import charts, selection


def _values(spark, values):
    return spark.createDataFrame([(v if v is None else float(v),) for v in values], "v double").repartition(3)


@pytest.mark.parametrize("values", [
    np.random.default_rng(1).normal(size=3000).tolist(),
    np.random.default_rng(2).integers(0, 5, 2000).tolist(),  # few values, many ties
    [1.0, np.nextafter(1.0, 2), 1.0, -1e300, 1.7e308, -1.7e308, 5e-324, 0.0, 1e-320] * 20,  # neighbours, and widths beyond a double
    [7.0] * 50, [3.0], [-1.0, 1.0],
    np.exp(np.random.default_rng(3).normal(size=1500) * 30).tolist(),  # nearly all in the first range
])
def test_order_statistics(spark, monkeypatch, values):
    monkeypatch.setattr(selection, "RANGES", 16)
    monkeypatch.setattr(selection, "PIECES", 4)
    n = len(values)
    ranks = sorted({1, n, (n + 1) // 2, max(1, n // 3), *range(1, n + 1, max(1, n // 40))})
    found = selection.order_statistics(_values(spark, [*values, None, float("nan")]), "v", ranks)
    assert found == [sorted(values)[r - 1] for r in ranks]


def test_ranks_out_of_reach_and_no_ranks(spark):
    with pytest.raises(ValueError):
        selection.order_statistics(_values(spark, [1.0]), "v", [2])
    assert selection.order_statistics(_values(spark, [1.0]), "v", []) == []
    assert selection.order_statistics(_values(spark, [None]), "v", []) == []


def test_spread_ranks():
    assert selection.spread_ranks(5, 10) == [1, 2, 3, 4, 5]
    assert selection.spread_ranks(1000, 4) == [1, 334, 667, 1000]
    assert len(set(selection.spread_ranks(10**12, 1000))) == 1000


def test_what_is_shuffled_are_ranges(spark):
    rows = spark.range(100_000).select((F.col("id") % 1000).cast("double").alias("v"))
    cut = rows.groupBy(F.floor("v")).count()._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in cut
    assert selection.order_statistics(rows, "v", [1, 50_000, 50_001, 100_000]) == [0.0, 499.0, 500.0, 999.0]


def test_thin_quantiles_are_those_of_all_points(spark):
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(500, 2)))], "id int, y double, p double")
    every = {r["rn"]: (r["residual"], r["x"]) for r in charts.qq_points(rows, "y", "p", "id").collect()}
    thin = charts.qq_thin(rows, "y", "p", 60).collect()
    assert len(thin) == 60 and all(every[r["rn"]] == (r["residual"], pytest.approx(r["x"])) for r in thin)
    assert charts.qq_thin(rows.filter("id < 0"), "y", "p").collect() == []


@pytest.mark.parametrize("size", [0, 1, 70, 999, 1000, 5000])
def test_sample_has_its_size_on_any_layout(spark, size):
    rows = spark.range(1000).withColumn("v", F.col("id") * 2)
    found = [sorted(r["id"] for r in selection.sample_rows(rows.repartition(n), "id", size).collect()) for n in (1, 7)]
    assert found[0] == found[1] and len(found[0]) == min(size, 1000)
    if size == 70:
        parts = [selection.sample_rows(rows.filter(f"id % 2 = {k}"), "id", 70) for k in (0, 1)]
        assert sorted(r["id"] for r in selection.sample_rows(parts[0].unionByName(parts[1]), "id", 70).collect()) == found[0]
