import datetime as dt
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from headway.operators import charts, timeseries


@pytest.fixture(scope="module")
def scored(spark):
    """Predictions over 80 days, with three days missing."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(900):
        day = i % 80
        if day in (4, 40, 41):
            continue
        t = dt.datetime(2024, 2, 1) + dt.timedelta(days=day, minutes=i)
        y = float(rng.normal(5, 2))
        rows.append((i, t, y, y + float(rng.normal(0, 1)) + np.sin(day / 5)))
    return spark.createDataFrame([(i, t, y, float(p)) for i, t, y, p in rows], "id int, t timestamp, y double, p double")


def test_daily_errors_match_pandas(scored):
    pdf = scored.toPandas()
    pdf["error"] = pdf["p"] - pdf["y"]
    want = pdf.set_index("t").resample("D")[["y", "p", "error"]].mean()
    got = timeseries.daily_errors(scored, "t", "y", "p").orderBy("day").toPandas()
    assert list(pd.to_datetime(got["day"])) == list(want.index)
    for column, name in (("actual", "y"), ("predicted", "p"), ("error", "error")):
        np.testing.assert_allclose(got[column].astype(float), want[name])
    assert got["error"].isna().sum() == 3


def test_autocorrelation_matches_its_definition(scored):
    daily = timeseries.daily_errors(scored, "t", "y", "p")
    x = daily.orderBy("day").toPandas()["error"].dropna().to_numpy()
    x = x - x.mean()
    n, r = len(x), [float((x[: len(x) - k] * x[k:]).sum() / (x * x).sum()) for k in range(31)]
    got = timeseries.error_autocorrelation(daily).orderBy("lag").collect()
    assert [g["lag"] for g in got] == list(range(31))
    assert [g["r"] for g in got] == pytest.approx(r)
    z = NormalDist().inv_cdf(0.975)
    band = [0.0] + [z * np.sqrt((1 + 2 * sum(v * v for v in r[1:k])) / n) for k in range(1, 31)]
    assert [g["band"] for g in got] == pytest.approx(band)


def test_autocorrelation_of_short_and_flat_series(spark):
    rows = [(dt.date(2024, 1, d), 1.0) for d in (1, 2, 3)]
    flat = timeseries.error_autocorrelation(spark.createDataFrame(rows, "day date, error double")).collect()
    assert len(flat) == 3 and all(r["r"] is None for r in flat)
    none = spark.createDataFrame([], "day date, error double")
    assert timeseries.error_autocorrelation(none).collect() == []


def test_residual_histogram(scored):
    residual = scored.select(F.col("p") - F.col("y")).toPandas().iloc[:, 0]
    want, edges = np.histogram(residual, bins=50)
    got = charts.residual_histogram(scored, "y", "p").orderBy("bin").collect()
    assert [r["n"] for r in got] == list(want)
    assert [r["lo"] for r in got] == pytest.approx(list(edges[:-1]))
    assert [r["hi"] for r in got] == pytest.approx(list(edges[1:]))


def test_histogram_of_one_value_and_of_nothing(spark):
    same = spark.createDataFrame([(1.0, 3.0)] * 4, "y double, p double")
    got = {r["bin"]: r["n"] for r in charts.residual_histogram(same, "y", "p").collect()}
    assert got[25] == 4 and sum(got.values()) == 4
    assert charts.residual_histogram(same.limit(0), "y", "p").count() == 0


def test_bins_2d_hold_every_row(scored):
    pdf = scored.toPandas()
    want, _, _ = np.histogram2d(pdf["y"], pdf["p"], bins=10)
    got = np.zeros((10, 10))
    for r in charts.bins_2d(scored, "y", "p", 10).collect():
        got[r["x_bin"], r["y_bin"]] = r["n"]
    assert got.sum() == len(pdf)
    assert (got == want).all()
    assert charts.residual_points(scored, "y", "p").count() == len(pdf)


def test_quantile_points(scored):
    points = charts.qq_points(scored, "y", "p", "id").orderBy("rn").collect()
    residual = [r["residual"] for r in points]
    n = len(residual)
    assert residual == sorted(residual) and [r["rn"] for r in points] == list(range(1, n + 1))
    last = 0.5 ** (1 / n)
    medians = [1 - last, *[(i - 0.3175) / (n + 0.365) for i in range(2, n)], last]
    assert [r["x"] for r in points] == pytest.approx([NormalDist().inv_cdf(m) for m in medians], abs=1e-7)
    line = charts.qq_line(charts.qq_points(scored, "y", "p", "id")).first()
    slope, intercept = np.polyfit([r["x"] for r in points], residual, 1)
    assert (line["slope"], line["intercept"]) == pytest.approx((slope, intercept))
    assert charts.qq_points(scored.limit(0), "y", "p", "id").count() == 0


def _pacf(rs):
    """Partial autocorrelations by solving the Yule-Walker equations of every order."""
    out = [1.0]
    for k in range(1, len(rs)):
        matrix = np.array([[rs[abs(i - j)] for j in range(k)] for i in range(k)])
        out.append(np.linalg.solve(matrix, np.array(rs[1 : k + 1]))[-1])
    return out


def test_partial_autocorrelation(spark):
    rng, e = np.random.default_rng(8), [0.0, 0.0]
    for v in rng.normal(size=200):
        e.append(0.6 * e[-1] - 0.3 * e[-2] + v)
    daily = spark.createDataFrame([(i, float(v)) for i, v in enumerate(e)], "day int, error double")
    correlated = timeseries.error_autocorrelation(daily, lags=12)
    rs = [r["r"] for r in correlated.orderBy("lag").collect()]
    found = timeseries.error_partial_autocorrelation(correlated).orderBy("lag").collect()
    assert [r["lag"] for r in found] == list(range(13))
    assert [r["r"] for r in found] == pytest.approx(_pacf(rs))
    assert found[0]["band"] == 0 and found[5]["band"] == pytest.approx(1.959963984540054 / len(e) ** 0.5)


@pytest.mark.parametrize("values, lags", [([], []), ([1.0], []), ([1.0, 2.0], [0]), ([1.0, 5.0, 2.0, 4.0, 0.0, 3.0], [0, 1, 2]), ([2.0] * 6, [0, 1, 2])])
def test_partial_autocorrelation_of_short_series(spark, values, lags):
    daily = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "day int, error double")
    found = timeseries.error_partial_autocorrelation(timeseries.error_autocorrelation(daily)).orderBy("lag").collect()
    assert [r["lag"] for r in found] == lags
    if values and len(set(values)) == 1:
        assert all(r["r"] is None for r in found)
