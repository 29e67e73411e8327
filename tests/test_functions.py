import datetime as dt
import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.functions import binning, parsing, stats
from headway.functions.calendar import calendar_columns, is_month_end


def test_calendar_at_the_edges(spark):
    days = ["2020-12-31 23:59:59", "2021-01-01 00:00:00", "2021-01-03 07:00:00", "2024-02-28 09:59:59",
            "2024-02-29 10:00:00", "2023-02-28 16:00:00", "2024-12-30 18:59:59", "2024-04-30 19:00:00"]
    df = spark.createDataFrame([(d,) for d in days], "t string").select(F.to_timestamp("t").alias("t"))
    for row in df.withColumns(calendar_columns(F.col("t"))).collect():
        t = row["t"]
        nxt = t + dt.timedelta(days=1)
        assert row["Hour"] == t.hour
        assert row["DayOfWeek"] == t.isoweekday() % 7 + 1
        assert row["WeekOfYear"] == t.isocalendar().week
        assert row["DayOfYear"] == t.timetuple().tm_yday
        assert row["IsMonthEnd"] == int(nxt.month != t.month)
        assert row["IsMonthStart"] == int(t.day == 1)
        assert row["IsMorningPeak"] == int(7 <= t.hour <= 9)
        assert row["IsEveningPeak"] == int(16 <= t.hour <= 18)
        assert row["IsWeekend"] == int(t.isoweekday() >= 6)
        assert row["Hour_sin"] == pytest.approx(math.sin(2 * math.pi * t.hour / 24), abs=1e-12)
        assert row["Month_cos"] == pytest.approx(math.cos(2 * math.pi * t.month / 12), abs=1e-12)


def test_month_end_modes(spark):
    df = spark.createDataFrame([("2024-02-28",), ("2024-02-29",), ("2024-01-27",), ("2024-01-31",)], "d string")
    day = F.to_date("d")
    rows = df.select(is_month_end(day).alias("a"), is_month_end(day, "late_days").alias("b")).collect()
    assert [tuple(r) for r in rows] == [(0, 1), (1, 1), (0, 0), (1, 1)]
    with pytest.raises(ValueError):
        is_month_end(day, "other")


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("1.5", "2024-01-02 03:04:05"), ("abc", "soon"), (None, None)], "a string, b string")
    rows = df.select(parsing.number(F.col("a")), parsing.moment(F.col("b")),
                     parsing.epoch_seconds(parsing.moment(F.col("b")))).collect()
    assert [r[0] for r in rows] == [1.5, None, None]
    assert [r[1] for r in rows] == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None]
    assert rows[0][2] == 1704164645
    fmt = spark.createDataFrame([("02/01/2024 03:04",)], "b string")
    assert fmt.select(parsing.moment(F.col("b"), "dd/MM/yyyy HH:mm")).first()[0] == dt.datetime(2024, 1, 2, 3, 4)


def test_digitize_and_linspace_match_numpy(spark):
    values = [-5.0, 0.0, 0.1, 2.4999, 2.5, 7.4, 7.5, 9.99, 10.0, 11.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    edges = np.linspace(0, 10, 5)
    assert df.select(binning.linspace(0.0, 10.0, 5)).first()[0] == list(edges)
    got = [r[0] for r in df.select(binning.digitize(F.col("x"), binning.edges(0.0, 10.0, 5))).collect()]
    assert got == list(np.digitize(values, edges))


def test_digitize_of_a_constant_and_of_null(spark):
    df = spark.createDataFrame([(3.0,), (2.0,), (None,)], "x double")
    assert [r[0] for r in df.select(binning.digitize(F.col("x"), binning.edges(3.0, 3.0, 5))).collect()] == [5, 0, None]


def test_cut_is_closed_on_the_right(spark):
    values = [-0.1, 0.0, 2.5, 2.6, 5.0, 10.0, 10.1, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(binning.cut(F.col("x"), binning.edges(0.0, 10.0, 5))).collect()]
    assert got == [None, 1, 1, 2, 2, 4, None, None]


@pytest.mark.parametrize("lo,hi", [(0.0, 1.0), (-3.7, 12.9), (0.1, 0.7)])
def test_histogram_bins_match_numpy(spark, lo, hi):
    edges = np.linspace(lo, hi, 51)
    values = sorted({*edges, *np.nextafter(edges[1:-1], -np.inf), *np.linspace(lo, hi, 333)})
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = np.bincount([r[0] for r in df.select(binning.histogram_bin(F.col("x"), lo, hi, 50)).collect()], minlength=50)
    assert got.sum() == len(values) and len(got) == 50
    want, _ = np.histogram(values, bins=50, range=(lo, hi))
    assert np.abs(got - want).sum() <= 2  # edges computed as lo + i*step may differ in the last bit


def test_edge_labels(spark):
    df = spark.createDataFrame([(0.014, 1234.5)], "a double, b double")
    assert df.select(binning.edge_label(F.col("a"), F.col("b"))).first()[0] == "0.01-1234.50"


def test_probit_matches_the_normal_distribution(spark):
    ps = [1e-9, 1e-4, 0.02, 0.02425, 0.1, 0.5, 0.77, 0.97575, 0.99, 1 - 1e-6]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    for p, row in zip(ps, df.select(stats.probit(F.col("p"))).collect()):
        assert row[0] == pytest.approx(NormalDist().inv_cdf(p), rel=2e-9, abs=1e-9)
    edge = spark.createDataFrame([(0.0,), (1.0,)], "p double")
    assert [r[0] for r in edge.select(stats.probit(F.col("p"))).collect()] == [None, None]


def test_order_statistic_medians(spark):
    got = [r[0] for r in spark.range(1, 6).select(stats.order_statistic_median(F.col("id"), 5)).collect()]
    last = 0.5 ** (1 / 5)
    assert got == pytest.approx([1 - last, *[(i - 0.3175) / 5.365 for i in (2, 3, 4)], last])
