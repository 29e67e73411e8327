"""The tables behind the charts. Every row of data is in them: as a point or in a count."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from headway.functions.binning import histogram_bin
from headway.functions.stats import correlation, order_statistic_median, probit
from headway.operators.ordering import global_row_number
from headway.operators.selection import order_statistics, spread_ranks


def residual_histogram(df: DataFrame, label: str, prediction: str, bins: int = 50) -> DataFrame:
    """Counts of prediction - label in equal bins, empty ones included: (bin, lo, hi, n)."""
    residual = (F.col(prediction) - F.col(label)).alias("residual")
    rows = df.select(residual).filter(F.col("residual").isNotNull())
    lo, hi = rows.agg(F.min("residual"), F.max("residual")).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    counts = rows.groupBy(histogram_bin(F.col("residual"), lo, hi, bins).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    start, step = (lo, (hi - lo) / bins) if lo < hi else (lo - 0.5, 1.0 / bins)
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.lit(start) + F.col("bin") * F.lit(step)).alias("lo"),
        (F.lit(start) + (F.col("bin") + 1) * F.lit(step)).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def bins_2d(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """Rows per cell of a bins-by-bins grid over the ranges of x and y: (x_bin, y_bin, n)."""
    rows = df.select(F.col(x).alias("x"), F.col(y).alias("y")).filter(
        F.col("x").isNotNull() & F.col("y").isNotNull()
    )
    x0, x1, y0, y1 = rows.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if x0 is None:
        return df.sparkSession.createDataFrame([], "x_bin int, y_bin int, n bigint")
    return rows.groupBy(
        histogram_bin(F.col("x"), x0, x1, bins).cast("int").alias("x_bin"),
        histogram_bin(F.col("y"), y0, y1, bins).cast("int").alias("y_bin"),
    ).agg(F.count(F.lit(1)).alias("n"))


def residual_points(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Actual, predicted and residual of every row."""
    y, p = F.col(label), F.col(prediction)
    return df.select(y.alias("actual"), p.alias("predicted"), (p - y).alias("residual"))


def qq_points(df: DataFrame, label: str, prediction: str, key: str) -> DataFrame:
    """Every residual against the normal quantile of its rank: (key, residual, rn, x)."""
    rows = df.select(F.col(key), (F.col(prediction) - F.col(label)).alias("residual")).filter(
        F.col("residual").isNotNull()
    )
    ranked = global_row_number(rows, ["residual", key])
    n = ranked.count()
    if n == 0:
        return ranked.withColumn("x", F.lit(None).cast("double"))
    return ranked.withColumn("x", probit(order_statistic_median(F.col("rn"), n)))


def qq_thin(df: DataFrame, label: str, prediction: str, most: int = 1000) -> DataFrame:
    """Some order statistics of the residuals against their normal quantiles: (residual, rn, x).

    They reach from the least residual to the greatest and are found without sorting.
    """
    rows = df.select((F.col(prediction) - F.col(label)).cast("double").alias("residual")).filter(
        F.col("residual").isNotNull() & ~F.isnan("residual")
    )
    n = rows.count()
    ranks = spread_ranks(n, most)
    points = list(zip(order_statistics(rows, "residual", ranks), ranks))
    table = df.sparkSession.createDataFrame(points, "residual double, rn bigint")
    return table.withColumn("x", probit(order_statistic_median(F.col("rn"), max(n, 1))))


def qq_line(points: DataFrame) -> DataFrame:
    """Least-squares line through the quantile points and its correlation."""
    return points.agg(
        F.regr_slope("residual", "x").alias("slope"),
        F.regr_intercept("residual", "x").alias("intercept"),
        correlation(F.col("residual"), F.col("x")).alias("r"),
    )
