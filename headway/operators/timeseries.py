"""Errors over time. Days bound the size of everything after the first grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Fixed value: two-sided 95 % point of the normal distribution.
Z95 = 1.959963984540054


def daily_errors(df: DataFrame, time: str, label: str, prediction: str) -> DataFrame:
    """Daily means of label, prediction and error; days without rows are there as nulls.

    Each day that has rows stretches to the day before the next one, so the rows
    are read once and no calendar has to be joined.
    """
    p, y = F.col(prediction), F.col(label)
    daily = (
        df.filter(F.col(time).isNotNull())
        .groupBy(F.to_date(time).alias("day"))
        .agg(F.avg(y).alias("actual"), F.avg(p).alias("predicted"), F.avg(p - y).alias("error"))
    )
    following = F.lead("day").over(Window.orderBy("day"))  # one row per day
    until = F.coalesce(F.date_sub(following, 1), F.col("day"))
    stretched = daily.withColumn("until", until).select(
        "*", F.explode(F.sequence("day", "until")).alias("date")
    )
    values = ("actual", "predicted", "error")
    return stretched.select(
        F.col("date").alias("day"), *[F.when(F.col("date") == F.col("day"), F.col(c)).alias(c) for c in values]
    )


def error_autocorrelation(daily: DataFrame, error: str = "error", lags: int = 30) -> DataFrame:
    """Autocorrelation of the daily error with Bartlett's 95 % band: (lag, r, band).

    Days without an error are left out and the rest counts as consecutive. The
    window has no partition because the series is one row per day.
    """
    order = Window.orderBy("day")
    series = daily.filter(F.col(error).isNotNull()).select("day", F.col(error).alias("e"))
    centred = series.withColumn("x", F.col("e") - F.avg("e").over(Window.partitionBy()))
    shifted = centred.select(
        "x", *[(F.col("x") * F.lag("x", k).over(order)).alias(f"x{k}") for k in range(1, lags + 1)]
    )
    sums = shifted.agg(
        F.count("x").alias("n"),
        F.sum(F.col("x") * F.col("x")).alias("s0"),
        *[F.sum(f"x{k}").alias(f"s{k}") for k in range(1, lags + 1)],
    )
    r = F.array(*[F.when(F.col("s0") > 0, F.col(f"s{k}") / F.col("s0")) for k in range(lags + 1)])
    rows = sums.select("n", r.alias("rs")).select("n", "rs", F.posexplode("rs").alias("lag", "r"))
    before = F.aggregate(
        F.slice("rs", F.lit(2), F.greatest(F.col("lag") - 1, F.lit(0))), F.lit(0.0), lambda acc, v: acc + v * v
    )
    band = F.when(F.col("lag") == 0, 0.0).otherwise(
        F.lit(Z95) * F.sqrt((F.lit(1.0) + F.lit(2.0) * before) / F.col("n"))
    )
    return rows.filter(F.col("lag") < F.col("n")).select("lag", "r", band.alias("band"))


def error_partial_autocorrelation(autocorrelation: DataFrame) -> DataFrame:
    """Partial autocorrelation by the Durbin-Levinson recursion: (lag, r, band), from the table of autocorrelations.

    The recursion runs over an array of as many values as there are lags, as one
    column expression. Only lags below half the length of the series are there, and
    the band is that of independent values. A series without spread gives nulls.
    """
    series = autocorrelation.agg(
        F.array_sort(F.collect_list(F.struct("lag", "r"))).alias("rows"), F.max(F.when(F.col("lag") == 1, F.col("band"))).alias("band")
    ).filter(F.size("rows") > 1)
    rs = F.transform("rows", lambda x: x["r"])
    days = F.round(F.lit(Z95 * Z95) / (F.col("band") * F.col("band")))  # the band at lag 1 holds their number
    last = F.least(F.size("rows") - 1, F.ceil(days / 2).cast("int") - 1)

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)

    def step(acc, k):
        before = F.slice(F.col("rs"), F.lit(2), k - 1)
        phi = acc["phi"]
        new = (F.element_at(F.col("rs"), k + 1) - dot(phi, F.reverse(before))) / (F.lit(1.0) - dot(phi, before))
        return F.struct(
            F.concat(F.zip_with(phi, F.reverse(phi), lambda x, y: x - new * y), F.array(new)).alias("phi"),
            F.concat(acc["found"], F.array(new)).alias("found"),
        )

    nothing = F.array().cast("array<double>")
    found = F.aggregate(
        F.when(F.col("last") > 0, F.sequence(F.lit(1), F.col("last"))).otherwise(F.array().cast("array<int>")),
        F.struct(nothing.alias("phi"), nothing.alias("found")), step, lambda acc: F.concat(F.array(F.element_at("rs", 1)), acc["found"]),
    )
    return (
        series.select(rs.alias("rs"), "band", last.alias("last")).select("band", F.posexplode(found).alias("lag", "r"))
        .select("lag", "r", F.when(F.col("lag") == 0, 0.0).otherwise(F.col("band")).alias("band"))
    )
