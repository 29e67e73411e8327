"""What the chosen model looks at and how its prediction moves."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import Column, DataFrame, functions as F, types as T

from headway.sources.writing import discard, scratch_folder

IMPORTANCE_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("feature_index", T.IntegerType()),
        T.StructField("importance", T.DoubleType()),
        T.StructField("kind", T.StringType()),
    ]
)


def importance_table(spark, model: Model, features: Sequence[str]) -> DataFrame:
    """One row per feature, the most important first; ``features`` names every slot of the vector.

    Tree models give impurity importances, which sum to 1; linear models the
    absolute coefficients of the standardised features. The kind says which.
    """
    if hasattr(model, "featureImportances"):
        values, kind = model.featureImportances.toArray(), "impurity"
    elif hasattr(model, "coefficients"):
        values, kind = abs(model.coefficients.toArray()), "coefficient"
    else:
        raise ValueError(f"{type(model).__name__} has no importances")
    if len(values) != len(features):
        raise ValueError(f"{len(features)} features are named, the model has {len(values)}")
    at: dict[str, int] = {}
    total: dict[str, float] = {}
    for i, (name, v) in enumerate(zip(features, values)):  # slots of one column are added up
        at.setdefault(name, i)
        total[name] = total.get(name, 0.0) + float(v)
    rows = [(name, at[name], total[name], kind) for name in at]
    return spark.createDataFrame(rows, IMPORTANCE_SCHEMA).orderBy(F.desc("importance"), "feature_index")


def top_features(importance: DataFrame, n: int = 10) -> list[str]:
    return [row["feature"] for row in importance.limit(n).select("feature").collect()]


def gain_importance(spark, model: MLWritable, features: Sequence[str]) -> DataFrame:
    """Mean gain per split, number of splits and share of all gain, per feature used.

    Spark saves a tree model as a table of nodes; the gains are aggregated there.
    Features that no node splits on are absent.
    """
    path = scratch_folder(spark, "nodes")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("nodeData.*").filter(F.col("leftChild") >= 0)
    found = (
        nodes.groupBy(F.col("split.featureIndex").alias("feature_index"))
        .agg(F.avg("gain").alias("mean_gain"), F.sum("gain").alias("total_gain"), F.count("gain").alias("n_splits"))
        .collect()  # one row per feature
    )
    discard(spark, path)
    everything = sum(row["total_gain"] for row in found)
    rows = [
        (features[r["feature_index"]], r["feature_index"], r["mean_gain"], r["total_gain"], r["n_splits"],
         r["total_gain"] / everything if everything else None)
        for r in sorted(found, key=lambda r: (-r["mean_gain"], r["feature_index"]))
    ]
    return spark.createDataFrame(
        rows,
        "feature string, feature_index int, mean_gain double, total_gain double, n_splits bigint, gain_share double",
    )


def dependence_points(df: DataFrame, features: Sequence[str], y: str) -> DataFrame:
    """Every (feature, value, y) point, long."""
    return df.select(*features, F.col(y).alias("y")).unpivot(["y"], list(features), "feature", "value")


def dependence_lines(df: DataFrame, features: Sequence[str], y: str) -> DataFrame:
    """Least-squares line of y on each feature; null for a feature without spread."""
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            F.regr_slope(y, f).alias("slope"),
            F.regr_intercept(y, f).alias("intercept"),
        )
        for f in features
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair: (f1, f2, corr), rows with both present.

    Means are taken first and the products of the centred values summed second:
    two plain passes cost a fraction of one with a moving mean per pair. Pairs
    with missing values get sums over their own rows. Null where one of the two
    does not vary.
    """
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.struct(F.avg(c).alias("mean"), F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c)
            for c in columns
        ],
    ).first()
    centred = {c: F.col(c).cast("double") - F.lit(seen[c]["mean"]) for c in columns}

    def value(a: str, b: str) -> Column:
        if seen[a]["lo"] == seen[a]["hi"] or seen[b]["lo"] == seen[b]["hi"]:
            return F.lit(None).cast("double")
        x, y = centred[a], centred[b]
        if seen[a]["n"] == seen[b]["n"] == seen["rows"]:
            return F.sum(x * y) / F.sqrt(F.sum(x * x) * F.sum(y * y))
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        n = F.count_if(both)
        together = n * F.sum(x * y) - F.sum(x) * F.sum(y)
        apart = (n * F.sum(x * x) - F.sum(x) * F.sum(x)) * (n * F.sum(y * y) - F.sum(y) * F.sum(y))
        return F.when((F.min(x) < F.max(x)) & (F.min(y) < F.max(y)), together / F.sqrt(apart))

    pairs = [(a, a, value(a, a)) for a in columns]
    for a, b in combinations(columns, 2):
        r = value(a, b)
        pairs += [(a, b, r), (b, a, r)]
    rows = [F.struct(F.lit(a).alias("f1"), F.lit(b).alias("f2"), r.alias("corr")) for a, b, r in pairs]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def partial_dependence(
    model: PipelineModel, df: DataFrame, features: Sequence[str], inputs: Sequence[str], points: int = 20,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Mean prediction as one feature runs over its range and the others stay.

    The grid of features and points is a constant, so each row is scored at every
    point where it lies and only (feature, point) sums are shuffled. ``carried``
    columns, such as text categories, reach the model as they are.
    """
    ends = df.agg(
        *[F.min(f).cast("double").alias(f"min {f}") for f in features],
        *[F.max(f).cast("double").alias(f"max {f}") for f in features],
    ).first()
    grid = []
    for f in features:
        lo, hi = ends[f"min {f}"], ends[f"max {f}"]
        if lo is None:
            continue
        for i in range(points):
            at = hi if i == points - 1 else lo + i * ((hi - lo) / (points - 1))
            grid.append(F.struct(F.lit(f).alias("feature"), F.lit(i).alias("step"), F.lit(at).alias("point")))
    if not grid:
        raise ValueError("no values to run over")
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in inputs], *carried)
    laid = rows.select("*", F.inline(F.array(*grid)))
    moved = laid.withColumns(
        {f: F.when(F.col("feature") == f, F.col("point")).otherwise(F.col(f)) for f in features}
    )
    return (
        model.transform(moved)
        .groupBy("feature", "step", "point")
        .agg(F.avg("prediction").alias("mean_prediction"))
    )
