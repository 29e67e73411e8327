"""Errors per model and split, binned confusion counts, ranking, the ensemble.

All take a frame of rows with a label, a split and one prediction column per
model. A frame of one row per model is small; rows of data never leave Spark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F, types as T

from headway.functions import binning, stats
from headway.schema import ENSEMBLE, SPLITS

# Column names of the evaluation table.
EVALUATION_SCHEMA = T.StructType(
    [
        T.StructField("Model", T.StringType()),
        T.StructField("Train_RMSE", T.DoubleType()),
        T.StructField("Test_RMSE", T.DoubleType()),
        T.StructField("Val_RMSE", T.DoubleType()),
        T.StructField("Test_R2", T.DoubleType()),
        T.StructField("Training_Time", T.DoubleType()),
    ]
)


def with_error(df: DataFrame, label: str, prediction: str, out: str = "error") -> DataFrame:
    return df.withColumn(out, F.col(prediction) - F.col(label))


def metrics(
    df: DataFrame, label: str, predictions: Mapping[str, str], split: str = "split"
) -> DataFrame:
    """RMSE and both R2 of every model on every split, in one aggregation.

    ``predictions`` maps model name to column. Each row is laid out once per model
    right before the partial aggregation, in the same stage: with one set of
    measures to update, that is faster than keeping those of all models side by
    side. What is shuffled is one row per model and split from each task.
    """
    y, p = F.col("__label"), F.col("__prediction")
    named = [F.col(f"`{column}`").cast("double").alias(name) for name, column in predictions.items()]
    long = df.select(F.col(split).alias("split"), F.col(label).cast("double").alias("__label"), *named).unpivot(
        ["split", "__label"], [F.col(f"`{name}`") for name in predictions], "model", "__prediction"
    )
    order = F.element_at(
        F.create_map(*[F.lit(v) for pair in zip(predictions, range(len(predictions))) for v in pair]), F.col("model")
    )
    return (
        long.groupBy("model", "split")
        .agg(
            F.count(p - y).alias("n"),
            stats.rmse(y, p).alias("rmse"),
            stats.r2(y, p).alias("r2"),
            stats.r2_corr(y, p).alias("r2_corr"),
        )
        .select("split", "model", order.alias("model_order"), "n", "rmse", "r2", "r2_corr")
    )


def evaluation_table(long: DataFrame, seconds: DataFrame | None = None) -> DataFrame:
    """One row per model with the errors of the three splits side by side."""

    def at(split: str, value: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(value)))

    wide = long.groupBy("model", "model_order").agg(
        at("train", "rmse").alias("Train_RMSE"),
        at("test", "rmse").alias("Test_RMSE"),
        at("val", "rmse").alias("Val_RMSE"),
        at("test", "r2").alias("Test_R2"),
    )
    if seconds is None:
        wide = wide.withColumn("Training_Time", F.lit(None).cast("double"))
    else:
        wide = wide.join(seconds.select("model", F.col("seconds").alias("Training_Time")), "model", "left")
    return wide.withColumnRenamed("model", "Model")


def metric_long(table: DataFrame, prefix: str = "RMSE") -> DataFrame:
    """Evaluation table turned to one row per model and split."""
    columns = {f"{s.capitalize()}_{prefix}": s for s in SPLITS if f"{s.capitalize()}_{prefix}" in table.columns}
    named = table.select("Model", *[F.col(c).alias(s) for c, s in columns.items()])
    return named.unpivot(["Model"], list(columns.values()), "split", prefix.lower())


def rank_models(table: DataFrame, by: str = "Test_RMSE", limit: int = 3) -> DataFrame:
    """The best models that have a score; of equal ones the first to be trained comes first."""
    return table.filter(F.col(by).isNotNull() & ~F.isnan(by)).orderBy(by, "model_order").limit(limit)


def best_model(table: DataFrame, by: str = "Test_RMSE") -> DataFrame:
    """The one best model, the ensemble included."""
    order = F.struct(F.col(by), F.col("model_order"))
    return table.filter(F.col(by).isNotNull() & ~F.isnan(by)).agg(
        F.min_by("Model", order).alias("Model"), F.min(by).alias(by)
    )


def row_mean(columns: Sequence[str]) -> Column:
    return reduce(add, [F.col(f"`{c}`") for c in columns]) / F.lit(float(len(columns)))


def with_ensemble(df: DataFrame, members: Sequence[str], out: str = f"pred_{ENSEMBLE}") -> DataFrame:
    """Mean of the members' predictions, row by row; they share the row already."""
    if len(members) < 3:
        raise ValueError("an ensemble needs three models")
    return df.withColumn(out, row_mean(members))


def ensemble_vs_components(table: DataFrame, members: DataFrame, ensemble: DataFrame) -> DataFrame:
    """Test errors of the members and of the ensemble, one below the other."""
    columns = ["Model", "Test_RMSE", "Test_R2"]
    parts = table.join(members.select("Model"), "Model", "left_semi").select(*columns)
    return parts.unionByName(ensemble.select(*columns))


def bin_edges(df: DataFrame, label: str, split: str = "split", k: int = 5) -> DataFrame:
    """Edges of each split's label range: (split, edge_no, edge)."""
    ends = df.groupBy(split).agg(F.min(label).alias("lo"), F.max(label).alias("hi"))
    return ends.select(
        F.col(split).alias("split"),
        F.posexplode(binning.linspace(F.col("lo"), F.col("hi"), k)).alias("edge_no", "edge"),
    )


def bin_labels(edges: DataFrame, separator: str = "-") -> DataFrame:
    """Text of each bin from its two edges: (split, bin, label)."""
    nxt = edges.select("split", (F.col("edge_no") - 1).alias("edge_no"), F.col("edge").alias("upper"))
    return edges.join(nxt, ["split", "edge_no"]).select(
        "split",
        (F.col("edge_no") + 1).alias("bin"),
        binning.edge_label(F.col("edge"), F.col("upper"), separator).alias("label"),
    )


def confusion(
    df: DataFrame,
    label: str,
    predictions: Mapping[str, str],
    split: str = "split",
    k: int = 5,
    kind: str = "digitize",
) -> DataFrame:
    """Counts per model, split, actual bin and predicted bin, zeros included.

    Edges span the actual values of each split. ``digitize`` bins are closed on
    the left and the bins shown are those that occur on either side; ``cut`` bins
    are closed on the right, always all shown, and leave out values beyond the
    edges.
    """
    if kind not in ("digitize", "cut"):
        raise ValueError(f"unknown kind {kind!r}")
    binned = {"digitize": binning.digitize, "cut": binning.cut}[kind]
    # One row per split, of which there are three.
    span = binning.edges(F.min(label), F.max(label), k)
    points = [f"__edge{i}" for i in range(k)]
    ends = df.groupBy(F.col(split).alias("split")).agg(*[e.alias(name) for e, name in zip(span, points)])
    at = [F.col(name) for name in points]
    counts = (
        df.join(F.broadcast(ends), df[split] == ends["split"])
        .select(
            ends["split"],
            binned(F.col(label), at).alias("actual_bin"),
            *[binned(F.col(f"`{c}`"), at).alias(name) for name, c in predictions.items()],
        )
        .unpivot(
            ["split", "actual_bin"], [F.col(f"`{name}`") for name in predictions], "model", "predicted_bin"
        )
        .filter(F.col("actual_bin").isNotNull() & F.col("predicted_bin").isNotNull())
        .groupBy("model", "split", "actual_bin", "predicted_bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if kind == "cut":
        seen = F.array(*[F.lit(i) for i in range(1, k)])
    else:
        seen = F.array_union(F.collect_set("actual_bin"), F.collect_set("predicted_bin"))
    # At most k+1 bins to a side, so the grid below is a few dozen rows per model.
    filled = counts.groupBy("model", "split").agg(
        seen.alias("bins"),
        F.map_from_entries(
            F.collect_list(F.struct(F.struct("actual_bin", "predicted_bin"), F.col("n")))
        ).alias("found"),
    )
    return (
        filled.withColumn("actual_bin", F.explode("bins"))
        .withColumn("predicted_bin", F.explode("bins"))
        .select(
            "model", "split", "actual_bin", "predicted_bin",
            F.coalesce(
                F.element_at("found", F.struct("actual_bin", "predicted_bin")), F.lit(0)
            ).cast("bigint").alias("n"),
        )
    )


def confusion_matrix(counts: DataFrame, k: int = 5) -> DataFrame:
    """The long counts laid out with one column per predicted bin."""
    return counts.groupBy("model", "split", "actual_bin").pivot("predicted_bin", list(range(k + 1))).sum("n")
