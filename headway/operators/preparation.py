"""Imputation, standardisation and the feature stages of a model.

Statistics are fitted once, in one aggregate over all columns, and then used as
constants. There are as many of them as columns, not rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, functions as F


def fit_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return row.asDict()


def mean_fill(df: DataFrame, means: dict[str, float | None]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in means.items()})


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample standard deviation of each column."""
    row = df.agg(
        *[F.avg(c).alias(f"mean {c}") for c in columns],
        *[F.stddev_samp(c).alias(f"std {c}") for c in columns],
    ).first()
    return {c: (row[f"mean {c}"], row[f"std {c}"]) for c in columns}


def standardize(df: DataFrame, scaling: dict[str, tuple[float, float]]) -> DataFrame:
    """Centre and scale; a column without spread becomes 0."""
    return df.withColumns(
        {
            c: (F.col(c) - F.lit(mean)) / F.lit(std) if std else F.when(F.col(c).isNotNull(), F.lit(0.0))
            for c, (mean, std) in scaling.items()
        }
    )


def unstandardize(df: DataFrame, scaling: dict[str, tuple[float, float]]) -> DataFrame:
    """Back to the original units."""
    return df.withColumns(
        {c: F.col(c) * F.lit(std or 0.0) + F.lit(mean) for c, (mean, std) in scaling.items()}
    )


def feature_stages(features: Sequence[str], output: str = "scaledFeatures", categorical: Sequence[str] = ()) -> Pipeline:
    """Mean imputation, assembly and standardisation as one Spark ML pipeline.

    Columns of category codes (see ``categories.encode``), off by default, are one-hot
    encoded and put behind the scaled numbers as they are: not centred, so the vector
    stays sparse. A code beyond the dictionary has no slot.
    """
    filled = [f"{c}_filled" for c in features]
    scaled = "scaledNumbers" if categorical else output
    stages = [
        Imputer(strategy="mean", inputCols=list(features), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="error"),
        StandardScaler(inputCol="features", outputCol=scaled, withMean=True, withStd=True),
    ]
    if categorical:
        encoded = [f"{c}_onehot" for c in categorical]
        stages += [
            OneHotEncoder(inputCols=list(categorical), outputCols=encoded, dropLast=True),
            VectorAssembler(inputCols=[scaled, *encoded], outputCol=output, handleInvalid="error"),
        ]
    return Pipeline(stages=stages)


def slot_names(features: Sequence[str], sizes: Mapping[str, int]) -> list[str]:
    """The column behind each slot of the feature vector; ``sizes`` are the values of each category."""
    return [*features, *[c for c, n in sizes.items() for _ in range(n)]]


def fit_features(df: DataFrame, features: Sequence[str], categorical: Sequence[str] = ()) -> PipelineModel:
    """Fit the feature stages; ``categorical`` names columns of codes."""
    numeric = df.withColumns({c: F.col(c).cast("double") for c in features})
    return feature_stages(features, categorical=categorical).fit(numeric)
