"""Result files, saved models and staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.operators.evaluation import EVALUATION_SCHEMA
from headway.session import shared_dir


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_predictions(df: DataFrame, path: str, time: str, label: str, prediction: str = "prediction") -> None:
    """Time, label and prediction of each row as CSV."""
    write_csv(df.select(time, label, F.col(f"`{prediction}`").alias("prediction")), path)


def write_evaluation(table: DataFrame, path: str) -> None:
    """One line per model, columns in their fixed order."""
    write_csv(table.select(*[F.col(f.name).cast(f.dataType) for f in EVALUATION_SCHEMA.fields]), path)


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Chart tables, one Parquet folder each."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_ensemble(spark: SparkSession, members: Mapping[str, PipelineModel], path: str) -> None:
    """An ensemble is its members and the list of their names."""
    for name, model in members.items():
        save_model(model, f"{path}/members/{name}")
    rows = [(i, name) for i, name in enumerate(members)]
    spark.createDataFrame(rows, "position int, member string").coalesce(1).write.mode("overwrite").json(
        f"{path}/member_list"
    )


def load_ensemble(spark: SparkSession, path: str) -> dict[str, PipelineModel]:
    listed = spark.read.schema("position int, member string").json(f"{path}/member_list")
    return {r["member"]: load_model(f"{path}/members/{r['member']}") for r in listed.orderBy("position").collect()}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path of its own in the shared folder."""
    return f"{shared_dir(spark)}/headway/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = (), folder: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    What is used many times is computed once, and the loss of an executor costs
    no recomputation.
    """
    path = f"{folder}/{name}" if folder else scratch_folder(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a folder of staged tables; nothing outside the package's own is touched."""
    if not folder.startswith(f"{shared_dir(spark)}/headway/"):
        raise ValueError(f"{folder} holds no staged tables")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
