"""The corpus pipeline: quality, near copies, repeated passages, mixing, packing.

Each stage works on all documents that the one before it kept, and every stage but
the last returns the columns of ``documents``. SQL cannot express the classifier,
the bands or the tokenizer, so there is no oracle: tests/llm holds the stages
against plain versions. Stages that hand texts to Python set the session's Arrow
batches to a megabyte and leave them so, as what they return is computed later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm import batches, mixing, near_dedup, packing, quality, queries, substring_dedup
from headway.llm.substring_dedup import free_name
from headway.sources.writing import stage

LEAST_SCORE = 0.3


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects."""
    batches.keep_small(spark)
    model = quality.fit(docs, _labels(spark, sf_dir))
    name = free_name(docs, "score")
    return quality.score(docs, model, keep_as=name).filter(F.col(name) >= LEAST_SCORE).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: five-word shingles, 0.8 or more alike.

    Rows are compared, not ids: of repeated rows and of copies with a null or the same
    id one stays too, the one of the smallest id. Texts without words stay all.
    """
    row = free_name(docs, "row")
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-rows")  # numbered for good once it is written
    judged = near_dedup.near_duplicates(rows, words=5, percent=80, id_col=row)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row).alias("at"))  # a null id comes last
    ranked = rows.select(F.col(row).alias("doc_id"), order.alias("order")).join(judged, "doc_id")
    kept = ranked.groupBy("component_id").agg(F.min("order").alias("order"))
    return rows.join(kept.select(F.col("order.at").alias(row)), row, "left_semi").select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out every 200-byte string that stands anywhere else; the length follows the text."""
    batches.keep_small(spark)
    cut = substring_dedup.remove_repeats(docs, with_text=True)
    return cut.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give each document as many copies as its rate says, none for a rate near 0."""
    mixed = mixing.mix(docs, _labels(spark, sf_dir), queries.domain(), queries.TARGETS)
    mark, copies = free_name(docs, "mark"), free_name(docs, "copies")
    rates = mixed.filter("copies > 0").select(F.col("mark").alias(mark), F.col("copies").alias(copies)).dropDuplicates([mark])
    return (
        docs.withColumn(mark, mixing.mark(docs)).join(rates, mark)
        .withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
        .select(*docs.columns)
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    batches.keep_small(spark)
    return packing.pack(docs, queries.tokenizer())


STAGES = [
    ("quality", keep_good),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_domains),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, work) in enumerate(STAGES, 1):
        docs = work(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
