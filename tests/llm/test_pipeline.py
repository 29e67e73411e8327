"""The pipeline's stages, one by one and in a row."""

from pyspark.sql import functions as F

import corpus_pipeline
from headway.llm import batches, queries
from tests.llm import brute
from tests.llm.test_operators import check_pieces
from headway.llm.packing import WordCoder

SF = "/root/testdata/sf0.001"


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for at, (name, work) in enumerate(corpus_pipeline.STAGES, 1):
        work(spark, docs, SF).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = before.select("doc_id", "text").collect()
        assert docs.count() > 0
        if at < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
    rows = [(r["doc_id"], r["text"]) for r in kept["near_dedup"]]
    want = {i for i, (_, c) in brute.near_duplicates(rows, 5, 80).items() if i == c}
    assert {r["doc_id"] for r in kept["substring_dedup"]} == want
    rests = {i: rest.decode("utf-8", "ignore") for i, _, removed, _, rest in brute.remove_repeats([tuple(r) for r in kept["substring_dedup"]])}
    assert {r["doc_id"]: r["text"] for r in kept["mixing"]} == {i: t for i, t in rests.items() if t}
    assert {r["doc_id"] for r in kept["packing"]} <= set(rests)


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_one_row_of_each_group_of_copies_stays(spark):
    """Repeated rows, copies with a null id, ids with two texts: no text goes with all its copies."""
    one, two, three = (" ".join(f"w{k}x{i}" for i in range(80)) for k in range(3))
    rows = [(3, one), (3, one), (None, one), (5, one + " end"), (None, two), (None, two), (4, two + " z"), (6, three), (6, one), (7, ""), (7, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).repartition(3)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert sorted(map(repr, ((r[0], r[1]) for r in kept.collect()))) == sorted(map(repr, [(3, one), (4, two + " z"), (6, three), (7, ""), (7, ""), (8, None)]))
    cut = corpus_pipeline.drop_repeated_passages(spark, kept, SF)
    assert {r["text"] or "" for r in cut.collect()} == {one, two + " z", three, ""}


def test_stages_send_small_batches(spark, monkeypatch):
    """Texts go to Python a few at a time when what a stage returned is computed."""
    def sized(docs):
        def check(rows):
            for batch in rows:
                assert batch.nbytes < 100_000
                yield batch
        return docs.mapInArrow(check, docs.schema)

    monkeypatch.setattr(batches, "BYTES", 1 << 15)
    monkeypatch.setattr(corpus_pipeline.quality, "fit", lambda docs, labels: None)
    monkeypatch.setattr(corpus_pipeline.quality, "score", lambda docs, model, keep_as: sized(docs).withColumn(keep_as, F.lit(1.0)))
    monkeypatch.setattr(corpus_pipeline.substring_dedup, "remove_repeats", lambda docs, with_text: sized(docs))
    monkeypatch.setattr(corpus_pipeline.packing, "pack", lambda docs, files: sized(docs))
    docs = spark.createDataFrame([(k, f"word{k} " * 120, "en", "s", 0) for k in range(600)], DOCS).coalesce(1)
    try:
        for work in (corpus_pipeline.keep_good, corpus_pipeline.drop_repeated_passages, corpus_pipeline.pack_sequences):
            spark.conf.unset(batches.SETTING)
            assert work(spark, docs, SF).count() == 600
    finally:
        spark.conf.unset(batches.SETTING)


def test_run(spark):
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert len({(p["sequence_id"], p["offset"]) for p in pieces}) == len(pieces)


def test_whole_packing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = corpus_pipeline.pack_sequences(spark, docs, SF).collect()
    check_pieces([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], pieces, WordCoder(queries.tokenizer()[0]).whole)
