"""Spelling variants against deleting every code point of every word, and on awkward tables."""

import numpy as np
import pytest

from headway.llm import spelling
from tests.llm import brute
from tests.llm.test_operators import SCHEMA, awkward

SF = "/root/testdata/sf0.001"


def _found(df) -> dict:
    rows = df.collect()
    found = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(found) == len(rows)
    return found


def _texts(seed: int, n: int) -> list[tuple]:
    """Words of few letters, so that very many are one edit apart, some of them rare."""
    rng = np.random.default_rng(seed)
    letters = list("abÀÿ")
    words = ["".join(rng.choice(letters, rng.integers(5, 9))) for _ in range(n)]
    counts = rng.choice([1, 5, 6, 30, 200], n)
    return [(i, " ".join([w.upper() if "a" in w else w] * c)) for i, (w, c) in enumerate(zip(words, counts))]


@pytest.mark.parametrize("block, cells", [(64, 1 << 18), (4, 64)])
def test_near_words(spark, monkeypatch, block, cells):
    """Also with tiny blocks, so that keys are cut into tiles and tiles are settled one by one."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "CELLS", cells)
    rows = _texts(3, 500)
    assert _found(spelling.variants(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute.spelling(rows)


def test_chain_of_forms(spark):
    words = {"abcdefgh": 3200, "abcdefg": 640, "abcdef": 128, "abcdeX": 25, "abcdXX": 5, "zzzzzz": 5}
    rows = [(i, f"{w} " * n) for i, (w, n) in enumerate(words.items())]
    found = _found(spelling.variants(spark.createDataFrame(rows, "doc_id bigint, text string"), drops=10**9))
    assert found["abcdxx"][4] == "abcdefgh" and found["abcdxx"][2] == "abcdex"
    assert found["zzzzzz"] == (5, 0, None, None, "zzzzzz")


def test_ties_go_to_the_smallest_word(spark):
    rows = [(1, "wordsa " * 50 + "wordsb " * 50 + "wordsc " * 6)]
    found = _found(spelling.variants(spark.createDataFrame(rows, "doc_id bigint, text string"), drops=10**9))
    assert found["wordsc"] == (6, 2, "wordsa", 50, "wordsa")


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert _found(spelling.variants(docs)) == brute.spelling([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_awkward(spark):
    """Null ids and texts, repeated rows, very long texts and words, columns with clashing names."""
    rows = [*awkward(), *[(7, "a" * 3000 + " " + "b" * 3000 + "c", "", 0.0, 1, "")] * 6, *[(8, "b" * 3001, "", 0.0, 1, "")] * 7]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("lang", "word").withColumnRenamed("mark", "n")
    assert _found(spelling.variants(docs)) == brute.spelling([r[:2] for r in rows])


def test_empty(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")).collect() == []
