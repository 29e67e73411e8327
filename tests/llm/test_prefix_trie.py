"""The trie against the set of all prefixes, and on awkward tables."""

import random

import pytest
from pyspark.sql import functions as F

from headway.llm import prefix_trie
from tests.llm import brute

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SF = "/root/testdata/sf0.001"


def _found(df) -> dict:
    rows = df.collect()
    found = {(r["conv_id"], r["depth"]): tuple(r[2:]) for r in rows}
    assert len(found) == len(rows)
    return found


def _check(spark, rows) -> None:
    assert _found(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute.prefix_trie(rows)


def test_two_fattest(spark):
    ends = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(ends, "a bigint, b bigint").select("a", "b", prefix_trie.two_fattest(F.col("a"), F.col("b")).alias("f")).collect()
    for a, b, f in got:
        assert f == max(range(a + 1, b + 1), key=lambda x: (x & -x))


def test_shared_prefixes(spark):
    """Few different turns, many lengths: long shared ways, ends inside edges, copies, missing group heads."""
    rng, rows = random.Random(5), []
    for c in range(150):
        if rng.random() < 0.1:
            continue
        for t in range(rng.choice([1, 2, 3, 5, 9, 17, 40])):
            rows.append((c, t or (None if rng.random() < 0.2 else 0), "u" if t else rng.choice(["u", None, ""]), rng.choice(["a b", "c", None][: 1 if rng.random() < 0.9 else 3])))
    _check(spark, rows)


def test_slices(spark, monkeypatch):
    """Sums carried from slice to slice, and a conversation that is far longer than the others."""
    monkeypatch.setattr(prefix_trie, "SLICE", 3)
    rows = [(c, t, "u", "x y" if t % 7 else f"z{c % 3}") for c in range(6) for t in range((c * 5) % 23 + 1)]
    _check(spark, rows + [(5, t, "u", "long") for t in range(100, 180)])


def test_digests_of_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 40)
    _check(spark, [(c, 0, "u", "same") for c in range(300)])


def test_whole_table(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    assert _found(prefix_trie.prefix_trie(turns)) == brute.prefix_trie([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])


def test_awkward(spark):
    """Null ids, turns, roles and texts, repeated rows, turnless conversations, long texts, clashing names."""
    rows = [
        (None, 0, "u", "nobody"), (None, None, None, None), (0, None, None, None), (0, 1, "u", "a"), (0, 1, "u", "a"), (0, 2, "u", "w " * 50_000),
        *[(c, 0, "u", "only") for c in range(41, 60)],  # heads of their group are missing: some are left without turns
        (1, 5, "", ""), (1, 7, None, ""), (20, 0, "u", "😀 é"),
    ]
    turns = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", depth bigint, k1 string")
    assert _found(prefix_trie.prefix_trie(turns)) == brute.prefix_trie(rows)


@pytest.mark.parametrize("rows", [[], [(None, 0, "u", "x")]])
def test_without_conversations(spark, rows):
    assert prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_only_turnless(spark):
    """Conversations whose turns all give way to those of a missing head."""
    turnless = [c for c in range(1, 20) if prefix_trie_h(c)]
    _check(spark, [(c, 0, "u", "x") for c in turnless])


def prefix_trie_h(c: int) -> int:
    import zlib

    return zlib.crc32(str(c).encode()) % 4
