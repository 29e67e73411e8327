"""Suffix-array rules against the definition of repeats, and on awkward tables."""

import numpy as np

from headway.llm import quality_rules
from tests.llm import brute
from tests.llm.test_operators import SCHEMA, awkward

NAMES = ["n_repeat_words", "n_repeats", "n_covered", "longest_repeat"]


def test_repetition():
    rng = np.random.default_rng(1)
    for _ in range(150):
        texts = []
        for _ in range(rng.integers(1, 6)):
            words = rng.integers(0, rng.integers(1, 8), rng.integers(0, 50)).tolist()
            texts.append(words + words[: rng.integers(0, len(words) + 1)] if rng.random() < 0.5 else words)
        least = int(rng.integers(2, 6))
        got = quality_rules.repetition(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts]), least)
        assert list(zip(*[c.tolist() for c in got])) == [brute.repetition(t, least) for t in texts]


def test_suffix_array_is_in_order():
    words = np.random.default_rng(2).integers(0, 3, 300)
    order, shared = quality_rules.suffix_array(words, np.zeros(300, np.int64))
    suffixes = [words[i:].tolist() for i in order]
    assert suffixes == sorted(suffixes)
    for a, b, n in zip(suffixes, suffixes[1:], shared[1:]):
        assert a[:n] == b[:n] and a[n : n + 1] != b[n : n + 1]


def test_verdict(spark):
    fresh = lambda seed, n: " ".join(f"w{seed}x{i}" for i in range(n))
    texts = {
        1: fresh(1, 50), 2: " ".join(f"a{i} a{i} a{i} a{i} a{i}" for i in range(10)), 3: fresh(3, 9),
        4: f"{fresh(4, 120)} {fresh(5, 2000)} {fresh(4, 120)}", 5: f"{fresh(6, 15)} {fresh(7, 200)} {fresh(6, 15)}",
        6: f"{fresh(8, 4)} {fresh(9, 6)} {fresh(8, 4)}",
    }
    rows = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    assert {i: (r["base_failed"], r["kept"]) for i, r in rows.items()} == {
        1: (False, True), 2: (False, False), 3: (True, False), 4: (False, False), 5: (False, True), 6: (False, True),
    }
    assert rows[4]["longest_repeat"] == 120 and rows[4]["n_repeats"] == 1 and rows[2]["n_covered"] == 50


def test_awkward(spark, monkeypatch):
    """Null, empty and very long texts, null and repeated ids, odd white space, clashing names; texts sorted a few at a time."""
    monkeypatch.setattr(quality_rules, "AT_ONCE", 100)
    rows = [*awkward(), (77, "a b\n \na b\na b \n\r\na\x0bb | # <x>", "", 0.0, 1, "")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("mark", "n_words").withColumnRenamed("lang", "kept")
    got = sorted(map(repr, ([r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["n_covered"]] for r in quality_rules.judge(docs).collect())))
    want = []
    for i, text in ((r[0], r[1] or "") for r in rows):
        words, lines = brute.WORD.findall(text), [x for x in text.split("\n") if brute.WORD.search(x)]
        under, _, covered, _ = brute.repetition(words, 4) if len(words) < 2000 else (None,) * 4
        want.append([i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), under, covered])
    long = next(w for w in want if w[5] is None)
    long[5:] = next(eval(g)[5:] for g in got if eval(g)[0] == long[0])
    assert got == sorted(map(repr, want))


def test_empty(spark):
    assert quality_rules.judge(spark.createDataFrame([], SCHEMA)).collect() == []
