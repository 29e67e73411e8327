"""Quality rules: counts of a text, and how much of it repeats itself, by a suffix array.

The words of many texts are laid out one after the other; the first rank of a word
holds its text, so suffixes never match across texts. Ranks of windows of 1, 2, 4,
... words are refined by sorting pairs of ranks, and only windows that are not the
only ones of their kind stay in the sort. The common prefix of neighbours in the
suffix array is read off the stored ranks, the widest first. Intervals of common
prefixes give the maximal repeats: substrings that stand in several places and can
be made longer on neither side. The union of their spans is what a text repeats.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW, MOST_REPEATED, FEWEST = 5, 20, 10  # base rule: words of a window, per cent in repeated windows, words of a text
REPEAT, COVERED, LONGEST = 4, 25, 100  # verdict: words of a repeat at least, per cent covered, words of the longest
FREE = 10  # covered words that are no fault in the shortest text: a line of a few words, said twice
AT_ONCE = 1 << 18  # words sorted together, beyond the last text

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def _group_ends(keys: np.ndarray) -> np.ndarray:
    """Ranks: how many keys are as small or smaller, equal keys included."""
    order = np.argsort(keys)
    edges = np.flatnonzero(np.diff(keys[order], append=keys[order[-1]] + 1)) + 1
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.repeat(edges, np.diff(edges, prepend=0))
    return rank


def suffix_array(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in suffix order, and the words that each shares with the one before it.

    ``text`` names the text of each word, in order. Places whose word stands nowhere
    else in its text are left out: they share nothing.
    """
    n = len(words)
    rank = _group_ends(text * (int(words.max()) + 1) + words)
    end = np.searchsorted(text, text, "right")
    levels = [rank]
    places = open_ = np.flatnonzero(np.bincount(rank)[rank] > 1)
    while len(open_):
        behind = open_ + (1 << (len(levels) - 1))
        pair = rank[open_] * (n + 1) + np.where(behind < end[open_], rank[np.minimum(behind, n - 1)], 0)
        by = np.argsort(pair)
        open_, pair = open_[by], pair[by]
        edges = np.flatnonzero(np.diff(pair, append=pair[-1] + 1)) + 1  # where pairs end
        sizes, group = np.diff(edges, prepend=0), pair[edges - 1] // (n + 1)
        group_end = edges[np.searchsorted(group, group, "right") - 1]
        # A pair ranks as its group did, less the places that come behind it there.
        rank = rank.copy()
        rank[open_] = np.repeat(group - (group_end - edges), sizes)
        levels.append(rank)
        open_ = open_[np.repeat(sizes, sizes) > 1]
    order = places[np.argsort(rank[places])]
    shared = np.zeros(len(order), np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for at in range(len(levels) - 1, -1, -1):
        same = levels[at][np.minimum(a, n - 1)] == levels[at][np.minimum(b, n - 1)]
        step = np.where(same & (a < n) & (b < n), 1 << at, 0)
        a, b, shared[1:] = a + step, b + step, shared[1:] + step
    return order, shared


def maximal_repeats(before: np.ndarray, shared: np.ndarray, least: int) -> np.ndarray:
    """Rows (words, first rank, last rank) of the maximal repeats of ``least`` words or more.

    An interval of the suffix array that shares more words than its neighbours is a
    repeat that cannot be made longer to the right; it is maximal if the words before
    its places (``before``, by rank) are not all the same.
    """
    changes = np.cumsum(np.diff(before, prepend=before[:1]) != 0)
    lengths = np.append(np.where(shared >= least, shared, 0), 0)
    lengths[0] = 0
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []
    for at in np.flatnonzero(lengths | np.append(0, lengths[:-1])).tolist():
        length, begin = int(lengths[at]), at - 1
        while stack and stack[-1][0] > length:
            size, begin = stack.pop()
            if changes[at - 1] > changes[begin]:
                found.append((size, begin, at - 1))
        if length and (not stack or stack[-1][0] < length):
            stack.append((length, begin))
    return np.array(found, np.int64).reshape(-1, 3)


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places the spans cover."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def repetition(words: np.ndarray, sizes: np.ndarray, least: int = REPEAT) -> tuple[np.ndarray, ...]:
    """For each text: words in repeated windows, maximal repeats, words under them, words of the longest."""
    n, texts = len(words), len(sizes)
    text = np.repeat(np.arange(texts), sizes)
    none = np.zeros(texts, np.int64)
    order, shared = suffix_array(words, text) if n else (none[:0], none[:0])
    if not len(order):
        return none, none, none, none
    before = np.where(np.diff(text, prepend=-1) != 0, -1, np.roll(words, 1))[order]
    longest = np.maximum(shared, np.append(shared[1:], 0))  # of the intervals over a place
    windows, spans = longest >= WINDOW, longest >= least
    found = maximal_repeats(before, shared, least)
    most = none.copy()
    np.maximum.at(most, text[order[found[:, 1]]], found[:, 0])
    # An interval that could be longer on the left lies under the one that is.
    return (
        np.bincount(text[_covered(order[windows], np.full(int(windows.sum()), WINDOW), n)], minlength=texts),
        np.bincount(text[order[found[:, 1]]], minlength=texts),
        np.bincount(text[_covered(order[spans], longest[spans], n)], minlength=texts),
        most,
    )


class _Ids(dict):
    """Numbers of words, in the order they are first met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    return len(lines) - len(set(lines))


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_repeats", "n_covered", "longest_repeat"]


def _judged(least: int):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, at = batch.column("doc_id"), batch.column("text").to_pylist(), 0
            while at < len(texts):
                begin, numbers, ids, plain = at, _Ids(), [], []
                while at < len(texts) and len(ids) < AT_ONCE:
                    text = texts[at] or ""
                    found = _WORD.findall(text)
                    ids.extend(map(numbers.__getitem__, found))
                    plain.append((len(found), sum(map(len, found)), sum(map(text.count, _SYMBOLS)), _repeated_lines(text)))
                    at += 1
                columns = list(np.array(plain, np.int64).T)
                columns += repetition(np.array(ids, np.int64), columns[0], least)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(begin, at - begin), *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", *_COUNTS]
                )

    return judge


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = REPEAT, covered: int = COVERED, longest: int = LONGEST,
    free: int = FREE,
) -> DataFrame:
    """Counts of every text, base_failed and kept.

    Words are ``[^\\x20\\x09-\\x0D]+``. word_chars are their code points, n_symbols the
    characters ``#*$%&|<>``, n_dup_lines lines with a word that equal an earlier one,
    n_repeat_words words in windows of five that the text holds twice or more. The
    base rule fails texts of fewer than ten words or with over 20 per cent of them in
    repeated windows. The verdict of the suffix array fails those of which maximal
    repeats of ``least`` words or more cover over ``free`` words and over ``covered``
    per cent, or of which one is over ``longest`` words long. n_repeats is their number, n_covered the words
    under them, longest_repeat the words of the longest. A null text has no words and
    fails; each row is judged by itself, rows with equal or null ids too. Extra columns
    are not read, an empty table gives no rows.
    """
    counted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _judged(least), ", ".join([f"doc_id {docs.schema[id_col].dataType.simpleString()}", *[f"{c} bigint" for c in _COUNTS]])
    )
    failed = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    much = (F.col("n_covered") > free) & (100 * F.col("n_covered") > covered * F.col("n_words"))
    repeats = much | (F.col("longest_repeat") > longest)
    return counted.withColumn("base_failed", failed).withColumn("kept", ~(F.col("base_failed") | repeats))
