"""Spelling variants: words one edit apart, found by dense prefix-suffix tiles.

Two words are one inserted, deleted or replaced code point apart just when their
common prefix and common suffix together reach the longer length minus one. Blocks
of words are laid out as padded matrices of code points, once from the left and once
from the right, and held against each other column by column.

Which blocks meet: the edit lies in one third of the longer word's places, and what
is around that third is equal in both. So a word is put under its surroundings for
each third and for both longer lengths that it can have with a partner, and only
words under one key are compared. A pair counts where its common prefix ends, which
is in one third only, so it counts once. A key with many words is cut into blocks
and its block pairs are dealt out as tiles; a tile gives back one row for each word
(partners, best partner), never its pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from headway.sources.writing import stage

PARTS = 3  # a word's places are cut into so many, one of which holds the edit
BLOCK = 64  # words of a block
CELLS = 1 << 18  # code points laid out at once, beyond the first tile
COUNTED = 200_000  # different words that a worker counts before it hands them on
SHORTEST, LEAST, MARGIN, DROPS = 6, 5, 5, 199

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def misspelt(run: str, start: int, drops: int) -> str:
    """The run, without one code point if ``drops`` divides its checksum."""
    mark = zlib.crc32(run.encode(), start)
    if mark % drops:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1 :]


def _counted(shortest: int, drops: int):
    pattern = re.compile(rf"{RUN.pattern[:-1]}{{{shortest},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[str] = Counter()

        def hand_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], names=["word", "n"]
            )
            totals.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                start = zlib.crc32(f"{key}:".encode())
                lowered = text.encode("utf-8", "replace").translate(_LOWER).decode()
                for run, n in Counter(pattern.findall(lowered)).items():
                    word = misspelt(run, start, drops)
                    if len(word) >= shortest:
                        totals[word] += n
                if len(totals) >= COUNTED:
                    yield hand_on()
        if totals:
            yield hand_on()

    return count


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, least: int = LEAST, drops: int = DROPS
) -> DataFrame:
    """``word`` and ``n`` of the words that are long and frequent enough.

    Runs shorter than ``shortest`` are no words whatever is deleted from them.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.col(text_col).cast("string").alias("text")
    ).filter(F.col("text").isNotNull())
    return (
        rows.mapInArrow(_counted(shortest, drops), "word string, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    )


def _cut(length: Column, part: int) -> Column:
    return F.floor(length * part / PARTS).cast("int")


def surroundings(words: DataFrame) -> DataFrame:
    """Each word under its keys: (longer length, part with the edit, hash of what is around it)."""
    own = F.char_length("word")
    keys = []
    for longer in (own, own + 1):
        for part in range(PARTS):
            before, after = _cut(longer, part), longer - _cut(longer, part + 1)
            around = F.xxhash64(F.substring(F.col("word"), F.lit(1), before), F.right(F.col("word"), after), longer)
            keys.append(F.struct(longer.alias("longer"), F.lit(part).alias("part"), around.alias("around")))
    return words.select("word", "n", F.inline(F.array(*keys)))


_KEY = ["longer", "part", "around"]
_TILE = [*_KEY, "row", "column"]


def tiles(keyed: DataFrame) -> DataFrame:
    """Words with the tiles they are compared in; words alone under a key are in none."""
    sizes = keyed.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = keyed.join(sizes, _KEY).withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("word"), blocks).cast("int")})
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.select(
        *_KEY, F.least("block", "other").alias("row"), F.greatest("block", "other").alias("column"), "block", "word", "n"
    )


def single_edits(left: np.ndarray, right: np.ndarray, lengths: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks x words x words: which words are one edit apart, and their common prefixes.

    ``left`` and ``right`` hold the words of each block as code points, padded behind
    and in front. Block b is compared with block b + ``shift``.
    """
    n = len(left) - shift
    one, two = lengths[:n, :, None], lengths[shift:, None, :]
    longer, shorter = np.maximum(one, two), np.minimum(one, two)
    common = []
    for cells, columns in ((left, range(left.shape[2])), (right, range(right.shape[2] - 1, -1, -1))):
        total = np.zeros(longer.shape, np.int32)
        alive = np.ones(longer.shape, bool)
        for k in columns:
            alive &= cells[:n, :, None, k] == cells[shift:, None, :, k]
            if not alive.any():
                break
            total += alive
        common.append(np.minimum(total, shorter))  # padding is equal to padding
    return common[0] + common[1] >= longer - 1, common[0]


def _matrix(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in words], np.int32)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left, right = (np.zeros((len(words), width), np.uint32) for _ in range(2))
    left[row, column] = codes
    right[row, column + (width - lengths)[row]] = codes
    return left, right, lengths


def compare_tiles(words: list[str], n: np.ndarray, tile: np.ndarray, block: np.ndarray, longer: np.ndarray, part: np.ndarray) -> tuple:
    """Rows (given tile by tile) with partners: their number, and the best partner's row."""
    count = -(-len(words) // BLOCK)
    width = max(map(len, words))
    left, right, lengths = _matrix([*words, *[""] * (count * BLOCK - len(words))], width)
    pad = lambda x, v: np.concatenate((x, np.full(count * BLOCK - len(x), v, x.dtype))).reshape(count, BLOCK)
    tile_of, block_of, longer_of, part_of = pad(tile, -1), pad(block, 0), pad(longer, 0), pad(part, 0)
    first, last = np.unique(tile, return_index=True)[1], len(tile) - 1 - np.unique(tile[::-1], return_index=True)[1]
    split = _tile_is_split(tile, block)
    split_of = pad(split, False)
    shape = (count, BLOCK, width)
    left, right, lengths = left.reshape(shape), right.reshape(shape), lengths.reshape(count, BLOCK)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for shift in range(int((last // BLOCK - first // BLOCK).max()) + 1):
        m = count - shift
        near, prefix = single_edits(left, right, lengths, shift)
        near &= (tile_of[:m, :, None] == tile_of[shift:, None, :]) & (tile_of[:m, :, None] >= 0)
        # In a tile of two blocks the words of each are compared with those of the other.
        near &= ~split_of[:m, :, None] | (block_of[:m, :, None] != block_of[shift:, None, :])
        at, where = longer_of[:m, :, None], part_of[:m, :, None]
        near &= np.maximum(lengths[:m, :, None], lengths[shift:, None, :]) == at
        near &= (prefix >= at * where // PARTS) & (prefix < at * (where + 1) // PARTS)
        if not shift:
            near &= np.triu(np.ones((BLOCK, BLOCK), bool), 1)
        b, i, j = np.nonzero(near)
        pairs.append((b * BLOCK + i, (b + shift) * BLOCK + j))
    a, b = (np.concatenate(side) for side in zip(*pairs))
    one, two = np.concatenate((a, b)), np.concatenate((b, a))
    if not len(one):
        return one, one, one
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[two], -n[two], one))
    one, two = one[order], two[order]
    rows, begins, partners = np.unique(one, return_index=True, return_counts=True)
    return rows, partners, two[begins]


def _tile_is_split(tile: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Whether a row's tile holds words of two blocks."""
    begins = np.flatnonzero(np.diff(tile, prepend=tile[0] - 1))
    low, high = np.minimum.reduceat(block, begins), np.maximum.reduceat(block, begins)
    return np.repeat(low < high, np.diff(np.append(begins, len(tile))))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by tile; whole tiles are compared together."""

    def settle(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
        words = table.column("word").to_pylist()
        n, block, longer, part = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "block", "longer", "part"))
        rows, partners, best = compare_tiles(words, n, np.repeat(np.arange(len(edges) - 1), np.diff(edges)), block, longer, part)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in rows], pa.string()), pa.array(partners, pa.int64()),
                pa.array(n[best], pa.int64()), pa.array([words[i] for i in best], pa.string()),
            ],
            names=["word", "near", "best_n", "best"],
        )

    def settled(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(w) for w in table.column("word").to_pylist()])
        at = 0
        while at < len(edges) - 1:
            end, width = at, 0
            while end < len(edges) - 1:
                width = max(width, int(lengths[edges[end] : edges[end + 1]].max()))
                if end > at and (edges[end + 1] - edges[at]) * width > CELLS:
                    break
                end += 1
            part = edges[at : end + 1]
            yield settle(table.slice(part[0], part[-1] - part[0]), part - part[0])
            at = end

    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        fresh = pa.Table.from_batches([batch])
        held = fresh if held is None else pa.concat_tables([held, fresh])
        keys = np.stack([held.column(c).to_numpy().astype(np.int64) for c in _TILE])
        edges = np.flatnonzero((np.diff(keys) != 0).any(0)) + 1
        if len(edges):
            yield from settled(held.slice(0, edges[-1]), np.append(0, edges))
            held = held.slice(edges[-1])
    if held is not None:
        yield from settled(held, np.array([0, held.num_rows]))


def roots(links: DataFrame) -> DataFrame:
    """``word`` and ``root``: where following ``form`` from a word ends.

    Every round doubles the way that is jumped. A form is MARGIN times as frequent as
    its word, so ways are short and never closed.
    """
    now = stage(links.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = stage(now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"), "spelling-links")
        if longer.filter(F.col("further").isNotNull()).isEmpty():
            return longer.select("word", "root")
        now = longer.select("word", "root")


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, least: int = LEAST,
    margin: int = MARGIN, drops: int = DROPS,
) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of the texts.

    Words are the maximal runs of Latin letters (A to Z, a to z, U+00C0 to U+00FF),
    A-Z lower-cased, of ``shortest`` code points and ``least`` occurrences at least.
    A run loses the code point at its checksum modulo its length where ``drops``
    divides the checksum of id and run; a null id counts as an empty one there, a
    null text has no words. Near words are exactly one edit apart; the form is the
    near word of largest n, of equal ones the smallest in code-point order, if its n
    is ``margin`` times the word's. The root is where forms lead. Repeated rows count
    again, extra columns are not read, and an empty table gives no rows.
    """
    words = stage(word_counts(docs, id_col, text_col, shortest, least, drops), "spelling-words")
    keyed = stage(surroundings(words), "spelling-keys")
    found = (
        tiles(keyed).repartition(*_TILE).sortWithinPartitions(*_TILE)
        .mapInArrow(_compared, "word string, near bigint, best_n bigint, best string")
        .groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top"))
    )
    enough = -F.col("top.less") >= margin * F.col("n")
    judged = stage(
        words.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("top.best")).alias("form"), F.when(enough, -F.col("top.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(judged.filter(F.col("form").isNotNull()))
    return judged.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
