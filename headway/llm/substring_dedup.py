"""Remove every byte string of 200 bytes that also starts anywhere else.

Which windows can meet: each 200-byte window has an anchor, the 50-byte gram in it
with the smallest hash (the leftmost of equal ones). Equal windows have equal
anchors at the same place in them, so only windows with the same anchor need to
meet. Windows next to each other with one anchor form a record: some 75 starts in
275 bytes, two records for 150 bytes of text, which are shuffled as hashes. Where
a text repeats itself after p bytes, up to 151, a record has p starts and equals
the next one; such a run is one row with the number of its records, so few bytes
said over and over make no more rows than other text.

1. Anchors that occur once are dropped: nothing else can equal their windows.
2. Equal records (same anchor, same bytes) settle each other whole.
3. What is left are anchors with different records: ends of passages, edits in
   copies. Their bytes are fetched and the suffixes at all starts sorted. A
   mergesort compares two suffixes by their common extension, found by binary
   search over prefix polynomial hashes in eight steps; neighbours that agree on
   200 bytes are verified byte by byte.
4. More different records of one anchor than are sorted in one place are halved:
   by the place of the anchor in their windows, into slices with half the
   windows, which meet by the bytes that all these windows share. Slices that
   meet no other go, equal ones are settled whole by their bytes and go on as
   one, small groups are sorted, and the rest is halved again, eight times at
   most: then a slice is a window.

Every step groups by hashes with counts first, so a passage in a third of all
documents does not meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.near_dedup import _inverse, _power, mix
from headway.sources.writing import stage

LENGTH, GRAM = 200, 50
WIDE = LENGTH - GRAM + 1  # grams of a window
PIECE = 1 << 19  # windows looked at at once: a long text takes no more memory
SORTED = 512  # different records that are sorted in one place; more are halved first
AT_ONCE = 2048  # records sorted together, beyond the last group

_U = np.uint64
_LOW = _U((1 << 20) - 1)


def _sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the bytes times powers of an odd number, modulo 2^64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * _power(len(data)), out=out[1:])
    return out


def _hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of bytes from start to end, wherever they stand."""
    return (sums[ends] - sums[starts]) * _inverse(len(sums))[starts]


def records(data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows with one anchor: hash of the anchor and of the bytes, start, windows, place of the anchor, times.

    Equal records that follow each other are one, with their number.
    """
    for at in range(0, max(0, len(data) - LENGTH + 1), PIECE):
        piece = data[at : at + PIECE + LENGTH - 1]
        windows = len(piece) - LENGTH + 1
        sums = _sums(piece)
        grams = np.arange(len(piece) - GRAM + 1)
        hashed = mix(_hash(sums, grams, grams + GRAM))
        # Hash above, place below: the minimum is the smallest hash, of equal ones the leftmost.
        least = (hashed & ~_LOW) | grams.astype(np.uint64)
        width = 1
        while width * 2 <= WIDE:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < WIDE:
            least = np.minimum(least[: len(least) - (WIDE - width)], least[WIDE - width :])
        anchors = (least & _LOW).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(anchors)) + 1))
        count = np.diff(np.concatenate((first, [windows])))
        anchor = anchors[first]
        whole = mix(_hash(sums, first, first + count + LENGTH - 1) + _U(31) * (anchor - first).astype(np.uint64))
        found = (hashed[anchor].view(np.int64), whole.view(np.int64), count, anchor - first)
        new = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in found], axis=0)))
        times = np.diff(np.concatenate((np.flatnonzero(new), [len(new)])))
        gram, whole, count, off = (c[new] for c in found)
        yield gram, whole, first[new] + at, count, off, times


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts: list[tuple] = []
        size = 0
        for key, mark, text in zip(*(batch.column(c).to_pylist() for c in ("id", "mark", "text"))):
            raw = _bytes(text)
            if len(raw) < LENGTH:
                continue
            for found in records(np.frombuffer(raw, np.uint8)):
                parts.append((np.full(len(found[0]), key), np.full(len(found[0]), mark), *found))
                size += len(found[0])
            if size > 200_000:
                yield _batch(parts)
                parts, size = [], 0
        if parts:
            yield _batch(parts)


def _batch(parts: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)], names=["id", "mark", "mh", "rh", "start", "n", "off", "times"]
    )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the records asked for."""
    names = ["mh", "k", "id", "mark", "at", "lo", "hi"]
    for batch in batches:
        rows: list[list] = [[] for _ in range(8)]
        for key, mark, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("id", "mark", "text", "wanted"))):
            raw = _bytes(text)
            for w in wanted:
                data = raw[w["start"] : w["start"] + w["n"] + LENGTH - 1]
                for column, value in zip(rows, (w["mh"], w["k"], key, mark, w["start"], w["off"] - w["n"] + 1, w["off"], data)):
                    column.append(value)
        kinds = [*[pa.int64()] * 7, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=[*names, "data"])


def common_extension(sums: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common beginning of suffixes, up to ``limit``, by binary search over hashes."""
    low, step = np.zeros(len(a), np.int64), 1 << (limit.bit_length() - 1)
    while step:
        longer = low + step
        fits = longer <= limit
        longer = np.where(fits, longer, low)
        same = _hash(sums, a, a + longer) == _hash(sums, b, b + longer)
        low = np.where(fits & same, longer, low)
        step >>= 1
    return low


def suffix_sort(data: np.ndarray, sums: np.ndarray, starts: np.ndarray, group: np.ndarray, limit: int) -> np.ndarray:
    """Order of suffixes by group and by their first ``limit`` bytes.

    A mergesort from runs of one: each suffix finds its place in the run beside
    its own by binary search, all of them at once. Runs lie within groups, which
    have to be in order.
    """
    n = len(starts)
    order = np.arange(n)
    edges = np.flatnonzero(np.diff(group)) + 1
    first = np.repeat(np.concatenate(([0], edges)), np.diff(np.concatenate(([0], edges, [n]))))
    last = np.repeat(np.concatenate((edges, [n])), np.diff(np.concatenate(([0], edges, [n]))))
    most, run, place = int((last - first).max()) if n else 0, 1, np.arange(n)
    while run < most:
        within = place - first
        mine = first + within // run * run
        odd = (within // run) % 2 == 1
        other = np.where(odd, mine - run, mine + run)
        low, high = np.minimum(other, last), np.minimum(other + run, last)
        begin = low.copy()
        while (open_ := low < high).any():
            at = np.flatnonzero(open_)
            middle = (low[at] + high[at]) // 2
            a, b = starts[order[at]], starts[order[middle]]
            shared = common_extension(sums, a, b, limit)
            whole = shared >= limit
            step = np.where(whole, 0, shared)
            # Suffixes of the right run go behind equal ones of the left run.
            before = np.where(whole, odd[at], data[b + step] < data[a + step])
            low[at] = np.where(before, middle + 1, low[at])
            high[at] = np.where(before, high[at], middle)
        target = np.where(odd, mine - run, mine) + (place - mine) + (low - begin)
        merged = np.empty_like(order)
        merged[target] = order
        order, run = merged, run * 2
    return order


def repeated_windows(slices: list[bytes], anchors: np.ndarray, offs: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """For each slice, which of its windows equal one of another slice with the same anchor."""
    data = np.frombuffer(b"".join(slices), np.uint8)
    sums = _sums(data)
    begins = np.concatenate(([0], np.cumsum([len(s) for s in slices])[:-1])).astype(np.int64)
    owner = np.repeat(np.arange(len(slices)), counts)
    window = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begins[owner] + window
    # Equal windows have the anchor at the same place.
    _, anchor = np.unique(anchors, return_inverse=True)
    group = anchor[owner] * (2 * LENGTH) + (offs[owner] - window) + LENGTH
    by_group = np.argsort(group, kind="stable")
    starts, owner, window, group = starts[by_group], owner[by_group], window[by_group], group[by_group]
    _, inverse, sizes = np.unique(group, return_inverse=True, return_counts=True)
    some = sizes[inverse] > 1
    starts, owner, window, group = starts[some], owner[some], window[some], group[some]
    found = [np.zeros(c, bool) for c in counts]
    if not len(starts):
        return found
    order = suffix_sort(data, sums, starts, group, LENGTH)
    left, right = order[:-1], order[1:]
    equal = group[left] == group[right]
    equal[equal] = common_extension(sums, starts[left[equal]], starts[right[equal]], LENGTH) >= LENGTH
    for i in np.flatnonzero(equal):  # hashes agree: now the bytes
        a, b = starts[left[i]], starts[right[i]]
        equal[i] = data[a : a + LENGTH].tobytes() == data[b : b + LENGTH].tobytes()
    hit = np.zeros(len(starts), bool)
    hit[left[equal]] = hit[right[equal]] = True
    for o, w in zip(owner[hit], window[hit]):
        found[o][w] = True
    return found


def _span_rows(keys: list[tuple], found: list[np.ndarray]) -> pa.RecordBatch:
    rows = []
    for (key, mark, start), hits in zip(keys, found):
        edge = np.flatnonzero(np.diff(np.concatenate(([0], hits.astype(np.int8), [0]))))
        rows += [(key, mark, start + int(a), start + int(b) + LENGTH - 1) for a, b in zip(edge[::2], edge[1::2])]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 4)], names=["id", "mark", "a", "b"])


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices come ordered by group; whole groups are sorted together."""
    held: list[tuple] = []

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        group, key, mark, at, lo, hi, data = zip(*rows)
        found = repeated_windows(list(data), np.array(group), np.array(hi), np.array(hi) - np.array(lo) + 1)
        return _span_rows(list(zip(key, mark, at)), found)

    for batch in batches:
        held += zip(*(batch.column(c).to_pylist() for c in ("g", "id", "mark", "at", "lo", "hi", "data")))
        while len(held) > AT_ONCE:
            end = AT_ONCE
            while end < len(held) and held[end][0] == held[end - 1][0]:
                end += 1
            if end == len(held):
                break
            yield settle(held[:end])
            held = held[end:]
    if held:
        yield settle(held)


def _halved(slices: DataFrame) -> DataFrame:
    """Each slice as two, by the place of the anchor in its windows, named by the bytes shared by all windows of a half."""
    middle = F.expr("(p + q) div 2")
    halves = F.array(
        F.struct(F.col("p").alias("p"), middle.alias("q")), F.struct((middle + 1).alias("p"), F.col("q").alias("q"))
    )
    low, high = F.greatest("lo", "half.p"), F.least("hi", "half.q")
    return (
        slices.withColumn("half", F.explode(halves)).withColumns({"low": low, "high": high}).filter("low <= high")
        .selectExpr(
            "mh", "half.p AS p", "half.q AS q", "id", "mark", "at + hi - high AS at", "low AS lo", "high AS hi",
            f"substring(data, cast(hi - high + 1 AS int), cast(high - low + {LENGTH} AS int)) AS data",
        )
        # A clash of names does no harm: it only brings slices together whose bytes differ.
        .withColumn("g", F.expr(f"xxhash64(mh, p, q, substring(data, cast(hi - p + 1 AS int), cast({LENGTH} + p - q AS int)))"))
    )


def _by_slices(pieces: DataFrame) -> DataFrame:
    """Spans of the windows of different records that equal one of another record.

    ``pieces`` has one row for each different record of an anchor: the anchor, their
    number ``k``, the first place ``at`` in the text, the least and largest place of
    the anchor in its windows (``lo``, ``hi``) and the bytes.
    """
    kind = ["g", "mh", "p", "q", "lo", "hi", "data"]
    groups = [pieces.withColumns({"g": F.col("mh"), "p": F.lit(0).cast("bigint"), "q": F.lit(WIDE - 1).cast("bigint")})]
    halved, classes = [], []
    for _ in range((WIDE - 1).bit_length()):
        large = groups[-1].filter(F.col("k") > SORTED)
        if large.isEmpty():
            break
        halved.append(stage(_halved(large), "string-halves"))
        classes.append(
            stage(
                halved[-1].groupBy(*kind).agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("id", "mark", "at")).alias("one")),
                "string-slices",
            )
        )
        met = classes[-1].groupBy("g").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
        groups.append(stage(classes[-1].join(met, "g").select(*kind, "k", "one.*"), "string-groups"))
    small = [g.filter(F.col("k") <= SORTED).select("g", "id", "mark", "at", "lo", "hi", "data") for g in groups]
    found = reduce(DataFrame.unionByName, small).repartition("g").sortWithinPartitions("g").mapInArrow(
        _sorted_groups, "id bigint, mark bigint, a bigint, b bigint"
    )
    if not halved:
        return found
    repeated = reduce(DataFrame.unionByName, classes).filter("c > 1").select(*kind)
    settled = reduce(DataFrame.unionByName, halved).join(repeated, kind, "left_semi")
    return found.unionByName(settled.selectExpr("id", "mark", "at AS a", f"at + hi - lo + {LENGTH} AS b"))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it that make it new to the table."""
    while name in df.columns:
        name = f"_{name}"
    return name


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple:
    """Id, text and mark: rows of one key have one text. Without an id another hash of the text stands for it."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.coalesce(F.col(id_col).cast("bigint"), F.xxhash64(F.lit("text"), text)), text, F.xxhash64(text)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, mark and the byte ranges from a to b (they may overlap) that are repeated."""
    key, text, mark = _keyed(docs, id_col, text_col)
    texts = docs.select(key.alias("id"), mark.alias("mark"), text.alias("text"))
    found_in = lambda: texts.mapInArrow(
        _records, "id bigint, mark bigint, mh bigint, rh bigint, start bigint, n bigint, off bigint, times bigint"
    )
    repeated = stage(found_in().groupBy("mh").agg(F.sum("times").alias("c")).filter("c > 1").select("mh"), "string-anchors")
    met = stage(found_in().join(repeated, "mh"), "string-records")
    classes = stage(
        met.groupBy("mh", "rh").agg(F.sum("times").alias("c"), F.min(F.struct("id", "mark", "start", "n", "off")).alias("one")),
        "string-classes",
    )
    several = stage(classes.groupBy("mh").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "string-several")
    end = F.col("start") + F.col("n") * F.col("times") + (LENGTH - 1)  # of a run: it has no gaps
    settled = met.join(classes.filter("c > 1").select("mh", "rh"), ["mh", "rh"]).select("id", "mark", F.col("start").alias("a"), end.alias("b"))
    # One record of each class stands for it; what is found of one that stands for others is known already.
    wanted = (
        classes.join(several, "mh")
        .select("one.id", "one.mark", F.struct("mh", "k", "one.start", "one.n", "one.off").alias("w"))
        .groupBy("id", "mark").agg(F.collect_list("w").alias("wanted"))
    )
    pieces = stage(
        texts.join(wanted, ["id", "mark"]).mapInArrow(
            _slices, "mh bigint, k bigint, id bigint, mark bigint, at bigint, lo bigint, hi bigint, data binary"
        ).dropDuplicates(["mh", "id", "mark", "at"]),
        "string-pieces",
    )
    return settled.unionByName(_by_slices(pieces))


def _cut(names: list[str], text_col: str, spans_col: str, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text, spans in zip(batch.column(text_col).to_pylist(), batch.column(spans_col).to_pylist()):
                raw, kept, at, removed, runs, end = _bytes(text), [], 0, 0, 0, -1
                for s in sorted((s["a"], s["b"]) for s in spans or ()):
                    a, b = s[0], s[1]
                    if a > end:
                        kept.append(raw[at:a])
                        runs += 1
                        removed += b - a
                        at = end = b
                    elif b > end:
                        removed += b - end
                        at = end = b
                kept.append(raw[at:])
                rest = b"".join(kept)
                values = (len(raw), removed, runs, hashlib.sha256(rest).hexdigest())
                for column, value in zip(out, (*values, b"".join(kept).decode("utf-8", "ignore") if with_text else None)):
                    column.append(value)
            if with_text:
                columns = [pa.array(out[4], pa.string()) if n == text_col else batch.column(n) for n in names]
                emptied = [removed > 0 and not text for removed, text in zip(out[1], out[4])]
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array([not e for e in emptied], pa.bool_()))
                continue
            arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *arrays], names=[*names, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return cut


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """n_bytes, n_removed, n_spans and kept_sha256 of every row beside its id, or (``with_text``) what is kept of the table.

    Removed is each byte covered by a 200-byte string that also starts anywhere
    else in the table, in the same text too; strings are judged on the input. The
    text is UTF-8; a null one is empty. ``with_text`` gives the columns of the input,
    the text being what remains without the parts of characters that a cut leaves;
    rows of which nothing remains are left out, rows without text stay. Rows with the same id and
    text are copies of each other like any others; null ids are ids like any other.
    An empty table gives no rows.
    """
    spans = (
        repeated_spans(docs, id_col, text_col).groupBy("id", "mark").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    )
    if with_text:
        kept, names, key, mark = docs, docs.columns, _keyed(docs, id_col, text_col)[0], _keyed(docs, id_col, text_col)[2]
    else:
        kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        names, text_col = ["doc_id"], "text"
        key, _, mark = _keyed(kept, "doc_id", "text")
    own = {n: free_name(docs, n) for n in ("id", "mark", "spans")}
    joined = kept.withColumns({own["id"]: key, own["mark"]: mark}).join(
        spans.select(*[F.col(n).alias(o) for n, o in own.items()]), [own["id"], own["mark"]], "left"
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name in names)
    added = "" if with_text else ", n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return joined.select(*[f"`{n}`" for n in dict.fromkeys([*names, text_col])], own["spans"]).mapInArrow(
        _cut(names, text_col, own["spans"], with_text), fields + added
    )
