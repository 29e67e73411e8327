"""Near duplicates by MinHash: universal hash minima, bands, verification, components.

A text is the set of its word shingles. ``BANDS`` x ``ROWS`` universal hash
functions give its minima; texts that share all minima of a band meet in a
bucket. At a similarity of 0.8 a pair misses every bucket with a chance of 6e-7.
Equal sets are one class throughout, so copies never meet one another.

No bucket is expanded into all its pairs. First every text is compared with the
centre of its buckets that its signature is closest to; the links found give a
first round of components. What is left to decide in a bucket are pairs from
different components: the texts outside its largest component are held against
all others, in cells of bounded size, where signatures sort out most pairs, full
sets confirm the rest, and pairs linked meanwhile are passed over. So every pair
of a bucket is either linked by a path or tested, however large the bucket is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm import batches
from headway.llm.components import connected_components
from headway.sources.writing import stage

ROWS, BANDS = 5, 36
MINIMA = ROWS * BANDS
SPREADS = 5.0  # standard deviations that a signature may fall short of the threshold
LEFT, RIGHT = 256, 1024  # texts of the two sides of a cell
SENT_NODES = 1_000_000  # texts asked for by keys that every executor gets (24 MB); more are joined by shuffle
_BATCH = 1 << 20  # bytes of text hashed at once, beyond the first text

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_seeds = np.random.default_rng(20240607)
_A = (_seeds.integers(0, 1 << 63, MINIMA, dtype=np.uint64) << _U(1)) | _U(1)
_B = _seeds.integers(0, 1 << 63, MINIMA, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of a public hash)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_TABLES: dict[str, np.ndarray] = {}


def _table(name: str, base: int, n: int) -> np.ndarray:
    if len(_TABLES.get(name, ())) < n:
        values = np.full(max(n, 1 << 16), _U(base), np.uint64)
        values[0] = 1
        _TABLES[name] = np.multiply.accumulate(values)
    return _TABLES[name][:n]


def _power(n: int) -> np.ndarray:
    return _table("power", int(_PRIME), n)


def _inverse(n: int) -> np.ndarray:
    return _table("inverse", pow(int(_PRIME), -1, 1 << 64), n)


def _word_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, by sums of its bytes times powers of an odd number."""
    space = _IS_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + _U(1)) * _power(len(data)))))
    return mix((sums[ends] - sums[starts]) * _inverse(len(data))[starts] + (ends - starts).astype(np.uint64))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; see ``near_duplicates``."""
    data = np.frombuffer((text or "").encode("utf-8", "replace").translate(_LOWER), np.uint8)
    hashes = _word_hashes(data)
    width = min(words, len(hashes))
    if not width:
        return hashes
    n = len(hashes) - width + 1
    total = np.full(n, _U(width), np.uint64)
    for k in range(width):
        total = mix(total * _PRIME + hashes[k : k + n])
    return np.unique(total)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Texts x MINIMA: the smallest value of each universal hash function (multiply and add)."""
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    values, out = np.concatenate(sets), np.empty((MINIMA, len(sets)), np.uint64)
    hashed = np.empty_like(values)
    for k in range(MINIMA):
        np.multiply(values, _A[k], out=hashed)
        np.add(hashed, _B[k], out=hashed)
        out[k] = np.minimum.reduceat(hashed, starts)
    return out.T


def band_keys(lowest: np.ndarray) -> np.ndarray:
    """Texts x BANDS: one number for the minima of each band, the band's place included."""
    total = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(lowest), BANDS)).copy()
    for k in range(ROWS):
        total = mix(total * _PRIME + lowest[:, k::ROWS])
    return total


def least_agreement(percent: int) -> float:
    """Equal signature bytes that a pair at the threshold reaches but for one time in millions."""
    p = percent / 100 + (1 - percent / 100) / 256
    return MINIMA * p - SPREADS * np.sqrt(MINIMA * p * (1 - p))


def _sign(words: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, texts = batch.column("doc_id"), batch.column("mark"), batch.column("text").to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or "") < _BATCH):
                    size += len(texts[end] or "")
                    end += 1
                sets = [shingles(t, words) for t in texts[at:end]]
                full = [i for i, s in enumerate(sets) if len(s)]
                found = [[None] * len(sets) for _ in range(4)]
                if full:
                    lowest = minima([sets[i] for i in full])
                    for i, low, keys in zip(full, lowest, band_keys(lowest).view(np.int64)):
                        place = np.arange(1, len(sets[i]) + 1, dtype=np.uint64)
                        found[0][i] = int((mix(sets[i] * _PRIME + place).sum()).view(np.int64))
                        found[1][i] = int((mix(sets[i] ^ _PRIME) * place).sum().view(np.int64))
                        found[2][i] = (low >> _U(56)).astype(np.uint8).tobytes()
                        found[3][i] = keys
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, end - at), marks.slice(at, end - at), pa.array([len(s) for s in sets], pa.int64()), pa.array(found[0], pa.int64()),
                        pa.array(found[1], pa.int64()), pa.array(found[2], pa.binary()), pa.array(found[3], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "mark", "n_shingles", "k1", "k2", "sig", "bands"],
                )
                at = end

    return sign


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, MINIMA) for c in ("sig_a", "sig_b")
            )
            equal = (one == two).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(equal, pa.int32())], names=["a", "b", "equal"]
            )


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def _confirmed(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())
            good = [similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return confirm


def _forest(ids: np.ndarray, comps: np.ndarray, left: np.ndarray, sigs: np.ndarray, sets: list[bytes], percent: int, least: float) -> list[tuple]:
    """Links that join different components within a cell: a forest, at most one for each text."""
    links: list[tuple] = []
    right = np.flatnonzero(~left)
    if not left.any() or not len(right):
        return links
    two, right_comps = sigs[right], comps[right]
    sizes = np.array([len(sets[j]) // 8 for j in right])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for i in np.flatnonzero(left):
        own, comp = np.frombuffer(sets[i], np.uint64), comps[i]
        equal = (two == sigs[i]).sum(1)
        fits = (equal >= least) & (right_comps != comp)
        fits &= (100 * sizes >= percent * len(own)) & (100 * len(own) >= percent * sizes)
        for j in sorted(np.flatnonzero(fits), key=lambda j: -equal[j]):
            other = right_comps[j]
            if root(comp) != root(other) and similar(own, np.frombuffer(sets[right[j]], np.uint64), percent):
                parent[root(comp)] = root(other)
                links.append((int(ids[i]), int(ids[right[j]])))
    return links


_CELL = ["bucket", "row", "column"]


def _cells(percent: int):
    """Rows come ordered by cell; each cell is tested when its last row is there."""
    least = least_agreement(percent)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(table: pa.Table, edges: list[int]) -> pa.RecordBatch:
            ids, comps = (table.column(c).to_numpy() for c in ("node", "comp"))
            left = np.array(table.column("left").to_pylist(), bool)
            sets = table.column("shingles").to_pylist()
            sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, MINIMA)
            links = []
            for at, end in zip(edges[:-1], edges[1:]):
                links += _forest(ids[at:end], comps[at:end], left[at:end], sigs[at:end], sets[at:end], percent, least)
            a, b = zip(*links) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = pa.Table.from_batches([batch])
            held = fresh if held is None else pa.concat_tables([held, fresh])
            keys = np.stack([held.column(c).to_numpy().astype(np.int64) for c in _CELL])
            edges = (np.flatnonzero((np.diff(keys) != 0).any(0)) + 1).tolist()
            if edges:
                yield settle(held.slice(0, edges[-1]), [0, *edges])
                held = held.slice(edges[-1])
        if held is not None:
            yield settle(held, [0, held.num_rows])

    return test


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    A set holds the distinct ``words``-word shingles of the text, A-Z lower-cased,
    split at ASCII white space; with fewer words the whole sequence is one; without
    words it is empty and links with nothing. Linked are documents with 100 *
    intersection >= ``percent`` * union. component_id is the smallest id that links
    lead to, itself included. Rows with a null id are linked with nothing, have no
    component and are kept; rows with the same id count as one document with all
    their links, whatever their texts, and each comes back. Extra columns are not read; an empty table gives no rows.
    """
    with batches.small(docs.sparkSession):  # all that goes to Python is staged in it
        return _near_duplicates(docs, words, percent, id_col, text_col)


def _near_duplicates(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    rows_in = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = rows_in.withColumn("mark", F.xxhash64("text")).mapInArrow(
        _sign(words), "doc_id bigint, mark bigint, n_shingles bigint, k1 bigint, k2 bigint, sig binary, bands array<bigint>"
    )
    base = stage(signed.withColumn("row", F.monotonically_increasing_id()), "near-signed")  # numbered for good once it is written

    # Equal sets are one class, a node that is named by its first row.
    known = base.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = stage(
        known.groupBy("k1", "k2").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
        "near-classes",
    )
    member = stage(known.select("row", "k1", "k2").join(classes, ["k1", "k2"]).select("row", "rep"), "near-members")
    others = member.filter("row <> rep").select("row")
    single = stage(
        known.select(F.col("row").alias("node"), "doc_id", "mark", "sig", "bands").join(others.withColumnRenamed("row", "node"), "node", "left_anti"),
        "near-singles",
    )
    # Rows of one id are one document: links between the nodes of its rows.
    again = stage(
        base.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").drop("n"),
        "near-again",
    )
    repeated = base.select("row", "doc_id").join(again, "doc_id").select("row", "first")
    rep = member.withColumnRenamed("rep", "node")
    same = stage(
        repeated.join(rep, "row", "left").select(F.coalesce("node", "row").alias("a"), "first")
        .join(rep.withColumnRenamed("row", "first"), "first", "left").select("a", F.coalesce("node", "first").alias("b")),
        "near-ids",
    )

    # Buckets with more than one class, and their rows.
    spread = single.select("node", F.explode("bands").alias("bucket"))
    centres = stage(
        spread.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last"))
        .filter("centre < last").drop("last"),
        "near-buckets",
    )
    met = stage(spread.join(centres, "bucket"), "near-met")
    wanted = met.select("node").distinct()
    sig = stage(
        single.select("node", "doc_id", "mark", "sig").join(wanted, "node", "left_semi")
        .join(again.select("doc_id", F.lit(True).alias("several")), "doc_id", "left"),
        "near-sigs",
    )
    # A node's text is one of its first row's id and mark. Rows that are repeated give their set again.
    asked = sig.select("node", "doc_id", "mark", F.coalesce("several", F.lit(False)).alias("several"))
    few = asked.count() <= SENT_NODES
    texts = rows_in.withColumn("mark", F.xxhash64("text")).join(F.broadcast(asked) if few else asked, ["doc_id", "mark"])
    made = stage(
        texts.select("node", "several", "text").mapInArrow(_sets(words), "node bigint, several boolean, shingles binary"), "near-made"
    )
    sets = made.filter(~F.col("several")).drop("several")
    sets = stage(sets.unionByName(made.filter("several").drop("several").dropDuplicates(["node"])), "near-sets") if not again.isEmpty() else sets

    # Round 1: each text and the centre of its buckets that agrees best.
    pairs = met.filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    agreed = (
        pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
        .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
        .mapInArrow(_agreement, "a bigint, b bigint, equal int")
        .filter(F.col("equal") >= F.lit(float(least_agreement(percent))))
        .groupBy("a").agg(F.max_by("b", F.struct("equal", -F.col("b"))).alias("b"))
    )
    linked = stage(
        stage(agreed, "near-best").join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
        .mapInArrow(_confirmed(percent), "a bigint, b bigint"),
        "near-links",
    )
    linked = linked.unionByName(same)
    first = stage(connected_components(linked), "near-first")

    # Round 2: pairs of different components in a bucket.
    held = stage(
        met.select("bucket", "node").join(first, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("comp")),
        "near-held",
    )
    parts = held.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    open_buckets = stage(
        parts.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("main")
        ).filter("parts > 1").select(
            "bucket", F.col("main.comp").alias("main"),
            F.ceil((F.col("n") - F.col("main.n")) / LEFT).cast("int").alias("lefts"), F.ceil(F.col("n") / RIGHT).cast("int").alias("rights"),
        ),
        "near-open",
    )
    undecided = held.join(open_buckets, "bucket")
    block = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    cells = undecided.filter(F.col("comp") != F.col("main")).select(
        "bucket", "node", "comp", F.lit(True).alias("left"), block(1, "lefts").alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("column"),
    ).unionByName(undecided.select(
        "bucket", "node", "comp", F.lit(False).alias("left"),
        F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("row"), block(2, "rights").alias("column"),
    ))
    more = stage(
        cells.join(stage(sets.join(sig.select("node", "sig"), "node"), "near-full"), "node")
        .repartition(*_CELL).sortWithinPartitions(*_CELL).select(*_CELL, "node", "comp", "left", "sig", "shingles")
        .mapInArrow(_cells(percent), "a bigint, b bigint"),
        "near-more",
    )
    joined = stage(connected_components(linked.unionByName(more)), "near-components")

    placed = stage(
        base.select("row", "doc_id", "n_shingles").join(member, "row", "left").withColumn("node", F.coalesce("rep", "row"))
        .join(joined, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component")),
        "near-placed",
    )
    linked_rows = placed.filter(F.col("component").isNotNull())
    least = linked_rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return (
        linked_rows.join(least, "component").select("doc_id", "n_shingles", "component_id")
        .unionByName(placed.filter(F.col("component").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _sets(words: int):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("several"), pa.array(sets, pa.binary())], names=["node", "several", "shingles"]
            )

    return compute
