"""Quality scores by nearest-neighbour voting in a latent semantic space.

Whole texts become counts of hashed byte trigrams, damped, weighted by rarity and
projected onto the main directions of a bounded labelled sample. The sample's
vectors (at most ``SAMPLE`` for each label, of ``LATENT`` numbers) are broadcast;
every document gets the exact cosines with all of them in blocks, and the votes
of the nearest ones are weighted by their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.sources.writing import stage

FEATURES = 4096
LATENT = 64
SAMPLE = 1500  # labelled texts of each label that the model is fitted on, at most
NEIGHBOURS = 15
SHARPNESS = 4  # a vote weighs the similarity to this power
REPEATS = 2.0  # weight of the share of repeated words beside trigrams of length 1
BLOCK = 256  # documents whose cosines are computed at once
_PIECE = 1 << 20  # bytes hashed at once: a long text takes no more memory than this


def features(text: str | None) -> np.ndarray:
    """Counts of the hashed byte trigrams of the whole text; last, how many in 1000 words repeat the one before."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(FEATURES + 1, np.int64)
    for at in range(0, max(0, len(data) - 2), _PIECE):
        b = data[at : at + _PIECE + 2].astype(np.uint32)
        code = (b[:-2] * np.uint32(65537) + b[1:-1] * np.uint32(257) + b[2:]) * np.uint32(2654435761)
        counts[:-1] += np.bincount(code >> np.uint32(20), minlength=FEATURES)
    words = text.split()
    counts[-1] = 1000 * sum(map(eq, words, islice(words, 1, None))) // max(1, len(words))
    return counts


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _rows(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Weighted trigrams at length 1, and the share of repeated words beside them."""
    out = np.empty(counts.shape, np.float32)
    for at in range(0, len(counts), BLOCK):  # no second copy of a large table
        part = counts[at : at + BLOCK]
        out[at : at + BLOCK, :-1] = _unit(np.log1p(part[:, :-1], dtype=np.float32) * rarity)
        out[at : at + BLOCK, -1] = part[:, -1] * np.float32(REPEATS / 1000)
    return out


@dataclass
class Model:
    rarity: np.ndarray  # of each feature
    directions: np.ndarray  # features x latent
    vectors: np.ndarray  # sample x latent, of length 1
    labels: np.ndarray  # 0 or 1
    prior: float

    def place(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_rows(counts, self.rarity) @ self.directions)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of the similarity-weighted votes for label 1; the prior where nothing is similar."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        near = self.place(counts) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weights = np.clip(np.take_along_axis(near, best, 1), 0, 1).astype(np.float64) ** SHARPNESS
        total = weights.sum(1)
        votes = (weights * self.labels[best]).sum(1)
        return np.clip(np.where(total > 0, votes / np.where(total > 0, total, 1), self.prior), 0, 1)


def fit_arrays(counts: np.ndarray, labels: np.ndarray) -> Model:
    """Rarity, main directions (subspace iteration from a fixed start) and the sample's vectors."""
    n = len(labels)
    rarity = np.log((1 + n) / (1 + (counts[:, :-1] > 0).sum(0))).astype(np.float32) + 1
    model = Model(rarity, np.eye(FEATURES + 1, LATENT, dtype=np.float32), np.zeros((0, LATENT), np.float32), labels, 0.5)
    if n:
        rows = _rows(counts, rarity)
        basis = np.random.default_rng(7).standard_normal((FEATURES + 1, LATENT + 16)).astype(np.float32)
        for _ in range(4):
            basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
        _, _, turned = np.linalg.svd(rows @ basis, full_matrices=False)
        model.directions = np.ascontiguousarray((basis @ turned.T)[:, :LATENT], dtype=np.float32)
        model.vectors, model.prior = model.place(counts), float(labels.mean())
    return model


def held_out(id_col: str = "doc_id"):
    """Rows kept out of the fit: crc32 of the id as text is a multiple of five."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on labelled texts that are not held out, up to SAMPLE of each label.

    Which ones is decided by a hash of the text; a repeated text counts once, with the
    label of its smallest id. Labels that are null or neither 0 nor 1 are left out; of
    several labels for an id the mean decides. Ids, labels and hashes are staged first,
    then the chosen texts are fetched: only features of the sample reach the driver,
    one row for each of at most 2 * SAMPLE texts.
    """
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("double").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0.0, 1.0))
        .groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    texts = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        .filter(F.col("id").isNotNull() & F.col("text").isNotNull() & ~held_out("id"))
        .withColumn("place", F.pmod(F.xxhash64("text"), F.lit(1 << 40)))
    )
    places = stage(
        texts.select("id", "place").join(known, "id").groupBy("place").agg(F.min(F.struct("id", "label")).alias("one"))
        .select("place", "one.id", "one.label"),
        "quality-places",
    )
    chosen = []
    for value, n in sorted((r[0], r[1]) for r in places.groupBy("label").count().collect()):
        # Somewhat more than is wanted, by the hash; then the first SAMPLE of them.
        some = places.filter((F.col("label") == value) & (F.col("place") < F.lit(int((1 << 40) * min(1.0, 1.3 * SAMPLE / n)))))
        chosen += [(r["id"], r["place"], value) for r in some.orderBy("place").limit(SAMPLE).collect()]
    asked = docs.sparkSession.createDataFrame([c[:2] for c in chosen], places.select("id", "place").schema)
    fetched = texts.join(F.broadcast(asked), ["id", "place"]).select("place", "text").dropDuplicates(["place"])
    found = {r["place"]: np.frombuffer(r["counts"], "<u2") for r in fetched.mapInArrow(_counted, "place bigint, counts binary").collect()}
    counts = np.array([found[p] for _, p, _ in chosen], np.uint16).reshape(-1, FEATURES + 1)
    return fit_arrays(counts, np.array([v for *_, v in chosen], np.float64))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [np.minimum(features(t), 65535).astype("<u2").tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("place"), pa.array(counts, pa.binary())], names=["place", "counts"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep_as: str | None = None) -> DataFrame:
    """doc_id and score of every row, or all columns of the input and the score under the name ``keep_as``.

    A null or empty text, or one of fewer than three bytes, gets the prior. Ids may
    be null or repeated: the text alone decides. An empty table gives no rows.
    """
    if keep_as in docs.columns:
        raise ValueError(f"the table has a column {keep_as!r} already")
    wanted = docs if keep_as else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    text_at, out = (text_col, keep_as) if keep_as else ("text", "score")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2 * SAMPLE vectors and the directions at most
    names = wanted.columns if keep_as else ["doc_id"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                counts = np.array([features(t) for t in part.column(text_at).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(fitted.score(counts), pa.float64())], names=[*names, out]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields if f.name in names)
    return wanted.mapInArrow(judge, f"{fields}, `{out}` double")
