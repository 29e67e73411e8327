"""Pack documents into sequences of a fixed length: concatenate and cut.

All documents are one stream of tokens, each followed by a separator. The first
pass tokenises and writes every document with its place in its partition; the
totals of the partitions, one number each, are summed up in order, which gives
every document its place in the stream. The second pass cuts each document
where it crosses a multiple of the length; a document that does leaves boundary
records on both sides. Only the last sequence is not full.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from headway.sources.writing import stage

KEPT_WORDS = 300_000  # words whose ids a worker remembers, about 60 MB
_ROWS = 256  # documents cut at once
_BATCH = 1 << 20  # characters of text tokenised before the ids are handed on, beyond the last text
_GAP = re.compile(r"(?<=\S) (?=\S)")
_CODERS: dict[tuple, "WordCoder"] = {}  # of this worker process


class WordCoder:
    """Token ids of a text as little-endian 32-bit bytes, word by word.

    A byte-level BPE with GPT-2's splitting never joins anything across a space
    that has no other white space beside it, so a text is cut there and the ids
    of a piece are remembered. Texts with the string of a special token go
    through the tokenizer as a whole.
    """

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str | None = None):
        self.path, self._whole = path, None
        with open(path, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file).get("added_tokens", [])]
        self.kept: dict[str, bytes] = {}
        self.plain = None
        if ranks_path:  # the same vocabulary for a faster library
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @property
    def whole(self):
        """The tokenizer itself, read when it is first needed."""
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self.path)
        return self._whole

    def _ids(self, piece: str) -> bytes:
        ids = self.plain(piece) if self.plain else self.whole.encode(piece, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        found = self.kept.get(word)
        if found is None:
            found = self._ids(" " + word)
            if len(self.kept) < KEPT_WORDS:
                self.kept[word] = found
        return found

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(mark in text for mark in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = text.split(" ")
        get, out = self.kept.get, []
        for word in words:
            ids = get(word)
            if ids is None:
                if not word or word[0].isspace() or word[-1].isspace():  # two white spaces side by side
                    break
                ids = self._word(word)
            out.append(ids)
        else:
            out[0] = self._ids(words[0])
            return b"".join(out)
        words = _GAP.split(text)
        if len(words) == 1:
            return self._ids(text)
        return b"".join([self._ids(words[0]), *map(self._word, words[1:-1]), self._ids(" " + words[-1])])


def coder(*key) -> WordCoder:
    """One coder for each worker process, as long as it lives."""
    if key not in _CODERS:
        _CODERS[key] = WordCoder(*key)
    return _CODERS[key]


def tokenise(docs: DataFrame, tokenizer: tuple, separator: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """First pass: part, start within the part, doc_id, n and ids (with the separator)."""
    wanted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = wanted.schema["doc_id"].dataType.simpleString()
    end = np.array([separator], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, start = coder(*tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, done = batch.column("text"), 0
            while done < len(texts):
                ids, size = [], 0
                while done + len(ids) < len(texts) and size < _BATCH:
                    text = texts[done + len(ids)].as_py() or ""
                    ids.append(_narrow(words.encode(text) + end))
                    size += len(text)
                n = [len(x) // w for x, w in ids]
                starts = list(accumulate(n, initial=start))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(n), pa.int32()), pa.array(starts[:-1], pa.int64()),
                        batch.column("doc_id").slice(done, len(n)), pa.array(n, pa.int64()), pa.array([x for x, _ in ids], pa.binary()),
                    ],
                    names=["part", "local", "doc_id", "n", "ids"],
                )
                start, done = starts[-1], done + len(n)

    return wanted.mapInArrow(encode, f"part int, local bigint, doc_id {id_type}, n bigint, ids binary")


def _narrow(ids: bytes) -> tuple[bytes, int]:
    """Two bytes for each id where they suffice, and how many it are."""
    values = np.frombuffer(ids, "<u4")
    return (values.astype("<u2").tobytes(), 2) if values.max() < 65536 else (ids, 4)


def _wide(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")


def pack(
    docs: DataFrame, tokenizer: tuple, length: int = 1024, separator: int = 0,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens.

    A null or empty text is the separator alone. Ids may be null or repeated: each
    row is a document of its own. Extra columns are not read; an empty table gives
    no rows. ``tokenizer``: path of the tokenizer's file, and optionally the path
    of the same vocabulary as ranks and its splitting pattern. ``with_ids`` adds
    the ids of each piece. A piece that begins or ends inside its document is a
    boundary record.
    """
    spark = docs.sparkSession
    coded = stage(tokenise(docs, tokenizer, separator, id_col, text_col), "pack-tokens")
    totals = sorted(coded.groupBy("part").agg(F.sum("n")).collect())  # one row per partition
    before = list(accumulate((t for _, t in totals), initial=0))
    bases = spark.createDataFrame([(p, b) for (p, _), b in zip(totals, before)], "part int, base bigint")
    placed = coded.join(F.broadcast(bases), "part").select((F.col("base") + F.col("local")).alias("at"), "doc_id", "n", "ids")
    id_field = pa.field("ids", pa.list_(pa.int32()))
    id_type = placed.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, _ROWS) for b in batches for at in range(0, b.num_rows, _ROWS)):
            rows, pieces, source = [], [], []
            for i, (at, n, data) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("at", "n", "ids")))):
                ids, first = _wide(data, n), 0
                while first < n:
                    sequence, offset = divmod(at + first, length)
                    size = min(length - offset, n - first)
                    piece = ids[first : first + size]
                    rows.append((first, size, zlib.crc32(piece.tobytes()), n, sequence, offset, first > 0 or size < n))
                    source.append(i)
                    if with_ids:
                        pieces.append(piece.astype("i4"))
                    first += size
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 6 + [pa.bool_()]
            arrays = [batch.column("doc_id").take(pa.array(source, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "boundary"]
            if with_ids:
                arrays, names = [*arrays, pa.array(pieces, id_field.type)], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = (
        f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, boundary boolean"
    )
    return placed.mapInArrow(cut, schema + (", ids array<int>" if with_ids else ""))
