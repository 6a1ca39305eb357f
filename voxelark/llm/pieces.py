"""SentencePiece encoding and decoding by a table of distinct chunks.

When no piece of a model holds a space marker after another character, merges
never cross from a word into the marker before the next one. A text is then a
sequence of marked words (one or more markers and what follows up to the next
marker) that can be segmented on their own. Each task keeps a table of the
distinct marked words it has met, lets the library segment each of them once, and
joins ids and decoded strings back by position with array lookups.

The table of a task is bounded (TABLE_WORDS); on reaching the bound it is started
anew, which costs repeated segmentation and changes nothing in the result.
Nothing is shuffled: rows stay in the partition they were read in.

Null and empty texts give no ids and an empty decoded text. Repeated rows give
repeated results. Columns other than id and text are ignored, whatever their names. An empty table
gives no rows; a text longer than a slice is a slice of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelark.llm.common import slices, table

MARK = "▁"
MODEL = "piece_bpe_32k.model"
#: Distinct marked words a task holds at most (about 60 MB).
TABLE_WORDS = 200_000
_MARKED = re.compile(f"{MARK}+[^{MARK}]*")


class ChunkTable:
    """Distinct marked words with their ids and decoded strings."""

    def __init__(self, processor, limit: int = TABLE_WORDS):
        self.processor, self.limit = processor, limit
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.decoded: list[str] = []
        self.ids, self.lengths = [np.empty(0, np.int32)], [np.empty(0, np.int64)]

    def add(self, words: set[str]) -> None:
        if len(self.code) + len(words) > self.limit:
            self._clear()
        new = [w for w in words if w not in self.code]
        if not new:
            return
        # The library adds the first marker itself.
        encoded = self.processor.encode(new, num_threads=1)
        if "" in new:
            # A marker at the very end of a text; the library has no empty text to give it for.
            encoded[new.index("")] = [self.processor.piece_to_id(MARK)]
        self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
        self.decoded += self.processor.decode(encoded, num_threads=1)
        self.lengths.append(np.fromiter(map(len, encoded), np.int64, len(encoded)))
        self.ids.append(np.array([i for e in encoded for i in e], np.int32))

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.ids, self.lengths = [np.concatenate(self.ids)], [np.concatenate(self.lengths)]
        ends = np.cumsum(self.lengths[0])
        return self.ids[0], ends - self.lengths[0], self.lengths[0]


def marked_words(text: str) -> list[str]:
    """The marked words of a text, each without its first marker."""
    if not text:
        return []
    parts = text.split(" ")
    if "" not in parts and MARK not in text:
        return parts
    return [m[1:] for m in _MARKED.findall(MARK + text.replace(" ", MARK))]


def check_model(processor) -> None:
    """Raise if pieces of the model can cross a marker: the table would then give other ids."""
    crossing = re.compile(f"[^{MARK}]{MARK}")
    for i in range(processor.get_piece_size()):
        if crossing.search(processor.id_to_piece(i)):
            raise ValueError(f"piece {i} crosses a space marker; texts of this model can't be cut into words")


def _encode(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    import sentencepiece

    chunks = ChunkTable(sentencepiece.SentencePieceProcessor(model_proto=model))
    for batch in slices(batches):
        texts = [marked_words(t) for t in batch.column(1).to_pylist()]
        chunks.add({w for words in texts for w in words})
        ids, starts, lengths = chunks.flat()
        code, decoded = chunks.code, chunks.decoded
        per_text = [np.fromiter(map(code.__getitem__, words), np.int64, len(words)) for words in texts]
        codes = np.concatenate(per_text) if per_text else np.empty(0, np.int64)
        n = lengths[codes]
        before = np.concatenate([[0], np.cumsum(n)])
        positions = np.arange(before[-1]) + np.repeat(starts[codes] - before[:-1], n)
        cuts = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.ListArray.from_arrays(pa.array(before[cuts], pa.int32()), pa.array(ids[positions], pa.int32())),
                pa.array([" ".join(map(decoded.__getitem__, c.tolist())) for c in per_text], pa.string()),
            ],
            names=["doc_id", "ids", "decoded"],
        )


def encode_texts(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): what the sentencepiece library gives for every whole text.

    The model file is read where the driver runs and travels with the tasks (it is
    smaller than a megabyte), so executors need no copy of it.
    """
    import sentencepiece

    with open(model_path, "rb") as f:
        model = f.read()
    check_model(sentencepiece.SentencePieceProcessor(model_proto=model))
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return rows.mapInArrow(lambda batches: _encode(batches, model), "doc_id long, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and checksums of encoded texts."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def sentencepiece_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document through the public 32k model."""
    import public_tokenizers

    return digests(encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL)))


QUERIES = {"op9_sentencepiece": sentencepiece_query}
ORACLES: dict[str, str] = {}
