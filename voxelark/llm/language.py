"""Language identification with error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over hashed
letter n-grams tells the languages with a 1 from those with a 0; a text gets the
language whose codeword has the smallest loss, every bit weighted by how well its
classifier separated the two sides in training. Codewords differ in several bits, so
a few wrong classifiers do not change the answer. Up to five languages get all
distinct columns of the exhaustive code; more languages get seeded random columns,
about ten times the logarithm of their number.

The classifiers are multinomial: log ratios of smoothed n-gram frequencies of the
two sides. They need only the n-gram counts of each language, which one pass adds up
over all training rows (every task sums its own rows first). What reaches the driver
is one number per language and feature, whatever the number of rows.

A text that is null or has no letter is ``und`` with score 0. Rows with a null
language are never trained on. Without any training row everything is ``und``.
Repeated rows count repeatedly; extra columns are ignored, whatever their names. An empty table
gives an empty result. Texts may have any length. Of languages with equal losses the first
in order of name is chosen, and the decision is flagged as ambiguous.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelark.llm.common import slices, small_batches, table

UNDETERMINED = "und"
#: Hashed features: byte trigrams and byte 5-grams share the two halves.
FEATURES = 1 << 14
SMOOTH = 0.5
SEED = 5
#: Below this score the decision is flagged as ambiguous.
AMBIGUOUS = 0.6
_LETTER = re.compile(r"[^\W\d_]")
#: Bytes below 128 that are no letters become spaces.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def features(text: str) -> np.ndarray:
    """Hashed n-grams of the letters of a text."""
    raw = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "
    x = np.frombuffer(raw, np.uint8).astype(np.uint32)
    half = FEATURES // 2
    three = (x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA77)) ^ (x[2:] * np.uint32(0xC2B2AE3D))
    if len(x) < 5:
        return (three >> np.uint32(8)) % half
    five = (three[:-2] * np.uint32(0x27D4EB2F)) ^ (x[3:-1] * np.uint32(0x165667B1)) ^ (x[4:] * np.uint32(0xD3A2646D))
    return np.concatenate([(three >> np.uint32(8)) % half, (five >> np.uint32(8)) % half + half])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if lang not in sums:
                sums[lang] = np.zeros(FEATURES, np.int64)
            if text and _LETTER.search(text):
                sums[lang] += np.bincount(features(text), minlength=FEATURES)
    for lang, n in sums.items():
        used = np.flatnonzero(n) if n.any() else np.array([0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(n[used])], names=["lang", "feature", "n"]
        )


def codewords(k: int) -> np.ndarray:
    """A (k, bits) matrix of -1 and 1; every column has both values."""
    if k == 1:
        return np.ones((1, 1))
    if k <= 5:
        columns = [[1] + [1 if c >> j & 1 else -1 for j in range(k - 1)] for c in range(2 ** (k - 1) - 1)]
        return np.array(columns, dtype=float).T
    rng, bits = np.random.default_rng(SEED), int(np.ceil(10 * np.log2(k)))
    best, apart = None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], size=(k, bits))
        code[0, np.all(code == code[0], axis=0)] *= -1
        nearest = min(np.sum(code[i] != code[j]) for i in range(k) for j in range(i))
        if nearest > apart:
            best, apart = code, nearest
    return best


class LanguageModel:
    """Codewords, one weight vector per bit, and the weights of the bits."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.code = languages, codewords(max(1, len(languages)))
        share = (counts + SMOOTH) / (counts.sum(axis=1, keepdims=True) + SMOOTH * counts.shape[1]) if languages else counts
        ratios, apart = [], []
        for bit in self.code.T if languages else []:
            if len(languages) == 1:
                ratios.append(np.ones(FEATURES))
                apart.append(1.0)
                continue
            # Languages of a side weigh the same, however many rows each has.
            one, zero = share[bit > 0].mean(axis=0), share[bit < 0].mean(axis=0)
            ratios.append(np.log(one / zero))
            apart.append(float(((one - zero) * ratios[-1]).sum()))
        self.ratios = np.array(ratios).T if ratios else np.zeros((FEATURES, 0))
        self.weights = np.array(apart) / max(sum(apart), 1e-12)

    def decide(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score between 0 and 1, and whether the decision is ambiguous."""
        if not self.languages or not text or not _LETTER.search(text):
            return UNDETERMINED, 0.0, True
        found = features(text)
        # Overlapping n-grams repeat their evidence; the root keeps margins comparable between lengths.
        margins = self.ratios[found].sum(axis=0) / np.sqrt(len(found))
        losses = (np.logaddexp(0.0, -self.code * margins) * self.weights).sum(axis=1) * self.code.shape[1]
        odds = np.exp(losses.min() - losses)
        best = int(np.argmin(losses))
        score = float(1.0 / odds.sum())
        return self.languages[best], score, score < AMBIGUOUS


def fit(rows: DataFrame) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of all given rows."""
    small_batches(rows.sparkSession)
    labelled = rows.filter(F.col("lang").isNotNull()).select("lang", "text")
    counts = labelled.mapInArrow(_count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("lang").agg(F.collect_list(F.struct("feature", "n")).alias("f")).collect()
    languages = sorted(r["lang"] for r in packed)
    matrix = np.zeros((len(languages), FEATURES))
    for r in packed:
        k = languages.index(r["lang"])
        for feature, n in r["f"]:
            matrix[k, feature] = n
    return LanguageModel(languages, matrix)


def predict(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) from the text alone."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            said = [shared.value.decide(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s[0] for s in said], pa.string()),
                    pa.array([s[1] for s in said], pa.float64()),
                    pa.array([s[2] for s in said], pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "ambiguous"],
            )

    texts = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(decide, "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out():
    """Documents that are never trained on; one without an id has no remainder and is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


QUERIES = {"op4_language": language_query}
ORACLES: dict[str, str] = {}
