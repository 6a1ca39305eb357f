"""Repeated passages of words by super-k-mer partitioning.

A window is SIZE consecutive words. Its minimiser is the smallest hash of its inner
m-grams of words. Consecutive windows that share a minimiser travel as one packed
string (a super-k-mer) to the bucket of that minimiser; equal windows have equal
minimisers and meet there. In a bucket the windows of the distinct strings are sorted
word by word, so equal windows are found exactly. Only minimisers that occur in two
documents are packed and moved (see ``windows``); minimisers of more than HOT_ROWS
occurrences are split further before they travel.

A word is removed if a window that covers it also starts in a document of a smaller
doc_id. Null texts have no words; texts of fewer than SIZE words lose nothing; a text
equal to that of a smaller doc_id loses all its words if it has SIZE of them. Rows
without doc_id lose nothing and are not compared. Repeated rows get equal results. An empty
table gives no rows, texts may have any length, and columns beside doc_id and text may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelark.functions.sizing import attach
from voxelark.llm.common import slices, table
from voxelark.llm.windows import (
    PARTS,
    Kind,
    _binary,
    anchor_rows,
    as_lists,
    bucket_count,
    bucket_spans,
    chosen_runs,
    hot_spans,
    repeated_anchors,
    with_spans,
    without_copies,
)

SIZE = 50
GRAM = 6
#: Bytes of a packed super-k-mer, about.
PACKED = 450


def _pack(kind: Kind, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            t = kind.tokens(_binary(batch, 1))
            text, first, n, anchor, _ = chosen_runs(kind, t, batch.column(2).to_pylist())
            packed = [kind.pack(t, a, k + kind.size - 1) for a, k in zip(first.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((anchor % np.uint64(buckets)).astype(np.int64)),
                    pa.array(ids[text].astype(np.int64)),
                    pa.array(first - t.offsets[text]),
                    pa.array(packed, pa.binary()),
                ],
                names=["bucket", "doc_id", "start", "packed"],
            )

    return run


def _sort(kind: Kind):
    def join(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        split = [b.split(b" ") for b in bodies]
        numbers: dict[bytes, int] = {}
        codes = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in split for w in ws), np.uint64)
        codes = np.concatenate([codes, np.zeros(1, np.uint64)])
        offsets = np.concatenate([[0], np.cumsum([len(ws) for ws in split])]).astype(np.int64)
        return (codes[:-1] << np.uint64(32)) | codes[1:], offsets

    # Tokens are pairs of words.
    steps = sorted({*range(0, kind.size - 1, 2), max(0, kind.size - 2)})

    def run(rows: pa.Table) -> pa.Table:
        bodies = rows.column("packed").to_pylist()
        windows = np.fromiter((b.count(b" ") for b in bodies), np.int64, len(bodies)) + 2 - kind.size
        doc, start = (rows.column(c).to_numpy() for c in ("doc_id", "start"))
        d, lo, hi = bucket_spans(doc, start, bodies, windows, join, steps, kind.size, False)
        return pa.table({"doc_id": pa.array(d, pa.int64()), "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64())})

    return run


def repeated_spans(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Lists of spans of words (doc_id, spans) that repeat passages of smaller documents, and the ids of whole copies."""
    kind = Kind(True, size, gram)
    single, copies = without_copies(docs)
    lists, seen = repeated_anchors(anchor_rows(single, kind), within=False)
    buckets = bucket_count(single, seen["runs"], PACKED)
    met = single.join(lists.select("doc_id", "anchors").filter(F.size("anchors") > 0), "doc_id")
    packed = met.mapInArrow(_pack(kind, buckets), "bucket long, doc_id long, start long, packed binary")
    spans = packed.groupBy("bucket").applyInArrow(_sort(kind), "doc_id long, lo long, hi long")
    spans = as_lists(spans)
    if seen["hot"]:
        hot = attach(single, lists.select("doc_id", "hot").filter(F.size("hot") > 0), ["doc_id"], "inner", "hot-lists")
        spans = spans.union(hot_spans(hot, kind, within=False))
    return spans, copies


def remove_repeated(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """(doc_id, kept, n_words, n_removed): the words that stay, joined by one space."""
    spans, copies = repeated_spans(docs, size, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, n_words, n_removed = [], [], []
            for text, copy, cuts in zip(_binary(batch, 1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = text.split()
                n_words.append(len(words))
                if copy and len(words) >= size:
                    words = []
                for lo, hi in reversed([(c["lo"], c["hi"]) for c in cuts or ()]):
                    del words[lo:hi]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                names=["doc_id", "kept", "n_words", "n_removed"],
            )

    rows = with_spans(docs.select("doc_id", "text"), spans, copies).selectExpr(*PARTS).mapInArrow(run, "doc_id long, kept binary, n_words long, n_removed long")
    return rows.withColumn("kept", F.col("kept").cast("string"))


def substring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 50 words that smaller documents hold."""
    done = remove_repeated(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op5_substring": substring_query}
ORACLES = {
    "op5_substring": f"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), windows AS (
  SELECT doc_id, s, md5(array_to_string(words[s:s + {SIZE - 1}], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {SIZE - 2})) AS s FROM w)
), firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + {SIZE})) AS k FROM windows JOIN firsts USING (h) WHERE first < doc_id
), cut AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(len(words), 0)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed,
       sha256(array_to_string([x[1] FOR x IN list_zip(coalesce(words, []), range(1, coalesce(len(words), 0) + 1))
                               IF NOT coalesce(list_contains(ks, x[2]), false)], ' ')) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id)
"""
}
