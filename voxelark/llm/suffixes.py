"""Repeated byte strings by range-partitioned suffixes.

Suffixes matter here by their first SIZE bytes. Runs of neighbouring suffixes that hold
one anchor (see ``windows``) travel packed as one row, and only those whose anchor
occurs more than once. Rows are range-partitioned by their leading token, the eight
bytes at the anchor, with splitters taken from a sample; equal leading tokens never
straddle a boundary, so strings are compared inside a range. Each bucket sorts its
suffixes locally by multikey quicksort over tokens of eight bytes. A leading token of
more than HOT_ROWS occurrences would overflow a range: its suffixes are dealt over all
tasks by their whole content and compared across all of them.

A byte is removed if a string of SIZE bytes covering it also starts earlier, in a smaller
doc_id or earlier in the same document. Strings never cross documents and are judged on
the input. Null texts are empty; texts shorter than SIZE lose nothing; a text equal
to that of a smaller doc_id is removed whole if it has SIZE bytes. Rows without doc_id
lose nothing and are not compared. Repeated rows get equal results. An empty table gives no
rows, texts may have any length, and columns beside doc_id and text may have any name.
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
    Tokens,
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

SIZE = 100
GRAM = 24
TOKEN = 8
#: Leading tokens sampled for the splitters; they decide balance only, not results.
SAMPLE = 50_000
#: Ranges; buckets beyond them divide a range by a hash of the leading token.
MOST_RANGES = 4_096
#: Bytes of a packed run, about.
PACKED = 140


def _tokens_at(raw: np.ndarray) -> np.ndarray:
    """Big-endian eight bytes at every position."""
    padded = np.concatenate([raw, np.zeros(TOKEN, np.uint8)])
    value = np.zeros(len(raw), np.uint64)
    for k in range(TOKEN):
        value = (value << np.uint64(8)) | padded[k : k + len(raw)]
    return value


def _leads(kind: Kind, t: Tokens, first: np.ndarray, anchor: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Leading token of the anchor of each run."""
    width = kind.size - kind.gram + 1
    out = np.empty(len(first), np.uint64)
    tokens = _tokens_at(t.payload)
    for k in range(0, len(first), 20_000):
        f = first[k : k + 20_000]
        at = f + np.argmax(grams[f[:, None] + np.arange(width)] == anchor[k : k + 20_000, None], axis=1)
        out[k : k + 20_000] = tokens[at]
    return out


def _pack(kind: Kind, splitters: np.ndarray | None, share: int):
    """Packed runs with their bucket; without splitters only the leading tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            t = kind.tokens(_binary(batch, 1))
            text, first, n, anchor, grams = chosen_runs(kind, t, batch.column(2).to_pylist())
            lead = _leads(kind, t, first, anchor, grams)
            if splitters is None:
                # A number that depends on the place draws the sample.
                lot = (ids[text].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (first - t.offsets[text]).astype(np.uint64)
                lot = (lot * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)
                yield pa.RecordBatch.from_arrays([pa.array(lead.view(np.int64)), pa.array(lot.astype(np.int64))], names=["lead", "lot"])
                continue
            spread = (lead * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            bucket = np.searchsorted(splitters, lead, side="right") * share + (spread % np.uint64(share)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket.astype(np.int64)),
                    pa.array(ids[text].astype(np.int64)),
                    pa.array(first - t.offsets[text]),
                    pa.array([kind.pack(t, a, k + kind.size - 1) for a, k in zip(first.tolist(), n.tolist())], pa.binary()),
                ],
                names=["bucket", "doc_id", "start", "packed"],
            )

    return run


def _sort(kind: Kind):
    def join(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype(np.int64)
        return _tokens_at(np.frombuffer(b"".join(bodies), np.uint8)), offsets

    steps = sorted({*range(0, kind.size - TOKEN + 1, TOKEN), kind.size - TOKEN})

    def run(rows: pa.Table) -> pa.Table:
        bodies = rows.column("packed").to_pylist()
        windows = np.fromiter(map(len, bodies), np.int64, len(bodies)) + 1 - kind.size
        doc, start = (rows.column(c).to_numpy() for c in ("doc_id", "start"))
        d, lo, hi = bucket_spans(doc, start, bodies, windows, join, steps, kind.size, True)
        return pa.table({"doc_id": pa.array(d, pa.int64()), "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64())})

    return run


def repeated_spans(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Lists of spans of bytes (doc_id, spans) that also start earlier, and the ids of whole copies."""
    if gram < TOKEN:
        raise ValueError(f"an anchor must hold the leading token: gram >= {TOKEN}")
    kind = Kind(False, size, gram)
    single, copies = without_copies(docs)
    lists, seen = repeated_anchors(anchor_rows(single, kind), within=True)
    buckets = bucket_count(single, seen["runs"], PACKED)
    ranges = min(buckets, MOST_RANGES)
    wanted = lists.select("doc_id", "anchors").filter(F.size("anchors") > 0)
    # Documents drawn by a hash of their id until about SAMPLE leading tokens are met.
    part = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, -(-seen["runs"] // SAMPLE)))) == 0
    some = single.join(wanted.filter(part), "doc_id")
    leads = some.mapInArrow(_pack(kind, None, 1), "lead long, lot long").orderBy("lot").limit(2 * SAMPLE)
    leads = leads.toPandas()["lead"].to_numpy(np.int64)
    ordered = np.sort(leads.view(np.uint64))
    splitters = ordered[np.arange(1, ranges) * len(ordered) // ranges] if len(ordered) else np.empty(0, np.uint64)
    met = single.join(wanted, "doc_id")
    packed = met.mapInArrow(
        _pack(kind, splitters, -(-buckets // ranges)), "bucket long, doc_id long, start long, packed binary"
    )
    spans = packed.groupBy("bucket").applyInArrow(_sort(kind), "doc_id long, lo long, hi long")
    spans = as_lists(spans)
    if seen["hot"]:
        hot = attach(single, lists.select("doc_id", "hot").filter(F.size("hot") > 0), ["doc_id"], "inner", "hot-lists")
        spans = spans.union(hot_spans(hot, kind, within=True))
    return spans, copies


def remove_repeated(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans): the bytes that stay, and how many runs went."""
    spans, copies = repeated_spans(docs, size, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, n_bytes, n_spans = [], [], []
            for text, copy, cuts in zip(_binary(batch, 1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                gone = [(0, len(text))] if copy and len(text) >= size else [(c["lo"], c["hi"]) for c in cuts or ()]
                n_bytes.append(len(text))
                n_spans.append(len(gone))
                edges = [0, *(x for span in gone for x in span), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            removed = [n - len(k) for n, k in zip(n_bytes, kept)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(kept, pa.binary()),
                    *(pa.array(x, pa.int64()) for x in (n_bytes, removed, n_spans)),
                ],
                names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    rows = with_spans(docs.select("doc_id", "text"), spans, copies)
    return rows.selectExpr(*PARTS).mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def cleaned(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """The documents, all columns kept, with repeated strings cut out of ``text``.

    A character of which bytes were removed goes whole.
    """
    spans, copies = repeated_spans(docs, size, gram)
    rows, columns = with_spans(docs, spans, copies), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            copy, spans = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("__copy", "__spans"))
            for k, text in enumerate(texts):
                if text and (copy[k] or spans[k]):
                    raw = text.encode()
                    gone = [(0, len(raw))] if copy[k] and len(raw) >= size else [(c["lo"], c["hi"]) for c in spans[k] or ()]
                    edges = [0, *(x for span in gone for x in span), len(raw)]
                    texts[k] = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])).decode("utf-8", "ignore")
            arrays = [pa.array(texts, pa.string()) if c == "text" else batch.column(batch.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return rows.mapInArrow(run, docs.schema)


def suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without strings of 100 bytes that start earlier."""
    done = remove_repeated(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op8_suffix": suffix_query}
ORACLES = {
    "op8_suffix": f"""
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
h AS (SELECT doc_id, hex(raw) AS x, octet_length(raw) AS n FROM b),
windows AS (
  SELECT doc_id, s, md5(substr(x, 2 * s + 1, {2 * SIZE})) AS m
  FROM (SELECT doc_id, x, unnest(range(n - {SIZE - 1})) AS s FROM h WHERE n >= {SIZE})
), marked AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY m ORDER BY doc_id, s) AS r FROM windows
), gone AS (
  SELECT doc_id, s, max(s) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last
  FROM marked WHERE r > 1
), islands AS (
  SELECT doc_id, s, sum(CASE WHEN last IS NULL OR s > last + {SIZE} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS k
  FROM gone
), spans AS (SELECT doc_id, k, min(s) AS lo, max(s) + {SIZE} AS hi FROM islands GROUP BY ALL),
pieces AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS since FROM spans
), sums AS (
  SELECT doc_id, x, n, coalesce(sum(hi - lo), 0)::BIGINT AS n_removed, count(lo) AS n_spans,
         coalesce(string_agg(substr(x, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo), '') || substr(x, 2 * coalesce(max(hi), 0) + 1) AS kept
  FROM h LEFT JOIN pieces USING (doc_id) GROUP BY doc_id, x, n
)
SELECT doc_id, n::BIGINT AS n_bytes, n_removed, n_spans::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256 FROM sums
"""
}
