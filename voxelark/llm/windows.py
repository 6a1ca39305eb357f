"""Repeated windows of a fixed number of tokens, found without moving every window.

Shared by the duplicate removers over words and over bytes. Every window has an
anchor: the smallest hash of its inner m-grams. Equal windows have equal anchors, and
runs of consecutive windows share one, so a text of n tokens has far fewer anchors
than windows (about 2 / (window - m + 2) of n).

1. ``without_copies``: a text equal to the text of a smaller doc_id is set aside; all
   its windows start earlier. Very large groups of copies never reach what follows.
2. ``anchor_rows``: one row per distinct (document, anchor).
3. ``repeated_anchors``: anchors that can hold an equal window; one list per document.
4. The caller cuts the runs of those anchors out of the texts and compares them.
   Anchors with more than HOT_ROWS occurrences are kept apart (``hot_spans``), because
   one anchor of a line that many documents share would else fill one task.
5. ``with_spans``: the removed spans of each document beside its text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelark.functions.sizing import attach, materialize
from voxelark.llm.common import discard, slices, stored

#: Occurrences from which an anchor is hot.
HOT_ROWS = 10_000
#: Bytes of packed runs in a bucket, on average.
BUCKET_BYTES = 2 << 20
#: Windows of a hot anchor compared together after whole runs: each round cuts what differs into three.
WIDTHS = (27, 9, 3, 1)
_BASE = 0x9E3779B97F4A7C15
_BYTE_HASH = np.random.default_rng(11).integers(0, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: What the removers read of ``with_spans``.
PARTS = ["__id AS doc_id", "cast(text AS binary) AS text", "__copy AS copy", "__spans AS spans"]


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    ones = np.ones(n + 1, np.uint64)
    up, down = ones * np.uint64(_BASE), ones * np.uint64(pow(_BASE, -1, 1 << 64))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def rolling(x: np.ndarray, m: int) -> np.ndarray:
    """64-bit hashes of all m-grams of the token hashes ``x``."""
    if len(x) < m:
        return np.empty(0, np.uint64)
    size = 1 << max(16, int(len(x)).bit_length())
    up, down = (p[: len(x) + 1] for p in _powers(size))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up[: len(x)], dtype=np.uint64)])
    h = (sums[m:] - sums[:-m]) * down[: len(x) - m + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    return h


def sliding_min(g: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    k = 1
    while 2 * k <= width:
        g = np.minimum(g[:-k], g[k:])
        k *= 2
    rest = width - k
    return np.minimum(g[: len(g) - rest], g[rest:]) if rest else g


class Tokens:
    """Tokens of some texts side by side, with hashes."""

    def __init__(self, hashes: np.ndarray, offsets: np.ndarray, payload: np.ndarray):
        self.hashes, self.offsets, self.payload = hashes, offsets, payload


def byte_tokens(texts: list[bytes]) -> Tokens:
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return Tokens(_BYTE_HASH[raw], offsets, raw)


def word_tokens(texts: list[bytes]) -> Tokens:
    """Words between ASCII white space: what bytes.split() gives."""
    from pandas.util import hash_array

    per_text = [t.split() for t in texts]
    words = np.array([w for ws in per_text for w in ws], dtype=object)
    offsets = np.concatenate([[0], np.cumsum([len(ws) for ws in per_text])]).astype(np.int64)
    hashes = hash_array(words, categorize=False) if len(words) else np.empty(0, np.uint64)
    return Tokens(hashes, offsets, words)


class Kind:
    """What a token is, how long a window is, and the length of an anchor."""

    def __init__(self, words: bool, size: int, gram: int):
        self.words, self.size, self.gram = words, size, gram
        self.tokens = word_tokens if words else byte_tokens

    def pack(self, t: Tokens, at: int, n: int) -> bytes:
        """``n`` tokens as one string."""
        return b" ".join(t.payload[at : at + n].tolist()) if self.words else t.payload[at : at + n].tobytes()

    def length(self, packed: str):
        """Tokens of a packed column."""
        if self.words:
            return F.size(F.split(F.col(packed).cast("string"), " ")).cast("long")
        return F.octet_length(packed).cast("long")

    def runs(self, t: Tokens):
        """Text number, first window, number of windows and anchor of every run; also the m-gram hashes."""
        empty = np.empty(0, np.int64)
        if len(t.hashes) < self.size:
            return empty, empty, empty, np.empty(0, np.uint64), np.empty(0, np.uint64)
        grams = rolling(t.hashes, self.gram)
        low = sliding_min(grams, self.size - self.gram + 1)
        text = np.repeat(np.arange(len(t.offsets) - 1), np.diff(t.offsets))[: len(low)]
        valid = np.arange(len(low)) + self.size <= t.offsets[text + 1]
        new = valid.copy()
        new[1:] &= ~(valid[:-1] & (low[1:] == low[:-1]))
        first = np.flatnonzero(new)
        # A run ends where the next begins or where windows stop being valid.
        ends = np.flatnonzero(valid & np.concatenate([new[1:] | ~valid[1:], [True]])) + 1
        return text[first], first, ends - first, low[first], grams


    def anchors(self, t: Tokens):
        """Text number and hash of every m-gram that is the smallest of some window.

        A periodic text has one run of windows but many such m-grams, so positions,
        not runs, tell whether an anchor repeats inside a text.
        """
        if len(t.hashes) < self.size:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        width = self.size - self.gram + 1
        grams = rolling(t.hashes, self.gram)
        low = sliding_min(grams, width)
        text = np.repeat(np.arange(len(t.offsets) - 1), np.diff(t.offsets))[: len(grams)]
        low[np.arange(len(low)) + self.size > t.offsets[text[: len(low)] + 1]] = 0
        around = np.zeros(len(grams) + width - 1, np.uint64)
        around[width - 1 : width - 1 + len(low)] = low
        at = np.flatnonzero(~sliding_min(~around, width) == grams)
        return text[at], grams[at]


def _binary(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [t or b"" for t in batch.column(column).to_pylist()]


def without_copies(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with an id and a text whose text is not that of a smaller doc_id, and the ids of the others."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = rows.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") > 0))
    prints = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("print"))
    firsts = prints.groupBy("print").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    copies = materialize(
        prints.join(firsts, "print").filter("doc_id > first").select("doc_id", F.lit(True).alias("copy")).distinct(), "copies"
    )
    single = attach(rows, copies, ["doc_id"], "left", part_of=copies).filter(F.col("copy").isNull()).drop("copy")
    return single, copies


def anchor_rows(single: DataFrame, kind: Kind) -> DataFrame:
    """(doc_id, anchor, n): distinct anchors of every document and how often each occurs there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            text, anchor = kind.anchors(kind.tokens(_binary(batch, 1)))
            order = np.lexsort((anchor, text))
            text, anchor = text[order], anchor[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.concatenate([at, [len(text)]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[text[at]].astype(np.int64)), pa.array(anchor[at].view(np.int64)), pa.array(n.astype(np.int32))],
                names=["doc_id", "anchor", "n"],
            )

    rows, _ = stored(single.mapInArrow(run, "doc_id long, anchor long, n int"), "anchors")
    return rows


def repeated_anchors(rows: DataFrame, within: bool) -> tuple[DataFrame, dict]:
    """(doc_id, anchors, hot): per document its anchors that occur elsewhere, too.

    ``within`` counts repetitions inside one document as well. Documents without
    such an anchor have no row.
    """
    if within:
        counts = rows.groupBy("anchor").agg(F.sum("n").alias("total")).filter("total > 1")
    else:
        # A row is a document here: two of them are two documents.
        counts = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("total")).filter("total > 1")
    hot = F.col("total") > HOT_ROWS
    listed = (
        rows.select("doc_id", "anchor")
        .join(counts, "anchor")
        .groupBy("doc_id")
        .agg(
            F.collect_list(F.when(~hot, F.col("anchor"))).alias("anchors"),
            F.collect_list(F.when(hot, F.col("anchor"))).alias("hot"),
        )
    )
    table = materialize(listed, "repeated")
    discard(rows)
    seen = table.agg(
        F.coalesce(F.sum(F.size("anchors").cast("long")), F.lit(0)).alias("runs"),
        F.coalesce(F.sum(F.size("hot").cast("long")), F.lit(0)).alias("hot"),
    ).first()
    return table, seen.asDict()


def bucket_count(single: DataFrame, runs: int, run_bytes: int) -> int:
    """Enough buckets for BUCKET_BYTES each, and several for every shuffle partition."""
    partitions = int(single.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(8 * partitions, runs * run_bytes // BUCKET_BYTES)


def equal_groups(tokens: np.ndarray, at: np.ndarray, steps: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the windows starting at ``at``: members and group numbers of equal windows.

    ``tokens[p]`` is the 64-bit token at position p, ``steps`` the offsets of the
    tokens of a window. Windows are split by one token after the other; windows alone
    in their group drop out, groups of two are compared directly.
    """
    members, groups = at, np.zeros(len(at), np.int64)
    done_members, done_groups, made = [], [], 0
    for k, step in enumerate(steps):
        if not len(members):
            break
        key = tokens[members + step]
        order = np.argsort(key, kind="stable") if k == 0 else np.lexsort((key, groups))
        members, key, groups = members[order], key[order], groups[order]
        new = np.ones(len(members), bool)
        new[1:] = (key[1:] != key[:-1]) | (groups[1:] != groups[:-1])
        numbers = np.cumsum(new) - 1
        sizes = np.bincount(numbers)[numbers]
        starts = np.flatnonzero(new & (sizes == 2))
        if len(starts):
            a, b, rest = members[starts], members[starts + 1], steps[k + 1 :]
            same = np.ones(len(a), bool)
            for s in rest:
                left = np.flatnonzero(same)
                same[left] = tokens[a[left] + s] == tokens[b[left] + s]
            a, b = a[same], b[same]
            done_members += [a, b]
            fresh = made + np.arange(len(a))
            done_groups += [fresh, fresh]
            made += len(a)
        more = sizes > 2
        members, groups = members[more], numbers[more]
    if len(members):
        _, groups = np.unique(groups, return_inverse=True)
        done_members.append(members)
        done_groups.append(groups + made)
    if not done_members:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(done_members), np.concatenate(done_groups)


def bucket_spans(doc, start, bodies: list, windows, join: Callable, steps: list[int], size: int, within: bool):
    """Removed spans (doc, from, to) of the runs of one bucket.

    Equal runs are one body; only distinct bodies are sorted. A window is removed if
    its sequence occurs at a smaller doc_id or, with ``within``, earlier in the same one.
    """
    start_key = start if within else np.zeros_like(start)
    codes: dict = {}
    code = np.fromiter((codes.setdefault(b, len(codes)) for b in bodies), np.int64, len(bodies))
    order = np.lexsort((start_key, doc, code))
    head = np.ones(len(order), bool)
    head[1:] = code[order][1:] != code[order][:-1]
    lead = order[head]  # the earliest occurrence of each body, by code
    n = windows[lead]
    tokens, offsets = join(list(codes))
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    body = np.repeat(np.arange(len(lead)), n)
    members, groups = equal_groups(tokens, offsets[body] + inner, steps)
    # The earliest place of every group of equal windows.
    base = np.repeat(offsets[: len(lead)], n)
    where = np.searchsorted(base + inner, members)
    m_body, m_inner = body[where], inner[where]
    m_doc, m_start = doc[lead][m_body], start_key[lead][m_body] + (m_inner if within else 0)
    sort = np.lexsort((m_start, m_doc, groups))
    first = np.ones(len(sort), bool)
    first[1:] = groups[sort][1:] != groups[sort][:-1]
    number = np.cumsum(first) - 1
    low_doc, low_start = m_doc[sort][first][number], m_start[sort][first][number]
    later = (low_doc < m_doc[sort]) | ((low_doc == m_doc[sort]) & (low_start < m_start[sort]))
    b, i = m_body[sort][later], m_inner[sort][later]
    order = np.lexsort((i, b))
    b, i = b[order], i[order]
    new = np.ones(len(b), bool)
    new[1:] = (b[1:] != b[:-1]) | (i[1:] != i[:-1] + 1)
    s = np.flatnonzero(new)
    e = np.concatenate([s[1:], [len(b)]])[: len(s)] - 1
    out_doc, out_from = doc[lead][b[s]], start[lead][b[s]] + i[s]
    out_to = start[lead][b[s]] + i[e] + size if len(s) else out_from
    # Other occurrences of a body: all windows repeat those of the first, unless nothing there is smaller.
    low = lead[code]
    whole = (doc[low] < doc) | ((doc[low] == doc) & (start_key[low] < start_key))
    part = ~whole & (low != np.arange(len(doc)))
    # Same document without ``within``: the windows removed at the first occurrence are removed here, too.
    again = np.flatnonzero(part)
    at, end = (np.searchsorted(b[s], code[again], side=side) for side in ("left", "right"))
    n = end - at
    which = np.repeat(again, n)
    span = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at, n)
    out_doc = np.concatenate([out_doc, doc[which]])
    out_from = np.concatenate([out_from, start[which] + i[s][span]])
    out_to = np.concatenate([out_to, start[which] + i[e][span] + size])
    return (
        np.concatenate([out_doc, doc[whole]]),
        np.concatenate([out_from, start[whole]]),
        np.concatenate([out_to, start[whole] + windows[whole] - 1 + size]),
    )


def chosen_runs(kind: Kind, t: Tokens, lists: list) -> tuple:
    """Runs whose anchor is listed for their text."""
    text, first, n, anchor, grams = kind.runs(t)
    sizes = [len(x) for x in lists]
    want_text = np.repeat(np.arange(len(lists)), sizes)
    want = np.concatenate([np.asarray(x, np.int64) for x in lists]) if sum(sizes) else np.empty(0, np.int64)
    # Pairs (text, anchor) as one structured key each.
    pair = np.dtype([("t", np.int64), ("a", np.int64)])
    have = np.empty(len(text), pair)
    have["t"], have["a"] = text, anchor.view(np.int64)
    wanted = np.empty(len(want), pair)
    wanted["t"], wanted["a"] = want_text, want
    keep = np.isin(have, wanted) if len(want) else np.zeros(len(text), bool)
    return text[keep], first[keep], n[keep], anchor[keep], grams


def _split(kind: Kind, width: int):
    """Pieces into parts of at most ``width`` windows, cut at places that depend on the content around the anchor only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner = kind.size - kind.gram + 1
        for batch in slices(batches, "packed"):
            t = kind.tokens(_binary(batch, 2))
            grams = rolling(t.hashes, kind.gram)
            n = np.diff(t.offsets) - kind.size + 1
            body = np.repeat(np.arange(len(n)), n)
            at = np.repeat(t.offsets[:-1], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            anchor = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)[body]
            away = np.empty(len(at), np.int64)
            for k in range(0, len(at), 20_000):
                x = at[k : k + 20_000, None]
                away[k : k + 20_000] = np.argmax(grams[x + np.arange(inner)] == anchor[k : k + 20_000, None], axis=1)
            new = np.ones(len(at), bool)
            place = at + away
            new[1:] = (body[1:] != body[:-1]) | (place[1:] != place[:-1]) | (away[1:] // width != away[:-1] // width)
            first = np.flatnonzero(new)
            # Windows whose anchor stands in the same third all hold these tokens, whichever of them a part has.
            core = (place - away // width * width)[first]
            yield _parts(kind, batch, t, body, at, first, core, max(0, kind.size - width + 1))

    return run


def _parts(kind: Kind, batch: pa.RecordBatch, t: Tokens, body, at, first, core, shared: int) -> pa.RecordBatch:
    """Bodies of the pieces of ``at`` that begin at the positions ``first``, and the ``shared`` tokens at ``core`` of each."""
    n = np.diff(np.concatenate([first, [len(at)]]))
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    starts = batch.column(1).to_numpy(zero_copy_only=False)
    b, a = body[first], at[first]
    places = list(zip(a.tolist(), n.tolist()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[b].astype(np.int64)),
            pa.array((starts[b] + a - t.offsets[b]).astype(np.int64)),
            pa.array([kind.pack(t, x, k + kind.size - 1) for x, k in places], pa.binary()),
            pa.array(batch.column(3).to_numpy(zero_copy_only=False)[b].astype(np.int64)),
            pa.array([kind.pack(t, x, shared) for x in core.tolist()], pa.binary()),
        ],
        names=["doc_id", "start", "packed", "anchor", "core"],
    )


def hot_spans(met: DataFrame, kind: Kind, within: bool) -> DataFrame:
    """(doc_id, spans): removed windows of hot anchors, without gathering an anchor's rows.

    ``met`` has doc_id, text and the list ``hot``. Packed pieces are compared as a whole, finer
    in every round (runs, then WIDTHS windows): a grouped minimum of their places, pre-aggregated,
    tells the first occurrence of each distinct piece, and only that is cut finer, and only if its core (what
    all windows share that have their anchor in the same third) stands in another distinct piece: otherwise
    none of its windows occurs outside its copies. A document has one row for a piece, with all its places. What many documents
    share ends in the first rounds, what is unique is cut once, so few windows travel alone.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            t = kind.tokens(_binary(batch, 1))
            text, first, n, anchor, _ = chosen_runs(kind, t, batch.column(2).to_pylist())
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[text].astype(np.int64)),
                    pa.array(first - t.offsets[text]),
                    pa.array([kind.pack(t, a, k + kind.size - 1) for a, k in zip(first.tolist(), n.tolist())], pa.binary()),
                    pa.array(anchor.view(np.int64)),
                    pa.array([b""] * len(first), pa.binary()),
                ],
                names=["doc_id", "start", "packed", "anchor", "core"],
            )

    shape, piece = "doc_id long, start long, packed binary, anchor long, core binary", ["packed", "anchor"]
    found = before = None
    for label, split in (("runs", runs), *((f"windows-{w}", _split(kind, w)) for w in WIDTHS)):
        rows = met.mapInArrow(split, shape).withColumn("core", F.xxhash64("core"))
        placed = rows.groupBy(*piece, "doc_id").agg(F.array_sort(F.collect_list("start")).alias("starts"), F.first("core").alias("core"))
        by_doc, _ = stored(placed, f"hot-{label}")
        if before is not None:
            discard(before)
        firsts = by_doc.groupBy(*piece).agg(
            F.min(F.struct("doc_id", "starts")).alias("f"), F.max("doc_id").alias("last"), F.first("core").alias("core")
        )
        firsts, _ = stored(firsts, f"hot-{label}-firsts")
        before = firsts
        several = F.col("f.doc_id") < F.col("last")
        later = F.col("doc_id") > F.col("f.doc_id")
        gone = F.col("starts")
        if within:
            # In the document of the first place all other places go.
            several = several | (F.size("f.starts") > 1)
            gone = F.when(later, gone).otherwise(F.slice("starts", 2, F.greatest(F.size("starts") - 1, F.lit(0))))
            later = later | (F.size("starts") > 1)
        again = firsts.filter(several).select(*piece, "f", kind.length("packed").alias("length"))
        joined = by_doc.join(again, piece).filter(later)
        spans = F.transform(gone, lambda at: F.struct(at.alias("lo"), (at + F.col("length")).alias("hi")))
        # What goes is small; the pieces are not needed after it.
        joined, _ = stored(joined.select("doc_id", spans.alias("spans")), f"hot-{label}-spans")
        discard(by_doc)
        found = joined if found is None else found.union(joined)
        start = F.col("f.starts")[0] if within else F.explode("f.starts")
        if split is not runs:
            # A whole run may hold its anchor several times; parts hold it at one place, so their cores can be told.
            shared = firsts.groupBy("core", "anchor").agg(F.count(F.lit(1)).alias("pieces")).filter("pieces > 1")
            firsts = firsts.join(shared, ["core", "anchor"])
        met = firsts.select(F.col("f.doc_id").alias("doc_id"), start.alias("start"), *piece)
    discard(before)
    return found


def as_lists(spans: DataFrame) -> DataFrame:
    """(doc_id, spans) of rows (doc_id, lo, hi)."""
    return spans.select("doc_id", F.array(F.struct("lo", "hi")).alias("spans"))


def merged_spans(spans):
    """A column of spans as maximal runs of their union, in order."""
    start = F.slice(spans, 1, 0)

    def add(done, span):
        last = F.element_at(done, -1)
        grown = F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], span["hi"]).alias("hi"))
        apart = (F.size(done) == 0) | (span["lo"] > F.try_element_at(done, F.lit(-1))["hi"])
        return F.when(apart, F.concat(done, F.array(span))).otherwise(
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown))
        )

    return F.aggregate(F.array_sort(spans), start, add)


def with_spans(docs: DataFrame, spans: DataFrame, copies: DataFrame) -> DataFrame:
    """Every document (all columns) with ``copy`` and the merged ``spans`` (lists of them by doc_id) to remove.

    The spans of documents that lose something are a small table; it is joined by its
    measured size.
    """
    listed = spans.groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    listed = listed.select("doc_id", merged_spans(F.col("spans")).alias("spans"))
    both = copies.join(listed, "doc_id", "full").select(F.col("doc_id").alias("__id"), F.col("copy").alias("__copy"), F.col("spans").alias("__spans"))
    rows = docs.withColumn("__id", F.col("doc_id").cast("long"))
    return attach(rows, both, ["__id"], "left", "spans")
