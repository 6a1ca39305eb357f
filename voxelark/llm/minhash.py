"""Near-duplicate documents by MinHash banding and sequential Bayesian verification.

A document's set holds its distinct shingles. Documents with equal sets are one
class, represented by the smallest doc_id; all further work is between classes.

1. Signatures of BANDS x ROWS minimum hashes; equal bands put classes in one bucket.
2. In every bucket all members are paired with its smallest and its largest
   member, never with each other. Each pair is compared in batches of signature
   positions; after every batch the posterior of its similarity (uniform prior,
   binomial likelihood) tells whether the threshold is still possible, and pairs
   below the chosen MISS probability are pruned. Survivors are verified on the full
   sets.
3. Links make components. Buckets whose members lie in one component are done. In the
   others only pairs from different components can still matter; they are compared
   in tiles of bounded size, the members of the largest component against the rest,
   first by signatures and then by whole sets, so that no bucket is one task and only
   pairs that reach the threshold leave a tile. Their links are verified and added,
   and the components are final.

Pairs inside one component are not looked for: they change no component. With 24
bands of 4 a pair at similarity 0.8 shares no bucket with probability 3e-6.

Null texts and texts without words have an empty set and are linked with nothing.
Texts of fewer words than a shingle are one shingle. A row without an id takes no part in
any group: it is returned with a null component and kept. A doc_id is a key; exact
repeated rows have equal results. An empty table gives no rows, texts may have any length,
and extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelark.functions.sizing import attach
from voxelark.llm.common import components, discard, slices, stored, table

BANDS, ROWS = 24, 4
BATCH = 16
MISS = 1e-7
#: Members of a bucket on one side of a tile.
TILE = 256
_RNG = np.random.default_rng(29)
_MULTIPLY = _RNG.integers(0, 2**63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, size=BANDS * ROWS, dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str | None, width: int) -> set:
    """The distinct shingles of a text."""
    words = words_of(text)
    if len(words) <= width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(width))))


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of some words, sorted."""
    from pandas.util import hash_array

    if not words:
        return np.empty(0, np.uint64)
    h = hash_array(np.array(words, dtype=object), categorize=False)
    k = min(width, len(h))
    mixed = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        mixed = (mixed ^ h[i : len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minimum hashes of a set."""
    low = np.full(len(_MULTIPLY), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), 2048):
        low = np.minimum(low, (hashes[k : k + 2048, None] * _MULTIPLY + _ADD).min(axis=0))
    return (low >> np.uint64(32)).astype(np.uint32)


def least_matches(threshold: float, miss: float = MISS) -> list[int]:
    """After each batch: the fewest equal positions for which P(similarity >= threshold) is at least ``miss``."""
    out = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        # Posterior Beta(m + 1, n - m + 1): its upper tail is a binomial sum.
        tail = [sum(comb(n + 1, i) * threshold**i * (1 - threshold) ** (n + 1 - i) for i in range(m + 1)) for m in range(n + 1)]
        out.append(next(m for m in range(n + 1) if tail[m] >= miss))
    return out


def survivors(left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """Positions of the signature pairs that no batch prunes."""
    alive, equal = np.arange(len(left)), np.zeros(len(left), np.int64)
    for k, need in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        equal[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[equal[alive] >= need]
    return alive


def _signatures(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint32).reshape(len(values), BANDS * ROWS)


def document_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, print, signature) of every document; print tells equal sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, prints, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingle_hashes(words_of(text), width)
                n.append(len(hashes))
                prints.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
                signatures.append(signature(hashes).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(signatures, pa.binary())],
                names=["doc_id", "n_shingles", "print", "signature"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets, _ = stored(rows.mapInArrow(run, "doc_id long, n_shingles long, print binary, signature binary"), "sets")
    return sets


def _band_rows(classes: DataFrame) -> DataFrame:
    """(bucket, rep): one row per class and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).to_pylist()
            if not values:
                continue
            bands = _signatures(values).reshape(-1, BANDS, ROWS).astype(np.uint64)
            h = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
            for i in range(ROWS):
                h = (h ^ bands[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
                h = h ^ (h >> np.uint64(29))
            reps = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), pa.array(reps)], names=["bucket", "rep"])

    rows, _ = stored(classes.select("rep", "signature").mapInArrow(run, "bucket long, rep long"), "bands")
    return rows


def pruned(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures leave the threshold possible."""
    side = classes.select(F.col("rep"), "signature", "n_shingles")
    both = (
        pairs.join(side.toDF("a", "sa", "na"), "a")
        .join(side.toDF("b", "sb", "nb"), "b")
        .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        .select("a", "b", "sa", "sb")
    )
    least = least_matches(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (_signatures(batch.column(i).to_pylist()) for i in (2, 3))
                yield batch.select(["a", "b"]).take(pa.array(survivors(left, right, least)))

    return both.mapInArrow(run, "a long, b long")


def _texts(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(doc_id, text) of the needed documents; repeated rows of a document count once."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("doc_id").isNotNull())
    found = attach(texts, needed.distinct(), ["doc_id"], "inner", "needed")
    return stored(found.dropDuplicates(["doc_id"]), "texts")[0]


def _exact_sets(texts: DataFrame, width: int) -> DataFrame:
    """(rep, members): the whole shingle sets as 32-bit hashes.

    Equal hashes of different shingles only raise a common count, so a pair that
    fails on these sets fails on the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [(shingle_hashes(words_of(t), width) >> np.uint64(32)).astype(np.uint32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in sets], pa.binary())], names=["rep", "members"]
            )

    return texts.mapInArrow(run, "rep long, members binary")


def verified(pairs: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    texts = _texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
    both = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "ta"), "tb"):
            keep = []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = shingles(ta, width), shingles(tb, width)
                common = len(x & y)
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _tiles(
    bands: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, width: int
) -> DataFrame:
    """Pairs from different components of buckets that hold several, if their full sets can reach the threshold."""
    placed = bands.join(labels, bands.rep == labels.node, "left").select(
        "bucket", "rep", F.coalesce("component", "rep").alias("component")
    )
    groups = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = groups.groupBy("bucket").agg(
        F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("members"), F.count(F.lit(1)).alias("parts")
    )
    # All pairs of up to three members hold the smallest or the largest and were seen before.
    mixed = mixed.filter("parts > 1 and members > 3").select(
        "bucket",
        F.col("main.component").alias("main"),
        F.ceil(F.col("main.n") / TILE).cast("int").alias("tiles_main"),
        F.ceil((F.col("members") - F.col("main.n")) / TILE).cast("int").alias("tiles_rest"),
    )
    rows = placed.join(mixed, "bucket").withColumn("in_main", F.col("component") == F.col("main"))
    own = F.when(F.col("in_main"), F.pmod(F.xxhash64("rep"), F.col("tiles_main"))).otherwise(
        F.pmod(F.xxhash64("rep"), F.col("tiles_rest"))
    )
    rows = rows.withColumn("own", own.cast("int"))
    rest = F.sequence(F.lit(0), F.col("tiles_rest") - 1)
    with_main = F.transform(F.sequence(F.lit(0), F.col("tiles_main") - 1), lambda t: F.struct((-t - 1).alias("x"), F.col("own").alias("y")))
    with_rest = F.transform(rest, lambda t: F.struct(F.least(t, F.col("own")).alias("x"), F.greatest(t, F.col("own")).alias("y")))
    as_main = F.transform(rest, lambda t: F.struct((-F.col("own") - 1).alias("x"), t.alias("y")))
    rows = rows.withColumn("tile", F.explode(F.when(F.col("in_main"), as_main).otherwise(F.concat(with_main, with_rest))))
    rows, _ = stored(
        rows.select("bucket", F.col("tile.x").alias("x"), F.col("tile.y").alias("y"), "own", "in_main", "rep", "component"), "tiles"
    )
    sets = _exact_sets(_texts(docs, rows.select(F.col("rep").alias("doc_id"))), width)
    rows = rows.join(classes.select("rep", "signature", "n_shingles").join(sets, "rep"), "rep")
    least = least_matches(percent / 100)

    def run(group: pa.Table) -> pa.Table:
        rep, component, n, own = (group.column(c).to_numpy() for c in ("rep", "component", "n_shingles", "own"))
        main = group.column("in_main").to_numpy()
        x, y = group.column("x")[0].as_py(), group.column("y")[0].as_py()
        signatures = _signatures(group.column("signature").to_pylist())
        members = [np.frombuffer(m, np.uint32) for m in group.column("members").to_pylist()]
        _, codes = np.unique(np.concatenate(members), return_inverse=True)
        ends = np.cumsum(n)
        inside = np.zeros(codes.max() + 1, bool)
        left = np.flatnonzero(main if x < 0 else own == x)
        right = np.flatnonzero(~main if x < 0 else own == y)
        a_found, b_found = [], []
        for i in left:
            j = right[(component[right] != component[i]) & ((rep[right] > rep[i]) if x == y else True)]
            j = j[100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])]
            if len(j):
                j = j[survivors(np.broadcast_to(signatures[i], (len(j), signatures.shape[1])), signatures[j], least)]
            if len(j):
                own_codes = codes[ends[i] - n[i] : ends[i]]
                inside[own_codes] = True
                theirs = np.concatenate([codes[ends[k] - n[k] : ends[k]] for k in j])
                common = np.add.reduceat(inside[theirs].astype(np.int64), np.cumsum(n[j]) - n[j])
                inside[own_codes] = False
                j = j[100 * common >= percent * (n[i] + n[j] - common)]
                a_found.append(np.full(len(j), rep[i]))
                b_found.append(rep[j])
        a = np.concatenate(a_found) if a_found else np.empty(0, np.int64)
        b = np.concatenate(b_found) if b_found else np.empty(0, np.int64)
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return rows.groupBy("bucket", "x", "y").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, class_id) of every document; class_id is the smallest with equal shingles."""
    sets = document_sets(docs, width)
    classes, _ = stored(
        sets.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("print")
        .agg(F.min(F.struct("doc_id", "signature", "n_shingles")).alias("c"))
        .select("print", F.col("c.doc_id").alias("rep"), "c.signature", "c.n_shingles"),
        "classes",
    )
    bands = _band_rows(classes)
    ends = bands.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi")
    pairs = (
        bands.join(ends, "bucket")
        .select(F.explode(F.array(F.struct(F.col("lo").alias("a"), F.col("rep").alias("b")), F.struct(F.col("rep").alias("a"), F.col("hi").alias("b")))).alias("p"))
        .select("p.a", "p.b")
        .filter("a < b")
        .distinct()
    )
    first, _ = stored(pruned(pairs, classes, percent), "candidates")
    links, _ = stored(verified(first, docs, percent, width), "links")
    discard(first)
    labels = components(links)
    second, seen = stored(_tiles(bands, labels, classes, docs, percent, width), "more-candidates")
    if seen["rows"]:
        more, seen = stored(verified(second, docs, percent, width), "more-links")
        if seen["rows"]:
            labels = components(links.union(more))
    discard(bands)
    by_print = classes.join(labels, classes.rep == labels.node, "left").select(
        "print", "rep", F.coalesce("component", "rep").alias("component")
    )
    known = F.when(F.col("doc_id").isNotNull(), F.col("print")).alias("print")
    by_doc = sets.select("doc_id", "n_shingles", known).join(by_print, "print", "left")
    component = F.coalesce("component", "doc_id")
    return by_doc.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.coalesce("rep", "doc_id").alias("class_id"),
    )


def minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by shingles of two words at similarity 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


QUERIES = {"op2_minhash": minhash_query}
ORACLES = {
    "op2_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) >= 2 THEN list_distinct([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))])
                      WHEN len(words) = 1 THEN words ELSE [] END AS s FROM w
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS total, count(*) AS common
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL
), links AS (SELECT a, b FROM pairs WHERE 100 * common >= 80 * (total - common)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id),
prints AS (SELECT doc_id, CASE WHEN len(s) > 0 THEN min(doc_id) OVER (PARTITION BY list_sort(s)) ELSE doc_id END AS class_id,
                  coalesce(len(s), 0)::BIGINT AS n_shingles FROM sets)
SELECT doc_id, n_shingles, class_id, component_id, doc_id = component_id AS kept FROM prints JOIN low USING (doc_id)
"""
}
