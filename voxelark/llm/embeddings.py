"""Near-duplicate vectors by randomised-rotation binary codes with correction factors.

A unit vector is rotated at random into CODE_DIMS dimensions; the signs of its
coordinates are its code, and the inner product of the vector with the unit vector of
its signs is stored as the correction factor. Code times rotated query divided by the
factor estimates an inner product without bias; the factor also gives a confidence
bound for the error. Pairs whose estimate plus bound stays below the threshold are
dropped, all others are recomputed in double precision. Links are exact.

Candidates are pairs of one label that agree on all bits of some band of further sign
bits; bits per band grow with the largest label so that a bucket holds about
BUCKET vectors, and there are as many bands as the chosen MISS probability of a pair at
the threshold needs. Buckets are cut into tiles of bounded size. A pair is counted
in the first band on which it agrees, so a tile returns one row per vector (a
count and a link towards the tile's component), never its pairs. Equal vectors are
one class with a multiplicity and are not compared.

Vectors that are null, zero, or hold null or non-finite components, rows with a null
label or a null id link with nothing; a row without an id has a null component and is kept.
Vectors of different lengths are not compared. Repeated rows are vectors of their own and link
with each other. An empty table gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelark.llm.common import components, stored, table

THRESHOLD = 0.98
CODE_DIMS = 256
#: Width of the confidence bound in units of its standard term; two-sided error below 1e-8.
EPSILON = 6.0
MISS = 1e-6
BUCKET = 256
TILE = 512


@lru_cache(maxsize=16)
def rotation(dims: int, out: int, seed: int) -> np.ndarray:
    """Random directions (dims, out); orthonormal rows as far as dims <= out allows."""
    size = max(dims, out)
    q, _ = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((size, size)))
    return q[:dims, :out].copy()


def bands_for(largest: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Bits per band and bands for a label of ``largest`` vectors."""
    bits = min(24, max(1, round(math.log2(max(2, largest / BUCKET)))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - agree)))


def band_keys(unit: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """(n, bands) numbers of the sign bits of each band."""
    planes = np.random.default_rng([7, unit.shape[1]]).standard_normal((unit.shape[1], bits * bands))
    signs = (unit @ planes > 0).reshape(len(unit), bands, bits)
    return signs @ (1 << np.arange(bits))


def possible(unit: np.ndarray, threshold: float) -> np.ndarray:
    """Matrix of pairs whose estimated inner product plus bound reaches the threshold."""
    dims = max(CODE_DIMS, unit.shape[1])
    rotated = unit @ rotation(unit.shape[1], dims, 3)
    code = np.where(rotated > 0, 1.0, -1.0).astype(np.float32) / np.float32(math.sqrt(dims))
    factor = np.einsum("ij,ij->i", code, rotated)
    estimate = (code @ rotated.T.astype(np.float32)) / factor[:, None]
    bound = EPSILON * np.sqrt(np.maximum(0, 1 - factor**2)) / factor / math.sqrt(dims - 1)
    return estimate + bound[:, None] >= threshold


def _tile(threshold: float, bits: int, bands: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        rep, times, own = (group.column(c).to_numpy() for c in ("rep", "times", "own"))
        band, x, y = (group.column(c)[0].as_py() for c in ("band", "x", "y"))
        values = group.column("embedding").chunk(0) if group.num_rows else None
        raw = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rep), -1)
        unit = raw / np.abs(raw).max(axis=1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        maybe = possible(unit, threshold) & (rep[:, None] < rep[None, :])
        if x != y:
            maybe &= own[:, None] != own[None, :]
        # The order of ids is arbitrary for codes: the pair is judged by the smaller one's code.
        i, j = np.nonzero(maybe)
        exact = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
        i, j = i[exact], j[exact]
        keys = band_keys(unit, bits, bands)
        first = (keys[i, :band] == keys[j, :band]).any(axis=1) if band else np.zeros(len(i), bool)
        n = np.bincount(i[~first], weights=times[j[~first]], minlength=len(rep))
        n += np.bincount(j[~first], weights=times[i[~first]], minlength=len(rep))
        # Components inside the tile, by the smallest member.
        order = np.argsort(rep, kind="stable")
        low = np.empty(len(rep), np.int64)
        low[order] = np.arange(len(rep))
        while True:
            new = low.copy()
            np.minimum.at(new, i, low[j])
            np.minimum.at(new, j, low[i])
            if (new == low).all():
                break
            low = new
        root = rep[order][low]
        keep = (n > 0) | (root != rep)
        return pa.table(
            {"rep": pa.array(rep[keep]), "n": pa.array(n[keep].astype(np.int64)), "root": pa.array(root[keep].astype(np.int64))}
        )

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; ``vectors`` has vec_id, embedding and label."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label")
    )
    good = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.coalesce(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists("embedding", lambda v: v != 0), F.lit(False))
    )
    rows = rows.withColumn("good", good)
    # Negative zero equals zero; adding 0.0 makes the arrays equal, too.
    plain = F.transform("embedding", lambda v: v + F.lit(0.0))
    classes, seen = stored(
        rows.filter("good").groupBy("label", plain.alias("embedding")).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("times")),
        "vectors",
    )
    sizes = classes.groupBy("label", F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    bits, bands = bands_for(sizes or 1, threshold)

    def place(batches):
        for batch in batches:
            lists = batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            keys = np.zeros((batch.num_rows, bands), np.int64)
            for dims in np.unique(lengths):
                at = np.flatnonzero(lengths == dims)
                raw = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dims)
                unit = raw / np.abs(raw).max(axis=1, keepdims=True)
                keys[at] = band_keys(unit / np.linalg.norm(unit, axis=1, keepdims=True), bits, bands)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))], names=["rep", "keys"]
            )

    keys = classes.select("rep", "embedding").mapInArrow(place, "rep long, keys array<bigint>")
    placed, _ = stored(keys.select("rep", F.posexplode("keys").alias("band", "key")), "vector-bands")
    kinds = classes.select("rep", "label", F.size("embedding").alias("dims"))
    placed = placed.join(kinds, "rep")
    bucket = ["label", "dims", "band", "key"]
    counts = placed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    tiles = placed.join(counts, bucket).withColumn("t", F.ceil(F.col("m") / TILE).cast("int"))
    tiles = tiles.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("t")).cast("int"))
    others = F.sequence(F.lit(0), F.col("t") - 1)
    tiles = tiles.withColumn("other", F.explode(others)).withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other"))
    tiles = tiles.select(*bucket, "x", "y", "own", "rep").join(classes.select("rep", "times", "embedding"), "rep")
    found, _ = stored(
        tiles.groupBy(*bucket, "x", "y").applyInArrow(_tile(threshold, bits, bands), "rep long, n long, root long"), "vector-links"
    )
    labels = components(found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("rep").agg(F.sum("n").alias("n"))
    of_class = classes.join(linked, "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    of_class = of_class.select(
        F.col("label").alias("l"),
        F.col("embedding").alias("e"),
        (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    joined = rows.withColumn("e0", F.when(F.col("good"), plain)).join(
        of_class, F.col("good") & (F.col("label") == F.col("l")) & (F.col("e0") == F.col("e")), "left"
    )
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def embedding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors at cosine 0.98 within their labels."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {"op6_embedding": embedding_query}
ORACLES = {
    "op6_embedding": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM low LEFT JOIN n USING (vec_id)
"""
}
