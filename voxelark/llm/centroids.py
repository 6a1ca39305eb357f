"""Centroid clustering from stored dot products.

Components become integers, so every dot product, norm and distance is exact. The state is
one row per vector with its integers, its squared norm and its dot product with every
centroid, written to the shared folder after each round. The squared distance to a centroid
is norm + centroid norm - 2 * dot, so a round never multiplies whole vectors again: the
centroids' components that changed are few once clusters settle, and a dot product changes
by the sum of (component * change) over these only. The nearest centroid follows from the
updated dot products.

What meets on the driver is bounded by the parameters: the sums and counts of ``k``
clusters with ``dims`` components. Tasks add their vectors up first, so a cluster that
holds most vectors sends one row from each batch of a task.

The first centroids are the ``k`` vectors with the smallest hash of seed and vec_id. Vectors
of another length, with a null or a non-finite component, or null ones are left out. A
vector without vec_id is assigned, but starts no cluster; repeated rows are vectors of their own,
equal hashes are ordered by the integers. Fewer vectors than ``k`` give fewer centroids; an
empty table, or one without any vec_id, gives no rows. Equal distances go to the smaller number; a centroid without vectors
stays. Only ``vec_id`` and ``embedding`` are read, so extra columns may have any name.
Components must stay below LIMIT in size, so that a squared distance fits 64 bits; a
larger one ends the job with an error rather than with a wrong distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelark.llm.common import discard, stored, table

K = 16
ROUNDS = 3
DIMS = 64
SCALE = 64
SEED = 1
#: Bound of an integer component.
LIMIT = 1 << 26
STATE = "vec_id long, q array<int>, norm long, dots array<long>, cluster int, distance long"


def kept_vectors(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """(vec_id, x): vectors of ``dims`` finite components in double precision."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return rows.filter((F.size("x") == dims) & finite)


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), refused where a distance would not fit 64 bits."""
    q = np.floor(scale * x)
    if q.size and np.abs(q).max() >= LIMIT:
        raise ValueError(f"integer components must be smaller than {LIMIT}: exact distances would exceed 64 bits")
    return q.astype(np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = matrix.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).reshape(-1), kind))


def _assigned(ids: pa.Array, q: np.ndarray, norm: np.ndarray, dots: np.ndarray, centers: np.ndarray) -> pa.RecordBatch:
    """State rows with the nearest centroid by the given dot products."""
    distance = norm[:, None] + (centers**2).sum(axis=1) - 2 * dots
    cluster = distance.argmin(axis=1)
    near = distance[np.arange(len(q)), cluster]
    return pa.RecordBatch.from_arrays(
        [ids, _lists(q, pa.int32()), pa.array(norm), _lists(dots, pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(near)],
        names=["vec_id", "q", "norm", "dots", "cluster", "distance"],
    )


def first_state(rows: DataFrame, centers: np.ndarray, scale: int) -> DataFrame:
    """Integers, norms and all dot products with the first centroids."""
    dims = centers.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = integers(_matrix(batch.column(1), dims), scale)
            yield _assigned(batch.column(0), q, (q**2).sum(axis=1), q @ centers.T, centers)

    return rows.mapInArrow(run, STATE)


def moved(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """The state for changed centroids: dot products updated by the changed components only."""
    k, dims = new.shape
    change = [(c, np.flatnonzero(new[c] != old[c])) for c in range(k)]
    steps = [(c, at, (new - old)[c, at]) for c, at in change if len(at)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column(1), dims).astype(np.int64)
            dots = _matrix(batch.column(3), k).copy()
            for c, at, by in steps:
                dots[:, c] += q[:, at] @ by
            yield _assigned(batch.column(0), q, batch.column(2).to_numpy(zero_copy_only=False), dots, new)

    return state.mapInArrow(run, STATE)


def averaged(state: DataFrame, centers: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of every cluster; clusters without vectors stay."""
    k, dims = centers.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, cluster = _matrix(batch.column(0), dims).astype(np.int64), batch.column(1).to_numpy(zero_copy_only=False)
            sums = np.zeros((k, dims + 1), np.int64)
            np.add.at(sums, cluster, np.concatenate([q, np.ones((len(q), 1), np.int64)], axis=1))
            c, i = np.nonzero(sums)
            cells = [pa.array(c.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(sums[c, i])]
            yield pa.RecordBatch.from_arrays(cells, names=["cluster", "i", "total"])

    parts = state.select("q", "cluster").mapInArrow(run, "cluster int, i int, total long")
    sums = np.zeros((k, dims + 1), object)
    for row in parts.groupBy("cluster", "i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        sums[row.cluster, row.i] = int(row.total)
    new = centers.copy()
    for c in range(k):
        if sums[c, dims]:
            new[c] = [total // sums[c, dims] for total in sums[c, :dims]]
    return new


def seeds(rows: DataFrame, k: int, scale: int, seed: int) -> np.ndarray:
    """The integers of the ``k`` vectors with the smallest hashes, in order."""
    q = F.transform("x", lambda v: F.floor(v * scale)).alias("q")
    named = rows.filter("vec_id is not null").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "x", q)
    picked = named.orderBy("h", "q").limit(k).select("x").collect()
    return np.array([integers(np.array(r.x, float), scale) for r in picked], np.int64)


def cluster(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance, q, dots) of every kept vector after ``rounds`` rounds, and the centroids."""
    rows = kept_vectors(vectors, dims)
    centers = seeds(rows, k, scale, seed)
    if not len(centers):
        # No vector has an id: nothing starts a cluster.
        empty = rows.sparkSession.createDataFrame([], STATE)
        return empty, np.empty((0, dims), np.int64)
    state, _ = stored(first_state(rows, centers, scale), "state")
    for _ in range(rounds):
        new = averaged(state, centers)
        if (new == centers).all():
            break
        before, (state, _) = state, stored(moved(state, centers, new), "state")
        discard(before)
        centers = new
    return state, centers


def centroid_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every vector of ``embeddings``."""
    state, centers = cluster(table(spark, sf_dir, "embeddings"))
    sums = {r.cluster: int(r.s) for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centers]

    def of_cluster(values: list, kind: str):
        # A lookup by cluster in an array of at most k entries.
        return F.get(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), F.col("cluster"))

    inertia = [sums.get(c, 0) for c in range(len(centers))]
    return state.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster(inertia, "long").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"),
    )


def _sql() -> str:
    """Plain rounds over all distances."""
    steps, number = [], f"(SELECT vec_id, i, floor({SCALE} * x)::BIGINT AS x FROM parts)"
    for r in range(ROUNDS + 1):
        steps.append(f"""
d{r} AS (
  SELECT vec_id, c, sum((v.x - m.x) * (v.x - m.x))::BIGINT AS distance FROM v JOIN c{r} m USING (i) GROUP BY vec_id, c
), a{r} AS (
  SELECT vec_id, c, distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, c) AS k FROM d{r}) WHERE k = 1
)""")
        if r < ROUNDS:
            steps.append(f"""
s{r} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{r} JOIN v USING (vec_id) GROUP BY c, i),
c{r + 1} AS (
  SELECT m.c, m.i, coalesce((s - ((s % n) + n) % n) // n, m.x) AS x FROM c{r} m LEFT JOIN s{r} USING (c, i)
)""")
    return f"""
WITH kept AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (SELECT vec_id, unnest(range({DIMS})) AS i, unnest(embedding)::DOUBLE AS x FROM kept),
v AS {number},
first AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id::VARCHAR)) - 1 AS c FROM kept
  QUALIFY c < {K}
), c0 AS (SELECT c, i, x FROM first JOIN v USING (vec_id)), {','.join(steps)},
digests AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN digests USING (c)
"""


QUERIES = {"op11_centroids": centroid_query}
ORACLES = {"op11_centroids": _sql()}
