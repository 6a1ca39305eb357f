"""Helpers the operators of this package share: table access, Arrow slices, stored steps, components."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voxelark.functions.sizing import shared_dir

#: Bytes of text a Python helper turns into arrays at a time; bounds the memory of a worker.
SLICE_BYTES = 1 << 19
#: Bytes of rows handed to a Python worker at a time; Spark's own bound suits short rows, not whole texts.
BATCH_BYTES = 1 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by BATCH_BYTES unless a smaller bound holds already."""
    held = spark.conf.get(BATCH_CONF).removesuffix("b")
    if not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, *counts) -> tuple[DataFrame, dict]:
    """Write ``df`` to the shared folder and read it back, so that lost executors repeat nothing before it.

    ``counts`` are named aggregates observed while writing; they cost no job of their own.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/voxelark-llm/{label}-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.folder = path
    return kept, seen.get


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more: what was made of them is stored itself."""
    for kept in tables:
        spark = kept.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(kept.folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about SLICE_BYTES of ``column``; one longer value is a slice of its own."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        start = size = 0
        for row, length in enumerate(_lengths(values)):
            if size and size + length > SLICE_BYTES:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        if start < batch.num_rows:
            yield batch.slice(start)
    _release()


def _release() -> None:
    """Give the memory of finished slices back: worker processes live on between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _lengths(values: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(values), 0).to_pylist()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph: (node, component), component the smallest node.

    Smallest nodes themselves have no row.

    ``edges`` has long columns ``a`` and ``b``. Alternating large-star and small-star
    rounds, each a grouped minimum (pre-aggregated before its shuffle) and a join
    that AQE may split, so a node with very many links is never gathered in one
    task. Rounds grow with the logarithm of the longest chain; there is no limit on
    them, they end when a round changes nothing. An empty graph gives no rows.
    """
    links, seen = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    if seen["rows"] == 0:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    print_of = None
    while True:
        # Large star: every neighbour above a node is hung on the smallest neighbour of that node.
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        )
        # Small star: a node and its smaller neighbours are hung on the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .filter("a <> b")
            .distinct()
        )
        before = links
        links, seen = stored(
            small, "components", F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("print"),
        )
        discard(before)
        # The set of links is the same as before: every node hangs on its root.
        now = (seen["rows"], seen["print"])
        if now == print_of:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        print_of = now
