"""Size-checked joins and lineage cuts.

Most operators here are two-pass: one aggregation per group (stratum, batch,
volume), then a narrow map over the rows that needs the group's few numbers.
``attach`` is that second step. The aggregated side is written once to the
shared checkpoint folder, its size is measured, and only then is the join
strategy chosen: broadcast below a byte bound, otherwise a shuffle join in which
the rows of hot keys, and only those, are salted over many tasks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_CONF = "spark.voxelark.broadcastBytes"
SALT_CONF = "spark.voxelark.saltBuckets"
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_SALT_BUCKETS = 32
HOT_CONF = "spark.voxelark.hotRows"
DEFAULT_HOT_ROWS = 1_000_000
_fallback_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for cut lineage: the cluster's ``spark.checkpoint.dir``.

    Only when a local session names none (unit tests, a laptop) is a temporary
    folder made; a cluster without the setting is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback_dirs:
        _fallback_dirs[app] = tempfile.mkdtemp(prefix="voxelark-")
    return _fallback_dirs[app]


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and read it back: survives lost executors, cuts lineage.

    The size is observed while writing, so choosing a join later costs no job.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/voxelark/{label}-{uuid.uuid4().hex}"
    seen = Observation()
    total = F.coalesce(F.sum(_row_width(df)), F.lit(0)).alias("bytes")
    df.observe(seen, total).write.mode("errorifexists").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.measured = int(seen.get["bytes"])
    return table


ONE_PARTITION_BYTES = 512 * 1024


#: Rows, and bytes as ``materialize`` measures them, that one task of a sized shuffle takes at most, about.
PART_ROWS = 250_000
PART_BYTES = 32 * 1024 * 1024


def parts_of(spark: SparkSession, size: int, each: int) -> int:
    """Partitions of at most ``each`` of ``size``: their number grows with the data, so a task's memory doesn't.

    Partitions merged by compressed size can be many times as large once sorted or hashed. Smaller
    tables are dealt over the cores, down to a tenth of ``each``.
    """
    return max(1, -(-size // each), min(spark.sparkContext.defaultParallelism, -(-10 * size // each)))


def compact(table: DataFrame) -> DataFrame:
    """A written table in one partition if it is measured to be tiny.

    Later groupings and joins of such tables then need no shuffle; anything larger
    stays distributed.
    """
    if table.measured > ONE_PARTITION_BYTES:
        return table
    single = table.coalesce(1)
    single.measured = table.measured
    return single


def _bytes(column, kind: T.DataType):
    """Bytes of a value, nested values included."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        own = F.octet_length(column) + 24
    elif isinstance(kind, T.StructType):
        own = F.lit(16)
        for field in kind.fields:
            own = own + _bytes(column.getField(field.name), field.dataType)
    elif isinstance(kind, T.ArrayType):
        own = _total(column, kind.elementType) + 32
    elif isinstance(kind, T.MapType):
        own = _total(F.map_keys(column), kind.keyType) + _total(F.map_values(column), kind.valueType) + 64
    else:
        return F.lit(16).cast("long")
    return F.coalesce(own.cast("long"), F.lit(24).cast("long"))


def _total(column, kind: T.DataType):
    """Bytes of the elements of an array."""
    if isinstance(kind, (T.StringType, T.BinaryType, T.StructType, T.ArrayType, T.MapType)):
        return F.aggregate(column, F.lit(0).cast("long"), lambda sum_, x: sum_ + _bytes(x, kind))
    return F.size(column).cast("long") * 16


def _width(field: T.StructField):
    return _bytes(F.col(f"`{field.name}`"), field.dataType)


def _row_width(df: DataFrame):
    width = F.lit(0).cast("long")
    for field in df.schema.fields:
        width = width + _width(field)
    return width


def fits_broadcast(table: DataFrame) -> bool:
    """Whether a written table's measured size is below the broadcast bound."""
    limit = int(table.sparkSession.conf.get(BROADCAST_CONF, str(DEFAULT_BROADCAST_BYTES)))
    return table.measured <= limit


def salt_column(df: DataFrame, buckets: int):
    """Routing number from row content and input partition.

    Content alone would send all copies of one row to the same place; adding the
    partition number spreads copies too. A retried task gets the same values.
    """
    plain = [
        F.col(f"`{f.name}`")
        for f in df.schema.fields
        if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))
    ][:8]
    return F.pmod(F.xxhash64(*plain) + F.spark_partition_id(), F.lit(buckets)).cast("int")


def skew_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Shuffle join with a ``table`` of one row per key, whatever the skew of ``rows``.

    Keys with more rows than the hot bound are counted first (map-side combined).
    Only their rows are salted and only their table entries repeated per salt, so
    ordinary keys cost what a plain join costs. NULL keys match nothing and are
    spread too.
    """
    spark, keys = rows.sparkSession, list(keys)
    bound = int(spark.conf.get(HOT_CONF, str(DEFAULT_HOT_ROWS)))
    buckets = int(spark.conf.get(SALT_CONF, str(DEFAULT_SALT_BUCKETS)))
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__rows"))
    hot = materialize(
        counts.filter(F.col("__rows") > bound).select(*keys, F.lit(True).alias("__hot")), "hot-keys"
    )
    if hot.measured == 0:
        return rows.join(table, keys, how)
    missing = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    # At most rows / bound keys can be hot; the planner may still refuse a broadcast.
    marked = F.broadcast(hot) if fits_broadcast(hot) else hot
    left = rows.join(marked, keys, "left")
    spread = F.coalesce(F.col("__hot"), F.lit(False)) | missing
    left = left.withColumn("__salt", F.when(spread, salt_column(rows, buckets)).otherwise(0)).drop("__hot")
    every = F.sequence(F.lit(0), F.lit(buckets - 1))
    right = table.join(marked, keys, "left")
    right = right.withColumn("__salt", F.explode(F.when(F.col("__hot"), every).otherwise(F.array(F.lit(0)))))
    return left.join(right.drop("__hot"), [*keys, "__salt"], how).drop("__salt")


def attach(
    rows: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    label: str = "attach",
    part_of: DataFrame | None = None,
) -> DataFrame:
    """Join per-group numbers to rows without ever shuffling a hot group whole.

    ``small`` must hold at most one row per key. If it is a narrow selection from
    an already written table, name that table in ``part_of``: its size bounds the
    selection and nothing is written again.
    """
    table = materialize(small, label) if part_of is None else small
    bounded = table if part_of is None else part_of
    if fits_broadcast(bounded):
        return rows.join(F.broadcast(table), list(keys), how)
    return skew_join(rows, table, keys, how)
