"""Shards by proportional stratified interleaving, with DataFrame functions only.

Rows of each source are shuffled by a seeded hash and ranked; a row's fractional
rank is (rank + 1/2) / rows of its source. Sorting all rows by fractional rank
interleaves the sources in proportion, so every contiguous piece of that order
holds the mixture of the whole. The order is cut into pieces of equal row counts.

No source is ever ranked in one task: ranks are counted per (source, cell of the
hash) with a pre-aggregated count, running sums of those counts give each cell its
first rank, and only rows of one cell are numbered by a window. The global order
is numbered in the same way over cells of the fractional rank. Both kinds of cells
hold about CELL_ROWS rows, whatever the sizes of the sources.

Null sources form a stratum of their own. Null texts count 8 bytes and have a null
checksum; equal or repeated rows are separate rows (ties are broken by doc_id, then
checksum). Row counts of the shards differ by at most one. An empty table gives no rows. Texts may
have any length; columns beside those read may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelark.llm.common import stored, table

SHARDS = 24
SEED = "17"
#: Rows of a cell that one window numbers, on average.
CELL_ROWS = 2_000


def interleave(
    rows: DataFrame, shards: int, stratum: str = "source", id_column: str = "doc_id", text_column: str = "text", seed: str = SEED
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): the place of every row."""
    order = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))))
    light, seen = stored(
        rows.select(
            F.col(f"`{id_column}`").cast("long").alias("doc_id"),
            F.col(f"`{stratum}`").cast("string").alias("stratum"),
            (F.coalesce(F.octet_length(f"`{text_column}`"), F.lit(0)) + 8).cast("long").alias("size"),
            F.crc32(f"`{text_column}`").alias("text_crc32"),
            order.alias("lot"),
        ),
        "shard-rows",
    )
    n = seen["rows"]
    cells = max(1, -(-n // CELL_ROWS))
    # First eight hex digits of the lot, as a fraction of all lots: equal cells on average, in the order of the lots.
    cell = F.floor(F.conv(F.substring("lot", 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) * F.lit(cells)).cast("int")
    light = light.withColumn("cell", cell)
    counts = light.groupBy("stratum", "cell").agg(F.count(F.lit(1)).alias("n"))
    by_stratum = Window.partitionBy("stratum")
    firsts = counts.select(
        F.col("stratum").alias("s"),
        F.col("cell").alias("c"),
        (F.sum("n").over(by_stratum.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("first"),
        F.sum("n").over(by_stratum).alias("of"),
    )
    tie = [F.col("lot"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    placed = light.withColumn("r", F.row_number().over(Window.partitionBy("stratum", "cell").orderBy(*tie)) - 1).join(
        firsts, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c"))
    )
    fraction = (F.col("first") + F.col("r") + 0.5) / F.col("of")
    ranked, _ = stored(
        placed.select("doc_id", "stratum", "size", "text_crc32", "lot", fraction.alias("fraction")), "shard-fractions"
    )
    ranked = ranked.withColumn("band", F.least(F.floor(F.col("fraction") * cells), F.lit(cells - 1)).cast("int"))
    # One row for each band, in chunks of 1000 bands so that no window holds them all.
    bands = ranked.groupBy("band").agg(F.count(F.lit(1)).alias("n")).withColumn("chunk", F.floor(F.col("band") / 1000))
    chunks = bands.groupBy("chunk").agg(F.sum("n").alias("m"))
    before = Window.partitionBy(F.lit(0)).orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    chunks = chunks.select("chunk", (F.sum("m").over(before) - F.col("m")).alias("chunk_first"))
    within = Window.partitionBy("chunk").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    starts = bands.withColumn("before", F.sum("n").over(within) - F.col("n")).join(chunks, "chunk")
    starts = starts.select("band", (F.col("before") + F.col("chunk_first")).alias("start"))
    tie = [F.col("fraction"), F.col("stratum"), *tie]
    place = F.col("start") + F.row_number().over(Window.partitionBy("band").orderBy(*tie)) - 1
    n = max(n, 1)
    return (
        ranked.join(starts, "band")
        .withColumn("place", place.cast("long"))
        .withColumn("shard", F.expr(f"place * {shards} div {n}").cast("int"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("place") - F.expr(f"(cast(shard as bigint) * {n} + {shards - 1}) div {shards}")).cast("long").alias("slot"),
        )
    )


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row counts, each with the mixture of sources."""
    placed = interleave(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES = {"op3_sharding": sharding_query}
#: crc32 is computed byte by byte from the table of its polynomial.
ORACLES = {
    "op3_sharding": f"""
WITH poly AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda acc, k:
    CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END, b)) AS t
), base AS (
  SELECT doc_id, source, coalesce(strlen(text), 0) + 8 AS size, md5('{SEED}-' || doc_id) AS lot,
         regexp_extract_all(hex(encode(text)), '..') AS bytes
  FROM documents
), sums AS (
  SELECT doc_id, source, size, lot, xor(list_reduce(
    list_transform(bytes, lambda h: ('0x' || h)::BIGINT),
    lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM base, poly
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY lot, doc_id) - 0.5::DOUBLE)
            / count(*) OVER (PARTITION BY source) AS fraction, count(*) OVER () AS n FROM sums
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source, lot, doc_id) - 1 AS place FROM ranked
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (place * {SHARDS} // n)::INTEGER AS shard,
       (place - ((place * {SHARDS} // n) * n + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""
}
