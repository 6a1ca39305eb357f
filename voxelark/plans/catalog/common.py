"""Loading the given tables and rounding results for comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxelark.functions.columns import NUDGE, col, tidy


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6, only: Sequence[str] | None = None) -> DataFrame:
    """Round every double column the way the oracles do."""
    return df.select(
        *[
            tidy(col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and (only is None or f.name in only)
            else col(f.name)
            for f in df.schema.fields
        ]
    )


def sql_round(expression: str, digits: int = 6) -> str:
    return f"round({expression} + {NUDGE}, {digits}) + 0.0"


def voxel_grid(embeddings: DataFrame, keys: Sequence[str] = ("vec_id",)) -> DataFrame:
    """Each 64-element vector as a 4 x 4 x 4 volume, one row per voxel."""
    return embeddings.select(
        *[col(k) for k in keys], F.posexplode("embedding").alias("i", "v")
    ).select(
        *[col(k) for k in keys],
        (F.col("i") % 4).alias("x"),
        (F.floor(F.col("i") / 4) % 4).cast("int").alias("y"),
        F.floor(F.col("i") / 16).cast("int").alias("z"),
        F.col("v").cast("double").alias("value"),
    )


# The same grid in SQL.
VOX = """vox AS (
  SELECT vec_id, CAST(i % 4 AS INTEGER) AS x, CAST((i // 4) % 4 AS INTEGER) AS y,
         CAST(i // 16 AS INTEGER) AS z, CAST(embedding[i + 1] AS DOUBLE) AS value
  FROM embeddings, range(64) AS r(i))"""


def gappy_grid(embeddings: DataFrame, keys: Sequence[str] = ("vec_id",)) -> DataFrame:
    """The same volumes with some voxels absent, some NULL and some NaN."""
    x, y, z, k = F.col("x"), F.col("y"), F.col("z"), col(keys[0])
    missing = F.when((3 * k + x + y + z) % 13 == 7, F.lit(float("nan"))).otherwise(F.col("value"))
    value = F.when((k + 2 * x + y + z) % 11 != 5, missing)
    return voxel_grid(embeddings, keys).filter((k + x + 2 * y + 3 * z) % 9 != 4).withColumn("value", value)


# Absent voxels have no row, NULL and NaN ones are NULL.
GAPPY = f"""{VOX}, gappy AS (
  SELECT vec_id, x, y, z, CASE WHEN (vec_id + 2 * x + y + z) % 11 = 5 OR (3 * vec_id + x + y + z) % 13 = 7 THEN NULL
         ELSE value END AS value FROM vox WHERE (vec_id + x + 2 * y + 3 * z) % 9 <> 4)"""
