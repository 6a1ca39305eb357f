"""Feature, batch and statistics tables as Parquet or CSV."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import types as T

from voxelark.functions.columns import col, number


def read_features(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | T.StructType | None = None
) -> DataFrame:
    """Read a table with a header; NaN becomes NULL in floating-point columns."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    df = reader.load(path)
    return df.select(
        *[
            number(col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else col(f.name)
            for f in df.schema.fields
        ]
    )


def write_features(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def append_features(df: DataFrame, path: str) -> None:
    """Add rows to a table as they are produced."""
    df.write.mode("append").parquet(path)


def merge_feature_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of partial tables by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def write_stats(df: DataFrame, path: str) -> str:
    """Write statistics without ever replacing earlier ones.

    If the path is taken, a time-stamped sibling is used. Returns the path written.
    """
    try:
        df.write.mode("errorifexists").parquet(path)
        return path
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    stamped = f"{path.rstrip('/')}_{datetime.now():%Y%m%d%H%M%S%f}"
    df.write.mode("errorifexists").parquet(stamped)
    return stamped


def prefix_features(df: DataFrame, config_name: str, keys: Sequence[str]) -> DataFrame:
    """Replace the leading filter word of every feature name by ``config_name``.

    The word ends at the first ``_`` or ``-`` of the first feature's name.
    Diagnostic columns and keys keep their names.
    """
    features = [c for c in df.columns if c not in keys and not c.startswith("diagnostics")]
    if not features:
        return df
    word = features[0].split("_")[0].split("-")[0]
    return df.withColumnsRenamed({f: config_name + f.removeprefix(word) for f in features})


def assemble_configs(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Feature blocks of several configurations side by side, one row per key.

    Diagnostic columns are taken from the first block only. A key missing from a
    block gets NULLs there.
    """
    blocks = [tables[0]] + [
        t.select(*[col(c) for c in t.columns if not c.startswith("diagnostics")]) for t in tables[1:]
    ]
    return reduce(lambda a, b: a.join(b, list(keys), "full_outer"), blocks)


def score_columns(df: DataFrame, keys: Sequence[str], predictions: Column) -> DataFrame:
    """Keys and a prediction side by side."""
    return df.select(*[col(k) for k in keys], predictions.alias("predictions"))
