"""Row selection, include/skip lists, completeness checks and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelark.functions.columns import KEYS, col
from voxelark.functions.sizing import attach


def include(df: DataFrame, ids: DataFrame, on: Sequence[str] = ("patientID",)) -> DataFrame:
    """Keep only listed keys; an empty list keeps everything."""
    on = list(on)
    if ids.isEmpty():
        return df
    return attach(df, ids.select(*on).distinct(), on, "inner", "include")


def skip(df: DataFrame, ids: DataFrame, on: Sequence[str] = ("patientID",)) -> DataFrame:
    """Drop listed keys."""
    on = list(on)
    listed = ids.select(*on).distinct().withColumn("__listed", F.lit(True))
    return attach(df, listed, on, "left", "skip").filter(F.col("__listed").isNull()).drop("__listed")


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the table: {missing}")


def incomplete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which any of the columns is missing (NULL or NaN)."""
    def missing(name: str):
        if df.schema[name].dataType.typeName() in ("double", "float"):
            return col(name).isNull() | F.isnan(col(name))
        return col(name).isNull()

    return df.filter(reduce(lambda a, b: a | b, [missing(c) for c in columns]))


def check_complete(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Return ``df``, or fail naming some of the incomplete rows."""
    require_columns(df, columns)
    bad = incomplete_rows(df, columns).select(*[col(c) for c in [*keys, *columns]]).limit(20).collect()
    if bad:
        shown = "; ".join(str(r.asDict()) for r in bad)
        raise ValueError(f"missing values in {list(columns)}, for example: {shown}")
    return df


def drop_empty_masks(
    mask: DataFrame, keys: Sequence[str] = KEYS, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Masks with a non-zero voxel, and the keys of those without one."""
    keys = list(keys)
    filled = mask.groupBy(*keys).agg(F.bool_or(col(value) != 0).alias("__filled"))
    kept = attach(mask, filled.filter("__filled").drop("__filled"), keys, "inner", "filled-masks")
    return kept, filled.filter(~F.coalesce(F.col("__filled"), F.lit(False))).select(*keys)


def skipped_report(reasons: dict[str, DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """Union of skipped keys, each with the reason it was left out."""
    parts = [df.select(*keys).distinct().withColumn("reason", F.lit(r)) for r, df in reasons.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def filter_rois(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Regions whose name matches (case-sensitive search), never the origin marker."""
    return df.filter(col(name).rlike(pattern) & ~col(name).isin("Origin", "origin"))
