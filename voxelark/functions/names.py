"""File and structure names as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelark.functions.columns import col

EXTENSION = ".nii.gz"
MASK_PREFIX = "Mask_"


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(name: Column) -> Column:
    """Name without its last two extensions (``a.b.nii.gz`` gives ``a.b``)."""
    return F.regexp_replace(name, r"(?<=.)(\.[^.]*){1,2}$", "")


def suffixed_name(name: Column, suffix: str) -> Column:
    """Output name of a processing step: stem, ``_suffix`` and the usual extension."""
    return F.concat(stem(name), F.lit(f"_{suffix}{EXTENSION}"))


def canonical_mask_name(name: Column) -> Column:
    """Mask file name of a region: blanks become underscores, prefix and extension added."""
    return F.concat(F.lit(MASK_PREFIX), F.replace(name, F.lit(" "), F.lit("_")), F.lit(EXTENSION))


def prefix_listed(df: DataFrame, names: Sequence[str], file_name: str = "file_name") -> DataFrame:
    """Prefix files whose name up to the first dot is a listed structure (any case)."""
    listed = sorted({n.lower() for n in names})
    short = F.lower(F.substring_index(col(file_name), ".", 1))
    renamed = F.when(short.isin(listed), F.concat(F.lit(MASK_PREFIX), col(file_name)))
    return df.withColumn(file_name, F.coalesce(renamed, col(file_name)))
