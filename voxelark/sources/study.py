"""A study folder as a manifest table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def manifest_columns(files: DataFrame, root: str, path: str = "path") -> DataFrame:
    """Derive manifest columns from paths ``root/patient/sub_analysis/...``.

    ``sub_Analysis`` is NULL for files lying in the patient folder itself; ``inner``
    is the path below the sub-analysis folder.
    """
    relative = F.split(F.substr(F.col(path), _after(F.col(path), root)), "/")
    depth = F.size(relative)
    return files.select(
        F.col(path).alias("path"),
        relative[0].alias("patientID"),
        F.when(depth >= 3, relative[1]).alias("sub_Analysis"),
        F.when(depth >= 3, F.array_join(F.slice(relative, F.lit(3), F.greatest(depth - 2, F.lit(0))), "/")).alias(
            "inner"
        ),
        F.element_at(relative, -1).alias("file_name"),
        *[c for c in files.columns if c != path],
    )


def _after(path: Column, root: str) -> Column:
    """Position of the first character below the root folder."""
    folder = root.rstrip("/") + "/"
    return F.instr(path, folder) + F.lit(len(folder))


def scan_manifest(spark: SparkSession, root: str) -> DataFrame:
    """List a study. File contents are never read, only paths, sizes and times."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    return manifest_columns(files, root)
