"""Checks and plans on a study manifest.

A manifest has ``path, patientID, sub_Analysis, inner, file_name`` (see
``voxelark.sources.study``). Files in the patient folder itself carry no
``sub_Analysis``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelark.functions.columns import KEYS, col
from voxelark.functions.sizing import attach, materialize

READY, REORGANIZE, INVALID = "Ready", "Ready_to_reorganize", "Invalid"
SEGMENTATION_FILE = "RTSTRUCT.dcm"
# Characters that make a name a pattern rather than plain text.
_PATTERN_CHARACTERS = r"[\\^$.|?*+()\[\]{}]"


#: Characters of a name's key: files and names meet on substrings of this length.
_KEY = 3
# Patterns with one of these have no text that every match must hold, as far as is looked for here.
_OPEN_PATTERN = r"[\\|()\[\]{}]"


def _required_text(name: Column, is_pattern: Column) -> Column:
    """Lower-case text that every match of a name holds: a plain name itself, else the longest run of plain
    characters of a pattern without groups and alternatives. Empty if there is none."""
    # A character that may be left out or repeated at will is no part of a run.
    runs = F.split(F.regexp_replace(name, r"(?s).[*?]", "."), r"[.^$+]")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("r"))))["r"]
    return F.lower(F.when(~is_pattern, name).when(~name.rlike(_OPEN_PATTERN), longest).otherwise(F.lit("")))


def matching_files(manifest: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Files of the patient folder whose name contains a sub-analysis name.

    Case-insensitive; a name with pattern characters is searched as a pattern. A name is known
    by the last three characters of the text that its matches must hold, and meets only
    the files whose name has those somewhere; then it is searched. So the work grows
    with the files and their matches, not with files times sub-analyses. Names without such a text
    (of one or two characters, or patterns of groups and alternatives) meet all files of their patient.
    """
    patient, sub = keys
    subs = manifest.filter(F.col(sub).isNotNull()).select(patient, sub).distinct()
    is_pattern = col(sub).rlike(_PATTERN_CHARACTERS)
    text = _required_text(col(sub), is_pattern)
    key = F.when(F.length(text) >= _KEY, F.substr(text, F.length(text) - (_KEY - 1), F.lit(_KEY)))
    subs = materialize(subs.select(patient, sub, is_pattern.alias("__pattern"), key.alias("__key")), "sub-analyses")
    files = manifest.filter(F.col(sub).isNull()).select(patient, "path", "file_name")
    # One row of names per key: what a file's part may meet.
    keyed = subs.filter(F.col("__key").isNotNull()).groupBy(patient, "__key").agg(
        F.collect_set(F.struct(col(sub).alias("name"), "__pattern")).alias("__names")
    )
    lower = F.lower("file_name")
    starts = F.when(F.length(lower) >= _KEY, F.sequence(F.lit(1), F.length(lower) - (_KEY - 1)))
    parts = F.array_distinct(F.transform(starts, lambda i: F.substr(lower, i, F.lit(_KEY))))
    met = attach(files.withColumn("__key", F.explode(parts)), keyed, [patient, "__key"], "inner", "name-keys")
    met = met.select(patient, "path", "file_name", F.inline("__names"))
    rest = files.join(subs.filter(F.col("__key").isNull()).select(patient, col(sub).alias("name"), "__pattern"), patient)
    both = met.unionByName(rest)
    found = F.when(F.col("__pattern"), F.expr("file_name rlike concat('(?i)', name)")).otherwise(
        F.contains(F.lower("file_name"), F.lower("name"))
    )
    return both.filter(found).select(patient, F.col("name").alias(sub), "path", "file_name")


def structure_by_key(
    manifest: DataFrame, with_segmentation: bool = True, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Per sub-analysis: is it ready, and could it be reorganized?

    Ready means a ``DCM`` folder and, for segmented studies, the segmentation file
    in the sub-analysis folder. Reorganizable means exactly one file of the patient
    folder names the sub-analysis.
    """
    keys = list(keys)
    folders = manifest.filter(F.col(keys[1]).isNotNull())
    flags = folders.groupBy(*keys).agg(
        F.bool_or(F.col("inner") == SEGMENTATION_FILE).alias("has_segmentation"),
        F.bool_or(F.col("inner").startswith("DCM/")).alias("has_dcm"),
    )
    counts = matching_files(manifest, keys).groupBy(*keys).agg(F.count("*").alias("matches"))
    table = flags.join(counts, keys, "left").withColumn("matches", F.coalesce("matches", F.lit(0).cast("long")))
    ready, movable = F.col("has_dcm"), F.lit(True)
    if with_segmentation:
        ready = ready & F.col("has_segmentation")
        movable = F.col("matches") == 1
    return table.select("*", ready.alias("ready"), movable.alias("reorganizable"))


def check_structure(
    manifest: DataFrame, with_segmentation: bool = True, keys: Sequence[str] = KEYS
) -> DataFrame:
    """One row ``status`` for the whole study."""
    table = structure_by_key(manifest, with_segmentation, keys)
    summary = table.agg(F.bool_and("ready").alias("r"), F.bool_and("reorganizable").alias("m"))
    return summary.select(
        F.when(F.coalesce("r", F.lit(True)), READY).when(F.col("m"), REORGANIZE).otherwise(INVALID).alias("status")
    )


def unsegmented(manifest: DataFrame, image_type: str = "dicom", keys: Sequence[str] = KEYS) -> DataFrame:
    """Sub-analyses that still need a segmentation.

    DICOM: no segmentation file. NIfTI: fewer than two image files in the folder.
    """
    keys = list(keys)
    direct = ~F.col("inner").contains("/")
    if image_type.lower() == "dicom":
        done = F.bool_or(F.col("inner") == SEGMENTATION_FILE)
    elif image_type.lower() == "nifti":
        done = F.count_if(direct & F.col("file_name").endswith("nii.gz")) >= 2
    else:
        raise ValueError(f"unknown image type {image_type!r}; use dicom or nifti")
    grouped = manifest.filter(F.col(keys[1]).isNotNull()).groupBy(*keys).agg(done.alias("__done"))
    return grouped.filter(~F.col("__done")).select(*keys)


def reorganize_plan(
    manifest: DataFrame,
    with_segmentation: bool = True,
    all_segmented: bool = False,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Where each file should go: ``source, target, status`` per sub-analysis.

    Slices move to the ``DCM`` folder. The one patient-level file naming the
    sub-analysis becomes its segmentation file. A sub-analysis with none or with
    several gets one row saying so (an error row when all must be segmented).
    """
    patient, sub = keys
    root = F.concat_ws("/", patient, sub)
    slices = manifest.filter(F.col(sub).isNotNull() & ~F.col("inner").contains("/")).select(
        patient,
        sub,
        F.col("path").alias("source"),
        F.concat_ws("/", root, F.lit("DCM"), "file_name").alias("target"),
        F.lit("move").alias("status"),
    )
    if not with_segmentation:
        return slices
    matches = materialize(matching_files(manifest, keys), "matches")
    counts = matches.groupBy(patient, sub).agg(F.count("*").alias("__n"), F.min("path").alias("__path"))
    subs = manifest.filter(F.col(sub).isNotNull()).select(patient, sub).distinct()
    decided = subs.join(counts, [patient, sub], "left")
    one = F.col("__n") == 1
    absent = "error: segmentation not found" if all_segmented else "warning: segmentation not found"
    status = (
        F.when(F.col("__n").isNull(), absent).when(one, "move").otherwise("error: several segmentations found")
    )
    segmentations = decided.select(
        patient,
        sub,
        F.when(one, F.col("__path")).alias("source"),
        F.when(one, F.concat_ws("/", root, F.lit(SEGMENTATION_FILE))).alias("target"),
        status.alias("status"),
    )
    return slices.unionByName(segmentations)
