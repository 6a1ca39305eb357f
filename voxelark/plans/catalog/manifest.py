"""Study manifests. Events stand in for files: user = patient, type = sub-analysis."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from voxelark.functions.names import canonical_mask_name, prefix_listed, suffixed_name
from voxelark.functions.sizing import shared_dir
from voxelark.operators.selection import filter_rois
from voxelark.operators.structure import (
    check_structure,
    matching_files,
    reorganize_plan,
    structure_by_key,
    unsegmented,
)
from voxelark.plans.catalog.common import load
from voxelark.sources.study import manifest_columns, scan_manifest

ROOT = "/study"


def _sorted_study(spark, sf_dir):
    """Most events are slices in DCM folders, some are segmentations."""
    e = load(spark, sf_dir, "events")
    folder = F.concat(F.lit(f"{ROOT}/U"), F.col("user_id"), F.lit("/"), F.col("event_type"))
    path = F.when(F.col("event_id") % 10 == 0, F.concat(folder, F.lit("/RTSTRUCT.dcm"))).otherwise(
        F.concat(folder, F.lit("/DCM/"), F.col("event_id"), F.lit(".dcm"))
    )
    return manifest_columns(e.select(path.alias("path")), ROOT)


def _loose_study(spark, sf_dir):
    """Slices directly in the sub-analysis folder; some patient-level files."""
    e = load(spark, sf_dir, "events")
    patient = F.concat(F.lit(f"{ROOT}/U"), F.col("user_id"))
    path = F.when(
        F.col("event_id") % 40 == 0,
        F.concat(patient, F.lit("/rt_"), F.upper("event_type"), F.lit("_"), F.col("event_id"), F.lit(".dcm")),
    ).otherwise(F.concat(patient, F.lit("/"), F.col("event_type"), F.lit("/"), F.col("event_id"), F.lit(".dcm")))
    return manifest_columns(e.select(path.alias("path")), ROOT)


def study_manifest(spark, sf_dir):
    return _sorted_study(spark, sf_dir)


def structure_flags(spark, sf_dir):
    return structure_by_key(_sorted_study(spark, sf_dir))


def structure_flags_loose(spark, sf_dir):
    return structure_by_key(_loose_study(spark, sf_dir))


def structure_status(spark, sf_dir):
    sorted_images = check_structure(_sorted_study(spark, sf_dir), with_segmentation=False)
    sorted_all = check_structure(_sorted_study(spark, sf_dir))
    loose = check_structure(_loose_study(spark, sf_dir), with_segmentation=False)
    parts = [("images", sorted_images), ("segmented", sorted_all), ("loose", loose)]
    tables = [df.withColumn("study", F.lit(name)) for name, df in parts]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def named_files(spark, sf_dir):
    return matching_files(_loose_study(spark, sf_dir))


def named_files_by_pattern(spark, sf_dir):
    """Sub-analyses with names that are patterns, plain ones, short ones, and ones of alternatives."""
    loose = _loose_study(spark, sf_dir)
    name, turn = F.col("sub_Analysis"), F.length("patientID") + F.length("sub_Analysis")
    odd = (
        F.when(turn % 4 == 0, F.regexp_replace(name, "^(.).", "$1."))
        .when(turn % 4 == 1, F.concat(F.substr(name, F.lit(1), F.lit(1)), F.lit(".*"), F.substr(name, F.lit(3), F.lit(9))))
        .when(turn % 4 == 2, F.concat(F.lit("("), name, F.lit("|x)")))
        .otherwise(F.substr(name, F.lit(1), F.lit(2)))
    )
    return matching_files(loose.withColumn("sub_Analysis", odd))


def segmentation_needed(spark, sf_dir):
    return unsegmented(_sorted_study(spark, sf_dir), "dicom")


def moves_planned(spark, sf_dir):
    return reorganize_plan(_loose_study(spark, sf_dir))


def regions_selected(spark, sf_dir):
    part = load(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("roi_name"))
    return filter_rois(part, "roi_name", "^(red|blue|Origin)").withColumn(
        "file_name", canonical_mask_name(F.col("roi_name"))
    )


def output_names(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    name = F.element_at(F.split("url", "/"), -1)
    return pages.select("page_id", suffixed_name(F.concat(name, F.lit(".v1.nii.gz")), "W").alias("file_name"))


def listed_names_prefixed(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.upper("source"), F.lit(".nii.gz")).alias("file_name")
    )
    return prefix_listed(docs, ["Src1", "src7", "SRC12"])


def study_scanned(spark, sf_dir):
    """Files of each day and event type written to a study folder, then listed: names and sizes, contents unread."""
    e = load(spark, sf_dir, "events")
    root = f"{shared_dir(spark)}/voxelark/study-{uuid.uuid4().hex}"
    lines = e.groupBy(F.concat(F.lit("D"), F.dayofmonth("ts")).alias("patient"), F.col("event_type").alias("kind")).agg(
        F.count("*").cast("string").alias("value")
    )
    # One line of text per folder: its size is the length of the number and a line end.
    lines.repartition(1).write.partitionBy("patient", "kind").text(root)
    files = scan_manifest(spark, root).filter(F.col("file_name").endswith(".txt"))
    return files.groupBy("patientID", "sub_Analysis").agg(
        F.count("*").alias("files"), F.sum("length").alias("length"), F.max((F.col("modificationTime").isNotNull()).cast("int")).alias("timed")
    )


QUERIES = {
    "study_scanned": study_scanned,
    "study_manifest": study_manifest,
    "structure_flags": structure_flags,
    "structure_flags_loose": structure_flags_loose,
    "structure_status": structure_status,
    "named_files": named_files,
    "named_files_by_pattern": named_files_by_pattern,
    "segmentation_needed": segmentation_needed,
    "moves_planned": moves_planned,
    "regions_selected": regions_selected,
    "output_names": output_names,
    "listed_names_prefixed": listed_names_prefixed,
}

# ---------------------------------------------------------------- checking SQL

_SORTED = """files AS (SELECT 'U' || user_id AS patientID, event_type AS sub_Analysis,
  CASE WHEN event_id % 10 = 0 THEN 'RTSTRUCT.dcm' ELSE 'DCM/' || event_id || '.dcm' END AS inside FROM events)"""
_LOOSE = """files AS (SELECT 'U' || user_id AS patientID,
  CASE WHEN event_id % 40 = 0 THEN NULL ELSE event_type END AS sub_Analysis,
  CASE WHEN event_id % 40 = 0 THEN 'rt_' || upper(event_type) || '_' || event_id || '.dcm'
    ELSE event_id || '.dcm' END AS file_name FROM events),
subs AS (SELECT DISTINCT patientID, sub_Analysis FROM files WHERE sub_Analysis IS NOT NULL),
named AS (SELECT s.patientID, s.sub_Analysis, '/study/' || f.patientID || '/' || f.file_name AS path, f.file_name
  FROM subs s JOIN files f ON f.patientID = s.patientID AND f.sub_Analysis IS NULL
  AND regexp_matches(f.file_name, s.sub_Analysis, 'i')),
counted AS (SELECT s.*, count(n.path) AS k, min(n.path) AS path FROM subs s LEFT JOIN named n
  USING (patientID, sub_Analysis) GROUP BY 1, 2)"""

ORACLES = {
    "study_scanned": """SELECT 'patient=D' || day(ts) AS patientID, 'kind=' || event_type AS sub_Analysis, 1::BIGINT AS files,
 length(CAST(count(*) AS VARCHAR)) + 1 AS length, 1::INTEGER AS timed FROM events GROUP BY day(ts), event_type""",
    "study_manifest": f"""WITH {_SORTED} SELECT '/study/' || patientID || '/' || sub_Analysis || '/' || inside AS path,
 patientID, sub_Analysis, inside AS "inner", string_split(inside, '/')[-1] AS file_name FROM files""",
    "structure_flags": f"""WITH {_SORTED}, f AS (SELECT patientID, sub_Analysis,
  bool_or(inside = 'RTSTRUCT.dcm') AS has_segmentation, bool_or(inside LIKE 'DCM/%') AS has_dcm FROM files GROUP BY 1, 2)
SELECT *, 0::BIGINT AS matches, has_segmentation AND has_dcm AS ready, FALSE AS reorganizable FROM f""",
    "structure_flags_loose": f"""WITH {_LOOSE} SELECT patientID, sub_Analysis, FALSE AS has_segmentation,
 FALSE AS has_dcm, k AS matches, FALSE AS ready, k = 1 AS reorganizable FROM counted""",
    "structure_status": f"""WITH {_SORTED}, f AS (SELECT patientID, sub_Analysis,
  bool_or(inside = 'RTSTRUCT.dcm') AS s, bool_or(inside LIKE 'DCM/%') AS d FROM files GROUP BY 1, 2)
SELECT 'images' AS study, CASE WHEN bool_and(d) THEN 'Ready' ELSE 'Ready_to_reorganize' END AS status FROM f
UNION ALL SELECT 'segmented', CASE WHEN bool_and(d AND s) THEN 'Ready' ELSE 'Invalid' END FROM f
UNION ALL SELECT 'loose', 'Ready_to_reorganize'""",
    "named_files": f"WITH {_LOOSE} SELECT * FROM named",
    "named_files_by_pattern": f"""WITH {_LOOSE.split('named AS')[0]}
odd AS (SELECT DISTINCT patientID, CASE (length(patientID) + length(sub_Analysis)) % 4
  WHEN 0 THEN regexp_replace(sub_Analysis, '^(.).', '\\1.') WHEN 1 THEN sub_Analysis[1] || '.*' || substr(sub_Analysis, 3, 9)
  WHEN 2 THEN '(' || sub_Analysis || '|x)' ELSE substr(sub_Analysis, 1, 2) END AS sub_Analysis FROM subs)
SELECT s.patientID, s.sub_Analysis, '/study/' || f.patientID || '/' || f.file_name AS path, f.file_name
FROM odd s JOIN files f ON f.patientID = s.patientID AND f.sub_Analysis IS NULL AND regexp_matches(f.file_name, s.sub_Analysis, 'i')""",
    "segmentation_needed": f"""WITH {_SORTED} SELECT patientID, sub_Analysis FROM files GROUP BY 1, 2
 HAVING NOT bool_or(inside = 'RTSTRUCT.dcm')""",
    "moves_planned": f"""WITH {_LOOSE}
SELECT patientID, sub_Analysis, '/study/' || patientID || '/' || sub_Analysis || '/' || file_name AS source,
 patientID || '/' || sub_Analysis || '/DCM/' || file_name AS target, 'move' AS status
FROM files WHERE sub_Analysis IS NOT NULL
UNION ALL SELECT patientID, sub_Analysis, CASE WHEN k = 1 THEN path END,
 CASE WHEN k = 1 THEN patientID || '/' || sub_Analysis || '/RTSTRUCT.dcm' END,
 CASE k WHEN 0 THEN 'warning: segmentation not found' WHEN 1 THEN 'move'
  ELSE 'error: several segmentations found' END FROM counted""",
    "regions_selected": """SELECT p_partkey, p_name AS roi_name, 'Mask_' || replace(p_name, ' ', '_') || '.nii.gz' AS file_name
FROM part WHERE regexp_matches(p_name, '^(red|blue|Origin)') AND p_name NOT IN ('Origin', 'origin')""",
    "output_names": r"""SELECT page_id,
 regexp_replace(string_split(url, '/')[-1] || '.v1.nii.gz', '(\.[^.]*){1,2}$', '') || '_W.nii.gz' AS file_name FROM pages""",
    "listed_names_prefixed": """SELECT doc_id, CASE WHEN lower(source) IN ('src1', 'src7', 'src12') THEN 'Mask_' ELSE '' END
 || upper(source) || '.nii.gz' AS file_name FROM documents""",
}
