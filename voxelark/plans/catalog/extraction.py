"""Features of several configurations in one wide table."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxelark.plans.catalog import spatial, texture
from voxelark.plans.catalog.common import VOX, load, rounded, sql_round, voxel_grid
from voxelark.plans.extraction import CLASSES, FeatureConfig, extract_features, skipped_regions


def extracted_features(spark, sf_dir):
    """Original and filtered features of every volume."""
    image = voxel_grid(load(spark, sf_dir, "embeddings"))
    mask = image.withColumn("value", F.when(F.col("value") > -0.12, 1).otherwise(0))
    configs = [
        FeatureConfig("Original", bin_width=texture.WIDTH, classes=CLASSES[1:]),
        FeatureConfig(
            "Gabor_S4", "Gabor", texture.WIDTH, pad=2, size=4, freq=0.25, classes=("firstorder", "glcm")
        ),
        FeatureConfig("LoG", "LoG", texture.WIDTH, pad=2, sigma=[1.0], classes=("firstorder",)),
    ]
    return rounded(extract_features(image, mask, configs, ["vec_id"]))


def extracted_shape(spark, sf_dir):
    """Shape and diagnostics of every volume with a voxel above 0.05."""
    image = voxel_grid(load(spark, sf_dir, "embeddings"))
    mask = image.withColumn("value", F.when(F.col("value") > 0.05, 1).otherwise(0))
    config = FeatureConfig("Original", classes=("shape",))
    return rounded(extract_features(image, mask, [config], ["vec_id"], texture.SPACING, with_diagnostics=True), 5)


def regions_skipped(spark, sf_dir):
    """Volumes whose mask is absent (no voxel above 0.2) or empty (none above 0.3)."""
    image = voxel_grid(load(spark, sf_dir, "embeddings"))
    mask = image.filter(F.col("value") > 0.2)
    mask = mask.withColumn("value", F.when(F.col("value") > 0.3, 1).otherwise(0))
    return skipped_regions(image, mask, ["vec_id"])


QUERIES = {
    "extracted_features": extracted_features,
    "extracted_shape": extracted_shape,
    "regions_skipped": regions_skipped,
}

# ---------------------------------------------------------------- checking SQL

_ROI = "roi AS (SELECT * FROM vox WHERE value > -0.12)"


def _class_sql(kind: str, prefix: str, kernel: str | None) -> str:
    """A class's own checking SQL on the original or a filtered image, renamed."""
    sql = texture.ORACLES[f"{kind}_features"].replace("e * 3.75", "e * 1")
    if kernel is not None:
        response = spatial._convolved_sql({kernel: spatial._BANK[kernel]}, False, rounding=False)
        region = f"roi AS (SELECT f.* FROM vox f JOIN (WITH {VOX} SELECT vec_id, x, y, z, value AS raw FROM vox) o "
        region += "USING (vec_id, x, y, z) WHERE raw > -0.12)"
        sql = sql.replace(VOX, f"vox AS ({response})").replace(_ROI, region.replace("f.*", "f.vec_id, f.x, f.y, f.z, f.value"))
    return f"SELECT vec_id, COLUMNS('^([A-Z0-9].*)$') AS '{prefix}_{kind}_\\1' FROM ({sql})"


_PARTS = [
    *[_class_sql(k, "Original", None) for k in ("firstorder", "glcm", "gldm", "glrlm", "glszm", "ngtdm")],
    *[_class_sql(k, "Gabor_S4", "gabor-0") for k in ("firstorder", "glcm")],
    _class_sql("firstorder", "LoG-sigma-1-0-mm-3D", "log-sigma-1"),
]

_JOINED = f"SELECT * FROM ({_PARTS[0]}) p0" + "".join(
    f" JOIN ({part}) p{i} USING (vec_id)" for i, part in enumerate(_PARTS[1:], 1)
)

_IMAGE, _MASK = "diagnostics_Image-original", "diagnostics_Mask-original"
_DIAGNOSTICS = f"""WITH {VOX}, i AS (SELECT vec_id, {sql_round('avg(value)', 5)} AS "{_IMAGE}_Mean",
 {sql_round('min(value)', 5)} AS "{_IMAGE}_Minimum", {sql_round('max(value)', 5)} AS "{_IMAGE}_Maximum"
 FROM vox GROUP BY 1)
SELECT * FROM i JOIN (SELECT vec_id, count(*) AS "{_MASK}_VoxelNum",
 {', '.join(f'min({a}) AS "{_MASK}_BoundingBox_{a}"' for a in 'xyz')},
 {', '.join(f'max({a}) - min({a}) + 1 AS "{_MASK}_BoundingBox_size_{a}"' for a in 'xyz')},
 {', '.join(sql_round(f'avg({a})', 5) + f' AS "{_MASK}_CenterOfMassIndex_{a}"' for a in 'xyz')}
 FROM vox WHERE value > 0.05 GROUP BY 1) USING (vec_id)"""

ORACLES = {
    "extracted_features": _JOINED,
    "extracted_shape": f"""SELECT * FROM (
 SELECT vec_id, CAST(COLUMNS('^([A-Z].*)$') AS DOUBLE) AS 'Original_shape_\\1' FROM ({texture.ORACLES["shape_features"]}))
 JOIN ({_DIAGNOSTICS}) USING (vec_id)""",
    "regions_skipped": f"""WITH {VOX}, m AS (SELECT vec_id, max(value) AS top FROM vox GROUP BY 1)
SELECT vec_id, CASE WHEN top > 0.2 THEN 'empty mask' ELSE 'no mask' END AS reason FROM m WHERE top <= 0.3""",
}
