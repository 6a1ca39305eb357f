"""Voxel intensities and masks. Each embedding vector is a 4 x 4 x 4 volume."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxelark.operators import intensity, masks
from voxelark.operators.selection import drop_empty_masks, skipped_report
from voxelark.plans.catalog.common import GAPPY, VOX, gappy_grid, load, rounded, sql_round, voxel_grid

K = ["vec_id"]
ON = [*K, "x", "y", "z"]


def _image(spark, sf_dir):
    return voxel_grid(load(spark, sf_dir, "embeddings"))


def _mask(spark, sf_dir):
    return _image(spark, sf_dir).withColumn("value", F.when(F.col("value") > 0, 1).otherwise(0))


def _named_masks(spark, sf_dir):
    """Three masks per volume from intensity bands; odd volumes lack the last."""
    image = _image(spark, sf_dir)
    v = F.col("value")
    bands = F.array(
        F.struct(F.lit("Mask_Pancreas.nii.gz").alias("series"), (v > 0).alias("set")),
        F.struct(F.lit("Mask_pancreas_duct.nii.gz").alias("series"), (v < -0.15).alias("set")),
        F.struct(F.lit("Mask_liver.nii.gz").alias("series"), (v > 0.1).alias("set")),
        F.struct(F.lit("img.nii.gz").alias("series"), F.lit(True).alias("set")),
    )
    rows = image.select(*ON, F.inline(bands)).filter(
        (F.col("series") != "Mask_liver.nii.gz") | (F.col("vec_id") % 2 == 0)
    )
    return rows.select(*ON, "series", F.when(F.col("set"), 2).otherwise(0).alias("value"))


def windowed(spark, sf_dir):
    return rounded(intensity.window_intensity(_image(spark, sf_dir), 0.02, 0.3))


def windowed_preset(spark, sf_dir):
    """Prices as intensities under a named window."""
    line = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        (F.col("l_extendedprice") / 100 - 300).alias("value"),
    )
    return rounded(intensity.window_preset(line, "CT_pancreas"))


def image_with_mask(spark, sf_dir):
    return rounded(masks.join_mask(_image(spark, sf_dir), _mask(spark, sf_dir), K))


def thresholded_mask(spark, sf_dir):
    return masks.threshold_mask(_image(spark, sf_dir), _mask(spark, sf_dir), -0.1, 0.1, K)


def thresholded_mask_positive(spark, sf_dir):
    ones = _image(spark, sf_dir).withColumn("value", F.lit(1))
    return masks.threshold_mask(_image(spark, sf_dir), ones, keys=K, positive_only=True)


def masks_merged_by_regex(spark, sf_dir):
    return masks.merge_masks(_named_masks(spark, sf_dir), regex="Pan*", keys=K)


def masks_merged_by_lists(spark, sf_dir):
    return masks.merge_masks(
        _named_masks(spark, sf_dir),
        add=["Mask_Pancreas.nii.gz", "Mask_pancreas_duct.nii.gz"],
        sub=["Mask_liver.nii.gz"],
        keys=K,
    )


def masks_missing(spark, sf_dir):
    return masks.missing_masks(
        _named_masks(spark, sf_dir), ["Mask_Pancreas.nii.gz", "Mask_liver.nii.gz"], K
    )


def binned_by_number(spark, sf_dir):
    return intensity.bin_intensity(_image(spark, sf_dir), n_bins=16, mask=_mask(spark, sf_dir), keys=K)


def binned_by_width(spark, sf_dir):
    return intensity.bin_intensity(_image(spark, sf_dir), bin_width=0.03, keys=K)


def scaled_uint8(spark, sf_dir):
    return intensity.scale_uint8(_image(spark, sf_dir), keys=K)


def scaled_linear(spark, sf_dir):
    return rounded(
        intensity.scale_intensity(
            _image(spark, sf_dir), "linear", _mask(spark, sf_dir), K, low=-1.0, high=1.0
        )
    )


def scaled_zscore(spark, sf_dir):
    return rounded(intensity.scale_intensity(_image(spark, sf_dir), "zscore", _mask(spark, sf_dir), K))


def scaled_robust(spark, sf_dir):
    return rounded(intensity.scale_intensity(_image(spark, sf_dir), "robust", keys=K))


def _matched(image_mask, reference_mask):
    def run(spark, sf_dir):
        image, mask = _image(spark, sf_dir), _mask(spark, sf_dir)
        first = F.col("vec_id") == 0
        return rounded(
            intensity.match_histogram(
                image,
                image.filter(first),
                mask if image_mask else None,
                mask.filter(first) if reference_mask else None,
                K,
            )
        )

    return run


def cropped_to_mask(spark, sf_dir):
    tight = _image(spark, sf_dir).withColumn("value", F.when(F.col("value") > 0.2, 1).otherwise(0))
    return rounded(masks.crop_to_mask(_image(spark, sf_dir), tight, 1, K))


def empty_masks_skipped(spark, sf_dir):
    """Masks of bright voxels: volumes without any are reported with a reason."""
    bright = _image(spark, sf_dir).withColumn("value", F.when(F.col("value") > 0.3, 1).otherwise(0))
    _, empty = drop_empty_masks(bright, K)
    unlabelled = masks.missing_masks(_named_masks(spark, sf_dir), ["Mask_liver.nii.gz"], K)
    return skipped_report({"empty mask": empty, "mask not found": unlabelled}, K)


def filled_masks_kept(spark, sf_dir):
    bright = _image(spark, sf_dir).withColumn("value", F.when(F.col("value") > 0.3, 1).otherwise(0))
    return drop_empty_masks(bright, K)[0]


def series_classified(spark, sf_dir):
    """Line items as series: discounts have few values, prices many."""
    line = load(spark, sf_dir, "lineitem")
    v = F.array(
        F.struct(F.lit("discount.nii.gz").alias("series"), F.col("l_discount").alias("value")),
        F.struct(F.lit("price.nii.gz").alias("series"), F.col("l_extendedprice").alias("value")),
        F.struct(F.lit("IMG_tax.nii.gz").alias("series"), F.col("l_tax").alias("value")),
        F.struct(F.lit("Msk_price.nii.gz").alias("series"), F.col("l_extendedprice").alias("value")),
    )
    return masks.classify_series(line.select("l_returnflag", F.inline(v)), ["l_returnflag"])


def _gappy(spark, sf_dir):
    return gappy_grid(load(spark, sf_dir, "embeddings"))


def _bright_mask(spark, sf_dir):
    """Masks of bright voxels; many are empty and every seventh volume has none."""
    bright = F.when(F.col("value") > 0.3, 1).otherwise(0)
    return _image(spark, sf_dir).filter("vec_id % 7 <> 0").withColumn("value", bright)


def binned_with_gaps(spark, sf_dir):
    return intensity.bin_intensity(_gappy(spark, sf_dir), n_bins=8, mask=_bright_mask(spark, sf_dir), keys=K)


def binned_width_with_gaps(spark, sf_dir):
    return intensity.bin_intensity(_gappy(spark, sf_dir), bin_width=0.05, mask=_bright_mask(spark, sf_dir), keys=K)


def scaled_uint8_with_gaps(spark, sf_dir):
    return intensity.scale_uint8(_gappy(spark, sf_dir), _bright_mask(spark, sf_dir), K)


def scaled_zscore_with_gaps(spark, sf_dir):
    return rounded(intensity.scale_intensity(_gappy(spark, sf_dir), "zscore", _bright_mask(spark, sf_dir), K))


def scaled_robust_with_gaps(spark, sf_dir):
    return rounded(intensity.scale_intensity(_gappy(spark, sf_dir), "robust", _bright_mask(spark, sf_dir), K))


def volumes_skipped(spark, sf_dir):
    return intensity.skipped_volumes(_gappy(spark, sf_dir), _bright_mask(spark, sf_dir), K)


QUERIES = {
    "binned_with_gaps": binned_with_gaps,
    "binned_width_with_gaps": binned_width_with_gaps,
    "scaled_uint8_with_gaps": scaled_uint8_with_gaps,
    "scaled_zscore_with_gaps": scaled_zscore_with_gaps,
    "scaled_robust_with_gaps": scaled_robust_with_gaps,
    "volumes_skipped": volumes_skipped,
    "windowed": windowed,
    "windowed_preset": windowed_preset,
    "image_with_mask": image_with_mask,
    "thresholded_mask": thresholded_mask,
    "thresholded_mask_positive": thresholded_mask_positive,
    "masks_merged_by_regex": masks_merged_by_regex,
    "masks_merged_by_lists": masks_merged_by_lists,
    "masks_missing": masks_missing,
    "binned_by_number": binned_by_number,
    "binned_by_width": binned_by_width,
    "scaled_uint8": scaled_uint8,
    "scaled_linear": scaled_linear,
    "scaled_zscore": scaled_zscore,
    "scaled_robust": scaled_robust,
    "histogram_matched": _matched(False, False),
    "histogram_matched_both_masks": _matched(True, True),
    "histogram_matched_image_mask": _matched(True, False),
    "histogram_matched_reference_mask": _matched(False, True),
    "cropped_to_mask": cropped_to_mask,
    "empty_masks_skipped": empty_masks_skipped,
    "filled_masks_kept": filled_masks_kept,
    "series_classified": series_classified,
}

# ---------------------------------------------------------------- checking SQL

_V = "vec_id, x, y, z"
_NAMED = f"""WITH {VOX}, named AS (
  SELECT {_V}, 'Mask_Pancreas.nii.gz' AS series, CASE WHEN value > 0 THEN 2 ELSE 0 END AS value FROM vox
  UNION ALL SELECT {_V}, 'Mask_pancreas_duct.nii.gz', CASE WHEN value < -0.15 THEN 2 ELSE 0 END FROM vox
  UNION ALL SELECT {_V}, 'Mask_liver.nii.gz', CASE WHEN value > 0.1 THEN 2 ELSE 0 END FROM vox
    WHERE vec_id % 2 = 0)"""
_MERGED = """CAST(CASE WHEN max(CASE WHEN series <> 'Mask_liver.nii.gz' AND value <> 0 THEN 1 ELSE 0 END) = 1
  AND max(CASE WHEN series = 'Mask_liver.nii.gz' AND value <> 0 THEN 1 ELSE 0 END) = 0
  THEN 1 ELSE 0 END AS INTEGER) AS value"""
_RANGE = "min(value) AS lo, max(value) AS hi"


def _histogram_sql(image_mask: bool, reference_mask: bool) -> str:
    src = "WHERE value > 0" if image_mask else ""
    ref = "WHERE vec_id = 0" + (" AND value > 0" if reference_mask else "")
    probs = "[" + ", ".join(f"{j}/11.0" for j in range(1, 11)) + "]"
    apply_to = "v.value > 0" if image_mask else "TRUE"
    passed = " + ".join(f"CAST(v.value >= sk.k[{j}] AS INTEGER)" for j in range(1, 13))
    return f"""WITH {VOX},
sb AS (SELECT vec_id, min(value) AS lo, avg(value) AS m, max(value) AS hi FROM vox {src} GROUP BY 1),
sk AS (SELECT sb.vec_id, any_value(lo) AS lo, list_concat([any_value(m)],
    list_concat(quantile_cont(value, {probs}), [any_value(hi)])) AS k
  FROM vox JOIN sb USING (vec_id) WHERE value >= m GROUP BY 1),
rb AS (SELECT min(value) AS rlo, avg(value) AS rm, max(value) AS rhi FROM vox {ref}),
rk AS (SELECT any_value(rlo) AS rlo, list_concat([any_value(rm)],
    list_concat(quantile_cont(value, {probs}), [any_value(rhi)])) AS rk
  FROM vox, rb {ref} AND value >= rm),
j AS (SELECT v.*, sk.lo, sk.k, rk.rlo, rk.rk, {passed} AS p
  FROM vox v JOIN sk USING (vec_id), rk)
SELECT {_V}, {sql_round(f'''CASE WHEN NOT ({apply_to.replace('v.', '')}) THEN value
  WHEN p = 0 THEN rlo + (value - lo) * coalesce((rk[1] - rlo) / nullif(k[1] - lo, 0), 0)
  WHEN p = 12 THEN rk[12]
  ELSE rk[p] + (value - k[p]) * coalesce((rk[p + 1] - rk[p]) / nullif(k[p + 1] - k[p], 0), 0) END''')} AS value
FROM j"""


# Voxels inside the bright masks, and what they say about their volume.
_BRIGHT = f"""{GAPPY}, bright AS (SELECT g.* FROM gappy g JOIN vox v USING (vec_id, x, y, z)
  WHERE v.value > 0.3 AND vec_id % 7 <> 0),
r AS (SELECT vec_id, min(value) AS lo, max(value) AS hi, avg(value) AS m, stddev_pop(value) AS s,
  quantile_cont(value, 0.5) AS q, quantile_cont(value, 0.98) - quantile_cont(value, 0.02) AS w FROM bright GROUP BY 1)"""


def _bright_sql(value: str) -> str:
    known = "value IS NOT NULL AND lo IS NOT NULL"
    return f"WITH {_BRIGHT} SELECT {_V}, CASE WHEN {known} THEN {value} END AS value FROM gappy LEFT JOIN r USING (vec_id)"


ORACLES = {
    "binned_with_gaps": _bright_sql(
        """CAST(CASE WHEN hi > lo THEN least(greatest(floor((value - lo) / nullif(hi - lo, 0) * 8), 0), 7)
  WHEN value < lo THEN 0 ELSE 7 END AS INTEGER)"""
    ),
    "binned_width_with_gaps": _bright_sql(
        "CAST(least(greatest(floor((value - lo) / 0.05), 0), greatest(ceil((hi - lo) / 0.05) - 1, 0)) AS INTEGER)"
    ),
    "scaled_uint8_with_gaps": _bright_sql(
        "CAST(trunc(least(greatest(coalesce((value - lo) / nullif(hi - lo, 0) * 255, 0), 0), 255)) AS INTEGER)"
    ),
    "scaled_zscore_with_gaps": _bright_sql(sql_round("(value - m) / nullif(s, 0)")),
    "scaled_robust_with_gaps": _bright_sql(sql_round("(value - q) / nullif(w, 0)")),
    "volumes_skipped": f"""WITH {_BRIGHT}, n AS (SELECT vec_id, count(value) AS n FROM gappy GROUP BY 1),
o AS (SELECT vec_id, max(value) AS top FROM vox GROUP BY 1), i AS (SELECT vec_id, count(value) AS k FROM bright GROUP BY 1)
SELECT vec_id, CASE WHEN n = 0 THEN 'no values' WHEN vec_id % 7 = 0 THEN 'no mask' WHEN top <= 0.3 THEN 'empty mask'
  ELSE 'no values inside the mask' END AS reason
FROM n JOIN o USING (vec_id) LEFT JOIN i USING (vec_id) WHERE n = 0 OR vec_id % 7 = 0 OR top <= 0.3 OR coalesce(k, 0) = 0""",
    "windowed": f"WITH {VOX} SELECT {_V}, {sql_round('least(greatest(value, -0.13), 0.17)')} AS value FROM vox",
    "windowed_preset": f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
 {sql_round('least(greatest(l_extendedprice / 100 - 300, -200.0), 300.0)')} AS value FROM lineitem""",
    "image_with_mask": f"""WITH {VOX} SELECT {_V}, {sql_round('value')} AS value,
 CAST(CASE WHEN value > 0 THEN 1 ELSE 0 END AS INTEGER) AS mask FROM vox""",
    "thresholded_mask": f"""WITH {VOX} SELECT {_V},
 CAST(CASE WHEN value > 0 AND value BETWEEN -0.1 AND 0.1 THEN 1 ELSE 0 END AS INTEGER) AS value FROM vox""",
    "thresholded_mask_positive": f"""WITH {VOX} SELECT {_V},
 CAST(CASE WHEN value > 0 THEN 1 ELSE 0 END AS INTEGER) AS value FROM vox""",
    "masks_merged_by_regex": f"{_NAMED} SELECT {_V}, {_MERGED} FROM named GROUP BY ALL",
    "masks_merged_by_lists": f"{_NAMED} SELECT {_V}, {_MERGED} FROM named WHERE vec_id % 2 = 0 GROUP BY {_V}",
    "masks_missing": "SELECT vec_id FROM embeddings WHERE vec_id % 2 = 1",
    "binned_by_number": f"""WITH {VOX}, r AS (SELECT vec_id, {_RANGE} FROM vox WHERE value > 0 GROUP BY 1)
SELECT {_V}, CAST(least(greatest(floor((value - lo) / (hi - lo) * 16), 0), 15) AS INTEGER) AS value
FROM vox JOIN r USING (vec_id)""",
    "binned_by_width": f"""WITH {VOX}, r AS (SELECT vec_id, {_RANGE} FROM vox GROUP BY 1)
SELECT {_V}, CAST(least(greatest(floor((value - lo) / 0.03), 0), ceil((hi - lo) / 0.03) - 1) AS INTEGER) AS value
FROM vox JOIN r USING (vec_id)""",
    "scaled_uint8": f"""WITH {VOX}, r AS (SELECT vec_id, {_RANGE} FROM vox GROUP BY 1)
SELECT {_V}, CAST(trunc((value - lo) / (hi - lo) * 255) AS INTEGER) AS value FROM vox JOIN r USING (vec_id)""",
    "scaled_linear": f"""WITH {VOX}, r AS (SELECT vec_id, {_RANGE} FROM vox WHERE value > 0 GROUP BY 1)
SELECT {_V}, {sql_round('(value - lo) / nullif(hi - lo, 0) * 2 - 1')} AS value FROM vox JOIN r USING (vec_id)""",
    "scaled_zscore": f"""WITH {VOX}, r AS (SELECT vec_id, avg(value) AS m, stddev_pop(value) AS s
 FROM vox WHERE value > 0 GROUP BY 1)
SELECT {_V}, {sql_round('(value - m) / nullif(s, 0)')} AS value FROM vox JOIN r USING (vec_id)""",
    "scaled_robust": f"""WITH {VOX}, r AS (SELECT vec_id, quantile_cont(value, 0.5) AS m,
 quantile_cont(value, 0.98) - quantile_cont(value, 0.02) AS s FROM vox GROUP BY 1)
SELECT {_V}, {sql_round('(value - m) / nullif(s, 0)')} AS value FROM vox JOIN r USING (vec_id)""",
    "histogram_matched": _histogram_sql(False, False),
    "histogram_matched_both_masks": _histogram_sql(True, True),
    "histogram_matched_image_mask": _histogram_sql(True, False),
    "histogram_matched_reference_mask": _histogram_sql(False, True),
    "cropped_to_mask": f"""WITH {VOX}, b AS (SELECT vec_id, min(x) AS x0, max(x) AS x1, min(y) AS y0,
  max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM vox WHERE value > 0.2 GROUP BY 1)
SELECT {_V}, {sql_round('value')} AS value FROM vox JOIN b USING (vec_id)
WHERE x BETWEEN x0 - 1 AND x1 + 1 AND y BETWEEN y0 - 1 AND y1 + 1 AND z BETWEEN z0 - 1 AND z1 + 1""",
    "empty_masks_skipped": f"""WITH {VOX}
SELECT vec_id, 'empty mask' AS reason FROM vox GROUP BY 1 HAVING max(value) <= 0.3
UNION ALL SELECT vec_id, 'mask not found' FROM embeddings WHERE vec_id % 2 = 1""",
    "filled_masks_kept": f"""WITH {VOX}, f AS (SELECT vec_id FROM vox GROUP BY 1 HAVING max(value) > 0.3)
SELECT {_V}, CAST(CASE WHEN value > 0.3 THEN 1 ELSE 0 END AS INTEGER) AS value FROM vox JOIN f USING (vec_id)""",
    "series_classified": """WITH s AS (
  SELECT l_returnflag, 'discount.nii.gz' AS series, count(DISTINCT l_discount) AS k FROM lineitem GROUP BY 1
  UNION ALL SELECT l_returnflag, 'price.nii.gz', count(DISTINCT l_extendedprice) FROM lineitem GROUP BY 1
  UNION ALL SELECT l_returnflag, 'IMG_tax.nii.gz', 1000 FROM lineitem GROUP BY 1
  UNION ALL SELECT l_returnflag, 'Msk_price.nii.gz', 0 FROM lineitem GROUP BY 1)
SELECT l_returnflag, series, CASE WHEN k < 100 THEN 'mask' ELSE 'image' END AS kind FROM s""",
}
