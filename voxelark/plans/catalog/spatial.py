"""Resampling, convolution and filter banks."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from voxelark.functions.columns import number
from voxelark.operators.convolve import (
    apply_filters,
    convolve,
    gabor_kernel,
    gaussian_taps,
    kernel_terms,
    log_terms,
    wavelet_bank,
    wavelet_levels,
)
from voxelark.operators.resample import resample, resample_study, resampled_volumes
from voxelark.plans.catalog.common import GAPPY, VOX, gappy_grid, load, rounded, sql_round, voxel_grid

K = ["vec_id"]
# Voxel size of the grids, in millimetres.
SPACING = {"x": 1.0, "y": 1.5, "z": 2.5}


def _image(spark, sf_dir):
    return voxel_grid(load(spark, sf_dir, "embeddings"))


def _volumes(spark, sf_dir):
    ids = load(spark, sf_dir, "embeddings").select("vec_id")
    return ids.select(
        "vec_id",
        *[F.lit(4).alias(f"n{a}") for a in "xyz"],
        *[F.lit(s).alias(f"s{a}") for a, s in SPACING.items()],
    )


def resampled_geometry(spark, sf_dir):
    return resampled_volumes(_volumes(spark, sf_dir), 1.0)


def resampled_nearest(spark, sf_dir):
    mask = _image(spark, sf_dir).withColumn("value", F.when(F.col("value") > 0, 1).otherwise(0))
    return resample(mask, _volumes(spark, sf_dir), 1.0, "nearest", K)


def resampled_linear(spark, sf_dir):
    return rounded(resample(_image(spark, sf_dir), _volumes(spark, sf_dir), 1.0, "linear", K))


def resampled_linear_edge(spark, sf_dir):
    return rounded(
        resample(_image(spark, sf_dir), _volumes(spark, sf_dir), 2.0, "linear", K, outside="edge")
    )


def _study(spark, sf_dir):
    """Image and mask series per volume; every third volume has no mask."""
    image = _image(spark, sf_dir)
    v = F.array(
        F.struct(F.lit("img.nii.gz").alias("series"), F.col("value").alias("value")),
        F.struct(F.lit("Mask_a.nii.gz").alias("series"), (F.col("value") > 0).cast("double").alias("value")),
    )
    rows = image.select("vec_id", "x", "y", "z", F.inline(v))
    return rows.filter((F.col("series") == "img.nii.gz") | (F.col("vec_id") % 3 != 0))


def _series_volumes(spark, sf_dir):
    names = F.explode(F.array(F.lit("img.nii.gz"), F.lit("Mask_a.nii.gz"))).alias("series")
    return _volumes(spark, sf_dir).select("*", names)


def study_resampled(spark, sf_dir):
    return rounded(resample_study(_study(spark, sf_dir), _series_volumes(spark, sf_dir), 1.0, K)[0])


def study_images_resampled(spark, sf_dir):
    """The images of the study alone."""
    out = resample_study(_study(spark, sf_dir), _series_volumes(spark, sf_dir), 1.0, K, has_masks=False)[0]
    return rounded(out)


def study_masks_resampled(spark, sf_dir):
    """The masks of the study alone."""
    out = resample_study(_study(spark, sf_dir), _series_volumes(spark, sf_dir), 1.0, K)[0]
    return rounded(out.filter(F.col("series") != "img.nii.gz"))


def study_without_mask(spark, sf_dir):
    return resample_study(_study(spark, sf_dir), _series_volumes(spark, sf_dir), 1.0, K)[1]


def gabor_filtered(spark, sf_dir):
    return rounded(convolve(_image(spark, sf_dir), gabor_kernel(8, 0.5, math.pi / 4), K))


# Taps of the Haar wavelet.
_H = 1 / math.sqrt(2)
HAAR_LOW, HAAR_HIGH = [_H, _H], [-_H, _H]


def filters_applied(spark, sf_dir):
    """Gabor in two directions, Laplacian of Gaussian and wavelet bands together."""
    bank = {
        "gabor-0": kernel_terms(gabor_kernel(4, 0.25, 0.0)),
        "gabor-90": kernel_terms(gabor_kernel(4, 0.25, math.pi / 2)),
        "log-sigma-1": log_terms(1.0),
        **wavelet_bank(HAAR_LOW, HAAR_HIGH),
    }
    return rounded(apply_filters(_image(spark, sf_dir), bank, K))


def _gappy(spark, sf_dir):
    return gappy_grid(load(spark, sf_dir, "embeddings"))


# An uneven kernel of three by three voxels.
UNEVEN = [(dx, dy, 0, round(0.1 + 0.05 * (dx + 1) + 0.15 * (dy + 1), 2)) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]


def convolved_with_gaps(spark, sf_dir):
    return rounded(convolve(_gappy(spark, sf_dir), UNEVEN, K))


def resampled_with_gaps(spark, sf_dir):
    return rounded(resample(_gappy(spark, sf_dir), _volumes(spark, sf_dir), 1.0, "linear", K))


def resampled_nearest_with_gaps(spark, sf_dir):
    marks = _gappy(spark, sf_dir).withColumn("value", F.when(number(F.col("value")) > 0, 1).otherwise(0))
    return resample(marks, _volumes(spark, sf_dir), 1.0, "nearest", K)


def wavelet_two_levels(spark, sf_dir):
    return rounded(wavelet_levels(_image(spark, sf_dir), HAAR_LOW, HAAR_HIGH, 2, 0, K))


def wavelet_second_level(spark, sf_dir):
    return rounded(wavelet_levels(_image(spark, sf_dir), HAAR_LOW, HAAR_HIGH, 1, 1, K))


QUERIES = {
    "convolved_with_gaps": convolved_with_gaps,
    "resampled_with_gaps": resampled_with_gaps,
    "resampled_nearest_with_gaps": resampled_nearest_with_gaps,
    "wavelet_two_levels": wavelet_two_levels,
    "wavelet_second_level": wavelet_second_level,
    "resampled_geometry": resampled_geometry,
    "resampled_nearest": resampled_nearest,
    "resampled_linear": resampled_linear,
    "resampled_linear_edge": resampled_linear_edge,
    "study_resampled": study_resampled,
    "study_images_resampled": study_images_resampled,
    "study_masks_resampled": study_masks_resampled,
    "study_without_mask": study_without_mask,
    "gabor_filtered": gabor_filtered,
    "filters_applied": filters_applied,
}

# ---------------------------------------------------------------- checking SQL


def _grid_sql(size: float) -> str:
    """Target grid of one volume: counts by half-even rounding."""
    counts = {a: round(4 * (s / size)) for a, s in SPACING.items()}
    return (
        "SELECT CAST(a AS INTEGER) AS tx, CAST(b AS INTEGER) AS ty, CAST(c AS INTEGER) AS tz, "
        + ", ".join(f"t{a}_raw * {size} / {s} AS p{a}" for a, s in SPACING.items())
        + f" FROM (SELECT a, b, c, a AS tx_raw, b AS ty_raw, c AS tz_raw FROM range({counts['x']}) AS r1(a), "
        f"range({counts['y']}) AS r2(b), range({counts['z']}) AS r3(c))"
    )


_OUT = "(px >= 3.5 OR py >= 3.5 OR pz >= 3.5)"


def _nearest_sql(value: str) -> str:
    index = ", ".join(f"CAST(least(floor(p{a} + 0.5), 3) AS INTEGER) AS n{a}" for a in "xyz")
    return f"""near AS (SELECT g.*, {index} FROM grid g),
nearest AS (SELECT v.vec_id, n.tx AS x, n.ty AS y, n.tz AS z,
  CASE WHEN {_OUT} THEN 0 ELSE {value} END AS value
  FROM near n JOIN vox v ON v.x = n.nx AND v.y = n.ny AND v.z = n.nz)"""


def _linear_sql(zero: bool) -> str:
    low = ", ".join(f"CAST(least(floor(p{a}), 3) AS INTEGER) AS l{a}" for a in "xyz")
    corners = " UNION ALL ".join(
        "SELECT tx, ty, tz, px, py, pz, "
        + ", ".join(f"least(l{a} + {d}, 3) AS c{a}" for a, d in zip("xyz", c))
        + ", "
        + " * ".join(f"least(p{a} - l{a}, 1)" if d else f"(1 - least(p{a} - l{a}, 1))" for a, d in zip("xyz", c))
        + " AS w FROM low"
        for c in [(i, j, k) for i in (0, 1) for j in (0, 1) for k in (0, 1)]
    )
    guard = f"CASE WHEN bool_or({_OUT}) THEN 0 ELSE sum(w * v.value) END" if zero else "sum(w * v.value)"
    return f"""low AS (SELECT g.*, {low} FROM grid g), corners AS ({corners}),
linear AS (SELECT v.vec_id, tx AS x, ty AS y, tz AS z, {guard} AS value
  FROM corners c JOIN vox v ON v.x = c.cx AND v.y = c.cy AND v.z = c.cz GROUP BY 1, 2, 3, 4)"""


def _convolved_sql(kernels: dict, per_filter: bool, rounding: bool = True) -> str:
    """Direct sum over every kernel tap with coordinates clamped to the grid."""
    rows = ", ".join(
        f"('{name}', {dx}, {dy}, {dz}, {w!r}::DOUBLE)" for name, taps in kernels.items() for dx, dy, dz, w in taps
    )
    inside = " AND ".join(f"v.{a} = least(greatest(t.{a} - k.d{a}, 0), 3)" for a in "xyz")
    label = "k.filter_id, " if per_filter else ""
    total = sql_round("sum(w * value)") if rounding else "sum(w * value)"
    return f"""WITH {VOX}, kernel(filter_id, dx, dy, dz, w) AS (VALUES {rows}),
place AS (SELECT CAST(i % 4 AS INTEGER) AS x, CAST((i // 4) % 4 AS INTEGER) AS y,
  CAST(i // 16 AS INTEGER) AS z FROM range(64) AS r(i)),
reach AS (SELECT t.x AS tx, t.y AS ty, t.z AS tz, v.x, v.y, v.z, {label}sum(k.w) AS w
  FROM place t, kernel k, place v WHERE {inside} GROUP BY ALL)
SELECT vox.vec_id, tx AS x, ty AS y, tz AS z, {label.replace('k.', '')}{total} AS value
FROM vox JOIN reach USING (x, y, z) GROUP BY ALL"""


def _full(terms) -> list[tuple[int, int, int, float]]:
    return [
        (i, j, k, a * b * c) for tx, ty, tz in terms for i, a in tx for j, b in ty for k, c in tz
    ]


_GAUSS, _CURVE = gaussian_taps(1.0), gaussian_taps(1.0, 2)
_BANK = {
    "gabor-0": gabor_kernel(4, 0.25, 0.0),
    "gabor-90": gabor_kernel(4, 0.25, math.pi / 2),
    "log-sigma-1": _full([(_CURVE, _GAUSS, _GAUSS), (_GAUSS, _CURVE, _GAUSS), (_GAUSS, _GAUSS, _CURVE)]),
    **{
        f"wavelet-{a}{b}{c}": [
            (i, j, k, {"L": HAAR_LOW, "H": HAAR_HIGH}[a][i + 1] * {"L": HAAR_LOW, "H": HAAR_HIGH}[b][j + 1]
             * {"L": HAAR_LOW, "H": HAAR_HIGH}[c][k + 1])
            for i in (-1, 0) for j in (-1, 0) for k in (-1, 0)
        ]
        for a in "LH" for b in "LH" for c in "LH"
    },
}

def _gap_convolved_sql() -> str:
    """Every tap read at its clamped position; NULL unless all nine are there."""
    rows = ", ".join(f"({dx}, {dy}, {w!r}::DOUBLE)" for dx, dy, _, w in UNEVEN)
    at = " AND ".join(
        f"v.{a} = least(greatest(t.{a} - k.d{a}, b.lo_{a}), b.hi_{a})" if a != "z" else "v.z = t.z" for a in "xyz"
    )
    ends = ", ".join(f"min({a}) AS lo_{a}, max({a}) AS hi_{a}" for a in "xyz")
    return f"""WITH {GAPPY}, kernel(dx, dy, w) AS (VALUES {rows}), b AS (SELECT vec_id, {ends} FROM gappy GROUP BY 1)
SELECT t.vec_id, t.x, t.y, t.z, CASE WHEN count(v.value) = 9 THEN {sql_round('sum(k.w * v.value)')} END AS value
FROM gappy t JOIN b USING (vec_id) CROSS JOIN kernel k LEFT JOIN gappy v ON v.vec_id = t.vec_id AND {at}
GROUP BY ALL"""


def _gap_linear_sql() -> str:
    """A row where the voxel before the target is; NULL if a corner with weight is missing."""
    base = _linear_sql(True).split(", corners AS")[0]
    corners = " UNION ALL ".join(
        "SELECT tx, ty, tz, px, py, pz, lx, ly, lz, "
        + ", ".join(f"least(l{a} + {d}, 3) AS c{a}" for a, d in zip("xyz", c))
        + ", "
        + " * ".join(f"least(p{a} - l{a}, 1)" if d else f"(1 - least(p{a} - l{a}, 1))" for a, d in zip("xyz", c))
        + " AS w FROM low"
        for c in [(i, j, k) for i in (0, 1) for j in (0, 1) for k in (0, 1)]
    )
    return f"""WITH {GAPPY}, grid AS ({_grid_sql(1.0)}), {base},
corners AS (SELECT * EXCLUDE (w), sum(w) AS w FROM ({corners}) GROUP BY ALL),
served AS (SELECT g.vec_id, c.* FROM corners c JOIN gappy g ON g.x = c.lx AND g.y = c.ly AND g.z = c.lz)
SELECT s.vec_id, tx AS x, ty AS y, tz AS z, CASE WHEN bool_or({_OUT}) THEN 0
  WHEN count(*) FILTER (w > 0 AND v.value IS NULL) = 0 THEN {sql_round('sum(w * v.value) FILTER (w > 0)')} END AS value
FROM served s LEFT JOIN gappy v ON v.vec_id = s.vec_id AND v.x = cx AND v.y = cy AND v.z = cz GROUP BY 1, 2, 3, 4"""


def _bands_sql(source: str, dilation: int, prefix: str) -> str:
    """All eight Haar bands of a table (vec_id, x, y, z, value), taps ``dilation`` apart."""
    haar = {"L": HAAR_LOW, "H": HAAR_HIGH}
    rows = ", ".join(
        f"('{prefix}-{a}{b}{c}', {i * dilation}, {j * dilation}, {k * dilation}, "
        f"{haar[a][i + 1] * haar[b][j + 1] * haar[c][k + 1]!r}::DOUBLE)"
        for a in "LH" for b in "LH" for c in "LH" for i in (-1, 0) for j in (-1, 0) for k in (-1, 0)
    )
    inside = " AND ".join(f"v.{a} = least(greatest(t.{a} - k.d{a}, 0), 3)" for a in "xyz")
    return f"""SELECT t.vec_id, t.x, t.y, t.z, filter_id, sum(w * v.value) AS value
FROM {source} t CROSS JOIN (VALUES {rows}) k(filter_id, dx, dy, dz, w) JOIN {source} v ON v.vec_id = t.vec_id AND {inside}
GROUP BY ALL"""


def _levels_sql(name: str, keep: str) -> str:
    return f"""WITH {VOX}, one AS ({_bands_sql('vox', 1, 'wavelet')}),
low AS (SELECT * EXCLUDE (filter_id) FROM one WHERE filter_id = 'wavelet-LLL'), two AS ({_bands_sql('low', 2, name)}),
every AS (SELECT * FROM two{keep})
SELECT * REPLACE ({sql_round('value')} AS value) FROM every"""


ORACLES = {
    "convolved_with_gaps": _gap_convolved_sql(),
    "resampled_with_gaps": _gap_linear_sql(),
    "resampled_nearest_with_gaps": f"""WITH {GAPPY}, grid AS ({_grid_sql(1.0)}),
{_nearest_sql('CASE WHEN v.value > 0 THEN 1 ELSE 0 END').replace('JOIN vox v', 'JOIN gappy v')}
SELECT * REPLACE (CAST(value AS INTEGER) AS value) FROM nearest""",
    "wavelet_two_levels": _levels_sql("wavelet2", " UNION ALL SELECT * FROM one WHERE filter_id <> 'wavelet-LLL'"),
    "wavelet_second_level": _levels_sql("wavelet", ""),
    "resampled_geometry": """SELECT vec_id, 4::INTEGER AS nx, 6::INTEGER AS ny, 10::INTEGER AS nz,
 1.0::DOUBLE AS sx, 1.0::DOUBLE AS sy, 1.0::DOUBLE AS sz FROM embeddings""",
    "resampled_nearest": f"""WITH {VOX}, grid AS ({_grid_sql(1.0)}),
{_nearest_sql('CASE WHEN v.value > 0 THEN 1 ELSE 0 END')} SELECT * REPLACE (CAST(value AS INTEGER) AS value) FROM nearest""",
    "resampled_linear": f"""WITH {VOX}, grid AS ({_grid_sql(1.0)}), {_linear_sql(True)}
SELECT * REPLACE ({sql_round('value')} AS value) FROM linear""",
    "resampled_linear_edge": f"""WITH {VOX}, grid AS ({_grid_sql(2.0)}), {_linear_sql(False)}
SELECT * REPLACE ({sql_round('value')} AS value) FROM linear""",
    "study_resampled": f"""WITH {VOX}, grid AS ({_grid_sql(1.0)}), {_linear_sql(True)},
{_nearest_sql('CASE WHEN v.value > 0 THEN 1.0 ELSE 0.0 END')}
SELECT vec_id, x, y, z, 'img.nii.gz' AS series, {sql_round('value')} AS value FROM linear
UNION ALL SELECT vec_id, x, y, z, 'Mask_a.nii.gz', CAST(value AS DOUBLE) FROM nearest WHERE vec_id % 3 <> 0""",
    "study_images_resampled": f"""WITH {VOX}, grid AS ({_grid_sql(1.0)}), {_linear_sql(True)}
SELECT vec_id, x, y, z, 'img.nii.gz' AS series, {sql_round('value')} AS value FROM linear""",
    "study_masks_resampled": f"""WITH {VOX}, grid AS ({_grid_sql(1.0)}), {_nearest_sql('CASE WHEN v.value > 0 THEN 1.0 ELSE 0.0 END')}
SELECT vec_id, x, y, z, 'Mask_a.nii.gz' AS series, CAST(value AS DOUBLE) AS value FROM nearest WHERE vec_id % 3 <> 0""",
    "study_without_mask": "SELECT vec_id FROM embeddings WHERE vec_id % 3 = 0",
    "gabor_filtered": _convolved_sql({"kernel": gabor_kernel(8, 0.5, math.pi / 4)}, False),
    "filters_applied": _convolved_sql(_BANK, True),
}
