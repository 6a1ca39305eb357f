"""First-order, texture and shape features of regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxelark.operators import texture
from voxelark.operators.zones import zone_sizes
from voxelark.plans.catalog.common import GAPPY, VOX, gappy_grid, load, rounded, sql_round, voxel_grid

K = ["vec_id"]
WIDTH = 0.07
SPACING = (1.0, 1.5, 2.5)


def _levels(spark, sf_dir):
    """Region: every voxel above -0.12, levels of width 0.07."""
    image = voxel_grid(load(spark, sf_dir, "embeddings"))
    mask = image.withColumn("value", F.when(F.col("value") > -0.12, 1).otherwise(0))
    return texture.roi_levels(image, mask, WIDTH, K)


def _features(compute):
    def run(spark, sf_dir):
        return rounded(compute(_levels(spark, sf_dir), K))

    return run


def level_pairs(spark, sf_dir):
    return rounded(texture.cooccurrence(_levels(spark, sf_dir), K))


def level_runs(spark, sf_dir):
    return texture.runs(_levels(spark, sf_dir), K)


def level_zones(spark, sf_dir):
    zones = zone_sizes(_levels(spark, sf_dir), K)
    return zones.groupBy("vec_id", "level", "size").agg(F.count("*").alias("n"))


def shape_features(spark, sf_dir):
    image = voxel_grid(load(spark, sf_dir, "embeddings"))
    mask = image.withColumn("value", F.when(F.col("value") > 0.05, 1).otherwise(0))
    return rounded(texture.shape(mask, K, SPACING), 5)


def maximal_correlation(spark, sf_dir):
    return rounded(texture.glcm(_levels(spark, sf_dir), K, mcc=True).select("vec_id", "MCC"))


def levels_with_gaps(spark, sf_dir):
    """Levels of regions in which voxels are absent, NULL and NaN."""
    image = gappy_grid(load(spark, sf_dir, "embeddings"))
    return rounded(texture.roi_levels(image, None, WIDTH, K))


QUERIES = {
    "levels_with_gaps": levels_with_gaps,
    "firstorder_features": _features(lambda lv, k: texture.firstorder(lv, k, 3.75)),
    "glcm_features": _features(texture.glcm),
    "glcm_maximal_correlation": maximal_correlation,
    "gldm_features": _features(texture.gldm),
    "glrlm_features": _features(texture.glrlm),
    "glszm_features": _features(texture.glszm),
    "ngtdm_features": _features(texture.ngtdm),
    "shape_features": shape_features,
    "level_pairs": level_pairs,
    "level_runs": level_runs,
    "level_zones": level_zones,
}

# ---------------------------------------------------------------- checking SQL

_LV = f"""{VOX}, roi AS (SELECT * FROM vox WHERE value > -0.12),
lv AS (SELECT vec_id, x, y, z, value,
  CAST(floor(value / {WIDTH}) - floor(min(value) OVER (PARTITION BY vec_id) / {WIDTH}) + 1 AS INTEGER) AS level
  FROM roi)"""
_DIRECTIONS = ", ".join(f"({a}, {dx}, {dy}, {dz})" for a, (dx, dy, dz) in enumerate(texture.DIRECTIONS))
_PAIRS = f"""dirs(angle, dx, dy, dz) AS (VALUES {_DIRECTIONS}),
pairs AS (SELECT a.vec_id, d.angle, a.level AS i, b.level AS j FROM lv a, dirs d, lv b
  WHERE b.vec_id = a.vec_id AND b.x = a.x + d.dx AND b.y = a.y + d.dy AND b.z = a.z + d.dz),
sym AS (SELECT vec_id, angle, i, j FROM pairs UNION ALL SELECT vec_id, angle, j, i FROM pairs),
cnt AS (SELECT vec_id, angle, i, j, count(*) AS n FROM sym GROUP BY ALL),
pm AS (SELECT vec_id, angle, i, j, n / sum(n) OVER (PARTITION BY vec_id, angle) AS p FROM cnt)"""


def _glcm_sql() -> str:
    ng = "(SELECT vec_id, max(level) AS ng FROM lv GROUP BY 1)"
    parts = {
        "Autocorrelation": "sum(i * j * p)",
        "JointAverage": "max(mu)",
        "ClusterProminence": "sum((i + j - 2 * mu) ** 4 * p)",
        "ClusterShade": "sum((i + j - 2 * mu) ** 3 * p)",
        "ClusterTendency": "sum((i + j - 2 * mu) ** 2 * p)",
        "Contrast": "sum((i - j) ** 2 * p)",
        "Correlation": """CASE WHEN sum((i - mu) ** 2 * p) = 0 THEN 1
          ELSE sum((i - mu) * (j - mu) * p) / sum((i - mu) ** 2 * p) END""",
        "DifferenceAverage": "sum(abs(i - j) * p)",
        "DifferenceVariance": "sum((abs(i - j) - da) ** 2 * p)",
        "JointEnergy": "sum(p * p)",
        "JointEntropy": "-sum(p * log2(p))",
        "Idm": "sum(p / (1 + (i - j) ** 2))",
        "Idmn": "sum(p / (1 + (i - j) ** 2 / (ng * ng)))",
        "Id": "sum(p / (1 + abs(i - j)))",
        "Idn": "sum(p / (1 + abs(i - j) / ng))",
        "InverseVariance": "coalesce(sum(CASE WHEN i <> j THEN p / (i - j) ** 2 END), 0)",
        "MaximumProbability": "max(p)",
        "SumAverage": "sum((i + j) * p)",
        "SumSquares": "sum((i - mu) ** 2 * p)",
    }
    extra = ["SumEntropy", "DifferenceEntropy", "Imc1", "Imc2"]
    return f"""WITH {_LV}, {_PAIRS},
mx AS (SELECT vec_id, angle, i, sum(p) AS px FROM pm GROUP BY ALL),
mo AS (SELECT vec_id, angle, sum(i * p) AS mu, sum(abs(i - j) * p) AS da FROM pm GROUP BY 1, 2),
per AS (SELECT vec_id, angle, {", ".join(f"{e} AS {n}" for n, e in parts.items())}
  FROM pm JOIN mo USING (vec_id, angle) JOIN {ng} USING (vec_id) GROUP BY 1, 2),
hx AS (SELECT vec_id, angle, -sum(px * log2(px)) AS hx FROM mx GROUP BY 1, 2),
h1 AS (SELECT pm.vec_id, pm.angle, -sum(p * log2(a.px * b.px)) AS hxy1 FROM pm
  JOIN mx a ON a.vec_id = pm.vec_id AND a.angle = pm.angle AND a.i = pm.i
  JOIN mx b ON b.vec_id = pm.vec_id AND b.angle = pm.angle AND b.i = pm.j GROUP BY 1, 2),
h2 AS (SELECT a.vec_id, a.angle, -sum(a.px * b.px * log2(a.px * b.px)) AS hxy2 FROM mx a
  JOIN mx b ON a.vec_id = b.vec_id AND a.angle = b.angle GROUP BY 1, 2),
se AS (SELECT vec_id, angle, -sum(q * log2(q)) AS SumEntropy FROM
  (SELECT vec_id, angle, i + j AS k, sum(p) AS q FROM pm GROUP BY ALL) GROUP BY 1, 2),
de AS (SELECT vec_id, angle, -sum(q * log2(q)) AS DifferenceEntropy FROM
  (SELECT vec_id, angle, abs(i - j) AS k, sum(p) AS q FROM pm GROUP BY ALL) GROUP BY 1, 2),
every AS (SELECT *, CASE WHEN hx <= 0 THEN 0 ELSE (JointEntropy - hxy1) / hx END AS Imc1,
  sqrt(greatest(1 - exp(-2 * (hxy2 - JointEntropy)), 0)) AS Imc2
  FROM per JOIN hx USING (vec_id, angle) JOIN h1 USING (vec_id, angle) JOIN h2 USING (vec_id, angle)
  JOIN se USING (vec_id, angle) JOIN de USING (vec_id, angle))
SELECT vec_id, {", ".join(sql_round(f"avg({n})", 6 if n not in ("Imc2",) else 6) + f" AS {n}" for n in [*parts, *extra])}
FROM every GROUP BY 1"""


_EMPHASIS = {
    "small": "sum(n / j ** 2) / max(nz)",
    "large": "sum(n * j ** 2) / max(nz)",
    "gray": "max(g2) / max(nz)",
    "gray_norm": "max(g2) / max(nz) ** 2",
    "size": "max(s2) / max(nz)",
    "size_norm": "max(s2) / max(nz) ** 2",
    "percentage": "max(nz) / max(np)",
    "gray_variance": "sum(n / nz * (i - mi) ** 2)",
    "size_variance": "sum(n / nz * (j - mj) ** 2)",
    "entropy": "-sum(n / nz * log2(n / nz))",
    "low": "sum(n / i ** 2) / max(nz)",
    "high": "sum(n * i ** 2) / max(nz)",
    "small_low": "sum(n / (i ** 2 * j ** 2)) / max(nz)",
    "small_high": "sum(n * i ** 2 / j ** 2) / max(nz)",
    "large_low": "sum(n * j ** 2 / i ** 2) / max(nz)",
    "large_high": "sum(n * i ** 2 * j ** 2) / max(nz)",
}


def _emphasis_sql(counts: str, names: dict[str, str]) -> str:
    """``counts`` is SQL defining cm(vec_id, angle, i, j, n)."""
    return f"""WITH RECURSIVE {_LV}, {counts},
tot AS (SELECT vec_id, angle, sum(n) AS nz, sum(n * i) / sum(n) AS mi, sum(n * j) / sum(n) AS mj
  FROM cm GROUP BY 1, 2),
g AS (SELECT vec_id, angle, sum(k ** 2) AS g2 FROM
  (SELECT vec_id, angle, i, sum(n) AS k FROM cm GROUP BY ALL) GROUP BY 1, 2),
s AS (SELECT vec_id, angle, sum(k ** 2) AS s2 FROM
  (SELECT vec_id, angle, j, sum(n) AS k FROM cm GROUP BY ALL) GROUP BY 1, 2),
v AS (SELECT vec_id, count(*) AS np FROM lv GROUP BY 1),
f AS (SELECT vec_id, angle, {", ".join(f"{_EMPHASIS[k]} AS {n}" for k, n in names.items())}
  FROM cm JOIN tot USING (vec_id, angle) JOIN g USING (vec_id, angle) JOIN s USING (vec_id, angle)
  JOIN v USING (vec_id) GROUP BY 1, 2)
SELECT vec_id, {", ".join(sql_round(f"avg({n})") + f" AS {n}" for n in names.values())} FROM f GROUP BY 1"""


_NEAR = """nb AS (SELECT a.vec_id, a.x, a.y, a.z, a.level AS i, b.level AS o FROM lv a LEFT JOIN lv b
  ON a.vec_id = b.vec_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.z - b.z) <= 1
  AND (a.x <> b.x OR a.y <> b.y OR a.z <> b.z)),
near AS (SELECT vec_id, x, y, z, i, count(o) AS k, avg(o) AS m,
  count(CASE WHEN o = i THEN 1 END) + 1 AS j FROM nb GROUP BY ALL)"""
_DEPENDENCE = f"{_NEAR}, cm AS (SELECT vec_id, 0 AS angle, i, j, count(*) AS n FROM near GROUP BY ALL)"
# Runs: a voxel starts one if the voxel before it in the direction has another level;
# the run's length is the distance to the first later place that ends it.
_RUNS = f"""dirs(angle, dx, dy, dz) AS (VALUES {_DIRECTIONS}),
steps AS (SELECT a.vec_id, d.angle, a.x, a.y, a.z, a.level AS i, r.t FROM lv a, dirs d, range(1, 5) AS r(t)),
hit AS (SELECT s.vec_id, s.angle, s.x, s.y, s.z, s.i, s.t, (b.level IS NOT NULL AND b.level = s.i) AS same
  FROM steps s JOIN dirs d USING (angle) LEFT JOIN lv b ON b.vec_id = s.vec_id AND b.x = s.x + s.t * d.dx
  AND b.y = s.y + s.t * d.dy AND b.z = s.z + s.t * d.dz),
len AS (SELECT vec_id, angle, x, y, z, i, min(CASE WHEN NOT same THEN t END) AS j FROM hit GROUP BY ALL),
heads AS (SELECT l.* FROM len l JOIN dirs d USING (angle) LEFT JOIN lv b ON b.vec_id = l.vec_id
  AND b.x = l.x - d.dx AND b.y = l.y - d.dy AND b.z = l.z - d.dz WHERE b.level IS NULL OR b.level <> l.i),
cm AS (SELECT vec_id, angle, i, j, count(*) AS n FROM heads GROUP BY ALL)"""
_ZONES = """link AS (SELECT a.vec_id, a.level, a.z * 16 + a.y * 4 + a.x AS a, b.z * 16 + b.y * 4 + b.x AS b
  FROM lv a JOIN lv b ON a.vec_id = b.vec_id AND a.level = b.level AND abs(a.x - b.x) <= 1
  AND abs(a.y - b.y) <= 1 AND abs(a.z - b.z) <= 1),
reach(vec_id, level, a, b) AS (SELECT vec_id, level, a, b FROM link
  UNION SELECT r.vec_id, r.level, r.a, l.b FROM reach r JOIN link l ON l.vec_id = r.vec_id AND l.a = r.b),
zone AS (SELECT vec_id, level, a, min(b) AS root FROM reach GROUP BY ALL),
sz AS (SELECT vec_id, level, root, count(*) AS j FROM zone GROUP BY ALL),
cm AS (SELECT vec_id, 0 AS angle, level AS i, j, count(*) AS n FROM sz GROUP BY ALL)"""

ORACLES = {
    "levels_with_gaps": f"""WITH {GAPPY}, g AS (SELECT * FROM gappy WHERE value IS NOT NULL)
SELECT vec_id, x, y, z, {sql_round('value')} AS value,
 CAST(floor(value / {WIDTH}) - floor(min(value) OVER (PARTITION BY vec_id) / {WIDTH}) + 1 AS INTEGER) AS level FROM g""",
    "firstorder_features": f"""WITH {_LV},
b AS (SELECT vec_id, count(*) AS n, avg(value) AS m, sum(value * value) AS e, min(value) AS lo, max(value) AS hi,
  quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.9) AS p90, quantile_cont(value, 0.5) AS md,
  quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM lv GROUP BY 1),
c AS (SELECT vec_id, avg(abs(value - m)) AS mad, avg((value - m) ** 2) AS m2, avg((value - m) ** 3) AS m3,
  avg((value - m) ** 4) AS m4, avg(CASE WHEN value BETWEEN p10 AND p90 THEN value END) AS rm
  FROM lv JOIN b USING (vec_id) GROUP BY 1),
r AS (SELECT vec_id, avg(abs(value - rm)) AS rmad FROM lv JOIN b USING (vec_id) JOIN c USING (vec_id)
  WHERE value BETWEEN p10 AND p90 GROUP BY 1),
h AS (SELECT vec_id, level, count(*) / sum(count(*)) OVER (PARTITION BY vec_id) AS p FROM lv GROUP BY 1, 2),
u AS (SELECT vec_id, -sum(p * log2(p)) AS ent, sum(p * p) AS uni FROM h GROUP BY 1)
SELECT vec_id, {sql_round('e')} AS Energy, {sql_round('e * 3.75')} AS TotalEnergy, {sql_round('ent')} AS Entropy,
 {sql_round('lo')} AS Minimum, {sql_round('p10')} AS "10Percentile", {sql_round('p90')} AS "90Percentile",
 {sql_round('hi')} AS Maximum, {sql_round('m')} AS Mean, {sql_round('md')} AS Median,
 {sql_round('iqr')} AS InterquartileRange, {sql_round('hi - lo')} AS "Range",
 {sql_round('mad')} AS MeanAbsoluteDeviation, {sql_round('rmad')} AS RobustMeanAbsoluteDeviation,
 {sql_round('sqrt(e / n)')} AS RootMeanSquared, {sql_round('coalesce(m3 / nullif(m2 ** 1.5, 0), 0)')} AS Skewness,
 {sql_round('coalesce(m4 / nullif(m2 ** 2, 0), 0)')} AS Kurtosis, {sql_round('m2')} AS Variance,
 {sql_round('uni')} AS Uniformity
FROM b JOIN c USING (vec_id) JOIN r USING (vec_id) JOIN u USING (vec_id)""",
    "glcm_features": _glcm_sql(),
    "gldm_features": _emphasis_sql(_DEPENDENCE, texture.DEPENDENCE_NAMES),
    "glrlm_features": _emphasis_sql(_RUNS, texture.RUN_NAMES),
    "glszm_features": _emphasis_sql(_ZONES, texture.ZONE_NAMES),
    "ngtdm_features": f"""WITH {_LV}, {_NEAR},
t AS (SELECT vec_id, i, count(*) AS n, sum(abs(i - m)) AS s FROM near WHERE k > 0 GROUP BY 1, 2),
q AS (SELECT *, n / sum(n) OVER (PARTITION BY vec_id) AS p FROM t),
one AS (SELECT vec_id, sum(n) AS nv, count(*) AS ng, sum(s) AS ss, sum(p * s) AS ps FROM q GROUP BY 1),
two AS (SELECT a.vec_id, sum(a.p * b.p * (a.i - b.i) ** 2) AS c, sum(abs(a.i * a.p - b.i * b.p)) AS b,
  sum(abs(a.i - b.i) * (a.p * a.s + b.p * b.s) / (a.p + b.p)) AS x, sum((a.p + b.p) * (a.i - b.i) ** 2) AS st
  FROM q a JOIN q b USING (vec_id) GROUP BY 1)
SELECT vec_id, {sql_round('CASE WHEN ps = 0 THEN 1e6 ELSE 1 / ps END')} AS Coarseness,
 {sql_round('coalesce(c / nullif(ng * (ng - 1), 0) * ss / nv, 0)')} AS Contrast,
 {sql_round('coalesce(ps / nullif(b, 0), 0)')} AS Busyness, {sql_round('x / nv')} AS Complexity,
 {sql_round('coalesce(st / nullif(ss, 0), 0)')} AS Strength FROM one JOIN two USING (vec_id)""",
    "level_pairs": f"WITH {_LV}, {_PAIRS} SELECT vec_id, CAST(angle AS INTEGER) AS angle, i, j, {sql_round('p')} AS p FROM pm",
    "level_runs": f"WITH {_LV}, {_RUNS} SELECT vec_id, CAST(angle AS INTEGER) AS angle, i, j, n FROM cm",
    "level_zones": f"WITH RECURSIVE {_LV}, {_ZONES} SELECT vec_id, i AS level, j AS size, n FROM cm",
    "shape_features": f"""WITH {VOX}, inside AS (SELECT vec_id, x * 1.0 AS a, y * 1.5 AS b, z * 2.5 AS c
  FROM vox WHERE value > 0.05),
m AS (SELECT vec_id, count(*) AS n, var_pop(a) AS xx, var_pop(b) AS yy, var_pop(c) AS zz, covar_pop(a, b) AS xy,
  covar_pop(a, c) AS xz, covar_pop(b, c) AS yz FROM inside GROUP BY 1),
t AS (SELECT *, (xx + yy + zz) / 3 AS q FROM m),
w AS (SELECT *, sqrt(((xx - q) ** 2 + (yy - q) ** 2 + (zz - q) ** 2 + 2 * (xy ** 2 + xz ** 2 + yz ** 2)) / 6) AS p
  FROM t),
f AS (SELECT *, acos(least(greatest(coalesce(((xx - q) * ((yy - q) * (zz - q) - yz ** 2)
    - xy * (xy * (zz - q) - yz * xz) + xz * (xy * yz - (yy - q) * xz)) / nullif(2 * p ** 3, 0), 0), -1), 1)) / 3 AS phi
  FROM w),
e AS (SELECT *, greatest(q + 2 * p * cos(phi), 0) AS l1, greatest(q + 2 * p * cos(phi + 2 * pi() / 3), 0) AS l3,
  greatest(q - 2 * p * cos(phi) - 2 * p * cos(phi + 2 * pi() / 3), 0) AS l2 FROM f)
SELECT vec_id, n AS VoxelCount, {sql_round('n * 3.75', 5)} AS VoxelVolume,
 {sql_round('4 * sqrt(l1)', 5)} AS MajorAxisLength, {sql_round('4 * sqrt(l2)', 5)} AS MinorAxisLength,
 {sql_round('4 * sqrt(l3)', 5)} AS LeastAxisLength, {sql_round('sqrt(l2 / nullif(l1, 0))', 5)} AS Elongation,
 {sql_round('sqrt(l3 / nullif(l1, 0))', 5)} AS Flatness FROM e""",
}
