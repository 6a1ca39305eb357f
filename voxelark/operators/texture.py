"""First-order and texture features of regions of interest.

Definitions follow the published image-feature standards. Only voxels inside the
region take part. Regions are reduced to small count tables (pairs of levels,
runs, zones, dependences) by ordinary aggregations keyed by coordinates, so a
large region spreads over many tasks; formulas then work on the count tables.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelark.functions.columns import KEYS, col, number
from voxelark.functions.sizing import PART_BYTES, PART_ROWS, attach, materialize, parts_of
from voxelark.operators.blocks import DIRECTIONS, pair_counts, run_pieces, surroundings
from voxelark.operators.masks import XYZ, inside_mask
from voxelark.operators.quantiles import grouped_quantiles, largest_group
from voxelark.operators.zones import zone_sizes

def roi_levels(
    voxels: DataFrame,
    mask: DataFrame | None = None,
    bin_width: float = 25.0,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Region voxels with their grey level, counted from 1 at the region's minimum.

    NULL and NaN voxels are missing: they belong to no region.
    """
    keys = list(keys)
    inside = inside_mask(voxels, mask, keys).withColumn("value", number(F.col("value"))).filter(F.col("value").isNotNull())
    lowest = inside.groupBy(*keys).agg(F.floor(F.min("value") / bin_width).alias("__low"))
    rows = attach(inside, lowest, keys, "inner", "region-minimum")
    level = F.floor(F.col("value") / bin_width) - F.col("__low") + 1
    return rows.select(*[col(k) for k in keys], *XYZ, "value", level.cast("int").alias("level"))


def _entropy(p: Column) -> Column:
    return -F.sum(p * F.log2(p))


# ------------------------------------------------------------------ first order


#: Voxels of the largest region that first-order features take in one task.
REGION_ROWS = 1_000_000
_PROBS = (0.1, 0.25, 0.5, 0.75, 0.9)


def _moments_of(d: Column) -> list[Column]:
    return [
        F.avg(F.abs(d)).alias("MeanAbsoluteDeviation"),
        F.avg(d * d).alias("Variance"),
        F.avg(d * d * d).alias("__m3"),
        F.avg(d * d * d * d).alias("__m4"),
    ]


def _region_statistics(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of regions that fit a task each: every voxel is shuffled once and all passes run where its region lies."""
    v, region = F.col("value"), Window.partitionBy(*keys)
    given = levels.dropna(subset=keys).select(*keys, "value", "level")
    rows = given.repartition(parts_of(levels.sparkSession, levels.count(), PART_ROWS), *[col(k) for k in keys])
    q = F.percentile(number(v), F.array(*[F.lit(p) for p in _PROBS]))
    rows = rows.withColumns({"__n": F.count("*").over(region), "Mean": F.avg(v).over(region), "q": q.over(region)})
    core = F.when(v.between(F.col("q")[0], F.col("q")[4]), v)
    share = F.count("*").over(Window.partitionBy(*keys, "level")) / F.col("__n")
    rows = rows.withColumns({"__core": F.avg(core).over(region), "__p": share})
    return rows.groupBy(*keys).agg(
        F.count("*").alias("__n"),
        F.first("Mean").alias("Mean"),
        F.sum(v * v).alias("Energy"),
        F.min(v).alias("Minimum"),
        F.max(v).alias("Maximum"),
        F.first("q").alias("q"),
        *_moments_of(v - F.col("Mean")),
        F.avg(F.abs(core - F.col("__core"))).alias("RobustMeanAbsoluteDeviation"),
        # Each voxel holds its part of its level's share.
        (-F.sum(F.log2("__p") / F.col("__n"))).alias("Entropy"),
        F.sum(F.col("__p") / F.col("__n")).alias("Uniformity"),
    )


def _spread_statistics(levels: DataFrame, keys: list[str], largest: int) -> DataFrame:
    """The same of regions of any size, by aggregations that combine before they shuffle."""
    v = F.col("value")
    base = levels.groupBy(*keys).agg(
        F.count("*").alias("__n"),
        F.avg(v).alias("Mean"),
        F.sum(v * v).alias("Energy"),
        F.min(v).alias("Minimum"),
        F.max(v).alias("Maximum"),
    )
    q = grouped_quantiles(levels, keys, "value", _PROBS, largest)
    base = materialize(base.join(q, keys), "firstorder")
    rows = attach(levels, base.select(*keys, "Mean", "q"), keys, "inner", part_of=base)
    d = v - F.col("Mean")
    core = F.when(v.between(F.col("q")[0], F.col("q")[4]), v)
    moments = rows.groupBy(*keys).agg(*_moments_of(d), F.avg(core).alias("__core"))
    moments = materialize(moments, "firstorder-moments")
    centered = attach(rows, moments.select(*keys, "__core"), keys, "inner", part_of=moments)
    robust = centered.groupBy(*keys).agg(F.avg(F.abs(core - F.col("__core"))).alias("RobustMeanAbsoluteDeviation"))
    share = F.col("__c") / F.sum("__c").over(Window.partitionBy(*keys))
    histogram = levels.groupBy(*keys, "level").agg(F.count("*").alias("__c"))
    spread = histogram.withColumn("__p", share).groupBy(*keys).agg(
        _entropy(F.col("__p")).alias("Entropy"), F.sum(F.col("__p") * F.col("__p")).alias("Uniformity")
    )
    return base.join(moments, keys).join(robust, keys).join(spread, keys)


def firstorder(
    levels: DataFrame, keys: Sequence[str] = KEYS, voxel_volume: float = 1.0
) -> DataFrame:
    """Intensity statistics per region."""
    keys = list(keys)
    largest = largest_group(levels, keys)
    table = _region_statistics(levels, keys) if largest <= REGION_ROWS else _spread_statistics(levels, keys, largest)
    sd = F.sqrt("Variance")
    return table.select(
        *keys,
        "Energy",
        (F.col("Energy") * float(voxel_volume)).alias("TotalEnergy"),
        "Entropy",
        "Minimum",
        F.col("q")[0].alias("10Percentile"),
        F.col("q")[4].alias("90Percentile"),
        "Maximum",
        "Mean",
        F.col("q")[2].alias("Median"),
        (F.col("q")[3] - F.col("q")[1]).alias("InterquartileRange"),
        (F.col("Maximum") - F.col("Minimum")).alias("Range"),
        "MeanAbsoluteDeviation",
        "RobustMeanAbsoluteDeviation",
        F.sqrt(F.col("Energy") / F.col("__n")).alias("RootMeanSquared"),
        F.coalesce(F.try_divide(F.col("__m3"), F.pow(sd, 3)), F.lit(0.0)).alias("Skewness"),
        F.coalesce(F.try_divide(F.col("__m4"), F.pow("Variance", 2)), F.lit(0.0)).alias("Kurtosis"),
        "Variance",
        "Uniformity",
    )


# ------------------------------------------------------------------------- GLCM


def cooccurrence(levels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Symmetric, normalized level-pair matrix per direction: ``keys, angle, i, j, p``."""
    keys = list(keys)
    counts = pair_counts(levels, keys)
    both = F.array(
        F.struct(F.col("i").alias("a"), F.col("j").alias("b")),
        F.struct(F.col("j").alias("a"), F.col("i").alias("b")),
    )
    mirrored = counts.select(*keys, "angle", "n", F.inline(both))
    summed = mirrored.groupBy(*keys, "angle", F.col("a").alias("i"), F.col("b").alias("j")).agg(
        F.sum("n").alias("n")
    )
    whole = Window.partitionBy(*keys, "angle")
    return summed.select(*keys, "angle", "i", "j", (F.col("n") / F.sum("n").over(whole)).alias("p"))


def glcm(levels: DataFrame, keys: Sequence[str] = KEYS, mcc: bool = False) -> DataFrame:
    """Co-occurrence features, averaged over directions.

    ``mcc`` adds the maximal correlation coefficient (a small eigenvalue problem
    per region and direction).
    """
    keys = list(keys)
    by = [*keys, "angle"]
    # Rows lie by region and direction from their counts on, so windows and sums here need no other shuffle.
    matrix = cooccurrence(levels, keys)
    matrix = materialize(matrix, "glcm") if mcc else matrix
    angles = F.explode(F.array(*[F.lit(a) for a in range(len(DIRECTIONS))])).alias("angle")
    top = levels.groupBy(*keys).agg(F.max("level").alias("__ng")).select(*keys, angles, "__ng")
    p, i, j = F.col("p"), F.col("i"), F.col("j")
    gap = F.abs(i - j)
    rows = matrix.join(top, by).withColumns({"__s": i + j, "__d": gap})
    rows = rows.withColumns(
        {
            "__ps": F.sum(p).over(Window.partitionBy(*by, "__s")),
            "__pd": F.sum(p).over(Window.partitionBy(*by, "__d")),
            "__mu": F.sum(i * p).over(Window.partitionBy(*by)),
            "__px": F.sum(p).over(Window.partitionBy(*by, "i")),
            "__py": F.sum(p).over(Window.partitionBy(*by, "j")),
            "__da": F.sum(F.abs(i - j) * p).over(Window.partitionBy(*by)),
        }
    )
    mu, ng = F.col("__mu"), F.col("__ng")
    around = i + j - 2 * mu
    plain = rows.groupBy(*by).agg(
        F.sum(i * j * p).alias("Autocorrelation"),
        F.first(mu).alias("JointAverage"),
        F.sum(around * around * around * around * p).alias("ClusterProminence"),
        F.sum(around * around * around * p).alias("ClusterShade"),
        F.sum(around * around * p).alias("ClusterTendency"),
        F.sum(gap * gap * p).alias("Contrast"),
        F.sum((i - mu) * (j - mu) * p).alias("__cov"),
        F.sum(gap * p).alias("DifferenceAverage"),
        F.sum(F.pow(gap - F.col("__da"), 2) * p).alias("DifferenceVariance"),
        F.sum(p * p).alias("JointEnergy"),
        _entropy(p).alias("JointEntropy"),
        (-F.sum(p * F.log2(F.col("__px")))).alias("__hx"),
        (-F.sum(p * F.log2(F.col("__py")))).alias("__hy"),
        (-F.sum(p * F.log2(F.col("__ps")))).alias("__hs"),
        (-F.sum(p * F.log2(F.col("__pd")))).alias("__hd"),
        F.sum(p / (1 + gap * gap)).alias("Idm"),
        F.sum(p / (1 + gap * gap / (ng * ng))).alias("Idmn"),
        F.sum(p / (1 + gap)).alias("Id"),
        F.sum(p / (1 + gap / ng)).alias("Idn"),
        F.coalesce(F.sum(F.when(gap > 0, p / (gap * gap))), F.lit(0.0)).alias("InverseVariance"),
        F.max(p).alias("MaximumProbability"),
        F.sum((i + j) * p).alias("SumAverage"),
        F.sum(F.pow(i - mu, 2) * p).alias("SumSquares"),
    )
    # Both mixed entropies equal the sum of the marginal ones.
    mixed = F.col("__hx") + F.col("__hy")
    larger = F.greatest("__hx", "__hy")
    inner = 1 - F.exp(-2 * (mixed - F.col("JointEntropy")))
    plain = plain.withColumns(
        {
            "Correlation": F.coalesce(F.try_divide(F.col("__cov"), F.col("SumSquares")), F.lit(1.0)),
            "Imc1": F.coalesce(F.try_divide(F.col("JointEntropy") - mixed, larger), F.lit(0.0)),
            "Imc2": F.sqrt(F.greatest(inner, F.lit(0.0))),
            "SumEntropy": F.col("__hs"),
            "DifferenceEntropy": F.col("__hd"),
        }
    ).drop("__cov", "__hx", "__hy", "__hs", "__hd")

    if mcc:
        plain = plain.join(_maximal_correlation(matrix, keys), by)
    names = [c for c in plain.columns if c not in by]
    return plain.groupBy(*keys).agg(*[F.avg(n).alias(n) for n in names])


def _maximal_correlation(matrix: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Second largest correlation of each (levels x levels) matrix, per direction."""
    keys = list(keys)

    def second_largest(i: np.ndarray, j: np.ndarray, p: np.ndarray) -> float:
        levels = np.unique(i)
        dense = np.zeros((len(levels), len(levels)))
        dense[np.searchsorted(levels, i), np.searchsorted(levels, j)] = p
        root = np.sqrt(dense.sum(axis=1))
        values = np.sort(np.abs(np.linalg.eigvalsh(dense / np.outer(root, root))))
        return values[-2] if len(values) > 1 else 1.0

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        angle, i, j, p = (pdf[c].to_numpy() for c in ("angle", "i", "j", "p"))
        angles = np.unique(angle)
        values = [second_largest(i[angle == a], j[angle == a], p[angle == a]) for a in angles]
        first = {k: [pdf[k].iloc[0]] * len(angles) for k in keys}
        return pd.DataFrame({**first, "angle": angles, "MCC": values})

    types = ", ".join(f"`{k}` {matrix.schema[k].dataType.simpleString()}" for k in [*keys, "angle"])
    return matrix.groupBy(*keys).applyInPandas(solve, f"{types}, MCC double")


# ----------------------------------------------- runs, zones, dependences (i, j)

# Published names per feature class of the shared emphasis formulas.
RUN_NAMES = {
    "small": "ShortRunEmphasis",
    "large": "LongRunEmphasis",
    "gray": "GrayLevelNonUniformity",
    "gray_norm": "GrayLevelNonUniformityNormalized",
    "size": "RunLengthNonUniformity",
    "size_norm": "RunLengthNonUniformityNormalized",
    "percentage": "RunPercentage",
    "gray_variance": "GrayLevelVariance",
    "size_variance": "RunVariance",
    "entropy": "RunEntropy",
    "low": "LowGrayLevelRunEmphasis",
    "high": "HighGrayLevelRunEmphasis",
    "small_low": "ShortRunLowGrayLevelEmphasis",
    "small_high": "ShortRunHighGrayLevelEmphasis",
    "large_low": "LongRunLowGrayLevelEmphasis",
    "large_high": "LongRunHighGrayLevelEmphasis",
}
ZONE_NAMES = {
    "small": "SmallAreaEmphasis",
    "large": "LargeAreaEmphasis",
    "gray": "GrayLevelNonUniformity",
    "gray_norm": "GrayLevelNonUniformityNormalized",
    "size": "SizeZoneNonUniformity",
    "size_norm": "SizeZoneNonUniformityNormalized",
    "percentage": "ZonePercentage",
    "gray_variance": "GrayLevelVariance",
    "size_variance": "ZoneVariance",
    "entropy": "ZoneEntropy",
    "low": "LowGrayLevelZoneEmphasis",
    "high": "HighGrayLevelZoneEmphasis",
    "small_low": "SmallAreaLowGrayLevelEmphasis",
    "small_high": "SmallAreaHighGrayLevelEmphasis",
    "large_low": "LargeAreaLowGrayLevelEmphasis",
    "large_high": "LargeAreaHighGrayLevelEmphasis",
}
DEPENDENCE_NAMES = {
    "small": "SmallDependenceEmphasis",
    "large": "LargeDependenceEmphasis",
    "gray": "GrayLevelNonUniformity",
    "size": "DependenceNonUniformity",
    "size_norm": "DependenceNonUniformityNormalized",
    "gray_variance": "GrayLevelVariance",
    "size_variance": "DependenceVariance",
    "entropy": "DependenceEntropy",
    "low": "LowGrayLevelEmphasis",
    "high": "HighGrayLevelEmphasis",
    "small_low": "SmallDependenceLowGrayLevelEmphasis",
    "small_high": "SmallDependenceHighGrayLevelEmphasis",
    "large_low": "LargeDependenceLowGrayLevelEmphasis",
    "large_high": "LargeDependenceHighGrayLevelEmphasis",
}


def emphasis(counts: DataFrame, by: Sequence[str], names: dict[str, str]) -> DataFrame:
    """Features of a count table ``by..., i (level), j (size), n``."""
    by = list(by)
    whole = Window.partitionBy(*by)
    rows = counts.withColumns(
        {
            "i": F.col("i").cast("double"),
            "j": F.col("j").cast("double"),
            "__all": F.sum("n").over(whole),
            "__gray": F.sum("n").over(Window.partitionBy(*by, "i")),
            "__size": F.sum("n").over(Window.partitionBy(*by, "j")),
        }
    )
    rows = rows.withColumn("p", F.col("n") / F.col("__all"))
    rows = rows.withColumns(
        {"__mi": F.sum(F.col("p") * F.col("i")).over(whole), "__mj": F.sum(F.col("p") * F.col("j")).over(whole)}
    )
    p, i2, j2 = F.col("p"), F.col("i") * F.col("i"), F.col("j") * F.col("j")
    formulas = {
        "small": F.sum(p / j2),
        "large": F.sum(p * j2),
        "gray": F.sum(p * F.col("__gray")),
        "gray_norm": F.sum(p * F.col("__gray") / F.col("__all")),
        "size": F.sum(p * F.col("__size")),
        "size_norm": F.sum(p * F.col("__size") / F.col("__all")),
        "percentage": F.sum("n") / F.sum(F.col("n") * F.col("j")),
        "gray_variance": F.sum(p * F.pow(F.col("i") - F.col("__mi"), 2)),
        "size_variance": F.sum(p * F.pow(F.col("j") - F.col("__mj"), 2)),
        "entropy": _entropy(p),
        "low": F.sum(p / i2),
        "high": F.sum(p * i2),
        "small_low": F.sum(p / (i2 * j2)),
        "small_high": F.sum(p * i2 / j2),
        "large_low": F.sum(p * j2 / i2),
        "large_high": F.sum(p * i2 * j2),
    }
    return rows.groupBy(*by).agg(*[formulas[k].alias(name) for k, name in names.items()])


def dependence_features(near: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Features of equal-level neighbour counts (the voxel itself included)."""
    counts = near.groupBy(*keys, F.col("level").alias("i"), (F.col("same") + 1).alias("j")).agg(
        F.count("*").alias("n")
    )
    return emphasis(counts, keys, DEPENDENCE_NAMES)


def gldm(levels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return dependence_features(surroundings(levels, keys), keys)


def runs(levels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Maximal runs of equal level per direction: ``keys, angle, i, j (length), n``.

    Blocks count the runs that end inside them. The pieces of longer lines are put together here:
    for pieces that follow each other, position minus the lengths before it is the same.
    """
    keys = list(keys)
    pieces = materialize(run_pieces(levels, keys), "run-pieces")
    line = [*keys, "angle", "i", "px", "py", "pz"]
    before = F.sum("j").over(Window.partitionBy(*line).orderBy("t")) - F.col("j")
    islands = pieces.filter("t is not null").withColumn("__run", F.col("t") - before)
    whole = islands.groupBy(*line, "__run").agg(F.sum("j").alias("j"))
    closed = pieces.filter("t is null").select(*keys, "angle", "i", "j", "n")
    both = closed.unionByName(whole.select(*keys, "angle", "i", "j", F.lit(1).cast("long").alias("n")))
    # Runs of one block are counted already: a sum before the shuffle would hold them all for nothing.
    both = both.repartition(parts_of(pieces.sparkSession, pieces.measured, PART_BYTES), *[col(k) for k in keys], "angle")
    return both.groupBy(*keys, "angle", "i", "j").agg(F.sum("n").alias("n"))


def glrlm(levels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Run-length features, averaged over directions."""
    keys = list(keys)
    table = emphasis(runs(levels, keys), [*keys, "angle"], RUN_NAMES)
    return table.groupBy(*keys).agg(*[F.avg(n).alias(n) for n in RUN_NAMES.values()])


def glszm(levels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Features of connected zones of equal level."""
    counts = (
        zone_sizes(levels, keys)
        .groupBy(*keys, F.col("level").alias("i"), F.col("size").alias("j"))
        .agg(F.count("*").alias("n"))
    )
    return emphasis(counts, keys, ZONE_NAMES)


# ------------------------------------------------------------------------ NGTDM

COARSENESS_LIMIT = 1e6


#: Pairs of levels compared together.
_LEVEL_PAIRS = 1 << 20


def level_pair_sums(level: Column, count: Column, difference: Column) -> Column:
    """Struct of sums over all pairs of a region's levels, from arrays of each level's count and summed difference."""
    shape = "contrast double, busy double, complexity double, strong double"
    return F.pandas_udf(_level_pair_sums, shape)(level, count, difference)


def _level_pair_sums(level: pd.Series, count: pd.Series, difference: pd.Series) -> pd.DataFrame:
    """The sums of some regions.

    Moments and ranks give three of them without looking at pairs. The fourth divides by the sum of
    two shares; it takes the pairs in slices, so memory stays bounded.
    """

    def sums(i: np.ndarray, n: np.ndarray, s: np.ndarray) -> tuple:
        p, size = n / n.sum(), len(i)
        contrast = 2 * (p * (i - (p * i).sum()) ** 2).sum()
        middle = i - i.mean()
        strong = 2 * (p * (size * middle**2 + (middle**2).sum())).sum()
        ranked = np.sort(i * p)
        busy = 2 * (ranked * (2 * np.arange(1, size + 1) - size - 1)).sum()
        complexity, step = 0.0, max(1, _LEVEL_PAIRS // size)
        for k in range(0, size, step):
            a = slice(k, k + step)
            shared = ((p * s)[a, None] + (p * s)[None, :]) / (p[a, None] + p[None, :])
            complexity += (np.abs(i[a, None] - i[None, :]) * shared).sum()
        return contrast, busy, complexity, strong

    found = [sums(*map(np.asarray, row)) for row in zip(level, count, difference)]
    return pd.DataFrame(found, columns=["contrast", "busy", "complexity", "strong"])


def tone_features(near: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Features of the difference between a voxel and its neighbours' mean."""
    keys = list(keys)
    difference = F.abs(F.col("level") - F.col("total") / F.col("n"))
    table = (
        near.filter(F.col("n") > 0)
        .groupBy(*keys, F.col("level").cast("double").alias("i"))
        .agg(F.count("*").alias("n"), F.sum(difference).alias("s"))
    )
    packed = table.groupBy(*keys).agg(
        F.sum("n").cast("double").alias("__nv"),
        F.count("*").alias("__ng"),
        F.sum("s").alias("__s"),
        (F.sum(F.col("n") * F.col("s")) / F.sum("n")).alias("__ps"),
        F.collect_list(F.struct("i", "n", "s")).alias("__l"),
    )
    lists = [F.col("__l")[c].cast("array<double>") for c in ("i", "n", "s")]
    sums = packed.withColumn("__t", level_pair_sums(*lists)).select(*keys, "__nv", "__ng", "__s", "__ps", "__t.*")
    zero = F.lit(0.0)
    pairs = F.col("__ng") * (F.col("__ng") - 1)
    return sums.select(
        *keys,
        F.coalesce(F.try_divide(F.lit(1.0), F.col("__ps")), F.lit(COARSENESS_LIMIT)).alias("Coarseness"),
        F.coalesce(F.try_divide(F.col("contrast"), pairs) * F.col("__s") / F.col("__nv"), zero).alias("Contrast"),
        F.coalesce(F.try_divide(F.col("__ps"), F.col("busy")), zero).alias("Busyness"),
        (F.col("complexity") / F.col("__nv")).alias("Complexity"),
        F.coalesce(F.try_divide(F.col("strong"), F.col("__s")), zero).alias("Strength"),
    )


def ngtdm(levels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return tone_features(surroundings(levels, keys), keys)


# ------------------------------------------------------------------------ shape


def shape(
    mask: DataFrame,
    keys: Sequence[str] = KEYS,
    spacing: Sequence[float] = (1.0, 1.0, 1.0),
) -> DataFrame:
    """Voxel-based shape: volume and axes of the ellipsoid with equal covariance.

    Eigenvalues of the symmetric 3 x 3 covariance come from the closed form for
    cubic characteristic polynomials, so everything stays a built-in expression.
    """
    keys = list(keys)
    a, b, c = [F.col(axis) * float(s) for axis, s in zip(XYZ, spacing)]
    inside = mask.filter(F.col("value") != 0)
    m = inside.groupBy(*keys).agg(
        F.count("*").alias("VoxelCount"),
        F.var_pop(a).alias("xx"),
        F.var_pop(b).alias("yy"),
        F.var_pop(c).alias("zz"),
        F.covar_pop(a, b).alias("xy"),
        F.covar_pop(a, c).alias("xz"),
        F.covar_pop(b, c).alias("yz"),
    )
    m = m.withColumn("mid", (F.col("xx") + F.col("yy") + F.col("zz")) / 3)
    m = m.withColumns({f"{k}c": F.col(k) - F.col("mid") for k in ("xx", "yy", "zz")})
    off = F.pow("xy", 2) + F.pow("xz", 2) + F.pow("yz", 2)
    m = m.withColumn(
        "width", F.sqrt((F.pow("xxc", 2) + F.pow("yyc", 2) + F.pow("zzc", 2) + 2 * off) / 6)
    )
    x, y, z = F.col("xxc"), F.col("yyc"), F.col("zzc")
    det = (
        x * (y * z - F.pow("yz", 2))
        - F.col("xy") * (F.col("xy") * z - F.col("yz") * F.col("xz"))
        + F.col("xz") * (F.col("xy") * F.col("yz") - y * F.col("xz"))
    )
    ratio = F.coalesce(F.try_divide(det, 2 * F.pow("width", 3)), F.lit(0.0))
    m = m.withColumn("phi", F.acos(F.least(F.greatest(ratio, F.lit(-1.0)), F.lit(1.0))) / 3)
    third = 2 * np.pi / 3
    largest = F.col("mid") + 2 * F.col("width") * F.cos("phi")
    smallest = F.col("mid") + 2 * F.col("width") * F.cos(F.col("phi") + third)
    middle = 3 * F.col("mid") - largest - smallest
    zero = F.lit(0.0)
    m = m.withColumns(
        {
            "l1": F.greatest(largest, zero),
            "l2": F.greatest(middle, zero),
            "l3": F.greatest(smallest, zero),
        }
    )
    return m.select(
        *keys,
        "VoxelCount",
        (F.col("VoxelCount") * float(np.prod(spacing))).alias("VoxelVolume"),
        (4 * F.sqrt("l1")).alias("MajorAxisLength"),
        (4 * F.sqrt("l2")).alias("MinorAxisLength"),
        (4 * F.sqrt("l3")).alias("LeastAxisLength"),
        F.sqrt(F.try_divide(F.col("l2"), F.col("l1"))).alias("Elongation"),
        F.sqrt(F.try_divide(F.col("l3"), F.col("l1"))).alias("Flatness"),
    )
