"""Voxel intensities: windowing, binning, scaling, histogram matching.

A voxel table has one row per voxel: volume keys, ``x, y, z`` and ``value``.
Operators needing numbers of the whole volume aggregate once per volume and then
map the voxels with those few numbers attached. NULL and NaN voxels are missing: they
count for nothing and stay NULL. A volume without a mask voxel or without a value has no such
numbers: its voxels stay in the result with NULL, and ``skipped_volumes`` reports it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelark.functions.columns import KEYS, col, number
from voxelark.functions.sizing import attach, materialize
from voxelark.operators.masks import inside_mask
from voxelark.operators.quantiles import grouped_quantiles

# Named intensity windows as (width, level).
WINDOW_PRESETS = {
    "CT_brain": (80, 40),
    "CT_subdural_1": (130, 50),
    "CT_subdural_2": (300, 100),
    "CT_subdural_3": (215, 75),
    "CT_stroke_1": (8, 32),
    "CT_stroke_2": (40, 40),
    "CT_temporal_bones_1": (2800, 600),
    "CT_temporal_bones_2": (4000, 700),
    "CT_HN_soft_tissues_1": (350, 20),
    "CT_HN_soft_tissues_2": (400, 60),
    "CT_HN_soft_tissues_3": (375, 45),
    "CT_lungs": (1500, -600),
    "CT_mediastinum": (350, 50),
    "CT_AB_soft_tissues": (400, 50),
    "CT_liver": (150, 30),
    "CT_SP_soft_tissues": (250, 50),
    "CT_bone": (1800, 400),
    "CT_pancreas": (500, 50),
}


def window_intensity(voxels: DataFrame, level: float, width: float, value: str = "value") -> DataFrame:
    """Clip intensities to ``level`` plus or minus half the ``width``."""
    low, high = float(level) - float(width) / 2, float(level) + float(width) / 2
    v = number(col(value))
    return voxels.withColumn(value, F.when(v.isNotNull(), F.greatest(F.least(v, F.lit(high)), F.lit(low))))


def window_preset(voxels: DataFrame, name: str, value: str = "value") -> DataFrame:
    """Clip with a named window; an unknown name is an error."""
    if name not in WINDOW_PRESETS:
        raise ValueError(f"unknown window {name!r}; use one of {sorted(WINDOW_PRESETS)}")
    width, level = WINDOW_PRESETS[name]
    return window_intensity(voxels, level, width, value)


def _with_range(voxels, keys, value, mask) -> DataFrame:
    """Voxels with the minimum and maximum of their volume (mask voxels only)."""
    limits = inside_mask(voxels, mask, keys).groupBy(*keys).agg(
        F.min(number(col(value))).alias("__min"), F.max(number(col(value))).alias("__max")
    )
    return attach(voxels, limits, keys, "left", "intensity-range")


def skipped_volumes(
    voxels: DataFrame, mask: DataFrame | None = None, keys: Sequence[str] = KEYS, value: str = "value"
) -> DataFrame:
    """``keys, reason`` of the volumes for which binning, scaling or matching has no numbers to work with.

    One aggregation of the voxels; with a mask also of the voxels inside it.
    """
    keys = list(keys)
    some = F.count(number(col(value)))
    found = voxels.groupBy(*[col(k) for k in keys]).agg(some.alias("__values"))
    if mask is None:
        reasons = found.withColumn("reason", F.when(F.col("__values") == 0, "no values"))
    else:
        marked = mask.groupBy(*[col(k) for k in keys]).agg(F.count_if(F.col("value") > 0).alias("__on"))
        inside = inside_mask(voxels, mask, keys).groupBy(*[col(k) for k in keys]).agg(some.alias("__inside"))
        both = found.join(marked, keys, "left").join(inside, keys, "left")
        reasons = both.withColumn(
            "reason",
            F.when(F.col("__values") == 0, "no values")
            .when(F.col("__on").isNull(), "no mask")
            .when(F.col("__on") == 0, "empty mask")
            .when(F.coalesce(F.col("__inside"), F.lit(0)) == 0, "no values inside the mask"),
        )
    return reasons.filter(F.col("reason").isNotNull()).select(*[col(k) for k in keys], "reason")


def bin_intensity(
    voxels: DataFrame,
    n_bins: int | None = None,
    bin_width: float | None = None,
    mask: DataFrame | None = None,
    keys: Sequence[str] = KEYS,
    value: str = "value",
) -> DataFrame:
    """Replace intensities by bin numbers from 0.

    Either a fixed number of equal bins between the volume's minimum and maximum,
    or bins of a fixed width starting at the minimum. Limits come from mask voxels
    and every voxel is binned, clipped to the first and last bin.
    """
    if (n_bins is None) == (bin_width is None):
        raise ValueError("give either n_bins or bin_width")
    rows = _with_range(voxels, list(keys), value, mask)
    v, low, high = number(col(value)), F.col("__min"), F.col("__max")
    if n_bins is not None:
        last = int(n_bins) - 1
        position = F.floor((v - low) / F.nullif(high - low, F.lit(0.0)) * int(n_bins))
        flat = F.when(v < low, 0).otherwise(last)
        binned = F.when(high > low, F.least(F.greatest(position, F.lit(0)), F.lit(last))).otherwise(flat)
    else:
        last = F.greatest(F.ceil((high - low) / float(bin_width)) - 1, F.lit(0))
        position = F.floor((v - low) / float(bin_width))
        binned = F.least(F.greatest(position, F.lit(0)), last)
    # greatest and least skip NULL, so a missing voxel needs its own branch.
    known = v.isNotNull() & low.isNotNull()
    return rows.withColumn(value, F.when(known, binned.cast("int"))).drop("__min", "__max")


def scale_uint8(
    voxels: DataFrame,
    mask: DataFrame | None = None,
    keys: Sequence[str] = KEYS,
    value: str = "value",
) -> DataFrame:
    """Scale to whole numbers 0..255, truncating; values outside are clipped."""
    rows = _with_range(voxels, list(keys), value, mask)
    v, low, high = number(col(value)), F.col("__min"), F.col("__max")
    # Clipped before it becomes an integer: values far outside the mask's range would not fit one.
    scaled = F.least(F.greatest(F.try_divide(v - low, high - low) * 255, F.lit(0.0)), F.lit(255.0)).cast("int")
    return rows.withColumn(value, F.when(v.isNotNull() & low.isNotNull(), scaled)).drop("__min", "__max")


def scale_intensity(
    voxels: DataFrame,
    method: str = "linear",
    mask: DataFrame | None = None,
    keys: Sequence[str] = KEYS,
    value: str = "value",
    low: float = 0.0,
    high: float = 1.0,
    lower_percent: float = 2.0,
    upper_percent: float = 98.0,
) -> DataFrame:
    """Linear scaling to ``[low, high]``, z-score, or robust scaling per volume.

    ``zscore`` divides by the population standard deviation; ``robust`` is
    ``(x - median) / (upper percentile - lower percentile)``.
    """
    keys = list(keys)
    v = number(col(value))
    if method == "linear":
        rows = _with_range(voxels, keys, value, mask)
        share = F.try_divide(v - F.col("__min"), F.col("__max") - F.col("__min"))
        return rows.withColumn(value, share * (high - low) + low).drop("__min", "__max")
    inside = inside_mask(voxels, mask, keys)
    if method == "zscore":
        stats = inside.groupBy(*keys).agg(
            F.avg(number(v)).alias("__c"), F.stddev_pop(number(v)).alias("__s")
        )
    elif method == "robust":
        q = grouped_quantiles(inside, keys, value, [lower_percent / 100, 0.5, upper_percent / 100])
        stats = q.select(*keys, F.col("q")[1].alias("__c"), (F.col("q")[2] - F.col("q")[0]).alias("__s"))
    else:
        raise ValueError(f"unknown scaling method {method!r}")
    rows = attach(voxels, stats, keys, "left", "intensity-stats")
    return rows.withColumn(value, F.try_divide(v - F.col("__c"), F.col("__s"))).drop("__c", "__s")


def histogram_knots(
    voxels: DataFrame,
    keys: Sequence[str],
    n_points: int = 10,
    value: str = "value",
) -> DataFrame:
    """Knots of the quantile map per volume: ``keys..., min, knots``.

    The knots are the mean, ``n_points`` evenly spaced quantiles of the values at
    or above the mean, and the maximum.
    """
    keys = list(keys)
    v = number(col(value))
    base = materialize(
        voxels.groupBy(*keys).agg(
            F.min(v).alias("__lo"), F.avg(v).alias("__mean"), F.max(v).alias("__hi")
        ),
        "histogram-base",
    )
    above = attach(voxels, base.select(*keys, "__mean"), keys, "inner", part_of=base).filter(
        col(value) >= F.col("__mean")
    )
    probs = [j / (n_points + 1) for j in range(1, n_points + 1)]
    quantiles = grouped_quantiles(above, keys, value, probs)
    return base.join(quantiles, keys).select(
        *keys,
        F.col("__lo").alias("low"),
        F.concat(F.array("__mean"), F.col("q"), F.array("__hi")).alias("knots"),
    )


def match_histogram(
    voxels: DataFrame,
    reference: DataFrame,
    mask: DataFrame | None = None,
    reference_mask: DataFrame | None = None,
    keys: Sequence[str] = KEYS,
    n_points: int = 10,
    value: str = "value",
) -> DataFrame:
    """Map each volume's intensities onto those of one reference volume.

    Piecewise linear between the knots of :func:`histogram_knots`. Below the mean
    the map joins the two minima and means; above the last knot it continues with
    the last slope. With an image mask only mask voxels are used and changed; with
    a reference mask only its voxels describe the reference.
    """
    keys = list(keys)
    ref = inside_mask(reference, reference_mask, keys).withColumn("__ref", F.lit(1))
    target = histogram_knots(ref, ["__ref"], n_points, value).first()
    if target is None:
        raise ValueError("the reference volume has no voxels")
    ref_low, ref_knots = target["low"], target["knots"]
    source = histogram_knots(inside_mask(voxels, mask, keys), keys, n_points, value)
    rows = attach(voxels, source, keys, "left", "histogram-knots")
    mapped = _piecewise(number(col(value)), F.col("low"), F.col("knots"), ref_low, ref_knots)
    if mask is not None:
        marked = mask.filter(F.col("value") > 0).select(*keys, "x", "y", "z", F.lit(True).alias("__in"))
        rows = rows.join(marked, [*keys, "x", "y", "z"], "left")
        mapped = F.when(F.col("__in"), mapped).otherwise(col(value))
    return rows.select(*[mapped.alias(c) if c == value else col(c) for c in voxels.columns])


def _piecewise(v: Column, low: Column, knots: Column, ref_low: float, ref_knots: Sequence[float]) -> Column:
    """Linear interpolation; the segment is found by counting knots passed."""
    size = len(ref_knots)
    passed = F.lit(0)
    for j in range(size):
        passed = passed + F.when(v >= knots[j], 1).otherwise(0)
    target = F.array(*[F.lit(float(k)) for k in ref_knots])

    def line(x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
        return y0 + (v - x0) * F.coalesce(F.try_divide(y1 - y0, x1 - x0), F.lit(0.0))

    segment = F.least(passed, F.lit(size - 1))
    inner = line(
        F.element_at(knots, segment), F.element_at(knots, segment + 1),
        F.element_at(target, segment), F.element_at(target, segment + 1),
    )
    below = line(low, knots[0], F.lit(float(ref_low)), F.lit(float(ref_knots[0])))
    return F.when(v == knots[size - 1], F.lit(float(ref_knots[-1]))).when(passed == 0, below).otherwise(inner)
