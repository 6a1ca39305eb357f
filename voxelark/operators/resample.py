"""Resampling volumes to isotropic voxels.

Interpolation is separable, so it runs one axis at a time. A source voxel works
out which target positions it serves and emits them: nearest-neighbour resampling
needs no shuffle at all, linear needs one window per axis for the next voxel on
the line. Nothing is joined voxel to voxel.

Neighbours are taken by position. A target whose source voxel is absent has no row; one
that needs an absent, NULL or NaN neighbour is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelark.functions.columns import KEYS, col, number
from voxelark.functions.sizing import attach
from voxelark.operators.masks import XYZ, classify_series


def resampled_volumes(volumes: DataFrame, size: float) -> DataFrame:
    """Volume table after resampling: new counts (half-even) and spacing."""
    updates = {}
    for axis in XYZ:
        scaled = F.col(f"n{axis}") * (F.col(f"s{axis}") / F.lit(float(size)))
        updates[f"n{axis}"] = F.bround(scaled).cast("int")
        updates[f"s{axis}"] = F.lit(float(size))
    return volumes.withColumns(updates)


def _targets(axis: str, method: str, step: Column, new: Column) -> Column:
    """Target positions served by the source voxel at this axis position.

    Position ``t`` lies at ``t * step`` in source voxels. Nearest rounds half up,
    linear takes the voxel at or before it. The last voxel also serves everything
    beyond.
    """
    here = F.col(axis)
    half = 0.5 if method == "nearest" else 0.0
    low = F.greatest(F.floor((here - half) / step) - 1, F.lit(0).cast("long"))
    high = F.least(F.ceil((here + 1 - half) / step) + 1, new.cast("long") - 1)
    last = here == F.col(f"n{axis}") - 1
    high = F.when(last, new.cast("long") - 1).otherwise(high)
    span = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    serving = lambda t: F.floor(t * step + half)
    return F.filter(span, lambda t: (serving(t) == here) | (last & (serving(t) > here)))


def _outside(axis: str, target: Column, step: Column) -> Column:
    """More than half a voxel beyond the last source voxel."""
    return target * step >= F.col(f"n{axis}") - F.lit(0.5)


def resample(
    voxels: DataFrame,
    volumes: DataFrame,
    size: float = 1.0,
    method: str = "linear",
    keys: Sequence[str] = KEYS,
    outside: str = "zero",
) -> DataFrame:
    """Dense volumes on a grid of ``size`` spacing with origin and axes kept.

    ``volumes`` has ``keys..., nx, ny, nz, sx, sy, sz``. Targets more than half a
    voxel beyond the last source voxel become 0, or repeat the edge with
    ``outside="edge"``.
    """
    if method not in ("nearest", "linear"):
        raise ValueError(f"unknown interpolation {method!r}; use nearest or linear")
    if outside not in ("zero", "edge"):
        raise ValueError("outside must be zero or edge")
    keys = list(keys)
    geometry = volumes.select(*keys, *[f"n{a}" for a in XYZ], *[f"s{a}" for a in XYZ])
    rows = attach(voxels, geometry, keys, "inner", "geometry")
    kind = voxels.schema["value"].dataType
    rows = rows.withColumn("__out", F.lit(False))
    if method == "linear":
        rows = rows.withColumn("value", number(F.col("value")))
    for axis in XYZ:
        step = F.lit(float(size)) / F.col(f"s{axis}")
        new = F.bround(F.col(f"n{axis}") * (F.col(f"s{axis}") / F.lit(float(size))))
        if method == "linear":
            line = Window.partitionBy(*keys, *[a for a in XYZ if a != axis]).orderBy(axis)
            edge = F.col(axis) == F.col(f"n{axis}") - 1
            adjacent = F.lead(axis).over(line) == F.col(axis) + 1
            following = F.when(edge, F.col("value")).when(adjacent, F.lead("value").over(line))
            rows = rows.withColumn("__next", following)
        rows = rows.withColumn("__t", F.explode(_targets(axis, method, step, new)))
        value = F.col("value")
        if method == "linear":
            share = F.col("__t") * step - F.col(axis)
            between = value + (F.col("__next") - value) * F.least(share, F.lit(1.0))
            value = F.when(share == 0, value).otherwise(between)
        beyond = F.col("__out") | _outside(axis, F.col("__t"), step)
        rows = rows.withColumns({"value": value, "__out": beyond, axis: F.col("__t").cast("int")})
    out = F.col("value").cast(kind) if method == "nearest" else F.col("value")
    if outside == "zero":
        out = F.when(F.col("__out"), F.lit(0).cast(kind if method == "nearest" else "double")).otherwise(out)
    return rows.select(*[out.alias("value") if c == "value" else col(c) for c in voxels.columns])


def resample_study(
    voxels: DataFrame,
    volumes: DataFrame,
    size: float = 1.0,
    keys: Sequence[str] = KEYS,
    name: str = "series",
    image_method: str = "linear",
    mask_method: str = "nearest",
    has_masks: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Images and masks each with their own interpolation.

    Returns the resampled voxels and the keys holding a single series, which have
    no mask. Without masks in the study only images are resampled.
    """
    keys = list(keys)
    kinds = classify_series(voxels, keys, name)
    tagged = attach(voxels, kinds, [*keys, name], "inner", "series-kinds")
    full = [*keys, name]
    images = resample(tagged.filter(F.col("kind") == "image").drop("kind"), volumes, size, image_method, full)
    lonely = kinds.groupBy(*keys).count().filter(F.col("count") < 2).select(*keys)
    if not has_masks:
        return images, lonely
    masks = resample(tagged.filter(F.col("kind") == "mask").drop("kind"), volumes, size, mask_method, full)
    masks = attach(masks, lonely.withColumn("__lone", F.lit(True)), keys, "left", "lonely")
    masks = masks.filter(F.col("__lone").isNull()).drop("__lone")
    return images.unionByName(masks), lonely
