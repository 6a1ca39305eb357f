"""Mask algebra on voxel tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelark.functions.columns import KEYS, col
from voxelark.functions.sizing import attach

XYZ = ("x", "y", "z")
# Fixed value: how mask files are recognised by name.
MASK_FILE = r"(?i).*mask.*.nii.gz"


def join_mask(
    image: DataFrame, mask: DataFrame, keys: Sequence[str] = KEYS, how: str = "inner"
) -> DataFrame:
    """Image voxels with the mask value at the same place as ``mask``.

    The join key includes the coordinates, so even a single huge volume spreads
    evenly over the tasks.
    """
    on = [*keys, *XYZ]
    return image.join(mask.select(*on, F.col("value").alias("mask")), on, how)


def inside_mask(image: DataFrame, mask: DataFrame | None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Only image voxels whose mask value is positive; all of them without a mask."""
    if mask is None:
        return image
    on = [*keys, *XYZ]
    return image.join(mask.filter(F.col("value") > 0).select(*on), on, "left_semi")


def threshold_mask(
    image: DataFrame,
    mask: DataFrame,
    low: float | None = None,
    high: float | None = None,
    keys: Sequence[str] = KEYS,
    positive_only: bool = False,
) -> DataFrame:
    """Keep mask values where the image lies within the bounds (inclusive), else 0.

    ``positive_only`` also drops voxels at or below zero when no lower bound is given.
    """
    on = [*keys, *XYZ]
    joined = mask.join(image.select(*on, F.col("value").alias("__image")), on)
    kept = F.lit(True)
    if low is not None:
        kept = kept & (F.col("__image") >= float(low))
    elif positive_only:
        kept = kept & (F.col("__image") > 0)
    if high is not None:
        kept = kept & (F.col("__image") <= float(high))
    value = F.when(kept, F.col("value")).otherwise(F.lit(0).cast(mask.schema["value"].dataType))
    return joined.select(*[value.alias("value") if c == "value" else col(c) for c in mask.columns])


def merge_masks(
    masks: DataFrame,
    regex: str | None = None,
    add: Sequence[str] = (),
    sub: Sequence[str] = (),
    keys: Sequence[str] = KEYS,
    name: str = "series",
) -> DataFrame:
    """One mask per key: 1 where an added mask is set and no subtracted one is.

    With ``regex`` (case-insensitive search) matching mask files are added and all
    other mask files subtracted. With lists, ``add`` and ``sub`` name the files, and
    a key lacking any of them is left out; :func:`missing_masks` reports those.
    """
    if (regex is None) == (not add and not sub):
        raise ValueError("give either regex or add/sub lists")
    keys = list(keys)
    if regex is not None:
        files = masks.filter(col(name).rlike(MASK_FILE))
        positive = col(name).rlike(f"(?i){regex}")
        negative = ~positive
    else:
        listed = list(dict.fromkeys([*add, *sub]))
        files = masks.filter(col(name).isin(listed))
        complete = _complete_keys(files, listed, keys, name)
        files = attach(files, complete, keys, "inner", "complete-masks")
        positive, negative = col(name).isin(list(add)), col(name).isin(list(sub))
    on = F.col("value") != 0
    merged = files.groupBy(*keys, *XYZ).agg(
        F.bool_or(positive & on).alias("__add"), F.bool_or(negative & on).alias("__sub")
    )
    kept = F.coalesce(F.col("__add"), F.lit(False)) & ~F.coalesce(F.col("__sub"), F.lit(False))
    return merged.select(*keys, *XYZ, F.when(kept, 1).otherwise(0).alias("value"))


def _complete_keys(files: DataFrame, listed: Sequence[str], keys: Sequence[str], name: str) -> DataFrame:
    return (
        files.groupBy(*keys)
        .agg(F.count_distinct(col(name)).alias("__k"))
        .filter(F.col("__k") == len(listed))
        .select(*keys)
    )


def missing_masks(
    masks: DataFrame, listed: Sequence[str], keys: Sequence[str] = KEYS, name: str = "series"
) -> DataFrame:
    """Keys that lack at least one of the listed masks."""
    present = F.count_distinct(F.when(col(name).isin(list(listed)), col(name)))
    return (
        masks.groupBy(*keys)
        .agg(present.alias("__k"))
        .filter(F.col("__k") < len(set(listed)))
        .select(*keys)
    )


def bounding_boxes(mask: DataFrame, pad: int = 0, keys: Sequence[str] = KEYS) -> DataFrame:
    """Box around the non-zero voxels of each mask, widened by ``pad``."""
    limits = []
    for axis in XYZ:
        limits += [(F.min(axis) - pad).alias(f"{axis}0"), (F.max(axis) + pad).alias(f"{axis}1")]
    return mask.filter(F.col("value") != 0).groupBy(*keys).agg(*limits)


def crop_to_mask(
    voxels: DataFrame, mask: DataFrame, pad: int = 10, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Voxels inside the padded bounding box of their mask."""
    keys = list(keys)
    boxed = attach(voxels, bounding_boxes(mask, pad, keys), keys, "inner", "boxes")
    within = F.lit(True)
    for axis in XYZ:
        within = within & F.col(axis).between(F.col(f"{axis}0"), F.col(f"{axis}1"))
    return boxed.filter(within).select(*[col(c) for c in voxels.columns])


DISTINCT_LIMIT = 100


def classify_series(
    voxels: DataFrame, keys: Sequence[str] = KEYS, name: str = "series"
) -> DataFrame:
    """``keys, series, kind``: mask or image, by name, else by distinct values.

    A name containing img or image says image, one containing msk or mask says
    mask; otherwise fewer than 100 distinct values say mask. Only undecided series
    have their values counted.
    """
    lowered = F.lower(col(name))
    by_name = F.when(lowered.contains("img") | lowered.contains("image"), "image").when(
        lowered.contains("msk") | lowered.contains("mask"), "mask"
    )
    undecided = F.when(by_name.isNull(), F.col("value"))
    counted = voxels.groupBy(*keys, name).agg(F.count_distinct(undecided).alias("__k"))
    kind = F.coalesce(by_name, F.when(F.col("__k") < DISTINCT_LIMIT, "mask").otherwise("image"))
    return counted.select(*keys, name, kind.alias("kind"))
