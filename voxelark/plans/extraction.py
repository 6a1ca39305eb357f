"""Feature extraction for several configurations in one job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelark.functions.columns import KEYS
from voxelark.functions.sizing import materialize
from voxelark.operators import texture
from voxelark.operators.convolve import (
    IDENTITY,
    Term,
    apply_filters,
    gabor_kernel,
    kernel_terms,
    log_terms,
    wavelet_bank,
)
from voxelark.operators.masks import XYZ, crop_to_mask, inside_mask

#: Shape depends on the mask alone, so only Original configurations give it.
CLASSES = ("shape", "firstorder", "glcm", "gldm", "glrlm", "glszm", "ngtdm")


@dataclass
class FeatureConfig:
    """What to extract: an image type with its filter settings and a bin width.

    ``image_type`` is Original, LoG (``sigma`` list), Wavelet (``low`` and ``high``
    taps) or Gabor (``size``, ``freq``, ``angle``).
    """

    name: str
    image_type: str = "Original"
    bin_width: float = 25.0
    pad: int = 10
    sigma: Sequence[float] = ()
    low: Sequence[float] = ()
    high: Sequence[float] = ()
    size: int = 8
    freq: float = 0.5
    angle: float = 0.0
    classes: Sequence[str] = field(default_factory=lambda: CLASSES)

    def bank(self, spacing: Sequence[float]) -> dict[str, list[Term]]:
        """Filters by their column prefix."""
        kind = self.image_type.lower()
        if kind == "original":
            return {self.name: [(IDENTITY, IDENTITY, IDENTITY)]}
        if kind == "gabor":
            return {self.name: kernel_terms(gabor_kernel(self.size, self.freq, self.angle))}
        if kind == "log":
            if not self.sigma:
                raise ValueError("LoG needs at least one sigma")
            label = {s: str(float(s)).replace(".", "-") for s in self.sigma}
            return {f"{self.name}-sigma-{label[s]}-mm-3D": log_terms(float(s), spacing) for s in self.sigma}
        if kind == "wavelet":
            if not self.low or not self.high:
                raise ValueError("Wavelet needs low and high taps")
            return wavelet_bank(self.low, self.high, self.name)
        raise ValueError(f"unknown image type {self.image_type!r}")


def extract_features(
    images: DataFrame,
    masks: DataFrame,
    configs: Sequence[FeatureConfig],
    keys: Sequence[str] = KEYS,
    spacing: Sequence[float] = (1.0, 1.0, 1.0),
    with_diagnostics: bool = False,
) -> DataFrame:
    """One wide row per key: ``<config>[-<filter>]_<class>_<feature>``.

    Images are cropped around their mask first, all filters of one padding run together,
    and all filtered images of one bin width share each feature job. A configuration
    gives the same features alone and in company. ``with_diagnostics`` adds the columns
    of :func:`diagnostics` once; :func:`skipped_regions` names the keys without a row.
    """
    keys = list(keys)
    spread = [*keys, "filter_id"]
    banks: dict[int, dict[str, list[Term]]] = {}
    owner: dict[str, FeatureConfig] = {}
    for config in configs:
        pad = 0 if config.image_type.lower() == "original" else config.pad
        for name, terms in config.bank(spacing).items():
            if name in owner:
                raise ValueError(f"two configurations produce {name!r}")
            owner[name] = config
            banks.setdefault(pad, {})[name] = terms
    responses = reduce(
        DataFrame.unionByName,
        [_responses(crop_to_mask(images, masks, pad, keys), banks[pad], owner, keys) for pad in sorted(banks)],
    )
    inside = materialize(inside_mask(responses, masks, keys), "filtered-regions")

    volume = float(spacing[0] * spacing[1] * spacing[2])
    tables: list[tuple[str, DataFrame, list[str]]] = []
    for width in sorted({c.bin_width for c in configs}):
        ids = [n for n, c in owner.items() if c.bin_width == width]
        chosen = inside.filter(F.col("filter_id").isin(ids))
        levels = materialize(texture.roi_levels(chosen, None, width, spread), "levels")
        wanted = {k for n in ids for k in owner[n].classes}
        compute = {
            "firstorder": lambda lv: texture.firstorder(lv, spread, volume),
            "glcm": lambda lv: texture.glcm(lv, spread),
            "glrlm": lambda lv: texture.glrlm(lv, spread),
            "glszm": lambda lv: texture.glszm(lv, spread),
        }
        if wanted & {"gldm", "ngtdm"}:
            near = materialize(texture.surroundings(levels, spread), "neighbourhoods")
            compute["gldm"] = lambda _, near=near: texture.dependence_features(near, spread)
            compute["ngtdm"] = lambda _, near=near: texture.tone_features(near, spread)
        for kind in CLASSES:
            if kind in wanted and kind in compute:
                using = [n for n in ids if kind in owner[n].classes]
                table = compute[kind](levels)
                tables.append((kind, table.filter(F.col("filter_id").isin(using)), using))
    shaped = [c.name for c in configs if "shape" in c.classes and c.image_type.lower() == "original"]
    if shaped:
        names = F.explode(F.array(*[F.lit(n) for n in shaped])).alias("filter_id")
        tables.append(("shape", texture.shape(masks, keys, spacing).select("*", names), shaped))
    if not tables:
        raise ValueError("no configuration asks for a class of features")
    wide = _wide(tables, keys)
    return wide.join(diagnostics(images, masks, keys), keys, "left") if with_diagnostics else wide


def diagnostics(images: DataFrame, masks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Facts about each image and its mask under their published names, one row per key.

    Tuples are spread over one column per axis. A key without mask voxels has NULLs.
    """
    keys = list(keys)
    image, mask = "diagnostics_Image-original", "diagnostics_Mask-original"
    whole = images.groupBy(*keys).agg(
        F.avg("value").alias(f"{image}_Mean"),
        F.min("value").alias(f"{image}_Minimum"),
        F.max("value").alias(f"{image}_Maximum"),
    )
    inside = masks.filter(F.col("value") != 0).groupBy(*keys).agg(
        F.count("*").alias(f"{mask}_VoxelNum"),
        *[F.min(a).alias(f"{mask}_BoundingBox_{a}") for a in XYZ],
        *[(F.max(a) - F.min(a) + 1).alias(f"{mask}_BoundingBox_size_{a}") for a in XYZ],
        *[F.avg(a).alias(f"{mask}_CenterOfMassIndex_{a}") for a in XYZ],
    )
    return whole.join(inside, keys, "left")


def skipped_regions(images: DataFrame, masks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys, reason`` of everything that extraction has no row for: no image, no mask, empty mask.

    Both sides are added up before the one shuffle; NULL keys count as a key.
    """
    keys = list(keys)
    zero = F.lit(0)
    seen = images.select(*keys, F.lit(1).alias("__image"), zero.alias("__mask"), zero.alias("__on")).unionByName(
        masks.select(*keys, zero.alias("__image"), F.lit(1).alias("__mask"),
                     F.when(F.col("value") != 0, 1).otherwise(0).alias("__on"))
    )
    found = seen.groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("__image", "__mask", "__on")])
    reason = (
        F.when(F.col("__image") == 0, "no image")
        .when(F.col("__mask") == 0, "no mask")
        .when(F.col("__on") == 0, "empty mask")
    )
    return found.select(*keys, reason.alias("reason")).filter(F.col("reason").isNotNull())


def _responses(cropped: DataFrame, bank: dict[str, list[Term]], owner: dict[str, FeatureConfig], keys: list[str]) -> DataFrame:
    """Filtered images of one padding, told apart by ``filter_id``."""
    if all(owner[name].image_type.lower() == "original" for name in bank):
        names = F.explode(F.array(*[F.lit(n) for n in bank])).alias("filter_id")
        return cropped.select(*keys, "x", "y", "z", "value", names)
    return apply_filters(cropped, bank, keys).select(*keys, "x", "y", "z", "value", "filter_id")


def _wide(tables, keys: list[str]) -> DataFrame:
    """All classes and filters side by side, through one long table and one pivot."""
    longs, names = [], []
    for kind, table, using in tables:
        features = [c for c in table.columns if c not in (*keys, "filter_id")]
        cast = table.select(*keys, "filter_id", *[F.col(f"`{f}`").cast("double").alias(f) for f in features])
        long = cast.unpivot([*keys, "filter_id"], features, "feature", "value")
        longs.append(
            long.select(*keys, F.concat_ws("_", "filter_id", F.lit(kind), "feature").alias("feature"), "value")
        )
        names += [f"{u}_{kind}_{f}" for u in using for f in features]
    union = reduce(lambda a, b: a.unionByName(b), longs)
    return union.groupBy(*keys).pivot("feature", names).agg(F.first("value"))
