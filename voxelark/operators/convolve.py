"""Convolution and filter banks on volumes.

A filter is a sum of terms, each a product of one-dimensional taps along x, y and
z. All filters of a bank run together: one window per axis reaches the neighbours
on a line, so voxels are shuffled at most three times whatever the number of
filters or the size of their kernels.

Neighbours are found by position. Beyond the bounding box of a volume the border voxel is
repeated. Inside it a voxel may be absent, NULL or NaN: a term has a value only where
every voxel between its outermost offsets (its own row, column and slice included) is
there, else the result is NULL. A window counts the values in that range of positions;
where none is missing, rows and positions agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelark.functions.columns import KEYS, col, number
from voxelark.functions.sizing import attach, materialize
from voxelark.operators.masks import XYZ

Taps = tuple[tuple[int, float], ...]
Term = tuple[Taps, Taps, Taps]
IDENTITY: Taps = ((0, 1.0),)


def kernel_terms(taps: Sequence[tuple[int, int, int, float]]) -> list[Term]:
    """Any kernel ``(dx, dy, dz, weight)`` as terms: one per line of the kernel."""
    lines: dict[tuple[int, int], list[tuple[int, float]]] = {}
    for dx, dy, dz, w in taps:
        lines.setdefault((dy, dz), []).append((dx, float(w)))
    return [
        (tuple(sorted(line)), ((dy, 1.0),), ((dz, 1.0),)) for (dy, dz), line in sorted(lines.items())
    ]


def gabor_kernel(
    size: int = 8, freq: float = 0.5, angle: float = 0.0
) -> list[tuple[int, int, int, float]]:
    """In-plane Gabor kernel: Gaussian of width ``0.2 * size`` times a cosine wave.

    The grid is turned by ``angle`` about its middle, index ``size / 2``.
    """
    sigma, middle = 0.2 * size, size // 2
    taps = []
    for i in range(size):
        for j in range(size):
            dx, dy = i - middle, j - middle
            u = math.cos(angle) * dx - math.sin(angle) * dy
            v = math.sin(angle) * dx + math.cos(angle) * dy
            w = math.exp(-0.5 * (u * u + v * v) / sigma**2) * math.cos(2 * math.pi * freq * u)
            taps.append((dx, dy, 0, w))
    return taps


def gaussian_taps(sigma: float, order: int = 0) -> Taps:
    """Sampled Gaussian (``order`` 0) or its second derivative (``order`` 2)."""
    radius = max(1, math.ceil(4 * sigma))
    weights = {k: math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)}
    total = sum(weights.values())
    if order == 0:
        return tuple((k, w / total) for k, w in weights.items())
    curved = {k: w / total * (k * k / sigma**4 - 1 / sigma**2) for k, w in weights.items()}
    drift = sum(curved.values()) / len(curved)
    return tuple((k, w - drift) for k, w in curved.items())


def log_terms(sigma: float, spacing: Sequence[float] = (1.0, 1.0, 1.0)) -> list[Term]:
    """Laplacian of Gaussian, scale-normalized, ``sigma`` in physical units."""
    per_axis = [sigma / s for s in spacing]
    smooth = [gaussian_taps(s) for s in per_axis]
    curve = [tuple((k, w * s * s) for k, w in gaussian_taps(s, 2)) for s in per_axis]
    return [tuple(curve[a] if a == axis else smooth[a] for a in range(3)) for axis in range(3)]


def wavelet_bank(
    low: Sequence[float], high: Sequence[float], prefix: str = "wavelet", dilation: int = 1
) -> dict[str, list[Term]]:
    """The eight undecimated sub-bands of one level from low- and high-pass taps, ``dilation`` voxels apart."""
    middle = len(low) // 2
    taps = {
        "L": tuple(((k - middle) * dilation, float(w)) for k, w in enumerate(low)),
        "H": tuple(((k - middle) * dilation, float(w)) for k, w in enumerate(high)),
    }
    return {
        f"{prefix}-{a}{b}{c}": [(taps[a], taps[b], taps[c])] for a in "LH" for b in "LH" for c in "LH"
    }


def _along(name: str, taps: Taps, line, axis: str) -> Column:
    """``sum(weight * value at position minus offset)`` on a line, borders repeated, NULL near missing voxels."""
    column = F.col(name)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.lit(0.0)
    for offset, weight in taps:
        if offset == 0:
            shifted = column
        elif offset > 0:
            shifted = F.coalesce(F.lag(column, offset).over(line), F.first(column).over(whole))
        else:
            shifted = F.coalesce(F.lead(column, -offset).over(line), F.last(column).over(whole))
        total = total + shifted * F.lit(weight)
    back, ahead = max(0, *(o for o, _ in taps)), max(0, *(-o for o, _ in taps))
    if not back and not ahead:
        return total
    lo, hi, here = F.col(f"__lo_{axis}"), F.col(f"__hi_{axis}"), F.col(axis)
    there = F.count(column).over(line.rangeBetween(-back, ahead))
    return F.when(there == F.least(here + ahead, hi) - F.greatest(here - back, lo) + 1, total)


def apply_filters(
    voxels: DataFrame, bank: dict[str, list[Term]], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Every filter of the bank on every volume: ``keys, x, y, z, filter_id, value``, one row per given voxel."""
    keys = list(keys)
    on = [*keys, *XYZ]
    first = list(dict.fromkeys(term[0] for terms in bank.values() for term in terms))
    second = list(dict.fromkeys(term[:2] for terms in bank.values() for term in terms))

    rows = voxels.select(*[col(k) for k in on], number(F.col("value")).alias("value"))
    ends = [f(F.col(a)).alias(f"__{side}_{a}") for a in XYZ for side, f in (("lo", F.min), ("hi", F.max))]
    rows = attach(rows, voxels.groupBy(*[col(k) for k in keys]).agg(*ends), keys, "inner", "bounding-boxes")
    box = [c for c in rows.columns if c.startswith(("__lo_", "__hi_"))]

    def line(axis: str):
        return Window.partitionBy(*[col(k) for k in keys], *[a for a in XYZ if a != axis]).orderBy(axis)

    rows = rows.select(*on, *box, *[_along("value", taps, line("x"), "x").alias(f"__x{i}") for i, taps in enumerate(first)])
    rows = rows.select(
        *on,
        *box,
        *[_along(f"__x{first.index(tx)}", ty, line("y"), "y").alias(f"__y{i}") for i, (tx, ty) in enumerate(second)],
    )
    results = []
    for name, terms in bank.items():
        total = F.lit(0.0)
        for tx, ty, tz in terms:
            total = total + _along(f"__y{second.index((tx, ty))}", tz, line("z"), "z")
        results.append((name, total))
    rows = rows.select(*on, *[total.alias(f"__f{i}") for i, (_, total) in enumerate(results)])
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("filter_id"), F.col(f"__f{i}").alias("value"))
            for i, (name, _) in enumerate(results)
        ]
    )
    return rows.select(*on, F.inline(entries))


def convolve(
    voxels: DataFrame, kernel: Sequence[tuple[int, int, int, float]], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Convolve every volume with one kernel given as ``(dx, dy, dz, weight)``."""
    return apply_filters(voxels, {"kernel": kernel_terms(kernel)}, keys).drop("filter_id")


def wavelet_levels(
    voxels: DataFrame,
    low: Sequence[float],
    high: Sequence[float],
    level: int = 1,
    start_level: int = 0,
    keys: Sequence[str] = KEYS,
    prefix: str = "wavelet",
) -> DataFrame:
    """Sub-bands of ``level`` levels of the undecimated wavelet transform, from ``start_level`` on.

    Each level decomposes the approximation of the one before with taps twice as far apart.
    The first level given is named ``prefix-<band>``, later ones ``prefix<number>-<band>``;
    the approximation ``LLL`` belongs to the last level only.
    """
    if level < 1 or start_level < 0:
        raise ValueError("level must be positive and start_level not negative")
    keys, parts, source = list(keys), [], voxels
    for number_ in range(1, start_level + level + 1):
        given, last = number_ - start_level, number_ == start_level + level
        name = prefix if given <= 1 else f"{prefix}{given}"
        bank = wavelet_bank(low, high, name, 1 << (number_ - 1))
        if given < 1:
            bank = {f"{name}-LLL": bank[f"{name}-LLL"]}
        out = apply_filters(source, bank, keys)
        if last:
            parts.append(out)
            break
        out = materialize(out, "wavelet-level")
        source = out.filter(F.col("filter_id") == f"{name}-LLL").drop("filter_id")
        if given >= 1:
            parts.append(out.filter(F.col("filter_id") != f"{name}-LLL"))
    return reduce(DataFrame.unionByName, parts)


def sparse_volumes(voxels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys whose voxels do not fill their bounding box: filters are NULL around what is missing."""
    box = F.lit(1).cast("long")
    for axis in XYZ:
        box = box * (F.max(axis) - F.min(axis) + 1)
    sizes = voxels.groupBy(*keys).agg(F.count("*").alias("__n"), box.alias("__box"))
    return sizes.filter(F.col("__n") != F.col("__box")).select(*keys)
