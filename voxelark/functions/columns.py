"""Choosing, cleaning and reshaping feature columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ("patientID", "sub_Analysis")
# Fixed value: names that are not features, matched at the start of the name.
NOT_A_FEATURE = r"^(patientID|sub_Analysis)|diagnostics"


def feature_columns(
    df: DataFrame,
    exclude: Sequence[str] = (),
    pattern: str = NOT_A_FEATURE,
) -> list[str]:
    """Numeric columns whose name does not start with ``pattern``."""
    skip = re.compile(pattern)
    dropped = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in dropped and not skip.match(f.name)
    ]


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def number(column: Column) -> Column:
    """Double with NaN turned into NULL, so aggregates skip it."""
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def finite(column: Column) -> Column:
    """Double with NaN and infinities turned into NULL."""
    value = number(column)
    return F.when(F.abs(value) < F.lit(float("inf")), value)


# Added before rounding, so values exactly half way do not depend on the last bit.
NUDGE = 1e-9


def tidy(column: Column, digits: int = 6) -> Column:
    """Rounded double without negative zero, for comparing results.

    Plain arithmetic on doubles: much cheaper than decimal rounding, and the same
    as what the checking database does.
    """
    step = F.lit(float(10**digits))
    return F.rint((column + F.lit(NUDGE)) * step) / step + F.lit(0.0)


def to_long(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """One row per key and feature: ``keys..., feature, value``."""
    cleaned = df.select(*[col(k) for k in keys], *[number(col(f)).alias(f) for f in features])
    return cleaned.unpivot(list(keys), list(features), "feature", "value")


def to_wide(
    long: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    name: str = "feature",
    value: str = "value",
) -> DataFrame:
    """Inverse of :func:`to_long`; the feature list is given, so no extra job runs."""
    return long.groupBy(*keys).pivot(name, list(features)).agg(F.first(value, ignorenulls=True))


def struct_of(names: Sequence[str]) -> Column:
    return F.struct(*[col(n) for n in names])
