"""Scoring rows with trained models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelark.functions.columns import KEYS, col
from voxelark.operators.selection import require_columns


class LinearScorer:
    """Smallest object with the expected surface: names and ``predict``."""

    def __init__(self, names: Sequence[str], weights: Sequence[float], intercept: float = 0.0):
        self.feature_names_in_ = list(names)
        self.weights = np.asarray(weights, dtype=float)
        self.intercept = float(intercept)

    def predict(self, frame: pd.DataFrame) -> np.ndarray:
        return frame.to_numpy(dtype=float) @ self.weights + self.intercept


def model_features(model: Any) -> list[str]:
    """Feature names a model was trained on: attribute or ``feature_name()``."""
    names = getattr(model, "feature_names_in_", None)
    if names is None and callable(getattr(model, "feature_name", None)):
        names = model.feature_name()
    if names is None:
        raise ValueError("the model does not say which features it was trained on")
    return [str(n) for n in names]


def predict(
    df: DataFrame,
    model: Any,
    feature_names: Sequence[str] | None = None,
    keys: Sequence[str] = KEYS,
    result: str = "double",
) -> DataFrame:
    """Keys and ``predictions``, scored batch-wise in the workers.

    Only the model's own features reach Python and only predictions return; the model travels with the
    task code (Spark ships a large one once per executor). A Spark ML model is
    applied as it is.
    """
    keys = list(keys)
    if isinstance(model, PipelineModel):
        scored = model.transform(df)
        return scored.select(*[col(k) for k in keys], F.col("prediction").alias("predictions"))
    names = list(feature_names) if feature_names is not None else model_features(model)
    require_columns(df, [*keys, *names])

    @F.pandas_udf(result)
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            out = pd.DataFrame(index=batch.index)
            out["predictions"] = np.asarray(model.predict(batch[names])) if len(batch) else []
            yield out["predictions"]

    needed = list(dict.fromkeys(names)) or keys
    values = F.struct(*[col(c).alias(c) for c in needed])
    return df.select(*[col(k) for k in keys], score(values).alias("predictions"))
