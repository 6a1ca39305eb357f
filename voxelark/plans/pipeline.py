"""Ordered chains of steps, and replaying a training chain on new data."""

from __future__ import annotations

import inspect
import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from voxelark.functions.columns import KEYS, feature_columns
from voxelark.functions.sizing import materialize
from voxelark.operators import intensity, masks, selection, stats
from voxelark.operators.combat import CombatCells, combat, combat_study, harmonize_towards
from voxelark.operators.normalize import NormalizerModel, fit_normalizer
from voxelark.operators.predict import predict

# Steps without fitted state: functions of a DataFrame and keyword parameters.
PLAIN_STEPS: dict[str, Callable[..., DataFrame]] = {
    "include": selection.include,
    "skip": selection.skip,
    "dedupe": stats.dedupe_first,
    "window": intensity.window_intensity,
    "window_preset": intensity.window_preset,
    "bin": intensity.bin_intensity,
    "scale": intensity.scale_intensity,
    "match_histogram": intensity.match_histogram,
    "threshold_mask": masks.threshold_mask,
    "merge_masks": masks.merge_masks,
    "crop": masks.crop_to_mask,
    "predict": predict,
}
FITTED_STEPS = ("harmonize", "normalize")


@dataclass
class Step:
    """One step: a registered name or a function, its parameters, its input.

    A step reads the previous output unless ``source`` names an earlier step (by
    its label) or ``"input"``.
    """

    name: str | Callable[..., DataFrame]
    params: dict[str, Any] = field(default_factory=dict)
    label: str | None = None
    source: str | None = None

    def title(self) -> str:
        return self.label or (self.name if isinstance(self.name, str) else self.name.__name__)


def _accepted(function: Callable, params: dict[str, Any], defaults: dict[str, Any]) -> dict[str, Any]:
    """Shared defaults the function knows, overridden by the step's own parameters."""
    known = set(inspect.signature(function).parameters)
    return {**{k: v for k, v in defaults.items() if k in known}, **params}


class _Fitted:
    """Fit and replay of the two stateful steps."""

    @staticmethod
    def fit(kind: str, df: DataFrame, params: dict[str, Any]) -> tuple[dict[str, Any], DataFrame]:
        if kind == "normalize":
            model = fit_normalizer(df, **params)
            return {"model": model}, model.transform(df)
        keys = list(params.get("keys", KEYS))
        names = params.get("names") or feature_columns(df, exclude=keys)
        settings = {**params, "keys": keys, "names": names}
        model, out = combat_study(df, settings.pop("batch"), **settings)
        # The cells carry batch column, features and covariates; the samples are not needed again.
        later = {k: v for k, v in settings.items() if k not in ("batch_col", "covars", "continuous", "names")}
        # However often later steps read it: a projection of the written samples, without a shuffle.
        return {"cells": model.cells, "settings": later}, out

    @staticmethod
    def replay(kind: str, state: dict[str, Any], df: DataFrame, params: dict[str, Any]) -> DataFrame:
        if kind == "normalize":
            return state["model"].transform(df)
        return harmonize_towards(state["cells"], df, params["batch"], **state["settings"])


@dataclass
class Pipeline:
    """Steps over DataFrames with shared defaults; steps may repeat."""

    steps: Sequence[Step]
    defaults: dict[str, Any] = field(default_factory=dict)

    def run(self, df: DataFrame, timer: bool = False):
        """Output of the last step; with ``timer`` also a table of seconds per step.

        Steps are lazy, so timing writes each step's output to the shared folder.
        """
        return _chain(self, df, lambda i, step, source: self._apply(step, source), timer)

    def _apply(self, step: Step, df: DataFrame) -> DataFrame:
        if step.name in FITTED_STEPS:
            return _Fitted.fit(step.name, df, _fitted_params(step, self.defaults))[1]
        function = _function(step)
        return function(df, **_accepted(function, step.params, self.defaults))

    def fit(self, train: DataFrame) -> tuple[PipelineBundle, DataFrame]:
        """Run on training data, keeping what fitted steps learned."""
        states: dict[int, dict[str, Any]] = {}

        def apply(i: int, step: Step, source: DataFrame) -> DataFrame:
            if step.name not in FITTED_STEPS:
                return self._apply(step, source)
            states[i], out = _Fitted.fit(step.name, source, _fitted_params(step, self.defaults))
            return out

        out = _chain(self, train, apply)
        return PipelineBundle(self, states), out


def _function(step: Step) -> Callable[..., DataFrame]:
    if callable(step.name):
        return step.name
    if step.name not in PLAIN_STEPS:
        raise ValueError(f"unknown step {step.name!r}; use one of {sorted([*PLAIN_STEPS, *FITTED_STEPS])}")
    return PLAIN_STEPS[step.name]


def _fitted_params(step: Step, defaults: dict[str, Any]) -> dict[str, Any]:
    function = fit_normalizer if step.name == "normalize" else combat
    return _accepted(function, step.params, defaults)


def _chain(pipeline: Pipeline, df: DataFrame, apply, timer: bool = False):
    outputs, timings, current = {"input": df}, [], df
    for i, step in enumerate(pipeline.steps):
        begin = time.perf_counter()
        source = current if step.source is None else outputs[step.source]
        current = apply(i, step, source)
        if timer:
            current = materialize(current, "timed-step")
            timings.append((i, step.title(), time.perf_counter() - begin))
        outputs[step.title()] = current
    if timer:
        return current, df.sparkSession.createDataFrame(timings, "position int, step string, seconds double")
    return current


@dataclass
class PipelineBundle:
    """A trained chain: normalization uses the training statistics, harmonization
    moves new samples towards the training cells. No training sample is kept."""

    pipeline: Pipeline
    states: dict[int, dict[str, Any]]

    def transform(
        self, df: DataFrame, overrides: dict[str, dict[str, Any]] | None = None,
        then: Sequence[Step] = (),
    ) -> DataFrame:
        """Replay on new data.

        ``overrides`` gives parameters per step label, such as the new batch table;
        ``then`` appends steps, such as a prediction.
        """
        overrides = overrides or {}
        replayed = Pipeline([*self.pipeline.steps, *then], self.pipeline.defaults)

        def apply(i: int, step: Step, source: DataFrame) -> DataFrame:
            changed = {**step.params, **overrides.get(step.title(), {})}
            if i in self.states:
                return _Fitted.replay(step.name, self.states[i], source, changed)
            return replayed._apply(Step(step.name, changed, step.label), source)

        return _chain(replayed, df, apply)

    def reads_once(self, then: Sequence[Step] = ()) -> bool:
        """Whether ``transform`` surely reads its table once: harmonization writes its samples, and
        normalization and prediction before it go by rows."""
        steps = [*self.pipeline.steps, *then]
        if any(step.source is not None for step in steps):
            return False
        names = [step.name for step in steps]
        before = names[: names.index("harmonize")] if "harmonize" in names else names
        return all(name in ("normalize", "predict") for name in before)

    def save(self, path: str) -> None:
        """Store everything fitted as Parquet. Plain steps stay in code."""
        spark = None
        for i, state in self.states.items():
            if "model" in state:
                state["model"].save(f"{path}/step={i}")
                spark = state["model"].stats.sparkSession
                continue
            spark = state["cells"].table.sparkSession
            state["cells"].save(f"{path}/step={i}/training")
            settings = json.dumps(state["settings"])
            spark.createDataFrame([(settings,)], "settings string").write.parquet(f"{path}/step={i}/settings")
        if spark is not None:
            kinds = [(i, self.pipeline.steps[i].name) for i in self.states]
            spark.createDataFrame(kinds, "step int, kind string").write.parquet(f"{path}/steps")

    @classmethod
    def load(cls, spark: SparkSession, path: str, pipeline: Pipeline) -> PipelineBundle:
        """Fitted state from Parquet for the same chain of steps."""
        states: dict[int, dict[str, Any]] = {}
        for row in spark.read.parquet(f"{path}/steps").collect():
            folder = f"{path}/step={row['step']}"
            if row["kind"] == "normalize":
                states[row["step"]] = {"model": NormalizerModel.load(spark, folder)}
            else:
                states[row["step"]] = {
                    "cells": CombatCells.load(spark, f"{folder}/training"),
                    "settings": json.loads(spark.read.parquet(f"{folder}/settings").first()["settings"]),
                }
        return cls(pipeline, states)
