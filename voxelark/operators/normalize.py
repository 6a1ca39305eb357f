"""Feature normalization with fitted, storable statistics.

Every method is an affine map ``(x - center) / scale`` whose two numbers come
from the statistics of the row's stratum. Fitting is one aggregation; applying is
one narrow projection over the rows with two arrays attached per stratum.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelark.functions.columns import col, feature_columns, number
from voxelark.functions.sizing import attach, compact, materialize
from voxelark.operators.stats import ALL, STAT_COLUMNS, describe_levels

# Accepted spellings, compared without case, blanks and dashes.
METHOD_NAMES = {
    "minmax": "minmax",
    "zscore": "zscore",
    "robustscaling": "robust",
    "robust": "robust",
}


def method_name(method: str) -> str:
    """Canonical method name; an unknown one is an error."""
    plain = method.lower().replace(" ", "").replace("-", "").replace("_", "")
    if plain not in METHOD_NAMES:
        raise ValueError(f"{method!r} is not a normalization method; use one of {sorted(set(METHOD_NAMES.values()))}")
    return METHOD_NAMES[plain]


def center_and_scale(method: str):
    """The two columns of a statistics table that make up the affine map."""
    return {
        "minmax": (F.col("min"), F.col("max") - F.col("min")),
        "zscore": (F.col("mean"), F.col("std")),
        "robust": (F.col("p50"), F.col("p75") - F.col("p25")),
    }[method]


@dataclass
class NormalizerModel:
    """Statistics per level and feature, plus how to use them.

    ``stats`` holds ``<by>, feature, count, mean, std, min, p25, p50, p75, max``
    with the level ``'all'`` for the whole training table.
    """

    stats: DataFrame
    features: list[str]
    method: str = "minmax"
    by: str = "sub_Analysis"
    stratified: bool = True

    def _arrays(self) -> DataFrame:
        """One row per level: centers and scales in feature order."""
        center, scale = center_and_scale(self.method)
        order = F.create_map(*[x for i, f in enumerate(self.features) for x in (F.lit(f), F.lit(i))])
        entry = F.struct(order[F.col("feature")].alias("i"), center.alias("c"), scale.alias("s"))
        levels = (
            self.stats.filter(F.col("feature").isin(self.features))
            .groupBy(col(self.by).cast("string").alias("__level"))
            .agg(F.sort_array(F.collect_list(entry)).alias("__e"))
        )
        return levels.select(
            "__level",
            F.size("__e").alias("__k"),
            F.transform("__e", lambda e: e["c"]).alias("__c"),
            F.transform("__e", lambda e: e["s"]).alias("__s"),
        )

    def transform(self, df: DataFrame) -> DataFrame:
        """Normalize the model's features, leaving all other columns as they are.

        A stratum the statistics do not know uses the level ``'all'``.
        Constant features give NULL.
        """
        missing = [f for f in self.features if f not in df.columns]
        if missing:
            raise ValueError(f"columns missing from the table: {missing}")
        levels = materialize(self._arrays(), "normalizer")
        overall = levels.filter(F.col("__level") == ALL).first()
        if overall is None or overall["__k"] != len(self.features):
            raise ValueError("statistics lack the level 'all' for some feature")

        def literal(values):
            return F.array(*[F.lit(v).cast("double") for v in values])

        c_all, s_all = literal(overall["__c"]), literal(overall["__s"])
        if self.stratified:
            own = levels.filter((F.col("__level") != ALL) & (F.col("__k") == len(self.features))).drop("__k")
            tagged = df.withColumn("__level", col(self.by).cast("string"))
            rows = attach(tagged, own, ["__level"], part_of=levels)
            center, scale = F.coalesce("__c", c_all), F.coalesce("__s", s_all)
        else:
            rows, center, scale = df, c_all, s_all
        rows = rows.withColumns({"__center": center, "__scale": scale})
        position = {f: i for i, f in enumerate(self.features)}
        return rows.select(
            *[
                F.try_divide(
                    number(col(c)) - F.col("__center")[position[c]], F.col("__scale")[position[c]]
                ).alias(c)
                if c in position
                else col(c)
                for c in df.columns
            ]
        )

    def save(self, path: str) -> None:
        """Store statistics and settings as Parquet."""
        self.stats.write.mode("errorifexists").parquet(f"{path}/stats")
        settings = json.dumps(
            {"features": self.features, "method": self.method, "by": self.by, "stratified": self.stratified}
        )
        spark = self.stats.sparkSession
        spark.createDataFrame([(settings,)], "settings string").write.mode("errorifexists").parquet(
            f"{path}/settings"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NormalizerModel:
        settings = json.loads(spark.read.parquet(f"{path}/settings").first()["settings"])
        return cls(spark.read.parquet(f"{path}/stats"), **settings)


def fit_normalizer(
    df: DataFrame,
    features: Sequence[str] | None = None,
    method: str = "minmax",
    by: str = "sub_Analysis",
    stratified: bool = True,
    all_statistics: bool = False,
) -> NormalizerModel:
    """Compute the statistics a method needs (or all of them, to share a model)."""
    name = method_name(method)
    features = list(features) if features is not None else feature_columns(df, exclude=[by])
    quartiles = all_statistics or name == "robust"
    if stratified:
        stats = describe_levels(df, features, by, quartiles)
    else:
        whole = df.select(*[col(f) for f in features]).withColumn(by, F.lit(None).cast("string"))
        stats = describe_levels(whole, features, by, quartiles)
    return NormalizerModel(
        compact(materialize(stats.select(by, "feature", *STAT_COLUMNS), "feature-stats")),
        features,
        name,
        by,
        stratified,
    )


def normalize(
    df: DataFrame,
    features: Sequence[str] | None = None,
    method: str = "minmax",
    by: str = "sub_Analysis",
    stratified: bool = True,
) -> DataFrame:
    """Normalize a table with its own statistics."""
    return fit_normalizer(df, features, method, by, stratified).transform(df)


def normalize_external(
    df: DataFrame,
    stats: DataFrame,
    features: Sequence[str],
    method: str = "minmax",
    by: str = "sub_Analysis",
    stratified: bool = True,
) -> DataFrame:
    """Normalize with statistics computed elsewhere (the training table's)."""
    return NormalizerModel(stats, list(features), method_name(method), by, stratified).transform(df)


def attach_stats(long: DataFrame, stats: DataFrame, by: str = "sub_Analysis") -> DataFrame:
    """Long rows joined to the statistics of their stratum, else those of ``'all'``."""
    packed = stats.select(
        col(by).alias("__level"), F.col("feature"), F.struct(*STAT_COLUMNS).alias("__stats")
    )
    packed = materialize(packed, "stats")
    known = packed.select("__level").distinct().withColumn("__own", F.lit(True))
    rows = long.withColumn("__level", col(by).cast("string"))
    rows = attach(rows, known, ["__level"], label="levels")
    rows = rows.withColumn("__level", F.when(F.col("__own"), F.col("__level")).otherwise(F.lit(ALL)))
    rows = attach(rows, packed, ["__level", "feature"], part_of=packed)
    return rows.select(*[col(c) for c in long.columns], "__stats.*")
