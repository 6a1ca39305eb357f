"""ComBat batch-effect harmonization from sufficient statistics.

The published method standardizes every feature with a linear model, shrinks the
per-batch location and scale estimates with empirical Bayes, and maps the data
back. Every quantity it needs is a function of the counts, means and centered
squares of the cells formed by batch and categorical covariates. So:

* the samples are read once, by an aggregation over cells with map-side combining
  (a batch with a third of all rows shrinks to one row per input partition);
* regression, pooled variance, estimates and priors are expressions on the small
  ``cell x feature`` table;
* samples are read a second time by a narrow projection, because inside a cell
  the harmonized value is an affine function of the value.

The covariate coefficients come from the within-batch cross products, so the only
matrix inverted is covariates x covariates, shared by all features. Where a covariate has
more levels than there are batches and the model is large, that covariate's levels are
eliminated instead (their block of the normal equations is diagonal): they may be many
thousands, stay a table, and never reach the driver.

The cells are a table of their own (``CombatCells``) that merges with the cells of other
samples and can be stored: harmonizing new samples towards a training table reads the
training cells, never the training samples.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelark.functions.columns import KEYS, col, feature_columns, finite, to_long
from voxelark.functions.sizing import attach, compact, materialize
from voxelark.operators.selection import require_columns
from voxelark.operators.stats import WIDE_FEATURE_LIMIT, dedupe_first

CONVERGENCE = 1e-4
MAX_ROUNDS = 10_000
# Residual variance below this share of the squared level counts as zero.
ZERO_VARIANCE = 1e-28
#: Model columns up to which the cross products are plain expressions; beyond them numpy adds them up in tasks.
DENSE_TERMS = 40
#: Model columns beside the largest block, whose cross products form one matrix on the driver.
MAX_DESIGN_COLUMNS = 1_024


def _float32(column: Column) -> Column:
    return column.cast("float").cast("double")


@dataclass
class Design:
    """Columns of the model: batches, categorical levels, continuous covariates."""

    batch: str
    covars: list[str] = field(default_factory=list)
    continuous: list[str] = field(default_factory=list)
    levels: dict[str, list[str]] = field(default_factory=dict)
    ref_batch: str | None = None
    #: A categorical covariate whose effects are a table of their own instead of model columns.
    absorbed: str | None = None

    @property
    def terms(self) -> list[tuple[str, str | None]]:
        dummies = [(c, level) for c in self.covars if c != self.absorbed for level in self.levels[c][1:]]
        return dummies + [(c, None) for c in self.continuous]

    def term_names(self) -> list[str]:
        return [c if level is None else f"{c}={level}" for c, level in self.terms]

    def cell_value(self, j: int) -> Column:
        """Value of term ``j`` in a cell (a cell mean for a continuous covariate)."""
        name, level = self.terms[j]
        if level is None:
            return F.col(f"__c{self.continuous.index(name)}")
        return F.when(col(name) == level, 1.0).otherwise(0.0)

    def row_value(self, j: int) -> Column:
        name, level = self.terms[j]
        if level is None:
            return _float32(col(name))
        return F.when(col(name).cast("string") == level, 1.0).otherwise(0.0)


@dataclass
class CombatModel:
    """Fitted estimates as three small tables plus the design."""

    features: DataFrame
    batches: DataFrame
    feature_batches: DataFrame
    names: list[str]
    design: Design
    mean_only: bool = False
    cells: CombatCells | None = None
    #: Effects of the absorbed covariate: feature, level, effect.
    effects: DataFrame | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        """Harmonize samples, using each sample's own covariates."""
        return _apply(self, df, average_covariates=False)

    def apply_trained(self, df: DataFrame) -> DataFrame:
        """Harmonize new samples of known batches with the stored estimates.

        Covariates of new samples are not used; the training average stands in.
        A batch the training did not see is an error.
        """
        return _apply(self, df, average_covariates=True)

    def save(self, path: str) -> None:
        self.features.write.mode("errorifexists").parquet(f"{path}/features")
        self.batches.write.mode("errorifexists").parquet(f"{path}/batches")
        self.feature_batches.write.mode("errorifexists").parquet(f"{path}/feature_batches")
        if self.effects is not None:
            self.effects.write.mode("errorifexists").parquet(f"{path}/effects")
        settings = json.dumps(
            {"names": self.names, "mean_only": self.mean_only, "design": self.design.__dict__}
        )
        self.features.sparkSession.createDataFrame([(settings,)], "settings string").write.mode(
            "errorifexists"
        ).parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CombatModel:
        settings = json.loads(spark.read.parquet(f"{path}/settings").first()["settings"])
        design = Design(**settings["design"])
        return cls(
            spark.read.parquet(f"{path}/features"),
            spark.read.parquet(f"{path}/batches"),
            spark.read.parquet(f"{path}/feature_batches"),
            settings["names"],
            design,
            settings["mean_only"],
            effects=spark.read.parquet(f"{path}/effects") if design.absorbed else None,
        )


@dataclass
class CombatCells:
    """Moments of every (batch, covariate cell, feature): all that fitting needs of the samples.

    ``table`` has ``__batch``, the covariates, ``feature``, ``n`` samples, ``gaps`` of them without a
    continuous covariate, ``seen`` values with their ``mean`` and centered squares ``m2``; for continuous
    covariates also their means ``__c<i>``, cross products ``__cc<i>_<k>`` and products with the
    value ``cy<i>``. Cells of different samples merge in any order; products with the values of a feature
    that has gaps are not kept exact, as fitting refuses or leaves out such features.
    """

    table: DataFrame
    names: list[str]
    batch: str
    covars: list[str] = field(default_factory=list)
    continuous: list[str] = field(default_factory=list)

    @classmethod
    def of(
        cls,
        df: DataFrame,
        names: Sequence[str],
        batch: str = "batch",
        covars: Sequence[str] = (),
        continuous: Sequence[str] = (),
    ) -> CombatCells:
        """One pass over samples that carry their batch and covariates."""
        design = Design(batch, list(covars), list(continuous))
        require_columns(df, [batch, *covars, *continuous])
        table = compact(materialize(_cells(df, names, design), "combat-cells"))
        return cls(table, list(names), batch, list(covars), list(continuous))

    def relabelled(self, batch: Column) -> CombatCells:
        """The same cells under other batch names; cells that now share a name are merged."""
        return self._merged(self.table.withColumn("__batch", batch))

    def merge(self, other: CombatCells) -> CombatCells:
        """Cells of both sets of samples."""
        if (self.names, self.covars, self.continuous) != (other.names, other.covars, other.continuous):
            raise ValueError("cells of different features or covariates do not merge")
        return self._merged(self.table.unionByName(other.table))

    def _merged(self, table: DataFrame) -> CombatCells:
        cont = range(len(self.continuous))
        pairs = [(i, k) for i in cont for k in range(i, len(self.continuous))]
        by = ["__batch", *self.covars, "feature"]
        # Means are pooled first, then every part is moved from its own mean to the pooled one.
        size = {"mean": F.col("seen"), **{f"__c{i}": F.col("n") for i in cont}}
        pooled = table.groupBy(*[col(k) for k in by]).agg(
            F.collect_list(F.struct(*[c for c in table.columns if c not in by])).alias("__parts"),
            *[F.try_divide(F.sum(w * F.col(c)), F.sum(F.when(F.col(c).isNotNull(), w))).alias(f"__to_{c}") for c, w in size.items()],
        )

        def total(value) -> Column:
            return F.aggregate("__parts", F.lit(0.0), lambda done, p: done + F.coalesce(value(p), F.lit(0.0)))

        def count(name: str) -> Column:
            return F.aggregate("__parts", F.lit(0).cast("long"), lambda done, p: done + p[name]).alias(name)

        def away(p, name: str) -> Column:
            return p[name] - F.col(f"__to_{name}")

        columns = [
            *[count(c) for c in ("n", "gaps", "seen")],
            F.col("__to_mean").alias("mean"),
            total(lambda p: p["m2"] + p["seen"] * away(p, "mean") * away(p, "mean")).alias("m2"),
            *[F.col(f"__to___c{i}").alias(f"__c{i}") for i in cont],
        ]
        for i, k in pairs:
            cross = total(lambda p, i=i, k=k: p[f"__cc{i}_{k}"] + p["n"] * away(p, f"__c{i}") * away(p, f"__c{k}"))
            columns.append(cross.alias(f"__cc{i}_{k}"))
        for i in cont:
            cross = total(lambda p, i=i: p[f"cy{i}"] + p["seen"] * away(p, f"__c{i}") * away(p, "mean"))
            columns.append(cross.alias(f"cy{i}"))
        merged = pooled.select(*[col(k) for k in by], *columns)
        return CombatCells(compact(materialize(merged, "combat-cells")), self.names, self.batch, self.covars, self.continuous)

    def save(self, path: str) -> None:
        self.table.write.mode("errorifexists").parquet(f"{path}/cells")
        parts = {k: v for k, v in self.__dict__.items() if k != "table"}
        spark = self.table.sparkSession
        spark.createDataFrame([(json.dumps(parts),)], "settings string").write.mode("errorifexists").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CombatCells:
        parts = json.loads(spark.read.parquet(f"{path}/settings").first()["settings"])
        return cls(materialize(spark.read.parquet(f"{path}/cells"), "combat-cells"), **parts)


def _cells(df: DataFrame, names: Sequence[str], design: Design) -> DataFrame:
    """One pass over the samples: moments per (batch, covariate cell, feature)."""
    keys = ["__batch", *design.covars]
    cont = [f"__x{i}" for i in range(len(design.continuous))]
    base = df.select(
        col(design.batch).cast("string").alias("__batch"),
        *[col(c).cast("string").alias(c) for c in design.covars],
        *[_float32(col(c)).alias(x) for c, x in zip(design.continuous, cont)],
        *[finite(col(f)).alias(f) for f in names],
    )
    gaps = F.count_if(reduce(lambda a, b: a | b, [F.col(x).isNull() | F.isnan(x) for x in cont], F.lit(False)))
    shared = [gaps.alias("gaps"), *[F.avg(x).alias(f"__c{i}") for i, x in enumerate(cont)]]
    for i, a in enumerate(cont):
        for k in range(i, len(cont)):
            shared.append((F.covar_pop(a, cont[k]) * F.count("*")).alias(f"__cc{i}_{k}"))

    def per_feature(value: Column) -> list[Column]:
        return [
            F.count(value).alias("seen"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(value)).alias("m2"),
            *[
                (F.covar_pop(F.col(x), value) * F.count(value)).alias(f"cy{i}")
                for i, x in enumerate(cont)
            ],
        ]

    if len(names) > WIDE_FEATURE_LIMIT:
        long = base.unpivot([*keys, *cont], list(names), "feature", "value")
        return long.groupBy(*keys, "feature").agg(
            F.count("*").alias("n"), *shared, *per_feature(F.col("value"))
        )
    packed = [F.struct(*per_feature(col(f))).alias(f"__m{i}") for i, f in enumerate(names)]
    wide = base.groupBy(*keys).agg(F.count("*").alias("n"), *shared, *packed)
    entries = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f"__m{i}").alias("m")) for i, f in enumerate(names)]
    )
    kept = [c for c in wide.columns if not c.startswith("__m")]
    return wide.select(*kept, F.inline(entries)).select(*kept, "feature", "m.*")


def _facts(cells: DataFrame, design: Design, any_feature: str, dense_terms: int) -> dict:
    """What the driver has to know about the cells: features with gaps, covariate levels, sizes of the
    reference and of the smallest batch. The levels of the largest covariate of a large model stay where they are.
    """
    one = F.col("feature") == any_feature
    blocks = ["__batch", *design.covars]
    sizes = cells.filter(one).agg(*[F.count_distinct(col(c)).alias(f"s{i}") for i, c in enumerate(blocks)]).first()
    sizes = dict(zip(blocks, sizes))
    largest = max(blocks, key=lambda c: sizes[c])
    columns = sum(n - 1 for c, n in sizes.items() if c != "__batch") + len(design.continuous)
    if columns > dense_terms and largest != "__batch":
        design.absorbed = largest
    rest = [c for c in blocks if c not in (largest, design.absorbed)]
    if columns > dense_terms and sum(sizes[c] - 1 for c in rest) + len(design.continuous) > MAX_DESIGN_COLUMNS:
        raise ValueError(f"beside the largest, batches and covariates have more than {MAX_DESIGN_COLUMNS} levels: {sizes}")
    listed = [c for c in design.covars if c != design.absorbed]

    nameless = reduce(lambda a, b: a | b, [col(c).isNull() for c in blocks])
    missing = F.when(nameless, F.col("n")).otherwise(F.col("gaps"))
    per_batch = cells.groupBy("__batch").agg(
        F.sum(F.when(one, F.col("n"))).alias("n"),
        F.sum(F.when(one, missing)).alias("missing"),
        F.collect_set(F.when(F.col("seen") < F.col("n"), F.col("feature"))).alias("gaps"),
        *[F.collect_set(col(c)).alias(f"l{i}") for i, c in enumerate(listed)],
    )
    is_ref = F.col("__batch") == F.lit(design.ref_batch)
    other = F.when(~F.coalesce(is_ref, F.lit(False)), F.struct("n", "__batch"))

    def union(name: str) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.collect_set(name))))

    row = per_batch.agg(
        F.max(F.when(is_ref, F.col("n"))).alias("ref_size"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"),
        F.min(other).alias("smallest"),
        union("gaps").alias("gaps"),
        *[union(f"l{i}").alias(f"l{i}") for i in range(len(listed))],
    ).first()
    levels = {c: row[f"l{i}"] for i, c in enumerate(listed)}
    known = {k: row[k] for k in ("ref_size", "smallest", "missing")}
    return {"gaps": row["gaps"] or [], "levels": levels, "large": columns > dense_terms, **known}


def _inverse_cross_product(cells: DataFrame, design: Design, any_feature: str) -> np.ndarray:
    """Inverse of the within-batch covariate cross products (covariates squared)."""
    q = len(design.terms)
    one = cells.filter(F.col("feature") == any_feature)
    pairs = [(j, k) for j in range(q) for k in range(j, q)]
    z = [design.cell_value(j) for j in range(q)]
    first_continuous = q - len(design.continuous)

    def scatter(j: int, k: int) -> Column:
        if j < first_continuous or k < first_continuous:
            return F.lit(0.0)
        return F.col(f"__cc{j - first_continuous}_{k - first_continuous}")

    per_batch = one.groupBy("__batch").agg(
        F.sum("n").alias("__n"),
        *[F.sum(F.col("n") * z[j]).alias(f"__z{j}") for j in range(q)],
        *[F.sum(F.col("n") * z[j] * z[k] + scatter(j, k)).alias(f"__p{j}_{k}") for j, k in pairs],
    )
    sums = per_batch.agg(
        *[
            F.sum(
                F.col(f"__p{j}_{k}") - F.col(f"__z{j}") * F.col(f"__z{k}") / F.col("__n")
            ).alias(f"s{j}_{k}")
            for j, k in pairs
        ]
    ).first()
    matrix = np.zeros((q, q))
    for j, k in pairs:
        matrix[j, k] = matrix[k, j] = sums[f"s{j}_{k}"]
    if np.linalg.matrix_rank(matrix, tol=1e-9 * max(1.0, np.abs(matrix).max())) < q:
        raise ValueError("covariates are confounded with the batches (singular design)")
    return np.linalg.inv(matrix)


def _within(cells: DataFrame, group: str, terms: list[tuple[str, str | None]], continuous: list[str], values: bool) -> DataFrame:
    """Cross products of model columns around the means of ``group``, added up in tasks.

    The products of columns with each other as rows (i, j, v), or with ``values`` those of columns with the
    values as rows (feature, i, v). Cells of one level of the group meet in one task.
    """
    q = len(terms)
    place = {t: i for i, t in enumerate(terms)}
    dummies = sorted({name for name, level in terms if level is not None})
    at = [place[c, None] for c in continuous]

    def design_rows(pdf: pd.DataFrame) -> np.ndarray:
        z = np.zeros((len(pdf), q))
        for name in dummies:
            where = pdf[name].map({level: i for (n, level), i in place.items() if n == name and level is not None})
            known = where.notna().to_numpy()
            z[np.flatnonzero(known), where[known].astype(int)] = 1.0
        for i, k in enumerate(at):
            z[:, k] = pdf[f"__c{i}"]
        return z

    def own_products(part: pd.DataFrame) -> np.ndarray:
        z, n = design_rows(part), part["n"].to_numpy(float)
        codes, level = np.unique(part[group].to_numpy(), return_inverse=True)
        weight, sums = np.zeros(len(codes)), np.zeros((len(codes), q))
        np.add.at(weight, level, n)
        np.add.at(sums, level, z * n[:, None])
        if values:
            y, totals = n * part["mean"].to_numpy(float), np.zeros(len(codes))
            np.add.at(totals, level, y)
            own = z.T @ y - sums.T @ (totals / weight)
            for i, a in enumerate(at):
                own[a] += part[f"cy{i}"].sum()
            return own
        own = (z * n[:, None]).T @ z - (sums / weight[:, None]).T @ sums
        for i, a in enumerate(at):
            for j in range(i, len(at)):
                shared = part[f"__cc{i}_{j}"].sum()
                own[a, at[j]] += shared
                if i != j:
                    own[at[j], a] += shared
        return own

    def of_part(pdf: pd.DataFrame) -> pd.DataFrame:
        if values:
            each = [pd.DataFrame({"feature": f, "i": np.arange(q), "v": own_products(part)}) for f, part in pdf.groupby("feature")]
            return pd.concat(each)
        own = own_products(pdf)
        i, j = np.nonzero(own)
        return pd.DataFrame({"i": i, "j": j, "v": own[i, j]})

    part = F.pmod(F.xxhash64(col(group)), F.lit(_partitions(cells))).alias("__part")
    return cells.groupBy(part).applyInPandas(of_part, "feature string, i int, v double" if values else "i int, j int, v double")


#: Cells a task adds up at once, on average.
_CELLS_OF_A_PART = 20_000


def _partitions(cells: DataFrame) -> int:
    return max(1, -(-cells.count() // _CELLS_OF_A_PART))


def _many_coefficients(cells: DataFrame, design: Design, any_feature: str) -> tuple[DataFrame, DataFrame | None]:
    """Coefficients of a large model: the largest block of levels is eliminated, the rest is solved.

    ``feature, __beta array`` in the order of the design's terms, and the effects of an absorbed
    covariate (feature, level, effect), relative to its first level.
    """
    group, terms = design.absorbed or "__batch", list(design.terms)
    if design.absorbed:
        batches = sorted(r[0] for r in cells.filter(F.col("feature") == any_feature).select("__batch").distinct().collect())
        terms = [*[("__batch", b) for b in batches[1:]], *terms]
    q, skipped = len(terms), len(terms) - len(design.terms)
    if q:
        sums = _within(cells.filter(F.col("feature") == any_feature), group, terms, design.continuous, False)
        matrix = np.zeros((q, q))
        for r in sums.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
            matrix[r["i"], r["j"]] = r["v"]
        scale = np.sqrt(np.maximum(np.diag(matrix), 1e-300))
        if np.linalg.matrix_rank(matrix / np.outer(scale, scale), tol=1e-9) < q:
            raise ValueError("covariates are confounded with the batches (singular design)")
        factor = np.linalg.cholesky(matrix / np.outer(scale, scale))
        shared = cells.sparkSession.sparkContext.broadcast((factor, scale))

        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            lower, own = shared.value
            right = np.zeros(q)
            np.add.at(right, pdf["i"].to_numpy(), pdf["v"].to_numpy())
            x = np.linalg.solve(lower.T, np.linalg.solve(lower, right / own)) / own
            return pd.DataFrame({"feature": [pdf["feature"].iloc[0]], "__all": [x.tolist()]})

        products = _within(cells, group, terms, design.continuous, True).groupBy("feature", "i").agg(F.sum("v").alias("v"))
        solved = products.groupBy("feature").applyInPandas(solve, "feature string, __all array<double>")
    else:
        solved = cells.select("feature").distinct().withColumn("__all", F.array().cast("array<double>"))
    solved = compact(materialize(solved.withColumn("__beta", F.slice("__all", skipped + 1, max(q - skipped, 0)) if q > skipped else F.array().cast("array<double>")), "combat-solved"))
    beta = solved.select("feature", "__beta")
    if not design.absorbed:
        return beta, None
    # What remains of a level's mean without the batches and the other terms; the first level is zero.
    batch_place = F.create_map(*[x for i, (_, b) in enumerate(terms[:skipped]) for x in (F.lit(b), F.lit(i))]) if skipped else None
    of_batch = F.coalesce(F.get(F.col("__all"), batch_place[F.col("__batch")]), F.lit(0.0)) if skipped else F.lit(0.0)
    rest = F.col("mean") - of_batch - _effect(design, design.cell_value)
    level = cells.join(solved, "feature").groupBy("feature", col(group).alias("level")).agg(
        (F.sum(F.col("n") * rest) / F.sum("n")).alias("__g")
    )
    level = compact(materialize(level, "combat-levels"))
    first = level.groupBy("feature").agg(F.min_by("__g", "level").alias("__first"))
    effects = level.join(first, "feature").select("feature", "level", (F.col("__g") - F.col("__first")).alias("effect"))
    return beta, compact(materialize(effects, "combat-effects"))


def _coefficients(cells: DataFrame, design: Design, any_feature: str) -> DataFrame:
    """``feature, __beta array`` of covariate coefficients."""
    q = len(design.terms)
    if q == 0:
        return cells.select("feature").distinct().withColumn(
            "__beta", F.array().cast("array<double>")
        )
    inverse = _inverse_cross_product(cells, design, any_feature)
    z = [design.cell_value(j) for j in range(q)]
    first_continuous = q - len(design.continuous)

    def scatter(j: int) -> Column:
        return F.col(f"cy{j - first_continuous}") if j >= first_continuous else F.lit(0.0)

    per_batch = cells.groupBy("feature", "__batch").agg(
        F.sum("n").alias("__n"),
        F.sum(F.col("n") * F.col("mean")).alias("__y"),
        *[F.sum(F.col("n") * z[j]).alias(f"__z{j}") for j in range(q)],
        *[F.sum(F.col("n") * z[j] * F.col("mean") + scatter(j)).alias(f"__zy{j}") for j in range(q)],
    )
    crossed = per_batch.groupBy("feature").agg(
        *[
            F.sum(F.col(f"__zy{j}") - F.col(f"__z{j}") * F.col("__y") / F.col("__n")).alias(f"__v{j}")
            for j in range(q)
        ]
    )
    betas = []
    for j in range(q):
        term = F.lit(0.0)
        for k in range(q):
            term = term + F.lit(float(inverse[j, k])) * F.col(f"__v{k}")
        betas.append(term)
    return crossed.select("feature", F.array(*betas).alias("__beta"))


def _effect(design: Design, value) -> Column:
    total = F.lit(0.0)
    for j in range(len(design.terms)):
        total = total + F.col("__beta")[j] * value(j)
    return total


def _location_scale(cells: DataFrame, design: Design, any_feature: str, large: bool):
    """Per feature: grand mean, pooled variance. Per feature and batch: estimates. Effects of an absorbed covariate."""
    effects = None
    if large:
        beta, effects = _many_coefficients(cells, design, any_feature)
    else:
        beta = _coefficients(cells, design, any_feature)
    if design.terms:
        beta = compact(materialize(beta, "combat-coefficients"))
    fitted = cells.join(beta, "feature").withColumn("__mod", _effect(design, design.cell_value))
    if effects is not None:
        named = effects.withColumnRenamed("level", "__level")
        fitted = fitted.withColumn("__level", col(design.absorbed)).join(named, ["feature", "__level"])
        fitted = fitted.withColumn("__mod", F.col("__mod") + F.col("effect")).drop("__level", "effect")
    whole = Window.partitionBy("feature", "__batch")
    size = F.sum("n").over(whole)
    level = F.sum(F.col("n") * (F.col("mean") - F.col("__mod"))).over(whole) / size
    fitted = fitted.withColumns({"__nb": size, "__b": level})
    spread = F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("__mod") - F.col("__b"), 2)
    for i in range(len(design.continuous)):
        j = len(design.terms) - len(design.continuous) + i
        spread = spread - 2 * F.col("__beta")[j] * F.col(f"cy{i}")
        for k in range(len(design.continuous)):
            lo, hi = min(i, k), max(i, k)
            other = len(design.terms) - len(design.continuous) + k
            spread = spread + F.col("__beta")[j] * F.col("__beta")[other] * F.col(f"__cc{lo}_{hi}")
    per_batch = (
        fitted.groupBy("feature", "__batch")
        .agg(
            F.first("__nb").alias("n"),
            F.first("__b").alias("level"),
            F.sum(spread).alias("rss"),
            F.sum(F.col("n") * F.col("__mod")).alias("mod_sum"),
        )
        .withColumnRenamed("__batch", "batch")
    )
    per_batch = compact(materialize(per_batch, "combat-batches"))
    if design.ref_batch is None:
        grand = F.sum(F.col("n") * F.col("level")) / F.sum("n")
        variance = F.sum("rss") / F.sum("n")
    else:
        is_ref = F.col("batch") == design.ref_batch
        grand = F.max(F.when(is_ref, F.col("level")))
        variance = F.max(F.when(is_ref, F.col("rss") / F.col("n")))
    per_feature = per_batch.groupBy("feature").agg(
        grand.alias("stand_mean"),
        variance.alias("__var"),
        (F.sum("mod_sum") / F.sum("n")).alias("mod_mean"),
    )
    zero = F.col("__var") <= F.lit(ZERO_VARIANCE) * F.pow("stand_mean", 2)
    # The median of the flags "variance is not zero" replaces a zero variance.
    features = Window.partitionBy(F.lit(1))
    balance = F.count_if(~zero).over(features) - F.count_if(zero).over(features)
    filler = (F.signum(balance.cast("double")) + 1) / 2
    per_feature = per_feature.join(beta, "feature").select(
        "feature",
        "stand_mean",
        "mod_mean",
        F.when(zero, filler).otherwise(F.col("__var")).alias("var_pooled"),
        "__beta",
    )
    return compact(materialize(per_feature, "combat-features")), per_batch, effects


def _estimates(per_feature: DataFrame, per_batch: DataFrame, mean_only: bool) -> DataFrame:
    sd = F.sqrt("var_pooled")
    raw_scale = F.try_divide(F.col("rss"), F.col("var_pooled") * (F.col("n") - 1))
    scale = F.lit(1.0) if mean_only else F.when(raw_scale == 0, 1.0).otherwise(raw_scale)
    return per_batch.join(per_feature, "feature").select(
        "feature",
        "batch",
        "n",
        F.try_divide(F.col("level") - F.col("stand_mean"), sd).alias("gamma_hat"),
        scale.alias("delta_hat"),
        F.try_divide(F.col("rss"), F.col("var_pooled")).alias("ssq"),
    )


def _priors(estimates: DataFrame, mean_only: bool) -> DataFrame:
    m, s2 = F.avg("delta_hat"), F.var_samp("delta_hat")
    none = F.lit(None).cast("double")
    return estimates.groupBy("batch").agg(
        F.first("n").alias("n"),
        F.avg("gamma_hat").alias("gamma_bar"),
        F.var_samp("gamma_hat").alias("t2"),
        (none if mean_only else F.try_divide(2 * s2 + m * m, s2)).alias("a_prior"),
        (none if mean_only else F.try_divide(m * s2 + m * m * m, s2)).alias("b_prior"),
    )


_STAR = "feature string, batch string, gamma_star double, delta_star double"


def _parametric(estimates: DataFrame, priors: DataFrame) -> DataFrame:
    """Coupled posterior means, iterated per batch over its features.

    One group is one number set per feature, whatever the number of samples.
    """

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        g_hat, n = pdf["gamma_hat"].to_numpy(), pdf["n"].to_numpy(dtype=float)
        g_bar, t2 = pdf["gamma_bar"].iloc[0], pdf["t2"].iloc[0]
        a, b = pdf["a_prior"].iloc[0], pdf["b_prior"].iloc[0]
        ssq = pdf["ssq"].to_numpy()
        gamma, delta = g_hat, pdf["delta_hat"].to_numpy()
        with np.errstate(all="ignore"):
            for _ in range(MAX_ROUNDS):
                new_gamma = (t2 * n * g_hat + delta * g_bar) / (t2 * n + delta)
                around = ssq + n * (g_hat - new_gamma) ** 2
                new_delta = (0.5 * around + b) / (n / 2 + a - 1)
                moved = ((np.abs(new - old) / old).max() for new, old in ((new_gamma, gamma), (new_delta, delta)))
                change = max(moved)
                gamma, delta = new_gamma, new_delta
                if not change > CONVERGENCE:
                    break
            else:
                raise ValueError(f"batch {pdf['batch'].iloc[0]!r} did not converge in {MAX_ROUNDS} rounds")
        return pd.DataFrame(
            {"feature": pdf["feature"], "batch": pdf["batch"], "gamma_star": gamma, "delta_star": delta}
        )

    joined = estimates.join(priors.drop("n"), "batch")
    return joined.groupBy("batch").applyInPandas(solve, _STAR)


#: Features of a tile: one task compares this many with this many others.
TILE_FEATURES = 2_048
_PART = "feature string, batch string, top double, weight double, gamma double, delta double"


def _non_parametric(estimates: DataFrame, n_features: int) -> DataFrame:
    """Likelihood-weighted averages over the other features of the batch.

    A batch's features are dealt over blocks by a hash, and every pair of blocks is a tile
    of its own, so no task sees all pairs. A tile gives each of its features the
    largest log weight it met and the sums relative to it; such parts merge in any order.
    """
    blocks = -(-n_features // TILE_FEATURES)
    spread = F.pmod(F.xxhash64("feature"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    rows = estimates.withColumn("i", spread).withColumn("j", every)
    others = estimates.select("feature", "batch", "gamma_hat", "delta_hat", spread.alias("j")).withColumn("i", every)

    def solve(own: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        g, d = other["gamma_hat"].to_numpy(), other["delta_hat"].to_numpy()
        g_own, n, ssq = own["gamma_hat"].to_numpy(), own["n"].to_numpy(dtype=float), own["ssq"].to_numpy()
        itself = pd.Index(other["feature"]).get_indexer(own["feature"])
        parts = np.zeros((4, len(own)))
        parts[0] = -np.inf
        step = max(1, 2_000_000 // max(1, len(g)))
        with np.errstate(all="ignore"):
            for start in range(0, len(own) if len(g) else 0, step):
                k = np.arange(start, min(start + step, len(own)))
                around = ssq[k, None] + n[k, None] * (g_own[k, None] - g[None, :]) ** 2
                log_weight = -0.5 * n[k, None] * np.log(2 * np.pi * d[None, :]) - around / (2 * d[None, :])
                here = itself[k] >= 0
                log_weight[np.flatnonzero(here), itself[k][here]] = -np.inf
                top = log_weight.max(axis=1)
                weight = np.exp(log_weight - np.where(np.isneginf(top), 0.0, top)[:, None])
                parts[:, k] = top, weight.sum(axis=1), weight @ g, weight @ d
        return pd.DataFrame(
            {"feature": own["feature"], "batch": own["batch"], **dict(zip(("top", "weight", "gamma", "delta"), parts))}
        )

    tile = ["batch", "i", "j"]
    parts = rows.groupBy(*tile).cogroup(others.groupBy(*tile)).applyInPandas(solve, _PART)
    met = parts.groupBy("feature", "batch").agg(F.max("top").alias("__top"), F.collect_list(F.struct("top", "weight", "gamma", "delta")).alias("__p"))

    def total(name: str) -> Column:
        return F.aggregate("__p", F.lit(0.0), lambda done, p: done + p[name] * F.exp(p["top"] - F.col("__top")))

    return met.select(
        "feature",
        "batch",
        F.try_divide(total("gamma"), total("weight")).alias("gamma_star"),
        F.try_divide(total("delta"), total("weight")).alias("delta_star"),
    )


def _shrunken(
    estimates, priors, eb: bool, parametric: bool, mean_only: bool, ref: str | None, n_features: int
) -> DataFrame:
    free = estimates if ref is None else estimates.filter(F.col("batch") != ref)
    if not eb:
        stars = free.select(
            "feature", "batch", F.col("gamma_hat").alias("gamma_star"), F.col("delta_hat").alias("delta_star")
        )
    elif not parametric:
        stars = _non_parametric(free, n_features)
    elif mean_only:
        weighted = (F.col("t2") * F.col("gamma_hat") + F.col("gamma_bar")) / (F.col("t2") + 1)
        stars = free.join(priors.select("batch", "t2", "gamma_bar"), "batch").select(
            "feature", "batch", weighted.alias("gamma_star"), F.lit(1.0).alias("delta_star")
        )
    else:
        stars = _parametric(free, priors)
    if ref is not None:
        stars = stars.unionByName(
            estimates.filter(F.col("batch") == ref).select(
                "feature", "batch", F.lit(0.0).alias("gamma_star"), F.lit(1.0).alias("delta_star")
            )
        )
    return stars


def fit_combat(
    df: DataFrame,
    features: Sequence[str] | None = None,
    batch_col: str = "batch",
    covars: Sequence[str] = (),
    continuous: Sequence[str] = (),
    ref_batch: str | None = None,
    eb: bool = True,
    parametric: bool = True,
    mean_only: bool = False,
    on_missing_ref: str = "error",
    drop_incomplete: bool = False,
    dense_terms: int | None = None,
) -> CombatModel:
    """Fit ComBat on a table that already carries batch and covariate columns.

    Features with a missing or non-finite value are refused by name, or left out
    (and later passed through unchanged) with ``drop_incomplete``.
    """
    covars, continuous = list(covars), list(continuous)
    if features is None:
        features = feature_columns(df, exclude=[batch_col, *covars, *continuous])
    cells = CombatCells.of(df, features, batch_col, covars, continuous)
    return fit_cells(cells, ref_batch, eb, parametric, mean_only, on_missing_ref, drop_incomplete, dense_terms)


def fit_cells(
    held: CombatCells,
    ref_batch: str | None = None,
    eb: bool = True,
    parametric: bool = True,
    mean_only: bool = False,
    on_missing_ref: str = "error",
    drop_incomplete: bool = False,
    dense_terms: int | None = None,
) -> CombatModel:
    """Fit ComBat from cells alone; samples without a batch or covariate are refused.

    Models of more than ``dense_terms`` columns eliminate their largest block of levels first.
    """
    features, cells = held.names, held.table
    design = Design(held.batch, held.covars, held.continuous, ref_batch=None if ref_batch is None else str(ref_batch))
    facts = _facts(cells, design, features[0], DENSE_TERMS if dense_terms is None else dense_terms)
    if facts["missing"]:
        columns = [design.batch, *design.covars, *design.continuous]
        raise ValueError(f"missing values in {columns}: {facts['missing']} samples lack one of them")
    if facts["gaps"] and not drop_incomplete:
        raise ValueError(f"features with missing or non-finite values: {facts['gaps']}")
    names = [f for f in features if f not in set(facts["gaps"])]
    if not names:
        raise ValueError("no complete feature to harmonize")
    if eb and len(names) < 2:
        raise ValueError("empirical Bayes needs at least two features; use eb=False")
    if facts["gaps"]:
        cells = cells.filter(~F.col("feature").isin(facts["gaps"]))
    design.levels = facts["levels"]
    if design.ref_batch is not None and facts["ref_size"] is None:
        if on_missing_ref != "ignore":
            raise ValueError(f"reference batch {ref_batch!r} not found")
        design.ref_batch = None
    if design.ref_batch is not None and facts["ref_size"] < 2:
        raise ValueError("the reference batch needs at least two samples")
    if not mean_only and facts["smallest"] is not None and facts["smallest"]["n"] < 2:
        raise ValueError(
            f"batch {facts['smallest']['__batch']!r} has one sample and so no variance; use mean_only"
        )

    per_feature, per_batch, effects = _location_scale(cells, design, names[0], facts["large"])
    estimates = compact(materialize(_estimates(per_feature, per_batch, mean_only), "combat-estimates"))
    priors = _priors(estimates, mean_only)
    stars = _shrunken(estimates, priors, eb, parametric, mean_only, design.ref_batch, len(names))
    feature_batches = estimates.drop("ssq", "n").join(stars, ["feature", "batch"])
    feature_batches = compact(materialize(feature_batches, "combat-stars"))
    terms = F.array(*[F.lit(t) for t in design.term_names()]) if design.terms else F.array().cast("array<string>")
    # One entry per model column; the effects of an absorbed covariate are a table of their own.
    table = per_feature.select(
        "feature", "stand_mean", "var_pooled", "mod_mean", F.map_from_arrays(terms, "__beta").alias("betas")
    )
    return CombatModel(table, priors, feature_batches, names, design, mean_only, held, effects)


def _zero_if_known(checks: Sequence[tuple[Column, str, Column]]) -> Column:
    """0.0, or a failure while running, so no extra pass checks the rows first."""
    result = None
    for known, what, shown in checks:
        message = F.concat(F.lit(f"{what} not part of the training table: "), F.coalesce(shown, F.lit("NULL")))
        failed = F.raise_error(message).cast("double")
        result = F.when(~known, failed) if result is None else result.when(~known, failed)
    return result.otherwise(F.lit(0.0))


def _apply(model: CombatModel, df: DataFrame, average_covariates: bool) -> DataFrame:
    design, names = model.design, model.names
    require_columns(df, [design.batch, *names])
    rows = df.withColumn("__batch", col(design.batch).cast("string"))
    place = {f: i for i, f in enumerate(names)}
    order = F.create_map(*[x for f, i in place.items() for x in (F.lit(f), F.lit(i))])
    terms = design.term_names()
    use_covariates = bool(terms) and not average_covariates
    coefficients = [F.col("betas")[t] for t in terms] if use_covariates else []
    sd = F.sqrt("var_pooled")
    level = F.col("stand_mean") + (F.col("mod_mean") if average_covariates else F.lit(0.0))
    entry = F.struct(
        order[F.col("feature")].alias("i"),
        level.alias("m"),
        (F.col("gamma_star") * sd).alias("shift"),
        F.try_divide(F.lit(1.0), F.sqrt("delta_star")).alias("rate"),
        *[c.alias(f"b{j}") for j, c in enumerate(coefficients)],
    )
    packed = (
        model.feature_batches.join(model.features, "feature")
        .groupBy(F.col("batch").alias("__batch"))
        .agg(F.sort_array(F.collect_list(entry)).alias("__e"))
    )
    # Plain arrays of doubles: reading one number per feature and row stays cheap.
    arrays = packed.select(
        "__batch",
        *[F.col("__e")[k].alias(f"__{k}") for k in ("m", "shift", "rate")],
        *[F.col("__e")[f"b{j}"].alias(f"__b{j}") for j in range(len(coefficients))],
    )
    rows = attach(rows, arrays, ["__batch"], label="combat-arrays")
    checks = [(F.col("__m").isNotNull(), "batch", F.col("__batch"))]
    absorbed = None if average_covariates else design.absorbed
    if absorbed:
        by_level = F.sort_array(F.collect_list(F.struct(order[F.col("feature")].alias("i"), "effect")))["effect"]
        rows = rows.withColumn("__level", col(absorbed).cast("string"))
        rows = attach(rows, model.effects.groupBy(F.col("level").alias("__level")).agg(by_level.alias("__g")), ["__level"], label="combat-levels")
        checks.append((F.col("__g").isNotNull(), f"covariate {absorbed}", F.col("__level")))
    if not average_covariates:
        require_columns(df, [*design.covars, *design.continuous])
        for c in design.covars:
            if c == absorbed:
                continue
            value = col(c).cast("string")
            seen = F.coalesce(value.isin(design.levels[c]), F.lit(False))
            checks.append((seen, f"covariate {c}", value))
    rows = rows.withColumn("__known", _zero_if_known(checks))
    if use_covariates:
        rows = rows.withColumns({f"__z{j}": design.row_value(j) for j in range(len(terms))})

    def harmonized(name: str) -> Column:
        i = place[name]
        center = F.col("__m")[i] + F.col("__known")
        for j in range(len(coefficients)):
            center = center + F.col(f"__b{j}")[i] * F.col(f"__z{j}")
        if absorbed:
            center = center + F.col("__g")[i]
        y = finite(col(name))
        value = (y - center - F.col("__shift")[i]) * F.col("__rate")[i] + center
        if design.ref_batch is not None and not average_covariates:
            value = F.when(F.col("__batch") == design.ref_batch, y).otherwise(value)
        return value.alias(name)

    return rows.select(*[harmonized(c) if c in place else col(c) for c in df.columns])


def attach_batch(
    features: DataFrame,
    batch: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Left join of batch and covariate columns; refuses tables lacking them."""
    require_columns(batch, columns)
    return features.join(batch.select(*[col(k) for k in keys], *[col(c) for c in columns]), list(keys), "left")


def combat(
    features: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = KEYS,
    batch_col: str = "batch",
    covars: Sequence[str] = (),
    order_by: Sequence[str] | None = None,
    names: Sequence[str] | None = None,
    continuous: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Harmonize a feature table within itself.

    Duplicate keys are dropped on both sides (first row kept), batch information
    with its covariates, categorical and ``continuous``, is joined and must be
    complete, then the table is fitted and transformed.
    """
    keys, covars, continuous = list(keys), list(covars), list(continuous)
    return combat_study(features, batch, keys, batch_col, covars, order_by, names, continuous, **options)[1]


def combat_study(
    features: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = KEYS,
    batch_col: str = "batch",
    covars: Sequence[str] = (),
    order_by: Sequence[str] | None = None,
    names: Sequence[str] | None = None,
    continuous: Sequence[str] = (),
    **options,
) -> tuple[CombatModel, DataFrame]:
    """The fitted model, which holds the cells of the table, and the harmonized table."""
    keys, covars, continuous = list(keys), list(covars), list(continuous)
    ready = materialize(prepare(features, batch, keys, [*covars, *continuous, batch_col], order_by), "prepared")
    if names is None:
        names = feature_columns(features, exclude=keys)
    model = fit_combat(ready, names, batch_col, covars, continuous, **options)
    return model, model.transform(ready).select(*[col(c) for c in features.columns])


def prepare(
    features: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Both tables without duplicate keys, joined. Who reads it twice writes it: the shuffles behind it cost more
    than the table. Fitting reads the features and batch columns of it only, and finds samples without batch
    information in the cells."""
    require_columns(batch, columns)
    rest = [c for c in features.columns if c not in keys]
    unique = dedupe_first(features, keys, order_by or rest)
    unique_batch = dedupe_first(batch.select(*[col(c) for c in [*keys, *columns]]), keys, columns)
    return attach_batch(unique, unique_batch, columns, keys)


def combat_external(
    train: DataFrame,
    train_batch: DataFrame,
    new: DataFrame,
    new_batch: DataFrame,
    keys: Sequence[str] = KEYS,
    batch_col: str = "batch",
    covars: Sequence[str] = (),
    ref_batch: str | None = None,
    order_by: Sequence[str] | None = None,
    names: Sequence[str] | None = None,
    continuous: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Harmonize new samples towards a training table.

    The training table is read once, into cells; to call this repeatedly keep the cells
    (``training_cells``) and use ``harmonize_towards``.
    """
    if names is None:
        names = feature_columns(new, exclude=list(keys))
    require_columns(train, names)
    cells = training_cells(train, train_batch, keys, batch_col, covars, order_by, names, continuous)
    return harmonize_towards(cells, new, new_batch, keys, ref_batch, order_by, **options)


def training_cells(
    train: DataFrame,
    train_batch: DataFrame,
    keys: Sequence[str] = KEYS,
    batch_col: str = "batch",
    covars: Sequence[str] = (),
    order_by: Sequence[str] | None = None,
    names: Sequence[str] | None = None,
    continuous: Sequence[str] = (),
) -> CombatCells:
    """Cells of a training table: all that later calls need of it."""
    keys, columns = list(keys), [*covars, *continuous, batch_col]
    if names is None:
        names = feature_columns(train, exclude=keys)
    ready = prepare(train, train_batch, keys, columns, order_by)
    return CombatCells.of(ready, names, batch_col, covars, continuous)


def harmonize_towards(
    training: CombatCells,
    new: DataFrame,
    new_batch: DataFrame,
    keys: Sequence[str] = KEYS,
    ref_batch: str | None = None,
    order_by: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Harmonize new samples towards stored training cells; no training sample is read.

    With a reference batch, training batches are renamed with the suffix ``_ref``
    so that they stay apart from new batches of the same name; without one all
    training samples form a single reference batch. Only new samples return.
    """
    keys, names = list(keys), training.names
    columns = [*training.covars, *training.continuous, training.batch]
    require_columns(new, names)
    fresh = materialize(prepare(new, new_batch, keys, columns, order_by), "prepared")
    known = F.col("__batch").isNotNull()
    if ref_batch in (None, "", "None"):
        old, reference = training.relabelled(F.when(known, F.lit("ref"))), "ref"
    else:
        old, reference = training.relabelled(F.concat(F.col("__batch"), F.lit("_ref"))), f"{ref_batch}_ref"
    own = CombatCells.of(fresh, names, training.batch, training.covars, training.continuous)
    model = fit_cells(old.merge(own), reference, **options)
    return model.transform(fresh).select(*[col(c) for c in new.columns])


def standardized_long(df: DataFrame, model: CombatModel, keys: Sequence[str]) -> DataFrame:
    """Standardized samples ``keys..., feature, value`` (covariate-free designs)."""
    scale = model.features.select("feature", "stand_mean", F.sqrt("var_pooled").alias("sd"))
    long = attach(to_long(df, keys, model.names), scale, ["feature"], label="combat-scale")
    return long.select(
        *[col(k) for k in keys],
        "feature",
        F.try_divide(F.col("value") - F.col("stand_mean"), F.col("sd")).alias("value"),
    )
