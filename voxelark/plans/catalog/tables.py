"""Statistics, normalization, duplicates, lists and table assembly."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline as MlPipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from voxelark.functions.columns import feature_columns, to_long
from voxelark.functions.sizing import attach, materialize, shared_dir
from voxelark.operators.normalize import (
    NormalizerModel,
    attach_stats,
    fit_normalizer,
    normalize,
    normalize_external,
)
from voxelark.operators.predict import LinearScorer, predict
from voxelark.operators.quantiles import merge_sketches, quantile_sketches, rank_select, sketch_statistics
from voxelark.operators.selection import include, incomplete_rows, skip
from voxelark.operators.stats import (
    dedupe_first,
    describe,
    describe_levels,
    duplicates,
    moments,
    stats_to_long,
    stats_to_wide,
)
from voxelark.plans.catalog.common import load, rounded, sql_round
from voxelark.sources.tables import (
    append_features,
    assemble_configs,
    merge_feature_tables,
    prefix_features,
    read_features,
    write_features,
    write_stats,
)

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ID = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]
STRATUM = "l_returnflag"
CUT = "1998-01-01"


def _lineitem(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(*ID, STRATUM, *FEATURES)


def describe_all(spark, sf_dir):
    return rounded(describe(_lineitem(spark, sf_dir), FEATURES), 4)


def describe_by_stratum(spark, sf_dir):
    return rounded(describe(_lineitem(spark, sf_dir), FEATURES, [STRATUM]), 4)


def describe_with_overall(spark, sf_dir):
    return rounded(describe_levels(_lineitem(spark, sf_dir), FEATURES, STRATUM), 4)


def describe_merged_moments(spark, sf_dir):
    """Overall level merged from the strata instead of a second scan."""
    stats = describe_levels(_lineitem(spark, sf_dir), FEATURES, STRATUM, quartiles=False)
    return rounded(stats.drop("p25", "p50", "p75"), 4)


def statistics_wide_layout(spark, sf_dir):
    stats = describe_levels(_lineitem(spark, sf_dir), FEATURES, STRATUM)
    return rounded(stats_to_wide(stats, FEATURES, STRATUM), 4)


def statistics_wide_round_trip(spark, sf_dir):
    stats = describe_levels(_lineitem(spark, sf_dir), FEATURES, STRATUM)
    return rounded(stats_to_long(stats_to_wide(stats, FEATURES, STRATUM), STRATUM), 4)


def quantiles_by_rank(spark, sf_dir):
    """The bucketed rank selection used for groups too large for one buffer."""
    long = to_long(_lineitem(spark, sf_dir), [STRATUM], FEATURES)
    q = rank_select(long, [STRATUM, "feature"], "value", [0.02, 0.25, 0.5, 0.75, 0.98])
    names = ("p02", "p25", "p50", "p75", "p98")
    return rounded(q.select(STRATUM, "feature", *[F.col("q")[i].alias(n) for i, n in enumerate(names)]), 4)


PROBS = [0.02, 0.25, 0.5, 0.75, 0.98]


def quantiles_sketched(spark, sf_dir):
    """Sketches of every ship mode status and stratum, merged to strata: exact moments, and whether the estimated
    quantiles lie within one per cent of the wanted rank and the distinct count within a tenth."""
    df = load(spark, sf_dir, "lineitem")
    fine = quantile_sketches(df, FEATURES, [STRATUM, "l_linestatus"])
    read = sketch_statistics(merge_sketches(fine, [STRATUM]), PROBS)
    read = materialize(read, "sketches")
    ranks = attach(to_long(df, [STRATUM], FEATURES), read.select(STRATUM, "feature", "q"), [STRATUM, "feature"], "inner", part_of=read)
    v = F.col("value")
    # A quantile is right if the wanted rank lies between the shares below it and up to it.
    shares = [
        F.struct(F.avg((v < F.col("q")[i]).cast("double")).alias("below"), F.avg((v <= F.col("q")[i]).cast("double")).alias("upto"))
        for i in range(len(PROBS))
    ]
    near = F.lit(True)
    for i, p in enumerate(PROBS):
        near = near & (F.col(f"s{i}.below") <= p + 0.01) & (F.col(f"s{i}.upto") >= p - 0.01)
    exact = F.count_distinct(v).alias("different")
    checked = ranks.groupBy(STRATUM, "feature").agg(exact, *[s.alias(f"s{i}") for i, s in enumerate(shares)])
    both = read.join(checked, [STRATUM, "feature"])
    counted = F.abs(F.col("distinct") - F.col("different")) <= 0.1 * F.col("different")
    return rounded(
        both.select(STRATUM, "feature", "count", "mean", "std", "min", "max", near.alias("quantiles_near"), counted.alias("distinct_near")), 4
    )


def quantiles_refined(spark, sf_dir):
    """Percentiles of prices crowded around one value, so that slices are cut again until one fits."""
    line = load(spark, sf_dir, "lineitem")
    crowded = line.select(STRATUM, (F.lit(1e6) + F.col("l_extendedprice") / 1e4).alias("value"))
    q = rank_select(crowded, [STRATUM], "value", [0.1, 0.5, 0.9], fit_values=50)
    return rounded(q.select(STRATUM, *[F.col("q")[i].alias(n) for i, n in enumerate(("p10", "p50", "p90"))]), 3)


def statistics_never_replaced(spark, sf_dir):
    """Statistics of two groupings written to one path: both stay, the second under a name of its own."""
    df, path = _lineitem(spark, sf_dir), f"{shared_dir(spark)}/voxelark/stats-{uuid.uuid4().hex}"
    tables = []
    for i, by in enumerate(([], [STRATUM])):
        stats = describe(df, FEATURES, by).withColumn("level", F.col(STRATUM) if by else F.lit("all"))
        written = write_stats(stats.select("level", "feature", "count", "mean"), path)
        tables.append(spark.read.parquet(written).select(F.lit(i).alias("copy"), F.lit(written == path).alias("at_path"), "*"))
    return rounded(tables[0].unionByName(tables[1]), 4)


def columns_used(spark, sf_dir):
    """The columns of a table that count as features, with how many values each has."""
    joined = load(spark, sf_dir, "lineitem").withColumnsRenamed(
        {"l_orderkey": "patientID_order", "l_linenumber": "diagnostics_line", "l_tax": "tax_diagnostics"}
    )
    names = feature_columns(joined, exclude=["l_suppkey"])
    return moments(joined, names, []).select("feature", "count")


def _normalized(method, stratified):
    def run(spark, sf_dir):
        df = _lineitem(spark, sf_dir)
        return rounded(normalize(df, FEATURES, method, STRATUM, stratified))

    return run


def _normalized_external(method):
    def run(spark, sf_dir):
        """Statistics of earlier shipments (level 'R' unseen) applied to later ones."""
        df = load(spark, sf_dir, "lineitem")
        train = df.filter((F.col("l_shipdate") < CUT) & (F.col(STRATUM) != "R"))
        new = df.filter(F.col("l_shipdate") >= CUT).select(*ID, STRATUM, *FEATURES)
        stats = fit_normalizer(train, FEATURES, method, STRATUM, all_statistics=True).stats
        return rounded(normalize_external(new, stats, FEATURES, method, STRATUM))

    return run


def long_rows_with_statistics(spark, sf_dir):
    df = load(spark, sf_dir, "lineitem")
    stats = describe_levels(df.filter(F.col(STRATUM) != "R"), FEATURES, STRATUM, quartiles=False)
    long = to_long(df, [*ID, STRATUM], ["l_discount", "l_tax"])
    return rounded(attach_stats(long, stats, STRATUM).drop("p25", "p50", "p75"))


def first_of_duplicates(spark, sf_dir):
    df = _lineitem(spark, sf_dir)
    return dedupe_first(df, ["l_orderkey", "l_linenumber"], ["l_suppkey", "l_partkey"])


def dropped_duplicates(spark, sf_dir):
    df = _lineitem(spark, sf_dir)
    return duplicates(df, ["l_orderkey", "l_linenumber"], ["l_suppkey", "l_partkey"])


def _regional_nations(spark, sf_dir):
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    chosen = region.filter(F.col("r_regionkey") == 1).withColumnRenamed("r_regionkey", "n_regionkey")
    return nation.join(chosen, "n_regionkey", "left_semi").withColumnRenamed("n_nationkey", "c_nationkey")


def include_listed(spark, sf_dir):
    return include(load(spark, sf_dir, "customer"), _regional_nations(spark, sf_dir), ["c_nationkey"])


def skip_listed(spark, sf_dir):
    return skip(load(spark, sf_dir, "customer"), _regional_nations(spark, sf_dir), ["c_nationkey"])


def missing_batch_info(spark, sf_dir):
    """Documents without label information after the left join."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    joined = docs.join(load(spark, sf_dir, "labels"), "doc_id", "left")
    return incomplete_rows(joined, ["quality", "toxic"])


def renamed_config_features(spark, sf_dir):
    part = load(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_size").cast("double").alias("original_size"),
        F.col("p_retailprice").alias("original_retailprice"),
    )
    return prefix_features(part, "Base", ["p_partkey"])


def side_by_side_configs(spark, sf_dir):
    """Two per-supplier feature blocks, diagnostics from the first only."""
    line, keys = load(spark, sf_dir, "lineitem"), ["l_suppkey"]
    blocks = []
    for name, flag in (("Returned", "R"), ("Accepted", "A")):
        rows = line.filter(F.col(STRATUM) == flag)
        block = rows.groupBy(*keys).agg(
            F.count("*").alias("diagnostics_rows"),
            F.avg("l_quantity").alias("original_mean"),
            F.max("l_extendedprice").alias("original_max"),
        )
        blocks.append(prefix_features(block, name, keys))
    return rounded(assemble_configs(blocks, keys))


def merged_partial_tables(spark, sf_dir):
    """Partial tables with different columns become one, by name."""
    line = load(spark, sf_dir, "lineitem")
    parts = [
        line.filter(F.col(STRATUM) == "A").select(*ID, "l_quantity", "l_tax"),
        line.filter(F.col(STRATUM) == "N").select("l_tax", *ID, "l_discount"),
        line.filter(F.col(STRATUM) == "R").select(*ID, "l_quantity", "l_discount"),
    ]
    return merge_feature_tables(parts)


# Weights of a linear score, standing in for a trained model.
WEIGHTS = {"l_tax": 3.0, "l_quantity": 0.25, "l_discount": -1.5}


def scored_rows(spark, sf_dir):
    model = LinearScorer(list(WEIGHTS), list(WEIGHTS.values()), 0.5)
    return rounded(predict(_lineitem(spark, sf_dir), model, keys=ID))


def scored_by_spark_model(spark, sf_dir):
    """A Spark ML regression of price on quantity, fitted and applied."""
    df = _lineitem(spark, sf_dir)
    stages = [
        VectorAssembler(inputCols=["l_quantity"], outputCol="features"),
        LinearRegression(featuresCol="features", labelCol="l_extendedprice", solver="normal"),
    ]
    return rounded(predict(df, MlPipeline(stages=stages).fit(df), keys=ID), 3)


def saved_statistics_applied(spark, sf_dir):
    """Statistics written, read back, and applied."""
    df = _lineitem(spark, sf_dir)
    path = f"{shared_dir(spark)}/voxelark/normalizer-{uuid.uuid4().hex}"
    fit_normalizer(df, FEATURES, "zscore", STRATUM, all_statistics=True).save(path)
    return rounded(NormalizerModel.load(spark, path).transform(df))


def appended_table(spark, sf_dir):
    """A table written, appended to, and read back."""
    df = _lineitem(spark, sf_dir)
    path = f"{shared_dir(spark)}/voxelark/features-{uuid.uuid4().hex}"
    write_features(df.filter(F.col(STRATUM) == "A"), path)
    append_features(df.filter(F.col(STRATUM) == "N"), path)
    return read_features(spark, path)


QUERIES = {
    "quantiles_sketched": quantiles_sketched,
    "quantiles_refined": quantiles_refined,
    "statistics_never_replaced": statistics_never_replaced,
    "columns_used": columns_used,
    "scored_by_spark_model": scored_by_spark_model,
    "saved_statistics_applied": saved_statistics_applied,
    "appended_table": appended_table,
    "describe_all": describe_all,
    "describe_by_stratum": describe_by_stratum,
    "describe_with_overall": describe_with_overall,
    "describe_merged_moments": describe_merged_moments,
    "statistics_wide_layout": statistics_wide_layout,
    "statistics_wide_round_trip": statistics_wide_round_trip,
    "quantiles_by_rank": quantiles_by_rank,
    "normalize_minmax_stratified": _normalized("MinMax", True),
    "normalize_zscore_stratified": _normalized("Z-Score", True),
    "normalize_robust_stratified": _normalized("Robust Scaling", True),
    "normalize_minmax_overall": _normalized("min max", False),
    "normalize_zscore_overall": _normalized("z score", False),
    "normalize_robust_overall": _normalized("robust scaling", False),
    "normalize_minmax_external": _normalized_external("MinMax"),
    "normalize_robust_external": _normalized_external("RobustScaling"),
    "long_rows_with_statistics": long_rows_with_statistics,
    "first_of_duplicates": first_of_duplicates,
    "dropped_duplicates": dropped_duplicates,
    "include_listed": include_listed,
    "skip_listed": skip_listed,
    "missing_batch_info": missing_batch_info,
    "renamed_config_features": renamed_config_features,
    "side_by_side_configs": side_by_side_configs,
    "merged_partial_tables": merged_partial_tables,
    "scored_rows": scored_rows,
}

# ---------------------------------------------------------------- checking SQL

_LONG = " UNION ALL ".join(
    f"SELECT {', '.join(ID)}, {STRATUM}, l_shipdate, '{f}' AS feature, {f} AS value FROM lineitem"
    for f in FEATURES
)


def _stats_sql(digits: int | None, quartiles: bool = True) -> str:
    def r(e):
        return sql_round(e, digits) if digits is not None else e

    columns = [
        "count(value) AS count",
        f"{r('avg(value)')} AS mean",
        f"{r('stddev_samp(value)')} AS std",
        f"{r('min(value)')} AS min",
    ]
    if quartiles:
        columns += [
            f"{r(f'quantile_cont(value, {p})')} AS {n}"
            for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
        ]
    return ", ".join([*columns, f"{r('max(value)')} AS max"])


def _levels_sql(digits, quartiles=True, source="long"):
    s = _stats_sql(digits, quartiles)
    return (
        f"SELECT {STRATUM}, feature, {s} FROM {source} GROUP BY 1, 2 "
        f"UNION ALL SELECT 'all', feature, {s} FROM {source} GROUP BY 2"
    )


_WIDE = f"""WITH long AS ({_LONG}), st AS ({_levels_sql(None)}),
u AS (""" + " UNION ALL ".join(
    f"SELECT {STRATUM}, feature, '{label}' AS statistics, CAST({name} AS DOUBLE) AS value FROM st"
    for label, name in (
        ("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
        ("25%", "p25"), ("50%", "p50"), ("75%", "p75"), ("max", "max"),
    )
) + ") SELECT statistics, " + STRATUM + ", " + ", ".join(
    sql_round(f"max(CASE WHEN feature = '{f}' THEN value END)", 4) + f" AS {f}" for f in FEATURES
) + " FROM u GROUP BY 1, 2"

_FORMULA = {
    "minmax": ("min({f}) OVER w", "max({f}) OVER w - min({f}) OVER w"),
    "zscore": ("avg({f}) OVER w", "stddev_samp({f}) OVER w"),
    "robust": (
        "quantile_cont({f}, 0.5) OVER w",
        "quantile_cont({f}, 0.75) OVER w - quantile_cont({f}, 0.25) OVER w",
    ),
}


def _normalize_sql(method: str, stratified: bool) -> str:
    center, scale = _FORMULA[method]
    parts = ", ".join(
        sql_round(f"({f} - {center.format(f=f)}) / nullif({scale.format(f=f)}, 0)") + f" AS {f}"
        for f in FEATURES
    )
    window = f"PARTITION BY {STRATUM}" if stratified else ""
    return f"SELECT {', '.join(ID)}, {STRATUM}, {parts} FROM lineitem WINDOW w AS ({window})"


def _external_sql(method: str) -> str:
    plain = {
        "minmax": ("min({f})", "max({f}) - min({f})"),
        "robust": ("quantile_cont({f}, 0.5)", "quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25)"),
    }[method]
    aggregates = ", ".join(
        f"{plain[0].format(f=f)} AS c_{f}, {plain[1].format(f=f)} AS s_{f}" for f in FEATURES
    )
    values = ", ".join(
        sql_round(
            f"(n.{f} - CASE WHEN o.k IS NULL THEN a.c_{f} ELSE o.c_{f} END) / "
            f"nullif(CASE WHEN o.k IS NULL THEN a.s_{f} ELSE o.s_{f} END, 0)"
        )
        + f" AS {f}"
        for f in FEATURES
    )
    keys = ", ".join(f"n.{k}" for k in [*ID, STRATUM])
    return f"""WITH train AS (SELECT * FROM lineitem WHERE l_shipdate < '{CUT}' AND {STRATUM} <> 'R'),
own AS (SELECT {STRATUM} AS k, {aggregates} FROM train GROUP BY 1),
every AS (SELECT {aggregates} FROM train)
SELECT {keys}, {values} FROM lineitem n LEFT JOIN own o ON n.{STRATUM} = o.k, every a
WHERE n.l_shipdate >= '{CUT}'"""


_RANKED = f"""SELECT {', '.join([*ID, STRATUM, *FEATURES])},
 row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_suppkey, l_partkey, {', '.join([STRATUM, *FEATURES])}) AS rn FROM lineitem"""
_DEDUPE_COLUMNS = ", ".join([*ID, STRATUM, *FEATURES])
_LISTED = "SELECT n_nationkey FROM nation WHERE n_regionkey = 1"

ORACLES = {
    "quantiles_sketched": " UNION ALL ".join(
        f"""SELECT l_returnflag, '{f}' AS feature, count({f}) AS count, {sql_round(f'avg({f})', 4)} AS mean,
 {sql_round(f'stddev_samp({f})', 4)} AS std, {sql_round(f'min({f})', 4)} AS min, {sql_round(f'max({f})', 4)} AS max,
 TRUE AS quantiles_near, TRUE AS distinct_near FROM lineitem GROUP BY 1"""
        for f in FEATURES
    ),
    "quantiles_refined": "SELECT l_returnflag, " + ", ".join(
        f"{sql_round(f'quantile_cont(1e6 + l_extendedprice / 1e4, {p})', 3)} AS {n}"
        for p, n in ((0.1, "p10"), (0.5, "p50"), (0.9, "p90"))
    ) + " FROM lineitem GROUP BY 1",
    "statistics_never_replaced": " UNION ALL ".join(
        f"""SELECT {i}::INTEGER AS copy, {i == 0} AS at_path, {level} AS level, '{f}' AS feature, count({f}) AS count,
 {sql_round(f'avg({f})', 4)} AS mean FROM lineitem{group}"""
        for i, level, group in ((0, "'all'", ""), (1, "l_returnflag", " GROUP BY l_returnflag"))
        for f in FEATURES
    ),
    "columns_used": " UNION ALL ".join(
        f"SELECT '{n}' AS feature, count({c}) AS count FROM lineitem"
        for n, c in (("l_partkey", "l_partkey"), ("l_quantity", "l_quantity"), ("l_extendedprice", "l_extendedprice"),
                     ("l_discount", "l_discount"), ("tax_diagnostics", "l_tax"))
    ),
    "scored_by_spark_model": f"""SELECT {', '.join(ID)}, {sql_round('a + b * l_quantity', 3)} AS predictions
FROM lineitem, (SELECT regr_intercept(l_extendedprice, l_quantity) AS a,
  regr_slope(l_extendedprice, l_quantity) AS b FROM lineitem)""",
    "saved_statistics_applied": _normalize_sql("zscore", True),
    "appended_table": f"SELECT {', '.join([*ID, STRATUM, *FEATURES])} FROM lineitem WHERE {STRATUM} IN ('A', 'N')",
    "describe_all": f"WITH long AS ({_LONG}) SELECT feature, {_stats_sql(4)} FROM long GROUP BY 1",
    "describe_by_stratum": f"WITH long AS ({_LONG}) SELECT {STRATUM}, feature, {_stats_sql(4)} FROM long GROUP BY 1, 2",
    "describe_with_overall": f"WITH long AS ({_LONG}) {_levels_sql(4)}",
    "describe_merged_moments": f"WITH long AS ({_LONG}) {_levels_sql(4, False)}",
    "statistics_wide_layout": _WIDE,
    "statistics_wide_round_trip": f"WITH long AS ({_LONG}) {_levels_sql(4)}",
    "quantiles_by_rank": f"WITH long AS ({_LONG}) SELECT {STRATUM}, feature, "
    + ", ".join(
        sql_round(f"quantile_cont(value, {p})", 4) + f" AS {n}"
        for p, n in ((0.02, "p02"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.98, "p98"))
    )
    + " FROM long GROUP BY 1, 2",
    "normalize_minmax_stratified": _normalize_sql("minmax", True),
    "normalize_zscore_stratified": _normalize_sql("zscore", True),
    "normalize_robust_stratified": _normalize_sql("robust", True),
    "normalize_minmax_overall": _normalize_sql("minmax", False),
    "normalize_zscore_overall": _normalize_sql("zscore", False),
    "normalize_robust_overall": _normalize_sql("robust", False),
    "normalize_minmax_external": _external_sql("minmax"),
    "normalize_robust_external": _external_sql("robust"),
    "long_rows_with_statistics": f"""WITH long AS ({_LONG}),
st AS ({_levels_sql(6, False, "(SELECT * FROM long WHERE l_returnflag <> 'R')")})
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey, l.{STRATUM}, l.feature,
 {sql_round('l.value')} AS value, s.count, s.mean, s.std, s.min, s.max
FROM long l JOIN st s ON s.feature = l.feature
 AND s.{STRATUM} = CASE WHEN l.{STRATUM} = 'R' THEN 'all' ELSE l.{STRATUM} END
WHERE l.feature IN ('l_discount', 'l_tax')""",
    "first_of_duplicates": f"SELECT {_DEDUPE_COLUMNS} FROM ({_RANKED}) WHERE rn = 1",
    "dropped_duplicates": f"SELECT {_DEDUPE_COLUMNS} FROM ({_RANKED}) WHERE rn > 1",
    "include_listed": f"SELECT * FROM customer WHERE c_nationkey IN ({_LISTED})",
    "skip_listed": f"SELECT * FROM customer WHERE c_nationkey NOT IN ({_LISTED})",
    "missing_batch_info": """SELECT d.doc_id, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL OR l.toxic IS NULL""",
    "renamed_config_features": """SELECT p_partkey, CAST(p_size AS DOUBLE) AS Base_size,
 p_retailprice AS Base_retailprice FROM part""",
    "side_by_side_configs": f"""WITH a AS (SELECT l_suppkey, count(*) AS diagnostics_rows,
  {sql_round('avg(l_quantity)')} AS Returned_mean, {sql_round('max(l_extendedprice)')} AS Returned_max
  FROM lineitem WHERE {STRATUM} = 'R' GROUP BY 1),
b AS (SELECT l_suppkey, {sql_round('avg(l_quantity)')} AS Accepted_mean,
  {sql_round('max(l_extendedprice)')} AS Accepted_max FROM lineitem WHERE {STRATUM} = 'A' GROUP BY 1)
SELECT * FROM a FULL OUTER JOIN b USING (l_suppkey)""",
    "merged_partial_tables": f"""SELECT {', '.join(ID)}, l_quantity, l_tax, NULL::DOUBLE AS l_discount
 FROM lineitem WHERE {STRATUM} = 'A'
UNION ALL SELECT {', '.join(ID)}, NULL, l_tax, l_discount FROM lineitem WHERE {STRATUM} = 'N'
UNION ALL SELECT {', '.join(ID)}, l_quantity, NULL, l_discount FROM lineitem WHERE {STRATUM} = 'R'""",
    "scored_rows": f"""SELECT {', '.join(ID)},
 {sql_round('0.5 + 3.0 * l_tax + 0.25 * l_quantity - 1.5 * l_discount')} AS predictions FROM lineitem""",
}
