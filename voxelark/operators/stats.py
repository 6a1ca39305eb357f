"""Describe statistics, duplicate handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelark.functions.columns import col, number, struct_of, to_long
from voxelark.functions.sizing import DEFAULT_HOT_ROWS, HOT_CONF, attach, compact, materialize
from voxelark.operators.quantiles import BUILTIN_GROUP_ROWS, grouped_quantiles, quantile_sketches, rank_select, sketch_statistics

ALL = "all"
QUARTILES = (0.25, 0.5, 0.75)
# Row labels of the wide statistics layout, with our column names.
WIDE_LABELS = {
    "count": "count",
    "mean": "mean",
    "std": "std",
    "min": "min",
    "25%": "p25",
    "50%": "p50",
    "75%": "p75",
    "max": "max",
}
STAT_COLUMNS = tuple(WIDE_LABELS.values())
WIDE_FEATURE_LIMIT = 256


def _moment_fields(value: Column) -> list[Column]:
    return [
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def moments(df: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """count/mean/std/min/max per group and feature, in one pass.

    A moderate number of features is aggregated side by side and turned long
    afterwards, so rows are never multiplied; very wide tables are unpivoted and
    combined map-side.
    """
    by = list(by)
    if len(features) > WIDE_FEATURE_LIMIT:
        return to_long(df, by, features).groupBy(*by, "feature").agg(*_moment_fields(F.col("value")))
    packed = [F.struct(*_moment_fields(number(col(f)))).alias(f"__m{i}") for i, f in enumerate(features)]
    wide = df.groupBy(*[col(b) for b in by]).agg(*packed)
    entries = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f"__m{i}").alias("m")) for i, f in enumerate(features)]
    )
    return wide.select(*by, F.inline(entries)).select(*by, "feature", "m.*")


def _described_in_one_pass(df: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    quartiles = F.array(*[F.lit(p) for p in QUARTILES])
    packed = []
    for i, f in enumerate(features):
        value = number(col(f))
        q = F.percentile(value, quartiles)
        extra = [q[k].alias(name) for k, name in enumerate(("p25", "p50", "p75"))]
        packed.append(F.struct(*_moment_fields(value), *extra).alias(f"__m{i}"))
    wide = df.groupBy(*[col(b) for b in by]).agg(*packed)
    entries = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f"__m{i}").alias("m")) for i, f in enumerate(features)]
    )
    return wide.select(*by, F.inline(entries)).select(*by, "feature", *[f"m.{s}" for s in STAT_COLUMNS])


def describe(
    df: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = (),
    group_rows: int | None = None,
    approx: bool = False,
) -> DataFrame:
    """Statistics per feature, or per group and feature when ``by`` is given.

    ``approx`` takes quartiles from mergeable sketches: one pass, whatever the size of a group.
    Exact quartiles use the built-in aggregate while the values of all features of the largest
    group stay below its bound, and rank selection beyond.
    """
    by = list(by)
    if approx:
        read = sketch_statistics(quantile_sketches(df, features, by), QUARTILES)
        quartiles = [F.col("q")[i].alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
        return read.select(*[col(b) for b in by], "feature", "count", "mean", "std", "min", *quartiles, "max")
    if group_rows is None:
        sizes = df.groupBy(*[col(b) for b in by]).count()
        group_rows = int(sizes.agg(F.coalesce(F.max("count"), F.lit(0)).alias("m")).first()["m"])
    if group_rows * len(features) <= BUILTIN_GROUP_ROWS and len(features) <= WIDE_FEATURE_LIMIT:
        return _described_in_one_pass(df, features, by)
    base = moments(df, features, by)
    quantiles = grouped_quantiles(
        to_long(df, by, features), [*by, "feature"], "value", QUARTILES, group_rows
    )
    # Joined by a struct, so that a NULL stratum finds its quantiles.
    key = struct_of([*by, "feature"]).alias("__k")
    return (
        base.withColumn("__k", key)
        .join(quantiles.select(key, "q"), "__k", "left")
        .withColumns({"p25": F.col("q")[0], "p50": F.col("q")[1], "p75": F.col("q")[2]})
        .select(*[col(b) for b in by], "feature", *STAT_COLUMNS)
    )


def overall_moments(strata: DataFrame) -> DataFrame:
    """Merge per-stratum moments into the moments of all rows.

    Variances are combined from the group sizes, means and deviations, so the
    table is not read a second time.
    """
    total = F.sum("count")
    center = F.try_divide(F.sum(F.col("count") * F.col("mean")), total)
    means = strata.groupBy("feature").agg(total.alias("count"), center.alias("mean"),
                                          F.min("min").alias("min"), F.max("max").alias("max"))
    within = (F.col("s.count") - 1) * F.coalesce(F.pow(F.col("s.std"), 2), F.lit(0.0))
    between = F.col("s.count") * F.pow(F.col("s.mean") - F.col("m.mean"), 2)
    spread = (
        strata.alias("s")
        .join(means.alias("m"), F.col("s.feature") == F.col("m.feature"))
        .filter(F.col("s.count") > 0)
        .groupBy(F.col("s.feature").alias("feature"))
        .agg(F.sum(within + between).alias("__ss"))
    )
    return means.join(spread, "feature", "left").select(
        "feature",
        "count",
        "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("__ss") / (F.col("count") - 1))).alias("std"),
        "min",
        "max",
    )


def describe_levels(
    df: DataFrame,
    features: Sequence[str],
    by: str = "sub_Analysis",
    quartiles: bool = True,
) -> DataFrame:
    """Statistics of every stratum plus one level ``'all'`` over all rows.

    Rows with a NULL stratum count only towards ``'all'``. A real stratum called
    ``'all'`` would be ambiguous and is refused.
    """
    level = col(by).cast("string")
    reserved = F.raise_error(F.lit(f"column {by} contains the reserved level {ALL}"))
    level = F.when(level == ALL, reserved).otherwise(level)
    tagged = df.select(level.alias("level"), *[col(f) for f in features])
    empty = [F.lit(None).cast("double").alias(p) for p in ("p25", "p50", "p75")]
    columns = ["level", "feature", *STAT_COLUMNS]
    rows = df.count() if quartiles else 0
    if quartiles and rows * len(features) <= BUILTIN_GROUP_ROWS and len(features) <= WIDE_FEATURE_LIMIT:
        strata = describe(tagged, features, ["level"], rows)
        overall = describe(tagged, features, (), rows).withColumn("level", F.lit(ALL))
        table = strata.filter(F.col("level").isNotNull()).select(columns).unionByName(overall.select(columns))
        return table.withColumnRenamed("level", by)
    strata = compact(materialize(moments(tagged, features, ["level"]), "moments"))
    overall = overall_moments(strata).select(F.lit(ALL).alias("level"), "*")
    table = strata.filter(F.col("level").isNotNull()).unionByName(overall)
    if quartiles:
        long = to_long(tagged, ["level"], features)
        if rows > BUILTIN_GROUP_ROWS:

            def own_and_all(key: Column) -> Column:
                whole = F.struct(F.lit(ALL).alias("level"), key["feature"].alias("feature"))
                return F.array_compact(F.array(F.when(key["level"].isNotNull(), key), whole))

            quantiles = rank_select(long, ["level", "feature"], "value", QUARTILES, groups_of=own_and_all)
        else:
            levels = F.explode(F.array_compact(F.array("level", F.lit(ALL)))).alias("level")
            quantiles = grouped_quantiles(long.select(levels, "feature", "value"), ["level", "feature"], "value", QUARTILES, rows)
        table = table.join(quantiles, ["level", "feature"], "left").withColumns(
            {"p25": F.col("q")[0], "p50": F.col("q")[1], "p75": F.col("q")[2]}
        )
    else:
        table = table.select("*", *empty)
    table = table.select(columns)
    return table.withColumnRenamed("level", by)


def stats_to_wide(stats: DataFrame, features: Sequence[str], by: str = "sub_Analysis") -> DataFrame:
    """Long statistics to the layout with one row per level and statistic."""
    entries = F.array(
        *[
            F.struct(F.lit(label).alias("statistics"), col(name).cast("double").alias("value"))
            for label, name in WIDE_LABELS.items()
        ]
    )
    long = stats.select(col(by), "feature", F.inline(entries))
    return long.groupBy("statistics", by).pivot("feature", list(features)).agg(F.first("value"))


def stats_to_long(wide: DataFrame, by: str = "sub_Analysis", statistics: str = "statistics") -> DataFrame:
    """Inverse of :func:`stats_to_wide`."""
    features = [c for c in wide.columns if c not in (by, statistics)]
    long = wide.select(by, statistics, *[col(f).cast("double").alias(f) for f in features]).unpivot(
        [by, statistics], features, "feature", "value"
    )
    labels = list(WIDE_LABELS)
    pivoted = long.groupBy(by, "feature").pivot(statistics, labels).agg(F.first("value"))
    renamed = [
        (col(label).cast("long") if name == "count" else col(label)).alias(name)
        for label, name in WIDE_LABELS.items()
    ]
    return pivoted.select(by, "feature", *renamed)


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the first row of each key.

    Rows are sorted by key and order where they are read and only the first of each key there is shuffled: a key that
    holds a third of all rows shrinks to one row per input partition. What arrives is sorted
    once more, so a join by the same keys needs neither a shuffle nor a sort. Spark aggregates whole rows
    several times slower than it compares neighbours; an aggregate is left for keys with floating numbers, of which
    it makes 0.0 and -0.0 one value, for streams and for tables without any order.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [*order_by, *[c for c in rest if c not in order_by]]
    orderable = [o for o in order if _orderable(df, o)]
    kinds = [df.schema[k].dataType.simpleString() for k in keys]
    if keys and orderable and not df.isStreaming and not any(t in k for k in kinds for t in ("float", "double", "variant")):
        place = F.row_number().over(Window.partitionBy(*[col(k) for k in keys]).orderBy(*[col(o) for o in orderable]))
        return df.withColumn("__place", place).filter("__place = 1").select(*[col(c) for c in df.columns])
    if rest and sorted(orderable) == sorted(rest):
        # The order holds every column: it is the row, which then is sorted, shuffled and compared once instead of twice.
        first = F.min(struct_of(orderable))
    else:
        first = F.min_by(struct_of(rest), struct_of(orderable))
    winner = df.groupBy(*[col(k) for k in keys]).agg(first.alias("__first"))
    return winner.select(*[col(k) for k in keys], "__first.*").select(*[col(c) for c in df.columns])


def _orderable(df: DataFrame, name: str) -> bool:
    return "map<" not in df.schema[name].dataType.simpleString()


#: Hash buckets of keys: together they say whether any key may be hot, for a shuffle of some numbers per task.
_KEY_BUCKETS = 1 << 16


def duplicates(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The rows :func:`dedupe_first` leaves out, every copy of them.

    Rows are counted in hash buckets of their key first. Those of buckets within the hot bound meet
    by key in one shuffle. Only in the others, a key may be too hot for one task.
    """
    spark, keys = df.sparkSession, list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [*order_by, *[c for c in rest if c not in order_by]]
    # 0.0 and -0.0 are one key.
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")}
    hashed = F.xxhash64(*[col(k) + F.lit(0.0) if k in floating else col(k) for k in keys])
    tagged = df.withColumn("__b", F.pmod(hashed, F.lit(_KEY_BUCKETS)))
    bound = int(spark.conf.get(HOT_CONF, str(DEFAULT_HOT_ROWS)))
    crowded = tagged.groupBy("__b").count().filter(F.col("count") > bound).select("__b", F.lit(True).alias("__crowded"))
    crowded = materialize(crowded, "crowded-keys")
    if crowded.measured == 0:
        return _later_rows(df, keys, order)
    marked = tagged.join(F.broadcast(crowded), "__b", "left")
    plain = marked.filter(F.col("__crowded").isNull()).select(*[col(c) for c in df.columns])
    hot = marked.filter(F.col("__crowded")).select(*[col(c) for c in df.columns])
    return _later_rows(plain, keys, order).unionByName(_later_rows_of_hot_keys(hot, keys, order))


def _later_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All rows but the first of each key, from one sorted shuffle."""
    place = F.row_number().over(Window.partitionBy(*[col(k) for k in keys]).orderBy(*[col(o) for o in order]))
    return df.withColumn("__place", place).filter(F.col("__place") > 1).drop("__place")


def _later_rows_of_hot_keys(df: DataFrame, keys: list[str], order: Sequence[str]) -> DataFrame:
    """All rows but the first of each key, whatever the number of its rows.

    Keys are counted first, and only rows of repeated keys go on. Identical rows are
    then folded into one row with a count, which shrinks a hot group of copies before any
    shuffle by key.
    """
    tagged = df.withColumn("__k", struct_of(keys))
    several = tagged.groupBy("__k").count().filter(F.col("count") > 1).select("__k")
    df = attach(tagged, several, ["__k"], "inner", "repeated-keys").drop("__k")
    folded = df.groupBy(*[col(c) for c in df.columns]).agg(F.count("*").alias("__n"))
    ordered = folded.withColumn("__o", struct_of(order))
    # Keys as one struct: it is never NULL itself, and NULL fields of equal keys are equal.
    ordered = ordered.withColumn("__k", struct_of(keys))
    first = ordered.groupBy("__k").agg(F.min("__o").alias("__first"), F.sum("__n").alias("__rows"))
    repeated = first.filter(F.col("__rows") > 1).select("__k", "__first")
    joined = attach(ordered, repeated, ["__k"], "inner", "first-rows")
    copies = joined.withColumn(
        "__n", F.col("__n") - F.when(F.col("__o") == F.col("__first"), 1).otherwise(0)
    ).filter(F.col("__n") > 0)
    return _repeat_rows(copies, "__n").select(*[col(c) for c in df.columns])


_COPIES_PER_CHUNK = 100_000


def _repeat_rows(df: DataFrame, count: str) -> DataFrame:
    """Emit each row ``count`` times; only counts beyond a chunk are cut up and dealt over tasks."""

    def emitted(rows: DataFrame, size: Column) -> DataFrame:
        return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), size.cast("long"))))

    few = emitted(df.filter(F.col(count) <= _COPIES_PER_CHUNK), F.col(count))
    last = F.col(count) - 1
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / _COPIES_PER_CHUNK)))
    chunked = df.filter(F.col(count) > _COPIES_PER_CHUNK).withColumn("__chunk", chunks).repartition("__o", "__chunk")
    many = emitted(chunked, F.least(F.col(count) - F.col("__chunk") * _COPIES_PER_CHUNK, F.lit(_COPIES_PER_CHUNK)))
    return few.unionByName(many.drop("__chunk"))
