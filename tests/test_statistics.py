import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxelark.functions.sizing import HOT_CONF, materialize
from voxelark.functions import sizing
from voxelark.functions.columns import feature_columns, to_long, to_wide
from voxelark.operators import quantiles, stats
from voxelark.operators.quantiles import grouped_quantiles, rank_select


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def features(spark):
    rows = [
        ("p1", "a", 1.0, 5.0, "x", 7.0),
        ("p2", "a", 2.0, 5.0, "x", None),
        ("p3", "a", float("nan"), 5.0, "x", 1.0),
        ("p4", "b", 4.0, 5.0, "x", -3.5),
        ("p5", None, 8.0, 5.0, "x", 0.0),
    ]
    return table(
        spark,
        rows,
        "patientID string, sub_Analysis string, f double, constant double, diagnostics_x string, x_diagnostics double",
    )


def test_feature_columns_match_prefix_only(features):
    assert feature_columns(features) == ["f", "constant", "x_diagnostics"]


def test_describe_levels_matches_pandas(features):
    got = {(r["sub_Analysis"], r["feature"]): r for r in stats.describe_levels(features, ["f", "x_diagnostics"]).collect()}
    frame = features.toPandas()
    for level, part in [("a", frame[frame.sub_Analysis == "a"]), ("all", frame)]:
        for name in ("f", "x_diagnostics"):
            want = part[name].describe()
            row = got[(level, name)]
            assert row["count"] == want["count"]
            for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
                assert row[ours] == pytest.approx(want[theirs], abs=1e-12)
    assert got[("b", "f")]["std"] is None
    assert (None, "f") not in got


def test_merged_moments_equal_direct_ones(features):
    direct = stats.describe(features, ["f", "x_diagnostics"]).toPandas().set_index("feature")
    merged = stats.describe_levels(features, ["f", "x_diagnostics"], quartiles=False)
    merged = merged.filter("sub_Analysis = 'all'").toPandas().set_index("feature")
    for name in direct.index:
        for s in ("count", "mean", "std", "min", "max"):
            assert merged.loc[name, s] == pytest.approx(direct.loc[name, s], abs=1e-12)


def test_reserved_level_is_refused(spark):
    df = table(spark, [("p", "all", 1.0)], "patientID string, sub_Analysis string, f double")
    with pytest.raises(Exception, match="reserved level"):
        stats.describe_levels(df, ["f"]).collect()


def test_wide_and_long_moments_agree(spark, features, monkeypatch):
    narrow = stats.moments(features, ["f", "constant"], ["sub_Analysis"]).orderBy("sub_Analysis", "feature").collect()
    monkeypatch.setattr(stats, "WIDE_FEATURE_LIMIT", 1)
    long = stats.moments(features, ["f", "constant"], ["sub_Analysis"]).orderBy("sub_Analysis", "feature").collect()
    assert narrow == long


def test_wide_layout_round_trip(features):
    table_ = stats.describe_levels(features, ["f", "constant"])
    wide = stats.stats_to_wide(table_, ["f", "constant"])
    assert wide.columns == ["statistics", "sub_Analysis", "f", "constant"]
    back = stats.stats_to_long(wide)
    order = ["sub_Analysis", "feature"]
    assert back.orderBy(order).collect() == table_.select(back.columns).orderBy(order).collect()


def test_to_long_and_back(features):
    long = to_long(features, ["patientID"], ["f", "constant"])
    wide = to_wide(long, ["patientID"], ["f", "constant"]).orderBy("patientID").collect()
    assert [r["f"] for r in wide] == [1.0, 2.0, None, 4.0, 8.0]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.floats(-1e6, 1e6, allow_nan=False) | st.sampled_from([0.0, -1.0, 1.0, 1000.0001, 1000.0002]),
        min_size=1,
        max_size=60,
    )
)
def test_rank_selection_is_exact(spark, values):
    probs = [0.0, 0.02, 0.25, 0.5, 0.9, 1.0]
    df = table(spark, [("g", v) for v in values] + [("h", 3.0)], "g string, v double")
    got = {r["g"]: r["q"] for r in rank_select(df, ["g"], "v", probs).collect()}
    assert got["g"] == pytest.approx(list(np.quantile(values, probs)), rel=1e-12, abs=1e-9)
    assert got["h"] == [3.0] * len(probs)


def test_large_groups_leave_the_builtin_aggregate(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.sqrt("id").alias("v"))
    small = grouped_quantiles(df, ["g"], "v", [0.1, 0.5]).orderBy("g").collect()
    monkeypatch.setattr(quantiles, "BUILTIN_GROUP_ROWS", 10)
    large = grouped_quantiles(df, ["g"], "v", [0.1, 0.5]).orderBy("g").collect()
    for a, b in zip(small, large):
        assert a["q"] == pytest.approx(b["q"], rel=1e-12)


def test_bucket_keeps_the_order_of_values(spark):
    values = sorted([0.0, 1e-300, -1e-300, 5e-324, 1.0, 2.0, 4.0, 2.0**53, 2.0**53 - 1, 1e308, -1e308, 0.1, 0.3, -0.3])
    df = table(spark, [(v,) for v in values], "v double")
    got = [r["b"] for r in df.select("v", quantiles._bucket(F.col("v")).alias("b")).orderBy("v").collect()]
    assert got == sorted(got)


def test_dedupe_and_duplicates_partition_the_rows(spark):
    rows = [("k", 2, "b"), ("k", 1, "a"), ("k", 1, "a"), ("j", 5, "z"), ("k", 1, "a"), ("m", 1, None), ("m", None, "q")]
    df = table(spark, rows, "key string, o int, v string")
    first = stats.dedupe_first(df, ["key"], ["o"])
    rest = stats.duplicates(df, ["key"], ["o"])
    assert sorted(map(str, (first.collect() + rest.collect()))) == sorted(map(str, df.collect()))
    kept = {r["key"]: (r["o"], r["v"]) for r in first.collect()}
    assert kept == {"k": (1, "a"), "j": (5, "z"), "m": (None, "q")}


def test_many_copies_are_all_reported(spark, monkeypatch):
    monkeypatch.setattr(stats, "_COPIES_PER_CHUNK", 7)
    df = spark.range(100).select(F.lit("k").alias("key"), F.lit(1).alias("o"))
    assert stats.duplicates(df, ["key"], ["o"]).count() == 99


@pytest.mark.parametrize("hot", [100, 10_000])
def test_skew_join_equals_plain_join(spark, hot):
    key = F.when(F.col("id") % 10 < 6, 0).when(F.col("id") % 10 == 9, None).otherwise(F.col("id") % 10)
    rows = spark.range(1000).select(key.cast("long").alias("k"), "id")
    small = table(spark, [(0, "zero"), (7, "seven")], "k long, name string")
    settings_ = {sizing.BROADCAST_CONF: "0", sizing.HOT_CONF: str(hot), "spark.sql.autoBroadcastJoinThreshold": "-1"}
    try:
        for name, value in settings_.items():
            spark.conf.set(name, value)
        for how in ("left", "inner"):
            got = sizing.attach(rows, small, ["k"], how).select("k", "id", "name")
            plan = got._jdf.queryExecution().toString()
            assert ("__salt" in plan) == (hot == 100)
            want = rows.join(small, "k", how).select("k", "id", "name")
            assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    finally:
        for name in settings_:
            spark.conf.unset(name)


def test_describe_levels_beyond_the_builtin_bound(spark, features, monkeypatch):
    small = stats.describe_levels(features, ["f", "x_diagnostics"]).orderBy("sub_Analysis", "feature").collect()
    monkeypatch.setattr(stats, "BUILTIN_GROUP_ROWS", 1)
    monkeypatch.setattr(quantiles, "BUILTIN_GROUP_ROWS", 1)
    large = stats.describe_levels(features, ["f", "x_diagnostics"]).orderBy("sub_Analysis", "feature").collect()
    for a, b in zip(small, large, strict=True):
        assert a[:3] == b[:3]
        assert list(a[3:]) == [pytest.approx(v) if v is not None else None for v in b[3:]]


def test_shared_folder_follows_the_session(spark):
    table_ = sizing.materialize(spark.range(3), "probe")
    assert spark.conf.get("spark.checkpoint.dir") in table_.inputFiles()[0]
    assert table_.measured > 0 and table_.count() == 3


def test_infinite_values_keep_describe_going(spark):
    df = table(spark, [(1.0,), (math.inf,)], "f double")
    assert stats.describe(df, ["f"]).first()["max"] == math.inf


def test_duplicates_with_null_keys(spark):
    rows = [(None, 1), (None, 2), (None, 2), (1, 5), (1, 4)]
    df = spark.createDataFrame(rows, "k int, v int")
    got = sorted((r.k or 0, r.v) for r in stats.duplicates(df, ["k"], ["v"]).collect())
    assert got == [(0, 2), (0, 2), (1, 5)]


def test_nested_values_are_measured(spark):
    df = spark.range(100).selectExpr("struct(id, repeat('x', 10000) AS t) AS s", "array(repeat('y', 1000)) AS a")
    assert 1_100_000 <= materialize(df, "nested").measured <= 2_200_000


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 3.0, 5.0],
    [float("inf"), float("-inf"), 1.0, 2.0, 3.0],
    [float("inf"), float("inf"), float("inf"), 1.0],
    [-0.0, 0.0, -1e-300, 1e-300],
    [5e-324, 1e-323, 1.5e-323, 2e-323],
    [None, None],
    [1.0 + k * 2.0**-50 for k in range(40)] + [2.0],
])
def test_large_and_small_groups_agree(spark, monkeypatch, values):
    """Both paths give the same rows, the NULL stratum and groups without values included."""
    rows = [(level, v) for level in ("a", None) for v in values]
    frame = table(spark, rows, "sub_Analysis string, f double")

    def answers():
        described = stats.describe(frame, ["f"], ["sub_Analysis"]).select("sub_Analysis", "p25", "p50", "p75").collect()
        quarters = grouped_quantiles(frame, ["sub_Analysis"], "f", [0.25, 0.5, 0.9]).collect()
        order = lambda found: sorted(map(repr, map(tuple, found)))
        return order(described), order(quarters)

    small = answers()
    monkeypatch.setattr(stats, "BUILTIN_GROUP_ROWS", 0)
    monkeypatch.setattr(quantiles, "BUILTIN_GROUP_ROWS", 0)
    large = answers()
    assert small == large or [[r.replace("-0.0", "0.0") for r in part] for part in small] == [
        [r.replace("-0.0", "0.0") for r in part] for part in large
    ]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.sampled_from([0.0, 5e-324, 1e-323, -5e-324, 1e308, -1e308, float("inf"), float("-inf"), 1e9, 1e9 + 1e-6, 1e9 + 2e-6, 1e9 + 3e-6])
        | st.floats(1e6, 1e6 + 1e-3),
        min_size=1,
        max_size=80,
    )
)
def test_crowded_ranges_are_cut_again_and_again(spark, values):
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    df = table(spark, [("g", v) for v in values], "g string, v double")
    got = rank_select(df, ["g"], "v", probs, fit_values=2).first()["q"]
    ordered = sorted(values)
    for p, q in zip(probs, got):
        at = (len(values) - 1) * p
        lo, hi, share = ordered[math.floor(at)], ordered[math.ceil(at)], at - math.floor(at)
        want = lo if lo == hi or share == 0 else lo * (1 - share) + hi * share
        assert (math.isnan(q) and math.isnan(want)) or q == pytest.approx(want, rel=1e-12, abs=1e-300)


def test_sketches_merge_over_pools_and_strata(spark):
    df = spark.range(40_000).select(
        (F.col("id") % 3).alias("g"), (F.col("id") % 2).alias("pool"), F.pow(F.rand(3), 3).alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise((F.col("id") % 500).cast("double")).alias("w"),
    )
    parts = [quantiles.quantile_sketches(df.filter(F.col("pool") == k), ["v", "w"], ["g"]) for k in (0, 1)]
    for by in (["g"], []):
        read = quantiles.sketch_statistics(quantiles.merge_sketches(parts[0].unionByName(parts[1]), by), [0.1, 0.5, 0.9])
        frame = df.toPandas()
        for r in read.collect():
            own = frame[frame.g == r["g"]] if by else frame
            values = own[r["feature"]].dropna()
            assert r["count"] == len(values)
            if not len(values):
                assert r["q"] is None and r["mean"] is None
                continue
            assert r["mean"] == pytest.approx(values.mean()) and r["std"] == pytest.approx(values.std())
            assert r["distinct"] == pytest.approx(values.nunique(), rel=0.1)
            for p, q in zip((0.1, 0.5, 0.9), r["q"]):
                assert (values < q).mean() - 0.01 <= p <= (values <= q).mean() + 0.01
    approx = stats.describe(df, ["v", "w"], ["g"], approx=True)
    exact = stats.describe(df, ["v", "w"], ["g"])
    assert approx.columns == exact.columns and approx.count() == exact.count()


def test_duplicates_of_ordinary_keys_meet_in_one_shuffle(spark):
    """Keys within the hot bound need one shuffle of the rows; beyond it the same rows come from the other way."""
    rows = [(k, v, None if v % 3 == 0 else float(v)) for k in (None, 0.0, -0.0, 1.5, 2.5) for v in (3, 1, 1, 2)] + [(9.0, 1, None)]
    df = spark.createDataFrame(rows, "k double, v int, w double")
    later = stats.duplicates(df, ["k"], ["v"])
    assert later._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1
    got = Counter((r.k and r.k + 0.0, r.v, r.w) for r in later.collect())
    want = Counter()
    for key in {r[0] and r[0] + 0.0 for r in rows}:
        own = sorted([r for r in rows if r[0] is not None and r[0] == key] if key is not None else [r for r in rows if r[0] is None],
                     key=lambda r: (r[1], r[2] is not None, r[2] or 0.0))
        want.update((key, r[1], r[2]) for r in own[1:])
    assert got == want
    spark.conf.set(HOT_CONF, "5")
    try:
        assert Counter((r.k and r.k + 0.0, r.v, r.w) for r in stats.duplicates(df, ["k"], ["v"]).collect()) == want
    finally:
        spark.conf.unset(HOT_CONF)


def test_levels_share_one_histogram(spark, monkeypatch):
    """Quartiles of strata and of all rows by rank, rows read once for both: NULL strata and missing values included."""
    rng = np.random.default_rng(8)
    rows = [(["a", "b", None][i % 3], float(v) if i % 7 else None, float(rng.integers(0, 5))) for i, v in enumerate(rng.normal(0, 10, 600))]
    rows += [("empty", None, float("nan")), ("one", 2.5, 1.0)]
    df = spark.createDataFrame(rows, "g string, u double, v double")
    seen = []
    chosen = stats.rank_select
    monkeypatch.setattr(stats, "BUILTIN_GROUP_ROWS", 10)
    monkeypatch.setattr(stats, "rank_select", lambda long, *a, **b: seen.append(long.count()) or chosen(long, *a, fit_values=20, **b))
    got = {(r.g, r.feature): r for r in stats.describe_levels(df, ["u", "v"], "g").collect()}
    # Two features of every row; the level of all rows needs no rows of its own.
    assert seen == [2 * len(rows)]
    assert set(got) == {(g, f) for g in ("a", "b", "empty", "one", "all") for f in ("u", "v")}
    for (g, f), r in got.items():
        values = [x for row in rows if g in ("all", row[0]) for x in [row[1 if f == "u" else 2]] if x is not None and not math.isnan(x)]
        if not values:
            assert (r["count"], r.p25, r.p50, r.p75) == (0, None, None, None)
        else:
            assert np.allclose([r.p25, r.p50, r.p75], np.percentile(values, [25, 50, 75]), rtol=1e-12)


def test_first_rows_travel_once(spark):
    rows = [(k % 5 if k % 7 else None, [None, "b", "a"][k % 3], float(k * 13 % 11)) for k in range(60)] * 2
    df = spark.createDataFrame(rows, "key int, t string, v double")
    out = stats.dedupe_first(df, ["key"], ["v"])
    want = {}
    for k, t, v in rows:
        order = (v, t is not None, t or "")
        want[k] = min(want.get(k, (order, t)), (order, t), key=lambda pair: pair[0])
    assert {r["key"]: (r["t"], r["v"]) for r in out.collect()} == {k: (t, order[0]) for k, (order, t) in want.items()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "min_by" not in plan and out.columns == df.columns
    # A column without an order is no part of it.
    mapped = df.withColumn("m", F.create_map("t", "v")).filter("t is not null")
    assert stats.dedupe_first(mapped, ["key"], ["v"]).count() == 6
    assert stats.dedupe_first(df, ["key"], ["key"]).count() == stats.dedupe_first(df.select("key"), ["key"], ["key"]).count() == 6


def test_first_rows_are_compared_without_aggregates(spark):
    """Neighbours of a sorted partition, before the shuffle and after it; a join by the same keys adds nothing."""
    rows = [(k % 7 if k % 5 else None, k % 3, [None, "b", "a"][k % 4 % 3], float(k * 13 % 11)) for k in range(200)] * 2
    df = spark.createDataFrame(rows, "key long, part int, t string, v double").repartition(3)
    out = stats.dedupe_first(df, ["key", "part"], ["t"])
    want = {}
    for key, part, t, v in rows:
        order = (t is not None, t or "", v)
        want[key, part] = min(want.get((key, part), order), order)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit") < plan.index("hashpartitioning") < plan.rindex("WindowGroupLimit")
    got = out.collect()
    assert out.columns == df.columns and len(got) == len(want)
    assert all(want[r["key"], r["part"]] == (r["t"] is not None, r["t"] or "", r["v"]) for r in got)
    joined = out.select("*").join(stats.dedupe_first(df.select("key", "part", "v"), ["key", "part"], ["v"]).hint("merge"), ["key", "part"], "left")
    assert joined._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 2
    # Of floating keys, 0.0 and -0.0 are one, and come back as 0.0.
    floating = spark.createDataFrame([(-0.0, 2), (0.0, 3), (None, 1)], "key double, v int")
    assert sorted((str(r["key"]), r["v"]) for r in stats.dedupe_first(floating, ["key"], ["v"]).collect()) == [("0.0", 2), ("None", 1)]
