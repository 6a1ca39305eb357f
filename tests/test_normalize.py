import numpy as np
import pytest

from voxelark.operators import normalize as nz
from voxelark.operators.normalize import NormalizerModel, fit_normalizer, normalize, normalize_external

SCHEMA = "patientID string, sub_Analysis string, f double, flat double, diagnostics_x double"


@pytest.fixture(scope="module")
def df(spark):
    rows = [(f"p{i}", "ab"[i % 2], float(i * i - 7), 3.0, 1.0) for i in range(9)] + [("q", "c", 5.0, 3.0, 1.0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_method_spellings():
    assert {nz.method_name(m) for m in ("MinMax", "min max", "MIN MAX")} == {"minmax"}
    assert {nz.method_name(m) for m in ("Z-Score", "z score", "zscore", "ZScore")} == {"zscore"}
    assert {nz.method_name(m) for m in ("RobustScaling", "Robust scaling")} == {"robust"}
    with pytest.raises(ValueError):
        nz.method_name("quantile")


def test_minmax_stays_in_unit_interval_and_flat_is_null(df):
    rows = normalize(df, method="MinMax").collect()
    assert len(rows) == 10
    values = [r["f"] for r in rows if r["sub_Analysis"] != "c"]
    assert min(values) == 0 and max(values) == 1
    assert all(r["flat"] is None for r in rows)
    assert all(r["diagnostics_x"] == 1.0 for r in rows)
    assert [r["f"] for r in rows if r["sub_Analysis"] == "c"] == [None]


@pytest.mark.parametrize("stratified", [True, False])
def test_zscore_has_mean_zero_and_std_one(df, stratified):
    frame = normalize(df, ["f"], "zscore", stratified=stratified).toPandas()
    groups = [g for _, g in frame[frame.sub_Analysis != "c"].groupby("sub_Analysis")] if stratified else [frame]
    for g in groups:
        assert np.mean(g.f) == pytest.approx(0, abs=1e-12)
        assert np.std(g.f, ddof=1) == pytest.approx(1)


def test_unknown_stratum_uses_the_overall_statistics(spark, df):
    model = fit_normalizer(df.filter("sub_Analysis <> 'c'"), ["f"], "robust")
    new = spark.createDataFrame([("n", "zzz", 10.0, 0.0, 0.0), ("n", None, 10.0, 0.0, 0.0)], SCHEMA)
    values = df.filter("sub_Analysis <> 'c'").toPandas().f
    want = (10.0 - values.median()) / (values.quantile(0.75) - values.quantile(0.25))
    assert [r["f"] for r in model.transform(new).collect()] == pytest.approx([want, want])


def test_saved_model_gives_the_same_result(spark, df, tmp_path):
    model = fit_normalizer(df, ["f"], "minmax", all_statistics=True)
    model.save(str(tmp_path / "m"))
    again = NormalizerModel.load(spark, str(tmp_path / "m"))
    assert again.transform(df).collect() == model.transform(df).collect()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        model.save(str(tmp_path / "m"))


def test_missing_feature_or_statistics_is_an_error(df):
    stats = fit_normalizer(df, ["f"]).stats
    with pytest.raises(ValueError, match="flat"):
        normalize_external(df.drop("flat"), stats, ["f", "flat"])
    with pytest.raises(ValueError, match="all"):
        NormalizerModel(stats, ["f", "flat"]).transform(df)


def test_plan_has_no_python_and_no_row_shuffle(df):
    plan = normalize(df, ["f"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
