import numpy as np
import pandas as pd
import pytest

from voxelark.operators import combat as combat_module
from voxelark.operators.combat import (
    CombatCells,
    CombatModel,
    combat,
    combat_external,
    fit_combat,
    harmonize_towards,
    training_cells,
)
from voxelark.plans.catalog import harmonize

NAMES = [f"f{i}" for i in range(6)]


def sample_frame(seed=0, n=60):
    rng = np.random.default_rng(seed)
    batch = rng.choice(["a", "b", "c"], n, p=[0.5, 0.3, 0.2])
    sex = rng.choice(["f", "m", "x"], n)
    age = rng.normal(50, 10, n).astype("float32").astype(float)
    frame = pd.DataFrame({"patientID": [f"p{i}" for i in range(n)], "sub_Analysis": "s", "batch": batch, "sex": sex, "age": age})
    for i, f in enumerate(NAMES):
        shift = np.select([batch == "a", batch == "b"], [0.0, 2.0 + i], -1.5)
        scale = np.select([batch == "a", batch == "b"], [1.0, 2.0], 0.6)
        frame[f] = 10 * i + shift + scale * rng.normal(size=n) + 0.8 * (sex == "m") - 0.05 * age * (i % 2)
    return frame


def dense_combat(frame, covars=(), continuous=(), ref=None, eb=True, parametric=True, mean_only=False):
    """Matrix form of the published method, written independently of the engine."""
    y = frame[NAMES].to_numpy().T
    levels = sorted(frame.batch.unique())
    onehot = np.column_stack([(frame.batch == b).to_numpy(float) for b in levels])
    extra = [np.column_stack([(frame[c] == v).to_numpy(float) for v in sorted(frame[c].unique())[1:]]) for c in covars]
    extra += [frame[[c]].to_numpy(float) for c in continuous]
    design_batch = onehot.copy()
    r = levels.index(ref) if ref else None
    if ref:
        design_batch[:, r] = 1.0
    x = np.hstack([design_batch, *extra])
    beta = np.linalg.lstsq(x, y.T, rcond=None)[0]
    counts = onehot.sum(axis=0)
    grand = beta[r] if ref else counts / counts.sum() @ beta[: len(levels)]
    resid = y - (x @ beta).T
    var = (resid[:, onehot[:, r] == 1] ** 2).mean(axis=1) if ref else (resid**2).mean(axis=1)
    mod = (x[:, len(levels):] @ beta[len(levels):]).T
    center = grand[:, None] + mod
    s = (y - center) / np.sqrt(var)[:, None]
    gamma = np.linalg.lstsq(design_batch, s.T, rcond=None)[0]
    out = np.empty_like(y)
    for k, b in enumerate(levels):
        here = onehot[:, k] == 1
        sb, n = s[:, here], here.sum()
        g_hat = gamma[k]
        d_hat = np.ones(len(NAMES)) if mean_only else sb.var(axis=1, ddof=1)
        g, d = g_hat, d_hat
        if ref == b:
            out[:, here] = y[:, here]
            continue
        g_bar, t2 = g_hat.mean(), g_hat.var(ddof=1)
        if eb and parametric and mean_only:
            g, d = (t2 * g_hat + g_bar) / (t2 + 1), np.ones(len(NAMES))
        elif eb and parametric:
            m, s2 = d_hat.mean(), d_hat.var(ddof=1)
            a, bb = (2 * s2 + m**2) / s2, (m * s2 + m**3) / s2
            while True:
                gn = (t2 * n * g_hat + d * g_bar) / (t2 * n + d)
                dn = (0.5 * ((sb - gn[:, None]) ** 2).sum(axis=1) + bb) / (n / 2 + a - 1)
                change = max((abs(gn - g) / g).max(), (abs(dn - d) / d).max())
                g, d = gn, dn
                if not change > 1e-4:
                    break
        elif eb:
            gs, ds = [], []
            for i in range(len(NAMES)):
                og, od = np.delete(g_hat, i), np.delete(d_hat, i)
                ss = ((sb[i][None, :] - og[:, None]) ** 2).sum(axis=1)
                w = (2 * np.pi * od) ** (-n / 2) * np.exp(-ss / (2 * od))
                gs.append((og * w).sum() / w.sum())
                ds.append((od * w).sum() / w.sum())
            g, d = np.array(gs), np.array(ds)
        out[:, here] = (sb - g[:, None]) / np.sqrt(d)[:, None] * np.sqrt(var)[:, None] + center[:, here]
    return out.T


CASES = [
    {},
    {"eb": False},
    {"mean_only": True},
    {"parametric": False},
    {"ref": "b"},
    {"covars": ["sex"]},
    {"covars": ["sex"], "continuous": ["age"]},
    {"covars": ["sex"], "continuous": ["age"], "ref": "a"},
    {"continuous": ["age"], "mean_only": True, "ref": "c"},
]


@pytest.mark.parametrize("case", CASES, ids=[str(c) for c in CASES])
def test_agrees_with_the_matrix_form(spark, case):
    frame = sample_frame()
    options = {**case}
    ref = options.pop("ref", None)
    model = fit_combat(spark.createDataFrame(frame), NAMES, ref_batch=ref, **options)
    got = model.transform(spark.createDataFrame(frame)).toPandas().set_index("patientID").loc[frame.patientID]
    np.testing.assert_allclose(got[NAMES].to_numpy(), dense_combat(frame, **case), rtol=1e-8, atol=1e-8)


def test_many_features_take_the_long_path(spark, monkeypatch):
    from voxelark.operators import combat as module

    frame = sample_frame(3)
    monkeypatch.setattr(module, "WIDE_FEATURE_LIMIT", 2)
    got = fit_combat(spark.createDataFrame(frame), NAMES, covars=["sex"], continuous=["age"])
    got = got.transform(spark.createDataFrame(frame)).toPandas()
    np.testing.assert_allclose(got[NAMES].to_numpy(), dense_combat(frame, ["sex"], ["age"]), rtol=1e-8)


def test_incomplete_features_are_named_or_passed_through(spark):
    frame = sample_frame(1)
    frame.loc[4, "f2"] = np.inf
    df = spark.createDataFrame(frame)
    with pytest.raises(ValueError, match="f2"):
        fit_combat(df, NAMES)
    out = fit_combat(df, NAMES, drop_incomplete=True).transform(df).toPandas()
    assert (out.f2 == frame.f2).all() and not np.allclose(out.f1, frame.f1)


def test_refusals(spark):
    frame = sample_frame(2)
    df = spark.createDataFrame(frame)
    with pytest.raises(ValueError, match="not found"):
        fit_combat(df, NAMES, ref_batch="zzz")
    assert fit_combat(df, NAMES, ref_batch="zzz", on_missing_ref="ignore").design.ref_batch is None
    with pytest.raises(ValueError, match="two features"):
        fit_combat(df, NAMES[:1])
    with pytest.raises(ValueError, match="confounded"):
        frame["same"] = frame.batch
        fit_combat(spark.createDataFrame(frame), NAMES, covars=["same"])
    lonely = frame.copy()
    lonely.loc[0, "batch"] = "d"
    with pytest.raises(ValueError, match="one sample"):
        fit_combat(spark.createDataFrame(lonely), NAMES)
    with pytest.raises(Exception, match="not part of the training table"):
        fit_combat(df, NAMES).transform(spark.createDataFrame(lonely)).collect()
    with pytest.raises(Exception, match="not part of the training table"):
        odd = frame.copy()
        odd.loc[0, "sex"] = "new"
        fit_combat(df, NAMES, covars=["sex"]).transform(spark.createDataFrame(odd)).collect()


def test_constant_feature_stays_finite(spark):
    frame = sample_frame(5)
    frame["f0"] = 0.1
    df = spark.createDataFrame(frame)
    out = fit_combat(df, NAMES, eb=False).transform(df).toPandas()
    assert np.allclose(out.f0, 0.1)


def test_saved_estimates_give_the_same_result(spark, tmp_path):
    df = spark.createDataFrame(sample_frame())
    model = fit_combat(df, NAMES, covars=["sex"], continuous=["age"])
    model.save(str(tmp_path / "c"))
    again = CombatModel.load(spark, str(tmp_path / "c"))
    a, b = model.transform(df).toPandas(), again.transform(df).toPandas()
    pd.testing.assert_frame_equal(a, b)


def test_study_drops_duplicates_and_demands_batches(spark):
    frame = sample_frame()
    twice = pd.concat([frame, frame.iloc[:5].assign(f0=999.0)])
    features = spark.createDataFrame(twice[["patientID", "sub_Analysis", *NAMES]])
    batch = spark.createDataFrame(frame[["patientID", "sub_Analysis", "batch", "sex"]])
    got = combat(features, batch, covars=["sex"], order_by=NAMES).toPandas().set_index("patientID").loc[frame.patientID]
    np.testing.assert_allclose(got[NAMES].to_numpy(), dense_combat(frame, ["sex"]), rtol=1e-8)
    with pytest.raises(ValueError, match="missing values"):
        combat(features, batch.filter("patientID <> 'p3'"))
    with pytest.raises(ValueError, match="site"):
        combat(features, batch, covars=["site"])


@pytest.mark.parametrize("ref", ["a", None])
def test_continuous_covariates_come_from_the_batch_table(spark, ref):
    train, new = sample_frame(3), sample_frame(4, 40)
    new["patientID"] = "n" + new.patientID
    keys = ["patientID", "sub_Analysis"]

    def split(frame):
        return spark.createDataFrame(frame[[*keys, *NAMES]]), spark.createDataFrame(frame[[*keys, "batch", "age"]])

    inside = combat(*split(train), continuous=["age"], ref_batch=ref).toPandas().set_index("patientID").loc[train.patientID]
    want = dense_combat(train, continuous=["age"], ref=ref)
    np.testing.assert_allclose(inside[NAMES].to_numpy(), want, rtol=1e-7, atol=1e-8)
    moved = combat_external(*split(train), *split(new), ref_batch=ref, continuous=["age"])
    moved = moved.toPandas().set_index("patientID").loc[new.patientID]
    pooled = pd.concat([train.assign(batch=train.batch + "_ref" if ref else "ref"), new]).reset_index(drop=True)
    want = dense_combat(pooled, continuous=["age"], ref=f"{ref}_ref" if ref else "ref")[len(train):]
    np.testing.assert_allclose(moved[NAMES].to_numpy(), want, rtol=1e-7, atol=1e-8)
    with pytest.raises(ValueError, match="missing values"):
        features, batch = split(train)
        combat(features, batch.selectExpr(*keys, "batch", "if(patientID = 'p3', double('NaN'), age) age"), continuous=["age"])


@pytest.mark.parametrize("ref", ["a", None])
def test_external_mode_moves_only_new_rows(spark, ref):
    train, new = sample_frame(7), sample_frame(8, 40)
    new["patientID"] = "n" + new.patientID
    keys = ["patientID", "sub_Analysis"]

    def split(frame):
        return spark.createDataFrame(frame[[*keys, *NAMES]]), spark.createDataFrame(frame[[*keys, "batch"]])

    got = combat_external(*split(train), *split(new), ref_batch=ref).toPandas().set_index("patientID").loc[new.patientID]
    pooled = pd.concat([train.assign(batch=train.batch + "_ref" if ref else "ref"), new])
    want = dense_combat(pooled.reset_index(drop=True), ref=f"{ref}_ref" if ref else "ref")[len(train):]
    np.testing.assert_allclose(got[NAMES].to_numpy(), want, rtol=1e-7, atol=1e-8)
    with pytest.raises(ValueError, match="f5"):
        old, old_batch = split(train)
        combat_external(old.drop("f5"), old_batch, *split(new), ref_batch=ref)


KEYS = ["patientID", "sub_Analysis"]


def halves(spark, frame, columns):
    return spark.createDataFrame(frame[[*KEYS, *NAMES]]), spark.createDataFrame(frame[[*KEYS, *columns]])


@pytest.mark.parametrize("covars,continuous", [([], []), (["sex"], []), (["sex"], ["age"])])
def test_cells_merge_to_the_cells_of_all_samples(spark, covars, continuous):
    frame = sample_frame(11, 90)
    frame.loc[5, "f3"] = np.nan

    def cells(part):
        return CombatCells.of(spark.createDataFrame(part), NAMES, "batch", covars, continuous)

    merged = cells(frame[:30]).merge(cells(frame[30:31])).merge(cells(frame[31:]))
    by = ["__batch", *covars, "feature"]
    a, b = (c.table.toPandas().sort_values(by).reset_index(drop=True) for c in (merged, cells(frame)))
    gaps = b.feature == "f3"
    for part in (a, b):
        part.loc[gaps, [c for c in part.columns if c.startswith("cy")]] = 0.0
    pd.testing.assert_frame_equal(a[b.columns], b, rtol=1e-9, check_dtype=False)
    with pytest.raises(ValueError, match="do not merge"):
        merged.merge(CombatCells.of(spark.createDataFrame(frame), NAMES[:2], "batch", covars, continuous))


@pytest.mark.parametrize("ref", ["a", None])
def test_stored_cells_replace_the_training_rows(spark, tmp_path, ref):
    train, new = sample_frame(7), sample_frame(8, 40)
    new["patientID"] = "n" + new.patientID
    features, batch = halves(spark, train, ["batch", "sex"])
    features.write.parquet(str(tmp_path / "train"))
    cells = training_cells(spark.read.parquet(str(tmp_path / "train")), batch, covars=["sex"])
    cells.save(str(tmp_path / "cells"))
    kept = CombatCells.load(spark, str(tmp_path / "cells"))
    moved = harmonize_towards(kept, *halves(spark, new, ["batch", "sex"]), ref_batch=ref)
    assert not any("/train/" in f for f in moved.inputFiles())
    got = moved.toPandas().set_index("patientID").loc[new.patientID]
    pooled = pd.concat([train.assign(batch=train.batch + "_ref" if ref else "ref"), new]).reset_index(drop=True)
    want = dense_combat(pooled, ["sex"], ref=f"{ref}_ref" if ref else "ref")[len(train):]
    np.testing.assert_allclose(got[NAMES].to_numpy(), want, rtol=1e-7, atol=1e-8)
    with pytest.raises(ValueError, match="missing values"):
        harmonize_towards(kept, *halves(spark, new.assign(batch=new.batch.where(new.index != 3)), ["batch", "sex"]))


@pytest.mark.parametrize("tile", [1, 2, 4])
def test_non_parametric_tiles_merge_to_one_block(spark, monkeypatch, tile):
    from voxelark.operators import combat as module

    monkeypatch.setattr(module, "TILE_FEATURES", tile)
    frame = sample_frame(12)
    got = fit_combat(spark.createDataFrame(frame), NAMES, parametric=False).transform(spark.createDataFrame(frame)).toPandas()
    np.testing.assert_allclose(got[NAMES].to_numpy(), dense_combat(frame, parametric=False), rtol=1e-8, atol=1e-8)


def many_levels(seed, n, levels):
    """Samples of a covariate with many levels, each of which several batches hold."""
    rng = np.random.default_rng(seed)
    frame = sample_frame(seed, n)
    frame["site"] = [f"l{k:05d}" for k in rng.permutation(np.arange(n) % levels)]
    effect = rng.normal(0, 2, levels)
    for i, f in enumerate(NAMES):
        frame[f] += effect[frame.site.str[1:].astype(int)] * (1 + 0.1 * i)
    return frame


@pytest.mark.parametrize("case", [{"covars": ["site"]}, {"covars": ["sex", "site"], "continuous": ["age"]}, {"covars": ["site"], "ref": "b"}])
def test_covariates_of_many_levels_agree_with_the_matrix_form(spark, tmp_path, case):
    frame = many_levels(21, 400, 60)
    options = {**case}
    ref = options.pop("ref", None)
    model = fit_combat(spark.createDataFrame(frame), NAMES, ref_batch=ref, **options)
    assert model.design.absorbed == "site" and "site" not in model.design.levels
    got = model.transform(spark.createDataFrame(frame)).toPandas().set_index("patientID").loc[frame.patientID]
    np.testing.assert_allclose(got[NAMES].to_numpy(), dense_combat(frame, **case), rtol=1e-7, atol=1e-7)
    model.save(str(tmp_path / "m"))
    again = CombatModel.load(spark, str(tmp_path / "m")).transform(spark.createDataFrame(frame)).toPandas()
    np.testing.assert_allclose(again.set_index("patientID").loc[frame.patientID][NAMES].to_numpy(), got[NAMES].to_numpy())
    with pytest.raises(Exception, match="not part of the training table"):
        model.transform(spark.createDataFrame(frame.assign(site="new"))).collect()


def test_many_batches_and_small_covariates(spark):
    """The batch block is the largest: covariates beyond the plain expressions are solved in tasks."""
    frame = sample_frame(22, 200)
    model = fit_combat(spark.createDataFrame(frame), NAMES, covars=["sex"], continuous=["age"], dense_terms=1)
    got = model.transform(spark.createDataFrame(frame)).toPandas().set_index("patientID").loc[frame.patientID]
    np.testing.assert_allclose(got[NAMES].to_numpy(), dense_combat(frame, ["sex"], ["age"]), rtol=1e-7, atol=1e-7)


def test_five_thousand_levels(spark):
    """Against numpy's least squares by alternating, without a dense design."""
    n, levels = 20_000, 5_000
    rng = np.random.default_rng(23)
    batch, site = rng.integers(0, 3, n), rng.permutation(np.arange(n) % levels)
    values = {f: rng.normal(size=n) + batch * (1 + i) + 0.5 * np.sin(site) for i, f in enumerate(NAMES[:2])}
    frame = pd.DataFrame({"patientID": np.arange(n), "batch": batch.astype(str), "site": np.char.mod("%05d", site), **values})
    model = fit_combat(spark.createDataFrame(frame), NAMES[:2], covars=["site"], eb=False)
    got = {(r["feature"], r["level"]): r["effect"] for r in model.effects.collect()}
    assert len(got) == 2 * levels
    for f in NAMES[:2]:
        y, a, g = values[f], np.zeros(3), np.zeros(levels)
        for _ in range(300):
            a = np.bincount(batch, y - g[site]) / np.bincount(batch)
            g = np.bincount(site, y - a[batch]) / np.bincount(site)
        want = g - g[0]
        assert np.array([got[f, f"{k:05d}"] for k in range(levels)]) == pytest.approx(want, abs=1e-6)


def test_prepared_samples_are_shuffled_once(spark):
    """Harmonized samples come from the written join of samples and batches: nothing is shuffled again to transform."""
    rows = [(f"p{i}", i % 3, "ab"[i % 2], float(i * i % 17), float(i % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "patientID string, sub_Analysis int, batch string, u double, v double")
    keys = ["patientID", "sub_Analysis"]
    features, batch = df.drop("batch"), df.select(*keys, "batch")
    model, out = combat_module.combat_study(features, batch, keys, names=["u", "v"])
    towards = combat_module.harmonize_towards(model.cells, features, batch, keys, "a")
    for harmonized in (out, towards):
        plan = harmonized._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(patientID" not in plan and harmonized.count() == 40


def test_items_stay_where_they_are(spark, tmp_path):
    """Few suppliers go to the line items, whatever size Spark guesses; copies and unknown suppliers as in any inner join."""
    items = [(i, i, s, 1, 2.0, 3.0, 0.1, 0.2, "A", "F", "1997-01-01") for i, s in enumerate([0, 0, 1, 2, 7, None])]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string"
    spark.createDataFrame(items, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    suppliers = [(0, 1), (1, 1), (1, 2), (2, 9), (None, 1)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(1, "a"), (2, "b")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = harmonize._items(spark, str(tmp_path))
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = sorted((r["l_orderkey"], r["batch"]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert got == [(0, "a"), (1, "a"), (2, "a"), (2, "b")]
    assert "hashpartitioning" not in plan
