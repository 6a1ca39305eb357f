"""Texture features on small regions, against brute force."""

import itertools
import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from voxelark.operators import texture
from voxelark.operators.zones import zone_sizes
from voxelark.plans.extraction import FeatureConfig, extract_features, skipped_regions

K = ["patientID"]


def levels_frame(spark, array, patient="p"):
    """Region of the non-zero voxels with the given levels."""
    rows = [
        (patient, int(x), int(y), int(z), float(array[x, y, z]), int(array[x, y, z]))
        for x, y, z in np.ndindex(*array.shape)
        if array[x, y, z] > 0
    ]
    return spark.createDataFrame(rows, "patientID string, x int, y int, z int, value double, level int")


def cells(array):
    return {p: int(array[p]) for p in np.ndindex(*array.shape) if array[p] > 0}


def neighbours(p):
    for d in itertools.product((-1, 0, 1), repeat=3):
        if d != (0, 0, 0):
            yield tuple(a + b for a, b in zip(p, d))


@pytest.fixture(scope="module")
def array():
    a = np.random.default_rng(4).integers(0, 4, (4, 5, 3))
    a[1, 1, 1] = 0
    return a


# A flat 4 x 4 image worked out by hand.
HAND = np.array([[1, 1, 2, 2], [1, 1, 2, 2], [1, 3, 3, 3], [3, 3, 4, 4]]).T.reshape(4, 4, 1)


def test_directions_are_half_of_the_neighbours():
    assert len(texture.DIRECTIONS) == 13
    both = set(texture.DIRECTIONS) | {tuple(-v for v in d) for d in texture.DIRECTIONS}
    assert len(both) == 26


def test_hand_worked_pairs(spark):
    horizontal = texture.DIRECTIONS.index((1, 0, 0))
    rows = texture.cooccurrence(levels_frame(spark, HAND), K).filter(f"angle = {horizontal}").collect()
    got = {(r["i"], r["j"]): r["p"] * 24 for r in rows}
    want = {(1, 1): 4, (1, 2): 2, (2, 1): 2, (2, 2): 4, (1, 3): 1, (3, 1): 1, (3, 3): 6, (3, 4): 1, (4, 3): 1, (4, 4): 2}
    assert {k: pytest.approx(v) for k, v in got.items()} == want


def test_hand_worked_runs_and_zones(spark):
    frame = levels_frame(spark, HAND)
    horizontal = texture.DIRECTIONS.index((1, 0, 0))
    got = {(r["i"], r["j"]): r["n"] for r in texture.runs(frame, K).filter(f"angle = {horizontal}").collect()}
    assert got == {(1, 2): 2, (2, 2): 2, (1, 1): 1, (3, 3): 1, (3, 2): 1, (4, 2): 1}
    zones = sorted((r["level"], r["size"]) for r in zone_sizes(frame, K).collect())
    assert zones == [(1, 5), (2, 4), (3, 5), (4, 2)]


def brute_runs(array, d):
    data, counts = cells(array), {}
    for p, v in data.items():
        before = tuple(a - b for a, b in zip(p, d))
        if data.get(before) == v:
            continue
        length, q = 0, p
        while data.get(q) == v:
            length, q = length + 1, tuple(a + b for a, b in zip(q, d))
        counts[(v, length)] = counts.get((v, length), 0) + 1
    return counts


def test_runs_in_every_direction(spark, array):
    rows = texture.runs(levels_frame(spark, array), K).collect()
    for angle, d in enumerate(texture.DIRECTIONS):
        got = {(r["i"], r["j"]): r["n"] for r in rows if r["angle"] == angle}
        assert got == brute_runs(array, d)


def brute_zones(array):
    data, seen, sizes = cells(array), set(), []
    for p, v in data.items():
        if p in seen:
            continue
        stack, size = [p], 0
        seen.add(p)
        while stack:
            q = stack.pop()
            size += 1
            for r in neighbours(q):
                if data.get(r) == v and r not in seen:
                    seen.add(r)
                    stack.append(r)
        sizes.append((v, size))
    return sorted(sizes)


@pytest.mark.parametrize("seed,high", [(0, 3), (1, 2)])
def test_zones(spark, seed, high):
    array = np.random.default_rng(seed).integers(0, high + 1, (7, 6, 4))
    frame = levels_frame(spark, array).unionByName(levels_frame(spark, HAND, "q"))
    got = zone_sizes(frame, K).collect()
    assert sorted((r["level"], r["size"]) for r in got if r["patientID"] == "p") == brute_zones(array)
    assert sorted((r["level"], r["size"]) for r in got if r["patientID"] == "q") == brute_zones(HAND)


def test_a_winding_zone_is_one_zone(spark):
    snake = np.zeros((9, 9, 1), int)
    for row in range(0, 9, 2):
        snake[:, row, 0] = 1
        if row + 1 < 9:
            snake[8 if (row // 2) % 2 == 0 else 0, row + 1, 0] = 1
    assert [r["size"] for r in zone_sizes(levels_frame(spark, snake), K).collect()] == [int(snake.sum())]


@pytest.mark.parametrize("shape", [(1, 600, 1), (300, 300, 1)])
def test_wide_zones_settle(spark, shape):
    """A long line of touching runs and a whole slice of one level are one zone each."""
    axis = F.explode(F.sequence(F.lit(0), F.lit(shape[1] - 1)))
    frame = spark.range(shape[0]).select(F.lit("p").alias("patientID"), F.col("id").cast("int").alias("x"), axis.alias("y"))
    frame = frame.withColumns({"z": F.lit(0), "value": F.lit(1.0), "level": F.lit(1)})
    assert [r["size"] for r in zone_sizes(frame, K).collect()] == [shape[0] * shape[1]]


def test_neighbourhoods(spark, array):
    data = cells(array)
    for r in texture.surroundings(levels_frame(spark, array), K).collect():
        p = (r["x"], r["y"], r["z"])
        near = [data[q] for q in neighbours(p) if q in data]
        assert (r["level"], r["n"], r["total"], r["same"]) == (data[p], len(near), sum(near), near.count(data[p]))


def test_dependence_and_tone_features(spark, array):
    data = cells(array)
    dep = [(v, 1 + sum(data.get(q) == v for q in neighbours(p))) for p, v in data.items()]
    row = texture.gldm(levels_frame(spark, array), K).first()
    assert row["LargeDependenceEmphasis"] == pytest.approx(np.mean([j * j for _, j in dep]))
    assert row["HighGrayLevelEmphasis"] == pytest.approx(np.mean([i * i for i, _ in dep]))
    assert row["SmallDependenceLowGrayLevelEmphasis"] == pytest.approx(np.mean([1 / (i * i * j * j) for i, j in dep]))
    counts = np.unique([i for i, _ in dep], return_counts=True)[1]
    assert row["GrayLevelNonUniformity"] == pytest.approx((counts**2).sum() / len(dep))

    s, n = {}, {}
    for p, v in data.items():
        near = [data[q] for q in neighbours(p) if q in data]
        if near:
            s[v] = s.get(v, 0) + abs(v - np.mean(near))
            n[v] = n.get(v, 0) + 1
    total = sum(n.values())
    p = {i: n[i] / total for i in n}
    tone = texture.ngtdm(levels_frame(spark, array), K).first()
    assert tone["Coarseness"] == pytest.approx(1 / sum(p[i] * s[i] for i in n))
    busy = sum(abs(i * p[i] - j * p[j]) for i in n for j in n)
    assert tone["Busyness"] == pytest.approx(sum(p[i] * s[i] for i in n) / busy)


def test_uniform_region(spark):
    frame = levels_frame(spark, np.ones((3, 3, 1), int))
    glcm = texture.glcm(frame, K, mcc=True).first()
    assert (glcm["Contrast"], glcm["JointEnergy"], glcm["Correlation"], glcm["MCC"]) == (0, 1, 1, 1)
    assert glcm["Imc1"] == 0 and glcm["Imc2"] == 0
    tone = texture.ngtdm(frame, K).first()
    assert tone["Coarseness"] == texture.COARSENESS_LIMIT and tone["Contrast"] == 0


def test_maximal_correlation(spark, array):
    rows = texture.cooccurrence(levels_frame(spark, array), K).toPandas()
    values = []
    for _, m in rows.groupby("angle"):
        ids = sorted(m.i.unique())
        p = np.zeros((len(ids), len(ids)))
        for r in m.itertuples():
            p[ids.index(r.i), ids.index(r.j)] = r.p
        px = p.sum(axis=1)
        q = np.einsum("ik,jk,i,k->ij", p, p, 1 / px, 1 / px)
        values.append(math.sqrt(sorted(np.linalg.eigvals(q).real)[-2]))
    got = texture.glcm(levels_frame(spark, array), K, mcc=True).first()
    assert got["MCC"] == pytest.approx(np.mean(values))


def test_levels_start_at_one(spark):
    rows = [("p", i, 0, 0, v) for i, v in enumerate([-30.0, -25.0, 0.0, 24.9, 25.0])]
    v = spark.createDataFrame(rows, "patientID string, x int, y int, z int, value double")
    got = {r["value"]: r["level"] for r in texture.roi_levels(v, None, 25.0, K).collect()}
    assert got == {-30.0: 1, -25.0: 2, 0.0: 3, 24.9: 3, 25.0: 4}


def test_firstorder_by_definition(spark):
    x = np.array([3.0, -1.0, 4.5, 10.0, 2.0, 2.0, 7.5])
    rows = [("p", i, 0, 0, float(v)) for i, v in enumerate(x)]
    v = spark.createDataFrame(rows, "patientID string, x int, y int, z int, value double")
    got = texture.firstorder(texture.roi_levels(v, None, 2.0, K), K, 2.0).first()
    p10, p90 = np.percentile(x, [10, 90])
    core = x[(x >= p10) & (x <= p90)]
    m = x - x.mean()
    want = {
        "Energy": (x**2).sum(), "TotalEnergy": 2 * (x**2).sum(), "Mean": x.mean(), "Median": np.median(x),
        "10Percentile": p10, "90Percentile": p90, "Variance": x.var(), "RootMeanSquared": math.sqrt((x**2).mean()),
        "MeanAbsoluteDeviation": abs(m).mean(), "RobustMeanAbsoluteDeviation": abs(core - core.mean()).mean(),
        "Skewness": (m**3).mean() / x.std() ** 3, "Kurtosis": (m**4).mean() / x.var() ** 2, "Range": np.ptp(x),
    }
    for name, value in want.items():
        assert got[name] == pytest.approx(value), name


def test_shape_axes_match_numpy(spark):
    rng = np.random.default_rng(2)
    for array in (rng.random((5, 4, 6)) > 0.6, np.ones((4, 1, 1), bool), np.ones((2, 2, 2), bool)):
        rows = [("p", int(x), int(y), int(z), 1.0) for x, y, z in np.argwhere(array)]
        df = spark.createDataFrame(rows, "patientID string, x int, y int, z int, value double")
        spacing = (1.0, 1.5, 3.0)
        got = texture.shape(df, K, spacing).first()
        values = np.linalg.eigvalsh(np.cov((np.argwhere(array) * spacing).T, bias=True)).clip(0)
        want = 4 * np.sqrt(values[::-1])
        assert [got["MajorAxisLength"], got["MinorAxisLength"], got["LeastAxisLength"]] == pytest.approx(
            list(want), abs=1e-6
        )
        assert got["VoxelVolume"] == pytest.approx(array.sum() * 4.5)


def test_shape_diagnostics_and_skipped_regions(spark):
    schema = "patientID string, sub_Analysis string, x int, y int, z int, value double"
    box = [(x, y, z) for x in range(4) for y in range(3) for z in range(2)]
    keys = [("a", "s"), ("b", "s"), ("c", "s"), (None, "s")]
    image = spark.createDataFrame([(*k, x, y, z, float(x)) for k in keys for x, y, z in box], schema)
    filled = [("a", "s", x, y, z, float(x > 0)) for x, y, z in box]
    mask = spark.createDataFrame(
        [*filled, ("b", "s", 0, 0, 0, 0.0), ("b", "s", 1, 0, 0, None), ("d", "s", 0, 0, 0, 1.0)], schema
    )
    both = ["patientID", "sub_Analysis"]
    known = mask.filter("patientID <> 'd'")
    configs = [FeatureConfig("Original", classes=("shape",)), FeatureConfig("Second", classes=("shape", "firstorder"))]
    (row,) = extract_features(image, known, configs, both, with_diagnostics=True).collect()
    assert row["Original_shape_VoxelCount"] == row["Second_shape_VoxelCount"] == 18
    assert row["Second_firstorder_Mean"] == 2
    assert row["diagnostics_Image-original_Mean"] == 1.5 and row["diagnostics_Mask-original_VoxelNum"] == 18
    assert [row[f"diagnostics_Mask-original_BoundingBox_{a}"] for a in "xyz"] == [1, 0, 0]
    assert [row[f"diagnostics_Mask-original_BoundingBox_size_{a}"] for a in "xyz"] == [3, 3, 2]
    assert [row[f"diagnostics_Mask-original_CenterOfMassIndex_{a}"] for a in "xyz"] == [2, 1, 0.5]
    skipped = {r["patientID"]: r["reason"] for r in skipped_regions(image, mask, both).collect()}
    assert skipped == {"b": "empty mask", "c": "no mask", None: "no mask", "d": "no image"}
    assert skipped_regions(image.limit(0), mask.limit(0), both).count() == 0
    with pytest.raises(ValueError, match="class"):
        extract_features(image, known, [FeatureConfig("LoG", "LoG", sigma=[1.0], classes=("shape",))], both)


def test_extraction_joins_all_configurations(spark):
    rng = np.random.default_rng(3)
    rows = [
        (p, "s", int(x), int(y), int(z), float(rng.normal() * 40))
        for p in ("a", "b") for x, y, z in np.ndindex(6, 6, 3)
    ]
    image = spark.createDataFrame(rows, "patientID string, sub_Analysis string, x int, y int, z int, value double")
    mask = image.selectExpr("patientID", "sub_Analysis", "x", "y", "z", "double(x between 1 and 3 and y > 1) value")
    configs = [
        FeatureConfig("Original", classes=("firstorder", "ngtdm")),
        FeatureConfig("LoG", "LoG", pad=2, sigma=[1.0], classes=("firstorder",)),
        FeatureConfig("Gab", "Gabor", 10.0, pad=2, size=4, classes=("firstorder",)),
    ]
    out = extract_features(image, mask, configs)
    frame = out.toPandas()
    assert len(frame) == 2 and not frame.isna().any().any()
    assert {"Original_firstorder_Mean", "LoG-sigma-1-0-mm-3D_firstorder_Energy", "Gab_firstorder_Range", "Original_ngtdm_Strength"} <= set(frame)
    plain = texture.firstorder(texture.roi_levels(image, mask), ["patientID", "sub_Analysis"]).toPandas()
    got = frame.set_index("patientID").Original_firstorder_Entropy
    want = plain.set_index("patientID").Entropy
    assert got.sort_index().tolist() == pytest.approx(want.sort_index().tolist())


def test_regions_are_shuffled_once_for_their_statistics(spark, monkeypatch):
    """Small regions need one shuffle of their voxels; the way for large ones gives the same numbers."""
    rng = np.random.default_rng(12)
    rows = [(p, int(x), 0, 0, float(v), int(v // 2) + 6) for p, n in (("p", 90), ("q", 1), ("r", 17))
            for x, v in enumerate(rng.normal(0, 3, n).clip(-9, 9))]
    rows.append((None, 0, 0, 0, 1.0, 1))
    levels = spark.createDataFrame(rows, "patientID string, x int, y int, z int, value double, level int")
    near = texture.firstorder(levels, ["patientID"], 2.0)
    assert near._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    near = near.toPandas().set_index("patientID").sort_index()
    monkeypatch.setattr(texture, "REGION_ROWS", 1)
    far = texture.firstorder(levels, ["patientID"], 2.0).toPandas().set_index("patientID").sort_index()
    assert list(near.index) == list(far.index) == ["p", "q", "r"] and list(near.columns) == list(far.columns)
    assert np.allclose(near.to_numpy(float), far.to_numpy(float), rtol=1e-9, atol=1e-12)
    # Level pairs stay where they were counted: voxels, the regions' highest levels and the result are all that moves.
    plan = texture.glcm(levels, ["patientID"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(patientID") <= 5 and "FileScan" not in plan
