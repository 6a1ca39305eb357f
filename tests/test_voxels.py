"""Voxel operators on small volumes, against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelark.operators import convolve, intensity, masks, resample
from voxelark.operators.selection import drop_empty_masks, skipped_report

K = ["patientID", "sub_Analysis"]
SCHEMA = "patientID string, sub_Analysis string, x int, y int, z int, value double"


def volume(spark, array, patient="p", extra=None):
    rows = [
        (patient, "s", int(x), int(y), int(z), float(array[x, y, z])) for x, y, z in np.ndindex(*array.shape)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    return df if extra is None else df.withColumn("series", F.lit(extra))


def dense(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["x"], r["y"], r["z"]] = r["value"]
    return out


@pytest.fixture(scope="module")
def array():
    return np.random.default_rng(0).normal(size=(5, 4, 3)) * 50


def test_windowing_is_idempotent_and_presets_are_checked(spark, array):
    v = volume(spark, array)
    once = intensity.window_intensity(v, 10, 40)
    np.testing.assert_allclose(dense(once, array.shape), np.clip(array, -10, 30))
    assert intensity.window_intensity(once, 10, 40).exceptAll(once).count() == 0
    assert intensity.WINDOW_PRESETS["CT_pancreas"] == (500, 50) and len(intensity.WINDOW_PRESETS) == 18
    with pytest.raises(ValueError, match="unknown window"):
        intensity.window_preset(v, "CT_knee")


@pytest.mark.parametrize("n", [2, 16])
def test_bins_by_number_match_digitize(spark, array, n):
    inside = array > -20
    mask = volume(spark, inside.astype(float))
    got = dense(intensity.bin_intensity(volume(spark, array), n_bins=n, mask=mask), array.shape)
    edges = np.linspace(array[inside].min(), array[inside].max(), n + 1)
    np.testing.assert_array_equal(got, np.clip(np.digitize(array, edges) - 1, 0, n - 1))


def test_values_on_bin_edges(spark):
    line = np.arange(9.0).reshape(9, 1, 1)
    by_number = dense(intensity.bin_intensity(volume(spark, line), n_bins=4), line.shape).ravel()
    assert list(by_number) == [0, 0, 1, 1, 2, 2, 3, 3, 3]
    by_width = dense(intensity.bin_intensity(volume(spark, line), bin_width=2.0), line.shape).ravel()
    edges = np.arange(0, 8 + 2.0, 2.0)
    assert list(by_width) == list(np.clip(np.digitize(line.ravel(), edges) - 1, 0, len(edges) - 2))


def test_constant_volume(spark):
    flat = volume(spark, np.full((2, 2, 1), 7.0))
    assert {r["value"] for r in intensity.bin_intensity(flat, n_bins=8).collect()} == {7}
    assert {r["value"] for r in intensity.bin_intensity(flat, bin_width=5).collect()} == {0}
    assert {r["value"] for r in intensity.scale_intensity(flat, "zscore").collect()} == {None}


def test_scaling_methods(spark, array):
    v = volume(spark, array)
    inside = array > 0
    mask = volume(spark, inside.astype(float) * 2)
    z = dense(intensity.scale_intensity(v, "zscore", mask), array.shape)
    np.testing.assert_allclose(z, (array - array[inside].mean()) / array[inside].std())
    lin = dense(intensity.scale_intensity(v, "linear", low=-1, high=3), array.shape)
    np.testing.assert_allclose(lin, np.interp(array, [array.min(), array.max()], [-1, 3]), atol=1e-12)
    rob = dense(intensity.scale_intensity(v, "robust", lower_percent=5, upper_percent=90), array.shape)
    p5, p50, p90 = np.percentile(array, [5, 50, 90])
    np.testing.assert_allclose(rob, (array - p50) / (p90 - p5))
    u8 = dense(intensity.scale_uint8(v), array.shape)
    np.testing.assert_array_equal(u8, ((array - array.min()) / (array.max() - array.min()) * 255).astype(np.uint8))


def test_histogram_matching_to_itself_changes_nothing(spark, array):
    v = volume(spark, array)
    np.testing.assert_allclose(dense(intensity.match_histogram(v, v), array.shape), array, atol=1e-9)
    scaled = volume(spark, array * 3 + 10)
    got = dense(intensity.match_histogram(scaled, v), array.shape)
    np.testing.assert_allclose(got, array, atol=1e-8)


def test_histogram_matching_leaves_voxels_outside_the_mask(spark, array):
    mask = volume(spark, (array > 0).astype(float))
    got = dense(intensity.match_histogram(volume(spark, array), volume(spark, array * 2), mask), array.shape)
    np.testing.assert_allclose(got[array <= 0], array[array <= 0])
    assert not np.allclose(got[array > 0], array[array > 0])


def named(spark, arrays):
    parts = [volume(spark, a, extra=n) for n, a in arrays.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_merging_masks(spark):
    a = np.array([[[2.0], [2.0], [0.0], [0.0]]])
    b = np.array([[[0.0], [1.0], [1.0], [0.0]]])
    files = named(spark, {"Mask_Panc.nii.gz": a, "mask_duct.nii.gz": b, "img.nii.gz": b * 0 + 5})
    got = dense(masks.merge_masks(files, regex="Pan*"), a.shape).ravel()
    assert list(got) == [1, 0, 0, 0]
    lists = {"add": ["mask_duct.nii.gz", "Mask_Panc.nii.gz"]}
    assert list(dense(masks.merge_masks(files, **lists), a.shape).ravel()) == [1, 1, 1, 0]
    assert masks.merge_masks(files, add=["Mask_Panc.nii.gz"], sub=["Mask_none.nii.gz"]).count() == 0
    assert masks.missing_masks(files, ["Mask_none.nii.gz"]).count() == 1
    with pytest.raises(ValueError):
        masks.merge_masks(files)
    with pytest.raises(ValueError):
        masks.merge_masks(files, regex="x", add=["y"])


def test_thresholding_keeps_mask_values_within_bounds(spark, array):
    mask = (array > 10) * 2.0
    got = dense(masks.threshold_mask(volume(spark, array), volume(spark, mask), 15, 60), array.shape)
    np.testing.assert_array_equal(got, np.where((array >= 15) & (array <= 60), mask, 0))
    ones = volume(spark, np.ones_like(array))
    positive = dense(masks.threshold_mask(volume(spark, array), ones, positive_only=True), array.shape)
    np.testing.assert_array_equal(positive, (array > 0) * 1.0)
    assert dense(masks.threshold_mask(volume(spark, array), ones), array.shape).all()


def test_empty_masks_are_reported(spark):
    both = volume(spark, np.zeros((2, 1, 1))).unionByName(volume(spark, np.ones((2, 1, 1)), "q"))
    kept, empty = drop_empty_masks(both)
    assert {r["patientID"] for r in kept.collect()} == {"q"}
    report = skipped_report({"empty mask": empty}).collect()
    assert [(r["patientID"], r["reason"]) for r in report] == [("p", "empty mask")]


def test_crop_pads_the_bounding_box(spark):
    image = np.arange(216.0).reshape(6, 6, 6)
    mask = np.zeros((6, 6, 6))
    mask[2, 3, 4] = 1
    got = masks.crop_to_mask(volume(spark, image), volume(spark, mask), pad=1)
    assert got.count() == 27
    assert {r["x"] for r in got.collect()} == {1, 2, 3}


def test_series_kinds(spark):
    many = np.arange(120.0).reshape(120, 1, 1)
    few = np.arange(99.0).reshape(99, 1, 1)
    files = named(
        spark,
        {"my_IMG.nii.gz": few, "MSK_img.nii.gz": few, "Mask.nii.gz": many, "x.nii.gz": many, "y.nii.gz": few},
    )
    kinds = {r["series"]: r["kind"] for r in masks.classify_series(files).collect()}
    assert kinds == {
        "my_IMG.nii.gz": "image", "MSK_img.nii.gz": "image", "Mask.nii.gz": "mask",
        "x.nii.gz": "image", "y.nii.gz": "mask",
    }


def geometry(spark, shape, spacing):
    row = ("p", "s", *shape, *[float(s) for s in spacing])
    return spark.createDataFrame(
        [row], "patientID string, sub_Analysis string, nx int, ny int, nz int, sx double, sy double, sz double"
    )


def interpolate(array, spacing, size, method, outside):
    """Point by point on the target grid."""
    n = array.shape
    new = [int(round(n[a] * (spacing[a] / size))) for a in range(3)]
    out = np.zeros(new)
    for t in np.ndindex(*new):
        c = [t[a] * size / spacing[a] for a in range(3)]
        if outside == "zero" and any(c[a] >= n[a] - 0.5 for a in range(3)):
            continue
        if method == "nearest":
            out[t] = array[tuple(min(math.floor(c[a] + 0.5), n[a] - 1) for a in range(3))]
            continue
        total = 0.0
        for corner in np.ndindex(2, 2, 2):
            w, index = 1.0, []
            for a in range(3):
                low = min(math.floor(c[a]), n[a] - 1)
                f = min(c[a] - low, 1.0)
                w *= f if corner[a] else 1 - f
                index.append(min(low + corner[a], n[a] - 1))
            total += w * array[tuple(index)]
        out[t] = total
    return out


@pytest.mark.parametrize("method", ["nearest", "linear"])
@pytest.mark.parametrize("outside", ["zero", "edge"])
@pytest.mark.parametrize("spacing,size", [((1, 1, 3), 1.0), ((0.7, 1.3, 2.5), 0.9), ((1, 1, 1), 2.0)])
def test_resampling(spark, array, method, outside, spacing, size):
    got = resample.resample(
        volume(spark, array), geometry(spark, array.shape, spacing), size, method, outside=outside
    )
    want = interpolate(array, spacing, size, method, outside)
    assert got.count() == want.size
    np.testing.assert_allclose(dense(got, want.shape), want, atol=1e-9)


def test_resampling_to_the_same_spacing_is_identity(spark, array):
    got = resample.resample(volume(spark, array), geometry(spark, array.shape, (2, 2, 2)), 2.0)
    np.testing.assert_allclose(dense(got, array.shape), array)


def test_new_size_rounds_half_to_even(spark):
    table = resample.resampled_volumes(geometry(spark, (5, 7, 3), (0.5, 0.5, 0.5)), 1.0).first()
    assert (table["nx"], table["ny"], table["nz"]) == (2, 4, 2)


def convolved(array, taps):
    out = np.zeros_like(array)
    n = array.shape
    for p in np.ndindex(*n):
        out[p] = sum(
            w * array[tuple(min(max(p[a] - d[a], 0), n[a] - 1) for a in range(3))] for *d, w in taps
        )
    return out


def test_any_kernel_is_convolved_exactly(spark, array):
    rng = np.random.default_rng(1)
    taps = [(int(a), int(b), int(c), float(rng.normal())) for a, b, c in rng.integers(-3, 4, (9, 3))]
    taps = list({t[:3]: t for t in taps}.values())
    got = dense(convolve.convolve(volume(spark, array), taps), array.shape)
    np.testing.assert_allclose(got, convolved(array, taps), atol=1e-9)


def test_gabor_kernel_shape():
    taps = {(x, y): w for x, y, _, w in convolve.gabor_kernel(8, 0.5, 0.0)}
    assert len(taps) == 64 and taps[(0, 0)] == 1.0
    assert taps[(1, 0)] == pytest.approx(-math.exp(-0.5 / 1.6**2))
    assert taps[(0, 1)] == pytest.approx(math.exp(-0.5 / 1.6**2))
    turned = {(x, y): w for x, y, _, w in convolve.gabor_kernel(8, 0.5, math.pi / 2)}
    assert turned[(0, 1)] == pytest.approx(taps[(1, 0)])


def test_filter_bank_runs_all_filters_together(spark, array):
    bank = {
        "log": convolve.log_terms(1.0, (1, 1, 2)),
        "gabor": convolve.kernel_terms(convolve.gabor_kernel(4, 0.25, 0.3)),
        **convolve.wavelet_bank([0.5, 0.5], [-0.5, 0.5]),
    }
    out = convolve.apply_filters(volume(spark, array), bank)
    low = dense(out.filter("filter_id = 'wavelet-LLL'"), array.shape)
    mean = [(i, j, k, 0.125) for i in (-1, 0) for j in (-1, 0) for k in (-1, 0)]
    np.testing.assert_allclose(low, convolved(array, mean), atol=1e-9)
    full = [
        (i, j, k, a * b * c) for tx, ty, tz in bank["log"] for i, a in tx for j, b in ty for k, c in tz
    ]
    np.testing.assert_allclose(dense(out.filter("filter_id = 'log'"), array.shape), convolved(array, full), atol=1e-8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") <= 3 * 2


def test_sparse_volumes_are_found(spark, array):
    v = volume(spark, array)
    assert convolve.sparse_volumes(v).count() == 0
    assert convolve.sparse_volumes(v.filter("not (x = 1 and y = 1 and z = 1)")).count() == 1


def test_study_is_routed_by_kind(spark, array):
    files = named(spark, {"img.nii.gz": array, "mask.nii.gz": (array > 0) * 1.0})
    files = files.unionByName(volume(spark, array, "q", "img.nii.gz"))
    vols = geometry(spark, array.shape, (1, 1, 1)).unionByName(
        geometry(spark, array.shape, (1, 1, 1)).withColumn("patientID", F.lit("q"))
    )
    vols = vols.withColumn("series", F.explode(F.array(F.lit("img.nii.gz"), F.lit("mask.nii.gz"))))
    out, lonely = resample.resample_study(files, vols, 0.5)
    frame = out.toPandas()
    assert set(frame[frame.series == "mask.nii.gz"].value) == {0.0, 1.0}
    assert [r["patientID"] for r in lonely.collect()] == ["q"]
    assert set(map(tuple, frame[["patientID", "series"]].drop_duplicates().values)) == {
        ("p", "img.nii.gz"), ("p", "mask.nii.gz"), ("q", "img.nii.gz"),
    }


def test_missing_voxels_stay_missing(spark):
    """NULL and NaN voxels get no value from windowing, binning or scaling, and none end the job."""
    values = [0.0, 5.0, 10.0, None, float("nan"), 1e12]
    rows = [("p", "a", x, 0, 0, v) for x, v in enumerate(values)]
    v = spark.createDataFrame(rows, "patientID string, sub_Analysis string, x int, y int, z int, value double")
    mask = v.filter("x < 5").withColumn("value", F.lit(1.0))

    def got(df):
        return [r["value"] for r in df.orderBy("x").collect()]

    assert got(intensity.window_intensity(v, 5, 10)) == [0.0, 5.0, 10.0, None, None, 10.0]
    assert got(intensity.bin_intensity(v, n_bins=2, mask=mask)) == [0, 1, 1, None, None, 1]
    assert got(intensity.bin_intensity(v, bin_width=5, mask=mask)) == [0, 1, 1, None, None, 1]
    assert got(intensity.scale_uint8(v, mask)) == [0, 127, 255, None, None, 255]
    for method in ("linear", "zscore", "robust"):
        assert [x is None for x in got(intensity.scale_intensity(v, method, mask))] == [False] * 3 + [True] * 2 + [False]


def line(spark, values, at=None):
    rows = [("p", "a", x, 0, 0, v) for x, v in zip(at or range(len(values)), values)]
    return spark.createDataFrame(rows, "patientID string, sub_Analysis string, x int, y int, z int, value double")


def along(df):
    return {r["x"]: r["value"] for r in df.collect()}


def test_filters_go_by_position(spark):
    """A missing neighbour is no border: NULL beside it, the value by position elsewhere."""
    shift = [(1, 0, 0, 1.0)]
    assert along(convolve.convolve(line(spark, [1.0, 2.0, None, 4.0, 100.0]), shift)) == {0: 1.0, 1: 1.0, 2: None, 3: None, 4: 4.0}
    assert along(convolve.convolve(line(spark, [1.0, 2.0, float("nan"), 4.0, 100.0]), shift))[3] is None
    gap = line(spark, [1.0, 2.0, 4.0, 100.0], at=[0, 1, 3, 4])
    assert along(convolve.convolve(gap, shift)) == {0: 1.0, 1: 1.0, 3: None, 4: 4.0}
    # The border voxel of the volume itself may be missing on a line.
    two = line(spark, [1.0, 2.0], at=[1, 2]).unionByName(line(spark, [5.0], at=[0]).selectExpr("patientID", "sub_Analysis", "x", "1 y", "z", "value"))
    assert along(convolve.convolve(two, shift).filter("y = 0")) == {1: None, 2: 1.0}
    far = [(2, 0, 0, 1.0), (0, 0, 0, 1.0)]
    assert along(convolve.convolve(line(spark, [1.0, None, 3.0, 4.0, 5.0]), far)) == {0: 2.0, 1: None, 2: None, 3: None, 4: 8.0}


def test_resampling_goes_by_position(spark):
    vols = geometry(spark, (5, 1, 1), (2, 1, 1)).withColumn("sub_Analysis", F.lit("a"))
    whole = line(spark, [0.0, 2.0, 4.0, 6.0, 8.0])
    assert [along(resample.resample(whole, vols, 1.0, outside="edge"))[t] for t in range(10)] == [0, 1, 2, 3, 4, 5, 6, 7, 8, 8]
    gap = along(resample.resample(line(spark, [0.0, 2.0, 6.0, 8.0], at=[0, 1, 3, 4]), vols, 1.0, outside="edge"))
    # Targets 4 and 5 belong to the absent voxel; target 3 lacks its second neighbour.
    assert gap == {0: 0, 1: 1, 2: 2, 3: None, 6: 6, 7: 7, 8: 8, 9: 8}
    null = along(resample.resample(line(spark, [0.0, 2.0, None, 6.0, 8.0]), vols, 1.0, outside="edge"))
    assert null == {0: 0, 1: 1, 2: 2, 3: None, 4: None, 5: None, 6: 6, 7: 7, 8: 8, 9: 8}


def decomposed(array, low, high, dilation):
    taps = {"L": low, "H": high}
    middle = len(low) // 2
    out = {}
    for name in ("LH"[a] + "LH"[b] + "LH"[c] for a, b, c in np.ndindex(2, 2, 2)):
        full = [
            ((i - middle) * dilation, (j - middle) * dilation, (k - middle) * dilation, wa * wb * wc)
            for i, wa in enumerate(taps[name[0]]) for j, wb in enumerate(taps[name[1]]) for k, wc in enumerate(taps[name[2]])
        ]
        out[name] = convolved(array, full)
    return out


@pytest.mark.parametrize("level,start", [(1, 0), (2, 0), (1, 1), (2, 1)])
def test_wavelets_of_several_levels(spark, array, level, start):
    low, high = [0.25, 0.5, 0.25], [-0.25, 0.5, -0.25]
    got = convolve.wavelet_levels(volume(spark, array), low, high, level, start)
    current, want = array, {}
    for n in range(start + level):
        bands = decomposed(current, low, high, 1 << n)
        if n >= start:
            prefix = "wavelet" if n == start else f"wavelet{n - start + 1}"
            want |= {f"{prefix}-{k}": v for k, v in bands.items() if k != "LLL" or n == start + level - 1}
        current = bands["LLL"]
    assert {r["filter_id"] for r in got.select("filter_id").distinct().collect()} == set(want)
    for name in ("LLL", "HLH"):
        label = f"wavelet{level}-{name}" if level > 1 else f"wavelet-{name}"
        np.testing.assert_allclose(dense(got.filter(F.col("filter_id") == label), array.shape), want[label], atol=1e-9)
    with pytest.raises(ValueError):
        convolve.wavelet_levels(volume(spark, array), low, high, 0)


def test_volumes_without_mask_voxels_stay_and_are_reported(spark):
    v = line(spark, [1.0, 2.0, 3.0]).unionByName(line(spark, [4.0, None, float("nan")]).withColumn("patientID", F.lit("q")))
    v = v.unionByName(line(spark, [None, None]).withColumn("patientID", F.lit("r"))).unionByName(line(spark, [1.0]).withColumn("patientID", F.lit("s")))
    mask = v.filter("patientID <> 's'").withColumn("value", F.when(F.col("patientID") == "q", F.col("x") > 0).otherwise(F.col("patientID") == "p").cast("int"))
    reasons = {r["patientID"]: r["reason"] for r in intensity.skipped_volumes(v, mask).collect()}
    assert reasons == {"q": "no values inside the mask", "r": "no values", "s": "no mask"}
    assert [r["patientID"] for r in intensity.skipped_volumes(v).collect()] == ["r"]
    for out in (
        intensity.bin_intensity(v, n_bins=2, mask=mask), intensity.bin_intensity(v, bin_width=1.0, mask=mask),
        intensity.scale_uint8(v, mask), *[intensity.scale_intensity(v, m, mask) for m in ("linear", "zscore", "robust")],
    ):
        assert out.count() == v.count()
        assert {r["patientID"] for r in out.filter("value is not null").collect()} == {"p"}
