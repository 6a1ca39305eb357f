"""Manifests, sources, pipelines, scoring and streams."""

import datetime as dt
import random
import re
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline as MlPipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from voxelark.functions.names import prefix_listed, stem, suffixed_name
from voxelark.operators import combat as combat_module
from voxelark.operators.predict import LinearScorer, predict
from voxelark.operators.selection import check_complete, filter_rois, include, skip
from voxelark.operators.structure import check_structure, matching_files, reorganize_plan, unsegmented
from voxelark.plans import pipeline as pipeline_module
from voxelark.plans.pipeline import Pipeline, PipelineBundle, Step
from voxelark.sources import tables
from voxelark.sources.study import manifest_columns, scan_manifest
from voxelark.streaming import arrivals

FEATURES = "patientID string, sub_Analysis string, f double, g double"


def manifest(spark, paths):
    return manifest_columns(spark.createDataFrame([(p,) for p in paths], "path string"), "/data/study")


def test_scan_reads_paths_only(spark, tmp_path):
    for name in ("a/s1/DCM/1.dcm", "a/s1/RTSTRUCT.dcm", "a/loose.dcm"):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(b"1234")
    df = scan_manifest(spark, str(tmp_path))
    rows = {(r["patientID"], r["sub_Analysis"], r["inner"], r["file_name"], r["length"]) for r in df.collect()}
    assert rows == {
        ("a", "s1", "DCM/1.dcm", "1.dcm", 4), ("a", "s1", "RTSTRUCT.dcm", "RTSTRUCT.dcm", 4), ("a", None, None, "loose.dcm", 4),
    }
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan


SORTED = ["/data/study/p/s1/DCM/1.dcm", "/data/study/p/s1/RTSTRUCT.dcm", "/data/study/q/s2/DCM/a/2.dcm"]
LOOSE = [
    "/data/study/p/art/1.dcm", "/data/study/p/art/sub/9.dcm", "/data/study/p/ART_rt.dcm",
    "/data/study/p/ven/1.dcm", "/data/study/p/ven_1.dcm", "/data/study/p/ven_2.dcm", "/data/study/q/none/1.dcm",
]


def status(df, **options):
    return check_structure(df, **options).first()["status"]


def test_structure_status(spark):
    assert status(manifest(spark, SORTED), with_segmentation=False) == "Ready"
    assert status(manifest(spark, SORTED)) == "Invalid"
    assert status(manifest(spark, [*SORTED, "/data/study/q/s2/RTSTRUCT.dcm"])) == "Ready"
    assert status(manifest(spark, LOOSE)) == "Invalid"
    assert status(manifest(spark, LOOSE[:3])) == "Ready_to_reorganize"
    assert status(manifest(spark, LOOSE), with_segmentation=False) == "Ready_to_reorganize"


def test_names_with_pattern_characters_are_patterns(spark):
    df = manifest(spark, ["/data/study/p/v.n/1.dcm", "/data/study/p/xVENx.dcm", "/data/study/p/v_.dcm"])
    assert [r["file_name"] for r in matching_files(df).collect()] == ["xVENx.dcm"]


def test_reorganization_plan(spark):
    rows = reorganize_plan(manifest(spark, LOOSE)).collect()
    moves = {r["source"].removeprefix("/data/study/"): r["target"] for r in rows if r["status"] == "move"}
    assert moves == {
        "p/art/1.dcm": "p/art/DCM/1.dcm", "p/ART_rt.dcm": "p/art/RTSTRUCT.dcm",
        "p/ven/1.dcm": "p/ven/DCM/1.dcm", "q/none/1.dcm": "q/none/DCM/1.dcm",
    }
    others = {(r["sub_Analysis"], r["status"]) for r in rows if r["status"] != "move"}
    assert others == {("none", "warning: segmentation not found"), ("ven", "error: several segmentations found")}
    strict = {r["status"] for r in reorganize_plan(manifest(spark, LOOSE), all_segmented=True).collect()}
    assert "error: segmentation not found" in strict


def test_unsegmented_per_image_type(spark):
    assert [r["patientID"] for r in unsegmented(manifest(spark, SORTED)).collect()] == ["q"]
    nifti = manifest(spark, ["/data/study/p/s/img.nii.gz", "/data/study/q/s/img.nii.gz", "/data/study/q/s/liver.nii.gz"])
    assert [r["patientID"] for r in unsegmented(nifti, "nifti").collect()] == ["p"]
    with pytest.raises(ValueError):
        unsegmented(nifti, "png")


def test_names(spark):
    df = spark.createDataFrame([("a.b.nii.gz",), ("Liver.nii.gz",), ("plain",), ("one.dcm",)], "file_name string")
    assert [r[0] for r in df.select(stem(F.col("file_name"))).collect()] == ["a.b", "Liver", "plain", "one"]
    assert df.select(suffixed_name(F.col("file_name"), "111")).first()[0] == "a.b_111.nii.gz"
    assert [r[0] for r in prefix_listed(df, ["LIVER", "a"]).collect()] == [
        "Mask_a.b.nii.gz", "Mask_Liver.nii.gz", "plain", "one.dcm",
    ]
    rois = spark.createDataFrame([("Pancreas",), ("pan",), ("origin",), ("Origin",)], "n string")
    assert [r[0] for r in filter_rois(rois, "n", "Pan|rigin").collect()] == ["Pancreas"]


def test_lists(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "patientID string, v int")
    ids = spark.createDataFrame([("a",), ("a",)], "patientID string")
    assert [r["v"] for r in include(df, ids).collect()] == [1]
    assert sorted(r["v"] for r in skip(df, ids).collect()) == [2, 3]
    assert include(df, ids.limit(0)).count() == 3


def test_incomplete_rows_are_shown(spark):
    df = spark.createDataFrame([("a", "s", 1.0), ("b", "s", float("nan"))], "patientID string, sub_Analysis string, v double")
    with pytest.raises(ValueError, match="'b'"):
        check_complete(df, ["v"])
    with pytest.raises(ValueError, match="w"):
        check_complete(df, ["w"])


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "s", 1.5, float("nan")), ("b", "s", None, 2.0)], FEATURES)
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        tables.write_features(df, path, fmt=fmt)
        tables.write_features(df, path, fmt=fmt)
        back = {r["patientID"]: (r["f"], r["g"]) for r in tables.read_features(spark, path, fmt).collect()}
        assert back == {"a": (1.5, None), "b": (None, 2.0)}
    tables.append_features(df, str(tmp_path / "parquet"))
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 4


def test_statistics_are_never_replaced(spark, tmp_path):
    df = spark.range(2)
    first = tables.write_stats(df, str(tmp_path / "st"))
    second = tables.write_stats(spark.range(5), str(tmp_path / "st"))
    assert first != second and second.startswith(first + "_")
    assert spark.read.parquet(first).count() == 2 and spark.read.parquet(second).count() == 5


def test_configs_side_by_side(spark):
    one = spark.createDataFrame([("a", "s", 1.0, "v1")], "patientID string, sub_Analysis string, `log-s_x` double, diagnostics_v string")
    two = spark.createDataFrame([("b", "s", 2.0, "v2")], "patientID string, sub_Analysis string, original_x double, diagnostics_v string")
    keys = ["patientID", "sub_Analysis"]
    parts = [tables.prefix_features(one, "LoG", keys), tables.prefix_features(two, "Orig", keys)]
    out = tables.assemble_configs(parts, keys)
    assert out.columns == [*keys, "LoG-s_x", "diagnostics_v", "Orig_x"]
    assert out.count() == 2
    merged = tables.merge_feature_tables(parts)
    assert merged.count() == 2 and set(merged.columns) == set(out.columns)


def test_predictions(spark):
    df = spark.createDataFrame([("a", "s", 1.0, 2.0), ("b", "s", 3.0, -1.0)], FEATURES)
    model = LinearScorer(["g", "f"], [10.0, 1.0], 0.5)
    got = predict(df.repartition(3), model).orderBy("patientID").collect()
    assert [r["predictions"] for r in got] == [21.5, -6.5]
    with pytest.raises(ValueError, match="h"):
        predict(df, model, ["h"])

    class Booster:
        def feature_name(self):
            return ["f"]

        def predict(self, frame):
            return frame["f"].to_numpy() * 2

    assert [r["predictions"] for r in predict(df, Booster()).orderBy("patientID").collect()] == [2.0, 6.0]
    ml = MlPipeline(stages=[VectorAssembler(inputCols=["f"], outputCol="v"), LinearRegression(featuresCol="v", labelCol="g")]).fit(df)
    assert [r["predictions"] for r in predict(df, ml).orderBy("patientID").collect()] == pytest.approx([2.0, -1.0])


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(0)
    frame = pd.DataFrame({"patientID": [f"p{i}" for i in range(40)], "sub_Analysis": "s", "f": rng.normal(size=40), "g": rng.normal(size=40) * 3})
    batch = pd.DataFrame({"patientID": frame.patientID, "sub_Analysis": "s", "batch": np.where(np.arange(40) % 2, "x", "y")})
    return spark.createDataFrame(frame), spark.createDataFrame(batch)


def test_chain_replays_training(spark, training, tmp_path):
    train, batch = training
    chain = Pipeline(
        [
            Step("harmonize", {"batch": batch, "ref_batch": "x"}),
            Step("normalize", {"method": "minmax", "features": ["f", "g"]}),
            Step(lambda df: df.withColumn("h", F.col("f") + F.col("g")), label="sum"),
        ],
        defaults={"keys": ["patientID", "sub_Analysis"]},
    )
    bundle, out = chain.fit(train)
    values = out.toPandas()
    assert values.f.min() == pytest.approx(0) and values.f.max() == pytest.approx(1) and "h" in values
    new = train.withColumn("patientID", F.concat(F.lit("n"), "patientID"))
    new_batch = batch.withColumn("patientID", F.concat(F.lit("n"), "patientID"))
    scorer = Step("predict", {"model": LinearScorer(["h"], [2.0])})
    replay = {"overrides": {"harmonize": {"batch": new_batch}}, "then": [scorer]}
    scored = bundle.transform(new, **replay).orderBy("patientID").collect()
    assert len(scored) == 40
    bundle.save(str(tmp_path / "b"))
    again = PipelineBundle.load(spark, str(tmp_path / "b"), chain)
    for a, b in zip(scored, again.transform(new, **replay).orderBy("patientID").collect()):
        assert a["predictions"] == pytest.approx(b["predictions"])


def test_defaults_sources_and_timings(spark, training):
    train, _ = training
    steps = [
        Step("dedupe", {"order_by": ["f"]}, label="first"),
        Step(lambda df: df.filter("f > 0"), label="positive"),
        Step(lambda df, scale=1: df.withColumn("f", F.col("f") * scale), {"scale": 3}, "scaled", source="first"),
    ]
    out, timings = Pipeline(steps, {"keys": ["patientID"], "scale": 2}).run(train, timer=True)
    assert out.count() == 40
    assert [r["step"] for r in timings.orderBy("position").collect()] == ["first", "positive", "scaled"]
    total = train.agg(F.sum("f")).first()[0]
    assert out.agg(F.sum("f")).first()[0] == pytest.approx(3 * total)
    with pytest.raises(ValueError, match="unknown step"):
        Pipeline([Step("fly")]).run(train)


def test_new_and_stable_items(spark):
    schema = "patientID string, modificationTime timestamp, length long"
    ts = datetime.fromisoformat
    old = spark.createDataFrame([("a", ts("2024-01-01"), 5), ("b", ts("2024-01-01"), 5), ("c", ts("2024-01-01"), 1), ("c", ts("2024-01-02"), 1)], schema)
    done = spark.createDataFrame([("b",)], "patientID string")
    now = F.lit("2024-01-02 00:05:00").cast("timestamp")
    assert [r["patientID"] for r in arrivals.discover_new(old, done, 10, now).collect()] == ["a"]
    later = old.unionByName(spark.createDataFrame([("b", ts("2024-01-01"), 1)], schema))
    assert sorted(r["patientID"] for r in arrivals.stable_items(old, later).collect()) == ["a", "c"]


def test_pools_survive_a_restart(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "id long, k long"

    def poll():
        stream = arrivals.read_arrivals(spark, source, schema, max_files=1)
        step = lambda df: df.groupBy("k").count()
        arrivals.run_incremental(stream, step, out, checkpoint).awaitTermination()
        return spark.read.parquet(out)

    spark.range(10).selectExpr("id", "id % 2 k").coalesce(1).write.parquet(source)
    first = poll().count()
    assert poll().count() == first == 2
    spark.range(4).selectExpr("id", "5L k").coalesce(1).write.mode("append").parquet(source)
    assert sorted((r["k"], r["count"]) for r in poll().collect()) == [(0, 5), (1, 5), (5, 4)]
    with pytest.raises(ValueError):
        arrivals.read_arrivals(spark, source, schema, clean="burn")


@pytest.mark.parametrize("made_from_pool", [False, True])
def test_stream_takes_the_batch_table_of_new_samples(spark, training, tmp_path, made_from_pool):
    train, batch = training
    steps = [
        Step("harmonize", {"batch": batch, "ref_batch": "x"}),
        Step("normalize", {"method": "minmax", "features": ["f", "g"]}),
    ]
    bundle, _ = Pipeline(steps, {"keys": ["patientID", "sub_Analysis"]}).fit(train)
    new = train.withColumn("patientID", F.concat(F.lit("n"), "patientID"))
    new_batch = batch.withColumn("patientID", F.concat(F.lit("n"), "patientID"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    new.coalesce(1).write.parquet(source)

    def of_pool(pool):
        return {"harmonize": {"batch": new_batch.join(pool.select("patientID"), "patientID", "left_semi")}}

    overrides = of_pool if made_from_pool else {"harmonize": {"batch": new_batch}}
    arriving = arrivals.read_arrivals(spark, source, train.schema)
    then = [Step("predict", {"model": LinearScorer(["f", "g"], [2.0, 1.0])})]
    arrivals.score_stream(arriving, bundle, out, str(tmp_path / "c"), overrides=overrides, then=then).awaitTermination()
    want = bundle.transform(new, {"harmonize": {"batch": new_batch}}, then).orderBy("patientID").collect()
    got = spark.read.parquet(out).orderBy("patientID").collect()
    assert [r["patientID"] for r in got] == [r["patientID"] for r in want]
    assert [r["predictions"] for r in got] == pytest.approx([r["predictions"] for r in want])


def test_finished_inputs_can_be_archived(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "old"
    for i in range(3):
        spark.range(1).selectExpr(f"{i}L id").coalesce(1).write.mode("append").parquet(str(source))
    for n in range(2):
        stream = arrivals.read_arrivals(spark, str(source), "id long", max_files=1, clean="archive", archive=str(archive))
        arrivals.append_results(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert list(archive.rglob("*.parquet"))


def test_names_meet_files_by_required_text(spark):
    """Plain names, short ones and patterns against a search of every name in every file."""
    rng = random.Random(5)
    names = ["CT", "ct_abdomen", "a.c", "x.*y", "(MR|PET)", "v?en", "ab+c", "T1", "pre[0-9]", "é1x", "^rt_v", "end$", "A", "dup", "DUP"]
    files = ["rt_ct_ABDOMEN_1.dcm", "aXc.dcm", "x12y", "mr_7", "pet", "ven", "en.dcm", "abbbc", "PRE5", "É1X.dcm", "rt_ven", "the end", "t1", "dup", ""]
    files += ["".join(rng.choice("abcxyvent_1.") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    rows = [(f"p{i % 2}", n, f"/r/p{i % 2}/{n}/1.dcm", "1.dcm", "1.dcm") for i, n in enumerate(names * 2)]
    rows += [(f"p{i % 2}", None, f"/r/p{i % 2}/{i}{f}", None, f) for i, f in enumerate(files)]
    df = spark.createDataFrame(rows, "patientID string, sub_Analysis string, path string, inner string, file_name string")
    got = {(r["patientID"], r["sub_Analysis"], r["path"]) for r in matching_files(df).collect()}
    subs = {(r[0], r[1]) for r in rows if r[1]}
    want = {
        (p, n, r[2]) for p, n in subs for r in rows
        if r[1] is None and r[0] == p and (re.search(n, r[4], re.I) if re.search(r"[\\^$.|?*+()\[\]{}]", n) else n.lower() in r[4].lower())
    }
    assert got == want and len(got) == matching_files(df).count()


def test_sizes_settle_once_over_restarts(spark, tmp_path):
    """A size is given once it was the same for the wait, by an equal observation or by the timer, over restarts."""
    source = str(tmp_path / "in")
    polls = [
        [("a", 0, 5), ("b", 0, 1), ("c", 0, 9), (None, 0, 1), ("d", 0, None)],
        [("a", 1, 5), ("b", 1, 2), ("a", 1, 4)],
        [("a", 3, 5), ("b", 3, 2), ("c", 3, 10)],
        [("a", 9, 6), ("z", 30, 0)],
        [("z", 60, 0)],
    ]
    for rows in polls:
        timed = [(k, dt.datetime(2024, 1, 1, t // 60, t % 60), n) for k, t, n in rows]
        spark.createDataFrame(timed, "patientID string, modificationTime timestamp, length long").coalesce(1).write.mode("append").parquet(source)
        stream = arrivals.read_arrivals(spark, source, "patientID string, modificationTime timestamp, length long", max_files=1)
        settled = arrivals.settled_sizes(stream, quiet="2 minutes", watermark="1 minute")
        arrivals.append_results(settled, str(tmp_path / "out"), str(tmp_path / "check"), partitions=2).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    got = sorted((r["patientID"], r["length"], r["since"].minute, r["settled"].minute) for r in out)
    # z waits for a watermark that never comes; its second observation settles it.
    assert got == [("a", 5, 0, 3), ("a", 6, 9, 11), ("b", 2, 1, 3), ("c", 10, 3, 5), ("z", 0, 30, 0)]


def test_settled_sizes_keep_items_in_groups(spark, tmp_path):
    """Items of one group settle each on its own, by observations, timers and after changes, with one state row per group."""
    source, items = str(tmp_path / "in"), 300
    for minute in (0, 2, 5, 9, 30):
        # Item i changes at minute 5 if i % 3 == 1, is last seen at 2 if i % 3 == 2, and first seen at 9 if i % 3 == 0 and i is odd.
        seen = [(i, minute, 7 * i + (i % 3 == 1 and minute >= 5)) for i in range(items)
                if not (i % 3 == 2 and minute > 2) and not (i % 6 == 3 and minute < 9)]
        timed = [(k, dt.datetime(2024, 1, 1, 0, t), n) for k, t, n in seen]
        spark.createDataFrame(timed, "patientID long, modificationTime timestamp, length long").coalesce(1).write.mode("append").parquet(source)
        stream = arrivals.read_arrivals(spark, source, "patientID long, modificationTime timestamp, length long", max_files=1)
        settled = arrivals.settled_sizes(stream, quiet="4 minutes", watermark="1 minute", groups=8)
        query = arrivals.append_results(settled, str(tmp_path / "out"), str(tmp_path / "check"), partitions=2)
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    got = sorted((r["patientID"], r["length"], r["since"].minute, r["settled"].minute) for r in rows)
    want = []
    for i in range(items):
        if i % 3 == 1:
            want.append((i, 7 * i + 1, 5, 9))
        elif i % 3 == 2:
            want.append((i, 7 * i, 0, 4))
        elif i % 6 == 3:
            # Its next observation comes with the batch after the one that could have timed it.
            want.append((i, 7 * i, 9, 30))
        else:
            want.append((i, 7 * i, 0, 5))
    assert got == sorted(want)


def test_keys_do_not_pass_through_python(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, 1.0, 2.0), (None, 3.0, None), (5, 4.0, 1.0)], "k long, f double, g double")
    out = predict(df.coalesce(1), LinearScorer(["f", "g"], [2.0, 1.0], 1.0), keys=["k"])
    assert {(r["k"], r["predictions"]) for r in out.collect()} == {(big, 5.0), (None, None), (5, 10.0)}
    assert out.columns == ["k", "predictions"] and "ArrowEvalPython" in out._jdf.queryExecution().toString()
    assert predict(df.filter("f > 9"), LinearScorer(["g", "f"], [2.0, 1.0]), keys=["k", "f"]).count() == 0


def test_a_pool_read_once_is_not_persisted(spark, training, tmp_path):
    train, batch = training
    keys = {"keys": ["patientID", "sub_Analysis"]}
    normalize = Step("normalize", {"method": "minmax", "features": ["f", "g"]})
    bundle, _ = Pipeline([Step("harmonize", {"batch": batch, "ref_batch": "x"}), normalize], keys).fit(train)
    score = Step("predict", {"model": LinearScorer(["f", "g"], [2.0, 1.0])})
    assert bundle.reads_once([score]) and bundle.reads_once([Step("dedupe", {})])
    assert not bundle.reads_once([Step("predict", {}, source="input")])
    plain, _ = Pipeline([normalize], keys).fit(train)
    assert plain.reads_once([score]) and not plain.reads_once([Step("match_histogram", {})])

    seen, transform = [], bundle.transform

    def watched(pool, *args):
        seen.append(pool.storageLevel.useMemory)
        return transform(pool, *args)

    bundle.transform = watched
    source = str(tmp_path / "in")
    train.coalesce(1).write.parquet(source)
    overrides = {"harmonize": {"batch": batch}}
    for i, given in enumerate([overrides, lambda pool: overrides]):
        arriving = arrivals.read_arrivals(spark, source, train.schema)
        where = str(tmp_path / f"out{i}")
        arrivals.score_stream(arriving, bundle, f"{where}/o", f"{where}/c", overrides=given, then=[score]).awaitTermination()
    assert seen == [False, True]


def test_fitting_a_chain_writes_the_samples_once(spark, training, monkeypatch):
    written = []
    real = combat_module.materialize
    for module in (combat_module, pipeline_module):
        monkeypatch.setattr(module, "materialize", lambda df, label="table": (written.append((label, df.columns)), real(df, label))[1])
    train, batch = training
    steps = [Step("harmonize", {"batch": batch, "ref_batch": "x"}), Step("normalize", {"method": "minmax", "features": ["f", "g"]})]
    _, out = Pipeline(steps, {"keys": ["patientID", "sub_Analysis"]}).fit(train)
    assert out.count() == train.count()
    assert [label for label, columns in written if "patientID" in columns] == ["prepared"]
