"""Metadata files to manifest, flattened tables, validation and exports."""

import os
import json
import struct
import subprocess
import sys
import time
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wayframe import schemas
from wayframe.functions import pixels
from wayframe.operators import fingerprint, flatten, manifest, training, validate
from wayframe.sources import tables


def _metadata(root, missing=False):
    version = root / "v1"
    version.mkdir()
    scenes, samples, data = [], [], []
    for s in ("a", "b"):
        scenes.append({"token": f"sc-{s}", "name": f"scene-{s}", "description": "Night", "x": 1})
        samples.append({"token": f"sa-{s}", "scene_token": f"sc-{s}"})
        for kind, key, folder in (
            ("cam", True, "samples/CAM_FRONT"), ("sweep", False, "sweeps/CAM_FRONT"),
            ("radar", True, "samples/RADAR_FRONT"),
        ):
            name = f"{folder}/{s}.jpg"
            data.append({"token": f"{kind}-{s}", "sample_token": f"sa-{s}", "filename": name,
                         "is_key_frame": key})
            if kind != "radar" and not (missing and kind == "cam" and s == "b"):
                (root / folder).mkdir(parents=True, exist_ok=True)
                (root / name).write_bytes(b"")
    for name, content in (("scene", scenes), ("sample", samples), ("sample_data", data)):
        (version / f"{name}.json").write_text(json.dumps(content))


def _manifest(spark, root):
    read = {n: tables.read_metadata(spark, str(root), "v1", n)
            for n in ("sample_data", "sample", "scene")}
    folders = read["sample_data"].select(
        F.regexp_extract("filename", "^(.*)/[^/]*$", 1).alias("directory"))
    listing = tables.list_files(folders, str(root), batch=1)
    return manifest.build_manifest(read["sample_data"], read["sample"], read["scene"], listing)


@pytest.mark.parametrize("missing", [False, True])
def test_manifest_from_files(spark, tmp_path, missing):
    _metadata(tmp_path, missing)
    built = _manifest(spark, tmp_path)
    assert built.schema.fieldNames() == schemas.AVAILABILITY.fieldNames()
    assert built.count() == 6
    counts = {(r.channel, r.is_key_frame): (r.n_referenced, r.n_present)
              for r in manifest.summarize(built).collect()}
    assert counts[("RADAR_FRONT", True)] == (2, 0)
    assert counts[("CAM_FRONT", False)] == (2, 2)
    assert manifest.keyframe_gate(built).first().complete is (not missing)
    assert manifest.keyframe_gate(built, "sonar").first().complete is True
    one = built.filter("sample_data_token = 'cam-a'").first()
    assert (one.modality, one.scene_token, one.scene_name) == ("cam", "sc-a", "scene-a")


def test_manifest_defaults_unknown_scenes(spark):
    data = spark.createDataFrame([("t", "lost", "a/B_C/x", True)],
                                 "token string, sample_token string, filename string, "
                                 "is_key_frame boolean")
    empty = {n: spark.createDataFrame([], schemas.METADATA[n]) for n in ("sample", "scene")}
    listing = spark.createDataFrame([("a/B_C/x",)] * 3, "filename string")
    row = manifest.build_manifest(data, empty["sample"], empty["scene"], listing).collect()
    assert [(r.scene_token, r.scene_name, r.present) for r in row] == [("", "", True)]


def test_flatten_counts_kept_boxes(spark):
    scene = spark.createDataFrame([("s1", "scene-1", "Rainy NIGHT", "l1")], schemas.SCENE)
    log = spark.createDataFrame([("l1", "harbor")], schemas.LOG)
    sample = spark.createDataFrame([("p1", "s1", 7), ("p2", "s1", 8)], schemas.SAMPLE)
    data = spark.createDataFrame(
        [(f"d{i}", f"p{i}", f"samples/CAM_FRONT/{i}.jpg", 1600, 900, 5, True) for i in (1, 2)]
        + [("d3", "p1", "sweeps/CAM_FRONT/3.jpg", 1600, 900, 5, False),
           ("d4", "p1", "samples/RADAR/4.bin", 1600, 900, 5, True)],
        "token string, sample_token string, filename string, width long, height long, "
        "timestamp long, is_key_frame boolean")
    boxes = spark.createDataFrame(
        [("a1", "d1", "vehicle.car", "1", 0.0, 10.0), ("a2", "d1", "animal", "4", 0.0, 5.0),
         ("a3", "d1", "vehicle.car", "x", 0.0, 10.0), ("a4", "d1", "vehicle.car", "4", 0.0, 4.9),
         ("a5", "d1", "vehicle.car", "4", None, None)],
        "annotation_token string, sample_data_token string, category_name string, "
        "visibility_token string, x_min double, x_max double")
    boxes = boxes.withColumns({"y_min": F.col("x_min"), "y_max": F.lit(10.0),
                               "num_lidar_pts": F.lit(1), "num_radar_pts": F.lit(0)})
    samples, annotations = flatten.flatten(scene, log, sample, data, boxes, min_area=50.0)
    got = {r.sample_data_token: r for r in samples.collect()}
    assert {t: r.n_boxes for t, r in got.items()} == {"d1": 2, "d2": 0}
    assert (got["d1"].is_night, got["d1"].is_rain, got["d1"].location) == (True, True, "harbor")
    kept = {r.annotation_token: r.category_group for r in annotations.collect()}
    assert kept == {"a1": "car", "a2": None}  # an area equal to the floor is kept
    assert samples.schema.fieldNames() == schemas.SAMPLES.fieldNames()
    assert annotations.schema.fieldNames() == schemas.ANNOTATIONS.fieldNames()
    none, _ = flatten.flatten(scene, log, sample, data, boxes, limit_scenes=0)
    assert none.count() == 0


def test_annotations_reach_every_camera_of_their_sample(spark):
    unit = [1.0, 0.0, 0.0, 0.0]
    annotation = spark.createDataFrame(
        [("a", "p", "i", "4", [0.0, 0.0, 12.0], [2.0, 2.0, 2.0], unit, 3, 1)],
        schemas.SAMPLE_ANNOTATION)
    instance = spark.createDataFrame([("i", "c")], schemas.INSTANCE)
    category = spark.createDataFrame([("c", "vehicle.car")], schemas.CATEGORY)
    data = spark.createDataFrame(
        [(f"d{k}", "p", "e", f"cs{k}", f"samples/CAM_{k}/x.jpg", 1600, 900, 1, True)
         for k in ("FRONT", "BACK")], schemas.SAMPLE_DATA)
    ego = spark.createDataFrame([("e", [0.0, 0.0, 2.0], unit)], schemas.EGO_POSE)
    k = [[1000.0, 0.0, 800.0], [0.0, 1000.0, 450.0], [0.0, 0.0, 1.0]]
    sensors = spark.createDataFrame(
        [("csFRONT", "s", [0.0, 0.0, 0.0], unit, k),
         ("csBACK", "s", [0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], k)], schemas.CALIBRATED_SENSOR)
    boxes = flatten.camera_boxes(annotation, instance, category, data, ego, sensors)
    got = {r.sample_data_token: r for r in flatten.image_boxes(boxes).collect()}
    assert got["dFRONT"].x_min == pytest.approx(688.889, abs=1e-3)
    assert got["dFRONT"].category_name == "vehicle.car"
    assert got["dBACK"].x_min is None


# --- validation -----------------------------------------------------------------------


def _tables(spark):
    cameras = ["CAM_FRONT", "CAM_FRONT_LEFT", "CAM_FRONT_RIGHT", "CAM_BACK", "CAM_BACK_LEFT",
               "CAM_BACK_RIGHT"]
    images = [(f"d{i}-{c}", f"p{i}", c, f"{c}/{i}.jpg", 1600, 900, 1, "s1")
              for i in range(15) for c in cameras]
    samples = spark.createDataFrame(images, "sample_data_token string, sample_token string, "
                                    "channel string, filename string, width long, height long, "
                                    "n_boxes long, scene_token string")
    annotations = spark.createDataFrame(
        [("a1", "d0", "CAM_FRONT", "vehicle.car", "car", "4", 0.0, 0.0, 1600.0, 900.0, 10.0),
         ("a2", "d0", "CAM_FRONT", "animal", None, "1", 1.0, 1.0, 2.0, 2.0, 1.0)],
        "annotation_token string, sample_data_token string, channel string, category_name string, "
        "category_group string, visibility_token string, x_min double, y_min double, "
        "x_max double, y_max double, bbox_area double")
    return samples, annotations


def _failed(df):
    return {(r["table"], r["rule"], r["column"]): r.violations
            for r in df.filter(~F.col("passed")).collect()}


def test_clean_tables_pass(spark):
    assert validate.overall(validate.validate(*_tables(spark))).first() == (True, 0)


def test_each_broken_rule_is_named(spark):
    samples, annotations = _tables(spark)
    far = annotations.withColumn("x_max", F.lit(9999.0))
    assert _failed(validate.validate(samples, far)) == {("annotations", "between", "x_max"): 2}
    odd = annotations.withColumn("category_name", F.lit("not.a.real.category"))
    assert _failed(validate.validate(samples, odd)) == {
        ("annotations", "in_set", "category_name"): 2}
    flat = annotations.withColumns({"x_max": F.col("x_min"), "bbox_area": F.lit(0.0)})
    assert set(_failed(validate.check(flat, validate.annotation_rules(), "annotations"))) == {
        ("annotations", "positive", "bbox_area"), ("annotations", "greater", "x_max,x_min")}
    short = samples.filter("sample_token <> 'p3'")
    assert _failed(validate.validate(short, annotations)) == {
        ("samples", "images_per_scene", "scene_token"): 1}
    twice = samples.union(samples.filter("sample_data_token = 'd0-CAM_FRONT'"))
    assert _failed(validate.validate(twice, annotations)) == {
        ("samples", "unique", "sample_data_token"): 2}
    gone = _failed(validate.check(samples.drop("width"), validate.sample_rules(), "samples"))
    assert gone == {("samples", "column_exists", "width"): None, ("samples", "equals", "width"): None}
    nulls = annotations.withColumn("x_min", F.lit(None).cast("double"))
    assert _failed(validate.check(nulls, validate.annotation_rules(), "t")) == {
        ("t", "not_null", "x_min"): 2}


# --- training export ------------------------------------------------------------------


def _export(spark):
    samples = spark.createDataFrame(
        [("d1", "s1", "CAM_FRONT", "x/d1.jpg", "Night"), ("d2", "s2", "CAM_BACK", "x/d2.jpg", "rain"),
         ("d3", "s3", "CAM_FRONT", "x/d3.jpg", ""), ("d4", "s1", "CAM_FRONT", "x/d4.jpg", "Night")],
        "sample_data_token string, scene_name string, channel string, filename string, "
        "scene_description string")
    splits = spark.createDataFrame([("s1", "train"), ("s2", "val")], "scene_name string, split string")
    annotations = spark.createDataFrame(
        [("b", "d1", "car", 100.0, 200.0, 300.0, 400.0), ("a", "d1", "bus", 0.0, 0.0, 1600.0, 900.0),
         ("c", "d1", None, 0.0, 0.0, 1.0, 1.0)],
        "annotation_token string, sample_data_token string, category_group string, "
        "x_min double, y_min double, x_max double, y_max double")
    return samples, splits, annotations


def test_export_keeps_empty_images_and_never_filters_val(spark):
    samples, splits, annotations = _export(spark)
    frames = training.export_frames(samples, splits)
    labels = training.label_table(frames, annotations)
    texts = {r.stem: r.label_text for r in labels.collect()}
    assert texts == {"d1": "2 0.5 0.5 1.0 1.0\n0 0.125 0.333333 0.125 0.222222", "d2": "", "d4": ""}
    assert training.export_stats(labels).first() == (2, 1, 2)
    listed = spark.createDataFrame([("d4",)], "sample_data_token string")
    some = training.export_frames(samples, splits, train_frames=listed)
    assert rows(some.select("sample_data_token", "split")) == [("d2", "val"), ("d4", "train")]
    none = training.train_filter(frames, listed.limit(0))
    assert rows(none.select("sample_data_token")) == [("d2",)]
    assert training.export_frames(samples, splits, cameras=["CAM_BACK"]).count() == 1
    assert training.export_frames(samples, splits, limit_scenes=1).count() == 2
    assert rows(training.slice_images(frames)) == [
        ("time_of_day", "day", "x/d2.jpg"), ("weather", "rain", "x/d2.jpg")]


def test_exports_are_written_partitioned(spark, tmp_path):
    samples, splits, annotations = _export(spark)
    frames = training.export_frames(samples, splits)
    tables.write_label_files(training.label_table(frames, annotations), str(tmp_path / "l"))
    assert {p.name for p in (tmp_path / "l").glob("split=*")} == {"split=train", "split=val"}
    tables.write_slice_lists(training.slice_images(frames), str(tmp_path / "s"))
    assert not (tmp_path / "s" / "dim=weather" / "slice=clear").exists()
    assert spark.read.text(str(tmp_path / "s")).count() == 2


def test_fingerprint_ignores_order_and_sees_content(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "i int, s string")
    def print_of(df):
        return fingerprint.fingerprint(df).first()["fingerprint"]
    assert print_of(a) == print_of(a.repartition(3).orderBy("s"))
    assert print_of(a) != print_of(a.dropDuplicates())
    assert print_of(a) != print_of(a.fillna("", "s"))
    assert print_of(a.limit(0)) == print_of(a.filter("false"))
    assert len(print_of(a)) == 16


def test_unchanged_builds_are_skipped(spark, tmp_path):
    a = spark.range(5).withColumnRenamed("id", "sample_data_token")
    built = []

    def build(path):
        built.append(path)
        a.write.mode("overwrite").parquet(path)
        return {"n": 5}

    key = fingerprint.build_key({"t": a}, {"cameras": None})
    path = str(tmp_path / "out")
    assert fingerprint.build_if_changed(spark, key, path, build) == ({"n": 5}, False)
    assert fingerprint.build_if_changed(spark, key, path, build) == ({"n": 5}, True)
    assert fingerprint.build_if_changed(spark, key, path, build, force=True)[1] is False
    other = fingerprint.build_key({"t": a}, {"cameras": None}, train_frames=a.limit(2))
    assert fingerprint.build_if_changed(spark, other, path, build)[1] is False
    assert len(built) == 3


# --- sources --------------------------------------------------------------------------


def _png(width, height, rgb):
    def chunk(tag, data):
        body = tag + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))
    lines = (b"\0" + bytes(rgb) * width) * height
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines))
            + chunk(b"IEND", b""))


def test_images_decode_and_bad_ones_are_null(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(_png(4, 2, (200, 200, 200)))
    (tmp_path / "b.png").write_bytes(_png(1, 1, (0, 0, 255)))
    (tmp_path / "c.png").write_bytes(b"junk")
    images = tables.read_images(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[-1]: (r.height, r.width, r.b) for r in images.select(
        "path", "height", "width",
        pixels.brightness("height", "width", "n_channels", "data").alias("b")).collect()}
    assert got == {"a.png": (2, 4, 200.0), "b.png": (1, 1, 29.0), "c.png": (None, None, None)}


def test_write_returns_the_row_count(spark, tmp_path):
    assert tables.write_table(spark.range(7), str(tmp_path / "new" / "t")) == 7
    assert tables.read_columns(spark, str(tmp_path / "new" / "t"), "id").count() == 7


def test_feature_tables_from_parquet_and_capture_log(spark, tmp_path):
    log = tmp_path / "log.jsonl"
    log.write_text(json.dumps({"ts": "2026-01-01T00:00:00+00:00", "image_width": 10,
                               "image_height": 20, "n_detections": 3, "brightness": 1.5}) + "\n")
    row = tables.read_features(spark, str(log)).first()
    assert (row.width, row.height, row.n_boxes, row.brightness) == (10, 20, 3, 1.5)
    spark.range(2).write.parquet(str(tmp_path / "f.parquet"))
    assert tables.read_features(spark, str(tmp_path / "f.parquet")).count() == 2


def test_query_over_registered_views(spark, tmp_path):
    df = spark.createDataFrame([("CAM_FRONT", True)], "channel string, present boolean")
    df.write.parquet(str(tmp_path / "availability.parquet"))
    out = tables.query(spark, "SELECT channel, sum(present::int) AS n FROM availability GROUP BY 1",
                       str(tmp_path))
    assert rows(out) == [("CAM_FRONT", 1)]


def test_a_scope_leaves_no_scratch_behind(spark, tmp_path):
    from wayframe.sources import scratch

    root = scratch.scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    with scratch.scope(spark):
        kept = scratch.settle(spark.range(5), "numbers")
        assert set(os.listdir(root)) > before
        kept.write.parquet(str(tmp_path / "out"))
    assert set(os.listdir(root)) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_scratch_without_a_shared_folder(tmp_path):
    # A session of its own, without the machine's defaults.
    code = """
from wayframe.plans.session import local_session
from wayframe.sources import scratch
spark = local_session(1)
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert scratch.settle(spark.range(3)).count() == 3
assert scratch.scratch_root(spark) == scratch.scratch_root(spark)
"""
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def _unpng(raw):
    width, height, _, kind = struct.unpack(">IIBB", raw[16:26])
    channels = {0: 1, 2: 3, 6: 4}[kind]
    size = struct.unpack(">I", raw[33:37])[0]
    lines = np.frombuffer(zlib.decompress(raw[41: 41 + size]), np.uint8).reshape(height, -1)
    assert (lines[:, 0] == 0).all()
    return lines[:, 1:].reshape(height, width, channels)


def test_thumbnails_are_bounded_means(spark, tmp_path):
    rng = np.random.default_rng(4)
    image = rng.integers(0, 256, (9, 14, 3)).astype(np.uint8)
    small = pixels.shrunk(image, 5)
    assert small.shape == (3, 5, 3) and pixels.shrunk(image, 14) is image
    block = image[3:6, 14 * 2 // 5: 14 * 3 // 5].reshape(-1, 3).astype(int)
    assert small[1, 2].tolist() == [(2 * t + len(block)) // (2 * len(block)) for t in block.sum(axis=0).tolist()]
    assert pixels.shrunk(image[:, :1], 2).shape == (2, 1, 3)
    assert (_unpng(pixels.png(image)) == image[:, :, ::-1]).all()
    assert (_unpng(pixels.png(image[:, :, :1])) == image[:, :, :1]).all()
    (tmp_path / "a.png").write_bytes(pixels.png(image))
    (tmp_path / "c.png").write_bytes(b"junk")
    read = tables.read_images(spark, str(tmp_path)).withColumn("thumb", pixels.thumbnail("height", "width", "n_channels", "data", 5))
    got = {r.path.rsplit("/", 1)[-1]: r.thumb for r in read.collect()}
    assert got["c.png"] is None and (_unpng(got["a.png"]) == small[:, :, ::-1]).all()


def test_listing_takes_each_folder_alone(spark, tmp_path):
    for name in ("a/x.jpg", "a/k=1/y.jpg", "a/deep/z.jpg", "b/w w+%41.jpg", "top.jpg"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"")
    folders = spark.createDataFrame([("a",), ("a/k=1",), ("b",), ("none",), ("a",), ("",)], "directory string")
    for batch in (1, 100):
        assert rows(tables.list_files(folders, str(tmp_path), batch)) == [("a/k=1/y.jpg",), ("a/x.jpg",), ("b/w w+%41.jpg",), ("top.jpg",)]
    assert tables.list_files(folders.limit(0), str(tmp_path)).count() == 0


def test_listing_takes_tasks_for_cores_not_for_folders(spark, tmp_path, monkeypatch):
    odd = ["a,b", "{c}", "[d]", "e*", "f?", "g^h", "i\\j", "k l", "m%6e", "o+p"]
    names = [*odd, *(f"x/{i}" for i in range(70))]
    for name in names:
        (tmp_path / "in {1,2}" / name).mkdir(parents=True)
        (tmp_path / "in {1,2}" / name / "f.jpg").write_bytes(b"")
    (tmp_path / "in {1,2}" / "gh").mkdir()  # only named by a pattern
    (tmp_path / "in {1,2}" / "gh" / "f.jpg").write_bytes(b"")
    folders = spark.createDataFrame([(n,) for n in [*names, "../in {1,2}/x/1", "x//2", "none"]], "directory string")
    tracker = spark.sparkContext.statusTracker()
    before = {*tracker.getJobIdsForGroup(None)}
    root = str(tmp_path / "in {1,2}")
    assert rows(tables.list_files(folders, root)) == sorted((f"{n}/f.jpg",) for n in names)
    time.sleep(1)
    jobs = [tracker.getJobInfo(j) for j in {*tracker.getJobIdsForGroup(None)} - before]
    stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
    assert stages and max(s.numTasks for s in stages if s) <= 2 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(tables, "LISTED", 3)
    assert rows(tables.list_files(folders, root, batch=4)) == sorted((f"{n}/f.jpg",) for n in names)


def test_tasks_write_the_image_files_of_the_text_sink(spark, tmp_path, monkeypatch):
    from wayframe.plans import images

    spark.range(250).select(F.col("id").alias("s_suppkey")).write.parquet(str(tmp_path / "supplier.parquet"))

    def written():
        units, root = images._written(spark, str(tmp_path))
        place = Path(root.removeprefix("file:"))
        files = {str(f.parent.relative_to(place)): f.read_bytes() for f in place.rglob("*") if f.is_file() and f.parent != place and f.suffix != ".crc"}
        return files, units, images._decoded(spark, root)

    by_tasks, units, decoded = written()
    folders = units.filter("NOT absent").select(images._folder())
    assert {(f,) for f in by_tasks} == {*rows(folders)} and len(by_tasks) == 214
    with images.settings(spark, images.SMALL_FILES):
        assert decoded.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism + 1  # 7 with a file for 4 MB
    assert decoded.filter("height IS NULL").count() == sum(b == b"not an image\n" for b in by_tasks.values()) == 24
    monkeypatch.setattr(images, "_mounted", lambda spark, root: None)
    assert written()[0] == by_tasks


def test_json_files_grow_in_number_not_in_rows(spark, tmp_path):
    from wayframe.plans import files

    table = spark.range(600_000).select(F.md5(F.col("id").cast("string")).alias("token"))
    files._json_arrays(table, str(tmp_path / "rows.json"))
    read = spark.read.schema("token string").option("multiLine", True).json(str(tmp_path / "rows.json"))
    sizes = [r[1] for r in read.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 600_000 == read.distinct().count() and max(sizes) < 60_000
