"""Drift, latency and the streams."""

import json
import statistics
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wayframe import schemas
from wayframe.operators import drift, validate
from wayframe.operators.latency import latency_summary
from wayframe.streaming import capture as streams


def _features(spark, n, bright, boxes, seed):
    rng = np.random.default_rng(seed)
    data = [(float(rng.normal(*bright)), 1600, 900, int(rng.poisson(boxes))) for _ in range(n)]
    return spark.createDataFrame(data, "brightness double, width long, height long, n_boxes long")


@pytest.mark.parametrize("n", [300, 1200])
def test_shifted_features_drift_and_equal_ones_do_not(spark, n):
    day = _features(spark, n, (110, 20), 12, 0)
    night = _features(spark, n, (40, 15), 5, 1)
    same = _features(spark, n, (110, 20), 12, 2)
    constants = {"categorical": ("width", "height")}
    shifted = {r["column"]: r for r in drift.column_drift(day, night, **constants).collect()}
    assert {r.method for r in shifted.values()} == {"wasserstein", "jensen_shannon"}
    p = {r["column"]: r for r in drift.column_drift(day, night, method="p_value", **constants).collect()}
    assert {c: r.drift_detected for c, r in p.items()} == {c: r.drift_detected for c, r in shifted.items()}
    assert {r.method for r in p.values()} == {"ks", "chi_square"}
    assert shifted["brightness"].drift_detected and shifted["n_boxes"].drift_detected
    assert not shifted["width"].drift_detected and not shifted["height"].drift_detected
    verdict = drift.dataset_verdict(drift.column_drift(day, night)).first()
    assert tuple(verdict) == (4, 2, 0.5, True)
    alike = drift.column_drift(day, same, method="p_value", **constants)
    assert not drift.dataset_verdict(alike).first().dataset_drift
    identical = drift.column_drift(day, day)
    assert identical.filter("drift_detected").isEmpty()


def test_columns_without_values_are_dropped(spark):
    day = _features(spark, 50, (110, 20), 12, 0)
    blank = day.withColumn("brightness", F.lit(float("nan")))
    got = [r["column"] for r in drift.column_drift(blank, day).collect()]
    assert sorted(got) == ["height", "n_boxes", "width"]
    with pytest.raises(ValueError):
        drift.column_drift(blank.select("brightness"), day)
    with pytest.raises(ValueError):
        drift.column_drift(day.select("width"), day.select("height"))


def test_statistics_against_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(0, 1, 400).round(1), rng.normal(0.4, 1.2, 300).round(1)
    frames = [spark.createDataFrame([(float(x),) for x in v], "brightness double") for v in (a, b)]
    stats = drift.column_statistics(drift.value_counts(*frames, ["brightness"])).first()
    grid = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert stats.ks == pytest.approx(np.abs(fa - fb).max())
    area = (np.abs(fa - fb)[:-1] * np.diff(grid)).sum()
    assert stats.wasserstein == pytest.approx(area / a.std())
    p = np.array([(a == g).mean() for g in grid])
    q = np.array([(b == g).mean() for g in grid])
    m = (p + q) / 2
    js = sum((x[x > 0] * np.log(x[x > 0] / m[x > 0])).sum() for x in (p, q)) / 2
    assert stats.jensen_shannon == pytest.approx(js**0.5)


def test_chi_square_tail_and_ks_series(spark):
    # Upper 5% points of the chi-square distribution.
    points = {1: 3.841459, 2: 5.991465, 3: 7.814728, 4: 9.487729, 5: 11.070498}
    df = spark.createDataFrame([(float(x), k) for k, x in points.items()], "x double, k int")
    got = [r[0] for r in df.select(drift.chi_square_p_value("x", "k")).collect()]
    assert got == pytest.approx([0.05] * 5, abs=1e-6)
    one = spark.range(1).select(
        drift.ks_p_value(F.lit(1.3581 / 10), F.lit(200), F.lit(200)),
        drift.ks_p_value(F.lit(0.0), F.lit(200), F.lit(200)),
        drift.ks_p_value(F.lit(1.0), F.lit(200), F.lit(200)),
    ).first()
    assert tuple(one) == pytest.approx((0.05, 1, 0), abs=1e-3)


def test_low_cardinality_columns(spark):
    def kinds(shares, n):
        return spark.createDataFrame(
            [(float(k),) for k, s in enumerate(shares) for _ in range(int(s * n))], "width double")
    even, skewed = kinds([.5, .3, .2], 400), kinds([.2, .3, .5], 400)
    kind = {"categorical": ("width",)}
    row = drift.column_drift(even, skewed, method="p_value", **kind).first()
    assert row.method == "chi_square" and row.drift_detected
    assert not drift.column_drift(even, kinds([.5, .3, .2], 200), **kind).first().drift_detected
    big = drift.column_drift(kinds([.5, .3, .2], 4000), kinds([.2, .3, .5], 4000), **kind).first()
    assert big.method == "jensen_shannon" and big.drift_detected
    unseen = drift.column_drift(even, kinds([.4, .3, .2, .1], 400), method="p_value", **kind).first()
    assert unseen.score == 0 and unseen.drift_detected


def test_feature_table(spark):
    samples = spark.createDataFrame(
        [(f"d{i}", "CAM_FRONT", i >= 3, f"{i}.jpg", 1600, 900, 2 if i >= 3 else 12) for i in range(5)],
        "sample_data_token string, channel string, is_night boolean, filename string, width long, "
        "height long, n_boxes long")
    stats = spark.createDataFrame([("0.jpg", 200.0), ("3.jpg", 20.0)],
                                  "filename string, brightness double")
    night = drift.feature_table(samples, stats, condition="night")
    assert {r.sample_data_token: r.brightness for r in night.collect()} == {"d3": 20.0, "d4": None}
    assert night.schema.fieldNames() == schemas.DRIFT_FEATURES.fieldNames()
    assert drift.feature_table(samples, condition="day").filter("brightness IS NULL").count() == 3
    assert drift.feature_table(samples, sample_images=2).count() == 2
    with pytest.raises(ValueError):
        drift.feature_table(samples, condition="dusk")


def test_exact_percentiles(spark):
    data = {"a": [5.0, 1.0, 9.0, 9.0, 2.5], "b": [7.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [("a", None)],
                               "m string, latency_ms double")
    got = {r.m: r for r in latency_summary(df, ["m"]).collect()}
    assert (got["a"].n, got["a"].p50_ms) == (5, 5.0)
    assert got["a"].p95_ms == pytest.approx(np.percentile(data["a"], 95))
    assert got["a"].mean_ms == pytest.approx(statistics.mean(data["a"]))
    assert (got["b"].p50_ms, got["b"].p95_ms) == (7.0, 7.0)
    assert latency_summary(df).first().n == 6


# --- streams --------------------------------------------------------------------------

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def _log(folder, name, records):
    folder.mkdir(exist_ok=True)
    lines = []
    for minute, bright, boxes in records:
        lines.append(json.dumps({
            "ts": (START + timedelta(minutes=minute)).isoformat(), "image_width": 1600,
            "image_height": 900, "n_detections": boxes, "brightness": bright,
            "latency_ms": bright / 2, "model_version": "m1"}))
    (folder / name).write_text("\n".join(lines) + "\n")


def test_windows_close_and_late_rows_are_dropped(spark, tmp_path):
    log, out, state = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "state")
    _log(log, "1.json", [(1, 10.0, 2), (2, 20.0, 4), (3, 30.0, 3)])
    stats = streams.window_counts(streams.read_capture(spark, str(log)), "10 minutes", "5 minutes")
    streams.run_to_table(stats, out, state)
    assert spark.read.schema(stats.schema).parquet(out).count() == 0
    _log(log, "2.json", [(30, 50.0, 1)])
    streams.run_to_table(stats, out, state)
    _log(log, "3.json", [(4, 99.0, 9), (60, 1.0, 1)])  # minute 4 is long closed
    streams.run_to_table(stats, out, state)
    got = streams.window_stats(spark.read.schema(stats.schema).parquet(out)).orderBy("window_start").collect()
    assert [(r.n, r.mean_brightness, r.mean_n_boxes, r.p95_latency_ms) for r in got] == [
        (3, 20.0, 3.0, 15.0), (1, 50.0, 1.0, 25.0)]


def test_repeated_frames_are_kept_once(spark, tmp_path):
    log, out, state = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "state")
    _log(log, "1.json", [(1, 10.0, 1), (2, 20.0, 2), (2, 20.0, 2)])
    once = streams.new_frames(streams.read_capture(spark, str(log)), "n_boxes", "ts", "1 hour")
    streams.run_to_table(once, out, state)
    _log(log, "2.json", [(5, 20.0, 2), (6, 30.0, 3)])
    streams.run_to_table(once, out, state)
    assert rows(spark.read.parquet(out).select("n_boxes")) == [(1,), (2,), (3,)]


def test_appending_is_idempotent(spark, tmp_path):
    source, store = tmp_path / "in", str(tmp_path / "store")
    schema = "sample_data_token string, x int"
    def arrive(*tokens):
        spark.createDataFrame([(t, 1) for t in tokens], schema).write.mode("append").parquet(str(source))
    arrive("a", "b", "b")
    def run(state):
        stream = spark.readStream.schema(schema).parquet(str(source))
        streams.append_missing(stream, store, str(tmp_path / state)).start().awaitTermination()
        return [r[0] for r in rows(spark.read.parquet(store).select("sample_data_token"))]
    assert run("one") == ["a", "b"]
    arrive("b", "c")
    assert run("one") == ["a", "b", "c"]
    assert run("another") == ["a", "b", "c"]  # a lost checkpoint replays everything


def test_a_batch_reads_the_buckets_it_touches(spark, tmp_path):
    store = str(tmp_path / "store")
    rows_of = spark.range(400).select(F.concat(F.lit("t"), "id").alias("sample_data_token"), "id")
    streams.write_frames(rows_of, store, buckets=16)
    batch = rows_of.filter("id IN (3, 90)").unionByName(spark.createDataFrame([("new", 1)], "sample_data_token string, id long"))
    held = streams.stored_tokens(batch, store, "sample_data_token", 16)
    touched = {r.bucket16 for r in held.select("bucket16").distinct().collect()}
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert 1 <= len(touched) <= 3 and "PartitionFilters: [isnotnull(bucket16" in plan or "bucket16#" in plan.split("PartitionFilters")[1]
    every = spark.read.parquet(store)
    own = every.filter(F.col("bucket16").isin(list(touched)))
    assert {r.f for r in held.select(F.input_file_name().alias("f")).distinct().collect()} == {
        r.f for r in own.select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(every.inputFiles()) == 16
    with pytest.raises(ValueError, match="buckets"):
        streams.stored_tokens(batch, store, "sample_data_token", 32)
    assert streams.read_frames(spark, store).columns == ["sample_data_token", "id"]
    assert streams.stored_tokens(batch, str(tmp_path / "none"), "sample_data_token", 16) is None


def test_windows_without_a_model_or_a_latency(spark):
    counts = spark.createDataFrame(
        [("w", None, None, 2, 1, 4.0, 0, None), ("w", None, 5.0, 1, 0, None, 1, 3), ("w", "m", None, 1, 0, None, 0, None)],
        "window_start string, model_version string, latency_ms double, n long, n_brightness long, sum_brightness double, n_counted long, sum_boxes long")
    assert rows(streams.window_stats(counts)) == [("w", "m", 1, None, None, None), ("w", None, 3, 4.0, 3.0, 5.0)]


def test_a_window_is_judged_over_all_its_batches(spark, tmp_path):
    log, out, state = tmp_path / "log", tmp_path / "out", str(tmp_path / "state")
    reference = spark.createDataFrame([(float(100 + i % 10), i % 7) for i in range(200)],
                                      "brightness double, n_boxes long")
    def run():
        job = streams.drift_per_window(
            streams.read_capture(spark, str(log)), reference, str(out), state,
            ("brightness", "n_boxes"), "1 hour")
        job.start().awaitTermination()
        found = streams.latest_verdicts(spark, str(out)).orderBy("window_start").collect()
        return [r.n_drifted for r in found]
    _log(log, "1.json", [(i % 59, 100.0 + i % 10, i % 7) for i in range(60)])
    assert run() == [0]
    # The first hour turns dark later on; the second hour is like the reference.
    _log(log, "2.json", [(i % 59, 20.0, i % 7) for i in range(300)]
         + [(60 + i % 59, 100.0 + i % 10, i % 7) for i in range(60)])
    assert run() == [1, 0]


def test_violations_are_observed_per_batch(spark, tmp_path):
    log = tmp_path / "log"
    _log(log, "1.json", [(1, 10.0, -1), (2, -5.0, 3), (3, 300.0, 3)])
    rules = [*validate.column_exists("ts"), validate.between("brightness", 0, 255),
             validate.at_least("n_boxes", 0)]
    watched = streams.count_violations(streams.read_capture(spark, str(log)), rules)
    done = streams.run_to_table(watched, str(tmp_path / "o"), str(tmp_path / "s"))
    seen = [p.observedMetrics["rules"] for p in done.recentProgress if p.observedMetrics]
    assert [tuple(s) for s in seen] == [(3, 2, 1)]


def test_a_wide_window_has_an_exact_percentile(spark, tmp_path):
    n = 100_000
    capture = spark.range(n).selectExpr(
        "timestamp_seconds(1700000000 + id % 60) AS ts", "'m' AS model_version", "1.0 AS brightness", "1L AS n_boxes",
        f"double((id * 7919) % {n}) AS latency_ms")
    capture.union(capture.limit(1).withColumn("ts", F.expr("ts + INTERVAL 2 DAYS"))).coalesce(1).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(capture.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    streams.run_to_table(streams.window_counts(stream, "1 hour"), str(tmp_path / "out"), str(tmp_path / "state"))
    rows = streams.window_stats(spark.read.parquet(str(tmp_path / "out"))).collect()
    assert [r.n for r in rows][:1] == [n]
    assert rows[0].p95_latency_ms == 0.95 * n - 1
