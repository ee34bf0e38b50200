"""Label results: parsing, retries, batches, cost, and label evaluation."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wayframe.functions import labels
from wayframe.functions.labels import with_status
from wayframe.functions.taxonomy import COUNT_FIELDS
from wayframe.operators import evaluate, labelling
from wayframe.sources.tables import read_label_results

RAW = "custom_id string, result_type string, stop_reason string, text string, error_type string"


def _document(**changes):
    document = {
        "time_of_day": "night", "weather": "rain",
        "object_counts": {f: i for i, f in enumerate(COUNT_FIELDS)},
        "hazards": ["wet road"], "notable_conditions": [], "label_confidence": "high",
    }
    return {**document, **changes}


def _counts(**changes):
    return _document(object_counts={**_document()["object_counts"], **changes})


def _status(spark, texts):
    raw = spark.createDataFrame([(str(i), "succeeded", "end_turn", t, None)
                                 for i, t in enumerate(texts)], RAW)
    found = {r.custom_id: r for r in with_status(raw).collect()}
    return [found[str(i)] for i in range(len(texts))]


def test_status_matrix(spark):
    good = json.dumps(_document())
    cases = [
        ("succeeded", "end_turn", good, None, "ok"),
        ("succeeded", "refusal", good, None, "refusal"),
        ("succeeded", "max_tokens", good, None, "truncated"),
        ("succeeded", "end_turn", "not json", None, "invalid_json"),
        ("succeeded", "end_turn", "", None, "invalid_json"),
        ("succeeded", "end_turn", None, None, "invalid_json"),
        ("succeeded", "end_turn", '{"nope": 1}', None, "schema_invalid"),
        ("errored", None, None, "invalid_request", "errored_bad_request"),
        ("errored", None, None, "api_error", "errored_server"),
        ("expired", None, None, None, "expired"),
        ("canceled", None, None, None, "canceled"),
    ]
    raw = spark.createDataFrame([(str(i), *c[:4]) for i, c in enumerate(cases)], RAW)
    got = {r.custom_id: r.parse_status for r in with_status(raw).collect()}
    assert [got[str(i)] for i in range(len(cases))] == [c[4] for c in cases]


def test_documents_are_validated_strictly(spark):
    def without(key):
        return {k: v for k, v in _document().items() if k != key}
    bad = [
        _counts(cars=-1), _counts(cars=2.5), _counts(cars=None), _counts(cars="two"),
        _counts(cars="true"), _counts(cars=[1]), _counts(extra=1), _document(extra=1),
        without("hazards"), without("object_counts"), _document(object_counts={}),
        _document(weather="snow"), _document(weather=None), _document(time_of_day=1),
        _document(label_confidence="HIGH"), _document(hazards="x"), _document(hazards=[1]),
        _document(hazards=["a", None]), _document(hazards=None), _document(hazards=["a", 1]),
        [_document()], "text", 5,
    ]
    got = _status(spark, [json.dumps(b) for b in bad])
    assert [(b, r.parse_status) for b, r in zip(bad, got) if r.parse_status != "schema_invalid"] == []
    assert all(r.label is None for r in got)


def test_whole_numbers_in_other_spellings_are_counts(spark):
    spelled = {"cars": "3", "trucks": 2.0, "buses": True, "trailers": " 4 ", "barriers": "5.0",
               "bicycles": False}
    row, empty = _status(spark, [json.dumps(_counts(**spelled)), json.dumps(_document(hazards=[]))])
    counts = row.label.object_counts
    assert row.parse_status == empty.parse_status == "ok"
    assert (counts.cars, counts.trucks, counts.buses, counts.trailers, counts.barriers,
            counts.bicycles, counts.pedestrians) == (3, 2, 1, 4, 5, 0, 7)
    assert empty.label.hazards == []


def test_results_are_collected_from_files_in_order(spark, tmp_path):
    def line(token, **changes):
        record = {"custom_id": token, "result_type": "succeeded", "stop_reason": "end_turn",
                  "text": json.dumps(_document(**changes)), "error_type": None}
        return json.dumps(record)
    (tmp_path / "b1.jsonl").write_text(
        line("t1", weather="fog") + "\n" + line("t2") + "\n" + line("t2", weather="clear") + "\n")
    (tmp_path / "b2.jsonl").write_text(line("t1", weather="snow") + "\n")
    (tmp_path / "z9.jsonl").write_text(line("t1") + "\n")
    batches = spark.createDataFrame([("b1", "m"), ("b2", "m")], "batch_id string, model string")
    raw = read_label_results(spark, str(tmp_path), batches)
    assert raw.count() == 5
    labels = labelling.collect_labels(raw)
    got = {(r.sample_data_token, r.model): (r.parse_status, r.weather) for r in labels.collect()}
    assert got == {("t1", "m"): ("schema_invalid", None), ("t2", "m"): ("ok", "clear"),
                   ("t1", "?"): ("ok", "rain")}
    assert rows(labelling.collect_labels(raw)) == rows(labels)
    assert rows(labelling.status_counts(labels)) == [
        ("?", "ok", 1), ("m", "ok", 1), ("m", "schema_invalid", 1)]
    assert rows(labelling.result_counts(raw.withColumn("result_type", F.lit("odd")))) == [
        ("errored", 5)]
    row = labels.filter("sample_data_token = 't2'").first()
    assert (row.hazards, row.notable_conditions, row.pedestrians) == ('["wet road"]', "[]", 7)


def test_line_order_survives_split_files(spark, tmp_path):
    """The last of many lines wins even when its file is read in many splits."""
    def line(i):
        text = json.dumps(_counts(cars=i))
        return json.dumps({"custom_id": f"t{i % 3}", "result_type": "succeeded",
                           "stop_reason": "end_turn", "text": text, "error_type": None})
    (tmp_path / "b1.jsonl").write_text("\n".join(line(i) for i in range(300)) + "\n")
    batches = spark.createDataFrame([("b1", "m")], "batch_id string, model string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                             "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        raw = read_label_results(spark, str(tmp_path), batches)
        assert raw.select("position.start").distinct().count() > 5  # splits of one file
        got = {r.sample_data_token: r.cars for r in labelling.collect_labels(raw).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert raw.count() == 300 and got == {"t0": 297, "t1": 298, "t2": 299}


def test_pending_leaves_out_finished_and_in_flight(spark):
    requested = spark.createDataFrame([("m", t) for t in "abcde"] + [("n", "a")],
                                      "model string, sample_data_token string")
    statuses = spark.createDataFrame(
        [("m", "a", "ok"), ("m", "b", "expired"), ("m", "c", "refusal"), ("n", "a", "errored_server")],
        "model string, sample_data_token string, parse_status string")
    batches = spark.createDataFrame(
        [("m", "in_progress", ["d"]), ("m", "ended", ["e", "b"]), ("n", None, ["z"])],
        "model string, status string, custom_ids array<string>")
    got = labelling.pending(requested, statuses, labelling.in_flight_tokens(batches))
    assert rows(got) == [("m", "b"), ("m", "e"), ("n", "a")]


@pytest.mark.parametrize("shards", [1, 3, None])
def test_batches_respect_both_bounds(spark, shards):
    sizes = [(i * 37) % 90 + 1 for i in range(200)] + [500]
    requests = spark.createDataFrame([("m", f"t{i:03}", s) for i, s in enumerate(sizes)],
                                     "model string, sample_data_token string, size long")
    got = labelling.assign_batches(requests, chunk_size=5, max_bytes=200, shards=shards)
    assert got.count() == len(sizes)
    for r in labelling.batch_summary(got).collect():
        assert r.n_requests <= 5
        assert r.n_bytes <= 200 or r.n_requests == 1
    if shards == 3:
        return
    want, batch, held, spent = [], 0, 0, 0
    for i, s in enumerate(sizes):
        if held and (held >= 5 or spent + s > 200):
            batch, held, spent = batch + 1, 0, 0
        held, spent = held + 1, spent + s
        want.append((f"t{i:03}", batch))
    assert rows(got.select("sample_data_token", "batch")) == want


def test_cost(spark):
    requests = spark.createDataFrame([("a",)] * 1000 + [("?",)], "model string")
    got = {r.model: r.cost for r in labelling.estimate_cost(requests, {"a": (1.0, 5.0)}).collect()}
    assert got["a"] == pytest.approx(1000 * (2300 + 5 * 350) / 1e6 * 0.5) and got["?"] is None


# --- evaluation -----------------------------------------------------------------------


def _labels(spark, nights, model="m"):
    rows_ = [(f"d{i}", model, "ok", "night" if n else "day", "clear", *[2 if f == "cars" else 0
             for f in COUNT_FIELDS]) for i, n in enumerate(nights)]
    return spark.createDataFrame(rows_, "sample_data_token string, model string, parse_status string,"
                                 " time_of_day string, weather string, "
                                 + ", ".join(f"{f} int" for f in COUNT_FIELDS))


def _truth(spark):
    """Four day and four night frames; two cars each, a hidden pedestrian at night."""
    sample = spark.createDataFrame(
        [(f"d{i}", i >= 4, False, "x|night|dry" if i >= 4 else "x|day|dry") for i in range(8)],
        "sample_data_token string, is_night boolean, is_rain boolean, stratum string")
    boxes = [(f"d{i}", "vehicle.car", "4") for i in range(8) for _ in range(2)]
    boxes += [(f"d{i}", "human.pedestrian.adult", "1") for i in range(4, 8)]
    boxes += [("d0", "animal", "4"), ("other", "vehicle.car", "4")]
    return sample, spark.createDataFrame(
        boxes, "sample_data_token string, category_name string, visibility_token string")


def test_label_evaluation(spark):
    sample, annotations = _truth(spark)
    labels = _labels(spark, [False] * 4 + [True] * 3 + [False])
    tables = evaluate.evaluate_labels(labels, sample, annotations, "m", 2)
    flags = {r.scope: r for r in tables["flags"].collect()}
    assert set(flags) == {"overall", "x|night|dry", "x|day|dry"}
    assert (flags["overall"].night_recall, flags["overall"].night_precision) == (0.75, 1.0)
    assert flags["overall"].night_accuracy == 7 / 8 and flags["overall"].rain_f1 == 0
    assert flags["x|day|dry"].night_precision == 0
    counts = {r["class"]: r for r in tables["counts_all"].collect()}
    assert len(counts) == 10
    assert (counts["cars"].mae, counts["cars"].exact_rate, counts["cars"].gt_total) == (0, 1, 16)
    assert counts["pedestrians"].mae == 0.5 and counts["pedestrians"].within_1_rate == 1
    visible = {r["class"]: r for r in tables["counts_visible"].collect()}
    assert visible["pedestrians"].gt_total == 0 and visible["pedestrians"].mae == 0
    buckets = {r.bucket: (r.n, r.mae) for r in tables["buckets"].collect()}
    assert buckets == {"0": (68, 0.0), "1-3": (12, pytest.approx(4 / 12))}


def test_ground_truth_counts_are_zero_filled(spark):
    _, annotations = _truth(spark)
    tokens = spark.createDataFrame([("d5",), ("unknown",)], "sample_data_token string")
    got = {r.sample_data_token: (r.cars, r.pedestrians, r.barriers)
           for r in evaluate.gt_counts(tokens, annotations).collect()}
    assert got == {"d5": (2, 1, 0), "unknown": (0, 0, 0)}


def test_model_agreement(spark):
    a = _labels(spark, [True] * 4)
    b = _labels(spark, [True, True, True, False]).withColumn("cars", F.lit(3))
    got = evaluate.model_agreement(a, b).first()
    assert tuple(got) == (4, 0.75, 1.0, pytest.approx(0.1))
    none = evaluate.model_agreement(a, b.limit(0)).first()
    assert tuple(none) == (0, None, None, None)


@pytest.mark.parametrize("rows_per_cut", [1, 7, 64, 1000])
def test_cuts_do_not_show_in_sequential_filling(spark, rows_per_cut):
    sizes = {"m": [(i * 37) % 90 + 1 for i in range(200)] + [500], "n": [300, 1, 1], "o": [1] * 23, "p": [250] * 9}
    requests = spark.createDataFrame(
        [(m, f"t{i:03}", s) for m, own in sizes.items() for i, s in enumerate(own)], "model string, sample_data_token string, size long")
    got = labelling.fill_batches(requests, chunk_size=5, max_bytes=200, rows_per_cut=rows_per_cut)
    whole = labelling.assign_batches(requests, chunk_size=5, max_bytes=200, shards=1)
    columns = ("model", "sample_data_token", "size", "batch")
    assert rows(got.select(*columns)) == rows(whole.select(*columns))
    assert labelling.fill_batches(requests.limit(0)).count() == 0


def _requests(spark, n):
    return spark.createDataFrame([("m", f"t{i:04}", (i * 37) % 90 + 1) for i in range(n)], "model string, sample_data_token string, size long")


def test_short_cuts_do_not_make_more_ranges(spark, monkeypatch):
    parts, settle = {}, labelling.settle
    monkeypatch.setattr(labelling, "settle", lambda df, name: (parts.setdefault(name, df.rdd.getNumPartitions()), settle(df, name))[1])
    assert labelling.fill_batches(_requests(spark, 90), chunk_size=1, max_bytes=200, rows_per_cut=1).count() == 90
    assert parts["dealt"] == 1  # 90 cuts


def test_shards_are_filled_in_bounded_groups(spark, monkeypatch):
    monkeypatch.setattr(labelling, "CUT_ROWS", 10)
    rows_at_once, settle = [], labelling.settle

    def seen(df, name):
        if name == "cuts":
            rows_at_once.append(df.count())
        return settle(df, name)

    monkeypatch.setattr(labelling, "settle", seen)
    got = labelling.assign_batches(_requests(spark, 95), chunk_size=5, max_bytes=200, shards=1)
    whole = labelling.fill_batches(_requests(spark, 95), chunk_size=5, max_bytes=200, rows_per_cut=1000)
    assert rows(got.drop("shard")) == rows(whole)
    assert rows_at_once[0] == 10  # cuts of ten, not one group of a shard


def test_texts_that_settle_nothing_are_not_parsed(spark):
    raw = spark.createDataFrame(
        [("a", "errored", None, "x", "{}"), ("b", "succeeded", "refusal", None, "{}"), ("c", "succeeded", None, None, "{}"), ("d", None, None, None, "{}")],
        "custom_id string, result_type string, stop_reason string, error_type string, text string")
    got = {r.custom_id: r.parse_status for r in with_status(raw).collect()}
    assert got == {"a": "errored_server", "b": "refusal", "c": "schema_invalid", "d": "schema_invalid"}
    parsed = raw.select("custom_id", F.try_parse_json(labels._read_text()).isNotNull().alias("parsed"))
    assert {r.custom_id for r in parsed.collect() if r.parsed} == {"c", "d"}


def test_only_last_results_are_parsed(spark):
    raw = spark.createDataFrame(
        [("a", "m", p, k, "succeeded", None, None, t) for p, k, t in (("1", 1, "not json"), ("1", 2, ""), ("2", 0, "{}"))],
        "custom_id string, model string, path string, position long, result_type string, stop_reason string, error_type string, text string")
    collected = labelling.collect_labels(raw)
    assert [r.parse_status for r in collected.collect()] == ["schema_invalid"]
    plan = collected._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("parseJson") < plan.index("Aggregate")  # a plan is read from its last step
