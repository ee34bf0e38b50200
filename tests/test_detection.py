"""Matching, failures, average precision and running totals against brute force."""

import random

import pytest

from tests.conftest import rows
from wayframe.operators import detection, matching
from wayframe.operators.running import running_totals

BOX = "x_min double, y_min double, x_max double, y_max double"
PRED = f"frame string, box_id string, cls int, conf double, {BOX}"
GT = f"frame string, box_id string, cls int, {BOX}"


def _iou(a, b):
    w = max(0.0, min(a[2], b[2]) - max(a[0], b[0]))
    h = max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
    return w * h / union if union > 0 else 0.0


def _greedy(pred, gt, t):
    """Matches by definition, one prediction at a time."""
    out = []
    for frame, cls in {(g[0], g[2]) for g in gt}:
        free = {g[1]: g[3:] for g in gt if (g[0], g[2]) == (frame, cls)}
        mine = [p for p in pred if (p[0], p[2]) == (frame, cls)]
        for p in sorted(mine, key=lambda p: (-p[3], p[1])):
            best = max(free, key=lambda g: (_iou(p[4:], free[g]), [-ord(c) for c in g]),
                       default=None)
            if best is not None and _iou(p[4:], free[best]) >= t:
                out.append((frame, cls, t, p[1], best))
                del free[best]
    return sorted(out)


def _random_boxes(seed, frames=6, n=14):
    """Crowded frames: many boxes overlap, with tied confidences and repeated boxes."""
    rng = random.Random(seed)
    def box():
        x, y = rng.randrange(0, 40, 4), rng.randrange(0, 20, 4)
        return (float(x), float(y), float(x + rng.choice([20, 24])), float(y + rng.choice([16, 20])))
    gt = [(f"f{f}", f"g{i:02}", rng.randrange(2), *box()) for f in range(frames) for i in range(n)]
    pred = [(f"f{f}", f"p{i:02}", rng.randrange(3), rng.randrange(1, 10) / 10, *box())
            for f in range(frames + 1) for i in range(n)]
    return pred, gt


def _frames(spark, pred, gt):
    return spark.createDataFrame(pred, PRED), spark.createDataFrame(gt, GT)


@pytest.mark.parametrize("fold_limit", [matching.FOLD_LIMIT, 0, 60])
def test_matches_equal_the_definition(spark, fold_limit):
    pred, gt = _random_boxes(11, n=24)
    got = matching.match_boxes(*_frames(spark, pred, gt), (0.5, 0.75), fold_limit=fold_limit)
    want = sorted(_greedy(pred, gt, 0.5) + _greedy(pred, gt, 0.75))
    assert sorted(tuple(r)[:5] for r in got.collect()) == want
    assert len(want) > 40


CASES = {
    # name: (predictions, ground truth, (n_gt, matched, fn, low, score))
    "identical": ([("a", 0, .9, 0), ("b", 1, .8, 50)], [("g", 0, 0), ("h", 1, 50)], (2, 2, 0, 0, 0)),
    "low": ([("a", 0, .2, 0)], [("g", 0, 0), ("h", 0, 50)], (2, 1, 1, 1, 1.5)),
    "class": ([("a", 1, .9, 0)], [("g", 0, 0)], (1, 0, 1, 0, 1)),
    "far": ([("a", 0, .9, 6)], [("g", 0, 0)], (1, 0, 1, 0, 1)),
    "twice": ([("a", 0, .3, 0), ("b", 0, .9, 2)], [("g", 0, 0)], (1, 1, 0, 0, 0)),
    "missed": ([], [("g", 0, 0)], (1, 0, 1, 0, 1)),
    "nothing": ([], [], (0, 0, 0, 0, 0)),
    "unasked": ([("a", 3, .9, 0)], [], (0, 0, 0, 0, 0)),
}


def test_failure_accounting(spark):
    pred = [(f, i, c, s, x, 0.0, x + 10.0, 10.0) for f, (ps, _, _) in CASES.items()
            for i, c, s, x in [(i, c, s, float(x)) for i, c, s, x in ps]]
    gt = [(f, i, c, x, 0.0, x + 10.0, 10.0) for f, (_, gs, _) in CASES.items()
          for i, c, x in [(i, c, float(x)) for i, c, x in gs]]
    p, g = _frames(spark, pred, gt)
    frames = spark.createDataFrame([(f, f == "low") for f in CASES],
                                   "sample_data_token string, is_night boolean")
    scored = matching.score_frames(frames, g, matching.match_boxes(p, g))
    got = {r.sample_data_token: tuple(r)[2:] for r in scored.collect()}
    assert got == {f: want for f, (_, _, want) in CASES.items()}
    top = matching.top_failures(scored, 2).collect()
    assert [r.sample_data_token for r in top] == ["low", "class"]
    total = matching.summarize_failures(scored).first()
    assert (total.n_frames, total.total_fn, total.total_low_conf) == (8, 4, 1)
    assert total.mean_failure_score_night == 1.5
    empty = matching.summarize_failures(scored.filter("false")).first()
    assert tuple(empty) == (0, 0.0, 0.0, 0.0, 0, 0)


def test_gridded_pairs_find_the_same_pairs(spark):
    pred, gt = _random_boxes(4)
    pred = [(*p[:4], *[c * 20 for c in p[4:]]) for p in pred]
    gt = [(*g[:3], *[c * 20 for c in g[3:]]) for g in gt]
    p, g = _frames(spark, pred, gt)
    assert rows(matching._gridded_pairs(p, g, 0.5)) == rows(matching.overlapping_pairs(p, g, 0.5))


def _ap(pred, gt, t):
    """Mean over classes of the 101-level interpolated precision."""
    hits = {m[0] + m[3] for m in _greedy(pred, gt, t)}
    scores = []
    for cls in {g[2] for g in gt}:
        n = sum(g[2] == cls for g in gt)
        curve = []
        for c in sorted({p[3] for p in pred if p[2] == cls}, reverse=True):
            seen = [p for p in pred if p[2] == cls and p[3] >= c]
            tp = sum(p[0] + p[1] in hits for p in seen)
            curve.append((tp, tp / len(seen)))
        levels = [max([pr for tp, pr in curve if tp * 100 >= i * n], default=0) for i in range(101)]
        scores.append(sum(levels) / 101)
    return sum(scores) / len(scores)


def test_average_precision_overall_and_per_slice(spark):
    pred, gt = _random_boxes(2)
    night = {"f0", "f3"}
    slices = spark.createDataFrame([(f, "time_of_day/night") for f in night],
                                   "frame string, slice string")
    per_class = detection.class_metrics(*_frames(spark, pred, gt), slices)
    got = {r.slice: r for r in detection.detection_metrics(per_class).collect()}
    assert got["overall"].mAP50 == pytest.approx(_ap(pred, gt, 0.5))
    ladder = [_ap(pred, gt, t) for t in detection.IOU_LADDER]
    assert got["overall"]["mAP50-95"] == pytest.approx(sum(ladder) / 10)
    dark = [[x for x in side if x[0] in night] for side in (pred, gt)]
    assert got["time_of_day/night"].mAP50 == pytest.approx(_ap(*dark, 0.5))


def test_perfect_detections_score_one_and_none_score_zero(spark):
    _, gt = _random_boxes(8)
    gt = [(f"{g[0]}{g[1]}", *g[1:]) for g in gt]
    pred = [(g[0], "p", g[2], 0.9, *g[3:]) for g in gt]
    p, g = _frames(spark, pred, gt)
    best = detection.detection_metrics(detection.class_metrics(p, g)).first()
    assert tuple(best)[1:] == pytest.approx((1, 1, 1, 1))
    none = detection.detection_metrics(detection.class_metrics(p.limit(0), g)).first()
    assert tuple(none)[1:] == (0, 0, 0, 0)


def test_promotion_gate_and_flat_metrics(spark):
    schema = "slice string, mAP50 double, `mAP50-95` double, precision double, recall double"
    metrics = spark.createDataFrame([("overall", .5, .3, .6, .7), ("time_of_day/night", .4, .2, .1, .2)],
                                    schema)
    floors = {"min_overall_map": 0.3, "min_night_map": 0.2}
    assert detection.promotion_gate(metrics, floors).first().passed is True
    assert detection.promotion_gate(metrics, {**floors, "min_night_map": .21}).first().passed is False
    day = metrics.filter("slice = 'overall'")
    assert detection.promotion_gate(day, floors).first().passed is False
    assert detection.promotion_gate(day, {}).first().passed is True
    flat = {r.name: r.value for r in detection.flat_metrics(metrics).collect()}
    assert flat["night_mAP50-95"] == .2 and flat["overall_recall"] == .7 and len(flat) == 8


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_do_not_depend_on_the_cuts(spark, descending):
    rng = random.Random(1)
    values = sorted({round(rng.gauss(0, 5), 2) for _ in range(900)})
    data = [(k, v, rng.randrange(9)) for k in "ab" for v in values if k == "a" or v > 3]
    points = spark.createDataFrame(data, "k string, v double, n long")
    options = dict(descending=descending)
    whole = running_totals(points, ["k"], "v", ["n"], **options)
    cut = running_totals(points, ["k"], "v", ["n"], rows_per_cut=50, **options)
    assert rows(whole) == rows(cut)
    total = {}
    for k, v, n in sorted(data, key=lambda r: r[1], reverse=descending):
        total[k] = total.get(k, 0) + n
        total[k, v] = total[k]
    assert {(r.k, r.v): r.cum_n for r in cut.collect()} == {x: n for x, n in total.items() if len(x) == 2}


def test_small_groups_have_one_cell(spark, monkeypatch):
    grids, gridded = [], matching._gridded_pairs

    def seen(pred, gt, iou_min):
        grids.extend(r["_grid"] for r in pred.collect())
        return gridded(pred, gt, iou_min)

    monkeypatch.setattr(matching, "_gridded_pairs", seen)
    box = "frame string, box_id string, cls int, conf double, x_min double, y_min double, x_max double, y_max double"
    pred = spark.createDataFrame([("f", "p", 0, 0.9, 10.0, 10.0, 700.0, 700.0)], box)
    gt = spark.createDataFrame([("f", "g", 0, 0.0, 10.0, 10.0, 690.0, 700.0)], box).drop("conf")
    assert [r.gt_id for r in matching.match_boxes(pred, gt, (0.5,), fold_limit=0).collect()] == ["g"]
    assert grids == [1]  # not the 64 cells a side of a crowded frame


def test_boxes_inside_the_image_cross_no_edge():
    import numpy as np

    from wayframe.functions import geometry

    inside = np.stack([np.linspace(100, 200, 8), np.linspace(50, 90, 8)], axis=1)
    points, seen = np.stack([inside, inside - [150, 0]]), np.ones((2, 8), bool)
    size = np.full(2, 1600.0), np.full(2, 900.0)
    reached = [rows.tolist() for rows, _, _ in geometry._chord_crossings(points, seen, *size)]
    assert reached == [[1], [], [], []]
