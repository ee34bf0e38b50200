"""Queries over detections: projection, matching, failures, average precision."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayframe.functions.conditions import slice_members
from wayframe.operators import detection, flatten as flat, matching, sampling
from wayframe.operators.detection import IOU_LADDER
from wayframe.plans.metadata import flat_tables
from wayframe.plans.proxies import table
from wayframe.plans.registry import query, r6, rounded, view
from wayframe.sources.scratch import settle

# --- twins ----------------------------------------------------------------------------

_INTER = (
    "greatest(least(p.x_max, g.x_max) - greatest(p.x_min, g.x_min), 0.0)"
    " * greatest(least(p.y_max, g.y_max) - greatest(p.y_min, g.y_min), 0.0)"
)
_UNION = (
    "((p.x_max - p.x_min) * (p.y_max - p.y_min) + (g.x_max - g.x_min) * (g.y_max - g.y_min)"
    f" - {_INTER})"
)
_IOU = f"CASE WHEN {_UNION} > 0 THEN {_INTER} / {_UNION} ELSE 0 END"
_LADDER = "[" + ", ".join(f"{t}::DOUBLE" for t in IOU_LADDER) + "]"

view("truth", """
    SELECT sample_data_token AS frame, annotation_token AS box_id,
      CAST(list_position(['car', 'truck', 'bus', 'pedestrian', 'bicycle'], category_group) - 1
        AS INT) AS cls, x_min, y_min, x_max, y_max
    FROM {annotations} WHERE category_group IS NOT NULL""")
view("pairs", f"""
    SELECT p.frame, p.cls, p.box_id AS pred_id, p.conf, g.box_id AS gt_id, {_IOU} AS iou
    FROM {{predictions}} p JOIN {{truth}} g ON p.frame = g.frame AND p.cls = g.cls
    WHERE {_IOU} >= 0.5""")
view("choices", f"""
    SELECT *, row_number() OVER (PARTITION BY frame, cls, iou_threshold
        ORDER BY conf DESC, pred_id) AS turn
    FROM (SELECT frame, cls, iou_threshold, pred_id, any_value(conf) AS conf,
            list({{'gt_id': gt_id, 'iou': iou}} ORDER BY iou DESC, gt_id) AS wanted
          FROM {{pairs}}, (SELECT unnest({_LADDER}) AS iou_threshold) WHERE iou >= iou_threshold
          GROUP BY frame, cls, iou_threshold, pred_id)""".replace("{'gt_id'", "{{'gt_id'")
     .replace("iou} ORDER", "iou}} ORDER"))
view("claims", """
    SELECT DISTINCT frame, cls, iou_threshold, CAST(0 AS BIGINT) AS turn,
      CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS VARCHAR) AS pred_id,
      CAST(NULL AS DOUBLE) AS conf, CAST(NULL AS VARCHAR) AS gt_id, CAST(NULL AS DOUBLE) AS iou
    FROM {choices}
    UNION ALL
    SELECT frame, cls, iou_threshold, turn,
      CASE WHEN pick IS NULL THEN taken ELSE list_append(taken, pick.gt_id) END,
      pred_id, conf, pick.gt_id, pick.iou
    FROM (SELECT h.*, c.taken,
            list_filter(h.wanted, lambda w: NOT list_contains(c.taken, w.gt_id))[1] AS pick
          FROM claims c JOIN {choices} h ON h.frame = c.frame AND h.cls = c.cls
            AND h.iou_threshold = c.iou_threshold AND h.turn = c.turn + 1)""")
view("matches", """
    SELECT frame, cls, iou_threshold, pred_id, gt_id, conf, iou FROM {claims}
    WHERE gt_id IS NOT NULL""")
view("memberships", """
    SELECT sample_data_token AS frame, unnest([
      CASE WHEN contains(lower(scene_description), 'night') THEN 'time_of_day/night'
           ELSE 'time_of_day/day' END,
      CASE WHEN contains(lower(scene_description), 'rain') THEN 'weather/rain'
           ELSE 'weather/clear' END, 'overall']) AS slice FROM {samples}""")
view("curve", f"""
    SELECT slice, cls, iou_threshold, n_gt, conf,
      sum(tp) OVER w AS tp, sum(n - tp) OVER w AS fp
    FROM (SELECT slice, p.cls, t.iou_threshold, p.conf, count(*) AS n, count(m.pred_id) AS tp
          FROM {{predictions}} p JOIN {{memberships}} s ON p.frame = s.frame
          CROSS JOIN (SELECT unnest({_LADDER}) AS iou_threshold) t
          LEFT JOIN {{matches}} m ON m.pred_id = p.box_id AND m.iou_threshold = t.iou_threshold
          GROUP BY ALL)
    JOIN (SELECT slice, cls, count(*) AS n_gt FROM {{truth}} JOIN {{memberships}} USING (frame)
          GROUP BY ALL) USING (slice, cls)
    WINDOW w AS (PARTITION BY slice, cls, iou_threshold ORDER BY conf DESC)""")
view("levels", """
    SELECT slice, cls, iou_threshold, l,
      coalesce(max(tp / (tp + fp)) FILTER (tp * 100 >= l * n_gt), 0) AS p
    FROM {curve} CROSS JOIN (SELECT unnest(range(101)) AS l) GROUP BY ALL""")
view("best", """
    SELECT slice, cls, iou_threshold, max({{'f1': CASE WHEN tp > 0 THEN
        2 * (tp / (tp + fp)) * (tp / n_gt) / ((tp / (tp + fp)) + (tp / n_gt)) ELSE 0 END,
      'p': tp / (tp + fp), 'r': tp / n_gt}}) AS b
    FROM {curve} GROUP BY ALL""")
view("class_scores", f"""
    SELECT k.slice, k.cls, k.iou_threshold, coalesce(ap, 0) AS ap,
      coalesce(b.p, 0) AS precision, coalesce(b.r, 0) AS recall
    FROM (SELECT DISTINCT slice, cls, iou_threshold FROM {{truth}} JOIN {{memberships}} USING (frame)
          CROSS JOIN (SELECT unnest({_LADDER}) AS iou_threshold)) k
    LEFT JOIN (SELECT slice, cls, iou_threshold, avg(p) AS ap FROM {{levels}} GROUP BY ALL) a
      USING (slice, cls, iou_threshold)
    LEFT JOIN {{best}} USING (slice, cls, iou_threshold)""")
view("slice_scores", """
    SELECT slice, avg(ap) FILTER (iou_threshold = 0.5) AS "mAP50", avg(ap) AS "mAP50-95",
      avg(precision) FILTER (iou_threshold = 0.5) AS precision,
      avg(recall) FILTER (iou_threshold = 0.5) AS recall
    FROM {class_scores} GROUP BY slice""")
view("val_frames", """
    SELECT sample_data_token, scene_name, is_night FROM {samples} JOIN {splits} USING (scene_name)
    WHERE split = 'val' AND channel = 'CAM_FRONT'""")
view("sweep_truth", """
    SELECT t.* FROM {truth} t JOIN {annotations} a ON t.box_id = a.annotation_token
    JOIN {val_frames} v ON t.frame = v.sample_data_token
    WHERE TRY_CAST(a.visibility_token AS INT) >= 2""")
view("sweep_choices", f"""
    SELECT *, row_number() OVER (PARTITION BY frame, cls ORDER BY conf DESC, pred_id) AS turn
    FROM (SELECT p.frame, p.cls, p.box_id AS pred_id, p.conf,
            list(g.box_id ORDER BY {_IOU} DESC, g.box_id) AS wanted
          FROM {{predictions}} p JOIN {{sweep_truth}} g ON p.frame = g.frame AND p.cls = g.cls
          WHERE {_IOU} >= 0.5 AND p.conf >= 0.3 GROUP BY ALL)""")
view("sweep_claims", """
    SELECT DISTINCT frame, cls, CAST(0 AS BIGINT) AS turn, CAST([] AS VARCHAR[]) AS taken,
      CAST(NULL AS DOUBLE) AS conf, CAST(NULL AS VARCHAR) AS gt_id
    FROM {sweep_choices}
    UNION ALL
    SELECT frame, cls, turn,
      CASE WHEN pick IS NULL THEN taken ELSE list_append(taken, pick) END, conf, pick
    FROM (SELECT h.*, c.taken,
            list_filter(h.wanted, lambda w: NOT list_contains(c.taken, w))[1] AS pick
          FROM sweep_claims c JOIN {sweep_choices} h ON h.frame = c.frame AND h.cls = c.cls
            AND h.turn = c.turn + 1)""")
view("failures", """
    SELECT v.*, coalesce(n_gt, 0) AS n_gt, coalesce(n_matched, 0) AS n_matched,
      coalesce(n_gt, 0) - coalesce(n_matched, 0) AS n_fn, coalesce(n_low_conf, 0) AS n_low_conf,
      coalesce(n_gt, 0) - coalesce(n_matched, 0) + 0.5::DOUBLE * coalesce(n_low_conf, 0)
        AS failure_score
    FROM {val_frames} v
    LEFT JOIN (SELECT frame, count(*) AS n_gt FROM {sweep_truth} GROUP BY frame) t
      ON v.sample_data_token = t.frame
    LEFT JOIN (SELECT frame, count(*) AS n_matched, count(*) FILTER (conf < 0.4) AS n_low_conf
      FROM {sweep_claims} WHERE gt_id IS NOT NULL GROUP BY frame) m
      ON v.sample_data_token = m.frame""")


# --- projection -----------------------------------------------------------------------

view("cuboid_corners", """
    SELECT annotation_token, k, 800 + 1e3 * x / z AS u, 450 + 1e3 * y / z AS v FROM (
      SELECT annotation_token, sx * 4 + sy * 2 + sz AS k,
        cx + (l / 2 * (1 - 2 * sx)) * cos(angle) + (h / 2 * (1 - 2 * sz)) * sin(angle) AS x,
        cy + w / 2 * (1 - 2 * sy) AS y,
        cz - (l / 2 * (1 - 2 * sx)) * sin(angle) + (h / 2 * (1 - 2 * sz)) * cos(angle) AS z
      FROM {cuboids}, (SELECT unnest([0, 1]) AS sx), (SELECT unnest([0, 1]) AS sy),
        (SELECT unnest([0, 1]) AS sz))
    WHERE z > 0.1""")
view("cuboid_seen", """
    SELECT annotation_token FROM {cuboid_corners} GROUP BY ALL HAVING count(*) >= 3""")
view("cuboid_segments", """
    SELECT a.annotation_token, a.u AS u1, a.v AS v1, b.u AS u2, b.v AS v2
    FROM {cuboid_corners} a JOIN {cuboid_corners} b
      ON a.annotation_token = b.annotation_token AND a.k < b.k""")
view("canvas", "SELECT unnest([0, 1600, 0, 1600]) AS x, unnest([0, 0, 900, 900]) AS y")
view("cuboid_points", """
    SELECT annotation_token, u, v FROM {cuboid_corners}
    WHERE u BETWEEN 0 AND 1600 AND v BETWEEN 0 AND 900
    UNION ALL
    SELECT annotation_token, e, v1 + (e - u1) / (u2 - u1) * (v2 - v1)
    FROM {cuboid_segments}, (SELECT unnest([0, 1600]) AS e)
    WHERE u1 <> u2 AND e BETWEEN least(u1, u2) AND greatest(u1, u2)
      AND v1 + (e - u1) / (u2 - u1) * (v2 - v1) BETWEEN 0 AND 900
    UNION ALL
    SELECT annotation_token, u1 + (e - v1) / (v2 - v1) * (u2 - u1), e
    FROM {cuboid_segments}, (SELECT unnest([0, 900]) AS e)
    WHERE v1 <> v2 AND e BETWEEN least(v1, v2) AND greatest(v1, v2)
      AND u1 + (e - v1) / (v2 - v1) * (u2 - u1) BETWEEN 0 AND 1600
    UNION ALL
    SELECT a.annotation_token, x, y
    FROM {cuboid_corners} a JOIN {cuboid_corners} b
      ON a.annotation_token = b.annotation_token AND a.k < b.k
    JOIN {cuboid_corners} c ON a.annotation_token = c.annotation_token AND b.k < c.k, {canvas}
    WHERE ((b.u - a.u) * (y - a.v) - (b.v - a.v) * (x - a.u) >= 0
       AND (c.u - b.u) * (y - b.v) - (c.v - b.v) * (x - b.u) >= 0
       AND (a.u - c.u) * (y - c.v) - (a.v - c.v) * (x - c.u) >= 0)
      OR ((b.u - a.u) * (y - a.v) - (b.v - a.v) * (x - a.u) <= 0
       AND (c.u - b.u) * (y - b.v) - (c.v - b.v) * (x - b.u) <= 0
       AND (a.u - c.u) * (y - c.v) - (a.v - c.v) * (x - c.u) <= 0)""")


def _cuboids(spark, d):
    cuboids = table(spark, d, "cuboids")
    half = F.col("angle") / 2
    zero = F.lit(0.0)
    return cuboids.select(
        "annotation_token",
        F.array("cx", "cy", "cz").alias("center"),
        F.array("w", "l", "h").alias("size"),
        F.array(F.cos(half), zero, F.sin(half), zero).alias("rotation"),
        F.array(
            F.array(F.lit(1000.0), zero, F.lit(800.0)),
            F.array(zero, F.lit(1000.0), F.lit(450.0)),
            F.array(zero, zero, F.lit(1.0)),
        ).alias("camera_intrinsic"),
        F.lit(1600).cast("long").alias("width"), F.lit(900).cast("long").alias("height"),
    )


@query("P16", f"""
    SELECT annotation_token, {", ".join(
        r6(e) + " AS " + n for e, n in (
            ("x0", "x_min"), ("y0", "y_min"), ("x1", "x_max"), ("y1", "y_max")))}
    FROM {{cuboids}} LEFT JOIN (
      SELECT annotation_token, min(u) AS x0, min(v) AS y0, max(u) AS x1, max(v) AS y1
      FROM {{cuboid_points}} JOIN {{cuboid_seen}} USING (annotation_token)
      GROUP BY annotation_token HAVING max(u) > min(u) AND max(v) > min(v)) b
      USING (annotation_token)""")
def projected_boxes(spark, d):
    return rounded(flat.image_boxes(_cuboids(spark, d)), "x_min", "y_min", "x_max", "y_max")


@query("P16", f"""
    SELECT annotation_token, {", ".join(
        r6(e) + " AS " + n for e, n in (
            ("x0", "x_min"), ("y0", "y_min"), ("x1", "x_max"), ("y1", "y_max")))}
    FROM {{cuboids}} LEFT JOIN (
      SELECT annotation_token, min(u) AS x0, min(v) AS y0, max(u) AS x1, max(v) AS y1
      FROM {{cuboid_corners}} JOIN {{cuboid_seen}} USING (annotation_token)
      GROUP BY annotation_token HAVING max(u) > min(u) AND max(v) > min(v)) b
      USING (annotation_token)""")
def projected_boxes_unclipped(spark, d):
    boxes = flat.image_boxes(_cuboids(spark, d), clip=False)
    return rounded(boxes, "x_min", "y_min", "x_max", "y_max")


# --- matching -------------------------------------------------------------------------


def _detections(spark, d):
    truth = matching.ground_truth(flat_tables(spark, d)[1])
    return settle(table(spark, d, "predictions"), "predictions"), settle(truth, "truth")


@query("P17 J13", f"""
    SELECT frame, cls, pred_id, conf, gt_id, {r6("iou")} AS iou FROM {{pairs}}""")
def overlapping_pairs(spark, d):
    return rounded(matching.overlapping_pairs(*_detections(spark, d)), "iou")


@query("W4 J13 P17", f"""
    SELECT frame, cls, iou_threshold, pred_id, gt_id, conf, {r6("iou")} AS iou FROM {{matches}}""")
def match_boxes(spark, d):
    return rounded(matching.match_boxes(*_detections(spark, d), IOU_LADDER), "iou")


@query("W4 J13 P17", f"""
    SELECT frame, cls, iou_threshold, pred_id, gt_id, conf, {r6("iou")} AS iou FROM {{matches}}
    WHERE iou_threshold = 0.5""")
def match_boxes_by_rounds(spark, d):
    return rounded(matching.match_boxes(*_detections(spark, d), (0.5,), fold_limit=0), "iou")


def _failures(spark, d):
    samples, annotations = flat_tables(spark, d)
    val = table(spark, d, "splits").filter("split = 'val'")
    return matching.failure_sweep(
        samples, annotations, table(spark, d, "predictions"), val, conf_low=0.3
    )


@query("M4 J14 J7 P7 W4", "SELECT * FROM {failures}")
def failure_table(spark, d):
    return _failures(spark, d)


@query("A7", f"""
    SELECT count(*) AS n_frames, {r6("avg(failure_score)")} AS mean_failure_score,
      {r6("coalesce(avg(failure_score) FILTER (NOT is_night), 0)")} AS mean_failure_score_day,
      {r6("coalesce(avg(failure_score) FILTER (is_night), 0)")} AS mean_failure_score_night,
      CAST(sum(n_fn) AS BIGINT) AS total_fn, CAST(sum(n_low_conf) AS BIGINT) AS total_low_conf
    FROM {{failures}}""")
def failure_summary(spark, d):
    means = [f"mean_failure_score{s}" for s in ("", "_day", "_night")]
    return rounded(matching.summarize_failures(_failures(spark, d)), *means)


@query("T1", """
    SELECT * FROM {failures} ORDER BY failure_score DESC, sample_data_token LIMIT 40""")
def top_failures(spark, d):
    return matching.top_failures(_failures(spark, d), 40)


@query("T5", "SELECT * FROM {samples} ORDER BY sample_data_token LIMIT 30")
def first_frames(spark, d):
    return flat_tables(spark, d)[0].orderBy("sample_data_token").limit(30)


# --- average precision ----------------------------------------------------------------


def _frames(spark, d):
    samples = flat_tables(spark, d)[0].select(
        F.col("sample_data_token").alias("frame"), "scene_description"
    )
    return settle(samples, "frames")


def _class_metrics(spark, d, frames=None):
    frames = _frames(spark, d) if frames is None else frames
    members = slice_members(frames).select("frame", "slice")
    pred = table(spark, d, "predictions").join(frames.select("frame"), "frame", "left_semi")
    truth = settle(matching.ground_truth(flat_tables(spark, d)[1]), "truth")
    return detection.class_metrics(settle(pred, "predictions"), truth, members)


def _metrics(spark, d):
    frames = _frames(spark, d)
    sizes = detection.slice_sizes(slice_members(frames).select("slice")).unionByName(
        frames.agg(F.count("*").alias("n_images")).select(F.lit("overall").alias("slice"), "n_images")
    )
    return detection.detection_metrics(_class_metrics(spark, d, frames), sizes)


@query("A24 W4", f"""
    SELECT slice, cls, iou_threshold, {r6("ap")} AS ap, {r6("precision")} AS precision,
      {r6("recall")} AS recall FROM {{class_scores}}""")
def class_average_precision(spark, d):
    return rounded(_class_metrics(spark, d), "ap", "precision", "recall")


_METRIC_SQL = f"""SELECT slice, {r6('"mAP50"')} AS "mAP50", {r6('"mAP50-95"')} AS "mAP50-95",
      {r6("precision")} AS precision, {r6("recall")} AS recall, n_images
    FROM {{slice_scores}} JOIN
      (SELECT slice, count(*) AS n_images FROM {{memberships}} GROUP BY slice) USING (slice)"""


@query("A24 A25", _METRIC_SQL)
def detection_metrics(spark, d):
    return rounded(_metrics(spark, d), *detection.METRICS)


@query("P27", f"""
    SELECT split_part(slice, '/', -1) || '_' || metric AS name, value FROM (
      UNPIVOT (SELECT * EXCLUDE (n_images) FROM ({_METRIC_SQL}))
      ON "mAP50", "mAP50-95", precision, recall INTO NAME metric VALUE value)""")
def flat_metrics(spark, d):
    return rounded(detection.flat_metrics(_metrics(spark, d)), "value")


@query("P26", f"""
    SELECT {r6("o")} AS overall_map, {r6("n")} AS night_map, o >= 0.1 AND n >= 0.05 AS passed
    FROM (SELECT coalesce(max("mAP50-95") FILTER (slice = 'overall'), 0) AS o,
      coalesce(max("mAP50-95") FILTER (slice = 'time_of_day/night'), 0) AS n
      FROM {{slice_scores}})""")
def promotion_gate(spark, d):
    gate = detection.promotion_gate(
        _metrics(spark, d), {"min_overall_map": 0.1, "min_night_map": 0.05}
    )
    return rounded(gate, "overall_map", "night_map")
