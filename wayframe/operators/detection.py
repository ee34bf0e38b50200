"""Average precision of detections, overall and per condition slice, and promotion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from wayframe.operators.matching import match_claims
from wayframe.operators.running import running_totals
from wayframe.sources.scratch import settle

# The usual mAP50-95 ladder and the 101 recall levels.
IOU_LADDER = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))
RECALL_LEVELS = 100
METRICS = ("mAP50", "mAP50-95", "precision", "recall")


def operating_points(
    pred: DataFrame,
    gt: DataFrame,
    slices: DataFrame | None = None,
    thresholds: Sequence[float] = IOU_LADDER,
    truth: DataFrame | None = None,
) -> DataFrame:
    """True and false positives at every distinct confidence.

    One row per (slice, class, IoU threshold, confidence), with cumulative counts from the
    most confident down. Predictions of equal confidence form one point, which makes the
    curve independent of their order. ``slices`` maps ``frame`` to ``slice``; every frame
    also counts towards ``overall``.
    """
    claims = match_claims(pred, gt, thresholds)
    # The ladder stays a handful of columns until every prediction and hit is counted. Rows
    # meet their frame's slices in one join, and are counted where they are before they move.
    steps = [f"tp{k}" for k in range(len(thresholds))]
    seen = _sliced(pred.select("frame", "cls", "conf"), slices)
    seen = seen.groupBy("slice", "cls", "conf").agg(F.count("*").alias("n_pred"))
    hits = _sliced(claims.select("frame", "cls", "conf", "reached"), slices).groupBy("slice", "cls", "conf").agg(
        *[F.sum(F.getbit("reached", F.lit(k)).cast("long")).alias(step) for k, step in enumerate(steps)])
    keys = ["slice", "cls", "iou_threshold"]
    ladder = F.array(*[
        F.struct(F.lit(float(t)).alias("iou_threshold"), F.coalesce(step, F.lit(0)).alias("tp"))
        for t, step in zip(thresholds, steps)])
    points = seen.join(hits, ["slice", "cls", "conf"], "left").select("slice", "cls", "conf", "n_pred", F.inline(ladder))
    points = settle(points.select(*keys, "conf", "tp", (F.col("n_pred") - F.col("tp")).alias("fp")), "operating-points")
    curve = running_totals(points, keys, "conf", ["tp", "fp"], descending=True)
    return curve.join(_truth_counts(gt, slices) if truth is None else truth, ["slice", "cls"])


def _sliced(df: DataFrame, slices: DataFrame | None) -> DataFrame:
    """Rows once for ``overall`` and once for every slice of their ``frame``."""
    everything = F.array(F.lit("overall"))
    if slices is None:
        return df.withColumn("slice", F.explode(everything))
    held = slices.groupBy("frame").agg(F.collect_list("slice").alias("_slices"))
    found = df.join(held, "frame", "left")
    return found.withColumn("slice", F.explode(F.concat(everything, F.coalesce("_slices", F.array().cast("array<string>"))))).drop("_slices")


def _truth_counts(gt: DataFrame, slices: DataFrame | None) -> DataFrame:
    """Boxes ``n_gt`` per slice and class: a small table, written."""
    return settle(_sliced(gt.select("frame", "cls"), slices).groupBy("slice", "cls").agg(F.count("*").alias("n_gt")), "truth-counts")


def class_metrics(
    pred: DataFrame,
    gt: DataFrame,
    slices: DataFrame | None = None,
    thresholds: Sequence[float] = IOU_LADDER,
) -> DataFrame:
    """AP per (slice, class, IoU threshold), and precision/recall at the best F1.

    AP is the mean over 101 recall levels of the best precision at that recall or beyond.
    Classes without ground truth are left out.
    """
    keys = ["slice", "cls", "iou_threshold"]
    recall = F.col("cum_tp") / F.col("n_gt")
    precision = F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))
    truth = _truth_counts(gt, slices)
    curve = operating_points(pred, gt, slices, thresholds, truth).select(
        *keys, "n_gt", precision.alias("precision"), recall.alias("recall"),
        # The highest level this point reaches, by integer division.
        F.floor(F.col("cum_tp") * RECALL_LEVELS / F.col("n_gt")).cast("int").alias("level"),
    )
    f1 = F.when(
        F.col("precision") + F.col("recall") > 0,
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")),
    ).otherwise(F.lit(0.0))
    levels = curve.groupBy(*keys, "level").agg(
        F.max("precision").alias("precision"),
        F.max(F.struct(f1.alias("f1"), F.col("precision"), F.col("recall"))).alias("best"),
    )
    # At most 101 rows per key. A level's precision is the best at it or beyond; it then
    # also holds for the levels below it down to the next one that is present.
    down = Window.partitionBy(*keys).orderBy(F.desc("level"))
    upto = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = levels.withColumns(
        {
            "_reach": F.max("precision").over(upto),
            "_below": F.coalesce(F.lead("level").over(down), F.lit(-1)),
        }
    )
    scored = steps.groupBy(*keys).agg(
        (F.sum(F.col("_reach") * (F.col("level") - F.col("_below"))) / (RECALL_LEVELS + 1))
        .alias("ap"),
        F.max("best").alias("best"),
    )
    ladder = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("iou_threshold")
    truth_keys = truth.select("slice", "cls", ladder)
    return truth_keys.join(scored, keys, "left").select(
        *keys,
        F.coalesce("ap", F.lit(0.0)).alias("ap"),
        F.coalesce("best.precision", F.lit(0.0)).alias("precision"),
        F.coalesce("best.recall", F.lit(0.0)).alias("recall"),
    )


def detection_metrics(per_class: DataFrame, n_images: DataFrame | None = None) -> DataFrame:
    """Mean over classes: ``slice, mAP50, mAP50-95, precision, recall`` (+ ``n_images``)."""
    at_half = F.col("iou_threshold") == IOU_LADDER[0]
    out = per_class.groupBy("slice").agg(
        F.avg(F.when(at_half, F.col("ap"))).alias("mAP50"),
        F.avg("ap").alias("mAP50-95"),
        F.avg(F.when(at_half, F.col("precision"))).alias("precision"),
        F.avg(F.when(at_half, F.col("recall"))).alias("recall"),
    )
    return out if n_images is None else out.join(n_images, "slice")


def slice_sizes(members: DataFrame) -> DataFrame:
    """Images per slice; a slice without images has no row."""
    return members.groupBy("slice").agg(F.count("*").alias("n_images"))


def promotion_gate(metrics: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """One row: overall and night mAP50-95 both reach their floors.

    Missing floors count as 0, as does a missing night slice.
    """

    def value(name: str):
        picked = F.max(F.when(F.col("slice") == name, F.col("`mAP50-95`")))
        return F.coalesce(picked, F.lit(0.0))

    return metrics.agg(
        value("overall").alias("overall_map"), value("time_of_day/night").alias("night_map")
    ).withColumn(
        "passed",
        (F.col("overall_map") >= float(thresholds.get("min_overall_map", 0.0)))
        & (F.col("night_map") >= float(thresholds.get("min_night_map", 0.0))),
    )


def flat_metrics(metrics: DataFrame) -> DataFrame:
    """Long form ``name, value`` with names ``<tag>_<metric>``; the tag follows the slash."""
    long = metrics.select("slice", *[F.col(f"`{m}`") for m in METRICS]).unpivot(
        ["slice"], [F.col(f"`{m}`") for m in METRICS], "metric", "value"
    )
    tag = F.substring_index("slice", "/", -1)
    return long.select(F.concat_ws("_", tag, "metric").alias("name"), "value")
