"""Predicted labels against ground truth."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from wayframe.functions.geometry import visibility_at_least
from wayframe.functions.taxonomy import COUNT_FIELDS, count_field


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when whole is 0."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))


def precision_recall_f1(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return {
        "precision": precision,
        "recall": recall,
        "f1": ratio(2 * precision * recall, precision + recall),
    }


def _confusion(name: str, predicted: Column, actual: Column) -> list[Column]:
    predicted, actual = (F.coalesce(c, F.lit(False)) for c in (predicted, actual))
    return [
        F.count_if(predicted & actual).alias(f"{name}_tp"),
        F.count_if(predicted & ~actual).alias(f"{name}_fp"),
        F.count_if(~predicted & actual).alias(f"{name}_fn"),
    ]


def gt_counts(
    tokens: DataFrame, annotations: DataFrame, visibility_min: int | None = None
) -> DataFrame:
    """Ground-truth count per frame and field, zero for every requested frame without one.

    The pivot is a set of conditional counts, so it is one aggregation with partial sums
    and needs no pass to find the pivot values.
    """
    boxes = annotations
    if visibility_min is not None:
        boxes = boxes.filter(visibility_at_least(F.col("visibility_token"), visibility_min))
    boxes = boxes.select("sample_data_token", count_field(F.col("category_name")).alias("_field"))
    counts = (
        boxes.filter(F.col("_field").isNotNull())
        .groupBy("sample_data_token")
        .agg(*[F.count_if(F.col("_field") == f).alias(f) for f in COUNT_FIELDS])
    )
    wanted = tokens.select("sample_data_token").distinct()
    return wanted.join(counts, "sample_data_token", "left").fillna(0, list(COUNT_FIELDS))


def eval_flags(labels: DataFrame, sample: DataFrame) -> DataFrame:
    """Condition labels against the scene flags, overall and per stratum.

    Frames are summed per stratum first; the overall row is rolled up from those sums.
    """
    context = sample.select("sample_data_token", "is_night", "is_rain", "stratum")
    joined = labels.select("sample_data_token", "time_of_day", "weather").join(
        context, "sample_data_token"
    )
    time, weather = F.col("time_of_day"), F.col("weather")
    night, rain = time == "night", weather == "rain"
    sums = joined.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *_confusion("night", night, F.col("is_night")),
        *_confusion("rain", rain, F.col("is_rain")),
        F.count_if(time == "dusk_dawn").alias("dusk_dawn"),
        F.count_if(weather == "overcast").alias("overcast"),
        F.count_if(weather == "fog").alias("fog"),
    )
    measures = [c for c in sums.columns if c != "stratum"]
    totals = sums.groupingSets([[], ["stratum"]], "stratum").agg(
        F.grouping("stratum").alias("_total"), *[F.sum(c).alias(c) for c in measures]
    )
    n = F.col("n")

    def block(name: str) -> list[Column]:
        tp, fp, fn = (F.col(f"{name}_{c}") for c in ("tp", "fp", "fn"))
        scores = precision_recall_f1(tp, fp, fn)
        return [
            ((n - fp - fn) / n).alias(f"{name}_accuracy"),
            *[v.alias(f"{name}_{k}") for k, v in scores.items()],
        ]

    return totals.filter(n > 0).select(
        F.when(F.col("_total") == 1, "overall").otherwise(F.col("stratum")).alias("scope"),
        "n",
        *block("night"),
        (F.col("dusk_dawn") / n).alias("dusk_dawn_share"),
        *block("rain"),
        (F.col("overcast") / n).alias("overcast_share"),
        (F.col("fog") / n).alias("fog_share"),
    )


def _with_truth(labels: DataFrame, gt: DataFrame) -> DataFrame:
    """Predicted fields next to ``gt_<field>`` for the frames both sides know."""
    truth = gt.select("sample_data_token", *[F.col(f).alias(f"gt_{f}") for f in COUNT_FIELDS])
    return labels.select("sample_data_token", *COUNT_FIELDS).join(truth, "sample_data_token")


def eval_counts(labels: DataFrame, gt: DataFrame) -> DataFrame:
    """Count metrics per field: totals, MAE, exact and within-one rates, presence scores.

    All fields are aggregated side by side in one row and turned afterwards, so the frames
    are never multiplied by the number of fields.
    """

    def measures(field: str) -> dict[str, Column]:
        pred, actual = F.col(field), F.col(f"gt_{field}")
        error = F.abs(pred - actual)
        return {
            "gt_total": F.sum(actual),
            "pred_total": F.sum(pred),
            "error": F.sum(error),
            "exact": F.count_if(error == 0),
            "near": F.count_if(error <= 1),
            "tp": F.count_if((pred > 0) & (actual > 0)),
            "fp": F.count_if((pred > 0) & (actual <= 0)),
            "fn": F.count_if((pred <= 0) & (actual > 0)),
        }

    sums = _with_truth(labels, gt).agg(
        F.count("*").alias("n"),
        *[v.alias(f"{f}__{k}") for f in COUNT_FIELDS for k, v in measures(f).items()],
    )
    names = list(measures(COUNT_FIELDS[0]))
    rows = F.array(
        *[
            F.struct(F.lit(f).alias("class"), *[F.col(f"{f}__{k}").alias(k) for k in names])
            for f in COUNT_FIELDS
        ]
    )
    n = F.col("n")
    presence = precision_recall_f1(F.col("tp"), F.col("fp"), F.col("fn"))
    return sums.select("n", F.inline(rows)).select(
        "class", "n", "gt_total", "pred_total",
        (F.col("error") / n).alias("mae"),
        (F.col("exact") / n).alias("exact_rate"),
        (F.col("near") / n).alias("within_1_rate"),
        *[v.alias(f"presence_{k}") for k, v in presence.items()],
    )


def eval_buckets(labels: DataFrame, gt: DataFrame) -> DataFrame:
    """MAE by size of the true count, pooled over fields; unseen buckets have no row."""
    pairs = F.array(
        *[F.struct(F.col(f).alias("pred"), F.col(f"gt_{f}").alias("gt")) for f in COUNT_FIELDS]
    )
    pooled = _with_truth(labels, gt).select(F.inline(pairs))
    true_count = F.col("gt")
    bucket = (
        F.when(true_count <= 0, "0").when(true_count <= 3, "1-3").when(true_count <= 9, "4-9")
        .otherwise("10+")
    )
    return pooled.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("n"), F.avg(F.abs(F.col("pred") - F.col("gt"))).alias("mae")
    )


def model_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: how often two models agree on the frames both labelled (NULLs when none)."""
    left, right = a.alias("a"), b.alias("b")
    joined = left.join(right, F.col("a.sample_data_token") == F.col("b.sample_data_token"))

    def same(name: str) -> Column:
        equal = F.coalesce(F.col(f"a.{name}") == F.col(f"b.{name}"), F.lit(False))
        return F.avg(equal.cast("int"))

    gaps = sum(
        (F.abs(F.col(f"a.{f}") - F.col(f"b.{f}")) for f in COUNT_FIELDS), start=F.lit(0)
    )
    return joined.agg(
        F.count("*").alias("n"),
        same("time_of_day").alias("time_of_day_agreement"),
        same("weather").alias("weather_agreement"),
        (F.sum(gaps) / (F.count("*") * len(COUNT_FIELDS))).alias("count_mae_between_models"),
    )


def evaluate_labels(
    labels: DataFrame,
    sample: DataFrame,
    annotations: DataFrame,
    model: str,
    visibility_min: int | None = None,
) -> Mapping[str, DataFrame]:
    """The evaluation tables of one model's parsed labels."""
    ok = labels.filter((F.col("parse_status") == "ok") & (F.col("model") == model))
    everything = gt_counts(ok, annotations)
    return {
        "flags": eval_flags(ok, sample),
        "counts_all": eval_counts(ok, everything),
        "counts_visible": eval_counts(ok, gt_counts(ok, annotations, visibility_min)),
        "buckets": eval_buckets(ok, everything),
    }
