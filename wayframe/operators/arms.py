"""Comparing the arms of a training experiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BASELINE = "baseline"
COMPARED = ("overall_map50_95", "night_map50_95")


def upsert_arm(results: DataFrame | None, record: DataFrame) -> DataFrame:
    """Results with one arm's row added or replaced.

    Raises when another arm was evaluated on a different number of validation images.
    """
    if results is None:
        return record
    others = results.join(record.select("arm"), "arm", "left_anti")
    merged = others.unionByName(record)
    sizes = merged.agg(F.count_distinct("val_images"), F.collect_set("val_images")).first()
    if sizes[0] > 1:
        raise AssertionError(f"arms were evaluated on different validation sets: {sizes[1]}")
    return merged


def arm_report(results: DataFrame) -> DataFrame:
    """Each arm with its change against the baseline, NULL for the baseline itself."""
    everything = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )  # one row per arm
    is_baseline = F.col("arm") == BASELINE
    deltas = {}
    for metric in COMPARED:
        base = F.max(F.when(is_baseline, F.col(metric))).over(everything)
        name = "d_" + metric.removesuffix("_map50_95")
        deltas[name] = F.when(~is_baseline, F.col(metric) - base)
    return results.withColumns(deltas)
