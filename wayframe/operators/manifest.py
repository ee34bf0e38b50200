"""Which referenced sensor files exist."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, functions as F

from wayframe.functions import paths

log = logging.getLogger("wayframe")


def build_manifest(
    sample_data: DataFrame, sample: DataFrame, scene: DataFrame, listing: DataFrame
) -> DataFrame:
    """One row per referenced file with its scene and whether it was listed.

    ``listing`` has one row per file found, in the same relative form as ``filename``.
    Scene columns default to the empty string when the reference does not resolve.
    """
    scene_of = sample.select(F.col("token").alias("sample_token"), "scene_token")
    named = scene.select(F.col("token").alias("scene_token"), F.col("name").alias("scene_name"))
    listed = listing.select("filename").distinct().withColumn("_listed", F.lit(True))
    path = F.col("filename")
    return (
        sample_data.join(scene_of.join(named, "scene_token", "left"), "sample_token", "left")
        .join(listed, "filename", "left")
        .select(
            F.col("token").alias("sample_data_token"),
            path,
            paths.channel(path).alias("channel"),
            paths.modality(paths.channel(path)).alias("modality"),
            "is_key_frame",
            F.coalesce("scene_token", F.lit("")).alias("scene_token"),
            F.coalesce("scene_name", F.lit("")).alias("scene_name"),
            F.col("_listed").isNotNull().alias("present"),
        )
    )


def summarize(manifest: DataFrame) -> DataFrame:
    """Referenced and present files per channel and keyframe flag."""
    return manifest.groupBy("channel", "is_key_frame").agg(
        F.count("*").alias("n_referenced"), F.count_if("present").alias("n_present")
    )


def keyframe_gate(manifest: DataFrame, modality: str = "cam") -> DataFrame:
    """One row: is every referenced keyframe of a modality present (true when none is)."""
    wanted = manifest.filter((F.col("modality") == modality) & F.col("is_key_frame"))
    return wanted.agg(F.coalesce(F.bool_and("present"), F.lit(True)).alias("complete"))


def only_present(frames: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Frames whose file is present; without a manifest, all of them with a warning."""
    if manifest is None:
        log.warning("no availability manifest: trusting the metadata's file references")
        return frames
    found = manifest.filter("present").select("sample_data_token", "present")
    return frames.join(found, "sample_data_token")


def not_done(frames: DataFrame, done: DataFrame, token: str = "sample_data_token") -> DataFrame:
    """Frames that a previous run has not stored yet."""
    return frames.join(done.select(token), token, "left_anti")
