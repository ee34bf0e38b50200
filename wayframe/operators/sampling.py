"""Stratified samples, the baseline/pool split and experiment arms."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wayframe.functions.conditions import STRATUM_COLUMNS, stratum_label
from wayframe.operators.draw import allocate, draw, draw_n
from wayframe.operators.manifest import only_present
from wayframe.sources.scratch import settle

log = logging.getLogger("wayframe")

ARMS = ("baseline", "mined", "random")


def stratum_counts(frames: DataFrame, keys: Sequence[str] = STRATUM_COLUMNS) -> DataFrame:
    return frames.groupBy(*keys).agg(F.count("*").alias("n"))


def quotas_for(
    frames: DataFrame, keys: Sequence[str], total: int, floor: int
) -> DataFrame:
    """Allocate ``total`` over the strata of ``frames``.

    The quotas stay in the plan: one row per stratum, however many there are.
    """
    return allocate(stratum_counts(frames, keys), keys, total, floor)


def stratified_draw(
    frames: DataFrame, keys: Sequence[str], total: int, floor: int, token: str, seed: int
) -> DataFrame:
    """``total`` rows, proportional over the strata with a floor per stratum."""
    return draw(frames, keys, quotas_for(frames, keys, total, floor), token, seed)


def labelling_sample(
    samples: DataFrame,
    manifest: DataFrame | None = None,
    *,
    channel: str = "CAM_FRONT",
    size: int = 5000,
    floor: int = 250,
    subset_size: int = 500,
    subset_floor: int = 25,
    seed: int = 6,
) -> DataFrame:
    """Stratified labelling sample with a nested comparison subset.

    Adds ``stratum`` and ``in_subset``; the subset is drawn from the sample by the same
    rule with the next seed.
    """
    frames = only_present(samples.filter(F.col("channel") == channel), manifest)
    frames = settle(frames, "frames")
    keys, token = list(STRATUM_COLUMNS), "sample_data_token"
    sample = settle(stratified_draw(frames, keys, size, floor, token, seed), "sample")
    subset = stratified_draw(sample, keys, subset_size, subset_floor, token, seed + 1)
    marked = subset.select(token, F.lit(True).alias("in_subset"))
    return sample.join(marked, token, "left").select(
        *[c for c in sample.columns],
        F.coalesce("in_subset", F.lit(False)).alias("in_subset"),
        stratum_label(*[F.col(c) for c in STRATUM_COLUMNS]).alias("stratum"),
    )


def scene_rollup(samples: DataFrame) -> DataFrame:
    """Per scene: its night flag and frame count."""
    return samples.groupBy("scene_name").agg(
        F.bool_or("is_night").alias("is_night"), F.count("*").alias("n_frames")
    )


def split_baseline_pool(scenes: DataFrame, frac: float = 0.25, seed: int = 64) -> DataFrame:
    """Give every scene the role ``baseline`` or ``pool``, stratified by night.

    Each night stratum contributes ``max(1, round(n * frac))`` baseline scenes, rounding
    half to even.
    """
    share = F.greatest(F.lit(1), F.bround(F.col("n") * F.lit(frac)).cast("long"))
    quotas = scenes.groupBy("is_night").agg(F.count("*").alias("n"))
    quotas = quotas.select("is_night", share.alias("quota"))
    baseline = draw(scenes, ["is_night"], quotas, "scene_name", seed)
    picked = baseline.select("scene_name", F.lit("baseline").alias("role"))
    return scenes.join(picked, "scene_name", "left").withColumn(
        "role", F.coalesce("role", F.lit("pool"))
    )


def role_totals(split: DataFrame) -> DataFrame:
    return split.groupBy("role").agg(
        F.count("*").alias("n_scenes"),
        F.sum("n_frames").alias("n_frames"),
        F.count_if("is_night").alias("n_night"),
    )


def frames_with_role(samples: DataFrame, split: DataFrame, role: str, channel: str) -> DataFrame:
    """Tokens of one camera's frames in the scenes of a role."""
    scenes = split.filter(F.col("role") == role).select("scene_name")
    frames = samples.filter(F.col("channel") == channel)
    return frames.join(scenes, "scene_name", "left_semi").select("sample_data_token")


def arm_frames(baseline: DataFrame, extra: DataFrame | None, arm: str) -> DataFrame:
    """Training tokens of one experiment arm: the baseline plus the arm's own frames."""
    if arm not in ARMS:
        raise ValueError(f"unknown arm {arm!r}, expected one of {ARMS}")
    tokens = baseline.select("sample_data_token")
    if arm == "baseline":
        return tokens.distinct()
    return tokens.union(extra.select("sample_data_token")).distinct()


def first_scenes(frames: DataFrame, n: int | None, name: str = "scene_name") -> DataFrame:
    """Keep the frames of the first n scenes by name (all when n is None)."""
    if n is None:
        return frames
    return frames.join(frames.select(name).distinct().orderBy(name).limit(n), name, "left_semi")


def random_control(pool: DataFrame, n: int, seed: int) -> DataFrame:
    """Uniform draw of n pool tokens, the control for mining."""
    return draw_n(pool.select("sample_data_token"), n, "sample_data_token", seed)


def require_subset(part: DataFrame, whole: DataFrame, token: str, message: str) -> None:
    """Raise when some token of ``part`` is not in ``whole``."""
    if not part.join(whole, token, "left_anti").isEmpty():
        raise AssertionError(message)


def require_disjoint(a: DataFrame, b: DataFrame, token: str, message: str) -> None:
    """Raise when the two frames share a token."""
    if not a.join(b, token, "left_semi").isEmpty():
        raise AssertionError(message)
