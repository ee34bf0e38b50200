"""Relational scene metadata to the two flat analytics tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wayframe.functions import geometry, paths, taxonomy
from wayframe.functions.conditions import with_flags
from wayframe.operators.sampling import first_scenes

CONTEXT = (
    "scene_token", "scene_name", "scene_description", "log_token", "location",
    "is_night", "is_rain",
)


def scene_context(scene: DataFrame, log: DataFrame) -> DataFrame:
    """One row per scene with its location and condition flags."""
    scenes = scene.select(
        F.col("token").alias("scene_token"),
        F.col("name").alias("scene_name"),
        F.col("description").alias("scene_description"),
        "log_token",
    )
    places = log.select(F.col("token").alias("log_token"), "location")
    return with_flags(scenes.join(places, "log_token")).select(*CONTEXT)


def camera_images(
    sample_data: DataFrame,
    sample: DataFrame,
    context: DataFrame,
    cameras: Sequence[str] = taxonomy.CAMERAS,
) -> DataFrame:
    """Camera keyframes with their scene context.

    The linked list of keyframes per scene needs no traversal: each sample names its scene.
    """
    keyframes = (
        sample_data.filter("is_key_frame")
        .withColumn("channel", paths.channel(F.col("filename")))
        .filter(F.col("channel").isin(*cameras))
        .select(
            F.col("token").alias("sample_data_token"), "sample_token", "channel", "filename",
            "width", "height", "timestamp",
        )
    )
    scene_of = sample.select(F.col("token").alias("sample_token"), "scene_token")
    return keyframes.join(scene_of.join(context, "scene_token"), "sample_token")


def kept_boxes(
    boxes: DataFrame, *, visibility_min: int = 1, min_area: float = 0.0
) -> DataFrame:
    """Boxes on the image that pass the visibility and area floors."""
    return (
        boxes.filter(geometry.visibility_at_least(F.col("visibility_token"), visibility_min))
        .filter(F.col("x_min").isNotNull())
        .withColumn(
            "bbox_area",
            geometry.area(*[F.col(c) for c in ("x_min", "y_min", "x_max", "y_max")]),
        )
        .filter(F.col("bbox_area") >= min_area)
    )


def flatten(
    scene: DataFrame,
    log: DataFrame,
    sample: DataFrame,
    sample_data: DataFrame,
    boxes: DataFrame,
    *,
    cameras: Sequence[str] = taxonomy.CAMERAS,
    visibility_min: int = 1,
    min_area: float = 0.0,
    limit_scenes: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Return ``(samples, annotations)``: one row per camera keyframe, one per kept box.

    ``boxes`` holds image-plane boxes per ``sample_data_token`` (see :func:`image_boxes`).
    Box counts are aggregated before they meet the images, so a frame with very many
    boxes costs one row in that join.
    """
    context = first_scenes(scene_context(scene, log), limit_scenes)
    images = camera_images(sample_data, sample, context, cameras)
    kept = kept_boxes(boxes, visibility_min=visibility_min, min_area=min_area)

    annotations = kept.join(
        images.select("sample_data_token", "sample_token", "channel", *CONTEXT),
        "sample_data_token",
    ).select(
        "annotation_token", "sample_data_token", "sample_token", "channel", "category_name",
        taxonomy.category_group(F.col("category_name")).alias("category_group"),
        "visibility_token", "num_lidar_pts", "num_radar_pts",
        "x_min", "y_min", "x_max", "y_max", "bbox_area", *CONTEXT,
    )
    counts = kept.groupBy("sample_data_token").agg(F.count("*").alias("n_boxes"))
    samples = images.join(counts, "sample_data_token", "left").select(
        "sample_data_token", "sample_token", "channel", "filename", "width", "height",
        "timestamp", F.coalesce("n_boxes", F.lit(0)).alias("n_boxes"), *CONTEXT,
    )
    return samples, annotations


def camera_boxes(
    annotation: DataFrame,
    instance: DataFrame,
    category: DataFrame,
    sample_data: DataFrame,
    ego_pose: DataFrame,
    calibrated_sensor: DataFrame,
    cameras: Sequence[str] = taxonomy.CAMERAS,
) -> DataFrame:
    """3D annotations of each camera keyframe, moved into that camera's frame."""
    named = instance.select(F.col("token").alias("instance_token"), "category_token").join(
        category.select(
            F.col("token").alias("category_token"), F.col("name").alias("category_name")
        ),
        "category_token",
    )

    def pose(df: DataFrame, key: str, prefix: str, *extra: str) -> DataFrame:
        return df.select(
            F.col("token").alias(key),
            F.col("translation").alias(f"{prefix}_t"),
            F.col("rotation").alias(f"{prefix}_q"),
            *extra,
        )

    views = (
        sample_data.filter("is_key_frame")
        .filter(paths.channel(F.col("filename")).isin(*cameras))
        .select(
            F.col("token").alias("sample_data_token"), "sample_token", "ego_pose_token",
            "calibrated_sensor_token", "width", "height",
        )
        .join(pose(ego_pose, "ego_pose_token", "ego"), "ego_pose_token")
        .join(
            pose(calibrated_sensor, "calibrated_sensor_token", "sensor", "camera_intrinsic"),
            "calibrated_sensor_token",
        )
    )
    moved = geometry.to_camera_frame(
        "translation", "rotation", "ego_t", "ego_q", "sensor_t", "sensor_q"
    )
    return (
        annotation.join(views, "sample_token")
        .join(named, "instance_token")
        .withColumn("_moved", moved)
        .select(
            F.col("token").alias("annotation_token"), "sample_data_token", "category_name",
            "visibility_token", "num_lidar_pts", "num_radar_pts",
            F.col("_moved.center").alias("center"), "size",
            F.col("_moved.rotation").alias("rotation"),
            "camera_intrinsic", "width", "height",
        )
    )


def image_boxes(boxes: DataFrame, *, clip: bool = True, min_z: float = 0.1) -> DataFrame:
    """Project camera-frame boxes to image-plane ``x_min..y_max`` (NULL when invisible)."""
    box = geometry.project_box(clip=clip, min_z=min_z)(
        "center", "size", "rotation", "camera_intrinsic", "width", "height"
    )
    corners = ("x_min", "y_min", "x_max", "y_max")
    return (
        boxes.withColumn("_box", box)
        .select("*", *[F.col(f"_box.{c}").alias(c) for c in corners])
        .drop("_box", "center", "size", "rotation", "camera_intrinsic", "width", "height")
    )
