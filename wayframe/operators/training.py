"""Training-set export: split assignment, frame selection and label text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wayframe.functions import geometry, paths, taxonomy
from wayframe.functions.conditions import SLICES, slice_members
from wayframe.operators.sampling import first_scenes


def with_split(samples: DataFrame, splits: DataFrame) -> DataFrame:
    """Add each frame's official ``split`` by scene name; unmapped scenes are dropped."""
    return samples.join(splits.select("scene_name", "split"), "scene_name")


def train_filter(frames: DataFrame, train_frames: DataFrame | None) -> DataFrame:
    """Keep listed frames of the train split and every frame of any other split."""
    if train_frames is None:
        return frames
    listed = train_frames.select("sample_data_token").distinct().withColumn("_in", F.lit(True))
    marked = frames.join(listed, "sample_data_token", "left")
    return marked.filter((F.col("split") != "train") | F.col("_in")).drop("_in")


def export_frames(
    samples: DataFrame,
    splits: DataFrame,
    *,
    cameras: Sequence[str] | None = None,
    limit_scenes: int | None = None,
    train_frames: DataFrame | None = None,
) -> DataFrame:
    """Frames of a training set with their split."""
    frames = with_split(samples, splits)
    if cameras:
        frames = frames.filter(F.col("channel").isin(*cameras))
    return train_filter(first_scenes(frames, limit_scenes), train_frames)


def label_lines(
    frames: DataFrame, annotations: DataFrame, order: str = "annotation_token"
) -> DataFrame:
    """One row per label line ``split, stem, position, line`` of the exported frames.

    Row form of the label files: nothing is gathered per image, so it can be written
    sorted by (stem, position) whatever the number of boxes in an image.
    """
    boxes = annotations.filter(F.col("category_group").isNotNull()).select(
        "sample_data_token",
        F.col(order).alias("position"),
        geometry.label_line(taxonomy.class_index(F.col("category_group"))).alias("line"),
    )
    where = frames.select(
        "sample_data_token", "split", paths.stem(F.col("filename")).alias("stem")
    )
    return boxes.join(where, "sample_data_token").select("split", "stem", "position", "line")


def label_table(
    frames: DataFrame, annotations: DataFrame, order: str = "annotation_token"
) -> DataFrame:
    """One label text per exported image, empty for images without boxes.

    A row is one image's label file, so its boxes meet in one place by definition.
    """
    lines = label_lines(frames, annotations, order).groupBy("split", "stem").agg(
        F.count("*").alias("n_boxes"),
        F.array_sort(F.collect_list(F.struct("position", "line"))).alias("_lines"),
    )
    text = F.array_join(F.transform("_lines", lambda x: x["line"]), "\n")
    texts = lines.select("split", "stem", "n_boxes", text.alias("label_text"))
    images = frames.select("split", paths.stem(F.col("filename")).alias("stem"))
    return images.join(texts, ["split", "stem"], "left").select(
        "split", "stem",
        F.coalesce("label_text", F.lit("")).alias("label_text"),
        F.coalesce("n_boxes", F.lit(0)).alias("n_boxes"),
    )


def export_stats(labels: DataFrame) -> DataFrame:
    """One row: train images, val images and boxes."""
    return labels.agg(
        F.count_if(F.col("split") == "train").alias("train_images"),
        F.count_if(F.col("split") == "val").alias("val_images"),
        F.coalesce(F.sum("n_boxes"), F.lit(0)).alias("boxes"),
    )


def slice_images(frames: DataFrame, config=SLICES) -> DataFrame:
    """Validation images per condition slice: ``dim, slice, filename``."""
    val = frames.filter(F.col("split") == "val").select("filename", "scene_description")
    tagged = slice_members(val, config)
    return tagged.select(
        F.substring_index("slice", "/", 1).alias("dim"),
        F.substring_index("slice", "/", -1).alias("slice"),
        "filename",
    )
