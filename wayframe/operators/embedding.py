"""Turning frames into vectors: pluggable embedders and the resumable batch job."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation, functions as F, types as T

from wayframe.functions.pixels import thumbnail
from wayframe.functions.vectors import EPSILON
from wayframe.operators.manifest import not_done, only_present
from wayframe.sources import vectors

STORED = (
    "sample_data_token", "sample_token", "scene_token", "scene_name", "scene_description",
    "channel", "filename", "timestamp", "location", "is_night", "is_rain", "n_boxes", "thumbnail",
)


class Embedder(Protocol):
    """Maps a column to unit ``vector``s of ``dim`` floats in one shared space."""

    dim: int
    name: str

    def embed(self, df: DataFrame, column: str) -> DataFrame: ...
IMAGE_COLUMNS = ("height", "width", "n_channels", "data")


@dataclass(frozen=True)
class HashedTextEmbedder:
    """Hashed token frequencies of a text column, all inside the JVM."""

    dim: int = 64
    name: str = "hashed-text"

    def embed(self, df: DataFrame, column: str) -> DataFrame:
        text = df.withColumn("_text", F.coalesce(F.col(column), F.lit("")))
        steps = [
            RegexTokenizer(inputCol="_text", outputCol="_tokens", pattern=r"[^\p{L}\p{N}]+"),
            HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=self.dim),
            Normalizer(inputCol="_tf", outputCol="_unit"),
        ]
        for step in steps:
            text = step.transform(text)
        vector = vector_to_array("_unit", "float32")
        return text.withColumn("vector", vector).drop("_text", "_tokens", "_tf", "_unit")


@dataclass(frozen=True)
class FunctionEmbedder:
    """A user model: ``load()`` returns a function from a list of values to a matrix.

    The model is loaded once per task and called on Arrow batches.
    """

    load: Callable[[], Callable[[list], np.ndarray]]
    dim: int
    name: str

    def embed(self, df: DataFrame, column: str) -> DataFrame:
        load = self.load

        @F.pandas_udf(T.ArrayType(T.FloatType()))
        def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for part in parts:
                raw = np.asarray(model(part.tolist()), dtype=np.float64)
                unit = raw / np.maximum(np.linalg.norm(raw, axis=-1, keepdims=True), EPSILON)
                yield pd.Series(list(unit.astype(np.float32)))

        return df.withColumn("vector", encode(F.col(column)))


def _stored_rows(todo: DataFrame, embedder: Embedder, column: str, thumbnail_side: int | None = None) -> DataFrame:
    embedded = embedder.embed(todo.filter(F.col(column).isNotNull()), column)
    if thumbnail_side is not None:
        embedded = embedded.withColumn("thumbnail", thumbnail(*IMAGE_COLUMNS, thumbnail_side))
    kept = [F.col(c) for c in STORED if c in embedded.columns and c != "n_boxes"]
    if "n_boxes" in embedded.columns:
        kept.append(F.col("n_boxes").cast("int").alias("n_boxes"))
    return embedded.select("vector", *kept)


def embed_frames(
    frames: DataFrame,
    embedder: Embedder,
    column: str,
    *,
    manifest: DataFrame | None = None,
    done: DataFrame | None = None,
) -> DataFrame:
    """Store rows for the frames that are present and not stored yet.

    A frame whose input is NULL (an unreadable image) is left out.
    """
    present = only_present(frames, manifest)
    todo = present if done is None else not_done(present, done)
    return _stored_rows(todo, embedder, column)


def run_embedding(
    frames: DataFrame,
    embedder: Embedder,
    column: str,
    store: str,
    *,
    manifest: DataFrame | None = None,
    rebuild: bool = False,
    thumbnail_side: int | None = None,
) -> dict[str, int]:
    """Append the missing frames to a vector store; return what was done.

    With ``thumbnail_side`` the frames carry decoded images (``IMAGE_COLUMNS``), of which a
    PNG with sides up to that length is stored.

    Scenes are counted as processed or skipped (nothing left to do), from tokens alone; the
    added and the unreadable rows are counted by the write itself, so that the input column
    is read once.
    """
    spark = frames.sparkSession
    if rebuild:
        vectors.drop_store(spark, store)
    present = only_present(frames, manifest)
    marked = present.withColumn("_done", F.lit(False))
    todo = present
    if vectors.store_exists(spark, store):
        done = vectors.open_store(spark, store).select("sample_data_token")
        mark = done.withColumn("_stored", F.lit(True))
        marked = present.join(mark, "sample_data_token", "left")
        marked = marked.withColumn("_done", F.col("_stored").isNotNull())
        todo = not_done(present, done)
    per_scene = marked.groupBy("scene_name").agg(F.count_if(~F.col("_done")).alias("todo"))
    plan = per_scene.agg(
        F.count_if(F.col("todo") > 0).alias("busy"), F.count("*").alias("scenes")).first()
    seen, given = Observation("embedding"), Observation("embedding-input")
    todo = todo.observe(given, F.count_if(F.col(column).isNull()).alias("unreadable"))
    rows = _stored_rows(todo, embedder, column, thumbnail_side).observe(seen, F.count("*").alias("added"))
    vectors.append(rows, store)
    return {
        "scenes_processed": plan["busy"],
        "scenes_skipped": plan["scenes"] - plan["busy"],
        "frames_added": seen.get["added"],
        "unreadable": given.get["unreadable"],
        "total": vectors.open_store(spark, store).count(),
    }
