"""Queries over image files: written from the suppliers, listed, decoded, embedded.

A supplier is a unit with one image: a bitmap of colours that follow from its key. One in
nine files is junk, and one in seven is referenced but never written.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayframe.functions import pixels
from wayframe.operators import embedding, manifest
from wayframe.plans.proxies import table
from wayframe.plans.registry import query, r6, rounded, view
from wayframe.plans.vectors import _MILLIONTHS_SQL, _millionths
from wayframe.sources import tables as io, vectors
from wayframe.sources.scratch import scratch_path, settings, settle

TOKEN = "sample_data_token"
SIDE = 8
TASK_FILES = 200  # image files that a task writes, about, and that a part has at most
# Image files are small: each counts for 64 KB, not 4 MB, when they are dealt to tasks.
SMALL_FILES = {"spark.sql.files.openCostInBytes": str(1 << 16)}

# Both engines run this; colours stay below 128.
_UNITS = """
    SELECT s_suppkey AS k, 'u' || CAST(s_suppkey AS STRING) AS token, CAST(5 + s_suppkey % 20 AS INT) AS width,
      CAST(4 + s_suppkey % 13 AS INT) AS height, s_suppkey % 9 = 4 AS broken, s_suppkey % 7 = 3 AS absent,
      CASE s_suppkey % 3 WHEN 0 THEN 'CAM_FRONT' WHEN 1 THEN 'CAM_BACK' ELSE 'RADAR_FRONT' END AS channel
    FROM {supplier}"""
view("units", _UNITS)
view("pixels", """
    SELECT *, (k + x + y) % 128 AS b, (k * 5 + y * 11) % 128 AS g, (k * 7 + x * 3) % 128 AS r
    FROM (SELECT *, unnest(range(width)) AS x FROM (SELECT *, unnest(range(height)) AS y FROM {units}
          WHERE NOT broken AND NOT absent))""")


def _units(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "supplier").createOrReplaceTempView("supplier_of_units")
    return spark.sql(_UNITS.replace("{supplier}", "supplier_of_units"))


def _part() -> Column:
    return F.expr(f"k div {TASK_FILES}")


def _folder() -> Column:
    return F.concat(F.lit("part="), _part().cast("string"), F.lit("/channel="), F.col("channel"), F.lit("/unit="), F.col("token"))


def _bitmap() -> Column:
    """A Windows bitmap whose bytes are all below 128, so that a text sink writes them as they are."""

    def number(value, size: int = 4) -> list[Column]:
        return [F.char(value if isinstance(value, Column) else F.lit(value)), *[F.char(F.lit(0))] * (size - 1)]

    # The file size only has to be large enough.
    head = [F.lit("BM"), *[F.char(F.lit(c)) for c in (127, 127, 0, 0)], *number(0), *number(54), *number(40), *number(F.col("width")), *number(F.col("height")),
            *number(1, 2), *number(24, 2), *[c for _ in range(6) for c in number(0)]]
    k = F.col("k")

    def colours(x: Column, y: Column) -> Column:
        return F.concat(F.char((k + x + y) % 128), F.char((k * 5 + y * 11) % 128), F.char((k * 7 + x * 3) % 128))

    pad = F.repeat(F.char(F.lit(0)), F.pmod(-3 * F.col("width"), F.lit(4)))
    lines = F.transform(F.sequence(F.col("height") - 1, F.lit(0)), lambda y: F.concat(
        F.array_join(F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda x: colours(x, y)), ""), pad))
    return F.concat(*head, F.array_join(lines, ""))


def _mounted(spark: SparkSession, root: str) -> str | None:
    """A path that tasks open by themselves, where ``root`` is a folder of the machines' own file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    place = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toUri()
    return place.getPath() if place.getScheme() == "file" else None


def _writer(root: str):
    """The files that Spark's text sink writes: through Hadoop each would cost four processes that set permissions."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                folder = f"{root}/part={row['part']}/channel={row['channel']}/unit={row['unit']}"
                os.makedirs(folder, exist_ok=True)
                draft = f"{folder}/.{uuid.uuid4().hex}"  # hidden from Spark until it is whole
                with open(draft, "wb") as file:
                    file.write(row["value"].encode() + b"\n")
                os.replace(draft, f"{folder}/image")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return write


def _written(spark: SparkSession, d: str) -> tuple[DataFrame, str]:
    """The units, and where the image files of those that have one are."""
    root, units = scratch_path(spark, "images"), _units(spark, d)
    files = units.filter("NOT absent").select(
        _part().alias("part"), "channel", F.col("token").alias("unit"), F.when(F.col("broken"), F.lit("not an image")).otherwise(_bitmap()).alias("value"))
    # A task has whole parts, so that a commit renames a part, not each unit's folder.
    files = files.repartitionByRange(max(8, -(-units.count() // TASK_FILES)), "part")
    mounted = _mounted(spark, root)
    if mounted is None:
        files.write.option("mapreduce.fileoutputcommitter.algorithm.version", "1").partitionBy("part", "channel", "unit").text(root)
    else:
        files.mapInArrow(_writer(mounted), "n long").write.format("noop").mode("overwrite").save()
    return units, root


def _decoded(spark: SparkSession, root: str) -> DataFrame:
    return io.read_images(spark, root).withColumn(TOKEN, F.regexp_extract("path", "/unit=([^/]+)/", 1))


@query("S8 P18", f"""
    WITH grays AS (SELECT k, avg((114 * b + 587 * g + 299 * r + 500) // 1000) AS gray FROM {{pixels}} GROUP BY k)
    SELECT token AS sample_data_token, CASE WHEN NOT broken THEN height END AS height, CASE WHEN NOT broken THEN width END AS width,
      {r6("gray")} AS brightness, (SELECT count(*) FROM {{units}} WHERE broken AND NOT absent) AS n_unreadable
    FROM {{units}} LEFT JOIN grays USING (k) WHERE NOT absent""")
def image_brightness(spark: SparkSession, d: str) -> DataFrame:
    """Bitmaps written from a table, some of them junk, decoded and measured."""
    _, root = _written(spark, d)
    bright = pixels.brightness("height", "width", "n_channels", "data").alias("brightness")
    with settings(spark, SMALL_FILES):
        read = settle(_decoded(spark, root).select(TOKEN, "height", "width", bright), "brightness")
    unreadable = read.filter("height IS NULL").count()
    return rounded(read, "brightness").withColumn("n_unreadable", F.lit(unreadable).cast("long"))


def _manifest(units: DataFrame, root: str) -> DataFrame:
    """Availability of the units' files by a listing of the folders they should be in."""
    spark = units.sparkSession
    listing = io.list_files(units.select(_folder().alias("directory")), root, batch=200)
    listing = listing.select(F.regexp_replace("filename", "/[^/]*$", "").alias("filename"))  # Spark names the files
    sample_data = units.select("token", F.col("token").alias("sample_token"), _folder().alias("filename"), (F.col("k") % 2 == 0).alias("is_key_frame"))
    none = spark.createDataFrame([], "token string, scene_token string, name string")
    return manifest.build_manifest(sample_data, none.select("token", "scene_token"), none.select("token", "name"), listing)


@query("S4 J4 A1", """
    SELECT is_key_frame, count(*) AS n_referenced, count(*) FILTER (NOT absent) AS n_present
    FROM (SELECT *, k % 2 = 0 AS is_key_frame FROM {units}) GROUP BY is_key_frame""")
def listed_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Files on a file system listed by their folders, against those that are referenced."""
    found = _manifest(*_written(spark, d))
    return manifest.summarize(found).groupBy("is_key_frame").agg(
        F.sum("n_referenced").alias("n_referenced"), F.sum("n_present").alias("n_present"))


def _mean_colour():
    """Means of blue, green and red of an image's bytes."""
    return lambda images: [np.frombuffer(i, np.uint8).reshape(-1, 3).mean(axis=0) for i in images]


@query("M1 M2 A26 J5 S8", f"""
    WITH means AS (SELECT k, avg(b) AS b, avg(g) AS g, avg(r) AS r FROM {{pixels}} GROUP BY k)
    SELECT token AS sample_data_token, {_MILLIONTHS_SQL.format("[b, g, r]", "CAST(CAST(x / n AS FLOAT) AS DOUBLE) * 1e6")} AS unit,
      CAST(CASE WHEN m <= {SIDE} THEN width ELSE greatest(1, round_even(width * {SIDE} / m, 0)) END AS INT) AS thumbnail_width,
      CAST(CASE WHEN m <= {SIDE} THEN height ELSE greatest(1, round_even(height * {SIDE} / m, 0)) END AS INT) AS thumbnail_height,
      (SELECT count(*) FROM {{units}} WHERE broken AND NOT absent) AS unreadable, CAST(0 AS BIGINT) AS added_again
    FROM (SELECT *, greatest(width, height) AS m, sqrt(b * b + g * g + r * r) AS n FROM {{units}} JOIN means USING (k))""")
def image_embedding_job(spark: SparkSession, d: str) -> DataFrame:
    """Images that are present, embedded with thumbnails into a store; a second run adds nothing."""
    units, root = _written(spark, d)
    # Both runs read tokens and pixels: files are opened and decoded once.
    with settings(spark, SMALL_FILES):
        frames = settle(_decoded(spark, root).withColumn("scene_name", F.lit("scene-0")), "decoded")
    store, embedder = scratch_path(spark, "image-store"), embedding.FunctionEmbedder(_mean_colour, 3, "colour")
    options = dict(manifest=_manifest(units, root), thumbnail_side=SIDE)
    first = embedding.run_embedding(frames, embedder, "data", store, **options)
    again = embedding.run_embedding(frames, embedder, "data", store, **options)

    def side(start: int) -> Column:
        return F.conv(F.hex(F.substring("thumbnail", start, 4)), 16, 10).cast("int")

    return vectors.open_store(spark, store).select(
        TOKEN, _millionths("vector").alias("unit"), side(17).alias("thumbnail_width"), side(21).alias("thumbnail_height"),
        F.lit(first["unreadable"]).cast("long").alias("unreadable"), F.lit(again["frames_added"]).cast("long").alias("added_again"))
