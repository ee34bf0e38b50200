"""Reading and writing tables."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Mapping
from contextlib import AbstractContextManager
from itertools import islice
from multiprocessing.pool import ThreadPool
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from wayframe import schemas
from wayframe.sources.scratch import scratch_path, settings, settle

LISTERS = 8  # blocks of directories that are listed at a time
LISTED = 50_000  # names that the driver gathers before it writes them
# Capture-log names of the drift features.
CAPTURE_RENAMES = {"image_width": "width", "image_height": "height", "n_detections": "n_boxes"}


def read_metadata(spark: SparkSession, root: str, version: str, table: str) -> DataFrame:
    """One raw metadata table: a JSON array of objects, with its declared schema."""
    path = f"{root.rstrip('/')}/{version}/{table}.json"
    return spark.read.schema(schemas.METADATA[table]).option("multiLine", True).json(path)


def read_columns(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Some columns of a Parquet table; only those are read."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Write Parquet and return the row count, observed by the write itself."""
    seen = Observation("write")
    counted = df.observe(seen, F.count("*").alias("n"))
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return seen.get["n"]


def write_summary(df: DataFrame, path: str) -> None:
    """Write an already aggregated frame as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A drift feature table: Parquet, or a capture log when the name ends in .jsonl."""
    if path.endswith(".jsonl"):
        return spark.read.schema(schemas.CAPTURE).json(path).withColumnsRenamed(CAPTURE_RENAMES)
    return spark.read.parquet(path)


def _listing_tasks(spark: SparkSession) -> AbstractContextManager[None]:
    """Directories are listed by some tasks for each core; Spark's own number is a task for each directory, up to 10,000."""
    tasks, found = max(LISTERS, 2 * spark.sparkContext.defaultParallelism), "spark.sql.sources.parallelPartitionDiscovery"
    return settings(spark, {f"{found}.parallelism": str(tasks), f"{found}.threshold": str(LISTERS)})


def _pattern(base: str, directories: list[str]) -> str:
    """A Hadoop pattern of directories below ``base``.

    Each choice has a slash, so that it is looked up by its name and no directory is searched
    for it. Expanding the choices takes one level of escapes.
    """

    def literal(path: str) -> str:
        return re.sub(r"([\\{}\[\]*?,^])", r"\\\1", path)

    choices = (re.sub(r"([\\{},])", r"\\\1", literal(d)) + "/" for d in directories)
    return f"{literal(base)}/{{{','.join(choices)}}}"


def list_files(directories: DataFrame, root: str, batch: int = 1000) -> DataFrame:
    """Files of each relative ``directory`` under ``root``, on any file system, as ``filename``.

    Directories are listed in blocks of ``batch`` by Spark's own parallel listing, which
    looks at names alone (empty files included). LISTERS blocks are under way at a time, and
    names go to a table whenever the driver holds LISTED of them. A directory's files are its own, not those of
    directories below it (which are walked all the same); one that does not exist has none. Names that begin with a dot or an
    underscore are hidden from Spark and are not listed.
    """
    spark = directories.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    base = system.makeQualified(where).toString().rstrip("/")
    skip = len(system.makeQualified(where).toUri().getPath().rstrip("/")) + 1
    out = scratch_path(spark, "listing")
    spark.createDataFrame([], "filename string").write.parquet(out)

    def files_in(block: list[str]) -> set[str]:
        try:  # all directories are looked up by one call
            below = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(_pattern(base, block))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":  # none of them exists
                raise
            return set()
        # In one text instead of one call for each name; names are encoded as in a URI.
        names = spark._jvm.org.apache.hadoop.util.StringUtils.join("\n", below._jdf.inputFiles())
        files = {unquote(re.sub("^[^/]*(//[^/]*)?", "", n))[skip:] for n in names.split("\n")}
        wanted = {*block}
        return {f for f in files if posixpath.dirname(f) in wanted}

    def write(files: list[str]) -> None:
        listed = pa.table({"filename": pa.array(files, pa.string())})
        spark.createDataFrame(listed).write.mode("append").parquet(out)

    names = (r["directory"] for r in directories.select("directory").distinct().toLocalIterator())
    # Another spelling of a directory is not the name of any file's directory.
    names = (d for d in names if d is not None and posixpath.normpath(f"/{d}") == f"/{d}")
    files: list[str] = []
    with _listing_tasks(spark), ThreadPool(LISTERS) as listers:
        while wave := list(islice(names, batch * LISTERS)):
            for found in listers.imap(files_in, [wave[i:i + batch] for i in range(0, len(wave), batch)]):
                files.extend(found)
            if len(files) >= LISTED:
                write(files)
                files = []
    if files:
        write(files)
    return spark.read.schema("filename string").parquet(out)


def read_label_results(
    spark: SparkSession, path: str, batches: DataFrame,
    files: str = "*.jsonl", batch: str = r"([^/]+)\.jsonl$",
) -> DataFrame:
    """Raw label results with their model and place: ``path, position`` order the lines.

    Files are split like any text, however long. A line's position is where its split
    starts and its number inside the split, which is the order of lines in the file.
    ``batches`` maps ``batch_id`` to ``model``; an unknown one is ``?``. ``batch`` is where a
    file's path has its id, the stem of a .jsonl file unless told otherwise.
    """
    place = F.struct(
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    lines = spark.read.text(path, pathGlobFilter=files, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), place.alias("position"), "value"
    )
    record = F.from_json("value", schemas.LABEL_RESULT)
    raw = lines.filter(F.trim("value") != "").select("path", "position", record.alias("r"))
    stem = F.regexp_extract("path", batch, 1)
    raw = raw.select("r.*", "path", "position", stem.alias("batch_id"))
    # Written, so that its measured size decides: a few batches must not deal the lines out.
    known = settle(batches.select("batch_id", "model"), "batches")
    return raw.join(known, "batch_id", "left").withColumn(
        "model", F.coalesce("model", F.lit("?"))
    )


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images ``path, height, width, n_channels, data``; unreadable ones are NULL."""
    image = F.col("image")
    readable = image["width"] > 0
    columns = {"height": "height", "width": "width", "nChannels": "n_channels", "data": "data"}
    with _listing_tasks(spark):
        images = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(path)
    return images.select(
        image["origin"].alias("path"),
        *[F.when(readable, image[k]).alias(v) for k, v in columns.items()],
    )


def write_label_files(labels: DataFrame, path: str) -> None:
    """Label texts partitioned by split."""
    labels.write.mode("overwrite").partitionBy("split").parquet(path)


def write_slice_lists(images: DataFrame, path: str) -> None:
    """One folder of image lists per ``dim`` and ``slice``; empty slices get none."""
    images.select("dim", "slice", F.col("filename").alias("value")).write.mode(
        "overwrite"
    ).partitionBy("dim", "slice").text(path)


def register_views(spark: SparkSession, tables: Mapping[str, str]) -> list[str]:
    """Register a SQL view per (name, Parquet path) that can be read; return the names."""
    made = []
    for name, path in tables.items():
        try:
            spark.read.parquet(path).createOrReplaceTempView(name)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":  # anything but one that is not built yet
                raise
            continue
        made.append(name)
    return made


def query(spark: SparkSession, sql: str, root: str) -> DataFrame:
    """Run SQL over the processed tables under ``root``."""
    names = ("samples", "annotations", "availability")
    register_views(spark, {n: f"{root.rstrip('/')}/{n}.parquet" for n in names})
    return spark.sql(sql)
