"""Queries that write the driving tables out as files and read them back through the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayframe.operators import flatten as flat, labelling, training
from wayframe.operators.fingerprint import build_if_changed, build_key
from wayframe.plans import labelling as _  # noqa: F401  its twins
from wayframe.plans.metadata import MIN_AREA, exported, flat_tables, label_files
from wayframe.plans.proxies import table
from wayframe.plans.registry import TWINS, query, r6, rounded
from wayframe.sources import tables as io
from wayframe.sources.scratch import scratch_path, settle
from wayframe.streaming import capture as streams


FILE_ROWS = 50_000  # of a JSON array, about
LINE_ROWS = 200_000  # of a file of JSON lines, about


def _json_arrays(df: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """Write a table as files of one JSON array of objects each, more files for more rows."""
    files = max(8, -(-df.count() // file_rows))
    rows = df.select(F.to_json(F.struct(*df.columns)).alias("row"), F.pmod(F.xxhash64("token"), F.lit(files)).alias("file"))
    arrays = rows.repartition(files, "file").groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("row"), ",\n"), F.lit("]")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


@query("S1 J1", "SELECT * FROM {samples}")
def metadata_from_json(spark: SparkSession, d: str) -> DataFrame:
    """Raw metadata written as JSON arrays, read with its declared schemas and flattened."""
    root, names = scratch_path(spark, "metadata"), ("scene", "log", "sample", "sample_data")
    for name in names:
        _json_arrays(table(spark, d, name), f"{root}/v1/{name}.json")
    raw = [io.read_metadata(spark, root, "v1", name) for name in names]
    return flat.flatten(*raw, table(spark, d, "boxes"), min_area=MIN_AREA)[0]


@query("S2 S3", """
    SELECT sample_data_token, n_boxes, (SELECT count(*) FROM {samples}) AS n_written FROM {samples}""")
def written_table(spark: SparkSession, d: str) -> DataFrame:
    """A table written with its observed row count, and two of its columns read back."""
    path = scratch_path(spark, "samples")
    n = io.write_table(flat_tables(spark, d)[0], path)
    return io.read_columns(spark, path, "sample_data_token", "n_boxes").withColumn("n_written", F.lit(n).cast("long"))


@query("S10 A16", TWINS["label_files"])
def written_label_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "label-files")
    io.write_label_files(label_files(spark, d), path)
    return spark.read.schema("stem string, label_text string, n_boxes long, split string").parquet(path).select(
        "split", "stem", "label_text", "n_boxes")


@query("S11 P2", TWINS["slice_image_lists"])
def written_slice_lists(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "slice-lists")
    io.write_slice_lists(training.slice_images(exported(spark, d)), path)
    return spark.read.schema("value string, dim string, slice string").text(path).select(
        "dim", "slice", F.col("value").alias("filename"))


@query("S12", f"""
    SELECT channel, count(*) AS images, {r6("avg(n_boxes)")} AS mean_boxes FROM {{samples}} GROUP BY channel""")
def written_summary(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "summary")
    summary = flat_tables(spark, d)[0].groupBy("channel").agg(F.count("*").alias("images"), F.avg("n_boxes").alias("mean_boxes"))
    io.write_summary(rounded(summary, "mean_boxes"), path)
    return spark.read.schema("channel string, images long, mean_boxes double").json(path)


@query("A19 A18", """
    SELECT count(*) AS n_rows, false AS first_skipped, true AS second_skipped, false AS changed_skipped FROM {samples}""")
def build_skipped(spark: SparkSession, d: str) -> DataFrame:
    """A build runs, is skipped while nothing changed, and runs again for another option."""
    path, samples = scratch_path(spark, "build"), settle(flat_tables(spark, d)[0], "samples")

    def run(floor: int) -> tuple[dict, bool]:
        key = build_key({"samples": samples}, {"floor": floor})
        return build_if_changed(spark, key, path, lambda to: {"n_rows": io.write_table(samples, f"{to}-{floor}")})

    (stats, first), (_, second), (_, changed) = run(1), run(1), run(2)
    return spark.range(1).select(
        F.lit(stats["n_rows"]).cast("long").alias("n_rows"), F.lit(first).alias("first_skipped"),
        F.lit(second).alias("second_skipped"), F.lit(changed).alias("changed_skipped"))


@query("S7 P21 P22 P23 W8", TWINS["collected_labels"])
def labels_from_files(spark: SparkSession, d: str) -> DataFrame:
    """Label results written as JSON lines, a folder per batch, and collected from there."""
    path, results = scratch_path(spark, "results"), settle(table(spark, d, "results"), "raw-results")
    parts = max(8, -(-results.count() // LINE_ROWS))
    lines = results.withColumnRenamed("path", "batch").repartitionByRange(parts, "batch", "position").sortWithinPartitions("batch", "position")
    lines = lines.select("custom_id", "result_type", "stop_reason", "text", "error_type", "batch")
    lines.write.partitionBy("batch").option("compression", "gzip").json(path)
    batches = results.select(F.col("path").alias("batch_id"), "model").distinct()
    return labelling.collect_labels(io.read_label_results(spark, path, batches, "*.json.gz", r"/batch=([^/]+)/"))


@query("ST1", f"""
    SELECT model_version, count(*) AS n, CAST(sum(n_boxes) AS BIGINT) AS boxes,
      {r6("avg(brightness)")} AS mean_brightness FROM {{capture}} GROUP BY model_version""")
def capture_json_stream(spark: SparkSession, d: str) -> DataFrame:
    """A capture log of JSON lines, read as a stream with its fixed schema and renames."""
    log, out = scratch_path(spark, "capture-log"), scratch_path(spark, "captured")
    back = {v: k for k, v in io.CAPTURE_RENAMES.items()}
    rows = table(spark, d, "capture").drop("event_id").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.withColumnsRenamed(back).write.json(log)
    stream = streams.read_capture(spark, log, files_per_trigger=2)
    streams.run_to_table(stream, out, scratch_path(spark, "captured-state"))
    read = spark.read.schema(stream.schema).parquet(out).groupBy("model_version").agg(
        F.count("*").alias("n"), F.sum("n_boxes").alias("boxes"), F.avg("brightness").alias("mean_brightness"))
    return rounded(read, "mean_brightness")
