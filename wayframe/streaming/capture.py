"""Streams over the serving capture log and over newly arriving frames."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from wayframe import schemas
from wayframe.operators.drift import (
    FEATURES, dataset_verdict, drift_from_counts, side_counts,
)
from wayframe.operators.running import running_totals
from wayframe.operators.validate import Rule
from wayframe.sources.scratch import scope, settle
from wayframe.sources.tables import CAPTURE_RENAMES

BUCKETS = 256


def read_capture(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The append-only capture log as a stream, with the drift features' names."""
    reader = spark.readStream.schema(schemas.CAPTURE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path).withColumnsRenamed(CAPTURE_RENAMES)


def window_counts(
    capture: DataFrame, width: str = "1 hour", lateness: str = "10 minutes"
) -> DataFrame:
    """Requests per tumbling window, model version and latency, with the sums of the other features.

    Rows later than ``lateness`` behind the newest are dropped, which bounds the state to
    the open windows. The state is a row per distinct latency, dealt by all three keys, so
    no group's latencies ever meet in one buffer; :func:`window_stats` reads them.
    """
    return (
        capture.withWatermark("ts", lateness)
        .groupBy(F.window("ts", width), "model_version", "latency_ms")
        .agg(
            F.count("*").alias("n"),
            F.count("brightness").alias("n_brightness"), F.sum("brightness").alias("sum_brightness"),
            F.count("n_boxes").alias("n_counted"), F.sum("n_boxes").alias("sum_boxes"),
        )
        .select(F.col("window.start").alias("window_start"), "model_version", "latency_ms", "n",
                "n_brightness", "sum_brightness", "n_counted", "sum_boxes")
    )


def window_stats(counts: DataFrame, percent: int = 95) -> DataFrame:
    """Feature statistics per window and model version from the rows of :func:`window_counts`.

    The percentile is exact: the smallest latency that ``percent`` % of the window do not
    exceed, read off running counts.
    """
    key = F.struct("window_start", "model_version")
    rows = counts.withColumn("_key", key)
    totals = rows.groupBy("_key").agg(
        F.sum("n").alias("n"),
        (F.sum("sum_brightness") / F.nullif(F.sum("n_brightness"), F.lit(0))).alias("mean_brightness"),
        (F.sum("sum_boxes") / F.nullif(F.sum("n_counted"), F.lit(0))).alias("mean_n_boxes"),
    )
    values = settle(
        rows.filter(F.col("latency_ms").isNotNull()).groupBy("_key", "latency_ms").agg(F.sum("n").alias("n")), "latencies")
    whole = values.groupBy("_key").agg(F.sum("n").alias("_whole"))
    reached = running_totals(values, ["_key"], "latency_ms", ["n"]).join(whole, "_key").filter(
        F.col("cum_n") * 100 >= F.col("_whole") * percent)
    limits = reached.groupBy("_key").agg(F.min("latency_ms").alias(f"p{percent}_latency_ms"))
    return totals.join(limits, "_key", "left").select(
        "_key.window_start", "_key.model_version", "n", "mean_brightness", "mean_n_boxes", f"p{percent}_latency_ms")


def new_frames(frames: DataFrame, token: str = "sample_data_token", time: str = "ts",
               lateness: str = "1 hour") -> DataFrame:
    """Each frame once: repeats within the lateness bound are dropped, so state stays small."""
    return frames.withWatermark(time, lateness).dropDuplicatesWithinWatermark([token])


def _bucket_name(buckets: int) -> str:
    """The folder column of a store's buckets; another number of them is another name."""
    return f"bucket{buckets}"


def _with_bucket(rows: DataFrame, token: str, buckets: int) -> DataFrame:
    number = F.pmod(F.xxhash64(F.col(token)), F.lit(buckets)).cast("int")
    return rows.withColumn(_bucket_name(buckets), number)


def write_frames(rows: DataFrame, store: str, token: str = "sample_data_token", buckets: int = BUCKETS) -> None:
    """Add rows to a store of frames, in a folder per bucket of the token's hash."""
    own = _bucket_name(buckets)
    _with_bucket(rows, token, buckets).repartition(own).write.mode("append").partitionBy(own).parquet(store)


def read_frames(spark: SparkSession, store: str) -> DataFrame:
    """The rows of a store of frames."""
    rows = spark.read.parquet(store)
    return rows.drop(*[c for c in rows.columns if re.fullmatch(r"bucket\d+", c)])


def stored_tokens(batch: DataFrame, store: str, token: str, buckets: int) -> DataFrame | None:
    """Stored tokens of the buckets that a batch touches; None when there is no store yet.

    Only those buckets' folders are listed as files to read.
    """
    spark, own = batch.sparkSession, _bucket_name(buckets)
    try:
        held = spark.read.parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # anything but a first batch
            raise
        return None
    if own not in held.columns:
        raise ValueError(f"{store} is not dealt into {buckets} buckets")
    numbers = [r[0] for r in _with_bucket(batch, token, buckets).select(own).distinct().collect()]  # at most one per bucket
    return held.filter(F.col(own).isin(numbers)).select(token, own)


def append_missing(stream: DataFrame, store: str, checkpoint: str,
                   token: str = "sample_data_token", buckets: int = BUCKETS):
    """Append streamed frames that the store does not hold; safe to replay.

    Each micro-batch is anti-joined with what is stored, so repeats at any distance and
    re-run batches add nothing. The store is dealt into buckets by the token's hash, and of
    what is stored only the tokens of the buckets that the batch touches are read.
    """

    def add(batch: DataFrame, _: int) -> None:
        with scope(batch.sparkSession):
            fresh = settle(batch.dropDuplicates([token]), "batch")
            held = stored_tokens(fresh, store, token, buckets)
            if held is not None:
                fresh = fresh.join(held.select(token), token, "left_anti").select(*batch.columns)
            write_frames(fresh, store, token, buckets)

    return (
        stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )


def drift_per_window(
    stream: DataFrame, reference: DataFrame, out: str, checkpoint: str,
    columns: Sequence[str] = FEATURES, width: str = "1 day", share: float = 0.25,
):
    """Compare every event-time window with a reference, keeping one verdict per window.

    A micro-batch adds its value counts under ``out/counts`` in a folder of its own, then
    the verdicts of the windows it touched are recomputed from all their counts, in jobs
    whose number does not depend on the windows, under ``out/verdicts``. Replaying a batch
    rewrites the same folders; :func:`latest_verdicts` reads the last verdict of each
    window. The reference's value counts are repeated per touched window.
    """
    ref = settle(side_counts(reference, columns), "reference-counts")

    def judge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        windowed = batch.withColumn("window_start", F.window("ts", width)["start"])
        key = F.date_format("window_start", "yyyyMMdd'T'HHmmss")
        counted = side_counts(windowed, columns, "window_start")
        counted.withColumn("window_key", key).write.mode("overwrite").partitionBy(
            "window_key"
        ).parquet(f"{out}/counts/batch={number}")
        counts = spark.read.parquet(f"{out}/counts")
        touched = counts.filter(F.col("batch") == number).select("window_key", "window_start")
        # All touched windows in one job, keyed by window; their folders alone are read.
        names = touched.select("window_key").distinct()
        own = counts.join(names, "window_key", "left_semi").groupBy("window_start", "column", "value").agg(
            F.sum("n").alias("n_cur"))
        zero = F.lit(0).cast("long")
        windows = own.agg(F.collect_set("window_start")).scalar()  # of one batch: few
        sides = own.select("window_start", "column", "value", zero.alias("n_ref"), "n_cur").unionByName(
            ref.withColumn("windows", windows).select(
                F.explode("windows").alias("window_start"), "column", "value", F.col("n").alias("n_ref"), zero.alias("n_cur")))
        merged = settle(
            sides.groupBy("window_start", "column", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")),
            "value-counts")
        verdicts = dataset_verdict(drift_from_counts(merged, "window_start"), share, "window_start")
        verdicts.write.mode("overwrite").parquet(f"{out}/verdicts/batch={number}")

    return (
        stream.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )


def latest_verdicts(spark: SparkSession, out: str) -> DataFrame:
    """The last batch's verdict of each window."""
    read = spark.read.parquet(f"{out}/verdicts")
    values = F.struct("batch", *[c for c in read.columns if c not in ("batch", "window_start")])
    return read.groupBy("window_start").agg(F.max(values).alias("last")).select("window_start", "last.*").drop("batch")


def rule_columns(rules: Sequence[Rule]) -> list[str]:
    """The columns of violation counts: rows, then one per rule."""
    return ["rows", *[f"{r.name}_{'_'.join(r.columns)}" for r in rules if r.broken is not None]]


def write_and_count(stream: DataFrame, rules: Sequence[Rule], out: str, checkpoint: str):
    """Write a stream's rows under ``out/rows`` and each batch's violations under ``out/violations``.

    Both are folders per batch, so that a replayed batch replaces its own and the sum over
    all batches is complete however long the stream runs.
    """
    names = rule_columns(rules)
    counts = [F.count("*"), *[F.count_if(r.broken) for r in rules if r.broken is not None]]

    def add(batch: DataFrame, number: int) -> None:
        path = f"{out}/rows/batch={number}"
        batch.write.mode("overwrite").parquet(path)
        written = batch.sparkSession.read.schema(batch.schema).parquet(path)
        written.agg(*[c.alias(n) for c, n in zip(counts, names)]).write.mode("overwrite").parquet(
            f"{out}/violations/batch={number}")

    return (
        stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )


def count_violations(stream: DataFrame, rules: Sequence[Rule], name: str = "rules") -> DataFrame:
    """Observe a rule suite on a stream: rows and violations per micro-batch.

    The counts arrive with each progress event, keyed by ``name``; the rows pass through.
    """
    tested = [r for r in rules if r.broken is not None]
    counts = [
        F.count_if(r.broken).alias(f"{r.name}:{','.join(r.columns)}") for r in tested
    ]
    return stream.observe(name, F.count("*").alias("rows"), *counts)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Process what is available into a Parquet table; return the finished query."""
    query = (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).outputMode(mode)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
