"""Order-free content fingerprints and skip-if-unchanged builds."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUILDER_VERSION = 1


def _row_hash(columns: list[str]) -> Column:
    """First 60 bits of a row's md5, NULL told apart from any text."""
    text = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("\x1f", *text)), 1, 15), 16, 10).cast("long")


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: a table's ``fingerprint`` (16 hex digits) and row count.

    Rows are hashed and combined by sum and xor, so the result depends on the rows and
    not on files, partitions or order, and needs no sort.
    """
    hashed = df.select(_row_hash(columns or df.columns).alias("h"))
    sums = hashed.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("total"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).cast("string").alias("mix"),
    )
    text = F.concat_ws("|", F.col("n_rows").cast("string"), "total", "mix")
    return sums.select(F.substring(F.sha2(text, 256), 1, 16).alias("fingerprint"), "n_rows")


def build_key(
    tables: Mapping[str, DataFrame],
    options: Mapping[str, object],
    train_frames: DataFrame | None = None,
) -> dict:
    """Identity of a build: the builder, its options and the content of its inputs."""
    key = {"builder_version": BUILDER_VERSION, **options}
    key["data"] = {n: fingerprint(t).first()["fingerprint"] for n, t in sorted(tables.items())}
    if train_frames is not None:
        tokens = train_frames.select("sample_data_token").distinct()
        key["train_frames"] = fingerprint(tokens).first()["fingerprint"]
    return key


def build_if_changed(
    spark: SparkSession,
    key: Mapping[str, object],
    path: str,
    build: Callable[[str], Mapping[str, object]],
    *,
    force: bool = False,
) -> tuple[dict, bool]:
    """Run ``build(data_path)`` unless ``path`` already holds a build with this key.

    Returns the build's statistics and whether it was skipped. The key is written after
    the data, so an interrupted build is never taken for a finished one.
    """
    record = f"{path}/_key"
    text = json.dumps(key, sort_keys=True, default=str)
    stored = _read_record(spark, record)
    if not force and stored is not None and stored["key"] == text:
        return json.loads(stored["stats"]), True
    stats = dict(build(f"{path}/data"))
    row = [(text, json.dumps(stats))]
    spark.createDataFrame(row, "key string, stats string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(record)
    return stats, False


def _read_record(spark: SparkSession, record: str) -> dict | None:
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.schema("key string, stats string").parquet(record).first()
    except AnalysisException:  # nothing built here yet
        return None
    return row.asDict() if row else None
