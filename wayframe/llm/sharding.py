"""Shuffled shards by a two-pass external shuffle, in DataFrame operations only.

Pass one scatters rows: a row's shard follows from doc_id and the number of shards alone
(the highest of one seeded hash per shard wins), and inside its shard a second seeded hash
deals it uniformly over as many buckets as hold about ``bucket_bytes`` of text each. One
more shard takes rows only into itself. Rows of one doc_id would always meet, so the
bucket's hash also takes the text's own hash; exact repeats of one row share a bucket.

Pass two takes a bucket at a time: its rows are put in a fixed order, shuffled by
Fisher-Yates (Spark's seeded ``shuffle`` of an array) and written, numbered from where the
buckets before it in the shard end. The order before the shuffle and the partition of a
bucket, which follows its number and seeds the shuffle, are fixed, so that a task that is run
again writes the same, and no task has two buckets.

Defined results: a null text stays null and is 8 bytes large; a null doc_id is hashed like
a value of its own. Every input row is in one shard once, repeated rows too. Columns other
than doc_id and text are not carried.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wayframe.sources.scratch import scratch_path, settle

RECORD_BYTES = 8
BUCKET_BYTES = 16 << 20
SEED = 20


def shard_of(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose seeded hash of doc_id is highest; ties go to the lower shard."""
    tries = [F.struct(F.xxhash64(doc_id, F.lit(s), F.lit(seed)).alias("h"), F.lit(-s).alias("s")) for s in range(shards)]
    return -F.greatest(*tries)["s"]


def write_shards(
    docs: DataFrame, path: str, shards: int = 24, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED,
) -> str:
    """Write (doc_id, text, size, slot) as Parquet below ``path``/shard=<n>; returns the path."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + RECORD_BYTES
    rows = rows.select("doc_id", "text", size.alias("size"), shard_of(F.col("doc_id"), shards, seed).alias("shard"))
    held = rows.groupBy("shard").agg(F.sum("size").alias("bytes"))
    counts = {r["shard"]: -(-r["bytes"] // bucket_bytes) for r in held.collect()}  # one row per shard
    buckets = F.element_at(F.lit([max(1, counts.get(s, 1)) for s in range(shards)]), F.col("shard") + 1)
    place = F.pmod(F.xxhash64("doc_id", F.xxhash64("text"), F.lit(seed + 1)), buckets)
    firsts = [0, *accumulate(max(1, counts.get(s, 1)) for s in range(shards))]
    # Buckets are numbered over all shards, and each is a partition of its own by its number.
    number = F.element_at(F.lit(firsts), F.col("shard") + 1) + F.col("bucket").cast("int")
    scattered = rows.withColumn("bucket", place).withColumn("number", number).repartitionById(firsts[-1], "number")
    # Twice: once to count the buckets, small, and once to write them.
    sizes = settle(rows.select("shard", place.alias("bucket")).groupBy("shard", "bucket").agg(F.count("*").alias("n")), "buckets")
    starts = sizes.withColumn("start", F.sum("n").over(
        Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
    bucketed = scattered.groupBy("number", "shard", "bucket").agg(
        F.array_sort(F.collect_list(F.struct("doc_id", "text", "size"))).alias("rows"))
    shuffled = (
        bucketed.join(starts.select("shard", "bucket", "start"), ["shard", "bucket"])
        .sortWithinPartitions("shard", "bucket")
        .select("shard", "start", F.shuffle("rows", F.lit(seed)).alias("rows"))
        .select("shard", "start", F.posexplode("rows").alias("at", "row"))
        .select("row.doc_id", "row.text", "row.size", (F.col("start") + F.col("at")).alias("slot"), "shard")
    )
    shuffled.write.partitionBy("shard").parquet(path)
    return path


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, text string, size long, slot long, shard int").parquet(path)


def shard(docs: DataFrame, shards: int = 24, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """Write docs into shuffled shards and read them back."""
    spark = docs.sparkSession
    return read_shards(spark, write_shards(docs, scratch_path(spark, "shards"), shards, bucket_bytes, seed))
