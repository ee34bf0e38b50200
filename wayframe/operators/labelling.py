"""Label results: parsing, retries, batch sizing and cost."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from wayframe.functions.labels import TERMINAL, frame_price, with_status
from wayframe.functions.taxonomy import COUNT_FIELDS
from wayframe.sources.scratch import settle

KNOWN_RESULTS = ("succeeded", "errored", "canceled", "expired")
CUT_ROWS = 200_000  # of a batch's order that a task fills at once
RANGE_ROWS = 500_000  # that a task numbers


def flatten_labels(parsed: DataFrame) -> DataFrame:
    """One flat row per result; everything but the status is NULL when it did not parse."""
    label = F.col("label")
    return parsed.select(
        F.col("custom_id").alias("sample_data_token"),
        "model",
        "parse_status",
        label["time_of_day"].alias("time_of_day"),
        label["weather"].alias("weather"),
        F.to_json(label["hazards"]).alias("hazards"),
        F.to_json(label["notable_conditions"]).alias("notable_conditions"),
        label["label_confidence"].alias("label_confidence"),
        *[label["object_counts"][f].alias(f) for f in COUNT_FIELDS],
        *[c for c in ("path", "position") if c in parsed.columns],
    )


def keep_last(labels: DataFrame, order: tuple[str, ...] = ("path", "position")) -> DataFrame:
    """The last row per (token, model) in file and line order."""
    rest = [c for c in labels.columns if c not in ("sample_data_token", "model", *order)]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return (
        labels.groupBy("sample_data_token", "model")
        .agg(last.alias("_row"))
        .select("sample_data_token", "model", *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def collect_labels(raw: DataFrame) -> DataFrame:
    """Raw results (with ``model``, ``path``, ``position``) to the labels table.

    Only each request's last result is parsed.
    """
    raw = raw.select(
        F.col("custom_id").alias("sample_data_token"), "model", "result_type", "stop_reason", "error_type", "text", "path", "position"
    )
    last = keep_last(raw).withColumnRenamed("sample_data_token", "custom_id")
    return flatten_labels(with_status(last))


def latest_status(raw: DataFrame) -> DataFrame:
    """Only the status of the last result per (token, model); the label is not carried."""
    statuses = with_status(raw).select(
        F.col("custom_id").alias("sample_data_token"), "model", "parse_status", "path", "position"
    )
    return keep_last(statuses)


def status_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy("model", "parse_status").agg(F.count("*").alias("n"))


def result_counts(raw: DataFrame, *keys: str) -> DataFrame:
    """Results per type; an unknown type counts as errored."""
    known = F.when(F.col("result_type").isin(*KNOWN_RESULTS), F.col("result_type"))
    kind = F.coalesce(known, F.lit("errored")).alias("result_type")
    return raw.groupBy(*keys, kind).agg(F.count("*").alias("n"))


def pending(requested: DataFrame, statuses: DataFrame, in_flight: DataFrame) -> DataFrame:
    """Requests (``model``, ``sample_data_token``) that still need to be sent.

    Left out are tokens with a terminal status and tokens of a batch that has not ended.
    ``in_flight`` has one row per (model, token) of such batches.
    """
    keys = ["model", "sample_data_token"]
    finished = statuses.filter(F.col("parse_status").isin(*TERMINAL)).select(*keys)
    return requested.join(finished.unionByName(in_flight.select(*keys)), keys, "left_anti")


def in_flight_tokens(batches: DataFrame) -> DataFrame:
    """Tokens of batches that have not ended, from ``(model, status, custom_ids)``."""
    waiting = batches.filter(F.col("status").isNull() | (F.col("status") != "ended"))
    return waiting.select("model", F.explode("custom_ids").alias("sample_data_token"))


def estimate_cost(
    requests: DataFrame, prices: Mapping[str, tuple[float, float]]
) -> DataFrame:
    """Frames and estimated batch cost per model."""
    n = requests.groupBy("model").agg(F.count("*").alias("n_frames"))
    return n.withColumn("cost", F.col("n_frames") * frame_price(F.col("model"), prices))


def assign_batches(
    requests: DataFrame,
    *,
    chunk_size: int = 500,
    max_bytes: int = 190_000_000,
    shards: int,
) -> DataFrame:
    """Add ``shard`` and ``batch`` to requests ``(model, sample_data_token, size)``.

    Batches are bounded by count and by total size; an item larger than the bound gets a
    batch of its own. Filling is sequential, so each model's requests are first spread
    over shards by token hash and batches never span shards; with one shard the result is
    plain sequential filling in token order. ``shards`` is the caller's, so that a growing
    table does not regroup what was batched before; a shard is itself filled by many tasks,
    so that its size bounds no task's memory.
    """
    prefix = F.conv(F.substring(F.md5("sample_data_token"), 1, 8), 16, 10).cast("long")
    sharded = requests.select(
        "model", "sample_data_token", F.col("size").cast("long").alias("size"),
        F.pmod(prefix, F.lit(shards)).cast("int").alias("shard"),
    )
    return _filled(sharded, ("model", "shard"), chunk_size, max_bytes, CUT_ROWS)


def _next_starts(sizes: np.ndarray, chunk_size: int, max_bytes: int) -> np.ndarray:
    """Where the batch after one that begins at each item begins."""
    upto = np.cumsum(sizes)
    spent = upto - sizes
    at = np.arange(len(sizes))
    fits = np.searchsorted(upto, spent + max_bytes, side="right")
    return np.minimum(np.minimum(np.maximum(fits, at + 1), at + chunk_size), len(sizes))


def fill_batches(
    requests: DataFrame, *, chunk_size: int = 500, max_bytes: int = 190_000_000, rows_per_cut: int = CUT_ROWS,
) -> DataFrame:
    """Plain sequential filling of each model's requests in token order, by many tasks.

    Adds ``batch`` to requests ``(model, sample_data_token, size)``; the result is that of
    :func:`assign_batches` with one shard, whatever ``rows_per_cut`` is.
    """
    narrow = requests.select("model", "sample_data_token", F.col("size").cast("long").alias("size"))
    return _filled(narrow, ("model",), chunk_size, max_bytes, rows_per_cut)


def _filled(requests: DataFrame, keys: tuple[str, ...], chunk_size: int, max_bytes: int, rows_per_cut: int) -> DataFrame:
    """Requests with the ``batch`` that sequential filling per ``keys`` gives them.

    A key's requests are numbered in token order and cut after every ``rows_per_cut``. How a
    cut is filled depends on what is before it only through the number of its first items
    that still go to the batch left open there, which is at most ``chunk_size``. So each cut,
    seeing also the first items of the next, turns every such number into the one it hands on
    and the batches it begins; following these from cut to cut, a short table per cut, gives
    where each begins, and then all cuts are filled at once. The numbering is by ranges of
    RANGE_ROWS, however short the cuts are.
    """
    cut_rows = max(rows_per_cut, chunk_size)
    types = {f.name: f.dataType.simpleString() for f in requests.schema}
    key_types = ", ".join(f"{k} {types[k]}" for k in keys)
    requests = settle(requests, "requests")
    parts = max(1, -(-requests.count() // RANGE_ROWS))
    dealt = settle(requests.repartitionByRange(parts, *keys, "sample_data_token").withColumn("part", F.spark_partition_id()), "dealt")
    held = dealt.groupBy(*keys, "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*keys).orderBy("part")) - F.col("n")
    held = held.select(*keys, "part", before.alias("before"))  # a row per key and part
    inside = F.row_number().over(Window.partitionBy(*keys, "part").orderBy("sample_data_token", "size"))
    number = F.col("before") + F.col("inside") - 1
    numbered = settle(
        _with(dealt.withColumn("inside", inside), held, *keys, "part").select(
            *requests.columns, number.alias("i"), F.floor(number / cut_rows).cast("long").alias("cut")), "numbered")
    ahead = numbered.filter((F.col("cut") > 0) & (F.col("i") % cut_rows < chunk_size)).withColumn("cut", F.col("cut") - 1)
    seen = numbered.withColumn("own", F.lit(True)).unionByName(ahead.withColumn("own", F.lit(False)))
    seen = seen.select(*keys, "cut", "i", "size", "own")

    def hand_on(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table["i"]))
        sizes, n = np.asarray(table["size"])[order], int(pc.sum(table["own"]).as_py())
        following = _next_starts(sizes, chunk_size, max_bytes).tolist()
        left, begun = [0] * (len(sizes) + 1), [0] * (len(sizes) + 1)
        for at in range(n, len(sizes) + 1):
            left[at] = at - n
        for at in range(n - 1, -1, -1):
            left[at], begun[at] = left[following[at]], begun[following[at]] + 1
        upto = min(n, chunk_size) + 1
        return pa.table({**{k: table[k].slice(0, 1) for k in keys}, "cut": table["cut"].slice(0, 1),
                         "left": pa.array([left[:upto]], pa.list_(pa.int32())), "begun": pa.array([begun[:upto]], pa.list_(pa.int32()))})

    tables = settle(seen.groupBy(*keys, "cut").applyInArrow(hand_on, f"{key_types}, cut long, left array<int>, begun array<int>"), "cuts")

    def follow(table: pa.Table) -> pa.Table:
        table = table.sort_by("cut")
        entry, batch, entries, firsts = 0, 0, [], []
        for left, begun in zip(table["left"].to_pylist(), table["begun"].to_pylist()):
            entries.append(entry)
            firsts.append(batch)
            entry, batch = left[entry], batch + begun[entry]
        return pa.table({**{k: table[k] for k in keys}, "cut": table["cut"], "entry": pa.array(entries, pa.int32()), "first": pa.array(firsts, pa.int64())})

    entries = settle(tables.groupBy(*keys).applyInArrow(follow, f"{key_types}, cut long, entry int, first long"), "entries")

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        following = _next_starts(np.asarray(table["size"]), chunk_size, max_bytes)
        begins = np.zeros(len(following) + 1, np.int64)
        at = table["entry"][0].as_py()
        while at < len(following):
            begins[at] = 1
            at = int(following[at])
        batch = table["first"][0].as_py() - 1 + np.cumsum(begins[:-1])
        return pa.table({**{c: table[c] for c in types}, "batch": pa.array(batch)})

    filled = ", ".join(f"{c} {t}" for c, t in types.items())
    return _with(numbered, entries, *keys, "cut").groupBy(*keys, "cut").applyInArrow(fill, f"{filled}, batch long")


def _with(df: DataFrame, found: DataFrame, *keys: str) -> DataFrame:
    """A join on keys that may be null; the keys are those of ``df``."""
    named = found.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(named, same).drop(*[f"_{k}" for k in keys])


def batch_summary(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("model", "shard", "batch").agg(
        F.count("*").alias("n_requests"), F.sum("size").alias("n_bytes")
    )
