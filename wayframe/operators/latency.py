"""Latency summaries with exact percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wayframe.operators.running import running_totals
from wayframe.sources.scratch import settle


def latency_summary(
    captured: DataFrame,
    keys: Sequence[str] = (),
    shares: Sequence[float] = (0.5, 0.95),
    value: str = "latency_ms",
) -> DataFrame:
    """Requests, mean and percentiles (``p50_ms``, ``p95_ms``) of a latency column.

    Percentiles interpolate linearly between ranks. They are read off running counts of
    the distinct values, so no task holds a whole group, as the built-in exact percentile
    would.
    """
    keys = list(keys)
    counts = settle(
        captured.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("value"))
        .agg(F.count("*").alias("n")),
        "latencies",
    )
    keyed = counts.withColumn("_all", F.lit(1))
    ranks = running_totals(keyed, [*keys, "_all"], "value", ["n"])
    totals = keyed.groupBy(*keys, "_all").agg(
        F.sum("n").alias("_rows"), (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean_ms")
    )
    joined = ranks.join(totals, [*keys, "_all"])

    def at(index):
        inside = (F.col("cum_n") - F.col("n") <= index) & (index < F.col("cum_n"))
        return F.max(F.when(inside, F.col("value")))

    def percentile(share: float):
        position = (F.col("_rows") - 1) * F.lit(float(share))
        low, high = at(F.floor(position)), at(F.ceil(position))
        weight = F.max(position - F.floor(position))
        return (low + (high - low) * weight).alias(f"p{round(share * 100)}_ms")

    return (
        joined.groupBy(*keys, "_all")
        .agg(
            F.first("_rows").alias("n"), F.first("mean_ms").alias("mean_ms"),
            *[percentile(s) for s in shares],
        )
        .drop("_all")
    )
