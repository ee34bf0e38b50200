"""Running totals over an ordered column without a single-task window.

A plain window needs all rows of a key in one task, which fails when the keys are a
handful of classes or columns. Here the order column is dealt by ranges into cuts,
totals run inside each cut in parallel, and each cut starts from the totals before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from wayframe.sources.scratch import settle

ROWS_PER_CUT = 2_000_000


def _in_cuts(points: DataFrame, order: str, rows_per_cut: int) -> DataFrame | None:
    """``points`` dealt by ranges of ``order`` and written, with their range as ``_cut``.

    There are as many cuts as it takes; None when one will do. Equal values share a cut.
    """
    cuts = -(-points.count() // rows_per_cut)
    if cuts < 2:
        return None
    return settle(
        points.repartitionByRange(cuts, order).withColumn("_cut", F.spark_partition_id()), "cuts")


def running_totals(
    points: DataFrame,
    keys: Sequence[str],
    order: str,
    measures: Sequence[str],
    *,
    descending: bool = False,
    rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Add ``cum_<measure>`` per key in ``order``, and ``next_<order>`` (NULL at the end).

    ``points`` must be pre-aggregated to one row per (keys, order), with a numeric order
    column, and be cheap to read more than once (see ``settle``).
    """
    cut = _in_cuts(points, order, rows_per_cut)
    ordering = F.col(order).desc() if descending else F.col(order).asc()
    if cut is None:
        window = Window.partitionBy(*keys).orderBy(ordering)
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        totals = {f"cum_{m}": F.sum(m).over(upto) for m in measures}
        return points.withColumns({**totals, f"next_{order}": F.lead(order).over(window)})

    first = F.max(order) if descending else F.min(order)
    summary = cut.groupBy(*keys, "_cut").agg(
        *[F.sum(m).alias(f"_total_{m}") for m in measures], first.alias("_first")
    )
    # One row per key and cut from here on.
    cut_order = F.col("_cut").desc() if descending else F.col("_cut").asc()
    over_cuts = Window.partitionBy(*keys).orderBy(cut_order)
    before = over_cuts.rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(
        *keys, "_cut",
        *[
            F.coalesce(F.sum(f"_total_{m}").over(before), F.lit(0)).alias(f"_before_{m}")
            for m in measures
        ],
        F.lead("_first").over(over_cuts).alias("_following"),
    )
    window = Window.partitionBy(*keys, "_cut").orderBy(ordering)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = cut.join(offsets, [*keys, "_cut"])
    return joined.select(
        *points.columns,
        *[(F.col(f"_before_{m}") + F.sum(m).over(upto)).alias(f"cum_{m}") for m in measures],
        F.coalesce(F.lead(order).over(window), F.col("_following")).alias(f"next_{order}"),
    )
