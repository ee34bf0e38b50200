"""Distribution drift of feature columns between a reference and a current table."""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wayframe.operators.draw import draw_n
from wayframe.operators.running import running_totals
from wayframe.sources.scratch import settle

log = logging.getLogger("wayframe")

# --- Fixed values: feature columns, test choice and cut-offs -------------------------
FEATURES = ("brightness", "width", "height", "n_boxes")
P_VALUE = 0.05
DISTANCE = 0.1
MIN_SPREAD = 0.001
DRIFT_SHARE = 0.25
# --- End of fixed values ------------------------------------------------------------


def _number(name: str) -> Column:
    """The column as a double, NaN as NULL."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def side_counts(df: DataFrame, columns: Sequence[str], *keys: str) -> DataFrame:
    """Rows per distinct value: ``[keys], column, value, n``.

    However many rows repeat a value, it is one row from here on.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), _number(c).alias("value")) for c in columns]
    )
    long = df.select(*keys, F.inline(pairs)).filter(F.col("value").isNotNull())
    return long.groupBy(*keys, "column", "value").agg(F.count("*").alias("n"))


def merge_counts(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Two sides' counts as a stored table ``column, value, n_ref, n_cur``."""
    zero = F.lit(0).cast("long")
    ref = reference.select("column", "value", F.col("n").alias("n_ref"), zero.alias("n_cur"))
    cur = current.select("column", "value", zero.alias("n_ref"), F.col("n").alias("n_cur"))
    merged = ref.unionByName(cur).groupBy("column", "value").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )
    return settle(merged, "value-counts")


def value_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    return merge_counts(side_counts(reference, columns), side_counts(current, columns))


def usable_columns(counts: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with a value on both sides of merged counts; raises when there is none."""
    sides = counts.groupBy("column").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )
    filled = {r["column"] for r in sides.collect() if r["n_ref"] and r["n_cur"]}
    kept = [c for c in columns if c in filled]
    if not kept:
        raise ValueError(f"none of {list(columns)} can be compared: each lacks values on a side")
    for name in columns:
        if name not in filled:
            log.warning("drift of %s is not judged, one side has no value of it", name)
    return kept


def column_statistics(counts: DataFrame, *keys: str) -> DataFrame:
    """Per column (and ``keys``): sizes, distinct values, and the distances between the two sides.

    ``ks`` is the largest gap between the cumulative distributions, ``wasserstein`` the
    area between them over the reference's standard deviation, ``jensen_shannon`` the
    distance between value frequencies and ``chi_square`` its goodness-of-fit statistic.
    ``counts`` is read several times and should be a stored table.
    """
    by = [*keys, "column"]
    curves = running_totals(counts, by, "value", ["n_ref", "n_cur"])
    mean = F.sum(F.col("n_ref") * F.col("value")) / F.sum("n_ref")
    totals = counts.groupBy(*by).agg(
        F.sum("n_ref").alias("rows_ref"), F.sum("n_cur").alias("rows_cur"),
        F.count("*").alias("n_values"), mean.alias("mean_ref"),
    )
    gap = F.abs(F.col("cum_n_ref") / F.col("rows_ref") - F.col("cum_n_cur") / F.col("rows_cur"))
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    p, q = F.col("n_ref") / F.col("rows_ref"), F.col("n_cur") / F.col("rows_cur")

    def half_divergence(share: Column) -> Column:
        return F.when(share > 0, share * F.log(share / ((p + q) / 2))).otherwise(F.lit(0.0))

    expected = p * F.col("rows_cur")
    misfit = (F.col("n_cur") - expected) * (F.col("n_cur") - expected) / expected
    spread = F.col("n_ref") * F.pow(F.col("value") - F.col("mean_ref"), F.lit(2.0))
    joined = curves.join(totals, by)
    stats = joined.groupBy(*by).agg(
        F.first("rows_ref").alias("rows_ref"), F.first("rows_cur").alias("rows_cur"),
        F.first("n_values").alias("n_values"),
        F.max(gap).alias("ks"),
        F.sum(gap * width).alias("_area"),
        F.sum(spread).alias("_spread"),
        F.sum(half_divergence(p) + half_divergence(q)).alias("_divergence"),
        F.sum(F.when(F.col("n_ref") > 0, misfit)).alias("_misfit"),
        F.count_if(F.col("n_ref") == 0).alias("_unseen"),
    )
    deviation = F.sqrt(F.col("_spread") / F.col("rows_ref"))
    return stats.select(
        *by, "rows_ref", "rows_cur", "n_values", "ks",
        (F.col("_area") / F.greatest(deviation, F.lit(MIN_SPREAD))).alias("wasserstein"),
        F.sqrt(F.greatest(F.col("_divergence") / 2, F.lit(0.0))).alias("jensen_shannon"),
        # A value the reference never shows makes the fit infinitely bad.
        F.when(F.col("_unseen") > 0, F.lit(float("inf"))).otherwise(F.col("_misfit"))
        .alias("chi_square"),
    )


def ks_p_value(ks: Column, rows_ref: Column, rows_cur: Column) -> Column:
    """Asymptotic two-sample p-value: the Kolmogorov series."""
    n = rows_ref * rows_cur / (rows_ref + rows_cur)
    root = F.sqrt(n) * ks
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda i: 2 * F.pow(F.lit(-1.0), i - 1) * F.exp(-2.0 * i * i * root * root),
    )
    series = F.aggregate(terms, F.lit(0.0), lambda total, t: total + t)
    # The alternating series needs many terms near zero, where the p-value is 1.
    return F.when(root < 0.2, F.lit(1.0)).otherwise(
        F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    )


@F.pandas_udf(T.DoubleType())
def chi_square_p_value(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution for a handful of degrees of freedom."""

    def tail(x: float, k: int) -> float:
        if k < 1:
            return 1.0
        if math.isinf(x):
            return 0.0
        # Even k: Poisson sum; odd k: erfc plus the same recurrence.
        term = math.exp(-x / 2) if k % 2 == 0 else math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
        total = 0.0 if k % 2 == 0 else math.erfc(math.sqrt(x / 2))
        for i in range(k % 2, k - 1, 2):
            total += term
            term *= x / (i + 2)
        return min(1.0, total)

    return pd.Series([tail(x, int(k)) for x, k in zip(statistic, freedom)], dtype=float)


def column_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] = FEATURES,
    *, method: str = "distance", categorical: Sequence[str] = (),
) -> DataFrame:
    """Drift verdict per usable column: ``column, method, score, drift_detected``.

    ``method`` is the same at every size: ``distance`` scores normalised Wasserstein, or
    Jensen-Shannon for ``categorical`` columns, and drift means 0.1 or more; ``p_value``
    scores the two-sample KS test, or chi-square, and drift means p < 0.05.
    """
    shared = [c for c in columns if c in reference.columns and c in current.columns]
    if not shared:
        raise ValueError("the tables share no feature column")
    counts = value_counts(reference, current, shared)
    usable = usable_columns(counts, shared)
    return drift_from_counts(
        counts.filter(F.col("column").isin(*usable)), method=method, categorical=categorical)


def drift_from_counts(
    counts: DataFrame, *keys: str, method: str = "distance", categorical: Sequence[str] = ()
) -> DataFrame:
    """The verdicts of :func:`column_drift` from merged value counts, per ``keys``.

    Columns without values on one side get no row.
    """
    if method not in ("distance", "p_value"):
        raise ValueError(f"method must be distance or p_value, not {method!r}")
    stats = column_statistics(counts, *keys)
    stats = stats.filter((F.col("rows_ref") > 0) & (F.col("rows_cur") > 0))
    kinds = F.col("column").isin(*categorical) if categorical else F.lit(False)
    if method == "p_value":
        name = F.when(kinds, "chi_square").otherwise("ks")
        score = F.when(kinds, chi_square_p_value("chi_square", F.col("n_values") - 1)).otherwise(
            ks_p_value(F.col("ks"), F.col("rows_ref"), F.col("rows_cur")))
        drifted = F.col("score") < P_VALUE
    else:
        name = F.when(kinds, "jensen_shannon").otherwise("wasserstein")
        score = F.when(kinds, F.col("jensen_shannon")).otherwise(F.col("wasserstein"))
        drifted = F.col("score") >= DISTANCE
    return stats.select(*keys, "column", name.alias("method"), score.alias("score")).withColumn(
        "drift_detected", drifted)


def dataset_verdict(drift: DataFrame, share: float = DRIFT_SHARE, *keys: str) -> DataFrame:
    """How many columns drifted, and whether that is at least ``share`` of them, per ``keys``."""
    return drift.groupBy(*keys).agg(
        F.count("*").alias("n_columns"), F.count_if("drift_detected").alias("n_drifted")
    ).select(
        *keys, "n_columns", "n_drifted",
        (F.col("n_drifted") / F.col("n_columns")).alias("share_drifted"),
        (F.col("n_drifted") / F.col("n_columns") >= share).alias("dataset_drift"),
    )


def feature_table(
    samples: DataFrame,
    image_stats: DataFrame | None = None,
    *,
    condition: str = "all",
    sample_images: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Reference feature table: filter by condition, draw frames, attach brightness.

    Frames are drawn before any pixel is looked at. ``image_stats`` has ``filename`` and
    ``brightness``; frames without one, or all frames when it is None, get NULL.
    """
    if condition not in ("all", "day", "night"):
        raise ValueError(f"condition must be all, day or night, not {condition!r}")
    frames = samples
    if condition != "all":
        frames = samples.filter(F.col("is_night") == F.lit(condition == "night"))
    frames = draw_n(frames, sample_images, "sample_data_token", seed)
    columns = ["sample_data_token", "channel", "is_night", "width", "height", "n_boxes"]
    if image_stats is None:
        return frames.select(*columns, F.lit(None).cast("double").alias("brightness"))
    stats = image_stats.select("filename", "brightness")
    return frames.join(stats, "filename", "left").select(*columns, "brightness")
