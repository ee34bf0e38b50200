"""Deterministic draws: exact n-smallest-by-hash per group, without a global sort.

Ordering by a seeded hash of the id gives the same rows on any machine and for any
partitioning. The n-th smallest hash of a group is found in two narrow passes (a
histogram over hash prefixes, then a ranking inside the one prefix that straddles the
quota), so no task ever sorts a whole group, however large, and the wide rows are only
filtered, never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayframe.sources.scratch import settle

_PREFIX_DIGITS = 4


def draw_key(token: Column | str, seed: int) -> Column:
    """Hash that orders a draw."""
    token = F.col(token) if isinstance(token, str) else token
    return F.md5(F.concat_ws("|", token.cast("string"), F.lit(str(seed))))


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where NULL equals NULL; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    joined = left.join(renamed, on, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def draw(
    df: DataFrame, keys: Sequence[str], quotas: DataFrame, token: str, seed: int
) -> DataFrame:
    """Keep each group's ``quota`` rows with the smallest seeded hash of ``token``.

    ``quotas`` has one row per group: the key columns and ``quota``. Groups without a
    positive quota yield nothing. ``token`` must be unique.
    """
    hashed = settle(
        df.select(*keys, F.col(token).alias("_token"), draw_key(token, seed).alias("_key")),
        "draw-keys",
    )
    prefix = F.substring("_key", 1, _PREFIX_DIGITS)
    histogram = hashed.groupBy(*keys, prefix.alias("_prefix")).agg(F.count("*").alias("_n"))
    running = Window.partitionBy(*keys).orderBy("_prefix")
    before = F.sum("_n").over(running) - F.col("_n")
    reach = null_safe(histogram.withColumn("_before", before), quotas, keys, "inner")
    # One row per group, written so that its measured size decides the joins below: with
    # few groups the large side is filtered in place instead of being shuffled by group.
    edge = settle(
        reach.filter(F.col("_before") < F.col("quota"))
        .groupBy(*keys)
        .agg(F.max(F.struct("_prefix", (F.col("quota") - F.col("_before")).alias("_left"))).alias("_edge")),
        "draw-edges",
    )
    straddling = null_safe(hashed, edge, keys, "inner").filter(prefix == F.col("_edge._prefix"))
    ranked = straddling.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("_key", "_token"))
    )
    last = settle(
        ranked.filter(F.col("_rank") <= F.col("_edge._left"))
        .groupBy(*keys)
        .agg(F.max(F.struct("_key", "_token")).alias("_last")),
        "draw-limits",
    )
    here = F.struct(draw_key(token, seed).alias("_key"), F.col(token).alias("_token"))
    return null_safe(df, last, keys, "inner").filter(here <= F.col("_last")).drop("_last")


def draw_n(df: DataFrame, n: int | None, token: str, seed: int) -> DataFrame:
    """Uniform draw of n rows without replacement; everything when there are fewer."""
    if n is None:
        return df
    if n <= 0:
        return df.limit(0)
    whole = df.withColumn("_all", F.lit(1))
    quotas = df.sparkSession.range(1).select(F.lit(1).alias("_all"), F.lit(n).alias("quota"))
    return draw(whole, ["_all"], quotas, token, seed).drop("_all")


def allocate(strata: DataFrame, keys: Sequence[str], total: int, floor: int) -> DataFrame:
    """Split ``total`` over strata ``[keys], n`` in proportion to size; adds ``quota``.

    A stratum's floor is ``floor``, or its own size where that is smaller. With a common
    rate for all strata above their floor, the floor binds first for the smallest strata:
    taken by size, the binding ones are a prefix, and running sums tell where it ends. The
    others share what is left at one rate, rounded down, and the units lost to rounding go
    to the largest remainders; ties go to the larger stratum, then to the smaller key. A
    total that covers everything takes everything; floors beyond the total are an error.

    All of it depends on sizes alone, so the sums run over the distinct sizes, of which n
    rows have at most about sqrt(2 n); strata of one size are only ranked by key.
    """
    exact = "decimal(19,0)"
    n, strata_of = F.col("n").cast(exact), F.col("_strata").cast(exact)
    least = F.least(n, F.lit(floor).cast(exact))
    smaller = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()

    def over(value: Column, window) -> Column:
        return F.coalesce(F.sum(value).over(window), F.lit(0)).cast(exact)

    sizes = strata.groupBy("n").agg(F.count("*").alias("_strata"))
    sizes = sizes.select(
        "n", "_strata", over(n * strata_of, every).alias("_all"), over(least * strata_of, every).alias("_floors"),
        (over(n * strata_of, every) - over(n * strata_of, smaller)).cast(exact).alias("_rest"),
        (F.lit(total) - over(least * strata_of, smaller)).cast(exact).alias("_left"),
    )
    sizes = sizes.withColumn("_bound", F.col("_left") * n < least * F.col("_rest"))
    free = F.when(F.col("_bound"), F.lit(0).cast(exact))
    sizes = sizes.withColumns({
        "_mass": over(free.otherwise(n * strata_of), every),
        "_budget": (F.lit(total) - over(F.when(F.col("_bound"), least * strata_of), every)).cast(exact),
    })
    product = F.col("_budget") * n
    sizes = sizes.withColumns({
        "_share": F.when(F.col("_bound"), least).otherwise(F.floor((product - product % F.col("_mass")) / F.col("_mass"))).cast(exact),
        "_over": free.otherwise(product % F.col("_mass")),
    })
    sizes = sizes.withColumn("_spare", F.col("_budget") - over(free.otherwise(F.col("_share") * strata_of), every))
    first = Window.orderBy(F.col("_bound"), F.desc("_over"), F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    extra = F.greatest(F.lit(0), F.least(strata_of, F.col("_spare") - over(strata_of, first)))
    sizes = sizes.select(
        "n", "_share", "_all", "_floors", F.when(F.col("_bound"), 0).otherwise(extra).cast("long").alias("_extra"))
    rank = F.row_number().over(Window.partitionBy("n").orderBy(*[F.asc_nulls_first(k) for k in keys]))
    message = F.lit(f"a floor of {floor} per stratum exceeds the total of {total}")
    quota = (
        F.when(F.col("_all") <= total, F.col("n"))
        .when(F.col("_floors") > total, F.raise_error(message).cast("long"))
        .otherwise(F.col("_share").cast("long") + (F.col("_rank") <= F.col("_extra")).cast("long"))
    )
    ranked = strata.select(*keys, "n", rank.alias("_rank"))
    return ranked.join(sizes, "n").select(*keys, quota.alias("quota"))
