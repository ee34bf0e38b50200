"""Mixing sources to target weights by hash thresholds, in DataFrame operations only.

A document's place is a 60-bit hash of its doc_id, size and a seed. A source whose target is
r times its size gives floor(r) whole copies of every document, and one more of those whose
place lies below the source's threshold: the copies' budgets are nested (the first copies
fill up before the second begin), and so are mixes of growing budgets, as thresholds only
rise. The threshold is found without sorting documents: sizes are summed by source and hash
bucket (1,024 buckets, so a source is at most 1,024 rows however hot it is), a running sum
over the buckets names the one in which the budget ends, and only that bucket's documents are
summed again by the next ten bits, until it holds one document. That document is taken when
more than half of it lies inside the budget. So every source comes within half of one
document of its target, and no document is taken more than ``most`` times.

The text is read once, for its words; what is written and read again is one narrow row per
document (and the carried columns). Rows equal in source, doc_id and size share a place; a
second hash, of the written row's number, tells them apart in further rounds, so that a
doc_id repeated many times is still divided. Which of such rows is taken does not show in
(doc_id, size, taken).

Targets: ``budget`` words (all there are, unless given) are shared by weight. A source's
target stops at ``most`` times its size and the excess is shared again by weight until none
is above, which is one level: the words per unit of weight at which the capped and the
uncapped targets use up the budget. It is found from running totals over the sources.

Defined results: a null or empty text has size 0 and is taken 0 times a size of 0; null is a
source of its own, after all others. A null doc_id is hashed like an empty text. Sources
without words, or missing from a weight table, have target 0. No rows give no rows. Every
input row gives one row of the plan. Columns that are not carried are not read, and the
carried ones may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayframe.operators.running import running_totals
from wayframe.sources.scratch import settle

BITS = 10
PLACE_BITS = 60
LEVELS = PLACE_BITS // BITS
SOURCES_PER_CUT = 1_000_000


def size_of(text: Column) -> Column:
    """Number of words: each is replaced by one letter, then white space goes."""
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]++", "w")
    return F.coalesce(F.length(F.translate(marks, " \t\n\x0b\f\r", "")), F.lit(0)).cast("long")


def place_of(doc_id: Column, size: Column, seed: int) -> Column:
    text = F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, PLACE_BITS // 4), 16, 10).cast("long")


def _ranked(sizes: DataFrame) -> DataFrame:
    """Add ``rank`` from 0 by code point, null last, over as many ranges as it takes."""
    cuts = max(1, -(-sizes.count() // SOURCES_PER_CUT))
    dealt = settle(sizes.withColumn("last", F.col("source").isNull()).repartitionByRange(cuts, "last", "source")
                   .withColumn("cut", F.spark_partition_id()), "sources")
    starts = dealt.groupBy("cut").agg(F.count("*").alias("n"))
    starts = starts.select("cut", (F.sum("n").over(Window.orderBy("cut")) - F.col("n")).alias("start"))  # a row per cut
    inside = F.row_number().over(Window.partitionBy("cut").orderBy("last", "source"))
    return dealt.withColumn("inside", inside).join(starts, "cut").select(
        *sizes.columns, (F.col("start") + F.col("inside") - 1).alias("rank"))


def targets(sizes: DataFrame, weights: Sequence[int] | DataFrame = (1, 2, 3), most: int = 3, budget: int | None = None) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    ``weights`` are repeated over the sources by code point, or a table (source, weight).
    """
    if isinstance(weights, DataFrame):
        own = weights.groupBy(F.col("source").alias("of")).agg(F.max("weight").cast("double").alias("weight"))
        held = sizes.join(own, F.col("source").eqNullSafe(F.col("of")), "left").select(
            "source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    else:
        turn = F.element_at(F.lit([float(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
        held = _ranked(sizes).select("source", "source_size", turn.alias("weight"))
    held = settle(held.withColumns({"cap": (F.col("source_size") * most).cast("double"),
                                    "level": F.when(F.col("weight") > 0, F.col("source_size") * most / F.col("weight"))}), "weights")
    whole = held.where("weight > 0").agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total = float(held.agg(F.sum("source_size")).first()[0] or 0 if budget is None else budget)
    # Sources fill up in the order of cap / weight; before a source does, the others share what is left.
    steps = held.where("weight > 0").groupBy("level").agg(F.sum("cap").alias("cap"), F.sum("weight").alias("weight"))
    steps = running_totals(settle(steps, "levels"), [], "level", ["cap", "weight"])
    left = F.lit(total) - (F.col("cum_cap") - F.col("cap"))
    level = left / (F.lit(whole["weight"]) - (F.col("cum_weight") - F.col("weight")))
    found = steps.select("level", level.alias("shared")).where("level >= shared").agg(F.max("shared")).first()[0]
    target = F.col("cap") if found is None else F.when(F.col("level") < found, F.col("cap")).otherwise(F.lit(found) * F.col("weight"))
    return held.select("source", "source_size", F.when(F.col("weight") > 0, target).otherwise(0.0).alias("target"))


def plan(
    docs: DataFrame, weights: Sequence[int] | DataFrame = (1, 2, 3), most: int = 3, budget: int | None = None,
    seed: int = 11, columns: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """One row per document: row (a struct of ``columns``), source, size, source_size, target, times, taken."""
    size = size_of(F.col("text").cast("string"))
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"), docs["source"].cast("string").alias("source"),
                       size.alias("size"), docs["doc_id"].alias("id"))
    number = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - PLACE_BITS)
    rows = settle(rows.select("row", "source", "size", place_of(F.col("id"), F.col("size"), seed).alias("place"), number.alias("tie")), "sizes")

    part = rows.select("source", "size", "place", "tie")
    state, depth = None, 0
    while True:
        digit = _digit(depth)
        sums = settle(part.groupBy("source", digit.alias("digit")).agg(F.sum("size").alias("words"), F.count("*").alias("n")), "buckets")
        if state is None:
            sizes = settle(sums.groupBy("source").agg(F.sum("words").alias("source_size")), "source-sizes")
            copies = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size")))).otherwise(0)
            state = targets(sizes, weights, most, budget).withColumn("copies", copies.cast("long"))
            state = settle(state.select("*", (F.col("target") - F.col("copies") * F.col("source_size")).alias("left"),
                                        F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("high"),
                                        F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("n")), "state")
        state = settle(_refined(state, sums, depth), "state")
        depth += 1
        if depth == 2 * LEVELS or (state.agg(F.max("n")).first()[0] or 0) <= 1:
            break
        part = settle(_by_source(part.withColumn("digit", digit), state.select("source", _last(depth).alias("at")))
                      .where("digit = at").select("source", "size", "place", "tie"), "boundary")

    inside = F.col("before") + F.col("words") / 2 < F.col("left")
    high, low = _prefix("place", min(depth, LEVELS)), _prefix("tie", max(depth - LEVELS, 0))
    at = (high == F.col("high")) & (low == F.col("low"))
    below = (high < F.col("high")) | ((high == F.col("high")) & (low < F.col("low")))
    extra = F.when(F.col("high").isNull(), F.col("left") > 0).otherwise(below | (at & inside))
    limits = state.select("source", "source_size", "target", "copies", "left", "before", "high", "low", "words")
    return (
        _by_source(rows, limits).withColumn("times", F.least(F.lit(most), F.col("copies") + extra.cast("long")))
        .select("row", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))
    )


def _by_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    return rows.join(per_source.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")


def _digit(depth: int) -> Column:
    name, level = ("place", depth) if depth < LEVELS else ("tie", depth - LEVELS)
    return F.shiftright(name, PLACE_BITS - BITS * (level + 1)).bitwiseAND((1 << BITS) - 1)


def _prefix(name: str, levels: int) -> Column:
    """The first ``levels`` digits; 0 for none of them."""
    return F.shiftright(name, PLACE_BITS - BITS * levels) if levels else F.lit(0).cast("long")


def _last(depth: int) -> Column:
    return F.col("high" if depth <= LEVELS else "low").bitwiseAND((1 << BITS) - 1)


def _refined(state: DataFrame, sums: DataFrame, depth: int) -> DataFrame:
    """The state with the bucket added in which each source's budget ends.

    ``high`` is null where the budget covers the whole source.
    """
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("digit"))
    found = _by_source(sums.select("source", "digit", F.col("words").alias("own"), F.col("n").alias("rows"), upto.alias("upto")),
                       state.select("source", "before", "left"))
    found = found.where("before + upto > left").groupBy("source").agg(F.min(F.struct("digit", "own", "rows", "upto")).alias("b"))
    name = "high" if depth < LEVELS else "low"
    columns = {
        name: F.col(name) * (1 << BITS) + F.col("b.digit"), "before": F.col("before") + F.col("b.upto") - F.col("b.own"),
        "words": F.col("b.own"), "n": F.col("b.rows"),
    }
    found = found.withColumnRenamed("source", "of")
    return state.join(found, F.col("source").eqNullSafe(F.col("of")), "left").select(
        *[columns.get(c, F.col(c)).alias(c) for c in state.columns])


def mix(
    docs: DataFrame, weights: Sequence[int] | DataFrame = (1, 2, 3), most: int = 3, budget: int | None = None, seed: int = 11,
) -> DataFrame:
    """The mix itself: rows of docs, each as often as it is taken."""
    taken = plan(docs, weights, most, budget, seed, docs.columns).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy")).select("row.*")
