"""How five document filters interact: what each removes in every order, and its fair share.

Removal is a game: a coalition of filters removes the documents that fail any of them. Its
Hart-Mas-Colell potential is P(S) = (v(S) + sum of P(S without i)) / |S|, computed over the 32
coalitions from the empty one up. A filter's Shapley value is P(all) - P(all but it), and what
a filter removes at a step is v(filters so far) - v(filters before), so the 120 orders are
read off the 32 coalitions' values and no document is looked at twice. Values are kept times
120, in which every potential is a whole number.

Documents enter as counts per part and pattern of failures, at most 32 rows a part: the game
is played on those. A filter's own failures read only the text; the filter on repeats needs
the smallest doc_id of each text, found by an aggregate over 128-bit digests. A text that
holds more than a ten-thousandth of all documents is one of fewer than ten thousand, so the
first doc_ids of such texts are sent to every task and only the others are joined by digest.

Defined results: a null text is empty, and equal to other empty texts. A null source is the
part ''. A document fails E when a smaller doc_id has the same text; rows of one doc_id do
not make each other fail, and a null doc_id neither fails nor makes others fail. Repeated
label rows count as quality 1 or toxic 1 when any of them does; labels without a document
(or a null doc_id) are not used. No rows give no rows. Only doc_id, text and source of docs
and doc_id, quality and toxic of labels are read, whatever else there is.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from wayframe.sources.scratch import settle

FILTERS = "ABCDE"
EVERY = (1 << len(FILTERS)) - 1
ORDERS = 120
HOT = 10_000
MEASURES = ("n", "good", "toxic")


def own_failures(text: Column) -> Column:
    """The bits of A to D, which a text alone decides."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]++"), "")
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("own")))[0]
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]++", ""))
    failed = (
        counts["all"] < 50,
        100 * counts["own"].cast("long") < 65 * counts["all"].cast("long"),
        100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    )
    return sum(((F.when(f, 1 << k).otherwise(0)) for k, f in enumerate(failed)), F.lit(0))


def failures(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, part, failed (a bit per filter)."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = settle(docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"), own_failures(text).alias("failed")), "failures")
    texts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    texts = settle(texts.where("last > first").select(F.col("digest").alias("of"), "first", "n"), "repeated-texts")
    hot = settle(texts.where(F.col("n") * HOT > rows.count()).select("of", "first"), "hot-texts")  # fewer than HOT rows
    same = F.col("digest") == F.col("of")
    repeated = F.when(F.col("doc_id") > F.col("first"), 1 << FILTERS.index("E")).otherwise(0)
    found = (
        rows.join(F.broadcast(hot), same)
        .unionByName(rows.join(F.broadcast(hot), same, "left_anti").join(texts.select("of", "first"), same, "left"), allowMissingColumns=True)
    )
    return found.select("doc_id", "part", (F.col("failed") + repeated).alias("failed"))


def patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents by what they fail; at most 32 rows a part."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("of")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    known = known.where("good = 1 or toxic = 1")
    found = failures(docs)
    # Rows without a doc_id have no label; they would all meet in one task of the join.
    labelled = found.where("doc_id is not null").join(known, F.col("doc_id") == F.col("of"), "left").unionByName(
        found.where("doc_id is null"), allowMissingColumns=True)
    return labelled.groupBy("part", "failed").agg(
        F.count("*").alias("n"), *[F.sum(F.coalesce(m, F.lit(0).cast("long"))).alias(m) for m in ("good", "toxic")])


def coalitions(cells: DataFrame) -> DataFrame:
    """(part, n, removed, lost_good, lost_toxic): what each of the 32 coalitions removes, as arrays by bits."""

    def value(measure: str, s: int) -> Column:
        return F.sum(F.when(F.col("failed").bitwiseAND(s) != 0, F.col(measure)).otherwise(0))

    return cells.groupBy("part").agg(
        F.sum("n").alias("n"),
        *[F.array(*[value(m, s) for s in range(EVERY + 1)]).alias(f"v_{m}") for m in MEASURES])


def potentials(values: DataFrame) -> DataFrame:
    """Add ``potential``, times ORDERS: an array over the coalitions of ``v_n``, smaller ones first."""
    out = values.withColumn("potential", F.array_repeat(F.lit(0).cast("long"), EVERY + 1))
    for size in range(1, len(FILTERS) + 1):
        # A coalition's potential needs those of one filter less, which the last round gave.
        entries = []
        for s in range(EVERY + 1):
            if s.bit_count() == size:
                without = sum((F.col("potential")[s ^ (1 << k)] for k in range(len(FILTERS)) if s >> k & 1), F.lit(0).cast("long"))
                entries.append(F.call_function("div", F.col("v_n")[s] * ORDERS + without, F.lit(size).cast("long")))
            else:
                entries.append(F.col("potential")[s])
        out = out.withColumn("potential", F.array(*entries))
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step with what that step removes."""
    orders = ["".join(order) for order in permutations(FILTERS)]
    steps = []
    for order in orders:
        before = 0
        for step, name in enumerate(order, 1):
            own = 1 << FILTERS.index(name)
            steps.append([step, before, before | own, own])
            before |= own
    game = settle(potentials(coalitions(patterns(docs, labels))), "game")
    rows = game.select("*", F.posexplode(F.lit(steps)).alias("at", "now")).select(
        "*", F.get(F.lit(orders), F.floor(F.col("at") / len(FILTERS)).cast("int")).alias("filter_order"),
        *[F.col("now")[k].alias(c) for k, c in enumerate(("step", "before", "after", "own"))])

    def at(column: str, coalition: Column | str) -> Column:
        return F.get(column, F.col(coalition) if isinstance(coalition, str) else coalition)

    removed = at("v_n", "after") - at("v_n", "before")
    rest = F.lit(EVERY) - F.col("own")
    return rows.select(
        "part", "filter_order", "step", (F.col("n") - at("v_n", "after")).alias("kept"), removed.alias("removed"),
        (at("v_n", "own") - removed).alias("redundant"), (at("v_n", F.lit(EVERY)) - at("v_n", rest)).alias("unique_fails"),
        (at("v_good", "after") - at("v_good", "before")).alias("good_lost"),
        (at("v_toxic", "after") - at("v_toxic", "before")).alias("toxic_lost"),
        (at("potential", F.lit(EVERY)) - at("potential", rest)).alias("shapley"))
