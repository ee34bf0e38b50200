"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

Tokens are the white-space separated words of the lower-cased text, as 64-bit hashes. A
seed mask selects some positions of a short run of tokens and ignores the others; its hash
survives a substitution in an ignored position. The three default masks are lossless for
the test that follows: any window of 13 tokens with at most 3 substitutions, wherever they
are, agrees in all selected positions of one of them.

Test seeds are few, training seeds are as many as tokens, so a training seed is only
formed into a row when it may hit: the test seeds set bits in a map of sixteen bits a seed,
read as a scalar subquery inside the scan's own stage. A benchmark of more than MOST_SEEDS
seeds is searched in parts by hash, each with a map of its own. Bits
only drop what can't match; the join on hashes decides. Around each hit the tokens of both
sides, aligned, are compared: an overlap is a window with enough equal tokens. The window
holds the seed or touches its surroundings of one window's length, so that a row carries a
bounded piece of its document. Items shorter than the window are compared whole, with the
same share of substitutions; where the masks would miss some of them, items of that length
get further masks (see ``short_masks``), so that every length is searched without loss.

Defined results: null texts, null ids' texts included, are read like any other (a null id
stays null); items without a token are not searched; repeated rows of one
doc_id or item_id are searched each and reported together. Columns other than doc_id, text
and item_id are not read; the filtering form returns all columns as they were.
"""

from __future__ import annotations

import functools
import itertools
import math

from pyspark.sql import Column, DataFrame, functions as F

from wayframe.sources.scratch import settle

MASKS = ("111011", "110100101", "111000101")
WINDOW = 13
SUBSTITUTIONS = 3
MOST_SEEDS = 1 << 21  # of a map: 4 MB
_LEAST_WORDS = 32768  # of 64 bits


def _placed(mask: str, size: int) -> list[frozenset[int]]:
    """The selected positions of a mask at each of its places in ``size`` tokens."""
    return [frozenset(at + k for k, c in enumerate(mask) if c == "1") for at in range(size - len(mask) + 1)]


@functools.cache
def short_masks(size: int, substitutions: int, masks: tuple[str, ...]) -> tuple[str, ...]:
    """Masks that, beside the given ones, find an item of ``size`` tokens after any substitutions.

    The heaviest few that do; of large cases one plain run, which some gap must leave whole.
    """
    run = "1" * (size // (substitutions + 1))
    if math.comb(size, substitutions) > 1000 or size > 14:
        return (run,)
    missed = {
        gone for gone in itertools.combinations(range(size), substitutions)
        if not any(place.isdisjoint(gone) for mask in masks for place in _placed(mask, size))}
    inner = [format(bits, "b").rstrip("0") for bits in range(1, 1 << size)]
    for weight in range(size - substitutions, 0, -1):
        left, chosen = set(missed), []
        some = sorted({m for m in inner if m.count("1") == weight})
        hit = {m: {gone for gone in missed if any(place.isdisjoint(gone) for place in _placed(m, size))} for m in some}
        while left and len(chosen) < 4:
            best = max(some, key=lambda m: len(hit[m] & left))
            chosen.append(best)
            if not hit[best] & left:
                break
            left -= hit[best]
        if not left:
            return tuple(chosen)
    return (run,)


def tokens(text: str) -> Column:
    """Hashes of the words of a text column."""
    trimmed = F.btrim(F.lower(F.col(text).cast("string")), F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(trimmed) > 0, F.transform(
        F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: F.xxhash64(w))).otherwise(F.array().cast("array<long>"))


def _seed(mask: str, at: Column, of: str, number: int) -> Column:
    """The hash of a mask's tokens from a position on; null where the mask does not fit."""
    chosen = [F.element_at(of, (at + k).cast("int")) for k, c in enumerate(mask) if c == "1"]
    return F.when(at + len(mask) - 1 <= F.size(of), F.xxhash64(F.lit(number), *chosen))


def _positions(docs: DataFrame, masks: tuple[str, ...], *keep: str) -> DataFrame:
    """One row per token at which the shortest mask fits, numbered from 1."""
    shortest = min(map(len, masks))
    return docs.where(F.size("tokens") >= shortest).select(
        *keep, "tokens", F.explode(F.sequence(F.lit(1), F.size("tokens") - (shortest - 1))).alias("at"))


def _bit_map(seeds: DataFrame, words: int) -> DataFrame:
    """All bits of the seeds as one array of longs."""
    word = F.pmod(F.shiftright("seed", 6), F.lit(words))
    bits = seeds.groupBy(word.alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(pmod(seed, 64) AS INT))")).alias("bits"))
    every = seeds.sparkSession.range(0, words, 1, 1).withColumnRenamed("id", "word")
    return every.join(bits, "word", "left").agg(
        F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("all")
    ).select(F.transform("all", lambda x: x["bits"]).alias("bits"))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS,
    window: int = WINDOW, substitutions: int = SUBSTITUTIONS,
) -> DataFrame:
    """(doc_id, item_id, hits, matched): documents that overlap with test items.

    ``hits`` are the distinct (position, position, mask) hits with an overlap around them,
    ``matched`` the most equal tokens in a window.
    """
    items = settle(benchmark.select("item_id", tokens("text").alias("tokens")).withColumn("item", F.xxhash64("tokens")), "items")
    # The lengths below the window that occur, at most as many as the window has tokens.
    sizes = [r[0] for r in items.select(F.size("tokens")).where(F.size("tokens").between(1, window - 1)).distinct().collect()]
    short = {n: short_masks(n, n * substitutions // window, tuple(masks)) for n in sizes}
    given, masks = len(masks), (*masks, *sorted({m for own in short.values() for m in own} - {*masks}))

    def for_item(number: int, mask: str) -> Column:
        own = [n for n, chosen in short.items() if mask in chosen]
        return F.lit(True) if number < given else F.size("tokens").isin(own)

    test = settle(
        _positions(items, masks, "item").select("item", "at", F.explode(F.array(*[
            F.struct(F.lit(m).alias("mask"), F.when(for_item(m, mask), _seed(mask, F.col("at"), "tokens", m)).alias("seed"))
            for m, mask in enumerate(masks)
        ])).alias("s")).where("s.seed is not null").select("item", F.col("at").alias("item_at"), "s.mask", "s.seed").distinct(), "seeds")
    n_seeds = test.count()
    parts = max(1, -(-n_seeds // MOST_SEEDS))
    words = max(_LEAST_WORDS, 1 << math.ceil(math.log2(max(1, n_seeds / parts / 4))))
    part_of = F.pmod(F.xxhash64("seed", F.lit(7)), F.lit(parts))
    at = F.col("at")
    seeds = [_seed(mask, at, "tokens", m) for m, mask in enumerate(masks)]

    def may_hit(seed: Column) -> Column:
        word = F.element_at("known", (F.pmod(F.shiftright(seed, 6), F.lit(words)) + 1).cast("int"))
        return F.coalesce(F.getbit(word, F.pmod(seed, F.lit(64)).cast("int")) == 1, F.lit(False))

    reach = window + max(map(len, masks))
    before = F.least(F.lit(window), at - 1)

    def near(own: DataFrame) -> DataFrame:
        known = _bit_map(own, words).scalar()
        rows = _positions(docs.select("doc_id", tokens("text").alias("tokens")).withColumn("known", known), masks, "doc_id", "known")
        rows = rows.where(F.greatest(*[may_hit(s).cast("int") for s in seeds]) == 1).select(
            "doc_id", "at", before.alias("before"),
            F.slice("tokens", (at - before).cast("int"), (before + reach).cast("int")).alias("around"),
            F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), s.alias("seed")) for m, s in enumerate(seeds)])).alias("s"))
        return rows.select("doc_id", "at", "before", "around", "s.mask", "s.seed").join(own, ["mask", "seed"])

    found = functools.reduce(DataFrame.unionByName, [near(test if parts == 1 else test.where(part_of == k)) for k in range(parts)])
    hits = found.join(
        items.groupBy("item").agg(F.first("tokens").alias("item_tokens")), "item")
    # Align both sides, from as far back as both go.
    back = F.least("before", F.col("item_at") - 1, F.lit(window))
    ours = F.slice("around", (F.col("before") - back + 1).cast("int"), (back + reach).cast("int"))
    theirs = F.slice("item_tokens", (F.col("item_at") - back).cast("int"), (back + reach).cast("int"))
    size = F.least(F.lit(window), F.size("item_tokens"))
    equal = F.zip_with(ours, theirs, lambda x, y: F.coalesce((x == y).cast("int"), F.lit(0)))
    best = F.array_max(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("equal") - F.col("size") + 1)),
        lambda k: F.aggregate(F.slice("equal", k, F.col("size")), F.lit(0), lambda a, e: a + e)))
    found = (
        hits.select("doc_id", "item", "at", "item_at", "mask", equal.alias("equal"), size.alias("size"))
        .withColumn("matched", best)
        .where(F.col("matched") * window >= F.col("size") * (window - substitutions))
        .groupBy("doc_id", "item").agg(
            F.count("*").alias("hits"), F.max("matched").cast("long").alias("matched"))
    )
    # Item texts that occur twice are searched once and reported under each id.
    return found.join(items.select("item", "item_id").distinct(), "item").groupBy("doc_id", "item_id").agg(
        F.sum("hits").alias("hits"), F.max("matched").alias("matched"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs whose document overlaps with no test item."""
    found = overlaps(docs, benchmark, **options).select(F.col("doc_id").alias("leaked_id")).distinct()
    return docs.join(settle(found, "leaked"), F.col("doc_id").eqNullSafe(F.col("leaked_id")), "left_anti")
