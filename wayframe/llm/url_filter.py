"""URL rules through Bloom filter cascades, in DataFrame operations only.

A rule is a host with a path, such as ``example.net/en/``; it fits the host and its
subdomains where the url's path starts with the rule's. A url therefore asks for a few
keys: its host's suffixes with as many labels as some rule has, each followed by its path's
prefixes of some rule's length. The longest listed key decides.

Membership is answered by a cascade per verdict. Level one holds the listed keys; level two
the keys of the corpus that level one takes wrongly; level three the listed keys that level
two takes; and so on until nothing is left over. The first level that rejects a key answers
for it. All keys of all urls are the universe, so the answer is exact for every one of
them, and the corpus is judged without a join. Level one's size grows with the list and
with the logarithm of universe over list, so that about as many keys as the list has are
left for level two: a cascade is bounded by the list, not by the corpus. Its levels travel to
every task, so a list of more than ``most_keys`` keys is dealt by hash into parts of fewer;
each part has cascades over its share of the universe, and the parts judge one after another.

Defined results: a null url, or one without ``://``, has an empty host and path; no rule
fits it. Ties in length go to the smaller key; a key listed for both verdicts blocks. Where
no rule fits, the verdict is the method's: not listed, allow. Every input row gives one
output row. Columns other than page_id and url are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from wayframe.sources.scratch import settle

MOST_KEYS = 4_000_000
HASHES = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """The keys a url asks for: some suffixes of its host with some prefixes of its path."""
    return F.array_distinct(F.filter(F.array(*[
        F.when((host != "") & (F.length(path) >= n), F.concat(F.substring_index(host, ".", -k), F.substring(path, 1, n)))
        for k in labels for n in lengths
    ]), lambda key: key.isNotNull()))


def _bit(key: Column, seed: int, words: int) -> tuple[Column, Column]:
    """Word and bit of a key's hash in a filter of a power of two words of 64 bits."""
    h = F.xxhash64(key, F.lit(seed))
    return F.shiftright(h, 6).bitwiseAND(F.lit(words - 1).cast("long")), h.bitwiseAND(F.lit(63).cast("long")).cast("int")


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))


def _filter_of(keys: DataFrame, words: int, level: int) -> DataFrame:
    """The bits of all keys as one array, written out."""
    at = [F.struct(*(c.alias(n) for c, n in zip(_bit(F.col("key"), HASHES * level + i, words), ("word", "bit")))) for i in range(HASHES)]
    bits = keys.select(F.explode(F.array(*at)).alias("b")).groupBy("b.word").agg(
        F.bit_or(F.expr("shiftleft(1L, b.bit)")).alias("bits"))
    every = keys.sparkSession.range(0, words, 1, 1).withColumnRenamed("id", "word")
    return settle(
        every.join(bits, "word", "left")
        .agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("all"))
        .select(F.transform("all", lambda x: x["bits"]).alias("bits")), "filter")


def _takes(bits: Column, key: Column, words: int, level: int) -> Column:
    out = F.lit(True)
    for i in range(HASHES):
        word, bit = _bit(key, HASHES * level + i, words)
        out = out & (F.getbit(F.element_at(bits, (word + 1).cast("int")), bit) == 1)
    return out


class Cascade:
    """Exact membership of a universe's keys in a list."""

    def __init__(self, levels: list[tuple[DataFrame, int]]):
        self.levels = levels  # filter of one row, its number of words

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame) -> Cascade:
        """listed and universe have the distinct keys in a column key."""
        inside, outside = listed.select("key"), None
        n_inside, n_universe = inside.count(), universe.count()
        levels: list[tuple[DataFrame, int]] = []
        held, n_held = inside, n_inside
        while n_held:
            level = len(levels)
            spare = math.log2(max(2, n_universe / n_held)) if level == 0 else 4.0
            words = 1 << max(0, math.ceil(math.log2(n_held * max(8.0, 1.6 * spare) / 64)))
            made = _filter_of(held, words, level)
            levels.append((made, words))
            if level == 0:
                wrong = universe.where(_takes(made.scalar(), F.col("key"), words, level)).join(inside, "key", "left_anti")
            else:
                wrong = (inside if level % 2 else outside).where(_takes(made.scalar(), F.col("key"), words, level))
            wrong = settle(wrong, "wrong")
            if level % 2 == 0:
                outside = wrong
            else:
                inside = wrong
            held, n_held = wrong, wrong.count()
        return cls(levels)

    def columns(self, prefix: str) -> dict[str, Column]:
        """The filters as columns, to be added to the rows that are judged."""
        return {f"{prefix}{i}": made.scalar() for i, (made, _) in enumerate(self.levels)}

    def holds(self, key: Column, prefix: str) -> Column:
        """Whether a key of the universe is listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            taken = _takes(F.col(f"{prefix}{level}"), key, self.levels[level][1], level)
            out = F.when(~taken, F.lit(level % 2 == 1)).otherwise(out)
        return out


def judge(pages: DataFrame, rules: DataFrame, most_keys: int = MOST_KEYS) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    rules has the columns key (host and path) and verdict (block or allow).
    """
    rules = settle(rules.select("key", "verdict").where("key is not null").groupBy("key").agg(F.max("verdict").alias("verdict")), "rules")
    slash = F.instr("key", "/")
    rule_host = F.when(slash > 0, F.substring(F.col("key"), F.lit(1), slash - 1)).otherwise(F.col("key"))
    # Few: as many as rules have different numbers of labels and lengths of paths.
    labels = [r[0] for r in rules.select(F.size(F.split(rule_host, "[.]"))).distinct().collect()]
    lengths = [r[0] for r in rules.select(F.length("key") - F.length(rule_host)).distinct().collect()]

    host, path = host_and_path("url")
    asked = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    asked = asked.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), sorted(labels), sorted(lengths)))
    universe = settle(asked.select(F.explode("keys").alias("key")).distinct(), "universe")
    parts = max(1, -(-rules.count() // most_keys))
    ready = asked
    if parts > 1:
        ready = settle(asked.withColumn("found", F.transform("keys", lambda k: F.lit(None).cast("string"))), "asked")
    for part in range(parts):

        def of_part(keys: DataFrame) -> DataFrame:
            return keys if parts == 1 else keys.where(_part(F.col("key"), parts) == part)

        cascades = {v: Cascade.build(of_part(rules).where(F.col("verdict") == v), of_part(universe)) for v in ("block", "allow")}
        held = ready
        for verdict, cascade in cascades.items():
            held = held.withColumns(cascade.columns(f"_{verdict}_")) if cascade.levels else held

        def verdict_of(key: Column) -> Column:
            block, allow = (cascades[v].holds(key, f"_{v}_") for v in ("block", "allow"))
            return F.when(block, "block").when(allow, "allow")

        if parts == 1:
            ready = held.withColumn("found", F.transform("keys", lambda k: verdict_of(k)))
        else:
            judged = F.zip_with("keys", "found", lambda k, f: F.when(_part(k, parts) == part, verdict_of(k)).otherwise(f))
            ready = settle(held.select("page_id", "host", "path", "keys", judged.alias("found")), "judged")

    fits = F.filter(
        F.zip_with("keys", "found", lambda k, f: F.struct((-F.length(k)).alias("n"), k.alias("key"), f.alias("verdict"))),
        lambda x: x["verdict"].isNotNull())
    return ready.select("page_id", "host", "path", F.array_min(fits).alias("best")).select(
        "page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))
