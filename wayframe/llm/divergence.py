"""How far the word use of a language's sources lies apart.

Terms are counted by CountVectorizer with ``minDF`` and no limit of the vocabulary. Every
token carries its document's language, so that one fit serves all languages: a token's
document frequency is the term's in that language. The model's vocabulary then turns each
document into its exact sparse vector, in Arrow batches where the tokens are made (what the
model's own transform gives, without moving every token into the JVM and back a second time;
the two are compared in the tests); the vectors are summed per source (the sums are kept sparse: a row
per source and term, combined in the tasks before they are shuffled, so that a hot source
is as many partial sums as there are tasks). A language's sums follow from its sources'.

Probabilities are whole billionths with ``prior`` added to each count. Two sources differ by
the sum of absolute differences over the language's kept terms. A term that neither has adds
the same difference of their lowest probabilities each time, so only terms that one of two
sources has are looked at: sources are dealt into tiles and terms into shards, a task takes
one shard of two tiles and gives a partial sum per pair of sources. Tiles of TILE sources and
shards of SHARD_TERMS terms bound a task; neither a term's holders nor a language's sources
meet in one group, and pairs of sources are all that is emitted.

CountVectorizer hands its vocabulary (terms in ``min_docs`` documents and more) to the driver
and to every executor. With ``term_shards`` above 1 terms are split by hash and each part is
fitted and counted by itself, which gives the same sums with so much smaller vocabularies at
the price of that many readings of the texts; ``term_shards_for`` names the number from the
bytes of text, by which vocabularies grow as a power of about 0.6.

Defined results: null text, lang and source count as empty strings, and '' is a language or
source like others. Every (lang, source) has its pairs, also without kept terms; in a
language without kept terms all differences are 0. A source alone in its language has no
pairs. Repeated rows count as documents of their own. No rows give no rows. Columns other
than text, lang and source are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from wayframe.llm import words as wd
from wayframe.sources.scratch import settle

SCALE = 1_000_000_000
PRIOR = 5
TILE = 128
SHARD_TERMS = 4096
BREAK = "\0"  # between a token's language and its term; never part of a term
BYTES_PER_FIT = 256 << 30
HELD = 1 << 21  # sums of a task before it hands them on
_TERM = np.zeros(256, bool)
_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def tokens_of(texts: wd.Texts, langs: list[bytes]) -> pa.Array:
    """Lists of tokens: longest runs of letters A-Z, lower-cased, and characters beyond ASCII, behind the language."""
    inside = _TERM[texts.data]
    found = wd.words(texts, inside)
    size = found.ends - found.starts
    marks = [lang + BREAK.encode() for lang in langs]
    before = np.array([len(m) for m in marks], np.int64)[found.doc]
    ends = np.cumsum(before + size)
    begins = ends - size
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    letters = np.flatnonzero(inside)
    data[letters + np.repeat(begins - found.starts, size)] = wd.LOWER[texts.data[letters]]
    kinds, kind = np.unique(np.array(marks, object), return_inverse=True)
    for k, mark in enumerate(kinds):
        at = (begins - before)[kind[found.doc] == k]
        data[at[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    strings = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(data)])
    return pa.LargeListArray.from_arrays(pa.array(found.first.astype(np.int64)), strings).cast(pa.list_(pa.string()))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = [lang.encode() for lang in batch.column("lang").to_pylist()]
        for texts in wd.slices(batch.column("text")):
            own = slice(texts.first, texts.first + len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("source").slice(texts.first, len(texts)), tokens_of(texts, langs[own])], names=["source", "tokens"])


def document_vectors(tokens: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sparse vectors that a fitted model gives lists of tokens, as (document, index, count)."""
    at = pc.index_in(tokens.values, value_set=vocabulary)
    doc = np.repeat(np.arange(len(tokens)), np.asarray(tokens.value_lengths()))
    known = np.asarray(at.is_valid())
    key, n = np.unique(doc[known] << 32 | np.asarray(at.drop_null()).astype(np.int64), return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, n


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(n, first) if len(first) else n


def _sums(vocabulary: pa.Array):
    """Sums of documents' vectors per source, as far as a task holds them."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def rows() -> pa.RecordBatch:
            key, n = _summed(*map(np.concatenate, zip(*parts)))
            sources = pa.array(list(names), pa.string()).take(pa.array(key >> 32))
            return pa.RecordBatch.from_arrays([sources, pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(n)], names=["source", "at", "n"])

        for batch in _tokens(batches):
            doc, at, n = document_vectors(batch.column("tokens"), vocabulary)
            own = np.array([names.setdefault(s, len(names)) for s in batch.column("source").to_pylist()], np.int64)
            parts.append(_summed(own[doc] << 32 | at, n))
            held += len(parts[-1][0])
            if held > HELD:
                parts = [_summed(*map(np.concatenate, zip(*parts)))]
                held = len(parts[0][0])
                if held > HELD // 2:
                    yield rows()
                    names, parts, held = {}, [], 0
        if parts:
            yield rows()

    return sums


def term_shards_for(text_bytes: int) -> int:
    return max(1, round((text_bytes / BYTES_PER_FIT) ** 0.6))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])


def group_counts(docs: DataFrame, min_docs: int = 30, term_shards: int = 1) -> tuple[DataFrame, DataFrame]:
    """The kept terms (lang, term) and their counts (lang, source, term, n) where they occur."""
    spark, texts = docs.sparkSession, _texts(docs)
    terms, counts = [], []
    for part in range(term_shards):
        tokens = texts.mapInArrow(_tokens, "source string, tokens array<string>").select("tokens")
        if term_shards > 1:
            tokens = tokens.select(F.filter("tokens", lambda t: F.pmod(F.xxhash64(t), F.lit(term_shards)) == part).alias("tokens"))
        # The fit refuses an empty vocabulary: a token that is no term is always in it.
        filler = spark.range(min_docs).select(F.array(F.lit(BREAK)).alias("tokens"))
        model = CountVectorizer(inputCol="tokens", outputCol="vector", minDF=float(min_docs), vocabSize=2**31 - 1).fit(
            tokens.unionByName(filler))
        found = [(at, *token.rpartition(BREAK)[::2]) for at, token in enumerate(model.vocabulary) if token != BREAK]
        vocabulary = settle(spark.createDataFrame(found, "at int, lang string, term string"), "vocabulary")
        sums = texts.mapInArrow(_sums(pa.array(model.vocabulary, pa.string())), "source string, at int, n long").groupBy("source", "at").agg(
            F.sum("n").alias("n"))
        counts.append(settle(sums.join(vocabulary, "at").select("lang", "source", "term", "n"), "counts"))
        terms.append(vocabulary.select("lang", "term"))
    return reduce(DataFrame.unionByName, terms), reduce(DataFrame.unionByName, counts)


def probability(n: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * vocabulary)), exact for any counts."""
    wide = [c.cast("decimal(18,0)") for c in (n, total, vocabulary)]
    numerator = (wide[0] + F.lit(PRIOR)) * F.lit(SCALE)
    quotient = F.call_function("div", numerator, wide[1] + wide[2] * F.lit(PRIOR))
    return F.when(vocabulary > 0, F.lit(1).cast("long") + quotient).otherwise(F.lit(0).cast("long"))


def _tile_pairs(table: pa.Table) -> pa.Table:
    """Partial differences of the pairs of two tiles of sources over one shard of terms.

    Rows without a term carry a source's lowest probability and its language's vocabulary.
    """
    term, p = table["term"].to_pylist(), np.asarray(table["p"])
    sources, at = np.unique(np.asarray(table["source"].to_pylist(), object), return_inverse=True)
    lone = np.asarray([t is None for t in term])
    floor, tile, size = (np.zeros(len(sources), np.int64) for _ in range(3))
    floor[at[lone]] = p[lone]
    tile[at[lone]] = np.asarray(table["tile"])[lone]
    size[at[lone]] = np.asarray(table["vocabulary"])[lone]
    lang, left, right, shard = (table[c][0].as_py() for c in ("lang", "left", "right", "shard"))
    known = [t for t in term if t is not None]
    held, column = np.unique(np.asarray(known, object), return_inverse=True) if known else (np.zeros(0, object), np.zeros(0, np.int64))
    grid = np.repeat(floor[:, None], len(held), axis=1)
    grid[at[~lone], column] = p[~lone]
    first, second = np.flatnonzero(tile == left), np.flatnonzero(tile == right)
    # Terms outside the shard's held ones count once, in the first shard.
    outside = (size[:1] if shard == 0 else np.zeros(1, np.int64)) - len(held)
    a, b, value = [], [], []
    for one in first:
        others = second[second > one] if left == right else second
        part = np.abs(grid[others] - grid[one]).sum(axis=1) + outside * np.abs(floor[others] - floor[one])
        keep = np.ones(len(others), bool) if shard == 0 else part != 0
        a += [sources[one]] * int(keep.sum())
        b += list(sources[others[keep]])
        value.append(part[keep])
    values = np.concatenate(value) if value else np.zeros(0, np.int64)
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.string()),
                     "b": pa.array(b, pa.string()), "value": pa.array(values, pa.int64())})


def source_pairs(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, either way round.

    ``groups``: lang, source, floor (probability of a term without counts), vocabulary.
    ``counts``: lang, source, term, p.
    """
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"), F.max("vocabulary").alias("size"))
    shards = F.greatest(F.lit(1), F.ceil(F.col("size") / SHARD_TERMS)).cast("int")
    tiles = settle(tiles.select(F.col("lang").alias("of"), "tiles", shards.alias("shards")), "tiles")
    empty = groups.join(tiles, F.col("lang") == F.col("of")).select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.col("floor").alias("p"), "vocabulary", "tiles",
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    full = counts.join(tiles, F.col("lang") == F.col("of")).select(
        "lang", "source", "term", "p", F.lit(None).cast("long").alias("vocabulary"), "tiles",
        F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"))
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    sent = full.unionByName(empty).withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    sent = sent.select("lang", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right"), "shard",
                       "source", "term", "p", "vocabulary", "tile")
    parts = sent.groupBy("lang", "left", "right", "shard").applyInArrow(_tile_pairs, "lang string, a string, b string, value long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return sums.select("lang", both.alias("pair"), "value").select("lang", "pair.source", "pair.item", "value")


def audit(docs: DataFrame, min_docs: int = 30, top_terms: int = 50, term_shards: int | None = None) -> DataFrame:
    """One row per (lang, source, part, item): value and rank; parts are ``pair`` and ``term``."""
    seen = settle(_texts(docs).groupBy("lang", "source").agg(F.sum(F.octet_length("text")).alias("bytes")), "groups")
    if term_shards is None:
        term_shards = term_shards_for(seen.agg(F.sum("bytes")).first()[0] or 0)
    terms, counts = group_counts(docs, min_docs, term_shards)
    sizes = terms.groupBy("lang").agg(F.count("*").alias("vocabulary"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = seen.join(sizes, "lang", "left").join(totals, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("vocabulary", F.lit(0).cast("long")).alias("vocabulary"), F.coalesce("total", F.lit(0).cast("long")).alias("total"))
    groups = settle(groups.withColumn("floor", probability(F.lit(0), F.col("total"), F.col("vocabulary"))), "groups")
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    whole = whole.join(langs, "lang")
    own = counts.join(groups, ["lang", "source"])
    own = settle(own.join(whole, ["lang", "term"]).select(
        "lang", "source", "term", probability(F.col("n"), F.col("total"), F.col("vocabulary")).alias("p"),
        probability(F.col("all"), F.col("lang_total"), F.col("vocabulary")).alias("q")), "probabilities")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = own.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    over = over.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms)
    pairs = source_pairs(groups, own.select("lang", "source", "term", "p"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(over)
