"""Near duplicates by MinHash with tensored banding.

A document's set holds the hashes of its distinct runs of ``words`` words; a shorter
document is one run. Every set gets ``collections`` small hash collections of ``rows``
minima each. Table keys are all pairs of collections, so 32 minima serve 120 tables of
four minima: sets of similarity 0.8 share at least two of the 16 collections, and so meet
in a table, except for about 2 in a million. What meets is verified on full sets.

No group is expanded into pairs:

* Documents with equal sets are one node (an aggregate with map-side combining).
* A collection that no second node has is dropped before pairs of collections are formed.
* In each table key all nodes are compared with one pivot, the node whose collections are
  the most common; the pivot of a group of edited copies is close to their origin.
* Only keys that still hold several components are looked at again, between components,
  around one pivot per key, the node that shares most of its shingles. A shingle that no
  other of these nodes has is in no intersection. Of two nodes' intersection, what lies in
  the pivot is at most what either has of it, and the rest are shingles both have outside
  of it: pairs come from an index of those, which are few around a good pivot, and only
  pairs that can reach the threshold are verified. No link is lost by it.

Defined results: a null text, or one without words, is linked with nothing. A null doc_id
is linked with nothing, its component is null and it is kept. Repeated rows of one doc_id
are one document with several texts: a link of any of them is a link of all. Columns other
than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wayframe.llm import words as wd
from wayframe.llm.frames import components
from wayframe.sources.scratch import settle

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: wd.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text as (value, text), ordered by text and value."""
    found = wd.words(texts)
    hashes = wd.word_hashes(texts, found, lower=True)
    values, at = wd.windows(hashes, found, size)
    short = np.flatnonzero((found.counts > 0) & (found.counts < size))
    whole = np.full(len(short), 0x5851F42D4C957F2D, np.uint64)
    for k in range(size - 1):
        more = found.counts[short] > k
        whole[more] = wd.mix(whole[more] * np.uint64(0x100000001B3) + hashes[found.first[short[more]] + k])
    return wd.within(np.concatenate([values, whole]), np.concatenate([found.doc[at], short]))


def _reduce(ufunc: np.ufunc, values: np.ndarray, first: np.ndarray, counts: np.ndarray, empty: np.uint64) -> np.ndarray:
    """ufunc over each text's run of values; ``empty`` where there are none."""
    out = np.full(len(counts), empty, np.uint64)
    some = counts > 0
    if some.any():
        out[some] = ufunc.reduceat(values, first[some])
    return out


def signer(words: int, collections: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow batches of (doc_id, text) to set sizes, set fingerprints and hash collections."""
    rng = np.random.default_rng(977)
    factors = rng.integers(1, 1 << 63, collections * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    masks = rng.integers(1, 1 << 63, collections * rows, dtype=np.uint64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in wd.slices(batch.column("text")):
                n = len(texts)
                values, doc = shingle_sets(texts, words)
                counts = np.bincount(doc, minlength=n)
                first = np.cumsum(counts) - counts
                mixed = wd.mix(values)
                signatures = np.empty((n, collections), np.uint64)
                for c in range(collections):
                    key = np.full(n, c, np.uint64)
                    for r in range(c * rows, (c + 1) * rows):
                        key = wd.mix(key + _reduce(np.minimum, (mixed ^ masks[r]) * factors[r], first, counts, _EMPTY))
                    signatures[:, c] = key
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(texts.first, n).cast(pa.int64()),
                        pa.array(counts.astype(np.int64)),
                        pa.array(_reduce(np.add, mixed, first, counts, np.uint64(0)).view(np.int64)),
                        pa.array(_reduce(np.add, wd.mix(mixed ^ masks[0]), first, counts, np.uint64(0)).view(np.int64)),
                        pa.ListArray.from_arrays(
                            np.arange(0, n * collections + 1, collections, dtype=np.int32), signatures.ravel().view(np.int64)),
                    ],
                    names=["doc_id", "n_shingles", "print_a", "print_b", "collections"],
                )

    return sign


def verifier(words: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow batches of (a, b, text_a, text_b) to the pairs (a, b) that are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("text_a"), batch.column("text_b")
            size = max(1, batch.num_rows)
            step = max(1, int(size * wd.SLICE_BYTES / max(1, left.nbytes, right.nbytes)))
            for row in range(0, batch.num_rows, step):
                n = min(step, batch.num_rows - row)
                (va, ga), (vb, gb) = ((np.concatenate(v), np.concatenate(g)) for v, g in (
                    zip(*((x, d + t.first) for t in wd.slices(side.slice(row, n)) for x, d in [shingle_sets(t, words)]))
                    for side in (left, right)))
                values, groups = np.concatenate([va, vb]), np.concatenate([ga, gb])
                order = np.lexsort((values, groups))
                v, g = values[order], groups[order]
                both = np.bincount(g[1:][(v[1:] == v[:-1]) & (g[1:] == g[:-1])], minlength=n)
                union = np.bincount(groups, minlength=n) - both
                keep = pa.array((100 * both >= percent * union) & (both > 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(row, n).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return verify


def _shingle_rows(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for texts in wd.slices(batch.column("text")):
                values, doc = shingle_sets(texts, words)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(doc + texts.first)), pa.array(values.view(np.int64))], names=["node", "shingle"])

    return rows


def _similar(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar; a hot b is split by the skew join."""
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return (
        pairs.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b")
        .mapInArrow(verifier(words, percent), "a long, b long")
    )


def _in_several_parts(rows: DataFrame, by: str) -> DataFrame:
    """The rows whose key or pivot still holds several components."""
    open_ones = rows.groupBy(by).agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    return rows.join(open_ones.select(by), by, "left_semi")


def _parted(rows: DataFrame, parts: DataFrame) -> DataFrame:
    return rows.drop("part").join(parts.withColumnRenamed("component", "part"), "node", "left").withColumn(
        "part", F.coalesce("part", "node"))


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, collections: int = 16, rows: int = 2,
) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id reachable over links, kept is true for it alone.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = settle(docs.mapInArrow(
        signer(words, collections, rows),
        "doc_id long, n_shingles long, print_a long, print_b long, collections array<long>"), "signed")

    # Equal sets are one node, named by the smallest doc_id.
    prints = ["print_a", "print_b", "n_shingles"]
    named = signed.where("n_shingles > 0 and doc_id is not null")
    groups = settle(named.groupBy(*prints).agg(F.min("doc_id").alias("node")), "groups")
    members = settle(
        named.join(groups, prints)
        .select("doc_id", "node", "n_shingles", F.when(F.col("doc_id") == F.col("node"), F.col("collections")).alias("collections")),
        "members")
    nodes = members.where("doc_id = node")

    # Collections that several nodes have, then the table keys: all pairs of those.
    single = nodes.select("node", "n_shingles", F.posexplode("collections").alias("i", "u")).distinct()
    shared = single.groupBy("i", "u").agg(F.count("*").alias("holders")).where("holders > 1")
    live = (
        single.join(shared, ["i", "u"]).groupBy("node", "n_shingles")
        .agg(F.sort_array(F.collect_list(F.struct("i", "u"))).alias("us"), F.sum("holders").alias("weight"))
        .where(F.size("us") > 1)
    )
    keys = F.flatten(F.transform("us", lambda x, at: F.transform(
        F.slice("us", at + 2, collections), lambda y: F.xxhash64(x["i"], y["i"], x["u"], y["u"]))))
    keyed = live.select("node", "n_shingles", "weight", F.explode(keys).alias("key"))
    tables = (
        keyed.groupBy("key")
        .agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("top"), F.count("*").alias("n"))
        .where("n > 1").select("key", (-F.col("top.minus")).alias("pivot"))
    )
    met = settle(keyed.join(tables, "key").select("key", "node", "n_shingles", "pivot"), "met")

    # Compare every node of a key with the key's pivot.
    stars = met.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    stars = settle(stars.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "a", "b").dropDuplicates(["x", "y"]).select("a", "b"), "stars")
    candidates = settle(
        docs.join(met.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .dropDuplicates(["doc_id", "text"]), "candidates")
    links = settle(_similar(stars, candidates, words, percent), "links")

    # Repeated rows of one doc_id with different texts link their nodes.
    ids = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    repeats = members.select("doc_id", F.col("node").alias("b")).join(ids.select("doc_id", "a"), "doc_id").where("a <> b")
    links = settle(links.union(repeats.select("a", "b")).distinct(), "links")
    parts = components(links, settle)

    # What is left: pairs of nodes of one key in different components.
    active = settle(_in_several_parts(_parted(met.select("key", "node", "n_shingles"), parts), "key"), "active")
    if not active.isEmpty():
        # The shingles of each set that another active set has too: no others can be common.
        rows_of = candidates.join(active.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").mapInArrow(
            _shingle_rows(words), "node long, shingle long")
        known = rows_of.groupBy("shingle").agg(
            F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("n")).where("first <> last")
        # How common a shingle is goes before its hash, so that sorting puts the rare ones first.
        ranked = F.shiftleft(F.least("n", F.lit(65_535)), 47).bitwiseOR(F.col("shingle").bitwiseAND(F.lit((1 << 47) - 1)))
        several = signed.groupBy("doc_id").agg(F.min("print_a").alias("low"), F.max("print_a").alias("high")).where("low <> high")
        sets = settle(
            rows_of.join(known.select("shingle", ranked.alias("ranked")), "shingle").groupBy("node").agg(
                F.collect_set("ranked").alias("shared"))
            .join(several.select(F.col("doc_id").alias("node"), F.lit(True).alias("several")), "node", "left"), "sets")
        # One pivot per key, the node with most of its shingles in common; then no more keys.
        best = active.join(sets.select("node", F.size("shared").alias("common")), "node", "left").groupBy("key").agg(
            F.max(F.struct((F.coalesce("common", F.lit(0)) / F.col("n_shingles")).alias("share"), (-F.col("node")).alias("minus"))).alias("top"))
        around = active.join(best.select("key", (-F.col("top.minus")).alias("pivot")), "key").select(
            "node", "pivot", "n_shingles", "part").distinct()
        none = F.array().cast("array<long>")
        around = around.join(sets, "node", "left").join(
            sets.select(F.col("node").alias("pivot"), F.col("shared").alias("pivot_shared")), "pivot", "left").join(
            nodes.groupBy(F.col("node").alias("pivot")).agg(F.max("n_shingles").alias("pivot_n")), "pivot")
        around = settle(around.select(
            "node", "pivot", "n_shingles", "part", "pivot_n", F.coalesce("several", F.lit(False)).alias("several"),
            F.coalesce(F.size(F.array_intersect("shared", "pivot_shared")), F.lit(0)).alias("inside"),
            F.coalesce(F.array_except("shared", "pivot_shared"), none).alias("outside")), "around")
        # Their intersection with the pivot is known now, and so is every link to it.
        direct = around.where(
            (F.col("node") != F.col("pivot")) & ~F.col("several")
            & (100 * F.col("inside") >= percent * (F.col("n_shingles") + F.col("pivot_n") - F.col("inside"))))
        links = settle(links.union(direct.select(F.col("node").alias("a"), F.col("pivot").alias("b"))), "links")
        parts = components(links, settle)
        around = settle(_in_several_parts(_parted(around, parts), "pivot"), "around")

        # Of a pair's intersection min(inside) may lie in the pivot, the rest is common outside.
        a, b = around.alias("a"), around.alias("b")
        both = 100 + percent
        sizes = F.col("a.n_shingles") + F.col("b.n_shingles")
        inside = F.least("a.inside", "b.inside")
        apart = (F.col("a.pivot") == F.col("b.pivot")) & (F.col("a.part") != F.col("b.part")) & (F.col("a.node") < F.col("b.node"))
        pair = [F.col("a.node").alias("a"), F.col("b.node").alias("b")]
        # Pairs that need nothing outside: few, as either would be linked with the pivot if as large.
        inner = around.where(F.col("several") | (both * F.col("inside") >= percent * (F.col("n_shingles") + F.ceil(F.col("n_shingles") * percent / 100))))
        inner = inner.drop("outside")
        near = inner.alias("a").join(
            inner.alias("b"), apart & (F.col("a.several") | F.col("b.several") | (both * inside >= percent * sizes))).select(*pair)
        # The others need some common shingles outside, at least `need` of them; so they share
        # one among all but need - 1 of each, of which the rarest are listed.
        need = F.greatest(F.lit(1), F.ceil(
            percent * (F.col("n_shingles") + F.ceil(F.col("n_shingles") * percent / 100)) / both) - F.col("inside"))
        listed = around.withColumn("most", F.size("outside")).where(F.col("most") >= need).select(
            "node", "pivot", "part", "n_shingles", "inside", "most",
            F.explode(F.slice(F.array_sort("outside"), F.lit(1), (F.col("most") - need + 1).cast("int"))).alias("shingle"))
        a, b = listed.alias("a"), listed.alias("b")
        enough = both * (inside + F.least("a.most", "b.most")) >= percent * sizes
        far = a.join(b, apart & (F.col("a.shingle") == F.col("b.shingle")) & enough).select(*pair)
        tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = settle(near.union(far).distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        more = settle(_similar(pairs, candidates, words, percent), "more")
        if not more.isEmpty():
            parts = components(links.union(more), settle)

    found = members.select("doc_id", "node").join(parts, "node", "left").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "node")).alias("component_id"))
    return (
        signed.select("doc_id", "n_shingles").join(found, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        .select("doc_id", "n_shingles", "component_id", "kept")
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all columns of docs; of repeated rows of it, one."""
    kept = near_duplicates(docs, words, percent).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    out = docs.join(settle(kept, "kept"), F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return out
    return out.where("doc_id is null").unionByName(out.where("doc_id is not null").dropDuplicates(["doc_id"]))
