"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over runs of ``order`` words. Every word of the training texts is a word of its
own, and its counts come from all of them, however many there are; the probability of a word
they lack is the mass that the discounts leave to unseen words, spread over IDS possible
words. The discounts of each order follow from its counts of counts (Chen and Goodman), the
lower orders from continuation counts (runs from a text's beginning, which nothing precedes,
by their counts).

Counts are never gathered: all runs of the training texts and of the documents are dealt out
by the word before the last, which all orders from two share, so that a run meets all its
counts in one partition. The runs after a word that the training texts hold more than HOT_RUNS
times are dealt out further by the word before it, which all orders from three share; counts of
two words after such a word are added up over its partitions and then sent to each of them. A
partition counts its training runs first and then passes over the
documents' runs piece by piece. What it finds is linear in the last word's lowest-order
probability. The FREQUENT most frequent words (a fixed number) have theirs, and short ids, in
every task; a run that ends in another word is joined with a table of those. The runs are
dealt in ROUNDS rounds, a fixed number, each of which reads the texts once and leaves a sum
per document; its shuffle files are deleted before the next begins (see SETTINGS). Partitions
grow in number with the texts. Sums are of whole millionths and don't depend on order.

The trusted documents are split in two halves by a hash of doc_id: the model counts all of
one half, and a language's threshold is a quantile of the perplexity of all of its other half,
since a model's perplexity of its own training texts says nothing of others.

Defined results: trusted means quality 1 and toxic not 1; repeated label rows count by
their smallest quality and largest toxic. Rows of one doc_id are scored as one document. A
null or empty text has no words, no perplexity, and is not kept. A language without trusted
text (or null) uses the threshold over all languages; with no trusted text at all there is
no model: perplexity is null and every document with a word is kept. Columns other than
doc_id, text and lang are not read; the filtering form returns all columns as they were.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wayframe.llm import words as wd
from wayframe.sources.scratch import scope, scratch_path, settings, settle

ORDER = 3
IDS = 1 << 20  # words that an unseen word may be, or as many as the training texts have
FREQUENT = 1 << 18  # words with short ids, whose lowest-order probability every task has
ROUNDS = 4  # parts of the runs that are dealt out one after another
PART_RUNS = 250_000  # training runs of a partition, about
PART_DOCUMENTS = 50_000  # documents for each partition at most
HOT_RUNS = 250_000  # training runs after one word that stay together, about
PIECE_BYTES = 1 << 20  # text whose runs are sent together
SETTINGS = {  # of all jobs but the last
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",  # shuffle files end with their job
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}
EDGE = 0  # before the first word and after the last
UNKNOWN = 1
NAMED = 2  # ids from here on are the frequent words, the most frequent first
RARE = 1 << 61  # ids from here on are hashes of all other words


class Index:
    """Sorted hashes that are found by their first bits."""

    def __init__(self, keys: np.ndarray):
        bits = len(keys).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        self.starts = np.zeros(1 << bits, np.int64)
        np.cumsum(np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits)[:-1], out=self.starts[1:])
        self.size = len(keys)
        self.keys = np.append(keys, np.uint64(0xFFFFFFFFFFFFFFFF))

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each is there, and where."""
        at = self.starts[(wanted >> self.shift).astype(np.int64)]
        near = self.keys[at]
        known = near == wanted
        left = np.flatnonzero(near < wanted)
        while len(left):
            at[left] += 1
            near, want = self.keys[at[left]], wanted[left]
            known[left[near == want]] = True
            left = left[near < want]
        return known & (at < self.size), at


def word_ids(texts: wd.Texts, found: wd.Words, hashes: np.ndarray, vocabulary: np.ndarray | Index, order: np.ndarray) -> np.ndarray:
    """Ids of words; ``vocabulary`` are sorted hashes of the frequent words, or their index, and ``order`` their ids."""
    index = vocabulary if isinstance(vocabulary, Index) else Index(vocabulary)
    out = (hashes >> np.uint64(3)).astype(np.int64) | RARE
    known, at = index.find(hashes)
    out[known] = order[at[known]]
    return out


def _place(rest: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """What deals out the runs after a hot word."""
    return wd.mix(rest + salt.astype(np.uint64) + np.uint64(1))


def _hot(words: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """Which of the words have more than one part."""
    return (words < len(salts)) & (salts[np.minimum(words, len(salts) - 1)] > 1)


def runs(texts: wd.Texts, vocabulary: np.ndarray | Index, order: np.ndarray, size: int, salts: np.ndarray,
         shard: int = 0, shards: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``size`` ids that end in each word or the text's end, as (ids, text, what deals them out further).

    Only those of a shard, by the hash of the last word but one; ``salts`` are the parts of
    such a word's runs by its id.
    """
    found = wd.words(texts)
    ids = word_ids(texts, found, wd.word_hashes(texts, found), vocabulary, order)
    some = np.flatnonzero(found.counts > 0)
    block = np.zeros(len(texts), np.int64)
    block[some] = np.arange(len(some)) * size
    flat = np.full(len(ids) + len(some) * size, EDGE, np.int64)
    flat[np.arange(len(ids)) + block[found.doc] + size - 1] = ids
    doc = np.repeat(some, found.counts[some] + 1)
    ends = np.arange(len(doc)) + (size - 1) * (np.cumsum(np.diff(doc, prepend=-1) > 0))
    rest = wd.mix(flat.view(np.uint64))[ends - 1]
    if shards > 1:
        mine = np.flatnonzero(rest % np.uint64(shards) == shard)
        doc, ends, rest = doc[mine], ends[mine], rest[mine]
    rest = rest // np.uint64(shards)
    hot = np.flatnonzero(_hot(flat[ends - 1], salts)) if size > 2 else []
    if len(hot):
        before = wd.mix(flat[ends[hot] - 2].view(np.uint64))
        rest[hot] = _place(rest[hot], before % salts[flat[ends[hot] - 1]].astype(np.uint64))
    return np.stack([flat[ends - back] for back in range(size - 1, -1, -1)], axis=1), doc, rest


def _keys(kind: int, ids: np.ndarray) -> np.ndarray:
    """Hashes of runs: 2 k for a run of k words, 2 k + 1 for what is before its last word."""
    h = np.full(len(ids), kind, np.uint64)
    for column in ids.T:
        h = wd.mix(h * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64) + np.uint64(1))
    return h


def _counted(values: np.ndarray, names: list[str]) -> pa.RecordBatch:
    v, n = np.unique(values, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64) if v.dtype != np.uint64 else v.view(np.int64)), pa.array(n)], names=names)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in wd.slices(batch.column("text")):
            yield _counted(wd.word_hashes(texts, wd.words(texts)), ["word", "n"])


def discounts(counts_of_counts: dict[int, int]) -> tuple[float, float, float]:
    """D1, D2 and D3+ from how many entries were seen once, twice, three and four times."""
    n1, n2, n3, n4 = (counts_of_counts.get(k, 0) for k in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def _discounts_of(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.asarray(d)[np.minimum(n, 3).astype(np.int64) - 1]


def pack(ids: np.ndarray, *others: np.ndarray) -> bytes:
    """Runs of ids and further columns of small numbers as they are sent: byte by byte, compressed, rare words apart."""
    flat = ids.T.ravel()
    rare = flat >= RARE
    columns = np.concatenate([np.where(rare, UNKNOWN, flat), *others]).astype(np.int32)
    planes = np.ascontiguousarray(columns.view(np.uint8).reshape(len(columns), 4).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True) + flat[rare].tobytes()


def unpack(data: bytes, n: int, rare: int, size: int, others: int = 0) -> tuple[np.ndarray, ...]:
    cut = len(data) - 8 * rare
    planes = np.frombuffer(pa.decompress(data[:cut], n * (size + others) * 4, "zstd", asbytes=True), np.uint8).reshape(4, n * (size + others))
    columns = np.ascontiguousarray(planes.T).view(np.int32).ravel()
    flat = columns[: n * size].astype(np.int64)
    flat[flat == UNKNOWN] = np.frombuffer(data[cut:], np.int64)
    return flat.reshape(size, n).T, *columns[n * size:].reshape(others, n)


SENT = "part int, side int, n long, rare long, documents array<long>, data binary"
TRAINING, HOT, ASKED = 0, 1, 2


def _by_part(rest: np.ndarray, parts: int, *columns: np.ndarray) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    """Where each partition's rows begin, all their partitions, and the columns in that order."""
    part = (rest % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
    part = part[order]
    return [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(part)], part, [c[order] for c in columns]


def _sent(rows: list[tuple], holders: list[pa.Array]) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, holders)]).astype(np.int32), pa.concat_arrays(holders))
    *plain, data = (pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())))
    return pa.RecordBatch.from_arrays([*plain, lists, data], names=["part", "side", "n", "rare", "documents", "data"])


def _sender(words: Broadcast, size: int, side: int, shard: int, shards: int, parts: int):
    """The runs of a shard by the partition that counts them; with their documents, if asked."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, order, salts, *_ = words.value
        index = Index(vocabulary)
        for batch in batches:
            for texts in wd.slices(batch.column("text"), PIECE_BYTES):
                ids, doc, rest = runs(texts, index, order, size, salts, shard, shards)
                cuts, part, (ids, doc) = _by_part(rest, parts, ids, doc)
                rows, holders = [], []
                for low, high in zip(cuts, cuts[1:]):
                    others = []
                    if side == ASKED:  # a document's runs are side by side
                        new = np.diff(doc[low:high], prepend=-1) > 0
                        holders.append(batch.column("doc_id").take(pa.array(doc[low:high][new] + texts.first)))
                        others = [np.cumsum(new) - 1]
                    else:
                        holders.append(pa.nulls(0, pa.int64()))
                    rows.append((int(part[low]), side, high - low, int((ids[low:high] >= RARE).sum()), pack(ids[low:high], *others)))
                if rows:
                    yield _sent(rows, holders)

    return send


def _hot_sender(words: Broadcast, shard: int, shards: int, parts: int):
    """A shard's counts of two words after a hot word, to each of the hot word's parts."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = words.value[2]
        step = max(1, 200_000 // int(salts.max()))
        for batch in batches:
            for low in range(0, len(batch), step):
                word, last, n = (np.asarray(batch.column(c)[low: low + step]) for c in ("word", "value", "n"))
                rest = wd.mix(word.view(np.uint64))
                mine = np.flatnonzero(rest % np.uint64(shards) == shard)
                times = salts[word[mine]]
                salt = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                mine = np.repeat(mine, times)
                cuts, part, (ids, counted) = _by_part(
                    _place(rest[mine] // np.uint64(shards), salt), parts, np.stack([word[mine], last[mine]], axis=1), n[mine])
                rows = [(int(part[a]), HOT, b - a, int((ids[a:b] >= RARE).sum()), pack(ids[a:b], counted[a:b])) for a, b in zip(cuts, cuts[1:])]
                if rows:
                    yield _sent(rows, [pa.nulls(0, pa.int64())] * len(rows))

    return send


@dataclass
class Level:
    """Distinct runs of one size with their counts."""

    ids: np.ndarray
    n: np.ndarray

    def shorter(self) -> Level:
        """The runs' last words, with how often each was seen after different words."""
        own = self.ids[:, 1:]
        once = np.ones(len(own), np.int64)
        return _level(own, once if own.shape[1] == 1 else np.where(own[:, 0] == EDGE, self.n, once))


def _level(ids: np.ndarray, n: np.ndarray) -> Level:
    _, first, inverse = np.unique(_keys(2 * ids.shape[1], ids), return_index=True, return_inverse=True)
    return Level(ids[first], np.bincount(inverse, n, len(first)).astype(np.int64))


@dataclass
class Counts:
    """Hashes of the runs and contexts of a partition with their values, per kind."""

    keys: dict[int, Index]
    x: dict[int, np.ndarray]  # discounted counts of runs, totals of contexts
    taken: dict[int, np.ndarray]

    def find(self, kind: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the ids' runs are there, and where."""
        if kind not in self.keys or not len(ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known, at = self.keys[kind].find(_keys(kind, ids))
        known = np.flatnonzero(known)
        return known, at[known]


def counts(level: Level, cuts: dict[int, tuple[float, float, float]], hot: Level, salts: np.ndarray) -> Counts:
    """Counts of all orders from two, from the runs of the highest and the ``hot`` words' of two."""
    out = Counts({}, {}, {})
    while (size := level.ids.shape[1]) > 1:
        d = _discounts_of(level.n, cuts[size])
        keys = _keys(2 * size, level.ids)
        by_key = np.argsort(keys)
        out.keys[2 * size], out.x[2 * size] = Index(keys[by_key]), (level.n - d)[by_key]
        before, context = np.unique(_keys(2 * size + 1, level.ids[:, :-1]), return_inverse=True)
        out.keys[2 * size + 1], out.x[2 * size + 1] = Index(before), np.bincount(context, level.n, len(before))
        # By kinds of counts, so that the sum does not depend on the runs' order.
        out.taken[2 * size + 1] = sum(
            cuts[size][k - 1] * np.bincount(context[np.minimum(level.n, 3) == k], minlength=len(before)) for k in (1, 2, 3))
        level = level.shorter()
        if level.ids.shape[1] == 2 and len(hot.ids):
            rest = np.flatnonzero(~_hot(level.ids[:, 0], salts))
            level = Level(np.concatenate([level.ids[rest], hot.ids]), np.concatenate([level.n[rest], hot.n]))
    return out


def linear(ids: np.ndarray, found: Counts) -> tuple[np.ndarray, np.ndarray]:
    """a and b of the runs' interpolated probabilities a + b * p, p the last word's lowest-order one."""
    a, b = np.zeros(len(ids)), np.ones(len(ids))
    order = ids.shape[1]
    for size in range(2, order + 1):
        held, at = found.find(2 * size + 1, ids[:, order - size: -1])
        if not len(held):
            continue
        total, taken = found.x[2 * size + 1][at], found.taken[2 * size + 1][at]
        seen, where = found.find(2 * size, ids[held, order - size:])
        own = np.zeros(len(held))
        own[seen] = found.x[2 * size][where]
        a[held] = (own + taken * a[held]) / total
        b[held] = taken * b[held] / total
    return a, b


def _received(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(batch.column("side").to_pylist(), batch.column("n").to_pylist(), batch.column("rare").to_pylist(),
                       batch.column("documents"), batch.column("data"))


def _training_level(pieces: list[np.ndarray], size: int) -> Level:
    ids = np.concatenate(pieces) if pieces else np.zeros((0, size), np.int64)
    return _level(ids, np.ones(len(ids), np.int64))


def _hot_level(pieces: list[tuple[np.ndarray, np.ndarray]]) -> Level:
    """The hot words' counts, of which a partition that has several of a word's parts got several copies."""
    if not pieces:
        return Level(np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
    ids, n = (np.concatenate(c) for c in zip(*pieces))
    _, first = np.unique(_keys(4, ids), return_index=True)
    return Level(ids[first], n[first].astype(np.int64))


def _surveyor(words: Broadcast, size: int):
    """Counts of counts by order (kind 2 k, the count, how many) and of words (kind 2, the word, its count).

    Of two words after a hot word the partition's counts (kind 0, the hot word, the other, its count).
    """

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = words.value[2]
        level = _training_level([unpack(data.as_py(), n, rare, size)[0] for _, n, rare, _, data in _received(batches)], size)
        while level.ids.shape[1] > 1:
            if level.ids.shape[1] == 2 < size:
                hot = _hot(level.ids[:, 0], salts)
                yield _survey_rows(0, level.ids[hot, 1], level.n[hot], level.ids[hot, 0])
                level = Level(level.ids[~hot], level.n[~hot])
            v, n = np.unique(level.n[level.n <= 4], return_counts=True)
            yield _survey_rows(2 * level.ids.shape[1], v, n)
            level = level.shorter()
        yield _survey_rows(2, level.ids[:, 0], level.n)

    return survey


def _survey_rows(kind: int, v: np.ndarray, n: np.ndarray, word: np.ndarray | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(v), kind, np.int32)), pa.array(np.zeros(len(v), np.int64) if word is None else word), pa.array(v), pa.array(n)],
        names=["kind", "word", "value", "n"])


def _dealt(df: DataFrame, parts: int) -> DataFrame:
    return df.repartition(parts, "part").sortWithinPartitions("side")


def _parts(spark: SparkSession, n_runs: int, n_documents: int = 0) -> int:
    return max(3 * spark.sparkContext.defaultParallelism, -(-n_runs // PART_RUNS), -(-n_documents // PART_DOCUMENTS))


def train(trusted: DataFrame, order: int = 2) -> tuple:
    """The frequent words' hashes and ids, the training texts, the lowest order by id, the order,
    the discounts by size, the lowest order of other words (word, p), the number of training words,
    the parts of each word's runs by id, the counts of two words after those that have several.

    The counts of runs are made where they are used (see ``score``).
    """
    spark = trusted.sparkSession
    words = settle(trusted.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    all_words = words.agg(F.count("*").alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    most = words.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    hashes, n = np.asarray(most["word"]).view(np.uint64), np.asarray(most["n"])
    ids = np.empty(len(n), np.int64)
    ids[np.lexsort((hashes, -n))] = NAMED + np.arange(len(n))
    salts = np.ones(NAMED + len(n), np.int64)
    if order > 2:
        salts[ids] = -(-n // HOT_RUNS)
    by_hash = np.argsort(hashes)
    vocabulary, ids = hashes[by_hash], ids[by_hash]

    parts = _parts(spark, all_words["n"])
    named = spark.sparkContext.broadcast((vocabulary, ids, salts))  # once: each closure that holds them takes its own disk
    sent = _dealt(trusted.select("text").mapInArrow(_sender(named, order, TRAINING, 0, 1, parts), SENT), parts)
    found = settle(
        sent.mapInArrow(_surveyor(named, order), "kind int, word long, value long, n long").groupBy("kind", "word", "value").agg(
            F.sum("n").alias("n")), "survey")
    named.destroy()
    hot = found.where("kind = 0").select("word", "value", "n")
    cuts: dict[int, dict[int, int]] = {size: {} for size in range(2, order + 1)}
    of_hot = hot.where("n <= 4").groupBy(F.lit(4).alias("kind"), F.col("n").alias("value")).agg(F.count("*").alias("n"))
    for r in found.where("kind > 2").select("kind", "value", "n").union(of_hot).collect():
        cuts[r["kind"] // 2][r["value"]] = cuts[r["kind"] // 2].get(r["value"], 0) + r["n"]
    cuts = {size: discounts(c) for size, c in cuts.items()}

    # Lowest order: in how many contexts a word was seen.
    after_hot = hot.groupBy("value").agg(F.count("*").alias("n"))
    lowest = settle(found.where("kind = 2").select("value", "n").union(after_hot).groupBy(F.col("value").alias("word")).agg(
        F.sum("n").alias("n")), "lowest")
    d = discounts({r[0]: r[1] for r in lowest.where("n <= 4").groupBy("n").count().collect()})
    n = F.col("n")
    discount = F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
    sums = lowest.groupBy(F.least(n, F.lit(3)).alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    total = max(sum(r["n"] for r in sums), 1)
    taken = sum(d[k - 1] * sum(r["words"] for r in sums if r["k"] == k) for k in (1, 2, 3))
    unseen = (taken / total if sums else 1.0) / max(IDS, NAMED + all_words["distinct"])
    lowest = lowest.select("word", ((n - discount) / total + unseen).alias("p"))
    named = lowest.where(F.col("word") < RARE).toArrow()
    lower = np.full(NAMED + len(vocabulary), unseen)
    lower[np.asarray(named["word"])] = np.asarray(named["p"])
    rare = settle(lowest.where(F.col("word") >= RARE), "rare")
    return vocabulary, ids, trusted, lower, order, cuts, rare, all_words["n"], salts, hot


def _scorer(words: Broadcast, order: int, cuts: dict[int, tuple[float, float, float]]):
    """Sums per document of runs that end in a frequent word, and the other runs: word, a, b."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *_, salts, lower = words.value
        pieces, of_hot, found = [], [], None
        for side, n, rare, documents, data in _received(batches):
            if side == TRAINING:
                pieces.append(unpack(data.as_py(), n, rare, order)[0])
                continue
            if side == HOT:
                of_hot.append(unpack(data.as_py(), n, rare, 2, 1))
                continue
            if found is None:
                found = counts(_training_level(pieces, order), cuts, _hot_level(of_hot), salts)
                pieces.clear()
                of_hot.clear()
            ids, doc = unpack(data.as_py(), n, rare, order, 1)
            a, b = linear(ids, found)
            last = ids[:, -1]
            named, other = np.flatnonzero(last < RARE), np.flatnonzero(last >= RARE)
            micro = np.rint(np.log(a[named] + b[named] * lower[last[named]]) * 1e6)
            holders, none = documents.values, pa.nulls(len(documents.values))
            yield pa.RecordBatch.from_arrays(
                [holders, pa.array(wd.sums(micro, doc[named], len(holders))), pa.array(np.bincount(doc[named], minlength=len(holders))),
                 none.cast(pa.int64()), none.cast(pa.float64()), none.cast(pa.float64())], names=_SCORED)
            yield pa.RecordBatch.from_arrays(
                [holders.take(pa.array(doc[other])), pa.nulls(len(other), pa.int64()), pa.array(np.ones(len(other), np.int64)),
                 pa.array(last[other]), pa.array(a[other]), pa.array(b[other])], names=_SCORED)

    return score


_SCORED = ["doc_id", "micro", "n", "word", "a", "b"]


def score(docs: DataFrame, model: tuple, shards: int | None = None) -> DataFrame:
    """(doc_id, n_pairs, log_perplexity) of every doc_id that has a word; ``shards`` are rounds."""
    vocabulary, ids, trusted, lower, order, cuts, rare, n_words, salts, hot = model
    spark = docs.sparkSession
    shards = shards or ROUNDS
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = _parts(spark, n_words // shards, docs.count())
    schema = "doc_id long, micro long, n long"
    words = spark.sparkContext.broadcast((vocabulary, ids, salts, lower))
    paths = [scratch_path(spark, "sums") for _ in range(shards)]
    for k, path in enumerate(paths):
        with scope(spark):
            sent = trusted.select("text").mapInArrow(_sender(words, order, TRAINING, k, shards, parts), SENT).union(
                texts.mapInArrow(_sender(words, order, ASKED, k, shards, parts), SENT))
            if salts.max() > 1:
                sent = sent.union(hot.mapInArrow(_hot_sender(words, k, shards, parts), SENT))
            found = settle(
                _dealt(sent, parts).mapInArrow(_scorer(words, order, cuts), "doc_id long, micro long, n long, word long, a double, b double"), "scored")
            p = F.col("a") + F.col("b") * F.coalesce("p", F.lit(float(lower[UNKNOWN])))
            others = found.where("word is not null").join(rare, "word", "left").select("doc_id", F.rint(F.log(p) * 1e6).cast("long").alias("micro"), "n")
            found.where("word is null").select("doc_id", "micro", "n").union(others).groupBy("doc_id").agg(
                F.sum("micro").alias("micro"), F.sum("n").alias("n")).write.parquet(path)
    words.destroy()
    return (
        spark.read.schema(schema).parquet(*paths).groupBy("doc_id").agg(F.sum("micro").alias("micro"), F.sum("n").alias("n_pairs"))
        .select("doc_id", "n_pairs", (-F.col("micro") / F.col("n_pairs") / 1e6).alias("log_perplexity"))
    )


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.995) -> DataFrame:
    """One row per doc_id: doc_id, lang, n_pairs, log_perplexity, threshold, kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    trusted = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).where(
        "quality = 1 and coalesce(toxic, 0) <> 1 and doc_id is not null").select("doc_id")
    spark = docs.sparkSession
    path = scratch_path(spark, "scores")
    with settings(spark, SETTINGS):
        langs = settle(docs.groupBy("doc_id").agg(F.min("lang").alias("lang")), "langs")
        trusted = langs.join(trusted, "doc_id", "left_semi")
        place = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_003)) / 1_000_003
        trusted = settle(trusted.select("doc_id", "lang", (place < 0.5).alias("train")), "trusted")
        with scope(spark):  # the tables of the model are not needed any more
            sample = settle(docs.join(trusted.where("train").select("doc_id"), "doc_id", "left_semi").select("text"), "sample")
            if learned := not sample.isEmpty():
                scores = score(docs, train(sample, ORDER))
                scores.write.parquet(path)
    if not learned:
        scores = docs.groupBy("doc_id").agg(F.max(F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).alias("kept"))
        return langs.join(scores, langs.doc_id.eqNullSafe(scores.doc_id)).select(
            langs.doc_id, "lang", F.lit(None).cast("long").alias("n_pairs"), F.lit(None).cast("double").alias("log_perplexity"),
            F.lit(None).cast("double").alias("threshold"), "kept")
    scores = spark.read.schema(scores.schema).parquet(path)

    # Quantiles from counts of perplexities in steps of a thousandth: small, exact, mergeable.
    held = trusted.where("not train").join(scores, "doc_id").select(
        "lang", F.ceil(F.col("log_perplexity") * 1000).cast("long").alias("step"))
    steps = held.groupBy("lang", "step").agg(F.count("*").alias("n"))
    every = steps.groupBy("step").agg(F.sum("n").alias("n"))

    def limit(df: DataFrame, *by: str) -> DataFrame:
        up, whole = Window.partitionBy(*by).orderBy("step"), Window.partitionBy(*by)
        return (
            df.withColumn("below", F.sum("n").over(up)).withColumn("holders", F.sum("n").over(whole))
            .where(F.col("below") >= quantile * F.col("holders")).groupBy(*by).agg((F.min("step") / 1000).alias("threshold"))
        )

    with settings(spark, SETTINGS):
        each = settle(limit(steps, "lang"), "thresholds")
        general = limit(every.withColumn("all", F.lit(1)), "all").first()
    found = langs.alias("d").join(scores.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")), "left").select(
        "d.doc_id", "d.lang", "n_pairs", "log_perplexity")
    threshold = F.coalesce("threshold", F.lit(general["threshold"] if general else None).cast("double"))
    return (
        found.alias("f").join(each.alias("e"), F.col("f.lang").eqNullSafe(F.col("e.lang")), "left")
        .select("doc_id", "f.lang", "n_pairs", "log_perplexity", threshold.alias("threshold"),
                (F.col("n_pairs").isNotNull() & F.coalesce(F.col("log_perplexity") <= threshold, F.lit(True))).alias("kept"))
    )


def keep_good(docs: DataFrame, labels: DataFrame, quantile: float = 0.995) -> DataFrame:
    """The rows of docs whose document is kept."""
    kept = classify(docs, labels, quantile).where("kept").select(F.col("doc_id").alias("kept_id"))
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
