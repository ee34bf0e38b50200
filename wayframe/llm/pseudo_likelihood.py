"""Document scores by masked pseudo-likelihood under a bidirectional window network.

Every word is predicted from the ``SIDE`` words on either side of it; the conditional
log-probabilities of a document's words, summed, are its score. A hidden layer feeds a
softmax in two levels, over groups of classes and over the classes of a group. The most
frequent words of the corpus are classes of their own. All other words fall into classes by
shape and length, and are then spelt out: a model of three bytes (interpolated, with an end of
word) gives each such word, seen before or not, a probability of its own. So a word's
probability is the class's under both sides times the spelling's; the spelling is not
normalised to the class, which makes the product a lower bound.

Training reads the whole corpus. Words are counted by 64-bit hashes; the counts name the
frequent ones. One more reading takes the masked positions of every document with their
surroundings (one in ``MASK_EVERY`` by a hash of the document and the position, others each
round, and one fixed position of every document with words), and counts the bytes of the
words that are spelt. Then come ``rounds`` rounds: the positions are dealt by hash into
chunks of about CHUNK, each chunk trains a copy of the network in numpy in an order that its
hashes fix, and Spark averages the copies, weighted by positions, as whole numbers. The
number of chunks follows the corpus, and neither chunks nor their order depend on how the
table is partitioned. A task streams its chunks; what reaches the driver is one network of
fixed size, the frequent words, and at most SYMBOLS**3 counts of bytes.

Defined results: a null text or one without words has 0 words, pseudo-likelihood 0 and a
null mean. Every input row gives one output row, repeated rows too; a null doc_id stays
null. An empty corpus leaves the network as it was initialised. Columns other than doc_id
and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayframe.llm import words as wd
from wayframe.sources.scratch import settle

GROUPS = 32
MEMBERS = 64
CLASSES = GROUPS * MEMBERS
NAMED = CLASSES - MEMBERS  # the last group's classes are shapes
EDGE = CLASSES  # outside of the text
SIDE = 2
HIDDEN = 24
MASK_EVERY = 8
CHUNK = 1 << 19
BATCH = 2048
RATE = 0.1
BLOCK = 8192  # positions of a document that stay together
MOST_TASKS = 20_000
_FIXED = float(1 << 20)

SYMBOLS = 160  # bytes below 128, and those above in 32 sets of COARSE
COARSE = 4
END = 0x20
_SYMBOL = np.where(np.arange(256) < 128, np.arange(256), 128 + (np.arange(256) & 31)).astype(np.int64)
_SYMBOL[wd.SPACE] = END
_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 48) & (_BYTES < 58)
_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) < 123)
_CAPITAL = (_BYTES >= 65) & (_BYTES < 91)


@dataclass
class Vocabulary:
    """Hashes of the named words, sorted, with their classes; counts of all classes."""

    hashes: np.ndarray
    classes: np.ndarray
    counts: np.ndarray


def shapes(texts: wd.Texts, found: wd.Words) -> np.ndarray:
    """A number below MEMBERS for each word: capital, mark at the end, digit, beyond ASCII, length."""
    if not len(found.starts):
        return np.zeros(0, np.int64)
    first, last = texts.data[found.starts], texts.data[found.ends - 1]

    def holds(flags: np.ndarray) -> np.ndarray:
        upto = np.zeros(len(texts.data) + 1, np.int32)
        np.cumsum(flags, out=upto[1:])
        return upto[found.ends] > upto[found.starts]

    size = np.searchsorted([5, 8, 12], found.ends - found.starts, "right")
    marks = ~(_DIGIT | _LETTER)[last] & (last < 128)
    return _CAPITAL[first] + 2 * marks + 4 * holds(_DIGIT[texts.data]) + 8 * holds(texts.data >= 128) + 16 * size


def window_ids(texts: wd.Texts, vocabulary: Vocabulary, found: wd.Words | None = None, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all words, their texts, and the classes around each word."""
    found = found or wd.words(texts)
    hashes = wd.word_hashes(texts, found) if hashes is None else hashes
    ids = NAMED + shapes(texts, found)
    if len(vocabulary.hashes):
        near = np.minimum(np.searchsorted(vocabulary.hashes, hashes), len(vocabulary.hashes) - 1)
        ids = np.where(vocabulary.hashes[near] == hashes, vocabulary.classes[near], ids)
    n = len(ids)
    around = np.full((n, 2 * SIDE), EDGE, np.int64)
    for k in range(1, SIDE + 1):
        if n > k:
            same = found.doc[k:] == found.doc[:-k]
            around[k:, SIDE - k][same] = ids[:-k][same]
            around[:-k, SIDE - 1 + k][same] = ids[k:][same]
    return ids, found.doc, around


def spelling_codes(texts: wd.Texts, found: wd.Words) -> tuple[np.ndarray, np.ndarray]:
    """Codes of three symbols that end in each byte, and of the last two with END for each word."""
    s = _SYMBOL[texts.data]
    one, two = np.full(len(s), END), np.full(len(s), END)
    one[1:], two[2:] = s[:-1], s[:-2]
    one[found.starts] = END
    two[found.starts] = END
    second = found.starts[found.ends - found.starts > 1] + 1
    two[second] = END
    last = found.ends - 1
    return (two * SYMBOLS + one) * SYMBOLS + s, (one[last] * SYMBOLS + s[last]) * SYMBOLS + END


def spelling_table(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-probabilities of a symbol after two, by Witten-Bell interpolation down to even odds."""
    three = np.zeros(SYMBOLS**3)
    three[codes] = counts
    three = three.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for counted in (three.sum(axis=(0, 1)), three.sum(axis=0), three):
        total, kinds = counted.sum(axis=-1, keepdims=True), (counted > 0).sum(axis=-1, keepdims=True)
        p = np.where(total > 0, (counted + kinds * p) / np.maximum(total + kinds, 1), p)
    return np.log(p).astype(np.float32).ravel()


def spelling(texts: wd.Texts, found: wd.Words, table: np.ndarray) -> np.ndarray:
    """Log-probability of each word's bytes and its end."""
    codes, ends = spelling_codes(texts, found)
    upto = np.zeros(len(codes) + 1)
    np.cumsum(table[codes] - (texts.data >= 128) * np.log(COARSE), out=upto[1:])
    return upto[found.ends] - upto[found.starts] + table[ends]


def _softmax(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities, in place, and the logarithm of what they were divided by."""
    top = logits.max(axis=1, keepdims=True)
    logits -= top
    np.exp(logits, out=logits)
    total = logits.sum(axis=1, keepdims=True)
    logits /= total
    return logits, (top + np.log(total))[:, 0]


@dataclass
class Network:
    """Rows per place and class around, hidden bias, and weights and bias of groups and members."""

    inputs: np.ndarray
    bias: np.ndarray
    groups: np.ndarray
    group_level: np.ndarray
    members: np.ndarray
    member_level: np.ndarray

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        share = ((counts + 1.0) / (counts.sum() + len(counts))).reshape(GROUPS, MEMBERS)
        whole = share.sum(axis=1)
        return cls(
            rng.normal(0, 0.1, (2 * SIDE * (CLASSES + 1), HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
            rng.normal(0, 0.1, (HIDDEN, GROUPS)).astype(np.float32), np.log(whole).astype(np.float32),
            rng.normal(0, 0.1, (GROUPS, HIDDEN, MEMBERS)).astype(np.float32), np.log(share / whole[:, None]).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.bias, self.groups, self.group_level, self.members, self.member_level]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def with_values(self, flat: np.ndarray) -> Network:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at: at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Network(*out)

    def rows(self, around: np.ndarray) -> np.ndarray:
        return around + np.arange(2 * SIDE) * (CLASSES + 1)

    def hidden(self, around: np.ndarray) -> np.ndarray:
        rows = self.rows(around)
        total = self.inputs[rows[:, 0]]
        for k in range(1, rows.shape[1]):
            total += self.inputs[rows[:, k]]
        total += self.bias
        return np.tanh(total, out=total)

    @staticmethod
    def by_group(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        group = ids // MEMBERS
        order = np.argsort(group, kind="stable")
        ends = np.searchsorted(group[order], np.arange(GROUPS + 1))
        for g in range(GROUPS):
            if ends[g] < ends[g + 1]:
                yield g, order[ends[g]: ends[g + 1]]

    def log_probabilities(self, ids: np.ndarray, around: np.ndarray, step: int = 16384) -> np.ndarray:
        """log p(class | both sides) of each word."""
        out = np.empty(len(ids))
        for at in range(0, len(ids), step):
            own = ids[at: at + step]
            hidden = self.hidden(around[at: at + step])
            logits = hidden @ self.groups + self.group_level
            chosen = logits[np.arange(len(own)), own // MEMBERS].astype(float)
            found = chosen - _softmax(logits)[1]
            for g, rows in self.by_group(own):
                logits = hidden[rows] @ self.members[g] + self.member_level[g]
                chosen = logits[np.arange(len(rows)), own[rows] % MEMBERS].astype(float)
                found[rows] += chosen - _softmax(logits)[1]
            out[at: at + step] = found
        return out

    def learn(self, ids: np.ndarray, around: np.ndarray, squares: list[np.ndarray]) -> None:
        """One Adagrad step on the words' mean negative log-probability."""
        n = len(ids)
        hidden = self.hidden(around)
        error = _softmax(hidden @ self.groups + self.group_level)[0]
        error[np.arange(n), ids // MEMBERS] -= 1
        error /= n
        below = error @ self.groups.T
        steps = [(2, slice(None), hidden.T @ error), (3, slice(None), error.sum(axis=0))]
        for g, rows in self.by_group(ids):
            own = _softmax(hidden[rows] @ self.members[g] + self.member_level[g])[0]
            own[np.arange(len(rows)), ids[rows] % MEMBERS] -= 1
            own /= n
            below[rows] += own @ self.members[g].T
            steps += [(4, g, hidden[rows].T @ own), (5, g, own.sum(axis=0))]
        below *= 1 - hidden * hidden
        rows = self.rows(around).ravel()
        order = np.argsort(rows, kind="stable")
        kinds, first = np.unique(rows[order], return_index=True)
        steps += [(0, kinds, np.add.reduceat(below[order // (2 * SIDE)], first, axis=0)), (1, slice(None), below.sum(axis=0))]
        parts = self.parts()
        for which, at, grad in steps:
            squares[which][at] += grad * grad
            parts[which][at] -= RATE * grad / (np.sqrt(squares[which][at]) + 1e-6)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words by hash; the row without a word counts them all."""

    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        hashes = np.concatenate(parts)
        word, n = np.unique(hashes, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([*word.view(np.int64).tolist(), None], pa.int64()), pa.array([*n.tolist(), len(hashes)], pa.int64())], names=["word", "n"])

    parts, held = [], 0
    for batch in batches:
        for texts in wd.slices(batch.column("text")):
            parts.append(wd.word_hashes(texts, wd.words(texts)))
            held += len(parts[-1])
            if held > CHUNK:
                yield counted(parts)
                parts, held = [], 0
    if held:
        yield counted(parts)


def _examples(vocabulary: Vocabulary, rounds: int, chunks: int):
    """Masked positions of each round, a row per document and block, and bytes of spelt words."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelt = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            doc_ids = np.asarray(batch.column("doc_id").cast(pa.int64()).fill_null(-1))
            for texts in wd.slices(batch.column("text")):
                found = wd.words(texts)
                if not len(found.starts):
                    continue
                hashes = wd.word_hashes(texts, found)
                ids, doc, around = window_ids(texts, vocabulary, found, hashes)
                codes, ends = spelling_codes(texts, found)
                tail = ids >= NAMED
                inside = np.zeros(len(codes) + 1, np.int32)
                np.add.at(inside, found.starts[tail], 1)
                np.add.at(inside, found.ends[tail], -1)
                np.add.at(spelt, codes[np.cumsum(inside[:-1]) > 0], 1)
                np.add.at(spelt, ends[tail], 1)

                some = found.counts > 0
                key = np.zeros(len(texts), np.uint64)
                key[some] = np.add.reduceat(wd.mix(hashes), found.first[:-1][some])
                key = wd.mix(key + wd.mix(doc_ids[texts.first: texts.first + len(texts)].astype(np.uint64) + np.uint64(1)))
                place = (np.arange(len(ids)) - found.first[doc]).astype(np.uint64)
                slot = wd.mix(key[doc] + place * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(MASK_EVERY)
                fixed = place == key[doc] % found.counts[doc].astype(np.uint64)
                grid = np.concatenate([ids[:, None], around], axis=1).astype("<u2")
                block = wd.mix(key[doc] + (place // np.uint64(BLOCK)))
                new = np.ones(len(ids), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (block[1:] != block[:-1])
                run = np.cumsum(new) - 1
                for number in range(rounds):
                    at = np.flatnonzero((slot == number % MASK_EVERY) | fixed)
                    first = np.flatnonzero(np.diff(run[at], prepend=-1))
                    offsets = (np.append(first, len(at)) * grid.itemsize * grid.shape[1]).astype(np.int32)
                    data = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(grid[at].tobytes())])
                    order = block[at][first]
                    chunk = (order % np.uint64(chunks)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(first), number, np.int32)), pa.array(chunk), pa.array(wd.mix(order).view(np.int64)), data], names=["round", "chunk", "order", "data"])
        some = np.flatnonzero(spelt)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), -1, np.int32)), pa.array(some), pa.array(spelt[some]), pa.nulls(len(some), pa.binary())], names=["round", "chunk", "order", "data"])

    return extract


def _trainer(network: Network):
    """Networks trained by chunk, summed with their positions as weights; place -1 has the weights."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = np.zeros(len(network.flat()), np.int64), 0
        chunk, mine, squares, held, size, seen = None, None, [], [], 0, 0

        def step(last: bool) -> None:
            nonlocal held, size, seen
            if held and (last or size >= BATCH):
                grid = np.concatenate(held)
                upto = len(grid) if last else len(grid) // BATCH * BATCH
                for at in range(0, upto, BATCH):
                    own = grid[at: min(at + BATCH, upto)].astype(np.int64)
                    mine.learn(own[:, 0], own[:, 1:], squares)
                held, size, seen = [grid[upto:]], len(grid) - upto, seen + upto

        def close() -> None:
            nonlocal weight, total
            if chunk is not None:
                step(True)
                total += np.rint(mine.flat().astype(float) * _FIXED).astype(np.int64) * seen
                weight += seen

        for batch in batches:
            for number, data in zip(batch.column("chunk").to_pylist(), batch.column("data")):
                if number != chunk:
                    close()
                    chunk, mine, held, size, seen = number, network.with_values(network.flat()), [], 0, 0
                    squares = [np.full_like(p, 1e-4) for p in mine.parts()]
                held.append(np.frombuffer(data.as_buffer(), "<u2").reshape(-1, 1 + 2 * SIDE))
                size += len(held[-1])
                step(False)
        close()
        if weight:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, len(total), dtype=np.int32)), pa.array(np.concatenate([[weight], total]))], names=["at", "value"])

    return train


def vocabulary_of(texts: DataFrame) -> Vocabulary:
    """The most frequent words by name; ties go to the smaller hash."""
    counted = texts.mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.col("word").isNotNull(), F.desc("n"), "word").limit(NAMED + 1).collect()
    words, n = (np.array([r[c] for r in top[1:]], np.int64) for c in ("word", "n"))
    counts = np.zeros(CLASSES)
    counts[: len(n)] = n
    counts[NAMED:] = ((top[0]["n"] if top else 0) - n.sum()) / MEMBERS
    order = np.argsort(words.view(np.uint64))
    return Vocabulary(words.view(np.uint64)[order], order, counts)


def train(docs: DataFrame, rounds: int = 2) -> tuple[Network, Vocabulary, np.ndarray]:
    """The network, the named words and the table of spellings."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    vocabulary = vocabulary_of(texts.select("text"))
    network = Network.start(vocabulary.counts)
    chunks = max(1, round(vocabulary.counts.sum() / MASK_EVERY / CHUNK))
    found = settle(texts.mapInArrow(_examples(vocabulary, rounds, chunks), "round int, chunk long, order long, data binary"), "examples")
    spelt = found.where("round = -1").groupBy(F.col("chunk").alias("code")).agg(F.sum("order").alias("n")).toArrow()
    table = spelling_table(np.asarray(spelt["code"]), np.asarray(spelt["n"]))
    for number in range(rounds):
        dealt = found.where(F.col("round") == number).select("chunk", "order", "data")
        dealt = dealt.repartition(min(chunks, MOST_TASKS), "chunk").sortWithinPartitions("chunk", "order", "data")
        sums = dealt.mapInArrow(_trainer(network), "at int, value long").groupBy("at").agg(
            F.sum(F.col("value").cast("decimal(38,0)")).cast("double").alias("value")).toArrow()
        if len(sums):
            values = np.asarray(sums["value"])[np.argsort(np.asarray(sums["at"]))]
            network = network.with_values(values[1:] / values[0] / _FIXED)
    return network, vocabulary, table


def _scorer(network: Network, vocabulary: Vocabulary, table: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in wd.slices(batch.column("text")):
                n, found = len(texts), wd.words(texts)
                ids, doc, around = window_ids(texts, vocabulary, found)
                logp = network.log_probabilities(ids, around) + np.where(ids >= NAMED, spelling(texts, found, table), 0.0)
                words, total = np.bincount(doc, minlength=n), np.bincount(doc, weights=logp, minlength=n).astype(float)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(texts.first, n).cast(pa.int64()), pa.array(words.astype(np.int64)),
                     pa.array(total), pa.array(total / np.maximum(words, 1), mask=words == 0)],
                    names=["doc_id", "n_words", "pseudo_likelihood", "mean_log_probability"])

    return score


def score(docs: DataFrame, network: Network, vocabulary: Vocabulary, table: np.ndarray) -> DataFrame:
    """doc_id, n_words, pseudo_likelihood, mean_log_probability of every row of docs."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _scorer(network, vocabulary, table), "doc_id long, n_words long, pseudo_likelihood double, mean_log_probability double")
