"""Language of each word, span and document.

A word is a run of letters. Its script, by fixed ranges of code points, narrows the
languages to those whose training text uses that script; each of them scores the word by
the log-probabilities of its letter trigrams. Viterbi over a document's words, with a
penalty for switching, labels every word, so that mixed texts fall into spans; the
document's language is the one with most letters.

Training counts hashed trigrams per language over all training rows in Spark; the model,
``BUCKETS`` numbers per language, is as large whatever the corpus. A task walks the words
of many documents in step, so that the number of steps is that of the longest document of
some megabytes of text, and no text is cut.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is
everything when nothing was learned. A word in a script that no language uses is a word of
whatever surrounds it. Ties go to the smaller language name. Every input row gives one
output row, repeated rows too; a null doc_id stays null. Columns other than doc_id, text
and, for training, lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayframe.llm import words as wd

BUCKETS = 1 << 16
GROUP_BYTES = 8 << 20
LEAST_SHARE = 0.01  # of a language's letters, for a script to count as its own
# Code point ranges of scripts.
SCRIPTS = (
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF),
    ("arabic", 0x750, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("thai", 0xE00, 0xE7F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
NAMES = ("other", *dict.fromkeys(s[0] for s in SCRIPTS))
_tables: list[np.ndarray] = []


def _code_tables() -> list[np.ndarray]:
    """Letter or not, lower case, and script of every code point."""
    if not _tables:
        letter = np.zeros(0x110000, bool)
        lower = np.arange(0x110000, dtype=np.uint32)
        script = np.zeros(0x110000, np.int8)
        for code in range(0x110000):
            if (c := chr(code)).isalpha():
                letter[code] = True
                if len(small := c.lower()) == 1:
                    lower[code] = ord(small)
        for name, low, high in SCRIPTS:
            script[low: high + 1] = NAMES.index(name)
        _tables.extend((letter, lower, script))
    return _tables


@dataclass
class Letters:
    """Letter words of some texts and the trigram at every letter."""

    doc: np.ndarray  # text of each word
    start: np.ndarray  # code point in its text
    size: np.ndarray  # letters
    script: np.ndarray
    trigram: np.ndarray  # bucket of each letter, word by word


def letters(texts: wd.Texts) -> Letters:
    letter, lower, script = _code_tables()
    codes = np.frombuffer(texts.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum((texts.data & 0xC0) != 0x80, out=heads[1:])
    offsets = heads[texts.offsets]
    is_letter = letter[codes]
    small = np.where(is_letter, lower[codes], 0).astype(np.uint64)
    cut = np.zeros(len(codes) + 1, bool)
    cut[offsets] = True
    before, after = np.zeros_like(small), np.zeros_like(small)
    before[1:], after[:-1] = small[:-1], small[1:]
    before[cut[:-1]] = 0
    after[cut[1:]] = 0
    starts = np.flatnonzero(is_letter & (before == 0))
    ends = np.flatnonzero(is_letter & (after == 0)) + 1
    at = np.flatnonzero(is_letter)
    mixed = (before[at] * np.uint64(0x9E3779B97F4A7C15) ^ small[at] * np.uint64(0xC2B2AE3D27D4EB4F)) + after[at] * np.uint64(0x165667B19E3779F9)
    trigram = (wd.mix(mixed) & np.uint64(BUCKETS - 1)).astype(np.int64)
    doc = np.searchsorted(offsets, starts, "right") - 1
    return Letters(doc, starts - offsets[doc], ends - starts, script[codes[starts]].astype(np.int64), trigram)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, bucket, n): trigrams (kind 0) and scripts' letters (kind 1)."""
    for batch in batches:
        langs, codes = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        held = np.zeros((len(langs), BUCKETS + len(NAMES)), np.int64)
        for texts in wd.slices(batch.column("text")):
            found = letters(texts)
            lang = codes[texts.first + found.doc]
            held += np.bincount(
                np.repeat(lang, found.size) * held.shape[1] + found.trigram, minlength=held.size).reshape(held.shape)
            held += np.bincount(
                lang * held.shape[1] + BUCKETS + found.script, weights=found.size, minlength=held.size).astype(np.int64).reshape(held.shape)
        row, bucket = np.nonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()).take(pa.array(row)), pa.array(bucket), pa.array(held[row, bucket])], names=["lang", "bucket", "n"])


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray  # bucket x language
    allowed: np.ndarray  # script x language


def train(docs: DataFrame) -> Model:
    """Learn from (text, lang); rows with a null in either are left out."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        "text is not null and lang is not null")
    # At most BUCKETS + scripts rows per language.
    counted = rows.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(counted.lang))
    table = np.zeros((BUCKETS + len(NAMES), len(langs)))
    for k, lang in enumerate(langs):
        mine = counted[counted.lang == lang]
        table[mine.bucket.to_numpy(), k] = mine.n.to_numpy()
    trigrams, scripts = table[:BUCKETS], table[BUCKETS:]
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(NAMES), 0), bool))
    logp = np.log((trigrams + 0.1) / (trigrams.sum(axis=0) + 0.1 * BUCKETS))
    logp -= logp.mean(axis=1, keepdims=True)
    return Model(langs, logp.astype(np.float32), scripts >= LEAST_SHARE * np.maximum(scripts.sum(axis=0), 1))


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word; text i has the words first[i]:first[i + 1]."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begin, size = first[:-1][order], counts[order]
    active = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), "right")
    n_langs = scores.shape[1]
    kinds = np.arange(n_langs, dtype=np.uint8)
    back = np.empty(scores.shape, np.uint8 if n_langs < 256 else np.int32)
    state = np.zeros((len(order), n_langs), np.float32)
    for step, n in enumerate(active):
        at = begin[:n] + step
        held = state[:n]
        best = held.argmax(axis=1)
        switch = np.take_along_axis(held, best[:, None], 1) - np.float32(penalty if step else 0)
        stay = held >= switch
        back[at] = np.where(stay, kinds, best[:, None])
        state[:n] = np.where(stay, held, switch) + scores[at]
    path = np.zeros(len(scores), np.int64)
    now = state.argmax(axis=1)
    for step in range(len(active) - 1, -1, -1):
        n = active[step]
        at = begin[:n] + step
        path[at] = now[:n]
        now[:n] = back[at, now[:n]]
    return path


_RESULT = "doc_id long, lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>"


def _labeller(model: Model, penalty: float):
    n_langs = len(model.langs)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*model.langs, "und"], pa.string())
        for batch in batches:
            column = batch.column("text")
            for group in wd.slices(column, GROUP_BYTES):
                n = len(group)
                parts, known, sizes, docs, starts = [], [], [], [], []
                for texts in wd.slices(column.slice(group.first, n)):
                    found = letters(texts)
                    if not len(found.size) or not n_langs:
                        continue
                    begin = np.cumsum(found.size) - found.size
                    score = np.add.reduceat(model.logp[found.trigram], begin, axis=0)
                    allowed = model.allowed[found.script]
                    score = np.where(allowed, score, np.float32(-1e4))
                    foreign = ~allowed.any(axis=1)
                    score[foreign] = 0
                    parts.append(score)
                    known.append(np.where(foreign, 0, found.size))
                    sizes.append(found.size)
                    docs.append(found.doc + texts.first)
                    starts.append(found.start)
                if parts:
                    score, weight, size, doc, start = (np.concatenate(x) for x in (parts, known, sizes, docs, starts))
                    path = viterbi(score, np.searchsorted(doc, np.arange(n + 1)), penalty)
                else:
                    weight = size = doc = start = path = np.zeros(0, np.int64)
                width = max(1, n_langs)
                held = np.bincount(doc * width + path, weights=weight, minlength=n * width).reshape(n, width)
                best, total = held.argmax(axis=1), np.bincount(doc, weights=size, minlength=n)
                turn = np.ones(len(path), bool)
                turn[1:] = (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(turn)
                last = np.append(first[1:], len(path))[: len(first)] - 1
                spans = pa.StructArray.from_arrays(
                    [pa.array(start[first]), pa.array(start[last] + size[last]), names.take(pa.array(path[first]))], names=["start", "end", "lang"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(group.first, n).cast(pa.int64()),
                     names.take(pa.array(np.where(total > 0, best, n_langs))),
                     pa.array(held.max(axis=1) / np.maximum(total, 1)),
                     pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[first], np.arange(n + 1)), pa.int32()), spans)],
                    names=["doc_id", "lang_pred", "score", "spans"])

    return label


def identify(docs: DataFrame, model: Model, penalty: float = 12.0) -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score, spans.

    score is the share of the letters that are in spans of lang_pred; letters of words in a
    script that no language uses count for none, so a text of those alone has score 0 (and the
    first language). Spans have code point
    positions and reach from their first word to their last.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_labeller(model, penalty), _RESULT)
