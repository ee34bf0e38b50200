"""Quality rules as weak supervision.

Each rule looks at a few counts of a whole text and votes good (1), bad (-1) or abstains
(0). Documents are first counted by their pattern of votes, at most 3**9 patterns whatever
the corpus, and expectation-maximisation over those counts estimates how often each rule
votes which way on good and on bad documents, and the share of good ones. A document is
kept when its posterior probability of being good reaches a threshold; no rule has a veto.

Defined results: a null text or one without words has all counts 0 and fails the base
limits. Every input row gives one output row, repeated rows too; a null doc_id stays null.
With no documents nothing is estimated and the result is empty. Columns other than doc_id
and text are not read; the filtering form returns all columns as they were.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wayframe.llm import words as wd
from wayframe.sources.scratch import settle

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_wide", "n_bangs", "n_distinct_words",
)
MIN_WORDS = 50

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LETTER = _UPPER | np.isin(np.arange(256), np.arange(97, 123))


def count_texts(texts: wd.Texts) -> np.ndarray:
    """The columns of COUNTS for each text."""
    n, data = len(texts), texts.data
    found = wd.words(texts)
    hashes = wd.word_hashes(texts, found)

    def per_text(mask: np.ndarray) -> np.ndarray:
        before = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=before[1:])
        return np.diff(before[texts.offsets])

    in_word = ~wd.SPACE[data]
    # Lines: from a text's start or a line feed to the next line feed or the text's end.
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([texts.offsets[:-1], feeds + 1]))
    ends = np.sort(np.concatenate([texts.offsets[1:], feeds]))
    worded = np.zeros(len(data) + 1, np.int64)
    np.cumsum(in_word, out=worded[1:])
    full = worded[ends] > worded[starts]
    starts, ends = starts[full], ends[full]
    owner = np.searchsorted(texts.offsets, starts, "right") - 1
    lines = np.bincount(owner, minlength=n)
    _, line_of = wd.within(wd.span_hashes(data, starts, ends), owner)
    # Words of three-word windows that occur at least twice in their text.
    values, at = wd.windows(hashes, found, 3)
    order = np.lexsort((values, found.doc[at]))
    v, g = values[order], found.doc[at][order]
    same = (v[1:] == v[:-1]) & (g[1:] == g[:-1])
    twice = np.zeros(len(v), bool)
    twice[1:] |= same
    twice[:-1] |= same
    repeated = np.zeros(len(hashes) + 2, bool)
    for k in range(3):
        repeated[at[order[twice]] + k] = True
    _, word_of = wd.within(hashes, found.doc)
    return np.stack([
        found.counts,
        per_text(in_word & ((data & 0xC0) != 0x80)),
        per_text(_SYMBOL[data]),
        lines - np.bincount(line_of, minlength=n),
        np.bincount(found.doc[repeated[: len(hashes)]], minlength=n),
        lines,
        per_text(_UPPER[data]),
        per_text(_LETTER[data]),
        per_text(data >= 0xC0),
        per_text(data == 33),
        np.bincount(word_of, minlength=n),
    ])


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def text_counts(text: pa.Array) -> pa.Array:
    parts = [count_texts(t) for t in wd.slices(text)]
    columns = np.concatenate(parts, axis=1) if parts else np.zeros((len(COUNTS), 0), np.int64)
    return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=list(COUNTS))


def _vote(bad: Column, good: Column) -> Column:
    """0 for bad, 2 for good, 1 to abstain: a digit of the pattern."""
    return F.when(bad, 0).when(good, 2).otherwise(1)


def rules() -> list[Column]:
    """The votes; all shares are in whole numbers, so that no rounding can flip one."""
    c = {name: F.col(f"counts.{name}") for name in COUNTS}
    words, none = c["n_words"], F.col("counts.n_words") == 0
    long = words >= MIN_WORDS
    return [
        _vote(~long, words >= 2 * MIN_WORDS),
        _vote(none | (c["word_chars"] < 2 * words) | (c["word_chars"] > 15 * words),
              (c["word_chars"] >= 3 * words) & (c["word_chars"] <= 10 * words)),
        _vote(10 * c["n_symbols"] > words, 50 * c["n_symbols"] <= words),
        _vote(10 * c["n_dup_lines"] > 3 * c["n_lines"], (c["n_dup_lines"] == 0) & (c["n_lines"] > 1)),
        _vote(2 * c["n_repeat_words"] > words, long & (5 * c["n_repeat_words"] <= words)),
        _vote(2 * c["n_upper"] > c["n_letters"], (c["n_letters"] > 0) & (5 * c["n_upper"] <= c["n_letters"])),
        _vote(5 * c["n_bangs"] > words, long & (50 * c["n_bangs"] <= words)),
        _vote(long & (10 * c["n_distinct_words"] < words), long & (3 * c["n_distinct_words"] >= words)),
        _vote(4 * (c["n_letters"] + c["n_wide"]) < 3 * c["word_chars"],
              (words > 0) & (20 * (c["n_letters"] + c["n_wide"]) >= 17 * c["word_chars"])),
    ]


def vote_pattern() -> Column:
    pattern = F.lit(0)
    for vote in rules():
        pattern = pattern * 3 + vote
    return pattern.cast("int")


def base_failed() -> Column:
    return (F.col("counts.n_words") < MIN_WORDS) | (100 * F.col("counts.n_repeat_words") > 50 * F.col("counts.n_words"))


def estimate(patterns: np.ndarray, counts: np.ndarray, n_rules: int, rounds: int = 200) -> np.ndarray:
    """Posterior probability of good for each pattern, by expectation-maximisation.

    Each rule has its own accuracy on good and on bad documents, over the votes it casts.
    The start also settles which class is the good one; it stops when no posterior moves by
    a billionth.
    """
    if not len(patterns):
        return np.zeros(0)
    votes = np.stack([patterns // 3 ** (n_rules - 1 - k) % 3 - 1 for k in range(n_rules)], axis=1)
    weight = counts.astype(float)
    # A single vote against starts as doubt: most rules see one kind of bad text only.
    good = np.where((votes < 0).any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        classes = np.stack([1 - good, good], axis=1) * weight[:, None]
        score = np.tile(np.log((classes.sum(axis=0) + 1) / (weight.sum() + 2)), (len(votes), 1))
        for k in range(n_rules):
            # Of the votes cast on either class, the share for and against; abstaining says nothing.
            cast = np.stack([classes[votes[:, k] == v].sum(axis=0) + 1 for v in (-1, 1)])
            log = np.log(cast / cast.sum(axis=0))
            score += np.where((votes[:, k] == 0)[:, None], 0.0, log[(votes[:, k] > 0).astype(int)])
        after = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -700, 700)))
        moved, good = np.abs(after - good).max(), after
        if moved < 1e-9:
            break
    return good


def posteriors(counted: DataFrame) -> list[tuple[int, float]]:
    """(pattern, posterior) of every pattern that occurs; at most 3**9 rows reach the driver."""
    rows = counted.groupBy(vote_pattern().alias("pattern")).count().orderBy("pattern").collect()
    good = estimate(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), len(rules()))
    return [(r[0], float(p)) for r, p in zip(rows, good)]


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per row of docs: doc_id, the counts, base_failed, posterior, kept."""
    counted = settle(docs.select("doc_id", text_counts(F.col("text").cast("string")).alias("counts")), "counts")
    # At most 3**9 rows, so that a broadcast has a proven bound.
    found = docs.sparkSession.createDataFrame(posteriors(counted), "pattern int, posterior double")
    return (
        counted.withColumn("pattern", vote_pattern()).join(F.broadcast(found), "pattern")
        .select("doc_id", "counts.*", base_failed().alias("base_failed"), "posterior",
                (~base_failed() & (F.col("posterior") >= threshold)).alias("kept"))
    )


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that pass; counts are taken again instead of shuffling the texts."""
    text = text_counts(F.col("text").cast("string"))
    found = posteriors(settle(docs.select(text.alias("counts")), "counts"))
    passed = [p for p, good in found if good >= threshold]
    view = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("counts"))
    return view.where(~base_failed() & vote_pattern().isin(passed)).select("row.*")
