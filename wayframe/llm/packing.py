"""Hierarchical residual packing of tokenised documents into sequences.

Every document becomes its token ids and one end id. Only a document longer than a
sequence is cut: into full pieces, the first of which may be shorter. Full pieces are
sequences of their own. The others are packed by best fit, longest first, in leaves of
bounded size inside each partition, without a shuffle.

What is left open is merged up a tree, bins as items. After best fit at most one bin of a
leaf is half full or less, and two bins over half full never fit together; so of each node
only that small bin and its emptiest others, as many as a node has children, can matter
further up, and everything else is emitted. A node therefore reads a constant number of
bins however many documents there are, and each level has a fraction of the nodes before.

Defined results: a null text is an empty document, one piece holding the end id alone. A
null doc_id stays null; repeated rows are packed each. Columns other than doc_id and text
are not read.
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayframe.sources.scratch import settle

CAPACITY = 2048
END = 0
FANOUT = 8
LEAF = 20_000
# The vocabulary's own split, without backtracking.
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

_loaded: dict[str, object] = {}


def added_tokens(ranks_file: str) -> dict[str, int]:
    """Ids of the added tokens of the JSON beside a rank file; without one there are none."""
    path = os.path.splitext(ranks_file)[0] + ".json"
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens", [])
    if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"added tokens of {path} that take more or less than their own string")
    return {t["content"]: t["id"] for t in added}


def encoder(ranks_file: str):
    """Ids of a text under a byte-level BPE rank file and the added tokens beside it."""
    if ranks_file not in _loaded:
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        ordinary = tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        added = added_tokens(ranks_file)
        longest_first = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

        def encode(text: str) -> list[int]:
            ids = []
            for k, part in enumerate(longest_first.split(text)):
                ids += [added[part]] if k % 2 else ordinary(part)
            return ids

        _loaded[ranks_file] = encode if added else ordinary
    return _loaded[ranks_file]


def default_ranks() -> str:
    """The rank file of the same vocabulary as byte_bpe_50k.json."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _tokenizer(ranks_file: str | None, capacity: int, end: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_file or default_ranks())
        for batch in batches:
            rows, pieces, starts, lengths, sums, kept = [], [], [], [], [], []
            column = batch.column("text")
            for row in range(batch.num_rows):
                ids = np.array([*encode(column[row].as_py() or ""), end], "<u4")
                at = 0
                for piece in range(-(-len(ids) // capacity)):
                    length = (len(ids) - 1) % capacity + 1 if piece == 0 else capacity
                    part = ids[at: at + length]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at)
                    lengths.append(length)
                    sums.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        kept.append(part.astype(np.int32))
                    at += length
            arrays = [batch.column("doc_id").cast(pa.int64()).take(pa.array(rows, pa.int64())),
                      pa.array(pieces, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return cut


def pieces(docs: DataFrame, ranks_file: str | None = None, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document.

    ranks_file is the vocabulary's rank file at a path every executor has, with the
    vocabulary's JSON beside it if it has added tokens; by default those that come with the
    tokenizers' package.
    """
    ids = ", ids array<int>" if with_ids else ""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(
        _tokenizer(ranks_file, capacity, end, with_ids),
        f"doc_id long, piece int, start long, length long, ids_crc32 long{ids}")


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item, and the bins' fills: longest first, tightest bin first."""
    bins, offsets, fills = [0] * len(lengths), [0] * len(lengths), []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free space
    free = 0  # bit r is set when a bin has r places left
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[item]
        fits = free >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                free &= ~(1 << room)
        else:
            b, room = len(fills), capacity
            fills.append(0)
        bins[item], offsets[item] = b, fills[b]
        fills[b] += size
        left = room - size
        if left:
            insort(open_bins[left], b, key=lambda x: -x)  # the lowest bin is taken first
            free |= 1 << left
    return bins, offsets, fills


def _still_open(fills: list[int], capacity: int, fanout: int) -> list[int]:
    """Bins that can matter to a later merge: the small one and the emptiest others."""
    order = sorted(range(len(fills)), key=lambda b: (fills[b], b))
    small = sum(2 * f <= capacity for f in fills)
    return [b for b in order[: small + fanout] if fills[b] < capacity]


def _leaf_packer(capacity: int, leaf: int, fanout: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            table = pa.Table.from_batches(held).combine_chunks()
            lengths = table.column("length").to_pylist()
            bins, offsets, fills = best_fit(lengths, capacity)
            still = set(_still_open(fills, capacity, fanout))
            out = table.append_column("bin", pa.array(np.array(bins, np.int64) + number))
            out = out.append_column("offset", pa.array(offsets, pa.int64()))
            out = out.append_column("fill", pa.array([fills[b] for b in bins], pa.int64()))
            out = out.append_column("open", pa.array([b in still for b in bins]))
            out = out.append_column("leaf", pa.array(np.full(len(bins), number, np.int64)))
            number += max(1, len(fills))
            held.clear()
            yield from out.to_batches()

        for batch in batches:
            for row in range(0, batch.num_rows, leaf):
                part = batch.slice(row, leaf)
                if held and sum(b.num_rows for b in held) + part.num_rows > leaf:
                    yield from flush()
                held.append(part)
        if held:
            yield from flush()

    return pack


_OPEN = "node long, parts array<struct<bin: long, fill: long>>, fill long, open boolean"


def _merger(capacity: int, fanout: int):
    def merge(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: (-r["fill"], r["parts"][0]["bin"]))
        bins, _, fills = best_fit([r["fill"] for r in rows], capacity)
        parts: list[list[dict]] = [[] for _ in fills]
        for row, b in zip(rows, bins):
            parts[b] += row["parts"]
        still = set(_still_open(fills, capacity, fanout))
        kind = pa.list_(pa.struct([("bin", pa.int64()), ("fill", pa.int64())]))
        return pa.Table.from_arrays(
            [pa.array([key[0].as_py()] * len(fills), pa.int64()), pa.array(parts, kind), pa.array(fills, pa.int64()),
             pa.array([b in still for b in range(len(fills))])],
            names=["node", "parts", "fill", "open"])

    return merge


def pack(cut: DataFrame, capacity: int = CAPACITY, fanout: int = FANOUT, leaf: int = LEAF) -> DataFrame:
    """The rows of ``cut`` (see pieces) with sequence_id and offset."""
    names = cut.columns
    cut = settle(cut, "pieces")
    packed = settle(cut.mapInArrow(
        _leaf_packer(capacity, leaf, fanout),
        ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
        + ", bin long, offset long, fill long, open boolean, leaf long"), "leaves")
    bins = packed.where("open").groupBy("bin").agg(F.min("leaf").alias("node"), F.min("fill").alias("fill"))
    level = settle(bins.select(
        "node", F.array(F.struct("bin", "fill")).alias("parts"), "fill", F.lit(True).alias("open")), "open")
    moved = None
    nodes = level.select("node").distinct().count()
    while nodes > 1:
        nodes = -(-nodes // fanout)
        level = settle(
            level.where("open").withColumn("node", F.pmod(F.xxhash64("node", F.lit(nodes)), F.lit(nodes)))
            .groupBy("node").applyInArrow(_merger(capacity, fanout), _OPEN), "open")
        closed = level.where(F.lit(nodes == 1) | ~F.col("open")).where(F.size("parts") > 1)
        moved = closed if moved is None else moved.union(closed)
    if moved is None:
        return packed.select(*names, F.col("bin").alias("sequence_id"), "offset")
    # Bins that moved: their sequence and the place of their first token in it.
    before = F.aggregate(F.slice("parts", 1, F.col("at").cast("int")), F.lit(0).cast("long"), lambda a, p: a + p["fill"])
    places = moved.select(F.col("parts")[0]["bin"].alias("sequence_id"), "parts", F.posexplode("parts").alias("at", "part")).select(
        F.col("part.bin").alias("bin"), "sequence_id", before.alias("base"))
    return packed.join(places, "bin", "left").select(
        *names, F.coalesce("sequence_id", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))
