"""Exact cosine search over a table of frame vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wayframe.functions.vectors import EPSILON

TOKEN, VECTOR = "sample_data_token", "vector"
# Queries a task holds while it scans the store once, and the results it may hold for them.
QUERY_BLOCK = 512
HELD_RESULTS = 2_000_000
MERGE_PARTS = 64

# Columns of a search result.
RESULT_COLUMNS = (
    "sample_data_token", "scene_name", "scene_description", "channel", "filename",
    "timestamp", "location", "is_night", "is_rain", "n_boxes", "thumbnail", "score",
)


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.maximum(lengths, EPSILON)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: score descending, then id."""
    return np.lexsort((ids, -scores))[:k]


def _scan(queries: np.ndarray, names: Sequence, ks: Sequence[int], schema: pa.Schema):
    """Task body: the best rows of one partition for every query of a block.

    A matrix product shortlists each batch; the few rows that could still matter are then
    scored one row at a time, so a vector's score never depends on the batch it came in
    and equal vectors tie exactly.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = [(None, None)] * len(queries)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            sizes = np.unique(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
            if sizes.tolist() != [queries.shape[1]]:
                raise ValueError(f"queries have {queries.shape[1]} dimensions, stored vectors {sizes.tolist()}")
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            store = _unit_rows(flat.reshape(batch.num_rows, -1).astype(np.float64))
            rough = store @ queries.T
            for q, k in enumerate(ks):
                column = rough[:, q]
                old_ids, old_scores = held[q]
                floor = old_scores[-1] if old_ids is not None and len(old_ids) == k else -2.0
                if len(column) > k:
                    floor = max(floor, np.partition(column, -k)[-k])
                near = np.flatnonzero(column >= floor - 1e-9)
                if len(near) == 0:
                    continue
                exact = (store[near] * queries[q]).sum(axis=1)
                new_ids = ids[near]
                if old_ids is not None:
                    new_ids = np.concatenate([old_ids, new_ids])
                    exact = np.concatenate([old_scores, exact])
                keep = _best(new_ids, exact, k)
                held[q] = (new_ids[keep], exact[keep])
        for name, (ids, scores) in zip(names, held):
            if ids is not None:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(ids), schema.field(0).type),
                        pa.array(ids, schema.field(1).type),
                        pa.array(scores, schema.field(2).type),
                    ],
                    schema=schema,
                )

    return run


def _query_blocks(queries: DataFrame, block: int) -> Iterator[list]:
    """Queries in driver-sized blocks: one when there are few, else by hash."""
    rows = queries.limit(block + 1).collect()
    if len(rows) <= block:
        yield rows
        return
    parts = 2 * -(-queries.count() // block)
    part_of = F.pmod(F.xxhash64("query_id"), F.lit(parts))
    for part in range(parts):
        yield queries.filter(part_of == part).collect()


def top_k_batch(
    store: DataFrame,
    queries: DataFrame,
    k: int | None = None,
    *,
    token: str = TOKEN,
    vector: str = VECTOR,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k nearest rows of ``store`` for each query: ``query_id, <token>, score, rank``.

    ``queries`` has ``query_id`` and ``vector``, and ``k`` as a column when the argument is
    None. Queries go to the tasks in blocks of at most about ``query_block`` (fewer when k
    is large), the store is scanned once per block, and every partition hands on at most k rows per query, so no
    query-by-store product is ever shuffled.
    """
    columns = ["query_id", "vector"] + (["k"] if k is None else [])
    plan = queries.select(*columns)
    id_type = store.schema[token].dataType
    out = T.StructType(
        [
            plan.schema["query_id"],
            T.StructField(token, id_type),
            T.StructField("score", T.DoubleType()),
        ]
    )
    most = k if k is not None else plan.agg(F.max("k")).first()[0]
    block = max(1, min(query_block, HELD_RESULTS // max(1, most or 1)))
    narrow = store.filter(F.col(vector).isNotNull()).select(token, vector)
    limits, parts = [], []
    for rows in _query_blocks(plan, block):
        rows = [(r.query_id, r.vector, k if k is not None else int(r.k)) for r in rows]
        rows = [r for r in rows if r[2] > 0]
        if not rows:
            continue
        matrix = _unit_rows(np.array([v for _, v, _ in rows], dtype=np.float64))
        names, ks = [r[0] for r in rows], [r[2] for r in rows]
        parts.append(narrow.mapInArrow(_scan(matrix, names, ks, to_arrow_schema(out)), out))
        limits += zip(names, ks)
    if not parts:
        return store.sparkSession.createDataFrame([], out).withColumn("rank", F.lit(0))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    if k is None:
        schema = T.StructType([plan.schema["query_id"], T.StructField("_k", T.IntegerType())])
        found = found.join(store.sparkSession.createDataFrame(limits, schema), "query_id")
        limit = F.col("_k")
    else:
        limit = F.lit(k)
    # Merge in two levels so that one query's partial results never meet in one task.
    part_of = F.pmod(F.xxhash64(token), F.lit(MERGE_PARTS))
    order = [F.desc("score"), F.asc(token)]
    local = Window.partitionBy("query_id", part_of).orderBy(*order)
    final = Window.partitionBy("query_id").orderBy(*order)
    return (
        found.withColumn("rank", F.row_number().over(local))
        .filter(F.col("rank") <= limit)
        .withColumn("rank", F.row_number().over(final))
        .filter(F.col("rank") <= limit)
        .select("query_id", token, "score", "rank")
    )


def with_context(hits: DataFrame, store: DataFrame, token: str = TOKEN) -> DataFrame:
    """Attach the stored context columns to search hits."""
    context = [c for c in RESULT_COLUMNS if c in store.columns and c not in (token, "score")]
    return hits.join(store.select(token, *context), token)


def top_k(
    store: DataFrame,
    query: Sequence[float],
    k: int,
    *,
    exclude: object | None = None,
    token: str = TOKEN,
    vector: str = VECTOR,
) -> DataFrame:
    """The k rows nearest to one query vector, with ``score`` = 1 - cosine distance."""
    spark = store.sparkSession
    searched = store if exclude is None else store.filter(F.col(token) != F.lit(exclude))
    queries = spark.createDataFrame(
        [(0, [float(x) for x in query])], "query_id int, vector array<double>"
    )
    hits = top_k_batch(searched, queries, k, token=token, vector=vector)
    return hits.select(token, "score", "rank")


def vector_for(
    store: DataFrame, value: object, *, token: str = TOKEN, vector: str = VECTOR
) -> list[float] | None:
    """The stored vector of one frame, None when the token is unknown."""
    row = store.filter(F.col(token) == F.lit(value)).select(vector).first()
    return None if row is None else list(row[0])


def similar_to(
    store: DataFrame, value: object, k: int, *, token: str = TOKEN, vector: str = VECTOR
) -> DataFrame:
    """The k frames most similar to a stored one, itself excluded."""
    query = vector_for(store, value, token=token, vector=vector)
    if query is None:
        raise KeyError(f"no stored vector for {value!r}")
    return top_k(store, query, k, exclude=value, token=token, vector=vector)


def search_text(store: DataFrame, text: str, k: int, embedder, **names) -> DataFrame:
    """The k frames nearest to a text, embedded in the store's vector space."""
    one = store.sparkSession.createDataFrame([(text,)], "text string")
    query = embedder.embed(one, "text").select("vector").first()[0]
    return top_k(store, list(query), k, **names)


def search_image(store: DataFrame, image: bytes, k: int, embedder, **names) -> DataFrame:
    """The k frames nearest to an image, embedded in the store's vector space."""
    one = store.sparkSession.createDataFrame([(bytearray(image),)], "image binary")
    query = embedder.embed(one, "image").select("vector").first()[0]
    return top_k(store, list(query), k, **names)


def read_vectors(store: DataFrame, tokens: DataFrame, token: str = TOKEN, vector: str = VECTOR):
    """Stored vectors of a set of tokens."""
    return store.select(token, vector).join(tokens.select(token), token, "left_semi")
