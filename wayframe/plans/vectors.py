"""Queries over frame vectors: search, clustering and mining."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wayframe.functions.vectors import cosine_score, normalize
from wayframe.operators import embedding, mining, search
from wayframe.plans.metadata import flat_tables
from wayframe.plans.proxies import table
from wayframe.plans.registry import query, r6, rounded, view
from wayframe.sources.scratch import settle

TOKEN = "sample_data_token"
_SCORE = (
    "list_inner_product(CAST(a.vector AS DOUBLE[]), CAST(b.vector AS DOUBLE[]))"
    " / (sqrt(list_inner_product(CAST(a.vector AS DOUBLE[]), CAST(a.vector AS DOUBLE[])))"
    " * sqrt(list_inner_product(CAST(b.vector AS DOUBLE[]), CAST(b.vector AS DOUBLE[]))))"
)
view("probe", "SELECT sample_data_token, vector FROM {vectors} WHERE sample_data_token = 'v7'")
view("centroids", """
    SELECT label AS query_id, list(m ORDER BY i) AS vector FROM (
      SELECT label, i, avg(vector[i]) AS m FROM {vectors}, (SELECT unnest(range(1, 65)) AS i)
      GROUP BY ALL) GROUP BY label""")
view("centroid_scores", f"""
    SELECT a.query_id, b.sample_data_token, b.label, {_SCORE} AS score
    FROM {{centroids}} a, {{vectors}} b""")


def _centroids(vectors):
    """Mean vector per label."""
    parts = vectors.select("label", F.posexplode("vector").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg("x").alias("m"))
    lists = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("v"))
    return lists.select(
        F.col("label").alias("query_id"), F.transform("v", lambda x: x["m"]).alias("vector")
    )


def _millionths(vector) -> Column:
    """All components in whole millionths, as one text."""
    return F.array_join(F.transform(vector, lambda x: F.rint(x.cast("double") * 1e6).cast("long").cast("string")), ",")


_MILLIONTHS_SQL = (
    "array_to_string(list_transform({}, lambda x: CAST(CAST(round_even({}, 0) AS BIGINT) AS VARCHAR)), ',')")


@query("P19", f"""
    SELECT sample_data_token, {_MILLIONTHS_SQL.format("vector", "CAST(x AS DOUBLE) / n * 1e6")} AS unit,
      {r6("n")} AS norm FROM (
      SELECT *, sqrt(list_inner_product(CAST(vector AS DOUBLE[]), CAST(vector AS DOUBLE[]))) AS n
      FROM {{vectors}})""")
def normalized_vectors(spark, d):
    unit = normalize(F.col("vector"))
    length = F.sqrt(F.aggregate(
        "vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    ))
    return rounded(
        table(spark, d, "vectors").select(
            TOKEN, _millionths(unit).alias("unit"), length.alias("norm")
        ), "norm",
    )


@query("P20 J17", f"""
    SELECT b.sample_data_token, {r6(_SCORE)} AS score FROM {{probe}} a, {{vectors}} b""")
def cosine_scores(spark, d):
    vectors = table(spark, d, "vectors")
    probe = search.vector_for(vectors, "v7")
    score = cosine_score(F.col("vector"), F.array(*[F.lit(float(x)) for x in probe]))
    return rounded(vectors.select(TOKEN, score.alias("score")), "score")


@query("T2 P20 J17", f"""
    SELECT b.sample_data_token, {r6(_SCORE)} AS score,
      CAST(row_number() OVER (ORDER BY {_SCORE} DESC, b.sample_data_token) AS INT) AS rank
    FROM {{probe}} a, {{vectors}} b ORDER BY rank LIMIT 12""")
def vector_top_k(spark, d):
    vectors = table(spark, d, "vectors")
    return rounded(search.top_k(vectors, search.vector_for(vectors, "v7"), 12), "score")


@query("T3 T2 J17", f"""
    SELECT b.sample_data_token, b.scene_name, b.channel, b.is_night, {r6(_SCORE)} AS score
    FROM {{probe}} a, {{vectors}} b WHERE b.sample_data_token <> 'v7'
    ORDER BY {_SCORE} DESC, b.sample_data_token LIMIT 12""")
def vector_similar(spark, d):
    vectors = table(spark, d, "vectors")
    hits = search.similar_to(vectors, "v7", 12)
    found = search.with_context(hits, vectors)
    return rounded(found.select(TOKEN, "scene_name", "channel", "is_night", "score"), "score")


@query("J15 T3", f"""
    SELECT query_id, sample_data_token, {r6("score")} AS score, CAST(rank AS INT) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, sample_data_token)
        AS rank FROM {{centroid_scores}}) WHERE rank <= 15""")
def centroid_top_k(spark, d):
    vectors = table(spark, d, "vectors")
    return rounded(search.top_k_batch(vectors, _centroids(vectors), 15), "score")


@query("J16 J7", f"""
    SELECT sample_data_token, CAST(label AS INT) AS label, len(vector) AS dim,
      {_MILLIONTHS_SQL.format("vector", "CAST(x AS DOUBLE) * 1e6")} AS components
    FROM {{vectors}} WHERE label IN (2, 3)""")
def read_vectors(spark, d):
    vectors = table(spark, d, "vectors")
    tokens = vectors.filter(F.col("label").isin(2, 3)).select(TOKEN)
    found = search.read_vectors(vectors, tokens)
    labels = vectors.select(TOKEN, "label")
    return found.join(labels, TOKEN).select(
        TOKEN, "label", F.size("vector").cast("long").alias("dim"), _millionths("vector").alias("components")
    )


# Labels 8 and 9 are failures, 0 to 6 the pool, 7 the baseline.
view("failing", """
    SELECT sample_data_token, vector, label, is_night, CAST(len(scene_name) AS DOUBLE) + label
      AS failure_score FROM {vectors} WHERE label >= 8""")


@query("A8", f"""
    SELECT CAST(c AS INT) AS cluster, count(label) AS size,
      {r6("coalesce(avg(CAST(is_night AS INT)), 0)")} AS night_share,
      {r6("coalesce(avg(failure_score), 0)")} AS mean_failure_score
    FROM (SELECT unnest(range(12)) AS c) LEFT JOIN (SELECT label, is_night,
      CAST(len(scene_name) AS DOUBLE) + label AS failure_score FROM {{vectors}}) ON label = c
    GROUP BY c""")
def cluster_diagnostics(spark, d):
    vectors = table(spark, d, "vectors")
    score = F.length("scene_name").cast("double") + F.col("label")
    failures = vectors.select(TOKEN, "is_night", score.alias("failure_score"))
    assigned = vectors.select(TOKEN, F.col("label").alias("cluster"))
    stats = mining.cluster_stats(assigned, failures, 12)
    return rounded(stats, "night_share", "mean_failure_score")


N_MINE, OVERFETCH = 120, 2
# Fewer than N_MINE in all, so every cluster's quota is its size.
QUOTA_BY_LABEL = {0: 1, 1: 2, 2: 3, 3: 4, 4: 5, 5: 6, 6: 7, 7: 8, 8: 9, 9: 10}
_QUOTAS = "(VALUES " + ", ".join(
    f"({c}, {q}, {i})"
    for i, (c, q) in enumerate(sorted(QUOTA_BY_LABEL.items(), key=lambda x: (-x[1], x[0])), 1)
) + ") q(cluster, quota, turn)"
view("candidates", f"""
    SELECT turn, cluster, quota, list({{{{'t': sample_data_token, 's': score}}}}
      ORDER BY score DESC, sample_data_token) AS found
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, sample_data_token)
            AS rank FROM {{centroid_scores}} WHERE label <= 6)
    JOIN {_QUOTAS} ON query_id = cluster WHERE rank <= quota * {OVERFETCH} GROUP BY ALL""")
def _picking(own: str, candidates: str) -> str:
    """A turn per row: what is taken so far and the cluster's picks."""
    return f"""
    SELECT CAST(0 AS INT) AS turn, CAST([] AS VARCHAR[]) AS taken,
      CAST(NULL AS INT) AS cluster, CAST([] AS STRUCT(t VARCHAR, s DOUBLE)[]) AS picks
    UNION ALL
    SELECT CAST(turn AS INT), list_concat(taken, list_transform(picks, lambda p: p.t)), cluster,
      picks
    FROM (SELECT c.turn, p.taken, c.cluster,
            list_filter(c.found, lambda f: NOT list_contains(p.taken, f.t))[:c.quota] AS picks
          FROM {own} p JOIN {{{candidates}}} c ON c.turn = p.turn + 1)"""


view("picking", _picking("picking", "candidates"))
view("first_picks", """
    SELECT cluster, p.t AS sample_data_token, p.s AS score
    FROM (SELECT cluster, unnest(picks) AS p FROM {picking})""")
view("spare_picks", f"""
    SELECT cluster, sample_data_token, score FROM (
      SELECT cluster, f.t AS sample_data_token, f.s AS score, row_number() OVER
        (PARTITION BY f.t ORDER BY f.s DESC, turn) AS again
      FROM (SELECT cluster, turn, unnest(found) AS f FROM {{candidates}})
      WHERE f.t NOT IN (SELECT sample_data_token FROM {{first_picks}}))
    WHERE again = 1 QUALIFY row_number() OVER (ORDER BY score DESC, sample_data_token)
      <= {N_MINE} - (SELECT count(*) FROM {{first_picks}})""")


@query("W7 J15 W1 U2", f"""
    SELECT CAST(cluster AS INT) AS cluster, sample_data_token, {r6("score")} AS score,
      {r6("1 - score")} AS distance
    FROM (SELECT * FROM {{first_picks}} UNION ALL SELECT * FROM {{spare_picks}})""")
def mined_frames(spark, d):
    vectors = table(spark, d, "vectors")
    centroids = _centroids(vectors).withColumnRenamed("query_id", "cluster")
    pool = vectors.filter(F.col("label") <= 6)
    mined = mining.mine(centroids, pool, QUOTA_BY_LABEL, N_MINE, OVERFETCH)
    return rounded(mined, "score", "distance")


# Six clusters of one centre: all but the first find their own nearest frames taken.
view("crowded_scores", """
    SELECT q.query_id, s.sample_data_token, s.label, s.score FROM {centroid_scores} s
    JOIN (SELECT unnest(range(10)) AS query_id) q ON s.query_id = CASE WHEN q.query_id < 6 THEN 0 ELSE q.query_id END""")
view("crowded_candidates", f"""
    SELECT turn, cluster, quota, list({{{{'t': sample_data_token, 's': score}}}}
      ORDER BY score DESC, sample_data_token) AS found
    FROM (SELECT * FROM {{crowded_scores}} WHERE label <= 6) JOIN {_QUOTAS} ON query_id = cluster GROUP BY ALL""")
view("crowded_picking", _picking("crowded_picking", "crowded_candidates"))
view("crowded_picks", """
    SELECT cluster, p.t AS sample_data_token, p.s AS score
    FROM (SELECT cluster, unnest(picks) AS p FROM {crowded_picking})""")


@query("W7 J15 W1 U2", f"""
    SELECT CAST(cluster AS INT) AS cluster, sample_data_token, {r6("score")} AS score, {r6("1 - score")} AS distance
    FROM (SELECT * FROM {{crowded_picks}} UNION ALL (
      SELECT cluster, sample_data_token, score FROM (
        SELECT cluster, f.t AS sample_data_token, f.s AS score, row_number() OVER
          (PARTITION BY f.t ORDER BY f.s DESC, turn) AS again
        FROM (SELECT cluster, turn, unnest(found) AS f FROM {{crowded_candidates}})
        WHERE f.t NOT IN (SELECT sample_data_token FROM {{crowded_picks}}))
      WHERE again = 1 QUALIFY row_number() OVER (ORDER BY score DESC, sample_data_token)
        <= {N_MINE} - (SELECT count(*) FROM {{crowded_picks}})))""")
def mined_to_completion(spark, d):
    """Every quota is filled and N_MINE frames are found, though the clusters crowd each other out."""
    vectors = table(spark, d, "vectors")
    centers = settle(_centroids(vectors), "centroids")
    same = centers.filter("query_id = 0").select(F.explode(F.sequence(F.lit(0), F.lit(5))).alias("cluster"), "vector")
    centroids = same.unionByName(centers.filter("query_id >= 6").select(F.col("query_id").cast("int").alias("cluster"), "vector"))
    return rounded(mining.mine(centroids, vectors.filter(F.col("label") <= 6), QUOTA_BY_LABEL, N_MINE), "score", "distance")


def _mining_run(spark, d):
    vectors = table(spark, d, "vectors")
    score = F.length("scene_name").cast("double") + F.col("label")
    failures = vectors.filter(F.col("label") >= 8).withColumn("failure_score", score)
    role = F.when(F.col("label") <= 6, "pool").otherwise("baseline")
    split = vectors.filter(F.col("label") < 8).select("scene_name", role.alias("role")).distinct()
    return vectors, mining.run_mining(
        failures, split, vectors, vectors, top_k=80, n_clusters=2, n_mine=60, restarts=3
    )


def _k_means_views(name: str, source: str, k: int, restarts: int, seed: int = 64) -> None:
    """Views of exact k-means: points, farthest-first seeds, Lloyd's rounds and the best restart's clusters."""

    def away(c: str, p: str) -> str:
        return f"CAST(list_sum(list_transform(list_zip({c}, {p}), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"

    view(f"{name}_points", f"""
        SELECT sample_data_token AS t, list_transform(vector, lambda x: CAST(round_even(CAST(x AS DOUBLE) * 1000000, 0) AS BIGINT)) AS p
        FROM {{{source}}}""")
    view(f"{name}_seeds", f"""
        SELECT r, 1 AS n, [p] AS centers FROM (
          SELECT p, row_number() OVER (ORDER BY md5(concat_ws('|', t, '{seed}')), t) AS r FROM {{{name}_points}}) WHERE r <= {restarts}
        UNION ALL
        SELECT r, n + 1, list_append(any_value(centers), arg_min(p, turn)) FROM (
          SELECT s.r, s.n, s.centers, x.p, lpad(CAST(1000000000000000000
            - list_min(list_transform(s.centers, lambda c: {away("c", "x.p")})) AS VARCHAR), 20, '0') || x.t AS turn
          FROM {name}_seeds s, {{{name}_points}} x WHERE s.n < {k}) GROUP BY r, n""")
    view(f"{name}_rounds", f"""
        SELECT r, 0 AS round, centers, false AS done FROM {{{name}_seeds}} WHERE n = {k}
        UNION ALL
        SELECT r, round + 1, fresh, fresh = centers FROM (
          SELECT r, round, centers, list_transform(range(1, {k + 1}), lambda j: coalesce(moved[j], centers[j])) AS fresh FROM (
            SELECT r, round, any_value(centers) AS centers, map(list(j), list(c)) AS moved FROM (
              SELECT r, round, any_value(centers) AS centers, j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
                SELECT r, round, any_value(centers) AS centers, j, i, CAST(sum(p[i]) AS BIGINT) AS s, count(*) AS n FROM (
                  SELECT r, round, centers, p, CAST(list_position(d, list_min(d)) AS BIGINT) AS j FROM (
                    SELECT s.r, s.round, s.centers, x.p, list_transform(s.centers, lambda c: {away("c", "x.p")}) AS d
                    FROM {name}_rounds s, {{{name}_points}} x WHERE NOT s.done)),
                  (SELECT unnest(range(1, 65)) AS i) GROUP BY r, round, j, i) GROUP BY r, round, j) GROUP BY r, round))""")
    view(f"{name}_best", f"""
        SELECT any_value(centers) AS centers FROM (
          SELECT s.r, s.centers, list_min(list_transform(s.centers, lambda c: {away("c", "x.p")})) AS cost
          FROM {{{name}_rounds}} s, {{{name}_points}} x WHERE s.done) GROUP BY r ORDER BY sum(cost), r LIMIT 1""")
    view(f"{name}_assigned", f"""
        SELECT t AS sample_data_token, CAST(list_position(d, list_min(d)) - 1 AS INT) AS cluster FROM (
          SELECT x.t, list_transform(b.centers, lambda c: {away("c", "x.p")}) AS d
          FROM {{{name}_best}} b, {{{name}_points}} x)""")


view("worst", "SELECT * FROM {failing} ORDER BY failure_score DESC, sample_data_token LIMIT 80")
_k_means_views("worst_clusters", "worst", 2, 3)
_k_means_views("failing_clusters", "failing", 3, 2)


@query("M3 M5 A8 T1", f"""
    SELECT c AS cluster, count(failure_score) AS size, {r6("coalesce(avg(CAST(is_night AS INT)), 0)")} AS night_share,
      {r6("coalesce(avg(failure_score), 0)")} AS mean_failure_score
    FROM (SELECT CAST(unnest(range(2)) AS INT) AS c) LEFT JOIN {{worst_clusters_assigned}} ON cluster = c
    LEFT JOIN {{worst}} USING (sample_data_token) GROUP BY c""")
def failure_clusters(spark, d):
    """Clusters of the worst failures, as the mining run reports them."""
    return rounded(_mining_run(spark, d)[1].clusters, "night_share", "mean_failure_score")


@query("M3", "SELECT sample_data_token, cluster FROM {failing_clusters_assigned}")
def cluster_assignments(spark, d):
    """The cluster of every failure."""
    failing = table(spark, d, "vectors").filter(F.col("label") >= 8)
    return mining.cluster_failures(failing, k=3, restarts=2)[0]


# The whole run: quotas by cluster size, then each cluster's nearest free frames in turn.
view("mined_sizes", """
    SELECT c AS cluster, greatest(count(sample_data_token), 1) AS n
    FROM (SELECT CAST(unnest(range(2)) AS INT) AS c) LEFT JOIN {worst_clusters_assigned} ON cluster = c GROUP BY c""")
view("mined_quotas", """
    SELECT *, row_number() OVER (ORDER BY quota DESC, cluster) AS turn FROM (
      SELECT cluster, CASE WHEN t <= 60 THEN n ELSE 60 * n // t + CASE WHEN row_number() OVER (
          ORDER BY 60 * n % t DESC, n DESC, cluster) <= 60 - sum(60 * n // t) OVER () THEN 1 ELSE 0 END END AS quota
      FROM (SELECT *, sum(n) OVER () AS t FROM {mined_sizes}))""")
view("mined_candidates", f"""
    SELECT turn, cluster, quota, list({{{{'t': sample_data_token, 's': score}}}} ORDER BY score DESC, sample_data_token) AS found
    FROM (SELECT a.cluster, a.quota, a.turn, b.sample_data_token, {_SCORE} AS score
      FROM (SELECT q.*, list_transform(k.centers[q.cluster + 1], lambda x: CAST(x AS DOUBLE) / 1000000) AS vector
            FROM {{mined_quotas}} q, {{worst_clusters_best}} k) a, {{vectors}} b WHERE b.label <= 6) GROUP BY ALL""")
view("mined_picking", _picking("mined_picking", "mined_candidates"))
view("mined_picks", "SELECT cluster, p.t AS sample_data_token, p.s AS score FROM (SELECT cluster, unnest(picks) AS p FROM {mined_picking})")


@query("M5 M3 W7 J15 W1 T1", f"""
    SELECT CAST(cluster AS INT) AS cluster, sample_data_token, {r6("score")} AS score
    FROM (SELECT * FROM {{mined_picks}} UNION ALL (
      SELECT cluster, sample_data_token, score FROM (
        SELECT cluster, f.t AS sample_data_token, f.s AS score, row_number() OVER
          (PARTITION BY f.t ORDER BY f.s DESC, turn) AS again
        FROM (SELECT cluster, turn, unnest(found) AS f FROM {{mined_candidates}})
        WHERE f.t NOT IN (SELECT sample_data_token FROM {{mined_picks}}))
      WHERE again = 1 QUALIFY row_number() OVER (ORDER BY score DESC, sample_data_token)
        <= 60 - (SELECT count(*) FROM {{mined_picks}})))""")
def mined_failures(spark, d):
    """The frames that a whole mining run picks for its clusters of failures."""
    return rounded(_mining_run(spark, d)[1].mined.select("cluster", TOKEN, "score"), "score")


@query("M5 W6 J19 U3", """
    SELECT least(60, count(*)) AS n_mined, least(60, count(*)) AS n_random,
      avg(CAST(is_night AS INT)) AS night_share, count(*) > 0 AS inside_pool
    FROM {vectors} WHERE label <= 6""")
def mining_invariants(spark, d):
    """What must hold for any clustering: exact sizes, and only (day) pool frames."""
    vectors, run = _mining_run(spark, d)
    summary = mining.mining_summary(run.mined, run.random, vectors)
    pool = vectors.filter(F.col("label") <= 6).select(TOKEN)
    outside = run.mined.join(pool, TOKEN, "left_anti").isEmpty()
    return summary.withColumn("inside_pool", F.lit(outside))


# --- embedding ------------------------------------------------------------------------


@query("M1 M2 J5 J8")
def text_vectors(spark, d):
    """Hashed text vectors of whole documents; Spark's token hash has no SQL form."""
    docs = table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias(TOKEN), F.col("source").alias("scene_name"), "text"
    )
    done = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias(TOKEN))
    rows = embedding.embed_frames(
        docs, embedding.HashedTextEmbedder(64), "text", manifest=None, done=done
    )
    return rows.select(TOKEN, "scene_name", F.size("vector").alias("dim"))


@query("M1", f"""
    SELECT sample_data_token, {_MILLIONTHS_SQL.format(
        "[a, b, c]", "CAST(CAST(x / n AS FLOAT) AS DOUBLE) * 1e6")} AS unit
    FROM (SELECT *, greatest(sqrt(a * a + b * b + c * c), 1e-12) AS n FROM (
      SELECT CAST(doc_id AS VARCHAR) AS sample_data_token, CAST(length(text) AS DOUBLE) AS a,
        CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS b,
        CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS c FROM documents))""")
def function_vectors(spark, d):
    """A user's model as the embedder: lengths and two letter counts, as unit vectors."""

    def load():
        return lambda texts: [[len(t), t.count("e"), t.count(" ")] for t in texts]

    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias(TOKEN), "text")
    found = embedding.FunctionEmbedder(load, 3, "counts").embed(docs, "text")
    return found.select(TOKEN, _millionths("vector").alias("unit"))


@query("T3 M1")
def text_search(spark, d):
    """Nearest documents to a phrase, in the hashed text space."""
    embedder = embedding.HashedTextEmbedder(64)
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias(TOKEN), "text")
    store = settle(embedder.embed(docs, "text").select(TOKEN, "vector"), "text-vectors")
    return rounded(search.search_text(store, "the of and in", 10, embedder), "score")


@query("S2 S9 A26 J8", """
    SELECT count(DISTINCT scene_name) AS scenes_processed, CAST(0 AS BIGINT) AS scenes_skipped,
      count(*) AS frames_added, CAST(0 AS BIGINT) AS unreadable, count(*) AS total,
      CAST(0 AS BIGINT) AS added_again
    FROM {samples}""")
def embedding_job(spark, d):
    """Embed scene descriptions into a new store, then run again: nothing is added."""
    from wayframe.sources.scratch import scratch_path

    frames = settle(flat_tables(spark, d)[0], "frames")
    store, embedder = scratch_path(spark, "store"), embedding.HashedTextEmbedder(16)
    first = embedding.run_embedding(frames, embedder, "scene_description", store)
    again = embedding.run_embedding(frames, embedder, "scene_description", store)
    row = {**first, "added_again": again["frames_added"]}
    schema = ", ".join(f"{name} long" for name in row)
    return spark.createDataFrame([tuple(row.values())], schema)
