"""Mining pool frames that resemble clusters of failures."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayframe.operators.clusters import k_means
from wayframe.operators.draw import allocate
from wayframe.operators.matching import top_failures
from wayframe.operators.sampling import (
    frames_with_role, random_control, require_disjoint, require_subset,
)
from wayframe.operators.search import TOKEN, VECTOR, read_vectors, top_k_batch
from wayframe.sources.scratch import settle


def cluster_failures(
    vectors: DataFrame, k: int = 8, seed: int = 64, restarts: int = 10
) -> tuple[DataFrame, DataFrame]:
    """k-means over failure vectors, best of several seeded restarts.

    Returns (``token, cluster`` assignments, ``cluster, vector`` centroids). See
    :mod:`wayframe.operators.clusters`.
    """
    assigned, centers = k_means(vectors, k, seed=seed, restarts=restarts, token=TOKEN, vector=VECTOR)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centers)]
    return assigned, vectors.sparkSession.createDataFrame(rows, "cluster int, vector array<double>")


def cluster_stats(assigned: DataFrame, failures: DataFrame, k: int) -> DataFrame:
    """Size, night share and mean score of each cluster; empty clusters keep a row of 0."""
    context = failures.select(TOKEN, "is_night", "failure_score")
    stats = assigned.join(context, TOKEN).groupBy("cluster").agg(
        F.count("*").alias("size"),
        F.avg(F.col("is_night").cast("int")).alias("night_share"),
        F.avg("failure_score").alias("mean_failure_score"),
    )
    every = assigned.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
    return every.join(stats, "cluster", "left").fillna(
        0, ["size", "night_share", "mean_failure_score"]
    )


def cluster_quotas(sizes: dict[int, int], n: int) -> dict[int, int]:
    """Share n over the clusters by size; an empty cluster still counts as one."""
    rows = [(int(c), max(int(size), 1)) for c, size in sizes.items()]
    strata = SparkSession.active().createDataFrame(rows, "cluster int, n long")
    return {r["cluster"]: r["quota"] for r in allocate(strata, ["cluster"], n, 0).collect()}


def select_mined(candidates: DataFrame, quotas: dict[int, int], n: int) -> DataFrame:
    """Pick up to n candidates (``cluster, token, score``), each token once.

    Clusters choose in descending quota order; each takes its nearest frames that no
    earlier cluster took. What is still missing is filled with the nearest left over,
    whichever cluster they were fetched for. The candidates are at most n for each cluster
    (see :func:`fetch_depths`); every step reads and writes at most that much.
    """
    candidates = settle(candidates.select("cluster", TOKEN, "score"), "candidates")
    nearest = [F.desc("score"), F.asc(TOKEN)]
    order = sorted((c for c in quotas if quotas[c] > 0), key=lambda c: (-quotas[c], c))
    mined = candidates.limit(0)
    for cluster in order:
        own = candidates.filter(F.col("cluster") == cluster)
        free = own.join(mined.select(TOKEN), TOKEN, "left_anti")
        picks = free.orderBy(*nearest).limit(quotas[cluster]).select(*candidates.columns)
        mined = mined.unionByName(settle(picks, "mined"))
    missing = n - mined.count()
    if missing > 0:
        turn = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("cluster"))
        spare = candidates.join(mined.select(TOKEN), TOKEN, "left_anti").groupBy(TOKEN)
        spare = spare.agg(F.max(F.struct("score", (-turn).alias("turn"), "cluster")).alias("_b"))
        spare = spare.select(F.col("_b.cluster").alias("cluster"), TOKEN, "_b.score")
        mined = mined.unionByName(settle(spare.orderBy(*nearest).limit(missing), "mined"))
    return mined


def fetch_depths(quotas: dict[int, int], n: int) -> dict[int, int]:
    """How many of its nearest frames each cluster must see for the selection to be complete.

    Clusters choose in turn. Those before and at a cluster's turn take as many frames as
    their quotas add up to, so among so many of its nearest there are as many free ones as
    its quota, unless they are the whole pool. Where the quotas leave some of the n frames
    open, the best left over is always among some cluster's n nearest: all frames nearer to
    that cluster are taken or come before it. So no deeper fetch could change a choice.
    """
    order = sorted((c for c in quotas if quotas[c] > 0), key=lambda c: (-quotas[c], c))
    depths = dict(zip(order, accumulate(quotas[c] for c in order)))
    if sum(quotas[c] for c in order) < n:
        depths = dict.fromkeys(order, n)
    return {c: depths.get(c, 0) for c in quotas}


def mine(
    centroids: DataFrame, pool: DataFrame, quotas: dict[int, int], n: int, overfetch: int | None = None
) -> DataFrame:
    """Mined frames ``sample_data_token, cluster, score, distance`` from a vector pool.

    Exactly n frames, or the whole pool where it is smaller. With ``overfetch`` each cluster
    sees that multiple of its quota only, and crowded clusters may leave some of the n open.
    """
    depths = fetch_depths(quotas, n) if overfetch is None else {c: q * overfetch for c, q in quotas.items()}
    fetch = F.create_map(*[F.lit(x) for c, k in depths.items() for x in (c, k)])
    queries = centroids.select(
        F.col("cluster").alias("query_id"), "vector", F.coalesce(fetch[F.col("cluster")], F.lit(0)).alias("k")
    )
    candidates = top_k_batch(pool, queries).withColumnRenamed("query_id", "cluster")
    picked = select_mined(candidates, quotas, n)
    return picked.withColumn("distance", 1 - F.col("score"))


@dataclass(frozen=True)
class Mining:
    """Tables of one mining run; ``shortfall`` is how many frames could not be found."""

    mined: DataFrame
    random: DataFrame
    clusters: DataFrame
    shortfall: int


def run_mining(
    failures: DataFrame,
    split: DataFrame,
    samples: DataFrame,
    vectors: DataFrame,
    *,
    channel: str = "CAM_FRONT",
    top_k: int = 1000,
    n_clusters: int = 8,
    n_mine: int = 1500,
    overfetch: int | None = None,
    seed: int = 64,
    restarts: int = 10,
) -> Mining:
    """Cluster the worst failures, mine the pool and draw the random control.

    Fails when a mined or control frame is outside the pool or inside the baseline.
    """
    worst = settle(top_failures(failures, top_k), "worst")
    assigned, centroids = cluster_failures(
        read_vectors(vectors, worst), n_clusters, seed, restarts
    )
    clusters = settle(cluster_stats(assigned, worst, n_clusters), "clusters")
    sizes = {r["cluster"]: r["size"] for r in clusters.collect()}  # n_clusters rows

    pool_scenes = split.filter(F.col("role") == "pool").select("scene_name")
    pool = vectors.filter(F.col("channel") == channel)
    pool = pool.join(pool_scenes, "scene_name", "left_semi")
    mined = mine(centroids, pool, cluster_quotas(sizes, n_mine), n_mine, overfetch)
    mined = settle(
        mined.join(vectors.select(TOKEN, "scene_name", "is_night"), TOKEN), "mined-frames"
    )
    pool_frames = frames_with_role(samples, split, "pool", channel)
    baseline = frames_with_role(samples, split, "baseline", channel)
    control = settle(random_control(pool_frames, n_mine, seed), "control")
    for name, part in (("mined", mined), ("random", control)):
        require_subset(part, pool_frames, TOKEN, f"{name} frames must come from the pool")
        require_disjoint(part, baseline, TOKEN, f"{name} frames overlap the baseline")
    return Mining(mined, control, clusters, n_mine - mined.count())


def mining_summary(mined: DataFrame, control: DataFrame, samples: DataFrame) -> DataFrame:
    """One row: set sizes and the night share of the mined frames."""
    sets = mined.select(TOKEN, F.lit(True).alias("_mined")).unionByName(
        control.select(TOKEN, F.lit(False).alias("_mined"))
    )
    flagged = sets.join(samples.select(TOKEN, "is_night"), TOKEN, "left")
    return flagged.agg(
        F.count_if("_mined").alias("n_mined"),
        F.count_if(~F.col("_mined")).alias("n_random"),
        F.avg(F.when(F.col("_mined"), F.col("is_night").cast("int"))).alias("night_share"),
    )
