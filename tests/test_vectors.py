"""Vector search, mining and the embedding job."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wayframe.functions.vectors import cosine_score, dot, normalize
from wayframe.operators import embedding, mining, search
from wayframe.sources import vectors as stores

TOKEN = "sample_data_token"


def _store(spark, n=700, dim=8, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    matrix = rng.normal(size=(n, dim)).astype(np.float32)
    if copies:
        matrix[:copies] = matrix[0]
    data = [(f"t{i:04}", [float(x) for x in v], f"s{i % 5}", "CAM_FRONT", i % 5 == 0)
            for i, v in enumerate(matrix)]
    schema = f"{TOKEN} string, vector array<float>, scene_name string, channel string, is_night boolean"
    return matrix.astype(np.float64), spark.createDataFrame(data, schema).repartition(6)


def _best(matrix, query, k, skip=()):
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    scores = (unit * (query / np.linalg.norm(query))).sum(axis=1)
    order = sorted((i for i in range(len(matrix)) if i not in skip), key=lambda i: (-scores[i], i))
    return [(f"t{i:04}", pytest.approx(scores[i])) for i in order[:k]]


def _hits(df):
    return [(r[TOKEN], r.score) for r in df.orderBy("rank").collect()]


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])],
                               "a array<float>, b array<float>, z array<float>")
    a, b, z = F.col("a"), F.col("b"), F.col("z")
    got = df.select(dot(a, b), normalize(a), cosine_score(a, b), normalize(z), cosine_score(a, z))
    row = got.first()
    assert row[0] == 24 and row[1] == pytest.approx([0.6, 0.8]) and row[2] == pytest.approx(0.96)
    assert row[3] == [0, 0] and row[4] == 0


def test_top_k_and_self_exclusion(spark):
    matrix, store = _store(spark)
    assert _hits(search.top_k(store, matrix[3], 9)) == _best(matrix, matrix[3], 9)
    assert _hits(search.similar_to(store, "t0003", 9)) == _best(matrix, matrix[3], 9, {3})
    assert search.vector_for(store, "none") is None
    with pytest.raises(KeyError):
        search.similar_to(store, "none", 3)
    assert search.top_k(store, matrix[3], 10_000).count() == 700


def test_copies_tie_exactly_and_by_token(spark):
    matrix, store = _store(spark, copies=300)
    got = _hits(search.top_k(store, matrix[0] + 0.01, 250))
    assert [t for t, _ in got] == [f"t{i:04}" for i in range(250)]
    assert len({s for _, s in got}) == 1


@pytest.mark.parametrize("block", [2048, 2])
def test_many_queries_with_their_own_k(spark, block):
    matrix, store = _store(spark)
    ks = {0: 4, 1: 0, 2: 11, 3: 1, 4: 2, 5: 3, 6: 5}
    queries = spark.createDataFrame([(q, [float(x) for x in matrix[q] * 3], k) for q, k in ks.items()],
                                    "query_id int, vector array<double>, k int")
    got = search.top_k_batch(store, queries, query_block=block)
    for q, k in ks.items():
        assert _hits(got.filter(F.col("query_id") == q)) == _best(matrix, matrix[q], k)
    assert search.top_k_batch(store, queries.limit(0)).count() == 0


def test_hits_carry_their_context(spark):
    matrix, store = _store(spark)
    found = search.with_context(search.top_k(store, matrix[0], 3), store)
    assert {TOKEN, "scene_name", "channel", "is_night", "score"} <= set(found.columns)
    assert found.count() == 3
    wanted = store.filter("scene_name = 's1'").select(TOKEN)
    assert search.read_vectors(store, wanted).count() == 140


# --- mining ---------------------------------------------------------------------------


def test_selection_fills_quotas_then_spares(spark):
    data = [(0, "a", .9), (0, "b", .8), (0, "c", .7), (0, "d", .2), (1, "a", .95), (1, "b", .5),
            (1, "e", .4), (1, "d", .3)]
    candidates = spark.createDataFrame(data, f"cluster int, {TOKEN} string, score double")
    picked = mining.select_mined(candidates, {0: 2, 1: 1}, 5)
    assert rows(picked.select("cluster", TOKEN)) == [(0, "a"), (0, "b"), (0, "c"), (1, "d"), (1, "e")]
    assert mining.select_mined(candidates, {0: 2, 1: 1}, 3).count() == 3
    assert mining.select_mined(candidates, {0: 2, 1: 1}, 9).count() == 5


def _scenes(spark):
    """Two baseline, four pool and two val scenes; day frames near axis 0, night near axis 1."""
    rng = np.random.default_rng(1)
    data = []
    for s, (role, night) in enumerate(
        [("baseline", False), ("baseline", True)] + [("pool", False), ("pool", True)] * 2
        + [("val", False), ("val", True)]
    ):
        for f in range(4):
            v = rng.normal(scale=0.02, size=8)
            v[int(night)] += 1
            data.append((f"{role}-{s}-{f}", [float(x) for x in v], f"scene-{s}", "CAM_FRONT", night,
                         role, 1.0 + f))
    return spark.createDataFrame(
        data, f"{TOKEN} string, vector array<float>, scene_name string, channel string, "
              "is_night boolean, role string, failure_score double")


def test_mining_run(spark):
    frames = _scenes(spark)
    failures = frames.filter("role = 'val'")
    split = frames.filter("role <> 'val'").select("scene_name", "role").distinct()
    options = dict(top_k=8, n_clusters=2, n_mine=6, overfetch=2, restarts=3)
    run = mining.run_mining(failures, split, frames, frames, **options)
    tokens = [r[TOKEN] for r in run.mined.collect()]
    assert len(tokens) == len(set(tokens)) == 6 and run.random.count() == 6 and run.shortfall == 0
    assert all(t.startswith("pool") for t in tokens)
    clusters = run.clusters.collect()
    assert sum(c["size"] for c in clusters) == 8
    assert {c.night_share for c in clusters} == {0.0, 1.0}
    again = mining.run_mining(failures, split, frames, frames, **options)
    assert rows(again.mined.select(TOKEN)) == rows(run.mined.select(TOKEN))
    assert rows(again.random) == rows(run.random)
    summary = mining.mining_summary(run.mined, run.random, frames).first()
    assert tuple(summary) == (6, 6, 0.5)
    short = mining.run_mining(failures, split, frames, frames, **{**options, "n_mine": 40})
    assert short.shortfall == 40 - short.mined.count() > 0


def test_mining_refuses_frames_outside_the_pool(spark):
    frames = _scenes(spark)
    split = frames.filter("role <> 'val'").select("scene_name", "role").distinct()
    samples = frames.filter(f"{TOKEN} NOT LIKE 'pool-2%'")  # vectors the samples do not know
    with pytest.raises(AssertionError):
        mining.run_mining(frames.filter("role = 'val'"), split, samples, frames, top_k=8,
                          n_clusters=2, n_mine=16, restarts=1)


def test_empty_clusters_keep_a_row(spark):
    frames = _scenes(spark)
    assigned = frames.select(TOKEN, F.lit(1).alias("cluster"))
    stats = {r.cluster: tuple(r)[1:] for r in mining.cluster_stats(assigned, frames, 3).collect()}
    assert stats[0] == stats[2] == (0, 0.0, 0.0) and stats[1][0] == 32
    assert mining.cluster_quotas({0: 0, 1: 3}, 4) == {0: 1, 1: 3}


# --- embedding ------------------------------------------------------------------------


def _frames(spark):
    data = [(f"d{s}{f}", f"scene-{s}", "Night rain" if s == 2 else f"clear day {f}", 3)
            for s in range(3) for f in range(4)]
    return spark.createDataFrame(data, f"{TOKEN} string, scene_name string, text string, n_boxes long")


def test_embedding_resumes_and_rebuilds(spark, tmp_path):
    frames, store = _frames(spark), str(tmp_path / "store")
    embedder = embedding.HashedTextEmbedder(16)
    manifest = frames.select(TOKEN, (F.col(TOKEN) != "d00").alias("present"))
    first = embedding.run_embedding(frames, embedder, "text", store, manifest=manifest)
    assert (first["frames_added"], first["scenes_processed"], first["total"]) == (11, 3, 11)
    again = embedding.run_embedding(frames, embedder, "text", store, manifest=manifest)
    assert (again["frames_added"], again["scenes_skipped"], again["total"]) == (0, 3, 11)
    rest = embedding.run_embedding(frames, embedder, "text", store)
    assert (rest["frames_added"], rest["scenes_processed"], rest["total"]) == (1, 1, 12)
    built = embedding.run_embedding(frames, embedder, "text", store, rebuild=True)
    assert (built["frames_added"], built["total"]) == (12, 12)
    stored = stores.open_store(spark, store)
    before = rows(stored.select(TOKEN))
    assert stores.of_other_dimension(stored, 16).isEmpty()
    length = stored.select(F.sqrt(dot(F.col("vector"), F.col("vector")))).distinct().collect()
    assert all(r[0] == pytest.approx(1, abs=1e-6) for r in length)
    stores.compact(spark, store, 1)
    assert len(stores.open_store(spark, store).inputFiles()) == 1
    assert rows(stores.open_store(spark, store).select(TOKEN)) == before
    hit = search.search_text(stores.open_store(spark, store), "RAIN at night", 4, embedder).collect()
    assert {r[TOKEN][:2] for r in hit} == {"d2"}


def test_unreadable_inputs_are_counted(spark, tmp_path):
    frames = _frames(spark).withColumn("text", F.when(F.col(TOKEN) != "d11", F.col("text")))
    done = embedding.run_embedding(frames, embedding.HashedTextEmbedder(8), "text",
                                   str(tmp_path / "s"))
    assert (done["frames_added"], done["unreadable"]) == (11, 1)


def test_a_missing_store_is_an_error_unless_created(spark, tmp_path):
    path = str(tmp_path / "none")
    with pytest.raises(FileNotFoundError):
        stores.open_store(spark, path)
    assert stores.open_store(spark, path, create=True).count() == 0
    stores.drop_store(spark, path)
    assert not stores.store_exists(spark, path)


def test_user_models_run_once_per_task_and_are_normalised(spark):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])
    model = embedding.FunctionEmbedder(load, 2, "length")
    df = spark.createDataFrame([("abc",), ("",)], "text string")
    got = {r.text: r.vector for r in model.embed(df, "text").collect()}
    assert got["abc"] == pytest.approx([3 / 10**0.5, 1 / 10**0.5]) and got[""] == [0, 1]


def test_vectors_of_another_dimension_are_refused(spark):
    store = spark.createDataFrame(
        [("a", [1.0, 0.0, 0.0, 0.0]), ("b", [0.0, 1.0]), ("c", [0.0, 0.0, 1.0, 0.0, 0.0, 0.0])],
        "sample_data_token string, vector array<float>").coalesce(1)
    queries = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0], 3)], "query_id int, vector array<double>, k int")
    with pytest.raises(Exception, match="dimensions"):
        search.top_k_batch(store, queries).collect()


def test_search_by_image_with_thumbnails(spark, tmp_path):
    def load():
        def histogram(images):
            return np.array([np.bincount(np.frombuffer(bytes(i), np.uint8) % 8, minlength=8) for i in images])
        return histogram

    embedder = embedding.FunctionEmbedder(load, 8, "bytes")
    frames = spark.createDataFrame(
        [(f"d{i}", "s", bytearray([i] * 20 + [7 - i]), bytearray([i])) for i in range(6)],
        "sample_data_token string, scene_name string, image binary, thumbnail binary")
    store = str(tmp_path / "store")
    embedding.run_embedding(frames, embedder, "image", store)
    stored = stores.open_store(spark, store)
    hits = search.with_context(search.search_image(stored, bytes([3] * 9), 1, embedder), stored).collect()
    assert [(r.sample_data_token, bytes(r.thumbnail)) for r in hits] == [("d3", bytes([3]))]


def test_mining_finds_every_frame_it_was_asked_for(spark):
    # Three clusters of one centre: with a fixed overfetch the later ones find nothing free.
    pool = spark.createDataFrame(
        [(f"p{k:02d}", [1.0, k / 40]) for k in range(30)], f"{TOKEN} string, vector array<double>")
    centers = spark.createDataFrame([(c, [1.0, 0.0]) for c in range(3)], "cluster int, vector array<double>")
    quotas = {0: 5, 1: 4, 2: 3}
    short = mining.mine(centers, pool, quotas, 12, overfetch=1)
    assert short.count() < 12
    whole = {r[TOKEN]: r.cluster for r in mining.mine(centers, pool, quotas, 12).collect()}
    assert whole == {f"p{k:02d}": 0 if k < 5 else 1 if k < 9 else 2 for k in range(12)}
    assert mining.mine(centers, pool, quotas, 20).count() == 20
    assert mining.mine(centers, pool, quotas, 50).count() == 30 == mining.mine(centers, pool, {0: 100, 1: 7}, 107).count()
    assert mining.fetch_depths(quotas, 12) == {0: 5, 1: 9, 2: 12} and mining.fetch_depths({0: 0, 1: 3}, 5) == {0: 0, 1: 5}


def test_k_means_equals_a_plain_one(spark):
    from wayframe.operators.clusters import k_means
    from wayframe.operators.draw import draw_key

    rng = np.random.default_rng(8)
    points = {f"t{k:03d}": np.round(rng.normal(k % 3 * 4, 1, 5), 6) for k in range(90)}
    points |= {"same-a": points["t001"], "same-b": points["t001"]}
    frame = spark.createDataFrame([(t, p.tolist()) for t, p in points.items()], f"{TOKEN} string, vector array<double>").repartition(5)
    tokens = sorted(points)
    whole = {t: [round(x * 1e6) for x in points[t].tolist()] for t in tokens}

    def away(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    order = [r[TOKEN] for r in frame.orderBy(draw_key(TOKEN, 5), TOKEN).collect()]
    best = None
    for start in order[:4]:
        centers = [whole[start]]
        while len(centers) < 4:
            centers.append(whole[min(tokens, key=lambda t: (-min(away(whole[t], c) for c in centers), t))])
        while True:
            label = {t: min(range(4), key=lambda j: (away(whole[t], centers[j]), j)) for t in tokens}
            moved = [[sum(v) // len(own) for v in zip(*own)] if (own := [whole[t] for t in tokens if label[t] == j]) else centers[j] for j in range(4)]
            if moved == centers:
                break
            centers = moved
        cost = sum(away(whole[t], centers[label[t]]) for t in tokens)
        if best is None or cost < best[0]:
            best = cost, label, centers
    assigned, centers = k_means(frame, 4, seed=5, restarts=4)
    assert {r[TOKEN]: r.cluster for r in assigned.collect()} == best[1]
    assert (centers * 1e6).round().tolist() == best[2]
    assert rows(k_means(frame.coalesce(1), 4, seed=5, restarts=4)[0]) == rows(assigned)


def test_k_means_goes_on_until_nothing_moves(spark):
    from wayframe.operators import clusters
    from wayframe.operators.draw import draw_key

    points = np.round(np.random.default_rng(24).normal(size=(3000, 32)), 6)
    frame = spark.createDataFrame(
        [(f"t{i:04d}", p.tolist()) for i, p in enumerate(points)], f"{TOKEN} string, vector array<double>").coalesce(1)
    whole = np.rint(points * 1e6).astype(np.int64)

    def away(centers):
        return np.stack([((whole - c) ** 2).sum(axis=1) for c in centers], axis=1)

    centers = whole[[int(frame.orderBy(draw_key(TOKEN, 64), TOKEN).first()[TOKEN][1:])]]
    while len(centers) < 3:
        centers = np.concatenate([centers, whole[[away(centers).min(axis=1).argmax()]]])
    rounds, before = 0, None
    while before is None or (before != centers).any():
        label, before, rounds = away(centers).argmin(axis=1), centers, rounds + 1
        centers = np.stack([whole[label == j].sum(axis=0) // (label == j).sum() for j in range(3)])
    assert rounds > 100
    assigned, found = clusters.k_means(frame, 3, restarts=1)
    assert (np.rint(found * 1e6) == centers).all()
    assert [c for _, c in rows(assigned)] == label.tolist()


def test_k_means_of_few_or_large_vectors(spark):
    from wayframe.operators.clusters import k_means, whole_points

    frame = spark.createDataFrame([("a", [1e9, 0.5]), ("b", [1e9, 0.5])], f"{TOKEN} string, vector array<double>")
    assert whole_points(frame, TOKEN, "vector")[1] == 1
    assert {r.cluster for r in k_means(frame, 3)[0].collect()} == {0}
    with pytest.raises(ValueError, match="no vectors"):
        k_means(frame.limit(0), 2)


def _tokens(frame):
    return [r[0] for r in rows(frame.select(TOKEN))]


def test_readers_see_whole_versions(spark, tmp_path):
    store = str(tmp_path / "store")
    frame = spark.createDataFrame([(f"t{k}", [float(k)]) for k in range(6)], f"{TOKEN} string, vector array<float>")
    stores.append(frame.filter("sample_data_token < 't2'"), store)
    reader = stores.open_store(spark, store)
    stores.append(frame.filter("sample_data_token >= 't2'"), store)
    assert _tokens(reader) == ["t0", "t1"] and len(_tokens(stores.open_store(spark, store))) == 6
    assert _tokens(stores.open_store(spark, store, version=1)) == ["t0", "t1"]
    broken = frame.withColumn("vector", F.when(F.col(TOKEN) != "t5", F.col("vector")).otherwise(F.raise_error("lost").cast("array<float>")))
    with pytest.raises(Exception, match="lost"):
        stores.append(broken, store)
    assert len(_tokens(stores.open_store(spark, store))) == 6 and stores.versions(spark, store) == [1, 2]
    middle = stores.open_store(spark, store)
    stores.compact(spark, store, 2)
    assert _tokens(middle) == _tokens(stores.open_store(spark, store)) == sorted(f"t{k}" for k in range(6))
    assert len(stores.vacuum(spark, store)) == 3  # two old folders and the failed one
    assert len(_tokens(stores.open_store(spark, store))) == 6 and stores.vacuum(spark, store) == []
    assert stores.versions(spark, store) == [3]


def test_of_two_writers_of_a_version_one_goes_on(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    frame = spark.createDataFrame([("a", [1.0]), ("b", [2.0]), ("c", [3.0])], f"{TOKEN} string, vector array<float>")
    stores.append(frame.filter("sample_data_token = 'a'"), store)
    version, folders = stores.snapshot(spark, store)
    assert not stores._commit(spark, store, version, folders)
    real, other = stores._commit, []

    def late(spark, path, version, folders):
        if not other:  # somebody else commits first
            other.append(True)
            monkeypatch.setattr(stores, "_commit", real)
            stores.append(frame.filter("sample_data_token = 'b'"), store)
        return real(spark, path, version, folders)

    monkeypatch.setattr(stores, "_commit", late)
    stores.append(frame.filter("sample_data_token = 'c'"), store)
    assert _tokens(stores.open_store(spark, store)) == ["a", "b", "c"]
    other.clear()
    monkeypatch.setattr(stores, "_commit", late)
    stores.compact(spark, store, 1)  # while 'b' is added once more
    assert _tokens(stores.open_store(spark, store)) == ["a", "b", "b", "c"]
