"""Draws, allocation, splits and arms."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from wayframe.operators import arms, sampling
from wayframe.operators.draw import allocate, draw, draw_n

STRATA = {i: n for i, n in enumerate([12757, 6028, 770, 2015, 642, 7308, 3299, 1330])}


def _order(tokens, seed):
    return sorted(tokens, key=lambda t: (hashlib.md5(f"{t}|{seed}".encode()).hexdigest(), t))


def quotas(spark, counts, total, floor):
    strata = spark.createDataFrame([(str(k), n) for k, n in counts.items()], "kind string, n long")
    return {r.kind: r.quota for r in allocate(strata, ["kind"], total, floor).collect()}


def test_allocation_of_the_real_strata(spark):
    quota = quotas(spark, STRATA, 5000, 250)
    assert sum(quota.values()) == 5000
    assert max(quota.values()) == 1726
    assert sorted(quota.values())[:3] == [250, 250, 250]


def test_allocation_edges(spark):
    assert quotas(spark, {"a": 10, "b": 1000}, 200, 50) == {"a": 10, "b": 190}
    assert quotas(spark, {"a": 10, "b": 5}, 99, 50) == {"a": 10, "b": 5}
    assert quotas(spark, {}, 5, 1) == {}
    with pytest.raises(Exception, match="floor of 50"):
        quotas(spark, {"a": 100, "b": 100, "c": 100}, 100, 50)
    assert quotas(spark, {"b": 11, "a": 11, "c": 11}, 10, 0) == {"a": 4, "b": 3, "c": 3}


def by_definition(counts, total, floor):
    """One common rate above the floors, found by trying every prefix of the sizes."""
    order = sorted(counts, key=lambda k: counts[k])
    least = {k: min(floor, counts[k]) for k in counts}
    for bound in range(len(order) + 1):
        free = order[bound:]
        budget, mass = total - sum(least[k] for k in order[:bound]), sum(counts[k] for k in free)
        if all(budget * counts[k] >= least[k] * mass for k in free):
            break
    quota = {**least, **{k: budget * counts[k] // mass for k in free}}
    spare = total - sum(quota.values())
    for k in sorted(free, key=lambda k: (-(budget * counts[k] % mass), -counts[k], k))[:spare]:
        quota[k] += 1
    return quota


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.sampled_from("abcdefghijkl"), st.integers(1, 60), min_size=1, max_size=9),
       st.integers(1, 200), st.integers(0, 9))
def test_allocation_properties(spark, counts, total, floor):
    if total >= sum(counts.values()):
        assert quotas(spark, counts, total, floor) == counts
    elif sum(min(floor, n) for n in counts.values()) <= total:
        assert quotas(spark, counts, total, floor) == by_definition(counts, total, floor)


def test_draw_is_exact_with_one_hot_stratum(spark):
    """Nine in ten rows share a stratum, one stratum is NULL, one has no quota."""
    kinds = {i: "hot" if i % 10 else ("b" if i % 20 else None) for i in range(4000)}
    df = spark.createDataFrame([(f"t{i}", k, i) for i, k in kinds.items()],
                               "token string, kind string, payload int").repartition(7)
    quotas = spark.createDataFrame([("hot", 700), (None, 33), ("absent", 5)],
                                   "kind string, quota long")
    got = draw(df, ["kind"], quotas, "token", 9)
    want = []
    for kind, n in (("hot", 700), (None, 33)):
        tokens = [f"t{i}" for i, k in kinds.items() if k == kind]
        want += [(t, kind) for t in _order(tokens, 9)[:n]]
    assert rows(got.select("token", "kind")) == sorted(want, key=repr)
    assert got.columns == df.columns


def test_uniform_draw(spark):
    df = spark.createDataFrame([(f"t{i}",) for i in range(50)], "token string")
    tokens = [r[0] for r in df.collect()]
    assert rows(draw_n(df, 7, "token", 1)) == sorted((t,) for t in _order(tokens, 1)[:7])
    assert draw_n(df, 60, "token", 1).count() == 50
    assert draw_n(df, None, "token", 1).count() == 50
    assert draw_n(df, 0, "token", 1).count() == 0


def _samples(spark):
    data = [(f"d{i:03}", f"s{i // 10:02}", "CAM_FRONT" if i % 2 else "CAM_BACK", "x",
             i // 10 % 3 == 0, i % 5 == 0) for i in range(400)]
    return spark.createDataFrame(data, "sample_data_token string, scene_name string, "
                                 "channel string, location string, is_night boolean, "
                                 "is_rain boolean")


def test_labelling_sample_is_stratified_nested_and_repeatable(spark):
    samples = _samples(spark)
    manifest = samples.select("sample_data_token", (F.col("sample_data_token") != "d001")
                              .alias("present"))
    options = dict(size=60, floor=5, subset_size=20, subset_floor=2)
    got = sampling.labelling_sample(samples, manifest, **options)
    again = sampling.labelling_sample(samples.repartition(5), manifest, **options)
    assert rows(got.select("sample_data_token", "in_subset")) == rows(
        again.select("sample_data_token", "in_subset"))
    assert got.count() == 60 and got.filter("in_subset").count() == 20
    assert got.filter("channel <> 'CAM_FRONT' OR sample_data_token = 'd001'").isEmpty()
    assert got.groupBy("stratum").count().agg(F.min("count")).first()[0] >= 5
    assert got.columns.count("in_subset") == 1 and "present" in got.columns
    assert sampling.labelling_sample(samples, None, **options).count() == 60


def test_split_stratifies_by_night_and_rounds_half_to_even(spark):
    scenes = spark.createDataFrame(
        [(f"s{i:02}", i < 10, 4) for i in range(24)] , "scene_name string, is_night boolean, n_frames long")
    split = sampling.split_baseline_pool(scenes, 0.25, 64)
    counts = {(r.role, r.is_night): r["count"]
              for r in split.groupBy("role", "is_night").count().collect()}
    # 10 * .25 = 2.5 -> 2 and 14 * .25 = 3.5 -> 4
    assert counts == {("baseline", True): 2, ("pool", True): 8, ("baseline", False): 4,
                      ("pool", False): 10}
    one = sampling.split_baseline_pool(scenes.limit(1), 0.25, 64)
    assert [r.role for r in one.collect()] == ["baseline"]
    totals = {r.role: (r.n_scenes, r.n_frames, r.n_night)
              for r in sampling.role_totals(split).collect()}
    assert totals == {"baseline": (6, 24, 2), "pool": (18, 72, 8)}


def test_arms_and_guards(spark):
    def tokens(*names):
        return spark.createDataFrame([(n,) for n in names], "sample_data_token string")
    base, extra = tokens("a", "b"), tokens("b", "c")
    assert rows(sampling.arm_frames(base, None, "baseline")) == [("a",), ("b",)]
    assert rows(sampling.arm_frames(base, extra, "mined")) == [("a",), ("b",), ("c",)]
    with pytest.raises(ValueError):
        sampling.arm_frames(base, extra, "other")
    sampling.require_subset(tokens("a"), base, "sample_data_token", "no")
    with pytest.raises(AssertionError):
        sampling.require_subset(extra, base, "sample_data_token", "no")
    sampling.require_disjoint(tokens("c"), base, "sample_data_token", "no")
    with pytest.raises(AssertionError):
        sampling.require_disjoint(extra, base, "sample_data_token", "no")


def test_arm_results_need_one_validation_set(spark):
    def record(arm, images, value):
        return spark.createDataFrame(
            [(arm, images, value, value / 2)],
            "arm string, val_images long, overall_map50_95 double, night_map50_95 double")
    results = arms.upsert_arm(None, record("baseline", 10, 0.2))
    results = arms.upsert_arm(results, record("mined", 10, 0.5))
    results = arms.upsert_arm(results, record("mined", 10, 0.3))
    got = {r.arm: r.d_overall for r in arms.arm_report(results).collect()}
    assert got["baseline"] is None and got["mined"] == pytest.approx(0.1)
    with pytest.raises(AssertionError):
        arms.upsert_arm(results, record("random", 11, 0.3))
    assert arms.upsert_arm(record("mined", 9, 0.1), record("mined", 10, 0.3)).count() == 1
