"""Source mixing, source divergence and filter interactions: brute force, odd rows, laws."""

import itertools
import re
from collections import Counter

import pytest

from tests.llm.test_odd_rows import CLASHING, DOCS, ODD
from wayframe.llm import divergence, filter_audit, mixing


def frame(spark, rows, clash=True):
    docs = spark.createDataFrame(rows, DOCS)
    for name in (*CLASHING, "row", "place", "tie", "source_size", "target", "digit", "vector", "tokens", "part", "digest", "failed", "first", "of") if clash else ():
        if name not in docs.columns:
            docs = docs.selectExpr("*", f"'clash' AS {name}")
    return docs


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected_targets(sizes, weights=(1, 2, 3), most=3, budget=None):
    """Resharing round by round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()) if budget is None else budget, set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in capped else target[s] for s in names}
        capped |= above


def check_mix(rows, got):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want, taken, largest = expected_targets(sizes), Counter(), Counter()
    assert Counter((r.row.doc_id, r.size) for r in got) == Counter((r[0], len(words(r[1]))) for r in rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.times <= 3 and r.taken == r.times * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_targets_are_reshared_until_none_is_above(spark):
    for sizes in ({"a": 1000, "b": 10, "c": 1, None: 7, "d": 0}, {"é": 4, "z": 9, "Z": 11, "": 3}):
        for budget in (None, 10**6):
            table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
            got = {r.source: r.target for r in mixing.targets(table, budget=budget).collect()}
            want = expected_targets(sizes, budget=budget) if budget is None or budget <= 3 * sum(sizes.values()) else {s: 3 * n for s, n in sizes.items()}
            assert got == pytest.approx(want), (sizes, budget)


def test_mix_comes_near_its_targets(spark):
    rows = [(k, "w " * (k * 7 % 40), None, f"s{0 if k % 3 else k % 11}", 0) for k in range(600)]
    got = mixing.plan(frame(spark, rows, clash=False)).collect()
    check_mix(rows, got)
    again = mixing.plan(frame(spark, rows, clash=False).repartition(7)).collect()
    assert sorted((r.row.doc_id, r.taken) for r in got) == sorted((r.row.doc_id, r.taken) for r in again)


def test_mix_divides_one_document_repeated_many_times(spark):
    rows = [(1, "a b c", None, "a", 0)] * 300 + [(k, "x y", None, "b", 0) for k in range(40)]
    check_mix(rows, mixing.plan(frame(spark, rows, clash=False)).collect())


def test_mixes_of_growing_budgets_are_nested(spark):
    rows = [(k, "w " * (1 + k % 5), None, f"s{k % 3}", 0) for k in range(200)]
    docs = frame(spark, rows, clash=False)
    before = {}
    for budget in (50, 600, 1500):
        now = {r.row.doc_id: r.times for r in mixing.plan(docs, budget=budget).collect()}
        assert all(now[d] >= n for d, n in before.items())
        before = now


def test_mixed_rows(spark):
    docs = frame(spark, [r for r in ODD])
    plan = mixing.plan(docs)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == sum(r.taken for r in plan.collect())


def test_weights_by_table(spark):
    docs = frame(spark, [(k, "a b", None, "ab"[k % 2], 0) for k in range(100)], clash=False)
    weights = spark.createDataFrame([("a", 3.0), ("zz", 1.0)], "source string, weight double")
    got = mixing.plan(docs, weights).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert {r["source"]: r["sum(taken)"] for r in got} == {"a": 200, "b": 0}


def test_odd_rows_mix(spark):
    check_mix(ODD, mixing.plan(frame(spark, ODD)).collect())
    assert mixing.plan(frame(spark, [])).count() == 0 == mixing.mix(frame(spark, [])).count()
    nothing = [(1, None, None, None, 0), (2, "", None, "a", 0)]
    assert [r.taken for r in mixing.plan(frame(spark, nothing)).collect()] == [0, 0]


def brute_divergence(rows, min_docs, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate(lower))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= min_docs}
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in own}}
        whole = sum(counts.values(), Counter())

        def p(c, t):
            return 1 + 1_000_000_000 * (c[t] + 5) // (c.total() + 5 * len(kept))

        for s, c in counts.items():
            pairs = [(o, sum(abs(p(c, t) - p(d, t)) for t in kept)) for o, d in counts.items() if o != s]
            terms = [(t, p(c, t) - p(whole, t)) for t in c if p(c, t) > p(whole, t)]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(items, 1)]
    return sorted(out)


TEXTS = ["Älter als ÄLTER, alter Baum", "the the cat\0sat", "The CAT and_the dog", "x1y2 z", "", None, "dog dog dog 漢字"]
SPREAD = [(k, TEXTS[k * k % 7], ("en", "de", None)[k % 3], (f"s{k % 5}", None, "")[k % 7 % 3], 0) for k in range(120)]


@pytest.mark.parametrize("shards", [1, 3])
def test_divergence_equals_brute_force(spark, monkeypatch, shards):
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "SHARD_TERMS", 3)
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, SPREAD), 3, 2, shards).collect())
    assert got == brute_divergence(SPREAD, 3, 2)


def test_document_vectors_are_those_of_the_fitted_model(spark):
    from pyspark.ml.feature import CountVectorizer
    import pyarrow as pa

    texts = frame(spark, SPREAD, clash=False).selectExpr("coalesce(text, '') AS text", "coalesce(lang, '') AS lang", "coalesce(source, '') AS source")
    tokens = texts.mapInArrow(divergence._tokens, "source string, tokens array<string>").select("tokens")
    model = CountVectorizer(inputCol="tokens", outputCol="v", minDF=3.0, vocabSize=2**31 - 1).fit(tokens)
    rows = model.transform(tokens).collect()
    doc, at, n = divergence.document_vectors(pa.array([r.tokens for r in rows], pa.list_(pa.string())), pa.array(model.vocabulary))
    assert list(zip(doc.tolist(), at.tolist(), n.tolist())) == [
        (k, i, int(x)) for k, r in enumerate(rows) for i, x in zip(r.v.indices.tolist(), r.v.values)]


def test_divergence_of_odd_rows(spark):
    for rows in (ODD, []):
        got = sorted(tuple(r) for r in divergence.audit(frame(spark, rows), 2).collect())
        assert got == brute_divergence(rows, 2, 50)
    assert divergence.audit(frame(spark, SPREAD), 10**6).where("value <> 0 or part = 'term'").count() == 0


def test_probability_is_exact_for_large_counts(spark):
    from pyspark.sql import functions as F

    n, total, size = 987_654_321_012_345, 1_234_567_890_123_456, 45_678_901
    got = spark.range(1).select(divergence.probability(F.lit(n), F.lit(total), F.lit(size))).first()[0]
    assert got == 1 + 1_000_000_000 * (n + 5) // (total + 5 * size)


def test_term_shards_grow_with_the_text():
    assert divergence.term_shards_for(0) == divergence.term_shards_for(10**9) == 1
    assert divergence.term_shards_for(10**14) > divergence.term_shards_for(10**13) > 1


def brute_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = []
    for r in rows:
        text, ws = r[1] or "", words(r[1])
        e = r[0] is not None and any(o[0] is not None and o[0] < r[0] and (o[1] or "") == text for o in rows)
        flags = (len(ws) < 50, 100 * len(set(ws)) < 65 * len(ws), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                 bool(re.search("[#$%&*|]", text)), e)
        fails.append((r[3] or "", r[0], {f for f, bad in zip("ABCDE", flags) if bad}))
    out = {}
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = list(own)
            for step, name in enumerate(order, 1):
                gone = [f for f in left if name in f[2]]
                failing = [f for f in own if name in f[2]]
                left = [f for f in left if name not in f[2]]
                out[part, "".join(order), step] = (
                    len(left), len(gone), len(failing) - len(gone), sum(f[2] == {name} for f in own),
                    sum(f[1] in good for f in gone), sum(f[1] in toxic for f in gone))
    share = Counter()
    for (part, order, step), row in out.items():
        share[part, order[step - 1]] += row[1]
    return sorted((*key, *row, share[key[0], key[1][key[2] - 1]]) for key, row in out.items())


LABELS = [(5, 1, 0), (5, 0, 1), (6, 1, None), (9, None, 1), (7, 0, 0), (None, 1, 1), (77, 1, 1)]


@pytest.mark.parametrize("hot", [1, 10_000])
def test_filter_audit_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(filter_audit, "HOT", hot)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    long = " ".join(f"w{k}" for k in range(60))
    more = [(20 + k, (long, long + " $", long + " A" * 80, "a b", None, long)[k % 6], None, ("s", None, "t")[k % 3], 0) for k in range(40)]
    rows = [*ODD, *more]
    got = sorted(tuple(r) for r in filter_audit.audit(frame(spark, rows), labels).collect())
    assert got == brute_audit(rows, LABELS)


def test_filter_audit_of_no_rows(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert filter_audit.audit(frame(spark, []), labels).count() == 0
    one = filter_audit.audit(frame(spark, [(1, None, None, None, 0)]), labels.limit(0)).collect()
    assert len(one) == 600 and {r.part for r in one} == {""}


def test_shapley_values_share_what_all_filters_remove(spark):
    cells = spark.createDataFrame([("p", s, (s * 37) % 11, 0, 0) for s in range(32)], "part string, failed int, n long, good long, toxic long")
    row = filter_audit.potentials(filter_audit.coalitions(cells)).first()
    shares = [row.potential[31] - row.potential[31 ^ (1 << k)] for k in range(5)]
    assert sum(shares) == 120 * row.v_n[31]
