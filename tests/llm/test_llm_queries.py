"""Registered queries beside their SQL, and the pipeline stage by stage."""

import os
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.comparison import connect, differences
from wayframe.llm import decontaminate, kneser_ney, neardup, quality_rules
from wayframe.llm.queries import QUERIES, TWINS

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not found")


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_sql(spark, name):
    found = differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), TWINS[name])
    assert [d for d in found if d != "empty result"] == []


def test_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_near_duplicates_of_five_words_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(lower))
        sets[r.doc_id] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    part = {d: d for d in sets}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if (both := len(sets[a] & sets[b])) and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(part[a], part[b])
            moved |= part[a] != low or part[b] != low
            part[a] = part[b] = low
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, words=5, percent=80).collect()}
    assert links and got == part


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op9_script_viterbi_language_id"](spark, SF_DIR).collect() if r.held_out]
    assert rows and sum(truth[r.doc_id] == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels, tests = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("labels", "benchmark"))
    columns, steps = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.settle(stage(spark, docs, SF_DIR))
        steps.append((name, before, docs))
    assert all(after.columns == columns for _, _, after in steps[:-1])

    def ids(df, where="true"):
        return sorted(r.doc_id for r in df.where(where).collect())

    kept = [ids(after) for _, _, after in steps]
    assert kept[0] == ids(kneser_ney.classify(steps[0][1], labels), "kept")
    assert kept[1] == ids(quality_rules.judge(steps[1][1]), "kept")
    assert kept[2] == ids(neardup.near_duplicates(steps[2][1], words=5), "kept")
    leaked = {r.doc_id for r in decontaminate.overlaps(steps[3][1], tests).collect()}
    assert kept[3] == [d for d in kept[2] if d not in leaked]
    assert sorted(r.doc_id for r in docs.where("piece = 0").collect()) == kept[3]
    assert 0 < len(kept[3]) < len(kept[0])
