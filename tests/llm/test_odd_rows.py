"""Every operator on empty tables, nulls, empty and long texts, repeated rows, clashing columns."""

import pytest

from wayframe.llm import (
    decontaminate, kneser_ney, langid, neardup, packing, pseudo_likelihood, quality_rules, sharding, url_filter, warc)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("kept", "node", "key", "shard", "counts", "pattern", "row", "tokens", "at", "lane", "item", "text_a", "size")
WORD = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
ODD = [
    (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, " \n\t ", None, None, None), (4, "one", "en", "s", 3),
    (5, f"{WORD} {WORD}", "en", "s", 1), (5, f"{WORD} {WORD}", "en", "s", 1), (6, f"{WORD} {WORD}", "en", "s", 1),
    (7, "x " * 60_000, "en", "s", 1), (8, "y" * 300_000, None, "s", 1), (None, "no id here", "en", "s", 1), (None, None, None, None, None),
    (9, "Ünïcode ßtraße 漢字 <|endoftext|> \r\n\x0b\x0c \u00a0 end", "de", "s", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    for name in CLASHING:
        docs = docs.selectExpr("*", f"'clash' AS {name}")
    return docs


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(5, 1, 0), (5, 1, None), (6, 1, 0), (9, 1, 0), (7, 0, 0), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def tests(spark):
    return spark.createDataFrame(
        [(1, WORD, "x"), (1, WORD, "x"), (2, None, "x"), (3, "", "x"), (4, "two words", "x"), (None, "no id " * 4, "x")], "item_id long, text string, tokens string")


def test_near_duplicates(odd, none):
    got = neardup.near_duplicates(odd, words=2).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert (by[6].component_id, by[6].kept) == (5, False) and by[5].kept
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[4].n_shingles == 1 and by[7].n_shingles == 1
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2
    assert neardup.near_duplicates(none).count() == 0
    kept = neardup.keep_one(odd, words=2)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 7, 8, 9]


def test_quality_rules(odd, none):
    got = quality_rules.judge(odd).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[1].base_failed and not by[1].kept
    assert by[7].n_words == 60_000 == by[7].n_repeat_words and by[7].base_failed
    assert by[8].word_chars == 300_000
    assert quality_rules.judge(none).count() == 0 == quality_rules.keep_good(none).count()
    assert quality_rules.keep_good(odd).columns == odd.columns


def test_classifier(odd, none, labels):
    got = {r.doc_id: r for r in kneser_ney.classify(odd, labels).collect()}
    assert set(got) == {r[0] for r in ODD}
    assert not got[1].kept and not got[2].kept and got[1].log_perplexity is None
    assert got[4].n_pairs == 2 and got[7].n_pairs == 60_001
    assert kneser_ney.classify(none, labels).count() == 0
    unlabelled = kneser_ney.classify(odd, labels.limit(0)).collect()
    assert {r.doc_id for r in unlabelled if not r.kept} == {1, 2, 3}
    kept = kneser_ney.keep_good(odd, labels)
    assert kept.columns == odd.columns


def test_decontaminate(odd, none, tests):
    got = {(r.doc_id, r.item_id): r.matched for r in decontaminate.overlaps(odd, tests).collect()}
    assert got == {(5, 1): 12, (6, 1): 12}
    assert decontaminate.overlaps(none, tests).count() == 0 == decontaminate.overlaps(odd, tests.limit(0)).count()
    kept = decontaminate.drop_contaminated(odd, tests)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 3


def test_packing(odd, none):
    got = packing.pack(packing.pieces(odd)).collect()
    assert sum(r.start == 0 for r in got) == len(ODD)
    assert sum(r.length == 1 for r in got) == 3
    assert packing.pack(packing.pieces(none)).count() == 0


def test_sharding(odd, none):
    got = sharding.shard(odd, 3).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted((r[0] or 0, r[1] or "") for r in ODD)
    assert {r.size for r in got if r.text is None} == {8}
    assert sharding.shard(none, 3).count() == 0


def test_language(odd, none):
    model = langid.train(odd)
    got = langid.identify(odd, model).collect()
    assert len(got) == len(ODD)
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (1, 2, 3)} == {("und", 0.0)}
    assert {r.lang_pred for r in langid.identify(odd, langid.train(none)).collect()} == {"und"}
    assert langid.identify(none, model).count() == 0


def test_pseudo_likelihood(odd, none):
    model = pseudo_likelihood.train(odd, rounds=1)
    got = pseudo_likelihood.score(odd, *model).collect()
    assert len(got) == len(ODD)
    assert {(r.n_words, r.pseudo_likelihood, r.mean_log_probability) for r in got if r.doc_id in (1, 2, 3)} == {(0, 0.0, None)}
    assert pseudo_likelihood.score(none, *pseudo_likelihood.train(none)).count() == 0


PAGES = [
    (1, None, None), (2, "", ""), (3, "http://A.b/x", "p" * 200), (4, "http://a.b/X?q#f", "p" * 200), (4, "http://a.b/X?q#f", "p" * 200),
    (5, "not a url", "short"), (6, "http://a.b\r\nWARC/1.1", "WARC/1.1\r\n" * 30), (7, "x://é.net", "é" * 99), (None, "http://n/", "p" * 200),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr(
        "*", "'clash' AS digest", "'clash' AS key", "'clash' AS first", "'clash' AS host", "'clash' AS bytes")


def test_archives(spark, pages):
    got = warc.archive(pages).collect()
    assert len(got) == len(PAGES)
    by = {r.page_id: r for r in got}
    assert (by[3].record_type, by[4].record_type, by[4].refers_to, by[4].payload_bytes) == ("response", "revisit", 3, 200)
    assert (by[None].record_type, by[None].refers_to) == ("revisit", 3)
    assert by[1].payload_bytes == 0 == by[2].payload_bytes and by[7].payload_bytes == 198
    assert sorted(r.capture for r in got if r.page_id == 4) == [1, 2]
    assert warc.archive(pages.limit(0)).count() == 0


def test_url_rules(spark, pages):
    rules = spark.createDataFrame([("block", "net/"), ("block", "net"), ("allow", "a.b/x"), ("block", "b/"), (None, None)], "verdict string, key string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    assert got[1] == got[5] == ("", "", None, "allow")
    assert got[3] == ("a.b", "/x", "a.b/x", "allow") and got[4] == ("a.b", "/X", "b/", "block")
    assert got[7] == ("é.net", "", "net", "block")
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_pipeline(spark, odd, none, labels, tests, tmp_path):
    import corpus_pipeline

    prose = " ".join(f"word{k} and other words follow in line {k % 9}" for k in range(40))
    more = spark.createDataFrame([(30, prose, "en", "s", 1), (30, prose, "en", "s", 1), (31, prose + " end", "en", "s", 1), (32, prose[::-1], None, None, None)], DOCS)
    for name, docs, marks, items in (
        ("odd", odd.unionByName(more, allowMissingColumns=True), labels, tests), ("none", none, labels.limit(0), tests.limit(0)),
    ):
        for table, rows in (("documents", docs), ("labels", marks), ("benchmark", items)):
            rows.write.parquet(str(tmp_path / name / f"{table}.parquet"))
        seen = docs
        for stage, function in corpus_pipeline.STAGES[:-1]:
            seen = corpus_pipeline.settle(function(spark, seen, str(tmp_path / name)))
            assert seen.columns == docs.columns, stage
        packed = corpus_pipeline.run(spark, str(tmp_path / name))
        assert sorted((r.doc_id for r in packed.where("piece = 0").collect()), key=repr) == sorted((r.doc_id for r in seen.collect()), key=repr)
        if name == "none":
            assert packed.count() == 0
        else:
            assert {r.doc_id for r in seen.collect()}.isdisjoint({1, 2, 3})
    bare = str(tmp_path / "none")  # without labels or benchmark items
    assert corpus_pipeline.quality_classifier(spark, more, bare).count() == 4
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, more, bare).collect()) == [30, 32]
    assert corpus_pipeline.decontamination(spark, more, bare).count() == 4
