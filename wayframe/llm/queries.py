"""One query per operator over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayframe.llm import (
    decontaminate, divergence, filter_audit, kneser_ney, langid, mixing, packing, pseudo_likelihood, quality_rules, sharding, url_filter, warc)
from wayframe.llm.frames import table
from wayframe.llm.neardup import near_duplicates
from wayframe.llm.registry import LOWER, QUERIES, TWINS, WORDS, query

__all__ = ["QUERIES", "TWINS"]


@query(f"""
    WITH RECURSIVE texts AS (SELECT doc_id, {WORDS.format(LOWER.format('text'))} AS ws FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(ws) > 1
            THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE ws END) AS s FROM texts)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    links AS (
        SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y USING (s)
        JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
        GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    parts AS (SELECT a AS doc_id, min(b) AS part FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(part, doc_id) AS component_id,
           coalesce(part, doc_id) = doc_id AS kept
    FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN parts USING (doc_id)
""")
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query()
def op3_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op7_weak_supervision_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def _seeds_sql() -> str:
    """Every mask at every position, with the selected words spelt out."""
    parts = []
    for m, mask in enumerate(decontaminate.MASKS):
        chosen = " || ' ' || ".join(f"ws[p + {k}]" for k, c in enumerate(mask) if c == "1")
        parts.append(f"SELECT side, id, rid, p, {m} AS mask, {chosen} AS seed FROM places WHERE p + {len(mask) - 1} <= n")
    return " UNION ALL ".join(parts)


@query(f"""
    WITH texts AS (
        SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS rid, {WORDS.format("lower(coalesce(text, ''))")} AS ws FROM documents
        UNION ALL
        SELECT 'b', item_id, row_number() OVER (), {WORDS.format("lower(coalesce(text, ''))")} FROM benchmark),
    places AS (SELECT side, id, rid, ws, len(ws) AS n, unnest(range(1, len(ws) - 4)) AS p FROM texts),
    seeds AS ({_seeds_sql()}),
    hits AS (
        SELECT d.id AS doc_id, b.id AS item_id, d.rid AS drid, b.rid AS brid, d.p AS dp, b.p AS ip, d.mask
        FROM seeds d JOIN seeds b ON d.seed = b.seed AND d.mask = b.mask AND d.side = 'd' AND b.side = 'b'),
    aligned AS (
        SELECT h.*, least(13, dp - 1, ip - 1) AS back, x.ws AS xs, y.ws AS ys, least(13, len(y.ws)) AS size
        FROM hits h JOIN texts x ON x.side = 'd' AND x.rid = drid JOIN texts y ON y.side = 'b' AND y.rid = brid),
    equal AS (
        SELECT doc_id, item_id, size, list_transform(
            range(0, greatest(least(back + 22, len(xs) - (dp - back) + 1), least(back + 22, len(ys) - (ip - back) + 1))),
            lambda k: CASE WHEN xs[dp - back + k] = ys[ip - back + k] THEN 1 ELSE 0 END) AS e FROM aligned),
    scored AS (
        SELECT doc_id, item_id, size, list_max(list_transform(range(1, greatest(1, len(e) - size + 1) + 1),
            lambda k: list_sum(e[k:k + size - 1]))) AS matched FROM equal)
    SELECT doc_id, item_id, count(*) AS hits, max(matched)::BIGINT AS matched
    FROM scored WHERE matched * 13 >= size * 10 GROUP BY doc_id, item_id
""")
def op8_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


@query()
def op5_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = 24
    return sharding.shard(table(spark, sf_dir, "documents"), shards).select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        "shard", "slot", sharding.shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"))


URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
_RULES_SQL = ", ".join(f"('{v}', '{k}', '{k[:k.index('/')]}', '{k[k.index('/'):]}')" for v, k in URL_RULES)


@query(f"""
    WITH rules(verdict, rule, rule_host, rule_path) AS (VALUES {_RULES_SQL}),
    split AS (
        SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
    parts AS (
        SELECT page_id, {LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
               coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM split),
    fits AS (
        SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
        FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY page_id)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)
""")
def op4_bloom_cascade_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "verdict string, key string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


@query("""
    WITH payloads AS (
        SELECT page_id, url, strlen(coalesce(html, '')) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages),
    typed AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM payloads),
    keyed AS (
        SELECT *, lower(substr(url, position('://' IN url) + 3)) AS rest,
               strftime(make_timestamp((1577836800 + page_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured FROM typed),
    named AS (
        SELECT *, CASE WHEN position('://' IN url) > 0
            THEN array_to_string(list_reverse(string_split(regexp_extract(rest, '^[^/?#]*'), '.')), ',') || ')'
                 || regexp_extract(rest, '^[^/?#]*(.*)', 1, 's')
            ELSE lower(coalesce(url, '')) END AS url_key FROM keyed)
    SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
           CASE WHEN bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN bytes >= 100 AND page_id <> first THEN first END AS refers_to, url_key, captured,
           row_number() OVER (PARTITION BY url_key ORDER BY captured, page_id) AS capture
    FROM named
""")
def op2_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def _held_out() -> Column:
    """Documents that nothing is learned from; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


@query()
def op9_script_viterbi_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~_held_out()))
    return langid.identify(docs, model).select(
        "doc_id", _held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@query()
def op1_masked_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pseudo_likelihood.score(docs, *pseudo_likelihood.train(docs))


# Places are the first 60 bits of an md5; a row is taken once more when the sizes before it
# and half of its own lie inside what its source's whole copies leave of the target.
@query(f"""
    WITH sized AS (SELECT doc_id, source, len({WORDS.format("coalesce(text, '')")})::BIGINT AS size FROM documents),
    placed AS (
        SELECT *, ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), size, 11)), 1, 15))::BIGINT AS place FROM sized),
    sizes AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM sized GROUP BY source),
    levels AS (SELECT *, source_size * 3 / weight AS level FROM sizes),
    shares AS (
        SELECT l.level, ((SELECT sum(source_size)::BIGINT FROM sizes) - coalesce(sum(3 * b.source_size), 0)::BIGINT)
               / ((SELECT sum(weight) FROM sizes) - coalesce(sum(b.weight), 0)) AS shared
        FROM (SELECT DISTINCT level FROM levels) l LEFT JOIN levels b ON b.level < l.level GROUP BY l.level),
    aims AS (
        SELECT source, source_size, CASE WHEN level < (SELECT max(shared) FROM shares WHERE level >= shared)
            THEN (3 * source_size)::DOUBLE ELSE (SELECT max(shared) FROM shares WHERE level >= shared) * weight END AS target FROM levels),
    copied AS (
        SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size))::BIGINT ELSE 0 END AS copies FROM aims),
    runs AS (
        SELECT doc_id, size, source_size, target, copies, target - copies * source_size AS space,
               sum(size) OVER (PARTITION BY p.source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT - size AS before
        FROM placed p JOIN copied c ON p.source IS NOT DISTINCT FROM c.source)
    SELECT doc_id, size, source_size, target,
           (least(3, copies + CASE WHEN before + size / 2 < space THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM runs
""")
def op11_hash_threshold_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("row.doc_id", "size", "source_size", "target", "taken")


_TERMS = "regexp_extract_all({}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_BILLIONTHS = "(1 + (1000000000 * ({n}::HUGEINT + 5)) // ({total}::HUGEINT + 5 * {size}))::BIGINT"


@query(f"""
    WITH texts AS (
        SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               {_TERMS.format(LOWER.format('text'))} AS terms FROM documents),
    found AS (SELECT rid, lang, source, unnest(terms) AS term FROM texts),
    kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
    sizes AS (SELECT lang, count(*) AS size FROM kept GROUP BY lang),
    counts AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (SELECT DISTINCT lang, source FROM texts),
    totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
    dense AS (
        SELECT lang, source, term, coalesce(n, 0) AS n, {_BILLIONTHS.format(n='coalesce(n, 0)', total='total', size='size')} AS p
        FROM totals JOIN sizes USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
    whole AS (
        SELECT lang, term, {_BILLIONTHS.format(n='n', total='total', size='size')} AS q
        FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL) JOIN sizes USING (lang)
        JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) USING (lang)),
    gaps AS (
        SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p))::BIGINT AS value
        FROM dense x JOIN dense y USING (lang, term) WHERE x.source <> y.source GROUP BY ALL),
    items AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, p - q FROM dense JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM items)
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
""")
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query(f"""
    WITH texts AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS ws FROM documents),
    known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    failed AS (
        SELECT part, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
               100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * len(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
               doc_id > min(doc_id) OVER (PARTITION BY text) AS e, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
        FROM texts LEFT JOIN known USING (doc_id)),
    cells AS (
        SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY ALL),
    lists AS (SELECT part, n, good, toxic, list_filter([
        CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END, CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END],
        lambda x: x IS NOT NULL) AS fails FROM cells),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
    orders AS (
        SELECT v.l || w.l || x.l || y.l || z.l AS filter_order FROM letters v, letters w, letters x, letters y, letters z
        WHERE len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5),
    falls AS (
        SELECT part, n, good, toxic, fails, filter_order, unnest([1, 2, 3, 4, 5]) AS step,
               list_min(list_transform(fails, lambda f: instr(filter_order, f))) AS falls FROM lists, orders),
    steps AS (
        SELECT part, filter_order, step, substr(filter_order, step, 1) AS f,
               coalesce(sum(n) FILTER (falls IS NULL OR falls > step), 0) AS kept, coalesce(sum(n) FILTER (falls = step), 0) AS removed,
               coalesce(sum(n) FILTER (falls < step AND list_contains(fails, substr(filter_order, step, 1))), 0) AS redundant,
               coalesce(sum(n) FILTER (fails = [substr(filter_order, step, 1)]), 0) AS unique_fails,
               coalesce(sum(good) FILTER (falls = step), 0) AS good_lost, coalesce(sum(toxic) FILTER (falls = step), 0) AS toxic_lost
        FROM falls GROUP BY ALL)
    SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
           unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
           (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
    FROM steps
""")
def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
