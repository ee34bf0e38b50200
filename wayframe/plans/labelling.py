"""Queries over samples for labelling, label results and label evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayframe.functions.conditions import STRATUM_COLUMNS, stratum_label
from wayframe.functions.taxonomy import COUNT_FIELD_MEMBERS, COUNT_FIELDS
from wayframe.operators import arms, evaluate, labelling, sampling
from wayframe.operators.draw import draw_n
from wayframe.plans.metadata import STRATUM_SQL, flat_tables, manifest_of
from wayframe.plans.proxies import table
from wayframe.plans.registry import query, r6, rounded, view
from wayframe.sources.scratch import settle

# --- sampling -------------------------------------------------------------------------


def allocation_views(prefix: str, strata: str, keys: str, total: int, floor: int) -> None:
    """Twin of the allocator: pinning passes as a recursion over strata, then remainders.

    ``strata`` selects the keys and a count n per stratum; the quotas end up in the view
    ``<prefix>_quota``.
    """
    view(f"{prefix}_list", f"""
        SELECT *, row_number() OVER (ORDER BY n DESC, {keys}) AS i FROM ({strata})""")
    view(f"{prefix}_start", f"SELECT list(n ORDER BY i) AS ns FROM {{{prefix}_list}}")
    view(f"{prefix}_steps", f"""
        SELECT ns, 1 AS i, CAST({total} AS BIGINT) AS budget,
          list_transform(ns, lambda x: CAST(NULL AS BIGINT)) AS fixed,
          CAST(list_sum(ns) AS BIGINT) AS mass, false AS pinned, false AS done
        FROM {{{prefix}_start}}
        UNION ALL
        SELECT ns,
          CASE WHEN i > len(ns) THEN 1 ELSE i + 1 END,
          CASE WHEN hit THEN budget - least({floor}, ns[i]) ELSE budget END,
          CASE WHEN hit THEN list_concat(list_append(fixed[:i - 1], least({floor}, ns[i])),
                                         fixed[i + 1:]) ELSE fixed END,
          CASE WHEN i > len(ns) THEN CAST(coalesce(list_sum(list_transform(ns,
                 lambda x, j: CASE WHEN fixed[j] IS NULL THEN x ELSE 0 END)), 0) AS BIGINT)
               ELSE mass END,
          CASE WHEN i > len(ns) THEN false ELSE pinned OR hit END,
          i > len(ns) AND NOT pinned
        FROM (SELECT *, i <= len(ns) AND fixed[i] IS NULL
                AND budget * ns[i] < least({floor}, ns[i]) * mass AS hit
              FROM {prefix}_steps WHERE NOT done)""")
    view(f"{prefix}_end", f"""
        SELECT budget, fixed, CAST(coalesce(list_sum(list_transform(ns,
          lambda x, j: CASE WHEN fixed[j] IS NULL THEN x ELSE 0 END)), 0) AS BIGINT) AS mass,
          list_sum(ns) AS population
        FROM {{{prefix}_steps}} WHERE done""")
    view(f"{prefix}_shares", f"""
        SELECT l.*, fixed[i] AS pinned_at, population, budget,
          budget * n // mass AS share, budget * n % mass AS fraction
        FROM {{{prefix}_list}} l, {{{prefix}_end}} e""")
    view(f"{prefix}_quota", f"""
        SELECT {keys}, CAST(CASE WHEN {total} >= population THEN n
          WHEN pinned_at IS NOT NULL THEN pinned_at
          ELSE share + CASE WHEN row_number() OVER (PARTITION BY pinned_at IS NULL
                   ORDER BY fraction DESC, n DESC, {keys})
                 <= budget - sum(share) OVER (PARTITION BY pinned_at IS NULL) THEN 1 ELSE 0 END
          END AS BIGINT) AS quota
        FROM {{{prefix}_shares}}""")


STRATA = ", ".join(STRATUM_COLUMNS)
view("labelled_frames", """
    SELECT s.*, m.present FROM {samples} s
    JOIN {manifest} m USING (sample_data_token) WHERE m.present AND s.channel = 'CAM_FRONT'""")
allocation_views(
    "frames", f"SELECT {STRATA}, count(*) AS n FROM {{labelled_frames}} GROUP BY ALL",
    STRATA, 400, 2,
)
view("label_sample", f"""
    SELECT * EXCLUDE (rank, quota) FROM (
      SELECT f.*, row_number() OVER (PARTITION BY {STRATA}
        ORDER BY md5(concat_ws('|', sample_data_token, '6')), sample_data_token) AS rank
      FROM {{labelled_frames}} f)
    JOIN {{frames_quota}} USING ({STRATA}) WHERE rank <= quota""")
allocation_views(
    "subset", f"SELECT {STRATA}, count(*) AS n FROM {{label_sample}} GROUP BY ALL", STRATA, 150, 1
)


@query("A6 P15", f"""
    SELECT {STRATUM_SQL} AS stratum, count(*) AS n FROM {{samples}} GROUP BY ALL""")
def stratum_counts(spark, d):
    samples = flat_tables(spark, d)[0]
    counts = sampling.stratum_counts(samples)
    label = stratum_label(*[F.col(c) for c in STRATUM_COLUMNS])
    return counts.select(label.alias("stratum"), "n")


@query("W1", f"SELECT {STRATA}, quota FROM {{frames_quota}}")
def stratum_quotas(spark, d):
    samples = flat_tables(spark, d)[0].filter(F.col("channel") == "CAM_FRONT")
    frames = samples.join(
        manifest_of(spark, d).filter("present").select("sample_data_token"), "sample_data_token"
    )
    return sampling.quotas_for(frames, STRATUM_COLUMNS, 400, 2)


@query("W1 W2 W3 U2 P15 J5 T4", f"""
    SELECT *, coalesce(row_number() OVER (PARTITION BY {STRATA}
        ORDER BY md5(concat_ws('|', sample_data_token, '7')), sample_data_token) <= quota, false)
        AS in_subset,
      {STRATUM_SQL} AS stratum
    FROM {{label_sample}} LEFT JOIN {{subset_quota}} USING ({STRATA})""".replace(
    "SELECT *,", "SELECT * EXCLUDE (quota),", 1))
def labelling_sample(spark, d):
    return sampling.labelling_sample(
        flat_tables(spark, d)[0], manifest_of(spark, d), size=400, floor=2, subset_size=150,
        subset_floor=1,
    )


allocation_views(
    "lang", "SELECT lang, count(*) AS n FROM documents GROUP BY lang", "lang", 150, 25
)


@query("W1 W2", """
    SELECT doc_id, lang, source FROM (
      SELECT *, row_number() OVER (PARTITION BY lang
        ORDER BY md5(concat_ws('|', CAST(doc_id AS STRING), '64')), doc_id) AS rank
      FROM documents) JOIN {lang_quota} USING (lang) WHERE rank <= quota""")
def stratified_documents(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return sampling.stratified_draw(docs, ["lang"], 150, 25, "doc_id", 64)


@query("W6", """
    SELECT sample_data_token, channel, n_boxes FROM {samples}
    ORDER BY md5(concat_ws('|', sample_data_token, '0')), sample_data_token LIMIT 200""")
def uniform_draw(spark, d):
    samples = flat_tables(spark, d)[0].select("sample_data_token", "channel", "n_boxes")
    return draw_n(samples, 200, "sample_data_token", 0)


# --- split and arms -------------------------------------------------------------------

view("train_scenes", """
    SELECT scene_name, bool_or(is_night) AS is_night, count(*) AS n_frames
    FROM {samples} JOIN {splits} USING (scene_name) WHERE split = 'train' GROUP BY scene_name""")
view("scene_roles", """
    SELECT * EXCLUDE (rank, n), CASE WHEN rank <= greatest(1, round_even(n * 0.25::DOUBLE, 0))
      THEN 'baseline' ELSE 'pool' END AS role
    FROM (SELECT *, row_number() OVER (PARTITION BY is_night
            ORDER BY md5(concat_ws('|', scene_name, '64')), scene_name) AS rank,
            count(*) OVER (PARTITION BY is_night) AS n FROM {train_scenes})""")
view("role_frames", "SELECT sample_data_token, role FROM {samples} JOIN {scene_roles} USING (scene_name)")


def _split(spark, d):
    samples, splits = flat_tables(spark, d)[0], table(spark, d, "splits")
    train = samples.join(splits.filter("split = 'train'"), "scene_name", "left_semi")
    return samples, sampling.split_baseline_pool(sampling.scene_rollup(train))


@query("A4 J7", "SELECT * FROM {train_scenes}")
def scene_rollup(spark, d):
    samples, splits = flat_tables(spark, d)[0], table(spark, d, "splits")
    return sampling.scene_rollup(
        samples.join(splits.filter("split = 'train'"), "scene_name", "left_semi")
    )


@query("W5 A4", "SELECT * FROM {scene_roles}")
def baseline_pool_split(spark, d):
    return _split(spark, d)[1]


@query("A5", """
    SELECT role, count(*) AS n_scenes, CAST(sum(n_frames) AS BIGINT) AS n_frames,
      count(*) FILTER (is_night) AS n_night FROM {scene_roles} GROUP BY role""")
def role_totals(spark, d):
    return sampling.role_totals(_split(spark, d)[1])


view("control", """
    SELECT sample_data_token FROM {samples} JOIN {scene_roles} USING (scene_name)
    WHERE role = 'pool' AND channel = 'CAM_FRONT'
    ORDER BY md5(concat_ws('|', sample_data_token, '64')), sample_data_token LIMIT 60""")
view("baseline_frames", """
    SELECT sample_data_token FROM {samples} JOIN {scene_roles} USING (scene_name)
    WHERE role = 'baseline' AND channel = 'CAM_FRONT'""")


@query("U1 W6 J7", """
    SELECT sample_data_token FROM {baseline_frames}
    UNION SELECT sample_data_token FROM {control}""")
def arm_frames(spark, d):
    samples, split = _split(spark, d)
    pool = sampling.frames_with_role(samples, split, "pool", "CAM_FRONT")
    baseline = sampling.frames_with_role(samples, split, "baseline", "CAM_FRONT")
    return sampling.arm_frames(baseline, sampling.random_control(pool, 60, 64), "random")


@query("U3", """
    SELECT (SELECT count(*) FROM {control}) AS n_control,
      (SELECT count(*) FROM {control} SEMI JOIN {baseline_frames} USING (sample_data_token))
        AS n_in_baseline,
      (SELECT count(*) FROM {control} ANTI JOIN
        (SELECT sample_data_token FROM {role_frames} WHERE role = 'pool') p
        USING (sample_data_token)) AS n_outside_pool""")
def leakage_guard(spark, d):
    samples, split = _split(spark, d)
    token = "sample_data_token"
    split = settle(split, "split")
    pool = settle(sampling.frames_with_role(samples, split, "pool", "CAM_FRONT"), "pool")
    baseline = sampling.frames_with_role(samples, split, "baseline", "CAM_FRONT")
    baseline = settle(baseline, "baseline")
    control = settle(sampling.random_control(pool, 60, 64), "control")
    sampling.require_subset(control, pool, token, "control frames must come from the pool")
    sampling.require_disjoint(control, baseline, token, "control frames overlap the baseline")
    marks = control.join(baseline.withColumn("_b", F.lit(1)), token, "left")
    marks = marks.join(pool.withColumn("_p", F.lit(1)), token, "left")
    return marks.agg(
        F.count("*").alias("n_control"), F.count("_b").alias("n_in_baseline"),
        F.count_if(F.col("_p").isNull()).alias("n_outside_pool"),
    )


@query("A20 P28", f"""
    SELECT arm, n_train_images, val_images, {r6("overall_map50_95")} AS overall_map50_95,
      {r6("night_map50_95")} AS night_map50_95,
      {r6("CASE WHEN arm <> 'baseline' THEN overall_map50_95 - b.o END")} AS d_overall,
      {r6("CASE WHEN arm <> 'baseline' THEN night_map50_95 - b.n END")} AS d_night
    FROM {{arm_results}}, (SELECT overall_map50_95 AS o, night_map50_95 AS n
      FROM {{arm_results}} WHERE arm = 'baseline') b""")
def arm_report(spark, d):
    results = table(spark, d, "arm_results")
    merged = None
    for arm in sampling.ARMS:
        merged = arms.upsert_arm(merged, results.filter(F.col("arm") == arm))
    return rounded(
        arms.arm_report(merged), "overall_map50_95", "night_map50_95", "d_overall", "d_night"
    )


# --- label results --------------------------------------------------------------------

_COUNT_PATHS = ", ".join(
    f"json_extract(doc, '$.object_counts.{f}') AS j_{f}" for f in COUNT_FIELDS
)


def _count_sql(field: str) -> str:
    j = f"j_{field}"
    return (
        f"CASE json_type({j}) WHEN 'UBIGINT' THEN CAST({j} AS BIGINT)"
        f" WHEN 'BIGINT' THEN CAST({j} AS BIGINT)"
        f" WHEN 'DOUBLE' THEN CASE WHEN CAST({j} AS DOUBLE) = floor(CAST({j} AS DOUBLE))"
        f" THEN CAST(CAST({j} AS DOUBLE) AS BIGINT) END"
        f" WHEN 'VARCHAR' THEN CASE WHEN regexp_full_match({j} ->> '$', '\\s*[+-]?\\d+(\\.0*)?\\s*')"
        f" THEN TRY_CAST(regexp_replace(trim({j} ->> '$'), '\\.0*$', '') AS BIGINT) END"
        f" WHEN 'BOOLEAN' THEN CASE WHEN CAST({j} AS BOOLEAN) THEN 1 ELSE 0 END END AS {field}"
    )


_FIELD_KEYS = "[" + ", ".join(f"'{f}'" for f in sorted(COUNT_FIELDS)) + "]"
_ALL_COUNTS = " AND ".join(f"coalesce({f} >= 0, false)" for f in COUNT_FIELDS)


def _text_items(name: str) -> str:
    return (
        f"json_type(doc, '$.{name}') = 'ARRAY' AND list_count(list_filter("
        f"CAST(json_extract(doc, '$.{name}') AS JSON[]), lambda x: json_type(x) <> 'VARCHAR')) = 0"
    )


def _one_of(name: str, values: str) -> str:
    return f"json_type(doc, '$.{name}') = 'VARCHAR' AND (doc ->> '$.{name}') IN ({values})"


view("documents_read", f"""
    SELECT *, {_COUNT_PATHS} FROM (
      SELECT *, CASE WHEN json_valid(text) THEN CAST(text AS JSON) END AS doc FROM {{results}})""")
view("documents_counted", f"""
    SELECT * EXCLUDE ({", ".join(f"j_{f}" for f in COUNT_FIELDS)}),
      {", ".join(_count_sql(f) for f in COUNT_FIELDS)} FROM {{documents_read}}""")
view("documents_checked", f"""
    SELECT *, doc IS NOT NULL AND coalesce(json_type(doc) = 'OBJECT'
      AND list_sort(json_keys(doc)) = ['hazards', 'label_confidence', 'notable_conditions',
            'object_counts', 'time_of_day', 'weather']
      AND json_type(doc, '$.object_counts') = 'OBJECT'
      AND list_sort(json_keys(doc, '$.object_counts')) = {_FIELD_KEYS}
      AND {_one_of("time_of_day", "'day', 'dusk_dawn', 'night'")}
      AND {_one_of("weather", "'clear', 'overcast', 'rain', 'fog'")}
      AND {_one_of("label_confidence", "'low', 'medium', 'high'")}
      AND {_text_items("hazards")} AND {_text_items("notable_conditions")}
      AND {_ALL_COUNTS}, false) AS schema_ok
    FROM {{documents_counted}}""")
view("parsed", f"""
    SELECT custom_id AS sample_data_token, model, path, position, parse_status,
      CASE WHEN parse_status = 'ok' THEN doc ->> '$.time_of_day' END AS time_of_day,
      CASE WHEN parse_status = 'ok' THEN doc ->> '$.weather' END AS weather,
      CASE WHEN parse_status = 'ok' THEN CAST(doc -> '$.hazards' AS STRING) END AS hazards,
      CASE WHEN parse_status = 'ok' THEN CAST(doc -> '$.notable_conditions' AS STRING) END
        AS notable_conditions,
      CASE WHEN parse_status = 'ok' THEN doc ->> '$.label_confidence' END AS label_confidence,
      {", ".join(f"CASE WHEN parse_status = 'ok' THEN {f} END AS {f}" for f in COUNT_FIELDS)}
    FROM (SELECT *, CASE
        WHEN result_type = 'errored' THEN CASE WHEN error_type = 'invalid_request'
          THEN 'errored_bad_request' ELSE 'errored_server' END
        WHEN result_type IN ('expired', 'canceled') THEN result_type
        WHEN stop_reason = 'refusal' THEN 'refusal'
        WHEN stop_reason = 'max_tokens' THEN 'truncated'
        WHEN coalesce(text, '') = '' THEN 'invalid_json'
        WHEN schema_ok THEN 'ok' WHEN doc IS NOT NULL THEN 'schema_invalid'
        ELSE 'invalid_json' END AS parse_status FROM {{documents_checked}})""")
view("collected", """
    SELECT * EXCLUDE (path, position) FROM {parsed}
    QUALIFY row_number() OVER (PARTITION BY sample_data_token, model
      ORDER BY path DESC, position DESC) = 1""")


@query("P21 P22 P23", "SELECT * FROM {parsed}")
def parsed_labels(spark, d):
    return labelling.flatten_labels(labelling.with_status(table(spark, d, "results")))


@query("P21 P22 P23 W8", "SELECT * FROM {collected}")
def collected_labels(spark, d):
    return labelling.collect_labels(table(spark, d, "results"))


@query("A15", "SELECT model, parse_status, count(*) AS n FROM {collected} GROUP BY ALL")
def label_status_counts(spark, d):
    return labelling.status_counts(labelling.latest_status(table(spark, d, "results")))


@query("A27", """
    SELECT model, CASE WHEN event_type IN ('succeeded', 'errored', 'canceled', 'expired')
      THEN event_type ELSE 'errored' END AS result_type, count(*) AS n
    FROM (SELECT model, result_type AS event_type FROM {results} UNION ALL
          SELECT 'capture', event_type FROM events) GROUP BY ALL""")
def result_type_counts(spark, d):
    raw = table(spark, d, "results").select("model", "result_type")
    events = table(spark, d, "events").select(
        F.lit("capture").alias("model"), F.col("event_type").alias("result_type")
    )
    return labelling.result_counts(raw.unionByName(events), "model")


@query("J18", """
    SELECT model, sample_data_token, size FROM {requests} r
    WHERE NOT EXISTS (SELECT 1 FROM {collected} c WHERE c.model = r.model
        AND c.sample_data_token = r.sample_data_token AND c.parse_status IN
        ('ok', 'refusal', 'truncated', 'invalid_json', 'schema_invalid', 'errored_bad_request'))
      AND NOT EXISTS (SELECT 1 FROM {batches} b WHERE b.model = r.model
        AND b.sample_data_token = r.sample_data_token AND b.status <> 'ended')""")
def pending_requests(spark, d):
    statuses = labelling.latest_status(table(spark, d, "results"))
    batches = table(spark, d, "batches").select(
        "model", "status", F.array("sample_data_token").alias("custom_ids")
    )
    return labelling.pending(
        table(spark, d, "requests"), statuses, labelling.in_flight_tokens(batches)
    )


PRICES = {"small": (1.0, 5.0), "large": (5.0, 25.0)}


@query("P24", f"""
    SELECT model, count(*) AS n_frames, {r6('''count(*) * (CASE model
      WHEN 'small' THEN (2300 * 1e0 + 350 * 5e0) ELSE (2300 * 5e0 + 350 * 25e0) END) / 1e6 * 5e-1
      ''')} AS cost
    FROM {{requests}} GROUP BY model""")
def label_cost(spark, d):
    return rounded(labelling.estimate_cost(table(spark, d, "requests"), PRICES), "cost")


view("sharded", """
    SELECT model, sample_data_token, size, shard,
      row_number() OVER (PARTITION BY model, shard ORDER BY sample_data_token) AS i
    FROM (SELECT *, CAST(CAST('0x' || substr(md5(sample_data_token), 1, 8) AS BIGINT) % 16 AS INT)
      AS shard FROM {requests})""")
view("filled", """
    SELECT model, shard, i, sample_data_token, size, CAST(0 AS BIGINT) AS batch, 1 AS held,
      size AS bytes
    FROM {sharded} WHERE i = 1
    UNION ALL
    SELECT s.model, s.shard, s.i, s.sample_data_token, s.size,
      CASE WHEN f.held >= 8 OR f.bytes + s.size > 2000000 THEN f.batch + 1 ELSE f.batch END,
      CASE WHEN f.held >= 8 OR f.bytes + s.size > 2000000 THEN 1 ELSE f.held + 1 END,
      CASE WHEN f.held >= 8 OR f.bytes + s.size > 2000000 THEN s.size ELSE f.bytes + s.size END
    FROM filled f JOIN {sharded} s ON s.model = f.model AND s.shard = f.shard AND s.i = f.i + 1""")


@query("P25", "SELECT model, sample_data_token, size, shard, batch FROM {filled}")
def request_batches(spark, d):
    return labelling.assign_batches(
        table(spark, d, "requests"), chunk_size=8, max_bytes=2_000_000, shards=16
    )


# Sequential filling over whole models: where the batch after one that begins at i begins.
view("numbered", """
    SELECT *, row_number() OVER w AS i, sum(size) OVER w AS upto
    FROM {requests} WINDOW w AS (PARTITION BY model ORDER BY sample_data_token ROWS UNBOUNDED PRECEDING)""")
view("nexts", """
    SELECT model, i, i + greatest(1, %s) AS after FROM {numbered} WINDOW w AS (PARTITION BY model ORDER BY i)""" % " + ".join(
    f"CASE WHEN lead(upto, {k}) OVER w - upto + size <= 2000000 THEN 1 ELSE 0 END" if k else "CASE WHEN size <= 2000000 THEN 1 ELSE 0 END"
    for k in range(8)))
view("starts", """
    SELECT model, CAST(1 AS BIGINT) AS i FROM {numbered} WHERE i = 1
    UNION ALL
    SELECT n.model, n.after FROM starts s JOIN {nexts} n ON n.model = s.model AND n.i = s.i
    JOIN {numbered} x ON x.model = n.model AND x.i = n.after""")


@query("P25", """
    SELECT model, sample_data_token, size, CAST(count(s.found) OVER (PARTITION BY model ORDER BY i) - 1 AS BIGINT) AS batch
    FROM {numbered} LEFT JOIN (SELECT *, true AS found FROM {starts}) s USING (model, i)""")
def sequential_batches(spark, d):
    """Every model's requests in batches filled one after another, though by many tasks."""
    return labelling.fill_batches(table(spark, d, "requests"), chunk_size=8, max_bytes=2_000_000, rows_per_cut=500)


# --- evaluation -----------------------------------------------------------------------

_FIELD_SQL = "CASE " + " ".join(
    f"WHEN category_name IN ({', '.join(repr(n) for n in COUNT_FIELD_MEMBERS[f])}) THEN '{f}'"
    for f in COUNT_FIELDS
) + " END"


def _gt_view(name: str, floor: str) -> None:
    view(name, f"""
        SELECT sample_data_token, {", ".join(
            f"count(*) FILTER (field = '{f}') AS {f}" for f in COUNT_FIELDS)}
        FROM (SELECT DISTINCT sample_data_token FROM {{small}}) LEFT JOIN (
          SELECT sample_data_token, {_FIELD_SQL} AS field FROM {{annotations}} WHERE {floor})
          USING (sample_data_token)
        GROUP BY sample_data_token""")


view("small", "SELECT * FROM {frame_labels} WHERE model = 'small'")
view("large", "SELECT * FROM {frame_labels} WHERE model = 'large'")
_gt_view("gt_all", "true")
_gt_view("gt_visible", "TRY_CAST(visibility_token AS INT) >= 2")
_FIELD_LIST = ", ".join(COUNT_FIELDS)
view("count_pairs", f"""
    SELECT * FROM (UNPIVOT (SELECT sample_data_token, {_FIELD_LIST} FROM {{small}})
        ON {_FIELD_LIST} INTO NAME class VALUE pred)
    JOIN (UNPIVOT (SELECT sample_data_token, {_FIELD_LIST} FROM {{gt_all}})
        ON {_FIELD_LIST} INTO NAME class VALUE actual) USING (sample_data_token, class)""")


def _score_sql(prefix: str, tp: str, fp: str, fn: str) -> str:
    p = f"CASE WHEN {tp} + {fp} > 0 THEN {tp} / ({tp} + {fp}) ELSE 0 END"
    r = f"CASE WHEN {tp} + {fn} > 0 THEN {tp} / ({tp} + {fn}) ELSE 0 END"
    f1 = f"CASE WHEN ({p}) + ({r}) > 0 THEN 2 * ({p}) * ({r}) / (({p}) + ({r})) ELSE 0 END"
    return (
        f"{r6(p)} AS {prefix}_precision, {r6(r)} AS {prefix}_recall, {r6(f1)} AS {prefix}_f1"
    )


def _flag_sql(name: str, predicted: str, actual: str) -> str:
    n = {
        "tp": f"count(*) FILTER (({predicted}) AND ({actual}))",
        "fp": f"count(*) FILTER (({predicted}) AND NOT ({actual}))",
        "fn": f"count(*) FILTER (NOT ({predicted}) AND ({actual}))",
    }
    accuracy = r6(f"count(*) FILTER (({predicted}) = ({actual})) / count(*)")
    return f"{accuracy} AS {name}_accuracy, {_score_sql(name, **n)}"


def _labels_of(spark, d, model: str):
    return table(spark, d, "frame_labels").filter(F.col("model") == model)


@query("A11 P6 J7", "SELECT * FROM {gt_all}")
def gt_counts(spark, d):
    return evaluate.gt_counts(_labels_of(spark, d, "small"), flat_tables(spark, d)[1])


@query("A11 P7", "SELECT * FROM {gt_visible}")
def gt_counts_visible(spark, d):
    return evaluate.gt_counts(_labels_of(spark, d, "small"), flat_tables(spark, d)[1], 2)


@query("A9 A10 J10", f"""
    SELECT CASE WHEN grouping(stratum) = 1 THEN 'overall' ELSE stratum END AS scope,
      count(*) AS n, {_flag_sql("night", "time_of_day = 'night'", "is_night")},
      {r6("count(*) FILTER (time_of_day = 'dusk_dawn') / count(*)")} AS dusk_dawn_share,
      {_flag_sql("rain", "weather = 'rain'", "is_rain")},
      {r6("count(*) FILTER (weather = 'overcast') / count(*)")} AS overcast_share,
      {r6("count(*) FILTER (weather = 'fog') / count(*)")} AS fog_share
    FROM {{small}} JOIN (SELECT sample_data_token, is_night, is_rain, {STRATUM_SQL} AS stratum
      FROM {{samples}}) USING (sample_data_token)
    GROUP BY GROUPING SETS ((), (stratum))""")
def eval_flags(spark, d):
    samples = flat_tables(spark, d)[0]
    sample = samples.withColumn("stratum", stratum_label(*[F.col(c) for c in STRATUM_COLUMNS]))
    flags = evaluate.eval_flags(_labels_of(spark, d, "small"), sample)
    return rounded(flags, *[c for c in flags.columns if c not in ("scope", "n")])


@query("A12 J11 A9", f"""
    SELECT class, count(*) AS n, CAST(sum(actual) AS BIGINT) AS gt_total,
      CAST(sum(pred) AS BIGINT) AS pred_total, {r6("avg(abs(pred - actual))")} AS mae,
      {r6("count(*) FILTER (pred = actual) / count(*)")} AS exact_rate,
      {r6("count(*) FILTER (abs(pred - actual) <= 1) / count(*)")} AS within_1_rate,
      {_score_sql("presence", "count(*) FILTER (pred > 0 AND actual > 0)",
                  "count(*) FILTER (pred > 0 AND actual = 0)",
                  "count(*) FILTER (pred = 0 AND actual > 0)")}
    FROM {{count_pairs}} GROUP BY class""")
def eval_counts(spark, d):
    labels = _labels_of(spark, d, "small")
    gt = evaluate.gt_counts(labels, flat_tables(spark, d)[1])
    counts = evaluate.eval_counts(labels, gt)
    keep = ("class", "n", "gt_total", "pred_total")
    return rounded(counts, *[c for c in counts.columns if c not in keep])


@query("A13", f"""
    SELECT CASE WHEN actual = 0 THEN '0' WHEN actual <= 3 THEN '1-3' WHEN actual <= 9 THEN '4-9'
      ELSE '10+' END AS bucket, count(*) AS n, {r6("avg(abs(pred - actual))")} AS mae
    FROM {{count_pairs}} GROUP BY 1""")
def eval_buckets(spark, d):
    labels = _labels_of(spark, d, "small")
    gt = evaluate.gt_counts(labels, flat_tables(spark, d)[1])
    return rounded(evaluate.eval_buckets(labels, gt), "mae")


@query("A14 J12", f"""
    SELECT count(*) AS n,
      {r6("avg(CAST(a.time_of_day = b.time_of_day AS INT))")} AS time_of_day_agreement,
      {r6("avg(CAST(a.weather = b.weather AS INT))")} AS weather_agreement,
      {r6("sum(" + " + ".join(f"abs(a.{f} - b.{f})" for f in COUNT_FIELDS)
          + ") / (count(*) * 10)")} AS count_mae_between_models
    FROM {{small}} a JOIN {{large}} b USING (sample_data_token)""")
def model_agreement(spark, d):
    agreement = evaluate.model_agreement(_labels_of(spark, d, "small"), _labels_of(spark, d, "large"))
    return rounded(agreement, *[c for c in agreement.columns if c != "n"])


_QUALITY = _flag_sql("quality", "n_chars >= 600", "quality = 1")
_TOXIC = _flag_sql("toxic", "contains(text, '!')", "toxic = 1")


@query("A9 A10", f"""
    SELECT lang, count(*) AS n, {_QUALITY}, {_TOXIC}
    FROM documents JOIN labels USING (doc_id) GROUP BY lang""")
def document_flag_scores(spark, d):
    joined = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    tests = {
        "quality": (F.col("n_chars") >= 600, F.col("quality") == 1),
        "toxic": (F.contains("text", F.lit("!")), F.col("toxic") == 1),
    }
    sums = joined.groupBy("lang").agg(
        F.count("*").alias("n"),
        *[c for name, (p, a) in tests.items() for c in evaluate._confusion(name, p, a)],
    )
    out = ["lang", "n"]
    for name in tests:
        tp, fp, fn = (F.col(f"{name}_{c}") for c in ("tp", "fp", "fn"))
        out.append(((F.col("n") - fp - fn) / F.col("n")).alias(f"{name}_accuracy"))
        scores = evaluate.precision_recall_f1(tp, fp, fn)
        out += [v.alias(f"{name}_{k}") for k, v in scores.items()]
    scored = sums.select(*out)
    return rounded(scored, *[c for c in scored.columns if c not in ("lang", "n")])
