"""The given tables, re-read as driving data.

No driving data is provided, so each table of the library's data model is derived from
the given ones: customers become scenes, orders camera frames, line items annotated
boxes and predictions, events the serving capture log. Each mapping is one SELECT that
both Spark SQL and the checking engine run; MICROS and KVALUE stand for the two spellings
that differ between them. Mappings compute columns over all rows of their sources.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from wayframe.functions.taxonomy import CATEGORIES, COUNT_FIELD_MEMBERS, COUNT_FIELDS

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Part brands stand for categories; the last two are outside the known set.
_NAMES = (*CATEGORIES, "vehicle.bus.articulated", "static_object.pole")
_CATEGORY = "CASE p_brand " + " ".join(
    f"WHEN 'Brand#{i}' THEN '{name}'" for i, name in enumerate(_NAMES, 1)
) + " END"


def _counts(extra: str) -> str:
    """Per-frame predicted counts of every field, from boxes that pass ``extra``."""

    def one(field: str) -> str:
        names = ", ".join(f"'{n}'" for n in COUNT_FIELD_MEMBERS[field])
        return (
            f"CAST(sum(CASE WHEN category_name IN ({names}) AND {extra} THEN 1 ELSE 0 END)"
            f" AS BIGINT) AS {field}"
        )

    return ", ".join(one(f) for f in COUNT_FIELDS)


_COUNTS_JSON = " || ',' || ".join(f"'\"{f}\":' || CAST({f} AS STRING)" for f in COUNT_FIELDS[1:])

PROXIES = {
    "log": "SELECT CAST(n_nationkey AS STRING) AS token, lower(n_name) AS location FROM {nation}",
    "scene": """
        SELECT 'c' || CAST(c_custkey AS STRING) AS token,
          'scene-' || lpad(CAST(c_custkey AS STRING), 8, '0') AS name,
          CASE WHEN c_acctbal < 0 THEN 'Tonight' WHEN c_acctbal < 1500 THEN 'Night drive'
               ELSE 'Drive' END || ' near ' || lower(c_mktsegment)
            || CASE c_mktsegment WHEN 'MACHINERY' THEN ' in heavy RAIN'
               WHEN 'BUILDING' THEN ' by the train line' ELSE '' END AS description,
          CAST(c_nationkey AS STRING) AS log_token
        FROM {customer}""",
    "sample": """
        SELECT 's' || CAST(o_orderkey AS STRING) AS token,
          'c' || CAST(o_custkey AS STRING) AS scene_token, MICROS(o_orderdate) AS timestamp
        FROM {orders}""",
    "sample_data": """
        SELECT 'd' || CAST(o_orderkey AS STRING) AS token,
          's' || CAST(o_orderkey AS STRING) AS sample_token,
          CASE o_orderstatus WHEN 'P' THEN 'sweeps/' ELSE 'samples/' END
            || CASE o_orderpriority WHEN '1-URGENT' THEN 'CAM_FRONT'
               WHEN '2-HIGH' THEN 'CAM_FRONT_LEFT' WHEN '3-MEDIUM' THEN 'CAM_BACK'
               WHEN '5-LOW' THEN 'RADAR_FRONT' ELSE 'CAM_BACK_RIGHT' END
            || '/' || CAST(o_orderkey AS STRING) || '.jpg' AS filename,
          CAST(1600 AS BIGINT) AS width, CAST(900 AS BIGINT) AS height,
          MICROS(o_orderdate) AS timestamp, o_orderstatus <> 'P' AS is_key_frame
        FROM {orders}""",
    # Annotated boxes; those near the right edge reach past the image.
    "boxes": f"""
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-'
            || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-'
            || CAST(CAST(floor(l_extendedprice * 100 + 5e-1) AS BIGINT) AS STRING)
            AS annotation_token,
          'd' || CAST(l_orderkey AS STRING) AS sample_data_token,
          {_CATEGORY} AS category_name,
          CASE WHEN l_linenumber < 5 THEN CAST(l_linenumber AS STRING)
               WHEN l_linenumber < 7 THEN '4' ELSE 'unknown' END AS visibility_token,
          CAST(floor(l_quantity) AS BIGINT) AS num_lidar_pts,
          CAST(l_linenumber AS BIGINT) AS num_radar_pts,
          CAST((l_partkey * 37) % 1500 AS DOUBLE) AS x_min,
          CAST((l_suppkey * 53 + l_linenumber * 17) % 840 AS DOUBLE) AS y_min,
          (l_partkey * 37) % 1500 + 20 + 3e0 * l_quantity AS x_max,
          least((l_suppkey * 53 + l_linenumber * 17) % 840 + 15 + 2e0 * l_quantity, 9e2) AS y_max,
          l_discount, l_tax, l_returnflag, l_linestatus
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    # One prediction near every box, a second one for part of them, and some of a wrong class.
    "predictions": """
        SELECT sample_data_token AS frame, annotation_token || '-' || CAST(k AS STRING) AS box_id,
          CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN (cls + 1) % 5
               ELSE cls END AS INT) AS cls,
          floor((1e0 - l_discount * 8 + k * l_tax) * 100 + 5e-1) / 1e2 AS conf,
          x_min + floor(l_tax * 100 + 5e-1) * (2 + k) AS x_min, y_min + 3e0 * k AS y_min,
          x_max + floor(l_tax * 100 + 5e-1) * (2 + k) AS x_max, y_max + 2e0 * k AS y_max
        FROM (
          SELECT *, CASE
              WHEN category_name = 'vehicle.car' THEN 0 WHEN category_name = 'vehicle.truck' THEN 1
              WHEN category_name LIKE 'vehicle.bus%' THEN 2
              WHEN category_name LIKE 'human.pedestrian%' THEN 3
              WHEN category_name = 'vehicle.bicycle' THEN 4 END AS cls, 0 AS k
          FROM {boxes}
          UNION ALL
          SELECT *, CASE
              WHEN category_name = 'vehicle.car' THEN 0 WHEN category_name = 'vehicle.truck' THEN 1
              WHEN category_name LIKE 'vehicle.bus%' THEN 2
              WHEN category_name LIKE 'human.pedestrian%' THEN 3
              WHEN category_name = 'vehicle.bicycle' THEN 4 END AS cls, 1 AS k
          FROM {boxes} WHERE l_linestatus = 'F') guesses
        WHERE cls IS NOT NULL""",
    # Files found on disk: frames that have a finished line item; radar is never there.
    "listing": """
        SELECT DISTINCT filename FROM {sample_data}
        JOIN {lineitem} ON token = 'd' || CAST(l_orderkey AS STRING)
        WHERE l_linestatus = 'F' AND filename NOT LIKE '%RADAR%'""",
    "splits": """
        SELECT 'scene-' || lpad(CAST(c_custkey AS STRING), 8, '0') AS scene_name,
          CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'val' ELSE 'train' END AS split
        FROM {customer} WHERE c_mktsegment <> 'FURNITURE'""",
    "listed_frames": """
        SELECT DISTINCT 'd' || CAST(l_orderkey AS STRING) AS sample_data_token
        FROM {lineitem} WHERE l_returnflag = 'R'""",
    "stored_frames": """
        SELECT DISTINCT 'd' || CAST(l_orderkey AS STRING) AS sample_data_token
        FROM {lineitem} WHERE l_returnflag = 'A' AND l_linestatus = 'O'""",
    "box_counts": f"""
        SELECT sample_data_token, 'small' AS model, {_counts("l_discount < 7e-2")}
        FROM {{boxes}} GROUP BY sample_data_token
        UNION ALL
        SELECT sample_data_token, 'large' AS model, {_counts("l_tax < 6e-2")}
        FROM {{boxes}} GROUP BY sample_data_token""",
    # Two models' labels of every frame that has boxes.
    "frame_labels": f"""
        SELECT b.sample_data_token, b.model,
          CASE WHEN c_acctbal < 1500 THEN
                 CASE WHEN o_orderpriority = '2-HIGH' THEN 'dusk_dawn'
                      WHEN o_totalprice < 1e5 AND b.model = 'small' THEN 'day' ELSE 'night' END
               WHEN o_totalprice > 45e4 THEN 'night' ELSE 'day' END AS time_of_day,
          CASE WHEN c_mktsegment = 'MACHINERY' AND (o_totalprice > 6e4 OR b.model = 'large')
                 THEN 'rain'
               WHEN o_orderpriority = '5-LOW' THEN 'overcast'
               WHEN o_totalprice > 49e4 THEN 'fog' ELSE 'clear' END AS weather,
          {", ".join(f"b.{f}" for f in COUNT_FIELDS)}
        FROM {{box_counts}} b
        JOIN {{orders}} ON b.sample_data_token = 'd' || CAST(o_orderkey AS STRING)
        JOIN {{customer}} ON o_custkey = c_custkey""",
    # Raw label results: every frame's first batch, and a second one for open orders, with
    # failures and damaged documents chosen by the order number.
    "results": f"""
        SELECT custom_id, model, path, position,
          CASE k % 13 WHEN 0 THEN 'errored' WHEN 1 THEN 'errored' WHEN 2 THEN 'expired'
            WHEN 3 THEN 'canceled' ELSE 'succeeded' END AS result_type,
          CASE k % 13 WHEN 4 THEN 'refusal' WHEN 5 THEN 'max_tokens' ELSE 'end_turn' END
            AS stop_reason,
          CASE k % 13 WHEN 0 THEN 'invalid_request' WHEN 1 THEN 'api_error' END AS error_type,
          CASE k % 19
            WHEN 0 THEN 'not json' WHEN 1 THEN '' WHEN 2 THEN '[' || document || ']'
            WHEN 3 THEN replace(document, '"hazards"', '"dangers"')
            WHEN 4 THEN replace(document, '"weather"', '"extra":1,"weather"')
            WHEN 5 THEN replace(document, '"cars":' || CAST(cars AS STRING),
                                '"cars":"' || CAST(cars AS STRING) || '"')
            WHEN 6 THEN replace(document, '"cars":' || CAST(cars AS STRING),
                                '"cars":' || CAST(cars AS STRING) || '.0')
            WHEN 7 THEN replace(document, '"cars":' || CAST(cars AS STRING), '"cars":2.5')
            WHEN 8 THEN replace(document, '"cars":' || CAST(cars AS STRING), '"cars":-1')
            WHEN 9 THEN replace(document, '"cars":' || CAST(cars AS STRING), '"cars":true')
            WHEN 10 THEN replace(document, '"cars":' || CAST(cars AS STRING), '"cars":null')
            WHEN 11 THEN replace(document, '"night"', '"midnight"')
            WHEN 12 THEN replace(document, '["open door"]', '[7]')
            WHEN 13 THEN replace(document, '"weather":"', '"weather":5,"w":"')
            ELSE document END AS text
        FROM (
          SELECT f.sample_data_token AS custom_id, model, cars,
            model || '-1' AS path, o_orderkey AS position, o_orderkey AS k,
            '{{{{"time_of_day":"' || time_of_day || '","weather":"' || weather
              || '","object_counts":{{{{"cars":' || CAST(cars AS STRING) || ',' || {_COUNTS_JSON}
              || '}}}},"hazards":["open door"],"notable_conditions":[],"label_confidence":"high"}}}}'
              AS document
          FROM {{frame_labels}} f
          JOIN {{orders}} ON f.sample_data_token = 'd' || CAST(o_orderkey AS STRING)
          UNION ALL
          SELECT f.sample_data_token, model, cars,
            model || '-2', o_orderkey, o_orderkey + 7,
            '{{{{"time_of_day":"' || time_of_day || '","weather":"' || weather
              || '","object_counts":{{{{"cars":' || CAST(cars AS STRING) || ',' || {_COUNTS_JSON}
              || '}}}},"hazards":["open door"],"notable_conditions":[],"label_confidence":"low"}}}}'
          FROM {{frame_labels}} f
          JOIN {{orders}} ON f.sample_data_token = 'd' || CAST(o_orderkey AS STRING)
          WHERE o_orderstatus = 'O') answers""",
    # Batches that were sent: one per model and order priority; urgent ones still run.
    "batches": """
        SELECT model, CASE o_orderpriority WHEN '1-URGENT' THEN 'in_progress' ELSE 'ended' END
            AS status, sample_data_token
        FROM {frame_labels}
        JOIN {orders} ON sample_data_token = 'd' || CAST(o_orderkey AS STRING)""",
    "requests": """
        SELECT model, sample_data_token,
          CAST(floor(o_totalprice) AS BIGINT) AS size
        FROM {frame_labels}
        JOIN {orders} ON sample_data_token = 'd' || CAST(o_orderkey AS STRING)""",
    "vectors": """
        SELECT 'v' || CAST(vec_id AS STRING) AS sample_data_token, embedding AS vector,
          'scene-' || CAST(label AS STRING) AS scene_name, label,
          'CAM_FRONT' AS channel, label >= 7 AS is_night
        FROM {embeddings}""",
    "capture": """
        SELECT event_id, ts, CAST(1600 AS BIGINT) AS width, CAST(900 AS BIGINT) AS height,
          CAST(KVALUE(props) AS BIGINT) AS n_boxes, value AS brightness,
          value AS latency_ms, event_type AS model_version
        FROM {events}""",
    # Experiment arms: one row per return flag, metrics from the line items.
    "arm_results": """
        SELECT CASE l_returnflag WHEN 'A' THEN 'baseline' WHEN 'N' THEN 'mined' ELSE 'random' END
            AS arm,
          count(*) AS n_train_images, count(DISTINCT l_tax) AS val_images,
          sum(CASE WHEN l_discount > 4e-2 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE)
            AS overall_map50_95,
          sum(CASE WHEN l_tax > 4e-2 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE)
            AS night_map50_95
        FROM {lineitem} GROUP BY l_returnflag""",
    # Cuboids in front of a camera, one per line item.
    "cuboids": """
        SELECT annotation_token, num_lidar_pts / 1e1 - 2.5e0 + 4e0 * (x_min / 1500 - 5e-1) AS cx,
          (y_min - 420) / 2e2 AS cy, (x_min + y_min) / 1e2 - 3e0 AS cz,
          5e-1 + num_radar_pts / 2e0 AS w, 1e0 + num_lidar_pts / 1e1 AS l,
          1e0 + num_radar_pts / 1e1 AS h, x_min / 1500 * 3e0 AS angle
        FROM {boxes}""",
}

_KVALUE_SPARK = "get_json_object(props, '$.k')"
_WORD = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")
def _spelled(sql: str, dialect: str) -> str:
    if dialect == "spark":
        sql = re.sub(r"MICROS\((\w+)\)", r"unix_micros(CAST(\1 AS TIMESTAMP))", sql)
        return re.sub(r"KVALUE\((\w+)\)", r"get_json_object(\1, '$.k')", sql)
    sql = re.sub(r"MICROS\((\w+)\)", r"epoch_us(\1)", sql)
    return re.sub(r"KVALUE\((\w+)\)", r"json_extract_string(\1, '$.k')", sql)


def _named(sql: str) -> str:
    return _WORD.sub(r"\1", sql).replace("{{", "{").replace("}}", "}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a proxy built from the given tables."""
    if name not in PROXIES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = PROXIES[name]
    inputs = {word: table(spark, sf_dir, word) for word in set(_WORD.findall(sql))}
    return spark.sql(_spelled(sql, "spark"), **inputs)


def twin(sql: str, ctes: dict[str, str]) -> str:
    """A standalone query for the checking engine: ``sql`` plus the views it names."""
    order: list[str] = []

    def need(text: str) -> None:
        for word in _WORD.findall(text):
            source = ctes.get(word) or PROXIES.get(word)
            if source is None or word in order:
                continue
            need(source)
            if word not in order:
                order.append(word)

    need(sql)
    parts = []
    for word in order:
        text = ctes.get(word) or PROXIES[word]
        parts.append(f"{word} AS ({_named(_spelled(text, 'duckdb'))})")
    body = _named(_spelled(sql, "duckdb")).strip()
    if body.upper().startswith("WITH "):
        own = body[5:].strip()
        if own.upper().startswith("RECURSIVE "):
            own = own[10:]
        return "WITH RECURSIVE " + ", ".join([*parts, own]) if parts else "WITH RECURSIVE " + own
    return ("WITH RECURSIVE " + ", ".join(parts) + " " + body) if parts else body
