"""Queries over the flattened metadata: ingest, availability, validation, analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayframe import schemas
from wayframe.functions import conditions, paths, taxonomy
from wayframe.functions.geometry import normalised_box
from wayframe.operators import flatten as flat
from wayframe.operators import manifest as availability
from wayframe.operators import sampling, training, validate
from wayframe.operators.fingerprint import fingerprint
from wayframe.plans.proxies import table
from wayframe.plans.registry import query, r6, rounded, view

CAMERAS = ", ".join(f"'{c}'" for c in taxonomy.CAMERAS)
MIN_AREA = 900.0
GROUP_SQL = """CASE WHEN category_name = 'vehicle.car' THEN 'car'
    WHEN category_name = 'vehicle.truck' THEN 'truck'
    WHEN category_name = 'vehicle.bicycle' THEN 'bicycle'
    WHEN starts_with(category_name, 'vehicle.bus') THEN 'bus'
    WHEN starts_with(category_name, 'human.pedestrian') THEN 'pedestrian' END"""
CONTEXT_SQL = (
    "scene_token, scene_name, scene_description, log_token, location, is_night, is_rain"
)
STRATUM_SQL = """concat_ws('|', location, CASE WHEN is_night THEN 'night' ELSE 'day' END,
    CASE WHEN is_rain THEN 'rain' ELSE 'dry' END)"""

view("context", """
    SELECT s.token AS scene_token, name AS scene_name, description AS scene_description,
      s.log_token, location, contains(lower(description), 'night') AS is_night,
      contains(lower(description), 'rain') AS is_rain
    FROM {scene} s JOIN {log} l ON s.log_token = l.token""")
view("images", f"""
    SELECT d.token AS sample_data_token, d.sample_token, split_part(filename, '/', 2) AS channel,
      filename, width, height, d.timestamp, {CONTEXT_SQL}
    FROM {{sample_data}} d JOIN {{sample}} p ON d.sample_token = p.token
    JOIN {{context}} USING (scene_token)
    WHERE is_key_frame AND split_part(filename, '/', 2) IN ({CAMERAS})""")
view("kept", f"""
    SELECT *, (x_max - x_min) * (y_max - y_min) AS bbox_area FROM {{boxes}}
    WHERE TRY_CAST(visibility_token AS INT) >= 1
      AND (x_max - x_min) * (y_max - y_min) >= {MIN_AREA}""")
view("samples", """
    SELECT i.*, coalesce(n, 0) AS n_boxes FROM {images} i LEFT JOIN
      (SELECT sample_data_token, count(*) AS n FROM {kept} GROUP BY ALL) USING (sample_data_token)
    """)
view("annotations", f"""
    SELECT annotation_token, sample_data_token, sample_token, channel, category_name,
      {GROUP_SQL} AS category_group, visibility_token, num_lidar_pts, num_radar_pts,
      x_min, y_min, x_max, y_max, bbox_area, {CONTEXT_SQL}
    FROM {{kept}} JOIN {{images}} USING (sample_data_token)""")
view("manifest", """
    SELECT d.token AS sample_data_token, d.filename, split_part(d.filename, '/', 2) AS channel,
      lower(split_part(split_part(d.filename, '/', 2), '_', 1)) AS modality, is_key_frame,
      coalesce(p.scene_token, '') AS scene_token, coalesce(s.name, '') AS scene_name,
      l.filename IS NOT NULL AS present
    FROM {sample_data} d LEFT JOIN {sample} p ON d.sample_token = p.token
    LEFT JOIN {scene} s ON p.scene_token = s.token LEFT JOIN {listing} l ON d.filename = l.filename
    """)


def flat_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Flattened ``(samples, annotations)`` of the proxy metadata."""
    names = ("scene", "log", "sample", "sample_data", "boxes")
    return flat.flatten(*[table(spark, d, n) for n in names], min_area=MIN_AREA)


def manifest_of(spark: SparkSession, d: str) -> DataFrame:
    names = ("sample_data", "sample", "scene", "listing")
    return availability.build_manifest(*[table(spark, d, n) for n in names])


# --- flattening -----------------------------------------------------------------------


@query("J1 J2 P1 P9 P12", "SELECT * FROM {samples}")
def flatten_samples(spark, d):
    return flat_tables(spark, d)[0]


@query("J1 P4 P7 P8 P13", "SELECT * FROM {annotations}")
def flatten_annotations(spark, d):
    return flat_tables(spark, d)[1]


@query("P10", f"""
    SELECT s.* FROM {{samples}} s WHERE scene_name IN
      (SELECT DISTINCT scene_name FROM {{samples}} ORDER BY scene_name LIMIT 25)""")
def first_scenes(spark, d):
    return sampling.first_scenes(flat_tables(spark, d)[0], 25)


@query("P1 P2 P3 A10", f"""
    SELECT location, time_of_day, weather, count(*) AS images,
      CAST(sum(n_boxes) AS BIGINT) AS boxes, {r6("avg(n_boxes)")} AS boxes_per_image
    FROM (SELECT *, CASE WHEN NOT contains(lower(scene_description), 'night') THEN 'day'
                         ELSE 'night' END AS time_of_day,
            CASE WHEN NOT contains(lower(scene_description), 'rain') THEN 'clear'
                 ELSE 'rain' END AS weather FROM {{samples}})
    GROUP BY GROUPING SETS ((), (location, time_of_day, weather))""")
def slice_rollup(spark, d):
    samples = conditions.with_slices(flat_tables(spark, d)[0])
    keys = ["location", "time_of_day", "weather"]
    # Sums per slice first; the grand total is rolled up from those few rows.
    sums = samples.groupBy(*keys).agg(
        F.count("*").alias("images"), F.sum("n_boxes").alias("boxes")
    )
    out = sums.groupingSets([[], keys], *keys).agg(
        F.sum("images").alias("images"), F.sum("boxes").alias("boxes")
    )
    return rounded(
        out.withColumn("boxes_per_image", F.col("boxes") / F.col("images")), "boxes_per_image"
    )


TEXT_SLICES = {
    "length": {
        "dialogue": {"include": ["?", "!"]},
        "listing": {"include": ["\n"], "exclude": ["?"]},
        "plain": {"exclude": ["\n", "!"]},
    },
    "topic": {"the": {"include": ["The "]}, "la": {"include": [" la "], "exclude": [" the "]}},
}


@query("P2 P3", """
    SELECT lang, length, topic, count(*) AS n FROM (
      SELECT lang,
        CASE WHEN contains(t, '?') AND contains(t, '!') THEN 'dialogue'
             WHEN contains(t, chr(10)) AND NOT contains(t, '?') THEN 'listing'
             WHEN NOT contains(t, chr(10)) AND NOT contains(t, '!') THEN 'plain' END AS length,
        CASE WHEN contains(t, 'the ') THEN 'the'
             WHEN contains(t, ' la ') AND NOT contains(t, ' the ') THEN 'la' END AS topic
      FROM (SELECT lang, lower(text) AS t FROM documents))
    GROUP BY ALL""")
def text_slices(spark, d):
    docs = conditions.with_slices(table(spark, d, "documents"), TEXT_SLICES, "text")
    return docs.groupBy("lang", "length", "topic").agg(F.count("*").alias("n"))


@query("P4 P5 P6", f"""
    SELECT category_name, {GROUP_SQL} AS category_group,
      CAST(CASE {GROUP_SQL} WHEN 'car' THEN 0 WHEN 'truck' THEN 1 WHEN 'bus' THEN 2
        WHEN 'pedestrian' THEN 3 WHEN 'bicycle' THEN 4 END AS INT) AS class_index,
      CASE WHEN category_name IN ('vehicle.car', 'vehicle.emergency.police') THEN 'cars'
        WHEN category_name IN ('vehicle.truck', 'vehicle.emergency.ambulance') THEN 'trucks'
        WHEN category_name IN ('vehicle.bus.rigid', 'vehicle.bus.bendy') THEN 'buses'
        WHEN category_name = 'vehicle.trailer' THEN 'trailers'
        WHEN category_name = 'vehicle.construction' THEN 'construction_vehicles'
        WHEN category_name = 'vehicle.motorcycle' THEN 'motorcycles'
        WHEN category_name = 'vehicle.bicycle' THEN 'bicycles'
        WHEN starts_with(category_name, 'human.pedestrian.') THEN 'pedestrians'
        WHEN category_name = 'movable_object.trafficcone' THEN 'traffic_cones'
        WHEN category_name = 'movable_object.barrier' THEN 'barriers' END AS count_field,
      count(*) AS n
    FROM {{boxes}} GROUP BY ALL""")
def category_mapping(spark, d):
    name = F.col("category_name")
    # Count per name first: the mapping then runs on one row per category.
    counts = table(spark, d, "boxes").groupBy(name).agg(F.count("*").alias("n"))
    group = taxonomy.category_group(name)
    return counts.select(
        name, group.alias("category_group"), taxonomy.class_index(group).alias("class_index"),
        taxonomy.count_field(name).alias("count_field"), "n",
    )


# --- availability ---------------------------------------------------------------------


@query("J3 J4 P12", "SELECT * FROM {manifest}")
def build_manifest(spark, d):
    return manifest_of(spark, d)


@query("A1", """
    SELECT channel, is_key_frame, count(*) AS n_referenced,
      CAST(sum(CAST(present AS INT)) AS BIGINT) AS n_present
    FROM {manifest} GROUP BY ALL""")
def manifest_summary(spark, d):
    return availability.summarize(manifest_of(spark, d))


@query("A2", """
    SELECT modality, coalesce(bool_and(present), true) AS complete FROM
      (SELECT unnest(['cam', 'radar', 'lidar']) AS modality)
      LEFT JOIN (SELECT modality, present FROM {manifest} WHERE is_key_frame) USING (modality)
    GROUP BY modality""")
def manifest_gate(spark, d):
    manifest = manifest_of(spark, d)
    gates = [
        availability.keyframe_gate(manifest, m).withColumn("modality", F.lit(m))
        for m in ("cam", "radar", "lidar")
    ]
    return gates[0].unionByName(gates[1]).unionByName(gates[2])


@query("J5", """
    SELECT s.*, m.present FROM {samples} s
    JOIN {manifest} m USING (sample_data_token) WHERE m.present""")
def present_frames(spark, d):
    return availability.only_present(flat_tables(spark, d)[0], manifest_of(spark, d))


@query("J8 M2 ST5", """
    SELECT s.* FROM {samples} s
    ANTI JOIN {stored_frames} f ON s.sample_data_token = f.sample_data_token""")
def resume_frames(spark, d):
    return availability.not_done(flat_tables(spark, d)[0], table(spark, d, "stored_frames"))


# --- validation -----------------------------------------------------------------------


def _rule(name: str, column: str, broken: str, source: str, view_name: str) -> str:
    return (
        f"SELECT '{source}' AS \"table\", '{name}' AS \"rule\", '{column}' AS \"column\","
        f" count(*) FILTER ({broken}) AS violations FROM {{{view_name}}}"
    )


def _suite_sql(source: str, view_name: str, exists, required, others) -> str:
    rules = [("column_exists", c, "false") for c in exists]
    rules += [("not_null", c, f"{c} IS NULL") for c in required] + others
    union = " UNION ALL ".join(_rule(n, c, b, source, view_name) for n, c, b in rules)
    return f"SELECT *, violations = 0 AS passed FROM ({union})"


_KNOWN = ", ".join(f"'{c}'" for c in taxonomy.CATEGORIES)
_ANNOTATION_SUITE = _suite_sql(
    "annotations", "annotations", validate.ANNOTATION_COLUMNS, validate.ANNOTATION_REQUIRED,
    [("between", c, f"{c} NOT BETWEEN 0 AND 1600") for c in ("x_min", "x_max")]
    + [("between", c, f"{c} NOT BETWEEN 0 AND 900") for c in ("y_min", "y_max")]
    + [
        ("positive", "bbox_area", "bbox_area <= 0"),
        ("greater", "x_max,x_min", "x_max <= x_min"),
        ("greater", "y_max,y_min", "y_max <= y_min"),
        ("in_set", "category_name", f"category_name NOT IN ({_KNOWN})"),
        ("in_set", "category_group",
         "category_group NOT IN ('car', 'truck', 'bus', 'pedestrian', 'bicycle')"),
        ("in_set", "visibility_token", "visibility_token NOT IN ('1', '2', '3', '4')"),
    ],
)
_SAMPLE_SUITE = _suite_sql(
    "samples", "samples", validate.SAMPLE_COLUMNS, validate.SAMPLE_REQUIRED,
    [
        ("equals", "width", "width <> 1600"), ("equals", "height", "height <> 900"),
        ("in_set", "channel", f"channel NOT IN ({CAMERAS})"), ("at_least", "n_boxes", "n_boxes < 0"),
    ],
)


@query("V1 V2 V3 V4 V5 V6", _ANNOTATION_SUITE)
def validate_annotations(spark, d):
    return validate.check(flat_tables(spark, d)[1], validate.annotation_rules(), "annotations")


@query("V1 V2 V7 V8", _SAMPLE_SUITE)
def validate_samples(spark, d):
    return validate.check(flat_tables(spark, d)[0], validate.sample_rules(), "samples")


@query("V9", """
    SELECT 'boxes' AS "table", 'unique' AS "rule", 'sample_data_token' AS "column",
      CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS violations,
      coalesce(sum(n) FILTER (n > 1), 0) = 0 AS passed
    FROM (SELECT count(*) AS n FROM {boxes} GROUP BY sample_data_token)""")
def validate_unique(spark, d):
    return validate.check_unique(table(spark, d, "boxes"), "sample_data_token", "boxes")


@query("A3 V10", """
    SELECT scene_token, count(*) AS n_images FROM {samples}
    GROUP BY scene_token HAVING count(*) NOT BETWEEN 3 AND 8""")
def scene_count_outliers(spark, d):
    return validate.scene_counts(flat_tables(spark, d)[0], 3, 8)


@query("V1 V10", f"""
    SELECT bool_and(passed) AS passed, count(*) FILTER (NOT passed) AS n_failed FROM (
      SELECT passed FROM ({_ANNOTATION_SUITE}) UNION ALL SELECT passed FROM ({_SAMPLE_SUITE})
      UNION ALL
      SELECT count(*) = count(DISTINCT sample_data_token) FROM {{samples}} UNION ALL
      SELECT bool_and(n BETWEEN 3 AND 8) FROM
        (SELECT count(*) AS n FROM {{samples}} GROUP BY scene_token))""")
def validation_verdict(spark, d):
    return validate.overall(validate.validate(*flat_tables(spark, d), images_per_scene=(3, 8)))


# --- analytics views ------------------------------------------------------------------


def _sql_over(spark, d, sql: str) -> DataFrame:
    samples, annotations = flat_tables(spark, d)
    return spark.sql(
        sql, samples=samples, annotations=annotations, availability=manifest_of(spark, d)
    )


@query("SQL1", """
    SELECT category_group, location, count(*) AS boxes FROM {annotations}
    GROUP BY 1, 2 ORDER BY 3 DESC, 1 NULLS FIRST, 2 LIMIT 8""")
def boxes_by_group(spark, d):
    return _sql_over(spark, d, """
        SELECT category_group, location, count(*) AS boxes FROM {annotations}
        GROUP BY 1, 2 ORDER BY 3 DESC, 1 NULLS FIRST, 2 LIMIT 8""")


@query("SQL2", """
    SELECT location, is_night, is_rain, count(DISTINCT scene_token) AS scenes,
      count(*) AS images FROM {samples} GROUP BY 1, 2, 3""")
def scenes_by_condition(spark, d):
    return _sql_over(spark, d, """
        SELECT location, is_night, is_rain, count(DISTINCT scene_token) AS scenes,
          count(*) AS images FROM {samples} GROUP BY 1, 2, 3""")


@query("SQL3", """
    SELECT channel, is_night, round(avg(n_boxes), 2) AS avg_boxes_per_image
    FROM {samples} GROUP BY 1, 2""")
def avg_boxes_per_image(spark, d):
    return _sql_over(spark, d, """
        SELECT channel, is_night, round(avg(n_boxes), 2) AS avg_boxes_per_image
        FROM {samples} GROUP BY 1, 2""")


@query("SQL4", """
    SELECT channel, is_key_frame, count(*) AS referenced,
      CAST(sum(present::int) AS BIGINT) AS present FROM {manifest} GROUP BY 1, 2""")
def availability_by_channel(spark, d):
    return _sql_over(spark, d, """
        SELECT channel, is_key_frame, count(*) AS referenced, sum(present::int) AS present
        FROM {availability} GROUP BY 1, 2""")


# --- training export ------------------------------------------------------------------

view("exported", """
    SELECT s.*, split FROM {samples} s JOIN {splits} USING (scene_name)
    WHERE split <> 'train' OR sample_data_token IN (SELECT sample_data_token FROM {listed_frames})
    """)
_FRACTIONS = {
    "cx": "(x_min + x_max) / 2 / 1600", "cy": "(y_min + y_max) / 2 / 900",
    "bw": "(x_max - x_min) / 1600", "bh": "(y_max - y_min) / 900",
}
_FRACTION_SQL = {
    k: f"round_even(least(greatest({v}, 0.0), 1.0) * 1e6, 0) / 1e6" for k, v in _FRACTIONS.items()
}
_LINE = " || ' ' || ".join(
    ["CAST(list_position(['car', 'truck', 'bus', 'pedestrian', 'bicycle'], category_group) - 1"
     " AS STRING)"]
    + [f"CAST({v} AS STRING)" for v in _FRACTION_SQL.values()]
)
view("label_lines", f"""
    SELECT split, parse_filename(filename, true) AS stem, annotation_token AS position,
      {_LINE} AS line
    FROM {{annotations}} JOIN (SELECT sample_data_token, split, filename FROM {{exported}})
      USING (sample_data_token)
    WHERE category_group IS NOT NULL""")


def exported(spark, d, **options) -> DataFrame:
    samples, splits = flat_tables(spark, d)[0], table(spark, d, "splits")
    return training.export_frames(samples, splits, **options)


@query("J6 J7 J9", "SELECT * FROM {exported}")
def training_frames(spark, d):
    return exported(spark, d, train_frames=table(spark, d, "listed_frames"))


@query("J6 P9", """
    SELECT s.*, split FROM {samples} s JOIN {splits} USING (scene_name)
    WHERE channel IN ('CAM_FRONT', 'CAM_BACK')""")
def camera_training_frames(spark, d):
    return exported(spark, d, cameras=["CAM_FRONT", "CAM_BACK"])


@query("P13", f"""
    SELECT annotation_token, {", ".join(
        f"{r6(f'least(greatest({v}, 0.0), 1.0)')} AS {k}" for k, v in _FRACTIONS.items())}
    FROM {{annotations}}""")
def normalised_boxes(spark, d):
    boxes = flat_tables(spark, d)[1]
    return rounded(
        boxes.select("annotation_token", *[v.alias(k) for k, v in normalised_box().items()]),
        "cx", "cy", "bw", "bh",
    )


@query("P14", "SELECT * FROM {label_lines}")
def label_lines(spark, d):
    frames = exported(spark, d, train_frames=table(spark, d, "listed_frames"))
    return training.label_lines(frames, flat_tables(spark, d)[1])


view("label_files", """
    SELECT e.split, parse_filename(filename, true) AS stem,
      coalesce(label_text, '') AS label_text, coalesce(n, 0) AS n_boxes
    FROM {exported} e LEFT JOIN (
      SELECT split, stem, string_agg(line, chr(10) ORDER BY position, line) AS label_text,
        count(*) AS n FROM {label_lines} GROUP BY ALL) l
    ON e.split = l.split AND parse_filename(filename, true) = l.stem""")


@query("A16 P14", "SELECT * FROM {label_files}")
def label_files(spark, d):
    frames = exported(spark, d, train_frames=table(spark, d, "listed_frames"))
    return training.label_table(frames, flat_tables(spark, d)[1])


@query("A17", """
    SELECT count(*) FILTER (split = 'train') AS train_images,
      count(*) FILTER (split = 'val') AS val_images,
      CAST(coalesce(sum(n_boxes), 0) AS BIGINT) AS boxes FROM {label_files}""")
def export_stats(spark, d):
    return training.export_stats(label_files(spark, d))


@query("P2", """
    SELECT dim, slice, filename FROM (
      SELECT filename, unnest([
        CASE WHEN contains(lower(scene_description), 'night') THEN 'time_of_day/night'
             ELSE 'time_of_day/day' END,
        CASE WHEN contains(lower(scene_description), 'rain') THEN 'weather/rain'
             ELSE 'weather/clear' END]) AS tag
      FROM {samples} JOIN {splits} USING (scene_name) WHERE split = 'val'),
      LATERAL (SELECT split_part(tag, '/', 1) AS dim, split_part(tag, '/', 2) AS slice)""")
def slice_image_lists(spark, d):
    images = training.slice_images(exported(spark, d))
    return images.select("dim", "slice", "filename")


# Every column, so that a change anywhere changes the fingerprint.
_HASHED = schemas.SAMPLES.fieldNames()


@query("A18", f"""
    SELECT substr(sha256(concat_ws('|', CAST(n AS STRING), CAST(total AS STRING),
        CAST(mix AS STRING))), 1, 16) AS fingerprint, n AS n_rows FROM (
      SELECT count(*) AS n, sum(CAST(h AS HUGEINT)) AS total, bit_xor(h) AS mix FROM (
        SELECT CAST('0x' || substr(md5(concat_ws(chr(31), {", ".join(
            f"coalesce('=' || CAST({c} AS STRING), '-')" for c in _HASHED)})), 1, 15) AS BIGINT)
          AS h FROM {{samples}}))""")
def table_fingerprint(spark, d):
    return fingerprint(flat_tables(spark, d)[0], _HASHED)


@query("P12", """
    SELECT page_id, regexp_extract(p, '^(.*)/[^/]*$', 1) AS parent,
      split_part(p, '/', -1) AS basename,
      split_part(regexp_extract(p, '^(.*)/[^/]*$', 1), '/', -1) AS channel
    FROM (SELECT page_id, url AS p FROM pages)""")
def path_parts(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select(
        "page_id", paths.parent(url).alias("parent"), paths.basename(url).alias("basename"),
        paths.channel(url).alias("channel"),
    )
