"""Queries over the capture log: drift, latency, and the streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayframe.operators import drift, validate
from wayframe.operators.latency import latency_summary
from wayframe.plans.metadata import flat_tables
from wayframe.plans.proxies import _KVALUE_SPARK, table
from wayframe.plans.registry import query, r6, rounded, view
from wayframe.sources.scratch import scratch_path, settle
from wayframe.streaming import capture as streams

MIDDLE = "2024-01-16"
view("ref", f"SELECT * FROM {{capture}} WHERE ts < TIMESTAMP '{MIDDLE}'")
view("cur", f"SELECT * FROM {{capture}} WHERE ts >= TIMESTAMP '{MIDDLE}'")
_LONG = "UNPIVOT (SELECT {0} FROM {1}) ON {2} INTO NAME \"column\" VALUE value"
_AS_DOUBLE = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in drift.FEATURES)
view("both_counts", f"""
    SELECT "column", value, sum(r) AS r, sum(c) AS c FROM (
      SELECT "column", value, 1 AS r, 0 AS c FROM (
        {_LONG.format(_AS_DOUBLE, "{ref}", ", ".join(drift.FEATURES))})
      UNION ALL
      SELECT "column", value, 0, 1 FROM (
        {_LONG.format(_AS_DOUBLE, "{cur}", ", ".join(drift.FEATURES))})) GROUP BY ALL""")
view("both_curves", """
    SELECT *, sum(r) OVER w AS cum_r, sum(c) OVER w AS cum_c, lead(value) OVER w AS following,
      sum(r) OVER (PARTITION BY "column") AS n_r, sum(c) OVER (PARTITION BY "column") AS n_c,
      count(*) OVER (PARTITION BY "column") AS n_values
    FROM {both_counts} WINDOW w AS (PARTITION BY "column" ORDER BY value)""")
view("column_stats", """
    SELECT s."column", rows_ref, rows_cur, n_values, ks, area / greatest(deviation, 0.001)
      AS wasserstein, sqrt(greatest(js / 2, 0)) AS jensen_shannon,
      CASE WHEN unseen > 0 THEN 'Infinity'::DOUBLE ELSE misfit END AS chi_square
    FROM (SELECT "column", CAST(any_value(n_r) AS BIGINT) AS rows_ref,
        CAST(any_value(n_c) AS BIGINT) AS rows_cur, any_value(n_values) AS n_values,
        max(abs(cum_r / n_r - cum_c / n_c)) AS ks,
        sum(abs(cum_r / n_r - cum_c / n_c) * coalesce(following - value, 0)) AS area,
        sum(CASE WHEN r > 0 THEN r / n_r * ln((r / n_r) / ((r / n_r + c / n_c) / 2)) ELSE 0 END
          + CASE WHEN c > 0 THEN c / n_c * ln((c / n_c) / ((r / n_r + c / n_c) / 2)) ELSE 0 END)
          AS js,
        sum(CASE WHEN r > 0 THEN (c - r / n_r * n_c) ** 2 / (r / n_r * n_c) END) AS misfit,
        count(*) FILTER (r = 0) AS unseen
      FROM {both_curves} GROUP BY "column") s
    JOIN (SELECT "column", stddev_pop(value) AS deviation FROM (
        """ + _LONG.format(_AS_DOUBLE, "{ref}", ", ".join(drift.FEATURES)) + """)
      GROUP BY "column") d ON s."column" = d."column\"""")
_ROOT = "(sqrt(rows_ref * rows_cur / (rows_ref + rows_cur)) * ks)"
_KS_P = (
    f"CASE WHEN {_ROOT} < 0.2 THEN 1 ELSE least(greatest(list_sum(list_transform(range(1, 101),"
    f" lambda i: 2 * (-1) ** (i - 1) * exp(-2.0 * i * i * {_ROOT} * {_ROOT}))), 0), 1) END"
)
view("drift_scores", f"""
    SELECT "column", method, score,
      score >= 0.1 AS drift_detected
    FROM (SELECT *, CASE WHEN "column" IN ('width', 'height') THEN 'jensen_shannon'
          ELSE 'wasserstein' END AS method,
        CASE WHEN "column" IN ('width', 'height') THEN jensen_shannon ELSE wasserstein END AS score
      FROM {{column_stats}})""")
CONSTANTS = ("width", "height")


def _halves(spark, d) -> tuple[DataFrame, DataFrame]:
    capture = table(spark, d, "capture")
    boundary = F.lit(MIDDLE).cast("timestamp_ntz")
    return capture.filter(F.col("ts") < boundary), capture.filter(F.col("ts") >= boundary)


# --- drift ----------------------------------------------------------------------------


@query("A22", f"""
    SELECT "column", rows_ref, rows_cur, n_values, {r6("ks")} AS ks,
      {r6("wasserstein")} AS wasserstein, {r6("jensen_shannon")} AS jensen_shannon,
      {r6("chi_square")} AS chi_square
    FROM {{column_stats}}""")
def drift_statistics(spark, d):
    counts = drift.value_counts(*_halves(spark, d), drift.FEATURES)
    stats = drift.column_statistics(counts)
    return rounded(stats, "ks", "wasserstein", "jensen_shannon", "chi_square")


@query("A22", f"""SELECT "column", {r6("ks")} AS ks, {r6(_KS_P)} AS p_value
    FROM {{column_stats}}""")
def ks_drift(spark, d):
    stats = drift.column_statistics(drift.value_counts(*_halves(spark, d), drift.FEATURES))
    p = drift.ks_p_value(F.col("ks"), F.col("rows_ref"), F.col("rows_cur"))
    return rounded(stats.select("column", "ks", p.alias("p_value")), "ks", "p_value")


@query("A21 A22", f"""
    SELECT "column", method, {r6("score")} AS score, drift_detected FROM {{drift_scores}}""")
def column_drift(spark, d):
    return rounded(drift.column_drift(*_halves(spark, d), categorical=CONSTANTS), "score")


@query("A22", f"""
    SELECT count(*) AS n_columns, count(*) FILTER (drift_detected) AS n_drifted,
      {r6("count(*) FILTER (drift_detected) / count(*)")} AS share_drifted,
      count(*) FILTER (drift_detected) / count(*) >= 0.25 AS dataset_drift
    FROM {{drift_scores}}""")
def drift_verdict(spark, d):
    return rounded(drift.dataset_verdict(
        drift.column_drift(*_halves(spark, d), categorical=CONSTANTS)), "share_drifted")


view("type_counts", """
    SELECT k AS value, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS r,
      count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS c
    FROM (SELECT ts, list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type)
      AS k FROM events) GROUP BY k""")


@query("A22", f"""
    SELECT {r6('''sqrt(greatest(sum(
        CASE WHEN r > 0 THEN r / nr * ln((r / nr) / ((r / nr + c / nc) / 2)) ELSE 0 END
        + CASE WHEN c > 0 THEN c / nc * ln((c / nc) / ((r / nr + c / nc) / 2)) ELSE 0 END) / 2, 0))
        ''')} AS jensen_shannon,
      {r6("sum((c - r / nr * nc) ** 2 / (r / nr * nc))")} AS chi_square
    FROM (SELECT *, sum(r) OVER () AS nr, sum(c) OVER () AS nc FROM {{type_counts}})""")
def low_cardinality_drift(spark, d):
    names = F.array(*[F.lit(t) for t in ("click", "error", "purchase", "signup", "view")])
    halves = [
        half.select(F.array_position(names, F.col("model_version")).alias("kind"))
        for half in _halves(spark, d)
    ]
    stats = drift.column_statistics(drift.value_counts(*halves, ["kind"]))
    return rounded(stats.select("jensen_shannon", "chi_square"), "jensen_shannon", "chi_square")


@query("A28 P11 W6", """
    SELECT sample_data_token, channel, is_night, width, height, n_boxes,
      CAST(NULL AS DOUBLE) AS brightness
    FROM {samples} WHERE is_night
    ORDER BY md5(concat_ws('|', sample_data_token, '3')), sample_data_token LIMIT 90""")
def night_features(spark, d):
    samples = flat_tables(spark, d)[0]
    return drift.feature_table(samples, condition="night", sample_images=90, seed=3)


@query("A28", """
    SELECT sample_data_token, channel, is_night, width, height, n_boxes, brightness
    FROM {samples} LEFT JOIN (SELECT filename, max(num_lidar_pts) * 1e0 AS brightness
      FROM {boxes} JOIN {sample_data} ON sample_data_token = token GROUP BY filename)
      USING (filename) WHERE NOT is_night""")
def day_features(spark, d):
    samples = flat_tables(spark, d)[0]
    files = table(spark, d, "sample_data").select(
        F.col("token").alias("sample_data_token"), "filename"
    )
    stats = table(spark, d, "boxes").join(files, "sample_data_token").groupBy("filename").agg(
        F.max("num_lidar_pts").cast("double").alias("brightness")
    )
    return drift.feature_table(samples, stats, condition="day", sample_images=None)


@query("A23", f"""
    SELECT model_version, count(*) AS n, {r6("avg(latency_ms)")} AS mean_ms,
      {r6("quantile_cont(latency_ms, 0.5)")} AS p50_ms,
      {r6("quantile_cont(latency_ms, 0.95)")} AS p95_ms
    FROM {{capture}} GROUP BY model_version""")
def latency_percentiles(spark, d):
    summary = latency_summary(table(spark, d, "capture"), ["model_version"])
    return rounded(summary, "mean_ms", "p50_ms", "p95_ms")


# --- streams --------------------------------------------------------------------------


def _stream(spark, d, per_trigger: int | None = None) -> DataFrame:
    """The events table as a stream of capture records."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    events = reader.parquet(d)
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.lit(1600).cast("long").alias("width"), F.lit(900).cast("long").alias("height"),
        F.expr(_KVALUE_SPARK).cast("long").alias("n_boxes"),
        F.col("value").alias("brightness"), F.col("value").alias("latency_ms"),
        F.col("event_type").alias("model_version"),
    )


@query("ST2 S6", f"""
    SELECT window_start, model_version, count(*) AS n,
      {r6("avg(brightness)")} AS mean_brightness, {r6("avg(n_boxes)")} AS mean_n_boxes,
      {r6("quantile_disc(latency_ms, 0.95)")} AS p95_latency_ms
    FROM (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS window_start FROM {{capture}})
    WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM {{capture}}) - INTERVAL 10 MINUTE
    GROUP BY ALL""")
def stream_window_stats(spark, d):
    """Windows that the watermark has closed once the stream has been read."""
    counts = streams.window_counts(_stream(spark, d), "1 day", "10 minutes")
    out = scratch_path(spark, "windows")
    streams.run_to_table(counts, out, scratch_path(spark, "windows-state"))
    read = streams.window_stats(spark.read.schema(counts.schema).parquet(out))
    read = read.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    return rounded(read, "mean_brightness", "mean_n_boxes", "p95_latency_ms")


@query("ST5", """
    SELECT count(*) AS n, count(DISTINCT user_id) AS users, CAST(sum(event_id) AS BIGINT) AS total
    FROM events""")
def stream_dedup(spark, d):
    """Every record sent twice, kept once."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    once = streams.new_frames(twice, "event_id", "ts", "1 hour")
    out = scratch_path(spark, "deduplicated")
    streams.run_to_table(once, out, scratch_path(spark, "deduplicated-state"))
    return spark.read.schema(once.schema).parquet(out).agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users"),
        F.sum("event_id").alias("total"),
    )


@query("ST5 J8", """
    SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total
    FROM events GROUP BY event_type""")
def stream_append(spark, d):
    """Append the events to a store that already has the clicks, then replay them all."""
    store = scratch_path(spark, "appended")
    streams.write_frames(table(spark, d, "events").filter("event_type = 'click'"), store, "event_id", buckets=16)
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    for _ in range(2):
        events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
        job = streams.append_missing(
            events.parquet(d), store, scratch_path(spark, "appended-state"), "event_id", 16
        )
        job.start().awaitTermination()
    return streams.read_frames(spark, store).groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("total")
    )


@query("ST4", """
    SELECT count(*) AS rows, count(*) FILTER (brightness <= 0) AS not_positive,
      count(*) FILTER (brightness NOT BETWEEN 0 AND 255) AS out_of_range,
      count(*) FILTER (n_boxes < 10) AS few_boxes FROM {capture}""")
def stream_rules(spark, d):
    """Rule violations observed while the stream is written."""
    rules = [
        validate.positive("brightness"), validate.between("brightness", 0, 255),
        validate.at_least("n_boxes", 10),
    ]
    out = scratch_path(spark, "watched")
    job = streams.write_and_count(_stream(spark, d), rules, out, scratch_path(spark, "watched-state"))
    job.start().awaitTermination()
    counted = spark.read.parquet(f"{out}/violations")
    names = ("rows", "not_positive", "out_of_range", "few_boxes")
    return counted.agg(*[F.sum(c).alias(n) for c, n in zip(streams.rule_columns(rules), names)])


view("weekly_counts", """
    SELECT w, "column", value, sum(r) AS r, sum(c) AS c FROM (
      SELECT w, "column", value, 0 AS r, 1 AS c FROM (
        UNPIVOT (SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS w,
            brightness, CAST(n_boxes AS DOUBLE) AS n_boxes FROM {capture})
          ON brightness, n_boxes INTO NAME "column" VALUE value)
      UNION ALL
      SELECT w, "column", value, 1, 0 FROM (
        UNPIVOT (SELECT brightness, CAST(n_boxes AS DOUBLE) AS n_boxes FROM {ref})
          ON brightness, n_boxes INTO NAME "column" VALUE value),
        (SELECT DISTINCT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS w
          FROM {capture})) GROUP BY ALL""")
view("weekly_stats", """
    SELECT w, "column", any_value(n_r) AS rows_ref, any_value(n_c) AS rows_cur,
      max(abs(cum_r / n_r - cum_c / n_c)) AS ks,
      sum(abs(cum_r / n_r - cum_c / n_c) * coalesce(following - value, 0))
        / greatest(any_value(deviation), 0.001) AS wasserstein
    FROM (SELECT *, sum(r) OVER u AS cum_r, sum(c) OVER u AS cum_c, lead(value) OVER u AS following,
            sum(r) OVER (PARTITION BY w, "column") AS n_r,
            sum(c) OVER (PARTITION BY w, "column") AS n_c
          FROM {weekly_counts} WINDOW u AS (PARTITION BY w, "column" ORDER BY value))
    JOIN (SELECT "column", stddev_pop(value) AS deviation FROM (
        UNPIVOT (SELECT brightness, CAST(n_boxes AS DOUBLE) AS n_boxes FROM {ref})
          ON brightness, n_boxes INTO NAME "column" VALUE value) GROUP BY "column")
      USING ("column")
    GROUP BY ALL""")


@query("ST3 A22", f"""
    SELECT w AS window_start, count(*) AS n_columns, count(*) FILTER (drifted) AS n_drifted,
      count(*) FILTER (drifted) / count(*) >= 0.25 AS dataset_drift
    FROM (SELECT w, wasserstein >= 0.1 AS drifted FROM {{weekly_stats}}) GROUP BY w""")
def stream_drift(spark, d):
    """A verdict per week of the stream against the first half of the month."""
    out = scratch_path(spark, "drift")
    job = streams.drift_per_window(
        _stream(spark, d), _halves(spark, d)[0], out, scratch_path(spark, "drift-state"),
        ("brightness", "n_boxes"), "7 days",
    )
    job.start().awaitTermination()
    verdicts = streams.latest_verdicts(spark, out)
    return verdicts.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n_columns",
        "n_drifted", "dataset_drift",
    )


@query("S5 S6", f"""
    SELECT count(*) AS n, {r6("avg(brightness)")} AS mean_brightness,
      CAST(sum(n_boxes) AS BIGINT) AS boxes FROM {{capture}}""")
def capture_log_roundtrip(spark, d):
    """Write the events as a JSON-lines capture log and load it as a feature table."""
    from wayframe.sources.tables import CAPTURE_RENAMES, read_features

    path = scratch_path(spark, "capture") + ".jsonl"
    back = {v: k for k, v in CAPTURE_RENAMES.items()}
    log = table(spark, d, "capture").drop("event_id")
    log.withColumn("ts", F.col("ts").cast("timestamp")).withColumnsRenamed(back).write.json(path)
    features = settle(read_features(spark, path), "features")
    summary = features.agg(
        F.count("*").alias("n"), F.avg("brightness").alias("mean_brightness"),
        F.sum("n_boxes").alias("boxes"),
    )
    return rounded(summary, "mean_brightness")
