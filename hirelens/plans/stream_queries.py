"""Queries over the stored output of real streaming runs.

``events`` become messages, delivered in slices of ten days through files in
the shared scratch folder. Each slice is one run of the streams to completion
(``availableNow``), so every slice after the first is also a restart from the
checkpoint. Deliveries are what a queue does: clicks come twice in their slice,
purchases again a slice later, errors only a slice late (beyond the watermark
but for those of its last minutes), and some messages are cut short or lack a
job id. The queries read the tables that the streams wrote.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions.agg import money_avg_sql as MA
from hirelens.operators import messages, realtime, serving
from hirelens.plans import adapters
from hirelens.plans.registry import query
from hirelens.session import scratch_path
from hirelens.sinks import keyed
from hirelens.sources.messages import read_message_files
from hirelens.sources.tables import read_table
from hirelens.streaming import aggregator, live_layer
from hirelens.streaming.runs import fresh_name

SLICE_DAYS = 10
CUT_OFF = "2024-01-15 00:00:00"


def _slice(ts: str = "ts"):
    return F.floor(F.unix_date(F.to_date(ts)) / SLICE_DAYS)


def live_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the live layer with the ``slice`` that delivers them."""
    events = read_table(spark, sf_dir, "events")
    kind = F.col("event_type")
    slices = (F.when(kind == "error", F.array(_slice() + 1))
              .when(kind == "click", F.array(_slice(), _slice()))
              .when(kind == "purchase", F.array(_slice(), _slice() + 1))
              .otherwise(F.array(_slice())))
    rows = events.withColumn("_slices", slices)
    name = F.concat(F.lit("e"), F.col("event_id").cast("string"))
    told = adapters.events_as_raw_messages(rows, F.when((kind == "view") & (F.col("value") < 2), None).otherwise(name),
                                           keep=("event_type", "_slices", F.col("value").alias("_value")))
    cut = (F.col("event_type") == "signup") & (F.col("_value") < 2)
    value = F.when(cut, F.substring("value", 1, 20)).otherwise(F.col("value"))
    return told.withColumn("value", value).withColumn("slice", F.explode("_slices")).drop("event_type", "_slices", "_value")


def _run(spark: SparkSession, deliveries: DataFrame, name: str, start) -> str:
    """Deliver slice after slice to ``start(raw, out, checkpoint)`` and wait
    for its queries; returns the folder of their outputs. Only the names of
    the slices come to the driver."""
    root = scratch_path(spark, fresh_name(name))
    source = f"{root}/source"
    for number in sorted(r[0] for r in deliveries.select("slice").distinct().collect()):
        deliveries.where(F.col("slice") == number).drop("slice").write.mode("append").parquet(source)
        for q in start(read_message_files(spark, source), f"{root}/out", f"{root}/checkpoint"):
            q.awaitTermination()
    return f"{root}/out"


@functools.cache
def _live(application: str, sf_dir: str) -> str:
    spark = SparkSession.active()
    return _run(spark, live_deliveries(spark, sf_dir), "live", lambda raw, out, checkpoint: live_layer.start(
        raw, out, checkpoint, trigger={"availableNow": True}, fold_every=2))


@functools.cache
def _closed(application: str, sf_dir: str) -> str:
    spark = SparkSession.active()
    rows = adapters.events_as_clean_messages(read_table(spark, sf_dir, "events")).withColumn("slice", _slice("timestamp"))
    return _run(spark, rows, "realtime", lambda raw, out, checkpoint: aggregator.start(
        raw, out, checkpoint, trigger={"availableNow": True}, output_mode="append"))


def _view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A speed view as stored by the live run of this session."""
    root = f"{_live(spark.sparkContext.applicationId, sf_dir)}/{name}"
    return keyed.current_view(spark, root, live_layer.VIEW_KEY)


# What the runs must have stored: late rows are those at or before the
# watermark (30 minutes behind the latest good row of the slices before).
LIVE_SQL = f"""
WITH d AS (
  SELECT *, CAST(floor((CAST(ts AS DATE) - DATE '1970-01-01') / {SLICE_DAYS}.0) AS BIGINT)
            + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS slice,
         CASE WHEN event_type = 'signup' AND value < 2 THEN 'PARSE_ERROR'
              WHEN event_type = 'view' AND value < 2 THEN 'job_id missing' END AS fault
  FROM events),
again AS (SELECT slice, ts, fault FROM d UNION ALL
          SELECT slice + 1, ts, fault FROM d WHERE event_type = 'purchase'),
tops AS (SELECT slice, max(ts) FILTER (WHERE fault IS NULL) AS top FROM again GROUP BY slice),
marks AS (SELECT slice, date_trunc('milliseconds', max(top) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING
                                                                 AND 1 PRECEDING)) - INTERVAL '30 minutes' AS mark FROM tops),
kept AS (
  SELECT d.*, upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS location_city,
         'k' || json_extract_string(props, '$.k') AS kskill
  FROM d JOIN marks USING (slice) WHERE fault IS NULL AND (mark IS NULL OR ts > mark))"""
_WINDOW_SQL = """, w AS (
  SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
         location_city, count(*) AS job_count FROM {rows} GROUP BY ALL)"""


@query("t1_stream_silver_events", LIVE_SQL + """
SELECT 'e' || CAST(event_id AS VARCHAR) AS job_id, location_city, 'User ' || CAST(user_id AS VARCHAR) AS company_name,
       event_type || '|' || kskill AS skills, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts FROM kept""")
def q_silver(spark, sf_dir):
    """Accepted once whatever was delivered again, late rows
    dropped, across restarts."""
    rows = spark.read.parquet(f"{_live(spark.sparkContext.applicationId, sf_dir)}/silver")
    return rows.select("job_id", "location_city", "company_name", F.array_join("skills", "|").alias("skills"),
                       F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_ts"))


@query("t1_stream_job_counts", LIVE_SQL + _WINDOW_SQL.format(rows="kept") + """
SELECT window_start, window_end, location_city, job_count,
       strftime(strptime(window_end, '%Y-%m-%d %H:%M:%S') + INTERVAL '7200 seconds', '%Y-%m-%d %H:%M:%S') AS expires_at FROM w""")
def q_stream_job_counts(spark, sf_dir):
    """A1, SK2, SK5, T4: the stored speed view, last write of a key wins."""
    return _view(spark, sf_dir, "job_counts_10m").select(
        "window_start", "window_end", F.col("field").alias("location_city"), F.col("value").alias("job_count"), "expires_at")


@query("t2_stream_skill_counts", LIVE_SQL + """,
s AS (SELECT ts, unnest([event_type, kskill]) AS skill FROM kept)
SELECT strftime(time_bucket(INTERVAL '10 minutes', ts) - to_minutes(CAST(10 * r.k AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(time_bucket(INTERVAL '10 minutes', ts) - to_minutes(CAST(10 * r.k AS BIGINT)) + INTERVAL '30 minutes',
                '%Y-%m-%d %H:%M:%S') AS window_end,
       skill, count(*) AS skill_count
FROM s CROSS JOIN range(0, 3) AS r(k) GROUP BY ALL""")
def q_stream_skill_counts(spark, sf_dir):
    """Sliding windows in update mode, across restarts."""
    return _view(spark, sf_dir, "skill_counts_30m").select(
        "window_start", "window_end", F.col("field").alias("skill"), F.col("value").alias("skill_count"))


@query("sk4_stream_dead_letters", LIVE_SQL + """
SELECT 'raw_events' AS original_topic, CASE fault WHEN 'PARSE_ERROR' THEN fault ELSE 'VALIDATION_ERROR' END AS error_type,
       fault AS error_message, count(*) AS n FROM d WHERE fault IS NOT NULL GROUP BY ALL""")
def q_stream_dead_letters(spark, sf_dir):
    """SK4: what the live layer set aside, by reason."""
    rows = spark.read.parquet(f"{_live(spark.sparkContext.applicationId, sf_dir)}/dead_letter")
    return rows.groupBy("original_topic", "error_type", "error_message").agg(F.count("*").alias("n"))


def _batch_counts(spark, sf_dir):
    """A1 recomputed from all good messages, late ones too."""
    told = live_deliveries(spark, sf_dir).drop("slice")
    norm = messages.normalize_events(messages.clean_events(messages.parse_messages(told, ingest_time=F.col("kafka_ts"))))
    return realtime.job_counts_10m(realtime.dedup_jobs(norm.select("job_id", "event_ts", "source_url", "location_city")))


@query("a16_stored_stream_batch_reconciliation", LIVE_SQL + ", good AS (SELECT *, upper(substr(event_type, 1, 1)) "
       "|| substr(event_type, 2) AS location_city FROM d WHERE fault IS NULL)" + _WINDOW_SQL.format(rows="kept") + """,
b AS (SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M:%S') AS window_start, location_city,
             count(*) AS job_count FROM good GROUP BY ALL)
SELECT b.window_start, b.location_city, w.job_count AS stream_job_count, b.job_count AS batch_job_count,
       coalesce(w.job_count, 0) - b.job_count AS job_count_diff
FROM b LEFT JOIN w ON w.window_start = b.window_start AND w.location_city = b.location_city""")
def q_a16_stored(spark, sf_dir):
    """A16 / J3 on the stored speed view: it differs from a batch recompute by
    the late rows, and by nothing else."""
    stored = q_stream_job_counts(spark, sf_dir)
    return serving.reconcile(stored, _batch_counts(spark, sf_dir), ["window_start", "location_city"], "job_count")


@query("u1_stored_batch_speed_merge", LIVE_SQL + ", good AS (SELECT *, upper(substr(event_type, 1, 1)) "
       "|| substr(event_type, 2) AS location_city FROM d WHERE fault IS NULL)" + _WINDOW_SQL.format(rows="kept")
       + _WINDOW_SQL.format(rows="good").replace(", w AS", ", b AS") + f"""
SELECT window_start, window_end, location_city, job_count, 'batch' AS layer FROM b WHERE window_start < '{CUT_OFF}'
UNION ALL SELECT window_start, window_end, location_city, job_count, 'speed' FROM w WHERE window_start >= '{CUT_OFF}'""")
def q_u1_stored(spark, sf_dir):
    """Batch windows before the cut-off, stored speed windows from it on."""
    stored = q_stream_job_counts(spark, sf_dir).drop("expires_at")
    return serving.merge_layers(_batch_counts(spark, sf_dir), stored, "window_start", CUT_OFF)


# A window is closed once the watermark (10 minutes behind the latest event) has reached its end.
_CLOSED_SQL = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '10 minutes' FROM events)"
_BUCKET_SQL = """strftime(ws, '%Y-%m-%dT%H:%M:00Z') AS time_bucket,
       strftime(ws + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS window_end"""


def _stored(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    root = f"{_closed(spark.sparkContext.applicationId, sf_dir)}/{table}"
    return keyed.current_view(spark, root, aggregator.KEYS[table]).drop("updated_at", "batch_id")


@query("t5_stream_closed_job_counts", "WITH " + adapters.EVENTS_CLEAN_SQL + f"""
SELECT {_BUCKET_SQL}, city, employment_type, count(job_id) AS job_count, count(DISTINCT company_name) AS distinct_company_count
FROM cw WHERE ws + INTERVAL '10 minutes' <= {_CLOSED_SQL} GROUP BY ALL""")
def q_closed_jobs(spark, sf_dir):
    """Chained aggregates in append mode, exact distinct counts."""
    return _stored(spark, sf_dir, "realtime_job_counts_10m").select(
        "time_bucket", "window_end", "city", "employment_type", "job_count", "distinct_company_count")


@query("t5_stream_closed_skill_counts", "WITH " + adapters.EVENTS_CLEAN_SQL + f""",
cs AS (SELECT job_id, company_name, city, salary_min, salary_max, ws, unnest(skills) AS skill FROM cw)
SELECT {_BUCKET_SQL}, skill, city, count(job_id) AS job_count, count(DISTINCT company_name) AS distinct_company_count,
       {MA('salary_min')} AS avg_salary_min, {MA('salary_max')} AS avg_salary_max
FROM cs WHERE skill IS NOT NULL AND skill <> '' AND ws + INTERVAL '10 minutes' <= {_CLOSED_SQL} GROUP BY ALL""")
def q_closed_skills(spark, sf_dir):
    """As above, with money averages."""
    return _stored(spark, sf_dir, "realtime_skill_counts").select(
        "time_bucket", "window_end", "skill", "city", "job_count", "distinct_company_count", "avg_salary_min",
        "avg_salary_max")


@query("a16_closed_windows_reconciliation", "WITH " + adapters.EVENTS_CLEAN_SQL + f"""
SELECT strftime(ws, '%Y-%m-%dT%H:%M:00Z') AS time_bucket, city, employment_type, count(job_id) AS stream_job_count,
       count(job_id) AS batch_job_count, CAST(0 AS BIGINT) AS job_count_diff
FROM cw WHERE ws + INTERVAL '10 minutes' <= {_CLOSED_SQL} GROUP BY ALL""")
def q_a16_closed(spark, sf_dir):
    """A16 without late rows: the stored closed windows equal the batch plan's."""
    batch = realtime.job_counts_sliding(messages.parse_clean(adapters.clean_messages(spark, sf_dir)))
    stored = _stored(spark, sf_dir, "realtime_job_counts_10m")
    closed = batch.where(F.col("window_end") <= stored.select(F.max("window_end")).scalar())
    return serving.reconcile(stored, closed, ["time_bucket", "city", "employment_type"], "job_count")
