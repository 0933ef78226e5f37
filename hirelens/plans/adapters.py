"""Driver tables re-expressed as the reference's inputs.

``events`` becomes (a) raw queue messages of the live layer and (b) clean
events of the realtime aggregator; the same mapping is written in SQL for the
oracle. These are projections of the whole table (every row is kept).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.sources.tables import read_table

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _k(props="props"):
    return F.get_json_object(F.col(props), "$.k")


def events_as_raw_messages(events: DataFrame, job_id: Column | None = None, keep=()) -> DataFrame:
    """events -> queue messages whose value is a flat raw event (11 strings).
    job_id = 'u<user>-k<k>' so the same posting repeats (dedup has work), if
    no other is given. ``keep``: columns to carry along."""
    ts = F.date_format("ts", ISO_MICROS)
    posting = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-k"), _k())
    value = F.to_json(F.struct(
        (posting if job_id is None else job_id).alias("job_id"),
        F.lit("events").alias("source"),
        F.concat(F.lit("https://events.example.com/e/"), F.col("event_id").cast("string")).alias("source_url"),
        F.col("event_type").alias("title"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("company_name"),
        F.concat(F.col("value").cast("string"), F.lit(" triệu")).alias("salary_text"),
        F.col("event_type").alias("location_text"),
        F.concat(F.col("event_type"), F.lit(", k"), _k()).alias("skills_text"),
        F.col("props").alias("description_text"),
        ts.alias("event_ts"), ts.alias("ingest_ts")))
    return events.select(
        *keep, F.col("event_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("raw_events").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"))


def events_as_clean_messages(events: DataFrame) -> DataFrame:
    """events -> queue messages whose value is a clean event (city =
    event_type, company = user, salary = value .. 2 * value, skills =
    ['k<k>', event_type])."""
    value = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("job_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("company_name"),
        F.col("event_type").alias("city"),
        F.when(F.col("value") >= 100, F.lit("FULL_TIME")).otherwise(F.lit("PART_TIME")).alias("employment_type"),
        F.col("value").alias("salary_min"),
        (F.col("value") * 2).alias("salary_max"),
        F.array(F.concat(F.lit("k"), _k()), F.col("event_type")).alias("skills"),
        F.date_format("ts", ISO_MICROS).alias("event_ts")))
    return events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("jobs_clean").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_raw_messages(read_table(spark, sf_dir, "events"))


def clean_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_clean_messages(read_table(spark, sf_dir, "events"))


# SQL twins -----------------------------------------------------------------

EVENTS_RAW_SQL = """
e AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) || '-k' || json_extract_string(props, '$.k') AS job_id,
         ts, event_id,
         'https://events.example.com/e/' || CAST(event_id AS VARCHAR) AS source_url,
         upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS location_city,
         event_type,
         'k' || json_extract_string(props, '$.k') AS kskill,
         value
  FROM events
),
ed AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts, source_url) AS rn FROM e)
  WHERE rn = 1
)
"""

EVENTS_CLEAN_SQL = """
c AS (
  SELECT CAST(event_id AS VARCHAR) AS job_id, 'user_' || CAST(user_id AS VARCHAR) AS company_name,
         event_type AS city,
         CASE WHEN value >= 100 THEN 'FULL_TIME' ELSE 'PART_TIME' END AS employment_type,
         value AS salary_min, value * 2 AS salary_max, ts,
         ['k' || json_extract_string(props, '$.k'), event_type] AS skills
  FROM events
),
cw AS (
  SELECT c.*, time_bucket(INTERVAL '1 minute', ts) - to_minutes(CAST(r.k AS BIGINT)) AS ws
  FROM c CROSS JOIN range(0, 10) AS r(k)
)
"""
