"""Registered queries: each runs an operator over whole driver tables and has,
where SQL can express it, an oracle query for DuckDB with the same columns.

``QUERIES[name] = (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.functions import constants as K
from hirelens.functions.agg import money_avg_sql as MA
from hirelens.functions import enums, html, salary, text, urls
from hirelens.operators import gold, keys, messages, realtime, serving
from hirelens.plans import adapters, jobs_view
from hirelens.plans.jobs_view import with_j
from hirelens.plans.registry import QUERIES, query
from hirelens.session import scratch_path
from hirelens.sinks.commits import remove
from hirelens.sources.tables import read_table
from hirelens.streaming.runs import fresh_name

def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


STRIP_SQL = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _strip(x: str) -> str:
    return STRIP_SQL.format(x=x)


# =========================================================== live layer (A)

def _stream_a(spark, sf_dir, dedup=True, cols=None):
    """Live-layer input: messages -> V1 -> V5 -> P4 (-> K7 batch dedup).
    ``cols``: the columns the consumer needs; projecting them before the
    dedup keeps the shuffle narrow (a struct inside an aggregate is not
    pruned by the optimizer)."""
    msgs = adapters.raw_messages(spark, sf_dir)
    parsed = messages.parse_messages(msgs, ingest_time=F.col("kafka_ts"))
    norm = messages.normalize_events(messages.clean_events(parsed))
    if cols is not None:
        norm = norm.select("job_id", "event_ts", "source_url", *cols)
    return realtime.dedup_jobs(norm) if dedup else norm


@query("v1_parse_props", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.k') IS NOT NULL AS is_parse_ok
FROM events""")
def q_v1_parse_props(spark, sf_dir):
    from pyspark.sql import types as T
    ev = read_table(spark, sf_dir, "events")
    p = messages.parse_json(F.col("props"), T.StructType([T.StructField("k", T.IntegerType())]))
    return ev.select("event_id", p.alias("p")).select(
        "event_id", F.col("p.k").alias("k"),
        (F.col("p").isNotNull() & F.col(f"p.{messages.CORRUPT}").isNull() & F.col("p.k").isNotNull())
        .alias("is_parse_ok"))


@query("p4_normalized_events", """
SELECT 'u' || CAST(user_id AS VARCHAR) || '-k' || json_extract_string(props, '$.k') AS job_id,
       'events' AS source,
       upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS location_city,
       'User ' || CAST(user_id AS VARCHAR) AS company_name,
       CAST(regexp_extract(CAST(value AS VARCHAR), '(\\d+)', 1) AS BIGINT) * 1000000 AS salary_min,
       coalesce(CAST(NULLIF(regexp_extract(CAST(value AS VARCHAR) || ' triệu', '(\\d+)\\D+(\\d+)', 2), '') AS BIGINT),
                CAST(regexp_extract(CAST(value AS VARCHAR), '(\\d+)', 1) AS BIGINT)) * 1000000 AS salary_max,
       event_type || '|k' || json_extract_string(props, '$.k') AS skills,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts
FROM events""")
def q_p4_normalized_events(spark, sf_dir):
    n = _stream_a(spark, sf_dir, dedup=False)
    return n.select("job_id", "source", "location_city", "company_name", "salary_min", "salary_max",
                    F.array_join("skills", "|").alias("skills"),
                    F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_ts"))


A1_SQL = "WITH " + adapters.EVENTS_RAW_SQL + """
SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
       location_city, count(*) AS job_count
FROM ed GROUP BY ALL"""


@query("a1_job_counts_10m", A1_SQL)
def q_a1(spark, sf_dir):
    return realtime.job_counts_10m(_stream_a(spark, sf_dir, cols=["location_city"]))


A2_CTE = "WITH " + adapters.EVENTS_RAW_SQL + """,
sk AS (SELECT ts, unnest([event_type, kskill]) AS skill FROM ed),
a2 AS (
  SELECT strftime(time_bucket(INTERVAL '10 minutes', ts) - to_minutes(CAST(10 * r.k AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(time_bucket(INTERVAL '10 minutes', ts) - to_minutes(CAST(10 * r.k AS BIGINT)) + INTERVAL '30 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
         skill, count(*) AS skill_count
  FROM sk CROSS JOIN range(0, 3) AS r(k) GROUP BY ALL)
"""


@query("a2_skill_counts_30m", A2_CTE + "SELECT * FROM a2")
def q_a2(spark, sf_dir):
    return realtime.skill_counts_30m(_stream_a(spark, sf_dir, cols=["skills"]))


@query("l1_top_skills_latest_window", A2_CTE + """
SELECT window_start, window_end, skill, skill_count FROM a2
WHERE window_end = (SELECT max(window_end) FROM a2)
ORDER BY skill_count DESC, skill LIMIT 10""")
def q_l1(spark, sf_dir):
    return serving.top_n_latest(realtime.skill_counts_30m(_stream_a(spark, sf_dir, cols=["skills"])),
                                value="skill_count", field="skill", n=10)


A1_CTE = "WITH " + adapters.EVENTS_RAW_SQL + """,
a1 AS (SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
              strftime(time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
              location_city, count(*) AS job_count
       FROM ed GROUP BY ALL)
"""


@query("l2_latest_job_counts_window", A1_CTE + "SELECT * FROM a1 WHERE window_end = (SELECT max(window_end) FROM a1)")
def q_l2(spark, sf_dir):
    return serving.latest_window(realtime.job_counts_10m(_stream_a(spark, sf_dir, cols=["location_city"])))


@query("sk5_speed_view_rows", "WITH " + adapters.EVENTS_RAW_SQL + """,
a1 AS (SELECT time_bucket(INTERVAL '10 minutes', ts) AS ws, INTERVAL '10 minutes' AS len, location_city AS field,
              count(*) AS value FROM ed GROUP BY ALL),
sk AS (SELECT ts, unnest([event_type, kskill]) AS skill FROM ed),
a2 AS (SELECT time_bucket(INTERVAL '10 minutes', ts) - to_minutes(CAST(10 * r.k AS BIGINT)) AS ws,
              INTERVAL '30 minutes' AS len, skill AS field, count(*) AS value
       FROM sk CROSS JOIN range(0, 3) AS r(k) GROUP BY ALL)
SELECT 'job_counts_10m' AS view, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(ws + len, '%Y-%m-%d %H:%M:%S') AS window_end, field, value,
       strftime(ws + len + INTERVAL '7200 seconds', '%Y-%m-%d %H:%M:%S') AS expires_at FROM a1
UNION ALL
SELECT 'skill_counts_30m', strftime(ws, '%Y-%m-%d %H:%M:%S'), strftime(ws + len, '%Y-%m-%d %H:%M:%S'), field, value,
       strftime(ws + len + INTERVAL '7200 seconds', '%Y-%m-%d %H:%M:%S') FROM a2""")
def q_sk5(spark, sf_dir):
    from hirelens.sinks import keyed
    norm = _stream_a(spark, sf_dir, cols=["location_city", "skills"])
    a1 = keyed.speed_view_rows(realtime.job_counts_10m(norm), "job_counts_10m", "location_city", "job_count")
    a2 = keyed.speed_view_rows(realtime.skill_counts_30m(norm), "skill_counts_30m", "skill", "skill_count")
    return a1.unionByName(a2)


@query("a16_stream_batch_reconciliation", "WITH " + adapters.EVENTS_RAW_SQL + """,
s AS (SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M:%S') AS window_start, location_city,
             count(*) AS job_count FROM ed GROUP BY ALL),
b AS (SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M:%S') AS window_start, location_city,
             count(*) AS job_count FROM e GROUP BY ALL)
SELECT coalesce(s.window_start, b.window_start) AS window_start,
       coalesce(s.location_city, b.location_city) AS location_city,
       s.job_count AS stream_job_count, b.job_count AS batch_job_count,
       coalesce(s.job_count, 0) - coalesce(b.job_count, 0) AS job_count_diff
FROM s FULL OUTER JOIN b ON s.window_start = b.window_start AND s.location_city = b.location_city""")
def q_a16(spark, sf_dir):
    stream_side = realtime.job_counts_10m(_stream_a(spark, sf_dir, cols=["location_city"]))
    batch_side = realtime.job_counts_10m(_stream_a(spark, sf_dir, dedup=False, cols=["location_city"]))
    return serving.reconcile(stream_side, batch_side, ["window_start", "location_city"], "job_count")


@query("u1_batch_speed_merge", "WITH " + adapters.EVENTS_RAW_SQL + """,
b AS (SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
             strftime(time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
             location_city, count(*) AS job_count FROM e GROUP BY ALL),
s AS (SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
             strftime(time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
             location_city, count(*) AS job_count FROM ed GROUP BY ALL)
SELECT window_start, window_end, location_city, job_count, 'batch' AS layer FROM b WHERE window_start < '2024-01-15 00:00:00'
UNION ALL
SELECT window_start, window_end, location_city, job_count, 'speed' AS layer FROM s WHERE window_start >= '2024-01-15 00:00:00'""")
def q_u1(spark, sf_dir):
    batch_side = realtime.job_counts_10m(_stream_a(spark, sf_dir, dedup=False, cols=["location_city"]))
    speed_side = realtime.job_counts_10m(_stream_a(spark, sf_dir, cols=["location_city"]))
    return serving.merge_layers(batch_side, speed_side, "window_start", "2024-01-15 00:00:00")


# ====================================================== realtime aggregator (C)

def _clean(spark, sf_dir):
    return messages.parse_clean(adapters.clean_messages(spark, sf_dir))


@query("a3_job_counts_sliding", "WITH " + adapters.EVENTS_CLEAN_SQL + """
SELECT strftime(ws, '%Y-%m-%dT%H:%M:00Z') AS time_bucket,
       strftime(ws + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
       city, employment_type, count(job_id) AS job_count,
       count(DISTINCT company_name) AS distinct_company_count
FROM cw GROUP BY ALL""")
def q_a3(spark, sf_dir):
    return realtime.job_counts_sliding(_clean(spark, sf_dir))


@query("a4_skill_counts_sliding", "WITH " + adapters.EVENTS_CLEAN_SQL + """,
cs AS (SELECT job_id, company_name, city, salary_min, salary_max, ws, unnest(skills) AS skill FROM cw)
SELECT strftime(ws, '%Y-%m-%dT%H:%M:00Z') AS time_bucket,
       strftime(ws + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
       skill, city, count(job_id) AS job_count,
       count(DISTINCT company_name) AS distinct_company_count,
       """ + MA('salary_min') + """ AS avg_salary_min, """ + MA('salary_max') + """ AS avg_salary_max
FROM cs WHERE skill IS NOT NULL AND skill <> '' GROUP BY ALL""")
def q_a4(spark, sf_dir):
    return realtime.skill_counts_sliding(_clean(spark, sf_dir))


# ================================================================ gold over J

@query("a6_job_facts_daily", with_j("""
SELECT strftime(posting_date, '%Y-%m-%d') AS date_key, source, city, category_level_1, category_level_2,
       category_level_3, level_normalized, employment_type,
       count(*) AS job_count, count(DISTINCT company_name) AS distinct_company_count,
       """ + MA('salary_min') + """ AS avg_salary_min, """ + MA('salary_max') + """ AS avg_salary_max,
       round(median(salary_min), 4) AS median_salary_min, round(median(salary_max), 4) AS median_salary_max,
       count(*) FILTER (WHERE english_required) / count(*) AS english_required_ratio,
       count(*) FILTER (WHERE has_benefits) / count(*) AS benefit_coverage_ratio
FROM jl GROUP BY ALL"""))
def q_a6(spark, sf_dir):
    return gold.job_facts_daily(jobs_view.jobs_latest_stored(
        spark, sf_dir, scratch_path(spark, fresh_name("latest")), "source", "company_name", "city", "category_level_1",
        "category_level_2", "category_level_3", "level_normalized", "employment_type", "salary_min", "salary_max",
        "posting_date", "english_required", "has_benefits"))


SKILLS_SQL = """,
jx AS (SELECT *, unnest(list_distinct(skills)) AS skill FROM jl),
jxs AS (SELECT * FROM jx WHERE skill IS NOT NULL AND skill <> '')
"""


@query("a7_skill_counts_daily", with_j(SKILLS_SQL + """,
g AS (SELECT strftime(posting_date, '%Y-%m-%d') AS date_key, source, skill, city, category_level_3,
             count(*) AS job_count, count(DISTINCT company_name) AS distinct_company_count,
             """ + MA('salary_min') + """ AS avg_salary_min, """ + MA('salary_max') + """ AS avg_salary_max
      FROM jxs GROUP BY ALL)
SELECT *, CAST(rank() OVER (PARTITION BY date_key, source ORDER BY job_count DESC) AS INTEGER) AS skill_rank_in_day,
          CAST(rank() OVER (PARTITION BY date_key, source, city ORDER BY job_count DESC) AS INTEGER) AS skill_rank_in_city
FROM g"""))
def q_a7(spark, sf_dir):
    path = scratch_path(spark, fresh_name("latest"))
    counts = gold.skill_counts_daily(jobs_view.jobs_latest_stored(
        spark, sf_dir, path, "source", "company_name", "city", "category_level_3", "skills", "salary_min", "salary_max", "posting_date"))
    remove(spark, path)     # the counts are stored
    return counts


@query("a8_salary_stats_by_skill_month", with_j(SKILLS_SQL + """
SELECT strftime(posting_date, '%Y-%m') AS month_key, skill, city, category_level_3,
       count(*) AS job_count,
       """ + MA('salary_min') + """ AS avg_salary_min, """ + MA('salary_max') + """ AS avg_salary_max,
       round(median(salary_min), 4) AS median_salary_min, round(median(salary_max), 4) AS median_salary_max,
       round(quantile_cont(salary_min, 0.25), 4) AS p25_salary_min,
       round(quantile_cont(salary_max, 0.75), 4) AS p75_salary_max
FROM jxs GROUP BY ALL"""))
def q_a8(spark, sf_dir):
    return gold.salary_stats_by_skill_month(jobs_view.jobs_latest(spark, sf_dir))


@query("a9_company_hiring_by_month", with_j(""",
g AS (SELECT strftime(posting_date, '%Y-%m') AS month_key, company_name, city,
             count(*) AS job_count, count(DISTINCT job_title) AS distinct_job_title_count,
             """ + MA('salary_min') + """ AS avg_salary_min, """ + MA('salary_max') + """ AS avg_salary_max
      FROM jl GROUP BY ALL)
SELECT *, CAST(rank() OVER (PARTITION BY month_key, city ORDER BY job_count DESC) AS INTEGER) AS hiring_rank_in_city
FROM g"""))
def q_a9(spark, sf_dir):
    return gold.company_hiring_by_month(jobs_view.jobs_latest(spark, sf_dir))


@query("a10_skill_cooccurrence_weekly", with_j(""",
wk AS (SELECT job_id, strftime(posting_date, '%G-W%V') AS week_key, skills FROM jl),
js AS (SELECT DISTINCT job_id, week_key, s AS skill FROM (SELECT job_id, week_key, unnest(skills) AS s FROM wk)
       WHERE s IS NOT NULL AND s <> ''),
pairs AS (SELECT a.week_key, a.skill AS skill_a, b.skill AS skill_b, count(*) AS cooccurrence_count
          FROM js a JOIN js b ON a.job_id = b.job_id AND a.skill < b.skill GROUP BY ALL),
marg AS (SELECT week_key, skill, count(*) AS n FROM js GROUP BY ALL),
weeks AS (SELECT week_key, count(*) AS n_week FROM wk GROUP BY ALL)
SELECT p.week_key, p.skill_a, p.skill_b, p.cooccurrence_count,
       w.n_week * p.cooccurrence_count / (ma.n * mb.n) AS lift_score,
       p.cooccurrence_count / (ma.n + mb.n - p.cooccurrence_count) AS jaccard_score
FROM pairs p JOIN marg ma ON p.week_key = ma.week_key AND p.skill_a = ma.skill
JOIN marg mb ON p.week_key = mb.week_key AND p.skill_b = mb.skill
JOIN weeks w ON p.week_key = w.week_key"""))
def q_a10(spark, sf_dir):
    return gold.skill_cooccurrence_weekly(jobs_view.jobs_latest(spark, sf_dir))


@query("w2_skill_rank_overall", with_j(SKILLS_SQL + """,
bc AS (SELECT skill, city, count(*) AS skill_job_count_city FROM jxs GROUP BY ALL),
ov AS (SELECT skill, count(*) AS skill_job_count, count(DISTINCT company_name) AS skill_distinct_company_count
       FROM jxs GROUP BY ALL)
SELECT bc.skill, bc.city, bc.skill_job_count_city,
       CAST(rank() OVER (PARTITION BY bc.city ORDER BY bc.skill_job_count_city DESC) AS INTEGER) AS skill_rank_by_city,
       ov.skill_job_count, ov.skill_distinct_company_count,
       CAST(ov.rk AS INTEGER) AS skill_rank_overall
FROM bc JOIN (SELECT *, rank() OVER (ORDER BY skill_job_count DESC) AS rk FROM ov) ov ON bc.skill = ov.skill"""))
def q_w2(spark, sf_dir):
    return gold.skill_rank_overall(jobs_view.jobs_latest(spark, sf_dir))


@query("w3_demand_trend_city", with_j(""",
d AS (SELECT city, posting_date, count(*) AS job_count FROM jl GROUP BY ALL),
f AS (SELECT city, strftime(posting_date, '%Y-%m-%d') AS date_key, job_count,
        CAST(coalesce(sum(job_count) OVER (PARTITION BY city ORDER BY posting_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 0) AS BIGINT) AS jobs_7d,
        CAST(coalesce(sum(job_count) OVER (PARTITION BY city ORDER BY posting_date RANGE BETWEEN INTERVAL 13 DAYS PRECEDING AND INTERVAL 7 DAYS PRECEDING), 0) AS BIGINT) AS jobs_prev_7d,
        CAST(coalesce(sum(job_count) OVER (PARTITION BY city ORDER BY posting_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW), 0) AS BIGINT) AS jobs_30d,
        CAST(coalesce(sum(job_count) OVER (PARTITION BY city ORDER BY posting_date RANGE BETWEEN INTERVAL 59 DAYS PRECEDING AND INTERVAL 30 DAYS PRECEDING), 0) AS BIGINT) AS jobs_prev_30d
      FROM d)
SELECT *, CASE WHEN jobs_prev_7d = 0 THEN NULL ELSE jobs_7d / jobs_prev_7d - 1.0 END AS demand_trend_7d,
          CASE WHEN jobs_prev_30d = 0 THEN NULL ELSE jobs_30d / jobs_prev_30d - 1.0 END AS demand_trend_30d
FROM f"""))
def q_w3(spark, sf_dir):
    return gold.demand_trend(jobs_view.jobs_latest(spark, sf_dir), "city")


@query("w3_skill_trend", with_j(""",
e AS (SELECT unnest(list_distinct(skills)) AS skill, posting_date FROM jl),
d AS (SELECT skill, posting_date, count(*) AS job_count FROM e WHERE skill <> '' GROUP BY ALL),
f AS (SELECT skill, strftime(posting_date, '%Y-%m-%d') AS date_key, job_count,
        CAST(coalesce(sum(job_count) OVER (PARTITION BY skill ORDER BY posting_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 0) AS BIGINT) AS jobs_7d,
        CAST(coalesce(sum(job_count) OVER (PARTITION BY skill ORDER BY posting_date RANGE BETWEEN INTERVAL 13 DAYS PRECEDING AND INTERVAL 7 DAYS PRECEDING), 0) AS BIGINT) AS jobs_prev_7d,
        CAST(coalesce(sum(job_count) OVER (PARTITION BY skill ORDER BY posting_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW), 0) AS BIGINT) AS jobs_30d,
        CAST(coalesce(sum(job_count) OVER (PARTITION BY skill ORDER BY posting_date RANGE BETWEEN INTERVAL 59 DAYS PRECEDING AND INTERVAL 30 DAYS PRECEDING), 0) AS BIGINT) AS jobs_prev_30d
      FROM d)
SELECT *, CASE WHEN jobs_prev_7d = 0 THEN NULL ELSE jobs_7d / jobs_prev_7d - 1.0 END AS demand_trend_7d,
          CASE WHEN jobs_prev_30d = 0 THEN NULL ELSE jobs_30d / jobs_prev_30d - 1.0 END AS demand_trend_30d
FROM f"""))
def q_w3_skills(spark, sf_dir):
    return gold.skill_trend(jobs_view.jobs_latest(spark, sf_dir))


@query("a12_version_activity", with_j("""
SELECT strftime(posting_date, '%Y-%m-%d') AS date_key, count(*) AS job_count,
       CAST(count(*) FILTER (WHERE record_version = 1) AS BIGINT) AS new_job_count,
       CAST(count(*) FILTER (WHERE record_version > 1) AS BIGINT) AS updated_job_count,
       CAST(count(*) FILTER (WHERE status = 'O') AS BIGINT) AS active_job_count,
       count(*) FILTER (WHERE record_version = 1) / count(*) AS new_job_ratio,
       count(*) FILTER (WHERE record_version > 1) / count(*) AS updated_job_ratio
FROM jl GROUP BY ALL"""))
def q_a12(spark, sf_dir):
    return gold.version_activity(jobs_view.jobs_latest(spark, sf_dir))


@query("a14_experience_mix", with_j(""",
b AS (SELECT *, CASE WHEN experience_months_min IS NULL THEN 'unknown' WHEN experience_months_min < 24 THEN 'junior'
                     WHEN experience_months_min < 60 THEN 'mid' ELSE 'senior' END AS bucket FROM jl)
SELECT city, count(*) AS job_count,
       CAST(count(*) FILTER (WHERE bucket = 'junior') AS BIGINT) AS junior_job_count,
       CAST(count(*) FILTER (WHERE bucket = 'mid') AS BIGINT) AS mid_job_count,
       CAST(count(*) FILTER (WHERE bucket = 'senior') AS BIGINT) AS senior_job_count,
       count(*) FILTER (WHERE bucket = 'junior') / count(*) AS junior_ratio,
       count(*) FILTER (WHERE bucket = 'mid') / count(*) AS mid_ratio,
       count(*) FILTER (WHERE bucket = 'senior') / count(*) AS senior_ratio,
       count(*) FILTER (WHERE english_required) / count(*) AS english_required_ratio
FROM b GROUP BY ALL"""))
def q_a14(spark, sf_dir):
    return gold.experience_mix(jobs_view.jobs_latest(spark, sf_dir))


@query("a15_company_hiring_intensity", with_j(""",
g AS (SELECT strftime(posting_date, '%Y-%m') AS month_key, city, company_name, count(*) AS company_job_count
      FROM jl GROUP BY ALL)
SELECT *, CAST(sum(company_job_count) OVER (PARTITION BY month_key, city) AS BIGINT) AS city_month_job_count,
       company_job_count / sum(company_job_count) OVER (PARTITION BY month_key, city) AS company_hiring_intensity
FROM g"""))
def q_a15(spark, sf_dir):
    return gold.company_hiring_intensity(jobs_view.jobs_latest(spark, sf_dir))


@query("a11_coverage_metrics", with_j("""
SELECT city, count(*) AS job_count,
       count(*) FILTER (WHERE salary_min IS NOT NULL) / count(*) AS salary_disclosed_ratio,
       count(*) FILTER (WHERE company_name IS NOT NULL AND company_name <> '') / count(*) AS company_coverage,
       count(*) FILTER (WHERE city IS NOT NULL) / count(*) AS location_parse_rate
FROM jl GROUP BY ALL"""))
def q_a11(spark, sf_dir):
    return gold.coverage_metrics(jobs_view.jobs_latest(spark, sf_dir))


@query("a5_verification_counts", with_j("""
SELECT 'J' AS dataset, city, count(*) AS row_count FROM j GROUP BY ALL
UNION ALL SELECT 'J_latest', city, count(*) FROM jl GROUP BY ALL"""))
def q_a5(spark, sf_dir):
    j = jobs_view.jobs(spark, sf_dir).groupBy("city").agg(F.count(F.lit(1)).alias("row_count"))
    jl = jobs_view.jobs_latest(spark, sf_dir).groupBy("city").agg(F.count(F.lit(1)).alias("row_count"))
    return j.select(F.lit("J").alias("dataset"), "city", "row_count").unionByName(
        jl.select(F.lit("J_latest").alias("dataset"), "city", "row_count"))


# ========================================================= keys and versions

@query("k4_bronze_dedup", with_j("""
SELECT job_id, hash_content, CAST(ingest_ts AS DATE) AS ingest_date,
       arg_min(ingest_ts, (ingest_ts, l_partkey, l_suppkey, l_extendedprice, l_quantity)) AS ingest_ts,
       arg_min(l_partkey, (ingest_ts, l_partkey, l_suppkey, l_extendedprice, l_quantity)) AS l_partkey,
       count(*) AS duplicate_count
FROM j GROUP BY ALL"""))
def q_k4(spark, sf_dir):
    j = jobs_view.jobs_narrow(spark, sf_dir).withColumn("ingest_date", F.to_date("ingest_ts")) \
        .select("posting", "content", "ingest_date", "ingest_ts", "l_partkey", "l_suppkey",
                "l_extendedprice", "l_quantity")
    d = keys.bronze_dedup(j, key=("posting", "content", "ingest_date"), order=jobs_view.ORDER_COLS)
    return jobs_view.named(d).select("job_id", "hash_content", "ingest_date", "ingest_ts", "l_partkey", "duplicate_count")


@query("k5_record_versions", with_j("""
SELECT job_id, ingest_ts, l_partkey, l_suppkey, hash_content, record_version, is_latest FROM jv"""))
def q_k5(spark, sf_dir):
    return jobs_view.jobs_versioned(spark, sf_dir).select(
        "job_id", "ingest_ts", "l_partkey", "l_suppkey", "hash_content", "record_version", "is_latest")


@query("k6_latest_snapshot", with_j("""
SELECT job_id, record_version, ingest_ts, hash_content, company_name, city, salary_min FROM jl"""))
def q_k6(spark, sf_dir):
    # By the key that the versions are dealt by, and without the columns that no
    # one asks for: the snapshot needs no shuffle and no sort of its own.
    key, order = ["l_orderkey", "l_linenumber"], ("record_version",) + jobs_view.ORDER_COLS
    v = jobs_view.jobs_numbered(spark, sf_dir).select(*key, "_content", *order, "company_name", "city", "salary_min")
    # Rows without a line number have no job_id: together they are one posting.
    nameless = v.where("l_linenumber IS NULL").withColumn("l_orderkey", F.lit(None).cast("bigint"))
    snap = keys.latest_snapshot(v.where("l_linenumber IS NOT NULL"), key, order).unionByName(
        keys.latest_snapshot(nameless, key, order))
    return jobs_view.hashed(snap).select("job_id", "record_version", "ingest_ts", "hash_content", "company_name", "city", "salary_min")


K8_SQL = with_j(""",
old AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY record_version DESC,
          ingest_ts DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) rn
        FROM jv WHERE ingest_ts < TIMESTAMP '1998-01-01') WHERE rn = 1),
new AS (SELECT * FROM jv WHERE ingest_ts >= TIMESTAMP '1998-01-01'),
u AS (SELECT * FROM old UNION ALL SELECT * FROM new),
m AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY record_version DESC,
          ingest_ts DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) rn FROM u) WHERE rn = 1)
SELECT job_id, record_version, ingest_ts, hash_content FROM m""")


@query("k8_upsert_merge", K8_SQL)
def q_k8(spark, sf_dir):
    order = ("record_version",) + jobs_view.ORDER_COLS
    # project once before the split: both branches then share one plan (and
    # one exchange) instead of each recomputing the joins
    v = jobs_view.jobs_versioned(spark, sf_dir, narrow=True).select("posting", "content", *order)
    cutoff = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    old = keys.latest_snapshot(v.filter(F.col("ingest_ts") < cutoff), "posting", order)
    new = v.filter(F.col("ingest_ts") >= cutoff)
    return jobs_view.named(keys.upsert_merge(old, new, "posting", order)).select("job_id", "record_version", "ingest_ts", "hash_content")


@query("k9_deletion_flag_status", with_j("""
SELECT job_id, CAST(posting_date + INTERVAL 30 DAY AS TIMESTAMP) AS valid_through_ts,
       coalesce(CAST(posting_date + INTERVAL 30 DAY AS TIMESTAMP) < TIMESTAMP '1998-06-01', false) AS is_deleted,
       CASE WHEN CAST(posting_date + INTERVAL 30 DAY AS TIMESTAMP) >= ingest_ts THEN 'active' ELSE 'expired' END AS status
FROM jl"""))
def q_k9(spark, sf_dir):
    jl = jobs_view.jobs_latest(spark, sf_dir)
    vt = F.date_add("posting_date", 30).cast("timestamp_ntz")
    return jl.select("job_id", vt.alias("valid_through_ts"),
                     keys.deletion_flag(vt, "1998-06-01 00:00:00").alias("is_deleted"),
                     enums.posting_status(vt, F.col("ingest_ts")).alias("status"))


@query("j4_new_vs_known_postings", with_j(""",
old AS (SELECT DISTINCT job_id FROM j WHERE ingest_ts < TIMESTAMP '1998-01-01'),
new AS (SELECT * FROM j WHERE ingest_ts >= TIMESTAMP '1998-01-01')
SELECT strftime(ingest_ts, '%Y-%m') AS month_key,
       CAST(count(*) FILTER (WHERE job_id NOT IN (SELECT job_id FROM old)) AS BIGINT) AS new_posting_events,
       CAST(count(*) FILTER (WHERE job_id IN (SELECT job_id FROM old)) AS BIGINT) AS known_posting_events
FROM new GROUP BY ALL"""))
def q_j4(spark, sf_dir):
    j = jobs_view.jobs(spark, sf_dir)
    cutoff = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    old = j.filter(F.col("ingest_ts") < cutoff).select("job_id")
    new = j.filter(F.col("ingest_ts") >= cutoff).withColumn("month_key", enums.month_key("ingest_ts"))
    return serving.new_vs_known(new, old, "job_id", "month_key")


@query("l3_search_facets", with_j("""
SELECT city, count(*) AS job_count, """ + MA('salary_min') + """ AS avg_salary_min
FROM jl WHERE list_contains(skills, 'economy') AND salary_min BETWEEN 20000 AND 60000
  AND posting_date >= DATE '1996-01-01'
GROUP BY ALL"""))
def q_l3(spark, sf_dir):
    return serving.search_facets(jobs_view.jobs_latest(spark, sf_dir), skill="economy",
                                 salary_range=(20000, 60000), since="1996-01-01", facet="city")


@query("v8_layer_not_null_rules", with_j("""
SELECT 'job_id_not_null' AS rule, CAST(count(*) FILTER (WHERE job_id IS NULL) AS BIGINT) AS violations FROM jl
UNION ALL SELECT 'hash_content_not_null', CAST(count(*) FILTER (WHERE hash_content IS NULL) AS BIGINT) FROM jl
UNION ALL SELECT 'ingest_ts_not_null', CAST(count(*) FILTER (WHERE ingest_ts IS NULL) AS BIGINT) FROM jl
UNION ALL SELECT 'source_not_null', CAST(count(*) FILTER (WHERE source IS NULL) AS BIGINT) FROM jl
UNION ALL SELECT 'no_noise_skill', CAST(count(*) FILTER (WHERE len(list_filter(skills, lambda x: lower(x) IN (""" +
    _sql_list(K.SKILL_NOISE) + """))) > 0) AS BIGINT) FROM jl"""))
def q_v8(spark, sf_dir):
    from hirelens.operators import quality
    return quality.not_null_rules(jobs_view.jobs_latest(spark, sf_dir),
                                  ["job_id", "hash_content", "ingest_ts", "source"])


# ================================================================ text rules

@query("x1_clean_text_documents", """
SELECT doc_id, t AS text_clean, length(t) AS n_chars_clean FROM (
  SELECT doc_id, """ + _strip("regexp_replace(regexp_replace(replace(coalesce(text, ''), chr(13), chr(10)), "
                             "'\\n\\s*\\n+', chr(10) || chr(10), 'g'), '[ \\t]+', ' ', 'g')") + """ AS t
  FROM documents)""")
def q_x1(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", text.clean_text("text").alias("t"))
    return d.select("doc_id", F.col("t").alias("text_clean"), F.length("t").cast("bigint").alias("n_chars_clean"))


def _city_sql(x: str) -> str:
    key = f"lower({_strip(x)})"
    exact = " ".join(f"WHEN {key} = '{k}' THEN '{v}'" for k, v in K.CITY_MAP)
    order = sorted(range(len(K.CITY_MAP)), key=lambda i: (-len(K.CITY_MAP[i][0]), i))
    cont = " ".join(f"WHEN contains({key}, '{K.CITY_MAP[i][0]}') THEN '{K.CITY_MAP[i][1]}'" for i in order)
    return f"CASE {exact} {cont} ELSE {_strip(x)} END"


@query("n1_normalize_city_documents", "SELECT doc_id, " + _city_sql("coalesce(text, '')") + " AS city FROM documents")
def q_n1(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", text.normalize_city("text").alias("city"))


@query("n5_filter_skills_documents", """
WITH t AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), ',')) AS raw,
                  generate_subscripts(string_split(coalesce(text, ''), ','), 1) AS pos FROM documents),
s AS (SELECT doc_id, pos, """ + _strip("raw") + """ AS sk FROM t),
k AS (SELECT * FROM s WHERE length(sk) BETWEEN 2 AND 60 AND lower(sk) NOT IN (""" + _sql_list(K.SKILL_NOISE) + """)),
f AS (SELECT doc_id, pos, sk, row_number() OVER (PARTITION BY doc_id, lower(sk) ORDER BY pos) AS rn FROM k)
SELECT d.doc_id, coalesce(string_agg(f.sk, '|' ORDER BY f.pos), '') AS skills,
       CAST(count(f.sk) AS INTEGER) AS n_skills
FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id AND f.rn = 1 GROUP BY d.doc_id""")
def q_n5(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    sk = text.filter_skills(F.split(F.coalesce("text", F.lit("")), ","))
    return d.select("doc_id", sk.alias("s")).select(
        "doc_id", F.array_join("s", "|").alias("skills"), F.size("s").alias("n_skills"))


SALARY_TEXT_SQL = """
CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || ' - ' || format('{:,}', CAST(floor(l_extendedprice) AS BIGINT))
  || CASE l_returnflag WHEN 'R' THEN ' USD' WHEN 'A' THEN ' triệu' ELSE ' Thỏa thuận' END"""


def _salary_text():
    return F.concat(F.floor("l_quantity").cast("string"), F.lit(" - "),
                    F.format_number(F.floor("l_extendedprice"), 0),
                    F.when(F.col("l_returnflag") == "R", F.lit(" USD"))
                    .when(F.col("l_returnflag") == "A", F.lit(" triệu")).otherwise(F.lit(" Thỏa thuận")))


@query("n2_n3_parse_salary_lineitem", """
WITH t AS (SELECT l_orderkey, l_linenumber, """ + SALARY_TEXT_SQL + """ AS st FROM lineitem),
n AS (SELECT *, list_transform(regexp_extract_all(st, '\\d+(?:[.,]\\d+)*'),
        lambda x: CASE WHEN regexp_full_match(x, '\\d{1,3}(?:[.,]\\d{3})+') THEN TRY_CAST(regexp_replace(x, '[.,]', '', 'g') AS DOUBLE)
                  ELSE TRY_CAST(replace(x, ',', '') AS DOUBLE) END) AS nums,
        contains(lower(st), 'thỏa thuận') OR contains(lower(st), 'thoả thuận') AS neg FROM t)
SELECT l_orderkey, l_linenumber,
       CASE WHEN neg THEN NULL WHEN len(nums) >= 2 THEN least(nums[1], nums[2]) WHEN len(nums) = 1 THEN nums[1] END AS salary_min,
       CASE WHEN neg THEN NULL WHEN len(nums) >= 2 THEN greatest(nums[1], nums[2]) END AS salary_max,
       CASE WHEN contains(lower(st), 'usd') OR contains(st, '$') THEN 'USD' ELSE 'VND' END AS currency,
       CAST(regexp_extract(lower(st), '(\\d+)', 1) AS BIGINT)
         * CASE WHEN contains(lower(st), 'usd') THEN 25000 ELSE 1000000 END AS salary_min_vnd,
       coalesce(CAST(NULLIF(regexp_extract(lower(st), '(\\d+)\\D+(\\d+)', 2), '') AS BIGINT),
                CAST(regexp_extract(lower(st), '(\\d+)', 1) AS BIGINT))
         * CASE WHEN contains(lower(st), 'usd') THEN 25000 ELSE 1000000 END AS salary_max_vnd
FROM n""")
def q_n2(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", _salary_text().alias("st"))
    p, v = salary.parse_salary("st"), salary.salary_vnd("st")
    return li.select("l_orderkey", "l_linenumber", p["salary_min"].alias("salary_min"),
                     p["salary_max"].alias("salary_max"), p["currency"].alias("currency"),
                     v["salary_min"].alias("salary_min_vnd"), v["salary_max"].alias("salary_max_vnd"))


@query("n4_split_skills_part", """
SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(
         regexp_replace(p_name || ' , ' || p_type || ',,' || p_brand, '\\s*,\\s*', ',', 'g'), ','),
         lambda x: trim(x)), lambda x: x <> ''), '|') AS skills
FROM part""")
def q_n4(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    st = F.concat("p_name", F.lit(" , "), "p_type", F.lit(",,"), "p_brand")
    return p.select("p_partkey", F.array_join(text.split_skills(st), "|").alias("skills"))


@query("n6_n22_names_supplier", """
SELECT s.s_suppkey, upper(substr(s.s_name, 1, 1)) || lower(substr(s.s_name, 2)) AS company_name,
       lower(n.n_name) AS source, regexp_replace(regexp_replace(lower(n.n_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS city_slug
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def q_n6(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    n = F.broadcast(read_table(spark, sf_dir, "nation"))
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    return j.select("s_suppkey", text.company_case("s_name").alias("company_name"),
                    text.source_case("n_name").alias("source"), text.city_slug("n_name").alias("city_slug"))


@query("n8_n9_n24_orders", """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'FULL_TIME' WHEN 'O' THEN 'PART_TIME' WHEN 'P' THEN 'INTERN' ELSE 'OTHER' END AS employment_type,
       CASE o_orderstatus WHEN 'F' THEN 'Toàn thời gian' WHEN 'O' THEN 'Bán thời gian' WHEN 'P' THEN 'Thực tập' ELSE 'Khác' END AS employment_type_vi,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'director' WHEN '2-HIGH' THEN 'manager' WHEN '3-MEDIUM' THEN 'lead'
            WHEN '4-NOT SPECIFIED' THEN 'specialist' WHEN '5-LOW' THEN 'staff' END AS level_normalized,
       strftime(o_orderdate, '%Y-%m-%d') AS event_date, strftime(o_orderdate, '%Y-%m') AS month_key,
       strftime(o_orderdate, '%G-W%V') AS week_key, strftime(o_orderdate, '%Y-%m-%dT%H:%M:00Z') AS time_bucket
FROM orders""")
def q_n8(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    raw = F.when(F.col("o_orderstatus") == "F", F.lit("Full-time")) \
        .when(F.col("o_orderstatus") == "O", F.lit("part time")) \
        .when(F.col("o_orderstatus") == "P", F.lit("Thực tập")).otherwise(F.lit("?"))
    lvl = jobs_view._case(F.col("o_orderpriority"), jobs_view.PRIORITY_LEVEL)
    code = enums.employment_type(raw)
    return o.select("o_orderkey", code.alias("employment_type"), enums.employment_type_vi(code).alias("employment_type_vi"),
                    enums.level_normalized(lvl).alias("level_normalized"),
                    enums.date_key("o_orderdate").alias("event_date"), enums.month_key("o_orderdate").alias("month_key"),
                    enums.week_key("o_orderdate").alias("week_key"), enums.time_bucket("o_orderdate").alias("time_bucket"))


@query("v4_parse_delimited_part", """
SELECT CAST(p_partkey AS VARCHAR) AS job_id, p_name AS job_title,
       CASE WHEN p_type <> 'SMALL' THEN p_type END AS city,
       concat_ws('|', CAST(p_partkey AS VARCHAR), p_name, CASE WHEN p_type <> 'SMALL' THEN p_type END) AS raw_value
FROM part""")
def q_v4(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    line = F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name",
                       F.when(F.col("p_type") != "SMALL", F.col("p_type")))
    return messages.parse_delimited(p.select(line.alias("value")))


@query("k3_content_hash_documents", """
SELECT doc_id, sha256(concat_ws('|', """ + ", ".join(
    _strip(f"regexp_replace(lower(coalesce({c}, '')), '\\s+', ' ', 'g')")
    for c in ("source", "lang", "NULL", "CAST(n_chars AS VARCHAR)", "text")) + """)) AS hash_content
FROM documents""")
def q_k3(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", urls.content_hash(F.col("source"), F.col("lang"), F.lit(None).cast("string"),
                                                F.col("n_chars").cast("string"), F.col("text")).alias("hash_content"))


@query("sk1_document_bulk_lines", """
SELECT doc_id, 0 AS line_no, to_json({'index': {'_index': 'documents_v1', '_id': CAST(doc_id AS VARCHAR)}})::VARCHAR AS line
FROM documents
UNION ALL
SELECT doc_id, 1, to_json({'doc_id': doc_id, 'lang': lang, 'source': source, 'n_chars': n_chars, 'text': text})::VARCHAR
FROM documents""")
def q_sk1(spark, sf_dir):
    from hirelens.sinks import documents as docsink
    d = read_table(spark, sf_dir, "documents")
    return docsink.bulk_lines(d, id_col="doc_id", index="documents_v1",
                              fields=["doc_id", "lang", "source", "n_chars", "text"], keep=["doc_id"])


# ================================================================ pages (X, K)

PAGE_URL_SQL = """
pu AS (SELECT page_id, url, regexp_replace(""" + _strip("url") + """, '#.*$', '') AS nf FROM pages),
pp AS (SELECT page_id, url,
         lower(regexp_extract(nf, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)) AS scheme,
         regexp_extract(nf, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?]*)', 1) AS netloc,
         regexp_extract(nf, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?]*([^?]*)', 1) AS path,
         CASE WHEN contains(nf, '?') THEN substr(nf, strpos(nf, '?') + 1) ELSE '' END AS query
       FROM pu),
pq AS (SELECT *, array_to_string(list_filter(string_split(query, '&'),
          lambda x: regexp_full_match(x, '[^=]*=.+') AND lower(split_part(x, '=', 1)) NOT IN (""" + \
    _sql_list(K.TRACKING_PARAMS) + """)), '&') AS q FROM pp),
pn AS (SELECT *, scheme || '://' || lower(netloc) || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS normalized_url
       FROM pq)
"""


@query("k1_k2_pages_urls", "WITH " + PAGE_URL_SQL + """
SELECT page_id, normalized_url, netloc AS domain, replace(netloc, 'www.', '') AS source,
       sha256(lower(replace(netloc, 'www.', '')) || '|' || normalized_url) AS job_id,
       md5(url) AS legacy_job_id,
       CASE WHEN regexp_matches(""" + _strip("url") + """, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN """ + _strip("url") + """
            ELSE 'https://' || """ + _strip("url") + """ END AS url_with_scheme
FROM pn""")
def q_k1(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    dom = urls.url_domain("url")
    src = urls.source_from_domain(dom)
    return p.select("page_id", urls.normalize_url("url").alias("normalized_url"), dom.alias("domain"),
                    src.alias("source"), urls.job_id(src, "url").alias("job_id"),
                    urls.legacy_job_id("url").alias("legacy_job_id"),
                    urls.ensure_scheme("url").alias("url_with_scheme"))


def _unescape_sql(t: str) -> str:
    """The character references that the pages table has (an ampersand's with
    or without its semicolon); the operator decodes all that there are."""
    for a, b in (("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&quot;", '"')):
        t = f"replace({t}, '{a}', chr({ord(b)}))"
    return f"regexp_replace({t}, '&amp;?', '&', 'g')"


def _visible_sql(html_col: str) -> str:
    """A page without comments, scripts, styles and its declaration."""
    t = f"regexp_replace(coalesce({html_col}, ''), '(?s)<!--.*?-->', ' ', 'g')"
    t = f"regexp_replace({t}, '(?is)<(script|style|template)\\b.*?</(script|style|template)\\s*>', ' ', 'g')"
    return f"regexp_replace({t}, '(?is)<!doctype[^>]*>', ' ', 'g')"


PAGE_TEXT_SQL = """
ph AS (SELECT page_id, html, """ + _visible_sql("html") + """ AS body FROM pages),
pt AS (SELECT page_id, html,
         array_to_string(list_filter(list_transform(string_split_regex(body, '<[^>]*>'),
           lambda x: """ + _strip(_unescape_sql("x")) + """),
           lambda x: x <> ''), chr(10)) AS page_text
       FROM ph)
"""


@query("x9_x10_page_text_and_blocked", "WITH " + PAGE_TEXT_SQL + """,
ti AS (SELECT page_id, """ + _strip("regexp_replace(regexp_replace(coalesce(regexp_extract(body, '(?is)<title[^>]*>(.*?)</title>', 1), ''), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')") + """ AS title_text FROM ph)
SELECT pt.page_id, length(pt.html) AS html_chars, length(pt.page_text) AS page_text_chars,
       (""" + " OR ".join(f"contains(lower(pt.html), '{s}')" for s in K.BLOCKED_HTML_SIGNALS) + """) AS has_block_signal,
       (""" + " OR ".join(f"contains(lower(ti.title_text), '{s}')" for s in K.BLOCKED_TITLE_SIGNALS) + """) AS has_title_signal,
       length(pt.html) < 1000 OR (""" + " OR ".join(f"contains(lower(pt.html), '{s}')" for s in K.BLOCKED_HTML_SIGNALS) + """)
         OR (""" + " OR ".join(f"contains(lower(ti.title_text), '{s}')" for s in K.BLOCKED_TITLE_SIGNALS) + """)
         OR length(pt.page_text) < 300 AS looks_blocked
FROM pt JOIN ti ON pt.page_id = ti.page_id""")
def q_x10(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages").select("page_id", "html")
    return html.blocked_flags(p).select("page_id", "html_chars", "page_text_chars", "has_block_signal",
                                        "has_title_signal", "looks_blocked")


def _elem_text_sql(tag: str, html_col: str = "html") -> str:
    """SQL twin of :func:`hirelens.functions.html.element_text`."""
    t = f"regexp_replace(coalesce(regexp_extract({_visible_sql(html_col)}, '(?is)<{tag}[^>]*>(.*?)</{tag}>', 1), ''), " \
        "'<[^>]*>', ' ', 'g')"
    return _strip(f"regexp_replace({_unescape_sql(t)}, '\\s+', ' ', 'g')")


@query("x2_page_title", "SELECT page_id, coalesce(NULLIF(" + _elem_text_sql("h1") + ", ''), NULLIF("
       + _elem_text_sql("title") + ", '')) AS title FROM pages")
def q_x2(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", html.page_title("html").alias("title"))


@query("p1_flat_events_pages", "WITH " + PAGE_TEXT_SQL + """
SELECT p.page_id, md5(p.url) AS job_id,
       replace(regexp_extract(""" + _strip("p.url") + """, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1), 'www.', '') AS source,
       p.url AS source_url, """ + _strip("pt.page_text") + """ AS description_text
FROM pages p JOIN pt ON p.page_id = pt.page_id""")
def q_p1(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    rec = p.select("page_id", F.col("url").alias("source_url"), urls.url_domain("url").alias("domain"),
                   html.page_text("html").alias("description"),
                   F.lit(None).cast("array<string>").alias("skills"))
    for c in ("title", "company_name", "salary", "location", "requirements", "benefits"):
        rec = rec.withColumn(c, F.lit(None).cast("string"))
    flat = messages.to_flat_event(rec, crawled_at=F.lit(""), ingest_ts=F.lit(""), keep=("page_id",))
    return flat.select("page_id", "job_id", "source", "source_url", "description_text")


# Every page's own id and url in a fixed job page, written alike in Spark and in SQL (%s: id, %u: url).
JOB_PAGE = """<!DOCTYPE html><html><head><title>Page %s</title><!-- <h1>old</h1> -->
<meta name="description" content="  About   job %s "><meta property="og:title" content="T&amp;C %s"><meta content="nameless">
<script type="application/ld+json">{"@type": "JobPosting",   "title": "Job %s"}</script>
<script type="application/ld+json">{broken %s</script><style>h1 {color: red}</style></head>
<body><div class="breadcrumb"><a href="/">Home</a> <a href="/%s">Group %s</a></div>
<h1 class="job-title">K&#7929; s&#432; d&agrave;i %s</h1><div class="company-box"><a>C&ocirc;ng ty %s</a></div>
<p class="job-salary"> </p><p class="x-wage">%s - 35 tri&#7879;u</p><span class="address">Street %s</span>
<div class="job-level">L%s</div><div class="exp-box">%s n&#259;m</div><i class="expired-date">%s/12</i>
<b class="working-form">Full %s</b><em class="quantity">%s</em>
<div class="job-description"><h2>What</h2><p>Build %s</p><ul><li>One %s</li><li> Two </li><li></li></ul></div>
<div id="the-requirement"><ul><li>Need %s</li></ul></div><div class="benefits">Plain %s</div>
<div class="job-tags"><a>Tool%s</a><a>Docker</a><a>Docker</a><a class="tag">A very long label that is no skill at all, by far %s</a></div>
<h3>Form</h3><p>Day %s</p><p>Night</p><h3>Empty</h3><h3>Url</h3><p>%u</p></body></html>"""


def _job_page_spark(page_id, url):
    return F.replace(F.replace(F.lit(JOB_PAGE), F.lit("%s"), page_id.cast("string")), F.lit("%u"),
                     F.replace(F.replace(url, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")))


@query("x3_x8_job_page_fields", """
SELECT page_id, 'Kỹ sư dài ' || page_id AS title, 'Công ty ' || page_id AS company_name,
  page_id || ' - 35 triệu' AS salary, 'Street ' || page_id AS location, 'L' || page_id AS level,
  page_id || ' năm' AS experience, page_id || '/12' AS deadline, 'Full ' || page_id AS job_type,
  CAST(page_id AS VARCHAR) AS quantity,
  'What' || chr(10) || 'Build ' || page_id || chr(10) || 'One ' || page_id || chr(10) || 'Two' AS description,
  'One ' || page_id || '|Two' AS description_items, 'Need ' || page_id AS requirements,
  'Need ' || page_id AS requirement_items, 'Plain ' || page_id AS benefits, '' AS benefit_items,
  'Docker|Tool' || page_id AS skills, 'Home|Group ' || page_id AS categories,
  'About job ' || page_id AS meta_description, 'T&C ' || page_id AS meta_title, CAST(2 AS BIGINT) AS n_meta,
  '{"@type": "JobPosting", "title": "Job ' || page_id || '"}' AS json_ld_1, '{broken ' || page_id AS json_ld_2,
  'Day ' || page_id || chr(10) || 'Night' AS form_section, url AS url_section, CAST(4 AS BIGINT) AS n_sections
FROM pages""")
def q_job_page_fields(spark, sf_dir):
    from hirelens.operators.pages import extract_pages
    p = read_table(spark, sf_dir, "pages")
    found = extract_pages(p.select("page_id", _job_page_spark(F.col("page_id"), F.col("url")).alias("html")))
    lists = ["description_items", "requirement_items", "benefit_items", "categories"]
    plain = ["title", "company_name", "salary", "location", "level", "experience", "deadline", "job_type", "quantity",
             "description", "requirements", "benefits"]
    # the container's own text is a chip as well: it is too long here
    return found.select("page_id", *plain, *[F.array_join(c, "|").alias(c) for c in lists],
                        F.array_join("skills", "|").alias("skills"),
                        F.col("meta_tags")["description"].alias("meta_description"),
                        F.col("meta_tags")["og:title"].alias("meta_title"),
                        F.size("meta_tags").cast("bigint").alias("n_meta"),
                        F.get("json_ld", 0).alias("json_ld_1"), F.get("json_ld", 1).alias("json_ld_2"),
                        F.col("sections_by_heading")["Form"].alias("form_section"),
                        F.col("sections_by_heading")["Url"].alias("url_section"),
                        F.size("sections_by_heading").cast("bigint").alias("n_sections"))


@query("x3_x8_extract_pages", "WITH " + PAGE_TEXT_SQL + """
SELECT pt.page_id, NULLIF(""" + _elem_text_sql("h1", "p.html") + """, '') AS title,
       length(pt.page_text) AS page_text_chars
FROM pt JOIN pages p ON pt.page_id = p.page_id""")
def q_x3_x8(spark, sf_dir):
    from hirelens.operators.pages import extract_pages
    out = extract_pages(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", F.nullif("title", F.lit("")).alias("title"),
                      F.length("page_text").cast("bigint").alias("page_text_chars"))


# ===================================================== documents x labels

@query("n10_j5_source_priority_documents", """
SELECT d.doc_id,
       coalesce(NULLIF(trim(CASE WHEN l.quality = 1 THEN d.source END), ''), NULLIF(trim(d.lang), '')) AS company_name,
       CASE WHEN NULLIF(trim(CASE WHEN l.quality = 1 THEN d.source END), '') IS NOT NULL THEN 'structured'
            WHEN NULLIF(trim(d.lang), '') IS NOT NULL THEN 'page' END AS company_name_source,
       coalesce(NULLIF(trim(CASE WHEN l.quality = 1 THEN d.source END), '') <> NULLIF(trim(d.lang), ''), false) AS has_conflict
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_n10(spark, sf_dir):
    from hirelens.operators.medallion import first_present
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id", "left")  # J5: structured evidence + page evidence per key
    structured = F.when(F.col("quality") == 1, F.col("source"))
    val, used, conflict = first_present(("structured", structured), ("page", F.col("lang")))
    return j.select("doc_id", val.alias("company_name"), used.alias("company_name_source"),
                    conflict.alias("has_conflict"))


QUALITY_SQL = """
q AS (SELECT d.doc_id, d.source, d.n_chars > 0 AS has_text, l.doc_id IS NOT NULL AS has_label,
             coalesce(l.quality = 1, false) AS quality_ok, coalesce(l.toxic, 0) = 0 AS non_toxic,
             d.lang IS NOT NULL AS lang_known
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
qs AS (SELECT *, CAST(has_text AS INTEGER) + CAST(has_label AS INTEGER) + CAST(quality_ok AS INTEGER)
                 + CAST(non_toxic AS INTEGER) + CAST(lang_known AS INTEGER) AS passed FROM q)
"""


@query("n23_quality_score_documents", "WITH " + QUALITY_SQL + """
SELECT doc_id, round(CAST(passed AS DOUBLE) / 5.0, 10) AS data_quality_score,
       concat_ws(',', CASE WHEN NOT has_text THEN 'has_text' END, CASE WHEN NOT has_label THEN 'has_label' END,
                 CASE WHEN NOT quality_ok THEN 'quality_ok' END, CASE WHEN NOT non_toxic THEN 'non_toxic' END,
                 CASE WHEN NOT lang_known THEN 'lang_known' END) AS data_quality_notes
FROM qs""")
def q_n23(spark, sf_dir):
    from hirelens.operators import quality
    f = _doc_quality_flags(spark, sf_dir)
    score, notes = quality.quality_score({k: F.col(k) for k in DOC_FLAGS})
    return f.select("doc_id", score.alias("data_quality_score"), notes.alias("data_quality_notes"))


DOC_FLAGS = ["has_text", "has_label", "quality_ok", "non_toxic", "lang_known"]


def _doc_quality_flags(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "lang")
    lab = read_table(spark, sf_dir, "labels")
    j = d.join(lab.withColumn("_l", F.lit(True)), "doc_id", "left")
    return j.select("doc_id", "source", (F.col("n_chars") > 0).alias("has_text"),
                    F.col("_l").isNotNull().alias("has_label"),
                    F.coalesce(F.col("quality") == 1, F.lit(False)).alias("quality_ok"),
                    (F.coalesce("toxic", F.lit(0)) == 0).alias("non_toxic"),
                    F.col("lang").isNotNull().alias("lang_known"))


@query("a11_quality_coverage_by_source", "WITH " + QUALITY_SQL + """
SELECT source, count(*) AS doc_count,
       sum(passed) / (5 * count(*)) AS data_quality_coverage,
       count(*) FILTER (WHERE has_label) / count(*) AS label_coverage,
       count(*) FILTER (WHERE quality_ok) / count(*) AS quality_ok_ratio
FROM qs GROUP BY ALL""")
def q_a11q(spark, sf_dir):
    from hirelens.functions.agg import ratio
    f = _doc_quality_flags(spark, sf_dir)
    passed = sum((F.col(k).cast("int") for k in DOC_FLAGS), F.lit(0))
    return f.withColumn("_p", passed).groupBy("source").agg(
        F.count(F.lit(1)).alias("doc_count"),
        (F.sum("_p") / (F.count(F.lit(1)) * 5)).alias("data_quality_coverage"),
        ratio(F.col("has_label")).alias("label_coverage"),
        ratio(F.col("quality_ok")).alias("quality_ok_ratio"))


def _benefit_sql(col: str) -> str:
    from hirelens.functions.taxonomy import BENEFIT_TAGS
    parts = []
    for tag, words in BENEFIT_TAGS:
        cond = " OR ".join(f"contains(lower({col}), '{w}')" for w in words)
        parts.append(f"count(*) FILTER (WHERE {cond}) / count(*) AS {tag}_ratio")
    anyc = " OR ".join(f"contains(lower({col}), '{w}')" for _, ws in BENEFIT_TAGS for w in ws)
    parts.append(f"count(*) FILTER (WHERE {anyc}) / count(*) AS benefit_coverage_ratio")
    return ",\n       ".join(parts)


def _english_sql(col: str) -> str:
    from hirelens.functions.taxonomy import ENGLISH_PATTERN
    return f"regexp_matches(lower(coalesce({col}, '')), '{ENGLISH_PATTERN}')"


@query("a13_n19_benefit_ratios_documents", "SELECT source, count(*) AS doc_count,\n       " + _benefit_sql("text")
       + ",\n       count(*) FILTER (WHERE " + _english_sql("text") + ") / count(*) AS english_required_ratio"
       + "\nFROM documents GROUP BY ALL")
def q_a13(spark, sf_dir):
    from hirelens.functions import taxonomy
    from hirelens.functions.agg import ratio
    d = read_table(spark, sf_dir, "documents").select("source", taxonomy.benefit_tags("text").alias("tags"),
                                                      taxonomy.english_required("text").alias("eng"))
    aggs = [ratio(F.array_contains("tags", tag)).alias(f"{tag}_ratio") for tag, _ in taxonomy.BENEFIT_TAGS]
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("doc_count"), *aggs,
                                   ratio(F.size("tags") > 0).alias("benefit_coverage_ratio"),
                                   ratio(F.col("eng")).alias("english_required_ratio"))


# ============================================================ experience

# Sentences around each document's own numbers; the oracle states what they say.
@query("n2_n11_free_text_documents", """
WITH d AS (SELECT doc_id, doc_id % 3 AS kind, 1 + doc_id % 11 AS a, 1 + n_chars % 4 AS b, 10 + doc_id % 7 AS lo,
                  9 + n_chars % 31 AS hi FROM documents)
SELECT doc_id,
  CAST(CASE kind WHEN 0 THEN least(lo, hi) WHEN 2 THEN 100 * lo END AS DOUBLE) AS salary_min,
  CAST(CASE kind WHEN 0 THEN greatest(lo, hi) END AS DOUBLE) AS salary_max,
  CASE kind WHEN 2 THEN 'USD' ELSE 'VND' END AS currency,
  CAST(CASE kind WHEN 0 THEN least(a, 12 * b) WHEN 2 THEN 12 * b END AS INTEGER) AS experience_months_min,
  CAST(CASE kind WHEN 0 THEN greatest(a, 12 * b) WHEN 2 THEN 12 * (b + 1) END AS INTEGER) AS experience_months_max,
  CASE kind WHEN 0 THEN 'FULL_TIME' WHEN 1 THEN 'INTERN' ELSE 'OTHER' END AS employment_type
FROM d""")
def q_free_text(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    a, b = (1 + F.col("doc_id") % 11).cast("string"), (1 + F.col("n_chars") % 4).cast("string")
    lo, hi = (10 + F.col("doc_id") % 7).cast("string"), (9 + F.col("n_chars") % 31).cast("string")
    kind = F.col("doc_id") % 3
    benefits = F.when(kind == 0, F.concat(F.lit("Thưởng tháng 13, 12 ngày phép. Lương "), lo, F.lit(" - "), hi, F.lit(" triệu"))) \
        .when(kind == 2, F.concat(F.lit("Nghỉ 14 ngày, lương $"), lo, F.lit("00/tháng cho 3 vị trí ở "), F.col("source"))) \
        .otherwise(F.concat(F.lit("Thưởng tháng 13, 12 ngày phép, tầng "), a))
    needs = F.when(kind == 0, F.concat(F.lit("Độ tuổi 22-35, kinh nghiệm từ "), a, F.lit(" tháng đến "), b, F.lit(" năm"))) \
        .when(kind == 2, F.concat(F.lit("Born in 1990, "), b, F.lit("-"), (2 + F.col("n_chars") % 4).cast("string"),
                                  F.lit(" years of experience"))) \
        .otherwise(F.concat(F.lit("Tốt nghiệp năm 2020, thành thạo "), b, F.lit(" ngôn ngữ, kinh nghiệm là lợi thế. "), a))
    kinds = F.when(kind == 0, F.lit('["FULL_TIME", "PART_TIME"]')).when(kind == 1, F.lit(' ["intern"]')).otherwise(F.lit("[]"))
    sal, exp = salary.salary_in_text(benefits), enums.experience_in_text(needs)
    return d.select("doc_id", sal["salary_min"].alias("salary_min"), sal["salary_max"].alias("salary_max"),
                    sal["currency"].alias("currency"), exp["experience_months_min"].alias("experience_months_min"),
                    exp["experience_months_max"].alias("experience_months_max"),
                    enums.employment_type(kinds).alias("employment_type"))


@query("n11_n12_experience_part", """
WITH t AS (SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN CAST(p_size AS VARCHAR) || ' tháng'
                                  WHEN 'LARGE' THEN '1-' || CAST(p_size AS VARCHAR) || ' năm'
                                  WHEN 'PROMO' THEN 'Không yêu cầu kinh nghiệm'
                                  ELSE CAST(p_size AS VARCHAR) || '.5 năm' END AS txt FROM part),
n AS (SELECT p_partkey, lower(txt) AS lt,
             list_transform(regexp_extract_all(lower(txt), '\\d+(?:[.,]\\d+)?'), lambda x: TRY_CAST(replace(x, ',', '.') AS DOUBLE)) AS nums
      FROM t),
m AS (SELECT p_partkey,
        CASE WHEN regexp_matches(lt, 'không yêu cầu|no experience|chưa có kinh nghiệm') AND len(nums) = 0 THEN 0
             ELSE CAST(round(nums[1] * CASE WHEN regexp_matches(lt, 'năm|year') THEN 12.0
                                           WHEN regexp_matches(lt, 'tháng|month') THEN 1.0 ELSE 12.0 END) AS INTEGER) END
          AS experience_months_min,
        CAST(round(nums[2] * CASE WHEN regexp_matches(lt, 'năm|year') THEN 12.0
                                  WHEN regexp_matches(lt, 'tháng|month') THEN 1.0 ELSE 12.0 END) AS INTEGER)
          AS experience_months_max
      FROM n)
SELECT *, CASE WHEN experience_months_min IS NULL THEN 'unknown' WHEN experience_months_min < 24 THEN 'junior'
               WHEN experience_months_min < 60 THEN 'mid' ELSE 'senior' END AS experience_bucket
FROM m""")
def q_n11(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    sz = F.col("p_size").cast("string")
    txt = F.when(F.col("p_type") == "SMALL", F.concat(sz, F.lit(" tháng"))) \
        .when(F.col("p_type") == "LARGE", F.concat(F.lit("1-"), sz, F.lit(" năm"))) \
        .when(F.col("p_type") == "PROMO", F.lit("Không yêu cầu kinh nghiệm")) \
        .otherwise(F.concat(sz, F.lit(".5 năm")))
    e = enums.experience_months(txt)
    return p.select("p_partkey", e["experience_months_min"].alias("experience_months_min"),
                    e["experience_months_max"].alias("experience_months_max"),
                    enums.experience_bucket(e["experience_months_min"]).alias("experience_bucket"))


# ================================================================= rollup

@query("o1_category_rollup", with_j("""
SELECT category_level_1, category_level_2, CAST(grouping_id(category_level_1, category_level_2) AS INTEGER) AS grouping_level,
       count(*) AS job_count, """ + MA("salary_min") + """ AS avg_salary_min
FROM jl GROUP BY ROLLUP (category_level_1, category_level_2)"""))
def q_o1(spark, sf_dir):
    from hirelens.functions.agg import money_avg
    jl = jobs_view.jobs_latest(spark, sf_dir)
    return jl.rollup("category_level_1", "category_level_2").agg(
        F.grouping_id().cast("int").alias("grouping_level"), F.count(F.lit(1)).alias("job_count"),
        money_avg("salary_min").alias("avg_salary_min"))


# ===================================================== document contract

@query("v7_document_contract_check", with_j(""",
docs AS (SELECT job_id, CASE WHEN status <> 'P' THEN hash_content END AS content_hash, job_title, company_name, city,
                CASE WHEN status = 'F' THEN strftime(posting_date, '%d/%m/%Y') ELSE strftime(posting_date, '%Y-%m-%d') END AS event_date,
                strftime(ingest_ts, '%Y-%m-%dT%H:%M:%S') AS fetched_at, 'https://tpch.example/' || job_id AS job_url
         FROM jl),
e AS (SELECT concat_ws(',', CASE WHEN content_hash IS NULL OR content_hash = '' THEN 'missing:content_hash' END,
                 CASE WHEN event_date IS NOT NULL AND NOT regexp_full_match(event_date, '\\d{4}-\\d{2}-\\d{2}') THEN 'bad_format:event_date' END) AS contract_errors
      FROM docs)
SELECT contract_errors, count(*) AS doc_count FROM e GROUP BY ALL"""))
def q_v7(spark, sf_dir):
    jl = jobs_view.jobs_latest(spark, sf_dir)
    docs = jl.select("job_id", F.when(F.col("status") != "P", F.col("hash_content")).alias("content_hash"),
                     "job_title", "company_name", "city",
                     F.when(F.col("status") == "F", F.date_format("posting_date", "dd/MM/yyyy"))
                     .otherwise(enums.date_key("posting_date")).alias("event_date"),
                     F.date_format("ingest_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("fetched_at"),
                     F.concat(F.lit("https://tpch.example/"), "job_id").alias("job_url"))
    checked = messages.document_contract_errors(docs)
    return checked.groupBy(F.array_join("contract_errors", ",").alias("contract_errors")) \
        .agg(F.count(F.lit(1)).alias("doc_count"))


@query("p2_v2_envelope_roundtrip_pages", "WITH " + PAGE_URL_SQL + """
SELECT sha256('boards|' || normalized_url) AS job_id, 'boards' AS source, url AS source_url,
       normalized_url AS normalized_source_url, 1 AS crawl_version, CAST(NULL AS VARCHAR) AS envelope_error,
       netloc AS domain
FROM pn""")
def q_p2(spark, sf_dir):
    """Pages -> envelopes (P2) -> queue messages (key = job_id, value = JSON)
    -> parsed envelopes (V2)."""
    p = read_table(spark, sf_dir, "pages").select(
        F.col("url").alias("source_url"),
        F.struct(urls.url_domain("url").alias("domain"), html.page_title("html").alias("title")).alias("payload"))
    env = messages.to_envelope(p, source="boards", now=F.lit("2024-01-01T00:00:00"))
    msgs = env.select(F.col("key").cast("binary").alias("key"), F.to_json("envelope").cast("binary").alias("value"),
                      F.lit("jobs_raw").alias("topic"), F.lit(0).alias("partition"),
                      F.lit(0).cast("bigint").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"))
    parsed = messages.parse_envelope(msgs)
    return parsed.select("job_id", "source", "source_url", "normalized_source_url",
                         F.get_json_object("raw_json", "$.crawl_version").cast("int").alias("crawl_version"),
                         "envelope_error", F.col("payload.domain").alias("domain"))


@query("n18_taxonomy_split_jobs", with_j(""",
soft AS (SELECT DISTINCT lower(p_type) AS skill_key FROM part),
hard AS (SELECT DISTINCT w AS skill_key FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS w FROM part)
         WHERE w NOT IN (SELECT skill_key FROM soft)),
tax AS (SELECT skill_key, 'soft' AS kind FROM soft UNION ALL SELECT skill_key, 'hard' FROM hard),
ex AS (SELECT job_id, unnest(skills) AS skill, generate_subscripts(skills, 1) AS pos FROM jl),
m AS (SELECT ex.job_id, ex.pos, ex.skill, tax.kind FROM ex JOIN tax ON lower(trim(ex.skill)) = tax.skill_key),
g AS (SELECT job_id, string_agg(skill, '|' ORDER BY pos) AS skills_taxonomy,
             coalesce(string_agg(skill, '|' ORDER BY pos) FILTER (WHERE kind = 'hard'), '') AS hard_skills,
             coalesce(string_agg(skill, '|' ORDER BY pos) FILTER (WHERE kind = 'soft'), '') AS soft_skills
      FROM m GROUP BY job_id)
SELECT jl.job_id, coalesce(g.skills_taxonomy, '') AS skills_taxonomy, coalesce(g.hard_skills, '') AS hard_skills,
       coalesce(g.soft_skills, '') AS soft_skills
FROM jl LEFT JOIN g ON jl.job_id = g.job_id"""))
def q_n18(spark, sf_dir):
    from hirelens.functions import taxonomy
    part = read_table(spark, sf_dir, "part")
    soft = part.select(F.lower("p_type").alias("skill_key")).distinct()
    hard = part.select(F.explode(F.split(F.lower("p_name"), " ")).alias("skill_key")).distinct() \
        .join(soft, "skill_key", "left_anti")
    tax = soft.withColumn("skill_kind", F.lit("soft")).unionByName(hard.withColumn("skill_kind", F.lit("hard")))
    jl = jobs_view.jobs_latest(spark, sf_dir, narrow=True).select("posting", "skills")
    out = taxonomy.split_skills_by_taxonomy(jl, "posting", "skills", tax, fixed_size=False)
    return out.select(F.sha2("posting", 256).alias("job_id"), *[F.array_join(c, "|").alias(c) for c in ("skills_taxonomy", "hard_skills", "soft_skills")])


JSON_LD_PATTERN = r"""(?is)<script[^>]*type\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script>"""


@query("p5_p6_bronze_pages", "WITH " + PAGE_URL_SQL + "," + PAGE_TEXT_SQL.strip().rstrip(",") + """
SELECT sha256('boards|' || pn.normalized_url) AS job_id,
       CAST(len(regexp_extract_all(p.html, '""" + JSON_LD_PATTERN.replace("'", "''") + """', 1)) AS INTEGER) AS json_ld_count,
       CAST(0 AS INTEGER) AS skills_count,
       len(regexp_extract_all(p.html, '""" + JSON_LD_PATTERN.replace("'", "''") + """', 1)) > 0 AS has_json_ld,
       pt.page_text <> '' AS has_page_text,
       false AS has_structured_salary, false AS has_noisy_skill_list, false AS has_valid_posting_date,
       CAST(NULL AS VARCHAR) AS job_title_raw
FROM pages p JOIN pn ON p.page_id = pn.page_id JOIN pt ON p.page_id = pt.page_id""")
def q_p5(spark, sf_dir):
    """Pages -> payload (domain, visible text, JSON-LD blocks) -> envelope ->
    bronze projection with its quality-flag map (P5, P6, X5, X9)."""
    from hirelens.operators import medallion
    p = read_table(spark, sf_dir, "pages")
    payload = F.struct(urls.url_domain("url").alias("domain"), html.page_text("html").alias("page_text"),
                       html.json_ld_blocks("html").alias("json_ld"))
    env = messages.to_envelope(p.select(F.col("url").alias("source_url"), payload.alias("payload")),
                               source="boards", now=F.lit("2024-01-01T00:00:00"))
    msgs = env.select(F.col("key").cast("binary").alias("key"), F.to_json("envelope").cast("binary").alias("value"),
                      F.lit("jobs_raw").alias("topic"), F.lit(0).alias("partition"),
                      F.lit(0).cast("bigint").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"))
    b = medallion.bronze(messages.parse_envelope(msgs).withColumn("crawl_version", F.lit(1)))
    f = F.col("quality_issue_flags")
    return b.select("job_id", "json_ld_count", F.col("skills_raw_count").alias("skills_count"), f["has_json_ld"].alias("has_json_ld"),
                    f["has_page_text"].alias("has_page_text"), f["has_structured_salary"].alias("has_structured_salary"),
                    f["has_noisy_skill_list"].alias("has_noisy_skill_list"),
                    f["has_valid_posting_date"].alias("has_valid_posting_date"), "job_title_raw")


@query("k7_dedup_events", "WITH " + adapters.EVENTS_RAW_SQL + """
SELECT job_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts, source_url, location_city FROM ed""")
def q_k7(spark, sf_dir):
    """K7 in batch: the earliest event per job_id (ties by source_url); the
    streaming form keeps the first arrival within the watermark."""
    d = _stream_a(spark, sf_dir, cols=["location_city"])
    return d.select("job_id", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_ts"),
                    "source_url", "location_city")


from hirelens.plans import silver_queries, state_queries, stream_queries  # noqa: E402,F401  (they register their queries)

__all__ = ["QUERIES"]
