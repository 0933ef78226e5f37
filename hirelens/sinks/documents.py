"""Document-index sink as bulk NDJSON (SK1) and search projections (SK9).

Every document gives two lines — an action line with the index and id (so a
re-send is an upsert by id) and the document itself — written as text files
by the executors. No HTTP client runs inside Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens import schemas


def bulk_lines(df: DataFrame, id_col: str, index: str, fields: list[str], keep=()) -> DataFrame:
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"),
                                         F.col(id_col).cast("string").alias("_id")).alias("index")))
    doc = F.to_json(F.struct(*[F.col(c) for c in fields]))
    lines = F.array(F.struct(F.lit(0).alias("line_no"), action.alias("line")),
                    F.struct(F.lit(1).alias("line_no"), doc.alias("line")))
    return df.select(*keep, F.explode(lines).alias("l")).select(*keep, "l.line_no", "l.line")


def write_bulk(df: DataFrame, path: str, id_col: str, index: str, fields: list[str]) -> None:
    """Write bulk NDJSON files (one per partition; order within a file keeps
    each action line next to its document)."""
    bulk_lines(df, id_col, index, fields).select("line").write.mode("overwrite").text(path)


# Stable field lists of the search projections.
SEARCH_FIELDS = {
    "jobs_silver_v1": ["job_id", "job_title", "job_title_display", "company_name", "city", "location_display",
                       "employment_type", "level_normalized", "salary_min", "salary_max", "skills", "category_level_1",
                       "category_level_2", "category_level_3", "benefits_tags", "status", "posting_date"],
    "jobs_realtime_v1": schemas.JOB_DOCUMENT_FIELDS,
    "gold_job_facts_daily_v1": ["date_key", "city", "employment_type", "job_count", "avg_salary_min",
                                "avg_salary_max"],
    "gold_skill_counts_daily_v1": ["date_key", "skill", "city", "job_count", "skill_rank_in_day"],
    "gold_company_hiring_by_month_v1": ["month_key", "company_name", "city", "job_count", "distinct_job_title_count",
                                        "avg_salary_min", "avg_salary_max", "hiring_rank_in_city"],
}


def search_projection(df: DataFrame, name: str) -> DataFrame:
    """SK9: the stable field list of a search index."""
    return df.select(*SEARCH_FIELDS[name])
