"""Serving queries and layer merges: L1–L3, U1, A16 / J3, J4."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_window(view: DataFrame, end_col: str = "window_end") -> DataFrame:
    """L2: rows of the latest window (by window end); empty when the view is
    empty. The max is a scalar subquery (one global aggregate value)."""
    return view.filter(F.col(end_col) == view.select(F.max(end_col)).scalar())


def top_n_latest(view: DataFrame, value: str, field: str, n: int = 10,
                 end_col: str = "window_end") -> DataFrame:
    """L1: top ``n`` fields of the latest window, value descending, ties by
    field name (TakeOrderedAndProject: a per-partition top-n, then a merge of
    n rows per partition; the limit is the feature)."""
    return latest_window(view, end_col).orderBy(F.col(value).desc(), F.col(field).asc()).limit(n)


def reconcile(stream_side: DataFrame, batch_side: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Full outer join of the stream table and a batch recompute on
    the shared keys; NULL-safe difference per key."""
    s = stream_side.select(*keys, F.col(metric).alias(f"stream_{metric}"))
    b = batch_side.select(*keys, F.col(metric).alias(f"batch_{metric}"))
    j = s.join(b, keys, "full_outer")
    diff = F.coalesce(F.col(f"stream_{metric}"), F.lit(0)) - F.coalesce(F.col(f"batch_{metric}"), F.lit(0))
    return j.withColumn(f"{metric}_diff", diff.cast("bigint"))


def merge_layers(batch_side: DataFrame, speed_side: DataFrame, time_col: str, cutoff) -> DataFrame:
    """Historical (batch) rows before the cut-off, realtime rows from it
    on; ``unionByName`` with the serving layer marked."""
    b = batch_side.filter(F.col(time_col) < F.lit(cutoff)).withColumn("layer", F.lit("batch"))
    s = speed_side.filter(F.col(time_col) >= F.lit(cutoff)).withColumn("layer", F.lit("speed"))
    return b.unionByName(s)


def new_vs_known(batch: DataFrame, known_keys: DataFrame, key: str, group: str) -> DataFrame:
    """Per group, batch rows whose key is new (left anti join against the
    known keys) and rows of known keys (left semi join)."""
    known = known_keys.select(key).distinct()
    new = batch.join(known, key, "left_anti").groupBy(group).agg(F.count(F.lit(1)).alias("new_posting_events"))
    old = batch.join(known, key, "left_semi").groupBy(group).agg(F.count(F.lit(1)).alias("known_posting_events"))
    return new.join(old, group, "full_outer").select(
        group, F.coalesce("new_posting_events", F.lit(0)).cast("bigint").alias("new_posting_events"),
        F.coalesce("known_posting_events", F.lit(0)).cast("bigint").alias("known_posting_events"))


def search_facets(silver: DataFrame, skill: str | None = None, city: str | None = None,
                  company: str | None = None, salary_range=None, since: str | None = None,
                  facet: str = "city") -> DataFrame:
    """L3: historical search filters (skill, city, company, salary range,
    date) and facet counts."""
    df = silver
    if skill is not None:
        df = df.filter(F.array_contains("skills", skill))
    if city is not None:
        df = df.filter(F.col("city") == city)
    if company is not None:
        df = df.filter(F.col("company_name") == company)
    if salary_range is not None:
        lo, hi = salary_range
        df = df.filter(F.col("salary_min").between(lo, hi))
    if since is not None:
        df = df.filter(F.col("posting_date") >= F.lit(since).cast("date"))
    from hirelens.functions.agg import money_avg
    return df.groupBy(facet).agg(F.count(F.lit(1)).alias("job_count"),
                                 money_avg("salary_min").alias("avg_salary_min"))
