"""Queries whose operators continue from what earlier batches have left."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.operators import keys
from hirelens.plans import jobs_view
from hirelens.plans.jobs_view import ORDER_COLS, with_j
from hirelens.plans.registry import query
from hirelens.session import scratch_path
from hirelens.sinks.commits import remove
from hirelens.sinks.steps import dealt, written
from hirelens.streaming.runs import fresh_name

@query("k5_versions_from_state", with_j("""
SELECT job_id, ingest_ts, l_partkey, l_suppkey, hash_content, record_version, is_latest FROM jv"""))
def q_k5_state(spark, sf_dir):
    """K5 over three deliveries of lineitem by ship date: each one's versions
    continue from the state row of its jobs. Returned items of the first years
    are only delivered with the last ones: their jobs are versioned again.

    A delivery writes its own rows once, with ``again`` for those of jobs that
    were versioned anew, and the table is put together as it is read: no row
    is copied with each delivery. All tables have the same buckets of postings,
    so that rows are shuffled on their way to the first one only. What a later
    step has replaced is removed."""
    root = scratch_path(spark, fresh_name("versions"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = {"key": "posting", "order": ORDER_COLS, "hash_col": "content"}
    year = F.year("ingest_ts")
    delivery = F.when((year < 1997) & (F.col("employment_type") == "CONTRACTOR"), 2).when(year < 1997, 0).when(year < 1999, 1).otherwise(2)
    rows = jobs_view.jobs_texts(spark, sf_dir).select("posting", "job_title", "company_name", "city", *ORDER_COLS, delivery.alias("delivery"))
    rows = written(rows, f"{root}/rows")
    bronze = dealt(rows.repartition(buckets, "posting"), f"{root}/bronze", "posting", buckets, "delivery")
    remove(spark, f"{root}/rows")
    state, made = None, []
    for n in range(3):
        batch = jobs_view.narrow_of(bronze.where(F.col("delivery") == n).drop("delivery"))
        if state is None:
            new = keys.versioned(batch, **by).withColumn("again", F.lit(False))
        else:
            new, late = keys.continue_versions(batch, state, **by)
            late = dealt(late, f"{root}/late{n}", "posting", buckets)
            history = jobs_view.narrow_of(bronze.where(F.col("delivery") <= n).drop("delivery")).join(late, "posting", "left_semi")
            new = new.withColumn("again", F.lit(False)).unionByName(
                keys.versioned(history, **by).withColumn("again", F.lit(True)))
        new = dealt(new, f"{root}/new{n}", "posting", buckets)
        if n == 2:
            remove(spark, f"{root}/bronze")
        last = keys.version_state(new.where("is_latest"), **by)
        if state is not None:
            last = state.join(new.select("posting").distinct(), "posting", "left_anti").unionByName(last)
        state = dealt(last, f"{root}/state{n}", "posting", buckets)
        if n:
            remove(spark, f"{root}/state{n - 1}")
        made.append(new)
    table = functools.reduce(DataFrame.unionByName, [_still(new, made[n + 1:]) for n, new in enumerate(made)])
    return jobs_view.named(table).select("job_id", "ingest_ts", "l_partkey", "l_suppkey", "hash_content", "record_version", "is_latest")


def _still(new: DataFrame, later: list[DataFrame]) -> DataFrame:
    """The rows of a delivery that later ones have not versioned again; none
    is the latest of a job that has later rows."""
    for told in later:
        told = told.groupBy("posting").agg(F.max("again").alias("_again"))
        new = (new.join(told, "posting", "left").where(~F.coalesce("_again", F.lit(False)))
               .withColumn("is_latest", F.col("is_latest") & F.col("_again").isNull()).drop("_again"))
    return new.drop("again")
