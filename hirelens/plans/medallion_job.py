"""Batch medallion job (E4): raw envelopes -> raw -> bronze -> silver -> gold.

Raw and bronze grow by partitions of their batch. Versions continue from a
kept state row per job (last order, hash and version, and the partitions that
hold the job), so a batch reads its own bronze rows only; a job with a row
that comes before what is known is versioned again from its whole history.
Silver partitions that gain, lose or unflag a row are written anew, and the
gold and lookup partitions that depend on them rebuilt. All of a batch shows
at once, by one commit (:class:`hirelens.sinks.commits.Lake`): a job that dies
before has changed nothing, and its batch can be run again. The as-of time is
a parameter; nothing reads the wall clock.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions import enums
from hirelens.operators import gold, keys, medallion
from hirelens.sinks import documents
from hirelens.sinks.commits import Lake, partition_names

def _jobs_by_day(latest: DataFrame) -> DataFrame:
    return medallion.jobs_by_day(latest).withColumn("date_key", enums.date_key("posting_date"))


def _jobs_by_skill(latest: DataFrame) -> DataFrame:
    return medallion.jobs_by_skill(latest).withColumn("month_key", enums.month_key("posting_date"))


def _jobs_silver(latest: DataFrame) -> DataFrame:
    return documents.search_projection(latest, "jobs_silver_v1").withColumn("date_key", enums.date_key("posting_date"))


# Tables built from the latest silver rows: builder, partition key, columns that readers look up (SK8).
GOLD_TABLES = {
    "gold_job_facts_daily": (gold.job_facts_daily, "date_key", ["city"]),
    "gold_skill_counts_daily": (gold.skill_counts_daily, "date_key", ["skill"]),
    "gold_salary_stats_by_skill_month": (gold.salary_stats_by_skill_month, "month_key", ["skill"]),
    "gold_company_hiring_by_month": (gold.company_hiring_by_month, "month_key", ["company_name"]),
    "gold_skill_cooccurrence_weekly": (gold.skill_cooccurrence_weekly, "week_key", None),
    "jobs_by_day": (_jobs_by_day, "date_key", ["job_id"]),
    "jobs_by_skill": (_jobs_by_skill, "month_key", ["skill", "job_id"]),
    "jobs_silver_v1": (_jobs_silver, "date_key", ["job_id"]),
}
# Search lists (SK9) of gold tables; that of silver is above, that of the stream is the consumer's.
SEARCH_TABLES = {f"{t}_v1": t for t in ("gold_job_facts_daily", "gold_skill_counts_daily", "gold_company_hiring_by_month")}
KEY_OF = {"date_key": enums.date_key, "month_key": enums.month_key, "week_key": enums.week_key}
TABLES = ("raw", "bronze", "silver", "versions", *GOLD_TABLES, *SEARCH_TABLES)
SILVER_PARTITIONS = ["posting_date", "city_slug"]
BRONZE_PARTITIONS = ["batch_id", "source", "ingest_date"]


def _key_of_part(part: str, key: str) -> str:
    """The gold key of a silver partition's posting date."""
    day = datetime.date.fromisoformat(part.split("/")[0].removeprefix("posting_date="))
    year, week, _ = day.isocalendar()
    return {"date_key": day.isoformat(), "month_key": f"{day:%Y-%m}", "week_key": f"{year}-W{week:02d}"}[key]


def _part_of() -> Column:
    city = F.when(F.coalesce("city_slug", F.lit("")) == "", "__HIVE_DEFAULT_PARTITION__").otherwise(F.col("city_slug"))
    return F.concat(F.lit("posting_date="), F.col("posting_date").cast("string"), F.lit("/city_slug="), city)


def _silver_rows(bronze: DataFrame, as_of: str | None) -> DataFrame:
    rows = medallion.silver_fields(medallion.bronze_dedup(bronze), as_of)
    return rows.withColumn("posting_date", F.coalesce("posting_date", F.to_date("ingest_ts")))


def _known(rows: DataFrame) -> DataFrame:
    """State of versioned silver rows: what continues their versions, the
    hashes of the last day (a copy of one of them is no new row), the
    partition of the last row and of all rows."""
    order = F.struct(*medallion.SILVER_ORDER)
    day = rows.groupBy("job_id", "ingest_date").agg(F.collect_set("hash_content").alias("day_hashes"))
    day = day.groupBy("job_id").agg(F.max("ingest_date").alias("last_day"), F.max_by("day_hashes", "ingest_date").alias("day_hashes"))
    parts = rows.groupBy("job_id").agg(F.max_by(_part_of(), order).alias("latest_part"), F.collect_set(_part_of()).alias("parts"))
    return keys.version_state(rows, order=medallion.SILVER_ORDER).join(day, "job_id").join(parts, "job_id")


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _extended(known: DataFrame, rows: DataFrame, late: DataFrame) -> DataFrame:
    """The state after ``rows``: of late jobs it is that of their rows, of
    others the old one carried on."""
    new = _known(rows)
    old = known.join(late, "job_id", "left_anti").select(
        "job_id", F.col("parts").alias("_parts"), F.col("last_day").alias("_day"), F.col("day_hashes").alias("_hashes"))
    new = new.join(old, "job_id", "left").withColumns({
        "parts": F.array_union("parts", F.coalesce("_parts", F.array().cast("array<string>"))),
        "day_hashes": F.when(F.col("_day") == F.col("last_day"), F.array_union("day_hashes", "_hashes"))
        .otherwise(F.col("day_hashes"))})
    return known.join(new, "job_id", "left_anti").unionByName(new.select(known.columns))


def _new_silver(lake: Lake, batch: DataFrame, replaced: DataFrame | None, as_of: str | None,
                stage: str) -> tuple[DataFrame, set[str], DataFrame]:
    """What a batch changes: the new rows of the silver partitions touched,
    their names, and the new state. ``replaced``: jobs of an earlier run of
    this batch, which are versioned again."""
    day = F.col("ingest_date")
    if "versions" not in lake.tables:
        rows = keys.versioned(_silver_rows(batch, as_of), order=medallion.SILVER_ORDER, bucket=day)
        rows = _staged(rows, f"{stage}/rows")
        return rows, partition_names(rows, SILVER_PARTITIONS), _known(rows)
    known = lake.read("versions")
    if replaced is None:
        # A copy of a row of the job's last day is a duplicate (K4), not a version.
        seen = known.select("job_id", F.col("last_day").alias("ingest_date"), F.explode("day_hashes").alias("hash_content"))
        batch = batch.join(seen, ["job_id", "ingest_date", "hash_content"], "left_anti")
    rows, late = keys.continue_versions(_silver_rows(batch, as_of), known, order=medallion.SILVER_ORDER, bucket=day)
    if replaced is not None:
        late = late.union(replaced).distinct()
    late = _staged(late, f"{stage}/late")
    rows = _staged(rows.join(late, "job_id", "left_anti"), f"{stage}/rows")
    if not late.isEmpty():
        history = lake.read("bronze").join(late, "job_id", "left_semi").drop("batch_id")
        again = keys.versioned(_silver_rows(history, as_of), order=medallion.SILVER_ORDER, bucket=day)
        rows = _staged(rows.unionByName(again), f"{stage}/all_rows")
    newer = rows.select("job_id").distinct()
    left = known.join(late, "job_id", "left_semi").select(F.explode("parts").alias("p")).union(
        known.join(late, "job_id", "left_anti").join(newer, "job_id", "left_semi").select("latest_part"))
    touched = {r["p"] for r in left.distinct().collect()} | partition_names(rows, SILVER_PARTITIONS)
    old = (lake.read("silver", touched).join(late, "job_id", "left_anti")
           .join(newer.withColumn("_newer", F.lit(True)), "job_id", "left")
           .withColumn("is_latest", F.col("is_latest") & F.col("_newer").isNull()))
    return old.select(rows.columns).unionByName(rows), touched, _extended(known, rows, late)


def run(spark: SparkSession, envelopes: DataFrame, out_root: str, as_of: str | None = None,
        batch_id: str = "0") -> dict[str, str]:
    """Add one batch of parsed envelopes to the lake, in one commit; returns
    the tables' root folders (read them by :func:`table`). The same
    ``batch_id`` again replaces the batch."""
    lake = Lake(spark, out_root)
    stage = f"{out_root}/_stage/{lake.version}"

    def mine(name: str) -> set[str]:
        return {p for p in lake.parts(name) if p.split("/")[0] == f"batch_id={batch_id}"}

    replaced = None
    if batch_id in lake.done:
        replaced = _staged(lake.read("bronze", mine("bronze")).select("job_id").distinct(), f"{stage}/replaced")
    lake.stage("raw", envelopes.withColumn("batch_id", F.lit(batch_id)), ["batch_id"], mine("raw"))
    bronze = medallion.bronze(lake.read("raw", mine("raw")).drop("batch_id")).withColumn("batch_id", F.lit(batch_id))
    lake.stage("bronze", bronze, BRONZE_PARTITIONS, mine("bronze"))
    batch = lake.read("bronze", mine("bronze")).drop("batch_id")

    merged, touched, state = _new_silver(lake, batch, replaced, as_of, stage)
    state = _staged(state, f"{stage}/state")        # it reads the table that it replaces
    lake.stage("silver", merged, SILVER_PARTITIONS, touched)
    lake.stage("versions", state, [])
    for name, (build, key, lookup) in GOLD_TABLES.items():
        wanted = {_key_of_part(p, key) for p in touched}
        parts = {p for p in lake.parts("silver") if _key_of_part(p, key) in wanted}
        lake.stage(name, build(medallion.silver_latest(lake.read("silver", parts))), [key],
                   {f"{key}={value}" for value in wanted}, lookup)
    for name, source in SEARCH_TABLES.items():
        key = GOLD_TABLES[source][1]
        parts = {f"{key}={_key_of_part(p, key)}" for p in touched}
        lake.stage(name, documents.search_projection(lake.read(source, parts), name), [key], parts)
    lake.commit(batch_id)
    return {name: f"{out_root}/{name}" for name in TABLES}


def table(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """A table of the lake as of its last commit."""
    return Lake(spark, out_root).read(name)
