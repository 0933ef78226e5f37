"""Dedup, versions, latest snapshot, upsert merge, deletion flag (K4–K9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bronze_dedup(df: DataFrame, key=("job_id", "hash_content", "ingest_date"),
                 order=("ingest_ts",)) -> DataFrame:
    """K4: one row per (job_id, hash_content, ingest_date); the earliest
    ``order`` wins (deterministic). Uses ``min_by`` so the work is a partial
    + final aggregate (map-side combine), safe for hot keys."""
    cols = [c for c in df.columns if c not in key]
    packed = F.struct(*[F.col(c) for c in cols])
    okey = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(*key).agg(F.min_by(packed, okey).alias("_row"),
                               F.count(F.lit(1)).alias("duplicate_count"))
    return agg.select(*key, "_row.*", "duplicate_count")


def latest_flag(key: list[str], order=("ingest_ts",)) -> Column:
    """K6: whether a row is the last one of its key in ``order``."""
    return F.lead(F.lit(1)).over(Window.partitionBy(*key).orderBy(*order)).isNull()


def versioned(df: DataFrame, key: str | list[str] = "job_id", order=("ingest_ts",),
              hash_col: str = "hash_content", with_latest_flag: bool = True,
              bucket: Column | None = None) -> DataFrame:
    """K5: ``record_version`` = 1 + number of content changes so far, in
    ``order`` within ``key`` (A -> B -> A counts as 3 versions), plus the K6
    latest flag (``is_latest``) from the same pass.

    With ``bucket`` (a column monotone in ``order``, e.g. the ingest day) the
    running count is a parallel prefix scan, so one key's history is not
    sorted in a single task:

    1. window over (key, bucket): changes inside the bucket so far;
    2. per (key, bucket) summary: first / last hash and change total; a
       window over the summaries (rows = buckets of a key) adds the changes
       of earlier buckets and at bucket boundaries;
    3. join the offsets back on (key, bucket) — the big side is already
       partitioned by (key, bucket) from step 1, so it is not shuffled again.
    """
    ordered = [F.col(c) for c in order]
    keys_ = [key] if isinstance(key, str) else list(key)
    if bucket is None:
        w = Window.partitionBy(*keys_).orderBy(*ordered)
        prev = F.lag(hash_col).over(w)
        changed = F.when(prev.isNotNull() & (F.col(hash_col) != prev), 1).otherwise(0)
        out = df.withColumn("_chg", changed) \
            .withColumn("record_version",
                        (F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1).cast("int"))
        if with_latest_flag:
            out = out.withColumn("is_latest", latest_flag(keys_, order))
        return out.drop("_chg")

    wb = Window.partitionBy(*keys_, "_bucket").orderBy(*ordered)
    prev = F.lag(hash_col).over(wb)
    local = df.withColumn("_bucket", bucket) \
        .withColumn("_chg", F.when(prev.isNotNull() & (F.col(hash_col) != prev), 1).otherwise(0)) \
        .withColumn("_local", F.sum("_chg").over(wb.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("_last_in_bucket", F.lead(F.lit(1)).over(wb).isNull()).drop("_chg")
    okey = F.struct(*ordered)
    summ = local.groupBy(*keys_, "_bucket").agg(
        F.max("_local").alias("_total"),
        F.min_by(hash_col, okey).alias("_first_hash"),
        F.max_by(hash_col, okey).alias("_last_hash"))
    ws = Window.partitionBy(*keys_).orderBy("_bucket")
    prev_last = F.lag("_last_hash").over(ws)
    summ = summ.withColumn("_boundary", F.when(prev_last.isNotNull() & (F.col("_first_hash") != prev_last), 1)
                           .otherwise(0))
    summ = summ.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys_)], F.col("_bucket").alias("_b"),
        (F.coalesce(F.sum(F.col("_total") + F.col("_boundary"))
                    .over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         + F.col("_boundary")).alias("_offset"),
        F.lead(F.lit(1)).over(ws).isNull().alias("_last_bucket"))
    cond = local["_bucket"] == summ["_b"]
    for i, k in enumerate(keys_):
        cond = cond & (local[k] == summ[f"_k{i}"])
    j = local.join(summ, cond)
    out = j.withColumn("record_version", (F.col("_offset") + F.col("_local") + 1).cast("int"))
    if with_latest_flag:
        out = out.withColumn("is_latest", F.col("_last_in_bucket") & F.col("_last_bucket"))
    return out.drop(*[f"_k{i}" for i in range(len(keys_))], "_b", "_bucket", "_local", "_last_in_bucket",
                    "_offset", "_last_bucket")


VERSION_STATE = ("last_order", "last_hash", "last_version")


def version_state(rows: DataFrame, key: str = "job_id", order=("ingest_ts",), hash_col: str = "hash_content") -> DataFrame:
    """What :func:`continue_versions` has to know of versioned rows: one row a
    key with its last order, hash and version."""
    okey = F.struct(*order)
    return rows.groupBy(key).agg(F.max(okey).alias("last_order"), F.max_by(hash_col, okey).alias("last_hash"),
                                 F.max_by("record_version", okey).alias("last_version"))


def continue_versions(batch: DataFrame, state: DataFrame, key: str = "job_id", order=("ingest_ts",),
                      hash_col: str = "hash_content", bucket: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """K5 for a new batch from kept state (:func:`version_state`), without the
    rows before it: ``(rows, late)``.

    ``rows``: the batch's rows with ``record_version`` and ``is_latest``
    (within the batch), for keys whose rows all come after the last row known.
    ``late``: the other keys; their whole history is needed
    (:func:`versioned`). Versions inside the batch are counted as there, and
    start where the state ends."""
    okey = F.struct(*order)
    start = (batch.groupBy(key).agg(F.min(okey).alias("_first"), F.min_by(hash_col, okey).alias("_first_hash"))
             .join(state.select(key, *VERSION_STATE), key, "left"))
    is_late = F.coalesce(F.col("_first") <= F.col("last_order"), F.lit(False))
    offset = F.coalesce(F.col("last_version") - 1 + (F.col("_first_hash") != F.col("last_hash")).cast("int"), F.lit(0))
    offsets = start.where(~is_late).select(key, offset.alias("_offset"))
    rows = versioned(batch, key, order, hash_col, bucket=bucket).join(offsets, key)
    return (rows.withColumn("record_version", (F.col("record_version") + F.col("_offset")).cast("int")).drop("_offset"),
            start.where(is_late).select(key))


def latest_snapshot(df: DataFrame, key: str | list[str] = "job_id",
                    order=("record_version", "ingest_ts")) -> DataFrame:
    """K6: one row per key: highest ``record_version``, ties -> latest
    ``ingest_ts`` (plus any extra tie-break columns in ``order``).

    ``max_by`` over a struct is a partial + final aggregate: a key holding a
    third of the rows is reduced map-side instead of landing in one task.
    """
    keys_ = [key] if isinstance(key, str) else list(key)
    cols = [c for c in df.columns if c not in keys_]
    packed = F.struct(*[F.col(c) for c in cols])
    okey = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys_).agg(F.max_by(packed, okey).alias("_row")).select(*keys_, "_row.*")


def upsert_merge(snapshot: DataFrame, batch: DataFrame, key: str = "job_id",
                 order=("record_version", "ingest_ts")) -> DataFrame:
    """Merge a new batch into a snapshot (union + K6)."""
    return latest_snapshot(snapshot.unionByName(batch, allowMissingColumns=True), key, order)


def deletion_flag(valid_through: Column | str, as_of) -> Column:
    """K9: ``is_deleted`` = posting expired before the as-of time. The as-of
    time is a parameter; batch jobs never read the wall clock."""
    v = F.col(valid_through) if isinstance(valid_through, str) else valid_through
    a = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    return F.coalesce(v < a, F.lit(False))
