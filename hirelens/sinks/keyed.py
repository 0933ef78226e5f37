"""Keyed upsert tables on plain Parquet (SK2, SK5).

Each micro-batch is written by the executors to ``<root>/run=R/batch_id=N``
with ``mode("overwrite")`` on that folder only: a retried batch rewrites the
same folder, and a run that lost its checkpoint has another ``R`` (see
:mod:`hirelens.streaming.runs`), so no delta is overwritten by another. The
current view is a last-write-wins aggregate over the base (if deltas have been
folded into one) and the deltas since, plus a time-to-live filter. ``fold``
makes a new base; ``compact`` writes the view as a table of the same layout.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.functions.constants import SPEED_VIEW_TTL_SECONDS
from hirelens.sinks.commits import CommitLog, children, remove
from hirelens.streaming.runs import path_exists


def delta_path(root: str, batch_id: int, run: str) -> str:
    return f"{root}/run={run}/batch_id={batch_id}"


def write_delta(df: DataFrame, root: str, batch_id: int, run: str, updated_at: Column | None = None) -> None:
    """Write one micro-batch of keyed rows (executor side, errors propagate
    so the batch is retried instead of committed)."""
    ua = updated_at if updated_at is not None else F.current_timestamp()
    df.withColumn("updated_at", ua).write.mode("overwrite").parquet(delta_path(root, batch_id, run))


def current_view(spark: SparkSession, root: str, key: list[str], ttl_seconds: int | None = None,
                 as_of: Column | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Last write wins per key by (updated_at, batch_id); rows older than the
    TTL (by ``updated_at``) are hidden. ``max_by`` keeps it a partial +
    final aggregate. A table without a batch yet is empty if its row
    ``schema`` (without ``updated_at``) is given, else an error."""
    deltas = _stored(spark, root)
    if deltas is None:
        if schema is None:
            raise FileNotFoundError(f"no batch below {root} yet, and no schema given")
        extra = [T.StructField("updated_at", T.TimestampType()), T.StructField("run", T.StringType()),
                 T.StructField("batch_id", T.LongType())]
        deltas = spark.createDataFrame([], T.StructType([*schema.fields, *extra]))
    cols = [c for c in deltas.columns if c not in key]
    latest = deltas.groupBy(*key).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct("updated_at", "batch_id")).alias("_r")) \
        .select(*key, "_r.*").drop("run")
    if ttl_seconds is not None:
        now = as_of if as_of is not None else F.current_timestamp()
        latest = latest.filter(F.col("updated_at") >= now - F.make_dt_interval(secs=F.lit(ttl_seconds)))
    return latest


def _deltas(spark: SparkSession, root: str, folded: dict[str, int]) -> dict[str, list[int]]:
    """Run -> numbers of the finished batches that aren't in the base."""
    found = {}
    for folder in children(spark, root):
        if folder.startswith("run="):
            run = folder.removeprefix("run=")
            batches = [int(b.removeprefix("batch_id=")) for b in children(spark, f"{root}/{folder}") if b.startswith("batch_id=")]
            found[run] = [b for b in batches if b > folded.get(run, -1)
                          and path_exists(spark, f"{delta_path(root, b, run)}/_SUCCESS")]
    return found


def _stored(spark: SparkSession, root: str) -> DataFrame | None:
    """All rows of the table's last version: its base and the deltas that the
    base doesn't hold; None if there is neither."""
    _, state = CommitLog(spark, root).latest()
    parts = []
    if state:
        parts.append(spark.read.parquet(f"{root}/{state['base']}"))
    paths = [delta_path(root, b, run) for run, batches in _deltas(spark, root, state.get("folded", {})).items() for b in batches]
    if paths:
        parts.append(spark.read.option("basePath", root).parquet(*paths))
    parts = [p.withColumn("run", F.col("run").cast("string")).withColumn("batch_id", F.col("batch_id").cast("bigint"))
             for p in parts]
    return functools.reduce(DataFrame.unionByName, parts) if parts else None


def fold(spark: SparkSession, root: str, key: list[str], ttl_seconds: int | None = None,
         as_of: Column | None = None) -> int:
    """Fold the deltas so far into a new base; with a TTL, expired rows go for
    good. Starts from the last base, so each delta is folded once. Readers see
    the new base and the deltas after it from one commit on; what the commit
    before had folded is removed now, so that a reader of the last version may
    still finish. Returns the number of the commit."""
    log = CommitLog(spark, root)
    number, state = log.latest()
    folded = state.get("folded", {})
    new = {run: max(batches) for run, batches in _deltas(spark, root, folded).items() if batches}
    if not new:
        return number
    base = f"_base/v={number + 1}"
    current_view(spark, root, key, ttl_seconds, as_of).withColumn("run", F.lit("")).write.mode("overwrite").parquet(f"{root}/{base}")
    log.commit(number + 1, {"base": base, "folded": folded | new})
    for run, upto in folded.items():
        for folder in children(spark, f"{root}/run={run}"):
            if folder.startswith("batch_id=") and int(folder.removeprefix("batch_id=")) <= upto:
                remove(spark, f"{root}/run={run}/{folder}")
    if number > 1:
        remove(spark, f"{root}/_base/v={number - 1}")
    return number + 1


def fold_at(spark: SparkSession, root: str, key: list[str], batch_id: int, every: int | None) -> None:
    """Fold after every so many batches of a stream (None: never). A batch that
    is written again after a failure is folded at most once."""
    if every and batch_id % every == every - 1:
        fold(spark, root, key)


def compact(spark: SparkSession, root: str, key: list[str], out: str, ttl_seconds: int | None = None,
            as_of: Column | None = None) -> None:
    """Write the current view to ``out``, a new table that :func:`current_view`
    reads and streams may add deltas to; with a TTL, expired rows go for good.
    Rows keep their ``updated_at``, so later deltas still win."""
    current_view(spark, root, key, ttl_seconds, as_of).drop("batch_id") \
        .write.mode("overwrite").parquet(delta_path(out, 0, "compacted"))


def speed_view_rows(agg: DataFrame, view: str, field_col: str, value_col: str,
                    ttl_seconds: int = SPEED_VIEW_TTL_SECONDS) -> DataFrame:
    """SK5: windowed aggregate -> keyed rows (view, window_start, window_end,
    field, value, expires_at). The latest-window index is ``max(window_end)``
    of a view (see :func:`hirelens.operators.serving.latest_window`)."""
    end = F.to_timestamp("window_end")
    return agg.select(
        F.lit(view).alias("view"), "window_start", "window_end",
        F.coalesce(F.col(field_col), F.lit("unknown")).alias("field"),
        F.col(value_col).cast("bigint").alias("value"),
        F.date_format(end + F.make_dt_interval(secs=F.lit(ttl_seconds)), "yyyy-MM-dd HH:mm:ss").alias("expires_at"))
