"""Windowed realtime aggregates (A1–A4) and stream dedup (K7).

The same builder serves a static DataFrame and a streaming one; output names
and types are the same. Where the best plan differs (distinct counts, sliding
windows) the builder checks ``df.isStreaming``.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hirelens.functions import enums
from hirelens.functions.agg import cents, money_mean


def _bounds(window_col: str = "window"):
    return [F.date_format(F.col(f"{window_col}.start"), "yyyy-MM-dd HH:mm:ss").alias("window_start"),
            F.date_format(F.col(f"{window_col}.end"), "yyyy-MM-dd HH:mm:ss").alias("window_end")]


def dedup_jobs(df: DataFrame, key: str = "job_id", ts: str = "event_ts",
               watermark: str | None = "30 minutes", tie: str = "source_url") -> DataFrame:
    """K7: one event per job_id.

    Streaming: ``withWatermark`` + ``dropDuplicatesWithinWatermark`` (state
    expires with the watermark). Batch: the earliest event per key, ties by
    ``tie`` — deterministic, via a partial + final ``min_by`` aggregate.
    """
    if df.isStreaming:
        return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])
    cols = [c for c in df.columns if c != key]
    row = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(ts), F.col(tie)))
    return df.groupBy(key).agg(row.alias("_r")).select(key, "_r.*")


def job_counts_10m(df: DataFrame, ts: str = "event_ts", city: str = "location_city") -> DataFrame:
    """A1: jobs per 10-minute tumbling window and city."""
    return df.groupBy(F.window(ts, "10 minutes"), F.col(city)) \
        .agg(F.count(F.lit(1)).alias("job_count")) \
        .select(*_bounds(), F.col(city).alias("location_city"), "job_count")


def skill_counts_30m(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """A2: skill counts per 30-minute window sliding by 10 minutes; empty
    skills dropped. Narrow select before the explode."""
    ex = df.select(ts, F.explode_outer("skills").alias("skill")) \
        .filter(F.col("skill").isNotNull() & (F.length("skill") > 0))
    return ex.groupBy(F.window(ts, "30 minutes", "10 minutes"), "skill") \
        .agg(F.count(F.lit(1)).alias("skill_count")) \
        .select(*_bounds(), "skill", "skill_count")


# Windows are put together in blocks of so many window lengths.
_BLOCK_WINDOWS = 6


def _sliced(df: DataFrame, ts: str, keys: list[str], window_min: int, slide_min: int,
            sums: list[str]) -> DataFrame:
    """Batch plan for sliding windows, exact for counts, sums and distinct
    companies. Rows are counted per slide-sized slice, key and company; a
    company counts in a window at its first slice there, so in those windows
    that begin after its slice before (``_gap`` slices back). Slices of a key,
    with the gaps of their companies, are then dealt by blocks of time, and
    only there expanded to the windows that cover them: no company and no
    shuffle is multiplied by the windows."""
    slide_s = slide_min * 60
    n = window_min // slide_min
    block = n * _BLOCK_WINDOWS
    sl = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / slide_s)
    aggs = [F.count("job_id").alias("_cnt")]
    for c in sums:
        aggs += [F.sum(cents(c)).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}")]
    names = ["_cnt", *[f"{p}_{c}" for c in sums for p in ("_s", "_n")]]
    add = [F.sum(c).alias(c) for c in names]
    pre = df.withColumn("_slice", sl).groupBy("_slice", *keys, "company_name").agg(*aggs)
    before = F.lag("_slice").over(Window.partitionBy(*keys, "company_name").orderBy("_slice"))
    # Rows without a time are one window, where each company counts once.
    gap = F.when(F.col("_slice").isNull(), 1).otherwise(F.least(F.lit(n), F.coalesce(F.col("_slice") - before, F.lit(n))))
    slices = pre.withColumn("_gap", gap.cast("int")).groupBy("_slice", *keys, "_gap") \
        .agg(F.count("company_name").alias("_companies"), *add)

    def block_of(slice_) -> Column:
        return F.floor(slice_ / block)

    dealt = slices.withColumn("_block", F.explode_outer(F.sequence(block_of(F.col("_slice") - (n - 1)), block_of(F.col("_slice"))))) \
        .repartition("_block", *keys)
    ex = dealt.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))) \
        .withColumn("_start", F.col("_slice") - F.col("_k")) \
        .where(block_of(F.col("_start")).eqNullSafe(F.col("_block")))
    first = F.sum(F.when(F.col("_k") < F.col("_gap"), F.col("_companies")))
    out = ex.groupBy("_block", *keys, "_start").agg(*add, first.alias("distinct_company_count"))
    start = F.timestamp_seconds(F.col("_start") * slide_s)
    return out.select(
        enums.time_bucket(start).alias("time_bucket"),
        F.date_format(start + F.make_dt_interval(mins=F.lit(window_min)),
                      "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        *keys, F.coalesce(F.col("_cnt"), F.lit(0)).cast("bigint").alias("job_count"),
        F.coalesce(F.col("distinct_company_count"), F.lit(0)).cast("bigint").alias("distinct_company_count"),
        *[money_mean(F.col(f"_s_{c}"), F.col(f"_n_{c}")).alias(f"avg_{c}") for c in sums])


def _streaming_sliding(df: DataFrame, ts: str, keys: list[str], window_min: int, slide_min: int,
                       sums: list[str], watermark: str, approx_distinct: bool = False) -> DataFrame:
    """Streaming plan: native sliding window with watermark; exact distinct
    as ``size(collect_set)`` (distinct aggregates are rejected on streams),
    or a bounded HyperLogLog sketch with ``approx_distinct``."""
    distinct = F.approx_count_distinct("company_name") if approx_distinct \
        else F.size(F.collect_set("company_name"))
    aggs = [F.count("job_id").alias("job_count"),
            distinct.cast("bigint").alias("distinct_company_count")]
    for c in sums:
        aggs.append(money_mean(F.sum(cents(c)), F.count(c)).alias(f"avg_{c}"))
    g = df.withWatermark(ts, watermark) \
        .groupBy(F.window(ts, f"{window_min} minutes", f"{slide_min} minutes"), *keys).agg(*aggs)
    return g.select(enums.time_bucket("window.start").alias("time_bucket"),
                    F.date_format("window.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
                    *keys, "job_count", "distinct_company_count", *[f"avg_{c}" for c in sums])


# Companies of a key are dealt to so many groups of one state entry each. A
# checkpoint holds the number: a stream that has one can't change it.
_GROUPS = 4096


def _slice_gaps(who: T.StructType, out: T.StructType, n: int, slide_s: int) -> StatefulProcessor:
    """How many slices ago a company was last seen with the same keys (at most
    ``n``), for rows (group, slice, *who, ...) of closed slices: these come
    after all slices of the batches before. The state of a group are the
    companies of its last ``n`` slices, each with its last slice."""
    width, row_of = len(who), Row(*out.names)
    state = T.StructType([*who.fields, T.StructField("_slice", T.LongType())])
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)

    # A local class goes to the worker by value: Spark's driver-side worker need not find this module.
    class SliceGaps(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getListState("last", state)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            last = {tuple(r[:width]): r[width] for r in self.last.get()}
            at = None
            for row in sorted(rows, key=lambda r: r[1]):
                at, seen = row[1], tuple(row[2:width + 2])
                gap = min(n, at - last.get(seen, at - n))
                last[seen] = at
                end = epoch + timedelta(seconds=(at + 1) * slide_s, microseconds=-1)
                yield row_of(end, gap, *row[1:])
            if at is not None:
                self.last.put([(*seen, s) for seen, s in last.items() if s > at - n])

    return SliceGaps()


def _chained_sliding(df: DataFrame, ts: str, keys: list[str], window_min: int, slide_min: int,
                     sums: list[str], watermark: str) -> DataFrame:
    """Streaming plan for append mode: three stateful operators in one query.
    Rows are first counted per slide-sized slice, key and company. A closed
    slice of a company gets its gap (:func:`_slice_gaps`): as in the batch plan
    a company counts in those windows that begin after its slice before. So
    slices fan out to the windows that cover them without their companies, and
    are added up before they are shuffled or kept. No state is multiplied by
    the windows but that of the result's own rows, and all of it leaves when
    its slice or window closes. The result has closed windows only."""
    slide_s = slide_min * 60
    n = window_min // slide_min
    names = ["_cnt", *[f"{p}_{c}" for c in sums for p in ("_s", "_n")]]
    first = [F.count("job_id").alias("_cnt")]
    for c in sums:
        first += [F.coalesce(F.sum(cents(c)), F.lit(0)).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}")]
    who = [*keys, "company_name"]
    slices = df.withWatermark(ts, watermark).groupBy(F.window(ts, f"{slide_min} minutes"), *who).agg(*first) \
        .select(F.pmod(F.xxhash64(*who), F.lit(_GROUPS)).alias("_group"),
                F.floor(F.unix_seconds("window.start") / slide_s).alias("_slice"), *who, *names)
    types = slices.select(*who, *names).schema
    told = T.StructType([T.StructField("_time", T.TimestampType()), T.StructField("_gap", T.LongType()),
                         T.StructField("_slice", T.LongType()), *types.fields])
    gaps = slices.groupBy("_group").transformWithState(
        _slice_gaps(types[:len(who)], told, n, slide_s), told, "append", "eventTime", eventTimeColumnName="_time")
    ex = gaps.withColumn("window", F.window("_time", f"{window_min} minutes", f"{slide_min} minutes"))
    back = F.col("_slice") - F.floor(F.unix_seconds("window.start") / slide_s)
    out = ex.groupBy("window", *keys).agg(
        *[F.sum(c).alias(c) for c in names],
        F.count(F.when(back < F.col("_gap"), F.col("company_name"))).alias("distinct_company_count"))
    return out.select(enums.time_bucket("window.start").alias("time_bucket"),
                      F.date_format("window.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
                      *keys, F.col("_cnt").alias("job_count"), "distinct_company_count",
                      *[money_mean(F.col(f"_s_{c}"), F.col(f"_n_{c}")).alias(f"avg_{c}") for c in sums])


def _stream_plan(df: DataFrame, ts: str, keys: list[str], window_min: int, slide_min: int, sums: list[str],
                 watermark: str, approx_distinct: bool, output_mode: str) -> DataFrame:
    if output_mode == "append" and not approx_distinct:
        return _chained_sliding(df, ts, keys, window_min, slide_min, sums, watermark)
    return _streaming_sliding(df, ts, keys, window_min, slide_min, sums, watermark, approx_distinct)


def job_counts_sliding(df: DataFrame, ts: str = "event_time", window_min: int = 10,
                       slide_min: int = 1, watermark: str = "10 minutes",
                       approx_distinct: bool = False, output_mode: str = "update") -> DataFrame:
    """A3: jobs + distinct companies per (10-minute window sliding by 1
    minute, city, employment type). On a stream, append mode uses the chained
    plan (:func:`_chained_sliding`); update mode can't chain aggregates."""
    keys = ["city", "employment_type"]
    if df.isStreaming:
        return _stream_plan(df, ts, keys, window_min, slide_min, [], watermark, approx_distinct, output_mode)
    return _sliced(df, ts, keys, window_min, slide_min, [])


def skill_counts_sliding(df: DataFrame, ts: str = "event_time", window_min: int = 10,
                         slide_min: int = 1, watermark: str = "10 minutes",
                         approx_distinct: bool = False, output_mode: str = "update") -> DataFrame:
    """A4: per (window, skill, city): jobs, distinct companies, average
    salaries. Skills exploded first, empty skills dropped. Plans as in A3."""
    ex = df.select("job_id", "company_name", "city", "salary_min", "salary_max", ts,
                   F.explode("skills").alias("skill")) \
        .filter(F.col("skill").isNotNull() & (F.col("skill") != ""))
    keys = ["skill", "city"]
    sums = ["salary_min", "salary_max"]
    if df.isStreaming:
        return _stream_plan(ex, ts, keys, window_min, slide_min, sums, watermark, approx_distinct, output_mode)
    return _sliced(ex, ts, keys, window_min, slide_min, sums)
