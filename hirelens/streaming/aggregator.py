"""Stream C (realtime aggregator): clean events -> job counts and skill counts
per 10-minute window sliding by 1 minute -> keyed realtime tables.

One query reads and parses the source and appends all rows, good and bad, to a
folder; two aggregate queries and the dead letters stream from there. The
caller waits for any to stop (T9). In update mode the exact distinct company count is
``size(collect_set)`` (distinct aggregates are rejected on streaming plans);
in append mode it is a count of companies from chained aggregates.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hirelens.functions.constants import STREAM_C_WATERMARK
from hirelens.operators import messages, realtime
from hirelens.sinks import keyed
from hirelens.streaming.runs import make_dirs, run_id, state_settings

KEYS = {"realtime_job_counts_10m": ["time_bucket", "city", "employment_type"],
        "realtime_skill_counts": ["time_bucket", "city", "skill"]}


def aggregates(raw: DataFrame, watermark: str = STREAM_C_WATERMARK,
               approx_distinct: bool = False, output_mode: str = "update") -> dict[str, DataFrame]:
    """A3 and A4 over clean-event messages."""
    return clean_aggregates(messages.parse_clean(raw), watermark, approx_distinct, output_mode)


def clean_aggregates(clean: DataFrame, watermark: str = STREAM_C_WATERMARK, approx_distinct: bool = False,
                     output_mode: str = "update") -> dict[str, DataFrame]:
    options = {"watermark": watermark, "approx_distinct": approx_distinct, "output_mode": output_mode}
    return {"realtime_job_counts_10m": realtime.job_counts_sliding(clean, **options),
            "realtime_skill_counts": realtime.skill_counts_sliding(clean, **options)}


def start(raw: DataFrame, out_root: str, checkpoint_root: str, trigger: dict | None = None,
          watermark: str = STREAM_C_WATERMARK, output_mode: str = "update",
          approx_distinct: bool = False, fold_every: int | None = None) -> list[StreamingQuery]:
    """Update mode: each refresh is an upsert by the grouping key (the current
    view keeps the last write per key, no duplicate documents). Append mode:
    every window is written once, when it closes, from chained aggregates
    whose state is bounded (see :mod:`hirelens.operators.realtime`).
    Every ``fold_every`` batches the deltas are folded (:func:`keyed.fold`).
    ``approx_distinct`` keeps a bounded sketch instead of the set of companies
    of each open window. ``checkpoint_root`` must outlive the driver."""
    spark = raw.sparkSession
    run = run_id(spark, checkpoint_root)
    trigger = trigger or {"processingTime": "30 seconds"}
    path = os.path.join(out_root, "parsed", f"run={run}")
    parsed = messages.parse_clean_all(raw)

    def appended(df: DataFrame, to: str, name: str, *by: str) -> StreamingQuery:
        return (df.writeStream.outputMode("append").format("parquet").partitionBy(*by).option("path", to)
                .option("checkpointLocation", os.path.join(checkpoint_root, name))
                .queryName(f"realtime_{name}").trigger(**trigger).start())

    out = [appended(parsed, path, "parsed", "ok")]
    if trigger.get("availableNow") or trigger.get("once"):
        out[0].awaitTermination()
    make_dirs(spark, path)  # must exist before a stream reads it
    rows = spark.readStream.schema(parsed.schema).parquet(path)
    out.append(appended(messages.clean_failures(rows.where(~F.col("ok"))),
                        os.path.join(out_root, "dead_letter", f"run={run}"), "dead_letter"))
    clean = rows.where("ok").drop("raw_json", "topic", "errors", "ok")
    for name, agg in clean_aggregates(clean, watermark, approx_distinct, output_mode).items():
        root = os.path.join(out_root, name)

        def sink(batch: DataFrame, batch_id: int, _root=root, _key=KEYS[name]):
            keyed.write_delta(batch, _root, batch_id, run)
            keyed.fold_at(batch.sparkSession, _root, _key, batch_id, fold_every)

        with state_settings(spark):
            out.append(agg.writeStream.outputMode(output_mode).foreachBatch(sink)
                       .option("checkpointLocation", os.path.join(checkpoint_root, name))
                       .queryName(name).trigger(**trigger).start())
    return out


def await_any(spark: SparkSession, timeout: int | None = None) -> bool:
    """Block until any query stops (or the timeout passes)."""
    return spark.streams.awaitAnyTermination(timeout)
