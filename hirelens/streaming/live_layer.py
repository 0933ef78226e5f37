"""Stream A (live layer): validate -> clean -> normalize -> watermark + dedup
-> two window aggregates -> speed-view tables.

One query reads the source once, deduplicates and appends normalized events
to a silver folder; both aggregates read that folder as a stream (each its own
state and checkpoint) and write keyed speed-view rows through ``foreachBatch``
on the executors. A third, stateless query writes rows that can't be used to
the dead-letter output.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from hirelens import schemas
from hirelens.functions.constants import STREAM_A_WATERMARK
from hirelens.operators import messages, realtime
from hirelens.sinks import keyed
from hirelens.streaming.runs import make_dirs, run_id, state_settings


def main_stream(raw: DataFrame, watermark: str = STREAM_A_WATERMARK, dedup: bool = True) -> DataFrame:
    """Messages -> normalized, deduplicated events."""
    norm = messages.normalize_events(messages.clean_events(
        messages.parse_messages(raw, schemas.RAW_EVENT)))
    if not dedup:
        return norm.withWatermark("event_ts", watermark) if raw.isStreaming else norm
    return realtime.dedup_jobs(norm, watermark=watermark)


def aggregates(main: DataFrame) -> dict[str, DataFrame]:
    """A1 and A2 over the main stream (watermark inherited from it)."""
    return {"job_counts_10m": realtime.job_counts_10m(main),
            "skill_counts_30m": realtime.skill_counts_30m(main)}


VIEW_FIELDS = {"job_counts_10m": ("location_city", "job_count"),
               "skill_counts_30m": ("skill", "skill_count")}


VIEW_KEY = ["view", "window_start", "field"]


def start(raw: DataFrame, out_root: str, checkpoint_root: str, trigger: dict | None = None,
          watermark: str = STREAM_A_WATERMARK, output_mode: str = "update",
          fold_every: int | None = None) -> list[StreamingQuery]:
    """Start the live layer as four queries:

    1. ``silver``: messages -> normalized, deduplicated events, appended to
       ``out_root/silver/run=R`` (one dedup state);
    2. two aggregate queries (A1, A2) that read the silver folder as a
       stream, in update mode, each micro-batch written as keyed speed-view
       rows under ``out_root/<view>/run=R/batch_id=N`` (idempotent on retry);
    3. ``dead_letter``: rows that don't parse, or lack a job id or a time.

    Every ``fold_every`` batches a view's deltas are folded (:func:`keyed.fold`).
    ``checkpoint_root`` must be a folder that outlives the driver. Without
    the old one, a restart is a new run ``R`` beside the old outputs.

    With a run-to-completion trigger the silver query finishes before the
    aggregates start, so they see all of it.
    """
    trigger = trigger or {"processingTime": "10 seconds"}
    spark = raw.sparkSession
    run = run_id(spark, checkpoint_root)
    silver_path = os.path.join(out_root, "silver", f"run={run}")
    main = main_stream(raw, watermark)
    with state_settings(spark):
        silver = (main.drop("raw_json").writeStream.outputMode("append").format("parquet")
                  .option("path", silver_path).option("checkpointLocation", os.path.join(checkpoint_root, "silver"))
                  .queryName("speed_silver").trigger(**trigger).start())
    dead = messages.event_dead_letters(messages.parse_messages(raw, schemas.RAW_EVENT))
    queries = [silver, dead.writeStream.outputMode("append").format("parquet")
               .option("path", os.path.join(out_root, "dead_letter", f"run={run}"))
               .option("checkpointLocation", os.path.join(checkpoint_root, "dead_letter"))
               .queryName("speed_dead_letter").trigger(**trigger).start()]
    if trigger.get("availableNow") or trigger.get("once"):
        silver.awaitTermination()
    schema = main.drop("raw_json").schema
    make_dirs(spark, silver_path)  # must exist before a stream reads it
    events = spark.readStream.schema(schema).parquet(silver_path).withWatermark("event_ts", watermark)
    for view, agg in aggregates(events).items():
        field, value = VIEW_FIELDS[view]
        root = os.path.join(out_root, view)

        def sink(batch: DataFrame, batch_id: int, _view=view, _root=root, _f=field, _v=value):
            keyed.write_delta(keyed.speed_view_rows(batch, _view, _f, _v), _root, batch_id, run)
            keyed.fold_at(batch.sparkSession, _root, VIEW_KEY, batch_id, fold_every)

        with state_settings(spark):
            q = (agg.writeStream.outputMode(output_mode).foreachBatch(sink)
                 .option("checkpointLocation", os.path.join(checkpoint_root, view))
                 .queryName(f"speed_{view}").trigger(**trigger).start())
        queries.append(q)
    return queries


def start_console(raw: DataFrame, checkpoint_root: str, watermark: str = STREAM_A_WATERMARK,
                  fmt: str = "console", name: str = "speed_main") -> StreamingQuery:
    """SK6: debug output of the main stream (console or memory sink)."""
    w = main_stream(raw, watermark).writeStream.outputMode("append").format(fmt) \
        .option("checkpointLocation", os.path.join(checkpoint_root, "main_" + fmt))
    if fmt == "memory":
        w = w.queryName(name)
    else:
        w = w.option("truncate", False).option("numRows", 10)
    return w.start()
