"""Stream B (consumer): envelope messages -> job documents, keyed jobs table,
clean events and dead letters, all from one micro-batch.

The batch is persisted once and every output is an executor-side DataFrame
write; a failing write raises, so the batch is retried rather than committed
with lost rows. Per-batch counts (messages, ok, dead letters) are observed
metrics visible in ``query.lastProgress``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hirelens import schemas
from hirelens.operators import messages
from hirelens.sinks import documents, keyed
from hirelens.streaming.runs import run_id

DOC_INDEX = "jobs_realtime_v1"


def transformed(raw: DataFrame) -> DataFrame:
    """V2 + consumer transform, with observed batch metrics."""
    tr = messages.consumer_transform(messages.parse_envelope(raw))
    return tr.observe("consumer_metrics",
                      F.count(F.lit(1)).alias("batch_count"),
                      F.count_if(F.size("errors") == 0).alias("ok_count"),
                      F.count_if(F.size("errors") > 0).alias("dead_letter_count"))


def clean_event_messages(tr: DataFrame) -> DataFrame:
    """SK3: good rows as clean events, (key = job_id, value = JSON) messages.
    The event time keeps its time of day; the message time stands in for one
    that is missing."""
    value = F.to_json(F.struct(
        "job_id", "company_name", "city", "employment_type",
        "salary_min", "salary_max", "skills", "event_ts"))
    return tr.filter(F.size("errors") == 0).select(F.col("job_id").alias("key"), value.alias("value"))


def process_batch(batch: DataFrame, batch_id: int, out_root: str, run: str) -> None:
    """One micro-batch -> four outputs; each write overwrites only its
    own run's ``batch_id`` folder, so a retried batch is idempotent."""
    batch.persist()
    try:
        docs = messages.job_documents(batch)
        documents.write_bulk(docs, keyed.delta_path(f"{out_root}/documents", batch_id, run),
                             "job_id", DOC_INDEX, schemas.JOB_DOCUMENT_FIELDS)
        keyed.write_delta(docs.select("job_id", "job_title", "company_name", "city", "salary_min",
                                      "salary_max", "employment_type", "skills", "event_date"),
                          os.path.join(out_root, "jobs_streaming"), batch_id, run)
        clean_event_messages(batch).write.mode("overwrite").parquet(
            keyed.delta_path(f"{out_root}/jobs_clean", batch_id, run))
        messages.dead_letters(batch).write.mode("overwrite").parquet(
            keyed.delta_path(f"{out_root}/dead_letter", batch_id, run))
    finally:
        batch.unpersist()


def start(raw: DataFrame, out_root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """``checkpoint`` must be a folder that outlives the driver; without the
    old one, a restart is a new run beside the old outputs."""
    run = run_id(raw.sparkSession, checkpoint)
    trigger = trigger or {"processingTime": "10 seconds"}
    return (transformed(raw).writeStream.outputMode("append")
            .foreachBatch(lambda b, i: process_batch(b, i, out_root, run))
            .option("checkpointLocation", checkpoint).queryName("consumer")
            .trigger(**trigger).start())
