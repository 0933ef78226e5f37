"""Message sources (SR1–SR3) and medallion reads (SR4).

Every operator downstream accepts any DataFrame with the queue message
columns (key, value, topic, partition, offset, timestamp), so a queue, a
folder of replay files and a test DataFrame are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import schemas


def read_messages(spark: SparkSession, bootstrap: str, topic: str,
                  starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None) -> DataFrame:
    """SR1: queue source (needs the Kafka connector on the classpath; the
    reader fails at ``load`` without it). A trigger takes all that is there
    unless ``max_offsets_per_trigger`` says otherwise."""
    reader = (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", "false"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def read_message_files(spark: SparkSession, path: str, fmt: str = "parquet",
                       max_files_per_trigger: int | None = None, streaming: bool = True) -> DataFrame:
    """SR2: message columns from files, for replay and tests. The file rate
    limit stands in for offsets per trigger."""
    if not streaming:
        return spark.read.schema(schemas.MESSAGE).format(fmt).load(path)
    r = spark.readStream.schema(schemas.MESSAGE).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def read_json_records(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """SR3: crawled records as a JSON array, single object or NDJSON. A record
    is either a bare payload or ``{source_url, payload}``; both give
    (source_url, payload). Unparsable lines land in ``_corrupt_record``."""
    schema = T.StructType(list(schemas.PAYLOAD.fields) + [
        T.StructField("source_url", T.StringType(), True),
        T.StructField("payload", schemas.PAYLOAD, True),
        T.StructField("_corrupt_record", T.StringType(), True)])
    df = spark.read.schema(schema).option("multiLine", multiline) \
        .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    bare = F.struct(*[F.col(f.name) for f in schemas.PAYLOAD.fields])
    return df.select(F.col("source_url"), F.coalesce(F.col("payload"), bare).alias("payload"),
                     F.col("_corrupt_record"))


def read_layer(spark: SparkSession, path: str, **partition_filters) -> DataFrame:
    """SR4: a medallion table read with partition filters (posting_date,
    city_slug, date_key, month_key, week_key ...): the filters prune folders
    before any file is opened."""
    df = spark.read.parquet(path)
    for k, v in partition_filters.items():
        df = df.filter(F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(k) == v)
    return df
