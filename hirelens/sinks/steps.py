"""Steps of a job as stored tables: what a step has shuffled goes when it ends."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _cleaned(spark: SparkSession):
    kept = spark.conf.get(_SHUFFLE_CLEANUP)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, kept)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table at ``path``; the shuffle files of the write go with it."""
    spark = df.sparkSession
    with _cleaned(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, path: str, key: str, buckets: int, *by: str) -> DataFrame:
    """:func:`written`, in buckets of ``key`` (sorted ``by``): who needs the rows
    of a key together reads a bucket, and shuffles nothing. Only the catalog can say
    that a table has buckets; it forgets the name at once, the files stay."""
    spark, name = df.sparkSession, f"step_{uuid.uuid4().hex}"
    with _cleaned(spark):
        writer = df.write.format("parquet").option("compression", "zstd").bucketBy(buckets, key).option("path", path)
        (writer.sortBy(*by) if by else writer).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table
