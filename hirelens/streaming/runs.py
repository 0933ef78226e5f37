"""Identity of a streaming run: one name for as long as its checkpoint lives.

Micro-batches are numbered from 0 again when a checkpoint is lost. Outputs are
therefore named by run and batch: a restart from a kept checkpoint rewrites
its own unfinished batch, a restart without it writes beside the old batches.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import SparkSession

# State lies in RocksDB, on local disk with bounded memory, and a checkpoint
# keeps the versions that a restart can ask for.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def state_partitions(spark: SparkSession) -> int:
    """One state partition a core, and no more than shuffles have. Each costs a
    task, files and its metrics in every micro-batch (the metrics of a task grow
    with the partitions, too), whatever it holds."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(8, spark.sparkContext.defaultParallelism))


@contextlib.contextmanager
def state_settings(spark: SparkSession):
    """Queries started within get :data:`STATE_CONF` and
    :func:`state_partitions`; a query that has a checkpoint keeps the partitions
    that it began with. The session's own settings are as before afterwards."""
    conf = {**STATE_CONF, "spark.sql.shuffle.partitions": str(state_partitions(spark))}
    kept = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def fresh_name(name: str) -> str:
    """``name`` and a suffix that no other folder has."""
    return f"{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def make_dirs(spark: SparkSession, path: str) -> None:
    """Create a folder in the file system that Spark itself reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The run's id, kept beside the checkpoint's own folders."""
    path = f"{checkpoint}/run_id"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([(uuid.uuid4().hex,)], "id string").coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).first()[0]
