"""Tables that readers see in one version: immutable folders and commit files.

A writer puts new data into folders that no reader looks at, then adds one
small numbered file that says which folders make up each table from now on.
Readers follow the highest number. So a writer that dies before its commit has
changed nothing, a reader keeps the version that it began with, and several
tables change together. Two writers can't both make the same commit: the
second fails. This names folders, no more; it is not a table format.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGITS = 12
LOOKUP_BLOCK = 4 << 20     # bytes of a row group of a lookup table


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it isn't there)."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


class CommitLog:
    """Numbered commit files of a folder, each a JSON object."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root}/_commits"

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in children(self.spark, self.folder) if n.endswith(".json")]

    def read(self, number: int) -> dict:
        p, fs = _path(self.spark, f"{self.folder}/{number:0{_DIGITS}}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """The last commit; number 0 and nothing before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def commit(self, number: int, state: dict) -> None:
        """Make ``state`` commit ``number``: written aside, then renamed, which
        fails if that commit exists."""
        final, fs = _path(self.spark, f"{self.folder}/{number:0{_DIGITS}}.json")
        aside, _ = _path(self.spark, f"{self.folder}/_{number}-{self.spark._jvm.java.util.UUID.randomUUID()}")
        out = fs.create(aside, False)
        try:
            out.write(json.dumps(state, sort_keys=True).encode())
        finally:
            out.close()
        if fs.exists(final) or not fs.rename(aside, final):
            fs.delete(aside, False)
            raise RuntimeError(f"commit {number} of {self.folder} was made by another writer")


class Lake:
    """Partitioned tables below one root whose partitions are replaced
    together. A commit holds, per table, its schema and the folder of each of
    its partitions: metadata of one entry a partition, kept on the driver."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.log = spark, root, CommitLog(spark, root)
        self.number, state = self.log.latest()
        self.tables: dict[str, dict] = state.get("tables", {})
        self.done: dict[str, int] = state.get("done", {})
        self.version = f"v={self.number + 1:0{_DIGITS}}-{self.spark._jvm.java.util.UUID.randomUUID().toString()[:8]}"

    def parts(self, table: str) -> dict[str, str]:
        """Partition -> version folder."""
        return self.tables.get(table, {}).get("parts", {})

    def read(self, table: str, only: set[str] | None = None) -> DataFrame:
        """The rows of a table (of the partitions named, if any are), staged
        ones included; no other folder is listed."""
        schema = T.StructType.fromJson(self.tables[table]["schema"])
        paths = [f"{self.root}/{table}/{folder}/{part}".rstrip("/") for part, folder in self.parts(table).items()
                 if only is None or part in only]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("v", T.StringType())]))
        return rows.option("basePath", f"{self.root}/{table}").parquet(*paths).select(*schema.names)

    def stage(self, table: str, df: DataFrame, by: list[str], replaces: set[str] | None = None,
              lookup: list[str] | None = None) -> None:
        """Write ``df`` as the new content of its partitions, and of those that
        it ``replaces`` (without rows there, they go). No other reader sees it
        before :meth:`commit`. ``replaces=None``: ``df`` is the whole table.

        ``lookup``: columns that readers look rows up by. Files and their small
        row groups are then in this order, so the bounds of a row group tell
        whether it can hold a key; the first column has a Bloom filter too."""
        path = f"{self.root}/{table}/{self.version}"
        if lookup:
            order = [*by, *lookup]
            writer = df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite") \
                .option(f"parquet.bloom.filter.enabled#{lookup[0]}", "true").option("parquet.block.size", LOOKUP_BLOCK)
        else:
            # Rows of a partition meet in one task for writing; Spark splits what is too large for one.
            writer = (df.hint("rebalance", *by) if by else df).write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(path)
        kept = {} if replaces is None else {p: f for p, f in self.parts(table).items() if p not in replaces}
        new = dict.fromkeys(_partitions(self.spark, path, len(by)), self.version)
        self.tables = self.tables | {table: {"schema": df.schema.jsonValue(), "parts": kept | new}}

    def commit(self, batch: str) -> None:
        """Show all that was staged, as the work of ``batch``."""
        self.log.commit(self.number + 1, {"tables": self.tables, "done": self.done | {batch: self.number + 1}})
        self.number += 1
        self.done = self.done | {batch: self.number}

    def clean(self, keep: int = 2) -> None:
        """Remove version folders that none of the last ``keep`` commits names
        (and that aren't newer than these: a writer may still fill them)."""
        numbers = self.log.numbers()[-keep:]
        states = [self.log.read(n)["tables"] for n in numbers]
        for table in {t for s in states for t in s}:
            named = {folder for s in states for folder in s.get(table, {}).get("parts", {}).values()}
            for folder in children(self.spark, f"{self.root}/{table}"):
                if folder.startswith("v=") and folder not in named and int(folder[2:2 + _DIGITS]) <= numbers[-1]:
                    remove(self.spark, f"{self.root}/{table}/{folder}")


def _partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders below ``path``, ``depth`` levels down."""
    found = [""]
    for _ in range(depth):
        found = [f"{p}/{c}".lstrip("/") for p in found for c in children(spark, f"{path}/{p}".rstrip("/")) if "=" in c]
    return found


def partition_names(df: DataFrame, by: list[str]) -> set[str]:
    """The folder names of the partitions that hold the rows of ``df``, whose
    columns ``by`` are dates or plain slugs. Only these come to the driver."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")) for c in by]
    names = [F.when(n == "", F.lit("__HIVE_DEFAULT_PARTITION__")).otherwise(n) for n in names]
    rows = df.select(F.concat_ws("/", *[F.concat(F.lit(f"{c}="), n) for c, n in zip(by, names)]).alias("p")).distinct()
    return {r["p"] for r in rows.collect()}
