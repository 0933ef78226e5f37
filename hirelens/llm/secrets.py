"""Secret scans over content-addressed versions with an incremental ledger.

Every version of every path is named by the SHA-256 of its bytes (its blob).
The ledger has a row for each pair of blob and rule version that was scanned.
A run scans only the pairs that the ledger lacks, appends them, and joins the
ledger's findings back to all paths that hold the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import digest, fresh_path, table, written


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if ``group`` has ``least`` characters.

    Raise ``version`` with every change: blobs are then scanned anew for this
    rule, and only for it."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    flags: int = 0


# The rules in their order of report.
RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12, re.ASCII | re.IGNORECASE),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    # The same matches as [0-9a-f]+ of 16 or more: a run is always taken whole.
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
)
LEDGER = T.StructType([
    T.StructField("blob", T.BinaryType()),
    T.StructField("kind", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
])
_ARROW = pa.schema([("blob", pa.binary()), ("kind", pa.string()), ("version", pa.int32()),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def scan(text: str, rule: Rule) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches as [start, end) in code points."""
    return [m.span() for m in re.finditer(rule.pattern, text, rule.flags)
            if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _scan_batches(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...]) -> Iterator[pa.RecordBatch]:
    by_name = {f"{r.kind}:{r.version}": r for r in rules}
    for batch in batches:
        rows = []
        for blob, text, names in zip(batch["blob"], batch["text"], batch["todo"]):
            text = text.as_py()
            for name in names.as_py():
                rule = by_name[name]
                rows.append({"blob": blob.as_py(), "kind": rule.kind, "version": rule.version,
                             "spans": [{"start": s, "end": e} for s, e in scan(text, rule)]})
        yield pa.RecordBatch.from_pylist(rows, _ARROW)


def blob_of(text="text"):
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def update_ledger(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
    """Scan what the ledger (a Parquet folder, which may not exist yet) lacks.

    Copies of a blob merge before the shuffle (one text a blob and task), so a
    blob that fills a third of all rows is no hot key. Run again after a
    failed run, it scans what isn't there yet; the append is one commit."""
    names = [f"{r.kind}:{r.version}" for r in rules]
    todo = F.array(*[F.lit(n) for n in names])
    blobs = (versions.select(blob_of(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
             .groupBy("blob").agg(F.first("text").alias("text")))
    known = read_ledger(versions.sparkSession, ledger)
    if known is None:
        new = blobs.withColumn("todo", todo)
    else:
        done = known.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("done"))
        new = (blobs.join(done, "blob", "left")
               .withColumn("todo", F.when(F.col("done").isNull(), todo).otherwise(F.array_except(todo, "done")))
               .where(F.size("todo") > 0))
    (new.select("blob", "text", "todo").mapInArrow(lambda it: _scan_batches(it, rules), LEDGER)
     .write.mode("append").parquet(ledger))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(LEDGER).parquet(ledger)


def findings(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``versions`` with a column ``found``: an array of ``(start, at, kind,
    end)`` structs in order of start, then of the rules (``at`` is the rule's
    place), from the ledger's rows for these rule versions; empty if none.

    Every row of ``versions`` stays, with all its columns (one named ``found``
    or ``_blob`` is replaced). A null text counts as empty.
    """
    spark = versions.sparkSession
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    # Written first, so that the join is of two plain tables and Spark can split a blob of very many paths.
    by_blob = written(read_ledger(spark, ledger).where(current & (F.size("spans") > 0))
               .dropDuplicates(["blob", "kind", "version"])
               .select(F.col("blob").alias("_blob"), "kind", F.explode("spans").alias("s"))
               .groupBy("_blob").agg(F.array_sort(F.collect_list(F.struct(
                   F.col("s.start").alias("start"), place[F.col("kind")].alias("at"),
                   F.col("kind").alias("kind"), F.col("s.end").alias("end")))).alias("found")), "findings")
    rows = versions.drop("found", "_blob").withColumn("_blob", blob_of(text))
    none = F.array().cast("array<struct<start:bigint,at:int,kind:string,end:bigint>>")
    return rows.join(by_blob, "_blob", "left").drop("_blob").withColumn("found", F.coalesce("found", none))


def redact(text, found, mask: str = "[secret]"):
    """The text with every found span (overlaps merged) replaced by ``mask``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    return F.aggregate(
        found, start,
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"],
                   F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                            F.lit(mask)))
            .otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at")),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = fresh_path(spark, "secret-ledger")
    update_ledger(docs, ledger)
    found = findings(docs, ledger).select("doc_id", "found")
    names = F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(r.kind) for r in RULES], digest(names).alias("base_sha256"),
                        F.array_join(names, ",").alias("spans"))
