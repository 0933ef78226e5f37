"""Corpus cleaning: from the documents table to pieces for training.

Each stage calls one operator of ``hirelens.llm`` on all rows that the stage
before it kept, and its decisions take effect:

1. language    rejects documents without a letter, and those that score below
               ``LEAST_SCORE`` for every learned language (none if there is
               nothing to learn from: no lang, no id or no letter anywhere)
2. near_dup    keeps one document of each SimHash component: the smallest
               doc_id (of its rows there, the smallest text, language and
               source); a component of null ids only keeps one of its rows.
               A doc_id with different texts can stay once per component
3. benchmark   removes documents that hold a window of a benchmark item
4. secrets     replaces every secret found by a mask (``n_chars`` follows)
5. pieces      encodes the whole texts; returns ids, the two best scores and
               what the second segmentation changes in the ids

``run`` applies them to ``documents``, writing each stage's rows to the shared
checkpoint folder. Stages 1 to 4 return the columns of ``documents``; columns
that a table has besides these pass through. Null texts have no letter, so
they end in stage 1. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import decontaminate, language, pieces, secrets, simhash
from hirelens.llm.common import fresh_path, table, written

LEAST_SCORE = 0.1


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(docs)
    if not model.labels:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.predict(docs, model, out="_language")
    return (found.where((F.col("_language.lang_pred") != language.UNKNOWN) & (F.col("_language.score") >= LEAST_SCORE))
            .drop("_language"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(docs)
    # The smallest doc_id of each component stays (null if it has none).
    prints = written(found.groupBy("fp", "root").agg(F.min("doc_id").alias("low")), "prints")
    groups = written(prints.groupBy("root").agg(F.min("low").alias("least")), "components")
    chosen = groups.where("least is not null").select(F.col("least").alias("doc_id")).distinct()
    named = docs.join(chosen, "doc_id", "left_semi").select(docs.columns)
    # Rows that repeat a doc_id are rare: only they are told apart by their component and put in order.
    again = named.groupBy("doc_id").agg(F.count("*").alias("_rows")).where("_rows > 1").select("doc_id")
    single = named.join(again, "doc_id", "left_anti")
    order = F.struct(*[F.col(c) for c in ("text", "lang", "source", "n_chars") if c in docs.columns])
    packed = (named.join(again, "doc_id", "left_semi").select(docs.columns).unionByName(docs.where("doc_id is null"))
              .select("doc_id", F.struct(*docs.columns).alias("row"), order.alias("order"), "text"))
    others = (simhash.fingerprints(packed).join(prints.select("fp", "root"), "fp").join(groups, "root")
              .where(F.col("doc_id").eqNullSafe(F.col("least")))
              .groupBy("root").agg(F.min_by("row", "order").alias("row")).select("row.*"))
    return single.select(docs.columns).unionByName(others)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ledger = fresh_path(spark, "secret-ledger")
    secrets.update_ledger(docs, ledger)
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")  # whatever their names
    found = secrets.findings(docs.select("text", others), ledger)
    hit = F.size("found") > 0
    masked = F.when(hit, secrets.redact(F.col("text"), F.col("found"))).otherwise(F.col("text"))
    new = {"text": masked, "n_chars": F.when(hit, F.length(masked).cast("long")).otherwise(F.col("row.n_chars"))}
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pieces.encode(docs.select("doc_id", "lang", "source", "text"), n=2)
    return found.select("doc_id", "lang", "source", F.size("pieces.ids").cast("long").alias("n_pieces"),
                        F.col("pieces.ids").alias("ids"), "pieces.scores", "pieces.round_trip",
                        F.col("pieces.ranks.changes").alias("changes"))


STAGES = [
    ("language", language_stage),
    ("near_dup", near_dup_stage),
    ("benchmark", benchmark_stage),
    ("secrets", secrets_stage),
    ("pieces", pieces_stage),
]
ORACLE_SQL = None  # the kernel, the fingerprints and the lattice are beyond SQL; tests hold a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
