"""Language identification with a string kernel.

The kernel counts the character n-grams of one to three characters that two
texts both contain (presence, blended spectrum, normalised by the texts' own
counts). Grams are hashed to a fixed number of buckets. A Nystroem map over
landmark texts and one-versus-rest ridge regression give the weights; batches
of texts are scored by matrix products.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm.common import table, written

ORDERS = (1, 2, 3)
BUCKETS = (1 << 10, 1 << 12, 1 << 13)  # one range of buckets for each order
LANDMARKS = 48       # texts of a label that span the Nystroem map
PER_LABEL = 192      # texts of a label that the regression learns from
LABELS = 256         # the most frequent labels are learned
RIDGE = 1e-3
BATCH = 64
UNKNOWN = "und"
PIECE = 1 << 18      # characters taken at once from a long text


def grams(text: str) -> np.ndarray:
    """Which buckets the whole text's n-grams fall into (booleans)."""
    found = np.zeros(sum(BUCKETS), bool)
    reach = ORDERS[-1] - 1
    for at in range(0, max(len(text), 1), PIECE):
        codes = np.frombuffer(text[at:at + PIECE + reach].lower().encode("utf-32-le", "replace"), np.uint32)
        base, key = 0, np.zeros(0, np.uint64)
        for order, size in zip(ORDERS, BUCKETS):
            n = len(codes) - order + 1
            if n <= 0:
                break
            key = codes.astype(np.uint64) if order == 1 else (key[:n] << np.uint64(21)) | codes[order - 1:]
            mixed = key * np.uint64(0x9E3779B97F4A7C15)
            found[base + (mixed >> np.uint64(64 - int(math.log2(size)))).astype(np.int64)] = True
            base += size
    return found


@dataclass
class Model:
    """``scores = presence @ weights / sqrt(presence.sum())``: the kernel
    values with all landmarks times the regression's coefficients, multiplied
    out in advance (both are linear in the presence vector)."""

    labels: list[str]
    weights: np.ndarray

    @staticmethod
    def fit(presence: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
        names = sorted(set(labels))
        if not names:
            return Model([], np.zeros((sum(BUCKETS), 0), np.float32))
        x = presence.astype(np.float64)
        x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
        y = np.array([[float(label == name) for name in names] for label in labels])
        chosen, seen = [], dict.fromkeys(names, 0)
        for i, label in enumerate(labels):
            if seen[label] < landmarks:
                seen[label] += 1
                chosen.append(i)
        marks = x[chosen]
        values, vectors = np.linalg.eigh(marks @ marks.T)
        keep = values > 1e-8 * values.max(initial=1e-30)
        nystroem = vectors[:, keep] / np.sqrt(values[keep])
        z = (x @ marks.T) @ nystroem
        weight = 1 / np.maximum(y.sum(axis=0), 1)        # every label counts alike
        row = (y @ weight)[:, None]
        solved = np.linalg.solve(z.T @ (row * z) + ridge * np.eye(z.shape[1]), z.T @ (row * y))
        return Model(names, (marks.T @ (nystroem @ solved)).astype(np.float32))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.labels:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        x = np.stack([grams(t) for t in texts]).astype(np.float32)
        scores = (x @ self.weights) / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
        best = scores.argmax(axis=1)
        return [self.labels[b] for b in best], np.clip(scores[np.arange(len(best)), best], 0, 1).astype(np.float64)


def held_out(doc_id="doc_id"):
    """crc32 of the id as text, mod 4, is 2 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, per_label: int = PER_LABEL, labels: int = LABELS) -> Model:
    """Fit on a bounded sample: of each of the ``labels`` most frequent
    languages (ties to the smaller name) the ``per_label`` rows with the
    lowest hash of the id, never a held-out one, a null lang, a null id or a
    text without a letter. Workers reduce each whole text to its buckets (13
    kB of booleans, packed to 2 kB); only these come to the driver:
    ``labels * per_label`` rows at most. No such row: the model knows nothing
    and predicts ``und``."""
    usable = (docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out())
              .select("doc_id", "lang", F.xxhash64("doc_id").alias("h"), "text"))
    ids = written(usable.where(F.col("text").rlike(r"\p{L}")).select("lang", "h").distinct(), "labelled")
    frequent = (ids.groupBy("lang").agg(F.count("*").alias("ids"))
                .orderBy(F.desc("ids"), "lang").limit(labels))
    # Hashes above some four times the wanted share can't be among the lowest: few rows a label are put in order.
    share = F.least(F.lit(1.0), F.lit(4.0 * per_label) / F.col("ids"))
    ranked = (ids.join(F.broadcast(frequent), "lang").where(F.pmod("h", F.lit(1 << 30)) <= share * (1 << 30))
              .withColumn("n", F.row_number().over(
                  Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h")))
              .where(F.col("n") <= per_label).select("lang", "h"))
    sample = (usable.join(F.broadcast(ranked), ["lang", "h"]).where(F.col("text").rlike(r"\p{L}"))
              .dropDuplicates(["lang", "h"]))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(grams(t)).tobytes() for t in batch["text"].to_pylist()]
            yield pa.record_batch({"lang": batch["lang"], "h": batch["h"], "bits": pa.array(bits, pa.binary())})

    rows = (sample.select("lang", "h", "text").mapInArrow(reduce, "lang string, h long, bits binary")
            .orderBy("lang", "h").collect())
    n = sum(BUCKETS)
    presence = (np.stack([np.unpackbits(np.frombuffer(r["bits"], np.uint8))[:n] for r in rows])
                if rows else np.zeros((0, n)))
    return Model.fit(presence, [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out``: ``lang_pred``, ``score`` (0 to
    1). A null text or one without a letter is ``und`` with score 0. Only the
    text is looked at. All rows and columns stay (a column named like ``out``
    is replaced)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = [], [np.zeros(0)]
            for at in range(0, len(batch), BATCH):
                texts = batch.slice(at, BATCH).to_pylist()
                got, values = sent.value.predict([t or "" for t in texts])
                blind = [not any(map(str.isalpha, t or "")) for t in texts]
                names += [UNKNOWN if b else g for b, g in zip(blind, got)]
                scores.append(np.where(blind, 0.0, values))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(scores))],
                                             ["lang_pred", "score"])

    return docs.withColumn(out, of.asNondeterministic()(F.col(text)))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")
