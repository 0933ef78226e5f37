"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

Fingerprints are cut into tiles by the population counts of their four 16-bit
quarters. Two fingerprints within ``radius`` bits have quarter counts whose
differences add up to ``radius`` at most, so only tile pairs within that
distance are compared (exclusive-or and bit counts over numpy blocks); all
other tile pairs are skipped without losing a link.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import table, utf8, word_pieces, written
from hirelens.llm.components import roots

SHINGLE = 3
RADIUS = 2
SEED = 42
TILE = 4096      # mean fingerprints of a full tile; a larger cell gets more tiles
ROWS = 256       # rows of a tile compared at once
QUARTERS = 4
_BASE = 64 // QUARTERS + 1


def _shingle_hashes(text: bytes, k: int) -> Iterator[np.ndarray]:
    """XXH64 of every k-word shingle, in blocks; a shorter text is one shingle."""
    digest, some, tail = xxhash.xxh64_intdigest, False, []
    for words in word_pieces(text.lower()):  # bytes.lower() maps A-Z only
        words = tail + words
        if len(words) < k:
            tail = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        yield np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1:].tolist())], np.uint64)
        some, tail = True, words[len(words) - k + 1:]
    if tail and not some:
        yield np.array([digest(b" ".join(tail), SEED)], np.uint64)


def fingerprint(text: bytes | None, k: int = SHINGLE) -> int:
    """Bits set in over half of the shingle hashes; no word gives zero."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in _shingle_hashes(text or b"", k):
        for block in np.array_split(hashes, len(hashes) // 65536 + 1):
            bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """``docs`` with a column ``fp`` (the 64 bits as a long)."""
    @F.arrow_udf(T.LongType())
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(np.array([fingerprint(x.as_py(), shingle) for x in batch], np.uint64).view(np.int64))

    return docs.withColumn("fp", of.asNondeterministic()(utf8(text)))


def _cell(fp):
    """The quarters' population counts as digits of one number (17^4 at most)."""
    width = 64 // QUARTERS
    cell = F.lit(0)
    for i in range(QUARTERS):
        part = F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1))
        cell = cell * _BASE + F.bit_count(part)
    return cell.cast("int")


def _neighbours(cell, radius: int):
    """Cells not below ``cell`` whose counts differ by ``radius`` in all."""
    digits = [F.pmod(F.floor(cell / _BASE ** (QUARTERS - 1 - i)), F.lit(_BASE)) for i in range(QUARTERS)]
    found = []
    for step in itertools.product(range(-radius, radius + 1), repeat=QUARTERS):
        code = sum(d * _BASE ** (QUARTERS - 1 - i) for i, d in enumerate(step))
        if sum(map(abs, step)) <= radius and (code > 0 or not any(step)):
            inside = F.lit(True)
            for digit, d in zip(digits, step):
                if d:
                    inside = inside & (digit + d).between(0, _BASE - 1)
            found.append(F.when(inside, cell + code))
    return F.filter(F.array(*found), lambda c: c.isNotNull())


def _forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) pairs that join what lies within ``radius`` bits between
    two tiles (or within one): at most one pair a fingerprint, whatever the
    number of close pairs."""
    every = a if b is None else np.concatenate([a, b])
    other, shift = (a, 0) if b is None else (b, len(a))
    label = np.arange(len(every))
    for at in range(0, len(a), ROWS):
        close = np.bitwise_count(a[at:at + ROWS, None] ^ other[None, :]) <= radius
        if b is None:
            close[np.arange(len(close)), np.arange(at, at + len(close))] = False
        for i in np.flatnonzero(close.any(axis=1)):
            met = np.append(label[np.flatnonzero(close[i]) + shift], label[at + i])
            low = met.min()
            if (met != low).any():
                label[np.isin(label, met)] = low
    moved = np.flatnonzero(label != np.arange(len(every)))
    return every[moved], every[label[moved]]


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, tops = [], []
        for same, a, b in zip(batch.column("same"), batch.column("fps"), batch.column("others")):
            a, b = (np.asarray(x.values).view(np.uint64) for x in (a, b))
            node, top = _forest(a, None if same.as_py() else b, radius)
            nodes.append(node)
            tops.append(top)
        if nodes:
            yield pa.record_batch({"a": np.concatenate(nodes).view(np.int64), "b": np.concatenate(tops).view(np.int64)})


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct ``fp`` longs -> links ``(a, b)`` that connect exactly the
    fingerprints within ``radius`` bits (a spanning forest of each tile pair).

    The counts of all cells are broadcast: 17^4 = 83,521 rows at most. A cell
    of many fingerprints is dealt to several tiles by a hash, so no tile and
    no task grows with the largest group of near copies."""
    celled = prints.select("fp", _cell(F.col("fp")).alias("cell"))
    sizes = celled.groupBy("cell").agg(F.ceil(F.count("*") / TILE).alias("blocks"))
    tiles = (celled.join(F.broadcast(sizes), "cell")
             .groupBy("cell", F.pmod(F.xxhash64("fp"), F.col("blocks")).alias("block"))
             .agg(F.collect_list("fp").alias("fps")))
    left = tiles.withColumn("near", F.explode(_neighbours(F.col("cell"), radius)))
    right = tiles.select(F.col("cell").alias("near"), F.col("block").alias("block2"), F.col("fps").alias("others"))
    pairs = (left.join(right, "near").where((F.col("near") > F.col("cell")) | (F.col("block2") >= F.col("block")))
             .select(((F.col("near") == F.col("cell")) & (F.col("block2") == F.col("block"))).alias("same"),
                     "fps", "others"))
    return pairs.mapInArrow(lambda it: _compare(it, radius), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per input row: ``doc_id, fp, root, component_id``.

    ``root`` names the component (its smallest fingerprint as a long),
    ``component_id`` is the smallest doc_id in it. Null and empty texts have
    fingerprint zero and link like any other; a row with a null doc_id keeps
    a null doc_id, takes part in links and never gives the component's id
    (null only if no row there has one). Repeated rows each give a row. Other
    columns of ``docs`` are ignored, so clashing names do no harm. An empty
    table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = written(fingerprints(rows, shingle).select("doc_id", "fp"), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    found = roots(links(prints, radius))
    named = (prints.join(found.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    # Written, so that the last join is of plain tables: Spark can split the rows of one very common fingerprint.
    named = written(named.select("fp", "root").join(lowest, "root"), "components")
    return rows.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
