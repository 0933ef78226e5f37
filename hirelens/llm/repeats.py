"""Repeated passages with sparse suffix arrays.

Only suffixes at content-selected positions are kept: in every run of
``REACH + 1`` possible window starts, the word whose following words have the
smallest hash (a minimiser). Equal windows select the same word, so a passage
of ``MIN`` words that two documents share has such a suffix in both, with the
same ``REACH`` words behind it. The suffixes are sorted by a hash of these
words, neighbours are compared, and matches are extended to the left and right.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import table, utf8, word_pieces, written
from hirelens.llm.components import roots

MIN = 50        # words of a passage
REACH = 25      # a suffix starts so many words behind a window's start at most
GRAM = 8        # words whose hash selects a suffix
BLOCK = 1 << 19  # window starts handled at once, which bounds memory
NAMELESS = -1 << 63
_SEED = 7
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd multipliers
_SUFFIXES = "key long, stretch long, doc_id long, lo long, hi long"
_SPANS = "doc_id long, lo long, hi long, first long, open boolean"


def _mix(x: np.ndarray, add: int = 0) -> np.ndarray:
    x = x + np.uint64(add)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of word ranges, from one hash per word (arithmetic mod 2^64)."""

    def __init__(self, words: np.ndarray, base: int):
        power = np.cumprod(np.full(len(words) + 1, base, np.uint64))
        self.back = np.cumprod(np.full(len(words) + 1, pow(base, -1, 1 << 64), np.uint64))
        self.sums = np.r_[np.zeros(1, np.uint64), np.cumsum(words * power[:-1])]

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (self.sums[hi] - self.sums[lo]) * self.back[lo]


def word_hashes(text: bytes | None) -> np.ndarray:
    """One hash per word (between ASCII white space, A-Z lower-cased)."""
    digest = xxhash.xxh64_intdigest
    return np.concatenate([np.array([digest(w, _SEED) for w in piece], np.uint64)
                           for piece in word_pieces((text or b"").lower())])


def suffixes(words: np.ndarray, least: int = MIN, reach: int = REACH) -> Iterator[dict[str, np.ndarray]]:
    """The selected suffixes: ``key`` hashes the ``reach`` words from it on;
    ``lo``/``hi`` is the stretch of all windows that select it, hashed in
    ``stretch``."""
    for at in range(0, len(words) - least + 1, BLOCK):
        part = words[at:at + BLOCK + least - 1]
        roll, starts = Rolling(part, _BASES[0]), np.arange(len(part) - least + 1)
        grams = np.arange(len(starts) + reach)
        order = _mix(roll.of(grams, grams + GRAM), 1)
        chosen = starts + np.lib.stride_tricks.sliding_window_view(order, reach + 1).argmin(axis=1)
        head = np.flatnonzero(np.r_[True, np.diff(chosen) != 0])
        lo, hi, place = head, np.r_[head[1:], len(starts)] - 1 + least, chosen[head]
        yield {"key": _mix(roll.of(place, place + reach), 2), "stretch": _mix(roll.of(lo, hi) + hi.astype(np.uint64) - lo.astype(np.uint64), 3),
               "lo": lo + at, "hi": hi + at}


def _select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            for found in suffixes(word_hashes(text.as_py())):
                yield pa.record_batch({
                    "key": found["key"].view(np.int64), "stretch": found["stretch"].view(np.int64),
                    "doc_id": np.full(len(found["lo"]), doc_id), "lo": found["lo"], "hi": found["hi"]})


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Small batches joined into larger ones."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted batch's groups start."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes sorted by key, stretch, document -> spans.

    Equal stretches of several documents are repeated as a whole: a span with
    the first document seen. Where suffixes share the key only, the match ends
    within a stretch: these go on as ``open``, with the first and last
    document of each repeated stretch, to be extended word by word. A key at a
    batch's edge may go on in the next batch, so its stretches stay open too.
    """
    for batch in batches:
        key, stretch, doc, lo, hi = (batch[c].to_numpy() for c in ("key", "stretch", "doc_id", "lo", "hi"))
        if not len(key):
            continue
        heads = _heads(key, stretch)
        sizes = np.diff(np.r_[heads, len(key)])
        tails = heads + sizes - 1
        repeated = np.repeat(doc[heads] != doc[tails], sizes)
        first = np.repeat(doc[heads], sizes)
        keys = _heads(key)
        per_key = np.diff(np.r_[keys, len(key)])
        shared = np.minimum.reduceat(doc, keys) != np.maximum.reduceat(doc, keys)
        head = np.zeros(len(key), np.int64)
        head[heads] = 1
        unsure = shared & (np.add.reduceat(head, keys) > 1)     # several stretches, repeated or not
        unsure[[0, -1]] = True
        ends = np.zeros(len(key), bool)
        ends[heads] = ends[tails] = True
        open_ = np.repeat(unsure, per_key) & (~repeated | ends)
        for rows, flag in ((np.flatnonzero(repeated), False), (np.flatnonzero(open_), True)):
            if len(rows):
                yield pa.record_batch({"doc_id": doc[rows], "lo": lo[rows], "hi": hi[rows], "first": first[rows],
                                       "open": np.full(len(rows), flag)})


def _windows(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Every window of the open stretches, with a 128-bit hash."""
    for batch in batches:
        for doc_id, text, spans in zip(batch["doc_id"].to_pylist(), batch["text"], batch["spans"]):
            words, wanted = word_hashes(text.as_py()), spans.values
            last = len(words) - least
            mark = np.zeros(max(last, 0) + 2, np.int64)
            lo = np.minimum(wanted.field("lo").to_numpy(), last + 1)
            hi = np.minimum(wanted.field("hi").to_numpy() - least + 1, last + 1)
            if last < 0:
                continue  # another row of this doc_id has the longer text
            np.add.at(mark, lo, 1)
            np.add.at(mark, np.maximum(hi, lo), -1)
            starts = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            for at in range(0, len(starts), BLOCK):
                some = starts[at:at + BLOCK]
                base, part = some[0], words[some[0]:some[-1] + least]
                one, two = Rolling(part, _BASES[0]), Rolling(_mix(part, 4), _BASES[1])
                some = some - base
                yield pa.record_batch({
                    "h1": _mix(one.of(some, some + least), 5).view(np.int64),
                    "h2": _mix(two.of(some, some + least), 6).view(np.int64),
                    "doc_id": np.full(len(some), doc_id), "lo": some + base})


@F.arrow_udf(T.StructType([T.StructField("n", T.LongType()), T.StructField("spans", T.StringType())]))
def _merged(spans: pa.Array) -> pa.Array:
    """Overlapping or touching spans as one: words covered, ``lo:hi`` pairs."""
    out = []
    for row in spans:
        lo, hi = (row.values.field(c).to_numpy() for c in ("lo", "hi"))
        order = np.argsort(lo, kind="stable")
        lo, reach = lo[order], np.maximum.accumulate(hi[order])
        head = np.flatnonzero(np.r_[True, lo[1:] > reach[:-1]])
        lo, hi = lo[head], reach[np.r_[head[1:], len(lo)] - 1]
        out.append({"n": int((hi - lo).sum()), "spans": ",".join(f"{a}:{b}" for a, b in zip(lo, hi))})
    return pa.array(out, pa.struct([("n", pa.int64()), ("spans", pa.string())]))


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      least: int = MIN, reach: int = REACH) -> DataFrame:
    """A row per document that shares ``least`` or more words in a row,
    verbatim, with another document: ``doc_id, class_id, n_repeated, spans``.

    Words lie between ASCII white space; A-Z count as a-z. ``spans`` are the
    word ranges ``lo:hi`` (end exclusive) covered by shared passages, merged;
    ``n_repeated`` their words; ``class_id`` the smallest doc_id of the class
    of documents linked by shared passages. Every such window is found.

    Rows that repeat a doc_id are one document (a passage that only they share
    isn't repeated); rows with a null doc_id are together one nameless
    document (doc_id null, and class_id null if it is in the class: it sorts
    first). Null and short texts share nothing. Other columns are ignored; an
    empty table gives no row.

    A very common passage is no hot group: the sort deals its suffixes by
    document as well, and window counts merge before the shuffle.
    """
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NAMELESS)).alias("doc_id"), utf8(text).alias("text"))
    kept = written(rows.where(F.col("text").isNotNull()).mapInArrow(lambda it: _gathered(_select(it)), _SUFFIXES), "suffixes")
    order = ["key", "stretch", "doc_id", "lo"]
    spans = written(kept.repartitionByRange(*order).sortWithinPartitions(*order)
                    .mapInArrow(compare_neighbours, _SPANS), "spans")
    open_ = (spans.where("open").groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))
    windows = written(rows.join(open_, "doc_id").mapInArrow(
        lambda it: _gathered(_windows(it, least)), "h1 long, h2 long, doc_id long, lo long"), "windows")
    twice = (windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .where("first < last"))
    found = (spans.where("not open").select("doc_id", "lo", "hi", "first")
             .union(windows.join(twice, ["h1", "h2"])
                    .select("doc_id", "lo", (F.col("lo") + least).alias("hi"), "first")))
    found = written(found.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"),
                                                F.collect_set("first").alias("firsts")), "passages")
    linked = roots(found.select(F.col("doc_id").alias("a"), F.explode("firsts").alias("b")))
    named = found.join(linked.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    merged = named.select("doc_id", F.coalesce("root", "doc_id").alias("class_id"), _merged("spans").alias("m"))
    return merged.select(*[F.nullif(F.col(c), F.lit(NAMELESS)).alias(c) for c in ("doc_id", "class_id")],
                         F.col("m.n").alias("n_repeated"), F.col("m.spans").alias("spans"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
win AS (
  SELECT doc_id, s, md5(array_to_string(w[s + 1 : s + 50], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS s FROM d WHERE len(w) >= 50)),
rep AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, s, first FROM win JOIN rep USING (h)),
pos AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM hit),
run AS (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM pos),
span AS (SELECT doc_id, min(p) AS lo, max(p) + 1 AS hi FROM run GROUP BY doc_id, g),
edge AS (
  SELECT DISTINCT doc_id AS a, first AS b FROM hit WHERE doc_id <> first
  UNION SELECT DISTINCT first, doc_id FROM hit WHERE doc_id <> first),
reach(a, b) AS (
  SELECT DISTINCT doc_id, doc_id FROM hit
  UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
cls AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a)
SELECT doc_id, any_value(class_id) AS class_id, CAST(sum(hi - lo) AS BIGINT) AS n_repeated,
  string_agg(lo || ':' || hi, ',' ORDER BY lo) AS spans
FROM span JOIN cls USING (doc_id) GROUP BY doc_id
"""
