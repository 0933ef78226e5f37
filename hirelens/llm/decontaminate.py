"""Benchmark decontamination with suffix arrays over the training text.

Each task turns its documents into shards of words, sorts the shard's suffixes
and binary-searches every benchmark suffix in them. Suffixes are sorted three
words deep first; only those that share such a prefix with some benchmark
suffix are sorted deeper, so the array is complete wherever a search looks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import digest, table, utf8, word_pieces, written

WINDOW = 10
SHARD_WORDS = 1 << 20
CHUNK_WORDS = 500_000   # benchmark words sent to the executors at once
_BITS = 21              # of a word's number: over CHUNK_WORDS
_FOUND = ("struct<n_words:bigint,spans:array<struct<lo:bigint,hi:bigint>>,"
          "items:array<string>,longest:bigint,longest_at:bigint>")
_FOUND_ARROW = pa.struct([("n_words", pa.int64()),
                          ("spans", pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
                          ("items", pa.list_(pa.string())), ("longest", pa.int64()), ("longest_at", pa.int64())])
# Word bytes are kept (A-Z lower-cased), all others become a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))


def words(text: bytes | None) -> Iterator[list[bytes]]:
    return word_pieces((text or b"").translate(_WORDS))


class TestSuffixes:
    """One chunk of the benchmark: every window as a suffix to look up."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.ids = [i for i, _ in items]
        flat, starts, depths, owners = [], [], [], []
        for k, (_, item) in enumerate(items):
            depth = min(window, len(item))
            for s in range(len(item) - depth + 1):
                starts.append(len(flat) + s)
                depths.append(depth)
                owners.append(k)
            flat += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in item] + [0]
        self.words = np.array(flat + [0] * (window + 3), np.int64)
        self.starts, self.depths, self.owners = (np.array(x, np.int64) for x in (starts, depths, owners))
        self.first = np.zeros(len(self.vocabulary) + 1, bool)
        self.first[self.words[self.starts]] = True

    def occurrences(self, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(suffix number, position in the shard) of all verbatim windows.

        ``shard`` holds word numbers, zero for unknown words and between
        documents, and ends in zeros."""
        at = np.flatnonzero(self.first[shard])
        prefix = np.zeros(len(at), np.int64)             # rank of the words so far
        open_, rank = np.arange(len(self.starts)), np.zeros(len(self.starts), np.int64)
        found, depth = [], 0
        while len(at) and len(open_):
            step = 2 if depth else 3
            key = prefix << (_BITS * step) if depth else prefix
            low = rank << (_BITS * step) if depth else rank
            high = low.copy()
            for i in range(step):
                shift = _BITS * (step - 1 - i)
                key = key | shard[at + depth + i] << shift
                inside = self.depths[open_] > depth + i
                word = self.words[self.starts[open_] + depth + i] << shift
                low = low | np.where(inside, word, 0)
                high = high | np.where(inside, word, ((1 << _BITS) - 1) << shift)
            order = np.argsort(key, kind="stable")       # the suffix array, this deep
            at, key = at[order], key[order]
            lo, hi = np.searchsorted(key, low, "left"), np.searchsorted(key, high, "right")
            ends = self.depths[open_] <= depth + step
            done = ends & (lo < hi)
            for q, a, b in zip(open_[done], lo[done], hi[done]):
                found.append((np.full(b - a, q), at[a:b]))
            going = ~ends & (lo < hi)
            open_, lo, hi = open_[going], lo[going], hi[going]
            tops, one, rank = np.unique(lo, return_index=True, return_inverse=True)
            sizes = hi[one] - tops                       # ranges of equal prefixes, never overlapping
            prefix = np.repeat(np.arange(len(tops)), sizes)
            at = at[np.arange(sizes.sum()) + np.repeat(tops - np.cumsum(sizes) + sizes, sizes)]
            depth += step
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([q for q, _ in found]), np.concatenate([p for _, p in found])

    def search(self, texts: list[bytes | None]) -> list[dict]:
        """What each of the texts shares with the benchmark chunk."""
        get, shard, bounds = self.vocabulary.get, [], [0]
        for text in texts:
            n = 0
            for piece in words(text):
                shard.append(np.fromiter(map(get, piece, itertools.repeat(0)), np.int64, len(piece)))
                n += len(piece)
            shard.append(np.zeros(1, np.int64))
            bounds.append(bounds[-1] + n + 1)
        begin, end = np.array(bounds[:-1]), np.array(bounds[1:]) - 1
        out = [{"n_words": int(n), "spans": [], "items": [], "longest": 0, "longest_at": None} for n in end - begin]
        suffix, at = self.occurrences(np.concatenate([*shard, np.zeros(int(self.depths.max(initial=0)) + 3, np.int64)]))
        if not len(at):
            return out
        # Windows that follow each other on one diagonal are one longer match.
        order = np.lexsort((at, at - self.starts[suffix]))
        suffix, at = suffix[order], at[order]
        head = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(self.starts[suffix]) != 1)])
        start, stop = at[head], at[np.r_[head[1:], len(at)] - 1] + self.depths[suffix[np.r_[head[1:], len(at)] - 1]]
        doc, item = np.searchsorted(begin, start, "right") - 1, self.owners[suffix[head]]
        order = np.lexsort((stop, start))
        reach = -1
        for k in order.tolist():
            d, one = int(doc[k]), out[doc[k]]
            s, e = int(start[k] - begin[d]), int(stop[k] - begin[d])
            if e - s > one["longest"]:
                one["longest"], one["longest_at"] = e - s, s
            if one["spans"] and s <= one["spans"][-1]["hi"]:
                one["spans"][-1]["hi"] = max(e, one["spans"][-1]["hi"])
            else:
                one["spans"].append({"lo": s, "hi": e})
        for d, i in sorted(set(zip(doc.tolist(), item.tolist()))):
            if self.ids[i] is not None:
                out[d]["items"].append(self.ids[i])
        return out


def _chunks(benchmark: DataFrame, window: int) -> Iterator[TestSuffixes]:
    """The benchmark in chunks of bounded size, read one partition at a time."""
    items, n = [], 0
    for row in benchmark.toLocalIterator():
        item = [w for piece in words(row["text"]) for w in piece]
        if item:
            items.append((row["item_id"], item))
            n += len(item)
        if n >= CHUNK_WORDS:
            yield TestSuffixes(items, window)
            items, n = [], 0
    if items:
        yield TestSuffixes(items, window)


def _searcher(spark: SparkSession, chunk: TestSuffixes):
    sent = spark.sparkContext.broadcast(chunk)

    @F.arrow_udf(_FOUND)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found, group, size = [], [], 0
            for text in batch:
                group.append(text.as_py())
                size += len(group[-1] or b"")
                if size >= SHARD_WORDS * 6:
                    found += sent.value.search(group)
                    group, size = [], 0
            yield pa.array(found + (sent.value.search(group) if group else []), _FOUND_ARROW)

    return search.asNondeterministic()


def _covered(spans: Column) -> Column:
    """Words in the union of ``[lo, hi)`` spans."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    return F.aggregate(
        F.array_sort(spans), zero,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["hi"] - F.greatest(s["lo"], acc["reach"]))).alias("n"),
            F.greatest(acc["reach"], s["hi"]).alias("reach")),
        lambda acc: acc["n"])


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   text: str = "text", out: str = "leak") -> DataFrame:
    """``docs`` with a struct column ``out`` of what it shares with the
    benchmark: ``n_words, n_hit, n_items, items, spans, longest, longest_at``.

    A word is hit if it lies in an occurrence of a window (``window``
    consecutive words of an item, or a whole shorter item). ``items`` are the
    distinct ids of the items found, sorted as strings; an item with a null id
    hits words but isn't named, and repeated items count once. ``longest`` is
    the longest verbatim match in words (0: none) and ``longest_at`` the word
    where it starts. Null or empty texts and items have no words. All rows and
    columns of ``docs`` stay; a column that is named like ``out`` is replaced.

    The benchmark is the stated query set: it goes to the executors in chunks
    of ``CHUNK_WORDS`` words; with several chunks the hits so far are written
    after each. Documents are never shuffled.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), utf8("text").alias("text"))
    parts = f"{out}_parts"
    hits = docs.withColumn(parts, F.array().cast(f"array<{_FOUND}>"))
    empty, some = TestSuffixes([], window), False
    for chunk in _chunks(items, window):
        if some:
            hits = written(hits, "leaks")
        hits = hits.withColumn(parts, F.concat(parts, F.array(_searcher(spark, chunk)(utf8(text)))))
        some = True
    if not some:  # an empty benchmark still counts the words
        hits = hits.withColumn(parts, F.array(_searcher(spark, empty)(utf8(text))))
    spans = F.flatten(F.col(f"{parts}.spans"))
    ids = F.array_sort(F.array_distinct(F.flatten(F.col(f"{parts}.items"))))
    best = F.array_max(F.transform(parts, lambda p: F.struct(p["longest"], (-p["longest_at"]).alias("at"))))
    return hits.withColumn(out, F.struct(
        F.col(parts)[0]["n_words"].alias("n_words"), _covered(spans).alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"), ids.alias("items"), spans.alias("spans"),
        best["longest"].alias("longest"), (-best["at"]).alias("longest_at"))).drop(parts)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark."""
    return benchmark_hits(docs, benchmark, window, text, "_leak").where("_leak.n_hit = 0").drop("_leak")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "leak.n_words", "leak.n_hit", "leak.n_items",
                        digest(F.col("leak.items")).alias("items_sha256"),
                        (F.col("leak.n_hit") > 0).alias("contaminated"))


ORACLE = """
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS d, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM item WHERE len(w) > 0)),
depth AS (SELECT DISTINCT d FROM win),
pos AS (
  SELECT r, d, s, array_to_string(w[s : s + d - 1], ' ') AS t
  FROM (SELECT r, w, d, unnest(range(1, len(w) - d + 2)) AS s FROM doc, depth WHERE len(w) >= d)),
hit AS (SELECT r, s, win.d, item_id FROM pos JOIN win ON pos.d = win.d AND pos.t = win.t),
run AS (
  SELECT h.r, count(DISTINCT h.word) AS n_hit FROM (SELECT r, unnest(range(s, s + d)) AS word FROM hit) h GROUP BY h.r),
ids AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN run USING (r) LEFT JOIN ids USING (r)
"""
