"""Phrase collocations by Toivonen's method: sample, count, expand, close.

A sample of the documents proposes phrases. One pass over all documents then
counts the proposed phrases and their negative border: the phrases that were
not proposed although both their longest parts were. A border phrase that is
frequent in all documents is a failure of the sample; it joins the proposed
ones, and a further pass counts the border that this adds, and the border that
failures in it would add. Then every frequent phrase has been counted. (The
sample itself is mined length by length, by the same passes.)

The words are numbered once, block by block, and the blocks written; passes
read these. They know a phrase by a 64-bit hash of its language and words. The
proposed phrases are sent as a bitmap of fixed size: a false positive only
makes a pass count some more phrases. A last pass counts the phrases whose
hash is frequent once more by their words, so hashes decide no result. Counts
are added up in each task first and travel as arrays, one for each bucket of
hashes; there are as many buckets as blocks, so a bucket stays small.
"""

from __future__ import annotations

import collections
import contextlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm.common import fresh_path, table, utf8, written

LEAST = 30            # occurrences of a candidate
LONGEST = 4           # words
TOP = 2000
SAMPLE = 8            # one document in so many proposes phrases
EASE = 0.6            # of the sample's share of LEAST: fewer failures of the border
COVER = (100, 80)     # 100 * f(longer) >= 80 * f(phrase) drops the phrase
SCALE = 2_000_000
UNKNOWN = "und"
HASH = 48             # bits of a hash
BITS = 26             # the bitmap has 2 ** BITS bits: 8 MB whatever the corpus
TOKENS = 1 << 19      # words of a block: 2 MB
ROWS = 4              # blocks, or arrays of a bucket, that a worker gets at once
SENT = 64             # arrays that a worker returns at once
ROW_GROUP = 1 << 24   # bytes of the blocks' files that are read at once
KEYS = 1 << 20        # hashes that are counted together before they leave a task
NAMES = 1 << 18       # phrases named together before they leave a task
BUCKETS = 64          # of hashes at least
PIECE = 1 << 20       # bytes of a very long text cut into words at once
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CUT = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
# A-Z become a-z, a tab a space, every end of a piece a newline.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else b
               for b in range(256))


class Words(dict):
    """Word -> number from 1, in order of appearance; 0 ends a piece."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": 0})
        self.names = [b"\n"]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        return number

    def numbers(self, text: bytes) -> Iterator[np.ndarray]:
        at = 0
        while at < len(text):
            cut = _CUT.search(text, at + PIECE)
            end = cut.start() if cut else len(text)
            found = text[at:end].translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")
            numbers = np.fromiter(map(self.__getitem__, found), np.int32, len(found))
            yield numbers[numbers >= 0]
            at = end


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@dataclass
class Block:
    """The words of some documents of one language in a row, pieces ended by
    zeros. ``grams`` gives for each length which places start a phrase of it
    and the hash of the phrase there."""

    lang: str
    ids: np.ndarray
    names: list[bytes]

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        word = np.array([xxhash.xxh64_intdigest(w) for w in self.names], np.uint64)[self.ids]
        inside = self.ids > 0
        starts, key = inside, _mixed(word + np.uint64(xxhash.xxh64_intdigest(self.lang.encode(), 1)))
        cut = np.uint64(64 - HASH)
        yield starts, key >> cut
        for n in range(2, LONGEST + 1):
            starts = starts[:-1] & inside[n - 1:]
            key = _mixed(key[:-1] * _MIX + word[n - 1:])
            yield starts, key >> cut

    def phrase(self, at: int, n: int) -> bytes:
        return b" ".join([self.names[i] for i in self.ids[at:at + n].tolist()])


def _numbered(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[pa.RecordBatch]:
    """Documents -> a row for each block."""
    def row(lang: str, words: Words, parts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.record_batch({"lang": [lang], "ids": pa.array([np.concatenate(parts).tobytes()], pa.binary()),
                                "names": pa.array([b"\n".join(words.names[1:])], pa.binary())})

    held: dict[str, tuple[Words, list[np.ndarray], list[int]]] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            words, parts, size = held.setdefault(lang, (Words(), [], [0]))
            for numbers in words.numbers(text.as_py()):
                parts.append(numbers)
                size[0] += len(numbers)
            parts.append(np.zeros(1, np.int32))
            if size[0] >= tokens:
                yield row(lang, *held.pop(lang)[:2])
    for lang, (words, parts, _) in held.items():
        yield row(lang, words, parts)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for lang, ids, names in zip(batch.column("lang"), batch.column("ids"), batch.column("names")):
            words = names.as_py().split(b"\n")
            yield Block(lang.as_py(), np.frombuffer(ids.as_py(), np.int32), [b"", *words])


class Bitmap:
    """Which hashes are known, by their lowest ``BITS`` bits."""

    def __init__(self, data: np.ndarray | None = None):
        self.data = np.zeros(1 << (BITS - 3), np.uint8) if data is None else data

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys & np.uint64((1 << BITS) - 1)
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def joined(self, keys: DataFrame) -> Bitmap:
        """With the hashes of a table ``key``, folded to bits by Spark: the
        driver gets the fixed 2 ** BITS bits at most."""
        rows = keys.select((F.col("key").bitwiseAND(F.lit((1 << BITS) - 1)) + 1).alias("p"))  # buckets count from 1
        found = (rows.groupBy(F.bitmap_bucket_number("p").alias("bucket"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")))
        data = self.data.copy()
        for bucket, bits in found.collect():
            bits = np.frombuffer(bits, np.uint8)
            data[(bucket - 1) * len(bits):bucket * len(bits)] |= bits
        return Bitmap(data)


def _candidates(block: Block, known: Bitmap, before: Bitmap | None, ahead: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length the hashes of the phrases to count: those that are
    known, and those of the border.

    A first pass (``before`` None) counts single words, and phrases whose
    longest parts are both known. A further pass counts what the pass that
    knew ``before`` did not. If it looks ``ahead``, what it counts itself
    passes for a known part of a longer phrase: whatever turns out frequent in
    it, the phrases that hold it are counted too."""
    parts, old = None, None
    for n, (starts, key) in enumerate(block.grams(), 1):
        def joined(shorter: np.ndarray | None) -> np.ndarray:
            return starts if shorter is None else starts & shorter[:-1] & shorter[1:]

        chosen, held = joined(parts), np.zeros(len(key), bool)
        held[chosen] = known.has(key[chosen])
        if before is None:
            new, parts = chosen, held
        else:
            was = joined(old)
            new, old = chosen & ~was, np.zeros(len(key), bool)
            old[was] = before.has(key[was])
            parts = held | new if ahead else held
        border = new & ~held if n < LONGEST else np.zeros(len(key), bool)
        yield key[new & ~border], key[border]


def _edge(bucket: int, buckets: int) -> int:
    """The first hash of a bucket: buckets are equal ranges of all hashes."""
    return -(-(bucket << HASH) // buckets)


def _dealt(key: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """For each bucket that has any: its number and where its hashes are in
    ``key`` (in order)."""
    edges = np.array([_edge(b, buckets) for b in range(1, buckets)], np.uint64)
    cuts = [0, *np.searchsorted(key, edges).tolist(), len(key)]
    for bucket in range(buckets):
        if cuts[bucket] < cuts[bucket + 1]:
            yield bucket, slice(cuts[bucket], cuts[bucket + 1])


def _pack(key: np.ndarray, n: np.ndarray, first: int) -> tuple[bytes, bytes, bytes]:
    """Hashes in order as steps from ``first`` on, of 32 bits if they fit, and
    counts as bytes; 255 stands for a larger one, which comes by itself."""
    steps = np.diff(key, prepend=np.uint64(first))
    steps = steps.astype(np.uint32) if steps.max(initial=0) < 1 << 32 else steps
    return steps.tobytes(), np.minimum(n, 255).astype(np.uint8).tobytes(), n[n >= 255].astype(np.int64).tobytes()


def _unpack(steps: bytes, counts: bytes, large: bytes, first: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.frombuffer(counts, np.uint8).astype(np.int64)
    n[n == 255] = np.frombuffer(large, np.int64)
    kind = np.uint32 if len(steps) == 4 * len(n) else np.uint64
    return np.cumsum(np.frombuffer(steps, kind), dtype=np.uint64) + np.uint64(first), n


def _buckets_in_order(batches: Iterator[pa.RecordBatch], columns: list[str], by: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows sorted by the first ``by`` columns, those of equal ones together."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns)))
    for head, own in itertools.groupby(rows, lambda row: row[:by]):
        yield head, [row[by:] for row in own]


def _count(blocks: DataFrame, buckets: int, known: Bitmap, before: Bitmap | None, ahead: bool, least: int) -> DataFrame:
    """``key, n, border``: hashes of :func:`_candidates` with ``least``
    occurrences; ``border``: not known, and shorter than the longest."""
    sent = blocks.sparkSession.sparkContext.broadcast((known, before, ahead))

    def packed(keys: list[np.ndarray], border: bool) -> Iterator[pa.RecordBatch]:
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        told = [(bucket, *_pack(key[at], n[at], _edge(bucket, buckets))) for bucket, at in _dealt(key, buckets)]
        for at in range(0, len(told), SENT):
            some = told[at:at + SENT]
            yield pa.record_batch({"bucket": pa.array([t[0] for t in some], pa.int32()),
                                   "border": pa.array([border] * len(some)),
                                   **{name: pa.array([t[i] for t in some], pa.binary())
                                      for i, name in enumerate(("steps", "counts", "large"), 1)}})

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {False: [], True: []}
        for block in _blocks(batches):
            for found in _candidates(block, *sent.value):
                for border, keys in zip((False, True), found):
                    held[border].append(keys)
            for border, keys in held.items():
                if sum(map(len, keys)) >= KEYS:
                    yield from packed(keys, border)
                    held[border] = []
        for border, keys in held.items():
            if keys:
                yield from packed(keys, border)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, border), rows in _buckets_in_order(batches, ["bucket", "border", "steps", "counts", "large"], 2):
            key, n = map(np.concatenate, zip(*[_unpack(*row, _edge(bucket, buckets)) for row in rows]))
            order = np.argsort(key)
            key = key[order]
            heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            n = np.add.reduceat(n[order], heads)
            often = n >= least
            yield pa.record_batch({"key": key[heads[often]].view(np.int64), "n": n[often],
                                   "border": np.full(int(often.sum()), border)})

    arrays = blocks.mapInArrow(counted, "bucket int, border boolean, steps binary, counts binary, large binary")
    return (arrays.repartition("bucket").sortWithinPartitions("bucket", "border")
            .mapInArrow(added, "key long, n long, border boolean"))


def _closed(blocks: DataFrame, buckets: int, known: Bitmap, least: int, ahead: bool) -> list[DataFrame]:
    """The tables of frequent hashes that the passes find. Passes go on until
    no border phrase is frequent. One that looks ``ahead`` is the last: it has
    counted all that its border's failures could ask for."""
    before, tables = None, []
    while True:
        tables.append(written(_count(blocks, buckets, known, before, ahead, least), "frequent"))
        failures = tables[-1].where("border")
        if failures.isEmpty() or (ahead and before is not None):
            return tables
        known, before = known.joined(failures), known


class Names:
    """Phrases of one language by hash, with their occurrences in a task."""

    def __init__(self):
        self.keys, self.counts, self.names = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

    def add(self, block: Block, frequent: Bitmap) -> None:
        for n, (starts, key) in enumerate(block.grams(), 1):
            at = np.flatnonzero(starts)
            at = at[frequent.has(key[at])]
            found, first, times = np.unique(key[at], return_index=True, return_counts=True)
            place = np.searchsorted(self.keys, found)
            old = place < len(self.keys)
            old[old] = self.keys[place[old]] == found[old]
            self.counts[place[old]] += times[old]
            # New ones go in between; the numbers of the names stay.
            self.keys = np.insert(self.keys, place[~old], found[~old])
            self.counts = np.insert(self.counts, place[~old], times[~old])
            self.names.append((found[~old], [block.phrase(i, n) for i in at[first[~old]].tolist()], n))

    def rows(self, lang: str, buckets: int) -> Iterator[tuple]:
        """(bucket, lang, length of the phrases, phrases, counts)"""
        for keys, names, n in self.names:
            times = self.counts[np.searchsorted(self.keys, keys)]
            for bucket, places in _dealt(keys, buckets):
                yield bucket, lang, n, b"\n".join(names[places]), times[places].tobytes()


def _named(blocks: DataFrame, buckets: int, frequent: Bitmap, least: int) -> DataFrame:
    """``lang, phrase, n_words, n``: occurrences by words of all phrases whose
    hash is frequent, if they are ``least``."""
    sent = blocks.sparkSession.sparkContext.broadcast(frequent)
    schema = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("n_words", pa.int32()), ("phrases", pa.binary()),
                        ("counts", pa.binary())])

    def packed(held: dict[str, Names]) -> Iterator[pa.RecordBatch]:
        for lang, names in held.items():
            rows = names.rows(lang, buckets)
            while told := list(itertools.islice(rows, SENT)):
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*told), schema)], schema)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Names] = {}
        for block in _blocks(batches):
            held.setdefault(block.lang, Names()).add(block, sent.value)
            if sum(len(n.keys) for n in held.values()) >= NAMES:
                yield from packed(held)
                held = {}
        yield from packed(held)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, lang, length), rows in _buckets_in_order(batches, schema.names, 3):
            total = collections.Counter()
            for phrases, counts in rows:
                for phrase, n in zip(phrases.split(b"\n"), np.frombuffer(counts, np.int64).tolist()):
                    total[phrase] += n
            found = [(p, n) for p, n in total.items() if n >= least]
            yield pa.record_batch({"lang": pa.array([lang] * len(found), pa.string()),
                                   "phrase": pa.array([p for p, _ in found], pa.binary()).cast(pa.string()),
                                   "n_words": pa.array([length] * len(found), pa.int32()),
                                   "n": pa.array([n for _, n in found], pa.int64())})

    arrays = blocks.mapInArrow(counted, "bucket int, lang string, n_words int, phrases binary, counts binary")
    return (arrays.repartition("bucket").sortWithinPartitions("bucket", "lang", "n_words")
            .mapInArrow(added, "lang string, phrase string, n_words int, n long"))


def _written_blocks(rows: DataFrame) -> tuple[DataFrame, int]:
    """The blocks of documents, and the number of buckets for them."""
    tokens, path = TOKENS, fresh_path(rows.sparkSession, "word-blocks")
    blocks = rows.mapInArrow(lambda batches: _numbered(batches, tokens), "lang string, ids binary, names binary")
    # Few and large rows: pages and row groups are measured after every row.
    (blocks.write.option("parquet.block.size", ROW_GROUP).option("parquet.block.size.row.check.min", "1")
     .option("parquet.page.size.row.check.min", "1").option("compression", "zstd").parquet(path))
    blocks = rows.sparkSession.read.schema(blocks.schema).parquet(path)
    return blocks, max(BUCKETS, blocks.count())


@contextlib.contextmanager
def _few_rows_at_once(spark: SparkSession) -> Iterator[None]:
    """Rows here are megabytes: queries that run inside send few of them to a
    worker at once. The session's setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, n_words, n``: every phrase of one to four words with
    ``least`` occurrences in its language, exactly counted over all rows; and
    ``lang, n``: the occurrences of all words.

    A null text has no words, a null lang is ``und``. Repeated rows count each.
    Other columns are ignored. An empty table gives empty results."""
    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"),
                       F.coalesce(utf8(text), F.lit(b"")).alias("text"))
    sample, few = _written_blocks(rows.where(F.pmod(F.xxhash64("lang", "text"), F.lit(SAMPLE)) == 0))
    blocks, buckets = _written_blocks(rows)
    known, frequent = Bitmap(), Bitmap()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            yield pa.record_batch({"lang": [block.lang], "n": [int((block.ids > 0).sum())]})

    with _few_rows_at_once(docs.sparkSession):
        for found in _closed(sample, few, known, max(1, int(EASE * least / SAMPLE)), ahead=False):
            known = known.joined(found)
        for found in _closed(blocks, buckets, known, least, ahead=True):
            frequent = frequent.joined(found)
        total = blocks.mapInArrow(words, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))
        return written(_named(blocks, buckets, frequent, least), "phrases"), written(total, "words")


def _wide(column: Column) -> Column:
    return column.cast("decimal(19,0)")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top``
    phrases of two to four words with ``a >= least`` occurrences.

    ``score`` is floor(2,000,000 a / (l + r)) of the cut into two parts (with
    ``l`` and ``r`` occurrences) that scores lowest, the first such cut. A
    phrase inside a longer one with 80 % of its occurrences at least is left
    out. Ties go to the larger ``a``, then to the smaller phrase in byte order.
    Nulls and empty tables: see :func:`frequent_phrases`."""
    counted, total = frequent_phrases(docs, text, lang, least)
    words = F.split("phrase", " ")
    candidates = counted.where("n_words > 1").withColumnRenamed("n", "a")

    def part(lo: Column | int, n: Column | int) -> Column:
        return F.array_join(F.slice(words, lo, n), " ")

    cuts = written(candidates.select("lang", "phrase", "a", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("n_words") - 1),
        lambda k: F.struct(k.alias("k"), part(1, k).alias("first"),
                           part(k + 1, F.col("n_words") - k).alias("rest")))).alias("c"))
        .select("lang", "phrase", "a", "c.*"), "cuts")
    left = counted.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counted.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    score = F.expr(f"CAST({SCALE} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) "
                   "DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    scored = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
              .groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))

    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("n_words") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.col("n_words") - n + 1), lambda lo: part(lo, n))))
    longer = (candidates.where("n_words > 2").select("lang", F.explode(inner).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (scored.join(longer, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (_wide(F.col("longer")) * COVER[0] < _wide(F.col("a")) * COVER[1])))
    # Written, so that each task drops what can't be among a language's first before it is dealt by language.
    kept = written(kept.select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r"), "scored")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = kept.withColumn("rank", rank).where(F.col("rank") <= top)
    return (best.join(total, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                    F.col("score").cast("long").alias("score")))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
