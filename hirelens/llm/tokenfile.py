"""Token ids in Arrow files of equal-length sequences and masks.

The ids of all documents, in ascending order of doc_id, are one stream cut
into sequences of ``length`` ids. A file holds a range of documents: record
batches of ``fixed_size_list`` ids and masks (mask 0: padding after the last
id), which a reader maps into memory and slices without a copy. Beside it, an
index file has each document's place in the file's stream.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm.common import fresh_path, table, written
from hirelens.llm.units import encoder, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
END = 2
LENGTH = 2048
SEQUENCES = 128      # sequences of a record batch: half a megabyte
_INDEX = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())])
_FILES = "part int, ids string, docs string, n_docs long, n_tokens long"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class SequenceWriter:
    """Appends documents to one ids file and its index."""

    def __init__(self, ids, docs, kind: np.dtype, length: int = LENGTH):
        self.length, self.kind = length, kind
        item = pa.from_numpy_dtype(kind)
        self.schema = pa.schema([("input_ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))],
                                metadata={"length": str(length)})
        self.ids, self.docs = pa.ipc.new_file(ids, self.schema), pa.ipc.new_file(docs, _INDEX)
        self.held, self.size, self.n_tokens, self.index = [], 0, 0, []
        self.n_docs = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.kind.itemsize
        self.index.append({"doc_id": doc_id, "at": self.n_tokens, "n_tokens": n})
        self.held.append(ids)
        self.size += n
        self.n_tokens += n
        self.n_docs += 1
        if self.size >= self.length * SEQUENCES:
            self._write(False)

    def _write(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.held), self.kind)
        block = self.length * SEQUENCES
        for at in range(0, len(flat) if last else len(flat) // block * block, block):
            ids = flat[at:at + block]
            pad = -len(ids) % self.length
            mask = pa.array(np.r_[np.ones(len(ids), bool), np.zeros(pad, bool)])
            ids = pa.array(np.r_[ids, np.zeros(pad, self.kind)] if pad else ids)
            self.ids.write_batch(pa.record_batch(
                [pa.FixedSizeListArray.from_arrays(x, self.length) for x in (ids, mask)], schema=self.schema))
        self.held = [] if last else [flat[len(flat) // block * block:].tobytes()]
        self.size = 0 if last else len(flat) % block
        if self.index:
            self.docs.write_batch(pa.RecordBatch.from_pylist(self.index, _INDEX))
            self.index = []

    def close(self) -> None:
        self._write(True)
        self.ids.close()
        self.docs.close()


class SequenceFile:
    """Random access to a file of sequences: slices share the mapped memory."""

    def __init__(self, path: str):
        store, name = _store(path)
        source = pa.memory_map(name) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(name)
        self.reader = pa.ipc.open_file(source)
        self.length = int(self.reader.schema.metadata[b"length"])
        self._batch, self._number = None, -1

    def _values(self, number: int) -> tuple[np.ndarray, pa.Array]:
        if number != self._number:
            batch = self.reader.get_batch(number)
            self._batch = batch.column(0).flatten().to_numpy(zero_copy_only=True), batch.column(1)
            self._number = number
        return self._batch

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence ``i``."""
        ids, mask = self._values(i // SEQUENCES)
        k = i % SEQUENCES
        return ids[k * self.length:(k + 1) * self.length], np.array(mask[k].as_py())

    def slices(self, at: int, n: int) -> Iterator[np.ndarray]:
        """The ``n`` ids from place ``at`` of the stream, a slice a batch."""
        block = self.length * SEQUENCES
        while n:
            ids, _ = self._values(at // block)
            part = ids[at % block:at % block + n]
            yield part
            at, n = at + len(part), n - len(part)


def _write_part(batches: Iterator[pa.RecordBatch], folder: str, path: str, end: int, length: int):
    writer, store, context = None, None, TaskContext.get()
    part, attempt = context.partitionId(), context.taskAttemptId()
    names = [f"{folder}/part-{part:05d}.ids.arrow", f"{folder}/part-{part:05d}.docs.arrow"]
    encode = encoder(path)
    tail = np.array([end], encode.kind).tobytes()
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            if writer is None:
                store, _ = _store(folder)
                store.create_dir(_store(folder)[1], recursive=True)
                drafts = [f"{_store(n)[1]}.{attempt}" for n in names]
                streams = [store.open_output_stream(d) for d in drafts]
                writer = SequenceWriter(*streams, encode.kind, length)
            writer.add(doc_id, encode.ids(text.as_py() or "") + tail)
    if writer:
        writer.close()
        for stream, draft, name in zip(streams, drafts, names):
            stream.close()
            store.move(draft, _store(name)[1])
        yield pa.RecordBatch.from_pylist([{"part": part, "ids": names[0], "docs": names[1],
                                           "n_docs": writer.n_docs, "n_tokens": writer.n_tokens}],
                                         pa.schema([("part", pa.int32()), ("ids", pa.string()), ("docs", pa.string()),
                                                    ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end: int = END,
                 length: int = LENGTH) -> DataFrame:
    """Encode every whole text (null: empty), append ``end`` and write the
    files below ``folder`` in ascending order of doc_id (nulls first; equal
    ids in order of the text's hash, then the text). Returns a row per file:
    ``part, ids, docs, n_docs, n_tokens, base`` (ids in the files before it).

    A task writes to names of its own attempt and renames them at its end, so
    a repeated task replaces whole files. ``folder`` must be one that all
    executors reach. Other columns are ignored; an empty table writes no file.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("h"))
    files = (rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
             .select("doc_id", "text")
             .mapInArrow(lambda it: _write_part(it, folder, path, end, length), _FILES))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return written(files, "token-files").withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _read_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, (store, name) = SequenceFile(row["ids"]), _store(row["docs"])
            index = pa.ipc.open_file(store.open_input_file(name))
            for k in range(index.num_record_batches):
                docs = index.get_batch(k)
                sums = []
                for at, n in zip(docs["at"].to_pylist(), docs["n_tokens"].to_pylist()):
                    crc = 0
                    for part in ids.slices(at, n):
                        crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                    sums.append(crc)
                start = pa.array(docs["at"].to_numpy() + row["base"])
                yield pa.record_batch({"doc_id": docs["doc_id"], "start": start, "n_tokens": docs["n_tokens"],
                                       "ids_crc32": pa.array(sums, pa.int64())})


def read_documents(files: DataFrame) -> DataFrame:
    """Read back what :func:`write_tokens` wrote: a row per document with
    ``doc_id, start, n_tokens, ids_crc32``, a task per file."""
    return (files.repartition(max(1, files.count())).select("ids", "docs", "base")
            .mapInArrow(_read_part, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_tokens(table(spark, sf_dir, "documents"), fresh_path(spark, "tokens"))
    return read_documents(files)
