"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.session import scratch_path

# Python workers get and return batches of at most so many bytes of text.
PIECE_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused folder below the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps read
    the files, so a lost executor doesn't repeat the work before them."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: str = "text") -> Column:
    """The UTF-8 bytes of a text column: workers need no decoding."""
    return F.col(column).cast("binary")


def word_pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words between ASCII white space, in lists: a very long text is cut
    at white space into pieces of about ``size`` bytes to bound memory."""
    at = 0
    while len(text) - at > size:
        cut = _SPACE.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()].split()
        at = cut.end()
    yield (text[at:] if at else text).split()


def digest(pieces: Column) -> Column:
    """Lower-case sha256 of an array of strings, comma-joined."""
    return F.sha2(F.array_join(pieces, ",").cast("binary"), 256)
