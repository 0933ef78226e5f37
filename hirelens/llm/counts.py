"""Token counts that follow edits.

A document's pre-tokens are the leaves of a segment tree, in slots of some
consecutive units (a unit's pre-tokens never depend on its neighbours, see
:mod:`hirelens.llm.units`). A node holds the characters and tokens below it.
An edit finds its slots by descending the tree, encodes only these again
(more, if it moved the boundary to a neighbour), and updates the sums above.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import table
from hirelens.llm.units import Encoder, encoder, split, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
SLOT = 32       # units of a slot
MASK = "[removed]"
# Edits of the registered query: e-mail addresses, long numbers and keys go.
PERSONAL = re.compile(r"[\w.+-]{1,64}@[\w-]+(?:\.[\w-]+)+|\+?\d[\d ()-]{7,}\d|\b[0-9a-f]{16,}\b")


class TokenTree:
    """The segment tree of one document, over the slots of its units."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.size = 1 << max(0, len(chars) - 1).bit_length()
        self.chars, self.tokens = np.zeros(2 * self.size, np.int64), np.zeros(2 * self.size, np.int64)
        for tree, leaves in ((self.chars, chars), (self.tokens, tokens)):
            tree[self.size:self.size + len(leaves)] = leaves
            low = self.size
            while low > 1:
                tree[low // 2:low] = tree[low:2 * low:2] + tree[low + 1:2 * low:2]
                low //= 2
        self.slots = len(chars)
        self.encoded = 0  # tokens that edits encoded again

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        return (x[self.size:self.size + self.slots] for x in (self.chars, self.tokens))

    @classmethod
    def build(cls, text: str, encode: Encoder) -> TokenTree:
        if not text:
            return cls(np.zeros(1, np.int64), np.zeros(1, np.int64))
        units = split(text) if encode.by_unit else [text]
        width = encode.kind.itemsize
        chars = np.fromiter(map(len, units), np.int64, len(units)) + 1
        chars[0] -= 1
        if encode.by_unit:
            ids = [encode.first[units[0]], *map(encode.rest.__getitem__, units[1:])]
        else:
            ids = [encode.ids(text)]
        tokens = np.fromiter(map(len, ids), np.int64, len(ids)) // width
        heads = np.arange(0, len(units), SLOT)
        return cls(np.add.reduceat(chars, heads), np.add.reduceat(tokens, heads))

    def find(self, place: int) -> tuple[int, int]:
        """(slot, its first character) of the character at ``place``."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if place >= start + self.chars[node] and self.chars[node + 1]:
                start += int(self.chars[node])
                node += 1
        return node - self.size, start

    def _set(self, slot: int, chars: int, tokens: int) -> None:
        for tree, value in ((self.chars, chars), (self.tokens, tokens)):
            node = slot + self.size
            tree[node] = value
            while node > 1:
                node //= 2
                tree[node] = tree[2 * node] + tree[2 * node + 1]

    def edit(self, text: str, start: int, end: int, new: str, encode: Encoder) -> str:
        """Replace ``text[start:end]`` and return the new text."""
        out = text[:start] + new + text[end:]
        grown = len(out) - len(text)
        first, low = self.find(start)
        last, high = self.find(max(start, end - 1))
        high += int(self.chars[self.size + last])

        def cut(place: int) -> bool:  # is it still a place where units part?
            return (0 < place < len(out) - 1 and out[place] == " "
                    and not out[place - 1].isspace() and not out[place + 1].isspace())

        while low > 0 and not (encode.by_unit and cut(low)):                   # context on the left
            first, low = self.find(low - 1)
        while high < len(text) and not (encode.by_unit and cut(high + grown)):  # and on the right
            last, high = self.find(high)
            high += int(self.chars[self.size + last])
        region = out[low:high + grown]
        if low and region:
            tokens = sum(map(len, map(encode.rest.__getitem__, split(region[1:])))) if encode.by_unit else 0
        else:
            tokens = len(encode.ids(region))
        tokens //= encode.kind.itemsize
        self.encoded += tokens
        self._set(first, len(region), tokens)
        for slot in range(first + 1, last + 1):
            if self.chars[self.size + slot]:
                self._set(slot, 0, 0)
        return out


def apply_edits(tree: TokenTree, text: str, edits: list[tuple[int, int, str]], encode: Encoder) -> str:
    """Edits ``(start, end, new)`` in places of the text before any of them,
    without overlaps; from the last to the first, so places hold."""
    for start, end, new in sorted(edits, reverse=True):
        text = tree.edit(text, start, end, new, encode)
    return text


def personal_edits(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), MASK) for m in PERSONAL.finditer(text)]


_KIND = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_edits", T.LongType()),
                      T.StructField("n_after", T.LongType()), T.StructField("n_encoded", T.LongType()),
                      T.StructField("chars", T.ArrayType(T.LongType())), T.StructField("tokens", T.ArrayType(T.LongType()))])
_ARROW = pa.struct([(n, pa.int64()) for n in ("n_tokens", "n_edits", "n_after", "n_encoded")]
                   + [(n, pa.list_(pa.int64())) for n in ("chars", "tokens")])


def count_tokens(docs: DataFrame, edits=personal_edits, tokenizer: str | None = None, text: str = "text",
                 leaves: bool = True, out: str = "count") -> DataFrame:
    """``docs`` with a struct column ``out``: ``n_tokens`` of the whole text;
    the number of its ``edits`` (a function of the text, giving places that
    don't overlap), ``n_after`` the tokens once they are applied, and
    ``n_encoded`` the tokens that had to be encoded for them; with ``leaves``
    the tree's slots after the edits (``chars`` and ``tokens``), to be kept
    and passed to :func:`update_counts`.

    A null text counts as empty (no token, no edit). All rows and columns stay
    (a column named like ``out`` is replaced).
    """
    path = tokenizer or tokenizer_path(TOKENIZER)

    @F.arrow_udf(_KIND)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(path)
        for batch in batches:
            rows = []
            for value in batch:
                value = value.as_py() or ""
                tree = TokenTree.build(value, encode)
                before, todo = tree.total, edits(value)
                apply_edits(tree, value, todo, encode)
                chars, tokens = tree.leaves() if leaves else (None, None)
                rows.append({"n_tokens": before, "n_edits": len(todo), "n_after": tree.total,
                             "n_encoded": tree.encoded, "chars": chars, "tokens": tokens})
            yield pa.array(rows, _ARROW)

    return docs.withColumn(out, of.asNondeterministic()(F.col(text)))




def update_counts(trees: DataFrame, tokenizer: str | None = None, out: str = "count") -> DataFrame:
    """A later round: rows with ``text`` (before the edits), the kept ``chars``
    and ``tokens`` and ``edits`` (an array of structs ``start, end, new``; null:
    none) -> the struct column ``out`` as above. No text is encoded whole."""
    path = tokenizer or tokenizer_path(TOKENIZER)

    @F.arrow_udf(_KIND)
    def of(text: pa.Array, chars: pa.Array, tokens: pa.Array, edits: pa.Array) -> pa.Array:
        encode, rows = encoder(path), []
        for value, c, t, todo in zip(text, chars, tokens, edits):
            value, todo = value.as_py() or "", [(e["start"], e["end"], e["new"] or "") for e in todo.as_py() or []]
            tree = TokenTree(np.array(c.as_py(), np.int64), np.array(t.as_py(), np.int64))
            before = tree.total
            apply_edits(tree, value, todo, encode)
            chars_, tokens_ = tree.leaves()
            rows.append({"n_tokens": before, "n_edits": len(todo), "n_after": tree.total,
                         "n_encoded": tree.encoded, "chars": chars_, "tokens": tokens_})
        return pa.array(rows, _ARROW)

    return trees.withColumn(out, of.asNondeterministic()("text", "chars", "tokens", "edits"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), leaves=False)
    return found.select("doc_id", "count.n_tokens", "count.n_edits", "count.n_after", "count.n_encoded")
