"""SentencePiece encoding and decoding with exact N-best segmentations.

A text is a lattice of the model's pieces. A forward Viterbi pass gives every
position the best score of reaching it; a backward A-star search from the end
uses these scores as exact heuristics, so it yields the segmentations in order
of their total score and expands little besides them.

No piece goes across the start of a word, nor across two characters that
are neighbours in no piece. The lattice falls apart there, so it is searched
in parts, once for each distinct part, and the best N sums are put together.
Texts are lists of word numbers; what is known of the words lies in arrays.
"""

from __future__ import annotations

import functools
import heapq
import random
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import table
from hirelens.llm.units import CACHED_CHARS, Cache, tokenizer_path

MODEL = "piece_bpe_32k.model"
N_BEST = 4
WORDS = 300_000  # distinct words kept by a worker: some 250 bytes each
WORD_CHARS = 16 * WORDS  # characters of these
SPACE = "▁"
PENALTY = 10.0   # an unknown character scores so much less than the worst piece
TOGETHER = 8192  # parts searched at once
LONGEST = 40     # characters of such parts; longer ones are searched one by one
LEARNT = 1 << 20  # characters of texts whose words are learnt together
SEARCHED = 1 << 19  # characters of new words whose parts are held at once
_RUNS = re.compile(f"{SPACE}+[^{SPACE}]*")


class Pieces:
    """The pieces and scores of a model, and searches over its lattice."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.known: dict[str, tuple[int, float]] = {}
        self.bytes: dict[int, int] = {}
        for i, piece in enumerate(self.text):
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.known[piece] = i, model.get_score(i)
        byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        self.raw = [byte_of.get(i, piece.replace(SPACE, " ").encode()) for i, piece in enumerate(self.text)]
        self.unknown = model.unk_id()
        self.lost = min((s for _, s in self.known.values()), default=0.0) - PENALTY
        self.prefixes = {p[:n] for p in self.known for n in range(1, len(p) + 1)}
        self.inside = {p[i:i + 2] for p in self.known for i in range(len(p) - 1)}
        self.by_word = not any(pair[0] != SPACE and pair[1] == SPACE for pair in self.inside)
        self.table = PieceTable(self)
        self.words = Words(self)
        self.options: dict[int, Cache] = {}

    def spell(self, character: str) -> list[int]:
        """Ids of a character that no piece covers: its bytes, or unknown."""
        data = character.encode()
        return [self.bytes[b] for b in data] if all(b in self.bytes for b in data) else [self.unknown]

    def _lattice(self, part: str) -> tuple[list[float], list[list[tuple[int, int, float]]]]:
        """Forward Viterbi scores of all positions, and the (start, id, score)
        edges into each, longest first (id -1: a character no piece covers)."""
        size, known, prefixes = len(part), self.known, self.prefixes
        best = [0.0] + [float("-inf")] * size
        into: list[list[tuple[int, int, float]]] = [[] for _ in range(size + 1)]
        for at in range(size):
            base, alone = best[at], True
            for end in range(at + 1, size + 1):
                piece = part[at:end]
                if piece not in prefixes:
                    break
                found = known.get(piece)
                if found:
                    into[end].append((at, found[0], found[1]))
                    if end == at + 1:
                        alone = False
                    if base + found[1] > best[end]:
                        best[end] = base + found[1]
            if alone:
                into[at + 1].append((at, -1, self.lost))
                if base + self.lost > best[at + 1]:
                    best[at + 1] = base + self.lost
        return best, into

    def n_best(self, part: str, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations (all, if fewer) as (score, ids), best
        first. Equal scores come in the order of the search: it prefers the
        longest way back, then the longer last piece."""
        size = len(part)
        best, into = self._lattice(part)
        agenda, out, turn = [(-best[size], size, 0, 0.0, None)], [], 0
        while agenda and len(out) < n:                  # backward A-star
            _, at, _, behind, path = heapq.heappop(agenda)
            if at == 0:
                ids: list[int] = []
                place = 0
                while path:
                    end, piece, path = path
                    ids += self.spell(part[place]) if piece < 0 else [piece]
                    place = end
                out.append((behind, ids))
                continue
            for start, piece, score in into[at]:
                turn += 1
                heapq.heappush(agenda, (-(best[start] + score + behind), start, turn, score + behind,
                                        (at, piece, path)))
        return out

    def cut(self, text: str) -> list[str]:
        """Parts between characters that are neighbours in no piece."""
        inside = self.inside
        at = [0, *(i for i in range(1, len(text)) if text[i - 1:i + 1] not in inside), len(text)]
        return [text[a:b] for a, b in zip(at, at[1:])]

    def _part(self, part: str) -> tuple[float, float, bytes]:
        """Best score, its lead over the second, best ids: the best path
        through an edge is its forward and backward scores together, and the
        second segmentation has some edge that the best has not."""
        size = len(part)
        if size == 1:
            found = self.known.get(part)
            score, ids = (found[1], [found[0]]) if found else (self.lost, self.spell(part))
            return score, float("inf"), array("i", ids).tobytes()
        best, into = self._lattice(part)
        back = [float("-inf")] * size + [0.0]
        way, second, ids = size, float("-inf"), []
        for at in range(size, 0, -1):
            behind, chosen = back[at], None
            for edge in into[at]:
                start, piece, score = edge
                if behind + score > back[start]:
                    back[start] = behind + score
                if at == way and chosen is None and best[start] + score == best[at]:
                    chosen = edge                        # the best path's edge: longest first
                elif best[start] + score + behind > second:
                    second = best[start] + score + behind
            if chosen:
                way = chosen[0]
                ids.append(self.spell(part[way]) if chosen[1] < 0 else [chosen[1]])
        return best[size], best[size] - second, array("i", [i for some in reversed(ids) for i in some]).tobytes()

    def segments(self, text: str) -> list[str]:
        """The words of a text, each without the space sign before it."""
        if not text:
            return []
        if self.by_word and not text.startswith(" ") and "  " not in text and SPACE not in text:
            return text.split(" ")
        escaped = SPACE + text.replace(" ", SPACE)
        return [run[1:] for run in _RUNS.findall(escaped)] if self.by_word else [escaped[1:]]

    def encode_batch(self, texts: list[str], n: int = N_BEST) -> Iterator[tuple[bytes, list[float], list[tuple], bool]]:
        """:meth:`encode` of each text, and whether decoding gives the text
        back; their words are learnt together."""
        at, known = 0, self.words
        while at < len(texts):
            end, size, words, stops = at, 0, [], [0]
            while end < len(texts) and (end == at or size + len(texts[end]) <= LEARNT):
                words += self.segments(texts[end])
                stops.append(len(words))
                size += len(texts[end])
                end += 1
            numbers = known.learn(words)
            sizes, scores, leads, odd = (x[numbers] for x in (known.sizes, known.scores, known.leads, known.odd))
            ids, places = _runs_of(known.ids, known.starts[numbers], sizes), np.append(0, np.cumsum(sizes))
            for text, a, b in zip(texts[at:end], stops, stops[1:]):
                data = ids[places[a]:places[b]].tobytes()
                best, changes = self._put_together(words[a:b], data, places[a:b + 1] - places[a], scores[a:b], leads[a:b], n)
                # If every word of a text comes back, the whole text does.
                back = not odd[a:b].any() or self.decode(np.frombuffer(data, np.int32).tolist()) == text.replace(SPACE, " ")
                yield data, best, changes, back
            at = end

    def encode(self, text: str, n: int = N_BEST) -> tuple[bytes, list[float], list[tuple]]:
        """(ids of the best segmentation as 32-bit integers, the N best
        scores, and how each of the N differs from the best: (start, stop, ids
        put there) in order of the text, see :func:`put_in`); N is 2 at
        least."""
        return next(self.encode_batch([text], n))[:3]

    def _put_together(self, words: list[str], data: bytes, places: np.ndarray, scores: np.ndarray, leads: np.ndarray,
                      n: int) -> tuple[list[float], list[list[tuple]]]:
        """The N best scores and the changes of :meth:`encode`, from the ids of
        the words, their places in ``data``, best scores and leads."""
        if not words:
            return [], []
        total = sum(scores.tolist())
        # The N best sums differ from the best in the N - 1 words of least lead at most.
        near = np.arange(len(leads))
        if len(leads) >= n:
            near = np.flatnonzero(leads <= np.partition(leads, n - 2)[n - 2])
            near = np.sort(near[np.argsort(leads[near], kind="stable")[:n - 1]])
        sums: list[tuple[float, tuple]] = [(0.0, ())]
        for k in near[leads[near] < np.inf].tolist():
            options = self._options(SPACE + words[k], n)
            best, own = options[0][0], np.frombuffer(data[4 * int(places[k]):4 * int(places[k + 1])], np.int32).tolist()
            # Among equal scores the search may not begin with the best that is returned.
            options = [(best, own), *[o for o in options if o[1] != own][:n - 1]]
            more = [(loss + best - score, choice + ((k, other),) if j else choice)
                    for loss, choice in sums for j, (score, other) in enumerate(options)]
            more.sort(key=lambda x: x[0])
            sums = more[:n]
        return ([total - loss for loss, _ in sums],
                [[(int(places[k]), int(places[k + 1]), other) for k, other in choice] for _, choice in sums])

    def _options(self, word: str, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best of a word, from the ``n`` best of its parts."""
        if n not in self.options:
            self.options[n] = Cache(lambda part: self.n_best(part, n), WORDS // 20)
        known = self.options[n]
        best: list[tuple[float, list[int]]] = [(0.0, [])]
        for part in self.cut(word):
            best = sorted([(s + t, a + b) for s, a in best for t, b in known[part]], key=lambda x: -x[0])[:n]
        return best

    def decode(self, ids) -> str:
        """The text of ids: pieces joined, bytes put together, spaces back."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class Numbers(dict):
    """Strings to numbers: a new one gets the next."""

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        return number


def _runs_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``data`` from ``starts``, one after the other."""
    stops = np.cumsum(sizes)
    return data[np.repeat(starts - stops + sizes, sizes) + np.arange(stops[-1] if len(stops) else 0)]


class Words:
    """What is known of words (strings without the space sign before them), by
    their numbers: how many pieces, best score, lead over the second, whether
    the ids decode to another text, and where the best ids are. A worker
    process keeps one for all its tasks; when it is full, the half that was
    met most often stays, so memory is bounded whatever the vocabulary."""

    def __init__(self, model: Pieces):
        self.model, self.numbers, self.chars = model, Numbers(), 0
        self.sizes, self.starts, self.met = (np.zeros(0, np.int64) for _ in range(3))
        self.scores, self.leads = np.zeros(0), np.zeros(0)
        self.odd, self.ids = np.zeros(0, bool), np.zeros(0, np.int32)

    def learn(self, words: list[str]) -> np.ndarray:
        """The numbers of words; new ones are searched together. The numbers
        hold until the next call."""
        if len(self.numbers) > WORDS or self.chars > WORD_CHARS:
            self._forget()
        old = len(self.numbers)
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        new = list(islice(self.numbers, old, None))
        places = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)))
        self.chars += int(places[-1]) if new else 0
        at = 0
        while at < len(new):
            end = max(at + 1, int(np.searchsorted(places, (places[at - 1] if at else 0) + SEARCHED, side="right")))
            sizes, scores, leads, odd, ids = self._search(new[at:end])
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
            self.sizes, self.scores = np.append(self.sizes, sizes), np.append(self.scores, scores)
            self.leads, self.odd = np.append(self.leads, leads), np.append(self.odd, odd)
            self.ids = np.append(self.ids, ids)
            at = end
        self.met = np.append(self.met, np.zeros(len(new), np.int64)) + np.bincount(numbers, minlength=len(self.numbers))
        return numbers

    def _forget(self) -> None:
        words = list(self.numbers)
        short = np.fromiter(map(len, words), np.int64, len(words)) <= CACHED_CHARS
        stay = np.flatnonzero(short & (self.met > 1))
        stay = np.sort(stay[np.argsort(-self.met[stay], kind="stable")[:WORDS // 2]])
        self.ids = _runs_of(self.ids, self.starts[stay], self.sizes[stay])
        self.sizes, self.scores, self.leads, self.odd = (x[stay] for x in (self.sizes, self.scores, self.leads, self.odd))
        self.starts, self.met = np.cumsum(self.sizes) - self.sizes, self.met[stay] // 2
        self.numbers = Numbers((words[k], i) for i, k in enumerate(stay.tolist()))
        self.chars = sum(map(len, self.numbers))

    def _search(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Pieces, best scores, leads, oddness and the ids of words, from
        those of their distinct parts."""
        table = self.model.table
        text = SPACE + SPACE.join(words)
        cut = table.cuts(text)
        first = np.cumsum([0, *[len(w) + 1 for w in words[:-1]]])
        cut[first] = True
        starts, parts = np.flatnonzero(cut), Numbers()
        bounds = [*starts.tolist(), len(text)]
        each = map(text.__getitem__, map(slice, bounds, bounds[1:]))
        which = np.fromiter(map(parts.__getitem__, each), np.int64, len(starts))
        sizes, scores, leads, odd, ids = table.search(list(parts))
        begins, word = (np.cumsum(sizes) - sizes)[which], np.searchsorted(starts, first)
        return (np.add.reduceat(sizes[which], word), np.add.reduceat(scores[which], word),
                np.minimum.reduceat(leads[which], word), np.logical_or.reduceat(odd[which], word),
                _runs_of(ids, begins, sizes[which]))


class PieceTable:
    """The same search over many parts at once. The pieces are a trie in
    arrays: the child of node ``v`` by a character of kind ``c`` is node
    ``base[v] + c``, if that node's parent is ``v``. Each step of the search
    is an array operation over all parts that have an edge there."""

    def __init__(self, model: Pieces):
        self.model = model
        paired = sorted(set("".join(model.inside)))
        characters = paired + sorted(set("".join(model.known)) - set(paired))
        kinds = {c: k for k, c in enumerate(characters, 1)}     # 0: in no piece
        self.kind = np.zeros(0x110000, np.int32)
        self.kind[[ord(c) for c in characters]] = np.arange(1, len(kinds) + 1)
        self.paired = len(paired)
        self.inside = np.zeros((len(paired) + 1, len(paired) + 1), bool)
        for a, b in model.inside:
            self.inside[kinds[a], kinds[b]] = True
        self.alone = np.array([False, *[c in model.known for c in characters]])
        self._plant(kinds)

    def _plant(self, kinds: dict[str, int]) -> None:
        below: dict[str, list[str]] = {}
        for prefix in sorted(self.model.prefixes):
            below.setdefault(prefix[:-1], []).append(prefix)
        most, rng, known = len(kinds) + 1, random.Random(0), self.model.known
        size = 1 << (4 * len(self.model.prefixes)).bit_length()
        used, nodes, bases = bytearray(size + most), {"": 0}, {}
        used[0] = True
        for prefix in sorted(below, key=lambda p: (len(p), -len(below[p]))):
            wanted = [kinds[child[-1]] for child in below[prefix]]
            for _ in range(1000):
                base = rng.randrange(size)
                if not any(used[base + k] for k in wanted):
                    break
            else:
                base = len(used)
                used.extend(bytes(most))
            bases[nodes[prefix]] = base
            for child, k in zip(below[prefix], wanted):
                used[base + k], nodes[child] = True, base + k
        self.base, self.parent, self.ids = np.zeros(len(used), np.int32), *(np.full(len(used), -1, np.int32) for _ in range(2))
        self.base[list(bases)] = list(bases.values())
        self.scores = np.zeros(len(used))
        for prefix, node in nodes.items():
            if prefix:
                self.parent[node] = nodes[prefix[:-1]]
                if prefix in known:
                    self.ids[node], self.scores[node] = known[prefix]

    def _kinds(self, text: str) -> np.ndarray:
        return self.kind[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def cuts(self, text: str) -> np.ndarray:
        """Whether no piece holds a character and the one before it."""
        kinds = self._kinds(text)
        kinds[kinds > self.paired] = 0
        return np.append(True, ~self.inside[kinds[:-1], kinds[1:]])

    def search(self, parts: list[str]) -> tuple[np.ndarray, ...]:
        """For each part what :meth:`Pieces._part` says: number of pieces, best
        score, lead over the second, whether its ids decode to another text
        (pieces alone never do); and the ids of all."""
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        kinds = self._kinds("".join(parts))
        begins = np.cumsum(lengths) - lengths
        plain = (lengths <= LONGEST) & np.logical_and.reduceat(self.alone[kinds], begins)
        sizes, odd = np.zeros(len(parts), np.int64), np.zeros(len(parts), bool)
        scores, leads = np.zeros(len(parts)), np.zeros(len(parts))
        order, ids = [], []
        for k in np.flatnonzero(~plain).tolist():
            scores[k], leads[k], data = self.model._part(parts[k])
            own = np.frombuffer(data, np.int32)
            sizes[k] = len(own)
            odd[k] = b"".join([self.model.raw[i] for i in own.tolist()]) != parts[k].replace(SPACE, " ").encode()
            order.append([k])
            ids.append(own)
        some = np.flatnonzero(plain)
        some = some[np.argsort(-lengths[some], kind="stable")]
        for at in range(0, len(some), TOGETHER):
            group = some[at:at + TOGETHER]
            sizes[group], scores[group], leads[group], own = self._together(
                _runs_of(kinds, begins[group], lengths[group]), lengths[group])
            order.append(group)
            ids.append(own)
        order = np.concatenate(order)
        starts = np.zeros(len(parts), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return sizes, scores, leads, odd, _runs_of(np.concatenate(ids), starts, sizes)

    def _together(self, kinds: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """The search over parts in order of falling length, each of whose
        characters is a piece."""
        n, longest, low = len(lengths), int(lengths[0]), float("-inf")
        columns = np.zeros((n, longest), np.int32)
        columns[np.arange(longest) < lengths[:, None]] = kinds
        columns = np.ascontiguousarray(columns.T)
        longer = np.searchsorted(-lengths, -np.arange(longest + 1), side="left")   # parts with a character there
        every = np.arange(n)
        best, back = np.full((longest + 1, n), low), np.full((longest + 1, n), low)
        best[0], back[lengths, every] = 0.0, 0.0
        came, last = np.zeros((longest + 1, n), np.int32), np.zeros((longest + 1, n), np.int32)
        edges = []
        for start in range(longest):
            rows, node = every[:longer[start]], np.zeros(longer[start], np.int32)
            for end in range(start + 1, longest + 1):
                rows = rows[:np.searchsorted(rows, longer[end - 1])]
                node = node[:len(rows)]
                child = self.base[node] + columns[end - 1, rows]
                there = self.parent[child] == node
                rows, node = rows[there], child[there]
                if not len(rows):
                    break
                whole = self.ids[node] >= 0
                on, piece = rows[whole], node[whole]
                score = self.scores[piece]
                total = best[start, on] + score
                edges.append((start, end, on, score, total))
                better = total > best[end, on]              # of equal ones the longest piece
                on = on[better]
                best[end, on], came[end, on], last[end, on] = total[better], start, piece[better]
        # The best paths, from their ends.
        to, path = np.zeros((longest + 1, n), np.int32), np.full((longest, n), -1, np.int32)
        way = lengths.copy()
        for end in range(longest, 0, -1):
            on = np.flatnonzero(way == end)
            start = came[end, on]
            to[start, on], path[start, on] = end, self.ids[last[end, on]]
            way[on] = start
        second = np.full(n, low)
        for start, end, on, score, total in reversed(edges):
            behind = back[end, on]
            back[start, on] = np.maximum(back[start, on], behind + score)
            second[on] = np.maximum(second[on], np.where(to[start, on] == end, low, total + behind))
        path = np.ascontiguousarray(path.T)
        used, total = path >= 0, best[lengths, every]
        return used.sum(axis=1), total, total - second, path[used]


def put_in(data: bytes, changes) -> bytes:
    """The best segmentation's ids (32-bit integers) with those of another
    put in: ``changes`` are (start, stop, ids), not overlapping, in order."""
    out, at = [], 0
    for start, stop, ids in changes:
        out += [data[4 * at:4 * start], array("i", ids).tobytes()]
        at = stop
    return b"".join([*out, data[4 * at:]])


@functools.cache
def pieces(path: str) -> Pieces:
    """The worker process's copy of a model."""
    return Pieces(path)


_KIND = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("scores", T.ArrayType(T.DoubleType())),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("round_trip", T.BooleanType()),
    T.StructField("ranks", T.ArrayType(T.StructType([
        T.StructField("n_pieces", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("changes", T.ArrayType(T.StructType([
            T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()),
            T.StructField("ids", T.ArrayType(T.IntegerType()))])))]))),
])
_ARROW = pa.struct([("ids", pa.list_(pa.int32())), ("scores", pa.list_(pa.float64())),
                    ("ids_crc32", pa.int64()), ("round_trip", pa.bool_()), ("ranks", pa.list_(pa.struct([
                        ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("changes", pa.list_(pa.struct([
                            ("start", pa.int32()), ("stop", pa.int32()), ("ids", pa.list_(pa.int32()))])))])))])


def encode(docs: DataFrame, model: str | None = None, n: int = N_BEST, text: str = "text",
           out: str = "pieces") -> DataFrame:
    """``docs`` with a struct column ``out``: ``ids`` of the best segmentation
    of the whole text, the ``n`` best ``scores`` (fewer if there are fewer
    segmentations), ``ids_crc32`` over the ids as little-endian 32-bit
    integers, and ``round_trip``: decoding the ids gives the text back (the
    space sign U+2581 in a text comes back as a space). ``ranks`` has all ``n``
    segmentations, in step with the scores: their ``n_pieces``, ``ids_crc32``
    and ``changes``, the places ``start:stop`` of ``ids`` (none for the best)
    that hold other ids; :func:`segmentations` gives their ids in full.

    A null or empty text has no ids and no scores. All rows and columns stay
    (a column named like ``out`` is replaced).
    """
    path = model or tokenizer_path(MODEL)

    @F.arrow_udf(_KIND)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = pieces(path)
        for batch in batches:
            ids, ends, scores, sums, whole, ranks = [], [0], [], [], [], []
            texts = [t or "" for t in batch.to_pylist()]
            for data, best, changes, back in found.encode_batch(texts, n):
                one = np.frombuffer(data, np.int32)
                ids.append(one)
                ends.append(ends[-1] + len(one))
                scores.append(best)
                sums.append(zlib.crc32(data))
                whole.append(back)
                every = [put_in(data, c) if c else data for c in changes]
                ranks.append([(len(e) // 4, sums[-1] if e is data else zlib.crc32(e), c) for e, c in zip(every, changes)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                             pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])))
            yield pa.StructArray.from_arrays(
                [lists, pa.array(scores, pa.list_(pa.float64())), pa.array(sums, pa.int64()),
                 pa.array(whole, pa.bool_()), pa.array(ranks, _ARROW.field("ranks").type)], fields=list(_ARROW))

    return docs.withColumn(out, of.asNondeterministic()(F.col(text)))


def segmentations(found: DataFrame, column: str = "pieces", out: str = "segmentations") -> DataFrame:
    """``found`` with the ids of every segmentation of :func:`encode`, best
    first, in column ``out``: an array of arrays."""
    @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for best, ranks in batches:
            every = []
            for ids, some in zip(best, ranks.to_pylist()):
                data = b"" if ids.as_py() is None else np.asarray(ids.values, np.int32).tobytes()
                every.append(None if some is None else [np.frombuffer(put_in(data, [
                    (c["start"], c["stop"], c["ids"]) for c in r["changes"]]), np.int32) for r in some])
            yield pa.array(every, pa.list_(pa.list_(pa.int32())))

    return found.withColumn(out, of(F.col(f"{column}.ids"), F.col(f"{column}.ranks")))


def decode(ids: DataFrame, model: str | None = None, column: str = "ids", out: str = "text") -> DataFrame:
    """``ids`` with the decoded text in column ``out`` (null ids: null)."""
    path = model or tokenizer_path(MODEL)

    @F.arrow_udf(T.StringType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = pieces(path)
        for batch in batches:
            yield pa.array([None if x is None else found.decode(x) for x in batch.to_pylist()], pa.string())

    return ids.withColumn(out, of(F.col(column)))


def op7_sentencepiece_n_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size("pieces.ids").cast("long").alias("n_pieces"), "pieces.scores",
                        "pieces.ids_crc32", "pieces.round_trip", F.col("pieces.ranks.n_pieces").alias("rank_pieces"),
                        F.col("pieces.ranks.ids_crc32").alias("rank_crc32"))
