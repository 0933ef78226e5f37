"""Conversation repair by iterative-deepening A*.

Rows of one conversation are kept, given another role, deleted, or empty ones
inserted, so that the roles' initials match ``(s?(ua)+)?``. A depth-first
search tries edits in ASCII order of their initials (Delete, Insert, Keep,
Rerole) under a cost bound; the bound grows until a path is accepted, which is
then the cheapest and among those the ASCII-least. A transposition table keeps
for each failed state what it needs at least, across bounds.

Rows are dealt by ranges of (conversation, turn), not by conversation, so a
conversation of any length is spread. A task sees runs of rows in order. A
conversation that lies inside one task and has ``SEGMENT`` rows at most is
repaired there; any other is cut into segments, each searched once for every
pair of grammar states at its ends. A pass over these small tables chooses the
states along each conversation; then all segments are repaired by themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import table, written

SEGMENT = 64          # rows that are searched at once
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLANK, DUPLICATE, CUT_OFF = 1, 2, 3
START, SYSTEM, USER, ASSISTANT = range(4)
# The grammar (s?(ua)+)?: the next state for each role initial; a repair can only add or name the last of them.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ACCEPTED = (START, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
REACHES = ((START, SYSTEM, USER, ASSISTANT), (SYSTEM, USER, ASSISTANT), (USER, ASSISTANT), (USER, ASSISTANT))
TAIL = (0, 2, 1, 0)   # rows to insert after the last row, by state
_LEGAL = {"su", "ua", "au"}
_SPACES = " \t\n\x0b\x0c\r"


def wanted(state: int) -> str:
    """The role initial that an inserted row, or one with a new role, has."""
    return "a" if state == USER else "u"


class Search:
    """Repairs of a list of rows ``(initial, fault)``; ``fault`` is 0, BLANK,
    DUPLICATE or CUT_OFF. ``ends`` are the states accepted after the last row;
    rows are inserted after it only where ``trailing``."""

    def __init__(self, rows: list[tuple[str, int]], ends: tuple[int, ...] = ACCEPTED, trailing: bool = True):
        self.rows, self.ends, self.trailing = rows, ends, trailing
        self.least = [0] * (len(rows) + 1)      # of the edits from a row on: what its fault alone costs
        for i in range(len(rows) - 1, -1, -1):
            fault = rows[i][1]
            self.least[i] = self.least[i + 1] + (DELETE if fault in (BLANK, DUPLICATE) else TRUNCATED if fault else 0)
        # States that can still reach an accepted one, and the cost of the dearest repair that can be needed.
        self.open = [any(end in ends for end in REACHES[state]) for state in range(4)]
        self.most = DELETE * len(rows) + 2 * INSERT + TRUNCATED
        self.needs: dict[int, int] = {}         # 4 * row + state -> cost that any accepting path from there has at least

    def moves(self, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(edit, cost, next row, next state) in ASCII order."""
        n = len(self.rows)
        if i < n:
            initial, fault = self.rows[i]
            yield "D", DELETE, i + 1, state
        if i < n or self.trailing:
            yield "I", INSERT, i, NEXT[state][wanted(state)]
        if i < n and fault not in (BLANK, DUPLICATE):
            extra = TRUNCATED if fault else 0
            if initial in NEXT[state]:
                yield "K", KEEP + extra, i + 1, NEXT[state][initial]
            yield "R", REROLE + extra, i + 1, NEXT[state][wanted(state)]

    def descend(self, state: int, bound: int) -> str | None:
        """The first accepting path of cost ``bound`` at most. Iterative, so
        that a path may be longer than Python's stack."""
        n, ends, needs, least = len(self.rows), self.ends, self.needs, self.least
        if n == 0 and state in ends:
            return ""
        path, stack = [], [[0, state, bound, self.moves(0, state), 1 << 60]]
        while stack:
            i, state, left, moves, need = top = stack[-1]
            for edit, cost, j, after in moves:
                if not self.open[after]:
                    continue
                ahead = cost + max(needs.get(4 * j + after, 0), least[j])
                if ahead > left:
                    top[4] = min(top[4], ahead)
                    continue
                path.append(edit)
                if j == n and after in ends:
                    return "".join(path)
                stack.append([j, after, left - cost, self.moves(j, after), 1 << 60])
                break
            else:
                stack.pop()
                needs[4 * i + state] = max(needs.get(4 * i + state, 0), top[4])
                if stack:
                    above = stack[-1]
                    path.pop()
                    above[4] = min(above[4], above[2] - left + top[4])
        return None

    def best(self, state: int = START) -> tuple[int, str] | None:
        """Cost and edits; None if no repair ends in ``ends``."""
        bound = self.least[0]
        while bound <= self.most:
            path = self.descend(state, bound)
            if path is not None:
                return bound, path
            bound = max(bound + 1, self.needs[state])
        return None


def repaired(rows: list[tuple[str, str]], edits: str, state: int = START) -> Iterator[str]:
    """The lines ``role:text`` after the edits of rows ``(role, text)``."""
    row = iter(rows)
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(row)
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else wanted(state)
        yield f"{role if edit == 'K' else NAMES[initial]}:{text}"
        state = NEXT[state][initial]


def faults(rows: list[tuple[str, str]], seen: set) -> list[int]:
    """Each row's first fault; ``seen`` gathers the conversation's rows (as
    128-bit hashes)."""
    found = []
    for role, text in rows:
        row = xxhash.xxh3_128_intdigest(f"{len(role)}:{role}{text}")
        text = text.strip(_SPACES)
        found.append(BLANK if not text else DUPLICATE if row in seen else CUT_OFF if text[-1] not in ".!?" else 0)
        seen.add(row)
    return found


@dataclass
class Report:
    """Sums over a conversation's rows, given run by run in order."""

    counts: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    last: str | None = None
    turns: list = field(default_factory=list)   # smallest, largest, distinct

    def add(self, initials: str, found: list[int], turns: list[int | None]) -> None:
        for fault in found:
            self.counts[fault] += 1
        if initials:
            whole = (self.last or "") + initials
            self.illegal += sum(whole[k:k + 2] not in _LEGAL for k in range(len(whole) - 1))
            self.last = initials[-1]
        for turn in turns:
            if turn is not None:
                if not self.turns:
                    self.turns = [turn, turn, 1]
                elif turn != self.turns[1]:
                    self.turns[1:] = [turn, self.turns[2] + 1]

    def row(self, cost: int, audit: str, digest: str) -> dict:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return {"gaps": gaps, "blank": self.counts[BLANK], "duplicate": self.counts[DUPLICATE],
                "truncated": self.counts[CUT_OFF], "illegal": self.illegal, "cost": cost, "audit": audit,
                "repaired_sha256": digest}


_RESULT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
           ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
_RESULT_SQL = ", ".join(f"{k} {'long' if t == pa.int64() else 'string'}" for k, t in _RESULT)
_RESULT_STRUCT = f"struct<{','.join(f'{k}:{"bigint" if t == pa.int64() else "string"}' for k, t in _RESULT)}>"
_RUN = pa.struct([("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("found", pa.list_(pa.int8())),
                  ("turns", pa.list_(pa.int64()))])
_RUN_SQL = "struct<roles:array<string>,texts:array<string>,found:array<tinyint>,turns:array<bigint>>"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows -> a row for each repaired conversation, or for each
    segment of one that the task may not hold whole."""
    part, done, cut = TaskContext.get().partitionId(), [], []
    conv, rows, turns, seen, segment, first = None, [], [], set(), 0, True

    def close(whole: bool) -> None:
        nonlocal rows, turns, segment
        found = faults(rows, seen)
        if whole:
            report = Report()
            report.add("".join(r[:1] for r, _ in rows), found, turns)
            cost, audit = Search([(r[:1], f) for (r, _), f in zip(rows, found)]).best()
            lines = "\n".join(repaired(rows, audit))
            done.append({"conv": conv, **report.row(cost, audit, hashlib.sha256(lines.encode()).hexdigest())})
        else:
            cut.append({"conv": conv, "part": part, "segment": segment, "run": {
                "roles": [r for r, _ in rows], "texts": [t for _, t in rows], "found": found, "turns": turns}})
        rows, turns, segment = [], [], segment + 1

    def out() -> Iterator[pa.RecordBatch]:
        result, lists = pa.struct(_RESULT), [x for x in (done, cut) if x]
        for told in lists:
            yield pa.record_batch({
                "conv": pa.array([x["conv"] for x in told], pa.string()),
                "part": pa.array([x.get("part") for x in told], pa.int32()),
                "segment": pa.array([x.get("segment") for x in told], pa.int64()),
                "run": pa.array([x.get("run") for x in told], _RUN),
                "result": pa.array([None if "run" in x else {k: x[k] for k, _ in _RESULT} for x in told], result)})
            told.clear()

    for batch in batches:
        for key, turn, role, text, gone in zip(*(batch.column(c).to_pylist()
                                                 for c in ("conv", "turn", "role", "text", "gone"))):
            if key != conv:
                if conv is not None:
                    close(whole=not first and segment == 0)
                    first = False
                conv, seen, segment = key, set(), 0
            if len(rows) == SEGMENT:
                close(whole=False)
            if not gone:
                rows.append((role, text))
                turns.append(turn)
        if sum(map(len, (done, cut))) >= 1024:
            yield from out()
    if conv is not None:
        close(whole=False)      # it may go on in the next task
    yield from out()


def _tables(found: list[int], initials: list[str]) -> tuple[list[int], list[int], list[str]]:
    """For all 16 pairs of states before and after a segment: the cost (-1:
    impossible), the place of the edits among those from the same state in
    ASCII order, and the edits."""
    rows = list(zip(initials, found))
    costs, ranks, edits = [], [], []
    for state in range(4):
        best = [Search(rows, (end,), False).best(state) for end in range(4)]
        order = sorted(b[1] for b in best if b)
        costs += [b[0] if b else -1 for b in best]
        ranks += [order.index(b[1]) if b else -1 for b in best]
        edits += [b[1] if b else "" for b in best]
    return costs, ranks, edits


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        told = []
        for run, later in zip(batch.column("run").to_pylist(), batch.column("later").to_pylist()):
            for k in later or ():
                if run["found"][k] != BLANK:
                    run["found"][k] = DUPLICATE
            told.append((run, *_tables(run["found"], [r[:1] for r in run["roles"]])))
        yield pa.record_batch({
            "conv": batch.column("conv"), "part": batch.column("part"), "segment": batch.column("segment"),
            "run": pa.array([x[0] for x in told], _RUN), "costs": pa.array([x[1] for x in told], pa.list_(pa.int64())),
            "ranks": pa.array([x[2] for x in told], pa.list_(pa.int64())),
            "edits": pa.array([x[3] for x in told], pa.list_(pa.string()))})


class Chain:
    """The states between a conversation's segments: for each state reached
    so far its cost and the place of its edits among those of all states."""

    def __init__(self):
        self.cost, self.rank, self.back = {START: 0}, {START: 0}, []

    def add(self, costs: list[int], ranks: list[int]) -> None:
        best = {}
        for end in range(4):
            ways = [(self.cost[s] + costs[4 * s + end], self.rank[s], ranks[4 * s + end], s)
                    for s in self.cost if costs[4 * s + end] >= 0]
            if ways:
                best[end] = min(ways)
        order = sorted(best, key=lambda end: best[end][1:])
        self.cost = {end: way[0] for end, way in best.items()}
        self.rank = {end: order.index(end) for end in best}
        self.back.append(bytes(best[end][3] if end in best else 0 for end in range(4)))

    def states(self) -> tuple[int, list[int]]:
        """The whole cost, and the states around all segments."""
        end = min(self.cost, key=lambda s: (self.cost[s] + INSERT * TAIL[s], self.rank[s]))
        states = [end]
        for back in reversed(self.back):
            states.append(back[states[-1]])
        return self.cost[end] + INSERT * TAIL[end], states[::-1]


def _by_conversation(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[str, Iterator[tuple]]]:
    """Rows sorted by conversation, one conversation after the other."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ["conv", *columns])))
    held = next(rows, None)
    while held is not None:
        conv = held[0]

        def own() -> Iterator[tuple]:
            nonlocal held
            while held is not None and held[0] == conv:
                now, held = held, next(rows, None)
                yield now[1:]
        yield conv, own()


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conv, rows in _by_conversation(batches, ["part", "segment", "costs", "ranks"]):
        chain, places = Chain(), []
        for part, segment, costs, ranks in rows:
            chain.add(costs, ranks)
            places.append((part, segment))
        cost, states = chain.states()
        for at in range(0, len(places), 4096):
            some = places[at:at + 4096]
            yield pa.record_batch({
                "conv": pa.array([conv] * len(some)), "part": pa.array([p for p, _ in some], pa.int32()),
                "segment": pa.array([s for _, s in some], pa.int64()),
                "before": pa.array(states[at:at + len(some)], pa.int32()),
                "after": pa.array(states[at + 1:at + 1 + len(some)], pa.int32()),
                "cost": pa.array([cost] * len(some), pa.int64())})


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    told = []
    for conv, rows in _by_conversation(batches, ["run", "edits", "before", "after", "cost"]):
        report, sha, audit, after, cost, some = Report(), hashlib.sha256(), [], START, 0, False
        for run, edits, before, after, cost in rows:
            report.add("".join(r[:1] for r in run["roles"]), run["found"], run["turns"])
            audit.append(edits[4 * before + after])
            for line in repaired(list(zip(run["roles"], run["texts"])), audit[-1], before):
                sha.update((b"\n" if some else b"") + line.encode())
                some = True
        audit.append("I" * TAIL[after])
        for line in repaired([], audit[-1], after):
            sha.update((b"\n" if some else b"") + line.encode())
            some = True
        told.append((conv, report.row(cost, "".join(audit), sha.hexdigest())))
        if len(told) >= 1024:
            yield _results(told)
            told = []
    if told:
        yield _results(told)


def _results(told: list[tuple[str, dict]]) -> pa.RecordBatch:
    return pa.record_batch({"conv": pa.array([c for c, _ in told]),
                            **{k: pa.array([x[k] for _, x in told], t) for k, t in _RESULT}})


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", gone: Column | None = None) -> DataFrame:
    """One row per ``conv_id``: ``gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256``.

    Rows come by turn (nulls first); rows of one turn by role, then by the
    first 64 characters of the text, then by its MD5. A null role or text is
    one space, so the row is blank; an empty role is one space too. A null
    conv_id is a conversation of its own. Rows where ``gone`` holds only name
    their conversation; one without other rows has zeros, an empty audit and
    the hash of the empty string. Other columns are ignored. An empty table
    gives an empty result.

    A conversation's audit and hash are one value each, so one task reads a
    conversation's segments at the end, one after the other in bounded memory
    (but for the audit itself); all searches are spread."""
    named = F.when(F.col(conv_id).isNull(), "").otherwise(F.concat(F.lit("="), F.col(conv_id).cast("string")))
    plain = rows.select(
        F.col(conv_id).alias("conv_id"), named.alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.when(F.coalesce(F.col(role), F.lit("")) == "", " ").otherwise(F.col(role)).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        F.coalesce(gone if gone is not None else F.lit(False), F.lit(False)).alias("gone"))
    # Equal rows can be swapped, so a number of the row may part them: no value is too common to be spread.
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 64), F.md5("text"),
             F.col("_row")]
    dealt = plain.drop("conv_id").withColumn("_row", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = written(dealt.select("conv", "turn", "role", "text", "gone").mapInArrow(
        _runs, f"conv string, part int, segment long, run {_RUN_SQL}, result {_RESULT_STRUCT}"), "runs")
    whole = runs.where("result IS NOT NULL").select("conv", "result.*")
    cut = runs.where("run IS NOT NULL").drop("result")

    # Rows of a segment that an earlier segment of the conversation has too.
    place = F.struct("part", "segment")
    keys = written(cut.select("conv", "part", "segment", F.posexplode(F.arrays_zip("run.roles", "run.texts")))
                   .select("conv", "part", "segment", "pos", F.md5(F.concat(
                       F.length("col.roles").cast("string"), F.lit(":"), "col.roles", "col.texts")).alias("k")), "row-keys")
    first = keys.groupBy("conv", "k").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    again = written(first.where("first <> last").select("conv", "k", "first"), "row-keys-again")
    later = (keys.join(again, ["conv", "k"]).where(place > F.col("first"))
             .groupBy("conv", "part", "segment").agg(F.collect_list("pos").alias("later")))
    solved = written(cut.join(later, ["conv", "part", "segment"], "left").mapInArrow(
        _solved, f"conv string, part int, segment long, run {_RUN_SQL}, costs array<long>, ranks array<long>, "
                 "edits array<string>"), "segments")
    chained = written(solved.select("conv", "part", "segment", "costs", "ranks").repartition("conv")
                      .sortWithinPartitions("conv", "part", "segment")
                      .mapInArrow(_chained, "conv string, part int, segment long, before int, after int, cost long"),
                      "chains")
    joined = (solved.join(chained, ["conv", "part", "segment"]).repartition("conv")
              .sortWithinPartitions("conv", "part", "segment")
              .select("conv", "run", "edits", "before", "after", "cost").mapInArrow(_joined, f"conv string, {_RESULT_SQL}"))
    found = whole.unionByName(joined)
    kind = rows.schema[conv_id].dataType
    back = F.when(F.col("conv") == "", F.lit(None)).otherwise(F.expr("substring(conv, 2)")).cast(kind)
    return found.select(back.alias("conv_id"), *[k for k, _ in _RESULT])


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with a column ``gone`` and a fault in every row whose
    crc32(``conv_id:turn``) mod 20 is below 5 (nulls are one space): 0 drops
    the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4
    makes it the user's."""
    def told(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(told("text"), ".!?", "")).otherwise(told("text"))
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(told("role")).alias("role"),
                        text.alias("text"), (kind == 0).alias("gone"), times.alias("times"))
            .withColumn("times", F.explode("times")).drop("times"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return repair(rows, gone=F.col("gone"))
