"""Conversation repair against a plain dynamic programme over whole conversations."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from hirelens.llm import conversations as C
from tests.conftest import SF_SMALL
from tests.llm.cases import pairs

LETTER = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """rows of (role, fault name) -> (cost, audit), by a table from the end."""
    best = {state: (0, "") if state in ("", "a") else None for state in LETTER}

    def inserted(table):
        for _ in range(4):
            for state in LETTER:
                to = "a" if state == "u" else "u"
                if table[to] is not None:
                    way = (table[to][0] + 2, "I" + table[to][1])
                    table[state] = min(table[state] or way, way)
        return table
    best = inserted(best)
    for role, fault in reversed(rows):
        new = {}
        for state, letters in LETTER.items():
            ways = [(best[state][0] + 3, "D" + best[state][1])]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] and role[:1] in letters:
                    c, a = best[role[:1]]
                    ways.append((c + extra, "K" + a))
                c, a = best["a" if state == "u" else "u"]
                ways.append((c + 2 + extra, "R" + a))
            new[state] = min(ways)
        best = inserted(new)
    return best[""]


def plain(rows):
    """rows of (conv_id, turn, role, text) -> results, damage included."""
    out = {}
    for conv, turn, role, text in rows:
        have = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        have += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, have in out.items():
        have.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, told = set(), []
        for _, role, text in have:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            told.append((role, "blank" if not marks else "duplicate" if (role, text) in seen
                         else "truncated" if marks[-1] not in ".!?" else ""))
            seen.add((role, text))
        cost, audit = cheapest(told)
        lines, state, i = [], "", 0
        for edit in audit:
            if edit != "I":
                _, role, text = have[i]
                i += 1
            if edit == "D":
                continue
            to = role[:1] if edit == "K" else "a" if state == "u" else "u"
            lines.append(f"{role}:{text}" if edit == "K" else
                         f"{'user' if to == 'u' else 'assistant'}:{text if edit == 'R' else ''}")
            state = to
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        turns = {t for t, _, _ in have if t is not None}
        first = [r[:1] for _, r, _ in have]
        out[conv] = (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                     *[sum(f == k for _, f in told) for k in ("blank", "duplicate", "truncated")],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return sorted(out.values(), key=repr)


def run(df):
    return pairs(C.repair(C.damaged(df), gone=F.col("gone")))


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.01"])
def test_query_equals_the_plain_version(spark, sf):
    got = C.op11_conversation_repair(spark, sf)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           "repaired_sha256"]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert pairs(got) == plain(rows)


def test_search_finds_the_cheapest_and_least_edits():
    rng = random.Random(2)
    names = ["", "blank", "duplicate", "truncated"]
    for _ in range(1500):
        rows = [(rng.choice("suuuaaat "), rng.choice(names + [""] * 4)) for _ in range(rng.randrange(14))]
        assert C.Search([(r, names.index(f)) for r, f in rows]).best() == cheapest(rows)


def test_long_conversations_are_searched_in_segments(spark):
    """One conversation has most rows; its rows repeat across segments; turns
    tie, are null and missing; another has only equal rows."""
    rng = random.Random(4)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", None]
    rows = [(7, rng.randrange(4000) if rng.random() < 0.97 else None, rng.choice(roles),
             rng.choice(["Yes.", "no", "", "What?", None]) if rng.random() < 0.3 else f"line {i}.") for i in range(1500)]
    rows += [(8, 3, "user", "same thing.")] * 400
    rows += [(i, t, "assistant" if t % 2 else "user", f"t {t}!") for i in (9, None) for t in range(C.SEGMENT * 2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    assert run(df) == plain(rows)


def test_edges(spark):
    rows = [("a", None, None, None), ("a", 1, "user", "hi."), ("b", 5, "user", "x" * 300_000 + " end"),
            ("c", -2, "system", "s."), ("c", 9, "", "t."), ("c", 9, "", "t."), (None, None, "user", "?"),
            ("", 0, "assistant", " \t "), ("=", 2, "user", "é! "), ("a:b", 1, "uX", "keeps its role.")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    want = plain([(c, t, r or None, x) for c, t, r, x in rows])
    assert run(df) == want
    clash = df.select("*", *[F.lit(1).alias(c) for c in ("conv", "part", "run", "segment", "found", "k")])
    assert pairs(C.repair(clash)) == pairs(C.repair(df))
    assert C.repair(df.limit(0)).collect() == []
    gone = C.repair(df.where("conv_id = 'c'"), gone=F.lit(True)).collect()
    assert [tuple(r) for r in gone] == [("c", 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
