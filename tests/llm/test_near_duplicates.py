import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from hirelens.llm import components, simhash
from tests.llm.cases import edge_docs, no_docs


def plain_fingerprint(text):
    if text is None:
        return 0
    words = text.translate({c: c + 32 for c in range(65, 91)}).encode()
    words = [w for w in __import__("re").findall(rb"[^\x20\x09-\x0D]+", words)]
    parts = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(nodes, close):
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if close(a, b):
                low, high = sorted((find(a), find(b)))
                top[high] = low
    return {n: find(n) for n in nodes}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aAbÉé \t\n\r\x0b\x0c\x1c\xa0z.", max_size=60))
def test_fingerprint_is_the_contracts(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_long_texts_are_hashed_in_pieces():
    text = " ".join(random.Random(1).choice(["ab", "cd", "ef", "gh"]) for _ in range(900_000))
    whole = text.encode()
    assert len(whole) > 2 << 20
    words = whole.split()
    counts = np.zeros(64, int)
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(len(words) - 2)], np.uint64)
    for b in range(64):
        counts[b] = int((hashes >> np.uint64(b) & np.uint64(1)).sum())
    assert simhash.fingerprint(whole) == sum(1 << b for b in range(64) if counts[b] * 2 > len(hashes))


def test_spark_hash_is_the_same(spark):
    row = spark.sql("select xxhash64('the quick fox') as h").first()
    assert row["h"] % (1 << 64) == xxhash.xxh64_intdigest(b"the quick fox", 42)


def test_tiles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)  # many tiles a cell
    rng = random.Random(7)
    prints = set()
    for _ in range(40):
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 6, 40])):
            prints.add(at)
            for _ in range(rng.choice([1, 2, 3])):
                at ^= 1 << rng.randrange(64)
    prints |= {0, (1 << 64) - 1, 1, 3, 7}
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    want = plain_components(signed, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 2)
    links = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 2)
    got = {r["node"]: r["root"] for r in components.roots(links).collect()}
    assert {p: got.get(p, p) for p in signed} == want
    assert links.count() < 40 * len(signed)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5, 5), (7, 8)]
    got = {r["node"]: r["root"] for r in components.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 80)}
    assert components.roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_match_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) for _ in range(rng.randint(0, 400)))
            for _ in range(40)]
    texts = base + [t.replace("alpha", "alpha", 1) + rng.choice(["", " ", " tail"]) for t in base[:25]] + base[:10] + [None, ""]
    rows = list(enumerate(texts, start=100))
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"])
           for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    prints = {d: plain_fingerprint(t) for d, t in rows}
    want = plain_components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert got == {d: (prints[d], want[d]) for d in prints}


def test_edge_cases(spark):
    rows = simhash.near_duplicates(edge_docs(spark)).collect()
    assert len(rows) == 12
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert [r["component_id"] for r in by[1]] == [1, 1]
    assert {r["component_id"] for r in by[None]} == {1, 2}         # they follow the ids of their groups
    assert {by[i][0]["fp"] for i in (2, 3, 4)} == {0}
    assert {by[i][0]["component_id"] for i in (2, 3, 4)} == {2}
    assert simhash.near_duplicates(no_docs(spark)).count() == 0
    only = spark.createDataFrame([(None, "a b c d"), (None, None)], "doc_id long, text string")
    assert [r["component_id"] for r in simhash.near_duplicates(only).collect()] == [None, None]
