import random
import re

import numpy as np

from hirelens.llm import decontaminate, topk
from tests.llm.cases import LONG, edge_docs, no_docs, pairs


def plain_top_k(rows, every, k):
    import math
    ok = [(i, v, [math.floor(64 * float(np.float32(x))) for x in e]) for i, (v, e) in enumerate(rows)
          if v is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, q, w in ok:
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(w, x)), v) for j, v, x in ok if j != i)[:k]
            out += [(q, n, v, -s) for n, (s, v) in enumerate(found, 1)]
    return sorted(out, key=repr)


def test_top_k_equals_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, [rng.choice([-1.5, -0.2, 0.0, 0.31, 0.9]) + 0.01 * rng.random() for _ in range(6)]) for i in range(700)]
    rows += [(700 + i, [0.5] * 6) for i in range(300)]                       # many ties
    rows += [(2000, None), (None, [1.0] * 6), (2020, [1.0, None]), (2040, [float("nan")] * 6), (2060, [float("inf")] * 6),
             (2080, []), (2100, [1.0, 2.0]), (20, [0.1] * 6), (20, [0.1] * 6), (-40, [3.0] * 6), (2120, [4e6] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    df = df.selectExpr("*", "'x' as weights", "1 as near", "2 as shard", "3 as score")
    assert pairs(topk.top_k(df)) == plain_top_k(rows, 20, 20)
    few = df.where("vec_id in (0, 1, 2, 700)")
    assert pairs(topk.top_k(few)) == plain_top_k([r for r in rows if r[0] in (0, 1, 2, 700)], 20, 20)
    assert topk.top_k(df.limit(0)).count() == 0


def test_blocks_are_skipped():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(32, 16)) * 60
    weights = np.concatenate([(c + rng.normal(size=(64, 16))).astype(np.int32) for c in centres])
    shard = topk.Shard(0, 16, np.arange(len(weights)).astype("<i8").tobytes(), weights.tobytes())
    seen = []
    real, topk.np.matmul = np.matmul, lambda a, b: seen.append(a.shape[:2]) or real(a, b)
    try:
        scores, ids = shard.search(weights[:8], np.full(8, np.iinfo(np.int64).min), np.arange(8), 20)
    finally:
        topk.np.matmul = real
    full = weights[:8].astype(np.int64) @ weights.T.astype(np.int64)
    full[np.arange(8), np.arange(8)] = np.iinfo(np.int64).min
    assert (np.sort(full, axis=1)[:, ::-1][:, :20] == scores).all()
    assert sum(a * b for a, b in seen) < 8 * shard.blocks / 2      # fewer than half of the blocks were scored


def plain_hits(docs, items, window=10):
    low = {c: c + 32 for c in range(65, 91)}

    def cut(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))

    wins = {}
    for i, t in items:
        w = cut(t)
        d = min(window, len(w))
        for s in range(len(w) - d + 1 if w else 0):
            wins.setdefault(tuple(w[s:s + d]), set()).add(i)
    out = []
    for k, t in docs:
        w, hit, found = cut(t), set(), set()
        for d in {len(x) for x in wins}:
            for s in range(len(w) - d + 1):
                if tuple(w[s:s + d]) in wins:
                    hit |= set(range(s, s + d))
                    found |= wins[tuple(w[s:s + d])] - {None}
        out.append((k, len(w), len(hit), tuple(sorted(str(x) for x in found))))
    return sorted(out, key=repr)


def test_leaks_equal_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = ["the", "of", "été", "A1", "b", "c", "dd"]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ".", ", ", "\n"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 30]))) for i in range(25)] + [(3, "zz yy xx ww"), (None, "qq rr"),
                                                                                  (40, None), (41, "!!!")]
    items[0] = (0, text(40))
    docs = [(i, rng.choice(["", text(20)]) + " " + (rng.choice(items)[1] or "") + " " + text(15)) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "pp QQ rr. zz yy xx ww"), (None, items[0][1].upper()), (5, "repeat")]
    want = plain_hits(docs, items)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "7 as leak_parts", "8 as leak")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "9 as doc_id")

    def got():
        out = decontaminate.benchmark_hits(d, b)
        return sorted(((r["doc_id"], r["leak"]["n_words"], r["leak"]["n_hit"], tuple(r["leak"]["items"]))
                       for r in out.collect()), key=repr)

    assert got() == want
    monkeypatch.setattr(decontaminate, "CHUNK_WORDS", 40)      # the benchmark in several chunks
    assert got() == want
    clean = decontaminate.decontaminate(d, b)
    assert clean.columns == d.columns
    assert clean.count() == sum(1 for w in want if not w[2])


def test_longest_match_is_located(spark):
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, "x y " + " ".join(words[5:30]) + " z " + " ".join(words[:12]))], "doc_id long, text string")
    bench = spark.createDataFrame([("q", " ".join(words))], "item_id string, text string")
    leak = decontaminate.benchmark_hits(docs, bench).first()["leak"]
    assert (leak["longest"], leak["longest_at"], leak["n_hit"]) == (25, 2, 37)
    assert [tuple(s) for s in leak["spans"]] == [(2, 27), (28, 40)]


def test_leak_edge_cases(spark):
    bench = spark.createDataFrame([(1, "quick brown fox"), (2, LONG)], "item_id long, text string")
    rows = decontaminate.benchmark_hits(edge_docs(spark), bench).collect()
    assert len(rows) == 12 and len(rows[0]) == len(edge_docs(spark).columns)
    by = {r["doc_id"]: r["leak"] for r in rows}
    assert by[5]["n_hit"] == by[5]["n_words"] and by[5]["items"] == ["2"]
    assert by[1]["n_hit"] == 3 and by[2]["n_words"] == 0 and by[3]["n_words"] == 0
    assert decontaminate.benchmark_hits(no_docs(spark), bench).count() == 0
    none = decontaminate.benchmark_hits(edge_docs(spark), bench.limit(0)).collect()
    assert {r["leak"]["n_hit"] for r in none} == {0} and max(r["leak"]["n_words"] for r in none) > 60_000
