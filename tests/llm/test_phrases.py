"""Phrase collocations against a plain count of all phrases."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import phrases
from tests.conftest import SF_SMALL
from tests.llm.cases import edge_docs, no_docs, pairs


def plain(rows, least, top=phrases.TOP):
    """rows of (lang, text) -> rows of the result."""
    f, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    f[lang, tuple(words[i:i + n])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = {(lang, w[i:i + n]) for (lang, w), b in candidates.items() for n in range(2, len(w))
              for i in range(len(w) - n + 1) if 100 * b >= 80 * f[lang, w[i:i + n]]}
    found = collections.defaultdict(list)
    for (lang, w), a in candidates.items():
        if (lang, w) not in inside:
            cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, rank, w.decode(), -a, left, right, total[lang], -score)
                  for lang, rows in found.items()
                  for rank, (score, a, w, left, right) in enumerate(sorted(rows)[:top], 1))


def test_query_equals_the_plain_count(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("lang", "text").collect()]
    got = phrases.op12_phrase_collocations(spark, SF_SMALL)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    want = plain(rows, 30)
    assert want and pairs(got) == sorted(want, key=repr)


@pytest.mark.parametrize("sample", [3, 10_000])
def test_failures_of_the_border_are_counted(spark, monkeypatch, sample):
    """Few or no documents propose phrases: the passes still find them all."""
    monkeypatch.setattr(phrases, "SAMPLE", sample)
    rng = random.Random(3)
    words = ["Ab", "b", "cé", "dd", "e"]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice(" \t\n,. ") for _ in range(30)))
            for _ in range(150)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    blocks, buckets = phrases._written_blocks(df.selectExpr("'x' AS lang", "cast(text AS binary) AS text"))
    one, two = (phrases._closed(blocks, buckets, phrases.Bitmap(), 6, ahead) for ahead in (False, True))
    assert len(one) == 4 and len(two) == 2                    # from nothing: a pass a length, or one that looks ahead
    assert {r for t in one for r in pairs(t.select("key", "n"))} == {r for t in two for r in pairs(t.select("key", "n"))}
    assert pairs(phrases.collocations(df, least=6)) == sorted(plain(rows, 6), key=repr)
    assert pairs(phrases.collocations(df, least=6, top=3)) == sorted(plain(rows, 6, 3), key=repr)


def test_blocks_and_long_texts(spark, monkeypatch):
    """Texts cut into parts, and blocks in the middle of a batch, lose nothing."""
    monkeypatch.setattr(phrases, "SAMPLE", 2)
    text = " ".join(f"w{i % 7} x{i % 3}" for i in range(2000)) + ". " + "long" * 300
    rows = [("en", text + str(i % 2)) for i in range(6)]
    want = sorted(plain(rows, 30), key=repr)
    df = spark.createDataFrame(rows, "lang string, text string")
    for tokens, piece in ((500, 1 << 20), (1 << 20, 64)):
        words = phrases.Words()
        monkeypatch.setattr(phrases, "PIECE", piece)
        got = [i for part in words.numbers(text.encode()) for i in part.tolist()]
        monkeypatch.setattr(phrases, "PIECE", 1 << 20)
        assert got == [i for part in words.numbers(text.encode()) for i in part.tolist()]
        monkeypatch.setattr(phrases, "TOKENS", tokens)
        assert pairs(phrases.collocations(df)) == want


def test_packed_counts_come_back():
    rng = np.random.default_rng(1)
    for size, top in ((0, 10), (1, 10), (5000, 1 << 20), (5000, 1 << 48)):
        key = np.unique(rng.integers(0, top, size, np.uint64)) + np.uint64(7)
        n = rng.integers(1, 400, len(key))
        again = phrases._unpack(*phrases._pack(key, n, 7), 7)
        assert (again[0] == key).all() and (again[1] == n).all()
    key = np.unique(rng.integers(0, 1 << 48, 999, np.uint64))
    dealt = list(phrases._dealt(key, 7))
    assert np.concatenate([key[at] for _, at in dealt]).tolist() == key.tolist()
    assert all(phrases._edge(b, 7) <= k < phrases._edge(b + 1, 7) for b, at in dealt for k in key[at].tolist())


def test_scores_past_64_bits(spark):
    big = 9_000_000_000_000
    score = F.expr(f"CAST({phrases.SCALE} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) "
                   "DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    row = spark.createDataFrame([(big, big, big + 1)], "a long, l long, r long").select(score.alias("s")).first()
    assert row["s"] == 2_000_000 * big // (2 * big + 1)


def test_edges(spark):
    df = edge_docs(spark)
    rows = [(r["lang"], r["text"]) for r in df.collect()]
    assert pairs(phrases.collocations(df, least=2)) == sorted(plain(rows, 2), key=repr)
    assert phrases.collocations(no_docs(spark)).collect() == []
