"""Quality rules against a plain version: measures, votes, EM, decisions."""

import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from hirelens.llm import quality
from tests.conftest import SF_SMALL
from tests.llm.cases import edge_docs, no_docs, pairs

SPACE = " \t\n\x0b\x0c\r"


def plain_measures(text, window=quality.WINDOW):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = collections.defaultdict(list)
    for i in range(len(words) - window + 1):
        at[tuple(words[i:i + window])].append(i)
    covered = {p for places in at.values() if len(places) > 1 for i in places for p in range(i, i + window)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "n_distinct": len(set(words)), "n_single": sum(len(w) == 1 for w in words),
            "n_upper": len(re.findall("[A-Z]", text)), "n_letters": len(re.findall(r"[^\x20\x09-\x0D!-/:-@\[-`{-~0-9]", text)),
            "n_marks": len(re.findall(r"[!-/:-@\[-`{-~]", text)), "n_cries": len(re.findall("[!?]", text)),
            "n_stops": len(re.findall("[.!?]", text)), "n_digits": len(re.findall("[0-9]", text))}


def plain_fit(patterns):
    """(votes tuple -> rows) -> share, accuracies on good and on bad texts."""
    k = len(next(iter(patterns), ()))
    share, good, bad = quality.SHARE, [quality.GOOD] * k, [quality.BAD] * k
    p = quality.PSEUDO
    for _ in range(quality.ROUNDS):
        weight = {v: n * plain_posterior((share, good, bad), v) for v, n in patterns.items()}

        def rates(weight, start, right):
            return [(sum(w for v, w in weight.items() if v[j] == right) + start * p)
                    / (sum(w for v, w in weight.items() if v[j]) + p) for j in range(k)]
        new = ((sum(weight.values()) + quality.SHARE * p) / (sum(patterns.values()) + p), rates(weight, quality.GOOD, 1),
               rates({v: n - weight[v] for v, n in patterns.items()}, quality.BAD, -1))
        moved = max(abs(a - b) for a, b in zip([new[0], *new[1], *new[2]], [share, *good, *bad]))
        share, good, bad = new
        if moved < quality.CLOSE:
            break
    return share, good, bad


def plain_posterior(model, votes):
    share, good, bad = model
    odds = math.log(share / (1 - share))
    for v, g, b in zip(votes, good, bad):
        odds += math.log(g / (1 - b)) if v > 0 else math.log((1 - g) / b) if v < 0 else 0
    return 1 / (1 + math.exp(-odds))


def test_query_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = quality.assess(docs.withColumn("text2", F.col("text"))).collect()
    for r in rows:
        assert r["m"].asDict() == plain_measures(r["text2"])
        n, repeated = r["m"]["n_words"], r["m"]["n_repeat_words"]
        assert r["base_failed"] == (n < 20 or 100 * repeated > 30 * n)
    model = plain_fit(collections.Counter(tuple(r["votes"]) for r in rows))
    for r in rows:
        assert r["posterior"] == pytest.approx(plain_posterior(model, tuple(r["votes"])), abs=1e-9)
        assert r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)
    got = quality.op13_quality_rules(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "posterior", "kept"]
    assert pairs(got.select("doc_id", "kept")) == sorted(((r["doc_id"], r["kept"]) for r in rows), key=repr)


def test_repeated_windows_overlap_and_touch(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("ab" if i % 2 else "abcd") for _ in range(rng.randrange(60))) for i in range(80)]
    texts += ["x " * 500, " ".join(map(str, range(40))) * 2, "\x0b".join("ab") * 30]
    got = quality.measures(spark.createDataFrame([(t, t) for t in texts], "text string, copy string")).collect()
    assert all(r["m"]["n_repeat_words"] == plain_measures(r["copy"])["n_repeat_words"] for r in got)


def test_the_model_learns_which_rules_to_trust(spark):
    """Rules a and b see the latent quality, c votes at random."""
    rng = random.Random(1)
    rows = []
    for _ in range(4000):
        good = rng.random() < 0.7
        rows.append(tuple((1 if (rng.random() < right) == good else -1) if rng.random() < 0.9 else 0
                          for right in (0.9, 0.85, 0.8)) + (rng.choice((-1, 1)),))
    model = quality.fit(spark.createDataFrame(rows, "a int, b int, c int, d int"), list("abcd"))
    assert model.share == pytest.approx(0.7, abs=0.05)
    assert model.good["a"] > 0.85 and model.bad["a"] > 0.85
    assert abs(model.good["d"] + model.bad["d"] - 1) < 0.1          # says nothing
    share, good, bad = plain_fit(collections.Counter(rows))
    assert model.share == pytest.approx(share) and list(model.good.values()) == pytest.approx(good)


def test_junk_goes_and_clean_text_stays(spark):
    """Held against labels that the operator never sees."""
    found = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = quality.assess(found).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    told = {(r["quality"], r["kept"]): r["n"] for r in found.where("not base_failed").groupBy("quality", "kept")
            .agg(F.count("*").alias("n")).collect()}
    assert told.get((1, False), 0) == 0 and told.get((0, True), 0) <= 0.05 * sum(told.values())


def test_edges(spark):
    df = quality.assess(edge_docs(spark).withColumn("votes", F.lit("x")).withColumn("kept", F.lit("y")))
    rows = df.collect()
    assert len(rows) == 12 and "spans" in df.columns and "text" not in df.columns
    told = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert not told[2]["kept"] and told[2]["m"]["n_words"] == 0 and told[4]["m"]["n_words"] == 0
    assert told[5]["m"]["n_words"] > 60_000 and not told[8]["kept"]
    assert quality.assess(no_docs(spark)).collect() == []
