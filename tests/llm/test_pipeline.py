import collections


import pytest

import corpus_pipeline
from hirelens.llm import pieces
from tests.llm.cases import edge_docs, no_docs
from tests.llm.test_near_duplicates import plain_components, plain_fingerprint
from tests.llm.test_scans import plain_spans
from tests.llm.test_search_and_leaks import plain_hits

SF = "/root/testdata/sf0.01"


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dup", "benchmark", "secrets", "pieces"]


def test_pipeline_against_plain_python(spark):
    """Every stage recomputed in plain Python over the whole table."""
    rows = {r["doc_id"]: r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {i: r for i, r in rows.items() if r["text"] and any(c.isalpha() for c in r["text"])}
    prints = {i: plain_fingerprint(r["text"]) for i, r in kept.items()}
    groups = plain_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    best = {}
    for i in sorted(kept):
        best.setdefault(groups[prints[i]], i)
    kept = {i: kept[i] for i in best.values()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = {i: n for i, _, n, _ in plain_hits([(i, r["text"]) for i, r in kept.items()], items)}
    kept = {i: r for i, r in kept.items() if not hits[i]}
    model = pieces.pieces(pieces.tokenizer_path(pieces.MODEL))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(kept)
    for i, r in kept.items():
        text, at, out = r["text"], 0, []
        for s, e in sorted(tuple(map(int, x.split(":")[1:])) for x in plain_spans(text)):
            if s >= at:
                out.append(text[at:s] + "[secret]")
            at = max(at, e)
        assert got[i]["round_trip"] and model.decode(got[i]["ids"]) == "".join(out) + text[at:]
        assert got[i]["lang"] == r["lang"] and got[i]["n_pieces"] == len(got[i]["ids"])


@pytest.mark.parametrize("docs", ["edge", "none"])
def test_stages_take_odd_tables(spark, docs, tmp_path):
    df = edge_docs(spark) if docs == "edge" else no_docs(spark)
    spark.createDataFrame([(1, "quick brown fox"), (None, None)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = df.columns
        df = stage(spark, df, str(tmp_path))
        rows = df.collect()
        df = spark.createDataFrame(rows, df.schema)
        seen[name] = collections.Counter(r["doc_id"] for r in rows)
        if name != "pieces":
            assert df.columns == columns
    if docs == "none":
        assert not any(seen.values())
        return
    assert not {2, 3, 4, 6} & set(seen["language"]) and seen["language"][1] == 2 and seen["language"][None] == 1
    assert seen["near_dup"][1] == 1 and None not in seen["near_dup"]     # copies of document 1
    assert 1 not in seen["benchmark"]
    assert seen["pieces"] == seen["secrets"] == seen["benchmark"]


def test_near_dup_stage_keeps_one_row_of_nameless_groups(spark):
    rows = [(None, "a b c d", "en", "s", 7)] * 3 + [(None, "q w e r t y", "en", "s", 11), (4, "z x c v b", "en", "s", 9),
                                                  (4, "entirely other words in this one", "en", "s", 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.near_dup_stage(spark, df, "").collect())
    assert got == [(0, "a b c d"), (0, "q w e r t y"), (4, "entirely other words in this one"), (4, "z x c v b")]


def test_near_dup_stage_keeps_one_row_of_each_component(spark):
    """One doc_id with texts in two components: each keeps its own row."""
    t1, t2 = "zebra yak xerus wombat vole", "apple banana cherry damson elder"
    rows = [(5, t1), (7, t1), (3, t2), (5, t2), (8, "first of two texts"), (8, "another one of them entirely")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.near_dup_stage(spark, df, "").collect())
    assert got == [(3, t2), (5, t1), (8, "another one of them entirely"), (8, "first of two texts")]


def test_language_stage_without_anything_to_learn(spark):
    rows = [(1, "some words", None, "s", 10), (2, "1 2 3", None, "s", 5), (3, None, None, "s", 0), (None, "été", None, "s", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.language_stage(spark, df, "")
    assert got.columns == df.columns and sorted(r["text"] for r in got.collect()) == ["some words", "été"]
