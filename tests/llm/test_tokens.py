import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hirelens.llm import counts, pieces, tokenfile, units
from hirelens.llm.units import Encoder
from tests.llm.cases import LONG, ROWS, edge_docs, no_docs

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "Bc", " ", "  ", "\n", " \n", "\t", " ", "don't", "'s", "12", "²", "...", "é", "日本",
       "<|endoftext|>", "\x1c", "\x85", "​", "x́", "_", "word word", "\U0001f600"]


@pytest.fixture(scope="module")
def encode():
    return Encoder(BPE)


def library(encode, text):
    return encode.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(ODD) | st.characters(max_codepoint=0x300, exclude_categories=["Cs"]), max_size=14))
def test_units_encode_as_the_library(parts):
    encode, text = units.encoder(BPE), "".join(parts)
    assert np.frombuffer(encode.ids(text), encode.kind).tolist() == library(encode, text)


def test_other_tokenizers_are_left_to_the_library():
    encode = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not encode.by_unit
    assert np.frombuffer(encode.ids("The  quick <fox>"), encode.kind).tolist() == library(encode, "The  quick <fox>")


def test_cache_is_bounded_and_keeps_what_is_used():
    made = []
    cache = units.Cache(lambda u: made.append(u) or len(u), limit=8)
    for i in range(100):
        assert cache["often"] == 5 and cache[f"n{i}"] == len(f"n{i}")
        assert len(cache) + len(cache.old) <= 9
    assert made.count("often") == 1
    assert cache["x" * 1000] == 1000 and "x" * 1000 not in cache


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=30), st.lists(st.tuples(
    st.integers(0, 60), st.integers(0, 25), st.lists(st.sampled_from(ODD), max_size=3)), max_size=5))
def test_edits_keep_the_counts(parts, edits):
    encode, text = units.encoder(BPE), "".join(parts)
    old, counts.SLOT = counts.SLOT, 2
    try:
        tree = counts.TokenTree.build(text, encode)
        assert tree.total == len(library(encode, text))
        for start, n, new in edits:
            start = min(start, len(text))
            text = tree.edit(text, start, min(len(text), start + n), "".join(new), encode)
            assert (tree.total, int(tree.chars[1])) == (len(library(encode, text)), len(text))
            kept = counts.TokenTree(*tree.leaves())             # as stored and read again
            assert (kept.chars == tree.chars).all() and (kept.tokens == tree.tokens).all()
    finally:
        counts.SLOT = old


def test_an_edit_encodes_a_small_part(encode):
    tree = counts.TokenTree.build(LONG, encode)
    tree.edit(LONG, len(LONG) // 2, len(LONG) // 2 + 3, "new words", encode)
    assert 0 < tree.encoded < tree.total / 500


def test_counts_of_documents_and_a_second_round(spark, encode):
    rows = counts.count_tokens(edge_docs(spark)).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        text, c = r["text"] or "", r["count"]
        edits = counts.personal_edits(text)
        after = text
        for s, e, new in sorted(edits, reverse=True):
            after = after[:s] + new + after[e:]
        assert (c["n_tokens"], c["n_edits"], c["n_after"]) == (len(library(encode, text)), len(edits), len(library(encode, after)))
    kept = (counts.count_tokens(edge_docs(spark, clash=False), edits=lambda t: [])
            .selectExpr("doc_id", "text", "count.chars", "count.tokens",
                        "if(length(text) > 5, array(struct(2L as start, 4L as end, ' zz  ' as new)), null) as edits"))
    for r in counts.update_counts(kept).collect():
        text = r["text"] or ""
        want = text[:2] + " zz  " + text[4:] if len(text) > 5 else text
        assert r["count"]["n_after"] == len(library(encode, want))
    assert counts.count_tokens(no_docs(spark)).count() == 0


def test_token_files(spark, scratch, encode):
    files = tokenfile.write_tokens(edge_docs(spark).repartition(3), f"{scratch}/tokens", length=64)
    got = sorted(((r["start"], r["n_tokens"], r["ids_crc32"], r["doc_id"]) for r in tokenfile.read_documents(files).collect()))
    start, stream = 0, []
    assert [g[3] for g in got] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    texts = {}
    for row in ROWS:
        texts.setdefault(row[0], []).append(row[1])
    for at, n, crc, doc_id in got:
        ids = {tuple(library(encode, t or "") + [2]) for t in texts[doc_id]}
        assert at == start and (n, crc) in {(len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for i in ids}
        start += n
    # the files themselves: equal lengths, masks, no copy
    for r in files.orderBy("part").collect():
        file = tokenfile.SequenceFile(r["ids"])
        assert file.reader.schema.field("input_ids").type == pa.list_(pa.uint16(), 64)
        total = 0
        for b in range(file.reader.num_record_batches):
            for i in range(file.reader.get_batch(b).num_rows):
                ids, mask = file.sequence(b * tokenfile.SEQUENCES + i)
                assert len(ids) == len(mask) == 64 and not ids.flags.owndata
                total += int(mask.sum())
                stream += ids[mask].tolist()
        assert total == r["n_tokens"]
    assert len(stream) == start and stream.count(2) >= len(ROWS)
    none = tokenfile.write_tokens(no_docs(spark), f"{scratch}/none")
    assert tokenfile.read_documents(none).count() == 0


def every_segmentation(model, text):
    out = []

    def walk(at, score, ids):
        if at == len(text):
            out.append((round(score, 2), tuple(ids)))
            return
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in model.known:
                i, s = model.known[text[at:end]]
                walk(end, score + s, [*ids, i])
        if text[at] not in model.known:
            walk(at + 1, score + model.lost, [*ids, *model.spell(text[at])])

    walk(0, 0.0, [])
    return sorted(out, reverse=True)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="thenra ,.é\n日ß1▁\U0001f600", min_size=1, max_size=9), st.integers(2, 6))
def test_n_best_are_the_best_of_all(text, n):
    model = pieces.pieces(MODEL)
    want = every_segmentation(model, pieces.SPACE + text.replace(" ", pieces.SPACE))
    ids, scores, _ = model.encode(text, n)
    ids = tuple(np.frombuffer(ids, np.int32).tolist())
    assert [round(s, 2) for s in scores] == [s for s, _ in want[:n]]
    assert (round(scores[0], 2), ids) in want
    assert model.decode(ids) == text.replace(pieces.SPACE, " ")


def test_a_star_gives_distinct_segmentations_in_order():
    model = pieces.pieces(MODEL)
    found = model.n_best("▁international", 40)
    want = every_segmentation(model, "▁international")
    assert [round(s, 2) for s, _ in found] == [s for s, _ in want[:40]]
    assert len({tuple(i) for _, i in found}) == 40


def test_words_share_the_search_of_their_parts():
    model, rng, searched = pieces.Pieces(MODEL), random.Random(7), []
    search = model.table.search
    model.table.search = lambda parts, *size: searched.extend(parts) or search(parts, *size)
    words = sorted({"".join(rng.choices("thenraio", k=8)) for _ in range(400)})
    words = [w + mark for mark in ("", ",", ".", ".\nThe") for w in words]
    ids, scores, _ = model.encode(" ".join(words), 2)
    assert len(searched) == len(set(searched)) <= len(words) / 4 + 10
    assert scores[0] == sum(model.n_best(pieces.SPACE + w, 1)[0][0] for w in words)
    assert model.decode(np.frombuffer(ids, np.int32)) == " ".join(words)


def test_words_are_forgotten_and_searched_again(monkeypatch):
    for name, value in {"WORDS": 20, "WORD_CHARS": 200, "SEARCHED": 30, "TOGETHER": 8}.items():
        monkeypatch.setattr(pieces, name, value, raising=False)
    model, rng = pieces.Pieces(MODEL), random.Random(3)
    some = ["the", "cat,", "on", "no.\nYes", "naïve", "日本", "\U0001f600", "x" * 45, "=" * 41, "", "▁"]
    texts = [" ".join(rng.choice([rng.choice(some), "".join(rng.choices("thenra.,", k=rng.randrange(1, 9)))])
                      for _ in range(rng.randrange(7))) for _ in range(200)]
    for at in range(0, len(texts), 5):
        for text, (ids, scores, changes, back) in zip(texts[at:at + 5], model.encode_batch(texts[at:at + 5], 3)):
            want = model.n_best(pieces.SPACE + text.replace(" ", pieces.SPACE), 3) if text else []
            assert scores == [s for s, _ in want] and back
            for own in (pieces.put_in(ids, c) for c in changes):
                assert model.decode(np.frombuffer(own, np.int32)) == text.replace(pieces.SPACE, " ")
        assert len(model.words.numbers) <= 20 + 5 * 8


def test_decoding_agrees_with_the_library():
    from sentencepiece import SentencePieceProcessor
    theirs, model = SentencePieceProcessor(model_file=MODEL), pieces.pieces(MODEL)
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(["the ", "naïve", " x", "\n", "日本 ", "12,5"]) for _ in range(8))
        assert model.decode(theirs.encode(text)) == theirs.decode(theirs.encode(text)) == text


def test_pieces_of_documents(spark):
    rows = pieces.encode(edge_docs(spark)).collect()
    assert len(rows) == len(ROWS) and all(r["pieces"]["round_trip"] for r in rows)
    for r in rows:
        n = len(r["pieces"]["ids"])
        assert (n == 0) == (not r["text"]) and len(r["pieces"]["scores"]) <= pieces.N_BEST
        assert r["pieces"]["ids_crc32"] == zlib.crc32(np.array(r["pieces"]["ids"], "<i4").tobytes())
    again = pieces.decode(pieces.encode(edge_docs(spark)).selectExpr("doc_id", "text as was", "pieces.ids")).collect()
    assert all(r["text"] == (r["was"] or "") for r in again)
    assert pieces.encode(no_docs(spark)).count() == 0


def test_all_n_segmentations_of_documents(spark):
    model = pieces.pieces(MODEL)
    texts = ["a", "ab ab", "the cat", "xx yy", "naïve  é", "\U0001f600 日本", "aaaa", "on no", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pieces.segmentations(pieces.encode(df)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text, found, got = r["text"] or "", r["pieces"], [tuple(i) for i in r["segmentations"]]
        want = every_segmentation(model, pieces.SPACE + text.replace(" ", pieces.SPACE)) if text else []
        n = min(pieces.N_BEST, len(want))
        assert len(got) == len(set(got)) == len(found["scores"]) == len(found["ranks"]) == n
        assert all((round(s, 2), i) in want for s, i in zip(found["scores"], got))
        assert not got or got[0] == tuple(found["ids"])
        assert [(x["n_pieces"], x["ids_crc32"]) for x in found["ranks"]] == [
            (len(i), zlib.crc32(np.array(i, "<i4").tobytes())) for i in got]
