import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillgraph.llm import bpe, common, langid, packing

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
bits = st.sampled_from(["a", "the", "ing", " ", "  ", "\n", "\t", "\r\n", ".", "'s", "'LL", "12", "½", "é", "漢字", "😀", "\xa0", "\x1c", "\x85", "́", "ǅ", "٣", "<|endoftext|>", "<|", "aaaaaaa", "!!!!", "Σ", "İ", "​", "ᄀ", "ᅡ"])
texts = st.lists(bits, max_size=14).map("".join)
KIND = "doc_id long, text string, lang string, fingerprint string, ids binary"


def rows(spark, values, extra=()):
    """Documents with null and repeated ids and columns whose names clash with what operators add."""
    data = [(i, t, "xx", "clash", b"x") for i, t in values]
    return spark.createDataFrame(data, KIND)


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(BYTE)


@settings(max_examples=400, deadline=None)
@given(texts)
def test_bpe_equals_the_library(text):
    got = bpe.load(BYTE).encode(text)
    want = Tokenizer_byte().encode(text, add_special_tokens=False).ids
    assert np.frombuffer(got, np.uint32).tolist() == want
    assert bpe.load(BYTE).decode(got) == Tokenizer_byte().decode(want, skip_special_tokens=False)


_cache = {}


def Tokenizer_byte():
    return _cache.setdefault("b", Tokenizer.from_file(BYTE))


@settings(max_examples=400, deadline=None)
@given(texts)
def test_word_ids_equal_the_library(text):
    words = packing.load(WORD)
    assert np.frombuffer(words.encode(text), np.uint32).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_bpe_table(spark):
    out = bpe.encode_documents(rows(spark, [(1, "hello world"), (1, "hello world"), (None, None), (2, "")]), BYTE).collect()
    assert len(out) == 4
    assert all((r["decoded"] == "" and bytes(r["ids"]) == b"") for r in out if r["doc_id"] != 1)
    assert bpe.encode_documents(rows(spark, []), BYTE).count() == 0


def test_bpe_long_text():
    text = "word " * 50_000 + "x" * 3000
    assert np.frombuffer(bpe.load(BYTE).encode(text), np.uint32).tolist() == Tokenizer_byte().encode(text, add_special_tokens=False).ids


def test_first_fit_decreasing_matches_a_plain_scan():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = rng.integers(1, 101, rng.integers(1, 60)).tolist()
        where, offset = packing.first_fit_decreasing(lengths, 100)
        room, want = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            b = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
            if b == len(room):
                room.append(100)
            want[i] = b, 100 - room[b]
            room[b] -= lengths[i]
        assert {i: (where[i], offset[i]) for i in range(len(lengths))} == want


def test_packing_table(spark):
    long = "word " * 10_000
    docs = rows(spark, [(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, long)])
    out = packing.pack_documents(docs, WORD, keep_ids=True).collect()
    by_doc = {}
    for r in out:
        by_doc.setdefault(r["doc_id"], []).append(r)
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    assert [r["doc_tokens"] for r in by_doc[1]] == [3, 3] and by_doc[None][0]["doc_tokens"] == 1 and by_doc[2][0]["length"] == 1
    assert sorted((r["start"], r["length"]) for r in by_doc[3]) == [(0, 4096), (4096, 4096), (8192, 1809)]
    filled = {}
    for r in out:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["sequence_length"]))
    for parts in filled.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and parts[0][2] == (at if at & (at - 1) == 0 else 4096)
    assert packing.pack_documents(rows(spark, []), WORD).count() == 0


def test_equal_rows_spread_over_the_groups(spark):
    """100,000 equal rows and a document of a million ids: no group holds more than its share of pieces."""
    docs = spark.range(100_000).selectExpr("cast(7 as bigint) as doc_id", "'a b' as text").unionByName(spark.range(1).selectExpr("cast(8 as bigint) as doc_id", "repeat('word ', 1000000) as text"))
    out = packing.pack_documents(docs, WORD).groupBy(F.shiftright("sequence_id", 32).alias("g")).agg(F.count("*").alias("n"), F.sum("length").alias("ids")).collect()
    assert sum(r["n"] for r in out) == 100_000 + 245 and sum(r["ids"] for r in out) == 300_000 + 1_000_001
    assert len(out) > 20 and max(r["n"] for r in out) < 1.5 * packing.GROUP_ROWS


def test_packing_query_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    tokenizer, want = Tokenizer.from_file(WORD), set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], np.uint32)
        want |= {(r["doc_id"], at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes()), len(ids)) for at in range(0, len(ids), 4096)}
    got = packing.op7_packing(spark, sf).collect()
    assert len(got) == len(want) and {(r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got} == want


def test_bpe_query_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in bpe.op4_bpe(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = Tokenizer_byte().encode(r["text"] or "", add_special_tokens=False).ids
        text = Tokenizer_byte().decode(ids, skip_special_tokens=False)
        g = got[r["doc_id"]]
        assert (g["n_tokens"], g["ids_sha256"], g["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_operators_in_one_projection_keep_their_tables():
    made = []
    for _ in range(3):
        common.held("one", lambda: made.append(1) or {}, 90)
        common.held("two", lambda: made.append(2) or {}, 90)
    assert made == [1, 2]
    common.held("three", lambda: made.append(3) or {}, 90)
    common.held("two", lambda: made.append(2) or {}, 90)
    assert made == [1, 2, 3] and "one" not in common._held
    common._held.clear()


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out("doc_id")))
    out = langid.identify(docs, model).where(langid.held_out("doc_id"))
    good, n = out.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 20 and good / n > 0.97


def test_language_matches_a_plain_sum(spark):
    docs = spark.createDataFrame([(1, "der die das", "de"), (2, "the and of", "en"), (3, None, "en"), (4, "x", None)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.langs == ["de", "en"]
    for text in ("die that", "a", "Ünd  12 die"):
        c = langid.codes(text)
        bins, _ = langid.grams(c)
        assert np.allclose(langid.score_batch(model, [text, "other", text])[[0, 2]], model.logp[bins].sum(0), atol=1e-3)


def test_language_edge_cases(spark):
    docs = rows(spark, [(1, None), (1, ""), (None, "123 !?"), (2, "abc")]).withColumn("score", F.lit(9.0))
    out = {(r["doc_id"], r["text"]): r for r in langid.identify(docs, langid.fit(docs)).collect()}
    assert [out[k]["lang_pred"] for k in ((1, None), (1, ""), (None, "123 !?"))] == ["und"] * 3
    assert out[2, "abc"]["lang_pred"] == "xx" and 0 <= out[2, "abc"]["score"] <= 1
    none = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(docs.limit(0), none).count() == 0


def test_steps_count_each_n_gram_once(monkeypatch):
    """Texts around the borders of steps have the counts of the whole text, against a plain loop."""
    whole = {}
    for n in (*range(94, 107), 200, 305):
        text = ("der Straße 12 und\u03a3 the! " * 20)[:n]
        c = langid.codes(text)
        whole[text] = np.bincount(langid.grams(c)[0], minlength=langid.BINS)
    monkeypatch.setattr(langid, "STEP", 50)
    for text, want in whole.items():
        got = sum(np.bincount(b, minlength=langid.BINS) for b in langid.bins_in_steps(langid.codes(text)))
        assert (got == want).all()
        m = langid.Model(["a", "b"], np.random.default_rng(1).normal(size=(langid.BINS, 2)).astype(np.float32))
        assert np.allclose(langid.score_batch(m, ["x", text, "yy"])[1], want @ m.logp.astype(np.float64), rtol=1e-6)


def test_languages_in_turns_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{a}{b} {b}{a} {a}{a}", a + b) for i, (a, b) in enumerate((a, b) for a in "abcde" for b in "xyz")] + [(99, None, None)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    want = sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in langid.identify(docs, model).collect())
    monkeypatch.setattr(langid, "TOGETHER", 4)
    again = langid.fit(docs)
    assert again.langs == model.langs and np.allclose(again.logp, model.logp)
    assert sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in langid.identify(docs, model).collect()) == want


def test_language_of_a_long_text_goes_in_steps(spark):
    docs = spark.createDataFrame([(1, "der die das", "de"), (2, "the and of", "en")], "doc_id long, text string, lang string")
    long = spark.createDataFrame([(1, "the and of " * 60_000)], "doc_id long, text string")
    assert langid.identify(long, langid.fit(docs)).first()["lang_pred"] == "en"
