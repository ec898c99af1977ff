import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quillgraph.llm import common, simhash
from quillgraph.llm.common import discard, materialise
from tests.conftest import small_broadcasts

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "substring_dedup", "packing"]
    sizes = [docs.count()]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialise(stage(spark, before, SF))
        assert after.columns == docs.columns
        sizes.append(after.count())
        if name != "substring_dedup":  # what stays is unchanged
            assert after.exceptAll(before).count() == 0
        before = after
    assert sizes[1] == sizes[0] and sizes[2] < sizes[1] and sizes[3] == sizes[2]
    assert before.where("n_chars <> char_length(text)").count() == 0
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = before.collect()
    assert all(r["text"] == texts[r["doc_id"]] or len(r["text"].split()) < len(texts[r["doc_id"]].split()) for r in kept)
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in kept}
    discard(before)


def test_stages_take_odd_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "the words are here", "en", "s", 18), (3, "the words are here", "en", "s", 18), (None, "the words are here", "en", "s", 18)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SF))
    assert sorted((r["doc_id"] for r in docs.collect()), key=str) == sorted([3, 3, None], key=str)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_near_dedup_sends_no_keys_to_the_driver(spark):
    """Near copies share many more keys than there are documents; a broadcast of the keys passes the size allowed here."""
    rng, rows = np.random.default_rng(3), []
    for i in range(0, 8000, 2):
        w = [f"w{x}" for x in rng.integers(0, 100_000, 200)]
        rows += [(i, " ".join(w), "en", "s", 9), (i + 1, " ".join([*w[:-1], "other"]), "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    prints = [simhash.fingerprint(r[1]) & (2**64 - 1) for r in rows]
    want = {i for i in range(len(rows)) if i % 2 == 0 or (prints[i] ^ prints[i - 1]).bit_count() > 3}
    assert len(want) < 0.9 * len(rows)
    with small_broadcasts(spark):
        kept = materialise(corpus_pipeline.near_dedup(spark, docs, SF))
    assert kept.count() == len(want) and {r["doc_id"] for r in kept.collect()} == want
    discard(kept)


def test_near_dedup_broadcasts_no_table(spark):
    """Spark's default threshold would broadcast links, groups and kept ids, all of which grow with the documents."""
    rows = [(i, " ".join([*(f"w{i // 2}x{j}" for j in range(199)), f"y{i % 2}"]), "en", "s", 9) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    prints = [simhash.fingerprint(r[1]) & (2**64 - 1) for r in rows]
    want = {i for i in range(len(rows)) if i % 2 == 0 or (prints[i] ^ prints[i - 1]).bit_count() > 3}
    assert len(want) < 0.9 * len(rows)
    with small_broadcasts(spark, below="10m", most="1k"):
        kept = materialise(corpus_pipeline.near_dedup(spark, docs, SF))
    assert kept.count() == len(want) and {r["doc_id"] for r in kept.collect()} == want
    discard(kept)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_run_leaves_no_scratch_tables(spark):
    before = common.made_so_far()
    out = corpus_pipeline.run(spark, SF)
    assert len(common.made_so_far() - before) == 1 and out.count() > 0


@pytest.mark.parametrize("clash", [["score", "lang_pred", "n_words", "a.b", "_quill_told"], ["n_removed", "starts", "ends", "kept_text", "component_id", "fingerprint", "key", "label"]])
def test_extra_columns_stay_whatever_their_names(spark, clash):
    long = "a long text of words that differ " + " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, "the words are here and so on"), (1, "the words are here and so on"), (2, long), (3, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 9, *[float(k) for k in range(len(clash))]) for i, t in rows], f"doc_id long, text string, lang string, source string, n_chars long, {', '.join(f'`{c}` double' for c in clash)}")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SF))
    assert docs.columns[5:] == clash and docs.count() == 3
    assert all(r[5:] == tuple(float(k) for k in range(len(clash))) for r in docs.collect())
    assert corpus_pipeline.packing(spark, docs, SF).count() == 2 + -(-corpus_pipeline.packing(spark, docs, SF).agg(F.max("doc_tokens")).first()[0] // 4096)


def test_run_against_a_plain_chain(spark):
    """What each document holds in the end, by brute force; the language model's and SimHash's choices are given."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, corpus_pipeline.language_id(spark, docs, SF), SF).collect()}
    words = {r["doc_id"]: (r["text"], re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in docs.collect() if r["doc_id"] in kept}
    first = {}
    for i in sorted(words):
        w = words[i][1]
        for a in range(len(w) - 12):
            first.setdefault(tuple(w[a : a + 13]), i)
    tokenizer, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), set()
    for i, (text, w) in words.items():
        gone = np.zeros(len(w), bool)
        for a in range(len(w) - 12):
            if first[tuple(w[a : a + 13])] < i:
                gone[a : a + 13] = True
        text = " ".join(x for x, g in zip(w, gone) if not g) if gone.any() else text
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        for at in range(0, len(ids), 4096):
            want.add((i, at, zlib.crc32(np.array(ids[at : at + 4096], np.uint32).tobytes()), len(ids)))
    got = [(r["doc_id"], r["start"], r["ids_crc32"], r["doc_tokens"]) for r in corpus_pipeline.run(spark, SF).collect()]
    assert len(got) == len(want) and set(got) == want
