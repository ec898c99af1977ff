import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import kdtree, lbl, licenses
from quillgraph.llm.langid import held_out

KIND = "doc_id long, text string, source string, lang string, size int, node int, key string, shard int"


def table(spark, values):
    return spark.createDataFrame([(i, t, f"s{(i or 0) % 5}", "l", 1, 1, "c", 1) for i, t in values], KIND)


def check_shards(out, n, shards=16):
    assert len(out) == n
    slots = collections.defaultdict(list)
    size = collections.Counter()
    for r in out:
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) and 0 <= k < shards for k, s in slots.items())
    return size


def test_shards_are_even_and_keep_equal_texts(spark):
    rng = random.Random(1)
    docs = [(i, "x" * rng.randint(0, 300) + str(i if i % 5 else i // 50)) for i in range(3000)]
    out = kdtree.kd_shards(table(spark, docs)).collect()
    size = check_shards(out, len(docs))
    mean = sum(size.values()) / 16
    assert len(size) == 16 and max(size.values()) < 1.05 * mean and min(size.values()) > 0.95 * mean
    by_text = collections.defaultdict(set)
    text = dict(docs)
    for r in out:
        by_text[text[r["doc_id"]]].add(r["shard"])
        assert r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
    assert all(len(s) == 1 for s in by_text.values())


def test_a_third_of_copies_is_dealt_out(spark):
    docs = [(i, "copy " * 20 if i % 3 == 0 else f"{i} " * 20) for i in range(3000)]
    size = check_shards(kdtree.kd_shards(table(spark, docs)).collect(), len(docs))
    mean = sum(size.values()) / 16
    assert max(size.values()) < 1.15 * mean and min(size.values()) > 0.85 * mean


def test_groups_that_fit_a_shard_stay_whole(spark):
    sf = "/root/testdata/sf0.01"
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    by_text, size = collections.defaultdict(set), collections.Counter()
    for r in kdtree.op6_sharding(spark, sf).collect():
        by_text[text[r["doc_id"]]].add(r["shard"])
        size[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in by_text.values()) and len(size) == 16
    mean = sum(size.values()) / 16
    assert max(size.values()) < 1.2 * mean and min(size.values()) > 0.8 * mean


def test_splits_against_a_plain_tree(spark):
    """Each node is cut across its widest dimension, relative to the whole, at the weighted median; ties go by their hash."""
    rng = np.random.default_rng(4)
    n = 2000
    units = {"k": range(n), "bytes": rng.integers(1, 900, n).astype(float), "x0": rng.normal(size=n), "x1": rng.integers(0, 4, n).astype(float), "x2": rng.exponential(size=n), "x3": np.zeros(n), "tie": rng.random(n), "node": 0}
    import pandas as pd

    plain = pd.DataFrame(units)
    df = spark.createDataFrame(plain).withColumn("node", F.col("node").cast("int"))
    dims = list(kdtree.DIMENSIONS)
    for nodes in (1, 2, 4, 8):
        df = kdtree._split(df, nodes)
        span = plain[dims].max() - plain[dims].min()
        span[span == 0] = 1
        new = plain["node"] * 2
        for k in range(nodes):
            p = plain[plain["node"] == k]
            d = ((p[dims].max() - p[dims].min()) / span).idxmax()
            p = p.sort_values([d, "tie"])
            upto, half = p["bytes"].cumsum(), p["bytes"].sum() / 2
            at = int((upto <= half).sum())
            left = at + (half - (upto.iloc[at - 1] if at else 0) > p["bytes"].iloc[at] / 2)
            new[p.index[left:]] += 1
        plain["node"] = new
        got = {r["k"]: r["node"] for r in df.select("k", "node").collect()}
        assert got == dict(zip(plain["k"], plain["node"]))
        df = spark.createDataFrame(plain).withColumn("node", F.col("node").cast("int"))


def test_shards_of_a_target_size(spark):
    docs = table(spark, [(i, "y" * 99) for i in range(64)] + [(100 + i, f"{i:099}") for i in range(64)])
    assert len({r["shard"] for r in kdtree.kd_shards(docs, target_bytes=1700).collect()}) == 8


def test_shard_edges(spark):
    docs = [(None, None), (1, ""), (1, ""), (2, None), (3, "y" * 100_000)]
    out = kdtree.kd_shards(table(spark, docs)).collect()
    check_shards(out, 5)
    assert {(r["size"], r["text_crc32"]) for r in out if r["doc_id"] != 3} == {(1, 0)}
    assert kdtree.kd_shards(table(spark, [])).count() == 0
    assert {r["shard"] for r in kdtree.kd_shards(table(spark, [(1, "a")])).collect()} <= set(range(16))
    with pytest.raises(ValueError):
        kdtree.kd_shards(table(spark, docs), shards=12)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_base_score_and_normalisation(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = {r["doc_id"]: r for r in lbl.op8_lbl(spark, sf).collect()}
    count = collections.Counter(w for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2 for w in [*words(t), None])
    n, v = sum(count.values()), len(count)
    better = 0
    for i, t in docs:
        ts = [*words(t), None]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ts)
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ts), sum(count[w] > 0 for w in ts), n)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2) and math.isclose(r["base_score"], base, rel_tol=1e-9)
        better += r["score"] > r["base_score"]
    assert better / len(docs) > 0.8


def vocabulary(n=40):
    rng = np.random.default_rng(1)
    return lbl.Vocabulary([(b"w%d" % i, int(x)) for i, x in enumerate(np.sort(rng.integers(5, 500, n))[::-1])], rng.integers(0, 9, lbl.SUFFIXES), 30)


def test_probabilities_of_all_units_sum_to_one():
    rng, v = np.random.default_rng(0), vocabulary()
    m = lbl.LogBilinear(v)
    m.train(*(rng.integers(0, v.size, 20_000).astype(np.int32) for _ in range(3)))
    every = np.arange(v.size, dtype=np.int32)
    for a, b in ((0, 3), (v.size, v.size), (5, v.size)):
        p = np.exp(m.log_probabilities(every, np.full(v.size, a, np.int32), np.full(v.size, b, np.int32)))
        assert abs(p.sum() - 1) < 1e-4
    m.bias[:] *= 40  # scores beyond what exp() takes
    p = np.exp(m.log_probabilities(every, every, every))
    assert np.isfinite(p).all() and (p <= 1 + 1e-5).all()


def test_training_learns_what_follows_what():
    v = vocabulary()
    rng = np.random.default_rng(0)
    w = (np.arange(60_000) % 10).astype(np.int32)
    flip = rng.random(len(w)) < 0.1
    w[flip] = rng.integers(0, 10, flip.sum())
    m = lbl.LogBilinear(v)
    before = m.log_probabilities(w[2:], w[1:-1], w[:-2]).mean()
    for seed in range(6):
        m.train(w[2:], w[1:-1], w[:-2], seed)
    assert m.log_probabilities(w[2:], w[1:-1], w[:-2]).mean() > max(before, math.log(1 / 10)) + 1


def test_sequences_are_led_and_closed():
    v = vocabulary()
    w, a, b = v.sequence(np.array([4, 5, 6], np.int32), np.array([0, 2, 0, 1]))
    s = v.size
    assert w.tolist() == [v.end, 4, 5, v.end, v.end, 6, v.end]
    assert a.tolist() == [s, s, 4, 5, s, s, 6] and b.tolist() == [s, s, s, 4, s, s, s]


def test_score_by_brute_force(spark):
    """Every token's probability by the network's parameters, one by one; the words and the unknown of a class sum to one."""
    docs = [(i, " ".join(random.Random(i).choice(["alpha", "beta", "gamma", "deltas", "omegas", "x"]) for _ in range(50)) + f" r{i}ing q{i}ing") for i in range(60)]
    got = {}
    keep = lbl.Scorer.__init__

    def spy(self, *a):
        keep(self, *a)
        got["s"] = self

    lbl.Scorer.__init__ = spy
    try:
        out = {r["doc_id"]: r for r in lbl.lbl_scores(table(spark, docs), F.col("doc_id") < 50, most_words=5).collect()}
    finally:
        lbl.Scorer.__init__ = keep
    m, v = got["s"].model, got["s"].model.v
    count = collections.Counter(w for i, t in docs if i < 50 for w in t.split())
    assert len(v.words) == 5
    rest = collections.Counter()
    for w, n in count.items():
        if w.encode() not in v.words:
            rest[lbl.suffix(w.encode())] += n + 1
    for i, t in docs:
        units = [v.size, v.size, *(v.unit(w.encode()) for w in t.split()), v.end]
        want = 0.0
        for k, w in zip(range(2, len(units)), [*t.split(), None]):
            ctx = m.r[units[k - 1]] * m.c1 + m.r[units[k - 2]] * m.c2
            y = v.class_of[units[k]]
            s = np.exp(m.qc @ ctx + m.bc)
            inside = np.arange(v.begin[y], v.begin[y + 1])
            z = np.exp(m.q[inside] @ ctx + m.bias[inside])
            want += math.log10(s[y] / s.sum()) + math.log10(z[units[k] - v.begin[y]] / z.sum())
            if w is not None and w.encode() not in v.words:
                want += math.log10((count[w] + 1) / (rest[lbl.suffix(w.encode())] + 1))
        assert out[i]["score"] == pytest.approx(want, rel=1e-4)


def test_lbl_edges(spark):
    docs = table(spark, [(1, None), (1, ""), (None, "A b"), (2, "a B c")])
    out = lbl.lbl_scores(docs, F.lit(True)).collect()
    assert sorted(r["n_tokens"] for r in out) == [1, 1, 3, 4] and all(r["train_tokens"] == 9 and r["score"] <= 0 for r in out)
    out = lbl.lbl_scores(docs, F.lit(None).cast("boolean")).collect()
    assert all(r["score"] == r["base_score"] and r["n_known"] == 0 for r in out)
    assert lbl.lbl_scores(docs.limit(0), F.lit(True)).count() == 0


def test_repeated_rows_and_a_long_text(spark):
    docs = [(7, "same old words here")] * 3000 + [(8, "long " * 300_000), (9, None)]
    out = lbl.lbl_scores(table(spark, docs), F.lit(True)).collect()
    assert len(out) == len(docs) and {r["train_tokens"] for r in out} == {3000 * 5 + 300_001 + 1}
    assert len({round(r["score"], 9) for r in out if r["doc_id"] == 7}) == 1


def test_the_vocabulary_grows_with_the_corpus(spark):
    sizes = []
    for n in (100, 2700):
        docs = [(i, " ".join(f"w{random.Random(i * 50 + k).randint(0, 5000)}" for k in range(50))) for i in range(n)]
        seen = []
        keep = lbl.Vocabulary.__init__
        lbl.Vocabulary.__init__ = lambda self, words, *a: (seen.append(len(words)), keep(self, words, *a))[1]
        try:
            lbl.lbl_scores(table(spark, docs), F.lit(True)).count()
        finally:
            lbl.Vocabulary.__init__ = keep
        sizes.append(seen[0])
    assert 2.5 < sizes[1] / sizes[0] < 3.5


def test_words_with_equal_hashes_stay_apart(spark, monkeypatch):
    """Counts go by words, not by hashes."""
    monkeypatch.setattr(lbl.xxhash, "xxh3_64_intdigest", lambda w: 7)
    c = lbl.ChunkWords(["b a c a", "d"], [], 4)
    again = lbl.ChunkWords(["d", "c a b a"], [], 4)
    assert [c.words[i] for i in c.order] == [again.words[i] for i in again.order] == [b"a", b"b", b"c", b"d"]


TEMPLATES = licenses.TEMPLATES


def norm(text):
    return [x for x in (re.sub(r"^[^\w]+|[^\w]+$", "", w).lower() for w in text.split()) if x]


def grams(w):
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_license_scan_finds_edited_templates():
    """Against brute force: every template edited at random, where enough of its shingles is left."""
    t, rng = licenses.Templates(TEMPLATES), random.Random(3)
    texts, want = [], []
    for _ in range(400):
        name = rng.choice(sorted(TEMPLATES))
        w = TEMPLATES[name].split()
        for _ in range(rng.randint(0, max(1, len(w) // 30))):
            w[rng.randrange(len(w))] = "zz"
        text = " ".join([rng.choice("abcdefgh") for _ in range(rng.randint(0, 60))] + w + [rng.choice("abcdefgh") for _ in range(rng.randint(0, 60))])
        share = len(grams(norm(text)) & grams(norm(TEMPLATES[name]))) / len(grams(norm(TEMPLATES[name])))
        texts.append(text)
        want.append((name, share >= 0.8, share))
    found = t.scan(texts)
    missed = sum(ok and name not in {m[0] for m in f} for (name, ok, _), f in zip(want, found))
    false = sum(not ok and share < 0.75 and name in {m[0] for m in f} for (name, ok, share), f in zip(want, found))
    assert missed == 0 and false == 0
    for text, f in zip(texts, found):
        for name, a, b, share in f:
            part = grams(norm(" ".join(text.split()[a:b])))
            assert len(part & grams(norm(TEMPLATES[name]))) / len(grams(norm(TEMPLATES[name]))) == pytest.approx(share)


def test_license_table(spark):
    line = TEMPLATES["MIT/line"]
    docs = table(spark, [(1, f"x {line} y\n{line}"), (1, line), (None, line.upper()), (2, None), (3, ""), (4, "Released under the"), (5, "w " * 100_000 + line)])
    out = sorted(((r["doc_id"], r["template"], r["start_word"], r["end_word"]) for r in licenses.scan_licenses(docs).collect()), key=str)
    assert out == sorted([(1, "MIT/line", 1, 6), (1, "MIT/line", 7, 12), (1, "MIT/line", 0, 5), (None, "MIT/line", 0, 5), (5, "MIT/line", 100_000, 100_005)], key=str)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_license_query_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r["doc_id"], r["template"]) for r in licenses.op9_licenses(spark, sf).collect()}
    want = {(r["doc_id"], n) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for n, t in TEMPLATES.items() if len(grams(norm(r["text"])) & grams(norm(t))) >= 0.8 * len(grams(norm(t)))}
    assert got == want


def test_held_out_is_by_crc(spark):
    out = spark.range(300).select("id", held_out("id", 7).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 7 == 2) for r in out)
    assert spark.range(1).select(held_out("id").alias("h")).where(F.col("h").isNull()).count() == 0
