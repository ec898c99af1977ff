import hashlib
import random
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from quillgraph.llm import minhash, multi_index, simhash, substring
from quillgraph.llm.common import connected_components, materialise
from tests.conftest import small_broadcasts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KIND = "doc_id long, text string, fingerprint string, chunk int, bucket string, bits int, fp int, node int, key int"


def table(spark, values):
    return spark.createDataFrame([(i, t, "c", 1, "c", 1, 1, 1, 1) for i, t in values], KIND)


def corpus(seed=1, n=120):
    """Short documents that share passages, copies and near copies; ids repeat, some texts are null or empty."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passages = [[rng.choice(words) for _ in range(rng.randint(10, 40))] for _ in range(5)]
    out = []
    for i in range(n):
        body = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(body))
            body[at:at] = rng.choice(passages)
        sep = rng.choice([" ", "  ", "\n", "\t", " "])
        out.append((i, sep.join(body)))
    out += [(n + k, out[k][1]) for k in range(10)] + [(n + 20 + k, out[k][1] + " tail") for k in range(10)]
    return out + [(n + 50, None), (n + 51, ""), (n + 52, "one"), (3, out[7][1]), (3, out[3][1])]


def test_substring_brute_force(spark):
    docs = corpus()
    first = {}
    cut = lambda t: WORD.findall(t or "")
    for i, t in docs:
        w = cut(t)
        for a in range(len(w) - 12):
            k = tuple(w[a : a + 13])
            first[k] = min(first.get(k, i), i)
    want = []
    for i, t in docs:
        w = cut(t)
        gone = [False] * len(w)
        for a in range(len(w) - 12):
            if first[tuple(w[a : a + 13])] < i:
                gone[a : a + 13] = [True] * 13
        want.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    rows = substring.substring_dedup(table(spark, docs)).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows) == sorted(want)
    assert sum(r["n_removed"] for r in rows) > 200
    for r in rows:
        assert sum(b - a for a, b in zip(r["starts"], r["ends"])) == r["n_removed"]
        assert all(b < a for b, a in zip(r["ends"], r["starts"][1:]))


def test_substring_edges(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    out = {r["doc_id"]: r for r in substring.substring_dedup(table(spark, [(None, long), (5, long), (6, long + " y"), (7, None)]), carry={"kept": "fingerprint"}).collect()}
    assert out[None]["n_removed"] == 0 and out[5]["n_removed"] == 0 and out[6]["kept_text"] == "y" and out[7]["kept_text"] == ""
    assert out[5]["kept"] == "c"
    assert substring.substring_dedup(table(spark, [])).count() == 0
    same = substring.substring_dedup(table(spark, [(1, "a  b\nc")]), untouched=True).first()
    assert same["kept_text"] == "a  b\nc"


def test_rolling_hash_is_positional():
    h = np.array([3, 5, 7, 3, 5, 7, 5, 3, 7], np.uint64)
    got = substring.rolling(h, 3, substring.BASE)
    want = [sum(int(h[a + k]) * pow(substring.BASE, -k, 1 << 64) for k in range(3)) * 1 for a in range(7)]
    scaled = {int(g) for g in got}
    assert got[0] == got[3] and len(scaled) == len({w % (1 << 64) for w in want})


def plain_fingerprint(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] * bool(w)
    ones = [0] * 64
    for x in s:
        h = xxhash.xxh64_intdigest(x.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(s))


def components(prints):
    """By brute force: {id: smallest id reachable}."""
    best = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for i, a in prints:
            for j, b in prints:
                if (a ^ b).bit_count() <= 3 and best[j] < best[i]:
                    best[i], changed = best[j], True
    return best


def test_simhash_brute_force(spark):
    docs = corpus(2)
    prints = [(i, plain_fingerprint(t)) for i, t in docs]
    want = components(prints)
    rows = simhash.simhash_groups(table(spark, docs)).collect()
    assert sorted((r["doc_id"], r["fingerprint"] & (2**64 - 1)) for r in rows) == sorted(prints)
    assert all(r["component_id"] == want[r["doc_id"]] for r in rows)


def near_prints(n, seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(n // 8)]
    out = set(base)
    while len(out) < n:
        x = rng.choice(base)
        for b in rng.sample(range(64), rng.randint(1, 5)):
            x ^= 1 << b
        out.add(x)
    return sorted(out)


def test_pigeonring_loses_no_link(spark):
    prints = near_prints(300, 5)
    rows = [(x - (1 << 64) if x >> 63 else x, i) for i, x in enumerate(prints)]
    links = simhash.near_links(spark.createDataFrame(rows, "fp long, node long"))
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    want = components(list(enumerate(prints)))
    assert {i: got.get(i, i) for i in want} == want


def test_large_keys_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    prints = sorted({(0xABCDEF << 40) | sum(1 << b for b in c) for k in range(60) for c in [random.Random(k).sample(range(40), 2)]})
    links = simhash.near_links(spark.createDataFrame([(x - (1 << 64) if x >> 63 else x, i) for i, x in enumerate(prints)], "fp long, node long"))
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    want = components(list(enumerate(prints)))
    assert {i: got.get(i, i) for i in want} == want


def test_no_key_of_near_prints_goes_to_the_driver(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(6000)]
    prints = [x ^ (1 << rng.randrange(64)) if k else x for x in base for k in range(2)]
    rows = [(x - (1 << 64) if x >> 63 else x, i) for i, x in enumerate(prints)]
    with small_broadcasts(spark):
        links = simhash.near_links(materialise(spark.createDataFrame(rows, "fp long, node long")))
        got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert got == {i: i - i % 2 for i in range(len(prints))}


def test_simhash_edges(spark):
    docs = table(spark, [(4, None), (3, ""), (None, "a b c d"), (5, "a b c d"), (5, "a b c d")])
    out = [(r["doc_id"], r["component_id"]) for r in simhash.simhash_groups(docs).collect()]
    assert sorted(out, key=str) == sorted([(4, 3), (3, 3), (None, None), (5, 5), (5, 5)], key=str)
    assert simhash.simhash_groups(table(spark, [])).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([3, None, 5, 5], key=str)


def test_components_of_a_long_path(spark):
    path = list(range(200))
    random.Random(3).shuffle(path)
    edges = spark.createDataFrame([*zip(path, path[1:]), (5, 5), (None, 1)], "u long, v long")
    out = connected_components(edges).collect()
    assert len(out) == 200 and {r["component"] for r in out} == {0}


def test_minhash_brute_force(spark):
    docs = sorted({i: t for i, t in reversed(corpus(3))}.items())
    shingles = lambda t: (lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())(WORD.findall(t or ""))
    out = {r["doc_id"]: r for r in minhash.fingerprint_edits(table(spark, docs)).collect()}
    assert len(out) == len(docs)
    errors = []
    for k, (i, t) in enumerate(docs):
        t, after = t or "", docs[(k + 1) % len(docs)][1] or ""
        n = len(t)
        edited = t[: n - n // 4] + after[: n // 4]
        assert out[i]["n_chars"] == n and out[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in ((out[i]["near_edited"], edited), (out[i]["near_next"], after)):
            a, b = shingles(t), shingles(other)
            errors.append(near - (len(a & b) / len(a | b) if a | b else 1))
            assert 0 <= near <= 1
    assert np.sqrt(np.mean(np.square(errors))) < 0.06 and abs(np.mean(errors)) < 0.02
    prints = {}
    for i, t in docs:
        assert prints.setdefault(t or "", out[i]["fingerprint"]) == out[i]["fingerprint"]


def test_minhash_edges(spark):
    docs = table(spark, [(None, "a b c d e f g h"), (1, None), (2, "x y"), (2, "x y"), (2, "z " * 9)])
    out = minhash.fingerprint_edits(docs).collect()
    assert len(out) == 5 and sum(r["doc_id"] is None for r in out) == 1
    assert minhash.fingerprint_edits(table(spark, [])).count() == 0
    alone = minhash.fingerprint_edits(table(spark, [(1, "abcdefgh")])).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and alone["near_next"] == 1


def vectors(n=900, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 3, 32))
    near = base[rng.integers(0, len(base), n // 3)] + rng.normal(size=(n // 3, 32)) * rng.uniform(0, 0.25, (n // 3, 1))
    hot = base[0] + rng.normal(size=(n // 3, 32)) * 0.05
    return np.concatenate((base, near, hot)).astype(np.float32)


def brute_links(x, label, threshold=0.98):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    hit = (u @ u.T >= threshold) & (label[:, None] == label[None])
    np.fill_diagonal(hit, False)
    return hit


def test_multi_index_recall(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 64)
    monkeypatch.setattr(multi_index, "CELL", 64)
    x = vectors()
    label = np.arange(len(x)) % 2
    hit = brute_links(x, label)
    rows = [(i, v.tolist(), int(g), "clash", 1) for i, (v, g) in enumerate(zip(x, label))]
    out = {r["vec_id"]: r for r in multi_index.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cell string, own int")).collect()}
    n = np.array([out[i]["n_links"] for i in range(len(x))])
    assert (n <= hit.sum(1)).all() and n.sum() / hit.sum() >= 0.95
    for i in range(len(x)):
        assert out[i]["component_id"] <= i and out[i]["kept"] == (out[i]["component_id"] == i)
        if n[i]:
            assert n[out[i]["component_id"]] > 0


def test_multi_index_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [0.0, 0.0], 1), (4, None, 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 2), (10, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (11, [1e-300, 0.0], 1)]
    out = multi_index.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert len(out) == len(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out}
    assert got[1] == (2, 1) and got[2] == (2, 1) and got[11] == (2, 1) and all(got[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10))
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert multi_index.near_vectors(empty).count() == 0


def test_multi_index_recall_on_many_vectors(spark, tmp_path):
    """50,000 vectors of three labels with near copies and a third of equal ones: recall of links and no false one."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(20_000, 32))
    near = base[rng.integers(0, 4000, 14_000)] + rng.normal(size=(14_000, 32)) * rng.uniform(0, 0.22, (14_000, 1))
    x = np.concatenate((base, near, np.repeat(base[:1], 16_000, 0))).astype(np.float32)
    label = np.concatenate((rng.integers(0, 3, 34_000), np.zeros(16_000, int)))
    pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x), "label": label}).to_parquet(tmp_path / "x.parquet")
    got = multi_index.near_vectors(spark.read.parquet(str(tmp_path / "x.parquet"))).toPandas().sort_values("vec_id")
    want = np.zeros(len(x), np.int64)
    for k in range(3):
        at = np.flatnonzero(label == k)
        u = x[at].astype(np.float64)
        u /= np.linalg.norm(u, axis=1)[:, None]
        for i in range(0, len(at), 1000):
            want[at[i : i + 1000]] = (u[i : i + 1000] @ u.T >= 0.98).sum(1) - 1
    n = got["n_links"].to_numpy()
    rare = want < 10_000
    assert (n <= want).all() and n[rare].sum() >= 0.98 * want[rare].sum() and n[~rare].sum() >= 0.98 * want[~rare].sum()
    assert got["component_id"].iloc[-1] == got["component_id"].iloc[34_000]


def test_multi_index_ids_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.01], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (1, [0.01, 1.0], 1)]
    out = multi_index.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out) == [(1, 3, 1)] * 3 + [(2, 2, 1)] * 2 + [(3, 1, 1)]


def test_multi_index_links_every_length(spark):
    x = {i: [1.0, float(i % 3), 0.5] for i in range(30)} | {i: [2.0, float(i % 2)] for i in range(30, 40)} | {40: [3.0], 41: [1.0], 42: [0.0]}
    out = {r["vec_id"]: r["n_links"] for r in multi_index.near_vectors(spark.createDataFrame([(i, v, 1) for i, v in x.items()], "vec_id long, embedding array<double>, label int")).collect()}
    assert out == {i: 9 if i < 30 else 4 if i < 40 else int(i < 42) for i in x}


def test_queries_agree_with_their_operators(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = substring.op1_substring(spark, sf)
    assert out.count() == docs.count() and set(out.columns) == {"doc_id", "n_words", "n_removed", "kept_sha256"}
    assert out.where(F.length("kept_sha256") != 64).count() == 0
    marks = simhash.op10_simhash(spark, sf)
    assert marks.where(~F.col("fingerprint").rlike("^[0-9a-f]{16}$")).count() == 0
