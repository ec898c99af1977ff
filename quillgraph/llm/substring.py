"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, matched over the whole corpus.

Documents are dealt into chunks of a few megabytes. A chunk hashes all its windows, keeps one entry for each
distinct hash (with its smallest document) and sends these, packed into one binary row for each bucket of hashes;
a passage that a third of the corpus shares is one entry for each chunk. A bucket answers each chunk with a bitmap:
does the window also start in a document with a smaller id elsewhere? The chunks are then read a second time, from
the same shuffle, and the flagged windows of each document merge into maximal intervals.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm.common import held, pieces, quoted

#: Text bytes of a chunk, and window hashes of a bucket; both bound what one task holds.
CHUNK_BYTES = 2 << 20
BUCKET_WINDOWS = 2_000_000
#: Odd bases of the two rolling hashes modulo 2**64, and their inverses.
BASE = 0x9E3779B97F4A7C15
BASE2 = 0xD1342543DE82EF95
#: Distinct words whose hash a worker remembers.
REMEMBER = 200_000


class WordHashes(dict):
    """A word's 64-bit hash, remembered for the first words seen."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBER:
            self[word] = h
        return h


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64, grown as needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, 1 << 16), base, np.uint64)
        p[0] = 1
        have = _powers[base] = np.cumprod(p, dtype=np.uint64)
    return have[:n]


def rolling(h: np.ndarray, window: int, base: int) -> np.ndarray:
    """Rabin-Karp hashes of all windows of h, modulo 2**64, from prefix sums of h[j] * base**-j."""
    n = len(h)
    if n < window:
        return np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(h * _power(pow(base, -1, 1 << 64), n), out=sums[1:])
    return (sums[window:] - sums[:-window]) * _power(base, n)[: n - window + 1]


class Chunk:
    """The windows of a chunk of documents, one entry for each distinct hash, in bucket order."""

    def __init__(self, ids: np.ndarray, texts: list[str | None], window: int, buckets: int):
        self.words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        size = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(size)
        total = int(self.ends[-1]) if len(size) else 0
        h = np.empty(total, np.uint64)
        at, hashes = 0, held("substring", WordHashes, 60)
        for w in self.words:
            h[at : at + len(w)] = np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w))
            at += len(w)
        row = np.repeat(np.arange(len(size)), size)
        known = np.array([x is not None for x in ids], bool)
        num = np.array([x if x is not None else 0 for x in ids], np.int64)
        if total < window:
            self.start, key, key2 = np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
        else:
            self.start = np.flatnonzero((row[window - 1 :] == row[: total - window + 1]) & known[row[: total - window + 1]])
            key = rolling(h, window, BASE)[self.start]
            key2 = rolling(h ^ (h >> np.uint64(29)), window, BASE2)[self.start]
        self.doc = num[row[self.start]]
        order = np.lexsort((self.doc, key))
        first = np.ones(len(order), bool)
        first[1:] = key[order][1:] != key[order][:-1]
        lead = order[first]
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(first) - 1
        self.key, self.low = key[lead], self.doc[lead]
        # The bucket comes from a second hash, so that windows meet only if both agree: its bits grow with the corpus.
        self.bucket = ((key2[lead] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        self.order = np.lexsort((self.key, self.low, self.bucket))
        self.counts = np.bincount(self.bucket, minlength=buckets)


def _chunk(pdf: pd.DataFrame, window: int, buckets: int) -> Chunk:
    return Chunk(pdf["_id"].astype(object).where(pdf["_id"].notna(), None).to_numpy(), pdf["_text"].tolist(), window, buckets)


def _send(pdf: pd.DataFrame, window: int, buckets: int) -> pd.DataFrame:
    """For each bucket: the distinct hashes, by document, with the documents' ids (as differences) and their counts."""
    c = _chunk(pdf, window, buckets)
    key, low = c.key[c.order], c.low[c.order]
    out, at = [], 0
    for b, n in enumerate(c.counts.tolist()):
        if n:
            ids, counts = np.unique(low[at : at + n], return_counts=True)
            out.append((b, int(pdf["_chunk"].iloc[0]), key[at : at + n].tobytes(), np.diff(ids, prepend=0).tobytes(), counts.astype(np.uint32).tobytes()))
            at += n
    return pd.DataFrame(out, columns=["bucket", "chunk", "keys", "ids", "counts"])


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each chunk: a bit for each of its hashes in this bucket, set if a smaller document has it too."""
    keys = [np.frombuffer(x, np.uint64) for x in pdf["keys"]]
    docs = np.concatenate([np.repeat(np.cumsum(np.frombuffer(i, np.int64)), np.frombuffer(n, np.uint32)) for i, n in zip(pdf["ids"], pdf["counts"])])
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    first = np.ones(len(order), bool)
    first[1:] = sorted_key[1:] != sorted_key[:-1]
    low = np.minimum.reduceat(docs[order], np.flatnonzero(first))
    flag = np.empty(len(order), bool)
    flag[order] = docs[order] > low[np.cumsum(first) - 1]
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"], "bits": [np.packbits(x).tobytes() for x in np.split(flag, cuts)]})


def _cut(docs: pd.DataFrame, bits: pd.DataFrame, window: int, buckets: int, names: list[str], untouched: bool) -> pd.DataFrame:
    if not len(docs):
        return pd.DataFrame(columns=names)
    c = _chunk(docs, window, buckets)
    flag = np.zeros(len(c.key), bool)
    starts = np.cumsum(c.counts) - c.counts
    for b, x in zip(bits["bucket"], bits["bits"]):
        n = c.counts[b]
        flag[c.order[starts[b] : starts[b] + n]] = np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool)
    go = c.start[flag[c.group] | (c.doc > c.low[c.group])]
    total = int(c.ends[-1])
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, go, 1)
    np.add.at(edge, go + window, -1)
    gone = np.cumsum(edge[:-1]) > 0
    kept, removed, begins, ends = [], [], [], []
    at = 0
    for text, w, end in zip(docs["_text"].tolist(), c.words, c.ends.tolist()):
        g = gone[at:end]
        n = int(g.sum())
        at = end
        removed.append(n)
        if not n:
            kept.append((text or "") if untouched else b" ".join(w).decode("utf-8", "surrogatepass"))
            begins.append([])
            ends.append([])
            continue
        step = np.diff(g.astype(np.int8), prepend=0, append=0)
        begins.append(np.flatnonzero(step == 1).astype(np.int32))
        ends.append(np.flatnonzero(step == -1).astype(np.int32))
        kept.append(b" ".join([x for x, y in zip(w, g.tolist()) if not y]).decode("utf-8", "surrogatepass"))
    out = docs.assign(n_words=np.diff(c.ends, prepend=0), n_removed=removed, starts=begins, ends=ends, kept_text=kept)
    return out[names]


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, carry: dict[str, str] | None = None, untouched: bool = False) -> DataFrame:
    """Remove each word that lies in a window whose word sequence also starts in a document with a smaller id.

    Words are runs without ASCII white space. Windows are judged on the input, not on what is left. Returns one row
    for each input row: ``doc_id``, ``n_words``, ``n_removed``, ``starts`` and ``ends`` (the maximal removed
    intervals, in words, half open) and ``kept_text`` (the kept words joined by one space; with ``untouched`` a text that
    loses nothing stays as it is, white space included); ``carry`` names further
    outputs, other than these, and the input columns they come from.

    Null and empty texts have no words and an empty kept text. A row with a null id keeps all its words and removes
    none elsewhere. Rows that repeat an id count as one document, so they do not remove each other's words. Repeats
    within one document stay. An empty table gives no rows. Other input columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    carry = carry or {}
    if clash := {c.lower() for c in carry} & {"doc_id", "n_words", "n_removed", "starts", "ends", "kept_text"}:
        raise ValueError(f"carried columns can't be named {sorted(clash)}")
    base = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), *[F.col(quoted(c)).alias(f"_c{i}") for i, c in enumerate(carry.values())])
    size = base.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    chunks = pieces(size, CHUNK_BYTES, spark, 256 << 10)
    buckets = pieces(size / 6, BUCKET_WINDOWS, spark, 50_000)
    base = base.withColumn("_chunk", F.pmod(F.xxhash64("_id", F.octet_length("_text")), F.lit(chunks)).cast("int"))
    sent = base.groupBy("_chunk").applyInPandas(partial(_send, window=window, buckets=buckets), "bucket int, chunk int, keys binary, ids binary, counts binary")
    bits = sent.groupBy("bucket").applyInPandas(_answer, "chunk int, bucket int, bits binary")
    kinds = dict(base.dtypes)
    schema = {"_id": "long", "n_words": "long", "n_removed": "long", "starts": "array<int>", "ends": "array<int>", "kept_text": "string"}
    schema |= {f"_c{i}": kinds[f"_c{i}"] for i in range(len(carry))}
    cut = partial(_cut, window=window, buckets=buckets, names=list(schema), untouched=untouched)
    out = base.groupBy("_chunk").cogroup(bits.groupBy("chunk")).applyInPandas(cut, ", ".join(f"{k} {v}" for k, v in schema.items()))
    return out.withColumnsRenamed({"_id": "doc_id"} | {f"_c{i}": c for i, c in enumerate(carry)})


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
