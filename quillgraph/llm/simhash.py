"""Near-duplicates by SimHash fingerprints, found with a pigeonring filter."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from quillgraph.llm.common import connected_components, materialise

#: 64 bits in a ring of 16 segments of 4 bits. With at most 3 differing bits there is a segment from which every
#: chain of l segments has at most floor(3 l / 16) differing bits: none in 5, one in 10, two in 15, three in 16.
SEGMENTS = 16
DISTANCE = 3
#: Fingerprints of one key compared in one task; larger keys are dealt out as pairs of blocks of this size.
BLOCK = 4096


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of a text, as a signed integer; zero without words."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    n = len(w)
    if n <= words:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(w), 42)], np.uint64)
    else:
        joined = b" ".join(w)
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[: n - words] + 1)).tolist()
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        ones += np.unpackbits(h[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h)).view(">u8")[0].astype(np.uint64).astype(np.int64))


@F.pandas_udf(LongType())
def simhash(texts: pd.Series) -> pd.Series:
    """SimHash over three-word shingles, repeats included, each hashed by XXH64 with seed 42."""
    return pd.Series([fingerprint(x) for x in texts], dtype="int64")


def _keys(fp: F.Column) -> F.Column:
    """The 32 keys of a fingerprint: for each start, 20 bits that must agree and either half of the next 20,
    of which one may differ, so that one half agrees."""
    out = []
    for i in range(SEGMENTS):
        k = 4 * i
        rot = fp if not k else F.shiftleft(fp, k).bitwiseOR(F.shiftrightunsigned(fp, 64 - k))
        first = F.shiftrightunsigned(rot, 44)
        upper = F.shiftrightunsigned(rot, 34).bitwiseAND(F.lit(1023))
        lower = F.shiftrightunsigned(rot, 24).bitwiseAND(F.lit(1023))
        for half, bits in enumerate((upper, lower)):
            out.append(F.shiftleft(F.lit(2 * i + half).cast("long"), 30).bitwiseOR(F.shiftleft(first, 10)).bitwiseOR(bits))
    return F.array(*out)


def _near(x: np.ndarray, start: int) -> np.ndarray:
    """Of XORed fingerprints: which pass the chains from this start and the whole check."""
    k = np.uint64(4 * start)
    rot = x if not start else (x << k) | (x >> np.uint64(64 - 4 * start))
    ok = np.bitwise_count(rot >> np.uint64(24)) <= 1
    ok &= np.bitwise_count(rot >> np.uint64(4)) <= 2
    return ok & (np.bitwise_count(x) <= DISTANCE)


def _forest(fp: np.ndarray, node: np.ndarray, side: np.ndarray | None, start: int) -> list[tuple[int, int]]:
    """Links among one key's fingerprints, thinned to a spanning forest; across two blocks if side is given."""
    group, out = np.arange(len(fp)), []
    for a in range(len(fp) - 1):
        near = _near(fp[a + 1 :] ^ fp[a], start)
        if side is not None:
            near &= side[a + 1 :] != side[a]
        met = np.unique(group[a + 1 :][near])
        met = met[met != group[a]]
        if len(met):
            out += [(int(node[a]), int(node[b])) for b in met]
            group[np.isin(group, met)] = group[a]
    return out


def _link(batches):
    """Links of keys that arrive sorted; the last key of a batch waits for the next batch."""
    rest: pd.DataFrame | None = None
    columns = ["key", "lo", "hi", "block", "fp", "node"]

    def links(p: pd.DataFrame) -> pd.DataFrame:
        key, lo, hi = (p[c].to_numpy() for c in columns[:3])
        fp, node, block = p["fp"].to_numpy().view(np.uint64), p["node"].to_numpy(), p["block"].to_numpy()
        cut = np.flatnonzero((key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
        begin, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(p)]))
        size = end - begin
        two = begin[(size == 2) & (lo[begin] == hi[begin])]
        start = (key[two] >> 31).astype(np.uint64)
        x = fp[two] ^ fp[two + 1]
        ok = np.zeros(len(two), bool)
        for i in range(SEGMENTS):
            at = np.flatnonzero(start == i)
            ok[at] = _near(x[at], i)
        u, v = [node[two[ok]]], [node[two[ok] + 1]]
        for a, b in zip(begin, end):
            if b - a > 2 or (b - a == 2 and lo[a] != hi[a]):
                found = _forest(fp[a:b], node[a:b], None if lo[a] == hi[a] else block[a:b], int(key[a]) >> 31)
                if found:
                    pair = np.array(found, np.int64)
                    u.append(pair[:, 0])
                    v.append(pair[:, 1])
        return pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v)})

    for p in batches:
        p = p[columns] if rest is None else pd.concat([rest, p[columns]], ignore_index=True)
        if not len(p):
            continue
        last = p.iloc[-1]
        same = ((p["key"] == last["key"]) & (p["lo"] == last["lo"]) & (p["hi"] == last["hi"])).to_numpy()
        at = int(np.argmax(same))
        rest = p.iloc[at:]
        if at:
            yield links(p.iloc[:at])
    if rest is not None and len(rest):
        yield links(rest)


def near_links(prints: DataFrame) -> DataFrame:
    """Links ``u``, ``v`` that connect all distinct fingerprints at 3 or fewer differing bits.

    ``prints`` has long columns ``fp`` (distinct) and ``node``. Each key's links come as a spanning forest, so
    a large group of near copies makes no more links than keys times members, and no connection is lost.
    """
    keyed = prints.select(F.explode(_keys(F.col("fp"))).alias("key"), "fp", "node")
    large = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    large = large.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    # Nothing here is broadcast: by Spark's estimate the 32 keys of a fingerprint are no more than the fingerprint.
    dealt = keyed.join(large.hint("merge"), "key").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "fp", "node")
    sets = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "fp")
    return sets.mapInPandas(_link, "u long, v long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents whose SimHash fingerprints link up at 3 or fewer differing bits.

    Returns ``doc_id``, ``fingerprint`` (long) and ``component_id``, the smallest id reachable, one row for each
    input row. Null and wordless texts have fingerprint zero and link like any other; equal texts, ties and
    repeated rows share a component; a row with a null id is in no group and has a null component; an empty table
    gives no rows; other columns are ignored. No table that grows with the documents is broadcast.
    """
    marks = materialise(docs.select(F.col(id_col).cast("long").alias("doc_id"), simhash(F.col(text_col)).alias("fingerprint")))
    prints = materialise(marks.where("doc_id is not null").groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("node")))
    found = connected_components(near_links(prints))
    group = prints.join(found.hint("merge"), "node", "left").select(F.col("fp").alias("fingerprint"), F.coalesce("component", "node").alias("group"))
    out = marks.join(group.hint("merge"), "fingerprint", "left")
    return out.select("doc_id", "fingerprint", F.when(F.col("doc_id").isNotNull(), F.col("group")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keep of each group the row with the smallest id, with the columns of ``docs`` unchanged.

    Rows with a null id are kept. If the smallest id is on several rows, all of these stay.
    """
    keep = simhash_groups(docs, id_col, text_col).where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_quill_keep")).distinct()
    kept = docs.join(keep.hint("merge"), docs[id_col] == F.col("_quill_keep"), "left_semi")
    return kept.unionByName(docs.where(F.col(id_col).isNull()))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
