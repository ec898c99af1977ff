"""Sharding: a K-d tree over document metadata, cut at distributed weighted medians. DataFrame operations only.

Rows with equal texts form one unit with one set of coordinates, so they go to one shard; only a unit larger than a
whole shard is dealt out by id into several. A level of the tree is cut at once: histograms of the
bytes along the widest dimension of each node, refined until one value is left, then by a hash among rows that tie.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm.common import discard, materialise, pieces

SHARDS = 16
#: Bars of a histogram and times it is refined, by value and then among ties.
BARS = 1024
REFINE = 3
#: A unit of equal texts larger than a shard is dealt out in parts of about this share of a shard's bytes.
PART = 1 / 16
#: Rows numbered in one task.
SLOT_ROWS = 200_000
DIMENSIONS = ("x0", "x1", "x2", "x3")


def _pick(node: Column, values: list) -> Column:
    """The value of a row's node, from a list by node."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), node + 1)


def _histogram(units: DataFrame, low: list[float], width: list[float], at: str, within: Column) -> list[list[tuple]]:
    """For each node the bars of ``at`` in order, among the rows in ``within``: their bytes, least and greatest value."""
    bar = F.floor((F.col(at) - _pick(F.col("node"), low)) / _pick(F.col("node"), width)).cast("int")
    bar = F.greatest(F.lit(0), F.least(F.lit(BARS - 1), bar))
    rows = units.where(within).groupBy("node", bar.alias("bar")).agg(F.sum("bytes").alias("bytes"), F.min(at).alias("low"), F.max(at).alias("high")).collect()
    out: list[list[tuple]] = [[] for _ in low]
    for r in sorted(rows, key=lambda r: r["bar"]):
        out[r["node"]].append((r["bytes"], r["low"], r["high"]))
    return out


def _cut_points(units: DataFrame, low: list[float], high: list[float], at: str, want: list[float], within: Column) -> tuple[list[float], list[float], list[float], list[float]]:
    """By node: the bounds of the last bar, which holds the median, the bytes still wanted from it, and its bytes.

    Bounds are values that occur, the upper one excluded, so that no rounding moves a row across them.
    """
    low, ends, want, left = list(low), list(high), list(want), [0.0] * len(low)
    for step in range(REFINE):
        width = [max((h - x) / BARS, math.ulp(max(abs(h), abs(x), 1.0))) for x, h in zip(low, ends)]
        inside = within & (F.col(at) >= _pick(F.col("node"), low)) & (F.col(at) < _pick(F.col("node"), ends)) if step else within
        for k, bars in enumerate(_histogram(units, low, width, at, inside)):
            for i, (n, least, greatest) in enumerate(bars):
                if want[k] < n or i == len(bars) - 1:
                    left[k], low[k], ends[k] = n, float(least), math.nextafter(float(greatest), math.inf)
                    break
                want[k] -= n
    return low, ends, want, left


def _split(units: DataFrame, nodes: int) -> DataFrame:
    """Cut each of ``nodes`` nodes in two, at half of its bytes."""
    spans = units.groupBy("node").agg(F.sum("bytes").alias("bytes"), *[f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("low", F.min), ("high", F.max))])
    by = {r["node"]: r for r in spans.collect()}
    whole = {d: (max((r[f"high_{d}"] for r in by.values()), default=0) - min((r[f"low_{d}"] for r in by.values()), default=0)) or 1 for d in DIMENSIONS}
    widest = [max(DIMENSIONS, key=lambda d: (by[k][f"high_{d}"] - by[k][f"low_{d}"]) / whole[d]) if k in by else DIMENSIONS[0] for k in range(nodes)]
    low = [float(by[k][f"low_{widest[k]}"]) if k in by else 0.0 for k in range(nodes)]
    high = [math.nextafter(float(by[k][f"high_{widest[k]}"]), math.inf) if k in by else 1.0 for k in range(nodes)]
    want = [by[k]["bytes"] / 2 if k in by else 0.0 for k in range(nodes)]
    chosen = F.element_at(F.array(*DIMENSIONS), _pick(F.col("node"), [DIMENSIONS.index(w) + 1 for w in widest]))
    units = units.withColumn("at", chosen)
    low, ends, want, _ = _cut_points(units, low, high, "at", want, F.lit(True))
    tied = (F.col("at") >= _pick(F.col("node"), low)) & (F.col("at") < _pick(F.col("node"), ends))
    cut, after, want, left = _cut_points(units, [0.0] * nodes, [1.0] * nodes, "tie", want, tied)
    cut = [b if want[k] > left[k] / 2 else a for k, (a, b) in enumerate(zip(cut, after))]  # the unit at the median goes to the nearer side
    right = (F.col("at") >= _pick(F.col("node"), ends)) | (tied & (F.col("tie") >= _pick(F.col("node"), cut)))
    return units.withColumn("node", F.col("node") * 2 + F.when(right, 1).otherwise(0)).drop("at")


def kd_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", tags: tuple[str, ...] = ("source", "lang"), target_bytes: int | None = None) -> DataFrame:
    """Put all rows into ``shards`` shards (a power of two) of near equal bytes, under the law ``bytes``.

    With ``target_bytes`` nodes are split until the shards reach that size or less on average, whatever ``shards`` says.

    Returns a row for each input row: ``doc_id``, ``size`` (UTF-8 bytes of the text, plus 1), ``text_crc32``,
    ``shard``, and ``slot`` (gapless from 0 in each shard, by id within blocks). Dimensions are the logarithm of the
    size, the smallest id of the equal texts, and hashes of that row's ``tags``.

    A null text has size 1 and the CRC of an empty text, and equals other null and empty texts. Null ids and tags
    count as zero; repeated rows are a unit; an unsplittable table leaves shards empty; an empty table gives no rows;
    other columns are ignored.
    """
    if shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    text = F.coalesce(F.col(text_col), F.lit(""))
    have = [t for t in tags if t in docs.columns]
    tag = [F.pmod(F.xxhash64(F.col(t)), F.lit(1 << 20)).cast("double") for t in have] + [F.lit(0.0)] * (2 - min(2, len(have)))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
        tag[0].alias("t0"),
        tag[1].alias("t1"),
    )
    rows = materialise(rows)
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    if target_bytes:
        shards = 1 << math.ceil(math.log2(max(1.0, (total or 0) / target_bytes)))
    shard = max(1.0, (total or 0) / shards)
    key = ["text_crc32", "hash", "size"]
    groups = rows.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct(F.coalesce("doc_id", F.lit(0)).alias("id"), "t0", "t1")).alias("first"))
    groups = materialise(groups.withColumn("parts", F.when(F.col("n") * F.col("size") > shard, F.ceil(F.col("n") * F.col("size") / F.lit(shard * PART))).otherwise(1).cast("int")))  # written, so that joins on it can split a hot unit
    sub = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(64 * shards))  # four for each part of the largest unit
    part = sub % F.col("parts")
    # Only units that are dealt out need counts by part. They are summed by part of a hash before they meet their unit,
    # so a unit with a third of all rows is a few hundred rows there.
    large = groups.where(F.col("parts") > 1).select(*key, "parts")
    summed = rows.groupBy(*key, sub.alias("sub")).agg(F.sum("size").alias("bytes"))
    in_large = summed.join(large, key).groupBy(*key, (F.col("sub") % F.col("parts")).alias("part")).agg(F.sum("bytes").alias("bytes"))
    small = groups.where(F.col("parts") <= 1).select(*key, F.lit(0).cast("long").alias("part"), (F.col("n") * F.col("size")).alias("bytes"), "first")
    first = groups.where(F.col("parts") > 1).select(*key, "first")
    units = small.unionByName(in_large.join(first, key).select(*key, "part", "bytes", "first"))
    units = units.select(
        *key, "part", F.col("bytes").cast("double").alias("bytes"), F.log2("size").alias("x0"), F.col("first.id").cast("double").alias("x1"), F.col("first.t0").alias("x2"), F.col("first.t1").alias("x3"),
        (F.pmod(F.xxhash64("hash", "part"), F.lit(1 << 52)) / float(1 << 52)).alias("tie"), F.lit(0).alias("node"),
    )
    units = materialise(units)
    nodes = 1
    while nodes < shards:
        before, units = units, materialise(_split(units, nodes))  # else the plan grows with each level
        discard(before)
        nodes *= 2
    placed = units.select(*key, "part", F.col("node").alias("shard"))
    out = rows.join(groups.select(*key, "parts"), key).withColumn("part", F.when(F.col("parts") > 1, part).otherwise(0).cast("long"))
    out = materialise(out.join(placed, [*key, "part"]).select("doc_id", "size", "text_crc32", "hash", "shard", F.monotonically_increasing_id().alias("row")))
    return _slots(out, count)


def _slots(rows: DataFrame, count: int) -> DataFrame:
    """Number each shard's rows from 0: by block of a hash, then by id, with the sizes of earlier blocks added.

    ``row`` was written with the rows, so equal rows go to different blocks, and the same ones each time."""
    blocks = pieces(count, SLOT_ROWS, rows.sparkSession, 2000)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "hash", "row"), F.lit(blocks)))
    sizes = rows.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = sizes.selectExpr("shard", "block", "coalesce(sum(n) over (partition by shard order by block rows between unbounded preceding and 1 preceding), 0) as before")
    ranked = rows.selectExpr("*", "row_number() over (partition by shard, block order by doc_id, hash, row) - 1 as place")
    return ranked.join(before, ["shard", "block"]).select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("place")).cast("long").alias("slot"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kd_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
