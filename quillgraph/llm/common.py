"""Helpers shared by the corpus operators: shared scratch tables, sizing, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where scratch tables go if a session on a local master names no spark.checkpoint.dir (tests, laptops).
FALLBACK_DIR = "file:///tmp/checkpoints/quillgraph"
#: What the tables that a Python worker remembers may take together, by the operators' own figures.
HELD_MB = 200

_held: dict = {}
_made: list[str] = []


def held(name, make, mb: int = 20):
    """What a Python worker remembers for one operator, made on first use; ``mb`` is about the most it grows to.

    Workers live on from stage to stage. Operators that share a projection keep their tables side by side; the oldest
    go when the sum would pass HELD_MB, and their memory goes back to the system.
    """
    found = _held.get(name)
    if found is None:
        if _held and sum(m for m, _ in _held.values()) + mb > HELD_MB:
            while _held and sum(m for m, _ in _held.values()) + mb > HELD_MB:
                del _held[next(iter(_held))]
            release()
        found = _held[name] = mb, make()
    return found[1]


def release() -> None:
    """Give memory that is free in this process back to the system, where the allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def quoted(name: str) -> str:
    """A column name that stands for itself, dots included."""
    return "`" + name.replace("`", "``") + "`"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; tables that cut lineage are written there."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = FALLBACK_DIR
    return f"{root.rstrip('/')}/quillgraph-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back, which cuts its lineage.

    A written table outlives lost executors and, unlike checkpoint(), computes its input only once.
    """
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    _made.append(path)
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by materialise(); only for tables that no later plan reads."""
    if path := getattr(df, "_scratch", None):
        _delete(df.sparkSession, path)


def made_so_far() -> set[str]:
    """The tables of materialise() that this process has made and not deleted."""
    return set(_made)


def discard_others(df: DataFrame, before: set[str]) -> None:
    """Delete the tables made since ``before``, except ``df``'s; only when no other plan reads them."""
    for path in [p for p in _made if p not in before and p != getattr(df, "_scratch", None)]:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
    if path in _made:
        _made.remove(path)


def pieces(total: float, each: float, spark: SparkSession, least: float) -> int:
    """How many parts of about ``each`` units ``total`` makes; small inputs still use every core, in parts of ``least``."""
    if not total:
        return 1
    cores = spark.sparkContext.defaultParallelism
    return max(1, math.ceil(total / each), min(2 * cores, math.ceil(total / least)))


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph. ``edges`` has long columns ``u`` and ``v``.

    Alternates large-star and small-star until nothing changes, so the number of rounds grows with the
    logarithm of the longest path and every step is a partial aggregation and a join. Returns ``node``,
    ``component`` (the smallest node reachable) for each node that has an edge to another; null ends
    and self-loops are ignored. Nothing is broadcast: Spark would judge the joins by the written tables' compressed size.
    """
    e = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialise(e)
    state = _checksum(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("p"))
        new = materialise(small.select(F.col("p.v").alias("u"), F.col("p.m").alias("v")).where("u <> v").distinct())
        discard(e)
        e, now = new, _checksum(new)
        if now == state:
            break
        state = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _checksum(e: DataFrame) -> tuple:
    row = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
    return tuple(row)
