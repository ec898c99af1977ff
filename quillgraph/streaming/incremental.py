"""Incremental loads with Structured Streaming: file streams, upserts in batches, posting lists, compaction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from quillgraph.functions.numbers import within_grace
from quillgraph.operators.catalogue import merge_postings, posting_lists


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def file_stream(spark: SparkSession, path: str, schema, files_each: int | None = None, fmt: str = "parquet") -> DataFrame:
    """New files of a folder as a stream; the checkpoint remembers which were processed."""
    reader = spark.readStream.format(fmt).schema(schema)
    return (reader.option("maxFilesPerTrigger", files_each) if files_each else reader).load(path)


def drain(stream: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process everything that is there in batches and stop; a restart goes on after the last finished batch."""
    q = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


class Versions:
    """A table rewritten by each batch: version n is written beside the one before and read only when complete.

    A batch that runs again after a failure starts from the version before it, so it is applied once.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self, before: int | None = None) -> DataFrame | None:
        listed = sorted(v for v in self._complete() if before is None or v < before)
        return self.spark.read.parquet(f"{self.root}/v={listed[-1]}") if listed else None

    def write(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/v={version}")

    def _complete(self) -> list[int]:
        jvm, conf = self.spark.sparkContext._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(conf)
        if not fs.exists(root):
            return []
        folders = [s.getPath() for s in fs.listStatus(root)]
        return [int(p.getName()[2:]) for p in folders if p.getName().startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]


def upsert_postings(versions: Versions) -> Callable[[DataFrame, int], None]:
    """Batch function that merges a batch of catalogue rows into stored posting lists."""

    def each(batch: DataFrame, n: int) -> None:
        new, old = posting_lists(batch), versions.read(before=n)
        versions.write(new if old is None else merge_postings(old, new), n)

    return each


def upsert_counts(versions: Versions, key: str) -> Callable[[DataFrame, int], None]:
    """Batch function that adds up rows by key."""

    def each(batch: DataFrame, n: int) -> None:
        new, old = batch.groupBy(key).agg(F.count("*").alias("n")), versions.read(before=n)
        both = new if old is None else new.unionByName(old)
        versions.write(both.groupBy(key).agg(F.sum("n").alias("n")), n)

    return each


def recent(pubs: DataFrame, start, days: int = 7) -> DataFrame:
    """Publications whose bibliography is extracted; all are stored."""
    return pubs.where(within_grace(F.col("updated"), F.col("created"), start, days))


def skip_first(rows: DataFrame, position: str, n: int) -> DataFrame:
    """Resume after the first ``n`` records."""
    return rows.where(F.col(position) > n)


def audit(rows: DataFrame, index: DataFrame, key: str, every: int, position: str) -> DataFrame:
    """Of every ``every``-th record those whose key is not indexed, to check a resumed load."""
    return rows.where(F.col(position) % every == 0).join(index.select(key).distinct(), key, "left_anti")


def compact(spark: SparkSession, path: str, out: str, target_bytes: int = 128 << 20) -> int:
    """Rewrite a folder of small files into files of about ``target_bytes``; returns how many."""
    jvm, conf = spark.sparkContext._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    p = jvm.org.apache.hadoop.fs.Path(path)
    n = max(1, -(-p.getFileSystem(conf).getContentSummary(p).getLength() // target_bytes))
    spark.read.parquet(path).repartition(int(n)).write.mode("overwrite").parquet(out)
    return int(n)
