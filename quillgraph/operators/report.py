"""Reports: extractor runs, pairwise differences, positional joins, rate logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def run_summary(runs: DataFrame) -> DataFrame:
    """By extractor: mean references, validated references and time, files with any reference, files."""
    return runs.groupBy("extractor").agg(
        F.round(F.avg("n_references"), 6).alias("avg_references"), F.round(F.avg("n_validated"), 6).alias("avg_validated"), F.round(F.avg("time_ms"), 6).alias("avg_time_ms"),
        F.count_if(F.col("n_references") > 0).alias("processed"), F.count("*").alias("files"),
    )


def only_in(left: DataFrame, right: DataFrame, by: str = "file", ids: tuple[str, ...] = ("arxiv_id", "doi")) -> DataFrame:
    """Rows of ``left`` that no row of ``right`` in the same file matches in any id.

    Two anti joins in a row stand for the disjunction. Null ids match nothing, but empty ones match each other, as in
    the published comparison; map them to null first to compare real ids only.
    """
    for c in ids:
        left = left.join(right.select(by, c).where(F.col(c).isNotNull()).distinct(), [by, c], "left_anti").select(left.columns)
    return left


def pairwise_differences(found: DataFrame, extractors: list[str] | None = None) -> DataFrame:
    """For each ordered pair of extractors how many references only the first one found; by default of all that occur, a handful."""
    if extractors is None:
        extractors = sorted(r[0] for r in found.select("extractor").where("extractor is not null").distinct().collect())
    out = None
    for a in extractors:
        for b in extractors:
            if a != b:
                n = only_in(found.where(F.col("extractor") == a), found.where(F.col("extractor") == b)).agg(F.count("*").alias("n")).select(F.lit(a).alias("found_by"), F.lit(b).alias("missed_by"), "n")
                out = n if out is None else out.unionByName(n)
    return out


def write_runs(runs: DataFrame, path: str) -> None:
    """One folder of CSV files for each extractor."""
    runs.write.mode("overwrite").partitionBy("extractor").csv(path)


def zip_arrays(rows: DataFrame, *columns: str) -> DataFrame:
    """Elements of several arrays by position, cut to the shortest: ``pos`` and a column for each."""
    shortest = F.least(*[F.size(c) for c in columns]) if len(columns) > 1 else F.size(columns[0])
    z = F.slice(F.arrays_zip(*columns), F.lit(1), shortest)
    return rows.select(*[c for c in rows.columns if c not in columns], F.posexplode(z).alias("pos", "_z")).select("*", "_z.*").drop("_z")


def at_positions(ids: DataFrame, found: DataFrame) -> DataFrame:
    """Join by explicit position and take the requested id over the returned one; a position on one side only is an error."""
    both = ids.withColumn("_a", F.lit(True)).join(found.drop("id").withColumn("_b", F.lit(True)), "pos", "full")
    lost = F.raise_error(F.concat(F.lit("no record or no id at position "), F.col("pos").cast("string"))).cast("boolean")
    return both.where(F.when(F.col("_a").isNull() | F.col("_b").isNull(), lost).otherwise(True)).drop("_a", "_b")


def over_limit(log: DataFrame, by: str, seconds: float, most: int) -> DataFrame:
    """Requests of a log that came when ``most`` others lay within the last ``seconds``."""
    w = W.partitionBy(by).orderBy(F.col("ts").cast("timestamp").cast("double")).rangeBetween(-seconds, 0)
    return log.withColumn("recent", F.count("*").over(w)).where(F.col("recent") > most)


def failures(rows: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    """Split into rows that are well and rows for the dead-letter table, by a column that names the reason."""
    return rows.where(F.col(reason).isNull()).drop(reason), rows.where(F.col(reason).isNotNull())
