"""End-to-end plans: loading the catalogue, harvesting, bulk archives, and resolution."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.functions.journal import parse_citation
from quillgraph.operators import catalogue as cat
from quillgraph.operators import graph, resolve, segment
from quillgraph.operators.lines import read_lines


#: Records that agree in all of these are alike, so any order of them gives the same table.
TOTAL_ORDER = ("doi", "title", "year", "volume", "first_page", "last_page", "issue", "journal", "pages", "pmid", "ssid", "authors", "pdf_urls")


def load_catalogue(records: DataFrame, stored: DataFrame | None = None, skip_known: bool = True, need_doi: bool = False) -> DataFrame:
    """Clean, drop records whose DOI is stored already, and number the rest after the stored ones."""
    rows = cat.clean_dump(records, need_doi)
    if stored is None:
        return cat.number(rows.drop("id"), *TOTAL_ORDER)
    if skip_known:
        rows = cat.drop_known(rows, stored)
    top = stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top"))
    return cat.number(rows.drop("id"), *TOTAL_ORDER).crossJoin(F.broadcast(top)).withColumn("id", F.col("id") + F.col("_top")).drop("_top")  # one row


def validators(letters: str, catalogue: DataFrame | None = None, hits: DataFrame | None = None) -> list[Callable[[DataFrame], DataFrame]]:
    """Validators by letter, in the order given: l resolves against the catalogue, c takes search hits, a extracts ids."""
    made = {"l": lambda r: resolve.resolve(r, catalogue), "c": lambda r: resolve.validate_hits(r, hits), "a": resolve.validate_ids}
    unknown = [x for x in letters if x not in made]
    if unknown:
        raise ValueError(f"no such validator: {', '.join(unknown)}")
    return [made[x] for x in letters]


def references(entries: DataFrame) -> DataFrame:
    """Citations with the fields that the rules of parse_citation() see in segmented entries."""
    none = lambda kind: F.lit(None).cast(kind)
    f = entries.withColumn("_f", parse_citation(F.col("reference")))
    return f.select(
        F.col("doc_id").alias("pub_id"), "pos", F.col("reference").alias("raw"), none("string").alias("arxiv_id"), F.regexp_extract("reference", r"\b(10\.\d{4,9}/\S+[^\s.,;])", 1).alias("doi"),
        F.transform("_f.authors", lambda a: F.struct(a.alias("name"), none("string").alias("affiliation"))).alias("authors"), "_f.title", "_f.journal", "_f.issue", "_f.first_page",
        "_f.last_page", "_f.volume", "_f.year", none("string").alias("issn"), none("string").alias("pmid"), none("string").alias("ssid"),
        F.array().cast("array<string>").alias("urls"), F.lit(True).alias("is_reference"), F.lit(False).alias("validated"),
    ).withColumn("doi", F.nullif("doi", F.lit("")))


class Extractor(Protocol):
    """Turns documents into bibliography entries: ``doc_id``, ``pos``, ``reference``."""

    def __call__(self, texts: DataFrame) -> DataFrame: ...


def layout_extractor(texts: DataFrame) -> DataFrame:
    """The layout rules, over positioned text."""
    return segment.segment(read_lines(texts))


def harvest(pubs: DataFrame, texts: DataFrame, chain: list[Callable[[DataFrame], DataFrame]], extractor: Extractor = layout_extractor) -> dict[str, DataFrame]:
    """Publications and their marked texts to a graph: lines, entries, citations, validators, nodes and edges."""
    refs = references(extractor(texts))
    for validate in chain:
        refs = refs.transform(validate)
    return graph.build(pubs, refs)


def write_graph(tables: dict[str, DataFrame], root: str) -> None:
    """Write all node and edge tables; a rerun overwrites them."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def session(app: str = "quillgraph", **conf: str) -> SparkSession:
    """A session with the settings the plans expect; what the cluster sets stays."""
    b = SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
