"""JSON, CSV, text and archive sources of bibliographic records."""

from __future__ import annotations

import io
import tarfile
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph import schemas
from quillgraph.functions.numbers import first_page, last_page, strict_int


def parse_dump(lines: DataFrame, value: str = "value") -> DataFrame:
    """Catalogue rows of a dump's JSON lines; a line that is not JSON gives nulls, as a missing field does."""
    r = F.from_json(value, schemas.DUMP_RECORD, {"mode": "PERMISSIVE"})
    d = lines.withColumn("_r", r)
    parts = F.get("_r.issued.date-parts", F.lit(0))
    year = F.try_element_at(F.filter(parts, lambda p: F.length(p.cast("string")) == 4), F.lit(-1))
    part = lambda x: F.coalesce(x, F.lit("null"))  # noqa: E731 - a missing part prints as it does in the dump's own rendering
    pages = F.split("_r.page", "-")
    return d.select(
        F.transform(F.coalesce("_r.author", F.array().cast("array<struct<family:string,given:string,sequence:string>>")), lambda a: F.struct(F.concat(part(a["given"]), F.lit(" "), part(a["family"])).alias("name"))).alias("authors"),
        F.col("_r.DOI").alias("doi"), F.coalesce(F.get("_r.short-container-title", F.lit(0)), F.get("_r.container-title", F.lit(0))).alias("journal"), F.col("_r.page").alias("pages"),
        F.col("_r.volume").alias("volume"), F.get("_r.title", F.lit(0)).alias("title"), year.alias("year"), strict_int(F.get(pages, F.lit(0))).alias("first_page"), strict_int(F.get(pages, F.lit(1))).alias("last_page"),
        F.col("_r.issue").alias("issue"), F.filter(F.transform(F.coalesce("_r.link", F.array().cast("array<struct<URL:string>>")), lambda x: x["URL"]), lambda u: F.coalesce(F.trim(u), F.lit("")) != "").alias("pdf_urls"),
    )


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """A dump of JSON lines; compress it with a codec that can be split (bzip2, zstd frames) for parallel reads."""
    return parse_dump(spark.read.text(path))


def read_open_corpus(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines whose fields are the catalogue's own; a gzip file is one task."""
    return spark.read.schema(schemas.CATALOGUE).json(path)


def parse_hits(pages: DataFrame, value: str = "value", top: int = 3) -> DataFrame:
    """Hits of a search service: a row for each of the first ``top`` items, with its rank and ``h_`` columns."""
    items = pages.withColumn("_p", F.from_json(value, schemas.SEARCH_PAGE)).select("*", F.posexplode("_p.message.items").alias("rank", "_i")).where(F.col("rank") < top)
    has_journal = F.col("_i.container-title").isNotNull()
    journal = lambda c: F.when(has_journal, c)
    name = lambda a: F.concat(F.coalesce(a["family"], F.lit("null")), F.lit(" "), F.coalesce(a["given"], F.lit("null")))
    return items.withColumns({
        "h_title": F.get("_i.title", F.lit(0)), "h_doi": F.col("_i.DOI"),
        "h_authors": F.transform(F.coalesce("_i.author", F.array().cast("array<struct<family:string,given:string>>")), lambda a: F.struct(name(a).alias("name"))),
        "h_pdf_urls": F.filter(F.transform(F.coalesce("_i.link", F.array().cast("array<struct<URL:string>>")), lambda x: x["URL"]), lambda u: u.isNotNull()),
        "h_short_title": journal(F.get("_i.short-container-title", F.lit(0))), "h_full_title": journal(F.get("_i.container-title", F.lit(0))), "h_volume": journal(F.col("_i.volume")),
        "h_first_page": journal(first_page(F.col("_i.page"))), "h_last_page": journal(last_page(F.col("_i.page"))), "h_issue": journal(F.col("_i.issue")), "h_issn": journal(F.get("_i.ISSN", F.lit(0))),
        "h_year": journal(F.get(F.get("_i.issued.date-parts", F.lit(0)), F.lit(0))),
    }).drop("_p", "_i")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV of extractor runs."""
    return spark.read.schema(schemas.EXTRACTION_RUN).csv(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Files inside tar archives: ``archive``, ``name``, ``content``; one archive is read by one task."""

    def unpack(batches):
        for p in batches:
            for archive, blob in zip(p["path"], p["content"]):
                with tarfile.open(fileobj=io.BytesIO(blob)) as tar:
                    for member in tar:
                        if member.isfile():
                            yield pd.DataFrame({"archive": [archive], "name": [member.name.rsplit("/", 1)[-1]], "content": [tar.extractfile(member).read()]})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(unpack, "archive string, name string, content binary")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Binary files, such as PDFs, with their MD5."""
    return spark.read.format("binaryFile").load(path).withColumn("md5sum", F.md5("content"))


def read_properties(path: str | Path) -> dict[str, str]:
    """A .properties file: key=value lines; '#' begins a comment."""
    out = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        if line.strip() and not line.lstrip().startswith("#") and "=" in line:
            k, v = line.split("=", 1)
            out[k.strip()] = v.strip()
    return out
