"""XML sources: OAI-PMH pages, Atom feeds, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph import schemas
from quillgraph.functions.text import before, null_if_blank, one_line

REQUIRED = ("identifier", "datestamp", "id", "created", "title", "abstract")


def read_oai_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "record").option("ignoreNamespace", "true").schema(schemas.OAI_RECORD).load(path)


def author_names(authors: Column) -> Column:
    """'forenames keyname suffix'; missing parts are left out, but a missing keyname leaves its space."""
    name = lambda a: F.concat(F.coalesce(F.concat(a["forenames"], F.lit(" ")), F.lit("")), F.coalesce(a["keyname"], F.lit("")), F.coalesce(F.concat(F.lit(" "), a["suffix"]), F.lit("")))
    return F.transform(F.coalesce(authors, F.array().cast(authors_type())), lambda a: F.struct(name(a).alias("name"), a["affiliation"].alias("affiliation")))


def authors_type() -> str:
    return "array<struct<keyname:string,forenames:string,suffix:string,affiliation:string>>"


def parse_oai(records: DataFrame) -> DataFrame:
    """Publications of OAI records; a record without a required field is dropped."""
    m = "metadata.arXiv."
    text = {"abstract": "abstract", "title": "title", "comments": "comments"}
    out = records.select(
        "header.identifier", "header.datestamp", F.col(f"{m}id").alias("id"), F.col(f"{m}created").alias("created"), F.col(f"{m}updated").alias("updated"),
        *[one_line(F.col(m + v)).alias(k) for k, v in text.items()],
        author_names(F.col(f"{m}authors.author")).alias("authors"),
        F.coalesce(F.split(f"{m}categories", " "), F.array().cast("array<string>")).alias("categories"),
        F.col(f"{m}`journal-ref`").alias("journal"), F.col(f"{m}`report-no`").alias("report_no"), F.col(f"{m}`msc-class`").alias("msc_class"),
        F.col(f"{m}`acm-class`").alias("acm_class"), F.col(f"{m}doi").alias("doi"), F.col(f"{m}license").alias("license"), F.lit(None).cast("string").alias("pdf_url"),
    )
    return out.dropna(subset=list(REQUIRED))


def read_oai(spark: SparkSession, path: str) -> DataFrame:
    return parse_oai(read_oai_raw(spark, path))


def page_records(pages: DataFrame, page: str = "page") -> DataFrame:
    """Publications of OAI pages that a harvest has brought as text, such as those of the paged source."""
    records = pages.select(F.explode(F.regexp_extract_all(page, F.lit(r"(?s)<record\b.*?</record>"), F.lit(0))).alias("_r"))
    return parse_oai(records.select(F.from_xml("_r", schemas.OAI_RECORD, {"ignoreNamespace": "true"}).alias("_r")).select("_r.*"))


def with_pdf_links(records: DataFrame, links: DataFrame) -> DataFrame:
    """``records`` with the address that ``links`` (``id``, ``url``) has for their id; a record without one is an error."""
    met = records.drop("pdf_url").join(links.select("id", F.col("url").alias("pdf_url")), "id", "left")
    lost = F.raise_error(F.concat(F.lit("no link for "), F.col("id"))).cast("string")
    return met.withColumn("pdf_url", F.when(F.col("pdf_url").isNull(), lost).otherwise(F.nullif("pdf_url", F.lit("")))).select(records.columns)


def read_cursor(spark: SparkSession, path: str) -> DataFrame:
    """``token`` and ``total`` of each page's resumption element; an empty token ends the harvest."""
    page = spark.read.text(path, wholetext=True)
    mark = r"(?s)<resumptionToken[^>]*>(.*?)</resumptionToken>"
    size = F.regexp_extract("value", r'<resumptionToken[^>]*completeListSize="(\d+)"', 1)
    return page.select(F.trim(F.regexp_extract("value", mark, 1)).alias("token"), F.coalesce(size.try_cast("int"), F.lit(0)).alias("total"))


def pdf_links(links: Column) -> Column:
    """Addresses of all links titled 'pdf'; one empty string if there is none."""
    found = F.transform(F.filter(links, lambda x: x["_title"] == "pdf"), lambda x: x["_href"])
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("")))


def categories(terms: Column) -> Column:
    """Terms that are neither blank nor have a digit, as classification codes do."""
    return F.filter(terms, lambda t: (F.trim(t) != "") & ~t.rlike(r"\d"))


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.format("xml").option("rowTag", "entry").schema(schemas.ATOM_ENTRY).load(path)
    return raw.select(
        "id", one_line(F.col("title")).alias("title"), one_line(F.col("summary")).alias("abstract"), before(F.col("published"), "T").alias("created"), before(F.col("updated"), "T").alias("updated"),
        F.transform("author", lambda a: F.struct(a["name"].alias("name"), a["arxiv:affiliation"].alias("affiliation"))).alias("authors"),
        categories(F.transform("category", lambda c: c["_term"])).alias("categories"), F.col("`arxiv:doi`").alias("doi"), F.col("`arxiv:journal_ref`").alias("journal"),
        null_if_blank(F.element_at(pdf_links(F.col("link")), -1)).alias("pdf_url"),
    )


def read_pdf_links(spark: SparkSession, path: str) -> DataFrame:
    """One row for each link titled 'pdf', or an empty one for an entry without."""
    raw = spark.read.format("xml").option("rowTag", "entry").schema(schemas.ATOM_ENTRY).load(path)
    return raw.select("id", F.explode(pdf_links(F.coalesce("link", F.array().cast("array<struct<_title:string,_href:string,_rel:string,_type:string>>")))).alias("url"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "file").schema(schemas.MANIFEST_FILE).load(path)


def pending(manifest: DataFrame, processed: DataFrame) -> DataFrame:
    """Files of a manifest that no processed path ends in; joined by base name."""
    done = processed.select(F.regexp_extract("path", r"[^/]+$", 0).alias("_base")).distinct()
    return manifest.withColumn("_base", F.regexp_extract("filename", r"[^/]+$", 0)).join(done, "_base", "left_anti").drop("_base")


def changed(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Files of a manifest whose local copy is missing or has another MD5; ``files`` has ``path`` and ``content``."""
    here = files.select(F.regexp_extract("path", r"[^/]+$", 0).alias("_base"), F.md5("content").alias("_md5"))
    rows = manifest.withColumn("_base", F.regexp_extract("filename", r"[^/]+$", 0)).join(here, "_base", "left")
    return rows.where(~F.col("_md5").eqNullSafe(F.col("md5sum"))).drop("_base", "_md5")
