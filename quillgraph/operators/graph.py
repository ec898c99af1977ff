"""The citation graph as node and edge tables, and their idempotent upsert."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions.numbers import iso_date
from quillgraph.functions.text import blank, null_if_blank

IDS = ("doi", "arxiv_id", "title")


def all_authors(pubs: DataFrame, refs: DataFrame) -> DataFrame:
    """Distinct (name, affiliation) of publications and resolved citations."""
    own = pubs.select(F.explode("authors").alias("a"))
    cited = refs.where("validated").select(F.explode("authors").alias("a"))
    return own.unionByName(cited).select("a.name", "a.affiliation").distinct()


def author_nodes(authors: DataFrame) -> DataFrame:
    return authors.select("name").distinct()


def affiliation_nodes(authors: DataFrame) -> DataFrame:
    return authors.where(~blank(F.col("affiliation"))).select(F.col("affiliation").alias("name")).distinct()


def journal_nodes(pubs: DataFrame, refs: DataFrame) -> DataFrame:
    own = pubs.select(F.col("journal").alias("title"))
    cited = refs.where("validated").select(F.col("journal").alias("title"))
    return own.unionByName(cited).where(~blank(F.col("title"))).distinct()


def publication_properties(pubs: DataFrame) -> DataFrame:
    """Properties of harvested publications: blanks become null, dates are parsed, the year is taken from them."""
    text = ("title", "doi", "msc_class", "acm_class", "pdf_url", "abstract")
    return pubs.select(F.col("id").alias("arxiv_id"), *[null_if_blank(F.col(c)).alias(c) for c in text], "categories", iso_date(F.col("created")).alias("created"), iso_date(F.col("updated")).alias("updated"), F.year(iso_date(F.col("created"))).alias("pub_year"))


def cited_key(row: DataFrame) -> Column:
    """The property a cited publication is merged by: its DOI, else its identifier, else its title."""
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    return F.coalesce(F.concat(F.lit("doi:"), some("doi")), F.concat(F.lit("arxiv_id:"), some("arxiv_id")), F.concat(F.lit("title:"), F.col("title")))


def match_by_any(refs: DataFrame, nodes: DataFrame, key: list[str], node: str, ids: tuple[str, ...] = IDS) -> DataFrame:
    """Pairs (key, node) that agree in any id: a union of equi-joins, as a disjunction would be a cross join.

    A null id meets nothing, nor does a blank one: nodes' blank ids are null. Joins here are merge joins: Spark guesses
    sizes from those of files, and would broadcast tables that grow.
    """
    def one(c: str) -> DataFrame:
        right = nodes.select(F.col(c).alias("_v"), F.col(node).alias("_node")).where(~blank(F.col("_v"))).distinct()
        return refs.select(*key, F.col(c).alias("_v")).where("_v is not null").join(right.hint("merge"), "_v").select(*key, F.col("_node").alias(node))

    return reduce(lambda a, b: a.unionByName(b), [one(c) for c in ids]).distinct()


def new_publications(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Resolved citations whose publication doesn't exist: one row for each merge key, the first by (pub_id, pos).

    Within a batch a later citation is not matched with what an earlier one creates, except by the same merge key.
    """
    fresh = refs.where("validated")
    for c in IDS:
        fresh = fresh.join(nodes.where(F.col(c).isNotNull()).select(c).distinct().hint("merge"), c, "left_anti")
    fresh = fresh.withColumn("merge_key", cited_key(fresh)).where("merge_key is not null")
    first = fresh.groupBy("merge_key").agg(F.min_by(F.struct(*refs.columns), F.struct("pub_id", "pos")).alias("_first"))
    return first.select(*[F.col(f"_first.{c}").alias(c) for c in refs.columns], "merge_key")


def missing_publications(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Titles of unresolved citations that no publication matches."""
    lost = refs.where(~F.col("validated") & ~blank(F.col("title")))
    for c in IDS:
        lost = lost.join(nodes.where(F.col(c).isNotNull()).select(c).distinct().hint("merge"), c, "left_anti")
    return lost.select("title").distinct()


def authored_edges(pubs: DataFrame) -> DataFrame:
    """publication -> author. An author with a blank (not null) affiliation has no such node, and loses the edge too."""
    a = pubs.select(F.col("id").alias("src"), F.explode("authors").alias("a"))
    return a.where(F.col("a.affiliation").isNull() | ~blank(F.col("a.affiliation"))).select("src", F.col("a.name").alias("dst")).distinct()


def works_edges(pubs: DataFrame) -> DataFrame:
    a = pubs.select(F.explode("authors").alias("a"))
    return a.where(~blank(F.col("a.affiliation"))).select(F.col("a.name").alias("src"), F.col("a.affiliation").alias("dst")).distinct()


def _any_ids(rows: DataFrame, by: list[str], usable: Callable[[Column], Column]) -> DataFrame:
    """A row for each distinct ``by`` and id it has, as ``_v``; ``_before`` has its ids that sort before, or null."""
    ids = F.filter(F.array(*[F.when(usable(F.col(c)), F.concat(F.lit(f"{c}:"), F.col(c))) for c in IDS]), lambda x: x.isNotNull())
    own = rows.select(*by, ids.alias("_ids")).repartition(*by).groupBy(*by).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_ids")))).alias("_ids"))
    before = F.filter("_ids", lambda x: x < F.col("_v"))
    return own.select(*by, "_ids", F.explode("_ids").alias("_v")).select(*by, "_v", F.when(F.size(before) > 0, before).alias("_before"))


def citation_edges(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """citing -> every publication that matches in any id, itself excluded: distinct (src, dst, raw_ref).

    Equal citations of a publication are put together before the join, and a pair comes from the first id that both
    have; so pairs, which can be many times the citations, are distinct as they are and need no shuffle.
    """
    cited = _any_ids(refs, ["pub_id", "raw"], lambda c: c.isNotNull()).withColumnRenamed("_before", "_cited")
    known = _any_ids(nodes.withColumnRenamed("node", "dst"), ["dst"], lambda c: ~blank(c))
    met = cited.join(known.hint("merge"), "_v").where(~F.coalesce(F.arrays_overlap("_cited", "_before"), F.lit(False)))
    return met.where(F.col("pub_id") != F.col("dst")).select(F.col("pub_id").alias("src"), "dst", F.col("raw").alias("raw_ref"))


def cited_by_edges(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """missing publication -> citing, for citations that match nothing.

    A titled one is a node by title and keeps the last raw string by position; an untitled one is a node of its own.
    """
    matched = match_by_any(refs.select("pub_id", "pos", *IDS), nodes.withColumnRenamed("node", "_node"), ["pub_id", "pos"], "_node").where("pub_id <> _node").select("pub_id", "pos").distinct()
    lost = refs.join(matched.hint("merge"), ["pub_id", "pos"], "left_anti")
    own = F.concat(F.lit("#"), F.sha2(F.concat_ws("/", "pub_id", F.col("pos").cast("string")), 256))
    lost = lost.withColumn("src", F.when(F.coalesce("title", F.lit("")) != "", F.col("title")).otherwise(own))
    return lost.groupBy("src", F.col("pub_id").alias("dst")).agg(F.max_by("raw", "pos").alias("raw_ref"))


def published_edges(pubs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """publication -> journal with the properties of the first row that creates the edge; known edges stay as they are."""
    rows = pubs.where(~blank(F.col("journal"))).select(F.col("id").alias("src"), F.col("journal").alias("dst"), F.struct("volume", "first_page", "last_page", "issue", F.col("raw_ref")).alias("p"), "pos")
    first = rows.groupBy("src", "dst").agg(F.min_by("p", "pos").alias("p")).select("src", "dst", "p.*")
    return first if known is None else first.join(known.select("src", "dst"), ["src", "dst"], "left_anti").unionByName(known)


def upsert(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Merge a batch into a node table: new properties win where they are not null; in a batch the last one by ``order``."""
    props = [c for c in old.columns if c != key]
    batch = new.groupBy(key).agg(*[F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_{c}") for c in props])
    return old.join(batch, key, "full").select(key, *[F.coalesce(f"_{c}", c).alias(c) for c in props])


def build(pubs: DataFrame, refs: DataFrame) -> dict[str, DataFrame]:
    """All node and edge tables of a batch of publications and their citations."""
    nodes = pubs.select(F.col("id").alias("node"), "doi", F.col("id").alias("arxiv_id"), "title")
    fresh = new_publications(refs, nodes)
    cited = fresh.select(F.col("merge_key").alias("node"), *IDS)
    every = nodes.unionByName(cited)
    authors = all_authors(pubs, refs)
    none = lambda kind: F.lit(None).cast(kind)
    own = pubs.select("id", "journal", none("string").alias("volume"), none("int").alias("first_page"), none("int").alias("last_page"), none("string").alias("issue"), F.col("journal").alias("raw_ref"), F.lit(0).alias("pos"))
    in_journals = own.unionByName(fresh.select(F.col("merge_key").alias("id"), "journal", "volume", "first_page", "last_page", "issue", F.col("raw").alias("raw_ref"), "pos"))
    return {
        "publications": every, "authors": author_nodes(authors), "affiliations": affiliation_nodes(authors), "journals": journal_nodes(pubs, refs),
        "missing": missing_publications(refs, every), "authored": authored_edges(pubs.select("id", "authors").unionByName(fresh.select(F.col("merge_key").alias("id"), "authors"))),
        "works": works_edges(pubs.select("id", "authors").unionByName(fresh.select(F.col("merge_key").alias("id"), "authors"))),
        "cites": citation_edges(refs, every), "cited_by": cited_by_edges(refs, every), "published": published_edges(in_journals), "properties": publication_properties(pubs),
        "cited_properties": fresh.select(F.col("merge_key").alias("node"), *IDS, "year", "journal", "volume", "issue", "first_page", "last_page", "issn", "pmid", "ssid", "urls"),
    }
