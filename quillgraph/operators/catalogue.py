"""The catalogue of known publications: cleaning, blocking keys, posting lists, lookups and duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillgraph.functions.numbers import expand_last_page, strict_int
from quillgraph.functions.text import blank, initials_key, title_key

#: Keys with this many postings or more are not indexed.
CAP = 10
#: Blocking keys in the order in which their candidates are tried.
BLOCKS = ("title", "author_volume_page_year", "author_pages_volume", "author_volume_year", "author_page_year")


def clean_dump(records: DataFrame, need_doi: bool = False) -> DataFrame:
    """Clean records of the open-corpus dump: page ranges, titles, 'volume issue' strings; drop records without a title."""
    pages = F.regexp_replace("pages", r"\s+", "")
    parts = F.split(pages, "-")
    first = F.when(F.size(parts) <= 2, strict_int(F.get(parts, F.lit(0))))
    last = F.when(F.size(parts) == 2, strict_int(F.get(parts, F.lit(1))))
    words = F.filter(F.split("volume", r"\s"), lambda w: w != "")
    out = records.withColumns({"pages": pages, "title": F.regexp_replace("title", "\n", " "), "_first": F.coalesce(first, F.col("first_page")), "_last": F.coalesce(last, F.col("last_page")), "_words": words})
    out = out.withColumns({
        "first_page": F.col("_first"), "last_page": F.when(F.size(F.split("pages", "-")) == 2, expand_last_page(F.col("_first"), F.col("_last"))).otherwise(F.col("_last")),
        "volume": F.coalesce(F.get("_words", F.lit(0)), F.col("volume")), "issue": F.coalesce(F.get("_words", F.lit(1)), F.col("issue")),
    }).drop("_first", "_last", "_words")
    out = out.where(usable_title(F.col("title")))
    return out.where(~blank(F.col("doi"))) if need_doi else out


def usable_title(title: Column) -> Column:
    """A title that is there and not a placeholder."""
    return ~blank(title) & ~title.contains("[Not Available].")


def number(records: DataFrame, *order: str) -> DataFrame:
    """Consecutive ids from 1 in a total order, without bringing all rows to one task.

    Rows are dealt by range and numbered in each range; the sizes of the ranges before are added.
    """
    dealt = records.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    dealt = dealt.withColumn("_place", F.row_number().over(W.partitionBy("_part").orderBy(*order)))
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row for each range
    return dealt.join(before, "_part").withColumn("id", F.col("_before") + F.col("_place")).drop("_part", "_place", "_n", "_before")


def blocking_keys(rows: DataFrame, probe: bool) -> DataFrame:
    """One row for each row and blocking key: ``block`` (its rank), ``key`` (a struct) and the row's columns.

    Records need one author for the first and third author key, citations one and two; the others need two.
    """
    n = F.size("authors")
    auth = initials_key(F.transform("authors", lambda a: a["name"]))
    has_volume, text = ~blank(F.col("volume")), lambda *c: F.to_json(F.array(*[F.col(x).cast("string") if isinstance(x, str) else x for x in c]))
    two = n >= 2
    keys = [
        F.when(~blank(F.col("title")), title_key(F.col("title"))),
        F.when(has_volume & F.col("first_page").isNotNull() & F.col("year").isNotNull() & (n >= 1), text(auth, "volume", "first_page", "year")),
        F.when(has_volume & F.col("first_page").isNotNull() & F.col("last_page").isNotNull() & (two if probe else n >= 1), text(auth, "first_page", "last_page", "volume")),
        F.when(has_volume & F.col("year").isNotNull() & two, text(auth, "volume", "year")),
        F.when(F.col("first_page").isNotNull() & F.col("year").isNotNull() & two, text(auth, "first_page", "year")),
    ]
    return rows.withColumn("_key", F.explode(F.array(*[F.struct(F.lit(i).alias("block"), k.alias("key")) for i, k in enumerate(keys)]))).select("*", "_key.*").drop("_key").where("key is not null")


def postings(catalogue: DataFrame, cap: int = CAP) -> DataFrame:
    """The inverted index: ``block``, ``key``, ``id`` for each posting, hot keys left out.

    A hot key is known from its partial counts alone, so no list is ever gathered for it. Hot keys are few beside the
    others, so the engine can broadcast them after checking their size, and their rows go before any shuffle; if they
    are many, the anti join is a shuffle whose large partitions can be split.
    """
    keyed = blocking_keys(catalogue, probe=False).select("block", "key", "id")
    hot = keyed.groupBy("block", "key").agg(F.count("*").alias("n")).where(F.col("n") >= cap).select("block", "key")
    return keyed.join(hot, ["block", "key"], "left_anti")


def posting_lists(catalogue: DataFrame, cap: int = CAP) -> DataFrame:
    """The inverted index as lists, newest first; each has fewer than ``cap`` ids."""
    return postings(catalogue, cap).groupBy("block", "key").agg(F.sort_array(F.collect_list("id"), asc=False).alias("ids"))


def merge_postings(stored: DataFrame, new: DataFrame, cap: int = CAP) -> DataFrame:
    """Merge a batch's lists into the stored ones: new ids first, cut to the cap; a full list is not written again."""
    old = stored.withColumnRenamed("ids", "_old")
    out = new.join(old, ["block", "key"], "full")
    merged = F.slice(F.concat(F.coalesce("ids", F.array().cast("array<bigint>")), F.coalesce("_old", F.array().cast("array<bigint>"))), 1, cap)
    out = out.withColumn("ids", F.when(F.size(merged) < cap, merged).otherwise(F.col("_old"))).drop("_old")
    return out.where("ids is not null")


def posting_stats(catalogue: DataFrame) -> DataFrame:
    """The longest posting list of each block, before the cap."""
    sizes = blocking_keys(catalogue, probe=False).groupBy("block", "key").agg(F.count("*").alias("n"))
    return sizes.groupBy("block").agg(F.max("n").alias("longest"))


def lookup(catalogue: DataFrame, block: str, **values) -> DataFrame:
    """Point lookup by one key: the records of a title, or of initials with volume, pages and year."""
    auth = initials_key(F.transform("authors", lambda a: a["name"]))
    if block == "title":
        found = title_key(F.col("title")) == title_key(F.lit(values["title"]))
    else:
        found = F.lit(True)
        for k, v in values.items():
            found = found & ((auth if k == "authors" else F.col(k)) == F.lit(v))
    return catalogue.where(found)


def drop_known(new: DataFrame, known: DataFrame, key: str = "doi") -> DataFrame:
    """Records whose key is not known yet; a null key passes."""
    return new.join(known.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def text_index(rows: DataFrame, id_col: str, *columns: str) -> DataFrame:
    """Inverted table of the words of some columns: ``token``, ``id``."""
    from quillgraph.functions.text import tokens

    text = F.concat_ws(" ", *columns)
    return rows.select(F.explode(tokens(text)).alias("token"), F.col(id_col).alias("id"))


def search(index: DataFrame, query: str, top: int = 3) -> DataFrame:
    """The rows that share most words with a query, ties by id: the offline stand-in for a search service."""
    words = sorted(set(query.lower().split()))
    return index.where(F.col("token").isin(words)).groupBy("id").agg(F.count("*").alias("hits")).orderBy(F.desc("hits"), "id").limit(top)
