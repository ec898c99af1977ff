"""Stand-ins: the engine's tables made from the test tables, which hold no citations, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def structs(*names) -> F.Column:
    return F.array(*[F.struct(n.alias("name")) for n in names])


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Known publications: one for each part. Pages and volumes make keys with few and with many records."""
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(
        k.alias("id"), structs(F.regexp_replace("p_name", " ", "."), F.concat_ws(" ", "p_type", "p_brand")).alias("authors"), F.lit(None).cast("string").alias("pmid"), F.concat(F.lit("10.1/"), k).alias("doi"),
        F.lit(None).cast("string").alias("ssid"), F.col("p_brand").alias("journal"), F.lit(None).cast("string").alias("pages"), F.col("p_size").cast("string").alias("volume"), F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("title"),
        (1990 + k % 9).cast("int").alias("year"), (k % 7).cast("int").alias("first_page"), (k % 7 + 5).cast("int").alias("last_page"), (k % 3).cast("string").alias("issue"), F.array().cast("array<string>").alias("pdf_urls"),
    )


#: The same in SQL, for the oracles.
CATALOGUE_SQL = """cat as (select p_partkey as id, [replace(p_name, ' ', '.'), p_type || ' ' || p_brand] as names, '10.1/' || p_partkey as doi, p_brand as journal,
    cast(p_size as varchar) as volume, p_name || ' ' || p_brand || ' ' || p_type as title, cast(1990 + p_partkey % 9 as int) as year, cast(p_partkey % 7 as int) as first_page,
    cast(p_partkey % 7 + 5 as int) as last_page, cast(p_partkey % 3 as varchar) as issue from part)"""

_ORDER = "l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


def references(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """Citations: one for each line item, of the part it names; some fields are off or missing. ``more``: columns kept."""
    k, n = F.col("l_partkey"), F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").selectExpr("*", f"cast(row_number() over (partition by l_orderkey order by {_ORDER}) as int) as pos")
    rows = rows.join(table(spark, sf, "part").hint("merge"), k == F.col("p_partkey"))
    none = F.lit(None).cast("string")
    names = structs(F.regexp_replace("p_name", " ", "."), F.concat_ws(" ", "p_type", "p_brand"))
    return rows.select(
        F.col("l_orderkey").cast("string").alias("pub_id"), "pos", F.concat_ws(", ", "p_name", F.concat_ws(" ", "p_type", "p_brand"), F.concat_ws(" ", "p_name", "p_brand", "p_type"), F.col("p_size").cast("string"), (k % 7).cast("string")).alias("raw"),
        none.alias("arxiv_id"), F.when(n % 2 == 0, F.concat(F.lit("10.1/"), k)).alias("doi"), F.transform(F.when(n % 5 == 0, F.slice(names, 1, 1)).otherwise(names), lambda a: F.struct(a["name"].alias("name"), none.alias("affiliation"))).alias("authors"),
        F.when(n % 3 != 0, F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("title"), none.alias("journal"), none.alias("issue"), F.when(n % 4 != 0, (k % 7).cast("int")).alias("first_page"), (k % 7 + 5).cast("int").alias("last_page"),
        F.col("p_size").cast("string").alias("volume"), (1990 + k % 9 + (n % 3 == 1).cast("int")).cast("int").alias("year"), none.alias("issn"), none.alias("pmid"), none.alias("ssid"), F.array().cast("array<string>").alias("urls"),
        F.lit(True).alias("is_reference"), (n % 4 == 1).alias("validated"), *more,
    )


REFERENCES_SQL = f"""refs as (select cast(l_orderkey as varchar) as pub_id, cast(pos as int) as pos, p_name || ', ' || p_type || ' ' || p_brand || ', ' || p_name || ' ' || p_brand || ' ' || p_type || ', ' || p_size || ', ' || (l_partkey % 7) as raw,
    case when l_linenumber % 2 = 0 then '10.1/' || l_partkey end as doi, case when l_linenumber % 5 = 0 then [replace(p_name, ' ', '.')] else [replace(p_name, ' ', '.'), p_type || ' ' || p_brand] end as names,
    case when l_linenumber % 3 <> 0 then p_name || ' ' || p_brand || ' ' || p_type end as title, case when l_linenumber % 4 <> 0 then cast(l_partkey % 7 as int) end as first_page, cast(l_partkey % 7 + 5 as int) as last_page,
    cast(p_size as varchar) as volume, cast(1990 + l_partkey % 9 + case when l_linenumber % 3 = 1 then 1 else 0 end as int) as year, l_linenumber % 4 = 1 as validated, l_partkey
    from (select *, row_number() over (partition by l_orderkey order by {_ORDER}) as pos from lineitem) join part on l_partkey = p_partkey)"""


def initials_sql(names: str) -> str:
    return f"array_to_string(list_transform({names}, lambda n: array_to_string(list_transform(list_sort(list_filter(regexp_split_to_array(n, '[\\s.]'), lambda w: w <> '')), lambda w: w[1:1]), '')), ',')"


def publications(spark: SparkSession, sf: str) -> DataFrame:
    """Publications of the graph: one for each order, by its customer, whose nation is the affiliation."""
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    k = F.col("o_orderkey")
    affiliation = F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, F.lit(" ")).otherwise(F.col("n_name"))
    return rows.select(
        k.cast("string").alias("id"), F.array(F.struct(F.col("c_name").alias("name"), affiliation.alias("affiliation"))).alias("authors"), F.when(k % 3 == 0, F.lit("  ")).otherwise(F.concat(F.lit("order "), k)).alias("title"),
        F.when(k % 2 == 0, F.concat(F.lit("10.1/"), k)).alias("doi"), F.col("o_orderpriority").alias("journal"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("created"), F.when(k % 4 == 0, F.date_format(F.date_add("o_orderdate", 30), "yyyy-MM-dd")).alias("updated"),
        F.lit("").alias("msc_class"), F.lit(None).cast("string").alias("acm_class"), F.lit(None).cast("string").alias("pdf_url"), F.col("o_orderstatus").alias("abstract"), F.array("o_orderstatus").alias("categories"),
    )


PUBLICATIONS_SQL = """pubs as (select cast(o_orderkey as varchar) as id, c_name as author, case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 then ' ' else n_name end as affiliation,
    case when o_orderkey % 3 = 0 then '  ' else 'order ' || o_orderkey end as title, case when o_orderkey % 2 = 0 then '10.1/' || o_orderkey end as doi, o_orderpriority as journal,
    cast(o_orderdate as date) as created, case when o_orderkey % 4 = 0 then cast(o_orderdate as date) + 30 end as updated, o_orderstatus as abstract
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""


def conversation_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Positioned lines: a conversation is a document, its turns are lines; every third turn is a page mark."""
    t = F.col("turn")
    return table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("doc_id"), t.cast("int").alias("line_no"), F.when(t % 3 == 0, -1).when(t % 3 == 2, -2).otherwise(F.length("text") % 50).cast("int").alias("indent"),
        (F.length("text") % 900).cast("int").alias("last_pos"), F.when(t % 3 == 1, F.when(F.length("text") % 2 == 0, F.length("text").cast("string")).otherwise(F.col("text"))).otherwise("@").alias("str"),
    )


LINES_SQL = """lines as (select cast(conv_id as varchar) as doc_id, cast(turn as int) as line_no, cast(case turn % 3 when 0 then -1 when 2 then -2 else length(text) % 50 end as int) as indent,
    cast(length(text) % 900 as int) as last_pos, case when turn % 3 = 1 then case when length(text) % 2 = 0 then cast(length(text) as varchar) else text end else '@' end as str from conversations)"""
