"""Queries of the scalar functions, filters and projections over stand-ins, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph import schemas
from quillgraph.functions import ids, numbers, text
from quillgraph.operators import catalogue as cat
from quillgraph.operators import graph
from quillgraph.plans.standins import PUBLICATIONS_SQL, initials_sql, publications, structs, table
from quillgraph.sources import records, xml

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


@query("str03_title_key", r"select p_partkey as id, coalesce(nullif(regexp_replace(lower(t), '[^\p{L}]', '', 'g'), ''), t) as title_key from (select p_partkey, case when p_partkey % 10 = 0 then cast(p_partkey as varchar) else p_name || ' ' || p_brand end as t from part)")
def str03(spark: SparkSession, sf: str) -> DataFrame:
    t = F.when(F.col("p_partkey") % 10 == 0, F.col("p_partkey").cast("string")).otherwise(F.concat_ws(" ", "p_name", "p_brand"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), text.title_key(t).alias("title_key"))


@query("str05_initials_key", f"select p_partkey as id, {initials_sql('names')} as initials from (select p_partkey, [replace(p_name, ' ', '.'), p_type || ' ' || p_brand] as names from part)")
def str05(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(F.regexp_replace("p_name", " ", "."), F.concat_ws(" ", "p_type", "p_brand"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), text.initials_key(names).alias("initials"))


@query("str08_one_line", r"""with a as (select doc_id, array_to_string(list_filter(list_transform(string_split(replace(text, ', ', '-' || chr(10)), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), chr(10)) as t from documents),
    b as (select doc_id, regexp_replace(regexp_replace(t, '(\p{Ll})-\n(\p{Ll})', '\1\2', 'g'), '(\p{Ll})-\n(\p{Ll})', '\1\2', 'g') as t from a)
    select doc_id, md5(replace(t[1:1] || replace(t[2:], '-' || chr(10), '-'), chr(10), ' ')) as h from b""")
def str08(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.md5(text.one_line(F.regexp_replace("text", ", ", "-\n"))).alias("h"))


@query("str07_join_lines", "select doc_id, md5(replace(replace(text, '-' || chr(10), '-'), chr(10), ' ')) as h from documents")
def str07(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.md5(text.join_lines(F.split("text", "\n"))).alias("h"))


@query("str09_fragments", "select p_partkey as id, p_name || p_brand as joined from part")
def str09(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), text.fragments(F.array("p_name", "p_brand")).alias("joined"))


@query("str12_split_citations", "select doc_id, pos, md5(part) as h from (select doc_id, unnest(parts) as part, unnest(range(len(parts))) as pos from (select doc_id, list_filter(list_transform(string_split(replace(text, '.', ';'), ';'), lambda x: trim(x)), lambda x: x <> '') as parts from documents))")
def str12(spark: SparkSession, sf: str) -> DataFrame:
    parts = text.split_citations(F.regexp_replace("text", "\\.", ";"))
    return table(spark, sf, "documents").select("doc_id", F.posexplode(parts).alias("pos", "p")).select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.md5("p").alias("h"))


@query("str10_str13_labels", "select l_orderkey, l_linenumber, l_linenumber as label, p_name as rest from lineitem join part on l_partkey = p_partkey")
def labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    line = F.concat(F.lit("["), F.col("l_linenumber"), F.lit("] "), F.col("p_name"))
    return rows.select("l_orderkey", "l_linenumber", text.label_value(line).alias("label"), text.strip_label(line, r"^\[\d{1,4}]").alias("rest"))


@query("str14_before", "select page_id, split_part(url, '?', 1) as address, position('/' in url) as slash, contains(lower(url), 'page=2') as second from pages")
def before(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", text.before(F.col("url"), "?").alias("address"), F.locate("/", F.col("url")).cast("bigint").alias("slash"), F.contains(F.lower("url"), F.lit("page=2")).alias("second"))


@query("str15_composite_key", """select p_partkey as id, '{"auth":"' || p_brand || '","vol":"' || p_size || '","page":' || p_partkey || '}' as k from part""")
def composite(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), text.composite_key(auth=F.col("p_brand"), vol=F.col("p_size").cast("string"), page=F.col("p_partkey")).alias("k"))


@query("str16_flt07_md5", "select doc_id, md5(text) as md5sum, md5(text) = md5(trim(text)) as same from documents")
def md5(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.md5("text").alias("md5sum"), (F.md5("text") == F.md5(F.trim("text"))).alias("same"))


@query("num01_num03_pages", "select p_partkey as id, p_partkey + 1000 as first_page, p_partkey % 90 + 10 as last_page, cast(substr(cast(p_partkey + 1000 as varchar), 1, length(cast(p_partkey + 1000 as varchar)) - 2) || cast(p_partkey % 90 + 10 as varchar) as bigint) as full_last from part")
def pages(spark: SparkSession, sf: str) -> DataFrame:
    p = F.concat(F.lit("pp. "), F.col("p_partkey") + 1000, F.lit("--"), F.col("p_partkey") % 90 + 10)
    first, last = numbers.first_page(p), numbers.last_page(p)
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), first.cast("bigint").alias("first_page"), last.cast("bigint").alias("last_page"), numbers.expand_last_page(first, last).cast("bigint").alias("full_last"))


@query("num02_strict_int", r"select p_partkey as id, case when regexp_full_match(s, '[+-]?\d+') then cast(s as int) end as n from (select p_partkey, case p_partkey % 5 when 0 then ' 12 ' when 1 then '12.7' when 2 then 'x' when 3 then '-7' else cast(p_partkey as varchar) end as s from part)")
def strict(spark: SparkSession, sf: str) -> DataFrame:
    s = F.expr("case p_partkey % 5 when 0 then ' 12 ' when 1 then '12.7' when 2 then 'x' when 3 then '-7' else cast(p_partkey as string) end")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), numbers.strict_int(s).alias("n"))


@query("num07_progress", "select o_orderstatus as k, round(count(*) * 100.0 / (select count(*) from orders), 2) as percent from orders group by 1")
def progress(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("k")).agg(F.count("*").alias("n"))
    return n.crossJoin(n.agg(F.sum("n").alias("all"))).select("k", numbers.progress(F.col("n"), F.col("all")).cast("double").alias("percent"))  # one row


@query("dtm01_parse_year", r"select doc_id, try_cast(nullif(regexp_extract(text, '(19|20)\d\d', 0), '') as int) as year from documents")
def year(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", numbers.parse_year(F.col("text")).alias("year"))


@query("dtm02_dtm03_flt05_grace", "select o_orderkey, cast(cast(o_orderdate as date) as varchar) as created, date_diff('day', cast(o_orderdate as date), date '1998-01-01') < 7 as recent from orders")
def grace(spark: SparkSession, sf: str) -> DataFrame:
    d = numbers.iso_date(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf, "orders").select("o_orderkey", d.cast("string").alias("created"), numbers.within_grace(F.lit(None).cast("date"), d, F.lit("1998-01-01").cast("date")).alias("recent"))


_RAW = "case o_orderkey % 9 when 0 then 'see arXiv:' || lpad(cast(o_orderkey % 10000 as varchar), 4, '0') || '.12345v2' when 1 then 'J. X hep-th/' || lpad(cast(o_orderkey as varchar), 7, '0') || ' y' when 2 then 'physics/' || lpad(cast(o_orderkey as varchar), 7, '0') when 3 then 'alg-geom/' || lpad(cast(o_orderkey as varchar), 7, '0') when 4 then 'math.AG/' || lpad(cast(o_orderkey as varchar), 7, '0') when 5 then 'ARXIV: none (1999) (2001)' when 6 then 'arXiv:hep-ph/' || lpad(cast(o_orderkey as varchar), 7, '0') || 'v1' when 7 then 'arxiv:12' else o_orderpriority end"


@query("str04_flt08_flt09_ids", f"""with r as (select o_orderkey, o_orderkey % 9 as c, {_RAW} as raw from orders) select o_orderkey, raw,
    case c when 0 then lpad(cast(o_orderkey % 10000 as varchar), 4, '0') || '.12345' when 1 then 'hep-th/' || lpad(cast(o_orderkey as varchar), 7, '0') when 2 then 'physics/' || lpad(cast(o_orderkey as varchar), 7, '0')
      when 3 then 'alg-geom/' || lpad(cast(o_orderkey as varchar), 7, '0') when 4 then 'math/' || lpad(cast(o_orderkey as varchar), 7, '0') when 6 then 'hep-ph/' || lpad(cast(o_orderkey as varchar), 7, '0') else '' end as arxiv_id,
    c in (0, 1, 2, 3, 5, 6, 7) as has_id, c in (2, 3) as several from r""")
def arxiv_ids(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr(_RAW.replace("varchar", "string"))
    rows = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return rows.withColumns({"arxiv_id": ids.arxiv_id(F.col("raw")), "has_id": ids.contains_id(F.col("raw")), "several": ids.contains_multiple_ids(F.col("raw"))})


@query("flt10_years_in_brackets", r"select o_orderkey, len(regexp_extract_all(s, '\((19|20)\d\d\)')) > 1 as reject from (select o_orderkey, '(' || year(o_orderdate) || ') x ' || case when o_orderkey % 2 = 0 then '(1999)' else '1999' end as s from orders)")
def weak(spark: SparkSession, sf: str) -> DataFrame:
    s = F.concat(F.lit("("), F.year("o_orderdate"), F.lit(") x "), F.when(F.col("o_orderkey") % 2 == 0, "(1999)").otherwise("1999"))
    return table(spark, sf, "orders").select("o_orderkey", (F.regexp_count(s, F.lit(r"\((19|20)\d\d\)")) > 1).alias("reject"))


@query("prj13_id_from_filename", "select o_orderkey, case when o_orderkey % 2 = 0 then 'hep-th/' || lpad(cast(o_orderkey as varchar), 7, '0') else lpad(cast(o_orderkey as varchar), 4, '0') || '.pdf' end as id from orders")
def filename(spark: SparkSession, sf: str) -> DataFrame:
    name = F.expr("case when o_orderkey % 2 = 0 then concat('a/hep-th', lpad(cast(o_orderkey as string), 7, '0'), '.pdf') else concat('b/', lpad(cast(o_orderkey as string), 4, '0'), '.pdf') end")
    return table(spark, sf, "orders").select("o_orderkey", ids.id_from_filename(name).alias("id"))


@query("jsn01_jsn03_props", """select event_id, cast(json_extract(props, '$.k') as bigint) as k, '{"k":' || cast(json_extract(props, '$.k') as varchar) || '}' as again, cast(json_extract(props, '$.k') as bigint) + user_id as total from events""")
def props(spark: SparkSession, sf: str) -> DataFrame:
    p = F.from_json("props", "k bigint")
    listed = F.from_json(F.concat(F.lit("["), p["k"], F.lit(","), F.col("user_id"), F.lit("]")), "array<bigint>")
    return table(spark, sf, "events").select("event_id", p["k"].alias("k"), F.to_json(p).alias("again"), F.aggregate(listed, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@query("flt02_categories", r"select p_partkey as id, array_to_string(list_filter([p_name, p_brand, ' ', p_type], lambda c: trim(c) <> '' and not regexp_matches(c, '\d')), ',') as kept from part")
def kept_categories(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.array_join(xml.categories(F.array("p_name", "p_brand", F.lit(" "), "p_type")), ",").alias("kept"))


_XML = """concat('<record><header><identifier>oai:', p_partkey, '</identifier><datestamp>2020-01-01</datestamp></header><metadata><arXiv><id>', lpad(cast(p_partkey as string), 9, '0'), '</id>', if(p_partkey % 4 = 0, '', '<created>2019-12-31</created>'),
    '<authors><author><keyname>', p_brand, '</keyname>', if(p_partkey % 2 = 0, concat('<forenames>', p_name, '</forenames>'), ''), if(p_partkey % 3 = 0, '<suffix>Jr</suffix>', ''), '</author></authors><title>', p_type, '</title><categories>math cs</categories><abstract>a\n b</abstract></arXiv></metadata></record>')"""


@query("src05_flt01_prj01_oai", """select 'oai:' || p_partkey as identifier, lpad(cast(p_partkey as varchar), 9, '0') as id, case when p_partkey % 2 = 0 then p_name || ' ' else '' end || p_brand || case when p_partkey % 3 = 0 then ' Jr' else '' end as author,
    p_type as title, 'a b' as abstract, 2 as n_categories from part where p_partkey % 4 <> 0""")
def oai(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select(F.from_xml(F.expr(_XML), " ".join(schemas.OAI_RECORD.split())).alias("r")).select("r.*")
    return xml.parse_oai(rows).select("identifier", "id", F.get("authors", F.lit(0))["name"].alias("author"), "title", "abstract", F.size("categories").alias("n_categories"))


@query("src01_page_records", """select 'k' || p_partkey as id, p_name as title, 'A ' || p_brand as author, case when p_partkey % 3 <> 0 then 'http://x/' || p_partkey end as pdf_url from part where p_partkey % 7 <> 0""")
def page_records(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of fifty parts each to records with their links; every seventh lacks its creation date."""
    from quillgraph.sources.xml import page_records as parsed
    from quillgraph.sources.xml import with_pdf_links

    p = table(spark, sf, "part")
    created = "if(p_partkey % 7 = 0, '', '<created>2001-02-03</created>')"
    record = f"""concat('<record><header><identifier>i', p_partkey, '</identifier><datestamp>2020-01-01</datestamp></header><metadata><arXiv><id>k', p_partkey, '</id>', {created}, '<title>', p_name,
        '</title><abstract>a</abstract><authors><author><keyname>', p_brand, '</keyname><forenames>A</forenames></author></authors></arXiv></metadata></record>')"""
    pages = p.groupBy(F.floor(F.col("p_partkey") / 50).alias("n")).agg(F.concat_ws("\n", F.lit("<OAI-PMH><ListRecords>"), F.collect_list(F.expr(record)), F.lit("</ListRecords></OAI-PMH>")).alias("page"))
    links = p.select(F.concat(F.lit("k"), "p_partkey").alias("id"), F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.concat(F.lit("http://x/"), "p_partkey")).alias("url"))
    return with_pdf_links(parsed(pages), links).select("id", "title", F.col("authors")[0]["name"].alias("author"), "pdf_url")


@query("src06_src07_links", "select p_partkey as id, case when p_partkey % 3 = 0 then '' else 'http://x/' || p_partkey end as url from part union all select p_partkey, 'http://y' from part where p_partkey % 3 = 1")
def links(spark: SparkSession, sf: str) -> DataFrame:
    kind = "array<struct<_title:string,_href:string>>"
    made = F.expr(f"cast(if(p_partkey % 3 = 0, array(struct('doi', 'http://z')), if(p_partkey % 3 = 1, array(struct('pdf', concat('http://x/', p_partkey)), struct('pdf', 'http://y')), array(struct('pdf', concat('http://x/', p_partkey))))) as {kind})")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.explode(xml.pdf_links(made)).alias("url"))


_DUMP = """concat('{"DOI":"10.1/', p_partkey, '","author":[{"family":"', p_brand, '"', if(p_partkey % 2 = 0, ',"given":"G"', ''), '}],"container-title":["', p_type, '"],', if(p_partkey % 3 = 0, '"short-container-title":["S"],', ''), '"issued":{"date-parts":[[', 1990 + p_partkey % 20, ',5]]},"page":"', p_partkey, '-', p_partkey + 9, '","title":["', p_name, '"],"volume":"', p_size, '"}')"""


@query("src11_src12_prj03_dump", """select p_partkey as first_page, p_partkey + 9 as last_page, '10.1/' || p_partkey as doi, case when p_partkey % 2 = 0 then 'G ' else 'null ' end || p_brand as author, case when p_partkey % 3 = 0 then 'S' else p_type end as journal,
    cast(1990 + p_partkey % 20 as int) as year, p_name as title, cast(p_size as varchar) as volume from part""")
def dump(spark: SparkSession, sf: str) -> DataFrame:
    out = records.parse_dump(table(spark, sf, "part").select(F.expr(_DUMP).alias("value")))
    return out.select(F.col("first_page").cast("bigint").alias("first_page"), F.col("last_page").cast("bigint").alias("last_page"), "doi", F.get("authors", F.lit(0))["name"].alias("author"), "journal", "year", "title", "volume")


_HITS = """concat('{"message":{"items":[', array_join(transform(sequence(0, 4), i -> concat('{"DOI":"10.1/', p_partkey, '.', i, '","title":["', p_name, '"],"author":[{"family":"F","given":"', p_brand, '"}],"container-title":["', p_type, '"],"page":"', p_partkey, '-', p_partkey + 3, '","issued":{"date-parts":[[2001,5,1]]},"link":[{"URL":"u"}]}')), ','), ']}}')"""


@query("src10_prj02_srt07_hits", "select p_partkey as id, cast(i as int) as rank, '10.1/' || p_partkey || '.' || i as doi, 'F ' || p_brand as author, p_type as journal, p_partkey as first_page, p_partkey + 3 as last_page, 2001 as year from part, range(3) t(i)")
def hits(spark: SparkSession, sf: str) -> DataFrame:
    out = records.parse_hits(table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.expr(_HITS).alias("value")))
    return out.select("id", "rank", F.col("h_doi").alias("doi"), F.get("h_authors", F.lit(0))["name"].alias("author"), F.col("h_full_title").alias("journal"), F.col("h_first_page").cast("bigint").alias("first_page"), F.col("h_last_page").cast("bigint").alias("last_page"), F.col("h_year").alias("year"))


@query("prj04_flt03_flt04_clean", r"""select p_partkey as id, cast(p_partkey + 1200 as int) as first_page, cast(cast(p_partkey + 1200 as varchar)[1:length(cast(p_partkey + 1200 as varchar)) - 2] || '56' as int) as last_page, cast(p_size as varchar) as volume, case when p_partkey % 2 = 0 then '7' end as issue,
    replace(p_name, ' ', ' ') as title from part where p_partkey % 5 not in (0, 1) and p_partkey % 7 <> 0""")
def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        k.alias("id"), F.concat(k + 1200, F.lit(" - 56")).alias("pages"), F.expr("case p_partkey % 5 when 0 then ' ' when 1 then 'x [Not Available].' else replace(p_name, ' ', '\n') end").alias("title"),
        F.concat(F.col("p_size"), F.when(k % 2 == 0, " 7").otherwise("")).alias("volume"), F.lit(None).cast("string").alias("issue"), F.lit(None).cast("int").alias("first_page"), F.lit(None).cast("int").alias("last_page"),
        F.when(k % 7 != 0, F.concat(F.lit("10.1/"), k)).alias("doi"),
    )
    return cat.clean_dump(rows, need_doi=True).select("id", "first_page", "last_page", "volume", "issue", "title")


@query("prj05_prj06_views", "select p_partkey as id, p_name as title, cast(p_size as varchar) as volume, case when trim(case when p_partkey % 2 = 0 then ' ' else p_type end) = '' then p_brand else p_type end as journal from part")
def views(spark: SparkSession, sf: str) -> DataFrame:
    full = F.when(F.col("p_partkey") % 2 == 0, " ").otherwise(F.col("p_type"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_size").cast("string").alias("volume"), F.coalesce(text.null_if_blank(full), "p_brand").alias("journal"))


@query("prj10_properties", f"with {PUBLICATIONS_SQL} select id as arxiv_id, nullif(trim(title), '') as title, doi, cast(created as varchar) as created, cast(updated as varchar) as updated, cast(year(created) as int) as pub_year from pubs")
def properties(spark: SparkSession, sf: str) -> DataFrame:
    return graph.publication_properties(publications(spark, sf)).select("arxiv_id", "title", "doi", F.col("created").cast("string").alias("created"), F.col("updated").cast("string").alias("updated"), "pub_year")


@query("prj14_report", "select p_partkey as id, 'title: ' || p_name || chr(10) || case when p_partkey % 2 = 0 then 'journal: ' || p_brand || chr(10) else '' end || 'volume: ' || p_size as report from part")
def report(spark: SparkSession, sf: str) -> DataFrame:
    field = lambda k, c: F.concat(F.lit(f"{k}: "), c)  # noqa: E731 - null for a null field, which concat_ws leaves out
    journal = F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.concat_ws("\n", field("title", F.col("p_name")), field("journal", journal), field("volume", F.col("p_size"))).alias("report"))


@query("arr_functions", "select p_partkey as id, array_to_string(list_reverse([p_name, p_brand, p_type]), '|') as reversed, p_name as first, case when p_partkey % 2 = 0 then p_brand end as second, len(list_filter([p_name, p_brand], lambda x: x like '%a%')) as n from part")
def arrays(spark: SparkSession, sf: str) -> DataFrame:
    one = F.when(F.col("p_partkey") % 2 == 0, F.array("p_name", "p_brand")).otherwise(F.array("p_name"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.array_join(F.reverse(F.array("p_name", "p_brand", "p_type")), "|").alias("reversed"), F.get(one, F.lit(0)).alias("first"), F.get(one, F.lit(1)).alias("second"), F.size(F.filter(F.array("p_name", "p_brand"), lambda x: x.like("%a%"))).cast("bigint").alias("n"))


@query("xml01_page_titles", r"select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, len(regexp_extract_all(html, '<a href=')) as n_links from pages")
def page_titles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<a href=")).cast("bigint").alias("n_links"))


@query("txt01_text_index", r"select distinct unnest(list_filter(regexp_split_to_array(lower(p_name || ' ' || p_type), '[^\p{L}\p{N}]+'), lambda w: w <> '')) as token, p_partkey as id from part")
def text_index(spark: SparkSession, sf: str) -> DataFrame:
    return cat.text_index(table(spark, sf, "part"), "p_partkey", "p_name", "p_type")


@query("src09_offline_search", r"select id, cast(count(*) as bigint) as hits from (select distinct unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')) as token, item_id as id from benchmark) where token in ('the', 'that', 'and', 'onon', 'ble') group by id order by hits desc, id limit 3")
def search(spark: SparkSession, sf: str) -> DataFrame:
    return cat.search(cat.text_index(table(spark, sf, "benchmark"), "item_id", "text"), "the that and onon ble")


@query("prj12_journal", "select p_partkey as id, p_type || ' J.' as title, cast(p_size as varchar) as volume, case when p_partkey % 2 = 0 then cast(p_partkey % 9 as varchar) end as number, cast(100 + p_partkey as int) as first_page, case when p_partkey % 3 <> 0 then cast(110 + p_partkey as int) end as last_page, cast(1950 + p_partkey % 70 as int) as year from part")
def journals(spark: SparkSession, sf: str) -> DataFrame:
    from quillgraph.functions.journal import parse_journal

    k = F.col("p_partkey")
    raw = F.concat("p_type", F.lit(" J. "), "p_size", F.when(k % 2 == 0, F.concat(F.lit(", no. "), k % 9)).otherwise(""), F.lit(", "), k + 100, F.when(k % 3 != 0, F.concat(F.lit("-"), k + 110)).otherwise(""), F.lit(" ("), k % 70 + 1950, F.lit(")"))
    return table(spark, sf, "part").select(k.alias("id"), parse_journal(raw).alias("j")).select("id", "j.*")


@query("src08_flt07_changed", "select doc_id from documents where doc_id % 3 <> 0")
def changed(spark: SparkSession, sf: str) -> DataFrame:
    """Files to fetch: a third is here and intact, a third has another checksum, a third is missing."""
    d = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("src/f_"), "doc_id").alias("filename"), F.md5("text").alias("md5sum"), F.col("text").cast("binary").alias("content"))
    manifest = d.select("doc_id", "filename", F.when(F.col("doc_id") % 3 == 1, F.md5("md5sum")).otherwise(F.col("md5sum")).alias("md5sum"))
    files = d.where("doc_id % 3 <> 2").select(F.concat(F.lit("/data/"), "filename").alias("path"), "content")
    return xml.changed(manifest, files).select("doc_id")


@query("src04_id_batches", "select o_custkey % 100 as batch, string_agg(cast(o_orderkey as varchar), ',' order by o_orderkey) as ids from orders group by 1")
def id_batches(spark: SparkSession, sf: str) -> DataFrame:
    by = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 100).alias("batch"))
    return by.agg(F.array_join(F.transform(F.sort_array(F.collect_list("o_orderkey")), lambda x: x.cast("string")), ",").alias("ids"))


@query("src13_src14_jsn02_records", "select p_partkey as id, p_name as title, cast(p_size as int) as first_page, p_brand as author, cast(null as varchar) as doi from part")
def open_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue rows written as JSON lines and parsed again."""
    rows = table(spark, sf, "part").select(F.to_json(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_size").alias("first_page"), structs(F.col("p_brand")).alias("authors"), F.lit("x").alias("unknown"))).alias("value"))
    parsed = rows.select(F.from_json("value", schemas.CATALOGUE).alias("r")).select("r.*")
    return parsed.select("id", "title", "first_page", F.get("authors", F.lit(0))["name"].alias("author"), "doi")


@query("srt01_srt03_sorted_keys", "select doi, id from (select case when p_partkey % 4 <> 0 then '10.1/' || p_partkey end as doi, p_partkey as id from part)")
def sorted_dois(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.when(F.col("p_partkey") % 4 != 0, F.concat(F.lit("10.1/"), "p_partkey")).alias("doi"), F.col("p_partkey").alias("id")).sort(F.asc_nulls_first("doi"))
