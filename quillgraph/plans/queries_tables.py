"""Queries of joins, aggregations, ordered lines, the graph and incremental loads over stand-ins, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillgraph.functions import similarity as sim
from quillgraph.functions.numbers import parse_year
from quillgraph.operators import catalogue as cat
from quillgraph.operators import graph, lines, report, resolve, segment
from quillgraph.plans.pipelines import references as as_references
from quillgraph.plans.pipelines import harvest, validators
from quillgraph.plans.standins import CATALOGUE_SQL, LINES_SQL, PUBLICATIONS_SQL, REFERENCES_SQL, catalogue, conversation_lines, initials_sql, publications, references, table
from quillgraph.streaming import incremental

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


# Blocking joins.

_A = initials_sql("names")
_TITLE = r"coalesce(nullif(regexp_replace(lower(title), '[^\p{L}]', '', 'g'), ''), title)"
_BLOCKS = {
    "jn01_title": (0, [_TITLE], "title is not null", "title is not null"),
    "jn02_author_volume_page_year": (1, [_A, "volume", "first_page", "year"], "first_page is not null", "len(names) >= 1"),
    "jn05_author_pages_volume": (2, [_A, "first_page", "last_page", "volume"], "first_page is not null and len(names) >= 2", "len(names) >= 1"),
    "jn03_author_volume_year": (3, [_A, "volume", "year"], "len(names) >= 2", "len(names) >= 2"),
    "jn04_author_page_year": (4, [_A, "first_page", "year"], "first_page is not null and len(names) >= 2", "len(names) >= 2"),
}


def _block_sql(name: str) -> str:
    _, keys, probe, build = _BLOCKS[name]
    key = ", ".join(f"{k} as k{i}" for i, k in enumerate(keys))
    on = ", ".join(f"k{i}" for i in range(len(keys)))
    return f"(select pub_id, pos, id from (select pub_id, pos, {key} from refs where {probe}) join (select id, {on} from (select id, {key}, count(*) over (partition by {', '.join(keys)}) as n from cat where {build}) where n < 10) using ({on}))"


def _block_query(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rank = _BLOCKS[name][0]
        probes = cat.blocking_keys(references(spark, sf), probe=True).where(F.col("block") == rank).select("pub_id", "pos", "block", "key")
        return probes.join(cat.postings(catalogue(spark, sf)), ["block", "key"]).select("pub_id", "pos", "id")

    return run


for _name in _BLOCKS:
    query(_name, f"with {CATALOGUE_SQL}, {REFERENCES_SQL} select pub_id, pos, id from {_block_sql(_name)}")(_block_query(_name))

_UNION = " union all ".join(f"select *, {_BLOCKS[n][0]} as block from {_block_sql(n)}" for n in _BLOCKS)


@query("set01_jn06_candidates", f"with {CATALOGUE_SQL}, {REFERENCES_SQL} select pub_id, pos, id, cast(min(block) as int) as block from ({_UNION}) group by all")
def candidates(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.candidates(references(spark, sf), catalogue(spark, sf))


@query("win12_first_candidate", f"with {CATALOGUE_SQL}, {REFERENCES_SQL} select pub_id, pos, id from (select *, row_number() over (partition by pub_id, pos order by block, id) as n from ({_UNION})) where n = 1")
def first_candidate(spark: SparkSession, sf: str) -> DataFrame:
    met = resolve.candidates(references(spark, sf), catalogue(spark, sf))
    return met.withColumn("n", F.row_number().over(W.partitionBy("pub_id", "pos").orderBy("block", "id"))).where("n = 1").select("pub_id", "pos", "id")


@query("num04_cheap_score", f"""with {CATALOGUE_SQL}, {REFERENCES_SQL}, met as (select pub_id, pos, id from ({_UNION}) group by all)
    select pub_id, pos, id, 4 - case when c.year <> r.year then 1 else 0 end - case when c.volume <> r.volume then 1 else 0 end - case when r.first_page is null or c.first_page <> r.first_page then 1 else 0 end as score
    from met join refs r using (pub_id, pos) join cat c using (id) where abs(c.year - r.year) <= 1""")
def cheap(spark: SparkSession, sf: str) -> DataFrame:
    refs, known = references(spark, sf), catalogue(spark, sf)
    known = known.select(*[F.col(c).alias(f"c_{c}") for c in known.columns])
    pairs = resolve.candidates(refs, catalogue(spark, sf)).join(known, F.col("id") == F.col("c_id")).join(refs, ["pub_id", "pos"])
    ref = {k: F.col(k) for k in ("year", "volume", "first_page")}
    return pairs.select("pub_id", "pos", "id", sim.cheap_score(ref, {k: F.col(f"c_{k}") for k in ref}).alias("score")).where("score is not null")


#: The whole resolution in SQL: the subsequence lengths by bit vectors, a letter of the text at a time.
_RESOLVED = f"""{CATALOGUE_SQL}, {REFERENCES_SQL}, met as (select pub_id, pos, id, min(block) as block from ({_UNION}) group by all),
    known as (select c.*, p_brand, case when length(p_type) >= length(p_brand) then p_type else p_brand end as longest, names[1] as single from cat c join part on id = p_partkey),
    pairs as (select pub_id, pos, id, block, raw, k.single, k.longest, k.journal, k.title,
        4 - case when k.year <> r.year then 1 else 0 end - case when k.volume <> r.volume then 1 else 0 end - case when r.first_page is null or k.first_page <> r.first_page then 1 else 0 end as cheap,
        case when k.last_page = r.last_page then 1 else 0 end + case when contains(raw, cast(k.first_page as varchar)) then 1 else 0 end as extra
        from met join refs r using (pub_id, pos) join known k using (id) where abs(k.year - r.year) <= 1),
    wanted as (select distinct raw, p from (select raw, unnest([single, longest, journal, title]) as p from pairs where cheap >= 2)),
    steps as (select raw, p, 0 as i, (cast(1 as bigint) << length(p)) - 1 as v from wanted union all
        select raw, p, i + 1, ((v + (v & m)) | (v - (v & m))) & ((cast(1 as bigint) << length(p)) - 1) from (select *, cast(list_sum(list_transform(range(1, length(p) + 1), lambda j: case when p[j:j] = raw[i + 1:i + 1] then cast(1 as bigint) << (j - 1) else 0 end)) as bigint) as m from steps where i < length(raw))),
    common as (select raw, p, length(p) as len, length(p) - bit_count(v) as n from steps where i = length(raw)),
    scored as (select pub_id, pos, id, block, cheap - case when s.n + 1 >= s.len and l.n + 1 >= l.len then 0 else 2 end as score, extra + case when j.n / j.len > 0.8 then 1 else 0 end + case when t.n / t.len > 0.9 then 2 else 0 end as more
        from pairs q join common s on s.raw = q.raw and s.p = single join common l on l.raw = q.raw and l.p = longest join common j on j.raw = q.raw and j.p = journal join common t on t.raw = q.raw and t.p = q.title where cheap >= 2),
    best as (select pub_id, pos, arg_min(id, cast(block as bigint) * 1000000000000 + id) as id from scored where score >= 2 and score + more >= 4 group by all),
    resolved as (select r.pub_id, r.pos, r.raw, b.id is not null as ok, case when b.id is null then r.doi else k.doi end as doi, case when b.id is null then r.title else k.title end as title, k.journal, case when b.id is null then r.volume else k.volume end as volume,
        case when b.id is null then r.year else k.year end as year, case when b.id is null then r.first_page else k.first_page end as first_page, case when b.id is null then r.last_page else k.last_page end as last_page, k.issue,
        r.validated or b.id is not null as validated, true as is_reference, case when b.id is null then len(r.names) else 2 end as n_authors from refs r left join best b using (pub_id, pos) left join known k on k.id = b.id)"""


@query("flagship_resolve", f"with recursive {_RESOLVED} select pub_id, pos, raw, doi, title, journal, volume, year, first_page, last_page, issue, validated, is_reference from resolved")
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Resolve all citations against the catalogue."""
    return resolve.resolve(references(spark, sf), catalogue(spark, sf)).select("pub_id", "pos", "raw", "doi", "title", "journal", "volume", "year", "first_page", "last_page", "issue", "validated", "is_reference")


@query("udf04_resolve_with_shortcut")
def shortcut(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.resolve_with_shortcut(references(spark, sf), catalogue(spark, sf)).select("pub_id", "pos", "doi", "title", "volume", "year", "validated")


#: Every second citation names an identifier.
_WITH_ID = "case when pos % 2 = 0 then 'hep-th/' || lpad(cast(pos as varchar), 7, '9') else '' end"


def _with_ids(refs: DataFrame) -> DataFrame:
    return refs.withColumn("raw", F.when(F.col("pos") % 2 == 0, F.concat("raw", F.lit(", HEP hep-th/"), F.lpad(F.col("pos").cast("string"), 7, "9"))).otherwise(F.col("raw")))


#: The same over citations of which every second names an identifier.
_RESOLVED_WITH_IDS = _RESOLVED.replace(REFERENCES_SQL, f"""plain_{REFERENCES_SQL}, refs as (select * replace (case when pos % 2 = 0 then raw || ', HEP hep-th/' || lpad(cast(pos as varchar), 7, '9') else raw end as raw) from plain_refs)""")


@query("udf03_validator_chain", f"with recursive {_RESOLVED_WITH_IDS} select pub_id, pos, doi, {_WITH_ID} as arxiv_id, validated or pos % 2 = 0 as validated, cast(case when pos % 2 = 0 and not validated then 0 else n_authors end as int) as n_authors from resolved")
def chain(spark: SparkSession, sf: str) -> DataFrame:
    refs = _with_ids(references(spark, sf))
    for v in validators("la", catalogue(spark, sf)):
        refs = refs.transform(v)
    return refs.select("pub_id", "pos", "doi", "arxiv_id", "validated", F.size("authors").alias("n_authors"))


@query("prj07_prj09_accept", f"with {REFERENCES_SQL} select pub_id, pos, {_WITH_ID} as arxiv_id, validated or pos % 2 = 0 as validated, cast(case when pos % 2 = 0 and not validated then 0 else len(names) end as int) as n_authors from refs")
def ids_only(spark: SparkSession, sf: str) -> DataFrame:
    out = resolve.validate_ids(_with_ids(references(spark, sf)))
    return out.select("pub_id", "pos", "arxiv_id", "validated", F.size("authors").alias("n_authors"))


@query("udf05_jn15_hits")
def hits(spark: SparkSession, sf: str) -> DataFrame:
    """Three hits for each citation: another part, the part it names, and a third one without pages."""
    refs, known = references(spark, sf, "l_partkey"), catalogue(spark, sf)
    n = known.count()
    places = F.array(*[F.struct(F.lit(rank).alias("rank"), F.lit(step).alias("step")) for rank, step in enumerate((1, 0, 2))])
    h = known.withColumn("_p", F.explode(places)).withColumns({c: F.when(F.col("_p.rank") != 2, F.col(c)) for c in ("first_page", "last_page")})
    h = h.select(F.pmod(F.col("id") - F.col("_p.step"), F.lit(n)).alias("l_partkey"), "_p.rank", F.col("authors").alias("h_authors"), F.col("title").alias("h_title"), F.col("doi").alias("h_doi"), F.col("year").alias("h_year"), F.col("volume").alias("h_volume"), F.col("issue").alias("h_issue"), F.lit("1").alias("h_issn"), F.col("first_page").alias("h_first_page"), F.col("last_page").alias("h_last_page"), F.col("journal").alias("h_short_title"), F.lit(" ").alias("h_full_title"), F.col("pdf_urls").alias("h_pdf_urls"))
    made = refs.select("pub_id", "pos", "l_partkey").join(h.hint("merge"), "l_partkey").drop("l_partkey")
    refs = refs.drop("l_partkey")
    return resolve.validate_hits(refs, made).select("pub_id", "pos", "doi", "title", "issn", "journal", "validated")


@query("jn07_lookup_title", f"with {CATALOGUE_SQL} select id, title from cat where {_TITLE} = 'redwidgetbrandeconomy'")
def lookup_title(spark: SparkSession, sf: str) -> DataFrame:
    return cat.lookup(catalogue(spark, sf), "title", title="Red WIDGET Brand#3 economy").select("id", "title")


@query("jn07_lookup_author_volume", f"with {CATALOGUE_SQL} select id, title from cat where {_A} = 'rw,BE' and volume = '28' and year = 1991")
def lookup_author(spark: SparkSession, sf: str) -> DataFrame:
    return cat.lookup(catalogue(spark, sf), "author", authors="rw,BE", volume="28", year=1991).select("id", "title")


@query("jn08_set03_drop_known", "select doc_id from documents where doc_id % 2 = 1 and (doc_id % 10 = 1 or md5(text) not in (select md5(text) from documents where doc_id % 2 = 0))")
def new_documents(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").withColumn("doi", F.when(F.col("doc_id") % 10 != 1, F.md5("text")))
    return cat.drop_known(rows.where("doc_id % 2 = 1"), table(spark, sf, "documents").where("doc_id % 2 = 0").withColumn("doi", F.md5("text"))).select("doc_id")


@query("set02_set04_union", "select md5(text) as h from documents where doc_id % 3 = 0 union select md5(text) from documents where doc_id % 3 <> 0")
def union(spark: SparkSession, sf: str) -> DataFrame:
    h = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("h"))
    return h.where("doc_id % 3 = 0").unionByName(h.where("doc_id % 3 <> 0")).select("h").distinct()


@query("flt06_pending", "select o_orderkey from orders where o_orderkey % 3 <> 0")
def pending(spark: SparkSession, sf: str) -> DataFrame:
    from quillgraph.sources.xml import pending as left

    o = table(spark, sf, "orders")
    manifest = o.select("o_orderkey", F.concat(F.lit("src/a_"), F.col("o_orderkey"), F.lit(".tar")).alias("filename"))
    done = o.where("o_orderkey % 3 = 0").select(F.concat(F.lit("/mnt/x/src/a_"), F.col("o_orderkey"), F.lit(".tar")).alias("path"))
    return left(manifest, done).select("o_orderkey")


@query("src02_src03_jn13_positions", "select o_custkey, cast(pos as int) as pos, o_orderkey, o_orderstatus from (select *, row_number() over (partition by o_custkey order by o_orderkey) - 1 as pos, count(*) over (partition by o_custkey) as n from orders) where pos < n - 1 or n = 1")
def positions(spark: SparkSession, sf: str) -> DataFrame:
    """Two lists by position, the second one shorter; the zip is cut to the shorter."""
    by = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("o"))
    lists = by.select("o_custkey", F.col("o.o_orderkey").alias("o_orderkey"), F.slice(F.col("o.o_orderstatus"), F.lit(1), F.greatest(F.lit(1), F.size("o") - 1)).alias("o_orderstatus"))
    return report.zip_arrays(lists, "o_orderkey", "o_orderstatus")


def _json_sql(*fields: str) -> str:
    return "'[" + """"' || """ + """ || '","' || """.join(fields) + """ || '"]'"""


#: The index's keys of all blocks, as the stand-in catalogue has all fields and two authors each.
_KEYS_SQL = "keys as (" + " union all ".join(f"select {rank} as block, {k[0] if rank == 0 else _json_sql(*k)} as key, id from cat" for rank, k, _, _ in _BLOCKS.values()) + ")"


@query("agg01_agg03_posting_lists", f"with {CATALOGUE_SQL}, {_KEYS_SQL} select block, key, array_to_string(list(id order by id desc), ',') as ids from keys group by 1, 2 having count(*) < 10")
def lists(spark: SparkSession, sf: str) -> DataFrame:
    return cat.posting_lists(catalogue(spark, sf)).select("block", "key", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@query("agg02_stm06_merge_postings", f"""with {CATALOGUE_SQL}, {_KEYS_SQL}, old as (select block, key, list(id order by id desc) as ids from keys where id % 2 = 0 group by 1, 2 having count(*) < 10), new as (select block, key, list(id order by id desc) as ids from keys where id % 2 = 1 group by 1, 2 having count(*) < 10)
    select block, key, array_to_string(case when len(coalesce(new.ids, [])) + len(coalesce(old.ids, [])) < 10 then list_concat(coalesce(new.ids, []), coalesce(old.ids, [])) else old.ids end, ',') as ids from new full join old using (block, key) where not (old.ids is null and len(new.ids) >= 10)""")
def merged(spark: SparkSession, sf: str) -> DataFrame:
    c = catalogue(spark, sf)
    out = cat.merge_postings(cat.posting_lists(c.where("id % 2 = 0")), cat.posting_lists(c.where("id % 2 = 1")))
    return out.select("block", "key", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@query("agg04_posting_stats", f"with {CATALOGUE_SQL}, {_KEYS_SQL} select block, max(n) as longest from (select block, count(*) as n from keys group by block, key) group by 1")
def stats(spark: SparkSession, sf: str) -> DataFrame:
    return cat.posting_stats(catalogue(spark, sf))


@query("agg05_agg12_agg13_flags", f"with {REFERENCES_SQL} select pub_id, count(*) filter (where validated) as n_validated, bool_and(validated) as every, bool_or(validated) as some, sum(len(names)) as n_names from refs group by 1")
def flags(spark: SparkSession, sf: str) -> DataFrame:
    return references(spark, sf).groupBy("pub_id").agg(F.count_if("validated").alias("n_validated"), F.bool_and("validated").alias("every"), F.bool_or("validated").alias("some"), F.sum(F.size("authors")).alias("n_names"))


_RUNS = "select cast(user_id as varchar) as file, event_type as extractor, cast(event_id % 7 as int) as n_references, cast(event_id % 3 as int) as n_validated, cast(floor(value * 10) as int) as time_ms from events"


@query("agg06_src22_run_summary", f"select extractor, round(avg(n_references), 6) as avg_references, round(avg(n_validated), 6) as avg_validated, round(avg(time_ms), 6) as avg_time_ms, count(*) filter (where n_references > 0) as processed, count(*) as files from ({_RUNS}) group by 1")
def summary(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return report.run_summary(e.select(F.col("user_id").cast("string").alias("file"), F.col("event_type").alias("extractor"), (F.col("event_id") % 7).cast("int").alias("n_references"), (F.col("event_id") % 3).cast("int").alias("n_validated"), F.floor(F.col("value") * 10).cast("int").alias("time_ms")))


@query("agg07_by_file", "select user_id, array_to_string(list(event_id order by event_id), ',') as ids from events group by 1")
def by_file(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_list("event_id")).cast("array<string>"), ",").alias("ids"))


@query("agg14_commonest_width", "select user_id, cast(w as int) as width, n from (select user_id, w, count(*) as n, row_number() over (partition by user_id order by count(*) desc, w) as k from (select user_id, cast(floor(value) as int) % 9 as w from events) group by 1, 2) where k = 1")
def width(spark: SparkSession, sf: str) -> DataFrame:
    return lines.commonest_width(table(spark, sf, "events").select("user_id", (F.floor("value").cast("int") % 9).alias("w")), "user_id", "w")


@query("agg15_folds", "select o_orderstatus, string_agg(o_orderpriority, ',' order by o_orderpriority) as priorities from (select distinct o_orderstatus, o_orderpriority from orders) group by 1")
def folds(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"))


_FOUND = "select event_id, user_id as file, event_type as extractor, case when event_id % 3 = 0 then cast(event_id % 11 as varchar) end as arxiv_id, case when event_id % 4 = 0 then cast(event_id % 13 as varchar) end as doi from events"


@query("jn14_agg17_differences", f"""with f as ({_FOUND}), names as (select distinct event_type as e from events) select a.e as found_by, b.e as missed_by,
    (select count(*) from f x where x.extractor = a.e and not exists (select 1 from f y where y.extractor = b.e and y.file = x.file and (y.arxiv_id = x.arxiv_id or y.doi = x.doi))) as n from names a, names b where a.e <> b.e""")
def differences(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    found = table(spark, sf, "events").select("event_id", F.col("user_id").alias("file"), F.col("event_type").alias("extractor"), F.when(i % 3 == 0, (i % 11).cast("string")).alias("arxiv_id"), F.when(i % 4 == 0, (i % 13).cast("string")).alias("doi"))
    return report.pairwise_differences(found)


@query("win13_stm08_over_limit", "select event_id, n as recent from (select event_id, count(*) over (partition by user_id order by epoch(ts) range between 36000 preceding and current row) as n from events) where n > 2")
def over_limit(spark: SparkSession, sf: str) -> DataFrame:
    return report.over_limit(table(spark, sf, "events"), "user_id", 36000, 2).select("event_id", "recent")


@query("srt05_srt07_top", "select user_id, event_id, cast(k as int) as k from (select *, row_number() over (partition by user_id order by value desc, event_id) as k from events) where k <= 3")
def top(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("k", F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))).where("k <= 3").select("user_id", "event_id", "k")


@query("srt04_srt06_longest_word", "select p_partkey as id, array_to_string(list_sort(string_split(p_name, ' ')), ' ') as words, list_sort(list_transform(string_split(p_name || ' ' || p_type, ' '), lambda w, i: lpad(cast(1000 - length(w) as varchar), 4, '0') || lpad(cast(i as varchar), 3, '0') || w))[1][8:] as longest from part")
def longest(spark: SparkSession, sf: str) -> DataFrame:
    words = F.transform(F.split(F.concat_ws(" ", "p_name", "p_type"), " "), lambda w, i: F.struct((-F.length(w)).alias("n"), i.alias("i"), w.alias("w")))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.array_join(F.array_sort(F.split("p_name", " ")), " ").alias("words"), F.array_min(words)["w"].alias("longest"))


@query("snk04_number", "select p_partkey, row_number() over (order by p_name, p_partkey) as id from part")
def numbered(spark: SparkSession, sf: str) -> DataFrame:
    return cat.number(table(spark, sf, "part").select("p_name", "p_partkey"), "p_name", "p_partkey").select("p_partkey", "id")


@query("snk06_dead_letters", "select doc_id, case when n_chars < 200 then 'short' end as reason from documents where n_chars < 200")
def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    return report.failures(table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") < 200, "short").alias("reason")), "reason")[1]


# Positioned lines.

_BODY_SQL = "translate(md5(c_custkey || '/' || page || '/' || n), '0123456789', 'ghijklmnop')"


@query("win04_win06_win07_furniture", f"select cast(c_custkey as varchar) as doc_id, cast(page as int) as page_no, {_BODY_SQL} as str from customer, range(1, 9) p(page), range(2) l(n)")
def furniture(spark: SparkSession, sf: str) -> DataFrame:
    """Eight pages for each customer: a running header, two lines of letters, and the page's number; header and number go."""
    pages = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("doc_id"), F.explode(F.sequence(F.lit(1), F.lit(8))).alias("page_no"))
    body = [F.translate(F.md5(F.concat_ws("/", "doc_id", F.col("page_no").cast("string"), F.lit(str(n)))), "0123456789", "ghijklmnop") for n in range(2)]
    page = [(lines.START, F.lit(lines.PAGE_START)), (50, F.concat(F.lit("A running header of customer "), "doc_id")), *((50, b) for b in body), (50, F.col("page_no").cast("string")), (lines.END, F.lit(lines.PAGE_END))]
    made = pages.select("doc_id", "page_no", F.posexplode(F.array(*[F.struct(F.lit(i).alias("indent"), t.alias("str")) for i, t in page])).alias("n", "x"))
    made = made.select("doc_id", (F.col("page_no") * len(page) + F.col("n")).alias("line_no"), "x.indent", F.lit(700).alias("last_pos"), "x.str", "page_no")
    return lines.without_marks(segment.without_furniture(made)).select("doc_id", "page_no", "str")


@query("win01_page_numbers", f"with {LINES_SQL} select doc_id, line_no, cast(sum(case when indent = -1 then 1 else 0 end) over (partition by doc_id order by line_no) as int) as page_no from lines")
def page_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return lines.page_numbers(conversation_lines(spark, sf)).select("doc_id", "line_no", "page_no")


@query("win02_page_edges", f"with {LINES_SQL} select doc_id, line_no, coalesce(lag(indent) over w = -1, false) as is_first, coalesce(lead(indent) over w = -2, false) as is_last from lines window w as (partition by doc_id order by line_no)")
def edges(spark: SparkSession, sf: str) -> DataFrame:
    return lines.page_edges(conversation_lines(spark, sf)).select("doc_id", "line_no", "is_first", "is_last")


@query("win05_number_lines", f"""with {LINES_SQL}, e as (select *, coalesce(lag(indent) over w = -1, false) as f, coalesce(lead(indent) over w = -2, false) as l from lines window w as (partition by doc_id order by line_no)),
    n as (select *, sum(f::int) over w as nf, sum(l::int) over w as nl from e window w as (partition by doc_id order by line_no)),
    d as (select *, coalesce(bool_and(case when f and nf > 1 then regexp_full_match(str, '\\d*') end) over (partition by doc_id), true) as df, coalesce(bool_and(case when l and nl > 1 then regexp_full_match(str, '\\d*') end) over (partition by doc_id), true) as dl from n)
    select doc_id, line_no from d where not case when df then f when dl then l else false end""")
def number_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines.drop_number_lines(conversation_lines(spark, sf)).select("doc_id", "line_no")


@query("agg16_running_width", f"with {LINES_SQL} select doc_id, line_no, max(last_pos - indent) over (partition by doc_id order by line_no) as widest from lines")
def running(spark: SparkSession, sf: str) -> DataFrame:
    return lines.running_width(conversation_lines(spark, sf)).select("doc_id", "line_no", "widest")


@query("str11_flt12_read_lines", r"""with l as (select doc_id, unnest(string_split(text, chr(10))) as s, unnest(range(len(string_split(text, chr(10))))) as i from documents)
    select cast(doc_id as varchar) as doc_id, cast(i as int) as line_no, cast(i % 300 as int) as indent, regexp_replace(s, '^\s+|\s+$', '', 'g') as str from l where i % 7 <> 3 and not regexp_full_match(s, '\s*')""")
def read(spark: SparkSession, sf: str) -> DataFrame:
    mark = "concat('@d', i % 300, '@d')"
    marked = f"array_join(transform(split(text, '\\n'), (s, i) -> concat({mark}, s, if(i % 7 = 3, '', '@d700@d'))), '\\n')"
    texts = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.expr(marked).alias("text"))
    return lines.without_marks(lines.trimmed(lines.read_lines(texts))).select("doc_id", "line_no", "indent", "str")


@query("win08_after_heading", f"""with {LINES_SQL}, h as (select *, case when line_no % 9 = 4 then 'References' when line_no % 9 = 1 then 'see References' else str end as s from lines)
    select doc_id, line_no from (select *, max(case when s like '%References%' and s[1:1] <> 's' then line_no end) over (partition by doc_id) as start from h) where line_no > start""")
def heading(spark: SparkSession, sf: str) -> DataFrame:
    rows = conversation_lines(spark, sf).withColumn("str", F.expr("case when line_no % 9 = 4 then 'References' when line_no % 9 = 1 then 'see References' else str end"))
    return lines.after_heading(rows).select("doc_id", "line_no")


@query("win09_grammar", "select l_orderkey, l_linenumber, l_partkey, case l_linenumber % 4 when 0 then 'A' when 1 then 'B' when 2 then 'C' else 'D' end as g from lineitem")
def grammar(spark: SparkSession, sf: str) -> DataFrame:
    first = F.expr("case l_linenumber % 4 when 0 then '[1] x' when 1 then '1. x' when 2 then '1 x' else '[Ab] x' end")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", lines.grammar(first).alias("g"))


@query("win03_win10_segment", f"with {REFERENCES_SQL} select pub_id as doc_id, cast(pos - 1 as int) as pos, raw || ' J. of Parts 7 (' || year || ').' as reference from refs")
def segmented(spark: SparkSession, sf: str) -> DataFrame:
    """Bibliographies of orders: a heading, a line for each item with its label, and a further line."""
    refs = references(spark, sf).select("pub_id", "pos", "raw", "year")
    items = refs.select("pub_id", F.explode(F.expr("array(named_struct('n', pos * 2, 's', concat('@d50@d[', pos, '] ', raw, '@d700@d')), named_struct('n', pos * 2 + 1, 's', concat('@d80@dJ. of Parts 7 (', year, ').@d400@d')))")).alias("x"))
    text = items.groupBy(F.col("pub_id").alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["s"]), "\n").alias("text"))
    text = text.withColumn("text", F.concat(F.lit("\\@ps\\\n@d50@dReferences@d200@d\n"), F.col("text"), F.lit("\n\\@pe\\")))
    return segment.segment(lines.read_lines(text))


@query("prj11_udf07_references", f"with {REFERENCES_SQL} select pub_id, cast(pos - 1 as int) as pos, raw || ' J. of Parts 7 (' || year || ').' as raw, year, year as seen, true as is_reference, false as validated from refs")
def harvested(spark: SparkSession, sf: str) -> DataFrame:
    return as_references(segmented(spark, sf)).withColumn("seen", parse_year(F.col("raw"))).select("pub_id", "pos", "raw", "year", "seen", "is_reference", "validated")


# Similarity.

_PAIRS = "names as (select distinct p_name as s from part), pairs as (select a.s as a, b.s as b from names a, names b)"


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of the 64 names there are at any scale."""
    names = table(spark, sf, "part").select("p_name").distinct()
    return names.select(F.col("p_name").alias("a")).crossJoin(F.broadcast(names.select(F.col("p_name").alias("b"))))


def _table_sql(first: str, cell: str) -> str:
    """Rows of a dynamic program over the letters of a and b; ``cell`` gives the list of a row from the row before."""
    return f"""with recursive {_PAIRS}, dp as (select a, b, 0 as i, list_transform(range(length(b) + 1), lambda j: {first}) as r from pairs
        union all select a, b, i + 1, {cell} from dp where i < length(a))"""


@query("str02_lcs_length", _table_sql("0", """list_transform(range(length(b) + 1), lambda j: list_max(list_transform(range(j + 1), lambda k: greatest(r[k + 1], case when k > 0 and a[i + 1:i + 1] = b[k:k] then r[k] + 1 else 0 end))))""") + " select a, b, cast(r[length(b) + 1] as int) as n from dp where i = length(a)")
def lcs_length(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf).withColumn("n", sim.lcs_length(F.col("a"), F.col("b")))


@query("str01_free_start_distance", _table_sql("0", """list_transform(range(length(b) + 1), lambda j: list_min(list_transform(range(j + 1), lambda k: j - k + case when k = 0 then 0 else least(r[k + 1] + 1, r[k] + case when lower(a[i + 1:i + 1]) = lower(b[k:k]) then 0 else 1 end) end)))""") + " select a, b, cast(r[length(b) + 1] as int) as n from dp where i = length(a)")
def distance(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf).withColumn("n", sim.edit_distance(F.col("a"), F.col("b")))


@query("str02_lcs")
def lcs(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf).withColumn("s", sim.lcs(F.col("a"), F.col("b")))


@query("str06_num05_authors", "select p_partkey as id, p_partkey % 3 <> 1 as all_in from part")
def authors_in(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the texts names one author only."""
    text = F.when(F.col("p_partkey") % 3 == 1, F.concat_ws(", ", "p_type", F.lit("0000"))).otherwise(F.concat_ws(", ", "p_type", "p_brand", "p_name"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), sim.all_authors_in(F.array("p_name", "p_type"), text).alias("all_in"))


# Graph.


@query("grf02_agg08_authors", f"with {PUBLICATIONS_SQL}, {REFERENCES_SQL} select distinct author as name from pubs union select unnest(names) from refs where validated")
def author_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return graph.author_nodes(graph.all_authors(publications(spark, sf), references(spark, sf)))


@query("agg10_affiliations", f"with {PUBLICATIONS_SQL} select distinct affiliation as name from pubs where trim(affiliation) <> ''")
def affiliation_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return graph.affiliation_nodes(graph.all_authors(publications(spark, sf), references(spark, sf)))


@query("agg09_journals", f"with {PUBLICATIONS_SQL} select distinct journal as title from pubs")
def journal_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return graph.journal_nodes(publications(spark, sf), references(spark, sf))


@query("grf05_authored", f"with {PUBLICATIONS_SQL} select distinct id as src, author as dst from pubs where affiliation is null or trim(affiliation) <> ''")
def authored(spark: SparkSession, sf: str) -> DataFrame:
    return graph.authored_edges(publications(spark, sf))


@query("jn12_works", f"with {PUBLICATIONS_SQL} select distinct author as src, affiliation as dst from pubs where trim(affiliation) <> ''")
def works(spark: SparkSession, sf: str) -> DataFrame:
    return graph.works_edges(publications(spark, sf))


_NODES_SQL = "nodes as (select 'n' || id as node, case when id % 3 = 0 then doi end as doi, cast(null as varchar) as arxiv_id, case when id % 5 = 0 then title end as title from cat)"


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    c = catalogue(spark, sf)
    return c.select(F.concat(F.lit("n"), "id").alias("node"), F.when(F.col("id") % 3 == 0, F.col("doi")).alias("doi"), F.lit(None).cast("string").alias("arxiv_id"), F.when(F.col("id") % 5 == 0, F.col("title")).alias("title"))


@query("jn09_grf06_cites", f"with {CATALOGUE_SQL}, {REFERENCES_SQL}, {_NODES_SQL} select distinct pub_id as src, node as dst, raw as raw_ref from refs r join nodes n on r.doi = n.doi union select pub_id, node, raw from refs r join nodes n on r.title = n.title")
def cites(spark: SparkSession, sf: str) -> DataFrame:
    return graph.citation_edges(references(spark, sf), _nodes(spark, sf))


@query("jn10_grf03_agg11_missing", f"with {CATALOGUE_SQL}, {REFERENCES_SQL}, {_NODES_SQL} select distinct title from refs r where not validated and trim(title) <> '' and not exists (select 1 from nodes n where n.doi = r.doi) and not exists (select 1 from nodes n where n.title = r.title)")
def missing(spark: SparkSession, sf: str) -> DataFrame:
    return graph.missing_publications(references(spark, sf), _nodes(spark, sf))


@query("grf04_new_publications", f"""with {CATALOGUE_SQL}, {REFERENCES_SQL}, {_NODES_SQL}, f as (select *, coalesce('doi:' || doi, 'title:' || title) as merge_key from refs r where validated and not exists (select 1 from nodes n where n.doi = r.doi) and not exists (select 1 from nodes n where n.title = r.title))
    select merge_key, pub_id, pos from (select *, row_number() over (partition by merge_key order by pub_id, pos) as n from f where merge_key is not null) where n = 1""")
def fresh(spark: SparkSession, sf: str) -> DataFrame:
    return graph.new_publications(references(spark, sf), _nodes(spark, sf)).select("merge_key", "pub_id", "pos")


@query("jn11_grf07_grf08_cited_by", f"""with {CATALOGUE_SQL}, {REFERENCES_SQL}, {_NODES_SQL} select case when title is null then '#' else title end as src, pub_id as dst, arg_max(raw, pos) as raw_ref from refs r
    where not exists (select 1 from nodes n where n.doi = r.doi) and not exists (select 1 from nodes n where n.title = r.title) group by case when title is null then '#' || pub_id || '/' || pos else title end, case when title is null then '#' else title end, pub_id""")
def cited_by(spark: SparkSession, sf: str) -> DataFrame:
    return graph.cited_by_edges(references(spark, sf), _nodes(spark, sf)).withColumn("src", F.when(F.col("src").startswith("#"), "#").otherwise(F.col("src")))


@query("grf09_grf10_published", f"with {REFERENCES_SQL} select pub_id as src, volume as dst, arg_min(first_page, pos) as first_page from (select * from refs where first_page is not null) group by 1, 2")
def published(spark: SparkSession, sf: str) -> DataFrame:
    rows = references(spark, sf).where("first_page is not null").withColumns({"id": F.col("pub_id"), "journal": F.col("volume"), "raw_ref": F.col("raw")})
    return graph.published_edges(rows).select("src", "dst", "first_page")


@query("grf01_upsert", "select o_custkey as k, arg_max(case when o_orderkey % 3 <> 0 then o_orderpriority end, case when o_orderkey % 3 <> 0 then o_orderkey end) as priority, max(case when o_orderkey % 2 = 0 then 1 else 0 end) as even from orders group by 1")
def upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, even and odd orders; later properties win where they are not null."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"), F.when(F.col("o_orderkey") % 2 == 0, 1).alias("even"), "o_orderkey")
    half = table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0] // 2
    empty = o.select("k", "priority", "even").limit(0)
    once = graph.upsert(empty, o.where(F.col("o_orderkey") <= half), "k", "o_orderkey")
    return graph.upsert(once, o.where(F.col("o_orderkey") > half), "k", "o_orderkey").withColumn("even", F.coalesce("even", F.lit(0)))


_MET = "(select r.pub_id, r.pos, r.raw, n.node from refs r join every n on r.doi = n.doi union select r.pub_id, r.pos, r.raw, n.node from refs r join every n on r.title = n.title and trim(n.title) <> '')"


@query("grf_build_tables", f"""with {PUBLICATIONS_SQL}, {REFERENCES_SQL},
    f as (select *, coalesce('doi:' || doi, 'title:' || title) as merge_key from refs where validated and doi not in (select doi from pubs where doi is not null) is not false and title not in (select title from pubs) is not false),
    fresh as (select * from (select *, row_number() over (partition by merge_key order by pub_id, pos) as n from f where merge_key is not null) where n = 1),
    every as (select id as node, doi, title from pubs union all select merge_key, doi, title from fresh), met as {_MET},
    lost as (select coalesce(title, '#' || pub_id || '/' || pos) as src, pub_id from refs where (pub_id, pos) not in (select (pub_id, pos) from met where pub_id <> node))
    select 'publications' as name, count(*) as n from every
    union all select 'authors', count(*) from (select author from pubs union select unnest(names) from refs where validated)
    union all select 'affiliations', count(distinct affiliation) from pubs where trim(affiliation) <> ''
    union all select 'journals', count(distinct journal) from pubs
    union all select 'missing', count(distinct title) from refs where not validated and (pub_id, pos) not in (select (pub_id, pos) from met)
    union all select 'authored', count(*) from (select id, author from pubs where affiliation is null or trim(affiliation) <> '' union select merge_key, unnest(names) from fresh)
    union all select 'works', count(*) from (select distinct author, affiliation from pubs where trim(affiliation) <> '')
    union all select 'cites', count(*) from (select distinct pub_id, node, raw from met where pub_id <> node)
    union all select 'cited_by', count(*) from (select distinct src, pub_id from lost)
    union all select 'published', count(*) from (select distinct id, journal from pubs)
    union all select 'properties', count(*) from pubs
    union all select 'cited_properties', count(*) from fresh""")
def built(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each table of the whole graph."""
    out = None
    for name, df in graph.build(publications(spark, sf), references(spark, sf)).items():
        n = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = n if out is None else out.unionByName(n)
    return out


#: A citation for each part in full, and the catalogue it is resolved against: titles of letters that no other part has.
_WORD = "translate(md5(cast(p_partkey as string)), '0123456789', 'ghijklmnop')"


def _cited_parts(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").withColumn("title", F.concat(F.lit("On the "), F.expr(_WORD), F.lit(" of "), "p_name"))
    k = F.col("p_partkey")
    raw = F.concat(F.lit("[1] A. B. Miller, C. Smith, "), "title", F.lit(", Phys. Rev. D "), F.col("p_size").cast("string"), F.lit(", "), (100 + k % 700).cast("string"), F.lit("-"), (110 + k % 700).cast("string"), F.lit(" ("), (1990 + k % 9).cast("string"), F.lit(")"))
    return p.select(k.cast("string").alias("doc_id"), F.lit(1).alias("pos"), raw.alias("reference"), "title", "p_size", "p_partkey")


@query("prj11_src19_citation_fields", """select cast(p_partkey as varchar) as pub_id, 'A. B. Miller;C. Smith' as names, 'On the ' || translate(md5(cast(p_partkey as varchar)), '0123456789', 'ghijklmnop') || ' of ' || p_name as title, 'Phys. Rev. D' as journal,
    cast(p_size as varchar) as volume, cast(100 + p_partkey % 700 as int) as first_page, cast(110 + p_partkey % 700 as int) as last_page, cast(1990 + p_partkey % 9 as int) as year from part""")
def citation_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Citation strings taken apart again."""
    out = as_references(_cited_parts(spark, sf))
    return out.select("pub_id", F.array_join(F.transform("authors", lambda a: a["name"]), ";").alias("names"), "title", "journal", "volume", "first_page", "last_page", "year")


@query("udf07_harvest_resolves", "select cast(p_partkey as varchar) as src, 'doi:10.1/' || p_partkey as dst from part")
def harvested(spark: SparkSession, sf: str) -> DataFrame:
    """Citation strings to the graph: fields, catalogue, citation edges to publications that weren't there."""
    parts = _cited_parts(spark, sf)
    author = lambda n: F.struct(F.lit(n).alias("name"))
    k, none = F.col("p_partkey"), F.lit(None).cast("string")
    known = parts.select(
        k.alias("id"), F.array(author("A. B. Miller"), author("C. Smith")).alias("authors"), none.alias("pmid"), F.concat(F.lit("10.1/"), k).alias("doi"), none.alias("ssid"), F.lit("Phys. Rev. D").alias("journal"), none.alias("pages"), F.col("p_size").cast("string").alias("volume"), "title",
        (1990 + k % 9).cast("int").alias("year"), (100 + k % 700).cast("int").alias("first_page"), (110 + k % 700).cast("int").alias("last_page"), none.alias("issue"), F.array().cast("array<string>").alias("pdf_urls"),
    )
    pubs = parts.select(
        F.col("doc_id").alias("id"), F.array().cast("array<struct<name:string,affiliation:string>>").alias("authors"), none.alias("title"), none.alias("doi"), none.alias("journal"),
        *[none.alias(c) for c in ("created", "updated", "msc_class", "acm_class", "pdf_url", "abstract")], F.array().cast("array<string>").alias("categories"),
    )
    tables = harvest(pubs, parts, validators("l", known), extractor=lambda p: p.select("doc_id", "pos", "reference"))
    return tables["cites"].select("src", "dst")


# Incremental loads.


def _scratch(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file:///tmp/checkpoints/quillgraph"
    return f"{root.rstrip('/')}/stream-{uuid.uuid4().hex}"


def _events_folder(spark: SparkSession, sf: str) -> str:
    """The events as a folder of several files, as a file stream finds them."""
    out = f"{_scratch(spark)}/events"
    table(spark, sf, "events").repartition(4, "event_id").write.parquet(out)
    return out


@query("stm02_stm03_stm05_file_stream", "select event_type, count(*) as n from events group by 1")
def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    folder, root = _events_folder(spark, sf), _scratch(spark)
    versions = incremental.Versions(spark, f"{root}/table")
    stream = incremental.file_stream(spark, folder, spark.read.parquet(folder).schema, 1)
    incremental.drain(stream, f"{root}/checkpoint", incremental.upsert_counts(versions, "event_type"))
    return versions.read()


@query("stm01_src01_paged_source", "select cast(p as varchar) as page, cast(r as int) as row from range(5) t(p), range(3) u(r)")
def paged(spark: SparkSession, sf: str) -> DataFrame:
    from quillgraph.sources.paged import PagedSource

    spark.dataSource.register(PagedSource)
    root = _scratch(spark)
    stream = spark.readStream.format("paged").option("transport", "quillgraph.sources.samples:FivePages").option("schema", "page string, row int").load()
    q = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(processingTime="0 seconds").start()
    for _ in range(60):
        q.processAllAvailable()
        if spark.read.schema("page string, row int").parquet(f"{root}/out").count() >= 15:
            break
    q.stop()
    return spark.read.schema("page string, row int").parquet(f"{root}/out")


@query("stm07_recent", f"with {PUBLICATIONS_SQL} select id from pubs where date_diff('day', coalesce(updated, created), date '2000-06-01') < 7")
def recent(spark: SparkSession, sf: str) -> DataFrame:
    rows = publications(spark, sf).withColumns({"created": F.col("created").cast("date"), "updated": F.col("updated").cast("date")})
    return incremental.recent(rows, F.lit("2000-06-01").cast("date")).select("id")


@query("stm04_skip_and_audit", "select p_partkey from part where p_partkey > 50 and p_partkey % 100 = 0 and p_partkey % 3 <> 0")
def audited(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return incremental.audit(incremental.skip_first(p, "p_partkey", 50), p.where("p_partkey % 3 = 0"), "p_partkey", 100, "p_partkey").select("p_partkey")


@query("stm11_snk02_compact", "select event_id, user_id from events")
def compacted(spark: SparkSession, sf: str) -> DataFrame:
    folder = _events_folder(spark, sf)
    incremental.compact(spark, folder, f"{folder}-compact")
    return spark.read.parquet(f"{folder}-compact").select("event_id", "user_id")
