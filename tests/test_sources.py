import io
import tarfile

import pytest
from pyspark.sql import functions as F

from quillgraph.operators import graph, report
from quillgraph.sources import paged, records, xml
from quillgraph.streaming import incremental

OAI = """<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>
<record><header><identifier>oai:1</identifier><datestamp>2020-01-01</datestamp></header><metadata><arXiv><id>0801.2407</id><created>2008-01-01</created><updated>2009-01-01</updated>
<authors><author><keyname>Doe</keyname><forenames>J.</forenames><suffix>Jr</suffix><affiliation>U</affiliation></author><author><keyname>Roe</keyname></author></authors>
<title>A long
 ti-
tle</title><categories>math cs</categories><abstract>One
two</abstract></arXiv></metadata></record>
<record><header><identifier>oai:2</identifier><datestamp>2020-01-01</datestamp></header><metadata><arXiv><id>x</id><title>no date</title><abstract>a</abstract><authors/></arXiv></metadata></record>
<resumptionToken completeListSize="77">tok|1</resumptionToken></ListRecords></OAI-PMH>"""

ATOM = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">
<entry><id>i1</id><updated>2009-01-02T00:00:00Z</updated><published>2008-01-02T10:00:00Z</published><title>T
one</title><summary>S</summary><author><name>J. Doe</name><arxiv:affiliation>U</arxiv:affiliation></author><arxiv:doi>10.1/x</arxiv:doi>
<link title="doi" href="d"/><link title="pdf" href="p1"/><link title="pdf" href="p2"/><category term="math.AG"/><category term="14J60"/></entry>
<entry><id>i2</id><title>U</title><summary>S</summary><author><name>R</name></author><link title="doi" href="d"/><category term="cs"/></entry></feed>"""


def test_oai(spark, tmp_path):
    (tmp_path / "p.xml").write_text(OAI)
    rows = xml.read_oai(spark, str(tmp_path / "p.xml")).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["id"], r["title"], r["abstract"], r["categories"]) == ("0801.2407", "A long title", "One two", ["math", "cs"])
    assert [(a["name"], a["affiliation"]) for a in r["authors"]] == [("J. Doe Jr", "U"), ("Roe", None)]
    cursor = xml.read_cursor(spark, str(tmp_path / "p.xml")).first()
    assert (cursor["token"], cursor["total"]) == ("tok|1", 77)


def test_atom(spark, tmp_path):
    (tmp_path / "a.xml").write_text(ATOM)
    rows = {r["id"]: r for r in xml.read_atom(spark, str(tmp_path / "a.xml")).collect()}
    assert rows["i1"]["created"] == "2008-01-02" and rows["i1"]["categories"] == ["math.AG"] and rows["i1"]["pdf_url"] == "p2" and rows["i1"]["title"] == "T one"
    assert rows["i2"]["pdf_url"] is None
    assert sorted(r["url"] for r in xml.read_pdf_links(spark, str(tmp_path / "a.xml")).collect()) == ["", "p1", "p2"]


def test_manifest_and_archives(spark, tmp_path):
    (tmp_path / "m.xml").write_text("<m><file><filename>pdf/a.tar</filename><md5sum>1</md5sum></file><file><filename>pdf/b.tar</filename><md5sum>2</md5sum></file></m>")
    m = xml.read_manifest(spark, str(tmp_path / "m.xml"))
    done = spark.createDataFrame([("/x/pdf/a.tar",)], "path string")
    assert [r["filename"] for r in xml.pending(m, done).collect()] == ["pdf/b.tar"]
    with tarfile.open(tmp_path / "a.tar", "w") as tar:
        info = tarfile.TarInfo("d/hep-th9901001.pdf")
        info.size = 3
        tar.addfile(info, io.BytesIO(b"abc"))
    row = records.read_archives(spark, str(tmp_path / "a.tar")).first()
    assert (row["name"], bytes(row["content"])) == ("hep-th9901001.pdf", b"abc")
    files = records.read_files(spark, str(tmp_path / "a.tar"))
    assert xml.changed(m, files).count() == 2


def test_dump_and_hits(spark):
    lines = ['{"DOI":"d","author":[{"family":"F"}],"container-title":["J"],"issued":{"date-parts":[[2001,5,1999]]},"page":"5-x","title":[],"link":[{"URL":""},{"URL":"u"}]}', "not json", "{}"]
    rows = records.parse_dump(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert len(rows) == 3
    assert rows[0]["authors"][0]["name"] == "null F" and rows[0]["year"] == 1999 and rows[0]["first_page"] == 5 and rows[0]["last_page"] is None and rows[0]["title"] is None and rows[0]["pdf_urls"] == ["u"]
    assert rows[1]["doi"] is None


def test_runs_and_properties(spark, tmp_path):
    (tmp_path / "r.csv").write_text("f,a,3,1,10\nf,b,0,0,5\n")
    runs = records.read_runs(spark, str(tmp_path / "r.csv"))
    assert {r["extractor"]: r["processed"] for r in report.run_summary(runs).collect()} == {"a": 1, "b": 0}
    report.write_runs(runs, str(tmp_path / "out"))
    (tmp_path / "c.properties").write_text("# c\na=1\n b = x=y \n")
    assert records.read_properties(tmp_path / "c.properties") == {"a": "1", "b": "x=y"}


def test_rate_limit_and_retry():
    now, slept = [0.0], []
    limit = paged.RateLimit(2, 1.0, clock=lambda: now[0], sleep=lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    for _ in range(3):
        limit.wait()
    assert slept == [1.0]
    limit.adapt({"X-Rate-Limit-Limit": "50", "X-Rate-Limit-Interval": "3s"})
    assert (limit.most, limit.seconds) == (50, 3.0)
    calls = []
    assert paged.with_retry(lambda: calls.append(1) or (len(calls) > 1 or 1 / 0), sleep=lambda s: None)
    http = paged.HttpPages({"url": "http://x", "from": "2020-01-01"})
    assert "from=2020-01-01" in http.address("") and "resumptionToken=t%7C1" in http.address("t|1")


def test_ranges_are_read_side_by_side(spark):
    spark.dataSource.register(paged.PagedSource)
    months = spark.read.format("paged").option("transport", "quillgraph.sources.samples:DatedPages").option("schema", "month int, row string").option("ranges", "1..3, 4..4,5..12").load()
    assert months.rdd.getNumPartitions() == 3
    assert sorted(tuple(r) for r in months.collect()) == sorted((m, f"{m}/{r}") for m in range(1, 13) for r in range(2))
    dated = paged.HttpPages({"url": "http://x", "from": "2020-01-01", "until": "2020-01-31"})
    assert "until=2020-01-31" in dated.address("") and "until" not in dated.address("t")


def test_records_of_fetched_pages(spark):
    pages = spark.createDataFrame([(OAI,), ("<OAI-PMH/>",), (None,)], "page string")
    rows = xml.page_records(pages)
    assert [(r["id"], r["title"], r["abstract"]) for r in rows.collect()] == [("0801.2407", "A long title", "One two")]
    linked = xml.with_pdf_links(rows, spark.createDataFrame([("0801.2407", "http://p")], "id string, url string"))
    assert linked.columns == rows.columns and linked.first()["pdf_url"] == "http://p"
    with pytest.raises(Exception, match="no link for 0801.2407"):
        xml.with_pdf_links(rows, spark.createDataFrame([("other", "http://p")], "id string, url string")).collect()


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", "x", None)], "k string, p string, q int")
    new = spark.createDataFrame([("a", None, 1, 1), ("a", "y", None, 2), ("b", "z", 3, 3)], "k string, p string, q int, at int")
    once = graph.upsert(old, new, "k", "at")
    want = {("a", "y", 1), ("b", "z", 3)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in graph.upsert(once, new, "k", "at").collect()} == want


def test_empty_ids_match_each_other(spark):
    a = spark.createDataFrame([("f", "", None), ("f", "1", None)], "file string, arxiv_id string, doi string")
    b = spark.createDataFrame([("f", "", None)], "file string, arxiv_id string, doi string")
    assert report.only_in(a, b).count() == 1


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") % 7).alias("k"))
    rows.repartition(5).write.parquet(str(tmp_path / "in"))
    versions = incremental.Versions(spark, str(tmp_path / "t"))
    stream = incremental.file_stream(spark, str(tmp_path / "in"), rows.schema, 1)
    incremental.drain(stream, str(tmp_path / "c"), incremental.upsert_counts(versions, "k"))
    assert {tuple(r) for r in versions.read().collect()} == {tuple(r) for r in rows.groupBy("k").count().collect()}
    before = versions._complete()
    incremental.drain(stream, str(tmp_path / "c"), incremental.upsert_counts(versions, "k"))
    assert versions._complete() == before
    assert incremental.table_or_none(spark, str(tmp_path / "none")) is None
