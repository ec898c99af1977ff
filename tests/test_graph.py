import random

import pytest
from pyspark.sql import functions as F

from quillgraph.functions.journal import parse_citation
from quillgraph.operators import catalogue, graph, report
from quillgraph.plans import pipelines
from quillgraph.schemas import REFERENCE

COLUMNS = ("authors", "title", "journal", "volume", "issue", "first_page", "last_page", "year")


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("[12] A. B. Miller, C. Smith, On the shape of rings, Phys. Rev. D 12, 45-67 (1990)", (["A. B. Miller", "C. Smith"], "On the shape of rings", "Phys. Rev. D", "12", None, 45, 67, 1990)),
        ("3. J. Doe and K. Roe, J. Phys. A 7 (2001) 100", (["J. Doe", "K. Roe"], None, "J. Phys. A", "7", None, 100, None, 2001)),
        ('Lee, Q. "A title in quotes," Nature 99, 5 (1988)', (["Lee, Q."], "A title in quotes", "Nature", "99", None, 5, None, 1988)),
        ("no field here", ([], None, None, None, None, None, None, None)),
        (None, ([], None, None, None, None, None, None, None)),
    ],
)
def test_citation_fields(spark, raw, want):
    row = spark.createDataFrame([(raw,)], "raw string").select(parse_citation(F.col("raw")).alias("f")).select("f.*").first()
    assert tuple(row[c] for c in COLUMNS) == want


def citations(spark, n=200, seed=1):
    rng = random.Random(seed)
    some = lambda *v: rng.choice([None, "", *v])
    rows = []
    for i in range(n):
        r = {"pub_id": f"p{i % 20}", "pos": i // 20, "raw": f"raw {i}", "doi": some("d1", "d2", "d3", "d4"), "arxiv_id": some("a1", "a2"), "title": some("t1", "t2", "t3"), "validated": rng.random() < 0.6, "is_reference": True}
        rows.append(r | {"authors": [("X", None)], "journal": some("J1", "J2"), "urls": []})
    return rows, spark.createDataFrame(rows, REFERENCE)


def test_matching_by_any_id(spark):
    rows, refs = citations(spark)
    nodes = [("n1", "d1", None, "t9"), ("n2", None, "a1", "t1"), ("n3", "", "", ""), ("n4", "d2", "a1", "t2")]
    met = graph.match_by_any(refs.select("pub_id", "pos", *graph.IDS), spark.createDataFrame(nodes, "node string, doi string, arxiv_id string, title string"), ["pub_id", "pos"], "node")
    want = {(r["pub_id"], r["pos"], n) for r in rows for n, *ids in nodes if any(v and v == r[c] for v, c in zip(ids, graph.IDS))}
    assert sorted((r["pub_id"], r["pos"], r["node"]) for r in met.collect()) == sorted(want)


def test_citation_edges_are_distinct_without_a_shuffle_of_pairs(spark):
    """Equal raw strings with other ids, a node in two rows, blank ids and a citation of itself."""
    rows, refs = citations(spark)
    refs = refs.withColumn("raw", F.concat(F.lit("raw "), F.col("pos") % 3))
    nodes = [("n1", "d1", None, "t9"), ("n2", None, "a1", "t1"), ("n2", "d3", "a2", "t1"), ("n3", "", "", " "), ("p4", "d2", "a1", "t2")]
    edges = graph.citation_edges(refs, spark.createDataFrame(nodes, "node string, doi string, arxiv_id string, title string"))
    plan = edges._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "Exchange" not in plan.split("Join")[0] and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    want = {(r["pub_id"], n, f"raw {r['pos'] % 3}") for r in rows for n, *ids in nodes if n != r["pub_id"] and any(v and v == r[c] for v, c in zip(ids, graph.IDS))}
    assert sorted(tuple(e) for e in edges.collect()) == sorted(want)


def test_graph_of_a_batch(spark):
    rows, refs = citations(spark)
    text = "id string, authors array<struct<name:string,affiliation:string>>, title string, doi string, journal string, created string, updated string, msc_class string, acm_class string, pdf_url string, abstract string, categories array<string>"
    pubs = spark.createDataFrame([(f"p{i}", [("A", "U")], f"own {i}", "d1" if i == 3 else None, "J9", "2001-02-03", None, "", None, None, "about", ["c"]) for i in range(20)], text)
    tables = {k: df.collect() for k, df in graph.build(pubs, refs).items()}
    key = lambda r: f"doi:{r['doi']}" if r["doi"] else f"arxiv_id:{r['arxiv_id']}" if r["arxiv_id"] else None if r["title"] is None else f"title:{r['title']}"
    first = {}
    for r in sorted(rows, key=lambda r: (r["pub_id"], r["pos"])):
        if r["validated"] and r["doi"] != "d1" and key(r):
            first.setdefault(key(r), r)
    assert {r["node"] for r in tables["cited_properties"]} == set(first) and len(tables["publications"]) == 20 + len(first)
    journals = {(f"p{i}", "J9") for i in range(20)} | {(k, r["journal"]) for k, r in first.items() if r["journal"]}
    assert {(r["src"], r["dst"]) for r in tables["published"]} == journals
    assert {(r["abstract"], str(r["created"]), r["msc_class"]) for r in tables["properties"]} == {("about", "2001-02-03", None)}


def test_positions_on_one_side_only_are_an_error(spark):
    ids = spark.createDataFrame([(0, "a"), (1, "b")], "pos int, id string")
    found = spark.createDataFrame([(0, "x", 5), (1, "y", 6)], "pos int, id string, v int")
    assert sorted(tuple(r) for r in report.at_positions(ids, found).select("pos", "id", "v").collect()) == [(0, "a", 5), (1, "b", 6)]
    with pytest.raises(Exception, match="position 1"):
        report.at_positions(ids, found.where("pos = 0")).collect()


def test_numbers_are_gapless_with_repeats(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"))
    got = sorted(r["id"] for r in catalogue.number(rows, "a", "b").collect())
    assert got == list(range(1, 5001))


def test_harvest_writes_and_overwrites(spark, tmp_path):
    entries = spark.createDataFrame([("p0", 1, "[1] A. Bee, A title of words, Phys. Rev. D 3, 5-9 (1999), 10.1234/abc")], "doc_id string, pos int, reference string")
    ref = pipelines.references(entries).first()
    assert (ref["doi"], ref["title"], ref["volume"], ref["authors"][0]["name"]) == ("10.1234/abc", "A title of words", "3", "A. Bee")
    nodes = {"n": spark.createDataFrame([("x",)], "node string")}
    for _ in range(2):
        pipelines.write_graph(nodes, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "n")).count() == 1
