import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillgraph.functions import ids, numbers, text
from quillgraph.functions import similarity as sim

words = st.text(alphabet="abcAB -", max_size=12)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("see arXiv:0801.2407v2 here", "0801.2407"),
        ("arXiv:hep-th/9901001v1", "hep-th/9901001"),
        ("J. Phys. hep-th/9901001", "hep-th/9901001"),
        ("math.AG/0101001 x", "math/0101001"),
        ("ARXIV:0801.2407", "0801.2407"),
        ("arxiv:0801.24", ""),
        ("arXiv:080.1/23456789", "080.1/23456789"),
        ("physics/0101001", "physics/0101001"),
        ("hep-ph/x hep-th/9901001", ""),
        ("nothing", ""),
        ("", ""),
        (None, None),
    ],
)
def test_arxiv_id(spark, raw, want):
    assert one(spark, ids.arxiv_id(F.lit(raw).cast("string"))) == want


def test_contains_ids(spark):
    assert one(spark, ids.contains_id(F.lit("HEP-TH/9901001")))
    assert not one(spark, ids.contains_id(F.lit("hep-th/99")))
    # An archive whose name ends another's, and one that is listed twice, count double.
    assert one(spark, ids.contains_multiple_ids(F.lit("physics/9901001")))
    assert one(spark, ids.contains_multiple_ids(F.lit("alg-geom/9901001")))
    assert not one(spark, ids.contains_multiple_ids(F.lit("hep-th/9901001")))
    assert one(spark, ids.contains_multiple_ids(F.lit("arXiv:1 arxiv:2")))


@pytest.mark.parametrize(("name", "want"), [("a/hep-th9901001.pdf", "hep-th/9901001"), ("0801.2407.pdf", "0801.2407.pdf")])
def test_id_from_filename(spark, name, want):
    assert one(spark, ids.id_from_filename(F.lit(name))) == want


@pytest.mark.parametrize(("raw", "want"), [("inter-\nesting", "interesting"), ("Self-\nLoop", "Self-Loop"), ("x-\n1", "x-1"), (" a \n\n b ", "a b"), ("-\nb", "- b"), ("-", "-"), ("", "")])
def test_one_line(spark, raw, want):
    assert one(spark, text.one_line(F.lit(raw))) == want


def test_join_lines(spark):
    assert one(spark, text.join_lines(F.array(F.lit("ab inter-"), F.lit("esting")))) == "ab inter-esting"
    assert one(spark, text.join_lines(F.array(F.lit("abc -"), F.lit("esting x")))) == "abc esting x"
    assert one(spark, text.join_lines(F.array(F.lit("ab"), F.lit("cd")))) == "ab cd"


def test_initials_and_title_key(spark):
    assert one(spark, text.initials_key(F.array(F.lit("V.A. Khoze"), F.lit("Alan M. Turing")))) == "AKV,AMT"
    assert one(spark, text.initials_key(F.array(F.lit("Khoze V.A.")))) == one(spark, text.initials_key(F.array(F.lit("V.A. Khoze"))))
    assert one(spark, text.title_key(F.lit("On Éa-1!"))) == "onéa"
    assert one(spark, text.title_key(F.lit("1984"))) == "1984"


def test_numbers(spark):
    assert one(spark, numbers.first_page(F.lit("p. 12--15"))) == 12
    assert one(spark, numbers.last_page(F.lit("p. 12--15"))) == 15
    assert one(spark, numbers.last_page(F.lit("12"))) is None
    assert one(spark, numbers.expand_last_page(F.lit(1234), F.lit(56))) == 1256
    assert one(spark, numbers.strict_int(F.lit(" 12 "))) is None
    assert one(spark, numbers.parse_year(F.lit("x 1874 2003"))) == 2003
    assert one(spark, numbers.iso_date(F.lit("2020-02-30"))) is None


def plain_lcs(a, b):
    t = [[""] * (len(b) + 1) for _ in range(len(a) + 1)]
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            if n[i - 1][j] == max(n[i - 1][j], n[i][j - 1], n[i - 1][j - 1] + (a[i - 1] == b[j - 1])):
                n[i][j], t[i][j] = n[i - 1][j], t[i - 1][j]
            elif n[i][j - 1] == max(n[i][j - 1], n[i - 1][j - 1] + (a[i - 1] == b[j - 1])):
                n[i][j], t[i][j] = n[i][j - 1], t[i][j - 1]
            else:
                n[i][j], t[i][j] = n[i - 1][j - 1] + 1, t[i - 1][j - 1] + a[i - 1]
    return t[-1][-1]


def plain_distance(a, b):
    a, b = a.lower(), b.lower()
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = min(t[i - 1][j] + 1, t[i][j - 1] + 1, t[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
    return t[-1][-1]


@settings(max_examples=300, deadline=None)
@given(words, words)
def test_sequences_match_plain_tables(a, b):
    want = a if a == b else plain_lcs(a, b)
    assert sim.subsequence(a, b) == want
    assert sim.subsequence_length(a, b) == len(want)
    assert sim.free_start_distance(a, b) == plain_distance(a, b)


def test_distance_borders():
    assert sim.free_start_distance("abc", "") == 0
    assert sim.free_start_distance("abc", "xabc") == 0
    assert sim.free_start_distance("ABC", "abc") == 0
    assert sim.free_start_distance("ABC", "abc", ignore_case=False) > 0


def test_author_in():
    assert sim.author_in("Alan Turing", "A. Turing, On numbers")
    assert sim.author_in("Alan Turin9", "A. Turing")
    assert not sim.author_in("Alan Turing", "xyz")
    assert not sim.author_in("  ", "xyz")
