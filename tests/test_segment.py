import hashlib
import itertools

import pytest

from quillgraph.operators import lines as L
from quillgraph.operators import segment as S
from quillgraph.operators.segment import Line


def entry_lines(label, further=80, last=500):
    out = []
    for n in range(1, 5):
        out += [Line(50, 700, f"{label(n)} Reference {n} line one", 1), Line(further, last, f"of {n}, Nature {n} (200{n}).", 1)]
    return out


@pytest.mark.parametrize(("grammar", "label"), [("A", "[{}]".format), ("B", "{}.".format), ("C", "{}".format), ("D", lambda n: f"[Ab{n}]")])
def test_one_column(grammar, label):
    got = S.split_entries(entry_lines(label), grammar, False, 900)
    assert got == [f"Reference {n} line one of {n}, Nature {n} (200{n})." for n in range(1, 5)]


@pytest.mark.parametrize("grammar", ["B", "D"])
def test_strict_grammars_need_an_indent(grammar):
    label = "{}.".format if grammar == "B" else lambda n: f"[A{n}]"
    assert S.split_entries(entry_lines(label, further=50), grammar, False, 900) == []


def test_flat_brackets_are_fine():
    assert len(S.split_entries(entry_lines("[{}]".format, further=50), "A", False, 900)) == 4


def test_repeated_number_drops_the_document():
    lines = entry_lines("[{}]".format)
    lines.insert(4, Line(50, 700, "[2] again", 1))
    assert S.split_entries(lines, "A", False, 900) == []


def test_last_entry_without_end():
    lines = entry_lines("[{}]".format, last=700) + [Line(80, 700, "AAAA", 1)] * 6
    assert S.split_entries(lines, "A", False, 900) == []


def test_two_columns():
    left = [Line(x.indent, 400, x.text, 1) for x in entry_lines("[{}]".format)[:4]]
    right = [Line(x.indent + 450, 850, x.text, 1) for x in entry_lines("[{}]".format)[4:]]
    assert len(S.split_entries(left + right, "A", True, 900)) == 4


def test_semicolons_and_weak_rejection():
    lines = [Line(50, 700, "[1] J. Phys. 5, 7 (2001); J. Phys. 6, 8 (2002)", 1), Line(50, 400, "[2] Nature 3 (2003).", 1)]
    assert S.split_entries(lines, "A", False, 900) == ["J. Phys. 5, 7 (2001)", "J. Phys. 6, 8 (2002)", "Nature 3 (2003)."]
    lines[0] = Line(50, 700, "[1] J. Phys. 5, 7 (2001) (2002)", 1)
    assert S.split_entries(lines, "A", False, 900) == []


def pages(n, top=None, bottom=None, body=lambda p: [f"body {chr(96 + p)}{chr(97 + 3 * p)} words", f"other {chr(122 - p) * 9}"]):
    out = []
    for p in range(1, n + 1):
        out.append(Line(L.START, 0, L.PAGE_START, p))
        if top and top(p):
            out.append(Line(50, 700, top(p), p))
        out += [Line(50, 700, t, p) for t in body(p)]
        if bottom and bottom(p):
            out.append(Line(50, 700, bottom(p), p))
        out.append(Line(L.END, 0, L.PAGE_END, p))
    return out


def texts(lines):
    return [x.text for x in lines if x.indent >= 0]


def test_page_numbers_on_top_and_bottom():
    assert not any(t.isdigit() for t in texts(S.without_page_numbers(pages(9, top=str)))[1:])
    assert not any(t.isdigit() for t in texts(S.without_page_numbers(pages(9, bottom=str))))
    assert S.number_places(pages(9, top=str)) == [0] * 7
    assert S.number_places(pages(7, top=str, bottom=str)) == [2] * 6
    assert S.number_places(pages(5)) is None


def test_alternating_page_numbers():
    odd_top = pages(9, top=lambda p: str(p) if p % 2 else None, bottom=lambda p: None if p % 2 else str(p))
    assert S.number_pattern(S.number_places(odd_top)) == 3


def test_a_header_with_digits_is_no_page_number():
    """Each set of up to six digits in the header of eight numbered pages; the numbers stand below."""
    letters = lambda p: [hashlib.md5(f"{p}/{n}".encode()).hexdigest().translate(str.maketrans("0123456789", "ghijklmnop")) for n in range(2)]
    left = lambda k: texts(S.clean(pages(8, top=lambda p: f"A running header of customer {k}", bottom=str, body=letters)))
    body = texts(pages(8, body=letters))
    assert left(21486) == body
    assert all(left("".join(d)) == body for n in range(1, 7) for d in itertools.combinations("0123456789", n))


def test_header_runs_need_three():
    head = "A running header of some length"
    assert head not in texts(S.without_headers(pages(4, top=lambda p: head)))
    assert head in texts(S.without_headers(pages(2, top=lambda p: head)))


def test_even_headers():
    head = "Author names of the paper here"
    assert head not in texts(S.without_headers(pages(8, top=lambda p: head if p % 2 == 0 else "q" * p)))


def test_bibliography_start():
    lines = [Line(50, 700, t, 1) for t in ("Intro", "see References", "References", "[1] a")]
    assert S.bibliography_start(lines) == 3
    lines = [Line(50, 700, t, 1) for t in ("Intro", L.RARE_FONT + "References", "References", "[1] a")]
    assert S.bibliography_start(lines) == 2
    run = [Line(50, 700, f"[{n}] a", 1) for n in range(1, 13)]
    assert S.bibliography_start([Line(50, 700, "x", 1), *run]) == 1
    assert S.bibliography_start([Line(50, 700, f"{n}. a", 1) for n in range(1, 13)]) == -1
    assert S.bibliography_start([Line(50, 700, "x", 1)]) == -1


def test_end_to_end(spark):
    marked = "\n".join([L.PAGE_START, "@d50@dReferences@d200@d", *[f"@d{x.indent}@d{x.text}@d{x.last}@d" for x in entry_lines("[{}]".format)], "no marks", L.PAGE_END])
    docs = spark.createDataFrame([("a", marked), ("b", ""), ("c", None)], "doc_id string, text string")
    lines = L.read_lines(docs)
    assert lines.where("doc_id = 'a'").count() == 11
    got = S.segment(lines).orderBy("pos").collect()
    assert [r["doc_id"] for r in got] == ["a"] * 4 and got[0]["reference"].startswith("Reference 1")
    layouts = spark.createDataFrame([("a", False, 900)], "doc_id string, two_columns boolean, page_width int")
    assert S.segment(lines, layouts).count() == 4
