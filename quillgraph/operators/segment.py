"""Segmenting positioned lines into bibliography entries.

The rules look back and ahead over a document's lines, so a document is handled as a whole: lines are dealt by document,
sorted, and streamed through one function that holds a document at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame

from quillgraph.functions.ids import MARK, PREFIXES
from quillgraph.functions.similarity import subsequence
from quillgraph.operators.lines import END, RARE_FONT, START

YEAR = re.compile(r"(19|20)\d\d")
YEAR_IN_BRACKETS = re.compile(r"\((19|20)\d\d\)")
_id = re.compile("|".join([f"(?:{p})/\\d\\d\\d" for p in dict.fromkeys(PREFIXES)] + [MARK]))


@dataclass
class Line:
    indent: int
    last: int
    text: str
    page: int
    number: int = -1

    @property
    def width(self) -> int:
        return self.last - self.indent


@dataclass(frozen=True)
class Grammar:
    label: re.Pattern
    numbered: bool
    strict: bool


#: The label at the start of each entry, and the first line that selects the grammar, tried in order.
GRAMMARS = {
    "A": (r"^\[\d{1,4}]", r"^\[1]", True, False),
    "B": (r"^\d{1,4}\.", r"1\.", True, True),
    "C": (r"^\d{1,4}", r"1 ", True, True),
    "D": (r"^\[.*?]", r"^\[.*?]", False, True),
}


@dataclass(frozen=True)
class Layout:
    """What differs between pages of one and two columns."""

    columns: int
    page_width: int

    def side(self, line: Line) -> int:
        return int(self.columns == 2 and line.indent >= self.page_width * 0.4)

    @property
    def long_entry(self) -> int:
        return 5 if self.columns == 1 else 10

    @property
    def longest_last(self) -> int:
        return 5 if self.columns == 1 else 9

    @property
    def full_line(self) -> float:
        return 0.9 if self.columns == 1 else 0.8


class Inconsistent(Exception):
    """The lines contradict the grammar; the whole document is left to another extractor."""


def names_id(text: str) -> bool:
    return bool(_id.search(text.lower()))


def names_several_ids(text: str) -> bool:
    low = text.lower()
    return sum(len(re.findall(f"{p}/\\d\\d\\d", low)) for p in PREFIXES) > 1 or low.count(MARK) > 1


def append(entry: str, line: str) -> str:
    if len(entry) > 2 and entry[-1] == "-":
        alone = len(entry.split()[-1]) == 1 and not entry[-1].isspace()
        word = re.match(r"\S*", line)[0]
        return entry[:-1] + line if alone and all(c.islower() for c in word) else entry + line
    return f"{entry} {line}" if entry else line


def parse_fields(raw: str) -> dict:
    """Rule-based stand-in for a statistical citation parser: authors, journal and year, as far as they show.

    An approximation behind the same interface; pass another function to split_entries for better fields.
    """
    year = YEAR.search(raw)
    journal = re.search(r"((?:[A-Z][A-Za-z]*\.\s?){1,5}(?:[A-Z]\b)?|Nature|Science|[A-Z]\w+ Journal[\w ]*)[,\s]*(?:vol\.?\s*)?\d+", raw)
    authors = re.findall(r"(?:[A-Z]\.[\s-]?)+\s?[A-Z][\w'-]+|[A-Z][\w'-]+,\s(?:[A-Z]\.[\s-]?)+", raw)
    return {"authors": authors, "journal": journal[1].strip() if journal else None, "year": int(year[0]) if year else None}


def not_a_reference(raw: str, parser: Callable[[str], dict] = parse_fields) -> bool:
    """Whether neither journal nor year nor an identifier beside authors is there."""
    f = parser(raw)
    return not (f["journal"] or f["year"] is not None or (names_id(raw) and f["authors"]))


def several_references(raw: str) -> bool:
    return names_several_ids(raw) or len(YEAR_IN_BRACKETS.findall(raw)) > 1


class Entries:
    """Where entries begin, and the indents of their further lines."""

    def __init__(self, lines: list[Line], g: Grammar, layout: Layout):
        self.lines, self.g, self.layout = lines, g, layout
        self.starts, self.widest, self.aligned = [0], lines[0].width, True
        self.further: dict[int, int] = {}
        while (at := self._next(self.starts[-1])) is not None:
            for line in lines[self.starts[-1] + 1 : at]:
                self.aligned &= self.further.setdefault(layout.side(line), line.indent) == line.indent
            self.starts.append(at)
            self.widest = max(self.widest, lines[at].width)
        self.aligned &= bool(self.further)
        if g.strict and not self.aligned:
            raise Inconsistent("entries are not told apart by indent")

    def _next(self, start: int) -> int | None:
        number = len(self.starts)
        for at in range(start + 1, len(self.lines)):
            line = self.lines[at]
            found = self.g.label.search(line.text)
            if not found:
                continue
            as_further = line.indent == self.further.get(self.layout.side(line), -1)
            value = int(re.sub(r"\D", "", found[0])) if self.g.numbered else number + 1
            if value == number + 1:
                if self.g.strict and as_further:
                    raise Inconsistent("a label stands at the indent of further lines")
                return at
            if value == number or (not as_further and not self.g.strict):
                raise Inconsistent("labels are out of order")
        return None

    def _text(self, at: int, first: bool) -> str:
        if not first:
            return self.lines[at].text
        found = self.g.label.search(self.lines[at].text)
        if not found:
            raise Inconsistent("an entry without a label")
        return self.lines[at].text[found.end() :].lstrip()

    def _short(self, at: int, share: float) -> bool:
        return self.lines[at].last < self.lines[at - 1].last * share

    def inner(self, start: int, end: int) -> str:
        """An entry that another follows: stops at a short line, or parts there if what follows looks like a citation."""
        one = self.layout.columns == 1
        more = any(names_id(x.text) or YEAR.search(x.text) for x in self.lines[start + 1 : end])
        entry, parted, before = "", False, 0
        for at in range(start, end):
            line, side = self.lines[at], self.layout.side(self.lines[at])
            new = self._text(at, at == start)
            entry = append(entry, new)
            closed = entry.strip() and entry[-1] != ";" and (entry[-1] == "." or end - start > self.layout.long_entry or parted)
            narrow = line.width < self.widest * self.layout.full_line
            if one:
                closed = closed and entry[-1] != "," and not names_id(new)
                ends = narrow if at == start else self._short(at, 0.9)
            else:
                ends = narrow or (at != start and side == before and self._short(at, 0.9))
            if closed and ends:
                if not more:
                    break
                entry, parted = entry + ";", True
            before = side
        return entry

    def last(self, start: int) -> str:
        """The last entry, whose end shows only by indents and short lines."""
        entry, before = "", 0
        for n, at in enumerate(range(start, len(self.lines))):
            line, side = self.lines[at], self.layout.side(self.lines[at])
            entry = append(entry, self._text(at, at == start))
            if n >= self.layout.longest_last:
                raise Inconsistent("the last entry has no end")
            following = self.lines[at + 1] if at + 1 < len(self.lines) else None
            if self.aligned and following and following.indent not in self.further.values():
                break
            if at > start:
                if (self.layout.columns == 1 or before == side) and self._short(at, 0.9):
                    break
            elif line.width < self.layout.full_line * self.widest and not (following and names_id(following.text)) and entry[-1:] != ",":
                break
            before = side
        return entry


def split_entries(lines: list[Line], name: str, two_columns: bool, page_width: int, parser: Callable[[str], dict] = parse_fields) -> list[str]:
    """The bibliography entries of a document's lines, or none at all if anything is inconsistent."""
    label, _, numbered, strict = GRAMMARS[name]
    try:
        e = Entries(lines, Grammar(re.compile(label), numbered, strict), Layout(2 if two_columns else 1, page_width))
        raw = [e.inner(a, b) for a, b in zip(e.starts, e.starts[1:])] + [e.last(e.starts[-1])]
    except Inconsistent:
        return []
    out = []
    for entry in raw:
        parts = [p.strip() for p in entry.split(";") if p.strip()]
        if (len(parts) > 1 and any(not_a_reference(p, parser) for p in parts)) or any(several_references(p) for p in parts):
            return []
        out += parts
    return out


# Page furniture.


def first_lines(lines: list[Line]) -> list[int]:
    return [i + 1 for i, x in enumerate(lines[:-1]) if x.indent == START]


def last_lines(lines: list[Line]) -> list[int]:
    return [i - 1 for i, x in enumerate(lines) if x.indent == END and i]


def number_places(lines: list[Line]) -> list[int] | None:
    """For pages 2 to 8 where the page number stands: 0 first line, 1 last, 2 both; None if a page has none.

    Unlike the published rules, which stop at the first line of page 8, that page is looked at whole: else a header that
    happens to hold an 8 counts as its number, whatever its last line says.
    """
    places: list[int] = []
    for i, line in enumerate(lines):
        if line.page == 1:
            continue
        if line.page > 8:
            break
        after = lines[i + 1] if i + 1 < len(lines) else None
        if line.indent == START and after and str(line.page) in after.text:
            places.append(0)
        if after and after.indent == END:
            if str(line.page) in line.text:
                if len(places) + 1 == line.page:
                    places[-1] = 2
                else:
                    places.append(1)
            if len(places) + 1 < line.page:
                return None
    return places


def number_pattern(places: list[int]) -> int | None:
    """0 first lines, 1 last lines, 2 and 3 alternating, 4 both; None if it can't be told."""
    in_first, in_last = {0, 2}, {1, 2}
    if len(places) < 6:
        return 0 if set(places) <= {0} else 1 if set(places) <= {1} else None
    even, odd = set(places[::2]), set(places[1::2])
    if set(places) == {2}:
        return 4
    tests = ((in_first, in_first), (in_last, in_last), (in_first, in_last), (in_last, in_first))
    return next((k for k, (e, o) in enumerate(tests) if even <= e and odd <= o), None)


def without_page_numbers(lines: list[Line]) -> list[Line]:
    places = number_places(lines)
    pattern = None if places is None else number_pattern(places)
    if pattern is None:
        return _without_digit_lines(lines)

    def goes(line: Line, first: bool) -> bool:
        if pattern in (0, 1):
            return first == (pattern == 0) and str(line.page) in line.text
        if pattern == 2:
            return first == (line.page % 2 == 1)
        # As published: the test of the last lines is always true.
        return not first or line.page % 2 == 0 if pattern == 3 else True

    out = []
    for i, line in enumerate(lines):
        if i > 1 and lines[i - 1].indent == START:
            gone = goes(line, True)
        else:
            gone = i + 1 < len(lines) and lines[i + 1].indent == END and goes(line, False)
        if not gone:
            out.append(line)
    return out


def _without_digit_lines(lines: list[Line]) -> list[Line]:
    digits = lambda where: all(all(c.isdigit() for c in lines[i].text) for i in where[1:])
    for where in (first_lines(lines), last_lines(lines)):
        if digits(where):
            gone = set(where)
            return [x for i, x in enumerate(lines) if i not in gone]
    return lines


def header_runs(texts: list[str]):
    """Runs of three or more lines that share a running header, as (first, after the last)."""
    i = 1
    while i < len(texts):
        common = subsequence(texts[i - 1], texts[i])
        if len(common) <= 1 or len(common) <= 0.75 * max(len(texts[i - 1]), len(texts[i])):
            i += 1
            continue
        j = i + 1
        while j < len(texts):
            rest = len(subsequence(common, texts[j]))
            alike = rest == len(common) or (len(common) > 15 and len(common) - rest < 4)
            if rest <= 0.75 * len(texts[j]) or not alike:
                break
            j += 1
        if j - (i - 1) >= 3:
            yield i - 1, j
        i = j + 1


def without_headers(lines: list[Line]) -> list[Line]:
    """Blank running headers among all, even and odd first and last lines, one list after the other; drop blank lines."""
    lines = [replace(x) for x in lines]
    first, last = first_lines(lines), last_lines(lines)
    for where in (first, last, first[::2], last[::2], first[1::2], last[1::2]):
        for a, b in list(header_runs([lines[i].text for i in where])):
            for i in where[a:b]:
                lines[i].text = ""
    return [x for x in lines if x.text]


def clean(lines: list[Line]) -> list[Line]:
    """Trim, and remove page numbers and headers until nothing changes."""
    lines = [replace(x, text=x.text.strip()) for x in lines if x.text.strip()]
    while True:
        left = without_headers(without_page_numbers(lines))
        if len(left) == len(lines):
            return left
        lines = left


def bibliography_start(lines: list[Line]) -> int:
    """Index of the first line after the heading, or of a numbered run that ends the document; -1 if there is none."""
    heads = ("References", "REFERENCES")
    rare = [i for i, x in enumerate(lines) if any(RARE_FONT + h in x.text for h in heads)]
    plain = [i for i, x in enumerate(lines) if any(h in x.text for h in heads) and not x.text[:1].islower()]
    if rare or plain:
        return (rare or plain)[-1] + 1
    most = range(50, 0, -10)
    for top in most:
        if (at := _run(lines, top, r"\[{}]")) != -1:
            return at
    for top in most:
        # As published: a run of 'n.' labels is found but its place is not returned.
        if _run(lines, top, r"{}\.[^\d]") != -1:
            return -1
        if (at := _run(lines, top, r"{}[^\d]")) != -1:
            return at
    return -1


def _run(lines: list[Line], top: int, label: str) -> int:
    """Index of label 1 of a run that goes from ``top`` down to 1, read backwards, with no page skipped."""
    at, page = len(lines) - 1, None
    for n in range(top, 0, -1):
        pattern = re.compile(label.format(n))
        while at >= 0:
            if page is not None and page - lines[at].page > 1:
                return -1
            if pattern.match(lines[at].text):
                page = lines[at].page
                break
            at -= 1
    return at


def extract(lines: list[Line], two_columns: bool, page_width: int, pages: int, parser: Callable[[str], dict] = parse_fields) -> list[str]:
    """From raw lines to entries; none if a long document gives too few, so that a caller can fall back."""
    lines = clean(lines)
    at = bibliography_start(lines)
    body = [x for x in lines[at:] if x.indent >= 0] if at != -1 else []
    name = next((k for k, g in GRAMMARS.items() if re.search(g[1], body[0].text)), None) if body else None
    found = [r.strip() for r in split_entries(body, name, two_columns, page_width, parser)] if name else []
    found = [r for r in found if r]
    return [] if pages > 40 and len(found) / pages < 0.7 else found


def segment(lines: DataFrame, layouts: DataFrame | None = None, page_width: int = 900) -> DataFrame:
    """Entries of each document: ``doc_id``, ``pos``, ``reference``.

    ``lines`` as from read_lines(); ``layouts`` has ``doc_id``, ``two_columns`` and ``page_width`` where they are known.
    """
    given = layouts is not None
    if given:
        lines = lines.join(layouts.select("doc_id", "two_columns", "page_width"), "doc_id", "left")
    columns = ["doc_id", "line_no", "indent", "last_pos", "str", "page_no", *(["two_columns", "page_width"] if given else [])]

    def entries(rows: list[tuple]) -> list[tuple]:
        two, width = (bool(rows[0][6]), int(rows[0][7])) if given and pd.notna(rows[0][6]) else (False, page_width)
        found = extract([Line(r[2], r[3], r[4], r[5]) for r in rows], two, width, max(r[5] for r in rows))
        return [(str(rows[0][0]), n, x) for n, x in enumerate(found)]

    return _by_document(lines.select(columns), entries, "doc_id string, pos int, reference string")


def without_furniture(lines: DataFrame) -> DataFrame:
    """Lines without page numbers and running headers, removed until nothing changes."""
    columns = ["doc_id", "line_no", "indent", "last_pos", "str", "page_no"]

    def kept(rows: list[tuple]) -> list[tuple]:
        left = clean([Line(r[2], r[3], r[4], r[5], r[1]) for r in rows])
        return [(str(rows[0][0]), x.number, x.indent, x.last, x.text, x.page) for x in left]

    return _by_document(lines.select(columns), kept, "doc_id string, line_no int, indent int, last_pos int, str string, page_no int")


def _by_document(lines: DataFrame, f: Callable[[list[tuple]], list[tuple]], schema: str) -> DataFrame:
    """Apply a function to each document's rows in order, one document in memory at a time."""
    columns, names = lines.columns, [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        held: list[tuple] = []
        for p in batches:
            out: list[tuple] = []
            for row in zip(*(p[c].tolist() for c in columns)):
                if held and held[0][0] != row[0]:
                    out += f(held)
                    held = []
                held.append(row)
            yield pd.DataFrame(out, columns=names)
        if held:
            yield pd.DataFrame(f(held), columns=names)

    return lines.repartition("doc_id").sortWithinPartitions("doc_id", "line_no").mapInPandas(run, schema)
