"""Journal references as published strings, taken apart by rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillgraph.functions.numbers import parse_year


def parse_journal(raw: Column) -> Column:
    """A struct of title, volume, number, first_page, last_page and year from strings like 'J. Phys. A 12, no. 3, 45-67 (1990)'.

    The title goes up to the first number, which is the volume; a number in 'no.' or brackets after it is the issue, if
    it isn't a year; pages follow. Parts that don't show are null. An approximation of a trained parser.
    """
    some = lambda p, k: F.nullif(F.regexp_extract(raw, p, k), F.lit(""))
    title = F.nullif(F.regexp_replace(F.regexp_extract(raw, r"^([^\d(]*)", 1), r"(?i)[\s,]*(?:vol\.?)?[\s,]*$", ""), F.lit(""))
    volume = some(r"^[^\d(]*(\d+[A-Z]?)", 1)
    number = F.coalesce(some(r"(?i)\bno\.?\s*(\d+)", 1), some(r"^[^\d(]*\d+[A-Z]?\s*\((\d{1,3})\)", 1))
    rest = F.regexp_replace(F.regexp_replace(raw, r"^[^\d(]*\d+[A-Z]?", ""), r"(?i)\bno\.?\s*\d+|\(\d+\)", " ")
    first = F.regexp_extract(rest, r"(\d+)", 1).try_cast("int")
    last = F.regexp_extract(rest, r"\d+\s*(?:-|--|\x{2013})\s*(\d+)", 1).try_cast("int")
    in_brackets = F.regexp_extract(raw, r"\(((?:19|20)\d\d)\)", 1).try_cast("int")
    return F.struct(title.alias("title"), volume.alias("volume"), number.alias("number"), first.alias("first_page"), last.alias("last_page"), F.coalesce(in_brackets, parse_year(rest)).alias("year"))


#: A name with its initials before or after it (not 'J. Phys. A 7'), and a journal's abbreviated or whole name before its volume.
_NAME = r"(?:(?:\p{Lu}\.[\s-]?)+\s?\p{Lu}[\p{L}'-]+(?![\p{L}'-])(?!\.\s?(?:\p{Lu}\b)?\s*\d)|\p{Lu}[\p{L}'-]+,?\s(?:\p{Lu}\.[\s-]?)+)"
_JOURNAL = r"(?:(?:\p{Lu}\p{L}*\.\s?){1,5}(?:\p{Lu}\b)?|Nature|Science|\p{Lu}\w+ Journal[\w ]*|Journal of [\p{L} ]+?)[,\s]*(?:[Vv]ol\.?\s*)?\d"


def parse_citation(raw: Column) -> Column:
    """A struct of authors, title, journal, volume, issue, first_page, last_page and year from a whole citation string.

    After a label come the authors, the title up to the journal (or in quotes), and the journal as parse_journal() reads
    it. Parts that don't show are null, missing authors an empty list. An approximation of a trained parser.
    """
    body = F.regexp_replace(raw, r"^\s*(?:\[[^\]]*\]|\d{1,4}\.)\s*", "")
    lead = F.regexp_extract(body, rf"^({_NAME}(?:\s*(?:,|;|and|&|,\s*and)\s*{_NAME})*)", 1)
    rest = F.regexp_replace(F.substr(body, F.length(lead) + 1), r"^[\s,.:;]*(?:et al\.?)?[\s,.:;]*", "")
    quoted = F.regexp_extract(rest, r"[\x{201C}\"]([^\x{201D}\"]+)[\x{201D}\"]", 1)
    before = F.regexp_extract(rest, rf"^(.*?)[\s,.:;]*{_JOURNAL}", 1)
    tail = F.regexp_extract(rest, rf"^.*?({_JOURNAL}.*)$", 1)
    title = F.coalesce(F.nullif(F.regexp_replace(quoted, r"[\s,.]+$", ""), F.lit("")), F.when(before.rlike(r"\p{L}{2,}\s+\p{L}"), before))
    j = parse_journal(F.nullif(tail, F.lit("")))
    year = F.coalesce(j["year"], parse_year(F.regexp_extract(body, r"\b((?:19|20)\d\d)\b", 1)))
    return F.struct(
        F.coalesce(F.transform(F.regexp_extract_all(lead, F.lit(f"({_NAME})"), F.lit(1)), lambda a: F.trim(a)), F.array().cast("array<string>")).alias("authors"), title.alias("title"), j["title"].alias("journal"),
        j["volume"].alias("volume"), j["number"].alias("issue"), j["first_page"].alias("first_page"), j["last_page"].alias("last_page"), year.alias("year"),
    )
