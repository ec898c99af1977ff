"""String functions, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(c: Column) -> Column:
    """Null, or nothing but white space."""
    return c.isNull() | (F.length(F.trim(F.regexp_replace(c, r"\s", " "))) == 0)


def null_if_blank(c: Column) -> Column:
    return F.when(~blank(c), c)


def title_key(title: Column) -> Column:
    """Blocking key of a title: its lower-case letters; the title itself if it has none."""
    return F.coalesce(F.nullif(F.regexp_replace(F.lower(title), r"[^\p{L}]", ""), F.lit("")), title)


def name_initials(name: Column) -> Column:
    """First letters of a name's words in sorted order, so that word order doesn't matter."""
    words = F.array_sort(F.filter(F.split(name, r"[\s.]"), lambda w: F.trim(w) != ""))
    return F.array_join(F.transform(words, lambda w: F.left(w, F.lit(1))), "")


def initials_key(names: Column) -> Column:
    """Blocking key of an author list: the initials of all authors in order."""
    return F.array_join(F.transform(names, name_initials), ",")


def one_line(text: Column) -> Column:
    """Join wrapped lines: a hyphen between lower-case letters goes, another one stays without a space."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, r"^\s+|\s+$", ""))), lambda x: x != "")
    joined = F.array_join(lines, "\n")
    joined = F.regexp_replace(joined, r"(?<=\p{Ll})-\n(?=\p{Ll})", "")
    joined = F.regexp_replace(joined, r"(?<=[\s\S])-\n", "-")
    return F.regexp_replace(joined, r"\n", " ")


def fragments(parts: Column) -> Column:
    """Join text fragments as they are."""
    return F.array_join(parts, "")


def add_line(ref: Column, line: Column) -> Column:
    """Append a line to a citation. After a hyphen nothing comes between; only a hyphen that stands alone goes."""
    alone = ref.rlike(r"(^|\s)-$") & line.rlike(r"^\p{javaLowerCase}*(\s|$)")
    hyphen = (F.length(ref) > 2) & ref.endswith("-")
    return (
        F.when(hyphen & alone, F.concat(F.left(ref, F.length(ref) - 1), line))
        .when(hyphen, F.concat(ref, line))
        .when(ref == "", line)
        .otherwise(F.concat(ref, F.lit(" "), line))
    )


def join_lines(lines: Column) -> Column:
    """Fold an array of lines into one citation."""
    return F.aggregate(lines, F.lit(""), add_line)


def strip_label(line: Column, pattern: str) -> Column:
    """Drop everything through the end of the first match, and white space after it; null without a match."""
    rest = F.regexp_replace(line, f"(?s)^.*?(?:{pattern.removeprefix('^')})", "") if not pattern.startswith("^") else F.regexp_replace(line, pattern, "")
    return F.when(line.rlike(pattern), F.regexp_replace(rest, r"^\s+", ""))


def split_citations(ref: Column) -> Column:
    """Citations that one string holds, parted by semicolons."""
    return F.filter(F.transform(F.split(ref, ";"), lambda x: F.trim(x)), lambda x: x != "")


def label_value(line: Column, pattern: str = r"^\[?(\d{1,4})") -> Column:
    """The number of a citation label; null if there is none."""
    return F.regexp_extract(line, pattern, 1).try_cast("int")


def before(text: Column, mark: str) -> Column:
    """The part before the first mark; the whole text without it."""
    return F.substring_index(text, mark, 1)


def composite_key(**parts: Column) -> Column:
    """A composite key as JSON; joins don't need it, it serves for export."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in parts.items()]))


def tokens(text: Column) -> Column:
    """Distinct lower-case words for the inverted text index."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
