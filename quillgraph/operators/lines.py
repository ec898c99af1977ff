"""Positioned text lines: reading marked text, page structure, and native page-furniture filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Marks in the text, and the indents that stand for page marks.
PAGE_START, PAGE_END, RARE_FONT, COORDINATE = "\\@ps\\", "\\@pe\\", "\\r\\", "@d"
START, END = -1, -2


def _doc():
    """A document's lines in order; made on use, as workers import this module without a session."""
    return W.partitionBy("doc_id").orderBy("line_no")


def read_lines(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Split marked text into lines. A line without a well-formed coordinate at both ends is left out; page marks stay.

    Columns: ``doc_id``, ``line_no``, ``indent``, ``last_pos``, ``str``, ``page_no`` (page starts so far).
    """
    mark = rf"{COORDINATE}(\d{{1,3}}){COORDINATE}"
    rows = texts.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "raw"))
    framed = F.col("raw").rlike(f"^{mark}") & F.col("raw").rlike(f"{mark}$")
    rows = rows.withColumns({
        "indent": F.when(framed, F.regexp_extract("raw", f"^{mark}", 1).cast("int")).when(F.col("raw") == PAGE_START, START).when(F.col("raw") == PAGE_END, END),
        "last_pos": F.when(framed, F.regexp_extract("raw", f"{mark}$", 1).cast("int")).otherwise(0),
        "str": F.when(framed, F.regexp_replace("raw", mark, "")).otherwise(F.col("raw")),
    })
    return page_numbers(rows).where("indent is not null").drop("raw")


def page_numbers(lines: DataFrame) -> DataFrame:
    """``page_no``: how many pages have begun."""
    return lines.withColumn("page_no", F.sum(F.when(F.col("indent") == START, 1).otherwise(0)).over(_doc()).cast("int"))


def page_edges(lines: DataFrame) -> DataFrame:
    """``is_first`` and ``is_last``: right after a page's start, right before its end."""
    return lines.withColumns({
        "is_first": F.coalesce(F.lag("indent").over(_doc()) == START, F.lit(False)),
        "is_last": F.coalesce(F.lead("indent").over(_doc()) == END, F.lit(False)),
    })


def trimmed(lines: DataFrame) -> DataFrame:
    """Without blank lines, white space at the ends removed."""
    return lines.where(~F.col("str").rlike(r"^\s*$")).withColumn("str", F.regexp_replace("str", r"^\s+|\s+$", ""))


def without_marks(lines: DataFrame) -> DataFrame:
    return lines.where("indent >= 0")


def drop_number_lines(lines: DataFrame) -> DataFrame:
    """Drop every page's first line if all of them but the first page's are digits only, else the last lines likewise."""
    rows = page_edges(lines)
    nth = lambda c: F.sum(F.col(c).cast("int")).over(_doc())
    rows = rows.withColumns({"_f": nth("is_first"), "_l": nth("is_last")})
    digits = lambda c, n: F.coalesce(F.bool_and(F.when(F.col(c) & (F.col(n) > 1), F.col("str").rlike(r"^\d*$"))).over(W.partitionBy("doc_id")), F.lit(True))
    rows = rows.withColumns({"_first": digits("is_first", "_f"), "_last": digits("is_last", "_l")})
    gone = F.when(F.col("_first"), F.col("is_first")).when(F.col("_last"), F.col("is_last")).otherwise(False)
    return rows.where(~gone).select(lines.columns)


def after_heading(lines: DataFrame) -> DataFrame:
    """Lines after the last bibliography heading: one in a rare font if there is any, else one that begins a line."""
    heading = F.col("str").rlike("References|REFERENCES")
    rare = F.contains("str", F.lit(f"{RARE_FONT}References")) | F.contains("str", F.lit(f"{RARE_FONT}REFERENCES"))
    all_of = W.partitionBy("doc_id")
    at = lambda c: F.max(F.when(c, F.col("line_no"))).over(all_of)
    rows = lines.withColumn("_at", F.coalesce(at(rare), at(heading & ~F.col("str").rlike(r"^\p{Ll}"))))
    return rows.where(F.col("line_no") > F.col("_at")).drop("_at")


def grammar(first_line: Column) -> Column:
    """The label grammar that a bibliography's first line shows: A '[n]', B 'n.', C 'n', D '[text]', or null."""
    return F.when(first_line.rlike(r"^\[1]"), "A").when(first_line.rlike(r"1\."), "B").when(first_line.rlike("1 "), "C").when(first_line.rlike(r"^\[.*?]"), "D")


def commonest_width(widths: DataFrame, by: str, width: str) -> DataFrame:
    """The most frequent width of each group, the smallest on ties; other fonts count as rare."""
    counts = widths.groupBy(by, width).agg(F.count("*").alias("n"))
    return counts.groupBy(by).agg(F.max_by(width, F.struct("n", -F.col(width))).alias("width"), F.max("n").alias("n"))


def running_width(lines: DataFrame) -> DataFrame:
    """The widest line so far."""
    return lines.withColumn("widest", F.max(F.col("last_pos") - F.col("indent")).over(_doc()))
