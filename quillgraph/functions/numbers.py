"""Number and date functions, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_int(text: Column) -> Column:
    """The integer a string is, without white space or a point; null otherwise."""
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))


def first_page(pages: Column) -> Column:
    """The first run of digits."""
    return F.regexp_extract(pages, r"(\d+)\D*(\d*)", 1).try_cast("int")


def last_page(pages: Column) -> Column:
    """The second run of digits."""
    return F.regexp_extract(pages, r"(\d+)\D*(\d*)", 2).try_cast("int")


def expand_last_page(first: Column, last: Column) -> Column:
    """Complete an abbreviated last page from the first one: 1234-56 ends on 1256."""
    f, t = first.cast("string"), last.cast("string")
    short = F.length(t) < F.length(f)
    return F.when(short, F.concat(F.left(f, F.length(f) - F.length(t)), t).try_cast("int")).otherwise(last)


def parse_year(text: Column) -> Column:
    """The first year of the 20th or 21st century in a string."""
    return F.regexp_extract(text, r"(19|20)\d\d", 0).try_cast("int")


def iso_date(text: Column) -> Column:
    """The date that an ISO string begins with; null if it is none."""
    return F.try_to_date(F.left(text, F.lit(10)), "yyyy-MM-dd")


def within_grace(updated: Column, created: Column, start: Column, days: int = 7) -> Column:
    """Updated (else created) after the start or fewer than ``days`` whole days before it."""
    return F.datediff(start, F.coalesce(updated, created)) < days


def progress(done: Column, total: Column) -> Column:
    """Percentage with two digits; null for an empty total."""
    return F.when(total > 0, F.round(done * 100.0 / total, 2))
