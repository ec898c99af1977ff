"""Identifiers in citation strings and file names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Archives of old-style identifiers, in the order in which they are tried; one is listed twice.
PREFIXES = """
astro-ph cond-mat gr-qc hep-ex hep-lat hep-ph hep-th math-ph nlin nucl-ex nucl-th physics quant-ph q-bio q-fin stat
eess econ adap-org patt-sol comp-gas chao-dyn funct-an alg-geom q-alg alg-geom dg-ga solv-int cmp-lg math cs
""".split()

MARK = "arxiv:"


def contains_id(text: Column) -> Column:
    """Whether a string names an identifier: an archive and three digits, or the mark, whatever the case."""
    any_prefix = "|".join(dict.fromkeys(PREFIXES))
    return F.lower(text).rlike(f"(?:{any_prefix})/\\d\\d\\d|{MARK}")


def count_ids(text: Column) -> Column:
    """Old-style identifiers by archive; an archive whose name ends like another's counts for both."""
    low = F.lower(text)
    return reduce(lambda a, b: a + b, [F.regexp_count(low, F.lit(f"{p}/\\d\\d\\d")) for p in PREFIXES])


def contains_multiple_ids(text: Column) -> Column:
    return (count_ids(text) > 1) | (F.regexp_count(F.lower(text), F.lit(MARK)) > 1)


def arxiv_id(raw: Column) -> Column:
    """The identifier a citation string names, or '' if none; null stays null.

    What follows the last mark decides if it is a digit and the string goes on for more than eight characters: a
    new-style number, else whatever leads to the digits after the first slash. Without a digit after a mark, the
    first archive in order that occurs decides, by its first occurrence, with digits after the slash or not.
    """
    tail = F.regexp_extract(raw, r"(?is)^.*arxiv:(.*)$", 1)
    marked = tail.rlike(r"^\d")
    new = F.regexp_extract(tail, r"^\d{4}\.\d*", 0)
    old = F.regexp_extract(tail, r"(?s)^[^/]*/\d*", 0)
    from_mark = F.when(F.length(tail) <= 8, "").when(tail.rlike(r"^\d{4}\."), new).otherwise(old)
    chain = F.when(raw.isNull(), F.lit(None).cast("string")).when(marked, from_mark)
    for p in dict.fromkeys(PREFIXES):
        q = p.replace("-", "\\-")
        plain = F.concat(F.lit(f"{p}/"), F.regexp_extract(F.substr(raw, F.locate(f"{p}/", raw) + len(p) + 1), r"^\d+", 0))
        chain = chain.when(raw.contains(f"{p}/"), F.when(plain != f"{p}/", plain).otherwise(""))
        digits = F.regexp_extract(raw, f"{q}\\.\\p{{Upper}}{{2}}/(\\d*)", 1)
        chain = chain.when(raw.rlike(f"{q}\\.\\p{{Upper}}{{2}}/"), F.when(digits != "", F.concat(F.lit(f"{p}/"), digits)).otherwise(""))
    return chain.otherwise("")


def id_from_filename(path: Column) -> Column:
    """hep-th9901001.pdf stands for hep-th/9901001; a name that begins with a digit stays as it is, ending included."""
    name = F.regexp_extract(path, r"[^/]*$", 0)
    return F.when(name.rlike(r"^\d"), name).otherwise(F.regexp_replace(name, r"^([^\d]*)(\d.*).{4}$", "$1/$2"))
