"""Document fingerprints by one-permutation MinHash. DataFrame operations only.

Each five-word shingle is hashed once; the upper bits choose one of 128 bins and a bin keeps its smallest hash. An
empty bin takes the value of the full bin that comes first in an order of the bins drawn for that empty bin (optimal
densification), so two texts fill it alike as often as they are alike. Of each bin the eight lowest bits are stored,
and the share of equal bins is corrected for chance agreement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm.common import materialise, pieces

BINS = 128
BIN_BITS = 7
LOW_BITS = 8
SHINGLE = 5
#: Sorts below all ids; stands for a null id in join keys.
NO_ID = -(1 << 63)


def fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the packed fingerprint (binary, one byte for each bin; empty without words).

    Shorter texts are one shingle. The steps are columns of their own, so that no lambda evaluates another again.
    """
    low = (1 << LOW_BITS) - 1
    words, hashes, firsts = f"{out}_w", f"{out}_h", f"{out}_f"
    bin_of = lambda x: F.shiftrightunsigned(x, 64 - BIN_BITS)
    df = df.withColumn(words, F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), ""))
    starts = F.expr(f"if(size({words}) = 0, array(), sequence(0, greatest(0, size({words}) - {SHINGLE})))")
    shingle = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(SHINGLE)]))
    df = df.withColumn(hashes, F.sort_array(shingle)).drop(words)
    first = F.filter(F.col(hashes), lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col(hashes), i - 1))))
    df = df.withColumn(firsts, first).drop(hashes)
    full = F.transform(F.col(firsts), lambda x: F.shiftleft(bin_of(x), LOW_BITS).bitwiseOR(x.bitwiseAND(F.lit(low))))
    empty = F.array_except(F.sequence(F.lit(0).cast("long"), F.lit(BINS - 1).cast("long")), F.transform(F.col(firsts), bin_of))
    borrowed = lambda i: F.array_min(F.transform(F.col(firsts), lambda x: F.xxhash64(i, bin_of(x)).bitwiseAND(F.lit(~low)).bitwiseOR(x.bitwiseAND(F.lit(low)))))
    filled = F.transform(empty, lambda i: F.shiftleft(i, LOW_BITS).bitwiseOR(borrowed(i).bitwiseAND(F.lit(low))))
    bins = F.sort_array(F.when(F.size(firsts) > 0, F.concat(full, filled)).otherwise(F.array().cast("array<long>")))
    digits = F.array(*[F.lit(f"{b:02x}") for b in range(low + 1)])
    packed = F.unhex(F.array_join(F.transform(bins, lambda p: F.get(digits, p.bitwiseAND(F.lit(low)).cast("int"))), ""))
    return df.withColumn(out, packed).drop(firsts)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two packed fingerprints, 0 to 1. Two without words are alike, one without is not."""
    same = F.aggregate(F.sequence(F.lit(1), F.lit(BINS)), F.lit(0), lambda n, i: n + (F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))).cast("int"))
    chance = 1 / (1 << LOW_BITS)
    estimate = F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))
    none = (F.octet_length(a) == 0) | (F.octet_length(b) == 0)
    return F.when(a == b, 1.0).when(none, 0.0).otherwise(estimate)


def next_documents(rows: DataFrame) -> DataFrame:
    """For each distinct (kid, h) the next one in order, and after the last the first: ``next_kid``, ``next_h``.

    Rows are dealt by range and numbered within each range; only the first row of each range crosses ranges.
    """
    spark = rows.sparkSession
    rows = rows.groupBy("kid", "h").agg(F.first("n").alias("n"))
    parts = pieces(rows.count(), 200_000, spark, 2000)
    dealt = materialise(rows.repartitionByRange(parts, "kid", "h").withColumn("block", F.spark_partition_id()))
    lead = dealt.selectExpr("*", "lead(struct(kid, h)) over (partition by block order by kid, h) as next")
    heads = dealt.groupBy("block").agg(F.min(F.struct("kid", "h")).alias("head"))
    heads = heads.selectExpr("block", "coalesce(lead(head) over (order by block), first(head) over (order by block)) as after")  # a row for each range
    out = lead.join(heads, "block").withColumn("next", F.coalesce("next", "after"))
    return out.select("kid", "h", "n", F.col("next.kid").alias("next_kid"), F.col("next.h").alias("next_h"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how alike they are.

    A text of n code points is edited by replacing its last floor(n / 4) by as many (or all) from the start of the
    next document in order of id; after the last comes the first. Returns a row for each input row: ``doc_id``,
    ``n_chars``, ``edited_sha256``, ``fingerprint`` and ``edited_fingerprint`` (hex; empty without words),
    ``near_edited``, ``near_next``.

    A null text is empty. Rows with the same id follow each other by a hash of the text; rows with the same id and
    text are one document and each get its result; null ids come first and follow each other in the same way. An
    empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("kid"), F.xxhash64(text).alias("h"), text.alias("text"))
    order = materialise(next_documents(rows.select("kid", "h", F.char_length("text").cast("long").alias("n"))))
    give = order.select(F.col("next_kid").alias("kid"), F.col("next_h").alias("h"), F.col("kid").alias("to_kid"), F.col("h").alias("to_h"), "n")
    heads = rows.join(give, ["kid", "h"]).select(F.col("to_kid").alias("kid"), F.col("to_h").alias("h"), F.expr("substring(text, 1, cast(n div 4 as int))").alias("head"))
    heads = heads.groupBy("kid", "h").agg(F.first("head").alias("head"))
    n = F.char_length("text")
    pair = rows.join(heads, ["kid", "h"]).select("kid", "h", "text", F.expr("concat(substring(text, 1, char_length(text) - char_length(text) div 4), head)").alias("edited"))
    pair = pair.withColumns({"n_chars": n.cast("long"), "sha": F.unhex(F.sha2("edited", 256))})
    pair = fingerprint(pair, "text", "own").drop("text")
    pair = fingerprint(pair, "edited", "new").drop("edited")
    marks = materialise(pair.join(order.drop("n"), ["kid", "h"]))
    after = marks.groupBy(F.col("kid").alias("next_kid"), F.col("h").alias("next_h")).agg(F.first("own").alias("next_own"))
    out = marks.join(after, ["next_kid", "next_h"])
    return out.select(
        F.when(F.col("kid") != NO_ID, F.col("kid")).alias("doc_id"), "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"),
        F.lower(F.hex("own")).alias("fingerprint"), F.lower(F.hex("new")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("new")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
