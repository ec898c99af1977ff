"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quillgraph.llm.common import discard, materialise

#: Hash bins of the n-grams of one to three characters.
BINS = 1 << 16
#: The model is fitted on about this many labelled rows at most, chosen by a hash of id and text.
TRAIN_ROWS = 20_000
#: Languages scored at once: it bounds the matrix that is broadcast (BINS x languages x 4 bytes). More go in turns.
TOGETHER = 256
#: Characters scored in one step.
STEP = 1 << 18
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
_is_letter = np.array([chr(c).isalpha() for c in range(1 << 16)] + [True])


def codes(text: str) -> np.ndarray:
    """Lower-cased letters as code points, other runs as one space, between two zeros."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter[np.minimum(c, 1 << 16)]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    c = np.where(letter, c, 32)[keep]
    return np.concatenate(([0], c, [0])).astype(np.uint32)


def grams(c: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all n-grams that lie within one text, and the positions where they start; only those before ``most``."""
    h1 = c * np.uint32(0x9E3779B1)
    two = (h1[:-1] ^ (c[1:] * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
    three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    gap = (c[:-1] == 0) & (c[1:] == 0)
    keep1 = np.flatnonzero(c[:most] != 0)
    keep2 = np.flatnonzero(~gap[:most])
    keep3 = np.flatnonzero(~(gap[:-1] | gap[1:])[:most] if len(gap) > 1 else np.empty(0, bool))
    at = np.concatenate((keep1, keep2, keep3))
    return np.concatenate((h1[keep1], two[keep2], three[keep3])) >> np.uint32(16), at


def bins_in_steps(c: np.ndarray):
    """The bins of all n-grams of one text, in steps that overlap by the two codes that an n-gram can reach ahead."""
    for at in range(0, len(c), STEP):
        yield grams(c[at : at + STEP + 2], STEP)[0]


def _count(batches):
    """Counts of n-grams by language over a partition, without the zeros; passed on when there are many languages."""
    found: dict[str, np.ndarray] = {}

    def counted():
        for lang, n in found.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bin": at.astype(np.int32), "n": n[at]})

    for p in batches:
        for lang, text in zip(p["lang"], p["text"]):
            if lang not in found and len(found) == TOGETHER:
                yield from counted()
                found.clear()
            have = found.setdefault(lang, np.zeros(BINS, np.int64))
            for bins in bins_in_steps(codes(text)):
                have += np.bincount(bins, minlength=BINS)
    yield from counted()


class Model:
    """Languages and their log-probabilities for each bin, [BINS, languages]."""

    def __init__(self, langs: list[str], logp: np.ndarray):
        self.langs, self.logp = langs, logp


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", most_rows: int = TRAIN_ROWS) -> Model:
    """Fit on the rows whose text and language are known, on a sample by a hash of id and text if there are more than ``most_rows``.

    Languages count as equally likely beforehand. Without such rows the model knows no language.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    n = rows.count()
    if n > most_rows:
        rows = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40)) < round(most_rows / n * (1 << 40)))
    counts = rows.select("lang", "text").mapInPandas(_count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    counts = materialise(counts)
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    logp = np.empty((BINS, len(langs)), np.float32)
    for at in range(0, len(langs), TOGETHER):
        some = langs[at : at + TOGETHER]
        found = counts.where(F.col("lang").isin(some)).toPandas()
        table = np.full((BINS, len(some)), 0.5)
        table[found["bin"].to_numpy(), np.searchsorted(some, found["lang"].to_numpy(dtype=object))] += found["n"]
        logp[:, at : at + TOGETHER] = np.log(table) - np.log(table.sum(axis=0))
    discard(counts)
    return Model(langs, logp)


def score_batch(model: Model, texts: list[str]) -> np.ndarray:
    """Log-likelihoods [texts, languages]: sums of the matrix rows of each text's bins."""
    out = np.zeros((len(texts), len(model.langs)))
    parts, owner, size = [], [], 0

    def flush() -> None:
        if parts:
            bins, at = grams(np.concatenate(parts))
            own = np.repeat(owner, [len(x) for x in parts])[at]
            for k in range(len(model.langs)):
                out[:, k] += np.bincount(own, weights=model.logp[bins, k], minlength=len(texts))

    for i, text in enumerate(texts):
        c = codes(text)
        if len(c) > STEP:
            for bins in bins_in_steps(c):
                n = np.bincount(bins, minlength=BINS)
                at = np.flatnonzero(n)
                out[i] += n[at] @ model.logp[at].astype(np.float64)
            continue
        parts.append(c)
        owner.append(i)
        size += len(c)
        if size >= STEP:
            flush()
            parts, owner, size = [], [], 0
    flush()
    return out


_KIND = StructType([StructField("lang", StringType()), StructField("top", DoubleType()), StructField("all", DoubleType())])


def _best(spark: SparkSession, model: Model, text: Column) -> Column:
    """Of the model's languages the likeliest, its log-likelihood, and the log of the sum of all; null for null or letterless texts."""
    shared = spark.sparkContext.broadcast((model.langs, model.logp))

    def run(texts: pd.Series) -> pd.DataFrame:
        m = Model(*shared.value)
        values = texts.tolist()
        best, top, every = [None] * len(values), np.full(len(values), np.nan), np.full(len(values), np.nan)
        known = [i for i, x in enumerate(values) if x is not None and LETTER.search(x)]
        for at in range(0, len(known), 256):
            rows = known[at : at + 256]
            s = score_batch(m, [values[i] for i in rows])
            top[rows] = s.max(axis=1)
            every[rows] = top[rows] + np.log(np.exp(s - top[rows][:, None]).sum(axis=1))
            for i, k in zip(rows, s.argmax(axis=1).tolist()):
                best[i] = m.langs[k]
        return pd.DataFrame({"lang": best, "top": top, "all": every})

    return F.pandas_udf(run, _KIND)(text)


def tell(docs: DataFrame, model: Model, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``out`` of ``lang`` and ``score``; all other columns stay. See identify()."""
    spark, found, some = docs.sparkSession, out, f"{out}_some"
    marked = docs.withColumn(found, F.lit(None).cast(_KIND))
    for at in range(0, len(model.langs), TOGETHER):
        best = _best(spark, Model(model.langs[at : at + TOGETHER], model.logp[:, at : at + TOGETHER]), F.col(text_col))
        if not at:
            marked = docs.withColumn(found, best)
            continue
        marked = materialise(marked).withColumn(some, best)
        both = f"""if({some}.lang is null, {found}, named_struct(
            'lang', if({some}.top > {found}.top, {some}.lang, {found}.lang), 'top', greatest({some}.top, {found}.top),
            'all', greatest({some}.all, {found}.all) + ln(1 + exp(-abs({some}.all - {found}.all)))))"""
        marked = marked.withColumn(found, F.expr(both)).drop(some)
    score = F.when(F.col(f"{found}.lang").isNotNull(), F.least(F.lit(1.0), F.exp(F.col(f"{found}.top") - F.col(f"{found}.all")))).otherwise(0.0)
    return marked.withColumn(found, F.struct(F.coalesce(f"{found}.lang", F.lit(UNKNOWN)).alias("lang"), score.alias("score")))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the posterior probability); columns of these names are replaced.

    Null texts and texts without a letter are ``und`` with score 0, as is every text if the model knows no
    language. Repeated rows stay; ties go to the first language in order; an empty table gives no rows. Texts of any
    length count whole. Beyond TOGETHER languages the table is written once for each further set of them.
    """
    told = tell(docs, model, "_quill_lang", text_col)
    return told.withColumns({"lang_pred": F.col("_quill_lang.lang"), "score": F.col("_quill_lang.score")}).drop("_quill_lang")


def held_out(id_col: str, parts: int = 4, part: int = 2) -> Column:
    """Whether a row is kept from training, by the CRC-32 of its id as text; a null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out("doc_id")))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
