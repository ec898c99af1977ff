"""The corpus pipeline: language ID, SimHash near-dedup, substring dedup, packing.

Every stage takes the documents that its predecessor kept and, but for the last, returns their columns, extra ones
included whatever their names. Texts may be null, empty or very long; rows and ids may repeat; tables may be empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm.common import discard_others, made_so_far, materialise
from quillgraph.llm.langid import UNKNOWN, fit, tell
from quillgraph.llm.packing import pack_documents
from quillgraph.llm.simhash import drop_near_duplicates
from quillgraph.llm.substring import substring_dedup

#: A document stays if its language is told with at least this probability.
LEAST_SCORE = 0.5
#: Text that goes to a Python worker at once: documents are long, and each batch is in memory several times.
BATCH_BYTES = 8 << 20
#: Words whose ids a worker remembers in the packing stage, which follows others in the same workers.
REMEMBER = 300_000


def _small_batches(spark: SparkSession) -> None:
    """This application's setting for all its stages."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language known: null, without letters, or told with less than LEAST_SCORE.

    The score is a posterior over the languages learned, which is near one for any text of some length: a long document
    in a language never learned stays. If no row has a language to learn from, nothing is dropped. Repeated rows and null
    ids are judged by their text alone.
    """
    _small_batches(spark)
    model = fit(docs)
    if not model.langs:
        return docs
    found = "_quill_told"
    while found in docs.columns:
        found += "_"
    told = tell(docs, model, found)
    return told.where((F.col(f"{found}.lang") != UNKNOWN) & (F.col(f"{found}.score") >= LEAST_SCORE)).drop(found)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies.

    Rows with a null id are in no group and stay; if the smallest id is on several rows, all of these stay; null and
    empty texts are copies of each other.
    """
    _small_batches(spark)
    return drop_near_duplicates(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the words of passages that start in a document with a smaller id; texts without any stay as they are.

    Null texts become empty; rows that repeat an id and rows with a null id take nothing from each other.
    ``n_chars`` is counted anew.
    """
    _small_batches(spark)
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = substring_dedup(docs, carry={f"_in{i}": c for i, c in enumerate(rest)}, untouched=True)
    own = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return cut.select([own[c].alias(c) if c in own else F.col(f"_in{rest.index(c)}").alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into training sequences: a row for each piece. Null and empty texts are the end id alone."""
    import public_tokenizers

    _small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), remember=REMEMBER).drop("ids")


STAGES = [("language_id", language_id), ("simhash_near_dedup", near_dedup), ("substring_dedup", passage_dedup), ("packing", packing)]
#: SQL can't express the language model, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written once, so that the next does not compute it again, and goes when
    the next is written, with the scratch tables of both."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), made_so_far()
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
        discard_others(docs, before)
    return STAGES[-1][1](spark, docs, sf_dir)
