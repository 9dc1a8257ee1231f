"""Corpus pipeline: quality rules, toxicity, near duplicates, repeated
passages, packing. Every stage takes ``(spark, docs, sf_dir)``; what it returns
is written as Parquet and read again as the next stage's ``docs``.

All stages but the last return the columns of ``documents``, for the documents
they keep. A document with a null ``doc_id`` passes the filtering stages only
by its own text; of near duplicates the row with the smallest ``doc_id`` stays
(null last; of equal ids the smallest SHA-256 of the row; of equal rows, one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartcast.llm import packing, quality, simhash, suffixes, toxicity
from cartcast.llm.common import documents, prepare, saved, table

TABLE = ("doc_id", "text", "lang", "source", "n_chars")

# Rows depend on trained models and on SHA-256 of cut texts: no SQL form.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    prepare(spark)
    return quality.keep_good(docs.select(*TABLE))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the model is fitted on the
    labelled documents that reached this stage."""
    prepare(spark)
    model = toxicity.fit_toxicity(docs, toxicity.learning_rows(table(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs.select(*TABLE), model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints, chosen by the row itself:
    rows of one id, or of none, that differ in text are compared like others."""
    prepare(spark)
    rest = F.to_json(F.struct(*[c for c in TABLE if c != "text"]))
    key = F.unhex(F.sha2(F.concat(F.coalesce(F.sha2("text", 256), F.lit("")), rest), 256))
    chosen, again = (saved(x, name) for x, name in zip(
        simhash.representatives(docs, key), ("pipeline-chosen", "pipeline-again")))
    rows = docs.select(*TABLE, key.alias("row_key"))
    kept = rows.join(chosen, "row_key", "left_semi")
    if not again.isEmpty():  # rows that are equal in all columns keep one; the others need no comparison
        once = kept.join(again, "row_key", "left_anti")
        kept = once.union(kept.join(again, "row_key", "left_semi").dropDuplicates(["row_key"]))
    return kept.select(*TABLE)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of smaller documents. Bytes that no longer
    form a character are dropped; a text may become empty, and stays."""
    prepare(spark)
    cut = suffixes.suffix_dedup(docs, with_text=True, carry=("text", "lang", "source", "n_chars"))
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))
    return cut.select("doc_id", text.alias("text"), "lang", "source",
                      F.when(F.col("n_removed") == 0, F.col("n_chars"))
                      .otherwise(F.length(text)).cast("long").alias("n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts and their place in sequences."""
    import public_tokenizers
    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("suffix-array dedup", passage_stage),
    ("best-fit packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
