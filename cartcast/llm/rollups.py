"""Token counts as delta-maintained rollups.

Totals by (source, language, tokenizer version) are kept as additive rows. A
batch of changes carries *inserts* (a document and its count), *deletes* (an
earlier insert with its sign turned) and *revisions* (the old count turned and
the new one added, under any version). A batch is first summed per key with a
map-side aggregate, so what is stored grows with the keys, not the documents,
then written under its batch id. A batch id commits once: a second delivery,
or the rerun of a batch whose job died, finds the committed folder, or none,
and never adds twice. Totals are the sum over committed batches;
:meth:`Rollup.compact` folds them into one.

State lies in a folder all executors share: ``batch=<id>`` folders written by
Spark's own commit protocol, complete when they hold ``_SUCCESS``.

Defined edge cases: null and empty texts count zero tokens and one document;
null sources, languages or versions form a key of their own; repeated rows
count as often as they occur, and of several rows with the smallest id of a text
none is a copy; an empty batch commits with no rows, and an empty table gives no
totals; a very long text is counted whole, by one pass of the pattern; further
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import documents, prepare, saved

KEYS = ("source", "lang", "version")
MEASURES = ("n_docs", "n_tokens", "n_chars")
SALTS = 64  # places of a text's copies

# Tokenizer versions of the registered query: pattern of one token.
VERSIONS = {"words-1": "[^\\x20\\x09-\\x0D]+", "letters-1": "[A-Za-z]+"}


def token_count(text: Column, version: str) -> Column:
    return F.regexp_count(text, F.lit(VERSIONS[version])).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, source, lang``, a digest of its text, ``n_chars``
    and its count under every version: one reading of the text, after which
    changes are worked out on narrow rows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"), F.sha2(text, 256).alias("digest"),
        F.length(text).cast("long").alias("n_chars"),
        F.create_map(*[x for v in VERSIONS for x in (F.lit(v), token_count(text, v))]).alias("tokens"))


def counted(rows: DataFrame, version: str, sign: int = 1) -> DataFrame:
    """Signed measure rows of measured documents under one tokenizer version."""
    return rows.select(
        "source", "lang", F.lit(version).alias("version"), F.lit(sign).cast("long").alias("n_docs"),
        (sign * F.col("tokens")[version]).alias("n_tokens"), (sign * F.col("n_chars")).alias("n_chars"))


def inserts(rows: DataFrame, version: str) -> DataFrame:
    return counted(rows, version)


def deletes(rows: DataFrame, version: str) -> DataFrame:
    return counted(rows, version, -1)


def revisions(rows: DataFrame, old: str, new: str) -> DataFrame:
    """Counts of the same documents moved from one version to another."""
    return counted(rows, old, -1).union(counted(rows, new))


class Rollup:
    """Additive totals in a shared folder, one folder per committed batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _files(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, root, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def committed(self) -> list[str]:
        """Ids of the batches whose write was completed."""
        jvm, root, fs = self._files()
        if not fs.exists(root):
            return []
        found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]
        return sorted(p.getName().removeprefix("batch=") for p in found
                      if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch of signed rows; False if this id has been committed."""
        if not batch_id or not batch_id.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"batch id {batch_id!r}")
        if batch_id in self.committed():
            return False
        # overwrite: what a job that died left under this id was never counted
        (changes.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
         .write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}"))
        return True

    def deltas(self) -> DataFrame:
        """Every committed batch's rows."""
        schema = ", ".join([f"{k} string" for k in KEYS] + [f"{m} long" for m in MEASURES])
        paths = [f"{self.path}/batch={b}" for b in self.committed()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def totals(self) -> DataFrame:
        """Current totals; keys whose documents are all gone are left out."""
        return (self.deltas().groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
                .filter(" or ".join(f"{m} != 0" for m in MEASURES)))

    def compact(self, path: str) -> "Rollup":
        """The same totals as one batch in a new folder; the ids counted so
        far stay refused there."""
        new = Rollup(self.spark, path)
        ids = self.committed()
        new.commit("compacted", self.totals())
        for i in ids:
            new.commit(i, self.totals().limit(0))
        return new


def marked_copies(rows: DataFrame) -> DataFrame:
    """Measured documents and ``is_copy``: a document with a smaller id has
    the same text. Texts are dealt by digest and a salt of their id, so a hot
    text lies in ``SALTS`` places; the first ids of these, at most ``SALTS`` a
    text, are compared, and only texts with several rows are joined."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    whole = Window.partitionBy("digest")
    first = (salted.groupBy("digest", "salt").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .select("digest", "salt", F.min("first_id").over(whole).alias("first_id"), F.sum("n").over(whole).alias("n"))
             .filter("n > 1").drop("n"))
    return salted.join(first, ["digest", "salt"], "left").withColumn(
        "is_copy", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))).drop("first_id", "salt")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted, later copies of a text are deleted, and
    the documents of every language but English are revised to the second
    version; two batches are delivered twice. Returns the totals."""
    prepare(spark)
    rows = saved(marked_copies(measured(documents(spark, sf_dir))), "token-counts")
    rollup = Rollup(spark, scratch_path(spark, "token-rollup"))
    rollup.commit("load", inserts(rows, "words-1"))
    rollup.commit("copies", deletes(rows.filter("is_copy"), "words-1"))
    rollup.commit("load", inserts(rows, "words-1"))
    rest = rows.filter("not is_copy and lang is distinct from 'en'")
    rollup.commit("retokenized", revisions(rest, "words-1", "letters-1"))
    rollup.commit("retokenized", revisions(rest, "words-1", "letters-1"))
    return rollup.totals()


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS t,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
), live AS (
  SELECT source, lang, t, CASE WHEN lang IS DISTINCT FROM 'en' THEN 'letters-1' ELSE 'words-1' END AS version
  FROM d WHERE doc_id IS NULL OR doc_id <= first_id
)
SELECT source, lang, version, count(*) AS n_docs,
       CAST(sum(CASE WHEN version = 'words-1' THEN len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))
                     ELSE len(regexp_extract_all(t, '[A-Za-z]+')) END) AS BIGINT) AS n_tokens,
       CAST(sum(length(t)) AS BIGINT) AS n_chars
FROM live GROUP BY ALL
"""
