"""Helpers shared by the corpus operators.

Every operator takes a DataFrame with at least the columns it names (usually
``doc_id`` and ``text``) and selects only those first, so further columns,
whatever their names, never clash. Batches are kept small in rows because a
text may be very long.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path, ship_package

BATCH_ROWS = 256
WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: small Arrow batches, the
    package on the workers, and the shared checkpoint folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def give_back() -> None:
    """Free the token caches that tasks of another operator have left in this
    Python worker; workers serve one operator after the other."""
    for name in ("tokens", "bpe"):
        module = sys.modules.get(f"{__package__}.{name}")
        if module is not None:
            module._LOADED.clear()
    pa.default_memory_pool().release_unused()


def keyed_text(docs: DataFrame) -> DataFrame:
    """``(doc_id long, text string)`` and nothing else."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage, and a lost executor costs at most a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lowest_per_class(rows: DataFrame, kind: str, turn: str, key: str, most: int) -> DataFrame:
    """At most ``most`` rows of each class, those of least ``turn`` (a 64-bit
    hash), then ``key``. Turns are counted by 4,096 ranges first, so whole ranges
    are kept by a filter and only each class's boundary range is ranked; no task
    holds a class. For classes of a bounded number."""
    span = F.shiftright(F.col(turn), 52).cast("int")
    counted = rows.groupBy(kind, span.alias("_span")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(kind).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    counted = (counted.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .filter(F.col("_before") < most))
    # at most 4,096 rows a class
    near = rows.withColumn("_span", span).join(F.broadcast(counted), [kind, "_span"])
    whole = near.filter(F.col("_before") + F.col("_n") <= most)
    edge = near.filter(F.col("_before") + F.col("_n") > most)
    place = F.row_number().over(Window.partitionBy(kind, "_span").orderBy(turn, key))
    edge = edge.withColumn("_place", place).filter(F.col("_place") <= most - F.col("_before"))
    return whole.select(*rows.columns).unionByName(edge.select(*rows.columns))


def crc_of_id(col="doc_id"):
    """crc32 of the id written as text (null id: crc of the empty string)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def by_bytes(batches, most: int = 8 << 20):
    """Arrow batches joined into tables of about ``most`` bytes, so that work
    per batch is shared by many short texts and few long ones."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def arrow_rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    """Rows (tuples in schema order) as one Arrow batch."""
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(cols, schema)], schema=schema)
