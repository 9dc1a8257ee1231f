"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str,
                   header: bool = True, sep: str = ",") -> DataFrame:
    """Header CSV with a declared schema (S1): no inference pass over the data."""
    return spark.read.csv(path, schema=schema, header=header, sep=sep, mode="FAILFAST")


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
              mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=header, sep=sep)


def load(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Default-format (``spark.sql.sources.default``) or named-format load."""
    r = spark.read.options(**options)
    return r.load(path) if fmt is None else r.format(fmt).load(path)


def save(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite",
         partition_by: list[str] | None = None, **options) -> None:
    w = df.write.mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    (w.save(path) if fmt is None else w.format(fmt).save(path))


def sql_on_file(spark: SparkSession, fmt: str, path: str, select: str = "*",
                where: str | None = None) -> DataFrame:
    """SQL run directly on files, no table registration."""
    q = f"SELECT {select} FROM {fmt}.`{path}`"
    if where:
        q += f" WHERE {where}"
    return spark.sql(q)


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """JSON lines; schema inferred when none is given."""
    r = spark.read
    return (r.schema(schema) if schema is not None else r).json(path)


def parse_json_column(df: DataFrame, col: str, sample: str, out: str = "j") -> DataFrame:
    """Parse a JSON string column with the schema of a sample document.

    The schema is derived once from a literal sample, so no pass over the data
    is spent on inference.
    """
    return df.withColumn(out, F.from_json(F.col(col), F.schema_of_json(F.lit(sample))))


def read_parquet_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with schema merge and ``key=value`` partition discovery."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line text scan, one ``value`` column."""
    return spark.read.text(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LIBSVM (label, sparse features; 1-based on disk)."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", str(num_features))
    return r.load(path)


def write_libsvm(df: DataFrame, path: str, label: str = "label",
                 features: str = "features") -> None:
    df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features")) \
      .write.mode("overwrite").format("libsvm").save(path)


def save_table(df: DataFrame, table: str, location: str) -> DataFrame:
    """Register ``df`` as a catalog table stored at ``location`` (an external
    table under shared storage, so no warehouse folder is left behind)."""
    df.write.mode("overwrite").option("path", location).saveAsTable(table)
    return df.sparkSession.table(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Remove a table's catalog entry; resolved queries keep reading its files."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def read_ctrl_a_table(spark: SparkSession, path: str, schema: str, table: str,
                      location: str) -> DataFrame:
    """Ctrl-A delimited text loaded into a catalog table."""
    df = spark.read.csv(path, schema=schema, sep="\x01")
    return save_table(df, table, location)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Parquet sink (S18); the writer keeps one file set per task, no funnel."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
