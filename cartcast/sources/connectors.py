"""Connector option builders: JDBC and Kafka.

No JDBC driver or Kafka connector ships with this environment, so these
build the exact reader/writer calls; the jobs run wherever the jars exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None,
                 password: str | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int | None = None,
                 **extra) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``. A partition column with
    bounds and a partition count splits the read into parallel range queries."""
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC read needs lower/upper bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    if fetch_size is not None:
        opts["fetchsize"] = str(fetch_size)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(spark: SparkSession, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kw)).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               batch_size: int | None = None, **kw) -> None:
    opts = jdbc_options(url, table, **kw)
    if batch_size:
        opts["batchsize"] = str(batch_size)
    df.write.format("jdbc").options(**opts).mode(mode).save()


def kafka_options(bootstrap: str, subscribe: str | None = None,
                  subscribe_pattern: str | None = None, assign: str | None = None,
                  starting_offsets: str = "latest") -> dict[str, str]:
    """Exactly one of ``subscribe`` / ``subscribePattern`` / ``assign``."""
    chosen = [(k, v) for k, v in (("subscribe", subscribe),
                                   ("subscribePattern", subscribe_pattern),
                                   ("assign", assign)) if v]
    if len(chosen) != 1:
        raise ValueError("give exactly one of subscribe, subscribe_pattern, assign")
    return {"kafka.bootstrap.servers": bootstrap, chosen[0][0]: chosen[0][1],
            "startingOffsets": starting_offsets}


def read_kafka_lines(spark: SparkSession, **kw) -> DataFrame:
    """Kafka stream → ``value`` strings (binary cast, F17)."""
    return (spark.readStream.format("kafka").options(**kafka_options(**kw)).load()
                 .selectExpr("CAST(value AS STRING) AS value"))
