"""Drive streaming queries to completion with ``trigger(availableNow=True)``.

A stream reads the given table itself. Where several micro-batches are the
point, :class:`Arrivals` writes the table once, partitioned by slice, and moves
one slice after another into the watched folder (a rename, no copy).

Sinks are idempotent by batch id: complete mode overwrites, update mode
appends rows tagged with the batch id and readers keep the latest row per
key, so a retried batch never double counts. Checkpoints live under the
shared ``spark.checkpoint.dir``; restarting with the same checkpoint resumes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(files_per_trigger))
    return r.load(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a file stream. The table may be one file or a folder
    of files; a pattern is a valid stream path for either."""
    base = f"{sf_dir.rstrip('/')}/{name}"
    return read_stream(spark, f"{base}.parque[t]", spark.read.parquet(f"{base}.parquet").schema)


class Arrivals:
    """Rows that reach a watched folder slice by slice."""

    def __init__(self, df: DataFrame, slice_of: Column, name: str = "arrivals"):
        self.spark = df.sparkSession
        self.schema = df.schema
        self.staged = scratch_path(self.spark, f"{name}-staged")
        self.folder = scratch_path(self.spark, f"{name}-in")
        df.withColumn("_slice", slice_of.cast("int")).write.partitionBy("_slice").parquet(self.staged)
        self._fs().mkdirs(self._path(self.folder))
        found = [s.getPath().getName() for s in self._fs().listStatus(self._path(self.staged))]
        self.slices = sorted(int(n.split("=")[1]) for n in found if n.startswith("_slice="))

    def _path(self, p: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(p)

    def _fs(self):
        return self._path(self.staged).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def deliver(self, i: int) -> None:
        if not self._fs().rename(self._path(f"{self.staged}/_slice={i}"), self._path(f"{self.folder}/slice-{i}")):
            raise RuntimeError(f"slice {i} could not be delivered")

    def stream(self) -> DataFrame:
        return (self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true")
                .parquet(self.folder))


def drain(start: Callable, arrivals: Arrivals | None = None, done: Callable[[], bool] | None = None) -> None:
    """Run a query over what is there, or slice by slice on one checkpoint.
    ``start()`` starts it. Once ``done()`` the query is not started again, and
    what has not been delivered stays undelivered."""
    for i in (arrivals.slices if arrivals else [None]):
        if arrivals:
            arrivals.deliver(i)
        q = start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        if done and done():
            break


def start_with_partitions(writer, spark: SparkSession, state_partitions: int | None):
    """Start a streaming query with an explicit number of state (shuffle)
    partitions. Streaming plans get no AQE coalescing and the count is fixed
    in the checkpoint at the first start, so it is chosen here: by default
    one partition per core of the cluster (``defaultParallelism``)."""
    n = state_partitions or spark.sparkContext.defaultParallelism
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        return writer.start()  # the query clones the session conf here
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)


def run_to_table(stream: DataFrame, mode: str, keys: Sequence[str] | None = None,
                 name: str = "stream", checkpoint: str | None = None,
                 batch_fn: Callable[[DataFrame, int], DataFrame] | None = None,
                 state_partitions: int | None = None, arrivals: Arrivals | None = None) -> DataFrame:
    """Run ``stream`` to the end of its input (of ``arrivals``, slice by
    slice) and return the final result as a batch DataFrame read from the sink.

    ``complete``: each batch overwrites the sink. ``update``: rows are
    appended with ``_batch`` and the latest row per ``keys`` wins.
    ``append``: rows are appended (``batch_fn`` may transform each batch and
    receives the batch id, e.g. per-batch SQL).
    """
    spark = stream.sparkSession
    out = scratch_path(spark, f"{name}-out")
    ckpt = checkpoint or scratch_path(spark, f"{name}-ckpt")

    def sink(batch: DataFrame, batch_id: int) -> None:
        b = batch_fn(batch, batch_id) if batch_fn else batch
        if mode == "complete":
            b.write.mode("overwrite").parquet(out)
        else:
            # keyed by batch id: a replayed batch rewrites its own partition
            (b.withColumn("_batch", F.lit(batch_id))
              .write.mode("overwrite").parquet(f"{out}/_batch_dir={batch_id}"))

    def start():
        writer = (stream.writeStream.outputMode(mode).foreachBatch(sink)
                  .option("checkpointLocation", ckpt).trigger(availableNow=True))
        return start_with_partitions(writer, spark, state_partitions)
    drain(start, arrivals)
    if mode == "complete":
        return spark.read.parquet(out)
    res = spark.read.parquet(out).drop("_batch_dir")
    if mode == "update":
        if not keys:
            raise ValueError("update mode needs key columns")
        vals = [c for c in res.columns if c not in keys and c != "_batch"]
        numeric = all(isinstance(res.schema[c].dataType, T.NumericType) for c in vals)
        if numeric:
            # one row per key per batch: per-column max_by on the batch id is
            # exact and keeps primitive buffers (hash aggregate)
            return res.groupBy(*keys).agg(*[F.max_by(c, "_batch").alias(c) for c in vals])
        latest = res.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("_batch")).alias("_v"))
        return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])
    return res
