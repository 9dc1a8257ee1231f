"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants; cluster-specific sizing
# (shuffle partitions, file split size) is left to the caller.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE size cached frames (model inputs reused by many fits) by volume
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cartcast") -> SparkSession:
    """Session for tests and the local bench (``local[cores]``)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("CARTCAST_DRIVER_MEM", "16g"))
               .config("spark.sql.streaming.stateStore.providerClass",
                       "org.apache.spark.sql.execution.streaming.state."
                       "RocksDBStateStoreProvider"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must name shared storage and is only read.
    Only a local session without it gets a fresh folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="cartcast-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - some deployments lock core configs
            pass
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/scratch/{name}-{uuid.uuid4().hex}"


def saved_table(df, name: str):
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage and outlives a cache that is released."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cartcast`` importable in Python workers (UDFs, stateful
    processors and stream callbacks refer to it by module), once per
    application: the package is zipped on the driver and added with
    ``addPyFile``, which distributes it to every executor."""
    import shutil

    import cartcast
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext here (e.g. a remote client)
        return
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(cartcast.__file__))
    out = tempfile.mkdtemp(prefix="cartcast-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "cartcast"), "zip",
                                  root_dir=os.path.dirname(pkg), base_dir="cartcast")
    sc.addPyFile(archive)  # served from here as long as the application runs
    atexit.register(shutil.rmtree, out, True)
    _SHIPPED.add(sc.applicationId)
