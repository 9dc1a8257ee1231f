"""Keyed running state with an initial state.

``transformWithStateInPandas`` keeps one value per key in the (RocksDB)
state store; the initial state is loaded once per key, and each micro-batch
adds its rows. Output is one row per touched key per batch (update mode).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_SCHEMA = T.StructType([T.StructField("count", T.LongType())])
OUTPUT_SCHEMA = T.StructType([T.StructField("key", T.StringType()),
                              T.StructField("count", T.LongType())])


class RunningCount(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", STATE_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        total = self.count.get()[0] if self.count.exists() else 0
        for pdf in rows:
            total += len(pdf)
        self.count.update((total,))
        yield pd.DataFrame({"key": [str(key[0])], "count": [total]})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        base = int(initialState["count"].sum())
        current = self.count.get()[0] if self.count.exists() else 0
        self.count.update((current + base,))

    def close(self) -> None:
        pass


def running_counts(rows: DataFrame, key: str = "key", initial: DataFrame | None = None) -> DataFrame:
    """Per key, the running count of rows including the initial counts
    (``initial`` has columns ``key`` and ``count``)."""
    # the processor runs in a Python runner that may not see shipped files:
    # send this self-contained module by value
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    g = rows.select(F.col(key).cast("string").alias("key")).groupBy("key")
    kw = {}
    if initial is not None:
        kw["initialState"] = initial.select(F.col("key").cast("string").alias("key"),
                                            "count").groupBy("key")
    return g.transformWithStateInPandas(statefulProcessor=RunningCount(), outputStructType=OUTPUT_SCHEMA,
                                        outputMode="Update", timeMode="None", **kw)
