"""Exact top-n products of two factor tables (M23), without a product of the
tables.

Items are laid in blocks of falling norm. A user scores one block, keeps the best
n, and goes on to the next block only while ``|user| * largest norm of the block``
can still reach its n-th best score (Cauchy-Schwarz), so most users leave after
few blocks; a user that never can is done exactly. Only one block of items
(``block`` rows, a bound) is outside Spark's tables at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import saved_table
from .relational import dense_index

_ROWS = 256  # users whose scores of a block are held at a time
_STATE = pa.schema([("user", pa.int64()), ("features", pa.list_(pa.float64())), ("norm", pa.float64()),
                    ("items", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])
_STATE_DDL = "user long, features array<double>, norm double, items array<long>, scores array<double>"


def top_products(users: DataFrame, items: DataFrame, n: int, block: int = 4096) -> DataFrame:
    """``user, items, scores``: the ``n`` items of largest inner product, best
    first, of equal scores the smaller item. ``users`` and ``items`` have ``id,
    features`` (array of doubles)."""
    if n < 1:
        raise ValueError("n must be at least 1")
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, v: s + v * v))
    ranked = items.select(F.col("id").cast("long").alias("item"),
                          F.transform("features", lambda v: v.cast("double")).alias("features"))
    ranked = dense_index(ranked.withColumn("low", -norm), "low", "at", tie="item")
    ranked = saved_table(ranked.withColumn("block", F.floor(F.col("at") / block).cast("int")), "item-blocks")
    n_blocks = (ranked.agg(F.max("block")).first()[0] or 0) + 1
    state = users.select(F.col("id").cast("long").alias("user"),
                         F.transform("features", lambda v: v.cast("double")).alias("features"))
    state = saved_table(state.withColumn("norm", norm).withColumn("items", F.array().cast("array<long>"))
                        .withColumn("scores", F.array().cast("array<double>")), "user-tops")
    done = None
    for i in range(n_blocks):
        rows = ranked.where(F.col("block") == i).select("item", "features").toArrow()  # at most `block` rows
        if not rows.num_rows:
            break
        ids = rows.column("item").to_numpy()
        y = np.stack(rows.column("features").to_pylist())
        most = float(np.sqrt((y ** 2).sum(axis=1)).max())
        # a user that cannot gain from this block cannot gain from a later one
        open_ = (F.size("scores") < n) | (F.col("norm") * most >= F.element_at("scores", -1) * (1 - 1e-12) - 1e-12)
        closed = state.where(~open_)
        done = closed if done is None else done.unionByName(closed)
        state = saved_table(_scored(state.where(open_), ids, y, n), "user-tops")
        if i + 1 < n_blocks and state.isEmpty():
            break
    out = state if done is None else done.unionByName(state)
    return out.select("user", "items", "scores")


def _best(x: np.ndarray, old_items: list, old_scores: list, ids: np.ndarray, y: np.ndarray, n: int):
    """The n best items and scores of every row of ``x`` among those it has and
    the block's; scores of ``_ROWS`` rows are held at a time."""
    k = min(n, len(ids))
    out_items, out_scores = [], []
    for s in range(0, len(x), _ROWS):
        score = x[s:s + _ROWS] @ y.T
        # the n-th best score of the block, then all items that reach it (ties)
        edge = np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k]
        for row, least, old_i, old_s in zip(score, edge, old_items[s:s + _ROWS], old_scores[s:s + _ROWS]):
            at = np.flatnonzero(row >= least)
            best = sorted(zip([-v for v in old_s] + (-row[at]).tolist(), old_i + ids[at].tolist()))[:n]
            out_items.append([i for _, i in best])
            out_scores.append([-v for v, _ in best])
    return out_items, out_scores


def _scored(state: DataFrame, ids: np.ndarray, y: np.ndarray, n: int) -> DataFrame:
    shared = state.sparkSession.sparkContext.broadcast((ids, y))  # one block of items

    def run(batches):
        ids, y = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            out_items, out_scores = _best(x, b.column(3).to_pylist(), b.column(4).to_pylist(), ids, y, n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1).cast(_STATE.field(1).type), b.column(2),
                 pa.array(out_items, _STATE.field(3).type), pa.array(out_scores, _STATE.field(4).type)], schema=_STATE)
    return state.mapInArrow(run, _STATE_DDL)
