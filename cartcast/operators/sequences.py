"""Frequent sequential patterns of any length by projection.

A pattern is a list of item sets; an entity contains it if its sets occur on
ascending dates. Patterns grow level by level. A pattern is extended
* by a further set: the entity's items whose last date is after the pattern's
  earliest end;
* within its last set: a larger item on the same date as one of its ends, the
  dates after the earliest end of the sets before on which it has the whole set.

The rows are shuffled once, by entity, and stored in packs of whole entities, about
``PART_ROWS`` rows each. Per level every pack counts the extensions of all frequent
patterns for its entities at once and gives one row per (pattern, item); Spark adds
these up and infrequent ones leave at once. Ends are derived again from the pack, so
nothing that grows with patterns times entities is shuffled or written; a level that
has no pattern ends the search. The driver holds the frequent patterns, which are the
result and few; a task holds a pack, so an entity's own distinct (date, item) rows,
as three numbers each, have to fit there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import saved_table

PART_ROWS = 500_000  # about so many rows of a partition, and of its entities counted at once


def frequent_sequences(rows: DataFrame, entity: str, date: str, item: str, least: int,
                       max_items: int | None = None) -> DataFrame:
    """``sequence`` (array of sorted item arrays) and ``freq``, the entities
    that contain it, for all patterns with ``freq >= least``; patterns of up to
    ``max_items`` items where that is given."""
    if least < 1:
        raise ValueError("least must be at least 1")
    spark = rows.sparkSession
    lines = rows.select(F.col(entity).alias("e"), F.col(date).alias("d"), F.col(item).alias("item"))
    lines = lines.where("e is not null and d is not null and item is not null")
    one = lines.groupBy("item").agg(F.count_distinct("e").alias("freq")).where(F.col("freq") >= least)
    one = saved_table(one, "sequence-items")
    # only frequent items can be part of a frequent pattern; they are numbered in their order
    first = one.orderBy("item").collect()
    names = [r["item"] for r in first]
    found = [([[r["item"]]], r["freq"]) for r in first]
    schema = one.select(F.array(F.array("item")).alias("sequence"), "freq").schema
    codes = spark.createDataFrame(list(zip(names, range(len(names)))), StructType(
        [StructField("item", one.schema["item"].dataType), StructField("i", IntegerType())]))
    packed = saved_table(_packed(lines.join(F.broadcast(codes), "item")), "sequence-lines")
    level = [((i,),) for i in range(len(names))]
    size = 1
    while level and (max_items is None or size < max_items):
        grown = (packed.mapInArrow(_extensions(level, len(names)), "p int, i int, same boolean, freq long")
                 .groupBy("p", "i", "same").agg(F.sum("freq").alias("freq")).where(F.col("freq") >= least).collect())
        last, level = level, []
        for r in grown:
            p = last[r["p"]]
            level.append((*p[:-1], (*p[-1], r["i"])) if r["same"] else (*p, (r["i"],)))
            found.append(([[names[x] for x in s] for s in level[-1]], r["freq"]))
        level.sort()
        size += 1
    return spark.createDataFrame(found, schema)


def _packed(lines: DataFrame) -> DataFrame:
    """``e, t, i``: packed numbers of the distinct rows of whole entities, about
    ``PART_ROWS`` rows at a time: the entity's place in the pack, the rank of the
    date among the entity's own dates, the item's number."""
    n = max(lines.sparkSession.sparkContext.defaultParallelism, -(-lines.count() // PART_ROWS))
    by_date = Window.partitionBy("e").orderBy("d")
    ranked = lines.repartition(n, "e").select("e", "d", "i").distinct().select(
        (F.row_number().over(by_date) == 1).alias("start"), F.dense_rank().over(by_date).alias("t"), "i")
    return ranked.mapInArrow(_packs, "e binary, t binary, i binary")


def _packs(batches):
    held = []

    def out(parts):
        start, t, i = (np.concatenate(c) for c in zip(*parts))
        e = np.cumsum(start, dtype=np.int32) - 1
        return pa.RecordBatch.from_arrays([pa.array([c.astype(np.int32).tobytes()], pa.binary()) for c in (e, t, i)],
                                          ["e", "t", "i"])
    for b in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        starts = np.flatnonzero(new[0])
        if sum(len(h[0]) for h in held) + b.num_rows > PART_ROWS and len(starts):
            cut = starts[-1]  # the last entity may go on in the next batch
            yield from [out(p) for p in [held + [[c[:cut] for c in new]]] if sum(len(h[0]) for h in p)]
            held, new = [], [c[cut:] for c in new]
        if len(new[0]):
            held.append(new)
    if held:
        yield out(held)


def _extensions(level: list[tuple], items: int):
    """``p, i, same, freq``: of each pack the entities that show pattern ``p`` of the
    level extended by item ``i``, within its last set (same) or as a further one."""
    def counted(e, t, i):
        new = np.r_[True, (e[1:] != e[:-1]) | (t[1:] != t[:-1])]
        group = np.cumsum(new) - 1  # an entity's date
        ge, gt = e[new], t[new]
        order = np.argsort(i, kind="stable")
        at = np.searchsorted(i[order], np.arange(items + 1))
        pair = e.astype(np.int64) * items + i
        last = np.lexsort((t, pair))
        last = last[np.r_[pair[last][1:] != pair[last][:-1], True]]  # the last date of an entity's item
        le, lt, li = e[last], t[last], i[last]
        never = np.iinfo(np.int32).max

        def ends(end, items_of_set):
            """Dates after ``end`` that have the whole set."""
            for k, x in enumerate(items_of_set):
                own = group[order[at[x]:at[x + 1]]]
                q = np.intersect1d(q, own, assume_unique=True) if k else own
            return q[gt[q] > end[ge[q]]]

        def earliest(q):
            end = np.full(e[-1] + 1, never, np.int32)
            who = ge[q]
            new = np.r_[True, who[1:] != who[:-1]] if len(q) else np.zeros(0, bool)
            end[who[new]] = gt[q[new]]
            return end

        path = [((), np.full(e[-1] + 1, -1, np.int32))]  # patterns come in order, so those of one head together
        for p, pattern in enumerate(level):
            head, tail = pattern[:-1], pattern[-1]
            while path[-1][0] != head[:len(path[-1][0])]:
                path.pop()
            while len(path[-1][0]) < len(head):
                known, end = path[-1]
                path.append((head[:len(known) + 1], earliest(ends(end, head[len(known)]))))
            q = ends(path[-1][1], tail)
            later = np.bincount(li[lt > earliest(q)[le]], minlength=items)
            inside = np.zeros(len(ge), bool)
            inside[q] = True
            within = np.bincount(np.unique(pair[inside[group] & (i > tail[-1])]) % items, minlength=items)
            for same, n in ((False, later), (True, within)):
                x = np.flatnonzero(n)
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), p), pa.int32()), pa.array(x, pa.int32()),
                                                      pa.array(np.full(len(x), same)), pa.array(n[x], pa.int64())],
                                                     ["p", "i", "same", "freq"])

    def run(batches):
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                yield from counted(*(np.frombuffer(c, np.int32) for c in row))
    return run
