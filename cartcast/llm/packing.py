"""Best-fit packing certified by dual-feasible-function bounds.

Texts become pieces of at most ``CAPACITY`` ids (only longer ones are cut).
Pieces are dealt evenly over partitions of bounded size; each partition packs
its own by best-fit decreasing and computes a lower bound on its bins from
dual-feasible functions over its length histogram. Where the bound meets the
bins used, the partition is certified and done. Where a gap is left, the
partition gives up its emptiest bins, whose waste covers the gap, and fuller
ones too as rounds go on; what all partitions gave up is dealt anew to fewer
partitions and packed again, until nothing is given up or the count no longer
falls. No round moves a settled piece, and a partition's work is bounded by
``PIECES_PER_TASK``. Every round's bins and bounds are kept as certificates.

Defined edge cases: null and empty texts are one piece that holds the end id;
repeated rows are each packed; an empty table gives an empty result; null ids
are kept; pieces of equal length are packed in the order they come in; a very
long text is many pieces; further columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import by_bytes, documents, keyed_text, prepare, saved

CAPACITY = 2048
PIECES_PER_TASK = 100_000
PATIENCE = 3        # rounds in a row without a lower count after which the rest stays
END_ID = 0


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every item: longest first, into the fullest bin that
    still holds it. Bins wait in one stack per free space; a bit mask of the
    free spaces in use finds the tightest one."""
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, n_bins = 0, 0
    order = np.argsort(-lengths, kind="stable")
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            at = waiting[free].pop()
            if not waiting[free]:
                mask ^= 1 << free
        else:
            free, at = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = at, capacity - free
        free -= length
        if free:
            if not waiting[free]:
                mask |= 1 << free
            waiting[free].append(at)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Fewest bins any packing needs, by two families of dual-feasible
    functions: thresholds (items over ``capacity - t`` count as whole bins,
    items under ``t`` as nothing) and roundings to multiples of ``1 / k``."""
    return bound_of_histogram(np.bincount(lengths, minlength=capacity + 1), capacity)


def bound_of_histogram(count: np.ndarray, capacity: int = CAPACITY) -> int:
    """:func:`lower_bound` from the number of items of each length."""
    if not count.sum():
        return 0
    volume = np.concatenate([[0], np.cumsum(count * np.arange(capacity + 1))])
    below = np.concatenate([[0], np.cumsum(count)])
    best = int(volume[-1])
    t = np.arange(1, capacity // 2 + 1)
    whole = below[-1] - below[capacity - t + 1]
    best = max(best, int((whole * capacity + volume[capacity - t + 1] - volume[t]).max()))
    x = np.arange(capacity + 1)
    for k in range(1, 33):
        up = (k + 1) * x
        # in units of 1 / k bins; exact multiples keep their size
        exact = up % capacity == 0
        units = np.where(exact, k * x / capacity, up // capacity)
        best = max(best, math.ceil(round(float((count * units).sum()) / k, 9)) * capacity)
    return -(-best // capacity)


def emptiest(fill: np.ndarray, gap: int, capacity: int) -> np.ndarray:
    """Bins to give up: the emptiest, until their waste covers the gap, and
    at least two (one alone has nothing to exchange with)."""
    order = np.argsort(fill, kind="stable")
    waste = np.cumsum(capacity - fill[order])
    return order[:max(2, int(np.searchsorted(waste, gap * capacity)) + 1)]


def _pack_round(items: DataFrame, turn: int, capacity: int) -> DataFrame:
    """Every partition packed; ``task, bins, bound`` say what it used and the
    least any packing of its items needs, ``settled`` which items stay."""
    schema = T.StructType([*items.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType()), T.StructField("settled", T.BooleanType()),
                           T.StructField("task", T.IntegerType()), T.StructField("bins", T.LongType()),
                           T.StructField("bound", T.LongType()), T.StructField("given", T.LongType())])

    def run(batches):
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.concat_tables(tables)  # bounded by PIECES_PER_TASK
        lengths = table["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        n_bins = int(bins.max()) + 1
        bound = lower_bound(lengths, capacity)
        settled, given = np.ones(len(bins), bool), 0
        if n_bins > bound:
            # fuller bins too, round by round
            open_bins = np.zeros(n_bins, bool)
            waste = (n_bins - bound) << min(turn, 30)
            open_bins[emptiest(np.bincount(bins, lengths, n_bins).astype(np.int64), waste, capacity)] = True
            settled, given = ~open_bins[bins], int(open_bins.sum())
        task = TaskContext.get().partitionId()
        first = (turn << 56) | (task << 28)
        n = len(bins)
        out = (table.append_column("sequence_id", pa.array(bins + first))
               .append_column("offset", pa.array(offsets)).append_column("settled", pa.array(settled))
               .append_column("task", pa.array(np.full(n, task, np.int32)))
               .append_column("bins", pa.array(np.full(n, n_bins))).append_column("bound", pa.array(np.full(n, bound)))
               .append_column("given", pa.array(np.full(n, given))))
        yield from out.to_batches(max_chunksize=10_000)
    return items.mapInArrow(run, schema)


def pack_certified(items: DataFrame, capacity: int = CAPACITY, per_task: int = PIECES_PER_TASK,
                   exchanges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(packed rows, certificates). Packs rows by their ``length`` (1 to
    ``capacity``); adds ``sequence_id`` and ``offset``. ``items`` should be a
    stored table: it is counted, dealt and packed.

    Rounds go on until nothing is given up. A round that does not lower the
    count is undone and dealt in another way; after ``PATIENCE`` of them in a row
    the rest keeps its places (``exchanges`` bounds the rounds as well, if given).
    Certificates have a row per round and partition: ``turn, task, bins`` it used,
    the ``bound`` of its items and the bins ``kept`` (task -1: the rest that kept
    its places); a last row (turn -1) holds all bins and the bound over all items."""
    spark = items.sparkSession
    place = ("sequence_id", "offset")
    extra = ("settled", "task", "bins", "bound", "given")
    done: list[DataFrame] = []
    notes: list[DataFrame] = []

    def noted(*row):
        notes.append(spark.createDataFrame([row], "turn int, task long, bins long, bound long, kept long"))
    rest, turn, before, stale, total = items, 0, None, 0, 0
    while True:
        n = rest.count()
        if not n and turn:
            break
        tasks = max(1, -(-n // per_task))
        # rest is a stored table, so the numbers of its rows are the same each time
        deal = F.xxhash64(F.monotonically_increasing_id(), F.lit(turn))
        dealt = rest.drop(*place).withColumn("_deal", deal).repartition(tasks, "_deal").drop("_deal")
        packed = saved(_pack_round(dealt, turn, capacity), "packed")
        note = packed.groupBy("task").agg(*[F.max(c).alias(c) for c in ("bins", "bound", "given")])
        used = note.agg(F.sum("bins").alias("bins"), F.sum("given").alias("given")).first()
        bins, given = used["bins"] or 0, used["given"] or 0
        if before is not None and bins >= before:
            stale += 1
            if stale >= PATIENCE or tasks == 1 or turn == exchanges:
                done.append(rest)
                noted(turn, -1, before, _bound_of_rows(rest, capacity), before)
                total += before
                break
            turn += 1
            continue
        stale = 0
        last = not given or turn == exchanges
        kept = F.col("bins") if last else F.col("bins") - F.col("given")
        notes.append(note.select(F.lit(turn).alias("turn"), F.col("task").cast("long").alias("task"), "bins", "bound",
                                 kept.alias("kept")))
        if last:
            done.append(packed.drop(*extra))
            total += bins
            break
        done.append(packed.filter("settled").drop(*extra))
        total += bins - given
        rest, before, turn = saved(packed.filter("not settled").drop(*extra), "unpacked"), given, turn + 1
    noted(-1, -1, total, _bound_of_rows(items, capacity), total)
    return _union(done), _union(notes)


def _bound_of_rows(items: DataFrame, capacity: int) -> int:
    count = np.zeros(capacity + 1, np.int64)
    for r in items.groupBy("length").count().collect():  # at most `capacity` rows
        count[r["length"]] = r["count"]
    return bound_of_histogram(count, capacity)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def best_fit_pack(items: DataFrame, capacity: int = CAPACITY, per_task: int = PIECES_PER_TASK,
                  exchanges: int | None = None) -> DataFrame:
    """The packed rows of :func:`pack_certified`."""
    return pack_certified(items, capacity, per_task, exchanges)[0]


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64())])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (``PIECES_DDL``) of every whole text's ids and the end id."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        coder = tokens.loaded(path)
        for b in by_bytes(batches, 4 << 20):
            rows = []
            for d, ids in zip(b.column(0).to_pylist(), coder.encode(b.column(1).to_pylist())):
                ids += end
                for k, s in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[s:s + 4 * capacity]
                    rows.append((d, k, s // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(zip(*rows), PIECES)], schema=PIECES)
    return keyed_text(docs).mapInArrow(run, PIECES_DDL)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents and their place: ``sequence_id, offset``."""
    return best_fit_pack(saved(token_pieces(docs, path, capacity), "pieces"), capacity)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    prepare(spark)
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
