"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints are 64-bit SimHashes of three-word shingles; two link at no more
than ``MAX_BITS`` (3) differing bits. Candidate search on distinct
fingerprints, by pigeonhole and the perfect (23, 12) Golay code:

* Cut the 64 bits into four 16-bit segments. Three errors leave at least one
  segment untouched: it is the exact part of a key.
* The other 48 bits are two 24-bit segments, one of which holds at most one
  of the errors. Its low 23 bits are decoded: the keys are the indices of the
  codewords nearest to the segment and to each of its 23 one-bit neighbours
  (one key or six). Segments within two bits of each other share an index.

So linked fingerprints share at least one (table, exact segment, codeword)
key. Rows are sorted by key inside each partition, and members of a key are
compared in numpy; what leaves a task is a spanning forest, never all pairs.
A key with more than ``HOT_KEY`` distinct fingerprints takes a linear exact
way instead: every member is listed under its 64-bit neighbours, all members
within two bits of a neighbour link to the smallest member within one bit of
it, which connects any two members up to three bits apart.

Defined edge cases: null and empty texts have fingerprint zero, linked like
any other; repeated rows share a fingerprint; an empty table gives an empty
result; null ids are kept and ignored when the smallest id is taken; a very long
text gives one fingerprint of all its shingles; a bit set in exactly half of the
hashes is 0; further columns are not read.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, give_back, prepare, saved
from .components import connected_components, local_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
HOT_KEY = 4096
SORTED_ROWS = 200_000  # rows compared at a time
GENERATOR = 0b110001110101  # x^11+x^10+x^6+x^5+x^4+x^2+1, the Golay code's


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Unsigned SimHash of the word shingles of ``text``."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    first, last = starts[:n], ends[min(width, len(words)) - 1:]
    for at in range(0, n, 65536):
        pairs = zip(first[at:at + 65536].tolist(), last[at:at + 65536].tolist())
        h = np.array([digest(joined[s:e], SEED) for s, e in pairs], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


@functools.cache
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the 12 message bits, and the error of each syndrome."""
    def remainder(v: int) -> int:
        for bit in range(22, 10, -1):
            if v >> bit & 1:
                v ^= GENERATOR << (bit - 11)
        return v
    syndromes = np.array([remainder(m << 11) for m in range(4096)], np.int64)
    errors = np.zeros(2048, np.int64)
    for weight in (1, 2, 3):
        for bits in itertools.combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            errors[remainder(e)] = e
    return syndromes, errors


def codeword_index(v: np.ndarray) -> np.ndarray:
    """Index (message) of the codeword nearest to each 23-bit value."""
    syndromes, errors = golay_tables()
    return (v ^ errors[syndromes[v >> 11] ^ (v & 0x7FF)]) >> 11


def nearby_indices(v: np.ndarray) -> np.ndarray:
    """(n, 24): index of each value and of its 23 one-bit neighbours."""
    flips = np.concatenate([[0], 1 << np.arange(23)])
    return codeword_index(v[:, None] ^ flips[None, :])


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All distinct (row, key) pairs of unsigned fingerprints."""
    prints = prints.astype(np.uint64)
    parts = [(prints >> np.uint64(16 * i)).astype(np.int64) & 0xFFFF for i in range(4)]
    rows, keys = [], []
    for exact in range(4):
        x, y, z = (parts[i] for i in range(4) if i != exact)
        rest = x | y << 16 | z << 32
        for half in range(2):
            index = np.sort(nearby_indices(rest >> 24 * half & 0x7FFFFF), axis=1)
            new = np.ones(index.shape, bool)
            new[:, 1:] = index[:, 1:] != index[:, :-1]
            at, col = np.nonzero(new)
            rows.append(at)
            keys.append((exact * 2 + half) << 28 | parts[exact][at] << 12 | index[at, col])
    return np.concatenate(rows), np.concatenate(keys)


def _link_sorted(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges among rows of equal key (rows sorted by key)."""
    a, b = np.empty(0, np.uint64), np.empty(0, np.uint64)
    at, lag = np.arange(len(keys)), 1
    while True:
        at = at[at + lag < len(keys)]
        at = at[keys[at] == keys[at + lag]]
        if not len(at):
            break
        close = np.bitwise_count(prints[at] ^ prints[at + lag]) <= max_bits
        a = np.concatenate([a, prints[at[close]]])
        b = np.concatenate([b, prints[at[close] + lag]])
        if len(a) > 1_000_000:
            a, b = _forest(a, b)
        lag += 1
    return _forest(a, b)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(a):
        return a, b
    node, root = local_components(a, b)
    return node[node != root], root[node != root]


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("hot", pa.bool_())])


def compare_keys(batches, max_bits: int = MAX_BITS, hot_key: int = HOT_KEY):
    """Edges from a stream of ``(key, fp)`` sorted by key; members of a key
    with more than ``hot_key`` rows leave as ``(fp, fp, hot)``."""
    def out(a, b, hot):
        for i in range(0, len(a), 50_000):
            x, y = a[i:i + 50_000], b[i:i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.uint64).view(np.int64)), pa.array(y.astype(np.uint64).view(np.int64)),
                 pa.array(np.full(len(x), hot))], schema=EDGES)

    def settle(keys, prints):
        _, first, size = np.unique(keys, return_index=True, return_counts=True)
        large = np.repeat(size > hot_key, size)
        if large.any():
            yield from out(prints[large], prints[large], True)
            keys, prints = keys[~large], prints[~large]
        yield from out(*_link_sorted(keys, prints, max_bits), False)

    keys, prints = np.empty(0, np.int64), np.empty(0, np.uint64)
    spilled = None  # a hot key whose first rows have already left
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            k = batch.column(0).to_numpy()
            p = batch.column(1).to_numpy().view(np.uint64)
            if spilled is not None:
                same = k == spilled
                yield from out(p[same], p[same], True)
                if not same.all():
                    spilled = None
                k, p = k[~same], p[~same]
            keys, prints = np.concatenate([keys, k]), np.concatenate([prints, p])
            if len(keys) < SORTED_ROWS:
                continue
            whole = keys != keys[-1]  # the last key may go on in the next batch
        else:
            whole = np.ones(len(keys), bool)
        yield from settle(keys[whole], prints[whole])
        keys, prints = keys[~whole], prints[~whole]
        if len(keys) > hot_key:
            yield from out(prints, prints, True)
            spilled, keys, prints = keys[0], keys[:0], prints[:0]


def _hot_edges(members: DataFrame) -> DataFrame:
    """Exact links of fingerprints in oversized keys, linear in their number
    (2,081 neighbours each); see the module's description."""
    masks = [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i in range(64) for j in range(i)]

    def spread(batches):
        flips = np.array(masks, np.uint64)
        for batch in batches:
            for p in batch.column(0).to_numpy().view(np.uint64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((p ^ flips).view(np.int64)), pa.array(np.full(len(flips), p).view(np.int64)),
                     pa.array(np.arange(len(flips)) <= 64)], names=["x", "fp", "near"])
    listed = members.mapInArrow(spread, "x long, fp long, near boolean")
    centre = listed.filter("near").groupBy("x").agg(F.min("fp").alias("centre"))
    return listed.join(centre, "x").select(F.col("fp").alias("a"), F.col("centre").alias("b")).distinct()


def link_fingerprints(prints: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """``(fp, root)``: the component of every distinct ``fp`` (signed long),
    linking at ``MAX_BITS`` or fewer differing bits."""
    spark = prints.sparkSession

    def spread(batches):
        for batch in batches:
            p = batch.column(0).to_numpy()
            at, keys = fuzzy_keys(p.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(p[at])], names=["key", "fp"])
    keyed = prints.select("fp").mapInArrow(spread, "key long, fp long")
    wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    edges = saved(keyed.repartition(wide, "key").sortWithinPartitions("key")
                  .mapInArrow(lambda it: compare_keys(it, MAX_BITS, hot_key), "a long, b long, hot boolean")
                  .distinct(), "simhash-edges")
    links = edges.filter("not hot").select("a", "b")
    hot = edges.filter("hot").select("a").distinct()
    if not hot.isEmpty():
        links = links.union(_hot_edges(hot))
    roots = connected_components(links).withColumnsRenamed({"node": "fp"})
    return prints.select("fp").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def fingerprints(docs: DataFrame, *carry) -> DataFrame:
    """``(doc_id, fp)`` of every whole text, ``fp`` as a signed long, and the
    columns ``carry`` of its row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    types = [f"`{n}` {t}" for n, t in rows.dtypes[2:]]

    def run(batches):
        give_back()
        for b in batches:
            p = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), *b.columns[2:]],
                                             names=["doc_id", "fp", *b.schema.names[2:]])
    return rows.mapInArrow(run, ", ".join(["doc_id long, fp long", *types]))


def representatives(docs: DataFrame, key, hot_key: int = HOT_KEY) -> tuple[DataFrame, DataFrame]:
    """``(row_key)`` of one row of each component, and ``(row_key, n)`` of the
    keys that several rows have. ``key`` names a row by all that it holds; of a
    component the smallest ``(doc_id, key)`` stays, null ids last. Minima are
    taken per fingerprint, then per component, both before the exchange."""
    prints = saved(fingerprints(docs, key.alias("row_key")), "simhash-rows")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    distinct = saved(prints.groupBy("fp").agg(F.min(order).alias("least")), "simhash-least")
    rooted = distinct.join(link_fingerprints(distinct.select("fp"), hot_key), "fp")
    chosen = rooted.groupBy("root").agg(F.min("least").alias("least")).select("least.row_key")
    again = prints.groupBy("row_key").agg(F.count("*").alias("n")).filter("n > 1")
    return chosen, again


def simhash_near_dedup(docs: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """``doc_id, fingerprint, component_id, class_fingerprint`` per document."""
    prints = saved(fingerprints(docs), "simhash-prints")
    distinct = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    rooted = distinct.join(link_fingerprints(distinct, hot_key), "fp")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "root", "component_id")
    return (prints.join(classes, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id", F.lower(F.lpad(F.hex("root"), 16, "0")).alias("class_fingerprint")))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash_near_dedup(documents(spark, sf_dir))
