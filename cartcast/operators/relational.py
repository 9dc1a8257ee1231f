"""Relational operators: joins, per-group picks, sampling, indexing (J*, A*, O*).

Sampling and splitting are keyed by a salted digest of a row key, so the
result does not depend on partitioning or retries (quirk Q17), and the same
digest is writable in other SQL dialects.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS = 52  # hex digits of the digest that a double holds exactly


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_unit(key, salt: int = 0) -> Column:
    """Deterministic, well-mixed value in (0, 1) from a key of any simple type.

    The leading 52 bits of the MD5 digest of ``"<salt>:<key>"``: salt and key
    are one message, so streams of different salts are unrelated for any pair
    of keys, whole 64-bit keys (and strings) count, and the same digest exists
    in other SQL dialects. A null key gives null.
    """
    text = F.concat(F.lit(f"{int(salt)}:"), _col(key).cast("string"))
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10)
    return (digits.cast("long") + F.lit(0.5)) / F.lit(float(1 << HASH_BITS))


def hash_unit_sql(key: str, salt: int = 0) -> str:
    """SQL twin of ``hash_unit`` (for the oracle queries)."""
    digits = f"CAST(('0x' || md5('{int(salt)}:' || CAST({key} AS VARCHAR))[1:{HASH_BITS // 4}]) AS BIGINT)"
    return f"(({digits} + 0.5::DOUBLE) / {float(1 << HASH_BITS)!r}::DOUBLE)"


def hash_sample(df: DataFrame, key: str, fraction: float, salt: int = 0) -> DataFrame:
    """Bernoulli sample without replacement, repeatable."""
    return df.filter(hash_unit(key, salt) < F.lit(fraction))


def hash_split(df: DataFrame, key: str, weights: Sequence[float], salt: int = 0,
               out: str = "split") -> DataFrame:
    """Tag each row with the index of its split (O13); filter per split."""
    total = float(sum(weights))
    u = hash_unit(key, salt)
    edges, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        edges.append(acc)
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(edges))):
        expr = F.when(u < F.lit(edges[i]), F.lit(i)).otherwise(expr)
    return df.withColumn(out, expr)


def split_frames(df: DataFrame, key: str, weights: Sequence[float], salt: int = 0):
    tagged = hash_split(df, key, weights, salt, "_split")
    return [tagged.filter(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def rebalance(df: DataFrame, label: str, key: str, neg_fraction: float,
              salt: int = 0) -> DataFrame:
    """Keep every positive row, a repeatable fraction of negatives."""
    neg = df.filter(F.col(label) == 0).filter(hash_unit(key, salt) < F.lit(neg_fraction))
    return neg.unionByName(df.filter(F.col(label) > 0))


def stratified_exact(df: DataFrame, stratum: str, key: str,
                     fractions: Mapping[object, float], salt: int = 0,
                     buckets: int = 1 << 16) -> DataFrame:
    """Exactly ``ceil(f * n_stratum)`` rows per stratum, lowest (hash, key) first.

    No task holds a whole stratum: the hash is cut into ``buckets`` ranges and
    counted per (stratum, bucket) with a partial aggregate (at most
    ``len(fractions) * buckets`` rows, the bound that makes the broadcast
    safe). Whole buckets under the quota are kept by a filter; only the one
    boundary bucket per stratum (1/``buckets`` of it) is ranked by a window.
    """
    s = F.col(stratum)
    frac = None
    for k, f in fractions.items():
        frac = (F.when(s == F.lit(k), F.lit(float(f))) if frac is None
                else frac.when(s == F.lit(k), F.lit(float(f))))
    h = (df.filter(s.isin(list(fractions)))
           .withColumn("_h", hash_unit(key, salt))
           .withColumn("_b", F.floor(F.col("_h") * buckets).cast("int")))
    hist = h.groupBy(stratum, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(stratum)
    cum = (hist.withColumn("_n", F.sum("_c").over(w))
               .withColumn("_cum", F.sum("_c").over(w.orderBy("_b")))
               .withColumn("_q", F.ceil(frac * F.col("_n")))
               .withColumn("_prev", F.col("_cum") - F.col("_c"))
               .filter(F.col("_prev") < F.col("_q"))
               .select(stratum, "_b", "_q", "_prev", "_cum"))
    tagged = h.join(F.broadcast(cum), [stratum, "_b"])
    whole = tagged.filter(F.col("_cum") <= F.col("_q"))
    edge = tagged.filter(F.col("_cum") > F.col("_q"))
    wr = Window.partitionBy(stratum, "_b").orderBy("_h", key)
    edge = (edge.withColumn("_r", F.row_number().over(wr))
                .filter(F.col("_r") <= F.col("_q") - F.col("_prev"))
                .drop("_r"))
    return whole.unionByName(edge).drop("_h", "_b", "_q", "_prev", "_cum")


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                    n: int, rank_col: str | None = None) -> DataFrame:
    """Top ``n`` rows per group by ``order`` (O4). Window over each group.

    Spark plans this as a partial window-group-limit before the shuffle,
    so each task forwards at most ``n`` rows per group.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


def first_per_group(df: DataFrame, group: Sequence[str], order_cols: Sequence[str],
                    value_cols: Sequence[str]) -> DataFrame:
    """First row per group by ``order_cols`` (A10): ``min_by`` aggregate.

    An aggregate with map-side partial merge: a hot group never sits in
    one task's memory as a list.
    """
    key = F.struct(*[F.col(c) for c in order_cols])
    row = F.struct(*[F.col(c) for c in list(order_cols) + list(value_cols)])
    picked = df.groupBy(*group).agg(F.min_by(row, key).alias("_r"))
    return picked.select(*group, *[F.col(f"_r.{c}").alias(c)
                                   for c in list(order_cols) + list(value_cols)])


def dense_index(df: DataFrame, order_col: str, out: str = "idx",
                num_partitions: int | None = None, tie: str | None = None) -> DataFrame:
    """Consecutive 0-based index in ``order_col`` order, without a global window.

    Range-partition, then index = rows in earlier partitions + position in
    the partition. The per-partition counts are one row per partition. The
    partitioned rows are checkpointed (shared ``spark.checkpoint.dir``) so
    both passes see the same partitioning, and lineage is cut. ``tie`` orders
    and spreads rows of equal ``order_col`` (default: a hash of the row).
    """
    n = num_partitions or df.sparkSession.sparkContext.defaultParallelism
    breaker = F.col(tie) if tie else F.xxhash64(*[F.col(c) for c in df.columns])
    parted = (df.withColumn("_tie", breaker)
                .repartitionByRange(n, F.col(order_col), F.col("_tie"))
                .sortWithinPartitions(order_col, "_tie").drop("_tie")
                .withColumn("_mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    pid = F.shiftright(F.col("_mid"), 33)
    local = F.col("_mid") - F.shiftleft(pid, 33)
    counts = parted.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_c"))
    offsets = counts.select(
        "_pid",
        (F.sum("_c").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    offsets = offsets.fillna(0, ["_off"])
    return (parted.join(F.broadcast(offsets), pid == F.col("_pid"))
                  .withColumn(out, F.col("_off") + local)
                  .drop("_mid", "_pid", "_off"))


def global_running_sums(df: DataFrame, order_col: str, sums: Mapping[str, str],
                        num_partitions: int | None = None) -> tuple[DataFrame, dict]:
    """Inclusive running sums (``value column -> result column``) in
    ``order_col`` order over the whole frame, without a single-partition
    window, and the grand totals.

    Range-partition on the order column, take per-partition totals (one row
    per partition), turn them into offsets, and add each row's running sums
    inside its own partition. Rows are checkpointed to the shared
    ``spark.checkpoint.dir`` so both passes see the same partitioning.
    Ties in ``order_col`` should be pre-aggregated by the caller.
    """
    n = num_partitions or df.sparkSession.sparkContext.defaultParallelism
    parted = (df.repartitionByRange(n, F.col(order_col))
                .withColumn("_pid", F.spark_partition_id())
                .checkpoint(eager=True))
    per_part = sorted(parted.groupBy("_pid").agg(*[F.sum(v).alias(o) for v, o in sums.items()]).collect(),
                      key=lambda r: r["_pid"])  # one row per partition
    before = dict.fromkeys(sums.values(), 0)
    offsets = []
    for r in per_part:
        offsets.append((r["_pid"], *before.values()))
        before = {o: x + (r[o] or 0) for o, x in before.items()}
    kind = {o: dict(parted.agg(F.sum(v)).dtypes).popitem()[1] for v, o in sums.items()}
    off = df.sparkSession.createDataFrame(
        offsets, "_pid int, " + ", ".join(f"_off_{o} {kind[o]}" for o in sums.values()))
    w = Window.partitionBy("_pid").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    out = parted.select("*", *[F.sum(v).over(w).alias(f"_loc_{o}") for v, o in sums.items()]) \
        .join(F.broadcast(off), "_pid")
    keep = [c for c in df.columns]
    return out.select(*keep, *[(F.col(f"_off_{o}") + F.col(f"_loc_{o}")).alias(o) for o in sums.values()]), before


def global_running_sum(df: DataFrame, order_col: str, value_col: str,
                       out: str = "running", num_partitions: int | None = None) -> DataFrame:
    """One running sum (see :func:`global_running_sums`)."""
    return global_running_sums(df, order_col, {value_col: out}, num_partitions)[0]


def poisson_thresholds(mean: float, tol: float = 1e-12) -> list[float]:
    """CDF of Poisson(mean) at k = 0, 1, … until within ``tol`` of 1."""
    import math
    p, k = math.exp(-mean), 0
    if mean < 0 or p == 0.0:
        raise ValueError(f"mean {mean} has no Poisson table (exp(-mean) underflows)")
    out, c = [], p
    while 1.0 - c > tol and p > 0.0:
        out.append(c)
        k += 1
        p *= mean / k
        c += p
    out.append(c)
    return out


def hash_sample_with_replacement(df: DataFrame, key: str, fraction: float,
                                 salt: int = 0) -> DataFrame:
    """Sample with replacement (O9), repeatable: each row appears k times with
    k ~ Poisson(fraction), k taken from the inverse CDF at the row's hash
    value. Independent of partitioning and retries (quirk Q17)."""
    u = hash_unit(key, salt)
    cdf = poisson_thresholds(fraction)
    k = F.lit(len(cdf))
    for i in reversed(range(len(cdf))):
        k = F.when(u < F.lit(cdf[i]), F.lit(i)).otherwise(k)
    return (df.withColumn("_k", k).filter(F.col("_k") > 0)
              .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_k"))))
              .drop("_k"))


def hash_sample_by(df: DataFrame, stratum: str, key: str, fractions: Mapping[object, float],
                   salt: int = 0) -> DataFrame:
    """Approximate stratified sample (O11), repeatable: a row is kept when its
    hash falls under its stratum's fraction (strata not listed are dropped)."""
    s = F.col(stratum)
    frac = F.lit(0.0)
    for k, f in fractions.items():
        frac = F.when(s == F.lit(k), F.lit(float(f))).otherwise(frac)
    return df.filter(hash_unit(key, salt) < frac)


def hash_normal(key, salt: int = 0) -> Column:
    """Standard normal value from a key (O15), repeatable: Box–Muller over
    two independent hash uniforms."""
    u1, u2 = hash_unit(key, salt + 1), hash_unit(key, salt + 2)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * 3.141592653589793 * u2)
