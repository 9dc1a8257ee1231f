"""Relational operators: hashing, sampling, indexing, running sums."""

import pandas as pd
from pyspark.sql import functions as F

from cartcast.operators import relational as R


def test_hash_is_spread(spark):
    df = spark.range(0, 20000)
    u = [r.u for r in df.select(R.hash_unit("id").alias("u")).collect()]
    assert 0 < min(u) and max(u) < 1
    # a 10 % sample is spread over the whole key range, not a prefix
    s = R.hash_sample(df, "id", 0.1).agg(F.count("id").alias("n"), F.max("id").alias("hi")).first()
    assert 1700 < s.n < 2300 and s.hi > 19000


def test_hash_split_partition(spark):
    df = spark.range(0, 5000)
    parts = R.split_frames(df, "id", [0.8, 0.2])
    a, b = parts[0].count(), parts[1].count()
    assert a + b == 5000 and 3800 < a < 4200


def test_stratified_exact_counts(spark):
    rows = [(i, "hot" if i % 3 else "cold") for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, s string")
    out = R.stratified_exact(df, "s", "k", {"hot": 0.1, "cold": 0.25}, buckets=64)
    got = {r.s: r.n for r in out.groupBy("s").agg(F.count("k").alias("n")).collect()}
    assert got == {"hot": 200, "cold": 250}


def test_dense_index_consecutive(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1001).alias("k"))
    idx = R.dense_index(df, "k", "i", num_partitions=4).orderBy("k").toPandas()
    assert idx["i"].tolist() == list(range(1000))


def test_global_running_sum_matches_pandas(spark):
    pdf = pd.DataFrame({"x": list(range(500)), "v": [i % 7 for i in range(500)]})
    df = spark.createDataFrame(pdf)
    out = R.global_running_sum(df, "x", "v", "c", num_partitions=5).orderBy("x").toPandas()
    assert out["c"].tolist() == pdf["v"].cumsum().tolist()


def test_first_per_group_and_topn(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z")], "g int, o int, v string")
    first = {r.g: r.v for r in R.first_per_group(df, ["g"], ["o"], ["v"]).collect()}
    assert first == {1: "a", 2: "z"}
    top = R.top_n_per_group(df, ["g"], [F.col("o").desc()], 2, "r").collect()
    assert sorted((r.g, r.o) for r in top) == [(1, 2), (1, 3), (2, 5)]


def test_with_replacement_sample_is_partition_independent(spark):
    df = spark.range(0, 20000)
    a = R.hash_sample_with_replacement(df.repartition(3), "id", 0.5).groupBy("id").count()
    b = R.hash_sample_with_replacement(df.repartition(7), "id", 0.5).groupBy("id").count()
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    n = R.hash_sample_with_replacement(df, "id", 0.5).count()
    assert 9000 < n < 11000


def test_hash_normal_moments(spark):
    z = spark.range(0, 50000).select(R.hash_normal("id").alias("z"))
    m = z.agg(F.avg("z").alias("m"), F.stddev("z").alias("s")).first()
    assert abs(m.m) < 0.03 and abs(m.s - 1) < 0.03


def test_salted_streams_independent(spark):
    """The split (salt 1) of rows kept by a 5 % sample (salt 0) is still ~80/20."""
    df = spark.range(0, 200000)
    kept = df.filter(R.hash_unit("id", 0) < 0.05)
    share = kept.agg(F.avg((R.hash_unit("id", 1) < 0.8).cast("double"))).first()[0]
    assert abs(share - 0.8) < 0.03


def test_salted_streams_are_not_shifted_copies(spark):
    """hash(k, s) is no hash(k + j, t) for any small shift, nor for the shift
    that a salt times a constant would give; halves of 64-bit keys count."""
    n = 3000
    df = spark.range(0, n).select("id", *[R.hash_unit(F.col("id") + off, s).alias(f"s{s}_{k}")
                                          for s in (0, 1, 2) for k, off in enumerate((0, 1, 1000003, 1 << 31, (1 << 31) - 2, 1 << 40))])
    pdf = df.toPandas().drop(columns="id")
    values = {c: set(pdf[c]) for c in pdf}
    for a in values:
        for b in values:
            if a[:2] < b[:2]:
                assert not values[a] & values[b], (a, b)
        assert len(values[a]) == n
    corr = pdf.corr().abs().to_numpy().copy()
    corr[range(len(corr)), range(len(corr))] = 0
    assert corr.max() < 0.1


def test_poisson_table_of_large_means():
    import pytest
    t = R.poisson_thresholds(250.0)
    assert len(t) > 300 and abs(t[-1] - 1) < 1e-9 and t == sorted(t)
    with pytest.raises(ValueError):
        R.poisson_thresholds(800.0)
