"""A key holding a third of all rows: aggregates stay partial, joins split."""

from pyspark.sql import functions as F

from cartcast.operators.horizons import horizon_sums


def _conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_user_dimension_join_is_split(spark):
    n = 60000
    pairs = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("userId"),
        F.col("id").alias("productId"))
    users = spark.range(0, n).select(F.col("id").alias("userId"), (F.col("id") % 5).alias("segment"))
    old = _conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    try:
        j = pairs.join(users, "userId", "left")
        assert len(j.collect()) == n                # whole result, nothing dropped
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan
    finally:
        _restore(spark, old)


def test_hot_pair_horizon_sums_partial(spark):
    n = 30000
    rows = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("userId"),
        F.lit(7).alias("productId"), (F.col("id") % 30).cast("int").alias("d"), F.lit(1).alias("x"))
    out = horizon_sums(rows, ["userId", "productId"], "d", {"s{n}": "x"}, (5, 400))
    hot = out.filter("userId = -1").first()
    assert hot.s400 == n // 3 and hot.s5 == sum(1 for i in range(0, n, 3) if i % 30 < 5)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan               # map-side combine before the shuffle
