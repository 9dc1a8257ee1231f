"""Horizon features and contest quirks on hand-made frames (FIXTURES §C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartcast.functions.codes import CATEGORY_CODES, recode
from cartcast.functions.dates import days_before, elapsed_days
from cartcast.plans import features as FT

CUT = "2017-04-01"


def d(s):
    return dt.date.fromisoformat(s)


@pytest.fixture
def orders_mini(spark):
    rows = [  # user, product, order, date, qty
        (1, 10, 100, d("2017-03-31"), 1),   # 1 day before
        (1, 10, 101, d("2017-03-28"), 2),   # 4 days
        (1, 10, 102, d("2017-03-27"), 4),   # 5 days: outside o5
        (1, 10, 103, d("2016-02-27"), 8),   # 399 days: inside o400
        (1, 10, 104, d("2016-02-26"), 16),  # 400 days: outside o400
        (1, 10, 105, d("2017-04-04"), 1),   # cutoff month: label 4
        (1, 10, 106, d("2017-04-09"), 1),   # cutoff month again
        (2, 20, 107, d("2017-04-02"), 1),   # label only: not in population
    ]
    return spark.createDataFrame(rows, "userId long, productId long, orderId long, orderDate date, buyNum int")


def test_horizon_edges(orders_mini):
    f = FT.order_features(orders_mini, CUT).collect()
    assert len(f) == 1
    r = f[0]
    assert r.o5 == 3          # days 1 and 4
    assert r.o10 == 7         # + day 5
    assert r.o400 == 15       # day 399 in, day 400 out


def test_label_policies(orders_mini):
    first = FT.order_features(orders_mini, CUT, with_label=True).collect()
    assert [(r.userId, r.label) for r in first] == [(1, 4)]
    allp = FT.purchase_labels(orders_mini, CUT, "all").orderBy("label").collect()
    assert [r.label for r in allp] == [4, 9, 2] or sorted(r.label for r in allp) == [2, 4, 9]


def test_missing_date_sentinel(spark):
    df = spark.createDataFrame([(None,), (d("2017-03-31"),)], "x date")
    got = [r.v for r in df.select(days_before(CUT, "x").alias("v")).collect()]
    assert got == [100000, 1]


def test_elapsed_days_noon_and_24h(spark):
    rows = [(dt.datetime(2017, 3, 31, 1, 0, 0),),    # 23 h before: 0
            (dt.datetime(2017, 3, 30, 12, 0, 0),),   # noon, 36 h: 1 (24-hour parse)
            (dt.datetime(2017, 4, 2, 0, 0, 0),)]     # after cutoff: negative
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = [r.v for r in df.select(elapsed_days(CUT, "t").alias("v")).collect()]
    assert got == [0, 1, -1]


def test_comment_scores(spark):
    comments = spark.createDataFrame([
        (1, dt.datetime(2017, 3, 31, 1, 0), 500, 1),    # < 24 h: dropped (Q4)
        (1, dt.datetime(2017, 3, 29, 8, 0), 501, 3),    # day 2, earlier
        (1, dt.datetime(2017, 3, 29, 20, 0), 502, 1),   # day 2, later: wins (Q5)
        (1, dt.datetime(2017, 3, 20, 0, 0), 503, 2),    # order with two products (Q6)
        (1, dt.datetime(2017, 3, 20, 0, 0), 999, 1),    # orphan order: vanishes
    ], "userId long, commentTime timestamp_ntz, orderId long, scoreLevel int")
    op = spark.createDataFrame([(500, 10), (501, 10), (502, 10), (503, 10), (503, 11)],
                               "orderId long, productId long")
    got = {(r.productId): (r.s5, r.s20) for r in FT.comment_features(comments, op, CUT).collect()}
    assert got[10] == (3, 4)      # day 2 → +3; day 12 → +1
    assert got[11] == (0, 1)


def test_recode_strict_and_lenient(spark):
    df = spark.createDataFrame([(101,), (46,), (99,)], "c int")
    lenient = [r.v for r in df.select(recode("c", CATEGORY_CODES).alias("v")).collect()]
    assert lenient == [0, 5, None]
    with pytest.raises(Exception):
        df.select(recode("c", CATEGORY_CODES, strict=True).alias("v")).collect()


def test_flagship_shape(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    cols = df.columns
    assert cols[:2] == ["userId", "productId"]
    assert {"o5", "o400", "ua1_5", "ua2_400", "s5", "s400", "label"} <= set(cols)
    assert df.count() > 0


def test_latest_code_equals_max_by(spark):
    from cartcast.operators.horizons import latest_code_per_day, one_per_day
    t = dt.datetime(2017, 3, 1, 10, 0, 0)
    rows = [(1, 1, t, 5, 2), (1, 1, t, 7, 3),             # same second: larger order wins
            (1, 2, t, 9, 1), (1, 2, t + dt.timedelta(hours=1), 2, 2),  # later time wins
            (2, 1, t, 1, 1)]
    df = spark.createDataFrame(rows, "u long, d int, t timestamp_ntz, o long, c int")
    a = {(r.u, r.d): r.code for r in latest_code_per_day(df, ["u"], "d", "t", "o", "c").collect()}
    b = {(r.u, r.d): r.code for r in one_per_day(df, ["u"], "d", "c", ["t", "o"], out="code").collect()}
    assert a == b == {(1, 1): 3, (1, 2): 2, (2, 1): 1}


def test_latest_code_checks_its_range(spark):
    from cartcast.operators.horizons import latest_code_per_day
    ddl = "u int, d int, t timestamp, o long, c int"
    t = dt.datetime(2000, 1, 1)
    rows = [(1, 1, t, 5, 2), (1, 1, t, None, 7), (1, 1, t, 9, None)]
    assert [r.code for r in latest_code_per_day(spark.createDataFrame(rows, ddl), ["u"], "d", "t", "o", "c").collect()] == [2]
    for bad in ((1, 1, t, 5, 10), (1, 1, t, -1, 3)):
        with pytest.raises(Exception, match="out of range"):
            latest_code_per_day(spark.createDataFrame([bad], ddl), ["u"], "d", "t", "o", "c").collect()


def test_cutoffs_reach_the_scans(spark):
    """Orders, actions and comments are bounded by date in the Parquet scan."""
    import re

    from cartcast.suite.q_features import purchase_features_df

    from .conftest import SF_SMALL
    plan = purchase_features_df(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    pushed = " ".join(re.findall(r"PushedFilters: \[[^\]]*", plan))
    assert "LessThan(o_orderdate" in pushed and "LessThan(ts," in pushed and "LessThanOrEqual(o_orderdate" in pushed


def test_feature_partitions_grow_with_the_rows(spark, monkeypatch):
    """The pairs are dealt by rows, once, and give the same table."""
    from cartcast.suite import q_features as Q

    from .conftest import SF_SMALL
    monkeypatch.setattr(Q, "_PART_ROWS", 200)
    df = Q.purchase_features_df(spark, SF_SMALL)
    parts = -(-Q.Tables(spark, SF_SMALL).lineitem.count() // 200)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {parts}), REPARTITION_BY_NUM") >= 3
    t = Q.Tables(spark, SF_SMALL)
    plain = Q.FT.purchase_features(Q.C.order_log(t), Q.C.order_products(t), Q.C.action_log(t, Q.C.ORDER_CUTOFF),
                                   Q.C.comment_log(t), Q.C.user_table(t), Q.C.product_table(t), Q.C.ORDER_CUTOFF)
    assert df.schema == plain.schema
    assert sorted(map(str, df.collect())) == sorted(map(str, plain.collect()))
