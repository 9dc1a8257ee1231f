"""Queries for the feature build: L2, L3, A11–A16, F1–F3."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import days_before, elapsed_days, month_key
from ..operators import horizons as H
from ..plans import contest as C
from ..plans import features as FT
from ..tables import Tables
from . import query
from .sqlparts import (ALOG, CLOG, OLOG, PRODUCTS, USERS, action_features_sql,
                       comment_features_sql, labels_sql, order_features_sql)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


@query("horizon_order_sums",
       _with(OLOG, order_features_sql()) + "SELECT * FROM ofeat")
def horizon_order_sums(spark, sf):
    return FT.order_features(C.order_log(Tables(spark, sf)), C.ORDER_CUTOFF)


@query("horizon_action_sums",
       _with(ALOG, action_features_sql()) + "SELECT * FROM afeat")
def horizon_action_sums(spark, sf):
    return FT.action_features(C.action_log(Tables(spark, sf), C.ORDER_CUTOFF), C.ORDER_CUTOFF)


@query("horizon_scores",
       _with(OLOG, CLOG, comment_features_sql()) + "SELECT * FROM cfeat")
def horizon_scores(spark, sf):
    t = Tables(spark, sf)
    return FT.comment_features(C.comment_log(t), C.order_products(t), C.ORDER_CUTOFF)


def _purchase_features_sql() -> str:
    cols = ["f.userId", "f.productId"] + [f"f.o{n}" for n in H.HORIZONS]
    for n in H.HORIZONS:
        cols += [f"COALESCE(a.ua1_{n}, 0) AS ua1_{n}", f"COALESCE(a.ua2_{n}, 0) AS ua2_{n}"]
    cols += [f"COALESCE(c.s{n}, 0) AS s{n}" for n in H.HORIZONS]
    cols += ["COALESCE(u.segment, 0) AS segment", "COALESCE(u.nation, 0) AS nation",
             "COALESCE(u.grade, 0) AS grade", "COALESCE(p.price, 0.0) AS price",
             "COALESCE(p.cate, 0) AS cate", "COALESCE(p.size, 0) AS size",
             "COALESCE(l.label, 0) AS label"]
    return (_with(OLOG, ALOG, CLOG, USERS, PRODUCTS, order_features_sql(),
                  action_features_sql(), comment_features_sql(), labels_sql())
            + "SELECT " + ", ".join(cols) + """
FROM ofeat f
LEFT JOIN afeat a ON a.userId = f.userId AND a.productId = f.productId
LEFT JOIN cfeat c ON c.userId = f.userId AND c.productId = f.productId
LEFT JOIN users u ON u.userId = f.userId
LEFT JOIN products p ON p.productId = f.productId
LEFT JOIN lab l ON l.userId = f.userId AND l.productId = f.productId""")


# Most order lines or events whose features one task aggregates.
_PART_ROWS = 250_000


def purchase_features_df(spark, sf):
    t = Tables(spark, sf)
    parts = -(-max(t.lineitem.count(), t.events.count()) // _PART_ROWS)  # counted in the files' footers
    return FT.purchase_features(C.order_log(t), C.order_products(t),
                                C.action_log(t, C.ORDER_CUTOFF), C.comment_log(t),
                                C.user_table(t), C.product_table(t),
                                C.ORDER_CUTOFF, parts=max(parts, spark.sparkContext.defaultParallelism))


query("purchase_features", _purchase_features_sql())(purchase_features_df)


@query("purchase_labels",
       _with(OLOG, labels_sql()) + "SELECT * FROM lab")
def purchase_labels(spark, sf):
    return FT.purchase_labels(C.order_log(Tables(spark, sf)), C.ORDER_CUTOFF)


@query("days_before_cutoff", f"""
SELECT o_orderkey,
       COALESCE(CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{C.ORDER_CUTOFF}') AS INTEGER), 100000) AS days
FROM orders""")
def days_before_cutoff(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", days_before(C.ORDER_CUTOFF, "o_orderdate").alias("days"))


@query("elapsed_days", """
SELECT event_id,
       CAST(TRUNC((epoch(TIMESTAMP '2024-01-25 12:00:00') - epoch(ts)) / 86400) AS INTEGER) AS days
FROM events""")
def elapsed_days_q(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id", elapsed_days("2024-01-25 12:00:00", "ts").alias("days"))


@query("date_parts", """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day
FROM orders""")
def date_parts(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", month_key("o_orderdate").alias("month"),
                    F.dayofmonth("o_orderdate").alias("day"))


@query("group_sum_multi", _with(ALOG) + """
SELECT userId, productId, actionDate,
       CAST(SUM(CASE WHEN actionType = 1 THEN actionNum ELSE 0 END) AS BIGINT) AS type1_num,
       CAST(SUM(CASE WHEN actionType = 2 THEN actionNum ELSE 0 END) AS BIGINT) AS type2_num
FROM alog GROUP BY userId, productId, actionDate""")
def group_sum_multi(spark, sf):
    a = C.action_log(Tables(spark, sf))
    piv = a.select("userId", "productId", "actionDate",
                   *H.pivot_sum(a, "actionType", "actionNum", {1: "t1", 2: "t2"}))
    return (piv.groupBy("userId", "productId", "actionDate")
               .agg(F.sum("t1").cast("long").alias("type1_num"),
                    F.sum("t2").cast("long").alias("type2_num")))


@query("pivot_action_type", _with(ALOG) + """
SELECT userId, productId, actionDate,
       CASE WHEN actionType = 1 THEN actionNum ELSE 0 END AS type1_num,
       CASE WHEN actionType = 2 THEN actionNum ELSE 0 END AS type2_num
FROM alog""")
def pivot_action_type(spark, sf):
    a = C.action_log(Tables(spark, sf))
    return a.select("userId", "productId", "actionDate",
                    *H.pivot_sum(a, "actionType", "actionNum", {1: "type1_num", 2: "type2_num"}))


@query("group_sum_min", _with(OLOG) + f"""
SELECT userId, productId, date_diff('day', orderDate, DATE '{C.ORDER_CUTOFF}') AS d,
       CAST(SUM(buyNum) AS BIGINT) AS buyNum, MIN(orderArea) AS minArea
FROM olog WHERE orderDate < DATE '{C.ORDER_CUTOFF}'
GROUP BY userId, productId, d""")
def group_sum_min(spark, sf):
    o = C.order_log(Tables(spark, sf), with_area=True)
    pre = o.filter(F.col("orderDate") < F.lit(C.ORDER_CUTOFF).cast("date"))
    return (pre.withColumn("d", F.datediff(F.lit(C.ORDER_CUTOFF).cast("date"), "orderDate").cast("long"))
               .groupBy("userId", "productId", "d")
               .agg(F.sum("buyNum").cast("long").alias("buyNum"), F.min("orderArea").alias("minArea")))


@query("first_purchase", _with(OLOG) + """
SELECT userId, productId, CAST(strftime(orderDate, '%Y%m') AS INTEGER) AS month,
       CAST(MIN(day(orderDate)) AS INTEGER) AS day
FROM olog GROUP BY userId, productId, month""")
def first_purchase(spark, sf):
    o = C.order_log(Tables(spark, sf))
    return (o.groupBy("userId", "productId", month_key("orderDate").alias("month"))
             .agg(F.min(F.dayofmonth("orderDate")).alias("day")))


@query("day_map", _with(OLOG) + """
, per_day AS (SELECT userId, productId, CAST(day(orderDate) AS INTEGER) AS dom, SUM(buyNum) AS q
             FROM olog WHERE orderDate >= DATE '2001-01-01' AND orderDate < DATE '2001-02-01'
             GROUP BY userId, productId, dom)
SELECT userId, productId, CAST(COUNT(*) AS BIGINT) AS n_days, CAST(SUM(q) AS BIGINT) AS total,
       CAST(MIN(dom) AS INTEGER) AS first_day
FROM per_day GROUP BY userId, productId""")
def day_map_q(spark, sf):
    """Map day -> units in the label month; checked through its properties."""
    o = C.order_log(Tables(spark, sf))
    m = (o.filter((F.col("orderDate") >= F.lit("2001-01-01").cast("date"))
                  & (F.col("orderDate") < F.lit("2001-02-01").cast("date")))
          .withColumn("dom", F.dayofmonth("orderDate")))
    mp = H.day_map(m, ["userId", "productId"], "dom", "buyNum")
    return mp.select("userId", "productId",
                     F.size("by_day").cast("long").alias("n_days"),
                     F.aggregate(F.map_values("by_day"), F.lit(0).cast("long"),
                                 lambda acc, x: acc + x).alias("total"),
                     F.array_min(F.map_keys("by_day")).alias("first_day"))


def _lookback_sql(target=300, steps=8) -> str:
    elems = ", ".join(
        f"ROUND(COALESCE(SUM(CASE WHEN t BETWEEN {target - k} AND {target} THEN v END), 0.0), 4)"
        for k in range(steps))
    return f"""WITH w AS (
  SELECT l_partkey AS item, CAST(FLOOR(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 7) AS BIGINT) AS t,
         l_quantity AS v FROM lineitem)
SELECT item, [{elems}] AS lookback FROM w GROUP BY item"""


@query("lookback_cumulative", _lookback_sql())
def lookback_cumulative(spark, sf):
    """Weekly look-back vector per part: running sums 0..7 weeks back from week 300."""
    li = Tables(spark, sf).lineitem
    w = li.select(F.col("l_partkey").alias("item"),
                  F.floor(F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")) / 7)
                   .cast("long").alias("t"),
                  F.col("l_quantity").alias("v"))
    out = H.lookback_cumulative(w, ["item"], "t", "v", target=300, steps=8)
    return out.select("item", F.transform("lookback", lambda x: F.round(x, 4)).alias("lookback"))


@query("reverse_time_index", """
WITH w AS (SELECT l_partkey AS item, CAST(FLOOR(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 7) AS BIGINT) AS week,
                  l_quantity AS qty FROM lineitem)
SELECT item, (SELECT MAX(week) FROM w) + 1 - week AS weeks_back, ROUND(SUM(qty), 4) AS qty
FROM w GROUP BY item, week""")
def reverse_time_index(spark, sf):
    """weekly sales re-indexed backwards from the last week (1 = latest),
    the time axis the look-back vectors count on."""
    li = Tables(spark, sf).lineitem
    w = li.select(F.col("l_partkey").alias("item"),
                  F.floor(F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")) / 7)
                   .cast("long").alias("week"), F.col("l_quantity").alias("qty"))
    last = w.agg(F.max("week")).first()[0]  # scalar
    g = w.groupBy("item", "week").agg(F.round(F.sum("qty"), 4).alias("qty"))
    return g.select("item", (F.lit(last + 1) - F.col("week")).alias("weeks_back"), "qty")
