"""DuckDB SQL fragments shared by the oracle queries."""

from __future__ import annotations

from ..operators.horizons import HORIZONS
from ..plans.contest import ACTION_SHIFT_DAYS, ORDER_CUTOFF

OLOG = """olog AS (
  SELECT o.o_custkey AS userId, l.l_partkey AS productId, o.o_orderkey AS orderId,
         CAST(o.o_orderdate AS DATE) AS orderDate, c.c_nationkey AS orderArea,
         CAST(l.l_quantity AS INTEGER) AS buyNum
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey)"""

ALOG = f"""alog AS (
  SELECT user_id AS userId,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS productId,
         CAST(ts AS DATE) - {ACTION_SHIFT_DAYS} AS actionDate, 1 AS actionNum,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 0 END AS actionType
  FROM events)"""

CLOG = """clog AS (
  SELECT o_custkey AS userId, o_orderdate AS commentTime, o_orderkey AS orderId,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS scoreLevel
  FROM orders)"""

USERS = """users AS (
  SELECT c_custkey AS userId,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
              WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 END AS segment,
         c_nationkey AS nation,
         GREATEST(CAST(FLOOR(c_acctbal / 2000) AS INTEGER), 0) AS grade
  FROM customer)"""

PRODUCTS = r"""products AS (
  SELECT p_partkey AS productId, p_retailprice AS price,
         CAST(regexp_extract(p_brand, '(\d+)$', 1) AS INTEGER) AS cate, p_size AS size
  FROM part)"""


def hsum(day: str, measure: str, name: str, horizons=HORIZONS) -> str:
    return ",\n  ".join(
        f"CAST(COALESCE(SUM(CASE WHEN {day} >= 0 AND {day} < {n} THEN {measure} END), 0) AS BIGINT) AS {name.format(n=n)}"
        for n in horizons)


def order_features_sql(cutoff=ORDER_CUTOFF) -> str:
    return f"""ofeat AS (
  SELECT userId, productId,
  {hsum(f"date_diff('day', orderDate, DATE '{cutoff}')", 'buyNum', 'o{n}')}
  FROM olog WHERE orderDate < DATE '{cutoff}'
  GROUP BY userId, productId)"""


def action_features_sql(cutoff=ORDER_CUTOFF) -> str:
    d = f"date_diff('day', actionDate, DATE '{cutoff}')"
    parts = []
    for n in HORIZONS:
        for k in (1, 2):
            parts.append(
                f"CAST(COALESCE(SUM(CASE WHEN {d} >= 0 AND {d} < {n} THEN "
                f"CASE WHEN actionType = {k} THEN actionNum ELSE 0 END END), 0) AS BIGINT) AS ua{k}_{n}")
    return f"""afeat AS (
  SELECT userId, productId,
  {",\n  ".join(parts)}
  FROM alog WHERE actionDate < DATE '{cutoff}'
  GROUP BY userId, productId)"""


def comment_features_sql(cutoff=ORDER_CUTOFF) -> str:
    return f"""cday AS (
  SELECT c.userId, op.productId,
         CAST(TRUNC((epoch(TIMESTAMP '{cutoff}') - epoch(c.commentTime)) / 86400) AS INTEGER) AS d,
         c.scoreLevel, c.commentTime, c.orderId
  FROM clog c JOIN (SELECT DISTINCT l_orderkey AS orderId, l_partkey AS productId FROM lineitem) op
    ON c.orderId = op.orderId),
cper AS (
  SELECT userId, productId, d, arg_max(scoreLevel, (commentTime, orderId)) AS level
  FROM cday WHERE d > 0 GROUP BY userId, productId, d),
cfeat AS (
  SELECT userId, productId,
  {hsum('d', 'CASE level WHEN 1 THEN 3 WHEN 2 THEN 1 WHEN 3 THEN -4 END', 's{n}')}
  FROM cper GROUP BY userId, productId)"""


def labels_sql(cutoff=ORDER_CUTOFF) -> str:
    return f"""lab AS (
  SELECT userId, productId, CAST(MIN(day(orderDate)) AS INTEGER) AS label
  FROM olog WHERE orderDate >= DATE '{cutoff}' AND orderDate < DATE '{cutoff}' + INTERVAL 1 MONTH
  GROUP BY userId, productId)"""
