"""Contest-shaped logs derived from the driver tables.

order   = orders ⋈ lineitem (+ customer nation as area)
action  = events (view → type 1, click → type 2; product = props.k)
comment = orders (status F/O/P → level 1/2/3)
user    = customer, product = part
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import clamp_min, recode
from ..tables import Tables

# Fixed values for the stand-ins (driver-data vocabularies, not contest values).
ACTION_TYPES = {"view": 1, "click": 2}
STATUS_LEVELS = {"F": 1, "O": 2, "P": 3}
SEGMENT_CODES = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3, "MACHINERY": 4}

ORDER_CUTOFF = "2001-01-01"
# The events table lies 8424 days after the orders' calendar: action dates are
# shifted back by this constant, so one cutoff holds for every feature.
ACTION_SHIFT_DAYS = 8424


def order_log(t: Tables, with_area: bool = False) -> DataFrame:
    """One row per order line. The customer lookup for ``orderArea`` is only
    planned when asked for (Catalyst cannot drop an unused outer join)."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    cols = [F.col("o_custkey").alias("userId"),
            F.col("l_partkey").alias("productId"),
            F.col("o_orderkey").alias("orderId"),
            F.to_date("o_orderdate").alias("orderDate"),
            F.col("l_quantity").cast("int").alias("buyNum")]
    if with_area:
        area = t.customer.select(F.col("c_custkey").alias("o_custkey"),
                                 F.col("c_nationkey").alias("orderArea"))
        j = j.join(area, "o_custkey", "left")
        cols.insert(4, F.col("orderArea"))
    return j.select(*cols)


def order_products(t: Tables) -> DataFrame:
    """Distinct (orderId, productId) pairs, read from the order lines alone."""
    return (t.lineitem.select(F.col("l_orderkey").alias("orderId"),
                              F.col("l_partkey").alias("productId"))
                      .distinct())


def action_log(t: Tables, before: str | None = None) -> DataFrame:
    """Actions on the orders' calendar; ``before`` keeps those before a date,
    as a bound on the raw time that reaches the scan."""
    e = t.events
    if before:
        end = dt.date.fromisoformat(before) + dt.timedelta(days=ACTION_SHIFT_DAYS)
        e = e.filter(F.col("ts") < F.lit(end.isoformat()).cast(e.schema["ts"].dataType))
    return e.select(F.col("user_id").alias("userId"),
                    F.get_json_object("props", "$.k").cast("long").alias("productId"),
                    F.date_sub(F.to_date("ts"), ACTION_SHIFT_DAYS).alias("actionDate"),
                    F.lit(1).alias("actionNum"),
                    F.coalesce(recode("event_type", ACTION_TYPES), F.lit(0)).alias("actionType"))


def comment_log(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(F.col("o_custkey").alias("userId"),
                    F.col("o_orderdate").alias("commentTime"),
                    F.col("o_orderkey").alias("orderId"),
                    recode("o_orderstatus", STATUS_LEVELS).alias("scoreLevel"))


def user_table(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(F.col("c_custkey").alias("userId"),
                    recode("c_mktsegment", SEGMENT_CODES).alias("segment"),
                    F.col("c_nationkey").alias("nation"),
                    clamp_min(F.floor(F.col("c_acctbal") / 2000).cast("int"), 0).alias("grade"))


def product_table(t: Tables) -> DataFrame:
    p = t.part
    return p.select(F.col("p_partkey").alias("productId"),
                    F.col("p_retailprice").alias("price"),
                    F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int").alias("cate"),
                    F.col("p_size").alias("size"))


def page_views(t: Tables) -> DataFrame:
    """Click-stream page views from events: url from the item key, status 500
    for error events, zip from the user id (S16, T8–T10, T18)."""
    e = t.events
    k = F.get_json_object("props", "$.k").cast("long")
    return e.select(F.col("ts"),
                    F.concat(F.lit("/p/"), (k % 10).cast("string")).alias("url"),
                    F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
                    (F.col("user_id") % 10).cast("int").alias("zip"),
                    F.col("user_id").alias("user"))
