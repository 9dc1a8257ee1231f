"""Projection, filter, catalog, join, aggregate, sort and sampling queries
(P*, J*, A*, O*)."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.dates import month_key
from ..operators import relational as R
from ..plans import contest as C
from ..session import scratch_path
from ..sources import files as SF
from ..tables import Tables
from . import query


def _view(df, stem):
    name = f"{stem}_{uuid.uuid4().hex[:8]}"
    df.createOrReplaceTempView(name)
    return name


def _h(key: str) -> str:
    """DuckDB twin of ``relational.hash_unit`` (salt 0)."""
    return R.hash_unit_sql(key, 0)


# ---- P: projection, filter, catalog ---------------------------------------

@query("project_cols", "SELECT c_custkey, c_name FROM customer")
def project_cols(spark, sf):
    return Tables(spark, sf).customer.select("c_custkey", "c_name")


@query("project_arith", "SELECT p_partkey, p_size + 1 AS size_next FROM part")
def project_arith(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", (F.col("p_size") + 1).alias("size_next"))


@query("project_rename", "SELECT o_orderkey AS orderId, o_custkey AS userId, o_orderdate FROM orders")
def project_rename(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return o.withColumnRenamed("o_orderkey", "orderId").withColumnRenamed("o_custkey", "userId")


@query("with_column", """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS disc_price FROM lineitem""")
def with_column(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return (li.withColumn("disc_price", F.col("l_extendedprice") * (1 - F.col("l_discount")))
              .drop("l_extendedprice", "l_discount"))


@query("drop_cols", "SELECT s_suppkey, s_nationkey FROM supplier")
def drop_cols(spark, sf):
    return Tables(spark, sf).supplier.drop("s_acctbal", "s_name")


@query("filter_compare", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice > 100000 AND o_totalprice < 300000 AND o_orderstatus = 'F'""")
def filter_compare(spark, sf):
    o = Tables(spark, sf).orders
    return (o.filter((F.col("o_totalprice") > 100000) & (F.col("o_totalprice") < 300000)
                     & (F.col("o_orderstatus") == "F"))
             .select("o_orderkey", "o_totalprice"))


@query("filter_between", "SELECT c_name, c_acctbal FROM customer WHERE c_acctbal BETWEEN 1000 AND 2000")
def filter_between(spark, sf):
    v = _view(Tables(spark, sf).customer, "customers")
    return spark.sql(f"SELECT c_name, c_acctbal FROM {v} WHERE c_acctbal BETWEEN 1000 AND 2000")


@query("filter_conjunct", """
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
WHERE l_discount - 0.05 > -0.011 AND l_discount - 0.05 < 0.011""")
def filter_conjunct(spark, sf):
    li = Tables(spark, sf).lineitem
    d = F.col("l_discount") - 0.05
    return li.filter((d > -0.011) & (d < 0.011)).select("l_orderkey", "l_linenumber", "l_discount")


@query("filter_sql_string", "SELECT event_id, value FROM events WHERE event_type = 'click' AND value > 100")
def filter_sql_string(spark, sf):
    e = Tables(spark, sf).events
    return e.filter("event_type = 'click' AND value > 100").select("event_id", "value")


@query("grep_documents", "SELECT doc_id, n_chars FROM documents WHERE contains(text, 'the')")
def grep_documents(spark, sf):
    d = Tables(spark, sf).documents
    return d.filter(F.col("text").contains("the")).select("doc_id", "n_chars")


@query("row_to_string", """
SELECT c_custkey, 'Name: ' || c_name || ', segment: ' || c_mktsegment AS line FROM customer""")
def row_to_string(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", F.concat(F.lit("Name: "), "c_name", F.lit(", segment: "),
                                          "c_mktsegment").alias("line"))


@query("row_to_map", """
SELECT c_custkey, c_name AS name, c_mktsegment AS segment, 2 AS n_keys FROM customer""")
def row_to_map(spark, sf):
    c = Tables(spark, sf).customer
    m = c.select("c_custkey", F.create_map(F.lit("name"), "c_name",
                                           F.lit("segment"), "c_mktsegment").alias("m"))
    return m.select("c_custkey", F.col("m")["name"].alias("name"),
                    F.col("m")["segment"].alias("segment"), F.size("m").alias("n_keys"))


@query("map_primitive", "SELECT l_orderkey, l_linenumber, l_linenumber * 2 AS doubled FROM lineitem")
def map_primitive(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber", (F.col("l_linenumber") * 2).alias("doubled"))


@query("temp_view_sql", "SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY c_mktsegment")
def temp_view_sql(spark, sf):
    v = _view(Tables(spark, sf).customer, "customers")
    return spark.sql(f"SELECT c_mktsegment, COUNT(*) AS n FROM {v} GROUP BY c_mktsegment")


@query("global_view_sql", "SELECT n_regionkey, COUNT(*) AS n FROM nation GROUP BY n_regionkey")
def global_view_sql(spark, sf):
    name = f"nations_{uuid.uuid4().hex[:8]}"
    Tables(spark, sf).nation.createOrReplaceGlobalTempView(name)
    other = spark.newSession()
    return other.sql(f"SELECT n_regionkey, COUNT(*) AS n FROM global_temp.{name} GROUP BY n_regionkey")


@query("sql_transformer", "SELECT p_partkey, p_retailprice, p_retailprice * p_size AS v FROM part")
def sql_transformer(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_retailprice", "p_size")
    st = SQLTransformer(statement="SELECT p_partkey, p_retailprice, p_retailprice * p_size AS v FROM __THIS__")
    return st.transform(p)


@query("row_index", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders")
def row_index(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey")
    return R.dense_index(o, "o_orderkey", "idx").select("o_orderkey", "idx")


# ---- J: joins -------------------------------------------------------------

@query("join_inner", """
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def join_inner(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return t.lineitem.select("l_orderkey", "l_linenumber").join(o, ["l_orderkey"])


_PAIRS_SQL = """WITH op AS (
  SELECT o.o_custkey AS userId, l.l_partkey AS productId, COUNT(*) AS n_lines
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
ap AS (
  SELECT user_id AS userId, CAST(json_extract_string(props, '$.k') AS BIGINT) AS productId,
         COUNT(*) AS n_actions FROM events GROUP BY 1, 2)
SELECT op.userId, op.productId, op.n_lines, COALESCE(ap.n_actions, 0) AS n_actions
FROM op LEFT JOIN ap ON op.userId = ap.userId AND op.productId = ap.productId"""


@query("join_left_composite", _PAIRS_SQL)
def join_left_composite(spark, sf):
    t = Tables(spark, sf)
    op = C.order_log(t).groupBy("userId", "productId").agg(F.count(F.lit(1)).alias("n_lines"))
    ap = C.action_log(t).groupBy("userId", "productId").agg(F.count(F.lit(1)).alias("n_actions"))
    return op.join(ap, ["userId", "productId"], "left").na.fill(0, ["n_actions"])


@query("join_left_dim", """
SELECT o.o_orderkey, c.c_mktsegment, c.c_nationkey FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_left_dim(spark, sf):
    """Dimension lookup. The dimension grows with the data, so no forced
    broadcast: the optimizer broadcasts it while its estimated size is under
    the threshold and falls back to a shuffle join (AQE skew-split) above it."""
    t = Tables(spark, sf)
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return t.orders.select("o_orderkey", "o_custkey").join(c, "o_custkey", "left").drop("o_custkey")


@query("join_sql_left", """
WITH lines AS (
  SELECT o.o_custkey AS userId, l.l_partkey AS productId, o.o_orderkey AS orderId, o.o_orderdate AS d
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE o.o_orderdate >= TIMESTAMP '2001-01-01' AND o.o_orderdate < TIMESTAMP '2001-02-01')
SELECT userId, productId, CAST(day(d) AS INTEGER) AS day, orderId
FROM lines QUALIFY CAST(d AS DATE) = MIN(CAST(d AS DATE)) OVER (PARTITION BY userId, productId)""")
def join_sql_left(spark, sf):
    """J4 / L3 first step: the orders of each pair's first purchase day in the
    month, as a SQL left join on a date range that reaches the scan."""
    lines = C.order_log(Tables(spark, sf)).filter(
        "orderDate >= date'2001-01-01' and orderDate < date'2001-02-01'")
    return spark.sql("""
      SELECT f.userId, f.productId, dayofmonth(f.firstDate) AS day, l.orderId
      FROM (SELECT userId, productId, min(orderDate) AS firstDate FROM {lines} GROUP BY userId, productId) f
      LEFT JOIN {lines} l
        ON l.userId = f.userId AND l.productId = f.productId AND l.orderDate = f.firstDate""", lines=lines)


@query("join_view_table", """
SELECT n.n_name, COUNT(*) AS n_customers FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name""")
def join_view_table(spark, sf):
    t = Tables(spark, sf)
    name = f"cartcast_nation_{uuid.uuid4().hex[:8]}"
    SF.save_table(t.nation, name, scratch_path(spark, "nation-table"))
    v = _view(t.customer, "customers")
    out = spark.sql(f"""SELECT n.n_name, COUNT(*) AS n_customers FROM {v} c
                        JOIN {name} n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""")
    SF.drop_table(spark, name)
    return out


@query("join_distinct_side", """
SELECT o.o_orderkey AS orderId, op.productId, o.o_orderstatus AS status FROM orders o
JOIN (SELECT DISTINCT l_orderkey AS orderId, l_partkey AS productId FROM lineitem) op ON o.o_orderkey = op.orderId""")
def join_distinct_side(spark, sf):
    t = Tables(spark, sf)
    op = C.order_products(t)
    o = t.orders.select(F.col("o_orderkey").alias("orderId"), F.col("o_orderstatus").alias("status"))
    return o.join(op, "orderId")


_RATINGS_AVG_SQL = """ratings AS (
  SELECT o.o_custkey AS user, l.l_partkey AS item, AVG(l.l_quantity) / 10 AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)"""


RATINGS_SQL = """SELECT CAST(o.o_custkey AS INTEGER) AS usr, CAST(l.l_partkey AS INTEGER) AS item, AVG(l.l_quantity) / 10 AS rating
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2"""


def ratings(t: Tables):
    """(user, item, rating) from order lines: mean quantity / 10."""
    return (C.order_log(t).groupBy(F.col("userId").alias("user"), F.col("productId").alias("item"))
                          .agg((F.avg("buyNum") / 10).alias("rating")))


@query("join_pred_actual", "WITH " + _RATINGS_AVG_SQL + """,
item_mean AS (SELECT item, AVG(rating) AS prediction FROM ratings GROUP BY item)
SELECT r.user, r.item, ROUND(r.rating, 9) AS rating, ROUND(m.prediction, 9) AS prediction
FROM ratings r JOIN item_mean m ON r.item = m.item""")
def join_pred_actual(spark, sf):
    """Item-mean baseline predictions joined to the truth on (user, item)."""
    r = ratings(Tables(spark, sf))
    pred = r.groupBy("item").agg(F.avg("rating").alias("prediction"))
    return (r.join(pred, "item")
             .select("user", "item", F.round("rating", 9).alias("rating"),
                     F.round("prediction", 9).alias("prediction")))


@query("join_missing_zero_mae", """
WITH allq AS (SELECT l_partkey AS item, SUM(l_quantity) AS q FROM lineitem GROUP BY 1),
early AS (SELECT l_partkey AS item, SUM(l_quantity) AS q FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT ROUND(AVG(ABS(a.q - COALESCE(e.q, 0))), 6) AS mae, COUNT(*) AS n
FROM allq a LEFT JOIN early e ON a.item = e.item""")
def join_missing_zero_mae(spark, sf):
    li = Tables(spark, sf).lineitem
    allq = li.groupBy(F.col("l_partkey").alias("item")).agg(F.sum("l_quantity").alias("q"))
    early = (li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
               .groupBy(F.col("l_partkey").alias("item")).agg(F.sum("l_quantity").alias("qe")))
    j = allq.join(early, "item", "left")
    return j.agg(F.round(F.avg(F.abs(F.col("q") - F.coalesce("qe", F.lit(0.0)))), 6).alias("mae"),
                 F.count(F.lit(1)).alias("n"))


# ---- A: aggregates --------------------------------------------------------

@query("group_count", "SELECT l_returnflag, COUNT(*) AS count FROM lineitem GROUP BY l_returnflag")
def group_count(spark, sf):
    return Tables(spark, sf).lineitem.groupBy("l_returnflag").count()


@query("global_count", "SELECT COUNT(*) AS n FROM orders")
def global_count(spark, sf):
    v = _view(Tables(spark, sf).orders, "orders")
    return spark.sql(f"SELECT COUNT(*) AS n FROM {v}")


@query("distinct_in_month", """
SELECT COUNT(DISTINCT o_custkey) AS buyers FROM orders
WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2001-02-01'""")
def distinct_in_month(spark, sf):
    o = Tables(spark, sf).orders
    m = o.filter("o_orderdate >= timestamp_ntz'2001-01-01' and o_orderdate < timestamp_ntz'2001-02-01'")
    return m.agg(F.count_distinct("o_custkey").alias("buyers"))


@query("argmax_row", """
SELECT c_nationkey, MAX(c_acctbal) AS max_bal, arg_max(c_custkey, (c_acctbal, c_custkey)) AS c_custkey
FROM customer GROUP BY c_nationkey""")
def argmax_row(spark, sf):
    c = Tables(spark, sf).customer
    return c.groupBy("c_nationkey").agg(
        F.max("c_acctbal").alias("max_bal"),
        F.max_by("c_custkey", F.struct("c_acctbal", "c_custkey")).alias("c_custkey"))


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark, sf):
    return Tables(spark, sf).lineitem.select("l_partkey", "l_suppkey").distinct()


@query("class_fractions", """
SELECT l_returnflag, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS fraction
FROM lineitem GROUP BY l_returnflag""")
def class_fractions(spark, sf):
    g = Tables(spark, sf).lineitem.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    # the window runs over the grouped result: one row per class
    return g.withColumn("fraction", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("first_per_group", """
SELECT o_custkey, arg_min(o_orderdate, (o_orderdate, o_orderkey)) AS o_orderdate,
       arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
       arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice
FROM orders GROUP BY o_custkey""")
def first_per_group(spark, sf):
    o = Tables(spark, sf).orders
    return R.first_per_group(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_totalprice"])


@query("mse_rmse", """
SELECT l.l_returnflag, ROUND(AVG(POW(l.l_quantity * p.p_retailprice - l.l_extendedprice, 2)), 2) AS mse,
       ROUND(SQRT(AVG(POW(l.l_quantity * p.p_retailprice - l.l_extendedprice, 2))), 4) AS rmse
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_returnflag""")
def mse_rmse(spark, sf):
    t = Tables(spark, sf)
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    j = t.lineitem.join(p, "l_partkey")
    err2 = F.pow(F.col("l_quantity") * F.col("p_retailprice") - F.col("l_extendedprice"), 2)
    g = j.groupBy("l_returnflag").agg(F.avg(err2).alias("_mse"))
    return g.select("l_returnflag", F.round("_mse", 2).alias("mse"), F.round(F.sqrt("_mse"), 4).alias("rmse"))


@query("count_ratio", """
SELECT ROUND(AVG(CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END), 6) AS ratio,
       ROUND(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) / SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END), 6) AS r_per_a
FROM lineitem""")
def count_ratio(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.agg(
        F.round(F.avg(F.when(F.col("l_discount") > 0.05, 1.0).otherwise(0.0)), 6).alias("ratio"),
        F.round(F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
                / F.sum(F.when(F.col("l_returnflag") == "A", 1).otherwise(0)), 6).alias("r_per_a"))


@query("any_significant", "SELECT event_type, bool_or(value > 480) AS any_high FROM events GROUP BY event_type")
def any_significant(spark, sf):
    e = Tables(spark, sf).events
    return e.groupBy("event_type").agg(F.bool_or(F.col("value") > 480).alias("any_high"))


_DESCRIBE_COLS = ("l_quantity", "l_extendedprice", "l_discount")


def describe_numeric_df(df, cols):
    """Column summary in long form (A20): count, mean, stddev, min, max,
    all from one aggregate pass; values rounded to 6 places."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).cast("double").alias(f"{c}|count"), F.avg(c).alias(f"{c}|mean"),
                 F.stddev_samp(c).alias(f"{c}|stddev"), F.min(c).cast("double").alias(f"{c}|min"),
                 F.max(c).cast("double").alias(f"{c}|max")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{a.split('|')[0]}', '{a.split('|')[1]}', `{a}`" for a in wide.columns)
    return wide.selectExpr(f"stack({len(wide.columns)}, {pairs}) AS (column, stat, value)") \
               .withColumn("value", F.round("value", 6))


def _describe_sql():
    parts = []
    for c in _DESCRIBE_COLS:
        for stat, e in (("count", f"CAST(COUNT({c}) AS DOUBLE)"), ("mean", f"AVG({c})"),
                        ("stddev", f"STDDEV_SAMP({c})"), ("min", f"CAST(MIN({c}) AS DOUBLE)"),
                        ("max", f"CAST(MAX({c}) AS DOUBLE)")):
            parts.append(f"SELECT '{c}' AS column, '{stat}' AS stat, ROUND({e}, 6) AS value FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@query("describe_numeric", _describe_sql())
def describe_numeric(spark, sf):
    return describe_numeric_df(Tables(spark, sf).lineitem, _DESCRIBE_COLS)


@query("rating_cardinality", "WITH " + _RATINGS_AVG_SQL + """
SELECT COUNT(*) AS n_ratings, COUNT(DISTINCT user) AS n_users, COUNT(DISTINCT item) AS n_items FROM ratings""")
def rating_cardinality(spark, sf):
    r = ratings(Tables(spark, sf))
    return r.agg(F.count(F.lit(1)).alias("n_ratings"), F.count_distinct("user").alias("n_users"),
                 F.count_distinct("item").alias("n_items"))


@query("relevant_lists", "WITH " + _RATINGS_AVG_SQL + """,
rel AS (SELECT user, item FROM ratings WHERE rating > 2.5)
SELECT r.user, r.item, c.n_relevant FROM rel r JOIN (SELECT user, COUNT(*) AS n_relevant FROM rel GROUP BY user) c
ON r.user = c.user""")
def relevant_lists(spark, sf):
    """Relevant items per user in long form (A24): (user, item, n_relevant).

    Kept as rows rather than one array per user so a heavy user never
    becomes one giant value; ranking metrics join on these rows."""
    r = ratings(Tables(spark, sf)).filter(F.col("rating") > 2.5).select("user", "item")
    n = r.groupBy("user").agg(F.count(F.lit(1)).alias("n_relevant"))
    return r.join(n, "user")


# ---- O: order, limit, union, sampling -------------------------------------

@query("sort_asc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey")
def sort_asc(spark, sf):
    return Tables(spark, sf).orders.select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")


@query("take_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def take_n(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query("topn_per_group", """
WITH q AS (SELECT o.o_custkey AS userId, l.l_partkey AS productId, SUM(l.l_quantity) AS qty
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)
SELECT userId, productId, qty, rk FROM (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY qty DESC, productId) AS rk FROM q) WHERE rk <= 3""")
def topn_per_group(spark, sf):
    q = (C.order_log(Tables(spark, sf)).groupBy("userId", "productId")
          .agg(F.sum("buyNum").cast("double").alias("qty")))
    return R.top_n_per_group(q, ["userId"], [F.col("qty").desc(), F.col("productId")], 3, "rk") \
            .withColumn("rk", F.col("rk").cast("long"))


@query("cluster_sizes", "SELECT label, COUNT(*) AS size FROM embeddings GROUP BY label ORDER BY size DESC, label")
def cluster_sizes(spark, sf):
    e = Tables(spark, sf).embeddings
    return e.groupBy("label").agg(F.count(F.lit(1)).alias("size")).orderBy(F.col("size").desc(), "label")


@query("union_all", """
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'A'""")
def union_all(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    return li.filter("l_returnflag = 'R'").unionByName(li.filter("l_returnflag = 'A'"))


@query("hash_sample", f"SELECT o_orderkey, o_custkey FROM orders WHERE {_h('o_orderkey')} < 0.1")
def hash_sample(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey")
    return R.hash_sample(o, "o_orderkey", 0.1)


@query("sample_replacement")
def sample_replacement(spark, sf):
    return Tables(spark, sf).orders.select("o_orderkey").sample(True, 0.5, seed=7)


@query("sample_exact_n", f"""
SELECT o_orderkey FROM orders ORDER BY {_h('o_orderkey')}, o_orderkey LIMIT 100""")
def sample_exact_n(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey")
    return o.orderBy(R.hash_unit("o_orderkey"), "o_orderkey").limit(100)


@query("stratified_approx")
def stratified_approx(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    return o.sampleBy("o_orderstatus", {"F": 0.1, "O": 0.5, "P": 0.2}, seed=11)


@query("stratified_exact", f"""
WITH h AS (SELECT o_orderkey, o_orderstatus, {_h('o_orderkey')} AS hv,
                  CASE o_orderstatus WHEN 'F' THEN 0.1 WHEN 'O' THEN 0.5 WHEN 'P' THEN 0.2 END AS f FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY hv, o_orderkey) AS rn,
             COUNT(*) OVER (PARTITION BY o_orderstatus) AS n FROM h)
SELECT o_orderkey, o_orderstatus FROM r WHERE rn <= CEIL(f * n)""")
def stratified_exact(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    return R.stratified_exact(o, "o_orderstatus", "o_orderkey", {"F": 0.1, "O": 0.5, "P": 0.2})


@query("hash_split", f"""
SELECT CASE WHEN {_h('o_orderkey')} < 0.8 THEN 0 ELSE 1 END AS split, COUNT(*) AS n FROM orders GROUP BY split""")
def hash_split(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey")
    return R.hash_split(o, "o_orderkey", [0.8, 0.2]).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("rebalance", f"""
WITH f AS (SELECT l_orderkey * 8 + l_linenumber AS k, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem)
SELECT label, COUNT(*) AS n FROM f WHERE label > 0 OR {_h('k')} < 0.05 GROUP BY label""")
def rebalance(spark, sf):
    li = Tables(spark, sf).lineitem
    f = li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"),
                  F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))
    return R.rebalance(f, "label", "k", 0.05).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("random_normal")
def random_normal(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey")
    return o.select("o_orderkey", F.randn(seed=3).alias("z"), F.rand(seed=4).alias("u"))


def _poisson_case_sql(u: str, mean: float) -> str:
    cdf = R.poisson_thresholds(mean)
    return "CASE " + " ".join(f"WHEN {u} < {c!r} THEN {i}" for i, c in enumerate(cdf)) + f" ELSE {len(cdf)} END"


@query("hash_sample_replacement", f"""
WITH k AS (SELECT o_orderkey, {_poisson_case_sql(R.hash_unit_sql('o_orderkey', 0), 0.5)} AS k FROM orders)
SELECT o_orderkey, CAST(c.copy AS INTEGER) AS _copy FROM k, LATERAL (SELECT unnest(range(1, k + 1)) AS copy) c
WHERE k > 0""")
def hash_sample_replacement(spark, sf):
    """O9, repeatable form: Poisson(0.5) copies per order from its hash."""
    o = Tables(spark, sf).orders.select("o_orderkey")
    return R.hash_sample_with_replacement(o, "o_orderkey", 0.5)


@query("hash_stratified_approx", f"""
SELECT o_orderkey, o_orderstatus FROM orders
WHERE {R.hash_unit_sql('o_orderkey', 0)} < CASE o_orderstatus WHEN 'F' THEN 0.1 WHEN 'O' THEN 0.5 WHEN 'P' THEN 0.2 ELSE 0.0 END""")
def hash_stratified_approx(spark, sf):
    """O11, repeatable form of ``sampleBy``."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    return R.hash_sample_by(o, "o_orderstatus", "o_orderkey", {"F": 0.1, "O": 0.5, "P": 0.2})


@query("hash_normal", f"""
SELECT o_orderkey, ROUND(SQRT(-2.0 * LN({R.hash_unit_sql('o_orderkey', 1)})) * COS(2.0 * 3.141592653589793 * {R.hash_unit_sql('o_orderkey', 2)}), 9) AS z
FROM orders""")
def hash_normal_q(spark, sf):
    """O15, repeatable form: a standard normal value per order."""
    o = Tables(spark, sf).orders.select("o_orderkey")
    return o.select("o_orderkey", F.round(R.hash_normal("o_orderkey"), 9).alias("z"))
