"""End-to-end job queries."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..operators import relational as R
from ..plans import contest as C
from ..plans import jobs as J
from ..session import saved_table, scratch_path
from ..sources import files as SF
from ..tables import Tables
from . import query
from .q_features import _purchase_features_sql, purchase_features_df
from .sqlparts import CLOG, OLOG, PRODUCTS, USERS


def _hs(key: str, salt: int) -> str:
    return R.hash_unit_sql(key, salt)


@query("profile_tables", "WITH " + ",\n".join([OLOG, USERS, PRODUCTS]) + """
SELECT 'users_per_segment' AS profile, CAST(segment AS VARCHAR) AS key, COUNT(*) AS n FROM users GROUP BY 2
UNION ALL SELECT 'users_per_grade', CAST(grade AS VARCHAR), COUNT(*) FROM users GROUP BY 2
UNION ALL SELECT 'products_per_category', CAST(cate AS VARCHAR), COUNT(*) FROM products GROUP BY 2
UNION ALL SELECT 'lines_per_month', strftime(orderDate, '%Y%m'), COUNT(*) FROM olog GROUP BY 2
UNION ALL SELECT 'buyers_per_month', strftime(orderDate, '%Y%m'), COUNT(DISTINCT userId) FROM olog GROUP BY 2""")
def profile_tables(spark, sf):
    t = Tables(spark, sf)
    return J.profile_tables(C.user_table(t), C.product_table(t), C.order_log(t))


@query("first_purchase_table", "WITH " + ",\n".join([OLOG, CLOG, USERS, PRODUCTS]) + """,
lab AS (SELECT userId, productId, arg_min(orderId, (orderDate, orderId)) AS labelId,
               CAST(day(MIN(orderDate)) AS INTEGER) AS labelDay
        FROM olog WHERE orderDate >= DATE '2001-01-01' AND orderDate < DATE '2001-02-01' GROUP BY 1, 2),
hist AS (SELECT userId, productId, orderId, CAST(date_diff('day', orderDate, DATE '2001-01-01') AS INTEGER) AS daysFromBuy
         FROM olog WHERE orderDate < DATE '2001-01-01')
SELECT l.userId, l.productId, l.labelId, l.labelDay, p.price, p.cate, p.size, u.segment, u.nation, u.grade,
       h.orderId, h.daysFromBuy, c.scoreLevel
FROM lab l JOIN products p ON l.productId = p.productId JOIN users u ON l.userId = u.userId
LEFT JOIN hist h ON h.userId = l.userId AND h.productId = l.productId
LEFT JOIN clog c ON c.orderId = h.orderId""")
def first_purchase_table(spark, sf):
    t = Tables(spark, sf)
    return J.first_purchase_table(C.order_log(t), C.comment_log(t), C.user_table(t),
                                  C.product_table(t), C.ORDER_CUTOFF)


@query("model_input", "WITH pf AS (" + _purchase_features_sql() + f"""),
k AS (SELECT label, userId || '-' || productId AS key FROM pf),
t AS (SELECT label, key, CASE WHEN {_hs('key', 1)} < 0.8 THEN 0 ELSE 1 END AS split FROM k)
SELECT split, COUNT(*) AS n, CAST(SUM(CASE WHEN label > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos
FROM t WHERE split = 1 OR label > 0 OR {_hs('key', 0)} < 0.05 GROUP BY 1""")
def model_input(spark, sf):
    mi = J.model_input(saved_table(purchase_features_df(spark, sf), "purchase-features"))
    return mi.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                   F.sum(F.when(F.col("label") > 0, 1).otherwise(0)).alias("n_pos"))


def _weekly_sales(t: Tables):
    li = t.lineitem
    week = F.floor(F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")) / 7).cast("long")
    return li.select(F.col("l_partkey").alias("item"), week.alias("week"), F.col("l_quantity").alias("qty"))


@query("sales_lookback", """
WITH w AS (SELECT l_partkey AS item, CAST(FLOOR(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 7) AS BIGINT) AS week,
                  l_quantity AS qty FROM lineitem),
lb AS (SELECT item, [""" + ", ".join(
    f"ROUND(COALESCE(SUM(CASE WHEN week BETWEEN {300 - k} AND 300 THEN qty END), 0.0), 4)" for k in range(8)) + """] AS lookback
       FROM w GROUP BY item),
nx AS (SELECT item, SUM(qty) AS next_qty FROM w WHERE week = 301 GROUP BY item)
SELECT lb.item, lb.lookback, COALESCE(nx.next_qty, 0.0) AS next_qty FROM lb LEFT JOIN nx ON lb.item = nx.item""")
def sales_lookback(spark, sf):
    f = J.lookback_features(_weekly_sales(Tables(spark, sf)), "item", "week", "qty", 300, 8)
    return f.select("item", F.transform("lookback", lambda x: F.round(x, 4)).alias("lookback"), "next_qty")


def _scores_for_submission(spark, sf):
    pf = purchase_features_df(spark, sf)
    return pf.select(F.col("userId").alias("user"),
                     (F.col("o400") * 10 + F.col("s400")).alias("score"),
                     F.date_add(F.lit(C.ORDER_CUTOFF).cast("date"),
                                (F.col("productId") % 28).cast("int")).alias("date"))


@query("submission_topk", "WITH pf AS (" + _purchase_features_sql() + """),
s AS (SELECT userId AS usr, o400 * 10 + s400 AS score,
             DATE '2001-01-01' + CAST(productId % 28 AS INTEGER) AS d FROM pf),
b AS (SELECT usr, arg_max(score, (score, d)) AS score, arg_max(d, (score, d)) AS date FROM s GROUP BY usr)
SELECT usr AS user, score, date FROM b WHERE usr IN (SELECT c_custkey FROM customer)
ORDER BY score DESC, usr LIMIT 100""")
def submission_topk(spark, sf):
    """Best row per known user, top 100, written as header CSV and read back."""
    sub = J.submission(_scores_for_submission(spark, sf),
                       Tables(spark, sf).customer.select(F.col("c_custkey").alias("user")), 100)
    path = scratch_path(spark, "submission")
    SF.write_csv(sub, path)
    return SF.read_csv_typed(spark, path, "user LONG, score LONG, date DATE")


@query("label_reindex", """
SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS DOUBLE) AS label_idx FROM lineitem""")
def label_reindex(spark, sf):
    """Labels to 0..k-1 in sorted order with a class table (the fitted labels)."""
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    m = StringIndexer(inputCol="l_returnflag", outputCol="label_idx", stringOrderType="alphabetAsc").fit(li)
    return m.transform(li).select("l_orderkey", "l_linenumber", "label_idx")


@query("train_test_report", f"""
WITH s AS (SELECT CASE WHEN {_hs('vec_id', 4)} < 0.8 THEN 'train' ELSE 'test' END AS part, len(embedding) AS w FROM embeddings),
g AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'test' ELSE 'train' END AS part FROM lineitem)
SELECT 'split' AS source, part, COUNT(*) AS n, CAST(MAX(w) AS INTEGER) AS width FROM s GROUP BY part
UNION ALL SELECT 'given', part, COUNT(*), 2 FROM g GROUP BY part""")
def train_test_report(spark, sf):
    """Sizes and vector widths of a split table and of a given test set."""
    t = Tables(spark, sf)
    emb = t.embeddings.select("vec_id", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))
    split = J.load_train_test(emb, None, "vec_id", salt=4)[2]
    li = t.lineitem.select("l_orderkey", "l_returnflag", array_to_vector(F.array("l_quantity", "l_discount")).alias("features"))
    given = J.load_train_test(li.filter("l_returnflag <> 'R'"), li.filter("l_returnflag = 'R'"), "l_orderkey")[2]
    return (split.select(F.lit("split").alias("source"), "part", "n", "width")
            .union(given.select(F.lit("given"), "part", "n", "width")))
