"""Source and sink queries (S*). File queries write data derived from the
driver tables to a fresh path under the shared checkpoint folder, then read it."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import files as SF
from ..sources import text as TX
from ..tables import Tables
from . import query

CUSTOMER_SCHEMA = ("c_custkey LONG, c_name STRING, c_nationkey INT, "
                   "c_acctbal DOUBLE, c_mktsegment STRING")


@query("scan_csv_roundtrip", "SELECT * FROM customer")
def scan_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    SF.write_csv(Tables(spark, sf).customer, path)
    return SF.read_csv_typed(spark, path, CUSTOMER_SCHEMA)


@query("scan_parquet", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'""")
def scan_parquet(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return (li.filter(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
              .select("l_orderkey", "l_partkey", "l_quantity"))


@query("scan_default_format", "SELECT p_partkey, p_name, p_brand FROM part")
def scan_default_format(spark, sf):
    path = scratch_path(spark, "default")
    SF.save(Tables(spark, sf).part.select("p_partkey", "p_name", "p_brand"), path)
    return SF.load(spark, path)


@query("convert_json_to_parquet",
       "SELECT event_id, user_id, event_type, value, props FROM events")
def convert_json_to_parquet(spark, sf):
    j, p = scratch_path(spark, "json"), scratch_path(spark, "parquet")
    ev = Tables(spark, sf).events.select("event_id", "user_id", "event_type", "value", "props")
    SF.save(ev, j, fmt="json")
    back = SF.load(spark, j, fmt="json",
                   ).select("event_id", "user_id", "event_type", "value", "props")
    SF.save(back, p, fmt="parquet")
    return SF.load(spark, p, fmt="parquet")


@query("sql_on_file", "SELECT n_name, n_regionkey FROM nation WHERE n_regionkey = 1")
def sql_on_file(spark, sf):
    return SF.sql_on_file(spark, "parquet", f"{sf}/nation.parquet",
                          "n_name, n_regionkey", "n_regionkey = 1")


@query("scan_json_inferred", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def scan_json_inferred(spark, sf):
    path = scratch_path(spark, "json")
    SF.save(Tables(spark, sf).customer, path, fmt="json")
    return SF.read_json(spark, path)


@query("json_from_strings", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_from_strings(spark, sf):
    ev = Tables(spark, sf).events
    return SF.parse_json_column(ev, "props", '{"k": 1}').select("event_id", F.col("j.k").alias("k"))


@query("schema_merge", """
SELECT p_partkey, p_size, p_retailprice, NULL::VARCHAR AS p_brand, 1 AS key FROM part WHERE p_size <= 25
UNION ALL
SELECT p_partkey, p_size, NULL::DOUBLE AS p_retailprice, p_brand, 2 AS key FROM part WHERE p_size > 25""")
def schema_merge(spark, sf):
    base = scratch_path(spark, "merge")
    p = Tables(spark, sf).part
    SF.write_parquet(p.filter("p_size <= 25").select("p_partkey", "p_size", "p_retailprice"),
                     f"{base}/key=1")
    SF.write_parquet(p.filter("p_size > 25").select("p_partkey", "p_size", "p_brand"),
                     f"{base}/key=2")
    return SF.read_parquet_merged(spark, base)


@query("catalog_table_kv", """
SELECT p_brand AS value, COUNT(*) AS n FROM part GROUP BY p_brand""")
def catalog_table_kv(spark, sf):
    path = scratch_path(spark, "kv")
    lines = Tables(spark, sf).part.select(
        F.concat_ws("\x01", F.col("p_partkey").cast("string"), F.col("p_brand")).alias("value"))
    lines.write.mode("overwrite").text(path)
    name = f"cartcast_kv_{uuid.uuid4().hex[:8]}"
    SF.read_ctrl_a_table(spark, path, "key LONG, value STRING", name, scratch_path(spark, "kv-table"))
    out = spark.sql(f"SELECT value, COUNT(*) AS n FROM {name} GROUP BY value")
    SF.drop_table(spark, name)
    return out


@query("scan_text_split", "SELECT c_name AS name, c_acctbal AS acctbal FROM customer")
def scan_text_split(spark, sf):
    path = scratch_path(spark, "txt")
    c = Tables(spark, sf).customer
    c.select(F.concat_ws(", ", "c_name", F.col("c_acctbal").cast("string")).alias("value")) \
     .write.mode("overwrite").text(path)
    lines = SF.read_lines(spark, path)
    return lines.select(*TX.split_trim_cast("value", ",", [("name", "string"), ("acctbal", "double")]))


@query("scan_libsvm", """
SELECT CAST(label AS DOUBLE) AS label, COUNT(*) AS n,
       ROUND(SUM(CAST(embedding[1] AS DOUBLE)), 4) AS sum_f0,
       ROUND(SUM(CAST(embedding[64] AS DOUBLE)), 4) AS sum_f63
FROM embeddings GROUP BY label""")
def scan_libsvm(spark, sf):
    path = scratch_path(spark, "libsvm")
    e = Tables(spark, sf).embeddings
    SF.write_libsvm(e.select("label", array_to_vector("embedding").alias("features")), path)
    back = SF.read_libsvm(spark, path, num_features=64)
    arr = vector_to_array("features")
    return (back.groupBy("label")
                .agg(F.count(F.lit(1)).alias("n"),
                     F.round(F.sum(arr[0]), 4).alias("sum_f0"),
                     F.round(F.sum(arr[63]), 4).alias("sum_f63")))


@query("parse_dense_points", """
SELECT l_quantity AS label, l_extendedprice AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem""")
def parse_dense_points(spark, sf):
    path = scratch_path(spark, "dense")
    li = Tables(spark, sf).lineitem
    li.select(F.concat(F.col("l_quantity").cast("string"), F.lit(","),
                       F.concat_ws(" ", *[F.col(c).cast("string") for c in
                                          ("l_extendedprice", "l_discount", "l_tax")])).alias("value")) \
      .write.mode("overwrite").text(path)
    pts = TX.parse_dense_points(SF.read_lines(spark, path))
    a = vector_to_array("features")
    return pts.select("label", a[0].alias("f0"), a[1].alias("f1"), a[2].alias("f2"))


RATINGS_SQL = """SELECT CAST(o.o_custkey AS INTEGER) AS user, CAST(l.l_partkey AS INTEGER) AS item,
       CAST(l.l_quantity / 10 AS FLOAT) AS rating, CAST(l.l_linenumber AS BIGINT) AS ts
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


def rating_lines(t: Tables, sep: str = "::"):
    li, o = t.lineitem, t.orders
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(F.concat_ws(sep, F.col("o_custkey").cast("string"), F.col("l_partkey").cast("string"),
                                (F.col("l_quantity") / 10).cast("float").cast("string"),
                                F.col("l_linenumber").cast("string")).alias("value"))


@query("parse_ratings", RATINGS_SQL)
def parse_ratings(spark, sf):
    path = scratch_path(spark, "ratings")
    rating_lines(Tables(spark, sf)).write.mode("overwrite").text(path)
    return TX.parse_ratings(SF.read_lines(spark, path), sep="::")[0]


@query("rejected_ratings", """
SELECT o_orderstatus AS status, COUNT(*) AS rejected FROM orders WHERE o_orderkey % 7 = 0 GROUP BY 1""")
def rejected_ratings(spark, sf):
    """Lines whose field count is wrong are kept apart and counted. Here
    the orders whose key seven divides are written without their last field."""
    o = Tables(spark, sf).orders
    fields = [F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"), F.lit("1.0")]
    line = F.when(F.col("o_orderkey") % 7 == 0, F.concat_ws("::", *fields[:2], F.col("o_orderstatus"))).otherwise(
        F.concat_ws("::", *fields, F.lit("1")))
    path = scratch_path(spark, "rejected-ratings")
    o.select(line.alias("value")).write.mode("overwrite").text(path)
    bad = TX.parse_ratings(SF.read_lines(spark, path), sep="::")[1]
    return (bad.groupBy(F.element_at(F.split(bad.columns[0], "::"), -1).alias("status"))
            .agg(F.count(F.lit(1)).alias("rejected")))


@query("parse_pageviews", """
SELECT event_type AS url, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
       CAST(user_id % 10 AS INTEGER) AS zip, CAST(user_id AS INTEGER) AS user FROM events""")
def parse_pageviews(spark, sf):
    path = scratch_path(spark, "pv")
    e = Tables(spark, sf).events
    e.select(TX.format_pageview("event_type",
                                F.when(F.col("event_type") == "error", 500).otherwise(200),
                                F.col("user_id") % 10, "user_id").alias("value")) \
     .write.mode("overwrite").text(path)
    return TX.parse_pageviews(SF.read_lines(spark, path))


@query("range_table", """
WITH ids AS (SELECT range AS id FROM range(0, (SELECT MAX(o_orderkey) + 1 FROM orders)))
SELECT CAST(id // 1000 AS BIGINT) AS block, COUNT(*) AS ids, COUNT(o.o_orderkey) AS used
FROM ids LEFT JOIN orders o ON o.o_orderkey = ids.id GROUP BY block""")
def range_table(spark, sf):
    """A generated key range (sized from the data) matched to orders."""
    o = Tables(spark, sf).orders
    hi = o.agg(F.max("o_orderkey")).first()[0]
    ids = spark.range(0, hi + 1)
    j = ids.join(o.select("o_orderkey"), ids.id == o.o_orderkey, "left")
    return (j.groupBy(F.floor(F.col("id") / 1000).cast("long").alias("block"))
             .agg(F.count(F.lit(1)).alias("ids"), F.count("o_orderkey").alias("used")))


@query("parquet_sink_roundtrip", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS qty
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def parquet_sink_roundtrip(spark, sf):
    path = scratch_path(spark, "sink")
    li = Tables(spark, sf).lineitem
    SF.write_parquet(li, path, partition_by=["l_returnflag"])
    back = spark.read.parquet(path)
    return (back.groupBy("l_returnflag", "l_linestatus")
                .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")))


@query("vector_parquet_roundtrip", """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim,
       ROUND(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total
FROM embeddings""")
def vector_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "vec")
    e = Tables(spark, sf).embeddings
    SF.write_parquet(e.select("vec_id", array_to_vector("embedding").alias("v")), path)
    back = spark.read.parquet(path)
    a = vector_to_array("v")
    return back.select("vec_id", F.size(a).alias("dim"),
                       F.round(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


@query("parse_labeled_vectors", """
SELECT CAST(label AS DOUBLE) AS label,
       ROUND(CAST(embedding[1] AS DOUBLE), 4) AS x0, ROUND(CAST(embedding[2] AS DOUBLE), 4) AS x1,
       ROUND(CAST(embedding[3] AS DOUBLE), 4) AS x2 FROM embeddings""")
def parse_labeled_vectors(spark, sf):
    path = scratch_path(spark, "lv")
    e = Tables(spark, sf).embeddings
    r = [F.round(F.col("embedding")[i].cast("double"), 4).cast("string") for i in range(3)]
    e.select(F.concat(F.lit("("), F.col("label").cast("string"), F.lit(",["),
                      F.concat_ws(",", *r), F.lit("])")).alias("value")) \
     .write.mode("overwrite").text(path)
    pts = TX.parse_labeled_vectors(SF.read_lines(spark, path))
    a = vector_to_array("features")
    return pts.select("label", a[0].alias("x0"), a[1].alias("x1"), a[2].alias("x2"))
