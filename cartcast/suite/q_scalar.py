"""Scalar function and UDF-surface queries (F*, U*)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from ..functions.codes import CATEGORY_CODES, clamp_min, clip_unit, recode
from ..operators.custom import MeanCenterer, ShiftBy
from ..session import scratch_path
from ..sources.text import split_trim_cast
from ..tables import Tables
from . import query


@query("split_trim_cast", """
SELECT c_custkey, TRIM(split_part(c_name, '#', 1)) AS prefix,
       TRY_CAST(TRIM(split_part(c_name, '#', 2)) AS INTEGER) AS number FROM customer""")
def split_trim_cast_q(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", *split_trim_cast("c_name", "#", [("prefix", "string"), ("number", "int")]))


@query("word_explode", """
SELECT word, COUNT(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""")
def word_explode(spark, sf):
    d = Tables(spark, sf).documents
    return (d.select(F.explode(F.split("text", " ")).alias("word"))
             .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def _case(col: str, mapping) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {k} THEN {v}" for k, v in mapping.items()) + " END"


@query("recode_category", f"SELECT p_partkey, {_case('p_size', CATEGORY_CODES)} AS cate FROM part")
def recode_category(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", recode("p_size", CATEGORY_CODES).alias("cate"))


@query("clamp_negative", "SELECT c_custkey, GREATEST(c_acctbal, 0) AS bal FROM customer")
def clamp_negative(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", clamp_min("c_acctbal", 0.0).alias("bal"))


@query("fill_nulls", """
SELECT c.c_custkey, COALESCE(o.n, 0) AS n_orders, ROUND(COALESCE(o.spent, 0.0), 2) AS spent FROM customer c
LEFT JOIN (SELECT o_custkey, COUNT(*) AS n, SUM(o_totalprice) AS spent FROM orders
           WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey""")
def fill_nulls(spark, sf):
    t = Tables(spark, sf)
    o = (t.orders.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
          .groupBy(F.col("o_custkey").alias("c_custkey"))
          .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spent")))
    j = t.customer.select("c_custkey").join(o, "c_custkey", "left").na.fill(0)
    return j.withColumn("spent", F.round("spent", 2))


@query("clip_unit", "SELECT event_id, LEAST(GREATEST(value / 100 - 1, 0.0), 1.0) AS v FROM events")
def clip_unit_q(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id", clip_unit(F.col("value") / 100 - 1).alias("v"))


@query("rating_binarize", """
SELECT l_orderkey, l_linenumber, l_quantity / 10 - 2.5 AS shifted,
       CAST(CASE WHEN l_quantity / 10 - 2.5 > 0 THEN 1 ELSE 0 END AS DOUBLE) AS relevant FROM lineitem""")
def rating_binarize(spark, sf):
    li = Tables(spark, sf).lineitem
    s = F.col("l_quantity") / 10 - 2.5
    return li.select("l_orderkey", "l_linenumber", s.alias("shifted"),
                     F.when(s > 0, 1.0).otherwise(0.0).alias("relevant"))


@query("floor_bucket", """
SELECT vec_id, list_transform(embedding, lambda x: CAST(FLOOR(CAST(x AS DOUBLE) * 1000 / 16) AS BIGINT)) AS buckets
FROM embeddings""")
def floor_bucket(spark, sf):
    e = Tables(spark, sf).embeddings
    return e.select("vec_id", F.transform("embedding",
                                          lambda x: F.floor(x.cast("double") * 1000 / 16)).alias("buckets"))


@query("token_count", "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_tokens FROM documents")
def token_count(spark, sf):
    d = Tables(spark, sf).documents
    return d.select("doc_id", F.size(F.split("text", " ")).alias("n_tokens"))


@query("modulo_count", "SELECT user_id % 10 AS bucket, COUNT(*) AS n FROM events GROUP BY bucket")
def modulo_count(spark, sf):
    e = Tables(spark, sf).events
    return e.groupBy((F.col("user_id") % 10).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("cast_binary", "SELECT item_id, text AS value FROM benchmark")
def cast_binary(spark, sf):
    b = Tables(spark, sf).benchmark
    raw = b.select("item_id", F.col("text").cast("binary").alias("value"))
    return raw.select("item_id", F.col("value").cast("string").alias("value"))


# ---- U: UDF surface ----------------------------------------------------------

@F.pandas_udf(T.LongType())
def _code_points(s: pd.Series) -> pd.Series:
    return s.str.len().astype("int64")


@query("pandas_udf_scalar", "SELECT doc_id, CAST(length(text) AS BIGINT) AS n FROM documents")
def pandas_udf_scalar(spark, sf):
    """Arrow-batched scalar UDF (U1); Spark's own ``char_length`` is the fast path."""
    d = Tables(spark, sf).documents
    return d.select("doc_id", _code_points("text").alias("n"))


def _disc_price(batches):
    for pdf in batches:
        yield pd.DataFrame({"l_orderkey": pdf["l_orderkey"], "l_linenumber": pdf["l_linenumber"],
                            "disc_price": pdf["l_extendedprice"] * (1 - pdf["l_discount"])})


@query("map_in_pandas", """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS disc_price FROM lineitem""")
def map_in_pandas(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return li.mapInPandas(_disc_price, "l_orderkey long, l_linenumber int, disc_price double")


# Orders per pandas call: groups stay bounded (lines of at most this many
# orders) while the per-call Python overhead is paid once per bucket.
ORDERS_PER_CALL = 256


def _line_ranks(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["l_orderkey", "l_extendedprice", "l_linenumber"],
                          ascending=[True, False, True])
    pdf["rank"] = pdf.groupby("l_orderkey").cumcount() + 1
    return pdf[["l_orderkey", "l_linenumber", "rank"]]


@query("apply_in_pandas", """
SELECT l_orderkey, l_linenumber,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rank
FROM lineitem""")
def apply_in_pandas(spark, sf):
    """Grouped map (U3). A call gets the lines of a block of consecutive
    order keys (bounded size); ranking inside is vectorised pandas."""
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    block = F.floor(F.col("l_orderkey") / ORDERS_PER_CALL)
    return li.groupBy(block.alias("_blk")).applyInPandas(
        _line_ranks, "l_orderkey long, l_linenumber int, rank long")


def _medians(pdf: pd.DataFrame) -> pd.DataFrame:
    return (pdf.groupby("l_orderkey", as_index=False)["l_quantity"].median()
               .rename(columns={"l_quantity": "med"}))


@query("pandas_udaf", "SELECT l_orderkey, MEDIAN(l_quantity) AS med FROM lineitem GROUP BY l_orderkey")
def pandas_udaf(spark, sf):
    """User aggregate in pandas (U4): one output row per order, computed per
    block of orders. Unbounded groups use built-in ``median`` instead, which
    Spark evaluates without a Python round trip."""
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_quantity")
    block = F.floor(F.col("l_orderkey") / ORDERS_PER_CALL)
    return li.groupBy(block.alias("_blk")).applyInPandas(_medians, "l_orderkey long, med double")


@udtf(returnType=T.StructType([T.StructField("pos", T.IntegerType()),
                                 T.StructField("token", T.StringType())]), useArrow=True)
class Tokens:
    def eval(self, text: str):
        if text is None:
            return
        for i, tok in enumerate(text.split(" ")):
            yield i, tok


@query("udtf_tokens", """
SELECT item_id, CAST(t.pos - 1 AS INTEGER) AS pos, t.token FROM benchmark,
  LATERAL (SELECT unnest(string_split(text, ' ')) AS token, generate_subscripts(string_split(text, ' '), 1) AS pos) t""")
def udtf_tokens(spark, sf):
    """Row-to-rows Python table function (U5) used in a lateral join."""
    b = Tables(spark, sf).benchmark
    spark.udtf.register("cartcast_tokens", Tokens)
    return spark.sql("SELECT item_id, pos, token FROM {bench}, LATERAL cartcast_tokens(text)", bench=b)


@query("custom_transformer", "SELECT l_orderkey, l_linenumber, l_quantity + 0.5 AS shifted FROM lineitem")
def custom_transformer(spark, sf):
    """Custom unary transformer, saved and loaded before use."""
    st = ShiftBy(0.5).setInputCol("l_quantity").setOutputCol("shifted")
    path = scratch_path(spark, "shiftby")
    st.save(path)
    loaded = ShiftBy.load(path)
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return loaded.transform(li).drop("l_quantity")


@query("custom_estimator", """
SELECT l_orderkey, l_linenumber, ROUND(l_quantity - (SELECT AVG(l_quantity) FROM lineitem), 6) AS centered
FROM lineitem""")
def custom_estimator(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    model = MeanCenterer(inputCol="l_quantity", outputCol="centered").fit(li)
    out = model.transform(li)
    return out.select("l_orderkey", "l_linenumber", F.round("centered", 6).alias("centered"))
