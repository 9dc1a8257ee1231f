"""Feature transformer queries (E*), vectors exported as rounded arrays."""

from __future__ import annotations

from pyspark.ml.feature import (DCT, IDF, PCA, Binarizer, Bucketizer, CountVectorizer,
                                ElementwiseProduct, HashingTF, IndexToString, Interaction,
                                MaxAbsScaler, MinMaxScaler, NGram, Normalizer, OneHotEncoder,
                                PolynomialExpansion, RFormula,
                                StandardScaler, StopWordsRemover, StringIndexer,
                                UnivariateFeatureSelector, VectorAssembler, VectorIndexer,
                                VectorSlicer, Word2Vec)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.quantiles import quantile_splits
from ..operators.text import CUSTOM_STOPWORDS, regex_tokens
from ..tables import Tables
from . import query


def _arr(c, n=9):
    return F.transform(vector_to_array(c), lambda x: F.round(x, n))


def _li_vec(t: Tables, cols=("l_quantity", "l_extendedprice", "l_discount")):
    li = t.lineitem.select("l_orderkey", "l_linenumber", *[c for c in cols if c != "l_linenumber"])
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="error").transform(li)


_KEY = "l_orderkey, l_linenumber"


@query("one_hot", """
SELECT c_custkey, list_transform(range(24), lambda i: CAST(CASE WHEN i = c_nationkey THEN 1 ELSE 0 END AS DOUBLE)) AS vec
FROM customer""")
def one_hot(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_nationkey")
    enc = OneHotEncoder(inputCol="c_nationkey", outputCol="v", dropLast=True).fit(c)
    return enc.transform(c).select("c_custkey", vector_to_array("v").alias("vec"))


@query("string_index", """
WITH f AS (SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1),
r AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY n DESC, c_mktsegment) - 1 AS DOUBLE) AS idx FROM f)
SELECT c.c_custkey, r.idx FROM customer c JOIN r USING (c_mktsegment)""")
def string_index(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    m = StringIndexer(inputCol="c_mktsegment", outputCol="idx", stringOrderType="frequencyDesc").fit(c)
    return m.transform(c).select("c_custkey", "idx")


@query("index_to_string", "SELECT c_custkey, c_mktsegment AS segment FROM customer")
def index_to_string(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    m = StringIndexer(inputCol="c_mktsegment", outputCol="idx").fit(c)
    back = IndexToString(inputCol="idx", outputCol="segment", labels=m.labels)
    return back.transform(m.transform(c)).select("c_custkey", "segment")


@query("vector_index", f"""
SELECT {_KEY}, [CAST(l_linenumber - 1 AS DOUBLE), l_quantity, l_discount] AS vec FROM lineitem""")
def vector_index(spark, sf):
    v = _li_vec(Tables(spark, sf), ("l_linenumber", "l_quantity", "l_discount"))
    m = VectorIndexer(inputCol="features", outputCol="ix", maxCategories=10).fit(v)
    return m.transform(v).select("l_orderkey", "l_linenumber", vector_to_array("ix").alias("vec"))


@query("feature_assemble", f"""
SELECT {_KEY}, [l_quantity, l_extendedprice, l_discount, l_tax] AS vec FROM lineitem""")
def feature_assemble(spark, sf):
    li = Tables(spark, sf).lineitem
    keep = [c for c in li.columns if c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    v = VectorAssembler(inputCols=keep, outputCol="f", handleInvalid="error").transform(li)
    return v.select("l_orderkey", "l_linenumber", vector_to_array("f").alias("vec"))


@query("vector_slice", f"SELECT {_KEY}, [l_quantity, l_discount] AS vec FROM lineitem")
def vector_slice(spark, sf):
    v = _li_vec(Tables(spark, sf))
    s = VectorSlicer(inputCol="features", outputCol="s", indices=[0, 2])
    return s.transform(v).select("l_orderkey", "l_linenumber", vector_to_array("s").alias("vec"))


@query("min_max_scale", f"""
SELECT {_KEY}, [ROUND((l_quantity - MIN(l_quantity) OVER ()) / (MAX(l_quantity) OVER () - MIN(l_quantity) OVER ()), 9),
  ROUND((l_extendedprice - MIN(l_extendedprice) OVER ()) / (MAX(l_extendedprice) OVER () - MIN(l_extendedprice) OVER ()), 9),
  ROUND((l_discount - MIN(l_discount) OVER ()) / (MAX(l_discount) OVER () - MIN(l_discount) OVER ()), 9)] AS vec FROM lineitem""")
def min_max_scale(spark, sf):
    v = _li_vec(Tables(spark, sf))
    m = MinMaxScaler(inputCol="features", outputCol="s").fit(v)
    return m.transform(v).select("l_orderkey", "l_linenumber", _arr("s").alias("vec"))


@query("max_abs_scale", f"""
SELECT {_KEY}, [ROUND(l_quantity / MAX(ABS(l_quantity)) OVER (), 9), ROUND(l_extendedprice / MAX(ABS(l_extendedprice)) OVER (), 9),
  ROUND(l_discount / MAX(ABS(l_discount)) OVER (), 9)] AS vec FROM lineitem""")
def max_abs_scale(spark, sf):
    v = _li_vec(Tables(spark, sf))
    m = MaxAbsScaler(inputCol="features", outputCol="s").fit(v)
    return m.transform(v).select("l_orderkey", "l_linenumber", _arr("s").alias("vec"))


@query("standard_scale", f"""
SELECT {_KEY}, [ROUND((l_quantity - AVG(l_quantity) OVER ()) / STDDEV_SAMP(l_quantity) OVER (), 6),
  ROUND((l_extendedprice - AVG(l_extendedprice) OVER ()) / STDDEV_SAMP(l_extendedprice) OVER (), 6),
  ROUND((l_discount - AVG(l_discount) OVER ()) / STDDEV_SAMP(l_discount) OVER (), 6)] AS vec FROM lineitem""")
def standard_scale(spark, sf):
    v = _li_vec(Tables(spark, sf))
    m = StandardScaler(inputCol="features", outputCol="s", withMean=True, withStd=True).fit(v)
    return m.transform(v).select("l_orderkey", "l_linenumber", _arr("s", 6).alias("vec"))


@query("normalize_rows", f"""
WITH v AS (SELECT {_KEY}, l_quantity AS a, l_extendedprice / 1000 AS b, l_discount AS c FROM lineitem),
n AS (SELECT *, ABS(a) + ABS(b) + ABS(c) AS n1, SQRT(a*a + b*b + c*c) AS n2,
             GREATEST(ABS(a), ABS(b), ABS(c)) AS ninf FROM v)
SELECT {_KEY}, [a / n1, b / n1, c / n1] AS l1, [a / n2, b / n2, c / n2] AS l2,
       [a / ninf, b / ninf, c / ninf] AS linf
FROM n""")
def normalize_rows(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity",
                                           (F.col("l_extendedprice") / 1000).alias("b"), "l_discount")
    v = VectorAssembler(inputCols=["l_quantity", "b", "l_discount"], outputCol="features").transform(li)
    out = v
    for name, p in (("l1", 1.0), ("l2", 2.0), ("linf", float("inf"))):
        out = Normalizer(inputCol="features", outputCol=f"_{name}", p=p).transform(out)
    return out.select("l_orderkey", "l_linenumber", vector_to_array("_l1").alias("l1"),
                      vector_to_array("_l2").alias("l2"), vector_to_array("_linf").alias("linf"))


@query("binarize", f"SELECT {_KEY}, CAST(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS DOUBLE) AS b FROM lineitem")
def binarize(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_discount")
    return Binarizer(threshold=0.05, inputCol="l_discount", outputCol="b").transform(li).drop("l_discount")


@query("bucketize", """
SELECT event_id, CAST(CASE WHEN value < 0 THEN 0 WHEN value < 10 THEN 1 WHEN value < 100 THEN 2
                      WHEN value < 250 THEN 3 ELSE 4 END AS DOUBLE) AS bucket FROM events""")
def bucketize(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "value")
    b = Bucketizer(splits=[float("-inf"), 0.0, 10.0, 100.0, 250.0, float("inf")],
                   inputCol="value", outputCol="bucket")
    return b.transform(e).drop("value")


@query("quantile_bucket", """
WITH q AS (SELECT quantile_disc(value, 0.25) AS a, quantile_disc(value, 0.5) AS b, quantile_disc(value, 0.75) AS c FROM events),
t AS (SELECT value, CAST((value >= a)::INT + (value >= b)::INT + (value >= c)::INT AS DOUBLE) AS bucket FROM events, q)
SELECT bucket, COUNT(*) AS n, MIN(value) AS lo, MAX(value) AS hi FROM t GROUP BY bucket""")
def quantile_bucket(spark, sf):
    """Quantile buckets with exact boundaries (E13), found by refined
    histograms: size and range of each."""
    e = Tables(spark, sf).events.select("value")
    b = Bucketizer(splits=quantile_splits(e, "value", 4), inputCol="value", outputCol="bucket").transform(e)
    return b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))


@query("elementwise_product", f"""
SELECT {_KEY}, [l_quantity * 0.5, l_extendedprice * 2.0, l_discount * 10.0] AS vec FROM lineitem""")
def elementwise_product(spark, sf):
    from pyspark.ml.linalg import Vectors
    v = _li_vec(Tables(spark, sf))
    e = ElementwiseProduct(scalingVec=Vectors.dense([0.5, 2.0, 10.0]), inputCol="features", outputCol="p")
    return e.transform(v).select("l_orderkey", "l_linenumber", vector_to_array("p").alias("vec"))


@query("poly_expand", f"""
WITH v AS (SELECT {_KEY}, l_discount * 10 AS x, l_tax * 10 AS y FROM lineitem)
SELECT {_KEY}, list_transform([x, x*x, x*x*x, y, x*y, x*x*y, y*y, x*y*y, y*y*y], lambda e: ROUND(e, 9)) AS vec FROM v""")
def poly_expand(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("x"),
                                           (F.col("l_tax") * 10).alias("y"))
    v = VectorAssembler(inputCols=["x", "y"], outputCol="xy").transform(li)
    p = PolynomialExpansion(degree=3, inputCol="xy", outputCol="p").transform(v)
    return p.select("l_orderkey", "l_linenumber", _arr("p").alias("vec"))


@query("interaction", f"SELECT {_KEY}, [ROUND(l_quantity * l_discount, 9), ROUND(l_quantity * l_tax, 9)] AS vec FROM lineitem")
def interaction(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    v = VectorAssembler(inputCols=["l_discount", "l_tax"], outputCol="dt").transform(li)
    i = Interaction(inputCols=["l_quantity", "dt"], outputCol="i").transform(v)
    return i.select("l_orderkey", "l_linenumber", _arr("i").alias("vec"))


@query("dct_vectors", """
SELECT vec_id, list_transform(range(64), lambda k: ROUND(
  (CASE WHEN k = 0 THEN SQRT(1.0 / 64) ELSE SQRT(2.0 / 64) END) * list_sum(list_transform(range(64),
   lambda j: CAST(embedding[j + 1] AS DOUBLE) * COS(PI() / 64 * (j + 0.5) * k))), 6) + 0.0) AS dct
FROM embeddings""")
def dct_vectors(spark, sf):
    """Orthonormal DCT-II of each embedding."""
    e = Tables(spark, sf).embeddings
    v = e.select("vec_id", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("v"))
    d = DCT(inverse=False, inputCol="v", outputCol="d").transform(v)
    return d.select("vec_id", F.transform(vector_to_array("d"), lambda x: F.round(x, 6) + F.lit(0.0)).alias("dct"))


_PCA_STEPS = 400


def _pca_sql(k: int = 3) -> str:
    """Leading variances of the covariance matrix by power iteration and
    deflation (recursive CTEs over one row that holds the matrix)."""
    parts = ["""x AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, range(64) r(i))""",
             """m AS (SELECT vec_id, i, v - AVG(v) OVER (PARTITION BY i) AS v FROM x)""",
             """n AS (SELECT COUNT(*) AS n FROM embeddings)""",
             """c AS (SELECT a.i, b.i AS j, SUM(a.v * b.v) / (MAX(n.n) - 1) AS s FROM m a JOIN m b ON a.vec_id = b.vec_id, n GROUP BY 1, 2)""",
             """r AS (SELECT i, list(s ORDER BY j) AS row FROM c GROUP BY i)""",
             """m0 AS (SELECT list(row ORDER BY i) AS mat, list_sum(list(row[i + 1])) AS trace FROM r)"""]
    for p in range(k):
        parts.append(f"""p{p} AS (SELECT 0 AS step, list_transform(range(64), lambda j: 1.0 + (j * 7 % 13) / 13.0) AS v, 0.0::DOUBLE AS l
  UNION ALL SELECT step + 1, list_transform(w, lambda y: y / SQRT(list_dot_product(w, w))), SQRT(list_dot_product(w, w))
  FROM (SELECT step, list_transform(mat, lambda q: list_dot_product(q, v)) AS w FROM p{p}, m{p} WHERE step < {_PCA_STEPS}))""")
        parts.append(f"""m{p + 1} AS (SELECT list_transform(range(64), lambda i: list_transform(range(64),
   lambda j: mat[i + 1][j + 1] - l * v[i + 1] * v[j + 1])) AS mat, trace FROM m{p}, p{p} WHERE step = {_PCA_STEPS})""")
    rows = " UNION ALL ".join(f"SELECT {p} AS component, ROUND(l, 3) AS variance, ROUND(l / trace, 3) AS share "
                              f"FROM p{p}, m0 WHERE step = {_PCA_STEPS}" for p in range(k))
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + rows


@query("pca_project", _pca_sql())
def pca_project(spark, sf):
    """The projection's variance along each of the three leading
    components, and its share of the total."""
    e = Tables(spark, sf).embeddings.select("vec_id", array_to_vector("embedding").alias("v"))
    m = PCA(k=3, inputCol="v", outputCol="pc").fit(e)
    pc = m.transform(e).select(F.posexplode(vector_to_array("pc")).alias("component", "value"))
    shares = {i: float(x) for i, x in enumerate(m.explainedVariance)}
    share = F.create_map(*[F.lit(x) for kv in shares.items() for x in kv])
    return (pc.groupBy("component").agg(F.round(F.var_samp("value"), 3).alias("variance"))
            .select(F.col("component").cast("int").alias("component"), "variance",
                    F.round(share[F.col("component")], 3).alias("share")))


@query("r_formula", """
WITH f AS (SELECT c_mktsegment AS seg, row_number() OVER (ORDER BY COUNT(*) DESC, c_mktsegment) - 1 AS idx FROM customer GROUP BY 1)
SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS label,
  list_concat(list_transform(range((SELECT COUNT(*) - 1 FROM f)), lambda i: CASE WHEN i = f.idx THEN 1.0 ELSE 0.0 END::DOUBLE),
              [c_acctbal]) AS features
FROM customer JOIN f ON seg = c_mktsegment""")
def r_formula(spark, sf):
    """Label, dummies of the category (by falling frequency, the last one
    dropped) and the number."""
    c = Tables(spark, sf).customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    out = RFormula(formula="c_nationkey ~ c_mktsegment + c_acctbal").fit(c).transform(c)
    return out.select("c_custkey", "label", vector_to_array("features").alias("features"))


@query("chi_select", f"""
WITH v AS (SELECT {_KEY}, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS y,
  [CASE WHEN l_linenumber > 3 THEN 1.0 ELSE 0.0 END, CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END,
   CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END]::DOUBLE[] AS x FROM lineitem),
l AS (SELECT i, x[i] AS a, y, COUNT(*) AS o FROM v, range(1, 4) r(i) GROUP BY ALL),
s AS (SELECT i, SUM(o * o / (ra * rb / n)) - MAX(n) AS stat FROM (
  SELECT i, o, SUM(o) OVER (PARTITION BY i, a) AS ra, SUM(o) OVER (PARTITION BY i, y) AS rb, SUM(o) OVER (PARTITION BY i) AS n FROM l) GROUP BY i),
top AS (SELECT list(i ORDER BY i) AS keep FROM (SELECT i FROM s ORDER BY stat DESC LIMIT 2))
SELECT {_KEY}, list_transform(keep, lambda i: x[i]) AS selected FROM v, top""")
def chi_select(spark, sf):
    """The two features of largest chi-square (all have one degree of
    freedom, so the order of the p-values is that of the statistics)."""
    li = Tables(spark, sf).lineitem

    def flag(cond):
        return F.when(cond, 1.0).otherwise(0.0)
    f = li.select("l_orderkey", "l_linenumber", flag(F.col("l_returnflag") == "R").alias("label"),
                  flag(F.col("l_linenumber") > 3).alias("a"), flag(F.col("l_discount") > 0.05).alias("b"),
                  flag(F.col("l_linestatus") == "F").alias("c"))
    v = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(f)
    sel = UnivariateFeatureSelector(featuresCol="features", outputCol="sel", labelCol="label",
                                    selectionMode="numTopFeatures")
    sel.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(2)
    out = sel.fit(v).transform(v)
    return out.select("l_orderkey", "l_linenumber", vector_to_array("sel").alias("selected"))


_TOKENS_SQL = "list_filter(regexp_split_to_array(lower(text), '\\W'), lambda x: len(x) > 0)"


def _digest(tokens):
    """md5 of the tokens joined by spaces: order and content in one value."""
    return F.md5(F.array_join(tokens, " ").cast("binary"))


@query("tokenize", f"""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, md5(array_to_string(t, ' ')) AS digest
FROM (SELECT doc_id, {_TOKENS_SQL} AS t FROM documents)""")
def tokenize(spark, sf):
    d = regex_tokens(Tables(spark, sf).documents.select("doc_id", "text"))
    return d.select("doc_id", F.size("tokens").alias("n_tokens"), _digest("tokens").alias("digest"))


_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in CUSTOM_STOPWORDS) + "]"


@query("remove_stopwords", f"""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_words, md5(array_to_string(t, ' ')) AS digest
FROM (SELECT doc_id, list_filter({_TOKENS_SQL}, lambda x: NOT list_contains({_STOP_SQL}, x)) AS t FROM documents)""")
def remove_stopwords(spark, sf):
    d = regex_tokens(Tables(spark, sf).documents.select("doc_id", "text"))
    r = StopWordsRemover(inputCol="tokens", outputCol="words", stopWords=CUSTOM_STOPWORDS)
    return r.transform(d).select("doc_id", F.size("words").alias("n_words"), _digest("words").alias("digest"))


@query("ngrams", f"""
SELECT doc_id, CAST(GREATEST(len(t) - 1, 0) AS INTEGER) AS n_bigrams,
  md5(array_to_string(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]), ' ')) AS digest
FROM (SELECT doc_id, {_TOKENS_SQL} AS t FROM documents)""")
def ngrams(spark, sf):
    d = regex_tokens(Tables(spark, sf).documents.select("doc_id", "text"))
    g = NGram(n=2, inputCol="tokens", outputCol="bigrams").transform(d)
    return g.select("doc_id", F.size("bigrams").alias("n_bigrams"), _digest("bigrams").alias("digest"))


@query("count_vectorize", f"""
WITH t AS (SELECT doc_id, unnest({_TOKENS_SQL}) AS w FROM documents),
f AS (SELECT w, COUNT(*) AS tf, COUNT(DISTINCT doc_id) AS df FROM t GROUP BY w HAVING COUNT(DISTINCT doc_id) >= 2),
top AS (SELECT tf FROM f ORDER BY tf DESC LIMIT 50)
SELECT CAST(COUNT(*) AS INTEGER) AS vocab_size, CAST(SUM(tf) AS DOUBLE) AS in_vocab_tokens FROM top""")
def count_vectorize(spark, sf):
    d = regex_tokens(Tables(spark, sf).documents.select("doc_id", "text"))
    m = CountVectorizer(inputCol="tokens", outputCol="tf", vocabSize=50, minDF=2.0).fit(d)
    tf = m.transform(d)
    total = tf.agg(F.sum(F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda s, x: s + x)).alias("t"))
    return total.select(F.lit(len(m.vocabulary)).alias("vocab_size"), F.col("t").alias("in_vocab_tokens"))


@query("hashing_tf", f"""
WITH t AS (SELECT doc_id, list_distinct({_TOKENS_SQL}) AS d, {_TOKENS_SQL} AS a FROM documents)
SELECT doc_id, CAST(len(a) AS DOUBLE) AS total, TRUE AS terms_ok FROM t""")
def hashing_tf(spark, sf):
    """Per document, the hashed counts add up to its tokens, and the
    buckets in use are the distinct indices that its distinct tokens hash to."""
    d = regex_tokens(Tables(spark, sf).documents.select("doc_id", "text"))
    tf = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=1 << 12)
    h = tf.transform(d)
    # every token again on its own, through the same transformer
    own = tf.transform(d.select("doc_id", F.explode(F.array_distinct("tokens")).alias("t"))
                       .select("doc_id", F.array("t").alias("tokens")))
    # the stored entries of the sparse vectors: no row becomes 4,096 doubles
    entries = F.unwrap_udt("tf")
    bucket = own.select("doc_id", F.element_at(entries["indices"], 1).alias("b"))
    seen = bucket.groupBy("doc_id").agg(F.count_distinct("b").alias("n"))
    used = F.size(F.filter(entries["values"], lambda x: x > 0))
    out = h.select("doc_id", F.aggregate(entries["values"], F.lit(0.0), lambda s, x: s + x).alias("total"),
                   used.alias("used"))
    return out.join(seen, "doc_id", "left").select(
        "doc_id", "total", (F.col("used") == F.coalesce("n", F.lit(0))).alias("terms_ok"))


@query("tf_idf", f"""
WITH t AS (SELECT DISTINCT doc_id, unnest({_TOKENS_SQL}) AS term FROM documents),
m AS (SELECT COUNT(*) AS m FROM documents)
SELECT term, COUNT(*) AS df, ROUND(LN((MAX(m.m) + 1.0) / (COUNT(*) + 1.0)), 9) AS idf FROM t, m GROUP BY term""")
def tf_idf(spark, sf):
    """Term-level IDF ``ln((m + 1) / (df + 1))`` as a DataFrame aggregate; the
    vector form is ``HashingTF`` + ``IDF`` (see ``idf_vectors``)."""
    d = regex_tokens(Tables(spark, sf).documents.select("doc_id", "text"))
    m = d.count()
    terms = d.select("doc_id", F.explode(F.array_distinct("tokens")).alias("term"))
    df_ = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df_.select("term", "df", F.round(F.log((F.lit(m) + 1.0) / (F.col("df") + 1.0)), 9).alias("idf"))


@query("idf_vectors", f"""
WITH t AS (SELECT doc_id, {_TOKENS_SQL} AS t FROM documents),
v AS (SELECT unnest({_STOP_SQL}) AS w, generate_subscripts({_STOP_SQL}, 1) AS i),
tf AS (SELECT doc_id, i, CAST(len(list_filter(t, lambda x: x = w)) AS DOUBLE) AS n FROM t, v),
df AS (SELECT i, SUM(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS df, COUNT(*) AS m FROM tf GROUP BY i)
SELECT doc_id, list(ROUND(n * CASE WHEN df >= 2 THEN LN((m + 1.0) / (df + 1.0)) ELSE 0 END, 9) ORDER BY i) AS tfidf
FROM tf JOIN df USING (i) GROUP BY doc_id""")
def idf_vectors(spark, sf):
    """Counts over a given vocabulary, weighted by IDF(minDocFreq=2)."""
    from pyspark.ml.feature import CountVectorizerModel
    d = regex_tokens(Tables(spark, sf).documents.select("doc_id", "text"))
    h = CountVectorizerModel.from_vocabulary(CUSTOM_STOPWORDS, inputCol="tokens", outputCol="tf").transform(d)
    w = IDF(inputCol="tf", outputCol="tfidf", minDocFreq=2).fit(h).transform(h)
    return w.select("doc_id", F.transform(vector_to_array("tfidf"), lambda x: F.round(x, 9)).alias("tfidf"))


@query("word2vec_doc", "SELECT item_id, 8 AS width, TRUE AS averaged FROM benchmark")
def word2vec_doc(spark, sf):
    b = regex_tokens(Tables(spark, sf).benchmark.select("item_id", "text"))
    m = Word2Vec(vectorSize=8, minCount=2, maxIter=1, seed=5, inputCol="tokens", outputCol="v").fit(b)
    # a text's vector is the mean of its known words' vectors
    words = m.getVectors().select(F.col("word").alias("w"), vector_to_array("vector").alias("x"))
    parts = b.select("item_id", F.size("tokens").alias("n"), F.explode("tokens").alias("w")).join(words, "w")
    mean = (parts.select("item_id", "n", F.posexplode("x").alias("i", "x")).groupBy("item_id", "i")
            .agg((F.sum("x") / F.first("n")).alias("x")).groupBy("item_id")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("mean")))
    out = m.transform(b).select("item_id", vector_to_array("v").alias("v")).join(mean, "item_id", "left")
    gap = F.array_max(F.zip_with("v", "mean", lambda p, q: F.abs(p - q)))
    none = F.array_max(F.transform("v", lambda p: F.abs(p)))
    return out.select("item_id", F.size("v").alias("width"),
                      (F.coalesce(gap, none) < 1e-5).alias("averaged"))


@query("append_bias", f"SELECT {_KEY}, [l_quantity, l_discount, 1.0] AS vec FROM lineitem")
def append_bias(spark, sf):
    li = Tables(spark, sf).lineitem
    v = li.select("l_orderkey", "l_linenumber",
                  array_to_vector(F.array_append(F.array("l_quantity", "l_discount"), F.lit(1.0))).alias("f"))
    return v.select("l_orderkey", "l_linenumber", vector_to_array("f").alias("vec"))


@query("standard_scale_std_only", f"""
SELECT {_KEY}, [ROUND(l_quantity / STDDEV_SAMP(l_quantity) OVER (), 6),
  ROUND(l_extendedprice / STDDEV_SAMP(l_extendedprice) OVER (), 6),
  ROUND(l_discount / STDDEV_SAMP(l_discount) OVER (), 6)] AS vec FROM lineitem""")
def standard_scale_std_only(spark, sf):
    """E9, std-only form (the estimator's default: no centring)."""
    v = _li_vec(Tables(spark, sf))
    m = StandardScaler(inputCol="features", outputCol="s", withMean=False, withStd=True).fit(v)
    return m.transform(v).select("l_orderkey", "l_linenumber", _arr("s", 6).alias("vec"))


@query("count_vectorize_fixed", f"""
SELECT doc_id, CAST(len(list_filter({_TOKENS_SQL}, lambda x: list_contains({_STOP_SQL}, x))) AS DOUBLE) AS in_vocab
FROM documents""")
def count_vectorize_fixed(spark, sf):
    """E24 with a fixed vocabulary (``CountVectorizerModel.from_vocabulary``):
    per document, the count of tokens that are in the vocabulary."""
    from pyspark.ml.feature import CountVectorizerModel
    d = regex_tokens(Tables(spark, sf).documents.select("doc_id", "text"))
    m = CountVectorizerModel.from_vocabulary(CUSTOM_STOPWORDS, inputCol="tokens", outputCol="tf")
    tf = m.transform(d)
    return tf.select("doc_id", F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda s, x: s + x).alias("in_vocab"))
