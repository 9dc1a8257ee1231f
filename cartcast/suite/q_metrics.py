"""Metric and statistics queries (V*, A21)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import relational as R
from ..operators import stats as S
from ..plans import contest as C
from ..plans import features as FT
from ..tables import Tables
from . import query
from .sqlparts import OLOG


def _r(c, n=9):
    return F.round(c, n)


def _pred_frame(t: Tables):
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    j = t.lineitem.join(p, "l_partkey")
    return j.select((F.col("l_extendedprice") / 1000).alias("label"),
                    (F.col("l_quantity") * F.col("p_retailprice") / 1000).alias("prediction"))


@query("regression_metrics", """
WITH j AS (SELECT l.l_extendedprice / 1000 AS y, l.l_quantity * p.p_retailprice / 1000 AS p
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
m AS (SELECT AVG(y) AS my FROM j)
SELECT ROUND(AVG((p - y) * (p - y)), 6) AS mse, ROUND(SQRT(AVG((p - y) * (p - y))), 6) AS rmse,
       ROUND(AVG(ABS(p - y)), 6) AS mae,
       ROUND(1 - SUM((p - y) * (p - y)) / SUM((y - my) * (y - my)), 6) AS r2,
       ROUND(AVG((p - my) * (p - my)), 6) AS var,
       ROUND(1 / (1 + SQRT(AVG((p - y) * (p - y)))), 6) AS score
FROM j, m""")
def regression_metrics(spark, sf):
    m = M.regression_metrics(_pred_frame(Tables(spark, sf)), "label", "prediction")
    return m.select(*[_r(c, 6).alias(c) for c in m.columns])


def _scores(t: Tables):
    li = t.lineitem
    return li.select(F.col("l_discount").alias("score"),
                     F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"))


_CURVE_SQL = """WITH g AS (
  SELECT l_discount AS threshold, SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS p,
         SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS n FROM lineitem GROUP BY l_discount),
c AS (SELECT threshold, SUM(p) OVER (ORDER BY threshold DESC) AS tp, SUM(n) OVER (ORDER BY threshold DESC) AS fp,
             SUM(p) OVER () AS tot_p, SUM(n) OVER () AS tot_n FROM g),
m AS (SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, tp / (tp + fp) AS precision,
             tp / tot_p AS recall, fp / tot_n AS fpr FROM c)"""


@query("binary_threshold_metrics", _CURVE_SQL + """
SELECT threshold, tp, fp, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall,
       ROUND(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 9) AS f_measure,
       ROUND(fpr, 9) AS fpr FROM m""")
def binary_threshold_metrics(spark, sf):
    c = M.binary_curve(_scores(Tables(spark, sf)), "score", "label")
    return c.select("threshold", "tp", "fp", *[_r(x).alias(x) for x in
                                               ("precision", "recall", "f_measure", "fpr")])


@query("auc_roc", _CURVE_SQL + """,
l AS (SELECT *, COALESCE(LAG(fpr) OVER (ORDER BY threshold DESC), 0) AS fpr0,
             COALESCE(LAG(recall) OVER (ORDER BY threshold DESC), 0) AS tpr0,
             COALESCE(LAG(precision) OVER (ORDER BY threshold DESC), precision) AS prec0 FROM m)
SELECT ROUND(SUM((fpr - fpr0) * (recall + tpr0) / 2), 9) AS auc_roc,
       ROUND(SUM((recall - tpr0) * (precision + prec0) / 2), 9) AS auc_pr FROM l""")
def auc_roc(spark, sf):
    a = M.auc(M.binary_curve(_scores(Tables(spark, sf)), "score", "label"))
    return a.select(_r("auc_roc").alias("auc_roc"), _r("auc_pr").alias("auc_pr"))


def _multiclass(t: Tables):
    li = t.lineitem
    lab = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    pred = (F.when(F.col("l_linestatus") == "O", 1.0)
             .when(F.col("l_discount") >= 0.05, 2.0).otherwise(0.0))
    return li.select(lab.alias("label"), pred.alias("prediction"))


_MC_SQL = """WITH d AS (
  SELECT CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS DOUBLE) AS label,
         CAST(CASE WHEN l_linestatus = 'O' THEN 1 WHEN l_discount >= 0.05 THEN 2 ELSE 0 END AS DOUBLE) AS prediction
  FROM lineitem)"""


@query("confusion_matrix", _MC_SQL + " SELECT label, prediction, COUNT(*) AS n FROM d GROUP BY label, prediction")
def confusion_matrix(spark, sf):
    return M.confusion_matrix(_multiclass(Tables(spark, sf)), "label", "prediction")


@query("multiclass_metrics", _MC_SQL + """,
tot AS (SELECT COUNT(*) AS total FROM d),
a AS (SELECT label AS k, COUNT(*) AS actual FROM d GROUP BY 1),
p AS (SELECT prediction AS k, COUNT(*) AS predicted FROM d GROUP BY 1),
t AS (SELECT label AS k, COUNT(*) AS tp FROM d WHERE label = prediction GROUP BY 1),
per AS (SELECT COALESCE(a.k, p.k) AS k, COALESCE(actual, 0) AS actual, COALESCE(predicted, 0) AS predicted,
               COALESCE(tp, 0) AS tp, total FROM a FULL JOIN p ON a.k = p.k LEFT JOIN t ON t.k = COALESCE(a.k, p.k), tot),
m AS (SELECT k, actual, total, tp,
             CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
             CASE WHEN actual > 0 THEN tp / actual ELSE 0 END AS recall,
             (predicted - tp) / (total - actual) AS fpr FROM per),
m2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m)
SELECT CAST(k AS DOUBLE) AS label, 'precision' AS metric, ROUND(precision, 9) AS value FROM m2
UNION ALL SELECT k, 'recall', ROUND(recall, 9) FROM m2
UNION ALL SELECT k, 'f1', ROUND(f1, 9) FROM m2
UNION ALL SELECT k, 'fpr', ROUND(fpr, 9) FROM m2
UNION ALL SELECT NULL, 'weighted_precision', ROUND(SUM(actual / total * precision), 9) FROM m2
UNION ALL SELECT NULL, 'weighted_recall', ROUND(SUM(actual / total * recall), 9) FROM m2
UNION ALL SELECT NULL, 'weighted_f1', ROUND(SUM(actual / total * f1), 9) FROM m2
UNION ALL SELECT NULL, 'weighted_fpr', ROUND(SUM(actual / total * fpr), 9) FROM m2
UNION ALL SELECT NULL, 'accuracy', ROUND(SUM(tp) / MAX(total), 9) FROM m2
UNION ALL SELECT NULL, 'test_error', ROUND(1 - SUM(tp) / MAX(total), 9) FROM m2""")
def multiclass_metrics(spark, sf):
    m = M.multiclass_metrics(_multiclass(Tables(spark, sf)), "label", "prediction")
    return m.withColumn("value", _r("value"))


@query("multilabel_metrics", """
WITH s AS (SELECT l_orderkey, list_distinct(list(l_returnflag)) AS labs,
                  list_distinct(list(CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'N' END)) AS preds
           FROM lineitem GROUP BY l_orderkey),
r AS (SELECT len(list_intersect(labs, preds)) AS i, len(labs) AS l, len(preds) AS p,
             len(labs) + len(preds) - len(list_intersect(labs, preds)) AS u FROM s),
k AS (SELECT COUNT(DISTINCT x) AS k FROM (SELECT l_returnflag AS x FROM lineitem UNION ALL
      SELECT CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'N' END FROM lineitem))
SELECT ROUND(AVG(CASE WHEN p > 0 THEN i / p ELSE 0 END), 9) AS precision,
       ROUND(AVG(CASE WHEN l > 0 THEN i / l ELSE 0 END), 9) AS recall,
       ROUND(AVG(CASE WHEN l + p > 0 THEN 2 * i / (l + p) ELSE 0 END), 9) AS f1,
       ROUND(AVG(CASE WHEN u > 0 THEN i / u ELSE 1 END), 9) AS accuracy,
       ROUND(AVG(CASE WHEN i = l AND i = p THEN 1.0 ELSE 0.0 END), 9) AS subset_accuracy,
       ROUND(SUM(l + p - 2 * i) / (COUNT(*) * MAX(k.k)), 9) AS hamming_loss,
       ROUND(SUM(i) / SUM(p), 9) AS micro_precision, ROUND(SUM(i) / SUM(l), 9) AS micro_recall,
       ROUND(2 * SUM(i) / (SUM(p) + SUM(l)), 9) AS micro_f1
FROM r, k""")
def multilabel_metrics(spark, sf):
    """Label sets per order (bounded by the order's lines)."""
    li = Tables(spark, sf).lineitem
    sets = li.groupBy("l_orderkey").agg(
        F.collect_set("l_returnflag").alias("labs"),
        F.collect_set(F.when(F.col("l_linestatus") == "F", "R").otherwise("N")).alias("preds"))
    m = M.multilabel_metrics(sets, "labs", "preds")
    return m.select(*[_r(c).alias(c) for c in m.columns])


def _rank_inputs(t: Tables, k: int = 5):
    """Top-k items by quantity before the cutoff, and items bought after it,
    from one row per (user, item) of a single pass over the orders."""
    early = F.col("orderDate") < F.lit(C.ORDER_CUTOFF).cast("date")
    pairs = (C.order_log(t).groupBy(F.col("userId").alias("user"), F.col("productId").alias("item"))
             .agg(F.sum(F.when(early, F.col("buyNum"))).alias("qty"), F.max(~early).alias("later")))
    pred = R.top_n_per_group(pairs.filter("qty is not null"), ["user"], [F.col("qty").desc(), F.col("item")], k, "rank")
    return pred.select("user", "item", "rank"), pairs.filter("later").select("user", "item")


@query("ranking_metrics", "WITH " + OLOG + """,
q AS (SELECT userId AS usr, productId AS item, SUM(buyNum) AS qty FROM olog WHERE orderDate < DATE '2001-01-01' GROUP BY 1, 2),
pred AS (SELECT usr, item, row_number() OVER (PARTITION BY usr ORDER BY qty DESC, item) AS rnk FROM q QUALIFY rnk <= 5),
rel AS (SELECT DISTINCT userId AS usr, productId AS item FROM olog WHERE orderDate >= DATE '2001-01-01'),
nrel AS (SELECT usr, COUNT(*) AS nrel FROM rel GROUP BY usr),
h AS (SELECT p.usr, p.rnk, CASE WHEN r.item IS NULL THEN 0 ELSE 1 END AS hit
      FROM pred p LEFT JOIN rel r ON p.usr = r.usr AND p.item = r.item),
h2 AS (SELECT *, SUM(hit) OVER (PARTITION BY usr ORDER BY rnk ROWS UNBOUNDED PRECEDING) AS cum FROM h),
pu AS (SELECT usr, SUM(hit) AS hk, SUM(CASE WHEN hit = 1 THEN cum / rnk ELSE 0 END) AS ap_sum,
              SUM(CASE WHEN hit = 1 THEN 1 / log2(rnk + 1) ELSE 0 END) AS dcg FROM h2 GROUP BY usr),
pu2 AS (SELECT pu.*, COALESCE(nrel.nrel, 0) AS nrel,
               list_sum(list_transform(range(1, LEAST(5, GREATEST(COALESCE(nrel.nrel, 0), 1)) + 1),
                                       lambda i: 1 / log2(i + 1))) AS ideal
        FROM pu LEFT JOIN nrel ON pu.usr = nrel.usr)
SELECT ROUND(AVG(hk / 5), 9) AS precision_at_k,
       ROUND(AVG(CASE WHEN nrel > 0 THEN ap_sum / nrel ELSE 0 END), 9) AS map,
       ROUND(AVG(CASE WHEN nrel > 0 AND ideal > 0 THEN dcg / ideal ELSE 0 END), 9) AS ndcg_at_k
FROM pu2""")
def ranking_metrics(spark, sf):
    pred, rel = _rank_inputs(Tables(spark, sf))
    m = M.ranking_metrics(pred, rel, 5)
    return m.select(*[_r(c).alias(c) for c in m.columns])


def _labels_for(ol, cutoff):
    return FT.purchase_labels(ol, cutoff, "first")


@query("hit_rates", "WITH " + OLOG + """,
pop AS (SELECT userId, productId,
               COALESCE(MIN(CASE WHEN orderDate >= DATE '2001-01-01' THEN day(orderDate) END), 0) AS label
        FROM olog WHERE orderDate < DATE '2001-02-01' GROUP BY 1, 2
        HAVING COUNT(CASE WHEN orderDate < DATE '2001-01-01' THEN 1 END) > 0),
prev AS (SELECT userId, productId, MIN(day(orderDate)) AS prediction FROM olog
         WHERE orderDate >= DATE '2000-12-01' AND orderDate < DATE '2001-01-01' GROUP BY 1, 2),
j AS (SELECT pop.label, COALESCE(prev.prediction, 0) AS prediction FROM pop LEFT JOIN prev
      ON pop.userId = prev.userId AND pop.productId = prev.productId)
SELECT ROUND(SUM(CASE WHEN label > 0 AND prediction > 0 THEN 1 ELSE 0 END) / SUM(CASE WHEN label > 0 THEN 1 ELSE 0 END), 9) AS buyer_hit,
       ROUND(SUM(CASE WHEN label > 0 AND ABS(label - prediction) < 0.1 THEN 1 ELSE 0 END) / SUM(CASE WHEN label > 0 THEN 1 ELSE 0 END), 9) AS date_hit,
       ROUND(AVG(CASE WHEN ABS(label - prediction) < 0.1 THEN 1.0 ELSE 0.0 END), 9) AS overall_hit
FROM j""")
def hit_rates(spark, sf):
    """V8 with a persistence baseline: predict last month's first purchase day."""
    ol = C.order_log(Tables(spark, sf))
    pop = FT.order_features(ol, C.ORDER_CUTOFF, horizons=(5,), with_label=True).select(
        "userId", "productId", "label")
    prev = _labels_for(ol, "2000-12-01").withColumnRenamed("label", "prediction")
    j = pop.join(prev, ["userId", "productId"], "left").na.fill(0, ["prediction"])
    m = M.hit_rates(j)
    return m.select(*[_r(c).alias(c) for c in m.columns])


@query("contest_score", """
WITH ans AS (SELECT o_custkey AS usr, MIN(CAST(o_orderdate AS DATE)) AS d FROM orders
             WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2001-02-01' GROUP BY 1),
dec AS (SELECT o_custkey AS usr, COUNT(*) AS n, MAX(day(o_orderdate)) AS last_day FROM orders
        WHERE o_orderdate >= TIMESTAMP '2000-12-01' AND o_orderdate < TIMESTAMP '2001-01-01' GROUP BY 1),
sub AS (SELECT usr, row_number() OVER (ORDER BY n DESC, usr) AS rnk,
               DATE '2001-01-01' + CAST(last_day - 1 AS INTEGER) AS d FROM dec QUALIFY rnk <= 100),
s1 AS (SELECT SUM(1 / (1 + ln(rnk)) * CASE WHEN ans.usr IS NOT NULL THEN 1.0 ELSE 0.0 END) / SUM(1 / (1 + ln(rnk))) AS s1
       FROM sub LEFT JOIN ans ON sub.usr = ans.usr),
s2 AS (SELECT AVG(CASE WHEN sub.usr IS NOT NULL THEN 10 / (10 + POW(ABS(date_diff('day', ans.d, sub.d)), 2)) ELSE 0.0 END) AS s2
       FROM ans LEFT JOIN sub ON ans.usr = sub.usr)
SELECT ROUND(s1, 9) AS s1, ROUND(s2, 9) AS s2, ROUND(0.4 * s1 + 0.6 * s2, 9) AS score FROM s1, s2""")
def contest_score(spark, sf):
    o = Tables(spark, sf).orders
    d = F.to_date("o_orderdate")
    ans = (o.filter((d >= F.lit("2001-01-01").cast("date")) & (d < F.lit("2001-02-01").cast("date")))
            .groupBy(F.col("o_custkey").alias("user")).agg(F.min(d).alias("date")))
    dec = (o.filter((d >= F.lit("2000-12-01").cast("date")) & (d < F.lit("2001-01-01").cast("date")))
            .groupBy(F.col("o_custkey").alias("user"))
            .agg(F.count(F.lit(1)).alias("n"), F.max(F.dayofmonth("o_orderdate")).alias("last_day")))
    # the submission is a fixed-size ranked list: the limit is the feature
    top = dec.orderBy(F.col("n").desc(), "user").limit(100)
    sub = (top.withColumn("rank", F.row_number().over(
                Window.orderBy(F.col("n").desc(), "user")))
              .withColumn("date", F.date_add(F.lit("2001-01-01").cast("date"), F.col("last_day") - 1)))
    s = M.contest_score(sub.select("user", "rank", "date"), ans, alpha=0.4)
    return s.select(*[_r(c).alias(c) for c in s.columns])


@query("corr_pairs", """
SELECT ROUND(corr(l_quantity, l_extendedprice), 9) AS corr_l_quantity_l_extendedprice,
       ROUND(corr(l_discount, l_tax), 9) AS corr_l_discount_l_tax FROM lineitem""")
def corr_pairs(spark, sf):
    c = S.correlations(Tables(spark, sf).lineitem, [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax")])
    return c.select(*[_r(x).alias(x) for x in c.columns])


@query("chi_square_stat", """
WITH cells AS (SELECT l_returnflag AS a, l_linestatus AS b, COUNT(*) AS o FROM lineitem GROUP BY 1, 2),
ra AS (SELECT a, SUM(o) AS ra FROM cells GROUP BY a), cb AS (SELECT b, SUM(o) AS cb FROM cells GROUP BY b),
n AS (SELECT SUM(o) AS n, COUNT(DISTINCT a) AS r, COUNT(DISTINCT b) AS c FROM cells)
SELECT 'independence' AS test, ROUND(SUM(o * o / (ra * cb / n.n)) - MAX(n.n), 6) AS statistic,
       CAST(MAX((n.r - 1) * (n.c - 1)) AS BIGINT) AS dof
FROM cells JOIN ra USING (a) JOIN cb USING (b), n
UNION ALL
SELECT 'uniform', ROUND(SUM(POW(o - e, 2) / e), 6), CAST(MAX(k) - 1 AS BIGINT)
FROM (SELECT COUNT(*) AS o, SUM(COUNT(*)) OVER () / COUNT(*) OVER () AS e, COUNT(*) OVER () AS k
      FROM orders GROUP BY o_orderpriority)""")
def chi_square_stat(spark, sf):
    t = Tables(spark, sf)
    ind = S.chi_square_independence(t.lineitem, "l_returnflag", "l_linestatus")
    uni = S.chi_square_uniform(t.orders, "o_orderpriority")
    out = (ind.select(F.lit("independence").alias("test"), "statistic", "dof")
              .unionByName(uni.select(F.lit("uniform").alias("test"), "statistic", "dof")))
    return out.select("test", F.round("statistic", 6).alias("statistic"), F.col("dof").cast("long"))


@query("ks_statistic", """
WITH g AS (SELECT value AS x, COUNT(*) AS c FROM events GROUP BY value),
c AS (SELECT x, c, SUM(c) OVER (ORDER BY x) AS cum, SUM(c) OVER () AS n FROM g),
f AS (SELECT *, LEAST(GREATEST(x / 500.0, 0.0), 1.0) AS fx FROM c)
SELECT ROUND(MAX(GREATEST(cum / n - fx, fx - (cum - c) / n)), 9) AS d, CAST(MAX(n) AS BIGINT) AS n FROM f""")
def ks_statistic(spark, sf):
    """KS distance of event values to Uniform(0, 500) (user-supplied CDF)."""
    e = Tables(spark, sf).events
    k = S.ks_statistic(e, "value", lambda x: F.least(F.greatest(x / 500.0, F.lit(0.0)), F.lit(1.0)))
    return k.select(_r("d").alias("d"), F.col("n").cast("long"))


_KDE_POINTS = (10.0, 100.0, 250.0, 400.0)


@query("kernel_density", " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS point, ROUND(AVG(EXP(-POW(({p} - value) / 20.0, 2) / 2)) / (20.0 * SQRT(2 * PI())), 12) AS density FROM events"
    for p in _KDE_POINTS))
def kernel_density(spark, sf):
    k = S.kernel_density(Tables(spark, sf).events, "value", _KDE_POINTS, 20.0)
    return k.select("point", F.round("density", 12).alias("density"))


@query("cosine_columns", """
WITH long AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS x FROM embeddings, range(64) r(i)),
g AS (SELECT a.i, b.i AS j, SUM(a.x * b.x) AS s FROM long a JOIN long b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY 1, 2),
d AS (SELECT i, s FROM g WHERE i = j)
SELECT CAST(g.i AS INTEGER) AS i, CAST(g.j AS INTEGER) AS j, ROUND(g.s / SQRT(di.s * dj.s), 6) AS cosine
FROM g JOIN d di ON g.i = di.i JOIN d dj ON g.j = dj.i WHERE g.i < g.j""")
def cosine_columns(spark, sf):
    c = S.column_cosines(Tables(spark, sf).embeddings, "embedding", 64)
    return c.select("i", "j", F.round("cosine", 6).alias("cosine"))


@query("svd_values", """
SELECT 64 AS k, ROUND(SUM(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 4) AS sum_s2
FROM embeddings""")
def svd_values(spark, sf):
    """Singular values of the embedding matrix; checked by sum(s²) = ‖A‖²_F."""
    s = S.singular_values(Tables(spark, sf).embeddings, "embedding", 64)
    rows = [(i, float(v)) for i, v in enumerate(s)]
    sv = spark.createDataFrame(rows, "idx int, s double")
    return sv.agg(F.count(F.lit(1)).cast("int").alias("k"), F.round(F.sum(F.col("s") * F.col("s")), 4).alias("sum_s2"))


@query("vector_summary", """
SELECT CAST(i AS INTEGER) AS dim, ROUND(AVG(x), 9) AS mean, ROUND(VAR_SAMP(x), 9) AS variance,
       CAST(SUM(CASE WHEN x <> 0 THEN 1 ELSE 0 END) AS DOUBLE) AS nnz, ROUND(MAX(x), 9) AS max, ROUND(MIN(x), 9) AS min
FROM (SELECT i, CAST(embedding[i + 1] AS DOUBLE) AS x FROM embeddings, range(64) r(i)) GROUP BY i""")
def vector_summary(spark, sf):
    e = Tables(spark, sf).embeddings.select(array_to_vector("embedding").alias("v"))
    v = S.vector_summary(e, "v")
    return v.select(F.col("dim").cast("int").alias("dim"), *[_r(c).alias(c) for c in ("mean", "variance")],
                    "nnz", _r("max").alias("max"), _r("min").alias("min"))


@query("cosine_columns_approx", """
WITH long AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS x FROM embeddings, range(64) r(i)),
g AS (SELECT a.i, b.i AS j, SUM(a.x * b.x) AS s FROM long a JOIN long b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY 1, 2),
d AS (SELECT i, s FROM g WHERE i = j)
SELECT CAST(g.i AS INTEGER) AS i, CAST(g.j AS INTEGER) AS j, TRUE AS close FROM g WHERE g.i < g.j""")
def cosine_columns_approx(spark, sf):
    """V14, thresholded form: sampled entries of each column; every pair's
    estimate is within 0.1 of the exact cosine."""
    e = Tables(spark, sf).embeddings
    est = S.column_cosines_sampled(e, "embedding", 64, 0.1, "vec_id", salt=14)
    exact = S.column_cosines(e, "embedding", 64).withColumnRenamed("cosine", "exact")
    out = exact.join(est, ["i", "j"], "left").na.fill(0.0, ["cosine"])
    return out.select("i", "j", (F.abs(F.col("cosine") - F.col("exact")) < 0.1).alias("close"))


@query("svd_factors", """
WITH x AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS x FROM embeddings, range(64) r(i))
SELECT vec_id, ROUND(SUM(x * x), 4) AS energy, TRUE AS rebuilt FROM x GROUP BY vec_id""")
def svd_factors(spark, sf):
    """U, s and V of all 64 components: the rows rebuilt from them equal
    the matrix, and have its energy."""
    u, s, v = S.svd(Tables(spark, sf).embeddings.select("vec_id", "embedding"), "embedding", 64, 64)
    basis = [F.array(*[F.lit(float(z)) for z in v[j] * s]) for j in range(64)]
    back = F.array(*[F.aggregate(F.zip_with("u", b, lambda a, c: a * c), F.lit(0.0), lambda a, c: a + c) for b in basis])
    out = u.select("vec_id", "embedding", back.alias("back"))
    gap = F.array_max(F.zip_with("embedding", "back", lambda a, c: F.abs(a.cast("double") - c)))
    return out.select("vec_id", F.round(F.aggregate("back", F.lit(0.0), lambda a, c: a + c * c), 4).alias("energy"),
                      (gap < 1e-6).alias("rebuilt"))


def _ks_normal_sql() -> str:
    nodes, weights = S.erf_nodes()
    return f"""
WITH m AS (SELECT AVG(value) AS m, STDDEV_SAMP(value) AS s FROM events),
g AS (SELECT value AS x, COUNT(*) AS c FROM events GROUP BY value),
c AS (SELECT x, c, SUM(c) OVER (ORDER BY x) AS cum, SUM(c) OVER () AS n FROM g),
z AS (SELECT *, GREATEST(-6.0, LEAST(6.0, (x - m) / (s * SQRT(2.0)))) AS z FROM c, m),
q AS (SELECT {nodes!r}::DOUBLE[] AS u, {weights!r}::DOUBLE[] AS w),
f AS (SELECT *, (1 + z * list_sum(list_transform(range(1, len(u) + 1), lambda i: w[i] * EXP(-z * z * u[i] * u[i]))) * 2 / SQRT(PI())) / 2 AS fx
      FROM z, q)
SELECT ROUND(MAX(GREATEST(cum / n - fx, fx - (cum - c) / n)), 6) AS d, TRUE AS agrees FROM f"""


@query("ks_normal", _ks_normal_sql())
def ks_normal(spark, sf):
    """V12 (normal form): KS distance of event values to a normal with the
    sample mean and deviation, and its agreement with Spark's own test."""
    from pyspark.ml.stat import KolmogorovSmirnovTest
    e = Tables(spark, sf).events.select("value")
    m = e.agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s")).first()
    d = S.ks_statistic(e, "value", S.normal_cdf(float(m["m"]), float(m["s"]))).first()["d"]
    r = KolmogorovSmirnovTest.test(e, "value", "norm", float(m["m"]), float(m["s"])).first()
    return spark.createDataFrame([(round(d, 6), abs(r.statistic - d) < 1e-6)], "d double, agrees boolean")
