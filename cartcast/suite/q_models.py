"""Model, clustering, pattern-mining and tuning queries (M*, L5, J10–J12).

Where a model has a closed form, the SQL twin computes it (least squares with
inference statistics, elastic net on one feature, naive Bayes, item sets,
rules, sequences, nearest neighbours). Iterative models return one row per
scored row with what must hold of it (better than the majority class, nearest
centre, probabilities that add up), so an empty or a useless model fails."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, MultilayerPerceptronClassifier,
                                       NaiveBayes, OneVsRest, RandomForestClassifier)
from pyspark.ml.clustering import (LDA, BisectingKMeans, GaussianMixture, KMeans,
                                   PowerIterationClustering)
from pyspark.ml.evaluation import (MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.feature import (BucketedRandomProjectionLSH, HashingTF,
                                MinHashLSH, StopWordsRemover, Tokenizer, VectorAssembler)
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import (AFTSurvivalRegression, DecisionTreeRegressor,
                                   GBTRegressor, GeneralizedLinearRegression, IsotonicRegression,
                                   LinearRegression, RandomForestRegressor)
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import folds as FO
from ..operators import metric_join as MJ
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import relational as R
from ..operators.boosting import SoftmaxBoosting
from ..operators.recommend import top_products
from ..operators.sequences import frequent_sequences
from ..operators.text import CUSTOM_STOPWORDS, regex_tokens
from ..plans import features as FT
from ..plans import jobs as J
from ..session import saved_table, scratch_path
from ..tables import Tables
from . import query
from .q_features import _purchase_features_sql, purchase_features_df
from .q_relational import RATINGS_SQL, ratings


def _emb(t: Tables):
    e = t.embeddings
    return e.select("vec_id", F.col("label").cast("double").alias("label"),
                    array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))


def _emb_binary(t: Tables):
    return _emb(t).withColumn("label", F.when(F.col("label") < 5, 1.0).otherwise(0.0))


def _emb_sign(t: Tables):
    """A label that the vector decides: whether its first coordinate is positive."""
    return _emb(t).withColumn("label", F.when(vector_to_array("features")[0] > 0, 1.0).otherwise(0.0))


def _emb_three(t: Tables):
    """Three classes that the vector decides: which of its first three
    coordinates is largest."""
    x = vector_to_array("features")
    most = F.greatest(x[0], x[1], x[2])
    return _emb(t).withColumn("label", F.when(x[0] == most, 0.0).when(x[1] == most, 1.0).otherwise(2.0))


def _total_sse(d) -> float:
    """Squared distance of all rows to their mean."""
    r = d.select(Summarizer.metrics("variance", "count").summary(F.col("features")).alias("s")).first()["s"]
    return float(sum(r["variance"])) * (r["count"] - 1)


def _reg(t: Tables):
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    j = t.lineitem.join(p, "l_partkey")
    f = j.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 1000).alias("label"),
                 "l_quantity", (F.col("p_retailprice") / 1000).alias("price"), "l_discount")
    return VectorAssembler(inputCols=["l_quantity", "price", "l_discount"], outputCol="features").transform(f)


# Most rows of a partition that a tree regression reads again for every level.
_TREE_ROWS = 1_000_000


def _tree_rows(d):
    """Rows dealt evenly into partitions of at most about ``_TREE_ROWS``, however
    many rows there are and however large the files' pieces."""
    return d.repartition(max(d.sparkSession.sparkContext.defaultParallelism, -(-d.count() // _TREE_ROWS)))


def _split(df, key):
    return R.split_frames(df, key, [0.8, 0.2], salt=3)


def _judged(scored, *keys):
    """Scored rows and whether the model beats the majority class (from one
    row per class)."""
    by_label = scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("label") == F.col("prediction")).cast("int")).alias("ok")).collect()
    better = bool(by_label) and sum(r["ok"] for r in by_label) > max(r["n"] for r in by_label)
    return scored.select(*keys, "label", F.lit(better).alias("beats_majority"))


def _judged_regression(scored, *keys):
    """Scored rows and whether the model's squared error is below that of the
    mean."""
    r = scored.agg(F.avg(F.pow(F.col("label") - F.col("prediction"), 2)).alias("mse"),
                   F.var_pop("label").alias("var")).first()
    return scored.select(*keys, "label", F.lit(r["mse"] < r["var"]).alias("beats_mean"))


_EMB_SIGN_SQL = "SELECT vec_id, CASE WHEN embedding[1] > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS label, TRUE AS beats_majority FROM embeddings"
_EMB_THREE_SQL = """SELECT vec_id, CASE WHEN embedding[1] >= GREATEST(embedding[2], embedding[3]) THEN 0.0
  WHEN embedding[2] >= embedding[3] THEN 1.0 ELSE 2.0 END::DOUBLE AS label, TRUE AS beats_majority FROM embeddings"""
_TEST_SQL = f" WHERE {R.hash_unit_sql('vec_id', 3)} >= 0.8"
_REG_SQL = """SELECT l_orderkey, l_linenumber, l_extendedprice / 1000 AS label, TRUE AS beats_mean
FROM lineitem JOIN part ON p_partkey = l_partkey"""


# ---- classification ---------------------------------------------------------

@query("logreg_score", _EMB_SIGN_SQL + _TEST_SQL)
def logreg_score(spark, sf):
    d = _emb_sign(Tables(spark, sf))
    train, test = _split(d, "vec_id")
    m = LogisticRegression(maxIter=10, regParam=0.001, elasticNetParam=0.5, threshold=0.5).fit(train)
    return _judged(m.transform(test), "vec_id")


@query("logreg_multinomial", _EMB_THREE_SQL + _TEST_SQL)
def logreg_multinomial(spark, sf):
    train, test = _split(_emb_three(Tables(spark, sf)), "vec_id")
    m = LogisticRegression(maxIter=10, regParam=0.01, family="multinomial").fit(train)
    return _judged(m.transform(test), "vec_id")


@query("logreg_summary", """
WITH c AS (SELECT SUM(CASE WHEN label < 5 THEN 1 ELSE 0 END) AS p, COUNT(*) AS n FROM embeddings)
SELECT 'objective' AS part, TRUE AS ordered, TRUE AS bounded FROM c UNION ALL SELECT 'roc', TRUE, TRUE FROM c
UNION ALL SELECT 'f_measure', TRUE, TRUE FROM c""")
def logreg_summary(spark, sf):
    """M3: the training summary's three series checked as rows: the loss never
    rises and starts at the entropy of the classes, the ROC climbs from (0, 0)
    to (1, 1), F lies in [0, 1] at every threshold."""
    series = _training_summary(spark, sf).cache()
    w = Window.partitionBy("part").orderBy("x", "y")
    step = series.withColumn("before", F.lag("y").over(w))
    # one row per point of a summary
    out = step.groupBy("part").agg(
        F.max(F.when(F.col("part") == "objective", F.col("y") > F.col("before") + 1e-9)
              .when(F.col("part") == "roc", F.col("y") < F.col("before")).otherwise(F.lit(False))).alias("broken"),
        F.min("y").alias("lo"), F.max("y").alias("hi"))
    return out.select("part", (~F.coalesce("broken", F.lit(False))).alias("ordered"),
                      ((F.col("lo") >= 0) & (F.col("hi") <= 1)).alias("bounded"))


def _training_summary(spark, sf):
    """(part, x, y): loss by iteration, ROC, F-measure by threshold."""
    d = _emb_binary(Tables(spark, sf))
    m = LogisticRegression(maxIter=10, regParam=0.01).fit(d)
    s = m.summary
    loss = spark.createDataFrame([(float(i), float(v)) for i, v in enumerate(s.objectiveHistory)], "x double, y double")
    return (loss.select(F.lit("objective").alias("part"), "x", "y")
            .union(s.roc.select(F.lit("roc"), "FPR", "TPR"))
            .union(s.fMeasureByThreshold.select(F.lit("f_measure"), "threshold", F.col("F-Measure"))))


@query("logreg_training_rows")
def logreg_training_rows(spark, sf):
    """M3: the summary's rows themselves, with the threshold of best F marked."""
    rows = _training_summary(spark, sf)
    best = rows.filter("part = 'f_measure'").orderBy(F.col("y").desc(), "x").first()["x"]
    return rows.withColumn("chosen", (F.col("part") == "f_measure") & (F.col("x") == F.lit(best)))


@query("logreg_threshold", """
SELECT vec_id, TRUE AS consistent FROM embeddings""")
def logreg_threshold(spark, sf):
    """M3: the threshold of best F-measure is set on the model, and every
    prediction follows it."""
    d = _emb_binary(Tables(spark, sf))
    m = LogisticRegression(maxIter=10, regParam=0.01).fit(d)
    best = m.summary.fMeasureByThreshold.orderBy(F.col("F-Measure").desc(), "threshold").first()["threshold"]
    m.setThreshold(best)
    follows = (vector_to_array("probability")[1] > best) == (F.col("prediction") == 1.0)
    return m.transform(d).select("vec_id", follows.alias("consistent"))


@query("linear_svc", _EMB_SIGN_SQL)
def linear_svc(spark, sf):
    """M4: fitted on all rows, and all rows scored."""
    d = _emb_sign(Tables(spark, sf))
    m = LinearSVC(maxIter=10, regParam=0.1).fit(d)
    return _judged(m.transform(d), "vec_id")


@query("dtree_classify", _EMB_SIGN_SQL + _TEST_SQL)
def dtree_classify(spark, sf):
    d = _emb_sign(Tables(spark, sf))
    train, test = _split(d, "vec_id")
    m = DecisionTreeClassifier(maxDepth=5, maxBins=32, impurity="gini", minInstancesPerNode=1).fit(train)
    return _judged(m.transform(test), "vec_id")


@query("rf_classify", _EMB_SIGN_SQL + _TEST_SQL)
def rf_classify(spark, sf):
    train, test = _split(_emb_sign(Tables(spark, sf)), "vec_id")
    m = RandomForestClassifier(numTrees=10, maxDepth=5, seed=1, featureSubsetStrategy="auto").fit(train)
    return _judged(m.transform(test), "vec_id")


@query("gbt_classify", _EMB_SIGN_SQL)
def gbt_classify(spark, sf):
    """Fitted on all rows, and all rows scored."""
    d = _emb_sign(Tables(spark, sf))
    m = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(d)
    return _judged(m.transform(d), "vec_id")


@query("naive_bayes", """
WITH lo AS (SELECT MIN(list_min(CAST(embedding AS DOUBLE[]))) AS lo FROM embeddings),
x AS (SELECT label, i, CAST(embedding[i + 1] AS DOUBLE) - lo AS v FROM embeddings, lo, range(64) r(i)),
s AS (SELECT label, i, SUM(v) AS s FROM x GROUP BY 1, 2)
SELECT CAST(label AS DOUBLE) AS label, CAST(i AS INTEGER) AS feature,
       ROUND(LN(s + 1.0) - LN(SUM(s) OVER (PARTITION BY label) + 64.0), 6) AS log_prob FROM s""")
def naive_bayes(spark, sf):
    """The fitted log probabilities of every class and feature (features
    shifted by the global minimum: multinomial counts are non-negative)."""
    d = _emb(Tables(spark, sf))
    lo = d.select(F.min(F.array_min(vector_to_array("features")))).first()[0]
    d2 = d.withColumn("features", array_to_vector(F.transform(vector_to_array("features"),
                                                               lambda x: x - F.lit(lo))))
    m = NaiveBayes(smoothing=1.0, modelType="multinomial").fit(d2)
    labels = sorted(r["label"] for r in d.select("label").distinct().collect())
    rows = [(float(labels[c]), j, round(float(v), 6)) for c, row in enumerate(m.theta.toArray()) for j, v in enumerate(row)]
    return spark.createDataFrame(rows, "label double, feature int, log_prob double")


@query("mlp_classify", _EMB_THREE_SQL + _TEST_SQL)
def mlp_classify(spark, sf):
    train, test = _split(_emb_three(Tables(spark, sf)), "vec_id")
    m = MultilayerPerceptronClassifier(layers=[64, 16, 3], maxIter=20, blockSize=128, seed=1).fit(train)
    return _judged(m.transform(test), "vec_id")


@query("one_vs_rest", _EMB_THREE_SQL + _TEST_SQL)
def one_vs_rest(spark, sf):
    train, test = _split(_emb_three(Tables(spark, sf)), "vec_id")
    m = OneVsRest(classifier=LogisticRegression(maxIter=5, tol=1e-6)).fit(train)
    return _judged(m.transform(test), "vec_id")


# ---- regression -------------------------------------------------------------

@query("linreg_fit", """
SELECT ROUND(regr_slope(l_extendedprice / 1000, l_quantity), 6) AS slope,
       ROUND(regr_intercept(l_extendedprice / 1000, l_quantity), 6) AS intercept FROM lineitem""")
def linreg_fit(spark, sf):
    """M5/M6: one-feature least squares with the exact normal-equation solver."""
    li = Tables(spark, sf).lineitem
    d = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(
        li.select((F.col("l_extendedprice") / 1000).alias("label"), "l_quantity"))
    m = LinearRegression(solver="normal", regParam=0.0).fit(d)
    return spark.createDataFrame([(round(float(m.coefficients[0]), 6), round(float(m.intercept), 6))],
                                 "slope double, intercept double")


def _quantity_price(t: Tables):
    return VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(
        t.lineitem.select((F.col("l_extendedprice") / 1000).alias("label"), "l_quantity"))


@query("linreg_elastic", """
WITH s AS (SELECT AVG(l_quantity) AS mx, AVG(l_extendedprice / 1000) AS my, STDDEV_POP(l_quantity) AS sx,
                  STDDEV_POP(l_extendedprice / 1000) AS sy, corr(l_quantity, l_extendedprice / 1000) AS r FROM lineitem),
w AS (SELECT *, 0.3 / sy AS lam FROM s),
b AS (SELECT *, SIGN(r) * GREATEST(ABS(r) - lam * 0.8, 0) / (1 + lam * 0.2) * sy / sx AS slope FROM w)
SELECT ROUND(slope, 4) AS slope, ROUND(my - slope * mx, 3) AS intercept FROM b""")
def linreg_elastic(spark, sf):
    """M5/M6: elastic net on one feature (closed form: soft threshold of the
    correlation, shrunk by the quadratic part, in standard units)."""
    m = LinearRegression(maxIter=100, tol=1e-9, regParam=0.3, elasticNetParam=0.8).fit(_quantity_price(Tables(spark, sf)))
    return spark.createDataFrame([(round(float(m.coefficients[0]), 4), round(float(m.intercept), 3))],
                                 "slope double, intercept double")


@query("glm_fit", """
WITH s AS (SELECT COUNT(*) AS n, AVG(l_quantity) AS mx, regr_sxx(l_extendedprice / 1000, l_quantity) AS sxx,
  regr_syy(l_extendedprice / 1000, l_quantity) AS syy, regr_sxy(l_extendedprice / 1000, l_quantity) AS sxy,
  regr_slope(l_extendedprice / 1000, l_quantity) AS b, regr_intercept(l_extendedprice / 1000, l_quantity) AS a FROM lineitem),
d AS (SELECT *, syy - b * sxy AS dev, (syy - b * sxy) / (n - 2) AS disp FROM s)
SELECT ROUND(b, 6) AS slope, ROUND(a, 6) AS intercept, ROUND(SQRT(disp / sxx), 6) AS slope_error,
  ROUND(SQRT(disp * (1.0 / n + mx * mx / sxx)), 6) AS intercept_error, ROUND(b / SQRT(disp / sxx), 2) AS slope_t,
  ROUND(disp, 4) AS dispersion, ROUND(dev / n, 4) AS mean_deviance FROM d""")
def glm_fit(spark, sf):
    """M7: Gaussian GLM with its inference statistics."""
    d = _quantity_price(Tables(spark, sf))
    m = GeneralizedLinearRegression(family="gaussian", link="identity", maxIter=10).fit(d)
    s = m.summary
    se, t = s.coefficientStandardErrors, s.tValues
    n = d.count()
    return spark.createDataFrame(
        [(round(float(m.coefficients[0]), 6), round(float(m.intercept), 6), round(float(se[0]), 6), round(float(se[1]), 6),
          round(float(t[0]), 2), round(float(s.dispersion), 4), round(float(s.deviance) / n, 4))],
        "slope double, intercept double, slope_error double, intercept_error double, slope_t double, "
        "dispersion double, mean_deviance double")


@query("aft_fit", "SELECT COUNT(*) AS n, TRUE AS ordered, TRUE AS positive FROM lineitem")
def aft_fit(spark, sf):
    """M8: survival regression; on every row the predicted quantiles are
    positive and rise with their probability."""
    li = Tables(spark, sf).lineitem
    d = li.select((F.col("l_quantity")).alias("label"),
                  F.when(F.col("l_returnflag") == "R", 0.0).otherwise(1.0).alias("censor"),
                  "l_discount", "l_tax")
    d = VectorAssembler(inputCols=["l_discount", "l_tax"], outputCol="features").transform(d)
    m = AFTSurvivalRegression(quantileProbabilities=[0.3, 0.6], quantilesCol="quantiles",
                              maxIter=10).fit(d)
    q = vector_to_array("quantiles")
    return m.transform(d).agg(F.count(F.lit(1)).alias("n"), F.min(q[0] < q[1]).alias("ordered"),
                              F.min((q[0] > 0) & (F.col("prediction") > 0)).alias("positive"))


@query("isotonic_fit", "SELECT l_quantity AS quantity, TRUE AS rising, TRUE AS balanced FROM lineitem GROUP BY 1")
def isotonic_fit(spark, sf):
    """M9: isotonic fit of price on quantity, one row per distinct quantity:
    the prediction is not below that of the next smaller quantity, and over
    each level of the fit the mean prediction is the mean label."""
    d = _quantity_price(Tables(spark, sf)).withColumn("quantity", F.col("l_quantity"))
    m = IsotonicRegression(isotonic=True).fit(d)
    by_x = m.transform(d).groupBy("quantity").agg(
        F.first("prediction").alias("p"), F.sum("label").alias("s"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(F.floor(F.col("quantity") / 1000)).orderBy("quantity")
    level = by_x.groupBy(F.round("p", 9).alias("level")).agg((F.sum("s") / F.sum("n")).alias("mean"))
    out = by_x.withColumn("before", F.lag("p").over(w)).withColumn("level", F.round("p", 9)).join(level, "level")
    return out.select("quantity", F.coalesce(F.col("p") >= F.col("before"), F.lit(True)).alias("rising"),
                      (F.abs(F.col("p") - F.col("mean")) < 1e-6).alias("balanced"))


@query("dtree_regress", _REG_SQL)
def dtree_regress(spark, sf):
    d = _reg(Tables(spark, sf))
    m = DecisionTreeRegressor(maxDepth=5).fit(_tree_rows(d))
    return _judged_regression(m.transform(d), "l_orderkey", "l_linenumber")


@query("rf_regress", _REG_SQL)
def rf_regress(spark, sf):
    d = _reg(Tables(spark, sf))
    m = RandomForestRegressor(numTrees=5, maxDepth=5, seed=1).fit(_tree_rows(d))
    return _judged_regression(m.transform(d), "l_orderkey", "l_linenumber")


@query("gbt_regress", _REG_SQL)
def gbt_regress(spark, sf):
    d = _reg(Tables(spark, sf))
    m = GBTRegressor(maxIter=5, maxDepth=3, seed=1).fit(_tree_rows(d))
    return _judged_regression(m.transform(d), "l_orderkey", "l_linenumber")


# ---- clustering -------------------------------------------------------------

@query("kmeans_assign", "SELECT vec_id, TRUE AS nearest FROM embeddings")
def kmeans_assign(spark, sf):
    """Every row is assigned to its nearest fitted centre (the k centres
    as a bounded literal array)."""
    d = _emb(Tables(spark, sf))
    m = KMeans(k=10, seed=1, maxIter=10, initMode="k-means||").fit(d)
    centers = [list(map(float, c)) for c in m.clusterCenters()]
    out = m.transform(d).select("vec_id", vector_to_array("features").alias("x"), "prediction")
    carr = F.array(*[F.array(*[F.lit(v) for v in c]) for c in centers])
    dist = F.transform(carr, lambda c: F.aggregate(F.zip_with(c, F.col("x"), lambda a, b: (a - b) * (a - b)),
                                                   F.lit(0.0), lambda s, v: s + v))
    best = F.array_position(dist, F.array_min(dist)) - 1
    return out.select("vec_id", (best == F.col("prediction")).alias("nearest"))


_TOTAL_SSE_SQL = """x AS (SELECT i, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, range(64) r(i)),
t AS (SELECT SUM(v) AS sse FROM (SELECT VAR_POP(v) * COUNT(*) AS v FROM x GROUP BY i))"""


@query("bisecting_kmeans", "SELECT COUNT(*) AS n, 4 AS clusters, TRUE AS tighter FROM embeddings")
def bisecting_kmeans(spark, sf):
    """Four clusters over all rows, tighter than one cluster."""
    d = _emb(Tables(spark, sf))
    m = BisectingKMeans(k=4, seed=1, maxIter=10).fit(d)
    one, cost = _total_sse(d), m.summary.trainingCost
    return m.transform(d).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("prediction").cast("int").alias("clusters"),
                              F.lit(0 < cost < one).alias("tighter"))


@query("gmm_assign", "SELECT vec_id, TRUE AS adds_up, TRUE AS likeliest FROM embeddings")
def gmm_assign(spark, sf):
    """Posterior probabilities add up to one, and the assigned component
    has the largest."""
    e = Tables(spark, sf).embeddings
    d = e.select("vec_id", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))
    m = GaussianMixture(k=3, seed=1, maxIter=10).fit(d)
    p = vector_to_array("probability")
    total = F.aggregate(p, F.lit(0.0), lambda s, x: s + x)
    return m.transform(d).select("vec_id", (F.abs(total - 1) < 1e-6).alias("adds_up"),
                                 (p[F.col("prediction")] == F.array_max(p)).alias("likeliest"))


# Edges are the pairs of weight exp(-d^2 / 2) of at least this.
_LEAST_WEIGHT = 0.45
_AFFINITY_SQL = f"""
WITH c AS (SELECT MIN(vec_id) AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE embedding IS NOT NULL GROUP BY embedding)
SELECT a.id AS src, b.id AS dst, ROUND(EXP(-POW(list_distance(a.x, b.x), 2) / 2), 9) AS weight
FROM c a JOIN c b ON a.id < b.id WHERE EXP(-POW(list_distance(a.x, b.x), 2) / 2) >= {_LEAST_WEIGHT}"""


def near_affinity(t: Tables, least: float = _LEAST_WEIGHT):
    """Affinity edges (src, dst, weight) of all pairs whose weight
    ``exp(-|a-b|^2 / 2)`` is at least ``least`` (J9, F13): every pair within the
    distance where the weight falls under it, by the pivot join. Equal vectors
    are one point (``vector_members`` names it)."""
    reps, _ = MJ.vector_classes(t.embeddings, "vec_id", "embedding")
    near = MJ.l2_pairs(reps, math.sqrt(-2 * math.log(least)) * (1 + 1e-9))
    weight = F.exp(-F.pow("dist", F.lit(2.0)) / 2)
    return near.select(F.col("a").alias("src"), F.col("b").alias("dst"), weight.alias("weight")).where(F.col("weight") >= least)


@query("pair_affinity", _AFFINITY_SQL)
def pair_affinity(spark, sf):
    return near_affinity(Tables(spark, sf)).withColumn("weight", F.round("weight", 9))


@query("vector_members", """SELECT vec_id AS member, MIN(vec_id) OVER (PARTITION BY embedding) AS id
FROM embeddings WHERE embedding IS NOT NULL""")
def vector_members(spark, sf):
    """Membership of the points that affinity and distance joins speak of."""
    return MJ.vector_classes(Tables(spark, sf).embeddings, "vec_id", "embedding")[1].select("member", "id")


@query("pic_assign", "WITH e AS (" + _AFFINITY_SQL.strip() + """),
n AS (SELECT src AS id FROM e UNION SELECT dst FROM e) SELECT id, TRUE AS assigned, TRUE AS denser FROM n""")
def pic_assign(spark, sf):
    """Power iteration on the complete affinity graph: every point with an
    edge gets exactly one of three clusters, and edges join points of one
    cluster more often than sizes alone would have it."""
    edges = saved_table(near_affinity(Tables(spark, sf)), "affinity")
    pic = PowerIterationClustering(k=3, maxIter=10, srcCol="src", dstCol="dst", weightCol="weight")
    got = saved_table(pic.assignClusters(edges), "clusters")
    side = got.select(F.col("id").alias("src"), F.col("cluster").alias("c1"))
    other = got.select(F.col("id").alias("dst"), F.col("cluster").alias("c2"))
    within = edges.join(side, "src").join(other, "dst").agg(
        (F.sum(F.when(F.col("c1") == F.col("c2"), F.col("weight")).otherwise(0.0)) / F.sum("weight"))).first()[0]
    sizes = [r["count"] for r in got.groupBy("cluster").count().collect()]  # three rows
    by_chance = sum(n * n for n in sizes) / sum(sizes) ** 2 if sizes else 1.0
    return got.groupBy("id").agg(((F.count(F.lit(1)) == 1) & F.min("cluster").between(0, 2)).alias("assigned"),
                                 F.lit(bool(within and within > by_chance)).alias("denser"))


_LDA_FEATURES = 1 << 12
_LDA_STOP = sorted(set(CUSTOM_STOPWORDS))


def _lda_words(t: Tables):
    d = regex_tokens(t.documents.select("doc_id", "text"))
    return StopWordsRemover(inputCol="tokens", outputCol="words", stopWords=_LDA_STOP).transform(d)


def _lda_corpus(t: Tables):
    """Hashed term counts: every word takes part, and no vocabulary is
    gathered. (An own vocabulary size is ``CountVectorizer``'s argument.)"""
    return HashingTF(inputCol="words", outputCol="features", numFeatures=_LDA_FEATURES).transform(_lda_words(t))


def _term_total():
    """The terms of a document, counted from the stored entries of its sparse
    vector (not from its 4,096 doubles)."""
    return F.aggregate(F.unwrap_udt("features")["values"], F.lit(0.0), lambda s, x: s + x)


# Most stored term counts of a partition of an EM corpus: each is an edge of the
# graph that a task builds and sorts.
_EM_EDGES = 1_000_000


def _em_partitions(spark, terms: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-terms // _EM_EDGES))


def _bucket_words(t: Tables, buckets):
    """The most frequent word of each hashed term."""
    words = _lda_words(t).select(F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    one = HashingTF(inputCol="ws", outputCol="v", numFeatures=_LDA_FEATURES).transform(
        words.select("w", "n", F.array("w").alias("ws")))
    at = one.select("w", "n", F.element_at(F.unwrap_udt("v")["indices"], 1).alias("bucket"))
    return (at.join(F.broadcast(buckets), "bucket")  # topics x terms shown
            .groupBy("bucket").agg(F.max_by("w", F.struct("n", "w")).alias("term")))


@query("lda_topics", "SELECT CAST(t AS INTEGER) AS topic, 5 AS n_terms, TRUE AS descending FROM range(3) r(t)")
def lda_topics(spark, sf):
    """Top terms of three topics, heaviest first."""
    t = Tables(spark, sf)
    m = LDA(k=3, maxIter=5, optimizer="online", seed=1).fit(_lda_corpus(t))
    top = m.describeTopics(5).select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "z"))
    top = top.select("topic", "rank", F.col("z.termIndices").alias("bucket"), F.col("z.termWeights").alias("weight"))
    named = top.join(_bucket_words(t, top.select("bucket").distinct()), "bucket")
    w = Window.partitionBy("topic").orderBy("rank")  # five rows per topic
    named = named.withColumn("before", F.lag("weight").over(w))
    return named.groupBy("topic").agg(
        F.count("term").cast("int").alias("n_terms"),
        F.min(F.coalesce((F.col("weight") > 0) & (F.col("weight") <= F.col("before")), F.lit(True))).alias("descending"))


_LDA_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in _LDA_STOP) + "]"


@query("lda_corpus", f"""
WITH t AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '\\W'), lambda x: len(x) > 0)) AS w FROM documents)
SELECT w AS term, COUNT(*) AS n, COUNT(DISTINCT doc_id) AS docs, list_contains({_LDA_STOP_SQL}, w) AS dropped FROM t GROUP BY w""")
def lda_corpus(spark, sf):
    """Corpus preparation as rows: every term's tokens and documents, and
    whether the stop words drop it."""
    d = _lda_words(Tables(spark, sf)).select("doc_id", "tokens", "words")
    kept = d.select("doc_id", F.explode("words").alias("term"), F.lit(False).alias("dropped"))
    gone = d.select("doc_id", F.explode("tokens").alias("term"), F.lit(True).alias("dropped")).filter(
        F.col("term").isin(_LDA_STOP))
    return kept.union(gone).groupBy("term", "dropped").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


@query("lda_em", f"""
WITH t AS (SELECT unnest(list_filter(regexp_split_to_array(lower(text), '\\W'), lambda x: len(x) > 0)) AS w FROM documents)
SELECT SUM(CASE WHEN list_contains({_LDA_STOP_SQL}, w) THEN 0 ELSE 1 END)::DOUBLE AS tokens_kept,
       SUM(CASE WHEN list_contains({_LDA_STOP_SQL}, w) THEN 1 ELSE 0 END)::DOUBLE AS tokens_dropped, TRUE AS improves FROM t""")
def lda_em(spark, sf):
    """EM-optimised LDA; tokens kept and dropped, and whether five rounds
    raise the training likelihood over one."""
    words = _lda_corpus(Tables(spark, sf))
    # on disk, without texts and words: the graphs of the fits have the memory
    stored = saved_table(words.select("features", (F.size("tokens") - F.size("words")).alias("dropped"),
                                      F.monotonically_increasing_id().alias("at")), "lda-corpus")
    counts = stored.agg(F.sum(_term_total()).alias("kept"), F.sum("dropped").cast("double").alias("dropped"),
                        F.sum(F.size(F.unwrap_udt("features")["indices"])).alias("terms")).first()
    # the fit names documents by their place: dealt and laid in stored order, they have
    # the same one whenever a part is read again (else edges lead to no vertex)
    parts = _em_partitions(spark, counts["terms"] or 0)
    corpus = stored.repartition(parts, "at").sortWithinPartitions("at").select("features")
    likelihood = []
    for rounds in (1, 5):  # the graph of one fit is dropped before the next
        model = LDA(k=3, maxIter=rounds, optimizer="em", seed=1).fit(corpus)
        likelihood.append(model.trainingLogLikelihood())
        del model
    return spark.createDataFrame([(counts["kept"], counts["dropped"], likelihood[1] > likelihood[0])],
                                 "tokens_kept double, tokens_dropped double, improves boolean")


@query("lda_perplexity", f"SELECT COUNT(*) AS n_test, TRUE AS falls, TRUE AS bound FROM documents WHERE {R.hash_unit_sql('doc_id', 31)} >= 0.8")
def lda_perplexity(spark, sf):
    """Topics of the training texts judged on the held-out texts: the
    perplexity bound falls from one round to ten, lies between one and the
    number of terms, and is minus the log-likelihood per token."""
    t = Tables(spark, sf)
    # the vectors alone are kept: a document's words take several times their room
    train, test = (d.select("features").cache() for d in R.split_frames(_lda_corpus(t), "doc_id", [0.8, 0.2], salt=31))
    one, ten = (LDA(k=3, maxIter=n, optimizer="online", subsamplingRate=0.2, seed=1).fit(train) for n in (1, 10))
    first, last = one.logPerplexity(test), ten.logPerplexity(test)
    r = test.agg(F.count(F.lit(1)).alias("n"), F.sum(_term_total()).alias("tokens")).first()
    per_token = -ten.logLikelihood(test) / r["tokens"]
    train.unpersist()
    test.unpersist()
    return spark.createDataFrame([(r["n"], last < first, 0 < last < math.log(_LDA_FEATURES) + 1 and abs(last - per_token) < 1e-3 * last)],
                                 "n_test long, falls boolean, bound boolean")


# ---- recommendation, patterns ------------------------------------------------

def _als_ratings(t: Tables):
    r = ratings(t)
    return r.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"),
                    F.col("rating").cast("float").alias("rating"))


def _stored_ratings(t: Tables):
    """The ratings, joined and aggregated once: fits, predictions and checks read
    the stored rows."""
    return saved_table(_als_ratings(t), "ratings")


def _als_split(t: Tables):
    r = _als_ratings(t).withColumn("_k", F.concat_ws("-", "user", "item"))
    return [d.drop("_k") for d in R.split_frames(r, "_k", [0.8, 0.2], salt=5)]


_RATING_SQL = f"""r AS ({{ratings}}),
s AS (SELECT *, {R.hash_unit_sql("usr || '-' || item", 5)} < 0.8 AS train FROM r)"""


@query("als_predict", "WITH " + _RATING_SQL.format(ratings=RATINGS_SQL) + """
SELECT usr AS user, item, TRUE AS as_dot FROM s t WHERE NOT train
  AND EXISTS (SELECT 1 FROM s u WHERE u.train AND u.usr = t.usr) AND EXISTS (SELECT 1 FROM s i WHERE i.train AND i.item = t.item)""")
def als_predict(spark, sf):
    """Held-out pairs whose user and item were trained on (cold rows are
    dropped); each prediction is the inner product of the fitted factors."""
    train, test = _als_split(Tables(spark, sf))
    als = ALS(rank=5, maxIter=3, regParam=0.1, userCol="user", itemCol="item", ratingCol="rating",
              coldStartStrategy="drop", seed=1)
    m = als.fit(train)
    u = m.userFactors.select(F.col("id").alias("user"), F.col("features").alias("x"))
    i = m.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("y"))
    dot = F.aggregate(F.zip_with("x", "y", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
    return m.transform(test).join(u, "user").join(i, "item").select(
        "user", "item", (F.abs(F.col("prediction") - dot) <= 1e-4 * (1 + F.abs(dot))).alias("as_dot"))


@query("als_implicit", "WITH r AS (" + RATINGS_SQL + ") SELECT COUNT(*) AS n, TRUE AS separates FROM r")
def als_implicit(spark, sf):
    """Implicit factors score observed pairs above pairs of the same
    users with other items (shifted by one place in the item order)."""
    r = _stored_ratings(Tables(spark, sf))
    m = ALS(rank=5, maxIter=5, implicitPrefs=True, alpha=1.0, userCol="user", itemCol="item",
            ratingCol="rating", coldStartStrategy="drop", seed=1).fit(r)
    top = r.agg(F.max("item")).first()[0]
    other = r.select("user", (F.pmod(F.col("item") + 7919, F.lit(top)) + 1).cast("int").alias("item"))
    other = other.join(r.select("user", "item"), ["user", "item"], "left_anti")
    seen = m.transform(r.select("user", "item")).agg(F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("p")).first()
    unseen = m.transform(other).agg(F.avg("prediction")).first()[0]
    return spark.createDataFrame([(seen["n"], seen["p"] > unseen)], "n long, separates boolean")


@query("als_topn", "WITH r AS (" + RATINGS_SQL + """)
SELECT DISTINCT usr AS user, 3 AS n, TRUE AS best_first FROM r""")
def als_topn(spark, sf):
    """Three recommendations of all items for all users, by blocks of
    items of falling norm: scores fall, and no observed pair scores above a
    user's third recommendation unless it is recommended."""
    r = _stored_ratings(Tables(spark, sf))
    m = ALS(rank=5, maxIter=3, regParam=0.1, userCol="user", itemCol="item", ratingCol="rating",
            seed=1).fit(r)
    recs = top_products(m.userFactors, m.itemFactors, 3)
    score = F.col("scores")
    falling = (score[0] >= score[1]) & (score[1] >= score[2])
    seen = m.transform(r).select("user", "item", "prediction")
    missed = (seen.join(recs, "user").filter(~F.array_contains("items", F.col("item").cast("long"))
                                             & (F.col("prediction") > score[2] + 1e-5))
              .select("user").distinct().withColumn("missed", F.lit(True)))
    return recs.join(missed, "user", "left").select(
        "user", F.size("items").alias("n"), (falling & F.col("missed").isNull()).alias("best_first"))


def _baskets(t: Tables):
    """One basket per order: the distinct brands of its lines (bounded by lines per order)."""
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    j = t.lineitem.select("l_orderkey", "l_partkey").join(p, "l_partkey")
    return j.groupBy("l_orderkey").agg(F.array_distinct(F.collect_list("p_brand")).alias("items"))


_BASKET_SQL = """b AS (SELECT DISTINCT l.l_orderkey AS o, p.p_brand AS item FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
n AS (SELECT COUNT(DISTINCT o) AS n FROM b),
s1 AS (SELECT item, COUNT(*) AS freq FROM b GROUP BY item),
s2 AS (SELECT x.item AS a, y.item AS c, COUNT(*) AS freq FROM b x JOIN b y ON x.o = y.o AND x.item < y.item GROUP BY 1, 2),
s3 AS (SELECT x.item AS a, y.item AS c, z.item AS e, COUNT(*) AS freq FROM b x JOIN b y ON x.o = y.o AND x.item < y.item
       JOIN b z ON x.o = z.o AND y.item < z.item GROUP BY 1, 2, 3)"""


_RULE_PARTS = """,
n2 AS (SELECT CEIL(0.02 * n) AS least, n FROM n),
f AS (SELECT [item] AS items, freq FROM s1 UNION ALL SELECT [a, c], freq FROM s2 UNION ALL SELECT [a, c, e], freq FROM s3),
k AS (SELECT items, freq FROM f, n2 WHERE freq >= least)"""


@query("frequent_itemsets", "WITH " + _BASKET_SQL + _RULE_PARTS + " SELECT items, freq FROM k")
def frequent_itemsets(spark, sf):
    """FP-growth, all item sets (the twin counts up to three items; a
    larger set would be a difference)."""
    m = FPGrowth(itemsCol="items", minSupport=0.02, minConfidence=0.1).fit(_baskets(Tables(spark, sf)))
    return m.freqItemsets.select(F.array_sort("items").alias("items"), "freq")


@query("association_rules", "WITH " + _BASKET_SQL + _RULE_PARTS + """,
p AS (SELECT items, freq, unnest(items) AS c FROM k WHERE len(items) > 1)
SELECT a.items AS antecedent, [p.c] AS consequent, ROUND(p.freq / a.freq, 9) AS confidence,
       ROUND(p.freq / a.freq / (t.freq / n.n), 9) AS lift
FROM p JOIN k a ON a.items = list_filter(p.items, lambda x: x <> p.c) JOIN s1 t ON t.item = p.c, n
WHERE p.freq / a.freq >= 0.1""")
def association_rules(spark, sf):
    """All rules, whatever the length of their left side."""
    m = FPGrowth(itemsCol="items", minSupport=0.02, minConfidence=0.1).fit(_baskets(Tables(spark, sf)))
    return m.associationRules.select(F.array_sort("antecedent").alias("antecedent"), "consequent",
                                     F.round("confidence", 9).alias("confidence"), F.round("lift", 9).alias("lift"))


def _sequence_sql(support: float, sets: int) -> str:
    """Patterns of any length, level by level: ``e`` holds the dates on which a
    customer can end a pattern, grown by every item. The last level must be
    empty on the tables, or patterns are missing here."""
    parts = [f"""l AS (SELECT DISTINCT o.o_custkey AS c, o.o_orderdate AS d, p.p_brand AS item FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey),
n AS (SELECT CEIL({support} * COUNT(DISTINCT c)) AS least FROM l),
e1 AS (SELECT [[item]] AS sequence, item AS tail, c, d FROM l),
f1 AS (SELECT sequence, COUNT(DISTINCT c) AS freq FROM e1, n GROUP BY sequence, least HAVING COUNT(DISTINCT c) >= least)"""]
    for i in range(1, sets):
        parts.append(f"""k{i} AS (SELECT e{i}.* FROM e{i} JOIN f{i} USING (sequence)),
m{i} AS (SELECT sequence, c, MIN(d) AS d FROM k{i} GROUP BY 1, 2),
e{i + 1} AS MATERIALIZED (SELECT list_append(m.sequence, [l.item]) AS sequence, l.item AS tail, l.c, l.d FROM m{i} m JOIN l ON l.c = m.c AND l.d > m.d
  UNION SELECT list_append(k.sequence[:-2], list_append(k.sequence[-1], l.item)), l.item, l.c, l.d
  FROM k{i} k JOIN l ON l.c = k.c AND l.d = k.d AND l.item > k.tail),
f{i + 1} AS (SELECT sequence, COUNT(DISTINCT c) AS freq FROM e{i + 1}, n GROUP BY sequence, least HAVING COUNT(DISTINCT c) >= least)""")
    return "WITH " + ",\n".join(parts) + " " + " UNION ALL ".join(f"SELECT * FROM f{i}" for i in range(1, sets + 1))


def _order_lines(t: Tables):
    """(customer, order date, brand), distinct."""
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(p, "l_partkey").join(o, "l_orderkey")
    return lines.select("o_custkey", "o_orderdate", F.col("p_brand").alias("item")).distinct()


def _patterns(spark, sf, support: float):
    lines = saved_table(_order_lines(Tables(spark, sf)), "order-lines")
    n = lines.agg(F.count_distinct("o_custkey")).first()[0]
    return frequent_sequences(lines, "o_custkey", "o_orderdate", "item", math.ceil(support * n))


@query("sequence_patterns", _sequence_sql(0.5, 3))
def sequence_patterns(spark, sf):
    """Sequential patterns that half of the customers show, of any
    length, over whole histories."""
    return _patterns(spark, sf, 0.5)


@query("prefix_span", _sequence_sql(0.25, 4))
def prefix_span(spark, sf):
    """Patterns that a quarter of the customers show, of any length, over
    whole histories (three items on these tables)."""
    return _patterns(spark, sf, 0.25)


# ---- approximate similarity (LSH) --------------------------------------------
# Recall is stated on all pairs of rows.

_L2_RADIUS, _L2_TABLES = 5.0, 8
_JACCARD, _JACCARD_TABLES = 0.3, 12


def _bucket_length(d, radius: float) -> float:
    """Bucket length from the data: a pair within ``radius`` lies about
    ``radius / sqrt(dims)`` apart on a random direction, and the bucket is
    four times that, but no more than a quarter of the rows' own spread."""
    r = d.select(Summarizer.metrics("variance").summary(F.col("features")).alias("s")).first()["s"]["variance"]
    spread = float(sum(r)) ** 0.5 / len(r) ** 0.5
    return max(min(4 * radius / len(r) ** 0.5, spread), 1e-9)


def _l2_model(d):
    return BucketedRandomProjectionLSH(inputCol="features", outputCol="h", bucketLength=_bucket_length(d, _L2_RADIUS),
                                       numHashTables=_L2_TABLES, seed=1).fit(d)


_L2_SQL = f"""
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.x, b.x) AS dist FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)"""
_NEAR = 1.2
# every row against every other; the search for neighbours asks some rows only
_L2_ALL_SQL = """
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.x, b.x) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id)"""


@query("l2_similarity_join", f"""
WITH c AS (SELECT MIN(vec_id) AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE embedding IS NOT NULL GROUP BY embedding)
SELECT a.id AS a, b.id AS b, ROUND(list_distance(a.x, b.x), 9) AS dist
FROM c a JOIN c b ON a.id < b.id WHERE list_distance(a.x, b.x) <= {_NEAR}""")
def l2_similarity_join(spark, sf):
    """All pairs of different vectors within a distance, as rows; equal
    vectors are one point (``vector_members`` is the membership)."""
    reps, _ = MJ.vector_classes(Tables(spark, sf).embeddings, "vec_id", "embedding")
    return MJ.l2_pairs(reps, _NEAR).withColumn("dist", F.round("dist", 9))


@query("lsh_l2_join", f"WITH {_L2_ALL_SQL} SELECT COUNT(*) AS exact, TRUE AS within, TRUE AS recall_ok FROM p WHERE dist < {_L2_RADIUS}")
def lsh_l2_join(spark, sf):
    """J10's hashed form, measured on all rows against all rows: the exact count
    block by block, whether every pair found is within the distance, and recall of
    at least 0.9. Pairs are counted where they meet."""
    d = _emb(Tables(spark, sf))
    hashed = _l2_model(d).transform(d.distinct()).select(
        F.col("vec_id").alias("id"), vector_to_array("features").alias("x"),
        F.transform("h", lambda v: vector_to_array(v)[0].cast("long")).alias("h"))
    hashed = saved_table(hashed, "l2-hashes")
    found = MJ.bucket_matches(hashed, hashed, _L2_RADIUS, counted=True)
    got = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max("far").alias("far")).first()
    points = d.select(F.col("vec_id").alias("id"), vector_to_array("features").alias("x"))
    exact = MJ.l2_within(points, points, _L2_RADIUS, counted=True).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return spark.createDataFrame([(exact, (got["far"] or 0.0) < _L2_RADIUS, got["n"] >= 0.9 * exact)],
                                 "exact long, within boolean, recall_ok boolean")


@query("lsh_l2_buckets", f"SELECT CAST(t AS INTEGER) AS hash_table, COUNT(*) AS n, TRUE AS spread FROM embeddings, range({_L2_TABLES}) r(t) GROUP BY 1")
def lsh_l2_buckets(spark, sf):
    """J10's buckets: rows per hash table, and whether the largest bucket holds
    less than half of them."""
    d = _emb(Tables(spark, sf))
    h = _l2_model(d).transform(d).select(F.posexplode("h").alias("hash_table", "h"))
    sizes = h.groupBy("hash_table", vector_to_array("h")[0].alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("hash_table").agg(F.sum("n").alias("total"), F.max("n").alias("largest")).select(
        F.col("hash_table").cast("int").alias("hash_table"), F.col("total").alias("n"),
        (F.col("largest") < F.col("total") / 2).alias("spread"))


_JACCARD_SQL = """
t AS (SELECT doc_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '\\W'), lambda x: len(x) > 0))) AS s FROM documents),
c AS (SELECT s, MIN(doc_id) AS rep, COUNT(*) AS copies, MAX(CASE WHEN doc_id % 50 = 0 THEN 1 ELSE 0 END) AS asked FROM t WHERE len(s) > 0 GROUP BY s),
p AS (SELECT a.rep AS a, b.rep AS b, a.asked AS asked, len(list_intersect(a.s, b.s)) AS i, len(a.s) + len(b.s) AS u
      FROM c a JOIN c b ON {on})"""


def _token_sets(t: Tables):
    """(classes of equal token sets, membership)."""
    return MJ.set_classes(regex_tokens(t.documents.select("doc_id", "text")), "doc_id", "tokens")


@query("jaccard_similarity_join", f"WITH {_JACCARD_SQL.format(on='a.rep < b.rep')} "
       f"SELECT a, b, ROUND(i / (u - i), 9) AS similarity FROM p WHERE i / (u - i) >= {1 - _JACCARD}")
def jaccard_similarity_join(spark, sf):
    """All pairs of different token sets of at least that similarity, as
    rows between classes (``token_set_members`` is the membership)."""
    reps, _ = _token_sets(Tables(spark, sf))
    return MJ.jaccard_pairs(saved_table(reps.select("id", "s"), "token-sets"), 1 - _JACCARD).withColumn(
        "similarity", F.round("similarity", 9))


@query("lsh_jaccard_join", f"WITH {_JACCARD_SQL.format(on='a.rep <> b.rep')} SELECT COUNT(*) AS exact, "
       f"TRUE AS within, TRUE AS recall_ok FROM p WHERE 1 - i / (u - i) < {_JACCARD}")
def lsh_jaccard_join(spark, sf):
    """J11's hashed form, measured on all classes against all classes (pairs in
    both orders): the exact count, every pair found within the distance, recall of
    at least 0.9. Equal sets share one row, so copies cannot fill a bucket."""
    c = saved_table(_token_sets(Tables(spark, sf))[0].select("id", "s"), "token-sets")
    tf = HashingTF(inputCol="s", outputCol="tf", numFeatures=1 << 20, binary=True).transform(c)
    m = MinHashLSH(inputCol="tf", outputCol="h", numHashTables=_JACCARD_TABLES, seed=1).fit(tf)
    hashed = saved_table(m.transform(tf).select(
        "id", "s", F.transform("h", lambda v: vector_to_array(v)[0].cast("long")).alias("h")), "set-hashes")
    near = saved_table(MJ.jaccard_pairs(hashed, 1 - _JACCARD).withColumn("dist", 1 - F.col("similarity"))
                       .filter(F.col("dist") < _JACCARD), "near-sets")
    found = MJ.jaccard_buckets(hashed, None, 1 - _JACCARD, near=near)
    got = found.agg(F.count(F.lit(1)).alias("n"), F.max(1 - F.col("similarity")).alias("far")).first()
    exact = near.count()
    return spark.createDataFrame([(2 * exact, (got["far"] or 0.0) < _JACCARD, got["n"] >= 0.9 * exact)],
                                 "exact long, within boolean, recall_ok boolean")


@query("token_set_classes", f"WITH {_JACCARD_SQL.format(on='FALSE')} SELECT rep, copies FROM c")
def token_set_classes(spark, sf):
    """Classes of documents with equal token sets."""
    return _token_sets(Tables(spark, sf))[0].select(F.col("id").alias("rep"), "copies")


@query("token_set_members", f"WITH {_JACCARD_SQL.format(on='FALSE')} SELECT t.doc_id AS member, c.rep AS id FROM t JOIN c ON t.s = c.s")
def token_set_members(spark, sf):
    """The class of every document with a token."""
    return _token_sets(Tables(spark, sf))[1].select("member", "id")


@query("lsh_ann", f"WITH {_L2_SQL}, f AS (SELECT MIN(vec_id) AS k FROM embeddings), " + """
n AS (SELECT b, dist FROM p, f WHERE a = k ORDER BY dist LIMIT 4)
SELECT CAST(COUNT(*) + 1 AS INTEGER) AS found, TRUE AS self_first, TRUE AS close FROM n""")
def lsh_ann(spark, sf):
    """Five approximate nearest neighbours of the first embedding: itself
    first, and the farthest no farther than 1.2 times the exact fifth."""
    d = _emb(Tables(spark, sf))
    first = d.orderBy("vec_id").first()
    got = _l2_model(d).approxNearestNeighbors(d, first["features"], 5, distCol="dist").select("vec_id", "dist").collect()
    key = [float(v) for v in first["features"]]
    gap = F.aggregate(F.zip_with(vector_to_array("features"), F.array(*[F.lit(v) for v in key]),
                                 lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    fifth = d.select(F.sqrt(gap).alias("dist")).orderBy("dist").limit(5).agg(F.max("dist")).first()[0]
    rows = sorted((r["dist"], r["vec_id"]) for r in got)
    return spark.createDataFrame([(len(rows), rows[0][1] == first["vec_id"], rows[-1][0] <= 1.2 * fifth)],
                                 "found int, self_first boolean, close boolean")


# ---- pipelines, tuning, persistence, purchase model ---------------------------

@query("ml_stages_score", "SELECT doc_id, CAST(quality AS DOUBLE) AS label, TRUE AS same, TRUE AS beats_majority FROM documents JOIN labels USING (doc_id)")
def ml_stages_score(spark, sf):
    """Tokenizer → hashing TF → logistic regression as one pipeline,
    saved unfitted and fitted, loaded back and applied."""
    t = Tables(spark, sf)
    docs = t.documents.select("doc_id", "text").join(t.labels.select("doc_id", "quality"), "doc_id")
    docs = docs.select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    p = Pipeline(stages=[Tokenizer(inputCol="text", outputCol="words"),
                         HashingTF(inputCol="words", outputCol="features", numFeatures=1 << 12),
                         LogisticRegression(maxIter=10, regParam=0.001)])
    p.write().overwrite().save(scratch_path(spark, "pipeline-unfit"))
    model = p.fit(docs)
    path = scratch_path(spark, "pipeline-fit")
    model.write().overwrite().save(path)
    # the loaded pipeline predicts what the fitted one does
    before = model.transform(docs).select("doc_id", F.col("prediction").alias("before"))
    after = PipelineModel.load(path).transform(docs).select("doc_id", "label", "prediction").join(before, "doc_id")
    after = after.withColumn("same", F.col("prediction") == F.col("before")).cache()
    out = _judged(after, "doc_id", "same")
    return out


@query("cv_select", "SELECT CAST(g AS INTEGER) AS grid_point, TRUE AS beats_majority FROM range(4) r(g)")
def cv_select(spark, sf):
    """A logistic grid by Spark's cross-validation; every grid point is
    right more often than the majority class."""
    d = _emb_sign(Tables(spark, sf)).cache()
    lr = LogisticRegression(maxIter=5)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.1, 0.01]).addGrid(lr.elasticNetParam, [0.0, 0.5]).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid,
                        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
                        numFolds=2, parallelism=2, seed=1)
    m = cv.fit(d)
    n = [r["count"] for r in d.groupBy("label").count().collect()]  # two rows
    d.unpersist()
    return spark.createDataFrame([(i, float(v) > max(n) / sum(n)) for i, v in enumerate(m.avgMetrics)],
                                 "grid_point int, beats_majority boolean")


_RIDGE_FOLDS, _RIDGE_PENALTIES = 4, (0.0, 0.1, 10.0, 1000.0)


@query("cv_ridge", f"""
WITH d AS (SELECT l_quantity AS x, l_extendedprice / 1000 AS y,
  LEAST(CAST(FLOOR({R.hash_unit_sql('l_orderkey * 8 + l_linenumber', 29)} * {_RIDGE_FOLDS}) AS INTEGER), {_RIDGE_FOLDS - 1}) AS fold FROM lineitem),
m AS (SELECT f.fold, COUNT(*) AS n, AVG(x) AS mx, AVG(y) AS my, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy
      FROM (SELECT DISTINCT fold FROM d) f JOIN d ON d.fold <> f.fold GROUP BY f.fold),
w AS (SELECT fold, penalty, sxy / (sxx + penalty * n) AS b, my - sxy / (sxx + penalty * n) * mx AS a
      FROM m, (SELECT unnest({list(_RIDGE_PENALTIES)}) AS penalty))
SELECT w.fold, CAST(penalty AS DOUBLE) AS penalty, ROUND(AVG(POW(y - a - b * x, 2)), 4) AS mse, ROUND(b, 6) AS slope
FROM w JOIN d ON d.fold = w.fold GROUP BY w.fold, penalty, b""")
def cv_ridge(spark, sf):
    """Ridge regression over four folds and four penalties from one
    aggregate of fold statistics: error and slope of every grid point and fold."""
    d = Tables(spark, sf).lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"), "l_quantity",
                                          (F.col("l_extendedprice") / 1000).alias("label"))
    rows = FO.ridge_grid(FO.fold_moments(d, ["l_quantity"], "label", "k", _RIDGE_FOLDS, 29), _RIDGE_PENALTIES)
    return spark.createDataFrame([(f, p, round(mse, 4), round(float(w[1]), 6)) for f, p, mse, w in rows],
                                 "fold int, penalty double, mse double, slope double")


@query("tvs_select", "SELECT CAST(g AS INTEGER) AS grid_point, g IN (1, 3) AS beats_mean, g IN (1, 3) AS intercept_wins FROM range(4) r(g)")
def tvs_select(spark, sf):
    d = _reg(Tables(spark, sf))
    lr = LinearRegression(maxIter=5)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.1, 0.01]).addGrid(lr.fitIntercept, [False, True]).build()
    tvs = TrainValidationSplit(estimator=lr, estimatorParamMaps=grid, evaluator=RegressionEvaluator(),
                               trainRatio=0.8, seed=1)
    m = tvs.fit(d)
    spread = d.agg(F.stddev_pop("label")).first()[0]
    v = m.validationMetrics
    # of the two points with one regularisation, the one with an intercept fits better
    twin = {i: next(j for j, q in enumerate(grid) if j != i and q[lr.regParam] == p[lr.regParam]) for i, p in enumerate(grid)}
    return spark.createDataFrame([(i, float(v[i]) < spread, v[i] < v[twin[i]]) for i in range(len(grid))],
                                 "grid_point int, beats_mean boolean, intercept_wins boolean")


def _purchase_report_sql() -> str:
    """Held-out rows, buyers, and the log-loss of the training part's class
    shares (each class counted once more) on the held-out rows."""
    key = "userId || '-' || productId"
    return "WITH pf AS (" + _purchase_features_sql() + f"""),
u AS (SELECT label, {R.hash_unit_sql(key, 1)} AS part, {R.hash_unit_sql(key, 0)} AS thin FROM pf),
tr AS (SELECT label FROM u WHERE part < 0.8 AND (label > 0 OR thin < 0.05)),
te AS (SELECT label FROM u WHERE part >= 0.8),
s AS (SELECT CAST(k AS INTEGER) AS label, (COUNT(tr.label) + 1) / (SELECT COUNT(*) + 32 FROM tr) AS share
      FROM range(32) r(k) LEFT JOIN tr ON tr.label = k GROUP BY k)
SELECT COUNT(*) AS n, CAST(SUM(CASE WHEN te.label > 0 THEN 1 ELSE 0 END) AS BIGINT) AS buyers,
       ROUND(-AVG(LN(share)), 6) AS share_loss, TRUE AS earned FROM te JOIN s ON s.label = te.label"""


@query("purchase_day_model", _purchase_report_sql())
def purchase_day_model(spark, sf):
    """Forest of purchase days on the prepared feature table, scored
    on all held-out pairs. Buying carries no signal in these tables, so what the
    forest must earn is calibration: its mean probability of a purchase on the
    training rows is that of the rows, within a factor of three."""
    return _purchase_report(spark, sf, "forest")


@query("purchase_day_boosted", _purchase_report_sql())
def purchase_day_boosted(spark, sf):
    """M1: softmax boosted trees (32 classes, depth 7, 7 rounds) from uniform
    classes, scored on all held-out pairs: the held-out log-loss falls from
    uniform to the first round, to the fourth, to the last."""
    return _purchase_report(spark, sf, "boosted")


def _purchase_input(spark, sf):
    """Model input from the stored feature table: encoder, scaler and the fits
    read it several times, its joins and aggregates run once."""
    return J.model_input(saved_table(purchase_features_df(spark, sf), "purchase-features"))


def _purchase_report(spark, sf, kind):
    mi = _purchase_input(spark, sf).cache()
    try:
        train, test = (mi.filter(F.col("split") == i) for i in (0, 1))
        counts = {int(r["label"]): r["count"] for r in train.groupBy("label").count().collect()}  # one row per class
        total = sum(counts.values()) + 32
        model = MD.purchase_day_classifier(kind).fit(train)
        share = F.array(*[F.lit((counts.get(k, 0) + 1) / total) for k in range(32)])
        r = test.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("label") > 0).cast("long")).alias("buyers"),
                     F.avg(-F.log(share[F.col("label").cast("int")])).alias("share_loss")).first()
        earned = _loss_falls(model, test) if kind == "boosted" else _calibrated(model, train)
        return spark.createDataFrame([(r["n"], r["buyers"], round(r["share_loss"], 6), earned)],
                                     "n long, buyers long, share_loss double, earned boolean")
    finally:
        mi.unpersist()


def _calibrated(model, train) -> bool:
    r = model.transform(train).agg(F.avg(1 - F.get("probabilities", F.lit(0))).alias("said"),
                                   F.avg((F.col("label") > 0).cast("double")).alias("is")).first()
    return r["is"] / 3 < r["said"] < 3 * r["is"]


def _loss_falls(model, test) -> bool:
    rounds = len(model.trees)
    loss = [math.log(model.classes)]
    for n in sorted({1, -(-rounds // 2), rounds}):
        p = F.get("probabilities", F.col("label").cast("int"))
        loss.append(model.first_rounds(n).transform(test).agg(F.avg(-F.log(p))).first()[0])
    return all(y < x for x, y in zip(loss, loss[1:]))


_BOOST_NUMBERS = [c for c in (*FT.feature_columns(), "segment", "nation", "grade", "price", "cate", "size")
                  if c not in ("segment", "grade")]


def _boost_root_sql(lam: float = 2.0, gamma: float = 0.1) -> str:
    """Root gains of softmax boosting from counts: with uniform classes the
    gradients of ``n`` rows with ``n_k`` of class k give a score of
    ``(sum n_k^2 - n^2 / 32) / (n h + lambda)``, ``h = 2 / 32 * 31 / 32``."""
    key = "userId || '-' || productId"
    cols = ", ".join(f"CAST({c} AS DOUBLE)" for c in _BOOST_NUMBERS)
    h = 2 / 32 * (1 - 1 / 32)
    return "WITH pf AS (" + _purchase_features_sql() + f"""),
tr AS (SELECT label, [{cols}] AS x FROM pf WHERE {R.hash_unit_sql(key, 1)} < 0.8 AND (label > 0 OR {R.hash_unit_sql(key, 0)} < 0.05)),
v AS (SELECT label, CAST(i AS INTEGER) AS feature, x[i + 1] AS v FROM tr, range({len(_BOOST_NUMBERS)}) r(i)),
g AS (SELECT feature, MIN(v) AS lo, MAX(v) AS hi FROM v GROUP BY 1),
s AS (SELECT label, feature, CASE WHEN hi > lo THEN (v - lo) / (hi - lo) ELSE 0.5 END AS v FROM v JOIN g USING (feature)),
b AS (SELECT label, feature, CASE WHEN v = 0 THEN 0 ELSE 1 + LEAST(FLOOR(CASE WHEN hi > lo THEN (v - lo) / (hi - lo) ELSE 0 END * 32 + 1e-9), 31) END AS bin
      FROM s JOIN (SELECT feature, MIN(v) AS lo, MAX(v) AS hi FROM s GROUP BY 1) USING (feature)),
c AS (SELECT feature, bin, label, COUNT(*) AS n FROM b GROUP BY 1, 2, 3),
t AS (SELECT feature, label, SUM(n) AS n FROM c GROUP BY 1, 2),
l AS (SELECT t.feature, t.label, CAST(th AS INTEGER) AS threshold, m.side AS missing_left, t.n AS total,
             COALESCE(SUM(c.n), 0) AS n
      FROM t, range(1, 32) r(th), (SELECT unnest([FALSE, TRUE]) AS side) m
      LEFT JOIN c ON c.feature = t.feature AND c.label = t.label AND CASE WHEN c.bin = 0 THEN m.side ELSE c.bin <= th END
      GROUP BY 1, 2, 3, 4, 5),
q AS (SELECT feature, threshold, missing_left, SUM(n) AS nl, SUM(n * n) AS ql, SUM(total - n) AS nr,
             SUM((total - n) * (total - n)) AS qr, SUM(total) AS nt, SUM(total * total) AS qt FROM l GROUP BY 1, 2, 3),
w AS (SELECT *, ((ql - nl * nl / 32) / (nl * {h} + {lam}) + (qr - nr * nr / 32) / (nr * {h} + {lam})
             - (qt - nt * nt / 32) / (nt * {h} + {lam})) / 2 - {gamma} AS gain
      FROM q WHERE nl * 32 * {h} >= 5 AND nr * 32 * {h} >= 5)"""


def _boost_stump_sql() -> str:
    """The best split applied: leaf weights from the counts of either side,
    softmax of them for every held-out pair."""
    key = "userId || '-' || productId"
    cols = ", ".join(f"CAST({c} AS DOUBLE)" for c in _BOOST_NUMBERS)
    return _boost_root_sql(0.0, 0.0) + f""",
best AS (SELECT * FROM w ORDER BY ROUND(gain, 9) DESC, feature, missing_left, threshold LIMIT 1),
leaf AS (SELECT l.label, l.n, l.total - l.n AS m, nl, nr FROM l JOIN best b USING (feature, threshold, missing_left)),
weight AS (SELECT k AS label, -0.1 * (MAX(b.nl) / 32 - COALESCE(SUM(f.n), 0)) / (MAX(b.nl) * {2 / 32 * (1 - 1 / 32)}) AS wl,
  -0.1 * (MAX(b.nr) / 32 - COALESCE(SUM(f.m), 0)) / (MAX(b.nr) * {2 / 32 * (1 - 1 / 32)}) AS wr
  FROM range(32) r(k) CROSS JOIN best b LEFT JOIN leaf f ON f.label = k GROUP BY k),
p AS (SELECT EXP(MAX(CASE WHEN label = 0 THEN wl END)) / SUM(EXP(wl)) AS pl, EXP(MAX(CASE WHEN label = 0 THEN wr END)) / SUM(EXP(wr)) AS pr FROM weight),
te AS (SELECT userId, productId, [{cols}][best.feature + 1] AS v, best.* FROM pf, best WHERE {R.hash_unit_sql(key, 1)} >= 0.8),
z AS (SELECT te.*, CASE WHEN g.hi > g.lo THEN (v - lo) / (hi - lo) ELSE 0.5 END AS x FROM te JOIN g USING (feature)),
side AS (SELECT userId, productId, CASE WHEN x = 0 THEN missing_left
  ELSE 1 + LEAST(GREATEST(FLOOR(x * 32 + 1e-9), 0), 31) <= threshold END AS goes_left FROM z)
SELECT userId, productId, ROUND(CASE WHEN goes_left THEN pl ELSE pr END, 9) AS p_none FROM side, p"""


@query("purchase_boost_stump", _boost_stump_sql())
def purchase_boost_stump(spark, sf):
    """M1: one round of depth one on the numeric features, without penalties (so
    that the root splits): the probability of no purchase of every held-out pair."""
    from pyspark.ml.feature import VectorSlicer
    mi = _purchase_input(spark, sf).withColumnRenamed("features", "every")
    mi = VectorSlicer(inputCol="every", outputCol="features", indices=list(range(len(_BOOST_NUMBERS)))).transform(mi)
    mi = saved_table(mi.select("userId", "productId", F.col("label").cast("double").alias("label"), "features", "split"), "boost-rows")
    model = SoftmaxBoosting(rounds=1, depth=1, colsample=1.0, reg_lambda=0.0, gamma=0.0).fit(mi.filter(F.col("split") == 0))
    return model.transform(mi.filter(F.col("split") == 1)).select(
        "userId", "productId", F.round(F.get("probabilities", F.lit(0)), 9).alias("p_none"))


@query("purchase_boost_root", _boost_root_sql() + " SELECT feature, ROUND(MAX(gain), 6) AS gain FROM w GROUP BY feature")
def purchase_boost_root(spark, sf):
    """M1: the best root split of every numeric feature in the first round,
    from the gradient histograms of the fit itself."""
    train = _purchase_input(spark, sf).filter(F.col("split") == 0)
    splits = SoftmaxBoosting().root_splits(train.select(F.col("label").cast("double").alias("label"), "features"))
    return splits.filter((F.col("feature") < len(_BOOST_NUMBERS)) & (F.col("gain") > F.lit(float("-inf")))).select(
        "feature", F.round("gain", 6).alias("gain"))


@query("sales_forecast", f"""
SELECT COUNT(DISTINCT l_partkey) FILTER (WHERE {R.hash_unit_sql('l_partkey', 21)} >= 0.8) AS n_test, TRUE AS scored, TRUE AS beats_zero FROM lineitem""")
def sales_forecast(spark, sf):
    """Look-back features → GBT regressor tuned by 4-fold cross-validation
    on 80 % of the items → RMSE and score 1/(1+RMSE) on the held-out items."""
    from .q_jobs import _weekly_sales
    f = J.lookback_features(_weekly_sales(Tables(spark, sf)), "item", "week", "qty", 300, 8)
    d = f.select("item", F.col("next_qty").alias("label"), array_to_vector("lookback").alias("features")).cache()
    try:
        train, test = R.split_frames(d, "item", [0.8, 0.2], salt=21)
        gbt = GBTRegressor(maxIter=3, maxDepth=3, seed=1)
        grid = ParamGridBuilder().addGrid(gbt.maxDepth, [2, 3]).build()
        cv = CrossValidator(estimator=gbt, estimatorParamMaps=grid, evaluator=RegressionEvaluator(),
                            numFolds=4, seed=1)
        pred = cv.fit(train).transform(test)
        met = M.regression_metrics(pred, "label", "prediction").select("rmse", "score").first()
        # a forecast of no sales at all has the root mean square of the labels as error
        zero = test.agg(F.sqrt(F.avg(F.pow("label", F.lit(2.0))))).first()[0]
        return spark.createDataFrame([(test.count(), abs(met["score"] - 1 / (1 + met["rmse"])) < 1e-9, met["rmse"] < zero)],
                                     "n_test long, scored boolean, beats_zero boolean")
    finally:
        d.unpersist()


@query("pca_vs_full", f"SELECT 'full' AS model, 64 AS dims, COUNT(*) AS n_test, TRUE AS as_expected FROM embeddings{_TEST_SQL} UNION ALL SELECT 'pca', 8, COUNT(*), TRUE FROM embeddings{_TEST_SQL}")
def pca_vs_full(spark, sf):
    """Linear regression on all 64 dims vs on 8 principal components,
    both scored on the held-out split. The target is linear in the dims, so the
    full model must find it and the reduced one loses what its components lack,
    but not more than 1.2 times the target's spread."""
    from pyspark.ml.feature import PCA
    x = vector_to_array("features")
    d = _emb(Tables(spark, sf)).withColumn("label", 3 * x[0] + 2 * x[1] - x[2])
    train, test = _split(d, "vec_id")
    full = LinearRegression(solver="normal").fit(train)
    pca = PCA(k=8, inputCol="features", outputCol="pc").fit(train)
    lr_pc = LinearRegression(solver="normal", featuresCol="pc").fit(pca.transform(train))
    ev = RegressionEvaluator(metricName="rmse")
    rows = []
    for name, dims, scored in (("full", len(full.coefficients), full.transform(test)),
                               ("pca", len(lr_pc.coefficients), lr_pc.transform(pca.transform(test)))):
        rows.append((name, dims, scored.count(), ev.evaluate(scored)))
    spread = test.agg(F.stddev_pop("label")).first()[0]
    best = rows[0][3]
    ok = {"full": best < 1e-6 * spread, "pca": best < rows[1][3] < 1.2 * spread}
    return spark.createDataFrame([(name, dims, n, ok[name]) for name, dims, n, _ in rows],
                                 "model string, dims int, n_test long, as_expected boolean")


@query("kmeans_cost", "WITH " + _TOTAL_SSE_SQL + """
SELECT CAST(k AS INTEGER) AS k, ROUND(sse, 3) AS one_cluster, TRUE AS tighter FROM t, (SELECT unnest([2, 5, 10]) AS k)""")
def kmeans_cost(spark, sf):
    """Training cost (within-set SSE) by k, each below that of
    fewer clusters, from the cost of one cluster (exact) downwards."""
    d = _emb(Tables(spark, sf)).cache()
    one = _total_sse(d)
    rows, before = [], one
    for k in (2, 5, 10):
        cost = float(KMeans(k=k, seed=1, maxIter=20, initMode="k-means||").fit(d).summary.trainingCost)
        rows.append((k, round(one, 3), 0 < cost < before))
        before = cost
    d.unpersist()
    return spark.createDataFrame(rows, "k int, one_cluster double, tighter boolean")


@query("word2vec_synonyms", """
WITH t AS (SELECT unnest(list_filter(regexp_split_to_array(lower(text), '\\W'), lambda x: len(x) > 0)) AS w FROM benchmark),
top AS (SELECT w FROM t GROUP BY w ORDER BY COUNT(*) DESC, w LIMIT 1)
SELECT w AS word, 5 AS n, TRUE AS nearest_first, TRUE AS in_vocabulary FROM top""")
def word2vec_synonyms(spark, sf):
    """Word vectors over the benchmark passages and the five nearest words
    to the most frequent token: other words of the vocabulary, nearest first,
    by the cosine of the fitted vectors."""
    from pyspark.ml.feature import Word2Vec
    b = regex_tokens(Tables(spark, sf).benchmark.select("item_id", "text"))
    m = Word2Vec(vectorSize=8, minCount=2, maxIter=1, seed=5, inputCol="tokens", outputCol="v").fit(b)
    words = b.select(F.explode("tokens").alias("w")).groupBy("w").count()
    top = words.orderBy(F.col("count").desc(), "w").first()["w"]
    found = m.findSynonyms(top, 5).collect()  # five rows
    scores = [r["similarity"] for r in found]
    known = words.filter(F.col("w").isin([r["word"] for r in found]) & (F.col("count") >= 2)).count()
    falling = scores == sorted(scores, reverse=True) and all(-1 <= x <= 1 + 1e-6 for x in scores)
    return spark.createDataFrame([(top, len(found), falling, known == len(found) and top not in {r["word"] for r in found})],
                                 "word string, n int, nearest_first boolean, in_vocabulary boolean")


@query("als_rmse", "SELECT TRUE AS beats_mean, TRUE AS improves")
def als_rmse(spark, sf):
    """Explicit ALS on its training pairs (held-out ratings carry no
    signal here): RMSE below the spread around the mean rating, and lower after
    five rounds than after one."""
    train, _ = _als_split(Tables(spark, sf))
    train = train.cache()
    rmse = []
    for rounds in (1, 5):
        m = ALS(rank=5, maxIter=rounds, regParam=0.1, userCol="user", itemCol="item", ratingCol="rating", seed=1).fit(train)
        rmse.append(RegressionEvaluator(metricName="rmse", labelCol="rating").evaluate(m.transform(train)))
    spread = train.agg(F.stddev_pop("rating")).first()[0]
    train.unpersist()
    return spark.createDataFrame([(rmse[1] < spread, rmse[1] < rmse[0])], "beats_mean boolean, improves boolean")
