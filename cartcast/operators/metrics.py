"""Evaluation metrics as DataFrame aggregates (V1–V9).

Each metric is one or two aggregate passes; curves pre-aggregate to
distinct (optionally binned) scores before any ordered pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import global_running_sums


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """MSE, RMSE, MAE, R², explained variance and score 1/(1+RMSE) (V1, V2).

    Explained variance follows Spark's evaluator: mean squared deviation of
    the prediction from the label mean.
    """
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    s = df.agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy"),
               F.sum(F.pow(p - y, 2)).alias("sse"), F.sum(F.abs(p - y)).alias("sae"),
               F.sum(p).alias("sp"), F.sum(p * p).alias("spp"))
    n = F.col("n")
    mean_y = F.col("sy") / n
    sst = F.col("syy") - n * mean_y * mean_y
    # sum (p - mean_y)^2 = spp - 2 mean_y sp + n mean_y^2
    ev = (F.col("spp") - 2 * mean_y * F.col("sp") + n * mean_y * mean_y) / n
    mse = F.col("sse") / n
    return s.select(mse.alias("mse"), F.sqrt(mse).alias("rmse"), (F.col("sae") / n).alias("mae"),
                    (1 - F.col("sse") / sst).alias("r2"), ev.alias("var"),
                    (1 / (1 + F.sqrt(mse))).alias("score"))


def binary_curve(df: DataFrame, score: str, label: str, num_bins: int | None = None,
                 beta: float = 1.0) -> DataFrame:
    """Per threshold (distinct score, high to low): tp, fp, precision, recall,
    F(beta), FPR (V3). Scores are grouped first (optionally binned), and the
    cumulative counts use ``global_running_sum``, so no step holds all rows."""
    s = F.col(score).cast("double")
    if num_bins:
        s = F.floor(s * num_bins) / num_bins
    pos = F.when(F.col(label) > 0.5, 1).otherwise(0)
    g = df.groupBy(s.alias("threshold")).agg(F.sum(pos).cast("long").alias("p"),
                                              F.sum(1 - pos).cast("long").alias("n"))
    g = g.withColumn("neg_threshold", -F.col("threshold"))
    # both sums and the totals come from one ordered pass
    cum, tot = global_running_sums(g, "neg_threshold", {"p": "tp", "n": "fp"})
    tot = {"P": tot["tp"], "N": tot["fp"]}
    b2 = beta * beta
    prec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp"), F.lit(tot["P"]))
    return cum.select("threshold", "p", "n", "tp", "fp", prec.alias("precision"), rec.alias("recall"),
                      F.when(prec + rec > 0, (1 + b2) * prec * rec / (b2 * prec + rec))
                       .otherwise(0.0).alias("f_measure"),
                      F.try_divide(F.col("fp"), F.lit(tot["N"])).alias("fpr"),
                      F.lit(tot["P"]).alias("total_p"), F.lit(tot["N"]).alias("total_n"))


def auc(curve: DataFrame) -> DataFrame:
    """Areas under ROC and PR (trapezoids) from ``binary_curve``.

    Each threshold's trapezoid only needs its own increments: the previous
    point is (tp - p, fp - n), so both areas are plain sums over the curve
    rows with no ordering step, whatever the number of distinct scores.
    Products of counts are taken as doubles: the totals may be integers, and
    their product leaves that type from some 60,000 rows of either class on.
    """
    tp, fp, p, n, P, N = (F.col(c).cast("double") for c in ("tp", "fp", "p", "n", "total_p", "total_n"))
    tp0, fp0 = tp - p, fp - n
    prec = F.col("precision")
    prec0 = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(prec)
    roc = F.try_divide(n * (tp + tp0), 2 * N * P)
    pr = F.try_divide(p, P) * (prec + prec0) / 2
    return curve.agg(F.sum(roc).alias("auc_roc"), F.sum(pr).alias("auc_pr"))


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")) \
             .agg(F.count(F.lit(1)).alias("n"))


def multiclass_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per label precision, recall, F1, FPR plus weighted averages and
    accuracy, in long form (metric, label, value) (V4, V7)."""
    # the table is read once, into at most k * k cells; margins are sums of cells
    cells = confusion_matrix(df, label, pred)
    ends = F.array(F.struct(F.col("label").alias("k"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted"),
                            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp")),
                   F.struct(F.col("prediction").alias("k"), F.lit(0).cast("long").alias("actual"),
                            F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")))
    per = (cells.select(F.explode(ends).alias("e")).select("e.*").groupBy("k")
           .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
           .withColumn("total", F.sum("actual").over(Window.partitionBy(F.lit(0)))))  # a row per class
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("actual") > 0, F.col("tp") / F.col("actual")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    fpr = (F.col("predicted") - F.col("tp")) / (F.col("total") - F.col("actual"))
    per = per.select("k", "actual", "total", prec.alias("precision"), rec.alias("recall"),
                     f1.alias("f1"), fpr.alias("fpr"), "tp")
    every = Window.partitionBy(F.lit(0))  # a row per class
    share = F.col("actual") / F.col("total")
    names = ("precision", "recall", "f1", "fpr")
    whole = {f"weighted_{c}": F.sum(share * F.col(c)).over(every) for c in names}
    whole["accuracy"] = F.sum("tp").over(every) / F.col("total")
    per = per.withColumns(whole).withColumn("first", F.row_number().over(every.orderBy("k")) == 1)

    def row(label, metric, value):
        return F.struct(label.cast("double").alias("label"), F.lit(metric).alias("metric"),
                        value.cast("double").alias("value"))
    own = F.array(*[row(F.col("k"), c, F.col(c)) for c in names])
    total = F.array(*[row(F.lit(None), c, F.col(c)) for c in whole],
                    row(F.lit(None), "test_error", 1 - F.col("accuracy")))
    return per.select(F.explode(F.when(F.col("first"), F.concat(own, total)).otherwise(own)).alias("r")).select("r.*")


def multilabel_metrics(df: DataFrame, labels: str, preds: str) -> DataFrame:
    """Document-averaged and micro metrics, Hamming loss, subset accuracy (V5).

    ``labels`` / ``preds`` are array columns of distinct values per row.
    """
    L, P = F.col(labels), F.col(preds)
    inter = F.size(F.array_intersect(L, P))
    nl, np_ = F.size(L), F.size(P)
    uni = F.size(F.array_union(L, P))
    per = df.select(inter.alias("i"), nl.alias("l"), np_.alias("p"), uni.alias("u"),
                    F.explode_outer(F.array_union(L, P)).alias("_lab"))
    n_labels = per.agg(F.count_distinct("_lab")).first()[0]  # scalar
    rows = df.select(inter.alias("i"), nl.alias("l"), np_.alias("p"), uni.alias("u"))
    agg = rows.agg(
        F.count(F.lit(1)).alias("docs"),
        F.avg(F.when(F.col("p") > 0, F.col("i") / F.col("p")).otherwise(0.0)).alias("precision"),
        F.avg(F.when(F.col("l") > 0, F.col("i") / F.col("l")).otherwise(0.0)).alias("recall"),
        F.avg(F.when(F.col("l") + F.col("p") > 0, 2 * F.col("i") / (F.col("l") + F.col("p")))
               .otherwise(0.0)).alias("f1"),
        F.avg(F.when(F.col("u") > 0, F.col("i") / F.col("u")).otherwise(1.0)).alias("accuracy"),
        F.avg(F.when((F.col("i") == F.col("l")) & (F.col("i") == F.col("p")), 1.0).otherwise(0.0))
         .alias("subset_accuracy"),
        F.sum("i").alias("si"), F.sum("l").alias("sl"), F.sum("p").alias("sp"),
        F.sum(F.col("l") + F.col("p") - 2 * F.col("i")).alias("sh"))
    return agg.select(
        "precision", "recall", "f1", "accuracy", "subset_accuracy",
        (F.col("sh") / (F.col("docs") * F.lit(n_labels))).alias("hamming_loss"),
        (F.col("si") / F.col("sp")).alias("micro_precision"),
        (F.col("si") / F.col("sl")).alias("micro_recall"),
        (2 * F.col("si") / (F.col("sp") + F.col("sl"))).alias("micro_f1"))


def ranking_metrics(pred: DataFrame, relevant: DataFrame, k: int,
                    user: str = "user", item: str = "item", rank: str = "rank") -> DataFrame:
    """precision@k, MAP and NDCG@k from long-form rows (V6).

    ``pred``: (user, item, rank 1..m) top lists; ``relevant``: (user, item).
    Users are those with a prediction list; no per-user arrays are built.
    """
    nrel = relevant.groupBy(user).agg(F.count(F.lit(1)).alias("nrel"))
    hits = pred.join(relevant.withColumn("_hit", F.lit(1)), [user, item], "left") \
               .withColumn("_hit", F.coalesce("_hit", F.lit(0)))
    w = Window.partitionBy(user).orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    hits = hits.withColumn("_cum", F.sum("_hit").over(w))
    r = F.col(rank)
    per_user = hits.groupBy(user).agg(
        F.sum(F.when(r <= k, F.col("_hit")).otherwise(0)).alias("hk"),
        F.sum(F.when(F.col("_hit") == 1, F.col("_cum") / r).otherwise(0.0)).alias("ap_sum"),
        F.sum(F.when((r <= k) & (F.col("_hit") == 1), 1 / F.log2(r + 1)).otherwise(0.0)).alias("dcg"))
    per_user = per_user.join(nrel, user, "left").na.fill(0, ["nrel"])
    # ideal DCG: sum_{i=1..min(k, nrel)} 1/log2(i+1), from a k-row table
    ideal = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(F.lit(k), F.col("nrel")), F.lit(1))),
                        F.lit(0.0), lambda acc, i: acc + 1 / F.log2(i + 1))
    per_user = per_user.withColumn("idcg", F.when(F.col("nrel") > 0, ideal).otherwise(0.0))
    return per_user.agg(
        F.avg(F.col("hk") / k).alias("precision_at_k"),
        F.avg(F.when(F.col("nrel") > 0, F.col("ap_sum") / F.col("nrel")).otherwise(0.0)).alias("map"),
        F.avg(F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(0.0)).alias("ndcg_at_k"))


def hit_rates(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Buyer hit rate, purchase-date hit rate (two-sided, quirk Q15) and
    overall date accuracy, one pass (V8)."""
    y, p = F.col(label), F.col(pred)
    bought = y > 0
    close = F.abs(y - p) < 0.1
    return df.agg(
        (F.sum(F.when(bought & (p > 0), 1).otherwise(0)) / F.sum(F.when(bought, 1).otherwise(0))).alias("buyer_hit"),
        (F.sum(F.when(bought & close, 1).otherwise(0)) / F.sum(F.when(bought, 1).otherwise(0))).alias("date_hit"),
        F.avg(F.when(close, 1.0).otherwise(0.0)).alias("overall_hit"))


def contest_score(submission: DataFrame, answer: DataFrame, alpha: float = 0.4,
                  weight: Callable[[Column], Column] | None = None,
                  decay: Callable[[Column], Column] | None = None,
                  user: str = "user", rank: str = "rank", date: str = "date") -> DataFrame:
    """``alpha * S1 + (1 - alpha) * S2`` (V9).

    S1: weighted share of submitted users who bought (weight by submission
    rank); S2: mean over answer users of ``decay(|days off|)``, 0 if the
    user was not submitted. The published weight and decay formulas are
    images, so they are parameters; the defaults are placeholders.
    """
    weight = weight or (lambda r: 1 / (1 + F.log(r)))
    decay = decay or (lambda d: 10 / (10 + d * d))
    a = answer.select(F.col(user).alias("_u"), F.col(date).alias("_true"))
    j = submission.join(a, submission[user] == a["_u"], "left")
    s1 = j.agg((F.sum(weight(F.col(rank)) * F.when(F.col("_u").isNotNull(), 1.0).otherwise(0.0))
                / F.sum(weight(F.col(rank)))).alias("s1"))
    j2 = a.join(submission.select(F.col(user).alias("_u"), F.col(date).alias("_pred")), "_u", "left")
    d = F.abs(F.datediff(F.col("_pred"), F.col("_true")))
    s2 = j2.agg(F.avg(F.when(F.col("_pred").isNotNull(), decay(d)).otherwise(0.0))).first()[0]
    return s1.select("s1", F.lit(s2).alias("s2"),
                     (alpha * F.col("s1") + (1 - alpha) * F.lit(s2)).alias("score"))

