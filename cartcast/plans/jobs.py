"""End-to-end jobs composed from the operators."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_before, month_key
from ..operators import relational as R
from ..operators.horizons import lookback_cumulative
from .features import PAIR

ID_COLS = ("userId", "productId", "label")


def profile_tables(users: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Category profiles in long form (profile, key, n) (L1): users per
    segment and grade, products per category, order lines and distinct
    buyers per month. Every profile is one grouped aggregate."""
    def prof(df, name, key):
        return (df.groupBy(F.col(key).cast("string").alias("key"))
                  .agg(F.count(F.lit(1)).alias("n")).withColumn("profile", F.lit(name)))
    by_month = orders.withColumn("month", month_key("orderDate"))
    buyers = (by_month.groupBy(F.col("month").cast("string").alias("key"))
                      .agg(F.count_distinct("userId").alias("n"))
                      .withColumn("profile", F.lit("buyers_per_month")))
    return (prof(users, "users_per_segment", "segment")
            .unionByName(prof(users, "users_per_grade", "grade"))
            .unionByName(prof(products, "products_per_category", "cate"))
            .unionByName(prof(by_month, "lines_per_month", "month"))
            .unionByName(buyers))


def first_purchase_table(orders: DataFrame, comments: DataFrame, users: DataFrame,
                         products: DataFrame, cutoff: str) -> DataFrame:
    """Training rows for first-purchase prediction (L3).

    Label = first purchase in the cutoff month (month is part of the key,
    quirk Q11), one label order per pair; then each pre-cutoff order of the
    pair with its days-before-cutoff and its comment level. Joins are
    one-to-many on the pair (no pair explosion: the label side has one row).
    """
    start = F.lit(cutoff).cast("date")
    in_month = orders.filter((F.col("orderDate") >= start)
                             & (F.col("orderDate") < F.add_months(start, 1)))
    label = (in_month.groupBy(*PAIR)
                     .agg(F.min_by(F.struct("orderDate", "orderId"),
                                   F.struct("orderDate", "orderId")).alias("_l"))
                     .select(*PAIR, F.col("_l.orderId").alias("labelId"),
                             F.dayofmonth("_l.orderDate").alias("labelDay")))
    hist = (orders.filter(F.col("orderDate") < start)
                  .select(*PAIR, "orderId", days_before(cutoff, "orderDate").alias("daysFromBuy")))
    lvl = comments.select("orderId", "scoreLevel")
    return (label.join(products, "productId").join(users, "userId")
                 .join(hist, list(PAIR), "left")
                 .join(lvl, "orderId", "left"))


def pair_key():
    """One key per (user, product) pair for hashing."""
    return F.concat_ws("-", F.col("userId").cast("string"), F.col("productId").cast("string"))


def model_input(features: DataFrame, neg_fraction: float = 0.05,
                train_fraction: float = 0.8, salt: int = 0) -> DataFrame:
    """Model preparation (L4): an 80/20 split first; negatives of the training
    part are thinned to a repeatable share, the test part keeps every row;
    categorical columns are one-hot encoded, all are assembled, and the min-max
    scaler is fitted on the training part only.
    Returns (userId, productId, label, features, split)."""
    f = R.hash_split(features.withColumn("_key", pair_key()), "_key",
                     [train_fraction, 1 - train_fraction], salt + 1, "split")
    train = R.rebalance(f.filter(F.col("split") == 0), "label", "_key", neg_fraction, salt)
    cats = ["segment", "grade"]
    nums = [c for c in f.columns if c not in (*ID_COLS, "_key", "split", *cats)]
    stages = [OneHotEncoder(inputCols=cats, outputCols=[f"{c}_vec" for c in cats], dropLast=True,
                            handleInvalid="keep"),
              VectorAssembler(inputCols=nums + [f"{c}_vec" for c in cats], outputCol="raw",
                              handleInvalid="keep"),
              MinMaxScaler(inputCol="raw", outputCol="features")]
    fitted = Pipeline(stages=stages).fit(train)
    out = fitted.transform(train.unionByName(f.filter(F.col("split") == 1)))
    return out.select(*ID_COLS, "features", "split")


def load_train_test(train: DataFrame, test: DataFrame | None, key: str, features: str = "features",
                    test_fraction: float = 0.2, salt: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train and test parts (L9): the given test set, else a repeatable split of
    ``train`` by ``key``; and a report row per part (rows, vector width). A
    test vector of another width than the training vectors is an error."""
    if test is None:
        train, test = R.split_frames(train, key, [1 - test_fraction, test_fraction], salt)
    width = F.size(vector_to_array(features))
    sides = (train.select(F.lit("train").alias("part"), width.alias("w"))
             .union(test.select(F.lit("test").alias("part"), width.alias("w"))))
    report = sides.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("width"), F.max("w").alias("_most"))
    report = report.withColumn("width", F.when(F.col("width") == F.col("_most"), F.col("width")).otherwise(
        F.raise_error(F.concat(F.lit("mixed vector widths in "), F.col("part"))).cast("int"))).drop("_most")
    return train, test, report


def lookback_features(sales: DataFrame, item: str, week: str, qty: str,
                      target: int, steps: int) -> DataFrame:
    """Per item: cumulative look-back sums ending at ``target`` plus the
    next-week quantity as the regression label (L6)."""
    look = lookback_cumulative(sales, [item], week, qty, target, steps)
    nxt = (sales.filter(F.col(week) == target + 1).groupBy(item)
                .agg(F.sum(qty).cast("double").alias("next_qty")))
    return look.join(nxt, item, "left").na.fill(0.0, ["next_qty"])


def submission(scores: DataFrame, known_users: DataFrame, n: int,
               user: str = "user", score: str = "score", date: str = "date") -> DataFrame:
    """Ranked submission (S20, L7): one row per user (its best-scored row),
    only users present in ``known_users``, best first, exactly ``n`` rows
    (the limit is the feature)."""
    best = (scores.groupBy(user)
                  .agg(F.max_by(F.struct(score, date), F.struct(score, F.col(date))).alias("_b"))
                  .select(user, F.col(f"_b.{score}").alias(score), F.col(f"_b.{date}").alias(date)))
    known = best.join(known_users.select(user), user, "left_semi")
    return known.orderBy(F.col(score).desc(), F.col(user)).limit(n)
