"""Model factories and training helpers (M*): Spark ML estimators on tables.

Inputs are DataFrames of (label, features); nothing is collected except
fitted parameters. Frames reused by several fits are cached by the caller
and released after.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from .boosting import SoftmaxBoosting, SoftmaxModel


class PurchaseDayModel:
    """A fitted multi-class model; ``transform`` adds ``prediction`` and the
    array ``probabilities`` (one per class, adding up to one)."""

    def __init__(self, apply):
        self.transform = apply


class PurchaseDayClassifier:
    """Multi-class purchase-day model (M1).

    ``forest``: a random forest. ``boosted``: softmax boosting over 32 classes
    (depth 7, 7 rounds, step 0.1, lambda 2, gamma 0.1, child weight 5, 0.8 of the
    columns per tree, zero as the missing value), see ``operators.boosting``.
    """

    def __init__(self, kind: str = "forest", num_trees: int = 10, max_depth: int = 5, rounds: int = 7,
                 boosted_depth: int = 7, seed: int = 7):
        if kind not in ("forest", "boosted"):
            raise ValueError(kind)
        self.kind, self.num_trees, self.max_depth, self.seed = kind, num_trees, max_depth, seed
        self.rounds, self.boosted_depth = rounds, boosted_depth

    def fit(self, train: DataFrame) -> PurchaseDayModel | SoftmaxModel:
        if self.kind == "forest":
            model = RandomForestClassifier(numTrees=self.num_trees, maxDepth=self.max_depth, seed=self.seed).fit(train)
            return PurchaseDayModel(lambda df: model.transform(df).withColumn(
                "probabilities", vector_to_array("probability")))
        model = SoftmaxBoosting(classes=32, rounds=self.rounds, depth=self.boosted_depth, seed=self.seed).fit(train)
        return model


def purchase_day_classifier(kind: str = "forest", **options) -> PurchaseDayClassifier:
    return PurchaseDayClassifier(kind, **options)


def prefix_span(sequences: DataFrame, min_support: float, max_length: int,
                col: str = "sequence") -> DataFrame:
    """Spark's PrefixSpan over a column of sequences (array<array<item>>).

    Its input holds each sequence as one row, so use it where sequences are
    bounded (e.g. sessions or fixed periods); for whole-history supports of
    single items use a distinct (entity, item) aggregate instead.
    """
    from pyspark.ml.fpm import PrefixSpan
    ps = PrefixSpan(minSupport=min_support, maxPatternLength=max_length, sequenceCol=col)
    return ps.findFrequentSequentialPatterns(sequences)
