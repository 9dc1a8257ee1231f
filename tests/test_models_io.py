"""Param-map overrides (M28), model persistence (M32), file sink append
(T17), schema inspection (P19), dashboard selection (L8)."""

import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cartcast.session import scratch_path
from cartcast.streaming import runner as RN
from cartcast.streaming import transforms as ST

from .conftest import SF_SMALL


@pytest.fixture
def points(spark):
    rows = [(0.0, Vectors.dense([0.0, 1.1, 0.1])), (1.0, Vectors.dense([2.0, 1.0, -1.0])),
            (0.0, Vectors.dense([2.0, 1.3, 1.0])), (1.0, Vectors.dense([0.0, 1.2, -0.5]))]
    return spark.createDataFrame(rows, ["label", "features"])


def test_param_map_override(points):
    lr = LogisticRegression(maxIter=10, regParam=0.01)
    m1 = lr.fit(points)
    m2 = lr.fit(points, {lr.maxIter: 30, lr.regParam: 0.1, lr.probabilityCol: "p"})
    assert m2.getOrDefault("regParam") == 0.1 and m1.getOrDefault("regParam") == 0.01
    assert "p" in m2.transform(points).columns
    n = Normalizer(inputCol="features", outputCol="n", p=1.0)
    out = n.transform(points, {n.p: float("inf")}).first().n
    assert max(abs(x) for x in out) == pytest.approx(1.0)


def test_model_save_load(spark, points):
    m = LogisticRegression(maxIter=5).fit(points)
    path = scratch_path(spark, "lr-model")
    m.write().overwrite().save(path)
    back = LogisticRegressionModel.load(path)
    assert list(back.coefficients) == pytest.approx(list(m.coefficients))
    km = KMeans(k=2, seed=1).fit(points)
    kp = scratch_path(spark, "km-model")
    km.save(kp)
    assert len(KMeansModel.load(kp).clusterCenters()) == 2


def test_append_file_sink(spark):
    """Per-batch text appended to files, exactly once per batch."""
    src = scratch_path(spark, "t17-src")
    spark.createDataFrame([("a b",), ("c",)], "value string").write.parquet(src)
    s = RN.read_stream(spark, src, "value string")
    out, ckpt = scratch_path(spark, "t17-out"), scratch_path(spark, "t17-ckpt")
    q = (ST.words(s).writeStream.format("text").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["a", "b", "c"]


def test_schema_inspection(spark):
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    names = [f.name for f in df.schema.fields]
    assert names == ["event_id", "ts", "user_id", "event_type", "value", "props"]
    assert df.schema["ts"].dataType.typeName() == "timestamp_ntz"
    assert "event_id" in df._jdf.schema().treeString()


def test_dashboard_metric_names(spark):
    v = spark.createDataFrame([(1, "/a", 200, 1)], "user long, url string, status int, zip int")
    assert ST.dashboard(v, "pageCounts").first().n == 1
    with pytest.raises(ValueError):
        ST.dashboard(v, "nope")


def test_prefix_span_helper(spark):
    from cartcast.operators.models import prefix_span
    seqs = spark.createDataFrame([([[1, 2], [3]],), ([[1], [3, 2], [1, 2]],), ([[1, 2], [5]],), ([[6]],)],
                                 "sequence array<array<int>>")
    got = {str(r.sequence): r.freq for r in prefix_span(seqs, 0.5, 5).collect()}
    assert got["[[1]]"] == 3 and got["[[1, 2]]"] == 3 and got["[[1], [3]]"] == 2


def test_boosted_purchase_days_have_class_probabilities(spark):
    import random

    from cartcast.operators.models import purchase_day_classifier
    rng = random.Random(1)
    rows = [(float(c), Vectors.dense([c + rng.random() / 2, rng.random()])) for c in (0, 3, 17) for _ in range(40)]
    df = spark.createDataFrame(rows, ["label", "features"])
    for kind in ("forest", "boosted"):
        out = purchase_day_classifier(kind).fit(df).transform(df).collect()
        assert all(abs(sum(r.probabilities) - 1) < 1e-9 for r in out)
        assert sum(r.prediction == r.label for r in out) > 110
    one = spark.createDataFrame(rows[:5], ["label", "features"])
    assert {r.prediction for r in purchase_day_classifier("boosted").fit(one).transform(one).collect()} == {0.0}
    with pytest.raises(ValueError):
        purchase_day_classifier("other")


def test_given_test_set_and_width_report(spark):
    from cartcast.plans.jobs import load_train_test
    train = spark.createDataFrame([(i, Vectors.dense([1.0, 2.0])) for i in range(50)], ["k", "features"])
    test = spark.createDataFrame([(99, Vectors.dense([1.0, 2.0]))], ["k", "features"])
    _, given, report = load_train_test(train, test, "k")
    assert {(r.part, r.n, r.width) for r in report.collect()} == {("train", 50, 2), ("test", 1, 2)}
    assert given.first().k == 99
    a, b, _ = load_train_test(train, None, "k")
    assert a.count() + b.count() == 50 and 0 < b.count() < 25
    odd = test.union(spark.createDataFrame([(98, Vectors.dense([1.0]))], ["k", "features"]))
    with pytest.raises(Exception, match="mixed vector widths"):
        load_train_test(train, odd, "k")[2].collect()
