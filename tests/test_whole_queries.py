"""Queries that score every row, sparse term counts, the stored feature table."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartcast.operators import recommend as RC
from cartcast.session import scratch_path
from cartcast.suite import q_mlfeatures as QF
from cartcast.suite import q_models as QM

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def embeddings(spark):
    x = np.random.default_rng(2).normal(size=(150, 64))
    folder = scratch_path(spark, "tables")
    rows = spark.createDataFrame([(i, i % 10, v.tolist()) for i, v in enumerate(x)], "vec_id long, label int, embedding array<float>")
    rows.write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.mark.parametrize("query", [QM.linear_svc, QM.gbt_classify])
def test_every_row_is_scored(spark, embeddings, query):
    got = query(spark, embeddings).collect()
    assert sorted(r["vec_id"] for r in got) == list(range(150))
    assert all(r["beats_majority"] for r in got)


def test_l2_join_takes_every_row(spark):
    """All ordered pairs within the distance count, whatever their ids."""
    x = (np.random.default_rng(7).normal(size=(80, 64)) * 0.42).astype(np.float32)
    folder = scratch_path(spark, "tables")
    rows = [(50 * i + 1, i % 10, v.tolist()) for i, v in enumerate(x)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    gaps = np.linalg.norm(x[:, None].astype(float) - x[None], axis=2)
    want = int((gaps < QM._L2_RADIUS).sum()) - 80
    got = QM.lsh_l2_join(spark, folder).first()
    assert 1000 < want < 80 * 79 and (got["exact"], got["within"]) == (want, True)


def test_jaccard_join_takes_every_set(spark):
    """All ordered pairs of classes count, also where no document's id 50 divides."""
    folder = scratch_path(spark, "tables")
    rows = [(50 * i + 1, " ".join(f"t{i // 4}x{j}" for j in range(12 + i % 4))) for i in range(40)] + [(3, ""), (4, "t0x0")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = QM.lsh_jaccard_join(spark, folder).first()
    assert (got["exact"], got["within"]) == (10 * 4 * 3, True)


def test_term_counts_stay_sparse(spark):
    folder = scratch_path(spark, "tables")
    texts = ["a b b c", "", "x " * 500]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    out = QF.hashing_tf(spark, folder)
    assert "array_position" not in out._jdf.queryExecution().analyzed().toString()
    got = {r["doc_id"]: (r["total"], r["terms_ok"]) for r in out.collect()}
    assert got[0] == (4.0, True) and got[1] == (0.0, True) and got[2] == (500.0, True)


def test_model_input_reads_a_stored_table(spark):
    plan = QM._purchase_input(spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_scores_of_few_users_are_held_at_a_time():
    rng = np.random.default_rng(4)
    x, y, ids = rng.normal(size=(5000, 5)), rng.normal(size=(4096, 5)), np.arange(4096)
    tracemalloc.start()
    items, scores = RC._best(x, [[]] * 5000, [[]] * 5000, ids, y, 3)
    assert tracemalloc.get_traced_memory()[1] < 40 << 20  # all scores: 160 MB
    tracemalloc.stop()
    for i in (0, 255, 256, 4999):
        assert items[i] == np.argsort(-(y @ x[i]))[:3].tolist()
        assert scores[i] == pytest.approx(np.sort(y @ x[i])[:-4:-1].tolist())


def test_stored_ratings_are_not_computed_again(spark):
    plan = QM._stored_ratings(QM.Tables(spark, SF_SMALL))._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan and "Aggregate" not in plan


class Fitted(Exception):
    """Raised instead of fitting; holds what was to be fitted."""


def fitted(monkeypatch, name, query, spark, folder):
    class Estimator:
        def __init__(self, **options):
            pass

        def fit(self, d):
            raise Fitted(d)
    monkeypatch.setattr(QM, name, Estimator)
    with pytest.raises(Fitted) as e:
        query(spark, folder)
    return e.value.args[0]


@pytest.fixture(scope="module")
def texts(spark):
    folder = scratch_path(spark, "tables")
    rows = [(i, f"le mot{i % 7} b{i} b{i} c") for i in range(60)] + [(60, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return folder


def test_perplexity_keeps_vectors_alone(spark, texts, monkeypatch):
    train = fitted(monkeypatch, "LDA", QM.lda_perplexity, spark, texts)
    assert train.columns == ["features"]
    assert train.agg(F.sum(QM._term_total())).first()[0] == 4 * train.where(QM._term_total() > 0).count()
    spark.catalog.clearCache()


def test_em_corpus_is_stored_in_bounded_parts(spark, texts, monkeypatch):
    monkeypatch.setattr(QM, "_EM_EDGES", 3)
    corpus = fitted(monkeypatch, "LDA", QM.lda_em, spark, texts)
    assert corpus.columns == ["features"] and not corpus.is_cached
    assert corpus.rdd.getNumPartitions() == 60  # 60 texts of three terms


def test_em_corpus_keeps_its_order(spark, monkeypatch):
    """Documents of a part come in stored order, so that a part read again numbers
    them as before."""
    folder = scratch_path(spark, "tables")
    rows = [(i, "w " * (i + 1)) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    corpus = fitted(monkeypatch, "LDA", QM.lda_em, spark, folder)
    parts = corpus.select(QM._term_total().alias("n")).rdd.glom().collect()
    counts = [[r["n"] for r in p] for p in parts]
    assert sorted(sum(counts, [])) == list(range(1, 301)) and all(p == sorted(p) for p in counts)


def test_tree_rows_are_dealt_into_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(QM, "_TREE_ROWS", 50)
    d = fitted(monkeypatch, "GBTRegressor", QM.gbt_regress, spark, SF_SMALL)
    n = d.count()
    sizes = [r["count"] for r in d.groupBy(F.spark_partition_id()).count().collect()]
    assert n > 1000 and max(sizes) <= 60
