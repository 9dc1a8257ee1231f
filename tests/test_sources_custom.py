"""Connector option builders, custom ML stages, oracle smoke at sf0.001."""

import duckdb
import pytest

from cartcast.operators.custom import MeanCenterer, ShiftBy
from cartcast.session import scratch_path
from cartcast.sources.connectors import jdbc_options, kafka_options

from .conftest import SF_SMALL


def test_jdbc_options():
    o = jdbc_options("jdbc:postgresql:db", "schema.t", user="u", password="p",
                     partition_column="id", lower_bound=1, upper_bound=100, num_partitions=4)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_kafka_options():
    o = kafka_options("h:9092", subscribe="t1,t2")
    assert o["subscribe"] == "t1,t2"
    with pytest.raises(ValueError):
        kafka_options("h:9092", subscribe="a", assign='{"a":[0]}')


def test_shiftby_roundtrip(spark):
    st = ShiftBy(2.0).setInputCol("x").setOutputCol("y")
    path = scratch_path(spark, "shift")
    st.save(path)
    got = ShiftBy.load(path).transform(spark.createDataFrame([(1.0,)], "x double")).first().y
    assert got == 3.0


def test_mean_centerer(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    m = MeanCenterer(inputCol="x", outputCol="c").fit(df)
    assert sorted(r.c for r in m.transform(df).collect()) == [-1.0, 1.0]


@pytest.mark.parametrize("name", ["purchase_features", "horizon_scores", "stratified_exact",
                                  "binary_threshold_metrics", "stream_tumbling", "tf_idf"])
def test_oracle_small(spark, name):
    from __spark_entry__ import oracle_sql, queries
    from cartcast.tables import TABLES
    from tools.check_oracle import rows_of
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    df = queries()[name](spark, SF_SMALL)
    res = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, res.fetchall())
