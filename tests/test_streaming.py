"""Stream = batch, checkpoint recovery, slide checks."""

import pytest
from pyspark.sql import functions as F

from cartcast.session import scratch_path
from cartcast.streaming import runner as RN
from cartcast.streaming import transforms as ST


def _lines(spark):
    return spark.createDataFrame([("a b a",), ("b c",), ("a",)], "value string")


def test_stream_equals_batch(spark):
    lines = _lines(spark)
    parts = RN.Arrivals(lines, F.when(F.col("value").startswith("a"), 0).otherwise(1))
    assert parts.slices == [0, 1]
    streamed = {r.word: r["count"] for r in RN.run_to_table(ST.word_count(parts.stream()), "update", keys=["word"],
                                                            arrivals=parts).collect()}
    batch = {r.word: r["count"] for r in ST.word_count(lines).collect()}
    assert streamed == batch == {"a": 3, "b": 2, "c": 1}


def test_restart_from_checkpoint_no_double_count(spark):
    src = scratch_path(spark, "t-src")
    ckpt = scratch_path(spark, "t-ckpt")
    spark.createDataFrame([("x y",)], "value string").write.parquet(src, mode="append")
    s = RN.read_stream(spark, src, "value string")
    first = RN.run_to_table(ST.word_count(s), "complete", checkpoint=ckpt).collect()
    assert {r.word: r["count"] for r in first} == {"x": 1, "y": 1}
    spark.createDataFrame([("x",)], "value string").write.parquet(src, mode="append")
    s2 = RN.read_stream(spark, src, "value string")
    second = RN.run_to_table(ST.word_count(s2), "complete", checkpoint=ckpt).collect()
    assert {r.word: r["count"] for r in second} == {"x": 2, "y": 1}


def test_slide_longer_than_window_rejected():
    with pytest.raises(ValueError):
        ST.check_slide("10 seconds", "20 seconds")
    assert ST.check_slide("10 seconds", None) == "10 seconds"


def test_watermark_drops_late_row(spark):
    import datetime as dt
    src = scratch_path(spark, "t-late")
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    spark.createDataFrame([(t0,), (t0 + dt.timedelta(hours=3),)], "ts timestamp_ntz").write.parquet(src, mode="append")
    s = RN.read_stream(spark, src, "ts timestamp_ntz", files_per_trigger=1)
    g = ST.windowed_counts(ST.with_event_time(s, "ts", "10 minutes"), "ts", "1 hour")
    g = g.select(*ST.window_bounds(), "n")
    ckpt = scratch_path(spark, "t-late-ckpt")
    RN.run_to_table(g, "update", keys=["window_start", "window_end"], checkpoint=ckpt)
    # a row 2 h older than the watermark arrives in a later batch: dropped
    spark.createDataFrame([(t0 + dt.timedelta(minutes=5),)], "ts timestamp_ntz").write.parquet(src, mode="append")
    s2 = RN.read_stream(spark, src, "ts timestamp_ntz", files_per_trigger=1)
    g2 = ST.windowed_counts(ST.with_event_time(s2, "ts", "10 minutes"), "ts", "1 hour").select(*ST.window_bounds(), "n")
    out = RN.run_to_table(g2, "update", keys=["window_start", "window_end"], checkpoint=ckpt)
    got = {r.window_start.hour: r.n for r in out.collect()}
    assert got.get(10) is None


def test_student_t_p_value():
    from cartcast.streaming.online import student_t_two_sided_p
    assert student_t_two_sided_p(2.228138851986, 10) == pytest.approx(0.05, abs=1e-6)
    assert student_t_two_sided_p(0.0, 5) == pytest.approx(1.0, abs=1e-9)


def _model_query(spark, arrivals, model, ckpt):
    return lambda: (arrivals.stream().writeStream.foreachBatch(lambda b, bid: model.update(b, bid))
                    .option("checkpointLocation", f"{ckpt}/query").trigger(availableNow=True).start())


def test_streaming_welch_stops_the_query(spark):
    from cartcast.streaming.online import ModelStore, StreamingWelch
    rows = [(s, g, float(i % 3) + (10.0 if g == "b" else 0.0)) for s in range(3) for g in "ab" for i in range(60)]
    parts = RN.Arrivals(spark.createDataFrame(rows, "s int, g string, v double"), F.col("s"))
    ckpt = scratch_path(spark, "t-welch")
    w = StreamingWelch("g", "v", "a", "b", store=ModelStore(spark, f"{ckpt}/model"))
    RN.drain(_model_query(spark, parts, w, ckpt), parts, w.done)
    assert w.done() and len(w.history) == 1 and w.history[0][3] < 0.05
    # the other slices were not delivered, hence not consumed
    assert spark.read.option("recursiveFileLookup", "true").schema(parts.schema).parquet(parts.folder).count() == 120


def test_streaming_model_survives_a_restart(spark):
    from cartcast.streaming.online import ModelStore, StreamingKMeans, StreamingSGD
    rows = [(s, [float(s), float(i % 7)], float(3 * s + i % 7)) for s in range(3) for i in range(50)]
    df = spark.createDataFrame(rows, "s int, x array<double>, y double")

    def run(make_model, restart):
        parts = RN.Arrivals(df, F.col("s"))
        ckpt = scratch_path(spark, "t-model")
        model = make_model(ModelStore(spark, f"{ckpt}/model"))
        for i in parts.slices:
            if restart:  # a new driver: only the checkpoint folder is left
                model = make_model(ModelStore(spark, f"{ckpt}/model"))
            parts.deliver(i)
            RN.drain(_model_query(spark, parts, model, ckpt))
        model.update(df.filter("s = 2"), 2)  # a replayed batch changes nothing
        return model
    for make_model in (lambda st: StreamingKMeans([[0.0, 0.0], [2.0, 5.0]], store=st),
                       lambda st: StreamingSGD(2, 0.05, iterations=20, store=st)):
        a, b = run(make_model, False), run(make_model, True)
        if hasattr(a, "centers"):
            assert a.centers == b.centers and a.weights == b.weights and sum(a.weights) == 150
        else:
            assert a.w == b.w and any(a.w)
