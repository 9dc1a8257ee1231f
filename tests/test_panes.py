import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartcast.session import scratch_path
from cartcast.streaming import panes as PN
from cartcast.streaming import runner as RN

BASE = 1_700_000_000


def arrivals(spark, slices):
    rows = [(BASE + t, k, float(v), i) for i, part in enumerate(slices) for t, k, v in part]
    df = spark.createDataFrame(rows, "sec long, k string, v double, part int").select(
        F.timestamp_seconds("sec").alias("ts"), "k", "v", "part")
    return RN.Arrivals(df, F.col("part"), "panes")


def stream(a):
    return a.stream().withWatermark("ts", "20 seconds")


def test_running_sums_equal_each_window():
    rng = np.random.default_rng(3)
    panes = np.unique(rng.integers(0, 60, 25))
    sums = rng.normal(size=(len(panes), 2))
    starts, got = PN.touched_windows(panes, sums, panes[-6:], 7)
    assert set(starts) == {p - i for p in panes[-6:].tolist() for i in range(7)}
    for s, v in zip(starts, got):
        assert np.allclose(v, sums[(panes >= s) & (panes < s + 7)].sum(axis=0))


def test_starts_are_listed_without_a_product():
    touched = np.unique(np.random.default_rng(5).integers(0, 900, 60))
    want = np.unique((touched[:, None] - np.arange(9)).ravel())
    assert (PN.window_starts(touched.copy(), 9) == want).all()
    # 300,000 panes of 300 windows each: 90 million pairs, but 300,299 windows
    tracemalloc.start()
    assert len(PN.window_starts(np.arange(300_000), 300)) == 300_299
    assert tracemalloc.get_traced_memory()[1] < 50 << 20
    tracemalloc.stop()


def test_a_key_is_dealt_over_slabs_of_time(spark):
    """One key over three days: its state and windows lie in many groups, and
    windows across the slabs' borders are whole."""
    times = list(range(0, 3 * 86400, 977)) + [8191, 8192, 8193, 16383, 16384]
    a = arrivals(spark, [[(t, "a", 1) for t in times]])
    ckpt = scratch_path(spark, "panes-ckpt")
    out = RN.run_to_table(PN.sliding_sums(stream(a), "ts", "k", ["v"], "1 hour", "2 seconds"), "update",
                          keys=["key", "start"], name="sliding", arrivals=a, checkpoint=ckpt).collect()
    got = {r["start"] // PN.MICROS - BASE: r["v"] for r in out}
    assert len(got) == len(out)
    assert got == {s - BASE: len(x) for s, x in windows([(BASE + t, "a") for t in times], 2, 3600).items()}
    state = spark.read.format("statestore").option("stateVarName", "panes").load(ckpt)
    assert state.schema["key"].dataType.names == ["key", "slab"]
    # three days are nine slabs
    assert 3 * 43200 // PN.slab_panes(2 * PN.MICROS, 1800) == 9


def windows(events, step, size):
    out = defaultdict(list)
    for t, *rest in events:
        s = t // step * step
        while s > t - size:
            out[s].append(rest)
            s -= step
    return out


def test_spans_cover_exactly_the_windows_of_the_times():
    rng = random.Random(1)
    for _ in range(50):
        times = [rng.randrange(200) for _ in range(rng.randrange(1, 12))]
        step, size = rng.choice([(2, 15), (5, 5), (3, 9)])
        spans = PN.covered(np.array(times), step, size)
        want = {s // step for s in windows([(t,) for t in times], step, size)}
        assert {x for a, b in spans for x in range(a, b + 1)} == want
        assert all(b1 + 1 < a2 for (_, b1), (a2, _) in zip(spans, spans[1:]))
    assert PN.uncovered((1, 10), [(0, 2), (4, 5), (9, 20)]) == [(3, 3), (6, 8)]


@pytest.fixture(scope="module")
def slices():
    rng = random.Random(7)
    out, t = [], 0
    for _ in range(4):  # out of order within a slice, in order between slices
        out.append([(t + rng.randrange(60), rng.choice("abc"), rng.randrange(9)) for _ in range(80)])
        t += 60
    return out


def test_sliding_sums_over_restarts(spark, slices):
    """Every slice is a restart on one checkpoint; late panes are in the state."""
    a = arrivals(spark, slices)
    rows = stream(a).withColumn("n", F.lit(1.0))
    out = RN.run_to_table(PN.sliding_sums(rows, "ts", "k", ["n", "v"], "30 seconds", "2 seconds"), "update",
                          keys=["key", "start"], name="sliding", arrivals=a).collect()
    got = {(r["key"], r["start"] // PN.MICROS - BASE): (r["n"], r["v"]) for r in out}
    want = {}
    for s, rows in windows([(BASE + t, k, v) for part in slices for t, k, v in part], 2, 30).items():
        for k in "abc":
            of = [v for x, v in rows if x == k]
            if of:
                want[k, s - BASE] = (len(of), sum(of))
    assert got == want


def test_state_holds_one_window_and_the_delay(spark, slices):
    a = arrivals(spark, slices)
    ckpt = scratch_path(spark, "panes-ckpt")
    rows = stream(a).withColumn("n", F.lit(1.0))
    RN.run_to_table(PN.sliding_sums(rows, "ts", "k", ["n"], "10 seconds", "2 seconds"), "update",
                    keys=["key", "start"], name="sliding", arrivals=a, checkpoint=ckpt)
    state = spark.read.format("statestore").option("stateVarName", "panes").load(ckpt)
    sizes = [r[0] for r in state.select(F.size("value.panes")).collect()]
    # a slice spans 60 seconds, the delay 20: panes of one slice, the delay and a window at most
    assert sizes and max(sizes) <= (60 + 20 + 10) // 2


def test_distinct_users_over_restarts(spark, slices):
    a = arrivals(spark, slices)
    changes = RN.run_to_table(PN.user_changes(stream(a), "ts", "k", "15 seconds", "2 seconds"), "append",
                              name="users", arrivals=a)
    got = {r["start"] // PN.MICROS: r["users"] for r in PN.users_by_window(changes.select("start", "change"), "2 seconds").collect()}
    held = windows([(BASE + t, k) for part in slices for t, k, _ in part], 2, 15)
    assert got == {s: len({k for k, in rows}) for s, rows in held.items()}
    assert sum(Counter(r["change"] for r in changes.collect()).get(x, 0) * x for x in (1, -1)) == 0


def test_wrong_windows():
    with pytest.raises(ValueError):
        PN.check_panes("10 seconds", "20 seconds")
    with pytest.raises(ValueError):
        PN.check_panes("15 seconds", "2 seconds")
    assert PN.check_panes("10 minutes", "2 seconds") == (2_000_000, 300)


def test_no_users(spark):
    empty = spark.createDataFrame([], "start long, change long")
    assert PN.users_by_window(empty, "2 seconds").count() == 0
