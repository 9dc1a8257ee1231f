"""Sliding windows from panes: each event is kept once.

:func:`sliding_sums` keeps, per key, sums by pane (a span of the slide's width).
The sum of a window is the sum of the window before it plus the pane that enters
minus the pane that leaves, carried as running sums over the panes in order; a
batch emits the windows that its panes touch. Panes leave the state when the
watermark has passed their last window, and a timer clears a key that gets no
more rows, so a key's state is the panes of one window and the delay. Time is cut
into slabs of panes: a slab owns the windows that start in it and gets the rows
of their panes (those of the first ``k - 1`` panes of a slab also go to the one
before), so few keys still make many groups, and a group holds one slab of panes
and windows, however many rows or days a batch has.

:func:`user_changes` keeps, per user, the spans of window starts in which the
user is active, merged. A batch emits +1 where a newly covered span starts and
-1 after its end; the distinct users of a window are the running sum of the
changes up to its start (:func:`users_by_window`).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MICROS = 1_000_000


def micros(text: str) -> int:
    """``"10 minutes"`` as microseconds."""
    n, unit = text.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * MICROS


def check_panes(length: str, slide: str) -> tuple[int, int]:
    """(slide, panes of a window); a slide longer than the window, or one that
    does not divide it, is an error."""
    size, step = micros(length), micros(slide)
    if step > size:
        raise ValueError(f"slide {slide} is longer than window {length}")
    if size % step:
        raise ValueError(f"window {length} is not made of whole slides of {slide}")
    return step, size // step


def slab_panes(step: int, k: int) -> int:
    """Panes of a slab: a day's, between 8 ``k`` (an eighth of the rows, at most,
    goes to two slabs) and 4,096 (or 8 ``k`` where that is more)."""
    return max(8 * k, min(4096, -(-86400 * MICROS // step)))


def merged_panes(old: np.ndarray, old_sums: np.ndarray, new: np.ndarray, new_sums: np.ndarray):
    """Panes in order with summed values."""
    every = np.concatenate([old, new])
    panes, at = np.unique(every, return_inverse=True)
    sums = np.zeros((len(panes), old_sums.shape[1]))
    np.add.at(sums, at, np.concatenate([old_sums, new_sums]))
    return panes, sums


def window_starts(touched: np.ndarray, k: int) -> np.ndarray:
    """First panes of the windows of ``k`` panes that hold any of the touched
    panes (in order, distinct): of each pane those after the pane before it."""
    first = touched - (k - 1)
    first[1:] = np.maximum(first[1:], touched[:-1] + 1)
    n = touched - first + 1
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def touched_windows(panes: np.ndarray, sums: np.ndarray, touched: np.ndarray, k: int):
    """First pane and sums of every window of ``k`` panes that holds a touched
    pane. Running sums in pane order: a window is what has entered by its end
    minus what has left by its start."""
    starts = window_starts(touched, k)
    entered = np.concatenate([np.zeros((1, sums.shape[1])), np.cumsum(sums, axis=0)])
    return starts, entered[np.searchsorted(panes, starts + k)] - entered[np.searchsorted(panes, starts)]


class SlidingSums(StatefulProcessor):
    """Keys are (key, slab); only windows that start in the slab are emitted."""

    def __init__(self, step: int, k: int, measures: Sequence[str], slab: int):
        self.step, self.k, self.measures, self.slab = step, k, list(measures), slab

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", "panes array<bigint>, sums array<double>")

    def _held(self):
        if not self.state.exists():
            return np.zeros(0, np.int64), np.zeros((0, len(self.measures)))
        panes, sums = self.state.get()
        return np.array(panes, np.int64), np.array(sums, float).reshape(len(panes), -1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        panes, sums = self._held()
        touched = []
        for pdf in rows:
            by = pdf.groupby("pane")[self.measures].sum()
            if len(by):
                new = by.index.to_numpy(np.int64)
                touched.append(new)
                panes, sums = merged_panes(panes, sums, new, by.to_numpy(float))
        # panes whose last window the watermark has passed
        passed = timerValues.getCurrentWatermarkInMs() * 1000 // self.step
        if touched:
            starts, values = touched_windows(panes, sums, np.unique(np.concatenate(touched)), self.k)
            own = starts // self.slab == key[1]
            starts, values = starts[own], values[own]
            for i in range(0, len(starts), 50_000):
                out = pd.DataFrame(values[i:i + 50_000], columns=self.measures)
                out.insert(0, "start", starts[i:i + 50_000] * self.step)
                out.insert(0, "key", str(key[0]))
                yield out
        keep = panes + self.k > passed
        panes, sums = panes[keep], sums[keep]
        if len(panes):
            self.state.update((panes.tolist(), sums.ravel().tolist()))
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int((panes[-1] + self.k + 1) * self.step // 1000))
        elif self.state.exists():
            self.state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield pd.DataFrame({"key": pd.Series([], dtype=str), "start": pd.Series([], dtype="int64"),
                            **{m: pd.Series([], dtype=float) for m in self.measures}})

    def close(self) -> None:
        pass


def _by_value() -> None:
    # processors run in a Python runner that may not see shipped files
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _rocks(df: DataFrame) -> None:
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass",
                             "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def sliding_sums(rows: DataFrame, ts: str, key: str, measures: Sequence[str], length: str, slide: str) -> DataFrame:
    """``key, start`` (microseconds) and the sums of ``measures`` of each window
    that a batch touches, in update fashion: the latest row of a window holds.
    ``rows`` has a watermark on ``ts``; ``key`` is returned as text."""
    step, k = check_panes(length, slide)
    slab = slab_panes(step, k)
    _by_value()
    _rocks(rows)
    pane = F.floor(F.unix_micros(ts) / step).cast("long")
    narrow = rows.select(ts, F.col(key).cast("string").alias("key"), pane.alias("pane"),
                         *[F.col(m).cast("double").alias(m) for m in measures])
    slabs = F.array_distinct(F.array(*[F.floor((F.col("pane") - back) / slab).cast("long") for back in (k - 1, 0)]))
    narrow = narrow.withColumn("slab", F.explode(slabs))
    return narrow.groupBy("key", "slab").transformWithStateInPandas(
        statefulProcessor=SlidingSums(step, k, measures, slab), outputMode="Update", timeMode="EventTime",
        outputStructType="key string, start long, " + ", ".join(f"{m} double" for m in measures))


# -- distinct users --------------------------------------------------------------
def covered(times: np.ndarray, step: int, size: int) -> list[tuple[int, int]]:
    """Merged spans [first, last] of window starts (in steps) that hold any of
    the times: starts s with s step <= t < s step + size."""
    last = times // step
    first = (times - size) // step + 1
    spans: list[list[int]] = []
    for a, b in sorted(set(zip(first.tolist(), last.tolist()))):
        if spans and a <= spans[-1][1] + 1:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    return [(a, b) for a, b in spans]


def uncovered(span: tuple[int, int], held: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts of a span that no held span covers."""
    parts, a = [], span[0]
    for x, y in held:
        if y < a:
            continue
        if x > span[1]:
            break
        if x > a:
            parts.append((a, x - 1))
        a = max(a, y + 1)
    if a <= span[1]:
        parts.append((a, span[1]))
    return parts


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


class UserSpans(StatefulProcessor):
    def __init__(self, step: int, size: int):
        self.step, self.size = step, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("spans", "edges array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, int]] = []
        if self.state.exists():
            edges = list(self.state.get()[0])
            held = list(zip(edges[::2], edges[1::2]))
        starts, signs = [], []
        for pdf in rows:
            new = []
            for span in covered(pdf["micros"].to_numpy(np.int64), self.step, self.size):
                for a, b in uncovered(span, held):
                    starts += [a, b + 1]
                    signs += [1, -1]
                    new.append((a, b))
            held = joined(held + new)
        yield pd.DataFrame({"start": np.array(starts, np.int64) * self.step, "change": np.array(signs, np.int64)})
        # spans whose last window the watermark has passed get no more rows
        passed = (timerValues.getCurrentWatermarkInMs() * 1000 - self.size) // self.step
        held = [s for s in held if s[1] >= passed]
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if held:
            self.state.update(([x for s in held for x in s],))
            self.handle.registerTimer(int(((held[-1][1] + 1) * self.step + self.size) // 1000) + 1)
        elif self.state.exists():
            self.state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield pd.DataFrame({"start": pd.Series([], dtype="int64"), "change": pd.Series([], dtype="int64")})

    def close(self) -> None:
        pass


def user_changes(views: DataFrame, ts: str, user: str, length: str, slide: str) -> DataFrame:
    """``start`` (microseconds), ``change``: where users become active or cease
    to be. ``views`` has a watermark on ``ts``; the window need not be a whole
    number of slides. Append mode: each change is emitted once."""
    step, size = micros(slide), micros(length)
    if step > size:
        raise ValueError(f"slide {slide} is longer than window {length}")
    _by_value()
    _rocks(views)
    narrow = views.select(ts, F.col(user).cast("string").alias("user"), F.unix_micros(ts).alias("micros"))
    return narrow.groupBy("user").transformWithStateInPandas(
        statefulProcessor=UserSpans(step, size), outputMode="Append", timeMode="EventTime",
        outputStructType="start long, change long")


def users_by_window(changes: DataFrame, slide: str) -> DataFrame:
    """``start, users`` of every window with users: the running sum of the
    changes, summed per start first, over the starts up to the next change. The
    order is global, by ranges of starts (no window over all rows in one task)."""
    from ..operators.relational import global_running_sums
    step = micros(slide)
    by = changes.groupBy("start").agg(F.sum("change").alias("change")).where("change <> 0")
    if by.isEmpty():
        return by.select("start", F.col("change").alias("users"))
    running, _ = global_running_sums(by, "start", {"change": "users"})
    # the next change: a window per day of starts, and the first of a later day for its last
    day = F.floor(F.col("start") / (86400 * MICROS))
    rows = running.withColumn("day", day)
    firsts = rows.groupBy("day").agg(F.min("start").alias("first_start"))
    firsts = firsts.withColumn("next_day", F.lead("first_start").over(Window.orderBy("day")))  # a row per day
    inner = rows.withColumn("next", F.lead("start").over(Window.partitionBy("day").orderBy("start")))
    spans = inner.join(firsts.select("day", "next_day"), "day").withColumn("next", F.coalesce("next", "next_day"))
    return spans.where("users > 0").select(
        F.explode(F.sequence("start", F.col("next") - step, F.lit(step))).alias("start"), "users")
