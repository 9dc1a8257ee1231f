"""Stream transforms (T1–T19). Each is a plain DataFrame → DataFrame
function, so the same code runs on a batch frame (checked against SQL) and
on a streaming frame (checked against the batch result)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split lines into words (flatMap, F5)."""
    return lines.select(F.explode(F.split(F.col(col), " ")).alias("word"))


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """Running word count (T1): partial + final aggregate per word."""
    return words(lines, col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def with_event_time(df: DataFrame, ts: str = "ts", watermark: str | None = None) -> DataFrame:
    """Event time as TIMESTAMP (watermarks reject TIMESTAMP_NTZ), with an
    optional watermark so window state is evicted once closed."""
    out = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return out.withWatermark(ts, watermark) if watermark else out


def check_slide(length: str, slide: str | None) -> str:
    """Slide defaults to the window length; a slide longer than the window is
    an error (quirk Q13)."""
    if slide is None:
        return length
    to_sec = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}

    def secs(s: str) -> int:
        n, unit = s.split()
        return int(n) * to_sec[unit.rstrip("s")]
    if secs(slide) > secs(length):
        raise ValueError(f"slide {slide} is longer than window {length}")
    return slide


def windowed_counts(df: DataFrame, ts: str, length: str, slide: str | None = None,
                    keys: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """Tumbling (slide = length) or sliding window counts per key.
    With ``value`` the window also sums it (T7)."""
    w = F.window(F.col(ts), length, check_slide(length, slide))
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(value).alias("total"))
    return df.groupBy(w.alias("w"), *keys).agg(*aggs)


def error_rate(views: DataFrame, ts: str, length: str, slide: str,
               threshold: float = 0.05, key: str = "zip") -> DataFrame:
    """Share of non-200 statuses per key (zip code by default) and window,
    with the report line ``"<key>: <ratio>"``, the ratio starred when above
    ``threshold`` (T9, F16). The ratio is rounded to 4 places."""
    w = F.window(F.col(ts), length, check_slide(length, slide))
    g = views.groupBy(w.alias("w"), key).agg(
        F.round(F.avg(F.when(F.col("status") != 200, 1.0).otherwise(0.0)), 4).alias("error_rate"))
    return with_error_line(g, key, threshold)


def with_error_line(df: DataFrame, key: str = "zip", threshold: float = 0.05) -> DataFrame:
    """Report line ``"<key>: <ratio>"``, starred above the threshold."""
    k, r = F.col(key).cast("string"), F.col("error_rate").cast("string")
    return df.withColumn("line", F.when(F.col("error_rate") > threshold,
                                        F.format_string("%s: **%s**", k, r))
                                  .otherwise(F.format_string("%s: %s", k, r)))


def window_users(views: DataFrame, ts: str, length: str, slide: str) -> DataFrame:
    """Views per window and user: one small state row each, spread over the
    state partitions, however many users a window has."""
    return windowed_counts(views, ts, length, slide, ["user"])


def active_users(pairs: DataFrame) -> DataFrame:
    """Distinct users per window (T10) from one row per window and user."""
    return pairs.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("users"))


def grep_count(lines: DataFrame, needle: str, col: str = "value") -> DataFrame:
    """Number of lines containing ``needle``."""
    return lines.filter(F.col(col).contains(needle)).groupBy().agg(F.count(F.lit(1)).alias("n"))


def drop_stopwords(word_rows: DataFrame, stop: DataFrame, col: str = "word") -> DataFrame:
    """Left-anti join against a stop-word table (T16). The stop list is a
    fixed small list, so broadcasting it is bounded by construction."""
    return word_rows.join(F.broadcast(stop), col, "left_anti")


def stopword_counts(word_rows: DataFrame, stop: DataFrame, col: str = "word") -> DataFrame:
    """Kept and dropped rows in one pass (T16): counts per kept word, and one
    row with a null word that counts the rows dropped."""
    marked = word_rows.join(F.broadcast(stop.select(col, F.lit(True).alias("stop"))), col, "left")
    word = F.when(F.col("stop").isNull(), F.col(col))
    return (marked.groupBy(word.alias(col), F.col("stop").isNotNull().alias("dropped"))
            .agg(F.count(F.lit(1)).alias("count")))


def modulo_counts(df: DataFrame, col: str, m: int = 10) -> DataFrame:
    return df.groupBy((F.col(col) % m).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def window_bounds(c: str = "w") -> list[Column]:
    """Window struct → NTZ start/end columns for comparison with SQL."""
    return [F.col(f"{c}.start").cast("timestamp_ntz").alias("window_start"),
            F.col(f"{c}.end").cast("timestamp_ntz").alias("window_end")]


# The dashboard's metric names.
DASHBOARD_METRICS = ("pageCounts", "slidingPageCounts", "errorRatePerZipCode",
                     "activeUserCount", "popularUsersSeen")


def dashboard(views: DataFrame, metric: str, users: DataFrame | None = None,
              ts: str = "ts") -> DataFrame:
    """Click-stream dashboard (L8): one of five metrics selected by name.

    ``views`` has (ts, url, status, zip, user); ``users`` (user, name) is the
    static table for ``popularUsersSeen``. ``activeUserCount`` gives one row
    per window and user, which :func:`active_users` counts.
    """
    if metric == "pageCounts":
        return views.groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    if metric == "slidingPageCounts":
        return windowed_counts(views, ts, "10 seconds", "2 seconds", ["url"])
    if metric == "errorRatePerZipCode":
        return error_rate(views, ts, "30 seconds", "2 seconds")
    if metric == "activeUserCount":
        return window_users(views, ts, "15 seconds", "2 seconds")
    if metric == "popularUsersSeen":
        if users is None:
            raise ValueError("popularUsersSeen needs a users table")
        seen = views.select(ts, "user").join(users, "user").select(ts, "user", "name")
        if seen.isStreaming:  # state is dropped as the watermark passes
            return seen.dropDuplicatesWithinWatermark(["user"]).select("user", "name")
        return seen.select("user", "name").dropDuplicates(["user"])
    raise ValueError(f"invalid metric {metric!r}; one of {DASHBOARD_METRICS}")
