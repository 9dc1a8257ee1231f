"""Exact quantiles by histogram refinement.

One pass counts the values by equal ranges and keeps each range's smallest and
largest value; the range that holds a wanted rank is cut again in the next pass,
until it holds a single value. A pass brings at most ``probabilities x ranges``
rows to the driver, whatever the table's size, and no value list is ever
gathered or merged.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, col: str, probabilities: Sequence[float], ranges: int = 1024) -> list[float | None]:
    """For each probability the smallest value whose share of rows up to it is
    at least that (nulls and NaN are left out; no rows: None)."""
    x = df.select(F.col(col).cast("double").alias("v")).where("v is not null and not isnan(v)")
    r = x.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not r["n"]:
        return [None] * len(probabilities)
    # open searches: probability index -> (range, wanted rank within it, from 1)
    rank = [min(max(math.ceil(p * r["n"] - 1e-9), 1), r["n"]) for p in probabilities]
    found: list[float | None] = [None] * len(rank)
    searches = {i: (r["lo"], r["hi"], k) for i, k in enumerate(rank)}
    while True:
        for i, (lo, hi, k) in list(searches.items()):
            if lo == hi:
                found[i] = lo
                del searches[i]
        if not searches:
            return found
        spans = sorted({(lo, hi) for lo, hi, _ in searches.values()})
        v, label = F.col("v"), F.lit(None).cast("long")
        for s, (lo, hi) in reversed(list(enumerate(spans))):
            at = _cut(lo, hi, ranges)
            label = F.when(v.between(lo, hi), F.lit(s * ranges) + at).otherwise(label)
        rows = (x.withColumn("at", label).where("at is not null").groupBy("at")
                .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("at").collect())
        for i, (lo, hi, k) in searches.items():
            s = spans.index((lo, hi))
            for row in rows:
                if row["at"] // ranges == s:
                    if k <= row["n"]:
                        searches[i] = (row["lo"], row["hi"], k)
                        break
                    k -= row["n"]


def _cut(lo: float, hi: float, ranges: int):
    """Number of the equal range of a value. Where the width is not finite or
    too small to divide by, values are cut at the middle."""
    width = (hi - lo) / ranges
    if not math.isfinite(width) or lo + width == lo or width == 0:
        middle = lo / 2 + hi / 2
        return F.when(F.col("v") <= middle, 0).otherwise(1).cast("long")
    return F.least(F.floor((F.col("v") - lo) / width), F.lit(ranges - 1)).cast("long")


def quantile_splits(df: DataFrame, col: str, buckets: int) -> list[float]:
    """Splits of a bucketiser with ``buckets`` quantile buckets (fewer where
    quantiles are equal)."""
    inner = exact_quantiles(df, col, [i / buckets for i in range(1, buckets)])
    return [float("-inf"), *sorted({q for q in inner if q is not None}), float("inf")]
