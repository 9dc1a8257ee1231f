"""Text record parsers: strings in a column to typed columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_trim_cast(c, sep: str, types: list[tuple[str, str]]) -> list[Column]:
    """Split a delimited string, trim each field and cast it.

    ``try_cast`` keeps dirty fields as null instead of failing the job.
    """
    parts = F.split(_col(c), sep)
    return [F.trim(parts.getItem(i)).try_cast(t).alias(name)
            for i, (name, t) in enumerate(types)]


def parse_dense_points(df: DataFrame, col: str = "value") -> DataFrame:
    """``label,f1 f2 ...`` → (label double, features vector)."""
    head = F.split(F.col(col), ",", 2)
    feats = F.transform(F.split(F.trim(head.getItem(1)), r"\s+"), lambda x: x.cast("double"))
    return df.select(head.getItem(0).cast("double").alias("label"),
                     array_to_vector(feats).alias("features"))


def parse_ratings(df: DataFrame, col: str = "value", sep: str = "::",
                  with_ts: bool = True):
    """``user SEP item SEP rating [SEP ts]`` → typed ratings, plus rejected lines.

    Returns ``(good, rejected)``; a line is rejected when its field count is
    wrong or a field does not parse.
    """
    import re
    parts = F.split(F.col(col), re.escape(sep))
    n = 4 if with_ts else 3
    cols = [parts.getItem(0).try_cast("int").alias("user"),
            parts.getItem(1).try_cast("int").alias("item"),
            parts.getItem(2).try_cast("float").alias("rating")]
    if with_ts:
        cols.append(parts.getItem(3).try_cast("long").alias("ts"))
    parsed = df.select(F.col(col), F.size(parts).alias("_n"), *cols)
    ok = (F.col("_n") == n)
    names = ["user", "item", "rating"] + (["ts"] if with_ts else [])
    for name in names:
        ok = ok & F.col(name).isNotNull()
    flagged = parsed.withColumn("_ok", ok)
    good = flagged.filter("_ok").select(*names)
    bad = flagged.filter(~F.col("_ok")).select(col)
    return good, bad


def parse_pageviews(df: DataFrame, col: str = "value") -> DataFrame:
    """Tab-separated ``url status zip user``."""
    p = F.split(F.col(col), "\t")
    return df.select(p.getItem(0).alias("url"),
                     p.getItem(1).try_cast("int").alias("status"),
                     p.getItem(2).try_cast("int").alias("zip"),
                     p.getItem(3).try_cast("int").alias("user"))


def format_pageview(url, status, zipc, user) -> Column:
    return F.concat_ws("\t", _col(url), _col(status).cast("string"),
                       _col(zipc).cast("string"), _col(user).cast("string"))


def parse_bracket_vector(c) -> Column:
    """``[x1, x2, ...]`` → array<double>."""
    inner = F.regexp_extract(_col(c), r"\[([^\]]*)\]", 1)
    return F.transform(F.split(inner, r"\s*,\s*"), lambda x: F.trim(x).cast("double"))


def parse_labeled_vectors(df: DataFrame, col: str = "value") -> DataFrame:
    """``(y, [x1, x2, ...])`` → (label, features)."""
    label = F.regexp_extract(F.col(col), r"^\(\s*([^,\s]+)\s*,", 1).cast("double")
    return df.select(label.alias("label"),
                     array_to_vector(parse_bracket_vector(col)).alias("features"))
