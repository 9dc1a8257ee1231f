"""Quality rules as weak supervision.

Ten rules read a text and vote 1 (good), 0 (bad) or abstain (-1). Nothing is
labelled: expectation-maximisation estimates, for each class, how often every
rule votes each way, and the class prior; a text is kept when its posterior
probability of being good is at least one half and the base rules pass.

Votes form at most ``3 ** len(RULES)`` distinct patterns, so the corpus is
reduced to pattern counts by one hash aggregate and EM runs on those counts:
every document weighs in, and what the driver holds does not grow with the
corpus. The per-document scalars are saved once to the shared scratch folder,
so texts are read a single time.

Defined edge cases: a null or wordless text has no words, fails the base rules
and is not kept; repeated rows are each judged; a posterior of exactly one half
keeps the text; a very long text is measured whole, in one task; an empty table
gives an empty result; a null ``doc_id`` is passed through; further columns are
not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, arrow_rows, give_back, keyed_text, saved

SYMBOLS = re.compile(r"[#*$%&|<>]")
RULES = ("symbols", "dup_lines", "repeats", "capitals", "shouting",
         "word_length", "variety", "letters", "length", "tables")

STATS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                   ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                   ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
                   ("votes", pa.int64())])
STATS_DDL = ("doc_id long, n_words long, word_chars long, n_symbols long, "
             "n_dup_lines long, n_repeat_words long, votes long")


def repeated_words(words: list[str]) -> int:
    """Words covered by a three-word window that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    total, covered = 0, 0  # covered: end of what is already counted
    for i, w in enumerate(windows):
        if seen[w] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def _vote(value: float, bad_from: float, good_to: float) -> int:
    """Bad at or above ``bad_from``, good at or below ``good_to``."""
    return 0 if value >= bad_from else 1 if value <= good_to else -1


def measure(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, votes)."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    word_chars = sum(map(len, words))
    n_symbols = len(SYMBOLS.findall(text))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    if n == 0:
        return 0, 0, n_symbols, 0, 0, pattern([-1] * len(RULES))
    upper = sum(1 for w in words if len(w) > 1 and w.isupper()) / n
    letters = sum(map(str.isalpha, text))
    votes = [
        _vote(n_symbols / n, 0.1, 0.02),
        -1 if len(lines) < 2 else _vote(dup_lines / len(lines), 0.5, 0.05),
        _vote(repeats / n, 0.5, 0.1),
        _vote(upper, 0.5, 0.1),
        _vote(text.count("!") / n, 0.3, 0.05),
        _vote(abs(word_chars / n - 6.5), 5.0, 3.0),
        -1 if n < 20 else _vote(1 - len(set(words)) / n, 0.8, 0.6),
        _vote(1 - letters / max(word_chars, 1), 0.3, 0.15),
        _vote(-n, -25, -50),
        _vote(sum(1 for w in words if w == "|") / n, 0.1, 0.0),
    ]
    return n, word_chars, n_symbols, dup_lines, repeats, pattern(votes)


def pattern(votes: list[int]) -> int:
    out = 0
    for v in votes:
        out = out * 3 + (v + 1)
    return out


def unpack(code: int, n_rules: int = len(RULES)) -> list[int]:
    out = []
    for _ in range(n_rules):
        out.append(code % 3 - 1)
        code //= 3
    return out[::-1]


def text_statistics(docs: DataFrame) -> DataFrame:
    """Per document: the base counts and the rules' vote pattern."""
    def run(batches):
        give_back()
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            yield arrow_rows(STATS, [(i, *measure(t)) for i, t in zip(ids, texts)])
    return keyed_text(docs).mapInArrow(run, STATS_DDL)


def fit_votes(counts: dict[int, int], n_rules: int = len(RULES), rounds: int = 60,
              prior: float = 0.9, good_passes: float = 0.99, bad_passes: float = 0.6,
              strength: float = 10.0) -> dict[int, float]:
    """EM over vote patterns: pattern -> posterior probability of good.

    Both classes have their own vote rates per rule (abstentions carry no
    evidence). EM starts from good texts passing a rule they are judged by
    with ``good_passes`` and bad texts with ``bad_passes``: a bad text breaks
    a few rules, seldom most of them. ``strength`` pseudo-votes at these rates
    keep the classes from swapping names and rates off 0 and 1. Deterministic.
    """
    codes = sorted(counts)
    if not codes:
        return {}
    weight = np.array([counts[c] for c in codes], float)
    votes = np.array([unpack(c, n_rules) for c in codes])
    good, bad = (votes == 1).astype(float), (votes == 0).astype(float)
    # P(vote good | class) for the good and the bad class
    p_good = np.full(n_rules, good_passes)
    p_bad = np.full(n_rules, bad_passes)
    share = prior
    post = np.zeros(len(codes))
    for _ in range(rounds):
        l1 = np.log(share) + good @ np.log(p_good) + bad @ np.log1p(-p_good)
        l0 = np.log1p(-share) + good @ np.log(p_bad) + bad @ np.log1p(-p_bad)
        post = 1 / (1 + np.exp(np.clip(l0 - l1, -700, 700)))
        w1, w0 = weight * post, weight * (1 - post)
        p_good = ((w1 @ good + strength * good_passes) / (w1 @ (good + bad) + strength)).clip(1e-6, 1 - 1e-6)
        p_bad = ((w0 @ good + strength * bad_passes) / (w0 @ (good + bad) + strength)).clip(1e-6, 1 - 1e-6)
        share = float(((w1.sum() + strength * prior) / (weight.sum() + strength)).clip(1e-6, 1 - 1e-6))
    return dict(zip(codes, post.tolist()))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Base counts, ``base_failed``, ``quality`` (posterior) and ``kept``."""
    spark = docs.sparkSession
    stats = saved(text_statistics(docs), "quality-stats")
    # at most 3 ** len(RULES) rows
    counts = {r["votes"]: r["n"] for r in stats.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior = spark.createDataFrame(sorted(fit_votes(counts).items()), "votes long, quality double")
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (stats.join(F.broadcast(posterior), "votes")
            .withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept", "quality", "votes"))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that the rules keep.

    Texts are read twice, once for the vote patterns and once to judge by
    their posteriors, and never shuffled.
    """
    votes = text_statistics(docs.withColumn("doc_id", F.lit(0))).groupBy("votes").agg(F.count("*").alias("n"))
    posterior = fit_votes({r["votes"]: r["n"] for r in votes.collect()})  # at most 3 ** len(RULES) rows
    at = docs.columns.index("text")

    def run(batches):
        give_back()
        for b in batches:
            judged = [measure(t) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([not base_failed(m[0], m[4]) and posterior[m[5]] >= 0.5 for m in judged], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import documents, prepare
    prepare(spark)
    return quality_rules(documents(spark, sf_dir)).drop("votes")
