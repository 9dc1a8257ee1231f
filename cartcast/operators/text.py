"""Text feature helpers shared by the token queries."""

from __future__ import annotations

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame

# Custom stop words added to the default English list.
CUSTOM_STOPWORDS = ["le", "la", "les", "de", "des", "du", "un", "une", "et", "en"]


def regex_tokens(df: DataFrame, text: str = "text", out: str = "tokens",
                 pattern: str = r"\W") -> DataFrame:
    """Lower-cased tokens split on non-word characters, empty tokens dropped."""
    return RegexTokenizer(inputCol=text, outputCol=out, pattern=pattern,
                          minTokenLength=1).transform(df)


def remove_stopwords(df: DataFrame, tokens: str = "tokens", out: str = "words",
                     extra: list[str] | None = None, default: bool = True) -> DataFrame:
    words = list(extra or [])
    if default:
        words = StopWordsRemover.loadDefaultStopWords("english") + words
    return StopWordsRemover(inputCol=tokens, outputCol=out, stopWords=words).transform(df)
