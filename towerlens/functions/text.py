"""Text enrichment for transcripts, as Column expressions.

The reference calls hosted language-model functions (summary, sentiment).
Here both are deterministic Column expressions that run on the executors:

* ``summarize(col, max_words)`` -- the leading sentence, cut to
  ``max_words`` words;
* ``sentiment(col)`` -- counts of lexicon words: positive / negative /
  mixed / neutral.

``model_udf`` wraps a user's vectorised model (``pandas.Series -> pandas.Series``)
as an Arrow-batched pandas UDF for when a real model is available.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from towerlens.functions.geo import _c, let

# Sentiment lexicon (lower-case words, English and French).
POSITIVE_WORDS = [
    "good", "great", "excellent", "thanks", "thank", "happy", "resolved", "helpful", "perfect", "fast",
    "love", "satisfied", "works", "fixed", "bien", "merci", "parfait", "excellent", "content", "super",
]
NEGATIVE_WORDS = [
    "bad", "poor", "slow", "angry", "cancel", "problem", "issue", "broken", "outage", "dropped",
    "complaint", "terrible", "worse", "never", "mauvais", "lent", "panne", "problème", "annuler", "jamais",
]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}']+", " ")), " "), lambda w: w != "")


def summarize(col, max_words: int = 10) -> Column:
    """Leading sentence of the text, at most ``max_words`` words."""
    first = F.regexp_extract(_c(col), r"^\s*([^.!?\n]*[.!?]?)", 1)
    return let(F.filter(F.split(F.trim(first), r"\s+"), lambda w: w != ""),
               lambda ws: F.array_join(F.slice(ws, 1, max_words), " "))


def lexicon_counts(col) -> Column:
    """struct(pos, neg): numbers of positive and negative lexicon words (additive over text pieces)."""
    pos = F.array(*[F.lit(w) for w in sorted(set(POSITIVE_WORDS))])
    neg = F.array(*[F.lit(w) for w in sorted(set(NEGATIVE_WORDS))])
    return let(_words(_c(col)), lambda ws: F.struct(
        F.size(F.filter(ws, lambda w: F.array_contains(pos, w))).alias("pos"),
        F.size(F.filter(ws, lambda w: F.array_contains(neg, w))).alias("neg")))


def sentiment_label(pos, neg) -> Column:
    p, n = _c(pos), _c(neg)
    return (F.when((p > 0) & (n > 0), F.lit("mixed")).when(p > 0, F.lit("positive"))
            .when(n > 0, F.lit("negative")).otherwise(F.lit("neutral")))


def sentiment(col) -> Column:
    """positive / negative / mixed / neutral by lexicon word counts."""
    return F.when(_c(col).isNotNull(), let(lexicon_counts(col), lambda c: sentiment_label(c["pos"], c["neg"])))


def model_udf(fn, return_type: str = "string"):
    """Wrap ``fn(pandas.Series) -> pandas.Series`` as an Arrow-batched pandas UDF."""
    return F.pandas_udf(fn, return_type)
