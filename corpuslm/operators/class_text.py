"""The text of a class, and of the whole corpus, as relations.

The text of a class is its posts joined by one space, in id order. It is kept as ordered parts and
never put into one cell: counts, lengths and words of the joined text all add up over the parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.functions.text import or_empty, word_tokens
from corpuslm.operators.prep import labelled_only


def label_text(posts: DataFrame, id: str, label: str = "flair", text: str = "text") -> DataFrame:
    """(label, id, text): the parts of each class's text; id gives their order."""
    return labelled_only(posts, label).select(label, id, or_empty(F.col(text)).alias(text))


def _joined(text: str) -> list:
    return [
        F.count("*").alias("n_posts"),
        (F.sum(F.length(or_empty(F.col(text)))) + F.count("*") - 1).alias("n_chars"),
        F.sum(F.size(word_tokens(F.col(text)))).alias("n_words"),
    ]


def label_text_sizes(posts: DataFrame, label: str = "flair", text: str = "text") -> DataFrame:
    """(label, n_posts, n_chars, n_words) of the joined text of each class."""
    return labelled_only(posts, label).groupBy(label).agg(*_joined(text))


def background_text(posts: DataFrame, label: str = "flair", text: str = "text") -> DataFrame:
    """(n_posts, n_chars, n_words) of the joined text of all classes."""
    return labelled_only(posts, label).agg(*_joined(text))
