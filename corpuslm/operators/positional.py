"""The positional look-up: the i-th counted slot of a group gets the i-th word of the vocabulary.

It reproduces how the published figures were made, where the terms of a post, or of a class, are
replaced by the first k words of the vocabulary, k being the group's number of distinct terms. The
look-up by term is the correct one; this is for comparison with results made the other way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslm.plans.numbering import number_rows
from corpuslm.plans.shared import materialize
from corpuslm.plans.sizes import BROADCAST_BYTES
from corpuslm.plans.skew import lookup_join


def number_within(df: DataFrame, key: str, order: list[Column], name: str) -> DataFrame:
    """Add `name`: 0, 1, 2, ... among the rows of each key, in the given order (which must be total within a key).

    All rows are numbered by key and order over range partitions, and a key's first number is taken off. So a
    key that holds any share of the rows is ranked by as many tasks as hold that share.
    """
    numbered = number_rows(df, [F.asc(key), *order], "_all")
    numbered = materialize(numbered, "numbered-within")
    starts = numbered.groupBy(key).agg(F.min("_all").alias("_start"), F.count("*").alias("_rows"))
    found = lookup_join(numbered, starts, [key], "_rows", ["_start"], spread_by="_all")
    return found.select(*df.columns, (F.col("_all") - F.col("_start")).alias(name))


def positional(
    counts: DataFrame, key: str, vocabulary: DataFrame, term: str = "term", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(key, term, n) counts with their terms replaced; terms outside the vocabulary are dropped.

    `vocabulary` has (term, term_index). A key may have any number of terms, up to all of them. A null key is a key.
    """
    index = materialize(vocabulary.select(F.col("term").alias(term), "term_index"), "vocabulary")
    size = index.agg(F.coalesce(F.sum(F.octet_length(term) + 64), F.lit(0))).first()[0]
    fits = size <= broadcast_bytes
    if fits:
        ranked = counts.join(F.broadcast(index), term)
    else:
        weighed = counts.groupBy(term).agg(F.count("*").alias("_rows")).join(index, term)
        ranked = lookup_join(counts, weighed, [term], "_rows", ["term_index"], spread_by=key)
        ranked = ranked.where("term_index IS NOT NULL")
    placed = number_within(ranked.select(key, "n", "term_index"), key, [F.asc("term_index")], "_place")
    placed = placed.select(key, "n", F.col("_place").alias("term_index"))
    return _named(placed, index, key, term, fits).select(key, term, "n")


def first_words(
    posts: DataFrame, key: str, tokens: Column, vocabulary: DataFrame, term: str = "term", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(key, term): the first k words of the vocabulary for each post, k being its number of distinct tokens.

    The same terms as positional() gives for the posts' own counts, where the vocabulary has all their tokens: which these
    are then makes no difference, so they are counted within the row and not looked up. Posts without tokens have no row.
    """
    sizes = posts.select(key, distinct_tokens(tokens).alias("_k"))
    return words_before(sizes, key, "_k", vocabulary, term, broadcast_bytes)


def distinct_tokens(tokens: Column) -> Column:
    """How many words of the vocabulary a post gets."""
    return F.size(F.array_distinct(tokens)).cast("bigint")


def words_before(
    sizes: DataFrame, key: str, size: str, vocabulary: DataFrame, term: str = "term", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(key, term): the first words of the vocabulary for each row, as many as its `size` says. Rows of size 0 have none."""
    index = materialize(vocabulary.select(F.col("term").alias(term), "term_index"), "vocabulary")
    bytes_ = index.agg(F.coalesce(F.sum(F.octet_length(term) + 64), F.lit(0))).first()[0]
    sizes = sizes.where(F.col(size) > 0)
    places = sizes.select(key, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(size) - 1)).alias("term_index"))
    return _named(places, index, key, term, bytes_ <= broadcast_bytes).select(key, term)


def _named(placed: DataFrame, index: DataFrame, key: str, term: str, fits: bool) -> DataFrame:
    """Add the word of each term_index. The first words are those of nearly all keys, hence hot."""
    if fits:
        return placed.join(F.broadcast(index), "term_index")
    placed = materialize(placed, "placed")
    weighed = placed.groupBy("term_index").agg(F.count("*").alias("_rows")).join(index, "term_index")
    return lookup_join(placed, weighed, ["term_index"], "_rows", [term], spread_by=key)
