"""Term counting: per post, per class, over the corpus; vocabulary; ML vectors."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslm.functions.frequency import run_lengths, word_freq
from corpuslm.functions.text import word_tokens
from corpuslm.functions.unroll import unroll, unroll_structs
from corpuslm.operators import heads
from corpuslm.operators.prep import labelled_only
from corpuslm.plans.numbering import number_rows
from corpuslm.plans.shared import materialize
from corpuslm.plans.skew import lookup_join

# Functions of this module travel to the executors whole, so these need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Ranges of a histogram that is brought to the driver.
HISTOGRAM = 1_024


def term_counts(posts: DataFrame, id: str, tokens: Column) -> DataFrame:
    """(id, term, n). A post is one row, so its counts are made in place, without a shuffle."""
    return unroll_structs(posts, [id], run_lengths(tokens), "term")


def word_freq_maps(posts: DataFrame, id: str, tokens: Column) -> DataFrame:
    """(id, words_freq): the count of each distinct token of a post."""
    return posts.select(id, word_freq(tokens).alias("words_freq"))


def label_terms(posts: DataFrame, label: str = "flair", text: str = "text") -> DataFrame:
    """(label, word, n): word counts of all text of a class.

    Counting post by post equals counting the joined text, as posts are joined by a word separator.
    Counts are combined before the shuffle, so neither a large class nor a common word is moved whole.
    """
    words = unroll(labelled_only(posts, label), [label], word_tokens(F.col(text)), "word")
    return words.groupBy(label, "word").agg(F.count("*").alias("n"))


def vocabulary(posts: DataFrame, tokens: Column, size: int | None = None) -> DataFrame:
    """(term, n, df, term_index): terms by falling count, equal counts by term.

    All terms are numbered; a size keeps the top ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sizes in heads.slices(batch, 0):
                _, code, n, words = heads.counted(part.column(0), sizes)
                total, posts_of = np.bincount(code, n, len(words)).astype(np.int64), np.bincount(code, minlength=len(words))
                yield pa.RecordBatch.from_arrays([words, pa.array(total), pa.array(posts_of)], names=["term", "n", "df"])

    counts = posts.select(tokens.alias("tokens")).mapInArrow(run, "term string, n bigint, df bigint")
    counts = counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    return rank_terms(counts, size)


def rank_terms(counts: DataFrame, size: int | None = None) -> DataFrame:
    """Add term_index to (term, n, ...), by falling n and then by term; with a size, keep the first ones.

    A vocabulary is too long for a top-k, which would merge that many rows of every task in one. With a size the count
    of the last term is found first, and only terms that reach it are numbered: the wanted ones and those that tie with the last.
    """
    order = [F.desc("n"), F.asc("term")]
    if size is None:
        return number_rows(counts, order, "term_index")
    counts = materialize(counts, "term-counts")
    cut = least_count(counts, size)
    reached = counts.where(F.col("n") >= cut) if cut is not None else counts
    return number_rows(reached, order, "term_index").where(F.col("term_index") < size)


def least_count(counts: DataFrame, size: int, ranges: int = HISTOGRAM) -> int | None:
    """The greatest n that at least `size` rows of (n, ...) reach, or None where there are fewer rows.

    A histogram of at most `ranges` ranges of n tells in which of them that count lies; the next one splits that range, until it
    holds a single count. So the driver sees a bounded number of sums, however long the table or great the counts are.
    """
    low, high, total = counts.agg(F.min("n"), F.max("n"), F.count("*")).first()
    if size <= 0 or total < size:
        return None if size > 0 else high + 1 if high is not None else None
    above = 0  # rows beyond the range
    while low < high:
        width = -(-(high - low + 1) // ranges)
        place = F.floor((F.col("n") - low) / width).alias("place")
        inside = counts.where(F.col("n").between(low, high)).groupBy(place).agg(F.count("*").alias("rows"))
        for place, rows in sorted(map(tuple, inside.collect()), reverse=True):
            if above + rows >= size:
                low, high = low + place * width, min(high, low + (place + 1) * width - 1)
                break
            above += rows
    return low


def count_vectors(posts: DataFrame, id: str, tokens: Column, vocabulary: DataFrame, output: str = "words_features") -> DataFrame:
    """(id, output struct<size, indices, values>): sparse term counts of each post, as ML vectors have them.

    `vocabulary` is one of vocabulary(). Indices rise; terms outside the vocabulary count nowhere, and a
    post without any has an empty vector. A vector is bounded by its post; the vocabulary is joined and never
    brought to the driver.
    """
    index = materialize(vocabulary.select("term", F.col("n").alias("_weight"), "term_index"), "vocabulary")
    rank = -F.floor(F.log2("_weight") * heads.RANKS)
    cut = heads.head_cut(index, rank)
    in_head = F.lit(False) if cut is None else F.coalesce(rank <= cut, F.lit(False))
    head = index.where(in_head).select("term", "term_index").toArrow().combine_chunks()
    known, places = head["term"].combine_chunks(), head["term_index"].combine_chunks()

    def split(lists: pa.Array, sizes: np.ndarray) -> list[pa.Array]:
        row, code, n, words = heads.counted(lists, sizes)
        at = pc.index_in(words, value_set=known).take(pa.array(code))
        here, n = at.is_valid().to_numpy(zero_copy_only=False), pa.array(n.astype(float))
        own, others = pa.array(here), pa.array(~here)
        return [
            heads.lists(row[here], len(sizes), {"term_index": places.take(at.filter(own)), "n": n.filter(own)}),
            heads.lists(row[~here], len(sizes), {"term": words.take(pa.array(code[~here])), "n": n.filter(others)}),
        ]

    entry = F.struct("term_index", "n")
    found, rare = "struct<term_index:bigint,n:double>", "struct<term:string,n:double>"
    rows = heads.met(posts, id, tokens, split, found, rare, index.where(~in_head).select("term", "term_index"), "term", entry)
    vector = F.struct(
        F.lit(index.count()).cast("bigint").alias("size"),
        F.transform("_entries", lambda e: e["term_index"].cast("bigint")).alias("indices"),
        F.transform("_entries", lambda e: e["n"]).alias("values"),
    )
    return rows.select(id, vector.alias(output))


def label_vectors(counts: DataFrame, label: str, vocabulary: DataFrame) -> DataFrame:
    """(label, term_index, n): the vector of each class in rows, from (label, word, n) counts.

    A class may have every term of the corpus, so its vector is not gathered in one cell. The
    background's vector is the vocabulary's own (term_index, n).
    """
    index = vocabulary.select(F.col("term").alias("word"), F.col("n").alias("_weight"), "term_index")
    index = materialize(index, "vocabulary")
    placed = lookup_join(counts, index, ["word"], "_weight", ["term_index"], spread_by=label)
    return placed.where("term_index IS NOT NULL").select(label, "term_index", "n")
