"""Word-frequency and language-model maps of one row, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it many times in `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_lengths(tokens: Column) -> Column:
    """array<struct<term, n>> of the distinct tokens, in term order.

    Equal tokens are adjacent once sorted, so a token's count is the distance between the start of
    its run and the start of the next one.
    """

    def with_sorted(words: Column) -> Column:
        size = F.size(words)
        positions = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(positions, lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))

        def with_starts(first: Column) -> Column:
            ends = F.concat(F.slice(first, 2, F.greatest(F.size(first), F.lit(1))), F.array(size))
            return F.zip_with(
                first,
                ends,
                lambda a, b: F.struct(F.get(words, a).alias("term"), (b - a).cast("bigint").alias("n")),
            )

        return F.when(size > 0, let(starts, with_starts)).otherwise(
            F.array().cast("array<struct<term:string,n:bigint>>")
        )

    return let(F.sort_array(tokens), with_sorted)


def word_freq(tokens: Column) -> Column:
    """map<string,double> from each distinct token to its count."""
    pairs = F.transform(
        run_lengths(tokens), lambda e: F.struct(e["term"].alias("key"), e["n"].cast("double").alias("value"))
    )
    return F.map_from_entries(pairs)


def unigram_lm(freq: Column) -> Column:
    """Divide every frequency by the sum of all frequencies of the map."""
    total = F.aggregate(F.map_values(freq), F.lit(0.0), lambda a, x: a + x)
    return let(total, lambda s: F.transform_values(freq, lambda _, n: n / s))
