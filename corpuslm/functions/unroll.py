"""One row per element of a computed array.

A plain explode or inline makes the optimizer add the filter "array is not empty" below it, which
computes the array, here the tokens of a whole text, a second time. The outer forms add none, and
the one empty row they leave for an empty array is dropped afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unroll(df: DataFrame, keys: list[str], tokens: Column, name: str) -> DataFrame:
    """(keys, name): an array of non-null values, one row each."""
    return df.select(*keys, F.explode_outer(tokens).alias(name)).where(F.col(name).isNotNull())


def unroll_structs(df: DataFrame, keys: list[str], structs: Column, first: str) -> DataFrame:
    """(keys, fields): an array of structs whose field `first` is never null, one row each."""
    return df.select(*keys, F.inline_outer(structs)).where(F.col(first).isNotNull())
