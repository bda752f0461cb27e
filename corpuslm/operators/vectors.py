"""Sparse and dense ML vectors to rows and word maps, and back, without a dense array."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslm.operators import heads
from corpuslm.plans.shared import new_path

# Functions of this module travel to the executors whole, so these need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: how a vector's stored form says that it lists its indices.
SPARSE = 0


def vector_entries(vector: str | Column) -> Column:
    """array<struct<term_index int, n double>> of the non-zero entries of an ML vector, by index; null of a null one.

    A sparse vector costs what it holds, however large its size is.
    """
    raw = F.unwrap_udt(vector)
    listed = F.arrays_zip(raw["indices"].alias("term_index"), raw["values"].alias("n"))
    placed = F.transform(raw["values"], lambda n, i: F.struct(i.alias("term_index"), n.alias("n")))
    return F.filter(F.when(raw["type"] == SPARSE, listed).otherwise(placed), lambda e: e["n"] != 0)


def vector_rows(df: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, term_index int, n double): one row per non-zero entry; an empty or null vector has none."""
    return df.select(id, F.inline(vector_entries(vector)))


def ml_vectors(df: DataFrame, vector: str) -> DataFrame:
    """df with the struct<size, indices, values> of terms.count_vectors() as sparse ML vectors, null as null.

    Only the stored form is made here; the rows are written and read again with the vectors' type. An ML vector numbers its
    places by 32 bits, so a vocabulary has fewer than 2^31 terms, or the job fails.
    """
    whole = F.when(
        F.col(vector).isNotNull(),
        F.struct(
            F.lit(SPARSE).cast("tinyint").alias("type"),
            F.expr(f"int(`{vector}`.size)").alias("size"),
            F.transform(f"{vector}.indices", lambda i: i.cast("int")).alias("indices"),
            F.col(f"{vector}.values").alias("values"),
        ),
    )
    path = new_path(df.sparkSession, "ml-vectors")
    df.withColumn(vector, whole).write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT()) if f.name == vector else f for f in df.schema]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def vector_word_freq(df: DataFrame, id: str, vector: str, vocabulary: DataFrame, output: str = "words_freq") -> DataFrame:
    """(id, output map<string,double>): each word of a vector with its value. `id` is unique.

    `vocabulary` has (term, term_index) and may be of any length; it is joined, and the entries of common words are spread.
    A vector without entries, or null, has an empty map. An index that the vocabulary lacks names no word and is left out.
    """
    table = vocabulary.select("term", F.col("term_index").cast("int").alias("term_index"))
    rank = F.floor(F.log2(F.col("term_index") + 1) * heads.RANKS)
    cut = heads.head_cut(table, rank)
    in_head = F.lit(False) if cut is None else F.coalesce(rank <= cut, F.lit(False))
    head = table.where(in_head).toArrow().combine_chunks()
    known, words = head["term_index"].to_numpy(), head["term"].combine_chunks()
    place = np.full(int(known.max()) + 1 if len(known) else 1, -1)
    place[known] = np.arange(len(known))

    def split(entries: pa.Array, sizes: np.ndarray) -> list[pa.Array]:
        flat, row = entries.flatten(), np.repeat(np.arange(len(sizes)), sizes)
        index, n = flat.field(0).to_numpy(), flat.field(1)
        at = np.where(index < len(place), place[np.minimum(index, len(place) - 1)], -1)
        here = at >= 0
        own, others = pa.array(here), pa.array(~here)
        return [
            heads.lists(row[here], len(sizes), {"key": words.take(pa.array(at[here])), "value": n.filter(own)}),
            heads.lists(row[~here], len(sizes), {"term_index": pa.array(index[~here], pa.int32()), "n": n.filter(others)}),
        ]

    entry = F.struct(F.col("term").alias("key"), F.col("n").alias("value"))
    found, rare = "struct<key:string,value:double>", "struct<term_index:int,n:double>"
    named = heads.met(df, id, vector_entries(vector), split, found, rare, table.where(~in_head), "term_index", entry)
    return named.select(id, F.map_from_entries("_entries").alias(output))
