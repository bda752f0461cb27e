"""Look-ups where the rows lie: what most rows ask for is sent to the tasks, and only the rest of a row's entries move.

Rows go through Arrow batches. A table's most frequent keys, as many as HEAD_BYTES hold, travel with the task; the others are met by a join.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslm.plans.skew import SPREAD

# Functions of this module travel to the executors whole, so these need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of the keys that travel with a task, and of a key besides its string; ranks that a doubling of an order is divided into.
HEAD_BYTES, ROW_BYTES, RANKS = 16 << 20, 16, 16
# Elements of lists that a task looks at together, or one row's.
ELEMENTS = 1 << 20


def slices(batch: pa.RecordBatch, column: int, most: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batch in pieces of at most `most` elements (ELEMENTS) of a column of lists, or one row, with the length of each list."""
    sizes = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start, most = np.cumsum(sizes), 0, most or ELEMENTS
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start), sizes[start:stop]
        start = stop


def counted(tokens: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, code, n, words): how often each row of a column of lists holds each of the words, by row."""
    coded = tokens.flatten().dictionary_encode()
    kinds = max(len(coded.dictionary), 1)
    key = np.repeat(np.arange(len(sizes)), sizes) * kinds + coded.indices.to_numpy(zero_copy_only=False)
    key, n = np.unique(key, return_counts=True)
    return key // kinds, key % kinds, n, coded.dictionary


def lists(row: np.ndarray, rows: int, fields: dict[str, pa.Array]) -> pa.Array:
    """One list of structs for each of the rows, from the fields of all entries by row."""
    ends = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))


def head_cut(table: DataFrame, rank: Column, term: str = "term", most: int = HEAD_BYTES, each: int = ROW_BYTES) -> int | None:
    """The greatest value of `rank`, a few whole numbers, of the rows of least rank that may travel with a task; None for no row.

    A row takes `each` bytes besides its string."""
    size = F.sum(F.octet_length(term) + F.lit(each)).alias("bytes")
    cut = None
    for r, n in sorted(map(tuple, table.groupBy(rank.alias("rank")).agg(size).collect())):
        most -= n
        if most < 0:
            break
        cut = r
    return cut


def met(df: DataFrame, id: str, entries: Column, split: Callable, found: str, rare: str, tail: DataFrame, on: str, value: Column) -> DataFrame:
    """(id, _entries): the entries of each id, found where its row lies or in the tail.

    `split` takes a column of lists and their lengths and returns two columns of lists: what it found, of type `found`, and what it did not,
    structs of type `rare`. Of the latter only those whose column `on` is in the tail have an entry, `value`. Rows of equal id are added up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sizes in slices(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), *split(part.column(1), sizes)], names=["id", "found", "rare"])

    kind = df.schema[id].dataType.simpleString()
    rows = df.select(F.col(id).alias("id"), entries.alias("entries"))
    rows = rows.mapInArrow(run, f"id {kind}, found array<{found}>, rare array<{rare}>")
    # a row with what was found, and one for each entry that was not
    first = F.array(F.struct("found", F.lit(None).cast(rare).alias("rare")))
    others = F.transform("rare", lambda r: F.struct(F.lit(None).cast(f"array<{found}>").alias("found"), r.alias("rare")))
    rows = rows.select("id", F.inline(F.concat(first, others))).select("id", "found", "rare.*")
    spread = F.when(F.col(on).isNull(), F.pmod(F.xxhash64("id"), F.lit(SPREAD)).cast("int") + 1).otherwise(0)
    tail = tail.withColumnRenamed(on, "_key").withColumn("_at", F.lit(0))
    rows = rows.withColumn("_spread", spread).join(tail, (F.col(on) == F.col("_key")) & (F.col("_spread") == F.col("_at")), "left")
    own = F.when(F.col("_key").isNotNull(), value)
    rows = rows.select("id", F.coalesce("found", F.array_compact(F.array(own))).alias("found"))
    return rows.groupBy("id").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("_entries")).withColumnRenamed("id", id)
