"""What the operators of this package share: Arrow batches of bounded size, row keys, written tables."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslm.plans.shared import materialize

# Functions of this package travel to the executors whole, so these need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules["corpuslm.llm"])

# Text that a Python worker holds at a time; one longer text is a batch of its own.
BATCH_BYTES = 2 << 20
# An Arrow batch on its way to a Python worker; the default of 64 MB is held several times over by each task.
ARROW_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let no Arrow batch between the JVM and Python take more than ARROW_BYTES, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def short_lived_shuffles(spark: SparkSession) -> None:
    """Let shuffle files go when the query that made them ends, and not when the driver next collects its garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def slices(batch: pa.RecordBatch, column: int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most `most` bytes in the given string column, or one row."""
    start, held = 0, 0
    for row, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
        if held and held + (n or 0) > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def bounded(texts: list[str], most: int = BATCH_BYTES) -> Iterator[list[str]]:
    """The texts in lists of at most `most` characters, or one text."""
    part, held = [], 0
    for t in texts:
        if part and held + len(t) > most:
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t)
    if part:
        yield part


def map_texts(
    df: DataFrame, keep: list[Column], text: Column, make: Callable, fields: str, *, kept: str
) -> DataFrame:
    """Rows of `keep` with what `make` finds in each text.

    make() is called once per task and returns a function from a list of texts (null: "") to a list
    of columns in the order of `fields`. `kept` is the schema of `keep`.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for whole in parts:
            for part in slices(whole, whole.num_columns - 1):
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                found = step(texts)
                columns = [part.column(i) for i in range(part.num_columns - 1)] + [
                    c if isinstance(c, pa.Array) else pa.array(c) for c in found
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"{kept}, {fields}"
    names = [f.split()[0] for f in schema.replace("array<struct<", "array<").split(", ")]
    return df.select(*keep, text.cast("string").alias("_text")).mapInArrow(run, schema)


def row_key(id: str, text: str) -> Column:
    """A key of a row that also tells apart rows of equal or null id; repeated rows share it."""
    return F.xxhash64(F.col(id), F.col(text))


def crc_bucket(id: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo `buckets`; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


__all__ = ["BATCH_BYTES", "bounded", "bounded_batches", "crc_bucket", "map_texts", "materialize", "row_key", "short_lived_shuffles", "slices", "unique_name"]
