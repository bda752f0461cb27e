"""Appending in named batches: a run that fails half-way is not seen, a repeated run is not doubled."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from corpuslm.sources.jsonlines import POST_SCHEMA, read_posts

MANIFEST = T.StructType([T.StructField("batch", T.StringType()), T.StructField("folder", T.StringType())])


def committed(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of each batch whose writing has ended. One row per batch, as a listing of the folders would be.

    Of runs of one batch that ended side by side, the folder of the smallest name counts, for every reader alike.
    """
    try:
        rows = spark.read.schema(MANIFEST).json(f"{path}/manifest").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    found: dict[str, str] = {}
    for batch, folder in rows:
        found[batch] = min(folder, found.get(batch, folder))
    return found


def append_batch(posts: DataFrame, path: str, batch: str) -> bool:
    """Add the posts as the batch of that name, unless it is there already. Returns whether rows were written.

    The rows are written as JSON lines to a folder of their own. Only once all are written does a one-line file in the
    manifest name that folder, so readers see the whole batch or nothing, and a failed run can simply be repeated.
    """
    spark = posts.sparkSession
    if batch in committed(spark, path):
        return False
    folder = f"batch-{uuid.uuid4().hex}"
    posts.write.json(f"{path}/{folder}")
    spark.createDataFrame([(batch, folder)], MANIFEST).coalesce(1).write.mode("append").json(f"{path}/manifest")
    return True


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType | None = POST_SCHEMA, bad_lines: str | None = None
) -> DataFrame:
    """All rows of the batches that are committed; no rows where there are none. Other arguments as in read_posts()."""
    folders = sorted(committed(spark, path).values())
    if folders:
        return read_posts(spark, [f"{path}/{f}" for f in folders], schema, bad_lines)
    fields = [*(schema or T.StructType()).fields, *([T.StructField(bad_lines, T.StringType())] if bad_lines else [])]
    return spark.createDataFrame([], T.StructType(fields))
