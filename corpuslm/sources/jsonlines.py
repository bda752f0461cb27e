"""JSON-lines post tables: scan, append, ingest-if-absent."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POST_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("author", "created", "flair", "text")])


def read_posts(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = POST_SCHEMA, bad_lines: str | None = None
) -> DataFrame:
    """Scan JSON lines (blank lines are skipped). schema=None infers it, at the price of a second scan.

    A line that is no JSON object becomes a row of nulls. bad_lines names a further column that holds such
    lines as they are, and null for the good ones.
    """
    reader = spark.read
    if bad_lines:
        reader = reader.option("columnNameOfCorruptRecord", bad_lines)
    if schema is not None:
        schema = T.StructType([*schema.fields, T.StructField(bad_lines, T.StringType())]) if bad_lines else schema
        reader = reader.schema(schema)
    return reader.json(path)


def append_posts(posts: DataFrame, path: str) -> None:
    """Add every row as a line; running it twice keeps both copies."""
    posts.write.mode("append").json(path)


def has_data(spark: SparkSession, path: str) -> bool:
    """False when the path is missing or holds nothing."""
    try:
        return not spark.read.text(path).isEmpty()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def write_if_absent(posts: DataFrame, path: str) -> bool:
    """Ingest only when there is no data yet. Returns whether rows were written."""
    if has_data(posts.sparkSession, path):
        return False
    append_posts(posts, path)
    return True
