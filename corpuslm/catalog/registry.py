"""Name, Spark query and (where SQL can say it) DuckDB query of each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslm.sources.tables import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register the function below under `name`, with its equivalent SQL."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, read for work on their texts."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def as_posts(docs: DataFrame) -> DataFrame:
    """documents as a post table: a language as class, a key that is not unique."""
    return docs.select(
        "doc_id",
        F.col("source").alias("author"),
        F.col("n_chars").cast("string").alias("created"),
        F.col("lang").alias("flair"),
        "text",
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_posts(table(spark, sf_dir, "documents"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts, read for work on their texts."""
    return as_posts(documents(spark, sf_dir))


def rounded(column: str, digits: int = 6):
    # adding zero turns a rounded -0.0 into 0.0
    return (F.round(column, digits) + F.lit(0.0)).alias(column)


# SQL pieces ---------------------------------------------------------------------------------------

WS = r"[ \t\n\x0B\f\r]"
TOKENS_WS = (
    f"CASE WHEN regexp_full_match(text, '{WS}+') THEN []::VARCHAR[] "
    f"ELSE regexp_split_to_array(lower(regexp_replace(text, '{WS}+$', '')), '{WS}') END"
)
TOKENS_WORD = "list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]'), lambda x: x <> '')"

POSTS = """posts AS (
  SELECT doc_id, source AS author, CAST(n_chars AS VARCHAR) AS created, lang AS flair, text FROM documents)"""

LABELS = """classes AS (
  SELECT flair, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, flair) - 1 AS DOUBLE) AS idx,
    count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS prior
  FROM posts GROUP BY flair)"""

LABEL_TERMS = f"""words AS (SELECT flair, unnest({TOKENS_WORD}) AS word FROM posts),
label_terms AS (SELECT flair, word, CAST(count(*) AS DOUBLE) AS n FROM words GROUP BY flair, word)"""

MODELS = """label_totals AS (SELECT flair, sum(n) AS n FROM label_terms GROUP BY flair),
background AS (SELECT word, sum(n) / (SELECT sum(n) FROM label_terms) AS p_bg FROM label_terms GROUP BY word),
label_lm AS (SELECT l.flair, l.word, l.n / t.n AS p_lm FROM label_terms l JOIN label_totals t USING (flair))"""

# the formula as it is written, over every post, class and matched word
SCORES = f"""doc_terms AS (SELECT DISTINCT doc_id, unnest({TOKENS_WS}) AS word FROM posts),
matched AS (SELECT d.doc_id, d.word, b.p_bg FROM doc_terms d JOIN background b ON d.word = b.word),
sums AS (
  SELECT m.doc_id, c.flair AS class, sum(ln(c.prior * (0.5::DOUBLE * coalesce(l.p_lm, 0) + 0.5::DOUBLE * m.p_bg)
    / (0.5::DOUBLE * m.p_bg))) AS score
  FROM matched m CROSS JOIN classes c LEFT JOIN label_lm l ON l.flair = c.flair AND l.word = m.word
  GROUP BY m.doc_id, c.flair),
scores AS (
  SELECT p.doc_id, p.author, p.created, own.idx AS label, c.idx AS class, coalesce(s.score, 0) AS score
  FROM posts p JOIN classes own ON own.flair = p.flair CROSS JOIN classes c
  LEFT JOIN sums s ON s.doc_id = p.doc_id AND s.class = c.flair)"""

ALL_SCORES = ",\n".join([POSTS, LABELS, LABEL_TERMS, MODELS, SCORES])


def predicted(by: str) -> str:
    # scores that agree to nine digits are equal: sums of doubles depend on their order here
    return f"""best AS (SELECT *, max(round(score, 9)) OVER (PARTITION BY {by}) AS max_score FROM scores),
predictions AS (SELECT doc_id, label, class AS prediction, score, max_score FROM best
  WHERE round(score, 9) = max_score)"""
