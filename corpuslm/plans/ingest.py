"""From raw submissions to the stored post table, and on to the classes: one lazy plan up to the sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslm.functions import text as tx
from corpuslm.operators import prep
from corpuslm.plans.classify import Classified, classify
from corpuslm.plans.shared import materialize
from corpuslm.sources.jsonlines import read_posts, write_if_absent


def prepare(
    submissions: DataFrame,
    is_self: Column,
    self_text: Column,
    url: Column,
    extractors: list[tuple[str, Column]],
    author: Column,
    created: Column,
    flair: Column,
    min_chars: int = prep.MIN_CHARS,
    mark: str = prep.PDF_MARK,
) -> DataFrame:
    """(author, created, text, flair): route each submission's text, drop short ones, keep each record once."""
    named = submissions.withColumns({"author": author, "created": created.cast("string"), "flair": flair})
    routed = prep.route_text(named, is_self, self_text, url, extractors, min_chars=min_chars, mark=mark)
    nested = prep.nest_submission(prep.min_length(routed, min_chars=min_chars), ["author", "created", "flair", "method"])
    return prep.project_dedup(prep.with_post_key(nested))


def ingest(posts: DataFrame, path: str) -> DataFrame:
    """Store the posts as JSON lines unless there are some already, and scan what is stored."""
    write_if_absent(posts, path)
    return read_posts(posts.sparkSession, path)


def classify_stored(stored: DataFrame, lam: float = 0.5, ties: str = "all") -> Classified:
    """Classify a scanned post table. Posts of one author and creation time compete, as a post is known by these two.

    The stored rows are written with a number of their own, so each is scored by itself however many share its key, null
    ones included. The predictions are the best rows of a key, with the key as text.
    """
    posts = materialize(stored.withColumn("post", F.monotonically_increasing_id()), "stored-posts")
    done = classify(posts, "post", by=["created", "author"], lam=lam, ties=ties)
    key = tx.post_key(F.col("author"), F.col("created")).alias("key")
    done.predictions = done.predictions.select(key, *[c for c in done.predictions.columns if c != "post"])
    return done


def stage_table(posts: DataFrame, index, id: str) -> DataFrame:
    """(author, created, flair, text, words, indexed_flair): labelled posts with tokens and label index."""
    indexed = index.transform(posts, spread_by=id)
    return indexed.select("author", "created", "flair", "text", tx.ws_tokens(F.col("text")).alias("words"), "indexed_flair")
