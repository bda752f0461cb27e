"""The best class of each post."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslm.functions.text import ws_tokens
from corpuslm.operators.models import UnigramModel
from corpuslm.operators.scoring import LAMBDA, check_lambda, distinct_terms, score_blocks, score_columns, scores
from corpuslm.plans.shared import materialize
from corpuslm.plans.sizes import BROADCAST_BYTES
from corpuslm.plans.skew import lookup_join


def max_score(scores: DataFrame, by: list[str], id: str, score: str = "score") -> DataFrame:
    """Add max_score, the highest score among the rows that share `by`.

    by=[id] has one row per class in a group and uses a window. Any other key may hold many posts: the maximum of
    each post is written, one row for each, that of a key is taken from those, and the scores meet their post's row again. `id` must be
    unique for a post; scores_with_max saves making the scores twice.
    """
    if list(by) == [id]:
        return scores.withColumn("max_score", F.max(score).over(Window.partitionBy(*by)))
    posts = materialize(scores.groupBy(id, *by).agg(F.max(score).alias("_top"), F.count("*").alias("_scores")), "post-maxima")
    best = _of_keys(posts, by, id).select(F.col(id).alias("_post"), "max_score")
    return scores.join(best, scores[id].eqNullSafe(best["_post"])).drop("_post")


def _of_keys(posts: DataFrame, by: list[str], id: str) -> DataFrame:
    """Add max_score, the highest _top among the posts that share `by`."""
    best = posts.groupBy(*by).agg(F.max("_top").alias("max_score"), F.count("*").alias("_rows"))
    return lookup_join(posts, best, list(by), "_rows", ["max_score"], spread_by=id)


def scores_with_max(
    posts: DataFrame,
    model: UnigramModel,
    id: str,
    by: list[str],
    text: str = "text",
    keep: tuple[str, ...] = (),
    lam: float = LAMBDA,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, keep..., class, score, max_score): max_score over scores; `by` are among id and keep.

    With few classes a post's sums are written once, in one row; its scores, its maximum and that of its key all come from them.
    With many there is a row for each block of classes.
    """
    if list(by) == [id]:
        return max_score(scores(posts, model, id, text, keep, lam, broadcast_bytes=broadcast_bytes), by, id)
    if model.classes is None:
        keys = [id, *keep]
        terms = distinct_terms(posts, keys, ws_tokens(F.col(text)))
        rows = materialize(score_blocks(posts, terms, model, keys, check_lambda(lam), broadcast_bytes=broadcast_bytes), "post-scores")
        best = rows.groupBy(id, *by).agg(F.max(F.array_max("_scores")).alias("_top"))
        best = _of_keys(best, by, id).select(F.col(id).alias("_post"), "max_score")
        rows = rows.join(best, rows[id].eqNullSafe(best["_post"]))
        return rows.select(*keys, F.inline(F.arrays_zip(F.col("_labels").alias("class"), F.col("_scores").alias("score"))), "max_score")
    rows = materialize(score_columns(posts, model, id, text, keep, lam, broadcast_bytes), "post-scores")
    tops = [f"_s_{i}" for i in range(len(model.classes))]
    best = _of_keys(rows.withColumn("_top", F.greatest(*tops) if len(tops) > 1 else F.col(tops[0])), by, id)
    entries = [F.struct(F.lit(c[model.label]).alias("class"), F.col(s).alias("score")) for c, s in zip(model.classes, tops)]
    return best.select(id, *keep, F.inline(F.array(*entries)), "max_score")


def predict(
    scores: DataFrame, by: list[str], id: str, ties: str = "all", name: str = "class", score: str = "score"
) -> DataFrame:
    """The rows whose score is the highest of their key, the class renamed to prediction.

    ties="all" keeps every such row; ties="first" keeps one, the smallest class and then the smallest id.
    """
    if ties == "all":
        best = max_score(scores, by, id, score)
        return best.where(F.col("max_score") == F.col(score)).withColumnRenamed(name, "prediction")
    if ties != "first":
        raise ValueError("ties must be 'all' or 'first'")
    rest = [c for c in scores.columns if c not in (score, name, id, *by)]
    one = F.min(F.struct((-F.col(score)).alias("_neg"), name, *([] if list(by) == [id] else [id]), *rest))
    one = scores.groupBy(*by).agg(one.alias("_one"))
    columns = [F.col(c) if c in by else (-F.col("_one._neg") if c == score else F.col(f"_one.{c}")).alias(c)
               for c in scores.columns]
    return one.select(*columns).withColumn("max_score", F.col(score)).withColumnRenamed(name, "prediction")
