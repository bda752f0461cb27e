"""The whole classification: labels, models, scores, best class."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Row

from corpuslm.operators.labels import LabelIndex, label_index
from corpuslm.operators.models import UnigramModel, fit
from corpuslm.operators.predict import predict
from corpuslm.operators.scoring import LAMBDA, best_classes, scores
from corpuslm.plans.shared import materialize


@dataclass
class Classified:
    labels: LabelIndex
    model: UnigramModel
    score_all: Callable[[], DataFrame]
    predict_all: Callable[[], DataFrame]

    @cached_property
    def predictions(self) -> DataFrame:
        """The best classes. They take jobs of their own, which the scores don't need."""
        return self.predict_all()

    @cached_property
    def scores(self) -> DataFrame:
        """All scores. With many classes they take jobs of their own, which the predictions don't need."""
        return self.score_all()


def classify(
    posts: DataFrame,
    id: str,
    flair: str = "flair",
    text: str = "text",
    by: list[str] | None = None,
    ties: str = "all",
    lam: float = LAMBDA,
) -> Classified:
    """Index the labels, fit the models, score the labelled posts and keep each post's best class.

    Scores have (id, by..., label, class, score), predictions (id, by..., label, prediction, score,
    max_score), classes being label indexes. `by` is what identifies a post in the end: a unique id
    unless given, or for instance ["created", "author"].
    """
    labels = label_index(posts, flair)
    indexed = labels.transform(posts, spread_by=id, name="label")
    classes = labels.entries and [Row(label=e["label_index"], n=e["n"]) for e in labels.entries]
    model = fit(indexed, "label", text, classes)
    by = by or [id]
    keep = tuple(c for c in by if c != id) + ("label",)

    def predictions() -> DataFrame:
        if by == [id]:
            return best_classes(indexed, model, id, text, keep=keep, lam=lam, ties=ties)
        # the best of a key is among the best of its posts: few narrow rows, written as they are read twice
        own = materialize(best_classes(indexed, model, id, text, keep=keep, lam=lam).drop("max_score"), "own-best")
        return predict(own, by, id, ties, name="prediction")

    return Classified(labels, model, lambda: scores(indexed, model, id, text, keep=keep, lam=lam), predictions)
