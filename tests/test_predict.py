import pytest

from corpuslm.operators import models
from corpuslm.operators.predict import max_score, predict, scores_with_max
from corpuslm.operators.scoring import scores
from corpuslm.plans.classify import classify


def scored(spark):
    rows = [
        (1, "k", "x", 0.0, -1.0), (1, "k", "x", 1.0, -2.0),  # competes with post 2 under one key
        (2, "k", "x", 0.0, -3.0), (2, "k", "x", 1.0, -0.5),
        (3, "k", "y", 0.0, 0.0), (3, "k", "y", 1.0, 0.0),  # a tie
        (4, None, "y", 0.0, 5.0), (4, None, "y", 1.0, 4.0),
        (5, None, "y", 0.0, 5.0), (5, None, "y", 1.0, 4.5),  # ties with post 4 under a null key
    ]
    return spark.createDataFrame(rows, "id int, created string, author string, class double, score double")


def keyed(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_predict_by_id(spark):
    df = predict(scored(spark), ["id"], "id")
    assert keyed(df, "id", "prediction") == [(1, 0.0), (2, 1.0), (3, 0.0), (3, 1.0), (4, 0.0), (5, 0.0)]
    first = predict(scored(spark), ["id"], "id", ties="first")
    assert keyed(first, "id", "prediction", "score") == [(1, 0.0, -1.0), (2, 1.0, -0.5), (3, 0.0, 0.0), (4, 0.0, 5.0), (5, 0.0, 5.0)]
    assert first.columns == df.columns


def test_predict_by_shared_key(spark):
    by = ["created", "author"]
    assert keyed(predict(scored(spark), by, "id"), "id", "prediction") == [(2, 1.0), (3, 0.0), (3, 1.0), (4, 0.0), (5, 0.0)]
    assert keyed(predict(scored(spark), by, "id", ties="first"), "id", "prediction") == [(2, 1.0), (3, 0.0), (4, 0.0)]
    with pytest.raises(ValueError):
        predict(scored(spark), by, "id", ties="some")


def test_max_score_of_a_hot_key(spark):
    """One key holds most rows, all of them equal: every row is kept."""
    rows = [(i, "hot" if i % 3 else f"k{i}", "a", 0.0, 1.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, created string, author string, class double, score double")
    got = max_score(df, ["created", "author"], "id")
    assert got.count() == 3000 and got.where("max_score <> score OR max_score IS NULL").count() == 0


def test_classify_micro(micro):
    done = classify(micro, "id")
    got = {r["id"]: (r["label"], r["prediction"]) for r in done.predictions.collect()}
    assert got == {1: (0.0, 0.0), 2: (0.0, 0.0), 3: (1.0, 1.0), 5: (0.0, 0.0)}
    types = {f.name: f.dataType.simpleString() for f in done.predictions.schema}
    assert types == {"id": "bigint", "label": "double", "prediction": "double", "score": "double", "max_score": "double"}
    keyed = classify(micro, "id", by=["created", "author"])
    assert keyed.scores.columns == ["id", "created", "author", "label", "class", "score"]


def test_no_match_keeps_a_row_per_class(spark, micro):
    extra = micro.unionByName(spark.createDataFrame([(6, "eve", "d6", "tech", "xx!! yy??")], micro.schema))
    assert keyed(classify(extra, "id").predictions.where("id = 6"), "prediction") == [(0.0,), (1.0,)]
    assert keyed(classify(extra, "id", ties="first").predictions.where("id = 6"), "prediction") == [(0.0,)]


@pytest.mark.parametrize("ties", ["all", "first"])
def test_classify_by_key_is_predict_over_all_scores(documents, ties):
    from pyspark.sql import functions as F

    posts = documents.select("doc_id", F.col("lang").alias("flair"), "text", F.length("source").alias("author"), "source")
    done = classify(posts, "doc_id", by=["author"], ties=ties)
    want = predict(done.scores, ["author"], "doc_id", ties)
    assert keyed(done.predictions, *sorted(want.columns)) == keyed(want, *sorted(want.columns))
    assert done.predictions.columns == want.columns


@pytest.mark.parametrize("wide", [32, 1])
def test_scores_with_max_is_max_score_over_scores(spark, micro, wide):
    """One row per post is written at most; shared and null keys; the score's own columns stay."""
    posts = micro.where("flair IS NOT NULL").union(spark.createDataFrame([(7, None, "d1", "tech", "bread"), (8, None, "d1", "food", "fast sql"), (9, "ann", "d1", "food", None)], micro.schema))
    model = models.fit(posts, wide=wide)
    got = scores_with_max(posts, model, "id", ["created", "author"], keep=("created", "author"))
    own = {(r["id"], r["class"]): r for r in scores(posts, model, "id", keep=("created", "author")).collect()}
    best = {}
    for r in own.values():
        best[r["created"], r["author"]] = max(best.get((r["created"], r["author"]), -1e9), r["score"])
    rows = got.collect()
    assert got.columns == ["id", "created", "author", "class", "score", "max_score"] and len(rows) == len(own)
    assert all((r["score"], r["max_score"]) == (own[r["id"], r["class"]]["score"], best[r["created"], r["author"]]) for r in rows)


def test_max_score_writes_a_row_per_post(spark, monkeypatch):
    from corpuslm.operators import predict as module

    written = []
    keep = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: written.append(keep(df, name)) or written[-1])
    df = spark.createDataFrame([(i, f"k{i % 3}", "a", float(c), float(c * i % 5)) for i in range(50) for c in range(6)], "id int, created string, author string, class double, score double")
    assert max_score(df, ["created", "author"], "id").count() == 300
    assert [w.count() for w in written] == [50]
